from tallyloom.model.currency import CURRENCY_CODES, currency_frame
from tallyloom.model.datasets import (
    COST_AND_USAGE_TABLE,
    DATASETS,
    column_list,
    dataset_schema,
    declared_type,
    empty_dataset,
)
from tallyloom.model.manifests import RAW_MANIFESTS, STAGED_MANIFESTS, Manifest, manifest

__all__ = [
    "COST_AND_USAGE_TABLE",
    "CURRENCY_CODES",
    "DATASETS",
    "Manifest",
    "RAW_MANIFESTS",
    "STAGED_MANIFESTS",
    "column_list",
    "currency_frame",
    "dataset_schema",
    "declared_type",
    "empty_dataset",
    "manifest",
]
