"""A feed folder as a stream: every file that appears is staged, mapped and merged into the table once."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallyloom.operators.canonical import CHARGE_KEY, PROVIDER, MappedFeed, canonical_one
from tallyloom.sources.files import with_load_time
from tallyloom.sources.sinks import with_month
from tallyloom.sources.upsert import upsert_latest

FORMATS = {
    "csv": {"header": "true", "escape": '"', "mode": "FAILFAST", "enforceSchema": "true"},
    "json": {"mode": "FAILFAST"},
    "parquet": {},
}


def feed_stream(
    spark: SparkSession, path: str, schema: T.StructType | str, kind: str = "csv", files_at_once: int | None = None
) -> DataFrame:
    """New files of a folder with the time each was written; a stream needs its schema beforehand."""
    reader = spark.readStream.format(kind).options(**FORMATS[kind]).schema(schema)
    if files_at_once:
        reader = reader.option("maxFilesPerTrigger", files_at_once)
    return with_load_time(reader.load(path))


def ingest_stream(
    raw: DataFrame,
    mapped: Callable[[DataFrame], MappedFeed],
    table: str,
    checkpoint: str,
    key: Sequence[str] = (PROVIDER, *CHARGE_KEY),
) -> StreamingQuery:
    """Merges all files there are now into the table, in batches, and ends.

    Each batch goes through the same mapping as a batch run and into ``upsert_latest``. A batch that is
    repeated after a loss gives the same table, so each file counts once. Feeds of more than one raw
    stream, or with totals over files, have to be run as batches: a batch sees only its own files.
    """

    def merge(batch: DataFrame, _: int) -> None:
        upsert_latest(batch.sparkSession, with_month(canonical_one(mapped(batch))), table, key)

    return (
        raw.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
