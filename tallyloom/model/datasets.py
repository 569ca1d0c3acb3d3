"""The four canonical datasets: column names, types and, for cost and usage, the level of each column.

Money and quantities are doubles, times are zone-less timestamps in UTC, JSON is kept as text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Name, type, level, extra format check.
# Levels: required (type error, must be present), expected (type error), noted (type warning on a
# column every row should have), conditional (type warning), tagged (format warning only).
COST_AND_USAGE_TABLE = """
BilledCost                           double     required     numeric
BillingAccountId                     string     required     string
BillingAccountName                   string     required     -
BillingAccountType                   string     conditional  -
BillingCurrency                      string     required     currency,national_currency
BillingPeriodStart                   timestamp  required     datetime
BillingPeriodEnd                     timestamp  required     datetime
ChargeCategory                       string     required     -
ChargeClass                          string     required     -
ChargeDescription                    string     required     -
ChargeFrequency                      string     noted        -
ChargePeriodStart                    timestamp  required     datetime
ChargePeriodEnd                      timestamp  required     datetime
CommitmentDiscountCategory           string     conditional  -
CommitmentDiscountId                 string     conditional  -
CommitmentDiscountName               string     conditional  -
CommitmentDiscountQuantity           double     conditional  -
CommitmentDiscountStatus             string     conditional  -
CommitmentDiscountType               string     conditional  -
CommitmentDiscountUnit               string     conditional  -
ConsumedQuantity                     double     conditional  -
ConsumedUnit                         string     conditional  -
ContractedCost                       double     required     numeric
ContractedUnitPrice                  double     conditional  -
EffectiveCost                        double     required     numeric
ListCost                             double     required     numeric
ListUnitPrice                        double     conditional  -
PricingCategory                      string     conditional  -
PricingCurrency                      string     conditional  currency
PricingQuantity                      double     required     numeric
PricingUnit                          string     required     unit
ServiceCategory                      string     required     -
ServiceName                          string     required     -
ServiceSubcategory                   string     noted        -
SkuId                                string     conditional  -
SkuMeter                             string     conditional  -
SkuPriceDetails                      string     conditional  -
SkuPriceId                           string     conditional  -
SubAccountId                         string     conditional  -
SubAccountName                       string     conditional  -
SubAccountType                       string     conditional  -
AvailabilityZone                     string     conditional  -
CapacityReservationId                string     conditional  -
CapacityReservationStatus            string     conditional  -
ResourceId                           string     conditional  -
ResourceName                         string     conditional  -
ResourceType                         string     conditional  -
RegionId                             string     expected     -
RegionName                           string     conditional  -
Tags                                 string     tagged       key_value
InvoiceId                            string     conditional  -
InvoiceIssuerName                    string     required     -
InvoiceDetailId                      string     conditional  -
AllocatedResourceId                  string     conditional  -
AllocatedResourceName                string     conditional  -
AllocatedMethodId                    string     conditional  -
AllocatedMethodDetails               json       conditional  json
AllocatedTags                        string     tagged       key_value
ContractApplied                      json       conditional  json
CommitmentProgramEligibilityDetails  json       conditional  json
HostProviderName                     string     required     -
ServiceProviderName                  string     required     -
"""

# Name and type.
BILLING_PERIOD_TABLE = """
BillingPeriodCreated      timestamp
BillingPeriodEnd          timestamp
BillingPeriodLastUpdated  timestamp
BillingPeriodStart        timestamp
BillingPeriodStatus       string
InvoiceIssuerName         string
"""

# Name and type.
INVOICE_DETAIL_TABLE = """
BilledCost                      double
BillingAccountId                string
BillingCurrency                 string
BillingPeriodEnd                timestamp
BillingPeriodStart              timestamp
ChargeCategory                  string
InvoiceDetailCreated            timestamp
InvoiceDetailDescription        string
InvoiceDetailGrain              string
InvoiceDetailId                 string
InvoiceDetailLastUpdated        timestamp
InvoiceId                       string
InvoiceIssueDate                timestamp
InvoiceIssuerName               string
InvoiceIssueStatus              string
PaymentCurrency                 string
PaymentCurrencyBilledCost       double
PaymentCurrencyInvoiceDetailId  string
PaymentDueDate                  timestamp
PaymentTerms                    string
PurchaseOrderNumber             string
ReferenceInvoiceId              string
"""

# Name and type.
CONTRACT_COMMITMENT_TABLE = """
BillingCurrency                             string
ContractCommitmentApplicability             json
ContractCommitmentBenefitCategory           string
ContractCommitmentCategory                  string
ContractCommitmentCost                      double
ContractCommitmentCreated                   timestamp
ContractCommitmentDescription               string
ContractCommitmentDiscountPercentage        double
ContractCommitmentDurationType              string
ContractCommitmentFulfillmentInterval       string
ContractCommitmentId                        string
ContractCommitmentLastUpdated               timestamp
ContractCommitmentLifecycleStatus           string
ContractCommitmentModel                     string
ContractCommitmentOfferCategory             string
ContractCommitmentPaymentInterval           string
ContractCommitmentPaymentModel              string
ContractCommitmentPaymentUpfrontPercentage  double
ContractCommitmentPeriodEnd                 timestamp
ContractCommitmentPeriodStart               timestamp
ContractCommitmentQuantity                  double
ContractCommitmentType                      string
ContractCommitmentUnit                      string
ContractId                                  string
ContractPeriodEnd                           timestamp
ContractPeriodStart                         timestamp
InvoiceIssuerName                           string
PricingCurrency                             string
PricingCurrencyContractCommitmentCost       double
ServiceProviderName                         string
"""

_SPARK_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampNTZType(),
    "json": T.StringType(),
}


def _entries(table: str) -> list[list[str]]:
    return [line.split() for line in table.strip().splitlines()]


DATASETS: dict[str, dict[str, str]] = {
    name: {row[0]: row[1] for row in _entries(table)}
    for name, table in (
        ("CostAndUsage", COST_AND_USAGE_TABLE),
        ("BillingPeriod", BILLING_PERIOD_TABLE),
        ("InvoiceDetail", INVOICE_DETAIL_TABLE),
        ("ContractCommitment", CONTRACT_COMMITMENT_TABLE),
    )
}


def column_list(dataset: str) -> list[str]:
    """Column names of a dataset in order; an unknown dataset has none."""
    return list(DATASETS.get(dataset, {}))


def dataset_schema(dataset: str) -> T.StructType:
    return T.StructType(
        [T.StructField(name, _SPARK_TYPES[kind]) for name, kind in DATASETS[dataset].items()]
    )


def declared_type(column: str, fallback: T.DataType | None = None) -> T.DataType:
    """The type any canonical dataset declares for ``column``, else ``fallback`` (string)."""
    for columns in DATASETS.values():
        if column in columns:
            return _SPARK_TYPES[columns[column]]
    return fallback or T.StringType()


def empty_dataset(spark: SparkSession, dataset: str) -> DataFrame:
    """A typed relation without rows, for a dataset that has no feed yet."""
    return spark.createDataFrame([], dataset_schema(dataset))
