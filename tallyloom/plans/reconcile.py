"""Usage and cost of the nested feed with nothing left over: what either side has alone becomes a row too.

The cost join of ``nested_ai`` starts from the meters, so a cost without a meter vanishes and one that two
meters could take is billed twice. Here each side has one row for what is paid for: a meter of a bucket,
or a cost that names none. They meet in a full outer join, so the billed total is the staged total.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import exact_sum
from tallyloom.operators.canonical import Branch, MappedFeed
from tallyloom.operators.mapping import Expression
from tallyloom.operators.staging import LOADED_AT
from tallyloom.plans.nested_ai import EXTRAS, FEE_COST_TYPE, METERS, PROVIDER, RULES, unpivot_meters

OUTCOME = "outcome"
MATCHED, USAGE_ONLY, COST_ONLY = "matched", "usage only", "cost only"

_STARTED = ("bucket_start", "model", "workspace_id")


def meters_of_start(usage: DataFrame) -> DataFrame:
    """One row per bucket start, model, workspace and meter with a positive quantity, up to the latest end."""
    sums = [F.expr(f"sum({meter})").alias(meter) for meter, *_ in METERS]
    ends = [F.max(name).alias(name) for name in ("bucket_end", LOADED_AT)]
    meters = unpivot_meters(usage.groupBy(*_STARTED).agg(*sums, *ends))
    return meters.selectExpr("*", "coalesce('token:' || cost_key, 'fee') as paid_for")


def costs_of_start(cost: DataFrame) -> DataFrame:
    """Dollars per bucket start, model, workspace and what they pay for.

    A cost pays for its token type; without one, for the fee or for nothing that is metered.
    """
    paid_for = (
        f"coalesce('token:' || token_type, if(cost_type = '{FEE_COST_TYPE}', 'fee', null),"
        " 'other:' || coalesce(cost_type, '')) as paid_for"
    )
    return (
        cost.where("amount_usd is not null")
        .selectExpr("*", paid_for)
        .groupBy(*_STARTED, "paid_for")
        .agg(
            F.expr(exact_sum("amount_usd")).alias("amount_usd"),
            F.max("bucket_end").alias("bucket_end"),
            F.max(LOADED_AT).alias(LOADED_AT),
        )
    )


def reconcile(usage: DataFrame, cost: DataFrame) -> DataFrame:
    """Meters with their costs, meters without one, and costs without a meter, told apart by ``outcome``.

    Both sides are aggregated to unique keys before they are joined, so no key is hot. A missing
    model or bucket start is equal to no other, a missing workspace to a missing one.
    """
    meters, costs = meters_of_start(usage).alias("m"), costs_of_start(cost).alias("c")
    same = (
        "m.bucket_start = c.bucket_start and m.model = c.model and m.workspace_id <=> c.workspace_id"
        " and m.paid_for = c.paid_for"
    )
    either = [
        f"coalesce(m.{name}, c.{name}) as {name}" for name in ("bucket_start", "bucket_end", "paid_for")
    ]
    return meters.join(costs, F.expr(same), "full").selectExpr(
        *either,
        "if(m.paid_for is null, c.model, m.model) as model",
        "if(m.paid_for is null, c.workspace_id, m.workspace_id) as workspace_id",
        *[f"m.{name} as {name}" for name in ("token_slot", "quantity", "unit", "label")],
        "c.amount_usd as amount_usd",
        f"greatest(m.{LOADED_AT}, c.{LOADED_AT}) as {LOADED_AT}",
        f"case when m.paid_for is null then '{COST_ONLY}' when c.paid_for is null then '{USAGE_ONLY}'"
        f" else '{MATCHED}' end as {OUTCOME}",
    )


RECONCILED_RULES = RULES | {
    "ChargeCategory": Expression(
        f"if({OUTCOME} = '{COST_ONLY}', 'Adjustment', {RULES['ChargeCategory'].text})"
    ),
    "ChargeDescription": Expression(
        f"if({OUTCOME} = '{COST_ONLY}', coalesce(model, '') || ' - Cost without usage, ' || paid_for,"
        " model || ' - ' || label)"
    ),
}


def map_reconciled(usage: DataFrame, cost: DataFrame) -> MappedFeed:
    """Cost and usage whose billed cost adds up to the staged cost, also after the newest-row selection."""
    return MappedFeed(PROVIDER, (Branch(reconcile(usage, cost), RECONCILED_RULES, EXTRAS),))


def balance(usage: DataFrame, cost: DataFrame) -> DataFrame:
    """Per bucket start: staged cost, cost on meters, cost without a meter, and what is missing or too much."""
    billed = (
        reconcile(usage, cost)
        .selectExpr(
            "*",
            f"if({OUTCOME} = '{COST_ONLY}', null, amount_usd) as on_meter",
            f"if({OUTCOME} = '{COST_ONLY}', amount_usd, null) as alone",
        )
        .groupBy(F.col("bucket_start").alias("of_start"))
        .agg(
            F.expr(f"coalesce({exact_sum('on_meter')}, 0.0D)").alias("billed"),
            F.expr(f"coalesce({exact_sum('alone')}, 0.0D)").alias("adjusted"),
            F.expr(f"count_if({OUTCOME} = '{COST_ONLY}')").alias("costs_without_usage"),
            F.expr(f"count_if({OUTCOME} = '{USAGE_ONLY}')").alias("meters_without_cost"),
        )
    )
    staged = cost.groupBy("bucket_start").agg(F.expr(exact_sum("amount_usd")).alias("staged"))
    gap = " - ".join(f"cast({name} as decimal(38, 18))" for name in ("staged", "billed", "adjusted"))
    return (
        billed.join(staged, F.col("of_start").eqNullSafe(F.col("bucket_start")), "full")
        .selectExpr(
            "if(of_start is null, bucket_start, of_start) as bucket_start",
            *[f"coalesce({name}, 0.0D) as {name}" for name in ("staged", "billed", "adjusted")],
            *[f"coalesce({name}, 0L) as {name}" for name in ("costs_without_usage", "meters_without_cost")],
        )
        .selectExpr("*", f"cast({gap} as double) as difference")
    )
