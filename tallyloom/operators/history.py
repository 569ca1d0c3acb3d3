"""What was known when: every version of a charge with the time it held, and the charges as of an instant."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import quoted
from tallyloom.operators.canonical import CHARGE_KEY, PROVIDER, dedup_latest
from tallyloom.operators.staging import LOADED_AT
from tallyloom.session import file_system, shuffles_removed

KNOWN_FROM, KNOWN_TO, AS_OF = "known_from", "known_to", "as_of"
PART = "_part"
COMPRESSION = "zstd"

# Bytes of rows, by Spark's estimate, whose versions are found at once, and the number of parts at most.
AT_ONCE = 64 << 20
PARTS = 64


def versions(
    df: DataFrame, key: Sequence[str] = (PROVIDER, *CHARGE_KEY), work: str | None = None, at_once: int = AT_ONCE
) -> DataFrame:
    """Adds ``known_from`` and ``known_to``: a version holds from its load up to the next load of its charge.

    Rows of a charge from one load are reduced first, as ``dedup_latest`` does, on the map side too; so a
    charge's window holds one row per load, whatever its number of rows. A row without a load time is older
    than all others.

    All rows go through two shuffles. With ``work``, a fresh folder that all executors share, what Spark
    estimates at over ``at_once`` bytes is written there first, without a shuffle, in parts by the key's hash. The
    parts are then done one after the other: each one's shuffle files and rows go when its versions are
    written, so the disk holds every row once and one part's shuffles.
    """
    parts = 1 if work is None else min(PARTS, -(-_estimated_bytes(df) // at_once))
    if parts <= 1:
        return _with_times(df, key)
    spark = df.sparkSession
    files, to_path = file_system(spark, work)
    split, done = f"{work}/rows", f"{work}/versions"
    columns = ", ".join(quoted(name) for name in key)
    with shuffles_removed(spark):
        each = df.selectExpr("*", f"cast(pmod(xxhash64({columns}), {parts}) as int) as {PART}")
        each.write.partitionBy(PART).parquet(split, compression=COMPRESSION)
        stored = spark.read.schema(each.schema).parquet(split)
        found = None
        for part in range(parts):
            found = _with_times(stored.where(f"{PART} = {part}").drop(PART), key)
            found.write.mode("append").parquet(done, compression=COMPRESSION)
            files.delete(to_path(f"{split}/{PART}={part}"), True)
    return spark.read.schema(found.schema).parquet(done)


def _estimated_bytes(df: DataFrame) -> int:
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _with_times(df: DataFrame, key: Sequence[str]) -> DataFrame:
    each = dedup_latest(df, (*key, LOADED_AT))
    columns = ", ".join(quoted(name) for name in key)
    following = (
        f"lead({LOADED_AT}) over (partition by xxhash64({columns}), {columns}"
        f" order by {LOADED_AT} asc nulls first) as {KNOWN_TO}"
    )
    return each.selectExpr("*", f"{LOADED_AT} as {KNOWN_FROM}", following)


def as_of(versioned: DataFrame, instants: Sequence[str]) -> DataFrame:
    """The rows known at each of some instants, which are expressions, with the instant in ``as_of``.

    A version names the instants within its time by itself, so there is no join over ranges.
    """
    within = (
        f"(t >= {KNOWN_FROM} or {KNOWN_FROM} is null) and (t < {KNOWN_TO} or {KNOWN_TO} is null)"
    )
    at = f"explode(filter(array({', '.join(instants)}), t -> {within})) as {AS_OF}"
    return versioned.selectExpr("*", at)


def changed_amounts(
    versioned: DataFrame, since: str, until: str, amount: str, key: Sequence[str] = (PROVIDER, *CHARGE_KEY)
) -> DataFrame:
    """Charges whose amount differs between two instants: the key, ``before`` and ``after``.

    A charge that was not yet known at ``since`` has no amount before.
    """
    sides = [
        f"max(if({AS_OF} = {at}, {quoted(amount)}, null)) as {name}" for name, at in (("before", since), ("after", until))
    ]
    known = as_of(versioned, [since, until]).groupBy(*key).agg(*[F.expr(side) for side in sides])
    return known.where("not (before <=> after)")
