"""Mixing sources to target weights by capped water-filling.

Every source gets its weight's share of all words, but no more than a maximum of epochs of its own
size; what the clamped sources cannot take is shared among the others by weight, until none is above.
Whole repetitions take every document. The fractional one takes documents in the order of a seeded hash until
the target is met, the last of them in part, so that a source's words meet its target to the word.
That order is never sorted as a whole: hash buckets are summed, and only the bucket that holds the
target's end is looked at by document.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.llm.written import written

WEIGHTS = (5.0, 2.0, 1.0)  # for the sources in code point order, repeating
EPOCHS = 3.0
SEED = 17
BUCKET_ROWS = 2_000

WORDS = r"[^\x20\x09-\x0D]+"


def _in_order(spark: SparkSession, df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Adds ``part`` and ``at``: rows are in order by both. Sorted over tasks and written, never in one task."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    at = F.monotonically_increasing_id()
    return written(spark, ranged.withColumn("part", F.shiftright(at, 33)).withColumn("at", at), name)


def _sums_before(ordered: DataFrame, sums: dict[str, str]) -> DataFrame:
    """Adds the sum of each expression over all rows that come before, by sums of parts and sums within a part."""
    of_part = ordered.groupBy("part").agg(*[F.expr(f"sum({sql})").alias(f"all_{n}") for n, sql in sums.items()])
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per task of a sort
    zero = F.lit(0)
    starts = of_part.select(
        F.col("part").alias("_part"), *[F.coalesce(F.sum(f"all_{n}").over(earlier), zero).alias(f"start_{n}") for n in sums]
    )
    inside = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    own = {n: F.coalesce(F.sum(F.expr(sql)).over(inside), zero) for n, sql in sums.items()}
    joined = ordered.withColumns({f"own_{n}": c for n, c in own.items()}).join(starts, F.col("part") == F.col("_part"))
    whole = joined.withColumns({n: F.col(f"start_{n}") + F.col(f"own_{n}") for n in sums})
    return whole.select(*ordered.columns, *sums)


def water_fill(
    spark: SparkSession, sources: DataFrame, weights: Sequence[float] = WEIGHTS, epochs: float = EPOCHS
) -> DataFrame:
    """(source, source_size, n) with ``target``: sizes shared by weight, none above ``epochs`` times its size.

    Sources are ordered by what they can take for their weight. Those before the level are at their maximum, the
    others share what these leave; the level is the first place where the share is not above the
    maximum. Numbers and sums come from sorts over many tasks, so there may be any number of sources.
    If the whole can't be placed, every source is at its maximum; sources without weight get nothing.
    """
    named = _in_order(spark, sources, [F.asc_nulls_last("source")], "sources")
    numbered = _sums_before(named, {"number": "1"})
    weight = f"element_at(array({', '.join(f'{float(w)!r}D' for w in weights)}), cast(number % {len(weights)} + 1 as int))"
    weighed = numbered.selectExpr("source", "source_size", "n", f"{weight} as weight")
    weighed = weighed.withColumn("most", F.expr(f"if(weight > 0, {float(epochs)!r}D * source_size, 0D)"))
    weighed = weighed.withColumn("room", F.expr("if(weight > 0, most / weight, 0D)"))
    filled = _sums_before(
        _in_order(spark, weighed, [F.asc("room"), F.asc_nulls_last("source")], "rooms"),
        {"full": "most", "done": "weight"},
    )
    # four numbers, for the whole table
    total, shares = sources.agg(F.sum("source_size")).first()[0] or 0, weighed.agg(F.sum("weight")).first()[0] or 0.0
    filled = written(spark, filled, "filled")
    level = (
        filled.where("weight > 0")
        .withColumns({"remaining": F.lit(float(total)) - F.col("full"), "sharing": F.lit(float(shares)) - F.col("done")})
        .where("remaining * weight / sharing <= most")
        .agg(F.min(F.struct("at", "remaining", "sharing")).alias("l"))
        .first()
        .l
    )
    target = f"if(at < {level.at}, most, {level.remaining!r}D * weight / {level.sharing!r}D)" if level else "most"
    return filled.selectExpr("source", "source_size", "n", f"{target} as target")


def mix(
    spark: SparkSession,
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    epochs: float = EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """One row per document: doc_id, source, body (hash of the text), size, source_size, target, taken.

    ``taken`` counts the words of whole repetitions and of the fractional one. Null is a source of its own
    and comes last; null texts have no words. A source without words has target 0. Rows of one doc_id
    are ordered by a hash of their text, and which of identical rows is taken makes no difference.
    """
    text = F.coalesce("text", F.lit(""))
    draw = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    sized = docs.select(
        "doc_id",
        "source",
        F.xxhash64("text").alias("body"),
        F.regexp_count(text, F.lit(WORDS)).cast("long").alias("size"),
        draw.alias("draw"),
    )
    sized = written(spark, sized, "sizes")
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    targets = water_fill(spark, written(spark, sources, "source-sizes"), weights, epochs)
    whole = "if(source_size = 0, 0L, cast(floor(target / source_size) as long)) as whole"
    part = "if(source_size = 0, 0L, cast(bround(target - whole * source_size) as long)) as part"
    targets = targets.selectExpr("*", whole).selectExpr("source as _source", "source_size", "n", "target", "whole", part)
    targets = written(spark, targets, "targets")
    rows = sized.join(targets.drop("n"), sized["source"].eqNullSafe(F.col("_source"))).drop("_source")
    most = targets.agg(F.max("n")).first()[0] or 0
    digits = next(k for k in range(2, 9) if 16**k * BUCKET_ROWS >= most or k == 8)
    rows = rows.withColumn("bucket", F.substring("draw", 1, digits))

    earlier = Window.partitionBy("source").orderBy("bucket")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("source", "bucket").agg(F.sum("size").alias("held"))
    sums = sums.select(
        F.col("source").alias("_source"),
        F.col("bucket").alias("_bucket"),
        "held",
        F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("before"),
    )
    same = rows["source"].eqNullSafe(F.col("_source")) & (rows["bucket"] == F.col("_bucket"))
    placed = rows.join(sums, same).drop("_source", "_bucket")
    ends_here = "before < part and before + held > part"
    inside = Window.partitionBy("source", "bucket").orderBy("draw", "doc_id", "body")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    whole_buckets = placed.where(f"not ({ends_here})").withColumn(
        "extra", F.expr("if(before + held <= part, size, 0L)")
    )
    last_bucket = (
        placed.where(ends_here)
        .withColumn("ahead", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .withColumn("extra", F.expr("least(size, greatest(0L, part - before - ahead))"))
        .drop("ahead")
    )
    return (
        whole_buckets.unionByName(last_bucket)
        .withColumn("taken", F.col("whole") * F.col("size") + F.col("extra"))
        .select("doc_id", "source", "body", "size", "source_size", "target", "whole", "extra", "taken")
    )
