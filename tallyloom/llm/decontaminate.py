"""Test items inside documents by size-partitioned MinHash containment search.

Items are partitioned by their number of five-word shingles into classes that double in size. An item's
sketch is its bottom-k MinHash: the k smallest shingle hashes, where k follows from the upper bound of
the class. A document that holds at least the threshold's share of an item's shingles misses
fewer than k of them, so it holds one of the sketch: the search loses no pair, however long the
document is. Candidates are verified by the exact containment of the shingles' words.

All of it are DataFrame operations. The sketch index is written first, so that Spark knows its size: it is
broadcast below Spark's threshold, and beyond it document shingles are shuffled to it by hash.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.written import written

SHINGLE_WORDS = 5
THRESHOLD = 0.8
SPACES = r"[\x20\x09-\x0D]+"


def _words(text: str) -> Column:
    """Lower-case words between ASCII white space."""
    return F.filter(F.split(F.lower(text), SPACES), lambda w: w != "")


def _each(words: str, width: int, made: str) -> Column:
    """``made``, SQL over the word array and ``i``, for each start of ``width`` consecutive words."""
    return F.expr(
        f"if(size({words}) >= {width}, transform(sequence(0, size({words}) - {width}), i -> {made}),"
        f" cast(array() as array<{'bigint' if made.startswith('xxhash64') else 'string'}>))"
    )


def _hashes(words: str, width: int) -> Column:
    return _each(words, width, "xxhash64(" + ", ".join(f"{words}[i + {k}]" for k in range(width)) + ")")


def _phrases(words: str, width: int) -> Column:
    return F.array_distinct(
        _each(words, width, "concat_ws(' ', " + ", ".join(f"{words}[i + {k}]" for k in range(width)) + ")")
    )


def _by_width(made: Callable[[int], Column], width: int) -> Column:
    """``made`` for the item's own shingle width, which is that of all its words if these are fewer."""
    return reduce(lambda other, w: F.when(F.col("width") == w, made(w)).otherwise(other), range(1, width), made(width))


def find_items(
    spark: SparkSession,
    docs: DataFrame,
    items: DataFrame,
    width: int = SHINGLE_WORDS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Rows doc_id, body, item_id, n_shared, n_shingles and containment, of at least the threshold.

    ``body`` is the hash of the document's text. Containment is the share of an item's distinct shingles
    that the document has. An item of fewer words than a shingle is one shingle, all its words, and is
    found wherever they stand in a row. Null texts and items without words match nothing. Rows that
    share an item_id are looked for one by one, and the best fit is told; equal document rows are told
    once, also those without a doc_id. Empty tables give no rows; further columns are ignored.
    """
    known = (
        items.where("text is not null")
        .select("item_id", _words("text").alias("words"))
        .where("size(words) > 0")
        .withColumn("width", F.least(F.size("words"), F.lit(width)))
        .select(
            "item_id",
            "width",
            _by_width(lambda w: _phrases("words", w), width).alias("phrases"),
            _by_width(lambda w: _hashes("words", w), width).alias("h"),
        )
        .distinct()
        .select(
            "item_id",
            "width",
            "phrases",
            F.xxhash64("phrases").alias("of"),
            F.array_sort(F.array_distinct("h")).alias("h"),
        )
        .withColumn("class", F.expr("cast(floor(log2(size(h))) as int)"))
        .withColumn("k", F.expr(f"cast(floor({1 - threshold:.9f} * (power(2, class + 1) - 1)) as int) + 1"))
    )
    known = written(spark, known, "items")
    sketches = known.select("item_id", "of", F.explode(F.expr("slice(h, 1, k)")).alias("hash"))
    sketches = written(spark, sketches, "item-sketches")

    rows = docs.where("text is not null").select("doc_id", F.xxhash64("text").alias("body"), "text")
    hashed = rows.select("doc_id", "body", _words("text").alias("words"))
    widths = [r.width for r in known.select("width").distinct().collect()] or [width]  # at most the shingle width
    hashes = F.concat(*[_hashes("words", w) for w in widths])
    hashed = hashed.select("doc_id", "body", F.explode(hashes).alias("hash"))
    found = (
        hashed.join(sketches, "hash")
        .groupBy("doc_id", "body")
        .agg(F.collect_set(F.struct("item_id", "of")).alias("found"))
    )
    candidates = written(spark, found, "candidates").select(
        F.col("doc_id").alias("_doc"), F.col("body").alias("_body"), "found"
    )
    wanted = known.select(F.col("item_id").alias("_item"), F.col("of").alias("_of"), "phrases")
    same_item = F.col("item_id").eqNullSafe(F.col("_item")) & (F.col("of") == F.col("_of"))
    same = rows["doc_id"].eqNullSafe(candidates["_doc"]) & (rows["body"] == candidates["_body"])
    checked = (
        rows.join(candidates, same)
        .select("doc_id", "body", "found", _words("text").alias("words"))
        .select("doc_id", "body", "found", F.concat(*[_phrases("words", w) for w in widths]).alias("held"))
        .select("doc_id", "body", "held", F.explode("found").alias("f"))
        .select("doc_id", "body", "held", "f.item_id", "f.of")
        .join(wanted, same_item)
        .select(
            "doc_id",
            "body",
            "item_id",
            F.size(F.array_intersect("phrases", "held")).cast("long").alias("n_shared"),
            F.size("phrases").cast("long").alias("n_shingles"),
        )
        .withColumn("containment", F.col("n_shared") / F.col("n_shingles"))
        .where(F.col("containment") >= threshold)
    )
    best = F.max(F.struct("containment", "n_shared", "n_shingles")).alias("best")
    return (
        checked.groupBy("doc_id", "body", "item_id")
        .agg(best)
        .select("doc_id", "body", "item_id", "best.n_shared", "best.n_shingles", "best.containment")
    )
