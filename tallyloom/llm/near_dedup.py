"""Near-duplicate classes by ProbMinHash over weighted shingles, banding and exact verification.

A shingle is five words, its weight the number of its occurrences in the document. Every shingle runs a
Poisson process whose rate is its weight; each arrival goes to one register of the document, which keeps
the earliest. A process ends as soon as it is later than every register, so the work follows the number
of shingles, not shingles times registers. Two registers agree with the probability Jaccard of the
weighted shingles. Links are judged by sets, so a document of uneven weights has a second set of registers
with equal weights, which agree with the Jaccard of the sets; with even weights both are the same.

Texts that are equal form one node first. Bands of equal registers form buckets. In each bucket the
member that shares most buckets overall is compared with all others, which is linear in bucket sizes and
joins a hot group of copies in one step. Where the others of a bucket still are of several classes, they
meet again under their rarest shingles (a prefix filter, exact for the threshold), and only pairs from
different classes are compared. Links are judged by the exact Jaccard of the shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.llm import arrays as a
from tallyloom.llm.components import components
from tallyloom.llm.ship import ship
from tallyloom.llm.written import written

SHINGLE_WORDS = 5
THRESHOLD = 0.8
BANDS = 28
ROWS = 4


def shingles(
    data: np.ndarray, offsets: np.ndarray, width: int = SHINGLE_WORDS
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes, their documents (ascending) and their counts.

    A document of fewer words than the width has one shingle, all its words; one without words none.
    """
    starts, ends, first = a.word_bounds(data, offsets)
    words = a.Prefix(a.word_hashes(data, starts, ends))
    at, owner = a.within(first, width)
    counts = np.diff(first)
    short = np.flatnonzero((counts > 0) & (counts < width))
    hashes = np.concatenate(
        (words.spans(at, at + width), words.spans(first[short], first[short + 1]))
    )
    owner = np.concatenate((owner, short))
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    if not len(hashes):
        return hashes, owner, owner
    new = np.flatnonzero(
        np.concatenate(([True], (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])))
    )
    return hashes[new], owner[new], np.diff(np.concatenate((new, [len(hashes)])))


def signatures(
    hashes: np.ndarray, owner: np.ndarray, weights: np.ndarray, documents: int, registers: int
) -> np.ndarray:
    """The shingle that arrives first in each register of each document."""
    time = np.full(documents * registers, np.inf)
    first = np.zeros(documents * registers, dtype=np.uint64)
    live = np.arange(len(hashes))
    clock = np.zeros(len(hashes))
    turn = 0
    while len(live):
        ahead = 1 if len(live) > 4096 else 8
        now = clock[live]
        own = owner[live] * registers
        for _ in range(ahead):
            drawn = a.mix(hashes[live], turn)
            turn += 1
            uniform = ((drawn >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
            now = now - np.log(uniform) / weights[live]
            slot = own + (a.mix(drawn, 7) % np.uint64(registers)).astype(np.int64)
            better = now < time[slot]
            place, when = slot[better], now[better]
            np.minimum.at(time, place, when)
            won = time[place] == when
            first[place[won]] = hashes[live][better][won]
        clock[live] = now
        latest = time.reshape(documents, registers).max(axis=1)
        live = live[now < latest[owner[live]]]
    return first.reshape(documents, registers)


def _keys(
    hashes: np.ndarray, owner: np.ndarray, weights: np.ndarray, documents: int, bands: int, rows: int
) -> np.ndarray:
    """The key of each band of each document's registers."""
    chosen = signatures(hashes, owner, weights, documents, bands * rows)
    keys = np.zeros((documents, bands), dtype=np.uint64)
    for band in range(bands):
        key = np.full(documents, band, dtype=np.uint64)
        for row in range(rows):
            key = a.mix(key ^ chosen[:, band * rows + row], row + 1)
        keys[:, band] = key
    return keys


def _sketch(width: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in a.pieces(batches):
            hashes, owner, counts = shingles(data, offsets, width)
            size = np.bincount(owner, minlength=batch.num_rows)
            some = np.flatnonzero(size)
            dense = np.zeros(batch.num_rows, dtype=np.int64)
            dense[some] = np.arange(len(some))
            own = dense[owner]
            least = np.full(len(some), np.iinfo(np.int64).max)
            np.minimum.at(least, own, counts)
            most = np.zeros(len(some), dtype=np.int64)
            np.maximum.at(most, own, counts)
            uneven = np.flatnonzero(least < most)
            again = np.zeros(len(some), dtype=np.int64)
            again[uneven] = np.arange(len(uneven))
            of_uneven = (least < most)[own]
            equal = _keys(hashes, own, np.ones(len(own)), len(some), bands, rows)
            weighted = _keys(
                hashes[of_uneven], again[own[of_uneven]], counts[of_uneven], len(uneven), bands, rows
            )
            keys = np.concatenate((equal.reshape(-1), weighted.reshape(-1)))
            of = np.concatenate((np.repeat(some, bands), np.repeat(some[uneven], bands)))
            keys = keys[np.argsort(of, kind="stable")]
            ends = np.cumsum(np.bincount(of, minlength=batch.num_rows))
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate(([0], ends)).astype(np.int32)),
                pa.array(a.signed(keys)),
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(size), lists],
                names=["doc_id", "one", "two", "size", "bands"],
            )

    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in a.pieces(batches):
            hashes, owner, _ = shingles(data, offsets, width)
            ends = np.cumsum(np.bincount(owner, minlength=batch.num_rows))
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate(([0], ends)).astype(np.int32)), pa.array(a.signed(hashes))
            )
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["node", "shingles"])

    return run


def _linked(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs (one, two) whose shingle sets have at least the threshold's Jaccard."""
    left = sets.select(F.col("node").alias("one"), F.col("shingles").alias("mine"))
    right = sets.select(F.col("node").alias("two"), F.col("shingles").alias("other"))
    common = F.size(F.array_intersect("mine", "other"))
    return (
        pairs.join(right, "two")
        .join(left, "one")
        .select("one", "two", F.size("mine").alias("n"), F.size("other").alias("k"), common.alias("c"))
        .where(F.col("c") >= threshold * (F.col("n") + F.col("k") - F.col("c")))
        .select("one", "two")
    )


def near_duplicates(
    spark: SparkSession,
    docs: DataFrame,
    width: int = SHINGLE_WORDS,
    threshold: float = THRESHOLD,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """One row per document: doc_id, body, same_as (smallest doc_id of its text), class_id and class_body.

    Classes are the connected components of links between texts; the smallest doc_id of a class, and of its
    texts the smallest hash, stand for it as class_id and class_body. ``body`` is the hash of the row's text.
    Null texts count as empty; texts without words are alike only if equal. Rows that share a doc_id are
    classed each by its own text. Rows without a doc_id are given back with nulls and link nothing.
    An empty table gives no rows; further columns are ignored.
    """
    ship(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()
    text = F.coalesce("text", F.lit(""))
    hashed = docs.select(
        "doc_id", F.xxhash64(text).alias("one"), F.xxhash64(F.lit(1), text).alias("two"), "text"
    )
    sketches = hashed.mapInArrow(
        _sketch(width, bands, rows),
        f"doc_id {kind}, one long, two long, size long, bands array<long>",
    )
    sketches = written(spark, sketches, "sketches")
    texts = sketches.groupBy("one", "two").agg(F.min("doc_id").alias("same_as"))
    texts = written(spark, texts.where("same_as is not null"), "texts")
    of_texts = sketches.where("doc_id is not null").join(texts, ["one", "two"]).where("doc_id = same_as")
    node = F.struct(F.col("doc_id").alias("id"), F.col("one").alias("body")).alias("node")
    of_texts = of_texts.select(node, "size", "bands").dropDuplicates(["node", "bands"])

    banded = of_texts.select("node", "size", F.explode(F.array_distinct("bands")).alias("band"))
    sizes = banded.groupBy("band").agg(F.count("*").alias("members")).where("members > 1")
    buckets = written(spark, banded.join(written(spark, sizes, "sizes"), "band"), "buckets")

    central = buckets.groupBy("node").agg(F.sum("members").alias("weight"))
    ranked = buckets.join(central, "node")
    first = F.min(F.struct((-F.col("weight")).alias("lighter"), "node", "size"))
    pivots = ranked.groupBy("band").agg(first.alias("p"))
    pivots = pivots.select("band", F.col("p.node").alias("one"), F.col("p.size").alias("pivot_size"))
    pivots = written(spark, pivots, "pivots")
    fits = F.least("size", "pivot_size") >= threshold * F.greatest("size", "pivot_size")
    stars = (
        buckets.join(pivots, "band")
        .where(fits & (F.col("node") != F.col("one")))
        .select("one", F.col("node").alias("two"))
        .distinct()
    )

    members = central.select("node")
    sets = (
        hashed.where("doc_id is not null")
        .select(node, "text")
        .join(members, "node")
        .mapInArrow(_sets(width), f"node struct<id: {kind}, body: long>, shingles array<long>")
    )
    sets = written(spark, sets, "sets")
    links = written(spark, _linked(stars, sets, threshold), "links")
    labels = components(spark, links)

    label = F.xxhash64(F.coalesce("label", "node")).alias("label")  # only told apart from here on
    labelled = buckets.join(labels, "node", "left").select("band", "node", label)
    untried = labelled.join(pivots, "band").where("node <> one")  # pivots have met all the others
    mixed = (
        untried.groupBy("band")
        .agg(F.min("label").alias("low"), F.max("label").alias("high"))
        .where("low < high")
        .select("band")
    )
    open_docs = untried.join(mixed, "band").select("node", "label").distinct()
    open_docs = written(spark, open_docs, "open")
    pairs = _rare_pairs(spark, open_docs, sets, threshold)
    more = written(spark, _linked(pairs, sets, threshold), "links")
    if not more.limit(1).isEmpty():
        labels = components(spark, links.union(more))
    of_text = F.struct(F.col("same_as").alias("id"), F.col("one").alias("body"))
    known = F.col("doc_id").isNotNull()
    return (
        sketches.select("doc_id", "one", "two")
        .join(texts, ["one", "two"], "left")
        .withColumn("node", of_text)
        .join(labels, "node", "left")
        .withColumn("label", F.coalesce("label", "node"))
        .select(
            "doc_id",
            F.col("one").alias("body"),
            F.when(known, F.col("same_as")).alias("same_as"),
            F.when(known, F.col("label.id")).alias("class_id"),
            F.when(known, F.col("label.body")).alias("class_body"),
        )
    )


def _rare_pairs(
    spark: SparkSession, open_docs: DataFrame, sets: DataFrame, threshold: float
) -> DataFrame:
    """Pairs of different classes that can reach the threshold and share one of their rarest shingles.

    Two sets of sizes n and k reach a Jaccard of t if they share at least t / (1 + t) * (n + k) shingles.
    Only shingles that several classes hold can be shared by such a pair; let a document have e of
    them, ordered from rare to frequent. For partners of at least l shingles it needs c of these, so one of the
    first e - c + 1 is shared, or there is no partner if c is more than e. Sizes fall into classes
    of a few percent, each with its own l. No pair that reaches the threshold is lost.
    """
    each = sets.join(open_docs, "node").select(
        "node", "label", F.size("shingles").alias("size"), F.explode("shingles").alias("s")
    )
    each = written(spark, each, "shingles")
    spread = each.groupBy("s").agg(
        F.count("*").alias("held"), F.min("label").alias("low"), F.max("label").alias("high")
    )
    spread = written(spark, spread.where("low < high").select("s", "held"), "spread")
    whole = Window.partitionBy("node")
    share = threshold / (1 + threshold)
    step = 1.04
    needed = f"ceil({share!r} * (size + greatest({threshold!r} * size, floor(pow({step}, k)))) - 1e-6)"
    partners = F.expr(
        f"filter(sequence(cast(floor(ln({threshold!r} * size) / ln({step}) - 1e-9) as int),"
        f" cast(floor(ln(size / {threshold!r}) / ln({step}) + 1e-9) as int)),"
        f" k -> place <= e - {needed} + 1)"
    )
    rare = (
        each.join(spread, "s")
        .withColumn("e", F.count("*").over(whole))
        .where(F.col("e") >= threshold * F.col("size") - 1e-6)
        .withColumn("place", F.row_number().over(whole.orderBy("held", "s")))
        .withColumn("own", F.expr(f"cast(floor(ln(size) / ln({step})) as int)"))
        .select("s", "node", "label", "size", "own", F.explode(partners).alias("partner"))
    )
    rare = written(spark, rare, "rare")
    other = rare.select(
        "s",
        F.col("own").alias("partner"),
        F.col("partner").alias("own"),
        *[F.col(c).alias(f"{c}_2") for c in ("node", "label", "size")],
    )
    near = F.least("size", "size_2") >= threshold * F.greatest("size", "size_2")
    return (
        rare.join(other, ["s", "own", "partner"])
        .where((F.col("node") < F.col("node_2")) & (F.col("label") != F.col("label_2")) & near)
        .select(F.col("node").alias("one"), F.col("node_2").alias("two"))
        .distinct()
    )
