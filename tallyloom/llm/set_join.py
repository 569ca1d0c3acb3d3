"""Similarity join of shingle sets with adaptive multi-match prefixes, and the classes its links make.

Two sets that must share o shingles share at least k of them within the prefixes that leave out the last
o - k shingles of each, in any common order. Rare shingles come first. A longer prefix has longer lists
to meet, but asks for k matches, so fewer pairs are verified; each document takes the k whose estimated
cost, of list entries met and of candidates verified, is least. Links are judged by exact intersection.

Three steps keep the work near the size of the input:

1. Equal sets are one node. A node is closed if more of its shingles are its own than a link may miss. A share
   of the shingle space, the same for all documents, is enough to prove that for most; only open nodes
   are looked at in whole.
2. In each list of nodes that share a prefix shingle, the member with the least of its own meets all others.
   That is linear in the lists and makes groups of copies one class.
3. Shingles that one class alone holds can't make another link. By what is left, nodes are closed again, and the
   rest meet under multi-match prefixes, in different classes only. No list is capped. In long lists, which are of
   families around one text, nodes meet by what tells them from a pivot, the member with the most usual shingles:
   what two nodes differ in is what each differs in from the pivot but for what these have in common, and nodes
   that link with the pivot need no other link. So members of a family that miss the threshold by little
   meet under what few of them have changed, not under what all of them hold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import arrays as a
from tallyloom.llm.components import components
from tallyloom.llm.ship import ship
from tallyloom.llm.written import written

SHINGLE_WORDS = 4
SHARED, OF_UNION = 85, 100  # a link: OF_UNION * intersection >= SHARED * union
MOST_MATCHES = 6
VERIFY_COST = 0.1  # of comparing a shingle, in list entries met
SIZE_STEP = 1.04  # sizes of a class are within this factor
LONG_LIST = 64  # longer lists meet by differences from a pivot
PROOF_SHARE = 0.3  # of the shingle space that the first step looks at

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles and the document of each, ascending; all words if fewer than the width."""
    data = _LOWER[data]
    starts, ends, first = a.word_bounds(data, offsets)
    words = a.Prefix(a.word_hashes(data, starts, ends))
    at, owner = a.within(first, width)
    counts = np.diff(first)
    short = np.flatnonzero((counts > 0) & (counts < width))
    hashes = np.concatenate((words.spans(at, at + width), words.spans(first[short], first[short + 1])))
    owner = np.concatenate((owner, short))
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[new], owner[new]


def _lists(values: np.ndarray, owner: np.ndarray, rows: int) -> pa.ListArray:
    ends = np.cumsum(np.bincount(owner, minlength=rows))
    return pa.ListArray.from_arrays(
        pa.array(np.concatenate(([0], ends)).astype(np.int32)), pa.array(a.signed(values))
    )


def _digests(hashes: np.ndarray, owner: np.ndarray, rows: int) -> list[pa.Array]:
    """Two hashes of each set, from wrapping sums of its members' hashes; null for an empty set."""
    bounds = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=rows))))
    out = []
    for salt in (3, 5):
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(a.mix(hashes, salt), dtype=np.uint64)))
        with np.errstate(over="ignore"):
            whole = a.mix(sums[bounds[1:]] - sums[bounds[:-1]], salt + 1)
        out.append(pa.array(a.signed(whole), mask=bounds[1:] == bounds[:-1]))
    return out


def _sketch(width: int, share: float):
    limit = np.uint64(int(share * 2.0**64)) if share < 1 else np.uint64(2**64 - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in a.pieces(batches):
            hashes, owner = shingle_sets(data, offsets, width)
            size = np.bincount(owner, minlength=batch.num_rows)
            some = hashes <= limit
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:2],
                    *_digests(hashes, owner, batch.num_rows),
                    pa.array(size),
                    _lists(hashes[some], owner[some], batch.num_rows),
                ],
                names=["doc_id", "body", "one", "two", "n", "some"],
            )

    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in a.pieces(batches):
            hashes, owner = shingle_sets(data, offsets, width)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), _lists(hashes, owner, batch.num_rows)], names=["node", "shingles"]
            )

    return run


def _least_shared(size: str) -> str:
    """Shingles that a set shares with any partner that it links with."""
    return f"(({SHARED} * {size} + {OF_UNION - 1}) div {OF_UNION})"


def _least_shared_with_larger(size: str) -> str:
    whole = SHARED + OF_UNION
    return f"(({2 * SHARED} * {size} + {whole - 1}) div {whole})"


def _fits(one: str, two: str) -> Column:
    return F.expr(f"{OF_UNION} * least({one}, {two}) >= {SHARED} * greatest({one}, {two})")


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    left = sets.select(F.col("node").alias("one"), F.col("shingles").alias("mine"))
    right = sets.select(F.col("node").alias("two"), F.col("shingles").alias("other"))
    met = pairs.join(right, "two").join(left, "one")
    met = met.withColumn("c", F.size(F.array_intersect("mine", "other")))
    union = "(size(mine) + size(other) - c)"
    return met.where(f"{OF_UNION} * c >= {SHARED} * {union}").select("one", "two")


def _ordered(each: DataFrame, held: DataFrame) -> DataFrame:
    """(node, n, label, e, rare): the shingles of ``held`` in each node, rare ones first, e of them."""
    listed = (
        each.join(held, "s")
        .groupBy("node", "n", "label")
        .agg(F.sort_array(F.collect_list(F.struct("held", "s"))).alias("rare"))
    )
    return listed.withColumn("e", F.size("rare"))


def _star_pairs(rare: DataFrame, spark: SparkSession) -> DataFrame:
    """In each list of nodes under a prefix shingle, the node with the least of its own, and each other."""
    prefix = F.expr(f"slice(rare, 1, e - {_least_shared('n')} + 1)")
    lists = rare.where(f"e >= {_least_shared('n')}").select(
        "node", "n", ((F.col("n") - F.col("e")) / F.col("n")).alias("own"), F.explode(prefix).alias("r")
    )
    lists = written(spark, lists.select("node", "n", "own", F.col("r.s").alias("s")), "lists")
    central = lists.groupBy("s").agg(
        F.min(F.struct("own", "node", "n")).alias("p"), F.count("*").alias("members")
    )
    central = central.where("members > 1").select(
        "s", F.col("p.node").alias("one"), F.col("p.n").alias("one_n")
    )
    met = lists.join(central, "s").where((F.col("node") != F.col("one")) & _fits("n", "one_n"))
    return met.select("one", F.col("node").alias("two")).distinct()


def _size_class(size: str) -> str:
    return f"cast(floor(ln({size}) / ln({SIZE_STEP})) as int)"


def _prefixes(rare: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """Rows (s, node, n, label, e, at) of what each node asks for as the larger, and is listed under as the smaller.

    A listed row has the ``level``, the least number of matches whose prefix has the shingle.
    """
    least, least_small = _least_shared("n"), _least_shared_with_larger("n")
    asked = rare.where(f"e >= {least}").withColumn("prefix", F.expr(f"slice(rare, 1, cast(e - {least} + {most} as int))"))
    listed = rare.where(f"e >= {least_small}").withColumn(
        "prefix", F.expr(f"slice(rare, 1, cast(e - {least_small} + {most} as int))")
    )
    asked, listed = (
        side.select("node", "n", "label", "e", F.posexplode("prefix").alias("at", "r")).select(
            F.col("r.s").alias("s"), "node", "n", "label", "e", "at"
        )
        for side in (asked, listed)
    )
    return asked, listed.withColumn("level", F.expr(f"cast(greatest(1, at + 1 - e + {least_small}) as int)"))


def with_matches(asked: DataFrame, listed: DataFrame, most: int, verify: float = VERIFY_COST) -> DataFrame:
    """(node, matches): the number of shared prefix shingles at which the node's cost estimate is least.

    For k matches the node meets the lists of its prefix, as long as they are for k matches; no more than a
    k-th of their entries can be candidates, each of which costs a comparison of two sets. The prefix
    is taken for partners of the node's own size, which most are.
    """
    levels = range(1, most + 1)
    lengths = listed.groupBy("s").agg(*[F.expr(f"count_if(level <= {k})").alias(f"l{k}") for k in levels])
    same_size = _least_shared_with_larger("n")
    met = [F.expr(f"sum(if(at < e - {same_size} + {k}, coalesce(l{k}, 0L), 0L))").alias(f"m{k}") for k in levels]
    costs = [f"struct(if({k} <= {_least_shared('n')}, m{k} * (1 + {verify!r} * n / {k}), null) as cost, {k} as k)" for k in levels]
    possible = f"filter(array({', '.join(costs)}), c -> c.cost is not null)"
    return asked.join(lengths, "s", "left").groupBy("node", "n").agg(*met).select(
        "node", F.expr(f"array_min({possible}).k").alias("matches")
    )


def long_lists(rare: DataFrame, most: int) -> DataFrame:
    """(s, pivot): lists with more than LONG_LIST nodes, and of each the node with the most usual shingles."""
    asked, _ = _prefixes(rare, most)
    usual = rare.selectExpr("node", "aggregate(rare, 0L, (a, r) -> a + r.held) / n as usual")
    listed = asked.join(usual, "node").groupBy("s")
    listed = listed.agg(F.count("*").alias("members"), F.max(F.struct("usual", "node")).alias("p"))
    return listed.where(f"members > {LONG_LIST}").select("s", F.col("p.node").alias("pivot"))


def differences(rare: DataFrame, lists: DataFrame, sets: DataFrame, most: int) -> DataFrame:
    """(pivot, node, label, n, pivot_n, d, apart): the ``d`` shingles that one of a node and a pivot of its lists has."""
    asked, _ = _prefixes(rare, most)
    pairs = asked.join(lists, "s").select("pivot", "node", "label").distinct()
    left = sets.select("node", F.col("shingles").alias("mine"))
    right = sets.select(F.col("node").alias("pivot"), F.col("shingles").alias("other"))
    met = pairs.join(right, "pivot").join(left, "node")
    apart = F.concat(F.array_except("mine", "other"), F.array_except("other", "mine"))
    met = met.withColumn("apart", apart)
    return met.selectExpr(
        "pivot", "node", "label", "size(mine) as n", "size(other) as pivot_n", "size(apart) as d", "apart"
    )


def near_pivots(apart: DataFrame) -> DataFrame:
    """Links (one, two) of pivots with their nodes, by the number of shingles that they differ in."""
    linked = f"{SHARED + OF_UNION} * d <= {OF_UNION - SHARED} * (n + pivot_n) and node <> pivot"
    return apart.where(linked).select(F.col("pivot").alias("one"), F.col("node").alias("two"))


def around_pivots(apart: DataFrame) -> DataFrame:
    """Rows (one, two) of nodes of different labels that share so many differences from a pivot that they may link.

    Sets differ in d + d_2 - 2 * c shingles if c of their differences from the pivot are the same. One of the two,
    which asks, does not link with the pivot, or the pivot links both; so c is at least 1. Rare differences come
    first, and both have one of the c in their prefix. Differences that no other node of the pivot has count in d only.
    """
    both, gap = SHARED + OF_UNION, OF_UNION - SHARED
    each = apart.select("pivot", "node", F.explode("apart").alias("s"))
    held = each.groupBy("pivot", "s").agg(F.count("*").alias("held")).where("held > 1")
    rare = each.join(held, ["pivot", "s"]).groupBy("pivot", "node")
    rare = rare.agg(F.sort_array(F.collect_list(F.struct("held", "s"))).alias("rare"))
    rare = apart.drop("apart").join(rare, ["pivot", "node"]).withColumn("e", F.size("rare"))

    def prefix(of: DataFrame, least: str) -> DataFrame:
        of = of.withColumn("prefix", F.expr(f"slice(rare, 1, cast(greatest(0, e - {least} + 1) as int))"))
        of = of.select("pivot", "node", "label", "n", "d", "e", "outside", F.posexplode("prefix").alias("at", "r"))
        return of.withColumn("s", F.col("r.s")).drop("r")

    rare = rare.withColumn("outside", F.expr(f"{both} * d > {gap} * (n + pivot_n)"))
    # the least c with any partner outside, and of a node outside with any partner
    listed = prefix(rare, f"(({both} * d + {gap} * (pivot_n - n) + {2 * both}) div {2 * both})")
    asking = prefix(rare.where("outside"), f"(({both} * d - {gap} * (n + pivot_n) + {2 * both - 1}) div {2 * both})")
    listed = listed.withColumnsRenamed({name: f"{name}_2" for name in ("node", "label", "n", "d", "e", "at", "outside")})
    shared = f"(({both} * (d + d_2) - {gap} * (n + n_2) + {2 * both - 1}) div {2 * both})"
    near = (
        f"label <> label_2 and (node < node_2 or not outside_2) and at <= e - {shared} and at_2 <= e_2 - {shared}"
    )
    met = asking.join(listed, ["pivot", "s"]).where(_fits("n", "n_2") & F.expr(near))
    return met.select(F.least("node", "node_2").alias("one"), F.greatest("node", "node_2").alias("two"))


def candidates(rare: DataFrame, most: int = MOST_MATCHES, without: DataFrame | None = None) -> DataFrame:
    """Pairs (one, two) of different labels that share as many prefix shingles as the larger one asks for.

    Pairs that share a prefix shingle of ``without`` (s) are not looked for; it is left out of all lists.

    The larger node of a pair, by (n, node), decides. Lists are cut by the partner's class of size and by
    level: a node asks a list only as far as its prefix for partners of that size reaches, and for no
    more matches than it wants. What the counted shingles and the rest after the last of them can't make up
    to a link is no candidate either.
    """
    asked, listed = _prefixes(rare, most)
    if without is not None:
        asked, listed = (side.join(without, "s", "left_anti") for side in (asked, listed))
    both = SHARED + OF_UNION
    chosen = asked.join(with_matches(asked, listed, most), "node")
    smallest = f"greatest({_least_shared('n')}, cast(floor(pow({SIZE_STEP}, size_class)) as int))"
    reaches = f"at < e - (({SHARED} * (n + {smallest}) + {both - 1}) div {both}) + matches"
    asking = (
        chosen.withColumn(
            "size_class", F.explode(F.expr(f"sequence({_size_class(_least_shared('n'))}, {_size_class('n')})"))
        )
        .where(reaches)
        .withColumn("level", F.explode(F.expr("sequence(1, matches)")))
    )
    listing = listed.withColumn("size_class", F.expr(_size_class("n"))).withColumnsRenamed(
        {name: f"{name}_2" for name in ("node", "n", "label", "e", "at")}
    )
    shared = f"(({SHARED} * (n + n_2) + {both - 1}) div {both})"
    near = (
        f"(n_2 < n or (n_2 = n and node_2 < node)) and label <> label_2 and least(e, e_2) >= {shared}"
        f" and at < e - {shared} + matches and at_2 < e_2 - {shared} + matches"
    )
    met = asking.join(listing, ["s", "size_class", "level"]).where(_fits("n", "n_2") & F.expr(near))
    counted = met.groupBy("node", "node_2", "n", "n_2", "matches").agg(
        F.count("*").alias("c"), F.max(F.expr("at - e")).alias("last"), F.max(F.expr("at_2 - e_2")).alias("last_2")
    )
    reach = f"{both} * (c - 1 - greatest(last, last_2)) >= {SHARED} * (n + n_2)"
    return counted.where(f"c >= matches and {reach}").select(
        F.col("node").alias("one"), F.col("node_2").alias("two")
    )


def classes(
    spark: SparkSession,
    docs: DataFrame,
    width: int = SHINGLE_WORDS,
    most: int = MOST_MATCHES,
    share: float = PROOF_SHARE,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id.

    Links hold between documents with 100 * intersection >= 85 * union of their shingle sets; component_id is the
    smallest doc_id that links reach. Null texts and texts without words have empty sets, which link with
    nothing: their component is their own doc_id. Texts with fewer words than the width are one shingle.
    Rows that share a doc_id each get the class of their own text. Rows without a doc_id link as others do; a
    class of only such rows has a null component_id. An empty table gives no rows; further columns are
    ignored. Shingles are told apart by 64-bit hashes and sets by two of them.
    """
    ship(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()
    text = F.coalesce("text", F.lit(""))
    bodies = docs.select("doc_id", F.xxhash64(text).alias("body"), "text")
    sketches = bodies.mapInArrow(
        _sketch(width, share),
        f"doc_id {kind}, body long, one long, two long, n long, some array<long>",
    )
    sketches = written(spark, sketches, "sketches")
    nodes = sketches.where("n > 0").groupBy("one", "two", "n").agg(
        F.min("doc_id").alias("first"),
        F.min("body").alias("body"),
        F.min_by("doc_id", "body").alias("holder"),
    )

    own = sketches.select("one", F.explode("some").alias("s")).groupBy("s")
    own = own.agg(F.min("one").alias("one"), F.max("one").alias("other")).where("one = other")
    own = own.groupBy("one").agg(F.count("*").alias("own"))
    nodes = nodes.join(own, "one", "left").withColumn("own", F.coalesce("own", F.lit(0)))
    nodes = written(spark, nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")

    opened = nodes.where(f"own <= n - {_least_shared('n')}").select(
        "node", F.col("holder").alias("holder"), F.col("body").alias("held_body")
    )
    same = bodies["doc_id"].eqNullSafe(opened["holder"]) & (bodies["body"] == opened["held_body"])
    texts = bodies.join(opened, same).select("node", "text").dropDuplicates(["node"])
    sets = texts.mapInArrow(_sets(width), "node long, shingles array<long>")
    sets = written(spark, sets, "sets")

    each = sets.select("node", F.size("shingles").alias("n"), F.explode("shingles").alias("s"))
    held = each.groupBy("s").agg(F.count("*").alias("held")).where("held > 1")
    rare = _ordered(each.withColumn("label", F.col("node")), held)
    rare = written(spark, rare, "rare")
    stars = written(spark, _star_pairs(rare, spark), "stars")
    links = written(spark, _linked(stars, sets), "links")
    labels = components(spark, links)

    left = rare.drop("label").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    left = left.select("node", "n", "label", F.explode("rare.s").alias("s"))
    left = written(spark, left, "left")
    spread = left.groupBy("s").agg(
        F.count("*").alias("held"), F.min("label").alias("low"), F.max("label").alias("high")
    )
    rare = _ordered(left, spread.where("low < high").select("s", "held"))
    rare = written(spark, rare.where(f"e >= {_least_shared('n')}"), "rare")
    lists = written(spark, long_lists(rare, most), "long-lists")
    more = _linked(candidates(rare, most, lists), sets)
    if not lists.limit(1).isEmpty():
        apart = written(spark, differences(rare, lists, sets, most), "apart")
        around = written(spark, around_pivots(apart), "around")
        more = more.union(near_pivots(apart)).union(_linked(around.distinct(), sets))
    more = written(spark, more, "links")
    if not more.limit(1).isEmpty():
        labels = components(spark, links.union(more))

    classed = nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    classed = written(spark, classed.select("one", "two", "first", "label"), "classed")
    ids = classed.groupBy("label").agg(F.min("first").alias("component_id"))
    of_set = classed.join(ids, "label").select("one", "two", "component_id")
    found = sketches.select("doc_id", "one", "two", "n").join(of_set, ["one", "two"], "left")
    return found.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )
