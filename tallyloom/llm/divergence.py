"""How far the sources of a language differ in their words, from run-length coded columns of counts.

The kept terms of a language are put in an order that brings equal counts together: by the list of
(source, count) of the term, the largest source first. In that order a source is a column of counts, mostly
long runs of small numbers, and is kept as runs. Two sources are compared by cutting each other's runs at
their boundaries; between two boundaries both counts are constant, so one value of the divergence times
the length of the piece stands for all its terms.

The ordered vocabulary is cut into blocks, and the sources of a language into tiles. A task compares two tiles
over one block, so its memory doesn't follow the vocabulary, the number of sources or a hot source, and
words are added up per task before the first shuffle.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.llm.ship import ship
from tallyloom.llm.written import written

LEAST_DOCUMENTS = 10
TOP_TERMS = 10
UNIT = 1_000_000_000
BLOCK_TERMS = 16_384
TILE_SOURCES = 32
HELD_COUNTS = 400_000  # counters of a task before it hands them on

# Letters and bytes beyond ASCII make terms, A-Z becomes a-z, all else separates.
_TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_TERM_BYTES).split()


def _count(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[bytes, bytes], tuple[Counter, Counter]] = {}

        def handed_on() -> pa.RecordBatch:
            langs, sources, terms, occurrences, documents = [], [], [], [], []
            for (lang, source), (seen, docs) in held.items():
                langs += [lang] * len(seen)
                sources += [source] * len(seen)
                terms += seen.keys()
                occurrences += seen.values()
                documents += [docs[t] for t in seen]
            held.clear()
            names = [pa.array(x, pa.binary()).cast(pa.string()) for x in (langs, sources, terms)]
            return pa.RecordBatch.from_arrays(
                [*names, pa.array(occurrences, pa.int64()), pa.array(documents, pa.int64())],
                names=["lang", "source", "term", "n", "docs"],
            )

        size = 0
        for batch in batches:
            columns = [batch.column(i).cast(pa.binary()).to_pylist() for i in range(3)]
            for lang, source, text in zip(*columns, strict=True):
                seen, docs = held.setdefault((lang, source), (Counter(), Counter()))
                before = len(seen)
                found = Counter(terms_of(text))
                seen.update(found)
                docs.update(found.keys())
                size += len(seen) - before
                if size > most:
                    yield handed_on()
                    size = 0
        if held:
            yield handed_on()

    return run


def column_runs(
    place: np.ndarray, term: np.ndarray, count: np.ndarray
) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Each place with the starts, ends and counts of its runs; what no run covers is zero."""
    order = np.lexsort((term, place))
    place, term, count = place[order], term[order], count[order]
    new = np.ones(len(place), dtype=bool)
    new[1:] = (place[1:] != place[:-1]) | (term[1:] != term[:-1] + 1) | (count[1:] != count[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(place)) - 1
    of = place[first]
    bounds = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
    for low, high in zip(bounds, np.append(bounds[1:], len(of)), strict=True):
        yield int(of[low]), term[first[low:high]], term[last[low:high]] + 1, count[first[low:high]]


def _runs(block_terms: int):
    """Rows (lang, part, held) in order become blocks of runs; a block ends with its language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lang, number, size = None, 0, 0
        block = 0
        places: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        sizes: list[np.ndarray] = []

        def finished() -> Iterator[pa.RecordBatch]:
            term = np.repeat(np.arange(size), np.concatenate(sizes))
            rows = list(column_runs(np.concatenate(places), term, np.concatenate(counts)))
            n = len(rows)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * n),
                    pa.array([block] * n, pa.int64()),
                    pa.array([size] * n, pa.int32()),
                    pa.array([r[0] for r in rows], pa.int32()),
                    pa.array([r[1] for r in rows], pa.list_(pa.int32())),
                    pa.array([r[2] for r in rows], pa.list_(pa.int32())),
                    pa.array([r[3] for r in rows], pa.list_(pa.int64())),
                ],
                names=["lang", "block", "terms", "place", "starts", "ends", "counts"],
            )

        for batch in batches:
            langs = batch.column("lang").to_pylist()
            first = 0
            while first < len(langs):
                if langs[first] != lang or size == block_terms:
                    if size:
                        yield from finished()
                    lang, size, places, counts, sizes = langs[first], 0, [], [], []
                    block = (batch.column("part")[first].as_py() << 32) + number
                    number += 1
                last = first
                while last < len(langs) and langs[last] == lang and size + last - first < block_terms:
                    last += 1
                held = batch.column("held").slice(first, last - first)
                flat = held.flatten()
                places.append(flat.field(0).to_numpy(zero_copy_only=False))
                counts.append(flat.field(1).to_numpy(zero_copy_only=False))
                sizes.append(held.value_lengths().to_numpy(zero_copy_only=False))
                size += last - first
                first = last
        if size:
            yield from finished()

    return run


def shares(counts: np.ndarray, whole: int) -> np.ndarray:
    """1 + floor(UNIT * (count + 2) / whole), exactly: three digits of the quotient at a time."""
    left = counts.astype(np.int64) + 2
    out = np.zeros(len(left), dtype=np.int64)
    for _ in range(3):
        left = left * 1000
        out = out * 1000 + left // whole
        left = left % whole
    return out + 1


def run_sum(one: tuple, two: tuple, zero_one: int, zero_two: int, terms: int) -> int:
    """The divergence of two columns of (starts, ends, shares), each share 'zero' where no run is."""
    cuts = np.unique(np.concatenate(([0, terms], one[0], one[1], two[0], two[1])))
    at = cuts[:-1]
    p, q = (
        _at(starts, ends, values, zero, at)
        for (starts, ends, values), zero in ((one, zero_one), (two, zero_two))
    )
    return int(((p - q) * (p - q) // (p + q) * np.diff(cuts)).sum())


def _at(starts: np.ndarray, ends: np.ndarray, values: np.ndarray, zero: int, at: np.ndarray) -> np.ndarray:
    run = np.searchsorted(starts, at, side="right") - 1
    inside = run >= 0
    inside[inside] = at[inside] < ends[run[inside]]
    out = np.full(len(at), zero, dtype=np.int64)
    out[inside] = values[run[inside]]
    return out


def _compare(tile: int):
    """All pairs of sources of two tiles over one block; a source of the tiles without a row is zero."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        lang, block, left, right = key
        terms = int(rows.terms.iloc[0])
        empty = np.zeros(0, dtype=np.int64)
        whole: dict[int, int] = {}
        for first, wholes in zip(rows.firsts.iloc[0], rows["wholes"].iloc[0], strict=True):
            whole.update(zip(range(first, first + len(wholes)), map(int, wholes), strict=True))
        columns = {place: (empty, empty, empty) for place in whole}
        for r in rows.itertuples():
            columns[r.place] = (
                np.asarray(r.starts, dtype=np.int64),
                np.asarray(r.ends, dtype=np.int64),
                shares(np.asarray(r.counts), whole[r.place]),
            )
        zeros = {place: int(shares(np.zeros(1), n)[0]) for place, n in whole.items()}
        low, high = left * tile, right * tile
        out = []
        for a in range(low, low + tile):
            for b in range(max(a + 1, high), high + tile):
                if a in whole and b in whole:
                    out.append((lang, a, b, run_sum(columns[a], columns[b], zeros[a], zeros[b], terms), terms))
        return pd.DataFrame(out, columns=["lang", "a", "b", "value", "terms"])

    return run


def _share(count: str, whole: str) -> str:
    return (
        f"1 + cast((cast({count} as decimal(19, 0)) + 2) * {UNIT} "
        f"div cast({whole} as decimal(20, 0)) as bigint)"
    )


def audit(
    spark: SparkSession,
    docs: DataFrame,
    least: int = LEAST_DOCUMENTS,
    top: int = TOP_TERMS,
) -> DataFrame:
    """The divergence of every source from the others of its language, and the terms it overuses.

    Rows (lang, source, part, item, value, rank). Part ``pair``: item is another source. Part ``term``: item is
    a term that the source uses more than its language does, the ``top`` first. Ranks go by falling value,
    then by item. A language keeps the terms that ``least`` of its documents have.

    Null lang, source and text count as ''. Rows that are repeated count again, as documents of their own.
    Empty texts have no terms; their group still has its pairs. A language without kept terms has pairs
    of value 0 and no terms. Ties are ranked by item. An empty table gives no rows. Further columns are
    ignored. Counts of a language may be up to 9 * 10^15 words.
    """
    ship(spark)
    plain = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counted = plain.mapInArrow(_count(HELD_COUNTS), "lang string, source string, term string, n long, docs long")
    counted = counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    counted = written(spark, counted, "counted")
    kept = counted.groupBy("lang", "term").agg(F.sum("n").alias("of_lang"), F.sum("docs").alias("docs"))
    kept = written(spark, kept.where(F.col("docs") >= least).drop("docs"), "kept")
    used = written(spark, counted.drop("docs").join(kept, ["lang", "term"]), "used")

    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("of_lang").alias("lang_n"))
    sizes = used.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    groups = (
        plain.select("lang", "source")
        .distinct()
        .join(sizes, ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .na.fill(0, ["n", "v", "lang_n"])
        .withColumn("whole", F.col("n") + 2 * F.col("v"))
        .withColumn("lang_whole", F.col("lang_n") + 2 * F.col("v"))
    )
    ordered = Window.partitionBy("lang").orderBy(F.desc("n"), "source")
    groups = groups.withColumn("place", F.row_number().over(ordered) - 1)
    groups = written(spark, groups.withColumn("tile", F.expr(f"place div {TILE_SOURCES}").cast("int")), "groups")

    terms = (
        used.join(groups.select("lang", "source", "whole", "lang_whole"), ["lang", "source"])
        .withColumn("p", F.expr(_share("n", "whole")))
        .withColumn("q", F.expr(_share("of_lang", "lang_whole")))
        .where("p > q")
        .select("lang", "source", F.col("term").alias("item"), F.expr("(p - q) * (p - q) div (p + q)").alias("value"))
    )
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = terms.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)

    pairs = _pairs(spark, used, groups).withColumn("rank", F.row_number().over(best))
    columns = ("lang", "source", "part", "item", "value", "rank")
    pairs = pairs.withColumn("part", F.lit("pair")).select(*columns)
    return pairs.union(terms.withColumn("part", F.lit("term")).select(*columns))


def _pairs(spark: SparkSession, used: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) for each two sources of a language."""
    held = (
        used.join(groups.select("lang", "source", "place"), ["lang", "source"])
        .groupBy("lang", "term")
        .agg(F.sort_array(F.collect_list(F.struct("place", "n"))).alias("held"))
        .repartitionByRange("lang", "held", "term")
        .sortWithinPartitions("lang", "held", "term")
        .select("lang", F.spark_partition_id().alias("part"), "held")
    )
    runs = held.mapInArrow(
        _runs(BLOCK_TERMS),
        "lang string, block long, terms int, place int, starts array<int>, ends array<int>, counts array<long>",
    )
    runs = written(spark, runs, "runs").withColumn("tile", F.expr(f"place div {TILE_SOURCES}").cast("int"))

    tiles = (
        groups.groupBy("lang", "tile")
        .agg(F.sort_array(F.collect_list(F.struct("place", "whole"))).alias("w"))
        .select("lang", "tile", F.expr("w.whole").alias("wholes"), F.expr("w[0].place").alias("first"))
    )
    last = groups.groupBy("lang").agg(F.max("tile").alias("last"))
    partners = F.explode(F.sequence(F.lit(0), F.col("last"))).alias("other")
    met = tiles.join(last, "lang").select("lang", "tile", "wholes", "first", partners)
    other = tiles.select(
        "lang", F.col("tile").alias("other"), F.col("wholes").alias("wholes_2"), F.col("first").alias("first_2")
    )
    met = met.join(other, ["lang", "other"]).select(
        "lang",
        "tile",
        F.least("tile", "other").alias("left"),
        F.greatest("tile", "other").alias("right"),
        F.array("first", "first_2").alias("firsts"),
        F.array("wholes", "wholes_2").alias("wholes"),
    )
    sides = runs.join(met, ["lang", "tile"]).drop("tile")
    found = sides.groupBy("lang", "block", "left", "right").applyInPandas(
        _compare(TILE_SOURCES), "lang string, a int, b int, value long, terms int"
    )
    found = found.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("terms").alias("terms"))

    mine = groups.join(last, "lang").select("lang", "source", "place", "whole", "v", "tile", partners)
    theirs = groups.join(last, "lang").select(
        "lang",
        F.col("source").alias("item"),
        F.col("place").alias("place_2"),
        F.col("whole").alias("whole_2"),
        F.col("tile").alias("other"),
        F.explode(F.sequence(F.lit(0), F.col("last"))).alias("tile"),
    )
    both = mine.join(theirs, ["lang", "tile", "other"]).where("place <> place_2")
    both = both.withColumns({"a": F.least("place", "place_2"), "b": F.greatest("place", "place_2")})
    # Blocks in which neither tile has a run hold no row: there both counts are 0.
    rest = F.expr("v - coalesce(terms, 0)")
    p, q = (F.expr(f"case when v > 0 then {_share('0', whole)} end") for whole in ("whole", "whole_2"))
    return (
        both.join(found, ["lang", "a", "b"], "left")
        .withColumns({"p": p, "q": q, "rest": rest})
        .select(
            "lang",
            "source",
            "item",
            F.expr("coalesce(value, 0) + if(rest > 0, rest * ((p - q) * (p - q) div (p + q)), 0)").alias("value"),
        )
    )
