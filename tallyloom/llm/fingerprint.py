"""Document fingerprints by content-defined chunking.

A gear hash of the last 16 bytes proposes chunk ends. Chunking is normalised: up to the usual size only
a strict pattern ends a chunk, beyond it a loose one does, so that sizes stay close together. No hash
looks further back than a chunk is long, hence an edit moves only the chunks around it. A fingerprint
is the set of chunk digests with their lengths; the likeness of two texts is the share of the first
one's length whose chunks the second has, too (containment).

The neighbour of a document is the next smaller doc_id. Documents are dealt to ranges of doc_id whose
bounds are quantiles; each range also gets the first document of the following one, and is read in order.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import arrays as a
from tallyloom.llm.ship import ship

LEAST, USUAL, MOST = 16, 32, 192  # bytes; the gear hash spans as many bytes as LEAST
STRICT_BITS, LOOSE_BITS = 6, 3
ROWS_PER_RANGE = 1_000
RANGES_PER_TASK = 8  # ranges are dealt to tasks by hash; several to a task even out
MOST_RANGES = 20_000

_GEAR = (a.mix(np.arange(256, dtype=np.uint64), 11) >> np.uint64(48)).astype(np.uint16)


def chunk_ends(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Ends of all chunks; every end of a document that isn't empty is one."""
    gear = _GEAR[data]
    step = 1
    while step < LEAST:
        older = np.zeros_like(gear)
        older[step:] = gear[:-step] << np.uint16(step)
        gear = gear + older
        step *= 2
    loose = np.flatnonzero(gear < (1 << (16 - LOOSE_BITS))) + 1
    strict = (loose[gear[loose - 1] < (1 << (16 - STRICT_BITS))]).tolist()
    loose = loose.tolist()
    ends: list[int] = []
    of_strict = of_loose = 0
    for begin, end in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        at = begin
        while end - at > LEAST:
            of_strict = bisect_right(strict, at + LEAST, of_strict)
            cut = strict[of_strict] if of_strict < len(strict) else end
            if cut > at + USUAL:
                of_loose = bisect_right(loose, at + USUAL, of_loose)
                cut = loose[of_loose] if of_loose < len(loose) else end
            at = min(cut, at + MOST, end)
            ends.append(at)
        if at < end:
            ends.append(end)
    return np.array(ends, dtype=np.int64)


def fingerprints(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """For each document the sorted set of its chunks as 48 bits of digest and 16 of length."""
    ends = chunk_ends(data, offsets)
    starts = np.concatenate(([0], ends[:-1])).astype(np.int64)
    first = np.searchsorted(ends, offsets, side="right")
    spans = a.Prefix(data.astype(np.uint64) + np.uint64(1)).spans(starts, ends)
    packed = (spans & np.uint64(0xFFFFFFFFFFFF0000)) | (ends - starts).astype(np.uint64)
    return [np.unique(packed[first[i] : first[i + 1]]) for i in range(len(offsets) - 1)]


def as_text(fingerprint: np.ndarray) -> str:
    """16 hexadecimal digits for each chunk: 12 of its digest, 4 of its length in bytes."""
    return fingerprint.astype(">u8").tobytes().hex()


def containment(one: np.ndarray, other: np.ndarray) -> float:
    """Share of the first one's length whose chunks the other has; 1.0 if both are empty."""
    whole = int((one & np.uint64(0xFFFF)).sum())
    if not whole:
        return 1.0 if not len(other) else 0.0
    shared = np.intersect1d(one, other, assume_unique=True)
    return int((shared & np.uint64(0xFFFF)).sum()) / whole


def _in_order():
    def joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        raw = [t.encode() for t in texts]
        return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])

    def told(rows: list[tuple], nexts: list[str], following: list[np.ndarray], own: list[np.ndarray]):
        out: list[list] = [[] for _ in range(7)]
        edited = []
        for (_, _, _, text), after in zip(rows, nexts, strict=True):
            half = len(text) // 2
            edited.append(text[: len(text) - half] + after[:half])
        changed = fingerprints(*joined(edited))
        for row, new, print_, late, then in zip(rows, edited, own, changed, following, strict=True):
            if row[1]:
                continue
            values = (
                row[2],
                len(row[3]),
                hashlib.sha256(new.encode()).hexdigest(),
                as_text(print_),
                as_text(late),
                containment(print_, late),
                containment(print_, then),
            )
            for column, value in zip(out, values, strict=True):
                column.append(value)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # the last row, whose successor isn't known yet, and its fingerprint
        for batch, data, offsets in a.pieces(batches):
            columns = [batch.column(i).to_pylist() for i in range(3)]
            texts = [t or "" for t in batch.column(3).to_pylist()]
            rows = list(zip(*columns, texts, strict=True))
            prints = fingerprints(data, offsets)
            if held:
                rows, prints = [held[0], *rows], [held[1], *prints]
            ready = [i for i in range(len(rows) - 1) if rows[i][0] == rows[i + 1][0]]
            held = rows[-1], prints[-1]
            out = told(
                [rows[i] for i in ready],
                [rows[i + 1][3] for i in ready],
                [prints[i + 1] for i in ready],
                [prints[i] for i in ready],
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(2).slice(0, 0) if not out[0] else pa.array(out[0], batch.column(2).type)]
                + [pa.array(c, t) for c, t in zip(out[1:], _TYPES, strict=True)],
                names=_NAMES,
            )

    return run


_TYPES = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
_NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint"]
_NAMES += ["near_edited", "near_next"]


def compare_with_edits(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per document: its fingerprint, that of its edited text, and likenesses.

    The edited text has the last floor(n_chars / 2) code points replaced by the first as many (or all) of
    the next document in descending doc_id; after the last comes the first, so a lone document follows
    itself. Rows without a doc_id come last, and rows that share one are ordered by a hash of their
    text. Null texts are empty; two empty texts are fully alike. Further columns are ignored.
    """
    ship(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.xxhash64("text").alias("tie"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("place", F.coalesce(F.col("doc_id").cast("double"), F.lit(float("-inf"))))
    schema = (
        f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string,"
        " edited_fingerprint string, near_edited double, near_next double"
    )
    ranges = min(MOST_RANGES, max(1, rows.count() // ROWS_PER_RANGE))
    shares = [i / ranges for i in range(1, ranges)]
    bounds = []
    if shares:
        known = rows.where("doc_id is not null")
        bounds = known.agg(F.percentile_approx("place", shares, 5 * MOST_RANGES)).head()[0] or []
    if bounds:
        splits = [float("-inf"), *sorted(set(bounds)), float("inf")]
        dealt = Bucketizer(splits=splits, inputCol="place", outputCol="dealt").transform(rows)
        dealt = dealt.withColumn("range", F.col("dealt").cast("int"))
    else:
        dealt = rows.withColumn("range", F.lit(0))
    head = F.max(F.struct(F.col("doc_id").isNotNull(), "doc_id", "tie")).alias("head")
    heads = dealt.groupBy("range").agg(head).orderBy(F.desc("range")).collect()
    # a range's first row also closes the range before it; one row a range, so at most MOST_RANGES
    table = spark.createDataFrame(
        [(r.range, r.head.doc_id, r.head.tie, heads[i - 1].range) for i, r in enumerate(heads)],
        f"range int, head_id {kind}, head_tie long, closes int",
    )
    is_head = F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("tie") == F.col("head_tie"))
    own = F.struct(F.col("range").alias("range"), F.lit(False).alias("guest"))
    also = F.struct(F.col("closes").alias("range"), F.lit(True).alias("guest"))
    return (
        dealt.join(F.broadcast(table), "range")
        .select(F.explode(F.when(is_head, F.array(own, also)).otherwise(F.array(own))).alias("p"), "*")
        .select("p.range", "p.guest", "doc_id", "tie", "text")
        .repartition(max(1, len(heads) // RANGES_PER_TASK), "range")
        .sortWithinPartitions("range", "guest", F.col("doc_id").desc_nulls_last(), F.desc("tie"))
        .select("range", "guest", "doc_id", "text")
        .mapInArrow(_in_order(), schema)
    )
