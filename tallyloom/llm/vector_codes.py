"""Product codes of vectors; distances are looked up in per-dimension dictionaries of values.

Vectors are packed once into blocks. A block keeps, for each dimension, the distinct integers that occur in it
and for each vector the position of its integer among them. A round tabulates the squared differences of
every distinct integer to all entries of a codebook, so that the distance of a part is a gather and an add per
dimension; sums of parts per entry come from counts of dictionary positions. A round gives a few numbers
per entry and dimension, added up in Spark, which the driver turns into the next codebooks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.ship import ship
from tallyloom.llm.written import written

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
BLOCK_VECTORS = 1 << 16  # a position in a dictionary fits two bytes
BLOCK_VALUES = 1 << 22
NARROW = 1 << 24  # below it squares of differences can't leave 64 bits

Codebooks = list[np.ndarray]  # one array of entries by position for each part


def integers(values: np.ndarray) -> np.ndarray:
    """floor(SCALE * value); the product is exact, since SCALE is a power of two."""
    scaled = np.floor(values.astype(np.float64) * SCALE)
    if len(scaled) and np.abs(scaled).max() >= 2.0**62:
        raise OverflowError("a component is beyond what 62 bits hold")
    return scaled.astype(np.int64)


def _pack(dims: int):
    most = max(1, min(BLOCK_VECTORS, BLOCK_VALUES // max(dims, 1)))

    def block(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        n = table.num_rows
        flat = table.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        rows = integers(flat).reshape(n, dims)
        values, codes = [], np.zeros((dims, n), dtype=np.uint16)
        for d in range(dims):
            distinct, codes[d] = np.unique(rows[:, d], return_inverse=True)
            values.append(distinct)
        lists = [
            pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), table.column(c).combine_chunks())
            for c in ("vec_id", "label")
        ]
        return pa.RecordBatch.from_arrays(
            [*lists, pa.array([values], pa.list_(pa.list_(pa.int64()))), pa.array([codes.tobytes()])],
            names=["ids", "labels", "dictionary", "codes"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            while batch.num_rows:
                taken = batch.slice(0, most - size)
                held.append(taken)
                size += taken.num_rows
                batch = batch.slice(taken.num_rows)
                if size == most:
                    yield block(held)
                    held, size = [], 0
        if size:
            yield block(held)

    return run


def _unpack(batch: pa.RecordBatch) -> Iterator[tuple[int, list[np.ndarray], np.ndarray]]:
    for i in range(batch.num_rows):
        dictionary = batch.column("dictionary")[i].values
        values = [np.asarray(x.values) for x in dictionary]
        codes = np.frombuffer(batch.column("codes")[i].as_buffer(), dtype=np.uint16)
        yield i, values, codes.reshape(len(values), -1)


def nearest(values: list[np.ndarray], codes: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each vector's part (the first of equals) and its squared distance."""
    n = codes.shape[1]
    far = max((int(np.abs(v).max()) for v in (*values, entries) if v.size), default=0)
    kind = np.int64 if far < NARROW else object
    distance = np.zeros((n, len(entries)), dtype=kind)
    for d, known in enumerate(values):
        table = (known.astype(kind)[:, None] - entries[:, d].astype(kind)[None, :]) ** 2
        distance += table[codes[d]]
    best = distance.argmin(axis=1)
    return best, distance[np.arange(n), best]


def _totals(codebooks: Codebooks):
    """Per task, for each part, entry and position: the sum of the parts assigned, and their number."""
    width = codebooks[0].shape[1]
    entries = len(codebooks[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((PARTS, entries, width), dtype=object)
        members = np.zeros((PARTS, entries), dtype=np.int64)
        some = False
        for batch in batches:
            for _, values, codes in _unpack(batch):
                some = True
                for part, book in enumerate(codebooks):
                    own = slice(part * width, (part + 1) * width)
                    best, _ = nearest(values[own], codes[own], book)
                    members[part] += np.bincount(best, minlength=entries)
                    for d, known in enumerate(values[own]):
                        cell = best * len(known) + codes[own][d]
                        counts = np.bincount(cell, minlength=entries * len(known)).reshape(entries, -1)
                        kind = np.int64 if np.abs(known).max() < NARROW else object
                        sums[part, :, d] += counts.astype(kind) @ known.astype(kind)
        if some:
            flat = [Decimal(int(x)) for x in sums.reshape(-1)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(sums.size), pa.int64()),
                    pa.array(flat, pa.decimal128(38, 0)),
                    pa.array(np.repeat(members.reshape(-1), width), pa.int64()),
                ],
                names=["slot", "total", "members"],
            )

    return run


def _coded(codebooks: Codebooks):
    width = codebooks[0].shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, values, codes in _unpack(batch):
                chosen, error = np.zeros((codes.shape[1], PARTS), dtype=np.uint8), 0
                for part, book in enumerate(codebooks):
                    own = slice(part * width, (part + 1) * width)
                    chosen[:, part], distance = nearest(values[own], codes[own], book)
                    error = error + distance
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("ids")[i].values,
                        batch.column("labels")[i].values,
                        pa.array([row.tobytes().hex() for row in chosen]),
                        pa.array(error.tolist(), pa.int64()),
                    ],
                    names=["vec_id", "label", "code", "error"],
                )

    return run


def next_codebooks(codebooks: Codebooks, totals: dict[int, tuple[int, int]]) -> Codebooks:
    """Each entry becomes the floor of its parts' mean; an entry without parts stays."""
    width, entries = codebooks[0].shape[1], len(codebooks[0])
    new = [book.copy() for book in codebooks]
    for slot, (total, members) in totals.items():
        part, rest = divmod(slot, entries * width)
        if members:
            new[part][divmod(rest, width)] = total // members
    return new


def fingerprint(codebooks: Codebooks) -> str:
    numbers = ",".join(str(int(x)) for book in codebooks for x in book.reshape(-1))
    return hashlib.sha256(numbers.encode()).hexdigest()


def _seeds(vectors: DataFrame) -> list[list[float]]:
    order = [F.asc_nulls_last("vec_id"), F.asc("embedding")]
    return [r.embedding for r in vectors.orderBy(*order).limit(ENTRIES).select("embedding").collect()]


def compress(spark: SparkSession, vectors: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks]:
    """(vec_id, label, code, error) of every usable vector, and the codebooks after ``rounds`` rounds.

    A vector that is null or holds a null or non-finite component is left out. The 16 smallest vec_ids (equal
    ones by vector, null ones last) begin the codebooks; with fewer vectors these have fewer entries.
    The first of these that has a multiple of 8 components sets the length; vectors of another length
    can't be cut alike and come back with null code and error. Rows that are repeated count again. Null vec_ids and labels are kept. An
    empty table gives no rows and no codebooks. Further columns are ignored. An error beyond 64 bits stops the run.
    """
    ship(spark)
    usable = "forall(embedding, x -> x is not null and not isnan(x) and abs(x) <> double('infinity'))"
    kept = vectors.select("vec_id", "label", "embedding").where(F.expr(usable))
    ids, labels = (kept.schema[c].dataType.simpleString() for c in ("vec_id", "label"))
    schema = f"vec_id {ids}, label {labels}, code string, error long"
    even = kept.where((F.size("embedding") > 0) & (F.size("embedding") % PARTS == 0))
    seeds = _seeds(even)
    dims = len(seeds[0]) if seeds else 0
    uncut = kept.where(F.size("embedding") != dims) if seeds else kept
    uncut = uncut.selectExpr("vec_id", "label", "cast(null as string) as code", "cast(null as long) as error")
    if not seeds:
        return uncut, []
    alike = even.where(F.size("embedding") == dims)
    if any(len(s) != dims for s in seeds):
        seeds = _seeds(alike)
    first = integers(np.array(seeds, dtype=np.float64).reshape(-1)).reshape(len(seeds), PARTS, dims // PARTS)
    codebooks = [first[:, part].copy() for part in range(PARTS)]
    packed = alike.mapInArrow(
        _pack(dims),
        f"ids array<{ids}>, labels array<{labels}>, dictionary array<array<long>>, codes binary",
    )
    packed = written(spark, packed, "vectors")
    for _ in range(rounds):
        totals = packed.select("dictionary", "codes").mapInArrow(
            _totals(codebooks), "slot long, total decimal(38, 0), members long"
        )
        totals = totals.groupBy("slot").agg(F.sum("total").alias("total"), F.sum("members").alias("members"))
        found = {r.slot: (int(r.total), r.members) for r in totals.collect()}  # one for each codebook number
        codebooks = next_codebooks(codebooks, found)
    return packed.mapInArrow(_coded(codebooks), schema).union(uncut), codebooks


def coded_vectors(spark: SparkSession, vectors: DataFrame) -> DataFrame:
    """The codes with ``label_error``, the error summed over rows of equal label, and the codebooks' hash."""
    coded, codebooks = compress(spark, vectors)
    coded = written(spark, coded, "coded")
    of_label = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return coded.join(of_label, coded["label"].eqNullSafe(of_label["of"])).select(
        "vec_id", "code", "error", "label_error", F.lit(fingerprint(codebooks)).alias("codebooks_sha256")
    )
