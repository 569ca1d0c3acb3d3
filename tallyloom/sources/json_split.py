"""JSON files whose values span lines, read in parts.

A file is an array of objects or a single object, of any size, pretty-printed or in one line. Spark's text
source cuts it at every closing brace, in splits as large as any other scan's. Whether a brace counts depends
on what stands before it: inside a text it doesn't, and only the one that takes the nesting back to its
base ends an object. So a first pass tells for every split how it changes the two possible states at its
start; sums over the splits of a file then give the state at the start of each. A second pass cuts each
split into objects, and those that lie over a border are put together from their pieces.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.session import scratch_path

_EFFECTS = "file long, block long, parity int, outside long, inside long, first string, chunks long, bytes long"
_PIECES = "file long, block long, kind string, value string"


def _chunks(spark: SparkSession, files: str | list[str]) -> DataFrame:
    """Text up to each closing brace, in order within a split; a file is told by the hash of its path."""
    return spark.read.option("lineSep", "}").text(files).selectExpr(
        "value",
        "xxhash64(_metadata.file_path) as file",
        "_metadata.file_block_start as block",
    )


# The functions below run in tasks and so hold all they need.


def _effect() -> Callable[[str], tuple[int, int, int]]:
    """Of a chunk: whether it has an odd number of quotes, and its change of nesting from outside and inside a text."""
    import re

    escaped = re.compile(r"\\.", re.DOTALL)

    def change(part: str) -> int:
        return part.count("{") + part.count("[") - part.count("}") - part.count("]")

    def effect(chunk: str) -> tuple[int, int, int]:
        if "\\" in chunk:
            chunk = escaped.sub("", chunk)
        parts = chunk.split('"')
        return (len(parts) - 1) % 2, sum(map(change, parts[::2])), sum(map(change, parts[1::2]))

    return effect


def _split_effects() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    effect = _effect()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow

        at, state = None, None

        def done() -> pyarrow.RecordBatch:
            return pyarrow.RecordBatch.from_pylist(
                [dict(zip(names, (*at, *state), strict=True))], schema=pyarrow.schema(kinds)
            )

        names = ("file", "block", "parity", "outside", "inside", "first", "chunks", "bytes")
        kinds = [(n, pyarrow.int32() if n == "parity" else pyarrow.string() if n == "first" else pyarrow.int64()) for n in names]
        for batch in batches:
            for value, *here in zip(*(batch.column(c).to_pylist() for c in ("value", "file", "block")), strict=True):
                if here != at:
                    if at is not None:
                        yield done()
                    at, state = here, [0, 0, 0, None, 0, 0]
                parity, even, odd = effect(value)
                for start in (0, 1):
                    # the brace that ended the chunk counts where its end is outside a text
                    inside = (state[0] + start) % 2
                    state[1 + start] += (odd if inside else even) - (0 if (inside + parity) % 2 else 1)
                state[0] = (state[0] + parity) % 2
                if state[3] is None:
                    state[3] = (value.lstrip("﻿ \t\r\n") + "}")[:1]
                state[4] += 1
                state[5] += len(value.encode()) + 1
        if at is not None:
            yield done()

    return run


def _objects() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Cuts splits into whole objects and the pieces of objects that cross a border.

    Kinds: ``object``, ``begun`` (goes on in the next split), ``middle`` (a whole split in an object), ``ended``.
    """
    effect = _effect()
    blank = dict.fromkeys(map(ord, "\ufeff \t\r\n"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow

        out, size, at = [], 0, None
        held, continued, depth, inside, seen = [], False, 0, 0, 0

        def flush() -> pyarrow.RecordBatch:
            columns = list(zip(*out, strict=True))
            kinds = (pyarrow.int64(), pyarrow.int64(), pyarrow.string(), pyarrow.string())
            return pyarrow.RecordBatch.from_arrays(
                [pyarrow.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["file", "block", "kind", "value"]
            )

        def close() -> None:
            if held:
                out.append((*at, "middle" if continued else "begun", "".join(held)))

        names = ("value", "file", "block", "depth", "in_text", "base", "chunks", "last_open", "name")
        for batch in batches:
            for value, file, block, depth_0, in_text, base, chunks, last_open, name in zip(
                *(batch.column(c).to_pylist() for c in names), strict=True
            ):
                if (file, block) != at:
                    close()
                    at, held, seen = (file, block), [], 0
                    depth, inside = depth_0, int(in_text)
                    continued = depth > base or inside > 0
                seen += 1
                brace = "" if last_open and seen == chunks else "}"
                if not (held or continued):  # between objects
                    start = value.find("{")
                    between = (value if start < 0 else value[:start]).translate(blank)
                    first = block == 0 and seen == 1
                    opened = "[" if base and first else ""
                    if start >= 0:
                        expected = opened if first else "," if base else None
                    else:
                        expected = None if brace else opened + "]" * base
                    if between != expected:
                        raise ValueError(f"more than one JSON value, or other than objects, in {name}: {between[:80]!r}")
                    depth += between.count("[") - between.count("]")
                    if start < 0:
                        continue
                    value = value[start:]
                parity, even, odd = effect(value)
                depth += odd if inside else even
                inside = (inside + parity) % 2
                if brace and not inside:
                    depth -= 1
                held.append(value + brace)
                if depth == base and not inside:
                    text = "".join(held)
                    out.append((*at, "ended" if continued else "object", text))
                    size += len(text)
                    held, continued = [], False
                if size > 1 << 22:
                    yield flush()
                    out, size = [], 0
        close()
        if out:
            yield flush()

    return run


def split_values(spark: SparkSession, files: str | list[str]) -> DataFrame:
    """One row per object as text in ``value``, with the hash of its file's path in ``file``.

    Stops at a file with something other than objects in its array, with more than one value, or that ends
    within one. The states of splits are broadcast: a few numbers for each split of the scan, the list of
    which the driver holds anyway. Compressed files are one split each.
    """
    chunks = _chunks(spark, files)
    effects = chunks.mapInArrow(_split_effects(), _EFFECTS)
    sizes = spark.read.format("binaryFile").load(files).selectExpr(
        "xxhash64(_metadata.file_path) as file", "length as size", "_metadata.file_path as name"
    )
    before = "over (partition by file order by block rows between unbounded preceding and 1 preceding)"
    whole = "over (partition by file)"
    states = (
        effects.selectExpr("*", f"coalesce(sum(parity) {before}, 0L) % 2 = 1 as in_text")
        .selectExpr("*", "if(in_text, inside, outside) as change")
        .selectExpr(
            "*",
            f"coalesce(sum(change) {before}, 0L) as depth",
            f"sum(change) {whole} as final_depth",
            f"sum(parity) {whole} % 2 as final_text",
            f"sum(bytes) {whole} as read_bytes",
            "first_value(first) over (partition by file order by block) as opening",
            f"block = max(block) {whole} as is_last",
        )
        .join(sizes, "file")
    )
    # each chunk was taken to end in a brace; one byte too many means that the last one does not
    open_end = "(read_bytes = size + 1)"
    unclosed = f"final_text <> 0 or final_depth + if({open_end}, 1, 0) <> 0"
    wrong = "raise_error('a JSON value without an end, or more than one, in ' || name)"
    states = states.selectExpr(
        "file",
        "block",
        f"cast(if({unclosed}, {wrong}, depth) as long) as depth",
        "in_text",
        "if(opening = '[', 1, 0) as base",
        "chunks",
        f"is_last and {open_end} as last_open",
        "name",
    )
    pieces = chunks.join(F.broadcast(states), ["file", "block"]).mapInArrow(_objects(), _PIECES)
    path = scratch_path(spark, "json-objects")
    pieces.write.parquet(path)
    pieces = spark.read.schema(_PIECES).parquet(path)
    crossing = (
        pieces.where("kind <> 'object'")
        .selectExpr(
            "*",
            "sum(if(kind = 'begun', 1, 0)) over (partition by file order by block,"
            " if(kind = 'begun', 1, 0)) as turn",
        )
        .groupBy("file", "turn")
        .agg(F.sort_array(F.collect_list(F.struct("block", "value"))).alias("parts"))
        .select(F.array_join(F.col("parts.value"), "").alias("value"), "file")
    )
    return pieces.where("kind = 'object'").select("value", "file").unionByName(crossing)
