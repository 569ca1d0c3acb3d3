"""Substring dedup against reference blocks, in the manner of relative Lempel-Ziv factors but by whole blocks.

There is no greedy parse that extends a factor word by word; blocks are compared whole, by hash, which gives
the same removed words (README, item 2). Reference blocks are taken from all documents. A window of 50 words has
an anchor, the smallest hash among its word groups; consecutive windows with one anchor form a block.
As the anchor follows from the window's words alone, equal windows always meet under one anchor.

1. Blocks are indexed by anchor and content; anchors of a single document drop out.
2. A block whose whole content is known from a smaller doc_id lies inside a factor: all its windows repeat.
3. Only where an anchor has several contents, at the ends of factors, single windows are compared; there
   one block for each content stands for all its copies.

Neighbouring repeated windows join to factors, and a factor is at least one window long. Totals combine
before every shuffle. Joins are plain equality joins of written tables, so that both sides are shuffled as
they are and Spark can split a hot key.
Identity of a window is judged by 128-bit hashes, that of a block by 64 bits within its anchor.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import arrays as a
from tallyloom.llm.ship import ship
from tallyloom.llm.written import written

ANCHOR_WORDS = 16
SECOND_BASE = 0xC2B2AE3D27D4EB4F | 1


def _blocks(width: int, group: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in a.pieces(batches):
            starts, ends, first = a.word_bounds(data, offsets)
            at, owner = a.within(first, width)
            if not len(at):
                continue
            words = a.Prefix(a.word_hashes(data, starts, ends))
            places = np.arange(len(starts) - group + 1)
            anchor = a.sliding_min(words.spans(places, places + group), width - group + 1)[at]
            cut = np.flatnonzero(
                np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])))
            )
            last = np.concatenate((cut[1:], [len(at)])) - 1
            who = owner[cut]
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0).take(pa.array(who)),
                    rows.column(1).take(pa.array(who)),
                    pa.array(a.signed(anchor[cut])),
                    pa.array(a.signed(words.spans(at[cut], at[last] + width))),
                    pa.array((at[cut] - first[who]).astype(np.int32)),
                    pa.array((last - cut + 1).astype(np.int32)),
                ],
                names=["doc_id", "body", "anchor", "content", "start", "windows"],
            )

    return run


def _windows(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in a.pieces(batches):
            starts, ends, first = a.word_bounds(data, offsets)
            hashes = a.word_hashes(data, starts, ends)
            spans = rows.column(3)
            lists = spans.flatten()
            sizes = np.diff(spans.offsets.to_numpy())
            begin, count = (lists.field(i).to_numpy() for i in (0, 1))
            owner = np.repeat(np.arange(rows.num_rows), sizes)
            total = int(count.sum())
            at = (
                np.repeat(first[owner] + begin - (np.cumsum(count) - count), count)
                + np.arange(total)
            )
            owner = np.repeat(owner, count)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0).take(pa.array(owner)),
                    rows.column(1).take(pa.array(owner)),
                    pa.array((at - first[owner]).astype(np.int32)),
                    pa.array(a.signed(a.Prefix(hashes).spans(at, at + width))),
                    pa.array(a.signed(a.Prefix(hashes, SECOND_BASE).spans(at, at + width))),
                ],
                names=["doc_id", "body", "start", "one", "two"],
            )

    return run


def _removed(width: int, keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in a.pieces(batches):
            starts, ends, first = a.word_bounds(data, offsets)
            spans = rows.column(2)
            raw = data.tobytes()
            total, removed, digest, texts = [], [], [], []
            for i in range(rows.num_rows):
                low, high = int(first[i]), int(first[i + 1])
                words = raw[offsets[i] : offsets[i + 1]].split()
                found = spans[i].as_py() if spans[i].is_valid else None
                gone = 0
                if found:
                    steps = np.zeros(high - low + 1, dtype=np.int64)
                    begin = np.fromiter((x["start"] for x in found), np.int64, len(found))
                    size = np.fromiter((x["windows"] for x in found), np.int64, len(found))
                    np.add.at(steps, begin, 1)
                    np.add.at(steps, begin + size + width - 1, -1)
                    stays = np.cumsum(steps)[:-1] == 0
                    gone = int(len(words) - stays.sum())
                    words = [w for w, stay in zip(words, stays.tolist(), strict=True) if stay]
                kept = b" ".join(words)
                total.append(high - low)
                removed.append(gone)
                digest.append(hashlib.sha256(kept).hexdigest())
                if keep_text:
                    texts.append(kept.decode())
            columns = [rows.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64())]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
            columns.append(pa.array(digest, pa.string()))
            if keep_text:
                columns.append(pa.array(texts, pa.string()))
                names.append("kept_text")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def remove_repeats(
    spark: SparkSession,
    docs: DataFrame,
    window: int = 50,
    anchor_words: int = ANCHOR_WORDS,
    keep_text: bool = False,
) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 and, if asked for, kept_text.

    A word goes if a window over it also starts in a document with a smaller doc_id. Null texts have no
    words. Rows without a doc_id keep all words and make no others go; rows that share a doc_id are
    no smaller than each other. Documents shorter than a window keep everything. An empty table gives
    no rows; further columns are ignored.
    """
    ship(spark)
    anchor_words = min(anchor_words, window)
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.xxhash64("text").alias("body"), "text")
    known = texts.where("doc_id is not null and text is not null")

    blocks = known.mapInArrow(
        _blocks(window, anchor_words),
        f"doc_id {kind}, body long, anchor long, content long, start int, windows int",
    )
    blocks = written(spark, blocks, "blocks")

    shared = (
        blocks.groupBy("anchor")
        .agg(
            F.min("doc_id").alias("least"),
            F.max("doc_id").alias("most"),
            (F.min("content") != F.max("content")).alias("several"),
        )
        .where("least < most")
        .select("anchor", "least", "several")
    )
    shared = written(spark, shared, "anchors")
    hits = written(spark, blocks.join(shared, "anchor"), "shared-blocks")

    inside = hits.where("not several and least < doc_id").select("doc_id", "body", "start", "windows")
    several = hits.where("several")
    owners = several.groupBy("anchor", "content").agg(F.min("doc_id").alias("owner"))
    owners = written(spark, owners, "owners")
    several = several.join(owners, ["anchor", "content"])
    copies = several.where("owner < doc_id").select("doc_id", "body", "start", "windows")
    ends = several.where("owner = doc_id").groupBy("doc_id", "body")
    ends = ends.agg(F.collect_set(F.struct("start", "windows")).alias("spans"))

    windows = (
        known.join(ends, ["doc_id", "body"])
        .select("doc_id", "body", "text", "spans")
        .mapInArrow(_windows(window), f"doc_id {kind}, body long, start int, one long, two long")
    )
    windows = written(spark, windows, "windows")
    repeated = (
        windows.groupBy("one", "two")
        .agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
        .where("least < most")
        .select("one", "two", "least")
    )
    single = (
        windows.join(written(spark, repeated, "repeated"), ["one", "two"])
        .where("least < doc_id")
        .select("doc_id", "body", "start", F.lit(1).alias("windows"))
    )
    spans = (
        inside.unionByName(copies)
        .unionByName(single)
        .groupBy("doc_id", "body")
        .agg(F.collect_set(F.struct("start", "windows")).alias("spans"))
    )
    result = f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string"
    return (
        texts.join(spans, ["doc_id", "body"], "left")
        .select("doc_id", "text", "spans")
        .mapInArrow(_removed(window, keep_text), result + (", kept_text string" if keep_text else ""))
    )
