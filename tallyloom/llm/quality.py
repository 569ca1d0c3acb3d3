"""Document quality from a linear-chain conditional random field over lines.

Every line that isn't blank is labelled good or bad. Its features are shares of character and word kinds,
and the same of the lines before and after it. Training maximises the likelihood of chains whose lines
carry their document's label; it uses a bounded sample of labelled documents and runs on the driver.
Scoring runs in Spark over whole texts: forward and backward passes give each line's probability of
being good, and their mean weighted by line length is the document's score.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tallyloom.llm import arrays as a
from tallyloom.llm.ship import ship

TRAINING_DOCUMENTS = 4_000  # bound of the sample that a model is fitted on
TRAINING_LINES = 1_000  # labelled documents with more lines aren't used for fitting
CHAIN = 64  # longer chains are cut for fitting only
CUTOFF = 0.3
ROUNDS, RATE, PENALTY = 150, 0.05, 1e-3
FEATURES = 14

_CLASSES = 7  # upper, lower, digit, plain punctuation, bar, other signs, beyond ASCII
_CLASS = np.full(256, 5, dtype=np.uint8)
_CLASS[ord("A") : ord("Z") + 1] = 0
_CLASS[ord("a") : ord("z") + 1] = 1
_CLASS[ord("0") : ord("9") + 1] = 2
_CLASS[[ord(c) for c in ".,;:'\"()-?/"]] = 3
_CLASS[ord("|")] = 4
_CLASS[0x80:] = 6
_CLASS[list(a.SPACES)] = 7


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # of a good line against a bad one; the last is the constant
    moves: np.ndarray  # log potentials, from a line's label (row) to the next one's (column)
    first: float  # of a good first line against a bad one
    mean: np.ndarray
    scale: np.ndarray
    share: float  # of good documents, the score of a text without lines


def line_features(
    data: np.ndarray, offsets: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Own features of the lines that hold words, their documents, and their lengths in bytes."""
    starts, ends, first = a.word_bounds(data, offsets)
    if not len(starts):
        return np.zeros((0, FEATURES)), np.zeros(0, np.int64), np.zeros(0)
    new = np.zeros(len(data) + 1, dtype=np.int64)
    new[1:] = np.cumsum(data == 0x0A)
    document = np.searchsorted(first, np.arange(len(starts)), side="right") - 1
    line_of = new[starts]
    opens = np.flatnonzero(
        np.concatenate(
            ([True], (line_of[1:] != line_of[:-1]) | (document[1:] != document[:-1]))
        )
    )
    words = np.diff(np.concatenate((opens, [len(starts)])))
    line = np.repeat(np.arange(len(opens)), words)
    begin, end = starts[opens], ends[opens + words - 1]
    length = (end - begin).astype(float)
    kinds = _CLASS[data]
    columns = [np.log1p(length), np.log1p(words)]
    for kind in range(_CLASSES):
        sums = np.zeros(len(data) + 1, dtype=np.int32)
        np.cumsum(kinds == kind, out=sums[1:])
        columns.append((sums[end] - sums[begin]) / length)
    hashes = a.word_hashes(data, starts, ends)
    again = np.concatenate(([False], (hashes[1:] == hashes[:-1]) & (line[1:] == line[:-1])))
    columns.append(np.bincount(line, again, len(opens)) / words)
    order = np.lexsort((hashes, line))
    fresh = np.concatenate(
        ([True], (hashes[order][1:] != hashes[order][:-1]) | (line[order][1:] != line[order][:-1]))
    )
    columns.append(np.bincount(line[order], fresh, len(opens)) / words)
    columns.append(np.bincount(line, kinds[ends - 1] >= 4, len(opens)) / words)
    columns.append(np.bincount(line, (kinds[starts] == 0) & (kinds[ends - 1] != 1), len(opens)) / words)
    columns.append(np.bincount(line, ends - starts, len(opens)) / words / 8)
    return np.column_stack(columns), document[opens], length


def with_neighbours(own: np.ndarray, document: np.ndarray) -> np.ndarray:
    """Own features, then those of the line before and the line after within the document, else zeros."""
    if not len(own):
        return np.zeros((0, 3 * FEATURES + 1))
    same = (document[1:] == document[:-1])[:, None]
    nothing = np.zeros((1, own.shape[1]))
    before = np.vstack((nothing, own[:-1] * same))
    after = np.vstack((own[1:] * same, nothing))
    return np.hstack((own, before, after, np.ones((len(own), 1))))


def marginals(good: list[float], model: Model) -> list[float]:
    """Probability of each line to be good, given all lines; ``good`` are log potentials against bad."""
    (bb, bg), (gb, gg) = np.exp(model.moves).tolist()
    good = [math.exp(min(30.0, max(-30.0, g))) for g in good]
    odds = math.exp(model.first) * good[0]
    ahead = [odds]
    for g in good[1:]:
        odds = min(1e100, max(1e-100, g * (bg + gg * odds) / (bb + gb * odds)))
        ahead.append(odds)
    back = 1.0
    for i in range(len(good) - 1, -1, -1):
        odds = ahead[i] * back
        ahead[i] = odds / (1 + odds)
        onward = good[i] * back
        back = min(1e100, max(1e-100, (gb + gg * onward) / (bb + bg * onward)))
    return ahead


def fit(chains: list[tuple[int, np.ndarray]], share: float) -> Model:
    """Maximum likelihood by Adam; ``chains`` are labels and feature rows, cut to CHAIN lines."""
    parts = [(y, x[i : i + CHAIN]) for y, x in chains for i in range(0, len(x), CHAIN)]
    width = 3 * FEATURES + 1
    if not parts or len({y for y, _ in parts}) < 2:
        first = math.log(max(share, 1e-6) / max(1 - share, 1e-6))
        return Model(np.zeros(width), np.array([[9.0, 0], [0, 9.0]]), first, np.zeros(width), np.ones(width), share)
    rows = np.vstack([x for _, x in parts])
    mean, scale = rows.mean(axis=0), rows.std(axis=0) + 1e-3
    mean[-1], scale[-1] = 0, 1
    rows = np.clip((rows - mean) / scale, -8, 8)
    label = np.array([y for y, _ in parts], dtype=float)
    size = np.array([len(x) for _, x in parts])
    steps = int(size.max())
    place = np.full((len(parts), steps), -1)
    ends = np.cumsum(size)
    for i, n in enumerate(size):
        place[i, :n] = np.arange(ends[i] - n, ends[i])
    there = place >= 0
    good = np.repeat(label, size)
    theta = np.zeros(width + 5)  # weights, moves, first
    speed, square = np.zeros_like(theta), np.zeros_like(theta)
    for turn in range(1, ROUNDS + 1):
        score = (rows @ theta[:width])[place] * there
        moves = theta[width : width + 4].reshape(2, 2)
        ahead = np.zeros((len(parts), steps, 2))
        ahead[:, 0, 1] = theta[-1] + score[:, 0]
        for t in range(1, steps):
            step = np.logaddexp(ahead[:, t - 1, 0, None] + moves[0], ahead[:, t - 1, 1, None] + moves[1])
            step[:, 1] += score[:, t]
            ahead[:, t] = np.where(there[:, t, None], step, ahead[:, t - 1])
        back = np.zeros((len(parts), steps, 2))
        for t in range(steps - 2, -1, -1):
            onward = back[:, t + 1] + np.column_stack((np.zeros(len(parts)), score[:, t + 1]))
            step = np.logaddexp(moves[:, 0] + onward[:, 0, None], moves[:, 1] + onward[:, 1, None])
            back[:, t] = np.where(there[:, t + 1, None], step, back[:, t + 1])
        total = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])
        chance = np.exp(ahead[:, :, 1] + back[:, :, 1] - total[:, None])
        slope = np.zeros_like(theta)
        slope[:width] = rows.T @ (good - chance[there])
        for t in range(1, steps):
            live = there[:, t]
            if not live.any():
                break
            onward = back[live, t] + np.column_stack((np.zeros(live.sum()), score[live, t]))
            both = ahead[live, t - 1, :, None] + moves + onward[:, None, :] - total[live, None, None]
            seen = np.array([(label[live] == 0).sum(), 0, 0, (label[live] == 1).sum()])
            slope[width : width + 4] += seen - np.exp(both).sum(axis=0).ravel()
        slope[-1] = (label - chance[:, 0]).sum()
        slope = slope / len(parts) - PENALTY * theta
        speed = 0.9 * speed + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        theta = theta + RATE * (speed / (1 - 0.9**turn)) / (np.sqrt(square / (1 - 0.99**turn)) + 1e-8)
    return Model(theta[:width], theta[width : width + 4].reshape(2, 2), float(theta[-1]), mean, scale, share)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, data, offsets in a.pieces(batches):
        own, document, _ = line_features(data, offsets)
        rows = with_neighbours(own, document)
        ends = np.searchsorted(document, np.arange(batch.num_rows + 1))
        fits = [i for i in range(batch.num_rows) if 0 < ends[i + 1] - ends[i] <= TRAINING_LINES]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(pa.array(fits, pa.int64())),
                batch.column(1).take(pa.array(fits, pa.int64())),
                pa.array([rows[ends[i] : ends[i + 1]].astype(np.float32).tobytes() for i in fits], pa.binary()),
            ],
            names=["doc_id", "quality", "rows"],
        )


def train(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, limit: int = TRAINING_DOCUMENTS
) -> Model:
    """A model from at most ``limit`` labelled documents, chosen by a hash of doc_id.

    Of a document with several labels the lowest counts; null labels and ids are no labels. Without
    labels of both kinds, all documents get the share of good ones, or 0.5 without any label.
    """
    ship(spark)
    chosen = (
        labels.where("doc_id is not null and quality is not null")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(limit)
    )
    kind = docs.schema["doc_id"].dataType.simpleString()
    sample = (
        docs.select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")  # at most ``limit`` rows of two numbers
        .select("doc_id", F.col("quality").cast("int").alias("quality"), "text")
        .mapInArrow(_features, f"doc_id {kind}, quality int, rows binary")
        .collect()
    )
    sample.sort(key=lambda r: (r.doc_id, r.rows))
    width = 3 * FEATURES + 1
    chains = [
        (int(r.quality > 0), np.frombuffer(r.rows, np.float32).reshape(-1, width).astype(float))
        for r in sample
    ]
    share = sum(y for y, _ in chains) / len(chains) if chains else 0.5
    return fit(chains, share)


def _scores(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in a.pieces(batches):
            own, document, length = line_features(data, offsets)
            rows = np.clip((with_neighbours(own, document) - model.mean) / model.scale, -8, 8)
            good = (rows @ model.weights).tolist()
            ends = np.searchsorted(document, np.arange(batch.num_rows + 1)).tolist()
            scores = []
            for low, high in zip(ends[:-1], ends[1:], strict=True):
                if low == high:
                    scores.append(model.share)
                else:
                    chance = np.array(marginals(good[low:high], model))
                    whole = float((chance * length[low:high]).sum() / length[low:high].sum())
                    scores.append(min(1.0, max(0.0, whole)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64())], names=["row", "score"]
            )

    return run


def score(spark: SparkSession, docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """``row``, a struct of the ``keep`` columns, and the score of every document.

    A null text counts as empty; texts without words get the model's share of good documents. Every row
    is judged by its own text alone, so repeated rows get equal scores, and an empty table gives none.
    """
    ship(spark)
    rows = docs.select(F.struct(*keep).alias("row"), F.col("text").alias("text"))
    schema = StructType([rows.schema["row"], StructField("score", DoubleType())])
    return rows.mapInArrow(_scores(model), schema)


def is_held_out(doc_id: str = "doc_id"):
    """Whether a document is kept from training; null ids are held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(True))


def classify(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score and predicted (1 from CUTOFF on)."""
    model = train(spark, docs, labels.where(~is_held_out()))
    return score(spark, docs, model, ["doc_id"]).select(
        "row.doc_id",
        is_held_out("row.doc_id").alias("held_out"),
        "score",
        (F.col("score") >= CUTOFF).cast("int").alias("predicted"),
    )
