"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read by the next.

A stage takes (spark, docs, sf_dir) and returns the documents it leaves, in the columns of ``docs``; the last
one returns the mixed corpus, with two columns more. All stages keep rows without a doc_id, which they
cannot compare, and treat null texts as their operators say.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.decontaminate import find_items
from tallyloom.llm.lines import drop_boilerplate
from tallyloom.llm.mixing import mix
from tallyloom.llm.near_dedup import near_duplicates
from tallyloom.llm.quality import CUTOFF, is_held_out, score, train
from tallyloom.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = train(spark, docs, labels.where(~is_held_out()))
    return score(spark, docs, model, docs.columns).where(F.col("score") >= CUTOFF).select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without boilerplate lines, with n_chars of what is left."""
    clean = drop_boilerplate(spark, docs)
    made = {"n_chars": F.length("text").cast(docs.schema["n_chars"].dataType)}
    return clean.select(*[made.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The text that stands for each class of near duplicates; of rows equal in doc_id and text, one."""
    first = near_duplicates(spark, docs).where("doc_id = class_id and body = class_body")
    body = F.xxhash64(F.coalesce("text", F.lit("")))
    kept = (
        docs.select(F.col("doc_id").alias("doc_id"), body.alias("body"), F.struct(*docs.columns).alias("row"))
        .join(first.select("doc_id", "body").distinct(), ["doc_id", "body"])
        .groupBy("doc_id", "body")
        .agg(F.min_by("row", F.struct("row.text", F.xxhash64("row.text"))).alias("row"))
    )
    return kept.select("row.*").unionByName(docs.where("doc_id is null"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    held = find_items(spark, docs, items).select(
        F.col("doc_id").alias("_held_doc"), F.col("body").alias("_held_body")
    )
    same = docs["doc_id"].eqNullSafe(held["_held_doc"])
    same = same & (F.xxhash64(docs["text"]) == held["_held_body"])
    return docs.join(held.distinct(), same, "left_anti")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for each repetition of a document, with ``repetition`` and the words ``taken``.

    A fractional repetition has as many of the document's first words as it takes. Documents that the mix
    doesn't take, and those without words, are not in it. Rows that agree in doc_id, source and text
    are repeats of one document; each is taken as often as the mix says.
    """
    taken = (
        mix(spark, docs)
        .where("taken > 0")
        .groupBy("doc_id", "source", "body")
        .agg(F.sort_array(F.collect_list(F.struct("whole", "extra", "size"))).alias("takes"))
    )
    taken = taken.select(
        F.col("doc_id").alias("_doc"), F.col("source").alias("_source"), "body", "takes"
    )
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.xxhash64("text").alias("body"))
    rows = rows.withColumns({"doc": F.col("row.doc_id"), "from": F.col("row.source")})
    same = rows["doc"].eqNullSafe(taken["_doc"]) & rows["from"].eqNullSafe(taken["_source"])
    joined = rows.join(taken, same & (rows["body"] == taken["body"])).select(
        "row", rows["body"], "doc", "from", "takes"
    )
    one = joined.dropDuplicates(["doc", "from", "body"])
    times = one.select("row", F.explode("takes").alias("t"))
    copies = F.expr(
        "filter(concat(transform(sequence(0, t.whole), i -> if(i < t.whole, t.size, t.extra))),"
        " n -> n > 0)"
    )
    each = times.select("row", F.col("t.size").alias("size"), F.posexplode(copies).alias("repetition", "taken"))
    words = "array_join(slice(filter(split(row.text, '[\\\\x20\\\\x09-\\\\x0D]+'), w -> w <> ''), 1, int(taken)), ' ')"
    text = F.expr(f"if(taken = size, row.text, {words})")
    made = {"text": text, "n_chars": F.length(text).cast(docs.schema["n_chars"].dataType)}
    own = [c for c in docs.columns if c not in ("repetition", "taken")]
    return each.select(*[made.get(c, F.col(f"row.`{c}`")).alias(c) for c in own], "repetition", "taken")


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mixing", mixing),
]

# The classifier's training and the sketches have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
