"""Feed files that count once: a ledger of what was loaded, committed together with the data.

Rows go to a folder of their batch, with the file they come from. The batch counts from the moment its
entries are in the ledger, which is one small write after the data; a run that dies before leaves a folder
that no entry names, and the next run writes it anew. Readers take what the ledger names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.functions import quoted, utc_instant
from tallyloom.sources.upsert import table_exists

BATCH, FILE = "_batch", "_file"
LOADED, COPY = "loaded", "copy"

# The columns of a ledger.
LEDGER = (
    "file string, size bigint, written timestamp_ntz, rows bigint, content string, outcome string,"
    " batch string, turn bigint"
)

Reader = Callable[[SparkSession, list[str]], DataFrame]


def delivered(spark: SparkSession, pattern: str) -> DataFrame:
    """Path, name, size and time of every file that matches; contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(pattern)
    return found.selectExpr(
        "path", "_metadata.file_path as file", "length as size", f"{utc_instant('modificationTime')} as written"
    )


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    if not table_exists(spark, ledger):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(ledger)


def new_files(spark: SparkSession, pattern: str, ledger: str) -> DataFrame:
    """Files that the ledger doesn't have in this size and of this time."""
    same = ["file", "size", "written"]
    return delivered(spark, pattern).join(read_ledger(spark, ledger).select(*same), same, "left_anti")


def content_marks(df: DataFrame) -> DataFrame:
    """Rows of each file behind a frame, and a mark of its contents that the order of rows doesn't change.

    The mark is two sums of row hashes, so a file is never held as a whole and may have any size.
    """
    names = ", ".join(quoted(name) for name in df.columns)
    hashed = df.selectExpr(
        "_metadata.file_path as file",
        f"cast(xxhash64({names}) as decimal(38, 0)) as one",
        f"cast(xxhash64('two', {names}) as decimal(38, 0)) as two",
    )
    return hashed.groupBy("file").agg(
        F.count("*").alias("rows"),
        F.concat_ws(":", F.count("*"), F.sum("one"), F.sum("two")).alias("content"),
    )


def ingest_new(spark: SparkSession, pattern: str, read: Reader, table: str, ledger: str) -> dict[str, int]:
    """Loads the files that the ledger lacks and gives the number of files of each outcome.

    ``read`` makes a frame of some paths; it must keep ``_metadata``. A file whose rows are those of a loaded
    one, or of another new one, is entered as a copy and not loaded. A file that was changed in place counts
    as new, and its former rows no longer count. Empty files are entered as loaded, with no rows. Names of
    new files come to the driver; their rows are read once for the marks and once to be loaded.
    """
    fresh = new_files(spark, pattern, ledger).orderBy("file").collect()
    if not fresh:
        return {}
    known = read_ledger(spark, ledger)
    paths = {r.file: re.sub(r"([\[\]{}*?\\])", r"\\\1", r.path) for r in fresh}
    listed = spark.createDataFrame(
        [(r.file, r.size, r.written) for r in fresh], "file string, size bigint, written timestamp_ntz"
    )
    marks = listed.join(content_marks(read(spark, list(paths.values()))), "file", "left")
    marks = marks.na.fill({"rows": 0, "content": ""})
    counted = current(known).where("rows > 0").select("content", "file")
    others = counted.withColumnsRenamed({"content": "known_content", "file": "known_file"})
    # a changed file replaces its own former rows, so only the contents of other files make it a copy
    taken = (F.col("content") == F.col("known_content")) & (F.col("file") != F.col("known_file"))
    replaced = others.join(listed.select(F.col("file").alias("known_file")), "known_file", "left_anti")
    first = Window.partitionBy("content").orderBy("file")
    judged = (
        marks.join(replaced.select("known_content", "known_file"), taken, "left")
        .groupBy("file", "size", "written", "rows", "content")
        .agg(F.max("known_file").alias("known_file"))
        .withColumn("place", F.row_number().over(first))
        .withColumn(
            "outcome",
            F.when((F.col("rows") > 0) & (F.col("known_file").isNotNull() | (F.col("place") > 1)), COPY).otherwise(LOADED),
        )
    )
    entries = [tuple(r) for r in judged.select("file", "size", "written", "rows", "content", "outcome").collect()]
    entries.sort()
    batch = hashlib.sha256(repr(entries).encode()).hexdigest()[:16]
    loaded = [paths[e[0]] for e in entries if e[5] == LOADED and e[3]]
    if loaded:
        rows = read(spark, loaded).selectExpr("*", f"_metadata.file_path as {FILE}")
        rows.write.mode("overwrite").parquet(f"{table}/{BATCH}={batch}")
    turn = (known.agg(F.max("turn")).first()[0] or 0) + 1
    spark.createDataFrame([(*e, batch, turn) for e in entries], LEDGER).coalesce(1).write.mode(
        "append"
    ).parquet(ledger)
    outcomes = [e[5] for e in entries]
    return {name: outcomes.count(name) for name in sorted(set(outcomes))}


def current(entries: DataFrame) -> DataFrame:
    """The last entry of each file."""
    last = Window.partitionBy("file").orderBy(F.desc("turn"))
    return entries.withColumn("_place", F.row_number().over(last)).where("_place = 1").drop("_place")


def read_loaded(spark: SparkSession, table: str, ledger: str) -> DataFrame:
    """The rows of every loaded file as it was last delivered."""
    counted = current(read_ledger(spark, ledger)).where(f"outcome = '{LOADED}'")
    counted = counted.select(F.col("file").alias(FILE), F.col("batch").alias(BATCH))
    rows = spark.read.option("mergeSchema", True).parquet(table)
    return rows.withColumn(BATCH, F.col(BATCH).cast("string")).join(counted, [FILE, BATCH], "left_semi")
