"""File scans. No scan infers types: CSV is all text, JSON gets its schema, Parquet has its own."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions import literal, utc_instant
from tallyloom.operators.staging import LOADED_AT
from tallyloom.sources.json_split import split_values
from tallyloom.sources.widening import FAILED, disagree, read_widened

Paths = str | list[str]


def read_csv(
    spark: SparkSession,
    path: Paths,
    *,
    header: bool = True,
    delimiter: str = ",",
    quote: str = '"',
    columns: list[str] | None = None,
    multi_line: bool = False,
    strict: bool = True,
) -> DataFrame:
    """A CSV feed with every column as text; an empty field is NULL, a doubled quote is one quote.

    ``strict`` stops at a row with too few or too many fields, and at a file whose header names
    other columns or the same in another order. Naming the ``columns`` saves the look at the first file.

    Files are split over tasks. ``multi_line`` admits line breaks inside quoted fields, at the price
    of one task per file; without it ``strict`` stops at such a row instead of misreading it.
    """
    reader = (
        spark.read.option("header", header)
        .option("sep", delimiter)
        .option("quote", quote)
        .option("escape", quote)
        .option("multiLine", multi_line)
    )
    if strict:
        # A pruned parse does not see the fields it skips, so it cannot tell a broken row.
        reader = reader.option("mode", "FAILFAST").option("columnPruning", False)
        reader = reader.option("enforceSchema", not header)
    if columns is not None:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    return reader.csv(path)


def read_parquet(
    spark: SparkSession,
    path: Paths,
    *,
    hive_partitioning: bool = True,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """A Parquet feed whose files may have different columns; they are matched by name.

    Merging reads every footer. With a ``schema`` that step is skipped. Where files disagree on the type
    of a column it gets the least type that holds all of them (``sources/widening.py``).
    """
    reader = spark.read.option("recursiveFileLookup", not hive_partitioning)
    if schema is not None:
        return reader.schema(schema).parquet(path)
    try:
        return reader.option("mergeSchema", True).parquet(*([path] if isinstance(path, str) else path))
    except FAILED as error:
        if not disagree(error):
            raise
        return read_widened(spark, path, hive_partitioning)


# A line that can be a whole value. In a file whose every line is like this no value spans lines: if one
# did, a comma or bracket would stand at the end of a line or at the start of the next.
_WHOLE_LINE = r"^\s*(\{.*\}|\[.*\])\s*$"

_ARRAY = r"^\s*\["


def json_files(spark: SparkSession, path: Paths) -> tuple[list[str], list[str]]:
    """The files whose values each fit a line, and those with values over several lines.

    One pass over the text, without parsing it; only file names come to the driver. Empty files are
    in neither list.
    """
    found = (
        spark.read.text(path)
        .where(F.trim("value") != "")
        .selectExpr("_metadata.file_path as file", f"value rlike {literal(_WHOLE_LINE)} as whole")
        .groupBy("file")
        .agg(F.min("whole").alias("whole"))
        .orderBy("file")
        .collect()
    )
    return [r.file for r in found if r.whole], [r.file for r in found if not r.whole]


def read_json(
    spark: SparkSession, path: Paths, schema: T.StructType | str, json_format: str = "auto"
) -> DataFrame:
    """A JSON feed: ``newline_delimited``, ``array`` (one array per file), or ``auto``.

    ``auto`` finds the form of each file by itself, so that forms may be mixed in a folder. A line may hold
    an object or an array of objects; such files are split over tasks. So is a file whose value spans
    lines, an array or a single object (``sources/json_split.py``), unless it is compressed: then it is one row
    of text first, which Spark limits to 2 GB. If it holds more than that one value the read stops, as it
    does at anything unreadable.

    Where values span lines, the frame also has the file's ``_metadata``, for ``with_load_time``.
    """
    if json_format not in ("auto", "newline_delimited", "array"):
        raise ValueError(f"unknown JSON format {json_format!r}")
    reader = spark.read.schema(schema).option("mode", "FAILFAST")
    if json_format == "newline_delimited":
        return reader.json(path)
    if json_format == "array":
        return _spanning_values(spark, path, schema)
    by_line, spanning = json_files(spark, path)
    if not spanning:
        return reader.json(path)
    parts = [_spanning_values(spark, spanning, schema)]
    if by_line:
        parts.append(reader.json(by_line).select("*", "_metadata"))
    return parts[0] if len(parts) == 1 else parts[1].unionByName(parts[0])


# The endings of files that Spark takes apart only as a whole.
_PACKED = (".gz", ".bz2", ".zst", ".lz4", ".snappy", ".deflate")


def _spanning_values(spark: SparkSession, files: Paths, schema: T.StructType | str) -> DataFrame:
    """One row per object of files that each hold one array or object over several lines."""
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    known = spark.read.format("binaryFile").load(files).select("path", "_metadata")
    packed = [r.path for r in known.where(f"path rlike '({'|'.join(_PACKED).replace('.', '[.]')})$'").select("path").collect()]
    if packed:
        plain = [r.path for r in known.select("path").collect() if r.path not in set(packed)]
        whole = _whole_values(spark, packed, kind)
        return whole.unionByName(_spanning_values(spark, plain, schema)) if plain else whole
    parsed = f"from_json(value, {literal(kind.json())}, map('mode', 'FAILFAST')) as v"
    of_file = known.selectExpr("xxhash64(_metadata.file_path) as file", "_metadata")
    return split_values(spark, files).selectExpr(parsed, "file").join(of_file, "file").select("v.*", "_metadata")


def _whole_values(spark: SparkSession, files: list[str], kind: T.StructType) -> DataFrame:
    """The objects of compressed files, each read as one row of text.

    The parser ignores what follows a value. So the text is parsed as one member of an object, and a
    second member must be found behind it.
    """
    whole = spark.read.text(files, wholetext=True).select("value", "_metadata")

    def objects(shape: T.DataType) -> str:
        wrapped = "'{\"v\":' || value || ',\"whole\":true}'"
        wanted = literal(T.StructType().add("v", shape).add("whole", "boolean").json())
        return f"from_json({wrapped}, {wanted}, map('mode', 'FAILFAST'))"

    is_array = f"value rlike {literal(_ARRAY)}"
    parts = []
    for chosen, shape, values in (
        (is_array, T.ArrayType(kind), "p.v"),
        (f"not {is_array}", kind, "array(p.v)"),
    ):
        parsed = whole.where(chosen).selectExpr(f"{objects(shape)} as p", "_metadata")
        unfinished = "raise_error('more than one JSON value, or none, in ' || _metadata.file_path)"
        parts.append(
            parsed.selectExpr(f"inline(if(p.whole, {values}, {unfinished}))", "_metadata")
        )
    return parts[0].unionByName(parts[1])


def json_spec(spark: SparkSession, path: Paths) -> T.StructType:
    """The type of a JSON feed's objects, from one pass over all of them: a spec to begin a new feed with.

    Numbers with a fraction are doubles. What is null in every object, or of different kinds in two, is text. A
    feed that holds anything but objects, or none, has no such type and is an error.
    """
    values = read_json_values(spark, path)
    found = values.selectExpr("schema_of_variant_agg(parse_json(value)) as kind").first().kind
    if not str(found).startswith("OBJECT<"):
        raise ValueError(f"not a feed of JSON objects: {found}")
    text = re.sub(r"\bOBJECT<", "STRUCT<", found)
    for kind, name in (("OBJECT", "STRING"), ("VOID", "STRING"), ("VARIANT", "STRING"), (r"DECIMAL\(\d+,\s*\d+\)", "DOUBLE")):
        text = re.sub(rf"(?<=[ <]){kind}(?=[,>])", name, text)
    return T.StructType.fromDDL(text[len("STRUCT<") : -1])


def read_json_auto(spark: SparkSession, path: Paths) -> DataFrame:
    """A JSON feed by the types that its own objects have; two passes, the first over the whole text."""
    return read_json(spark, path, json_spec(spark, path))


def read_json_lines(spark: SparkSession, path: Paths) -> DataFrame:
    """Newline-delimited JSON as text, one object per row in ``value``."""
    return spark.read.text(path).where(F.trim("value") != "")


def read_json_values(spark: SparkSession, path: Paths) -> DataFrame:
    """The objects of a JSON feed of any form as text, one per row in ``value``."""
    by_line, spanning = json_files(spark, path)
    parts = []
    if by_line:
        parts.append(spark.read.text(by_line).where(F.trim("value") != ""))
    if spanning:
        parts.append(spark.read.text(spanning, wholetext=True))
    if not parts:
        return spark.createDataFrame([], "value string")
    # an array is opened; what is no array, or not JSON at all, stays as it is
    opened = f"if(value rlike {literal(_ARRAY)}, from_json(value, 'array<string>'), array(value))"
    texts = [df.selectExpr(f"explode(coalesce({opened}, array(value))) as value") for df in parts]
    return texts[0] if len(texts) == 1 else texts[0].unionByName(texts[1])


def with_load_time(df: DataFrame) -> DataFrame:
    """Adds the time the row's file was written, which orders versions of the same charge."""
    return df.selectExpr("*", f"{utc_instant('_metadata.file_modification_time')} as {LOADED_AT}")
