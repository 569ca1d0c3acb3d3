"""One frame over Parquet files whose columns changed their types from one delivery to the next.

Spark merges footers in a distributed job, but stops where two files disagree on a type. Deliveries follow
each other, so files of one schema follow each other in time: cutting the files, in the order they were
written, in halves until each half merges finds the runs of one schema with a few such jobs for each
change. Each run is read with its own schema, and its columns are cast to the least type that holds
the values of all runs.
"""

from __future__ import annotations

import re
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import types as T

from tallyloom.functions import literal, quoted

_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
_FLOATS = (T.FloatType, T.DoubleType)
_TIMES = (T.DateType, T.TimestampNTZType, T.TimestampType)
_NESTED = (T.StructType, T.ArrayType, T.MapType)

Files = list[str]


def wider(one: T.DataType, two: T.DataType) -> T.DataType:
    """The least type that holds the values of both.

    Integers widen; an integer beside a decimal is a decimal while 38 digits hold both, and beside a float a
    double; dates become times; structs take the fields of both; a truth value beside a number counts as
    a number. What has nothing else in common is text, nested values as JSON.
    """
    if one == two or isinstance(two, T.NullType):
        return one
    if isinstance(one, T.NullType):
        return two
    for left, right in ((one, two), (two, one)):
        if isinstance(left, T.BooleanType) and isinstance(right, T.NumericType):
            return right
    if isinstance(one, T.NumericType) and isinstance(two, T.NumericType):
        return _wider_number(one, two)
    if isinstance(one, _TIMES) and isinstance(two, _TIMES):
        return max(one, two, key=lambda kind: _TIMES.index(type(kind)))
    if isinstance(one, T.StructType) and isinstance(two, T.StructType):
        return merged(one, two)
    if isinstance(one, T.ArrayType) and isinstance(two, T.ArrayType):
        return T.ArrayType(wider(one.elementType, two.elementType))
    if isinstance(one, T.MapType) and isinstance(two, T.MapType):
        return T.MapType(wider(one.keyType, two.keyType), wider(one.valueType, two.valueType))
    return T.StringType()


def _wider_number(one: T.DataType, two: T.DataType) -> T.DataType:
    if isinstance(one, _INTEGERS) and isinstance(two, _INTEGERS):
        return max(one, two, key=lambda kind: _INTEGERS.index(type(kind)))
    if isinstance(one, _FLOATS) or isinstance(two, _FLOATS):
        return T.DoubleType()
    whole, scale = 0, 0
    for kind in (one, two):
        fraction = kind.scale if isinstance(kind, T.DecimalType) else 0
        digits = kind.precision if isinstance(kind, T.DecimalType) else _DIGITS[type(kind)]
        whole, scale = max(whole, digits - fraction), max(scale, fraction)
    return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.DoubleType()


def merged(one: T.StructType, two: T.StructType) -> T.StructType:
    """The fields of both by name, in the order they are first seen."""
    known = {field.name: field.dataType for field in one}
    for field in two:
        known[field.name] = wider(known.get(field.name, T.NullType()), field.dataType)
    return T.StructType([T.StructField(name, kind) for name, kind in known.items()])


def reshaped(value: str, have: T.DataType, want: T.DataType, depth: int = 0) -> str:
    """A value as the wider type; fields that it lacks are null."""
    if have == want:
        return value
    if isinstance(want, T.StringType) and isinstance(have, _NESTED):
        return f"to_json({value})"
    each = f"e{depth}"
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        known = {field.name: field.dataType for field in have}
        fields = [
            reshaped(f"{value}.{quoted(f.name)}", known[f.name], f.dataType, depth)
            if f.name in known
            else f"cast(null as {f.dataType.simpleString()})"
            for f in want
        ]
        named = ", ".join(f"{literal(f.name)}, {sql}" for f, sql in zip(want, fields, strict=True))
        return f"if({value} is null, null, named_struct({named}))"
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):
        inner = reshaped(each, have.elementType, want.elementType, depth + 1)
        return f"transform({value}, {each} -> {inner})"
    if isinstance(want, T.MapType) and isinstance(have, T.MapType):
        key = reshaped(f"{each}.key", have.keyType, want.keyType, depth + 1)
        item = reshaped(f"{each}.value", have.valueType, want.valueType, depth + 1)
        entries = f"transform(map_entries({value}), {each} -> struct({key} as key, {item} as value))"
        return f"map_from_entries({entries})"
    return f"cast({value} as {want.simpleString()})"


FAILED = (PySparkException, Py4JJavaError)  # the latter from within the job that reads footers


def disagree(error: Exception) -> bool:
    return "[CANNOT_MERGE_" in str(error)


def _folders(files: Files, all_files: Files) -> list[str]:
    """The same files with a folder's name in place of all its files; names taken literally, not as globs."""
    held: dict[str, int] = {}
    for file in all_files:
        folder = file.rpartition("/")[0]
        held[folder] = held.get(folder, 0) + 1
    mine: dict[str, Files] = {}
    for file in files:
        mine.setdefault(file.rpartition("/")[0], []).append(file)
    nested = {f for f in held if any(other.startswith(f + "/") for other in held)}
    names = []
    for folder, found in mine.items():
        names += [folder] if len(found) == held[folder] and folder not in nested else found
    return [re.sub(r"([\[\]{}*?\\])", r"\\\1", name) for name in names]


def parquet_files(spark: SparkSession, path: str | list[str]) -> Files:
    """The data files, in the order they were written; Spark's own listing, without their contents."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return [r.path for r in listed.select("path", "modificationTime").orderBy("modificationTime", "path").collect()]


def _reader(spark: SparkSession, base: str | None) -> DataFrameReader:
    """A reader that takes folder names below ``base`` as columns; without one no folder is a column."""
    if base is None:
        return spark.read.option("recursiveFileLookup", True)
    return spark.read if re.search(r"(?<!\\)[\[{*?]", base) else spark.read.option(
        "basePath", re.sub(r"\\(.)", r"\1", base)
    )


def schema_runs(spark: SparkSession, files: Files, base: str | None = None) -> list[tuple[Files, T.StructType]]:
    """Neighbouring files that agree on their types, with the schema that merges theirs."""
    runs: list[tuple[Files, T.StructType]] = []
    left = [files]
    while left:
        part = left.pop()
        try:
            schema = _reader(spark, base).option("mergeSchema", True).parquet(*_folders(part, files)).schema
        except FAILED as error:
            if len(part) == 1 or not disagree(error):
                raise
            half = len(part) // 2
            left += [part[half:], part[:half]]
            continue
        if runs and runs[-1][1] == schema:
            runs[-1] = (runs[-1][0] + part, schema)
        else:
            runs.append((part, schema))
    return runs


def united(frames: list[DataFrame]) -> DataFrame:
    """The rows of all frames; a column has the least type that holds it in every frame."""
    whole = T.StructType([])
    for frame in frames:
        whole = merged(whole, frame.schema)
    alike = []
    for frame in frames:
        known = {field.name: field.dataType for field in frame.schema}
        columns = [
            reshaped(quoted(f.name), known[f.name], f.dataType)
            if f.name in known
            else f"cast(null as {f.dataType.simpleString()})"
            for f in whole
        ]
        named = [f"{sql} as {quoted(f.name)}" for sql, f in zip(columns, whole, strict=True)]
        alike.append(frame.selectExpr(*named))
    return reduce(DataFrame.union, alike)


def read_widened(
    spark: SparkSession, path: str | list[str], hive_partitioning: bool = True
) -> DataFrame:
    """All files under ``path`` as one frame, ``united``; columns are in the order they are first seen.

    Names of files come to the driver, as they do in any scan; data and footers don't. Files of changing
    schemas that were written by turns cost a job each; such a feed is better rewritten once.
    """
    if not isinstance(path, str):
        return united([read_widened(spark, each, hive_partitioning) for each in path])
    base = path if hive_partitioning else None
    files = parquet_files(spark, path)
    return united(
        [
            _reader(spark, base).schema(schema).parquet(*_folders(part, files))
            for part, schema in schema_runs(spark, files, base)
        ]
    )
