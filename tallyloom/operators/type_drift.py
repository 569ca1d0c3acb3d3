"""Values in raw JSON whose type is not the declared one, path by path.

A fixed schema turns a number that became text, or an object that became an array, into null or into text
without a word. Here each document is parsed once to a variant, and the declared shape is walked through it
in one expression; only what differs reaches the aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions import literal
from tallyloom.operators.drift import UNREADABLE

_NUMBERS = (T.DoubleType, T.FloatType, T.DecimalType)
_ENTRY = "array<struct<path: string, declared: string, found: string>>"
_NONE = f"cast(array() as {_ENTRY})"


def _fitting(kind: T.DataType) -> tuple[str, ...]:
    """The JSON kinds that hold a declared type without loss."""
    if isinstance(kind, T.IntegralType):
        return ("BIGINT",)
    if isinstance(kind, _NUMBERS):
        return ("BIGINT", "DECIMAL", "DOUBLE")
    if isinstance(kind, T.BooleanType):
        return ("BOOLEAN",)
    if isinstance(kind, T.StructType):
        return ("OBJECT",)
    if isinstance(kind, T.MapType):
        return ("OBJECT",)
    return ("ARRAY",) if isinstance(kind, T.ArrayType) else ("STRING",)


def _declared(kind: T.DataType) -> str:
    named = {T.StructType: "object", T.MapType: "object", T.ArrayType: "array"}
    return named.get(type(kind), kind.simpleString())


def _differences(value: str, kind: T.DataType, path: str, depth: int) -> str:
    """What differs in a variant and below it, as an array; a missing value or a JSON null fits anything."""
    found = f"regexp_extract(schema_of_variant({value}), '^[A-Z]+', 0)"
    fits = ", ".join(literal(name) for name in (*_fitting(kind), "VOID"))
    entry = f"array(struct({literal(path or '$')} as path, {literal(_declared(kind))} as declared, {found} as found))"
    below = _below(value, kind, path, depth)
    return f"case when {value} is null then {_NONE} when {found} not in ({fits}) then {entry} else {below} end"


def _below(value: str, kind: T.DataType, path: str, depth: int) -> str:
    each = f"v{depth}"
    if isinstance(kind, T.StructType):
        parts = []
        for field in kind:
            key = field.name.replace("'", "\\'")
            child = f"variant_get({value}, {literal(f'$[\"{key}\"]')}, 'variant')"
            inner = _differences(each, field.dataType, f"{path}.{field.name}".lstrip("."), depth + 1)
            parts.append(f"flatten(transform(array({child}), {each} -> {inner}))")
        return f"concat({', '.join(parts)})" if parts else _NONE
    if isinstance(kind, T.ArrayType):
        inner = _differences(each, kind.elementType, f"{path}[]", depth + 1)
        return f"coalesce(flatten(transform(cast({value} as array<variant>), {each} -> {inner})), {_NONE})"
    return _NONE


def type_drift(lines: DataFrame, shape: T.DataType | str) -> DataFrame:
    """``path``, declared and found type, how many values differ so, and in how many documents.

    ``lines`` has one JSON document per row in ``value``; ``shape`` is the declared type of one, as DDL or a
    type. Integers must be integers that fit 64 bits, other numbers may be any, texts must be texts. Below a
    value of another kind nothing more is looked for. Text that is no JSON counts under the path ``$``
    as ``(unreadable)``; missing values and nulls differ in nothing.
    """
    kind = T.StructType.fromDDL(shape) if isinstance(shape, str) else shape
    unread = f"array(struct('$' as path, {literal(_declared(kind))} as declared, {literal(UNREADABLE)} as found))"
    parsed = lines.where("value is not null").selectExpr("try_parse_json(value) as doc")
    seen = parsed.selectExpr(
        f"if(doc is null, {unread}, {_differences('doc', kind, '', 0)}) as seen"
    ).where("size(seen) > 0")
    each = "explode(transform(array_distinct(seen), d -> struct(d as d, size(filter(seen, x -> x = d)) as n))) as e"
    return (
        seen.selectExpr(each)
        .selectExpr("e.d.path", "e.d.declared", "e.d.found", "cast(e.n as long) as n")
        .groupBy("path", "declared", "found")
        .agg(F.sum("n").alias("values"), F.count("*").alias("documents"))
    )
