"""Predicates on text: does it read as a date-time, a number, JSON, a key-value pair?

Each is NULL for NULL text (JSON also beyond the parser's limits) and false for what it rejects; none raises. Regular expressions do most of
the screening, so a malformed value costs no parser exception.
"""

from __future__ import annotations

from tallyloom.functions.columns import names_zone
from tallyloom.functions.sql import literal

# The accepted forms are date, date and time, and T-separated time with Z or an offset.
_DATE = r"^\s*(\d{1,4}-\d{1,2}-\d{1,2})"
_CLOCK = r"([01]?\d|2[0-3]):[0-5]?\d:[0-5]?\d"
_ZONE = r"(Z|[+-]\d{2}(:?\d{2}(:?\d{2})?)?)"
_DATE_TIME = rf"{_DATE}(\s+{_CLOCK}|T{_CLOCK}{_ZONE})?\s*\z"

# Fixed value: one key and one value of word characters.
_KEY_VALUE = r"^[A-Za-z0-9_]+:[A-Za-z0-9_]+\z"

# Fixed value: a plain decimal number.
_PLAIN_DECIMAL = r"^-?\d+(\.\d+)?\z"

# How the text of a JSON value begins and ends; what fails this need not be parsed.
_JSON_EDGES = r"(?s)^[ \t\r\n]*(\{.*\}|\[.*\]|\".*\"|-?[0-9].*|true|false|null)[ \t\r\n]*\z"

# The JVM's number parser also takes a trailing type letter, as in "1d".
_TYPE_LETTER = r"[0-9.][dDfF]\s*\z"


def _if_present(text: str, condition: str) -> str:
    return f"if({text} is null, null, {condition})"


def matches(text: str, pattern: str) -> str:
    return f"({text} rlike {literal(pattern)})"


def is_date_time(text: str) -> str:
    # a cast wants four to seven digits of year
    day = f"regexp_replace({text}, {literal('(?s)' + _DATE + '.*')}, '000$1')"
    on_calendar = f"try_cast({day} as date) is not null"
    return _if_present(text, f"{matches(text, _DATE_TIME)} and {on_calendar}")


def is_key_value(text: str) -> str:
    return matches(text, _KEY_VALUE)


def is_json(text: str) -> str:
    """Whole text is one JSON value; NULL where the parser's limits leave that open.

    Spark's parser stops after the first value and ignores what follows. So the text is parsed as the first
    element of an array whose second is the text's own MD5, which the text cannot contain: only if the
    text is one value does the digest come second. That is one parse per value.

    The parser takes strings up to 20 million characters, 1,000 levels and numbers of 1,000 digits. Text
    that fails and could exceed one of these is not judged.
    """
    wrapped = f"try_parse_json('[' || {text} || ',\"' || md5({text}) || '\"]')"
    second = f"cast(try_element_at(cast({wrapped} as array<variant>), 2) as string)"
    whole = f"coalesce({second} = md5({text}), false)"
    brackets = f"length({text}) - length(translate({text}, '[{{', ''))"
    beyond = (
        f"length({text}) > 20000000 or {brackets} >= 1000 or {matches(text, '[0-9.eE+-]{1000}')}"
    )
    return _if_present(
        text,
        f"case when not {matches(text, _JSON_EDGES)} then false when {whole} then true"
        f" when {beyond} then null else false end",
    )


def _is_number(text: str) -> str:
    return _if_present(
        text, f"try_cast({text} as double) is not null and not {matches(text, _TYPE_LETTER)}"
    )


def is_decimal(text: str) -> str:
    return f"({_is_number(text)} or {matches(text, _PLAIN_DECIMAL)})"


def is_castable(text: str, kind: str) -> str:
    """Whether ``cast_text(text, kind)`` would succeed."""
    if kind == "double":
        return _is_number(text)
    if kind == "bigint":
        rounded = f"try_cast(round(try_cast({text} as decimal(38, 10))) as bigint)"
        fits = f"coalesce(try_cast({text} as bigint), {rounded}) is not null"
    elif kind == "string":
        fits = "true"
    else:
        fits = f"try_cast({text} as {kind}) is not null"
        if kind == "timestamp":
            local = f"try_cast({text} as timestamp_ntz) is not null"
            fits = f"if({names_zone(text)}, {fits}, {local})"
    return _if_present(text, fits)
