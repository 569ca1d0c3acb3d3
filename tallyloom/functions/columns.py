"""Money, times and text."""

from __future__ import annotations

from tallyloom.functions.sql import literal


def guarded_ratio(amount: str, quantity: str) -> str:
    """``amount / quantity``, NULL where the quantity is zero or missing."""
    return f"({amount}) / nullif({quantity}, 0)"


def exact_sum(amount: str) -> str:
    """Sum of a double that does not depend on row order or partitioning.

    The values are added as decimals of 18 digits before and after the point, so a re-run task gives
    the same total. What such a decimal cannot hold (NaN, infinities, 1e20 and more, less than 1e-18) is
    added as doubles beside it; NaN and infinities so end up in the total. Should the decimals
    themselves overflow, all is added as doubles. NULL if there are no values.
    """
    exact = f"try_cast({amount} as decimal(38, 18))"
    rest = f"if({exact} is null or ({exact} = 0 and {amount} <> 0), {amount}, 0.0D)"
    total = f"cast(try_sum({exact}) as double)"
    return (
        f"case when count({amount}) = 0 then null"
        f" when count({exact}) > 0 and {total} is null then sum({amount})"
        f" else coalesce({total}, 0.0D) + sum({rest}) end"
    )


def concat_present(*parts: str) -> str:
    """Concatenation that skips NULL parts; empty text when all are NULL."""
    return "concat_ws('', " + ", ".join(f"cast({part} as string)" for part in parts) + ")"


def utc_instant(instant: str) -> str:
    """A zoned timestamp as zone-less UTC, whatever the session time zone is."""
    seconds = f"cast(cast(unix_micros({instant}) as decimal(20, 0)) / 1000000 as decimal(18, 6))"
    return f"(timestamp_ntz'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, {seconds}))"


# Text of a date, or a date and time, that names no zone.
_NO_ZONE = r"^\s*[0-9]+(-[0-9]+){0,2}([ T][0-9:.]*)?\s*\z"


def names_zone(text: str) -> str:
    return f"not ({text} rlike {literal(_NO_ZONE)})"


def utc_timestamp(text: str) -> str:
    """ISO text as zone-less UTC: an offset or a named zone is applied, without one it is UTC already."""
    shifted = utc_instant(f"cast({text} as timestamp)")
    return f"case when {names_zone(text)} then {shifted} else cast({text} as timestamp_ntz) end"


def cast_text(text: str, kind: str) -> str:
    """Feed text to a staged type. Unreadable text raises; it never turns into NULL.

    Whole-number columns round fractions half away from zero.
    """
    if kind == "timestamp":
        return utc_timestamp(text)
    if kind == "bigint":
        rounded = f"cast(round(cast({text} as decimal(38, 10))) as bigint)"
        return f"coalesce(try_cast({text} as bigint), {rounded})"
    return text if kind == "string" else f"cast({text} as {kind})"


def month_end(day: str) -> str:
    return f"last_day({day})"


def plus_month_less_day(day: str) -> str:
    """The last day of a one-month term that starts on ``day``; short months clip."""
    return f"date_sub(add_months({day}, 1), 1)"
