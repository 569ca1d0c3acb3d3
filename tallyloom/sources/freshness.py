"""Age of the newest row of a staged feed."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyloom.functions import quoted
from tallyloom.operators.staging import LOADED_AT

# Fixed value: hours after which a feed is reported as stale.
WARN_AFTER_HOURS = 24


def freshness(
    df: DataFrame, as_of: str, warn_after_hours: float = WARN_AFTER_HOURS, column: str = LOADED_AT
) -> DataFrame:
    """Newest load time, its age in hours at ``as_of``, and ``pass`` or ``warn``; no rows warns too."""
    return (
        df.selectExpr(f"max({quoted(column)}) as newest")
        .selectExpr("newest", f"timestampdiff(second, newest, {as_of}) / 3600.0D as age_hours")
        .selectExpr("*", f"if(age_hours <= {warn_after_hours}, 'pass', 'warn') as status")
    )
