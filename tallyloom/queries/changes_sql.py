"""The same results as SQL, for the queries over changing feeds."""

from __future__ import annotations

from tallyloom.queries.changes import DISTINCT_CHECKS
from tallyloom.queries.oracle import (
    _METER_SUMS,
    AI_COLUMNS,
    COST,
    FLAWED,
    METERS,
    OBSERVED,
    REPORT_ROWS,
    TOTALS,
    USAGE,
    canonical,
    newest,
    suite,
    tagged,
)

_METERS_OF_START = METERS.replace(
    TOTALS,
    f"SELECT bucket_start, max(bucket_end) AS bucket_end, model, workspace_id, {_METER_SUMS},"
    f" max(_loaded_at) AS _loaded_at FROM ({USAGE}) GROUP BY bucket_start, model, workspace_id",
)
_PAID_FOR = """coalesce('token:' || token_type, CASE WHEN cost_type = 'web_search' THEN 'fee' END,
  'other:' || coalesce(cost_type, ''))"""
RECONCILED = f"""
SELECT coalesce(m.bucket_start, c.bucket_start) AS bucket_start,
  coalesce(m.bucket_end, c.bucket_end) AS bucket_end,
  CASE WHEN m.paid_for IS NULL THEN c.model ELSE m.model END AS model,
  CASE WHEN m.paid_for IS NULL THEN c.workspace_id ELSE m.workspace_id END AS workspace_id,
  m.token_slot, m.quantity, m.unit, m.label, coalesce(m.paid_for, c.paid_for) AS paid_for, c.amount_usd,
  greatest(m._loaded_at, c._loaded_at) AS _loaded_at,
  m.paid_for IS NULL AS cost_only, c.paid_for IS NULL AS usage_only
FROM (SELECT *, coalesce('token:' || cost_key, 'fee') AS paid_for FROM ({_METERS_OF_START})) m
FULL JOIN (
  SELECT bucket_start, model, workspace_id, {_PAID_FOR} AS paid_for, max(bucket_end) AS bucket_end,
    max(_loaded_at) AS _loaded_at, sum(amount_usd::DECIMAL(18, 4))::DOUBLE AS amount_usd
  FROM ({COST}) WHERE amount_usd IS NOT NULL GROUP BY 1, 2, 3, 4
) c ON m.bucket_start = c.bucket_start AND m.model = c.model
  AND m.workspace_id IS NOT DISTINCT FROM c.workspace_id AND m.paid_for = c.paid_for
"""


def _known(day: str) -> str:
    return newest(f"SELECT * FROM ({tagged('aws_cur', REPORT_ROWS)}) WHERE _loaded_at <= TIMESTAMP '{day}'")


_SAME_CHARGE = " AND ".join(
    f"a.{name} IS NOT DISTINCT FROM b.{name}"
    for name in ("ChargePeriodStart", "ServiceName", "SubAccountId", "ChargeDescription")
)


def _distinct_check(column: str, other: str, expected: int) -> str:
    return f"""
    SELECT '{column}' AS column_name, '{other}' AS other, {expected}::BIGINT AS expected,
      CASE WHEN n <= 2 * {expected} + 1 AND {expected} <= 2 * n + 1 THEN n END AS distinct_count,
      CASE WHEN n = {expected} THEN 0 ELSE 1 END::BIGINT AS violations,
      CASE WHEN n = {expected} THEN 'pass' ELSE 'error' END AS status
    FROM (SELECT count(DISTINCT {other}) FILTER (WHERE {column} IS NOT NULL) AS n FROM r)"""


ORACLE: dict[str, str] = {
    "read_parquet_widen": """
        SELECT l_orderkey AS order_no, l_quantity AS quantity,
          CASE WHEN l_linenumber > 4 THEN 'line ' ELSE '' END || l_linenumber AS line,
          CASE WHEN l_linenumber <= 2 THEN date_trunc('day', l_shipdate) ELSE l_shipdate END::TIMESTAMP AS shipped,
          CASE WHEN l_linenumber <= 4 THEN l_tax END AS tax,
          CASE WHEN l_linenumber <= 4 THEN l_partkey END AS part_key,
          CASE WHEN l_linenumber IN (3, 4) THEN l_suppkey END AS part_supplier,
          CASE WHEN l_linenumber <= 4 THEN l_linenumber::VARCHAR ELSE '-,' || l_orderkey END AS places,
          CASE WHEN l_linenumber > 4 THEN l_returnflag END AS flag
        FROM lineitem""",
    "read_json_auto": """
        SELECT o_orderkey, o_totalprice, o_orderstatus, o_orderdate::VARCHAR AS o_orderdate,
          CASE WHEN o_orderstatus IS DISTINCT FROM 'P' THEN o_custkey END AS custkey,
          CASE WHEN o_orderstatus IS DISTINCT FROM 'P' THEN o_orderpriority END AS priority FROM orders""",
    "map_ai_usage_reconciled": canonical(
        RECONCILED,
        AI_COLUMNS
        | {
            "ChargeCategory": "CASE WHEN cost_only THEN 'Adjustment' WHEN unit = 'Requests' THEN 'Fee' ELSE 'Usage' END",
            "ChargeDescription": "CASE WHEN cost_only THEN coalesce(model, '') || ' - Cost without usage, '"
            " || paid_for ELSE model || ' - ' || label END",
        },
        more=", _loaded_at, token_slot AS _token_type, label AS _token_label",
    ),
    "cost_reconciliation": f"""
        WITH r AS MATERIALIZED ({RECONCILED}), b AS (
          SELECT bucket_start,
            coalesce(sum(amount_usd::DECIMAL(18, 4)) FILTER (WHERE NOT cost_only), 0) AS billed,
            coalesce(sum(amount_usd::DECIMAL(18, 4)) FILTER (WHERE cost_only), 0) AS adjusted,
            count(*) FILTER (WHERE cost_only) AS costs_without_usage,
            count(*) FILTER (WHERE usage_only) AS meters_without_cost
          FROM r GROUP BY 1
        ), s AS (
          SELECT bucket_start, coalesce(sum(amount_usd::DECIMAL(18, 4)), 0) AS staged FROM ({COST}) GROUP BY 1
        )
        SELECT coalesce(b.bucket_start, s.bucket_start) AS bucket_start,
          coalesce(staged, 0)::DOUBLE AS staged, coalesce(billed, 0)::DOUBLE AS billed,
          coalesce(adjusted, 0)::DOUBLE AS adjusted,
          coalesce(costs_without_usage, 0) AS costs_without_usage,
          coalesce(meters_without_cost, 0) AS meters_without_cost, 0::DOUBLE AS difference
        FROM b FULL JOIN s ON b.bucket_start IS NOT DISTINCT FROM s.bucket_start""",
    "upsert_latest": newest(tagged("aws_cur", REPORT_ROWS)),
    "new_files_only": """
        SELECT o_orderkey::VARCHAR AS o_orderkey, o_custkey::VARCHAR AS o_custkey, o_orderstatus,
          o_totalprice::VARCHAR AS o_totalprice, o_orderdate::VARCHAR AS o_orderdate, o_orderpriority
        FROM orders""",
    "v_type_drift": """
        SELECT 'has_more' AS path, 'boolean' AS declared, 'BIGINT' AS found, count(*) AS values,
          count(*) AS documents FROM events
        UNION ALL SELECT 'data[].results', 'array', 'OBJECT', count(*), count(*) FROM events
          WHERE event_type = 'view'
        UNION ALL SELECT 'data[].results[].cache_creation', 'object', 'ARRAY', count(*), count(*) FROM events
          WHERE event_type = 'signup'
        UNION ALL SELECT 'data[].results[].service_tier', 'string', 'BIGINT', count(*), count(*) FROM events
          WHERE event_type = 'signup'
        UNION ALL SELECT 'data[].results[].server_tool_use.web_search_requests', 'bigint', 'STRING', count(*),
          count(*) FROM events WHERE event_type = 'click'
        UNION ALL SELECT '$', 'object', '(unreadable)', count(*), count(*) FROM events
          WHERE event_type = 'error'""",
    "v_suite_incremental": suite(FLAWED),
    "charges_as_of": " UNION ALL ".join(
        f"SELECT *, TIMESTAMP '{day}' AS as_of FROM ("
        + _known(day)
        + ")"
        for day in ("1994-01-01", "1996-07-15", "2030-01-01")
    ),
    "changed_amounts": f"""
        WITH b AS ({_known("1996-07-15")}), a AS ({_known("1996-07-17")})
        SELECT a._provider, a.ChargePeriodStart, a.ServiceName, a.SubAccountId, a.ChargeDescription,
          b.BilledCost AS before, a.BilledCost AS after
        FROM a LEFT JOIN b ON {_SAME_CHARGE} WHERE a.BilledCost IS DISTINCT FROM b.BilledCost""",
    "column_sketch": " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, count(*) AS rows, count(*) FILTER (WHERE {name} IS NULL) AS nulls,"
        f" true AS distinct_within, {'true' if ordered else 'CAST(NULL AS BOOLEAN)'} AS quantiles_within,"
        f" {most} AS most_frequent FROM orders"
        for name, ordered, most in (
            ("o_orderkey", True, "NULL"),
            ("o_custkey", True, "NULL"),
            ("o_orderstatus", False, "(SELECT mode(o_orderstatus) FROM orders)"),
            ("o_totalprice", True, "NULL"),
            ("o_orderdate", True, "NULL"),
            ("o_orderpriority", False, "NULL"),
        )
    ),
    "v_distinct_suite": f"WITH r AS ({OBSERVED}) "
    + " UNION ALL ".join(_distinct_check(*check) for check in DISTINCT_CHECKS),
    "usage_member_counts": f"""
        SELECT model, workspace_id, count(DISTINCT api_key_id) AS api_keys, count(DISTINCT service_tier) AS tiers
        FROM ({USAGE}) GROUP BY model, workspace_id""",
}
