"""Queries by name, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE_SQL: dict[str, str] = {}

#: Ticks of the events table, for the SQL twins: exact cents and whole quantities beside the decimals.
TICKS_SQL = """WITH t AS (
  SELECT event_type AS symbol, event_id AS trade_id, ts, CAST(round(value * 100) AS BIGINT) AS cents, CAST(value AS DECIMAL(18,8)) AS price,
         CAST(json_extract_string(props, '$.k') AS BIGINT) + 1 AS q, CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) + 1 AS DECIMAL(18,8)) AS quantity,
         user_id % 2 = 1 AS is_buyer_maker, CAST(ts AS DATE) AS date
  FROM events WHERE value > 0)"""


def query(name: str, sql: str | None = None, raw: bool = False):
    """Register a query; sql continues after the tick table t, unless raw."""

    def add(f: Callable) -> Callable:
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql if raw else f"{TICKS_SQL}\n{sql}"
        return f

    return add


from .queries import aggregates, bars, flows, further, more, own, quality, rolling, series, stateful  # noqa: E402, F401  they register themselves
