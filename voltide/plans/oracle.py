"""SQL building blocks shared by the checks. They run on the same tables."""

from __future__ import annotations

from collections.abc import Iterable

TRADES = """
ops_orders AS (
  SELECT o.o_orderkey AS op_id, o.o_custkey AS client_id, o.o_orderdate AS close_ts,
         o.o_totalprice AS amount, c.c_mktsegment AS category, o.o_orderpriority AS product,
         CASE o.o_orderstatus WHEN 'F' THEN 'buy' WHEN 'O' THEN 'sell' END AS op_type,
         l.spread, l.closed_rate
  FROM orders o
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN (SELECT l_orderkey, round(avg(l_discount), 6) AS spread,
                    round(1 + avg(l_tax), 6) AS closed_rate
             FROM lineitem GROUP BY l_orderkey) l ON o.o_orderkey = l.l_orderkey
),
ops_events AS (
  SELECT event_id AS op_id, user_id AS client_id, ts AS close_ts, value AS amount,
         event_type AS category,
         CASE event_type WHEN 'purchase' THEN 'buy' WHEN 'click' THEN 'sell' END AS op_type
  FROM events
)"""

LOADED = """
loaded AS (
  SELECT *, avg(amount) OVER (PARTITION BY client_id) AS client_mean_amount,
         avg(amount) OVER (PARTITION BY client_id ORDER BY close_ts, op_id
                           ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS amount_ma_5,
         sum(amount) OVER (PARTITION BY client_id, close_ts) AS daily_volume,
         CAST(month(close_ts) AS INT) AS month, dayname(close_ts) AS day_name,
         close_ts + INTERVAL 7 DAY AS next_ts
  FROM ops_orders
)"""


def _scored(view: str, source: str) -> str:
    return f"""
{view} AS (
  SELECT * FROM (
    SELECT *, avg(amount) OVER (PARTITION BY client_id ORDER BY close_ts, op_id
                                ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS predicted_amount
    FROM {source})
  WHERE predicted_amount IS NOT NULL
)"""


VIEWS = {
    "trades": TRADES,
    "loaded": LOADED,
    "scored_orders": _scored("scored_orders", "ops_orders"),
    "scored_events": _scored("scored_events", "ops_events"),
}


def sql(body: str, *views: str, extra: str = "") -> str:
    """``body`` after the named views; ``extra`` holds further views."""
    parts = [VIEWS["trades"], *[VIEWS[v] for v in views]]
    if extra:
        parts.append(extra)
    return "WITH " + ",".join(parts) + "\n" + body


def r(expression: str, name: str, digits: int = 6) -> str:
    return f'round({expression}, {digits}) AS "{name}"'


def rs(columns: Iterable[str], digits: int = 6) -> str:
    return ", ".join(r(f'"{c}"', c, digits) for c in columns)


def over_client(fn: str, column: str, rows: int, shift: int = 0) -> str:
    return (
        f"{fn}({column}) OVER (PARTITION BY client_id ORDER BY close_ts, op_id "
        f"ROWS BETWEEN {rows - 1 + shift} PRECEDING AND "
        f"{'CURRENT ROW' if not shift else f'{shift} PRECEDING'})"
    )


def over_table(fn: str, column: str, rows: int) -> str:
    return (
        f"{fn}({column}) OVER (ORDER BY close_ts, op_id "
        f"ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)"
    )
