"""Query registration and shared oracle fragments.

``CTES`` are named SQL fragments; an oracle lists only its own body and gets the
fragments it mentions (and theirs) in front.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans.specs import ASSET_CODES, DAILY_SERIES, MONTHLY_SERIES
from tidemark.sources.sample import EVENT_CODE, EVENT_INVESTOR, PRIORITY_ROLE, STATUS_SCOPE, Sample

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
CTES: dict[str, str] = {}


def expand(body: str) -> str:
    """Prepend every fragment the body refers to, in definition order."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(CTES[name])

    visit(body)
    if not needed:
        return body.strip()
    parts = [f"{n} AS ({CTES[n].strip()})" for n in CTES if n in needed]
    body = body.strip()
    joint = ",\n" + body[5:] if body.startswith("WITH ") else "\n" + body
    return "WITH " + ",\n".join(parts) + joint


def query(name: str, sql: str | None = None):
    """Register ``fn(sample) -> DataFrame`` under ``name`` with its oracle."""

    def wrap(fn: Callable[[Sample], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, folder: fn(Sample(spark, folder))
        if sql is not None:
            ORACLES[name] = expand(sql)
        return fn

    return wrap


def r(x: str, digits: int = 6) -> str:
    """Half-up rounding of the shortest decimal form of a double (no negative zero)."""
    return f"CAST(round(CAST(CAST(({x})::DOUBLE AS VARCHAR) AS DECIMAL(38, 20)), {digits}) AS DOUBLE)"


def sql_map(mapping: dict[str, str], c: str) -> str:
    return "CASE " + c + " " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items()) + " END"


def sql_list(names: list[str], index: str) -> str:
    return "[" + ", ".join(f"'{n}'" for n in names) + f"][({index}) + 1]"


def sql_clip(x: str, lo: float = -3.0, hi: float = 3.0) -> str:
    return f"(CASE WHEN ({x}) IS NOT NULL THEN greatest({lo}::DOUBLE, least({hi}::DOUBLE, {x})) END)"


def sql_mean(*xs: str) -> str:
    """Mean over the non-null inputs."""
    total = " + ".join(f"coalesce({x}, 0)" for x in xs)
    n = " + ".join(f"(({x}) IS NOT NULL)::INT" for x in xs)
    return f"(({total})::DOUBLE / nullif({n}, 0))"


def sql_roll(fn: str, x: str, n: int, mp: int, win: str) -> str:
    """Windowed aggregate over the last n rows with a minimum of non-null values."""
    frame = f"({win} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"(CASE WHEN count({x}) OVER {frame} >= {mp} THEN {fn}({x}) OVER {frame} END)"


_CENTS = "CAST(round({0} * 100) AS BIGINT)"


def _price(c: str) -> str:
    x = _CENTS.format(c)
    return f"sum({x})::DOUBLE / count(*) / 100.0::DOUBLE AS close, sum({x})::DOUBLE / 100.0::DOUBLE AS value"


CTES["stock_prices"] = f"""
SELECT lpad(l_suppkey::VARCHAR, 6, '0') AS ticker, l_shipdate::DATE AS date, {_price('l_extendedprice')},
       sum(l_quantity) AS volume FROM lineitem GROUP BY 1, 2"""
CTES["scope_prices"] = f"""
SELECT {sql_map(STATUS_SCOPE, 'o_orderstatus')} AS market_scope, o_orderdate::DATE AS date, {_price('o_totalprice')}
FROM orders GROUP BY 1, 2"""
CTES["market_prices"] = f"""
SELECT ticker, date, {_price('p')} FROM (
  SELECT {sql_map(STATUS_SCOPE, 'o_orderstatus')} AS ticker, o_orderdate::DATE AS date, o_totalprice AS p FROM orders
  UNION ALL
  SELECT {sql_map(PRIORITY_ROLE, 'o_orderpriority')}, o_orderdate::DATE, o_totalprice FROM orders) GROUP BY 1, 2"""
CTES["theme_prices"] = f"""
SELECT 'theme_' || l_linenumber AS theme_bucket, l_shipdate::DATE AS date, {_price('l_extendedprice')}
FROM lineitem GROUP BY 1, 2"""
CTES["daily_obs"] = f"""
SELECT {sql_list(DAILY_SERIES, f'l_partkey % {len(DAILY_SERIES)}')} AS series_id, l_shipdate::DATE AS asof_date,
       sum(l_quantity) / count(*) AS value FROM lineitem GROUP BY 1, 2"""
CTES["monthly_obs"] = f"""
SELECT {sql_list(MONTHLY_SERIES, f'l_suppkey % {len(MONTHLY_SERIES)}')} AS series_id,
       date_trunc('month', l_shipdate)::DATE AS asof_date, sum(l_quantity) AS value FROM lineitem GROUP BY 1, 2"""
CTES["asset_prices"] = f"""
SELECT *, CASE WHEN day(asof_date) % 5 <> 0 THEN close * 0.98::DOUBLE END AS adj_close FROM (
  SELECT {sql_list(ASSET_CODES, f'l_partkey % {len(ASSET_CODES)}')} AS asset_code, l_shipdate::DATE AS asof_date,
         {_price('l_extendedprice')} FROM lineitem GROUP BY 1, 2)"""
CTES["flows"] = f"""
SELECT ts::DATE AS date, lpad(user_id::VARCHAR, 6, '0') AS ticker, {sql_map(EVENT_INVESTOR, 'event_type')} AS investor,
       CASE WHEN user_id % 2 = 0 THEN 'KOSPI' ELSE 'KOSDAQ' END AS market,
       sum({_CENTS.format('value')} - 5000)::DOUBLE / 100.0::DOUBLE AS net_value, count(*) AS net_volume
FROM events GROUP BY 1, 2, 3, 4"""
CTES["classification"] = """
SELECT lpad(c_custkey::VARCHAR, 6, '0') AS ticker, r_name AS market, n_name AS theme_bucket, c_mktsegment AS asset_type
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
CTES["snapshots"] = f"""
SELECT event_id, ts AS asof_ts, ts::DATE AS session_date, {sql_map(EVENT_CODE, 'event_type')} AS signal_code,
       ({_CENTS.format('value')} - 5000)::DOUBLE / 500000.0::DOUBLE AS change_pct, value AS metric_value,
       props AS detail_json, user_id FROM events"""
CTES["bars"] = f"""
SELECT time_bucket(INTERVAL 15 MINUTE, ts) AS asof_ts, {sql_map(EVENT_CODE, 'event_type')} AS signal_code,
       sum({_CENTS.format('value')} - 5000)::DOUBLE / count(*) / 500000.0::DOUBLE AS change_pct, count(*) AS n
FROM events GROUP BY 1, 2"""
CTES["spine"] = "SELECT DISTINCT o_orderdate::DATE AS asof_date FROM orders"
CTES["predictions"] = f"""
SELECT model, market_scope, forecast_horizon, asof_date, 'q40_q60' AS label_policy, year(asof_date) AS test_year,
       CASE c % 3 WHEN 0 THEN 'down' WHEN 1 THEN 'sideways' ELSE 'up' END AS actual_label,
       wd / (wd + ws + wu)::DOUBLE AS prob_down, ws / (wd + ws + wu)::DOUBLE AS prob_sideways,
       wu / (wd + ws + wu)::DOUBLE AS prob_up
FROM (SELECT 'm' || (o_orderkey % 2) AS model, {sql_map(STATUS_SCOPE, 'o_orderstatus')} AS market_scope,
             h || 'd' AS forecast_horizon, o_orderdate::DATE AS asof_date,
             sum(1 + (o_orderkey * 7 + h) % 11)::BIGINT AS wd, sum(1 + (o_orderkey * 13 + h) % 7)::BIGINT AS ws,
             sum(1 + (o_orderkey * 17 + h) % 13)::BIGINT AS wu, sum({_CENTS.format('o_totalprice')})::BIGINT AS c
      FROM orders, (VALUES (5), (20)) t(h) GROUP BY 1, 2, 3, 4)"""

CTES["scores"] = f"""
SELECT event_id, event_type, user_id, ts,
       CASE WHEN event_id % 17 <> 0 THEN (c % 700 - 350)::DOUBLE / 100.0::DOUBLE END AS s1,
       CASE WHEN event_id % 19 <> 0 THEN ((c * 3 + event_id) % 700 - 350)::DOUBLE / 100.0::DOUBLE END AS s2,
       CASE WHEN event_id % 23 <> 0 THEN ((c * 7 + event_id * 11) % 700 - 350)::DOUBLE / 100.0::DOUBLE END AS s3,
       (c % 101)::DOUBLE / 100.0::DOUBLE AS u1, ((c + event_id) % 101)::DOUBLE / 100.0::DOUBLE AS u2
FROM (SELECT *, {_CENTS.format('value')} AS c FROM events)"""
