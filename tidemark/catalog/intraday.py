"""Streaming queries (D1-D10): a file stream is drained and compared with batch SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.expressions import rd
from tidemark.catalog.registry import CTES, query, r, sql_clip, sql_mean
from tidemark.functions import labels as L
from tidemark.plans import panels as PN
from tidemark.sources.sample import EVENT_CODE, cents, mapped
from tidemark.streaming import intraday as D

CLOSED = "(SELECT max(ts) - INTERVAL 10 MINUTE FROM events)"
CTES["d_raw"] = "SELECT asof_ts, signal_code, change_pct, CASE WHEN signal_code IN ('1001', '2001', '1028') THEN change_pct END AS ix, metric_value, session_date, user_id FROM snapshots"
CTES["d_slots"] = f"""SELECT time_bucket(INTERVAL 15 MINUTE, asof_ts) AS slot, avg(ix) AS index_change, count(ix) AS index_rows, count(*) FILTER (ix > 0)::DOUBLE / nullif(count(ix), 0) AS pos, (count(*) FILTER (ix > 0) + 1)::DOUBLE / (count(*) FILTER (ix < 0) + 1) AS adr,
  (arg_max(ix, asof_ts) FILTER (ix IS NOT NULL) - min(ix)) / nullif(max(ix) - min(ix), 0) AS rp, avg(change_pct) FILTER (signal_code = 'USDKRW') AS fx, avg(change_pct) FILTER (signal_code = 'FUT') AS fut, avg(change_pct) FILTER (signal_code = '1028') AS large
FROM d_raw GROUP BY 1 HAVING time_bucket(INTERVAL 15 MINUTE, min(asof_ts)) + INTERVAL 15 MINUTE <= {CLOSED}"""
CTES["d_scores"] = f"""SELECT *, {sql_clip('dir * 0.55::DOUBLE + br * 0.20::DOUBLE + rk * 0.25::DOUBLE')} AS total FROM (SELECT *, CASE WHEN index_rows > 0 THEN {sql_clip('coalesce(index_change, 0) * 120')} ELSE 0 END AS dir,
  CASE WHEN index_rows > 0 AND pos IS NOT NULL THEN {sql_clip('(pos - 0.5::DOUBLE) * 6 + ln(greatest(adr, 0.000001::DOUBLE)) * 0.8::DOUBLE')} ELSE 0 END AS br,
  CASE WHEN index_rows > 0 THEN {sql_clip('(coalesce(rp, 0.5::DOUBLE) - 0.5::DOUBLE) * 4 - abs(coalesce(index_change, 0)) * 35 - coalesce(fx, 0) * 30')} ELSE 0 END AS rk FROM d_slots)"""


def stream(t):
    """The events file as a snapshot stream."""
    schema = t.table("events").schema
    e = D.landing_stream(t.spark, t.folder, schema, "events.parquet")
    return e.select("event_id", F.col("ts").alias("asof_ts"), F.col("ts").cast("date").alias("session_date"), mapped(EVENT_CODE, "event_type").alias("signal_code"),
                    ((cents("value") - 5000) / 500000.0).alias("change_pct"), F.col("value").alias("metric_value"), "user_id")


@query("d1_idempotent_ingest", "SELECT event_id, ts AS asof_ts, user_id FROM events")
def d1(t):
    twice = stream(t).select("event_id", "asof_ts", "user_id")
    twice = twice.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    return D.run_to_table(D.deduplicated(twice, ["event_id"], "asof_ts"))


@query("d2_intraday_state", f"""
SELECT slot AS asof_ts, {r('dir', 4)} AS direction_score, {r('br', 4)} AS breadth_score, {r('rk', 4)} AS risk_score, {r('total', 4)} AS total_score, CASE WHEN index_rows = 0 THEN 'fallback_prev_close' ELSE 'live' END AS session_status,
  CASE WHEN index_rows = 0 THEN '전일 기준 참고' WHEN total >= 1 THEN '강세' WHEN total >= 0.2 THEN '소폭 강세' WHEN total > -0.2 THEN '혼조' WHEN total > -1 THEN '약세' ELSE '강한 약세' END AS direction_label FROM d_scores""")
def d2(t):
    out = D.run_to_table(D.intraday_state(D.intraday_inputs(stream(t), "asof_ts", "signal_code", "change_pct")))
    return out.select("asof_ts", *[rd(c, 4).alias(c) for c in ("direction_score", "breadth_score", "risk_score", "total_score")], "session_status", "direction_label")


@query("d3_reference_close_fallback", f"""
SELECT s.event_id, {r('coalesce(CASE WHEN s.event_id % 5 <> 0 THEN s.metric_value END, c.close)', 4)} AS price_used, CASE WHEN s.event_id % 5 <> 0 THEN 0 WHEN c.close IS NOT NULL THEN 1 ELSE 2 END AS fallback_tier FROM snapshots s LEFT JOIN (
  SELECT CASE market_scope WHEN 'KOSPI' THEN '1001' WHEN 'KOSDAQ' THEN '2001' ELSE '1028' END AS signal_code, arg_max(close, date) AS close FROM scope_prices GROUP BY 1) c USING (signal_code)""")
def d3(t):
    from tidemark.operators.relational import latest_per_key

    code = L.lookup({"KOSPI": "1001", "KOSDAQ": "2001", "KOSPI200": "1028"}, "market_scope")
    closes = latest_per_key(t.scope_prices.select("market_scope", "date", "close"), ["market_scope"], ["date"]).select(code.alias("signal_code"), "close")
    live = stream(t).withColumn("price", F.when(F.col("event_id") % 5 != 0, F.col("metric_value")))
    out = D.run_to_table(D.with_reference_close(live, closes, "signal_code", "price", "close"))
    return out.select("event_id", rd("price_used", 4).alias("price_used"), "fallback_tier")


@query("d4_staleness", """
SELECT session_date, (date_diff('second', max(asof_ts), session_date::TIMESTAMP + INTERVAL 24 HOUR) > 2700)::INT AS is_stale FROM snapshots WHERE signal_code = '1001' GROUP BY 1""")
def d4(t):
    last = t.snapshots.where(F.col("signal_code") == "1001").groupBy("session_date").agg(F.max("asof_ts").alias("last_ts"))
    end = F.col("session_date").cast("timestamp_ntz") + F.expr("INTERVAL 24 HOURS")
    return last.select("session_date", D.stale(end, F.col("last_ts")).cast("int").alias("is_stale"))


@query("d5_session_close", f"""
SELECT session_date, signal_code, arg_max(metric_value, asof_ts) AS metric_value, max(asof_ts) AS last_ts, count(*) AS n FROM snapshots GROUP BY 1, 2 HAVING session_date + INTERVAL 1 DAY <= {CLOSED}""")
def d5(t):
    return D.run_to_table(D.session_close(stream(t), "asof_ts", "signal_code", "metric_value"))


@query("d6_futures_and_flow_overlay", f"""
SELECT slot AS asof_ts, {r('fut - large')} AS relative_gap, CASE WHEN fut - large IS NULL THEN 'missing' WHEN fut - large >= 0.002 THEN 'futures_above_spot' WHEN fut - large <= -0.002 THEN 'futures_below_spot' ELSE 'in_line' END AS relative_label,
  CASE WHEN (coalesce(index_change, 0) < 0)::INT + (coalesce(fx, 0) < 0)::INT + (coalesce(fut, 0) < 0)::INT >= 2 THEN 'net_selling' WHEN (coalesce(index_change, 0) > 0)::INT + (coalesce(fx, 0) > 0)::INT + (coalesce(fut, 0) > 0)::INT >= 2 THEN 'net_buying' ELSE 'mixed' END AS flow_side FROM d_slots""")
def d6(t):
    out = D.run_to_table(D.overlays(D.intraday_inputs(stream(t), "asof_ts", "signal_code", "change_pct"), ["index_change", "fx_change", "futures_change"]))
    return out.select("asof_ts", rd("relative_gap").alias("relative_gap"), "relative_label", "flow_side")


@query("d7_intraday_environment", f"""
SELECT slot AS asof_ts, {r(sql_clip(sql_mean(sql_clip('index_change * 20'), sql_clip('fut * 18'), sql_clip('fx * -80'), 'rk')), 5)} AS environment_score FROM d_scores""")
def d7(t):
    states = D.intraday_state(D.intraday_inputs(stream(t), "asof_ts", "signal_code", "change_pct"))
    return D.run_to_table(D.environment(states)).select("asof_ts", rd("environment_score", 5).alias("environment_score"))


@query("d8_current_point_override", """
SELECT signal_code, session_date AS date, CASE WHEN day(session_date) >= 20 THEN arg_max(metric_value, asof_ts) ELSE max(metric_value) END AS metric_value, CASE WHEN day(session_date) >= 20 THEN 'current_intraday_quote' ELSE 'daily' END AS point_type
FROM snapshots GROUP BY 1, 2""")
def d8(t):
    s = t.snapshots.withColumn("date", F.col("session_date"))
    daily = s.groupBy("signal_code", "date").agg(F.max("metric_value").alias("metric_value"))
    live = s.where(F.dayofmonth("date") >= 20).groupBy("signal_code", "date").agg(F.max_by("metric_value", "asof_ts").alias("metric_value"))
    return PN.current_point(daily, live, "signal_code", "date", "metric_value")


DP = "PARTITION BY signal_code ORDER BY slot"
CTES["d_bars"] = f"""SELECT signal_code, slot, s, CASE WHEN s >= 0.4 THEN 'up' WHEN s > -0.4 THEN 'flat' ELSE 'down' END AS label FROM (SELECT signal_code, time_bucket(INTERVAL 15 MINUTE, asof_ts) AS slot, round(avg(change_pct) * 120, 9) AS s FROM snapshots GROUP BY 1, 2) WHERE slot + INTERVAL 15 MINUTE <= {CLOSED}"""


@query("d9_state_change_stream", f"""
SELECT signal_code AS key, slot AS asof_ts, label, lag(label) OVER ({DP}) AS prev_label, CASE WHEN lag(s) OVER ({DP}) IS NULL OR abs(s - lag(s) OVER ({DP})) <= 1e-9 THEN 'unchanged' WHEN s > lag(s) OVER ({DP}) THEN 'stronger' ELSE 'weaker' END AS change_direction,
  {r('''date_diff('second', max(CASE WHEN chg THEN slot END) OVER (PARTITION BY signal_code ORDER BY slot), slot) / 3600.0::DOUBLE''', 4)} AS state_hours, material AS material_change FROM (
  SELECT *, coalesce(lag(label) OVER ({DP}) <> label, true) AS chg, (lag(label) OVER ({DP}) IS NULL OR lag(label) OVER ({DP}) <> label OR abs(s - lag(s) OVER ({DP})) >= 0.35 OR sign(s) <> sign(lag(s) OVER ({DP})))::INT AS material FROM d_bars)""")
def d9(t):
    closed = D.bars(stream(t), "asof_ts", "signal_code", "change_pct")
    landed = D.landing_stream(t.spark, D.run_to_folder(closed), closed.schema)
    live = landed.withColumn("score", F.round(F.col("change_pct") * 120, 9))
    live = live.withColumn("label", L.ladder("score", [(">=", 0.4, "up"), (">", -0.4, "flat")], "down"))
    out = D.run_to_table(D.state_changes(live, "signal_code", "asof_ts", "label", "score"), empty_batches=False)
    return out.drop("score").withColumn("state_hours", rd("state_hours", 4))


@query("d10_material_change_emission", f"""
SELECT signal_code AS key, slot AS asof_ts FROM (SELECT *, (lag(label) OVER ({DP}) IS NULL OR lag(label) OVER ({DP}) <> label OR abs(s - lag(s) OVER ({DP})) >= 0.35 OR sign(s) <> sign(lag(s) OVER ({DP})))::INT AS m FROM d_bars) WHERE m = 1""")
def d10(t):
    return d9(t).where(F.col("material_change") == 1).select("key", "asof_ts")
