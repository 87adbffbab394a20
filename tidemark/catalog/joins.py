"""Join queries, equality and point-in-time."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.expressions import rd
from tidemark.catalog.registry import query, r
from tidemark.functions import labels as L
from tidemark.functions import numeric as N
from tidemark.operators import asof as A
from tidemark.operators import relational as R
from tidemark.operators import windows as W
from tidemark.operators.windows import Axis
from tidemark.plans.specs import CONFIDENCE_FLOORS, RULE_PROFILES

SCOPE = Axis.of("market_scope", "date")
PS = "PARTITION BY market_scope ORDER BY date"
FWD = f"(SELECT market_scope, date, lead(close, 5) OVER ({PS}) / close - 1 AS fwd FROM scope_prices)"


def forward(t):
    return t.scope_prices.select("market_scope", "date", W.forward_return(SCOPE, "close", 5).alias("fwd"))


@query("j1_date_context_join", """
SELECT s.ticker, s.date, s.close, c.close AS fx_close FROM stock_prices s
LEFT JOIN (SELECT date, close FROM market_prices WHERE ticker = 'USDKRW') c ON s.date = c.date""")
def j1(t):
    context = t.market_prices.where(F.col("ticker") == "USDKRW").select("date", F.col("close").alias("fx_close"))
    return R.star_join(t.stock_prices.select("ticker", "date", "close"), [(context, ["date"])])


@query("j2_composite_key_join", f"""
SELECT p.model, p.market_scope, p.forecast_horizon, p.asof_date, {r('f.fwd')} AS fwd FROM predictions p
LEFT JOIN {FWD} f ON p.market_scope = f.market_scope AND p.asof_date = f.date""")
def j2(t):
    right = forward(t).withColumnRenamed("date", "asof_date")
    out = t.predictions.join(right, ["market_scope", "asof_date"], "left")
    return out.select("model", "market_scope", "forecast_horizon", "asof_date", rd("fwd").alias("fwd"))


@query("j3_star_join", f"""
SELECT p.market_scope, p.date, p.close, {r('f.fwd')} AS fwd, m.close AS gold_close, o.n AS order_count FROM scope_prices p
LEFT JOIN {FWD} f USING (market_scope, date) LEFT JOIN (SELECT date, close FROM market_prices WHERE ticker = 'GOLD') m ON p.date = m.date
LEFT JOIN (SELECT o_orderdate::DATE AS d, count(*) AS n FROM orders GROUP BY 1) o ON p.date = o.d""")
def j3(t):
    gold = t.market_prices.where(F.col("ticker") == "GOLD").select("date", F.col("close").alias("gold_close"))
    counts = t.table("orders").groupBy(F.col("o_orderdate").cast("date").alias("date")).agg(F.count(F.lit(1)).alias("order_count"))
    base = t.scope_prices.select("market_scope", "date", "close")
    out = R.star_join(base, [(forward(t), ["market_scope", "date"]), (gold, ["date"]), (counts, ["date"])])
    return out.withColumn("fwd", rd("fwd"))


@query("j4_inner_join", f"""
SELECT count(*) AS n, {r('avg(f.fwd * (p.prob_up - p.prob_down))')} AS edge FROM predictions p JOIN {FWD} f
ON p.market_scope = f.market_scope AND p.asof_date = f.date WHERE f.fwd IS NOT NULL""")
def j4(t):
    right = forward(t).where(F.col("fwd").isNotNull()).withColumnRenamed("date", "asof_date")
    out = t.predictions.join(right, ["market_scope", "asof_date"])
    return out.agg(F.count(F.lit(1)).alias("n"), rd(F.avg(F.col("fwd") * (F.col("prob_up") - F.col("prob_down")))).alias("edge"))


@query("j5_full_outer_by_date", """
SELECT coalesce(a.date, b.date) AS date, a.close AS orders_close, b.value AS shipped_value
FROM (SELECT * FROM scope_prices WHERE market_scope = 'KOSPI') a
FULL JOIN (SELECT date, value FROM theme_prices WHERE theme_bucket = 'theme_1') b ON a.date = b.date""")
def j5(t):
    a = t.scope_prices.where(F.col("market_scope") == "KOSPI").select("date", F.col("close").alias("orders_close"))
    b = t.theme_prices.where(F.col("theme_bucket") == "theme_1").select("date", F.col("value").alias("shipped_value"))
    return a.join(b, "date", "full")


@query("j6_scope_columns_back", f"""
SELECT p.market_scope, p.date, {r('k.a')} AS kospi_ret, {r('k.b')} AS kosdaq_ret FROM scope_prices p LEFT JOIN (
  SELECT date, max(ret) FILTER (market_scope = 'KOSPI') AS a, max(ret) FILTER (market_scope = 'KOSDAQ') AS b FROM (
    SELECT *, close / nullif(lag(close, 20) OVER ({PS}), 0) - 1 AS ret FROM scope_prices) GROUP BY 1) k USING (date)""")
def j6(t):
    rets = t.scope_prices.select("market_scope", "date", W.lag_return(SCOPE, "close", 20).alias("ret"))
    wide = rets.groupBy("date").agg(*[rd(F.max(F.when(F.col("market_scope") == s, F.col("ret")))).alias(f"{s.lower()}_ret") for s in ("KOSPI", "KOSDAQ")])
    return rets.select("market_scope", "date").join(wide, "date", "left")


@query("j7_spine_grid", """
SELECT s.asof_date, g.scope AS market_scope, p.close FROM spine s CROSS JOIN (VALUES ('ALL'), ('KOSPI'), ('KOSDAQ')) g(scope)
LEFT JOIN scope_prices p ON p.date = s.asof_date AND p.market_scope = g.scope""")
def j7(t):
    grid = A.grid(t.spine, "market_scope", ["ALL", "KOSPI", "KOSDAQ"])
    return grid.join(t.scope_prices.select(F.col("date").alias("asof_date"), "market_scope", "close"), ["asof_date", "market_scope"], "left")


@query("j8_semi_join", """
SELECT date, count(*) AS n, sum(net_volume)::BIGINT AS volume FROM flows WHERE ticker IN (
  SELECT lpad(c_custkey::VARCHAR, 6, '0') FROM customer WHERE c_mktsegment = 'BUILDING') GROUP BY 1""")
def j8(t):
    active = t.table("customer").where(F.col("c_mktsegment") == "BUILDING").select(F.lpad(F.col("c_custkey").cast("string"), 6, "0").alias("ticker"))
    return t.flows.join(active, "ticker", "left_semi").groupBy("date").agg(F.count(F.lit(1)).alias("n"), F.sum("net_volume").alias("volume"))


@query("j9_missing_keys", """
SELECT s.asof_date AS date, g.scope AS market_scope FROM spine s CROSS JOIN (VALUES ('KOSPI'), ('KOSDAQ'), ('KOSPI200')) g(scope)
WHERE NOT EXISTS (SELECT 1 FROM scope_prices p WHERE p.date = s.asof_date AND p.market_scope = g.scope)""")
def j9(t):
    expected = A.grid(t.spine.withColumnRenamed("asof_date", "date"), "market_scope", ["KOSPI", "KOSDAQ", "KOSPI200"])
    return R.missing_keys(expected, t.scope_prices, ["date", "market_scope"])


@query("j10_crosswalk_fan_out", """
SELECT coalesce(r_name, theme_bucket) AS bucket, date, count(*) AS members, sum(volume)::DOUBLE AS volume FROM (
  SELECT 'NATION_' || (ticker::BIGINT % 25) AS theme_bucket, date, volume FROM stock_prices) s
JOIN nation ON n_name = theme_bucket JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2""")
def j10(t):
    n, g = t.table("nation"), t.table("region")
    walk = n.join(g, n["n_regionkey"] == g["r_regionkey"]).select(F.col("n_name").alias("theme_bucket"), "r_name")
    rows = t.stock_prices.withColumn("theme_bucket", F.concat(F.lit("NATION_"), (F.col("ticker").cast("bigint") % 25).cast("string")))
    out = rows.join(walk, "theme_bucket").withColumn("bucket", F.coalesce("r_name", "theme_bucket"))
    return out.groupBy("bucket", "date").agg(F.count(F.lit(1)).alias("members"), F.sum("volume").alias("volume"))


@query("j11_overlay_actuals", """
SELECT s.asof_date, coalesce(p.close, 0::DOUBLE) AS close, CASE WHEN p.close IS NULL THEN 'not_available' ELSE 'actual' END AS source_quality
FROM spine s LEFT JOIN scope_prices p ON p.date = s.asof_date AND p.market_scope = 'KOSPI'""")
def j11(t):
    base = t.spine.withColumns({"close": F.lit(0.0), "source_quality": F.lit("not_available")})
    actual = t.scope_prices.where(F.col("market_scope") == "KOSPI").select(
        F.col("date").alias("asof_date"), "close", F.lit("actual").alias("source_quality"))
    return R.overlay(base, actual, ["asof_date"], ["close", "source_quality"])


@query("j12_forward_asof", """
SELECT m.series_id, m.asof_date AS source_date, min(s.asof_date) AS event_date FROM monthly_obs m JOIN spine s
ON s.asof_date >= m.asof_date + 21 GROUP BY 1, 2""")
def j12(t):
    obs = t.monthly_obs.select("series_id", F.col("asof_date").alias("source_date"))
    return A.asof_forward(obs, t.spine, "source_date", 21).select("series_id", "source_date", "event_date")


@query("j13_monthly_asof", f"""
SELECT s.asof_date, m.series_id, m.value, {r('m.yoy')} AS yoy FROM (SELECT k.*, s.asof_date FROM spine s CROSS JOIN (SELECT DISTINCT series_id FROM monthly_obs) k) s
ASOF JOIN (SELECT *, asof_date + 21 AS usable, value / nullif(lag(value, 12) OVER (PARTITION BY series_id ORDER BY asof_date), 0) - 1 AS yoy FROM monthly_obs) m
ON s.series_id = m.series_id AND s.asof_date >= m.usable""")
def j13(t):
    monthly = t.monthly_obs.withColumn("yoy", rd(W.year_over_year(Axis.of("series_id", "asof_date"), "value")))
    out = A.monthly_asof(t.spine, monthly.withColumnRenamed("asof_date", "obs_date"), "series_id", "obs_date", ["value", "yoy"])
    return out.select("asof_date", "series_id", "value", "yoy")


@query("j14_threshold_by_year", """
WITH tuned AS (SELECT market_scope, year(date) AS y, count(*) / 1000.0::DOUBLE AS up_threshold FROM scope_prices WHERE year(date) % 2 = 1 GROUP BY 1, 2)
SELECT p.market_scope, p.date, t.up_threshold, t.y AS threshold_year FROM scope_prices p
LEFT JOIN tuned t ON t.market_scope = p.market_scope AND t.y = (SELECT max(y) FROM tuned u WHERE u.market_scope = p.market_scope AND u.y <= year(p.date))""")
def j14(t):
    p = t.scope_prices.select("market_scope", "date")
    tuned = p.where(F.year("date") % 2 == 1).groupBy("market_scope", F.year("date").alias("y")).agg((F.count(F.lit(1)) / 1000.0).alias("up_threshold"))
    return A.threshold_by_year(p, tuned, ["market_scope"], F.year("date"), "y", ["up_threshold"])


@query("j15_backward_asof", """
SELECT l.event_id, l.user_id, l.ts, m.event_id AS matched_id, m.value AS matched_value FROM (SELECT * FROM events WHERE event_type = 'click') l
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') m ON l.user_id = m.user_id AND l.ts >= m.ts""")
def j15(t):
    e = t.table("events")
    left = e.where(F.col("event_type") == "click").select("event_id", "user_id", "ts")
    right = e.where(F.col("event_type") == "purchase").select("user_id", "ts", F.col("event_id").alias("matched_id"), F.col("value").alias("matched_value"))
    return A.asof_backward(left, right, ["user_id"], "ts", "ts", ["matched_id", "matched_value"], bucket_unit="day")


@query("j15_latest_session_snapshot", f"""
WITH states AS (SELECT asof_ts, CASE WHEN n % 3 = 0 THEN 'fallback_prev_close' ELSE 'live' END AS status, change_pct FROM bars WHERE signal_code = '1001' AND hour(asof_ts) >= 9),
want AS (SELECT asof_date::TIMESTAMP + INTERVAL 10 HOUR AS want_ts FROM (SELECT DISTINCT ts::DATE AS asof_date FROM events))
SELECT want_ts, coalesce(s.asof_ts, l.asof_ts) AS snapshot_ts, CASE WHEN s.asof_ts IS NOT NULL THEN 0 WHEN l.asof_ts IS NOT NULL THEN 1 END AS previous_session,
  {r('coalesce(s.change_pct, l.change_pct)')} AS change_pct FROM (SELECT want_ts, (SELECT max(asof_ts) FROM states WHERE asof_ts::DATE = want_ts::DATE AND asof_ts <= want_ts) AS same,
  (SELECT max(asof_ts) FROM states WHERE status = 'live' AND asof_ts <= want_ts AND asof_ts >= want_ts - INTERVAL 7 DAYS) AS recent FROM want) w
LEFT JOIN states s ON s.asof_ts = w.same LEFT JOIN states l ON l.asof_ts = w.recent AND w.same IS NULL""")
def j15_tiers(t):
    states = t.bars.where((F.col("signal_code") == "1001") & (F.hour("asof_ts") >= 9)).select(
        "asof_ts", F.when(F.col("n") % 3 == 0, "fallback_prev_close").otherwise("live").alias("status"), "change_pct")
    days = t.table("events").select(F.col("ts").cast("date").alias("d")).distinct()
    want = days.select((F.col("d").cast("timestamp_ntz") + F.expr("INTERVAL 10 HOURS")).alias("want_ts"))
    out = A.latest_session_snapshot(want, states, "want_ts", "asof_ts", "status", ["change_pct"])
    return out.withColumn("change_pct", rd("change_pct"))


@query("j16_latest_per_key", """
SELECT user_id, max(ts) AS ts, arg_max(event_id, ts) AS event_id FROM events GROUP BY 1""")
def j16(t):
    return R.latest_per_key(t.table("events").select("user_id", "ts", "event_id"), ["user_id"], ["ts"])


@query("j17_pit_shift", """
SELECT market_scope, asof_date, arg_max(close, date) AS close, max(date) AS date FROM (
  SELECT *, (date + CASE isodow(date) WHEN 5 THEN 3 WHEN 6 THEN 2 ELSE 1 END::INT)::DATE AS asof_date FROM scope_prices)
WHERE asof_date BETWEEN DATE '1995-06-01' AND DATE '2001-06-30' GROUP BY 1, 2""")
def j17(t):
    return A.pit_shift(t.scope_prices.select("market_scope", "date", "close"), "date", F.lit("1995-06-01").cast("date"),
                       F.lit("2001-06-30").cast("date"), keys=["market_scope"])


@query("j18_benchmark_excess", f"""
SELECT f.market_scope, f.date, {r('f.fwd - b.fwd')} AS excess FROM {FWD} f LEFT JOIN (SELECT date, fwd FROM {FWD} WHERE market_scope = 'KOSPI200') b USING (date)""")
def j18(t):
    out = R.with_benchmark(forward(t), ["date"], "market_scope", "KOSPI200", "fwd", "bench")
    return out.select("market_scope", "date", rd(F.col("fwd") - F.col("bench")).alias("excess"))


@query("j19_attach_with_default", """
SELECT lpad(l_suppkey::VARCHAR, 6, '0') AS ticker, coalesce(max(s_name), 'unknown') AS name, count(*) AS n FROM lineitem
LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 0) ON s_suppkey = l_suppkey GROUP BY 1""")
def j19(t):
    counts = t.table("lineitem").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    dim = t.table("supplier").where(F.col("s_acctbal") > 0).select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("name"))
    out = R.attach_with_default(counts, dim, ["l_suppkey"], {"name": "unknown"})
    return out.select(F.lpad(F.col("l_suppkey").cast("string"), 6, "0").alias("ticker"), "name", "n")


@query("j20_state_timeline", f"""
SELECT a.asof_ts, {r('a.change_pct')} AS main_change, {r('b.change_pct')} AS growth_change FROM bars a JOIN bars b ON a.asof_ts = b.asof_ts
WHERE a.signal_code = '1001' AND b.signal_code = '2001'""")
def j20(t):
    one = lambda code, name: t.bars.where(F.col("signal_code") == code).select("asof_ts", rd("change_pct").alias(name))
    return one("1001", "main_change").join(one("2001", "growth_change"), "asof_ts")


@query("j21_walk_forward_folds", """
SELECT p.model, p.market_scope, p.forecast_horizon, f.test_year, count(*) AS train_rows, sum((p.actual_label = 'up')::INT)::BIGINT AS train_up FROM predictions p
JOIN (SELECT DISTINCT model, market_scope, forecast_horizon, test_year FROM predictions) f ON p.model = f.model AND p.market_scope = f.market_scope
 AND p.forecast_horizon = f.forecast_horizon AND p.test_year < f.test_year GROUP BY 1, 2, 3, 4""")
def j21(t):
    from tidemark.plans.walkforward import expanding_totals

    keys = ["model", "market_scope", "forecast_horizon"]
    return expanding_totals(t.predictions, keys, "test_year", {"train_rows": F.count(F.lit(1)), "train_up": F.count_if(F.col("actual_label") == "up")}).where(F.col("train_rows").isNotNull())


@query("j22_neighbour_flags", f"""
SELECT asof_date, evt, coalesce(lead(evt) OVER (ORDER BY asof_date), 0) AS before_event, coalesce(lag(evt) OVER (ORDER BY asof_date), 0) AS after_event
FROM (SELECT s.asof_date, (p.close IS NULL)::INT AS evt FROM spine s LEFT JOIN scope_prices p ON p.date = s.asof_date AND p.market_scope = 'KOSPI')""")
def j22(t):
    kospi = t.scope_prices.where(F.col("market_scope") == "KOSPI").select(F.col("date").alias("asof_date"), "close")
    flags = t.spine.join(kospi, "asof_date", "left").select("asof_date", F.col("close").isNull().cast("int").alias("evt"), F.lit("spine").alias("k"))
    return W.with_neighbour_flags(flags, Axis.of("k", "asof_date"), "evt", "before_event", "after_event").drop("k")


@query("j23_threshold_or_argmax", """
WITH th AS (SELECT market_scope, forecast_horizon, test_year, count(*) % 10 / 20.0::DOUBLE + 0.3::DOUBLE AS d, count(*) % 7 / 20.0::DOUBLE + 0.3::DOUBLE AS u FROM predictions WHERE test_year >= 1998 GROUP BY 1, 2, 3)
SELECT p.model, p.market_scope, p.forecast_horizon, p.asof_date, CASE
  WHEN th.d IS NULL THEN CASE WHEN prob_down >= prob_sideways AND prob_down >= prob_up THEN 'down' WHEN prob_sideways >= prob_up THEN 'sideways' ELSE 'up' END
  WHEN prob_down >= th.d AND prob_down >= prob_up THEN 'down' WHEN prob_up >= th.u AND prob_up > prob_down THEN 'up' ELSE 'sideways' END AS direction
FROM predictions p LEFT JOIN th USING (market_scope, forecast_horizon, test_year)""")
def j23(t):
    from tidemark.plans.backtest import decide

    keys = ["market_scope", "forecast_horizon", "test_year"]
    n = F.count(F.lit(1))
    th = t.predictions.where(F.col("test_year") >= 1998).groupBy(*keys).agg(
        (n % 10 / 20.0 + 0.3).alias("down_threshold"), (n % 7 / 20.0 + 0.3).alias("up_threshold"))
    return decide(t.predictions, th, keys).select("model", "market_scope", "forecast_horizon", "asof_date", F.col("predicted_direction").alias("direction"))


@query("j24_parameter_grid", f"""
SELECT rule_name, confidence_floor, count(*) AS n, sum((greatest(prob_down, prob_sideways, prob_up) < confidence_floor)::INT)::BIGINT AS low FROM predictions,
 (SELECT unnest({list(RULE_PROFILES)}) AS rule_name), (SELECT unnest({CONFIDENCE_FLOORS})::DOUBLE AS confidence_floor) GROUP BY 1, 2""")
def j24(t):
    rules = [{"rule_name": k, "confidence_floor": f} for k in RULE_PROFILES for f in CONFIDENCE_FLOORS]
    rows = t.predictions.select(F.greatest("prob_down", "prob_sideways", "prob_up").alias("confidence"))
    return R.explode_grid(rows, rules).groupBy("rule_name", "confidence_floor").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("confidence") < F.col("confidence_floor")).alias("low"))


@query("j25_latest_stored_close", f"""
SELECT s.event_id, {r('s.metric_value / c.close')} AS against_close FROM snapshots s LEFT JOIN (
  SELECT CASE market_scope WHEN 'KOSPI' THEN '1001' WHEN 'KOSDAQ' THEN '2001' ELSE '1028' END AS signal_code, arg_max(close, date) / 1000 AS close
  FROM scope_prices GROUP BY 1) c USING (signal_code)""")
def j25(t):
    code = L.lookup({"KOSPI": "1001", "KOSDAQ": "2001", "KOSPI200": "1028"}, "market_scope")
    last = R.latest_per_key(t.scope_prices, ["market_scope"], ["date"]).select(code.alias("signal_code"), (F.col("close") / 1000).alias("ref"))
    return t.snapshots.join(last, "signal_code", "left").select("event_id", rd(N.ratio("metric_value", "ref")).alias("against_close"))


@query("j26_previous_row", """
SELECT signal_code, asof_ts, lag(asof_ts) OVER w AS previous_ts, lag(n) OVER w AS previous_n FROM bars WINDOW w AS (PARTITION BY signal_code ORDER BY asof_ts)""")
def j26(t):
    ax = Axis.of("signal_code", "asof_ts")
    return t.bars.select("signal_code", "asof_ts", F.lag("asof_ts").over(ax.by).alias("previous_ts"), F.lag("n").over(ax.by).alias("previous_n"))
