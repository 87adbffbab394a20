"""Top-k, set and reshape queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.aggregates import PKEYS, PRED, class_sql, predicted
from tidemark.catalog.expressions import rd
from tidemark.catalog.registry import query, r
from tidemark.operators import metrics as M
from tidemark.operators import relational as R
from tidemark.operators import windows as W
from tidemark.operators.windows import Axis
from tidemark.plans.specs import FORECAST_WEIGHTS

P = "PARTITION BY ticker ORDER BY date"
PS = "PARTITION BY market_scope ORDER BY date"
TICK = Axis.of("ticker", "date")


@query("t1_top_conditional_signals", """
SELECT event_id, array_to_string(list_transform(list_slice(list_sort(list_filter([
  CASE WHEN s1 > 0 THEN {'v': s1, 'n': 'trend'} END, CASE WHEN s2 > 0 THEN {'v': s2, 'n': 'growth'} END, CASE WHEN s3 > 0 THEN {'v': s3, 'n': 'breadth'} END,
  CASE WHEN u1 >= 0.55 THEN {'v': u1, 'n': 'above'} END], lambda x: x IS NOT NULL), 'DESC'), 1, 3), lambda x: x.n), ',') AS top FROM scores""")
def t1(t):
    one = lambda cond, v, n: F.when(cond, F.struct(v.alias("v"), F.lit(n).alias("n")))
    s1, s2, s3, u1 = (F.col(c) for c in ("s1", "s2", "s3", "u1"))
    arr = F.array(one(s1 > 0, s1, "trend"), one(s2 > 0, s2, "growth"), one(s3 > 0, s3, "breadth"), one(u1 >= 0.55, u1, "above"))
    return t.scores.select("event_id", F.array_join(F.transform(R.top_structs(arr), lambda x: x["n"]), ",").alias("top"))


@query("t2_top_movers", """
SELECT date, ticker, rnk FROM (SELECT date, ticker, row_number() OVER (PARTITION BY date ORDER BY abs(chg) DESC, ticker) AS rnk FROM (
  SELECT *, close - lag(close) OVER (PARTITION BY ticker ORDER BY date) AS chg FROM stock_prices) WHERE chg IS NOT NULL) WHERE rnk <= 3""")
def t2(t):
    rows = t.stock_prices.withColumn("chg", W.lag_diff(TICK, "close", 1)).where(F.col("chg").isNotNull())
    return R.pick_first(rows, ["date"], [F.desc(F.abs("chg")), F.asc("ticker")], 3, "rnk").select("date", "ticker", "rnk")


YEARLY = f"({class_sql(PRED, 'model, market_scope, forecast_horizon, test_year')})"


def yearly(t):
    return M.classification_scorecard(predicted(t), [*PKEYS, "test_year"], "actual_label", "predicted")


@query("t3_best_row_per_group", f"""
SELECT market_scope, forecast_horizon, model, test_year, {r('balanced_accuracy')} AS balanced_accuracy FROM {YEARLY}
QUALIFY row_number() OVER (PARTITION BY market_scope, forecast_horizon ORDER BY round(balanced_accuracy, 8) DESC, round(macro_f1, 8) DESC, model, test_year) = 1""")
def t3(t):
    rows = yearly(t)
    best = R.pick_first(rows, ["market_scope", "forecast_horizon"], [F.desc(F.round("balanced_accuracy", 8)), F.desc(F.round("macro_f1", 8)), F.asc("model"), F.asc("test_year")])
    return best.select("market_scope", "forecast_horizon", "model", "test_year", rd("balanced_accuracy").alias("balanced_accuracy"))


@query("t4_near_best_selection", f"""
SELECT market_scope, forecast_horizon, model, test_year FROM (SELECT *, max(balanced_accuracy) OVER (PARTITION BY market_scope, forecast_horizon) AS best FROM {YEARLY})
WHERE balanced_accuracy >= best - 0.05 QUALIFY row_number() OVER (PARTITION BY market_scope, forecast_horizon ORDER BY round(macro_f1, 8), model, test_year) = 1""")
def t4(t):
    out = R.near_best(yearly(t), ["market_scope", "forecast_horizon"], "balanced_accuracy", 0.05, [F.asc(F.round("macro_f1", 8)), F.asc("model"), F.asc("test_year")])
    return out.select("market_scope", "forecast_horizon", "model", "test_year")


@query("t5_grid_argmax_first_wins", """
SELECT market_scope, down_threshold, up_threshold, hits FROM (SELECT market_scope, d AS down_threshold, u AS up_threshold, count(*) FILTER (actual_label =
   CASE WHEN prob_down >= d AND prob_down >= prob_up THEN 'down' WHEN prob_up >= u AND prob_up > prob_down THEN 'up' ELSE 'sideways' END) AS hits
  FROM predictions, (SELECT unnest([0.34, 0.40, 0.46])::DOUBLE AS d), (SELECT unnest([0.34, 0.40, 0.46])::DOUBLE AS u) GROUP BY 1, 2, 3)
QUALIFY row_number() OVER (PARTITION BY market_scope ORDER BY hits DESC, down_threshold, up_threshold) = 1""")
def t5(t):
    from tidemark.plans.backtest import threshold_counts

    counts = threshold_counts(t.predictions, ["market_scope"], [0.34, 0.40, 0.46])
    hits = counts.withColumn("hits", F.col("tp_down") + F.col("tp_sideways") + F.col("tp_up"))
    best = R.latest_per_key(hits.withColumn("first", -F.col("grid_index")), ["market_scope"], ["hits", "first"])
    return best.select("market_scope", "down_threshold", "up_threshold", "hits")


@query("t6_best_model", f"""
SELECT market_scope, forecast_horizon, arg_max(model, struct_pack(a := round(acc, 8), b := model)) AS model FROM (SELECT model, market_scope, forecast_horizon, avg(accuracy) AS acc FROM {YEARLY} GROUP BY 1, 2, 3) GROUP BY 1, 2""")
def t6(t):
    mean = yearly(t).groupBy(*PKEYS).agg(F.round(F.avg("accuracy"), 8).alias("acc"))
    return R.latest_per_key(mean, ["market_scope", "forecast_horizon"], ["acc", "model"]).select("market_scope", "forecast_horizon", "model")


@query("t7_last_n_ascending", "SELECT asof_ts, signal_code, n FROM (SELECT * FROM bars ORDER BY asof_ts DESC, signal_code DESC LIMIT 72) ORDER BY 1, 2")
def t7(t):
    return R.last_n_ascending(t.bars.select("asof_ts", "signal_code", "n"), ["asof_ts", "signal_code"], 72)


@query("t8_representative_asset", f"""
SELECT date, ticker FROM (SELECT date, ticker, value, coalesce(list_position(['GOLD', 'BOND', 'CASH'], ticker), 999) AS pref FROM market_prices WHERE value > 300000)
QUALIFY row_number() OVER (PARTITION BY date ORDER BY pref, value DESC, ticker) = 1""")
def t8(t):
    from tidemark.plans.state import representative

    return representative(t.market_prices.where(F.col("value") > 300000), ["date"], "ticker", ["GOLD", "BOND", "CASH"], "value").select("date", "ticker")


@query("t9_strongest_weakest", """
SELECT date, arg_max(theme_bucket, struct_pack(v := close, k := theme_bucket)) AS strongest, max(close) AS strongest_score, arg_min(theme_bucket, struct_pack(v := close, k := theme_bucket)) AS weakest, min(close) AS weakest_score FROM theme_prices GROUP BY 1""")
def t9(t):
    return R.extremes(t.theme_prices, ["date"], "theme_bucket", "close")


@query("t10_ordered_highlights", """
SELECT lang, doc_id, source, rnk FROM (SELECT lang, doc_id, source, row_number() OVER (PARTITION BY lang ORDER BY CASE WHEN n_chars > 3000 THEN 0 WHEN n_chars > 1000 THEN 1 ELSE 2 END, doc_id DESC) AS rnk FROM documents) WHERE rnk <= 10""")
def t10(t):
    severity = F.when(F.col("n_chars") > 3000, 0).when(F.col("n_chars") > 1000, 1).otherwise(2)
    docs = t.table("documents").select("lang", "doc_id", "source", severity.alias("sev"))
    return R.pick_first(docs, ["lang"], [F.asc("sev"), F.desc("doc_id")], 10, "rnk").select("lang", "doc_id", "source", "rnk")


@query("t11_output_order", "SELECT market_scope, date, close FROM scope_prices ORDER BY date, market_scope")
def t11(t):
    return t.scope_prices.select("market_scope", "date", "close").orderBy("date", "market_scope")


@query("t12_rows_at_latest_date", """
SELECT p.market_scope, p.date, p.close FROM scope_prices p WHERE p.date = (SELECT max(q.date) FROM scope_prices q WHERE q.market_scope = p.market_scope AND q.date <= DATE '2000-12-31')""")
def t12(t):
    return R.rows_at_latest(t.scope_prices.select("market_scope", "date", "close"), ["market_scope"], "date", F.lit("2000-12-31").cast("date"))


@query("t13_strength_panel", """
SELECT date, theme_bucket, CASE WHEN up <= 3 THEN 'top' ELSE 'bottom' END AS side, up AS place FROM (
  SELECT *, row_number() OVER (PARTITION BY date ORDER BY close DESC, theme_bucket) AS up, row_number() OVER (PARTITION BY date ORDER BY close, theme_bucket) AS down FROM theme_prices) WHERE up <= 3 OR down <= 2""")
def t13(t):
    from tidemark.plans.state import strength_panel

    return strength_panel(t.theme_prices, "date", "theme_bucket", "close").select("date", "theme_bucket", "side", "place")


# -- set operations -------------------------------------------------------------------

@query("u1_union_all_frames", "SELECT market_scope AS code, date, close FROM scope_prices UNION ALL SELECT theme_bucket, date, close FROM theme_prices")
def u1(t):
    from tidemark.sources.tables import unite

    return unite([t.scope_prices.select(F.col("market_scope").alias("code"), "date", "close"), t.theme_prices.select(F.col("theme_bucket").alias("code"), "date", "close")])


@query("u2_tolerant_union", "SELECT ticker, date, volume FROM stock_prices UNION ALL SELECT ticker, date, NULL FROM market_prices")
def u2(t):
    from tidemark.sources.tables import unite

    return unite([t.stock_prices.select("ticker", "date", "volume"), t.market_prices.select("ticker", "date")])


@query("u3_union_source_priority", """
SELECT date, ticker, investor, CASE WHEN net_value > 0 THEN net_value * 2 ELSE net_value END AS net_value, CASE WHEN net_value > 0 THEN 'feed' ELSE 'base' END AS source FROM flows""")
def u3(t):
    base = t.flows.select("date", "ticker", "investor", "net_value", F.lit("base").alias("source"))
    feed = base.where(F.col("net_value") > 0).select("date", "ticker", "investor", (F.col("net_value") * 2).alias("net_value"), F.lit("feed").alias("source"))
    return R.union_by_priority([(feed, 0), (base, 1)], ["date", "ticker", "investor"])


@query("u4_keep_last_dedup", "SELECT l_orderkey, l_linenumber, max(l_shipdate) AS l_shipdate, arg_max(l_partkey, struct_pack(a := l_shipdate, b := l_partkey)) AS l_partkey FROM lineitem GROUP BY 1, 2")
def u4(t):
    rows = t.table("lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey")
    return R.latest_per_key(rows, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey"])


@query("u5_all_scope_duplication", f"SELECT s.scope AS market_scope, date, count(*) AS n, {r('sum(net_value)', 2)} AS net FROM flows, LATERAL (SELECT unnest([market, 'ALL']) AS scope) s GROUP BY 1, 2")
def u5(t):
    return R.with_all_scope(t.flows, "market").groupBy(F.col("market").alias("market_scope"), "date").agg(F.count(F.lit(1)).alias("n"), rd(F.sum("net_value"), 2).alias("net"))


@query("u6_scope_alias", "SELECT market_scope, date, close FROM scope_prices WHERE market_scope <> 'KOSPI200' UNION ALL SELECT 'KOSPI200', date, close FROM scope_prices WHERE market_scope = 'KOSPI'")
def u6(t):
    base = t.scope_prices.where(F.col("market_scope") != "KOSPI200").select("market_scope", "date", "close")
    return R.with_scope_alias(base, "market_scope", "KOSPI", "KOSPI200")


@query("u7_key_set_operations", """
SELECT 'only_left' AS kind, count(*) AS n FROM (SELECT date FROM scope_prices WHERE market_scope = 'KOSPI' EXCEPT SELECT date FROM scope_prices WHERE market_scope = 'KOSDAQ')
UNION ALL SELECT 'both', count(*) FROM (SELECT date FROM scope_prices WHERE market_scope = 'KOSPI' INTERSECT SELECT date FROM scope_prices WHERE market_scope = 'KOSDAQ')""")
def u7(t):
    day = lambda s: t.scope_prices.where(F.col("market_scope") == s).select("date")
    a, b = day("KOSPI"), day("KOSDAQ")
    count = lambda df, k: df.agg(F.lit(k).alias("kind"), F.count(F.lit(1)).alias("n"))
    return count(a.join(b, "date", "left_anti"), "only_left").unionByName(count(a.join(b, "date", "left_semi"), "both"))


@query("u8_append_later_rows", """
SELECT market_scope, date, close FROM scope_prices WHERE date < DATE '2000-01-01' UNION ALL SELECT market_scope, date, close + 1 FROM scope_prices p
WHERE date > (SELECT max(date) FROM scope_prices q WHERE q.market_scope = p.market_scope AND q.date < DATE '2000-01-01') AND date >= DATE '1999-06-01'""")
def u8(t):
    p = t.scope_prices.select("market_scope", "date", "close")
    extra = p.where(F.col("date") >= "1999-06-01").withColumn("close", F.col("close") + 1)
    return R.append_later(p.where(F.col("date") < "2000-01-01"), extra, ["market_scope"], "date")


# -- reshape --------------------------------------------------------------------------

THEMES = [f"theme_{i}" for i in range(1, 8)]


@query("r1_pivot_first", "SELECT date, " + ", ".join(f"max(close) FILTER (theme_bucket = '{m}') AS {m}_close" for m in THEMES) + " FROM theme_prices GROUP BY 1")
def r1(t):
    return R.pivot_wide(t.theme_prices, ["date"], "theme_bucket", THEMES, F.first("close"), suffix="_close")


@query("r2_pivot_aggregate", "SELECT date, market, " + ", ".join(r(f"sum(net_value) FILTER (investor = '{m}')", 2) + f" AS {m}" for m in ("foreign", "institution", "retail")) + " FROM flows GROUP BY 1, 2")
def r2(t):
    return R.pivot_wide(t.flows, ["date", "market"], "investor", ["foreign", "institution", "retail"], F.round(F.sum("net_value"), 2))


@query("r3_unpivot", "UNPIVOT (SELECT asof_date, model, market_scope, forecast_horizon, prob_down, prob_sideways, prob_up FROM predictions) ON prob_down, prob_sideways, prob_up INTO NAME class VALUE probability".replace("UNPIVOT (", "SELECT * FROM (UNPIVOT (", 1) + ")")
def r3(t):
    return R.unpivot_long(t.predictions, ["asof_date", *PKEYS], ["prob_down", "prob_sideways", "prob_up"], "class", "probability")


@query("r4_explode_horizons", f"""
SELECT market_scope, date, h.horizon AS forecast_horizon, {r('close * h.w / 1000')} AS weighted FROM scope_prices, (VALUES ('1d', 0.24), ('5d', 0.28), ('20d', 0.30)) h(horizon, w)""")
def r4(t):
    grid = [{"forecast_horizon": h, "w": w[0]} for h, w in FORECAST_WEIGHTS.items()]
    return R.explode_grid(t.scope_prices, grid).select("market_scope", "date", "forecast_horizon", rd(F.col("close") * F.col("w") / 1000).alias("weighted"))


@query("r5_nest_points", """
SELECT series_id, len(points) AS n, points[1].asof_date AS first_date, points[-1].asof_date AS last_date, list_sum(list_transform(points, lambda p: p.value))::DOUBLE AS total
FROM (SELECT series_id, list({'asof_date': asof_date, 'value': value} ORDER BY asof_date) AS points FROM monthly_obs GROUP BY 1)""")
def r5(t):
    out = R.nest_points(t.monthly_obs, ["series_id"], ["asof_date", "value"])
    return out.select("series_id", F.size("points").alias("n"), F.col("points")[0]["asof_date"].alias("first_date"), F.element_at("points", -1)["asof_date"].alias("last_date"),
                      F.aggregate("points", F.lit(0.0), lambda a, p: a + p["value"]).alias("total"))


@query("r6_points_to_rows", "SELECT series_id, asof_date AS date, value FROM monthly_obs")
def r6(t):
    docs = R.nest_points(t.monthly_obs.select("series_id", F.col("asof_date").cast("string").alias("date"), "value"), ["series_id"], ["date", "value"])
    docs = docs.select("series_id", F.to_json("points").alias("doc"))
    return R.unnest_points(docs, ["series_id"], "doc", "array<struct<date:date,value:double>>")
