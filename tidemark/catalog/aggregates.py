"""Aggregation and data-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.expressions import rd
from tidemark.catalog.registry import query, r, sql_clip, sql_roll
from tidemark.functions import labels as L
from tidemark.functions import numeric as N
from tidemark.functions import text as X
from tidemark.operators import metrics as M
from tidemark.operators import quality as Q
from tidemark.operators import relational as R
from tidemark.operators import windows as W
from tidemark.operators.windows import Axis

SCOPE = Axis.of("market_scope", "date")
TICK = Axis.of("ticker", "date")
PS = "PARTITION BY market_scope ORDER BY date"
P = "PARTITION BY ticker ORDER BY date"

# Score and realised return per scope and day: the z-score of the level against the next five-day return.
SCORED = f"""(SELECT market_scope, date, year(date) AS y, CASE WHEN month(date) <= 6 THEN 'h1' ELSE 'h2' END AS half,
  (close - {sql_roll('avg', 'close', 20, 10, PS)}) / 100000.0::DOUBLE AS score, lead(close, 5) OVER ({PS}) / close - 1 AS realised FROM scope_prices)"""


def scored(t):
    score = (F.col("close") - W.rolling_mean(SCOPE, "close", 20, 10)) / 100000.0
    return t.scope_prices.select("market_scope", "date", F.year("date").alias("y"), F.when(F.month("date") <= 6, "h1").otherwise("h2").alias("half"),
                                 score.alias("score"), W.forward_return(SCOPE, "close", 5).alias("realised"))


PRED = """(SELECT *, CASE WHEN prob_down >= prob_sideways AND prob_down >= prob_up THEN 'down' WHEN prob_sideways >= prob_up THEN 'sideways' ELSE 'up' END AS predicted,
  greatest(prob_down, prob_sideways, prob_up) AS confidence FROM predictions)"""


def predicted(t):
    from tidemark.plans.backtest import PROBS, with_confidence

    return with_confidence(t.predictions.withColumn("predicted", L.argmax_label(PROBS)))


@query("a1_grouped_sums_with_all", f"""
SELECT date, market AS market_scope, investor, {r('sum(net_value)', 2)} AS net_value, count(*) AS row_count FROM flows GROUP BY 1, 2, 3
UNION ALL SELECT date, 'ALL', investor, {r('sum(net_value)', 2)}, count(*) FROM flows GROUP BY 1, 3""")
def a1(t):
    out = M.grouping_totals(t.flows.withColumnRenamed("market", "market_scope"), "date", "market_scope", "investor", "net_value")
    return out.withColumn("net_value", rd("net_value", 2))


@query("a2_multi_measure_group", f"""
SELECT date, investor, {r('sum(net_value)', 2)} AS net_value, count(DISTINCT ticker) AS stock_count, count(*) FILTER (net_value > 0) AS positive_count,
  substr(string_agg(DISTINCT market, ',' ORDER BY market), 1, 200) AS source FROM flows GROUP BY 1, 2""")
def a2(t):
    return t.flows.groupBy("date", "investor").agg(
        rd(F.sum("net_value"), 2).alias("net_value"), F.count_distinct("ticker").alias("stock_count"),
        F.count_if(F.col("net_value") > 0).alias("positive_count"), X.sorted_distinct_text("market", ",").alias("source"))


@query("a3_breadth_group", f"""
SELECT date, market, count(*) FILTER (net_value > 0) AS positives, count(*) FILTER (net_value < 0) AS negatives, count(DISTINCT ticker) AS tickers,
  {r('count(*) FILTER (net_value > 0)::DOUBLE / nullif(count(*), 0)')} AS ratio FROM flows GROUP BY 1, 2""")
def a3(t):
    pos = F.count_if(F.col("net_value") > 0)
    return t.flows.groupBy("date", "market").agg(
        pos.alias("positives"), F.count_if(F.col("net_value") < 0).alias("negatives"), F.count_distinct("ticker").alias("tickers"),
        rd(N.ratio(pos, F.count(F.lit(1)))).alias("ratio"))


@query("a4_conditional_row", f"""
SELECT asof_ts, {r("avg(change_pct) FILTER (signal_code IN ('1001', '2001', '1028'))", 10)} AS index_change, {r("max(change_pct) FILTER (signal_code = 'FUT')", 10)} AS futures_change,
  {r("max(change_pct) FILTER (signal_code = 'USDKRW')", 10)} AS fx_change FROM bars GROUP BY 1""")
def a4(t):
    pick = lambda code: F.max(F.when(F.col("signal_code") == code, F.col("change_pct")))
    return t.bars.groupBy("asof_ts").agg(
        rd(F.avg(F.when(F.col("signal_code").isin("1001", "2001", "1028"), F.col("change_pct"))), 10).alias("index_change"),
        rd(pick("FUT"), 10).alias("futures_change"), rd(pick("USDKRW"), 10).alias("fx_change"))


BREADTH = f"""(SELECT ticker, date, {sql_roll('avg', 'close', 20, 20, P)} AS ma20, {sql_roll('avg', 'close', 60, 60, P)} AS ma60, close, close - lag(close) OVER ({P}) AS chg,
  {sql_roll('max', 'close', 252, 60, P)} AS hi, {sql_roll('min', 'close', 252, 60, P)} AS lo, row_number() OVER ({P}) AS rn FROM stock_prices)"""


@query("a5_market_breadth", f"""
SELECT date, count(*) AS universe, {r('avg((close > ma20)::INT)')} AS above_ma20, {r('avg((close > ma60)::INT)')} AS above_ma60,
  {r('(count(*) FILTER (chg > 0) + 1)::DOUBLE / (count(*) FILTER (chg < 0) + 1)')} AS adv_dec_ratio, count(*) FILTER (close >= hi) AS new_highs, count(*) FILTER (close <= lo) AS new_lows
FROM {BREADTH} WHERE rn >= 60 GROUP BY 1""")
def a5(t):
    from tidemark.plans.state import universe_breadth

    out = universe_breadth(t.stock_prices, "ticker", "date", "close")
    return out.select("date", "universe", rd("above_ma20").alias("above_ma20"), rd("above_ma60").alias("above_ma60"),
                      rd("adv_dec_ratio").alias("adv_dec_ratio"), "new_highs", "new_lows")


@query("a6_index_breadth_proxy", f"""
SELECT date, count(*) AS universe, {r('avg((close > ma20)::INT)')} AS above_ma20, {r('(count(*) FILTER (chg > 0) + 1)::DOUBLE / (count(*) FILTER (chg < 0) + 1)')} AS adv_dec_ratio FROM (
  SELECT market_scope, date, close, close - lag(close) OVER ({PS}) AS chg, {sql_roll('avg', 'close', 20, 20, PS)} AS ma20, row_number() OVER ({PS}) AS rn FROM scope_prices) WHERE rn >= 60 GROUP BY 1""")
def a6(t):
    from tidemark.plans.state import universe_breadth

    return universe_breadth(t.scope_prices, "market_scope", "date", "close").select(
        "date", "universe", rd("above_ma20").alias("above_ma20"), rd("adv_dec_ratio").alias("adv_dec_ratio"))


@query("a7_latest_per_group", "SELECT o_custkey, max(o_orderdate)::DATE AS last_day, max(struct_pack(d := o_orderdate, k := o_orderkey)).k AS o_orderkey FROM orders GROUP BY 1")
def a7(t):
    rows = t.table("orders").select("o_custkey", "o_orderdate", "o_orderkey")
    return R.latest_per_key(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select(
        "o_custkey", F.col("o_orderdate").cast("date").alias("last_day"), "o_orderkey")


SPREAD = "CASE WHEN count(*) FILTER (score IS NOT NULL AND realised IS NOT NULL) >= 20 THEN corr(score, realised) END"


@query("a8_summary_stats", f"""
SELECT s.market_scope, count(realised) AS n, {r('avg(realised)')} AS mean_return, {r('median(realised)')} AS median_return, {r('stddev_pop(realised)')} AS std_return,
  {r('avg(CASE WHEN realised > 0 THEN 1 WHEN realised IS NOT NULL THEN 0 END)')} AS win_rate, {r(SPREAD)} AS pearson, {r('any_value(k.rho)')} AS spearman
FROM {SCORED} s JOIN (SELECT market_scope, corr(ra, rb) AS rho FROM (
  SELECT market_scope, rank() OVER a + (count(*) OVER (PARTITION BY market_scope, score) - 1) / 2.0::DOUBLE AS ra, rank() OVER b + (count(*) OVER (PARTITION BY market_scope, realised) - 1) / 2.0::DOUBLE AS rb
  FROM {SCORED} WHERE score IS NOT NULL AND realised IS NOT NULL
  WINDOW a AS (PARTITION BY market_scope ORDER BY score), b AS (PARTITION BY market_scope ORDER BY realised)) GROUP BY 1) k USING (market_scope) GROUP BY 1""")
def a8(t):
    rows = scored(t)
    base = rows.groupBy("market_scope").agg(*M.summary_stats("score", "realised"), F.median("realised").alias("median_return"))
    out = base.join(M.spearman(rows, ["market_scope"], "score", "realised"), "market_scope")
    return out.select("market_scope", "n", *[rd(c).alias(c) for c in ("mean_return", "median_return", "std_return", "win_rate", "pearson", "spearman")])


@query("a8_spearman_whole_table", f"""
SELECT l_returnflag, {r('corr(ra, rb)')} AS spearman FROM (
  SELECT l_returnflag, rank() OVER a + (count(*) OVER (PARTITION BY l_returnflag, l_quantity) - 1) / 2.0::DOUBLE AS ra,
         rank() OVER b + (count(*) OVER (PARTITION BY l_returnflag, l_extendedprice) - 1) / 2.0::DOUBLE AS rb FROM lineitem
  WINDOW a AS (PARTITION BY l_returnflag ORDER BY l_quantity), b AS (PARTITION BY l_returnflag ORDER BY l_extendedprice)) GROUP BY 1""")
def a8_whole(t):
    out = M.spearman(t.table("lineitem"), ["l_returnflag"], "l_quantity", "l_extendedprice")
    return out.select("l_returnflag", rd("spearman").alias("spearman"))


LABELLED = f"(SELECT *, CASE WHEN score IS NULL THEN NULL WHEN score >= 0.35 THEN 'bullish' WHEN score > -0.35 THEN 'neutral' ELSE 'bearish' END AS label FROM {SCORED})"


def labelled(t):
    return scored(t).withColumn("label", L.ladder("score", [(">=", 0.35, "bullish"), (">", -0.35, "neutral")], "bearish"))


@query("a9_label_summary", f"SELECT market_scope, label, count(*) AS n, {r('avg(realised)')} AS mean_return, {r('avg((realised > 0)::INT)')} AS win_rate FROM {LABELLED} GROUP BY 1, 2")
def a9(t):
    return labelled(t).groupBy("market_scope", "label").agg(
        F.count(F.lit(1)).alias("n"), rd(F.avg("realised")).alias("mean_return"), rd(F.avg((F.col("realised") > 0).cast("int"))).alias("win_rate"))


QUINT = f"""(SELECT s.*, CASE WHEN score <= q[1] THEN 'Q1' WHEN score <= q[2] THEN 'Q2' WHEN score <= q[3] THEN 'Q3' WHEN score <= q[4] THEN 'Q4' ELSE 'Q5' END AS quintile
  FROM {SCORED} s JOIN (SELECT market_scope, quantile_cont(score, [0.2, 0.4, 0.6, 0.8]) AS q FROM {SCORED} GROUP BY 1) USING (market_scope) WHERE score IS NOT NULL)"""


@query("a10_quintile_summary", f"SELECT market_scope, quintile, count(*) AS n, {r('avg(realised)')} AS mean_return FROM {QUINT} GROUP BY 1, 2")
def a10(t):
    rows = M.quantile_bucketed(scored(t), ["market_scope"], "score", bounded=True)
    return rows.groupBy("market_scope", "quintile").agg(F.count(F.lit(1)).alias("n"), rd(F.avg("realised")).alias("mean_return"))


@query("a10_quantiles_whole_table", f"""
SELECT l_returnflag, {r('quantile_cont(l_extendedprice, 0.2)', 4)} AS q20, {r('quantile_cont(l_extendedprice, 0.5)', 4)} AS q50, {r('quantile_cont(l_extendedprice, 0.8)', 4)} AS q80 FROM lineitem GROUP BY 1""")
def a10_whole(t):
    out = M.exact_quantiles(t.table("lineitem"), ["l_returnflag"], "l_extendedprice", {"q20": 0.2, "q50": 0.5, "q80": 0.8})
    return out.select("l_returnflag", *[rd(c, 4).alias(c) for c in ("q20", "q50", "q80")])


@query("a11_top_bottom_spread", f"SELECT market_scope, {r('''avg(realised) FILTER (quintile = 'Q5') - avg(realised) FILTER (quintile = 'Q1')''')} AS spread FROM {QUINT} GROUP BY 1")
def a11(t):
    rows = M.quantile_bucketed(scored(t), ["market_scope"], "score", bounded=True)
    side = lambda q: F.avg(F.when(F.col("quintile") == q, F.col("realised")))
    return rows.groupBy("market_scope").agg(rd(side("Q5") - side("Q1")).alias("spread"))


@query("a12_regression_errors", f"""
SELECT market_scope, count(e) AS n, {r('avg(abs(e))')} AS mae, {r('sqrt(avg(e * e))')} AS rmse, {r('avg(CASE WHEN e IS NOT NULL THEN (sign(score) = sign(realised))::INT END)')} AS directional_hit,
  {r('corr(score, realised)')} AS corr, {r('avg(CASE WHEN e IS NOT NULL THEN score END)')} AS mean_pred, {r('avg(CASE WHEN e IS NOT NULL THEN realised END)')} AS mean_real
FROM (SELECT *, score - realised AS e FROM {SCORED}) GROUP BY 1""")
def a12(t):
    out = scored(t).groupBy("market_scope").agg(*M.regression_errors("score", "realised"))
    return out.select("market_scope", "n", *[rd(c).alias(c) for c in ("mae", "rmse", "directional_hit", "corr", "mean_pred", "mean_real")])


def class_sql(source: str, keys: str, actual: str = "actual_label", pred: str = "predicted") -> str:
    cs = ("down", "sideways", "up")
    tp = lambda c: f"count(*) FILTER ({actual} = '{c}' AND {pred} = '{c}')"
    act = lambda c: f"count(*) FILTER ({actual} = '{c}')"
    prd = lambda c: f"count(*) FILTER ({pred} = '{c}')"
    recall = " + ".join(f"coalesce({tp(c)}::DOUBLE / nullif({act(c)}, 0), 0)" for c in cs)
    supported = " + ".join(f"({act(c)} > 0)::INT" for c in cs)
    f1 = " + ".join(f"coalesce(2.0::DOUBLE * {tp(c)} / nullif({act(c)} + {prd(c)}, 0), 0)" for c in cs)
    return f"""SELECT {keys}, count(*) AS n, ({' + '.join(tp(c) for c in cs)})::DOUBLE / count(*) AS accuracy, ({recall}) / nullif({supported}, 0) AS balanced_accuracy,
      ({f1}) / 3 AS macro_f1, greatest({', '.join(act(c) for c in cs)})::DOUBLE / count(*) AS majority_baseline FROM {source} GROUP BY {keys}"""


CLASS_COLS = ("accuracy", "balanced_accuracy", "macro_f1", "majority_baseline")
PKEYS = ["model", "market_scope", "forecast_horizon"]


@query("a13_classification_metrics", f"SELECT model, market_scope, forecast_horizon, n, {', '.join(r(c) + f' AS {c}' for c in CLASS_COLS)} FROM ({class_sql(PRED, 'model, market_scope, forecast_horizon')})")
def a13(t):
    out = M.classification_scorecard(predicted(t), PKEYS, "actual_label", "predicted")
    return out.select(*PKEYS, "n", *[rd(c).alias(c) for c in CLASS_COLS])


@query("a14_confusion_matrix", f"""
SELECT k.market_scope, a.actual, b.predicted, count(p.model) AS n FROM (SELECT DISTINCT market_scope FROM predictions) k
CROSS JOIN (VALUES ('down'), ('sideways'), ('up')) a(actual) CROSS JOIN (VALUES ('down'), ('sideways'), ('up')) b(predicted)
LEFT JOIN {PRED} p ON p.market_scope = k.market_scope AND p.actual_label = a.actual AND p.predicted = b.predicted GROUP BY 1, 2, 3""")
def a14(t):
    return M.confusion(predicted(t), ["market_scope"], "actual_label", "predicted")


@query("a15_regime_performance", f"""
SELECT market_scope, dimension, dimension_value, count(*) AS n, {r('avg(realised)')} AS mean_return, {r('avg((realised > 0)::INT)')} AS win_rate FROM (
  SELECT market_scope, realised, 'label' AS dimension, label AS dimension_value FROM {LABELLED} UNION ALL
  SELECT market_scope, realised, 'half', half FROM {LABELLED} UNION ALL SELECT market_scope, realised, 'y', y::VARCHAR FROM {LABELLED}) GROUP BY 1, 2, 3""")
def a15(t):
    aggs = [F.count(F.lit(1)).alias("n"), rd(F.avg("realised")).alias("mean_return"), rd(F.avg((F.col("realised") > 0).cast("int"))).alias("win_rate")]
    rows = labelled(t).select("market_scope", "label", "half", "y", "realised")
    return M.dimension_performance(rows, ["market_scope"], ["label", "half", "y"], aggs)


PROBS_COLS = ("prob_down", "prob_sideways", "prob_up")
FWD2 = f"(SELECT market_scope, date AS asof_date, lead(close, 5) OVER ({PS}) / close - 1 AS fwd5, lead(close, 20) OVER ({PS}) / close - 1 AS fwd20 FROM scope_prices)"


@query("a16_feature_predictive_power", f"""
SELECT market_scope, feature, target, count(*) AS n, {r('corr(x, y)')} AS pearson, {r('corr(rx, ry)')} AS spearman FROM (
  SELECT *, rank() OVER a + (count(*) OVER (PARTITION BY market_scope, feature, target, x) - 1) / 2.0::DOUBLE AS rx, rank() OVER b + (count(*) OVER (PARTITION BY market_scope, feature, target, y) - 1) / 2.0::DOUBLE AS ry FROM (
    SELECT market_scope, f.feature, g.target, CASE f.feature WHEN 'prob_down' THEN prob_down WHEN 'prob_sideways' THEN prob_sideways ELSE prob_up END AS x, CASE g.target WHEN 'fwd5' THEN fwd5 ELSE fwd20 END AS y
    FROM predictions JOIN {FWD2} USING (market_scope, asof_date), (VALUES ('prob_down'), ('prob_sideways'), ('prob_up')) f(feature), (VALUES ('fwd5'), ('fwd20')) g(target))
  WHERE x IS NOT NULL AND y IS NOT NULL
  WINDOW a AS (PARTITION BY market_scope, feature, target ORDER BY x), b AS (PARTITION BY market_scope, feature, target ORDER BY y)) GROUP BY 1, 2, 3""")
def a16(t):
    from tidemark.plans.research import predictive_power

    fwd = t.scope_prices.select("market_scope", F.col("date").alias("asof_date"), W.forward_return(SCOPE, "close", 5).alias("fwd5"), W.forward_return(SCOPE, "close", 20).alias("fwd20"))
    rows = t.predictions.join(fwd, ["market_scope", "asof_date"])
    out = predictive_power(rows, ["market_scope"], PROBS_COLS, ["fwd5", "fwd20"])
    return out.select("market_scope", "feature", "target", "n", rd("pearson").alias("pearson"), rd("spearman").alias("spearman"))


def axis_sql(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN 'missing' WHEN {c} >= 0.3 THEN 'positive' WHEN {c} <= -0.3 THEN 'negative' ELSE 'neutral' END"


@query("a17_axis_combo_summary", f"""
SELECT {axis_sql('s1')} || '|' || {axis_sql('s2')} || '|' || {axis_sql('s3')} AS combo, count(*) AS n, {r('avg(u1)')} AS mean_return, {r('avg((u1 > 0.5)::INT)')} AS win_rate FROM scores GROUP BY 1 HAVING count(*) >= 10""")
def a17(t):
    from tidemark.plans.research import combo_summary

    out = combo_summary(t.scores.withColumn("result", F.col("u1") - 0.5), ["s1", "s2", "s3"], "result", [])
    return out.select("combo", "n", rd(F.col("mean_return") + 0.5).alias("mean_return"), rd("win_rate").alias("win_rate"))


@query("a18_quantile_thresholds", f"""
SELECT market_scope, {', '.join(r(f'quantile_cont(realised, {q / 100})') + f' AS q{q}' for q in (20, 40, 60, 80))}, count(realised) AS sample_count FROM {SCORED} GROUP BY 1""")
def a18(t):
    rows = scored(t)
    probs = {f"q{q}": q / 100 for q in (20, 40, 60, 80)}
    counts = rows.groupBy("market_scope").agg(F.count("realised").alias("sample_count"))
    out = M.exact_quantiles(rows, ["market_scope"], "realised", probs, bounded=True).join(counts, "market_scope")
    return out.select("market_scope", *[rd(q).alias(q) for q in probs], "sample_count")


@query("a19_walk_forward_scorecard", f"""
SELECT model, market_scope, forecast_horizon, count(*) AS years, {r('avg(balanced_accuracy)')} AS mean_balanced_accuracy, {r('avg(accuracy - majority_baseline)')} AS mean_lift
FROM ({class_sql(PRED, 'model, market_scope, forecast_horizon, test_year')}) GROUP BY 1, 2, 3""")
def a19(t):
    per = M.classification_scorecard(predicted(t), [*PKEYS, "test_year"], "actual_label", "predicted")
    return per.groupBy(*PKEYS).agg(F.count(F.lit(1)).alias("years"), rd(F.avg("balanced_accuracy")).alias("mean_balanced_accuracy"),
                                   rd(F.avg(F.col("accuracy") - F.col("majority_baseline"))).alias("mean_lift"))


@query("a20_horizon_scorecard", f"""
SELECT h.forecast_horizon, {r('avg(h.balanced_accuracy)')} AS holdout, {r('avg(w.balanced_accuracy)')} AS walk_forward FROM ({class_sql('(SELECT * FROM ' + PRED + ' WHERE test_year = 2001)', 'market_scope, forecast_horizon')}) h
LEFT JOIN ({class_sql('(SELECT * FROM ' + PRED + ' WHERE test_year < 2001)', 'market_scope, forecast_horizon')}) w USING (market_scope, forecast_horizon) GROUP BY 1""")
def a20(t):
    keys = ["market_scope", "forecast_horizon"]
    card = lambda df, name: M.classification_scorecard(df, keys, "actual_label", "predicted").select(*keys, F.col("balanced_accuracy").alias(name))
    rows = predicted(t)
    both = card(rows.where(F.col("test_year") == 2001), "h").join(card(rows.where(F.col("test_year") < 2001), "w"), keys, "left")
    return both.groupBy("forecast_horizon").agg(rd(F.avg("h")).alias("holdout"), rd(F.avg("w")).alias("walk_forward"))


def backtest_sql() -> str:
    from tidemark.catalog.series import STRATEGY

    return f"""(SELECT market_scope, n, cum, hold, vol, hvol, mdd, expo, turn, pow(1 + cum, 252.0::DOUBLE / n) - 1 AS ann, pow(1 + hold, 252.0::DOUBLE / n) - 1 AS hann FROM (
      SELECT market_scope, count(strategy_return) AS n, exp(sum(ln(1 + coalesce(strategy_return, 0)))) - 1 AS cum, exp(sum(ln(1 + coalesce(next_return, 0)))) - 1 AS hold,
        stddev_pop(strategy_return) * sqrt(252) AS vol, stddev_pop(next_return) * sqrt(252) AS hvol, min(dd) AS mdd, avg(exposure) AS expo, sum(turnover) AS turn FROM {STRATEGY} GROUP BY 1))"""


def backtested(t):
    from tidemark.catalog.series import strategy

    return M.strategy_metrics(strategy(t).withColumn("direction", F.when(F.col("exposure") == 1, "up").otherwise("sideways")), ["market_scope"])


@query("a21_backtest_metrics", f"SELECT market_scope, n AS days, {r('cum', 4)} AS cumulative_return, {r('ann', 5)} AS annual_return, {r('vol')} AS annual_vol, {r('ann / nullif(vol, 0)', 4)} AS sharpe, {r('mdd', 5)} AS mdd, {r('expo')} AS avg_exposure, {r('turn', 4)} AS total_turnover FROM {backtest_sql()}")
def a21(t):
    out = backtested(t)
    digits = {"cumulative_return": 4, "annual_return": 5, "annual_vol": 6, "sharpe": 4, "mdd": 5, "avg_exposure": 6, "total_turnover": 4}
    return out.select("market_scope", "days", *[rd(c, d).alias(c) for c, d in digits.items()])


@query("a22_relative_metrics", f"SELECT market_scope, {r('ann / nullif(vol, 0) - hann / nullif(hvol, 0)', 4)} AS sharpe_lift, {r('cum / nullif(hold, 0)', 4)} AS return_capture FROM {backtest_sql()}")
def a22(t):
    return backtested(t).select("market_scope", rd("sharpe_lift", 4).alias("sharpe_lift"), rd("return_capture", 4).alias("return_capture"))


@query("a23_importance_stability", f"""
SELECT feature, {r('avg(c)')} AS mean_coefficient, {r('avg(abs(c))')} AS mean_abs, count(*) FILTER (c > 0) AS positive_years, count(*) FILTER (c < 0) AS negative_years, count(*) AS years FROM (
  SELECT y, feature, corr(x, realised) AS c FROM (SELECT y, realised, 'score' AS feature, score AS x FROM {SCORED} UNION ALL SELECT y, realised, 'day', dayofyear(date)::DOUBLE FROM {SCORED}) GROUP BY 1, 2) GROUP BY 1""")
def a23(t):
    from tidemark.plans.research import importance_stability

    rows = scored(t).withColumn("day", F.dayofyear("date").cast("double"))
    per = R.unpivot_long(rows, ["y", "realised"], ["score", "day"], "feature", "x").groupBy("y", "feature").agg(M.safe_corr("x", "realised", 1).alias("coefficient"))
    out = importance_stability(per, ["feature"], "coefficient")
    return out.select("feature", rd("mean_coefficient").alias("mean_coefficient"), rd("mean_abs").alias("mean_abs"), "positive_years", "negative_years", "years")


@query("a24_error_summary", f"""
SELECT market_scope, actual_label, predicted, count(*) AS n, {r('avg(confidence)')} AS mean_confidence, count(*) FILTER (confidence >= 0.5) AS high_confidence FROM {PRED} WHERE actual_label <> predicted GROUP BY 1, 2, 3""")
def a24(t):
    wrong = predicted(t).where(F.col("actual_label") != F.col("predicted"))
    return wrong.groupBy("market_scope", "actual_label", "predicted").agg(
        F.count(F.lit(1)).alias("n"), rd(F.avg("confidence")).alias("mean_confidence"), F.count_if(F.col("confidence") >= 0.5).alias("high_confidence"))


@query("a24_worst_errors", f"""
SELECT model, market_scope, forecast_horizon, asof_date, {r('confidence')} AS confidence FROM {PRED} WHERE actual_label <> predicted ORDER BY confidence DESC, asof_date, model, market_scope, forecast_horizon LIMIT 200""")
def a24_worst(t):
    wrong = predicted(t).where(F.col("actual_label") != F.col("predicted"))
    return wrong.orderBy(F.desc("confidence"), "asof_date", *PKEYS).limit(200).select(*PKEYS, "asof_date", rd("confidence").alias("confidence"))


TYPES = ["signup", "error", "click", "view", "purchase"]


@query("a25_event_counts_pivot", "SELECT ts::DATE AS day, " + ", ".join(f"count(*) FILTER (event_type = '{c}') AS {c}" for c in TYPES) + ", count(DISTINCT user_id) AS sources FROM events GROUP BY 1")
def a25(t):
    return t.table("events").groupBy(F.col("ts").cast("date").alias("day")).agg(
        *[F.count_if(F.col("event_type") == c).alias(c) for c in TYPES], F.count_distinct("user_id").alias("sources"))


@query("a26_surprise_aggregates", f"""
SELECT ts::DATE AS day, count(*) AS n, sum((s2 IS NOT NULL)::INT)::BIGINT AS has_consensus, max(abs(s1)) AS max_abs_z, {r('avg(' + sql_clip('s1 / 3', -1, 1) + ')')} AS score,
  {r("avg(" + sql_clip('s1 / 3', -1, 1) + ") FILTER (event_type = 'click')")} AS click_score FROM scores GROUP BY 1""")
def a26(t):
    signed = N.clip(F.col("s1") / 3, -1, 1)
    return t.scores.groupBy(F.col("ts").cast("date").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.count("s2").alias("has_consensus"), F.max(F.abs("s1")).alias("max_abs_z"), rd(F.avg(signed)).alias("score"),
        rd(F.avg(F.when(F.col("event_type") == "click", signed))).alias("click_score"))


@query("a27_ensemble_mean", f"""
SELECT market_scope, forecast_horizon, asof_date, count(*) AS members, {', '.join(r(f'avg({c})') + f' AS {c}' for c in PROBS_COLS)} FROM predictions GROUP BY 1, 2, 3 HAVING count(*) >= 2""")
def a27(t):
    from tidemark.plans.models import ensemble_mean

    return ensemble_mean(t.predictions, ["market_scope", "forecast_horizon", "asof_date"]).select(
        "market_scope", "forecast_horizon", "asof_date", "members", *[rd(c).alias(c) for c in PROBS_COLS])


@query("a28_weighted_ensemble", f"""
WITH y AS (SELECT model, market_scope, forecast_horizon, test_year, avg(balanced_accuracy) OVER (PARTITION BY model, market_scope, forecast_horizon ORDER BY test_year ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS w
  FROM ({class_sql(PRED, 'model, market_scope, forecast_horizon, test_year')}))
SELECT market_scope, forecast_horizon, asof_date, {', '.join(r(f'sum({c} * w) / nullif(sum(w), 0)') + f' AS {c}' for c in PROBS_COLS)} FROM predictions JOIN y USING (model, market_scope, forecast_horizon, test_year)
WHERE w IS NOT NULL GROUP BY 1, 2, 3 HAVING count(*) >= 2""")
def a28(t):
    from tidemark.plans.models import weighted_ensemble

    return weighted_ensemble(predicted(t), "predicted").select("market_scope", "forecast_horizon", "asof_date", *[rd(c).alias(c) for c in PROBS_COLS])


@query("a29_filing_counts", """
SELECT source, count(*) AS filings, count(*) FILTER (lang = 'en') AS en, count(*) FILTER (lang <> 'en') AS other, count(*) FILTER (n_chars > 2000) AS long_filings,
  array_to_string(list_slice(list_sort(list(lpad(n_chars::VARCHAR, 8, '0') || ':' || lpad(doc_id::VARCHAR, 8, '0')), 'DESC'), 1, 3), ',') AS top3 FROM documents GROUP BY 1""")
def a29(t):
    from tidemark.operators.relational import pick_first

    docs = t.table("documents").select("source", "lang", "n_chars", "doc_id")
    counts = docs.groupBy("source").agg(F.count(F.lit(1)).alias("filings"), F.count_if(F.col("lang") == "en").alias("en"),
                                        F.count_if(F.col("lang") != "en").alias("other"), F.count_if(F.col("n_chars") > 2000).alias("long_filings"))
    tag = F.concat_ws(":", F.lpad(F.col("n_chars").cast("string"), 8, "0"), F.lpad(F.col("doc_id").cast("string"), 8, "0"))
    top = pick_first(docs.select("source", tag.alias("tag")), ["source"], [F.desc("tag")], 3)
    heads = top.groupBy("source").agg(F.array_join(F.sort_array(F.collect_list("tag"), asc=False), ",").alias("top3"))
    return counts.join(heads, "source", "left")


@query("a30_value_counts", "SELECT s1 AS value, count(*) AS n FROM scores GROUP BY 1")
def a30(t):
    return M.value_counts(t.scores, "s1").withColumnRenamed("s1", "value")


@query("a31_state_change_summary", """
SELECT signal_code, count(*) AS bars, sum(c)::BIGINT AS changes, max(asof_ts) FILTER (c = 1) AS last_change FROM (
  SELECT *, coalesce(sign(change_pct) <> lag(sign(change_pct)) OVER (PARTITION BY signal_code ORDER BY asof_ts), false)::INT AS c FROM bars) GROUP BY 1""")
def a31(t):
    ax = Axis.of("signal_code", "asof_ts")
    side = F.signum("change_pct")
    rows = t.bars.withColumn("c", F.coalesce((side != F.lag(side).over(ax.by)).cast("int"), F.lit(0)))
    return rows.groupBy("signal_code").agg(F.count(F.lit(1)).alias("bars"), F.sum("c").alias("changes"),
                                           F.max(F.when(F.col("c") == 1, F.col("asof_ts"))).alias("last_change"))


@query("a32_series_span", "SELECT series_id, min(asof_date) AS first_date, max(asof_date) AS last_date, count(*) AS n FROM daily_obs GROUP BY 1")
def a32(t):
    return M.series_span(t.daily_obs, ["series_id"], "asof_date")


@query("a33_latest_universe_mean", f"SELECT max(date) AS date, count(*) AS n, {r('avg(close)', 4)} AS mean_close FROM stock_prices WHERE date = (SELECT max(date) FROM stock_prices WHERE date <= DATE '2001-06-30')")
def a33(t):
    rows = t.stock_prices.withColumn("k", F.lit("all"))
    last = R.rows_at_latest(rows, ["k"], "date", F.lit("2001-06-30").cast("date"))
    return last.agg(F.max("date").alias("date"), F.count(F.lit(1)).alias("n"), rd(F.avg("close"), 4).alias("mean_close"))


@query("a34_theme_coverage", """
SELECT n_name AS theme_bucket, count(c.ticker) AS stocks, r_name AS region, (count(c.ticker) > 0)::INT AS mapped FROM nation JOIN region ON n_regionkey = r_regionkey LEFT JOIN classification c ON c.theme_bucket = n_name GROUP BY 1, 3""")
def a34(t):
    counts = t.classification.groupBy("theme_bucket").agg(F.count("ticker").alias("stocks"))
    n, g = t.table("nation"), t.table("region")
    walk = n.join(g, n["n_regionkey"] == g["r_regionkey"]).select(F.col("n_name").alias("theme_bucket"), F.col("r_name").alias("region"))
    out = R.attach_with_default(walk, counts, ["theme_bucket"], {"stocks": 0})
    return out.withColumn("mapped", (F.col("stocks") > 0).cast("int"))


@query("a35_universe_breadth", f"""
SELECT market, date, count(*) FILTER (net_value > 0) AS advancers, count(*) FILTER (net_value < 0) AS decliners, count(*) FILTER (net_value = 0) AS flat_count,
  {r('(count(*) FILTER (net_value > 0) + 1)::DOUBLE / (count(*) FILTER (net_value < 0) + 1)')} AS adv_dec_ratio, {r('count(*) FILTER (net_value > 0)::DOUBLE / count(*)')} AS positive_ratio FROM flows GROUP BY 1, 2""")
def a35(t):
    out = t.flows.groupBy("market", "date").agg(*M.breadth("net_value"))
    return out.withColumns({"adv_dec_ratio": rd("adv_dec_ratio"), "positive_ratio": rd("positive_ratio")})


@query("a36_confidence_scorecard", f"""
SELECT model, market_scope, count(*) AS n, {r('avg(confidence)')} AS mean_confidence, {r('median(confidence)')} AS median_confidence, {r('avg(confidence - (1 - confidence - least(prob_down, prob_sideways, prob_up)))')} AS mean_margin,
  {r('avg((confidence < 0.45)::INT)')} AS low_confidence_ratio FROM {PRED} GROUP BY 1, 2""")
def a36(t):
    from tidemark.plans.models import confidence_stats

    return confidence_stats(predicted(t), ["model", "market_scope"], 0.45).select(
        "model", "market_scope", "n", *[rd(c).alias(c) for c in ("mean_confidence", "median_confidence", "mean_margin", "low_confidence_ratio")])


# -- quality -------------------------------------------------------------------------

@query("q1_missing_rates", "SELECT unnest(['s1', 's2', 's3', 'u1']) AS column_name, unnest([" + ", ".join(r(f"avg(({c} IS NULL)::INT)") for c in ("s1", "s2", "s3", "u1")) + "]) AS missing_rate FROM scores")
def q1(t):
    return Q.missing_rates(t.scores, ["s1", "s2", "s3", "u1"])


@query("q2_duplicate_keys", "SELECT coalesce(sum(n), 0)::BIGINT AS all_members, coalesce(sum(n - 1), 0)::BIGINT AS extras FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)")
def q2(t):
    return Q.duplicate_keys(t.table("lineitem"), ["l_orderkey", "l_linenumber"])


@query("q3_missing_days", """
SELECT market_scope, (SELECT count(*) FROM spine) - count(DISTINCT date) AS missing_dates FROM scope_prices GROUP BY 1""")
def q3(t):
    return Q.missing_days(t.scope_prices, t.spine, "market_scope", ["KOSPI", "KOSDAQ", "KOSPI200"], "date")


@query("q3_scope_coverage", "SELECT market_scope, min(date) AS first_date, max(date) AS last_date, count(DISTINCT date) AS days FROM scope_prices GROUP BY 1")
def q3b(t):
    return Q.scope_coverage(t.scope_prices, "market_scope", "date")


@query("q4_coverage_flags", f"""
SELECT event_id, a_available, {r('a_coverage_ratio')} AS a_coverage_ratio, a_null_count, b_available, {r('(a_coverage_ratio + b_coverage_ratio) / 2')} AS coverage_ratio,
  CASE WHEN (a_coverage_ratio + b_coverage_ratio) / 2 >= 0.85 THEN 'high' WHEN (a_coverage_ratio + b_coverage_ratio) / 2 >= 0.65 THEN 'medium' WHEN (a_coverage_ratio + b_coverage_ratio) / 2 >= 0.35 THEN 'low' ELSE 'very_low' END AS coverage_quality
FROM (SELECT event_id, (s1 IS NOT NULL OR s2 IS NOT NULL)::INT AS a_available, ((s1 IS NOT NULL)::INT + (s2 IS NOT NULL)::INT)::DOUBLE / 2 AS a_coverage_ratio,
  (s1 IS NULL)::INT + (s2 IS NULL)::INT AS a_null_count, (s3 IS NOT NULL)::INT AS b_available, (s3 IS NOT NULL)::INT::DOUBLE AS b_coverage_ratio FROM scores)""")
def q4(t):
    out = Q.with_coverage(t.scores, {"a": ["s1", "s2"], "b": ["s3"]}, L.coverage_quality)
    return out.select("event_id", "a_available", "a_coverage_ratio", "a_null_count", "b_available", "coverage_ratio", "coverage_quality")


@query("q5_leakage_checks", f"""
SELECT unnest(['source_before_asof', 'target_after_asof', 'no_target_in_features']) AS check_name,
  unnest([count(*) FILTER (src >= date), count(*) FILTER (fin <= date), 0]) AS failed_rows, count(*) AS checked_rows,
  unnest([CASE WHEN count(*) FILTER (src >= date) = 0 THEN 'ok' ELSE 'failed' END, CASE WHEN count(*) FILTER (fin <= date) = 0 THEN 'ok' ELSE 'failed' END, 'ok']) AS status
FROM (SELECT date, lag(date) OVER ({PS}) AS src, lead(date, 5) OVER ({PS}) AS fin FROM scope_prices)""")
def q5(t):
    rows = t.scope_prices.select("date", F.lag("date").over(SCOPE.by).alias("src"), F.lead("date", 5).over(SCOPE.by).alias("fin"))
    return Q.leakage_checks(rows, "date", "src", "fin", ["ret_1m", "vol_20d"])


@query("q7_signal_contract", """
SELECT 'direction_enum' AS check_name, count(*) FILTER (actual_label NOT IN ('down', 'sideways', 'up')) AS failed_rows, count(*) AS checked_rows, 'ok' AS status FROM predictions
UNION ALL SELECT 'scope_enum', count(*) FILTER (market_scope = 'KOSPI200'), count(*), 'failed' FROM predictions
UNION ALL SELECT 'horizon_enum', 0, count(*), 'ok' FROM predictions UNION ALL SELECT 'probability_range', 0, count(*), 'ok' FROM predictions
UNION ALL SELECT 'probability_sum', 0, count(*), 'ok' FROM predictions UNION ALL SELECT 'confidence_range', 0, count(*), 'ok' FROM predictions
UNION ALL SELECT 'unique_key', sum(n - 1)::BIGINT, sum(n)::BIGINT, 'failed' FROM (SELECT count(*) AS n FROM predictions GROUP BY asof_date, market_scope, forecast_horizon)""")
def q7(t):
    rows = predicted(t).withColumn("predicted_direction", F.col("actual_label"))
    return Q.check(rows, Q.signal_constraints(["down", "sideways", "up"], ["ALL", "KOSPI", "KOSDAQ"], ["5d", "20d"]), ["asof_date", "market_scope", "forecast_horizon"])


@query("q8_forecast_contract", """
SELECT g.s AS market_scope, h.h AS forecast_horizon FROM (VALUES ('ALL'), ('KOSPI'), ('KOSDAQ')) g(s), (VALUES ('5d'), ('20d'), ('60d')) h(h)
WHERE NOT EXISTS (SELECT 1 FROM predictions p WHERE p.market_scope = g.s AND p.forecast_horizon = h.h AND p.asof_date = (SELECT max(asof_date) FROM predictions))""")
def q8(t):
    p = t.predictions
    latest = p.where(F.col("asof_date") == p.agg(F.max("asof_date")).scalar())
    required = R.explode_grid(p.agg(F.max("asof_date").alias("asof_date")), [
        {"market_scope": s, "forecast_horizon": h} for s in ("ALL", "KOSPI", "KOSDAQ") for h in ("5d", "20d", "60d")])
    return R.missing_keys(required, latest, ["market_scope", "forecast_horizon"])


@query("q9_table_presence", """
SELECT 'orders' AS table_name, count(*) AS n, (count(*) > 0)::INT AS not_empty FROM orders UNION ALL SELECT 'lineitem', count(*), (count(*) > 0)::INT FROM lineitem
UNION ALL SELECT 'events', count(*), (count(*) > 0)::INT FROM events""")
def q9(t):
    one = lambda n: t.table(n).agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("n"), (F.count(F.lit(1)) > 0).cast("int").alias("not_empty"))
    return one("orders").unionByName(one("lineitem")).unionByName(one("events"))


@query("q10_payload_keys", """
SELECT event_type, count(*) AS documents, count(*) FILTER (json_extract(props, '$.k') IS NULL OR event_id % 10 = 0)::BIGINT AS lacking_keys, (count(DISTINCT user_id % 1) <= 1)::INT AS consistent_market FROM events GROUP BY 1""")
def q10(t):
    doc = F.when(F.col("event_id") % 10 == 0, F.to_json(F.struct(F.lit("KR").alias("market")))).otherwise(
        F.to_json(F.struct(F.lit("KR").alias("market"), F.get_json_object("props", "$.k").alias("k"))))
    return Q.payload_checks(t.table("events").select("event_type", doc.alias("doc")), "doc", ["market", "k"], "event_type")


@query("q11_rate_completeness", """
SELECT asof_date, count(*) FILTER (value > 0) AS present, 13 - count(*) FILTER (value > 0) AS missing, (count(*) FILTER (value > 0) = 13)::INT AS complete FROM daily_obs GROUP BY 1""")
def q11(t):
    good = F.count_if(F.col("value") > 0)
    return t.daily_obs.groupBy("asof_date").agg(good.alias("present"), (F.lit(13) - good).alias("missing"), (good == 13).cast("int").alias("complete"))
