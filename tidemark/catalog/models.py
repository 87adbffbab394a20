"""Model queries (M1-M18) on daily direction and return datasets of the sample tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.expressions import rd
from tidemark.catalog.fits import fold_rows_sql, ridge_sql
from tidemark.catalog.marts import direction_sql, proxy_sql
from tidemark.catalog.registry import CTES, query, r, sql_clip
from tidemark.operators import metrics as M
from tidemark.operators.expanding import expanding_modes
from tidemark.operators import windows as W
from tidemark.operators.windows import Axis
from tidemark.plans import context as C
from tidemark.plans import models as MD
from tidemark.plans import walkforward as WF
from tidemark.plans.backtest import PROBS
from tidemark.plans.research import axis_dataset

SCOPE = Axis.of("market_scope", "date")
PS = "PARTITION BY market_scope ORDER BY date"
FIVE_CLASSES = ["strong_down", "mild_down", "sideways", "mild_up", "strong_up"]
FEATURES = ["ret_1m", "ret_3m", "vol_20d", "mdd_3m", "above_sma20", "above_sma60", "trading_value_expansion_ratio"]


CTES["m_features"] = proxy_sql("scope_prices", "market_scope")


def features(t):
    return C.proxy_features(t.scope_prices, "market_scope").withColumnRenamed("date", "asof_date")


def directions(t):
    labels = axis_dataset(t.scope_prices, {5: "forward_return_5d"}).withColumnRenamed("direction_label_3class_5d", "label")
    return features(t).join(labels.select("asof_date", "market_scope", "label", "direction_label_5d"), ["asof_date", "market_scope"])


def returns(t):
    fwd = t.scope_prices.select("market_scope", F.col("date").alias("asof_date"), W.forward_return(SCOPE, "close", 5).alias("target"))
    return features(t).join(fwd, ["asof_date", "market_scope"])


def probabilities(df, keys):
    return df.select(*keys, *[rd(c, 4).alias(c) for c in PROBS.values()])


CTES["m_returns"] = f"SELECT market_scope, date AS asof_date, {', '.join(FEATURES)}, lead(close, 5) OVER ({PS}) / close - 1 AS target FROM m_features"


@query("m1_walk_forward_ridge", ridge_sql("SELECT * FROM m_returns", ["market_scope"], "asof_date", FEATURES, "target", f"""
SELECT market_scope, asof_date, known AS training_sample_count, {r('pred')} AS prediction, label AS calibrated_forecast_label, confidence AS calibration_confidence_score FROM p""", embargo=5))
def m1(t):
    out = WF.walk_forward_ridge(returns(t), ["market_scope"], "asof_date", FEATURES, "target", embargo_rows=5)
    return out.select("market_scope", "asof_date", "training_sample_count", rd("predicted_forward_return").alias("prediction"), "calibrated_forecast_label", "calibration_confidence_score")


CTES["m_pred"] = f"""SELECT market_scope, date, forecast_horizon, real, lag(x, 1) OVER (PARTITION BY market_scope, forecast_horizon ORDER BY date) AS a, lag(x, 2) OVER (PARTITION BY market_scope, forecast_horizon ORDER BY date) AS b FROM (
  SELECT market_scope, date, h.h AS forecast_horizon, CASE h.h WHEN '5d' THEN r5 ELSE r20 END AS real, x FROM (
    SELECT market_scope, date, lead(close, 5) OVER ({PS}) / close - 1 AS r5, lead(close, 20) OVER ({PS}) / close - 1 AS r20, close / 250000.0::DOUBLE - 1 AS x FROM scope_prices), (VALUES ('5d'), ('20d')) h(h))"""


def stand_in(t):
    """Two lagged level predictions against forward returns, per scope and horizon."""
    rows = t.scope_prices.withColumns({"__5d": W.forward_return(SCOPE, "close", 5), "__20d": W.forward_return(SCOPE, "close", 20), "x": F.col("close") / 250000.0 - 1})
    long = rows.select("market_scope", "date", "x", F.explode(F.array(*[F.struct(F.lit(h).alias("forecast_horizon"), F.col(f"__{h}").alias("real")) for h in ("5d", "20d")])).alias("e"))
    ax = Axis.of(["market_scope", "forecast_horizon"], "date")
    long = long.select("market_scope", "date", "x", "e.*")
    return long.withColumns({"a": F.lag("x", 1).over(ax.by), "b": F.lag("x", 2).over(ax.by)})


CMP = """SELECT market_scope, forecast_horizon, count(*) AS n, corr(a, real) AS ca, corr(b, real) AS cb, avg(((a > 0) = (real > 0))::INT) AS ha, avg(((b > 0) = (real > 0))::INT) AS hb, avg(abs(a - real)) AS ea, avg(abs(b - real)) AS eb
FROM m_pred WHERE a IS NOT NULL AND b IS NOT NULL AND real IS NOT NULL GROUP BY 1, 2"""


M2_SCORE = sql_clip("(a - m) / nullif(s, 0)")


@query("m2_calibrated_scores", f"""
SELECT market_scope, date, forecast_horizon, {r('a', 8)} AS predicted_forward_return, {r('z', 6)} AS calibrated_forecast_score, CASE WHEN z IS NULL THEN NULL WHEN z >= 0.75 THEN 'bullish' WHEN z >= 0.2 THEN 'mild_bullish'
  WHEN z > -0.2 THEN 'neutral' WHEN z > -0.75 THEN 'mild_bearish' ELSE 'bearish' END AS calibrated_forecast_label,
  CASE WHEN a IS NULL THEN 0 ELSE {r(sql_clip("0.45::DOUBLE * least(1::DOUBLE, sqrt(c / 1000.0::DOUBLE)) + 0.35::DOUBLE * (1.0::DOUBLE - ((a IS NULL)::INT + (b IS NULL)::INT) / 2.0::DOUBLE) + 0.20::DOUBLE * least(1::DOUBLE, abs(coalesce(z, 0)) / 1.5::DOUBLE)", 0, 1), 4)} END AS calibration_confidence_score
FROM (SELECT *, {M2_SCORE} AS z FROM (SELECT *, avg(real) OVER w AS m, stddev_pop(real) OVER w AS s, count(real) OVER w AS c FROM m_pred WINDOW w AS (PARTITION BY market_scope, forecast_horizon ORDER BY date ROWS BETWEEN 280 PRECEDING AND 21 PRECEDING)))""")
def m2(t):
    """Scores of the stand-in prediction against the targets known by then."""
    past = Axis.of(["market_scope", "forecast_horizon"], "date").by.rowsBetween(-280, -21)
    rows = stand_in(t).withColumns({"m": F.avg("real").over(past), "s": F.stddev_pop("real").over(past), "c": F.count("real").over(past)})
    return WF.calibrated(rows, "a", "m", "s", "c", ["a", "b"]).select("market_scope", "date", "forecast_horizon", "predicted_forward_return", "calibrated_forecast_score", "calibrated_forecast_label", "calibration_confidence_score")


@query("m6_mode_imputation", """
WITH o AS (SELECT o_orderstatus AS scope, year(o_orderdate) AS y, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END AS c FROM orders),
f AS (SELECT DISTINCT scope, y FROM o),
m AS (SELECT f.scope, f.y, o.c, count(*) AS n FROM f JOIN o ON o.scope = f.scope AND o.y < f.y WHERE o.c IS NOT NULL GROUP BY 1, 2, 3 QUALIFY row_number() OVER (PARTITION BY f.scope, f.y ORDER BY count(*) DESC, o.c) = 1)
SELECT o.scope, o.y AS test_year, coalesce(o.c, m.c) AS category, count(*) AS n, count(*) FILTER (o.c IS NULL) AS imputed FROM o LEFT JOIN m ON m.scope = o.scope AND m.y = o.y GROUP BY 1, 2, 3""")
def m6_modes(t):
    """Missing categories of a year take the most frequent one of the years before."""
    rows = t.table("orders").select(F.col("o_orderstatus").alias("scope"), F.year("o_orderdate").alias("test_year"), F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderpriority")).alias("c"))
    folds = rows.select("scope", (F.col("test_year") - 1).alias("before")).distinct()
    modes = expanding_modes(rows, ["scope"], "test_year", folds, "before", ["c"]).select("scope", (F.col("before") + 1).alias("test_year"), "mode")
    filled = rows.join(modes, ["scope", "test_year"], "left").withColumn("category", F.coalesce("c", "mode"))
    return filled.groupBy("scope", "test_year", "category").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("c").isNull()).alias("imputed"))


@query("m13_evaluation", f"""
WITH l AS (SELECT market_scope, date, CASE WHEN fwd <= q[2] THEN 'down' WHEN fwd <= q[3] THEN 'sideways' WHEN fwd IS NOT NULL THEN 'up' END AS a FROM (SELECT market_scope, date, lead(close, 5) OVER ({PS}) / close - 1 AS fwd FROM scope_prices) f
  JOIN (SELECT market_scope, quantile_cont(fwd, [0.2, 0.4, 0.6, 0.8]) AS q FROM (SELECT market_scope, lead(close, 5) OVER ({PS}) / close - 1 AS fwd FROM scope_prices) GROUP BY 1) USING (market_scope)),
p AS (SELECT *, lag(a) OVER ({PS}) AS p, year(date) AS test_year FROM l),
c AS (SELECT market_scope, test_year, k, count(*) FILTER (a = k AND p = k) AS tp, count(*) FILTER (a = k) AS na, count(*) FILTER (p = k) AS np FROM p, (SELECT unnest(['down', 'sideways', 'up']) AS k) WHERE a IS NOT NULL AND p IS NOT NULL GROUP BY 1, 2, 3)
SELECT market_scope, test_year, sum(na)::BIGINT AS n, {r('sum(tp) / sum(na)::DOUBLE')} AS accuracy, {r('avg(CASE WHEN na > 0 THEN tp / na::DOUBLE END)')} AS balanced_accuracy,
  {r('sum(CASE WHEN na + np > 0 THEN 2 * tp / (na + np)::DOUBLE ELSE 0 END) / 3')} AS macro_f1, {r('max(na) / sum(na)::DOUBLE')} AS majority_baseline FROM c GROUP BY 1, 2""")
def m13(t):
    """Yearly scores of one model's predictions beside the majority class; the label of the day before stands for a prediction."""
    rows = directions(t).select("market_scope", "asof_date", F.year("asof_date").alias("test_year"), F.col("label").alias("a"))
    rows = rows.withColumn("p", F.lag("a").over(Axis.of("market_scope", "asof_date").by)).where("a IS NOT NULL AND p IS NOT NULL")
    card = M.classification_scorecard(rows, ["market_scope", "test_year"], "a", "p")
    return card.select("market_scope", "test_year", "n", *[rd(c).alias(c) for c in ("accuracy", "balanced_accuracy", "macro_f1", "majority_baseline")])


@query("m14_model_comparison", f"SELECT market_scope, forecast_horizon, n AS overlap_rows, {r('ca - cb')} AS corr_diff, {r('ha - hb')} AS hit_diff, {r('ea - eb')} AS mae_diff FROM ({CMP})")
def m14(t):
    return MD.compare_models(stand_in(t), "a", "b", "real").select("market_scope", "forecast_horizon", "overlap_rows", *[rd(f"{c}_diff").alias(f"{c}_diff") for c in ("corr", "hit", "mae")])


@query("m14_comparison_decision", f"""
SELECT *, CASE WHEN corr_wins >= 2 AND hit_wins >= 2 THEN 'promote_candidate' ELSE 'keep_primary' END AS decision FROM (
  SELECT count(*) FILTER (ca - cb > 0) AS corr_wins, count(*) FILTER (ha - hb > 0) AS hit_wins, count(*) FILTER (ea - eb < 0) AS mae_wins, count(*) AS total FROM ({CMP}) WHERE forecast_horizon = '20d')""")
def m14_decision(t):
    return MD.comparison_decision(MD.compare_models(stand_in(t), "a", "b", "real"))


@query("m5_promotion_gate", """
SELECT passed, CASE WHEN passed >= 2 THEN 'promote_candidate' ELSE 'research_only' END AS status FROM (SELECT count(*) FILTER (forecast_horizon = '20d' AND c >= -0.2 AND h >= 0.4) AS passed FROM (
  SELECT market_scope, forecast_horizon, corr(a, real) AS c, avg((sign(a) = sign(real))::INT) AS h FROM m_pred WHERE a IS NOT NULL AND real IS NOT NULL GROUP BY 1, 2))""")
def m5(t):
    metrics = stand_in(t).groupBy("market_scope", "forecast_horizon").agg(*M.regression_errors("a", "real"))
    return MD.promotion_gate(metrics, min_corr=-0.2, min_hit=0.4)


@query("m3_chronological_split", """
SELECT market_scope, (rn <= floor(n * 0.8))::INT AS is_train, count(*) AS n, min(date) AS first_date, max(date) AS last_date FROM (SELECT *, row_number() OVER (PARTITION BY market_scope ORDER BY date) AS rn, count(*) OVER (PARTITION BY market_scope) AS n FROM scope_prices) GROUP BY 1, 2""")
def m3_split(t):
    from tidemark.plans.model_input import chronological_split

    rows = chronological_split(t.scope_prices, ["market_scope"], "date")
    return rows.groupBy("market_scope", F.col("is_train").cast("int").alias("is_train")).agg(F.count(F.lit(1)).alias("n"), F.min("date").alias("first_date"), F.max("date").alias("last_date"))


@query("m16_holdout_split", """
SELECT market_scope, (rn <= least(greatest(floor(n * 0.8), n - 500), n - 50))::INT AS is_train, count(*) AS n, max(date) AS last_date FROM (SELECT *, row_number() OVER (PARTITION BY market_scope ORDER BY date) AS rn, count(*) OVER (PARTITION BY market_scope) AS n FROM scope_prices) GROUP BY 1, 2""")
def m16_split(t):
    rows = MD.holdout_split(t.scope_prices, ["market_scope"], "date")
    return rows.groupBy("market_scope", F.col("is_train").cast("int").alias("is_train")).agg(F.count(F.lit(1)).alias("n"), F.max("date").alias("last_date"))


@query("m6_capped_categories", """
SELECT coalesce(CASE WHEN rk <= 12 THEN p_brand ELSE 'infrequent' END, 'none') AS category, sum(n)::BIGINT AS n FROM (SELECT p_brand, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, p_brand) AS rk FROM part GROUP BY 1) GROUP BY 1""")
def m6(t):
    rows = MD.capped_category(t.table("part"), "p_brand", "category", 12)
    return rows.groupBy("category").agg(F.count(F.lit(1)).alias("n"))


@query("p22_feature_usability", f"""
SELECT market_scope, unnest(['value', 'flat']) AS feature, unnest([count(value), count(*)]) AS present, unnest([min(value) < max(value), false]) AS varies FROM scope_prices GROUP BY 1""")
def p22(t):
    rows = t.scope_prices.withColumn("flat", F.lit(1.0))
    return M.feature_usability(rows, ["market_scope"], ["value", "flat"]).drop("rows")


NUMERIC = ["close", "value", "ret_1m", "ret_3m", "above_sma20", "above_sma60", "above_sma120", "new_high_ratio_20d", "new_low_ratio_20d", "trading_value_expansion_ratio", "ret_pos_1m", "vol_20d", "mdd_3m"]


@query("p21_feature_columns", f"""
SELECT feature, {direction_sql('feature')} AS direction, present FROM (SELECT unnest([{', '.join(f"'{c}'" for c in NUMERIC)}]) AS feature, unnest([{', '.join(f'count({c})' for c in NUMERIC)}]) AS present FROM m_features)""")
def p21(t):
    from tidemark.plans.model_input import feature_columns, score_direction

    df = features(t)
    names = feature_columns(df.schema, keys=("asof_date", "market_scope"), numeric_only=True)
    cells = F.array(*[F.struct(F.lit(n).alias("feature"), F.lit(score_direction(n)).alias("direction"), F.count(n).alias("present")) for n in names])
    return df.agg(cells.alias("c")).select(F.explode("c").alias("x")).select("x.*")


@query("m3_holdout_regression")
def m3(t):
    out = MD.holdout_regression(returns(t), ["market_scope"], "asof_date", FEATURES, "target")
    return out.groupBy("market_scope").agg(*M.regression_errors("prediction", "target")).select("market_scope", "n", rd("mae", 4).alias("mae"), rd("rmse", 4).alias("rmse"))


@query("m4_walk_forward_candidates")
def m4(t):
    out = WF.walk_forward_candidates(returns(t), ["market_scope"], "asof_date", FEATURES[:4], "target", embargo_rows=5)
    return out.where(F.col("prediction").isNotNull()).groupBy("market_scope", "model").agg(*M.regression_errors("prediction", "target")).select("market_scope", "model", "n", rd("mae").alias("mae"))


@query("m4_fold_rows", "WITH " + ", ".join(f"{n} AS ({body})" for n, body in fold_rows_sql("SELECT * FROM m_returns", "market_scope", "asof_date", "target", 756, 20, 5).items()) + """
SELECT market_scope, a.fold, n_train, last_train, n_predicted, first_predicted, last_predicted FROM (SELECT market_scope, fold, count(*) AS n_predicted, min(asof_date) AS first_predicted, max(asof_date) AS last_predicted FROM fr WHERE fold IS NOT NULL GROUP BY 1, 2) a
JOIN (SELECT market_scope, f AS fold, count(*) AS n_train, max(asof_date) AS last_train FROM ft GROUP BY 1, 2) b USING (market_scope, fold)""")
def m4_rows(t):
    return WF.fold_rows(returns(t), ["market_scope"], "asof_date", "target", embargo_rows=5)


def run(t, kind, first_year):
    return MD.walk_forward_direction(directions(t), ["market_scope"], "asof_date", FEATURES, "label", kind, first_year=first_year)


def logistic(t, first_year, parts=0):
    return MD.walk_forward_logistic(directions(t), ["market_scope"], "asof_date", FEATURES, "label", first_year=first_year, parts=parts)


@query("m7_logistic_directions")
def m7(t):
    out, _ = logistic(t, 1998)
    return probabilities(out, ["market_scope", "asof_date", "test_year", "actual_label"])


@query("m7_forest_directions")
def m7_forest(t):
    out, _ = run(t, "random_forest", 2000)
    return probabilities(out, ["market_scope", "asof_date", "test_year", "actual_label"])


@query("m7_boosted_directions")
def m7_boosted(t):
    out, _ = run(t, "boosted", 2001)
    return probabilities(out, ["market_scope", "asof_date", "test_year", "actual_label"])


@query("m8_sigmoid_calibration")
def m8(t):
    out, _ = logistic(t, 2001, parts=3)
    return probabilities(out, ["market_scope", "asof_date", "test_year", "actual_label"])


@query("m9_coefficients")
def m9(t):
    _, rows = logistic(t, 2000)
    return rows.withColumn("coefficient", rd("coefficient", 4))


@query("m16_holdout_directions")
def m16(t):
    out = MD.holdout_direction(directions(t), ["market_scope"], "asof_date", FEATURES, "label")
    return probabilities(out, ["market_scope", "asof_date", "actual_label", "latest"])


@query("m16_holdout_five_classes")
def m16_five(t):
    out = MD.holdout_direction(directions(t), ["market_scope"], "asof_date", FEATURES, "direction_label_5d", FIVE_CLASSES)
    return out.select("market_scope", "asof_date", "actual_label", "latest", *[rd(c, 4).alias(c) for c in MD.prob_names(FIVE_CLASSES)])


FIVE_LABEL = "CASE WHEN fwd <= q[1] THEN 'strong_down' WHEN fwd <= q[2] THEN 'mild_down' WHEN fwd <= q[3] THEN 'sideways' WHEN fwd <= q[4] THEN 'mild_up' WHEN fwd IS NOT NULL THEN 'strong_up' END"


@query("m16_five_class_metrics", f"""
WITH f AS (SELECT market_scope, date, lead(close, 5) OVER ({PS}) / close - 1 AS fwd FROM scope_prices),
l AS (SELECT market_scope, date, {FIVE_LABEL} AS a FROM f JOIN (SELECT market_scope, quantile_cont(fwd, [0.2, 0.4, 0.6, 0.8]) AS q FROM f GROUP BY 1) USING (market_scope)),
p AS (SELECT market_scope, a, lag(a) OVER ({PS}) AS p FROM l),
c AS (SELECT market_scope, k, count(*) FILTER (a = k AND p = k) AS tp, count(*) FILTER (a = k) AS na, count(*) FILTER (p = k) AS np FROM p, (SELECT unnest([{', '.join(f"'{c}'" for c in FIVE_CLASSES)}]) AS k) WHERE a IS NOT NULL AND p IS NOT NULL GROUP BY 1, 2)
SELECT market_scope, sum(na)::BIGINT AS n, {r('sum(tp) / sum(na)::DOUBLE')} AS accuracy, {r('avg(CASE WHEN na > 0 THEN tp / na::DOUBLE END)')} AS balanced_accuracy,
  {r('sum(CASE WHEN na + np > 0 THEN 2 * tp / (na + np)::DOUBLE ELSE 0 END) / 5')} AS macro_f1 FROM c GROUP BY 1""")
def m16_metrics(t):
    """Scores of five classes; the label of the day before stands for a prediction."""
    rows = directions(t).select("market_scope", "asof_date", F.col("direction_label_5d").alias("a"))
    rows = rows.withColumn("p", F.lag("a").over(Axis.of("market_scope", "asof_date").by)).where("a IS NOT NULL AND p IS NOT NULL")
    card = M.classification_scorecard(rows, ["market_scope"], "a", "p", classes=FIVE_CLASSES)
    return card.select("market_scope", "n", *[rd(c).alias(c) for c in ("accuracy", "balanced_accuracy", "macro_f1")])


@query("m17_raw_against_calibrated")
def m17(t):
    raw, _ = logistic(t, 2001)
    calibrated, _ = logistic(t, 2001, parts=3)
    both = raw.withColumn("model", F.lit("raw")).unionByName(calibrated.withColumn("model", F.lit("sigmoid")))
    from tidemark.functions import labels as L
    from tidemark.plans.backtest import run_backtest, with_confidence

    decided = with_confidence(both.withColumn("predicted_direction", L.argmax_label(PROBS)))
    exposed = decided.withColumns({"exposure": L.lookup({"up": 1.0, "sideways": 0.5, "down": 0.0}, "predicted_direction"), "low_confidence": F.lit(0.0)})
    nxt = t.scope_prices.select(F.col("date").alias("asof_date"), "market_scope", (W.forward_return(SCOPE, "close", 1) / 50).alias("next_return"))
    keys = ["model", "market_scope"]
    card = run_backtest(exposed, nxt, keys=keys)[1].select(*keys, rd("sharpe", 3).alias("sharpe"))
    quality = M.classification_scorecard(decided, keys, "actual_label", "predicted_direction").select(*keys, rd("balanced_accuracy", 3).alias("balanced_accuracy"))
    stats = MD.confidence_stats(decided, keys, 0.4).select(*keys, rd("mean_confidence", 3).alias("mean_confidence"))
    return card.join(quality, keys).join(stats, keys)


@query("m18_logistic_diagnostics")
def m18(t):
    out, rows = logistic(t, 2000)
    pack = MD.logistic_diagnostics(out, rows, ["market_scope"])
    return pack["importance"].select("class", "feature", rd("mean_coefficient", 3).alias("mean_coefficient"), "positive_years", "negative_years", "years")


@query("m15_latest_inference")
def m15(t):
    """Fit each scope on all its rows, publish the model, load it again and score the newest day."""
    from tidemark.plans import foldmodels as FM
    from tidemark.session import scratch_folder

    rows, root = directions(t), scratch_folder(t.spark, "direction-model")
    folds = FM.prefix_folds(rows, ["market_scope"], "asof_date", FEATURES, "label", list(PROBS), FM.whole_cuts(["market_scope"], 200))
    version = FM.save(folds, FM.fit(folds), root)
    model, fitted = FM.load(t.spark, root)
    out = FM.score_newest(model, fitted, rows, "asof_date", list(PROBS.values()))
    return probabilities(out, ["market_scope", "asof_date"]).withColumn("model_version", F.lit(version.number))
