"""Threshold tuning, backtests, hand-over and axis research."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.aggregates import class_sql
from tidemark.catalog.expressions import rd
from tidemark.catalog.registry import CTES, query, r, sql_roll
from tidemark.operators import windows as W
from tidemark.operators.windows import Axis
from tidemark.plans import backtest as B
from tidemark.plans.specs import CONFIDENCE_FLOORS, NEAR_BEST_TOLERANCE, RULE_PROFILES, THRESHOLD_GRID

SCOPE = Axis.of("market_scope", "date")
PS = "PARTITION BY market_scope ORDER BY date"
K = "label_policy, model, market_scope, forecast_horizon"
ARGMAX = "CASE WHEN prob_down >= prob_sideways AND prob_down >= prob_up THEN 'down' WHEN prob_sideways >= prob_up THEN 'sideways' ELSE 'up' END"
THRESH = "CASE WHEN prob_down >= {0} AND prob_down >= prob_up THEN 'down' WHEN prob_up >= {1} AND prob_up > prob_down THEN 'up' ELSE 'sideways' END"
C3 = ("down", "sideways", "up")

CTES["m10_grid"] = f"SELECT d AS down_threshold, u AS up_threshold, row_number() OVER (ORDER BY d, u) AS gi FROM (SELECT unnest({THRESHOLD_GRID})::DOUBLE AS d), (SELECT unnest({THRESHOLD_GRID})::DOUBLE AS u)"
CTES["m10_train"] = f"""SELECT p.label_policy, p.model, p.market_scope, p.forecast_horizon, y.test_year, g.gi, g.down_threshold, g.up_threshold, p.actual_label, {THRESH.format('g.down_threshold', 'g.up_threshold')} AS predicted
FROM predictions p JOIN (SELECT DISTINCT {K}, test_year FROM predictions) y ON p.model = y.model AND p.market_scope = y.market_scope AND p.forecast_horizon = y.forecast_horizon AND p.test_year < y.test_year CROSS JOIN m10_grid g"""
CTES["m10_best"] = f"""SELECT * FROM ({class_sql('m10_train', K + ', test_year, gi, down_threshold, up_threshold')})
QUALIFY row_number() OVER (PARTITION BY {K}, test_year ORDER BY balanced_accuracy DESC, macro_f1 DESC, accuracy DESC, gi) = 1"""
CTES["m10_rows"] = f"SELECT p.*, {THRESH.format('t.down_threshold', 't.up_threshold')} AS tuned, {ARGMAX} AS argmax FROM predictions p JOIN m10_best t USING (label_policy, model, market_scope, forecast_horizon, test_year)"
AVG = ", ".join(f"avg({m}) AS {{0}}_{m}_avg" for m in ("accuracy", "balanced_accuracy", "macro_f1"))
CTES["m10_card"] = f"""SELECT *, tuned_balanced_accuracy_avg - argmax_balanced_accuracy_avg AS lift FROM (SELECT {K}, count(*) AS years, {AVG.format('tuned')} FROM ({class_sql('m10_rows', K + ', test_year', 'actual_label', 'tuned')}) GROUP BY {K})
JOIN (SELECT {K}, {AVG.format('argmax')} FROM ({class_sql('m10_rows', K + ', test_year', 'actual_label', 'argmax')}) GROUP BY {K}) USING (label_policy, model, market_scope, forecast_horizon)"""


def best_sql(side: str, method: str, kind: str) -> str:
    order = ", ".join(f"round({side}_{m}_avg, 10) DESC" for m in ("balanced_accuracy", "macro_f1", "accuracy"))
    return f"""SELECT market_scope, forecast_horizon, '{kind}' AS candidate_type, '{method}' AS decision_method, label_policy, model, {side}_balanced_accuracy_avg AS sel, lift FROM m10_card
      QUALIFY row_number() OVER (PARTITION BY market_scope, forecast_horizon ORDER BY {order}, label_policy, model) = 1"""


CTES["k21_pair"] = f"SELECT * FROM ({best_sql('tuned', 'threshold', 'threshold_best')}) UNION ALL SELECT * FROM ({best_sql('argmax', 'argmax', 'argmax_best')})"
CTES["k21_cand"] = """SELECT * FROM k21_pair UNION ALL SELECT p.* REPLACE ('selected' AS candidate_type) FROM k21_pair p JOIN (SELECT market_scope, forecast_horizon, lift > 0 AS up FROM k21_pair WHERE candidate_type = 'threshold_best') l
 USING (market_scope, forecast_horizon) WHERE (p.decision_method = 'threshold') = l.up"""
CTES["k21_pred"] = f"""SELECT c.candidate_type, p.*, greatest(prob_down, prob_sideways, prob_up) AS confidence, CASE WHEN c.decision_method = 'argmax' OR t.down_threshold IS NULL THEN {ARGMAX} ELSE {THRESH.format('t.down_threshold', 't.up_threshold')} END AS direction
FROM predictions p JOIN k21_cand c USING (label_policy, model, market_scope, forecast_horizon) LEFT JOIN m10_best t USING (label_policy, model, market_scope, forecast_horizon, test_year)"""
RULES = ", ".join(f"('{k}', {v['up']}, {v['sideways']}, {v['down']}, {v['fallback']})" for k, v in RULE_PROFILES.items())
CTES["k21_trade"] = f"""SELECT *, exposure * nr - turnover * 0.0005::DOUBLE AS sr FROM (SELECT *, abs(exposure - coalesce(lag(exposure) OVER (PARTITION BY candidate_type, {K}, rule_name, floor ORDER BY asof_date), 0)) AS turnover FROM (
  SELECT p.*, x.rule_name, f.floor, n.nr, (confidence < f.floor)::INT AS low, (CASE WHEN confidence < f.floor THEN x.fb WHEN direction = 'up' THEN x.u WHEN direction = 'down' THEN x.d ELSE x.s END)::DOUBLE AS exposure
  FROM k21_pred p JOIN (SELECT market_scope, date AS asof_date, (lead(close) OVER ({PS}) / close - 1) / 50 AS nr FROM scope_prices) n USING (market_scope, asof_date), (VALUES {RULES}) x(rule_name, u, s, d, fb), (SELECT unnest({CONFIDENCE_FLOORS})::DOUBLE AS floor) f
  WHERE n.nr IS NOT NULL))"""
CTES["k21_card"] = f"""SELECT *, ann / nullif(vol, 0) AS sharpe FROM (SELECT *, pow(1 + cum, 252.0::DOUBLE / days) - 1 AS ann FROM (SELECT candidate_type, {K}, rule_name, floor AS confidence_floor, count(*) AS days, product(1 + sr) - 1 AS cum, product(1 + nr) - 1 AS hold,
  stddev_pop(sr) * sqrt(252) AS vol, avg(exposure) AS avg_exposure, avg(turnover) AS avg_turnover, avg(low) AS low_confidence_ratio FROM k21_trade GROUP BY ALL))"""


def next_returns(t):
    return t.scope_prices.select(F.col("date").alias("asof_date"), "market_scope", (W.forward_return(SCOPE, "close", 1) / 50).alias("next_return"))


@query("m10_tuned_thresholds", f"SELECT {K}, test_year, down_threshold, up_threshold, n AS train_rows, {r('balanced_accuracy')} AS train_balanced_accuracy FROM m10_best")
def m10(t):
    return B.tune_thresholds(t.predictions, THRESHOLD_GRID).withColumn("train_balanced_accuracy", rd("train_balanced_accuracy"))


def card(t):
    th = B.tune_thresholds(t.predictions, THRESHOLD_GRID)
    return th, B.evaluate_thresholds(t.predictions, th)


@query("m10_scorecard", f"SELECT {K}, years, {r('tuned_balanced_accuracy_avg')} AS tuned_balanced_accuracy_avg, {r('argmax_balanced_accuracy_avg')} AS argmax_balanced_accuracy_avg, {r('lift')} AS lift FROM m10_card")
def m10_card(t):
    out = card(t)[1]
    return out.select(*B.KEYS, "years", rd("tuned_balanced_accuracy_avg").alias("tuned_balanced_accuracy_avg"), rd("argmax_balanced_accuracy_avg").alias("argmax_balanced_accuracy_avg"),
                      rd("balanced_accuracy_lift_vs_argmax").alias("lift"))


@query("k21_candidates", f"SELECT candidate_type, decision_method, {K}, {r('sel')} AS selection_balanced_accuracy FROM k21_cand")
def k21_candidates(t):
    return B.select_candidates(card(t)[1]).select("candidate_type", "decision_method", *B.KEYS, rd("selection_balanced_accuracy").alias("selection_balanced_accuracy"))


def k21_frames(t):
    th, candidates = B.tuned_candidates(t.predictions, THRESHOLD_GRID)
    rows = B.candidate_predictions(t.predictions, candidates, th)
    return B.run_backtest(B.apply_rules(rows, RULE_PROFILES, CONFIDENCE_FLOORS), next_returns(t))


@query("k21_rule_scorecard", f"SELECT candidate_type, {K}, rule_name, confidence_floor, days, {r('sharpe', 4)} AS sharpe, {r('avg_exposure', 5)} AS avg_exposure, {r('avg_turnover', 5)} AS avg_turnover, {r('low_confidence_ratio', 5)} AS low_confidence_ratio FROM k21_card")
def k21(t):
    out = k21_frames(t)[1]
    return out.select(*B.TRADE_KEYS, "days", rd("sharpe", 4).alias("sharpe"), *[rd(c, 5).alias(c) for c in ("avg_exposure", "avg_turnover", "low_confidence_ratio")])


TRADE = f"candidate_type, {K}, rule_name, confidence_floor"
CTES["k21_best"] = f"""SELECT * FROM (SELECT *, max(sharpe) OVER (PARTITION BY market_scope, forecast_horizon) AS top FROM k21_card WHERE sharpe IS NOT NULL) WHERE sharpe >= top - {NEAR_BEST_TOLERANCE}
QUALIFY row_number() OVER (PARTITION BY market_scope, forecast_horizon ORDER BY low_confidence_ratio, round(sharpe, 8) DESC, round(cum, 8) DESC, {TRADE}) = 1"""
EXPOSURE = "CASE rule_name " + " ".join(f"WHEN '{k}' THEN CASE WHEN low THEN {v['fallback']} WHEN direction = 'up' THEN {v['up']} WHEN direction = 'down' THEN {v['down']} ELSE {v['sideways']} END" for k, v in RULE_PROFILES.items()) + " END"
CTES["k22_rows"] = f"""SELECT *, confidence < confidence_floor AS low FROM (SELECT b.*, c.decision_method, p.asof_date, t.down_threshold, greatest(prob_down, prob_sideways, prob_up) AS confidence,
    CASE WHEN c.decision_method = 'threshold' AND t.down_threshold IS NOT NULL THEN {THRESH.format('t.down_threshold', 't.up_threshold')} ELSE {ARGMAX} END AS direction
  FROM k21_best b JOIN k21_cand c USING (candidate_type, {K}) JOIN (SELECT * FROM predictions QUALIFY row_number() OVER (PARTITION BY {K} ORDER BY asof_date DESC) = 1) p USING ({K})
  LEFT JOIN (SELECT {K}, max_by(down_threshold, test_year) AS down_threshold, max_by(up_threshold, test_year) AS up_threshold FROM (SELECT m.* FROM m10_best m JOIN (SELECT {K}, max(asof_date) AS newest FROM predictions GROUP BY ALL) n USING ({K}) WHERE m.test_year <= year(n.newest)) GROUP BY {K}) t USING ({K}))"""


@query("k21_best_rules", f"SELECT {TRADE}, {r('sharpe', 4)} AS sharpe, {r('low_confidence_ratio', 5)} AS low_confidence_ratio FROM k21_best")
def k21_best(t):
    return B.best_rules(k21_frames(t)[1], NEAR_BEST_TOLERANCE).select(*B.TRADE_KEYS, rd("sharpe", 4).alias("sharpe"), rd("low_confidence_ratio", 5).alias("low_confidence_ratio"))


@query("k22_signal_handoff", f"""
SELECT asof_date, market_scope, forecast_horizon, model AS model_name, decision_method, direction AS predicted_direction, {r('confidence')} AS confidence, rule_name, ({EXPOSURE})::DOUBLE AS recommended_exposure,
  concat_ws(';', CASE WHEN decision_method = 'threshold' AND down_threshold IS NULL THEN 'missing_threshold_used_argmax' END, CASE WHEN low THEN 'low_confidence_fallback' END) AS quality_warnings FROM k22_rows""")
def k22(t):
    from tidemark.plans.handoff import signal_rows

    th, candidates = B.tuned_candidates(t.predictions, THRESHOLD_GRID)
    rows = B.candidate_predictions(t.predictions, candidates, th)
    best = B.best_rules(B.run_backtest(B.apply_rules(rows, RULE_PROFILES, CONFIDENCE_FLOORS), next_returns(t))[1], NEAR_BEST_TOLERANCE)
    best = best.join(candidates.select("candidate_type", *B.KEYS, "decision_method"), ["candidate_type", *B.KEYS])
    return signal_rows(best, t.predictions, th, RULE_PROFILES).select(
        "asof_date", "market_scope", "forecast_horizon", "model_name", "decision_method", "predicted_direction", rd("confidence").alias("confidence"), "rule_name", "recommended_exposure", "quality_warnings")


# -- label policies and feature enhancement ---------------------------------------------------------

FWD = f"(SELECT market_scope, date, value, lead(close, 5) OVER ({PS}) / close - 1 AS fwd FROM scope_prices)"


def forward(t):
    return t.scope_prices.select("market_scope", "date", "value", W.forward_return(SCOPE, "close", 5).alias("fwd"))


@query("m11_label_policies", f"""
SELECT f.market_scope, f.date, CASE WHEN fwd <= q40 THEN 'down' WHEN fwd <= q60 THEN 'sideways' WHEN fwd > q60 THEN 'up' END AS q40_q60, CASE WHEN fwd <= q35 THEN 'down' WHEN fwd <= q65 THEN 'sideways' WHEN fwd > q65 THEN 'up' END AS wide
FROM {FWD} f JOIN (SELECT market_scope, quantile_cont(fwd, 0.4) AS q40, quantile_cont(fwd, 0.6) AS q60, quantile_cont(fwd, 0.35) AS q35, quantile_cont(fwd, 0.65) AS q65 FROM {FWD} GROUP BY 1) q USING (market_scope)""")
def m11(t):
    from tidemark.plans.research import label_policy

    a = label_policy(forward(t), ["market_scope"], "date", "fwd", "q40_q60", 0.4, 0.6)
    return label_policy(a, ["market_scope"], "date", "fwd", "wide", 0.35, 0.65).select("market_scope", "date", "q40_q60", "wide")


@query("m11_volatility_scaled_labels", f"""
WITH s AS (SELECT *, fwd / nullif({sql_roll('stddev_samp', 'fwd', 252, 60, PS)}, 0) AS z FROM {FWD})
SELECT s.market_scope, s.date, CASE WHEN z <= q40 THEN 'down' WHEN z <= q60 THEN 'sideways' WHEN z > q60 THEN 'up' END AS label FROM s
JOIN (SELECT market_scope, quantile_cont(z, 0.4) AS q40, quantile_cont(z, 0.6) AS q60 FROM s GROUP BY 1) q USING (market_scope)""")
def m11_scaled(t):
    from tidemark.plans.research import label_policy

    return label_policy(forward(t), ["market_scope"], "date", "fwd", "label", 0.4, 0.6, scale_window=252).select("market_scope", "date", "label")


@query("m12_flow_features", f"""
SELECT market_scope, date, {r('z20')} AS value_z20d, {r('z60')} AS value_z60d, {r('z20 - z60')} AS value_z_spread,
  {r('CASE WHEN len(xs) >= 20 THEN (len(list_filter(xs, lambda v: v < value)) + (len(list_filter(xs, lambda v: v = value)) + 1) / 2.0::DOUBLE) / len(xs) END')} AS value_pctile_60d FROM (
  SELECT *, (value - {sql_roll('avg', 'value', 20, 10, PS)}) / nullif({sql_roll('stddev_samp', 'value', 20, 10, PS)}, 0) AS z20, (value - {sql_roll('avg', 'value', 60, 30, PS)}) / nullif({sql_roll('stddev_samp', 'value', 60, 30, PS)}, 0) AS z60,
    list(value) OVER ({PS} ROWS BETWEEN 59 PRECEDING AND CURRENT ROW) AS xs FROM scope_prices)""")
def m12(t):
    from tidemark.plans.research import flow_features

    out = flow_features(t.scope_prices, SCOPE, ["value"])
    return out.select("market_scope", "date", *[rd(c).alias(c) for c in ("value_z20d", "value_z60d", "value_z_spread", "value_pctile_60d")])


@query("k20_axis_dataset", f"""
SELECT d.date AS asof_date, g.s AS market_scope, {r('f.fwd')} AS forward_return_5d, p.label FROM (SELECT DISTINCT date FROM scope_prices) d CROSS JOIN (VALUES ('ALL'), ('KOSPI'), ('KOSDAQ'), ('KOSPI200')) g(s)
LEFT JOIN (SELECT market_scope, date, fwd FROM {FWD} UNION ALL SELECT 'ALL', date, avg(fwd) FROM {FWD} WHERE market_scope <> 'KOSPI200' GROUP BY 2) f ON f.date = d.date AND f.market_scope = g.s
LEFT JOIN (SELECT x.market_scope, x.date, CASE WHEN fwd <= q[1] THEN 'down' WHEN fwd <= q[2] THEN 'down' WHEN fwd <= q[3] THEN 'sideways' WHEN fwd IS NOT NULL THEN 'up' END AS label FROM {FWD} x
  JOIN (SELECT market_scope, quantile_cont(fwd, [0.2, 0.4, 0.6, 0.8]) AS q FROM {FWD} GROUP BY 1) USING (market_scope)) p ON p.date = d.date AND p.market_scope = g.s AND g.s <> 'ALL'""")
def k20(t):
    from tidemark.plans.research import axis_dataset

    out = axis_dataset(t.scope_prices, {5: "forward_return_5d"})
    return out.select("asof_date", "market_scope", rd("forward_return_5d").alias("forward_return_5d"),
                      F.when(F.col("market_scope") != "ALL", F.col("direction_label_3class_5d")).alias("label"))
