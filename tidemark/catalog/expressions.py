"""Projections, labels and scalar functions (P1-P41, §2.9 families)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.catalog.registry import query, r, sql_clip, sql_mean
from tidemark.functions import dates as D
from tidemark.functions import labels as L
from tidemark.functions import numeric as N
from tidemark.functions import text as X
from tidemark.plans.specs import DIRECTION_EXPOSURE

Z = "::DOUBLE"


def rd(c, digits: int = 6) -> Column:
    return F.round(N.as_col(c).cast("double"), digits)


def label_report(name: str, label: Callable[[], Column], sql_label: str, extra: tuple[str, ...] = ("s1",)) -> None:
    """Register the census of a label: rows and score range per label value."""
    sql_aggs = ["count(*) AS n", *[f"{fn}({c}) AS {fn}_{c}" for c in extra for fn in ("min", "max")]]

    @query(name, f"SELECT {sql_label} AS label, {', '.join(sql_aggs)} FROM scores GROUP BY 1")
    def _(t):
        ranges = [fn(c).alias(f"{fn.__name__}_{c}") for c in extra for fn in (F.min, F.max)]
        return t.scores.withColumn("label", label()).groupBy("label").agg(F.count(F.lit(1)).alias("n"), *ranges)


@query("p1_null_safe_clip", f"""
SELECT event_id, {sql_clip('s1')} AS clipped, {sql_clip('s2', 0, 1)} AS unit FROM scores""")
def p1(t):
    return t.scores.select("event_id", N.clip("s1").alias("clipped"), N.clip("s2", 0, 1).alias("unit"))


FIVE = """CASE WHEN {0} IS NULL THEN NULL WHEN {0} >= {1} THEN 'bullish' WHEN {0} >= {2} THEN 'mild_bullish'
WHEN {0} > -{2} THEN 'neutral' WHEN {0} > -{1} THEN 'mild_bearish' ELSE 'bearish' END"""

label_report("p2_market_state_label", lambda: L.market_state("s1"), """CASE WHEN s1 IS NULL THEN NULL WHEN s1 >= 1.5 THEN 'strong_up'
WHEN s1 >= 0.4 THEN 'up' WHEN s1 <= -1.5 THEN 'strong_down' WHEN s1 <= -0.4 THEN 'down' ELSE 'neutral' END""")
label_report("p2_volatility_label", lambda: L.volatility_regime("u1"), """CASE WHEN u1 IS NULL THEN NULL WHEN u1 < 0.12 THEN 'low'
WHEN u1 < 0.22 THEN 'normal' WHEN u1 < 0.35 THEN 'high' ELSE 'stress' END""", ("u1",))
label_report("p2_forecast_label", lambda: L.forecast("s1"), FIVE.format("s1", 1.1, 0.35))
label_report("p3_state_bucket", lambda: L.state_bucket("s1"), """CASE WHEN s1 IS NULL THEN NULL WHEN s1 >= 2 THEN '강상승'
WHEN s1 >= 1 THEN '상승' WHEN s1 >= 0.3 THEN '강보합' WHEN s1 >= -0.3 THEN '중립' WHEN s1 >= -1 THEN '약보합'
WHEN s1 >= -2 THEN '하락' ELSE '강하락' END""")
label_report("p4_calibrated_label", lambda: L.calibrated("s1"), FIVE.format("s1", 0.75, 0.2))
label_report("p5_prediction_label", lambda: L.prediction("s1", "u1"), FIVE.format("(CASE WHEN u1 > 0 THEN s1 / u1 END)", 0.75, 0.2),
             ("s1", "u1"))
label_report("p6_risk_regime_label", lambda: L.risk_regime("s1", "s2", "s3"), f"""CASE WHEN {sql_mean('s1', 's2')} IS NULL THEN NULL
WHEN {sql_mean('s1', 's2')} >= 1.6 THEN 'risk_off_high' WHEN {sql_mean('s1', 's2')} >= 0.65 THEN 'risk_off_moderate'
WHEN s3 >= 1.2 AND {sql_mean('s1', 's2')} <= 0.2 THEN 'risk_on_moderate'
WHEN s3 >= 2.0 AND {sql_mean('s1', 's2')} <= -0.2 THEN 'risk_on_high' ELSE 'neutral' END""", ("s1", "s2", "s3"))
label_report("p7_monitoring_quality_label", lambda: L.monitoring_quality("s1", "u1"), """CASE WHEN s1 IS NULL OR u1 IS NULL
THEN 'insufficient_history' WHEN s1 >= 0.2 AND u1 >= 0.56 THEN 'strong' WHEN s1 >= 0.1 AND u1 >= 0.53 THEN 'usable'
WHEN s1 <= -0.05 OR u1 < 0.48 THEN 'weak' ELSE 'watch' END""", ("s1", "u1"))
label_report("p8_coverage_quality_label", lambda: L.coverage_quality("u1"), """CASE WHEN u1 >= 0.85 THEN 'high' WHEN u1 >= 0.65
THEN 'medium' WHEN u1 >= 0.35 THEN 'low' ELSE 'very_low' END""", ("u1",))
label_report("p9_regime_direction", lambda: L.regime_direction("s1"), """CASE WHEN s1 IS NULL THEN 'unknown' WHEN s1 > 0.1
THEN 'improving' WHEN s1 < -0.1 THEN 'deteriorating' ELSE 'unchanged' END""")
label_report("p9_regime_momentum", lambda: L.regime_momentum("s1", "s2"), """CASE WHEN s1 IS NULL THEN 'unknown'
WHEN s1 > 0.2 AND coalesce(s2, 0) > 0 THEN 'improving_accelerating' WHEN s1 > 0.2 THEN 'improving'
WHEN s1 < -0.2 AND coalesce(s2, 0) < 0 THEN 'deteriorating_accelerating' WHEN s1 < -0.2 THEN 'deteriorating'
ELSE 'stable' END""", ("s1", "s2"))
label_report("p10_surprise_direction", lambda: L.surprise_direction("s1"), """CASE WHEN s1 IS NULL THEN NULL WHEN s1 > 0 THEN 'upside'
WHEN s1 < 0 THEN 'downside' ELSE 'inline' END""")
label_report("p10_surprise_bias", lambda: L.surprise_bias("s1"), """CASE WHEN s1 IS NULL THEN NULL WHEN s1 >= 1 THEN 'risk_off_surprise'
WHEN s1 <= -1 THEN 'risk_on_surprise' ELSE 'mixed_or_inline' END""")
label_report("p11_axis_bucket", lambda: L.axis_bucket("s1"), """CASE WHEN s1 IS NULL THEN 'missing' WHEN s1 >= 0.3 THEN 'positive'
WHEN s1 <= -0.3 THEN 'negative' ELSE 'neutral' END""")
label_report("p11_tone", lambda: L.tone("s1"), """CASE WHEN s1 IS NULL THEN 'unknown' WHEN s1 >= 1 THEN 'good' WHEN s1 >= 0.3
THEN 'weak_good' WHEN s1 > -0.3 THEN 'neutral' WHEN s1 > -1 THEN 'weak_bad' ELSE 'bad' END""")
label_report("p11_score_band", lambda: L.score_band("s1"), """CASE WHEN s1 IS NULL THEN 0 WHEN s1 <= -2 THEN 1 WHEN s1 <= -1 THEN 2
WHEN s1 <= -0.3 THEN 3 WHEN s1 < 0.3 THEN 4 WHEN s1 < 1 THEN 5 WHEN s1 < 2 THEN 6 ELSE 7 END""")
label_report("p12_breadth_regime", lambda: L.breadth_regime("u1", F.col("u2") * 2), """CASE
WHEN u1 >= 0.6 AND coalesce(nullif(u2 * 2, 0), 1) >= 1.1 THEN '확산 강세'
WHEN u1 >= 0.5 AND coalesce(nullif(u2 * 2, 0), 1) >= 1.0 THEN '완만한 강세'
WHEN u1 <= 0.35 AND coalesce(nullif(u2 * 2, 0), 1) < 0.9 THEN '확산 약세'
WHEN u1 <= 0.45 AND coalesce(nullif(u2 * 2, 0), 1) < 1.0 THEN '완만한 약세' ELSE '혼조' END""", ("u1", "u2"))
label_report("p12_change_direction", lambda: L.change_direction("s1"), """CASE WHEN s1 IS NULL THEN 'unavailable' WHEN s1 > 0 THEN 'up'
WHEN s1 < 0 THEN 'down' ELSE 'flat' END""")
label_report("p12_quote_status", lambda: L.quote_status((F.col("event_id") % 3 == 0).cast("int"), "s1"), """CASE
WHEN event_id % 3 = 0 THEN 'fallback' WHEN s1 IS NULL THEN 'missing' ELSE 'live' END""")
label_report("p13_intraday_direction", lambda: L.intraday_direction("s1"), """CASE WHEN s1 IS NULL THEN NULL WHEN s1 >= 1 THEN '강세'
WHEN s1 >= 0.2 THEN '소폭 강세' WHEN s1 > -0.2 THEN '혼조' WHEN s1 > -1 THEN '약세' ELSE '강한 약세' END""")
label_report("p13_flow_labels", lambda: F.concat_ws("/", L.flow_direction("s1"), L.flow_strength(F.col("s1") * 5000)), """concat_ws('/',
CASE WHEN s1 > 0 THEN '순매수 우위' WHEN s1 < 0 THEN '순매도 우위' ELSE '중립' END,
CASE WHEN abs(coalesce(s1 * 5000, 0)) >= 10000 THEN '강함' WHEN abs(coalesce(s1 * 5000, 0)) >= 3000 THEN '보통' ELSE '약함' END)""")
label_report("p30_three_class", lambda: L.three_class(F.when(F.col("s1") <= -2, "strong_down").when(F.col("s1") <= -1, "mild_down")
             .when(F.col("s1") < 1, "sideways").when(F.col("s1") < 2, "mild_up").when(F.col("s1") >= 2, "strong_up")),
             "CASE WHEN s1 <= -1 THEN 'down' WHEN s1 < 1 THEN 'sideways' WHEN s1 >= 1 THEN 'up' END")
label_report("p34_alignment", lambda: L.alignment("s1", "s2"), """CASE
WHEN (coalesce(s1, 0) < 0.3 AND coalesce(s1, 0) > -0.3) OR (coalesce(s2, 0) < 0.3 AND coalesce(s2, 0) > -0.3) THEN 'mixed'
WHEN (s1 > 0) = (s2 > 0) THEN 'aligned' ELSE 'divergent' END""", ("s1", "s2"))
label_report("p38_status_labels", lambda: F.concat_ws("/", F.coalesce(L.status_badge("s1"), F.lit("none")), L.axis_status("s1")), """concat_ws('/',
CASE WHEN s1 IS NULL THEN 'none' WHEN s1 >= 1 THEN 'good' WHEN s1 > -0.5 THEN 'neutral' ELSE 'bad' END,
CASE WHEN s1 IS NULL THEN 'unknown' WHEN s1 >= 0.3 THEN 'positive' WHEN s1 <= -0.3 THEN 'negative' ELSE 'neutral' END)""")
label_report("p38_public_intraday_label", lambda: L.public_intraday_label(
    F.when(F.col("event_type") == "click", "강세").when(F.col("event_type") == "view", "").when(F.col("event_type") == "error", "other"),
    F.when(F.col("user_id") % 2 == 0, "fallback_prev_close").otherwise("live")), """CASE WHEN event_type = 'click' THEN '강세'
WHEN user_id % 2 = 0 THEN '혼조' WHEN event_type = 'error' THEN 'other' ELSE '혼조' END""")
label_report("p39_consideration_codes", lambda: F.array_join(L.considerations("s1", "s2", "s3"), ","), """concat_ws(',',
CASE WHEN s1 < -0.3 THEN 'environment_warning' WHEN s1 > 0.3 THEN 'environment_positive' ELSE 'environment_neutral' END,
CASE WHEN s2 >= 1 THEN 'medium_positive' WHEN s2 <= -1 THEN 'medium_warning' ELSE 'medium_neutral' END,
CASE WHEN s3 <= -0.3 THEN 'short_warning' WHEN s3 >= 0.3 THEN 'short_positive' ELSE 'short_neutral' END)""", ("s1", "s2", "s3"))
label_report("p19_signal_agreement", lambda: L.signal_agreement("s1", "s2"), """CASE WHEN s1 IS NULL AND s2 IS NULL THEN 'unavailable'
WHEN s1 IS NULL OR s2 IS NULL THEN 'single_source' WHEN sign(s1) = sign(s2) THEN 'aligned' ELSE 'mixed' END""", ("s1", "s2"))
label_report("k27_preview_label", lambda: L.preview("s1"), """CASE WHEN s1 IS NULL THEN NULL WHEN s1 >= 1.2 THEN '장초반 우호 가능성'
WHEN s1 >= 0.4 THEN '장초반 우호 흐름' WHEN s1 <= -1.2 THEN '장초반 부담 가능성' WHEN s1 <= -0.4 THEN '장초반 경계 흐름'
ELSE '혼조 출발 가능성' END""")


@query("p12_source_tier", """
SELECT tier, catalogue_tier, count(*) AS n FROM (
  SELECT CASE WHEN event_id % 11 = 0 THEN 'fallback' WHEN event_type = 'click' THEN 'official'
              WHEN event_type = 'view' THEN 'official_delayed' WHEN event_type = 'error' THEN 'fallback' ELSE 'proxy' END AS tier,
         CASE WHEN event_type = 'click' THEN 'official' WHEN event_type = 'error' THEN 'fallback' ELSE 'proxy' END AS catalogue_tier
  FROM events) GROUP BY 1, 2""")
def p12_tier(t):
    src = L.lookup({"click": "FDR:KS11", "view": "carry_forward:x", "purchase": "yahoo:SPY", "signup": "other"}, "event_type")
    flag = (F.col("event_id") % 11 == 0).cast("int")
    rows = t.table("events").select(L.source_tier(src, flag).alias("tier"), L.catalogue_source_tier(src).alias("catalogue_tier"))
    return rows.groupBy("tier", "catalogue_tier").agg(F.count(F.lit(1)).alias("n"))


@query("p14_row_mean", f"SELECT event_id, {r(sql_mean('s1', 's2', 's3'))} AS mean_score FROM scores")
def p14(t):
    return t.scores.select("event_id", rd(N.row_mean("s1", "s2", "s3")).alias("mean_score"))


@query("p15_weighted_mean", f"""
SELECT event_id,
  {r("(coalesce(s1 * 0.5, 0) + coalesce(s2 * -0.3, 0) + coalesce(s3 * 0.2, 0))::DOUBLE / nullif((s1 IS NOT NULL)::INT * 0.5::DOUBLE + (s2 IS NOT NULL)::INT * 0.3::DOUBLE + (s3 IS NOT NULL)::INT * 0.2::DOUBLE, 0)")} AS by_abs,
  {r("coalesce((coalesce(s1 * 0.5, 0) + coalesce(s2 * 0.5, 0))::DOUBLE / nullif((s1 IS NOT NULL)::INT * 0.5::DOUBLE + (s2 IS NOT NULL)::INT * 0.5::DOUBLE, 0), 0)")} AS signed_or_zero
FROM scores""")
def p15(t):
    return t.scores.select("event_id", rd(N.weighted_mean([("s1", 0.5), ("s2", -0.3), ("s3", 0.2)])).alias("by_abs"),
                           rd(N.weighted_mean([("s1", 0.5), ("s2", 0.5)], signed=True, empty=0.0)).alias("signed_or_zero"))


@query("p16_scaled_return_score", f"SELECT event_id, {r(sql_clip(sql_mean('s1 / 100', 's2 / 100') + ' * 90'), 4)} AS score FROM scores")
def p16(t):
    return t.scores.select("event_id", N.scaled_return_score(F.col("s1") / 100, F.col("s2") / 100, scale=90).alias("score"))


@query("p17_score_formulas", f"""
SELECT event_id, {r(sql_clip('s1 / 20 * 18.0::DOUBLE + s2 / 20 * 8.0::DOUBLE'), 4)} AS trend,
       {r(sql_clip('(' + sql_mean('s1', 's2', 's3', 'u1') + ' - 0.5) * 6.0::DOUBLE'), 4)} AS breadth,
       CASE WHEN s3 IS NOT NULL THEN {r('greatest(0::DOUBLE, least(3::DOUBLE, (greatest(0::DOUBLE, (u1 - 0.12::DOUBLE) / 0.18::DOUBLE) + abs(least(s3 / 10, 0::DOUBLE)) / 0.15::DOUBLE) * 1.5::DOUBLE))', 4)} END AS stress
FROM scores""")
def p17(t):
    return t.scores.select("event_id", N.trend_score(F.col("s1") / 20, F.col("s2") / 20).alias("trend"),
                           N.breadth_score("s1", "s2", "s3", "u1").alias("breadth"),
                           N.stress_score("u1", F.col("s3") / 10).alias("stress"))


@query("p18_state_components", f"""
WITH f AS (SELECT event_id, u1, u2, coalesce(s1, 0) / 50 AS a, coalesce(s2, 0) / 50 AS b, coalesce(s3, 0) / 50 AS c FROM scores),
g AS (SELECT event_id,
  {sql_clip('8.0::DOUBLE * a + 5.0::DOUBLE * b + 6.0::DOUBLE * c + 4.0::DOUBLE * a + 5.0::DOUBLE * b + 3.0::DOUBLE * c + 0.6::DOUBLE * (coalesce(nullif(u1, 0), 0.5::DOUBLE) - 0.5::DOUBLE)')} AS trend,
  {sql_clip('3.2::DOUBLE * (u1 - 0.5::DOUBLE) + 2.8::DOUBLE * (u2 - 0.5::DOUBLE) + 0.9::DOUBLE * ln(greatest(u1 + u2, 0.000001::DOUBLE)) + 10.0::DOUBLE * (u1 - u2) / 100')} AS breadth,
  {sql_clip('-55.0::DOUBLE * u2 / 10 + 18.0::DOUBLE * a + 10.0::DOUBLE * b')} AS risk,
  {sql_clip('-15.0::DOUBLE * a - 4.5::DOUBLE * b - 6.0::DOUBLE * c - 5.0::DOUBLE * a - 1.5::DOUBLE * b - 1.2::DOUBLE * c')} AS defensive
  FROM f)
SELECT event_id, {r('trend', 8)} AS trend_score, {r('breadth', 8)} AS breadth_score, {r('risk', 8)} AS risk_score,
  {r('defensive', 8)} AS defensive_flow_score,
  {r(sql_clip('0.35::DOUBLE * trend + 0.30::DOUBLE * breadth + 0.20::DOUBLE * risk + 0.15::DOUBLE * defensive'), 8)} AS total_score FROM g""")
def p18(t):
    z = F.lit(0.0)
    a, b, c = (F.coalesce(F.col(x), z) / 50 for x in ("s1", "s2", "s3"))
    f = {"regime": F.col("u1"), "main_ret_20d": a, "main_ret_60d": b, "growth_ret_20d": c, "growth_ret_60d": a,
         "large_ret_20d": b, "main_ret_5d": c, "above_ma20": F.col("u1"), "above_ma60": F.col("u2"),
         "adv_dec_ratio": F.col("u1") + F.col("u2"), "highs": F.col("u1"), "lows": F.col("u2"), "universe": F.lit(100),
         "vol_20d": F.col("u2") / 10, "dd_5d": a, "dd_20d": b, "fx_ret_20d": a, "inverse_ret_20d": b, "bond_ret_20d": c,
         "gold_ret_20d": a, "short_rate_chg": b, "bond_rate_chg": c}
    return t.scores.select("event_id", *[F.round(v, 8).alias(k) for k, v in N.state_components(f).items()])


@query("p19_overnight_biases", f"""
SELECT event_id, {r('fut', 8)} AS futures_bias, {r('world', 8)} AS global_risk_bias, {r('fx', 8)} AS fx_bias,
       {r(sql_clip('0.45::DOUBLE * fut + 0.35::DOUBLE * world + 0.20::DOUBLE * fx'), 8)} AS next_day_score
FROM (SELECT event_id,
  {sql_clip("coalesce((coalesce(10 * a * 0.4::DOUBLE, 0) + coalesce(10 * b * 0.2::DOUBLE, 0) + coalesce(10 * c * 0.2::DOUBLE, 0) + 10 * d * 0.2::DOUBLE) / ((a IS NOT NULL)::INT * 0.4::DOUBLE + (b IS NOT NULL)::INT * 0.2::DOUBLE + (c IS NOT NULL)::INT * 0.2::DOUBLE + 0.2::DOUBLE), 0::DOUBLE)")} AS fut,
  {sql_clip("(coalesce(8 * c * 0.45::DOUBLE, 0) + 8 * d * 0.45::DOUBLE + -3 * coalesce(a, 0) * 0.10::DOUBLE) / ((c IS NOT NULL)::INT * 0.45::DOUBLE + 0.45::DOUBLE + 0.10::DOUBLE) - (greatest(5 * coalesce(a, 0), 0::DOUBLE) + greatest(4 * coalesce(b, 0), 0::DOUBLE) + least(0.25::DOUBLE * (event_id % 7), 1::DOUBLE))")} AS world,
  {sql_clip('-12 * coalesce(b, 0)')} AS fx
  FROM (SELECT event_id, s1 / 30 AS a, s2 / 30 AS b, s3 / 30 AS c, u1 / 30 AS d FROM scores))""")
def p19(t):
    a, b, c, d = (F.col(x) / 30 for x in ("s1", "s2", "s3", "u1"))
    f = {"night": a, "proxy": b, "sp500": c, "nasdaq": d, "oil": a, "us10y": b, "risk_headlines": F.col("event_id") % 7, "fx": b}
    return t.scores.select("event_id", *[F.round(v, 8).alias(k) for k, v in N.overnight_biases(f).items()])


@query("p20_any_feature_present", """
SELECT (s1 IS NOT NULL OR s2 IS NOT NULL)::INT AS present, count(*) AS n FROM scores GROUP BY 1""")
def p20(t):
    return t.scores.groupBy(N.any_present("s1", "s2").cast("int").alias("present")).agg(F.count(F.lit(1)).alias("n"))


@query("p24_argmax_label", """
SELECT asof_date, model, market_scope, forecast_horizon,
  CASE WHEN prob_down >= prob_sideways AND prob_down >= prob_up THEN 'down' WHEN prob_sideways >= prob_up THEN 'sideways' ELSE 'up' END AS direction
FROM predictions""")
def p24(t):
    return t.predictions.select("asof_date", "model", "market_scope", "forecast_horizon", L.argmax_label(
        {"down": "prob_down", "sideways": "prob_sideways", "up": "prob_up"}).alias("direction"))


@query("p25_threshold_label", """
SELECT asof_date, model, market_scope, forecast_horizon,
  CASE WHEN prob_down >= 0.40 AND prob_down >= prob_up THEN 'down' WHEN prob_up >= 0.44 AND prob_up > prob_down THEN 'up' ELSE 'sideways' END AS direction
FROM predictions""")
def p25(t):
    return t.predictions.select("asof_date", "model", "market_scope", "forecast_horizon",
                                L.threshold_label("prob_down", "prob_up", F.lit(0.40), F.lit(0.44)).alias("direction"))


@query("p26_exposure_rule", """
SELECT asof_date, model, market_scope, forecast_horizon,
  (CASE WHEN greatest(prob_down, prob_sideways, prob_up) < 0.45 THEN 0.5
        WHEN prob_down >= prob_sideways AND prob_down >= prob_up THEN 0.0 WHEN prob_sideways >= prob_up THEN 0.5 ELSE 1.0 END)::DOUBLE AS exposure
FROM predictions""")
def p26(t):
    d = L.argmax_label({"down": "prob_down", "sideways": "prob_sideways", "up": "prob_up"})
    conf = F.greatest("prob_down", "prob_sideways", "prob_up")
    return t.predictions.select("asof_date", "model", "market_scope", "forecast_horizon",
                                L.exposure(d, conf, DIRECTION_EXPOSURE, 0.45, 0.5).alias("exposure"))


SAMPLE_RULES = [("risk", "risk", 1, "high", ["secret", "password", "error"]), ("funding", "funding", 0, "medium", ["license", "copyright"]),
                ("general_note", "note", 0, "normal", ["the", "der"])]


@query("p27_keyword_classification", """
SELECT category_key, risk_flag, severity_label, count(*) AS n, sum(n_chars)::BIGINT AS chars FROM (
  SELECT n_chars, CASE WHEN text LIKE '%exempt%' THEN 'general' WHEN text LIKE '%secret%' OR text LIKE '%password%' OR text LIKE '%error%' THEN 'risk'
    WHEN text LIKE '%license%' OR text LIKE '%copyright%' THEN 'funding' WHEN text LIKE '%the%' OR text LIKE '%der%' THEN 'general_note' ELSE 'general' END AS category_key,
   CASE WHEN category_key = 'risk' THEN 1 ELSE 0 END AS risk_flag,
   CASE category_key WHEN 'risk' THEN 'high' WHEN 'funding' THEN 'medium' ELSE 'normal' END AS severity_label
  FROM documents) GROUP BY 1, 2, 3""")
def p27(t):
    kind = L.classify_text("text", SAMPLE_RULES, ["exempt"])
    rows = t.table("documents").withColumn("k", kind).select("k.*", "n_chars")
    return rows.groupBy("category_key", "risk_flag", "severity_label").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"))


@query("p28_risk_headline", """
SELECT lang, count(*) AS n, sum(CASE WHEN lower(text) LIKE '%war%' OR lower(text) LIKE '%risk%' THEN 1 ELSE 0 END)::BIGINT AS risky
FROM documents GROUP BY 1""")
def p28(t):
    return t.table("documents").groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(L.mentions_any("text", ["War", "Risk"])).alias("risky"))


@query("p29_preview_window", """
SELECT ts::DATE AS day, in_window, session, count(*) AS n FROM (
  SELECT ts, (ts::TIME >= TIME '18:00:00' OR ts::TIME <= TIME '08:30:00')::INT AS in_window,
    CASE WHEN ts::TIME <= TIME '08:30:00' AND isodow(ts) < 6 THEN ts::DATE
         ELSE (ts::DATE + CASE isodow(ts) WHEN 5 THEN 3 WHEN 6 THEN 2 ELSE 1 END::INT)::DATE END AS session FROM events) GROUP BY 1, 2, 3""")
def p29(t):
    rows = t.table("events").select(F.col("ts").cast("date").alias("day"), D.in_preview_window("ts").cast("int").alias("in_window"),
                                    D.reference_session("ts").alias("session"))
    return rows.groupBy("day", "in_window", "session").agg(F.count(F.lit(1)).alias("n"))


@query("p31_display_scaling", f"""
SELECT event_id, {r('(' + sql_clip('s1') + ' + 3) / 6.0::DOUBLE * 100', 1)} AS gauge, {r('s2 * 100', 2)} AS pct, {r('s3 * 100', 1)} AS bp FROM scores""")
def p31(t):
    return t.scores.select("event_id", N.display_scalings("s1")["gauge"].alias("gauge"),
                           N.display_scalings("s2")["pct"].alias("pct"), N.display_scalings("s3")["bp"].alias("bp"))


ENV = sql_clip(f"({sql_mean('s1', 's2')}) - ({sql_mean('s2', 's3')}) * 0.7::DOUBLE")


@query("p32_axis_scores", f"""
SELECT event_id, {r(f"CASE WHEN event_id % 29 = 0 AND u1 IS NOT NULL THEN u1 ELSE {ENV} END")} AS environment,
  {r("coalesce(CASE WHEN event_id % 29 = 0 THEN s1 END, s2, s3)")} AS medium,
  {r(sql_clip(sql_mean('s1', 's3', sql_clip('s2 * 2'))))} AS short_term FROM scores""")
def p32(t):
    recovered = F.when(F.col("event_id") % 29 == 0, F.col("u1"))
    opportunity, pressure = N.row_mean("s1", "s2"), N.row_mean("s2", "s3")
    env = F.coalesce(recovered, N.clip(opportunity - pressure * 0.7))
    medium = F.coalesce(F.when(F.col("event_id") % 29 == 0, F.col("s1")), "s2", "s3")
    short = N.clip(N.row_mean("s1", "s3", N.clip(F.col("s2") * 2)))
    return t.scores.select("event_id", rd(env).alias("environment"), rd(medium).alias("medium"), rd(short).alias("short_term"))


@query("p33_short_term_blend", f"""
SELECT event_id, {r(sql_clip('''CASE WHEN s1 IS NULL THEN u1 * 0.55::DOUBLE + u2 * 0.45::DOUBLE WHEN event_type = 'click' THEN u2 * 0.20::DOUBLE + s1 * 0.80::DOUBLE
ELSE u2 * 0.45::DOUBLE + s1 * 0.55::DOUBLE END'''), 4)} AS short_term FROM scores""")
def p33(t):
    from tidemark.plans.panels import short_term_blend

    return t.scores.select("event_id", short_term_blend("u1", "u2", "s1", F.col("event_type") == "click").alias("short_term"))


@query("p35_material_change", """
SELECT user_id, event_id, CASE WHEN lag(event_id) OVER w IS NULL THEN 1
  WHEN event_type IS DISTINCT FROM lag(event_type) OVER w OR abs(u1 - lag(u1) OVER w) >= 0.35 OR sign(u2 - 0.5) <> lag(sign(u2 - 0.5)) OVER w THEN 1 ELSE 0 END AS material
FROM scores WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def p35(t):
    from tidemark.plans.panels import material_change

    return material_change(t.scores.withColumn("bias", F.col("u2") - 0.5), ["user_id"], ["ts", "event_id"], ["event_type"], "u1", "bias").select(
        "user_id", "event_id", F.col("material_change").alias("material"))


@query("p36_change_against_close", f"""
SELECT event_id, {r('base')} AS base_close, {r('price - base')} AS change_value, {r('price / nullif(base, 0) - 1')} AS change_pct
FROM (SELECT event_id, u1 + 1 AS price, coalesce(s1, u2) AS base FROM scores)""")
def p36(t):
    return t.scores.select("event_id", *[rd(v).alias(k) for k, v in N.change_against(F.col("u1") + 1, "s1", "u2").items()])


@query("p37_percent_detection", f"""
SELECT event_type, count(*) AS n, {r('sum(CASE WHEN m > 3 THEN x / 100 ELSE x END)', 4)} AS total FROM (
  SELECT event_type, x, median(abs(x)) OVER (PARTITION BY event_type) AS m FROM (
    SELECT event_type, CASE WHEN event_type IN ('click', 'view') THEN s1 * 4 ELSE s1 / 4 END AS x FROM scores)) GROUP BY 1""")
def p37(t):
    from tidemark.operators.metrics import exact_quantiles

    x = F.when(F.col("event_type").isin("click", "view"), F.col("s1") * 4).otherwise(F.col("s1") / 4)
    rows = t.scores.select("event_type", x.alias("x"), F.abs(x).alias("size"))
    mid = exact_quantiles(rows, ["event_type"], "size", {"m": 0.5})
    return rows.join(mid, "event_type").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum(N.unpercent("x", "m", 3.0)), 4).alias("total"))


@query("p40_next_day_test_scores", f"""
SELECT ts::DATE AS session, {r(f"avg({sql_clip('0.65::DOUBLE * coalesce(s1, 0) + 0.35::DOUBLE * coalesce(s2, 0)')})", 5)} AS environment, {r(f"avg({sql_clip('coalesce(s3, 0)')})", 5)} AS short_term
FROM scores GROUP BY 1""")
def p40(t):
    from tidemark.plans.panels import next_day_test_scores

    s = next_day_test_scores("s1", "s2", "s3")
    return t.scores.groupBy(F.col("ts").cast("date").alias("session")).agg(
        F.round(F.avg(s["environment"]), 5).alias("environment"), F.round(F.avg(s["short_term"]), 5).alias("short_term"))


@query("f_text_number_parse", f"""
SELECT event_type, count(x) AS n, {r('sum(x)', 2)} AS total FROM (
  SELECT event_type, CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'click' THEN -round(value, 2) ELSE round(value, 2) END AS x FROM events) GROUP BY 1""")
def parse_numbers(t):
    v = F.format_number("value", 2)
    raw = F.when(F.col("event_type") == "error", "-").when(F.col("event_type") == "click", F.concat(F.lit("▼"), v)).otherwise(F.concat(v, F.lit("%")))
    rows = t.table("events").select("event_type", X.parse_number(raw).alias("x"))
    return rows.groupBy("event_type").agg(F.count("x").alias("n"), F.round(F.sum("x"), 2).alias("total"))


@query("f_ticker_codes", "SELECT lpad(regexp_replace(s_name, '[^0-9]', '', 'g')::BIGINT::VARCHAR, 6, '0') AS ticker, s_name FROM supplier")
def ticker_codes(t):
    digits = F.regexp_replace("s_name", "^[^0-9]*0*(?=[0-9])", "")
    return t.table("supplier").select(X.ticker_code(digits).alias("ticker"), "s_name")


@query("f_calendar", """
SELECT asof_date, (asof_date + CASE isodow(asof_date) WHEN 5 THEN 3 WHEN 6 THEN 2 ELSE 1 END::INT)::DATE AS next_day,
  (asof_date - CASE isodow(asof_date) WHEN 6 THEN 15 WHEN 7 THEN 16 ELSE 14 END::INT)::DATE AS ten_back,
  date_trunc('month', asof_date)::DATE AS month_start, strftime(asof_date, '%Y%m%d') AS compact FROM spine""")
def calendar(t):
    d = F.col("asof_date")
    return t.spine.select("asof_date", D.next_business_day(d).alias("next_day"), D.shift_back_business_days(d, 10).alias("ten_back"),
                          F.trunc(d, "month").alias("month_start"), F.date_format(d, "yyyyMMdd").alias("compact"))


@query("f_epoch_and_elapsed", f"""
SELECT event_id, ts::DATE AS day, {r("date_diff('second', ts::DATE::TIMESTAMP, date_trunc('second', ts)) / 3600.0::DOUBLE", 4)} AS hours FROM events""")
def epochs(t):
    e = t.table("events")
    seconds = F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.date_trunc("second", "ts").cast("timestamp_ntz"))
    return e.select("event_id", D.epoch_day(seconds).alias("day"),
                    F.round(D.elapsed_hours(F.date_trunc("second", "ts"), F.date_trunc("day", "ts")), 4).alias("hours"))


@query("f_json_values", """
SELECT k, count(*) AS n FROM (SELECT CAST(json_extract(props, '$.k') AS INT) AS k FROM events) GROUP BY 1""")
def json_values(t):
    return t.table("events").groupBy(X.first_json_value("props", ["$.missing", "$.k"]).cast("int").alias("k")).agg(F.count(F.lit(1)).alias("n"))


@query("f_row_digest", """
SELECT count(DISTINCT sha256(event_type || user_id)) AS digests, count(*) AS n FROM events""")
def digests(t):
    return t.table("events").agg(F.count_distinct(X.row_digest("event_type", "user_id")).alias("digests"), F.count(F.lit(1)).alias("n"))


@query("f_distinct_text", """
SELECT o_orderdate::DATE AS day, substr(string_agg(DISTINCT o_orderpriority, ';' ORDER BY o_orderpriority), 1, 200) AS sources FROM orders GROUP BY 1""")
def distinct_text(t):
    return t.table("orders").groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(X.sorted_distinct_text("o_orderpriority").alias("sources"))
