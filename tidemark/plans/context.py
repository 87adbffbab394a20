"""Context marts of the daily update: market, risk, theme, flow, forecast (K1-K4, K7, K8).

All windows run on long series keyed by scope, asset or theme; wide date-keyed
frames appear only after the windows, as fixed-member pivots.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import labels as L
from tidemark.functions import numeric as N
from tidemark.operators import asof as A
from tidemark.operators import relational as R
from tidemark.operators import windows as W
from tidemark.operators.windows import Axis
from tidemark.plans.specs import FORECAST_TERMS, FORECAST_WEIGHTS

FLAGS = ["ret_pos_1m", "above_sma20", "above_sma60", "above_sma120", "new_high_ratio_20d", "new_low_ratio_20d"]


def proxy_features(prices: DataFrame, key: str, date: str = "date") -> DataFrame:
    """Return, volatility, drawdown and flag columns of each series; two stacked windows, one shuffle."""
    ax = Axis.of(key, date)
    df = prices.withColumn("daily_ret", W.lag_return(ax, "close", 1)).withColumns({
        "ret_1m": W.lag_return(ax, "close", 20), "ret_3m": W.lag_return(ax, "close", 60),
        "above_sma20": W.above_mean(ax, "close", 20, 10), "above_sma60": W.above_mean(ax, "close", 60, 20),
        "above_sma120": W.above_mean(ax, "close", 120, 40), "new_high_ratio_20d": W.touches_high(ax, "close", 20, 10),
        "new_low_ratio_20d": W.touches_low(ax, "close", 20, 10), "trading_value_expansion_ratio": W.expansion(ax, "value")})
    df = df.withColumn("ret_pos_1m", F.coalesce((F.col("ret_1m") > 0).cast("double"), F.lit(0.0)))
    df = W.with_rolling_mdd(df.withColumn("vol_20d", W.annualised_vol(ax, "daily_ret")), ax, "close", 60, "mdd_3m")
    return df.drop("daily_ret")


def composite_scope(features: DataFrame, key: str, parts: Mapping[str, float], name: str = "ALL", date: str = "date") -> DataFrame:
    """Blended index of the member scopes on their common dates, with its own features.

    Flags are the plain mean of the member flags.
    """
    pick = lambda c, s: F.max(F.when(F.col(key) == s, F.col(c)))
    wide = features.where(F.col(key).isin(list(parts))).groupBy(date).agg(
        *[pick("close", s).alias(f"close_{s}") for s in parts],
        reduce(lambda a, b: a + b, [F.coalesce(pick("value", s), F.lit(0.0)) for s in parts]).alias("value"),
        *[(reduce(lambda a, b: a + b, [pick(f, s) for s in parts]) / len(parts)).alias(f"mean_{f}") for f in FLAGS])
    common = wide.where(reduce(lambda a, b: a & b, [F.col(f"close_{s}").isNotNull() for s in parts])).withColumn(key, F.lit(name))
    ax = Axis.of(key, date)
    blend = reduce(lambda a, b: a + b, [F.coalesce(W.lag_return(ax, f"close_{s}", 1), F.lit(0.0)) * w for s, w in parts.items()])
    level = common.withColumn("__r", blend).withColumn("close", W.cumulative_index(ax, "__r"))
    own = proxy_features(level.select(key, date, "close", "value", *[f"mean_{f}" for f in FLAGS]), key, date)
    return own.drop(*FLAGS).withColumnsRenamed({f"mean_{f}": f for f in FLAGS})


def risk_context(prices: DataFrame, composite: DataFrame, start, end, assets: Mapping[str, str], ticker: str = "ticker", date: str = "date") -> DataFrame:
    """K2. Stress, defensive strength and drawdown pressure per day.

    ``assets`` maps ticker to output prefix (usdkrw, gold_proxy, bond_proxy, inverse_etf).
    """
    ax = Axis.of(ticker, date)
    rets = prices.where(F.col(ticker).isin(list(assets))).select(ticker, date, W.lag_return(ax, "close", 20).alias("ret"))
    wide = rets.groupBy(date).agg(*[F.max(F.when(F.col(ticker) == t, F.col("ret"))).alias(f"{p}_ret_1m") for t, p in assets.items()])
    base = composite.where(F.col(date).between(start, end)).select(date, "vol_20d", "mdd_3m")
    df = base.join(wide, date, "left").withColumnRenamed(date, "asof_date")
    stress = N.stress_score("vol_20d", "mdd_3m")
    defensive = N.score(N.row_mean("gold_proxy_ret_1m", "bond_proxy_ret_1m", "inverse_etf_ret_1m") * 30.0)
    df = df.withColumns({"defensive_asset_strength_score": defensive, "market_stress_score": stress,
                         "drawdown_pressure_score": N.drawdown_pressure("mdd_3m"), "volatility_regime_label": L.volatility_regime("vol_20d")})
    crash = F.coalesce(F.col("market_stress_score") >= 2.2, F.lit(False)) | F.coalesce(F.col("mdd_3m") <= -0.15, F.lit(False))
    return df.withColumn("crash_warning_flag", crash.cast("int")).drop("vol_20d", "mdd_3m")


RISK_ASSETS = {"USDKRW": "usdkrw", "GOLD": "gold_proxy", "BOND": "bond_proxy", "INVERSE": "inverse_etf"}


def market_context(prices: DataFrame, start, end, parts: Mapping[str, float] | None = None,
                   assets: Mapping[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """K1, K2. (market context per day and scope, risk context per day) from a (ticker, date, close, value) panel."""
    parts, assets = parts or {"KOSPI": 0.6, "KOSDAQ": 0.4}, assets or RISK_ASSETS
    scoped = prices.where(F.col("ticker").isin(list(parts))).select(F.col("ticker").alias("market_scope"), "date", "close", "value")
    members = proxy_features(scoped, "market_scope")
    composite = composite_scope(members, "market_scope", parts)
    risk = risk_context(prices, composite, start, end, assets)
    every = members.unionByName(composite).where(F.col("date").between(start, end)).withColumnRenamed("date", "asof_date")
    scope_returns = members.groupBy(F.col("date").alias("asof_date")).agg(*[
        F.max(F.when(F.col("market_scope") == s, F.col(c))).alias(f"{s.lower()}_{c}") for s in parts for c in ("ret_1m", "ret_3m")])
    df = R.star_join(every, [(scope_returns, ["asof_date"]), (risk.select("asof_date", "defensive_asset_strength_score"), ["asof_date"])])
    df = df.withColumns({"trend_score": N.trend_score("ret_1m", "ret_3m"),
                         "breadth_score": N.breadth_score("above_sma20", "above_sma60", "above_sma120", "ret_pos_1m"),
                         "stress": N.stress_score("vol_20d", "mdd_3m"), "defensive_flow_score": F.round("defensive_asset_strength_score", 4)})
    df = df.withColumn("risk_score", -F.col("stress"))
    df = df.withColumn("market_state_score", F.round(N.row_mean("trend_score", "breadth_score", "risk_score", "defensive_flow_score"), 4))
    both = F.col("trend_score") + F.col("breadth_score")
    df = df.withColumns({"market_state_label": L.market_state("market_state_score"),
                         "risk_on_score": N.score(both / 2.0 - F.col("stress"), 0, 3), "risk_off_score": N.score(F.col("stress") - both / 4.0, 0, 3)})
    out = df.select(
        "asof_date", "market_scope", "market_state_label", "market_state_score", "trend_score", "breadth_score", "risk_score", "defensive_flow_score",
        *[f"{s.lower()}_{c}" for s in parts for c in ("ret_1m", "ret_3m")], F.col("vol_20d").alias("market_vol_20d"), F.col("mdd_3m").alias("market_mdd_3m"),
        F.col("ret_pos_1m").alias("market_breadth_ret_pos_1m"), F.col("above_sma20").alias("market_breadth_above_sma20"),
        F.col("above_sma60").alias("market_breadth_above_sma60"), F.col("above_sma120").alias("market_breadth_above_sma120"),
        "new_high_ratio_20d", "new_low_ratio_20d", "trading_value_expansion_ratio", "risk_on_score", "risk_off_score")
    return out, risk


def theme_context(prices: DataFrame, start, end, key: str = "theme_bucket", date: str = "date") -> DataFrame:
    """K3. Momentum, rotation, persistence and concentration of the themes."""
    ax = Axis.of(key, date)
    df = prices.withColumns({"theme_ret_1w": W.lag_return(ax, "close", 5), "theme_ret_1m": W.lag_return(ax, "close", 20),
                             "theme_ret_3m": W.lag_return(ax, "close", 60), "theme_above_sma60_ratio": W.above_mean(ax, "close", 60, 20),
                             "theme_trading_value_expansion_ratio": W.expansion(ax, "value")})
    df = W.with_streak(df, ax, F.col("theme_ret_1m") > 0, "theme_persistence_days")
    df = df.withColumn("theme_breadth_positive_ratio", F.coalesce((F.col("theme_ret_1m") > 0).cast("double"), F.lit(0.0)))
    df = df.where(F.col(date).between(start, end))
    raw = F.coalesce("theme_ret_1m", F.lit(0.0)) * 0.65 + F.coalesce("theme_ret_3m", F.lit(0.0)) * 0.35
    df = W.with_cross_section(df.withColumn("raw_momentum", raw), date, "raw_momentum", "value", "theme_momentum_score", "theme_concentration_score")
    df = df.withColumn("theme_rotation_score", W.lag_diff(ax, "theme_momentum_score", 20))
    df = df.withColumn("leading_theme_rank", W.cross_rank(date, "theme_momentum_score", key))
    return df.drop("close", "value", "raw_momentum").withColumnRenamed(date, "asof_date")


def crosswalk_themes(themes: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """K3, J10. Theme rows fanned out to the mapped buckets, mapped names first.

    ``crosswalk``: quant_theme_bucket, theme_bucket, theme_name, mapping_confidence, is_active.
    """
    active = crosswalk.where(F.col("is_active") == 1).withColumnRenamed("theme_name", "mapped_name")
    out = themes.join(active, "theme_bucket", "inner")
    name = F.coalesce("mapped_name", "theme_name") if "theme_name" in themes.columns else F.col("mapped_name")
    return out.withColumn("theme_name", name).drop("mapped_name", "is_active")


def flow_ratios(values: Mapping[str, Column | str]) -> dict[str, Column]:
    """K4, K9. Ratios of foreign, institution and retail flow to their absolute total."""
    cols = {k: N.as_col(v) for k, v in values.items()}
    denom = F.nullif(N.row_sum(*[F.abs(c) for c in cols.values()]), F.lit(0.0))
    out = {f"{k}_net_buy_ratio": c / denom for k, c in cols.items()}
    base = cols["foreign"] + cols["institution"]
    out["smart_money_score"] = (base - F.coalesce(cols["retail"], F.lit(0.0))) / denom
    out["flow_concentration_score"] = F.greatest(*[F.abs(c) / denom for c in cols.values()])
    out["flow_context_available"] = F.when(denom.isNotNull(), 1).otherwise(0)
    return out


def flow_context(signals: DataFrame, spine: DataFrame, scopes: Sequence[str], codes: Mapping[str, str], start, end) -> DataFrame:
    """K4. End-of-session flow ratios laid over the (day, scope) grid, ALL scope only.

    ``signals``: session_date, asof_ts, signal_code, metric_value; ``codes`` maps foreign, institution and retail to codes.
    """
    wanted = signals.where(F.col("signal_code").isin(list(codes.values())) & F.col("session_date").between(start, end))
    closing = wanted.groupBy(F.col("session_date").alias("asof_date")).agg(*[
        F.max_by(F.when(F.col("signal_code") == c, F.col("metric_value")), F.when(F.col("signal_code") == c, F.col("asof_ts"))).alias(k)
        for k, c in codes.items()])
    parts = flow_ratios({k: k for k in codes})
    numbers = [k for k in parts if k != "flow_context_available"]
    actual = closing.withColumns(parts).withColumns({"market_scope": F.lit("ALL"), "flow_coverage_flag": F.col("flow_context_available"),
                                                     "source_quality": F.lit("intraday_aggregate_recent_only")})
    base = A.grid(spine.where(F.col("asof_date").between(start, end)), "market_scope", list(scopes))
    base = base.withColumns({**{n: F.lit(None).cast("double") for n in numbers}, "flow_context_available": F.lit(0), "flow_coverage_flag": F.lit(0),
                             "source_quality": F.lit("not_available")})
    columns = [*numbers, "flow_context_available", "flow_coverage_flag", "source_quality"]
    out = R.overlay(base, actual, ["asof_date", "market_scope"], columns)
    first_day = wanted.agg(F.min("session_date")).scalar()
    return out.withColumn("flow_source_start_date", first_day)


def forecast_context(market: DataFrame, risk: DataFrame, flow: DataFrame, macro: DataFrame, assets: DataFrame) -> DataFrame:
    """K8. Baseline forecast per day, scope and horizon from the weighted context scores."""
    base = R.star_join(market, [
        (risk.select("asof_date", "market_stress_score", "drawdown_pressure_score"), ["asof_date"]),
        (macro.select("asof_date", "global_risk_on_score", "external_macro_pressure_score", "risk_aversion_score"), ["asof_date"]),
        (assets.select("asof_date", "external_asset_risk_on_score"), ["asof_date"]),
        (flow.select("asof_date", "market_scope", "smart_money_score"), ["asof_date", "market_scope"])])
    terms = dict(zip(FORECAST_TERMS, ["market_state_score", "trend_score", "breadth_score", "risk_on_score", "risk_off_score", "global_risk_on_score",
                                      "external_asset_risk_on_score", "external_macro_pressure_score", "smart_money_score"]))
    base = base.withColumns({
        "expected_volatility_score": N.score(N.row_mean("market_stress_score", "risk_aversion_score"), 0, 3),
        "drawdown_risk_score": N.score(F.col("drawdown_pressure_score"), 0, 3),
        "upside_participation_score": N.score(N.row_mean("trend_score", "breadth_score")),
        "risk_regime_label": L.risk_regime("risk_off_score", "external_macro_pressure_score", "risk_on_score"),
        "available_terms": N.count_present(*terms.values())})
    scores = F.array(*[F.struct(F.lit(h).alias("forecast_horizon"), N.score(N.weighted_mean(list(zip(terms.values(), w)))).alias("market_forecast_score"))
                       for h, w in FORECAST_WEIGHTS.items()])
    df = base.withColumn("__h", F.explode(scores)).select("*", "__h.*").drop("__h")
    conviction = F.least(F.abs(F.coalesce("market_forecast_score", F.lit(0.0))) / 2.0, F.lit(1.0))
    penalty = F.when(F.col("expected_volatility_score").isNull(), 0.35).otherwise(F.least(F.col("expected_volatility_score") / 3.0, F.lit(1.0)))
    confidence = F.round(N.clip(F.col("available_terms") / 9.0 * 0.62 + conviction * 0.25 + (1.0 - penalty) * 0.13, 0, 1), 4)
    return df.select(
        "asof_date", "market_scope", "forecast_horizon", "market_forecast_score", L.forecast("market_forecast_score").alias("market_forecast_label"),
        "risk_regime_label", "expected_volatility_score", "drawdown_risk_score", "upside_participation_score", confidence.alias("confidence_score"),
        *[F.col(c).alias(f"baseline_{c}") for c in terms.values()])
