"""Macro, asset, event and surprise marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import labels as L
from tidemark.functions import numeric as N
from tidemark.operators import asof as A
from tidemark.operators import windows as W
from tidemark.operators.windows import Axis
from tidemark.plans.specs import (
    ASSET_CODES, CYCLICAL_SECTORS, DAILY_SERIES, DAILY_SHOCKS, DEFENSIVE_SECTORS, MONTHLY_EVENTS, RELEASE_LAG_DAYS, SURPRISE_GROUPS, SURPRISE_SPECS)


def macro_features(daily: DataFrame, monthly: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Long per-series features: filled level, z and change z per day; value, yoy, 3-month change per month."""
    spine = A.date_spine(daily, "asof_date")
    ax = Axis.of("series_id", "asof_date")
    filled = A.forward_fill(spine, daily, DAILY_SERIES, "series_id", "value")
    filled = W.with_change_zscore(W.with_zscore(filled, ax, "value", "z"), ax, "value", 20, "dz")
    changes = monthly.withColumns({"yoy": W.year_over_year(ax, "value"), "chg_3m": W.lag_diff(ax, "value", 3)})
    usable = A.monthly_asof(spine, changes.withColumnRenamed("asof_date", "obs_date"), "series_id", "obs_date", ["value", "yoy", "chg_3m"], RELEASE_LAG_DAYS)
    return filled, usable


def macro_context(daily: DataFrame, monthly: DataFrame, start=None, end=None) -> DataFrame:
    """K5. Rate, dollar, credit, risk-aversion, inflation and commodity pressure per day.

    Windows run per series; the wide row is one pivot of the finished features.
    """
    filled, usable = macro_features(daily, monthly)
    pick = lambda s, c: F.max(F.when(F.col("series_id") == s, F.col(c)))
    z_of = ["DGS10", "DGS2", "DFII10", "DTWEXBGS", "DEXKOUS", "BAMLH0A0HYM2", "BAMLC0A0CM", "VIXCLS", "GVZCLS", "T10YIE", "DCOILWTICO"]
    dz_of = ["DGS10", "DTWEXBGS", "BAMLH0A0HYM2", "VIXCLS", "DCOILWTICO"]
    wide = filled.groupBy("asof_date").agg(*[pick(s, "value").alias(f"v_{s}") for s in DAILY_SERIES], *[pick(s, "z").alias(f"z_{s}") for s in z_of],
                                           *[pick(s, "dz").alias(f"dz_{s}") for s in dz_of])
    slow = usable.groupBy("asof_date").agg(pick("CPIAUCSL", "yoy").alias("cpi_yoy"), pick("CPILFESL", "yoy").alias("core_cpi_yoy"), pick("PPIACO", "yoy").alias("ppi_yoy"),
                                           pick("UNRATE", "value").alias("unrate"), pick("PAYEMS", "chg_3m").alias("payrolls_3m_change"))
    df = wide.join(slow, "asof_date", "left")
    df = df if start is None else df.where(F.col("asof_date") >= start)
    df = df if end is None else df.where(F.col("asof_date") <= end)
    raw = {
        "rate_pressure_score": N.row_mean("z_DGS10", "z_DGS2", "z_DFII10", "dz_DGS10"),
        "usd_pressure_score": N.row_mean("z_DTWEXBGS", "z_DEXKOUS", "dz_DTWEXBGS"),
        "credit_stress_score": N.row_mean("z_BAMLH0A0HYM2", "z_BAMLC0A0CM", "dz_BAMLH0A0HYM2"),
        "risk_aversion_score": N.row_mean("z_VIXCLS", "dz_VIXCLS", "z_GVZCLS"),
        "inflation_pressure_score": N.row_mean("z_T10YIE", "cpi_yoy", "core_cpi_yoy", "ppi_yoy"),
        "commodity_pressure_score": N.row_mean("z_DCOILWTICO", "dz_DCOILWTICO"),
    }
    df = df.withColumns(raw).withColumn("__p", N.row_mean(*raw))
    return df.select(
        "asof_date", *[N.clip(c).alias(c) for c in raw], N.clip(-F.col("__p")).alias("global_risk_on_score"), N.clip("__p").alias("external_macro_pressure_score"),
        (F.col("v_DGS10") - F.col("v_DGS2")).alias("yield_curve_10y_2y"), (F.col("v_DGS10") - F.col("v_DGS3MO")).alias("yield_curve_10y_3m"),
        F.col("v_DGS10").alias("us_10y_rate"), F.col("v_DGS2").alias("us_2y_rate"), F.col("v_DFII10").alias("us_real_10y_rate"), F.col("v_T10YIE").alias("breakeven_10y"),
        F.col("v_VIXCLS").alias("vix_level"), F.col("v_BAMLH0A0HYM2").alias("hy_spread"), F.col("v_BAMLC0A0CM").alias("ig_spread"), F.col("v_DTWEXBGS").alias("dxy_level"),
        F.col("v_DEXKOUS").alias("usdkrw_level"), F.col("v_DCOILWTICO").alias("wti_level"), "cpi_yoy", "core_cpi_yoy", "ppi_yoy", "unrate", "payrolls_3m_change")


# Fixed values: (score, one-month assets, three-month assets, scale) of the asset context.
ASSET_SCORES = [
    ("us_equity_momentum_score", ["SPY"], ["SPY"], 10.0), ("us_growth_risk_score", ["QQQ"], ["QQQ"], 10.0), ("us_smallcap_risk_score", ["IWM"], [], 15.0),
    ("korea_proxy_momentum_score", ["EWY"], ["EWY"], 10.0), ("safe_haven_pressure_score", ["TLT", "GLD", "UUP"], [], 12.0), ("commodity_risk_score", ["USO"], [], 12.0),
    ("dollar_risk_score", ["UUP", "DXY"], [], 18.0), ("vix_market_stress_score", ["VIX"], [], 10.0), ("semiconductor_momentum_score", ["SOXX"], ["SOXX"], 10.0),
    ("global_ex_us_momentum_score", ["ACWX", "EFA", "EEM"], [], 12.0), ("asia_risk_on_score", ["FXI", "EWJ", "EWT", "INDA", "EWY"], [], 12.0),
    ("bank_stress_relief_score", ["KRE"], [], 15.0), ("rate_sensitive_cyclical_score", ["XHB"], [], 15.0), ("transport_cyclical_score", ["IYT"], [], 15.0),
    ("crypto_risk_appetite_score", ["BTCUSD"], [], 5.0),
]
RISK_ON_PARTS = ["us_equity_momentum_score", "us_growth_risk_score", "us_smallcap_risk_score", "us_sector_risk_on_score", "global_breadth_proxy_score",
                 "korea_proxy_momentum_score", "semiconductor_momentum_score", "global_ex_us_momentum_score", "em_vs_dm_score", "asia_risk_on_score",
                 "bank_stress_relief_score", "rate_sensitive_cyclical_score", "transport_cyclical_score", "crypto_risk_appetite_score", "credit_proxy_score"]
RISK_OFF_PARTS = ["safe_haven_pressure_score", "dollar_risk_score", "vix_market_stress_score", "low_vol_defensive_pressure_score"]


def asset_features(assets: DataFrame) -> DataFrame:
    """Per asset: price, 20- and 60-row returns over padded prices, above its 60-row mean."""
    ax = Axis.of("asset_code", "asof_date")
    df = assets.withColumn("price", F.coalesce("adj_close", "close")).withColumn("padded", W.pad_nulls(ax, "price"))
    return df.select("asset_code", "asof_date", W.lag_return(ax, "padded", 20).alias("ret_1m"), W.lag_return(ax, "padded", 60).alias("ret_3m"),
                     W.above_mean(ax, "price", 60, 20).alias("above"))


def asset_context(assets: DataFrame, start=None, end=None) -> DataFrame:
    """K6. Cross-asset scores per day from one pivot of per-asset features."""
    feats = asset_features(assets)
    pick = lambda a, c: F.max(F.when(F.col("asset_code") == a, F.col(c)))
    three = sorted({a for _, _, t, _ in ASSET_SCORES for a in t})
    sectors = CYCLICAL_SECTORS + DEFENSIVE_SECTORS
    df = feats.groupBy("asof_date").agg(*[pick(a, "ret_1m").alias(f"r1_{a}") for a in ASSET_CODES], *[pick(a, "ret_3m").alias(f"r3_{a}") for a in three],
                                        *[pick(a, "above").alias(f"up_{a}") for a in sectors])
    df = df if start is None else df.where(F.col("asof_date") >= start)
    df = df if end is None else df.where(F.col("asof_date") <= end)
    r1 = lambda a: F.col(f"r1_{a}")
    df = df.withColumns({name: N.scaled_return_score(*[f"r1_{a}" for a in one], *[f"r3_{a}" for a in far], scale=s) for name, one, far, s in ASSET_SCORES})
    df = df.withColumns({"__cyc": N.row_mean(*[f"r1_{a}" for a in CYCLICAL_SECTORS]), "__def": N.row_mean(*[f"r1_{a}" for a in DEFENSIVE_SECTORS])})
    positive: list[Column] = [(r1(a) > 0).cast("double") for a in sectors]
    df = df.withColumns({
        "sector_cyclical_vs_defensive_1m": F.col("__cyc") - F.col("__def"), "sector_positive_ratio_1m": N.row_mean(*positive),
        "sector_above_sma60_ratio": N.row_mean(*[f"up_{a}" for a in sectors]), "hyg_lqd_ret_spread_1m": r1("HYG") - r1("LQD")})
    df = df.withColumns({
        "us_sector_risk_on_score": N.scaled_return_score("sector_cyclical_vs_defensive_1m", scale=20.0), "us_defensive_sector_score": N.scaled_return_score("__def", scale=15.0),
        "global_breadth_proxy_score": N.score(((F.col("sector_positive_ratio_1m") - 0.5) + (F.col("sector_above_sma60_ratio") - 0.5)) * 3.0),
        "credit_proxy_score": N.scaled_return_score("hyg_lqd_ret_spread_1m", scale=25.0), "em_vs_dm_score": N.score((r1("EEM") - r1("EFA")) * 20.0),
        "low_vol_defensive_pressure_score": N.score((r1("USMV") - r1("SPY")) * 20.0)})
    risk_on = N.score(N.row_mean(*RISK_ON_PARTS, *[-F.col(c) for c in RISK_OFF_PARTS]))
    keep = [n for n, _, _, _ in ASSET_SCORES] + ["us_sector_risk_on_score", "us_defensive_sector_score", "global_breadth_proxy_score", "credit_proxy_score", "em_vs_dm_score",
                                                 "low_vol_defensive_pressure_score"]
    return df.select("asof_date", *keep, risk_on.alias("external_asset_risk_on_score"), "sector_cyclical_vs_defensive_1m", "sector_positive_ratio_1m",
                     "sector_above_sma60_ratio", "hyg_lqd_ret_spread_1m", *[r1(a).alias(f"{a.lower()}_ret_1m") for a in ("SPY", "QQQ", "EWY", "VIX")])


def usable_next_day(context: DataFrame, start, end) -> DataFrame:
    """K7. Context rows usable on the next business day, newest source per day."""
    shifted = A.pit_shift(context.withColumnRenamed("asof_date", "source_date"), "source_date", start, end)
    return shifted


# -- events ---------------------------------------------------------------------------

SCHEDULED_FLAGS = sorted(set(MONTHLY_EVENTS.values()))
SHOCK_FLAGS = sorted(f for f, _, _ in DAILY_SHOCKS.values())


def macro_events(daily: DataFrame, monthly: DataFrame, spine: DataFrame) -> DataFrame:
    """Events on the first usable spine day: releases 21 days after, shocks one day after."""
    ax = Axis.of("series_id", "asof_date")
    releases = monthly.where(F.col("series_id").isin(list(MONTHLY_EVENTS)) & F.col("value").isNotNull()).select(
        "series_id", F.col("asof_date").alias("source_date"), L.lookup(MONTHLY_EVENTS, "series_id").alias("event_flag"), F.lit(RELEASE_LAG_DAYS).alias("lag_days"))
    watched = daily.where(F.col("series_id").isin(list(DAILY_SHOCKS)) & F.col("value").isNotNull())
    moves = watched.select("series_id", "asof_date", W.lag_return(ax, "value", 1).alias("pct"), W.lag_diff(ax, "value", 1).alias("diff"))
    mode, size = L.lookup({s: m for s, (_, m, _) in DAILY_SHOCKS.items()}, "series_id"), L.lookup({s: t for s, (_, _, t) in DAILY_SHOCKS.items()}, "series_id")
    shocks = moves.where(F.abs(F.when(mode == "pct", F.col("pct")).otherwise(F.col("diff"))) >= size).select(
        "series_id", F.col("asof_date").alias("source_date"), L.lookup({s: f for s, (f, _, _) in DAILY_SHOCKS.items()}, "series_id").alias("event_flag"), F.lit(1).alias("lag_days"))
    both = releases.unionByName(shocks).withColumn("usable", F.expr("date_add(source_date, lag_days)"))
    return A.asof_forward(both, spine, "usable", 0, "event_date")


def event_calendar(daily: DataFrame, monthly: DataFrame, spine: DataFrame) -> DataFrame:
    """K10. Event flags, neighbour windows, distances and pressure on every spine day."""
    events = macro_events(daily, monthly, spine)
    flags = SCHEDULED_FLAGS + SHOCK_FLAGS
    counts = events.groupBy(F.col("event_date").alias("asof_date")).agg(
        *[F.count_if(F.col("event_flag") == f).alias(f) for f in flags], F.count_distinct("series_id").alias("macro_event_source_count"))
    df = spine.join(counts, "asof_date", "left").na.fill(0, [*flags, "macro_event_source_count"]).withColumn("calendar", F.lit("KR"))
    total = lambda cols: sum((F.col(c) for c in cols[1:]), F.col(cols[0]))
    df = df.withColumns({"scheduled_macro_event_count": total(SCHEDULED_FLAGS), "macro_shock_event_count": total(SHOCK_FLAGS)})
    df = df.withColumn("macro_event_count", F.col("scheduled_macro_event_count") + F.col("macro_shock_event_count"))
    df = df.withColumns({"major_macro_event_flag": (F.col("macro_event_count") > 0).cast("int"), "__sched": (F.col("scheduled_macro_event_count") > 0).cast("int")})
    ax = Axis.of("calendar", "asof_date")
    df = W.with_neighbour_flags(df, ax, "__sched", "pre_macro_event_1d_flag", "post_macro_event_1d_flag")
    df = W.with_event_distance(df, ax, "__sched", "days_since_scheduled_macro_event", "days_to_next_scheduled_macro_event")
    window = F.greatest("__sched", "pre_macro_event_1d_flag", "post_macro_event_1d_flag")
    df = df.withColumns({"macro_event_risk_window_flag": window, "macro_event_density_5d": W.rolling_sum(ax, "macro_event_count", 5)})
    pressure = N.clip(0.15 * F.col("scheduled_macro_event_count") + 0.35 * F.col("macro_shock_event_count") + 0.10 * F.col("macro_event_risk_window_flag"), 0, 1)
    return df.withColumn("macro_event_pressure_score", pressure).drop("calendar", "__sched")


def surprise_events(monthly: DataFrame, spine: DataFrame) -> DataFrame:
    """K11. Release metric against its own lagged expectation, on the first usable spine day."""
    ax = Axis.of("series_id", "asof_date")
    spec = lambda i: L.lookup({s: v[i] for s, v in SURPRISE_SPECS.items()}, "series_id")
    df = monthly.where(F.col("series_id").isin(list(SURPRISE_SPECS)) & F.col("value").isNotNull())
    df = df.withColumns({"previous_value": F.lag("value").over(ax.by), "actual_mom_change": W.lag_diff(ax, "value", 1), "actual_pct_change": W.lag_return(ax, "value", 1),
                         "event_group": spec(0), "metric_type": spec(1)})
    df = df.withColumn("actual_metric_value", F.when(F.col("metric_type") == "yoy", W.year_over_year(ax, "value")).otherwise(F.col("actual_mom_change")))
    df = W.with_expectation(df, ax, "actual_metric_value")
    df = df.withColumn("risk_off_surprise_zscore", F.col("surprise_z") * spec(2))
    df = df.withColumns({"proxy_surprise_value": F.col("actual_metric_value") - F.col("expected"), "surprise_direction_label": L.surprise_direction("surprise_z"),
                         "risk_bias_label": L.surprise_bias("risk_off_surprise_zscore")})
    out = A.asof_forward(df.withColumnRenamed("asof_date", "source_observation_date"), spine, "source_observation_date", RELEASE_LAG_DAYS, "asof_date")
    return out.withColumnsRenamed({"series_id": "source_series_id", "value": "actual_value", "expected": "expected_proxy_value", "surprise_z": "proxy_surprise_zscore"}).drop("expected_std")


def surprise_context(events: DataFrame, spine: DataFrame) -> DataFrame:
    """K11. Daily surprise aggregates on every spine day."""
    signed = N.clip(F.col("risk_off_surprise_zscore") / 3.0, -1, 1)
    per_day = events.groupBy("asof_date").agg(
        F.count(F.lit(1)).alias("macro_surprise_event_count"), F.max(F.abs("proxy_surprise_zscore")).alias("macro_surprise_abs_zscore_max"),
        F.avg(signed).alias("macro_surprise_risk_off_score"),
        *[F.avg(F.when(F.col("event_group") == g, signed)).alias(f"{g}_surprise_risk_off_score") for g in SURPRISE_GROUPS])
    df = spine.join(per_day, "asof_date", "left").na.fill(0, ["macro_surprise_event_count"]).withColumn("__k", F.lit("KR"))
    ax = Axis.of("__k", "asof_date")
    score = F.col("macro_surprise_risk_off_score")
    return df.withColumns({
        "macro_surprise_proxy_available_flag": (F.col("macro_surprise_event_count") > 0).cast("int"), "macro_surprise_pressure_score": N.clip(score, 0, 1),
        "macro_surprise_relief_score": N.clip(-score, 0, 1), "macro_surprise_event_density_63d": W.rolling_sum(ax, "macro_surprise_event_count", 63)}).drop("__k")
