"""Forward targets, forecast validation and monitoring."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import labels as L
from tidemark.operators import metrics as M
from tidemark.operators import relational as R
from tidemark.operators import windows as W
from tidemark.operators.windows import Axis
from tidemark.plans.specs import DRAWDOWN_LIMITS, FORECAST_HORIZONS

KEYS = ["asof_date", "market_scope", "forecast_horizon"]


def forecast_targets(closes: DataFrame, benchmark: str = "ALL", horizons: Mapping[str, int] = FORECAST_HORIZONS,
                     limits: Mapping[str, float] = DRAWDOWN_LIMITS) -> DataFrame:
    """K12. Forward return, path extremes and flags per day, scope and horizon.

    ``closes``: asof_date, market_scope, close. All horizons share one window pass; rows then fan out by horizon.
    """
    ax = Axis.of("market_scope", "asof_date")
    per = [F.struct(F.lit(h).alias("forecast_horizon"), F.lit(n).alias("target_horizon_trading_days"), F.lit(float(limits[h])).alias("__limit"),
                    F.col(f"__r{n}").alias("target_forward_return"), F.col(f"__e{n}").alias("target_end_close"), F.col(f"__d{n}").alias("target_end_asof_date"),
                    F.col(f"__lo{n}").alias("target_forward_max_drawdown"), F.col(f"__hi{n}").alias("target_forward_max_runup")) for h, n in horizons.items()]
    wide = closes.withColumns({k: v for n in horizons.values() for k, v in {
        f"__r{n}": W.forward_return(ax, "close", n), f"__e{n}": F.lead("close", n).over(ax.by), f"__d{n}": F.lead("asof_date", n).over(ax.by),
        f"__lo{n}": W.forward_drawdown(ax, "close", n), f"__hi{n}": W.forward_runup(ax, "close", n)}.items()})
    df = wide.select("asof_date", "market_scope", F.col("close").alias("target_start_close"), F.explode(F.array(*per)).alias("__t"))
    df = df.select("asof_date", "market_scope", "target_start_close", "__t.*")
    df = R.with_benchmark(df, ["asof_date", "forecast_horizon"], "market_scope", benchmark, "target_forward_return", "__bench")
    ret = F.col("target_forward_return")
    flag = lambda c: c.cast("int")
    return df.withColumns({
        "target_excess_return_vs_all": F.when(F.col("market_scope") == benchmark, 0.0).otherwise(ret - F.col("__bench")), "target_excess_return_vs_cash": ret,
        "target_direction_label": F.when(ret > 0, "up").when(ret.isNotNull(), "down_or_flat"), "target_upside_flag": flag(ret > 0),
        "target_downside_risk_flag": flag(F.col("target_forward_max_drawdown") <= -F.col("__limit")),
        "target_large_upside_flag": flag(F.col("target_forward_max_runup") >= F.col("__limit")), "target_available_flag": ret.isNotNull().cast("int")}).drop("__bench", "__limit")


def same_side(a: Column, b: Column) -> Column:
    """Both above zero or both at most zero; unknown counts as a miss."""
    return F.coalesce((a > 0) == (b > 0), F.lit(False)).cast("int")


def forecast_validation(forecast: DataFrame, calibrated: DataFrame, target: DataFrame) -> DataFrame:
    """K13. Forecasts against targets with direction hits and errors."""
    df = R.star_join(forecast, [(target, KEYS), (calibrated, KEYS)])
    real, base, model = F.col("target_forward_return"), F.col("market_forecast_score"), F.col("predicted_forward_return")
    valid = F.col("target_available_flag") == 1
    return df.withColumns({"baseline_direction_hit_flag": F.when(valid, same_side(base, real)), "baseline_forecast_error": base - real,
                           "ai_direction_hit_flag": F.when(valid, same_side(model, real)), "ai_forecast_error": model - real})


def forecast_monitoring(validation: DataFrame, windows: Sequence[int] = (20, 60, 120)) -> DataFrame:
    """K14. Rolling correlation, hit rate and error of baseline and model, with a quality label."""
    ax = Axis.of(["market_scope", "forecast_horizon"], "asof_date")
    df = validation.withColumns({"baseline_abs_error": F.abs("baseline_forecast_error"), "ai_abs_error": F.abs("ai_forecast_error")})
    cols: dict[str, Column] = {}
    for n in windows:
        need = max(10, n // 2)
        for who, score in (("baseline", "market_forecast_score"), ("ai", "predicted_forward_return")):
            cols[f"{who}_corr_{n}d"] = W.rolling_corr(ax, score, "target_forward_return", n)
            cols[f"{who}_hit_rate_{n}d"] = W.rolling_mean(ax, f"{who}_direction_hit_flag", n, need)
            cols[f"{who}_mae_{n}d"] = W.rolling_mean(ax, f"{who}_abs_error", n, need)
    df = df.withColumns(cols)
    df = df.withColumns({f"ai_minus_baseline_{k}_{n}d": F.col(f"ai_{k}_{n}d") - F.col(f"baseline_{k}_{n}d") for n in windows for k in ("corr", "hit_rate", "mae")})
    return df.withColumn("monitoring_quality_label", L.monitoring_quality("ai_corr_60d", "ai_hit_rate_60d"))


def validation_summary(validation: DataFrame, keys: Sequence[str] = ("market_scope", "forecast_horizon")) -> DataFrame:
    """A12 over the validation mart."""
    return validation.groupBy(*keys).agg(*M.regression_errors("predicted_forward_return", "target_forward_return"))
