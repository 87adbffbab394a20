"""State panels: short-term blends, material changes, composite axes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import dates as D
from tidemark.functions import labels as L
from tidemark.functions.numeric import as_col, clip, overnight_biases, ratio, row_mean
from tidemark.operators import asof as A
from tidemark.operators import relational as R
from tidemark.operators import windows as W
from tidemark.operators.windows import Axis


def short_term_blend(close_score, week_score, intraday_score, live: Column) -> Column:
    """P33. Weights follow the session: closing, live, or previous-close intraday."""
    close, week, intra = as_col(close_score), as_col(week_score), as_col(intraday_score)
    mixed = (F.when(intra.isNull(), close * 0.55 + week * 0.45).when(live, week * 0.20 + intra * 0.80)
             .otherwise(week * 0.45 + intra * 0.55))
    return F.round(clip(mixed), 4)


def material_change(df: DataFrame, keys: Sequence[str], order: Sequence[str], same: Sequence[str], score: str, bias: str,
                    step: float = 0.35) -> DataFrame:
    """P35, D10. 1 where a row differs materially from the row before it; first row 1."""
    ax = Axis.of(list(keys), list(order))
    prev = F.lag(F.struct(*same, score, F.signum(bias).alias("__sign"), F.lit(1).alias("__there"))).over(ax.by)
    df = df.withColumn("__prev", prev)
    moved = F.abs(F.col(score) - F.col(f"__prev.{score}")) >= step
    turned = F.signum(bias) != F.col("__prev.__sign")
    differs = [~F.col(c).eqNullSafe(F.col(f"__prev.{c}")) for c in same]
    flag = F.coalesce(moved, F.lit(False)) | F.coalesce(turned, F.lit(False))
    for d in differs:
        flag = flag | d
    return df.withColumn("material_change", F.when(F.col("__prev").isNull(), 1).otherwise(flag.cast("int"))).drop("__prev")


def next_day_test_scores(global_risk, fx, futures) -> dict[str, Column]:
    """P40. Test scores kept apart from the official series."""
    zero = F.lit(0.0)
    g, x, f = (F.coalesce(as_col(c), zero) for c in (global_risk, fx, futures))
    return {"environment": clip(0.65 * g + 0.35 * x), "short_term": clip(f)}


# -- series catalogue, composite axes, panels ---------------------------------------------

def series_catalogue(series: DataFrame, key: str, date: str, value: str, source: Column, points_from) -> DataFrame:
    """K23. Span, latest value and change, source tier and the recent points of each series.

    The point list of a series has at most one entry per day of the kept years.
    """
    ax = Axis.of(key, date)
    rows = series.where(F.col(value).isNotNull()).withColumns({"change": W.lag_diff(ax, value, 1), "change_pct": W.lag_return(ax, value, 1)})
    last = F.max_by(F.struct(F.col(value).alias("latest_value"), F.col("change").alias("latest_change_value"), F.col("change_pct").alias("latest_change_pct")), date)
    meta = rows.groupBy(key).agg(F.min(date).alias("start_date"), F.max(date).alias("latest_date"), F.count(F.lit(1)).alias("point_count"), last.alias("__l"))
    recent = R.nest_points(rows.where(F.col(date) >= points_from).select(key, F.col(date).alias("date"), F.col(value).alias("value")), [key], ["date", "value"])
    out = meta.join(recent, key, "left").withColumn("source_tier", L.catalogue_source_tier(source))
    return out.select(key, "start_date", "latest_date", "point_count", "__l.*", "source_tier", F.coalesce(F.size("points"), F.lit(0)).alias("recent_points"), "points")


def current_point(daily: DataFrame, live: DataFrame, key: str, date: str, value: str) -> DataFrame:
    """D8. Newest live value replaces or follows the last daily point of its series."""
    now = live.select(key, date, value, F.lit("current_intraday_quote").alias("point_type"))
    return R.union_by_priority([(now, 0), (daily.select(key, date, value, F.lit("daily").alias("point_type")), 1)], [key, date])


AXES = ["financial_environment", "medium_term_model_outlook", "short_term_market_condition"]


def axis_scores(df: DataFrame) -> DataFrame:
    """P32. The three axis scores of a wide context row (missing columns count as null)."""
    names = ["global_risk_on_score", "external_asset_risk_on_score", "us_equity_momentum_score", "korea_proxy_momentum_score", "external_macro_pressure_score", "rate_pressure_score",
             "commodity_pressure_score", "risk_aversion_score", "credit_stress_score", "financial_environment_score", "medium_term_model_outlook_score", "market_forecast_score",
             "market_state_score", "short_term_market_condition_score", "futures_direction_score", "derivatives_pressure_score", "smart_money_score_5d", "market_state_score_delta_5d"]
    full = df.withColumns({c: F.lit(None).cast("double") for c in names if c not in df.columns})
    opportunity, pressure = row_mean(*names[:4]), row_mean(*names[4:9])
    env = F.coalesce("financial_environment_score", clip(opportunity - pressure * 0.7))
    medium = F.coalesce("medium_term_model_outlook_score", "market_forecast_score", "market_state_score")
    short = F.coalesce("short_term_market_condition_score", clip(row_mean("futures_direction_score", "derivatives_pressure_score", "smart_money_score_5d", clip(F.col("market_state_score_delta_5d") * 2.0))))
    return full.select(*[c for c in df.columns if c not in names], env.alias(AXES[0]), medium.alias(AXES[1]), short.alias(AXES[2]))


def composite_chart(axes: DataFrame, until: Column, date: str = "asof_date") -> DataFrame:
    """K24. Axis scores as long series, rounded, filled over non-trading days up to ``until``."""
    long = axes.unpivot([date], AXES, "series_id", "raw").where(F.col("raw").isNotNull())
    points = long.select("series_id", F.col(date).alias("date"), F.round(clip("raw"), 4).alias("value"))
    return A.carry_forward_days(points, ["series_id"], "date", ["value"], until)


def rebased_indices(prices: DataFrame, key: str, date: str, close: str, start) -> DataFrame:
    """K24, W41. Reference indices rebased to 100 at the first day shown."""
    ax = Axis.of(key, date)
    return prices.where(F.col(date) >= start).select(key, date, W.rebased(ax, close).alias("level"))


def index_panel(prices: DataFrame, key: str, date: str, close: str, upto) -> DataFrame:
    """K26. Current returns, volatility (log returns), drawdown and tone per index."""
    ax = Axis.of(key, date)
    rows = prices.where(F.col(date) <= upto).withColumn("__l", F.log(ratio(close, F.lag(close).over(ax.by))))
    rows = rows.select(key, date, close, *[W.lag_return(ax, close, n).alias(f"ret_{n}d") for n in (1, 5, 20, 60)], W.annualised_vol(ax, "__l", 20, 20).alias("realized_vol_20d"),
                       W.drawdown(ax, close, 20).alias("drawdown_20d"))
    return R.latest_per_key(rows, [key], [date]).withColumn("direction", L.change_direction("ret_1d"))


def panel_history(states: DataFrame, scores: DataFrame, keys: Sequence[str], since, upto, ts: str) -> DataFrame:
    """K25, J20. State history with its component scores inside a lookback."""
    window = states.where(F.col(ts).between(since, upto))
    return window.join(scores, [*keys, ts])


def preview_states(assets: DataFrame, news: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """K27. Overnight biases, label, session and material-change flag per preview instant.

    ``assets``: keys, ts, asset_code, change_pct; ``news``: keys, ts, risk_headlines.
    """
    codes = {"night": "KOSPI200_NIGHT_FUT", "proxy": "KOREA_PROXY_EWY", "sp500": "SP500_FUT", "nasdaq": "NASDAQ100_FUT", "fx": "USDKRW", "oil": "WTI", "us10y": "US10Y"}
    wide = assets.groupBy(*keys, ts).agg(*[F.max(F.when(F.col("asset_code") == c, F.col("change_pct"))).alias(k) for k, c in codes.items()])
    df = R.attach_with_default(wide, news, [*keys, ts], {"risk_headlines": 0})
    biases = overnight_biases({**{k: F.col(k) for k in codes}, "risk_headlines": F.col("risk_headlines")})
    df = df.withColumns({k: F.round(v, 4) for k, v in biases.items()}).withColumns({"alignment": L.signal_agreement("night", "proxy")})
    df = df.withColumns({"preview_label": L.preview("next_day_score"), "reference_session": D.reference_session(ts), "active": D.in_preview_window(ts).cast("int")})
    return material_change(df, list(keys), [ts], ["preview_label"], "next_day_score", "futures_bias").drop(*codes)


# -- disclosures ----------------------------------------------------------------------------

def disclosure_events(filings: DataFrame, text: str, rules=L.DISCLOSURE_RULES, exempt=L.DISCLOSURE_EXEMPT) -> DataFrame:
    """K28, P27. Filings with category, risk flag and severity."""
    return filings.withColumn("__k", L.classify_text(text, rules, exempt)).select(*filings.columns, "__k.*")


def disclosure_summary(events: DataFrame, keys: Sequence[str], filing: str, k: int = 10) -> DataFrame:
    """K28, A29, T10. Counts per key and the first ``k`` highlights by severity, newest first.

    Only the ranked head of each key is gathered into the list.
    """
    total = events.groupBy(*keys).agg(F.count(F.lit(1)).alias("filing_count_total"), F.sum("risk_flag").alias("risk_event_count"),
                                      F.count_if(F.col("category_key") == "funding").alias("funding_count"), F.count_if(F.col("category_key") == "general").alias("general_count"))
    order = F.when(F.col("severity_label") == "high", 0).when(F.col("severity_label") == "medium", 1).otherwise(2)
    shown = events.where((F.col("risk_flag") == 1) | F.col("severity_label").isin("high", "medium")).withColumn("__o", order)
    head = R.pick_first(shown, keys, [F.asc("__o"), F.desc(filing)], k, "__rk")
    lists = head.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("__rk", filing))).alias("__h"))
    out = total.join(lists, list(keys), "left")
    return out.withColumn("highlights", F.transform(F.coalesce("__h", F.array().cast(head.select(F.array(F.struct("__rk", filing))).schema[0].dataType)), lambda x: x[filing])).drop("__h")
