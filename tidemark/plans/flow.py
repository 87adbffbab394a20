"""Domestic flow and derivatives mart (K9) and the investor aggregate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import numeric as N
from tidemark.operators import asof as A
from tidemark.operators import metrics as M
from tidemark.operators import relational as R
from tidemark.operators import windows as W
from tidemark.operators.windows import Axis
from tidemark.plans.context import flow_ratios
from tidemark.sources.sinks import merged

INVESTORS = ["foreign", "institution", "retail"]


def investor_features(flows: DataFrame, investors: Mapping[str, str] | None = None) -> DataFrame:
    """Daily investor features per scope (members and ALL) with 5- and 20-day windows.

    ``flows``: asof_date, ticker, market, investor, net_value, net_volume, source.
    ``investors`` maps foreign / institution / retail to the stored names. The sums are
    made per (day, scope, investor) before any window, so windows see one row per day and scope.
    """
    names = investors or {k: k for k in INVESTORS}
    wanted = flows.where(F.col("investor").isin(list(names.values()))).groupBy("asof_date", "ticker", "market", "investor").agg(
        F.sum("net_value").alias("v"), F.sum("net_volume").alias("q"), F.count_if(F.col("net_value") > 0).alias("p"), F.min("source").alias("source"))
    scoped = R.with_all_scope(wanted, "market", out="market_scope")
    aggs = []
    for k, stored in names.items():
        mine = F.col("investor") == stored
        aggs += [F.sum(F.when(mine, F.col("v"))).alias(f"{k}_net_buy_value_krw"), F.sum(F.when(mine, F.col("q"))).alias(f"{k}_net_buy_volume"),
                 N.ratio(F.sum(F.when(mine, F.col("p"))), F.count(F.when(mine, F.lit(1)))).alias(f"{k}_buying_breadth")]
    df = scoped.groupBy("asof_date", "market_scope").agg(
        *aggs, F.substring(F.array_join(F.array_sort(F.collect_set("source")), ","), 1, 200).alias("investor_flow_source"))
    values = {k: f"{k}_net_buy_value_krw" for k in names}
    parts = flow_ratios(values)
    parts["investor_flow_available"] = parts.pop("flow_context_available")
    df = df.withColumns(parts).withColumn("total_abs_net_value_krw", F.nullif(N.row_sum(*[F.abs(v) for v in values.values()]), F.lit(0.0)))
    ax = Axis.of("market_scope", "asof_date")
    rolled: dict[str, Column] = {}
    for k, v in values.items():
        for n in (5, 20):
            rolled[f"{k}_net_buy_value_{n}d_krw"] = W.rolling_sum(ax, v, n)
            rolled[f"{k}_net_buy_ratio_{n}d"] = W.ratio_of_sums(ax, v, "total_abs_net_value_krw", n)
    for k in ("foreign", "institution"):
        rolled[f"{k}_net_buy_days_5d"] = W.positive_days(ax, values[k], 5)
    for n in (5, 20):
        rolled[f"smart_money_score_{n}d"] = W.rolling_mean(ax, "smart_money_score", n)
    return df.withColumns(rolled)


def derivatives_features(futures: DataFrame, signals: DataFrame, codes: Mapping[str, str]) -> DataFrame:
    """Closing futures change and program flow of each session, outer-joined by day.

    ``futures``: session_date, asof_ts, change_pct; ``signals``: session_date, asof_ts, signal_code, metric_value (in eok).
    ``codes`` maps program, foreign, institution, retail to signal codes.
    """
    last = futures.groupBy(F.col("session_date").alias("asof_date")).agg(F.max_by("change_pct", "asof_ts").alias("futures_change_pct"))
    mine = lambda c: F.col("signal_code") == c
    flow = signals.where(F.col("signal_code").isin(list(codes.values()))).groupBy(F.col("session_date").alias("asof_date")).agg(*[
        F.max_by(F.when(mine(c), F.col("metric_value")), F.when(mine(c), F.col("asof_ts"))).alias(f"intraday_{k}_net_eok") for k, c in codes.items()])
    df = last.join(flow, "asof_date", "full")
    df = df.withColumn("program_total_net_krw", F.col("intraday_program_net_eok") * N.EOK)
    df = df.withColumns({"futures_direction_score": N.clip(F.col("futures_change_pct") * 50.0), "program_pressure_score": N.clip(F.col("program_total_net_krw") / 1e12)})
    return df.withColumns({"derivatives_pressure_score": N.clip(N.row_mean("futures_direction_score", "program_pressure_score")), "derivatives_context_available": F.lit(1)})


def flow_mart(spine: DataFrame, flows: DataFrame, futures: DataFrame, signals: DataFrame, codes: Mapping[str, str],
              scopes: Sequence[str] = ("ALL", "KOSPI", "KOSDAQ"), investors: Mapping[str, str] | None = None) -> DataFrame:
    """K9. Investor and derivatives features on the (day, scope) grid, intraday totals filling ALL where the daily feed lags."""
    base = A.grid(spine.select("asof_date"), "market_scope", list(scopes))
    df = R.star_join(base, [(investor_features(flows, investors), ["asof_date", "market_scope"]), (derivatives_features(futures, signals, codes), ["asof_date"])])
    df = df.na.fill(0, ["investor_flow_available", "derivatives_context_available"])
    intra = {k: F.col(f"intraday_{k}_net_eok") for k in INVESTORS}
    fallback = flow_ratios(intra)
    denom = F.nullif(N.row_sum(*[F.abs(c) for c in intra.values()]), F.lit(0.0))
    fallback["smart_money_score"] = (F.coalesce(intra["foreign"], F.lit(0.0)) + F.coalesce(intra["institution"], F.lit(0.0)) - F.coalesce(intra["retail"], F.lit(0.0))) / denom
    use = (F.col("market_scope") == "ALL") & (F.col("investor_flow_available") == 0) & (fallback.pop("flow_context_available") == 1)
    df = df.withColumn("__use", F.coalesce(use, F.lit(False)))
    df = df.withColumns({**{k: F.when(F.col("__use"), v).otherwise(F.col(k)) for k, v in fallback.items()},
                         "investor_flow_source": F.when(F.col("__use"), "intraday_flow_signal_fallback").otherwise(F.col("investor_flow_source"))})
    df = df.withColumn("investor_flow_available", F.when(F.col("__use"), 1).otherwise(F.col("investor_flow_available"))).drop("__use")
    score = N.clip(N.row_mean(F.col("smart_money_score") * 1.5, "futures_direction_score", "program_pressure_score"))
    available = ((F.col("investor_flow_available") == 1) | (F.col("derivatives_context_available") == 1)).cast("int")
    return df.withColumns({"domestic_flow_derivatives_score": score, "domestic_flow_available": available})


def recompute_aggregate(stored: DataFrame, stock_flows: DataFrame) -> DataFrame:
    """K29. Market-level sums recomputed from stock flows replace the stored rows of their keys."""
    fresh = M.grouping_totals(stock_flows, "date", "market_scope", "investor", "net_value").drop("row_count")
    return merged(stored, fresh, ["date", "market_scope", "investor"])
