"""Signal hand-over rows and their checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import labels as L
from tidemark.operators import asof as A
from tidemark.operators import relational as R
from tidemark.plans.backtest import KEYS, PROBS


def signal_rows(best: DataFrame, probabilities: DataFrame, thresholds: DataFrame, profiles: Mapping[str, Mapping[str, float]]) -> DataFrame:
    """K22. One signal per (scope, horizon): newest probabilities, latest tuned thresholds, rule exposure, warnings."""
    latest = R.latest_per_key(probabilities.select(*KEYS, "asof_date", *PROBS.values()), KEYS, ["asof_date"])
    rows = best.select("candidate_type", *KEYS, "decision_method", "rule_name", "confidence_floor", F.col("sharpe").alias("selection_sharpe"),
                       F.col("sharpe_lift").alias("selection_sharpe_lift"), F.col("mdd_improvement").alias("selection_mdd_improvement"),
                       F.col("cumulative_return").alias("selection_cumulative_return"), F.col("buyhold_cumulative_return").alias("selection_buyhold_cumulative_return"))
    df = rows.join(latest, KEYS)
    df = A.threshold_by_year(df, thresholds.select(*KEYS, "test_year", "down_threshold", "up_threshold"), KEYS, F.year("asof_date"), "test_year", ["down_threshold", "up_threshold"])
    tuned = (F.col("decision_method") == "threshold") & F.col("down_threshold").isNotNull()
    direction = F.when(tuned, L.threshold_label("prob_down", "prob_up", "down_threshold", "up_threshold")).otherwise(L.argmax_label(PROBS))
    df = df.withColumns({"predicted_direction": direction, "confidence": F.greatest(*PROBS.values())})
    low = F.col("confidence") < F.col("confidence_floor")
    chosen = None
    for name, p in profiles.items():
        value = F.when(low, p["fallback"]).otherwise(L.lookup({k: p[k] for k in ("up", "sideways", "down")}, "predicted_direction", 0.0))
        test = F.col("rule_name") == name
        chosen = F.when(test, value) if chosen is None else chosen.when(test, value)
    warnings = F.concat_ws(";", F.when((F.col("decision_method") == "threshold") & F.col("down_threshold").isNull(), "missing_threshold_used_argmax"),
                           F.when(low, "low_confidence_fallback"))
    return df.withColumns({"recommended_exposure": chosen, "quality_warnings": warnings, "model_status": F.lit("ok"), "release_stage": F.lit("research_beta")}).withColumnRenamed("model", "model_name")


def signal_quality(signals: DataFrame, today: Column, max_stale_days: int, scopes: Sequence[str], horizons: Sequence[str], source_dates: DataFrame, forbidden: str = "ALL") -> DataFrame:
    """Q6. Errors and warnings of a signal table as rows (kind, check_name, detail)."""
    newest = signals.agg(F.max("asof_date").alias("asof_date"))
    stale = newest.where(F.datediff(today, "asof_date") > max_stale_days).select(F.lit("error").alias("kind"), F.lit("stale_signal").alias("check_name"), F.col("asof_date").cast("string").alias("detail"))
    wanted = R.explode_grid(newest, [{"market_scope": s, "forecast_horizon": h} for s in scopes for h in horizons])
    missing = R.missing_keys(wanted, signals, ["market_scope", "forecast_horizon"]).select(
        F.lit("error").alias("kind"), F.lit("missing_market_horizon").alias("check_name"), F.concat_ws(":", "market_scope", "forecast_horizon").alias("detail"))
    banned = signals.where(F.col("market_scope") == forbidden).select(F.lit("error").alias("kind"), F.lit("non_investable_scope").alias("check_name"), F.col("forecast_horizon").alias("detail"))
    lagging = source_dates.withColumn("signal_date", newest.select("asof_date").scalar()).where(F.col("latest_date") < F.col("signal_date")).select(
        F.lit("warning").alias("kind"), F.lit("daily_source_older_than_signal").alias("check_name"), F.concat_ws(":", "market_scope", F.col("latest_date").cast("string")).alias("detail"))
    return stale.unionByName(missing).unionByName(banned).unionByName(lagging)
