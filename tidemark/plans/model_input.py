"""Wide model-input mart and readiness pack (K16, K17, P21, P41, M3 split)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import labels as L
from tidemark.functions import numeric as N
from tidemark.operators import metrics as M
from tidemark.operators import quality as Q
from tidemark.operators import relational as R
from tidemark.operators import windows as W
from tidemark.operators.windows import Axis
from tidemark.plans.targets import KEYS

# Lags of the change features.
DELTA_SPECS = {
    "market_state_score": [1, 5, 20], "trend_score": [5, 20], "breadth_score": [5, 20], "risk_score": [5, 20], "risk_on_score": [5, 20], "risk_off_score": [5, 20],
    "global_risk_on_score": [5, 20], "external_asset_risk_on_score": [5, 20], "market_forecast_score": [1, 5, 20], "calibrated_forecast_score": [5, 20],
}
PRESSURE_WORDS = ("pressure", "stress", "risk_off", "drawdown", "aversion", "volatility")


def regime_changes(df: DataFrame) -> DataFrame:
    """Change, transition and momentum features per (scope, horizon); one shuffle for all."""
    ax = Axis.of(["market_scope", "forecast_horizon"], "asof_date")
    deltas = {f"{c}_delta_{n}d": F.round(W.lag_diff(ax, c, n), 6) for c, lags in DELTA_SPECS.items() if c in df.columns for n in lags}
    change = W.change_columns(ax, "market_state_label")
    df = df.withColumns({**deltas, "previous_market_state_label": change["previous"], "state_change_flag": change["changed"]})
    df = df.withColumns({
        "market_forecast_score_acceleration_5d": F.round(W.lag_diff(ax, "market_forecast_score_delta_5d", 5), 6),
        "state_change_direction": L.regime_direction("market_state_score_delta_1d"),
        "transition_count_5d": W.transition_counts(ax, "state_change_flag", 5), "transition_count_20d": W.transition_counts(ax, "state_change_flag", 20)})
    df = W.with_days_since_change(df, ax, "state_change_flag", "days_since_state_change")
    return df.withColumns({
        "regime_stability_score": F.round(1.0 - N.clip(F.col("transition_count_20d") / 5.0, 0, 1), 6),
        "regime_momentum_label": L.regime_momentum("market_state_score_delta_5d", "market_forecast_score_acceleration_5d")})


def coverage(df: DataFrame, groups: Mapping[str, Sequence[str]]) -> DataFrame:
    """Q4 over the feature groups, with the number of groups present."""
    known = {g: [c for c in cols if c in df.columns] for g, cols in groups.items()}
    out = Q.with_coverage(df, {g: cols for g, cols in known.items() if cols}, L.coverage_quality)
    present = sum((F.col(f"{g}_available") for g, cols in known.items() if cols), F.lit(0))
    nulls = sum((F.col(f"{g}_null_count") for g, cols in known.items() if cols), F.lit(0))
    return out.withColumns({"source_group_available_count": present, "source_group_expected_count": F.lit(len(groups)), "overall_null_count": nulls})


def model_input(forecast: DataFrame, by_scope: Sequence[DataFrame], by_day: Sequence[DataFrame], calibrated: DataFrame, groups: Mapping[str, Sequence[str]]) -> DataFrame:
    """K16. Left star join of all marts onto the forecast keys, then change features and coverage flags."""
    parts = [(p, ["asof_date", "market_scope"]) for p in by_scope] + [(p, ["asof_date"]) for p in by_day] + [(calibrated, KEYS)]
    return with_directions(coverage(regime_changes(R.star_join(forecast, parts)), groups))


def score_direction(column: str) -> str:
    """P41. Reading of a score: whether a high value is favourable."""
    if any(w in column for w in PRESSURE_WORDS):
        return "higher_is_riskier"
    return "higher_is_better" if column.endswith(("_score", "_ratio")) else "descriptive"


def with_directions(df: DataFrame) -> DataFrame:
    """P41. Direction as column metadata; data is not touched."""
    return df.select(*[F.col(f.name).alias(f.name, metadata={"score_direction": score_direction(f.name)}) if isinstance(f.dataType, T.NumericType) else F.col(f.name)
                       for f in df.schema])


def feature_columns(schema: T.StructType, keys: Sequence[str] = KEYS, blocked_prefixes: Sequence[str] = ("target_",),
                    blocked: Sequence[str] = ("schema_version", "feature_version", "coverage_policy"), numeric_only: bool = False) -> list[str]:
    """P21. Feature names by type, prefix and block list; reads the schema only."""
    return [f.name for f in schema if f.name not in keys and f.name not in blocked and not f.name.startswith(tuple(blocked_prefixes))
            and "generated_at" not in f.name and (not numeric_only or isinstance(f.dataType, T.NumericType))]


def readiness(inputs: DataFrame, target: DataFrame, validation: DataFrame, dimensions: Sequence[str], source_date: str) -> dict[str, DataFrame]:
    """K17. Training rows, latest inference rows, leakage report and regime performance."""
    features = feature_columns(inputs.schema)
    train = inputs.join(target, KEYS).where(F.col("target_available_flag") == 1)
    latest = inputs.where(F.col("asof_date") == inputs.agg(F.max("asof_date")).scalar())
    rows = validation.where(F.col("target_available_flag") == 1).join(inputs.select(*KEYS, *dimensions), KEYS, "left")
    aggs = [F.count(F.lit(1)).alias("rows"), F.avg("target_forward_return").alias("mean_target_forward_return"),
            M.safe_corr("market_forecast_score", "target_forward_return").alias("baseline_corr"), F.avg("baseline_direction_hit_flag").alias("baseline_hit_rate"),
            F.avg(F.abs("baseline_forecast_error")).alias("baseline_mae")]
    regime = M.dimension_performance(rows, ["market_scope", "forecast_horizon"], dimensions, aggs)
    return {"train": train, "inference_latest": latest, "leakage": Q.leakage_checks(train, "asof_date", source_date, "target_end_asof_date", features), "regime": regime}


def chronological_split(df: DataFrame, keys: Sequence[str], order: str, train_share: float = 0.8) -> DataFrame:
    """M3, M16. ``is_train`` marks the first share of each group's rows."""
    ax = Axis.of(list(keys), order)
    cut = F.floor(F.count(F.lit(1)).over(ax.whole) * train_share)
    return df.withColumn("is_train", W.row_index(ax) <= cut)
