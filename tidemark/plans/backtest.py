"""Decisions, thresholds, rules and backtests of direction signals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions import labels as L
from tidemark.operators import metrics as M
from tidemark.operators import windows as W
from tidemark.operators.relational import explode_grid, latest_per_key, near_best, pick_first
from tidemark.operators.windows import Axis
from tidemark.session import cut_lineage

PROBS = {"down": "prob_down", "sideways": "prob_sideways", "up": "prob_up"}


def with_confidence(df: DataFrame) -> DataFrame:
    return df.withColumn("confidence", F.greatest(*PROBS.values()))


def decide(predictions: DataFrame, thresholds: DataFrame, keys: Sequence[str]) -> DataFrame:
    """J23. Tuned threshold decision where one exists for the keys, else the largest probability."""
    rows = predictions.join(thresholds, list(keys), "left")
    tuned = L.threshold_label("prob_down", "prob_up", "down_threshold", "up_threshold")
    direction = F.when(F.col("down_threshold").isNull(), L.argmax_label(PROBS)).otherwise(tuned)
    return with_confidence(rows.withColumn("predicted_direction", direction))


def threshold_grid(values: Sequence[float]) -> list[dict]:
    """J24. Every down / up threshold pair in a fixed order."""
    return [{"down_threshold": float(d), "up_threshold": float(u), "grid_index": i * len(values) + j}
            for i, d in enumerate(values) for j, u in enumerate(values)]


def _sides(values: Sequence[float]) -> list[dict]:
    return [{"side": side, "idx": i} for side in ("down", "up") for i in range(len(values))]


def side_counts(predictions: DataFrame, keys: Sequence[str], values: Sequence[float]) -> DataFrame:
    """Rows reaching each threshold, per side and actual class.

    A row can only turn down (its down probability is at least its up
    probability) or up, so the two thresholds act on disjoint rows and one
    histogram per side replaces the grid of pairs. Output per (keys, side, idx):
    ``h_c`` rows of class c at or above the threshold, ``t_c`` all rows of the side.
    """
    down_side = F.col("prob_down") >= F.col("prob_up")
    reach = F.when(down_side, F.col("prob_down")).otherwise(F.col("prob_up"))
    level = F.expr(" + ".join(f"int(__p >= {float(v)}D)" for v in values))
    rows = predictions.select(*keys, "actual_label", F.when(down_side, "down").otherwise("up").alias("side"), reach.alias("__p")).withColumn("level", level)
    hist = rows.groupBy(*keys, "side", "level").agg(*[F.count_if(F.col("actual_label") == c).alias(f"a_{c}") for c in PROBS])
    per = hist.withColumn("idx", F.explode(F.array(*[F.lit(i) for i in range(len(values))])))
    return per.groupBy(*keys, "side", "idx").agg(*[F.sum(F.when(F.col("level") > F.col("idx"), F.col(f"a_{c}")).otherwise(0)).alias(f"h_{c}") for c in PROBS],
                                                 *[F.sum(f"a_{c}").alias(f"t_{c}") for c in PROBS])


SIDE_COLUMNS = [f"{k}_{c}" for k in "ht" for c in PROBS]


def grid_counts(sides: DataFrame, keys: Sequence[str], values: Sequence[float]) -> DataFrame:
    """Class counts of every threshold pair from the side counts (fixed grid, no join)."""
    cell = F.struct(F.concat("side", F.col("idx").cast("string")).alias("key"), F.struct(*SIDE_COLUMNS).alias("value"))
    packed = sides.groupBy(*keys).agg(F.map_from_entries(F.collect_list(cell)).alias("__m"))
    rows = explode_grid(packed, threshold_grid(values))
    n = len(values)
    rows = rows.withColumns({"__d": F.try_element_at("__m", F.concat(F.lit("down"), F.floor(F.col("grid_index") / n).cast("string"))),
                             "__u": F.try_element_at("__m", F.concat(F.lit("up"), (F.col("grid_index") % n).cast("string")))})
    at = lambda side, c: F.coalesce(F.col(f"{side}.{c}"), F.lit(0))
    act = {c: at("__d", f"t_{c}") + at("__u", f"t_{c}") for c in PROBS}
    pred_down = at("__d", "h_down") + at("__d", "h_sideways") + at("__d", "h_up")
    pred_up = at("__u", "h_down") + at("__u", "h_sideways") + at("__u", "h_up")
    total = act["down"] + act["sideways"] + act["up"]
    out = {"n": total, **{f"act_{c}": v for c, v in act.items()}, "pred_down": pred_down, "pred_up": pred_up, "pred_sideways": total - pred_down - pred_up,
           "tp_down": at("__d", "h_down"), "tp_up": at("__u", "h_up"), "tp_sideways": act["sideways"] - at("__d", "h_sideways") - at("__u", "h_sideways")}
    return rows.select(*keys, "grid_index", "down_threshold", "up_threshold", *[v.alias(k) for k, v in out.items()])


def threshold_counts(predictions: DataFrame, keys: Sequence[str], values: Sequence[float]) -> DataFrame:
    """M10, T5. Class counts of every threshold pair per key."""
    return grid_counts(side_counts(predictions, keys, values), keys, values)


KEYS = ["label_policy", "model", "market_scope", "forecast_horizon"]


def tune_thresholds(predictions: DataFrame, values: Sequence[float], keys: Sequence[str] = KEYS, year: str = "test_year") -> DataFrame:
    """M10. Best threshold pair on the earlier years of each key, for every year with a past.

    Side counts add up over years, so the training counts of a year are running
    sums over the years of a key. Ties go to the first grid point.
    """
    yearly = side_counts(predictions, [*keys, year], values)
    dense = explode_grid(predictions.select(*keys, year).distinct(), _sides(values))
    dense = dense.join(yearly, [*keys, year, "side", "idx"], "left").na.fill(0, SIDE_COLUMNS)
    before = Window.partitionBy(*keys, "side", "idx").orderBy(year).rowsBetween(Window.unboundedPreceding, -1)
    past = dense.select(*keys, year, "side", "idx", *[F.sum(c).over(before).alias(c) for c in SIDE_COLUMNS])
    scored = M.with_class_metrics(grid_counts(past, [*keys, year], values).where(F.col("n") > 0)).withColumn("first", -F.col("grid_index"))
    best = latest_per_key(scored, [*keys, year], ["balanced_accuracy", "macro_f1", "accuracy", "first"])
    return best.select(*keys, year, "down_threshold", "up_threshold", F.col("balanced_accuracy").alias("train_balanced_accuracy"), F.col("n").alias("train_rows"))


def tuned_candidates(predictions: DataFrame, values: Sequence[float]) -> tuple[DataFrame, DataFrame]:
    """M10, T3. (thresholds, candidates); both are small, used several times downstream, and materialised once."""
    thresholds = cut_lineage(tune_thresholds(predictions, values))
    return thresholds, cut_lineage(select_candidates(evaluate_thresholds(predictions, thresholds)))


def evaluate_thresholds(predictions: DataFrame, thresholds: DataFrame, keys: Sequence[str] = KEYS, year: str = "test_year") -> DataFrame:
    """M10, A19. Tuned against argmax decisions on the test years, averaged per key."""
    rows = predictions.join(thresholds, [*keys, year]).withColumn("tuned", L.threshold_label("prob_down", "prob_up", "down_threshold", "up_threshold"))
    rows = rows.withColumn("argmax", L.argmax_label(PROBS))
    group = [*keys, year]
    metrics = ["accuracy", "balanced_accuracy", "macro_f1"]
    sides = [M.classification_scorecard(rows, group, "actual_label", d).select(*group, *[F.col(m).alias(f"{d}_{m}") for m in metrics]) for d in ("tuned", "argmax")]
    both = sides[0].join(sides[1], group)
    out = both.groupBy(*keys).agg(F.count(F.lit(1)).alias("years"), *[F.avg(f"{d}_{m}").alias(f"{d}_{m}_avg") for d in ("tuned", "argmax") for m in metrics])
    return out.withColumn("balanced_accuracy_lift_vs_argmax", F.col("tuned_balanced_accuracy_avg") - F.col("argmax_balanced_accuracy_avg"))


def select_candidates(scorecard: DataFrame) -> DataFrame:
    """T3. Best tuned, best argmax and selected model per (scope, horizon)."""
    group = ["market_scope", "forecast_horizon"]

    def best(side: str, method: str, kind: str) -> DataFrame:
        order = [F.desc(F.round(f"{side}_{m}_avg", 10)) for m in ("balanced_accuracy", "macro_f1", "accuracy")]
        rows = pick_first(scorecard, group, [*order, F.asc("label_policy"), F.asc("model")])
        return rows.select(*group, F.lit(kind).alias("candidate_type"), F.lit(method).alias("decision_method"), "label_policy", "model",
                           F.col(f"{side}_balanced_accuracy_avg").alias("selection_balanced_accuracy"), "balanced_accuracy_lift_vs_argmax")

    tuned, argmax = best("tuned", "threshold", "threshold_best"), best("argmax", "argmax", "argmax_best")
    lifted = tuned.select(*group, (F.col("balanced_accuracy_lift_vs_argmax") > 0).alias("__lift"))
    chosen = tuned.unionByName(argmax).join(lifted, group).where(F.col("__lift") == (F.col("decision_method") == "threshold")).drop("__lift")
    return tuned.unionByName(argmax).unionByName(chosen.withColumn("candidate_type", F.lit("selected")))


def candidate_predictions(predictions: DataFrame, candidates: DataFrame, thresholds: DataFrame) -> DataFrame:
    """J23. Predictions of every candidate with its decision and confidence."""
    rows = predictions.join(candidates, KEYS)
    decided = decide(rows, thresholds.select(*KEYS, "test_year", "down_threshold", "up_threshold"), [*KEYS, "test_year"])
    return decided.withColumn("predicted_direction", F.when(F.col("decision_method") == "argmax", L.argmax_label(PROBS)).otherwise(F.col("predicted_direction")))


TRADE_KEYS = ["candidate_type", *KEYS, "rule_name", "confidence_floor"]


def apply_rules(rows: DataFrame, profiles: Mapping[str, Mapping[str, float]], floors: Sequence[float]) -> DataFrame:
    """P26, J24. Every rule of the grid on every candidate row."""
    grid = [{"rule_name": name, "confidence_floor": float(f), **{f"w_{k}": float(v) for k, v in profile.items()}} for name, profile in profiles.items() for f in floors]
    df = explode_grid(rows, grid)
    low = F.col("confidence") < F.col("confidence_floor")
    base = F.when(F.col("predicted_direction") == "up", F.col("w_up")).when(F.col("predicted_direction") == "down", F.col("w_down")).otherwise(F.col("w_sideways"))
    return df.withColumns({"exposure": F.when(low, F.col("w_fallback")).otherwise(base), "low_confidence": low.cast("double")}).drop("w_up", "w_down", "w_sideways", "w_fallback")


def run_backtest(ruled: DataFrame, returns: DataFrame, cost_bps: float = 5.0, keys: Sequence[str] = TRADE_KEYS) -> tuple[DataFrame, DataFrame]:
    """K21, A21, A22. (trades, scorecard). ``returns``: asof_date, market_scope, next_return."""
    data = ruled.join(returns.where(F.col("next_return").isNotNull()), ["asof_date", "market_scope"])
    trades = W.with_strategy(data, Axis.of(list(keys), "asof_date"), "exposure", "next_return", cost_bps)
    card = M.strategy_metrics(trades.withColumn("direction", F.col("predicted_direction")), keys)
    low = trades.groupBy(*keys).agg(F.avg("low_confidence").alias("low_confidence_ratio"))
    return trades, card.join(low, list(keys))


def best_rules(scorecard: DataFrame, tolerance: float) -> DataFrame:
    """T4. Per (scope, horizon): near-best Sharpe, then fewest low-confidence days."""
    order = [F.asc("low_confidence_ratio"), F.desc(F.round("sharpe", 8)), F.desc(F.round("mdd", 8)), F.desc(F.round("cumulative_return", 8)), *[F.asc(k) for k in TRADE_KEYS]]
    return near_best(scorecard.where(F.col("sharpe").isNotNull()), ["market_scope", "forecast_horizon"], "sharpe", tolerance, order)
