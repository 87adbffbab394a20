"""Ensembles and walk-forward direction models."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.labels import CLASSES
from tidemark.functions.numeric import any_present, ratio
from tidemark.operators import metrics as M
from tidemark.operators import relational as R
from tidemark.operators import windows as W
from tidemark.operators.relational import pick_first
from tidemark.operators.windows import Axis
from tidemark.plans import foldmodels as FM
from tidemark.plans.backtest import PROBS
from tidemark.session import cut_lineage
from tidemark.sources.tables import unite


def ensemble_mean(predictions: DataFrame, keys: Sequence[str], min_members: int = 2) -> DataFrame:
    """A27. Mean member probabilities where enough members predicted."""
    out = predictions.groupBy(*keys).agg(F.count(F.lit(1)).alias("members"), *[F.avg(c).alias(c) for c in PROBS.values()],
                                         F.min("actual_label").alias("actual_label"))
    return out.where(F.col("members") >= min_members)


def weighted_ensemble(predictions: DataFrame, predicted: str, keys: Sequence[str] = ("market_scope", "forecast_horizon"),
                      top: int | None = None, min_members: int = 2) -> DataFrame:
    """A28. Members weighted by their mean balanced accuracy over earlier years."""
    member = ["model", *keys]
    yearly = M.classification_scorecard(predictions, [*member, "test_year"], "actual_label", predicted)
    before = Window.partitionBy(*member).orderBy("test_year").rowsBetween(Window.unboundedPreceding, -1)
    weights = yearly.select(*member, "test_year", F.avg("balanced_accuracy").over(before).alias("w")).where(F.col("w").isNotNull())
    if top is not None:
        place = F.row_number().over(Window.partitionBy(*keys, "test_year").orderBy(F.desc("w"), "model"))
        weights = weights.withColumn("__place", place).where(F.col("__place") <= top).drop("__place")
    rows = predictions.join(weights, [*member, "test_year"])
    out = rows.groupBy(*keys, "asof_date").agg(
        F.count(F.lit(1)).alias("members"), F.min("actual_label").alias("actual_label"),
        *[ratio(F.sum(F.col(c) * F.col("w")), F.sum("w")).alias(c) for c in PROBS.values()])
    return out.where(F.col("members") >= min_members)


def confidence_stats(predictions: DataFrame, keys: Sequence[str], floor: float) -> DataFrame:
    """A36. Mean, median, margin between the two best classes, share under the floor."""
    ordered = F.sort_array(F.array(*PROBS.values()), asc=False)
    return predictions.withColumn("__margin", ordered[0] - ordered[1]).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.avg("confidence").alias("mean_confidence"), F.median("confidence").alias("median_confidence"),
        F.avg("__margin").alias("mean_margin"), M.share(F.col("confidence") < floor).alias("low_confidence_ratio"))


# -- regression gates -------------------------------------------------------------------------


def best_model(metrics: DataFrame, keys: Sequence[str] = ("market_scope", "forecast_horizon")) -> DataFrame:
    """T6. Model with the best (correlation, hit rate) per key; nulls lose."""
    return pick_first(metrics, keys, [F.desc_nulls_last(F.round("corr", 10)), F.desc_nulls_last(F.round("directional_hit", 10)), F.asc("model")])


def promotion_gate(metrics: DataFrame, min_corr: float = 0.15, min_hit: float = 0.55, horizon: str = "20d", needed: int = 2) -> DataFrame:
    """M5. Promotion status from the metrics of one horizon (v1 uses 0.10 and 0.53)."""
    passed = F.count_if((F.col("forecast_horizon") == horizon) & (F.col("corr") >= min_corr) & (F.col("directional_hit") >= min_hit))
    return metrics.agg(passed.alias("passed")).withColumn("status", F.when(F.col("passed") >= needed, "promote_candidate").otherwise("research_only"))


def compare_models(rows: DataFrame, first: str, second: str, real: str, keys: Sequence[str] = ("market_scope", "forecast_horizon")) -> DataFrame:
    """M14. Metric differences of two models on their common rows."""
    both = rows.where(F.col(first).isNotNull() & F.col(second).isNotNull() & F.col(real).isNotNull())
    hit = lambda p: F.avg(((F.col(p) > 0) == (F.col(real) > 0)).cast("double"))
    mae = lambda p: F.avg(F.abs(F.col(p) - F.col(real)))
    out = both.groupBy(*keys).agg(F.count(F.lit(1)).alias("overlap_rows"), M.safe_corr(first, real, 2).alias("first_corr"), M.safe_corr(second, real, 2).alias("second_corr"),
                                  hit(first).alias("first_hit"), hit(second).alias("second_hit"), mae(first).alias("first_mae"), mae(second).alias("second_mae"))
    return out.withColumns({f"{m}_diff": F.col(f"first_{m}") - F.col(f"second_{m}") for m in ("corr", "hit", "mae")})


def comparison_decision(comparison: DataFrame, horizon: str = "20d", needed: int = 2) -> DataFrame:
    """M14. Majority decision on one horizon."""
    focus = comparison.where(F.col("forecast_horizon") == horizon)
    out = focus.agg(F.count_if(F.col("corr_diff") > 0).alias("corr_wins"), F.count_if(F.col("hit_diff") > 0).alias("hit_wins"),
                    F.count_if(F.col("mae_diff") < 0).alias("mae_wins"), F.count(F.lit(1)).alias("total"))
    won = (F.col("corr_wins") >= needed) & (F.col("hit_wins") >= needed)
    return out.withColumn("decision", F.when(won, "promote_candidate").otherwise("keep_primary"))


# -- preprocessing and classifiers -----------------------------------------------------------------


def holdout_split(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """M16. Chronological holdout: the last fifth, at most 500 and at least 50 rows per group."""
    ax = Axis.of(list(keys), order)
    n = F.count(F.lit(1)).over(ax.whole)
    cut = F.least(F.greatest(F.floor(n * 0.8), n - 500), n - 50)
    return df.withColumn("is_train", W.row_index(ax) <= cut)


def capped_category(df: DataFrame, column: str, out: str, limit: int = 24) -> DataFrame:
    """M6. The most frequent categories keep their name, the rest become one."""
    top = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("__n")).orderBy(F.desc("__n"), column).limit(limit)
    named = top.select(column, F.col(column).alias(out))
    other = F.when(F.col(column).isNotNull(), "infrequent")
    return df.join(named, column, "left").withColumn(out, F.coalesce(out, other))


def preprocessing_stages(numeric: Sequence[str], categorical: Sequence[str] = (), out: str = "features") -> list:
    """M6. Median imputation and scaling of numbers, one-hot of (capped) categories."""
    from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler

    filled = [f"__f_{c}" for c in numeric]
    stages = [Imputer(strategy="median", inputCols=list(numeric), outputCols=filled), VectorAssembler(inputCols=filled, outputCol="__num"),
              StandardScaler(inputCol="__num", outputCol="__scaled", withMean=True, withStd=True)]
    parts = ["__scaled"]
    if categorical:
        indexed, hot = [f"__i_{c}" for c in categorical], [f"__h_{c}" for c in categorical]
        stages += [StringIndexer(inputCols=list(categorical), outputCols=indexed, handleInvalid="keep"), OneHotEncoder(inputCols=indexed, outputCols=hot, dropLast=False)]
        parts += hot
    return [*stages, VectorAssembler(inputCols=parts, outputCol=out)]


def classifier(kind: str, seed: int = 42):
    """M7. Direction classifiers of trees on balanced row weights; the logistic one is ``walk_forward_logistic``."""
    from pyspark.ml.classification import GBTClassifier, OneVsRest, RandomForestClassifier

    if kind == "random_forest":
        return RandomForestClassifier(numTrees=60, maxDepth=6, minInstancesPerNode=20, seed=seed, featuresCol="features", labelCol="__y", weightCol="__w")
    if kind == "boosted":
        return OneVsRest(classifier=GBTClassifier(maxIter=20, maxDepth=4, stepSize=0.06, seed=seed, featuresCol="features", labelCol="__y"), featuresCol="features", labelCol="__y", weightCol="__w")
    raise ValueError(f"unknown classifier {kind}")


def with_class_index(df: DataFrame, label: str) -> DataFrame:
    place = F.array_position(F.array(*[F.lit(c) for c in CLASSES]), F.col(label))
    return df.withColumn("__y", (place - 1).cast("double"))


def with_balanced_weights(df: DataFrame) -> DataFrame:
    """Row weight n / (classes x class count), from one three-row aggregate."""
    per = df.groupBy("__y").agg(F.count(F.lit(1)).alias("__c"))
    total, kinds = per.agg(F.sum("__c")).scalar(), per.agg(F.count(F.lit(1))).scalar()
    return df.join(F.broadcast(per), "__y").withColumn("__w", total / (kinds * F.col("__c"))).drop("__c")


def usable_features(df: DataFrame, features: Sequence[str], min_present: int = 30) -> list[str]:
    """P22. Features with enough values and more than one distinct value (one aggregate, few rows)."""
    rows = M.feature_usability(df, [], features).where((F.col("present") >= min_present) & F.col("varies")).collect()
    found = {r["feature"] for r in rows}
    return [f for f in features if f in found]


def feature_cap(df: DataFrame, features: Sequence[str], min_share: float = 0.03, limit: int = 64) -> DataFrame:
    """P23. First ``limit`` features, in curated order, that are present often enough and vary."""
    place = F.array_position(F.array(*[F.lit(f) for f in features]), F.col("feature"))
    rows = M.feature_usability(df, [], features).where((F.col("present") >= F.col("rows") * min_share) & F.col("varies"))
    return rows.withColumn("place", place).orderBy("place").limit(limit)


def fit_direction(train: DataFrame, features: Sequence[str], label: str, kind: str):
    """M7. Fitted pipeline for one training frame."""
    from pyspark.ml import Pipeline

    usable = usable_features(train, features)
    rows = with_balanced_weights(with_class_index(train, label))
    return Pipeline(stages=[*preprocessing_stages(usable), classifier(kind)]).fit(rows), usable


def class_probabilities(model, df: DataFrame, kind: str) -> DataFrame:
    """Probability columns in the fixed class order; the one-vs-rest margins are squashed and normalised."""
    from pyspark.ml.functions import vector_to_array

    scored = model.transform(df)
    if kind == "boosted":
        raw = F.transform(vector_to_array("rawPrediction"), lambda x: 1.0 / (1.0 + F.exp(-2.0 * x)))
        total = F.aggregate(raw, F.lit(0.0), lambda a, x: a + x)
        p = F.transform(raw, lambda x: x / total)
    else:
        p = vector_to_array("probability")
    return scored.select(*df.columns, *[F.get(p, F.lit(i)).alias(f"prob_{c}") for i, c in enumerate(CLASSES)])


def direction_folds(df: DataFrame, keys: Sequence[str], year: str, label: str, first_year: int, min_train: int, min_test: int) -> list[dict]:
    """J21, M7. Keys and test years with enough training and test rows (a few rows on the driver)."""
    per = df.groupBy(*keys, year).agg(F.count(label).alias("n"), F.collect_set(label).alias("seen"))
    before = Window.partitionBy(*keys).orderBy(year).rowsBetween(Window.unboundedPreceding, -1)
    folds = per.select(*keys, year, "n", F.sum("n").over(before).alias("past"), F.size(F.array_distinct(F.flatten(F.collect_list("seen").over(before)))).alias("kinds"))
    wanted = folds.where((F.col(year) >= first_year) & (F.col("past") >= min_train) & (F.col("n") >= min_test) & (F.col("kinds") == len(CLASSES)))
    return [r.asDict() for r in wanted.orderBy(*keys, year).collect()]


def in_parallel(jobs: Sequence, run, width: int = 4) -> list:
    """Independent fits submitted together, as a cross-validator does."""
    from multiprocessing.pool import ThreadPool

    from pyspark import inheritable_thread_target

    if not jobs:
        return []
    pool = ThreadPool(min(width, len(jobs)))
    try:
        return pool.map(inheritable_thread_target(run), jobs)
    finally:
        pool.close()


def _no_predictions(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """Empty prediction frame for data too short for any fold."""
    none = F.lit(None).cast("double")
    return df.where(F.lit(False)).select(*columns, F.col(label).alias("actual_label"), *[none.alias(p) for p in PROBS.values()])


def walk_forward_direction(df: DataFrame, keys: Sequence[str], order: str, features: Sequence[str], label: str, kind: str, first_year: int = 2022, min_train: int = 400,
                           min_test: int = 30) -> tuple[DataFrame, list[tuple[dict, object, list[str]]]]:
    """M7. Yearly walk-forward class probabilities per key; returns predictions and the fitted models.

    The dataset has one row per day and key and is materialised once for all fits.
    """
    data = cut_lineage(df.where(F.col(label).isNotNull()).withColumn("test_year", F.year(order)))
    folds = direction_folds(data, keys, "test_year", label, first_year, min_train, min_test)

    def scoped(fold):
        rows = data
        for k in keys:
            rows = rows.where(F.col(k) == fold[k])
        return rows

    def run(fold):
        rows = scoped(fold)
        train, test = rows.where(F.col("test_year") < fold["test_year"]), rows.where(F.col("test_year") == fold["test_year"])
        model, usable = fit_direction(train, features, label, kind)
        scored = class_probabilities(model, test, kind)
        return fold, model, usable, scored.select(*keys, order, "test_year", F.col(label).alias("actual_label"), *PROBS.values())

    done = in_parallel(folds, run)
    frames = [d[3] for d in done] or [_no_predictions(data, [*keys, order, "test_year"], label)]
    return unite(frames).withColumn("model", F.lit(kind)), [(d[0], d[1], d[2]) for d in done]


def prob_names(classes: Sequence[str]) -> list[str]:
    return [f"prob_{c}" for c in classes]


def walk_forward_logistic(df: DataFrame, keys: Sequence[str], order: str, features: Sequence[str], label: str, first_year: int = 2022, min_train: int = 400, min_test: int = 30,
                          classes: Sequence[str] = CLASSES, parts: int = 0) -> tuple[DataFrame, DataFrame]:
    """M7, M8, M9. Yearly walk-forward logistic probabilities per key, and the folds' coefficients by class and feature.

    All folds of all keys are fitted together. With ``parts`` the probabilities are calibrated: growing heads of a year's
    training rows are fitted, a sigmoid per class is put through each head's scores of the run that follows, and a test
    row has the mean of the heads' calibrated probabilities.
    """
    data = df.where(F.col(label).isNotNull()).withColumn("test_year", F.year(order))
    folds = FM.prefix_folds(data, keys, order, features, label, classes, FM.year_cuts(keys, "test_year", first_year, min_train, min_test, parts))
    fitted, names = FM.fit(folds), prob_names(classes)
    rows = folds.rows.where("__no IS NOT NULL").select(*keys, order, "test_year", F.col(label).alias("actual_label"), *features)
    used = (FM.calibrated(folds, fitted) if parts else fitted.where("lo IS NULL")).withColumn("test_year", F.floor(F.col("fold") / 10).cast("int"))
    out = FM.probabilities(folds, rows.join(used, [*keys, "test_year"]), names, curves=parts > 0)
    if parts:
        out = out.groupBy(*keys, order, "test_year", "actual_label").agg(*[F.avg(n).alias(n) for n in names])
    whole = fitted.where("lo IS NULL").withColumn("fold", F.floor(F.col("fold") / 10).cast("int"))
    coefficients = FM.coefficient_rows(folds, whole).withColumnRenamed("fold", "test_year")
    return out.select(*keys, order, "test_year", "actual_label", *names).withColumn("model", F.lit("logistic")), coefficients


def holdout_direction(df: DataFrame, keys: Sequence[str], order: str, features: Sequence[str], label: str, classes: Sequence[str] = CLASSES, min_rows: int = 200) -> DataFrame:
    """M13, M16. Holdout predictions per key plus the prediction of the newest row (``latest`` = 1); any set of classes."""
    folds = FM.prefix_folds(df, keys, order, features, label, classes, FM.holdout_cuts(keys, min_rows))
    fitted, names = FM.fit(folds), prob_names(classes)
    rows = folds.rows.select(*keys, order, F.col(label).alias("actual_label"), *features, F.col("__no").alias("no"))
    newest = R.latest_per_key(rows, keys, [order]).withColumn("latest", F.lit(1))
    tests = rows.join(fitted.select(*keys, "last"), list(keys)).where(F.col("no") > F.col("last")).drop("last").withColumn("latest", F.lit(0))
    both = tests.unionByName(newest).join(fitted, list(keys))
    return FM.probabilities(folds, both, names).select(*keys, order, "actual_label", *names, "latest")


def holdout_regression(df: DataFrame, keys: Sequence[str], order: str, features: Sequence[str], target: str, categorical: Sequence[str] = ()) -> DataFrame:
    """M3. Boosted-tree regression per key on a chronological 80/20 split; holdout predictions."""
    from pyspark.ml import Pipeline
    from pyspark.ml.regression import GBTRegressor

    from tidemark.plans.model_input import chronological_split

    split = cut_lineage(chronological_split(df.where(F.col(target).isNotNull()), keys, order))
    groups = split.select(*keys).distinct().collect()

    def run(group):
        rows = split.where(functools.reduce(lambda a, b: a & b, [F.col(k) == group[k] for k in keys]))
        train = rows.where("is_train")
        stages = [*preprocessing_stages(usable_features(train, features), categorical), GBTRegressor(featuresCol="features", labelCol=target, maxIter=20, maxDepth=4, stepSize=0.05, seed=42)]
        return Pipeline(stages=stages).fit(train).transform(rows.where("NOT is_train")).select(*keys, order, target, "prediction")

    return unite(in_parallel(groups, run))


def logistic_diagnostics(predictions: DataFrame, coefficient_rows: DataFrame, keys: Sequence[str], worst: int = 200) -> dict[str, DataFrame]:
    """M18. Metrics, importance stability, confusion matrix, error summary and worst errors of one model run."""
    from tidemark.functions import labels as L
    from tidemark.plans.backtest import with_confidence
    from tidemark.plans.research import importance_stability

    rows = with_confidence(predictions.withColumn("predicted", L.argmax_label(PROBS)))
    wrong = rows.where(F.col("actual_label") != F.col("predicted"))
    return {
        "metrics": M.classification_scorecard(rows, [*keys, "test_year"], "actual_label", "predicted"),
        "importance": importance_stability(coefficient_rows, ["class", "feature"], "coefficient"),
        "confusion": M.confusion(rows, keys, "actual_label", "predicted"),
        "errors": wrong.groupBy(*keys, "actual_label", "predicted").agg(F.count(F.lit(1)).alias("n"), F.avg("confidence").alias("mean_confidence")),
        "worst_errors": wrong.orderBy(F.desc("confidence"), *keys, "test_year").limit(worst),
    }
