"""Walk-forward folds as data and the closed-form ridge.

Training totals of a fold are running totals over blocks, so every training row
is read once however many folds follow it.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions import labels as L
from tidemark.functions.numeric import as_col, clip, ratio
from tidemark.operators.expanding import block_moments, expanding_medians
from tidemark.operators.windows import Axis
from tidemark.session import cut_lineage


def expanding_totals(df: DataFrame, keys: Sequence[str], fold: str, totals: dict[str, Column], embargo: int = 0) -> DataFrame:
    """J21. For each (key, fold) the totals over all rows of earlier folds.

    The range join ``train.fold < test.fold`` becomes one aggregation per fold and
    a running sum over the few folds of a key.
    """
    per = df.groupBy(*keys, fold).agg(*[c.alias(n) for n, c in totals.items()])
    before = Window.partitionBy(*keys).orderBy(fold).rowsBetween(Window.unboundedPreceding, -1 - embargo)
    return per.select(*keys, fold, *[F.sum(n).over(before).alias(n) for n in totals])


# -- ridge ---------------------------------------------------------------------------------


def training_blocks(df: DataFrame, keys: Sequence[str], order: str, target: str, min_rows: int, refit: int, embargo_rows: int) -> DataFrame:
    """Fold of every row and the block from which a labelled row enters training.

    A row uses the labelled rows at least ``embargo_rows`` + 1 rows before it; its
    fold changes every ``refit`` of them once ``min_rows`` are there.
    """
    ax = Axis.of(list(keys), order)
    known = ax.by.rowsBetween(Window.unboundedPreceding, -1 - embargo_rows)
    count = F.count(target).over(known)
    label_no = F.count(target).over(ax.so_far)
    df = df.withColumns({"training_sample_count": count, "__no": label_no})
    fold = F.when(F.col("training_sample_count") >= min_rows, F.floor((F.col("training_sample_count") - min_rows) / refit).cast("int"))
    block = F.when(F.col(target).isNotNull(), F.greatest(F.ceil((F.col("__no") - min_rows) / refit), F.lit(0)).cast("int"))
    return df.withColumns({"__fold": fold, "__block": block}).drop("__no")


def spread(df: DataFrame, *cols: str) -> DataFrame:
    """Small frame with heavy work per row over several tasks (adaptive coalescing would leave one)."""
    return df.repartition(min(df.sparkSession.sparkContext.defaultParallelism, 200), *cols)


def _fold_grams(rows: DataFrame, keys: Sequence[str], features: Sequence[str], target: str) -> DataFrame:
    """Upper triangle of the moment matrix of [values, null marks, 1, target] per fold: sums of blocks, added up over the blocks of a key."""
    cells = [*[F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features], *[F.col(f).isNull().cast("double") for f in features], F.lit(1.0), F.col(target).cast("double")]
    blocks = block_moments(rows, keys, "__block", cells)
    upto = Window.partitionBy(*keys, "pair").orderBy("__block").rowsBetween(Window.unboundedPreceding, 0)
    total = blocks.withColumn("s", F.sum("s").over(upto))
    return total.groupBy(*keys, F.col("__block").alias("__fold")).agg(F.array_sort(F.collect_list(F.struct("pair", "s"))).alias("__g")).select(
        *keys, "__fold", F.transform("__g", lambda x: x["s"]).alias("gram"))


def _fold_medians(rows: DataFrame, keys: Sequence[str], features: Sequence[str]) -> DataFrame:
    """Exact medians of the training rows of each fold; 0 for a feature without values."""
    folds = rows.where(F.col("__fold").isNotNull()).select(*keys, "__fold").distinct()
    mids = expanding_medians(rows, keys, "__block", folds, "__fold", features)
    return mids.withColumn("medians", F.transform("medians", lambda x: F.coalesce(x, F.lit(0.0))))


def _solver(k: int, alpha: float, l1: float = 0.0, l2: float = 0.0, sweeps: int = 500):
    """Coefficients of one fold from its moments; a row is a (2k+2)-wide triangle.

    ``alpha`` is the ridge penalty on standardised columns. With ``l1`` or ``l2``
    the elastic net (1/2n)|y - Xb|^2 + l1 |b|_1 + l2/2 |b|^2 is solved instead, by
    coordinate steps on the same moments.
    """
    import numpy as np

    def shrunk(a, b, n):
        beta = np.zeros(k)
        for _ in range(sweeps):
            before = beta.copy()
            for j in range(k):
                rho = (b[j] - a[j] @ beta + a[j, j] * beta[j]) / n
                scale = a[j, j] / n + l2
                beta[j] = np.sign(rho) * max(abs(rho) - l1, 0.0) / scale if scale > 0 else 0.0
            if np.max(np.abs(beta - before), initial=0.0) < 1e-12:
                break
        return beta

    @F.pandas_udf("struct<intercept:double,weights:array<double>,target_mean:double,target_std:double,coefficient_norm:double>")
    def solve(gram: pd.Series, medians: pd.Series) -> pd.DataFrame:
        p = 2 * k + 2
        upper = np.triu_indices(p)
        out = []
        for g, m in zip(gram, medians):
            s = np.zeros((p, p))
            s[upper] = np.asarray(g, dtype=float)
            s = s + np.triu(s, 1).T
            t = np.zeros((k + 2, p))
            t[:k, :k] = np.eye(k)
            t[:k, k:2 * k] = np.diag(np.asarray(m, dtype=float))
            t[k, 2 * k] = t[k + 1, 2 * k + 1] = 1.0
            f = t @ s @ t.T
            n = f[k, k]
            mean, ybar = f[:k, k] / n, f[k, k + 1] / n
            var = np.diag(f)[:k] / n - mean ** 2
            std = np.sqrt(np.where(var > 1e-12 * np.maximum(1.0, mean ** 2), var, 0.0))
            std = np.where(std == 0.0, 1.0, std)
            a = (f[:k, :k] - n * np.outer(mean, mean)) / np.outer(std, std)
            b = (f[:k, k + 1] - n * mean * ybar) / std
            beta = shrunk(a, b, n) if l1 or l2 else np.linalg.pinv(a + alpha * np.eye(k)) @ b
            spread = max(f[k + 1, k + 1] / n - ybar ** 2, 0.0) ** 0.5
            w = beta / std
            out.append((ybar - w @ mean, w.tolist(), ybar, spread or 1.0, float(np.linalg.norm(beta))))
        return pd.DataFrame(out, columns=["intercept", "weights", "target_mean", "target_std", "coefficient_norm"])

    return solve


def walk_forward_ridge(df: DataFrame, keys: Sequence[str], order: str, features: Sequence[str], target: str, min_rows: int = 252, refit: int = 20,
                       alpha: float = 1.0, embargo_rows: int = 0, l1: float = 0.0, l2: float = 0.0) -> DataFrame:
    """M1, M2, M4. Walk-forward ridge predictions with score, label and confidence.

    Folds are data: moments per refit block are summed once and accumulated, a
    fold's system is solved from its k x k moments, and predictions are a join
    and a dot product. ``embargo_rows`` (set it to the horizon) keeps labels whose
    end lies after the prediction day out of training; 0 uses every earlier row.
    """
    rows = df.withColumns({f: F.when(~F.isnan(F.col(f).cast("double")), F.col(f).cast("double")) for f in features})
    # Moments, medians and predictions all read the dataset: it is computed once.
    rows = cut_lineage(training_blocks(rows, keys, order, target, min_rows, refit, embargo_rows))
    folds = _fold_grams(rows, keys, features, target).join(_fold_medians(rows, keys, features), [*keys, "__fold"])
    models = folds.withColumn("__m", _solver(len(features), alpha, l1, l2)("gram", "medians")).select(*keys, "__fold", "medians", "__m.*")
    out = rows.join(models, [*keys, "__fold"], "left")
    filled = F.array(*[F.coalesce(F.col(f), F.get("medians", F.lit(i))) for i, f in enumerate(features)])
    dot = F.aggregate(F.zip_with(filled, "weights", lambda x, w: x * w), F.lit(0.0), lambda a, x: a + x)
    out = out.withColumn("__pred", F.col("intercept") + dot)
    return calibrated(out, "__pred", "target_mean", "target_std", "training_sample_count", features).drop(
        "__pred", "__fold", "__block", "intercept", "weights", "medians", "target_mean", "target_std")


def calibrated(df: DataFrame, pred: str, mean: str, std: str, count: str, features: Sequence[str]) -> DataFrame:
    """M2. Score of a prediction against its training targets, label, and confidence from sample size, completeness and strength."""
    df = df.withColumn("__score", clip(ratio(F.col(pred) - F.col(mean), std)))
    missing = [as_col(f).isNull().cast("int") for f in features]
    complete = 1.0 - sum(missing[1:], missing[0]) / len(features)
    sample = F.least(F.lit(1.0), F.sqrt(F.col(count) / 1000.0))
    signal = F.least(F.lit(1.0), F.abs(F.coalesce("__score", F.lit(0.0))) / 1.5)
    confidence = F.when(F.col(pred).isNull(), 0.0).otherwise(F.round(clip(0.45 * sample + 0.35 * complete + 0.20 * signal, 0, 1), 4))
    return df.withColumns({"predicted_forward_return": F.round(pred, 8), "calibrated_forecast_score": F.round("__score", 6),
                           "calibrated_forecast_label": L.calibrated("__score"), "calibration_confidence_score": confidence}).drop("__score")


# Candidate regressors (elastic net 0.0008 with l1 share 0.15, ridge 3); the boosted one has its own in ``boosting``.
CANDIDATES = {"ridge": {"alpha": 3.0}, "elasticnet": {"l1": 0.0008 * 0.15, "l2": 0.0008 * 0.85}, "boosted": {}}


def fold_rows(df: DataFrame, keys: Sequence[str], order: str, target: str, min_rows: int = 756, refit: int = 20, embargo_rows: int = 0) -> DataFrame:
    """M4. What each fold trains on and predicts: training rows, newest training row, predicted rows, first and last of them."""
    rows = training_blocks(df, keys, order, target, min_rows, refit, embargo_rows)
    tests = rows.where(F.col("__fold").isNotNull()).groupBy(*keys, F.col("__fold").alias("fold")).agg(F.count(F.lit(1)).alias("n_predicted"), F.min(order).alias("first_predicted"), F.max(order).alias("last_predicted"))
    blocks = rows.where(F.col("__block").isNotNull()).groupBy(*keys, F.col("__block").alias("fold")).agg(F.count(F.lit(1)).alias("__n"), F.max(order).alias("__last"))
    upto = Window.partitionBy(*keys).orderBy("fold").rowsBetween(Window.unboundedPreceding, 0)
    trained = blocks.select(*keys, "fold", F.sum("__n").over(upto).alias("n_train"), F.max("__last").over(upto).alias("last_train"))
    return tests.join(trained, [*keys, "fold"])


def walk_forward_candidates(df: DataFrame, keys: Sequence[str], order: str, features: Sequence[str], target: str, candidates: dict[str, dict] | None = None,
                            min_rows: int = 756, refit: int = 20, embargo_rows: int = 0) -> DataFrame:
    """M4. Predictions of every candidate in long form (model, keys, order, prediction, target)."""
    from tidemark.plans.boosting import Boosting, walk_forward_boosted

    frames = []
    for name, options in (candidates or CANDIDATES).items():
        if name == "boosted":
            clean = df.withColumns({f: F.when(~F.isnan(F.col(f).cast("double")), F.col(f).cast("double")) for f in features})
            rows = cut_lineage(training_blocks(clean, keys, order, target, min_rows, refit, embargo_rows))
            made = walk_forward_boosted(rows, keys, order, features, target, Boosting(**options))
            frames.append(rows.join(made, [*keys, order], "left").select(*keys, order, F.lit(name).alias("model"), target, "prediction"))
            continue
        p = walk_forward_ridge(df, keys, order, features, target, min_rows, refit, embargo_rows=embargo_rows, **options)
        frames.append(p.select(*keys, order, F.lit(name).alias("model"), target, F.col("predicted_forward_return").alias("prediction")))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
