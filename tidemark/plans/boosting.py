"""Boosted regression trees of many walk-forward folds (M4).

A fold is a row: the packed rows of the blocks it trains on, and the rows it
predicts. Rows are packed once a block of ``refit`` labels, so what a fold
gathers is one entry a block; training sets of daily rows are bounded by the
calendar. Folds are fitted side by side, in one job whatever their number, and
a fit holds one fold: histograms of gradients over binned features, the leaf
with the greatest gain split next.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.operators.expanding import expanding_medians


@dataclass(frozen=True)
class Boosting:
    """Trees, shrinkage, leaves a tree, penalty on leaf values, least rows of a leaf, most bins of a feature."""

    # Settings of the candidate model.
    rounds: int = 90
    rate: float = 0.035
    leaves: int = 11
    l2: float = 0.15
    min_leaf: int = 20
    bins: int = 255


def bin_edges(column: np.ndarray, bins: int) -> np.ndarray:
    """Upper edges of all bins but the last: between neighbouring values, or at quantiles where there are too many of them."""
    values = np.unique(column)
    if len(values) <= bins:
        return (values[:-1] + values[1:]) / 2
    return np.unique(np.percentile(column, np.linspace(0, 100, bins + 1)[1:-1], method="midpoint"))


def _best_split(hist: np.ndarray, p: Boosting) -> tuple[float, int, int]:
    """(gain, feature, bin) of the best split by a histogram (2 x features x bins: gradient sums and rows); the first of equals."""
    left = np.cumsum(hist, axis=2)[:, :, :-1]
    total = hist[:, :1].sum(2, keepdims=True)
    right = total - left
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = left[0] ** 2 / (left[1] + p.l2) + right[0] ** 2 / (right[1] + p.l2) - total[0] ** 2 / (total[1] + p.l2)
    gain = np.where((left[1] >= p.min_leaf) & (right[1] >= p.min_leaf), gain, -np.inf)
    if not gain.size:
        return -np.inf, 0, 0
    at = int(np.argmax(gain))
    return float(gain.flat[at]), at // gain.shape[1], at % gain.shape[1]


def boosted_predictions(x: np.ndarray, y: np.ndarray, test: np.ndarray, p: Boosting = Boosting()) -> np.ndarray:
    """Fit on rows ``x`` and ``y`` without missing values and predict ``test``."""
    n, k = x.shape
    edges = [bin_edges(x[:, f], p.bins) for f in range(k)]
    width = max((len(e) for e in edges), default=0) + 1
    code = np.stack([np.searchsorted(edges[f], x[:, f]) for f in range(k)], 1)
    code_test = np.stack([np.searchsorted(edges[f], test[:, f]) for f in range(k)], 1)
    flat = code + np.arange(k) * width
    fitted, out = np.full(n, y.mean()), np.full(len(test), y.mean())

    def histogram(rows, g):
        cells, size = flat[rows].ravel(), k * width
        return np.stack([np.bincount(cells, np.repeat(g[rows], k), size), np.bincount(cells, minlength=size).astype(float)]).reshape(2, k, width)

    for _ in range(p.rounds):
        g = fitted - y
        hist = histogram(np.arange(n), g)
        # A leaf: its split, histogram, rows, and the rows of the test set that fall into it.
        leaves = [(_best_split(hist, p), hist, np.arange(n), np.arange(len(test)))]
        while len(leaves) < p.leaves:
            at = max(range(len(leaves)), key=lambda i: leaves[i][0][0])
            (gain, f, b), hist, rows, seen = leaves[at]
            if not gain > 0:
                break
            goes = code[rows, f] <= b
            parts = [rows[goes], rows[~goes]]
            small = int(len(parts[1]) < len(parts[0]))
            hists = [None, None]
            hists[small] = histogram(parts[small], g)
            hists[1 - small] = hist - hists[small]
            goes = code_test[seen, f] <= b
            tests = [seen[goes], seen[~goes]]
            leaves[at:at + 1] = [(_best_split(h, p), h, r, s) for h, r, s in zip(hists, parts, tests, strict=True)]
        if len(leaves) == 1:
            break
        for _, _, rows, seen in leaves:
            value = -p.rate * g[rows].sum() / (len(rows) + p.l2)
            fitted[rows] += value
            out[seen] += value
    return out


def walk_forward_boosted(rows: DataFrame, keys: Sequence[str], order: str, features: Sequence[str], target: str, settings: Boosting = Boosting()) -> DataFrame:
    """(keys, order, prediction) of every row with a fold, by trees fitted on the labelled rows of the blocks up to the fold's.

    ``rows`` has ``__fold`` and ``__block`` of ``training_blocks``. Missing values get the median of the fold's training rows.
    """
    keys, k = list(keys), len(features)
    x = F.array(*[F.coalesce(F.col(f).cast("double"), F.lit(float("nan"))) for f in features])
    packs = rows.where(F.col("__block").isNotNull()).groupBy(*keys, "__block").agg(F.sort_array(F.collect_list(F.struct(F.col(order).alias("at"), x.alias("x"), F.col(target).cast("double").alias("y")))).alias("p"))
    packs = packs.select(*keys, "__block", F.flatten(F.transform("p", lambda r: r["x"])).alias("x"), F.transform("p", lambda r: r["y"]).alias("y"))
    asked = rows.where(F.col("__fold").isNotNull()).groupBy(*keys, "__fold").agg(F.sort_array(F.collect_list(F.struct(F.col(order).alias("at"), x.alias("x")))).alias("p"))
    asked = asked.select(*keys, "__fold", F.transform("p", lambda r: r["at"]).alias("at"), F.flatten(F.transform("p", lambda r: r["x"])).alias("test"))
    last = asked.groupBy(*keys).agg(F.max("__fold").alias("__last"))
    reached = packs.join(last, keys).where("__block <= __last").withColumn("__fold", F.explode(F.sequence("__block", "__last")))
    train = reached.groupBy(*keys, "__fold").agg(F.sort_array(F.collect_list(F.struct("__block", "x", "y"))).alias("p"))
    folds = asked.select(*keys, "__fold")
    medians = expanding_medians(rows, keys, "__block", folds, "__fold", features)
    fits = asked.join(train, [*keys, "__fold"]).join(medians, [*keys, "__fold"])
    n = max(1, folds.count())
    fits = fits.select(*keys, "__fold", "at", "test", F.flatten(F.transform("p", lambda b: b["x"])).alias("x"), F.flatten(F.transform("p", lambda b: b["y"])).alias("y"), "medians")
    # By number: a row is a fit, so bytes say nothing about the work.
    fits = fits.repartition(min(n, 8 * rows.sparkSession.sparkContext.defaultParallelism), *keys, "__fold")
    schema = rows.select(*keys, order, F.lit(0.0).alias("prediction")).schema
    arrow = to_arrow_schema(schema)

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1)
                value = {c: row.column(c)[0] for c in row.schema.names}
                mids = np.array([m or 0.0 for m in value["medians"].as_py()])
                own, test = (np.asarray(value[c].values.to_numpy(zero_copy_only=False), float).reshape(-1, k) for c in ("x", "test"))
                own, test = (np.where(np.isnan(v), mids, v) for v in (own, test))
                got = boosted_predictions(own, np.asarray(value["y"].values.to_numpy(zero_copy_only=False), float), test, settings)
                days = value["at"].values
                yield pa.RecordBatch.from_arrays([*[pa.array([value[c].as_py()] * len(got), arrow.field(c).type) for c in keys], days.cast(arrow.field(order).type), pa.array(got)], schema=arrow)

    return fits.mapInArrow(run, schema)
