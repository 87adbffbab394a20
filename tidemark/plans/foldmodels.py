"""Logistic models of many folds at once.

A fold trains on the first ``last`` labelled rows of its key: walk-forward
years, chronological holdouts and the growing heads of time-series folds are
all of that kind. The cut points of a key divide its rows into blocks; counts,
sums and medians of a fold come from its blocks (``operators.expanding``).

Newton steps need every training row once for each fold and step, as each fold
has coefficients of its own. Rows are packed once, a few thousand to a row of
the table; a step joins the packs of a key with the coefficients of its folds
and adds up gradients and Hessians where the packs are. What is shuffled is one
small array a pack and fold, and the plan of a step is one, whatever the number
of folds. Coefficients stay in a table; the driver sees one number a step.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.operators.expanding import expanding_medians
from tidemark.operators.relational import latest_per_key
from tidemark.session import cut_lineage
from tidemark.sources import versions

#: Rows of a pack; most Newton steps, and the change of a coefficient that ends them.
PACK, STEPS, AT_REST = 4096, 40, 1e-10
#: A feature is used where so many training rows have it and it varies.
MIN_PRESENT = 30


@dataclass
class Folds:
    """Training rows in packs, and what is known of each fold before it is fitted.

    ``rows``: the columns given, __y (class number, null without label) and __no (number among the key's training rows).
    ``packs``: keys, pack, no, y, x (rows of features, NaN where null).
    ``stats``: keys, fold, last, lo, hi (the rows to calibrate on, if any), n, classes (training rows per class), med, mean, inv
    (one over the deviation; 0 where the feature is not used).
    """

    keys: list[str]
    features: list[str]
    classes: list[str]
    rows: DataFrame
    packs: DataFrame
    stats: DataFrame


def prefix_folds(df: DataFrame, keys: Sequence[str], order: str, features: Sequence[str], label: str, classes: Sequence[str], cuts: Callable[[DataFrame], DataFrame], min_present: int = MIN_PRESENT) -> Folds:
    """Number the labelled rows that have a feature, let ``cuts`` name the folds on them, and make their statistics.

    ``cuts`` gets the training rows and returns keys, fold, last, lo, hi. Folds that
    miss a class in their training rows are left out.
    """
    keys, features, classes = list(keys), list(features), list(classes)
    clean = {f: F.when(~F.isnan(F.col(f).cast("double")), F.col(f).cast("double")) for f in features}
    y = (F.array_position(F.array(*[F.lit(c) for c in classes]), F.col(label)) - 1).cast("int")
    some = reduce(lambda a, b: a | b, [F.col(f).isNotNull() for f in features])
    rows = df.withColumns(clean).withColumn("__y", F.when(y >= 0, y)).where(some)
    trains = F.when(F.col("__y").isNotNull(), 1)
    rows = cut_lineage(rows.withColumn("__no", F.when(F.col("__y").isNotNull(), F.count(trains).over(Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)))))
    train = rows.where("__no IS NOT NULL")
    folds = cut_lineage(cuts(train).select(*keys, "fold", F.col("last").cast("long").alias("last"), F.col("lo").cast("long").alias("lo"), F.col("hi").cast("long").alias("hi")).where("last > 0"))
    packs = train.groupBy(*keys, F.floor((F.col("__no") - 1) / PACK).alias("pack")).agg(F.sort_array(F.collect_list(F.struct(
        F.col("__no").alias("no"), F.col("__y").alias("y"), F.array(*[F.coalesce(f, F.lit(float("nan"))) for f in features]).alias("x")))).alias("p"))
    packs = cut_lineage(packs.select(*keys, "pack", F.transform("p", lambda r: r["no"]).alias("no"), F.transform("p", lambda r: r["y"]).alias("y"), F.flatten(F.transform("p", lambda r: r["x"])).alias("x")))
    return Folds(keys, features, classes, rows, packs, _statistics(train, folds, keys, features, len(classes), min_present))


def _statistics(train: DataFrame, folds: DataFrame, keys: list[str], features: list[str], n_classes: int, min_present: int) -> DataFrame:
    # A row's block is the number of cuts before it; the cut of block b ends blocks 0 to b.
    cut = folds.select(*keys, F.col("last").alias("no"), F.lit(1).alias("cut")).distinct()
    upto = Window.partitionBy(*keys).orderBy("no", "cut").rowsBetween(Window.unboundedPreceding, -1)
    marked = train.select(*keys, F.col("__no").alias("no"), F.lit(0).alias("cut"), F.col("__y").alias("y"), *[F.col(f).alias(f"f{i}") for i, f in enumerate(features)]).unionByName(cut, allowMissingColumns=True)
    marked = cut_lineage(marked.withColumn("block", F.coalesce(F.sum("cut").over(upto), F.lit(0)).cast("int")))
    rows, ends = marked.where("cut = 0"), marked.where("cut = 1").select(*keys, F.col("no").alias("last"), "block")
    sums = [F.count("*").alias("n"), *[F.count_if(F.col("y") == c).alias(f"y{c}") for c in range(n_classes)]]
    features = [f"f{i}" for i in range(len(features))]
    for i, f in enumerate(features):
        sums += [F.count(f).alias(f"n{i}"), F.sum(f).alias(f"s{i}"), F.sum(F.col(f) * F.col(f)).alias(f"q{i}"), F.min(f).alias(f"lo{i}"), F.max(f).alias(f"hi{i}")]
    blocks = rows.groupBy(*keys, "block").agg(*sums)
    so_far = Window.partitionBy(*keys).orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    over = lambda c: {"l": F.min, "h": F.max}.get(c[0], F.sum)(c).over(so_far)
    names = [c for c in blocks.columns if c not in (*keys, "block")]
    total = blocks.select(*keys, "block", *[over(c).alias(c) for c in names])
    mids = expanding_medians(rows, keys, "block", ends, "block", features)
    known = folds.join(ends, [*keys, "last"]).join(total, [*keys, "block"]).join(mids, [*keys, "block"])
    med = [F.coalesce(F.get("medians", F.lit(i)), F.lit(0.0)) for i in range(len(features))]
    none = [F.col("n") - F.col(f"n{i}") for i in range(len(features))]
    mean = [(F.coalesce(f"s{i}", F.lit(0.0)) + m * z) / F.col("n") for i, (m, z) in enumerate(zip(med, none, strict=True))]
    var = [(F.coalesce(f"q{i}", F.lit(0.0)) + m * m * z) / F.col("n") - u * u for i, (m, z, u) in enumerate(zip(med, none, mean, strict=True))]
    inv = [F.when((F.col(f"n{i}") >= min_present) & (F.col(f"lo{i}") < F.col(f"hi{i}")) & (v > 1e-12 * F.greatest(F.lit(1e-12), u * u)), 1.0 / F.sqrt(v)).otherwise(0.0)
           for i, (v, u) in enumerate(zip(var, mean, strict=True))]
    known = known.where(reduce(lambda a, b: a & b, [F.col(f"y{c}") > 0 for c in range(n_classes)])).select(
        *keys, "fold", "last", "lo", "hi", "n", F.array(*[F.col(f"y{c}") for c in range(n_classes)]).alias("classes"), F.array(*med).alias("med"), F.array(*mean).alias("mean"), F.array(*inv).alias("inv"))
    return cut_lineage(known.where(F.exists("inv", lambda x: x > 0)))


# -- sums over packs -------------------------------------------------------------------------


def _summed(folds: Folds, state: DataFrame, partial: Callable, update: Callable, schema: str) -> DataFrame:
    """One step of all folds: ``partial(fold, x, y, no)`` of every pack of the fold's key, added up, and ``update(fold, sums)``.

    ``state`` has keys, fold and whatever the functions need; ``update`` returns the columns of ``schema``.
    """
    keys, k = folds.keys, len(folds.features)
    mine = [c for c in state.columns if c not in keys]
    of_key = state.groupBy(*keys).agg(F.collect_list(F.struct(*mine)).alias("folds"))
    joined = folds.packs.join(of_key, keys)
    kinds = ", ".join(f"`{c}` {state.schema[c].dataType.simpleString()}" for c in keys)

    def add(batches):
        for b in batches:
            for r in b.to_pylist():
                x, y, no = np.asarray(r["x"], float).reshape(-1, k), np.asarray(r["y"]), np.asarray(r["no"])
                out = [{**{c: r[c] for c in keys}, "fold": f["fold"], "part": got.tolist()} for f in r["folds"] if (got := partial(f, x, y, no)) is not None]
                if out:
                    yield pa.RecordBatch.from_pylist(out, part_schema)

    def arrow(name):
        from pyspark.sql.pandas.types import to_arrow_type

        return to_arrow_type(state.schema[name].dataType)

    part_schema = pa.schema([*[(c, arrow(c)) for c in keys], ("fold", arrow("fold")), ("part", pa.list_(pa.float64()))])
    fold_kind = state.schema["fold"].dataType.simpleString()
    # A pack holds thousands of rows, so a fold has few parts.
    parts = joined.mapInArrow(add, f"{kinds}, fold {fold_kind}, part array<double>").groupBy(*keys, "fold").agg(F.collect_list("part").alias("parts"))
    ready = state.join(parts, [*keys, "fold"], "left")

    def change(batches):
        for b in batches:
            out = []
            for r in b.to_pylist():
                parts = r.pop("parts")
                out.append({**r, **update(r, np.sort(np.asarray(parts, float), axis=0).sum(0) if parts else None)})
            yield pa.RecordBatch.from_pylist(out, out_schema)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    fields = [f for f in state.schema.fields if f.name not in StructType.fromDDL(schema).names] + StructType.fromDDL(schema).fields
    out_schema = to_arrow_schema(StructType(fields))
    return ready.mapInArrow(change, StructType(fields))


def _to_rest(folds: Folds, state: DataFrame, partial: Callable, update: Callable, schema: str, steps: int = STEPS) -> DataFrame:
    """Steps until no fold's coefficients change by more than ``AT_REST``; a fold at rest keeps its own."""
    for _ in range(steps):
        state = cut_lineage(_summed(folds, state, partial, update, schema))
        moved = state.agg(F.max("moved")).first()[0]
        if moved is None or moved < AT_REST:
            break
    return state


def _scaled(f: dict, x: np.ndarray) -> np.ndarray:
    """Training columns of a fold with a column of ones: filled, centred, scaled; unused features are 0."""
    x = np.where(np.isnan(x), np.asarray(f["med"]), x)
    return np.concatenate([(x - np.asarray(f["mean"])) * np.asarray(f["inv"]), np.ones((len(x), 1))], 1)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def fit(folds: Folds, penalty: float | None = None) -> DataFrame:
    """``folds.stats`` with ``beta``: per class the coefficients of the scaled features and the intercept.

    Minimises the mean loss, classes weighted alike, plus ``penalty``/2 times the squared coefficients (intercepts free,
    centred). Without ``penalty`` it is one over the training rows, as for a unit inverse strength on summed losses.
    """
    c, k = len(folds.classes), len(folds.features) + 1
    free = np.tile(np.append(np.ones(k - 1), 0.0), c)

    def partial(f, x, y, no):
        if f["moved"] < AT_REST:
            return None
        use = no <= f["last"]
        if not use.any():
            return None
        x, y = _scaled(f, x[use]), y[use]
        w = (f["n"] / (c * np.asarray(f["classes"], float)))[y] / f["n"]
        p = _softmax(x @ np.asarray(f["beta"]).reshape(c, k).T)
        t = np.eye(c)[y]
        loss = -(w * np.log(np.maximum(p[np.arange(len(y)), y], 1e-300))).sum()
        grad = ((p - t) * w[:, None]).T @ x
        hess = np.zeros((c, k, c, k))
        for a in range(c):
            for b in range(a, c):
                v = w * p[:, a] * ((a == b) - p[:, b])
                hess[a, :, b, :] = hess[b, :, a, :] = (x * v[:, None]).T @ x
        return np.concatenate([[loss], grad.ravel(), hess.ravel()])

    def update(f, total):
        if total is None:
            return {}
        beta, before = np.asarray(f["beta"]), np.asarray(f["before"])
        lam = (1.0 / f["n"] if penalty is None else penalty) * free
        loss = total[0] + 0.5 * (lam * beta * beta).sum()
        if loss > f["loss"] + 1e-12 * abs(f["loss"]):  # too long a step: half of it
            new = (beta + before) / 2
            return {"beta": new.tolist(), "moved": float(np.abs(new - before).max())}
        grad, hess = total[1:1 + c * k] + lam * beta, total[1 + c * k:].reshape(c * k, c * k) + np.diag(lam)
        new = beta - np.linalg.lstsq(hess, grad, rcond=1e-12)[0]
        new = new.reshape(c, k)
        new[:, -1] -= new[:, -1].mean()
        new = new.ravel()
        return {"beta": new.tolist(), "before": beta.tolist(), "loss": float(loss), "moved": float(np.abs(new - beta).max())}

    none = F.array_repeat(F.lit(0.0), c * k)
    start = folds.stats.withColumns({"beta": none, "before": none, "loss": F.lit(1e300), "moved": F.lit(1e300)})
    return _to_rest(folds, start, partial, update, "beta array<double>, before array<double>, loss double, moved double").drop("before", "moved")


def calibrated(folds: Folds, fitted: DataFrame) -> DataFrame:
    """``fitted`` folds that have rows to calibrate on, with ``curves``: per class slope and offset of a sigmoid of the class score.

    The targets of a curve are (n + 1) / (n + 2) of the class's rows and 1 / (n + 2) of the others, n of each counted on the
    rows from ``lo`` to ``hi``, so that curves stay finite where classes don't overlap. Folds whose rows to calibrate on
    lack a class or the others are left out.
    """
    c, k = len(folds.classes), len(folds.features) + 1
    state = fitted.where("hi > lo")

    def scores(f, x, y, no):
        use = (no > f["lo"]) & (no <= f["hi"])
        return (_scaled(f, x[use]) @ np.asarray(f["beta"]).reshape(c, k).T, y[use]) if use.any() else (None, None)

    def count(f, x, y, no):
        z, y = scores(f, x, y, no)
        return None if z is None else np.bincount(y, minlength=c).astype(float)

    counted = _summed(folds, state, count, lambda f, t: {"held": (np.zeros(c) if t is None else t).tolist()}, "held array<double>")
    total = F.aggregate("held", F.lit(0.0), lambda s, x: s + x)
    start = cut_lineage(counted.where(~F.exists("held", lambda x: (x == 0) | (x == total)))).withColumns(
        {"curves": F.flatten(F.array_repeat(F.array(F.lit(0.0), F.lit(0.0)), c)), "moved": F.lit(1e300)})

    def partial(f, x, y, no):
        if f["moved"] < AT_REST:
            return None
        z, y = scores(f, x, y, no)
        if z is None:
            return None
        n, out = np.asarray(f["held"]), []
        for i in range(c):
            a, b = f["curves"][2 * i:2 * i + 2]
            t = np.where(y == i, (n[i] + 1) / (n[i] + 2), 1 / (n.sum() - n[i] + 2))
            p = 1 / (1 + np.exp(-np.clip(a * z[:, i] + b, -500, 500)))
            v = p * (1 - p)
            out += [((p - t) * z[:, i]).sum(), (p - t).sum(), (v * z[:, i] ** 2).sum(), (v * z[:, i]).sum(), v.sum()]
        return np.array(out)

    def update(f, total):
        if total is None:
            return {}
        new = np.asarray(f["curves"], float)
        for i in range(c):
            ga, gb, haa, hab, hbb = total[5 * i:5 * i + 5]
            step = np.linalg.solve([[haa + 1e-12, hab], [hab, hbb + 1e-12]], [ga, gb])
            new[2 * i:2 * i + 2] -= step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-300))
        return {"curves": new.tolist(), "moved": float(np.abs(new - np.asarray(f["curves"])).max())}

    return _to_rest(folds, start, partial, update, "curves array<double>, moved double").drop("moved", "held")


# -- using the folds ---------------------------------------------------------------------------


def _scores(folds: Folds) -> list[Column]:
    """Class scores of a row beside a fold's columns."""
    k = len(folds.features)
    x = [(F.coalesce(F.col(f), F.get("med", F.lit(i))) - F.get("mean", F.lit(i))) * F.get("inv", F.lit(i)) for i, f in enumerate(folds.features)]
    return [reduce(lambda s, j: s + x[j] * F.get("beta", F.lit(c * (k + 1) + j)), range(k), F.get("beta", F.lit(c * (k + 1) + k))) for c in range(len(folds.classes))]


def probabilities(folds: Folds, rows: DataFrame, names: Sequence[str], curves: bool = False) -> DataFrame:
    """``rows`` (joined with fitted folds) with a probability per class: of the softmax, or of the curves, made to sum to one."""
    z = [f"__z{i}" for i in range(len(folds.classes))]
    out = rows.withColumns(dict(zip(z, _scores(folds), strict=True)))
    if curves:
        part = [1.0 / (1.0 + F.exp(-(F.get("curves", F.lit(2 * i)) * F.col(c) + F.get("curves", F.lit(2 * i + 1))))) for i, c in enumerate(z)]
    else:
        part = [F.exp(F.col(c) - F.greatest(*z)) for c in z]
    out = out.withColumns({f"__e{i}": p for i, p in enumerate(part)})
    total = reduce(lambda a, b: a + b, [F.col(f"__e{i}") for i in range(len(z))])
    return out.withColumns({n: F.when(total > 0, F.col(f"__e{i}") / total).otherwise(1.0 / len(z)) for i, n in enumerate(names)}).drop(*z, *[f"__e{i}" for i in range(len(z))])


def coefficient_rows(folds: Folds, fitted: DataFrame) -> DataFrame:
    """M9. (keys, fold, class, feature, coefficient) of the features a fold uses."""
    k = len(folds.features)
    cells = F.array(*[F.struct(F.lit(c).alias("class"), F.lit(f).alias("feature"), F.get("beta", F.lit(i * (k + 1) + j)).alias("coefficient"), F.get("inv", F.lit(j)).alias("inv"))
                      for i, c in enumerate(folds.classes) for j, f in enumerate(folds.features)])
    return fitted.select(*folds.keys, "fold", F.explode(cells).alias("x")).select(*folds.keys, "fold", "x.*").where("inv > 0").drop("inv")


def year_cuts(keys: Sequence[str], year: str, first_year: int, min_train: int, min_test: int, parts: int = 0) -> Callable[[DataFrame], DataFrame]:
    """Folds ``year * 10`` of the rows before a year with enough rows before and in it; with ``parts``, folds ``year * 10 + i`` of growing heads.

    The training rows of a year are cut into ``parts`` + 1 runs of equal length, what is over going to the first; head i
    is all before run i + 1, which is the one it is calibrated on.
    """
    def cuts(train: DataFrame) -> DataFrame:
        per = train.groupBy(*keys, year).agg(F.count("*").alias("__n"))
        before = Window.partitionBy(*keys).orderBy(year).rowsBetween(Window.unboundedPreceding, -1)
        wanted = per.withColumn("n", F.sum("__n").over(before)).where((F.col(year) >= first_year) & (F.col("n") >= min_train) & (F.col("__n") >= min_test))
        none = F.lit(None).cast("long")
        folds = [F.struct((F.col(year) * 10).alias("fold"), F.col("n").alias("last"), none.alias("lo"), none.alias("hi"))]
        size = F.floor(F.col("n") / (parts + 1))
        for i in range(parts):
            lo = F.col("n") - (parts - i) * size
            folds.append(F.struct((F.col(year) * 10 + i + 1).alias("fold"), lo.alias("last"), lo.alias("lo"), (lo + size).alias("hi")))
        return wanted.select(*keys, F.explode(F.array(*folds)).alias("f")).select(*keys, "f.*")

    return cuts


def holdout_cuts(keys: Sequence[str], min_rows: int, share: float = 0.8, most: int = 500, least: int = 50) -> Callable[[DataFrame], DataFrame]:
    """M16. One fold a key: all but the last fifth, which is at most ``most`` and at least ``least`` rows."""
    def cuts(train: DataFrame) -> DataFrame:
        n = F.col("n")
        per = train.groupBy(*keys).agg(F.count("*").alias("n")).where(n >= min_rows)
        none = F.lit(None).cast("long")
        return per.select(*keys, F.lit(0).alias("fold"), F.least(F.greatest(F.floor(n * share), n - most), n - least).alias("last"), none.alias("lo"), none.alias("hi"))

    return cuts


def whole_cuts(keys: Sequence[str], min_rows: int) -> Callable[[DataFrame], DataFrame]:
    """M15. One fold a key that trains on all its rows."""
    def cuts(train: DataFrame) -> DataFrame:
        none = F.lit(None).cast("long")
        return train.groupBy(*keys).agg(F.count("*").alias("last")).where(F.col("last") >= min_rows).select(*keys, F.lit(0).alias("fold"), "last", none.alias("lo"), none.alias("hi"))

    return cuts


def save(folds: Folds, fitted: DataFrame, root: str) -> versions.Version:
    """M15. Publish fitted folds as the next version of the model at ``root``, with the names it needs."""
    return versions.replace(fitted, root, {"keys": folds.keys, "features": folds.features, "classes": folds.classes})


def load(spark, root: str, number: int | None = None) -> tuple[Folds, DataFrame]:
    """M15. A published model (the latest, or a numbered version) for ``probabilities``; without rows to train on."""
    found = versions.latest(spark, root) if number is None else versions.manifest(spark, root, number)
    if found is None:
        raise FileNotFoundError(f"no model is published at {root}")
    fitted = versions.read(spark, root, found.number)
    p = found.properties
    return Folds(p["keys"], p["features"], p["classes"], None, None, fitted), fitted


def score_newest(model: Folds, fitted: DataFrame, rows: DataFrame, order: str, names: Sequence[str]) -> DataFrame:
    """M15. Keys, ``order`` and class probabilities of the newest row of each key that has a feature, by the key's model."""
    some = reduce(lambda a, b: a | b, [F.col(f).isNotNull() for f in model.features])
    clean = rows.withColumns({f: F.when(~F.isnan(F.col(f).cast("double")), F.col(f).cast("double")) for f in model.features}).where(some)
    newest = latest_per_key(clean.select(*model.keys, order, *model.features), model.keys, [order])
    return probabilities(model, newest.join(fitted, model.keys), names).select(*model.keys, order, *names)
