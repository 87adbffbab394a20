"""Statistics of growing training sets whose cost follows the rows, not rows times training sets.

Rows enter training with a block; a fold uses every block up to its own. Sums
add up over blocks. Medians don't, so they are found by a descent: values get
their rank among all values of a key as a code, and all folds go down the code
digit by digit together. At a digit a fold needs to know how many values in its
node, of the blocks up to its own, fall to each child: running sums over one
window in which rows and folds of a node stand in order of their blocks.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.session import cut_lineage

#: Children of a node: values of a key with up to 16^L different values need L windows.
RADIX, BITS = 16, 4


def _descend(counted: DataFrame, folds: DataFrame, at: list[str], levels: int) -> DataFrame:
    """(at, fold, which, code): code of the lower (0) and upper (1) middle value of each fold's values."""
    child = [f"c{j}" for j in range(RADIX)]
    zeros = [F.lit(0).cast("long").alias(c) for c in child]
    state = folds.select(*at, "fold", F.explode(F.array(F.lit(0), F.lit(1))).alias("which"), F.lit(0).cast("long").alias("node"), F.lit(None).cast("long").alias("want"))
    for level in range(levels):
        shift = BITS * (levels - 1 - level)
        digit = F.shiftright("code", shift).bitwiseAND(RADIX - 1)
        values = counted.select(*at, F.shiftright("code", shift + BITS).alias("node"), F.col("block").alias("fold"), F.lit(0).alias("kind"), F.lit(None).cast("int").alias("which"), F.lit(None).cast("long").alias("want"),
                                *[F.when(digit == j, F.col("n")).otherwise(0).alias(c) for j, c in enumerate(child)])
        asked = state.select(*at, "node", "fold", F.lit(1).alias("kind"), "which", "want", *zeros)
        upto = Window.partitionBy(*at, "node").orderBy("fold", "kind").rowsBetween(Window.unboundedPreceding, 0)
        met = values.unionByName(asked).select(*at, "node", "fold", "kind", "which", "want", F.array(*[F.sum(c).over(upto) for c in child]).alias("have")).where("kind = 1")
        total = F.aggregate("have", F.lit(0).cast("long"), lambda s, x: s + x)
        met = met.withColumn("want", F.coalesce("want", F.floor((total - 1 + F.col("which")) / 2))).withColumn(
            "running", F.transform("have", lambda x, i: F.aggregate(F.slice("have", 1, i + 1), F.lit(0).cast("long"), lambda s, y: s + y)))
        step = F.size(F.filter("running", lambda x: x <= F.col("want")))
        state = met.where(F.col("want") >= 0).withColumn("step", step).select(*at, "fold", "which", (F.col("node") * RADIX + F.col("step")).alias("node"),
                                                                              (F.col("want") - F.when(F.col("step") > 0, F.get("running", F.col("step") - 1)).otherwise(0)).alias("want"))
    return state.select(*at, "fold", "which", F.col("node").alias("code"))


def expanding_medians(rows: DataFrame, keys: Sequence[str], block: str, folds: DataFrame, fold: str, features: Sequence[str]) -> DataFrame:
    """(keys, ``fold``, medians): exact medians of ``features`` over the rows with ``block`` <= the fold's number; null without values.

    ``folds`` names the folds (keys, ``fold``). Each window holds a row per value and block and two rows per fold; the
    number of windows follows the logarithm of a key's different values.
    """
    at = [*keys, "feature"]
    long = rows.where(F.col(block).isNotNull()).select(*keys, F.col(block).cast("long").alias("block"), F.posexplode(F.array(*[F.col(f).cast("double") for f in features])).alias("feature", "value"))
    ranked = long.where(F.col("value").isNotNull() & ~F.isnan("value")).withColumn("code", (F.dense_rank().over(Window.partitionBy(*at).orderBy("value")) - 1).cast("long"))
    counted = cut_lineage(ranked.groupBy(*at, "block", "code", "value").agg(F.count("*").alias("n")))
    greatest, levels = counted.agg(F.max("code")).first()[0] or 0, 1
    while greatest >= RADIX ** levels:
        levels += 1
    asked = folds.select(*keys, F.col(fold).cast("long").alias("fold")).distinct().withColumn("feature", F.explode(F.sequence(F.lit(0), F.lit(len(features) - 1))))
    middle = _descend(counted, asked, at, levels).join(counted.select(*at, "code", "value").distinct(), [*at, "code"])
    mids = middle.groupBy(*at, "fold").agg((F.sum("value") / 2).alias("median"))
    filled = asked.join(mids, [*at, "fold"], "left").groupBy(*keys, "fold").agg(F.array_sort(F.collect_list(F.struct("feature", "median"))).alias("m"))
    return filled.select(*keys, F.col("fold").cast(folds.schema[fold].dataType).alias(fold), F.transform("m", lambda x: x["median"]).alias("medians"))


def block_moments(rows: DataFrame, keys: Sequence[str], block: str, cells: Sequence[Column]) -> DataFrame:
    """(keys, ``block``, pair, s): upper triangle, row by row, of the moment matrix of ``cells`` per block; rows with a null block are left out.

    Every task adds up the products of its batches, so one array a batch and block is shuffled, whatever the rows.
    """
    p = len(cells)
    upper = np.triu_indices(p)
    z = rows.where(F.col(block).isNotNull()).select(*keys, block, F.array(*cells).alias("z"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in z.schema if f.name != "z")

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            names = b.schema.names[:-1]
            groups = b.select(names).to_pandas().groupby(names, dropna=False, sort=False).indices
            x = b.column("z").flatten().to_numpy(zero_copy_only=False).reshape(-1, p)
            firsts = pa.array([ix[0] for ix in groups.values()], pa.int64())
            sums = [(x[ix].T @ x[ix])[upper].tolist() for ix in groups.values()]
            yield pa.RecordBatch.from_arrays([*[b.column(c).take(firsts) for c in names], pa.array(sums, pa.list_(pa.float64()))], [*names, "sums"])

    sums = z.mapInArrow(run, f"{kinds}, sums array<double>").select(*keys, block, F.posexplode("sums").alias("pair", "s"))
    return sums.groupBy(*keys, block, "pair").agg(F.sum("s").alias("s"))


def expanding_modes(rows: DataFrame, keys: Sequence[str], block: str, folds: DataFrame, fold: str, columns: Sequence[str]) -> DataFrame:
    """(keys, ``fold``, column, mode): most frequent value of each column over the rows with ``block`` <= the fold's, the least of equals; null without values.

    Counts only grow with the blocks, so the mode up to a block is the value of the greatest running count met so far: one
    window over value counts per block, whatever the number of folds.
    """
    at = [*keys, "column"]
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    long = rows.where(F.col(block).isNotNull()).select(*keys, F.col(block).cast("long").alias("block"), F.explode(cells).alias("x")).select(*keys, "block", "x.*").where("value IS NOT NULL")
    counted = long.groupBy(*at, "value", "block").agg(F.count("*").alias("n"))
    running = counted.withColumn("n", F.sum("n").over(Window.partitionBy(*at, "value").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)))
    asked = folds.select(*keys, F.col(fold).cast("long").alias("block")).distinct().withColumn("column", F.explode(F.array(*[F.lit(c) for c in columns])))
    both = running.select(*at, "block", F.struct((-F.col("n")).alias("n"), "value").alias("least"), F.lit(False).alias("asked")).unionByName(asked.withColumn("asked", F.lit(True)), allowMissingColumns=True)
    upto = Window.partitionBy(*at).orderBy("block").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return both.withColumn("mode", F.min("least").over(upto)["value"]).where("asked").select(*keys, F.col("block").cast(folds.schema[fold].dataType).alias(fold), "column", "mode")
