"""Operator 12: hard negatives by segment summary filtering.

Every vector is cut into segments, and each segment's mean and deviation are
stored beside it. On a segment of s components two vectors' product is
s * (mean * mean) plus something between - and + s * (deviation * deviation);
summed over the segments this bounds their score from both sides. A block of
anchors meets a block of rows on few long segments first; what may still matter
goes on to twice as many halves, and what is left after the shortest segments
is scored exactly.

A row may matter to an anchor's positives if its upper bound reaches the fifth
best so far; to the negatives of a positive if its bounds leave room for a score
inside the band, at or above the tenth best so far.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm import vector_blocks as V
from tidemark.llm.shared import read_file, scratch, stored, write_file

ANCHOR_EVERY, POSITIVES, NEGATIVES = 100, 5, 10
#: A negative scores between these percentages of the positive.
BAND = (30, 90)
BLOCK, RUN, ANCHOR_BLOCK = 2048, 8, 256
#: Segments of the first level and of the last; every level has twice as many as the one before.
COARSEST, FINEST = 4, 16
#: Share of a block's pairs from which they are computed as a matrix, not one by one.
DENSE = 0.15
_SLACK = 1e-9


def segment_lengths(size: int, most: int = FINEST) -> np.ndarray:
    """Lengths of the finest segments: as equal as can be, some of them empty for short vectors."""
    return np.diff(np.arange(most + 1) * size // most)


def summaries(x: np.ndarray) -> np.ndarray:
    """Mean and deviation of the finest segments of each row: first all means, then all deviations."""
    lengths = segment_lengths(x.shape[1])
    edges = np.concatenate([[0], np.cumsum(lengths)])
    with np.errstate(over="ignore", invalid="ignore"):
        mean = np.stack([x[:, a:b].mean(1) if b > a else np.zeros(len(x)) for a, b in zip(edges[:-1], edges[1:], strict=True)], 1)
        dev = np.stack([x[:, a:b].std(1) if b > a else np.zeros(len(x)) for a, b in zip(edges[:-1], edges[1:], strict=True)], 1)
    return np.concatenate([mean, dev], 1)


def levels(stored_: np.ndarray, size: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Means and deviations from the coarsest to the finest segments, each times the root of the segment's length, so that products are plain."""
    s = segment_lengths(size).astype(np.float64)
    mean, dev = stored_[:, :FINEST], stored_[:, FINEST:]
    out, m = [], FINEST
    while True:
        root = np.sqrt(s)
        out.append((mean * root, dev * root))
        if m == COARSEST:
            return out[::-1]
        m //= 2
        whole = s.reshape(m, 2).sum(1)
        share = np.divide(s.reshape(m, 2), whole[:, None], out=np.zeros((m, 2)), where=whole[:, None] > 0)
        up = (mean.reshape(-1, m, 2) * share).sum(2)
        square = ((dev ** 2 + mean ** 2).reshape(-1, m, 2) * share).sum(2)
        mean, dev, s = up, np.sqrt(np.maximum(square - up ** 2, 0.0) + 1e-12 * square), whole


class Anchors:
    """A block of anchors and the bounds of a block of rows against it."""

    def __init__(self, block: V.Block):
        self.block = block
        self.levels = levels(block.extra, block.x.shape[1])

    def scored(self, rows: V.Block, start: np.ndarray, wanted) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(anchor, row, exact score) of the pairs of ``start`` (a mask) that ``wanted(anchors, lower, upper)`` lets through at every level.

        ``wanted`` gets anchor numbers and bounds of pairs, in one dimension.
        """
        a = self.block
        i, j = np.nonzero(start)
        bound = float(a.norms.max(initial=0)) * float(rows.norms.max(initial=0))
        if not bound < V.EXACT:  # bounds would not hold in double precision
            return i, j, V.products(a.x, rows.x, np.inf)[i, j]
        slack = _SLACK * (1.0 + bound)
        for (am, ad), (rm, rd) in zip(self.levels, levels(rows.extra, rows.x.shape[1]), strict=True):
            if not len(i):
                break
            if len(i) >= DENSE * start.size:
                middle, spread = (am @ rm.T)[i, j], (ad @ rd.T)[i, j]
            else:
                middle, spread = np.einsum("ij,ij->i", am[i], rm[j]), np.einsum("ij,ij->i", ad[i], rd[j])
            keep = wanted(i, middle - spread - slack, middle + spread + slack)
            i, j = i[keep], j[keep]
        if len(i) >= DENSE * start.size:
            return i, j, V.products(a.x, rows.x, bound)[i, j]
        return i, j, np.einsum("ij,ij->i", a.x[i], rows.x[j]).astype(np.int64)


class Best:
    """The first ``most`` entries of each key so far, and the score a new one needs."""

    def __init__(self, keys: int, most: int):
        self.keys, self.most = keys, most
        self.key, self.score, self.ids = (np.empty(0, np.int64) for _ in range(3))
        self.need = np.full(keys, -np.inf)

    def add(self, key, score, ids) -> None:
        key, score, ids = (np.concatenate([a, b]) for a, b in ((self.key, key), (self.score, score), (self.ids, ids)))
        kept = V.best(key, score, ids, self.most)
        self.key, self.score, self.ids = key[kept], score[kept], ids[kept]
        least = np.full(self.keys, np.inf)
        np.minimum.at(least, self.key, self.score.astype(np.float64))
        least = np.where(np.abs(least) < V.EXACT, least, -np.inf)
        self.need = np.where(np.bincount(self.key, minlength=self.keys) >= self.most, least, -np.inf)


def see_positives(anchors: Anchors, found: Best, rows: V.Block) -> None:
    a = anchors.block
    start = (a.tags[:, None] == rows.tags[None, :]) & (a.ids[:, None] != rows.ids[None, :])
    i, j, s = anchors.scored(rows, start, lambda i, low, high: high >= found.need[i])
    found.add(i, s, rows.ids[j])


def see_negatives(anchors: Anchors, found: Best, rows: V.Block, low: np.ndarray, high: np.ndarray) -> None:
    """``low`` and ``high``: least and greatest score per anchor and positive (rows x positives; empty band where there is none)."""
    a, width = anchors.block, low.shape[1]

    def wanted(i, least, most):
        need = np.maximum(low, found.need.reshape(low.shape))
        keep = np.zeros(len(i), bool)
        for p in range(width):
            keep |= (most >= need[i, p]) & (least <= high[i, p])
        return keep

    i, j, s = anchors.scored(rows, a.tags[:, None] != rows.tags[None, :], wanted)
    keys, scores, ids = [], [], []
    for p in range(width):
        hit = (s >= low[i, p]) & (s <= high[i, p])
        keys.append(i[hit] * width + p)
        scores.append(s[hit])
        ids.append(rows.ids[j[hit]])
    found.add(np.concatenate(keys), np.concatenate(scores), np.concatenate(ids))


def band(score: int, percent: tuple[int, int] = BAND) -> tuple[int, int]:
    """Least and greatest integer score s with percent[0] * score <= 100 * s <= percent[1] * score."""
    return -(-percent[0] * score // 100), percent[1] * score // 100


def _scanned(grid: DataFrame, folder: str, start, see, emit, schema: str) -> DataFrame:
    """Run over the tasks' shares of the grid: ``start`` per anchor block, ``see`` per block of rows, ``emit`` at the end."""

    def run(batches):
        state, name = None, None
        for r, last in V.pairs_of(batches):
            if name != (r["q_part"], r["q_k"]):
                name = r["q_part"], r["q_k"]
                state = start(Anchors(V.load(f"{folder}/a", *name)), r)
            for b in r["blocks"]:
                see(state, r["part"], b)
            if last and (out := emit(state, name)) is not None:
                yield out

    return grid.mapInArrow(run, schema)


def hard_negatives(vectors: DataFrame, label=None, anchor_every: int = ANCHOR_EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES, percent: tuple[int, int] = BAND) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose vec_id is divisible by ``anchor_every``; an anchor's positives the first ``positives`` other
    rows of its label; the negatives of a positive the first ``negatives`` rows of other labels whose score is within
    ``percent`` of the positive's. Components are floor(256 * x); scores are integer products, ties go to smaller ids.
    ``label`` (default: the column) may be any integer expression of the row.

    Rows with a null id, label or vector, or a null or not finite component, take no part; vectors of other lengths are
    not compared. Rows with the anchor's id are its own. Anchor rows that share an id are answered each; repeated rows
    count each. Scores beyond 64 bits become the nearest 64-bit integer. A positive with a negative score has no band.
    """
    spark, folder = vectors.sparkSession, scratch(vectors.sparkSession, "hard-negatives")
    rows = stored(V.vector_rows(vectors, F.col("`label`") if label is None else label), "vectors")
    asked = rows.where(F.col("vec_id") % anchor_every == 0)
    order = ["size", "tag", "vec_id", "v"]
    parts = V.query_parts(asked.count(), ANCHOR_BLOCK, spark)
    anchors = stored(V.lay(asked.repartition(parts, "vec_id").sortWithinPartitions(*order), f"{folder}/a", ANCHOR_BLOCK, summaries), "anchors")
    blocks = stored(V.lay(rows.repartitionByRange(*order).sortWithinPartitions(*order), f"{folder}/b", BLOCK, summaries), "blocks")
    parts, run = 1 + (anchors.agg(F.max("part")).first()[0] or 0), V.runs(blocks, RUN)
    where = ["q_part", "q_k", "at"]

    def first(a, r):
        return a, Best(len(a.block.ids), positives), {int(t) for t in np.unique(a.block.tags)}

    def look(state, part, b):
        a, found, tags = state
        if any(b["low"] <= t <= b["high"] for t in tags):
            see_positives(a, found, V.load(f"{folder}/b", part, b["k"]))

    def told(state, name):
        a, found, _ = state
        n = len(found.key)
        return pa.RecordBatch.from_arrays([pa.array([name[0]] * n, pa.int32()), pa.array([name[1]] * n, pa.int32()), pa.array(found.key, pa.int64()), pa.array(a.block.ids[found.key], pa.int64()),
                                           pa.array(found.ids, pa.int64()), pa.array(found.score, pa.int64())], [*where, "anchor_id", "positive_id", "positive_score"])

    near = _scanned(V.grid(run, anchors, parts), folder, first, look, told, "q_part int, q_k int, at long, anchor_id long, positive_id long, positive_score long")
    place = F.row_number().over(Window.partitionBy(*where).orderBy(F.desc("positive_score"), "positive_id"))
    near = stored(near.withColumn("p", place - 1).where(F.col("p") < positives), "positives")
    asked_for = anchors.join(_written(near, folder), ["part", "k"])

    def again(a, r):
        shape = len(a.block.ids), positives
        low, high = np.full(shape, V.LONG.max), np.full(shape, V.LONG.min)
        for at, p, score in read_file(f"{folder}/n/{r['q_part']:06d}-{r['q_k']:06d}", "<i8").reshape(-1, 3).tolist():
            low[at, p], high[at, p] = band(score, percent)
        return a, Best(low.size, negatives), low, high

    def mine(state, part, b):
        a, found, low, high = state
        if b["low"] != b["high"] or (a.block.tags != b["low"]).any():
            see_negatives(a, found, V.load(f"{folder}/b", part, b["k"]), low, high)

    def mined(state, name):
        _, found, _, _ = state
        n = len(found.key)
        return pa.RecordBatch.from_arrays([pa.array([name[0]] * n, pa.int32()), pa.array([name[1]] * n, pa.int32()), pa.array(found.key // positives, pa.int64()), pa.array(found.key % positives, pa.int32()),
                                           pa.array(found.ids, pa.int64()), pa.array(found.score, pa.int64())], [*where, "p", "negative_id", "negative_score"])

    far = _scanned(V.grid(run, asked_for, parts), folder, again, mine, mined, "q_part int, q_k int, at long, p int, negative_id long, negative_score long")
    rank = F.row_number().over(Window.partitionBy(*where, "p").orderBy(F.desc("negative_score"), "negative_id"))
    far = far.withColumn("rank", rank).where(F.col("rank") <= negatives)
    return far.join(near, [*where, "p"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _written(near: DataFrame, folder: str) -> DataFrame:
    """Write the positives of each anchor block, a few for each of its rows, beside it; part and k of the blocks that have some."""

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                write_file(f"{folder}/n/{r['part']:06d}-{r['k']:06d}", np.array([(x["at"], x["p"], x["positive_score"]) for x in r["near"]], "<i8").tobytes())
            yield b.select(["part", "k"])

    blocks = near.groupBy(F.col("q_part").alias("part"), F.col("q_k").alias("k")).agg(F.sort_array(F.collect_list(F.struct("at", "p", "positive_score"))).alias("near"))
    return stored(blocks.mapInArrow(run, "part int, k int"), "near")


def switched_label():
    """The label, moved on by one (of ten) where 7 divides vec_id."""
    label = F.col("`label`").cast("long")
    return F.when(F.col("`vec_id`") % 7 == 0, (label + 1) % 10).otherwise(label)
