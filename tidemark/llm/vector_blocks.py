"""Integer vectors in flat block files, and the grid of query blocks against runs of blocks (operators 12 and 13).

A vector's components x become floor(256 * x), x as double. Blocks hold a
bounded number of rows of one vector length, in an order that depends on the
rows alone, under names that depend on their place; so a task that runs again
writes the same files. What moves between tasks is names of blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import read_file, write_file

SCALE = 256.0
#: Sums of products below this are exact in double precision, in any order.
EXACT = float(1 << 53)
LONG = np.iinfo(np.int64)


@dataclass
class Block:
    """Rows of one vector length: ids, tags, integer components as doubles, lengths, and what ``lay`` added."""

    ids: np.ndarray
    tags: np.ndarray
    x: np.ndarray
    extra: np.ndarray
    norms: np.ndarray = None

    def __post_init__(self):
        if self.norms is None:
            self.norms = np.sqrt(np.einsum("ij,ij->i", self.x, self.x))


def scaled(column: pa.Array) -> list[np.ndarray | None]:
    """floor(256 * x) per row; None for null vectors and those with a null component or one that is not finite (times 256)."""
    column = column.cast(pa.large_list(pa.float64()))
    offs, flat = column.offsets.to_numpy(), column.values
    bad = flat.is_null().to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore", invalid="ignore"):
        x = np.floor(SCALE * flat.fill_null(0.0).to_numpy(zero_copy_only=False)) + 0.0
    bad = np.concatenate([[0], np.cumsum(bad | ~np.isfinite(x))])
    null = column.is_null().to_numpy(zero_copy_only=False)
    return [None if null[i] or bad[b] > bad[a] else x[a:b] for i, (a, b) in enumerate(zip(offs[:-1], offs[1:], strict=True))]


def vector_rows(vectors: DataFrame, tag: Column) -> DataFrame:
    """vec_id, tag, size, norm, v of the rows that take part: id, tag and vector not null, every component finite.

    v has the integers as 32 bits each, or as doubles where they need more.
    """

    def run(batches):
        for b in batches:
            x = scaled(b.column(2))
            keep = [i for i, v in enumerate(x) if v is not None]
            raw = [x[i].astype("<i4" if np.abs(x[i]).max(initial=0) < 2 ** 31 else "<f8").tobytes() for i in keep]
            with np.errstate(over="ignore"):
                norms = [float(np.sqrt(x[i] @ x[i])) for i in keep]
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), pa.array([len(x[i]) for i in keep], pa.int32()), pa.array(norms, pa.float64()), pa.array(raw, pa.binary())],
                                             ["vec_id", "tag", "size", "norm", "v"])

    rows = vectors.select(F.col("`vec_id`").cast("long").alias("vec_id"), tag.cast("long").alias("tag"), F.col("`embedding`").alias("e")).where("vec_id IS NOT NULL AND tag IS NOT NULL")
    return rows.mapInArrow(run, "vec_id long, tag long, size int, norm double, v binary")


_PLACED = "part int, k int, size int, n long, top double, low long, high long"


def lay(dealt: DataFrame, folder: str, rows: int, extra: Callable[[np.ndarray], np.ndarray] | None = None) -> DataFrame:
    """Write the rows of each partition, as they stand, to blocks of ``rows``; a row per block: part, k, size, n, top (greatest length), low and high tag.

    ``dealt`` must be sorted by all of its columns, size first, in each partition.
    """

    def block(part, k, size, got):
        x = np.zeros((len(got), size))
        for i, (_, _, v) in enumerate(got):
            x[i] = np.frombuffer(v, "<i4" if len(v) == 4 * size else "<f8")
        wide = bool(np.abs(x).max(initial=0) >= 2 ** 31)
        ids, tags = np.array([g[0] for g in got], "<i8"), np.array([g[1] for g in got], "<i8")
        more = np.zeros((len(got), 0)) if extra is None else extra(x)
        write_file(f"{folder}/{part:06d}-{k:06d}", np.array([len(got), size, more.shape[1], wide], "<i8").tobytes(), ids.tobytes(), tags.tobytes(), more.astype("<f8").tobytes(),
                   x.astype("<f8" if wide else "<i4").tobytes())
        with np.errstate(over="ignore"):
            top = float(np.sqrt(np.einsum("ij,ij->i", x, x).max(initial=0)))
        return part, k, size, len(got), top, int(tags.min()), int(tags.max())

    def run(batches):
        part, k, now, got, out = TaskContext.get().partitionId(), 0, None, [], []
        for b in batches:
            for vec_id, tag, size, v in zip(*[b.column(c).to_pylist() for c in ("vec_id", "tag", "size", "v")], strict=True):
                if got and (len(got) == rows or size != now):
                    out.append(block(part, k, now, got))
                    k, got = k + 1, []
                now = size
                got.append((vec_id, tag, v))
        if got:
            out.append(block(part, k, now, got))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.float64(), pa.int64(), pa.int64()), strict=True)],
                                             ["part", "k", "size", "n", "top", "low", "high"])

    return dealt.mapInArrow(run, _PLACED)


def load(folder: str, part: int, k: int) -> Block:
    raw = read_file(f"{folder}/{part:06d}-{k:06d}", np.uint8)
    n, size, width, wide = (int(v) for v in raw[:32].view("<i8"))
    ends = np.cumsum([32, 8 * n, 8 * n, 8 * n * width])
    x = raw[ends[3]:].view("<f8" if wide else "<i4").reshape(n, size).astype(np.float64)
    with np.errstate(over="ignore"):
        return Block(raw[ends[0]:ends[1]].view("<i8"), raw[ends[1]:ends[2]].view("<i8"), x, raw[ends[2]:ends[3]].view("<f8").reshape(n, width))


def products(a: np.ndarray, b: np.ndarray, bound: float) -> np.ndarray:
    """Exact integer inner products of the rows of ``a`` and ``b``; those beyond 64 bits become the nearest 64-bit integer.

    ``bound`` is the greatest product of two lengths: below 2^53 doubles hold every partial sum.
    """
    if bound < EXACT:
        return (a @ b.T).astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    got = whole(a).dot(whole(b).T) if a.shape[1] else np.zeros((len(a), len(b)), object)
    return np.clip(got, int(LONG.min), int(LONG.max)).astype(np.int64)


def best(key: np.ndarray, score: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Places of the ``most`` first entries of each key: higher scores first, then smaller ids."""
    order = np.lexsort((ids, -score.astype(np.float64), key)) if np.abs(score).max(initial=0) < EXACT else np.array(sorted(range(len(key)), key=lambda i: (key[i], -int(score[i]), ids[i])), np.int64)
    k = key[order]
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.empty(0, np.int64)
    rank = np.arange(len(k)) - np.repeat(first, np.diff(np.append(first, len(k))))
    return order[rank < most]


def runs(blocks: DataFrame, length: int) -> DataFrame:
    """Runs of up to ``length`` consecutive blocks of one part and size: part, size, blocks (k, top, low, high), top."""
    one = F.struct("k", "top", "low", "high")
    return blocks.groupBy("part", "size", F.floor(F.col("k") / length).alias("run")).agg(F.sort_array(F.collect_list(one)).alias("blocks"), F.max("top").alias("top"))


def grid(of: DataFrame, queries: DataFrame, parts: int) -> DataFrame:
    """Every query block (part < ``parts``, k, size, ...) beside every run of blocks of its vector length, dealt to tasks and sorted by query block and falling length.

    A task gets whole slices of a query block's runs, so that what it has found in one run prunes the next. The number
    of tasks follows the number of pairs.
    """
    sc = of.sparkSession.sparkContext
    n_runs, n_queries = of.count(), queries.count()
    tasks = max(1, min(n_runs * n_queries, max(2 * sc.defaultParallelism, n_runs * n_queries // 64)))
    slices = max(1, -(-tasks // max(1, n_queries)))
    q = queries.select(F.col("part").alias("q_part"), F.col("k").alias("q_k"), F.col("size").alias("q_size"), *[c for c in queries.columns if c not in ("part", "k", "size", "n", "top", "low", "high")])
    pairs = of.withColumn("q_part", F.explode(F.sequence(F.lit(0), F.lit(max(0, parts - 1))))).join(q, "q_part").where("size = q_size").withColumn("slice", F.pmod(F.xxhash64("part", "run"), F.lit(slices)))
    return pairs.repartition(tasks, "q_part", "q_k", "slice").sortWithinPartitions("q_part", "q_k", F.desc("top"), "part", "run")


def pairs_of(batches) -> Iterator[tuple[dict, bool]]:
    """Rows of a task's share of the grid, each with whether it is the last of its query block."""
    held = None
    for b in batches:
        for r in b.to_pylist():
            if held is not None:
                yield held, (held["q_part"], held["q_k"]) != (r["q_part"], r["q_k"])
            held = r
    if held is not None:
        yield held, True


def query_parts(n: int, rows: int, spark) -> int:
    """Partitions for ``n`` query rows in blocks of ``rows``: enough for every core, no more than there are blocks."""
    return max(1, min(-(-n // rows), 4 * spark.sparkContext.defaultParallelism))
