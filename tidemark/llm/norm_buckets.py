"""Operator 13: exact top-k inner products by norm-bucketed retrieval.

All vectors are sorted by falling length and cut into buckets. For a query and
a bucket, its k-th best score so far divided by the query's length and the
bucket's greatest length is the cosine that a row of the bucket needs: the
local threshold. Above one the bucket is skipped, unread. From
``COORDINATE_FROM`` on, the bucket's rows are narrowed by coordinates: a unit
vector within the threshold's angle of the query lies within that angle of it
as seen from every axis, which is a range of a sorted coordinate. Below, rows
are taken from the long end for as long as their length allows. What is left
is verified by exact integer products.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm import vector_blocks as V
from tidemark.llm.shared import scratch, stored

TOP, QUERY_EVERY = 5, 50
BUCKET, RUN, QUERY_BLOCK = 2048, 8, 256
#: Local cosine threshold from which a bucket is pruned by coordinates, and how many of the query's largest are looked at.
COORDINATE_FROM, FOCUS = 0.8, 3
_SLACK = 1e-9


class Bucket:
    """A block in falling order of length; sorted coordinates are made when first asked for."""

    def __init__(self, block: V.Block):
        self.block, self._columns = block, {}
        with np.errstate(divide="ignore", invalid="ignore"):
            self.unit = np.where(block.norms[:, None] > 0, block.x / block.norms[:, None], 0.0)

    def column(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        if f not in self._columns:
            order = np.argsort(self.unit[:, f], kind="stable")
            self._columns[f] = order, self.unit[order, f]
        return self._columns[f]

    def by_coordinates(self, unit: np.ndarray, cosine: float) -> np.ndarray:
        """Rows that may have at least ``cosine`` with ``unit``: in range on its largest coordinates, the shortest range first."""
        angle, focus, ranges = np.arccos(min(1.0, cosine)), np.argsort(-np.abs(unit), kind="stable")[:FOCUS], []
        for f in focus:
            own = np.arccos(np.clip(unit[f], -1, 1))
            low, high = np.cos(min(np.pi, own + angle)) - _SLACK, np.cos(max(0.0, own - angle)) + _SLACK
            order, values = self.column(f)
            a, b = np.searchsorted(values, low, "left"), np.searchsorted(values, high, "right")
            ranges.append((b - a, f, low, high, order[a:b]))
        ranges.sort(key=lambda r: r[0])
        rows = ranges[0][4]
        for _, f, low, high, _ in ranges[1:]:
            seen = self.unit[rows, f]
            rows = rows[(seen >= low) & (seen <= high)]
        return rows


class Search:
    """The best rows found so far for a block of queries."""

    def __init__(self, queries: V.Block, top: int):
        self.q, self.top = queries, top
        n = len(queries.ids)
        with np.errstate(divide="ignore", invalid="ignore"):
            self.unit = np.where(queries.norms[:, None] > 0, queries.x / queries.norms[:, None], 0.0)
        self.key, self.score, self.ids = (np.empty(0, np.int64) for _ in range(3))
        self.need = np.full(n, -np.inf)

    def may_hold(self, longest: float) -> np.ndarray:
        """Queries for which a row of this length or less can be among the best."""
        return self.q.norms * longest * (1 + 1e-12) >= self.need

    def add(self, key, score, ids) -> None:
        key, score, ids = (np.concatenate([a, b]) for a, b in ((self.key, key), (self.score, score), (self.ids, ids)))
        kept = V.best(key, score, ids, self.top)
        self.key, self.score, self.ids = key[kept], score[kept], ids[kept]
        full = np.bincount(self.key, minlength=len(self.need)) >= self.top
        least = np.full(len(self.need), np.inf)
        np.minimum.at(least, self.key, self.score.astype(np.float64))
        self.need = np.where(full, least, -np.inf)

    def see(self, block: V.Block) -> None:
        """Take in a block whose rows fall in length."""
        if not len(block.ids):
            return
        longest, q = float(block.norms[0]), self.q
        bound = float(q.norms.max(initial=0)) * longest
        if not bound < V.EXACT:  # too large for bounds in double precision: verify every product
            self._verified(np.arange(len(q.ids)), V.products(q.x, block.x, np.inf), block.ids)
            return
        active = np.flatnonzero(self.may_hold(longest))
        if not len(active):
            return
        with np.errstate(divide="ignore", invalid="ignore"):
            local = np.where(self.need[active] > 0, self.need[active] / (q.norms[active] * longest), -1.0)
        narrow = local >= COORDINATE_FROM
        self._by_length(active[~narrow], block)
        if narrow.any():
            self._by_coordinates(active[narrow], local[narrow], Bucket(block))

    def _by_length(self, some: np.ndarray, block: V.Block) -> None:
        if not len(some):
            return
        with np.errstate(divide="ignore", invalid="ignore"):
            shortest = np.where(self.need[some] > 0, self.need[some] / self.q.norms[some], 0.0) * (1 - 1e-12)
        rows = int(np.searchsorted(-block.norms, -shortest.min(), "right"))
        self._verified(some, V.products(self.q.x[some], block.x[:rows], 0.0), block.ids[:rows])

    def _by_coordinates(self, some: np.ndarray, local: np.ndarray, bucket: Bucket) -> None:
        keys, scores, ids = [], [], []
        for i, cosine in zip(some, local, strict=True):
            rows = bucket.by_coordinates(self.unit[i], cosine * (1 - 1e-12))
            rows = rows[bucket.block.ids[rows] != self.q.ids[i]]
            s = (bucket.block.x[rows] @ self.q.x[i]).astype(np.int64)
            hit = s >= self.need[i]
            keys.append(np.full(int(hit.sum()), i))
            scores.append(s[hit])
            ids.append(bucket.block.ids[rows[hit]])
        self.add(np.concatenate(keys), np.concatenate(scores), np.concatenate(ids))

    def _verified(self, some: np.ndarray, s: np.ndarray, ids: np.ndarray) -> None:
        """Keep of the products of ``some`` queries (rows of ``s``) those that reach the query's need and the block's own k-th best."""
        other = self.q.ids[some][:, None] != ids[None, :]
        s = np.where(other, s, V.LONG.min)
        floor = np.partition(s, s.shape[1] - self.top, axis=1)[:, s.shape[1] - self.top] if s.shape[1] > self.top else np.full(len(s), V.LONG.min)
        i, j = np.nonzero(other & (s >= floor[:, None]) & (s.astype(np.float64) >= np.where(np.abs(self.need[some]) < V.EXACT, self.need[some], -np.inf)[:, None]))
        self.add(some[i], s[i, j], ids[j])


def top_products(vectors: DataFrame, top: int = TOP, query_every: int = QUERY_EVERY) -> DataFrame:
    """query_id, rank, vec_id, score: the ``top`` highest integer products of every query row (vec_id divisible by ``query_every``) with the other rows.

    Components are floor(256 * x). Rows with a null id or vector, or a null or not finite component, take no part; vectors
    of other lengths are not compared. Rows with the query's id are its own and no candidates; query rows that share an
    id are answered each, and candidates that repeat count each. Fewer candidates than ``top`` give as many rows. Ties go
    to the smaller vec_id. Scores beyond 64 bits become the nearest 64-bit integer.
    """
    spark, folder = vectors.sparkSession, scratch(vectors.sparkSession, "norm-buckets")
    rows = stored(V.vector_rows(vectors, F.lit(0)), "vectors")
    asked = rows.where(F.col("vec_id") % query_every == 0)
    parts = V.query_parts(asked.count(), QUERY_BLOCK, spark)
    every = ["size", "vec_id", "tag", "v"]
    queries = stored(V.lay(asked.repartition(parts, "vec_id").sortWithinPartitions(*every), f"{folder}/q", QUERY_BLOCK), "queries")
    falling = ["size", F.desc("norm"), "vec_id", "tag", "v"]
    buckets = stored(V.lay(rows.repartitionByRange(*falling).sortWithinPartitions(*falling), f"{folder}/b", BUCKET), "buckets")
    parts = 1 + (queries.agg(F.max("part")).first()[0] or 0)

    def run(batches):
        search, name = None, None
        for r, last in V.pairs_of(batches):
            if name != (r["q_part"], r["q_k"]):
                name = r["q_part"], r["q_k"]
                search = Search(V.load(f"{folder}/q", *name), top)
            for b in r["blocks"]:
                if search.may_hold(b["top"]).any():
                    search.see(V.load(f"{folder}/b", r["part"], b["k"]))
            if last:
                n = len(search.key)
                yield pa.RecordBatch.from_arrays([pa.array([name[0]] * n, pa.int32()), pa.array([name[1]] * n, pa.int32()), pa.array(search.key, pa.int64()), pa.array(search.q.ids[search.key], pa.int64()),
                                                  pa.array(search.ids, pa.int64()), pa.array(search.score, pa.int64())], ["q_part", "q_k", "at", "query_id", "vec_id", "score"])

    found = V.grid(V.runs(buckets, RUN), queries, parts).mapInArrow(run, "q_part int, q_k int, at long, query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("q_part", "q_k", "at").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")
