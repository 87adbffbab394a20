"""Operator 9: near-duplicate vectors by an epsilon grid order join.

Unit vectors with cosine >= t lie within eps = sqrt(2 - 2t) of each other.
They are projected on leading principal dimensions, which never lengthens a
distance, and sorted by the eps-wide grid cells there, dimension by dimension.
The sorted sequence is cut into blocks, laid down as flat files. Two blocks
are joined when some of their cells are neighbours and their bounding boxes
come within eps; a join halves both sequences again and again, skips intervals
whose boxes are farther apart, and computes exact cosines of what is left.

Equal vectors are one row with a weight, links within a pair of blocks leave
it as one edge per vector to the least vector of its group there, and counts
as sums; so a large group of copies makes no more rows than it has members.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import connected
from tidemark.llm.shared import narrow, read_file, scratch, stored, thinned, write_file

COSINE = 0.95
DIMENSIONS, CELL_DIMENSIONS, BLOCK, LEAF = 12, 3, 2048, 128
#: The rotation is fitted on about so many vectors at most, those with the least hashes; any rotation gives the same links.
FITTED_ON = 20_000


def unit_vectors(column: pa.Array) -> list[np.ndarray | None]:
    """Rows scaled to length one in double precision; None for null, empty, zero or not wholly finite vectors."""
    column = column.cast(pa.list_(pa.float64()))
    out: list[np.ndarray | None] = [None] * len(column)
    offs = column.offsets.to_numpy()
    flat = column.values
    hole = flat.is_null().to_numpy(zero_copy_only=False)
    flat = flat.fill_null(0.0).to_numpy(zero_copy_only=False)
    null = column.is_null().to_numpy(zero_copy_only=False)
    for i in range(len(column)):
        a, b = offs[i], offs[i + 1]
        if null[i] or a == b or hole[a:b].any():
            continue
        v = flat[a:b]
        top = np.abs(v).max()
        if np.isfinite(top) and top > 0:
            v = v / top
            out[i] = v / np.sqrt(v @ v)
    return out


def _rows(vectors: DataFrame) -> DataFrame:
    """vec_id, node (64-bit name of the unit vector, null where invalid), size, unit (bytes)."""

    def run(batches):
        for b in batches:
            units = unit_vectors(b.column(1))
            raw = [None if u is None else (u + 0.0).astype("<f8").tobytes() for u in units]
            nodes = [None if r is None else int.from_bytes(hashlib.blake2b(r, digest_size=8).digest(), "little", signed=True) for r in raw]
            yield pa.record_batch([b.column(0), pa.array(nodes, pa.int64()), pa.array([None if u is None else len(u) for u in units], pa.int32()), pa.array(raw, pa.binary())],
                                  ["vec_id", "node", "size", "unit"])

    return narrow(vectors, vec_id="vec_id", embedding="embedding").mapInArrow(run, "vec_id long, node long, size int, unit binary")


def rotation(distinct: DataFrame) -> dict[int, np.ndarray]:
    """Leading principal directions per vector length, from a bounded sample."""
    by_size: dict[int, list] = {}
    for r in thinned(distinct, F.col("node"), FITTED_ON).select("size", "unit").collect():
        by_size.setdefault(r["size"], []).append(np.frombuffer(r["unit"], "<f8"))
    out = {}
    for size, rows in by_size.items():
        x = np.array(rows)
        _, vec = np.linalg.eigh(np.cov(x, rowvar=False, bias=True).reshape(size, size) if len(x) > 1 else np.eye(size))
        out[size] = np.ascontiguousarray(vec[:, ::-1][:, :DIMENSIONS])
    return out


def _turn(directions: dict, size: int) -> np.ndarray:
    got = directions.get(size)
    return got if got is not None else np.eye(size)[:, :DIMENSIONS]


def _projected(distinct: DataFrame, directions: dict, eps: float) -> DataFrame:
    shared = distinct.sparkSession.sparkContext.broadcast(directions)

    def run(batches):
        for b in batches:
            cells = []
            for raw, size in zip(b.column("unit"), b.column("size").to_pylist(), strict=True):
                p = np.frombuffer(raw.as_buffer(), "<f8") @ _turn(shared.value, size)
                cells.append(np.floor(p / eps).astype(np.int64).tolist() + [0] * (DIMENSIONS - len(p)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cells, pa.list_(pa.int64()))], [*b.schema.names, "cells"])

    return distinct.select("node", "size", "weight", "unit").mapInArrow(run, "node long, size int, weight long, unit binary, cells array<long>")


_HEAD = np.dtype([("node", "<i8"), ("weight", "<i8")])


def _sequence(cells: DataFrame, directions: dict, eps: float, folder: str) -> DataFrame:
    """Sort by size and cells, write blocks; per block: name, size, boxes, the cells it holds on the first dimensions."""
    shared = cells.sparkSession.sparkContext.broadcast(directions)
    order = ["size", "cells", "node"]

    def block(rows, name, size):
        unit = np.array([np.frombuffer(r[2], "<f8") for r in rows])
        head = np.array([(r[0], r[1]) for r in rows], _HEAD)
        p = unit @ _turn(shared.value, size)
        write_file(f"{folder}/{name}.head", head.tobytes())
        write_file(f"{folder}/{name}.unit", unit.tobytes())
        held = sorted({tuple(r[3][:CELL_DIMENSIONS]) for r in rows})
        return name, size, p.min(0).tolist(), p.max(0).tolist(), [list(c) for c in held]

    def run(batches):
        part, n, rows, now, out = TaskContext.get().partitionId(), 0, [], None, []
        for b in batches:
            for node, size, weight, unit, c in zip(*[b.column(k).to_pylist() for k in ("node", "size", "weight", "unit", "cells")], strict=True):
                if rows and (len(rows) == BLOCK or size != now):
                    out.append(block(rows, f"{part:06d}-{n:06d}", now))
                    n, rows = n + 1, []
                now = size
                rows.append((node, weight, unit, c))
        if rows:
            out.append(block(rows, f"{part:06d}-{n:06d}", now))
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip(("name", "size", "low", "high", "held"), x, strict=True)) for x in out],
                                             pa.schema([("name", pa.string()), ("size", pa.int32()), ("low", pa.list_(pa.float64())), ("high", pa.list_(pa.float64())), ("held", pa.list_(pa.list_(pa.int64())))]))

    return cells.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, "name string, size int, low array<double>, high array<double>, held array<array<long>>")


def _block_pairs(blocks: DataFrame, eps: float) -> DataFrame:
    """(a, b, size) of blocks a <= b that hold neighbouring cells and whose boxes come within eps."""
    own = blocks.select("name", "size", "low", "high", F.explode("held").alias("cell"))
    near = own
    for i in range(CELL_DIMENSIONS):
        near = near.withColumn("cell", F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), _shifted(i))))
    x, y = own.alias("x"), near.dropDuplicates(["name", "cell"]).alias("y")
    gap = F.aggregate(F.arrays_zip(F.col("x.low").alias("al"), F.col("x.high").alias("ah"), F.col("y.low").alias("bl"), F.col("y.high").alias("bh")), F.lit(0.0),
                      lambda s, d: s + F.pow(F.greatest(F.lit(0.0), d["al"] - d["bh"], d["bl"] - d["ah"]), F.lit(2.0)))
    met = x.join(y, (F.col("x.size") == F.col("y.size")) & (F.col("x.cell") == F.col("y.cell"))).where((F.col("x.name") <= F.col("y.name")) & (gap <= eps * eps + 1e-9))
    return met.select(F.col("x.name").alias("a"), F.col("y.name").alias("b"), F.col("x.size").alias("size")).distinct()


def _shifted(i: int):
    return lambda d: F.transform("cell", lambda v, k: F.when(k == i, v + d).otherwise(v))


def sequence_links(a: np.ndarray, pa_: np.ndarray, b: np.ndarray, pb: np.ndarray, same: bool, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Indices (i, j) of linked rows of two sequences (i < j when they are the same), found by halving both."""
    limit, found = 2 - 2 * cosine + 1e-9, []
    todo = [(0, len(a), 0, len(b), same)]
    while todo:
        a0, a1, b0, b1, eq = todo.pop()
        if a0 == a1 or b0 == b1:
            continue
        if not eq:
            gap = np.maximum(0, np.maximum(pa_[a0:a1].min(0) - pb[b0:b1].max(0), pb[b0:b1].min(0) - pa_[a0:a1].max(0)))
            if gap @ gap > limit:
                continue
        if max(a1 - a0, b1 - b0) <= LEAF:
            hit = a[a0:a1] @ b[b0:b1].T >= cosine
            if eq:
                hit = np.triu(hit, 1)
            i, j = np.nonzero(hit)
            found.append((i + a0, j + b0))
            continue
        am, bm = (a0 + a1) // 2, (b0 + b1) // 2
        todo += [(a0, am, b0, bm, eq), (am, a1, bm, b1, eq), (a0, am, bm, b1, False)]
        if not eq:
            todo.append((am, a1, b0, bm, False))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _least_linked(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Least index each of n rows reaches over the links."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, i, label[j])
        np.minimum.at(new, j, label[i])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _joined(pairs: DataFrame, directions: dict, folder: str, cosine: float) -> DataFrame:
    """(node, links, root) per pair of blocks and linked vector: weighted number of links there, least node of its group there."""
    shared = pairs.sparkSession.sparkContext.broadcast(directions)

    def load(name, size):
        unit = read_file(f"{folder}/{name}.unit", "<f8").reshape(-1, size)
        return read_file(f"{folder}/{name}.head", _HEAD), unit, unit @ _turn(shared.value, size)

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                ha, a, qa = load(r["a"], r["size"])
                same = r["a"] == r["b"]
                hb, b, qb = (ha, a, qa) if same else load(r["b"], r["size"])
                i, j = sequence_links(a, qa, b, qb, same, cosine)
                if not len(i):
                    continue
                head = ha if same else np.concatenate([ha, hb])
                j = j if same else j + len(ha)
                links = np.bincount(i, head["weight"][j], len(head)) + np.bincount(j, head["weight"][i], len(head))
                root = _least_linked(len(head), i, j)
                hit = np.flatnonzero(links)
                yield pa.record_batch([pa.array(head["node"][hit]), pa.array(links[hit].astype(np.int64)), pa.array(head["node"][root[hit]])], ["node", "links", "root"])

    return pairs.mapInArrow(run, "node long, links long, root long")


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept per row of ``vectors`` (vec_id, embedding; other columns are not read).

    Every pair of rows with cosine >= ``cosine`` in double precision links, none below it. Null, empty, zero and not
    wholly finite vectors link with nothing; so do vectors of different lengths. n_links counts other rows, equal
    vectors included. component_id is the smallest vec_id reachable; rows that share a vec_id keep one row each.
    """
    eps = float(np.sqrt(2 - 2 * cosine))
    rows = stored(_rows(vectors), "vectors")
    distinct = rows.where("node IS NOT NULL").groupBy("node").agg(F.first("size").alias("size"), F.first("unit").alias("unit"), F.count("*").alias("weight"), F.min("vec_id").alias("least"))
    distinct = stored(distinct, "distinct")
    directions, folder = rotation(distinct), scratch(vectors.sparkSession, "blocks")
    blocks = stored(_sequence(_projected(distinct, directions, eps), directions, eps, folder), "sequence")
    pairs = stored(_block_pairs(blocks, eps), "pairs")
    n, cores = pairs.count(), vectors.sparkSession.sparkContext.defaultParallelism
    # By number: the rows are names, so their bytes say nothing about the work, and adaptive coalescing would leave one task.
    found = stored(_joined(pairs.repartition(max(1, min(n, max(4 * cores, n // 64))), "a", "b"), directions, folder, cosine), "found")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    comp = connected(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    about = distinct.select("node", "weight", "least").join(links, "node", "left").join(comp, "node", "left").select(
        "node", "least", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "node").alias("comp"))
    about = stored(about, "about")
    about = about.join(about.groupBy("comp").agg(F.min("least").alias("component_id")), "comp").select("node", "n_links", "component_id")
    out = rows.select("vec_id", "node").join(about, "node", "left")
    comp_id = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), comp_id.alias("component_id"), F.coalesce(F.col("vec_id") == comp_id, F.lit(True)).alias("kept"))
