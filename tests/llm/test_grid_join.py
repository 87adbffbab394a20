"""Operator 9 against all pairs."""

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import grid_join


def plain(rows, cosine):
    units = grid_join.unit_vectors(pa.array([v for _, v in rows], pa.list_(pa.float64())))
    n = len(rows)
    link = np.array([[a != b and units[a] is not None and units[b] is not None and len(units[a]) == len(units[b]) and units[a] @ units[b] >= cosine for b in range(n)] for a in range(n)]).reshape(n, n)
    group = np.arange(n)
    for _ in range(n):
        group = np.array([min([group[a], *group[link[a]]]) for a in range(n)])
    least = [min(rows[b][0] for b in range(n) if group[b] == group[a]) for a in range(n)]
    return sorted((rows[a][0], int(link[a].sum()), least[a], rows[a][0] == least[a]) for a in range(n))


def vectors():
    rnd = np.random.default_rng(7)
    centres, rows = rnd.normal(size=(12, 24)), []
    for k in range(260):
        v = centres[k % 12] + rnd.normal(size=24) * [0.0, 0.1, 0.2, 0.35][k % 4]
        rows.append((k * 3 % 1000, [float(np.float32(x)) for x in v * (1 + k % 5)]))
    nan, inf = float("nan"), float("inf")
    return rows + [(5000, None), (5001, []), (5002, [0.0] * 24), (5003, [None, *[1.0] * 23]), (5004, [nan, *[1.0] * 23]), (5005, [inf, *[1.0] * 23]), (5006, [1.0]), (5007, [2.0]), (5008, [1.0, 0.0])]


@pytest.mark.parametrize("block,leaf", [(2048, 128), (16, 4)])
def test_all_pairs(spark, monkeypatch, block, leaf):
    monkeypatch.setattr(grid_join, "BLOCK", block)
    monkeypatch.setattr(grid_join, "LEAF", leaf)
    rows = vectors()
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, node string, size int").repartition(3)
    assert sorted(tuple(r) for r in grid_join.near_duplicates(df).collect()) == plain(rows, 0.95)


def test_sequences_skip_only_what_is_far():
    rnd = np.random.default_rng(8)
    x = np.concatenate([rnd.normal(size=(150, 16)), np.repeat(rnd.normal(size=(5, 16)), 30, 0) + rnd.normal(size=(150, 16)) * 0.08])
    x /= np.linalg.norm(x, axis=1)[:, None]
    x = x[np.lexsort(np.floor(x[:, :4] / 0.3).T[::-1])]
    i, j = grid_join.sequence_links(x, x[:, :6], x, x[:, :6], True, 0.95)
    want = np.argwhere(np.triu(x @ x.T >= 0.95, 1))
    assert sorted(map(list, zip(i.tolist(), j.tolist(), strict=True))) == want.tolist()


def test_no_vectors(spark):
    assert grid_join.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
