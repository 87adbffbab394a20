"""Operators 12 and 13 against all pairs."""

import math

import numpy as np
import pytest

from tidemark.llm import hard_negatives as H
from tidemark.llm import norm_buckets as N
from tidemark.llm import vector_blocks as V

TOP = 2 ** 63 - 1


def whole(v):
    if v is None or any(x is None or not math.isfinite(x) for x in v):
        return None
    return [math.floor(256 * x) for x in v]


def product(a, b):
    return max(-TOP - 1, min(TOP, sum(x * y for x, y in zip(a, b, strict=True))))


def plain_top(rows, top=5):
    ok = [(i, w) for i, v in rows if i is not None and (w := whole(v)) is not None]
    out = []
    for q, a in ok:
        if q % 50 == 0:
            near = sorted((-product(a, b), i) for i, b in ok if i != q and len(b) == len(a))
            out += [(q, k + 1, i, -s) for k, (s, i) in enumerate(near[:top])]
    return sorted(out)


def plain_negatives(rows):
    ok = [(i, (t + 1) % 10 if i % 7 == 0 else t, w) for i, v, t in rows if i is not None and t is not None and (w := whole(v)) is not None]
    out = []
    for q, tag, a in ok:
        if q % 100 == 0:
            all_ = sorted((-product(a, b), i, t) for i, t, b in ok if i != q and len(b) == len(a))
            for s, p, _ in [x for x in all_ if x[2] == tag][:5]:
                fit = [(n, i) for n, i, t in all_ if t != tag and -30 * s <= -100 * n <= -90 * s]
                out += [(q, p, k + 1, i, -s, -n) for k, (n, i) in enumerate(fit[:10])]
    return sorted(out)


def vectors(n=1500, d=24, seed=5):
    """Clusters, copies, very different lengths, ties, and rows that take no part."""
    rnd = np.random.default_rng(seed)
    centres, rows = rnd.normal(size=(9, d)), []
    for k in range(n):
        v = (centres[k % 9] + rnd.normal(size=d) * [0.0, 0.05, 0.3, 1.5][k % 4]) * [1, 1, 0.02, 6, 0][k % 5]
        rows.append((k * 5 % 2000, [float(np.float32(x)) for x in v]))
    nan, inf = float("nan"), float("inf")
    return rows + [(5000, None), (5050, []), (5100, []), (5200, [None, *[1.0] * (d - 1)]), (5300, [nan, *[1.0] * (d - 1)]), (5400, [inf, *[1.0] * (d - 1)]),
                   (5500, [1.0]), (5501, [2.0]), (5550, [-3.0, 0.25]), (5551, [0.5, 0.5]), (None, [1.0] * d)]


def labelled(rows):
    return [(i, v, None if k % 41 == 0 else 3 if k % 3 == 0 else k % 10) for k, (i, v) in enumerate(rows)]


SCHEMA = "vec_id long, embedding array<{}>, label int, node string, tag int, score long, part string"


def frame(spark, rows, kind="float"):
    return spark.createDataFrame([(*r, "n", 1, 2, "p") for r in rows], SCHEMA.format(kind)).repartition(3)


def result(df):
    return sorted(tuple(r) for r in df.collect())


def test_top(spark):
    rows = vectors()
    got = result(N.top_products(frame(spark, labelled(rows))))
    assert got == plain_top(rows) and len(got) > 100


def test_negatives(spark):
    rows = labelled(vectors())
    got = result(H.hard_negatives(frame(spark, rows), H.switched_label()))
    assert got == plain_negatives(rows) and len(got) > 100


def test_no_rows(spark):
    none = frame(spark, [])
    assert N.top_products(none).count() == 0 and H.hard_negatives(none, H.switched_label()).count() == 0
    alone = frame(spark, [(100, [1.0, 2.0], 1)])
    assert N.top_products(alone).count() == 0 and H.hard_negatives(alone, H.switched_label()).count() == 0


def test_repeated_ids_and_huge_components(spark):
    """Rows with one id are each other's own; products beyond doubles and 64 bits are exact or at the limit."""
    rows = [(100, [1.0, 2.0], 1), (100, [1.0, 2.5], 1), (101, [1.0, 2.0], 1), (101, [1.0, 2.0], 1), (102, [3.0, 0.5], 2), (200, [1e18, -3e7], 1), (203, [2e9, 5e7], 1), (204, [1e9 + 1, 7.0], 2),
            (300, [1e200, 1.0], 1), (303, [1e100, 1.0], 2), (400, [1.7e308, 1.0], 1)]
    assert result(N.top_products(frame(spark, rows, "double"))) == plain_top([r[:2] for r in rows if r[0] != 400])
    assert result(H.hard_negatives(frame(spark, rows, "double"), H.switched_label())) == plain_negatives([r for r in rows if r[0] != 400])


def blocks(x, rows):
    x = np.floor(256 * x)
    order = np.argsort(-np.linalg.norm(x, axis=1), kind="stable")
    return [V.Block(order[k:k + rows].astype("<i8"), order[k:k + rows] % 4, x[order[k:k + rows]], H.summaries(x[order[k:k + rows]])) for k in range(0, len(x), rows)]


@pytest.mark.parametrize("rows", [16, 128])
def test_pruning_by_coordinates_and_length(monkeypatch, rows):
    """Near copies raise the thresholds so that both ways of pruning take place, and nothing is lost."""
    rnd = np.random.default_rng(9)
    x = np.repeat(rnd.normal(size=(60, 12)), 10, 0) + rnd.normal(size=(600, 12)) * 0.02
    x *= rnd.uniform(0.5, 3, size=(600, 1)).round(1)
    seen = []
    plain_by = N.Bucket.by_coordinates
    monkeypatch.setattr(N.Bucket, "by_coordinates", lambda self, u, c: seen.append((len(got := plain_by(self, u, c)), len(self.unit))) or got)
    made = blocks(x, rows)
    q = made[1]
    search = N.Search(q, 5)
    skipped = 0
    for b in made:
        skipped += not search.may_hold(float(b.norms[0])).any()
        search.see(b)
    assert seen and sum(a for a, _ in seen) < 0.5 * sum(n for _, n in seen)
    ids, all_x = np.concatenate([b.ids for b in made]), np.concatenate([b.x for b in made])
    for i in range(len(q.ids)):
        s = (all_x @ q.x[i]).astype(int)
        want = sorted((-s[j], ids[j]) for j in range(600) if ids[j] != q.ids[i])[:5]
        assert sorted((-a, b) for a, b, k in zip(search.score, search.ids, search.key, strict=True) if k == i) == want


def test_bounds_hold_at_every_level():
    rnd = np.random.default_rng(3)
    for d in (1, 5, 16, 64, 77):
        x, y = np.floor(256 * rnd.normal(size=(40, d))), np.floor(256 * rnd.normal(size=(50, d)) + 90)
        real = x @ y.T
        widths = []
        for (am, ad), (bm, bd) in zip(H.levels(H.summaries(x), d), H.levels(H.summaries(y), d), strict=True):
            middle, spread = am @ bm.T, ad @ bd.T
            slack = 1e-9 * (1 + np.abs(real).max())
            assert (middle - spread <= real + slack).all() and (middle + spread >= real - slack).all()
            widths.append(spread.mean())
        assert widths == sorted(widths, reverse=True)


def test_filtering_leaves_few_pairs_where_segments_tell():
    """Vectors of steady segments: almost no pair is scored exactly, and the best are the same."""
    rnd = np.random.default_rng(4)
    x = np.repeat(rnd.normal(size=(500, 16)), 4, 1) + rnd.normal(size=(500, 64)) * 0.01
    made = blocks(x, 125)
    anchors, found, exact = H.Anchors(made[0]), H.Best(125, 5), []
    for b in made:
        got = anchors.scored(b, made[0].ids[:, None] != b.ids[None, :], lambda i, low, high: high >= found.need[i])
        exact.append(len(got[0]))
        found.add(got[0], got[2], b.ids[got[1]])
    assert sum(exact[1:]) < 0.1 * 125 * 375


def test_band():
    for s in range(-40, 400):
        low, high = H.band(s)
        assert [n for n in range(-50, 500) if 30 * s <= 100 * n <= 90 * s] == list(range(low, high + 1))
