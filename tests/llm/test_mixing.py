"""Operator 5 against a loop; the SQL oracle covers the query."""

import pytest
from pyspark.sql import functions as F

from tidemark.llm import mixing


def test_marginals_meet_targets(spark):
    rows = [(f"s{a}", f"l{b}", f"t{c}", 10 + 97 * a + 31 * b + 5 * c * a * a) for a in range(5) for b in range(3) for c in range(4)]
    cells = spark.createDataFrame([*rows, ("s9", "l0", "t0", 0)], "source string, lang string, topic string, n_tokens long")
    out = mixing.raked(cells)
    total = sum(r[3] for r in rows)
    for d in mixing.DIMENSIONS:
        want = {r[d]: r.target for r in mixing._targets(cells, d, mixing.FLATTEN).collect()}
        have = {r[d]: r.t / total for r in out.where("n_tokens > 0").groupBy(d).agg(F.sum(F.col("n_tokens") * F.col("weight")).alias("t")).collect()}
        assert have == pytest.approx(want, rel=1e-6)
    assert out.where("source = 's9'").first().weight == 1.0


def test_odd_documents(docs, odd, none):
    out = mixing.weighted(docs).collect()
    assert sorted(str(r.doc_id) for r in out) == sorted(str(i) for i, _ in odd)
    assert all(0 < r.prob <= 1 and r.source is not None for r in out)
    kept = mixing.sample(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in out if r.kept)
    assert mixing.weighted(none).count() == 0
    assert mixing.sample(none).count() == 0


def test_sample_follows_probability(spark):
    share = spark.range(20_000).select(mixing.uniform(F.col("id")).alias("u")).where("u < 0.3").count() / 20_000
    assert share == pytest.approx(0.3, abs=0.02)


def test_sample_meets_targets(spark):
    """Rare classes get weights far above one; no probability exceeds one, and the expected shares are the targets."""
    rows = [(i, "legal license term" if i % 800 == 0 else "made | cells" if i % 40 == 1 else "plain words here", "de" if i % 25 == 3 else "en", "s1" if i % 50 == 7 else "s0") for i in range(8_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    out = mixing.weighted(docs).cache()
    most = out.agg(F.max("weight"), F.max("prob")).first()
    assert most[0] > 1 / mixing.KEPT_SHARE and most[1] == pytest.approx(1)
    cells = out.groupBy(*mixing.DIMENSIONS).agg(F.sum("n_tokens").alias("n_tokens"))
    total = out.agg(F.sum(F.col("n_tokens") * F.col("prob"))).first()[0]
    for d in mixing.DIMENSIONS:
        want = {r[d]: r.target for r in mixing._targets(cells, d, mixing.FLATTEN).collect()}
        have = {r[d]: r.t / total for r in out.groupBy(d).agg(F.sum(F.col("n_tokens") * F.col("prob")).alias("t")).collect()}
        assert have == pytest.approx(want, rel=1e-6)
    got = mixing.sample(docs)
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.collect()) == sorted(r.doc_id for r in out.where("kept").collect())


def test_weights_of_a_loop(spark):
    """Against plain rounds; empty cells make the fitting slow."""
    rows = [("a", "x", "p", 50), ("a", "y", "q", 5), ("b", "x", "q", 8), ("c", "y", "p", 1), ("c", "z", "q", 20)]
    targets, w = [], [1.0] * 5
    for k in range(3):
        sums = {}
        for r in rows:
            sums[r[k]] = sums.get(r[k], 0) + r[3]
        targets.append({c: s ** mixing.FLATTEN / sum(x ** mixing.FLATTEN for x in sums.values()) for c, s in sums.items()})
    for _ in range(9):
        for k in range(3):
            have = {}
            for r, x in zip(rows, w, strict=True):
                have[r[k]] = have.get(r[k], 0) + r[3] / 84 * x
            w = [x * targets[k][r[k]] / have[r[k]] for r, x in zip(rows, w, strict=True)]
    out = mixing.raked(spark.createDataFrame(rows, "source string, lang string, topic string, n_tokens long"), rounds=9)
    assert {tuple(r[:3]): r.weight for r in out.collect()} == pytest.approx({r[:3]: x for r, x in zip(rows, w, strict=True)}, rel=1e-6)


def test_topic(spark):
    texts = ["", "plain words", "see | here", "mail a@b.c", "license by a@b", "see http://a.b/c", "a|b"]
    assert [r[0] for r in spark.createDataFrame([(t,) for t in texts], "text string").select(mixing.topic(F.col("text"))).collect()] == ["prose", "prose", "table", "contact", "legal", "web", "prose"]
