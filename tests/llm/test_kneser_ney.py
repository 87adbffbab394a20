"""Operator 3 against a dictionary version, and its sums to one."""

import math
import zlib
from collections import Counter

import pytest

from helpers_llm import LOWER, WORD, frame, prose
from tidemark.llm import kneser_ney


def plain(rows):
    texts = [[*WORD.findall((t or "").translate(LOWER)), "</s> "] for _, t in rows]
    held = [zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2 for i, _ in rows]
    train = [t for t, h in zip(texts, held, strict=True) if not h]
    c = Counter(w for t in train for w in t)
    pairs = Counter(p for t in train for p in zip(["<s> ", *t[:-1]], t))
    before = Counter(w for _, w in pairs)

    def discounts(counts):
        return [0, *kneser_ney.discounts(*[sum(v == k for v in counts.values()) for k in (1, 2, 3, 4)])]

    d2, d1 = discounts(pairs), discounts(before)
    total, spare = Counter(), Counter()
    for (a, _), n in pairs.items():
        total[a] += n
        spare[a] += d2[min(n, 3)]
    n, v, m = sum(c.values()), len(c), sum(before.values())
    left = sum(d1[min(x, 3)] for x in before.values()) / max(m, 1)

    def p1(w):
        return (before[w] - d1[min(before[w], 3)]) / m + left / (v + 1) if m else 1 / (v + 1)

    def p2(a, w):
        k = pairs[a, w]
        return (k - d2[min(k, 3)]) / total[a] + spare[a] / total[a] * p1(w) if total[a] else p1(w)

    out = []
    for (i, _), t, h in zip(rows, texts, held, strict=True):
        out.append((i, h, len(t), sum(c[w] > 0 for w in t), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t), sum(math.log10(p2(a, w)) for a, w in zip(["<s> ", *t[:-1]], t))))
    one = sum(p1(w) for w in before) + left / (v + 1) if m else 1
    return out, one


@pytest.mark.parametrize("which", ["odd", "sample", "alike"])
def test_scores(spark, odd, which):
    rows = odd if which == "odd" else [(i, "same words here again") for i in range(20)]
    if which == "sample":
        rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(80).collect()]
    want, one = plain(rows)
    assert one == pytest.approx(1)
    got = [tuple(r)[:7] for r in kneser_ney.scored(frame(spark, rows).repartition(3)).collect()]
    key = lambda r: (str(r[0]), r[2], round(r[5], 6))
    for g, w in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert g[:5] == w[:5]
        assert g[5:] == pytest.approx(w[5:], rel=1e-9)


def test_held_out_text_gains_from_context(spark):
    rows = [(i, prose(i % 9, 60, 40)) for i in range(120)]
    out = [r for r in kneser_ney.scored(frame(spark, rows)).collect() if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_no_documents_and_none_to_learn_from(spark, none):
    assert kneser_ney.scored(none).count() == 0
    only = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    r = kneser_ney.scored(frame(spark, [(only, "all new")])).first()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.score) == (3, 0, 0, 0.0)
