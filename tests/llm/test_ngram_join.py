"""Operator 2 against all pairs."""

from collections import Counter, defaultdict

import pytest

from helpers_llm import LOWER, WORD, frame, prose
from tidemark.llm import ngram_join


def plain(rows):
    sets, holders = [], defaultdict(list)
    for k, (_, t) in enumerate(rows):
        w = WORD.findall((t or "").translate(LOWER))
        s = {tuple(w[j:j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
        sets.append(s)
        for g in s:
            holders[g].append(k)
    group = list(range(len(rows)))

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    shared = Counter((a, b) for h in holders.values() for x, b in enumerate(h) for a in h[:x])
    for (a, b), n in shared.items():
        if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
            group[root(b)] = root(a)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(i, least.get(root(k), i))
    return sorted((str(i), len(sets[k]), str(least.get(root(k)) if sets[k] else i)) for k, (i, _) in enumerate(rows))


def run(df):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in ngram_join.components(df).collect())


def test_odd_texts(docs, odd):
    assert run(docs) == plain(odd)


def test_sample(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert run(frame(spark, rows)) == plain(rows)


@pytest.mark.parametrize("dense", [3])
def test_dense_columns_lose_no_link(spark, monkeypatch, dense):
    """Chains of edits, near copies around the threshold and a line in most texts, nearly all of it in dense columns."""
    monkeypatch.setattr(ngram_join, "DENSE", dense)
    monkeypatch.setattr(ngram_join, "FREQUENT", 3)
    line, rows = " ".join(f"line{k}" for k in range(12)), []
    for family in range(4):
        words = prose(50 + family, 90).split(" ")
        for k in range(30):
            words = list(words) if k % 3 else prose(50 + family, 90).split(" ")
            for e in range(k % 5):
                words[(k * 11 + e * 17) % 90] = f"e{family}x{k}x{e}"
            rows.append((family * 1000 + k, " ".join(words) + (" " + line if k % 2 else "")))
    assert run(frame(spark, rows)) == plain(rows)


def test_no_documents(none):
    assert ngram_join.components(none).count() == 0
    assert ngram_join.keep_one(none).count() == 0


def test_one_of_each_stays(spark, docs, odd):
    """Rows that share a doc_id or have none are rows of their own: one of each component stays, whatever its id."""
    more = [(i, t) for _, t in odd[:14] for i in (None, 7)] + [(None, odd[5][1])] * 3
    rows = [*odd, *more]
    df = frame(spark, rows).repartition(3)
    kept = ngram_join.keep_one(df)
    assert kept.columns == docs.columns
    numbered = {(k, n, c) for k, n, c in ((int(k), n, int(c)) for k, n, c in plain([(k, t) for k, (_, t) in enumerate(rows)]))}
    groups = defaultdict(list)
    for k, n, c in numbered:
        groups[c if n else ("none", k)].append(rows[k])
    want = [min(g, key=lambda r: (r[0] is None, r[0] or 0)) for g in groups.values()]
    got = kept.collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in want)
    of = {t: c if n else None for (k, n, c) in numbered for t in [rows[k][1]]}
    with_words = [of[r.text] for r in got if of[r.text] is not None]
    assert len(with_words) == len(set(with_words))
