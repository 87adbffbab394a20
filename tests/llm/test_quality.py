"""Operator 7: counts against Python, verdicts on junk and clean text."""

from collections import Counter

from helpers_llm import WORD, frame, prose
from tidemark.llm import quality


def plain(t):
    t = t or ""
    w = WORD.findall(t)
    three = Counter(tuple(w[j:j + 3]) for j in range(len(w) - 2))
    again = {j + k for j in range(len(w) - 2) if three[tuple(w[j:j + 3])] > 1 for k in range(3)}
    real = [x for x in t.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(real) - len(set(real)), len(again)


def test_counts(docs, odd):
    out = quality.verdicts(docs).collect()
    want = sorted((str(i), *c, c[0] < 50 or 100 * c[4] > 50 * c[0]) for i, t in odd for c in [plain(t)])
    assert sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in out) == want
    assert not any(r.kept and r.base_failed for r in out)


def corpus():
    clean = [(i, prose(i, 60 + i * 3)) for i in range(80)]
    junk = [(1000 + i, " ".join(w + "###" for w in prose(i, 90).split())) for i in range(3)]
    junk += [(1100 + i, " ".join(w.upper() + "!!" for w in prose(200 + i, 90).split())) for i in range(3)]
    junk += [(1200 + i, "\n".join(["buy it now and here"] * 3 + [prose(i, 8)] * 20)) for i in range(3)]
    return clean, junk


def test_junk_goes_and_clean_stays(spark):
    clean, junk = corpus()
    out = {r.doc_id: r.kept for r in quality.verdicts(frame(spark, clean + junk)).collect()}
    assert all(out[i] for i, _ in clean)
    assert not any(out[i] for i, _ in junk)
    kept = quality.keep_clean(frame(spark, clean + junk))
    assert sorted(r.doc_id for r in kept.collect()) == [i for i, _ in clean]


def test_filter_keeps_columns_and_agrees(docs, none):
    kept = quality.keep_clean(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in quality.verdicts(docs).collect() if r.kept)
    assert quality.verdicts(none).count() == quality.keep_clean(none).count() == 0
