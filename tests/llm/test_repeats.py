"""Operator 8 against all windows."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from helpers_llm import frame, prose
from tidemark.llm import repeats


def plain(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    met = Counter(t[j:j + length] for t in texts for j in range(len(t) - length + 1))
    out = []
    for (i, _), t in zip(rows, texts, strict=True):
        change = np.zeros(len(t) + 1, int)
        for j in range(len(t) - length + 1):
            if met[t[j:j + length]] > 1:
                change[j] += 1
                change[j + length] -= 1
        gone = np.cumsum(change[:-1]) > 0
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((str(i), len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def run(df, *args):
    return sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.without_repeats(df, *args).collect())


def passages():
    line, rows = prose(900, 60), []
    for k in range(25):
        own = prose(k, 70)
        rows.append((k, f"{own} {line if k % 2 else line[:150 + k]} {own[:220] if k % 3 == 0 else ''}"))
    return rows + [(100, "ab" * 500), (101, "x" * 199), (102, "x" * 200), (103, "x" * 201), (104, line), (105, "pre" + line[1:-1])]


@pytest.mark.parametrize("length,gram", [(200, 64), (40, 16), (12, 5)])
def test_passages(spark, length, gram):
    rows = passages()
    assert run(frame(spark, rows).repartition(4), length, gram) == plain(rows, length)


def test_odd_texts(docs, odd):
    assert run(docs) == plain(odd, 200)


def test_small_chunks_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK", 300)
    data = np.frombuffer(passages()[0][1].encode() * 3, np.uint8)
    offs = np.array([0, 700, len(data)])
    held = sorted(w for _, _, a, b, _ in repeats.anchors(data, offs) for lo, hi in zip(a, b, strict=True) for w in range(lo, hi + 1))
    assert held == [w for lo, hi in zip(offs[:-1], offs[1:], strict=True) for w in range(lo, hi - 199)]


def test_no_documents(none):
    assert repeats.without_repeats(none).count() == 0


def test_hot_anchors_are_counted_window_by_window(spark):
    """A passage with other surroundings in every document: its contexts don't meet in one shard, the result stays."""
    assert repeats._least_count(repeats._packed_count(np.array([1, 2, 128, 129, 5_000]))).tolist()[:4] == [1, 2, 128, 128]
    rows = passages()
    for length, gram in ((200, 64), (12, 5)):
        assert run(frame(spark, rows).repartition(4), length, gram, 1) == plain(rows, length)
    shared = prose(901, 60)
    rows = [(k, f"{prose(5000 + k, 12)} {shared} {prose(7000 + k, 12)}") for k in range(300)]
    df = frame(spark, rows).repartition(4)
    assert run(df, 200, 64, 60) == plain(rows, 200)
    windows, heated, strings, count = repeats.find_repeats(df, hot=60)
    sizes = [len(repeats.Lookup(*windows, count)._shard(s)[0]) for s in range(count)]
    with pytest.raises(FileNotFoundError):
        repeats.Lookup(windows[0] + "-lost", windows[1], count)._shard(windows[1][0])
    assert heated is not None and max(sizes) < 150
