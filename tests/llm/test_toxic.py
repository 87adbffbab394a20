"""Operator 4: the field against enumeration, held-out accuracy, odd inputs."""

import itertools
import zlib

import numpy as np

from helpers_llm import frame, prose
from tidemark.llm import toxic_spans


def test_marginals_by_enumeration():
    rnd = np.random.default_rng(1)
    u, change = rnd.normal(size=7), np.array([-0.7, 0.4, 0.9])
    total, mass = 0.0, np.zeros(7)
    for tags in itertools.product((0, 1), repeat=7):
        s = sum(u[t] for t in range(7) if tags[t]) + sum({(0, 0): 0, (0, 1): change[0], (1, 0): change[1], (1, 1): change[2]}[p] for p in itertools.pairwise(tags))
        total += np.exp(s)
        mass += np.exp(s) * np.array(tags)
    for block in (7, 3, 1):
        rows = -(-7 // block)
        x, f = np.zeros(rows * block), np.zeros(rows * block, bool)
        x[:7], f[:6] = u, True
        left, right = toxic_spans.forward_backward(x.reshape(rows, block), f.reshape(rows, block), change)
        assert np.allclose(1 / (1 + np.exp(-(left + right).ravel()[:7])), mass / total)


def corpus():
    rows, labels = [], []
    for i in range(400):
        words = prose(i, 40 + i % 60).split(" ")
        toxic = i % 8 == 0
        for k in range(1 + i % 3 if toxic else 0):
            words[(i + 7 * k) % len(words)] = ["zapfool", "grumscum,", "Blorkface."][(i + k) % 3]
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic), 1))
    return rows, labels


def test_held_out_documents_and_offsets(spark):
    rows, labels = corpus()
    marks = spark.createDataFrame([(i, q, t) for i, t, q in labels] + [(None, 1, 1), (7, 1, None)], "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in toxic_spans.scored(frame(spark, rows + [(900, None), (901, "")]), marks).collect()}
    truth = {i: t for i, t, _ in labels}
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(out[i].held_out == (i in set(held)) for i in truth)
    assert all(out[i].predicted == truth[i] for i in held)
    text = dict(rows)
    for i in held:
        found = {text[i][s.start:s.stop].lower().strip(".,") for s in out[i].spans}
        assert found <= {"zapfool", "grumscum", "blorkface"}
        assert bool(found) == bool(truth[i])
    assert out[900].predicted == out[901].predicted == 0
    assert all(0 <= r.score <= 1 for r in out.values())


def test_odd_texts_without_labels(spark, docs, odd, none):
    empty = spark.createDataFrame([], "doc_id long, toxic int")
    out = toxic_spans.scored(docs, empty).collect()
    assert len(out) == len(odd)
    assert {r.predicted for r in out} == {0}
    assert toxic_spans.scored(none, empty).count() == 0


def test_every_marker_is_kept_and_copies_count_once(spark):
    """More rare words in toxic documents than any cap; one toxic text copied many times makes no markers of its own words."""
    words = [f"{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{k:05d}zz" for k in range(9_000)]
    rows = [(i, f"{i} " + " ".join(words[300 * (i % 30):][:300])) for i in range(300)] + [(1000 + i, "solitary " + prose(1, 30)) for i in range(60)] + [(2000 + i, prose(i, 30)) for i in range(50)]
    labels = spark.createDataFrame([(i, int(i < 2000)) for i, _ in rows], "doc_id long, toxic int")
    docs = frame(spark, rows)
    files = toxic_spans.write_labels(labels)
    count, found = toxic_spans.find_markers(docs, files)
    blocks = np.bincount([i % 30 for i in range(300) if zlib.crc32(str(i).encode()) % 4 != 2], minlength=30)
    often = {w for k, w in enumerate(words) if blocks[k // 300] >= toxic_spans.MARKER_SHARE * (blocks[k // 300] + 1)}
    data = np.frombuffer(" ".join([*words, "solitary"]).encode(), np.uint8)
    starts, ends, _ = toxic_spans.word_bounds(data, np.array([0, len(data)]))
    hit = toxic_spans.Markers(count, found).among(toxic_spans.word_features(data, starts, ends)[:, 0])
    assert {w for w, h in zip([*words, "solitary"], hit.tolist(), strict=True) if h} == often
    assert sum(len(toxic_spans.read_file(n, "<u8")) for n in found.values()) > 20_000
