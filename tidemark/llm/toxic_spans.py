"""Operator 4: toxic spans by a linear-chain conditional random field, summed up to document scores.

Labels are known per document only, so tokens are labelled first: features of
a word (itself and its leading bytes) are counted over all labelled training
documents, and those that toxic documents hold and others don't are markers. A
token of a toxic document with a marker is toxic, every other token is not.
The field has one weight per feature and one per change of tag. It is fitted by
gradient ascent on a bounded sample of segments (about ``SEGMENTS`` of
``SEGMENT`` tokens at most, those with the least hashes, half of them with toxic
tokens if there are so many). Forward-backward over whole texts gives each token's marginal;
the greatest and the sum of a document give its score by a logistic curve
fitted on about ``CALIBRATED_ON`` labelled training documents at most.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import _BYTE, _LOWER, _P, _PINV, _powers, mix, narrow, read_file, scratch, shards, stored, text_pieces, thinned, word_bounds, write_file

FOLDS, HELD_OUT, THRESHOLD = 4, 2, 0.3
LEADING = (4, 5, 6, 7, 8)
MARKER_DOCS, MARKER_SHARE = 3, 0.85
SEGMENTS, SEGMENT, CALIBRATED_ON = 8_000, 48, 20_000
STEPS, RATE, RIDGE, BLOCK = 60, 0.3, 1e-6, 128


def held_out(ids: list) -> np.ndarray:
    """crc32 of doc_id as text, modulo ``FOLDS``; a null doc_id reads as empty text."""
    return np.fromiter((zlib.crc32(b"" if i is None else str(i).encode()) % FOLDS == HELD_OUT for i in ids), bool, len(ids))


def word_features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Feature hashes (word, leading bytes) of ascending words, A-Z read as a-z; a short word repeats itself."""
    out = np.empty((len(starts), 1 + len(LEADING)), np.uint64)
    lo = 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + (1 << 20), "right")))
        a = int(starts[lo])
        part = _LOWER[data[a:int(ends[hi - 1])]]
        sums = np.empty(len(part) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(_BYTE[part] * _powers(_P, len(part)), out=sums[1:])
        s, e = starts[lo:hi] - a, ends[lo:hi] - a
        back = _powers(_PINV, len(part))[s]
        for k, n in enumerate((None, *LEADING)):
            stop = e if n is None else np.minimum(e, s + n)
            out[lo:hi, k] = mix((sums[stop] - sums[s]) * back)
        lo = hi
    return out


def _distinct(data, starts, ends):
    """(code of each word, features of each distinct word)."""
    whole = np.empty(len(starts), np.uint64)
    lo = 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + (1 << 20), "right")))
        a = int(starts[lo])
        part = _LOWER[data[a:int(ends[hi - 1])]]
        sums = np.empty(len(part) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(_BYTE[part] * _powers(_P, len(part)), out=sums[1:])
        s, e = starts[lo:hi] - a, ends[lo:hi] - a
        whole[lo:hi] = (sums[e] - sums[s]) * _powers(_PINV, len(part))[s]
        lo = hi
    codes, _ = pd.factorize(whole)
    first = np.full(int(codes.max()) + 1 if len(codes) else 0, -1, np.int64)
    first[codes[::-1]] = np.arange(len(codes))[::-1]
    return codes, word_features(data, starts[first], ends[first])


class Labels:
    """toxic by doc_id, from mapped sorted files."""

    def __init__(self, files: list[tuple[int, int, str]]):
        self.parts = [(low, high, read_file(name, "<i8").reshape(2, -1)) for low, high, name in files]

    def of(self, ids: list) -> np.ndarray:
        """1, 0, or -1 where there is no label."""
        x = np.array([-(1 << 63) if i is None else i for i in ids], np.int64)
        out = np.full(len(x), -1, np.int64)
        for low, high, rows in self.parts:
            inside = np.flatnonzero((x >= low) & (x <= high))
            at = np.minimum(np.searchsorted(rows[0], x[inside]), rows.shape[1] - 1)
            hit = rows[0][at] == x[inside]
            out[inside[hit]] = rows[1][at[hit]]
        return out


def write_labels(labels: DataFrame) -> list[tuple[int, int, str]]:
    """Sorted label files, one a partition: least and greatest doc_id, name. Of repeated labels the greatest counts."""
    folder = scratch(labels.sparkSession, "labels")
    one = narrow(labels, doc_id="doc_id", toxic="toxic").where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max(F.col("toxic").cast("long")).alias("toxic"))

    def save(batches):
        parts = [(b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False)) for b in batches if b.num_rows]
        if parts:
            ids, toxic = (np.concatenate(x) for x in zip(*parts, strict=True))
            name = f"{folder}/{int(ids[0]) & (1 << 64) - 1:016x}.ids"
            write_file(name, ids.astype("<i8").tobytes(), toxic.astype("<i8").tobytes())
            yield pa.record_batch([pa.array([int(ids[0])]), pa.array([int(ids[-1])]), pa.array([name])], ["low", "high", "name"])

    made = one.repartitionByRange("doc_id").sortWithinPartitions("doc_id").mapInArrow(save, "low long, high long, name string").collect()
    return sorted((r.low, r.high, r.name) for r in made)


def _labelled_pieces(batches, files, copies=None):
    """(ids, toxic, data, offs) of the labelled training documents; with ``copies``, without those it names."""
    labels, copied = Labels(files), None if copies is None else Copies(copies)
    for b in batches:
        ids = b.column(0).to_pylist()
        toxic = labels.of(ids)
        use = (toxic >= 0) & ~held_out(ids)
        if copied is not None:
            use &= ~copied.spare(ids, toxic, b.column(2).to_numpy(zero_copy_only=False))
        toxic, ids = toxic[use], np.array([0 if i is None else i for i in ids], np.int64)[use]
        for lo, hi, data, offs in text_pieces(b.column(1).filter(pa.array(use))):
            yield ids[lo:hi], toxic[lo:hi], data, offs


class Copies:
    """The doc_id that stands for each text that several labelled training documents hold, by hash of text and label, from mapped files."""

    def __init__(self, files: list[tuple[int, int, str]]):
        self.parts = [(low, high, read_file(name, "<i8").reshape(2, -1)) for low, high, name in files]

    def spare(self, ids: list, toxic: np.ndarray, text_hash: np.ndarray) -> np.ndarray:
        """Whether another document stands for the text; rows that share the doc_id all stay."""
        x, key = np.array([-(1 << 63) if i is None else i for i in ids], np.int64), _text_key(text_hash, toxic)
        out = np.zeros(len(x), bool)
        for low, high, rows in self.parts:
            inside = np.flatnonzero((key >= low) & (key <= high))
            at = np.minimum(np.searchsorted(rows[0], key[inside]), rows.shape[1] - 1)
            out[inside] = (rows[0][at] == key[inside]) & (rows[1][at] != x[inside])
        return out


def _text_key(text_hash: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    return (mix(text_hash.astype(np.int64).view(np.uint64)) ^ np.where(toxic == 1, np.uint64(1), np.uint64(0))).view(np.int64)


def _hashed(docs: DataFrame) -> DataFrame:
    return narrow(docs, doc_id="doc_id", text="text").withColumn("text_hash", F.xxhash64("text"))


def write_copies(docs: DataFrame, files: list) -> list[tuple[int, int, str]]:
    """Sorted files of the texts held by several labelled training documents, as in ``write_labels``; the least doc_id stands for a text."""
    folder = scratch(docs.sparkSession, "copies")

    def keys(batches):
        labels = Labels(files)
        for b in batches:
            ids = b.column(0).to_pylist()
            toxic = labels.of(ids)
            use = (toxic >= 0) & ~held_out(ids)
            key = _text_key(b.column(1).to_numpy(zero_copy_only=False), toxic)
            yield pa.record_batch([pa.array(key[use]), b.column(0).filter(pa.array(use))], ["key", "doc_id"])

    def save(batches):
        parts = [(b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False)) for b in batches if b.num_rows]
        if parts:
            key, ids = (np.concatenate(x) for x in zip(*parts, strict=True))
            name = f"{folder}/{int(key[0]) & (1 << 64) - 1:016x}.copies"
            write_file(name, key.astype("<i8").tobytes(), ids.astype("<i8").tobytes())
            yield pa.record_batch([pa.array([int(key[0])]), pa.array([int(key[-1])]), pa.array([name])], ["low", "high", "name"])

    seen = _hashed(docs).select("doc_id", "text_hash").mapInArrow(keys, "key long, doc_id long").groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.max("doc_id").alias("last"))
    several = stored(seen.where("last > doc_id").select("key", "doc_id"), "copied")
    made = several.repartitionByRange("key").sortWithinPartitions("key").mapInArrow(save, "low long, high long, name string").collect()
    return sorted((r.low, r.high, r.name) for r in made)


class Markers:
    """Hashes of marker features, from mapped files sorted within ranges of the hash."""

    def __init__(self, count: int, files: dict[int, str]):
        self.count, self.files, self.opened = count, files, {}

    def among(self, x: np.ndarray) -> np.ndarray:
        flat = x.ravel()
        order = np.argsort(flat)
        shard = (flat[order] >> np.uint64(32)) * np.uint64(self.count) >> np.uint64(32)
        cuts = np.searchsorted(shard, np.arange(self.count + 1).astype(np.uint64))
        out = np.zeros(len(flat), bool)
        for s in np.flatnonzero(np.diff(cuts)).tolist():
            if s in self.files:
                if s not in self.opened:
                    self.opened[s] = read_file(self.files[s], "<u8")
                at = order[cuts[s]:cuts[s + 1]]
                out[at] = _among(self.opened[s], flat[at])
        return out.reshape(x.shape)


def find_markers(docs: DataFrame, files: list) -> tuple[int, dict[int, str]]:
    """All features held by enough toxic and few other training documents, counted over all of them, equal texts with one label once.

    Number of hash ranges, and the file of sorted hashes of each range that has any.
    """
    count, folder, copies = shards(docs.sparkSession, 1), scratch(docs.sparkSession, "markers"), write_copies(docs, files)

    def count_features(batches):
        def emit(held):
            key = np.concatenate([k for k, _, _ in held])
            order = np.argsort(key, kind="stable")
            key = key[order]
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            a, b = (np.add.reduceat(np.concatenate([h[i] for h in held])[order], first).astype("<u4") for i in (1, 2))
            key = key[first]
            cuts = np.searchsorted((key >> np.uint64(32)) * np.uint64(count) >> np.uint64(32), np.arange(count + 1))
            full = np.flatnonzero(np.diff(cuts))
            pack = [key[x:y].tobytes() + a[x:y].tobytes() + b[x:y].tobytes() for x, y in zip(cuts[full], cuts[full + 1], strict=True)]
            return pa.record_batch([pa.array(full.astype(np.int32)), pa.array(pack, pa.binary())], ["shard", "block"])

        held, n = [], 0
        for _, toxic, data, offs in _labelled_pieces(batches, files, copies):
            starts, ends, first = word_bounds(data, offs)
            codes, features = _distinct(data, starts, ends)
            row = np.repeat(np.arange(len(toxic)), np.diff(first))
            pairs = np.unique(row.astype(np.int64) << 32 | codes)
            row, code = pairs >> 32, pairs & 0xFFFFFFFF
            fcode, names = pd.factorize(features.ravel())
            fcode = fcode.reshape(features.shape)
            both = np.unique((row[:, None] << 32 | fcode[code]).ravel())
            f, y = both & 0xFFFFFFFF, toxic[both >> 32]
            held.append((names, np.bincount(f, y, len(names)).astype(np.int64), np.bincount(f, 1 - y, len(names)).astype(np.int64)))
            n += len(names)
            if n > 4_000_000:
                yield emit(held)
                held, n = [], 0
        if n:
            yield emit(held)

    def select(key, block):
        keys, a, b = [], [], []
        for x in block.column("block"):
            raw = x.as_py()
            n = len(raw) // 16
            keys.append(np.frombuffer(raw, "<u8", n))
            a.append(np.frombuffer(raw, "<u4", n, 8 * n))
            b.append(np.frombuffer(raw, "<u4", n, 12 * n))
        k = np.concatenate(keys)
        order = np.argsort(k, kind="stable")
        k = k[order]
        first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
        a, b = (np.add.reduceat(np.concatenate(v)[order].astype(np.int64), first) for v in (a, b))
        good = (a >= MARKER_DOCS) & (a >= MARKER_SHARE * (a + b + 1))
        if not good.any():
            return pa.table({"shard": pa.array([], pa.int32()), "name": pa.array([], pa.string())})
        name = f"{folder}/{key[0].as_py():06d}.markers"
        write_file(name, k[first][good].tobytes())
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "name": pa.array([name])})

    found = _hashed(docs).mapInArrow(count_features, "shard int, block binary").groupBy("shard").applyInArrow(select, "shard int, name string")
    return count, {r.shard: r.name for r in found.collect()}


def _among(sorted_keys: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(sorted_keys):
        return np.zeros(x.shape, bool)
    at = np.minimum(np.searchsorted(sorted_keys, x), len(sorted_keys) - 1)
    return sorted_keys[at] == x


def sample_segments(docs: DataFrame, files: list, markers: tuple[int, dict[int, str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, tags, present) of the sampled training segments: about ``SEGMENTS`` at most, whatever the corpus.

    One pass counts the segments of both kinds, a second one sends those whose hash lies below the share wanted.
    """
    wide, rows = 1 + len(LEADING), narrow(docs, doc_id="doc_id", text="text")

    def segments(batches):
        known = Markers(*markers)
        for ids, toxic, data, offs in _labelled_pieces(batches, files):
            starts, ends, first = word_bounds(data, offs)
            if not len(starts):
                continue
            codes, features = _distinct(data, starts, ends)
            row = np.repeat(np.arange(len(toxic)), np.diff(first))
            tag = np.zeros(len(codes), bool)
            held = np.flatnonzero(toxic[row] == 1)
            some = np.unique(codes[held])
            marked = np.zeros(len(features), bool)
            marked[some] = known.among(features[some]).any(1)
            tag[held] = marked[codes[held]]
            part = (np.arange(len(codes)) - first[row]) // SEGMENT
            cut = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (part[1:] != part[:-1])]))
            some = np.add.reduceat(tag.astype(np.int64), cut) > 0
            name = mix(mix(ids[row[cut]].view(np.uint64)) + part[cut].astype(np.uint64)) >> np.uint64(1)
            yield codes, features, tag, cut, np.append(cut[1:], len(codes)), np.where(some, 0, np.where(toxic[row[cut]] == 0, 1, 2)), name

    def count(batches):
        sums = np.zeros(2, np.int64)
        for *_, kind, _ in segments(batches):
            sums += np.bincount(kind, minlength=3)[:2]
        yield pa.record_batch([pa.array(sums[:1]), pa.array(sums[1:])], ["with_tag", "without"])

    n = rows.mapInArrow(count, "with_tag long, without long").agg(F.sum("with_tag"), F.sum("without")).first()
    share = np.array([min(1.0, SEGMENTS / 2 / k) if k else 0.0 for k in n] + [0.0])

    def send(batches):
        for codes, features, tag, start, stop, kind, name in segments(batches):
            keep = np.flatnonzero(name < share[kind] * 2.0 ** 63)
            yield pa.record_batch([pa.array([features[codes[start[i]:stop[i]]].tobytes() for i in keep], pa.binary()), pa.array([tag[start[i]:stop[i]].tobytes() for i in keep], pa.binary())], ["features", "tags"])

    got = sorted((bytes(r[0]), bytes(r[1])) for r in rows.mapInArrow(send, "features binary, tags binary").collect())
    x, y, there = np.zeros((len(got), SEGMENT, wide), np.uint64), np.zeros((len(got), SEGMENT), bool), np.zeros((len(got), SEGMENT), bool)
    for i, (features, tags) in enumerate(got):
        m = len(tags)
        x[i, :m] = np.frombuffer(features, np.uint64).reshape(m, wide)
        y[i, :m] = np.frombuffer(tags, bool)
        there[i, :m] = True
    return x, y, there


def forward_backward(u: np.ndarray, follows: np.ndarray, change: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds of tag 1 from the left (with the token's own score) and from the right.

    ``u`` scores tag 1 of each token in rows of tokens; ``follows[i, t]``: token t + 1 belongs to the same text. The last
    column of a row goes on in the first of the next row where it is followed. ``change`` holds the scores of 0-1, 1-0
    and 1-1; 0-0 has none. Rows are filled together from guessed ends until no end moves.
    """
    t01, t10, t11 = change
    n, m = u.shape
    left, right = np.zeros_like(u), np.zeros_like(u)
    goes_on = np.concatenate([[False], follows[:-1, -1]]) if n else np.zeros(0, bool)

    def step(r):
        return np.logaddexp(t01, r + t11) - np.logaddexp(0, r + t10)

    guess = np.where(goes_on, -5.0, 0.0)
    while n:
        r = guess
        for t in range(m):
            prior = np.where(goes_on, step(r), 0.0) if t == 0 else np.where(follows[:, t - 1], step(r), 0.0)
            r = left[:, t] = prior + u[:, t]
        new = np.where(goes_on, np.concatenate([[0.0], r[:-1]]), 0.0)
        if np.allclose(new, guess, rtol=0, atol=1e-12):
            break
        guess = new
    into = np.zeros(n)
    while n:
        s = into
        for t in range(m - 1, -1, -1):
            nxt = (s if t == m - 1 else right[:, t + 1] + u[:, t + 1])
            s = right[:, t] = np.where(follows[:, t], np.logaddexp(t10, t11 + nxt) - np.logaddexp(0, t01 + nxt), 0.0)
        new = np.where(follows[:, -1], np.append((right + u)[1:, 0], 0.0), 0.0)
        if np.allclose(new, into, rtol=0, atol=1e-12):
            break
        into = new
    return left, right


def fit_field(x: np.ndarray, y: np.ndarray, there: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, np.ndarray]:
    """Gradient ascent (Adam) on the conditional likelihood: (sorted features, weights, bias, change scores)."""
    names, code = np.unique(x[there], return_inverse=True)
    code = code.reshape(-1, x.shape[2])
    w, bias, change = np.zeros(len(names)), -4.0, np.array([0.0, 0.0, 0.0])
    if not len(names):
        return names, w, -8.0, change
    follows = np.zeros_like(there)
    follows[:, :-1] = there[:, 1:]
    tokens, gold = there.sum(), y[there].astype(float)
    pair = follows[:, :-1]
    gold_pairs = np.array([(~y[:, :-1] & y[:, 1:] & pair).sum(), (y[:, :-1] & ~y[:, 1:] & pair).sum(), (y[:, :-1] & y[:, 1:] & pair).sum()], float)
    theta = np.concatenate([w, [bias], change])
    m1, m2, size = np.zeros_like(theta), np.zeros_like(theta), len(names)
    for it in range(1, STEPS + 1):
        w, bias, change = theta[:size], theta[size], theta[size + 1:]
        u = np.zeros(there.shape)
        u[there] = w[code].sum(1) + bias
        left, right = forward_backward(u, follows, change)
        p = 1 / (1 + np.exp(-np.clip(left + right, -40, 40)))[there]
        r, s = left[:, :-1][pair], (right + u)[:, 1:][pair]
        e = np.stack([np.zeros_like(r), change[0] + s, r + change[1], r + change[2] + s])
        e = np.exp(e - e.max(0))
        e /= e.sum(0)
        off = gold - p
        grad = np.concatenate([np.bincount(code.ravel(), np.repeat(off, code.shape[1]), size), [off.sum()], gold_pairs - e[1:].sum(1)]) / tokens - RIDGE * theta
        m1, m2 = 0.9 * m1 + 0.1 * grad, 0.99 * m2 + 0.01 * grad ** 2
        theta = theta + RATE * (m1 / (1 - 0.9 ** it)) / (np.sqrt(m2 / (1 - 0.99 ** it)) + 1e-9)
    return names, theta[:size], float(theta[size]), theta[size + 1:]


def token_spans(docs: DataFrame, field) -> DataFrame:
    """doc_id, peak (greatest log-odds), mass (sum of marginals), spans (start, stop in code points, marginal >= 0.5) per document."""
    shared = docs.sparkSession.sparkContext.broadcast(field)
    span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("p", pa.float64())]))

    def run(batches):
        names, w, bias, change = shared.value
        for b in batches:
            for lo, hi, data, offs in text_pieces(b.column(1)):
                starts, ends, first = word_bounds(data, offs)
                peak, mass, spans = np.full(hi - lo, -20.0), np.zeros(hi - lo), [[] for _ in range(hi - lo)]
                n_words = np.diff(first)
                if len(starts):
                    codes, features = _distinct(data, starts, ends)
                    at = np.minimum(np.searchsorted(names, features), max(0, len(names) - 1))
                    known = (names[at] == features) if len(names) else np.zeros(features.shape, bool)
                    score = (np.where(known, w[at], 0.0).sum(1) if len(names) else np.zeros(len(features))) + bias
                    rows = -(-n_words // BLOCK)
                    begin = np.concatenate([[0], np.cumsum(rows)])[:-1] * BLOCK
                    row = np.repeat(np.arange(hi - lo), n_words)
                    slot = begin[row] + np.arange(len(codes)) - first[row]
                    u, follows = np.zeros(rows.sum() * BLOCK), np.zeros(rows.sum() * BLOCK, bool)
                    u[slot] = score[codes]
                    follows[slot] = np.append(row[1:] == row[:-1], False)
                    left, right = forward_backward(u.reshape(-1, BLOCK), follows.reshape(-1, BLOCK), change)
                    odds = np.clip((left + right).ravel()[slot], -20, 20)
                    p = 1 / (1 + np.exp(-odds))
                    full = np.flatnonzero(n_words)
                    peak[full] = np.maximum.reduceat(odds, first[full])
                    mass[full] = np.add.reduceat(p, first[full])
                    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                    for t in np.flatnonzero(odds >= 0):
                        o = points[offs[row[t]]]
                        spans[row[t]].append({"start": int(points[starts[t]] - o), "stop": int(points[ends[t]] - o), "p": float(p[t])})
                yield pa.record_batch([b.column(0).slice(lo, hi - lo), pa.array(peak), pa.array(mass), pa.array(spans, span)], ["doc_id", "peak", "mass", "spans"])

    return narrow(docs, doc_id="doc_id", text="text").mapInArrow(run, "doc_id long, peak double, mass double, spans array<struct<start: bigint, stop: bigint, p: double>>")


def fit_curve(peak: np.ndarray, mass: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic curve on the two sums by Newton steps with a small ridge; without both labels, the share of toxic ones."""
    x = np.stack([np.ones(len(y)), peak / 10, np.log1p(mass)], 1) if len(y) else np.zeros((0, 3))
    if not len(y) or y.min() == y.max():
        return np.array([np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)) if len(y) else -3.0, 0.0, 0.0])
    b = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(3)
        move = np.linalg.solve(h, x.T @ (y - p) - 1e-2 * b)
        b = b + np.clip(move, -5, 5)
        if np.abs(move).max() < 1e-9:
            break
    return b


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, n_spans, spans per document.

    Learns only from labelled documents outside the held-out fold. Empty and null texts have no token and get the curve's
    least score. Without labels no feature is a marker and all documents get one low score. Rows sharing a doc_id share
    its label; other columns are not read.
    """
    files = write_labels(labels)
    markers = find_markers(docs, files)
    field = fit_field(*sample_segments(docs, files, markers))
    sums = stored(token_spans(docs, field), "spans")

    @F.pandas_udf("boolean")
    def held(ids):
        return pd.Series(held_out([None if i is None or i != i else int(i) for i in ids]))

    sums = sums.withColumn("held_out", held("doc_id"))
    known = narrow(labels, l_doc="doc_id", toxic="toxic").where("toxic IS NOT NULL").groupBy("l_doc").agg(F.max("toxic").cast("double").alias("toxic"))
    train = sums.where(~F.col("held_out")).select("doc_id", "peak", "mass").join(known, F.col("doc_id") == F.col("l_doc"))
    got = thinned(stored(train, "curve"), F.xxhash64("doc_id"), CALIBRATED_ON).select("peak", "mass", "toxic").orderBy("peak", "mass", "toxic").toPandas()
    a, b, c = map(float, fit_curve(*(got[k].to_numpy(float) for k in ("peak", "mass", "toxic"))))
    score = 1 / (1 + F.exp(-(F.lit(a) + F.lit(b) * F.col("peak") / 10 + F.lit(c) * F.log1p("mass"))))
    out = sums.withColumn("score", score)
    return out.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), F.size("spans").cast("long").alias("n_spans"), "spans")
