"""Operator 8: removal of repeated byte strings by threshold-bounded interval expansion.

Every string of ``LENGTH`` bytes holds an anchor: among the ``GRAM``-byte
strings inside it, the one with the least hash, leftmost on ties. Equal strings
have equal anchors at the same offset, so they can only meet under one anchor.

1. Anchors are counted by hash over the whole corpus; those met once are done.
2. For the others the bytes of all windows around the anchor (its context) go
   to the anchor's shard, equal contexts of a task once, with their number.
3. A shard holds a Burrows-Wheeler transform cut down to the anchor rows: rows
   sorted by the bytes from the anchor on, each with the bytes before it. All
   rows of an anchor are an interval. Breadth first, intervals are extended
   backward by one byte (a stable partition by the preceding byte, which is
   what the LF mapping does to an interval), so that common strings are found
   by growing left part; an interval of weight one is dropped, and no string
   is followed past ``LENGTH``. At left part e, neighbours in an interval whose
   common prefix from the anchor on is at least ``LENGTH - e`` are repeated.
   An anchor met more than ``HOT`` times could fill a task with contexts that
   differ around a common passage. Its windows are counted one by one instead,
   by string hash like the anchors themselves, so that its work spreads over
   all shards.
4. The windows found repeated, a bit for each e, are laid down sorted by
   context hash; tasks map them, mark their documents and cut the marked bytes.

The text itself is never shuffled, only contexts of repeated anchors are.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import _BYTE, _P, _PINV, _powers, mix, narrow, read_file, scratch, shards, text_pieces, write_file

LENGTH, GRAM = 200, 64
#: Bytes looked at together; positions within fit the low bits that break ties of anchors.
CHUNK, TIE_BITS = 1 << 19, 20
#: Text and contexts a task holds at a time.
PIECE, SENT = 1 << 20, 12 << 20
#: Occurrences from which the windows of an anchor are counted apart; either way gives the same result.
HOT = 20_000


def _window_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w neighbours, by blockwise running minima from both sides."""
    n = len(x)
    full = -(-n // w) * w
    pad = np.full(full, np.iinfo(x.dtype).max, x.dtype)
    pad[:n] = x
    block = pad.reshape(-1, w)
    ahead = np.minimum.accumulate(block, 1).ravel()
    behind = np.minimum.accumulate(block[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(behind[:n - w + 1], ahead[w - 1:n])


def anchors(data: np.ndarray, offs: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Per run of windows with one anchor: anchor hash, anchor place, first and last window start, context hash."""
    n, w = len(data), length - gram + 1
    ends = np.repeat(offs[1:], np.diff(offs))
    for c0 in range(0, max(0, n - length + 1), CHUNK):
        part = data[c0:c0 + CHUNK + length - 1]
        sums = np.empty(len(part) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(_BYTE[part] * _powers(_P, len(part)), out=sums[1:])
        back = _powers(_PINV, len(part) + 1)
        h = mix((sums[gram:] - sums[:-gram]) * back[:len(part) - gram + 1])
        low = np.uint64((1 << TIE_BITS) - 1)
        best = _window_min((h & ~low) | np.arange(len(h), dtype=np.uint64), w)
        at = (best & low).astype(np.int64)
        start = np.flatnonzero(np.arange(c0 + length, c0 + length + len(at)) <= ends[c0:c0 + len(at)])
        if not len(start):
            continue
        a = at[start]
        new = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (start[1:] != start[:-1] + 1)]))
        first, last, a = start[new], start[np.append(new[1:], len(start)) - 1], a[new]
        key = h[a]
        ctx = (sums[last + length] - sums[first]) * back[first]
        yield key, a + c0, first + c0, last + c0, mix(mix(ctx + key) + (a - first).astype(np.uint64) * np.uint64(_P) + (last - first).astype(np.uint64))


def _shard_of(h: np.ndarray, count: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(count) >> np.uint64(32)).astype(np.int64)


def window_hashes(data: np.ndarray, key: np.ndarray, first: np.ndarray, last: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash with its anchor) of every window of the runs of one call of ``anchors``."""
    if not len(key):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    n, a = last - first + 1, int(first.min())
    start = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
    part = data[a:int(last.max()) + length]
    sums = np.zeros(len(part) + 1, np.uint64)
    np.cumsum(_BYTE[part] * _powers(_P, len(part)), out=sums[1:])
    s = start - a
    return start, mix(mix((sums[s + length] - sums[s]) * _powers(_PINV, len(part))[s]) + np.repeat(key, n))


class Lookup:
    """Sorted 64-bit keys in files by shard, each with a fixed number of bytes beside it. Shards that were not written hold nothing; a written one must be there."""

    def __init__(self, folder: str, written: tuple[int, ...], count: int, beside: int = 0):
        self.folder, self.written, self.count, self.beside, self.opened = folder, frozenset(written), count, beside, {}

    def _shard(self, s: int):
        if s not in self.opened:
            if s in self.written:
                keys = read_file(f"{self.folder}/{s:06d}.key", "<u8")
                self.opened[s] = keys, read_file(f"{self.folder}/{s:06d}.val", np.uint8).reshape(len(keys), self.beside) if self.beside else None
            else:
                self.opened[s] = np.empty(0, np.uint64), np.empty((0, self.beside), np.uint8)
        return self.opened[s]

    def find(self, shard: np.ndarray, keys: np.ndarray):
        """(found, bytes beside) per key."""
        order = np.lexsort((keys, shard))
        cuts = np.searchsorted(shard[order], np.arange(self.count + 1))
        hit, values = np.zeros(len(keys), bool), np.zeros((len(keys), self.beside), np.uint8)
        for s in np.flatnonzero(np.diff(cuts)).tolist():
            have, beside = self._shard(s)
            if len(have):
                q = order[cuts[s]:cuts[s + 1]]
                at = np.minimum(np.searchsorted(have, keys[q]), len(have) - 1)
                hit[q] = have[at] == keys[q]
                if self.beside:
                    values[q] = np.where(hit[q][:, None], beside[at], 0)
        return hit, values


@lru_cache(4)
def lookup(folder: str, written: tuple[int, ...], count: int, beside: int = 0) -> Lookup:
    return Lookup(folder, written, count, beside)


def repeated_windows(keys: np.ndarray, contexts: list[bytes], left: np.ndarray, spare: np.ndarray, weight: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> np.ndarray:
    """Bits (row, e): the window that starts e bytes before the row's anchor occurs more than once, by weight.

    ``left`` is the number of context bytes before the anchor; windows reach from e = ``spare`` to e = ``left``.
    """
    n, w = len(keys), length - gram + 1
    out = np.zeros((n, w), bool)
    if not n:
        return out
    sort_key = [k + c[a:] for k, c, a in zip((x.tobytes() for x in keys.astype(">u8")), contexts, left.tolist(), strict=True)]
    order = np.array(sorted(range(n), key=sort_key.__getitem__))
    keys, left, spare, weight = keys[order], left[order], spare[order], weight[order]
    right = np.zeros((n, length), np.uint8)
    before = np.zeros((n, w - 1), np.uint8)
    for r, i in enumerate(order):
        c, a = contexts[i], left[r]
        right[r, :len(c) - a] = np.frombuffer(c, np.uint8, len(c) - a, a)
        before[r, :a] = np.frombuffer(c, np.uint8, a)[::-1]
    size = length - spare
    common = np.zeros(n, np.int64)
    for lo in range(1, n, 1 << 15):
        hi = min(n, lo + (1 << 15))
        differ = right[lo:hi] != right[lo - 1:hi - 1]
        far = np.where(differ.any(1), differ.argmax(1), length)
        common[lo:hi] = np.minimum(np.minimum(far, size[lo:hi]), size[lo - 1:hi - 1])
    common[1:][keys[1:] != keys[:-1]] = -1
    common[0] = -1
    row, interval = np.arange(n), np.cumsum(np.concatenate([[0], keys[1:] != keys[:-1]]))
    for e in range(w):
        if not len(row):
            break
        same_right = np.cumsum(common < length - e)
        run = np.flatnonzero(np.concatenate([[True], (interval[1:] != interval[:-1]) | (same_right[row[1:]] != same_right[row[:-1]])]))
        total = np.repeat(np.add.reduceat(weight[row], run), np.diff(np.append(run, len(row))))
        hit = (total > 1) & (spare[row] <= e)
        out[row[hit], e] = True
        go = left[row] > e
        row, interval = row[go], interval[go]
        if e == w - 1 or not len(row):
            break
        step = interval * 256 + before[row, e]
        back = np.argsort(step, kind="stable")
        row, step = row[back], step[back]
        first = np.concatenate([[True], step[1:] != step[:-1]])
        interval = np.cumsum(first) - 1
        live = np.bincount(interval, weight[row]) > 1
        keep = live[interval]
        row, interval = row[keep], interval[keep]
    result = np.zeros_like(out)
    result[order] = out
    return result


def _text_only(docs: DataFrame) -> DataFrame:
    return narrow(docs, text="text")


def find_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> tuple[str, str | None, str, int]:
    """Count and expand over all documents.

    The folders of repeated windows by context, of hot anchors (None without any) and of their repeated windows by string
    hash, and the number of shards of each.
    """
    spark, count = docs.sparkSession, shards(docs.sparkSession, 4)
    seen, windows, heated, strings = (scratch(spark, x) for x in ("anchors", "windows", "hot", "strings"))
    meta = np.dtype([("key", "<u8"), ("ctx", "<u8"), ("left", "<u2"), ("spare", "<u2"), ("weight", "<u4"), ("size", "<u4")])

    def blocks(shard, pack):
        cuts = np.searchsorted(shard, np.arange(count + 1))
        full = np.flatnonzero(np.diff(cuts))
        return pa.record_batch([pa.array(full.astype(np.int32)), pa.array([pack(cuts[i], cuts[i + 1]) for i in full], pa.binary())], ["shard", "block"])

    def counted(hashes, folder, often):
        """Keys of ``hashes`` (of the bytes of a piece) met more than once, in ``folder``, and those met more than ``hot`` times in ``often``; the number of the latter."""

        def count_keys(batches):
            def emit(held):
                h, c = np.unique(np.concatenate(held), return_counts=True)
                number = _packed_count(c)
                return blocks(_shard_of(h, count), lambda a, b: h[a:b].tobytes() + number[a:b].tobytes())

            held, n = [], 0
            for b in batches:
                for _, _, data, offs in text_pieces(b.column(0), PIECE):
                    for key in hashes(data, offs):
                        held.append(key)
                        n += len(key)
                    if n > 1_500_000:
                        yield emit(held)
                        held, n = [], 0
            if n:
                yield emit(held)

        def keep_repeated(key, block):
            s, h, number = key[0].as_py(), [], []
            for x in block.column("block"):
                raw = x.as_py()
                n = len(raw) // 9
                h.append(np.frombuffer(raw, "<u8", n))
                number.append(np.frombuffer(raw, np.uint8, n, 8 * n))
            h, number = np.concatenate(h), np.concatenate(number)
            order = np.argsort(h, kind="stable")
            h, number = h[order], _least_count(number[order])
            first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
            total = np.add.reduceat(number, first)
            write_file(f"{folder}/{s:06d}.key", h[first][total > 1].tobytes())
            many = total > hot
            if often is not None and many.any():
                write_file(f"{often}/{s:06d}.key", h[first][many].tobytes())
            return pa.table({"shard": pa.array([s], pa.int32()), "n": pa.array([int(many.sum())])})

        made = _text_only(docs).mapInArrow(count_keys, "shard int, block binary").groupBy("shard").applyInArrow(keep_repeated, "shard int, n long")
        got = made.collect()  # a row a shard
        return (folder, tuple(sorted(r.shard for r in got))), (often, tuple(sorted(r.shard for r in got if r.n)))

    def hot_windows(data, offs):
        known = lookup(*heated, count)
        for key, _, first, last, _ in anchors(data, offs, length, gram):
            hit = np.flatnonzero(known.find(_shard_of(key, count), key)[0])
            yield window_hashes(data, key[hit], first[hit], last[hit], length)[1]

    seen, heated = counted(lambda data, offs: (key for key, *_ in anchors(data, offs, length, gram)), seen, heated)
    any_hot = len(heated[1]) > 0
    if any_hot:
        strings, _ = counted(hot_windows, strings, None)

    def send_contexts(batches):
        known, apart = lookup(*seen, count), lookup(*heated, count) if any_hot else None

        def emit(rows):
            m = np.array([(*k, v[1], v[2], v[3], len(v[0])) for k, v in rows.items()], meta)
            texts = [v[0] for v in rows.values()]
            order = np.argsort(_shard_of(m["key"], count), kind="stable")
            m = m[order]

            def pack(a, b):
                body = b"".join(texts[i] for i in order[a:b])
                return int(b - a).to_bytes(8, "little") + m[a:b].tobytes() + zstandard.ZstdCompressor(level=3).compress(body)

            return blocks(_shard_of(m["key"], count), pack)

        rows, held = {}, 0
        for b in batches:
            for _, _, data, offs in text_pieces(b.column(0), PIECE):
                raw = data.tobytes()
                for key, a, first, last, ctx in anchors(data, offs, length, gram):
                    hit, _ = known.find(_shard_of(key, count), key)
                    if apart is not None:
                        hit &= ~apart.find(_shard_of(key, count), key)[0]
                    hit = np.flatnonzero(hit)
                    for k, c, p, lo, hi in zip(key[hit].tolist(), ctx[hit].tolist(), a[hit].tolist(), first[hit].tolist(), last[hit].tolist(), strict=True):
                        got = rows.get((k, c))
                        if got is None:
                            rows[k, c] = [raw[lo:hi + length], p - lo, p - hi, 1]
                            held += hi + length - lo
                        else:
                            got[3] += 1
                if held > SENT:
                    yield emit(rows)
                    rows, held = {}, 0
        if rows:
            yield emit(rows)

    def expand(key, block):
        s, ms, texts = key[0].as_py(), [], []
        for x in block.column("block"):
            raw = x.as_py()
            n = int.from_bytes(raw[:8], "little")
            m = np.frombuffer(raw, meta, n, 8)
            body, at = zstandard.ZstdDecompressor().decompress(raw[8 + n * meta.itemsize:]), 0
            ms.append(m)
            for size in m["size"].tolist():
                texts.append(body[at:at + size])
                at += size
        m = np.concatenate(ms)
        order = np.lexsort((m["ctx"], m["key"]))
        m = m[order]
        first = np.flatnonzero(np.concatenate([[True], (m["key"][1:] != m["key"][:-1]) | (m["ctx"][1:] != m["ctx"][:-1])]))
        weight = np.add.reduceat(m["weight"].astype(np.int64), first)
        one = m[first]
        bits = repeated_windows(one["key"], [texts[i] for i in order[first]], one["left"].astype(np.int64), one["spare"].astype(np.int64), weight, length, gram)
        some = bits.any(1)
        ctx, bits = one["ctx"][some], np.packbits(bits[some], axis=1)
        order = np.argsort(ctx)
        write_file(f"{windows}/{s:06d}.val", bits[order].tobytes())
        write_file(f"{windows}/{s:06d}.key", ctx[order].tobytes())
        return pa.table({"shard": pa.array([s], pa.int32()), "n": pa.array([len(ctx)])})

    made = _text_only(docs).mapInArrow(send_contexts, "shard int, block binary").groupBy("shard").applyInArrow(expand, "shard int, n long").collect()
    return (windows, tuple(sorted(r.shard for r in made))), heated if any_hot else None, strings, count


def _packed_count(c: np.ndarray) -> np.ndarray:
    """A count in one byte: exact up to 128, above it a quarter of a power of two, rounded down."""
    return np.where(c <= 128, c, 128 + np.minimum(127, np.floor(4 * np.log2(np.maximum(c, 128) / 128)))).astype(np.uint8)


def _least_count(b: np.ndarray) -> np.ndarray:
    x = b.astype(np.float64)
    return np.where(x <= 128, x, np.floor(128 * 2 ** ((x - 128) / 4)))


def _covered(data, offs, found: tuple, length: int, gram: int) -> np.ndarray:
    windows, heated, strings, count = found
    have, change = lookup(*windows, count, -(-(length - gram + 1) // 8)), np.zeros(len(data) + 1, np.int32)
    for key, a, low, high, ctx in anchors(data, offs, length, gram):
        if heated is not None:
            hot = np.flatnonzero(lookup(*heated, count).find(_shard_of(key, count), key)[0])
            start, string = window_hashes(data, key[hot], low[hot], high[hot], length)
            start = start[lookup(*strings, count).find(_shard_of(string, count), string)[0]]
            np.add.at(change, start, 1)
            np.add.at(change, start + length, -1)
        hit, bits = have.find(_shard_of(key, count), ctx)
        hit = np.flatnonzero(hit)
        row, e = np.nonzero(np.unpackbits(bits[hit], axis=1, count=length - gram + 1))
        start = a[hit][row] - e
        np.add.at(change, start, 1)
        np.add.at(change, start + length, -1)
    return np.cumsum(change[:-1]) > 0


def without_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (the bytes left).

    A byte goes when some string of ``length`` bytes that covers it also starts anywhere else, in the same document or
    another; matches never cross documents. A null text is empty. Shorter texts lose nothing.
    """
    repeated = find_repeats(docs, length, gram, hot)

    def run(batches):
        for b in batches:
            for lo, hi, data, offs in text_pieces(b.column(1), PIECE):
                gone = _covered(data, offs, repeated, length, gram)
                rise = gone.copy()
                rise[1:] &= ~gone[:-1]
                begin = offs[:-1][np.diff(offs) > 0]
                rise[begin] = gone[begin]
                removed, spans = (np.diff(np.concatenate([[0], np.cumsum(x)])[offs]) for x in (gone, rise))
                kept = []
                for i in range(hi - lo):
                    part = data[offs[i]:offs[i + 1]]
                    kept.append((part[~gone[offs[i]:offs[i + 1]]] if removed[i] else part).tobytes())
                yield pa.record_batch([b.column(0).slice(lo, hi - lo), pa.array(np.diff(offs)), pa.array(removed.astype(np.int64)), pa.array(spans.astype(np.int64)),
                                       pa.array([hashlib.sha256(x).hexdigest() for x in kept]), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return narrow(docs, doc_id="doc_id", text="text").mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
