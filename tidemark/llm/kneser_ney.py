"""Operator 3: interpolated modified Kneser-Ney language model of word pairs.

Everything is counted in Spark over all training documents and laid down in
the shared folder as sorted arrays, cut into shards by word hash:

* ``h``    sorted 64-bit word hashes; a word's id is its place in all shards
* ``c``    count of each word                      ``cc``   distinct words before it
* ``k``    sorted pair keys (id of the first word << 32 | id of the second)
* ``n``    count of each pair                      ``ctx``  per first word: count, and pairs met once, twice, more often

Tasks count each piece of text in numpy first and send one packed block per
shard, so a frequent word or pair costs a task one entry. Scoring maps the
shards and finds each piece's distinct words and pairs by binary search. The
end of a text is a token; its beginning is a context only.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import hash_words, narrow, read_file, scratch, shards, stored, text_pieces, word_bounds, write_file

#: Hash of the end token; a word has it with probability 2**-64.
END = np.uint64(0x7F4A7C159E3779B9)
FOLDS, HELD_OUT = 7, 2
#: Distinct entries a task gathers before it sends them on.
GATHERED = 4_000_000
_CTX = np.dtype([("total", "<u8"), ("n1", "<u4"), ("n2", "<u4"), ("n3", "<u4")])


def held_out(ids: list, folds: int = FOLDS, part: int = HELD_OUT) -> np.ndarray:
    """crc32 of doc_id as text, modulo ``folds``; a null doc_id reads as empty text."""
    return np.fromiter((zlib.crc32(b"" if i is None else str(i).encode()) % folds == part for i in ids), bool, len(ids))


def _tokens(data, offs):
    """Token hashes of a piece with each text's end, and where each text begins."""
    starts, ends, first = word_bounds(data, offs)
    rows = len(offs) - 1
    tokens = np.empty(len(starts) + rows, np.uint64)
    begin = first + np.arange(rows + 1)
    last = begin[1:] - 1
    place = np.ones(len(tokens), bool)
    place[last] = False
    tokens[place] = hash_words(data, starts, ends)
    tokens[last] = END
    return tokens, begin


def _summed(keys: list, counts: list) -> tuple[np.ndarray, np.ndarray]:
    k, c = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k, kind="stable")
    k, c = k[order], c[order]
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.empty(0, np.int64)
    return k[first], np.add.reduceat(c, first) if len(k) else c


def _pack(*columns: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"".join(np.ascontiguousarray(c).tobytes() for c in columns))


def _unpack(block: bytes, *dtypes: str) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(block)
    n, out, at = len(raw) // sum(np.dtype(d).itemsize for d in dtypes), [], 0
    for d in dtypes:
        out.append(np.frombuffer(raw, d, n, at))
        at += n * np.dtype(d).itemsize
    return out


def _training(batches):
    for b in batches:
        held = held_out(b.column(0).to_pylist())
        for lo, hi, data, offs in text_pieces(b.column(1).filter(pa.array(~held))):
            yield _tokens(data, offs)


def _gather(parts, emit):
    """Sum (keys, counts) of pieces; emit whenever enough distinct entries are held."""
    keys, counts, held = [], [], 0
    for k, c in parts:
        keys.append(k)
        counts.append(c)
        held += len(k)
        if held > GATHERED:
            yield emit(*_summed(keys, counts))
            keys, counts, held = [], [], 0
    if held:
        yield emit(*_summed(keys, counts))


def _blocks(cuts: np.ndarray, *columns: np.ndarray) -> pa.RecordBatch:
    full = np.flatnonzero(np.diff(cuts))
    return pa.record_batch([pa.array(full.astype(np.int32)), pa.array([_pack(*[c[cuts[i]:cuts[i + 1]] for c in columns]) for i in full], pa.binary())], ["shard", "block"])


@dataclass(frozen=True)
class Model:
    """Folder of the shards and the few numbers that go with them (one row a shard)."""

    folder: str
    bases: tuple[int, ...]
    #: Shards that have pairs.
    paired: tuple[int, ...]
    tokens: int
    cc_total: int
    pair_discounts: tuple[float, float, float]
    word_discounts: tuple[float, float, float]
    #: Probability that the discounts of the unigram model leave to the uniform one.
    spare: float

    @property
    def words(self) -> int:
        return self.bases[-1]


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """D1, D2, D3+ from the numbers of items met once to four times; halves of the count where too few were met."""
    if not n1 or not n2:
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    d1, d2 = 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2
    d3 = 3 - 4 * y * n4 / n3 if n3 else 1.5
    return tuple(float(np.clip(d, 0.05 * k, 0.95 * k)) for k, d in ((1, d1), (2, d2), (3, d3)))


class Shards:
    """Mapped arrays of a model; each shard is opened when first asked for."""

    def __init__(self, folder: str, bases: tuple[int, ...], paired: tuple[int, ...] = ()):
        self.folder, self.bases, self.paired, self.opened = folder, np.array(bases), frozenset(paired), {}

    def array(self, shard: int, name: str, dtype) -> np.ndarray:
        key = shard, name
        if key not in self.opened:
            # A shard that got no word, or no pair, is not written; any other file must be there.
            written = shard in self.paired if name in ("k", "n", "ctx") else self.bases[shard + 1] > self.bases[shard]
            self.opened[key] = read_file(f"{self.folder}/{shard:06d}.{name}", dtype) if written else np.empty(0, dtype)
        return self.opened[key]

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Ids of sorted distinct hashes; -1 where the word is unknown."""
        count = len(self.bases) - 1
        out = np.full(len(hashes), -1, np.int64)
        cuts = np.searchsorted(_shard_of(hashes, count), np.arange(count + 1))
        for s in np.flatnonzero(np.diff(cuts)).tolist():
            h = self.array(s, "h", "<u8")
            if len(h):
                q = hashes[cuts[s]:cuts[s + 1]]
                at = np.minimum(np.searchsorted(h, q), len(h) - 1)
                out[cuts[s]:cuts[s + 1]] = np.where(h[at] == q, at + self.bases[s], -1)
        return out

    def values(self, ids: np.ndarray, name: str, dtype) -> np.ndarray:
        """Values at sorted ids, all known."""
        out = np.empty(len(ids), dtype)
        cuts = np.searchsorted(ids, self.bases)
        for s in np.flatnonzero(np.diff(cuts)).tolist():
            out[cuts[s]:cuts[s + 1]] = self.array(s, name, dtype)[ids[cuts[s]:cuts[s + 1]] - self.bases[s]]
        return out

    def pairs(self, keys: np.ndarray) -> np.ndarray:
        """Counts of sorted pair keys, 0 where unknown. The beginning's pairs lie in the last shard."""
        first = (keys >> np.uint64(32)).astype(np.int64)
        cuts = np.searchsorted(first, np.append(self.bases[:-1], self.bases[-1] + 1))
        cuts[0] = 0
        out = np.zeros(len(keys), np.uint32)
        for s in np.flatnonzero(np.diff(cuts)).tolist():
            k = self.array(s, "k", "<u8")
            if len(k):
                q = keys[cuts[s]:cuts[s + 1]]
                at = np.minimum(np.searchsorted(k, q), len(k) - 1)
                out[cuts[s]:cuts[s + 1]] = np.where(k[at] == q, self.array(s, "n", "<u4")[at], 0)
        return out


@lru_cache(1)
def opened(folder: str, bases: tuple[int, ...], paired: tuple[int, ...] = ()) -> Shards:
    return Shards(folder, bases, paired)


def _shard_of(hashes: np.ndarray, count: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(count) >> np.uint64(32)).astype(np.int64)


def _word_ids(tokens: np.ndarray, have: Shards):
    """(id per token, distinct ids sorted by hash, place of each token among them)."""
    codes, distinct = pd.factorize(tokens)
    order = np.argsort(distinct)
    ids = have.ids(distinct[order])
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    place = place[codes]
    return ids[place], ids, place


def _first_words(ids: np.ndarray, begin: np.ndarray, start_id: int) -> np.ndarray:
    prev = np.empty_like(ids)
    prev[1:] = ids[:-1]
    prev[begin[:-1]] = start_id
    return prev


def fit(docs: DataFrame) -> Model:
    """Count all training documents (those whose fold is not the held-out one) and write the model's shards."""
    spark, count = docs.sparkSession, shards(docs.sparkSession, 1)
    folder, rows = scratch(spark, "kneser-ney"), narrow(docs, doc_id="doc_id", text="text")

    def count_words(batches):
        def parts():
            for tokens, _ in _training(batches):
                codes, distinct = pd.factorize(tokens)
                yield distinct, np.bincount(codes, minlength=len(distinct))

        yield from _gather(parts(), lambda h, c: _blocks(np.searchsorted(_shard_of(h, count), np.arange(count + 1)), h, c.astype("<u4")))

    def write_words(key, block):
        s = key[0].as_py()
        got = [_unpack(x.as_py(), "<u8", "<u4") for x in block.column("block")]
        h, c = _summed([x[0] for x in got], [x[1].astype(np.int64) for x in got])
        write_file(f"{folder}/{s:06d}.h", h.tobytes())
        write_file(f"{folder}/{s:06d}.c", c.astype("<u8").tobytes())
        return pa.table({"shard": pa.array([s], pa.int32()), "words": pa.array([len(h)], pa.int64()), "tokens": pa.array([int(c.sum())], pa.int64())})

    made = rows.mapInArrow(count_words, "shard int, block binary").groupBy("shard").applyInArrow(write_words, "shard int, words long, tokens long").collect()
    sizes = np.zeros(count, np.int64)
    for r in made:
        sizes[r.shard] = r.words
    bases = tuple(int(x) for x in np.concatenate([[0], np.cumsum(sizes)]))
    start_id, tokens = bases[-1], sum(r.tokens for r in made)
    if start_id >= (1 << 32) - 1:
        raise ValueError("more than 2**32 - 2 distinct words")
    edges = np.array(bases)

    def count_pairs(batches):
        have = opened(folder, bases)

        def parts():
            for t, begin in _training(batches):
                ids, _, _ = _word_ids(t, have)
                keys = _first_words(ids, begin, start_id).astype(np.uint64) << np.uint64(32) | ids.astype(np.uint64)
                yield np.unique(keys, return_counts=True)

        def emit(k, c):
            first = (k >> np.uint64(32)).astype(np.int64)
            cuts = np.searchsorted(first, np.append(edges[:-1], start_id + 1))
            cuts[0] = 0
            step = np.diff(first, prepend=0)
            for s in np.flatnonzero(np.diff(cuts)).tolist():
                step[cuts[s]] = first[cuts[s]] - edges[s]
            return _blocks(cuts, step.astype("<u4"), (k & np.uint64(0xFFFFFFFF)).astype("<u4"), c.astype("<u4"))

        yield from _gather(parts(), emit)

    def write_pairs(key, block):
        s = key[0].as_py()
        keys, counts = [], []
        for x in block.column("block"):
            step, second, c = _unpack(x.as_py(), "<u4", "<u4", "<u4")
            keys.append((np.cumsum(step.astype(np.uint64)) + np.uint64(edges[s])) << np.uint64(32) | second)
            counts.append(c.astype(np.int64))
        k, c = _summed(keys, counts)
        local = (k >> np.uint64(32)).astype(np.int64) - edges[s]
        n = int(edges[s + 1] - edges[s]) + (s == count - 1)
        ctx = np.zeros(n, _CTX)
        ctx["total"] = np.bincount(local, c, n).astype(np.uint64)
        for name, met in (("n1", c == 1), ("n2", c == 2), ("n3", c > 2)):
            ctx[name] = np.bincount(local[met], minlength=n)
        write_file(f"{folder}/{s:06d}.k", k.astype("<u8").tobytes())
        write_file(f"{folder}/{s:06d}.n", c.astype("<u4").tobytes())
        write_file(f"{folder}/{s:06d}.ctx", ctx.tobytes())
        second, before = np.unique(k & np.uint64(0xFFFFFFFF), return_counts=True)
        cuts = np.searchsorted(second.astype(np.int64), edges)
        out = _blocks(cuts, second.astype("<u4"), before.astype("<u4"))
        ones = [None] * out.num_rows
        return pa.table({"shard": pa.concat_arrays([pa.array([s], pa.int32()), out.column(0)]), "block": pa.concat_arrays([pa.array([None], pa.binary()), out.column(1)]),
                         **{f"m{i}": pa.array([int((c == i).sum()), *ones], pa.int64()) for i in (1, 2, 3, 4)}})

    pairs = stored(rows.mapInArrow(count_pairs, "shard int, block binary").groupBy("shard").applyInArrow(
        write_pairs, "shard int, block binary, m1 long, m2 long, m3 long, m4 long"), "pairs")

    def write_before(key, block):
        s = key[0].as_py()
        got = [_unpack(x.as_py(), "<u4", "<u4") for x in block.column("block")]
        cc = np.bincount(np.concatenate([x[0] for x in got]).astype(np.int64) - edges[s], np.concatenate([x[1] for x in got]), int(edges[s + 1] - edges[s])).astype("<u4")
        write_file(f"{folder}/{s:06d}.cc", cc.tobytes())
        return pa.table({"total": pa.array([int(cc.astype(np.int64).sum())]), **{f"m{i}": pa.array([int((cc == i).sum())]) for i in (1, 2, 3, 4)}})

    sums = [F.coalesce(F.sum(f"m{i}"), F.lit(0)).alias(f"m{i}") for i in (1, 2, 3, 4)]
    pair = pairs.agg(*sums).first()
    before = pairs.where("block IS NOT NULL").select("shard", "block").groupBy("shard").applyInArrow(write_before, "total long, m1 long, m2 long, m3 long, m4 long")
    word = stored(before, "before").agg(F.coalesce(F.sum("total"), F.lit(0)).alias("total"), *sums).first()
    d1, d2, d3 = by_word = discounts(*word[1:5])
    more = start_id - word["m1"] - word["m2"]
    spare = (d1 * word["m1"] + d2 * word["m2"] + d3 * more) / max(1, word["total"])
    paired = tuple(sorted(r.shard for r in pairs.where("block IS NULL").select("shard").collect()))  # a row a shard at most
    return Model(folder, bases, paired, tokens, word["total"], discounts(*pair[:4]), by_word, spare)


def _discount(counts: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.array([0.0, *d])[np.minimum(counts, 3).astype(np.int64)]


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and perplexity of every document.

    ``score`` is the model's log10 probability of the whole text with its end, base_score that of the add-one unigram
    model. A null text is empty: one token, its end. An unknown word has the uniform share of the unigram model. Without
    training documents every word is unknown. One pass over the text, no shuffle.
    """
    folder, bases, words = model.folder, model.bases, model.words
    start_id, total = words, model.tokens

    def run(batches):
        have = opened(folder, bases, model.paired)
        for b in batches:
            keys = b.column(0).to_pylist()
            held = held_out(keys)
            for lo, hi, data, offs in text_pieces(b.column(1)):
                tokens, begin = _tokens(data, offs)
                ids, distinct, place = _word_ids(tokens, have)
                order = np.argsort(distinct)
                known = order[np.searchsorted(distinct[order], 0):]
                c, cc = np.zeros(len(distinct)), np.zeros(len(distinct))
                c[known], cc[known] = have.values(distinct[known], "c", "<u8"), have.values(distinct[known], "cc", "<u4")
                p1 = np.full(len(distinct), 1.0 / (words + 1))
                if model.cc_total:
                    d = _discount(cc, model.word_discounts)
                    p1 = (cc - d) / model.cc_total + p1 * model.spare
                prev = _first_words(ids, begin, start_id)
                ok = (prev >= 0) & (ids >= 0)
                key, back = np.unique(prev[ok].astype(np.uint64) << np.uint64(32) | ids[ok].astype(np.uint64), return_inverse=True)
                n = np.zeros(len(ids))
                n[ok] = have.pairs(key)[back]
                top, weight = np.zeros(len(distinct) + 1), np.zeros(len(distinct) + 1)
                seen = np.concatenate([known, [len(distinct)]]) if words else known
                ctx = _contexts(have, np.append(distinct[known], start_id) if words else distinct[known])
                top[seen] = ctx["total"]
                d1, d2, d3 = model.pair_discounts
                weight[seen] = d1 * ctx["n1"] + d2 * ctx["n2"] + d3 * ctx["n3"]
                before = np.empty_like(place)
                before[1:] = place[:-1]
                before[begin[:-1]] = len(distinct)
                t, w, uni = top[before], weight[before], p1[place]
                with np.errstate(divide="ignore", invalid="ignore"):
                    p2 = np.where(t > 0, (n - _discount(n, model.pair_discounts)) / t + w / t * uni, uni)
                at = begin[:-1]
                total_score = np.add.reduceat(np.log10(p2), at)
                base = np.add.reduceat(np.log10((c[place] + 1) / (total + words + 1)), at)
                m = np.diff(begin)
                yield pa.record_batch([b.column(0).slice(lo, hi - lo), pa.array(held[lo:hi]), pa.array(m), pa.array(np.add.reduceat((c[place] > 0).astype(np.int64), at)),
                                       pa.array(np.full(hi - lo, total, np.int64)), pa.array(base), pa.array(total_score), pa.array(10 ** np.minimum(-total_score / m, 300))],
                                      ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"])

    return narrow(docs, doc_id="doc_id", text="text").mapInArrow(
        run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double")


def _contexts(have: Shards, ids: np.ndarray) -> np.ndarray:
    """Context rows at sorted known ids; the beginning's lies behind the last shard's words."""
    out = np.zeros(len(ids), _CTX)
    cuts = np.searchsorted(ids, np.append(have.bases[:-1], have.bases[-1] + 1))
    for s in np.flatnonzero(np.diff(cuts)).tolist():
        part = slice(cuts[s], cuts[s + 1])
        rows = have.array(s, "ctx", _CTX)
        if len(rows):
            out[part] = rows[ids[part] - have.bases[s]]
    return out


def scored(docs: DataFrame) -> DataFrame:
    return score(docs, fit(docs))
