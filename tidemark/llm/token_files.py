"""Operator 1: token ids as flat unsigned integer files with 64-bit document offsets.

Documents are dealt by ranges of doc_id and sorted, so that the shards in
order hold all documents in ascending order. A shard is three flat files:

* ``NNNNNN.bin``  ids, unsigned 16-bit below 65,536 ids in the vocabulary, else 32-bit
* ``NNNNNN.off``  64-bit offsets, one per document and one past the end, counted in ids from the shard's first
* ``NNNNNN.doc``  64-bit doc_id per document

The manifest lists each shard's documents and ids; prefix sums over it (one
row a shard) give the base that turns local offsets into global ones.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice, pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.shared import narrow, read_file, scratch, text_pieces, write_file, writing

VOCABULARY, END_ID, NO_ID = "byte_bpe_50k.json", 0, -(1 << 63)
#: Chunks of text whose ids a worker remembers; beyond it the memory starts anew.
REMEMBERED = 1_000_000
#: New chunks encoded in one string; how byte-level vocabularies spell a space.
TOGETHER, SPACE = 64, "\u0120"
_SPLIT = re.compile(r"(?<=\S) (?=\S)")


def vocabulary_file(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class ChunkEncoder:
    """The tokenizers library behind a memory of chunks.

    A space between two characters that are not white space always begins a
    match of the byte-level pattern, so a text falls into chunks there and the
    ids of the text are those of its chunks in turn. Chunks repeat, texts don't.
    ``known`` has chunks without the space in front of them. New chunks are
    encoded many in a string: a token that begins with a space begins a chunk.

    Strings of special tokens in a text become their ids, as the library does by default; with ``special_as_text`` they
    are ordinary text.
    """

    def __init__(self, path: str, special_as_text: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        vocabulary = self.tokenizer.get_vocab()
        self.dtype = np.dtype("<u2") if max(vocabulary.values()) < 1 << 16 else np.dtype("<u4")
        self.begins = np.zeros(max(vocabulary.values()) + 1, bool)
        self.begins[[i for t, i in vocabulary.items() if t.startswith(SPACE)]] = True
        self.known: dict[str, bytes] = {}
        self.known_heads: dict[str, bytes] = {}

    def _encoded(self, texts: list[str]) -> Iterator[bytes]:
        for lo in range(0, len(texts), 10_000):
            for e in self.tokenizer.encode_batch_fast(texts[lo:lo + 10_000], add_special_tokens=False):
                yield np.asarray(e.ids, self.dtype).tobytes()

    def _together(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks without a space in them, each with a space in front."""
        strings = [" " + " ".join(chunks[lo:lo + TOGETHER]) for lo in range(0, len(chunks), TOGETHER)]
        ids = np.frombuffer(b"".join(self._encoded(strings)), self.dtype)
        edges = (np.append(np.flatnonzero(self.begins[ids]), len(ids)) * self.dtype.itemsize).tolist()
        if len(edges) != len(chunks) + 1:
            raise ValueError("the vocabulary does not keep spaces at the start of tokens")
        raw = ids.tobytes()
        return [raw[a:b] for a, b in pairwise(edges)]

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as bytes of ``dtype``."""
        cut = [t.split(" ") for t in texts]
        seen = set().union(*cut)
        if len(self.known) + len(self.known_heads) > REMEMBERED:
            self.known, self.known_heads = {k: self.known[k] for k in seen & self.known.keys()}, {}
        fresh = seen - self.known.keys()
        odd = {k for k in fresh if not k or k[0].isspace() or k[-1].isspace()}
        apart: dict[str, bytes] = {}
        loose = [i for i, c in enumerate(cut) if not odd.isdisjoint(c)] if odd else []
        if loose:  # a cut next to white space is no safe one
            for i in loose:
                cut[i] = _SPLIT.split(texts[i])
            tails = set().union(*(islice(cut[i], 1, None) for i in loose)) - self.known.keys()
            rare = [k for k in tails if " " in k or k[0].isspace() or k[-1].isspace()]
            apart = dict(zip(rare, self._encoded([" " + k for k in rare]), strict=True))
            fresh = (fresh - odd) | tails.difference(rare)
        plain = list(fresh)
        self.known.update(zip(plain, self._together(plain), strict=True))
        new = list({c[0] for c in cut} - self.known_heads.keys())
        self.known_heads.update(zip(new, self._encoded(new), strict=True))
        get, out = self.known.__getitem__, []
        loose_ones = set(loose)
        for i, c in enumerate(cut):
            tail = map(get, islice(c, 1, None)) if i not in loose_ones else (apart[k] if k in apart else get(k) for k in islice(c, 1, None))
            out.append(b"".join([self.known_heads[c[0]], *tail]))
        return out


@lru_cache(2)
def encoder(path: str, special_as_text: bool = False) -> ChunkEncoder:
    return ChunkEncoder(path, special_as_text)


def write_tokens(docs: DataFrame, folder: str, vocabulary: str | None = None, end_id: int | None = END_ID, special_as_text: bool = False) -> DataFrame:
    """Write shards below ``folder`` and return the manifest: shard, n_docs, n_tokens, base_docs, base_tokens, width.

    Order is doc_id (null first, written as the least 64-bit integer), equal ids by a hash of the text; a null text is empty. A task that runs
    again writes the same files. Ids go to the file as they are made; a task holds the ids of one piece of text and 16
    bytes a document. ``<|endoftext|>`` and other special strings in a text become their ids unless ``special_as_text``.
    The manifest has one row a shard and is made on the driver from that many rows.
    """
    path, spark = vocabulary or vocabulary_file(), docs.sparkSession
    rows = narrow(docs, doc_id="doc_id", text="text").withColumn("tie", F.xxhash64("text"))
    dealt = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")

    def run(batches):
        enc, shard = encoder(path, special_as_text), TaskContext.get().partitionId()
        end = b"" if end_id is None else np.asarray([end_id], enc.dtype).tobytes()
        sizes, keys = [], []
        first = next(batches, None)
        if first is None:
            return
        with writing(f"{folder}/{shard:06d}.bin") as out:
            for b in chain([first], batches):
                keys.append(b.column(0).cast(pa.int64()).fill_null(NO_ID).to_numpy(zero_copy_only=False).astype("<i8"))
                for lo, hi, _, _ in text_pieces(b.column(1)):
                    coded = [x + end for x in enc.encode_many([t or "" for t in b.column(1).slice(lo, hi - lo).to_pylist()])]
                    sizes.append(np.fromiter(map(len, coded), np.int64, len(coded)) // enc.dtype.itemsize)
                    out.write(b"".join(coded))
        offs = np.concatenate([[0], np.cumsum(np.concatenate([[], *sizes]))]).astype("<i8")
        for tail, parts in (("off", [offs.tobytes()]), ("doc", [k.tobytes() for k in keys])):
            write_file(f"{folder}/{shard:06d}.{tail}", *parts)
        yield pa.record_batch([pa.array([shard], pa.int32()), pa.array([len(offs) - 1], pa.int64()), pa.array([int(offs[-1])], pa.int64()), pa.array([enc.dtype.itemsize], pa.int32())],
                              ["shard", "n_docs", "n_tokens", "width"])

    made = sorted(dealt.select("doc_id", "text").mapInArrow(run, "shard int, n_docs long, n_tokens long, width int").collect())
    out, docs_before, before = [], 0, 0
    for r in made:
        out.append((r.shard, r.n_docs, r.n_tokens, docs_before, before, r.width))
        docs_before, before = docs_before + r.n_docs, before + r.n_tokens
    return spark.createDataFrame(out, "shard int, n_docs long, n_tokens long, base_docs long, base_tokens long, width int")


def read_tokens(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """Per document, from the mapped files: doc_id, start (ids before it), n_tokens, ids_crc32, shard."""

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                stem = f"{folder}/{r['shard']:06d}"
                ids, offs, keys = read_file(f"{stem}.bin", f"<u{r['width']}"), read_file(f"{stem}.off", "<i8"), read_file(f"{stem}.doc", "<i8")
                for lo in range(0, len(keys), 20_000):
                    hi = min(lo + 20_000, len(keys))
                    crc = [zlib.crc32(ids[offs[i]:offs[i + 1]].astype("<u4").tobytes()) for i in range(lo, hi)]
                    yield pa.record_batch([pa.array(keys[lo:hi], mask=keys[lo:hi] == NO_ID), pa.array(offs[lo:hi] + r["base_tokens"]), pa.array(np.diff(offs[lo:hi + 1])), pa.array(crc, pa.int64()),
                                           pa.array([r["shard"]] * (hi - lo), pa.int32())], ["doc_id", "start", "n_tokens", "ids_crc32", "shard"])

    n = max(1, manifest.count())
    return manifest.repartition(n).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long, shard int")


def token_file_digests(docs: DataFrame) -> DataFrame:
    """Write all documents and read them back."""
    folder = scratch(docs.sparkSession, "tokens")
    return read_tokens(docs.sparkSession, folder, write_tokens(docs, folder))
