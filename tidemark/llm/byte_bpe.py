"""Operator 10: byte-level BPE by a local rank file through the tiktoken library.

Long texts are cut where no match of the pattern can span the cut: before a
single space that stands between two characters that are not white space.
Every match of the pattern ends or begins there whatever surrounds it, so the
pieces encode to the same ids as the whole text.

The library's matcher ends the process on runs of about a million white-space
characters. Such a run is one match of the pattern, all but its last character
when text follows; that match goes straight to the merges.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import narrow

RANKS, WHOLE_CHARS = "byte_bpe_multi_50k.tiktoken", 1 << 16
_SAFE = re.compile(r"(?<=\S) (?=\S)")
#: Runs of so many characters with the White_Space property are matched here; the library manages nine times as many.
LONG_RUN = 100_000
_RUN = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % LONG_RUN)


def rank_file(name: str = RANKS) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Codec:
    """Encoder and raw-byte decoder over one rank file."""

    def __init__(self, path: str, pattern: str | None = None):
        import tiktoken

        if pattern is None:
            import public_tokenizers

            pattern = public_tokenizers.PATTERN
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, f))}
        self._enc = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        if len(text) <= WHOLE_CHARS:
            return self._enc.encode_ordinary(text)
        ids, at = [], 0
        for run in _RUN.finditer(text):
            end = run.end() if run.end() == len(text) else run.end() - 1
            ids += self._cut(text[at:run.start()]) + self._enc._encode_single_piece(text[run.start():end])
            at = end
        return ids + self._cut(text[at:])

    def _cut(self, text: str) -> list[int]:
        ids: list[int] = []
        for piece in pieces(text):
            ids += self._enc.encode_ordinary(piece)
        return ids

    def decode(self, ids) -> bytes:
        """The very bytes of the ids, also where they are no valid UTF-8."""
        return self._enc.decode_bytes(ids) if len(ids) else b""


def pieces(text: str, size: int = WHOLE_CHARS) -> Iterator[str]:
    """Parts of at least ``size`` characters (but for the last), cut at safe places only."""
    at = 0
    while len(text) - at > size:
        cut = _SAFE.search(text, at + size)
        if cut is None:
            break
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:]


@lru_cache(4)
def codec(path: str, pattern: str | None = None) -> Codec:
    return Codec(path, pattern)


def encode(docs: DataFrame, text: str = "text", ids: str = "token_ids", ranks: str | None = None) -> DataFrame:
    """``docs`` with an array of ids. Null and empty texts give an empty array; other columns stay."""
    path = ranks or rank_file()

    @F.pandas_udf("array<int>")
    def run(texts):
        enc = codec(path)
        return texts.map(lambda t: np.asarray(enc.encode(t), np.int32))

    return docs.withColumn(ids, run(F.col(f"`{text}`")))


def decode(docs: DataFrame, ids: str = "token_ids", out: str = "decoded", ranks: str | None = None) -> DataFrame:
    """``docs`` with the raw bytes of an array of ids; null ids decode to no bytes."""
    path = ranks or rank_file()

    @F.pandas_udf("binary")
    def run(rows):
        enc = codec(path)
        return rows.map(lambda x: enc.decode([]) if x is None else enc.decode([int(i) for i in x]))

    return docs.withColumn(out, run(F.col(f"`{ids}`")))


def round_trip(docs: DataFrame, ranks: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and restored (the decoded bytes are the text's) per document.

    A null text counts as empty. One pass, no shuffle; ids never leave the task.
    """
    path = ranks or rank_file()

    def run(batches):
        enc = codec(path)
        for b in batches:
            n, ids_sha, text_sha, same = [], [], [], []
            for t in b.column(1):
                t = t.as_py() or ""
                ids = enc.encode(t)
                raw = enc.decode(ids)
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest())
                text_sha.append(hashlib.sha256(raw).hexdigest())
                same.append(raw == t.encode())
            yield pa.record_batch([b.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string()), pa.array(same, pa.bool_())],
                                  ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "restored"])

    return narrow(docs, doc_id="doc_id", text="text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, restored boolean")
