"""Helpers shared by the corpus operators: shared folders, flat files, batches of text."""

from __future__ import annotations

import mmap
import posixpath
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import ensure_checkpoint_dir

#: Text is worked on in pieces of about this many bytes, whatever the size of an Arrow batch.
PIECE_BYTES = 4 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return posixpath.join(spark.sparkContext.getCheckpointDir(), f"{name}-{uuid.uuid4().hex}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: a cut that outlives executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shards(spark: SparkSession, per_partition: int = 2) -> int:
    """Number of hash ranges: follows the shuffle width chosen for the input."""
    return per_partition * max(4, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _store(path: str):
    from pyarrow import fs

    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(path)


@contextmanager
def writing(path: str):
    """An open flat file; it appears under its name only when whole, so a repeated task does no harm."""
    store, name = _store(path)
    store.create_dir(posixpath.dirname(name), recursive=True)
    draft = f"{name}.{uuid.uuid4().hex}.draft"
    with store.open_output_stream(draft) as out:
        yield out
    store.move(draft, name)


def write_file(path: str, *parts) -> None:
    """Write one flat file of ``parts``."""
    with writing(path) as out:
        for p in parts:
            out.write(p)


def read_file(path: str, dtype) -> np.ndarray:
    """The file as an array: memory-mapped on a mounted folder, else read."""
    from pyarrow import fs

    store, name = _store(path)
    if not isinstance(store, fs.LocalFileSystem):
        with store.open_input_file(name) as f:
            return np.frombuffer(f.read(), dtype)
    with open(name, "rb") as f:
        f.seek(0, 2)
        if not f.tell():
            return np.empty(0, dtype)
        return np.frombuffer(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ), dtype)


def text_pieces(column: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows of about ``limit`` bytes; null reads as empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return
    _, offs, data = column.buffers()
    offs = np.frombuffer(offs, np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1)
        yield lo, hi, data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        lo = hi


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_P = 0x9E3779B97F4A7C15
_PINV = pow(_P, -1, 2**64)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalising 64-bit mixer."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def _powers(base: int, n: int, _made: dict = {}) -> np.ndarray:  # noqa: B006
    have = _made.get(base)
    if have is None or len(have) < n:
        out = np.full(max(n, 1 << 16), base, np.uint64)
        out[0] = 1
        _made[base] = have = np.multiply.accumulate(out)
    return have[:n]


def word_bounds(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first word of each row and one past the last) of the words ``[^\\x20\\x09-\\x0D]+``."""
    n = len(data)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offs), np.int64)
    solid = ~_SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    begin = solid.copy()
    begin[1:] &= ~solid[:-1] | edge[1:n]
    end = solid.copy()
    end[:-1] &= ~solid[1:] | edge[1:n]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, offs)


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """64-bit hashes of byte ranges in ascending order, A-Z read as a-z on request."""
    out = np.empty(len(starts), np.uint64)
    lo = 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + (1 << 20), "right")))
        a, b = int(starts[lo]), int(ends[hi - 1])
        part = _LOWER[data[a:b]] if lower else data[a:b]
        sums = np.empty(len(part) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(_BYTE[part] * _powers(_P, len(part)), out=sums[1:])
        s, e = starts[lo:hi] - a, ends[lo:hi] - a
        out[lo:hi] = (sums[e] - sums[s]) * _powers(_PINV, len(part))[s] + (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        lo = hi
    return mix(out)


def narrow(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, cast; other columns, whatever their names, go no further."""
    return df.select(*[F.col(f"`{src}`").alias(dst) for dst, src in columns.items()])


def heaviest(df: DataFrame, column: str, most: int) -> DataFrame:
    """Rows with the greatest positive counts: as many whole steps of an eighth of a power of two as ``most`` rows hold.

    The driver sees one count a step, not rows of every task.
    """
    step = F.floor(8 * F.log2(column))
    total, cut = 0, None
    for r in sorted(df.groupBy(step.alias("step")).count().collect(), reverse=True):
        total += r["count"]
        if total > most:
            break
        cut = r["step"]
    return df.where(F.lit(False) if cut is None else step >= cut)


def thinned(df: DataFrame, hashed, most: int) -> DataFrame:
    """About ``most`` rows at most, those with the least hashes; all of them where there are fewer."""
    n = df.count()
    return df if n <= most else df.where(F.pmod(hashed, F.lit(1 << 31)) < F.lit((1 << 31) * most // n))
