"""Tables published version by version.

A version is a folder of Parquet files that is never written again. It counts
only once a manifest names it: manifests are numbered, and the next number is
taken by one rename that fails if the number is there already. Readers follow
the greatest number, so they see the old table or the new one, never a part;
a write that fails leaves files no manifest names. Of two writers that started
from one version the second gets an error and may try again.
"""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.sinks import merged

_MANIFESTS = "_manifests"


class VersionTaken(RuntimeError):
    """Another writer has published the version in the meantime."""


@dataclass(frozen=True)
class Version:
    number: int
    folder: str
    schema: T.StructType
    rows: int
    properties: dict = field(default_factory=dict)


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _store(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, root: str) -> list[int]:
    folder = _path(spark, posixpath.join(root, _MANIFESTS))
    store = _store(spark, root)
    names = [s.getPath().getName() for s in store.listStatus(folder)] if store.exists(folder) else []
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def manifest(spark: SparkSession, root: str, number: int) -> Version:
    """What is recorded of a published version."""
    text = "\n".join(r[0] for r in spark.read.text(posixpath.join(root, _MANIFESTS, f"{number:010d}.json"), wholetext=True).collect())
    d = json.loads(text)
    return Version(number, posixpath.join(root, d["folder"]), T.StructType.fromJson(d["schema"]), d["rows"], d["properties"])


def latest(spark: SparkSession, root: str) -> Version | None:
    """The published version with the greatest number."""
    numbers = _numbers(spark, root)
    return manifest(spark, root, numbers[-1]) if numbers else None


def read(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    """The latest version, or a numbered one."""
    version = latest(spark, root) if number is None else manifest(spark, root, number)
    if version is None:
        raise FileNotFoundError(f"nothing is published at {root}")
    return spark.read.schema(version.schema).parquet(version.folder)


def _commit(spark: SparkSession, root: str, number: int, text: str) -> None:
    jvm, folder = spark._jvm, posixpath.join(root, _MANIFESTS)
    draft, final = _path(spark, posixpath.join(folder, f".{uuid.uuid4().hex}.draft")), _path(spark, posixpath.join(folder, f"{number:010d}.json"))
    store = _store(spark, root)
    out = store.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(store.makeQualified(draft).toUri(), spark._jsc.hadoopConfiguration())
    no_options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        files.rename(draft, final, no_options)
    except Exception as e:
        store.delete(draft, False)
        if "FileAlreadyExistsException" in str(e):
            raise VersionTaken(f"version {number} of {root} has been published by another writer") from e
        raise


def replace(df: DataFrame, root: str, properties: dict | None = None, after: int | None = None) -> Version:
    """S22. Publish ``df`` as the next version; ``after`` is the version it was made from (default: the latest now)."""
    spark = df.sparkSession
    before = after if after is not None else (_numbers(spark, root) or [0])[-1]
    folder = f"v-{before + 1:010d}-{uuid.uuid4().hex}"
    path = posixpath.join(root, folder)
    df.write.parquet(path)
    schema = T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in df.schema])
    rows = spark.read.schema(schema).parquet(path).count()
    _commit(spark, root, before + 1, json.dumps({"folder": folder, "schema": schema.jsonValue(), "rows": rows, "properties": properties or {}}))
    return Version(before + 1, path, schema, rows, properties or {})


def upsert(new: DataFrame, root: str, keys: Sequence[str], keep_first: Sequence[str] = ()) -> Version:
    """S21. Publish the latest version with the rows of ``new`` in place of those of the same keys."""
    before = latest(new.sparkSession, root)
    if before is None:
        return replace(new, root)
    old = read(new.sparkSession, root, before.number)
    return replace(merged(old, new, keys, keep_first), root, before.properties, after=before.number)


def versions(spark: SparkSession, root: str) -> DataFrame:
    """Number, rows and folder of every published version."""
    found = [manifest(spark, root, n) for n in _numbers(spark, root)]
    return spark.createDataFrame([(v.number, v.rows, v.folder) for v in found], "number int, row_count long, folder string").orderBy(F.col("number"))
