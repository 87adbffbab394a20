"""Operator 11: Merkle manifest of a table, kept as a postorder append log.

Every row is a leaf; the leaves of a group in order are the base of a tree of
16-ary runs, and the groups' roots in order are the base of one more such tree.
Aligned builders each take 16^3 consecutive nodes of one group and write their
subtree's nodes in completion order: a node stands right after the last of its
children. So a node's place follows from its level and number alone (``place``)
and a proof reads the siblings of a path there, without an index. Builder roots
are the base nodes of the next pass, until one node a group is left.

A pass is one table of log segments, a row a builder: bounded rows, whatever
the size of a group. Ranks come from a range partition and prefix sums over one
row per partition and group in it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.shared import stored

FANOUT, BUILDER_LEVELS = 16, 3
BUILDER = FANOUT ** BUILDER_LEVELS
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_WHOLE = ""
#: Output rows of one Arrow batch of proofs.
OUT_ROWS = 8192


def digest(parts: Sequence[Column]) -> Column:
    """SHA-256 (32 bytes) of the parts one after the other; a part is ``-`` if null, else its length in bytes, ``:`` and itself."""
    text = [p.cast("string") for p in parts]
    return F.unhex(F.sha2(F.concat(*[F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in text]), 256))


def place(level: int, number: int, n: int) -> int:
    """Place in a postorder log over ``n`` base nodes of the ``number``-th node of ``level``: after its last base node and all that was complete before."""
    last = min((number + 1) * FANOUT ** level, n) - 1
    done, width = last, FANOUT
    while width <= last:
        done, width = done + last // width, width * FANOUT
    return done + level


def levels_of(n: int) -> int:
    """Levels above ``n`` base nodes until one is left, those of a full builder at most."""
    level = 0
    while level < BUILDER_LEVELS and n > FANOUT ** level:
        level += 1
    return level


def append_subtree(leaves: Sequence[bytes], levels: int) -> list[bytes]:
    """Digests of a builder's subtree in completion order."""
    log, pending = [], [[] for _ in range(levels + 1)]
    for i, node in enumerate(leaves):
        log.append(node)
        pending[0].append(node)
        for level in range(levels):
            run = pending[level]
            if len(run) < FANOUT and i + 1 < len(leaves):
                break
            node = hashlib.sha256("".join(x.hex() for x in run).encode()).digest()
            log.append(node)
            pending[level + 1].append(node)
            run.clear()
    return log


def runs_of(log: bytes, n: int, levels: int) -> list[list[str]]:
    """Per level the hex text of every run of a builder's log, addressed by ``place``."""
    out = []
    for level in range(levels):
        count = -(-n // FANOUT ** level)
        at = [32 * place(level, k, n) for k in range(count)]
        names = [log[p:p + 32].hex() for p in at]
        out.append(["".join(names[k:k + FANOUT]) for k in range(0, count, FANOUT)])
    return out


def path_of(runs: list[list[str]], i: int) -> list[tuple[str, str]]:
    """Siblings on the left and on the right of leaf ``i``'s ancestors, level by level."""
    out = []
    for level in runs:
        run, cut = level[i // FANOUT], 64 * (i % FANOUT)
        out.append((run[:cut], run[cut + 64:]))
        i //= FANOUT
    return out


def folded(node: str, path: Sequence[tuple[str, str]]) -> str:
    """Root that ``node`` (hex) gives with the siblings of ``path``."""
    for left, right in path:
        node = hashlib.sha256(f"{left}{node}{right}".encode()).hexdigest()
    return node


def proof_digest(path: Sequence[tuple[str, str]]) -> str:
    return hashlib.sha256("".join(left + right for left, right in path).encode()).hexdigest()


def _ranked(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` (grp, ...) with ``rank`` (from 0) in their group by ``order`` and ``n``, the group's rows."""
    part = F.shiftrightunsigned("at", 33)
    dealt = rows.repartitionByRange("grp", *order).sortWithinPartitions("grp", *order)
    dealt = stored(dealt.withColumn("at", F.monotonically_increasing_id()), "ranked").withColumn("part", part)
    spans = dealt.groupBy("grp", "part").agg(F.min("at").alias("first"), F.count("*").alias("rows"))
    own = Window.partitionBy("grp")
    spans = spans.select("grp", "part", "first", F.coalesce(F.sum("rows").over(own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
                         F.sum("rows").over(own).alias("n"))
    return dealt.join(spans, ["grp", "part"]).withColumn("rank", F.col("at") - F.col("first") + F.col("before")).drop("at", "part", "first", "before")


_SEGMENT = "grp string, block long, n long, leaves array<struct<rank:long,node:binary,key:{key},claim:binary>>, log binary, top binary"


def _segments(rows: DataFrame, key: str) -> DataFrame:
    """One pass: log segments of the builders over ``rows`` (grp, rank, n, node, key, claim)."""
    leaf = F.struct("rank", "node", "key", "claim")
    blocks = rows.groupBy("grp", F.floor(F.col("rank") / BUILDER).alias("block")).agg(F.max("n").alias("n"), F.sort_array(F.collect_list(leaf)).alias("leaves"))

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1)
                own = row.column(3).flatten()
                log = append_subtree(own.field("node").to_pylist(), levels_of(row.column(2)[0].as_py()))
                yield pa.RecordBatch.from_arrays([*row.columns, pa.array([b"".join(log)]), pa.array([log[-1]])], [*row.schema.names, "log", "top"])

    return stored(blocks.mapInArrow(run, _SEGMENT.format(key=key)), "segments")


def _passes(rows: DataFrame, key: str) -> list[DataFrame]:
    """Segment tables from the base to the roots, one for each factor of 16^3 in the largest group."""
    out = [_segments(rows, key)]
    while True:
        upper = out[-1].where(F.col("n") > BUILDER).select("grp", F.col("block").alias("rank"), F.ceil(F.col("n") / BUILDER).alias("n"), F.col("top").alias("node"),
                                                           F.lit(None).cast(key).alias("key"), F.lit(None).cast("binary").alias("claim"))
        if upper.isEmpty():
            return out
        out.append(_segments(upper, key))


def _roots(passes: Sequence[DataFrame]) -> DataFrame:
    """(grp, top) of every group."""
    ended = [p.where(F.col("n") <= BUILDER).select("grp", "top") for p in passes]
    out = ended[0]
    for e in ended[1:]:
        out = out.unionByName(e)
    return out


_PATH = "array<struct<left:string,right:string>>"


def _unfold(segments: DataFrame, above: DataFrame, key: str) -> DataFrame:
    """(grp, rank, key, path, subroot) of the base nodes of ``segments``, given the same of its builders as ``above``."""

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                leaves, upper = r["leaves"], [(x["left"], x["right"]) for x in r["path"]]
                runs = runs_of(r["log"], len(leaves), levels_of(r["n"]))
                out = {"grp": [], "rank": [], "key": [], "path": [], "subroot": []}
                for i, leaf in enumerate(leaves):
                    out["grp"].append(r["grp"])
                    out["rank"].append(leaf["rank"])
                    out["key"].append(leaf["key"])
                    out["path"].append([{"left": a, "right": z} for a, z in [*path_of(runs, i), *upper]])
                    out["subroot"].append(r["subroot"])
                yield pa.RecordBatch.from_pydict(out, schema)

    schema = pa.schema([("grp", pa.string()), ("rank", pa.int64()), ("key", {"long": pa.int64(), "string": pa.string()}[key]),
                        ("path", pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))), ("subroot", pa.binary())])
    return stored(_with_above(segments, above).mapInArrow(run, f"grp string, rank long, key {key}, path {_PATH}, subroot binary"), "paths")


def _with_above(segments: DataFrame, above: DataFrame) -> DataFrame:
    return segments.join(above, ["grp", "block"]).select("grp", "n", "leaves", "log", "path", "subroot")


def _proved(segments: DataFrame, above: DataFrame, root: str) -> DataFrame:
    """Result rows of the leaves in ``segments``."""

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                leaves, upper = r["leaves"], [(x["left"], x["right"]) for x in r["path"]]
                runs, subroot = runs_of(r["log"], len(leaves), levels_of(r["n"])), r["subroot"].hex()
                rows = []
                for i, leaf in enumerate(leaves):
                    path = [*path_of(runs, i), *upper]
                    got = folded((leaf["claim"] or leaf["node"]).hex(), path)
                    rows.append((leaf["key"], leaf["node"].hex(), subroot, root, proof_digest(path), got, got == root))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    types = [pa.int64(), *[pa.string()] * 5, pa.bool_()]
    return _with_above(segments, above).mapInArrow(run, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


@dataclass
class Manifest:
    """The log: segment tables of the groups' trees and of the tree over the groups, and the root (None of an empty table)."""

    groups: list[DataFrame]
    whole: list[DataFrame]
    root: str | None

    def group_paths(self) -> DataFrame:
        """(grp, path, subroot) of every group: from its root to the table's, top pass first."""
        none = F.lit(None).cast("binary").alias("subroot")
        above = self.whole[-1].select("grp", "block", F.array().cast(_PATH).alias("path"), none)
        for segments in reversed(self.whole):
            found = _unfold(segments, above, "string")
            above = found.select("grp", F.col("rank").alias("block"), "path", "subroot")
        return found.select(F.col("key").alias("grp"), "path").join(_roots(self.groups).withColumnRenamed("top", "subroot"), "grp")

    def proofs(self) -> DataFrame:
        """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every leaf; the claimed digest, where there is one, is folded in its place."""
        ended = self.group_paths().withColumn("block", F.lit(0).cast("long"))
        above = None
        for segments in reversed(self.groups):
            last = segments.where(F.col("n") <= BUILDER).select("grp", "block").join(ended, ["grp", "block"])
            above = last if above is None else last.unionByName(above, allowMissingColumns=True)
            if segments is not self.groups[0]:
                above = _unfold(segments, above, "long").select("grp", F.col("rank").alias("block"), "path", "subroot")
        return _proved(self.groups[0], above, self.root or "")


def manifest(docs: DataFrame, columns: Sequence[str] = COLUMNS, group: str = "source", key: str = "doc_id", claim: Column | None = None) -> Manifest:
    """Write the log of ``docs``: a leaf is the digest of ``columns``, leaves of a ``group`` ascend by ``key``.

    Null keys come first; equal keys ascend by leaf, and equal rows are leaves each. A null group is a group of its
    own, before all others, which follow bytewise. ``claim`` is a second digest (or null) kept beside a leaf for
    ``Manifest.proofs``. Other columns are not read. An empty table has no segments with rows and no root.
    """
    col = lambda c: F.col(f"`{c}`")
    leaf = digest([col(c) for c in columns])
    grp = F.coalesce(F.concat(F.lit("="), col(group).cast("string")), F.lit("-"))
    leaves = stored(docs.select(grp.alias("grp"), col(key).cast("long").alias("key"), leaf.alias("node"), (F.lit(None).cast("binary") if claim is None else claim).alias("claim"),
                                F.monotonically_increasing_id().alias("tie")), "leaves")
    groups = _passes(_ranked(leaves, ["key", "node", "tie"]).drop("tie"), "long")
    tops = _roots(groups).select(F.lit(_WHOLE).alias("grp"), F.col("grp").alias("key"), F.col("top").alias("node"), F.lit(None).cast("binary").alias("claim"))
    whole = _passes(_ranked(tops, ["key"]), "string")
    top = _roots(whole).first()
    return Manifest(groups, whole, None if top is None else top["top"].hex())


def tampered(docs: DataFrame) -> Column:
    """Digest of a row with its text's A-Z in lower case where 5 divides the crc32 of its doc_id; null elsewhere, and where doc_id is null."""
    low = F.translate("`text`", _UPPER, _UPPER.lower())
    parts = [low if c == "text" else F.col(f"`{c}`") for c in COLUMNS]
    return F.when(F.crc32(F.col("`doc_id`").cast("string").cast("binary")) % 5 == 0, digest(parts))


def checked(docs: DataFrame) -> DataFrame:
    """Manifest of ``docs`` and the proof of every row, folded from its tampered digest where it is tampered with.

    Null columns count as ``-``; repeated rows give a row each; an empty table gives none.
    """
    return manifest(docs, claim=tampered(docs)).proofs()


def oracle(group_levels: int = 4, whole_levels: int = 3) -> str:
    """The same in SQL, levels written out: up to 16^4 rows a group and 16^3 groups."""
    message = lambda cols: " || ".join(f"coalesce(strlen(({c})::VARCHAR) || ':' || ({c})::VARCHAR, '-')" for c in cols)
    low = [f"translate(text, '{_UPPER}', '{_UPPER.lower()}')" if c == "text" else c for c in COLUMNS]
    crc = ("xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)), "
           "lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, k: xor(x >> 1, (x & 1) * 3988292384))))")
    ctes = [f"""a AS (SELECT doc_id, coalesce('=' || source, '-') AS g, sha256({message(COLUMNS)}) AS leaf,
  CASE WHEN {crc} % 5 = 0 THEN sha256({message(low)}) END AS claim FROM documents)""",
            "g0 AS MATERIALIZED (SELECT *, leaf AS node, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM a)"]

    def tree(name, levels):
        for k in range(levels):
            ctes.append(f"{name}r{k} AS MATERIALIZED (SELECT g, i // 16 AS run, list(node ORDER BY i) AS ns, any_value(n) AS n FROM {name}{k} WHERE n > 1 GROUP BY 1, 2)")
            ctes.append(f"{name}{k + 1} AS MATERIALIZED (SELECT g, run AS i, sha256(array_to_string(ns, '')) AS node, (n + 15) // 16 AS n FROM {name}r{k})")

    def climb(name, levels, start, g, extra):
        last = start
        for k in range(levels):
            left, right = "array_to_string(ns[1:i % 16], '')", "array_to_string(ns[i % 16 + 2:], '')"
            ctes.append(f"""{name}p{k} AS MATERIALIZED (SELECT {extra}, i // 16 AS i, CASE WHEN ns IS NULL THEN node ELSE sha256({left} || node || {right}) END AS node,
  proof || coalesce({left} || {right}, '') AS proof FROM {last} p LEFT JOIN {name}r{k} r ON r.g = {g} AND r.run = p.i // 16)""")
            last = f"{name}p{k}"
        return last

    tree("g", group_levels)
    ctes.append("subs AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT g, node AS subroot FROM g{k} WHERE n = 1" for k in range(group_levels + 1)) + ")")
    ctes.append("w0 AS MATERIALIZED (SELECT '' AS g, g AS name, subroot AS node, row_number() OVER (ORDER BY encode(g)) - 1 AS i, count(*) OVER () AS n FROM subs)")
    tree("w", whole_levels)
    ctes.append("top AS (" + " UNION ALL ".join(f"SELECT node AS root FROM w{k} WHERE n = 1" for k in range(whole_levels + 1)) + ")")
    ctes.append("start AS (SELECT doc_id, leaf, p.g AS name, i, coalesce(claim, node) AS node, '' AS proof FROM g0 p)")
    inner = climb("g", group_levels, "start", "p.name", "doc_id, leaf, p.name")
    ctes.append(f"next AS (SELECT doc_id, leaf, subroot, p.name, w0.i AS i, p.node AS node, proof FROM {inner} p JOIN subs ON subs.g = p.name JOIN w0 ON w0.name = p.name)")
    outer = climb("w", whole_levels, "next", "''", "doc_id, leaf, subroot, p.name")
    return "WITH " + ",\n".join(ctes) + f"\nSELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, node AS folded_root, node = root AS verified FROM {outer} CROSS JOIN top"
