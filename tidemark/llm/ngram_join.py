"""Operator 2: n-gram Jaccard join by blocked sparse products of the document by n-gram incidence.

Rows of the incidence matrix are distinct sets of word n-grams (documents with
equal sets are one row), columns are n-grams in one global order: the frequent
ones last, the others by hash. Only the first ``p(n) = n - ceil(t n) + 1``
entries of a row of size n take part in the product. Columns fall into blocks
by hash; a block multiplies its part of the matrix with its transpose, and the
numbers of shared columns are added up over the blocks.

A pair of sizes a <= b reaches the threshold t only when a >= t b and it has
``o >= t (a + b) / (1 + t)`` columns in common. Of a row's first entries at most
``a - o`` are not in the other row, so the pair shares at least the lesser of
``p(a) - (a - o)`` and ``p(b) - (b - o)`` leading columns. Pairs that share
fewer are discarded, the others are checked against whole sets.

Columns with more than ``DENSE`` entries are not multiplied out: all their rows
are linked through one pivot each, and only rows that are still in another
component than most of the column are paired with it afterwards. The bound of a
pair is lowered by the dense columns its rows may have in common.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import connected
from tidemark.llm.shared import hash_words, heaviest, mix, narrow, read_file, scratch, shards, stored, text_pieces, word_bounds, write_file

WORDS, THRESHOLD = 5, (80, 100)
#: Columns with more rows than this go the way of pivots; both ways are exact.
DENSE = 24
#: N-grams met in this many documents of a batch, and in so many over all batches, are put last in the order, the most
#: frequent at most. The order decides how much work there is, never a result.
FREQUENT_IN_BATCH, FREQUENT, FREQUENT_KEPT, BATCH_GRAMS = 3, 12, 100_000, 4_000_000
#: Bits of a set's sketch: parities of its n-grams by hash.
SKETCH = 1024
_STEP = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def shingle_sets(column: pa.Array, k: int = WORDS):
    """Sorted distinct 64-bit hashes of the k-word n-grams of each text, lower-cased A-Z, in pieces of rows.

    Fewer words than k make one n-gram of them all; no words or null make an empty set.
    """
    for lo, hi, data, offs in text_pieces(column):
        starts, ends, first = word_bounds(data, offs)
        words = hash_words(data, starts, ends)
        grams = np.zeros(max(0, len(words) - k + 1), np.uint64)
        for i in range(k if len(grams) else 0):
            grams = mix(grams + words[i:len(words) - k + 1 + i] * _STEP[i % len(_STEP)])
        sets = []
        for i in range(hi - lo):
            a, b = first[i], first[i + 1]
            if b - a >= k:
                sets.append(np.unique(grams[a:b - k + 1]))
            elif b > a:
                one = np.zeros(1, np.uint64)
                for j in range(a, b):
                    one = mix(one + words[j:j + 1] * np.uint64(0x8EBC6AF09C88C6E3) + np.uint64(b - a))
                sets.append(one)
            else:
                sets.append(np.empty(0, np.uint64))
        yield lo, hi, sets


def _row_name(grams: np.ndarray) -> int | None:
    return int.from_bytes(hashlib.blake2b(grams.tobytes(), digest_size=8).digest(), "little", signed=True) if len(grams) else None


def prefix_lengths(n, num: int, den: int):
    """(as the larger, as the smaller) row of a pair: number of leading entries that must meet."""
    return n - -(-n * num // den) + 1, n - -(-n * 2 * num // (num + den)) + 1


def frequent_grams(docs: DataFrame, k: int = WORDS) -> np.ndarray:
    """Hashes of frequent n-grams and their counts, sorted by hash. Only those that fill a batch leave its task."""

    def run(batches):
        def emit(held):
            h = np.sort(np.concatenate(held))
            first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.empty(0, np.int64)
            c = np.diff(np.append(first, len(h)))
            many = c >= FREQUENT_IN_BATCH
            return pa.record_batch([pa.array(h[first[many]].view(np.int64)), pa.array(c[many].astype(np.int64))], ["h", "c"])

        held, n = [], 0
        for b in batches:
            for _, _, sets in shingle_sets(b.column(0), k):
                held += sets
                n += sum(map(len, sets))
                if n > BATCH_GRAMS:
                    yield emit(held)
                    held, n = [], 0
        if held:
            yield emit(held)

    met = narrow(docs, text="text").mapInArrow(run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c")).where(F.col("c") >= FREQUENT)
    top = heaviest(stored(met, "frequent"), "c", FREQUENT_KEPT).toPandas()
    h, c = top["h"].to_numpy(np.int64).view(np.uint64), top["c"].to_numpy(np.int64)
    order = np.argsort(h)
    return np.stack([h[order], c[order].astype(np.uint64)]) if len(h) else np.zeros((2, 0), np.uint64)


def _ordered(grams: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Global order: the rest by hash, then frequent ones by rising count."""
    if not frequent.shape[1] or not len(grams):
        return grams
    at = np.minimum(np.searchsorted(frequent[0], grams), frequent.shape[1] - 1)
    hit = frequent[0][at] == grams
    if not hit.any():
        return grams
    last = at[hit]
    return np.concatenate([grams[~hit], frequent[0][last[np.lexsort((frequent[0][last], frequent[1][last]))]]])


def _rows(docs: DataFrame, frequent, k: int, num: int, den: int) -> DataFrame:
    """doc_id, n, row (64-bit name of the set), prefix (leading entries as bytes) per document."""
    order = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches):
        for b in batches:
            for lo, hi, sets in shingle_sets(b.column(1), k):
                names = [_row_name(s) for s in sets]
                lead = [_ordered(s, order.value)[:prefix_lengths(len(s), num, den)[0]].tobytes() if len(s) else b"" for s in sets]
                yield pa.record_batch([b.column(0).slice(lo, hi - lo), pa.array([len(s) for s in sets], pa.int64()), pa.array(names, pa.int64()), pa.array(lead, pa.binary())],
                                      ["doc_id", "n", "row", "prefix"])

    return narrow(docs, doc_id="doc_id", text="text").mapInArrow(run, "doc_id long, n long, row long, prefix binary")


_ENTRY = np.dtype([("h", "<u8"), ("row", "<i8"), ("n", "<i4"), ("pos", "<i4")])


def _blocks(rows: DataFrame, count: int) -> DataFrame:
    """(block, entries): the leading entries of many rows, cut into column blocks by hash."""

    def emit(parts):
        e = np.concatenate(parts)
        block = (e["h"] >> np.uint64(32)) * np.uint64(count) >> np.uint64(32)
        order = np.argsort(block, kind="stable")
        e, cuts = e[order], np.searchsorted(block[order], np.arange(count + 1))
        full = np.flatnonzero(np.diff(cuts))
        return pa.record_batch([pa.array(full.astype(np.int32)), pa.array([e[cuts[i]:cuts[i + 1]].tobytes() for i in full], pa.binary())], ["block", "entries"])

    def run(batches):
        parts, held = [], 0
        for b in batches:
            for row, n, lead in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                h = np.frombuffer(lead.as_buffer(), "<u8")
                e = np.empty(len(h), _ENTRY)
                e["h"], e["row"], e["n"], e["pos"] = h, row, n, np.arange(len(h))
                parts.append(e)
                held += len(h)
                if held > 1_500_000:
                    yield emit(parts)
                    parts, held = [], 0
        if held:
            yield emit(parts)

    return rows.select("row", "n", "prefix").mapInArrow(run, "block int, entries binary")


def _product(num: int, den: int):
    """One block of the product: pairs with the number of columns they share here, and the entries of dense columns."""
    names = ["a", "b", "an", "bn", "shared", "h", "row", "n", "pos"]

    def out(p, shared, e):
        pairs = pa.Table.from_arrays([*[pa.array(p[:, i]) for i in range(4)], pa.array(shared.astype(np.int64))], names[:5])
        dense = pa.Table.from_arrays([pa.array(e[k].astype(np.int64)) if k != "h" else pa.array(e["h"].copy().view(np.int64)) for k in names[5:]], names[5:])
        return pa.concat_tables([pairs, dense], promote_options="default")

    def run(block):
        e = np.concatenate([np.frombuffer(x.as_buffer(), _ENTRY) for x in block.column("entries")])
        e = e[np.argsort(e["h"], kind="stable")]
        first = np.flatnonzero(np.concatenate([[True], e["h"][1:] != e["h"][:-1]]))
        size = np.diff(np.append(first, len(e)))
        each = np.repeat(size, size)
        dense, e = e[each > DENSE], e[(each > 1) & (each <= DENSE)]
        pairs = []
        for step in range(1, DENSE):
            x, y = e[:-step], e[step:]
            same = x["h"] == y["h"]
            if not same.any():
                break
            x, y = x[same], y[same]
            swap = (y["n"] < x["n"]) | ((y["n"] == x["n"]) & (y["row"] < x["row"]))
            small, large = np.where(swap, y, x), np.where(swap, x, y)
            ok = small["n"] * den >= large["n"].astype(np.int64) * num
            pairs.append(np.stack([c[ok].astype(np.int64) for c in (small["row"], large["row"], small["n"], large["n"])], 1))
        p = np.concatenate(pairs) if pairs else np.empty((0, 4), np.int64)
        order = np.lexsort((p[:, 1], p[:, 0]))
        p = p[order]
        first = np.flatnonzero(np.concatenate([[True], (p[1:, :2] != p[:-1, :2]).any(1)])) if len(p) else np.empty(0, np.int64)
        return out(p[first], np.diff(np.append(first, len(p))), dense)

    return run, "a long, b long, an long, bn long, shared long, h long, row long, n long, pos long"


def _least_shared(num: int, den: int):
    """Leading columns a pair of sizes an <= bn must share."""
    both = F.expr(f"((an + bn) * {num} + {num + den - 1}) div {num + den}")
    spare_a, spare_b = F.expr(f"(an * {num} + {den - 1}) div {den}"), F.expr(f"(bn * {num} + {den - 1}) div {den}")
    return F.least(both - spare_a, both - spare_b) + 1


def _keep_named(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(row, n, file, at, odd): where the whole sets of the wanted documents (doc_id, row) lie, and their sketches.

    Every task maps the wanted ids from sorted files and writes the sets it makes to a flat file of its own, so neither
    texts nor sets are shuffled; rows say where to find them. Of repeated documents one place is kept.
    """
    spark = docs.sparkSession
    folder = scratch(spark, "wanted")
    pair = np.dtype([("id", "<i8"), ("row", "<i8")])

    def save(batches):
        keys = [np.rec.fromarrays([b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)], dtype=pair) for b in batches]
        keys = np.concatenate(keys) if keys else np.empty(0, pair)
        if len(keys):
            low, high = int(keys["id"][0]), int(keys["id"][-1])
            name = f"{folder}/{low & (1 << 64) - 1:016x}.ids"
            write_file(name, keys.tobytes())
            yield pa.record_batch([pa.array([name]), pa.array([low]), pa.array([high])], ["name", "low", "high"])

    made = wanted.select("doc_id", "row").repartitionByRange("doc_id").sortWithinPartitions("doc_id").mapInArrow(save, "name string, low long, high long").collect()
    files = sorted((r.low, r.high, r.name) for r in made)

    def run(batches):
        have = [(low, high, read_file(name, pair)) for low, high, name in files]
        held, total, part = [], 0, 0

        def flush():
            name = f"{folder}/{TaskContext.get().partitionId():06d}-{TaskContext.get().taskAttemptId()}-{part:04d}.grams"  # rows hold places in this attempt's file
            write_file(name, *[g.tobytes() for _, g in held])
            n = np.array([len(g) for _, g in held], np.int64)
            odd = [np.packbits(np.bincount((g % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH) & 1).view("<i8") for _, g in held]
            at = np.arange(len(odd) + 1, dtype=np.int32) * (SKETCH // 64)
            return pa.record_batch([pa.array([r for r, _ in held], pa.int64()), pa.array(n), pa.array([name] * len(n), pa.string()), pa.array(np.cumsum(n) - n),
                                    pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(odd)))], ["row", "n", "file", "at", "odd"])

        for b in batches:
            ids = b.column(0).fill_null(-(1 << 63)).to_numpy(zero_copy_only=False)
            hit, rows = np.zeros(len(ids), bool), {}
            for low, high, keys in have:
                inside = np.flatnonzero((ids >= low) & (ids <= high))
                at = np.searchsorted(keys["id"], ids[inside])
                for i, x in zip(inside.tolist(), at.tolist(), strict=True):
                    while x < len(keys) and keys["id"][x] == ids[i]:
                        hit[i] = True
                        rows.setdefault(int(ids[i]), set()).add(int(keys["row"][x]))
                        x += 1
            b = b.filter(pa.array(hit))
            kept = b.column(0).to_pylist()
            for lo, _, sets in shingle_sets(b.column(1), k):
                for i, g in enumerate(sets):
                    name = _row_name(g)
                    if name in rows[kept[lo + i]]:
                        held.append((name, g))
                        total += len(g)
                if total > BATCH_GRAMS:
                    yield flush()
                    held, total, part = [], 0, part + 1
        if held:
            yield flush()

    made = narrow(docs, doc_id="doc_id", text="text").mapInArrow(run, "row long, n long, file string, at long, odd array<long>")
    return made.groupBy("row").agg(F.first("n").alias("n"), F.min(F.struct("file", "at")).alias("place"), F.first("odd").alias("odd")).select("row", "n", "place.file", "place.at", "odd")


def _possible(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose sketches allow the threshold: bits in which they differ never exceed the n-grams in which the sets do."""
    about = sets.select("row", "n", "odd")
    joined = pairs.select("a", "b").join(about.toDF("a", "an", "oa"), "a").join(about.toDF("b", "bn", "ob"), "b")
    differ = F.aggregate(F.zip_with("oa", "ob", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    return joined.where(differ * (num + den) <= (den - num) * (F.col("an") + F.col("bn"))).select("a", "b").distinct()


def _checked(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose whole sets, mapped from their files, reach the threshold."""
    place = sets.select("row", "n", "file", "at")
    located = pairs.select("a", "b").distinct().join(place.toDF("a", "an", "fa", "ta"), "a").join(place.toDF("b", "bn", "fb", "tb"), "b")

    def run(batches):
        opened = {}

        def grams(file, at, n):
            if file not in opened:
                opened[file] = read_file(file, "<u8")
            return opened[file][at:at + n]

        for b in batches:
            good = []
            for r in b.to_pylist():
                x, y = grams(r["fa"], r["ta"], r["an"]), grams(r["fb"], r["tb"], r["bn"])
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                both = int((y[at] == x).sum())
                good.append(den * both >= num * (len(x) + len(y) - both))
            yield b.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return located.mapInArrow(run, "a long, b long")


def _labelled(entries: DataFrame, components: DataFrame) -> DataFrame:
    return entries.join(components, entries.row == components.node, "left").select("h", "row", "n", "pos", F.coalesce("component", "row").alias("comp"))


def _fits(num: int, den: int):
    """Bounds on rows x and y of one dense column.

    A pair that shares any other column is a candidate already. One that doesn't meets these at the first column it
    shares: all that it has in common lies from there on.
    """
    n, m = F.least("x.n", "y.n"), F.greatest("x.n", "y.n")
    common = F.least(F.col("x.n") - F.col("x.pos"), F.col("y.n") - F.col("y.pos"))
    return (n * den >= m * num) & (common * (num + den) >= (n + m) * num)


def components(docs: DataFrame, k: int = WORDS, threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, the smallest doc_id reachable by links (itself included).

    Two documents link when ``den * |A and B| >= num * |A or B|`` of their n-gram sets. Documents without words link with
    nothing. Equal sets link. Rows that share a doc_id are one document each way they are reached; a null doc_id keeps
    its row, and its component is the smallest doc_id of its group (null where it has none). Extra columns are ignored.
    """
    num, den = threshold
    spark = docs.sparkSession
    rows = stored(_rows(docs, frequent_grams(docs, k), k, num, den), "rows")
    distinct = rows.where("n > 0").groupBy("row").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("prefix").alias("prefix"))
    run, schema = _product(num, den)
    found = stored(_blocks(distinct, shards(spark, 1)).groupBy("block").applyInArrow(run, schema), "product")
    dense = found.where("h IS NOT NULL").select("h", "row", "n", "pos")
    counts = dense.groupBy("row").agg(F.count("*").alias("dense"))
    shared = found.where("a IS NOT NULL").groupBy("a", "b").agg(F.first("an").alias("an"), F.first("bn").alias("bn"), F.sum("shared").alias("shared"))
    shared = shared.join(counts.select(F.col("row").alias("a"), F.col("dense").alias("da")), "a", "left").join(counts.select(F.col("row").alias("b"), F.col("dense").alias("db")), "b", "left")
    shared = stored(shared.where(F.col("shared") + F.least(F.coalesce("da", F.lit(0)), F.coalesce("db", F.lit(0))) >= _least_shared(num, den)).select("a", "b", "shared"), "pairs")
    central = dense.join(counts, "row")
    pivots = central.groupBy("h").agg(F.max_by(F.struct("row", "n"), F.struct("dense", "row")).alias("p"))
    starred = dense.alias("x").join(pivots, "h").select("x.*", F.col("p.row").alias("pivot"), F.col("p.n").alias("pn")).where("row <> pivot AND least(n, pn) * %d >= greatest(n, pn) * %d" % (den, num))
    starred = starred.groupBy(F.col("pivot").alias("a"), F.col("row").alias("b")).agg(F.count("*").alias("shared"))
    best = shared.unionByName(shared.select(F.col("b").alias("a"), F.col("a").alias("b"), "shared")).unionByName(starred)
    best = best.groupBy("b").agg(F.max_by("a", F.struct("shared", F.col("a"))).alias("a")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    ids = rows.where("n > 0").groupBy("row").agg(F.min("doc_id").alias("doc_id"))
    named = shared.select(F.col("a").alias("row")).unionByName(shared.select(F.col("b").alias("row"))).unionByName(dense.select("row")).distinct()
    sets = stored(_keep_named(docs, stored(ids.join(named, "row"), "named"), k), "sets")

    links = stored(_checked(best, sets, num, den), "links")
    comp = stored(connected(links), "components")
    a, b = comp.select(F.col("node").alias("a"), F.col("component").alias("ca")), comp.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    rest = shared.join(a, "a", "left").join(b, "b", "left").where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")
    marked = stored(_labelled(dense, comp), "dense")
    sizes = marked.groupBy("h", "comp").count()
    main = sizes.groupBy("h").agg(F.max_by("comp", F.struct("count", "comp")).alias("main"), F.count("*").alias("n_comp")).where("n_comp > 1")
    open_ = marked.join(main, "h")
    left = open_.where("comp <> main").alias("x").join(open_.alias("y"), "h").where((F.col("x.comp") != F.col("y.comp")) & _fits(num, den))
    rest = rest.unionByName(left.select(F.least("x.row", "y.row").alias("a"), F.greatest("x.row", "y.row").alias("b"))).distinct()
    more = _checked(stored(_possible(rest, sets, num, den), "rest"), sets, num, den)
    comp = connected(links.unionByName(more))

    members = rows.where("n > 0").select("doc_id", "row").join(comp, F.col("row") == F.col("node"), "left").select("row", "doc_id", F.coalesce("component", "row").alias("comp"))
    least = members.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    labels = members.select("row", "comp").distinct().join(least, "comp").select("row", "component_id")
    return rows.select("doc_id", "n", "row").join(labels, "row", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each component, all columns kept; rows without words all stay.

    The row with the smallest doc_id stays, null after all others; of several such rows the one with the least hash of
    all its columns; of equal rows any one.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    at = dict(zip(docs.columns, names, strict=True))
    # A written number for each row: rows that share a doc_id, or have none, are told apart by it.
    rows = stored(docs.toDF(*names).withColumn("__no", F.monotonically_increasing_id()), "numbered")
    found = components(rows.select(F.col("__no").alias("doc_id"), F.col(at["text"]).alias("text"))).where("n_shingles > 0")
    order = F.struct(F.col(at["doc_id"]).isNull(), F.col(at["doc_id"]), F.xxhash64(*names), "__no")
    keyed = rows.select("__no", order.alias("o")).join(found.select(F.col("doc_id").alias("__no"), "component_id"), "__no")
    first = keyed.groupBy("component_id").agg(F.min("o").alias("o")).select(F.col("o.__no").alias("__kept"))
    gone = keyed.join(first, F.col("__no") == F.col("__kept"), "left_anti").select(F.col("__no").alias("__gone"))
    return rows.join(gone, F.col("__no") == F.col("__gone"), "left_anti").select(*names).toDF(*docs.columns)
