"""Operator 6: personal data by bootstrapped contextual extraction, in DataFrame expressions only.

Base entities (email, ip, card, phone) are found by pattern in every whole
text. They seed a graph between instances (tokens that hold a digit or an @;
groups of digits with one blank between them are one token) and lexical
patterns (the two words before, or the words around, a token). In each round
patterns are ranked by the instances known so far: one is trusted for a kind
that holds enough distinct known instances and nearly all of its places. Its
other instances that have the shape of that kind become known, with its trust,
and count as seeds in the next round, until none is new. Instances of trusted
patterns become spans of the pattern's kind, wherever those patterns hold
them. The base spans always stay.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import narrow, stored

KINDS = ("email", "ip", "card", "phone")
#: Same matches as the plain patterns; possessive loops and starts at run edges keep them linear in very long texts.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Digit groups with one blank between them, then any token that holds a digit or an @.
TOKEN = r"(?<!\S)(?:[+(]*+[0-9][0-9()-]*+\x20(?=\(?[0-9]))*+[^\s0-9@]*+[0-9@]\S*+"
#: What an instance found by context has to look like, by kind, and how many digits it holds.
SHAPE = {
    "email": r"^[^\s@]++@[^\s@]++$",
    "ip": r"^(?:[0-9A-Fa-f:.]*?::[0-9A-Fa-f:.]*+|(?:[0-9A-Fa-f]++:){7}[0-9A-Fa-f]++|[0-9]++(?:\.[0-9]++){3})$",
    "card": r"^[0-9][0-9\x20-]*+$",
    "phone": r"^[+(]?[0-9][0-9().\x20/-]*+$",
}
DIGITS = {"card": (12, 19), "phone": (6, 15)}
ROUNDS, MIN_SEEDS, MIN_TRUST = 5, 5, 0.9
#: Running values are made block by block, and pieces of text are cut from blocks, so both stay near linear.
BLOCK, CUT, WIDE = 256, 4096, 64
SPANS = "array<struct<kind:int,start:int,stop:int,value:string>>"


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is evaluated once."""
    return F.get(F.transform(F.array(value), use), 0)


def _running(values: Column, merge: Callable[[Column, Column], Column]) -> Column:
    """Running sums or maxima (0 is neutral) of an array of int, itself included."""
    def along(x, first):
        def step(acc, v):
            return _bound(merge(acc["top"], v), lambda t: F.struct(t.alias("top"), F.concat(acc["out"], F.array(t)).alias("out")))
        return F.aggregate(x, F.struct(first.alias("top"), F.array().cast("array<int>").alias("out")), step, lambda acc: acc["out"])

    def spread(blocks):
        tops = along(F.transform(blocks, lambda x: F.aggregate(x, F.lit(0), merge)), F.lit(0))
        return _bound(tops, lambda t: F.flatten(F.transform(blocks, lambda x, i: along(x, F.coalesce(F.get(t, i - 1), F.lit(0))))))

    def cut(v):
        last = F.greatest(F.floor((F.size(v) - 1) / BLOCK), F.lit(0)).cast("int")
        return _bound(F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(v, i * BLOCK + 1, BLOCK)), spread)

    return _bound(values, cut)


def _digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(total, i):
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        twice = 2 * d
        return total + F.when(i % 2 == 0, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), F.lit(0), add) % 10 == 0


def _valid(kind: str, v: Column) -> Column:
    d = _digits(v)
    if kind == "ip":
        return F.forall(F.split(v, r"\."), lambda x: F.regexp_replace(x, "^0+(?=.)", "").rlike("^(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return F.length(d).between(16, 19) & _luhn(d)
    if kind == "phone":
        return F.length(d).between(8, 15)
    return F.lit(True)


def _shaped(kind: Column, v: Column) -> Column:
    """Whether ``v`` may be an entity of a kind (its number) where a trusted pattern says so."""
    out = F.lit(False)
    for i, k in enumerate(KINDS):
        ok = v.rlike(SHAPE[k])
        if k in DIGITS:
            ok = ok & F.length(_digits(v)).between(*DIGITS[k])
        out = F.when(kind == i, ok).otherwise(out)
    return out


def _located(hits: Column, pieces: Column) -> Column:
    """Array of (start, stop, value, before, after) in code points, from the matches and the text between them."""
    def place(p):
        def at(stops):
            return F.transform(hits, lambda v, i: F.struct(
                (F.get(stops, i) - F.length(v)).alias("start"), F.get(stops, i).alias("stop"), v.alias("value"),
                F.right(F.get(p, i), F.lit(80)).alias("before"), F.left(F.get(p, i + 1), F.lit(40)).alias("after")))
        return _bound(_running(F.transform(hits, lambda v, i: F.length(F.get(p, i)) + F.length(v)), lambda x, y: x + y), at)
    return _bound(pieces, place)


def _of_kind(kind: str, number: int, spans: Column) -> Column:
    good = F.filter(spans, lambda x: _valid(kind, x["value"]))
    return F.transform(good, lambda x: F.struct(F.lit(number).alias("kind"), x["start"].alias("start"), x["stop"].alias("stop"), x["value"].alias("value")))


def _trimmed(tokens: Column) -> Column:
    """Tokens without punctuation around them; a bracket stays where it opens a group of digits, colons before a short address."""
    def cut(t):
        def whole(n):
            v = F.regexp_replace(F.substring(t["value"], n + 1, F.length(t["value"])), r"(?<=[A-Za-z0-9])[^A-Za-z0-9]++$", "")
            return _bound(v, lambda x: F.struct((t["start"] + n).alias("start"), (t["start"] + n + F.length(x)).alias("stop"), x.alias("value"), t["before"].alias("before"), t["after"].alias("after")))
        return _bound(F.length(F.regexp_extract(t["value"], r"^(?:(?!\([0-9]++\)|::[0-9A-Fa-f])[^A-Za-z0-9@+])*+", 0)), whole)
    return F.transform(tokens, cut)


def _marked(tokens: Column, base: Column) -> Column:
    """Tokens with the kind of the first base span they overlap, null if none; spans are looked up by stretches of text."""
    def over(spans, lo, hi):
        return F.filter(spans, lambda s: (s["start"] < hi) & (lo < s["stop"]))

    def mark(near):
        def one(t):
            last = F.floor((F.greatest(t["stop"], t["start"] + 1) - 1) / CUT).cast("int")
            first = F.floor(t["start"] / CUT).cast("int")
            here = F.when(first == last, F.get(near, first)).otherwise(F.flatten(F.slice(near, first + 1, last - first + 1)))
            return F.struct(*[t[c].alias(c) for c in ("start", "stop", "value", "before", "after")], F.get(over(here, t["start"], t["stop"]), 0)["kind"].alias("kind"))
        return F.transform(tokens, one)

    def stretches(c, part):
        return F.transform(F.sequence(c * WIDE, F.least(c * WIDE + WIDE - 1, last)), lambda i: over(part, i * CUT, (i + 1) * CUT))

    last = F.floor(F.coalesce(F.element_at(tokens, -1)["stop"], F.lit(0)) / CUT).cast("int")
    near = F.flatten(F.transform(F.sequence(F.lit(0), F.floor(last / WIDE).cast("int")), lambda c: _bound(over(base, c * WIDE * CUT, (c + 1) * WIDE * CUT), lambda part: stretches(c, part))))
    return F.when(F.size(tokens) > 0, _bound(near, mark))


def found(rows: DataFrame, tokens: bool = True) -> DataFrame:
    """``rows`` (with a column text) and: base (array of kind number, start, stop, value), if asked tokens (array of located tokens, marked with base spans)."""
    text = F.coalesce("text", F.lit(""))
    maybe = {"email": text.contains("@"), "phone": text.contains("+")}
    patterns = {**BASE, "token": TOKEN}
    none = F.array().cast("array<string>")

    def spans(k):
        hits = F.when(maybe.get(k, F.lit(True)), F.regexp_extract_all(text, F.lit(patterns[k]), F.lit(0))).otherwise(none)
        return _bound(hits, lambda h: F.when(F.size(h) > 0, _located(h, F.split(text, patterns[k], -1))).otherwise(F.array().cast("array<struct<start:int,stop:int,value:string,before:string,after:string>>")))

    base = F.concat(*[_of_kind(k, i, spans(k)) for i, k in enumerate(KINDS)])
    if not tokens:
        return rows.withColumn("base", base)
    both = _bound(base, lambda b: F.struct(b.alias("base"), _bound(_trimmed(spans("token")), lambda t: _marked(t, b)).alias("tokens")))
    return rows.withColumn("__found", both).select(*rows.columns, "__found.base", "__found.tokens")


def _mentions(hit: DataFrame) -> DataFrame:
    """One row per token: its place, its two contexts, the kind of the base span it overlaps."""
    m = hit.select("doc_id", "text_hash", F.explode("tokens").alias("t")).select("doc_id", "text_hash", "t.*")
    words = F.filter(F.split(F.lower("before"), r"[^\p{L}\p{N}@=:]+"), lambda w: w != "")
    after = F.filter(F.split(F.lower("after"), r"[^\p{L}\p{N}@=:]+"), lambda w: w != "")
    left2, left1, right1 = F.when(F.size(words) > 1, F.concat_ws(" ", F.slice(words, -2, 2))), F.try_element_at(words, F.lit(-1)), F.try_element_at(after, F.lit(1))
    return m.select("doc_id", "text_hash", "value", "start", "stop", "kind",
                    F.array_compact(F.array(F.concat(F.lit("< "), left2), F.concat(left1, F.lit(" _ "), right1))).alias("contexts"))


def trusted(mentions: DataFrame, rounds: int = ROUNDS, min_seeds: int = MIN_SEEDS, min_trust: float = MIN_TRUST) -> DataFrame:
    """(context, kind, trust) of the patterns trusted at the end; equal mentions of any number of copies count once.

    A pattern's trust in a kind is the trust of its known instances of that kind over the number of all its instances.
    Patterns with fewer than ``min_seeds`` instances can never be trusted and leave the graph first.
    """
    edges = stored(mentions.select(F.explode("contexts").alias("context"), "value", "kind").groupBy("context", "value").agg(F.max("kind").alias("kind")), "edges")
    sizes = edges.groupBy("context").agg(F.count("*").alias("n")).where(F.col("n") >= min_seeds)
    live = stored(edges.join(sizes, "context"), "live")
    known = stored(live.where("kind IS NOT NULL").groupBy("value").agg(F.max("kind").alias("kind")).withColumn("trust", F.lit(1.0)), "known")
    pattern = None
    for _ in range(rounds):
        votes = live.drop("kind").join(known, "value").groupBy("context", "n", "kind").agg(F.count("*").alias("seeds"), F.sum("trust").alias("trust"))
        votes = votes.where(F.col("seeds") >= min_seeds).withColumn("trust", F.round(F.col("trust") / F.col("n"), 9)).where(F.col("trust") >= min_trust)
        pattern = stored(votes.groupBy("context").agg(F.max_by("kind", F.struct("trust", -F.col("kind"))).alias("kind"), F.max("trust").alias("trust")), "patterns")
        reach = live.drop("kind").join(pattern, "context").where(_shaped(F.col("kind"), F.col("value")))
        reach = reach.groupBy("value").agg(F.max_by("kind", F.struct("trust", -F.col("kind"))).alias("kind"), F.max("trust").alias("trust"))
        new = stored(reach.join(known, "value", "left_anti"), "known")
        if new.isEmpty():
            break
        known = known.unionByName(new)
    return pattern


def discovered(hit: DataFrame) -> DataFrame:
    """doc_id, text_hash, more (array of kind, start, stop, value): tokens that overlap no base span, in a trusted context, of its kind's shape."""
    mentions = stored(_mentions(hit), "mentions")
    new = mentions.where("kind IS NULL").drop("kind")
    placed = new.withColumn("context", F.explode("contexts")).join(trusted(mentions), "context").where(_shaped(F.col("kind"), F.col("value")))
    one = placed.groupBy("doc_id", "text_hash", "start", "stop", "value").agg(F.max_by("kind", F.struct("trust", -F.col("kind"))).alias("kind"))
    return one.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("kind", "start", "stop", "value")).alias("more"))


def _joined(spans: Column) -> Column:
    """kind:start:end, by kind as listed, then start, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_more per document.

    Null and empty texts have no spans. Offsets are code points, ends exclusive. Rows of equal doc_id and text get equal
    results, once each. Other columns are not read.
    """
    rows = narrow(docs, doc_id="doc_id", text="text").withColumn("text_hash", F.xxhash64("text"))
    hit = stored(found(rows).drop("text"), "found")
    more = discovered(hit)
    out = hit.alias("a").join(more.alias("b"), F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.text_hash") == F.col("b.text_hash")), "left")
    count = lambda i: F.size(F.filter("base", lambda s: s["kind"] == i)).cast("long")
    extra = F.coalesce("more", F.array().cast(SPANS))
    return out.select("a.doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)], F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
                      _joined(F.concat("base", extra)).alias("spans"), F.size(extra).cast("long").alias("n_more"))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets, as [EMAIL]; overlapping spans become one of the first kind.

    All columns stay, whatever their names; null texts stay null.
    """
    keyed = narrow(docs, doc_id="doc_id", text="text").withColumn("text_hash", F.xxhash64("text"))
    more = discovered(stored(found(keyed).drop("text"), "found")).select(F.col("doc_id").alias("m_doc"), F.col("text_hash").alias("m_hash"), "more")
    names = [f"c{i}" if c not in ("doc_id", "text") else c for i, c in enumerate(docs.columns)]
    base = found(docs.toDF(*names), tokens=False).withColumn("m_text", F.xxhash64("text"))
    both = base.join(more, F.col("doc_id").eqNullSafe(F.col("m_doc")) & (F.col("m_text") == F.col("m_hash")), "left")
    none = F.array().cast(SPANS)
    spans = F.array_sort(F.transform(F.concat("base", F.coalesce("more", none)), lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind"))))
    marks = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def put(parts, tops):
        def piece(lo, hi):
            return F.substring(F.array_join(F.slice(parts, F.floor(lo / CUT).cast("int") + 1, (F.floor(hi / CUT) - F.floor(lo / CUT)).cast("int") + 1), ""), lo % CUT + 1, hi - lo)

        def each(s, i):
            return _bound(F.coalesce(F.get(tops, i - 1), F.lit(0)), lambda top: F.when(s["start"] >= top, F.concat(piece(top, s["start"]), F.get(marks, s["kind"]))).otherwise(F.lit("")))

        return F.concat(F.array_join(F.transform("spans", each), ""), piece(F.element_at(tops, -1), F.length("text")))

    parts = F.regexp_extract_all(F.col("text"), F.lit(f"(?s).{{1,{CUT}}}"), F.lit(0))
    stops = _running(F.transform("spans", lambda s: s["stop"]), lambda x, y: F.greatest(x, y))
    clean = _bound(F.struct(parts.alias("parts"), stops.alias("stops")), lambda x: put(x["parts"], x["stops"]))
    return both.withColumn("spans", spans).withColumn("text", F.when(F.size("spans") > 0, clean).otherwise(F.col("text"))).select(*names).toDF(*docs.columns)
