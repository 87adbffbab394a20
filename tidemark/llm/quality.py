"""Operator 7: quality by weak supervision.

Seven rules look at counts of a whole text and each votes bad, abstains or,
two of them, votes good. Expectation-maximisation over the counts of vote patterns (at most
3**7 rows, whatever the corpus) estimates how often each rule votes how for
good and for bad documents, and with it the probability that a document with
a given pattern is good. A document stays when that is at least one half.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import hash_words, mix, narrow, stored, text_pieces, word_bounds

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters", "n_upper", "n_bangs")
SCHEMA = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS)
#: Bad below the first number of words, good from the second on.
LENGTH_BAD, LENGTH_GOOD = 50, 100
#: Bad where the first count is at least this share of the second, else no vote.
RATIOS = (("n_symbols", "n_words", 0.10), ("n_dup_lines", "n_lines", 0.50), ("n_repeat_words", "n_words", 0.40),
          ("n_upper", "n_letters", 0.40), ("n_bangs", "n_words", 0.20))
#: Bad where the mean word is shorter or longer; good between the inner two.
WORD_LENGTH = (2.0, 3.0, 9.0, 16.0)
RULES = 2 + len(RATIOS)
ROUNDS = 60
#: No rule is taken to call more than this share of the good documents bad.
FALSE_ALARMS = 0.002


def _flags(*chars: str) -> np.ndarray:
    out = np.zeros(256, np.int64)
    out[[ord(c) for group in chars for c in group]] = 1
    return out


_SYMBOL, _BANG = _flags("#*$%&|<>"), _flags("!")
_UPPER, _LETTER = np.zeros(256, np.int64), np.zeros(256, np.int64)
_UPPER[65:91] = 1
_LETTER[65:91] = _LETTER[97:123] = 1


def text_counts(column: pa.Array) -> np.ndarray:
    """One row of ``COUNTS`` per text; words are ``[^\\x20\\x09-\\x0D]+``, null is empty."""
    out = []
    for lo, hi, data, offs in text_pieces(column):
        starts, ends, first = word_bounds(data, offs)
        n_words = np.diff(first)
        solid_points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        word_sum = np.concatenate([[0], np.cumsum(solid_points[ends] - solid_points[starts])])

        def total(flags, data=data, offs=offs):
            return np.diff(np.concatenate([[0], np.cumsum(flags[data])])[offs])

        words = hash_words(data, starts, ends, lower=False)
        row = np.repeat(np.arange(hi - lo, dtype=np.uint64), n_words)
        covered = np.zeros(len(words), bool)
        if len(words) > 2:
            inside = row[2:] == row[:-2]
            window = mix(mix(mix(words[:-2] + row[:-2]) + words[1:-1]) + words[2:])
            window = np.where(inside, window, 0)
            _, back, times = np.unique(window, return_inverse=True, return_counts=True)
            again = (times[back] > 1) & inside
            for k in range(3):
                covered[k:len(words) - 2 + k] |= again
        repeat = np.diff(np.concatenate([[0], np.cumsum(covered)])[first])
        raw = data.tobytes()
        lines, dup = np.zeros(hi - lo, np.int64), np.zeros(hi - lo, np.int64)
        for i in range(hi - lo):
            real = [x for x in raw[offs[i]:offs[i + 1]].split(b"\n") if x.strip()]
            lines[i], dup[i] = len(real), len(real) - len(set(real))
        out.append(np.column_stack([n_words, np.diff(word_sum[first]), total(_SYMBOL), dup, repeat, lines, total(_LETTER), total(_UPPER), total(_BANG)]))
    return np.concatenate(out) if out else np.zeros((0, len(COUNTS)), np.int64)


def counted(docs: DataFrame) -> DataFrame:
    """doc_id and ``COUNTS`` of every document: one pass, no shuffle."""

    def run(batches):
        for b in batches:
            c = text_counts(b.column(1))
            yield pa.record_batch([b.column(0), *[pa.array(c[:, i]) for i in range(len(COUNTS))]], ["doc_id", *COUNTS])

    return narrow(docs, doc_id="doc_id", text="text").mapInArrow(run, SCHEMA)


def votes(c) -> list[Column]:
    """-1 bad, 0 abstains, 1 good; ratios of nothing abstain."""
    n = c("n_words")
    out = [F.when(n < LENGTH_BAD, -1).when(n >= LENGTH_GOOD, 1).otherwise(0)]
    out += [F.when((c(base) > 0) & (c(top) >= bad * c(base)), -1).otherwise(0) for top, base, bad in RATIOS]
    a, b, d, e = WORD_LENGTH
    mean = c("word_chars")
    out.append(F.when(n == 0, 0).when((mean < a * n) | (mean > e * n), -1).when((mean >= b * n) & (mean <= d * n), 1).otherwise(0))
    return out


def pattern(c=F.col) -> Column:
    """All votes as one number in base 3."""
    return sum(((v + 1) * 3 ** i for i, v in enumerate(votes(c))), F.lit(0)).cast("int")


def base_failed(c=F.col) -> Column:
    return (c("n_words") < 50) | (100 * c("n_repeat_words") > 50 * c("n_words"))


def posterior(counts: dict[int, int]) -> dict[int, float]:
    """Probability of good per vote pattern by expectation-maximisation over pattern counts.

    Starts from rules that seldom call a good document bad and that each catch a part of the bad ones; these rates also
    weigh as a prior as much as a tenth of all documents. Of good documents a rule calls at most ``FALSE_ALARMS`` bad:
    one that fires on a kind of bad document of its own, where no other rule can agree, would else be explained away.
    """
    if not counts:
        return {}
    keys = np.array(sorted(counts))
    weight = np.array([counts[k] for k in keys], float)
    vote = np.stack([keys // 3 ** i % 3 for i in range(RULES)])
    seen = np.stack([vote == v for v in range(3)], -1).astype(float)
    hold = 1 + weight.sum() / 10
    start_good, start_bad = np.tile([0.002, 0.198, 0.8], (RULES, 1)), np.tile([0.2, 0.3, 0.5], (RULES, 1))
    start_good[1:-1], start_bad[1:-1] = [0.002, 0.996, 0.002], [0.2, 0.799, 0.001]
    good, bad, share = start_good.copy(), start_bad.copy(), 0.9
    for _ in range(ROUNDS):
        g = np.log(share) + np.einsum("rpv,rv->p", seen, np.log(good))
        b = np.log1p(-share) + np.einsum("rpv,rv->p", seen, np.log(bad))
        post = 1 / (1 + np.exp(np.clip(b - g, -700, 700)))
        share = float(np.clip((weight @ post + 0.9 * hold) / (weight.sum() + hold), 0.5, 0.99))
        for table, w, start in ((good, weight * post, start_good), (bad, weight * (1 - post), start_bad)):
            t = np.einsum("rpv,p->rv", seen, w) + hold * start
            table[:] = t / t.sum(1, keepdims=True)
        good[:, 0] = np.minimum(good[:, 0], FALSE_ALARMS)
        good /= good.sum(1, keepdims=True)
    return {int(k): float(p) for k, p in zip(keys, post, strict=True)}


def fit(counts: DataFrame) -> DataFrame:
    """pattern, quality: the fitted model, at most 3**7 rows."""
    found = counts.groupBy(pattern().alias("pattern")).count().collect()
    model = posterior({r["pattern"]: r["count"] for r in found})
    return counts.sparkSession.createDataFrame(list(model.items()), "pattern int, quality double")


def verdicts(docs: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed, quality (probability of good) and kept per document.

    Null and empty texts have no words and fail the base rules. Equal rows get equal verdicts; no documents, no rows.
    """
    counts = stored(counted(docs), "quality")
    model = fit(counts)
    known = counts.withColumn("pattern", pattern()).join(F.broadcast(model), "pattern", "left").drop("pattern")
    return known.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= 0.5))


def keep_clean(docs: DataFrame) -> DataFrame:
    """The documents whose verdict is kept, with all their columns. Two passes over the text, none of it shuffled."""
    model = fit(counted(docs))
    at = docs.columns.index("text")

    def run(batches):
        for b in batches:
            c = text_counts(b.column(at))
            counts = pa.StructArray.from_arrays([pa.array(c[:, i]) for i in range(len(COUNTS))], list(COUNTS))
            yield pa.RecordBatch.from_arrays([*b.columns, counts], [*names, own])

    names = [f"c{i}" for i in range(len(docs.columns))]
    own = "counts"
    plain = docs.toDF(*names)
    inner = ", ".join(f"{c}: bigint" for c in COUNTS)
    schema = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, docs.schema, strict=True)) + f", {own} struct<{inner}>"
    c = lambda k: F.col(f"{own}.{k}")
    marked = plain.mapInArrow(run, schema).withColumn("pattern", pattern(c)).join(F.broadcast(model), "pattern", "left")
    return marked.where(~base_failed(c) & (F.col("quality") >= 0.5)).select(*names).toDF(*docs.columns)
