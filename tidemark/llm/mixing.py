"""Operator 5: mixing sources to target weights by iterative proportional fitting.

Documents are summed to cells (source, language, topic) of tokens. Each round
scales the cells' weights so that their tokens meet the target share of every
source, then of every language, then of every topic, until a round changes no
weight any more. A document is kept with the probability ``share`` times its
cell's weight, where ``share`` is at most one over the greatest weight: so no
probability exceeds one and the sample has the target shares in expectation,
with every document at most once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import stored

DIMENSIONS = ("source", "lang", "topic")
#: Target shares are the observed ones to this power, made to sum to one: large classes give way to small ones. The
#: greatest weight, and with it the part of the documents that a sample without repeats can hold, follows from it.
FLATTEN = 0.95
#: No more than this part of the tokens is kept, even where no weight exceeds one.
KEPT_SHARE, SEED = 0.8, "mix-1"
#: A round that changes weights by less than this (relative) is the last.
TOLERANCE, ROUNDS = 1e-10, 12
WORD = r"[^\x20\x09-\x0D]+"
#: Kinds of writing by a mark that a text holds, the first that fits; all others are ``OTHER``. Counts of marks would tell
#: more, but each is one more pass over every text.
MARKS = {"legal": "icense", "table": " | ", "contact": "@", "web": "://"}
OTHER = "prose"


def topic(text: Column) -> Column:
    """Kind of writing of a text that is not null."""
    kind = F
    for k, mark in MARKS.items():
        kind = kind.when(text.contains(mark), k)
    return kind.otherwise(OTHER)


def _attributes(docs: DataFrame) -> DataFrame:
    text = F.coalesce("`text`", F.lit(""))
    return docs.select(F.col("`doc_id`").alias("doc_id"), F.coalesce("`source`", F.lit("")).alias("source"), F.coalesce("`lang`", F.lit("")).alias("lang"),
                       topic(text).alias("topic"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("n_tokens"))


def _targets(cells: DataFrame, dimension: str, flatten: float) -> DataFrame:
    """Target share per class of one dimension; classes without tokens have none."""
    sums = cells.groupBy(dimension).agg(F.sum("n_tokens").alias("t")).where("t > 0").withColumn("p", F.pow(F.col("t").cast("double"), F.lit(flatten)))
    return sums.select(dimension, (F.col("p") / sums.agg(F.sum("p")).scalar()).alias("target"))


def raked(cells: DataFrame, dimensions: Sequence[str] = DIMENSIONS, flatten: float = FLATTEN, tolerance: float = TOLERANCE, rounds: int = ROUNDS) -> DataFrame:
    """``cells`` (dimensions, n_tokens) with the weight that brings their token shares to the targets.

    Sums and joins over cells only, written to the shared folder once a round; the driver sees one number a round.
    Cells without tokens have weight 1. Where cells are empty that the targets would need, rounds may go on for long;
    after ``rounds`` of them the last weights stand, with the last dimension's shares met exactly.
    """
    cells = stored(cells, "cells")
    total = cells.agg(F.sum("n_tokens").cast("double")).scalar()
    now = cells.where("n_tokens > 0").select(*dimensions, (F.col("n_tokens") / total).alias("share"), F.lit(1.0).alias("weight"))
    for d in dimensions:
        now = now.join(_targets(cells, d, flatten).withColumnRenamed("target", f"t_{d}").hint("merge"), d)
    kept = [*dimensions, "share", *[f"t_{d}" for d in dimensions]]
    now = stored(now.select(*kept, "weight"), "raked")
    for _ in range(rounds):
        nxt = now.withColumn("was", F.col("weight"))
        for d in dimensions:
            # Sorted joins: a hash table for the small side of every step of every round would fill the driver.
            have = nxt.groupBy(d).agg((F.first(f"t_{d}") / F.sum(F.col("share") * F.col("weight"))).alias("factor"))
            nxt = nxt.join(have.hint("merge"), d).withColumn("weight", F.col("weight") * F.col("factor")).drop("factor")
        now = stored(nxt.select(*kept, "weight", F.abs(F.col("weight") / F.col("was") - 1).alias("change")), "raked")
        change = now.agg(F.max("change")).first()[0]
        now = now.drop("change")
        if change is None or change < tolerance:
            break
    now = now.select(*dimensions, "share", "weight")
    return stored(cells.join(now.drop("share"), list(dimensions), "left").select(*dimensions, "n_tokens", F.coalesce("weight", F.lit(1.0)).alias("weight")), "weights")


def uniform(key: Column, seed: str = SEED) -> Column:
    """Number in [0, 1) from a hash of the key; null keys share one."""
    return F.conv(F.substring(F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(":" + seed))), 1, 8), 16, 10).cast("double") / F.lit(float(2 ** 32))


def _calibrated(attributes: DataFrame, kept_share: float) -> DataFrame:
    """(dimensions, weight, prob) of every cell: prob is the weight times the share that keeps the greatest one at 1 or below."""
    cells = raked(attributes.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("n_tokens")))
    most = cells.agg(F.max(F.when(F.col("n_tokens") > 0, F.col("weight")))).scalar()
    prob = F.col("weight") * F.least(F.lit(kept_share), 1.0 / most)
    return stored(cells.select(*DIMENSIONS, "weight", F.least(F.lit(1.0), F.coalesce(prob, F.lit(kept_share))).alias("prob")), "probabilities")


def weighted(docs: DataFrame, kept_share: float = KEPT_SHARE) -> DataFrame:
    """doc_id, source, lang, topic, n_tokens, weight, prob, kept per document.

    Null source or language is the class "", null text has no tokens. Cells without tokens have weight 1 and move no
    share. Repeated rows are decided alike.
    """
    attributes = stored(_attributes(docs), "attributes")
    cells = _calibrated(attributes, kept_share)
    return attributes.join(cells, list(DIMENSIONS)).withColumn("kept", uniform(F.col("doc_id")) < F.col("prob")).select("doc_id", *DIMENSIONS, "n_tokens", "weight", "prob", "kept")


def sample(docs: DataFrame, kept_share: float = KEPT_SHARE) -> DataFrame:
    """The kept documents with all their columns; their tokens have the target shares in expectation."""
    cells = _calibrated(stored(_attributes(docs), "attributes"), kept_share)
    names = [f"c{i}" for i in range(len(docs.columns))]
    at = dict(zip(docs.columns, names, strict=True))
    col = lambda k: F.col(at[k])
    keyed = docs.toDF(*names).withColumns({"source": F.coalesce(col("source"), F.lit("")), "lang": F.coalesce(col("lang"), F.lit("")), "topic": topic(F.coalesce(col("text"), F.lit("")))})
    return keyed.join(cells, list(DIMENSIONS)).where(uniform(col("doc_id")) < F.col("prob")).select(*names).toDF(*docs.columns)


def oracle(rounds: int = ROUNDS) -> str:
    """The same in SQL, all rounds written out."""
    ctes = [f"""a AS (SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS n_tokens,
  CASE {' '.join(f"WHEN contains(text, '{m}') THEN '{k}'" for k, m in MARKS.items())} ELSE '{OTHER}' END AS topic FROM documents)""",
            "cells AS (SELECT source, lang, topic, sum(n_tokens) AS n FROM a GROUP BY ALL HAVING sum(n_tokens) > 0)"]
    for d in DIMENSIONS:
        ctes.append(f"t_{d} AS (SELECT {d}, pow(sum(n)::DOUBLE, {FLATTEN}::DOUBLE) / sum(pow(sum(n)::DOUBLE, {FLATTEN}::DOUBLE)) OVER () AS target FROM cells GROUP BY {d})")
    ctes.append("r0 AS (SELECT source, lang, topic, n::DOUBLE / sum(n) OVER () AS share, 1::DOUBLE AS weight FROM cells)")
    last, k = "r0", 0
    for _ in range(rounds):
        for d in DIMENSIONS:
            k += 1
            ctes.append(f"r{k} AS MATERIALIZED (SELECT source, lang, topic, share, weight * (target / sum(share * weight) OVER (PARTITION BY {d})) AS weight FROM {last} JOIN t_{d} USING ({d}))")
            last = f"r{k}"
    prob = f"least(1::DOUBLE, coalesce(weight, 1) * least({KEPT_SHARE}::DOUBLE, 1 / (SELECT max(weight) FROM {last})))"
    return "WITH " + ",\n".join(ctes) + f"""
SELECT doc_id, source, lang, topic, n_tokens, round(coalesce(weight, 1), 6) AS weight, round({prob}, 6) AS prob, (u / 4294967296::DOUBLE) < {prob} AS kept
FROM (SELECT *, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':{SEED}'), 1, 8))::BIGINT AS u FROM a) LEFT JOIN {last} USING (source, lang, topic)"""
