"""Registered queries opN_<name> of the corpus operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import byte_bpe, grid_join, hard_negatives, kneser_ney, merkle, mixing, ngram_join, norm_buckets, pii, quality, repeats, token_files, toxic_spans
from tidemark.llm.shared import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return wrap


@query("op1_token_files")
def op1(spark, folder):
    """Token files of all documents, written and read back."""
    return token_files.token_file_digests(table(spark, folder, "documents"))


@query("op2_ngram_jaccard", r"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
i AS (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) > 0),
s AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS g FROM i),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS MATERIALIZED (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
r AS (WITH RECURSIVE r(a, b) AS (SELECT doc_id, doc_id FROM w UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a) SELECT a, min(b) AS c FROM r GROUP BY a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, r.c AS component_id FROM w JOIN r ON r.a = w.doc_id LEFT JOIN n ON n.doc_id = w.doc_id""")
def op2(spark, folder):
    """Near-duplicate components of all documents on five-word shingles."""
    return ngram_join.components(table(spark, folder, "documents"))


@query("op3_kneser_ney")
def op3(spark, folder):
    """Log10 probability of all documents under the model of the training ones."""
    return kneser_ney.scored(table(spark, folder, "documents"))


@query("op4_toxic_spans")
def op4(spark, folder):
    """Toxicity of all documents."""
    return toxic_spans.scored(table(spark, folder, "documents"), table(spark, folder, "labels")).drop("spans")


@query("op5_source_mixing", mixing.oracle())
def op5(spark, folder):
    """Weight, probability and decision of all documents."""
    return mixing.weighted(table(spark, folder, "documents")).withColumns({c: F.round(c, 6) for c in ("weight", "prob")})


@query("op6_contextual_pii")
def op6(spark, folder):
    """Personal data of all documents: base spans and those found by context."""
    return pii.personal_data(table(spark, folder, "documents"))


@query("op7_weak_supervision")
def op7(spark, folder):
    """Counts, base rules and the fitted verdict of all documents."""
    return quality.verdicts(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("quality", 6).alias("quality"))


@query("op8_interval_expansion")
def op8(spark, folder):
    """All documents without the bytes of strings of 200 bytes that occur more than once."""
    return repeats.without_repeats(table(spark, folder, "documents")).drop("kept")


@query("op9_grid_order_join", """
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
u AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS len FROM v WHERE e IS NOT NULL AND list_dot_product(e, e) > 0),
l AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id
      WHERE list_dot_product(a.e, b.e) / (a.len * b.len) >= 0.95),
r AS (WITH RECURSIVE r(a, b) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a) SELECT a, min(b) AS c FROM r GROUP BY a)
SELECT v.vec_id, count(l.b) AS n_links, any_value(r.c) AS component_id, v.vec_id = any_value(r.c) AS kept
FROM v JOIN r ON r.a = v.vec_id LEFT JOIN l ON l.a = v.vec_id GROUP BY v.vec_id""")
def op9(spark, folder):
    """Near-duplicate components of all embeddings."""
    return grid_join.near_duplicates(table(spark, folder, "embeddings"))


@query("op10_byte_bpe")
def op10(spark, folder):
    """Ids of all documents by the rank file, and the bytes decoded from them."""
    return byte_bpe.round_trip(table(spark, folder, "documents"))


@query("op11_merkle_manifest", merkle.oracle())
def op11(spark, folder):
    """Manifest of all documents, a proof of each, and what it makes of rows that were tampered with."""
    return merkle.checked(table(spark, folder, "documents"))


_INTEGERS = "list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"


@query("op12_hard_negatives", f"""
WITH t AS MATERIALIZED (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, {_INTEGERS} AND label IS NOT NULL),
s AS MATERIALIZED (SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS other, list_dot_product(a.v, b.v)::BIGINT AS score FROM t a JOIN t b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id, row_number() OVER w AS rank, s.other AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.other) QUALIFY row_number() OVER w <= 10""")
def op12(spark, folder):
    """Hard negatives of every anchor's positives among all embeddings, some labels switched."""
    return hard_negatives.hard_negatives(table(spark, folder, "embeddings"), hard_negatives.switched_label())


@query("op13_norm_buckets", f"""
WITH t AS MATERIALIZED (SELECT vec_id, {_INTEGERS}),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score FROM t q JOIN t c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, row_number() OVER w AS rank, vec_id, score FROM s WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 5""")
def op13(spark, folder):
    """The five highest integer products of every query row with all embeddings."""
    return norm_buckets.top_products(table(spark, folder, "embeddings"))
