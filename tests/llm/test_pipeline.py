"""The stages against their plain versions, one after another; the registered queries with SQL."""

import hashlib

import pytest

import corpus_pipeline
from compare import compare, connect
from test_ngram_join import plain as plain_groups
from tidemark.llm import ORACLES, QUERIES, byte_bpe, mixing, pii, quality

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = {r.doc_id for r in quality.verdicts(docs).collect() if r.kept}
    stages = dict(corpus_pipeline.STAGES)
    clean = stages["quality_rules"](spark, docs, FOLDER).cache()
    rows = sorted((r.doc_id, r.text) for r in clean.collect())
    assert {i for i, _ in rows} == kept
    assert clean.columns == docs.columns
    one = stages["near_duplicates"](spark, clean, FOLDER).cache()
    assert sorted(r.doc_id for r in one.collect()) == sorted(int(i) for i, _, c in plain_groups(rows) if i == c)
    bare = stages["personal_data"](spark, one, FOLDER).cache()
    left = pii.personal_data(bare).agg({"n_email": "sum", "n_ip": "sum", "n_card": "sum", "n_phone": "sum"}).first()
    assert sum(left) == 0 and bare.columns == docs.columns
    mixed = stages["source_mixing"](spark, bare, FOLDER).cache()
    assert {r.doc_id for r in mixed.collect()} == {r.doc_id for r in mixing.weighted(bare).collect() if r.kept}
    codec = byte_bpe.codec(byte_bpe.rank_file())
    want = sorted((r.doc_id, len(codec.encode(r.text)), hashlib.sha256(r.text.encode()).hexdigest()) for r in mixed.collect())
    got = corpus_pipeline.run(spark, FOLDER)
    assert sorted((r.doc_id, r.n_tokens, r.decoded_sha256) for r in got.collect()) == want


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    ok, message, _ = compare(spark, connect(FOLDER), FOLDER, name, QUERIES[name], ORACLES[name])
    assert ok, message


def test_a_query_for_every_operator():
    assert [n.split("_")[0] for n in sorted(QUERIES, key=lambda n: int(n.split("_")[0][2:]))] == [f"op{k}" for k in range(1, 14)]


def test_empty_table(spark, none, tmp_path):
    none.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
