"""The registered queries, their SQL twins and the pipeline."""

import duckdb
import pytest

import corpus_pipeline
from cohortry.llm.mixing import MAX_COPIES
from cohortry.llm.oracle import ORACLE
from cohortry.llm.queries import QUERIES
from tests.llm.conftest import SMALL

CONTRACTS = {
    1: "page_id url text n_chars", 3: "doc_id held_out score predicted",
    4: "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    5: "doc_id n_assign n_access n_hex base_sha256 spans", 7: "doc_id n_shingles component_id kept",
    8: "doc_id held_out lang_pred score", 9: "doc_id size text_crc32 law shard slot grown_shard",
    10: "doc_id n_words n_removed kept_sha256",
    11: "vec_id component n deviation whitened explained identity_error",
    12: "doc_id n_features weight score rank",
    13: "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
}


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows_as_sql(spark, name):
    con = duckdb.connect()
    for name_ in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {name_} AS SELECT * FROM '{SMALL}/{name_}.parquet'")
    result = con.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    want = sorted(result.fetchall(), key=repr)
    df = QUERIES[name](spark, SMALL)
    assert sorted(df.columns) == sorted(names)
    assert sorted((tuple(r) for r in df.select(names).collect()), key=repr) == want
    assert want


@pytest.mark.parametrize("number", sorted(CONTRACTS))
def test_columns(spark, number):
    name = next(n for n in QUERIES if n.startswith(f"op{number}_"))
    assert set(CONTRACTS[number].split()) <= set(QUERIES[name](spark, SMALL).columns)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, left = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.checkpointed(stage(spark, docs, SMALL))
        assert docs.columns == columns, name
        # Mixing repeats rows of rare cells.
        assert 0 < docs.count() <= left * (MAX_COPIES if name == "mixing" else 1), name
        left = docs.count()
    assert {r.doc_id for r in corpus_pipeline.run(spark, SMALL).collect()} == {r.doc_id for r in docs.collect()}


def test_pipeline_of_odd_rows(spark, documents):
    docs = documents
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
    assert docs.count() > 0
