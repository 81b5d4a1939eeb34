"""Every registered query against its SQL twin in DuckDB."""

import duckdb
import pytest

from cohortry.plans.oracle import ORACLE
from cohortry.plans.queries import QUERIES
from tests.conftest import SMALL

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "boolean": "BOOLEAN",
}
# Trained models have no SQL form; see also test_models.
ROWS_ONLY = {"lr_scores", "rf_scores", "gbt_scores"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


def test_every_query_but_the_models_has_a_twin():
    assert set(ORACLE) == set(QUERIES) - ROWS_ONLY


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_result_as_sql(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    columns = sorted(df.columns)
    got = [tuple(r[c] for c in columns) for r in df.collect()]
    done = duck.execute(ORACLE[name])
    names = [d[0] for d in done.description]
    types = {d[0]: str(d[1]) for d in done.description}
    assert sorted(names) == columns
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema.fields} == types
    want = [tuple(r[names.index(c)] for c in columns) for r in done.fetchall()]
    key = lambda t: tuple((v is None, str(v)) for v in t)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert got


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_rows_only_queries_run(spark, name):
    scored = QUERIES[name](spark, SMALL)
    assert scored.count() > 0 and scored.filter("score IS NULL OR score < 0 OR score > 1").count() == 0
    assert {r.prediction for r in scored.select("prediction").distinct().collect()} == {0, 1}
