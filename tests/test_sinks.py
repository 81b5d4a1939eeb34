import pytest
from pyspark.sql import types as T

from cohortry.session import shared_folder
from cohortry.sources import schemas, sinks
from tests.conftest import rows

SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False), T.StructField("x", T.DecimalType(7, 5), False),
    T.StructField("note", T.StringType(), True),
])


def test_typed_load_casts_and_keeps_rows(spark):
    df = spark.createDataFrame([(1, 0.5, None), (2, 0.25, "n")], "id int, x double, note string")
    loaded = sinks.typed_load(df, SCHEMA, shared_folder(spark, "t"))
    assert [f.dataType for f in loaded.schema.fields] == [f.dataType for f in SCHEMA.fields]
    assert loaded.count() == 2


def test_typed_load_refuses_nulls_overflow_and_missing_columns(spark):
    bad = spark.createDataFrame([(None, 0.5, None)], "id int, x double, note string")
    assert rows(sinks.null_violations(bad, SCHEMA)) == [(1, 0)]
    with pytest.raises(Exception, match="NULL in required column id"):
        sinks.typed_load(bad, SCHEMA, shared_folder(spark, "t"))
    wide = spark.createDataFrame([(1, 1e9, None)], "id int, x double, note string")
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        sinks.typed_load(wide, SCHEMA, shared_folder(spark, "t"))
    with pytest.raises(sinks.LoadError, match="note"):
        sinks.conform(bad.drop("note"), SCHEMA)


def test_clustered_files_hold_narrow_ranges(spark, cohort):
    path = shared_folder(spark, "c")
    stored = sinks.write_clustered(cohort.calls, path, ["variant_type", "gene_id"], cohort.call_key, 6)
    assert stored.count() == cohort.calls.count()
    files = stored.selectExpr("input_file_name() AS f", "variant_type AS t", "gene_id AS g")
    spans = files.groupBy("f").agg({"g": "count"}).count()
    assert spans == 6
    hit = files.filter("t = 'F' AND g = 5").select("f").distinct().count()
    assert hit <= 2


def test_one_hot_cluster_key_still_covers_several_files(spark):
    hot = spark.range(6000).selectExpr("1 AS k", "id")
    stored = sinks.write_clustered(hot, shared_folder(spark, "h"), ["k"], ["id"], 4)
    assert len(stored.inputFiles()) == 4


def test_write_back_and_save_table(spark):
    df = spark.range(5)
    assert sinks.write_back(df, shared_folder(spark, "w")).count() == 5
    assert sinks.save_table(df, "saved_rows").count() == 5
    assert sinks.save_table(spark.range(2), "saved_rows").count() == 2


def test_declared_schemas():
    assert [len(s) for s in (schemas.PANEL, schemas.PATIENTS, schemas.SPECIMENS, schemas.CALLS, schemas.REPORTS)] == [7, 7, 10, 15, 6]
    assert [f.name for f in schemas.PANEL.fields if f.nullable] == ["targeted_therapy"]


def test_repeated_load_counts_once_and_a_failed_one_changes_nothing(spark):
    path = shared_folder(spark, "loads")
    day = lambda *ids: spark.createDataFrame([(i, 0.5, "n") for i in ids], "id int, x double, note string")
    sinks.load_part(day(1, 2), SCHEMA, path, "monday")
    sinks.load_part(day(3), SCHEMA, path, "tuesday")
    loaded = sinks.load_part(day(1, 2, 4), SCHEMA, path, "monday")
    want = [(1, "monday"), (2, "monday"), (3, "tuesday"), (4, "monday")]
    assert rows(loaded.select("id", "load_id")) == want
    with pytest.raises(Exception, match="NULL in required column id"):
        sinks.load_part(day(5, None), SCHEMA, path, "monday")
    assert rows(spark.read.parquet(path).select("id", "load_id")) == want
    assert [f.dataType for f in loaded.schema.fields[:3]] == [f.dataType for f in SCHEMA.fields]


def test_table_is_replaced_from_itself_and_survives_a_failed_write(spark):
    first = sinks.replace_table(spark.range(10).selectExpr("id", "id % 2 AS odd"), "numbers_now")
    held = spark.table("numbers_now")
    second = sinks.replace_table(spark.table("numbers_now").filter("odd = 1"), "numbers_now")
    assert (first.count(), held.count(), second.count(), spark.table("numbers_now").count()) == (10, 10, 5, 5)
    with pytest.raises(Exception, match="not this one"):
        sinks.replace_table(spark.table("numbers_now").selectExpr("id", "raise_error('not this one') AS odd"), "numbers_now")
    assert rows(spark.table("numbers_now").select("id")) == [(1,), (3,), (5,), (7,), (9,)]


def test_bucketed_tables_join_without_moving_rows(spark):
    a = sinks.save_bucketed(spark.range(500).selectExpr("id % 50 AS k", "id AS v"), "bucketed_a", "k", 4)
    b = sinks.save_bucketed(spark.range(50).selectExpr("id AS k", "id * 2 AS w"), "bucketed_b", "k", 4)
    joined = a.hint("merge").join(b, "k")
    assert joined.count() == 500
    joined.collect()
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()


def test_pruned_layout_keeps_nulls_and_spreads_a_hot_value(spark):
    df = spark.range(1000).selectExpr("id", "CASE WHEN id < 900 THEN 'hot' WHEN id < 990 THEN 'cold' END AS part")
    # A table this small would be put into one task.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        stored = sinks.write_pruned(df, shared_folder(spark, "pruned"), "part")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert rows(stored.groupBy("part").count()) == [("cold", 90), ("hot", 900), (None, 10)]
    assert stored.filter("part = 'hot'").select("_metadata.file_path").distinct().count() > 1
