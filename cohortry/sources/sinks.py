"""Typed loads, clustered layout and write-back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortry.operators.ranking import ranges_for
from cohortry.session import shared_folder

LOAD_ID = "load_id"
SPREAD = 8


class LoadError(ValueError):
    """A table does not fit its declared schema."""


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to the declared columns and types.

    A missing column is an error at once. A value that does not fit its type
    is an error when rows are read, as casts follow the ANSI rules.
    """
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise LoadError(f"missing columns: {', '.join(missing)}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def null_violations(df: DataFrame, schema: T.StructType) -> DataFrame:
    """One row: the count of NULLs in each column declared NOT NULL."""
    required = [f.name for f in schema.fields if not f.nullable]
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])


def typed_load(df: DataFrame, schema: T.StructType, path: str) -> DataFrame:
    """Write ``df`` under its declared schema and read it back.

    The NOT NULL check rides along with the write: a violating row fails the
    job, so the input is read once and no partial table is committed.
    """
    typed = conform(df, schema)
    checked = [
        F.col(f.name) if f.nullable else _required(f.name) for f in schema.fields
    ]
    typed.select(*checked).write.mode("overwrite").parquet(path)
    return typed.sparkSession.read.schema(schema).parquet(path)


def _required(name: str) -> Column:
    column = F.col(name)
    fail = F.raise_error(F.lit(f"NULL in required column {name}"))
    return F.when(column.isNotNull(), column).otherwise(fail).alias(name)


def write_clustered(
    df: DataFrame,
    path: str,
    cluster_by: Sequence[str],
    spread_by: Sequence[str],
    partitions: int | None = None,
) -> DataFrame:
    """Write rows sorted by the cluster keys, so that filters on them skip files.

    ``spread_by`` continues the sort order and lets a hot cluster key cover
    several files instead of one.
    """
    spark = df.sparkSession
    count = partitions or ranges_for(df)
    order = [*cluster_by, *spread_by]
    (
        df.repartitionByRange(count, *order)
        .sortWithinPartitions(*order)
        .write.mode("overwrite")
        .parquet(path)
    )
    return spark.read.parquet(path)


def write_back(df: DataFrame, path: str) -> DataFrame:
    """Persist a derived table on the executors and read it back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def save_table(df: DataFrame, name: str) -> DataFrame:
    """Persist a derived table under a catalog name."""
    df.write.mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def load_part(df: DataFrame, schema: T.StructType, path: str, load_id: str) -> DataFrame:
    """Add ``df`` to a table that may have rows already, as the load named ``load_id``.

    Each load is a partition of its own. Writing one replaces that partition alone
    and only when the job has succeeded, so a repeated load counts once and a failed
    one leaves what was there. Returns the whole table.
    """
    typed = conform(df, schema)
    checked = [F.col(f.name) if f.nullable else _required(f.name) for f in schema.fields]
    (
        typed.select(*checked, F.lit(load_id).alias(LOAD_ID))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(LOAD_ID)
        .parquet(path)
    )
    declared = T.StructType([*schema.fields, T.StructField(LOAD_ID, T.StringType())])
    return df.sparkSession.read.schema(declared).parquet(path)


def replace_table(df: DataFrame, name: str) -> DataFrame:
    """Make the catalog name ``name`` stand for the rows of ``df``.

    The rows go to a new folder first, and the view of that name is pointed at it
    last. Whoever reads the old rows keeps them, ``df`` itself may read the name, and
    a write that fails leaves the name as it was. Old folders are left to be cleaned.
    """
    spark = df.sparkSession
    path = shared_folder(spark, f"table-{name.replace('.', '-')}")
    df.write.parquet(path)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{path}`")
    return spark.table(name)


def save_bucketed(df: DataFrame, name: str, key: str, buckets: int | None = None) -> DataFrame:
    """Store rows in buckets of a key: joins and groups by it then move none of them.

    The number of buckets follows the size of ``df``; tables that are to be joined
    without moving either need the same one.
    """
    writer = df.write.bucketBy(buckets or ranges_for(df), key).sortBy(key).mode("overwrite")
    writer.option("path", shared_folder(df.sparkSession, "bucketed")).saveAsTable(name)
    return df.sparkSession.table(name)


def write_pruned(df: DataFrame, path: str, by: str) -> DataFrame:
    """Store rows in one folder per value of a column with few values.

    A filter on the column, or a join with a filtered table on it, then opens only
    the folders that can match. The rows of a value are shared by several tasks,
    dealt by a hash of themselves, so that a hot value is no single task's.
    """
    dealt = F.pmod(F.xxhash64(*df.columns), F.lit(SPREAD))
    df.repartition(by, dealt).write.mode("overwrite").partitionBy(by).parquet(path)
    return df.sparkSession.read.parquet(path)


def copy_tables(spark: SparkSession, tables: dict[str, DataFrame], root: str) -> dict[str, DataFrame]:
    """A second deployment target: every table written and read back."""
    return {name: write_back(df, f"{root}/{name}") for name, df in tables.items()}
