"""Repeatable sampling: rows in the order of a hash of their key.

A plain ``orderBy(hash).limit(n)`` sends up to n rows of every map task to one
task. Here a histogram of the hash, over the key columns alone, finds the bucket of the
n-th row first. A second scan writes the rows up to that bucket; the few rows of the
bucket itself give the place of the n-th row, and the sample is a filter of what was
written. Splits mark rows by the places of two looks at the key columns.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortry.functions.hashing import key_hash
from cohortry.operators.ranking import null_safe_join
from cohortry.session import checkpointed

HASH, BUCKET, FINE = "_hash", "_bucket", "_fine"
HASH_BITS, BUCKET_BITS = 31, 16
NEED, NEED_BITS = "_need", 46


def _place(key: Sequence[str]) -> Column:
    return F.struct(F.col(HASH), *[F.col(k) for k in key])


def cut_points(
    hashed: DataFrame,
    key: Sequence[str],
    take: Callable[[Column], Column],
    by: Sequence[str] = (),
) -> DataFrame:
    """Per group, the place of the row that ``take(group size)`` rows reach.

    ``hashed`` carries the hash column; ``key`` must be unique in a group. Groups for
    which nothing is to be taken have no row in the result.
    """
    by = list(by)
    slim = hashed.select(*by, *[k for k in key if k not in by], HASH)
    # At most 2^16 rows per group from here to the edge, and one per group at its end.
    edge = checkpointed(_reached(_counted(slim, by, _bucket(), BUCKET), by, BUCKET, take))
    # Rows of one bucket in 2^16; the other half of the hash counts them once more.
    inside = checkpointed(null_safe_join(slim.withColumn(BUCKET, _bucket()), edge, [*by, BUCKET]))
    return _cut_inside(inside, key, by)


def _bucket() -> Column:
    return F.shiftright(HASH, HASH_BITS - BUCKET_BITS)


def _counted(rows: DataFrame, by: list[str], value: Column, name: str, *more: Column) -> DataFrame:
    return rows.groupBy(*by, value.alias(name)).agg(F.count(F.lit(1)).alias("_n"), *more)


def _cut_inside(inside: DataFrame, key: Sequence[str], by: list[str]) -> DataFrame:
    """Per group the place of the row that is number ``NEED`` in the group's edge bucket."""
    fine = F.col(HASH).bitwiseAND(F.lit(2 ** (HASH_BITS - BUCKET_BITS) - 1))
    counts = _counted(inside, by, fine, FINE, F.max(NEED).alias("_goal"))
    last = null_safe_join(inside.drop(NEED).withColumn(FINE, fine), _reached(counts, by, FINE), [*by, FINE])
    # Only rows that share the whole hash with the cut are ranked.
    rank = F.row_number().over(Window.partitionBy(*by, FINE).orderBy(_place(key)))
    return last.withColumn("_rank", rank).filter(F.col("_rank") == F.col(NEED)).select(*by, _place(key).alias("_cut"))


def _reached(
    counts: DataFrame, by: list[str], bucket: str, take: Callable[[Column], Column] | None = None
) -> DataFrame:
    """The first bucket that reaches the goal, and how many of its rows are needed.

    The goal is in ``counts``, or ``take`` of the group's size. Bucket and need are
    packed into one integer, whose smallest value needs no sort.
    """
    per_group = Window.partitionBy(*by)
    up_to = per_group.orderBy(bucket).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = counts.withColumn("_up_to", F.sum("_n").over(up_to))
    if take is not None:
        running = running.withColumn("_goal", take(F.sum("_n").over(per_group)).cast("bigint"))
    packed = F.shiftleft(F.col(bucket).cast("bigint"), NEED_BITS) + F.col("_goal") - F.col("_up_to") + F.col("_n")
    reached = running.filter((F.col("_goal") > 0) & (F.col("_up_to") >= F.col("_goal")))
    first = reached.groupBy(*by).agg(F.min(packed).alias("_edge"))
    return first.filter(F.col("_edge").isNotNull()).select(
        *by,
        F.shiftright("_edge", NEED_BITS).cast(counts.schema[bucket].dataType).alias(bucket),
        F.col("_edge").bitwiseAND(F.lit(2**NEED_BITS - 1)).alias(NEED),
    )


def with_per_label(df: DataFrame, values: DataFrame, label: str, value: str) -> DataFrame:
    """Add the value of each row's label, from a frame with one row per label, without a join.

    A join on a label with two values would send each to one task.
    """
    listed = values.agg(F.collect_list(F.struct(label, value)).alias("_all")).scalar()
    mine = F.filter("_all", lambda x: x[label].eqNullSafe(F.col(label)))
    return df.withColumn("_all", listed).withColumn(value, F.get(mine, F.lit(0))[value]).drop("_all")


def sample_rows(
    df: DataFrame, n: int, key: Sequence[str], tie_break: Sequence[str] = (), salt: int = 0
) -> DataFrame:
    """Exactly ``n`` rows (all, if there are fewer), the same ones every time.

    Rows are ordered by the hash of ``key``, then by ``key`` and ``tie_break``,
    which together must be unique.
    """
    if n <= 0:
        return df.limit(0)
    hashed = df.withColumn(HASH, key_hash(*key, salt=salt))
    order = list(dict.fromkeys([*key, *tie_break]))
    counts = _counted(hashed, [], _bucket(), BUCKET)
    edge = _reached(counts, [], BUCKET, lambda size: F.least(size, F.lit(n))).first()
    if edge is None:
        return df.limit(0)
    # The sample and the rest of its last bucket, one row in 2^16, are drawn once and written.
    drawn = checkpointed(hashed.filter(_bucket() <= edge[BUCKET]))
    inside = drawn.filter(_bucket() == edge[BUCKET]).select(*order, HASH).withColumn(NEED, F.lit(edge[NEED]))
    cut = _cut_inside(inside, order, [])
    return drawn.filter(_place(order) <= cut.scalar()).drop(HASH)


def stratified_split(
    df: DataFrame,
    label: str,
    test_share: float,
    key: Sequence[str],
    name: str = "is_test",
    tie_break: Sequence[str] = (),
    salt: int = 0,
) -> DataFrame:
    """Flag the same share of each label as test rows, exact to one row."""
    hashed = df.withColumn(HASH, key_hash(*key, salt=salt))
    order = list(dict.fromkeys([*key, *tie_break]))
    cut = cut_points(hashed, order, lambda size: F.round(size * F.lit(test_share)), [label])
    flagged = with_per_label(hashed, cut, label, "_cut")
    is_test = F.coalesce(_place(order) <= F.col("_cut"), F.lit(False))
    return flagged.withColumn(name, is_test).drop(HASH, "_cut")


def class_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Balanced weights: all rows / (number of classes x rows of the class)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    summary = counts.agg(F.struct(F.sum("_n").alias("rows"), F.count(F.lit(1)).alias("classes")))
    return counts.withColumn("_all", summary.scalar()).select(
        label,
        (F.col("_all.rows").cast("double") / (F.col("_all.classes") * F.col("_n"))).alias(name),
    )


def with_class_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    return with_per_label(df, class_weights(df, label, name), label, name)
