"""Running totals, numbering, exact medians and top rows per group.

A window without a partition key, or over one hot key, runs in one task. The
functions here first cut the sorted rows into ranges, so that a key of any
size is shared by many tasks, and carry the sum of earlier ranges along.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from cohortry.session import checkpointed

CHUNK, CHUNK_SUM, CHUNK_BEFORE = "_chunk", "_chunk_sum", "_chunk_before"
PLACE, FIRST = "_place", "_first"
RANGE_BYTES = 256 * 2**20

# A median may be buffered as value -> count inside one aggregate only if its
# type admits no more distinct values than this.
MAX_BUFFERED_VALUES = 2_000_000


def null_safe_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Equi-join on ``keys`` in which NULL equals NULL; the keys come from the left.

    The right keys are renamed first, as the two sides often share an origin.
    """
    other = {k: f"_right_{k}" for k in keys}
    match = reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(other[k])) for k in keys]
    )
    return left.join(right.withColumnsRenamed(other), match, how).drop(*other.values())


def ranges_for(df: DataFrame) -> int:
    """How many ranges a sort of ``df`` needs: by the size of what its plan scans.

    AQE never splits an explicit number of ranges, so that number has to follow
    the data and not the session's default.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Leaves of unknown size report the largest number there is.
    return max(least, -(-sum(s for s in sizes if s < 2**62) // RANGE_BYTES))


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    weight: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Add ``running`` (sum of ``weight`` up to and with the row) and ``total``.

    Within ``keys`` the columns ``order`` must be unique. Without a weight
    rows are counted: their place in their sorted range is written along with
    them, so that the rows are shuffled once. The range boundaries come from a
    sample and would differ if they were drawn twice, so the cut rows are
    written once and read back.
    """
    count = partitions or ranges_for(df)
    ranged = df.repartitionByRange(count, *keys, *order).sortWithinPartitions(*keys, *order)
    # The lower 33 bits of this id count the rows of a partition from 0.
    place = F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1))
    cut = checkpointed(ranged.withColumn(CHUNK, F.spark_partition_id()).withColumn(PLACE, place))
    amount = F.col(weight) if weight else F.lit(1).cast("bigint")
    # One row per range and key; a key meets at most ``count`` ranges.
    sums = cut.groupBy(CHUNK, *keys).agg(F.sum(amount).alias(CHUNK_SUM), F.min(PLACE).alias(FIRST))
    per_key = Window.partitionBy(*keys)
    earlier = per_key.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        F.col(CHUNK).alias("_at"),
        *[F.col(k).alias(f"_of_{k}") for k in keys],
        FIRST,
        F.coalesce(F.sum(CHUNK_SUM).over(earlier), F.lit(0)).alias(CHUNK_BEFORE),
        F.sum(CHUNK_SUM).over(per_key).alias("total"),
    )
    if weight:
        inside = (
            Window.partitionBy(CHUNK, *keys)
            .orderBy(*order)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        cut = cut.withColumn("_inside", F.sum(amount).over(inside))
        running = F.col("_inside") + F.col(CHUNK_BEFORE)
    else:
        running = F.col(PLACE) - F.col(FIRST) + 1 + F.col(CHUNK_BEFORE)
    # The range is never NULL and joins by plain equality, which keeps its partitioning.
    match = [F.col(CHUNK) == F.col("_at"), *[F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]]
    joined = cut.join(offsets, reduce(lambda x, y: x & y, match))
    return joined.select(*df.columns, running.alias("running"), "total")


def number_rows(
    df: DataFrame, order: Sequence[str], name: str = "rn", partitions: int | None = None
) -> DataFrame:
    """Number all rows 1..n in a total order, without a one-task window."""
    numbered = running_total(df, [], order, partitions=partitions)
    return numbered.withColumnRenamed("running", name).drop("total")


def first_numbered(df: DataFrame, order: Sequence[str], n: int, name: str = "rn") -> DataFrame:
    """The first ``n`` rows in a total order, numbered; ``n`` bounds the window."""
    head = df.orderBy(*order).limit(n)
    return head.withColumn(name, F.row_number().over(Window.orderBy(*order)).cast("bigint"))


def top_per_group(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int = 1, name: str = "rank"
) -> DataFrame:
    """The first ``k`` rows of each group; ``order`` must end in a unique key.

    Each map task keeps its own best ``k`` rows per group before the shuffle,
    which also tames hot groups.
    """
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn(name, rank.cast("bigint")).filter(F.col(name) <= k)


def buffered_values(dtype: T.DataType) -> int | None:
    """How many distinct values a type admits, or None if practically unlimited."""
    if isinstance(dtype, T.BooleanType):
        return 2
    if isinstance(dtype, T.ByteType):
        return 2**8
    if isinstance(dtype, T.ShortType):
        return 2**16
    if isinstance(dtype, T.DecimalType):
        return 2 * 10**dtype.precision
    return None


def small_domain(dtype: T.DataType) -> bool:
    size = buffered_values(dtype)
    return size is not None and size <= MAX_BUFFERED_VALUES


def median_of_counts(
    counts: DataFrame, keys: Sequence[str], value: str, n: str, name: str = "median"
) -> DataFrame:
    """Exact median per key from rows (keys, value, n) that are unique.

    A type with few possible values is buffered in one aggregate. Any other
    value is ranked across tasks, however many values a key has.
    """
    counts = counts.filter(F.col(value).isNotNull())
    if small_domain(counts.schema[value].dataType):
        return counts.groupBy(*keys).agg(F.percentile(F.col(value), F.lit(0.5), F.col(n)).alias(name))
    ranked = running_total(counts, keys, [value], n)

    def at(rank: Column) -> Column:
        holds = (F.col("running") >= rank) & (F.col("running") - F.col(n) < rank)
        return F.max(F.when(holds, F.col(value).cast("double")))

    low = F.expr("(total + 1) div 2")
    high = F.expr("total div 2 + 1")
    return ranked.groupBy(*keys).agg(((at(low) + at(high)) / 2).alias(name))


def exact_median(df: DataFrame, keys: Sequence[str], value: str, name: str = "median") -> DataFrame:
    """Exact median per key; equal values are counted before anything is ranked."""
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    return median_of_counts(counts, keys, value, "_n", name)


RANGE_BUCKETS = 4096


def median_by_ranges(
    df: DataFrame, keys: Sequence[str], value: str, name: str = "median", buckets: int = RANGE_BUCKETS
) -> DataFrame:
    """Exact median per key of any numeric value by narrowing ranges; rows are never moved or sorted.

    A first aggregate gives the number, the smallest and the largest value of each
    key. Every pass then counts the rows of a key's range in equal buckets, combined
    where the rows lie, and goes on with the smallest and largest value of the bucket
    that holds the middle. The ends of a range fall into different buckets, so a range
    shrinks with each pass, by about ``buckets`` times; it ends at one value. What
    travels is one row per key, range and bucket.

    NULL and NaN are no values; a key without any has no row.
    """
    keys = list(keys) or ["_all"]
    rows = df.withColumn("_all", F.lit(0)).select(*keys, F.col(value).cast("double").alias("_v"))
    rows = rows.filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    middle = F.array(F.expr("(_n + 1) div 2"), F.expr("_n div 2 + 1"))
    found = checkpointed(sizes.select(*keys, F.explode(middle).alias("_need"), "_lo", "_hi"))
    is_open = F.col("_lo") < F.col("_hi")
    while not found.filter(is_open).isEmpty():
        ranges = found.filter(is_open).select(*keys, "_lo", "_hi").distinct()
        inside = null_safe_join(rows, ranges, keys).filter(F.col("_v").between(F.col("_lo"), F.col("_hi")))
        # Halves, as the width of a range may be beyond the largest double.
        width = F.col("_hi") / 2 - F.col("_lo") / 2
        share = F.try_divide(F.col("_v") / 2 - F.col("_lo") / 2, width)
        bucket = F.least(F.floor(F.coalesce(share, F.lit(0.0)) * (buckets - 1)), F.lit(buckets - 2).cast("bigint"))
        bucket = F.when(F.col("_v") == F.col("_hi"), buckets - 1).otherwise(bucket)
        range_of = [*keys, "_lo", "_hi"]
        counts = inside.groupBy(*range_of, bucket.alias("_bucket")).agg(
            F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high")
        )
        # At most ``buckets`` rows per range.
        up_to = Window.partitionBy(*range_of).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
        counts = counts.withColumn("_up_to", F.sum("_n").over(up_to))
        hit = null_safe_join(found.filter(is_open), counts, range_of)
        before = F.col("_up_to") - F.col("_n")
        hit = hit.filter((F.col("_need") > before) & (F.col("_need") <= F.col("_up_to")))
        narrowed = hit.select(*keys, (F.col("_need") - before).alias("_need"), F.col("_low").alias("_lo"), F.col("_high").alias("_hi"))
        found = checkpointed(narrowed.unionByName(found.filter(~is_open)))
    medians = found.groupBy(*keys).agg((F.sum("_lo") / 2).alias(name))
    return medians.drop("_all")
