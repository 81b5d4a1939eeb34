"""Change of a measure between successive dates of a series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortry.functions.scalars import days_between
from cohortry.operators.grouping import whole_units


def trajectory(
    df: DataFrame,
    series: Sequence[str],
    date: str,
    value: str,
    tie_break: Sequence[str],
    carry: Sequence[str] = (),
    scale: float = 100.0,
    digits: int = 3,
    decimals: int = 5,
) -> DataFrame:
    """Pairs of neighbouring observations on different dates of a series.

    The order within a series is the date, then ``tie_break``. A row pairs
    with the row just before it, and pairs on one date are dropped; so only
    the first row of a date and the last row of the date before can meet.
    Those two are found by an aggregate that combines on the map side, and the
    window sees one row per date: a hot series shrinks to its dates.

    A difference of zero counts as falling. A value with more than ``decimals``
    decimals is an error.
    """
    order = F.struct(*tie_break)
    row = F.struct(F.col(value).alias("v"), *carry)
    daily = df.groupBy(*series, date).agg(
        F.min_by(row, order).alias("_first"),
        F.max_by(F.col(value), order).alias("_last"),
    )
    steps = Window.partitionBy(*series).orderBy(date)
    paired = daily.withColumns(
        {"_prev": F.lag("_last").over(steps), "prev_date": F.lag(date).over(steps)}
    ).filter(F.col("prev_date").isNotNull() & F.col("_prev").isNotNull())
    grid = f"decimal(20,{decimals})"

    def exact(at: str) -> Column:
        units = whole_units(F.col(at), decimals, value)
        return (units.cast(grid) / F.lit(10**decimals)).cast(grid)

    delta = (exact("_first.v") - exact("_prev")) * F.lit(int(scale))
    return (
        paired.select(
            *series,
            date,
            *[F.col(f"_first.{c}").alias(c) for c in carry],
            F.col("_first.v").alias(value),
            F.col("_prev").alias(f"prev_{value}"),
            "prev_date",
            F.round(delta, digits).cast("double").alias(f"{value}_delta"),
            days_between(F.col("prev_date"), F.col(date)).alias("days_between"),
        )
        .filter(F.col("days_between") > 0)
        .withColumn(
            f"{value}_trend",
            F.when(F.col(f"{value}_delta") > 0, F.lit("rising")).otherwise(F.lit("falling")),
        )
    )
