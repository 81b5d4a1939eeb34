"""Confidence score of a call, 0 to 100.

Four capped parts (fraction 35, depth 25, supporting reads 20, mapping
quality 15) and a bonus of 5 for panel genes with a therapy. A NULL among the
four measures scores 0; a NULL flag earns no bonus.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortry.functions.scalars import exact_round


@dataclass(frozen=True)
class ScoreCaps:
    """The value at which each part of the score is full."""

    vaf: float
    depth: float
    alt_reads: float
    mapq_floor: float
    mapq_span: float


# Points per part of the score.
VAF_POINTS, DEPTH_POINTS, READS_POINTS, MAPQ_POINTS, FLAG_POINTS, TOP = 35, 25, 20, 15, 5, 100.0

MEASURES = ("vaf", "read_depth", "alt_read_count", "mapping_quality")


def raw_confidence(
    caps: ScoreCaps,
    vaf: Column | str = "vaf",
    depth: Column | str = "read_depth",
    alt_reads: Column | str = "alt_read_count",
    mapq: Column | str = "mapping_quality",
    actionable: Column | str = "is_actionable",
) -> Column:
    """The unrounded score as one codegen expression."""
    v, d, a, q, flag = (
        F.col(c) if isinstance(c, str) else c for c in (vaf, depth, alt_reads, mapq, actionable)
    )
    v, d, a, q = (c.cast("double") for c in (v, d, a, q))

    def part(value: Column, cap: float, points: int) -> Column:
        return F.least(value / F.lit(cap), F.lit(1.0)) * F.lit(points)

    above = F.greatest(q - F.lit(caps.mapq_floor), F.lit(0.0))
    total = (
        part(v, caps.vaf, VAF_POINTS)
        + part(d, caps.depth, DEPTH_POINTS)
        + part(a, caps.alt_reads, READS_POINTS)
        + part(above, caps.mapq_span, MAPQ_POINTS)
        + F.when(flag, F.lit(float(FLAG_POINTS))).otherwise(F.lit(0.0))
    )
    missing = v.isNull() | d.isNull() | a.isNull() | q.isNull()
    return F.when(missing, F.lit(0.0)).otherwise(F.least(total, F.lit(TOP)))


def confidence(caps: ScoreCaps, **columns: Column | str) -> Column:
    """The score rounded to two places; use this form wherever possible."""
    return exact_round(raw_confidence(caps, **columns), 2)


def raw_confidence_batch(
    caps: ScoreCaps,
    vaf: pd.Series,
    depth: pd.Series,
    alt_reads: pd.Series,
    mapq: pd.Series,
    actionable: pd.Series,
) -> pd.Series:
    """The same sum over Arrow batches, for use behind a SQL name."""
    v, d, a, q = (s.astype("float64") for s in (vaf, depth, alt_reads, mapq))
    flag = actionable.astype("boolean").fillna(False).astype(bool)
    total = (
        np.minimum(v / caps.vaf, 1.0) * VAF_POINTS
        + np.minimum(d / caps.depth, 1.0) * DEPTH_POINTS
        + np.minimum(a / caps.alt_reads, 1.0) * READS_POINTS
        + np.minimum(np.maximum(q - caps.mapq_floor, 0.0) / caps.mapq_span, 1.0) * MAPQ_POINTS
        + flag * float(FLAG_POINTS)
    )
    known = v.notna() & d.notna() & a.notna() & q.notna()
    return pd.Series(np.minimum(total, TOP)).where(known, 0.0)


def confidence_udf(caps: ScoreCaps, digits: int | None = 2) -> Callable[..., Column]:
    """A pandas UDF; ``digits=None`` leaves rounding to the caller."""

    @F.pandas_udf(T.DoubleType())
    def score(
        vaf: pd.Series,
        depth: pd.Series,
        alt_reads: pd.Series,
        mapq: pd.Series,
        actionable: pd.Series,
    ) -> pd.Series:
        raw = raw_confidence_batch(caps, vaf, depth, alt_reads, mapq, actionable)
        if digits is None:
            return raw
        scaled = raw * 10.0**digits
        rounded = np.rint(scaled) / 10.0**digits
        # Next to a tie the product is not exact; the few values there are rounded from their own digits.
        tie = (scaled - np.floor(scaled) - 0.5).abs() < 1e-6
        rounded[tie] = [round(x, digits) for x in raw[tie]]
        return rounded

    return score


def register_confidence(
    spark: SparkSession, name: str, caps: ScoreCaps, digits: int | None = 2, replace: bool = True
) -> None:
    """Make the score callable from SQL and by ``F.call_udf`` under ``name``."""
    if not replace and spark.catalog.functionExists(name):
        raise ValueError(f"function {name!r} is already registered")
    spark.udf.register(name, confidence_udf(caps, digits))


def confidence_sql(caps: ScoreCaps) -> str:
    """The rounded score as SQL text in the names of the measures and the flag."""

    def part(value: str, cap: float, points: int) -> str:
        return f"least({value} / {float(cap)!r}D, 1.0D) * {points}"

    above = f"greatest(mapping_quality - {float(caps.mapq_floor)!r}D, 0.0D)"
    total = " + ".join(
        (
            part("vaf", caps.vaf, VAF_POINTS),
            part("read_depth", caps.depth, DEPTH_POINTS),
            part("alt_read_count", caps.alt_reads, READS_POINTS),
            part(above, caps.mapq_span, MAPQ_POINTS),
            f"if(coalesce(actionable, false), {float(FLAG_POINTS)!r}D, 0.0D)",
        )
    )
    missing = " OR ".join(f"{m} IS NULL" for m in MEASURES)
    score = f"CASE WHEN {missing} THEN 0.0D ELSE least({total}, {TOP!r}D) END"
    return f"CAST(round(CAST({score} AS DECIMAL(38, 10)), 2) AS DOUBLE)"


def register_confidence_sql(spark: SparkSession, name: str, caps: ScoreCaps, replace: bool = True) -> None:
    """The score as a function defined in SQL: the planner puts its body in place of each call.

    Callers get the same rows as from ``register_confidence`` without Python workers.
    """
    if not replace and spark.catalog.functionExists(name):
        raise ValueError(f"function {name!r} is already registered")
    create = "CREATE OR REPLACE TEMPORARY FUNCTION" if replace else "CREATE TEMPORARY FUNCTION"
    parameters = ", ".join([*(f"{m} DOUBLE" for m in MEASURES), "actionable BOOLEAN"])
    spark.sql(f"{create} {name}({parameters}) RETURNS DOUBLE RETURN {confidence_sql(caps)}")
