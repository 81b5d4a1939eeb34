"""Group statistics in one pass: counts, sums, exact distinct counts, medians.

Distinct counts and medians need rows at the grain (keys, value). One
GROUPING SETS aggregate builds all these grains from a single scan, combined
on the map side, and a second small aggregate folds them to the keys. A hot
key is spread over tasks by its values, never gathered raw.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortry.functions.scalars import percent_share
from cohortry.operators.ranking import median_of_counts, small_domain


@dataclass(frozen=True)
class Measure:
    """One named statistic of a column or a Spark SQL expression.

    ``decimals`` makes sums exact, whatever their order, for data that has at
    most so many decimals: they are summed as integers of the smallest unit. A
    value with more decimals, or a sum beyond the bigint range, is an error,
    never a wrong value.
    """

    name: str
    kind: str
    value: Column | str | None = None
    decimals: int | None = None


def rows(name: str) -> Measure:
    return Measure(name, "rows")


def count_where(name: str, condition: Column | str) -> Measure:
    return Measure(name, "count_where", condition)


def total(name: str, value: Column | str, decimals: int | None = None) -> Measure:
    return Measure(name, "total", value, decimals)


def mean(name: str, value: Column | str, decimals: int | None = None) -> Measure:
    return Measure(name, "mean", value, decimals)


def largest(name: str, value: Column | str) -> Measure:
    return Measure(name, "largest", value)


def smallest(name: str, value: Column | str) -> Measure:
    return Measure(name, "smallest", value)


def any_true(name: str, value: Column | str) -> Measure:
    return Measure(name, "any_true", value)


def distinct(name: str, value: Column | str) -> Measure:
    return Measure(name, "distinct", value)


def median(name: str, value: Column | str) -> Measure:
    return Measure(name, "median", value)


def rate(name: str, condition: Column | str) -> Measure:
    """Share of rows for which the condition holds, 0 to 100, unrounded."""
    return Measure(name, "rate", condition)


def _column(value: Column | str) -> Column:
    return F.expr(value) if isinstance(value, str) else value


def _input(measure: Measure) -> Column:
    value = _column(measure.value)
    if measure.decimals is not None:
        value = whole_units(value, measure.decimals, measure.name)
    return value


def whole_units(value: Column, decimals: int, name: str) -> Column:
    """The value in units of its last decimal; one with more decimals is an error, never rounded unseen."""
    scale = F.lit(10.0**decimals)
    units = F.rint(value.cast("double") * scale)
    broken = F.raise_error(F.concat(F.lit(f"{name} has more than {decimals} decimals: "), value.cast("string")))
    return F.when(value.isNull() | (units / scale == value.cast("double")), units.cast("bigint")).otherwise(
        broken.cast("bigint")
    )


def _partials(measure: Measure, column: str) -> dict[str, Column]:
    """Aggregates that can be merged later, keyed by a suffix."""
    value = F.col(column)
    if measure.kind == "rows":
        return {"n": F.count(F.lit(1))}
    if measure.kind == "count_where":
        return {"n": F.count_if(value)}
    if measure.kind == "rate":
        return {"n": F.count_if(value), "of": F.count(F.lit(1))}
    if measure.kind == "total":
        return {"sum": F.sum(value)}
    if measure.kind == "mean":
        return {"sum": F.sum(value), "n": F.count(value)}
    if measure.kind == "smallest":
        return {"min": F.min(value)}
    if measure.kind in ("largest", "any_true"):
        return {"max": F.max(value)}
    raise ValueError(f"unknown measure kind {measure.kind!r}")


_MERGE = {"n": F.sum, "of": F.sum, "sum": F.sum, "min": F.min, "max": F.max}


def _finish(measure: Measure, parts: dict[str, Column]) -> Column:
    if measure.decimals is not None:
        parts = parts | {"sum": parts["sum"].cast("double") / F.lit(10.0**measure.decimals)}
    if measure.kind == "mean":
        return F.try_divide(parts["sum"].cast("double"), parts["n"].cast("double"))
    if measure.kind == "rate":
        return F.try_divide(parts["n"].cast("double") * 100.0, parts["of"].cast("double"))
    (only,) = parts.values()
    if measure.kind in ("rows", "count_where"):
        return F.coalesce(only, F.lit(0)).cast("bigint")
    return only


def group_stats(df: DataFrame, keys: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    """One row per key with the given measures, in the given order."""
    keys = list(keys)
    inputs = {m.name: f"_in_{i}" for i, m in enumerate(measures)}
    prepared = df.select(
        *keys, *[_input(m).alias(inputs[m.name]) for m in measures if m.value is not None]
    )
    additive = [m for m in measures if m.kind not in ("distinct", "median")]
    detailed = [m for m in measures if m.kind in ("distinct", "median")]
    partial = {
        (m.name, part): agg
        for m in additive
        for part, agg in _partials(m, inputs[m.name]).items()
    }

    if not detailed or [m.kind for m in detailed] == ["distinct"]:
        # Spark's own plan for one distinct count already goes by (keys, value).
        aggs = [
            _finish(m, {p: a for (n, p), a in partial.items() if n == m.name}).alias(m.name)
            for m in additive
        ] + [F.count_distinct(inputs[m.name]).alias(m.name) for m in detailed]
        return prepared.groupBy(*keys).agg(*aggs).select(*keys, *[m.name for m in measures])

    details = [inputs[m.name] for m in detailed]
    hidden = {key: f"_part_{i}" for i, key in enumerate(partial)}
    grains = prepared.groupingSets([[*keys, d] for d in details], *keys, *details).agg(
        F.grouping_id().alias("_set"),
        F.count(F.lit(1)).alias("_n"),
        *[agg.alias(hidden[key]) for key, agg in partial.items()],
    )
    every = 2 ** len(details) - 1
    set_of = {m.name: every - 2 ** (len(details) - 1 - i) for i, m in enumerate(detailed)}
    first = F.col("_set") == set_of[detailed[0].name]

    folded: list[Column] = []
    ranked: list[Measure] = []
    for m in measures:
        mine = F.col("_set") == set_of[m.name] if m in detailed else first
        column = inputs[m.name]
        if m.kind == "distinct":
            folded.append(F.count(F.when(mine, F.col(column))).alias(m.name))
        elif m.kind == "median" and small_domain(prepared.schema[column].dataType):
            weight = F.when(mine, F.col("_n")).otherwise(F.lit(0))
            folded.append(
                F.percentile(F.when(mine, F.col(column)), F.lit(0.5), weight).alias(m.name)
            )
        elif m.kind == "median":
            ranked.append(m)
        else:
            merged = {
                p: _MERGE[p](F.when(first, F.col(hidden[(n, p)])))
                for (n, p) in partial
                if n == m.name
            }
            folded.append(_finish(m, merged).alias(m.name))
    frames = [grains.groupBy(*keys).agg(*folded)] if folded else []
    for m in ranked:
        column = inputs[m.name]
        counts = prepared.groupBy(*keys, column).agg(F.count(F.lit(1)).alias("_n"))
        frames.append(median_of_counts(counts, keys, column, "_n", m.name))
    return stitch(frames, keys).select(*keys, *[m.name for m in measures])


# Kinds that can be aggregated by a foreign key before anything is joined.
ADDITIVE = frozenset(("rows", "count_where", "rate", "total", "mean", "smallest", "largest", "any_true"))
SET, ROWS = "_set", "_n"


def mergeable(df: DataFrame, measure: Measure) -> bool:
    """Whether aggregates of ``measure`` over parts of a group give that of the group.

    Distinct counts of whole numbers do, as bitmaps; medians of a type with few
    values do, as counts per value.
    """
    if measure.kind in ADDITIVE:
        return True
    dtype = df.select(_column(measure.value)).schema[0].dataType
    return isinstance(dtype, T.IntegralType) if measure.kind == "distinct" else small_domain(dtype)


def _details(measures: Sequence[Measure]) -> dict[int, int]:
    """The distinct counts and medians by their place, and the grouping set that each has."""
    at = [i for i, m in enumerate(measures) if m.kind not in ADDITIVE]
    return {i: 2 ** len(at) - 1 - 2 ** (len(at) - 1 - j) for j, i in enumerate(at)}


def partial_stats(df: DataFrame, keys: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    """Aggregates per key that ``merged_stats`` folds into coarser keys.

    Distinct counts and medians keep one row per key and value, next to each other
    from one scan; the other measures lie with the first of them.
    """
    prepared = df.select(*keys, *[_input(m).alias(f"_in_{i}") for i, m in enumerate(measures) if m.value is not None])
    partials = [
        a.alias(f"_p{i}_{p}") for i, m in enumerate(measures) if m.kind in ADDITIVE for p, a in _partials(m, f"_in_{i}").items()
    ]
    details = [f"_in_{i}" for i in _details(measures)]
    if not details:
        return prepared.groupBy(*keys).agg(*partials)
    return prepared.groupingSets([[*keys, d] for d in details], *keys, *details).agg(
        F.grouping_id().alias(SET), F.count(F.lit(1)).alias(ROWS), *partials
    )


def partial_names(measures: Sequence[Measure]) -> list[str]:
    names = [f"_p{i}_{p}" for i, m in enumerate(measures) if m.kind in ADDITIVE for p in _partials(m, "x")]
    details = [f"_in_{i}" for i in _details(measures)]
    return [*names, *details, SET, ROWS] if details else names


def merged_stats(df: DataFrame, keys: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    """One row per key from rows that ``partial_stats`` made.

    Values of a distinct count become bits of bitmaps, one for each key and range of
    values; the ranges of a key do not overlap, so their counts add up.
    """
    keys, set_of = list(keys), _details(measures)
    first = F.lit(True) if not set_of else F.col(SET) == min(set_of.values())
    ranges = [
        F.when(F.col(SET) == set_of[i], F.bitmap_bucket_number(f"_in_{i}").cast("bigint"))
        for i in set_of if measures[i].kind == "distinct"
    ]
    step: dict[str, Column] = {}
    for i, m in enumerate(measures):
        if m.kind in ADDITIVE:
            step |= {f"_p{i}_{p}": _MERGE[p](F.when(first, F.col(f"_p{i}_{p}"))) for p in _partials(m, "x")}
        else:
            value = F.when(F.col(SET) == set_of[i], F.col(f"_in_{i}"))
            weight = F.when(F.col(SET) == set_of[i], F.col(ROWS)).otherwise(0)
            bits = F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position(value)))
            step[f"_d{i}"] = bits if m.kind == "distinct" else F.percentile(value, F.lit(0.5), weight)
    if ranges:
        merged = df.withColumn("_range", F.coalesce(*ranges)).groupBy(*keys, SET, "_range")
        df = merged.agg(*[a.alias(n) for n, a in step.items()])
        step = {n: _MERGE[n.rpartition("_")[2]](n) for n in step if n.startswith("_p")} | {
            f"_d{i}": (F.sum if measures[i].kind == "distinct" else F.max)(f"_d{i}") for i in set_of
        }
    folded = [
        _finish(m, {p: step[f"_p{i}_{p}"] for p in _partials(m, "x")}) if m.kind in ADDITIVE else step[f"_d{i}"]
        for i, m in enumerate(measures)
    ]
    return df.groupBy(*keys).agg(*[c.alias(m.name) for c, m in zip(folded, measures, strict=True)])


def stitch(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Put frames with one row per key side by side; NULL keys match NULL keys.

    A union and one small aggregate replace a chain of outer joins. A key that
    a frame lacks gets NULL in that frame's columns.
    """
    if len(frames) == 1:
        return frames[0]
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    values = [c for c in stacked.columns if c not in keys]
    return stacked.groupBy(*keys).agg(*[F.max(c).alias(c) for c in values])


def counts_with_share(
    df: DataFrame, keys: Sequence[str], count_name: str, share_name: str, digits: int = 2
) -> DataFrame:
    """Rows per key and their percentage of all rows.

    The total is a scalar subquery over the grouped counts, whose shuffle both
    uses share: neither a one-task window nor a second scan.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name))
    whole = counts.agg(F.sum(count_name)).scalar()
    return counts.withColumn(share_name, percent_share(F.col(count_name), whole, digits))
