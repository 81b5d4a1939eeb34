"""From a request for metrics by dimensions to a DataFrame.

Grain rules:

1. Each metric is aggregated over the rows of its own table, so a draw
   without calls counts as a draw and nothing is counted once per child row.
2. A filter on a child table restricts its parents to those with such a child.
3. A filter means what it says and nothing more.
4. Every dimension must be reachable many-to-one from each metric's table.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.functions.scalars import exact_round
from cohortry.operators.grouping import Measure, group_stats, mergeable, merged_stats, partial_names, partial_stats, stitch
from cohortry.semantic.model import (
    DerivedMetric, Field, LogicalTable, Metric, ModelError, SemanticModel, field_column,
)

Filter = str | tuple[str, object]
Loader = Mapping[str, DataFrame] | Callable[[str], DataFrame]


@dataclass(frozen=True)
class Restriction:
    """One filter: a field of a table and the test on it."""

    table: str
    field: Field
    wanted: object = True

    @property
    def column(self) -> str:
        return _name(self.table, self.field.name)

    def test(self) -> Column:
        value = F.col(self.column)
        if isinstance(self.wanted, (list, tuple, set)):
            return value.isin(*self.wanted)
        return value if self.wanted is True else value == F.lit(self.wanted)



def _name(table: str, column: str) -> str:
    return f"{table}__{column}"


def _tables_of(table: str, f: Field) -> set[str]:
    """The tables that a field of ``table`` is worked out from."""
    return {t for _, t, _ in f.inputs} or {table}


Wanted = dict[str, dict[str, Column]]


def _want(wanted: Wanted, table: str, f: Field, name: str) -> None:
    """Ask for what a field needs, under its name or the names of its inputs."""
    if not f.inputs:
        wanted.setdefault(table, {})[name] = field_column(f)
    for alias, t, expr in f.inputs:
        wanted.setdefault(t, {})[f"{name}__{alias}"] = F.expr(expr)


def _worked_out(frame: DataFrame, f: Field, name: str) -> DataFrame:
    """The field under its name, once its inputs have been joined."""
    if not f.inputs:
        return frame
    return frame.withColumn(name, F.expr(f.expr.format(**{alias: f"`{name}__{alias}`" for alias, _, _ in f.inputs})))


class SemanticQuery:
    """Resolves names once and builds one plan per metric table."""

    def __init__(self, model: SemanticModel, tables: Loader):
        self.model = model
        self._tables = tables

    def base(self, table: str) -> DataFrame:
        name = self.model.table(table).base_table
        return self._tables(name) if callable(self._tables) else self._tables[name]

    # -- plan parts --------------------------------------------------------

    def attach(
        self, table: str, wanted: dict[str, dict[str, Column]], base: DataFrame | None = None
    ) -> DataFrame:
        """Rows of ``table`` with the wanted columns of itself and its parents.

        Parents are joined with their own parents first: a fact table is then
        shuffled once per direct parent and never again for a grandparent.
        Left joins on unique keys keep every row exactly once.
        """
        beyond: dict[str, dict[str, dict[str, Column]]] = {}
        edges = {r.name: r for r in self.model.parents(table)}
        for t, columns in wanted.items():
            if t != table:
                first = self.model.path(table, t)[0]
                beyond.setdefault(first.name, {})[t] = dict(columns)
        keys = {a for name in beyond for a, _ in edges[name].columns}
        own = [c.alias(n) for n, c in wanted.get(table, {}).items()]
        frame = (self.base(table) if base is None else base).select(
            *[F.col(k).alias(_name(table, f"key_{k}")) for k in sorted(keys)], *own
        )
        for name, below in beyond.items():
            r = edges[name]
            parent_keys = {_name(r.one, f"to_{b}"): F.col(b) for _, b in r.columns}
            below.setdefault(r.one, {}).update(parent_keys)
            parent = self.attach(r.one, below)
            on = [
                frame[_name(table, f"key_{a}")] == parent[_name(r.one, f"to_{b}")]
                for a, b in r.columns
            ]
            frame = frame.join(parent, reduce(lambda x, y: x & y, on), "left").drop(*parent_keys)
        return frame.drop(*[_name(table, f"key_{k}") for k in keys])

    def restricted(
        self,
        table: LogicalTable,
        dimensions: Sequence[tuple[str, Field]],
        restrictions: Sequence[Restriction],
        inputs: dict[str, Column],
    ) -> DataFrame:
        """Rows of a metric's table that pass all filters, with its dimensions."""
        model = self.model

        def reached(owner: str, f: Field) -> bool:
            return all(model.path(table.name, t) is not None for t in _tables_of(owner, f))

        near = [r for r in restrictions if reached(r.table, r.field)]
        far = [r for r in restrictions if r not in near]
        wanted: Wanted = {table.name: dict(inputs)}
        for owner, f in dimensions:
            if not reached(owner, f):
                raise ModelError(
                    f"dimension {owner}.{f.name} is not reachable from {table.name}"
                )
            _want(wanted, owner, f, _name(owner, f.name))
        for r in near:
            _want(wanted, r.table, r.field, r.column)
        if far:
            for k in table.primary_key:
                wanted[table.name][_name(table.name, f"pk_{k}")] = F.col(k)
        frame = self.attach(table.name, wanted)
        for owner, f in dimensions:
            frame = _worked_out(frame, f, _name(owner, f.name))
        for r in near:
            frame = _worked_out(frame, r.field, r.column).filter(r.test())
        if far:
            # All far filters must hold on one and the same child row.
            child = model.bridge(table.name, {t for r in far for t in _tables_of(r.table, r.field)})
            keys = [_name(table.name, f"pk_{k}") for k in table.primary_key]
            needed = self._keys_from(child, table, keys)
            rows = self.base(child)
            for r in far:
                if r.table == child and not r.field.inputs:
                    rows = rows.withColumn(r.column, field_column(r.field)).filter(r.test())
                else:
                    _want(needed, r.table, r.field, r.column)
            # Whether there is such a row is all that counts, so each of its keys goes once.
            mine = needed.pop(child, {})
            foreign = {a for t in needed for a, _ in model.path(child, t)[0].columns}
            rows = rows.select(*sorted(foreign), *[c.alias(n) for n, c in mine.items()]).distinct()
            rows = self.attach(child, {**needed, child: {n: F.col(n) for n in mine}}, rows)
            for r in far:
                if r.table != child or r.field.inputs:
                    rows = _worked_out(rows, r.field, r.column).filter(r.test())
            frame = frame.join(rows.select(*keys).distinct(), keys, "left_semi")
        return frame

    def _keys_from(
        self, child: str, table: LogicalTable, names: Sequence[str]
    ) -> dict[str, dict[str, Column]]:
        """Where a child finds the primary key of ``table``.

        The foreign key next to it will do; the table itself is joined only if
        that key does not cover the primary key.
        """
        last = self.model.path(child, table.name)[-1]
        foreign = {b: a for a, b in last.columns}
        if set(foreign) == set(table.primary_key):
            owner, source = last.many, foreign
        else:
            owner, source = table.name, {k: k for k in table.primary_key}
        return {owner: {n: F.col(source[k]) for n, k in zip(names, table.primary_key, strict=True)}}

    # -- the query ---------------------------------------------------------

    def run(
        self,
        dimensions: Sequence[str] = (),
        metrics: Sequence[str] = (),
        where: Sequence[Filter] = (),
        default_filters: bool = False,
        round_pct: int | None = None,
    ) -> DataFrame:
        model = self.model
        dims = [model.field_named(d) for d in dimensions]
        for _, f in dims:
            if f.kind == "fact":
                raise ModelError(f"{f.name!r} is a fact and cannot be a dimension")
        asked = [model.metric_named(m) for m in metrics]
        if not asked:
            raise ModelError("ask for at least one metric")
        filters: list[Filter] = [*where]
        if default_filters:
            filters += [f for f in model.default_filters if f not in filters]
        restrictions = [self._restriction(f) for f in filters]

        needed: dict[str, dict[str, Metric]] = {}
        for owner, metric in asked:
            for t, m in self._simple(owner, metric):
                needed.setdefault(t, {})[m.name] = m
        keys = [_name(t, f.name) for t, f in dims]
        frames = [
            self._aggregate(model.table(t), list(ms.values()), dims, keys, restrictions)
            for t, ms in needed.items()
        ]
        stitched = stitch(frames, keys)
        return stitched.select(
            *[F.col(k).alias(n) for k, n in zip(keys, self._dimension_names(dims), strict=True)],
            *[self._result(owner, m, round_pct).alias(m.name) for owner, m in asked],
        )

    def verified(self, name: str, round_pct: int | None = None) -> DataFrame:
        """Run a query that the model carries, with its order and limit."""
        spec = self.model.verified[name]
        result = self.run(
            spec.get("dimensions", ()), spec["metrics"], spec.get("where", ()), round_pct=round_pct
        )
        names = [m.rpartition(".")[2] for m in spec.get("order_by", ())]
        dims = [c for c in result.columns if c not in {m.rpartition(".")[2] for m in spec["metrics"]}]
        result = result.orderBy(*[F.desc_nulls_last(n) for n in names], *dims)
        return result.limit(spec["limit"]) if "limit" in spec else result

    def _restriction(self, item: Filter) -> Restriction:
        if isinstance(item, str):
            table, f = self.model.field_named(item)
            if not f.is_filter:
                raise ModelError(f"{item!r} is not a filter")
            return Restriction(table, f)
        name, wanted = item
        table, f = self.model.field_named(name)
        return Restriction(table, f, wanted)

    def _simple(self, owner: str | None, metric: Metric | DerivedMetric):
        if isinstance(metric, Metric):
            return [(owner, metric)]
        parts = [self.model.metric_named(metric.numerator), self.model.metric_named(metric.denominator)]
        if any(isinstance(m, DerivedMetric) for _, m in parts):
            raise ModelError(f"{metric.name!r} builds on another derived metric")
        return parts

    def _aggregate(
        self,
        table: LogicalTable,
        metrics: list[Metric],
        dims: Sequence[tuple[str, Field]],
        keys: list[str],
        restrictions: Sequence[Restriction],
    ) -> DataFrame:
        kinds = [m for m in metrics if m.kind is not None]
        free = [m for m in metrics if m.kind is None]
        inputs = {
            _name(table.name, f"in_{m.name}"): F.expr(m.value) for m in kinds if m.value is not None
        }
        frames = []
        if kinds:
            measures = [
                m.measure(None if m.value is None else F.col(_name(table.name, f"in_{m.name}")))
                for m in kinds
            ]
            stats = self._merged(table, measures, dims, keys, restrictions, inputs)
            if stats is None:
                rows = self.restricted(table, dims, restrictions, inputs)
                stats = group_stats(rows, keys, measures)
            scaled = [
                (F.col(m.name) * m.scale if m.scale else F.col(m.name)).alias(
                    _name(table.name, m.name)
                )
                for m in kinds
            ]
            frames.append(stats.select(*keys, *scaled))
        if free:
            # Free expressions see the base columns, so all of them come along
            # and Catalyst drops the unused ones.
            columns = {c: F.col(c) for c in self.base(table.name).columns}
            rows = self.restricted(table, dims, restrictions, columns)
            aggs = [F.expr(m.expr).alias(_name(table.name, m.name)) for m in free]
            frames.append(rows.groupBy(*keys).agg(*aggs))
        return stitch(frames, keys)

    def _merged(
        self,
        table: LogicalTable,
        measures: Sequence[Measure],
        dims: Sequence[tuple[str, Field]],
        keys: list[str],
        restrictions: Sequence[Restriction],
        inputs: dict[str, Column],
    ) -> DataFrame | None:
        """The metrics of a table, aggregated by its foreign keys before its parents are joined.

        None where that does not apply: for distinct counts of other values than whole
        numbers and medians of types with many values, for filters on child tables,
        and where no parent is needed.
        """
        early = [r for r in restrictions if r.table == table.name and not r.field.inputs]
        late = [r for r in restrictions if r not in early]
        fields = [(t, f) for t, f in dims] + [(r.table, r.field) for r in late]
        away = {x for t, f in fields for x in _tables_of(t, f)} - {table.name}
        paths = {t: self.model.path(table.name, t) for t in away}
        if not away or any(p is None for p in paths.values()):
            return None
        foreign = sorted({a for p in paths.values() for a, _ in p[0].columns})
        wanted: Wanted = {}
        for t, f in dims:
            _want(wanted, t, f, _name(t, f.name))
        for r in late:
            _want(wanted, r.table, r.field, r.column)
        own = wanted.pop(table.name, {})
        rows = self.base(table.name)
        for r in early:
            rows = rows.withColumn(r.column, field_column(r.field)).filter(r.test())
        rows = rows.select(
            *foreign, *[c.alias(n) for n, c in own.items()], *[c.alias(n) for n, c in inputs.items()]
        )
        if not all(mergeable(rows, m) for m in measures):
            return None
        counted = partial_stats(rows, [*foreign, *own], measures)
        wanted[table.name] = {n: F.col(n) for n in (*own, *partial_names(measures))}
        frame = self.attach(table.name, wanted, counted)
        for t, f in dims:
            frame = _worked_out(frame, f, _name(t, f.name))
        for r in late:
            frame = _worked_out(frame, r.field, r.column).filter(r.test())
        return merged_stats(frame, keys, measures)

    def _result(self, owner: str | None, metric: Metric | DerivedMetric, round_pct: int | None) -> Column:
        if isinstance(metric, DerivedMetric):
            top, bottom = (
                self._result(t, m, None).cast("double") for t, m in self._simple(owner, metric)
            )
            return F.try_divide(top, bottom)
        value = F.col(_name(owner, metric.name))
        if metric.kind in ("rows", "count_where", "distinct"):
            # A group that the metric's table never reaches holds zero rows.
            value = F.coalesce(value, F.lit(0))
        if round_pct is not None and metric.percent:
            return exact_round(value, round_pct)
        return value

    @staticmethod
    def _dimension_names(dims: Sequence[tuple[str, Field]]) -> list[str]:
        names = [f.name for _, f in dims]
        return [
            n if names.count(n) == 1 else _name(t, n) for n, (t, _) in zip(names, dims, strict=True)
        ]

    # -- checks and description --------------------------------------------

    def verify(self) -> list[str]:
        """Problems of the model against the tables' schemas; reads no rows."""
        problems = []

        def attempt(what: str, build: Callable[[], object]) -> None:
            try:
                build()
            except Exception as error:  # analysis errors carry the useful text
                problems.append(f"{what}: {str(error).splitlines()[0]}")

        for t in self.model.tables:
            attempt(f"table {t.name}", lambda t=t: self.base(t.name).select(*t.primary_key).schema)
            for f in t.fields:
                parts = [(x, F.expr(e)) for _, x, e in f.inputs] or [(t.name, field_column(f))]
                for x, column in parts:
                    attempt(f"field {t.name}.{f.name}", lambda x=x, column=column: self.base(x).select(column).schema)
            for m in t.metrics:
                attempt(
                    f"metric {t.name}.{m.name}",
                    lambda t=t, m=m: self._aggregate(t, [m], [], [], []).schema,
                )
        for r in self.model.relationships:
            for table, columns in ((r.many, [a for a, _ in r.columns]), (r.one, [b for _, b in r.columns])):
                attempt(
                    f"relationship {r.name}",
                    lambda table=table, columns=columns: self.base(table).select(*columns).schema,
                )
        for d in self.model.derived:
            attempt(f"metric {d.name}", lambda d=d: self._simple(None, d))
        for name in self.model.default_filters:
            attempt(f"default filter {name}", lambda name=name: self._restriction(name))
        return problems

    def key_check(self, table: str) -> DataFrame:
        """Rows of a table, keys that repeat and keys that are NULL."""
        t = self.model.table(table)
        keyed = self.base(table).groupBy(*t.primary_key).agg(F.count(F.lit(1)).alias("n"))
        has_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in t.primary_key])
        return keyed.agg(
            F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_rows"),
            F.count_if(F.col("n") > 1).alias("repeated_keys"),
            F.count_if(has_null).alias("null_keys"),
        ).select(F.lit(table).alias("table_name"), "n_rows", "repeated_keys", "null_keys")

    def filled(self) -> DataFrame:
        """How many rows of its table each field fills that is worked out from it alone; one pass per table."""
        frames = []
        for t in self.model.tables:
            fields = [f for f in t.fields if not f.inputs]
            if not fields:
                continue
            names = [f.name for f in fields]
            counts = self.base(t.name).agg(*[F.count(field_column(f)).alias(f.name) for f in fields])
            pairs = F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("filled")) for n in names])
            frames.append(counts.select(F.lit(t.name).alias("table_name"), F.inline(pairs)))
        return reduce(DataFrame.unionByName, frames)

    def describe(self, spark: SparkSession) -> DataFrame:
        """The model as rows: one per field, metric and relationship."""
        rows = []
        for t in self.model.tables:
            for f in t.fields:
                rows.append((t.name, f.kind, f.name, f.expr, f.data_type, not f.private))
            for m in t.metrics:
                text = m.expr or f"{m.kind}({m.value or '*'})"
                rows.append((t.name, "metric", m.name, text, None, not m.private))
        for r in self.model.relationships:
            pairs = " and ".join(f"{r.many}.{a} = {r.one}.{b}" for a, b in r.columns)
            rows.append((r.many, "relationship", r.name, pairs, None, True))
        for d in self.model.derived:
            rows.append((None, "derived", d.name, f"{d.numerator} / {d.denominator}", None, True))
        return spark.createDataFrame(
            rows, "table_name string, kind string, name string, expr string, data_type string, public boolean"
        )
