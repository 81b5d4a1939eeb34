"""The parts of a semantic model and how names resolve in it."""

from __future__ import annotations

from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortry.operators import grouping as g

MEASURE_KINDS = (
    "rows", "count_where", "rate", "total", "mean", "largest", "smallest", "any_true",
    "distinct", "median",
)


class ModelError(ValueError):
    """A model or a request that cannot be answered unambiguously."""


@dataclass(frozen=True)
class Field:
    """A dimension or a fact: a named row-level Spark SQL expression.

    With ``inputs``, (name, table, expression) each, ``expr`` is a template over these
    names in braces, and is worked out where the tables have been joined.
    """

    name: str
    expr: str
    data_type: str = "string"
    kind: str = "dimension"
    synonyms: tuple[str, ...] = ()
    is_filter: bool = False
    is_enum: bool = False
    private: bool = False
    description: str = ""
    inputs: tuple[tuple[str, str, str], ...] = ()


@dataclass(frozen=True)
class Metric:
    """An aggregate over one logical table.

    Either ``kind`` and ``value`` (a row-level expression), which is the form
    that scales for distinct counts and medians, or ``expr``, any Spark SQL
    aggregate expression. ``scale`` multiplies the result; ``percent`` marks a
    percentage, which a request may ask to round.
    """

    name: str
    kind: str | None = None
    value: str | None = None
    expr: str | None = None
    decimals: int | None = None
    scale: int | None = None
    percent: bool = False
    synonyms: tuple[str, ...] = ()
    private: bool = False
    description: str = ""

    def measure(self, value: Column | None) -> g.Measure:
        return g.Measure(self.name, self.kind, value, self.decimals)


@dataclass(frozen=True)
class DerivedMetric:
    """A ratio of two metrics that may live on different tables."""

    name: str
    numerator: str
    denominator: str
    synonyms: tuple[str, ...] = ()
    description: str = ""


@dataclass(frozen=True)
class LogicalTable:
    name: str
    base_table: str
    primary_key: tuple[str, ...]
    fields: tuple[Field, ...] = ()
    metrics: tuple[Metric, ...] = ()
    synonyms: tuple[str, ...] = ()
    description: str = ""


@dataclass(frozen=True)
class Relationship:
    """Many rows of ``many`` point to one row of ``one``."""

    name: str
    many: str
    one: str
    columns: tuple[tuple[str, str], ...]


@dataclass(frozen=True)
class SemanticModel:
    name: str
    tables: tuple[LogicalTable, ...]
    relationships: tuple[Relationship, ...] = ()
    derived: tuple[DerivedMetric, ...] = ()
    default_filters: tuple[str, ...] = ()
    verified: dict[str, dict[str, Any]] = field(default_factory=dict)

    def table(self, name: str) -> LogicalTable:
        for t in self.tables:
            if t.name == name:
                return t
        raise ModelError(f"unknown table {name!r}")

    # -- names ------------------------------------------------------------

    def field_named(self, name: str) -> tuple[str, Field]:
        """(table, field) for a qualified name, a unique bare name or a synonym."""
        pool = [(t.name, f) for t in self.tables for f in t.fields]
        return self._resolve(name, pool, "dimension")

    def metric_named(self, name: str) -> tuple[str | None, Metric | DerivedMetric]:
        """(table, metric); the table of a derived metric is None."""
        pool: list[tuple[str | None, Any]] = [(t.name, m) for t in self.tables for m in t.metrics]
        pool += [(None, m) for m in self.derived]
        return self._resolve(name, pool, "metric")

    def _resolve(self, name: str, pool: list, what: str):
        exact = [(t, x) for t, x in pool if f"{t}.{x.name}" == name]
        bare = [(t, x) for t, x in pool if x.name == name]
        table, _, short = name.rpartition(".")
        lowered = short.lower()
        alike = [
            (t, x) for t, x in pool
            if lowered in (s.lower() for s in x.synonyms) and table in ("", t)
        ]
        for found in (exact, bare, alike):
            if len(found) > 1:
                options = ", ".join(f"{t}.{x.name}" for t, x in found)
                raise ModelError(f"{what} {name!r} is ambiguous: {options}")
            if found:
                (owner, item), = found
                if getattr(item, "private", False):
                    raise ModelError(f"{what} {name!r} is private")
                return owner, item
        raise ModelError(f"unknown {what} {name!r}")

    def synonyms(self) -> dict[str, list[str]]:
        """Every synonym with the qualified names it may mean."""
        meaning: dict[str, list[str]] = {}
        for t in self.tables:
            for x in (*t.fields, *t.metrics):
                for s in x.synonyms:
                    meaning.setdefault(s.lower(), []).append(f"{t.name}.{x.name}")
        for d in self.derived:
            for s in d.synonyms:
                meaning.setdefault(s.lower(), []).append(d.name)
        return meaning

    # -- relationships ----------------------------------------------------

    def parents(self, table: str) -> list[Relationship]:
        return [r for r in self.relationships if r.many == table]

    def path(self, start: str, goal: str) -> list[Relationship] | None:
        """The shortest many-to-one path, None if there is none."""
        level: list[tuple[str, list[Relationship]]] = [(start, [])]
        seen = {start}
        while level:
            arrived = [steps for at, steps in level if at == goal]
            if len(arrived) > 1:
                raise ModelError(f"several paths lead from {start} to {goal}")
            if arrived:
                return arrived[0]
            level = [
                (r.one, [*steps, r])
                for at, steps in level
                for r in self.parents(at)
                if r.one not in seen
            ]
            seen.update(at for at, _ in level)
        return None

    def bridge(self, table: str, filtered: set[str]) -> str:
        """The child table that reaches ``table`` and every filtered table."""
        lengths: dict[str, int] = {}
        for t in self.tables:
            paths = [self.path(t.name, x) for x in (table, *sorted(filtered))]
            if all(p is not None for p in paths):
                lengths[t.name] = sum(len(p) for p in paths)
        if not lengths:
            raise ModelError(f"no table relates {table} to {', '.join(sorted(filtered))}")
        best = min(lengths.values())
        nearest = [t for t, n in lengths.items() if n == best]
        if len(nearest) > 1:
            raise ModelError(f"several tables relate {table} to the filters: {nearest}")
        return nearest[0]


# -- loading ---------------------------------------------------------------


def _texts(spec: dict[str, Any], key: str) -> tuple[str, ...]:
    return tuple(spec.get(key) or ())


def _is_private(spec: dict[str, Any]) -> bool:
    return spec.get("access_modifier") == "private_access"


def _field(spec: dict[str, Any], kind: str) -> Field:
    return Field(
        name=spec["name"],
        expr=spec.get("expr", spec["name"]),
        data_type=spec.get("data_type", "string").lower(),
        kind=kind,
        synonyms=_texts(spec, "synonyms"),
        is_filter="filter" in (spec.get("labels") or ()),
        is_enum=bool(spec.get("is_enum", False)),
        private=_is_private(spec),
        description=spec.get("description", ""),
        inputs=tuple((n, *source.split(".", 1)) for n, source in (spec.get("inputs") or {}).items()),
    )


def _metric(spec: dict[str, Any]) -> Metric:
    kind = spec.get("kind")
    if kind is not None and kind not in MEASURE_KINDS:
        raise ModelError(f"metric {spec['name']!r} has unknown kind {kind!r}")
    if (kind is None) == ("expr" not in spec):
        raise ModelError(f"metric {spec['name']!r} needs either a kind or an expr")
    return Metric(
        name=spec["name"],
        kind=kind,
        value=spec.get("value"),
        expr=spec.get("expr"),
        decimals=spec.get("decimals"),
        scale=spec.get("scale"),
        percent=bool(spec.get("percent", False)),
        synonyms=_texts(spec, "synonyms"),
        private=_is_private(spec),
        description=spec.get("description", ""),
    )


def _base(spec: dict[str, Any]) -> str:
    base = spec["base_table"]
    return base if isinstance(base, str) else base["table"]


def from_dict(spec: dict[str, Any]) -> SemanticModel:
    """Build a model from a parsed specification."""
    tables = []
    for t in spec["tables"]:
        groups = (("dimensions", "dimension"), ("time_dimensions", "time"), ("facts", "fact"))
        fields = [_field(f, kind) for key, kind in groups for f in t.get(key) or ()]
        tables.append(
            LogicalTable(
                name=t["name"],
                base_table=_base(t),
                primary_key=tuple(t["primary_key"]["columns"]),
                fields=tuple(fields),
                metrics=tuple(_metric(m) for m in t.get("metrics") or ()),
                synonyms=_texts(t, "synonyms"),
                description=t.get("description", ""),
            )
        )
    edges = [
        Relationship(
            name=r["name"],
            many=r["left_table"],
            one=r["right_table"],
            columns=tuple(
                (c["left_column"], c["right_column"]) for c in r["relationship_columns"]
            ),
        )
        for r in spec.get("relationships") or ()
    ]
    derived = []
    for m in spec.get("metrics") or ():
        if "expr" in m:
            # The only form a model-level expression may take is "a / b".
            parts = [p.strip() for p in m["expr"].split("/")]
            if len(parts) != 2:
                raise ModelError(f"derived metric {m['name']!r} must be one ratio")
            numerator, denominator = parts
        else:
            numerator, denominator = m["numerator"], m["denominator"]
        derived.append(
            DerivedMetric(
                m["name"], numerator, denominator, _texts(m, "synonyms"), m.get("description", "")
            )
        )
    return SemanticModel(
        name=spec["name"],
        tables=tuple(tables),
        relationships=tuple(edges),
        derived=tuple(derived),
        default_filters=_texts(spec, "default_filters"),
        verified={q["name"]: q for q in spec.get("verified_queries") or ()},
    )


def _named(item: Any, **parts: Any) -> dict[str, Any]:
    """The specification of a part, without what is empty or a default."""
    spec = {"name": item.name, **parts}
    if item.synonyms:
        spec["synonyms"] = list(item.synonyms)
    if getattr(item, "private", False):
        spec["access_modifier"] = "private_access"
    if item.description:
        spec["description"] = item.description
    return {k: v for k, v in spec.items() if v not in (None, False)}


def _field_spec(f: Field) -> dict[str, Any]:
    labels = ["filter"] if f.is_filter else None
    inputs = {n: f"{t}.{e}" for n, t, e in f.inputs} or None
    return _named(f, expr=f.expr, data_type=f.data_type, labels=labels, is_enum=f.is_enum, inputs=inputs)


def to_dict(model: SemanticModel) -> dict[str, Any]:
    """The specification that ``from_dict`` turns into an equal model."""
    tables = []
    for t in model.tables:
        spec = _named(t, base_table=t.base_table, primary_key={"columns": list(t.primary_key)})
        for key, kind in (("dimensions", "dimension"), ("time_dimensions", "time"), ("facts", "fact")):
            spec[key] = [_field_spec(f) for f in t.fields if f.kind == kind]
        spec["metrics"] = [
            _named(m, kind=m.kind, value=m.value, expr=m.expr, decimals=m.decimals, scale=m.scale, percent=m.percent)
            for m in t.metrics
        ]
        tables.append(spec)
    return {
        "name": model.name,
        "default_filters": list(model.default_filters),
        "tables": tables,
        "relationships": [
            {
                "name": r.name, "left_table": r.many, "right_table": r.one,
                "relationship_columns": [{"left_column": a, "right_column": b} for a, b in r.columns],
            }
            for r in model.relationships
        ],
        "metrics": [_named(d, numerator=d.numerator, denominator=d.denominator) for d in model.derived],
        "verified_queries": list(model.verified.values()),
    }


def to_yaml(model: SemanticModel) -> str:
    import yaml

    return yaml.safe_dump(to_dict(model), sort_keys=False, allow_unicode=True)


def from_yaml(path: str | Path) -> SemanticModel:
    import yaml

    return from_dict(yaml.safe_load(Path(path).read_text()))


def cohort_model() -> SemanticModel:
    """The model that ships with the package."""
    return from_yaml(Path(__file__).with_name("cohort.yaml"))


def field_column(f: Field) -> Column:
    return F.expr(f.expr)
