"""Governed metrics: dimensions and measures declared once over one fact."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.operators.joins import lookup_join


@dataclass(frozen=True)
class Dimension:
    """A grouping column, and the look-up (if any) it comes from."""

    column: str
    lookup: str | None = None


@dataclass(frozen=True)
class Lookup:
    """A dimension table joined many-to-one: the fact column and the table's key."""

    table: DataFrame
    fact_column: str
    key: str


@dataclass(frozen=True)
class MetricView:
    """Measures aggregate the fact; ratios combine finished measures.

    A query joins only the look-ups its dimensions and filter name.
    """

    fact: DataFrame
    lookups: Mapping[str, Lookup]
    dimensions: Mapping[str, Dimension]
    measures: Mapping[str, Column]
    ratios: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    labels: Mapping[str, str] = field(default_factory=dict)

    def _name(self, name: str) -> str:
        known = set(self.dimensions) | set(self.measures) | set(self.ratios)
        plain = {label: key for key, label in self.labels.items()}.get(name, name)
        if plain not in known:
            raise KeyError(f"unknown dimension or measure: {name}")
        return plain

    def query(self, dimensions: Sequence[str], measures: Sequence[str],
              where: Callable[[Callable[[str], Column]], Column] | None = None) -> DataFrame:
        """Group by `dimensions` and return `measures`, each named as it was asked for.

        `where` receives a function from dimension name to column and returns a predicate.
        """
        used: set[str] = set()

        def column(name: str) -> Column:
            dim = self.dimensions[self._name(name)]
            if dim.lookup is None:
                return F.col(dim.column)
            used.add(dim.lookup)
            return F.col(f"_{dim.lookup}_{dim.column}")

        groups = [column(d).alias(d) for d in dimensions]
        predicate = where(column) if where else None
        rows = self.fact
        for name in self.lookups:
            if name in used:
                rows = self._attach(rows, name)
        if predicate is not None:
            rows = rows.filter(predicate)

        asked = [(m, self._name(m)) for m in measures]
        needed = {part for _, m in asked for part in self.ratios.get(m, (m,))}
        totals = [self.measures[m].alias(f"_{m}") for m in self.measures if m in needed]
        grouped = rows.groupBy(*groups).agg(*totals)

        def value(m: str) -> Column:
            if m in self.ratios:
                top, bottom = self.ratios[m]
                return F.try_divide(F.col(f"_{top}"), F.col(f"_{bottom}"))
            return F.col(f"_{m}")

        return grouped.select(*[F.col(f"`{d}`") for d in dimensions], *[value(m).alias(asked_as) for asked_as, m in asked])

    def _attach(self, rows: DataFrame, name: str) -> DataFrame:
        look = self.lookups[name]
        wanted = {d.column for d in self.dimensions.values() if d.lookup == name}
        side = look.table.select(
            F.col(look.key).alias(look.fact_column), *[F.col(c).alias(f"_{name}_{c}") for c in sorted(wanted)]
        )
        return lookup_join(rows, side, look.fact_column, "left")
