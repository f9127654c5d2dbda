"""Sums per tenant that can share one aggregate.

A tally says which days and rows it looks at, what it adds up per row, and what result rows the
sums make.  ``tally`` works out one of them; ``tallies`` works out any number over one
scan and one shuffle, each sum under its own condition.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerweave.functions.jsontext import json_value
from ledgerweave.operators.measures import with_tenants, zero_if_null
from ledgerweave.periods import Period, hull

Rows = list[dict[str, Column]]


@dataclass(frozen=True)
class Tally:
    """``sums`` are values per row; those in ``zeros`` are 0 over nothing, the others null.

    ``rows`` turns a function from a sum's name to its column into the result rows.
    """
    span: Period
    sums: Mapping[str, Column]
    rows: Callable[[Callable[[str], Column]], Rows]
    where: Column | None = None
    zeros: frozenset[str] = frozenset()

    def aggregates(self, name: Callable[[str], str]) -> list[Column]:
        counts = self.span.contains("tx_date")
        if self.where is not None:
            counts = counts & self.where
        out = []
        for key, value in self.sums.items():
            total = F.sum(F.when(counts, value))
            out.append((zero_if_null(total) if key in self.zeros else total).alias(name(key)))
        return out


def _narrowed(tx: DataFrame, each: Sequence[Tally]) -> DataFrame:
    """The rows that any of the tallies looks at."""
    rows = tx.where(hull(*[t.span for t in each]).contains("tx_date"))
    if len(each) == 1 and each[0].where is not None:
        rows = rows.where(each[0].where)
    return rows


def tally(tx: DataFrame, one: Tally, by: Sequence[str], tenants: DataFrame | None = None) -> DataFrame:
    """The result row of each tenant, or one per entry of ``rows``."""
    sums = (with_tenants(_narrowed(tx, [one]), tenants, by).groupBy(*by)
            .agg(*one.aggregates(lambda key: f"_{key}")))
    made = one.rows(lambda key: F.col(f"_{key}"))
    structs = [F.struct(*[c.alias(n) for n, c in row.items()]) for row in made]
    if len(made) == 1:
        return sums.select(*by, *[c.alias(n) for n, c in made[0].items()])
    return sums.select(*by, F.explode(F.array(*structs)).alias("_r")).select(*by, "_r.*")


def tallies(tx: DataFrame, named: Mapping[str, Tally], by: Sequence[str],
            tenants: DataFrame | None = None) -> DataFrame:
    """(tenant, call, rank, row): the result rows of all tallies as JSON objects."""
    each = list(named.items())
    aggregates = [c for i, (_, t) in enumerate(each) for c in t.aggregates(lambda key: f"_{i}_{key}")]
    sums = (with_tenants(_narrowed(tx, list(named.values())), tenants, by).groupBy(*by)
            .agg(*aggregates))
    made = [(name, rank, f"_r{i}_{rank}", row) for i, (name, t) in enumerate(each)
            for rank, row in enumerate(t.rows(lambda key: F.col(f"_{i}_{key}")), 1)]
    structs = sums.select(*by, *[F.struct(*[c.alias(n) for n, c in row.items()]).alias(at)
                                 for _, _, at, row in made])
    rows = F.array(*[F.struct(F.lit(name).alias("call"), F.lit(rank).alias("rank"),
                              json_value(at, structs.schema[at].dataType).alias("row"))
                     for name, rank, at, _ in made])
    return structs.select(*by, F.explode(rows).alias("_r")).select(*by, "_r.*")
