"""Breakdowns of the store: players dealt into groups by a key, with aggregates per group.

A ``Breakdown`` runs alone (optionally per tenant), or many of them run in
one pass over the store: each key is one of the grouping sets of a single
partially aggregated ``GROUP BY``, and ``grouping_id`` routes the groups back
to their breakdown. Aggregates that several breakdowns share are computed
once. The result is a few rows per breakdown, whatever the store's size.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Breakdown:
    name: str                                   # of the key column
    key: Column                                 # never null where ``where`` holds
    aggregates: dict[str, Column]
    where: Column | None = None                 # rows that take part
    finish: Callable[[DataFrame, tuple[str, ...]], DataFrame] = field(default=lambda groups, by: groups)

    def alone(self, store: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
        rows = store if self.where is None else store.filter(self.where)
        groups = rows.groupBy(*by, self.key.alias(self.name)).agg(*[c.alias(n) for n, c in self.aggregates.items()])
        return self.finish(groups, by)


def one_pass(store: DataFrame, breakdowns: dict[str, Breakdown],
             keep: Callable[[DataFrame], DataFrame] = DataFrame.persist) -> dict[str, DataFrame]:
    """Each breakdown's result over the groups of all of them, which ``keep`` computes once
    (a written table is recognised wherever it is used again; a cached plan may not be)."""
    names, parts = list(breakdowns), list(breakdowns.values())
    keys = [b.key if b.where is None else F.when(b.where, b.key) for b in parts]
    rows = store.select("*", *[k.alias(f"_key{i}") for i, k in enumerate(keys)])
    shared: dict[str, tuple[str, Column]] = {}
    for b in parts:
        for c in b.aggregates.values():
            shared.setdefault(str(c), (f"_agg{len(shared)}", c))
    columns = [F.col(f"_key{i}") for i in range(len(parts))]
    groups = rows.groupingSets([[c] for c in columns], *columns).agg(
        F.grouping_id().alias("_set"), *[c.alias(n) for n, c in shared.values()])
    groups = keep(groups)
    whole = (1 << len(parts)) - 1               # a bit is set where the column is not in the grouping set
    out = {}
    for i, (name, b) in enumerate(zip(names, parts)):
        own = groups.filter((F.col("_set") == whole ^ (1 << (len(parts) - 1 - i))) & F.col(f"_key{i}").isNotNull())
        out[name] = b.finish(own.select(F.col(f"_key{i}").alias(b.name), *[
            F.col(shared[str(c)][0]).alias(n) for n, c in b.aggregates.items()]), ())
    return out
