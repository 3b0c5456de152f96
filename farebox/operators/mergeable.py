"""Aggregates that can be brought up to date from new rows alone.

The stored state of a measure is its unrounded total and its number of
non-NULL values. Both add up, so old state plus the partials of new rows equals
a rebuild over all rows; averages and rounding happen only when the state is read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from farebox.functions.measures import ratio, shown, total

DEMAND = "taxi_demand"


@dataclass(frozen=True)
class Measure:
    """One measured column and how its mean and total are shown."""

    column: str
    label: str
    avg_digits: int | None = None
    total_digits: int | None = None
    show_total: bool = True

    @property
    def total(self) -> str:
        return f"total_{self.label}"

    @property
    def average(self) -> str:
        return f"avg_{self.label}"

    @property
    def filled(self) -> str:
        return f"n_{self.label}"


def partial_state(df: DataFrame, keys: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    """State of the rows in ``df``; ``keys`` are columns of it."""
    columns = [F.count("*").alias(DEMAND)]
    for m in measures:
        columns += [total(F.col(m.column)).alias(m.total), F.count(m.column).alias(m.filled)]
    return df.groupBy(*keys).agg(*columns)


def merge_state(
    states: Sequence[DataFrame], keys: Sequence[str], measures: Sequence[Measure]
) -> DataFrame:
    """Add up states. A NULL key is a group like any other; a total stays NULL until a value arrives."""
    names = [*keys, DEMAND, *[n for m in measures for n in (m.total, m.filled)]]
    union = states[0].select(*names)
    for state in states[1:]:
        union = union.unionByName(state.select(*names))
    columns = [F.sum(DEMAND).alias(DEMAND)]
    for m in measures:
        columns += [total(F.col(m.total)).alias(m.total), F.sum(m.filled).alias(m.filled)]
    return union.groupBy(*keys).agg(*columns)


def present_state(state: DataFrame, keys: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    """Readable summary: demand, means and totals, rounded as each measure says."""
    columns = [F.col(k) for k in keys] + [F.col(DEMAND)]
    for m in measures:
        average = ratio(F.col(m.total), F.col(m.filled))
        columns.append((average if m.avg_digits is None else shown(average, m.avg_digits)).alias(m.average))
        if m.show_total:
            whole = F.col(m.total) if m.total_digits is None else shown(F.col(m.total), m.total_digits)
            columns.append(whole.alias(m.total))
    return state.select(*columns)
