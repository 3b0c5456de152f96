"""Stored summaries ("data products") with provenance."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from farebox.functions.timeparts import day_bucket, hour_bucket, month_bucket, weekday_name
from farebox.operators.mergeable import Measure, merge_state, partial_state, present_state
from farebox.operators.summaries import is_wet
from farebox.sources.tables import BATCH, Table

PROVENANCE = ("data_source", "creation_time", "refresh_time", "schema_version")
DAY = "day_timestamp"
PER_DAY = {DAY: T.TimestampType()}
"""Partitions of the states a product is made of: that of each day lies by itself and is replaced when the day changes."""
PICKUP = "tpep_pickup_datetime"


@dataclass(frozen=True)
class ProductSpec:
    """A summary: its keys, its measures and what it is computed from."""

    name: str
    keys: Mapping[str, Callable[[], Column]]
    measures: tuple[Measure, ...]
    depends_on: frozenset[str]
    required: tuple[str, ...] = ()
    """Source columns that must not be NULL."""
    relabel: Mapping[str, Callable[[str], Column]] | None = None
    """Key columns that get their readable form after grouping."""

    @property
    def key_names(self) -> list[str]:
        return list(self.keys)


ZONE_STATISTICS = ProductSpec(
    name="taxi_zone_statistics",
    keys={"pu_zone": lambda: F.col("pu_zone"), "month": lambda: month_bucket(F.col(PICKUP))},
    measures=(Measure("trip_distance", "trip_distance", 0, 0), Measure("fare_amount", "fare_amount", 0, 0)),
    depends_on=frozenset({"trips", "zones"}),
)
WEATHER_SUMMARY = ProductSpec(
    name="weather_impact_summary",
    keys={"is_raining": lambda: is_wet("weather_prcp")},
    measures=(Measure("trip_distance", "trip_distance", 2, 0),),
    depends_on=frozenset({"trips", "weather"}),
    required=("trip_distance", "weather_prcp"),
)
AIR_SUMMARY = ProductSpec(
    name="air_quality_impact_summary",
    keys={"pickup_hour": lambda: hour_bucket(F.col(PICKUP))},
    measures=(
        Measure("air_q_sample_measurement", "air_quality", show_total=False),
        Measure("trip_distance", "trip_distance", 0, 0),
    ),
    depends_on=frozenset({"trips", "air_quality"}),
    required=(PICKUP, "air_q_sample_measurement"),
)
MOBILITY_SUMMARY = ProductSpec(
    name="daily_mobility_summary",
    keys={"pickup_hour": lambda: F.hour(PICKUP), "day_of_week": lambda: F.weekday(PICKUP)},
    measures=(Measure("trip_distance", "trip_distance", 0, 0),),
    depends_on=frozenset({"trips"}),
    relabel={"day_of_week": lambda c: weekday_name(F.col(c))},
)
PRODUCTS = {p.name: p for p in (ZONE_STATISTICS, WEATHER_SUMMARY, AIR_SUMMARY, MOBILITY_SUMMARY)}


def product_state(trips: DataFrame, spec: ProductSpec) -> DataFrame:
    """Mergeable state of a product over the given trips, per day. The scan reads only the named columns."""
    rows = trips.dropna(subset=list(spec.required)) if spec.required else trips
    day = F.col(DAY) if DAY in trips.columns else day_bucket(F.col(PICKUP))
    rows = rows.select(
        day.alias(DAY),
        *[expression().alias(name) for name, expression in spec.keys.items()],
        *[F.col(m.column).alias(m.column) for m in spec.measures],
    )
    state = partial_state(rows, [DAY, *spec.key_names], spec.measures)
    if spec.relabel:
        state = state.withColumns({k: label(k) for k, label in spec.relabel.items()})
    return state


def added_up(state: DataFrame, spec: ProductSpec) -> DataFrame:
    """The state of all days together."""
    return merge_state([state], spec.key_names, spec.measures)


def present(state: DataFrame, spec: ProductSpec) -> DataFrame:
    """The product as readers see it, from the states of its days."""
    return present_state(added_up(state, spec), spec.key_names, spec.measures)


def build_product(trips: DataFrame, spec: ProductSpec) -> DataFrame:
    return present(product_state(trips, spec), spec)


# -- provenance --------------------------------------------------------------


def next_provenance(before: Mapping[str, object], source: str) -> dict[str, str]:
    """Where the next state of a product comes from: creation time kept, version one higher."""
    now = datetime.now(timezone.utc).isoformat(timespec="microseconds")
    version = float(before.get("schema_version", 0.0)) + 1.0
    values = source, before.get("creation_time", now), now, f"{version:.1f}"
    return dict(zip(PROVENANCE, values))


def with_provenance(df: DataFrame, provenance: Mapping[str, str]) -> DataFrame:
    """Add where a product comes from, when it was made and refreshed, and its version."""
    times = {c: F.lit(datetime.fromisoformat(provenance[c])) for c in PROVENANCE[1:3]}
    return df.withColumns({c: times.get(c, F.lit(provenance[c])) for c in PROVENANCE})


def provenance_of(table: Table) -> tuple[datetime | None, float]:
    """Creation time and version of a stored product; ``(None, 0.0)`` when it does not exist."""
    note = table.snapshot().note
    if "schema_version" not in note:
        return None, 0.0
    return datetime.fromisoformat(note["creation_time"]), float(note["schema_version"])


# -- stored products -----------------------------------------------------------


def day_states(table: Table) -> Table:
    """The states of the days that the product in ``table`` is made of."""
    return Table(table.spark, f"{table.path}/by_day", PER_DAY)


def store_product(
    table: Table,
    state: DataFrame,
    spec: ProductSpec,
    source: str,
    days: Iterable[str] | None = None,
    covers: Mapping | None = None,
) -> None:
    """Store ``state`` as the states of all days, or of some ``days`` (``DAY=value`` folders), and the product made of them.

    ``covers`` says what the states were made from and is kept with them.
    """
    change = day_states(table).change()
    if days is None:
        change.put(state, 0)
    else:
        change.rewrite(state.withColumn(BATCH, F.lit(0)), cover={0: list(days)})
    change.note(covers=covers)
    change.publish()
    add_up_days(table, spec, source)


def add_up_days(table: Table, spec: ProductSpec, source: str) -> None:
    """Make the next state of a product from those of its days, with its provenance. Readers see the old one until then."""
    states = day_states(table)
    now = states.snapshot()
    change = table.change()
    # One row per key, whatever the number of days.
    change.put(added_up(states.read(snapshot=now), spec).coalesce(1), 0)
    change.note(**next_provenance(change.before.note, source), days=now.number)
    change.publish()


def is_added_up(table: Table) -> bool:
    """Whether the product was made from the present states of its days."""
    return table.snapshot().note.get("days") == day_states(table).snapshot().number


def read_product(table: Table, spec: ProductSpec) -> DataFrame:
    snapshot = table.snapshot()
    shown = present_state(table.read(snapshot=snapshot), spec.key_names, spec.measures)
    return with_provenance(shown, snapshot.note)


def merged_state(table: Table, new_trips: DataFrame, spec: ProductSpec) -> DataFrame:
    """Stored state plus the partials of new trips."""
    return merge_state([day_states(table).read(), product_state(new_trips, spec)], [DAY, *spec.key_names], spec.measures)
