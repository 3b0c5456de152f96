"""Bringing the integrated table and the products up to date."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from farebox.operators.conform import prefix_columns
from farebox.operators.merge import fill_unmatched
from farebox.operators.quality import one_row_per_key
from farebox.plans import integrate as wide
from farebox.plans.products import (
    DAY,
    PRODUCTS,
    ProductSpec,
    add_up_days,
    day_states,
    is_added_up,
    product_state,
    store_product,
)
from farebox.sources.scratch import staged
from farebox.sources.tables import BATCH, Snapshot, Table, in_parts

STATE_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("version", T.IntegerType()),
        T.StructField("columns", T.MapType(T.StringType(), T.StringType())),
    ]
)
DAY_LAYOUT = {DAY: T.TimestampType()}
# Below a borough the days lie by themselves too, so that a change of some days leaves the others alone.
BOROUGH_LAYOUT = {"pu_borough": T.StringType(), DAY: T.TimestampType()}


@dataclass(frozen=True)
class Catalog:
    """The tables of one installation, all below ``root``."""

    spark: SparkSession
    root: str
    measures: tuple[str, ...] | None = None
    """Air-quality columns of the integrated table; all of them by default."""
    two_layouts: bool = True
    """Whether the integrated table is kept by borough as well."""
    raw: tuple[str, ...] = ("trips", "weather", "zones", "air_quality")
    products: Mapping[str, ProductSpec] = field(default_factory=lambda: PRODUCTS)

    def table(self, name: str) -> Table:
        return Table(self.spark, f"{self.root}/{name}")

    @property
    def integrated(self) -> Table:
        return Table(self.spark, f"{self.root}/integrated_by_date", DAY_LAYOUT)

    @property
    def by_borough(self) -> Table:
        return Table(self.spark, f"{self.root}/integrated_by_borough", BOROUGH_LAYOUT)

    @property
    def state(self) -> Table:
        return self.table("state")

    def product(self, name: str) -> Table:
        return self.table(f"products/{name}")


# -- change detection ----------------------------------------------------------


def current_state(catalog: Catalog) -> DataFrame:
    """Version and columns of every raw table that exists; one row per table."""
    prints = [(name, catalog.table(name).fingerprint()) for name in catalog.raw]
    rows = [(name, p.version, dict(p.columns)) for name, p in prints if p is not None]
    return catalog.spark.createDataFrame(rows, STATE_SCHEMA)


def load_state(catalog: Catalog) -> DataFrame:
    if catalog.state.version() is None:
        return catalog.spark.createDataFrame([], STATE_SCHEMA)
    return catalog.state.read()


def save_state(catalog: Catalog, state: DataFrame) -> None:
    catalog.state.write_batch(state.coalesce(1), 0)


def detect_changes(before: DataFrame, now: DataFrame) -> DataFrame:
    """One row per table: old and new version, column changes, and whether anything changed.

    A table seen for the first time has nothing to be compared with and is
    reported as ``first_seen``.
    """
    old = before.toDF("table_name", "old_version", "old_columns")
    new = now.toDF("table_name", "new_version", "new_columns")
    names_old, names_new = F.map_keys("old_columns"), F.map_keys("new_columns")
    kept = F.array_intersect(names_old, names_new)
    retyped = F.filter(kept, lambda c: F.col("old_columns")[c] != F.col("new_columns")[c])
    compared = old.join(new, "table_name", "full_outer").select(
        "table_name",
        "old_version",
        "new_version",
        F.array_sort(F.array_except(names_new, names_old)).alias("added"),
        F.array_sort(F.array_except(names_old, names_new)).alias("removed"),
        F.array_sort(retyped).alias("retyped"),
    )
    status = (
        F.when(F.col("old_version").isNull(), "first_seen")
        .when(F.col("new_version").isNull(), "dropped")
        .when(
            (F.col("old_version") != F.col("new_version"))
            | (F.size("added") > 0)
            | (F.size("removed") > 0)
            | (F.size("retyped") > 0),
            "changed",
        )
        .otherwise("same")
    )
    return compared.withColumn("status", status)


def dependency_frame(spark: SparkSession, products: Mapping[str, ProductSpec] = PRODUCTS) -> DataFrame:
    """The dependency map as rows (product, dependency)."""
    rows = [(name, dep) for name, spec in products.items() for dep in sorted(spec.depends_on)]
    return spark.createDataFrame(rows, "product string, dependency string")


def products_behind(changes: DataFrame, dependencies: DataFrame) -> DataFrame:
    """(product) that depend on a table in ``changes`` (table_name); ``dependencies`` as above."""
    hit = dependencies.join(changes, F.col("dependency") == F.col("table_name"), "left_semi")
    return hit.select("product").distinct()


# -- integrated table ------------------------------------------------------------


def _span(df: DataFrame, time: str) -> tuple[str | None, str | None]:
    """First and last hour in a frame, as text."""
    hour = F.date_trunc("hour", F.col(time))
    return tuple(df.agg(F.min(hour).cast("string"), F.max(hour).cast("string")).first())


def _within(dim: DataFrame, time: str, span: tuple[str | None, str | None]) -> DataFrame:
    """Rows of an hourly dimension inside a span; the scan skips files and row groups by it."""
    low, high = (F.lit(t).cast("timestamp") for t in span)
    return dim.filter(F.col(time).between(low, high))


def integrated_rows(
    catalog: Catalog, since: int | None = None, upto: int | None = None, with_batch: bool = False
) -> DataFrame:
    """Trips (or only those between two versions) with the current dimensions.

    An increment reads the hourly dimensions only for the hours of its trips.
    """
    trips = catalog.table("trips").read(as_of=upto, since=since, with_batch=with_batch)
    weather, zones, air = (catalog.table(n).read() for n in ("weather", "zones", "air_quality"))
    if since is not None:
        span = _span(trips, "tpep_pickup_datetime")
        weather, air = _within(weather, "timestamp", span), _within(air, wide.AREA_TIME, span)
    return wide.integrate(trips, weather, zones, air, measures=catalog.measures)


def extend_integrated(catalog: Catalog) -> int | None:
    """Append the trips the integrated table does not have yet.

    Its batch number is the trip version it has reached, so a repeated run
    after a failure replaces the same batch and never appends twice. When the trips have been loaded
    afresh, the integrated table starts afresh too.
    """
    reached, trips = catalog.integrated.version(), catalog.table("trips").snapshot().versions()
    target = trips[-1] if trips else None
    if reached == target:
        return None
    change = catalog.integrated.change()
    if reached is not None and trips[0] > reached:
        change.start_at(target)
        reached = None
    change.put(integrated_rows(catalog, since=reached, upto=target), target)
    change.publish()
    return target


def rebuild_integrated(catalog: Catalog) -> None:
    """Integrate every batch again, all in one job and each in its own place."""
    versions = catalog.integrated.versions()
    if not versions:
        return
    rows = integrated_rows(catalog, upto=versions[-1], with_batch=True)
    # A batch holds the trips that came after the batch before it.
    reached = F.array(*[F.lit(v) for v in versions])
    batch = F.element_at(F.filter(reached, lambda v: v >= F.col(BATCH)), 1)
    change = catalog.integrated.change()
    change.rewrite(rows.withColumn(BATCH, batch), whole=versions)
    change.publish()


# -- what follows the integrated table ---------------------------------------------


def changed_parts(now: Snapshot, seen: Mapping[str, list[str]]) -> dict[int, set[str] | None]:
    """By batch the days that were written since ``seen`` (names of writes by batch); ``None`` stands for all.

    A write that is no longer there has been replaced as a whole, by days that need not be the same.
    """
    changed: dict[int, set[str] | None] = {}
    for batch, names in now.writes().items():
        known = seen.get(str(batch), [])
        if not known or set(known) - set(names):
            if names or known:
                changed[batch] = None
            continue
        fresh = [w for w in now.batches[batch].writes if w.name not in known]
        days = {step for w in fresh for folder in w.live or () for step in folder.split("/") if step.startswith(f"{DAY}=")}
        if days:
            changed[batch] = days
    return changed


def _covers(now: Snapshot) -> dict[str, list[str]]:
    return {str(batch): names for batch, names in now.writes().items()}


def sync_borough_layout(catalog: Catalog) -> bool:
    """Bring the borough layout to the state of the day layout: the same batches, and only what has changed.

    Rows are taken from the day layout, so both hold the same ones. Which writes it has copied is kept
    with its data; after a failure the next run copies what is missing.
    """
    if not catalog.two_layouts:
        return False
    source = catalog.integrated.snapshot()
    change = catalog.by_borough.change()
    changed = changed_parts(source, change.before.note.get("covers", {}))
    if not changed and source.versions() == change.before.versions():
        return False
    for start in source.starts:
        change.start_at(start)
    rows = catalog.integrated.read(with_batch=True, snapshot=source)
    whole = [batch for batch, days in changed.items() if days is None]
    parts = {batch: days for batch, days in changed.items() if days is not None}
    wanted = rows.where(F.col(BATCH).isin(whole)) if whole else None
    for batch, days in parts.items():
        some = in_parts(rows.where(F.col(BATCH) == batch), DAY, days)
        wanted = some if wanted is None else wanted.unionByName(some)
    if wanted is not None:
        change.rewrite(wanted, whole=whole, cover=parts, by=[DAY])
    change.note(covers=_covers(source))
    change.publish()
    return True


def _touched(target: DataFrame, source_time: DataFrame, time: str) -> DataFrame:
    """Target rows in the day partitions that the source's times fall into.

    There are no more such days than partitions, and the scan lists only theirs.
    """
    days = source_time.select(F.date_trunc("day", F.col(time)).cast("string")).dropna().distinct()
    return target.where(F.col(DAY).cast("string").isin([row[0] for row in days.collect()]))


def backfill(
    integrated: Table,
    source: DataFrame,
    prefix: str,
    on: Mapping[str, str],
    time: str,
    replace: bool = False,
) -> None:
    """Give integrated rows without a match the late dimension rows in ``source``.

    ``on`` maps target columns to (unprefixed) source columns, ``time`` is the
    source's hour. Only the touched day partitions are read, and written once. With ``replace`` rows
    with a match get the new values as well.
    """
    keys = list(on.values())
    # Stored, so that the planner knows its size and computes it once.
    with staged(one_row_per_key(source.dropna(subset=keys), keys), "late") as unique:
        side = prefix_columns(unique, prefix)
        columns = [prefix + c for c in unique.columns if c not in keys]
        target = _touched(integrated.read(with_batch=True), unique, time)
        filled = fill_unmatched(
            target, side, [(t, prefix + s) for t, s in on.items()], columns, f"{prefix}matched", replace
        )
        integrated.replace_partitions(filled)


def backfill_weather(catalog: Catalog, since: int | None) -> None:
    rows = catalog.table("weather").read(since=since)
    backfill(catalog.integrated, rows, "weather_", {"weather_time": "timestamp"}, "timestamp")


def backfill_air(catalog: Catalog, since: int | None) -> None:
    """Air quality of the hours that got measurements, over all stations of the hour.

    Trips of an hour that had measurements get the new mean too, as a build from scratch gives them.
    """
    table = catalog.table("air_quality")
    hours = [wide.AREA, wide.AREA_TIME]
    late = wide.home_state(table.read(since=since)).select(*hours).distinct()
    readings = _within(table.read(), wide.AREA_TIME, _span(late, wide.AREA_TIME))
    rows = wide.air_per_area_hour(readings.join(late, hours, "left_semi"), catalog.measures)
    backfill(
        catalog.integrated,
        rows,
        "air_q_",
        {"pu_borough": wide.AREA, "weather_time": wide.AREA_TIME},
        wide.AREA_TIME,
        replace=True,
    )


# -- products --------------------------------------------------------------------


def rebuild_product(catalog: Catalog, spec: ProductSpec) -> None:
    """Recompute the state of every day from the integrated table."""
    source = catalog.integrated.snapshot()
    state = product_state(catalog.integrated.read(snapshot=source), spec)
    store_product(catalog.product(spec.name), state, spec, catalog.integrated.path, covers=_covers(source))


def extend_product(catalog: Catalog, spec: ProductSpec) -> bool:
    """Recompute the state of the days whose trips have changed since the product was stored.

    It does not matter what changed them: new trips, late readings that fill gaps, or later ones that
    correct them. Only the partitions of these days are scanned.
    """
    source, table = catalog.integrated.snapshot(), catalog.product(spec.name)
    before = day_states(table).snapshot()
    seen = before.note.get("covers")
    if not before.versions() or seen is None or set(seen) - {str(v) for v in source.versions()}:
        rebuild_product(catalog, spec)
        return True
    changed = changed_parts(source, seen)
    if not changed:
        if is_added_up(table):
            return False
        add_up_days(table, spec, catalog.integrated.path)
        return True
    if any(days is None and seen.get(str(batch)) for batch, days in changed.items()):
        rebuild_product(catalog, spec)
        return True
    days = set().union(*[_days_of(source, batch) if d is None else d for batch, d in changed.items()])
    rows = in_parts(catalog.integrated.read(snapshot=source), DAY, days)
    store_product(table, product_state(rows, spec), spec, catalog.integrated.path, days, _covers(source))
    return True


def _days_of(snapshot: Snapshot, batch: int) -> set[str]:
    """The day folders of a batch."""
    return {folder for w in snapshot.batches[batch].writes for folder in w.live or ()}


def bootstrap_state(catalog: Catalog) -> bool:
    """Record the present versions as the baseline if there is none; tables that do not exist are skipped."""
    if catalog.state.version() is not None:
        return False
    save_state(catalog, current_state(catalog))
    return True


def bootstrap(catalog: Catalog) -> None:
    """First build of the integrated table in both layouts and of all products, and the baseline state."""
    now = current_state(catalog)
    extend_integrated(catalog)
    sync_borough_layout(catalog)
    for spec in catalog.products.values():
        rebuild_product(catalog, spec)
    save_state(catalog, now)


def refresh(catalog: Catalog) -> list[str]:
    """Bring everything up to date with the raw tables; returns the refreshed products.

    Safe to repeat after a failure: every step derives what is missing from the
    tables themselves, and the state is saved last.
    """
    before, now = load_state(catalog), current_state(catalog)
    if catalog.state.version() is None:
        bootstrap(catalog)
        return list(catalog.products)
    # One row per table; a table missing from the state was not watched before.
    found = detect_changes(before, now).where("status IN ('changed', 'first_seen')").select("table_name", "old_version")
    changes = {r["table_name"]: r["old_version"] for r in found.collect()}
    # Also when the state knows the trips: the integrated table may have missed them in a failed run.
    extended = extend_integrated(catalog) is not None
    if not changes and not extended:
        return []
    afresh = [n for n, old in changes.items() if n != "trips" and old is not None and catalog.table(n).start() > old]
    if "zones" in changes or afresh:
        rebuild_integrated(catalog)
    else:
        if "weather" in changes:
            backfill_weather(catalog, changes["weather"])
        if "air_quality" in changes:
            backfill_air(catalog, changes["air_quality"])
    sync_borough_layout(catalog)
    moved = [(name,) for name in changes] + [("trips",)] * extended
    moved_frame = catalog.spark.createDataFrame(moved, "table_name string")
    # One row per product.
    behind = {r["product"] for r in products_behind(moved_frame, dependency_frame(catalog.spark, catalog.products)).collect()}
    refreshed = [name for name in catalog.products if name in behind]
    for name in refreshed:
        extend_product(catalog, catalog.products[name])
    save_state(catalog, now)
    return refreshed
