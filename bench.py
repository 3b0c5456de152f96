"""Bench: one JSON line with the seconds of the headline queries.

Each query is run once to warm up and then timed over full evaluations into
the discard sink; the median counts. ``ratios`` compares the physical variants
the baseline asks for. Progress goes to stderr.
"""

from __future__ import annotations

import json
import os
import statistics
import sys

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from farebox.measure import NO_PLANNER_CHOICE, cached, measure, seconds  # noqa: E402
from farebox.operators import summaries as s  # noqa: E402
from farebox.plans import integrate as wide  # noqa: E402
from farebox.plans import products as p  # noqa: E402
from farebox.plans import refresh as r  # noqa: E402
from farebox.registry import QUERIES, roles  # noqa: E402
from farebox.registry.enrich import integrated_frame  # noqa: E402
from farebox.session import build_session, scoped_conf  # noqa: E402
from farebox.sources.readers import evaluate  # noqa: E402
from farebox.sources.scratch import clear_scratch, scratch_path  # noqa: E402
from farebox.sources.tables import Table  # noqa: E402

HEADLINE = [
    *["zone_monthly_demand", "distance_by_rain", "hourly_demand_air", "demand_air_correlation"],
    *["rain_demand_variation", "peak_hour_by_weekday", "monthly_trend"],
    *["trips_per_borough", "avg_duration_per_day", "avg_fare_per_borough", "fare_one_borough"],
    *["integrated", "enrich_hourly_weather", "enrich_zones_both_ends", "join_broadcast", "join_shuffle"],
    *["shipment_zone_statistics", "shipment_weekday_peak"],
    *["dq_primary_key", "dq_full_row", "dq_metrics", "merge_new_keys", "novel_rows_nullsafe"],
    *["key_overlap_counts", "except_all", "equivalence_counts", "product_merge_sum", "sample_exact_n"],
    *["conform_strings", "safe_cast", "schema_conformance_report"],
]
# These load or rewrite tables; one run each.
WRITING = ["ingest_trip_file", "merge_into_table", "append_novel_trips", "backfill_late_weather"]


def note(text: str) -> None:
    print(text, file=sys.stderr, flush=True)


def time_query(spark, sf_dir: str, name: str, runs: int = 3) -> float:
    """Median of building and running the query, after one warm-up."""
    evaluate(QUERIES[name](spark, sf_dir))
    return statistics.median(seconds(lambda: evaluate(QUERIES[name](spark, sf_dir))) for _ in range(runs))


def ratios(spark, sf_dir: str) -> dict[str, float]:
    """Time of the plain variant over that of the tuned one; above 1 the tuned one is faster."""
    out = {}
    frame = integrated_frame(spark, sf_dir)
    by_day = Table(spark, scratch_path(spark, "bench-day"), r.DAY_LAYOUT)
    # History and update are two batches, as a refresh leaves them.
    cut = F.lit(roles.HISTORY_END).cast("timestamp")
    older = F.coalesce(F.col("tpep_pickup_datetime") < cut, F.lit(True))
    write_day = seconds(lambda: [by_day.append(frame.where(part)) for part in (older, ~older)])
    by_area = Table(spark, scratch_path(spark, "bench-borough"), r.BOROUGH_LAYOUT)
    write_area = seconds(lambda: by_area.append(by_day.read()))
    out["write_by_day_sec"], out["write_by_borough_sec"] = write_day, write_area

    day, area = by_day.read(), by_area.read()
    fares = [s.average_fare_in_area(t, "ASIA") for t in (day, area)]
    out["pruned_vs_full"] = measure(fares[0]) / measure(fares[1])

    # The product before the update, its refresh by the days that the update touched, and a rebuild of all days.
    spec = p.WEATHER_SUMMARY
    catalog = r.Catalog(spark, scratch_path(spark, "bench-catalog"), two_layouts=False)
    catalog.integrated.append(frame.where(older))
    r.rebuild_product(catalog, spec)
    catalog.integrated.append(frame.where(~older))
    incremental = seconds(lambda: r.extend_product(catalog, spec))
    out["incremental_vs_rebuild"] = seconds(lambda: r.rebuild_product(catalog, spec)) / incremental

    spec = p.ZONE_STATISTICS
    product = catalog.product(spec.name)
    p.store_product(product, p.product_state(day, spec), spec, "bench")
    shown = p.read_product(product, spec)
    out["product_vs_direct"] = measure(s.zone_monthly_demand(day)) / measure(s.product_zone_demand(shown))

    with scoped_conf(spark, NO_PLANNER_CHOICE):
        joins = [QUERIES[name](spark, sf_dir) for name in ("join_shuffle", "join_broadcast")]
        for join in joins:
            evaluate(join)
        out["broadcast_vs_shuffle"] = measure(joins[0]) / measure(joins[1])

    peak = s.peak_hour_by_weekday(day)
    with scoped_conf(spark, {"spark.sql.adaptive.enabled": "false"}):
        without = measure(s.peak_hour_by_weekday(day))
    out["adaptive_on_vs_off"] = without / measure(peak)

    direct = measure(s.zone_monthly_demand(wide.with_zones(roles.trips(spark, sf_dir), roles.zones(spark, sf_dir))))
    base = wide.with_zones(roles.trips(spark, sf_dir), roles.zones(spark, sf_dir))
    with cached(base.select("pu_zone", "tpep_pickup_datetime")) as held:
        out["cached_vs_not"] = direct / measure(s.zone_monthly_demand(held))
    return {k: round(v, 3) for k, v in out.items()}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        times[name] = round(time_query(spark, sf_dir, name), 4)
        note(f"{times[name]:8.3f}s {name}")
    for name in WRITING:
        times[name] = round(seconds(lambda: evaluate(QUERIES[name](spark, sf_dir))), 4)
        note(f"{times[name]:8.3f}s {name}")
    compared = ratios(spark, sf_dir)
    note(json.dumps(compared))
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "ratios": compared,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    clear_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
