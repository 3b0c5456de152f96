"""Managed tables, loads, refresh and the stream on small data."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.measure import cached, measure, plan_text
from farebox.operators.rowsets import frames_equal
from farebox.plans import products as p
from farebox.plans import refresh as r
from farebox.operators.quality import graded_rows, one_row_per_key, quality_counts
from farebox.plans.ingest import ingest_all, ingest_dataset, ingest_frame, ingest_log
from farebox.plans.updates import load_update, update_log
from farebox.session import scoped_conf
from farebox.sources.city import air_quality_spec, trips_spec, weather_spec, zones_spec
from farebox.sources import tables
from farebox.sources.scratch import scratch_path, stage, staged
from farebox.sources.tables import Table
from farebox.streaming.updates import update_stream


@pytest.fixture
def root(spark):
    return scratch_path(spark, "test")


# -- tables -------------------------------------------------------------------------


def test_versions_and_time_travel(spark, root):
    t = Table(spark, f"{root}/t")
    assert t.version() is None and t.fingerprint() is None
    with pytest.raises(FileNotFoundError):
        t.read()
    assert t.append(spark.createDataFrame([(1,)], "a int")) == 0
    assert t.append(spark.createDataFrame([(2, "n")], "a int, b string")) == 1
    assert t.append(spark.createDataFrame([("3",)], "a string")) == 2
    assert sorted(tuple(x) for x in t.read().collect()) == [(1, None), (2, "n"), (3, None)]
    assert [tuple(x) for x in t.read(as_of=0).collect()] == [(1,)]
    assert sorted(x["a"] for x in t.read(since=0).collect()) == [2, 3]
    assert t.read(since=2).count() == 0
    assert t.read_latest().collect()[0]["a"] == 3
    assert t.fingerprint().version == 2 and dict(t.fingerprint().columns) == {"a": "int", "b": "string"}
    assert [(x["_batch_id"], x["row_count"]) for x in t.history(2).collect()] == [(2, 1), (1, 1)]


def test_repeated_batch_replaces_itself(spark, root):
    t = Table(spark, f"{root}/t", {"d": T.StringType()})
    t.append(spark.createDataFrame([(1, "x")], "a int, d string"))
    t.write_batch(spark.createDataFrame([(2, "y"), (3, "z")], "a int, d string"), 1)
    t.write_batch(spark.createDataFrame([(2, "y")], "a int, d string"), 1)
    assert sorted(x["a"] for x in t.read().collect()) == [1, 2]


def test_unfinished_batch_is_invisible(spark, root):
    t = Table(spark, f"{root}/t")
    t.append(spark.createDataFrame([(1,)], "a int"))
    change = t.change()
    change.put(spark.createDataFrame([(2, 5)], "a int, ghost int"), 1)
    assert t.version() == 0 and t.read().count() == 1 and t.read().columns == ["a"]
    assert t.vacuum() == 1 and t.vacuum() == 0
    t.append(spark.createDataFrame([(3,)], "a int"))
    with pytest.raises(OSError):
        change.publish()
    assert sorted(x.a for x in t.read().collect()) == [1, 3]


def files_of(path):
    return sorted(str(f) for f in path.rglob("*") if f.is_file())


def test_readers_see_whole_states_and_change_nothing(spark, tmp_path, monkeypatch):
    """At every step of a write to storage the table is read: it is the old one or the new one."""
    t = Table(spark, str(tmp_path / "t"), {"k": T.IntegerType()})
    t.append(spark.createDataFrame([(1, 1), (2, 2)], "a int, k int"))
    t.append(spark.createDataFrame([(3, 1)], "a int, k int"))
    seen = []

    def look():
        before = files_of(tmp_path)
        seen.append((t.read().columns, sorted(tuple(x) for x in t.read(with_batch=True).collect())))
        assert files_of(tmp_path) == before

    def watched(function):
        def step(*args, **more):
            look()
            out = function(*args, **more)
            look()
            return out

        return step

    def reload():
        change = t.change()
        change.start_at(change.next_batch())
        for n in (7, 8, 9):
            change.put(spark.createDataFrame([(n, n)], "a int, k int"), change.next_batch())
        change.publish()

    def rewrite():
        rows = t.read(with_batch=True).where("k = 1").withColumn("a", F.col("a") + 10).withColumn("n", F.lit("x"))
        t.replace_partitions(rows)

    grown = spark.createDataFrame([(4, 1, 0.5)], "a int, k int, more double")
    for do in (lambda: t.write_batch(grown, 1), rewrite, reload):
        look()
        old = seen[-1]
        seen.clear()
        with monkeypatch.context() as m:
            for name in ("write_text", "move_path", "remove_path", "child_names"):
                m.setattr(tables, name, watched(getattr(tables, name)) if name != "child_names" else getattr(tables, name))
            m.setattr(tables.Change, "_write", watched(tables.Change._write))
            do()
        look()
        new = seen[-1]
        assert old != new and all(state in (old, new) for state in seen) and len(seen) > 5
    assert [x.a for x in t.read().orderBy("a").collect()] == [7, 8, 9]


def test_old_folders_go_and_late_readers_still_read(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "KEEP", 2)
    t = Table(spark, str(tmp_path / "t"), {"k": T.IntegerType()})
    t.append(spark.createDataFrame([(k, k) for k in range(6)], "a int, k int"))
    late = t.read()
    t.replace_partitions(t.read(with_batch=True).where("k = 1").withColumn("a", F.lit(50)))
    assert sorted(x.a for x in late.collect()) == [0, 1, 2, 3, 4, 5]
    for k in (2, 3, 1, 1):
        t.replace_partitions(t.read(with_batch=True).where(f"k = {k}").withColumn("a", F.col("a") + 10))
    t.write_batch(spark.createDataFrame([(9, 9)], "a int, k int"), 1)
    assert sorted(x.a for x in t.read().collect()) == [0, 4, 5, 9, 12, 13, 70]
    parts = [f for f in files_of(tmp_path) if f.endswith(".parquet")]
    assert len(parts) <= 9, "folders that no kept snapshot names are removed"
    assert t.vacuum() == 0


def test_partition_pruning_and_null_partition(spark, root):
    t = Table(spark, f"{root}/t", {"zone": T.StringType()})
    t.append(spark.createDataFrame([(1, "A"), (2, None), (3, "B")], "a int, zone string"))
    assert {(x["a"], x["zone"]) for x in t.read().collect()} == {(1, "A"), (2, None), (3, "B")}
    plan = plan_text(t.read().filter(F.col("zone") == "A").select("a"))
    assert "PartitionFilters: [isnotnull(zone" in plan


def test_hot_partition_is_written_by_several_tasks(spark, root):
    """The rebalance before a partitioned write splits a partition that is too large."""
    t = Table(spark, f"{root}/t", {"zone": T.StringType()})
    df = spark.range(0, 200_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.col("id").cast("string")).otherwise(F.lit("pad" * 20)).alias("payload"),
        F.when(F.col("id") % 50 == 0, "B").otherwise("A").alias("zone"),
    )
    with scoped_conf(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "200KB"}):
        t.append(df)
    files = t.read().filter(F.col("zone") == "A").select(F.input_file_name().alias("f")).distinct().count()
    assert files > 1 and t.read().count() == 200_000


def test_replace_partitions_touches_only_what_it_covers(spark, root):
    t = Table(spark, f"{root}/t", {"zone": T.StringType()})
    t.append(spark.createDataFrame([(1, "A"), (2, "B")], "a int, zone string"))
    t.append(spark.createDataFrame([(3, "A")], "a int, zone string"))
    mine = t.read(with_batch=True).filter((F.col("zone") == "A") & (F.col("_batch_id") == 0))
    t.replace_partitions(mine.withColumn("a", F.col("a") + 100).withColumn("note", F.lit("n")))
    got = sorted(tuple(x) for x in t.read(with_batch=True).select("a", "note", "zone", "_batch_id").collect())
    assert got == [(2, None, "B", 0), (3, None, "A", 1), (101, "n", "A", 0)]


def test_stage(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert frames_equal(stage(df, "x"), df)
    with staged(df, "x") as copy:
        location = copy.inputFiles()[0]
        assert frames_equal(copy, df)
    import os

    assert not os.path.exists(location.removeprefix("file://"))


def test_scratch_follows_the_cluster_setting(spark, tmp_path, monkeypatch):
    from farebox.sources import scratch

    assert scratch._SETTING == "spark.checkpoint.dir"
    # That setting is fixed once a session runs, so another name stands in for it.
    monkeypatch.setattr(scratch, "_SETTING", "farebox.test.dir")
    with scoped_conf(spark, {"farebox.test.dir": str(tmp_path)}):
        assert scratch.scratch_root(spark).startswith(str(tmp_path))
        stage(spark.range(3), "x")
        assert any(tmp_path.rglob("_SUCCESS"))


def test_scoped_conf_restores_after_an_error(spark):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    with pytest.raises(RuntimeError), scoped_conf(spark, {"spark.sql.adaptive.enabled": "false"}):
        raise RuntimeError
    assert spark.conf.get("spark.sql.adaptive.enabled") == before


def test_cached_and_measure(spark):
    with cached(spark.range(5)) as held:
        assert "InMemoryTableScan" in plan_text(held)
        assert measure(held, 1) >= 0
    assert not held.is_cached


# -- ingestion ----------------------------------------------------------------------------

ZONES = "LocationID,Borough,Zone,service_zone\n1, EWR ,Newark,EWR\n2,Queens,  ,Boro\n2,Queens,Zed,Boro\n,Bronx,X,Boro\nbad,Bronx,Y,Boro\n"


def test_ingest_csv(spark, root, tmp_path):
    (tmp_path / "z.csv").write_text(ZONES)
    table = Table(spark, f"{root}/zones")
    record = ingest_dataset(spark, zones_spec(str(tmp_path / "z.csv")), table)
    assert (record.processed_records, record.null_key_records, record.duplicate_records, record.final_records) == (5, 2, 1, 2)
    assert {tuple(x) for x in table.read().collect()} == {(1, "EWR", "Newark", "EWR"), (2, "Queens", "Zed", "Boro")}
    assert ingest_log(spark, [record]).first()["rejected_records"] == 3


def test_ingest_reads_its_source_once(spark, root, tmp_path):
    """Every raw row is computed once, whatever is counted; a NULL key that is hot is no row to keep."""
    log = tmp_path / "seen"

    def note(batches):
        for batch in batches:
            with open(log, "a") as out:
                out.write("x" * batch.num_rows)
            yield batch

    lines = [(str(k % 40) if k % 3 else None, " Q ", f"z{k % 7}" if k % 5 else None, "s") for k in range(600)]
    raw = spark.createDataFrame(lines, "LocationID string, Borough string, Zone string, service_zone string")
    raw = raw.repartition(5).mapInArrow(note, raw.schema)
    spec = zones_spec("unused")
    table = Table(spark, f"{root}/zones")
    record = ingest_frame(raw, spec, table)
    assert len(log.read_text()) == 600
    kept = {}
    for key, _, zone, _ in lines:
        if key is not None:
            kept.setdefault(int(key), []).append((zone is None, zone))
    assert (record.processed_records, record.null_key_records, record.final_records) == (600, 200, len(kept))
    assert record.duplicate_records == 400 - len(kept)
    got = {tuple(x) for x in table.read().select("location_id", "zone").collect()}
    assert got == {(key, min(zones)[1]) for key, zones in kept.items()}
    assert table.read().columns == ["location_id", "borough", "zone", "service_zone"]


@pytest.mark.parametrize("keys", [["k"], ["k", "b"], []])
def test_graded_rows_keep_the_same_rows(spark, keys):
    data = [(1, "b", 2.0), (1, None, 1.0), (1, "a", None), (1, "a", 3.0), (2, None, None), (None, "x", 1.0), (None, "x", 1.0), (2, None, None)]
    df = spark.createDataFrame(data, "k int, b string, c double")
    graded = graded_rows(df, keys)
    counts = quality_counts(df, keys).first()
    assert graded.agg(F.sum("_copies")).first()[0] == counts["processed"] == 8
    complete = graded.drop("_copies").dropna(subset=keys) if keys else graded.drop("_copies")
    want = one_row_per_key(df.dropna(subset=keys), keys) if keys else df.distinct()
    assert frames_equal(complete, want) and complete.count() == counts["kept"]


def test_a_reload_of_several_files_shows_all_or_none(spark, root, tmp_path):
    specs = []
    for n in (1, 2, 3):
        (tmp_path / f"{n}.csv").write_text(f"LocationID,Borough,Zone,service_zone\n{n},B,z{n},s\n")
        specs.append(zones_spec(str(tmp_path / f"{n}.csv")))
    table = Table(spark, f"{root}/zones")
    table.append(spark.createDataFrame([(9, "X", "old", "s")], "location_id int, borough string, zone string, service_zone string"))
    shown = []

    def watched():
        for spec in specs:
            shown.append([x.zone for x in table.read().collect()])
            yield spec

    records = ingest_all(spark, watched(), lambda _: table)
    assert shown == [["old"]] * 3 and [x.final_records for x in records] == [1, 1, 1]
    assert sorted(x.zone for x in table.read().collect()) == ["z1", "z2", "z3"] and table.versions() == [1, 2, 3]


def test_ingest_restores_codes_and_times(spark, root, tmp_path):
    spec = air_quality_spec(str(tmp_path / "a.csv"))
    row = {c: "" for c in spec.raw_names}
    row |= {"State Code": "6", "County Code": "5", "Site Num": "12", "Parameter Code": "88101", "POC": "1"}
    row |= {"Date Local": "2024-01-01", "Time Local": "07:00", "Sample Measurement": " 4.5 "}
    (tmp_path / "a.csv").write_text(",".join(row) + "\n" + ",".join(row.values()) + "\n")
    table = Table(spark, f"{root}/air")
    ingest_dataset(spark, spec, table)
    got = table.read().withColumn("t", F.col("datetime_local").cast("string")).first()
    assert (got["state_code"], got["county_code"], got["site_num"], got["sample_measurement"], got["t"]) == (
        "06",
        "005",
        "0012",
        4.5,
        "2024-01-01 07:00:00",
    )


# -- a small installation --------------------------------------------------------------------

MEASURE_COLUMNS = [c for c in trips_spec().columns if c not in ("tpep_pickup_datetime", "tpep_dropoff_datetime")]


def trip_rows(spark, rows):
    """Trips from (vendor, pickup text, zone, distance, fare)."""
    df = spark.createDataFrame(rows, "vendor_id bigint, t string, z bigint, trip_distance double, fare_amount double")
    df = df.withColumns(
        {
            "tpep_pickup_datetime": F.col("t").cast("timestamp"),
            "tpep_dropoff_datetime": F.col("t").cast("timestamp") + F.expr("INTERVAL 10 MINUTES"),
            "pu_location_id": F.col("z"),
            "do_location_id": F.lit(2).cast("bigint"),
        }
    )
    spec = trips_spec()
    have = set(df.columns)
    return df.select(
        *[F.col(c) if c in have else F.lit(None).cast(t).alias(c) for c, t in spec.columns.items()]
    ).withColumn("store_and_fwd_flag", F.lit(None).cast("boolean"))


def weather_rows(spark, rows):
    df = spark.createDataFrame(rows, "t string, temp double, prcp double")
    return df.select(F.col("t").cast("timestamp").alias("timestamp"), "temp", "prcp")


def air_rows(spark, rows):
    df = spark.createDataFrame(rows, "county_name string, t string, site_num string, sample_measurement double")
    return df.select(
        F.lit("36").alias("state_code"),
        "county_name",
        "site_num",
        "sample_measurement",
        F.col("t").cast("timestamp").alias("datetime_local"),
    )


H = "2024-01-0{} {:02d}:15:00".format


@pytest.fixture
def catalog(spark, root):
    cat = r.Catalog(spark, root)
    trips = [(1, H(1, 10), 1, 2.0, 10.0), (2, H(1, 11), 1, None, 20.0), (3, H(2, 10), 9, 4.0, None)]
    cat.table("trips").append(trip_rows(spark, trips))
    cat.table("weather").append(weather_rows(spark, [("2024-01-01 10:00:00", None, 0.0)]))
    cat.table("zones").append(
        spark.createDataFrame([(1, "A", "a1", "s"), (2, "B", "b1", "s")], "location_id int, borough string, zone string, service_zone string")
    )
    cat.table("air_quality").append(air_rows(spark, [("A", "2024-01-01 10:00:00", "s1", 1.0)]))
    assert sorted(r.refresh(cat)) == sorted(p.PRODUCTS)
    return cat


def check_equals_rebuild(cat):
    """Integrated table and products must equal a build from scratch."""
    assert frames_equal(
        cat.integrated.read().select(*COMPARED), r.integrated_rows(cat).select(*COMPARED)
    )
    for name, spec in cat.products.items():
        stored = p.read_product(cat.product(name), spec).drop(*p.PROVENANCE)
        assert frames_equal(stored, p.build_product(r.integrated_rows(cat), spec)), name


COMPARED = [
    *["vendor_id", "tpep_pickup_datetime", "pu_borough", "pu_zone", "do_zone", "weather_prcp", "weather_matched"],
    *["air_q_matched", "air_q_sample_measurement", "air_q_measurements", "day_timestamp", "trip_distance"],
]


def test_bootstrap_then_nothing_to_do(catalog):
    check_equals_rebuild(catalog)
    assert r.refresh(catalog) == []


def test_new_trips(spark, catalog):
    new = [(1, H(1, 10), 1, 2.0, 10.0), (4, H(1, 10), 1, 6.0, 1.0), (5, H(3, 10), 2, None, None), (5, H(3, 10), 2, None, None)]
    spec = trips_spec(name="trips")
    record = load_update(catalog.table("trips"), trip_rows(spark, new).drop("store_and_fwd_flag"), spec, event_time="tpep_pickup_datetime")
    assert (record.rows_in_update, record.duplicates, record.inserted, record.schema_change) == (4, 2, 2, "")
    assert sorted(r.refresh(catalog)) == sorted(p.PRODUCTS)
    check_equals_rebuild(catalog)
    table = catalog.product("taxi_zone_statistics")
    first, version = p.provenance_of(table)
    shown = p.read_product(table, p.ZONE_STATISTICS).first()
    assert version == 2.0 and shown["schema_version"] == "2.0" and shown["refresh_time"] > shown["creation_time"]
    assert shown["creation_time"].timestamp() == first.timestamp()


def test_late_weather_with_new_column(spark, catalog):
    late = weather_rows(spark, [("2024-01-01 11:00:00", 5.0, 1.0), ("2024-01-02 10:00:00", 6.0, None), ("2024-01-09 10:00:00", 7.0, 2.0)])
    catalog.table("weather").append(late.withColumn("humidity", F.lit(50.0)))
    assert r.refresh(catalog) == ["weather_impact_summary"]
    check_equals_rebuild(catalog)
    got = {x["vendor_id"]: (x["weather_temp"], x["weather_humidity"], x["weather_matched"]) for x in catalog.integrated.read().collect()}
    assert got == {1: (None, None, True), 2: (5.0, 50.0, True), 3: (6.0, 50.0, True)}


def test_late_air_quality_of_several_stations(spark, catalog):
    late = [("A", "2024-01-01 11:00:00", "s1", 3.0), ("A", "2024-01-01 11:00:00", "s2", 5.0), ("B", "2024-01-01 11:00:00", "s3", 9.0)]
    catalog.table("air_quality").append(air_rows(spark, late))
    assert r.refresh(catalog) == ["air_quality_impact_summary"]
    check_equals_rebuild(catalog)
    assert catalog.integrated.read().filter("vendor_id = 2").first()["air_q_sample_measurement"] == 4.0


def test_changed_zones_rebuild(spark, catalog):
    catalog.table("trips").append(trip_rows(spark, [(6, H(1, 12), 9, 1.0, 1.0)]))
    r.refresh(catalog)
    catalog.table("zones").append(
        spark.createDataFrame([(9, "C", "c1", "s")], "location_id int, borough string, zone string, service_zone string")
    )
    assert r.refresh(catalog) == ["taxi_zone_statistics"]
    assert {x["pu_zone"] for x in catalog.integrated.read().collect()} == {"a1", "c1"}
    assert frames_equal(
        p.read_product(catalog.product("taxi_zone_statistics"), p.ZONE_STATISTICS).drop(*p.PROVENANCE),
        p.build_product(r.integrated_rows(catalog), p.ZONE_STATISTICS),
    )
    catalog.table("trips").append(trip_rows(spark, [(7, H(1, 13), 9, 1.0, 1.0)]))
    r.refresh(catalog)
    check_equals_rebuild(catalog)


def test_failure_before_the_state_is_saved(spark, catalog, monkeypatch):
    """Everything up to the state is done, then the driver dies; more trips arrive; refresh again."""
    catalog.table("trips").append(trip_rows(spark, [(8, H(2, 11), 1, 3.0, 3.0)]))

    def die(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        m.setattr(r, "save_state", die)
        r.refresh(catalog)
    catalog.table("trips").append(trip_rows(spark, [(9, H(2, 12), 1, 3.0, 3.0)]))
    r.refresh(catalog)
    check_equals_rebuild(catalog)
    assert catalog.integrated.read().count() == 5


def check_layouts(cat):
    day, borough = cat.integrated, cat.by_borough
    assert day.versions() == borough.versions()
    columns = [*COMPARED, "_batch_id"]
    assert frames_equal(borough.read(with_batch=True).select(*columns), day.read(with_batch=True).select(*columns))
    assert set(day.schema().names) == set(borough.schema().names)


def folders(cat):
    """Folders with data of the borough layout, by batch and write."""
    now = cat.by_borough.snapshot()
    return {(n, w.name): set(w.live) for n, b in now.batches.items() for w in b.writes}


def test_both_layouts_in_step(spark, catalog):
    """First build, new trips, late weather and air, changed zones, a reload: the layouts hold the same batches."""
    check_layouts(catalog)
    first = folders(catalog)
    catalog.table("trips").append(trip_rows(spark, [(8, H(2, 11), 1, 3.0, 3.0)]))
    r.refresh(catalog)
    check_layouts(catalog)
    assert first.items() <= folders(catalog).items(), "the first batch was left alone"
    catalog.table("weather").append(weather_rows(spark, [("2024-01-01 11:00:00", 5.0, 1.0)]).withColumn("humidity", F.lit(1.0)))
    r.refresh(catalog)
    check_layouts(catalog)
    kept = {key: live for key, live in folders(catalog).items() if key in first}
    assert [sorted(live) for live in kept.values()] == [
        ["pu_borough=__HIVE_DEFAULT_PARTITION__/day_timestamp=2024-01-02 00%3A00%3A00"]
    ], "only the touched day was copied"
    catalog.table("air_quality").append(air_rows(spark, [("A", "2024-01-02 11:00:00", "s1", 3.0)]))
    catalog.table("zones").append(
        spark.createDataFrame([(9, "C", "c1", "s")], "location_id int, borough string, zone string, service_zone string")
    )
    r.refresh(catalog)
    check_layouts(catalog)
    assert not r.sync_borough_layout(catalog)
    change = catalog.table("trips").change()
    change.start_at(2)
    change.put(trip_rows(spark, [(1, H(5, 10), 1, 2.0, 10.0)]), 2)
    change.publish()
    r.refresh(catalog)
    check_layouts(catalog)
    check_equals_rebuild(catalog)


def test_layouts_meet_again_after_a_failure(spark, catalog, monkeypatch):
    catalog.table("trips").append(trip_rows(spark, [(8, H(2, 11), 1, 3.0, 3.0)]))
    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        m.setattr(r, "sync_borough_layout", lambda _: (_ for _ in ()).throw(RuntimeError("driver lost")))
        r.refresh(catalog)
    assert catalog.integrated.version() == 1 and catalog.by_borough.version() == 0
    r.refresh(catalog)
    check_layouts(catalog)


def test_late_readings_are_taken_back_out(spark, catalog):
    """A second station and a third correct the mean of an hour: the product forgets what it was."""
    for n, level in (("s2", 3.0), ("s3", 8.0)):
        catalog.table("air_quality").append(air_rows(spark, [("A", "2024-01-01 10:00:00", n, level)]))
        assert r.refresh(catalog) == ["air_quality_impact_summary"]
        check_equals_rebuild(catalog)
    table = catalog.product("air_quality_impact_summary")
    assert p.read_product(table, p.AIR_SUMMARY).first()["avg_air_quality"] == 4.0


def test_products_scan_only_touched_days(spark, catalog, monkeypatch):
    catalog.table("weather").append(weather_rows(spark, [("2024-01-01 11:00:00", 5.0, 1.0)]))
    scanned = []
    state = r.product_state
    monkeypatch.setattr(r, "product_state", lambda rows, spec: (scanned.append(rows), state(rows, spec))[1])
    r.refresh(catalog)
    (rows,) = scanned
    assert {str(x[0]) for x in rows.select("day_timestamp").distinct().collect()} == {"2024-01-01 00:00:00"}
    assert "PartitionFilters: [" in plan_text(rows) and "day_timestamp" in plan_text(rows).split("PartitionFilters: ")[1]
    assert not r.extend_product(catalog, p.WEATHER_SUMMARY)


def test_a_product_is_added_up_after_a_failure(spark, catalog, monkeypatch):
    """The states of the days are stored, then the driver dies: the next refresh adds them up."""
    catalog.table("weather").append(weather_rows(spark, [("2024-01-01 11:00:00", 5.0, 1.0)]))
    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        m.setattr(p, "add_up_days", lambda *_: (_ for _ in ()).throw(RuntimeError("driver lost")))
        r.refresh(catalog)
    assert r.refresh(catalog) == ["weather_impact_summary"]
    check_equals_rebuild(catalog)


def test_a_day_without_rows_left(spark, catalog):
    """A product whose day loses its last row loses the state of that day."""
    table, spec = catalog.product("weather_impact_summary"), p.WEATHER_SUMMARY
    assert p.read_product(table, spec).count() == 1
    wide_rows = catalog.integrated.read(with_batch=True).where("day_timestamp = '2024-01-01'")
    catalog.integrated.replace_partitions(wide_rows.withColumn("weather_prcp", F.lit(None).cast("double")))
    assert r.extend_product(catalog, spec)
    assert p.read_product(table, spec).count() == 0


def test_all_air_columns_by_their_type(spark, catalog):
    """Numbers are averaged, texts count if all agree; a column that comes later reaches the wide table."""
    late = air_rows(spark, [("A", "2024-01-01 11:00:00", "s1", 3.0), ("A", "2024-01-01 11:00:00", "s2", 5.0)])
    late = late.withColumns({"aqi": F.col("sample_measurement").cast("int") * 2, "units": F.lit("ug")})
    catalog.table("air_quality").append(late)
    r.refresh(catalog)
    got = {x.vendor_id: x for x in catalog.integrated.read().collect()}
    columns = ["air_q_sample_measurement", "air_q_aqi", "air_q_units", "air_q_site_num", "air_q_state_code"]
    assert [got[2][c] for c in columns] == [4.0, 8.0, "ug", None, "36"]
    assert [got[1][c] for c in columns] == [1.0, None, None, "s1", "36"]
    check_layouts(catalog)
    compared = [*COMPARED, *columns[1:]]
    assert frames_equal(catalog.integrated.read().select(*compared), r.integrated_rows(catalog).select(*compared))


def test_rebuild_is_one_write(spark, catalog, monkeypatch):
    catalog.table("trips").append(trip_rows(spark, [(6, H(1, 12), 9, 1.0, 1.0)]))
    catalog.table("trips").append(trip_rows(spark, [(7, H(3, 12), 1, 1.0, 1.0)]))
    r.refresh(catalog)
    catalog.table("trips").append(trip_rows(spark, [(8, H(3, 13), 1, 1.0, 1.0)]))
    r.extend_integrated(catalog)
    before = catalog.integrated.read(with_batch=True).select(*COMPARED, "_batch_id").collect()
    writes, write = [], tables.Change._write
    monkeypatch.setattr(tables.Change, "_write", lambda *a: (writes.append(a), write(*a))[1])
    r.rebuild_integrated(catalog)
    assert len(writes) == 1 and catalog.integrated.versions() == [0, 2, 3]
    after = catalog.integrated.read(with_batch=True).select(*COMPARED, "_batch_id").collect()
    assert sorted(map(str, before)) == sorted(map(str, after))


def test_detect_changes(spark):
    before = spark.createDataFrame(
        [("a", 0, {"x": "int"}), ("b", 1, {"x": "int", "y": "int"}), ("gone", 0, {"x": "int"}), ("same", 3, {"x": "int"})],
        r.STATE_SCHEMA,
    )
    now = spark.createDataFrame(
        [("a", 1, {"x": "int", "z": "int"}), ("b", 1, {"x": "string"}), ("new", 0, {"x": "int"}), ("same", 3, {"x": "int"})],
        r.STATE_SCHEMA,
    )
    got = {x["table_name"]: (x["status"], x["added"], x["removed"], x["retyped"]) for x in r.detect_changes(before, now).collect()}
    assert got["a"] == ("changed", ["z"], [], [])
    assert got["b"] == ("changed", [], ["y"], ["x"])
    assert got["same"] == ("same", [], [], [])
    assert got["gone"][0] == "dropped" and got["new"][0] == "first_seen"


def test_products_behind(spark):
    def behind(*names):
        changes = spark.createDataFrame([(n,) for n in names], "table_name string")
        return {x["product"] for x in r.products_behind(changes, r.dependency_frame(spark)).collect()}

    assert behind("weather") == {"weather_impact_summary"}
    assert behind("zones") == {"taxi_zone_statistics"}
    assert len(behind("trips")) == 4
    assert behind() == set()


@pytest.mark.parametrize("step", ["data", "draft", "rewrite", "after"])
def test_a_crash_loses_nothing(spark, tmp_path, step, monkeypatch):
    """The write stops before the snapshot is written, before it is renamed, within a rewrite, or while old ones go."""
    t = Table(spark, str(tmp_path / "t"), {"k": T.IntegerType()})
    t.append(spark.createDataFrame([(1, 1), (2, 2)], "a int, k int"))

    def fail(*_):
        raise OSError("crash")

    with monkeypatch.context() as m:
        name = {"data": "write_text", "draft": "move_path", "rewrite": "move_path"}.get(step)
        m.setattr(*((tables, name, fail) if name else (tables.Change, "_forget", fail)))
        with pytest.raises(OSError):
            if step == "rewrite":
                t.replace_partitions(t.read(with_batch=True).where("k = 1").withColumn("a", F.lit(9)))
            else:
                t.write_batch(spark.createDataFrame([(9, 1), (2, 2)], "a int, k int"), 0)
    got = sorted(tuple(x) for x in t.read().collect())
    assert got == ([(2, 2), (9, 1)] if step == "after" else [(1, 1), (2, 2)])
    t.write_batch(spark.createDataFrame([(5, 5)], "a int, k int"), 0)
    assert [tuple(x) for x in t.read().collect()] == [(5, 5)]


def test_a_table_loaded_afresh(spark, tmp_path):
    t = Table(spark, str(tmp_path / "t"))
    for x in (1, 2, 3):
        if x == 3:
            t.start_at(2)
            assert t.read().count() == 2
        t.append(spark.createDataFrame([(x,)], "a int"))
    assert [x.a for x in t.read().collect()] == [3] and t.versions() == [2] and t.start() == 2
    assert sorted(x.a for x in t.read(as_of=1).collect()) == [1, 2]


# -- keyed updates and the stream ----------------------------------------------------------------


def weather_csv(path, lines, extra=""):
    spec = weather_spec(str(path))
    head = ",".join(spec.raw_names) + extra
    path.write_text("\n".join([head, *lines]) + "\n")
    return spec


def weather_line(hour, temp, extra=""):
    return f"2024,1,1,{hour},{temp}" + "," * 19 + extra


def test_keyed_update_with_new_column(spark, root, tmp_path):
    base = weather_csv(tmp_path / "w.csv", [weather_line(0, 1.5), weather_line(1, 2.5)])
    table = Table(spark, f"{root}/weather")
    ingest_dataset(spark, base, table)
    lines = [weather_line(1, 9, ",70"), weather_line(2, 3, ",71.5"), weather_line(2, 3, ",71.5"), weather_line("", 3, ",1")]
    update = weather_csv(tmp_path / "u.csv", lines, ",humidity")
    raw = spark.read.option("header", "true").csv(update.path)
    record = load_update(table, raw, update, {"humidity": T.DoubleType()})
    assert (record.rows_in_update, record.null_keys, record.duplicates, record.inserted) == (4, 1, 2, 1)
    assert record.schema_change == "+humidity"
    got = sorted(tuple(x) for x in table.read().select("hour", "temp", "humidity").collect())
    assert got == [(0, 1.5, None), (1, 2.5, None), (2, 3.0, 71.5)]
    assert str(table.read().filter("hour = 2").select(F.col("timestamp").cast("string")).first()[0]) == "2024-01-01 02:00:00"
    # the same load again, as the same batch and as a new one
    load_update(table, raw, update, {"humidity": T.DoubleType()}, batch=1)
    assert table.read().count() == 3
    again = load_update(table, raw, update, {"humidity": T.DoubleType()})
    assert again.inserted == 0 and table.read().count() == 3
    assert update_log(spark, [record, again]).count() == 2


def test_stream_loads_each_file_once(spark, root, tmp_path):
    base = weather_csv(tmp_path / "w.csv", [weather_line(0, 1.5)])
    table = Table(spark, f"{root}/weather")
    ingest_dataset(spark, base, table)
    landing = tmp_path / "landing"
    landing.mkdir()
    text = T.StructType([T.StructField(n, T.StringType()) for n in base.raw_names])
    records = []

    def run():
        update_stream(table, base, str(landing), str(tmp_path / "cp"), text, records=records).awaitTermination()

    weather_csv(landing / "a.csv", [weather_line(0, 9), weather_line(1, 2)])
    run()
    weather_csv(landing / "b.csv", [weather_line(1, 9), weather_line(2, 3)])
    run()
    run()
    assert sorted(tuple(x) for x in table.read().select("hour", "temp").collect()) == [(0, 1.5), (1, 2.0), (2, 3.0)]
    assert [(x.duplicates, x.inserted) for x in records] == [(1, 1), (1, 1)]
