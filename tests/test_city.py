"""The whole way of a city installation: six raw files, first build, three update files, refresh."""

from dataclasses import replace

from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.operators import summaries as s
from farebox.operators.rowsets import frames_equal
from farebox.plans import ingest, products, refresh, updates
from farebox.sources import city
from farebox.sources.scratch import scratch_path


def trip_file(spark, path, rows):
    """Trips (pickup, zone, distance, fare) as a raw file with the published names."""
    df = spark.createDataFrame(rows, "t string, z bigint, d double, f double")
    made = {
        "tpep_pickup_datetime": F.col("t").cast("timestamp"),
        "tpep_dropoff_datetime": F.col("t").cast("timestamp") + F.expr("INTERVAL 7 MINUTES"),
        "trip_distance": F.col("d"),
        "fare_amount": F.col("f"),
        "PULocationID": F.col("z").cast("int"),
        "DOLocationID": F.lit(2),
        "store_and_fwd_flag": F.lit("Y"),
    }
    types = city.TRIP_COLUMNS | {"airport_fee": "double"}
    renamed = {"airport_fee": "Airport_fee"}
    df.select(
        *[
            made.get(c, F.lit(1).cast("string" if t == "string" else t)).alias(renamed.get(c, c))
            for c, t in types.items()
        ]
    ).write.parquet(str(path))


def csv_file(path, columns, rows):
    lines = [",".join(columns)]
    lines += [",".join(str(row.get(c, "")) for c in columns) for row in rows]
    path.write_text("\n".join(lines) + "\n")


def weather_row(day, hour, prcp, **more):
    return {"year": 2024, "month": 1, "day": day, "hour": hour, "temp": 3.5, "prcp": prcp, **more}


def air_row(site, day, hour, value, county="Queens", state="36", **more):
    key = {"State Code": state, "County Code": 81, "Site Num": site, "Parameter Code": 88101, "POC": 1}
    time = {"Date Local": f"2024-01-{day:02d}", "Time Local": f"{hour:02d}:00"}
    return key | time | {"Sample Measurement": value, "County Name": county, **more}


def test_city(spark, tmp_path):
    specs = city.city_specs(str(tmp_path))
    by_name = {x.name: x for x in specs}
    for month, rows in {
        "01": [("2024-01-01 08:30:00", 1, 2.5, 10.0), ("2024-01-01 08:30:00", 1, 2.5, 10.0)],
        "02": [("2024-01-02 08:30:00", 1, None, 30.0), ("2024-01-02 09:10:00", 3, 1.25, None)],
        "03": [("2024-01-03 08:30:00", 2, 4.0, 12.0)],
    }.items():
        trip_file(spark, by_name[f"taxi_trips_{month}"].path, rows)
    weather = by_name["weather"]
    csv_file(tmp_path / "weather.csv", weather.raw_names, [weather_row(1, 8, 0.0), weather_row(2, 8, 1.5)])
    csv_file(
        tmp_path / "taxi_zone_lookup.csv",
        city.ZONE_COLUMNS,
        [{"LocationID": i, "Borough": b, "Zone": f"Z{i}"} for i, b in ((1, "Queens"), (2, "Bronx"))],
    )
    csv_file(
        tmp_path / "air_quality.csv",
        city.AIR_COLUMNS,
        [air_row(1, 1, 8, 4.0), air_row(2, 1, 8, 6.0), air_row(3, 1, 8, 99.0, state="34")],
    )

    catalog = refresh.Catalog(spark, scratch_path(spark, "city"))
    log = ingest.ingest_all(spark, specs, lambda name: catalog.table(city.TABLE_OF[name]))
    assert [(x.dataset, x.rejected_records) for x in log if x.rejected_records] == [("taxi_trips_01", 1)]
    trips = catalog.table("trips")
    assert trips.version() == 2 and trips.read().count() == 4
    assert trips.read().select("store_and_fwd_flag").distinct().first()[0] is True
    refresh.refresh(catalog)
    wide = {x["tpep_pickup_datetime"].strftime("%d %H"): x for x in catalog.integrated.read().collect()}
    assert wide["01 08"]["air_q_sample_measurement"] == 5.0 and wide["01 08"]["weather_prcp"] == 0.0
    assert wide["02 09"]["pu_borough"] is None and not wide["02 09"]["weather_matched"]

    # updates: weather with a new column, air quality with a new column, trips with copies of old ones
    csv_file(
        tmp_path / "weather_update.csv",
        [*weather.raw_names, "humidity"],
        [weather_row(2, 8, 9.9, humidity=1), weather_row(2, 9, 0.0, humidity=55.5), weather_row(3, 8, 2.0, humidity=60)],
    )
    csv_file(
        tmp_path / "air_update.csv",
        [*city.AIR_COLUMNS, "aqi"],
        [air_row(1, 2, 8, 8.0, aqi=32), air_row(1, 2, 8, 8.0, aqi=32), air_row(1, 1, 8, 7.0, aqi=28)],
    )
    trip_file(
        spark,
        tmp_path / "trips_update",
        [("2024-01-02 08:30:00", 1, None, 30.0), ("2024-02-01 08:30:00", 1, 3.0, 9.0)],
    )
    read = spark.read.option("header", "true").csv
    records = [
        updates.load_update(
            catalog.table("weather"), read(str(tmp_path / "weather_update.csv")), weather, {"humidity": T.DoubleType()}
        ),
        updates.load_update(
            catalog.table("air_quality"),
            read(str(tmp_path / "air_update.csv")),
            by_name["air_quality"],
            {"aqi": T.IntegerType()},
        ),
        updates.load_update(
            trips,
            spark.read.parquet(str(tmp_path / "trips_update")),
            replace(by_name["taxi_trips_03"], name="trips"),
            event_time="tpep_pickup_datetime",
        ),
    ]
    got = [(x.dataset, x.rows_in_update, x.duplicates, x.inserted, x.schema_change) for x in records]
    assert got == [
        ("weather", 3, 1, 2, "+humidity"),
        ("air_quality", 3, 2, 1, "+aqi"),
        ("trips", 2, 1, 1, ""),
    ]
    assert sorted(refresh.refresh(catalog)) == sorted(products.PRODUCTS)
    wide = {x["tpep_pickup_datetime"].strftime("%m-%d %H"): x for x in catalog.integrated.read().collect()}
    assert len(wide) == 5
    assert wide["01-02 09"]["weather_humidity"] == 55.5 and wide["01-03 08"]["weather_prcp"] == 2.0
    assert wide["01-02 08"]["air_q_sample_measurement"] == 8.0
    for name, spec in products.PRODUCTS.items():
        stored = products.read_product(catalog.product(name), spec).drop(*products.PROVENANCE)
        assert frames_equal(stored, products.build_product(catalog.integrated.read(), spec)), name

    # the product answers the direct query
    statistics = products.read_product(catalog.product("taxi_zone_statistics"), products.ZONE_STATISTICS)
    direct = s.zone_monthly_demand(catalog.integrated.read()).withColumnRenamed("count", "taxi_demand")
    assert frames_equal(s.product_zone_demand(statistics), direct)
    trend = s.product_monthly_trend(statistics)
    assert frames_equal(trend, s.monthly_trend(catalog.integrated.read()))
