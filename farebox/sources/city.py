"""Descriptors of the six city datasets.

Fixed values: names, types and keys of the published files.
"""

from __future__ import annotations

from farebox.sources.descriptor import DatasetSpec

_CSV = {"header": "true"}

# Ten hourly measures, each with the name of its source.
WEATHER_MEASURES = ("temp", "rhum", "prcp", "snwd", "wdir", "wspd", "wpgt", "pres", "cldc", "coco")

TRIP_COLUMNS = {
    "VendorID": "long",
    "tpep_pickup_datetime": "timestamp",
    "tpep_dropoff_datetime": "timestamp",
    "passenger_count": "double",
    "trip_distance": "double",
    "RatecodeID": "double",
    "store_and_fwd_flag": "string",
    "PULocationID": "long",
    "DOLocationID": "long",
    "payment_type": "long",
    "fare_amount": "double",
    "extra": "double",
    "mta_tax": "double",
    "tip_amount": "double",
    "tolls_amount": "double",
    "improvement_surcharge": "double",
    "total_amount": "double",
    "congestion_surcharge": "double",
    "airport_fee": "double",
}

ZONE_COLUMNS = {"LocationID": "integer", "Borough": "string", "Zone": "string", "service_zone": "string"}

AIR_COLUMNS = {
    "State Code": "string",
    "County Code": "string",
    "Site Num": "string",
    "Parameter Code": "string",
    "POC": "integer",
    "Latitude": "double",
    "Longitude": "double",
    "Datum": "string",
    "Parameter Name": "string",
    "Date Local": "string",
    "Time Local": "string",
    "Date GMT": "string",
    "Time GMT": "string",
    "Sample Measurement": "double",
    "Units of Measure": "string",
    "MDL": "double",
    "Uncertainty": "double",
    "Qualifier": "string",
    "Method Type": "string",
    "Method Code": "string",
    "Method Name": "string",
    "State Name": "string",
    "County Name": "string",
    "Date of Last Change": "string",
}

AIR_KEY = ("state_code", "county_code", "site_num", "parameter_code", "poc", "date_local", "time_local")


def weather_spec(path: str = "datasets/weather.csv") -> DatasetSpec:
    key = ("year", "month", "day", "hour")
    schema = dict.fromkeys(key, "integer")
    for measure in WEATHER_MEASURES:
        schema |= {measure: "double", f"{measure}_source": "string"}
    return DatasetSpec.from_dict(
        "weather",
        {
            "format": "csv",
            "path": path,
            "options": _CSV,
            "primary_keys": key,
            "assembled_timestamp": {**{f"{k}_col": k for k in key}, "output_col": "timestamp"},
            "schema": schema,
        },
    )


def trips_spec(path: str = "datasets/yellow_tripdata_2024-01.parquet", name: str = "taxi_trips_01") -> DatasetSpec:
    return DatasetSpec.from_dict(
        name,
        {
            "format": "parquet",
            "path": path,
            "timestamp_cols": dict.fromkeys(
                ("tpep_pickup_datetime", "tpep_dropoff_datetime"), "yyyy-MM-dd HH:mm:ss"
            ),
            "bool_cols": ["store_and_fwd_flag"],
            "schema": TRIP_COLUMNS,
        },
    )


def zones_spec(path: str = "datasets/taxi_zone_lookup.csv") -> DatasetSpec:
    return DatasetSpec.from_dict(
        "taxi_zone_lookup",
        {"format": "csv", "path": path, "options": _CSV, "primary_keys": ["location_id"], "schema": ZONE_COLUMNS},
    )


def air_quality_spec(path: str = "datasets/air_quality.csv") -> DatasetSpec:
    return DatasetSpec.from_dict(
        "air_quality",
        {
            "format": "csv",
            "path": path,
            "options": _CSV,
            "primary_keys": AIR_KEY,
            "date_time_pairs": [
                {
                    "date_col": "date_local",
                    "time_col": "time_local",
                    "output_col": "datetime_local",
                    "format": "yyyy-MM-dd HH:mm",
                }
            ],
            "code_widths": {"state_code": 2, "county_code": 3, "site_num": 4},
            "schema": AIR_COLUMNS,
        },
    )


MONTHS = ("01", "02", "03")

# Which managed table a dataset is loaded into; the months are batches of one table.
TABLE_OF = {
    "weather": "weather",
    "taxi_zone_lookup": "zones",
    "air_quality": "air_quality",
    **{f"taxi_trips_{month}": "trips" for month in MONTHS},
}


def city_specs(root: str = "datasets") -> list[DatasetSpec]:
    return [
        weather_spec(f"{root}/weather.csv"),
        *[trips_spec(f"{root}/yellow_tripdata_2024-{m}.parquet", f"taxi_trips_{m}") for m in MONTHS],
        zones_spec(f"{root}/taxi_zone_lookup.csv"),
        air_quality_spec(f"{root}/air_quality.csv"),
    ]
