"""Dataset descriptors: what a raw file looks like and how to conform it."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from pathlib import Path
from typing import Any

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from farebox.functions.names import snake_case_all, to_snake_case
from farebox.sources.scratch import read_text

# Type words a descriptor may use.
TYPE_WORDS: dict[str, T.DataType] = {
    "integer": T.IntegerType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "bigint": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "bool": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
}


def parse_type(word: str) -> T.DataType:
    """Spark type for a type word; an unknown word is an error, not a string column."""
    try:
        return TYPE_WORDS[word.strip().lower()]
    except KeyError:
        raise ValueError(f"unknown type {word!r}; use one of {sorted(TYPE_WORDS)}") from None


@dataclass(frozen=True)
class TimestampParts:
    """Columns holding the parts of one timestamp."""

    year: str
    month: str
    day: str
    output: str
    hour: str | None = None
    minute: str | None = None
    second: str | None = None


@dataclass(frozen=True)
class DateTimePair:
    date: str
    time: str
    output: str
    format: str


@dataclass(frozen=True)
class DatasetSpec:
    """One dataset. All column names are held in snake case."""

    name: str
    format: str
    path: str
    columns: Mapping[str, T.DataType]
    raw_names: tuple[str, ...] = ()
    primary_keys: tuple[str, ...] = ()
    options: Mapping[str, str] = field(default_factory=dict)
    timestamp_formats: Mapping[str, str] = field(default_factory=dict)
    parts: TimestampParts | None = None
    pairs: tuple[DateTimePair, ...] = ()
    booleans: tuple[str, ...] = ()
    code_widths: Mapping[str, int] = field(default_factory=dict)

    @classmethod
    def from_dict(cls, name: str, conf: Mapping[str, Any]) -> DatasetSpec:
        """Descriptor from its JSON form."""
        declared = conf.get("schema") or {}
        snake = snake_case_all(declared)
        parts = conf.get("assembled_timestamp")
        return cls(
            name=name,
            format=conf["format"],
            path=conf["path"],
            columns={n: parse_type(word) for n, word in zip(snake, declared.values())},
            raw_names=tuple(declared),
            primary_keys=tuple(to_snake_case(k) for k in conf.get("primary_keys") or ()),
            options=dict(conf.get("options") or {}),
            timestamp_formats={to_snake_case(c): f for c, f in (conf.get("timestamp_cols") or {}).items()},
            parts=TimestampParts(
                **{
                    part: to_snake_case(parts[f"{part}_col"])
                    for part in ("year", "month", "day", "hour", "minute", "second", "output")
                    if parts.get(f"{part}_col")
                }
            )
            if parts
            else None,
            pairs=tuple(
                DateTimePair(
                    date=to_snake_case(p["date_col"]),
                    time=to_snake_case(p["time_col"]),
                    output=to_snake_case(p["output_col"]),
                    format=p["format"],
                )
                for p in conf.get("date_time_pairs") or ()
            ),
            booleans=tuple(to_snake_case(c) for c in conf.get("bool_cols") or ()),
            code_widths={to_snake_case(c): int(w) for c, w in (conf.get("code_widths") or {}).items()},
        )

    def struct(self, extra: Mapping[str, T.DataType] | None = None) -> T.StructType:
        """Declared schema, optionally with columns an update adds; everything is nullable."""
        fields = {**self.columns, **(extra or {})}
        return T.StructType([T.StructField(n, t, True) for n, t in fields.items()])

    def at(self, path: str) -> DatasetSpec:
        return replace(self, path=path)


def load_specs(path: str, spark: SparkSession | None = None) -> dict[str, DatasetSpec]:
    """All descriptors of a JSON file, by dataset name; with a session the file may lie in any storage it reads."""
    text = read_text(spark, path) if spark else Path(path).read_text(encoding="utf-8")
    return {name: DatasetSpec.from_dict(name, conf) for name, conf in json.loads(text).items()}
