"""Schema and value conformance: one projection per step, no row counts on the way."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from farebox.functions import convert
from farebox.functions.names import snake_case_all
from farebox.sources.descriptor import DatasetSpec, DateTimePair, TimestampParts


def _map_columns(df: DataFrame, changes: Mapping[str, Column]) -> DataFrame:
    """Replace the named columns in one projection."""
    known = {c: e for c, e in changes.items() if c in df.columns}
    return df.withColumns(known) if known else df


# -- names ----------------------------------------------------------------


def standardize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*snake_case_all(df.columns))


def prefix_columns(df: DataFrame, prefix: str) -> DataFrame:
    return df.toDF(*[prefix + c for c in df.columns])


# -- types ----------------------------------------------------------------


def cast_columns(df: DataFrame, types: Mapping[str, T.DataType]) -> DataFrame:
    """Cast the columns that are present; bad text becomes NULL."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    return _map_columns(
        df,
        {c: convert.to_type(F.col(c), t) for c, t in types.items() if c in actual and actual[c] != t},
    )


def cast_declared(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    return cast_columns(df, spec.columns)


def cast_failures(df: DataFrame, types: Mapping[str, T.DataType]) -> DataFrame:
    """Per column: values present, and values the cast would turn into NULL.

    One scan and one global aggregate, whatever the number of columns.
    """
    checked = {c: t for c, t in types.items() if c in df.columns}
    aggregates = []
    for c, t in checked.items():
        text = convert.blank_to_null(F.col(c).cast("string"))
        failed = text.isNotNull() & convert.to_type(F.col(c), t).isNull()
        aggregates += [F.count(text).alias(f"{c}|present"), F.count_if(failed).alias(f"{c}|failed")]
    counts = df.agg(*aggregates)
    entries = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(t.simpleString()).alias("declared_type"),
            F.col(f"`{c}|present`").alias("present"),
            F.col(f"`{c}|failed`").alias("failed"),
        )
        for c, t in checked.items()
    ]
    return counts.select(F.inline(F.array(*entries)))


def align_to(
    df: DataFrame, target: T.StructType, new_types: Mapping[str, T.DataType] | None = None
) -> DataFrame:
    """Give the columns shared with ``target`` its types, and new columns the types in ``new_types``."""
    types = {f.name: f.dataType for f in target.fields}
    types.update({c: t for c, t in (new_types or {}).items() if c not in types})
    return cast_columns(df, types)


def complete_columns(df: DataFrame, target: T.StructType) -> DataFrame:
    """Columns of ``target`` first (NULL where absent), then the columns only ``df`` has."""
    have = set(df.columns)
    kept = [F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in target.fields]
    added = [F.col(c) for c in df.columns if c not in set(target.names)]
    return df.select(*kept, *added)


def evolve_union(old: DataFrame, new: DataFrame) -> DataFrame:
    """Both frames by name; a column one side lacks reads NULL there."""
    return old.unionByName(new, allowMissingColumns=True)


# -- schema checks --------------------------------------------------------


@dataclass(frozen=True)
class Violation:
    kind: str
    """``missing``, ``extra`` or ``type``."""
    column: str
    expected: str | None
    actual: str | None


def schema_violations(actual: T.StructType, spec: DatasetSpec) -> list[Violation]:
    """All differences between a conformed schema and the descriptor."""
    declared = {c: t.simpleString() for c, t in spec.columns.items()}
    found = {f.name: f.dataType.simpleString() for f in actual.fields}
    return [
        *(Violation("missing", c, declared[c], None) for c in sorted(declared.keys() - found.keys())),
        *(Violation("extra", c, None, found[c]) for c in sorted(found.keys() - declared.keys())),
        *(
            Violation("type", c, declared[c], found[c])
            for c in sorted(declared.keys() & found.keys())
            if declared[c] != found[c]
        ),
    ]


class SchemaError(ValueError):
    def __init__(self, dataset: str, violations: list[Violation]):
        self.violations = violations
        found = "; ".join(f"{v.column} ({v.kind}; declared {v.expected}, found {v.actual})" for v in violations)
        super().__init__(f"{len(violations)} columns of {dataset} do not fit its descriptor: {found}")


def require_schema(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """``df`` unchanged, or one error that lists every violation."""
    violations = schema_violations(df.schema, spec)
    if violations:
        raise SchemaError(spec.name, violations)
    return df


@dataclass(frozen=True)
class ColumnChange:
    column: str
    change: str
    """``added``, ``removed`` or ``retyped``."""
    old_type: str | None
    new_type: str | None


def schema_diff(old: Mapping[str, str], new: Mapping[str, str]) -> list[ColumnChange]:
    """Column changes between two ``name -> type`` maps."""
    changes = [ColumnChange(c, "added", None, new[c]) for c in new if c not in old]
    changes += [ColumnChange(c, "removed", old[c], None) for c in old if c not in new]
    changes += [ColumnChange(c, "retyped", old[c], new[c]) for c in old if c in new and old[c] != new[c]]
    return sorted(changes, key=lambda ch: ch.column)


def column_types(schema: T.StructType) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in schema.fields}


def drift_report(old: DataFrame, new: DataFrame) -> DataFrame:
    """Changed columns between two frames and how many rows of the newer one fill them."""
    changes = schema_diff(column_types(old.schema), column_types(new.schema))
    spark = new.sparkSession
    if not changes:
        return spark.createDataFrame(
            [], "column_name string, change string, old_type string, new_type string, filled bigint"
        )
    counted = [F.count(ch.column) if ch.new_type else F.lit(0).cast("bigint") for ch in changes]
    counts = new.agg(F.count("*"), *[c.alias(f"c{i}") for i, c in enumerate(counted)])
    rows = [
        F.struct(
            F.lit(ch.column).alias("column_name"),
            F.lit(ch.change).alias("change"),
            F.lit(ch.old_type).cast("string").alias("old_type"),
            F.lit(ch.new_type).cast("string").alias("new_type"),
            F.col(f"c{i}").alias("filled"),
        )
        for i, ch in enumerate(changes)
    ]
    return counts.select(F.inline(F.array(*rows)))


def schema_fingerprint(schema: T.StructType) -> str:
    """Hash of the sorted column names and types; the same in every process."""
    text = ",".join(f"{c}:{t}" for c, t in sorted(column_types(schema).items()))
    return hashlib.sha256(text.encode()).hexdigest()


# -- values ---------------------------------------------------------------


def trim_strings(df: DataFrame) -> DataFrame:
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return _map_columns(df, {c: convert.blank_to_null(F.col(c)) for c in texts})


def pad_codes(df: DataFrame, widths: Mapping[str, int]) -> DataFrame:
    return _map_columns(df, {c: convert.zero_pad(F.col(c), w) for c, w in widths.items()})


def parse_timestamps(df: DataFrame, formats: Mapping[str, str]) -> DataFrame:
    """Parse text columns; a column that is already a timestamp stays."""
    types = column_types(df.schema)
    return _map_columns(
        df,
        {c: convert.parse_timestamp(F.col(c), f) for c, f in formats.items() if types.get(c) == "string"},
    )


def assemble_timestamp(df: DataFrame, parts: TimestampParts | None) -> DataFrame:
    if parts is None:
        return df

    def maybe(name: str | None) -> Column | None:
        return None if name is None else F.col(name)

    return df.withColumn(
        parts.output,
        convert.timestamp_from_parts(
            F.col(parts.year),
            F.col(parts.month),
            F.col(parts.day),
            maybe(parts.hour),
            maybe(parts.minute),
            maybe(parts.second),
        ),
    )


def combine_date_time(df: DataFrame, pairs: Iterable[DateTimePair]) -> DataFrame:
    made = {p.output: convert.timestamp_from_pair(F.col(p.date), F.col(p.time), p.format) for p in pairs}
    return df.withColumns(made) if made else df


def convert_booleans(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return _map_columns(df, {c: convert.to_boolean(F.col(c)) for c in columns})


def conform_text(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Steps that need the raw text: trimming, code widths and timestamp formats."""
    return parse_timestamps(pad_codes(trim_strings(df), spec.code_widths), spec.timestamp_formats)


def derive_values(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Steps on typed columns: assembled timestamps, date-time pairs and booleans."""
    df = assemble_timestamp(df, spec.parts)
    df = combine_date_time(df, spec.pairs)
    return convert_booleans(df, spec.booleans)
