"""Stores whose months were written under different schemas, read as one table under a declared schema.

A month of a store is written by one job, so it has one schema; months differ
when a column was added or its type widened later on.  The scan gives each
file's missing columns the declared default while it reads (a null that was
stored stays null) and widens the stored type, both inside the Parquet reader:
no month is rewritten, no plan per version, and date filters still prune.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlake.sources.feeds import read_store

# stored type -> declared types that the Parquet reader widens it to without loss
WIDENS = {
    "tinyint": ("smallint", "int", "bigint", "double"),
    "smallint": ("int", "bigint", "double"),
    "int": ("bigint", "double"),
    "float": ("double",),
    "date": ("timestamp_ntz",),
}
DRIFT_SCHEMA = T.StructType([
    T.StructField("snapshot_date", T.DateType()), T.StructField("column_name", T.StringType()),
    T.StructField("stored_type", T.StringType()), T.StructField("declared_type", T.StringType()),
    T.StructField("state", T.StringType())])


class IncompatibleSchema(ValueError):
    pass


def _literal(value) -> str:
    """SQL text of a default."""
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, (int, float)):
        return repr(value)
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def with_defaults(schema: T.StructType, defaults: dict[str, object]) -> T.StructType:
    """``schema`` whose fields carry the value that files without the column read as (none given: null)."""
    unknown = sorted(set(defaults) - set(schema.names))
    if unknown:
        raise ValueError(f"defaults for columns that the schema lacks: {unknown}")
    fields = []
    for f in schema.fields:
        text = _literal(defaults[f.name]) if defaults.get(f.name) is not None else None
        marks = {"CURRENT_DEFAULT": text, "EXISTS_DEFAULT": text} if text else {}
        fields.append(T.StructField(f.name, f.dataType, f.nullable, {**(f.metadata or {}), **marks}))
    return T.StructType(fields)


def column_state(stored: str | None, declared: str | None) -> str:
    """same, added (declared, not in the file), extra (in the file, not declared), widened or incompatible."""
    if stored is None or declared is None:
        return "added" if stored is None else "extra"
    if stored == declared:
        return "same"
    decimals = [re.fullmatch(r"decimal\((\d+),(\d+)\)", t) for t in (stored, declared)]
    if all(decimals):
        (p, s), (q, t) = [tuple(map(int, d.groups())) for d in decimals]
        return "widened" if t >= s and q - t >= p - s else "incompatible"
    return "widened" if declared in WIDENS.get(stored, ()) else "incompatible"


def schema_drift(spark: SparkSession, path: str, schema: T.StructType, date_col: str = "Snapshot_Date") -> DataFrame:
    """One row per month and column whose stored form differs from the declared one: (snapshot_date, column_name,
    stored_type, declared_type, state), states as in ``column_state``.

    One footer a month is read, that of its first file by name: the work grows with the months, not with their rows.
    A store without months gives no rows.
    """
    months = (spark.read.schema(T.StructType([schema[date_col]])).parquet(path)
              .groupBy(date_col).agg(F.min("_metadata.file_path").alias("file")).where(F.col(date_col).isNotNull()))
    declared = {f.name: f.dataType.simpleString() for f in schema.fields if f.name != date_col}
    rows = []
    for month in months.orderBy(date_col).collect():    # one small row per month
        stored = {f.name: f.dataType.simpleString() for f in spark.read.parquet(month["file"]).schema.fields
                  if f.name != date_col}
        for name in [*declared, *[c for c in stored if c not in declared]]:
            state = column_state(stored.get(name), declared.get(name))
            if state != "same":
                rows.append((month[date_col], name, stored.get(name), declared.get(name), state))
    return spark.createDataFrame(rows, DRIFT_SCHEMA)


def read_evolved(spark: SparkSession, path: str, schema: T.StructType, defaults: dict[str, object] | None = None,
                 check: bool = True) -> DataFrame:
    """The whole store under ``schema``: columns a month lacks have their default, narrower ones are widened, those
    not declared are left out.  With ``check`` a month that cannot be read so raises ``IncompatibleSchema`` with its
    columns before any row is read."""
    if check:
        bad = schema_drift(spark, path, schema).where("state = 'incompatible'").collect()
        if bad:
            raise IncompatibleSchema("; ".join(
                f"{r.snapshot_date} {r.column_name}: {r.stored_type} stored, {r.declared_type} declared" for r in bad))
    return read_store(spark, path, schema=with_defaults(schema, defaults or {}))
