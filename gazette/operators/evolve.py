"""Schema-evolving appends and field-presence profiles.

``evolving_union`` accepts new columns (old rows read NULL), widens numeric
types where that is lossless and refuses narrowing or incompatible changes,
as a table with schema evolution does.  ``append_evolving`` applies the same
rule to a Parquet table directory before appending.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import path_exists

_NUMERIC_RANK = {T.ByteType: 1, T.ShortType: 2, T.IntegerType: 3, T.LongType: 4,
                 T.FloatType: 5, T.DoubleType: 6}


class SchemaConflict(ValueError):
    pass


def _widen(a: T.DataType, b: T.DataType) -> T.DataType:
    if a == b:
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(b, T.NullType):
        return a
    ra, rb = _NUMERIC_RANK.get(type(a)), _NUMERIC_RANK.get(type(b))
    if ra and rb:
        # long -> float/double may lose precision; only allow int types -> double.
        hi = a if ra >= rb else b
        lo = b if hi is a else a
        if isinstance(hi, T.FloatType) and _NUMERIC_RANK[type(lo)] >= 3:
            raise SchemaConflict(f"cannot widen {lo.simpleString()} to float")
        return hi
    if isinstance(a, T.TimestampNTZType) and isinstance(b, T.DateType) or \
       isinstance(b, T.TimestampNTZType) and isinstance(a, T.DateType):
        return T.TimestampNTZType()
    raise SchemaConflict(f"incompatible types {a.simpleString()} vs {b.simpleString()}")


def merged_schema(existing: T.StructType, incoming: T.StructType) -> T.StructType:
    """Existing columns first (widened), then new columns in arrival order."""
    inc = {f.name.lower(): f for f in incoming.fields}
    out = []
    for f in existing.fields:
        g = inc.pop(f.name.lower(), None)
        dt = f.dataType if g is None else _widen(f.dataType, g.dataType)
        out.append(T.StructField(f.name, dt, True))
    for name, g in inc.items():
        out.append(T.StructField(g.name, g.dataType, True))
    return T.StructType(out)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    have = {c.lower(): c for c in df.columns}
    return df.select(*[
        (F.col(have[f.name.lower()]).cast(f.dataType) if f.name.lower() in have
         else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ])


def evolving_union(existing: DataFrame, *incoming: DataFrame) -> DataFrame:
    """Union by (case-insensitive) name with schema evolution and a type guard."""
    schema = reduce(lambda s, d: merged_schema(s, d.schema), incoming, existing.schema)
    parts = [conform(existing, schema)] + [conform(d, schema) for d in incoming]
    return reduce(lambda a, b: a.unionByName(b), parts)


def append_evolving(spark: SparkSession, df: DataFrame, path: str) -> T.StructType:
    """Append to a Parquet table, evolving its schema; returns the new schema.

    New columns are simply written (readers use ``mergeSchema``); a type
    change is checked against the stored schema first and refused if unsafe.
    """
    current = read_evolving(spark, path).schema if path_exists(spark, path) else None
    if current is not None:
        schema = merged_schema(current, df.schema)
        for f in current.fields:
            if schema[f.name].dataType != f.dataType:
                raise SchemaConflict(f"column {f.name} would change type "
                                     f"{f.dataType.simpleString()} -> {schema[f.name].dataType.simpleString()}")
        df = conform(df, T.StructType([g for g in schema.fields if g.name.lower() in
                                       {c.lower() for c in df.columns}]))
    df.write.mode("append").parquet(path)
    return spark.read.option("mergeSchema", "true").parquet(path).schema


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(path)


def field_presence(df: DataFrame, batch_col: str) -> DataFrame:
    """Per batch, the non-NULL count of every column, one pass, long format.

    Replaces DESCRIBE-before/after: a column added by schema evolution shows
    up with zero presence in old batches.
    """
    cols = [c for c in df.columns if c != batch_col]
    wide = df.groupBy(batch_col).agg(*[F.count(F.col(c)).alias(c) for c in cols])
    return wide.unpivot(batch_col, cols, "column_name", "non_null")


def evolved_breakdown(tracking: DataFrame) -> DataFrame:
    """Counts by the three evolved fields over rows that carry them."""
    return (tracking.where(F.col("consent_state").isNotNull())
            .groupBy("consent_state", "engagement_score", "ab_test_variant")
            .agg(F.count("*").alias("events")))
