"""RAW table of JSON lines whose schema is a committed log.

Declared columns are stored with their types.  Fields that turn up later are
*open*: they are stored as the text of the line, and the log keeps what their
values have been so far, so nothing is lost while their type is not settled:

* numbers: digits before and after the point, whether all fitted a long, and
  whether a double holds all whole ones exactly.  Readers get the narrowest
  type that is exact: BIGINT; DOUBLE once fractions appear; DECIMAL when whole
  numbers are in the way that a double would round; text beyond 38 digits;
* texts, flags (BOOLEAN) and nested values (VARIANT).

A field never changes between those kinds, and declared columns never change
type: such a batch is refused before anything is written, and the table stays
as it was.  A field that has only been NULL adds no column yet.

The log is one small file per schema change (``_schema/_versions``), published
before the rows that need it: every row that can be read fits the schema.  A
batch costs one pass for the schema of its own lines and one to write them,
whatever the table's history; readers take the schema from the log, so no
footers are opened and no schemas merged.  A batch's rows are one partition
``(_source, _batch)``, so a replayed batch overwrites itself.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.evolve import SchemaConflict
from ..session import path_exists
from .json_loader import key_map
from .versions import Versions

_EXACT = 1 << 53                 # whole numbers up to here are exact in a double
_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _kind(dtype: T.DataType) -> str | None:
    if isinstance(dtype, T.NullType):
        return None
    if isinstance(dtype, _NUMBERS):
        return "number"
    if isinstance(dtype, T.BooleanType):
        return "flag"
    return "text" if isinstance(dtype, T.StringType) else "nested"


def line_kinds(lines: DataFrame, col: str = "value") -> dict[str, str]:
    """Kind of each field of some JSON objects, one per line, names lower-cased; one pass.

    A field with values of two kinds is an error, as is a line that is no object.
    """
    found = lines.where(F.length(F.trim(col)) > 0).agg(F.schema_of_variant_agg(F.parse_json(col))).first()[0]
    if found is None or found == "VOID":
        return {}
    if not found.startswith("OBJECT<"):
        raise SchemaConflict(f"lines hold {found}, not objects")
    mixed = "MIXED_VALUES"  # VARIANT stands for values of different types
    ddl = re.sub(r"\bOBJECT<", "STRUCT<", found)
    kinds: dict[str, str] = {}
    for f in T.DataType.fromDDL(ddl).fields:
        kind = mixed if isinstance(f.dataType, T.VariantType) else _kind(f.dataType)
        name = f.name.lower()
        if kind is None:
            continue
        if kind == mixed or kinds.get(name, kind) != kind:
            raise SchemaConflict(f"field {name} has values of different kinds in one batch")
        kinds[name] = kind
    return kinds


def number_facts(rows: DataFrame, names: list[str], keys: str = "_kv") -> dict[str, dict]:
    """What the number texts of some fields look like; one pass for all fields."""
    if not names:
        return {}
    aggs = []
    for n in names:
        text = F.col(keys)[n]
        whole = F.length(F.regexp_extract(text, r"^-?(\d+)", 1))
        fraction = F.length(F.regexp_extract(text, r"\.(\d+)", 1))
        free = fraction.eqNullSafe(F.lit(0)) & ~text.rlike("[eE]")
        held = F.abs(text.try_cast("decimal(38,0)"))
        aggs.append(F.struct(
            F.max(whole).alias("whole"), F.max(fraction).alias("fraction"),
            F.coalesce(F.bool_or(text.rlike("[eE]")), F.lit(False)).alias("exponent"),
            F.coalesce(F.bool_and(F.when(free, text.try_cast("bigint").isNotNull())), F.lit(True)).alias("long"),
            F.coalesce(F.bool_and(F.when(free, F.coalesce(held <= _EXACT, F.lit(False))).otherwise(whole <= 15)),
                       F.lit(True)).alias("double")).alias(f"`{n}`"))
    got = rows.agg(*aggs).first()
    return {n: got[i].asDict() for i, n in enumerate(names)}


def merged_facts(a: dict | None, b: dict) -> dict:
    if a is None:
        return b
    return {"whole": max(a["whole"], b["whole"]), "fraction": max(a["fraction"], b["fraction"]),
            "exponent": a["exponent"] or b["exponent"], "long": a["long"] and b["long"],
            "double": a["double"] and b["double"]}


def number_type(facts: dict) -> str:
    """The narrowest type that holds every number seen, exactly as a reader of JSON would take it."""
    whole, fraction = facts["whole"], facts["fraction"]
    if not fraction and not facts["exponent"]:
        return "bigint" if facts["long"] else "decimal(38,0)" if whole <= 38 else "string"
    if facts["double"]:
        return "double"
    if not facts["exponent"] and whole + fraction <= 38:
        return f"decimal({whole + fraction},{fraction})"
    return "string"


class RawTable:
    """Append-only table of JSON lines with a schema log."""

    def __init__(self, spark: SparkSession, path: str, declared: T.StructType):
        self.spark, self.path, self.declared = spark, path.rstrip("/"), declared
        self.log = Versions(spark, f"{self.path}/_schema")

    def fields(self) -> list[dict]:
        """Open fields of the committed schema, in the order they came."""
        held = self.log.load()
        return held["open"] if held else []

    def stored(self, fields: list[dict]) -> T.StructType:
        return T.StructType(self.declared.fields + [T.StructField(f["name"], T.StringType()) for f in fields])

    def _evolved(self, kinds: dict[str, str], facts: dict[str, dict]) -> list[dict]:
        """The open fields after a batch; raises on a change of kind or of a declared type."""
        own = {f.name.lower(): f for f in self.declared.fields}
        for name, kind in kinds.items():
            if name not in own:
                continue
            dtype = own[name].dataType
            wants = _kind(dtype)
            if wants == "text":
                continue  # any value has a text
            fits = kind == wants or (kind == "text" and isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)))
            if fits and isinstance(dtype, _WHOLE):
                fits = number_type(facts[name]) == "bigint"
            if not fits:
                raise SchemaConflict(f"column {name} is {dtype.simpleString()} and gets values of another type ({kind})")
        out = [dict(f) for f in self.fields()]
        have = {f["name"]: f for f in out}
        for name, kind in kinds.items():
            if name in own:
                continue
            f = have.get(name)
            if f is None:
                out.append(f := {"name": name, "kind": kind, "numbers": None})
            if f["kind"] != kind:
                raise SchemaConflict(f"field {name} held values of kind {f['kind']} and gets {kind}")
            if kind == "number":
                f["numbers"] = merged_facts(f["numbers"], facts[name])
        return out

    def append(self, lines: DataFrame, source: str, batch: int, col: str = "value") -> None:
        """Write one batch of lines as partition ``(source, batch)``, evolving the schema first."""
        kinds = line_kinds(lines, col)
        rows = key_map(lines, col)
        fields = self._evolved(kinds, number_facts(rows, [n for n, k in kinds.items() if k == "number"]))
        held = self.log.load()
        if held is None or held["open"] != fields:
            self.log.publish(held["version"] + 1 if held else 0, {"open": fields, "since": [source, int(batch)]})
        rows = rows.select(*[F.col("_kv")[f.name.lower()].cast(f.dataType).alias(f.name)
                             for f in self.stored(fields).fields])
        (rows.withColumn("_source", F.lit(source)).withColumn("_batch", F.lit(int(batch)))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("_source", "_batch").parquet(self.path))

    def read(self) -> DataFrame:
        """All rows, open fields typed by the committed schema."""
        fields = self.fields()
        parts = [T.StructField("_source", T.StringType()), T.StructField("_batch", T.IntegerType())]
        schema = T.StructType(self.stored(fields).fields + parts)
        if not self.log.numbers() or not path_exists(self.spark, self.path):
            rows = self.spark.createDataFrame([], schema)
        else:
            rows = self.spark.read.schema(schema).parquet(self.path)

        def typed(f: dict):
            text = F.col(f["name"])
            if f["kind"] == "number":
                return text.cast(number_type(f["numbers"]))
            return {"flag": text.cast("boolean"), "nested": F.parse_json(text)}.get(f["kind"], text)

        return rows.select(*[F.col(f.name) for f in self.declared.fields], *[typed(f).alias(f["name"]) for f in fields])
