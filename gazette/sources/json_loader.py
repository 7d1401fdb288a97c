"""NDJSON and semi-structured loads.

* ``load_ndjson``: one JSON object per line into a fixed schema, abort on
  malformed input.  ``case_insensitive=True`` matches keys by lower-cased
  name (Spark's JSON reader matches keys case-sensitively): each line is
  parsed once into ``map<string,string>``, keys lower-cased, then every
  target column is looked up and cast with ANSI casts (bad values raise).
* ``load_variant``: schema-on-read load into one VARIANT column; a single
  known wrapper key is unwrapped.
* ``FileLedger``: which files were loaded, so re-running a directory-scoped
  load never ingests a file twice.  ``load_once`` is its short form for small
  folders, whose file names are handled as a list.

Gzip input is transparent; gzip files are not splittable, so callers that
read a few large ``.gz`` files repartition right after the read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import materialize, path_exists


def load_ndjson(spark: SparkSession, paths, schema: StructType, case_insensitive: bool = True,
                fail_fast: bool = True, path_glob: str | None = None) -> DataFrame:
    paths = [paths] if isinstance(paths, str) else list(paths)
    if not case_insensitive:
        r = spark.read.schema(schema).option("mode", "FAILFAST" if fail_fast else "PERMISSIVE")
        if path_glob:
            r = r.option("pathGlobFilter", path_glob)
        return r.json(paths)
    r = spark.read
    if path_glob:
        r = r.option("pathGlobFilter", path_glob)
    return parse_lines(r.text(paths), schema, fail_fast)


def parse_lines(lines: DataFrame, schema: StructType, fail_fast: bool = True,
                col: str = "value") -> DataFrame:
    """Parse a frame of JSON text lines into ``schema``, keys matched case-insensitively."""
    return key_map(lines, col, fail_fast).select(*[
        F.col("_kv")[f.name.lower()].cast(f.dataType).alias(f.name) for f in schema.fields
    ])


def key_map(lines: DataFrame, col: str = "value", fail_fast: bool = True) -> DataFrame:
    """``_kv``: each JSON object as a map from lower-cased key to the value's text; blank lines go."""
    lines = lines.where(F.length(F.trim(col)) > 0)
    opts = {"mode": "FAILFAST"} if fail_fast else {}
    kv = F.transform_keys(F.from_json(col, "map<string,string>", opts), lambda k, v: F.lower(k))
    return lines.select(kv.alias("_kv"))


def load_variant(spark: SparkSession, paths, column: str = "raw_event",
                 unwrap_key: str | None = None) -> DataFrame:
    """Each line -> one VARIANT value; optionally unwrap ``{"<key>": {...}}``.

    A malformed line aborts the load.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    df = spark.read.format("json").option("singleVariantColumn", column).option("mode", "FAILFAST").load(paths)
    if unwrap_key:
        inner = F.try_variant_get(F.col(column), f"$.{unwrap_key}", "variant")
        df = df.select(F.coalesce(inner, F.col(column)).alias(column))
    return df


def new_files(spark: SparkSession, files: DataFrame, ledger_path: str) -> DataFrame:
    """Files (column ``_source_file``) not yet recorded in the ledger."""
    if not path_exists(spark, ledger_path):  # first run; an unreadable ledger raises
        return files
    seen = spark.read.parquet(ledger_path)
    return files.join(seen, "_source_file", "left_anti")


def record_files(files: DataFrame, ledger_path: str) -> None:
    files.select("_source_file").distinct().write.mode("append").parquet(ledger_path)


def pending_files(spark: SparkSession, paths, ledger_path: str) -> list[str]:
    """Files under ``paths`` not yet in the ledger (a file listing, not a data scan)."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    found = []
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        fs = hp.getFileSystem(conf)
        it = fs.listFiles(hp, True)
        while it.hasNext():
            st = it.next()
            name = st.getPath().getName()
            if not name.startswith(("_", ".")):
                found.append(st.getPath().toString())
    if not found:
        return []
    listing = spark.createDataFrame([(f,) for f in found], "_source_file string")
    return sorted(r[0] for r in new_files(spark, listing, ledger_path).collect())


def load_once(spark: SparkSession, paths, schema: StructType, ledger_path: str,
              case_insensitive: bool = True) -> tuple[DataFrame, list[str]]:
    """Directory-scoped idempotent load: only files absent from the ledger.

    Returns ``(rows, files)``; once the rows are written, the caller records
    the files with :func:`record_file_list` so a re-run skips them.
    """
    fresh = pending_files(spark, paths, ledger_path)
    if not fresh:
        return spark.createDataFrame([], schema), []
    return load_ndjson(spark, fresh, schema, case_insensitive), fresh


def record_file_list(spark: SparkSession, files: list[str], ledger_path: str) -> None:
    if files:
        record_files(spark.createDataFrame([(f,) for f in files], "_source_file string"), ledger_path)


class FileLedger:
    """Which files of landing folders were loaded, compared and kept in Spark.

    The listing is a scan of file metadata: no file is opened, and no file names
    come to the driver's Python.  New files are those that the ledger lacks
    (anti-join).  Their lines are read by one scan of the folder: a bound on the
    modification time, the oldest of the new files, prunes older files before
    they are opened, and a semi-join keeps exactly the new ones.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _reader(self, fmt: str, glob: str | None):
        r = self.spark.read.format(fmt).option("recursiveFileLookup", "true")
        return r.option("pathGlobFilter", glob) if glob else r

    def pending(self, folder: str, glob: str | None = None) -> DataFrame:
        """``(_source_file, _modified)`` of the files under ``folder`` not loaded yet, as a written table."""
        found = self._reader("binaryFile", glob).load(folder).select(
            F.col("_metadata.file_path").alias("_source_file"), F.col("_metadata.file_modification_time").alias("_modified"))
        return materialize(new_files(self.spark, found, self.path), "pending-files")

    def lines(self, folder: str, pending: DataFrame, glob: str | None = None) -> DataFrame | None:
        """``(value, _source_file)`` of all lines of the pending files; None if there are none."""
        oldest = pending.agg(F.min("_modified")).first()[0]
        if oldest is None:
            return None
        rows = self._reader("text", glob).load(folder).where(F.col("_metadata.file_modification_time") >= F.lit(oldest))
        return (rows.select("value", F.col("_metadata.file_path").alias("_source_file"))
                .join(pending.select("_source_file"), "_source_file", "left_semi").select("value", "_source_file"))

    def record(self, pending: DataFrame) -> None:
        """Note the files as loaded; called once their rows are written."""
        record_files(pending, self.path)


def infer_schema(spark: SparkSession, paths, sampling_ratio: float = 1.0) -> StructType:
    """JSON schema inference with lower-cased, de-duplicated field names.

    Inference is a pass over the input; on very large landing folders declare
    the schema instead.  With ``sampling_ratio`` < 1 fields of unsampled lines
    would be lost.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    inferred = spark.read.option("samplingRatio", sampling_ratio).json(paths).schema
    seen, fields = set(), []
    for f in inferred.fields:
        n = f.name.lower()
        if n not in seen:
            seen.add(n)
            fields.append(type(f)(n, f.dataType, True))
    return StructType(fields)
