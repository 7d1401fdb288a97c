"""Versioned tables: immutable files, and one small manifest per version.

A reader never sees a half-written state.  A writer adds files that nobody
reads yet and then publishes a manifest that names them; publishing is one
rename.  The pointer to the current state is the manifest with the highest
number.  A frame opened on a version keeps reading that version's files while
newer ones are published.  The last ``keep`` versions stay readable; what only
older ones name is removed.

``Versions`` holds the manifests, which are plain JSON dictionaries.
``BucketTable`` is a table cut into buckets on top of it: a version replaces
the buckets that a batch touches, each written once, as one file, and the
manifest maps every bucket to the version that wrote it.  Schemas are kept in
the manifest, so no reader opens footers to learn them.

There is one writer at a time (a stream's ``foreachBatch``).  Two writers that
race for a number cannot both win: the second one's rename fails.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Conflict(RuntimeError):
    """Another writer published this version first."""


class Versions:
    """Numbered manifests in one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, *parts: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join((self.root, *parts)))

    @property
    def _fs(self):
        return self._path("_versions").getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def numbers(self) -> list[int]:
        folder, fs = self._path("_versions"), self._fs
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and not n.startswith("."))

    def load(self, number: int | None = None) -> dict | None:
        """The manifest of a version, of the current one by default; None before the first."""
        if number is None:
            numbers = self.numbers()
            if not numbers:
                return None
            number = numbers[-1]
        file = self._fs.open(self._path("_versions", f"{number:012d}.json"))
        try:
            data = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(file, "UTF-8")
        finally:
            file.close()
        return json.loads(data) | {"version": number}

    def publish(self, number: int, manifest: dict) -> None:
        """Make ``manifest`` version ``number``: written aside, then renamed."""
        fs, target = self._fs, self._path("_versions", f"{number:012d}.json")
        aside = self._path("_versions", f".{uuid.uuid4().hex}")
        out = fs.create(aside, False)
        try:
            out.write(bytearray(json.dumps(manifest).encode()))
        finally:
            out.close()
        if fs.exists(target) or not fs.rename(aside, target):
            fs.delete(aside, False)
            raise Conflict(f"version {number} of {self.root} exists")

    def drop(self, numbers: list[int]) -> None:
        for n in numbers:
            self._fs.delete(self._path("_versions", f"{n:012d}.json"), False)


class BucketTable:
    """Rows cut into ``buckets`` by a hash; a version replaces whole buckets.

    ``keys`` are the columns that decide a row's bucket.  Files lie in
    ``state/_bucket=<b>/_v=<version>/``.
    """

    def __init__(self, spark: SparkSession, root: str, keys: list[str], buckets: int, keep: int = 2):
        self.spark, self.root, self.keys, self.buckets = spark, root.rstrip("/"), keys, buckets
        self.keep = max(1, keep)
        self.versions = Versions(spark, root)

    def bucket(self):
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def with_bucket(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("_bucket", self.bucket())

    def touched(self, rows: DataFrame) -> list[int]:
        """Buckets of some rows: at most ``buckets`` numbers."""
        return sorted(r[0] for r in rows.select(self.bucket().alias("b")).distinct().collect())

    def _folder(self, bucket: int, version: int) -> str:
        return f"{self.root}/state/_bucket={bucket}/_v={version}"

    def manifest(self, version: int | None = None) -> dict:
        found = self.versions.load(version)
        if found is None:
            return {"version": -1, "schema": None, "parts": {}, "note": {}}
        if found["buckets"] != self.buckets:
            raise ValueError(f"{self.root} has {found['buckets']} buckets, not {self.buckets}")
        return found

    def read(self, version: int | None = None, buckets: list[int] | None = None) -> DataFrame | None:
        """A version's rows (the current one's by default), of some buckets or of all; None before the first."""
        held = self.manifest(version)
        if held["schema"] is None:
            return None
        schema = T.StructType.fromJson(held["schema"])
        want = held["parts"] if buckets is None else {str(b): held["parts"][str(b)] for b in buckets
                                                      if str(b) in held["parts"]}
        if not want:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[self._folder(int(b), v) for b, v in want.items()])

    def replace(self, rows: DataFrame, touched: list[int], note: dict | None = None) -> int:
        """Publish a version in which the ``touched`` buckets hold exactly ``rows``.

        All other buckets stay.  ``note`` is merged into the manifest's notes.
        """
        held = self.manifest()
        number = held["version"] + 1
        parts = {b: v for b, v in held["parts"].items() if int(b) not in set(touched)}
        if touched:
            dealt = self.with_bucket(rows).withColumn("_v", F.lit(number)).repartition(len(touched), "_bucket")
            dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_bucket", "_v") \
                .parquet(f"{self.root}/state")
            fs = self.versions._fs
            parts |= {str(b): number for b in touched
                      if fs.exists(self.versions._path("state", f"_bucket={b}", f"_v={number}"))}
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema.fields])
        self.versions.publish(number, {"buckets": self.buckets, "schema": schema.jsonValue(), "parts": parts,
                                       "note": held["note"] | (note or {})})
        self._retire()
        return number

    def _retire(self) -> None:
        """Remove versions beyond the last ``keep``, and the files only they name."""
        numbers = self.versions.numbers()
        old, live = numbers[:-self.keep], numbers[-self.keep:]
        if not old:
            return
        named = {(b, v) for n in live for b, v in self.versions.load(n)["parts"].items()}
        gone = {(b, v) for n in old for b, v in self.versions.load(n)["parts"].items()} - named
        for b, v in sorted(gone):
            self.versions._fs.delete(self.versions._path("state", f"_bucket={b}", f"_v={v}"), True)
        self.versions.drop(old)

    def sizes(self, version: int | None = None) -> dict[int, int]:
        """Bytes of each bucket of a version."""
        fs = self.versions._fs
        return {int(b): fs.getContentSummary(self.versions._path("state", f"_bucket={b}", f"_v={v}")).getLength()
                for b, v in self.manifest(version)["parts"].items()}
