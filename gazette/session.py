"""Spark session defaults and shared-storage locations.

Every job in the library assumes:

* session time zone UTC (timestamps in the data are wall-clock, NTZ),
* ANSI mode on (division by zero raises, so ratios use ``nullif``),
* adaptive execution on, so join strategy, shuffle partition counts and
  skewed partitions are re-planned from runtime statistics.

Scratch data (staged files, stream checkpoints, lineage cuts) always goes
under ``spark.checkpoint.dir``, the shared folder a cluster names.  Only when
that setting is absent (unit tests, a laptop) do we point it at a local
temporary folder.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# Session settings every job relies on.  Sizes are per-partition targets and
# stay valid from a laptop to a large cluster: AQE coalesces small partitions
# and splits skewed ones at runtime.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Broadcast decisions: at planning time only for inputs whose file size,
    # inflated by a conservative decompression factor, is under the
    # threshold; everything else is decided by AQE on measured shuffle sizes.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.sources.fileCompressionFactor": "4.0",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.variant.allowReadingShredded": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "gazette", extra: dict | None = None) -> SparkSession:
    """Build (or fetch) a session with the library defaults applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false")
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime-settable defaults that an existing session has not set itself."""
    own = spark.conf.getAll
    for k, v in DEFAULT_CONF.items():
        if k in own:
            continue
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf on an already-running context
            pass
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir).  If
    neither is set and the session runs in local mode (tests), create a
    private local folder and register it; on a cluster an unset folder is an
    error, never a machine-local fallback.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.sparkContext.getCheckpointDir()
        except Exception:
            root = None
    if not root:
        master = spark.sparkContext.master or ""
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: configure a shared folder "
                               "(e.g. an object-store path) for this cluster session")
        root = tempfile.mkdtemp(prefix="gazette-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
        try:
            spark.sparkContext.setCheckpointDir(root)
        except Exception:
            pass
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df, name: str, partition_by: list | None = None):
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Used for dimensions derived from facts (CREATE TABLE AS SELECT): the
    lineage is cut and the planner gets real file sizes, so a small table is
    broadcast at planning time (size checked against
    ``spark.sql.autoBroadcastJoinThreshold``) instead of after the large side
    has already been shuffled; a large one stays a sort-merge join.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return spark.read.parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists; other errors are raised, never read as absence."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def input_bytes(spark: SparkSession, paths) -> int:
    """Total size of the files under ``paths`` (a listing, no data read)."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        fs = hp.getFileSystem(conf)
        if fs.exists(hp):
            total += fs.getContentSummary(hp).getLength()
    return total


_SHUFFLE = "spark.sql.shuffle.partitions"
_SIZED: dict[str, str] = {}  # application -> the value that tune_shuffle_partitions set last


def tune_shuffle_partitions(spark: SparkSession, paths, target_bytes: int = 128 << 20,
                            only_if_default: bool = True) -> int:
    """Size ``spark.sql.shuffle.partitions`` from the input volume, anew for each input.

    About one partition per ``target_bytes`` of input (shuffled data is
    usually smaller, and AQE coalesces further), never fewer than the task
    slots.  With ``only_if_default`` a value that somebody else set, at the
    start or since, is kept.
    """
    app = spark.sparkContext.applicationId
    current = spark.conf.get(_SHUFFLE, "200")
    ours = current == _SIZED.get(app, "200") and not (
        app not in _SIZED and spark.sparkContext.getConf().contains(_SHUFFLE))
    if only_if_default and not ours:
        return int(current)
    n = max(spark.sparkContext.defaultParallelism, -(-input_bytes(spark, paths) // target_bytes))
    _SIZED[app] = str(n)
    spark.conf.set(_SHUFFLE, str(n))
    return n


SCAN_BYTES = 8 << 20  # of a compressed input, for one task


def rebalance_small_scan(df, path: str, min_bytes: int = 1 << 20, max_bytes: int = 1 << 30):
    """Spread an under-partitioned scan over the task slots.

    A few large unsplittable inputs (single-row-group Parquet, gzip JSON)
    give fewer scan tasks than cores; a round-robin repartition then lets
    the per-row work (parsing, projection, partial aggregation) run in
    parallel, with about ``SCAN_BYTES`` of input a task.  A file may also be cut
    into enough splits of which few hold rows, since a row group is read by one
    task: the rows of each scan task are counted (from Parquet footers, no
    column is read).  Inputs above ``max_bytes`` are only shuffled for such an
    uneven scan: at that size the scan's own splits keep a cluster busy.
    """
    spark = df.sparkSession
    slots = spark.sparkContext.defaultParallelism
    size = input_bytes(spark, path)
    if size < min_bytes:
        return df
    wanted = slots * max(1, -(-size // (SCAN_BYTES * slots)))  # whole waves of tasks
    have = df.rdd.getNumPartitions()
    if size <= max_bytes and have < wanted:
        return df.repartition(wanted)
    loads = df.groupBy(F.spark_partition_id().alias("task")).count().agg(F.max("count"), F.sum("count")).first()
    if loads[0] is not None and loads[0] * slots > 2 * loads[1]:
        return df.repartition(wanted)
    return df
