"""Session helpers: shuffle sizing, scan rebalancing, shared checkpoint folder."""

from conftest import SMOKE
from gazette import session as S
from pyspark.sql import functions as F


def test_shuffle_partitions_sizing_keeps_explicit_setting(spark, monkeypatch):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    assert S.tune_shuffle_partitions(spark, SMOKE) == int(before)      # explicit 8 is kept
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "200")          # a user's own 200 too
        assert S.tune_shuffle_partitions(spark, SMOKE) == 200
        # a value that the library set itself is worked out anew for each input
        monkeypatch.setitem(S._SIZED, spark.sparkContext.applicationId, "200")
        large = S.tune_shuffle_partitions(spark, SMOKE, target_bytes=4096)
        assert large > spark.sparkContext.defaultParallelism
        assert S.tune_shuffle_partitions(spark, SMOKE) == spark.sparkContext.defaultParallelism
        assert S.tune_shuffle_partitions(spark, SMOKE, target_bytes=4096) == large
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_rebalance_only_when_underpartitioned(spark):
    path = "/root/testdata/sf0.1/events.parquet"
    one = spark.read.parquet(path)
    assert one.rdd.getNumPartitions() < spark.sparkContext.defaultParallelism
    assert S.rebalance_small_scan(one, path).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    wide = one.repartition(spark.sparkContext.defaultParallelism * 2)
    assert S.rebalance_small_scan(wide, path) is wide                   # already wide: untouched
    tiny = "/root/testdata/sf0.001/region.parquet"
    small = spark.read.parquet(tiny)
    assert S.rebalance_small_scan(small, tiny) is small                 # under 1 MB: untouched


def test_checkpoint_root_reads_session_setting(spark):
    root = S.checkpoint_root(spark)
    assert root == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    p = S.scratch_path(spark, "x")
    assert p.startswith(root + "/x-")
    m = S.materialize(spark.range(5), "t-mat")
    assert m.count() == 5 and root in m.inputFiles()[0]


def test_rebalance_sees_one_row_group_behind_many_splits(spark, tmp_path):
    path = str(tmp_path / "one.parquet")
    spark.range(200_000).selectExpr("id", "md5(cast(id AS string)) AS v").coalesce(1).write.parquet(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
        spark.conf.set("spark.sql.files.openCostInBytes", "1k")
        df = spark.read.parquet(path)
        assert df.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
        out = S.rebalance_small_scan(df, path)
        loads = [r[0] for r in out.groupBy(F.spark_partition_id()).count().select("count").collect()]
        assert len(loads) >= spark.sparkContext.defaultParallelism and max(loads) < 100_000 and sum(loads) == 200_000
        above = S.rebalance_small_scan(df, path, max_bytes=1 << 20)       # uneven: shuffled at any size
        assert above is not df and above.count() == 200_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
