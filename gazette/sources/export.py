"""Open-format export.

The article metrics are written as Parquet partitioned by ``section`` so any
engine reads them and a section filter prunes directories.  If an Iceberg
catalog is configured in the session (``spark.sql.catalog.<name>``), the same
frame can go to an Iceberg table instead; that jar is not bundled here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Narrow projection of the open table definition (7 columns).
NARROW_COLUMNS = ["article_id", "title", "section", "unique_readers", "avg_read_time_sec",
                  "deep_reads", "shares"]


def export_parquet(df: DataFrame, path: str, partition_by: str | None = "section",
                   columns: list | None = None) -> str:
    """Overwrite ``path`` with ``df`` (optionally a column subset), partitioned.

    No shuffle by the partition column: a section holding a third of the rows
    would otherwise be written by one task.  Each task writes its own slice
    of every section; ``maxRecordsPerFile`` bounds file sizes.
    """
    out = df.select(*columns) if columns else df
    w = (out.write.mode("overwrite").option("partitionOverwriteMode", "static")
         .option("maxRecordsPerFile", 5_000_000))
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)
    return path


def export_iceberg(df: DataFrame, table: str, partition_by: str | None = "section") -> str:
    """CTAS into an Iceberg table of a configured catalog (needs the runtime jar)."""
    w = df.writeTo(table).using("iceberg")
    if partition_by:
        w = w.partitionedBy(F.col(partition_by))
    w.createOrReplace()
    return table


def read_export(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def section_topn(exported: DataFrame, section: str, n: int = 10) -> DataFrame:
    """One section's most-read articles from the exported files."""
    return (exported.where(F.col("section") == F.lit(section))
            .select("article_id", "title", "section", "unique_readers", "performance_tier")
            .orderBy(F.desc("unique_readers"), F.asc("article_id")).limit(n))
