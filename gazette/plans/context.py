"""Per-run context: the derived layers built once from a fixture folder.

Every attribute is a lazy DataFrame; nothing executes until a query's result
is consumed.  Queries share these frames, so one plan per layer exists.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..sources import testdata as td
from ..operators import curate
from ..session import materialize, path_exists


# Curated tables built once per (application, fixture folder), like the
# reference's CREATE TABLE AS SELECT: later queries read the stored table.
_CURATED: dict = {}


class Context:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return td.table(self.spark, self.sf_dir, name)

    @cached_property
    def raw(self) -> DataFrame:
        """RAW tracking feed (text timestamps) incl. ``event_id``."""
        return td.tracking_events(self.spark, self.sf_dir)

    @cached_property
    def articles(self) -> DataFrame:
        """C1, materialized once in the shared folder (CTAS) and then read."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir, "articles")
        path = _CURATED.get(key)
        if path and path_exists(self.spark, path):
            return self.spark.read.parquet(path)
        df = materialize(curate.articles_dim(self.raw, td.ARTICLE_AS_OF_TS, td.UNREAD_ARTICLE_IDS),
                         "curated-articles")
        _CURATED[key] = df.inputFiles()[0].rsplit("/", 1)[0]
        return df

    @cached_property
    def events(self) -> DataFrame:
        """Typed events (C3) with ``event_id`` kept as a tiebreak column."""
        return curate.typed_events(self.raw, self.articles, keep_extra=["event_id"])

    @cached_property
    def actions(self) -> DataFrame:
        """Typed events without ``publication``: no article join, for marts that do not read it."""
        return curate.typed_events(self.raw, None, keep_extra=["event_id"])

    def events_since(self, day: str) -> DataFrame:
        """Typed events of ``day`` and later; the bound is pushed to the scan."""
        raw = td.tracking_events(self.spark, self.sf_dir, since=day)
        return curate.typed_events(raw, self.articles, keep_extra=["event_id"])

    @cached_property
    def subscribers(self) -> DataFrame:
        return td.subscribers(self.spark, self.sf_dir, td.SUBSCRIBER_AS_OF)

    @cached_property
    def change_feed(self) -> DataFrame:
        return td.article_change_feed(self.spark, self.sf_dir)
