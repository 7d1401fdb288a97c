"""Metric layer (G6, G7, C18): logical entities, dimensions, metrics, synonyms.

``SemanticModel.query(metrics, dimensions, where)`` resolves names or
synonyms, checks that everything requested belongs to one entity (no
relationship between entities is declared, so cross-entity questions are
refused), and compiles to a single ``groupBy().agg()`` on that entity.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Dimension:
    name: str
    entity: str
    column: str
    synonyms: tuple = ()


@dataclass(frozen=True)
class Metric:
    name: str
    entity: str
    expr: Callable[[], Column]
    synonyms: tuple = ()


@dataclass
class Entity:
    name: str
    frame: Callable[[], DataFrame]
    primary_key: tuple


class MetricError(ValueError):
    pass


@dataclass
class SemanticModel:
    entities: dict = field(default_factory=dict)
    dimensions: dict = field(default_factory=dict)
    metrics: dict = field(default_factory=dict)

    def add_entity(self, e: Entity):
        self.entities[e.name] = e

    def add_dimension(self, d: Dimension):
        self.dimensions[d.name] = d

    def add_metric(self, m: Metric):
        self.metrics[m.name] = m

    def _lookup(self, name: str, table: dict):
        key = name.strip().lower()
        for obj in table.values():
            if obj.name.lower() == key or key in (s.lower() for s in obj.synonyms):
                return obj
        return None

    def resolve(self, name: str):
        """Name or synonym -> Dimension or Metric."""
        obj = self._lookup(name, self.metrics) or self._lookup(name, self.dimensions)
        if obj is None:
            raise MetricError(f"unknown metric or dimension {name!r}")
        return obj

    def query(self, metrics: list, dimensions: list | None = None,
              where: Column | None = None, order_by_dims: bool = False) -> DataFrame:
        ms = [self.resolve(m) for m in metrics]
        ds = [self.resolve(d) for d in (dimensions or [])]
        for o in ms:
            if not isinstance(o, Metric):
                raise MetricError(f"{o.name!r} is a dimension, not a metric")
        for o in ds:
            if not isinstance(o, Dimension):
                raise MetricError(f"{o.name!r} is a metric, not a dimension")
        entities = {o.entity for o in ms + ds}
        if len(entities) != 1:
            raise MetricError(f"names span entities {sorted(entities)} with no declared relationship")
        ent = self.entities[entities.pop()]
        df = ent.frame()
        if where is not None:
            df = df.where(where)
        grouped = df.groupBy(*[F.col(d.column).alias(d.name) for d in ds])
        out = grouped.agg(*[m.expr().alias(m.name) for m in ms])
        return out.orderBy(*[d.name for d in ds]) if (ds and order_by_dims) else out


# --- fixed values: the content model's names and synonyms -------------------
CONTENT_DIMENSIONS = [
    ("section", "articles", "section", ("rubrique", "categorie")),
    ("publication", "articles", "publication", ("journal", "titre")),
    ("author", "articles", "author", ("journaliste", "auteur")),
    ("title", "articles", "title", ()),
    ("performance_tier", "articles", "performance_tier", ()),
    ("paywall_type", "articles", "paywall_type", ()),
    ("day", "engagement", "day", ("date", "jour")),
]
CONTENT_METRICS = [
    ("total_unique_readers", "articles", "sum", "unique_readers", ("lecteurs", "readers", "audience")),
    ("avg_reading_time", "articles", "avg", "avg_read_time_sec", ("temps de lecture", "reading time")),
    ("total_deep_reads", "articles", "sum", "deep_reads", ()),
    ("total_shares", "articles", "sum", "shares", ("partages",)),
    ("total_conversions", "articles", "sum", "conversions", ("abonnements", "subscriptions")),
    ("total_paywall_hits", "articles", "sum", "paywall_hits", ()),
    ("article_count", "articles", "count", "article_id", ()),
    ("total_page_views", "engagement", "sum", "page_views", ("pages vues", "vues")),
    ("avg_engagement", "engagement", "avg", "avg_engagement_sec", ()),
]

_AGG = {"sum": F.sum, "avg": F.avg, "count": F.count}


def content_model(article_performance: DataFrame, reader_engagement: DataFrame) -> SemanticModel:
    """The editorial model over the two refreshed aggregates.

    As defined, reader totals sum per-article distinct counts and averages
    average per-row averages; they are not true distinct / weighted values.
    """
    m = SemanticModel()
    m.add_entity(Entity("articles", lambda: article_performance, ("article_id",)))
    m.add_entity(Entity("engagement", lambda: reader_engagement, ("day", "section", "publication")))
    for name, ent, col, syn in CONTENT_DIMENSIONS:
        m.add_dimension(Dimension(name, ent, col, syn))
    for name, ent, fn, col, syn in CONTENT_METRICS:
        m.add_metric(Metric(name, ent, (lambda fn=fn, col=col: _AGG[fn](F.col(col))), syn))
    return m
