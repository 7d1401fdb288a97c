"""Named query plans: ``queries()`` and ``oracle_sql()``.

Importing this package registers every plan module.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import churn, core, export, governance, ingest, streams, text_ids  # noqa: F401  (registers)
from .registry import ORACLE, QUERIES


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in ORACLE.items() if k in QUERIES}
