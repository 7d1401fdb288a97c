"""Row-count audits (S15, U1): labelled counts as one UNION ALL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_audit(tables: dict[str, DataFrame], null_checks: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """``tables``: label -> frame; ``null_checks``: label -> (table label, column).

    A null check is computed in the same pass as its table's count.
    """
    null_checks = null_checks or {}
    parts = []
    for label, df in tables.items():
        checks = {k: c for k, (t, c) in null_checks.items() if t == label}
        aggs = [F.count("*").alias(label)] + [F.count_if(F.col(c).isNull()).alias(k) for k, c in checks.items()]
        wide = df.agg(*aggs)
        parts.append(wide.unpivot([], list(wide.columns), "tbl", "n"))
    return reduce(lambda a, b: a.unionByName(b), parts)
