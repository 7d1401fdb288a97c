"""Column-expression helpers (JVM-side, codegen friendly)."""

from .buckets import bucket, hash60, pick  # noqa: F401
from .dates import boundary_diff, format_raw_ts, parse_raw_ts  # noqa: F401
from .rules import (  # noqa: F401
    churn_rule_score, engagement_segment, pct_or_null, pct_or_zero, risk_segment, tier,
)
