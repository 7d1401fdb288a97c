"""Column masking by role.

A policy maps a value column to its masked form unless the caller's role is
privileged.  Role matching is exact (no role hierarchy): a child of an
admin role still sees masked values.  The role is an explicit argument, so
the decision is made when the plan is built and the masked plan stays plain
JVM expressions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.constants import EMAIL_MASK, NAME_MASK, PHONE_MASK_PREFIX, PRIVILEGED_ROLES

Policy = Callable[[Column], Column]


def mask_email(c: Column) -> Column:
    """Greedy ``.+@`` -> ``****@`` (up to the last ``@``); no ``@`` -> unchanged."""
    return F.regexp_replace(c, r".+@", EMAIL_MASK)


def mask_name(c: Column) -> Column:
    """Constant, also for NULL input."""
    return F.lit(NAME_MASK)


def mask_phone(c: Column) -> Column:
    """Prefix + last two characters; NULL stays NULL."""
    return F.concat(F.lit(PHONE_MASK_PREFIX), F.right(c, F.lit(2)))


SUBSCRIBER_POLICIES: dict[str, Policy] = {
    "email": mask_email,
    "full_name": mask_name,
    "phone": mask_phone,
}


def is_privileged(role: str, privileged=PRIVILEGED_ROLES) -> bool:
    return role in privileged


def secured(df: DataFrame, policies: dict[str, Policy], role: str,
            privileged=PRIVILEGED_ROLES) -> DataFrame:
    """The frame as ``role`` sees it: policy columns masked unless privileged.

    Columns are matched as Spark matches names, whatever their case; a policy
    without its column is an error, so that a renamed column cannot slip by.
    """
    by_name = {c.lower(): p for c, p in policies.items()}
    missing = set(by_name) - {c.lower() for c in df.columns}
    if missing:
        raise ValueError(f"policy columns missing from the frame: {sorted(missing)}")
    if is_privileged(role, privileged):
        return df
    return df.select(*[
        by_name[c.lower()](F.col(c)).alias(c) if c.lower() in by_name else F.col(c) for c in df.columns
    ])


def create_secured_view(df: DataFrame, name: str, policies: dict[str, Policy], role: str) -> DataFrame:
    out = secured(df, policies, role)
    out.createOrReplaceTempView(name)
    return out
