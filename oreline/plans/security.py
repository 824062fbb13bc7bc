"""Row-level security as filters on dimensions, spread to facts by semi joins."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from oreline.plans.star import Star


@dataclass(frozen=True)
class Role:
    """``departments`` maps the user to a filter on dim_department; None shows all departments."""

    departments: Callable[[Column], Column] | None = None
    billing: bool = True


ROLES = {
    "DeptManager": Role(departments=lambda user: F.col("department_name") == user),
    "ReadOnly": Role(billing=False),
}


def _any_of(roles: Sequence[Role], user: Column) -> Column | None:
    """What any of the roles shows; None when one of them shows everything."""
    allowed: Column = F.lit(False)
    for role in roles:
        if role.departments is None:
            return None
        allowed = allowed | role.departments(user)
    return allowed


def secure(star: Star, roles: Sequence[str], user: str | Column) -> Star:
    """The star as a user with these roles sees it. A row is visible if any role shows it.

    Pass ``F.session_user()`` as user to bind a view to whoever queries it.
    """
    if not roles:
        raise ValueError("at least one role is needed")
    who = F.lit(user) if isinstance(user, str) else user
    granted = [ROLES[name] for name in roles]
    tables = {}

    shown = _any_of(granted, who)
    if shown is not None:
        departments = star.tables["dim_department"].filter(shown)
        keys = departments.select("department_key")
        tables["dim_department"] = departments
        for fact in ("fact_admissions", "fact_bed_occupancy"):
            tables[fact] = star.tables[fact].join(keys, "department_key", "left_semi")

    keyed = star.companion("fact_billing", "fact_admissions")
    with_billing = [role for role in granted if role.billing]
    if not with_billing:
        tables["fact_billing"] = star.tables["fact_billing"].filter(F.lit(False))
        if keyed is not None:
            tables["fact_billing_keyed"] = keyed.filter(F.lit(False))
        return star.with_tables(tables)
    billed = _any_of(with_billing, who)
    if billed is not None:
        keys = star.tables["dim_department"].filter(billed).select("department_key")
        own = star.tables["fact_admissions"].join(keys, "department_key", "left_semi")
        tables["fact_billing"] = star.tables["fact_billing"].join(own.select("admission_id"), "admission_id", "left_semi")
        if keyed is not None:
            # Bills carry the department of their admission, so the two facts need not meet.
            key = "fact_admissions__department_key"
            tables["fact_billing_keyed"] = keyed.join(keys.withColumnRenamed("department_key", key), key, "left_semi")
    # Where bills are shown of admissions that are not, they must not carry their keys: the companion is left out.
    return star.with_tables(tables)
