"""Department attributes and the scope of a plan."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame, functions as F

from staffcast.functions.scalar import name_contains_any


def in_scope(
    rows: DataFrame, verticals: Collection[str] | None, exclude_tokens: tuple[str, ...] = ()
) -> DataFrame:
    """Keep the given verticals (None keeps all) and drop names holding an excluded token."""
    kept = rows if verticals is None else rows.where(F.col("vertical").isin(*verticals))
    return kept.where(~name_contains_any(F.col("department_name"), exclude_tokens))


def departments_in_scope(
    departments: DataFrame, verticals: Collection[str] | None, exclude_tokens: tuple[str, ...] = ()
) -> DataFrame:
    """Scope applied to the map itself; rows without an id are dropped."""
    return in_scope(departments.where(F.col("department_id").isNotNull()), verticals, exclude_tokens)


def attach_departments(rows: DataFrame, departments: DataFrame) -> DataFrame:
    """Add name and vertical; rows whose department is not in ``departments`` are dropped.

    No broadcast hint: the planner broadcasts the map when its size allows and
    otherwise falls back to a join that adaptive execution can split on skew.
    """
    return rows.join(departments, "department_id").select(
        "vertical", "department_id", "department_name",
        *[c for c in rows.columns if c != "department_id"],
    )
