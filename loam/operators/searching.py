"""Filters of the dashboard's views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def search(columns: Sequence[str], pattern: str) -> Column:
    """Whether any column matches, whatever the case; null matches nothing."""
    return F.exists(F.array(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]), lambda v: F.regexp_like(v, F.lit(f"(?i){pattern}")))


def any_part(column: str, chosen: Sequence[str]) -> Column:
    """Whether any choice is a part of the column; no choice filters nothing."""
    if not chosen:
        return F.lit(True)
    return F.coalesce(F.exists(F.array(*[F.lit(x) for x in chosen]), lambda x: F.contains(F.col(column), x)), F.lit(False))


def tri_state(column: str, choice: str) -> Column:
    """All, True or False; null is in neither of the last two."""
    return F.lit(True) if choice == "All" else F.coalesce(F.col(column) == (choice == "True"), F.lit(False))


def chosen(column: str, values: Sequence[str]) -> Column:
    return F.col(column).isin(*values) if values else F.lit(True)


def choices(df: DataFrame, column: str, by: str = ", ") -> DataFrame:
    """The distinct items of a joined column, in order."""
    return df.select(F.explode(F.split(column, by)).alias(column)).where(f"`{column}` != ''").distinct().orderBy(column)
