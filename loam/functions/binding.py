"""Names for parts of column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once a row, however often body uses it: an expression that holds another several times
    is otherwise written out, and computed, as often."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
