"""Small helpers shared by the expression modules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    """Accept a column name or a Column."""
    return F.col(c) if isinstance(c, str) else c


def ts_literal(value: str) -> Column:
    """A date or timestamp string as an explicit ``timestamp_ntz`` literal.

    Comparing a timestamp column with a bare string leaves the cast to
    the engine; here it is spelled out so ``'2024-03-25'`` means midnight
    starting that day, in every engine.
    """
    return F.to_timestamp_ntz(F.lit(value))
