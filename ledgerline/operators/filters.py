"""Row filters whose semantics need more than a bare ``where``.

Plain equality / IN / IS NOT NULL filters are written inline with the
DataFrame API where they are used; Catalyst pushes them into the
parquet scan (``PushedFilters``) on its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.common import as_col, ts_literal


def ts_range(column, start: str, end: str, whole_last_day: bool = False) -> Column:
    """``start <= ts <= end`` with date literals.

    A bare date as ``end`` means midnight *starting* that day, so events
    later on the last day fall outside (the behaviour of the classic
    ``ts <= '2024-03-25'``).  ``whole_last_day=True`` keeps the whole
    last day: ``ts < end + 1 day``.
    """
    c = as_col(column)
    lower = c >= ts_literal(start)
    if whole_last_day:
        upper = c < F.timestamp_add("DAY", F.lit(1), ts_literal(end))
    else:
        upper = c <= ts_literal(end)
    return lower & upper


def ts_between(column, start: str, end: str) -> Column:
    """SQL ``BETWEEN`` with explicit timestamp literals (end-day effect
    as in :func:`ts_range`)."""
    return as_col(column).between(ts_literal(start), ts_literal(end))


def filter_ts_range(df: DataFrame, column: str, start: str, end: str,
                    whole_last_day: bool = False) -> DataFrame:
    return df.where(ts_range(column, start, end, whole_last_day))


def json_path_not_null(text, path: str) -> Column:
    """True when the JSON path holds a value; JSON ``null`` and a missing
    key both count as null."""
    return F.get_json_object(as_col(text), path).isNotNull()


def finalized_positive(total="total", status="status", status_value: str = "FINALIZED") -> Column:
    """``(total > 0) & (status == 'FINALIZED')``."""
    return (as_col(total) > 0) & (as_col(status) == F.lit(status_value))
