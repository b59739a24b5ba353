"""Money and number formatting as built-in column expressions.

Amounts stay integer cents (``bigint``) until display.  Display strings
go through ``decimal(38,2)`` so a billion prints as ``1000000000.0`` and
not in scientific notation, and rounding matches half-away-from-zero on
the double value (the way a SQL ``round(x, 2)`` on a double behaves).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.functions.common import as_col


def to_cents(amount) -> Column:
    """Double dollars (or any unit) times 100, rounded, as ``bigint``."""
    return F.round(as_col(amount).cast("double") * F.lit(100.0), 0).cast("bigint")


def cents_to_units(cents) -> Column:
    """Integer cents to a double amount: one exact division, no drift."""
    return as_col(cents).cast("double") / F.lit(100.0)


def round_2(value) -> Column:
    """Round a double to 2 places, half away from zero on ``x * 100``."""
    return F.round(as_col(value).cast("double") * F.lit(100.0), 0) / F.lit(100.0)


def divide_safe(numerator, denominator) -> Column:
    """Fractional division; zero or null divisor gives null, never an error."""
    return F.try_divide(as_col(numerator).cast("double"), as_col(denominator).cast("double"))


def amount_text(cents) -> Column:
    """Cents as the shortest plain decimal text with at least one fraction
    digit: 82630 -> ``826.3``, 0 -> ``0.0``, 162904 -> ``1629.04``."""
    dec = (as_col(cents).cast("decimal(38,0)") / F.lit(100)).cast("decimal(38,2)")
    return F.regexp_replace(dec.cast("string"), "0$", "")


def format_money(cents, prefix: str = "$", suffix: str = " USD",
                 legacy_null_concat: bool = False) -> Column:
    """``$826.3 USD`` from cents.

    A null amount gives a null string.  ``legacy_null_concat=True`` keeps
    the prefix and suffix around an empty amount instead (``$ USD``),
    the way a null-skipping CONCAT behaves.
    """
    text = amount_text(cents)
    if legacy_null_concat:
        text = F.coalesce(text, F.lit(""))
    return F.concat(F.lit(prefix), text, F.lit(suffix))
