"""Lenient casts of raw text, with Hive's meaning.

Hive turns unparseable text into NULL; Spark 4 in ANSI mode raises, so raw
input goes through ``try_cast``.  Text to INT truncates a fractional part in
Hive ('12.7' -> 12); we go through DECIMAL(38,10), whose conversion to INT
truncates too.  Already typed columns use plain ``cast``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_to_int(c) -> Column:
    return _col(c).try_cast("decimal(38,10)").try_cast("int")


def text_to_date(c) -> Column:
    return _col(c).try_cast("date")


def text_to_timestamp(c) -> Column:
    return _col(c).try_cast("timestamp_ntz")


def period_to_date(c) -> Column:
    """'YYYY-MM' -> first day of that month: cast(concat(p, '-01') as DATE)."""
    return F.concat(_col(c), F.lit("-01")).try_cast("date")


def to_money(c) -> Column:
    """DOUBLE -> DECIMAL(10,2), HALF_UP; out of range -> NULL."""
    return _col(c).try_cast("decimal(10,2)")
