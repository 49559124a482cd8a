"""Date and year helpers.

Year filters are written so that Parquet can skip row groups: a filter on a
function of a column (``year(pay_date) = Y``) cannot be pushed down, while a
range on the column itself can.  Where the exact predicate is not a pure
range (raw text, truncating epoch division) we AND a necessary range that
pushes down with the exact predicate that decides.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = _dt.datetime(1970, 1, 1)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def year_start(year: int) -> _dt.date:
    return _dt.date(year, 1, 1)


def year_start_datetime(year: int) -> _dt.datetime:
    return _dt.datetime(year, 1, 1)


def execution_ts(year: int) -> Column:
    """LOAD_DATE of a yearly run: its execution date, 1 January 00:00 (t20)."""
    return F.lit(f"{year:04d}-01-01 00:00:00").cast("timestamp_ntz")


def ts_literal(value) -> Column:
    """A zone-less timestamp literal from a datetime/date/ISO string."""
    if isinstance(value, (_dt.datetime, _dt.date)):
        value = value.isoformat(sep=" ") if isinstance(value, _dt.datetime) else value.isoformat()
    return F.lit(str(value)).cast("timestamp_ntz")


def year_start_ts(c) -> Column:
    """Per-row LOAD_DATE for an all-years load: 1 January of the row's year."""
    return F.make_timestamp_ntz(F.year(_col(c)), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))


def in_year(c, year: int) -> Column:
    """Typed DATE/TIMESTAMP column in calendar year ``year``, as a pushable range."""
    lo, hi = year_start(year), year_start(year + 1)
    return (_col(c) >= F.lit(lo)) & (_col(c) < F.lit(hi))


def epoch_ms_to_timestamp(c) -> Column:
    """BIGINT epoch milliseconds -> zone-less TIMESTAMP (Hive reads BIGINT as ms, t1)."""
    return F.timestamp_millis(_col(c)).cast("timestamp_ntz")


def epoch_ms_year(c) -> Column:
    """year(from_unixtime(cast(ts/1000 as BIGINT))): seconds truncated toward zero."""
    secs = (_col(c) / F.lit(1000)).cast("bigint")
    return F.year(F.timestamp_seconds(secs))


def epoch_ms_in_year(c, year: int) -> Column:
    """Exact F2 filter plus a necessary millisecond range that reaches the scan."""
    lo = int((_dt.datetime(year, 1, 1) - _EPOCH).total_seconds()) * 1000
    hi = int((_dt.datetime(year + 1, 1, 1) - _EPOCH).total_seconds()) * 1000
    # truncation toward zero can move a value by < 1 s across the boundary
    coarse = (_col(c) > F.lit(lo - 1000)) & (_col(c) < F.lit(hi + 1000))
    return coarse & (epoch_ms_year(c) == F.lit(year))


def text_year(c) -> Column:
    """year() of a raw date/timestamp string; NULL when it does not parse."""
    return F.year(_col(c).try_cast("date"))


def text_in_year(c, year: int) -> Column:
    return text_year(c) == F.lit(year)


def period_key_year(c) -> Column:
    """extract(year from to_date(BILLING_PERIOD_KEY, 'YYYY-MM')) (t3).

    The key is a DATE as text ('YYYY-MM-DD'); PostgreSQL's to_date ignores the
    tail, so parse only the first seven characters.
    """
    return F.year(F.try_to_timestamp(F.substring(_col(c), 1, 7), F.lit("yyyy-MM")))
