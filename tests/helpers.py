import datetime as dt

from pyspark.sql import DataFrame


def rows(df: DataFrame, *cols):
    """Sorted list of tuples (None sorts first) for order-insensitive compares."""
    cols = cols or tuple(df.columns)
    out = [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]
    return sorted(out, key=lambda t: tuple((x is not None, x) for x in t))


def ts(year, month=1, day=1):
    return dt.datetime(year, month, day)
