"""Data Vault hash keys and hashdiffs, as built-in Column
expressions so they stay inside whole-stage codegen.

Normalisation of one business key: text form, trimmed of spaces, upper-cased,
blank -> NULL.  Composite keys join the normalised parts with a separator and
stand in a marker for each missing part; a composite of nothing but markers is
NULL.  A hashdiff hashes the same joined text without the NULL-ing, so it is
never NULL.  Hash only typed columns (DATE, DECIMAL, INT, STRING): their text
form is the same in every engine (SURVEY t19).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for identical hashes.
KEY_SEPARATOR = "||"
MISSING_PART = "^^"
RECORD_SOURCE = "PAYMENT - DATA LAKE"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def norm(c) -> Column:
    """nullif(upper(trim(cast(c as string))), '')"""
    return F.nullif(F.upper(F.trim(_col(c).cast("string"))), F.lit(""))


def _joined(cols, normalized: bool) -> Column:
    parts = [_col(c) if normalized else norm(c) for c in cols]
    return F.concat_ws(KEY_SEPARATOR, *[F.coalesce(p, F.lit(MISSING_PART)) for p in parts])


def hash_key(*cols, normalized: bool = False) -> Column:
    """md5 of one normalised key, or of several joined; NULL when all are blank.

    ``normalized=True``: the columns already hold ``norm(...)`` values (a stage
    that hashes one key into several hash keys normalises it once).
    """
    if len(cols) == 1:
        return F.md5(_col(cols[0]) if normalized else norm(cols[0]))
    all_missing = KEY_SEPARATOR.join([MISSING_PART] * len(cols))
    return F.md5(F.nullif(_joined(cols, normalized), F.lit(all_missing)))


def hashdiff(*cols, normalized: bool = False) -> Column:
    """md5 of the joined normalised payload; never NULL."""
    return F.md5(_joined(cols, normalized))
