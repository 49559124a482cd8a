"""Join helpers with a checked broadcast.

A side is broadcast only if its rows are known (from the write that made it, or a
proven bound) and their estimated bytes are under a limit; beyond the limit, or
without a known size, the plan keeps a shuffle join (sort-merge, with AQE splitting
skewed partitions, or broadcasting a side that its finished shuffle shows to be small).
Nothing is counted here: a plan is never run to learn how to run it.  The limits are
session settings: ``vaultmart.broadcast.maxBytes`` (default 64 MB; rows times the width
of the columns, text at ``TEXT_BYTES`` each) and ``vaultmart.broadcast.maxRows``.

``anti_join_existing`` is the vault's "insert if the key is new" step, with
three plans chosen by the sizes:

1. the target (hub/link keys) passes the check: broadcast it into the
   anti-join; the batch is neither shuffled nor computed twice;
2. else the batch's keys pass: the big target is only *scanned* against a
   broadcast of the batch keys (no shuffle of the target), and the few matches
   are broadcast back into the anti-join;
3. else the target's keys are first reduced to those the batch has (a semi-join, for
   which Spark builds a Bloom filter of the batch's keys and applies it to the
   target's scan, below its shuffle, where the target is big enough to gain),
   and the batch is anti-joined with these hits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultmart.functions.lineage import cut, cut_measured

MAX_ROWS_CONF = "vaultmart.broadcast.maxRows"
DEFAULT_MAX_ROWS = 1_000_000
MAX_BYTES_CONF = "vaultmart.broadcast.maxBytes"
DEFAULT_MAX_BYTES = 64 * 1024 * 1024
TEXT_BYTES = 48          # a hash key is 32 characters
ROW_BYTES = 32           # a row's own overhead in the broadcast relation
FIRST_DAY = "0001-01-01 00:00:00"


def broadcast_limit(df: DataFrame) -> int:
    """The most rows of ``df``'s width that may be broadcast."""
    conf = df.sparkSession.conf
    width = ROW_BYTES + sum(TEXT_BYTES if kind == "string" else 16 for _, kind in df.dtypes)
    return min(int(conf.get(MAX_ROWS_CONF, str(DEFAULT_MAX_ROWS))),
               int(conf.get(MAX_BYTES_CONF, str(DEFAULT_MAX_BYTES))) // width)


def is_small(df: DataFrame, known_rows: int | None) -> bool:
    """Size check against a known number (or proven upper bound) of rows."""
    return known_rows is not None and known_rows <= broadcast_limit(df)


def some_keys(batch: DataFrame, keys: list[str]) -> DataFrame:
    """The distinct keys of a batch that can match at all."""
    for k in keys:
        batch = batch.where(F.col(k).isNotNull())
    return batch.select(*keys).distinct()


def _filter_keys(batch: DataFrame, keys: list[str]) -> DataFrame:
    """The keys of a stored batch, in the form from which Spark builds a runtime Bloom
    filter: a scan (no aggregate) that it sees filtered.  The condition is on the load
    date, which all rows meet; one on the key would be inferred for the other side too,
    and the filter could then be made of that."""
    for k in keys:
        batch = batch.where(F.col(k).isNotNull())
    if "load_date" in batch.columns:
        day = F.lit(FIRST_DAY).cast("timestamp_ntz")
        batch = batch.where(F.coalesce("load_date", day) >= day)
    return batch.select(*keys)


def known_keys(stage: DataFrame, target: DataFrame, keys: list[str], target_rows: int,
               batch_rows: int) -> tuple[DataFrame, int]:
    """(what of the target's keys a *stored* batch holds, its rows): all that a load of the
    batch has to be compared with.  Where both are big, the history is scanned once,
    Bloom-filtered, and no row of the batch but its keys is shuffled for it."""
    target_keys = target.select(*keys)
    if is_small(target_keys, target_rows) or is_small(stage.select(*keys), batch_rows):
        return target, target_rows
    hits, size = cut_measured(target_keys.join(_filter_keys(stage, keys), keys, "left_semi"), "known")
    return hits, size.rows


def checked_broadcast(df: DataFrame, known_rows: int | None) -> DataFrame:
    """``F.broadcast(df)`` if it passes the size check, else ``df`` unchanged."""
    return F.broadcast(df) if is_small(df, known_rows) else df


def anti_join_existing(batch: DataFrame, target: DataFrame, keys: list[str],
                       target_rows: int | None = None,
                       batch_rows: int | None = None) -> DataFrame:
    """Rows of ``batch`` whose ``keys`` are not in ``target`` (NULL keys never
    match, so they are kept, like LEFT JOIN ... WHERE t.key IS NULL).

    ``target_rows`` / ``batch_rows``: the sizes, or proven upper bounds, where known.
    """
    if target_rows == 0:          # proven empty: nothing to exclude
        return batch
    target_keys = target.select(*keys)
    if is_small(target_keys, target_rows):
        return batch.join(F.broadcast(target_keys), keys, "left_anti")
    if is_small(batch.select(*keys), batch_rows):
        # the matches are a subset of the (checked) batch keys: bounded too
        hits = target_keys.join(F.broadcast(some_keys(batch, keys)), keys, "left_semi").distinct()
        return batch.join(F.broadcast(hits), keys, "left_anti")
    # both joins read the batch: written, it is computed once, and Spark can filter by it
    batch = cut(batch, "batch")
    hits = target_keys.join(_filter_keys(batch, keys), keys, "left_semi")
    return batch.join(hits, keys, "left_anti")
