"""Consecutive surrogate ids without a single-partition window.

``row_number() over (order by k)`` with no PARTITION BY moves every row into
one task.  Instead: range-partition and sort the rows by the ordering, tag each
row with ``monotonically_increasing_id`` (partition index in the upper bits,
position inside the partition in the lower 33 bits), count rows per
partition, and turn the counts into offsets with a running sum.  The running
sum covers one row per partition (plus one for the existing maximum id), so
its size is bounded by the partition count, not by the data; it is the only
thing broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultmart.functions.lineage import cut

_POS_BITS = 33


# A caller that can prove a bound of at most this many new rows gets the ids from
# one ordered window: bounded work for one task, and two jobs fewer.  Without a
# proven bound the ids are always distributed; nothing is probed.
SMALL_ROWS = 100_000


def _base(new_rows: DataFrame, existing: DataFrame | None, id_col: str) -> DataFrame:
    if existing is not None:
        return existing.agg(F.coalesce(F.max(id_col), F.lit(0)).cast("long").alias("_n"))
    return new_rows.sparkSession.range(1).select(F.lit(0).cast("long").alias("_n"))


def append_sequence_ids(new_rows: DataFrame, order: list[Column], existing: DataFrame | None,
                        id_col: str = "id", max_rows: int | None = None) -> DataFrame:
    """Give ``new_rows`` ids max(existing.id)+1, +2, ... in ``order``.

    ``order`` holds sort Columns (e.g. ``F.col("k").asc_nulls_last()``);
    ``max_rows``: an optional proven bound on ``new_rows``.
    """
    cols = new_rows.columns
    if max_rows is not None and max_rows <= SMALL_ROWS:
        # proven small: one ordered window; the base is a scalar subquery
        base = F.lit(0) if existing is None else _base(new_rows, existing, id_col).scalar()
        ranked = new_rows.withColumn("_r", F.row_number().over(Window.orderBy(*order)))
        return ranked.select((base + F.col("_r")).cast("long").alias(id_col), *cols)
    return _distributed_ids(new_rows, order, existing, id_col)


def _distributed_ids(new_rows: DataFrame, order: list[Column], existing: DataFrame | None,
                     id_col: str) -> DataFrame:
    cols = new_rows.columns
    tagged = (new_rows.repartitionByRange(*order)
              .sortWithinPartitions(*order)
              .withColumn("_mid", F.monotonically_increasing_id()))
    # Fix the tags: a recomputation after a lost executor must give the same ids.
    tagged = cut(tagged)
    tagged = (tagged.withColumn("_part", F.shiftright("_mid", _POS_BITS))
              .withColumn("_pos", F.col("_mid").bitwiseAND(F.lit((1 << _POS_BITS) - 1))))
    counts = tagged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    base = _base(new_rows, existing, id_col).select(F.lit(-1).cast("long").alias("_part"), "_n")
    running = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (counts.select(F.col("_part").cast("long"), F.col("_n").cast("long"))
               .unionByName(base)
               .select("_part", F.coalesce(F.sum("_n").over(running), F.lit(0)).alias("_off")))
    return (tagged.join(F.broadcast(offsets), "_part")
            .select((F.col("_off") + F.col("_pos") + F.lit(1)).cast("long").alias(id_col), *cols))
