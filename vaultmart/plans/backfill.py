"""Backfill (Q28) and the order-dependent satellite fold.

The reference runs one calendar year per scheduled run, one run at a time,
and every load reads what the previous years wrote.  ``backfill`` is that
schedule as a fold: years ascending, each step sees the previous state.  The
driver only iterates over the (few) years; each step is a set-based Spark job
whose results are appended to tables in the checkpoint folder, so the
lineage of year N never includes the plans of years 1..N-1.

Hubs and links do not need the fold (``hub_backfill`` / ``link_backfill`` load
all years in one pass); satellites do: a version is compared with the latest
versions, which the previous years decided.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from typing import TypeVar

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vaultmart.functions.joins import checked_broadcast
from vaultmart.functions.lineage import ScratchTable, cut_measured
from vaultmart.operators import vault as V

MOST_BITS = 63           # batches that one number can tell apart, and one bit

State = TypeVar("State")


def backfill(years: Iterable[int], step: Callable[[State, int], State], state: State) -> State:
    """Q28: apply ``step`` to each year in ascending order, threading the state."""
    for year in sorted(set(years)):
        state = step(state, year)
    return state


def batch_years(stage_all: DataFrame) -> list[int]:
    """Distinct load years of an all-years stage (a handful of values)."""
    rows = (stage_all.select(F.year("load_date").alias("y")).where(F.col("y").isNotNull())
            .distinct().collect())
    return sorted(r["y"] for r in rows)


class StagedBatches:
    """An all-years stage written once, partitioned by load year.

    Each year's batch is then a pruned partition read, not a recomputation of
    the hashes, and the per-year row counts (one small job, one row per year)
    give every later size decision a proven bound without further jobs.
    """

    def __init__(self, stage_all: DataFrame, name: str = "stage", cols: list[str] | None = None):
        """``cols``: write only the columns the later loads read (column pruning
        before materialising; ``load_date`` is always kept)."""
        if cols is not None:
            stage_all = stage_all.select(*dict.fromkeys([*cols, "load_date"]))
        self.table = ScratchTable.of(stage_all.withColumn("_batch", F.year("load_date")),
                                     name, partition_by=["_batch"])
        stats = (self.table.read().groupBy("_batch")
                 .agg(F.count(F.lit(1)).alias("n"), F.min("load_date").alias("lo"),
                      F.max("load_date").alias("hi")).collect())
        self.undated = any(r["_batch"] is None for r in stats)
        stats = [r for r in stats if r["_batch"] is not None]
        self.sizes = {r["_batch"]: r["n"] for r in stats}
        self.load_dates = {r["_batch"]: (r["lo"], r["hi"]) for r in stats}

    def increasing_load_dates(self) -> bool:
        """One load date per batch, rising from batch to batch."""
        spans = [self.load_dates[y] for y in self.years]
        return (all(lo == hi for lo, hi in spans)
                and all(a[1] < b[0] for a, b in zip(spans, spans[1:])))

    @property
    def years(self) -> list[int]:
        return sorted(self.sizes)

    def all(self) -> DataFrame:
        return self.table.read().drop("_batch")

    def batch(self, year: int) -> DataFrame:
        return self.table.read().where(F.col("_batch") == F.lit(year)).drop("_batch")


def _fold(staged: StagedBatches, sat: DataFrame | None, pk: str, hd: str, cols: list[str]) -> DataFrame:
    """What loading the batches in order inserts, where no load date is out of order.

    Of each key and hashdiff one number holds the batches that have it (a bit each; bit 0:
    a newest version in ``sat``).  The years are then walked over these numbers: a year
    inserts the hashdiffs it has that are not current, and if a key got any, they are
    its current ones.  A step is a window over the key, and all steps share one shuffle
    and one sort, whatever the number of years.  A key's rows are bounded by its
    distinct hashdiffs, and a window spills what memory does not hold.
    """
    bits = {year: 1 << n for n, year in enumerate(staged.years, 1)}
    dated = staged.table.read().where(F.col("_batch").isin(staged.years)).drop("_batch").select(*cols)
    # NULL keys never match: all their distinct rows of each batch are new
    rows = dated.distinct()
    keyed, unkeyed = rows.where(F.col(pk).isNotNull()), rows.where(F.col(pk).isNull())
    bit = F.lit(0).cast("long")
    for year, value in bits.items():
        bit = F.when(F.year("load_date") == year, F.lit(value).cast("long")).otherwise(bit)
    bit = bit.alias("_bit")
    seen = dated.where(F.col(pk).isNotNull()).select(pk, hd, bit)
    if sat is not None:
        newest = V.newest_per_key(sat.where(F.col(pk).isNotNull()), pk, hd)
        seen = seen.unionByName(newest.select(pk, hd, F.lit(1).cast("long").alias("_bit")))
    seen = seen.groupBy(pk, hd).agg(F.bit_or("_bit").alias("_has"))
    key = Window.partitionBy(pk)
    walk = seen.select(pk, hd, "_has", (F.col("_has").bitwiseAND(F.lit(1)) != 0).alias("_current"),
                       F.lit(0).cast("long").alias("_new"))
    for value in bits.values():
        has = F.col("_has").bitwiseAND(F.lit(value).cast("long")) != 0
        walk = (walk.withColumn("_ins", has & (~F.col("_current") | F.col(hd).isNull()))      # NULL never matches
                .withColumn("_any", F.max("_ins").over(key))
                .withColumn("_current", F.when(F.col("_any"), F.col("_ins")).otherwise(F.col("_current")))
                .withColumn("_new", F.when(F.col("_ins"), F.col("_new") + F.lit(value)).otherwise(F.col("_new"))))
    inserted = walk.where("_new != 0").select(F.col(pk).alias("_pk"), F.col(hd).alias("_hd"), "_new")
    new = (keyed.join(inserted, (F.col(pk) == F.col("_pk")) & F.col(hd).eqNullSafe(F.col("_hd")))
           .where(F.col("_new").bitwiseAND(bit) != 0).select(*cols))
    return new.unionByName(unkeyed)


def sat_backfill(staged: StagedBatches, sat: DataFrame | None, pk: str, hd: str,
                 cols: list[str], name: str = "sat") -> DataFrame:
    """The satellite after loading every year of ``staged`` in order
    (``sat=None``: starting from an empty satellite).

    When every batch has one load date, later than every earlier batch's and than
    anything already in the satellite, the load-date guard never excludes a version and
    the fold is set-based (``_fold``).  Otherwise, an exact split by key:
    * a key seen in only one batch (and every NULL key, which never matches)
      cannot depend on the other years' loads: its latest versions come from
      the existing satellite alone.  All such keys load in one set-based pass.
    * keys seen in several batches are folded year by year with ``sat_load``.

    Sizes come from the writes (a load inserts at most its batch's rows), so no
    join is chosen by counting.
    """
    spark = staged.table.spark
    if sat is None:    # a new satellite: nothing to write or count
        schema = staged.all().select(*cols).schema
        table, start_rows, sat_max = ScratchTable(spark, name, schema), 0, None
    else:
        table = ScratchTable.of(sat.select(*cols), name, sized=True)
        start_rows, sat_max = table.size.rows, table.size.newest
    first_ld = staged.load_dates[staged.years[0]][0] if staged.years else None
    if (staged.years and not staged.undated and len(staged.years) < MOST_BITS and staged.increasing_load_dates()
            and (sat_max is None or sat_max < first_ld)):
        table.append(_fold(staged, table.read() if sat is not None else None, pk, hd, cols))
        return table.read()
    stage = staged.all()
    spans = (stage.where(F.col(pk).isNotNull()).groupBy(pk)
             .agg(F.min("load_date").alias("_first"), F.max("load_date").alias("_last")))
    multi, size = cut_measured(spans.where(F.col("_first") < F.col("_last")).select(pk), f"{name}-multi")
    n_multi = size.rows
    multi_side = checked_broadcast(multi, n_multi)

    # distinct before the join and NULL keys past it: neither a hot user nor the
    # NULL keys then meet in one task of the join
    rows = stage.select(*cols)
    single = (rows.where(F.col(pk).isNotNull()).distinct().join(multi_side, pk, "left_anti").select(*cols)
              .unionByName(rows.where(F.col(pk).isNull()).distinct()))
    total = sum(staged.sizes.values())
    table.append(V.sat_load(single, table.read(), pk, hd, cols,
                            sat_rows=start_rows, batch_rows=total, unique=True))
    if n_multi == 0:
        return table.read()

    def batch_of(year: int) -> DataFrame:
        rows = staged.batch(year).select(*cols).where(F.col(pk).isNotNull()).distinct()
        return rows.join(multi_side, pk, "left_semi").select(*cols)

    def general_step(state: tuple[ScratchTable, int], year: int) -> tuple[ScratchTable, int]:
        tbl, bound = state
        batch_rows = staged.sizes[year]
        tbl.append(V.sat_load(batch_of(year), tbl.read(), pk, hd, cols,
                              sat_rows=bound, batch_rows=batch_rows, unique=True))
        return tbl, bound + batch_rows

    backfill(staged.years, general_step, (table, start_rows + total))
    return table.read()
