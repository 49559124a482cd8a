"""Sinks (S4, S5).

``overwrite_partition`` is Hive's ``INSERT OVERWRITE TABLE t PARTITION
(year='Y') SELECT ...``: exactly that partition is replaced, even by an empty
result, and the other years stay as they were.  Rows are written with dynamic
partition overwrite: Spark stages the new files and swaps the partition when the
job commits, so a job that fails half-way leaves the old year.  Only a result that
has turned out empty replaces the partition in place.

``overwrite_partitions`` is the backfill form: every year present in the
DataFrame replaced in one job, and with ``whole`` every other year emptied.  Rows
are rebalanced by year first (AQE splits large years), so a year gets a few files,
not one a task.

Either writes its input once: the write itself counts the rows of the partitions that
may have to be emptied.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultmart.functions.lineage import children, replace_partitions
from vaultmart.sources.schemas import REGISTRY


def overwrite_partition(df: DataFrame, root: str, year: int, table: str | None = None) -> None:
    cols = REGISTRY[table].fieldNames() if table else [c for c in df.columns if c != "year"]
    out = (df.where(F.col("year") == F.lit(str(year))) if "year" in df.columns else df).select(*cols)
    replace_partitions(out.withColumn("year", F.lit(str(year))), root, "year", [str(year)])


def overwrite_partitions(df: DataFrame, root: str, table: str | None = None, whole: bool = False) -> None:
    cols = REGISTRY[table].fieldNames() if table else [c for c in df.columns if c != "year"]
    gone = _years(df.sparkSession, root) if whole else set()
    replace_partitions(df.select(*cols, "year").hint("rebalance", "year"), root, "year", sorted(gone))


def _years(spark: SparkSession, root: str) -> set[str]:
    """The years that the table at ``root`` has a partition of."""
    return {name.removeprefix("year=") for name in children(spark, root) if name.startswith("year=")
            and name != "year=__HIVE_DEFAULT_PARTITION__"}
