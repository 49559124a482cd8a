"""Lineage cuts for iterative (year-by-year) plans.

A fold whose step reads the previous result would re-plan and re-run every
earlier year without a cut.  Two kinds of cut, both in the session's reliable
checkpoint directory (a shared folder on a cluster, read from
``spark.checkpoint.dir``), so a lost executor costs a re-read, not a
recomputation of the whole history:

* ``cut(df)``: write an intermediate result once, read it back;
* ``ScratchTable``: a Parquet table that a fold appends to year after year,
  like the warehouse tables of the reference; reads get column pruning,
  filter pushdown and partition pruning.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultmart.session import checkpoint_dir


FREE_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession):
    """The shuffle files of what is written inside go when its write ends, and do not wait
    for the driver's garbage collector."""
    before = spark.conf.get(FREE_CONF, None)
    spark.conf.set(FREE_CONF, "true")
    try:
        yield
    finally:
        spark.conf.unset(FREE_CONF) if before is None else spark.conf.set(FREE_CONF, before)


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """Materialise ``df`` reliably (one job: a Parquet write into the
    checkpoint folder) and return a DataFrame reading it back."""
    return ScratchTable.of(df, name).read()


@dataclass(frozen=True)
class Written:
    """What a write saw of its own rows: no job of its own counted them."""
    rows: int
    bytes: int                                  # of the values, in memory
    oldest: dt.datetime | None = None           # load dates, where the rows have one
    newest: dt.datetime | None = None


def _value_bytes(df: DataFrame) -> Column:
    total = F.lit(0).cast("long")
    for name, kind in df.dtypes:
        size = F.coalesce(F.octet_length(name), F.lit(0)) if kind in ("string", "binary") else F.lit(8)
        total = total + size
    return F.coalesce(F.sum(total), F.lit(0))


def measured(df: DataFrame, write: Callable[[DataFrame], None], **more: Column) -> tuple[Written, dict]:
    """``write(df)`` with its rows and bytes observed on the way (and the aggregates of
    ``more``); nothing is computed a second time."""
    seen = Observation()
    dates = {"oldest": F.min("load_date"), "newest": F.max("load_date")} if "load_date" in df.columns else {}
    values = {"rows": F.count(F.lit(1)), "bytes": _value_bytes(df), **dates, **more}
    write(df.observe(seen, *[c.alias(name) for name, c in values.items()]))
    got = seen.get
    return (Written(got["rows"], got["bytes"], got.get("oldest"), got.get("newest")),
            {name: got[name] for name in more})


def cut_measured(df: DataFrame, name: str = "cut") -> tuple[DataFrame, Written]:
    """``cut`` and what its write saw."""
    table = ScratchTable.of(df, name, sized=True)
    return table.read(), table.size


def together(*loads: Callable[[], None]) -> None:
    """Run independent loads at the same time, so that the jobs of one fill the
    cores that another leaves idle; the first error is raised once all ended."""
    with ThreadPoolExecutor(len(loads)) as pool:
        started = [pool.submit(load) for load in loads]
    for load in started:
        load.result()


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.schema("_ int").parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def file_system(spark: SparkSession, path: str):
    """(the file system that holds ``path``, the path as it knows it)."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def delete(spark: SparkSession, path: str) -> None:
    fs, at = file_system(spark, path)
    fs.delete(at, True)


def children(spark: SparkSession, path: str) -> dict[str, int]:
    """Name and size of what a folder holds (none: no such folder)."""
    fs, at = file_system(spark, path)
    if not fs.exists(at):
        return {}
    return {s.getPath().getName(): s.getLen() for s in fs.listStatus(at)}


def replace_partitions(df: DataFrame, path: str, column: str, emptied: list) -> Written:
    """Replace the partitions of ``column`` that ``df`` has rows of: Spark stages the
    new files and swaps them in when the job commits, so a job that fails leaves the
    old ones.  Partitions in ``emptied`` that get no rows are emptied after it.  ``df``
    is computed once: its write counts the rows of those partitions."""
    def write(rows: DataFrame) -> None:
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(column).parquet(path))

    size, rows = measured(df, write, **{f"in_{v}": F.count_if(F.col(column) == F.lit(v)) for v in emptied})
    for value in emptied:
        if not rows[f"in_{value}"]:
            df.drop(column).limit(0).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{column}={value}")
    return size


class ScratchTable:
    """An append-only Parquet table under the checkpoint directory.

    Nothing is written until the first append; until then ``read()`` is an
    empty DataFrame of the declared schema.
    """

    def __init__(self, spark: SparkSession, name: str, schema: T.StructType,
                 partition_by: list[str] | None = None, path: str | None = None):
        self.spark = spark
        self.schema = schema
        self.partition_by = partition_by or []
        self.path = path or scratch_path(spark, name)
        # a table opened at its path has what earlier processes wrote there
        self.written = path is not None and _exists(spark, path)
        self.size: Written | None = None        # of a table written once, if asked for

    @classmethod
    def of(cls, df: DataFrame, name: str, partition_by: list[str] | None = None,
           sized: bool = False) -> "ScratchTable":
        table = cls(df.sparkSession, name, df.schema, partition_by)
        if sized:
            table.size, _ = measured(df.select(*table.schema.fieldNames()), table.append)
        else:
            table.append(df)
        return table

    def append(self, df: DataFrame) -> None:
        writer = df.select(*self.schema.fieldNames()).write.mode("append")
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        writer.parquet(self.path)
        self.written = True

    def replace(self, df: DataFrame, gone: list | None = None) -> Written:
        """Replace the partitions that ``df`` has rows of (staged, swapped when the
        job commits); those of ``gone`` that it has none of are emptied."""
        (column,) = self.partition_by
        self.written = True
        return replace_partitions(df.select(*self.schema.fieldNames()), self.path, column, gone or [])

    def drop(self) -> None:
        """Delete the table's files; for intermediate results that nothing reads again."""
        delete(self.spark, self.path)
        self.written = False

    def read(self) -> DataFrame:
        if not self.written:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self.path).select(*self.schema.fieldNames())


