"""Warehouse tables stored by run, and the log of the runs that have finished.

The reference runs each insert as one transaction; a yearly run has a dozen of them.
Here every row a run inserts lies in that run's own partition, ``table/run=<id>/``, and
a run counts once the log says so.  A run that failed half-way has left rows in some
tables: the next run first deletes the partitions of runs that never finished, so a
year can simply be run again (``Runs.begin``).  A year that *has* finished and is run
again gets an id of its own and adds rows, as in the reference (t5, t7, t10).

The log also keeps what each write saw of itself (rows, bytes, load dates), so the sizes
that later plans depend on are known without counting anything.

Rows are rebalanced before they are written (AQE sizes the files), and small finished
runs are merged (``Runs.merge``): the merged partition is written under a hidden name,
entered in the log, and then takes the place of the runs it holds.  A process that
dies in between leaves either the old partitions or the new one to be seen: ``begin``
completes what the log says.

One process at a time may load into a table (as the reference's ``max_active_runs=1``).
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultmart.functions.joins import is_small
from vaultmart.functions.lineage import (ScratchTable, Written, _exists, children, delete, file_system, measured,
                                         together)

RUN = "run"
FILE_BYTES_CONF, FILE_BYTES = "vaultmart.files.targetBytes", 128 * 1024 * 1024
FAN_IN = 4               # so many small finished runs are merged into one
LOG = T.StructType([T.StructField(n, t) for n, t in (
    ("run", T.StringType()), ("table", T.StringType()), ("rows", T.LongType()), ("bytes", T.LongType()),
    ("oldest", T.TimestampNTZType()), ("newest", T.TimestampNTZType()), ("covers", T.StringType()))])


class RunTable(ScratchTable):
    """A table whose rows lie in one partition per run.

    ``by``: an integer column that the rows written have beside the schema's; it becomes
    a second partition level below the run.  ``read(with_by=True)`` returns it, and a
    filter on it prunes files.
    """

    mergeable = True

    def __init__(self, spark: SparkSession, name: str, schema: T.StructType, path: str | None = None,
                 by: str | None = None):
        super().__init__(spark, name, schema, None, path)
        self.name, self.by = name, by
        self.run = "all"                        # the run that appends now
        self.sizes: dict[str, Written] = {}
        self.most: int | None = None            # see append_shuffled

    def append_shuffled(self, df: DataFrame, most: int | None) -> None:
        """``append`` of at most ``most`` rows that come out of a shuffle: many are written
        as they are, since AQE has sized its partitions, and are not shuffled again."""
        self.most = most
        self.append(df)

    def append(self, df: DataFrame) -> None:
        """The rows of the current run: they replace what it may have written before."""
        most, self.most = self.most, None
        self.sizes[self.run] = self._write(df, f"{self.path}/{RUN}={self.run}", most)
        self.written = True

    def _write(self, df: DataFrame, path: str, most: int | None = None) -> Written:
        parts = [self.by] if self.by else []
        rows = df.select(*self.schema.fieldNames(), *parts)

        def write(seen: DataFrame) -> None:
            # static: the run's folder holds what this write puts there, and nothing else
            (seen.write.mode("overwrite").option("partitionOverwriteMode", "static")
                 .partitionBy(*parts).parquet(path))

        as_it_is = most is not None and not is_small(rows, most)
        return measured(rows if as_it_is else rows.hint("rebalance", *parts), write)[0]

    def read(self, with_by: bool = False, runs: list[str] | None = None) -> DataFrame:
        names = self.schema.fieldNames()
        schema = T.StructType([*self.schema.fields, T.StructField(RUN, T.StringType())])
        if self.by:
            schema = schema.add(self.by, T.IntegerType())
        names = [*names, self.by] if with_by and self.by else names
        if not self.written:
            return self.spark.createDataFrame([], schema).select(*names)
        rows = self.spark.read.schema(schema).parquet(self.path)
        return (rows if runs is None else rows.where(F.col(RUN).isin(runs))).select(*names)

    def read_run(self) -> DataFrame:
        """What the current run has written."""
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/{RUN}={self.run}")

    # ------------------------------------------------------------ for the log

    def stored_runs(self) -> set[str]:
        return {name.removeprefix(f"{RUN}=") for name in children(self.spark, self.path) if name.startswith(f"{RUN}=")}

    def undo(self, run: str) -> None:
        delete(self.spark, f"{self.path}/{RUN}={run}")
        self.sizes.pop(run, None)

    def hidden(self, run: str) -> str:
        return f"{self.path}/_merged-{run}"

    def write_merged(self, runs: list[str], into: str, shrink: Callable[[DataFrame], DataFrame] | None) -> Written:
        rows = self.read(with_by=True, runs=runs)
        return self._write(shrink(rows) if shrink else rows, self.hidden(into))

    def swap_in(self, runs: list[str], into: str) -> None:
        """Show the merged partition, then delete the runs it holds."""
        fs, at = file_system(self.spark, self.hidden(into))
        shown = file_system(self.spark, f"{self.path}/{RUN}={into}")[1]
        if fs.exists(at) and not fs.exists(shown):
            fs.rename(at, shown)
        if not fs.exists(shown):
            raise RuntimeError(f"{shown} is in the log of runs, but not there")
        for run in runs:
            self.undo(run)

    @property
    def rows(self) -> int:
        return sum(w.rows for w in self.sizes.values())

    @property
    def newest(self):
        return max((w.newest for w in self.sizes.values() if w.newest is not None), default=None)


class BucketedTable(RunTable):
    """A run table bucketed (and sorted) by its hash key.

    A vault table that grows for ever is joined by its key on every load.  Stored
    bucketed, a sort-merge join against it shuffles only the other side: the history
    itself never moves.  The files lie at the table's path; the bucketing is metadata,
    which every session that opens the path registers again over the same files.
    """

    mergeable = False        # a bucket's files are read together as they are

    def __init__(self, spark: SparkSession, name: str, schema: T.StructType, key: str, buckets: int,
                 path: str | None = None):
        super().__init__(spark, name, schema, path)
        self.key, self.buckets = key, buckets
        self.table_name = f"vaultmart_{name}_{hashlib.md5(self.path.encode()).hexdigest()[:12]}"
        if self.written:
            self._register()

    def _register(self) -> None:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table_name} ({columns}, {RUN} string) USING parquet "
                       f"PARTITIONED BY ({RUN}) CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) "
                       f"INTO {self.buckets} BUCKETS LOCATION '{self.path}'")
        if self.written:
            self.spark.sql(f"ALTER TABLE {self.table_name} RECOVER PARTITIONS")

    def append(self, df: DataFrame) -> None:
        if not self.written:
            self._register()
        self.undo(self.run)
        rows = df.select(*self.schema.fieldNames()).withColumn(RUN, F.lit(self.run))

        def write(seen: DataFrame) -> None:
            (seen.write.mode("append").format("parquet").partitionBy(RUN)
                 .bucketBy(self.buckets, self.key).sortBy(self.key).option("path", self.path)
                 .saveAsTable(self.table_name))

        # one file a bucket: the rows of a bucket meet in one task
        self.sizes[self.run] = measured(rows.repartition(self.buckets, self.key), write)[0]
        self.written = True

    def read(self, with_by: bool = False, runs: list[str] | None = None) -> DataFrame:
        if not self.written:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.table(self.table_name).select(*self.schema.fieldNames())

    def undo(self, run: str) -> None:
        super().undo(run)
        if self.written:
            self.spark.sql(f"ALTER TABLE {self.table_name} DROP IF EXISTS PARTITION ({RUN} = '{run}')")
            self.spark.catalog.refreshTable(self.table_name)


class Runs:
    """The finished runs of some tables; ``path``: where their log is kept (None: a new one
    that ends with the process)."""

    def __init__(self, spark: SparkSession, tables: dict[str, RunTable], path: str | None = None,
                 shrink: dict[str, Callable[[DataFrame], DataFrame]] | None = None):
        """``shrink``: per table, what may be left out when its runs are merged."""
        self.spark, self.tables, self.path = spark, tables, path
        self.shrink = shrink or {}
        self.finished: set[str] = set()
        self.merged: dict[tuple[str, str], list[str]] = {}       # (table, run) -> the runs it holds
        self.target = int(spark.conf.get(FILE_BYTES_CONF, str(FILE_BYTES)))
        if path is not None and _exists(spark, path):
            for r in spark.read.schema(LOG).parquet(path).collect():          # a row per run and table
                self._enter(r["table"], r["run"], Written(r["rows"], r["bytes"], r["oldest"], r["newest"]), r["covers"])
        self.recover()

    def _enter(self, table: str, run: str, size: Written, covers: str | None) -> None:
        if covers is None:
            self.finished.add(run)
        else:
            self.merged[table, run] = covers.split(",")
        if table in self.tables:
            self.tables[table].sizes[run] = size

    def _log(self, entries: list[tuple]) -> None:
        if self.path is not None:
            rows = [(run, table, w.rows, w.bytes, w.oldest, w.newest, covers) for run, table, w, covers in entries]
            self.spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").parquet(self.path)

    def recover(self) -> None:
        """Complete the merges the log knows, delete what unfinished runs have left."""
        for name, table in self.tables.items():
            stored = table.stored_runs()
            for (owner, into), runs in self.merged.items():
                if owner == name:
                    if stored & set(runs):
                        table.swap_in(runs, into)
                    for run in runs:
                        table.sizes.pop(run, None)
            for run in (stored | set(table.sizes)) - self.finished:
                if (name, run) not in self.merged:
                    table.undo(run)

    def begin(self, label: str) -> str:
        """Start the run ``label``, or the first repetition of it that has not finished."""
        self.recover()
        self.merge()
        run, nth = label, 1
        while run in self.finished:
            nth += 1
            run = f"{label}.{nth}"
        for table in self.tables.values():
            table.run = run
        self.run = run
        return run

    def finish(self) -> None:
        """One write makes all of the run count."""
        self._log([(self.run, name, t.sizes[self.run], None) for name, t in self.tables.items() if self.run in t.sizes])
        self.finished.add(self.run)

    def merge(self) -> None:
        """Merge the small finished runs of every table that has ``FAN_IN`` of them."""
        jobs = {}
        for name, table in self.tables.items():
            small = sorted(run for run, w in table.sizes.items() if w.bytes < self.target)
            if len(small) >= FAN_IN and table.mergeable:
                jobs[name] = small
        if not jobs:
            return
        into = f"merged-{sum(len(covered) for covered in self.merged.values()) + 1}"
        sizes: dict[str, Written] = {}

        def one(name: str) -> None:
            delete(self.spark, self.tables[name].hidden(into))
            sizes[name] = self.tables[name].write_merged(jobs[name], into, self.shrink.get(name))

        together(*[lambda name=name: one(name) for name in jobs])
        self._log([(into, name, sizes[name], ",".join(runs)) for name, runs in jobs.items()])
        for name, runs in jobs.items():
            table = self.tables[name]
            table.swap_in(runs, into)
            table.sizes[into] = sizes[name]
            self.merged[name, into] = runs
