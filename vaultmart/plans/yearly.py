"""Yearly runs as in the reference's schedule.

E1 ``run_lake_year``      raw -> ODS partitions of the year -> traffic mart
E2 ``run_vault_year``     ODS -> stage (materialised once) -> 4 hubs -> link -> 2 satellites
E3 ``run_report_year``    vault -> report (materialised once) -> 4 dimensions -> fact
   ``run_combined_year``  E2 then E3 for the same year (the fold Q28 registers)
E4 ``run_second_vault_year``  ODS slice reload -> second vault (4 hubs, transactional
                              link, 3 satellites) -> report variant B -> dimensions -> fact

Vault and report tables are stored by run (``functions.runs``), so each step reads
what the finished runs wrote, like the reference's INSERT INTO ... SELECT loads, and a
run that failed half-way is replaced when its year is run again.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultmart.functions import dates as D
from vaultmart.functions.joins import known_keys
from vaultmart.functions.keys import norm
from vaultmart.functions.lineage import ScratchTable, Written, children, scratch_path, together
from vaultmart.functions.runs import BucketedTable, Runs, RunTable
from vaultmart.operators import marts as M
from vaultmart.operators import ods as O
from vaultmart.operators import second_vault as V2
from vaultmart.operators import vault as V
from vaultmart.sources import schemas as S
from vaultmart.sources import sinks
from vaultmart.sources.lake import scan, scan_year


# ---------------------------------------------------------------- E1

def run_lake_year(stg: dict[str, DataFrame], lake_root: str, year: int) -> None:
    """Overwrite the year's partition of the four ODS tables, then the mart."""
    root = lake_root.rstrip("/")
    loads = {"ods_billing": O.ods_billing, "ods_issue": O.ods_issue,
             "ods_payment": O.ods_payment, "ods_traffic": O.ods_traffic}
    for table, load in loads.items():
        raw = stg[table.replace("ods_", "stg_")]
        sinks.overwrite_partition(load(raw, year), f"{root}/{table}", year, table)
    spark = stg["stg_traffic"].sparkSession
    traffic = scan_year(spark, "ods_traffic", f"{root}/ods_traffic", year)
    sinks.overwrite_partition(M.dm_bytes_received(traffic, year), f"{root}/dm_bytes_received",
                              year, "dm_bytes_received")


def run_lake_backfill(stg: dict[str, DataFrame], lake_root: str) -> None:
    """Every year at once: one pass per table, dynamic partition overwrite."""
    root = lake_root.rstrip("/")
    for table, load in {"ods_billing": O.ods_billing, "ods_issue": O.ods_issue,
                        "ods_payment": O.ods_payment, "ods_traffic": O.ods_traffic}.items():
        sinks.overwrite_partitions(load(stg[table.replace("ods_", "stg_")]), f"{root}/{table}", table,
                                   whole=True)
    spark = stg["stg_traffic"].sparkSession
    traffic = scan(spark, "ods_traffic", f"{root}/ods_traffic")
    sinks.overwrite_partitions(M.dm_bytes_received(traffic), f"{root}/dm_bytes_received",
                               "dm_bytes_received", whole=True)


# ---------------------------------------------------------------- E2
#
# Sizes: every write observes its own rows, so the loads know the sizes of the
# tables and of the batch without counting them.

BILLING_YEAR = "billing_year"       # the partition, below the run, of link and payment satellite


def _at(root: str | None, prefix: str, name: str) -> str | None:
    return f"{root.rstrip('/')}/{prefix}{name}" if root else None


def _current_schema(spec: tuple) -> S.T.StructType:
    pk, hd, _ = spec
    return S.T.StructType([S.T.StructField(pk, S.STRING), S.T.StructField(hd, S.STRING),
                           S.T.StructField("load_date", S.TIMESTAMP)])


def _newest(spec: tuple):
    """What a merge may leave out of a satellite's current versions: the older ones."""
    pk, hd, _ = spec
    return lambda rows: V.newest_per_key(rows, pk, hd)


@dataclass
class Vault:
    hub_user: RunTable
    hub_account: RunTable
    hub_billing_period: RunTable
    hub_pay_doc: RunTable
    link_user_account_billing_pay: RunTable
    sat_user_details: RunTable
    sat_pay_details: RunTable
    current: dict[str, RunTable]        # per satellite: key, hashdiff and date of the newest versions
    runs: Runs

    @classmethod
    def empty(cls, spark: SparkSession, buckets: int | None = None) -> "Vault":
        """``buckets``: store every table bucketed by its hash key (for loads
        where both the batch and the history are too big to broadcast)."""
        return cls.open(spark, None, buckets=buckets)

    @classmethod
    def open(cls, spark: SparkSession, root: str | None, prefix: str = "", buckets: int | None = None) -> "Vault":
        """The vault stored under ``root`` (tables ``prefix`` + name), new or with what
        earlier processes loaded; ``root=None``: a new one that ends with the process."""
        def table(name):
            path = _at(root, prefix, name)
            if buckets:
                return BucketedTable(spark, name, S.REGISTRY[name], VAULT_KEYS[name], buckets, path)
            return RunTable(spark, name, S.REGISTRY[name], path, BY.get(name))

        tables = {name: table(name) for name in VAULT_KEYS}
        current = {name: RunTable(spark, f"current_{name}", _current_schema(spec), _at(root, prefix, f"current_{name}"))
                   for name, spec in V.SATS.items()}
        runs = Runs(spark, {**tables, **{t.name: t for t in current.values()}}, _at(root, prefix, "vault_runs"),
                    shrink={f"current_{name}": _newest(spec) for name, spec in V.SATS.items()})
        return cls(**tables, current=current, runs=runs)

    @property
    def bounds(self) -> dict[str, int]:
        """The rows of every table."""
        return {name: getattr(self, name).rows for name in VAULT_KEYS}


VAULT_KEYS = {**{name: pk for name, (pk, _) in V.HUBS.items()},
              "link_user_account_billing_pay": V.LINK_PK,
              **{name: pk for name, (pk, _, _) in V.SATS.items()}}
BY = {"link_user_account_billing_pay": BILLING_YEAR, "sat_pay_details": BILLING_YEAR, "t_link_payment": BILLING_YEAR}


def _with_billing_year(stage: DataFrame) -> DataFrame:
    # of the normalised key, so that equal hash keys have equal years
    return stage.withColumn(BILLING_YEAR, D.period_key_year(norm("billing_period_key")))


def load_satellite(stage: DataFrame, batch: Written, sat: RunTable, current: RunTable, spec: tuple,
                   whole: bool = False) -> None:
    """One satellite load, and the current versions after it.

    A batch that is not older than anything stored is compared with the current versions,
    and the history is not read; a late one is compared with the history (t8).  Only the
    keys that got versions are written to ``current``."""
    pk, hd, cols = spec
    cols = [*cols, sat.by] if sat.by else cols
    on_time = sat.rows > 0 and batch.oldest is not None and sat.newest is not None and batch.oldest >= sat.newest
    sat.append_shuffled(V.sat_load(stage, sat.read(), pk, hd, cols, sat.rows, batch.rows,
                          current=current.read() if on_time else None, current_rows=current.rows,
                          whole=whole), batch.rows)
    current.append_shuffled(sat.read_run().where(F.col(pk).isNotNull()).select(pk, hd, "load_date").distinct(),
                   sat.sizes[sat.run].rows)


def _known(stage: DataFrame, table: RunTable, pk: str, rows: int) -> tuple[DataFrame, int]:
    """What of a table's keys the stage holds; a bucketed table is joined where it lies."""
    if isinstance(table, BucketedTable):
        return table.read(), table.rows
    return known_keys(stage, table.read(), [pk], table.rows, rows)


def load_hub(stage: DataFrame, table: RunTable, pk: str, keys: list[str], rows: int,
             matching: DataFrame | None = None) -> None:
    """One hub load from a stored stage of at most ``rows`` rows.  ``matching``: the
    part of it that has keys, if that is known."""
    known, n = _known(stage if matching is None else matching, table, pk, rows)
    table.append_shuffled(V.hub_load(stage, known, pk, keys, n, rows), rows)


def load_link(stage: DataFrame, table: RunTable, pk: str, cols: list[str], rows: int,
              matching: DataFrame | None = None) -> None:
    """One link load, as ``load_hub``."""
    cols = [*cols, table.by] if table.by else cols
    known, n = _known(stage if matching is None else matching, table, pk, rows)
    table.append_shuffled(V.link_load(stage, known, pk, cols, n, rows), rows)


def run_vault_year(ods, vault: Vault, year: int) -> Vault:
    """``ods``: the ODS DataFrame, or a function year -> DataFrame that reads only
    that year's partition of a year-partitioned ODS (partition pruning)."""
    ods_year = ods(year) if callable(ods) else ods
    vault.runs.begin(str(year))
    staged = ScratchTable.of(_with_billing_year(V.payment_stage(ods_year, year)), "stage", sized=True)   # read by 7 loaders
    stage, batch = staged.read(), staged.size

    together(*[partial(load_hub, stage, getattr(vault, name), *spec, batch.rows) for name, spec in V.HUBS.items()],
             partial(load_link, stage, vault.link_user_account_billing_pay, V.LINK_PK, V.LINK_COLS, batch.rows),
             *[partial(load_satellite, stage, batch, getattr(vault, name), vault.current[name], spec)
               for name, spec in V.SATS.items()])
    vault.runs.finish()
    staged.drop()
    return vault


# ---------------------------------------------------------------- E3

@dataclass
class Report:
    dims: dict[str, RunTable]
    fact: RunTable | ScratchTable
    runs: Runs
    spec: dict = field(default_factory=lambda: M.DIMS)
    replace_years: bool = False

    @classmethod
    def empty(cls, spark: SparkSession, spec: dict | None = None, replace_years: bool = False) -> "Report":
        return cls.open(spark, None, spec=spec, replace_years=replace_years)

    @classmethod
    def open(cls, spark: SparkSession, root: str | None, prefix: str = "", spec: dict | None = None,
             replace_years: bool = False) -> "Report":
        """The star stored under ``root``, as ``Vault.open``; ``root=None``: a new one.

        Facts are appended, as in the reference, so a rerun of a finished year doubles it
        (t10).  ``replace_years``: the fact is partitioned by billing year, and a
        run replaces its year."""
        spec = spec or M.DIMS
        dims = {name: RunTable(spark, name, S.dim_schema(key, _spark_type(ktype)), _at(root, prefix, name))
                for name, (_, key, ktype) in spec.items()}
        path = _at(root, prefix, "report_fact")
        fact = (ScratchTable(spark, "report_fact", S.REPORT_FACT, ["billing_year_id"], path) if replace_years
                else RunTable(spark, "report_fact", S.REPORT_FACT, path))
        stored = dims if replace_years else {**dims, "report_fact": fact}
        return cls(dims=dims, fact=fact, runs=Runs(spark, stored, _at(root, prefix, "report_runs")), spec=spec,
                   replace_years=replace_years)


def _spark_type(name: str):
    return {"int": S.INT, "string": S.STRING}[name]


def load_star(rep: DataFrame, report: Report, year: int, rows: int | None = None) -> Report:
    """Dimensions, then the fact, from one year's (materialised) report of ``rows`` rows."""
    report.runs.begin(str(year))

    def dim(name, column, key, ktype):
        table = report.dims[name]
        existing = table.read() if table.rows else None          # empty: skip it
        table.append(M.dim_load(rep, existing, column, key, ktype, report_rows=rows))

    together(*[partial(dim, name, *spec) for name, spec in report.spec.items()])
    fact = M.report_fact(rep, {k: t.read() for k, t in report.dims.items()}, report.spec,
                         dim_rows={k: t.rows for k, t in report.dims.items()})
    if report.replace_years:
        _, key, _ = report.spec["dim_billing_year"]
        ids = report.dims["dim_billing_year"].read().where(F.col(key) == year).select("id").collect()  # one row
        report.fact.replace(fact, [r["id"] for r in ids])
    else:
        report.fact.append(fact)
    report.runs.finish()
    return report


def run_report_year(vault: Vault, mdm: DataFrame, report: Report, year: int) -> Report:
    rep = ScratchTable.of(M.payment_report(vault.link_user_account_billing_pay.read(with_by=True),
                                           vault.hub_billing_period.read(), vault.sat_pay_details.read(with_by=True),
                                           vault.hub_user.read(), mdm, year,
                                           hub_bp_rows=vault.hub_billing_period.rows), "report", sized=True)
    load_star(rep.read(), report, year, rep.size.rows)
    rep.drop()
    return report


# ---------------------------------------------------------------- E2 + E3

def run_combined_year(ods, mdm: DataFrame, state: tuple[Vault, Report],
                      year: int) -> tuple[Vault, Report]:
    vault, report = state
    vault = run_vault_year(ods, vault, year)
    return vault, run_report_year(vault, mdm, report, year)


# ---------------------------------------------------------------- E4

UNDATED = "undated"     # the stage's partition of rows without pay_date


SECOND_VAULT = ["hub_user", "hub_account", "hub_payment", "hub_billing_period", "t_link_payment", "sat_user_details",
                "sat_payment_doc_type", "sat_user_as_client"]


@dataclass
class SecondVault:
    ods_root: str
    hub_user: RunTable
    hub_account: RunTable
    hub_payment: RunTable
    hub_billing_period: RunTable
    t_link_payment: RunTable
    sat_user_details: RunTable
    sat_payment_doc_type: RunTable
    sat_user_as_client: RunTable
    current_user_details: RunTable
    report: Report
    runs: Runs
    stage: ScratchTable                    # hash keys of the ODS, partitioned as it is
    staged_from: dict[str, str] = field(default_factory=dict)   # per partition: the ODS files staged
    staged_rows: dict[str, int] = field(default_factory=dict)
    loaded_from: dict[str, str] = field(default_factory=dict)   # per partition: the files this process has loaded

    @classmethod
    def empty(cls, spark: SparkSession) -> "SecondVault":
        return cls.open(spark, None)

    @classmethod
    def open(cls, spark: SparkSession, root: str | None, prefix: str = "") -> "SecondVault":
        """The second vault, its ODS, stage and report stored under ``root``, as ``Vault.open``."""
        tables = {name: RunTable(spark, name, S.REGISTRY[name], _at(root, prefix, name), BY.get(name))
                  for name in SECOND_VAULT}
        spec = V.SATS["sat_user_details"]
        current = RunTable(spark, "current_user_details", _current_schema(spec), _at(root, prefix, "current_user_details"))
        ods_root = _at(root, prefix, "ods_payment") or scratch_path(spark, "ods_payment")
        stage = ScratchTable(spark, "stage_v2", _stage_schema(spark), ["ods_year"], _at(root, prefix, "stage_v2"))
        v = cls(ods_root=ods_root, **tables, current_user_details=current,
                report=Report.open(spark, root, f"{prefix}report_", M.DIMS_B),
                runs=Runs(spark, {**tables, current.name: current}, _at(root, prefix, "vault_runs"),
                          shrink={current.name: _newest(spec)}), stage=stage)
        if stage.written:
            # a stored partition without a note is not trusted: it is staged again, or emptied
            v.staged_from = {name.removeprefix("ods_year="): "unknown" for name in children(spark, stage.path)
                             if name.startswith("ods_year=")}
            for r in _read_notes(stage):
                v.staged_from[r["ods_year"]], v.staged_rows[r["ods_year"]] = r["files"], r["rows"]
        return v

    def drop_stage(self) -> None:
        """Delete the staged hash keys; the next run stages the whole ODS again."""
        self.stage.drop()
        self.staged_from, self.staged_rows = {}, {}


def _staged_v2(ods: DataFrame, load_date: str) -> DataFrame:
    """The stage of some ODS partitions, by their year."""
    stage = _with_billing_year(V2.payment_stage_v2(ods, load_date))
    return stage.withColumn("ods_year", F.coalesce(F.year("pay_date").cast("string"), F.lit(UNDATED)))


def _stage_schema(spark: SparkSession) -> S.T.StructType:
    return _staged_v2(spark.createDataFrame([], S.ODS_PAYMENT), "1970-01-01 00:00:00").schema


NOTES = S.T.StructType([S.T.StructField("ods_year", S.STRING), S.T.StructField("files", S.STRING),
                        S.T.StructField("rows", S.BIGINT)])


def _read_notes(stage: ScratchTable) -> list:
    """What the stage's partitions were made from (a row a year); none: nothing is known."""
    notes = ScratchTable(stage.spark, "notes", NOTES, path=f"{stage.path}_notes")
    return notes.read().collect()


def _ods_files(spark: SparkSession, root: str) -> dict[str, str]:
    """Per ODS partition the names and sizes of its files.  Every write makes new names, so
    equal names mean the same rows."""
    out = {}
    for folder in children(spark, root):
        if folder.startswith("year="):
            files = {k: v for k, v in children(spark, f"{root}/{folder}").items() if k.startswith("part-") and v}
            year = folder.removeprefix("year=")
            out[UNDATED if year == "__HIVE_DEFAULT_PARTITION__" else year] = json.dumps(files, sort_keys=True)
    return out


def _restage(v: SecondVault, load_date: str) -> None:
    """Stage the ODS partitions whose files are not those the stage was made from: in a
    running process those the run has reloaded, after ``open`` also those that another
    process has changed or staged without noting it."""
    spark = v.stage.spark
    files = _ods_files(spark, v.ods_root)
    changed = [year for year in {**files, **v.staged_from} if files.get(year) != v.staged_from.get(year)]
    if not changed:
        return
    # an unnoted partition is staged again: the note comes after the rows
    ods = scan(spark, "ods_payment", v.ods_root).where(F.coalesce("year", F.lit(UNDATED)).isin(changed))
    rows = _staged_v2(ods, load_date)
    size = v.stage.replace(rows, changed)
    for year in changed:
        v.staged_from.pop(year, None)
        v.staged_rows.pop(year, None)
        if year in files:
            # a bound: the rows staged with this year
            v.staged_from[year], v.staged_rows[year] = files[year], size.rows
    notes = [(year, v.staged_from[year], v.staged_rows[year]) for year in v.staged_from]
    spark.createDataFrame(notes, NOTES).coalesce(1).write.mode("overwrite").parquet(f"{v.stage.path}_notes")


def run_second_vault_year(stg: DataFrame, mdm: DataFrame, v: SecondVault, year: int,
                          mdm_rows: int | None = None) -> SecondVault:
    """One run of the combined DAG.  Its load views take no year: every run
    loads the whole (reloaded) ODS with the run's LOAD_DATE.  ``mdm_rows``: the rows of
    the master data, where known."""
    load_date = f"{year:04d}-01-01 00:00:00"
    v.runs.begin(str(year))
    # slice reload (DELETE the year, INSERT the year) as one partition overwrite:
    # O(one year) written, other years and NULL-dated rows untouched
    sinks.overwrite_partition(O.ods_payment(stg, year), v.ods_root, year, "ods_payment")
    # hashed once per reload: the rows of other years keep their keys, so a run
    # stages only what it reloaded and gives all rows its own LOAD_DATE
    _restage(v, load_date)
    stage = v.stage.read().withColumn("load_date", D.ts_literal(load_date))
    n = sum(v.staged_rows.values())                  # a bound
    batch = Written(n, 0, D.year_start_datetime(year), D.year_start_datetime(year))

    # hubs and link hold every key of a partition that a finished run has loaded, so of
    # such partitions only NULL keys, which every run loads (t5), can have rows to insert
    loaded = [y for y, files in v.staged_from.items() if v.loaded_from.get(y) == files]
    known_years = F.col("ods_year").isin(loaded)

    def unseen(pk):
        if not loaded:
            return stage
        return stage.where(~known_years).unionByName(stage.where(known_years & F.col(pk).isNull()))

    def hub(name, pk, keys):
        load_hub(unseen(pk), getattr(v, name), pk, keys, n, stage.where(~known_years))

    def clients():
        hub("hub_user", *V.HUBS["hub_user"])       # a client is stored once the hub knows the user
        sat = v.sat_user_as_client
        sat.append_shuffled(V2.sat_user_as_client(mdm, v.hub_user.read(), sat.read(), load_date,
                                         on_time=sat.newest is not None and sat.newest <= batch.newest,
                                         sat_rows=sat.rows, batch_rows=mdm_rows), mdm_rows)

    together(clients, partial(load_link, unseen("pay_pk"), v.t_link_payment, "pay_pk", V2.T_LINK_COLS, n,
                              stage.where(~known_years)),
             partial(hub, "hub_account", *V.HUBS["hub_account"]),
             partial(hub, "hub_payment", "pay_pk", ["pay_doc_type_id", "pay_doc_num"]),
             partial(hub, "hub_billing_period", *V.HUBS["hub_billing_period"]),
             partial(load_satellite, stage, batch, v.sat_user_details, v.current_user_details, V.SATS["sat_user_details"],
                     whole=True),
             lambda: v.sat_payment_doc_type.append(V2.sat_payment_doc_type(
                 stage, v.sat_payment_doc_type.read(), v.sat_payment_doc_type.rows, n)))
    v.runs.finish()
    v.loaded_from = dict(v.staged_from)
    rep = ScratchTable.of(M.payment_report_client(v.t_link_payment.read(with_by=True), v.hub_billing_period.read(),
                                                  v.hub_user.read(), v.sat_user_as_client.read(), year,
                                                  hub_bp_rows=v.hub_billing_period.rows), "report_v2", sized=True)
    load_star(rep.read(), v.report, year, rep.size.rows)
    rep.drop()
    return v
