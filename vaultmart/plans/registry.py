"""The registered queries: one per operator of SURVEY section 2.7.

Each takes ``(spark, sf_dir)``, derives the raw tables from the test tables
with Spark (``sources.fixtures``) and runs over all of them:

* lake loads (Q01-Q05) load every year at once (the backfill form);
* vault loads (Q10-Q18) load every year 1995.. in order into empty tables
  and return the final table: hubs and links in one set-based pass,
  satellites by the year-by-year fold;
* report and star (Q21-Q27) cover every billing year;
* the second vault (Q14, Q16, Q19, Q20, Q22) is one run over the whole ODS,
  as its views take no year;
* the ``_year`` entries are the lake loads' yearly form;
* the ``_two_batches`` entries load a target with one batch and then with a second
  that overlaps it (the year OVERLAP) and repeats its NULL keys;
* Q28 is the reference's schedule itself: the combined vault + report run
  folded over every year, returning the fact table (same rows as Q27).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultmart.functions.lineage import ScratchTable, cut, cut_measured, scratch_path
from vaultmart.operators import marts as M
from vaultmart.operators import ods as O
from vaultmart.operators import second_vault as V2
from vaultmart.operators import vault as V
from vaultmart.plans import backfill as B
from vaultmart.plans import yearly as Y
from vaultmart.session import configure
from vaultmart.sources import fixtures
from vaultmart.sources import schemas as S
from vaultmart.sources import sinks
from vaultmart.sources.lake import scan, scan_year

# Parameters of the registered runs (the oracle uses the same values).
RELOAD_YEAR = 1998
V2_LOAD_DATE = "2002-01-01 00:00:00"
V1_VIEW_LOAD_DATE = "2002-01-01"
LAKE_YEAR, EVENT_YEAR = 1998, 2024      # of the yearly lake loads
OVERLAP = 1997                          # the year that both of two batches hold


def _raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return fixtures.raw(spark, sf_dir, name)


def _empty(spark: SparkSession, table: str) -> DataFrame:
    return spark.createDataFrame([], S.REGISTRY[table])


def _ods(spark, sf_dir) -> DataFrame:
    return O.ods_payment_copy(_raw(spark, sf_dir, "stg_payment"))


def _stage_all(spark, sf_dir) -> DataFrame:
    return V.payment_stage(_ods(spark, sf_dir))


# ---------------------------------------------------------------- ODS and traffic mart

def q01(spark, sf_dir):
    return O.ods_billing(_raw(spark, sf_dir, "stg_billing"))


def q02(spark, sf_dir):
    return O.ods_issue(_raw(spark, sf_dir, "stg_issue"))


def q03(spark, sf_dir):
    return O.ods_payment(_raw(spark, sf_dir, "stg_payment"))


def q04(spark, sf_dir):
    return O.ods_traffic(_raw(spark, sf_dir, "stg_traffic"))


def q05(spark, sf_dir):
    return M.dm_bytes_received(q04(spark, sf_dir))


def _typed_ods(spark, sf_dir) -> DataFrame:
    """The warehouse's ODS: a copy of the typed payment source."""
    return O.ods_payment_copy(_raw(spark, sf_dir, "stg_payment_typed"))


def q06(spark, sf_dir):
    return _typed_ods(spark, sf_dir)


def s02(spark, sf_dir):
    """S2: the typed payments as files in one folder per document type, read by a glob."""
    root = scratch_path(spark, "payment")
    (_raw(spark, sf_dir, "stg_payment_typed").withColumn("kind", F.coalesce("pay_doc_type", F.lit("none")))
     .hint("rebalance", "kind").write.partitionBy("kind").parquet(root))
    return O.ods_payment_copy(scan(spark, "stg_payment_typed", f"{root}/*/"))


def q07(spark, sf_dir):
    """Reload of a year whose rows in ODS are stale: half are missing, and the
    sums of the others are out of date."""
    ods = _typed_ods(spark, sf_dir)
    reloaded = F.year("pay_date") == RELOAD_YEAR
    stale = (ods.where(F.col("pay_date").isNull() | ~reloaded | (F.col("user_id") % 2 == 0))
             .withColumn("sum", F.when(reloaded, F.col("sum") + 1).otherwise(F.col("sum")).cast(S.MONEY)))
    return O.ods_payment_reload(stale, _raw(spark, sf_dir, "stg_payment_typed"), RELOAD_YEAR)


def _year(load, stg, year):
    return lambda spark, sf_dir: load(_raw(spark, sf_dir, stg), year)


def q05_year(spark, sf_dir):
    return M.dm_bytes_received(O.ods_traffic(_raw(spark, sf_dir, "stg_traffic"), EVENT_YEAR), EVENT_YEAR)


# ---------------------------------------------------------------- first vault

def q08(spark, sf_dir):
    return _stage_all(spark, sf_dir)


def q09(spark, sf_dir):
    return V.payment_stage_all(_ods(spark, sf_dir), V1_VIEW_LOAD_DATE)


def _hub(name):
    def run(spark, sf_dir):
        pk, keys = V.HUBS[name]
        return V.hub_backfill(_stage_all(spark, sf_dir), _empty(spark, name), pk, keys,
                              hub_rows=0)
    run.__name__ = name
    return run


def q15(spark, sf_dir):
    return V.link_backfill(_stage_all(spark, sf_dir),
                           _empty(spark, "link_user_account_billing_pay"), V.LINK_PK, V.LINK_COLS,
                           link_rows=0)


def _sat(name):
    def run(spark, sf_dir):
        pk, hd, cols = V.SATS[name]
        staged = B.StagedBatches(_stage_all(spark, sf_dir), cols=cols)
        return B.sat_backfill(staged, None, pk, hd, cols, name)
    run.__name__ = name
    return run


# ---------------------------------------------------------------- report star (variant A)

def _vault_all(spark, sf_dir) -> tuple[dict[str, DataFrame], int]:
    """The first vault after loading every year, built set-based where exact, and the
    rows of its billing-period hub."""
    pk, hd, sat_cols = V.SATS["sat_pay_details"]
    needed = [*V.LINK_COLS, *sat_cols, "user_key", "billing_period_key"]
    staged = B.StagedBatches(_stage_all(spark, sf_dir), cols=needed)
    stage = staged.all()
    out = {name: V.hub_backfill(stage, _empty(spark, name), pk, keys, hub_rows=0)
           for name, (pk, keys) in V.HUBS.items() if name in ("hub_user", "hub_billing_period")}
    out["link"] = V.link_backfill(stage, _empty(spark, "link_user_account_billing_pay"),
                                  V.LINK_PK, V.LINK_COLS, link_rows=0)
    out["sat_pay_details"] = B.sat_backfill(staged, None, pk, hd, sat_cols, "sat_pay_details")
    out["hub_billing_period"], size = cut_measured(out["hub_billing_period"], "hub_billing_period")
    return out, size.rows


def q21(spark, sf_dir):
    v, periods = _vault_all(spark, sf_dir)
    return M.payment_report(v["link"], v["hub_billing_period"], v["sat_pay_details"],
                            v["hub_user"], _raw(spark, sf_dir, "mdm_user"), hub_bp_rows=periods)


def _report_all(spark, sf_dir) -> tuple[DataFrame, int]:
    """The report over every billing year, materialised, with its row count
    (a bound on every dimension built from it)."""
    report, size = cut_measured(q21(spark, sf_dir), "report")
    return report, size.rows


def _dim(name):
    def run(spark, sf_dir):
        column, key, ktype = M.DIMS[name]
        report, n = _report_all(spark, sf_dir)
        return M.dim_backfill(report, None, column, key, ktype, report_rows=n)
    run.__name__ = name
    return run


def q27(spark, sf_dir):
    report, n = _report_all(spark, sf_dir)
    dims = {name: M.dim_backfill(report, None, column, key, ktype, report_rows=n)
            for name, (column, key, ktype) in M.DIMS.items()}
    return M.report_fact(report, dims, dim_rows={name: n for name in dims})


def q28(spark, sf_dir):
    """The reference's schedule: E2 + E3 for each year in turn; the fact table."""
    configure(spark)
    # the lake's ODS: written once, partitioned by year; each yearly run reads
    # only its own partition
    root = scratch_path(spark, "ods_payment")
    sinks.overwrite_partitions(O.ods_payment(_raw(spark, sf_dir, "stg_payment")), root,
                               "ods_payment")
    years = sorted(int(r["year"]) for r in scan(spark, "ods_payment", root)
                   .select("year").distinct().collect())

    def ods_of(year: int) -> DataFrame:
        return scan_year(spark, "ods_payment", root, year).drop("year")

    mdm = cut(_raw(spark, sf_dir, "mdm_user"), "mdm_user")   # read by every yearly report
    state = (Y.Vault.empty(spark), Y.Report.empty(spark))
    _, report = B.backfill(years, lambda st, y: Y.run_combined_year(ods_of, mdm, st, y), state)
    return report.fact.read()


def q29(spark, sf_dir):
    """The combined DAG (E4) folded over every year: reload, second vault,
    report variant B, star; the fact table."""
    configure(spark)
    stg = cut(_raw(spark, sf_dir, "stg_payment_typed"), "stg_payment")   # read by every reload
    mdm, size = cut_measured(_raw(spark, sf_dir, "mdm_user"), "mdm_user")
    years = B.batch_years(V.payment_stage(O.ods_payment_copy(stg)))
    v2 = B.backfill(years, lambda st, y: Y.run_second_vault_year(stg, mdm, st, y, size.rows),
                    Y.SecondVault.empty(spark))
    v2.drop_stage()
    return v2.report.fact.read()


# ---------------------------------------------------------------- second vault

def _stage_v2(spark, sf_dir):
    return V2.payment_stage_v2(_typed_ods(spark, sf_dir), V2_LOAD_DATE)


def q14(spark, sf_dir):
    return V2.hub_payment(_stage_v2(spark, sf_dir), _empty(spark, "hub_payment"), hub_rows=0)


def q16(spark, sf_dir):
    return V2.t_link_payment(_stage_v2(spark, sf_dir), _empty(spark, "t_link_payment"),
                             link_rows=0)


def q19(spark, sf_dir):
    return V2.sat_payment_doc_type(_stage_v2(spark, sf_dir), _empty(spark, "sat_payment_doc_type"),
                                   sat_rows=0)


def _v2_hubs(spark, stage):
    hu = V.hub_load(stage, _empty(spark, "hub_user"), *V.HUBS["hub_user"], hub_rows=0)
    hbp = V.hub_load(stage, _empty(spark, "hub_billing_period"), *V.HUBS["hub_billing_period"],
                     hub_rows=0)
    return hu, hbp


def q20(spark, sf_dir):
    stage = _stage_v2(spark, sf_dir)
    hu, _ = _v2_hubs(spark, stage)
    return V2.sat_user_as_client(_raw(spark, sf_dir, "mdm_user"), hu,
                                 _empty(spark, "sat_user_as_client"), V2_LOAD_DATE, sat_rows=0)


def q22(spark, sf_dir):
    stage = cut(_stage_v2(spark, sf_dir))
    hu, hbp = _v2_hubs(spark, stage)
    hbp, periods = cut_measured(hbp, "hub_billing_period")
    tlink = V2.t_link_payment(stage, _empty(spark, "t_link_payment"), link_rows=0)
    client = V2.sat_user_as_client(_raw(spark, sf_dir, "mdm_user"), hu,
                                   _empty(spark, "sat_user_as_client"), V2_LOAD_DATE, sat_rows=0)
    return M.payment_report_client(tlink, hbp, hu, client, hub_bp_rows=periods.rows)


# ---------------------------------------------------------------- two batches into one target

def _after(target: DataFrame, inserted: DataFrame) -> DataFrame:
    return target.unionByName(inserted)


def _two(stage_of, load, name):
    """A target after a batch of all years to OVERLAP and one of all from it.  ``load``
    takes the sizes of the target and of the batch."""
    def run(spark, sf_dir):
        early, late = stage_of(spark, sf_dir)
        target, loaded = cut_measured(load(early, _empty(spark, name), 0, None), name)
        staged = ScratchTable.of(late, "stage", sized=True)
        return _after(target, load(staged.read(), target, loaded.rows, staged.size.rows))
    return run


def _two_stages(ods_of, stage):
    def stages(spark, sf_dir):
        ods = ods_of(spark, sf_dir)
        year = F.year("pay_date")
        return (stage(ods.where(year.isNull() | (year <= OVERLAP)), f"{OVERLAP + 1}-01-01 00:00:00"),
                stage(ods.where(year.isNull() | (year >= OVERLAP)), V2_LOAD_DATE))
    return stages


_first = _two_stages(_ods, lambda ods, at: V.payment_stage(ods, load_date=at))
_second = _two_stages(_typed_ods, V2.payment_stage_v2)


def _two_hub(name):
    return _two(_first, lambda stage, hub, *rows: V.hub_load(stage, hub, *V.HUBS[name], *rows), name)


def _two_sat(name):
    return _two(_first, lambda stage, sat, *rows: V.sat_load(stage, sat, *V.SATS[name], *rows), name)


def q20_two(spark, sf_dir):
    """The second batch's master data has another billing mode for every fifth client."""
    mdm = cut(_raw(spark, sf_dir, "mdm_user"), "mdm_user")
    changed = mdm.withColumn("billing_mode", F.when(F.col("id") % 5 == 0, "TRIAL").otherwise(F.col("billing_mode")))
    early, late = _second(spark, sf_dir)
    pk_keys = V.HUBS["hub_user"]
    hub = cut(V.hub_load(early, _empty(spark, "hub_user"), *pk_keys), "hub_user")
    sat = cut(V2.sat_user_as_client(mdm, hub, _empty(spark, "sat_user_as_client"), f"{OVERLAP + 1}-01-01 00:00:00"),
              "sat_user_as_client")
    hub = _after(hub, V.hub_load(late, hub, *pk_keys))
    return _after(sat, V2.sat_user_as_client(changed, hub, sat, V2_LOAD_DATE))


def _two_dim(name):
    def run(spark, sf_dir):
        column, key, ktype = M.DIMS[name]
        report, _ = _report_all(spark, sf_dir)
        dim = cut(M.dim_load(report.where(F.col("billing_year") <= OVERLAP), None, column, key, ktype), name)
        return _after(dim, M.dim_load(report.where(F.col("billing_year") >= OVERLAP), dim, column, key, ktype))
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "Q01_ods_billing": q01,
    "Q02_ods_issue": q02,
    "Q03_ods_payment": q03,
    "Q04_ods_traffic": q04,
    "Q05_dm_bytes_received": q05,
    "Q06_ods_payment_copy": q06,
    "Q07_ods_payment_reload": q07,
    "S02_multi_directory_scan": s02,
    "Q08_payment_stage": q08,
    "Q09_payment_stage_all": q09,
    "Q10_hub_user": _hub("hub_user"),
    "Q11_hub_account": _hub("hub_account"),
    "Q12_hub_billing_period": _hub("hub_billing_period"),
    "Q13_hub_pay_doc": _hub("hub_pay_doc"),
    "Q14_hub_payment": q14,
    "Q15_link_user_account_billing_pay": q15,
    "Q16_t_link_payment": q16,
    "Q17_sat_user_details": _sat("sat_user_details"),
    "Q18_sat_pay_details": _sat("sat_pay_details"),
    "Q19_sat_payment_doc_type": q19,
    "Q20_sat_user_as_client": q20,
    "Q21_payment_report": q21,
    "Q22_payment_report_client": q22,
    "Q23_dim_billing_year": _dim("dim_billing_year"),
    "Q24_dim_legal_type": _dim("dim_legal_type"),
    "Q25_dim_district": _dim("dim_district"),
    "Q26_dim_registration_year": _dim("dim_registration_year"),
    "Q27_report_fact": q27,
    "Q28_backfill": q28,
    "Q29_combined_run_second_vault": q29,
    "Q01_ods_billing_year": _year(O.ods_billing, "stg_billing", LAKE_YEAR),
    "Q02_ods_issue_year": _year(O.ods_issue, "stg_issue", EVENT_YEAR),
    "Q03_ods_payment_year": _year(O.ods_payment, "stg_payment", LAKE_YEAR),
    "Q04_ods_traffic_year": _year(O.ods_traffic, "stg_traffic", EVENT_YEAR),
    "Q05_dm_bytes_received_year": q05_year,
    "Q10_hub_user_two_batches": _two_hub("hub_user"),
    "Q11_hub_account_two_batches": _two_hub("hub_account"),
    "Q12_hub_billing_period_two_batches": _two_hub("hub_billing_period"),
    "Q13_hub_pay_doc_two_batches": _two_hub("hub_pay_doc"),
    "Q14_hub_payment_two_batches": _two(_second, V2.hub_payment, "hub_payment"),
    "Q15_link_two_batches": _two(_first, lambda stage, link, *rows: V.link_load(stage, link, V.LINK_PK, V.LINK_COLS, *rows),
                                 "link_user_account_billing_pay"),
    "Q16_t_link_payment_two_batches": _two(_second, V2.t_link_payment, "t_link_payment"),
    "Q17_sat_user_details_two_batches": _two_sat("sat_user_details"),
    "Q18_sat_pay_details_two_batches": _two_sat("sat_pay_details"),
    "Q19_sat_payment_doc_type_two_batches": _two(_second, V2.sat_payment_doc_type, "sat_payment_doc_type"),
    "Q20_sat_user_as_client_two_batches": q20_two,
    "Q23_dim_billing_year_two_batches": _two_dim("dim_billing_year"),
    "Q24_dim_legal_type_two_batches": _two_dim("dim_legal_type"),
    "Q25_dim_district_two_batches": _two_dim("dim_district"),
    "Q26_dim_registration_year_two_batches": _two_dim("dim_registration_year"),
}
