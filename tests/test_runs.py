"""Tables stored by run: unfinished runs, current versions, pruning, merging, reopening."""

import contextlib
import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.helpers import rows, ts
from vaultmart.functions import joins as J
from vaultmart.functions import runs as R
from vaultmart.functions.lineage import ScratchTable, children, measured
from vaultmart.operators import marts as M
from vaultmart.operators import ods as O
from vaultmart.operators import vault as V
from vaultmart.plans import yearly as Y
from vaultmart.sources import fixtures, sinks

STAR = "billing_year int, legal_type string, district string, registration_year int, is_vip boolean, sum decimal(20,2)"


@pytest.fixture(scope="module")
def ods(spark):
    return O.ods_payment_copy(fixtures.stg_payment(spark, SF_SMALL)).cache()


def contents(vault):
    out = {name: rows(getattr(vault, name).read()) for name in Y.VAULT_KEYS}
    return out | {f"current_{name}": rows(V.newest_per_key(t.read(), *V.SATS[name][:2])) for name, t in vault.current.items()}


@pytest.fixture(scope="module")
def clean(spark, ods):
    """Three years in a row, and the plans of the satellite loads of the last."""
    vault, plans = Y.Vault.empty(spark), {}
    append = R.RunTable.append

    def noted(table, df):
        plans[table.run, table.name] = df._jdf.queryExecution().optimizedPlan().toString() + str(df.inputFiles())
        append(table, df)

    for year in (1995, 1996):
        Y.run_vault_year(ods, vault, year)
    R.RunTable.append = noted
    try:
        Y.run_vault_year(ods, vault, 1997)
        late = Y.Vault.empty(spark)
        Y.run_vault_year(ods, late, 1996)
        Y.run_vault_year(ods, late, 1995)
    finally:
        R.RunTable.append = append
    return vault, plans, contents(vault)


class Broken(Exception):
    pass


def breaking(*_args, **_kw):
    raise Broken


def test_a_run_that_failed_half_way_is_replaced(spark, ods, clean, tmp_dir, monkeypatch):
    """The fifth load (the link) of 1996 fails; the year is run again by another process."""
    first = Y.Vault.open(spark, tmp_dir, "dv_")
    Y.run_vault_year(ods, first, 1995)
    with monkeypatch.context() as m, pytest.raises(Broken):
        m.setattr(V, "link_load", breaking)
        Y.run_vault_year(ods, first, 1996)
    assert "run=1996" in children(spark, first.hub_user.path)          # four hubs and two satellites are there
    again = Y.Vault.open(spark.newSession(), tmp_dir, "dv_")
    assert again.bounds == {n: t for n, t in again.bounds.items() if t == getattr(again, n).read().count()}
    for year in (1996, 1997):
        Y.run_vault_year(ods, again, year)
    assert contents(again) == clean[2]
    # and by the same process, after it has failed once more
    with monkeypatch.context() as m, pytest.raises(Broken):
        m.setattr(V, "link_load", breaking)
        Y.run_vault_year(ods, again, 1998)
    again.runs.recover()
    assert contents(again) == clean[2]


def test_a_finished_year_run_again_gets_a_run_of_its_own(spark):
    star = Y.Report.empty(spark)
    one = spark.createDataFrame([(2000, "L", "D", 1990, True, 1)], "billing_year int, legal_type string, district string, "
                                "registration_year int, is_vip boolean, sum int").withColumn("sum", F.col("sum").cast("decimal(20,2)"))
    for _ in range(3):
        Y.load_star(one, star, 2000)
    assert star.runs.finished == {"2000", "2000.2", "2000.3"} and star.fact.read().count() == 3


def test_a_star_that_failed_at_the_fact_is_replaced(spark, tmp_dir, monkeypatch):
    rep = spark.createDataFrame([(2000, None, "D", 1990, True), (2000, "L", "E", None, False)],
                                "billing_year int, legal_type string, district string, registration_year int, is_vip boolean")
    rep = rep.withColumn("sum", F.lit(1).cast("decimal(20,2)"))
    whole = Y.load_star(rep, Y.Report.empty(spark), 2000)
    star = Y.Report.open(spark, tmp_dir, "r_")
    with monkeypatch.context() as m, pytest.raises(Broken):
        m.setattr(M, "report_fact", breaking)
        Y.load_star(rep, star, 2000)
    assert star.dims["dim_legal_type"].read().count() == 2          # a NULL value is inserted by every run
    star = Y.load_star(rep, Y.Report.open(spark, tmp_dir, "r_"), 2000)
    for name, table in [*star.dims.items(), ("fact", star.fact)]:
        assert rows(table.read()) == rows(getattr(whole, name).read() if name == "fact" else whole.dims[name].read())


def test_a_year_on_time_does_not_read_the_history(clean):
    vault, plans, _ = clean
    for name in V.SATS:
        on_time, late = plans["1997", name], plans["1995", name]
        assert f"/current_{name}-" in on_time and f"/{name}-" not in on_time
        # 1995 after 1996: compared with the history
        assert f"/{name}-" in late and "/current_" not in late


def test_only_changed_keys_are_written_to_the_current_versions(clean):
    vault, _, _ = clean
    for name, (pk, hd, _) in V.SATS.items():
        sat, current = getattr(vault, name), vault.current[name]
        new = sat.read().where((F.col("load_date") == ts(1997)) & F.col(pk).isNotNull()).select(pk, hd).distinct().count()
        assert current.sizes["1997"].rows == new
        assert rows(V.newest_per_key(current.read(), pk, hd)) == rows(V.newest_per_key(sat.read().where(F.col(pk).isNotNull()), pk, hd))


def _scans(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "FileScan" in line and "PartitionFilters: [" in line]


def test_a_yearly_report_reads_its_billing_year_only(spark, clean):
    vault, _, _ = clean
    mdm = fixtures.raw(spark, SF_SMALL, "mdm_user").cache()

    def report(with_by):
        return M.payment_report(vault.link_user_account_billing_pay.read(with_by), vault.hub_billing_period.read(),
                                vault.sat_pay_details.read(with_by), vault.hub_user.read(), mdm, 1996,
                                hub_bp_rows=vault.hub_billing_period.rows)

    pruned = [line for line in _scans(report(True)) if "billing_year" in line and "= 1996)" in line]
    assert len(pruned) == 2                                           # link and satellite
    assert rows(report(True)) == rows(report(False)) and report(True).count() > 0
    # what a year reads is that year's, not the history
    sizes = {y: vault.sat_pay_details.read(True).where(F.col("billing_year") == y).count() for y in (1995, 1996, 1997)}
    assert sum(sizes.values()) <= vault.sat_pay_details.rows and max(sizes.values()) < 0.5 * vault.sat_pay_details.rows


def test_t12_late_versions_of_old_links_count_in_their_billing_year(spark):
    """A payment of 1995's period is corrected by a load of 2001."""
    paid = [(7, "F", 1, "A", "p", "1995-03", "1995-03-09", 5.0), (7, "F", 2, "A", "p", "2001-03", "2001-03-09", 1.0)]
    late = [(7, "F", 1, "A", "p", "1995-03", "2001-04-01", 7.0)]
    ods = O.ods_payment_copy(spark.createDataFrame(paid + late, fixtures.S.STG_PAYMENT))
    mdm = spark.createDataFrame([], fixtures.S.MDM_USER)
    vault = Y.Vault.empty(spark)
    for year in (1995, 2001):
        Y.run_vault_year(ods, vault, year)
    got = {}
    for year in (1995, 2001):
        rep = M.payment_report(vault.link_user_account_billing_pay.read(True), vault.hub_billing_period.read(),
                               vault.sat_pay_details.read(True), vault.hub_user.read(), mdm, year)
        got[year] = [str(r["sum"]) for r in rep.collect()]
    assert got == {1995: ["12.00"], 2001: ["1.00"]}


SIMPLE = "k long, v string"


def simple(spark, first, last):
    return spark.range(first, last).select(F.col("id").alias("k"), F.concat(F.lit("v"), "id").alias("v"))


def loaded(spark, root, runs, table="t"):
    t = R.RunTable(spark, table, spark.createDataFrame([], SIMPLE).schema, f"{root}/{table}")
    log = R.Runs(spark, {table: t}, f"{root}/log")
    for n in runs:
        log.begin(str(n))
        t.append(simple(spark, 10 * n, 10 * n + 10))
        log.finish()
    return t, log


def test_small_runs_are_merged(spark, tmp_dir):
    t, log = loaded(spark, tmp_dir, range(1, 8))
    assert t.read().count() == 70 and t.rows == 70
    assert len(t.stored_runs()) == 4 and "merged-1" in t.stored_runs()          # 1-4, 5, 6, 7
    assert len(t.read().inputFiles()) == 4                                      # one file a partition
    again, log = loaded(spark.newSession(), tmp_dir, [8, 9, 10])
    assert rows(again.read(), "k") == [(k,) for k in range(10, 110)] and again.rows == 100
    assert log.finished == {str(n) for n in range(1, 11)} and len(again.stored_runs()) <= R.FAN_IN


@pytest.mark.parametrize("where", ["swap_in", "undo", "_log"])
def test_a_merge_that_is_cut_off_loses_and_doubles_nothing(spark, tmp_dir, monkeypatch, where):
    t, log = loaded(spark, tmp_dir, range(1, 5))
    owner = R.Runs if where == "_log" else R.RunTable
    with monkeypatch.context() as m, contextlib.suppress(Broken):
        m.setattr(owner, where, breaking)
        log.begin("5")
    again, _ = loaded(spark, tmp_dir, [])
    assert rows(again.read(), "k") == [(k,) for k in range(10, 50)] and again.rows == 40
    again, _ = loaded(spark, tmp_dir, [5])
    assert rows(again.read(), "k") == [(k,) for k in range(10, 60)] and again.rows == 50


def test_a_write_knows_its_size(spark, tmp_dir):
    size, more = measured(simple(spark, 5, 8), lambda df: df.write.parquet(f"{tmp_dir}/x"), even=F.count_if(F.col("k") % 2 == 0))
    assert (size.rows, size.bytes, size.newest, more["even"]) == (3, 3 * 8 + 3 * 2, None, 1)
    empty = ScratchTable.of(simple(spark, 1, 1), "none", sized=True)
    assert (empty.size.rows, empty.size.bytes) == (0, 0) and empty.read().count() == 0


def test_overwrites_run_their_input_once(spark, tmp_dir):
    seen = spark.sparkContext.accumulator(0)
    note = F.udf(lambda k: seen.add(1) or k, "long")
    df = spark.range(20).select(F.col("id").cast("int").alias("user_id"), note("id").alias("n"), F.lit("1998").alias("year"))
    sinks.overwrite_partition(df, f"{tmp_dir}/t", 1998)
    assert seen.value == 20


def _rows_of(plan, condition):
    """Rows that the filter with ``condition`` let through in the plan that ran."""
    todo, found = [plan], []
    while todo:
        node = todo.pop()
        kind = node.nodeName()
        if kind == "Filter" and condition in node.simpleString(10_000):
            found.append(node.metrics().apply("numOutputRows").value())
        inner = [node.executedPlan()] if kind == "AdaptiveSparkPlan" else [node.plan()] if "QueryStage" in kind else []
        children_ = node.children()
        todo += inner + [children_.apply(i) for i in range(children_.size())]
    return max(found)


@pytest.fixture()
def big_target(spark):
    """Every side is too big to broadcast, and a target of any size is worth a Bloom filter."""
    changed = {J.MAX_ROWS_CONF: "1", "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1",
               "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {key: spark.conf.get(key, None) for key in changed}
    for key, value in changed.items():
        spark.conf.set(key, value)
    yield
    for key, value in old.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_a_big_hub_is_bloom_filtered_before_its_shuffle(spark, tmp_dir, big_target):
    def hub(first, last):
        return spark.range(first, last).select(F.md5(F.col("id").cast("string")).alias("pk"), F.col("id").cast("string").alias("k"),
                                               F.lit(ts(1995)).cast("timestamp_ntz").alias("load_date"), F.lit("src").alias("record_source"))

    hub(0, 50_000).write.parquet(f"{tmp_dir}/hub")
    hub(49_900, 50_100).write.parquet(f"{tmp_dir}/stage")
    out = V.hub_load(spark.read.parquet(f"{tmp_dir}/stage"), spark.read.parquet(f"{tmp_dir}/hub"), "pk", ["k"], 50_000, 200)
    assert out.count() == 100
    out.collect()
    plan = out._jdf.queryExecution().executedPlan()
    lines = plan.toString().split("== Initial Plan ==")[0].splitlines()
    at = next(i for i, line in enumerate(lines) if "might_contain" in line)
    assert "Exchange hashpartitioning" in lines[at - 1]              # right below the exchange of the hub's keys
    # so only a few of the hub's 50,000 keys are shuffled
    assert _rows_of(plan, "might_contain") < 1_000


def test_a_bucketed_vault_can_be_reopened(spark, ods, tmp_dir, clean, big_target):
    first = Y.Vault.open(spark, tmp_dir, "b_", buckets=4)
    Y.run_vault_year(ods, first, 1995)
    other = spark.newSession()
    again = Y.Vault.open(other, tmp_dir, "b_", buckets=4)
    assert again.hub_user.read().count() == first.hub_user.rows == again.hub_user.rows
    for year in (1996, 1997):
        Y.run_vault_year(ods, again, year)
    assert contents(again) == clean[2]
    # its files are read in place: no exchange between the bucketed scan and the join
    keys = again.hub_user.read().select("user_pk")
    joined = keys.join(other.createDataFrame([("x",)], "user_pk string").hint("merge"), "user_pk", "left_semi")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan


def test_the_second_vault_can_be_reopened(spark, tmp_dir):
    stg = fixtures.raw(spark, SF_SMALL, "stg_payment").cache()
    mdm = fixtures.raw(spark, SF_SMALL, "mdm_user").cache()
    years = (1995, 1996, 1997)
    whole = Y.SecondVault.empty(spark)
    for year in years:
        Y.run_second_vault_year(stg, mdm, whole, year)
    first = Y.SecondVault.open(spark, tmp_dir, "v2_")
    for year in years[:2]:
        Y.run_second_vault_year(stg, mdm, first, year)
    again = Y.SecondVault.open(spark, tmp_dir, "v2_")
    assert set(again.staged_from) == {"1995", "1996"}
    staged = {f: children(spark, f"{again.stage.path}/{f}") for f in children(spark, again.stage.path) if f.startswith("ods")}
    Y.run_second_vault_year(stg, mdm, again, 1997)
    # the years that were staged before are not staged again
    assert all(children(spark, f"{again.stage.path}/{f}") == files for f, files in staged.items())
    for name in [*Y.SECOND_VAULT]:
        assert rows(getattr(again, name).read()) == rows(getattr(whole, name).read()), name
    assert rows(again.report.fact.read()) == rows(whole.report.fact.read())
    # another process reloads 1996 with fewer rows: the stage notices
    fewer = stg.where((F.substring("pay_date", 1, 4) != "1996") | (F.col("pay_doc_num") % 2 == 0))
    sinks.overwrite_partition(O.ods_payment(fewer, 1996), again.ods_root, 1996, "ods_payment")
    later = Y.SecondVault.open(spark, tmp_dir, "v2_")
    Y._restage(later, "1998-01-01 00:00:00")
    assert later.stage.read().where("ods_year = '1996'").count() == fewer.where(F.substring("pay_date", 1, 4) == "1996").count()


def test_client_report_of_the_newest_attributes_only(spark):
    tlink = spark.createDataFrame([("U", "B", 5)], "user_pk string, billing_period_pk string, sum int")
    tlink = tlink.withColumn("sum", F.col("sum").cast("decimal(10,2)"))
    periods = spark.createDataFrame([("B", "2020-01-01")], "billing_period_pk string, billing_period_key string")
    users = spark.createDataFrame([("U", "7")], "user_pk string, user_key string")
    sat = spark.createDataFrame([("U", "old", "D", None, True, ts(2020)), ("U", "new", "D", None, True, ts(2021))],
                                "user_pk string, legal_type string, district string, registered_at date, is_vip boolean, "
                                "load_date timestamp_ntz")
    for latest, kinds in ((False, ["new", "old"]), (True, ["new"])):
        got = M.payment_report_client(tlink, periods, users, sat, latest_only=latest)
        assert sorted(r["legal_type"] for r in got.collect()) == kinds and {str(r["sum"]) for r in got.collect()} == {"5.00"}


def test_files_of_run_tables_are_where_they_are_said_to_be(clean):
    vault, _, _ = clean
    path = vault.sat_pay_details.path.removeprefix("file:")
    assert any(f.startswith("billing_year=") for f in os.listdir(f"{path}/run=1996"))


def test_many_rows_out_of_a_shuffle_are_written_as_they_are(spark, tmp_dir, big_target, monkeypatch):
    written = []
    monkeypatch.setattr(R, "measured", lambda df, write: written.append(str(df._jdf.queryExecution().logical())) or [None])
    t = R.RunTable(spark, "t", spark.createDataFrame([], SIMPLE).schema, f"{tmp_dir}/t")
    t.append_shuffled(simple(spark, 0, 9), 9)
    t.append(simple(spark, 0, 9))
    assert ["rebalance" in plan.lower() for plan in written] == [False, True]


def test_known_keys_are_those_of_the_target_that_the_batch_has(spark, tmp_dir, big_target):
    simple(spark, 5, 9).unionByName(spark.createDataFrame([(None, "x")], SIMPLE)).write.parquet(f"{tmp_dir}/b")
    known, n = J.known_keys(spark.read.parquet(f"{tmp_dir}/b"), simple(spark, 0, 7), ["k"], 7, 5)
    assert (rows(known, "k"), n) == ([(5,), (6,)], 2)


def test_loaded_partitions_give_only_null_keys_again(spark, monkeypatch):
    stg = fixtures.raw(spark, SF_SMALL, "stg_payment").cache()
    mdm = fixtures.raw(spark, SF_SMALL, "mdm_user").cache()
    v, seen, load = Y.SecondVault.empty(spark), {}, V.link_load

    def noted(stage, *args):
        years = stage.where(F.col("pay_pk").isNotNull()).select("ods_year").distinct().collect()
        seen[v.runs.run] = sorted(r["ods_year"] for r in years)
        return load(stage, *args)

    monkeypatch.setattr(V, "link_load", noted)
    for year in (1995, 1996):
        Y.run_second_vault_year(stg, mdm, v, year)
    assert seen == {"1995": ["1995"], "1996": ["1996"]}
