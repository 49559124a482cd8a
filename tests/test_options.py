"""Options beyond the reference's defaults (t5, t10, t12) and the two-batch loads
under every join plan."""

import os
from decimal import Decimal

import pytest

from tests.conftest import SF_SMALL
from tests.helpers import rows, ts
from vaultmart.functions import joins as J
from vaultmart.functions.lineage import ScratchTable
from vaultmart.operators import marts as M
from vaultmart.operators import vault as V
from vaultmart.plans import registry as R
from vaultmart.plans import yearly as Y

HUB = "pk string, k string, load_date timestamp_ntz, record_source string"
REPORT = "billing_year int, legal_type string, district string, registration_year int, is_vip boolean, sum decimal(20,2)"


@pytest.fixture()
def limit_of_one(spark):
    spark.conf.set(J.MAX_ROWS_CONF, "1")
    yield
    spark.conf.unset(J.MAX_ROWS_CONF)


def test_t5_null_keys_can_be_left_out(spark):
    stage = spark.createDataFrame([("A", "a", ts(1995), "src"), (None, None, ts(1995), "src")], HUB)
    empty, cols = spark.createDataFrame([], HUB), ["pk", "k", "load_date", "record_source"]
    for skip, expected in ((False, [(None,), ("A",)]), (True, [("A",)])):
        assert rows(V.hub_load(stage, empty, "pk", ["k"], skip_null_keys=skip), "pk") == expected
        assert rows(V.link_load(stage, empty, "pk", cols, skip_null_keys=skip), "pk") == expected
        assert rows(V.sat_load(stage, empty, "pk", "k", cols, skip_null_keys=skip), "pk") == expected


def _report(spark, year, *amounts):
    return spark.createDataFrame([(year, f"L{i}", "D", 1990, True, Decimal(a)) for i, a in enumerate(amounts)], REPORT)


def test_t10_a_rerun_year_replaces_its_facts(spark):
    for replace, expected in ((True, ["3.00", "9.00"]), (False, ["1.00", "2.00", "3.00", "9.00"])):
        star = Y.Report.empty(spark, replace_years=replace)
        Y.load_star(_report(spark, 2000, "1", "2"), star, 2000)
        Y.load_star(_report(spark, 2001, "9"), star, 2001)
        Y.load_star(_report(spark, 2000, "3"), star, 2000)
        assert sorted(str(r["sum"]) for r in star.fact.read().collect()) == expected
    star = Y.Report.empty(spark, replace_years=True)
    Y.load_star(_report(spark, 2000, "1"), star, 2000)
    Y.load_star(_report(spark, 2001, "9"), star, 2001)
    Y.load_star(_report(spark, 2000), star, 2000)                # the year has nothing any more
    assert [str(r["sum"]) for r in star.fact.read().collect()] == ["9.00"]
    assert star.fact.read().columns == Y.S.REPORT_FACT.fieldNames()


def test_t12_latest_versions_only(spark):
    link = spark.createDataFrame([("L", "U", "B")], f"{V.LINK_PK} string, user_pk string, billing_period_pk string")
    periods = spark.createDataFrame([("B", "2020-01-01")], "billing_period_pk string, billing_period_key string")
    sat = spark.createDataFrame([("L", "a", Decimal("5.00"), ts(2020)), ("L", "b", Decimal("7.00"), ts(2021))],
                                f"{V.LINK_PK} string, pay_doc_hashdiff string, sum decimal(10,2), load_date timestamp_ntz")
    users = spark.createDataFrame([("U", "7")], "user_pk string, user_key string")
    mdm = spark.createDataFrame([], "id int, legal_type string, district string, registered_at date, is_vip boolean")
    for latest, total in ((False, "12.00"), (True, "7.00")):
        assert str(M.payment_report(link, periods, sat, users, mdm, latest_only=latest).first()["sum"]) == total


def test_a_dropped_table_leaves_no_files(spark):
    table = ScratchTable.of(spark.range(5), "t")
    path = table.path.removeprefix("file:")
    assert os.path.exists(path)
    table.drop()
    assert not os.path.exists(path) and table.read().count() == 0


def test_two_batches_give_the_same_rows_by_every_join(spark, request):
    names = ["Q11_hub_account_two_batches", "Q15_link_two_batches", "Q17_sat_user_details_two_batches"]
    by_broadcast = [rows(R.QUERIES[n](spark, SF_SMALL)) for n in names]
    request.getfixturevalue("limit_of_one")
    assert [rows(R.QUERIES[n](spark, SF_SMALL)) for n in names] == by_broadcast


def test_latest_versions_group_behind_an_exchange_of_their_own(spark, limit_of_one):
    sat = spark.createDataFrame([("P", "A", ts(1995)), ("P", "B", ts(1995))],
                                "pk string, hd string, load_date timestamp_ntz")
    cut_off = spark.createDataFrame([("P", ts(1996))], "pk string, _cut timestamp_ntz")
    out = V.latest_versions(sat, cut_off, "pk", "hd", sat_rows=99, batch_rows=99)
    assert "REPARTITION_BY_COL" in out._jdf.queryExecution().executedPlan().toString()
    assert rows(out) == [("P", "A"), ("P", "B")]


def test_lists_of_the_language_model_are_freed_when_they_are_counted(spark, monkeypatch):
    from vaultmart.functions.lineage import FREE_CONF
    from vaultmart.llm import lm_score

    seen, cut = [], lm_score.cut

    def noted(df, name):
        seen.append((name, spark.conf.get(FREE_CONF)))
        return cut(df, name)

    before = spark.conf.get(FREE_CONF, None)
    monkeypatch.setattr(lm_score, "cut", noted)
    docs = spark.createDataFrame([(1, "a b a"), (2, None)], "doc_id long, text string")
    assert lm_score.score(docs).count() == 2
    assert seen == [("lm-answers", "true")] and spark.conf.get(FREE_CONF, None) == before
