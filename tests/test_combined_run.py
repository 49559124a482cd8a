"""The combined run (E4): ODS slice reload as a partition overwrite, second
vault, report variant B."""

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from vaultmart.plans import yearly as Y
from vaultmart.sources import fixtures
from vaultmart.sources.lake import scan


def test_combined_run_two_years(spark):
    stg = fixtures.raw(spark, SF_SMALL, "stg_payment")
    mdm = fixtures.raw(spark, SF_SMALL, "mdm_user")
    v = Y.SecondVault.empty(spark)
    for year in (1995, 1996):
        Y.run_second_vault_year(stg, mdm, v, year)
    ods = scan(spark, "ods_payment", v.ods_root)
    by_year = {r["year"]: r["count"] for r in ods.groupBy("year").count().collect()}
    expected = {str(y): stg.where(F.substring("pay_date", 1, 4) == str(y)).count()
                for y in (1995, 1996)}
    assert by_year == expected
    # rerun 1996: the partition is replaced, not doubled; other years untouched
    Y.run_second_vault_year(stg, mdm, v, 1996)
    by_year = {r["year"]: r["count"] for r in
               scan(spark, "ods_payment", v.ods_root).groupBy("year").count().collect()}
    assert by_year == expected
    # FIXTURES.md: 116 + 30 users and 231 + 229 payments loaded by 1995 and 1996
    assert v.hub_user.read().where(F.col("user_pk").isNotNull()).count() == 146
    assert v.hub_payment.read().count() == 460
    assert v.t_link_payment.read().count() == 460
    fact = v.report.fact.read()
    assert fact.count() > 0 and fact.where(F.col("registration_year_id").isNull()).count() == 0


def test_the_stage_follows_reloads(spark):
    stg = fixtures.raw(spark, SF_SMALL, "stg_payment")
    mdm = fixtures.raw(spark, SF_SMALL, "mdm_user")
    in_year = F.substring("pay_date", 1, 4)
    v = Y.SecondVault.empty(spark)
    for year in (1995, 1996):
        Y.run_second_vault_year(stg, mdm, v, year)
    fewer = stg.where((in_year != "1995") | (F.crc32(F.col("pay_doc_num").cast("string")) % 2 == 0)).where(in_year != "1996")
    left = fewer.where(in_year == "1995").count()
    assert 0 < left < 231
    Y.run_second_vault_year(fewer, mdm, v, 1995)
    Y.run_second_vault_year(fewer, mdm, v, 1996)         # a year that has become empty
    assert {r["ods_year"]: r["count"] for r in v.stage.read().groupBy("ods_year").count().collect()} == {"1995": left}
    v.drop_stage()
    Y.run_second_vault_year(fewer, mdm, v, 1995)         # staged whole again
    assert v.stage.read().count() == left
