"""Report star (Q21-Q27): FIXTURES.md totals, t11, t12, and the dimension fold."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.helpers import rows
from vaultmart.functions.lineage import cut
from vaultmart.operators import marts as M
from vaultmart.plans import registry as R


@pytest.fixture(scope="module")
def report(spark):
    return cut(R.q21(spark, SF_SMALL))


def test_report_totals_match_fixtures(report):
    assert report.count() == 761
    assert report.agg(F.sum("sum")).first()[0] == Decimal("374446791.61")


def test_t11_fact_drops_groups_with_a_null_dimension_value(spark, report):
    dims = {n: M.dim_backfill(report, None, c, k, t) for n, (c, k, t) in M.DIMS.items()}
    fact = M.report_fact(report, dims)
    assert fact.count() == 723
    assert fact.agg(F.sum("sum")).first()[0] == Decimal("346895955.41")
    no_null = report.dropna(subset=["billing_year", "legal_type", "district", "registration_year"])
    assert fact.agg(F.sum("sum")).first()[0] == no_null.agg(F.sum("sum")).first()[0]


def test_dimension_backfill_equals_yearly_dimension_loads(spark, report):
    years = sorted(r[0] for r in report.select("billing_year").distinct().collect())
    for name, (column, key, ktype) in M.DIMS.items():
        dim = None
        for y in years:
            ins = M.dim_load(report.where(F.col("billing_year") == y), dim, column, key, ktype)
            dim = ins if dim is None else dim.unionByName(ins)
            dim = cut(dim)
        once = M.dim_backfill(report, None, column, key, ktype)
        assert rows(once) == rows(dim), name
        ids = [r[0] for r in once.collect()]
        assert sorted(ids) == list(range(1, len(ids) + 1))


def test_t12_versions_multiply_revenue(spark):
    link = spark.createDataFrame([("L", "U", "B")], "user_account_billing_pay_pk string, "
                                 "user_pk string, billing_period_pk string")
    hub_bp = spark.createDataFrame([("B", "2020-01-01")], "billing_period_pk string, "
                                   "billing_period_key string")
    sat = spark.createDataFrame([("L", Decimal("5.00")), ("L", Decimal("5.00"))],
                                "user_account_billing_pay_pk string, sum decimal(10,2)")
    hub_user = spark.createDataFrame([("U", "7")], "user_pk string, user_key string")
    mdm = spark.createDataFrame([], "id int, legal_type string, district string, "
                                "registered_at date, is_vip boolean, billing_mode string")
    out = M.payment_report(link, hub_bp, sat, hub_user, mdm).collect()
    assert len(out) == 1 and out[0]["sum"] == Decimal("10.00") and out[0]["legal_type"] is None
