"""The driver contract in __spark_entry__.py."""

import __spark_entry__ as E


def test_every_query_has_an_oracle():
    core = {q for q in E.queries() if q.startswith("Q")}
    assert core == {q for q in E.oracle_sql() if q.startswith("Q")}
    assert len(core) == 49


def test_entry_runs_on_the_smoke_scale(spark):
    df = E.entry(spark)
    assert df.columns == ["billing_year", "legal_type", "district", "registration_year", "is_vip",
                          "sum"]
    assert df.count() == 761
