"""Column helpers: hash keys, lenient casts, year filters."""

import datetime as dt
import hashlib

from pyspark.sql import functions as F

from vaultmart.functions import casts as C
from vaultmart.functions import dates as D
from vaultmart.functions.keys import hash_key, hashdiff, norm


def md5(s):
    return hashlib.md5(s.encode()).hexdigest()


def test_hash_key_normalises_and_nulls_blanks(spark):
    df = spark.createDataFrame([(" acc-5 ", 7), ("", None), (None, None)], "a string, b int")
    got = df.select(norm("a").alias("n"), hash_key("a").alias("h"),
                    hash_key("a", "b").alias("h2"), hashdiff("a", "b").alias("d")).collect()
    assert got[0]["n"] == "ACC-5"
    assert got[0]["h"] == md5("ACC-5")
    assert got[0]["h2"] == md5("ACC-5||7")
    # blank and NULL keys give a NULL hash key, a composite of only blanks too
    assert got[1]["h"] is None and got[2]["h"] is None
    assert got[1]["h2"] is None and got[2]["h2"] is None
    # a hashdiff is never NULL
    assert got[2]["d"] == md5("^^||^^")


def test_hash_of_typed_values_uses_engine_neutral_text(spark):
    df = spark.sql("SELECT DATE'2020-01-02' AS d, CAST(5 AS DECIMAL(10,2)) AS m")
    r = df.select(hashdiff("d", "m").alias("h")).first()
    assert r["h"] == md5("2020-01-02||5.00")


def test_lenient_text_casts_follow_hive(spark):
    df = spark.createDataFrame([("12.7",), ("n/a",), ("-3.9",), ("99999999999",)], "s string")
    got = [r[0] for r in df.select(C.text_to_int("s")).collect()]
    assert got == [12, None, -3, None]
    df = spark.createDataFrame([("2020-03",), ("bad",)], "p string")
    assert [r[0] for r in df.select(C.period_to_date("p")).collect()] == [dt.date(2020, 3, 1), None]


def test_epoch_millis_not_seconds(spark):
    ms = 1704067200123  # 2024-01-01 00:00:00.123 UTC
    df = spark.createDataFrame([(ms,)], "t long")
    r = df.select(D.epoch_ms_to_timestamp("t").alias("ts"), D.epoch_ms_year("t").alias("y")).first()
    assert r["ts"] == dt.datetime(2024, 1, 1, 0, 0, 0, 123000)
    assert r["y"] == 2024


def test_epoch_year_filter_truncates_toward_zero(spark):
    # -500 ms: ms/1000 = -0.5, truncated to 0 s -> 1970, not 1969
    df = spark.createDataFrame([(-500,), (-1500,), (0,)], "t long")
    kept = sorted(r[0] for r in df.where(D.epoch_ms_in_year("t", 1970)).collect())
    assert kept == [-500, 0]


def test_period_key_year_ignores_the_day(spark):
    df = spark.createDataFrame([("2020-03-01",), ("junk",)], "k string")
    assert [r[0] for r in df.select(D.period_key_year("k")).collect()] == [2020, None]


def test_year_range_filter_reaches_the_scan(spark, tmp_dir):
    spark.createDataFrame([(dt.date(1996, 5, 1),)], "pay_date date").write.parquet(tmp_dir + "/p")
    df = spark.read.parquet(tmp_dir + "/p").where(D.in_year("pay_date", 1996))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(pay_date,1996-01-01)" in plan
    assert "LessThan(pay_date,1997-01-01)" in plan
