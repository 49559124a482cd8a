"""Plan shapes that matter at scale: which side is broadcast, where partial
aggregation happens, what reaches the scan."""

import pytest

from tests.helpers import ts
from vaultmart.functions import joins as J
from vaultmart.operators import vault as V

HUB_SCHEMA = "pk string, k string, load_date timestamp_ntz, record_source string"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def small_limit(spark):
    old = spark.conf.get(J.MAX_ROWS_CONF, None)
    spark.conf.set(J.MAX_ROWS_CONF, "5")
    yield 5
    if old is None:
        spark.conf.unset(J.MAX_ROWS_CONF)
    else:
        spark.conf.set(J.MAX_ROWS_CONF, old)


def _hub(spark, n):
    return spark.createDataFrame([(f"K{i}", f"k{i}", ts(1990), "src") for i in range(n)], HUB_SCHEMA)


def test_small_target_is_broadcast_into_the_anti_join(spark, small_limit):
    batch = _hub(spark, 50)
    plan = _plan(J.anti_join_existing(batch, _hub(spark, 3), ["pk"], target_rows=3, batch_rows=50))
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan and "LeftSemi" not in plan


def test_big_target_small_batch_scans_the_target_against_batch_keys(spark, small_limit):
    batch = _hub(spark, 3)
    out = J.anti_join_existing(batch, _hub(spark, 50), ["pk"], target_rows=50, batch_rows=3)
    plan = _plan(out)
    assert "LeftSemi" in plan and "LeftAnti" in plan and "SortMergeJoin" not in plan
    assert out.count() == 0


def test_both_big_shuffle_on_the_key(spark, small_limit):
    out = J.anti_join_existing(_hub(spark, 40), _hub(spark, 50), ["pk"])     # no sizes: none is guessed
    plan = out._jdf.queryExecution().sparkPlan().toString()   # before AQE re-planning
    assert "SortMergeJoin" in plan and "LeftAnti" in plan
    assert out.count() == 0


def test_known_bounds_skip_the_count(spark, small_limit):
    # a bound above the limit forces the shuffle plan without measuring
    out = J.anti_join_existing(_hub(spark, 1), _hub(spark, 1), ["pk"], target_rows=99,
                               batch_rows=99)
    assert "SortMergeJoin" in out._jdf.queryExecution().sparkPlan().toString()


def test_first_row_per_key_combines_map_side(spark):
    stage = _hub(spark, 20).unionByName(_hub(spark, 20))
    plan = _plan(V.hub_load(stage, spark.createDataFrame([], HUB_SCHEMA), "pk", ["k"], hub_rows=0))
    # partial aggregate below the exchange: a hot key collapses before the shuffle
    assert plan.index("partial_min") > plan.index("Exchange hashpartitioning")


def test_first_row_per_key_reads_the_raw_rows_into_a_hash_table(spark):
    stage = _hub(spark, 20).unionByName(_hub(spark, 20))
    plan = _plan(V.hub_load(stage, spark.createDataFrame([], HUB_SCHEMA), "pk", ["k"], hub_rows=0))
    raw = [line for line in plan.splitlines() if "partial_min(load_date" in line]
    assert raw and all("HashAggregate" in line for line in raw)


@pytest.fixture()
def split_early(spark):
    """Shuffle joins only, and partitions of some kilobytes count as skewed."""
    changed = {J.MAX_ROWS_CONF: "1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
               "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128k",
               "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256k",
               "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    old = {key: spark.conf.get(key, None) for key in changed}
    for key, value in changed.items():
        spark.conf.set(key, value)
    yield
    for key, value in old.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_the_history_of_a_hot_key_is_split(spark, split_early):
    """A third of the satellite's versions and of the batch belong to one key."""
    from pyspark.sql import functions as F

    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 20_000))

    def rows(first, last, year):
        return (spark.range(first, last, 1, 16)     # enough map outputs to split one reducer's input
                .select(key.alias("pk"), F.md5(F.col("id").cast("string")).alias("hd"),
                        F.lit(ts(year)).cast("timestamp_ntz").alias("load_date")))

    # the second half of the history comes again in the batch
    out = V.sat_load(rows(30_000, 90_000, 1996), rows(0, 60_000, 1995), "pk", "hd", ["pk", "hd", "load_date"],
                     sat_rows=60_000, batch_rows=60_000)
    assert out.count() == 30_000
    # of the cut-offs, and of the newest dates: both joins on the key are split
    assert _final(out).count("SortMergeJoin(skew=true)") == 2


def _final(df):
    """The plan that has run (adaptive plans change while they run)."""
    df.collect()
    return _plan(df).split("== Initial Plan ==")[0]


def test_no_static_broadcast_guesses(spark):
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "-1"
    assert int(spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold")) > 0


def test_bucketed_hub_is_not_shuffled_in_a_big_anti_join(spark, small_limit):
    from vaultmart.functions.runs import BucketedTable

    hub = BucketedTable(spark, "hub_t", _hub(spark, 0).schema, "pk", 8)
    hub.append(_hub(spark, 50))
    batch = _hub(spark, 60)
    out = J.anti_join_existing(batch, hub.read(), ["pk"], target_rows=50, batch_rows=60)
    plan = out._jdf.queryExecution().executedPlan().toString()   # initial adaptive plan
    assert "SortMergeJoin" in plan
    # the bucketed hub is read in place: only rows of the batch are exchanged
    exchanged = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanged and not _shuffles_scan(plan, hub.table_name)
    assert sorted(r["pk"] for r in out.collect()) == [f"K{i}" for i in range(50, 60)]


def _shuffles_scan(plan, table):
    """Whether an Exchange stands above the scan of ``table`` before any join does."""
    lines = plan.splitlines()
    for at, line in enumerate(lines):
        if "FileScan parquet" in line and table in line:
            depth = len(line) - len(line.lstrip(" :+-"))
            for above in reversed(lines[:at]):
                level = len(above) - len(above.lstrip(" :+-"))
                if level < depth:
                    depth = level
                    if "Join" in above:
                        break
                    if "Exchange" in above:
                        return True
    return False


def test_yearly_vault_on_bucketed_tables(spark):
    from tests.conftest import SF_SMALL
    from vaultmart.operators import ods as O
    from vaultmart.plans import yearly as Y
    from vaultmart.sources import fixtures

    ods = O.ods_payment_copy(fixtures.raw(spark, SF_SMALL, "stg_payment"))
    vault = Y.Vault.empty(spark, buckets=4)
    for year in (1995, 1996):
        Y.run_vault_year(ods, vault, year)
    # FIXTURES.md: 116+30 users, 231+229 links after 1995 and 1996 at sf0.001
    assert vault.hub_user.read().count() == 146
    assert vault.link_user_account_billing_pay.read().count() == 460
