"""Small literal cases for the vault loads."""

from pyspark.sql import functions as F

from tests.helpers import rows, ts
from vaultmart.operators import vault as V

SAT_COLS = ["pk", "hd", "phone", "effective_from", "load_date", "record_source"]
SAT_SCHEMA = ("pk string, hd string, phone string, effective_from date, load_date timestamp_ntz, "
              "record_source string")


def _batch(spark, load_date, *pairs):
    data = [(pk, hd, hd.lower(), None, load_date, "src") for pk, hd in pairs]
    return spark.createDataFrame(data, SAT_SCHEMA)


def _load(spark, sat, batch):
    ins = V.sat_load(batch, sat, "pk", "hd", SAT_COLS)
    return ins, sat.unionByName(ins)


def test_t7_latest_is_the_newest_load_not_the_newest_state(spark):
    sat = spark.createDataFrame([], SAT_SCHEMA)
    ins, sat = _load(spark, sat, _batch(spark, ts(2000), ("P", "A"), ("P", "B")))
    assert ins.count() == 2
    ins, sat = _load(spark, sat, _batch(spark, ts(2001), ("P", "A"), ("P", "C")))
    assert rows(ins, "hd") == [("C",)]
    # rerun of the same year (same load date): latest = {C}, so A is stored again
    ins, sat = _load(spark, sat, _batch(spark, ts(2001), ("P", "A"), ("P", "C")))
    assert rows(ins, "hd") == [("A",)]
    # a third run: latest = {A, C} at that load date, nothing new
    ins, sat = _load(spark, sat, _batch(spark, ts(2001), ("P", "A"), ("P", "C")))
    assert ins.count() == 0


def test_t8_late_year_compares_only_with_versions_loaded_before_it(spark):
    sat = spark.createDataFrame(
        [("P", "Y", "y", None, ts(1998), "src"), ("P", "X", "x", None, ts(2000), "src")], SAT_SCHEMA)
    ins, _ = _load(spark, sat, _batch(spark, ts(1999), ("P", "X")))
    assert rows(ins, "hd") == [("X",)]  # X@2000 is after the cut-off; latest is {Y}
    ins, _ = _load(spark, sat, _batch(spark, ts(1999), ("P", "Y")))
    assert ins.count() == 0


def test_t9_change_and_change_back_stores_the_old_value_again(spark):
    sat = spark.createDataFrame([], SAT_SCHEMA)
    for year, value, expected in [(1995, "A", 1), (1996, "B", 1), (1997, "A", 1), (1998, "A", 0)]:
        ins, sat = _load(spark, sat, _batch(spark, ts(year), ("P", value)))
        assert ins.count() == expected, (year, value)


def test_sat_null_key_rows_are_inserted_every_batch(spark):
    sat = spark.createDataFrame([], SAT_SCHEMA)
    ins, sat = _load(spark, sat, _batch(spark, ts(1995), (None, "A")))
    ins2, _ = _load(spark, sat, _batch(spark, ts(1996), (None, "A")))
    assert ins.count() == 1 and ins2.count() == 1


HUB_SCHEMA = "pk string, k string, load_date timestamp_ntz, record_source string"


def _stage(spark, load_date, *keys):
    return spark.createDataFrame([(None if k is None else k.upper(), k, load_date, "src")
                                  for k in keys], HUB_SCHEMA)


def test_t5_hub_null_key_inserted_once_per_batch_and_keys_once(spark):
    hub = spark.createDataFrame([], HUB_SCHEMA)
    for year in (1995, 1996):
        ins = V.hub_load(_stage(spark, ts(year), "a", "a", "b", None, None), hub, "pk", ["k"])
        hub = hub.unionByName(ins)
    got = rows(hub, "pk", "load_date")
    assert got == [(None, ts(1995)), (None, ts(1996)), ("A", ts(1995)), ("B", ts(1995))]


def test_hub_first_row_takes_least_key_spelling(spark):
    stage = spark.createDataFrame([("ACC-5", "ACC-5", ts(1995), "src"),
                                   ("ACC-5", " acc-5 ", ts(1995), "src")], HUB_SCHEMA)
    ins = V.hub_load(stage, spark.createDataFrame([], HUB_SCHEMA), "pk", ["k"])
    assert rows(ins, "k") == [(" acc-5 ",)]


def test_hub_and_link_rerun_add_nothing_without_null_keys(spark):
    hub = spark.createDataFrame([], HUB_SCHEMA)
    stage = _stage(spark, ts(1995), "a", "b")
    hub = hub.unionByName(V.hub_load(stage, hub, "pk", ["k"]))
    assert V.hub_load(stage, hub, "pk", ["k"]).count() == 0
    link = V.link_load(stage, spark.createDataFrame([], HUB_SCHEMA), "pk", ["pk", "k", "load_date",
                                                                           "record_source"])
    assert V.link_load(stage, link, "pk", ["pk", "k", "load_date", "record_source"]).count() == 0


def test_backfill_matches_year_by_year_loads_on_literal_data(spark):
    batches = {1995: ["a", "b", None], 1996: ["b", "c", None], 1997: ["a", "d"]}
    stage_all = None
    hub = spark.createDataFrame([], HUB_SCHEMA)
    for year, keys in batches.items():
        st = _stage(spark, ts(year), *keys)
        stage_all = st if stage_all is None else stage_all.unionByName(st)
        hub = hub.unionByName(V.hub_load(st, hub, "pk", ["k"]))
    once = V.hub_backfill(stage_all, spark.createDataFrame([], HUB_SCHEMA), "pk", ["k"])
    assert rows(once) == rows(hub)
    cols = ["pk", "k", "load_date", "record_source"]
    link = spark.createDataFrame([], HUB_SCHEMA)
    for year, keys in batches.items():
        link = link.unionByName(V.link_load(_stage(spark, ts(year), *keys), link, "pk", cols))
    once = V.link_backfill(stage_all, spark.createDataFrame([], HUB_SCHEMA), "pk", cols)
    assert rows(once) == rows(link)


def test_sat_backfill_general_and_compact_folds_agree(spark):
    """An existing satellite with a version *later* than the first batch forces
    the general fold (load-date guard active); without it the compact fold
    runs.  Both must equal year-by-year sat_load."""
    from vaultmart.plans import backfill as B

    batches = {1995: [("P", "A"), ("Q", "A")], 1996: [("P", "B"), ("Q", "A")],
               1997: [("P", "A"), ("P", "C"), ("Q", "B")]}
    stage_all = None
    for y, pairs in batches.items():
        b = _batch(spark, ts(y), *pairs)
        stage_all = b if stage_all is None else stage_all.unionByName(b)
    staged = B.StagedBatches(stage_all, "t-stage")
    for existing in ([], [("P", "Z", "z", None, ts(1990), "src")],
                     [("P", "B", "b", None, ts(1996, 6), "src")]):
        sat = spark.createDataFrame(existing, SAT_SCHEMA)
        expected = sat
        for y, pairs in batches.items():
            expected = expected.unionByName(
                V.sat_load(_batch(spark, ts(y), *pairs), expected, "pk", "hd", SAT_COLS))
        got = B.sat_backfill(staged, sat if existing else None, "pk", "hd", SAT_COLS, "t")
        assert rows(got) == rows(expected), existing


def test_batches_in_order_are_folded_without_a_load_per_year(spark, monkeypatch):
    from vaultmart.plans import backfill as B

    def batch(y, pairs):
        nulled = F.when(F.col("hd") != "none", F.col("hd"))
        return _batch(spark, ts(y), *pairs).withColumn("hd", nulled)

    batches = {1995: [("P", "A"), ("Q", "A"), (None, "A"), ("R", "none")], 1996: [("P", "B"), ("Q", "A"), ("R", "none")],
               1997: [("P", "A"), ("P", "A"), ("P", "C"), (None, "A")], 1998: [("P", "B"), ("P", "C"), ("Q", "B")]}
    stage_all = None
    for y, pairs in batches.items():
        b = batch(y, pairs)
        stage_all = b if stage_all is None else stage_all.unionByName(b)
    staged = B.StagedBatches(stage_all, "t-stage")
    for existing in ([], [("P", "A", "a", None, ts(1990), "src"), ("P", "B", "b", None, ts(1989), "src")]):
        sat = spark.createDataFrame(existing, SAT_SCHEMA)
        expected = sat
        for y, pairs in batches.items():
            expected = expected.unionByName(V.sat_load(batch(y, pairs), expected, "pk", "hd", SAT_COLS))
        expected = rows(expected)
        with monkeypatch.context() as m:
            m.setattr(V, "sat_load", None)
            assert rows(B.sat_backfill(staged, sat if existing else None, "pk", "hd", SAT_COLS, "t")) == expected
