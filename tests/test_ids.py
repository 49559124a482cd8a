"""Consecutive ids without a single-partition window."""

from pyspark.sql import functions as F

import pytest

from vaultmart.functions import ids as I
from vaultmart.functions.ids import append_sequence_ids


@pytest.fixture(params=["small", "distributed"])
def path(request, monkeypatch):
    if request.param == "distributed":
        monkeypatch.setattr(I, "SMALL_ROWS", 10)
    return request.param


def test_ids_continue_from_existing_max_in_order(spark, path):
    new = spark.range(0, 500, numPartitions=7).select((F.col("id") * 3 % 500).alias("k"))
    new = new.union(spark.createDataFrame([(None,)], "k long"))
    existing = spark.createDataFrame([(10, 1000)], "id long, k long")
    out = append_sequence_ids(new, [F.col("k").asc_nulls_last()], existing).collect()
    ids = sorted((r["id"], r["k"]) for r in out)
    assert [i for i, _ in ids] == list(range(11, 11 + 501))
    keys = [k for _, k in ids]
    assert keys[:-1] == sorted(k for k in keys if k is not None)
    assert keys[-1] is None  # NULLs last


def test_ids_on_empty_input(spark, path):
    new = spark.createDataFrame([], "k string")
    assert append_sequence_ids(new, [F.col("k").asc()], None).count() == 0
