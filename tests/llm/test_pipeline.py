"""The pipeline against its stages done slowly, and on edge cases."""

import pytest

import corpus_pipeline as P
from tests.llm.conftest import EDGE
from tests.llm.test_dedup_and_simhash import expected_groups, slow_components
from vaultmart.llm import mixing, packing, toxicity


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory, edge_docs):
    path = str(tmp_path_factory.mktemp("tables"))
    edge_docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (7, 1, 1), (6, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(
        f"{path}/labels.parquet")
    return path


def test_stages_on_real_rows(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    stage = dict(P.STAGES)
    kept = stage["toxicity"](spark, docs, sf)
    scores = {r["doc_id"]: r["score"] for r in toxicity.scored(docs, toxicity.train(
        docs, spark.read.parquet(f"{sf}/labels.parquet"))).collect()}
    clean = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert sorted(d for d, _ in clean) == sorted(d for d, s in scores.items() if s < 0.5)

    single = stage["exact dedup"](spark, kept, sf)
    want = {d for d, keep, *_ in expected_groups(clean) if d == keep}
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(want)

    left = [(d, t) for d, t in clean if d in want]
    near = stage["simhash near-dedup"](spark, single, sf)
    want = sorted(d for d, _, c in slow_components(left) if d == c)
    assert sorted(r["doc_id"] for r in near.collect()) == want

    mixed = stage["mixing"](spark, near, sf)
    assert mixed.columns == docs.columns
    assert sorted({r["doc_id"] for r in mixed.collect()}) == want
    packed = stage["packing"](spark, mixed, sf).toPandas()
    words = {d: len(t.split()) + 1 for d, t in left}
    assert packed.length.sum() == sum(words[r["doc_id"]] for r in mixed.collect())
    whole = P.run(spark, sf).toPandas()
    assert len(whole) == len(packed) and whole.length.sum() == packed.length.sum()


def test_edge_cases_pass_through(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in P.STAGES:
        out = stage(spark, docs, folder)
        assert out.count() > 0, name
        if name != "packing":
            assert out.columns == docs.columns
    assert P.run(spark, folder).count() > 0


def test_no_documents(spark, folder):
    none = spark.read.parquet(f"{folder}/documents.parquet").where("false")
    assert all(stage(spark, none, folder).count() == 0 for _, stage in P.STAGES)
    assert len(EDGE) == 9


def test_pipeline_keeps_the_mixed_order(spark, tmp_path, monkeypatch):
    """Stage 4 writes whole rows in the order of ``mix``, and packing deals runs of
    that order; files of unlike sizes are not read in the order they were written."""
    docs = spark.createDataFrame([(i, "w " * (i % 9), "hot" if i % 3 else f"s{i % 7}") for i in range(2000)],
                                 "doc_id long, text string, source string").repartition(7)
    want = [r["doc_id"] for r in mixing.mix(docs, block_tokens=500).orderBy("block", "position").collect()]
    mixed = mixing.mixed_rows(docs, block_tokens=500)
    assert [r["doc_id"] for r in mixed.collect()] == want
    mixed.write.parquet(f"{tmp_path}/mixed")
    for rows in (spark.read.parquet(f"{tmp_path}/mixed"), mixed):
        got = packing.pack(rows, shard_rows=300, in_order=True).toPandas()
        for n in range(-(-len(want) // 300)):
            shard = got[got["shard"] == n]
            assert sorted(shard.doc_id) == sorted(want[300 * n:300 * n + 300])
            first = {d: i for i, d in reversed(list(enumerate(want[300 * n:300 * n + 300])))}
            ahead = shard.groupby("bin").doc_id.apply(lambda ids: min(first[d] for d in ids))
            assert ahead.is_monotonic_increasing
    monkeypatch.setattr(P.packing, "pack", lambda docs, **options: options)
    assert P.packed(spark, docs, "") == {"in_order": True}
