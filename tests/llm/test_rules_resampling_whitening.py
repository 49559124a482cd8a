"""Quality rules, importance resampling and whitening against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from tests.helpers import rows
from tests.llm.conftest import EDGE
from vaultmart.functions.lineage import ScratchTable
from vaultmart.llm import compression, resampling, whitening

# ---------------------------------------------------------------- quality rules


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] >= 2 for k in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered),
            len(words) < 50 or 100 * len(covered) > 50 * len(words))


def plain_kept(text):
    data = (text or "").encode()
    packer = zstandard.ZstdCompressor(level=3)

    def bad(part):
        found = [b for b in compression.BANDS if b[0] <= len(part)]
        ratio = len(packer.compress(part)) / len(part)
        return bool(found) and not found[-1][1] <= ratio <= found[-1][2]

    if not data:
        return True
    parts = [data[i:i + 4096] for i in range(0, len(data), 4096)]
    return not bad(data) and sum(len(p) for p in parts if bad(p)) <= 0.1 * len(data)


BASE = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


def expected_rules(docs):
    out = []
    for doc_id, text in docs:
        base = plain_counts(text)
        out.append((doc_id, *base, not base[-1] and plain_kept(text)))
    return sorted(out, key=lambda t: tuple((x is not None, x) for x in t))


def test_rules_on_edge_cases(edge_docs, no_docs):
    assert rows(compression.rules(edge_docs), *BASE) == expected_rules([r[:2] for r in EDGE])
    assert compression.rules(no_docs).count() == 0


def test_rules_on_real_texts(real_docs):
    docs = [(r["doc_id"], r["text"]) for r in real_docs.select("doc_id", "text").collect()]
    assert rows(compression.rules(real_docs), *BASE) == expected_rules(docs)


def test_rules_reject_repetition_and_noise_in_whole_texts_and_chunks(spark, real_docs):
    rng = random.Random(3)
    clean = max((r["text"] for r in real_docs.where("n_chars < 20000").orderBy("doc_id").limit(300).collect()
                 if plain_kept(r["text"]) and not plain_counts(r["text"])[-1]), key=len)
    noise = " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/", k=40))
                     for _ in range(200))
    again = " ".join(f"{i} buy now" for i in range(800))          # all windows differ
    part = clean + "\n" + noise
    docs = spark.createDataFrame([(1, clean), (2, noise), (3, again), (4, part)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in compression.rules(docs).collect()}
    assert {k: r["kept"] for k, r in got.items()} == {1: True, 2: False, 3: False, 4: False}
    assert not any(got[k]["base_failed"] for k in (1, 2, 4)) and got[4]["bad_share"] > 0.1
    assert not compression.outside(len(part.encode()), got[4]["ratio"])          # its chunks show it


def test_rules_keep_clean_documents_and_reject_bad_ones(spark, real_docs):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "quality")
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    got = compression.rules(docs).join(labels, "doc_id").where("not base_failed").groupBy("quality").agg(
        F.count("*").alias("n"), F.sum(F.col("kept").cast("int")).alias("kept")).collect()
    share = {r["quality"]: r["kept"] / r["n"] for r in got}
    assert share[1] >= 0.999 and share[0] < 0.6


def test_rules_over_a_long_unbroken_text_and_many_words():
    long = b"a" * 3_000_000
    packer = zstandard.ZstdCompressor(level=3)
    got = compression.measured(long, packer)
    assert got[0] == 1 and got[1] == len(long) and got[5]
    many = " ".join(str(i) for i in range(200_000)).encode()      # words over several pieces
    assert compression.repeated_words(many) == (200_000, 0)
    assert compression.repeated_words(many + b" 1 2 3") == (200_003, 6)


# ---------------------------------------------------------------- importance resampling

def plain_words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def plain_resample(docs, target, width=1, least=20, per_cent=10, buckets=10_000):
    def features(text):
        w = plain_words(text)
        return [" ".join(w[i:i + n]) for n in range(1, width + 1) for i in range(len(w) - n + 1)]

    def bucket(f):
        return zlib.crc32(f.encode()) % buckets

    s = Counter(bucket(f) for _, t in docs for f in features(t))
    t = Counter(bucket(f) for x in target for f in features(x))
    S, T = sum(s.values()), sum(t.values())
    out = []
    for doc_id, text in docs:
        found = features(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets))))
                     for b in map(bucket, found))
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(found), weight, score, None, len(plain_words(text))])
    can = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0]))
    for i, r in enumerate(can[:per_cent * len(can) // 100], 1):
        r[4] = i
    return sorted([tuple(r[:5]) for r in out], key=lambda t: tuple((x is not None, x) for x in t))


COLS = ["doc_id", "n_features", "weight", "score", "rank"]


def test_resampling_on_real_texts(spark, real_docs):
    target = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    docs = [(r["doc_id"], r["text"]) for r in real_docs.select("doc_id", "text").collect()]
    want = plain_resample(docs, [r["text"] for r in target.collect()])
    assert rows(resampling.resample(real_docs, target), *COLS) == want


def test_resampling_on_edge_cases(spark, edge_docs, no_docs):
    target = spark.createDataFrame([(1, "a b word"), (2, None)], "item_id long, text string")
    docs = [r[:2] for r in EDGE]
    for width in (1, 2, 3):
        got = rows(resampling.resample(edge_docs, target, least_words=2, per_cent=70, width=width), *COLS)
        assert got == plain_resample(docs, ["a b word", None], width, 2, 70)
    assert resampling.resample(no_docs, target).count() == 0
    assert rows(resampling.resample(edge_docs, target.limit(0)), *COLS) == plain_resample(docs, [])


def test_long_texts_give_the_same_features_over_many_pieces(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(5000)).encode()
    for width in (1, 2, 3):
        whole = Counter(np.concatenate(list(resampling.feature_buckets(text, width, resampling.Buckets(1000)))).tolist())
        with monkeypatch.context() as m:
            m.setattr(resampling, "PIECE", 7)
            cut = Counter(np.concatenate(list(resampling.feature_buckets(text, width, resampling.Buckets(1000)))).tolist())
        assert cut == whole


@pytest.mark.parametrize("digit,block", [(3, 2), (8, 5), (10, 12)])
def test_radix_sort_is_a_stable_sort(spark, digit, block):
    rng = random.Random(digit)
    data = [(i, rng.choice([-5, 0, 7, -(1 << 62), (1 << 62) + 3, rng.randrange(1000)]), rng.randrange(50))
            for i in range(700)]
    df = spark.createDataFrame(data, "pos long, a long, b long").withColumn("block", F.shiftright("pos", block))
    got = resampling.radix_sorted(ScratchTable.of(df.repartition(5).withColumn("first", F.col("pos")), "t"),
                                  [("a", True), ("b", False)], digit, block)
    want = [r[0] for r in sorted(data, key=lambda r: (-r[1], r[2], r[0]))]
    placed = sorted((r["pos"], r["first"]) for r in got.collect())
    assert [p for p, _ in placed] == list(range(700)) and [f for _, f in placed] == want


def test_radix_sort_of_equal_keys_and_of_no_rows(spark):
    df = spark.createDataFrame([(i * 10, 4, i) for i in range(9)], "pos long, a long, n long").withColumn("block", F.lit(0).cast("long"))
    got = resampling.radix_sorted(ScratchTable.of(df, "t"), [("a", True)])
    assert sorted((r["pos"], r["n"]) for r in got.collect()) == [(i, i) for i in range(9)]
    assert resampling.radix_sorted(ScratchTable.of(df.limit(0), "t"), [("a", True)]).count() == 0


def test_a_pass_moves_rows_through_one_exchange(spark):
    """Rows are dealt by block alone, so a hot key cannot fill a task."""
    df = spark.range(1000).select(F.col("id").alias("pos"), F.shiftright("id", 4).alias("block"), F.lit(7).cast("long").alias("key"))
    plan = resampling.radix_pass(df, F.col("key"))._jdf.queryExecution().executedPlan().toString()
    rows_dealt = [line for line in plan.splitlines() if "Exchange" in line and "REPARTITION_BY_COL" in line]
    assert len(rows_dealt) == 1 and "hashpartitioning(block" in rows_dealt[0]


# ---------------------------------------------------------------- whitening

def plain_whiten(vectors, most=8, weights="counts"):
    """(vec_id, component) -> values, sign free; all vectors of one length."""
    good = [(i, [math.floor(1024 * float(c)) + 100_000 for c in v]) for i, v in vectors
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = [x for _, x in good] if weights == "counts" else [list(x) for x in {tuple(x) for _, x in good}]
    n, total = len(fit), [sum(c) for c in zip(*fit)]
    m = np.array([[float(c - Fraction(s, n)) for c, s in zip(x, total)] for x in fit])
    V = m.T @ m / n
    e, u = np.linalg.eigh(V)
    order = [k for k in np.argsort(-e)[:most] if e[k] > 1e-12 * np.trace(V)]
    out = []
    for i, x in good:
        w = np.array([float(c - Fraction(s, n)) for c, s in zip(x, total)]) @ u
        dev = sum((n * c - s) ** 2 for c, s in zip(x, total))
        out += [(i, k + 1, n, dev, float(w[p] / math.sqrt(e[p])), float(e[p] / np.trace(V))) for k, p in enumerate(order)]
    return out


def same(got, want):
    """Equal rows, the sign of each component free but the same for all rows."""
    def key(r):
        return (r[0] is None, r[0] or 0, r[1], abs(r[4]))

    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    for k in {w[1] for w in want}:
        a = np.array([g[4] for g in got if g[1] == k])
        b = np.array([w[4] for w in want if w[1] == k])
        sign = np.sign(a @ b) or 1
        # rows of one id may be in another order: compare as sorted values too
        assert np.allclose(sorted(a * sign), sorted(b), atol=1e-8) and np.isclose(a @ b * sign, b @ b)
        assert np.allclose([g[5] for g in got if g[1] == k], [w[5] for w in want if w[1] == k], rtol=1e-10)


def values(df):
    return [(r["vec_id"], r["component"], r["n"], r["deviation"], r["whitened"], r["explained"]) for r in df.collect()]


def test_whitening_of_real_vectors(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    vectors = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    got = whitening.whiten(table)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    same(values(got), plain_whiten(vectors))
    assert {r[0] < 1e-6 for r in got.select("identity_error").distinct().collect()} == {True}


def edge_vectors(seed=5, n=60, d=4):
    rng = random.Random(seed)
    out = [(i, [rng.uniform(-2, 2) for _ in range(d)]) for i in range(n)]
    out += [(1000 + i, out[7][1]) for i in range(40)]              # one vector that a third share
    out += [(None, out[3][1]), (3, out[3][1]), (900, None), (901, [None] * d), (902, [math.nan] + [0.0] * (d - 1)),
            (903, [math.inf] + [0.0] * (d - 1)), (904, [0.0] * d)]
    return out


SCHEMA = "vec_id long, embedding array<double>, label int"


@pytest.mark.parametrize("weights", ["counts", "one"])
def test_whitening_of_nulls_copies_and_hot_vectors(spark, weights):
    vectors = edge_vectors()
    df = spark.createDataFrame([(*v, 1) for v in vectors], SCHEMA)
    for name in ("x", "white", "size", "n", "component", "weight"):
        df = df.withColumn(name, F.lit("clash"))
    for hot in (0.1, 2.0):                     # by broadcast, and none hot
        got = whitening.whiten(df.repartition(7), weights=weights, hot=hot)
        same(values(got), plain_whiten(vectors, weights=weights))
        assert max(r["identity_error"] for r in got.collect()) < 1e-8


def test_whitening_without_rows_spread_or_one_length(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert whitening.whiten(empty).count() == 0
    alone = spark.createDataFrame([(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0), (3, [], 0)], SCHEMA)
    assert whitening.whiten(alone).count() == 0                   # no spread: no components
    short, long = edge_vectors(1, 30, 3), [(5000 + i, v) for i, v in edge_vectors(2, 30, 5) if i is not None]
    got = values(whitening.whiten(spark.createDataFrame([(*v, 0) for v in short + long], SCHEMA)))
    same([g for g in got if g[0] is None or g[0] < 5000], plain_whiten(short))
    same([g for g in got if g[0] is not None and g[0] >= 5000], plain_whiten(long))


def test_deviations_of_any_size():
    x = np.array([[5, -3], [1 << 40, 2], [-(1 << 40), 1], [0, 0]], np.int64)
    total = [int(x[:, 0].sum()), int(x[:, 1].sum())]
    want = [sum((4 * int(v) - s) ** 2 for v, s in zip(row, total)) for row in x]
    assert whitening.deviations(x, 4, total) == [w if w < 1 << 63 else None for w in want]
    huge = whitening.whole_numbers(np.array([1e300, -1e300, 0.5]))
    assert huge.tolist() == [1 << 61, -(1 << 61), 100_512]
