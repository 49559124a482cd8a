import hashlib
import random
from types import SimpleNamespace

import numpy as np
import pytest
import xxhash

from tests.helpers import rows
from tests.llm.conftest import EDGE
from vaultmart.llm import exact_dedup, simhash


def norm(text):
    return "".join(c for c in (text or "") if c not in " \t\n\x0b\x0c\r")


def expected_groups(docs):
    groups = {}
    for doc_id, text in docs:
        groups.setdefault(norm(text), []).append((-len(text or ""), doc_id is None, doc_id or 0, doc_id))
    out = []
    for doc_id, text in docs:
        keep = min(groups[norm(text)])[3]
        out.append((doc_id, keep, len(groups[norm(text)]), doc_id == keep,
                    hashlib.sha256(norm(text).encode()).hexdigest()))
    return sorted(out, key=lambda t: tuple((x is not None, x) for x in t))


def test_exact_groups_on_edge_cases(edge_docs, no_docs):
    got = rows(exact_dedup.groups(edge_docs), "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert got == expected_groups([r[:2] for r in EDGE])
    assert exact_dedup.groups(no_docs).count() == 0


def test_unique_rows_returns_one_whole_row_a_group(edge_docs, no_docs):
    got = exact_dedup.unique_rows(edge_docs)
    assert got.columns == edge_docs.columns
    kept = sorted((r["doc_id"] is None, r["doc_id"], r["digest"]) for r in got.collect())
    # 2 beats 1 by length, once; of the empty texts the three blanks win
    assert kept == [(False, 2, "clash"), (False, 5, "clash"), (False, 6, "clash"), (False, 7, "clash"), (True, None, "clash")]
    assert exact_dedup.unique_rows(no_docs).count() == 0


def test_exact_groups_with_a_hot_text_over_many_tasks(spark):
    docs = [(i, "hot  text" if i % 3 == 0 else f"text {i % 50}") for i in range(3000)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(40)
    got = rows(exact_dedup.groups(df), "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert got == expected_groups(docs)
    assert exact_dedup.unique_rows(df).count() == 51


def test_content_decides_where_digests_collide(spark, monkeypatch):
    # two bits of a digest and no tag; nested functions and a plain namespace reach the workers by value
    def short(data):
        return SimpleNamespace(digest=lambda: bytes([len(data) % 4]))

    monkeypatch.setattr(exact_dedup, "hashlib", SimpleNamespace(sha256=short))
    monkeypatch.setattr(exact_dedup, "xxhash", SimpleNamespace(xxh64_intdigest=lambda data: 0))
    docs = [(i, f"text {i % 37}" * (1 + i % 3)) for i in range(300)] + [(999, "alone in its class of lengths")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    found = rows(exact_dedup.groups(df), "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert {r[4] for r in found} <= {"00", "01", "02", "03"}
    got = [r[:4] for r in found]
    monkeypatch.undo()
    assert got == [r[:4] for r in expected_groups(docs)]


def slow_fingerprint(text, width=3):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + width]) for i in range(len(words) - width + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(docs):
    """component of each row by comparing all pairs of fingerprints."""
    prints = [slow_fingerprint(t) for _, t in docs]
    codes = sorted(set(prints))
    group = {c: {c} for c in codes}
    for i, a in enumerate(codes):
        for b in codes[i + 1:]:
            if (a ^ b).bit_count() <= 2 and group[a] is not group[b]:
                group[a] |= group[b]
                for c in group[b]:
                    group[c] = group[a]
    least = {}
    for (doc_id, _), p in zip(docs, prints):
        key = min(group[p])
        if doc_id is not None:
            least[key] = min(least.get(key, doc_id), doc_id)
    return sorted(((d, f"{p:016x}", least.get(min(group[p]))) for (d, _), p in zip(docs, prints)),
                  key=lambda t: tuple((x is not None, x) for x in t))


def test_simhash_on_edge_cases(edge_docs, no_docs):
    got = rows(simhash.near_duplicates(edge_docs), "doc_id", "fingerprint", "component_id")
    assert got == slow_components([r[:2] for r in EDGE])
    assert simhash.near_duplicates(no_docs).count() == 0
    assert simhash.representatives(no_docs).count() == 0


def test_representatives_keep_one_row_a_class(spark, edge_docs):
    rows_in = [(1, "a b c"), (1, "x y z"), (0, "a  B c"), (None, "x y z"), (None, "n u l l"), (None, "n u l l"), (7, "q")]
    df = spark.createDataFrame(rows_in, "doc_id long, text string")
    got = sorted(((r["doc_id"], r["text"]) for r in simhash.representatives(df).collect()), key=str)
    assert got == sorted([(0, "a  B c"), (1, "x y z"), (None, "n u l l"), (7, "q")], key=str)
    kept = simhash.representatives(edge_docs)
    assert kept.columns == edge_docs.columns
    assert kept.count() == len({f for _, f, _ in slow_components([r[:2] for r in EDGE])})


def test_simhash_on_near_copies(spark, real_docs):
    rnd = random.Random(3)
    texts = [r["text"] for r in real_docs.limit(40).collect()]
    docs = [(i, t) for i, t in enumerate(texts)]
    for n in range(260):
        words = texts[n % 8].split(" ")
        words[rnd.randrange(len(words))] = f"w{n}"
        docs.append((1000 - n, " ".join(words)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows(simhash.near_duplicates(df), "doc_id", "fingerprint", "component_id") == slow_components(docs)


@pytest.mark.parametrize("limit", [16_384, 40])
def test_links_connect_what_all_pairs_connect(spark, monkeypatch, limit):
    """Chains of codes two bits apart, dense balls, and random codes; a small
    group limit makes the groups split several times."""
    monkeypatch.setattr(simhash, "GROUP_LIMIT", limit)
    rng = np.random.default_rng(5)
    codes = set(rng.integers(0, 1 << 63, 300, dtype=np.uint64).tolist())
    for centre in (0, (1 << 64) - 1, 0x123456789ABCDEF0):
        codes |= {centre ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 64, (120, 2))}
    chain = 0x0F0F0F0F0F0F0F0F
    for bit in range(0, 60, 2):
        chain ^= 3 << bit
        codes.add(chain)
    codes = np.array(sorted(codes), np.uint64)
    parent = np.arange(len(codes))
    for i in range(len(codes)):
        j = np.flatnonzero(np.bitwise_count(codes ^ codes[i]) <= 2)
        parent = simhash.merged(parent, np.full(len(j), i), j)
    df = spark.createDataFrame([(int(c),) for c in codes.view(np.int64)], "code long")
    found = {r["code"]: r["root"] for r in simhash.components(simhash.links(df)).collect()}
    signed = codes.view(np.int64).tolist()
    got = [found.get(c, c) for c in signed]
    assert len(set(zip(got, parent.tolist()))) == len(set(got)) == len(set(parent.tolist()))


def test_gray_index_finds_each_near_pair_once():
    rng = np.random.default_rng(1)
    codes = np.unique(np.concatenate([rng.integers(0, 1 << 12, 900, dtype=np.uint64),
                                      rng.integers(0, 1 << 63, 900, dtype=np.uint64)]))
    index = simhash.GrayIndex(codes)
    got = sorted((int(i), int(j)) for a, b in index.pairs(2) for i, j in zip(a, b))
    near = np.bitwise_count(index.codes[:, None] ^ index.codes[None, :]) <= 2
    assert got == sorted((int(i), int(j)) for i, j in zip(*np.nonzero(np.triu(near, 1))))


def test_simhash_classes_of_hot_and_rare_codes(spark, monkeypatch):
    """A third of the rows share a code, others have few rows; whatever counts as
    hot, every row keeps its class."""
    docs = spark.createDataFrame([(i, "the hot text of many copies" if i % 3 == 0 else f"rare text number {i % 400}")
                                  for i in range(1200)], "doc_id long, text string")
    found = []
    for most in (1, 10, 1000):
        monkeypatch.setattr(simhash, "HOT_CODES", most)
        found.append(sorted(tuple(r) for r in simhash.near_duplicates(docs).collect()))
    assert len(found[0]) == 1200 and found[0] == found[1] == found[2]
    assert {r[2] for r in found[0] if r[0] % 3 == 0} == {0}
