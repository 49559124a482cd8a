import math
import re
import tracemalloc
from collections import Counter

import numpy as np
import pytest

from tests.llm.conftest import EDGE, crc
from vaultmart.llm import lm_score, quality, toxicity


def slow_scores(docs, order, mass):
    counts = [Counter() for _ in range(order + 1)]
    tokens = []
    for doc_id, text in docs:
        seq = ["<s>"] + (text or "").encode().lower().split() + ["</s>"]
        tokens.append(seq)
        if (crc(doc_id) if doc_id is not None else 0) % 7 != 2:
            for n in range(1, order + 1):
                counts[n].update(tuple(seq[k - n + 1:k + 1]) for k in range(n - 1, len(seq)))
    starts = counts[1][("<s>",)]
    total = sum(counts[1].values()) - starts
    distinct = len([k for k in counts[1] if k != ("<s>",) and counts[1][k]])
    out = []
    for (doc_id, _), seq in zip(docs, tokens):
        score = base = known = 0
        for k in range(1, len(seq)):
            p = (counts[1][(seq[k],)] + 1) / (total + distinct + 1)
            base += math.log10(p)
            known += counts[1][(seq[k],)] > 0
            for n in range(2, order + 1):
                history = counts[n - 1][tuple(seq[k - n + 1:k])] if k - n + 1 >= 0 else 0
                if history:
                    p = (counts[n][tuple(seq[k - n + 1:k + 1])] + mass * p) / (history + mass)
            score += math.log10(p)
        out.append((doc_id, len(seq) - 1, known, total, base, score))
    return out


def compare(df, docs, order):
    got = sorted(map(tuple, lm_score.score(df, order=order, mass=50.0).drop("held_out").collect()),
                 key=lambda t: (t[0] is not None, t[0] or 0, t[4]))
    want = sorted(slow_scores(docs, order, 50.0), key=lambda t: (t[0] is not None, t[0] or 0, t[4]))
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert np.allclose([g[4:] for g in got], [w[4:] for w in want], rtol=1e-9)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_match_a_plain_model(edge_docs, order):
    compare(edge_docs, [r[:2] for r in EDGE], order)


def test_long_texts_are_walked_over_block_borders(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "BLOCK_BYTES", 40)
    monkeypatch.setattr(lm_score, "SHARD_BYTES", 200)
    docs = [(i, " ".join(f"w{(i * j) % 13}" for j in range(60))) for i in range(30)]
    compare(spark.createDataFrame(docs, "doc_id long, text string"), docs, 3)


def test_rows_of_many_shards_grow_with_the_ngrams_only(spark, monkeypatch):
    """A shard a byte: a block's rows are bounded by its distinct n-grams, at two sizes,
    and the scores are those of the plain model."""
    monkeypatch.setattr(lm_score, "BLOCK_BYTES", 60)
    monkeypatch.setattr(lm_score, "SHARD_BYTES", 4)
    for size in (12, 24):
        docs = [(i, " ".join(f"w{(i * j) % 11}" for j in range(14))) for i in range(size)]
        df = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
        compare(df, docs, 3)
        shards = sum(len(t) for _, t in docs) // 4
        found = df.mapInArrow(lm_score._blocks(3, 7, 2, 1000 * shards, True), lm_score.ROWS_DDL).collect()
        assert len({(r["block"], r["shard"]) for r in found}) == len(found)
        grams = sum(sum(r["sizes"]) for r in found)
        assert all(sum(r["sizes"]) for r in found) and len(found) <= grams <= 3 * 17 * size + 3 * size


def test_shards_are_slices_of_sorted_hashes():
    rng = np.random.default_rng(1)
    keys = np.unique(np.concatenate([rng.integers(0, 1 << 64, 500, np.uint64), np.array([0, (1 << 64) - 1], np.uint64)]))
    for shards in (1, 2, 3, 7, 1000, (1 << 32) - 1):
        dealt = lm_score._dealt(keys, shards)
        want: dict = {}
        for n, k in enumerate(keys.tolist()):
            want.setdefault(k * shards >> 64, []).append(n)
        assert {s: list(range(a, b)) for s, (a, b) in dealt.items()} == want
    assert lm_score._dealt(keys[:0], 5) == {}


def test_scores_of_no_documents(no_docs):
    assert lm_score.score(no_docs).count() == 0


def labelled(spark, real_docs):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    return docs, labels


@pytest.mark.parametrize("module,label,least", [(toxicity, "toxic", 0.85), (quality, "quality", 0.95)])
def test_held_out_accuracy(spark, real_docs, module, label, least):
    docs, labels = labelled(spark, real_docs)
    scored = module.scored(docs, module.train(docs, labels))
    rows = scored.join(labels.dropDuplicates(["doc_id"]), "doc_id").where("held_out").toPandas()
    found = rows[rows[label] == 1]["predicted"].mean()
    clean = 1 - rows[rows[label] == 0]["predicted"].mean()
    assert found > least and clean > 0.95, (found, clean)
    assert rows["score"].between(0, 1).all()
    assert (scored.where("doc_id is not null and held_out").first()["doc_id"] is not None)


@pytest.mark.parametrize("module", [toxicity, quality])
def test_edge_cases_are_scored(spark, edge_docs, no_docs, module):
    labels = spark.createDataFrame([(1, 1, 1), (2, 0, 0), (2, 0, 1), (6, None, None), (None, 1, 1), (99, 0, 0), (7, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    model = module.train(edge_docs, labels)
    rows = module.scored(edge_docs, model).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r[0]) for r in EDGE)
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert [r["held_out"] for r in rows if r["doc_id"] == 1] == [crc(1) % 5 == 0]
    assert module.scored(no_docs, model).count() == 0
    bare = module.train(edge_docs, labels.where("false"))
    assert {r["score"] for r in module.scored(edge_docs, bare).collect()} == {0.0 if module is toxicity else 0.5}


def test_isotonic_is_the_nearest_rising_step_function():
    x, y = toxicity.isotonic(np.array([1.0, 2, 3, 4, 5]), np.array([0.0, 1, 0, 1, 1]))
    assert np.interp([1, 2, 3, 4, 5], x, y).tolist() == [0, 0.5, 0.5, 1, 1]


def test_features_do_not_depend_on_chunks(monkeypatch):
    texts = ["You IDIOT you", "", "c l 1d10t!! " * 50, "plain words here"] * 3
    lexicon = toxicity.learn_lexicon(texts, np.array([True, False, True, False] * 3))
    lexicon = {"words": toxicity.hash_of([b"idiot"]), "stems": lexicon["stems"][:0]}
    whole = toxicity.features(texts, lexicon)
    assert whole[0][3] > 0 and whole[2][2] > 0
    from vaultmart.llm import textbytes
    monkeypatch.setattr(textbytes, "CHUNK", 700)
    assert np.allclose(toxicity.features(texts, lexicon), whole)


def test_only_near_copies_of_one_label_are_left_out():
    """Texts that share their three smallest word hashes, and little else."""
    words = [f"w{n}" for n in range(4000)]
    by_hash = [words[i] for i in np.argsort(toxicity.hash_of([w.encode() for w in words]))]
    shared, other = by_hash[:3], by_hash[3:]
    far = [" ".join(shared + other[100 * n:100 * n + 100]) for n in range(10)]
    near = [far[0] + " one", far[0] + " two more", far[1], far[1].upper()]
    texts = far + near + ["", " "]
    labels = np.array([0, 1] * 5 + [0, 1, 1, 0] + [0, 0])
    # far[0] is 0 and far[1] is 1, so near[1] and near[3] stay
    kept = toxicity.varied(texts, labels).tolist()
    assert kept == [*range(10), 11, 13, 14]


def test_registered_scores_use_trigrams_and_fitted_masses(spark, real_docs, monkeypatch):
    """Left-out training tokens fail as often as the fitted masses expect, and
    held-out texts are told better than by the old bigram mass."""
    monkeypatch.setattr(lm_score, "BLOCK_BYTES", 1 << 18)
    monkeypatch.setattr(lm_score, "SHARD_BYTES", 1 << 18)
    used = []
    fitted = lm_score.fitted_masses
    monkeypatch.setattr(lm_score, "fitted_masses", lambda *a: used.append(fitted(*a)) or used[-1])
    got = {r["doc_id"]: r for r in lm_score.score(real_docs).collect()}
    counts = [Counter() for _ in range(4)]
    for r in real_docs.collect():
        seq = ["<s>"] + r["text"].encode().lower().split() + ["</s>"]
        if crc(r["doc_id"]) % 7 != 2:
            for n in (1, 2, 3):
                counts[n].update(tuple(seq[k - n + 1:k + 1]) for k in range(n - 1, len(seq)))
    want = []
    for n in (2, 3):
        once = sum(c == 1 for c in counts[n].values())
        history = [c for h, c in counts[n - 1].items() if h[-1] != "</s>"]
        want.append(max([m for m in lm_score.MASSES if sum(c * m / (c - 1 + m) for c in history) <= once],
                        default=lm_score.MASSES[0]))
    assert used == [want]
    old = {r["doc_id"]: r for r in lm_score.score(real_docs, order=2, mass=2000.0).collect()}
    held = [d for d, r in got.items() if r["held_out"]]
    mean = [sum(x[d]["score"] for d in held) / sum(x[d]["n_tokens"] for d in held) for x in (got, old)]
    assert mean[0] > mean[1] + 0.05, mean


def test_one_toxic_text_is_told_from_clean_ones():
    """Far below the usual number of labelled texts, and with copies of the one."""
    clean = [f"the report of week {n} says that sales of item {n % 7} went well and the team met" for n in range(40)]
    bad = "you are a worthless zorgling and everybody hates you you zorgling"
    for toxic in ([bad], [bad] * 6, [bad, "shut up you stupid zorgling nobody likes you"]):
        texts = clean + toxic
        model = toxicity.fit(texts, np.array([0] * len(clean) + [1] * len(toxic)))
        score = toxicity.predict(model, texts)
        assert score[len(clean):].min() > 0.5 > score[:len(clean)].max()
    assert toxicity.fit(clean, np.zeros(len(clean), int)) == {"constant": 0.0}
    assert toxicity.fit(["", " "], np.array([0, 1])) == {"constant": 0.0}


def slow_tree_sums(x, y, trees=2, depth=2):
    """Newton trees by trying every split between the bins of fit_trees, one row at a time."""
    edges = [sorted({float(e) for e in np.quantile(c, np.linspace(0, 1, toxicity.BINS + 1)[1:-1])}
                    | ({float(e) * (1 - 1e-9) for e in np.quantile(c[c > 0], np.linspace(0, 1, 9)[:-1])} if (c > 0).any() else set()))
             for c in x.T]
    rate = min(max(y.mean(), 1e-3), 1 - 1e-3)
    total = [math.log(rate / (1 - rate))] * len(y)
    for _ in range(trees):
        g = [yy - 1 / (1 + math.exp(-t)) for yy, t in zip(y, total)]
        h = [1 / (1 + math.exp(-t)) * (1 - 1 / (1 + math.exp(-t))) for t in total]
        leaves = [list(range(len(y)))]
        for _ in range(depth):
            split = []
            for rows in leaves:
                best = (1e-9, None, None)
                for f, es in enumerate(edges):
                    for e in es:
                        left = [r for r in rows if x[r, f] <= e]
                        right = [r for r in rows if x[r, f] > e]
                        hl, hr = sum(h[r] for r in left), sum(h[r] for r in right)
                        if hl < 0.5 or hr < 0.5:
                            continue
                        gl, gr = sum(g[r] for r in left), sum(g[r] for r in right)
                        gain = gl ** 2 / (hl + 1) + gr ** 2 / (hr + 1) - (gl + gr) ** 2 / (hl + hr + 1)
                        if gain > best[0] + 1e-12:
                            best = (gain, f, e)
                _, f, e = best
                split += [[r for r in rows if f is None or x[r, f] <= e], [r for r in rows if f is not None and x[r, f] > e]]
            leaves = split
        for rows in leaves:
            value = toxicity.RATE * sum(g[r] for r in rows) / (sum(h[r] for r in rows) + 1)
            for r in rows:
                total[r] += value
    return np.array(total)


def test_trees_match_exhaustive_splits(monkeypatch):
    rng = np.random.default_rng(3)
    x = np.round(rng.random((50, 4)), 2)
    x[:, 3] *= rng.random(50) < 0.3
    y = (x[:, 0] + x[:, 3] + 0.2 * rng.random(50) > 0.8) * 1.0
    monkeypatch.setattr(toxicity, "TREES", 2)
    monkeypatch.setattr(toxicity, "DEPTH", 2)
    assert np.allclose(toxicity.tree_sum(toxicity.fit_trees(x, y), x), slow_tree_sums(x, y))


def test_labels_without_documents_take_no_places(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(1, 40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(1, 4000)], "doc_id long, toxic int")
    want = sum(crc(i) % 5 != 0 for i in range(1, 40))
    assert toxicity.labelled_sample(docs, labels, "toxic", 35).count() == min(35, want) > 20


def test_long_texts_without_white_space_are_read_whole_in_bounded_memory():
    """64 MB in one word: every byte comes by, whole characters at a time, and memory stays under 1 GB."""
    from vaultmart.llm import textbytes
    text = "aé" * 1000
    old, textbytes.CHUNK = textbytes.CHUNK, 7
    try:
        parts = [bytes(data[:-1]).decode() for data, _, number in textbytes.chunks([text])]
    finally:
        textbytes.CHUNK = old
    assert "".join(parts) == text and max(map(len, parts)) <= 14
    long = "abcdefgh" * (8 << 20)
    slopes = np.zeros(quality.BUCKETS, np.float32)
    lexicon = {"words": toxicity.hash_of([b"idiot"]), "stems": np.zeros(0, np.uint64)}
    tracemalloc.start()
    try:
        quality.predict(slopes, [long])
        got = toxicity.features([long], lexicon)
        assert tracemalloc.get_traced_memory()[1] < 1 << 30
    finally:
        tracemalloc.stop()
    assert got.shape[0] == 1


def plain_quality_features(text):
    """Buckets of a text's features, one string at a time."""
    words = text.encode().split()
    hashes = [int(toxicity.hash_of([w])[0]) for w in words]
    found = [quality.FIRST + h % (quality.BUCKETS - quality.FIRST) for h in hashes]
    for back, bucket in zip((1, 2), quality.AGAIN):
        found += [bucket for a, b in zip(words, words[back:]) if a == b]
    for word in words:
        marked = b" " + word + b" "
        for n in (3, 4):
            for k in range(len(marked) - n + 1):
                code = (0x811C9DC5 + n) & 0xFFFFFFFF
                for c in marked[k:k + n]:
                    code = (code ^ c) * 0x01000193 & 0xFFFFFFFF
                    code ^= code >> 15
                found.append(quality.FIRST + code % (quality.BUCKETS - quality.FIRST))
    return Counter([quality.CONSTANT, *found])


QUALITY_TEXTS = ["the cat sat on on the mat", "", "a", "\n\tab  cd ", "on on", "Ünïcödé é\u2003x wörter", "x" * 30, " ",
                 "buy now buy now now now", "fin"]


def test_quality_features_equal_plain_ones(monkeypatch):
    """Whatever texts stand beside a text, and wherever long ones are cut."""
    want = [plain_quality_features(t) for t in QUALITY_TEXTS]
    from vaultmart.llm import textbytes
    for chunk in (1 << 20, 40):
        monkeypatch.setattr(textbytes, "CHUNK", chunk)
        for texts, expected in ((QUALITY_TEXTS, want), (QUALITY_TEXTS[::-1], want[::-1])):
            got = [Counter(dict(zip(b.tolist(), c.tolist()))) for b, c in quality.counted(texts)]
            assert got == expected
            alone = [Counter(dict(zip(b.tolist(), c.tolist()))) for t in texts for b, c in quality.counted([t])]
            assert alone == expected


def plain_quality_model(texts, labels, epochs, rate):
    """The same steps of gradient descent, number by number; the loss is checked to be
    the softmax's cross entropy by its own differences."""
    rng = np.random.default_rng(7)
    vectors = rng.uniform(-1 / quality.WIDTH, 1 / quality.WIDTH, (quality.BUCKETS, quality.WIDTH)).astype(np.float32)
    vectors, layer = vectors.astype(float), [[0.0, 0.0] for _ in range(quality.WIDTH)]
    bags = [plain_quality_features(t) for t in texts]
    steps, step = epochs * len(bags), 0

    def loss(hidden, layer, label):
        z = [sum(h * row[c] for h, row in zip(hidden, layer)) for c in (0, 1)]
        return math.log(sum(math.exp(v) for v in z)) - z[label]

    for _ in range(epochs):
        for i in rng.permutation(len(bags)):
            now, step = rate * (1 - step / steps), step + 1
            bag, size, label = bags[i], sum(bags[i].values()), int(labels[i])
            hidden = [sum(n * vectors[b][k] for b, n in bag.items()) / size for k in range(quality.WIDTH)]
            eps = 1e-6
            by_layer = [[0.0, 0.0] for _ in range(quality.WIDTH)]
            by_hidden = [0.0] * quality.WIDTH
            for k in range(quality.WIDTH):
                for c in (0, 1):
                    up, down = ([r[:] for r in layer] for _ in range(2))
                    up[k][c] += eps
                    down[k][c] -= eps
                    by_layer[k][c] = (loss(hidden, up, label) - loss(hidden, down, label)) / (2 * eps)
                up, down = hidden[:], hidden[:]
                up[k] += eps
                down[k] -= eps
                by_hidden[k] = (loss(up, layer, label) - loss(down, layer, label)) / (2 * eps)
            layer = [[w - now * g for w, g in zip(row, slope)] for row, slope in zip(layer, by_layer)]
            for b, n in bag.items():
                for k in range(quality.WIDTH):
                    vectors[b][k] -= now * math.sqrt(len(bag)) * n / size * by_hidden[k]
    out = []
    for bag in bags:
        hidden = [sum(n * vectors[b][k] for b, n in bag.items()) / sum(bag.values()) for k in range(quality.WIDTH)]
        z = [sum(h * row[c] for h, row in zip(hidden, layer)) for c in (0, 1)]
        out.append(1 / (1 + math.exp(z[0] - z[1])))
    return out


def test_quality_training_and_scores_equal_plain_ones(monkeypatch):
    monkeypatch.setattr(quality, "EPOCHS", 40)
    labels = np.array([1, 0, 1, 1, 0, 1, 1, 0, 0, 1])
    model = quality.fit(QUALITY_TEXTS, labels)
    want = plain_quality_model(QUALITY_TEXTS, labels, quality.EPOCHS, quality.RATE)
    got = quality.predict(quality.slopes(model), QUALITY_TEXTS)
    assert np.allclose(got, want, atol=1e-4) and np.ptp(want) > 0.1, (got, want)
    # a score does not depend on the texts that are scored with it
    alone = [quality.predict(quality.slopes(model), [t])[0] for t in QUALITY_TEXTS]
    assert np.allclose(got, alone, atol=1e-9) and got[1] == got[7]


def plain_toxicity_features(text, words, stems):
    """The row of FEATURES of one text, by patterns over its bytes."""
    data = text.encode()
    lower = bytes(b + 32 if 65 <= b <= 90 else b for b in data)
    undone = lower.translate(bytes.maketrans(*toxicity.SUBSTITUTES))

    def found(of):
        out = []
        for m in re.finditer(rb"[0-9A-Za-z\x80-\xff]+", of):
            w = m[0]
            out.append((m.start(), w in words, any(len(w) > n and w[:n] in stems for n in toxicity.STEMS), w))
        return out

    plain, other = found(lower), found(undone)
    n = max(len(plain), 1)
    hits = [k for k, (_, a, b, _) in enumerate(plain) if a or b]
    hidden = {s for s, a, b, _ in other if a or b} - {plain[k][0] for k in hits}
    you = [k for k, (*_, w) in enumerate(plain) if w.decode(errors="replace") in toxicity.SECOND_PERSON]
    near = [min((abs(k - y) for y in you), default=None) for k in hits]
    near = [d for d in near if d is not None]
    word, stem = sum(a for _, a, _, _ in plain), sum(b for _, _, b, _ in plain)
    count = lambda pattern: len(re.findall(pattern, data))
    punct, letter = rb"[!-/:-@\[-`{-~]", rb"[A-Za-z\x80-\xff]"
    visible = max(sum(b not in b" \t\n\x0b\x0c\r" for b in data), 1)
    inner = rb"(?:[0-9]|(?!['-])" + punct + rb")"
    return [word / n, stem / n, len(hidden) / n, math.log1p(word), math.log1p(stem), len(you) / n,
            sum(d <= toxicity.WINDOW for d in near) / n, sum(1 / (1 + d) for d in near) / n,
            count(rb"[A-Z]") / max(count(letter), 1), count(rb"[A-Z]{3,}") / n, count(rb"[!?]") / visible,
            count(punct) / visible, count(punct + rb"{2,}") / n, count(rb"(?<=" + letter + rb")" + inner + rb"(?=" + letter + rb")") / n,
            count(rb"(?=(" + letter + rb")\1\1)") / visible, count(rb"[0-9]") / visible]


def test_toxicity_features_equal_plain_ones():
    texts = ["You IDIOT you!!", "", "such 1d10t!! st@pid $tupid people -- sooo bad", "plain words, don't worry", " \n",
             "idiot one two three four five six seven eight your stupidity", "é du Stupide?! b.a.d AAA b-d 'x'y", "you you",
             "idiotic idiots\nare\tyou? 3 4 5"]
    words, stems = [b"idiot", b"bad"], [b"stup", b"idioti"]
    lexicon = {"words": np.sort(toxicity.hash_of(words)),
               "stems": np.sort(np.array([int(toxicity.hash_of([s])[0]) ^ len(s) for s in stems], np.uint64))}
    got = toxicity.features(texts, lexicon)
    want = [plain_toxicity_features(t, words, stems) for t in texts]
    for name, g, w in zip(toxicity.FEATURES, got.T, np.array(want).T):
        assert np.allclose(g, w), (name, g.tolist(), w.tolist())


def test_lexicon_equals_a_plain_count():
    rng = np.random.default_rng(5)
    names = [f"w{n}x{n % 17}" for n in range(300)]
    texts = [" ".join(rng.choice(names, 30)) + (f" slur{rng.integers(4)}ling vermin" if n % 5 == 0 else "") for n in range(200)]
    toxic = np.arange(200) % 5 == 0
    got = toxicity.learn_lexicon(texts, toxic)
    bad, good = Counter(), Counter()
    for text, is_bad in zip(texts, toxic):
        of = {w.encode() for w in text.split()}
        entries = of | {(w[:n], n) for w in of for n in toxicity.STEMS if len(w) > n}
        (bad if is_bad else good).update(entries)
    want = {e for e, n in bad.items() if n >= max(3, 0.005 * toxic.sum())
            and (n + 0.1) / (toxic.sum() + 1) * ((~toxic).sum() + 1) / (good[e] + 0.1) >= 20}
    assert len(want) > 3
    assert sorted(got["words"].tolist()) == sorted(int(toxicity.hash_of([e])[0]) for e in want if isinstance(e, bytes))
    assert sorted(got["stems"].tolist()) == sorted(int(toxicity.hash_of([e[0]])[0]) ^ e[1] for e in want if not isinstance(e, bytes))
