"""Toxicity scores: gradient-boosted trees over dense features, calibrated.

Features of a text (``FEATURES``), all from whole texts: densities of a lexicon
of words and of word beginnings, also after undoing character substitutions;
how near lexicon words stand to second-person words; rates of capitals, of
punctuation and of obfuscation.

The lexicon is learnt: words and word beginnings of ``STEMS`` bytes that occur
far more often in toxic than in other training texts.  Near copies of a training
text with the same label are left out (``varied``).  The
training features of each fold of the sample use the lexicon of the other folds,
so the trees see the lexicon as it will behave on new texts.  Trees are fitted on logistic loss by
Newton steps over histograms; an isotonic fit on a quarter of the sample that
the trees have not seen turns their sum into a probability.

Labels come from at most ``SAMPLE`` labelled documents (those with the smallest
hash of doc_id), fitted in one task; the fitted model is a few hundred kB and is
sent to all tasks.  Scoring is one pass over all rows without a shuffle.

Defined results.  A word of more than 2 MB counts as several (``textbytes.chunks``).
NULL text is empty and is scored by its (zero) features.
doc_ids labelled more than once count with their highest label; NULL labels and
labels without a document are ignored.  With fewer than ``LEAST`` different labelled
training texts of a class the model is fitted without folds (``_fit_few``); only where
one class has none, every score is 0.  A NULL doc_id is scored and never trains.  Extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import pickle

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultmart.llm.common import held_out, id_and_text, named
from vaultmart.llm.textbytes import SpanHash, chunks, hash_of, member, runs

SAMPLE = 6_000           # most labelled documents that are learnt from
LEAST = 5                # fewer labelled documents of a class are learnt from without folds
STEMS = (4, 5, 6)        # bytes of the word beginnings tried for the lexicon
WINDOW = 6               # words within which a second-person word counts as near
NEAR = 0.8               # Jaccard similarity of the word sets of near copies
FOLDS = 5                # of the sample, for the lexicon
TREES, DEPTH, BINS, RATE = 60, 3, 32, 0.2

# Second-person words of the corpus languages.
SECOND_PERSON = ["you", "your", "yours", "yourself", "du", "dich", "dir", "dein", "deine", "ihr", "euch",
                 "sie", "tu", "te", "toi", "ton", "ta", "vous", "votre", "tú", "ti", "tus", "usted", "vosotros"]
# Characters written for letters.
SUBSTITUTES = (b"013457@$", b"oieastas")

FEATURES = ["word_density", "stem_density", "undone_density", "word_hits", "stem_hits", "second_person",
            "near_hits", "closeness", "capitals", "capital_words", "exclaims", "punctuation",
            "symbol_runs", "obfuscated", "repeated", "digits"]

_kind = np.zeros(256, np.uint8)                     # 1 letter, 2 digit, 4 white space, 8 punctuation
_kind[[c for c in range(256) if chr(c).isalpha() and c < 128 or c >= 128]] = 1
_kind[ord("0"):ord("9") + 1] = 2
_kind[[9, 10, 11, 12, 13, 32]] = 4
_kind[(_kind == 0) & (np.arange(256) > 32) & (np.arange(256) < 127)] = 8
_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
_undone = _lower.copy()
_undone[list(SUBSTITUTES[0])] = list(SUBSTITUTES[1])


class Words:
    """The words (letters and digits) of a chunk, lower-cased and hashed."""

    def __init__(self, data: np.ndarray, table: np.ndarray):
        self.data = table[data]
        self.start, self.end = runs(_kind[self.data] & 3 > 0)
        self.spans = SpanHash(self.data)
        self.hash = self.spans(self.start, self.end)

    def beginnings(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(places of longer words, hashes of their first ``size`` bytes)."""
        place = np.flatnonzero(self.end - self.start > size)
        return place, self.spans(self.start[place], self.start[place] + size) ^ np.uint64(size)


def _hits(words: Words, lexicon: dict) -> tuple[np.ndarray, np.ndarray]:
    word = member(words.hash, lexicon["words"])
    stem = np.zeros(len(words.hash), bool)
    for size in STEMS:
        place, hashes = words.beginnings(size)
        stem[place] |= member(hashes, lexicon["stems"])
    return word, stem


def features(texts, lexicon: dict) -> np.ndarray:
    """One row of FEATURES per text."""
    totals = np.zeros((len(texts), 20))
    second = np.sort(hash_of([w.encode() for w in SECOND_PERSON]))
    for data, offsets, number in chunks(texts):
        def per_text(places, weights=None):
            return np.bincount(np.searchsorted(offsets, places, "right") - 1, weights, len(offsets))

        words, kind = Words(data, _lower), _kind[data]
        word, stem = _hits(words, lexicon)
        plain = word | stem
        undone = Words(data, _undone)
        undone_word, undone_stem = _hits(undone, lexicon)
        hidden = (undone_word | undone_stem) & ~member(undone.start, words.start[plain])
        you = np.flatnonzero(member(words.hash, second))
        hit = np.flatnonzero(plain)
        distance = np.full(len(hit), 1e9)
        if len(you) and len(hit):
            at = np.searchsorted(you, hit)
            text_of = np.searchsorted(offsets, words.start, "right")
            for side in (np.maximum(at - 1, 0), np.minimum(at, len(you) - 1)):
                near = np.where(text_of[you[side]] == text_of[hit], np.abs(you[side] - hit), 1e9)
                distance = np.minimum(distance, near)
        upper = (data >= 65) & (data <= 90)
        letters = kind == 1
        capital_start, capital_end = runs(upper)
        shouted = capital_end - capital_start >= 3
        punct = kind == 8
        run_start, run_end = runs(punct)
        long_runs = run_end - run_start >= 2
        inner = (kind[1:-1] == 2) | punct[1:-1]
        obfuscated = 1 + np.flatnonzero(letters[:-2] & inner & letters[2:] & (data[1:-1] != 39) & (data[1:-1] != 45))
        repeated = 2 + np.flatnonzero((data[2:] == data[1:-1]) & (data[1:-1] == data[:-2]) & letters[2:])
        columns = [per_text(words.start), per_text(words.start[word]), per_text(words.start[stem]),
                   per_text(undone.start[hidden]), per_text(words.start[you]),
                   per_text(words.start[hit][distance <= WINDOW]),
                   per_text(words.start[hit], np.where(distance < 1e9, 1 / (1 + distance), 0)),
                   per_text(np.flatnonzero(upper)), per_text(np.flatnonzero(letters)),
                   per_text(capital_start[shouted]), per_text(np.flatnonzero((data == 33) | (data == 63))),
                   per_text(np.flatnonzero(punct)), per_text(run_start[long_runs]), per_text(obfuscated),
                   per_text(repeated), per_text(np.flatnonzero(kind == 2)),
                   per_text(np.flatnonzero(kind != 4))]
        for c, values in enumerate(columns):
            np.add.at(totals[:, c], number, values)
    (n, word, stem, hidden, you, near, close, upper, letters, shouted, exclaims, punct, long_runs,
     obfuscated, repeated, digits, visible) = totals[:, :17].T
    per_word, per_byte = 1 / np.maximum(n, 1), 1 / np.maximum(visible, 1)
    return np.column_stack([
        word * per_word, stem * per_word, hidden * per_word, np.log1p(word), np.log1p(stem), you * per_word,
        near * per_word, close * per_word, upper / np.maximum(letters, 1), shouted * per_word,
        exclaims * per_byte, punct * per_byte, long_runs * per_word, obfuscated * per_word,
        repeated * per_byte, digits * per_byte])


def _once_a_text(hashes: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    _, first = np.unique(hashes + text.astype(np.uint64) * np.uint64(0xA24BAED4963EE407), return_index=True)
    return hashes[first], text[first]


def learn_lexicon(texts, toxic: np.ndarray, least: int = 3) -> dict:
    """Words and beginnings found in at least 3 (and 0.5 %) of the toxic texts
    and at least 20 times as often as in the others."""
    counts: dict[str, list] = {"words": [], "stems": []}
    for data, offsets, number in chunks(texts):
        words = Words(data, _lower)
        text = number[np.searchsorted(offsets, words.start, "right") - 1]
        counts["words"].append(_once_a_text(words.hash, text))
        for size in STEMS:
            place, hashes = words.beginnings(size)
            counts["stems"].append(_once_a_text(hashes, text[place]))
    n_toxic, n_clean = toxic.sum(), (~toxic).sum()
    lexicon = {}
    for name, found in counts.items():
        lexicon[name] = np.zeros(0, np.uint64)
        if found:
            hashes, text = _once_a_text(*map(np.concatenate, zip(*found)))
            entries, place = np.unique(hashes, return_inverse=True)
            bad = np.bincount(place, toxic[text], len(entries))
            good = np.bincount(place, minlength=len(entries)) - bad
            lift = (bad + 0.1) / (n_toxic + 1) * (n_clean + 1) / (good + 0.1)
            lexicon[name] = np.sort(entries[(bad >= max(least, 0.005 * n_toxic)) & (lift >= 20)])
    return lexicon


# -- gradient-boosted trees ---------------------------------------------------

def fit_trees(x: np.ndarray, y: np.ndarray) -> dict:
    """Trees of DEPTH levels; every node of a level may split anywhere."""
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    # rare features are zero in most quantiles: bins among their other values too
    edges = [np.unique(np.concatenate([e, np.quantile(c[c > 0], np.linspace(0, 1, 9)[:-1]) * (1 - 1e-9)]))
             if (c > 0).any() else e for e, c in zip(edges, x.T)]
    binned = np.column_stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T)])
    rate = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(rate / (1 - rate)))
    total, trees = np.full(len(y), start), []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-total))
        gradient, weight = y - p, p * (1 - p)
        node, splits = np.zeros(len(y), np.int64), []
        for level in range(DEPTH):
            nodes = 1 << level
            best = [(1e-9, 0, len(edges[0]) + 1)] * nodes          # gain, feature, bin: all go left
            for f, e in enumerate(edges):
                width = len(e) + 1
                g = np.bincount(node * width + binned[:, f], gradient, nodes * width).reshape(nodes, width).cumsum(1)
                h = np.bincount(node * width + binned[:, f], weight, nodes * width).reshape(nodes, width).cumsum(1)
                gl, hl, gr, hr = g, h, g[:, -1:] - g, h[:, -1:] - h
                gain = gl ** 2 / (hl + 1) + gr ** 2 / (hr + 1) - g[:, -1:] ** 2 / (h[:, -1:] + 1)
                gain[(hl < 0.5) | (hr < 0.5)] = 0
                for n, b in enumerate(gain.argmax(1)):
                    if gain[n, b] > best[n][0]:
                        best[n] = (gain[n, b], f, int(b))
            feature, cut_at = np.array([b[1] for b in best]), np.array([b[2] for b in best])
            limit = [edges[f][b] if b < len(edges[f]) else np.inf for f, b in zip(feature, cut_at)]
            splits.append((feature, np.array(limit)))
            node = 2 * node + (binned[np.arange(len(y)), feature[node]] > cut_at[node])
        g = np.bincount(node, gradient, 1 << DEPTH)
        leaf = RATE * g / (np.bincount(node, weight, 1 << DEPTH) + 1)
        total += leaf[node]
        trees.append((splits, leaf))
    return {"start": start, "trees": trees}


def tree_sum(model: dict, x: np.ndarray) -> np.ndarray:
    total, rows = np.full(len(x), model["start"]), np.arange(len(x))
    for splits, leaf in model["trees"]:
        node = np.zeros(len(x), np.int64)
        for feature, limit in splits:
            node = 2 * node + (x[rows, feature[node]] > limit[node])
        total += leaf[node]
    return total


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The non-decreasing step function nearest to y (pool adjacent violators)."""
    values, place = np.unique(x, return_inverse=True)
    blocks = []
    for v, s, n in zip(values, np.bincount(place, y), np.bincount(place)):
        blocks.append([v, v, s, n])
        while len(blocks) > 1 and blocks[-2][2] / blocks[-2][3] >= blocks[-1][2] / blocks[-1][3]:
            high = blocks.pop()
            blocks[-1] = [blocks[-1][0], high[1], blocks[-1][2] + high[2], blocks[-1][3] + high[3]]
    ends = np.array([[lo, hi, s / n] for lo, hi, s, n in blocks])
    return ends[:, :2].ravel(), np.repeat(ends[:, 2], 2)


def varied(texts: list[str], labels: np.ndarray) -> np.ndarray:
    """Places of the texts that are no near copy of an earlier one: near copies
    would make each other's rare words look telling.  Texts whose three smallest
    word hashes agree are compared; a near copy has the same label and at least
    ``NEAR`` of the words of both in common."""
    sketch = np.full((len(texts), 3), ~np.uint64(0))
    for hashes, text in _distinct_words(texts):
        for t, h in zip(*_least(hashes, text, 3)):
            sketch[t] = np.sort(np.concatenate([sketch[t], h]))[:3]
    _, place, size = np.unique(np.column_stack([sketch, labels.astype(np.uint64)]), axis=0, return_inverse=True,
                               return_counts=True)
    place = place.ravel()
    keep = size[place] == 1
    alike = np.argsort(place, kind="stable")
    for group in np.split(alike, np.cumsum(size)[:-1]):
        kept: list[np.ndarray] = []
        for n in group if len(group) > 1 else ():
            found = [h for h, _ in _distinct_words([texts[n]])]
            words = np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint64)
            if not any(_near(words, other) for other in kept):
                kept.append(words)
                keep[n] = True
    return np.flatnonzero(keep)


def _near(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether the Jaccard similarity of two sets is at least NEAR."""
    few, many = sorted((len(a), len(b)))
    if few < NEAR * many:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= NEAR * (few + many - both)


def _distinct_words(texts):
    """Per chunk (word hashes, text numbers), each word of a text once, by text and hash."""
    for data, offsets, number in chunks(texts):
        words = Words(data, _lower)
        hashes, text = _once_a_text(words.hash, number[np.searchsorted(offsets, words.start, "right") - 1])
        order = np.lexsort([hashes, text])
        yield hashes[order], text[order]


def _least(hashes, text, n):
    starts = np.flatnonzero(np.diff(text, prepend=-1))
    return text[starts], [hashes[s:s + n] if s + n <= e else hashes[s:e]
                          for s, e in zip(starts, [*starts[1:], len(text)])]


def fit(texts: list[str], labels: np.ndarray) -> dict:
    if len(set((np.asarray(labels) == 1).tolist())) < 2:
        return {"constant": 0.0}                            # one class alone tells nothing
    keep = varied(texts, labels)
    texts, labels = [texts[i] for i in keep], labels[keep]
    toxic = labels == 1
    if min(toxic.sum(), (~toxic).sum()) < LEAST:
        return _fit_few(texts, toxic)
    x = np.zeros((len(texts), len(FEATURES)))
    for part in (np.arange(len(texts)) % FOLDS == n for n in range(FOLDS)):
        lexicon = learn_lexicon([texts[i] for i in np.flatnonzero(~part)], toxic[~part])
        x[part] = features([texts[i] for i in np.flatnonzero(part)], lexicon)
    fresh = np.arange(len(texts)) // FOLDS % 4 == 3         # a quarter of every fold
    if not toxic[fresh].any() or not toxic[~fresh].any():
        fresh = np.ones(len(texts), bool)
        trees = fit_trees(x, toxic * 1.0)
    else:
        trees = fit_trees(x[~fresh], toxic[~fresh] * 1.0)
    return {"lexicon": learn_lexicon(texts, toxic), "trees": trees,
            "steps": isotonic(tree_sum(trees, x[fresh]), toxic[fresh] * 1.0)}


def _fit_few(texts: list[str], toxic: np.ndarray) -> dict:
    """A model from very few texts of a class: too few for folds or a calibration part
    of their own, so all texts serve for lexicon, trees and calibration; the rarer
    class is weighted up by repetition."""
    lexicon = learn_lexicon(texts, toxic, 1)
    x = features(texts, lexicon)
    sizes = np.where(toxic, toxic.sum(), (~toxic).sum())
    again = np.repeat(np.arange(len(texts)), -(-max(8, int(sizes.max())) // sizes))
    trees = fit_trees(x[again], toxic[again] * 1.0)
    total = tree_sum(trees, x)
    if np.ptp(total) == 0:                                  # no feature tells the classes apart
        return {"constant": 0.0}
    return {"lexicon": lexicon, "trees": trees, "steps": isotonic(total, toxic * 1.0)}


def predict(model: dict, texts: list[str]) -> np.ndarray:
    if "constant" in model:
        return np.full(len(texts), model["constant"])
    return np.interp(tree_sum(model["trees"], features(texts, model["lexicon"])), *model["steps"])


# -- Spark --------------------------------------------------------------------

def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, size: int, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(doc_id, text, label) of at most ``size`` training documents: those with
    the smallest hash of doc_id outside the held-out fold (crc32 mod 5 = 0)."""
    marked = (labels.select(named("doc_id").cast("long").alias("doc_id"), named(label).cast("int").alias("label"))
                    .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull()
                           & ~held_out(F.col("doc_id"), 5, 0))
                    # only labels of documents that are there take places in the sample
                    .join(docs.select(named(id_col).cast("long").alias("doc_id")), "doc_id", "left_semi")
                    .groupBy("doc_id").agg(F.max("label").alias("label"))
                    .orderBy(F.xxhash64("doc_id"), "doc_id").limit(size))
    # at most ``size`` rows of two numbers
    return (id_and_text(docs, id_col, text_col).join(F.broadcast(marked), "doc_id")
            .orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text")).limit(size))


def fitted(sample: DataFrame, train) -> bytes:
    """``train(texts, labels)`` run in one task on the bounded sample."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "text"])
        return pd.DataFrame({"model": [pickle.dumps(train(rows["text"].tolist(), rows["label"].to_numpy()))]})

    found = sample.groupBy(F.lit(0).alias("all")).applyInPandas(run, "model binary").first()
    return bytes(found[0]) if found else pickle.dumps(train([], np.zeros(0, int)))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> dict:
    return pickle.loads(fitted(labelled_sample(docs, labels, "toxic", SAMPLE, id_col, text_col), fit))


def scored(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    model = docs.sparkSession.sparkContext.broadcast(model)     # bounded by SAMPLE-independent sizes

    def run(batches):
        for batch in batches:
            score = predict(model.value, batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], names=["doc_id", "score"])

    return (id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double")
            .select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted")))


def accepted(docs: DataFrame, model: dict, limit: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below ``limit``, all columns kept."""
    model, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(predict(model.value, texts) < limit))

    return docs.mapInArrow(run, docs.schema)
