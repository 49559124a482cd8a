"""Quality scores from supervised subword embeddings.

A document is the average of the learnt vectors of its features: its words, the
character 3- to 4-grams inside them (first and last character marked by the
word's border), pairs of equal neighbouring words (as the shared features "again"
and "again after one"), hashed into ``BUCKETS`` vectors of ``WIDTH`` numbers, and
one constant feature.  A linear layer and a softmax turn the average into the two
labels' probabilities.  Vectors and layer are trained together by numpy
stochastic gradient descent, one document a step.

Training takes at most ``SAMPLE`` labelled documents (those with the smallest
hash of doc_id outside the held-out fold), in one task.  The trained model has a
fixed size (BUCKETS x WIDTH floats, 4 MB).  Scoring is one pass over all rows
without a shuffle; as the layer is linear, a feature's part in the score is one
number, looked up per feature.

Defined results.  A word of more than 2 MB counts as several (``textbytes.chunks``).
NULL text is empty; an empty text has only the constant
feature, so its score is what that feature alone predicts.  Labels: repeated
doc_ids count with their highest label, NULL labels and labels without a document
are ignored.  Without any labelled training text the score is 0.5.  A NULL doc_id
is scored and never trains.  Extra columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultmart.llm.common import held_out, id_and_text
from vaultmart.llm.textbytes import SpanHash, chunks, runs
from vaultmart.llm.toxicity import fitted, labelled_sample

SAMPLE = 4_000           # most labelled documents that are learnt from
BUCKETS, WIDTH = 1 << 16, 16
GRAMS = (3, 4)
EPOCHS, RATE = 4, 0.3
CONSTANT, AGAIN = 0, (1, 2)      # buckets of features that are not hashed
FIRST = 3                        # the first hashed bucket

_space = np.zeros(256, bool)
_space[[9, 10, 11, 12, 13, 32]] = True


def buckets(data: np.ndarray, offsets: np.ndarray):
    """(place in ``data``, bucket) of every feature, as a few pairs of arrays;
    texts begin at ``offsets``."""
    gap = _space[data]
    start, end = runs(~gap)
    hashes = SpanHash(data)(start, end)
    yield start, FIRST + (hashes % np.uint64(BUCKETS - FIRST)).astype(np.int64)
    text = np.searchsorted(offsets, start, "right")
    for back, bucket in enumerate(AGAIN, 1):
        same = (hashes[back:] == hashes[:-back]) & (text[back:] == text[:-back])
        yield start[back:][same], np.full(same.sum(), bucket)
    # a border before the first text; every text ends with one
    wide = np.concatenate([[32], np.where(gap, 32, data)]).astype(np.uint32)
    shut = np.concatenate([[True], gap])
    for n in GRAMS:
        if len(wide) < n:
            continue
        code = np.full(len(wide) - n + 1, 0x811C9DC5 + n, np.uint32)
        for k in range(n):
            code = (code ^ wide[k:len(wide) - n + 1 + k]) * np.uint32(0x01000193)
            code ^= code >> np.uint32(15)
        inside = np.ones(len(code), bool)
        for k in range(1, n - 1):            # a gap may only stand at either end
            inside &= ~shut[k:len(code) + k]
        # the place in ``data`` of the second character: the first may be the border that
        # ends the text before
        place = np.flatnonzero(inside)
        yield place, FIRST + (code[place] % np.uint32(BUCKETS - FIRST)).astype(np.int64)


def counted(texts: list[str]):
    """Per text the distinct buckets and their counts."""
    held: list[list] = [[] for _ in texts]
    for data, offsets, number in chunks(texts):
        for place, bucket in buckets(data, offsets):
            text = np.searchsorted(offsets, place, "right") - 1
            for t, part in zip(number, np.split(bucket, np.searchsorted(text, np.arange(1, len(offsets))))):
                held[t].append(part)
    for parts in held:
        yield np.unique(np.concatenate([*parts, [CONSTANT]]).astype(np.int64), return_counts=True)


def fit(texts: list[str], labels: np.ndarray) -> dict:
    rng = np.random.default_rng(7)
    vectors = rng.uniform(-1 / WIDTH, 1 / WIDTH, (BUCKETS, WIDTH)).astype(np.float32)
    layer = np.zeros((WIDTH, 2), np.float32)
    seen = list(counted(texts))
    steps, step = max(1, EPOCHS * len(seen)), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(seen)):
            rate, step = RATE * (1 - step / steps), step + 1
            ids, counts = seen[i]
            share = (counts / counts.sum()).astype(np.float32)
            hidden = share @ vectors[ids]
            z = hidden @ layer
            p = np.exp(z - z.max())
            p /= p.sum()
            p[int(labels[i] == 1)] -= 1          # the loss's slope in z
            back = layer @ p
            layer -= rate * np.outer(hidden, p)
            # the average is over many features: their steps are scaled back up
            vectors[ids] -= rate * np.sqrt(len(ids)) * share[:, None] * back
    return {"vectors": vectors, "layer": layer}


def predict(slopes: np.ndarray, texts: list[str]) -> np.ndarray:
    """``slopes``: each bucket's part in (logit of 1 - logit of 0)."""
    total, count = np.full(len(texts), float(slopes[CONSTANT])), np.ones(len(texts))
    for data, offsets, number in chunks(texts):
        for place, bucket in buckets(data, offsets):
            cuts = np.searchsorted(place, offsets)
            sums = np.concatenate([[0.0], np.cumsum(slopes[bucket], dtype=np.float64)])
            ends = np.append(cuts[1:], len(place))
            np.add.at(total, number, sums[ends] - sums[cuts])
            np.add.at(count, number, ends - cuts)
    return 1 / (1 + np.exp(-total / count))


def slopes(model: dict) -> np.ndarray:
    return (model["vectors"] @ (model["layer"][:, 1] - model["layer"][:, 0])).astype(np.float32)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> dict:
    return pickle.loads(fitted(labelled_sample(docs, labels, "quality", SAMPLE, id_col, text_col), fit))


def scored(docs: DataFrame, model: dict, limit: float = 0.3, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    known = docs.sparkSession.sparkContext.broadcast(slopes(model))      # BUCKETS floats

    def run(batches):
        for batch in batches:
            score = predict(known.value, batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], names=["doc_id", "score"])

    return (id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double")
            .select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score",
                    (F.col("score") >= limit).cast("int").alias("predicted")))
