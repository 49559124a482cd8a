"""Importance resampling towards a target distribution.

Texts become bags of hashed features (runs of 1 to ``WIDTH`` words).  A feature's gain
is the logarithm of its smoothed frequency in the target over that in the documents; a
document's weight is the sum of its features' gains, its score the weight plus Gumbel
noise from a hash of its id, and the highest scores are drawn.  Drawing the k highest
noisy scores is sampling k documents without replacement by their weights.

1. Counting: a task adds its texts' features to one array of ``BUCKETS`` numbers; only
   those arrays' non-zero entries are shuffled.
2. Scoring: the gains (one array of ``BUCKETS`` longs, its size fixed by the parameter)
   are broadcast; a document's weight is a sum of array entries.  Rows are written once.
3. Ranking: a distributed LSD radix sort of the composite key (score falling, doc_id
   rising).  The key is a row of digits of ``DIGIT`` bits.  One pass, from the lowest digit to
   the highest: rows lie in blocks of 2 ** ``BLOCK`` positions; each block counts its digits;
   the counts, ordered by (digit, block), have running sums, which say where the block's
   first row of a digit goes; its later ones follow in their old order (a stable
   counting sort).  Rows move once a pass, by block, so that whatever the keys are,
   no task holds more than its blocks.  After the last pass a row's position is its rank.
   The passes carry five numbers a document and no text.

Defined results.  NULL text has no features (weight 0).  The noise of a NULL doc_id is
that of the empty id; it ranks last among ties.  Documents with fewer than
``LEAST_WORDS`` words are scored, never drawn.  Rows with the same score and id (a row that
is repeated) take consecutive ranks.  An empty target, or an empty table, has no
features: smoothing still defines every gain.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultmart.functions.lineage import ScratchTable
from vaultmart.llm.common import named, pieces

BUCKETS = 10_000
WIDTH = 1                # longest run of words that is a feature
SEED = 2024
LEAST_WORDS = 20
PER_CENT = 10            # of the documents with LEAST_WORDS words
DIGIT = 10               # bits
BLOCK = 12               # bits of a position inside a block
PIECE = 1 << 20          # bytes of a text worked on at once
REMEMBERED = 1 << 18     # features whose bucket a task remembers

# 0-9, a-z and every byte of a longer code point stay; A-Z become a-z; the rest separates
_WORD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 32
              for b in range(256))


class Buckets(dict):
    """feature -> bucket, remembered up to a bound."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        bucket = self[feature] = zlib.crc32(feature) % self.buckets
        return bucket


def word_count(text: bytes) -> int:
    return sum(len(piece.split()) for piece in pieces(text.translate(_WORD), PIECE))


def feature_buckets(text: bytes, width: int, known: Buckets):
    """The buckets of a text's features, as arrays."""
    tail: list[bytes] = []                   # words that still begin runs into the next piece
    for piece in pieces(text.translate(_WORD), PIECE):
        words = tail + piece.split()
        for n in range(1, width + 1):
            # runs that end inside the tail were counted with the last piece
            runs = words if n == 1 else [b" ".join(words[i:i + n]) for i in range(len(words) - n + 1)]
            skip = max(0, len(tail) - n + 1)
            yield np.fromiter(map(known.__getitem__, runs[skip:]), np.int64, len(runs[skip:]))
        tail = words[len(words) - width + 1:] if width > 1 else []


def _source(docs: DataFrame, text_col: str, *more: Column) -> DataFrame:
    return docs.select(*more, F.coalesce(named(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))


def bucket_counts(docs: DataFrame, text_col: str = "text", buckets: int = BUCKETS, width: int = WIDTH) -> DataFrame:
    """(bucket, n) of all texts, for buckets that hold a feature."""

    def run(batches):
        known, total = Buckets(buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column("text").to_pylist():
                for found in feature_buckets(text, width, known):
                    np.add.at(total, found, 1)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["bucket", "n"])

    return _source(docs, text_col).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def counts_array(counted: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """``bucket_counts`` as one array on the driver: at most ``buckets`` rows."""
    out = np.zeros(buckets, np.int64)
    for row in counted.collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the smoothed frequency in the target over that in the documents)."""
    buckets, S, T = len(documents), int(documents.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log(float(t + 1) * float(S + buckets) / (float(s + 1) * float(T + buckets))))
                     for s, t in zip(documents.tolist(), target.tolist())], np.int64)


def noise(doc_id: int | None, seed: int = SEED) -> int:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return math.floor(-1000 * math.log(-math.log((int(digest[:8], 16) + 0.5) / 4294967296)))


def weighed(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
            seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score of every row."""
    held = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches):
        array = held.value
        known = Buckets(len(array))
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                features = weight = 0
                for found in feature_buckets(text, width, known):
                    features += len(found)
                    weight += int(array[found].sum())
                words = features if width == 1 else word_count(text)
                rows.append((words, features, weight, weight + noise(doc_id, seed)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [()] * 4)]],
                names=["doc_id", "n_words", "n_features", "weight", "score"])

    return _source(docs, text_col, named(id_col).cast("long").alias("doc_id")).mapInArrow(
        run, "doc_id long, n_words long, n_features long, weight long, score long")


# ---------------------------------------------------------------- radix sort

def _digits(value: Column, low: int, high: int, falling: bool, bits: int) -> list[Column]:
    """The digits of value - low (or high - value), lowest first.  The difference is
    taken as unsigned: a range of the whole 64 bits wraps round rightly."""
    if low == high:
        return []
    width = (high - low).bit_length()

    def half(v, shift):          # by halves of 32 bits, as ANSI mode fails on a long's overflow
        return F.shiftrightunsigned(v, shift).bitwiseAND(F.lit(0xFFFFFFFF))

    a, b = (F.lit(high).cast("long"), value) if falling else (value, F.lit(low).cast("long"))
    small = half(a, 0) - half(b, 0)
    big = half(a, 32) - half(b, 32) + F.shiftright(small, 32)          # -1: a borrow
    difference = F.shiftleft(big, 32).bitwiseOR(small.bitwiseAND(F.lit(0xFFFFFFFF)))
    return [F.shiftrightunsigned(difference, at).bitwiseAND(F.lit((1 << bits) - 1)) for at in range(0, width, bits)]


def radix_pass(placed: DataFrame, digit: Column) -> DataFrame:
    """One stable counting-sort pass over rows of (block, pos, ...): the same rows,
    with the positions 0, 1, ... of their new order as ``pos``."""
    rows = placed.withColumn("_digit", digit)
    counted = rows.groupBy("block", "_digit").agg(F.count(F.lit(1)).alias("_n"))
    totals = counted.groupBy("_digit").agg(F.sum("_n").alias("_all"))                 # 2 ** DIGIT rows at most
    lower = Window.orderBy("_digit").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("_digit", F.coalesce(F.sum("_all").over(lower), F.lit(0)).alias("_lower"))
    before = Window.partitionBy("_digit").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    start = (counted.withColumn("_inside", F.coalesce(F.sum("_n").over(before), F.lit(0)))
             .join(F.broadcast(totals), "_digit")
             .select("block", "_digit", (F.col("_inside") + F.col("_lower")).alias("_start"),
                     F.lit(-1).cast("long").alias("pos")))
    # a block's rows and its starts meet in the one exchange of the rows; a start stands
    # before the rows of its digit
    met = rows.unionByName(start, allowMissingColumns=True).repartition("block")
    group = Window.partitionBy("block", "_digit").orderBy("pos")
    moved = met.withColumn("_first", F.first("_start").over(group)).withColumn("_nth", F.row_number().over(group))
    return (moved.where(F.col("pos") >= 0).withColumn("pos", F.col("_first") + F.col("_nth") - 2)
            .select(*placed.columns))


def radix_sorted(rows: ScratchTable, keys: list[tuple[str, bool]], digit: int = DIGIT,
                 block: int = BLOCK) -> DataFrame:
    """The rows of ``rows`` (columns block, pos and more; any distinct positions) with their
    place in the order of ``keys`` (column, falling; the most significant first) as
    ``pos``.  Keys are longs without NULLs.  ``rows`` is dropped."""
    ranges = rows.read().agg(*[f(k).alias(f"{n}_{k}") for k, _ in keys for n, f in (("lo", F.min), ("hi", F.max))]).first()
    passes = [d for k, falling in reversed(keys) if ranges[f"lo_{k}"] is not None
              for d in _digits(F.col(k), ranges[f"lo_{k}"], ranges[f"hi_{k}"], falling, digit)]
    if not passes:                # all keys equal: any order is theirs, but it must be dense
        passes = [F.lit(0).cast("long")]
    for d in passes:
        after = ScratchTable.of(radix_pass(rows.read(), d).withColumn("block", F.shiftright("pos", block)), "radix")
        rows.drop()
        rows = after
    return rows.read()


# ---------------------------------------------------------------- the operator

def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             target_text_col: str = "text", per_cent: int = PER_CENT, least_words: int = LEAST_WORDS,
             buckets: int = BUCKETS, width: int = WIDTH, seed: int = SEED, digit: int = DIGIT,
             block: int = BLOCK) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every row; rank 1, 2, ... of the drawn
    floor(``per_cent`` N / 100) of the N documents with ``least_words`` words, else NULL."""
    gain = gains(counts_array(bucket_counts(docs, text_col, buckets, width), buckets),
                 counts_array(bucket_counts(target, target_text_col, buckets, width), buckets))
    # written once: a row's first position is fixed before anything depends on it
    pos = F.monotonically_increasing_id()
    scored = ScratchTable.of(weighed(docs, gain, id_col, text_col, width, seed).select("*", pos.alias("pos")), "weighed")
    columns = ["doc_id", "n_features", "weight", "score"]
    enough = F.col("n_words") >= least_words
    n = scored.read().where(enough).count()
    drawn = n * per_cent // 100
    can = scored.read().where(enough).select(
        *columns, F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("_id"),
        F.shiftright("pos", block).alias("block"), "pos")
    ordered = radix_sorted(ScratchTable.of(can, "radix"), [("score", True), ("_id", False)], digit, block)
    rank = F.when(F.col("pos") < drawn, F.col("pos") + 1)
    return (ordered.select(*columns, rank.alias("rank"))
            .unionByName(scored.read().where(~enough).select(*columns, F.lit(None).cast("long").alias("rank"))))
