"""Near-duplicate classes by SimHash and a Gray-order hierarchical index.

Fingerprints: text with A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``, shingles
of ``width`` words (repeats included, joined by a space; fewer words: the whole
sequence; none: fingerprint zero, linked like any other), XXH64 with seed 42
of each shingle; a bit is 1 if set in over half of the hashes.  Fingerprints
link at ``max_bits`` or fewer differing bits, and the classes are the connected
components of those links.

How the links are found without comparing all pairs:

* equal fingerprints are one *code*, so copies cost one row;
* if two codes differ in at most ``k`` bits, then of ``k + 1`` blocks of bits at
  least one is equal in both, so each code is sent to the groups of its k + 1
  block values (the block rotated to the front);
* a group of more than ``GROUP_LIMIT`` codes is split again in the same way over
  its remaining bits, which is exact for the same reason, until every group fits
  (a group with 12 free bits cannot hold more than 4,096 codes);
* inside a group, the codes sorted by Gray rank form the leaves of a tree.  Each
  node holds the bits all its codes share (mask and pattern).  The self-join
  walks pairs of nodes downwards, adds up the differences in the newly shared
  bits, and drops a pair with all its codes once the sum exceeds ``max_bits``;
* a task hands on only (code, smallest code it reaches in this group), not pairs.

Components are then merged over the whole table by rounds of large-star and
small-star steps, each round a written table.  Rows get their class by their
code; codes with at least a HOT_CODES-th of all rows (so at most HOT_CODES) are
broadcast, so that a big group of copies never meets in one task.

Defined results.  NULL text counts as empty.  Rows with equal doc_id are
separate rows with their own fingerprint.  NULL doc_ids get a class like any
other row; component_id is the smallest non-NULL doc_id of the class (NULL if it
has none).  An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from functools import partial
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultmart.functions.lineage import cut
from vaultmart.llm.common import id_and_text, named, unpacked, whole_row

HOT_CODES = 1_000        # most codes that are broadcast to their rows
GROUP_LIMIT = 16_384     # most codes one task joins at once
LEAF, FAN = 16, 8        # codes in a leaf, children of a node
FRONTIER = 1 << 18       # most node pairs expanded at once
BLOCK = 1 << 16          # shingles counted at once

_hash = partial(xxhash.xxh64_intdigest, seed=42)


# -- fingerprints -------------------------------------------------------------

def fingerprint(text: str, width: int = 3) -> int:
    words = text.encode("utf-8").lower().split()
    if not words:
        return 0
    if len(words) < width:
        shingles = iter([b" ".join(words)])
    else:
        shingles = map(b" ".join, zip(*(islice(words, i, None) for i in range(width))))
    hashes, ones, total = map(_hash, shingles), np.zeros(64, np.int64), 0
    while True:
        block = np.fromiter(islice(hashes, BLOCK), np.uint64)
        if not len(block):
            break
        bits = np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        total += len(block)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.uint64)[0])


def _printed(width: int):
    """The last column, text, becomes code; the others pass through."""

    def run(batches):
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            codes = np.array([fingerprint(t, width) for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(codes.view(np.int64))],
                                             names=[*batch.schema.names[:-1], "code"])

    return run


def fingerprints(docs: DataFrame, width: int = 3, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, code): the fingerprint as a signed long."""

    return id_and_text(docs, id_col, text_col).mapInArrow(_printed(width), "doc_id long, code long")


# -- the index ----------------------------------------------------------------

def gray_rank(code: np.ndarray) -> np.ndarray:
    """Position of each 64-bit code in the reflected Gray sequence."""
    rank = code.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """A hierarchy over codes in Gray order; every node has the mask and the
    pattern of the bits that all codes below it share."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes[np.argsort(gray_rank(codes), kind="stable")]
        all_and = all_or = self.codes
        self.levels, step = [], LEAF
        while True:
            starts = np.arange(0, len(all_and), step)
            all_and = np.bitwise_and.reduceat(all_and, starts)
            all_or = np.bitwise_or.reduceat(all_or, starts)
            mask = ~(all_and ^ all_or)
            self.levels.append((all_and & mask, mask))
            step = FAN
            if len(starts) == 1:
                break

    def pairs(self, max_bits: int):
        """Arrays (i, j), i < j, of positions in ``codes`` that differ in at
        most ``max_bits`` bits; each such pair once."""
        zero = np.zeros(1, np.int64)
        yield from self._down(len(self.levels) - 1, zero, zero, zero, max_bits)

    def _down(self, level: int, a, b, seen, max_bits: int):
        """``seen``: the differences in bits shared by the nodes' parents."""
        for at in range(0, len(a), FRONTIER // FAN ** 2):
            part = slice(at, at + FRONTIER // FAN ** 2)
            x, y, acc = a[part], b[part], seen[part]
            if level == 0:
                yield from self._leaves(x, y, max_bits)
                continue
            pattern, mask = self.levels[level]
            known = np.repeat(mask[x] & mask[y], FAN * FAN)
            below, below_mask = self.levels[level - 1]
            i = np.repeat(x * FAN, FAN * FAN) + np.tile(np.repeat(np.arange(FAN), FAN), len(x))
            j = np.repeat(y * FAN, FAN * FAN) + np.tile(np.arange(FAN), FAN * len(y))
            ok = (j < len(below)) & (i <= j)
            i, j, known, acc = i[ok], j[ok], known[ok], np.repeat(acc, FAN * FAN)[ok]
            fresh = below_mask[i] & below_mask[j] & ~known
            acc = acc + np.bitwise_count((below[i] ^ below[j]) & fresh)
            near = acc <= max_bits
            yield from self._down(level - 1, i[near], j[near], acc[near], max_bits)

    def _leaves(self, a, b, max_bits: int):
        i = np.repeat(a * LEAF, LEAF * LEAF) + np.tile(np.repeat(np.arange(LEAF), LEAF), len(a))
        j = np.repeat(b * LEAF, LEAF * LEAF) + np.tile(np.arange(LEAF), LEAF * len(b))
        ok = (j < len(self.codes)) & (i < j)
        i, j = i[ok], j[ok]
        near = np.bitwise_count(self.codes[i] ^ self.codes[j]) <= max_bits
        yield i[near], j[near]


def merged(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Join the classes of i[n] and j[n]; ``parent`` stays flat (a class's
    smallest member is the parent of all)."""
    while len(i):
        x, y = parent[i], parent[j]
        apart = x != y
        i, j, x, y = i[apart], j[apart], x[apart], y[apart]
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(up := parent[parent], parent):
            parent = up
    return parent


def local_roots(codes: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(code, a code it is linked to, directly or not) for all linked codes of
    one group but the first of each class."""
    index = GrayIndex(codes)
    parent = np.arange(len(codes))
    for i, j in index.pairs(max_bits):
        parent = merged(parent, i, j)
    linked = parent != np.arange(len(codes))
    return index.codes[linked], index.codes[parent[linked]]


def _rotated(code: Column, low: int, by: int) -> Column:
    """``code`` with its lowest ``low`` bits rotated left by ``by``."""
    if by == 0:
        return code
    mask = (1 << low) - 1
    part = code.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("long"))
    turned = F.shiftleft(part, by).bitwiseOR(F.shiftrightunsigned(part, low - by))
    if low == 64:
        return turned
    return code.bitwiseAND(F.lit(~mask).cast("long")).bitwiseOR(
        turned.bitwiseAND(F.lit(mask).cast("long")))


def _split(rows: DataFrame, free: int, blocks: int) -> tuple[DataFrame, int]:
    """Send each row to the ``blocks`` groups of its blocks among the ``free``
    low bits of ``turned``; returns the rows and the bits then left free."""
    sizes = [free // blocks + (n < free % blocks) for n in range(blocks)]
    least = min(sizes)
    turns = [F.struct(F.lit(n).alias("n"), _rotated(F.col("turned"), free, sum(sizes[:n])).alias("to"))
             for n in range(blocks)]
    rows = rows.withColumn("turn", F.explode(F.array(*turns)))
    return rows.select("code", F.concat("path", F.col("turn.n").cast("string")).alias("path"),
                       F.col("turn.to").alias("turned"),
                       F.shiftrightunsigned("turn.to", free - least).alias("prefix")), free - least


def links(codes: DataFrame, max_bits: int = 2) -> DataFrame:
    """(a, b): for each group's linked codes, a code and the group's code it
    leads to.  Together these connect exactly what the links connect."""
    rows = codes.select("code", F.lit("").alias("path"), F.col("code").alias("turned"))
    rows, free = _split(rows, 64, max_bits + 1)
    found = []
    while True:
        big = None
        if 1 << free > GROUP_LIMIT:
            sizes = rows.groupBy("path", "prefix").count().where(F.col("count") > GROUP_LIMIT)
            big = cut(sizes.select("path", "prefix"), "simhash-big")
            if big.isEmpty():
                big = None
        small = rows if big is None else rows.join(big, ["path", "prefix"], "left_anti")
        found.append(_searched(small, max_bits))
        if big is None:
            break
        rows, free = _split(rows.join(big, ["path", "prefix"], "left_semi"), free, max_bits + 1)
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def _searched(rows: DataFrame, max_bits: int) -> DataFrame:
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        key, kept = None, []

        def done():
            codes = np.concatenate(kept)
            if len(codes) > 1:
                a, b = local_roots(codes, max_bits)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))],
                                                     schema=schema)

        for batch in batches:
            path = np.asarray(batch.column("path").to_pylist(), dtype=object)
            prefix = batch.column("prefix").to_numpy()
            codes = batch.column("code").to_numpy().view(np.uint64)
            if not len(codes):
                continue
            ends = np.flatnonzero((prefix[1:] != prefix[:-1]) | (path[1:] != path[:-1])) + 1
            for s, e in zip([0, *ends], [*ends, len(codes)]):
                if (path[s], prefix[s]) != key:
                    if kept:
                        yield from done()
                    key, kept = (path[s], prefix[s]), []
                kept.append(codes[s:e])
        if kept:
            yield from done()

    grouped = rows.repartition("path", "prefix").sortWithinPartitions("path", "prefix")
    return grouped.select("path", "prefix", "code").mapInArrow(run, "a long, b long")


# -- components ---------------------------------------------------------------

def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: link each node's larger neighbours to its smallest
    neighbour; small star: its smaller neighbours and itself."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    side = both.where(F.col("b") > F.col("a")) if large else both.where(F.col("b") < F.col("a"))
    out = side.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    if not large:
        out = out.union(least.select("a", F.col("m").alias("b")))
    return out.where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(code, root) of every code in ``edges``, the roots included."""
    edges = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                     .where(F.col("a") != F.col("b")).distinct(), "simhash-edges")
    state = _state(edges)
    while state[0]:
        edges = cut(_star(cut(_star(edges, True), "simhash-large"), False), "simhash-small")
        before, state = state, _state(edges)
        if before == state:
            break
    pairs = edges.select(F.col("a").alias("code"), F.col("b").alias("root"))
    return pairs.union(pairs.select(F.col("root").alias("code"), "root").distinct())


def classes(prints: DataFrame, max_bits: int = 2) -> DataFrame:
    """Adds to rows with (doc_id, code): root (one code of the row's class, the
    same for all of it) and component_id."""
    codes = cut(prints.groupBy("code").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")),
                "simhash-codes")
    rows = codes.agg(F.sum("n")).first()[0] or 0
    roots = components(links(codes, max_bits))
    linked = codes.join(roots, "code")
    smallest = linked.groupBy("root").agg(F.min("least").alias("linked_least"))
    named_codes = cut(
        codes.join(linked.join(smallest, "root").select("code", "root", "linked_least"), "code", "left").select(
            "code", "n", F.coalesce("root", "code").alias("root"),
            F.when(F.col("root").isNull(), F.col("least")).otherwise(F.col("linked_least")).alias("component_id")),
        "simhash-classes")
    is_hot = F.col("n") * HOT_CODES >= rows
    hot = F.broadcast(named_codes.where(is_hot).drop("n"))         # at most HOT_CODES codes
    return prints.join(hot, "code").unionByName(
        prints.join(hot.select("code"), "code", "left_anti")
              .join(named_codes.where(~is_hot).drop("n"), "code"))


def near_duplicates(docs: DataFrame, width: int = 3, max_bits: int = 2, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id."""
    prints = cut(fingerprints(docs, width, id_col, text_col), "simhash-prints")
    return classes(prints, max_bits).select(
        "doc_id", F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), "component_id")


def representatives(docs: DataFrame, width: int = 3, max_bits: int = 2, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One whole row of ``docs`` per class: the one with the smallest doc_id (a
    NULL id loses to any other; among rows of one id, the first stored).  The rows
    are written once with a number, and only numbers are grouped and joined."""
    rows = docs.select(whole_row(docs).alias("row"), named(id_col).cast("long").alias("doc_id"),
                       F.coalesce(named(text_col).cast("string"), F.lit("")).alias("text"))
    printed = rows.mapInArrow(_printed(width), rows.drop("text").schema.add("code", "long"))
    stored = cut(printed.withColumn("number", F.monotonically_increasing_id()), "simhash-rows")
    found = classes(stored.select("number", "doc_id", "code"), max_bits)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "number")).alias("first")
    kept = found.groupBy("root").agg(first).select(F.col("first.number").alias("number"))
    return unpacked(stored.join(kept, "number", "left_semi"), docs.columns)
