"""Language-model scores from a weighted backoff automaton, learnt and applied
without ever holding the model in one place.

Model.  Lower-case A-Z; tokens are the words ``[^\\x20\\x09-\\x0D]+`` and one end
per text.  The unigram state gives token w the weight
``p1(w) = (c(w) + 1) / (N + V + 1)``; for a history h of 1 to order-1 tokens

    p(w | h) = (c(hw) + mass * p(w | h')) / (c(h) + mass),   h' = h without its first token

which sums to one over all tokens and the unknown one.  The registered query has
order 3.  Each level has a mass of its own, fitted on the training counts: with
each training token left out in turn, the tokens expected to fail from their
histories, sum of mass / (c(h) - 1 + mass), are as many as do fail, which are the
n-grams counted once.  As an automaton: every
history seen in training is a state; a seen continuation hw is an arc with the
weight log10 p(w | h); any other token takes the failure arc to h' with the
weight log10(mass / (c(h) + mass)) and is tried again there.  A text starts in
the state of the history <start>, and one left-to-right walk adds up weights: all
texts of a block are walked at once, one token of each a step, with an array of current
states.  Long texts are walked in stretches of ``STRETCH`` tokens, each from the state
that the order-1 tokens before it lead to, which is the state the walk would have there.

Plan.  Texts are cut into blocks of about ``BLOCK_BYTES``.

1. Each block lists its distinct n-grams (as 64-bit hashes, sorted) with their counts in
   its training texts.  A shard is a range of hashes, so that a block's part of a shard is
   a slice; it is one row, with the differences of its hashes.  Equal n-grams of a block
   are one entry, so a word that makes up a third of the corpus is one entry a block,
   and shards are even.
2. A shard adds up the counts of its n-grams over all blocks, and answers each
   block with the totals of the n-grams it listed, in the order listed.  It also
   reports how many tokens and distinct tokens it counted (N and V).
3. Each block gets its answers, which are the counts of all states and arcs its own
   texts can touch, builds that part of the automaton, and walks its texts.

There is a row per block and shard that the block has an n-gram of, so a block makes as
many rows as there are shards, and never more than it has distinct n-grams: past that
rows grow with the input only.  A block's work does not depend on the number of shards.
Both sizes are parameters, bounded by the memory of a task.

Blocks are made twice from the table rather than stored, and are named by their
content: a table that changed in between raises an error.

Nothing is cut off by count or rank, and all n-grams of all training texts are
counted.  64-bit hashes stand for n-grams: the chance that any two of a billion
distinct ones fall together is about 3 percent.

Defined results.  NULL text is empty: its only token is the end.  A text of any
length is walked in blocks: the automaton's state after a cut follows from the
last order-1 tokens, which the next block is given.  Repeated doc_ids are scored
row by row; a NULL doc_id counts as the empty id for the fold.  With no training
text at all, p1 = 1 for every token.  An empty table gives an empty result.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultmart.functions.lineage import cut, shuffles_freed
from vaultmart.llm.common import WHITE_SPACE, id_and_text

BLOCK_BYTES = 4 << 20     # text in a block
SHARD_BYTES = 12 << 20    # corpus text for which one shard is planned
STRETCH = 256             # tokens of a text that are walked in one go
MASSES = [float(2.0 ** (n / 8)) for n in range(-16, 129)]     # tried when masses are fitted
ENDS = 1 << 31            # beside a block's count of an n-gram, which is far below
START, END = b"\x01 ", b"\x02 "      # no word holds white space
# of each level, in order: the number of n-grams, their hashes, their counts
ROWS = pa.schema([("kind", pa.string()), ("shard", pa.int64()), ("block", pa.string()), ("sizes", pa.list_(pa.int64())),
                  ("keys", pa.list_(pa.binary())), ("counts", pa.list_(pa.binary()))])
ROWS_DDL = "kind string, shard long, block string, sizes array<long>, keys array<binary>, counts array<binary>"


def _packed(values: np.ndarray) -> bytes:
    """Numbers of eight bytes, compressed byte by byte: high bytes are mostly nought."""
    planes = values.view(np.uint8).reshape(-1, 8).T.tobytes()
    return pa.compress(planes, codec="zstd", asbytes=True) if planes else b""


def _unpacked(data: bytes, n: int, kind) -> np.ndarray:
    if not n:
        return np.zeros(0, kind)
    planes = np.frombuffer(pa.decompress(data, n * 8, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, n).T).view(kind).ravel()


def hold_out(doc_id, modulus: int, remainder: int) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % modulus == remainder


def _pieces(text: bytes):
    """(piece, is last): pieces of at most BLOCK_BYTES, cut at white space."""
    at = 0
    while len(text) - at > BLOCK_BYTES:
        end = at + BLOCK_BYTES
        while end < len(text) and text[end] not in WHITE_SPACE:
            end += 1
        yield text[at:end], False
        at = end
    yield text[at:], True


def _grams(ids: np.ndarray, lead: np.ndarray, order: int, hashes: np.ndarray):
    """For each level 1..order: (hash of the n-gram ending at each token,
    whether it exists).  ``lead`` counts the tokens before it in its text."""
    grams, current = [], hashes[ids]
    for level in range(1, order + 1):
        if level > 1:
            # hash of (older word, newer gram), order-sensitive, mixed
            older = np.concatenate([np.zeros(level - 1, np.uint64), hashes[ids[:len(ids) - level + 1]]])[:len(ids)]
            current = _mix(older * np.uint64(0x9E3779B97F4A7C15) + grams[-1][0])
        grams.append((current, lead >= level - 1))
    return grams


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Block:
    """Whole texts or pieces of long ones, as one run of token ids.

    ``skip`` tokens at the head of each piece (the start, or what the cut left
    behind) only serve as history."""

    def __init__(self, order: int):
        self.order, self.size = order, 0
        self.doc, self.held, self.length, self.skip, self.tokens = [], [], [], [], []

    def add(self, row: int, doc_id, held: bool, tokens: list[bytes], skip: int, size: int):
        self.doc.append((row, doc_id))
        self.held.append(held)
        self.length.append(len(tokens))
        self.skip.append(skip)
        self.tokens.extend(tokens)
        self.size += size

    def packed(self) -> tuple[str, bytes, int]:
        """(name by content, the block, its size unpacked)."""
        vocabulary: dict[bytes, int] = {}
        ids = np.fromiter((vocabulary.setdefault(t, len(vocabulary)) for t in self.tokens),
                          np.int32, len(self.tokens))
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, vocabulary), np.uint64, len(vocabulary))
        rows = np.array([row for row, _ in self.doc], np.int64)
        meta = np.array([[0 if d is None else d, d is None, h, n, s] for (_, d), h, n, s
                         in zip(self.doc, self.held, self.length, self.skip)], np.int64)
        head = np.array([len(meta), len(hashes)], np.int64)
        raw = b"".join(x.tobytes() for x in (head, meta, hashes, ids))
        name = xxhash.xxh3_128_hexdigest(raw)
        raw += rows.tobytes()
        return name, pa.compress(raw, codec="zstd", asbytes=True), len(raw)


class Walk:
    """A packed block, its n-grams, and the automaton over them."""

    def __init__(self, packed: bytes, size: int, order: int):
        raw = pa.decompress(packed, size, codec="zstd", asbytes=True)
        n, v = np.frombuffer(raw, np.int64, 2)
        self.meta = np.frombuffer(raw, np.int64, n * 5, 16).reshape(n, 5)
        at = 16 + n * 40
        hashes = np.frombuffer(raw, np.uint64, v, at)
        self.rows = np.frombuffer(raw, np.int64, n, len(raw) - n * 8)
        ids = np.frombuffer(raw[at + v * 8:len(raw) - n * 8], np.int32)
        length, skip = self.meta[:, 3], self.meta[:, 4]
        starts = np.cumsum(length) - length
        lead = np.arange(len(ids)) - np.repeat(starts, length)
        self.scored = lead >= np.repeat(skip, length)
        self.doc = np.repeat(np.arange(n), length)
        self.training = np.repeat(self.meta[:, 2] == 0, length)
        # the <start> of a text: as a history it needs a count of its own
        self.start = (lead == 0) & (np.repeat(skip, length) == 1) & (hashes[ids] == _START_HASH)
        self.end = hashes[ids] == _END_HASH
        self.grams = _grams(ids, lead, order, hashes)
        self.lists: dict[int, tuple] = {}

    def listed(self, level: int):
        """(sorted distinct n-grams of a level, place of each token's n-gram in
        it, how often each is counted in training, with the bit ENDS if it ends
        a text and so is no history)."""
        if level in self.lists:
            return self.lists[level]
        grams, exists = self.grams[level - 1]
        distinct, place = np.unique(np.where(exists, grams, np.uint64(0)), return_inverse=True)
        counted = self.training & exists & (self.scored | self.start)
        ends = np.bincount(place[self.end & exists], minlength=len(distinct)) > 0
        self.lists[level] = distinct, place, np.bincount(place[counted], minlength=len(distinct)) | np.where(ends, ENDS, 0)
        return self.lists[level]

    def automaton(self, totals: list[np.ndarray], tokens: int, distinct: int, masses: list[float]) -> "Automaton":
        """The states and arcs that this block's texts can touch.  ``totals[n]``: the
        corpus count of each of the block's distinct (n+1)-grams."""
        return Automaton([self.listed(level)[:2] for level in range(1, len(totals) + 1)], totals, tokens, distinct, masses)

    def walked(self, model: "Automaton") -> np.ndarray:
        """log10 weight of each token, read from left to right."""
        length = self.meta[:, 3]
        first = np.cumsum(length) - length
        # stretches of each text; their walk begins order-1 tokens earlier, in the text
        parts = -(-length // STRETCH)
        text = np.repeat(np.arange(len(length)), parts)
        begin = first[text] + STRETCH * (np.arange(len(text)) - np.repeat(np.cumsum(parts) - parts, parts))
        stop = np.minimum(begin + STRETCH, (first + length)[text])
        at = np.maximum(begin - (len(model.arc) - 1), first[text])
        longest = np.argsort(at - stop, kind="stable")           # so that those still walking stand in front
        at, begin, stop = at[longest], begin[longest], stop[longest]
        weight = np.zeros(int(length.sum()))
        level, state = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        while len(at):
            read, level, state = model.step(at, level, state)
            own = at >= begin
            weight[at[own]] = read[own]
            at = at + 1
            going = int(np.searchsorted(-(stop - at), 0)) if len(at) else 0          # stop - at falls along the array
            at, begin, stop, level, state = at[:going], begin[:going], stop[:going], level[:going], state[:going]
        return weight


class Automaton:
    """States are seen histories of 0 to order-1 tokens, named by (length, number); the
    root is (0, 0).  For n-grams of each length, by number: ``arc`` holds the weight of the
    arc that reads the last token from the state of the others (NaN: never seen, no
    arc), ``fail`` the weight of the failure arc of the state the n-gram is, ``shorter`` the
    number of the n-gram without its first token, which is where that arc leads.  ``at``
    names the n-gram that ends at each token."""

    def __init__(self, listed, totals: list[np.ndarray], tokens: int, distinct: int, masses: list[float]):
        self.at = [place for _, place in listed]
        self.unknown = np.log10(1.0 / (tokens + distinct + 1.0))
        p = (totals[0] + 1.0) / (tokens + distinct + 1.0)
        self.arc = [np.where(totals[0] > 0, np.log10(p), np.nan)]
        self.shorter, self.fail = [np.zeros(len(p), np.int64)], []
        for n, mass in enumerate(masses, 1):                     # n-grams of n+1 tokens
            self.fail.append(np.log10(mass / (totals[n - 1] + mass)))
            place = self.at[n]
            one = np.zeros(len(totals[n]), np.int64)             # a token where each n-gram ends
            one[place] = np.arange(len(place))
            shorter = self.at[n - 1][one]
            history = np.where(one > 0, totals[n - 1][self.at[n - 1][one - 1]], 0)
            p = (totals[n] + mass * p[shorter]) / (history + mass)
            self.arc.append(np.where(totals[n] > 0, np.log10(p), np.nan))
            self.shorter.append(shorter)

    def step(self, tokens: np.ndarray, level: np.ndarray, state: np.ndarray):
        """Read one token of each text from its current state: (weights, next states)."""
        weight, todo = np.zeros(len(tokens)), np.arange(len(tokens))
        level, state = level.copy(), state.copy()
        while len(todo):
            known = np.empty(len(todo))
            for n in np.unique(level[todo]):
                mine = level[todo] == n
                known[mine] = self.arc[n][self.at[n][tokens[todo[mine]]]]
            taken = ~np.isnan(known)
            done = todo[taken]
            weight[done] += known[taken]
            # the n-gram just read, or the longest part of it that is a state
            level[done] = np.minimum(level[done] + 1, len(self.arc) - 1)
            lost = todo[~taken]
            for n in np.unique(level[done]):
                mine = done[level[done] == n]
                state[mine] = self.at[n - 1][tokens[mine]] if n else 0
            root = lost[level[lost] == 0]                        # a token never seen: back at the root
            weight[root] += self.unknown
            todo = lost[level[lost] > 0]
            for n in np.unique(level[todo]):                     # failure arcs
                mine = todo[level[todo] == n]
                weight[mine] += self.fail[n - 1][state[mine]]
                state[mine] = self.shorter[n - 1][state[mine]]
            level[todo] -= 1
        return weight, level, state


_START_HASH = np.uint64(xxhash.xxh3_64_intdigest(START))
_END_HASH = np.uint64(xxhash.xxh3_64_intdigest(END))


def _blocks(order: int, modulus: int, remainder: int, shards: int, lists: bool):
    """docs -> per block its rows of listed n-grams, or the block itself."""

    def emit(block: Block):
        name, packed, size = block.packed()
        rows = [("block", None, name, [size], [packed], None)]
        if lists:
            walk, parts = Walk(packed, size, order), {}
            for level in range(1, order + 1):
                keys, _, counts = walk.listed(level)
                for shard, (a, b) in _dealt(keys, shards).items():
                    some = keys[a:b]
                    parts.setdefault(shard, [_NOTHING] * order)[level - 1] = (
                        b - a, _packed(np.diff(some, prepend=np.uint64(0))), _packed(counts[a:b].astype(np.int64)))
            rows = [("list", shard, name, *map(list, zip(*held))) for shard, held in parts.items()]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), ROWS)], schema=ROWS)

    def run(batches):
        row, block = TaskContext.get().partitionId() << 40, Block(order)
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                held = hold_out(doc_id, modulus, remainder)
                history = [START]
                for piece, last in _pieces(text.encode("utf-8")):
                    words = piece.lower().split()
                    if last:
                        words.append(END)
                    if block.size and block.size + len(piece) > BLOCK_BYTES:
                        yield from emit(block)
                        block = Block(order)
                    tokens = history + words
                    block.add(row, doc_id, held, tokens, len(history), len(piece) + 64)
                    history = tokens[-max(order - 1, 1):]
                row += 1
        if block.doc:
            yield from emit(block)

    return run


_NOTHING = (0, b"", b"")             # of a level that has no n-gram in a shard


def _dealt(keys: np.ndarray, shards: int) -> dict[int, tuple[int, int]]:
    """shard -> (begin, end) of its slice of sorted keys, of the shards that have one.
    Shards cut the 64 bits evenly: floor(key * shards / 2**64), by halves of 32 bits."""
    n, half = np.uint64(shards), np.uint64(32)
    shard = ((keys >> half) * n + ((keys & np.uint64(0xFFFFFFFF)) * n >> half)) >> half
    begin = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]])[:len(keys)])
    return dict(zip(shard[begin].tolist(), zip(begin.tolist(), [*begin[1:].tolist(), len(keys)])))


def _count(lists: pd.DataFrame) -> pd.DataFrame:
    """One shard: totals for every block that listed its n-grams, level by level."""
    answers, fits, tokens, distinct_tokens = [[] for _ in range(len(lists))], [], 0, 0
    for level in range(len(lists["sizes"].iloc[0])):
        sizes = np.array([s[level] for s in lists["sizes"]], np.int64)
        keys = np.concatenate([np.cumsum(_unpacked(k[level], n, np.uint64)) for k, n in zip(lists["keys"], sizes)])
        counts = np.concatenate([_unpacked(c[level], n, np.int64) for c, n in zip(lists["counts"], sizes)])
        distinct, place = np.unique(keys, return_inverse=True)
        del keys
        totals = np.zeros(len(distinct), np.int64)
        np.add.at(totals, place, counts & ~ENDS)
        history = np.ones(len(distinct), bool)
        history[place[counts >= ENDS]] = False
        del counts
        at = 0
        for held, n in zip(answers, sizes):
            held.append(_packed(totals[place[at:at + n]]))
            at += n
        fits.append([float((totals == 1).sum()), *_failing(totals[history])])
        if level == 0:
            real = totals[distinct != _START_HASH]
            tokens, distinct_tokens = int(real.sum()), int((real > 0).sum())
    out = pd.DataFrame({
        "kind": "answer", "shard": lists["shard"].iloc[0], "block": lists["block"], "sizes": lists["sizes"],
        "keys": None, "counts": answers, "tokens": 0, "distinct": 0, "fit": None})
    out.at[out.index[0], "fit"] = [x for fit in fits for x in fit]
    out.loc[out.index[0], ["tokens", "distinct"]] = [tokens, distinct_tokens]
    return out


def _failing(history: np.ndarray) -> np.ndarray:
    """For each of MASSES: how many training tokens are expected to fail from
    histories with these counts, each token left out of the counts."""
    c, n = np.unique(history[history > 0], return_counts=True)
    return np.array([(n * c * (m / (c - 1 + m))).sum() for m in MASSES])


def fitted_masses(answers: DataFrame, order: int) -> list[float]:
    """The mass of each level from 2: the largest of MASSES at which no more tokens
    are expected to fail than do, which are the n-grams counted once."""
    found = (answers.where("fit is not null").select(F.posexplode("fit"))
             .groupBy("pos").agg(F.sum("col").alias("sum")).collect())       # a row per level and mass
    each = len(MASSES) + 1
    sums = {(r["pos"] // each + 1, r["pos"] % each): r["sum"] for r in found}
    masses = []
    for level in range(2, order + 1):
        fits = [m for n, m in enumerate(MASSES, 1) if sums.get((level - 1, n), 0) <= sums.get((level, 0), 0)]
        masses.append(max(fits, default=MASSES[0]))
    return masses


def _walks(order: int, shards: int, tokens: int, distinct: int, masses: list[float]):
    """One block and its answers -> (row, doc_id, sums) per text piece.  Blocks
    of equal content share their answers."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        blocks = rows[rows["kind"] == "block"]
        answers = rows[rows["kind"] == "answer"].drop_duplicates("shard").sort_values("shard")
        walks = [Walk(packed[0], int(size[0]), order) for packed, size in zip(blocks["keys"], blocks["sizes"])]
        if not walks:
            raise ValueError("the documents changed between the two passes over them")
        totals = [np.concatenate([_unpacked(c[level], int(n[level]), np.int64)
                                  for c, n in zip(answers["counts"], answers["sizes"])]) for level in range(order)]
        if [len(t) for t in totals] != [len(walks[0].listed(level)[0]) for level in range(1, order + 1)]:
            raise ValueError("the documents changed between the two passes over them")
        model = walks[0].automaton(totals, tokens, distinct, masses)
        score = walks[0].walked(model)
        count = totals[0][model.at[0]]
        base, known = np.log10((count + 1.0) / (tokens + distinct + 1.0)), count > 0
        n = len(walks[0].meta)

        def summed(x):
            return np.bincount(walks[0].doc, weights=np.where(walks[0].scored, x, 0), minlength=n)

        return pd.concat([pd.DataFrame({
            "row": w.rows, "doc_id": w.meta[:, 0], "no_id": w.meta[:, 1] == 1, "held_out": w.meta[:, 2] == 1,
            "n_tokens": summed(1).astype(np.int64), "n_known": summed(known).astype(np.int64),
            "base_score": summed(base), "score": summed(score)}) for w in walks])

    return run


def score(docs: DataFrame, order: int = 3, mass: float | None = None, modulus: int = 7, remainder: int = 2,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Texts whose crc32(doc_id) mod ``modulus`` is ``remainder`` are held out of
    training.  ``mass``: the pseudo-count with which a history trusts the next
    shorter one, at every level; None fits one per level on the training counts."""
    base = id_and_text(docs, id_col, text_col)
    size = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-size // SHARD_BYTES))
    lists = base.mapInArrow(_blocks(order, modulus, remainder, shards, True), ROWS_DDL)
    with shuffles_freed(base.sparkSession):        # the lists are 3 x the text
        answers = cut(lists.groupBy("shard").applyInPandas(
            _count, ROWS_DDL + ", tokens long, distinct long, fit array<double>"), "lm-answers")
    tokens, distinct = answers.agg(F.coalesce(F.sum("tokens"), F.lit(0)),
                                   F.coalesce(F.sum("distinct"), F.lit(0))).first()
    masses = fitted_masses(answers, order) if mass is None else [float(mass)] * (order - 1)
    blocks = base.mapInArrow(_blocks(order, modulus, remainder, shards, False), ROWS_DDL)
    walked = blocks.unionByName(answers.drop("tokens", "distinct", "fit")).groupBy("block").applyInPandas(
        _walks(order, shards, tokens, distinct, masses),
        "row long, doc_id long, no_id boolean, held_out boolean, n_tokens long, n_known long, "
        "base_score double, score double")
    return (walked.groupBy("row", "doc_id", "no_id", "held_out")
                  .agg(*[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")])
                  .select(F.when(~F.col("no_id"), F.col("doc_id")).alias("doc_id"), "held_out", "n_tokens",
                          "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score"))
