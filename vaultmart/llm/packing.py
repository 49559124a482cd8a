"""Best-fit packing of documents into sequences of several permitted lengths.

Documents are measured in words ``[^\\x20\\x09-\\x0D]+`` plus one end.  What is
longer than the largest capacity is cut into segments of that capacity and a
rest, so no token is lost.  Segments are dealt into shards of about ``shard_rows``
(a number proportional to the rows, so no shard grows): by hash, or, if the
documents come ``in_order``, by runs of their reading order.  Each shard is packed
on its own in one group of (id, length) rows:

* segments by falling length; each goes to the open bin that it leaves with the
  least room (best fit; of equal bins the one opened last);
* where none fits, a bin is opened whose cost per expected token is least.  A
  sequence of capacity c costs ``overhead + c + c * c / attention``: attention makes
  long sequences dear, the overhead and the room that nothing fills make short ones
  dear.  The tokens a bin can expect are the segment that opens it and what the
  lengths still to place would put into the rest, longest first; that rest is
  taken in the share in which tokens are left for all open room;
* at last every bin shrinks to the least permitted capacity that holds it.

Open bins are stacks by room left, and a bit set of the rooms in use finds the
best fit in one step, so a segment costs constant time.

Defined results.  NULL text is empty: one token, its end.  Repeated rows and rows
with NULL or equal ids are separate documents.  An empty table gives an empty
result; extra columns are ignored.  A bin's id is (shard, number).

Reading order (``in_order``).  Documents read from files come in the order of the
files' part numbers and of the rows inside them, as a sorted write left them; other
rows in the order of their partitions.  Shard n is the nth run of ``shard_rows``
segments, and its bins are numbered by their first segment in the order, so
reading bins by (shard, bin) keeps the order up to the packing inside a shard.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultmart.functions.ids import append_sequence_ids
from vaultmart.functions.lineage import cut
from vaultmart.llm.common import id_and_text

CAPACITIES = (512, 1024, 2048, 4096)
OVERHEAD = 32            # cost of a sequence besides its length, in tokens
ATTENTION = 12_288       # length at which attention costs as much as all the rest
SHARD_ROWS = 20_000
COLUMNS = ["shard", "bin", "capacity", "place_in_bin", "doc_id", "segment", "start", "length"]


def _segments(largest: int):
    """(doc_id, segment, start, length): a document's token ranges.  Columns after
    doc_id and text are kept behind them."""

    def run(batches):
        for batch in batches:
            words = np.array([len(t.encode("utf-8").split()) + 1 for t in batch.column("text").to_pylist()], np.int64)
            count = -(-words // largest)
            doc = np.repeat(np.arange(len(words)), count)
            segment = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
            start = segment * largest
            length = np.minimum(words[doc] - start, largest)
            kept = batch.schema.names[2:]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(doc)), pa.array(segment), pa.array(start), pa.array(length),
                 *[batch.column(c).take(pa.array(doc)) for c in kept]],
                names=["doc_id", "segment", "start", "length", *kept])

    return run


def cost(capacity: int, overhead: int = OVERHEAD, attention: int = ATTENTION) -> float:
    return overhead + capacity + capacity * capacity / attention


def _fill(room: int, lengths: int, counts: list[int]) -> int:
    """Tokens that the lengths still to place put into ``room``, longest first;
    bit n of ``lengths`` is set if ``counts[n]`` segments of length n are left."""
    free = room
    while free and (fitting := lengths & ((2 << free) - 1)):
        length = fitting.bit_length() - 1
        free -= min(counts[length], free // length) * length
        lengths = fitting ^ (1 << length)
    return room - free


def best_fit(lengths: np.ndarray, capacities=CAPACITIES, overhead: int = OVERHEAD, attention: int = ATTENTION):
    """(bin, offset) of each length (all at most the largest capacity; sorted
    falling), each bin's final capacity, and the capacity it was opened with."""
    largest, left, open_room = max(capacities), int(lengths.sum()), 0
    costs = {c: cost(c, overhead, attention) for c in sorted(capacities)}
    counts = np.bincount(lengths, minlength=largest + 1).tolist()
    to_place = sum(1 << n for n, count in enumerate(counts) if count)
    stacks: list[list[int]] = [[] for _ in range(largest + 1)]
    rooms, used, opened = 0, [], []            # rooms: bit r is set if a bin has r left
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for n, length in enumerate(lengths.tolist()):
        counts[length] -= 1
        if not counts[length]:
            to_place ^= 1 << length
        left -= length
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            b = stacks[room].pop()
            if not stacks[room]:
                rooms ^= 1 << room
            open_room -= room
        else:
            b, best = len(used), None
            for c, price in costs.items():
                if c >= length:
                    rest = c - length
                    share = min(1.0, left / (open_room + rest)) if rest else 0.0
                    each = price / (length + share * _fill(rest, to_place, counts))
                    if best is None or each < best:
                        best, room = each, c
            used.append(0)
            opened.append(room)
        bins[n], offsets[n] = b, used[b]
        used[b] += length
        room -= length
        open_room += room
        if room:
            if not stacks[room]:
                rooms |= 1 << room
            stacks[room].append(b)
    final = [min(c for c in capacities if c >= u) for u in used]
    return bins, offsets, np.array(final, np.int64), np.array(opened, np.int64)


def _in_order(docs: DataFrame, largest: int, id_col: str, text_col: str) -> DataFrame:
    """(at, doc_id, segment, start, length): ``at`` counts the segments from 1 in
    the reading order."""
    row = F.monotonically_increasing_id().alias("row")
    try:
        # a scan deals files to partitions by size: their names have the order
        placed = id_and_text(docs, id_col, text_col, F.input_file_name().alias("file"), row)
    except AnalysisException as e:
        if e.getCondition() != "MULTI_SOURCES_UNSUPPORTED_FOR_EXPRESSION":
            raise
        placed = id_and_text(docs, id_col, text_col, F.lit("").alias("file"), row)     # partitions have it
    segments = cut(placed.mapInArrow(
        _segments(largest), "doc_id long, segment long, start long, length long, file string, row long"), "pack-segments")
    # numbers of more than five digits would sort wrongly as text
    part = F.nullif(F.regexp_extract("file", r"part-(\d+)[^/]*$", 1), F.lit("")).cast("long")
    order = [F.col("part").asc_nulls_last(), *map(F.col, ("file", "row", "segment"))]
    return append_sequence_ids(segments.withColumn("part", part), order, None, "at").drop("part", "file", "row")


def pack(docs: DataFrame, capacities=CAPACITIES, overhead: int = OVERHEAD, shard_rows: int = SHARD_ROWS,
         id_col: str = "doc_id", text_col: str = "text", in_order: bool = False,
         attention: int = ATTENTION) -> DataFrame:
    """One row per segment: shard, bin, capacity, place_in_bin (its first token's
    place), doc_id, segment, start (its first token in the document), length."""
    largest = max(capacities)
    if in_order:
        dealt = _in_order(docs, largest, id_col, text_col)
        dealt = dealt.withColumn("shard", F.floor((F.col("at") - 1) / F.lit(shard_rows)))
        ties = ["at"]
    else:
        segments = cut(id_and_text(docs, id_col, text_col).mapInArrow(
            _segments(largest), "doc_id long, segment long, start long, length long"), "pack-segments")
        shards = max(1, -(-segments.count() // shard_rows))
        # repeated rows of one id are spread too: the row's place in its partition is hashed as well
        dealt = segments.withColumn("shard", F.pmod(F.xxhash64(
            "doc_id", "segment", F.monotonically_increasing_id()), F.lit(shards)))
        ties = ["doc_id", "segment"]

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", *ties], ascending=[False, *[True] * len(ties)], kind="stable")
        bins, offsets, final, _ = best_fit(rows["length"].to_numpy(), capacities, overhead, attention)
        capacity = final[bins]
        if in_order:
            first = np.full(len(final), np.iinfo(np.int64).max)
            np.minimum.at(first, bins, rows["at"].to_numpy())
            bins = np.argsort(np.argsort(first))[bins]
        return rows.assign(bin=bins, capacity=capacity, place_in_bin=offsets)[COLUMNS]

    return dealt.groupBy("shard").applyInPandas(
        run, "shard long, bin long, capacity long, place_in_bin long, doc_id long, segment long, start long, length long")
