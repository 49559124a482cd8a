"""Quality rules from compression bands.

Natural text compresses to a narrow band of ratios; text that repeats itself falls
below it, noise and encoded data lie above it.  The ratio is the size of the
zstandard frame over the size of the UTF-8 text.  A short text's ratio is high
whatever it says (the frame and the first use of every word cost most), so each
length has limits of its own (``BANDS``).  A document is rejected when

* its ratio over the whole text is outside the band of its length, or
* chunks (every ``CHUNK`` bytes; the last one may be shorter) outside the bands of
  *their* lengths hold more than ``SHARE`` of its bytes.  This finds damage that a
  long text's own ratio averages away.

Beside the verdict each row has plain counts of the whole text, and fails on too few
words or too many repeated ones (``base_failed``).

One pass over the rows, no shuffle; a text needs memory of a few times its own size,
and its word numbers (eight bytes a word) while it is measured.

Defined results.  NULL and empty texts have no words and fail.  Words are
``[^\\x20\\x09-\\x0D]+``; characters are code points.  A text shorter than the first
band has no compression limits.  Repeated rows and NULL ids are measured like any
other, every row gives one row; extra columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultmart.llm.common import WHITE_SPACE, named, pieces

LEVEL = 3
CHUNK = 4096             # bytes
SHARE = 0.1              # of a document's bytes that may lie in chunks outside their bands
# (from this many bytes on, lowest ratio, highest ratio), for prose: the lowest ratios lie
# about 0.02 under those of any text labelled good in the test tables, the highest well
# above them.  Code and tables repeat themselves more and want bands of their own.
BANDS = ((64, 0.30, 1.30), (128, 0.35, 1.05), (256, 0.49, 0.92), (512, 0.495, 0.85), (768, 0.466, 0.82),
         (1024, 0.46, 0.78), (1536, 0.446, 0.75), (2048, 0.436, 0.72), (3072, 0.43, 0.72), (4096, 0.416, 0.70),
         (6144, 0.406, 0.70), (8192, 0.40, 0.68), (12288, 0.394, 0.68), (16384, 0.382, 0.68), (32768, 0.372, 0.68),
         (65536, 0.34, 0.68))
LEAST_WORDS = 50
MOST_REPEATED = 50       # per cent of the words
SYMBOLS = b"#*$%&|<>"
PIECE = 1 << 20

_CONTINUED = bytes(range(0x80, 0xC0))        # bytes that begin no code point


def repeated_words(text: bytes) -> tuple[int, int]:
    """(words, words in 3-word windows that the text has twice or more)."""
    number: defaultdict = defaultdict(count().__next__)      # a number per distinct word
    parts = []
    for piece in pieces(text, PIECE):
        words = piece.split()
        parts.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
    ids = np.concatenate(parts)
    if len(ids) < 4:
        return len(ids), 0
    distinct = len(number)
    code = ids[:-1] * distinct + ids[1:]
    if distinct ** 3 >= 1 << 63:             # three numbers do not fit: number the pairs first
        code = np.unique(code, return_inverse=True)[1]
    code = code[:-1] * distinct + ids[2:]
    ordered = np.sort(code)
    again = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(again):
        return len(ids), 0
    window = np.isin(code, again)
    covered = np.zeros(len(ids), bool)
    for k in range(3):
        covered[k:len(window) + k] |= window
    return len(ids), int(covered.sum())


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    return len(lines) - len(set(lines))


def outside(size: int, ratio: float, bands=BANDS) -> bool:
    """Whether ``ratio`` is outside the band of texts of ``size`` bytes."""
    place = bisect_right(bands, size, key=lambda band: band[0])
    return place > 0 and not bands[place - 1][1] <= ratio <= bands[place - 1][2]


def compressed(text: bytes, packer, chunk: int = CHUNK, bands=BANDS) -> tuple[float, float, float, float]:
    """(ratio of the text, lowest and highest chunk ratio, share of its bytes in chunks
    outside their bands); an empty text has ratio 1."""
    if not text:
        return 1.0, 1.0, 1.0, 0.0
    whole = len(packer.compress(text)) / len(text)
    if len(text) <= chunk:
        return whole, whole, whole, float(outside(len(text), whole, bands))
    low, high, bad = np.inf, -np.inf, 0
    for start in range(0, len(text), chunk):
        part = text[start:start + chunk]
        ratio = len(packer.compress(part)) / len(part)
        bad += len(part) * outside(len(part), ratio, bands)
        if len(part) >= bands[0][0]:         # a shorter rest tells nothing
            low, high = min(low, ratio), max(high, ratio)
    return whole, low, high, bad / len(text)


COLUMNS = {"n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long",
           "n_repeat_words": "long", "base_failed": "boolean", "kept": "boolean", "n_bytes": "long",
           "ratio": "double", "lowest_chunk": "double", "highest_chunk": "double", "bad_share": "double"}


def measured(text: bytes, packer, chunk: int = CHUNK, bands=BANDS, share: float = SHARE) -> tuple:
    """The values of ``COLUMNS`` of one text."""
    words, repeated = repeated_words(text)
    failed = words < LEAST_WORDS or 100 * repeated > MOST_REPEATED * words
    whole, low, high, bad = compressed(text, packer, chunk, bands)
    rejected = outside(len(text), whole, bands) or bad > share
    return (words, len(text.translate(None, _CONTINUED + WHITE_SPACE)),
            len(text) - len(text.translate(None, SYMBOLS)), repeated_lines(text), repeated,
            failed, not failed and not rejected, len(text), whole, low, high, bad)


def rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", level: int = LEVEL, chunk: int = CHUNK,
          bands=BANDS, share: float = SHARE) -> DataFrame:
    """doc_id and ``COLUMNS`` of every row."""

    def run(batches):
        packer = zstandard.ZstdCompressor(level=level)
        for batch in batches:
            rows = [measured(text, packer, chunk, bands, share) for text in batch.column("text").to_pylist()]
            columns = zip(*rows) if rows else [()] * len(COLUMNS)
            kinds = {"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"),
                 *[pa.array(values, kinds[kind]) for values, kind in zip(columns, COLUMNS.values())]],
                names=["doc_id", *COLUMNS])

    source = docs.select(named(id_col).cast("long").alias("doc_id"),
                         F.coalesce(named(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))
    return source.mapInArrow(run, "doc_id long, " + ", ".join(f"{name} {kind}" for name, kind in COLUMNS.items()))
