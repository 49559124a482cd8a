"""Mixing sources to target weights, with DataFrame functions only.

1. Tokens per source: words ``[^\\x20\\x09-\\x0D]+`` plus one end per document.
2. Temperature: weights proportional to share ** exponent.  The exponent is the
   largest in [0, 1] whose weights reach ``entropy`` (as a part of the entropy of
   equal weights); the repetition limit goes first: no source may be read more
   than ``repeat`` times as often as the least repeated one.  Both conditions are
   monotone in the exponent, and are bracketed together by sections of ``GRID``
   parts, each one small aggregation over the table of sources; the exponent is
   resolved to six decimals, on the side that keeps the repetition limit.
3. Budget: ``budget`` tokens, or just enough that every source is read at least
   once.  A source's quota is its weight's part of the budget.  Weights below 0.001
   are not rounded here, only where they are reported.
4. Permutation: in each epoch a source's documents are read in the order of a
   hash of (seed, epoch, doc_id), as often as the quota lasts; a document is drawn
   if it starts before the quota ends.  A document whose start is at the part x of
   its source's quota goes to block floor(x * blocks), so every block of about
   ``block_tokens`` tokens has all sources in their weights; inside a block the
   order is again a hash.

A source may hold any part of the rows: running token sums are taken per range
of the hash (about ``RANGE_ROWS`` rows), and the sums of the ranges are added up
in a window over ranges, not rows.  The table of sources is broadcast when it has
at most ``BROADCAST_SOURCES`` rows; beyond it is joined under a salt.

Defined results.  NULL text is empty (one token, its end); a NULL source is a
source of its own; a NULL doc_id hashes as the empty text.  Rows that tie on
doc_id and size are interchangeable and each is drawn.  A single source gets
weight 1.  An empty table gives an empty result.  Extra columns are ignored by
``mix`` and carried by ``mixed_rows``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultmart.functions.lineage import cut
from vaultmart.llm.common import named, unpacked, whole_row

GRID = 32
RANGE_ROWS = 4_096
BROADCAST_SOURCES = 10_000
SALTS = 32
HASH_BITS = 60
ORDER = ["block", "turn", "doc_id", "epoch", "tokens", "start"]      # the mixed reading order


def token_count(text: Column) -> Column:
    return (F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")) + 1).cast("long")


def _hash(*parts: Column) -> Column:
    """The first 60 bits of the MD5 of the parts, joined by '|'."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def _key(source: Column) -> Column:
    """A source as a key that is never NULL, so that windows and joins on it
    share one partitioning."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def _source(key: Column) -> Column:
    return F.when(key != "", F.substring(key, 2, 1 << 30))


def source_totals(docs: DataFrame) -> DataFrame:
    return docs.groupBy("source").agg(F.sum("tokens").alias("total"), F.count("*").alias("documents"))


def exponent(totals: DataFrame, entropy: float, repeat: float) -> float:
    """The temperature exponent for a table of (source, total)."""
    sources, most, least = totals.agg(F.count("*"), F.max("total"), F.min("total")).first()
    if sources < 2:
        return 1.0
    # repetition: (most / least) ** (1 - a) <= repeat
    floor = 1.0 if repeat <= 1 and most > least else \
        max(0.0, 1 - math.log(repeat) / math.log(most / least)) if most > least else 0.0
    wanted = entropy * math.log(sources)

    def reached(grid: list[float]) -> dict[float, bool]:
        """Whether the weights of each exponent have the wanted entropy."""
        log = F.log(F.col("total") / F.lit(float(most)))
        rows = totals.select(log.alias("log"), F.explode(F.array(*map(F.lit, grid))).alias("a"))
        share = F.exp(F.col("a") * F.col("log"))
        rows = rows.groupBy("a").agg(F.sum(share).alias("z"), F.sum(share * F.col("a") * F.col("log")).alias("s"))
        return {r["a"]: r["ok"] for r in rows.select("a", (F.log("z") - F.col("s") / F.col("z") >= wanted)
                                                     .alias("ok")).collect()}

    low, high = 0.0, 1.0
    if reached([1.0])[1.0]:
        low = 1.0
    while low < 1.0 and high - low > 1e-9:
        grid = [low + (high - low) * n / GRID for n in range(1, GRID)]
        ok = reached(grid)
        low, high = (max([low, *(g for g in grid if ok[g])]), min([high, *(g for g in grid if not ok[g])]))
    return math.ceil(max(low, floor) * 1e6 - 1e-3) / 1e6


def quotas(docs: DataFrame, entropy: float, repeat: float, budget: int | None,
           block_tokens: int) -> tuple[DataFrame, int]:
    """(source, total, documents, weight, quota) and the number of blocks."""
    totals = cut(source_totals(docs), "mix-sources")
    a = exponent(totals, entropy, repeat)
    most = totals.agg(F.max("total")).first()[0]
    if most is None:
        return totals.select("*", F.lit(0.0).alias("weight"), F.lit(0).cast("long").alias("quota")), 1
    raw = totals.withColumn("raw", F.pow(F.col("total") / F.lit(float(most)), F.lit(a)))
    # sums in a fixed scale, so that their order cannot change the result
    raw = raw.withColumn("raw", _rounded("raw", 12).cast("decimal(38,30)"))
    z = raw.agg(F.sum("raw")).first()[0]
    weighted = raw.withColumn("weight", F.col("raw").cast("double") / F.lit(float(z)))
    weighted = weighted.withColumn("weight", _rounded("weight", 9))
    whole = budget is None
    if whole:
        budget = weighted.agg(F.max(F.ceil(F.col("total") / F.col("weight")))).first()[0]
    blocks = max(1, -(-budget // block_tokens))
    quota = F.round(F.col("weight") * budget).cast("long")
    # without a budget every document is read, whatever the division lost
    quota = F.greatest("total", quota) if whole else quota
    return weighted.drop("raw").withColumn("quota", quota), blocks


def _rounded(name: str, digits: int) -> Column:
    """Rounded to ``digits`` decimals, but only where six significant ones stay."""
    return F.when(F.col(name) >= 10.0 ** (6 - digits), F.round(name, digits)).otherwise(F.col(name))


def _with_quota(docs: DataFrame, sources: DataFrame) -> DataFrame:
    """Join the table of sources to rows of which one source may hold a third."""
    if sources.count() <= BROADCAST_SOURCES:
        return docs.join(F.broadcast(sources), "source")
    salted = docs.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    copies = sources.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return salted.join(copies, ["source", "salt"]).drop("salt")


def _drawn(docs: DataFrame, entropy: float, repeat: float, budget: int | None, block_tokens: int,
           seed: str) -> DataFrame:
    sources, blocks = quotas(docs, entropy, repeat, budget, block_tokens)
    sources = cut(sources, "mix-quotas")
    rows = _with_quota(docs, sources).where(F.col("quota") > 0)
    epochs = F.ceil(F.col("quota") / F.col("total")).cast("int")
    rows = rows.withColumn("epoch", F.explode(F.sequence(F.lit(1), epochs)))
    rows = rows.withColumn("at", _hash(F.lit(seed), F.col("epoch"), F.col("doc_id")))
    ranges = F.ceil(F.col("documents") / RANGE_ROWS)
    rows = rows.withColumn("range", F.floor(F.col("at") / F.lit(float(1 << HASH_BITS)) * ranges))
    part = ["source", "epoch", "range"]
    # (a) running sums inside a range
    inside = Window.partitionBy(*part).orderBy("at", "doc_id", "tokens")
    rows = rows.withColumn("inside", F.sum("tokens").over(inside) - F.col("tokens"))
    # (b) where each range starts; the light columns are read a second time for it
    light = _with_quota(docs.select("doc_id", "source", "tokens"), sources).where(F.col("quota") > 0)
    light = light.withColumn("epoch", F.explode(F.sequence(F.lit(1), epochs)))
    light = light.withColumn("range", F.floor(_hash(F.lit(seed), F.col("epoch"), F.col("doc_id"))
                                              / F.lit(float(1 << HASH_BITS)) * ranges))
    sums = light.groupBy(*part).agg(F.sum("tokens").alias("sum"))
    along = Window.partitionBy("source", "epoch").orderBy("range")
    sums = sums.select(*part, (F.sum("sum").over(
        along.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("sum")).alias("before"))
    rows = rows.join(sums, part)
    start = (F.col("epoch") - 1) * F.col("total") + F.col("before") + F.col("inside")
    rows = rows.withColumn("start", start).where(F.col("start") < F.col("quota"))
    return (rows.withColumn("block", F.floor(F.col("start") / F.col("quota") * F.lit(float(blocks))).cast("long"))
                .withColumn("turn", _hash(F.lit(seed), F.lit("block"), F.col("block"), F.col("epoch"), F.col("doc_id"))))


def _positions(drawn: DataFrame) -> DataFrame:
    """A block has about ``block_tokens`` tokens, whatever the sources' sizes."""
    order = Window.partitionBy("block").orderBy(*ORDER[1:])
    return drawn.withColumn("position", F.row_number().over(order))


def mix(docs: DataFrame, entropy: float = 0.95, repeat: float = 1.5, budget: int | None = None,
        block_tokens: int = 100_000, seed: str = "mix", id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source") -> DataFrame:
    """The mixed reading order: block, position, doc_id, source, epoch, tokens,
    weight (of the source)."""
    base = docs.select(named(id_col).cast("long").alias("doc_id"), _key(named(source_col)).alias("source"),
                       token_count(named(text_col)).alias("tokens"))
    base = cut(base, "mix-tokens")            # the texts are counted once
    return _positions(_drawn(base, entropy, repeat, budget, block_tokens, seed)).select(
        "block", "position", "doc_id", _source(F.col("source")).alias("source"), "epoch", "tokens",
        F.round("weight", 9).alias("weight"))


def mixed_rows(docs: DataFrame, entropy: float = 0.95, repeat: float = 1.5, budget: int | None = None,
               block_tokens: int = 100_000, seed: str = "mix", id_col: str = "doc_id", text_col: str = "text",
               source_col: str = "source") -> DataFrame:
    """The whole rows of ``docs`` in mixed order, repeated as the weights ask: the
    partitions are ranges of (block, turn) in rising order, and each is sorted, so
    the files of a write hold the order of ``mix`` one after another."""
    base = docs.select(named(id_col).cast("long").alias("doc_id"), _key(named(source_col)).alias("source"),
                       token_count(named(text_col)).alias("tokens"), whole_row(docs).alias("row"))
    placed = _drawn(base, entropy, repeat, budget, block_tokens, seed)
    return unpacked(placed.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER), docs.columns)
