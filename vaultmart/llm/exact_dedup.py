"""Exact deduplication that survives very large groups of copies.

Two texts are equal when they are identical after deleting every white-space
character (\\x20, \\x09-\\x0D).  Three combining steps, each of which groups by
the digest *and the full normalised text*, so a digest collision could never
merge different texts:

1. locally: Spark's map-side aggregation leaves one row per text and task;
2. salted: the rows of one text that many tasks still hold are merged in
   ``SALTS`` separate groups, by the salt of the task they come from;
3. globally: the at most ``SALTS`` winners of a text are merged.

So no reducer sees more than (tasks / SALTS) rows of a text in step 2 and
``SALTS`` rows in step 3, however many copies there are.

Rows find their class again by digest and tag.  Step 3 also notes where different
texts share both; the rows of such a key are joined by their whole text.  Classes
that hold a ``HOT``-th of all rows or more (at most ``HOT`` classes) are joined by
broadcast, so no reducer gets all rows of a very large one.

Defined results.  NULL text counts as empty; all empty (or white-space-only)
texts are one group.  The row with the most code points in its original text
stays, then the smallest doc_id (a NULL id loses to any other).  ``groups``
says ``kept`` of every row whose doc_id is the group's keep_id; where one
doc_id is repeated with equal texts, ``unique_rows`` still returns one row.
An empty table gives an empty result.  Extra columns never take part.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultmart.functions.lineage import cut
from vaultmart.llm.common import WHITE_SPACE, id_and_text, named, unpacked, whole_row

SALTS = 16
HOT = 1_000


def normalised(text: str) -> bytes:
    return text.encode("utf-8").translate(None, WHITE_SPACE)


def _keys(with_text: bool):
    """The last column, text, becomes points, digest and tag (a second,
    independent hash), and the normalised text if asked; others pass through."""

    def run(batches):
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            norms = [normalised(t) for t in texts]
            columns = {
                "points": pa.array([len(t) for t in texts], pa.int64()),
                "digest": pa.array([hashlib.sha256(n).digest() for n in norms], pa.binary()),
                "tag": pa.array([xxhash.xxh64_intdigest(n) >> 1 for n in norms], pa.int64()),
            }
            if with_text:
                columns["norm"] = pa.array(norms, pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns.values()],
                                             names=[*batch.schema.names[:-1], *columns])

    return run


KEYS = "points long, digest binary, tag long"


def _combined(keyed: DataFrame, best: Column) -> DataFrame:
    """Steps 1-3 over rows of (digest, tag, norm, best, group_size)."""
    total = F.sum("group_size").alias("group_size")
    salted = (keyed.withColumn("salt", F.pmod(F.hash(F.spark_partition_id()), F.lit(SALTS)))
                   .groupBy("digest", "tag", "norm", "salt").agg(best, total))
    # partitioned by the hashes alone, which serves the grouping by key and the join as well
    return salted.repartition("digest", "tag").groupBy("digest", "tag", "norm").agg(best, total)


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    base = id_and_text(docs, id_col, text_col)
    keyed = base.mapInArrow(_keys(True), f"doc_id long, {KEYS}, norm binary").select(
        "digest", "tag", "norm", F.lit(1).cast("long").alias("group_size"),
        F.struct("points", F.bitwise_not("doc_id").alias("not_id")).alias("best"))
    one = F.struct(F.bitwise_not(F.col("best.not_id")).alias("keep_id"), "group_size")
    # one row per (digest, tag); texts only where several share it
    keys = cut(_combined(keyed, F.max("best").alias("best"))
               .groupBy("digest", "tag").agg(F.collect_list(F.struct("norm", one.alias("class"))).alias("all"))
               .select("digest", "tag", F.col("all")[0]["class"].alias("class"),
                       F.when(F.size("all") > 1, F.col("all")).alias("several")), "exact-classes")
    each = base.mapInArrow(_keys(False), f"doc_id long, {KEYS}")
    found = _found(each, keys.where("several IS NULL").select("digest", "tag", "class"))
    several = keys.where("several IS NOT NULL")
    if not several.isEmpty():
        content = several.select("digest", "tag", F.inline("several"))
        found = found.where("class IS NOT NULL").unionByName(
            base.mapInArrow(_keys(True), f"doc_id long, {KEYS}, norm binary")
            .join(content, ["digest", "tag", "norm"]).select("doc_id", "digest", "class"))
    return found.select("doc_id", "class.keep_id", "class.group_size",
                        F.col("doc_id").eqNullSafe(F.col("class.keep_id")).alias("kept"),
                        F.lower(F.hex("digest")).alias("text_sha256"))


def _found(each: DataFrame, classes: DataFrame) -> DataFrame:
    """(doc_id, digest, class) of every row; class is NULL where ``classes`` lacks the key."""
    size = F.col("class.group_size")
    total = classes.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    is_hot = (size > 1) & (size * HOT >= total)
    hot = F.broadcast(classes.where(is_hot).withColumnRenamed("class", "hot"))
    # rows of hot classes are done: they go on under tags that no class has, evenly spread
    tag = F.when(F.col("hot").isNull(), F.col("tag")).otherwise(-1 - F.monotonically_increasing_id())
    return (each.join(hot, ["digest", "tag"], "left").withColumn("tag", tag)
                .join(classes.where(~is_hot), ["digest", "tag"], "left")
                .select("doc_id", "digest", F.coalesce("hot", "class").alias("class")))


def unique_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One whole row of ``docs`` per group of equal texts, all columns kept.
    Rows that tie on length and doc_id are told apart by their other columns,
    which must be orderable."""
    base = docs.select(whole_row(docs).alias("row"), named(id_col).cast("long").alias("doc_id"),
                       F.coalesce(named(text_col).cast("string"), F.lit("")).alias("text"))
    schema = (base.drop("text").schema.add("points", "long").add("digest", "binary")
                  .add("tag", "long").add("norm", "binary"))
    keyed = base.mapInArrow(_keys(True), schema).select(
        "digest", "tag", "norm", F.lit(1).cast("long").alias("group_size"),
        F.struct("points", F.bitwise_not("doc_id").alias("not_id"), "row").alias("best"))
    won = _combined(keyed, F.max("best").alias("best"))
    return unpacked(won.select(F.col("best.row").alias("row")), docs.columns)
