"""A training-corpus pipeline: five stages over the documents table.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it
kept; all but the last return the columns of ``documents``.  ``run`` writes every
stage as Parquet in the folder of spark.checkpoint.dir and reads it again, so no
stage's plan holds an earlier one and a lost executor costs a read.  A stage's files
are deleted once the next stage is written.

NULLs, empty texts, ties, repeated rows, extra columns and empty tables are
handled as each operator's module defines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vaultmart.functions.lineage import ScratchTable
from vaultmart.llm import exact_dedup, mixing, packing, simhash, toxicity
from vaultmart.llm.common import table


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more go; the model is fitted on the documents given."""
    return toxicity.accepted(docs, toxicity.train(docs, table(spark, sf_dir, "labels")), 0.5)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group of texts that are equal but for white space."""
    return exact_dedup.unique_rows(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of every SimHash class (3-word
    shingles, at most 2 bits apart)."""
    return simhash.representatives(docs, width=3, max_bits=2)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in mixed order; sources short of their weight are read again,
    up to 1.5 times in all.  Nothing is left out.  The written files hold the order."""
    return mixing.mixed_rows(docs, entropy=0.95, repeat=1.5)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ranges of all documents, placed in sequences of 512 to 4,096 tokens;
    shards are runs of the mixed order."""
    return packing.pack(docs, in_order=True)


STAGES = [("toxicity", without_toxic), ("exact dedup", without_copies), ("simhash near-dedup", without_near_copies),
          ("mixing", mixed), ("packing", packed)]

# SQL has no XXH64 and cannot train the trees of the first stage; tests/llm
# compares run() with a brute-force version on a small table.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    before = None
    for _, stage in STAGES[:-1]:
        written = ScratchTable.of(stage(spark, docs, sf_dir), "pipeline")
        docs = written.read()
        if before:
            before.drop()
        before = written
    return STAGES[-1][1](spark, docs, sf_dir)
