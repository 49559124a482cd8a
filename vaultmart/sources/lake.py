"""Scans of lake and warehouse tables (S1-S3, S10).

Every scan passes the declared schema: no inference, and the ``year``
partition column reads as STRING (Spark would infer an integer).  A scan of
one partition is a filter on the partition column, which Spark turns into
partition pruning (``PartitionFilters`` in the plan): other years' files are
never listed for reading.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultmart.sources.schemas import schema_of


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin a scan that is a single task, as a file of one Parquet row
    group under the split size is: every narrow step after it would run on one
    core.  A table of two or more splits is left as it is, whatever the cluster's
    width, so no table beyond one split is ever shuffled for this.
    """
    if df.rdd.getNumPartitions() > 1:
        return df
    return df.repartition(min_partitions or df.sparkSession.sparkContext.defaultParallelism)


def scan(spark: SparkSession, table: str, path: str) -> DataFrame:
    """S1/S2: external Parquet table (a directory, or a glob such as
    ``.../payment/*/``) read with its declared schema."""
    return spark.read.schema(schema_of(table)).parquet(path)


def scan_year(spark: SparkSession, table: str, root: str, year: int) -> DataFrame:
    """S3: one ``year`` partition of a partitioned lake table."""
    return scan(spark, table, root).where(F.col("year") == F.lit(str(year)))
