"""Helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space of every word definition in this package: \x20 and \x09-\x0D.
# It is also exactly what bytes.split() and bytes.strip() use.
WHITE_SPACE = b" \t\n\x0b\x0c\r"


def named(name: str) -> Column:
    """A column by its exact name (dots and spaces included)."""
    return F.col("`" + name.replace("`", "``") + "`")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: Column) -> DataFrame:
    """(doc_id long, text string, more), NULL text read as empty.  Every other column
    is left behind, so extra columns cannot clash with an operator's own."""
    return docs.select(named(id_col).cast("long").alias("doc_id"),
                       F.coalesce(named(text_col).cast("string"), F.lit("")).alias("text"), *more)


def whole_row(docs: DataFrame) -> Column:
    """All columns of a row as one struct, to be carried past an operator."""
    return F.struct(*[named(c).alias(c) for c in docs.columns])


def unpacked(df: DataFrame, columns: list[str], row: str = "row") -> DataFrame:
    """The columns packed by ``whole_row``, in their old order."""
    return df.select(*[F.col(row).getField(c).alias(c) for c in columns])


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """crc32 of the id's decimal text mod ``modulus`` equals ``remainder``
    (a NULL id is hashed as the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus == remainder


def pieces(text: bytes, limit: int):
    """Cut ``text`` into pieces of about ``limit`` bytes, always at white space,
    so no word is divided (a single longer word stays whole)."""
    start, n = 0, len(text)
    while n - start > limit:
        end = start + limit
        while end < n and text[end] not in WHITE_SPACE:
            end += 1
        yield text[start:end]
        start = end
    yield text[start:]
