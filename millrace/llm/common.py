"""Pieces that several operators of this package share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from millrace.plans.durable import materialise, temporary

__all__ = ["WORD", "crc_bucket", "documents", "fresh", "materialise", "numbered", "small_or_shuffled", "table", "temporary", "text_or_empty", "words_in"]

# A word is a run of characters that are neither a space nor one of \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def text_or_empty(text: str | Column) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words_in(text: str | Column) -> Column:
    """Number of words, 0 for null."""
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long")


def crc_bucket(doc_id: str | Column, modulus: int) -> Column:
    """crc32 of the id as text modulo ``modulus``; a null id counts as an empty text."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(column.cast("string"), F.lit(""))) % modulus


def numbered(rows: DataFrame, by: str, order: Sequence[str], into: str, total: int, per_block: int = 50_000) -> DataFrame:
    """Gapless numbers from 0 within each value of ``by``, without bringing a value's rows into one task.

    Rows are dealt into hash blocks of about ``per_block`` rows; block counts give each block its
    first number.  ``rows`` is read twice, so it should be a written table.
    """
    blocks = max(1, -(-total // per_block))
    rows = rows.withColumn("_block", F.pmod(F.xxhash64(*order), F.lit(blocks)))
    before = Window.partitionBy(by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    firsts = rows.groupBy(by, "_block").agg(F.count(F.lit(1)).alias("_n")).select(
        by, "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first")
    )
    place = F.row_number().over(Window.partitionBy(by, "_block").orderBy(*order))
    return (
        rows.join(firsts, [by, "_block"])
        .withColumn(into, F.col("_first") + place - 1)
        .drop("_block", "_first")
    )


# Tables of a few numbers a row are broadcast up to this many rows (some 32 MB), after they were counted.
BROADCAST_ROWS = 1_000_000


def small_or_shuffled(keys: DataFrame) -> DataFrame:
    """A written table of narrow rows with a broadcast hint if it is small, so that texts stay where they are."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys


def fresh(name: str, taken: Sequence[str]) -> str:
    """``name``, or with underscores before it if a column is called so (Spark ignores case)."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name = "_" + name
    return name
