"""Seeded pseudo-random order: sampling and splitting that any engine can reproduce.

The order of a row is the md5 of seed and id, ties by id.  A sample or split is a range of that
order, so once the row at its border is known every row is judged where it lies, without a
shuffle.  Borders come from the counts of hash-prefix buckets; a bucket with more rows than one
task should rank is counted again by a longer prefix, and the last one is ranked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

MAX_DIGITS = 5


def order_key(seed: int, id_col: str) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(id_col)))


def prefix_digits(rows: int, rows_per_bucket: int = 200_000) -> int:
    """Hex digits such that a bucket of the hash space holds about ``rows_per_bucket`` rows."""
    digits = 1
    while rows > rows_per_bucket * 16**digits and digits < MAX_DIGITS:
        digits += 1
    return digits


def _nth(keyed: DataFrame, id_col: str, prefix: str, place: int, rows: int, rows_per_bucket: int):
    """The row at ``place`` (from 1) among the ``rows`` rows whose hash starts with ``prefix``."""
    while rows > rows_per_bucket and len(prefix) < 32:
        digits = min(len(prefix) + prefix_digits(rows, rows_per_bucket), 32)
        inside = keyed.filter(F.col("_h").startswith(prefix)).groupBy(F.substring("_h", 1, digits).alias("_b"))
        upto = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
        ends = inside.agg(F.count(F.lit(1)).alias("_c")).select("_b", "_c", F.sum("_c").over(upto).alias("_end"))
        border = ends.filter(F.col("_end") >= place).orderBy("_end").first()
        prefix, place, rows = border["_b"], place - (border["_end"] - border["_c"]), border["_c"]
    one = keyed.filter(F.col("_h").startswith(prefix))
    ranked = one.withColumn("_r", F.row_number().over(Window.orderBy("_h", id_col)))
    return ranked.filter(F.col("_r") == place).first()


def within_first(
    df: DataFrame, id_col: str, seed: int, positions: Sequence[int], rows: int, rows_per_bucket: int = 200_000
) -> list[Column]:
    """For each position p a condition that holds for exactly the first p rows of the order.

    ``rows`` is the number of rows of ``df``; ids must be unique.
    """
    inner = [p for p in set(positions) if 0 < p < rows]
    found = {}
    if inner:
        digits = prefix_digits(rows, rows_per_bucket)
        keyed = df.select(F.col(id_col), order_key(seed, id_col).alias("_h")).withColumn("_b", F.substring("_h", 1, digits))
        counts = keyed.groupBy("_b").agg(F.count(F.lit(1)).alias("_c"))
        # One row per bucket, at most 16^MAX_DIGITS whatever the input size.
        upto = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
        ends = counts.select("_b", "_c", F.sum("_c").over(upto).alias("_end"))
        borders = ends.withColumn("_p", F.explode(F.array(*[F.lit(p) for p in inner]))).filter(
            (F.col("_end") - F.col("_c") < F.col("_p")) & (F.col("_p") <= F.col("_end"))
        )
        # One row per position.
        for r in borders.collect():
            found[r["_p"]] = _nth(keyed, id_col, r["_b"], r["_p"] - (r["_end"] - r["_c"]), r["_c"], rows_per_bucket)
    out = []
    for p in positions:
        if p <= 0 or p >= rows:
            out.append(F.lit(p >= rows))
        else:
            h, last = found[p]["_h"], found[p][id_col]
            key = order_key(seed, id_col)
            out.append((key < h) | ((key == h) & (F.col(id_col) <= F.lit(last))))
    return out
