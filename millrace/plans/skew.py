"""Joins and groupings that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from millrace.plans.durable import materialise, written_bytes

# At most this many keys can each hold more than total/MAX_HOT_KEYS rows, so a table of
# hot keys has a proven size bound and may be broadcast.
MAX_HOT_KEYS = 1000

# Rows of hot keys are broadcast up to this many bytes as written; beyond, they are copied to SALTS tasks.
BROADCAST_BYTES = 16 << 20
SALTS = 64

# Below this many rows a single task copes with any key and nothing is split.
SMALL_TOTAL = 5_000_000


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on columns of the same names where null equals null, as in groupBy."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in on})
    cond = [left[k].eqNullSafe(renamed[f"_right_{k}"]) for k in on]
    return left.join(renamed, cond, how).drop(*[f"_right_{k}" for k in on])


def hot_key_join(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    weight: str,
    total: int,
    small_total: int = SMALL_TOTAL,
) -> DataFrame:
    """Inner join where ``small`` has one row per key and ``weight`` = rows of ``big`` with it.

    ``total`` is the number of rows of ``big`` or an upper bound.  Heavy keys (fewer than
    MAX_HOT_KEYS by pigeonhole) are joined by broadcast if their rows are small, so the rows of
    ``big`` never move, and by salted copies if they are not; the rest is an ordinary shuffle join
    in which no key is heavy.
    """
    on = list(on)
    if total <= small_total:
        return null_safe_join(big, small.drop(weight), on)
    small = materialise(small, "hot-split")
    cut = total / MAX_HOT_KEYS
    hot = materialise(small.filter(F.col(weight) > cut), "hot-keys")
    cold = small.filter(F.col(weight) <= cut)
    hot_rows = hot.drop(weight)
    if written_bytes(hot) <= BROADCAST_BYTES:
        hot_part = null_safe_join(big, F.broadcast(hot_rows), on)
    else:
        salted = hot_rows.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        dealt = big.withColumn("_salt", F.pmod(F.xxhash64(*big.columns), F.lit(SALTS)).cast("int"))
        hot_part = null_safe_join(dealt, salted, [*on, "_salt"]).drop("_salt")
    moved = null_safe_join(big, F.broadcast(hot.select(*on)), on, "left_anti")
    cold_part = null_safe_join(moved, cold.drop(weight), on)
    return hot_part.unionByName(cold_part)


def split_hot(
    df: DataFrame, keys: Sequence[str], limit: int
) -> tuple[DataFrame, DataFrame | None]:
    """Split rows into those of keys with at most ``limit`` rows and those of heavier keys.

    The second part is None when no key exceeds the limit.
    """
    keys = list(keys)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    total, top = counts.agg(F.sum("_rows"), F.max("_rows")).first()
    if top is None or top <= limit:
        return df, None
    hot = counts.filter(F.col("_rows") > limit).select(*keys)
    # Fewer than total / limit keys are hot; they travel whole only when that is a small number.
    hot = F.broadcast(hot) if total <= limit * MAX_HOT_KEYS else hot
    return null_safe_join(df, hot, keys, "left_anti"), null_safe_join(df, hot, keys, "left_semi")
