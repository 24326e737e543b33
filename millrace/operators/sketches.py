"""Mergeable sketches: quantiles and distinct n-grams that are stored by day or hour and united later.

A sketch table has one row of a few kilobytes for each key, however many rows stand behind it.
Tables of new days are appended; any span of days and any coarser key is answered from the
sketches alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from millrace.functions.exchange import counted_grams

# Items a quantile sketch keeps on its first level: ranks are right within about 0.25% of the rows
# (2.3 / items ** 0.9, with 99% confidence), and exact up to so many rows.
QUANTILE_ITEMS = 2000
# 2 ** LOG_CELLS cells of a distinct sketch: a relative standard error of 0.83 / sqrt(cells), 0.65%.
LOG_CELLS = 14


def quantile_sketches(df: DataFrame, keys: Sequence[str], value: str, items: int = QUANTILE_ITEMS) -> DataFrame:
    """(keys, n, sketch) of the non-null values; tasks sketch their own rows before the shuffle."""
    held = F.col(value).cast("double")
    sketched = df.filter(held.isNotNull() & ~F.isnan(held)).groupBy(*keys)
    return sketched.agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double(held, items).alias("sketch"))


def quantiles(sketches: DataFrame, keys: Sequence[str], wanted: dict[str, float], items: int = QUANTILE_ITEMS) -> DataFrame:
    """(keys, n, one column for each wanted name) over all sketches of a key: {"p99": 0.99}."""
    merged = sketches.groupBy(*keys).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", items).alias("_s"))
    return merged.select(*keys, "n", *[F.kll_sketch_get_quantile_double("_s", F.lit(float(q))).alias(name) for name, q in wanted.items()])


def ngram_sketches(df: DataFrame, text: str, n: int, keys: Sequence[str], log_cells: int = LOG_CELLS) -> DataFrame:
    """(keys, total_ngrams, sketch) of the n-grams of the lower-cased texts; keys whose texts have none are left out."""
    # Words hold no separator, so joined words are the n-gram; a slice of texts passes on each once.
    kept = df.select(*keys, F.lower(F.col(text)).alias("_text"))
    schema = T.StructType([*df.select(*keys).schema.fields, *T.StructType.fromDDL("_g string, _c long").fields])
    each = kept.mapInArrow(counted_grams(n), schema)
    return each.groupBy(*keys).agg(F.sum("_c").alias("total_ngrams"), F.hll_sketch_agg("_g", log_cells).alias("sketch"))


def approx_distinct_n(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """distinct_ngrams (estimated), total_ngrams, distinct_n and repetition_rate over all sketches of a group."""
    merged = sketches.groupBy(*by).agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_ngrams"), F.sum("total_ngrams").alias("total_ngrams")
    )
    share = F.least(F.lit(1.0), F.col("distinct_ngrams") / F.col("total_ngrams"))
    found = merged.withColumns({"distinct_n": F.when(F.col("total_ngrams") > 0, share).otherwise(0.0)})
    return found.withColumn("repetition_rate", F.when(F.col("total_ngrams") > 0, 1 - F.col("distinct_n")).otherwise(0.0))
