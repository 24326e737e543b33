"""Near-duplicate removal by a positional prefix filter, with an exact decision and no pair missed.

Rule: in key order, a row is dropped if the Jaccard similarity of its shingle set and that of an
earlier kept row reaches the threshold.

All shingles have one order, frequent ones last, and a row is indexed by the first
n - ceil(t * n) + 1 of its set.  Similar sets share one of these, so rows meet in the buckets of
the index.  Rows with equal sets are one row.  Each round takes the lowest undecided keys of every
bucket as its leaders (one in the first round, a few later) and compares every row with the
leaders before it, never with all members, so a bucket of variants costs one comparison a row.
Sizes and positions rule most comparisons out, and parities of a set, some bits an element, nearly all
of the others: sets differ in at least as many elements as their parities do in bits.  Whole sets are
built for the rows of the remaining pairs only.  A row is kept once all undecided rows before it in
its buckets are known to differ; a row similar to a kept one is dropped.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from millrace.functions.exchange import buckets_answered, buckets_told, memberships, parts_for, prefix_batches
from millrace.functions.kernels import prefix_of, repeated_shingles_of, shingles_of
from millrace.plans.durable import materialise
from millrace.plans.skew import SMALL_TOTAL, hot_key_join

SHINGLE_WORDS = 5
# Leaders per bucket in the second round; the number doubles each round up to the maximum.
LEADERS = 32
MAX_LEADERS = 64
# Shingles that some batch holds several times, and the corpus at least so often, are ordered by
# their count; this many of them travel to the tasks (16 bytes each).  Others count as rare.  The
# order decides how large buckets are, never which rows are dropped.
FREQUENT_ROWS = 16
FREQUENT_SHINGLES = 500_000
# Pairs of keys are broadcast up to this many (some 32 MB).
BROADCAST_PAIRS = 1_000_000


def dedup_near(
    df: DataFrame, key: str, text: str, threshold: float = 0.85, small_total: int = SMALL_TOTAL, frequent_rows: int = FREQUENT_ROWS
) -> DataFrame:
    """Rows of ``df`` that are not near-duplicates of an earlier kept row; >= 1.0 disables."""
    if threshold >= 1.0:
        return df
    dropped = near_duplicates(df, key, text, threshold, small_total, frequent_rows)
    return df.join(dropped, key, "left_anti")


def frequent_shingles(df: DataFrame, text: str, least: int = FREQUENT_ROWS, most: int = FREQUENT_SHINGLES) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles in rising order, and how many rows were seen to hold each."""
    repeated = df.select(F.col(text).alias("text")).mapInArrow(repeated_shingles_of(SHINGLE_WORDS), "shingle long, rows long")
    counts = repeated.groupBy("shingle").agg(F.sum("rows").alias("rows")).filter(F.col("rows") >= least)
    found = counts.orderBy(F.desc("rows"), "shingle").limit(most).toArrow()
    shingle, rows = (np.asarray(found[c]) for c in ("shingle", "rows"))
    order = np.argsort(shingle)
    return shingle[order], rows[order]


def near_duplicates(
    df: DataFrame, key: str, text: str, threshold: float = 0.85, small_total: int = SMALL_TOTAL, frequent_rows: int = FREQUENT_ROWS
) -> DataFrame:
    """The keys that ``dedup_near`` drops.  Keys must be unique; rows without words are never dropped.

    ``df`` is read twice, and once more in each of a few rounds for rows that may be similar to
    another: write it to a table first if it is expensive to compute.
    """
    frequent = df.sparkSession.sparkContext.broadcast(frequent_shingles(df, text, frequent_rows))
    read = df.select(F.col(key), F.xxhash64(key).alias("mark"), F.col(text).alias("text"))
    kind = read.schema[key]
    schema = T.StructType([kind, *T.StructType.fromDDL("mark long, n int, hi long, lo long, prefix array<long>, parities array<long>").fields])
    # Filtered once written: a filter below the projection would hash every text again.
    rows = materialise(read.mapInArrow(prefix_of(SHINGLE_WORDS, threshold, frequent), schema), "near-rows").filter("n > 0")
    # Of rows with equal sets the lowest key stands for all; the others are similar to whatever it is similar to.
    firsts = materialise(rows.groupBy("hi", "lo").agg(F.min(key).alias(key)).select(key), "near-firsts")
    dropped = materialise(rows.select(key).join(firsts, key, "left_anti"), "near-equal")
    # The keys dropped already are few in most corpora, so that the prefixes need not move.
    members = _members(rows.filter(F.col(key).isNotNull()).join(dropped, key, "left_anti"), key)
    members = materialise(members, "near-members")
    parities = rows.select(key, "n", "parities")
    texts = df.select(key, F.col(text).alias("text"))
    rounds = 0
    # Counting a written table reads file footers only.
    while total := members.count():
        rounds += 1
        leaders = 1 if rounds == 1 else min(MAX_LEADERS, LEADERS * 2 ** (rounds - 2))
        led = materialise(_with_leaders(members, key, leaders, total, threshold, small_total), "near-led")
        complete = led.groupBy(key).agg(F.bool_and("complete").alias("_all")).filter("_all").select(key)
        pairs = led.select(key, F.explode("before").alias("leader")).distinct()
        if rounds == 1:
            # Only a row that leads all its buckets is sure to be kept yet.
            pairs = pairs.join(complete.withColumnRenamed(key, "leader"), "leader", "left_semi")
        pairs = materialise(pairs, "near-pairs")
        likely = materialise(_maybe_similar(pairs, pairs.count(), parities, key, threshold, small_total), "near-likely")
        edges = materialise(_similar(likely, likely.count(), texts, key, threshold, small_total), "near-edges")
        keepers = complete.join(edges.select(key), key, "left_anti")
        gone = edges.join(keepers.withColumnRenamed(key, "leader"), "leader", "left_semi").select(key).distinct()
        gone = materialise(gone, "near-dropped")
        dropped = dropped.unionByName(gone)
        decided = keepers.unionByName(gone)
        members = materialise(_shared(members.join(decided, key, "left_anti"), total, small_total), "near-members")
    return dropped


def _members(rows: DataFrame, key: str) -> DataFrame:
    """(key, n, place, bucket) of the shingles in the prefixes of at least two rows.

    Batches of rows tell parts of the hash range their shingles, each with the sum of marks of the
    rows that hold it; parts answer with the sums over all rows.  Shingles of equal sums are in the
    same rows: their buckets lead to the same pairs, and of these buckets only the first remains,
    which comes first in the prefix of every row.
    """
    kind = rows.schema[key].dataType
    row = T.ArrayType(T.StructType([T.StructField("key", kind), T.StructField("n", T.IntegerType())]))
    schema = T.StructType([T.StructField("batch", T.LongType()), T.StructField("rows", row), *T.StructType.fromDDL("marks binary, sizes binary, prefix binary").fields])
    batches = materialise(rows.select(key, "mark", "n", "prefix").mapInArrow(prefix_batches, schema), "near-batches")
    places = batches.agg(F.sum(F.octet_length("prefix"))).first()[0] or 0
    told = batches.drop("rows").mapInArrow(buckets_told(parts_for(places // 8)), "part int, batch long, size long, x binary, times binary, marks binary")
    answers = told.groupBy("part").applyInArrow(buckets_answered, "part int, batch long, size long, marks binary")
    found = T.StructType([T.StructField("key", kind), *T.StructType.fromDDL("n int, place int, bucket long").fields])
    return batches.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(memberships, found).withColumnRenamed("key", key)


def _shared(members: DataFrame, total: int, small_total: int) -> DataFrame:
    """Memberships in buckets of at least two rows."""
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("_size")).filter(F.col("_size") > 1)
    return hot_key_join(members, sizes, ["bucket"], "_size", total, small_total).select(*members.columns)


def _may_reach(n: Column, place: Column, other_n: Column, other_place: Column, threshold: float) -> Column:
    """Whether sets of these sizes, whose first common shingle has these places, can be similar enough."""
    rest = F.least(n - place, other_n - other_place)
    needed = F.ceil(threshold / (1 + threshold) * (n + other_n) - 1e-9)
    return (rest >= needed) & (F.least(n, other_n) >= threshold * F.greatest(n, other_n) - 1e-9)


def _with_leaders(members: DataFrame, key: str, leaders: int, total: int, threshold: float, small_total: int) -> DataFrame:
    """Memberships with the leaders before the row that may be similar, and whether all rows before it are leaders.

    A pair meets in the bucket of its first common shingle too, where sizes and places let a
    similar pair pass.
    """
    # Each task passes on only its own lowest keys per bucket.
    first = Window.partitionBy("bucket").orderBy(key)
    lowest = members.withColumn("_r", F.row_number().over(first)).filter(F.col("_r") <= leaders)
    head = F.struct(F.col(key).alias("k"), F.col("n").alias("n"), F.col("place").alias("place"))
    heads = lowest.groupBy("bucket").agg(F.sort_array(F.collect_list(head)).alias("_heads"))
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("_size"))
    joined = hot_key_join(members, heads.join(sizes, "bucket"), ["bucket"], "_size", total, small_total)
    near = F.filter("_heads", lambda h: (h["k"] < F.col(key)) & _may_reach(F.col("n"), F.col("place"), h["n"], h["place"], threshold))
    return joined.select(
        key,
        F.transform(near, lambda h: h["k"]).alias("before"),
        (F.col(key) <= F.element_at("_heads", -1)["k"]).alias("complete"),
    )


def _both(pairs: DataFrame, total: int, rows: DataFrame, key: str, small_total: int) -> DataFrame:
    """The pairs with the columns of both rows, those of the leader as ``leader_`` columns."""
    # Rows stay where they are while the pairs are few.
    pairs = F.broadcast(pairs) if total <= BROADCAST_PAIRS else pairs
    fans = pairs.groupBy("leader").agg(F.count(F.lit(1)).alias("_fan"))
    fans = F.broadcast(fans) if total <= BROADCAST_PAIRS else fans
    names = {c: f"leader_{c}" for c in rows.columns if c != key} | {key: "leader"}
    return hot_key_join(pairs.join(rows, key), fans.join(rows.withColumnsRenamed(names), "leader"), ["leader"], "_fan", total, small_total)


def _reaches(common: Column, threshold: float) -> Column:
    return common >= F.lit(threshold) * (F.col("n") + F.col("leader_n") - common)


def _differing(short: Column, long: Column) -> Column:
    """Bits in which parities differ, the longer ones folded onto the shorter."""
    words = F.size(short)
    parts = F.sequence(F.lit(0), (F.size(long) / words).cast("int") - 1)
    folded = F.aggregate(parts, short, lambda z, k: F.zip_with(z, F.slice(long, k * words + 1, words), lambda x, y: x.bitwiseXOR(y)))
    return F.aggregate(folded, F.lit(0), lambda z, word: z + F.bit_count(word))


def _maybe_similar(
    pairs: DataFrame, total: int, parities: DataFrame, key: str, threshold: float, small_total: int
) -> DataFrame:
    """The pairs whose sets may be similar enough: each bit that differs is an element of one set only."""
    both = _both(pairs, total, parities, key, small_total)
    mine, other = F.col("parities"), F.col("leader_parities")
    bits = F.when(F.size(mine) <= F.size(other), _differing(mine, other)).otherwise(_differing(other, mine))
    most = F.floor((F.col("n") + F.col("leader_n") - bits) / 2)
    return both.filter(_reaches(most, threshold)).select(key, "leader").distinct()


def _similar(
    pairs: DataFrame, total: int, texts: DataFrame, key: str, threshold: float, small_total: int
) -> DataFrame:
    """The pairs whose exact Jaccard similarity reaches the threshold."""
    if not total:
        return pairs
    needed = pairs.select(key).union(pairs.select("leader")).distinct()
    needed = F.broadcast(needed) if total <= BROADCAST_PAIRS else needed
    schema = T.StructType([texts.schema[key], *T.StructType.fromDDL("shingles array<long>").fields])
    sets = materialise(texts.join(needed, key, "left_semi").mapInArrow(shingles_of(SHINGLE_WORDS), schema), "near-sets")
    both = _both(pairs, total, sets.select("*", F.size("shingles").alias("n")), key, small_total)
    return both.filter(_reaches(F.size(F.array_intersect("shingles", "leader_shingles")), threshold)).select(key, "leader")
