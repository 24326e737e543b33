"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks.

Each source's documents, shuffled by a seeded digest, form one stream of words that is cut into
blocks of ``block_words``.  Slot i of the schedule takes the golden-ratio point frac(i * phi); the
cumulative weights map it to a source, and the slot's rank within the source names the block it
takes, starting over after the last one.  A source stops at its target: slots beyond it are
dropped, and the few slots by which the discrepancy leaves a source short are added at the end,
so the words taken are the target rounded down.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from millrace.llm.common import fresh, materialise, small_or_shuffled, temporary, words_in

GOLDEN = 0.6180339887498949
BLOCK_WORDS = 1024
SEED = "mix|"
WEIGHTS = (3, 1, 2)


def rows_of(docs: DataFrame, weight_rows: int = 50_000) -> DataFrame:
    """doc_id, source, size and seeded order ``h`` of every document, in a written table.

    Null texts have size 0; null ids take part in the shuffle as an empty text.
    """
    return materialise(
        docs.select(
            "doc_id", "source", words_in("text").alias("size"),
            F.md5(F.concat(F.lit(SEED), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("h"),
            F.xxhash64("doc_id", "source", "text").alias("row_key"),
        ),
        "mix-rows",
    )


def targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: int = 2) -> DataFrame:
    """One row per source: its place ``ord``, size, weight and target in words.

    Sources come by code point, null last, and take the weights in turn.  A target stops at
    ``most`` times the source; what is left over is shared anew by weight until none is above,
    which the order of most * size / weight settles in one pass.  The table has a row per source.
    """
    everyone = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("ord") % len(weights)).cast("int") + 1)
    sources = (
        rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
        .withColumn("ord", F.row_number().over(everyone) - 1)
        .withColumn("weight", cycle)
        .withColumn("cap", F.col("source_size") * most)
    )
    filled = Window.orderBy(F.col("cap") / F.col("weight"), "ord")
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    level = (
        F.lit(share) * F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    ) / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    levelled = sources.withColumn("_level", level)
    last = F.max(F.when(F.col("cap") / F.col("weight") > F.col("_level"), F.col("_level"))).over(whole)
    return levelled.withColumn("_last", last).select(
        "source", "ord", "n", "source_size", "weight",
        F.when(F.col("_last").isNull(), F.col("cap").cast("double"))
        .otherwise(F.least(F.col("cap").cast("double"), F.col("_last") * F.col("weight"))).alias("target"),
    )


def streams(rows: DataFrame, sources: DataFrame, per_block: int = 50_000) -> DataFrame:
    """Every row with ``start``, the place of its first word in its source's shuffled stream.

    A source's rows are dealt into ranges of the uniform digest, whose sums give each range its
    first place, so no task holds a whole source.
    """
    known = rows.join(sources.select(F.col("source").alias("_s"), "ord", "n"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    digest = F.conv(F.substring("h", 1, 8), 16, 10).cast("long")
    ranges = F.ceil(F.col("n") / per_block)
    known = known.withColumn("_range", F.shiftright(digest * ranges, 32)).drop("n")
    earlier = Window.partitionBy("ord").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    firsts = known.groupBy("ord", "_range").agg(F.sum("size").alias("_size")).select(
        "ord", "_range", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_first")
    )
    inside = (
        Window.partitionBy("ord", "_range").orderBy("h", "doc_id", "size", "row_key").rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        known.join(firsts, ["ord", "_range"])
        .withColumn("start", F.col("_first") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .drop("_range", "_first")
    )


def schedule(sources: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Slots of the mix: place, ord, rank, block and the words that the slot takes from its block."""
    spark = sources.sparkSession
    whole = F.floor("target").cast("long")
    quota = sources.filter("source_size > 0").select(
        "ord", "source_size", whole.alias("wanted"), F.ceil(F.col("source_size") / block_words).alias("blocks")
    ).withColumn(
        "slots",
        F.expr("wanted div source_size") * F.col("blocks") + F.ceil((F.col("wanted") % F.col("source_size")) / block_words),
    )
    quota = materialise(quota, "mix-quota")
    n = quota.agg(F.sum("slots")).first()[0] or 0
    running = Window.orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    reach = quota.select("ord", "slots", F.sum("slots").over(running).alias("_upto"))
    # Cells of the unit interval turn the lookup of a point into an equi-join.
    cells = 4096
    reach = reach.select(
        "ord", ((F.col("_upto") - F.col("slots")) / F.lit(float(n or 1))).alias("lo"),
        F.when(F.col("_upto") == n, F.lit(2.0)).otherwise(F.col("_upto") / F.lit(float(n or 1))).alias("hi"),
    ).withColumn("cell", F.explode(F.sequence(F.floor(F.col("lo") * cells), F.least(F.lit(cells - 1), F.floor(F.col("hi") * cells)))))
    point = F.pmod((F.col("id") + 1) * F.lit(GOLDEN), F.lit(1.0))
    points = spark.range(n).withColumn("u", point).withColumn("cell", F.floor(F.col("u") * cells))
    drawn = points.join(reach, "cell").filter("u >= lo and u < hi").select(
        F.col("id").alias("place"), "ord", F.expr("id div 65536").alias("_chunk")
    )
    drawn = materialise(drawn, "mix-points")
    before = Window.partitionBy("ord").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    firsts = drawn.groupBy("ord", "_chunk").agg(F.count(F.lit(1)).alias("_n")).select(
        "ord", "_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first")
    )
    ranked = drawn.join(firsts, ["ord", "_chunk"]).select(
        "place", "ord", (F.col("_first") + F.row_number().over(Window.partitionBy("ord", "_chunk").orderBy("place")) - 1).alias("rank")
    )
    got = drawn.groupBy("ord").agg(F.count(F.lit(1)).alias("_got"))
    short = quota.join(got, "ord", "left").withColumn("_got", F.coalesce("_got", F.lit(0))).filter("_got < slots").select(
        (F.lit(n) + F.col("ord")).alias("place"), "ord", F.explode(F.sequence(F.col("_got"), F.col("slots") - 1)).alias("rank")
    )
    slots = ranked.unionByName(short).join(F.broadcast(quota) if quota.count() <= 10_000 else quota, "ord").filter("rank < slots")
    taken = F.col("wanted") - F.expr("rank div blocks") * F.col("source_size") - F.col("block") * block_words
    return slots.withColumn("block", F.col("rank") % F.col("blocks")).select(
        "place", "ord", "rank", "block", F.least(F.lit(block_words), taken).alias("words")
    )


def draw(stream: DataFrame, slots: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Rows of ``stream`` with the words taken and the number of times their first word was taken."""
    cut = stream.filter("size > 0").withColumn(
        "block",
        F.explode(F.sequence(F.expr(f"start div {block_words}"), F.expr(f"(start + size - 1) div {block_words}"))),
    )
    from_, to = F.greatest(F.col("start") - F.col("block") * block_words, F.lit(0)), F.least(
        F.col("start") + F.col("size") - F.col("block") * block_words, F.lit(block_words)
    )
    met = cut.join(slots.select("ord", "block", "words"), ["ord", "block"], "left")
    words = F.greatest(F.least(to, F.coalesce("words", F.lit(0))) - from_, F.lit(0))
    opened = (F.expr(f"start div {block_words}") == F.col("block")) & (F.coalesce("words", F.lit(0)) > from_)
    keys = [c for c in stream.columns]
    some = met.groupBy(*keys).agg(F.sum(words).alias("taken"), F.sum(opened.cast("int")).alias("copies"))
    none = stream.filter("size = 0").withColumns({"taken": F.lit(0).cast("long"), "copies": F.lit(1).cast("long")})
    return some.unionByName(none)


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Words taken of every document: doc_id, size, source_size, target, taken, copies, row_key.

    Reads doc_id, text and source; other columns are ignored.  Null and empty texts have size 0,
    take no words and stay once.  Repeated rows are rows of their own.  An empty table gives none.
    """
    with temporary(docs.sparkSession):
        rows = rows_of(docs)
        sources = materialise(targets(rows), "mix-sources")
        found = draw(streams(rows, sources), schedule(sources, block_words), block_words)
        whole = found.join(sources.select("ord", "source_size", "target"), "ord").select(
            "doc_id", "size", "source_size", "target", "taken", "copies", "row_key"
        )
        return materialise(whole, "mix", outlives=True)


def mixed_documents(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mix as whole documents: a document comes out once for each pass that takes its first word.

    Keeps all columns.  Identical rows share the larger of their counts.
    """
    key, copies, copy = (fresh(n, docs.columns) for n in ("row_key", "copies", "copy"))
    times = mix(docs, block_words).groupBy("row_key").agg(F.max("copies").alias(copies)).withColumnRenamed("row_key", key)
    times = small_or_shuffled(materialise(times, "mix-copies"))
    keyed = docs.withColumn(key, F.xxhash64("doc_id", "source", "text"))
    return (
        keyed.join(times, key)
        .filter(F.col(copies) > 0)
        .withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies).cast("int"))))
        .drop(key, copies, copy)
    )
