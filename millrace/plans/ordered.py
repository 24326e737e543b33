"""Ordered computations (ranks, running values, sliding windows) without one-task windows.

Rows are cut into blocks along the order column at quantiles of the whole table, so a block
holds about ``rows_per_block`` rows however the keys are distributed.  Work inside a block is
an ordinary window; what crosses block borders (row counts, running values) is one small row
per key and block.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.plans.durable import materialise
from millrace.plans.skew import null_safe_join, split_hot

ROWS_PER_BLOCK = 1_000_000
MAX_BLOCKS = 4000

# A key up to this size is handled by one task.
KEY_ROWS = 2_000_000


def with_block(
    df: DataFrame, order: str, rows_per_block: int = ROWS_PER_BLOCK, out: str = "_blk"
) -> DataFrame | None:
    """Add a block number that never decreases as the numeric column ``order`` grows.

    None if the whole table fits one block.
    """
    rows = df.count()
    n = min(MAX_BLOCKS, -(-rows // rows_per_block))
    if n <= 1:
        return None
    marks = [i / n for i in range(1, n)]
    value = F.col(order).cast("double")
    found = df.agg(F.percentile_approx(value, marks, 10 * n)).first()[0] or []
    bounds = sorted(set(found))
    if not bounds:
        return None
    cut = Bucketizer(
        splits=[float("-inf"), *bounds, float("inf")],
        inputCol="_order_value",
        outputCol="_block_value",
        handleInvalid="keep",
    )
    return (
        cut.transform(df.withColumn("_order_value", value))
        .withColumn(out, F.col("_block_value").cast("int"))
        .drop("_order_value", "_block_value")
    )


def needs_blocks(df: DataFrame, keys: Sequence[str], key_rows: int = KEY_ROWS) -> bool:
    """Whether some key has more rows than one task should order."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return (counts.agg(F.max("_rows")).first()[0] or 0) > key_rows


def with_running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    running: dict[str, tuple[str, str]],
    rows_per_block: int = ROWS_PER_BLOCK,
    blocks: bool = True,
) -> DataFrame:
    """Add running values over the rows strictly before the current one.

    ``running`` maps an output name to (function, column); the function is one of sum, min, max.
    A sum starts at 0, min and max start at null.  The first order column must be numeric.
    Without ``blocks`` an ordinary window per key is used: right when no key is heavy.
    """
    keys = list(keys)
    blocked = with_block(df, order[0], rows_per_block) if blocks else None
    if blocked is None:
        whole = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        plain = {
            out: F.coalesce(F.sum(col).over(whole), F.lit(0)) if fn == "sum" else getattr(F, fn)(col).over(whole)
            for out, (fn, col) in running.items()
        }
        return df.withColumns(plain)
    here = Window.partitionBy(*keys, "_blk").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inner = blocked.select(
        "*",
        *[getattr(F, fn)(col).over(here).alias(f"_in_{out}") for out, (fn, col) in running.items()],
    )
    totals = blocked.groupBy(*keys, "_blk").agg(
        *[getattr(F, fn)(col).alias(f"_tot_{out}") for out, (fn, col) in running.items()]
    )
    # One row per key and block: at most MAX_BLOCKS rows per key.
    before = Window.partitionBy(*keys).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        *keys,
        "_blk",
        *[getattr(F, fn)(f"_tot_{out}").over(before).alias(f"_pre_{out}") for out, (fn, _) in running.items()],
    )
    joined = null_safe_join(inner, carried, [*keys, "_blk"])
    merged = {out: _merge(fn, F.col(f"_in_{out}"), F.col(f"_pre_{out}")) for out, (fn, _) in running.items()}
    return joined.select(*df.columns, *[c.alias(out) for out, c in merged.items()])


def _merge(fn: str, inner: Column, carried: Column) -> Column:
    if fn == "sum":
        return F.coalesce(inner, F.lit(0)) + F.coalesce(carried, F.lit(0))
    return F.least(inner, carried) if fn == "min" else F.greatest(inner, carried)


def with_rank(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    rows_per_block: int = ROWS_PER_BLOCK,
    out: str = "_rank",
    blocks: bool = True,
) -> DataFrame:
    """Row number within each key (from 1); ``order`` must be unique within a key."""
    if not blocks:
        return df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("bigint"))
    one = df.withColumn("_one", F.lit(1).cast("bigint"))
    ranked = with_running(one, keys, order, {out: ("sum", "_one")}, rows_per_block)
    return ranked.withColumn(out, F.col(out) + 1).drop("_one")


def with_previous_rows(
    df: DataFrame, rank: str, reach: int, rows_per_block: int = ROWS_PER_BLOCK, blocks: bool = True
) -> DataFrame:
    """Re-block ranked rows so that every row's ``reach`` predecessors share its block.

    The last ``reach`` rows of a block are repeated in the next one with ``_own`` = false;
    use a window over keys + ``_blk`` and keep the rows with ``_own``.
    """
    if not blocks:
        return df.withColumns({"_blk": F.lit(0), "_own": F.lit(True)})
    size = max(rows_per_block, reach)
    home = F.floor((F.col(rank) - 1) / size)
    offset = (F.col(rank) - 1) % size
    copies = F.when(
        offset >= size - reach,
        F.array(
            F.struct(home.alias("_blk"), F.lit(True).alias("_own")),
            F.struct((home + 1).alias("_blk"), F.lit(False).alias("_own")),
        ),
    ).otherwise(F.array(F.struct(home.alias("_blk"), F.lit(True).alias("_own"))))
    return df.withColumn("_copy", F.explode(copies)).select(*df.columns, "_copy._blk", "_copy._own")


def order_statistics(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    percents: dict[str, float],
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """The value at index min(floor(n * percent / 100), n - 1) of each key's sorted values, exactly."""

    def index(percent: float) -> Callable[[Column], Column]:
        return lambda n: F.least(F.floor(n * F.lit(percent) / F.lit(100.0)), n - 1)

    return _values_by_index(df, list(keys), value, {name: index(p) for name, p in percents.items()}, rows_per_block)


def values_at(df: DataFrame, value: str, indexes: dict[str, int], rows_per_block: int = ROWS_PER_BLOCK) -> dict:
    """The values at zero-based indexes of the sorted column."""

    def index(i: int) -> Callable[[Column], Column]:
        return lambda n: F.lit(i).cast("bigint")

    at = {name: index(i) for name, i in indexes.items()}
    return _values_by_index(df, [], value, at, rows_per_block).first().asDict()


def _values_by_index(
    df: DataFrame, keys: list[str], value: str, at: dict[str, Callable[[Column], Column]], rows_per_block: int
) -> DataFrame:
    """Block counts tell in which block each wanted index lies; only those blocks are ranked."""
    counted = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_cnt"))
    blocked = with_block(counted, value, rows_per_block)
    if blocked is None:
        return _values_in_one_block(counted, keys, value, at)
    per_block = blocked.groupBy(*keys, "_blk").agg(F.sum("_cnt").alias("_in_block"))
    all_blocks = Window.partitionBy(*keys)
    upto = all_blocks.orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    spans = per_block.select(
        *keys,
        "_blk",
        "_in_block",
        F.coalesce(F.sum("_in_block").over(upto), F.lit(0)).alias("_before"),
        F.sum("_in_block").over(all_blocks).alias("_n"),
    )
    wanted = F.array(*[F.struct(F.lit(name).alias("stat"), index(F.col("_n")).alias("idx")) for name, index in at.items()])
    targets = (
        spans.withColumn("_w", F.explode(wanted))
        .filter((F.col("_w.idx") >= F.col("_before")) & (F.col("_w.idx") < F.col("_before") + F.col("_in_block")))
        .groupBy(*keys, "_blk", "_before")
        .agg(F.collect_list("_w").alias("_wanted"))
    )
    inside = Window.partitionBy(*keys, "_blk").orderBy(value)
    ranked = (
        null_safe_join(blocked, targets, [*keys, "_blk"])
        .withColumn("_hi", F.col("_before") + F.sum("_cnt").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_lo", F.col("_hi") - F.col("_cnt"))
    )
    return _hits(ranked, keys, value, at)


def _values_in_one_block(
    counted: DataFrame, keys: list[str], value: str, at: dict[str, Callable[[Column], Column]]
) -> DataFrame:
    whole = Window.partitionBy(*keys)
    upto = whole.orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    ranked = counted.withColumns({"_hi": F.sum("_cnt").over(upto), "_n": F.sum("_cnt").over(whole)})
    wanted = F.array(*[F.struct(F.lit(name).alias("stat"), index(F.col("_n")).alias("idx")) for name, index in at.items()])
    return _hits(ranked.withColumns({"_lo": F.col("_hi") - F.col("_cnt"), "_wanted": wanted}), keys, value, at)


def _hits(ranked: DataFrame, keys: list[str], value: str, at: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """Values whose rank span [_lo, _hi) holds a wanted index, one column per statistic."""
    inside = F.filter("_wanted", lambda w: (w["idx"] >= F.col("_lo")) & (w["idx"] < F.col("_hi")))
    hits = ranked.select(*keys, value, F.explode(inside).alias("_w"))
    return hits.groupBy(*keys).agg(
        *[F.max(F.when(F.col("_w.stat") == name, F.col(value))).alias(name) for name in at]
    )


def greedy_spacing(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    gap: float,
    strict: bool = False,
    key_rows: int = KEY_ROWS,
    rows_per_block: int = ROWS_PER_BLOCK,
    heavy_keys: bool = True,
) -> DataFrame:
    """Per key keep the lowest position, then each next one at least ``gap`` after the last kept.

    With ``strict`` the distance must exceed ``gap``.  Input and output are (keys, position)
    with distinct positions.  Keys up to ``key_rows`` rows are walked by one task each; heavier
    keys are solved by pointer doubling, whose joins are on unique (key, rank) pairs.  Pass
    ``heavy_keys=False`` if it is known that there are none.
    """
    keys = list(keys)
    points = df.select(*keys, position).distinct()
    cold, hot = split_hot(points, keys, key_rows) if heavy_keys else (points, None)
    kept = cold.groupBy(*keys).applyInPandas(_spacing_walk(position, gap, strict), points.schema)
    if hot is None:
        return kept
    return kept.unionByName(_spacing_by_doubling(hot, keys, position, gap, strict, rows_per_block))


def _spacing_walk(position: str, gap: float, strict: bool):
    def walk(pdf):
        import numpy as np

        values = np.sort(pdf[position].to_numpy())
        side = "right" if strict else "left"
        at, chosen = 0, []
        while at < len(values):
            chosen.append(values[at])
            at = int(np.searchsorted(values, values[at] + gap, side=side))
        kept = pdf.iloc[: len(chosen)].copy()
        kept[position] = np.array(chosen, dtype=values.dtype)
        return kept

    return walk


def _spacing_by_doubling(
    points: DataFrame, keys: list[str], position: str, gap: float, strict: bool, rows_per_block: int
) -> DataFrame:
    kind = points.schema[position].dataType
    # A probe at position + gap counts the points before it: that count + 1 is the next rank.
    probe_side = 1 if strict else -1
    marks = points.select(
        *keys, F.col(position).alias("_at"), F.col(position).alias("_src"), F.lit(0).alias("_side"),
        F.lit(1).cast("bigint").alias("_pt"),
    ).unionByName(
        points.select(
            *keys, (F.col(position) + F.lit(gap)).cast(kind).alias("_at"), F.col(position).alias("_src"),
            F.lit(probe_side).alias("_side"), F.lit(0).cast("bigint").alias("_pt"),
        )
    )
    counted = with_running(marks, keys, ["_at", "_side", "_src"], {"_seen": ("sum", "_pt")}, rows_per_block)
    links = materialise(
        counted.groupBy(*keys, F.col("_src").alias(position)).agg(
            F.max(F.when(F.col("_pt") == 1, F.col("_seen") + 1)).alias("_rank"),
            F.max(F.when(F.col("_pt") == 0, F.col("_seen") + 1)).alias("_next"),
        ),
        "spacing-links",
    )
    ranks = links.select(*keys, "_rank")
    jumps = [materialise(
        links.select(*keys, "_rank", "_next").join(ranks.withColumnRenamed("_rank", "_next"), [*keys, "_next"])
        .select(*keys, "_rank", "_next"),
        "spacing-jump",
    )]
    while not jumps[-1].isEmpty():
        last = jumps[-1]
        onward = last.select(*keys, F.col("_rank").alias("_next"), F.col("_next").alias("_far"))
        jumps.append(materialise(
            last.join(onward, [*keys, "_next"]).select(*keys, "_rank", F.col("_far").alias("_next")),
            "spacing-jump",
        ))
    reached = ranks.filter(F.col("_rank") == 1)
    for jump in reversed(jumps[:-1]):
        stepped = reached.join(jump, [*keys, "_rank"]).select(*keys, F.col("_next").alias("_rank"))
        reached = materialise(reached.unionByName(stepped), "spacing-reached")
    return links.join(reached, [*keys, "_rank"]).select(*keys, position)
