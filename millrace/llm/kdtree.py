"""K-d tree partitioning: recursive weighted-median splits along the widest metadata dimension.

A point is one group of rows (rows with equal ``key``); its coordinates must depend on the key
alone, so a group never spans two shards.  Only histograms of at most BINS values per tree node
are ordered, and only one row per node reaches the driver.  The tree is a CASE expression, so
rows get their shard in place, without a shuffle or a join.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.llm.common import materialise, temporary

BINS = 4096
# Ties within a bin are ordered by the top 24 bits of the key, 12 bits at a time.
KEY_BITS = 12
# Groups above 1/LARGE of an even share are placed one by one.
LARGE = 32


@dataclass
class Node:
    """A leaf has one shard; an inner node sends points with (bin, key bits) below the cut to ``low``."""

    leaves: list[int]
    dim: str = ""
    lo: float = 0.0
    width: float = 1.0
    cut_bin: int = 0
    cut_key: int = 0
    low: "Node | None" = None
    high: "Node | None" = None


@dataclass
class Tree:
    root: Node
    large: dict[int, int] = field(default_factory=dict)
    shards: int = 1

    def shard(self, dims: Mapping[str, Column], key: Column) -> Column:
        """Shard number of a row as an expression over its coordinates and key."""
        found = _walk(self.root, dims, key, lambda n: F.lit(n.leaves[0]))
        if self.large:
            placed = F.create_map(*[F.lit(x) for pair in self.large.items() for x in pair])
            found = F.coalesce(F.try_element_at(placed, key), found)
        return found.cast("int")


def _key_bits(key: Column) -> Column:
    return F.shiftrightunsigned(key, 64 - 2 * KEY_BITS)


def _bin(x: Column, lo: float, width: float) -> Column:
    # Points of other nodes may lie far outside, so the place is limited before it becomes a number.
    place = (x - F.lit(lo)) / F.lit(width) * BINS
    return F.floor(F.greatest(F.lit(0.0), F.least(F.lit(BINS - 1.0), place))).cast("int")


def _walk(node: Node, dims: Mapping[str, Column], key: Column, leaf) -> Column:
    if node.low is None:
        return leaf(node)
    at = _bin(dims[node.dim], node.lo, node.width)
    below = (at < node.cut_bin) | ((at == node.cut_bin) & (_key_bits(key) < node.cut_key))
    return F.when(below, _walk(node.low, dims, key, leaf)).otherwise(_walk(node.high, dims, key, leaf))


def _crossing(counts: DataFrame, value: str, goals: DataFrame) -> dict[int, tuple[int, float]]:
    """Per node the value where the running weight passes the node's goal, and the weight before it."""
    upto = Window.partitionBy("node").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    running = counts.withColumn("_upto", F.sum("w").over(upto)).join(F.broadcast(goals), "node")
    passed = running.filter(F.col("_upto") >= F.col("goal"))
    first = passed.groupBy("node").agg(F.min(F.struct(value, (F.col("_upto") - F.col("w")).alias("before"))).alias("m"))
    return {r["node"]: (int(r["m"][0]), float(r["m"][1])) for r in first.collect()}


def fit_tree(points: DataFrame, dims: list[str], shards: int | None = None, target_bytes: int | None = None) -> Tree:
    """Tree over ``points`` (key, w, one column per dimension; one row per group, written beforehand).

    Give the number of shards or the bytes a leaf should reach.  Groups above 1/LARGE of an even
    share (fewer than LARGE * shards of them) are placed first, heaviest to the lightest shard, and
    the splits fill up what room they leave.  An empty table gives a tree of empty shards.
    """
    with temporary(points.sparkSession):
        return _fit(points, dims, shards, target_bytes)


def _fit(points: DataFrame, dims: list[str], shards: int | None, target_bytes: int | None) -> Tree:
    total = float(points.agg(F.sum("w")).first()[0] or 0)
    if shards is None:
        shards = max(1, math.ceil(total / target_bytes))
    loads, large = [0.0] * shards, {}
    for r in points.filter(F.col("w") > total / shards / LARGE).orderBy(F.desc("w"), "key").collect():
        large[r["key"]] = lightest = loads.index(min(loads))
        loads[lightest] += r["w"]
    room = _room(loads, total - sum(loads))
    root = Node([k for k in range(shards) if room[k] > 0] or [0])
    if large:
        points = points.join(F.broadcast(points.sparkSession.createDataFrame([(k,) for k in large], "key long")), "key", "left_anti")
    columns = {d: F.col(d) for d in dims}
    ends = points.agg(*[f(d).alias(f"{f.__name__}_{d}") for d in dims for f in (F.min, F.max)]).first()
    spread = {d: max((ends[f"max_{d}"] or 0) - (ends[f"min_{d}"] or 0), 1e-12) for d in dims}

    open_nodes = [root] if len(root.leaves) > 1 and total else []
    placed = points.withColumn("node", F.lit(0))
    while open_nodes:
        facts = {
            r["node"]: r
            for r in placed.groupBy("node").agg(
                F.sum("w").alias("w"), *[f(d).alias(f"{f.__name__}_{d}") for d in dims for f in (F.min, F.max)]
            ).collect()
        }
        for k, n in enumerate(open_nodes):
            n.dim = dims[0]
            if k in facts:
                r = facts[k]
                n.dim = max(dims, key=lambda d: (r[f"max_{d}"] - r[f"min_{d}"]) / spread[d])
                n.lo, n.width = float(r[f"min_{n.dim}"]), max(float(r[f"max_{n.dim}"] - r[f"min_{n.dim}"]), 1e-12)
        if facts:
            _cut(placed, open_nodes, {k: float(r["w"]) * _share(open_nodes[k], room) for k, r in facts.items()})
        following, sides = [], {}
        for k, n in enumerate(open_nodes):
            n.low, n.high = Node(n.leaves[: len(n.leaves) // 2]), Node(n.leaves[len(n.leaves) // 2 :])
            for child in (n.low, n.high):
                sides[id(child)] = len(following) if len(child.leaves) > 1 else -1
                following += [child] if len(child.leaves) > 1 else []
        if following:
            # One level a step keeps the expressions small.
            step = F.lit(-1)
            for k, n in enumerate(open_nodes):
                step = F.when(F.col("node") == k, _walk(n, columns, F.col("key"), lambda c: F.lit(sides[id(c)]))).otherwise(step)
            placed = materialise(placed.withColumn("node", step).filter("node >= 0"), "shard-level")
        open_nodes = following
    return Tree(root, large, shards)


def _room(loads: list[float], rest: float) -> list[float]:
    """What each shard still takes so that ``rest`` levels the loads as far as it can."""
    order = sorted(range(len(loads)), key=loads.__getitem__)
    level = 0.0
    for n in range(1, len(order) + 1):
        level = (rest + sum(loads[k] for k in order[:n])) / n
        if n == len(order) or level <= loads[order[n]]:
            break
    return [max(0.0, level - x) for x in loads]


def _share(node: Node, room: list[float]) -> float:
    """The part of a node's weight that its low side takes."""
    return sum(room[k] for k in node.leaves[: len(node.leaves) // 2]) / sum(room[k] for k in node.leaves)


def _cut(placed: DataFrame, nodes: list[Node], goals: dict[int, float]) -> None:
    """Set the cuts of ``nodes``: the weighted quantile by bin, then by key bits within the bin."""
    spark = placed.sparkSession
    goal_rows = lambda: spark.createDataFrame(list(goals.items()), "node int, goal double")

    def at(column: str, found: dict[int, int]) -> Column:
        return reduce(lambda some, k: some | ((F.col("node") == k) & (F.col(column) == found[k])), found, F.lit(False))

    picked = reduce(
        lambda rest, k: F.when(F.col("node") == k, _bin(F.col(nodes[k].dim), nodes[k].lo, nodes[k].width)).otherwise(rest),
        goals, F.lit(0),
    )
    binned = placed.select("node", "w", "key", picked.alias("bin"))
    cuts = _crossing(binned.groupBy("node", "bin").agg(F.sum("w").alias("w")), "bin", goal_rows())
    tied = binned.filter(at("bin", {k: v for k, (v, _) in cuts.items()})).select("node", "w", _key_bits(F.col("key")).alias("bits"))
    tied = tied.withColumn("part", F.shiftrightunsigned("bits", KEY_BITS))
    for k, (value, before) in cuts.items():
        nodes[k].cut_bin, goals[k] = value, goals[k] - before
    tops = _crossing(tied.groupBy("node", "part").agg(F.sum("w").alias("w")), "part", goal_rows())
    for k, (_, before) in tops.items():
        goals[k] -= before
    within = tied.filter(at("part", {k: v for k, (v, _) in tops.items()})).groupBy("node", "bits").agg(F.sum("w").alias("w"))
    lows = _crossing(within, "bits", goal_rows())
    group = {
        r["node"]: float(r["w"])
        for r in within.filter(at("bits", {k: v for k, (v, _) in lows.items()})).collect()
    }
    for k, (bits, before) in lows.items():
        # The crossing group goes to the side that leaves the smaller error.
        nodes[k].cut_key = bits + (1 if 2 * (goals[k] - before) > group[k] else 0)


TEXT_DIMS = ["log_bytes", "bytes_per_char", "chars_per_gap"]


def text_point(text: str) -> dict[str, Column]:
    """Key, weight (UTF-8 bytes plus 1) and coordinates of a document, all functions of its text alone.

    Equal texts share a point; null counts as an empty text.
    """
    known = F.coalesce(F.col(text), F.lit(""))
    size = F.octet_length(known).cast("long")
    chars = F.char_length(known)
    gaps = chars - F.char_length(F.replace(known, F.lit(" "), F.lit("")))
    return {
        "key": F.xxhash64(known),
        "w": size + 1,
        "log_bytes": F.log2(size + F.lit(1.0)),
        "bytes_per_char": size / F.greatest(chars, F.lit(1)),
        "chars_per_gap": F.log2(F.lit(1.0) + chars / (gaps + 1)),
    }


def groups(points: DataFrame) -> DataFrame:
    """One point per key; copies are summed on the map side, so a hot group is one row per task."""
    return points.groupBy("key").agg(F.sum("w").alias("w"), *[F.first(d).alias(d) for d in TEXT_DIMS])
