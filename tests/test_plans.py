"""Balanced plans give the same results as plain windows and joins."""

import random

import numpy as np
import pytest
from pyspark.sql import Window, functions as F

from millrace.plans.hashed import within_first
from millrace.plans.ordered import greedy_spacing, needs_blocks, order_statistics, values_at, with_previous_rows, with_rank, with_running
from millrace.plans.skew import hot_key_join, split_hot


@pytest.fixture(scope="module")
def series(spark):
    rng = random.Random(3)
    # One key holds most rows.
    rows = [("hot" if rng.random() < 0.7 else f"k{rng.randint(0, 5)}", i, rng.random()) for i in range(600)]
    return spark.createDataFrame(rows, "k string, step bigint, v double").cache()


def collect(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_rank_in_blocks(series):
    blocked = with_rank(series, ["k"], ["step"], rows_per_block=37)
    plain = with_rank(series, ["k"], ["step"], blocks=False)
    assert collect(blocked, "k", "step", "_rank") == collect(plain, "k", "step", "_rank")


def test_running_values_in_blocks(series):
    wanted = {"lo": ("min", "v"), "hi": ("max", "v"), "n": ("sum", "step")}
    blocked = with_running(series, ["k"], ["step"], wanted, rows_per_block=41)
    plain = with_running(series, ["k"], ["step"], wanted, blocks=False)
    assert collect(blocked, "k", "step", "lo", "hi", "n") == collect(plain, "k", "step", "lo", "hi", "n")


def test_previous_rows_halo(series):
    ranked = with_rank(series, ["k"], ["step"], rows_per_block=50)
    halo = with_previous_rows(ranked, "_rank", 7, rows_per_block=20)
    before = Window.partitionBy("k", "_blk").orderBy("_rank").rowsBetween(-7, -1)
    got = halo.withColumn("m", F.round(F.avg("v").over(before), 12)).filter("_own")
    plain = Window.partitionBy("k").orderBy("step").rowsBetween(-7, -1)
    want = series.withColumn("m", F.round(F.avg("v").over(plain), 12))
    assert collect(got, "k", "step", "m") == collect(want, "k", "step", "m")


def test_needs_blocks(series):
    assert needs_blocks(series, ["k"], 100)
    assert not needs_blocks(series, ["k"], 10_000)


@pytest.mark.parametrize("rows_per_block", [1_000_000, 23])
def test_order_statistics(series, rows_per_block):
    marks = {"p50": 50.0, "p90": 90.0, "p99": 99.0, "p100": 100.0}
    got = {r["k"]: r for r in order_statistics(series, ["k"], "v", marks, rows_per_block).collect()}
    groups = {}
    for r in series.collect():
        groups.setdefault(r["k"], []).append(r["v"])
    for k, values in groups.items():
        values.sort()
        for name, p in marks.items():
            assert got[k][name] == values[min(int(len(values) * p / 100.0), len(values) - 1)]


def test_order_statistics_with_ties(spark):
    df = spark.createDataFrame([("a", float(v)) for v in [1, 1, 1, 2, 2, 9]], "k string, v double")
    row = order_statistics(df, ["k"], "v", {"p50": 50.0, "p99": 99.0}, rows_per_block=2).first()
    assert (row["p50"], row["p99"]) == (2.0, 9.0)


def walk(values, gap, strict):
    kept = []
    for v in sorted(set(values)):
        if not kept or (v - kept[-1] > gap if strict else v - kept[-1] >= gap):
            kept.append(v)
    return kept


@pytest.mark.parametrize("strict", [False, True])
def test_greedy_spacing_both_ways(spark, strict):
    rng = random.Random(5)
    rows = [(k, rng.randint(0, 400)) for k in "ab" for _ in range(150)] + [("c", 5)]
    df = spark.createDataFrame(rows, "k string, at bigint")
    want = sorted((k, v) for k in "abc" for v in walk([a for x, a in rows if x == k], 10, strict))
    assert collect(greedy_spacing(df, ["k"], "at", 10, strict), "k", "at") == want
    assert collect(greedy_spacing(df, ["k"], "at", 10, strict, key_rows=20, rows_per_block=30), "k", "at") == want


def test_hot_key_join_matches_plain_join(spark):
    rng = random.Random(1)
    big = spark.createDataFrame([("hot" if rng.random() < 0.6 else f"k{rng.randint(0, 2000)}", i) for i in range(4000)], "k string, i int")
    small = big.groupBy("k").agg(F.min("i").alias("lo"), F.count("*").alias("w"))
    plain = hot_key_join(big, small, ["k"], "w", 4000)
    split = hot_key_join(big, small, ["k"], "w", 4000, small_total=10)
    assert collect(split, "k", "i", "lo") == collect(plain, "k", "i", "lo")
    assert plain.count() == 4000


def test_split_hot_keeps_every_row(series):
    cold, hot = split_hot(series, ["k"], 100)
    assert cold.count() + hot.count() == series.count()
    assert [r["k"] for r in hot.select("k").distinct().collect()] == ["hot"]
    assert split_hot(series, ["k"], 100_000)[1] is None


def test_first_rows_of_the_seeded_order(spark):
    import hashlib

    df = spark.range(500)
    order = sorted(range(500), key=lambda i: (hashlib.md5(f"9|{i}".encode()).hexdigest(), i))
    for per_bucket in (200_000, 3):
        conditions = within_first(df, "id", 9, [0, 1, 20, 499, 500, 900], 500, per_bucket)
        for p, condition in zip([0, 1, 20, 499, 500, 500], conditions):
            assert sorted(r["id"] for r in df.filter(condition).collect()) == sorted(order[:p])


def test_borders_in_buckets_beyond_the_first_count(spark, monkeypatch):
    import hashlib

    from millrace.plans import hashed

    monkeypatch.setattr(hashed, "MAX_DIGITS", 1)
    df = spark.range(900)
    order = sorted(range(900), key=lambda i: (hashlib.md5(f"3|{i}".encode()).hexdigest(), i))
    (condition,) = within_first(df, "id", 3, [333], 900, 2)
    assert sorted(r["id"] for r in df.filter(condition).collect()) == sorted(order[:333])


def test_values_at(spark):
    df = spark.createDataFrame([(v,) for v in [5, 1, 9, 3, 3, 7]], "v int")
    assert values_at(df, "v", {"a": 0, "b": 2, "c": 5}, rows_per_block=2) == {"a": 1, "b": 3, "c": 9}


def test_null_keys_are_a_group(spark):
    df = spark.createDataFrame([(None, 1, 1.0), (None, 2, 2.0), ("a", 1, 3.0)], "k string, s int, v double")
    for blocks in (True, False):
        got = with_rank(df, ["k"], ["s"], rows_per_block=1, blocks=blocks)
        assert sorted((str(r["k"]), r["_rank"]) for r in got.collect()) == [("None", 1), ("None", 2), ("a", 1)]
    assert order_statistics(df, ["k"], "v", {"p": 50.0}).filter("k is null").first()["p"] == 2.0


def test_block_borders_do_not_depend_on_partitions(spark, series):
    one = with_rank(series.repartition(1), ["k"], ["step"], rows_per_block=37)
    many = with_rank(series.repartition(16), ["k"], ["step"], rows_per_block=37)
    assert collect(one, "k", "step", "_rank") == collect(many, "k", "step", "_rank")
    assert np.isfinite([r["v"] for r in one.collect()]).all()


def test_hot_rows_too_large_to_broadcast_are_salted(spark, monkeypatch):
    from millrace.plans import skew

    monkeypatch.setattr(skew, "BROADCAST_BYTES", 0)
    big = spark.range(3000).select((F.col("id") % 7 * (F.col("id") % 3)).alias("k"), "id").withColumn("k", F.when(F.col("k") > 0, F.col("k")))
    small = big.groupBy("k").agg(F.count("*").alias("w"), F.max("id").alias("top"))
    got = skew.hot_key_join(big, small, ["k"], "w", 3000, small_total=0)
    want = skew.null_safe_join(big, small.drop("w"), ["k"])
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect()))


def test_temporary_tables_go_and_others_stay(spark):
    from millrace.plans.durable import materialise, temporary

    with temporary(spark):
        inner = materialise(spark.range(3), "inner")
        outer = materialise(inner.selectExpr("id + 1 as id"), "outer", outlives=True)
        path = inner.inputFiles()[0].removeprefix("file://")
    import os

    assert not os.path.exists(path) and outer.count() == 3


def test_scopes_of_threads_do_not_meet(spark):
    import threading

    from millrace.plans.durable import materialise, temporary

    opened, closed, found = threading.Event(), threading.Event(), []

    def other():
        with temporary(spark):
            opened.set()
            closed.wait(60)

    with temporary(spark):
        thread = threading.Thread(target=other)
        thread.start()
        opened.wait(60)
        table = materialise(spark.range(5), "mine")
        closed.set()
        thread.join()
        found.append(table.count())
        path = table.inputFiles()[0]
    assert found == [5] and not spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration()).exists(spark._jvm.org.apache.hadoop.fs.Path(path))
