"""Serving reports, alarms, alerts, training logs, runs and requests."""

import math

import pytest
from pyspark.sql import functions as F

from millrace.operators import requests, runs, serving


def test_service_report_fixture(spark):
    rows = [
        ("2024-01-01 00:10:00", "invocations", 100.0), ("2024-01-01 01:10:00", "invocations", 200.0),
        ("2024-01-01 00:10:00", "errors", 1.0), ("2024-01-01 01:10:00", "errors", 0.0),
        ("2024-01-01 00:10:00", "latency", 50_000.0), ("2024-01-01 01:10:00", "latency", 60_000.0),
    ]
    df = spark.createDataFrame([("e", *r) for r in rows], "endpoint string, ts string, metric string, value double")
    rollup = serving.hourly_rollup(df.withColumn("ts", F.col("ts").cast("timestamp")), "endpoint")
    row = serving.service_report(rollup, "endpoint").first()
    assert (row["invocation_count"], row["avg_p50_ms"], row["error_rate"], row["uptime_pct"], row["cost_estimate"]) == (300, 55.0, 0.3333, 100.0, 0.06)
    assert row["max_p99_ms"] == 60.0


def test_alarm_counts_missing_periods(spark):
    df = spark.createDataFrame([("e", 0, 1.0), ("e", 1500, 1.0)], "k string, s bigint, v double")
    got = serving.threshold_alarm(df, "k", "s", "v", "sum", "<=", 0.0, 3, "breaching", last_period=6).orderBy("period").collect()
    assert [(r["breaching"], r["in_alarm"]) for r in got] == [
        (False, False), (True, False), (True, False), (True, True), (True, True), (False, False), (True, False),
    ]
    calm = serving.threshold_alarm(df, "k", "s", "v", "avg", ">", 0.5, 2, "notBreaching", last_period=6)
    assert calm.filter("in_alarm").count() == 0
    top = serving.threshold_alarm(df, "k", "s", "v", "p99", ">", 0.5, 1, "notBreaching", last_period=6)
    assert top.filter("in_alarm").count() == 2


def test_error_rate_alarm(spark):
    df = spark.createDataFrame([("e", 300 * i, 1, 1) for i in range(4)] + [("e", 1200, 5, 0)], "k string, s bigint, inv int, err int")
    got = serving.error_rate_alarm(df, "k", "s", "inv", "err").orderBy("period").collect()
    assert [r["in_alarm"] for r in got] == [False, False, True, True, False]


def test_latency_report(spark):
    rows = [("a", i, i, float(i + 1), True) for i in range(10)] + [("a", 10, 10, 0.0, False), ("b", 11, 0, 5.0, False)]
    df = spark.createDataFrame(rows, "k string, id int, done int, ms double, ok boolean")
    got = {r["k"]: r for r in serving.latency_report(df, "k", "id", "done", "ms", "ok").collect()}
    assert (got["a"]["p50_ms"], got["a"]["p99_ms"], got["a"]["mean_ms"], got["a"]["errors"]) == (6.0, 10.0, 5.5, 1)
    assert got["a"]["error_rate"] == 0.0909 and got["a"]["throughput_rps"] == 181.82
    assert (got["b"]["error_rate"], got["b"]["p50_ms"], got["b"]["throughput_rps"]) == (1.0, 0.0, 0.0)
    warm = {r["k"]: r for r in serving.latency_report(df, "k", "id", "done", "ms", "ok", warmup=5, rows_per_block=2).collect()}
    assert warm["a"]["total_requests"] == 6 and warm["a"]["p50_ms"] == 8.0 and "b" not in warm


def test_rate_smoke_correctness(spark):
    df = spark.createDataFrame([("t", 10.0, None), ("t", 20.0, None), ("t", None, "ThrottlingException: x"), ("t", None, "other")], "k string, ms double, e string")
    row = serving.rate_test(df, "k", "ms", "e", 2, 2).first()
    assert (row["achieved_rpm"], row["throttle_rate"], row["error_rate"], row["latency_p50"]) == (1.0, 0.25, 0.5, 20.0)
    smoke = spark.createDataFrame([("ok", 10, 200), (" ", 10, 200), ("ok", 30_000, 200), ("ok", 10, 500), (None, 1, 200)], "t string, ms int, st int")
    checked = serving.smoke_check(smoke, "t", "ms", "st")
    assert [r["status_text"] for r in checked.collect()] == ["pass", "fail", "fail", "fail", "fail"]
    assert not serving.smoke_verdict(checked).first()["passed"]
    cases = spark.createDataFrame([("Paris is IT", ["paris"], ["london"]), ("London", ["paris"], ["LONDON"]), ("x", None, [])], "t string, a array<string>, b array<string>")
    got = serving.correctness_check(cases, "t", "a", "b").collect()
    assert [r["passed"] for r in got] == [True, False, True]
    assert got[1]["issues"] == ["Missing expected: 'paris'", "Contains forbidden: 'LONDON'"]


def test_confusion_backend_canary(spark):
    df = spark.createDataFrame([(True, True, None), (False, False, None), (True, False, None), (False, True, None), (True, True, "err")], "w boolean, s boolean, e string")
    assert tuple(serving.filter_confusion(df, "w", "s", "e").first()) == (2, 3, 5, 1, 1)
    lat = spark.createDataFrame([("a", 10.0), ("a", -1.0), ("b", 10.0)], "k string, ms double")
    assert tuple(serving.backend_latency_compare(lat, "k", "ms", "a", "b").first()) == (10.0, 10.0, "a")
    assert tuple(serving.backend_latency_compare(lat, "k", "ms", "a", "c").first()) == (10.0, -1.0, "insufficient_data")
    deploys = spark.createDataFrame([("e", t) for t in (0, 95, 101, 500)] + [("f", 0)], "ep string, at bigint")
    alarms = spark.createDataFrame([("e", 100), ("e", 610)], "ep string, fired bigint")
    got = {(r["ep"], r["at"]): r["status"] for r in serving.canary_verdict(deploys, alarms, "ep", "at", "fired", 100).collect()}
    assert got == {("e", 0): "rolled_back", ("e", 95): "rolled_back", ("e", 101): "completed", ("e", 500): "completed", ("f", 0): "completed"}


def test_alerts(spark):
    rows = [
        ("training", "m", "training_failed", None, None), ("training", "m", "done", None, None), ("drift", "e", None, None, None),
        ("deployment", "e", "rollback", None, None), ("deployment", "e", "odd", None, None), ("cost", "c", None, 120.0, 100.0), ("cost", "c", None, 1.0, 0.0),
    ]
    df = spark.createDataFrame(rows, "kind string, name string, event string, cost double, budget double").withColumn("details", F.lit(None).cast("map<string,string>"))
    got = serving.alert_events(df).collect()
    assert [r["severity"] for r in got] == ["CRITICAL", "INFO", "WARNING", "CRITICAL", "WARNING", "CRITICAL", "WARNING"]
    assert got[5]["subject"] == "Cost Alert: 120% of budget ($120.00/$100.00)" and got[0]["message"].startswith('[CRITICAL] {"model_id":"m"')
    long = df.withColumn("name", F.repeat(F.lit("n"), 200))
    assert all(len(r["subject"]) <= 100 for r in serving.alert_events(long).collect())


@pytest.mark.parametrize("key_rows", [1_000_000, 2])
def test_alert_dedup(spark, key_rows):
    seconds = [0, 10, 299, 300, 301, 599, 600, 2000, 2000]
    df = spark.createDataFrame([("k", i, s * 1_000_000) for i, s in enumerate(seconds)], "k string, id int, us bigint")
    kept = serving.alert_dedup(df, "k", "id", "us", key_rows=key_rows, rows_per_block=3)
    assert sorted(r["id"] for r in kept.collect()) == [0, 3, 6, 7]


def test_budget(spark):
    df = spark.createDataFrame([("t", d, 40.0) for d in "abc"], "k string, d string, c double")
    got = serving.budget_utilisation(df, "k", "d", "c", 100.0).orderBy("d").collect()
    assert [(r["utilization_pct"], r["level"]) for r in got] == [(40.0, "OK"), (80.0, "WARNING"), (120.0, "CRITICAL")]
    assert serving.budget_utilisation(df, "k", "d", "c", 0.0).first()["utilization_pct"] == 0.0


# ---- training logs


def logs(spark, values, steps=None):
    steps = steps or range(len(values))
    return spark.createDataFrame([("r", int(s), None if v is None else float(v)) for s, v in zip(steps, values)], "run string, step bigint, loss double")


BLOCKS = [{}, {"key_rows": 2, "rows_per_block": 3}]


@pytest.mark.parametrize("options", BLOCKS)
def test_spikes(spark, options):
    got = runs.loss_spikes(logs(spark, [1.0] * 5 + [10.0, 10.0]), "run", "step", "loss", 5, **options).orderBy("step").collect()
    assert [r["is_spike"] for r in got] == [False] * 5 + [True, True] and got[6]["rolling_mean"] == pytest.approx(2.8)
    got = runs.loss_spikes(logs(spark, [1.0] * 5 + [2.5, None, math.nan, 99.0]), "run", "step", "loss", 5, **options).collect()
    assert len(got) == 6 and not any(r["is_spike"] for r in got)


@pytest.mark.parametrize("options", BLOCKS)
def test_plateau(spark, options):
    got = runs.loss_plateau(logs(spark, [1.0, 1.5, 0.5, 0.6], [0, 15, 16, 30]), "run", "step", "loss", 10, **options).orderBy("step").collect()
    assert [r["is_plateau"] for r in got] == [False, True, False, True]
    assert [r["best_step"] for r in got] == [0, 0, 16, 16] and [r["best_loss"] for r in got] == [1.0, 1.0, 0.5, 0.5]


@pytest.mark.parametrize("options", BLOCKS)
@pytest.mark.parametrize(
    "values,patience,delta,counters,best",
    [
        ([1.0] * 4, 3, 0.01, [0, 1, 2, 3], 1.0),
        ([2.0, 2.0, 2.0, 1.5], 5, 0.01, [0, 1, 2, 0], 1.5),
        ([2.0, 1.95], 5, 0.1, [0, 1], 2.0),
        ([0.9, 0.8, 0.79995, 0.7999, 0.7], 2, 1e-4, [0, 0, 1, 2, 0], 0.7),
        ([math.nan, 1.0, math.nan, 0.5], 5, 0.1, [1, 0, 1, 0], 0.5),
        ([1.0, 0.95, 0.9, 0.85, 0.8], 9, 0.12, [0, 1, 2, 0, 1], 0.85),
    ],
)
def test_early_stop(spark, values, patience, delta, counters, best, options):
    got = runs.early_stop(logs(spark, values), "run", "step", "loss", patience, delta, **options).orderBy("step").collect()
    assert [r["counter"] for r in got] == counters and got[-1]["best_loss"] == best
    assert [r["should_stop"] for r in got] == [c >= patience for c in counters]


def test_run_cost(spark):
    df = spark.createDataFrame(
        [("r", 1, 1800.0, "ml.g5.2xlarge", 2), ("r", 2, 3600.0, "ml.g5.2xlarge", 2), ("r", 3, 7200.0, "ml.g5.2xlarge", 2), ("u", 1, 3600.0, "other", 1)],
        "run string, step bigint, s double, i string, c int",
    )
    got = {r["run"]: r for r in runs.run_cost(df, "run", "step", "s", "i", "c", 2.0).collect()}
    assert (got["r"]["estimated_cost_usd"], got["r"]["budget_stop_step"], got["u"]["estimated_cost_usd"]) == (4.848, 2, 0.0)


def test_checkpoints(spark):
    rows = [("r", f"checkpoint-{s}", m) for s, m in [(0, 0.5), (100, 0.3), (200, None), (300, 0.3), (400, math.inf), (1000, 0.9)]] + [("q", "checkpoint-7", None)]
    df = spark.createDataFrame(rows, "run string, path string, best_metric double")
    gone = runs.checkpoint_retention(df, "run", "path", 2)
    assert sorted(r["step"] for r in gone.collect()) == [0, 100, 200, 300]
    assert [tuple(r) for r in runs.best_checkpoint(df, "run", "path", "best_metric").collect()] == [("r", "checkpoint-100", 0.3, 100)]
    assert {r["run"]: r["step"] for r in runs.latest_checkpoint(df, "run", "path").collect()} == {"r": 1000, "q": 7}


def test_runs_and_models(spark):
    df = spark.createDataFrame([("a", {"l": 2.0}), ("b", {"l": 1.0}), ("c", {})], "run string, metrics map<string,double>")
    assert [r["run"] for r in runs.top_runs(df, "run", "metrics", "l", 3).collect()] == ["b", "a", "c"]
    models = spark.createDataFrame(
        [("g", 1, "Approved", '{"acc": 0.9}'), ("g", 2, "Approved", "{bad"), ("g", 3, "Rejected", None), ("h", 1, "Pending", None)],
        "grp string, created int, status string, body string",
    )
    rows = runs.latest_approved_model(models, "grp", "created", "status", "body").collect()
    assert [(r["grp"], r["created"], r["metrics"]) for r in rows] == [("g", 2, {})]
    params = spark.createDataFrame([(1, ("x", None), None, 5)], "id int, sec struct<a:string,b:string>, n string, k int")
    assert {r["param"]: r["value"] for r in runs.flatten_params(params, ["id"]).collect()} == {"sec.a": "x", "sec.b": "None", "k": "5"}


# ---- requests


def test_requests(spark):
    bodies = [
        ('{"prompt":"Test prompt"}', "application/json"), ('{"prompt":"p","temperature":10,"max_new_tokens":-5,"stop_sequences":["x"]}', "application/json"),
        ('"A simple prompt string"', "application/json"), ("plain", "text/plain"), ('{"text":1}', "application/json"), ("{bad", "application/json"),
        ("x", "text/xml"), ("[1]", "application/json"),
    ]
    df = spark.createDataFrame([(i, *b) for i, b in enumerate(bodies)], "id int, body string, kind string")
    good, bad = requests.normalise_requests(df, "body", "kind")
    got = {r["id"]: r for r in good.collect()}
    assert sorted(got) == [0, 1, 2, 3] and sorted(r["id"] for r in bad.collect()) == [4, 5, 6, 7]
    first = got[0]
    assert (first["max_new_tokens"], first["temperature"], first["top_p"], first["top_k"], first["do_sample"], first["repetition_penalty"]) == (256, 0.7, 0.9, 50, True, 1.1)
    assert (got[1]["temperature"], got[1]["max_new_tokens"], got[1]["stop_sequences"]) == (2.0, 1, ["x"])
    assert got[2]["prompt"] == "A simple prompt string" and got[3]["prompt"] == "plain"


def test_stop_sequences_and_ids(spark):
    df = spark.createDataFrame([("a END b STOP", 5, 10), ("none", 5, 10), ("none", 10, 10)], "t string, n int, top int").withColumn("s", F.array(F.lit("STOP"), F.lit("END")))
    got = requests.cut_at_stop_sequence(df, "t", "s", "n", "top").collect()
    assert [(r["t"], r["finish_reason"]) for r in got] == [("a END b ", "stop_sequence"), ("none", "stop"), ("none", "length")]
    ids = requests.with_request_id(spark.createDataFrame([("x",), (None,)], "request_id string")).collect()
    assert ids[0]["request_id"] == "x" and len(ids[1]["request_id"]) == 36


def test_equal_deployments_stay_apart(spark):
    deployed = spark.createDataFrame([("e", 100, {"k": "v"}), ("e", 100, {"k": "v"}), (None, 100, None)], "endpoint string, at long, tags map<string,string>")
    alarms = spark.createDataFrame([("e", 150), ("e", 90)], "endpoint string, at long")
    found = serving.canary_verdict(deployed, alarms, "endpoint", "at", "at", 60).collect()
    assert sorted(r["status"] for r in found) == ["completed", "rolled_back", "rolled_back"]


def test_early_stop_of_a_run_without_a_name(spark):
    rows = [(None, s, v) for s, v in enumerate([3.0, 2.0, 2.5, 1.0])] + [("r", 0, 1.0)]
    found = runs.early_stop(spark.createDataFrame(rows, "run string, step long, loss double"), "run", "step", "loss", 2).filter("run is null").orderBy("step").collect()
    assert [(r["best_loss"], r["counter"]) for r in found] == [(3.0, 0), (2.0, 0), (2.0, 1), (1.0, 0)]
