"""Sources, sinks, catalog, the corpus job and the streaming versions."""

import json

import pytest
from pyspark.sql import functions as F

from millrace.operators import catalog, prepare, runs, serving, tokens, validate
from millrace.operators.convert import training_text
from millrace.sources import readers, writers
from millrace.streaming import monitor
from millrace.streaming.run import drain_to_table


# ---- sources


@pytest.mark.parametrize("path,fmt", [("a.jsonl", "jsonl"), ("a.JSON", "jsonl"), ("s3://b/a.parquet", "parquet"), ("x/y.csv", "csv"), ("d.parquet/", "parquet")])
def test_detect_format(path, fmt):
    assert readers.detect_format(path) == fmt


def test_detect_format_errors():
    assert readers.detect_format("a.txt", "csv") == "csv"
    with pytest.raises(ValueError, match="Cannot detect format"):
        readers.detect_format("a.txt")
    with pytest.raises(ValueError, match="Unsupported format"):
        readers.detect_format("a.csv", "xml")


def test_jsonl_skips_what_is_not_an_object(spark, tmp_path):
    p = tmp_path / "a.jsonl"
    p.write_text('{"ok":1}\n\nNOT JSON\n[1,2,3]\n"string"\n{"ok":2, "t": "x"}\n')
    assert readers.read_jsonl(spark, str(p)).count() == 2
    assert sorted(r["ok"] for r in readers.read_jsonl(spark, str(p), "ok int").collect()) == [1, 2]
    rows = readers.ingest(spark, str(p)).orderBy("ok").collect()
    assert [r["t"] for r in rows] == [None, "x"]
    empty = tmp_path / "e.jsonl"
    empty.write_text("")
    assert readers.ingest(spark, str(empty)).count() == 0


def test_csv_keeps_empty_strings(spark, tmp_path):
    p = tmp_path / "a.csv"
    p.write_text('col,b\n"",x\n"a ""q"" \n c",y\n')
    assert [r["col"] for r in readers.ingest(spark, str(p)).collect()] == ["", 'a "q" \n c']


def test_split_dataset_resolution(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "a/train"))
    train, validation = readers.read_split_dataset(spark, str(tmp_path / "a"))
    assert train.count() == 3 and validation is None
    spark.range(2).write.parquet(str(tmp_path / "a/validation"))
    assert readers.read_split_dataset(spark, str(tmp_path / "a"))[1].count() == 2
    spark.range(4).write.parquet(str(tmp_path / "flat"))
    train, validation = readers.read_split_dataset(spark, str(tmp_path / "flat"))
    assert train.count() == 4 and validation is None
    with pytest.raises(ValueError):
        readers.load_by_uri(spark, "org/model-data")


def test_eval_set_uses_missing_keys_not_nulls(spark, tmp_path):
    p = tmp_path / "e.jsonl"
    p.write_text('{"input":"a","output":"b"}\n{"prompt":"c","reference":"d"}\n{"input":null,"prompt":"x"}\n{"z":1}\n')
    rows = [tuple(r) for r in readers.read_eval_set(spark, str(p)).collect()]
    assert rows[:2] == [("a", "b"), ("c", "d")] and rows[3] == ("", "")
    assert readers.read_eval_set(spark, str(p), "row").collect()[3]["prompt"] == '{"z":1}'
    df = spark.createDataFrame([("q", "t")], "question string, target string")
    assert tuple(df.select(*readers.eval_columns(df)).first()) == ("q", "t")


def test_write_splits_and_results(spark, tmp_path):
    parts = tokens.split_dataset(spark.range(20), "id")
    manifest = writers.write_splits(parts, str(tmp_path / "s"), "n").first()
    assert manifest["num_samples"] == 20 and len(manifest["sha256_checksum"]) == 64
    assert spark.read.json(str(tmp_path / "s/data")).groupBy("split").count().count() == 3
    writers.write_results_json(spark.createDataFrame([("m", 1.0)], "metric string, value double"), str(tmp_path / "r"), {"model": "x"})
    row = spark.read.json(str(tmp_path / "r")).first()
    assert row["results"]["value"] == 1.0 and row["metadata"]["model"] == "x" and row["timestamp"]


# ---- catalog


def test_checksum_ignores_layout_but_not_content_copies_or_name(spark):
    df = spark.createDataFrame([(i, f"t{i % 7}") for i in range(100)], "id int, t string")
    sums = lambda d, name="n": catalog.dataset_checksum(d, ["t"], name).first()["sha256_checksum"]
    assert sums(df) == sums(df.repartition(13)) == sums(df.orderBy(F.desc("id")))
    assert len({sums(df), sums(df, "m"), sums(df.filter("id > 0")), sums(df.withColumn("t", F.upper("t")))}) == 4


def test_versions(spark, tmp_path):
    store = str(tmp_path / "store")
    df = spark.range(10).withColumn("t", F.col("id").cast("string"))
    stats = tokens.token_statistics(spark.createDataFrame([([-100, 1],)], "labels array<int>"))
    first = catalog.publish_version(df, store, "ds", "1.0.0", statistics=stats, message="start")
    assert len(first) == 64
    catalog.publish_version(df.limit(4), store, "ds", "2.0.0")
    catalog.publish_version(df, store, "ds", "10.0.0")
    catalog.publish_version(df, store, "other", "1.0.0")
    manifests = spark.read.schema(catalog.MANIFEST).parquet(f"{store}/manifests")
    assert [r["version"] for r in catalog.list_versions(manifests, "ds").collect()] == ["1.0.0", "10.0.0", "2.0.0"]
    assert [r["version"] for r in catalog.list_versions(manifests, "ds", semantic=True).collect()] == ["1.0.0", "2.0.0", "10.0.0"]
    row = catalog.diff_versions(manifests, "ds", "1.0.0", "2.0.0").first()
    assert (row["samples_added"], row["samples_removed"]) == (0, 6)
    assert row["stats_old"]["token_distribution_percentiles"]["p50"] == 2.0 and row["stats_new"] is None
    with pytest.raises(ValueError, match="Manifest not found"):
        catalog.diff_versions(manifests, "ds", "1.0.0", "9.9.9")
    path = catalog.checkout_version(spark, store, "ds", "1.0.0")
    assert spark.read.parquet(path).count() == 10
    with pytest.raises(FileNotFoundError, match="Manifest not found"):
        catalog.checkout_version(spark, store, "ds", "3.0.0")
    df.limit(1).write.mode("append").parquet(path)
    with pytest.raises(ValueError, match="Checksum mismatch"):
        catalog.checkout_version(spark, store, "ds", "1.0.0")


def test_content_diff_counts_copies(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",)], "t string")
    b = spark.createDataFrame([("x",), ("z",)], "t string")
    assert sorted(tuple(r) for r in catalog.diff_content(a, b).collect()) == [("x", "removed", 1), ("y", "removed", 1), ("z", "added", 1)]


def test_registry(spark, tmp_path):
    path = str(tmp_path / "registry")
    manifest = lambda n: spark.createDataFrame([(n, "1.0.0", f"/data/{n}", 5)], "name string, version string, source_path string, num_samples long")
    a = catalog.register_dataset(manifest("a"), catalog.lineage_of("s3://x", "jsonl", "h", "1", ["clean"]), path, "me")
    catalog.register_dataset(manifest("b"), catalog.lineage_of("s3://y", "csv", "h", "1", [], parent=a), path)
    registry = spark.read.parquet(path)
    row = catalog.get_dataset(registry, a).first()
    assert (row["train_path"], row["validation_path"], row["registered_by"]) == ("/data/a/train", "/data/a/validation", "me")
    with pytest.raises(KeyError, match="Dataset not found"):
        catalog.get_dataset(registry, "nope")
    count = lambda f: catalog.search_datasets(registry, f).count()
    assert (count({}), count({"manifest.name": "a"}), count({"manifest.name": "a", "lineage.source_format": "csv"})) == (2, 1, 0)
    assert (count({"no.such": None}), count({"no.such": 1}), count({"lineage.parent_dataset_id": None})) == (2, 0, 1)
    assert catalog.get_lineage(registry, a).first()["transformations_applied"] == ["clean"]


# ---- the corpus job


def hundred(spark, tmp_path):
    p = tmp_path / "train.jsonl"
    p.write_text("\n".join(json.dumps({"instruction": f"Which sluice feeds wheel {i}?", "output": f"Wheel {i} turns on sluice {i % 7}, past weir {i}."}) for i in range(100)))
    return str(p)


def test_corpus_job(spark, tmp_path):
    source = hundred(spark, tmp_path)
    base = dict(source=source, pii_strategy=None, near_threshold=None)
    first = prepare.PrepareConfig(work_dir=str(tmp_path / "w1"), **base)
    steps = {r["step"]: r for r in prepare.prepare_corpus(spark, first).collect()}
    assert set(steps) == set(range(1, 9)) and steps[7]["output_count"] == 100
    assert all(r["duration_seconds"] >= 0 for r in steps.values())
    prepare.prepare_corpus(spark, prepare.PrepareConfig(work_dir=str(tmp_path / "w2"), **base))
    read = lambda w: spark.read.json(f"{tmp_path}/{w}/manifest").first()
    assert read("w1")["sha256_checksum"] == read("w2")["sha256_checksum"] and read("w1")["num_samples"] == 100
    again = prepare.PrepareConfig(work_dir=str(tmp_path / "w1"), resume_from=4, **base)
    resumed = {r["step"] for r in prepare.prepare_corpus(spark, again).collect()}
    assert resumed == {4, 5, 6, 7, 8} and read("w1")["sha256_checksum"] == read("w2")["sha256_checksum"]
    few = prepare.PrepareConfig(work_dir=str(tmp_path / "w3"), max_samples=10, **base)
    prepare.prepare_corpus(spark, few)
    assert read("w3")["num_samples"] == 10


def test_corpus_job_publishes_versions(spark, tmp_path):
    base = dict(source=hundred(spark, tmp_path), pii_strategy=None, near_threshold=None, name="wheels", store=str(tmp_path / "store"))
    prepare.prepare_corpus(spark, prepare.PrepareConfig(work_dir=str(tmp_path / "w1"), **base))
    prepare.prepare_corpus(spark, prepare.PrepareConfig(work_dir=str(tmp_path / "w2"), **base))
    versions = catalog._manifests(spark, base["store"]).collect()
    assert [(r["name"], r["version"], r["num_samples"], r["format"]) for r in versions] == [("wheels", "1.0.0", 100, "instruction")]
    assert versions[0]["statistics"]["total_samples"] == 100
    stored = spark.read.parquet(catalog.checkout_version(spark, base["store"], "wheels", "1.0.0"))
    assert stored.count() == 100 and {"input_ids", "labels", "split"} <= set(stored.columns)
    with pytest.raises(ValueError, match="published with other samples"):
        prepare.prepare_corpus(spark, prepare.PrepareConfig(work_dir=str(tmp_path / "w3"), max_samples=10, **base))
    prepare.prepare_corpus(spark, prepare.PrepareConfig(work_dir=str(tmp_path / "w3"), max_samples=10, version="1.1.0", **base))
    assert catalog.find_version(spark, base["store"], "wheels", "1.1.0")["num_samples"] == 10


def test_corpus_job_for_conversations(spark, tmp_path):
    say = lambda *turns: [(("user", "assistant")[k % 2], t) for k, t in enumerate(turns)]
    rows = [(say(f"How deep is pond {i}?", f"Pond {i} is {i * 3} feet deep; ask keeper{i}@ponds.example"),) for i in range(40)]
    rows += [(say("only one"),), (say("x", " \t "),), ([("system", "Be brief."), *say("Dry?", "No, the mill runs all year long on this brook")],)] + rows[:5]
    data = spark.createDataFrame(rows, "conversations array<struct<role string, content string>>")
    config = prepare.PrepareConfig(source="", work_dir=str(tmp_path / "w"), kind="conversation", template="chatml", max_length=4096, near_threshold=0.99)
    steps = {r["name"]: (r["input_count"], r["output_count"]) for r in prepare.prepare_corpus(spark, config, data).collect()}
    assert steps["ingest"] == (48, 48) and steps["validate"][1] in (46, 47) and steps["clean"][1] == 41
    assert steps["template"] == steps["tokenize"] == steps["publish"] == (41, 41)
    rendered = [r["rendered"] for r in spark.read.parquet(f"{tmp_path}/w/step_5_template").collect()]
    assert all("<EMAIL_ADDRESS>" in t for t in rendered if "Pond" in t) and not any("ponds.example" in t for t in rendered)
    assert sum("Be brief." in t for t in rendered) == 1
    assert catalog.find_version(spark, f"{tmp_path}/w/versions", "corpus", "1.0.0")["format"] == "conversation"
    with pytest.raises(ValueError, match="Missing required columns"):
        prepare.prepare_corpus(spark, config, data.withColumnRenamed("conversations", "other"))


def test_corpus_job_stops_on_personal_data(spark, tmp_path):
    from millrace.operators.pii import PersonalDataFound

    rows = spark.createDataFrame([("Who?", "Write to a@b.com")], "instruction string, output string")
    with pytest.raises(PersonalDataFound):
        prepare.prepare_corpus(spark, prepare.PrepareConfig(source="", work_dir=str(tmp_path / "w"), abort_on_pii=True), rows)


def test_content_ids_spread_copies(spark, monkeypatch):
    monkeypatch.setattr(prepare, "_COPIES_PER_TASK", 10)
    rows = spark.createDataFrame([("a", "b")] * 35 + [("c", "d")], "instruction string, output string")
    ids = [r["sample_id"] for r in prepare._with_content_ids(rows).collect()]
    assert len(ids) == 36 and len(set(ids)) == 36
    assert sorted(ids) == sorted(r["sample_id"] for r in prepare._with_content_ids(rows.repartition(5)).collect())


def test_long_conversation_rules_agree(spark):
    roles = {0: ["user", "assistant"] * 40, 1: ["system"] + ["user", "assistant"] * 9, 2: ["user", "user", "assistant"], 3: ["assistant"], 4: ["system", "assistant"], 5: ["bot", "assistant"]}
    rows = spark.createDataFrame([(k, i, r, "x") for k, v in roles.items() for i, r in enumerate(v)], "k int, turn int, role string, text string")
    arrays = validate.turns_from_rows(rows, "k", "turn", "role", "text")
    want = {r["k"]: r["v"] for r in arrays.select("k", validate.conversation_violations(F.col("conversations")).alias("v")).collect()}
    for options in ({}, {"key_rows": 5, "rows_per_block": 7}):
        got = {r["k"]: r["violations"] for r in validate.turn_row_violations(rows, "k", "turn", "role", "text", **options).collect()}
        assert got == want
    assert training_text(F.lit("i"), F.lit("o")) is not None


# ---- streaming against batch


@pytest.fixture()
def event_files(spark, tmp_path):
    rows = [(i % 3, i, f"2024-01-01 {i // 60:02d}:{i % 60:02d}:00", float((i * 37) % 50) + 1) for i in range(0, 600, 2)]
    df = spark.createDataFrame(rows, "run int, step bigint, at string, value double").withColumn("ts", F.col("at").cast("timestamp")).drop("at")
    # Several files in time order, read one per batch.
    path = str(tmp_path / "events")
    for k in range(3):
        df.filter(F.col("step").between(k * 200, k * 200 + 199)).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)
    return df, stream


def test_stream_rollup(event_files):
    df, stream = event_files
    got = drain_to_table(monitor.streaming_rollup(stream, ["run"], "ts", [F.sum("value").alias("s")]), "t").collect()
    closed = df.filter(F.col("ts") < F.lit("2024-01-01 09:00:00").cast("timestamp")).groupBy("run", F.window("ts", "1 hour").start.alias("p")).agg(F.sum("value").alias("s"))
    assert sorted((r["run"], r["period_start"], r["s"]) for r in got) == sorted(tuple(r) for r in closed.collect())


def test_stream_alarm(event_files):
    df, stream = event_files
    got = drain_to_table(monitor.streaming_alarm(stream, "run", "ts", "value", "avg", ">", 25.0, 2, "breaching"), "t").collect()
    batch = serving.threshold_alarm(df.withColumn("s", serving.epoch("ts")), "run", "s", "value", "avg", ">", 25.0, 2, "breaching")
    want = {(r["run"], r["period"]): (r["breaching"], r["in_alarm"]) for r in batch.collect()}
    assert len(got) > 300
    for r in got:
        assert (r["breaching"], r["in_alarm"]) == want[(r["run"], r["period"])]


@pytest.fixture()
def shuffled_files(spark, tmp_path):
    """Two rows a minute and run, each up to an hour late, in six files."""
    import random
    import time as clock

    draw = random.Random(5)
    rows = [(i % 3, i, f"2024-01-01 {i // 60:02d}:{i % 60:02d}:00", float(draw.randrange(1, 50)) * (6 if draw.random() < 0.05 else 1)) for i in range(900)]
    schema = "run int, step bigint, at string, value double"
    late = sorted(rows, key=lambda r: r[1] + draw.randrange(60))
    assert late != rows
    path = str(tmp_path / "shuffled")
    for k in range(6):
        part = spark.createDataFrame(late[k * 150 : k * 150 + 150], schema).withColumn("ts", F.col("at").cast("timestamp")).drop("at")
        part.coalesce(1).write.mode("append").parquet(path)
        clock.sleep(0.1)
    df = spark.read.parquet(path)
    return df, spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


# The last time stamp is 14:59; an hour and ten minutes before it the watermark stays.
UPTO = 899 - 70


def test_stream_loss_monitor_equals_batch_on_shuffled_arrival(shuffled_files):
    df, stream = shuffled_files
    live = monitor.streaming_loss_monitor(stream, "run", "step", "value", "ts", 5, 2.0, 60, 3, 0.5, delay="70 minutes")
    got = {(r["run"], r["step"]): r for r in drain_to_table(live, "t").collect()}
    assert sorted(s for _, s in got) == list(range(UPTO + 1))
    seen = lambda rows: [r for r in rows.collect() if r["step"] <= UPTO]
    spikes = seen(runs.loss_spikes(df, "run", "step", "value", 5, 2.0))
    plateaus = seen(runs.loss_plateau(df, "run", "step", "value", 60))
    stops = seen(runs.early_stop(df, "run", "step", "value", 3, 0.5))
    assert all(got[r["run"], r["step"]]["is_spike"] == r["is_spike"] for r in spikes) and any(r["is_spike"] for r in spikes)
    assert all(got[r["run"], r["step"]]["is_plateau"] == r["is_plateau"] for r in plateaus) and any(r["is_plateau"] for r in plateaus)
    assert all(got[r["run"], r["step"]]["counter"] == r["counter"] for r in stops)


def test_stream_loss_monitor_ends_at_a_nonfinite_loss(spark, shuffled_files):
    df, stream = shuffled_files
    broken = stream.withColumn("value", F.when((F.col("step") == 303), float("nan")).otherwise(F.col("value")))
    got = drain_to_table(monitor.streaming_loss_monitor(broken, "run", "step", "value", "ts", delay="70 minutes"), "t")
    last = {r["run"]: r["last"] for r in got.groupBy("run").agg(F.max("step").alias("last")).collect()}
    assert last == {0: 303, 1: 829, 2: 827}
    assert got.filter("step = 303").first()["should_stop"] is True


def test_stream_alert_dedup_equals_batch_on_shuffled_arrival(shuffled_files):
    df, stream = shuffled_files
    got = drain_to_table(monitor.streaming_alert_dedup(stream, "run", "step", "ts", window_seconds=1000, delay="70 minutes"), "t")
    want = serving.alert_dedup(df.filter(F.col("step") <= UPTO).select("run", "step", F.unix_micros("ts").alias("us")), "run", "step", "us", 1000)
    assert sorted(r["step"] for r in got.collect()) == sorted(r["step"] for r in want.collect())


@pytest.mark.parametrize("statistic", ["p99", "p50", "max"])
def test_stream_alarms_equal_batch_on_shuffled_arrival(shuffled_files, statistic):
    df, stream = shuffled_files
    got = drain_to_table(monitor.streaming_alarm(stream, "run", "ts", "value", statistic, ">", 45.0, 2, "breaching", 420, "70 minutes"), "t").collect()
    # Seven rows a period: the exact value at rank ceil(p * n).
    quantile = {"p99": 0.99, "p50": 0.5, "max": 1.0}[statistic]
    rank = lambda v: F.element_at(F.sort_array(F.collect_list(v)), F.ceil(quantile * F.count(v) - 1e-9).cast("int"))
    periods = df.groupBy("run", F.floor(serving.epoch("ts") / 420).alias("period")).agg(rank("value").alias("value"))
    want = {(r["run"], r["period"]): r for r in serving.alarm_states(periods, "run", ">", 45.0, 2, "breaching").collect()}
    assert len(got) > 300 // 3 and any(r["in_alarm"] for r in got) == any(want[r["run"], r["period"]]["in_alarm"] for r in got)
    for r in got:
        assert (r["value"], r["breaching"], r["in_alarm"]) == tuple(want[r["run"], r["period"]][c] for c in ("value", "breaching", "in_alarm"))


def test_stream_metric_sink_logs_failures(spark, event_files, tmp_path, caplog):
    df, stream = event_files
    out = str(tmp_path / "metrics")
    stream.writeStream.foreachBatch(monitor.metric_sink(out)).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    assert spark.read.parquet(out).count() == df.count()
    (tmp_path / "file").write_text("x")
    monitor.metric_sink(f"{tmp_path}/file/inside")(df, 0)
    assert "was not written" in caplog.text


def test_stream_clean_redact_and_drift(spark, tmp_path):
    df = spark.createDataFrame([(i, f"2024-01-01 {i // 4:02d}:00:0{i % 4}", f" I cannot mail a{i}@b.com \x07") for i in range(40)], "id int, at string, text string")
    df.withColumn("ts", F.col("at").cast("timestamp")).drop("at").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id int, text string, ts timestamp").parquet(str(tmp_path / "in"))
    cleaned = drain_to_table(monitor.streaming_clean_redact(stream, "id", "text").select("id", "text"), "t")
    assert {r["text"] for r in cleaned.collect()} == {"I cannot mail <EMAIL_ADDRESS>"}
    found = drain_to_table(monitor.streaming_output_drift(stream, "ts", "text", {"refusal_rate": 0.0}), "t").collect()
    assert len(found) >= 8 and all(r["drifted"] and r["n"] == 4 for r in found)


def test_inferred_names_may_hold_type_words(spark, tmp_path):
    rows = ['{"VOID_REASON": "x", "OBJECT<a": null, "n": {"VOID": [null, 1.5], "b c": []}}', '{"VOID_REASON": "y"}']
    path = tmp_path / "rows.jsonl"
    path.write_text("\n".join(rows))
    found = readers.infer_jsonl(spark, str(path)).collect()
    assert sorted(r["VOID_REASON"] for r in found) == ["x", "y"]
    first = next(r for r in found if r["VOID_REASON"] == "x")
    assert first["OBJECT<a"] is None and [v and float(v) for v in first["n"]["VOID"]] == [None, 1.5]


def test_stream_alarm_keeps_periods_that_begin_late(spark, tmp_path):
    import time as clock

    where = tmp_path / "in"
    where.mkdir()
    for at, value in (("10:00:00", 1.0), ("09:55:00", 7.0), ("11:00:00", 0.0)):
        one = spark.createDataFrame([("a", f"2024-01-01 {at}", value)], "k string, ts string, v double").withColumn("ts", F.to_timestamp("ts"))
        one.coalesce(1).write.mode("append").parquet(str(where))
        clock.sleep(1.1)
    schema = spark.read.parquet(str(where)).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(where))
    got = drain_to_table(monitor.streaming_alarm(stream, "k", "ts", "v", "sum", ">", 5.0, 1, "notBreaching"), "t").collect()
    values = [r["value"] for r in sorted(got, key=lambda r: r["period"])]
    assert values[:2] == [7.0, 1.0]
