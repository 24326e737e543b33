"""The corpus job: ingest, validate, redact, clean, render, tokenise, publish, report."""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from millrace.operators import catalog, clean, dedup, pii, tokens, validate
from millrace.operators.template import render_conversation, render_template
from millrace.plans.durable import materialise, temporary
from millrace.sources.readers import ingest
from millrace.sources.writers import write_splits

STEPS = ("ingest", "validate", "pii", "clean", "template", "tokenize", "publish", "report")


@dataclass
class PrepareConfig:
    source: str
    work_dir: str
    name: str = "corpus"
    version: str = "1.0.0"
    # instruction or conversation; the latter reads turns from the column conversations.
    kind: str = "instruction"
    # Folder of the version store, by default inside the work folder.
    store: str | None = None
    template: str = "alpaca"
    max_length: int = 512
    seed: int = 42
    fmt: str | None = None
    max_samples: int | None = None
    pii_strategy: str | None = "mask"
    abort_on_pii: bool = False
    persons: bool = False
    near_threshold: float | None = 0.85
    train: float = 0.9
    validation: float = 0.05
    resume_from: int = 1
    fields: tuple[str, ...] = field(default=("instruction", "input", "output", "system_prompt"))

    @property
    def turns(self) -> str | None:
        return "conversations" if self.kind == "conversation" else None

    @property
    def texts(self) -> tuple[str, ...]:
        return () if self.turns else self.fields


def prepare_corpus(spark: SparkSession, config: PrepareConfig, rows: DataFrame | None = None, names: DataFrame | None = None) -> DataFrame:
    """Run the steps and return their rows (step, name, input_count, output_count, duration_seconds).

    With a table of person ``names`` the personal-data step finds these too.

    Every step from 1 to 6 leaves a parquet table in the work folder; ``resume_from`` starts
    from the table of the step before it.  Rows are counted while they are written.  Step 7
    publishes the tokenised samples as a version of the store: a version that holds the same
    samples already is left as it is, one that holds others is an error.
    """
    report: list[tuple] = []
    counts: dict[int, int] = {}

    def path(step: int) -> str:
        return f"{config.work_dir}/step_{step}_{STEPS[step - 1]}"

    def table(step: int) -> DataFrame:
        return spark.read.parquet(path(step))

    def count(step: int) -> int:
        if step not in counts:
            counts[step] = table(step).count()
        return counts[step]

    def run(step: int, build) -> None:
        if step < config.resume_from:
            return
        start = time.monotonic()
        seen = Observation(f"step {step}")
        with temporary(spark):
            build().observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path(step))
        counts[step] = seen.get["rows"]
        before = count(step - 1) if step > 1 else count(1)
        report.append((step, STEPS[step - 1], before, count(step), time.monotonic() - start))

    run(1, lambda: _ingest(spark, config, rows))
    run(2, lambda: validate.normalise(table(1), config.kind)[0].drop("sample_kind"))
    run(3, lambda: _redact(table(2), config, names))
    run(4, lambda: _clean(table(3), config))
    run(5, lambda: _render(table(4), config))
    run(6, lambda: _tokenize(table(5), config))

    start = time.monotonic()
    final = table(6)
    tokens.require_samples(final)
    manifest = write_splits(final, f"{config.work_dir}/tokenized-{int(time.time() * 1000)}", config.name)
    stats = tokens.token_statistics(final).first().asDict()  # one row
    _publish(final, config, tokens.token_statistics(final))
    described = manifest.select("*", *[F.lit(v).alias(k) for k, v in stats.items()], F.lit(config.template).alias("template"), F.lit(config.version).alias("version"))
    described.coalesce(1).write.mode("overwrite").json(f"{config.work_dir}/manifest")
    report.append((7, "publish", count(6), count(6), time.monotonic() - start))
    report.append((8, "report", count(6), count(6), 0.0))
    steps = spark.createDataFrame(
        report, "step int, name string, input_count bigint, output_count bigint, duration_seconds double"
    )
    steps.coalesce(1).write.mode("overwrite").json(f"{config.work_dir}/report")
    return steps


def _ingest(spark: SparkSession, config: PrepareConfig, rows: DataFrame | None) -> DataFrame:
    data = ingest(spark, config.source, config.fmt) if rows is None else rows
    if config.turns and config.turns not in data.columns:
        raise ValueError(f"Missing required columns: {[config.turns]}")
    for name in config.texts:
        if name not in data.columns:
            data = data.withColumn(name, F.lit(None).cast("string"))
    if "sample_id" not in data.columns:
        data = _with_content_ids(data)
    if config.max_samples is not None:
        data = validate.sample_n(data, "sample_id", config.max_samples, config.seed)
    return data


# Copies of one row that a single task writes out.
_COPIES_PER_TASK = 100_000


def _with_content_ids(data: DataFrame) -> DataFrame:
    """Add ``sample_id``: the digest of the row and a copy number, whatever the file layout.

    Copies are counted map-side and written out again from the count; the copies of a hot row
    are spread over tasks.
    """
    columns = data.columns
    counted = data.groupBy(catalog.row_digest(columns).alias("_d")).agg(
        F.first(F.struct(*columns)).alias("_row"), F.count(F.lit(1)).alias("_c")
    )
    few = counted.filter(F.col("_c") <= _COPIES_PER_TASK).withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("_c"))))
    many = (
        counted.filter(F.col("_c") > _COPIES_PER_TASK)
        .withColumn("_from", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_c"), F.lit(_COPIES_PER_TASK).cast("bigint"))))
        .repartition("_d", "_from")
        .withColumn("_n", F.explode(F.sequence(F.col("_from"), F.least(F.col("_from") + _COPIES_PER_TASK - 1, F.col("_c")))))
        .drop("_from")
    )
    both = few.unionByName(many)
    return both.select("_row.*", F.concat_ws("-", "_d", F.col("_n").cast("string")).alias("sample_id"))


def _redact(data: DataFrame, config: PrepareConfig, names: DataFrame | None) -> DataFrame:
    texts = pii.long_texts(data, "sample_id", config.texts, config.turns)
    if config.abort_on_pii:
        pii.pii_gate(texts, persons=config.persons, names=names)
    if config.pii_strategy is None:
        return data
    if names is not None and config.turns:
        raise ValueError("A table of names is redacted in instruction fields only; use abort_on_pii for conversations")
    return pii.redact(data, config.pii_strategy, config.texts, config.turns, config.seed, config.persons, names=names)


def _clean(data: DataFrame, config: PrepareConfig) -> DataFrame:
    required = [] if config.turns else ["instruction", "output"]
    cleaned = clean.drop_empty(clean.clean_samples(data, config.texts, config.turns), required, config.turns)
    if config.near_threshold is None:
        return cleaned
    texted = cleaned.withColumn("_text", clean.primary_text(["instruction", "input", "output"], config.turns))
    # Both readers below go over their input several times, so it is written first.
    unique = materialise(clean.dedup_exact(texted, "sample_id", "_text"), "corpus-unique")
    return dedup.dedup_near(unique, "sample_id", "_text", config.near_threshold).drop("_text")


def _render(data: DataFrame, config: PrepareConfig) -> DataFrame:
    if config.turns:
        return render_conversation(data, config.template, config.turns)
    return render_template(data, config.template, input_="input", system="system_prompt")


def _publish(final: DataFrame, config: PrepareConfig, statistics: DataFrame) -> None:
    store = config.store or f"{config.work_dir}/versions"
    known = catalog.find_version(final.sparkSession, store, config.name, config.version)
    if known is None:
        catalog.publish_version(final, store, config.name, config.version, config.kind, config.source, statistics, f"template {config.template}")
    elif known["sha256_checksum"] != catalog.dataset_checksum(final, sorted(final.columns), config.name).first()["sha256_checksum"]:
        raise ValueError(f"{config.name}_v{config.version} is published with other samples")


def _tokenize(data: DataFrame, config: PrepareConfig) -> DataFrame:
    done = tokens.tokenize_with_labels(data, "rendered", config.template, config.max_length)
    kept = tokens.drop_unlabeled(done).select("sample_id", "input_ids", "attention_mask", "labels", "was_truncated")
    return tokens.split_dataset(materialise(kept, "corpus-tokens"), "sample_id", config.train, config.validation, config.seed)
