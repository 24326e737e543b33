"""Training logs, checkpoints and run tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.functions.fixed import INSTANCE_PRICES
from millrace.plans.ordered import (
    KEY_ROWS,
    ROWS_PER_BLOCK,
    greedy_spacing,
    needs_blocks,
    with_previous_rows,
    with_rank,
    with_running,
)
from millrace.plans.skew import null_safe_join


def hourly_price(instance: Column, prices: dict[str, float] = INSTANCE_PRICES) -> Column:
    table = F.create_map(*[F.lit(x) for pair in prices.items() for x in pair])
    return F.coalesce(F.try_element_at(table, instance), F.lit(0.0))


def run_cost(
    logs: DataFrame, run: str, step: str, seconds: str, instance: str, count: str, budget: float | None = None,
    prices: dict[str, float] = INSTANCE_PRICES,
) -> DataFrame:
    """Elapsed hours, cost and the first step at or over the budget per run.

    ``seconds`` is the time since the start of the run; unknown instances cost 0.
    """
    cost = F.col(seconds) / 3600 * hourly_price(F.col(instance), prices) * F.col(count)
    priced = logs.withColumn("_cost", cost)
    over = F.when(F.col("_cost") >= budget, F.struct(F.col(seconds), F.col(step))) if budget is not None else F.lit(None)
    stop = F.min(over)[step] if budget is not None else F.lit(None).cast("bigint")
    return priced.groupBy(run).agg(
        F.round(F.max(seconds) / 3600, 4).alias("elapsed_hours"),
        F.round(F.max("_cost"), 4).alias("estimated_cost_usd"),
        stop.alias("budget_stop_step"),
    )


def _finite(value: str) -> Column:
    return F.col(value).isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf"))


def nonfinite_stops(logs: DataFrame, run: str, step: str, loss: str) -> DataFrame:
    """(run, stop_step): the first NaN or infinite loss of each run that has one."""
    bad = logs.filter(F.isnan(loss) | (F.abs(loss) == float("inf")))
    return bad.groupBy(run).agg(F.min(step).alias("stop_step"))


def until_stop(logs: DataFrame, run: str, step: str, loss: str) -> DataFrame:
    """Finite losses logged before the run stopped.

    Runs that never stop are not in the stop table, so only its keys are looked up.
    """
    stops = nonfinite_stops(logs, run, step, loss)
    kept = null_safe_join(logs.filter(_finite(loss)), stops, [run], "left")
    return kept.filter(F.col("stop_step").isNull() | (F.col(step) < F.col("stop_step"))).drop("stop_step")


def loss_spikes(
    logs: DataFrame, run: str, step: str, loss: str, window: int = 50, factor: float = 3.0,
    key_rows: int = KEY_ROWS, rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """Add the mean of up to ``window`` previous losses and whether the loss exceeds factor times it."""
    rows = until_stop(logs, run, step, loss)
    blocks = needs_blocks(rows, [run], key_rows)
    ranked = with_rank(rows, [run], [step], rows_per_block, blocks=blocks)
    halo = with_previous_rows(ranked, "_rank", window, rows_per_block, blocks)
    before = Window.partitionBy(run, "_blk").orderBy("_rank").rowsBetween(-window, -1)
    scored = halo.withColumn("rolling_mean", F.avg(loss).over(before)).filter("_own").drop("_blk", "_own", "_rank")
    mean = F.col("rolling_mean")
    return scored.withColumn("is_spike", F.coalesce((mean > 0) & (F.col(loss) > factor * mean), F.lit(False)))


def loss_plateau(
    logs: DataFrame, run: str, step: str, loss: str, plateau_steps: int = 500,
    key_rows: int = KEY_ROWS, rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """Add best loss and its step so far, and whether no new minimum came for ``plateau_steps``."""
    rows = until_stop(logs, run, step, loss)
    blocks = needs_blocks(rows, [run], key_rows)
    with_min = with_running(rows, [run], [step], {"_prior": ("min", loss)}, rows_per_block, blocks)
    is_best = F.col("_prior").isNull() | (F.col(loss) < F.col("_prior"))
    marked = with_min.withColumns({"_best": is_best, "_best_step": F.when(is_best, F.col(step))})
    found = with_running(marked, [run], [step], {"_last_best": ("max", "_best_step")}, rows_per_block, blocks)
    since = F.when(F.col("_best"), F.lit(0).cast("bigint")).otherwise(F.col(step) - F.col("_last_best"))
    return found.select(
        *rows.columns,
        F.least(F.col("_prior"), F.col(loss)).alias("best_loss"),
        F.when(F.col("_best"), F.col(step)).otherwise(F.col("_last_best")).alias("best_step"),
        since.alias("steps_since_best"),
        (~F.col("_best") & (since >= plateau_steps)).alias("is_plateau"),
    )


def early_stop(
    evals: DataFrame, run: str, step: str, loss: str, patience: int = 5, min_delta: float = 1e-4,
    key_rows: int = KEY_ROWS, rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """Add best loss, counter and stop flag of patience-based stopping.

    An improvement must undercut the last improvement by more than ``min_delta``, so it is
    always a new running minimum: the minima are found first, and spacing them by min_delta
    gives the improvements.
    """
    rows = evals.filter(F.col(loss).isNotNull())
    blocks = needs_blocks(rows, [run], key_rows)
    ranked = with_rank(rows, [run], [step], rows_per_block, blocks=blocks)
    with_min = with_running(ranked, [run], [step], {"_prior": ("min", loss)}, rows_per_block, blocks)
    is_min = ~F.isnan(loss) & (F.col("_prior").isNull() | (F.col(loss) < F.col("_prior")))
    minima = with_min.filter(is_min).select(run, step, (-F.col(loss)).alias("_depth"))
    better = greedy_spacing(minima.select(run, "_depth"), [run], "_depth", min_delta, True, key_rows, rows_per_block, blocks)
    marks = null_safe_join(minima, better, [run, "_depth"]).select(run, step, F.lit(True).alias("_improved"))
    joined = null_safe_join(ranked, marks, [run, step], "left").withColumns(
        {
            "_at": F.when(F.col("_improved"), F.col("_rank")),
            "_level": F.when(F.col("_improved"), F.col(loss)),
        }
    )
    upto = with_running(joined, [run], [step], {"_last": ("max", "_at"), "_low": ("min", "_level")}, rows_per_block, blocks)
    counter = F.when(F.col("_improved"), F.lit(0).cast("bigint")).otherwise(F.col("_rank") - F.coalesce("_last", F.lit(0)))
    return upto.select(
        *evals.columns,
        F.coalesce("_level", "_low").alias("best_loss"),
        counter.alias("counter"),
        (counter >= patience).alias("should_stop"),
    )


def stop_steps(stopping: DataFrame, run: str, step: str) -> DataFrame:
    return stopping.filter("should_stop").groupBy(run).agg(F.min(step).alias("stop_step"))


def grad_norm_series(logs: DataFrame, run: str, step: str, norm: str) -> DataFrame:
    return logs.filter(F.col(norm).isNotNull()).select(run, step, F.round(norm, 6).alias("grad_norm"))


def checkpoint_step(path: Column) -> Column:
    """The number after the last dash of a checkpoint name, null for other paths."""
    return F.regexp_extract(path, r"checkpoint-(?:.*-)?([0-9]+)/?$", 1).try_cast("bigint")


def checkpoint_retention(checkpoints: DataFrame, run: str, path: str, keep: int = 3) -> DataFrame:
    """The checkpoints to remove: all but the ``keep`` with the highest step of each run.

    Each task passes on only its own top rows; the kept paths are then taken out by path.
    """
    steps = checkpoints.withColumn("step", checkpoint_step(F.col(path))).filter(F.col("step").isNotNull())
    newest = Window.partitionBy(run).orderBy(F.desc("step"), path)
    kept = steps.select(run, path, "step").withColumn("_r", F.row_number().over(newest)).filter(F.col("_r") <= keep)
    return steps.join(kept.select(run, path), [run, path], "left_anti")


def best_checkpoint(checkpoints: DataFrame, run: str, path: str, metric: str) -> DataFrame:
    """Lowest finite metric per run, the earliest step on ties; runs without a metric give no row."""
    rows = checkpoints.withColumn("step", checkpoint_step(F.col(path))).filter(_finite(metric) & F.col("step").isNotNull())
    best = F.min(F.struct(F.col(metric), F.col("step"), F.col(path)))
    return rows.groupBy(run).agg(best.alias("b")).select(run, F.col(f"b.{path}").alias(path), F.col(f"b.{metric}").alias(metric), "b.step")


def latest_checkpoint(checkpoints: DataFrame, run: str, path: str) -> DataFrame:
    rows = checkpoints.withColumn("step", checkpoint_step(F.col(path))).filter(F.col("step").isNotNull())
    return rows.groupBy(run).agg(F.max(F.struct("step", path)).alias("b")).select(run, f"b.{path}", "b.step")


def top_runs(runs: DataFrame, run: str, metrics: str, metric: str, k: int = 5) -> DataFrame:
    """The k runs with the lowest value of one entry of the metrics map; missing values last."""
    value = F.try_element_at(F.col(metrics), F.lit(metric))
    return runs.orderBy(value.asc_nulls_last(), run).limit(k)


def latest_approved_model(models: DataFrame, group: str, created: str, status: str, metrics_json: str) -> DataFrame:
    """The newest Approved row per group with its metrics as a map; bad JSON gives an empty map."""
    approved = models.filter(F.col(status) == "Approved")
    rest = [c for c in models.columns if c not in (group, created)]
    newest = approved.groupBy(group).agg(F.max(F.struct(F.col(created), *rest)).alias("m")).select(group, "m.*")
    parsed = F.from_json(metrics_json, "map<string,double>", {"mode": "PERMISSIVE"})
    return newest.withColumn("metrics", F.coalesce(parsed, F.create_map().cast("map<string,double>")))


def model_versions(models: DataFrame, group: str, name: str) -> DataFrame:
    return models.filter(F.col(group) == name)


def model_lineage(models: DataFrame, runs: DataFrame, evaluations: DataFrame, run: str) -> DataFrame:
    """Models with their run's metadata and evaluation results as a map."""
    # One value per run and metric first: the map is as long as the list of metric names.
    single = evaluations.groupBy(run, "metric").agg(F.max("value").alias("value"))
    results = single.groupBy(run).agg(F.map_from_entries(F.collect_list(F.struct("metric", "value"))).alias("eval_results"))
    return models.join(runs, run, "left").join(results, run, "left")


def job_summary(runs: DataFrame, run: str, best_step: str | None = None) -> DataFrame:
    """Summary metrics of each run as (run, metric, value, unit) rows."""
    values = {
        "TotalTrainingTimeMinutes": F.col("training_time_seconds") / 60.0,
        "FinalEvalLoss": F.col("final_eval_loss"),
        "EstimatedCostUSD": F.col("estimated_cost_usd"),
        "TotalSteps": F.col("total_steps"),
    }
    if best_step is not None:
        values["BestCheckpointStep"] = F.col(best_step)
    return metric_rows(runs, [run], values)


def training_metric_rows(logs: DataFrame, keys: Sequence[str]) -> DataFrame:
    names = {"TrainingLoss": "loss", "LearningRate": "learning_rate", "Epoch": "epoch"}
    return metric_rows(logs, keys, {n: F.col(c) for n, c in names.items() if c in logs.columns})


def inference_metric_rows(requests: DataFrame, keys: Sequence[str]) -> DataFrame:
    return metric_rows(
        requests, keys, {"InferenceLatency": F.col("latency_ms"), "TokensGenerated": F.col("tokens_generated")},
        {"InferenceLatency": "Milliseconds"},
    )


def metric_rows(df: DataFrame, keys: Sequence[str], values: dict[str, Column], units: dict[str, str] | None = None) -> DataFrame:
    units = units or {}
    wide = df.select(*keys, *[v.cast("double").alias(n) for n, v in values.items()])
    long = wide.unpivot(list(keys), list(values), "metric", "value")
    unit = F.lit("None")
    for name, u in units.items():
        unit = F.when(F.col("metric") == name, u).otherwise(unit)
    return long.withColumn("unit", unit)


def flatten_params(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, param, value): struct columns give section.key, scalars their name; null scalars are left out."""
    items = []
    for field in df.schema.fields:
        if field.name in keys:
            continue
        if field.dataType.typeName() == "struct":
            for inner in field.dataType.fields:
                value = F.coalesce(F.col(f"{field.name}.{inner.name}").cast("string"), F.lit("None"))
                items.append(F.struct(F.lit(f"{field.name}.{inner.name}").alias("param"), value.alias("value"), F.lit(True).alias("keep")))
        else:
            value = F.col(field.name)
            items.append(F.struct(F.lit(field.name).alias("param"), value.cast("string").alias("value"), value.isNotNull().alias("keep")))
    return df.select(*keys, F.explode(F.array(*items)).alias("p")).filter("p.keep").select(*keys, "p.param", "p.value")
