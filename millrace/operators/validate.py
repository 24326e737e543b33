"""Row validation, normalisation, dataset checks and seeded sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.functions.fixed import (
    MAX_INPUT,
    MAX_INSTRUCTION,
    MAX_OUTPUT,
    MAX_SYSTEM_PROMPT,
    ROLES,
)
from millrace.plans.hashed import order_key, within_first
from millrace.plans.ordered import KEY_ROWS, ROWS_PER_BLOCK, needs_blocks, with_rank

TURNS = T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())]))


def instruction_violations(
    instruction: Column, output: Column, input_: Column | None = None, system_prompt: Column | None = None
) -> Column:
    """Array of violation names, empty for a valid instruction sample."""
    nothing = F.lit(None).cast("string")
    input_ = nothing if input_ is None else input_
    system_prompt = nothing if system_prompt is None else system_prompt
    checks = [
        F.when(F.coalesce(F.length(instruction), F.lit(0)) == 0, "instruction is empty"),
        F.when(F.length(instruction) > MAX_INSTRUCTION, "instruction is too long"),
        F.when(F.coalesce(F.length(output), F.lit(0)) == 0, "output is empty"),
        F.when(F.length(output) > MAX_OUTPUT, "output is too long"),
        F.when(F.length(input_) > MAX_INPUT, "input is too long"),
        F.when(F.length(system_prompt) > MAX_SYSTEM_PROMPT, "system_prompt is too long"),
    ]
    return F.array_compact(F.array(*checks))


def turn_violations(role: Column, content: Column) -> Column:
    checks = [
        F.when(~F.coalesce(role.isin(*ROLES), F.lit(False)), "unknown role"),
        F.when(F.coalesce(F.length(content), F.lit(0)) == 0, "content is empty"),
    ]
    return F.array_compact(F.array(*checks))


def conversation_violations(turns: Column) -> Column:
    """Array of violation names for an array of (role, content) turns."""
    n = F.coalesce(F.size(turns), F.lit(0))
    first = F.try_element_at(turns, F.lit(1))["role"]
    last = F.try_element_at(turns, F.lit(-1))["role"]
    body = F.when(first == "system", F.slice(turns, 2, F.greatest(n - 1, F.lit(0)))).otherwise(turns)
    odd = F.filter(
        F.transform(body, lambda t, i: t["role"] != F.when(i % 2 == 0, "user").otherwise("assistant")), lambda x: x
    )
    bad_turn = F.exists(turns, lambda t: F.size(turn_violations(t["role"], t["content"])) > 0)
    checks = [
        F.when(n < 2, "fewer than 2 turns"),
        F.when((n >= 1) & ~F.coalesce(first.isin("user", "system"), F.lit(False)), "first turn is not user or system"),
        F.when((n >= 1) & ~F.coalesce(last == "assistant", F.lit(False)), "last turn is not assistant"),
        F.when(
            (n >= 2) & (first == "system") & (F.try_element_at(turns, F.lit(2))["role"] != "user"),
            "system is not followed by user",
        ),
        F.when((n >= 2) & (F.size(odd) > 0), "turns do not alternate"),
        F.when((n >= 1) & bad_turn, "invalid turn"),
    ]
    return F.array_compact(F.array(*checks))


def turns_from_rows(rows: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    """One row per conversation with its turns in order.

    The array form is one sample in one row; check conversations of unknown length with
    ``turn_row_violations`` first, which never collects them.
    """
    item = F.struct(F.col(turn).alias("_o"), F.col(role).alias("role"), F.col(text).alias("content"))
    ordered = F.transform(F.sort_array(F.collect_list(item)), lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content")))
    return rows.groupBy(key).agg(ordered.alias("conversations"))


def turn_row_violations(
    rows: DataFrame, key: str, turn: str, role: str, text: str, key_rows: int = KEY_ROWS, rows_per_block: int = ROWS_PER_BLOCK
) -> DataFrame:
    """(key, violations) straight from turn rows, for conversations of any length.

    Nothing is collected: a turn's expected role follows from its rank, and the rules become
    counts per conversation.  Names and order are those of ``conversation_violations``.
    """
    blocks = needs_blocks(rows, [key], key_rows)
    ranked = with_rank(rows, [key], [turn], rows_per_block, out="_rank", blocks=blocks)
    first = ranked.withColumn("_lead", (F.col("_rank") == 1) & F.coalesce(F.col(role) == "system", F.lit(False)))
    # Whether there is a leading system turn is not known to later rows; count for both cases.
    odd = F.col("_rank") % 2 == 1
    is_user, is_assistant = F.col(role) == "user", F.col(role) == "assistant"
    plain = F.when(odd, is_user).otherwise(is_assistant)
    shifted = F.when(odd, is_assistant).otherwise(is_user)
    bad = F.size(turn_violations(F.col(role), F.col(text))) > 0
    miss = lambda ok, where: F.count_if(where & ~F.coalesce(ok, F.lit(False)))
    at = lambda rank: F.max(F.when(F.col("_rank") == rank, F.col(role)))
    sums = first.groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"), F.bool_or("_lead").alias("_system"), at(1).alias("_first"), at(2).alias("_second"),
        F.max(F.struct("_rank", role))[role].alias("_last"), miss(plain, F.lit(True)).alias("_plain"),
        miss(shifted, F.col("_rank") > 1).alias("_shifted"), F.bool_or(bad).alias("_bad"),
    )
    n, system = F.col("_n"), F.col("_system")
    checks = [
        F.when(n < 2, "fewer than 2 turns"),
        F.when(~F.coalesce(F.col("_first").isin("user", "system"), F.lit(False)), "first turn is not user or system"),
        F.when(~F.coalesce(F.col("_last") == "assistant", F.lit(False)), "last turn is not assistant"),
        F.when((n >= 2) & system & (F.col("_second") != "user"), "system is not followed by user"),
        F.when((n >= 2) & (F.when(system, F.col("_shifted")).otherwise(F.col("_plain")) > 0), "turns do not alternate"),
        F.when(F.col("_bad"), "invalid turn"),
    ]
    return sums.select(key, F.array_compact(F.array(*checks)).alias("violations"))


def normalise(df: DataFrame, target: str = "auto") -> tuple[DataFrame, DataFrame]:
    """Split raw rows into accepted samples and rejects with a reason.

    Accepted rows gain ``sample_kind`` (instruction or conversation).  Absent columns count as
    null; ``auto`` tries the instruction form first.
    """
    if target not in ("instruction", "conversation", "auto"):
        raise ValueError(f"Unsupported target schema: {target}")

    def named(name: str, kind: str) -> Column:
        return F.col(name) if name in df.columns else F.lit(None).cast(kind)

    instruction = instruction_violations(
        named("instruction", "string"), named("output", "string"), named("input", "string"), named("system_prompt", "string")
    )
    conversation = conversation_violations(named("conversations", TURNS.simpleString()))
    as_instruction = F.when(F.size(instruction) == 0, "instruction")
    as_conversation = F.when(F.size(conversation) == 0, "conversation")
    if target == "instruction":
        kind, reason = as_instruction, instruction
    elif target == "conversation":
        kind, reason = as_conversation, conversation
    else:
        kind, reason = F.coalesce(as_instruction, as_conversation), F.concat(instruction, conversation)
    judged = df.withColumn("sample_kind", kind)
    accepted = judged.filter(F.col("sample_kind").isNotNull())
    rejected = judged.filter(F.col("sample_kind").isNull()).drop("sample_kind").withColumn(
        "reject_reason", F.array_join(reason, "; ")
    )
    return accepted, rejected


def validate_columns(df: DataFrame, required: Sequence[str]) -> None:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Long table (column, nulls), one scan for all columns."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column", "nulls")


def validate_no_nulls(df: DataFrame, columns: Sequence[str]) -> None:
    found = {r["column"]: r["nulls"] for r in null_counts(df, columns).collect() if r["nulls"]}
    if found:
        raise ValueError(f"Null values found: {found}")


def duplicate_count(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: rows beyond the first of their key.

    Keys are shuffled as 256-bit digests, counted map-side first.
    """
    digest = F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)
    per_key = df.select(digest.alias("_k")).groupBy("_k").agg(F.count(F.lit(1)).alias("_c"))
    return per_key.agg(F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).alias("duplicates"))


def dataset_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("num_rows")).withColumn("num_columns", F.lit(len(df.columns)).cast("bigint"))


def sample_n(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """n rows chosen by seeded hash of the unique ``key``; all rows if there are no more than n."""
    (chosen,) = within_first(df, key, seed, [n], df.count())
    return df.filter(chosen)


def capture_sample(df: DataFrame, key: str, percent: float, seed: int = 42) -> DataFrame:
    """Keep a fixed share of rows by key hash: stateless, so it also works on streams."""
    part = F.conv(F.substring(order_key(seed, key), 1, 8), 16, 10).cast("bigint") % 10000
    return df.filter(part < int(round(percent * 100)))


def validate_dataset(
    df: DataFrame,
    required: Sequence[str],
    checks: Sequence[str] = ("schema", "nulls", "duplicates"),
    sample_size: int | None = None,
    key: str | None = None,
) -> DataFrame:
    """One row (check, passed, detail) per chosen check, over the data or a seeded sample of it."""
    spark = df.sparkSession
    missing = [c for c in required if c not in df.columns]
    present = [c for c in required if c in df.columns]
    data = df if sample_size is None else sample_n(df, key, sample_size)
    parts = []
    if "schema" in checks:
        detail = f"Missing required columns: {missing}" if missing else ""
        parts.append(spark.createDataFrame([("schema", not missing, detail)], "check string, passed boolean, detail string"))
    if "nulls" in checks and present:
        counts = null_counts(data, present).agg(
            F.sum("nulls").alias("n"),
            F.array_join(
                F.sort_array(F.collect_list(F.when(F.col("nulls") > 0, F.concat_ws("=", "column", "nulls")))), ", "
            ).alias("where"),
        )
        parts.append(counts.select(F.lit("nulls").alias("check"), (F.col("n") == 0).alias("passed"), F.col("where").alias("detail")))
    if "duplicates" in checks and present:
        counts = duplicate_count(data, present)
        parts.append(
            counts.select(
                F.lit("duplicates").alias("check"),
                (F.col("duplicates") == 0).alias("passed"),
                F.when(F.col("duplicates") > 0, F.col("duplicates").cast("string")).otherwise("").alias("detail"),
            )
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
