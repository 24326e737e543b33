"""Conversions between instruction, conversation, ShareGPT and Alpaca forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.fixed import SHAREGPT_ROLES
from millrace.operators.validate import TURNS, instruction_violations


def _optional(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def _turn(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def _filled(text: Column) -> Column:
    return F.coalesce(F.length(text), F.lit(0)) > 0


def instruction_to_conversation(df: DataFrame, out: str = "conversations") -> DataFrame:
    """System turn if there is a system prompt, user turn (input after a blank line), assistant turn."""
    system, extra = _optional(df, "system_prompt"), _optional(df, "input")
    user = F.when(_filled(extra), F.concat("instruction", F.lit("\n\n"), extra)).otherwise(F.col("instruction"))
    pair = F.array(_turn("user", user), _turn("assistant", F.col("output")))
    return df.withColumn(out, F.when(_filled(system), F.concat(F.array(_turn("system", system)), pair)).otherwise(pair))


def conversation_to_instruction(df: DataFrame, turns: str = "conversations") -> DataFrame:
    """Leading system prompt, first user turn, last assistant turn; the turns between are lost."""
    first = F.try_element_at(F.col(turns), F.lit(1))

    def said(role: str, at: int) -> Column:
        return F.try_element_at(F.filter(turns, lambda t: t["role"] == role), F.lit(at))["content"]

    return df.withColumns(
        {
            "system_prompt": F.when(first["role"] == "system", first["content"]),
            "instruction": said("user", 1),
            "output": said("assistant", -1),
        }
    )


def sharegpt_to_conversation(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(converted, rejected): rejects lack both list columns or use an unknown speaker."""
    kind = "array<struct<from:string,value:string>>"
    lists = [F.col(c).cast(kind) for c in ("conversations", "conversation") if c in df.columns]
    source = F.coalesce(*lists) if lists else F.lit(None).cast(kind)
    roles = F.create_map(*[F.lit(x) for pair in SHAREGPT_ROLES.items() for x in pair])
    mapped = F.transform(
        source, lambda t: F.struct(F.try_element_at(roles, t["from"]).alias("role"), t["value"].alias("content"))
    )
    reason = F.when(source.isNull(), "no conversation list").when(
        F.exists(mapped, lambda t: t["role"].isNull()), "unknown speaker"
    )
    judged = df.withColumns({"_turns": mapped, "reject_reason": reason})
    plain = df.drop("conversations", "conversation").columns
    good = judged.filter(F.col("reject_reason").isNull()).select(*plain, F.col("_turns").cast(TURNS).alias("conversations"))
    return good, judged.filter(F.col("reject_reason").isNotNull()).drop("_turns")


def alpaca_to_conversation(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(converted, rejected): instruction and output must be present and not empty."""
    reason = F.array_join(
        F.filter(instruction_violations(_optional(df, "instruction"), _optional(df, "output")), lambda v: v.endswith("is empty")),
        "; ",
    )
    judged = df.withColumn("reject_reason", reason)
    good = judged.filter(F.col("reject_reason") == "").drop("reject_reason")
    bad = judged.filter(F.col("reject_reason") != "")
    if "instruction" in df.columns and "output" in df.columns:
        good = instruction_to_conversation(good)
    return good, bad


def training_text(instruction: Column, output: Column, input_: Column | None = None) -> Column:
    """Headers Instruction, Input (if any) and Response, separated by blank lines."""
    parts = [F.concat(F.lit("### Instruction:\n"), instruction, F.lit("\n"))]
    if input_ is not None:
        parts.append(F.when(_filled(input_), F.concat(F.lit("### Input:\n"), input_, F.lit("\n"))))
    parts.append(F.concat(F.lit("### Response:\n"), output))
    return F.concat_ws("\n", *parts)


def to_training_text(df: DataFrame) -> DataFrame:
    """Reduce instruction rows to their ``text``; other layouts pass unchanged.

    Rows with a null output have no text; ``training_text_rejects`` returns them.  ``output``
    missing as a column counts as empty.
    """
    if "input_ids" in df.columns or "text" in df.columns or "instruction" not in df.columns:
        return df
    output = F.col("output") if "output" in df.columns else F.lit("")
    input_ = F.col("input") if "input" in df.columns else None
    rows = df.filter(F.col("output").isNotNull()) if "output" in df.columns else df
    return rows.select(training_text(F.col("instruction"), output, input_).alias("text"))


def training_text_rejects(df: DataFrame) -> DataFrame:
    """Instruction rows that give no training text, with the reason; none for other layouts."""
    rows = df.withColumn("reason", F.lit("output is null"))
    given = "input_ids" in df.columns or "text" in df.columns or not {"instruction", "output"} <= set(df.columns)
    return rows.limit(0) if given else rows.filter(F.col("output").isNull())


def apply_chat_template(df: DataFrame) -> DataFrame:
    """Add ``text`` in the same layout and keep every other column."""
    input_ = F.col("input") if "input" in df.columns else None
    return df.withColumn("text", training_text(F.col("instruction"), F.col("output"), input_))
