"""Prompt rendering."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.fixed import ALPACA_PREAMBLE, RESPONSE_MARKERS

_PLACEHOLDER = re.compile(r"\{\{(.*?)\}\}", re.DOTALL)
_NAME = re.compile(r"[A-Za-z][A-Za-z0-9_]*")


def _given(text: Column | None) -> Column:
    return F.lit(False) if text is None else F.coalesce(F.length(text), F.lit(0)) > 0


def render(
    template: str, instruction: Column, output: Column, input_: Column | None = None, system: Column | None = None
) -> Column:
    """A named format: alpaca, chatml, llama3 or mistral.  Only alpaca uses ``input_``."""
    nothing = F.lit("")
    has_system, system_text = _given(system), F.lit("") if system is None else system
    if template == "alpaca":
        extra = nothing if input_ is None else F.when(
            _given(input_), F.concat(F.lit("\n### Input:\n"), input_, F.lit("\n"))
        ).otherwise(nothing)
        return F.concat(
            F.lit(f"{ALPACA_PREAMBLE}\n\n### Instruction:\n"), instruction, F.lit("\n"), extra,
            F.lit("\n### Response:\n"), output,
        )
    if template == "chatml":
        head = F.when(has_system, F.concat(F.lit("<|im_start|>system\n"), system_text, F.lit("<|im_end|>\n")))
        return F.concat(
            F.coalesce(head, nothing), F.lit("<|im_start|>user\n"), instruction,
            F.lit("<|im_end|>\n<|im_start|>assistant\n"), output, F.lit("<|im_end|>"),
        )
    if template == "llama3":
        head = F.when(
            has_system,
            F.concat(F.lit("<|start_header_id|>system<|end_header_id|>\n\n"), system_text, F.lit("<|eot_id|>")),
        )
        return F.concat(
            F.lit("<|begin_of_text|>"), F.coalesce(head, nothing),
            F.lit("<|start_header_id|>user<|end_header_id|>\n\n"), instruction,
            F.lit("<|eot_id|><|start_header_id|>assistant<|end_header_id|>\n\n"), output, F.lit("<|eot_id|>"),
        )
    if template == "mistral":
        head = F.when(has_system, F.concat(system_text, F.lit("\n\n"))).otherwise(nothing)
        return F.concat(F.lit("[INST] "), head, instruction, F.lit(" [/INST] "), output, F.lit("</s>"))
    raise FileNotFoundError(f"Template not found: {template}")


def render_template(
    df: DataFrame, template: str, instruction: str = "instruction", output: str = "output",
    input_: str | None = None, system: str | None = None, out: str = "rendered",
) -> DataFrame:
    named = lambda c: None if c is None else F.col(c)
    return df.withColumn(out, render(template, F.col(instruction), F.col(output), named(input_), named(system)))


def render_custom(df: DataFrame, template: str, out: str = "rendered") -> DataFrame:
    """A user template with ``{{ column }}`` placeholders; anything else in braces is an error."""
    parts, at = [], 0
    for hit in _PLACEHOLDER.finditer(template):
        name = hit.group(1).strip()
        if not _NAME.fullmatch(name):
            raise ValueError(f"Only column names may stand in a template: {name!r}")
        if name not in df.columns:
            raise ValueError(f"Template column not found: {name}")
        parts += [F.lit(template[at : hit.start()]), F.coalesce(F.col(name).cast("string"), F.lit(""))]
        at = hit.end()
    return df.withColumn(out, F.concat(*parts, F.lit(template[at:])))


def render_conversation(df: DataFrame, template: str, turns: str = "conversations", out: str = "rendered") -> DataFrame:
    """Each (user, assistant) pair rendered, the system prompt in the first; joined by newlines."""
    first = F.try_element_at(F.col(turns), F.lit(1))
    system = F.when(first["role"] == "system", first["content"])
    body = F.when(first["role"] == "system", F.slice(turns, 2, F.greatest(F.size(turns) - 1, F.lit(0)))).otherwise(F.col(turns))
    staged = df.withColumns({"_system": system, "_body": body}).withColumn("_pairs", F.floor(F.size("_body") / 2).cast("int"))
    # sequence() counts down from 0 to -1, so no pairs must be a case of its own.
    numbers = F.when(F.col("_pairs") > 0, F.sequence(F.lit(0), F.col("_pairs") - 1)).otherwise(F.array().cast("array<int>"))

    def chunk(i: Column) -> Column:
        said = lambda offset: F.element_at("_body", (i * 2 + offset + 1).cast("int"))["content"]
        return render(template, said(0), said(1), None, F.when(i == 0, F.col("_system")))

    return staged.withColumn(out, F.array_join(F.transform(numbers, chunk), "\n")).drop("_system", "_body", "_pairs")


def response_marker(template: str) -> str:
    return RESPONSE_MARKERS.get(template, "")


def estimate_tokens(rendered: Column) -> Column:
    return F.ceil(F.length(rendered) / 4)
