"""Inference requests and responses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.fixed import REQUEST_DO_SAMPLE, REQUEST_NUMBERS


def normalise_requests(df: DataFrame, body: str, content_type: str) -> tuple[DataFrame, DataFrame]:
    """(requests, rejects).  JSON objects, bare JSON strings and plain text become a prompt with
    defaults applied and parameters clamped; anything else is rejected with a reason."""
    parsed = F.when(F.col(content_type) == "application/json", F.try_parse_json(F.col(body)))
    kind = F.schema_of_variant("_json")
    staged = df.withColumn("_json", parsed).withColumn("_kind", kind)
    has_prompt = F.col("_kind").startswith("OBJECT") & F.try_variant_get("_json", "$.prompt", "variant").isNotNull()
    json_text = F.col("_kind") == "STRING"
    plain = F.col(content_type) == "text/plain"
    reason = (
        F.when(plain, None)
        .when(F.col(content_type) != "application/json", "Unsupported content type")
        .when(F.col("_json").isNull(), "Invalid JSON")
        .when(json_text | has_prompt, None)
        .otherwise("Missing required field: 'prompt'")
    )
    judged = staged.withColumn("reject_reason", reason)
    prompt = (
        F.when(plain, F.col(body))
        .when(json_text, F.try_variant_get("_json", "$", "string"))
        .otherwise(F.try_variant_get("_json", "$.prompt", "string"))
    )
    columns = {"prompt": prompt}
    for name, (default, low, high) in REQUEST_NUMBERS.items():
        given = F.try_variant_get("_json", f"$.{name}", "double")
        clamped = F.greatest(F.lit(float(low)), F.least(F.lit(float(high)), F.coalesce(given, F.lit(float(default)))))
        columns[name] = clamped.cast("bigint") if isinstance(default, int) else clamped
    columns["do_sample"] = F.coalesce(F.try_variant_get("_json", "$.do_sample", "boolean"), F.lit(REQUEST_DO_SAMPLE))
    columns["stop_sequences"] = F.coalesce(
        F.try_variant_get("_json", "$.stop_sequences", "array<string>"), F.array().cast("array<string>")
    )
    accepted = judged.filter(F.col("reject_reason").isNull()).withColumns(columns).drop("_json", "_kind", "reject_reason")
    return accepted, judged.filter(F.col("reject_reason").isNotNull()).drop("_json", "_kind")


def cut_at_stop_sequence(df: DataFrame, text: str, stops: Column | str, num_tokens: str, max_tokens: str) -> DataFrame:
    """Cut at the first listed stop sequence that occurs; add the finish reason."""
    present = F.filter(stops, lambda s: F.contains(F.col(text), s))
    found = df.withColumn("_stop", F.try_element_at(present, F.lit(1)))
    hit = F.col("_stop").isNotNull()
    before = F.substring(F.col(text), F.lit(1), F.position(F.col("_stop"), F.col(text)) - 1)
    reason = F.when(hit, "stop_sequence").when(F.col(num_tokens) < F.col(max_tokens), "stop").otherwise("length")
    return found.withColumns({"finish_reason": reason, text: F.when(hit, before).otherwise(F.col(text))}).drop("_stop")


def with_request_id(df: DataFrame, column: str = "request_id") -> DataFrame:
    if column not in df.columns:
        return df.withColumn(column, F.uuid())
    return df.withColumn(column, F.coalesce(F.col(column), F.uuid()))
