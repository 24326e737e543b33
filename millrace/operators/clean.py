"""Text cleaning, length, language and exact-duplicate filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.fixed import WHITESPACE
from millrace.functions.kernels import nfc, nfc_each
from millrace.functions.text import tokens

# Every character below U+0300 is its own canonical composition, alone and in sequence.
_MAY_COMPOSE = r"[^\x00-\u02ff]"
_CONTROLS = r"[\x00-\x08\x0b-\x0c\x0e-\x1f\x7f-\x9f]"

# Anything that neither cleaning step takes away.
_VISIBLE = f"[^{_CONTROLS[1:-1]}{WHITESPACE[1:-2]}]"


def _tidy(text: Column) -> Column:
    out = F.regexp_replace(text, _CONTROLS, "")
    out = F.regexp_replace(out, "\n{3,}", "\n\n")
    return F.regexp_replace(out, f"^{WHITESPACE}|{WHITESPACE}$", "")


def clean_text(text: Column) -> Column:
    """NFC, no control characters, at most one blank line in a row, stripped; null stays null.

    Only texts that can change under NFC travel to Python.
    """
    composed = nfc(F.when(text.rlike(_MAY_COMPOSE), text))
    return _tidy(F.coalesce(composed, text))


def clean_samples(df: DataFrame, fields: Sequence[str] = (), turns: str | None = None) -> DataFrame:
    """Clean every named text column and the content of every turn."""
    out = df.withColumns({f: clean_text(F.col(f)) for f in fields}) if fields else df
    if turns is None:
        return out
    contents = F.transform(turns, lambda t: t["content"])
    touchy = F.exists(turns, lambda t: t["content"].rlike(_MAY_COMPOSE))
    composed = out.withColumn("_nfc", F.coalesce(nfc_each(F.when(touchy, contents)), contents))
    return composed.withColumn(
        turns,
        F.zip_with(turns, "_nfc", lambda t, c: F.struct(t["role"].alias("role"), _tidy(c).alias("content"))),
    ).drop("_nfc")


def is_empty(required: Sequence[str] = (), turns: str | None = None) -> Column:
    """Whether a required text is null, empty or white space, or any turn is."""
    blank = lambda c: ~F.coalesce(c.rlike(_VISIBLE), F.lit(False))
    test = F.lit(False)
    for name in required:
        test = test | blank(F.col(name))
    if turns is not None:
        test = test | (F.coalesce(F.size(turns), F.lit(0)) <= 0) | F.exists(turns, lambda t: blank(t["content"]))
    return test


def drop_empty(df: DataFrame, required: Sequence[str] = (), turns: str | None = None) -> DataFrame:
    return df.filter(~F.coalesce(is_empty(required, turns), F.lit(False)))


def primary_text(fields: Sequence[str] = (), turns: str | None = None) -> Column:
    """The texts of a sample joined by newlines; nulls are skipped."""
    if turns is not None:
        return F.array_join(F.transform(turns, lambda t: t["content"]), "\n")
    return F.concat_ws("\n", *fields)


def filter_by_length(df: DataFrame, text: str, min_length: int = 0, max_length: int | None = None) -> DataFrame:
    n = F.length(text)
    return df.filter((n >= min_length) if max_length is None else n.between(min_length, max_length))


def dedup_exact(df: DataFrame, key: str, text: str) -> DataFrame:
    """Keep the row with the lowest key of each distinct text.

    Only (digest, key) is grouped, with map-side minima, so a text copied a billion times costs
    one row per task; the winners then select their rows by unique key.
    """
    winners = df.groupBy(F.sha2(F.col(text), 256).alias("_h")).agg(F.min(key).alias(key)).select(key)
    return df.join(winners, key, "left_semi")


def filter_language(df: DataFrame, lang: str, wanted: Sequence[str]) -> DataFrame:
    return df.filter(F.col(lang).isin(*wanted))


def guess_language(df: DataFrame, text: str, stop_words: dict[str, Sequence[str]], out: str = "language") -> DataFrame:
    """The language whose stop words cover most tokens; null where none occurs, ties by name."""
    toks = tokens(F.lower(F.col(text)))
    names = sorted(stop_words)

    def score(name: str) -> Column:
        words = F.array(*[F.lit(w) for w in stop_words[name]])
        hits = F.filter(F.col("_toks"), lambda t: F.array_contains(words, t))
        return F.struct(F.size(hits).alias("n"), F.lit(name).alias("name"))

    counts = [score(name) for name in names]
    scored = df.withColumn("_toks", toks).withColumn("_scores", F.array(*counts))
    top = F.array_max(F.transform("_scores", lambda s: s["n"]))
    first = F.element_at(F.filter("_scores", lambda s: s["n"] == top), 1)
    return scored.withColumn(out, F.when(top > 0, first["name"])).drop("_toks", "_scores")


def cleaning_report(total_input: DataFrame, cleaned: DataFrame, output: DataFrame) -> DataFrame:
    """total_input, total_output, dropped_empty and near_duplicates_removed from three stages."""
    stages = (
        total_input.select(F.lit("in").alias("s"))
        .unionByName(cleaned.select(F.lit("mid").alias("s")))
        .unionByName(output.select(F.lit("out").alias("s")))
    )
    n = lambda s: F.count_if(F.col("s") == s)
    return stages.agg(
        n("in").alias("total_input"),
        n("out").alias("total_output"),
        (n("in") - n("mid")).alias("dropped_empty"),
        (n("mid") - n("out")).alias("near_duplicates_removed"),
    )
