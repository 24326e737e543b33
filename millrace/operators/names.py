"""Person names by a gazetteer: a table of names joined on the capitalised words of texts.

A run of capitalised words gives all its parts of up to as many words as the longest name has;
the parts meet the table in a join, and of the hits in a text the leftmost and longest stay.  The
table may hold any number of names.  A recogniser of one's own joins in as a pandas UDF.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.functions.exchange import sliced
from millrace.functions.fixed import PERSON_SCORE
from millrace.plans.durable import materialise, written_bytes
from millrace.plans.skew import BROADCAST_BYTES, hot_key_join, null_safe_join

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Texts whose parts are listed at once have about so many bytes.
PART_BYTES = 1 << 20
_SPAN = "array<struct<start int, end int, score double>>"
# A word may hold hyphens and apostrophes, but a possessive s is not part of a name.
_WORD = re.compile(r"[^\W\d_]+(?:[-'’](?!s\b)[^\W\d_]+)*")


def parts_of(text: str, longest: int) -> list[tuple[int, int, str]]:
    """(start, end, words joined by a space) of all parts of runs of capitalised words."""
    words = [(m.start(), m.end(), m.group()) for m in _WORD.finditer(text)]
    out = []
    for first in range(len(words)):
        for last in range(first, min(first + longest, len(words))):
            if not words[last][2][0].isupper() or (last > first and text[words[last - 1][1] : words[last][0]].strip()):
                break
            out.append((words[first][0], words[last][1], " ".join(w for _, _, w in words[first : last + 1])))
    return out


def _parts(longest: int):
    """Arrow helper for rows (key, field, text): key and field with every part of the text, some texts at a time."""

    def run(batches):
        import pyarrow as pa

        for batch in sliced(batches, 2, PART_BYTES):
            rows, starts, ends, names = [], [], [], []
            for row, text in enumerate(batch.column(2).to_pylist()):
                for start, end, name in parts_of(text, longest) if text else []:
                    rows.append(row)
                    starts.append(start)
                    ends.append(end)
                    names.append(name)
            own = batch.select([0, 1]).take(pa.array(rows, pa.int32()))
            columns = [*own.columns, pa.array(starts, pa.int32()), pa.array(ends, pa.int32()), pa.array(names, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*own.schema.names, "start", "end", "name"])

    return run


def name_table(names: DataFrame, column: str = "name") -> DataFrame:
    """Distinct names in a written table, white space as one space; null and empty ones are left out."""
    words = F.filter(F.split(F.coalesce(F.col(column), F.lit("")), r"\s+"), lambda w: w != "")
    rows = names.select(F.array_join(words, " ").alias("name"), F.size(words).alias("words")).filter("words > 0")
    return materialise(rows.distinct(), "names")


def _leftmost_longest(hits: Column) -> Column:
    """Of spans ordered by start and falling end those that do not overlap an earlier kept one."""
    none = F.array().cast(_SPAN)
    step = lambda kept, h: F.when(
        (F.size(kept) == 0) | (h["start"] >= F.element_at(kept, -1)["end"]), F.concat(kept, F.array(h))
    ).otherwise(kept)
    ordered = F.array_sort(hits, lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(b["end"] - a["end"]))
    return F.aggregate(ordered, none, step)


def person_spans(texts: DataFrame, key: str, names: DataFrame | None = None, finder: Callable[[Column], Column] | None = None) -> DataFrame:
    """PERSON rows (key, field, entity_type, start, end, score, text_snippet) of (key, field, text).

    ``names`` has a column ``name``.  ``finder`` gives array<struct<start, end, score>> for a text
    column; its spans compete with those of the table.  (key, field) must be unique.  A small table
    of names is broadcast; with a large one the parts are shuffled, frequent ones split.
    """
    texts = texts.filter(F.col("text").rlike(r"\p{Lu}"))
    found = []
    if names is not None:
        known = name_table(names)
        longest = known.agg(F.max("words")).first()[0] or 0
        named = T.StructType([*texts.select(key, "field").schema.fields, *T.StructType.fromDDL("start int, end int, name string").fields])
        parts = texts.select(key, "field", "text").mapInArrow(_parts(longest), named)
        if written_bytes(known) <= BROADCAST_BYTES:
            hits = parts.join(F.broadcast(known.select("name")), "name")
        else:
            parts = materialise(parts, "name-parts")
            counts = parts.groupBy("name").agg(F.count(F.lit(1)).alias("_rows")).join(known.select("name"), "name")
            hits = hot_key_join(parts, counts, ["name"], "_rows", parts.count())
        found.append(hits.select(key, "field", "start", "end", F.lit(PERSON_SCORE).alias("score")))
    if finder is not None:
        found.append(texts.select(key, "field", F.explode(finder(F.col("text")).cast(_SPAN)).alias("s")).select(key, "field", "s.*"))
    if not found:
        raise ValueError("names or finder must be given")
    both = found[0] if len(found) == 1 else found[0].unionByName(found[1])
    spans = both.groupBy(key, "field").agg(_leftmost_longest(F.collect_list(F.struct("start", "end", "score"))).alias("spans"))
    met = null_safe_join(texts.select(key, "field", "text"), spans, [key, "field"])
    return met.select(key, "field", "text", F.explode("spans").alias("s")).select(
        key, "field", F.lit("PERSON").alias("entity_type"), "s.start", "s.end", "s.score",
        F.substring("text", F.col("s.start") + 1, F.col("s.end") - F.col("s.start")).alias("text_snippet"),
    )


def mask_spans(df: DataFrame, key: str, fields: Sequence[str], spans: DataFrame) -> DataFrame:
    """Every span (code points) of a field becomes <TYPE>.  Spans of a field must not overlap; ``key`` must be unique."""
    one = F.struct("start", "end", "entity_type")
    kind = "array<struct<start: int, end: int, entity_type: string>>"
    per_row = spans.groupBy(key).agg(*[F.sort_array(F.collect_list(F.when(F.col("field") == f, one))).alias(f"_spans_{f}") for f in fields])
    met = null_safe_join(df, per_row, [key], "left")

    def cut(f: str) -> Column:
        text, empty = F.col(f), F.struct(F.lit("").alias("out"), F.lit(0).alias("last"))
        step = lambda acc, s: F.struct(
            F.concat(acc["out"], F.substring(text, acc["last"] + 1, s["start"] - acc["last"]), F.lit("<"), s["entity_type"], F.lit(">")).alias("out"),
            s["end"].alias("last"),
        )
        done = F.aggregate(F.col(f"_spans_{f}").cast(kind), empty, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["last"] + 1, F.length(text))))
        return F.when(F.coalesce(F.size(f"_spans_{f}"), F.lit(0)) > 0, done).otherwise(text)

    return met.withColumns({f: cut(f) for f in fields}).drop(*[f"_spans_{f}" for f in fields])
