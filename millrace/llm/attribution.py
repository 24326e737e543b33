"""Token counts of sections: whole documents are encoded once and their tokens attributed by offsets.

Byte-level tokens partition the bytes of a text, so running lengths give each token's span; the
spans meet the sections' intervals by binary search.  A token that crosses a border goes where
the rule says: ``start`` (the section with its first byte), ``most`` (the section with most of its
bytes, the earlier one in a tie) or ``split`` (each section gets its share of the bytes).
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# The public vocabulary this environment offers; any file of "base64 rank" lines will do.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the split pattern that belongs to the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
RULES = ("start", "most", "split")

SECTION = T.StructType(
    [
        T.StructField("section", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
        T.StructField("tokens", T.DoubleType()), T.StructField("crossing", T.LongType()),
    ]
)


def vocabulary(spark: SparkSession, path: str = TOKENIZER) -> bytes:
    """The vocabulary file, read by Spark from any store; a file of a few megabytes."""
    where = path if ":" in path else f"file://{path}"
    return bytes(spark.read.format("binaryFile").load(where).select("content").first()[0])


@lru_cache(maxsize=2)
def _encoding(ranks: bytes, pattern: str):
    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
    lengths = np.zeros(max(table.values()) + 1, np.int64)
    for token, rank in table.items():
        lengths[rank] = len(token)
    return tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=table, special_tokens={}), lengths


def line_ends(text: bytes) -> np.ndarray:
    """Byte offsets after each line; a line break belongs to the line that it ends."""
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1
    return ends if len(ends) and ends[-1] == len(text) else np.append(ends, len(text))


def attribute(starts: np.ndarray, ends: np.ndarray, borders: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens (by byte span) per section (by its end), and how many tokens of it cross its end."""
    first = np.searchsorted(borders, starts, side="right")
    last = np.searchsorted(borders, ends - 1, side="right")
    crossing = np.bincount(first[last > first], minlength=len(borders))
    counts = np.bincount(first, minlength=len(borders)).astype(float)
    if rule != "start":
        for token in np.flatnonzero(last > first):
            over = np.arange(first[token], last[token] + 1)
            low = np.concatenate([[starts[token]], borders[over[:-1]]])
            high = np.concatenate([borders[over[:-1]], [ends[token]]])
            counts[first[token]] -= 1
            if rule == "most":
                counts[over[np.argmax(high - low)]] += 1
            else:
                counts[over] += (high - low) / (ends[token] - starts[token])
    return counts, crossing


def section_tokens(
    docs: DataFrame, keep: list[str], text: str = "text", sections: str | None = None, rule: str = "start",
    tokenizer: str = TOKENIZER, pattern: str = PATTERN,
) -> DataFrame:
    """``keep`` columns with one row per section: section, start, end (code points), tokens, crossing.

    Sections are the lines of the text, or the array column ``sections`` of rising end offsets in
    code points, the last of which is taken as the end of the text.  A null or empty text has one
    empty section without tokens.  Repeated rows come out repeated; other columns are not read.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary(docs.sparkSession, tokenizer))
    given = F.col(sections).cast("array<long>") if sections else F.lit(None).cast("array<long>")
    rows = docs.select(F.coalesce(F.col(text), F.lit("")).cast("binary").alias("_text"), given.alias("_sections"), *keep)
    kind = pa.list_(pa.struct([("section", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("tokens", pa.float64()), ("crossing", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, lengths = _encoding(shared.value, pattern)
        for batch in batches:
            for part in range(0, batch.num_rows, 500):
                some = batch.slice(part, 500)
                fields: list[list[np.ndarray]] = [[] for _ in range(5)]
                sizes = []
                for raw, wanted in zip(some.column(0), some.column(1)):
                    data = raw.as_py()
                    char = np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80) if data else np.zeros(0, np.int64)
                    if wanted.is_valid:
                        # The byte at which the n-th code point ends.
                        asked = np.array([v for v in wanted.as_py() or [] if v is not None], np.int64)
                        borders = np.append(np.searchsorted(char, asked[asked < (char[-1] if len(char) else 0)], side="right"), len(data))
                    else:
                        borders = line_ends(data)
                    ids = np.asarray(encoding.encode_ordinary(data.decode("utf-8", "replace")), np.int64)
                    ends = np.cumsum(lengths[ids]) if len(ids) else np.zeros(0, np.int64)
                    counts, crossing = attribute(ends - lengths[ids] if len(ids) else ends, ends, borders, rule)
                    at = np.concatenate([[0], char])[borders]
                    for values, new in zip(fields, (np.arange(len(borders)), np.concatenate([[0], at[:-1]]), at, counts, crossing)):
                        values.append(new)
                    sizes.append(len(borders))
                joined = [np.concatenate(v) for v in fields]
                items = pa.StructArray.from_arrays(
                    [pa.array(joined[0].astype(np.int32)), pa.array(joined[1].astype(np.int64)), pa.array(joined[2].astype(np.int64)), pa.array(joined[3]), pa.array(joined[4].astype(np.int64))],
                    fields=list(kind.value_type),
                )
                offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
                yield pa.RecordBatch.from_arrays([*some.columns[2:], pa.ListArray.from_arrays(offsets, items)], names=[*keep, "_found"])

    schema = T.StructType([*docs.select(*keep).schema.fields, T.StructField("_found", T.ArrayType(SECTION))])
    return rows.mapInArrow(run, schema).select(*keep, F.inline("_found"))
