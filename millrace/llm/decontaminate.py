"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are the 13-word windows of the benchmark items (an item with fewer words is one window).
A shift table over blocks of two words says how far a search may jump when a block occurs in no
window or only away from its end; blocks that end a window lead to a bucket of candidates by
first and last block, which are compared word by word.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from millrace.llm.common import fresh, materialise

# Words after lower-casing A-Z: digits, letters and everything beyond ASCII.
_WORD = re.compile(rb"[a-z0-9\x80-\xff]+")
WINDOW = 13
# Benchmarks above this many bytes of text are searched for in several passes.
BROADCAST_BYTES = 32 * 1024 * 1024

FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)


def words_of(text: bytes | None) -> list[bytes]:
    return _WORD.findall(text.lower()) if text else []


class WuManber:
    """Shift tables and buckets, one set for each window length that occurs."""

    def __init__(self, items: Iterable[tuple[str | None, bytes | None]], window: int = WINDOW):
        owners: dict[tuple[bytes, ...], set[str]] = {}
        for item, text in items:
            words = words_of(text)
            for start in range(max(1, len(words) - window + 1) if words else 0):
                owners.setdefault(tuple(words[start : start + window]), set()).update([] if item is None else [item])
        by_length: dict[int, list[tuple[bytes, ...]]] = defaultdict(list)
        for pattern in owners:
            by_length[len(pattern)].append(pattern)
        self.tables = [(n, *self._table(n, patterns, owners)) for n, patterns in sorted(by_length.items())]

    @staticmethod
    def _table(n: int, patterns: list[tuple[bytes, ...]], owners):
        block = min(2, n)
        shifts: dict[tuple[bytes, ...], int] = {}
        buckets: dict[tuple[bytes, ...], dict[tuple[bytes, ...], list]] = defaultdict(lambda: defaultdict(list))
        for pattern in patterns:
            for end in range(block, n + 1):
                key = pattern[end - block : end]
                shifts[key] = min(shifts.get(key, n), n - end)
            buckets[pattern[n - block :]][pattern[:block]].append((list(pattern), owners[pattern]))
        return block, shifts, {k: dict(v) for k, v in buckets.items()}

    def search(self, words: Sequence[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged spans of words inside occurrences, and the items that occur."""
        hits: list[tuple[int, int]] = []
        items: set[str] = set()
        count = len(words)
        for n, block, shifts, buckets in self.tables:
            jump, far, back = shifts.get, n - block + 1, block - 1
            end = n - 1
            while end < count:
                tail = (words[end - 1], words[end]) if back else (words[end],)
                step = jump(tail, far)
                if step:
                    end += step
                    continue
                start = end - n + 1
                head = (words[start], words[start + 1]) if back else tail
                for pattern, owners in buckets[tail].get(head, ()):
                    if words[start : end + 1] == pattern:
                        hits.append((start, end + 1))
                        items |= owners
                end += 1
        return merged(hits), items


def merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _mark(docs: DataFrame, text: str, into: str, items: list[tuple[str | None, bytes | None]], window: int) -> DataFrame:
    """``docs`` with column ``into`` (FOUND), to which an earlier pass may have added already."""
    shared = docs.sparkSession.sparkContext.broadcast(items)
    again = into in docs.columns
    schema = docs.schema if again else T.StructType([*docs.schema.fields, T.StructField(into, FOUND)])
    kind = pa.struct(
        [("n_words", pa.int64()), ("n_hit", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), ("items", pa.list_(pa.string()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = WuManber(shared.value, window)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text)).cast(pa.binary())
            earlier = batch.column(batch.schema.get_field_index(into)).to_pylist() if again else [None] * batch.num_rows
            found = []
            for value, before in zip(texts, earlier):
                words = words_of(value.as_py())
                spans, names = searcher.search(words)
                if before:
                    spans = merged([*spans, *((s["start"], s["end"]) for s in before["spans"])])
                    names = names.union(before["items"])
                found.append(
                    {"n_words": len(words), "n_hit": sum(e - s for s, e in spans), "spans": [{"start": s, "end": e} for s, e in spans], "items": sorted(names)}
                )
            kept = [batch.column(i) for i, n in enumerate(batch.schema.names) if n != into]
            names = [n for n in batch.schema.names if n != into]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(found, kind)], names=[*names, into])

    return docs.mapInArrow(run, schema)


def find_occurrences(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", into: str = "found", window: int = WINDOW,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``docs`` with a struct ``into``: n_words, n_hit, merged word spans and the ids of occurring items.

    The benchmark is shipped to the executors when its texts are below ``broadcast_bytes``;
    a larger one is cut into parts below that size and searched for part by part, each pass
    adding to what the one before wrote.  Null and empty texts have no words.  Items without an
    id mark words but are not counted; repeated items count once.  ``into`` must be a new name.
    """
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("binary").alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-int(size) // broadcast_bytes))
    for part in range(parts):
        own = items if parts == 1 else items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part)
        docs = _mark(docs, text, into, [(r["item_id"], bytes(r["text"]) if r["text"] is not None else None) for r in own.collect()], window)
        docs = docs if parts == 1 else materialise(docs, "decontaminate")
    return docs


def is_contaminated(found: str, parts: int = 20):
    """At least one word hit, and hit words times ``parts`` reach the words of the document."""
    hit, words = F.col(found)["n_hit"], F.col(found)["n_words"]
    return (hit > 0) & (parts * hit >= words)


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents that are not contaminated, with all their columns."""
    found = fresh("found", docs.columns)
    return find_occurrences(docs, benchmark, into=found).filter(~is_contaminated(found)).drop(found)
