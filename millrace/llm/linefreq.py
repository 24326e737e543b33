"""Quality rules by cross-document line frequency.

Lines are normalised and hashed; a line that many different documents of one host hold is
furniture of that host and goes.  A document that loses too much of itself is rejected, as is one
that fails the base rules on its own.  Copies of a text count as one document, so a line is not
furniture because one page was crawled often; copies are the concern of near-duplicate operators.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from millrace.llm.common import fresh, materialise
from millrace.plans.durable import written_bytes
from millrace.plans.skew import hot_key_join, null_safe_join

# Windows of so many words count as repeated when they occur twice in a text.
REPEAT_WORDS = 8
# Base rules: at least so many words, at most so many percent of them in repeated windows.
LEAST_WORDS = 20
MOST_REPEATED = 30
# A line goes when at least LINE_DOCS different documents and LINE_SHARE of a host's documents hold it.
LINE_DOCS = 4
LINE_SHARE = 0.05
# A document is depleted when less than this share of its words, or fewer than LEAST_WORDS, are left.
LEFT_SHARE = 0.5
# Bytes of text whose words are numbered together; a longer text is numbered alone.
GO_BYTES = 2 << 20
# Written tables are broadcast up to this size on disk; larger ones are shuffled.
BROADCAST_BYTES = 8 << 20

_SPACES = b"\t\n\x0b\x0c\r "
_CONTINUATION = bytes(range(0x80, 0xC0))
_SYMBOLS = b"#*$%&|<>"
_DIGITS = bytes.maketrans(b"123456789", b"000000000")

LINE = T.StructType([T.StructField("at", T.IntegerType()), T.StructField("words", T.IntegerType()), T.StructField("hi", T.LongType()), T.StructField("lo", T.LongType())])
_LINE = pa.struct([("at", pa.int32()), ("words", pa.int32()), ("hi", pa.int64()), ("lo", pa.int64())])
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
TEXT = ("host", "text_hi", "text_lo")


def normalised(line: bytes) -> bytes:
    """A-Z lower-cased, digits as 0, white space as one space, trimmed."""
    return b" ".join(line.lower().translate(_DIGITS).split())


def digest(value: bytes) -> tuple[int, int]:
    """128 bits as two signed numbers."""
    both = hashlib.blake2b(value, digest_size=16).digest()
    return int.from_bytes(both[:8], "little", signed=True), int.from_bytes(both[8:], "little", signed=True)


def repeated_words(ids: np.ndarray, sizes: np.ndarray, width: int = REPEAT_WORDS) -> np.ndarray:
    """Words of each text inside windows of ``width`` words that the text holds twice or more.

    ``ids`` are the word numbers of all texts in a row.  Runs of two, four, eight words get
    numbers from pairs of shorter runs, so equal numbers are equal runs and nothing is hashed.
    """
    owner = np.repeat(np.arange(len(sizes)), sizes)
    runs, length = ids.astype(np.int64), 1
    while length < width:
        # Two runs that overlap give the last step of a width that is no power of two.
        step = min(length, width - length)
        if len(runs) <= step:
            return np.zeros(len(sizes), np.int64)
        pair = runs[:-step] * (int(runs.max()) + 1) + runs[step:]
        runs, length = np.unique(pair, return_inverse=True)[1], length + step
    inside = owner[: len(runs)] == owner[width - 1 :]
    starts = np.flatnonzero(inside)
    if not len(starts):
        return np.zeros(len(sizes), np.int64)
    key = owner[starts] * (int(runs.max()) + 1) + runs[starts]
    _, back, times = np.unique(key, return_inverse=True, return_counts=True)
    starts = starts[times[back] > 1]
    edges = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + width, -1)
    covered = np.cumsum(edges[:-1]) > 0
    return np.bincount(owner[covered], minlength=len(sizes))


def _slices(column: pa.Array) -> Iterator[list[bytes]]:
    held, size = [], 0
    for value in column:
        text = value.as_py() or b""
        if held and size + len(text) > GO_BYTES:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held


def _describe(texts: list[bytes]) -> dict[str, list]:
    numbers: dict[bytes, int] = {}
    parts, out = [], {n: [] for n in (*COUNTS, "text_hi", "text_lo", "lines")}
    for text in texts:
        words = text.split()
        parts.append(np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words)))
        out["n_words"].append(len(words))
        out["word_chars"].append(len(text.translate(None, _SPACES + _CONTINUATION)))
        out["n_symbols"].append(len(text) - len(text.translate(None, _SYMBOLS)))
        raw, lines, repeats = set(), [], 0
        for at, line in enumerate(text.split(b"\n")):
            count = len(line.split())
            if not count:
                continue
            repeats += line in raw
            raw.add(line)
            lines.append((at, count, *digest(normalised(line))))
        out["n_dup_lines"].append(repeats)
        out["lines"].append([dict(zip(("at", "words", "hi", "lo"), line)) for line in lines])
        hi, lo = digest(text)
        out["text_hi"].append(hi)
        out["text_lo"].append(lo)
    sizes = np.array(out["n_words"], np.int64)
    ids = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    out["n_repeat_words"] = repeated_words(ids, sizes).tolist()
    return out


def describe(rows: DataFrame) -> DataFrame:
    """Columns ``row``, ``host`` and ``text`` of ``rows`` become row, host, base counts, a text digest and the hashed lines.

    Words are runs of other characters than space and \t \n \v \f \r.  Lines without a word are
    left out; ``at`` is a line's number in the text.  A null text has no words and no lines.
    """
    numbers = [*COUNTS, *TEXT[1:]]
    types = [*(T.StructField(n, T.LongType()) for n in numbers), T.StructField("lines", T.ArrayType(LINE))]
    schema = T.StructType([*rows.select("row", "host").schema.fields, *types])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = 0
            for texts in _slices(batch.column(2)):
                found = _describe(texts)
                own = [batch.column(i).slice(first, len(texts)) for i in (0, 1)]
                arrays = [pa.array(found[n], pa.int64()) for n in numbers] + [pa.array(found["lines"], pa.list_(_LINE))]
                yield pa.RecordBatch.from_arrays([*own, *arrays], names=["row", "host", *numbers, "lines"])
                first += len(texts)

    return rows.select("row", "host", F.col("text").cast("binary").alias("text")).mapInArrow(run, schema)


def base_failed():
    """Too few words, or too many of them in repeated windows."""
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def distinct_texts(described: DataFrame) -> DataFrame:
    """One row (host, text_hi, text_lo, lines) for each different text of a host; copies merge on the map side."""
    return materialise(described.groupBy(*TEXT).agg(F.first("lines").alias("lines")), "line-texts")


def frequent_lines(texts: DataFrame, line_docs: int = LINE_DOCS, line_share: float = LINE_SHARE) -> DataFrame:
    """Lines above the limits: host, hi, lo, n_docs.

    A text holds a line once.  Lines and texts are counted on the map side, so a hot host or line
    costs a row a task.
    """
    pair = F.array_distinct(F.transform("lines", lambda line: F.struct(line["hi"].alias("hi"), line["lo"].alias("lo"))))
    held = texts.select("host", F.explode(pair).alias("line"))
    counts = held.groupBy("host", "line.hi", "line.lo").agg(F.count(F.lit(1)).alias("n_docs")).filter(F.col("n_docs") >= line_docs)
    hosts = materialise(texts.groupBy("host").agg(F.count(F.lit(1)).alias("host_docs")), "line-hosts")
    above = null_safe_join(counts, _sized(hosts), ["host"]).filter(F.col("n_docs") >= line_share * F.col("host_docs"))
    return materialise(above.select("host", "hi", "lo", "n_docs"), "lines-frequent")


def _sized(table: DataFrame) -> DataFrame:
    return F.broadcast(table) if written_bytes(table) <= BROADCAST_BYTES else table


def removals(texts: DataFrame, frequent: DataFrame) -> DataFrame:
    """Numbers and words of the frequent lines of every text that holds some: removed, removed_words.

    A line that many documents hold is a hot key of this join.  All frequent lines are broadcast
    where they are few; else the hottest are and only the others' places are shuffled.
    """
    places = texts.select(*TEXT, F.explode("lines").alias("line")).select(*TEXT, "line.hi", "line.lo", "line.at", "line.words")
    on = ["host", "hi", "lo"]
    if written_bytes(frequent) <= BROADCAST_BYTES:
        marked = null_safe_join(places, F.broadcast(frequent.drop("n_docs")), on)
    else:
        total = texts.agg(F.sum(F.size("lines"))).first()[0] or 0
        marked = hot_key_join(places, frequent, on, "n_docs", total)
    gone = marked.groupBy(*TEXT).agg(F.array_sort(F.collect_list("at")).alias("removed"), F.sum("words").alias("removed_words"))
    return materialise(gone, "line-removals")


def line_rules(
    docs: DataFrame, text: str = "text", host: str = "source", into: str = "quality",
    line_docs: int = LINE_DOCS, line_share: float = LINE_SHARE, left_share: float = LEFT_SHARE, cleaned: bool = True,
) -> DataFrame:
    """``docs`` without the removed lines in ``text``, and a struct ``into``: the base counts, ``base_failed``, ``removed`` line numbers, ``left_words``, ``kept``.

    A line is removed when at least ``line_docs`` different texts of its host and ``line_share``
    of them hold it.  ``kept`` is false for rows that fail the base rules and for depleted ones,
    with less than ``left_share`` of their words or fewer than LEAST_WORDS left.  With ``cleaned`` false the text column is
    left out and no text is written.

    A null host is a host of its own.  Null and empty texts have no words and fail; a null text
    stays null.  Equal rows and copies get equal results.  An empty table gives none.  ``into``
    replaces a column called so; other names of ``docs`` don't matter.
    """
    names = [c for c in docs.columns if c.lower() != into.lower() and (cleaned or c != text)]
    row = F.struct(*[F.col(c) for c in names], F.lit(0).alias(fresh("nothing", names)))
    described = materialise(describe(docs.select(row.alias("row"), F.col(host).alias("host"), F.col(text).alias("text"))), "line-described")
    texts = distinct_texts(described)
    gone = removals(texts, frequent_lines(texts, line_docs, line_share))
    # Beyond the size of a broadcast, copies of one text meet its row by a shuffle that AQE splits.
    marked = null_safe_join(described.drop("lines"), _sized(gone), TEXT, "left")
    left = F.col("n_words") - F.coalesce("removed_words", F.lit(0))
    quality = F.struct(
        *COUNTS, base_failed().alias("base_failed"), F.coalesce("removed", F.array().cast("array<int>")).alias("removed"),
        left.alias("left_words"), (~base_failed() & (left >= left_share * F.col("n_words")) & (left >= LEAST_WORDS)).alias("kept"),
    )
    lines = F.split(F.col("row")[text], "\n", -1) if cleaned else None
    rest = F.array_join(F.filter(lines, lambda _, at: ~F.array_contains("removed", at)), "\n") if cleaned else None
    own = [F.when(F.col("removed").isNull(), F.col("row")[c]).otherwise(rest).alias(c) if c == text else F.col("row")[c].alias(c) for c in names]
    return marked.select(*own, quality.alias(into))


def clean_documents(docs: DataFrame, text: str = "text", host: str = "source", **limits) -> DataFrame:
    """Documents that are kept, with all their columns, their text without the removed lines."""
    into = fresh("quality", docs.columns)
    return line_rules(docs, text, host, into, **limits).filter(F.col(into)["kept"]).drop(into)
