"""Fill-in-middle transformation with cut points found in a Fenwick tree.

A text is cut into blocks of BLOCK bytes.  A Fenwick tree over the blocks holds how many units
start in each and how many code points.  The cut before unit k is found by a binary-lifting
descent to the block that holds its start, which also sums the code points passed, and then
inside that one block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

BLOCK = 512
# Sentinels of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
# Of 100 texts so many are transformed, and of 100 of these so many have the suffix first.
INFILL_PERCENT, SUFFIX_FIRST_PERCENT = 90, 20
# Output bytes that are handed on together.
GO_BYTES = 2 << 20

_LETTER = np.zeros(256, bool)
_LETTER[ord("A") : ord("Z") + 1] = _LETTER[ord("a") : ord("z") + 1] = True

RESULT = T.StructType(
    [
        T.StructField("n", T.LongType()),
        T.StructField("form", T.StringType()),
        T.StructField("prefix_chars", T.LongType()),
        T.StructField("middle_chars", T.LongType()),
        T.StructField("output", T.StringType()),
    ]
)
_RESULT = pa.struct([("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())])


class Cuts:
    """Units of a text (runs of A-Z and a-z, every other code point by itself) and where they start."""

    def __init__(self, text: bytes, block: int = BLOCK):
        data = np.frombuffer(text, np.uint8)
        self.bytes, self.block = len(text), block
        points = (data & 0xC0) != 0x80
        letter = _LETTER[data]
        self.starts = points.copy()
        # A letter after a letter goes on with the run.
        self.starts[1:] &= ~(letter[1:] & letter[:-1])
        self.points = points
        firsts = np.arange(0, len(text), block)
        self.units, self.n = self._tree(self.starts, firsts)
        self.chars, self.n_chars = self._tree(points, firsts)

    @staticmethod
    def _tree(flags: np.ndarray, firsts: np.ndarray) -> tuple[list[int], int]:
        """Cell i holds the sum of the last i & -i of the first i blocks."""
        upto = np.concatenate([[0], np.cumsum(np.add.reduceat(flags, firsts, dtype=np.int64))]) if len(firsts) else np.zeros(1, np.int64)
        cell = np.arange(len(upto))
        return (upto - upto[cell - (cell & -cell)]).tolist(), int(upto[-1])

    def before(self, unit: int) -> tuple[int, int]:
        """Bytes and code points before the given unit, or of the whole text if it has no more units."""
        if unit >= self.n:
            return self.bytes, self.n_chars
        at, left, passed = 0, unit, 0
        step = 1 << (len(self.units) - 1).bit_length()
        while step:
            to = at + step
            if to < len(self.units) and self.units[to] <= left:
                at, left, passed = to, left - self.units[to], passed + self.chars[to]
            step >>= 1
        first = at * self.block
        inside = int(np.flatnonzero(self.starts[first : first + self.block])[left])
        return first + inside, passed + int(np.count_nonzero(self.points[first : first + inside]))


def choices(doc: str, seed: int) -> list[int]:
    """Four numbers that seed and id decide."""
    key = hashlib.sha256(f"{seed}:{doc}".encode()).hexdigest()
    return [int(key[8 * k : 8 * k + 8], 16) for k in range(4)]


def transform(text: bytes, doc: str, seed: int) -> tuple[int, str, int | None, int | None, bytes]:
    """n, form, code points of prefix and middle, output."""
    cuts = Cuts(text)
    h1, h2, h3, h4 = choices(doc, seed)
    if not text or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= INFILL_PERCENT:
        return cuts.n, "plain", None, None, text
    one, two = sorted((h1 % (cuts.n + 1), h2 % (cuts.n + 1)))
    (left, left_chars), (right, right_chars) = cuts.before(one), cuts.before(two)
    prefix, middle, suffix = text[:left], text[left:right], text[right:]
    if h4 % 100 < SUFFIX_FIRST_PERCENT:
        form, output = "spm", SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle
    else:
        form, output = "psm", PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle
    return cuts.n, form, left_chars, right_chars - left_chars, output


def infill(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", into: str = "infill", seed: int = 1) -> DataFrame:
    """``docs`` without its text and with a struct ``into``: n units, form, prefix_chars, middle_chars and the output text.

    The choices hang on seed and id alone, so reruns and other partitions agree.  A null text is
    an empty one; empty texts and those that hold a sentinel stay plain.  A null id counts as an
    empty string, equal rows get equal results, an empty table gives none.  A column already
    called ``into`` is replaced.
    """
    kept = [c for c in docs.columns if c != text and c.lower() != into.lower()]
    schema = T.StructType([*docs.select(*kept).schema.fields, T.StructField(into, RESULT)])
    own = F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id")
    rows = docs.select(*kept, F.struct(own, F.col(text).cast("binary").alias("text")).alias(into))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(len(kept)).flatten()
            first, size, found = 0, 0, []

            def go(last: int) -> pa.RecordBatch:
                columns = [batch.column(i).slice(first, last - first) for i in range(len(kept))]
                parts = list(zip(*found))
                cells = [pa.array(p, pa.int64() if k in (0, 2, 3) else pa.string() if k == 1 else pa.binary()) for k, p in enumerate(parts)]
                cells[4] = cells[4].cast(pa.string(), safe=False)
                return pa.RecordBatch.from_arrays([*columns, pa.StructArray.from_arrays(cells, fields=list(_RESULT))], names=[*kept, into])

            for at, (doc, value) in enumerate(zip(ids, texts)):
                found.append(transform(value.as_py() or b"", doc.as_py(), seed))
                size += len(found[-1][4])
                if size > GO_BYTES or at + 1 == batch.num_rows:
                    yield go(at + 1)
                    first, size, found = at + 1, 0, []

    return rows.mapInArrow(run, schema)


def restored(output: str | Column, form: str | Column) -> Column:
    """The text that an output was made of.  A text has no sentinels, so they cut an output in one way only."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    marks = "|".join(m.decode() for m in (PREFIX, SUFFIX, MIDDLE))
    part = F.split(output, marks, -1)
    return (
        F.when(form == "psm", F.concat(part[1], part[3], part[2]))
        .when(form == "spm", F.concat(part[2], part[3], part[1]))
        .otherwise(output)
    )
