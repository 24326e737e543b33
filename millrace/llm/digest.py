"""Document fingerprints: quartile bucket digests of hashed byte triplets.

The triplets in a sliding window of five bytes are hashed into BUCKETS counters.  A counter
becomes two bits, its quartile among the counters of its document; a length code follows.
Equal texts have equal digests; the distance of two digests is the sum of quartile steps plus a
bounded step for the lengths.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

BUCKETS = 256
# Triplets (first, second, third) within a window of five bytes.
TRIPLETS = ((0, 1, 2), (0, 1, 3), (0, 2, 3), (0, 1, 4), (0, 2, 4), (0, 3, 4))
LENGTH_STEPS = 32
# Bytes that are counted in one go; a longer text is a go of its own.
GO_BYTES = 2 << 20


def quartile_codes(texts: Sequence[bytes]) -> np.ndarray:
    """One row of BUCKETS quartile codes (0 to 3) and a length code for each text."""
    counts = np.zeros((len(texts), BUCKETS), np.int64)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    first = 0
    while first < len(texts):
        last, size = first + 1, sizes[first]
        while last < len(texts) and size + sizes[last] <= GO_BYTES:
            size += sizes[last]
            last += 1
        joined = np.frombuffer(b"".join(texts[first:last]), np.uint8).astype(np.uint32)
        owner = np.repeat(np.arange(last - first), sizes[first:last])
        for salt, places in enumerate(TRIPLETS):
            reach = len(joined) - places[2]
            if reach <= 0:
                continue
            a, b, c = (joined[p : p + reach] for p in places)
            bucket = (((a << 16) | (b << 8) | c) * np.uint32(2654435761) + np.uint32(salt * 40503 * 65537 & 0xFFFFFFFF)) >> np.uint32(24)
            same = owner[:reach] == owner[places[2] :]
            cell = owner[:reach] * BUCKETS + bucket
            counts[first:last] += np.bincount(cell[same], minlength=(last - first) * BUCKETS).reshape(-1, BUCKETS)
        first = last
    ordered = np.sort(counts, axis=1)
    codes = np.zeros((len(texts), BUCKETS + 1), np.uint8)
    for quarter in (1, 2, 3):
        codes[:, :BUCKETS] += counts > ordered[:, [BUCKETS * quarter // 4 - 1]]
    codes[:, BUCKETS] = np.minimum(255, np.floor(8 * np.log2(sizes + 1.0)))
    return codes


def as_hex(codes: np.ndarray) -> list[str]:
    """Length code, then four quartile codes a byte."""
    quarters = codes[:, :BUCKETS].reshape(len(codes), -1, 4)
    packed = quarters[:, :, 0] << 6 | quarters[:, :, 1] << 4 | quarters[:, :, 2] << 2 | quarters[:, :, 3]
    return [bytes(row).hex() for row in np.concatenate([codes[:, BUCKETS:], packed], axis=1)]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """1 minus the bounded difference score of two rows of codes, from 0 to 1; equal rows have 1."""
    x, y = a.astype(np.int16), b.astype(np.int16)
    steps = np.abs(x[:, :BUCKETS] - y[:, :BUCKETS]).sum(axis=1)
    length = np.minimum(LENGTH_STEPS, np.abs(x[:, BUCKETS] - y[:, BUCKETS]))
    return 1.0 - (steps + length) / (3.0 * BUCKETS + LENGTH_STEPS)


def _finish(rows: list[tuple], after: tuple) -> dict:
    """Result columns of consecutive ``rows`` (id, text) whose last one is followed by ``after``."""
    texts = [r[1].decode("utf-8", "replace") for r in rows]
    following = [*texts[1:], after[1].decode("utf-8", "replace")]
    edited = [t[: len(t) - len(t) // 3] + n[: len(t) // 3] for t, n in zip(texts, following)]
    edited_bytes = [t.encode("utf-8", "replace") for t in edited]
    own = quartile_codes([*(r[1] for r in rows), after[1]])
    changed = quartile_codes(edited_bytes)
    return {
        "doc_id": [r[0] for r in rows],
        "n_chars": [len(t) for t in texts],
        "edited_sha256": [hashlib.sha256(t).hexdigest() for t in edited_bytes],
        "fingerprint": as_hex(own[:-1]),
        "edited_fingerprint": as_hex(changed),
        "near_edited": likeness(own[:-1], changed).tolist(),
        "near_next": likeness(own[:-1], own[1:]).tolist(),
    }


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Walk blocks of rows in descending id; each row meets the next one, a block's last its helper."""
    out = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), *((n, pa.string()) for n in ("edited_sha256", "fingerprint", "edited_fingerprint")), ("near_edited", pa.float64()), ("near_next", pa.float64())])
    held: list[tuple] = []
    size, block, first, closed = 0, None, None, False

    def close():
        nonlocal held, size
        if held:
            # Without a helper the block is the whole table, whose last row is followed by the first.
            yield pa.RecordBatch.from_pydict(_finish(held, first), schema=out)
        held, size = [], 0

    for batch in batches:
        blocks, helpers, ids = (batch.column(i).to_pylist() for i in range(3))
        for at, helper, doc, text in zip(blocks, helpers, ids, batch.column(3)):
            if at != block:
                yield from close()
                block, first, closed = at, None, False
            row = (doc, text.as_py() or b"")
            if helper:
                if held and not closed:
                    yield pa.RecordBatch.from_pydict(_finish(held, row), schema=out)
                    held, size = [], 0
                closed = True
                continue
            first = first or row
            if size > GO_BYTES:
                yield pa.RecordBatch.from_pydict(_finish(held, row), schema=out)
                held, size = [], 0
            held.append(row)
            size += len(row[1])
    yield from close()


def fingerprints(docs: DataFrame, blocks: int | None = None) -> DataFrame:
    """Fingerprint of every text and of its edit with the next document, by descending doc_id.

    Quantiles of the ids cut the table into blocks; the first row of a block also goes to the
    block before it as a helper, so each text moves once and no block needs another one.  A task
    walks its sorted blocks and holds a few megabytes.  Null texts are empty; repeated ids
    follow one another by a digest of their texts, null ids come last.  An empty table gives none.
    """
    spark = docs.sparkSession
    blocks = blocks or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    lowest = -(2**63)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    cuts = [i / blocks for i in range(1, blocks)]
    ends = rows.agg(F.max("doc_id").alias("top"), F.percentile_approx("doc_id", cuts or [0.5], 100_000).alias("cuts")).first()
    bounds = [] if ends["top"] is None else [ends["top"], *sorted({c for c in ends["cuts"] or [] if c < ends["top"]}, reverse=True)]
    ascending = np.array(bounds[:0:-1], np.int64)
    heads, last = set(bounds), max(0, len(bounds) - 1)

    @F.pandas_udf("array<int>")
    def places(ids):
        own = last - np.searchsorted(ascending, ids.to_numpy(), side="left")
        import pandas as pd

        return pd.Series([[k, (k - 1) % (last + 1)] if i in heads else [k] for i, k in zip(ids.tolist(), own.tolist())])

    dealt = rows.select(
        F.posexplode(places(F.coalesce("doc_id", F.lit(lowest)))).alias("helper", "block"), "doc_id", "text"
    )
    return (
        dealt.repartition("block")
        .sortWithinPartitions("block", "helper", F.col("doc_id").desc_nulls_last(), F.xxhash64("text"))
        .select("block", "helper", "doc_id", "text")
        .mapInArrow(_scan, SCHEMA)
    )
