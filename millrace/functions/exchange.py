"""Digests that batches of texts send to parts of the digest range, and what the parts answer.

A batch of some megabytes of text tells each part its own distinct digests once, sorted and packed,
so neither n-grams nor a row for each of them are shuffled.  The module is pickled by value so that
executors need no copy of the package.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Texts worked on together have about so many bytes; a longer one is alone.
SLICE_BYTES = 4 << 20
# Digests are dealt into parts of at most PART_MOST, and into up to PARTS where each has PART_LEAST.
PARTS, PART_LEAST, PART_MOST = 256, 20_000, 2_000_000


def parts_for(digests: int) -> int:
    return max(1, min(PARTS, digests // PART_LEAST), -(-digests // PART_MOST))


def sliced(batches: Iterator[pa.RecordBatch], text: int, together: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of batches whose texts (column number ``text``) have about ``together`` bytes."""
    import pyarrow.compute as pc

    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(sizes)
        first = 0
        while first < batch.num_rows:
            before = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + together, side="right")))
            yield batch.slice(first, last - first)
            first = last


def pack(numbers: np.ndarray) -> bytes:
    """Numbers by byte planes, compressed."""
    planes = np.ascontiguousarray(numbers).view(np.uint8).reshape(len(numbers), numbers.itemsize).T
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpack(data: bytes, size: int, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(data, size * width, codec="zstd"), np.uint8).reshape(width, size)
    return np.ascontiguousarray(planes.T).view(kind).reshape(size)


def pack_rising(digests: np.ndarray) -> bytes:
    return pack(np.diff(digests, prepend=np.uint64(0)))


def unpack_rising(data: bytes, size: int) -> np.ndarray:
    return np.cumsum(unpack(data, size, np.uint64), dtype=np.uint64)


def cuts(digests: np.ndarray, parts: int) -> list[tuple[int, int, int]]:
    """(part, begin, end) of the parts that rising ``digests`` fall into."""
    width = (1 << 64) // parts + 1
    at = np.searchsorted(digests, np.array([k * width for k in range(1, parts)], np.uint64))
    at = np.concatenate([[0], at, [len(digests)]]).astype(np.int64)
    return [(int(k), int(at[k]), int(at[k + 1])) for k in np.flatnonzero(np.diff(at))]


def runs(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal pairs together by rising x, and where each new pair begins in it."""
    order = np.argsort(x, kind="stable")
    left, right = x[order], y[order]
    same = left[1:] == left[:-1]
    if (same & (right[1:] != right[:-1])).any():
        order = np.lexsort((y, x))
        left, right = x[order], y[order]
        same = left[1:] == left[:-1]
    new = np.concatenate([np.ones(min(1, len(x)), np.bool_), ~same | (right[1:] != right[:-1])])
    return order, np.flatnonzero(new)


class Words:
    """The words of some texts: their number in each text, and two hashes of every word."""

    def __init__(self, sizes: np.ndarray, ids: np.ndarray, hashes: np.ndarray):
        self.sizes = sizes
        self.x = hashes[:, 0][ids] if len(ids) else np.zeros(0, np.uint64)
        self.y = hashes[:, 1][ids] if len(ids) else np.zeros(0, np.uint64)
        self.text_of = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)

    @staticmethod
    def read(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words per text, word numbers and the hashes of the distinct words."""
        from hashlib import blake2b

        numbers, ids, sizes = {}, [], []
        for text in texts:
            words = text.split() if text else []
            sizes.append(len(words))
            ids.append(np.fromiter([numbers.setdefault(w, len(numbers)) for w in words], np.int32, len(words)))
        hashes = b"".join(blake2b(w.encode("utf-8", "surrogatepass"), digest_size=16).digest() for w in numbers)
        flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
        return np.array(sizes, np.int64), flat, np.frombuffer(hashes, np.uint64).reshape(-1, 2)

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Both digests of every n-gram (96 bits), and the text it is in."""
        last = max(0, len(self.x) - n + 1)
        at = np.flatnonzero(self.text_of[:last] == self.text_of[len(self.x) - last :])
        x, y = self.x[at], self.y[at]
        for k in range(1, n):
            x, y = _extended(x, self.x[at + k]), _extended(y, self.y[at + k])
        return x, (y >> np.uint64(32)).astype(np.uint32), self.text_of[at]


def _extended(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    x = context * np.uint64(0x9E3779B97F4A7C15) + word
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def distinct_told(sizes: Sequence[int], parts: int):
    """Arrow helper for rows (group columns, text): for each slice, group, n and part the distinct n-grams.

    A slice's count of all n-grams is on the first of its rows of a group and n.
    """

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, -1):
            names = batch.schema.names[:-1]
            groups: dict[str, list[int]] = {}
            for row, values in enumerate(zip(*[batch.column(c).to_pylist() for c in names])) if names else []:
                groups.setdefault(repr(values), []).append(row)
            texts = batch.column(batch.num_columns - 1).to_pylist()
            for rows in groups.values() if names else [range(batch.num_rows)]:
                words = Words(*Words.read([texts[r] for r in rows]))
                for n in sizes:
                    x, y, _ = words.grams(n)
                    order, new = runs(x, y)
                    first = order[new]
                    x, y, total = x[first], y[first], len(order)
                    out = cuts(x, parts)
                    own = batch.slice(rows[0], 1).select(names).take(pa.array([0] * len(out), pa.int32())) if names else None
                    yield pa.RecordBatch.from_arrays(
                        [
                            *(own.columns if names else []),
                            pa.array([n] * len(out), pa.int32()),
                            pa.array([k for k, _, _ in out], pa.int32()),
                            pa.array([total if k == 0 else 0 for k in range(len(out))], pa.int64()),
                            pa.array([b - a for _, a, b in out], pa.int64()),
                            pa.array([pack_rising(x[a:b]) for _, a, b in out], pa.binary()),
                            pa.array([pack(y[a:b]) for _, a, b in out], pa.binary()),
                        ],
                        names=[*names, "n", "part", "total", "size", "x", "y"],
                    )

    return told


def distinct_in_part(by: Sequence[str]):
    """Arrow helper for the told rows of one group, n and part: how many digests there are, and the total."""

    def run(told: pa.Table) -> pa.Table:
        size = told.column("size").to_pylist()
        x = np.concatenate([unpack_rising(d.as_py(), s) for d, s in zip(told.column("x"), size)])
        y = np.concatenate([unpack(d.as_py(), s, np.uint32) for d, s in zip(told.column("y"), size)])
        found = {"n": told.column("n").slice(0, 1), "distinct": [len(runs(x, y)[1])], "total": [sum(told.column("total").to_pylist())]}
        return pa.table({c: told.column(c).slice(0, 1) for c in by} | found)

    return run


def counted_grams(n: int):
    """Arrow helper for rows (group columns, text): the distinct n-grams of a slice's groups as joined words, with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from collections import Counter

        for batch in sliced(batches, -1):
            names = batch.schema.names[:-1]
            counts: dict[str, tuple[int, Counter]] = {}
            values = zip(*[batch.column(c).to_pylist() for c in names]) if names else [()] * batch.num_rows
            for row, (group, text) in enumerate(zip(values, batch.column(batch.num_columns - 1).to_pylist())):
                words = text.split() if text else []
                counts.setdefault(repr(group), (row, Counter()))[1].update(map(" ".join, zip(*[words[k:] for k in range(n)])))
            for row, found in counts.values():
                own = batch.slice(row, 1).select(names).take(pa.array([0] * len(found), pa.int32())) if names else None
                columns = [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())]
                yield pa.RecordBatch.from_arrays([*(own.columns if names else []), *columns], names=[*names, "_g", "_c"])

    return run


# ---- n-grams of texts against those of all others

BLEU_SIZES = (1, 2, 3, 4)


def _number() -> int:
    """A task numbers its batches from a place of its own."""
    import uuid

    return uuid.uuid4().int >> 66 & ~0xFFFFFFFF


# Between the rows of a repeated key; white space to ``str.split``.
ROW_END = "\x1e"


def word_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, text) to one row for each slice: its keys, and the words of each text (ROW_END apart) of every key."""
    number = _number()
    for batch in sliced(batches, 1):
        texts = [t.split(ROW_END) for t in batch.column(1).to_pylist()]
        of_key = np.repeat(np.arange(len(texts), dtype=np.int32), [len(t) for t in texts])
        sizes, ids, hashes = Words.read([t for rows in texts for t in rows])
        keys = pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), batch.column(0))
        data = (of_key.tobytes(), sizes.tobytes(), pack(ids), hashes.tobytes())
        row = [pa.array([number]), keys, pa.array([len(ids)]), *[pa.array([d], pa.binary()) for d in data]]
        yield pa.RecordBatch.from_arrays(row, names=["batch", "keys", "n_words", "of_key", "sizes", "ids", "hashes"])
        number += 1


def _words_of(row: dict) -> Words:
    hashes = np.frombuffer(row["hashes"], np.uint64).reshape(-1, 2)
    words = Words(np.frombuffer(row["sizes"], np.int64), unpack(row["ids"], row["n_words"], np.int32), hashes)
    words.of_key = np.frombuffer(row["of_key"], np.int32)
    return words


def _in_texts(words: Words, n: int):
    """Distinct digests, and for each key and n-gram of it (by rising digest) the digest's rank, key and count."""
    x, y, text = words.grams(n)
    text = words.of_key[text]
    order, new = runs(x, y)
    rank = np.empty(len(x), np.int64)
    rank[order] = np.repeat(np.arange(len(new)), np.diff(np.append(new, len(x))))
    both, count = np.unique(rank * len(words.sizes) + text, return_counts=True)
    first = order[new]
    texts = max(1, len(words.sizes))
    return x[first], y[first], both // texts, both % texts, count.astype(np.int32)


def _top_two(rank: np.ndarray, count: np.ndarray, many: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest and the second largest count of each rank (0 for none); ``rank`` has every number below ``many``."""
    order = np.lexsort((-count, rank))
    rank, count = rank[order], count[order]
    first = np.searchsorted(rank, np.arange(many))
    second = np.zeros(many, np.int32)
    more = np.flatnonzero(np.diff(np.append(first, len(rank))) > 1)
    second[more] = count[first[more] + 1]
    return count[first] if many else second, second


def tops_told(parts: int):
    """Arrow helper for word batches: for each n and part the digests with their two largest counts in a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                words = _words_of(row)
                for n in BLEU_SIZES:
                    x, y, rank, _, count = _in_texts(words, n)
                    top, second = _top_two(rank, count, len(x))
                    out = cuts(x, parts)
                    packed = [[pack_rising(x[a:b]) for _, a, b in out], *[[pack(z[a:b]) for _, a, b in out] for z in (y, top, second)]]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([n] * len(out), pa.int32()), pa.array([p for p, _, _ in out], pa.int32()),
                            pa.array([row["batch"]] * len(out), pa.int64()), pa.array([b - a for _, a, b in out], pa.int64()),
                            *[pa.array(d, pa.binary()) for d in packed],
                        ],
                        names=["n", "part", "batch", "size", "x", "y", "top", "second"],
                    )

    return run


def tops_answered(told: pa.Table) -> pa.Table:
    """For each row of a part the two largest counts of its digests over all batches."""
    size = told.column("size").to_pylist()
    read = lambda c, kind: np.concatenate([unpack(d.as_py(), s, kind) for d, s in zip(told.column(c), size)])
    x = np.concatenate([unpack_rising(d.as_py(), s) for d, s in zip(told.column("x"), size)])
    order, new = runs(x, read("y", np.uint32))
    del x
    rank = np.empty(len(order), np.int64)
    rank[order] = np.repeat(np.arange(len(new)), np.diff(np.append(new, len(order))))
    tops = _top_two(np.concatenate([rank, rank]), np.concatenate([read("top", np.int32), read("second", np.int32)]), len(new))
    ends = np.cumsum([0, *size])
    packed = [[pack(t[rank[a:b]]) for a, b in zip(ends[:-1], ends[1:])] for t in tops]
    kept = {c: told.column(c) for c in ("n", "part", "batch", "size")}
    return pa.table(kept | {"top": pa.array(packed[0], pa.binary()), "second": pa.array(packed[1], pa.binary())})


def matches_of(own: pa.Table, answers: pa.Table) -> pa.Table:
    """(key, words, matches of each n) of the texts of a batch; texts of one key share their matches.

    Of two equal largest counts one is the second: a count below the largest is clipped by nothing,
    and the largest by the second.
    """
    keys = own.column("keys").combine_chunks().flatten()
    words = _words_of(own.drop_columns("keys").to_pylist()[0])
    rows = sorted(answers.to_pylist(), key=lambda r: (r["n"], r["part"]))
    found = [keys.take(pa.array(words.of_key)), words.sizes]
    for n in BLEU_SIZES:
        mine = [r for r in rows if r["n"] == n]
        top, second = (np.concatenate([np.zeros(0, np.int32), *[unpack(r[c], r["size"], np.int32) for r in mine]]) for c in ("top", "second"))
        _, _, rank, text, count = _in_texts(words, n)
        hits = np.where(count < top[rank], count, second[rank])
        found.append(np.bincount(text, hits, len(keys)).astype(np.int64)[words.of_key])
    return pa.Table.from_arrays([pa.array(c) if isinstance(c, np.ndarray) else c for c in found], names=["key", "_len", *[f"_m{n}" for n in BLEU_SIZES]])


# ---- rows that share an element of their prefix


def prefix_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, mark, n, prefix) to one row for each slice of some megabytes, its numbers as arrays of bytes."""
    number = _number()
    for whole in batches:
        sizes = np.diff(whole.column(3).offsets.to_numpy())
        ends = np.cumsum(sizes)
        first = 0
        while first < whole.num_rows:
            last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + (SLICE_BYTES >> 3), side="right")))
            batch = whole.slice(first, last - first)
            own = pa.StructArray.from_arrays([batch.column(0), batch.column(2)], names=["key", "n"])
            marks, prefix = batch.column(1).to_numpy().tobytes(), batch.column(3).flatten().to_numpy().tobytes()
            rows = pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own)
            row = [pa.array([number]), rows, *[pa.array([d], pa.binary()) for d in (marks, sizes[first:last].astype(np.int64).tobytes(), prefix)]]
            yield pa.RecordBatch.from_arrays(row, names=["batch", "rows", "marks", "sizes", "prefix"])
            first, number = last, number + 1


def buckets_told(parts: int):
    """Arrow helper for prefix batches: for each part the distinct elements with their rows, and the sum of these rows' marks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                prefix, sizes = np.frombuffer(row["prefix"], np.uint64), np.frombuffer(row["sizes"], np.int64)
                marks = np.repeat(np.frombuffer(row["marks"], np.uint64), sizes)
                order = np.argsort(prefix, kind="stable")
                x = prefix[order]
                new = np.flatnonzero(np.concatenate([np.ones(min(1, len(x)), np.bool_), x[1:] != x[:-1]]))
                times = np.diff(np.append(new, len(x))).astype(np.int32)
                total = np.add.reduceat(marks[order], new) if len(new) else marks
                x = x[new]
                out = cuts(x, parts)
                packed = [[pack_rising(x[a:b]) for _, a, b in out], [pack(times[a:b]) for _, a, b in out], [total[a:b].tobytes() for _, a, b in out]]
                numbers = [pa.array([p for p, _, _ in out], pa.int32()), pa.array([row["batch"]] * len(out), pa.int64()), pa.array([b - a for _, a, b in out], pa.int64())]
                yield pa.RecordBatch.from_arrays([*numbers, *[pa.array(d, pa.binary()) for d in packed]], names=["part", "batch", "size", "x", "times", "marks"])

    return run


def buckets_answered(told: pa.Table) -> pa.Table:
    """For each row of a part the sums of marks over all batches, 0 for elements that one row alone holds."""
    size = told.column("size").to_pylist()
    x = np.concatenate([unpack_rising(d.as_py(), s) for d, s in zip(told.column("x"), size)])
    times = np.concatenate([unpack(d.as_py(), s, np.int32) for d, s in zip(told.column("times"), size)])
    marks = np.concatenate([np.frombuffer(d.as_py(), np.uint64) for d in told.column("marks")])
    order = np.argsort(x, kind="stable")
    new = np.flatnonzero(np.concatenate([np.ones(min(1, len(x)), np.bool_), x[order][1:] != x[order][:-1]]))
    many = np.add.reduceat(times[order].astype(np.int64), new)
    # A sum of several marks may be 0 by chance; any other number does as well.
    total = np.where(many > 1, np.maximum(np.add.reduceat(marks[order], new), np.uint64(1)), np.uint64(0))
    whole = np.empty(len(x), np.uint64)
    whole[order] = np.repeat(total, np.diff(np.append(new, len(x))))
    ends = np.cumsum([0, *size])
    kept = {c: told.column(c) for c in ("part", "batch", "size")}
    return pa.table(kept | {"marks": pa.array([pack(whole[a:b]) for a, b in zip(ends[:-1], ends[1:])], pa.binary())})


def memberships(own: pa.Table, answers: pa.Table) -> pa.Table:
    """(key, n, place, bucket) of a batch's rows for elements that several rows hold.

    Of elements with the same rows each row keeps the first, which is the same one in all of them.
    """
    row = own.drop_columns("rows").to_pylist()[0]
    prefix, sizes = np.frombuffer(row["prefix"], np.uint64), np.frombuffer(row["sizes"], np.int64)
    found = sorted(answers.to_pylist(), key=lambda r: r["part"])
    marks = np.concatenate([np.zeros(0, np.uint64), *[unpack(r["marks"], r["size"], np.uint64) for r in found]])
    marks = marks[np.searchsorted(np.unique(prefix), prefix)]
    text = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(prefix)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    at = np.flatnonzero(marks)
    order = at[np.lexsort((place[at], marks[at], text[at]))]
    new = np.concatenate([np.ones(min(1, len(order)), np.bool_), (marks[order][1:] != marks[order][:-1]) | (text[order][1:] != text[order][:-1])])
    at = np.sort(order[new])
    rows = own.column("rows").combine_chunks().flatten().take(pa.array(text[at]))
    key, n = rows.flatten()
    columns = [key, n, pa.array(place[at].astype(np.int32)), pa.array(prefix[at].view(np.int64))]
    return pa.Table.from_arrays(columns, names=["key", "n", "place", "bucket"])
