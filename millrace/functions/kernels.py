"""Arrow-batched helpers for what column expressions cannot say.

Each helper works on one column batch inside a task; partitioning, grouping and joins stay
with Spark.  The module is pickled by value so that executors need no copy of the package.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import functions as F, types as T

from millrace.functions.exchange import SLICE_BYTES, sliced

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _struct(kind, *names):
    return T.StructType([T.StructField(name, kind) for name in names])


@F.arrow_udf(T.StringType())
def nfc(text: pa.Array) -> pa.Array:
    """Canonical composition, of 1 MB of texts at a time; nulls stay null."""
    from unicodedata import normalize

    done = []
    for part in sliced([pa.RecordBatch.from_arrays([text], names=["text"])], 0, 1 << 20):
        done.append(pa.array([t if t is None else normalize("NFC", t) for t in part.column(0).to_pylist()], pa.string()))
    return pa.concat_arrays(done) if done else text


def _shared_ngrams(left, right, n):
    from collections import Counter

    a = Counter(zip(*[left[k:] for k in range(n)]))
    b = Counter(zip(*[right[k:] for k in range(n)]))
    return sum((a & b).values())


def _longest_common_subsequence(left, right):
    """Length by the bit-vector recurrence of Crochemore et al. (2001)."""
    where = {}
    for position, word in enumerate(left):
        where[word] = where.get(word, 0) | (1 << position)
    full = (1 << len(left)) - 1
    row = full
    for word in right:
        hit = where.get(word, 0)
        row = ((row + (row & hit)) | (row & ~hit)) & full
    return len(left) - row.bit_count()


def _matched_places(left, right):
    """Places in ``left`` of one longest common subsequence with ``right``: of several, that with the latest matches."""
    width = len(right) + 1
    best = [[0] * width]
    for word in left:
        above, row = best[-1], [0] * width
        for j, other in enumerate(right):
            row[j + 1] = above[j] + 1 if word == other else max(above[j + 1], row[j])
        best.append(row)
    places, i, j = set(), len(left), len(right)
    while i and j:
        if left[i - 1] == right[j - 1]:
            i, j = i - 1, j - 1
            places.add(i)
        elif best[i][j - 1] > best[i - 1][j]:
            j -= 1
        else:
            i -= 1
    return places


def _union_matches(prediction, reference):
    """Words of the reference sentences that some prediction sentence matches in order, each word of either side once."""
    from collections import Counter

    free, other = Counter(w for s in reference for w in s), Counter(w for s in prediction for w in s)
    hits = 0
    for sentence in reference:
        union = set()
        for candidate in prediction:
            union |= _matched_places(sentence, candidate)
        for place in sorted(union):
            word = sentence[place]
            if free[word] > 0 and other[word] > 0:
                hits += 1
                free[word] -= 1
                other[word] -= 1
    return hits


@F.pandas_udf(T.IntegerType())
def sentence_matches(prediction: pd.Series, reference: pd.Series) -> pd.Series:
    """Union of longest common subsequences over sentence pairs; sentences are lines of split words."""
    sides = ([[line.split() for line in t.split("\n")] for t in side] for side in (prediction, reference))
    return pd.Series([_union_matches(p, r) for p, r in zip(*sides)], dtype="int32")


@F.pandas_udf(T.IntegerType())
def common_tokens(prediction: pd.Series, reference: pd.Series) -> pd.Series:
    """Size of the multiset intersection of the whitespace tokens."""
    return pd.Series(
        [_shared_ngrams(p.split(), r.split(), 1) for p, r in zip(prediction, reference)], dtype="int32"
    )


@F.pandas_udf(_struct(T.IntegerType(), "m1", "m2", "lcs"))
def rouge_matches(prediction: pd.Series, reference: pd.Series) -> pd.DataFrame:
    """Shared unigrams and bigrams and the longest common subsequence of split texts."""
    rows = []
    for p, r in zip(prediction, reference):
        a, b = p.split(), r.split()
        rows.append((_shared_ngrams(a, b, 1), _shared_ngrams(a, b, 2), _longest_common_subsequence(a, b)))
    return pd.DataFrame(rows, columns=["m1", "m2", "lcs"], dtype="int32")


@F.pandas_udf(_struct(T.IntegerType(), "m1", "m2", "m3", "m4"))
def bleu_matches(prediction: pd.Series, reference: pd.Series) -> pd.DataFrame:
    """Clipped n-gram matches of orders 1 to 4 against the best of several references.

    References come as one string with the separator U+001E between them.
    """
    from collections import Counter

    rows = []
    for p, refs in zip(prediction, reference):
        a = p.split()
        splits = [r.split() for r in refs.split("\x1e")]
        found = []
        for n in (1, 2, 3, 4):
            best = Counter()
            for b in splits:
                best |= Counter(zip(*[b[k:] for k in range(n)]))
            found.append(sum((Counter(zip(*[a[k:] for k in range(n)])) & best).values()))
        rows.append(found)
    return pd.DataFrame(rows, columns=["m1", "m2", "m3", "m4"], dtype="int32")


_MULTIPLIERS = np.array(
    [0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F],
    dtype=np.uint64,
)


def _mix(x):
    """SplitMix64 finaliser, on uint64 arrays."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _shingles(words, size):
    """Sorted distinct 64-bit hashes of the word n-grams; a short text is one shingle."""
    if not words:
        return np.zeros(0, dtype=np.uint64)
    codes = pd.util.hash_array(np.array(words, dtype=object), categorize=False)
    width = min(size, len(words))
    with np.errstate(over="ignore"):
        total = np.zeros(len(words) - width + 1, dtype=np.uint64)
        for k in range(width):
            total = _mix(total + codes[k : len(words) - width + 1 + k] * _MULTIPLIERS[k % 5] + np.uint64(k + 1))
    return np.unique(total)


def repeated_shingles_of(size: int):
    """Arrow helper for rows of one text: (shingle, rows) of the shingles that several texts of a slice hold."""

    def run(batches):
        import pyarrow as pa

        for batch in sliced(batches, 0, 2 * SLICE_BYTES):
            with np.errstate(over="ignore"):
                found = [_shingles((t or "").split(), size) for t in batch.column(0).to_pylist()]
            values, counts = np.unique(np.concatenate([np.zeros(0, np.uint64), *found]), return_counts=True)
            often = counts > 1
            yield pa.RecordBatch.from_pydict({"shingle": values[often].view(np.int64), "rows": counts[often].astype(np.int64)})

    return run


def _lists(arrays):
    import pyarrow as pa

    ends = np.cumsum([0, *map(len, arrays)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int64), *arrays])))


def _parities(found):
    """Parity of the number of elements that fall on each of at least two bits an element, as words of 64 bits.

    The number of words is a power of two, so the longer of two such rows folds onto the shorter.
    """
    bits = 64
    while bits < 2 * len(found):
        bits *= 2
    odd = np.bincount((found & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def prefix_of(size: int, threshold: float, frequent):
    """Arrow helper for rows (key, mark, text): key, mark, size and digest of the text's shingle set, the set's prefix and parities.

    Shingles are ordered by the count that ``frequent`` (a broadcast of sorted shingles and their
    counts) gives, then by value.  Two sets of Jaccard similarity >= t share one of their first
    n - ceil(t * n) + 1 shingles in any order that is the same for all sets.
    """

    def run(batches):
        from hashlib import blake2b
        from math import ceil

        import pyarrow as pa

        known, counts = frequent.value
        for batch in sliced(batches, 2):
            sizes, digests, prefixes, parities = [], [], [], []
            for t in batch.column(2).to_pylist():
                with np.errstate(over="ignore"):
                    found = _shingles((t or "").split(), size)
                n = len(found)
                digests.append(blake2b(found.tobytes(), digest_size=16).digest())
                parities.append(_parities(found))
                own = found.view(np.int64)
                if len(known) and n:
                    at = np.minimum(np.searchsorted(known, own), len(known) - 1)
                    own = own[np.lexsort((own, np.where(known[at] == own, counts[at], 0)))]
                sizes.append(n)
                # A copy, as a view would keep the whole set.
                prefixes.append(own[: n - ceil(threshold * n - 1e-9) + 1].copy() if n else own)
            digest = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            columns = [batch.column(0), batch.column(1), pa.array(sizes, pa.int32()), pa.array(digest[:, 0].copy()), pa.array(digest[:, 1].copy()), _lists(prefixes), _lists(parities)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:2], "n", "hi", "lo", "prefix", "parities"])

    return run


def shingles_of(size: int):
    """Arrow helper for rows (key, text): key and distinct hashes of the text's word n-grams."""

    def run(batches):
        import pyarrow as pa

        for batch in sliced(batches, 1):
            with np.errstate(over="ignore"):
                found = [_shingles((t or "").split(), size).view(np.int64) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(found)], names=[batch.schema.names[0], "shingles"])

    return run


@F.pandas_udf(T.ArrayType(T.StringType()))
def nfc_each(texts: pd.Series) -> pd.Series:
    """Canonical composition of every string of an array."""
    from unicodedata import normalize

    return texts.map(lambda row: None if row is None else [None if t is None else normalize("NFC", t) for t in row])


def find_entities(patterns: dict[str, tuple[str, float]]):
    """Arrow helper: text -> array of (entity_type, start, end, score, text_snippet)."""

    @F.pandas_udf("array<struct<entity_type string, start int, end int, score double, text_snippet string>>")
    def find(text: pd.Series) -> pd.Series:
        import re

        ready = [(kind, re.compile(pattern), score) for kind, (pattern, score) in patterns.items()]
        out = []
        for t in text:
            found = []
            for kind, pattern, score in ready:
                for hit in pattern.finditer(t or ""):
                    found.append((kind, hit.start(), hit.end(), score, hit.group()))
            out.append(found)
        return pd.Series(out)

    return find


# Lattice points of two samples of different sizes whose paths are counted; beyond, the expansion
# is used, which differs from the count by less than its own terms there.
LATTICE_POINTS = 10**8


def equal_sizes_p(h: int, n: int) -> float:
    """P(n * D >= h) for two samples of n values: Gnedenko and Korolyuk's alternating sum, at any n.

    Its terms fall so fast that a few suffice, however large the samples are.
    """
    from math import exp, lgamma, log1p

    def log_ratio(a):
        # ln of (n!)^2 / ((n - a)! (n + a)!); by Stirling's series where factorials lose digits.
        if n - a < 1000:
            return 2 * lgamma(n + 1) - lgamma(n - a + 1) - lgamma(n + a + 1)
        x = a / n
        main = -((n - a + 0.5) * log1p(-x) + (n + a + 0.5) * log1p(x))
        return main + (2 / n - 1 / (n - a) - 1 / (n + a)) / 12 - (2 / n**3 - 1 / (n - a) ** 3 - 1 / (n + a) ** 3) / 360

    if h <= 0:
        return 1.0
    total, sign, k = 0.0, 1.0, 1
    while k * h <= n:
        term = exp(log_ratio(k * h))
        total += sign * term
        sign, k = -sign, k + 1
        if term < 1e-18:
            break
    return min(1.0, max(0.0, 2 * total))


def expansion_p(d: float, n: float) -> float:
    """P(D >= d) of n values against a distribution, by the expansion of Pelz and Good (1976) to n ** -1.5."""
    from math import exp, pi, sqrt

    x = sqrt(n) * d
    if x <= 0.1:
        return 1.0
    if x > 5:
        return 2 * exp(-2 * x * x)
    odd = [(k + 0.5) ** 2 * pi**2 for k in range(-25, 25)]
    even = [k**2 * pi**2 for k in range(-25, 26)]
    near, far = [(u, exp(-u / (2 * x * x))) for u in odd], [(u, exp(-u / (2 * x * x))) for u in even]
    half = sqrt(pi / 2)
    k0 = half / x * sum(e for _, e in near)
    k1 = half / (6 * x**4) * sum((u - x**2) * e for u, e in near)
    k2 = half / (72 * x**7) * sum((6 * x**6 + 2 * x**4 + (2 * x**4 - 5 * x**2) * u + (1 - 2 * x**2) * u**2) * e for u, e in near)
    k2 -= half / (36 * x**3) * sum(u * e for u, e in far)
    k3 = half / (6480 * x**10) * sum(
        ((5 - 30 * x**2) * u**3 + (212 * x**4 - 60 * x**2) * u**2 + (135 * x**4 - 96 * x**6) * u - 30 * x**6 - 90 * x**8) * e for u, e in near
    )
    k3 += half / (216 * x**6) * sum((3 * x**2 * u - u**2) * e for u, e in far)
    return min(1.0, max(0.0, 1 - (k0 + k1 / sqrt(n) + k2 / n + k3 / n**1.5)))


def lattice_p(d: float, n: int, m: int) -> float:
    """P(D >= d) of two samples, by counting the paths from (0, 0) to (n, m) that stay inside the band."""
    from math import lgamma

    if n > m:
        n, m = m, n
    j = np.arange(m + 1) / m
    paths = (j < d - 1e-12).astype(float)
    log_scale = 0.0
    for i in range(1, n + 1):
        inside = np.abs(i / n - j) < d - 1e-12
        paths = np.where(inside, np.cumsum(np.where(inside, paths, 0.0)), 0.0)
        top = paths.max()
        if top == 0.0:
            return 1.0
        paths, log_scale = paths / top, log_scale + np.log(top)
    if paths[m] == 0.0:
        return 1.0
    all_paths = lgamma(n + m + 1) - lgamma(n + 1) - lgamma(m + 1)
    return float(min(1.0, max(0.0, 1 - np.exp(np.log(paths[m]) + log_scale - all_paths))))


@F.pandas_udf(T.StructType([T.StructField("p", T.DoubleType()), T.StructField("method", T.StringType())]))
def ks_p_value(d: pd.Series, n: pd.Series, m: pd.Series) -> pd.DataFrame:
    """Two-sided p of the two-sample statistic d for sample sizes n and m, and how it was found.

    Samples of one size have the exact value at every size.  For other sizes paths are counted,
    or, where these are too many, the expansion for n * m / (n + m) values is taken.
    """
    rows = []
    for stat, a, b in zip(d, n, m):
        if stat is None or np.isnan(stat) or not a or not b:
            rows.append((None, "undefined"))
        elif a == b:
            rows.append((equal_sizes_p(int(round(stat * a)), int(a)), "exact"))
        elif a * b <= LATTICE_POINTS:
            rows.append((lattice_p(stat, int(a), int(b)), "exact"))
        else:
            rows.append((expansion_p(stat, round(a * b / (a + b))), "expansion"))
    return pd.DataFrame(rows, columns=["p", "method"])
