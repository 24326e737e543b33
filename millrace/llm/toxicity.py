"""Toxic spans by a linear-chain conditional random field over words.

Documents carry the labels, so tokens are labelled first: a feature of a word (the word itself,
a prefix or a suffix) is telling when the documents it occurs in are toxic far more often than
chance allows, and a token of a toxic document with such a feature is toxic.  A chain with two
labels is trained on windows around these tokens and around others.  Forward-backward marginals
of whole texts give the offending spans, and the largest marginal and the sum inside the spans
give the score of the document, calibrated on the labels.  Words outside the spans add nothing, so
clean text does not raise a score however much of it there is.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from millrace.llm.common import materialise, temporary
from millrace.llm.lanes import WORD, Lanes, numbered_words, slices

# The classifier learns from at most this many labelled documents, those with the lowest digests.
SAMPLE_DOCS = 8_000
# A telling feature holds for mostly toxic documents; its log-likelihood ratio against the share of
# toxic documents passes the logarithm of the number of features by MARGIN.
PURITY, MARGIN = 0.9, 3.0
# A training window reaches so many words to either side; a document gives up to WINDOWS of each kind.
REACH, WINDOWS = 6, 2
BITS = 18
SLOTS = 9
# Texts that are walked together, and words whose emissions a task remembers.
TOGETHER_BYTES, KNOWN_WORDS = 2 << 20, 100_000
# The highest score of a text without a span.
SPANLESS = 0.5 - 1e-9
_EDGES = b".,;:!?()[]{}<>\"'|*_-~`"
_FLOOR, _CEIL = 1e-9, 1e9


def features(word: bytes) -> list[bytes]:
    """The word without marks at its edges, its prefixes of 3 to 6 bytes and its suffixes of 3 and 4."""
    bare = word.strip(_EDGES) or word
    n = len(bare)
    return [b"w" + bare, *(b"p" + bare[:k] for k in (3, 4, 5, 6) if k < n), *(b"s" + bare[-k:] for k in (3, 4) if k < n)]


def slots(word: bytes) -> list[int]:
    """Places of a word's features in the weight table, filled up with 0, which has no weight."""
    found = [1 + zlib.crc32(f) % ((1 << BITS) - 1) for f in features(word)]
    return found + [0] * (SLOTS - len(found))


@dataclass
class Chain:
    """Weights of label 1 against label 0, and what a step between labels weighs; calibration of documents."""

    weights: np.ndarray = field(default_factory=lambda: np.zeros(1 << BITS))
    bias: float = -4.0
    steps: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    scale: np.ndarray = field(default_factory=lambda: np.array([-4.0, 0.0, 0.0]))

    def emissions(self, words: list[bytes]) -> np.ndarray:
        if not words:
            return np.zeros(0)
        found = np.array([slots(w) for w in words], np.int32)
        return self.weights[found].sum(axis=1) + self.bias

    def marginals(self, emission: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Odds of label 1 at every token, given its whole sequence: forward odds times backward odds."""
        lift = np.exp(np.clip(emission, -20, 20))
        forward, backward = lift.copy(), np.ones_like(lift)
        (oo, ot), (to, tt) = np.exp(self.steps)
        lanes, before = Lanes(sizes), None
        for at in lanes:
            if before is not None:
                last = forward[before[: len(at)]]
                forward[at] *= np.clip((ot + last * tt) / (oo + last * to), _FLOOR, _CEIL)
                forward[at] = np.clip(forward[at], _FLOOR, _CEIL)
            before = at
        after = None
        for at in lanes.backward():
            if after is not None:
                ahead = np.clip(lift[after] * backward[after], _FLOOR, _CEIL)
                backward[at[: len(after)]] = (to + ahead * tt) / (oo + ahead * ot)
            after = at
        return forward * backward

    def summary(self, odds: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Per sequence: log of the largest odds, and log of 1 plus the expected number of toxic words in spans."""
        out = np.zeros((len(sizes), 2))
        out[:, 0] = np.log(_FLOOR)
        filled = np.flatnonzero(sizes)
        if len(filled):
            starts = (np.cumsum(sizes) - sizes)[filled]
            out[filled, 0] = np.log(np.maximum(np.maximum.reduceat(odds, starts), _FLOOR))
            out[filled, 1] = np.log1p(np.add.reduceat(np.where(odds >= 1, odds / (1 + odds), 0.0), starts))
        return out

    def scores(self, summary: np.ndarray) -> np.ndarray:
        found = 1 / (1 + np.exp(-np.clip(self.scale[0] + summary @ self.scale[1:], -500, 500)))
        # A chain that saw one kind of label only scores every text alike.
        return np.where((summary[:, 0] < 0) & self.scale[1:].any(), np.minimum(found, SPANLESS), found)


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int = SAMPLE_DOCS) -> DataFrame:
    """(toxic, text) of up to ``most`` documents with a toxic label, in a written table.

    Several labels of a document count as toxic if one is; null labels and null ids are no labels.
    """
    docs = docs.select("doc_id", "text")
    known = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("_toxic"))
    known = known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    some = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    # At most `most` rows of an id and a flag.
    return materialise(docs.join(F.broadcast(some), "doc_id").select(F.col("_toxic").alias("toxic"), F.col("text").cast("binary").alias("text")), "labelled")


def _features_in(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[bytes, list[int]] = {}
    for batch in batches:
        for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            words = set(WORD.findall((text.as_py() or b"").lower()))
            for feature in {f for w in words for f in features(w)}:
                counts.setdefault(feature, [0, 0])[toxic] += 1
    yield pa.RecordBatch.from_pydict(
        {
            "feature": pa.array(list(counts), pa.binary()),
            "clean": pa.array([c[0] for c in counts.values()], pa.int64()),
            "toxic": pa.array([c[1] for c in counts.values()], pa.int64()),
        }
    )


def telling_features(sample: DataFrame) -> set[bytes]:
    """Features whose documents are toxic far beyond chance."""
    toxic, total = sample.agg(F.sum("toxic"), F.count(F.lit(1))).first()
    if not toxic or toxic == total:
        return set()
    share = toxic / total
    counted = sample.mapInArrow(_features_in, "feature binary, clean long, toxic long").groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    counted = materialise(counted, "features")
    part = F.col("toxic") / (F.col("toxic") + F.col("clean"))
    ratio = F.col("toxic") * F.log(part / share) + F.when(
        F.col("clean") > 0, F.col("clean") * F.log((F.lit(1.0) - part) / (1 - share))
    ).otherwise(0.0)
    # Rare features cannot pass, so the number of chances is that of features met at least twice.
    chances = counted.filter("toxic + clean > 1").count()
    found = counted.filter((part >= max(PURITY, share)) & (ratio >= float(np.log(max(2, chances))) + MARGIN))
    return {bytes(r[0]) for r in found.select("feature").collect()}


def _windows(telling: set[bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, marks = [], []
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = WORD.findall((text.as_py() or b"").lower())
                if not words:
                    continue
                cache: dict[bytes, bool] = {}
                hit = [toxic and (cache[w] if w in cache else cache.setdefault(w, not telling.isdisjoint(features(w)))) for w in words]
                # Around toxic words, and evenly spread over the text.
                places = [i for i, h in enumerate(hit) if h][:: max(1, sum(map(bool, hit)) // WINDOWS)][:WINDOWS]
                if not toxic or places:
                    places += [len(words) * (2 * k + 1) // (2 * WINDOWS) for k in range(WINDOWS)]
                for at in places:
                    low, high = max(0, at - REACH), min(len(words), at + REACH + 1)
                    rows.append([s for w in words[low:high] for s in slots(w)])
                    marks.append([int(bool(h)) for h in hit[low:high]])
            yield pa.RecordBatch.from_pydict({"slots": pa.array(rows, pa.list_(pa.int32())), "marks": pa.array(marks, pa.list_(pa.int8()))})

    return run


def fit_chain(slot_rows: list[np.ndarray], mark_rows: list[np.ndarray], rounds: int = 30, rate: float = 0.5, decay: float = 1e-5) -> Chain:
    """Maximum likelihood of the windows by adaptive gradient steps; same input, same chain."""
    chain = Chain()
    n, longest = len(mark_rows), 2 * REACH + 1
    found = np.zeros((n, longest, SLOTS), np.int32)
    marks, there = np.zeros((n, longest)), np.zeros((n, longest), bool)
    for i, (s, m) in enumerate(zip(slot_rows, mark_rows)):
        found[i, : len(m)] = np.reshape(s, (-1, SLOTS))
        marks[i, : len(m)], there[i, : len(m)] = m, True
    flat = found[there]
    sums = [np.full_like(chain.weights, 1e-8), 1e-8, np.full((2, 2), 1e-8)]
    y = marks.astype(int)
    for _ in range(rounds):
        emission = np.zeros((n, longest))
        emission[there] = chain.weights[flat].sum(axis=1) + chain.bias
        score = np.stack([np.zeros_like(emission), emission], axis=-1)
        alpha, beta = score.copy(), np.zeros_like(score)
        for t in range(1, longest):
            alpha[:, t] += np.logaddexp.reduce(alpha[:, t - 1, :, None] + chain.steps, axis=1)
        for t in range(longest - 2, -1, -1):
            nxt = np.logaddexp.reduce(chain.steps + (score[:, t + 1] + beta[:, t + 1])[:, None, :], axis=2)
            beta[:, t] = np.where(there[:, t + 1, None], nxt, 0.0)
        ends = there.sum(axis=1) - 1
        norm = np.logaddexp.reduce(alpha[np.arange(n), ends], axis=1)
        toxic = np.exp(np.minimum(0, alpha[:, :, 1] + beta[:, :, 1] - norm[:, None]))
        wrong = np.where(there, marks - toxic, 0.0)[there]
        pair = alpha[:, :-1, :, None] + chain.steps + (score[:, 1:] + beta[:, 1:])[:, :, None, :] - norm[:, None, None, None]
        both = there[:, 1:]
        expected = np.exp(np.minimum(0, pair))[both].sum(axis=0)
        seen = np.bincount(2 * y[:, :-1][both] + y[:, 1:][both], minlength=4).reshape(2, 2)
        grads = [
            np.bincount(flat.ravel(), np.repeat(wrong, SLOTS), len(chain.weights)) / n - decay * chain.weights,
            wrong.sum() / n,
            (seen - expected) / n,
        ]
        grads[0][0] = 0.0
        for k, g in enumerate(grads):
            sums[k] = sums[k] + g * g
        chain.weights = chain.weights + rate * grads[0] / np.sqrt(sums[0])
        chain.bias += float(rate * grads[1] / np.sqrt(sums[1]))
        chain.steps = chain.steps + rate * grads[2] / np.sqrt(sums[2])
    return chain


def _calibrate(summary: np.ndarray, toxic: np.ndarray, decay: float = 1e-2) -> np.ndarray:
    """Logistic regression on a document's summary by Newton steps."""
    x = np.column_stack([np.ones(len(summary)), summary])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (toxic - p) - decay * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + decay * np.eye(len(w))
        w = w + np.linalg.solve(hess, grad)
    return w


def _remembered(chain: Chain, words: list[bytes], known: dict[bytes, float]) -> np.ndarray:
    """Emissions of distinct words; those of up to KNOWN_WORDS and the words at hand are kept for the next slice."""
    if len(known) > KNOWN_WORDS:
        known.clear()
    new = [w for w in words if w not in known]
    for first in range(0, len(new), 10_000):
        some = new[first : first + 10_000]
        known.update(zip(some, chain.emissions(some).tolist()))
    return np.fromiter(map(known.__getitem__, words), np.float64, len(words))


def _summaries(batches: Iterator[pa.RecordBatch], chain: Chain, text: int):
    known: dict[bytes, float] = {}
    for batch in slices(batches, text, TOGETHER_BYTES):
        ids, sizes, words = numbered_words(batch.column(text))
        emission = _remembered(chain, words, known)
        odds = chain.marginals(emission[ids] if len(words) else np.zeros(0), sizes)
        yield batch, sizes, odds


def train(docs: DataFrame, labels: DataFrame, most: int = SAMPLE_DOCS) -> Chain:
    """Chain learned from a bounded sample of the labelled rows of ``docs``.

    Without toxic labels every score is 0; without others every score is 1.
    """
    with temporary(docs.sparkSession):
        return _train(docs, labels, most)


def _train(docs: DataFrame, labels: DataFrame, most: int) -> Chain:
    spark = docs.sparkSession
    sample = labelled_sample(docs, labels, most)
    toxic, total = sample.agg(F.sum("toxic"), F.count(F.lit(1))).first()
    if not toxic or toxic == total:
        return Chain(scale=np.array([500.0 if toxic else -500.0, 0.0, 0.0]))
    telling = telling_features(sample)
    windows = sample.mapInArrow(_windows(telling), "slots array<int>, marks array<tinyint>").orderBy(F.xxhash64("slots"), "slots").toPandas()
    chain = fit_chain(list(windows["slots"]), list(windows["marks"])) if len(windows) else Chain()
    shared = spark.sparkContext.broadcast(chain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sizes, odds in _summaries(batches, shared.value, 1):
            found = shared.value.summary(odds, sizes)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found[:, 0]), pa.array(found[:, 1])], names=["toxic", "top", "sum"])

    seen = sample.mapInArrow(run, "toxic int, top double, sum double").orderBy("top", "sum", "toxic").toPandas()
    chain.scale = _calibrate(seen[["top", "sum"]].to_numpy(), seen["toxic"].to_numpy())
    return chain


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


def tag(docs: DataFrame, chain: Chain, score: str = "score", spans: str | None = "spans", text: str = "text") -> DataFrame:
    """``docs`` with the score of each text and, if wanted, its toxic spans as code point offsets.

    Null and empty texts have no words; they get the score that no sign of toxicity gives and no
    spans.  Words in a row whose marginals reach 0.5 are one span.
    """
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    fields = [T.StructField(score, T.DoubleType())] + ([T.StructField(spans, SPANS)] if spans else [])
    schema = T.StructType([*docs.schema.fields, *fields])
    place, own = docs.columns.index(text), len(docs.columns)
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def binary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, batch.column(place).cast(pa.binary())], names=[*batch.schema.names, "_"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = shared.value
        for batch, sizes, odds in _summaries(binary(batches), found, own):
            out = [*batch.columns[:own], pa.array(found.scores(found.summary(odds, sizes)))]
            if spans:
                ends = np.cumsum(sizes)
                per_text = [[] for _ in range(batch.num_rows)]
                hits = np.flatnonzero(odds >= 1)
                owner = np.searchsorted(ends, hits, side="right")
                for i in np.unique(owner):
                    per_text[i] = _spans(batch.column(own)[int(i)].as_py(), set((hits[owner == i] - (ends[i] - sizes[i])).tolist()))
                out.append(pa.array(per_text, kind))
            yield pa.RecordBatch.from_arrays(out, names=schema.names)

    return docs.mapInArrow(run, schema)


def _spans(text: bytes, hits: set[int]) -> list[dict]:
    out: list[dict] = []
    last, chars, seen = None, 0, 0
    for number, word in enumerate(WORD.finditer(text)):
        if number not in hits:
            continue
        chars += len(text[seen : word.start()].decode("utf-8", "replace"))
        start = chars
        chars += len(word.group().decode("utf-8", "replace"))
        seen = word.end()
        if last == number - 1 and out:
            out[-1]["end"] = chars
        else:
            out.append({"start": start, "end": chars})
        last = number
    return out
