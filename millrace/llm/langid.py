"""Language identification by prediction by partial matching over bytes.

Per language a tree of contexts of up to ORDER symbols holds how often each symbol followed.
With frozen counts the probability of a symbol is c / (n + d) in the longest known context (n
symbols seen, d distinct ones), and an unseen symbol pays the escape d / (n + d) and is looked up
one symbol shorter, down to a uniform guess.  The code length of a text is the sum of minus the
logarithms; the language with the shortest code wins.  All of this depends on the last ORDER
symbols only, so the trees become one table: state (longest known context) x symbol -> code
lengths of all languages.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.common import materialise

ORDER = 3
# Contexts of the full order below this share of all training symbols are not states of their own,
# so there are at most 1 / MIN_SHARE of them.
MIN_SHARE = 2e-6
CHUNK = 1 << 20


def _symbols() -> np.ndarray:
    """Byte to symbol: letters without case, one symbol each for blanks, digits and ASCII marks,
    lead bytes of UTF-8, and continuation bytes modulo 32 (which folds the case of Latin-1 letters)."""
    table = np.zeros(256, np.uint8)
    for byte in range(256):
        if byte < 0x80:
            letter = bytes([byte]).lower()
            if letter.isalpha():
                table[byte] = 1 + letter[0] - ord("a")
            elif letter.isdigit():
                table[byte] = 27
            elif byte > 0x20 and byte != 0x7F:
                table[byte] = 28
        elif byte < 0xC0:
            table[byte] = 29 + (byte & 31)
        elif byte < 0xE0:
            table[byte] = 61 + byte - 0xC0
        else:
            table[byte] = 93 + min(byte - 0xE0, 16)
    return table


SYMBOL = _symbols()
K = 110


def _codes(joined: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each byte the base-K number of the ORDER symbols before it and itself; blanks stand before a text."""
    symbols = SYMBOL[joined].astype(np.int64)
    place = np.arange(len(joined)) - np.repeat(starts, np.diff(np.append(starts, len(joined))))
    codes = symbols.copy()
    for back in range(1, ORDER + 1):
        earlier = np.zeros_like(symbols)
        earlier[back:] = symbols[:-back]
        earlier[place < back] = 0
        codes += earlier * K**back
    return codes


def _chunks(texts: list[bytes]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of texts of about CHUNK bytes: first, last, joined bytes, starts."""
    first = 0
    while first < len(texts):
        last, size = first, 0
        while last < len(texts) and (last == first or size + len(texts[last]) <= CHUNK):
            size += len(texts[last])
            last += 1
        sizes = np.fromiter(map(len, texts[first:last]), np.int64, last - first)
        yield first, last, np.frombuffer(b"".join(texts[first:last]), np.uint8), np.concatenate([[0], np.cumsum(sizes)[:-1]])
        first = last


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts (lang, code, n) of a task's rows (lang, text)."""
    known: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def add(lang: str, codes: np.ndarray, counts: np.ndarray) -> None:
        if lang in known:
            codes, counts = np.concatenate([known[lang][0], codes]), np.concatenate([known[lang][1], counts])
            codes, where = np.unique(codes, return_inverse=True)
            counts = np.bincount(where, counts, len(codes)).astype(np.int64)
        known[lang] = codes, counts

    for batch in batches:
        langs = np.array(batch.column(0).to_pylist(), object)
        texts = batch.column(1).to_pylist()
        for lang in set(langs):
            own = [texts[i] for i in np.flatnonzero(langs == lang)]
            for _, _, joined, starts in _chunks(own):
                if len(joined):
                    add(lang, *np.unique(_codes(joined, starts), return_counts=True))
    for lang, (codes, counts) in known.items():
        yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(codes), pa.string()), "code": codes, "n": counts})


def count_contexts(docs: DataFrame) -> DataFrame:
    """How often each run of ORDER + 1 symbols occurs per language, over all rows with text and lang."""
    rows = docs.filter("lang is not null and text is not null").select("lang", F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(_count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    langs: list[str]
    state_of: np.ndarray  # the last ORDER symbols -> state
    cost: np.ndarray  # state * K + symbol -> nats per language

    def lengths(self, texts: list[bytes]) -> np.ndarray:
        """Code length in nats of every text under every language."""
        out = np.zeros((len(texts), len(self.langs)))
        for first, last, joined, starts in _chunks(texts):
            if not len(joined):
                continue
            codes = _codes(joined, starts)
            paid = self.cost[self.state_of[codes // K] * K + codes % K]
            filled = np.flatnonzero(np.diff(np.append(starts, len(joined))))
            out[first + filled] = np.add.reduceat(paid, starts[filled], axis=0, dtype=np.float64)
        return out


def count_orders(counts: DataFrame, min_share: float = MIN_SHARE) -> list[DataFrame]:
    """(lang, code, n) for contexts of 0 to ORDER symbols; those of ORDER symbols have ``min_share`` of all.

    A language has at most K ** ORDER rows of each shorter order, and K / min_share of the full one.
    """
    whole = counts.agg(F.sum("n")).first()[0] or 0
    context = F.expr(f"code div {K}").alias("_context")
    heavy = counts.groupBy(context).agg(F.sum("n").alias("_whole")).filter(F.col("_whole") >= min_share * max(1, whole))
    code = lambda order: (F.col("code") % K ** (order + 1)).alias("code")
    shorter = [counts.groupBy("lang", code(order)).agg(F.sum("n").alias("n")) for order in range(ORDER)]
    full = counts.select("*", context).join(heavy, "_context", "left_semi")
    return [*shorter, full.select("lang", "code", "n")]


def freeze(orders: list[pd.DataFrame]) -> Model:
    """The table of code lengths from (lang, code, n) rows of each order; lang is learned as it is written."""
    langs = sorted(orders[0]["lang"].unique())
    if not langs:
        return Model([], np.zeros(K**ORDER, np.int32), np.zeros((K, 0), np.float32))
    # States of a longer order come after those of the shorter ones, which stay as fallbacks.
    cost = np.full((K, len(langs)), np.log(K))
    state_of = np.zeros(1, np.int64)
    for order in range(ORDER + 1):
        grams = orders[order].sort_values(["lang", "code"], ignore_index=True)
        context = (grams["code"] // K).to_numpy()
        kept = np.unique(context).astype(np.int64)
        shorter = state_of[np.arange(K**order) % K ** max(0, order - 1)]
        own = cost.reshape(-1, K, len(langs))[shorter[kept]].reshape(-1, len(langs))
        local = np.full(K**order, -1)
        local[kept] = np.arange(len(kept))
        for number, lang in enumerate(langs):
            rows = grams[(grams["lang"] == lang).to_numpy() & (local[context] >= 0)]
            at, symbol, n = local[(rows["code"] // K).to_numpy()], (rows["code"] % K).to_numpy(), rows["n"].to_numpy()
            seen = np.bincount(at, n, len(kept))
            distinct = np.bincount(at, minlength=len(kept)).astype(float)
            known = np.flatnonzero(seen)
            column = own[:, number].reshape(len(kept), K).copy()
            column[known] -= np.log(distinct[known] / (seen[known] + distinct[known]))[:, None]
            column[at, symbol] = -np.log(n / (seen[at] + distinct[at]))
            own[:, number] = column.reshape(-1)
        state_of = shorter.copy()
        state_of[kept] = (len(cost) // K if order else 0) + np.arange(len(kept))
        cost = np.concatenate([cost, own]) if order else own
    return Model(langs, state_of.astype(np.int32), cost.astype(np.float32))


def train(docs: DataFrame, min_share: float = MIN_SHARE) -> Model:
    """Model of all rows with text and lang.  The runs are counted by order and sifted before they
    reach the driver; see ``count_orders`` for their number, which grows with that of the languages."""
    counts = materialise(count_contexts(docs), "contexts")
    return freeze([rows.toPandas() for rows in count_orders(counts, min_share)])


def predict(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns with lang_pred and score.

    A null text or one without a letter is ``und`` with score 0, as is every text when no language
    was learned.  The score is the winner's share of the probabilities of the text under all
    languages; ties go to the language that comes first.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    lettered = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(*keep, F.when(lettered, F.col(text)).cast("binary").alias("_text"))
    schema = docs.select(*keep).schema.add("lang_pred", "string").add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = shared.value
        for batch in batches:
            texts = batch.column(len(keep)).to_pylist()
            langs, scores = ["und"] * len(texts), np.zeros(len(texts))
            some = [i for i, t in enumerate(texts) if t]
            if some and found.langs:
                lengths = found.lengths([texts[i] for i in some])
                best = lengths.argmin(axis=1)
                gaps = lengths - lengths[np.arange(len(some)), best][:, None]
                scores[some] = 1.0 / np.exp(-np.minimum(gaps, 700)).sum(axis=1)
                for i, k in zip(some, best):
                    langs[i] = found.langs[k]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], pa.array(langs, pa.string()), pa.array(scores)], names=[*keep, "lang_pred", "score"]
            )

    return rows.mapInArrow(run, schema)
