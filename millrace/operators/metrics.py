"""Text-quality and evaluation metrics over prediction/reference tables and plain corpora.

Corpus operators take ``by``, a list of grouping columns (empty for one overall row).
Pair operators read ``prediction`` and ``reference`` columns of one table; ``pair_up`` builds
it from two tables by key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from millrace.functions.exchange import ROW_END, distinct_in_part, distinct_told, matches_of, parts_for, tops_answered, tops_told, word_batches
from millrace.functions.fixed import TOXIC_KEYWORDS
from millrace.functions.kernels import bleu_matches, common_tokens, rouge_matches, sentence_matches
from millrace.functions.text import bleu_text, normalised_answer, rouge_lines, rouge_text, strip, tokens
from millrace.plans.durable import materialise
from millrace.plans.skew import SMALL_TOTAL, hot_key_join, null_safe_join


def pair_up(predictions: DataFrame, references: DataFrame, key: str) -> DataFrame:
    """Every prediction with its reference, null where there is none."""
    return predictions.join(references, key, "left")


def perplexity(df: DataFrame, loss: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.exp(F.avg(loss)).alias("perplexity"))


def sliding_token_windows(df: DataFrame, key: str, ids: str, max_len: int, stride: int) -> DataFrame:
    """Windows of at most ``max_len`` tokens every ``stride`` tokens, ending with the first that
    reaches the end of the text."""
    n = F.size(ids)
    last = F.when(n > max_len, F.ceil((n - max_len) / F.lit(stride)).cast("int")).otherwise(F.lit(0))
    starts = F.when(n > 0, F.transform(F.sequence(F.lit(0), last), lambda i: i * stride)).otherwise(
        F.array().cast("array<int>")
    )
    cut = df.withColumn("window_start", F.explode(starts))
    return cut.select(
        key,
        "window_start",
        F.least(F.col("window_start") + max_len, n).alias("window_end"),
        F.slice(ids, F.col("window_start") + 1, max_len).alias("window_ids"),
    )


def accuracy(pairs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Share of predictions equal to their reference after stripping; no reference is a miss."""
    hit = F.coalesce(strip(F.col("prediction")) == strip(F.col("reference")), F.lit(False))
    return pairs.groupBy(*by).agg(_mean_or_zero(hit.cast("double")).alias("accuracy"))


def exact_match(pairs: DataFrame, by: Sequence[str] = (), normalise: bool = True) -> DataFrame:
    p, r = F.col("prediction"), F.col("reference")
    if normalise:
        p, r = normalised_answer(p), normalised_answer(r)
    hit = F.coalesce(p == r, F.lit(False)) & F.col("reference").isNotNull()
    return pairs.groupBy(*by).agg(_mean_or_zero(hit.cast("double")).alias("exact_match"))


def token_f1(pairs: DataFrame, out: str = "f1") -> DataFrame:
    """Per-row F1 of the whitespace-token multisets; 0 where a side is empty."""
    sized = pairs.withColumns(
        {
            "_common": common_tokens(
                F.coalesce(F.col("prediction"), F.lit("")), F.coalesce(F.col("reference"), F.lit(""))
            ),
            "_np": F.size(tokens(F.col("prediction"))),
            "_nr": F.size(tokens(F.col("reference"))),
        }
    )
    return sized.withColumn(out, f_measure(F.col("_common"), F.col("_np"), F.col("_nr"))).drop("_common", "_np", "_nr")


def batch_f1(pairs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean F1 over the rows that have both sides."""
    both = pairs.filter(F.col("prediction").isNotNull() & F.col("reference").isNotNull())
    return token_f1(both).groupBy(*by).agg(_mean_or_zero(F.col("f1")).alias("batch_f1"))


def rouge_per_row(pairs: DataFrame) -> DataFrame:
    """Add rouge1, rouge2, rougeL and rougeLsum F-measures.

    rougeLsum takes every line as a sentence: words of a reference line count if they lie on a
    longest common subsequence with any prediction line, each word once.
    """
    ready = pairs.withColumns(
        {
            "_p": rouge_text(F.coalesce(F.col("prediction"), F.lit(""))),
            "_r": rouge_text(F.coalesce(F.col("reference"), F.lit(""))),
        }
    )
    matched = ready.withColumns(
        {
            "_m": rouge_matches("_p", "_r"), "_np": F.size(tokens(F.col("_p"))), "_nr": F.size(tokens(F.col("_r"))),
            "_sp": rouge_lines(F.coalesce(F.col("prediction"), F.lit(""))), "_sr": rouge_lines(F.coalesce(F.col("reference"), F.lit(""))),
        }
    )
    # Where both sides are one line the plain subsequence is the union; only others are matched again.
    several = F.contains("_sp", F.lit("\n")) | F.contains("_sr", F.lit("\n"))
    matched = matched.withColumn(
        "_u", F.coalesce(sentence_matches(F.when(several, F.col("_sp")).otherwise(""), F.when(several, F.col("_sr")).otherwise("")), F.lit(0))
    )
    zero = F.lit(0)
    return matched.withColumns(
        {
            "rouge1": f_measure(F.col("_m.m1"), F.col("_np"), F.col("_nr")),
            "rouge2": f_measure(
                F.col("_m.m2"), F.greatest(F.col("_np") - 1, zero), F.greatest(F.col("_nr") - 1, zero)
            ),
            "rougeL": f_measure(F.col("_m.lcs"), F.col("_np"), F.col("_nr")),
            "rougeLsum": f_measure(F.when(several, F.col("_u")).otherwise(F.col("_m.lcs")), F.col("_np"), F.col("_nr")),
        }
    ).drop("_p", "_r", "_m", "_np", "_nr", "_sp", "_sr", "_u")


def rouge(pairs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return rouge_per_row(pairs).groupBy(*by).agg(*[_mean_or_zero(F.col(m)).alias(m) for m in ("rouge1", "rouge2", "rougeL", "rougeLsum")])


def bleu(pairs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Corpus BLEU-4 with its precisions and lengths.  ``reference`` is a string or, for several references, an array."""
    many = pairs.schema["reference"].dataType.typeName() == "array"
    refs = F.col("reference") if many else F.array("reference")
    split = pairs.select(
        *by,
        F.array_join(tokens(bleu_text(F.col("prediction"))), " ").alias("_p"),
        F.transform(refs, lambda r: F.array_join(tokens(bleu_text(r)), " ")).alias("_refs"),
    )
    length = F.size(tokens(F.col("_p")))
    counted = split.select(
        *by,
        bleu_matches("_p", F.array_join("_refs", "\x1e")).alias("_m"),
        length.alias("_n"),
        F.array_min(F.transform("_refs", lambda r: F.size(tokens(r)))).alias("_ref_n"),
    )
    orders = (1, 2, 3, 4)
    sums = counted.groupBy(*by).agg(
        *[F.sum(f"_m.m{n}").alias(f"_m{n}") for n in orders],
        *[F.sum(F.greatest(F.col("_n") - (n - 1), F.lit(0))).alias(f"_t{n}") for n in orders],
        F.sum("_ref_n").alias("_ref"),
    )
    precisions = [F.when(F.col(f"_t{n}") > 0, F.col(f"_m{n}") / F.col(f"_t{n}")).otherwise(0.0) for n in orders]
    lowest = F.least(*precisions)
    mean = F.exp(sum((F.log(p) for p in precisions[1:]), F.log(precisions[0])) / 4)
    ratio = F.try_divide(F.col("_t1"), F.col("_ref"))
    penalty = F.when(ratio > 1, 1.0).otherwise(F.exp(1 - F.try_divide(F.lit(1), ratio)))
    return sums.select(
        *by,
        F.when((lowest > 0) & (F.col("_ref") > 0), mean * penalty).otherwise(0.0).alias("bleu"),
        F.coalesce(F.when((F.col("_ref") > 0) & (ratio > 0), penalty), F.lit(0.0)).alias("brevity_penalty"),
        F.array(*precisions).alias("precisions"),
        F.coalesce(ratio, F.lit(0.0)).alias("length_ratio"),
        F.col("_t1").alias("translation_length"),
        F.col("_ref").alias("reference_length"),
    )


def coherence(df: DataFrame, text: str, by: Sequence[str] = ()) -> DataFrame:
    """1 - (population deviation / mean) of word counts, clamped to 0..1."""
    counted = df.select(*by, F.size(tokens(F.col(text))).alias("_n"))
    n, mean = F.count("_n"), F.avg("_n")
    score = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - F.stddev_pop("_n") / mean))
    value = F.when(n == 0, 0.0).when(n < 2, 1.0).when(mean == 0, 0.0).otherwise(score)
    return counted.groupBy(*by).agg(value.alias("coherence"))


def coherence_of_ids(df: DataFrame, ids: str, by: Sequence[str] = ()) -> DataFrame:
    """1 - population variance of the unique-token ratio over texts of more than one token."""
    ratio = F.when(F.size(ids) > 1, F.size(F.array_distinct(ids)) / F.size(ids))
    counted = df.select(*by, ratio.alias("_u"))
    score = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - F.var_pop("_u")))
    return counted.groupBy(*by).agg(F.coalesce(score, F.lit(0.0)).alias("coherence"))


def _gram_counts(df: DataFrame, text: str, sizes: Sequence[int], by: Sequence[str]) -> DataFrame:
    """(by, n, distinct, total) n-grams of the lower-cased texts for each size, groups without any left out.

    Tasks tell digests (96 bits) of the n-grams, each once for some megabytes of text, to parts of
    the digest range, which count them; words and rows of n-grams are not shuffled.
    """
    kept = df.select(*by, F.lower(F.col(text)).alias("_text"))
    # A word and the space after it have three bytes or more in most texts; parts are a matter of size only.
    letters = df.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    groups = df.select(*by).schema.fields
    told = T.StructType([*groups, *T.StructType.fromDDL("n int, part int, total long, size long, x binary, y binary").fields])
    found = T.StructType([*groups, *T.StructType.fromDDL("n int, distinct long, total long").fields])
    asked = kept.mapInArrow(distinct_told(tuple(sizes), parts_for(letters // 4)), told)
    counted = asked.groupBy(*by, "n", "part").applyInArrow(distinct_in_part(tuple(by)), found)
    return counted.groupBy(*by, "n").agg(F.sum("distinct").alias("distinct"), F.sum("total").alias("total"))


def distinct_n(df: DataFrame, text: str, n: int, by: Sequence[str] = ()) -> DataFrame:
    """Distinct over total n-grams of the lower-cased texts, with both counts."""
    counted = _gram_counts(df, text, (n,), by)
    total, unique = F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("distinct"), F.lit(0))
    return counted.groupBy(*by).agg(
        unique.alias("distinct_ngrams"),
        total.alias("total_ngrams"),
        F.when(total > 0, unique / total).otherwise(0.0).alias("distinct_n"),
        F.when(total > 0, 1 - unique / total).otherwise(0.0).alias("repetition_rate"),
    )


def diversity(df: DataFrame, text: str, by: Sequence[str] = ()) -> DataFrame:
    """distinct_1, distinct_2 and distinct_3 from one scan."""
    counted = _gram_counts(df, text, (1, 2, 3), by)
    of = lambda n, col: F.sum(F.when(F.col("n") == n, F.col(col)))
    return counted.groupBy(*by).agg(
        *[F.coalesce(of(n, "distinct") / of(n, "total"), F.lit(0.0)).alias(f"distinct_{n}") for n in (1, 2, 3)]
    )


def self_bleu(df: DataFrame, key: str, text: str, small_total: int = SMALL_TOTAL) -> DataFrame:
    """Sentence BLEU-4 of each text against all other texts, smoothing 0.1 for empty matches.

    The clip of an n-gram is its largest count in any other text.  Batches of texts tell the two
    largest counts of their n-grams' digests to parts of the digest range, which answer with the
    two largest of all texts.  No pairs of texts and no rows of n-grams are formed.

    Rows of a repeated key are one text (in one row) with the length of each; those without a key match nothing.
    """
    # The separator of rows is white space within a text.
    named = df.select(F.col(key).alias("key"), F.translate(F.lower(F.coalesce(F.col(text), F.lit(""))), ROW_END, " ").alias("text"))
    kind = named.schema["key"].dataType
    repeated = named.groupBy("key").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("key")
    if not repeated.isEmpty():
        joined = null_safe_join(named, repeated, ["key"], "left_semi").groupBy("key").agg(F.array_join(F.collect_list("text"), ROW_END).alias("text"))
        named = null_safe_join(named, repeated, ["key"], "left_anti").unionByName(joined)
    schema = T.StructType([T.StructField("batch", T.LongType()), T.StructField("keys", T.ArrayType(kind)), *T.StructType.fromDDL("n_words long, of_key binary, sizes binary, ids binary, hashes binary").fields])
    batches = materialise(named.mapInArrow(word_batches, schema), "bleu-batches")
    words = batches.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    told = batches.drop("keys").mapInArrow(tops_told(parts_for(words)), "n int, part int, batch long, size long, x binary, y binary, top binary, second binary")
    answers = told.groupBy("n", "part").applyInArrow(tops_answered, "n int, part int, batch long, size long, top binary, second binary")
    matched = T.StructType([T.StructField("key", kind), *T.StructType.fromDDL("_len long, _m1 long, _m2 long, _m3 long, _m4 long").fields])
    # Written once: the lengths are compared with one another before they are scored.
    sums = materialise(batches.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(matches_of, matched), "bleu-matches")
    sums = sums.withColumnRenamed("key", key)
    closest = _closest_other_length(sums)
    scored = hot_key_join(sums, closest, ["_len"], "_n", 4 * words, small_total)
    parts = []
    for n in (1, 2, 3, 4):
        total = F.greatest(F.col("_len") - (n - 1), F.lit(1))
        got = F.col(f"_m{n}")
        parts.append(F.log(F.when(got > 0, got / total).otherwise(F.lit(0.1) / total)))
    penalty = F.when(F.col("_len") > F.col("_ref_len"), 1.0).otherwise(F.exp(1 - F.col("_ref_len") / F.col("_len")))
    score = F.when(F.col(key).isNotNull() & (F.col("_m1") > 0), penalty * F.exp((parts[0] + parts[1] + parts[2] + parts[3]) / 4))
    return scored.select(key, F.coalesce(score, F.lit(0.0)).alias("self_bleu"))


def _closest_other_length(lengths: DataFrame) -> DataFrame:
    """Per text length the nearest length of another text, the shorter one on ties.

    Works on the histogram of lengths, whose size is bounded by the longest text.
    """
    hist = lengths.groupBy("_len").agg(F.count(F.lit(1)).alias("_n"))
    ordered = Window.orderBy("_len")
    near = hist.select("_len", "_n", F.lag("_len").over(ordered).alias("_lo"), F.lead("_len").over(ordered).alias("_hi"))
    lo_gap, hi_gap = F.col("_len") - F.col("_lo"), F.col("_hi") - F.col("_len")
    other = F.when(F.col("_hi").isNull() | (lo_gap <= hi_gap), F.col("_lo")).otherwise(F.col("_hi"))
    return near.select("_len", "_n", F.when(F.col("_n") > 1, F.col("_len")).otherwise(other).alias("_ref_len"))


def corpus_self_bleu(df: DataFrame, key: str, text: str) -> DataFrame:
    """Mean over all texts; 0 for fewer than two."""
    scored = self_bleu(df, key, text)
    return scored.agg(F.when(F.count(key) > 1, F.avg("self_bleu")).otherwise(0.0).alias("self_bleu"))


def toxicity_score(text: Column) -> Column:
    """Distinct keywords among the whitespace tokens over 5, at most 1."""
    words = F.array(*[F.lit(w) for w in TOXIC_KEYWORDS])
    hits = F.size(F.array_intersect(tokens(F.lower(text)), words))
    return F.least(hits / F.lit(5.0), F.lit(1.0))


def toxicity(df: DataFrame, text: str, by: Sequence[str] = ()) -> DataFrame:
    scored = df.select(*by, toxicity_score(F.col(text)).alias("_s"))
    return scored.groupBy(*by).agg(
        _mean_or_zero(F.col("_s")).alias("mean_toxicity"),
        F.coalesce(F.max("_s"), F.lit(0.0)).alias("max_toxicity"),
        F.count_if(F.col("_s") >= 0.5).alias("num_flagged"),
    )


def toxic_rows(df: DataFrame, key: str, text: str) -> DataFrame:
    """The rows flagged by the keyword score, as a table rather than a list."""
    return df.select(key, toxicity_score(F.col(text)).alias("toxicity")).filter(F.col("toxicity") >= 0.5)


def generation_speed(df: DataFrame, num_tokens: str, latency_ms: str) -> DataFrame:
    rate = F.when(F.col(latency_ms) > 0, F.round(F.col(num_tokens) / (F.col(latency_ms) / 1000), 2))
    return df.withColumn("tokens_per_second", F.coalesce(rate, F.lit(0.0)))


def f_measure(common: Column, left: Column, right: Column) -> Column:
    p, r = F.try_divide(common, left), F.try_divide(common, right)
    return F.when((left > 0) & (right > 0) & (common > 0), 2 * p * r / (p + r)).otherwise(F.lit(0.0))


def _mean_or_zero(value: Column) -> Column:
    return F.coalesce(F.avg(value), F.lit(0.0))
