"""Tokenised samples: ids, labels, truncation, splits and statistics."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.fixed import IGNORE_LABEL
from millrace.operators.template import response_marker
from millrace.plans.hashed import within_first
from millrace.plans.ordered import values_at

# Words and single punctuation marks; the syntax is common to Java and RE2.
WORD_PATTERN = r"[\p{L}\p{M}\p{N}_]+|[^\p{L}\p{M}\p{N}_\s]"
VOCABULARY = 50_257
EOS_ID = VOCABULARY - 1


def word_ids(text: Column) -> Column:
    """Default tokenizer: a stable hash id for every word and punctuation mark."""
    words = F.regexp_extract_all(text, F.lit(WORD_PATTERN), F.lit(0))
    return F.transform(words, lambda w: (F.conv(F.substring(F.md5(w), 1, 8), 16, 10).cast("bigint") % EOS_ID).cast("int"))


def tokenize_with_labels(
    df: DataFrame,
    rendered: str,
    template: str,
    max_length: int,
    add_eos: bool = True,
    tokenizer: Callable[[Column], Column] = word_ids,
    eos_id: int = EOS_ID,
) -> DataFrame:
    """Add input_ids, attention_mask, labels and was_truncated.

    Labels are ignored up to and including the response marker; without a marker they are all
    ignored.  ``tokenizer`` maps a text column to an array<int> column and may be a pandas UDF.
    """
    marker = response_marker(template)
    at = F.locate(marker, F.col(rendered)) if marker else F.lit(0)
    prompt = F.when(at > 0, F.substring(F.col(rendered), F.lit(1), at + F.lit(len(marker) - 1)))
    staged = df.withColumns({"_prompt": prompt, "_all": tokenizer(F.col(rendered))}).withColumns(
        {
            "_ids": F.concat("_all", F.array(F.lit(eos_id))) if add_eos else F.col("_all"),
            "_np": F.when(F.col("_prompt").isNotNull(), F.size(tokenizer(F.coalesce("_prompt", F.lit(""))))),
        }
    )
    n = F.size("_ids")
    kept = F.least(n, F.lit(max_length))
    ignored = F.least(F.coalesce("_np", n), kept)
    return staged.withColumns(
        {
            "input_ids": F.slice("_ids", 1, max_length),
            "attention_mask": F.array_repeat(F.lit(1), kept),
            "labels": F.concat(
                F.array_repeat(F.lit(IGNORE_LABEL), ignored), F.slice(F.col("_ids"), ignored + 1, kept - ignored)
            ),
            "was_truncated": n > max_length,
        }
    ).drop("_prompt", "_all", "_ids", "_np")


def truncate(ids: Column, max_length: int) -> tuple[Column, Column]:
    """(ids cut to max_length, whether anything was cut)."""
    return F.slice(ids, 1, max_length), F.size(ids) > max_length


def drop_unlabeled(df: DataFrame, labels: str = "labels") -> DataFrame:
    return df.filter(F.exists(labels, lambda x: x != IGNORE_LABEL))


def require_samples(df: DataFrame) -> DataFrame:
    if df.isEmpty():
        raise ValueError("No samples survived")
    return df


def split_dataset(
    df: DataFrame,
    key: str,
    train: float = 0.9,
    validation: float = 0.05,
    seed: int = 42,
    shuffle: bool = True,
    out: str = "split",
) -> DataFrame:
    """Add the split name.  Validation and test get floor(n * share) rows but at least one each.

    The order is the seeded hash of the unique ``key``, or ``key`` itself (a number) without
    ``shuffle``.  Only the two border rows are searched for; every row is then labelled where it
    lies, so the data is not shuffled.
    """
    n = df.count()
    test = 1.0 - train - validation
    n_val = max(1, int(n * validation + 1e-9)) if n >= 3 else 0
    n_test = max(1, int(n * test + 1e-9)) if n >= 3 else 0
    n_train = n - n_val - n_test
    borders = [n_train, n_train + n_val]
    if shuffle:
        in_train, in_val = within_first(df, key, seed, borders, n)
    elif n < 3:
        in_train, in_val = F.lit(True), F.lit(True)
    else:
        last = values_at(df, key, {"train": n_train - 1, "validation": n_train + n_val - 1})
        in_train, in_val = F.col(key) <= F.lit(last["train"]), F.col(key) <= F.lit(last["validation"])
    return df.withColumn(out, F.when(in_train, "train").when(in_val, "validation").otherwise("test"))


def token_statistics(df: DataFrame, labels: str = "labels", approximate: bool = False) -> DataFrame:
    """Totals, averages, maxima and p50/p90/p95/p99 of sample lengths.

    Prompt tokens are the ignored labels.  Lengths are counted per distinct value first, so the
    exact percentiles work on a histogram bounded by the longest sample.
    """
    n = F.size(labels)
    prompt = F.size(F.filter(labels, lambda x: x == IGNORE_LABEL))
    lengths = df.select(n.alias("n"), prompt.alias("p"), (n - prompt).alias("r"))
    hist = lengths.groupBy("n").agg(
        F.count(F.lit(1)).alias("c"), F.sum("p").alias("sp"), F.sum("r").alias("sr"), F.max("p").alias("mp"), F.max("r").alias("mr")
    )
    marks = {"p50": 0.5, "p90": 0.9, "p95": 0.95, "p99": 0.99}
    if approximate:
        rows, p, r = F.count("n"), F.col("p"), F.col("r")
        totals = [rows, F.avg(p), F.avg(r), F.max(p), F.max(r)]
        cuts = [F.percentile_approx("n", q).cast("double").alias(k) for k, q in marks.items()]
        return lengths.agg(*[t.alias(n) for t, n in zip(totals, _TOTALS)], *cuts)
    rows = F.sum("c")
    totals = [F.coalesce(rows, F.lit(0)), F.sum("sp") / rows, F.sum("sr") / rows, F.max("mp"), F.max("mr")]
    cuts = [F.percentile("n", F.lit(q), F.col("c")).alias(k) for k, q in marks.items()]
    return hist.agg(*[t.alias(n) for t, n in zip(totals, _TOTALS)], *cuts)


_TOTALS = ("total_samples", "avg_input_tokens", "avg_output_tokens", "max_input_tokens", "max_output_tokens")
