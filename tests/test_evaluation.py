"""Metrics, model comparison and drift."""

import bisect
import itertools
import math
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from millrace.functions.kernels import equal_sizes_p, expansion_p, ks_p_value, lattice_p
from millrace.operators import drift, evaluate, metrics as m, sketches

PAIRS = "id int, prediction string, reference string"


def pairs(spark, *rows):
    return spark.createDataFrame([(i, p, r) for i, (p, r) in enumerate(rows)], PAIRS)


def texts(spark, *rows):
    return spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "id int, text string")


def test_perplexity(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,)], "loss double")
    assert m.perplexity(df, "loss").first()[0] == pytest.approx(math.exp(2))


@pytest.mark.parametrize("n,want", [(0, []), (5, [(0, 5)]), (10, [(0, 10)]), (11, [(0, 10), (4, 11)]), (18, [(0, 10), (4, 14), (8, 18)])])
def test_sliding_windows(spark, n, want):
    df = spark.createDataFrame([(1, list(range(n)))], "id int, ids array<int>")
    got = m.sliding_token_windows(df, "id", "ids", 10, 4).orderBy("window_start").collect()
    assert [(r["window_start"], r["window_end"]) for r in got] == want
    assert all(r["window_ids"] == list(range(r["window_start"], r["window_end"])) for r in got)


def test_exact_match_and_accuracy(spark):
    df = pairs(spark, ("The cat", "the cat"), (" a  dog ", "dog"), ("cat.", "cat"), ("x", None))
    assert m.exact_match(df).first()[0] == 0.5
    assert m.exact_match(df, normalise=False).first()[0] == 0.0
    assert m.accuracy(pairs(spark, (" a ", "a"), ("b", "c"))).first()[0] == 0.5
    assert m.exact_match(pairs(spark, ("éa", "é"))).first()[0] == 0.0
    none = pairs(spark, ("a", "a")).limit(0)
    for got in (m.exact_match(none), m.accuracy(none), m.batch_f1(none)):
        assert got.first()[0] == 0.0


@pytest.mark.parametrize(
    "p,r,f1",
    [("hello world", "hello there", 0.5), ("a a b", "a b b", 2 / 3), ("cat dog", "fish bird", 0.0), ("", "x", 0.0), ("x", "", 0.0), ("Cat", "cat", 0.0)],
)
def test_token_f1(spark, p, r, f1):
    assert m.token_f1(pairs(spark, (p, r))).first()["f1"] == pytest.approx(f1)


sentence = st.lists(st.sampled_from("a b c d e".split()), max_size=8).map(" ".join)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(sentence, sentence), min_size=1, max_size=15))
def test_f1_is_symmetric_and_rouge_l_matches_table(spark, rows):
    def lcs(a, b):
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, j in itertools.product(range(len(a)), range(len(b))):
            best[i + 1][j + 1] = best[i][j] + 1 if a[i] == b[j] else max(best[i][j + 1], best[i + 1][j])
        return best[-1][-1]

    there = [r["f1"] for r in m.token_f1(pairs(spark, *rows)).orderBy("id").collect()]
    back = [r["f1"] for r in m.token_f1(pairs(spark, *[(b, a) for a, b in rows])).orderBy("id").collect()]
    assert there == pytest.approx(back)
    for (p, r), row in zip(rows, m.rouge_per_row(pairs(spark, *rows)).orderBy("id").collect()):
        a, b = p.split(), r.split()
        n = lcs(a, b)
        assert row["rougeL"] == pytest.approx(2 * n / (len(a) + len(b)) if n else 0.0)
        assert row["rouge1"] >= row["rougeL"] - 1e-12


def union_lcs_by_hand(prediction, reference):
    """Hits of rougeLsum by enumerating subsequences; small sentences without repeated words have one longest."""
    hits, free = 0, {w for line in prediction for w in line}
    for sentence in reference:
        union = set()
        for other in prediction:
            best = ()
            for size in range(min(len(sentence), len(other)), 0, -1):
                found = [c for c in itertools.combinations(range(len(sentence)), size) if _is_subsequence([sentence[i] for i in c], other)]
                if found:
                    assert len(found) == 1 or size
                    best = max(found, key=lambda c: c[::-1])
                    break
            union |= set(best)
        for i in sorted(union):
            if sentence[i] in free:
                free.discard(sentence[i])
                hits += 1
    return hits


def _is_subsequence(part, whole):
    rest = iter(whole)
    return all(w in rest for w in part)


def test_rouge_l_sum_is_the_union_over_lines(spark):
    cases = [
        ("the cat sat", "the cat sat"), ("w1 w2 w6 w7 w8\nw1 w3 w8 w9 w5", "w1 w2 w3 w4 w5"), ("a b\nc d", "c d\na b"), ("a\n\n  \nb c", "b a c"), ("", "x\ny"), ("x\ny", ""),
        ("One, two.\nThree!", "three two\none"), ("p q r\ns t", "t s\nr q p\nz"),
    ]
    for (p, r), row in zip(cases, m.rouge_per_row(pairs(spark, *cases)).orderBy("id").collect()):
        a, b = ([re.findall("[a-z0-9]+", line.lower()) for line in side.split("\n")] for side in (p, r))
        n, size = union_lcs_by_hand([s for s in a if s], [s for s in b if s]), sum(map(len, a)) + sum(map(len, b))
        assert row["rougeLsum"] == pytest.approx(2 * n / size if n else 0.0), (p, r)
    # The example that defines the measure: four of five reference words lie on one of two subsequences.
    second = m.rouge_per_row(pairs(spark, cases[1])).first()
    assert second["rougeLsum"] == pytest.approx(2 * 4 / 15)


def test_compare_against_base_uses_both_metrics(spark):
    rows = [(i, "a b c" if i % 2 else "x", "a b c", "a b c") for i in range(40)]
    df = spark.createDataFrame(rows, "pair_id long, text_a string, text_b string, reference string")
    scored = evaluate.sample_scores(df, ["rouge_l", "exact_match"], "text_a", "text_b")
    found = {r["metric"]: r for r in evaluate.compare_against_base(scored).collect()}
    assert set(found) == {"rouge_l", "exact_match"}
    assert all((r["model_a_value"], r["model_b_value"], r["winner"]) == (0.5, 1.0, "model_b") for r in found.values())


def brute_two_sample(d, n, m):
    """Share of all interleavings of two samples whose statistic reaches d."""
    hits = total = 0
    for places in itertools.combinations(range(n + m), n):
        first, a, top = set(places), 0, 0.0
        for k in range(n + m):
            a += k in first
            top = max(top, abs(a / n - (k + 1 - a) / m))
        hits, total = hits + (top >= d - 1e-12), total + 1
    return hits / total


@pytest.mark.parametrize("n, m", [(4, 4), (6, 6), (3, 5), (7, 2), (5, 6)])
def test_exact_p_values_equal_enumeration(n, m):
    for d in {abs(i / n - j / m) for i in range(n + 1) for j in range(m + 1)} - {0.0}:
        assert lattice_p(d, n, m) == pytest.approx(brute_two_sample(d, n, m), abs=1e-12)
        if n == m:
            assert equal_sizes_p(round(d * n), n) == pytest.approx(brute_two_sample(d, n, m), abs=1e-12)


@pytest.mark.parametrize("n", [9_999, 10_000, 10_001, 10**6, 10**9])
def test_p_values_of_equal_sizes_have_no_step(n):
    for x in (0.5, 0.9, 1.36, 2.0):
        h = round(x * math.sqrt(2 * n))
        limit = 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * (h / math.sqrt(2 * n)) ** 2) for k in range(1, 40))
        # The closed form moves towards the limit as 1 / n and agrees with factorials where these have digits.
        assert equal_sizes_p(h, n) == pytest.approx(limit, abs=2 / n + 1e-9)
        if n <= 10_001:
            plain = 2 * sum((-1) ** (k - 1) * math.exp(2 * math.lgamma(n + 1) - math.lgamma(n - k * h + 1) - math.lgamma(n + k * h + 1)) for k in range(1, n // h + 1))
            assert equal_sizes_p(h, n) == pytest.approx(plain, rel=1e-8)


def test_expansion_meets_exact_values():
    def one_sample(d, n):
        """Marsaglia, Tsang and Wang's power of a matrix."""
        k = int(n * d) + 1
        size, h = 2 * k - 1, k - n * d
        matrix = np.array([[1.0 if i - j + 1 >= 0 else 0.0 for j in range(size)] for i in range(size)])
        for i in range(size):
            matrix[i, 0] -= h ** (i + 1)
            matrix[size - 1, i] -= h ** (size - i)
        matrix[size - 1, 0] += (2 * h - 1) ** size if 2 * h > 1 else 0
        for i in range(size):
            for j in range(size):
                if i - j + 1 > 0:
                    matrix[i, j] /= math.factorial(i - j + 1)
        power = np.linalg.matrix_power(matrix, n)[k - 1, k - 1]
        for i in range(1, n + 1):
            power *= i / n
        return 1 - power

    for n in (40, 90):
        for x in (0.6, 0.9, 1.2, 1.5):
            d = x / math.sqrt(n)
            assert expansion_p(d, n) == pytest.approx(one_sample(d, n), abs=3e-5)
    # Two samples just below and above the number of lattice points: no step beyond a thousandth.
    for n, m in ((9_000, 11_000), (7_000, 14_000)):
        for x in (0.8, 1.1, 1.4):
            d = round(x * math.sqrt((n + m) / (n * m)) * n * m) / (n * m)
            assert expansion_p(d, round(n * m / (n + m))) == pytest.approx(lattice_p(d, n, m), abs=4e-3)


def test_quantile_sketches_merge_within_their_error(spark):
    import random

    draw = random.Random(1)
    values = [draw.lognormvariate(3, 1) for _ in range(60_000)]
    df = spark.createDataFrame([(i % 7, i % 2, v) for i, v in enumerate(values)] + [(0, 0, None), (0, 0, float("nan"))], "day int, k int, v double")
    daily = sketches.quantile_sketches(df, ["k", "day"], "v")
    assert daily.count() == 14
    for row in sketches.quantiles(daily, ["k"], {"p50": 0.5, "p99": 0.99}).collect():
        own = sorted(v for i, v in enumerate(values) if i % 2 == row["k"])
        assert row["n"] == len(own)
        for name, q in (("p50", 0.5), ("p99", 0.99)):
            assert abs(bisect.bisect_right(own, row[name]) / len(own) - q) < 0.006


def test_distinct_sketches_unite(spark):
    texts = [(d, f"w{i % 5000} w{i * 7 % 9001} x") for d in range(3) for i in range(d * 3000, d * 3000 + 6000)] + [(9, "one"), (9, None)]
    df = spark.createDataFrame(texts, "day int, t string")
    stored = sketches.ngram_sketches(df, "t", 2, ["day"])
    assert {r["day"] for r in stored.collect()} == {0, 1, 2}
    exact, found = m.distinct_n(df, "t", 2).first(), sketches.approx_distinct_n(stored).first()
    assert found["total_ngrams"] == exact["total_ngrams"] and found["distinct_ngrams"] == pytest.approx(exact["distinct_ngrams"], rel=0.02)
    assert found["distinct_n"] + found["repetition_rate"] == pytest.approx(1.0)


def test_rouge_splits_on_other_characters(spark):
    row = m.rouge_per_row(pairs(spark, ("The CAT-sat!", "the cat sat"))).first()
    assert row["rouge1"] == row["rouge2"] == row["rougeL"] == 1.0


def test_bleu(spark):
    same = m.bleu(pairs(spark, ("the cat sat on the mat", "the cat sat on the mat"))).first()
    assert same["bleu"] == pytest.approx(1.0) and same["brevity_penalty"] == 1.0
    short = m.bleu(pairs(spark, ("the cat sat on", "the cat sat on the mat"))).first()
    assert short["bleu"] == pytest.approx(math.exp(1 - 6 / 4))
    assert m.bleu(pairs(spark, ("a b", "c d"))).first()["bleu"] == 0.0
    df = spark.createDataFrame([("a b c d", ["x y z w", "a b c d"])], "prediction string, reference array<string>")
    assert m.bleu(df).first()["bleu"] == pytest.approx(1.0)


def test_diversity_and_repetition(spark):
    same = texts(spark, *["hello hello hello"] * 5)
    row = m.diversity(same, "text").first()
    assert row["distinct_1"] == pytest.approx(1 / 15) and row["distinct_3"] == pytest.approx(1 / 5)
    assert m.distinct_n(texts(spark, *["the cat sat on the mat"] * 10), "text", 3).first()["repetition_rate"] == pytest.approx(0.9)
    assert m.distinct_n(texts(spark, "a"), "text", 3).first()["distinct_n"] == 0.0
    assert tuple(m.diversity(texts(spark, "").limit(0), "text").first()) == (0.0, 0.0, 0.0)


def sentence_bleu(hypothesis, references):
    score = 0.0
    for n in (1, 2, 3, 4):
        grams = lambda t: [tuple(t[i : i + n]) for i in range(len(t) - n + 1)]
        mine = grams(hypothesis)
        hit = sum(min(mine.count(g), max(grams(r).count(g) for r in references)) for g in set(mine))
        if n == 1 and hit == 0:
            return 0.0
        score += math.log((hit or 0.1) / max(len(mine), 1)) / 4
    ref = min((len(r) for r in references), key=lambda k: (abs(k - len(hypothesis)), k))
    return math.exp(score) * (1.0 if len(hypothesis) > ref else math.exp(1 - ref / len(hypothesis)))


def grams_moved(spark, df):
    """Whether a plan makes a row of every n-gram."""
    return "Generate" in df._jdf.queryExecution().executedPlan().toString()


def test_ngrams_are_counted_without_a_row_each(spark, monkeypatch):
    from millrace.functions import exchange

    monkeypatch.setattr(exchange, "PART_LEAST", 3)
    rng = random.Random(5)
    rows = [(rng.choice(["de", "en", None]), " ".join(rng.choice(["The", "cat", "sat", "Über", "x\u3000y", "on"]) for _ in range(rng.randint(0, 9)))) for _ in range(60)] + [("fr", None), ("fr", "one")]
    df = spark.createDataFrame(rows, "lang string, t string")
    for n in (1, 2, 3):
        want = {}
        for lang, text in rows:
            words = (text or "").lower().split()
            want.setdefault(lang, []).extend(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
        got = m.distinct_n(df, "t", n, ["lang"])
        assert not grams_moved(spark, got)
        assert {r["lang"]: (r["distinct_ngrams"], r["total_ngrams"]) for r in got.collect()} == {k: (len(set(g)), len(g)) for k, g in want.items() if g}
    assert not grams_moved(spark, m.diversity(df, "t"))
    assert not grams_moved(spark, sketches.ngram_sketches(df, "t", 2, ["lang"]))


def test_self_bleu_moves_no_ngrams_and_merges_repeated_keys(spark):
    rows = [(1, "the cat sat on a mat"), (1, "the cat"), (2, "the cat sat"), (None, "the cat sat"), (3, "alone")]
    got = m.self_bleu(spark.createDataFrame(rows, "id int, text string"), "id", "text")
    assert not grams_moved(spark, got)
    found = [(r["id"], r["self_bleu"]) for r in got.collect()]
    assert len(found) == 5 and dict(found)[None] == dict(found)[3] == 0.0 and len({s for k, s in found if k == 1}) == 2


@pytest.mark.parametrize("small_total", [5_000_000, 5])
def test_self_bleu_matches_brute_force(spark, small_total):
    rng = random.Random(4)
    rows = [" ".join(rng.choice("the cat sat on a mat".split()) for _ in range(rng.randint(1, 12))) for _ in range(20)]
    got = {r["id"]: r["self_bleu"] for r in m.self_bleu(texts(spark, *rows), "id", "text", small_total).collect()}
    for i, t in enumerate(rows):
        others = [o.split() for j, o in enumerate(rows) if j != i]
        assert got[i] == pytest.approx(sentence_bleu(t.split(), others)), t
    assert m.corpus_self_bleu(texts(spark, "only one"), "id", "text").first()[0] == 0.0


def test_coherence(spark):
    assert m.coherence(texts(spark, "a b", "a b"), "text").first()[0] == 1.0
    assert m.coherence(texts(spark, "one"), "text").first()[0] == 1.0
    assert m.coherence(texts(spark, "", ""), "text").first()[0] == 0.0
    assert m.coherence(texts(spark, "a").limit(0), "text").first()[0] == 0.0
    assert m.coherence(texts(spark, "a", "a b c"), "text").first()[0] == pytest.approx(0.5)
    ids = spark.createDataFrame([([1, 1],), ([1, 2],), ([5],)], "ids array<int>")
    assert m.coherence_of_ids(ids, "ids").first()[0] == pytest.approx(1 - 0.0625)


def test_toxicity(spark):
    df = texts(spark, "I hate the stupid idiot", "go to hell.", "fine")
    assert tuple(m.toxicity(df, "text").first()) == (pytest.approx(0.2), 0.6, 1)
    assert [r["id"] for r in m.toxic_rows(df, "id", "text").collect()] == [0]
    assert tuple(m.toxicity(df.limit(0), "text").first()) == (0.0, 0.0, 0)


def test_gate_prefers_minimum_and_skips_unnamed(spark):
    df = spark.createDataFrame(
        [("t", "exact_match", 0.4), ("t", "rouge_l", 0.3), ("x", "perplexity", 15.1), ("x", "mean_toxicity", 0.9), ("x", "toxicity", 0.1)],
        "task string, metric string, value double",
    )
    got = {r["metric"]: r["status"] for r in evaluate.threshold_gate(df).collect()}
    assert got == {"exact_match": "FAIL", "rouge_l": "PASS", "perplexity": "FAIL", "toxicity": "PASS"}
    both = evaluate.threshold_gate(df, {"min_toxicity": 0.5, "max_toxicity": 0.5}).collect()
    assert [(r["bound"], r["status"]) for r in both] == [("min", "FAIL")]


def scores(spark, a, b):
    return spark.createDataFrame([(float(x), float(y)) for x, y in zip(a, b)], "q_a double, q_b double")


def test_comparison_and_recommendation(spark):
    better = evaluate.compare_models(scores(spark, [0.1] * 30, [0.5 + i / 100 for i in range(30)]), ["q"])
    row = better.first()
    assert row["winner"] == "model_b" and row["p_value"] == 0.0 and row["method"] == "poisson"
    assert row["relative_change_pct"] == pytest.approx((row["model_b_value"] - 0.1) / 0.1 * 100)
    assert evaluate.recommend(better, "x", "y").first()["recommendation"] == "Take model B (y): it is ahead in 1 of 1 metrics, and 0 are even."
    same = evaluate.compare_models(scores(spark, [1, 0], [1, 0]), ["q"])
    assert (same.first()["winner"], same.first()["p_value"]) == ("tie", 1.0)
    assert evaluate.recommend(same, "x", "y").first()["recommendation"].startswith("Neither model is ahead: 1 of 1 metrics")
    empty = evaluate.compare_models(scores(spark, [1], [1]).limit(0), ["q"]).first()
    assert (empty["model_a_value"], empty["p_value"], empty["winner"]) == (0.0, 1.0, "tie")
    zero = evaluate.compare_models(scores(spark, [0, 0], [1, 1]), ["q"]).first()
    assert zero["relative_change_pct"] == 0.0 and zero["winner"] == "model_b"


@pytest.mark.parametrize("leaf_cells, fan_bits", [(512, 8), (4, 2)])
def test_multinomial_resamples_have_all_rows(spark, leaf_cells, fan_bits):
    """Sizes are exact, and mean and variance of the totals those of a multinomial draw, at every depth of the tree."""
    import numpy as np

    cells = [("q", round(i / 7 - 4, 12), i % 5 + 1) for i in range(60)] + [("one", 0.5, 9)]
    df = spark.createDataFrame(cells, "metric string, d double, c long")
    found = evaluate.multinomial_sums(df, 2000, 7, leaf_cells, fan_bits).toPandas()
    sums = found.groupby(["metric", "replicate"])[["total", "drawn"]].sum()
    assert (sums.loc["one", "total"] == 4.5).all() and (sums.loc["one", "drawn"] == 9).all()
    d, c = (np.array([x[k] for x in cells if x[0] == "q"], float) for k in (1, 2))
    n, p = c.sum(), c / c.sum()
    assert (sums.loc["q", "drawn"] == n).all() and len(sums.loc["q"]) == 2000
    total = sums.loc["q", "total"]
    spread = np.sqrt(n * (p @ d**2 - (p @ d) ** 2))
    assert abs(total.mean() - n * (p @ d)) < 5 * spread / np.sqrt(2000)
    assert total.std() == pytest.approx(spread, rel=0.1)
    again = evaluate.multinomial_sums(df.repartition(5), 2000, 7, leaf_cells, fan_bits).toPandas()
    assert np.allclose(again.groupby(["metric", "replicate"])["total"].sum(), sums["total"])


def test_bootstrap_agrees_between_methods_and_with_resampling(spark):
    rng = random.Random(8)
    a = [rng.random() for _ in range(60)]
    b = [x + rng.gauss(0.03, 0.2) for x in a]
    exact = evaluate.bootstrap_p(scores(spark, a, b), ["q"], method="multinomial").first()
    poisson = evaluate.bootstrap_p(scores(spark, a, b), ["q"]).first()
    d = [y - x for x, y in zip(a, b)]
    crossed = sum(sum(rng.choices(d, k=60)) <= 0 for _ in range(4000)) / 4000
    assert exact["p_value"] == pytest.approx(crossed, abs=0.06)
    assert poisson["method"] == "poisson" and poisson["p_value"] == pytest.approx(crossed, abs=0.06)
    assert exact["p_value"] == evaluate.bootstrap_p(scores(spark, a, b).repartition(7), ["q"], method="multinomial").first()["p_value"]
    assert evaluate.bootstrap_p(scores(spark, a, b).limit(0), ["q"]).first()["p_value"] == 1.0


def test_sample_scores(spark):
    df = spark.createDataFrame([("the cat", " The Cat", "dog")], "reference string, a string, b string")
    row = evaluate.sample_scores(df, ["exact_match", "f1_token", "rouge_l", "nonsense"], "a", "b").first()
    assert (row["exact_match_a"], row["exact_match_b"], row["f1_token_a"], row["rouge_l_a"], row["nonsense_a"]) == (1.0, 0.0, 0.0, 1.0, 0.0)


# ---- drift


def all_paths_p(d, n, m):
    hits = total = 0
    for where in itertools.combinations(range(n + m), n):
        x = y = 0
        top = 0.0
        for i in range(n + m):
            x, y = (x + 1, y) if i in where else (x, y + 1)
            top = max(top, abs(x / n - y / m))
        total += 1
        hits += top >= d - 1e-12
    return hits / total


@pytest.mark.parametrize("a,b", [([1, 2, 3, 4], [3, 4, 5, 6]), ([1, 2, 3], [2, 9, 9, 9, 10]), ([1, 1, 1, 2], [1, 5, 5, 5]), ([1, 2], [1, 2])])
@pytest.mark.parametrize("rows_per_block", [1_000_000, 2])
def test_ks(spark, a, b, rows_per_block):
    frame = lambda v: spark.createDataFrame([(float(x),) for x in v], "v double")
    row = drift.ks_two_sample(frame(a), frame(b), "v", rows_per_block=rows_per_block).first()
    points = sorted(set(a + b))
    want = max(abs(sum(x <= p for x in a) / len(a) - sum(x <= p for x in b) / len(b)) for p in points)
    assert row["statistic"] == pytest.approx(want)
    assert row["p_value"] == pytest.approx(all_paths_p(want, len(a), len(b)))


def test_ks_limit_is_close_to_exact(spark):
    df = spark.createDataFrame([(0.02, 10_000, 10_000), (0.02, 10_001, 10_001), (0.02, 10_000, 9_999)], "d double, n int, m int")
    p = [r["p"] for r in df.select(ks_p_value("d", "n", "m")["p"].alias("p")).collect()]
    assert p[0] == pytest.approx(p[1], abs=2e-3) and p[0] == pytest.approx(p[2], abs=2e-3)


def test_ks_vs_constant_is_ks_against_copies(spark):
    values = [1.0, 2.0, 2.0, 5.0, 6.0, 7.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    constant = spark.createDataFrame([(2.0,)] * len(values), "v double")
    a = drift.ks_vs_constant(df, "v", 2.0).first()
    b = drift.ks_two_sample(constant, df, "v").first()
    assert a["statistic"] == pytest.approx(b["statistic"]) and a["p_value"] == pytest.approx(b["p_value"])


def test_output_drift(spark):
    base = {"avg_response_length": 50.0, "refusal_rate": 0.01}
    row = drift.output_drift(texts(spark, *["I cannot help with that request"] * 5), "text", base).first()
    assert row["drifted"] and row["refusal_rate"] == 1.0 and any("refusal_rate: 0.01 -> 1.00" == d for d in row["details"])
    calm = drift.output_drift(texts(spark, "x y", ""), "text", {}).first()
    assert not calm["drifted"] and calm["details"] == [] and calm["avg_response_length"] == 1.0
    assert drift.output_drift(texts(spark, "x").limit(0), "text", base).first()["n"] == 0
    features = drift.output_features(texts(spark, "a b a b a"), "text").first()
    assert features["vocab_richness"] == pytest.approx(0.4) and features["repetition_rate"] == pytest.approx(0.5)


def test_input_drift(spark):
    row = drift.input_drift(texts(spark, "a b", "c", "d e f", "g"), "text", {"avg_length": 3.0}).first()
    assert row["sample_count"] == 4 and row["max_length"] == 3.0
    long = drift.input_drift(texts(spark, " ".join("x" * 20)), "text", {"max_length": 10.0}).first()
    assert long["drifted"] and long["details"] == ["max_length exceeded: 20 vs training 10"]
    assert drift.input_drift(texts(spark, "x").limit(0), "text", {}).first()["sample_count"] == 1


def test_embedding_and_performance_drift(spark):
    vec = lambda *rows: spark.createDataFrame([(list(map(float, r)),) for r in rows], "e array<float>")
    assert drift.embedding_drift(vec([1, 0], [0, 1]), vec([2, 2]), "e").first()[0] == pytest.approx(0.0)
    assert drift.embedding_drift(vec([1, 0]), vec([-1, 0]), "e").first()[0] == pytest.approx(2.0)
    frame = lambda d: spark.createDataFrame(list(d.items()), "metric string, value double")
    base, now = {"a": 0.95, "b": 0.95, "z": 0.0, "gone": 1.0, "loss": 1.0}, {"a": 0.94, "b": 0.5, "z": 1.0, "loss": 2.0}
    got = {r["metric"]: r["degraded"] for r in drift.performance_drift(frame(base), frame(now)).collect()}
    assert got == {"a": False, "b": True, "loss": False}
    got = {r["metric"]: r["degraded"] for r in drift.performance_drift(frame(base), frame(now), lower_is_better=["loss"]).collect()}
    assert got["loss"]
