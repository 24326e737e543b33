"""Text quality and evaluation metrics over documents, conversations and benchmark."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.fixed import TOXIC_KEYWORDS
from millrace.operators import evaluate, metrics as m, serving, sketches, tokens
from millrace.plans.durable import materialise
from millrace.plans.skew import null_safe_join
from millrace.workload import DOC_PAIRS_SQL, TURN_PAIRS_SQL, doc_pairs, load, query, rounded, toks, turn_pairs

_KEYWORDS = ", ".join(f"'{w}'" for w in TOXIC_KEYWORDS)
_TOX = f"least(len(list_intersect(list_distinct({toks('lower(text)')}), [{_KEYWORDS}])) / 5.0, 1.0)"

# Articles between non-word characters; twice, because neighbours share a separator.
_SEP = r"[^\p{L}\p{M}\p{N}_]"
_ART = rf"(^|{_SEP})(?:a|an|the)({_SEP}|$)"


def _normal(col: str) -> str:
    once = f"regexp_replace(lower({col}), '{_ART}', '\\1 \\2', 'g')"
    twice = f"regexp_replace({once}, '{_ART}', '\\1 \\2', 'g')"
    return f"array_to_string({toks(twice)}, ' ')"


@query("perplexity", "select event_type, round(exp(avg(value / 100)), 6) as perplexity from events group by event_type")
def _(spark, sf):
    losses = load(spark, sf, "events").select("event_type", (F.col("value") / 100).alias("loss"))
    return rounded(m.perplexity(losses, "loss", ["event_type"]))


@query(
    "sliding_token_windows",
    f"""with n as (select doc_id, len(regexp_extract_all(text, '{tokens.WORD_PATTERN}')) as n from documents)
    select doc_id, w * 256 as window_start, least(w * 256 + 512, n)::bigint as window_end
    from (select doc_id, n, unnest(range(0, case when n = 0 then 0 when n > 512 then ceil((n - 512) / 256.0)::bigint + 1 else 1 end)) as w from n)""",
)
def _(spark, sf):
    docs = load(spark, sf, "documents").select("doc_id", tokens.word_ids(F.col("text")).alias("ids"))
    windows = m.sliding_token_windows(docs, "doc_id", "ids", 512, 256)
    return windows.select("doc_id", F.col("window_start").cast("bigint").alias("window_start"), F.col("window_end").cast("bigint").alias("window_end"))


@query(
    "accuracy",
    f"""with p as ({DOC_PAIRS_SQL})
    select lang, round(avg(case when trim(prediction, e' \\t\\n\\r') = trim(reference, e' \\t\\n\\r') then 1.0 else 0.0 end), 6)::double as accuracy
    from p group by lang""",
)
def _(spark, sf):
    return rounded(m.accuracy(doc_pairs(spark, sf), ["lang"]))


@query(
    "exact_match",
    f"""with p as ({DOC_PAIRS_SQL})
    select lang, round(avg(case when {_normal('prediction')} = {_normal('reference')} then 1.0 else 0.0 end), 6)::double as exact_match
    from p group by lang""",
)
def _(spark, sf):
    return rounded(m.exact_match(doc_pairs(spark, sf), ["lang"]))


def _overlap_sql(pairs: str, key: str, tokens_p: str, tokens_r: str, n: int) -> str:
    """CTEs p, sizes and common: multiset n-gram overlap per pair."""
    gram = "array_to_string(list_slice(t, i, i + %d), ' ')" % (n - 1)
    side = lambda alias, expr: (
        f"{alias}{n} as (select k, g, count(*) as c from (select k, {gram} as g from (select k, t, unnest(range(1, len(t) - {n} + 2)) as i "
        f"from (select {key} as k, {expr} as t from pairs))) group by k, g)"
    )
    return (
        f"{side('p', tokens_p)}, {side('r', tokens_r)}, "
        f"m{n} as (select p.k, sum(least(p.c, r.c)) as m from p{n} p join r{n} r on p.k = r.k and p.g = r.g group by p.k), "
        f"l{n} as (select {key} as k, greatest(len({tokens_p}) - {n - 1}, 0) as a, greatest(len({tokens_r}) - {n - 1}, 0) as b from pairs), "
        f"f{n} as (select l.k, case when coalesce(m.m, 0) > 0 then 2.0 * (m.m / l.a) * (m.m / l.b) / (m.m / l.a + m.m / l.b) else 0.0 end as f "
        f"from l{n} l left join m{n} m on l.k = m.k)"
    )


@query(
    "token_f1",
    f"""with pairs as ({TURN_PAIRS_SQL}), {_overlap_sql('pairs', 'pair_id', toks('prediction'), toks('reference'), 1)}
    select k as pair_id, round(f, 6)::double as f1 from f1""",
)
def _(spark, sf):
    return rounded(m.token_f1(turn_pairs(spark, sf)).select("pair_id", "f1"))


@query(
    "batch_f1",
    f"""with pairs as (select * from ({DOC_PAIRS_SQL}) where reference is not null), {_overlap_sql('pairs', 'doc_id', toks('prediction'), toks('reference'), 1)}
    select d.lang, round(avg(f), 6)::double as batch_f1 from f1 join pairs d on d.doc_id = f1.k group by d.lang""",
)
def _(spark, sf):
    return rounded(m.batch_f1(doc_pairs(spark, sf), ["lang"]))


def _rouge_toks(col: str) -> str:
    return toks(f"regexp_replace(lower({col}), '[^a-z0-9]+', ' ', 'g')")


@query(
    "rouge",
    f"""with pairs as ({TURN_PAIRS_SQL}), {_overlap_sql('pairs', 'pair_id', _rouge_toks('prediction'), _rouge_toks('reference'), 1)},
    {_overlap_sql('pairs', 'pair_id', _rouge_toks('prediction'), _rouge_toks('reference'), 2)}
    select round(avg(f1.f), 6)::double as rouge1, round(avg(f2.f), 6)::double as rouge2 from f1 join f2 on f1.k = f2.k""",
)
def _(spark, sf):
    return rounded(m.rouge(turn_pairs(spark, sf)).select("rouge1", "rouge2"))


@query("rouge_l")
def _(spark, sf):
    return rounded(m.rouge_per_row(turn_pairs(spark, sf)).select("pair_id", F.col("rougeL").alias("rouge_l"), F.col("rougeLsum").alias("rouge_l_sum")))


_GRAMS_SQL = f"""select lang, source, array_to_string(t[i : i + 1], ' ') as g
    from (select lang, source, t, unnest(range(1, len(t))) as i from (select lang, source, {toks('lower(text)')} as t from documents) where len(t) > 1)"""


@query(
    "distinct_sketches",
    f"""with g as ({_GRAMS_SQL}), s as (select lang, source, count(*) as n from g group by all)
    select lang, sum(n)::bigint as total_ngrams, count(*) as sketches, (select count(distinct g) from g where g.lang is not distinct from s.lang) as exact_ngrams,
      true as near, true as same_as_one_pass from s group by lang""",
)
def _(spark, sf):
    docs = load(spark, sf, "documents")
    stored = materialise(sketches.ngram_sketches(docs, "text", 2, ["lang", "source"]), "gram-sketches")
    united = sketches.approx_distinct_n(stored, ["lang"]).select("lang", "total_ngrams", "distinct_ngrams")
    once = sketches.approx_distinct_n(sketches.ngram_sketches(docs, "text", 2, ["lang"]), ["lang"]).select("lang", F.col("distinct_ngrams").alias("once"))
    exact = m.distinct_n(docs, "text", 2, ["lang"]).select("lang", F.col("distinct_ngrams").alias("exact_ngrams"))
    counts = stored.groupBy("lang").agg(F.count("*").alias("sketches"))
    rows = null_safe_join(null_safe_join(null_safe_join(united, once, ["lang"]), exact, ["lang"]), counts, ["lang"])
    # Three standard errors; a union may use another estimator than one pass, so they agree to one.
    near = F.abs(F.col("distinct_ngrams") - F.col("exact_ngrams")) <= 0.02 * F.col("exact_ngrams")
    same = F.abs(F.col("distinct_ngrams") - F.col("once")) <= 0.0065 * F.col("exact_ngrams")
    return rows.select("lang", "total_ngrams", "sketches", "exact_ngrams", near.alias("near"), same.alias("same_as_one_pass"))


def _bleu_toks(col: str) -> str:
    out = f"replace(replace({col}, '-' || chr(10), ''), chr(10), ' ')"
    for entity, char in (("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
        out = f"replace({out}, '{entity}', '{char}')"
    out = f"' ' || {out} || ' '"
    out = f"regexp_replace({out}, '([\\{{-~\\[-` -&\\(-\\+:-@/])', ' \\1 ', 'g')"
    out = f"regexp_replace({out}, '([^0-9])([.,])', '\\1 \\2 ', 'g')"
    out = f"regexp_replace({out}, '([.,])([^0-9])', ' \\1 \\2', 'g')"
    out = f"regexp_replace({out}, '([0-9])(-)', '\\1 \\2 ', 'g')"
    return toks(out)


@query(
    "bleu",
    f"""with raw as ({TURN_PAIRS_SQL}),
    pairs as (select pair_id, {_bleu_toks('prediction')} as prediction, {_bleu_toks('reference')} as reference from raw),
    {', '.join(_overlap_sql('pairs', 'pair_id', 'prediction', 'reference', n) for n in (1, 2, 3, 4))},
    s as (select {', '.join(f'(select sum(m) from m{n}) / (select sum(a) from l{n}) as q{n}' for n in (1, 2, 3, 4))},
      (select sum(a) from l1) as hyp, (select sum(b) from l1) as ref)
    select round(case when least(coalesce(q1, 0), coalesce(q2, 0), coalesce(q3, 0), coalesce(q4, 0)) > 0
        then exp((ln(q1) + ln(q2) + ln(q3) + ln(q4)) / 4) * case when hyp > ref then 1.0 else exp(1 - ref / hyp) end else 0.0 end, 6)::double as bleu,
      round(case when hyp > ref then 1.0 else exp(1 - ref / hyp) end, 6)::double as brevity_penalty,
      round(coalesce(q1, 0), 6)::double as precision_1, round(coalesce(q2, 0), 6)::double as precision_2, round(coalesce(q3, 0), 6)::double as precision_3,
      round(coalesce(q4, 0), 6)::double as precision_4, round(coalesce(hyp / ref, 0), 6)::double as length_ratio,
      hyp::bigint as translation_length, ref::bigint as reference_length from s""",
)
def _(spark, sf):
    found = m.bleu(turn_pairs(spark, sf))
    each = {f"precision_{n}": F.col("precisions")[n - 1] for n in (1, 2, 3, 4)}
    return rounded(found.withColumns(each).drop("precisions"))


@query(
    "coherence",
    f"""with n as (select source, len({toks('text')}) as n from documents)
    select source, round(case when count(*) < 2 then 1.0 when avg(n) = 0 then 0.0 else greatest(0.0, least(1.0, 1 - stddev_pop(n) / avg(n))) end, 6)::double as coherence
    from n group by source""",
)
def _(spark, sf):
    return rounded(m.coherence(load(spark, sf, "documents"), "text", ["source"]))


@query(
    "coherence_of_ids",
    f"""with n as (select lang, regexp_extract_all(text, '{tokens.WORD_PATTERN}') as w from documents),
    h as (select lang, len(w) as n, len(list_distinct(list_transform(w, lambda x: ('0x' || substr(md5(x), 1, 8))::bigint % {tokens.EOS_ID}))) as u from n)
    select lang, round(greatest(0.0, least(1.0, 1 - var_pop(u / n))), 6)::double as coherence from h where n > 1 group by lang""",
)
def _(spark, sf):
    docs = load(spark, sf, "documents").select("lang", tokens.word_ids(F.col("text")).alias("ids"))
    return rounded(m.coherence_of_ids(docs, "ids", ["lang"]))


def _grams_sql(n: int, by: str) -> str:
    gram = f"array_to_string(list_slice(t, i, i + {n - 1}), ' ')"
    return (
        f"select {by}{gram} as g from (select {by}t, unnest(range(1, len(t) - {n} + 2)) as i "
        f"from (select {by}{toks('lower(text)')} as t from documents))"
    )


for _n in (1, 2, 3):

    @query(
        f"distinct_{_n}",
        f"""select lang, count(distinct g) as distinct_ngrams, count(*) as total_ngrams, round(count(distinct g) / count(*), 6)::double as distinct_n,
        round(1 - count(distinct g) / count(*), 6)::double as repetition_rate from ({_grams_sql(_n, 'lang, ')}) group by lang""",
    )
    def _(spark, sf, n=_n):
        return rounded(m.distinct_n(load(spark, sf, "documents"), "text", n, ["lang"]))


@query(
    "diversity",
    "select " + ", ".join(f"round((select count(distinct g) / count(*) from ({_grams_sql(n, '')})), 6)::double as distinct_{n}" for n in (1, 2, 3)),
)
def _(spark, sf):
    return rounded(m.diversity(load(spark, sf, "documents"), "text"))


@query(
    "repetition_rate",
    f"select round(1 - count(distinct g) / count(*), 6)::double as repetition_rate, count(*) as total_ngrams from ({_grams_sql(3, '')})",
)
def _(spark, sf):
    return rounded(m.distinct_n(load(spark, sf, "documents"), "text", 3).select("repetition_rate", "total_ngrams"))


@query(
    "self_bleu",
    f"""with d as (select item_id as k, {toks('lower(text)')} as t from benchmark),
    g as (select k, n, array_to_string(list_slice(t, i, i + n - 1), ' ') as g, count(*) as c
      from (select k, t, n, unnest(range(1, len(t) - n + 2)) as i from (select k, t, unnest([1, 2, 3, 4]) as n from d)) group by all),
    clipped as (select a.k, a.n, a.g, a.c, max(b.c) as top from g a left join g b on a.n = b.n and a.g = b.g and a.k <> b.k group by all),
    s as (select k, n, sum(least(c, coalesce(top, 0))) as hit from clipped group by k, n),
    lens as (select k, len(t) as len from d),
    ref as (select a.k, arg_min(b.len, abs(b.len - a.len) * 1000000 + b.len) as ref_len from lens a join lens b on a.k <> b.k group by a.k),
    full_s as (select lens.k, lens.len, x.n, coalesce(s.hit, 0) as hit from lens cross join (select unnest([1, 2, 3, 4]) as n) x left join s on s.k = lens.k and s.n = x.n),
    sc as (select k, any_value(len) as len, max(case when n = 1 then hit end) as h1,
      exp(avg(ln((case when hit > 0 then hit else 0.1 end) / greatest(len - n + 1, 1)))) as p from full_s group by k)
    select sc.k as item_id, round(case when h1 > 0 then p * case when len > ref_len then 1.0 else exp(1 - ref_len / len) end else 0.0 end, 6)::double as self_bleu
    from sc join ref on sc.k = ref.k""",
)
def _(spark, sf):
    return rounded(m.self_bleu(load(spark, sf, "benchmark"), "item_id", "text"))


@query("corpus_self_bleu")
def _(spark, sf):
    return rounded(m.corpus_self_bleu(load(spark, sf, "documents"), "doc_id", "text"))


@query(
    "toxicity",
    f"""select lang, round(avg(s), 6)::double as mean_toxicity, max(s)::double as max_toxicity, count(*) filter (s >= 0.5) as num_flagged
    from (select lang, {_TOX} as s from documents) group by lang""",
)
def _(spark, sf):
    return rounded(m.toxicity(load(spark, sf, "documents"), "text", ["lang"]))


@query("toxic_rows", f"select doc_id, toxicity::double as toxicity from (select doc_id, {_TOX} as toxicity from documents) where toxicity >= 0.5")
def _(spark, sf):
    return m.toxic_rows(load(spark, sf, "documents"), "doc_id", "text")


@query(
    "generation_speed",
    f"""select event_id, coalesce(case when value > 0 then round(length(props) / (value / 1000), 2) end, 0.0)::double as tokens_per_second from events""",
)
def _(spark, sf):
    events = load(spark, sf, "events").select("event_id", F.length("props").alias("num_tokens"), F.col("value").alias("latency_ms"))
    return m.generation_speed(events, "num_tokens", "latency_ms").select("event_id", "tokens_per_second")


@query(
    "benchmark_scores",
    f"""with pairs as ({DOC_PAIRS_SQL}), {_overlap_sql('pairs', 'doc_id', _rouge_toks('prediction'), _rouge_toks("coalesce(reference, '')"), 1)}
    select source as benchmark, count(*) as num_samples,
      round(avg(case when trim(prediction, e' \\t\\n\\r') = trim(reference, e' \\t\\n\\r') then 1.0 else 0.0 end), 6)::double as accuracy, round(avg(f), 6)::double as rouge1
    from pairs join f1 on f1.k = pairs.doc_id group by source""",
)
def _(spark, sf):
    pairs = doc_pairs(spark, sf).withColumnRenamed("source", "benchmark")
    return rounded(evaluate.benchmark_scores(pairs).select("benchmark", "num_samples", "accuracy", "rouge1"))


_TASK_SQL = f"""with pairs as (select * from ({DOC_PAIRS_SQL}) where reference is not null),
    {_overlap_sql('pairs', 'doc_id', toks('prediction'), toks('reference'), 1)},
    scores as (select lang as task, round(avg(case when {_normal('prediction')} = {_normal('reference')} then 1.0 else 0.0 end), 6)::double as em,
      round(avg(f), 6)::double as f1 from pairs join f1 on f1.k = pairs.doc_id group by lang)"""


@query(
    "custom_task_scores",
    f"""{_TASK_SQL} select task, 'exact_match' as metric, em as value from scores union all select task, 'f1_token', f1 from scores""",
)
def _(spark, sf):
    pairs = doc_pairs(spark, sf).filter("reference is not null")
    return rounded(evaluate.custom_task_scores(pairs, "lang", ["exact_match", "f1_token"]))


_FULL_SQL = f"""{_TASK_SQL}, ppl as (select round(exp(avg(value / 100)), 6) as p from events),
    speed as (select count(*) as n, avg(coalesce(case when value > 0 then round(length(props) / (value / 1000), 2) end, 0.0)) as s from events),
    docs as (select round(avg(case when {_normal('prediction')} = {_normal('reference')} then 1.0 else 0.0 end), 6)::double as em from pairs),
    everything as (select 'perplexity' as task, 'eval_perplexity' as metric, p as value from ppl
    union all select 'generation', 'num_samples', n::double from speed
    union all select 'generation', 'mean_tokens_per_second', round(s, 6)::double from speed
    union all select 'custom_docs', 'exact_match', em from docs)"""


def _full(spark, sf):
    events = load(spark, sf, "events")
    pairs = doc_pairs(spark, sf).filter("reference is not null")
    return evaluate.full_evaluation(
        losses=events.select((F.col("value") / 100).alias("loss")),
        generations=events.select(F.length("props").alias("num_tokens"), F.col("value").alias("latency_ms")),
        custom_tasks={"docs": (pairs, ["exact_match"])},
    )


@query("full_evaluation", f"{_FULL_SQL} select * from everything")
def _(spark, sf):
    return rounded(_full(spark, sf))


@query(
    "threshold_gate",
    f"""{_FULL_SQL} select task, 'exact_match' as metric, value, 'min' as bound, 0.5::double as threshold, case when value >= 0.5 then 'PASS' else 'FAIL' end as status
    from everything where metric = 'exact_match'
    union all select task, 'perplexity', value, 'max', 15.0::double, case when value <= 15.0 then 'PASS' else 'FAIL' end from everything where metric = 'eval_perplexity'""",
)
def _(spark, sf):
    named = _full(spark, sf).withColumn("metric", F.regexp_replace("metric", "^eval_", ""))
    return rounded(evaluate.threshold_gate(named))


def _two_models(spark, sf):
    """Model a answers with the user's text, model b with the reference without punctuation."""
    bare = F.regexp_replace("reference", "[.,]", "")
    return turn_pairs(spark, sf).withColumnRenamed("prediction", "text_a").withColumn("text_b", bare)


_MODELS_SQL = f"""select pair_id, reference, prediction as text_a, regexp_replace(reference, '[.,]', '', 'g') as text_b from ({TURN_PAIRS_SQL})"""


@query(
    "sample_scores",
    f"""with models as ({_MODELS_SQL}), pairs as (select pair_id * 2 as k2, text_a as prediction, reference from models union all select pair_id * 2 + 1, text_b, reference from models),
    {_overlap_sql('pairs', 'k2', toks('prediction'), toks('reference'), 1)}
    select pair_id, (lower(trim(text_a, e' \\t\\n\\r')) = lower(trim(reference, e' \\t\\n\\r')))::int::double as exact_match_a,
      (lower(trim(text_b, e' \\t\\n\\r')) = lower(trim(reference, e' \\t\\n\\r')))::int::double as exact_match_b,
      round(a.f, 6)::double as f1_token_a, round(b.f, 6)::double as f1_token_b
    from models join f1 a on a.k = pair_id * 2 join f1 b on b.k = pair_id * 2 + 1""",
)
def _(spark, sf):
    scored = evaluate.sample_scores(_two_models(spark, sf), ["exact_match", "f1_token"], "text_a", "text_b")
    return rounded(scored.select("pair_id", "exact_match_a", "exact_match_b", "f1_token_a", "f1_token_b"))


def _compared(spark, sf):
    names = ["exact_match", "f1_token", "rouge_l"]
    return evaluate.compare_models(evaluate.sample_scores(_two_models(spark, sf), names, "text_a", "text_b"), names)


_COMPARE_SQL = f"""with models as ({_MODELS_SQL}), pairs as (select pair_id * 2 as k2, text_a as prediction, reference from models union all select pair_id * 2 + 1, text_b, reference from models),
    {_overlap_sql('pairs', 'k2', toks('prediction'), toks('reference'), 1)},
    hits as (select k2 as k, (lower(trim(prediction, e' \\t\\n\\r')) = lower(trim(reference, e' \\t\\n\\r')))::int::double as f from pairs),
    each as (select 'f1_token' as metric, k // 2 as pair, max(f) filter (k % 2 = 0) as a, max(f) filter (k % 2 = 1) as b from f1 group by all
      union all select 'exact_match', k // 2, max(f) filter (k % 2 = 0), max(f) filter (k % 2 = 1) from hits group by all),
    means as (select metric, avg(a) as a, avg(b) as b, avg(b - a) / nullif(stddev_pop(b - a) / sqrt(count(*)), 0) as z from each group by metric)"""


# The winner by the normal limit of the bootstrap: 1.96 standard errors of the mean difference.
@query(
    "compare_models",
    f"""{_COMPARE_SQL} select metric, round(a, 6)::double as model_a_value, round(b, 6)::double as model_b_value,
      round(b - a, 6)::double as difference, case when a <> 0 then round((b - a) / abs(a) * 100, 4) else 0 end::double as relative_change_pct,
      case when z > 1.96 then 'model_b' when z < -1.96 then 'model_a' else 'tie' end as winner from means""",
)
def _(spark, sf):
    names = ["exact_match", "f1_token"]
    scored = evaluate.sample_scores(_two_models(spark, sf), names, "text_a", "text_b")
    rows = evaluate.compare_models(scored, names).select("metric", "model_a_value", "model_b_value", "difference", "relative_change_pct", "winner")
    return rounded(rows.withColumn("relative_change_pct", F.round("relative_change_pct", 4)))


_BASE_PAIRS = f"""with models as ({_MODELS_SQL}), pairs as (select pair_id * 2 as k2, text_a as prediction, reference from models union all select pair_id * 2 + 1, text_b, reference from models)"""


@query(
    "compare_against_base",
    f"""{_BASE_PAIRS}, h as (select k2 % 2 as side, avg((lower(trim(prediction, e' \\t\\n\\r')) = lower(trim(reference, e' \\t\\n\\r')))::int) as hit from pairs group by all)
    select 'exact_match' as metric, round(max(case when side = 0 then hit end), 6)::double as model_a_value, round(max(case when side = 1 then hit end), 6)::double as model_b_value from h""",
)
def _(spark, sf):
    scored = evaluate.sample_scores(_two_models(spark, sf), ["rouge_l", "exact_match"], "text_a", "text_b")
    # SQL has no longest common subsequence; the other metric is checked in the tests.
    rows = evaluate.compare_against_base(scored).filter("metric = 'exact_match'")
    return rounded(rows.select("metric", "model_a_value", "model_b_value"))


@query("paired_bootstrap")
def _(spark, sf):
    names = ["exact_match", "f1_token"]
    return evaluate.bootstrap_p(evaluate.sample_scores(_two_models(spark, sf), names, "text_a", "text_b"), names)


@query("recommend")
def _(spark, sf):
    return evaluate.recommend(_compared(spark, sf), "user-echo", "bare-reference")


@query(
    "side_by_side",
    f"""with models as ({_MODELS_SQL}) select pair_id, reference as prompt, text_a, text_b from models order by md5('42|' || pair_id), pair_id limit 20""",
)
def _(spark, sf):
    both = _two_models(spark, sf)
    prompts = both.select("pair_id", F.col("reference").alias("prompt"))
    return evaluate.side_by_side(prompts, both.select("pair_id", "text_a"), both.select("pair_id", "text_b"), "pair_id", 20)


@query(
    "toxicity_confusion",
    f"""with x as (select {_TOX} >= 0.2 as was, l.toxic = 1 as should from documents d join labels l on l.doc_id = d.doc_id)
    select count(*) filter (was = should) as passed, count(*) filter (was <> should) as failed, count(*) as total,
      count(*) filter (was and not should) as false_positives, count(*) filter (not was and should) as false_negatives from x""",
)
def _(spark, sf):
    docs = load(spark, sf, "documents").join(load(spark, sf, "labels"), "doc_id")
    judged = docs.select((m.toxicity_score(F.col("text")) >= 0.2).alias("was_blocked"), (F.col("toxic") == 1).alias("should_be_blocked"))
    return serving.filter_confusion(judged, "was_blocked", "should_be_blocked")
