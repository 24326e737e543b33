"""Drift, serving metrics, training logs, runs and requests.

The events table stands in for logs: the event type is an endpoint or run group, an error event
is a failed request, the value is a latency, a loss or a cost.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.fixed import INSTANCE_PRICES, REFUSAL_PATTERN
from millrace.operators import drift, metrics, requests, runs, serving, sketches
from millrace.workload import TURN_PAIRS_SQL, load, query, rounded, toks, turn_pairs

_REFUSAL = "(?i)" + REFUSAL_PATTERN.replace("'", "''")


def _events(spark, sf):
    return load(spark, sf, "events").withColumn("seconds", serving.epoch("ts"))


# ---- drift -------------------------------------------------------------------------------------


def _halves(spark, sf):
    events = load(spark, sf, "events")
    return events.filter(F.col("event_type") == "click"), events.filter(F.col("event_type") == "view")


@query(
    "ks_two_sample",
    """with c as (select value, count(*) filter (event_type = 'click') as a, count(*) filter (event_type = 'view') as b from events
      where event_type in ('click', 'view') group by value),
    s as (select sum(a) over (order by value) / sum(a) over () as x, sum(b) over (order by value) / sum(b) over () as y, sum(a) over () as n, sum(b) over () as m from c)
    select round(max(abs(x - y)), 9)::double as statistic, max(n)::bigint as n, max(m)::bigint as m from s""",
)
def _(spark, sf):
    a, b = _halves(spark, sf)
    return rounded(drift.ks_two_sample(a, b, "value").select("statistic", "n", "m"), 9)


@query("ks_p_value")
def _(spark, sf):
    a, b = _halves(spark, sf)
    return rounded(drift.ks_two_sample(a, b, "value"), 9)


# The closed form of the exact p-value; the alternating sum over k as a list.
def _p_sql(h: str, n: str) -> str:
    term = f"case when k % 2 = 1 then 2.0 else -2.0 end * exp(2 * lgamma({n} + 1) - lgamma({n} - k * {h} + 1) - lgamma({n} + k * {h} + 1))"
    return f"case when {h} <= 0 then 1.0 else greatest(0.0, least(1.0, list_sum(list_transform(range(1, ({n} // greatest({h}, 1)) + 1), lambda k: {term})))) end"


@query(
    "ks_vs_constant",
    f"""with c as (select user_id, greatest(count(*) filter (value < 40), count(*) filter (value > 40)) as h, count(*) as n from events group by user_id)
    select user_id, round(h / n, 9)::double as statistic, round({_p_sql('h', 'n')}, 9)::double as p_value, n, 'exact' as method from c""",
)
def _(spark, sf):
    return rounded(drift.ks_vs_constant(load(spark, sf, "events"), "value", 40.0, ["user_id"]), 9)


_FEATURES_SQL = f"""with t as (select lang, text, {toks('text')} as t from documents),
    f as (select lang, len(t)::double as avg_response_length, case when len(t) > 0 then len(list_distinct(t)) / len(t) else 0 end as vocab_richness,
      case when len(t) > 1 then 1 - len(list_distinct(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]))) / (len(t) - 1) else 0 end as repetition_rate,
      regexp_matches(text, '{_REFUSAL}')::int::double as refusal_rate from t)"""


@query(
    "output_features",
    f"""{_FEATURES_SQL} select lang, round(avg(avg_response_length), 6)::double as avg_response_length, round(avg(vocab_richness), 6)::double as vocab_richness,
      round(avg(repetition_rate), 6)::double as repetition_rate, round(avg(refusal_rate), 6)::double as refusal_rate from f group by lang""",
)
def _(spark, sf):
    rows = drift.output_features(load(spark, sf, "documents"), "text", ["lang"])
    names = (*drift.OUTPUT_METRICS, "refusal_rate")
    return rounded(rows.groupBy("lang").agg(*[F.avg(c).alias(c) for c in names]))


_BASE = {"avg_response_length": 200.0, "vocab_richness": 0.8, "repetition_rate": 0.05, "refusal_rate": 0.01}


@query(
    "output_drift",
    f"""{_FEATURES_SQL}, s as (select lang, count(*) as n, {', '.join(f"avg({m}) as {m}, greatest(count(*) filter ({m} < {_BASE[m]}), count(*) filter ({m} > {_BASE[m]})) as h_{m}" for m in drift.OUTPUT_METRICS)},
      avg(refusal_rate) as refusal_rate from f group by lang)
    select lang, n, {', '.join(f"round({m}, 6)::double as {m}" for m in (*drift.OUTPUT_METRICS, 'refusal_rate'))},
      ({' or '.join(f"(n >= 2 and {_p_sql(f'h_{m}', 'n')} < 0.05)" for m in drift.OUTPUT_METRICS)} or abs(refusal_rate - 0.01) > 0.1) as drifted from s""",
)
def _(spark, sf):
    return rounded(drift.output_drift(load(spark, sf, "documents"), "text", _BASE, ["lang"]).drop("details"))


_NOTES_SQL = " union all ".join(
    [
        f"select lang, printf('{m}: drift detected (p=%.4f, stat=%.4f)', {_p_sql(f'h_{m}', 'n')}, h_{m} / n) as detail from s where n >= 2 and {_p_sql(f'h_{m}', 'n')} < 0.05"
        for m in drift.OUTPUT_METRICS
    ]
    + [f"select lang, printf('refusal_rate: %.2f -> %.2f', {_BASE['refusal_rate']}::double, refusal_rate) from s where abs(refusal_rate - {_BASE['refusal_rate']}) > 0.1"]
)


@query(
    "output_drift_details",
    f"""{_FEATURES_SQL}, s as (select lang, count(*) as n, {', '.join(f"greatest(count(*) filter ({m} < {_BASE[m]}), count(*) filter ({m} > {_BASE[m]})) as h_{m}" for m in drift.OUTPUT_METRICS)},
      avg(refusal_rate) as refusal_rate from f group by lang) {_NOTES_SQL}""",
)
def _(spark, sf):
    found = drift.output_drift(load(spark, sf, "documents"), "text", _BASE, ["lang"])
    return found.select("lang", F.explode("details").alias("detail"))


@query(
    "input_drift",
    f"""with s as (select source, count(*) as n, avg(len({toks('text')})) as a, max(len({toks('text')}))::double as hi, min(len({toks('text')}))::double as lo,
      greatest(count(*) filter (len({toks('text')}) < 100), count(*) filter (len({toks('text')}) > 100)) as h from documents group by source)
    select source, n as sample_count, round(a, 6)::double as avg_length, hi as max_length, lo as min_length,
      (n >= 2 and {_p_sql('h', 'n')} < 0.05) or hi > 3000 as drifted from s""",
)
def _(spark, sf):
    found = drift.input_drift(load(spark, sf, "documents"), "text", {"avg_length": 100.0, "max_length": 2000.0}, ["source"])
    return rounded(found.drop("details"))


@query(
    "embedding_drift",
    """with x as (select label, generate_subscripts(embedding, 1) as i, unnest(embedding)::double as x from embeddings),
    m as (select i, avg(x) filter (label = 0) as a, avg(x) filter (label = 1) as b from x group by i)
    select round(1 - sum(a * b) / (sqrt(sum(a * a)) * sqrt(sum(b * b))), 6)::double as drift_score from m""",
)
def _(spark, sf):
    rows = load(spark, sf, "embeddings")
    return rounded(drift.embedding_drift(rows.filter("label = 0"), rows.filter("label = 1"), "embedding"))


@query(
    "embedding_drift_by",
    """with x as (select label, generate_subscripts(embedding, 1) as i, unnest(embedding)::double as x from embeddings),
    a as (select i, avg(x) as a from x group by i), b as (select label, i, avg(x) as b from x group by label, i)
    select label, round(1 - sum(a * b) / (sqrt(sum(a * a)) * sqrt(sum(b * b))), 6)::double as drift_score from b join a on a.i = b.i group by label""",
)
def _(spark, sf):
    rows = load(spark, sf, "embeddings")
    return rounded(drift.embedding_drift_by(rows, "embedding", "label", rows))


@query(
    "performance_drift",
    """with b as (select event_type as metric, avg(value) as baseline from events where ts < timestamp '2024-01-16' group by event_type),
    c as (select event_type as metric, avg(value) as "current" from events where ts >= timestamp '2024-01-16' group by event_type)
    select b.metric, round(baseline, 6)::double as baseline, round("current", 6)::double as "current", round(("current" - baseline) / abs(baseline), 6)::double as relative_change,
      ("current" - baseline) / abs(baseline) < -0.01 as degraded from b join c on b.metric = c.metric""",
)
def _(spark, sf):
    events = load(spark, sf, "events")
    middle = F.lit("2024-01-16").cast("timestamp_ntz")
    of = lambda rows: rows.groupBy(F.col("event_type").alias("metric")).agg(F.avg("value").alias("value"))
    return rounded(drift.performance_drift(of(events.filter(F.col("ts") < middle)), of(events.filter(F.col("ts") >= middle)), 0.01))


# ---- serving -----------------------------------------------------------------------------------

_POINTS_SQL = """select 'ep' || (user_id % 5) as endpoint, ts, 'invocations' as metric, 1.0 as value from events
    union all select 'ep' || (user_id % 5), ts, 'errors', 1.0 from events where event_type = 'error'
    union all select 'ep' || (user_id % 5), ts, 'latency', value * 1000 from events where event_type <> 'error'"""


def _points(spark, sf):
    events = _events(spark, sf).withColumn("endpoint", F.concat(F.lit("ep"), (F.col("user_id") % 5).cast("string")))
    failed = F.col("event_type") == "error"
    each = F.array_compact(
        F.array(
            F.struct(F.lit("invocations").alias("metric"), F.lit(1.0).alias("value")),
            F.when(failed, F.struct(F.lit("errors").alias("metric"), F.lit(1.0).alias("value"))),
            F.when(~failed, F.struct(F.lit("latency").alias("metric"), (F.col("value") * 1000).alias("value"))),
        )
    )
    return events.select("endpoint", "ts", "seconds", F.explode(each).alias("p")).select("endpoint", "ts", "seconds", "p.*")


_ROLLUP_SQL = f"""select endpoint, time_bucket(interval 1 hour, ts) as p, sum(value) filter (metric = 'invocations') as invocations, sum(value) filter (metric = 'errors') as errors,
    avg(value) filter (metric = 'latency') as avg_latency, max(value) filter (metric = 'latency') as max_latency from ({_POINTS_SQL}) group by all"""


@query(
    "hourly_rollup",
    f"""select endpoint, strftime(p, '%Y-%m-%d %H:%M:%S') as period_start, invocations::double as invocations, errors::double as errors,
      round(avg_latency, 6)::double as avg_latency, round(max_latency, 6)::double as max_latency from ({_ROLLUP_SQL})""",
)
def _(spark, sf):
    return rounded(serving.hourly_rollup(_points(spark, sf), "endpoint").withColumn("period_start", F.col("period_start").cast("string")))


@query(
    "hourly_rollup_last_day",
    f"""select endpoint, strftime(p, '%Y-%m-%d %H:%M:%S') as period_start, invocations::double as invocations from ({_ROLLUP_SQL})
    where p >= timestamp '2024-01-19' and p < timestamp '2024-01-20'""",
)
def _(spark, sf):
    rows = serving.hourly_rollup(_points(spark, sf), "endpoint", end="2024-01-20 00:00:00", hours=24)
    return rows.select("endpoint", F.col("period_start").cast("string").alias("period_start"), "invocations")


@query(
    "service_report",
    f"""select endpoint, round(count(*) filter (invocations > 0) / count(invocations) * 100, 2)::double as uptime_pct,
      round(sum(errors) / sum(invocations) * 100, 4)::double as error_rate, round(avg(avg_latency) / 1000, 2)::double as avg_p50_ms,
      round(max(max_latency) / 1000, 2)::double as max_p99_ms, sum(invocations)::bigint as invocation_count, round(sum(invocations) * 0.0002, 2)::double as cost_estimate
    from ({_ROLLUP_SQL}) group by endpoint""",
)
def _(spark, sf):
    return serving.service_report(serving.hourly_rollup(_points(spark, sf), "endpoint"), "endpoint")


_P99_SQL = "list_sort(list(value))[least(floor(count(*) * 99.0 / 100.0), count(*) - 1)::int + 1]"


def _alarm_sql(
    value: str, where: str, breach: str, consecutive: int, missing: str, key: str = "event_type", rows: str = "events", more: str = ""
) -> str:
    return f"""with v as (select {key}, epoch_us(ts) // 300000000 as period, {value} as value from {rows} {where} group by all),
    l as (select max(period) as last from v), g as (select {key}, unnest(range(min(period), (select last from l) + 1)) as period from v group by {key}),
    f as (select g.{key}, g.period, v.value, coalesce({breach}, {missing}) as breaching from g left join v on v.{key} = g.{key} and v.period = g.period)
    select {more}{key}, period, round(value, 6)::double as value, breaching,
      count(*) over w >= {consecutive} and count(*) filter (not breaching) over w = 0 as in_alarm from f
    window w as (partition by {key} order by period rows between {consecutive - 1} preceding and current row)"""


@query("threshold_alarm", _alarm_sql("count(*)::double", "", "value <= 0", 3, "true"))
def _(spark, sf):
    events = _events(spark, sf).withColumn("one", F.lit(1.0))
    return rounded(serving.threshold_alarm(events, "event_type", "seconds", "one", "sum", "<=", 0.0, 3, "breaching"))


@query("average_alarm", _alarm_sql("avg(value)", "", "value > 60", 2, "false"))
def _(spark, sf):
    return rounded(serving.threshold_alarm(_events(spark, sf), "event_type", "seconds", "value", "avg", ">", 60.0, 2, "notBreaching"))


@query(
    "p99_alarm",
    _alarm_sql(_P99_SQL, "", "value > 100", 2, "false"),
)
def _(spark, sf):
    return rounded(serving.threshold_alarm(_events(spark, sf), "event_type", "seconds", "value", "p99", ">", 100.0, 2, "notBreaching"))


_ENDPOINT_SQL = " union all ".join(
    f"""select * from ({_alarm_sql(value, f"where metric = '{metric}'", breach, consecutive, missing, "endpoint", "points", f"'{alarm}' as alarm, ")})"""
    for alarm, metric, value, breach, consecutive, missing in (
        ("zero-invocations", "invocations", "sum(value)", "value <= 0", 3, "true"),
        ("p99-latency", "latency_us", _P99_SQL, "value > 5000000", 2, "false"),
        ("5xx-rate", "errors", "avg(value)", "value > 1", 2, "false"),
        ("unhealthy-instances", "invocations_per_instance", "sum(value)", "value <= 0", 3, "true"),
    )
)


@query(
    "endpoint_alarms",
    f"""with points as (select endpoint, ts, case metric when 'latency' then 'latency_us' else metric end as metric, value from ({_POINTS_SQL})) {_ENDPOINT_SQL}""",
)
def _(spark, sf):
    points = _points(spark, sf).withColumn("metric", F.when(F.col("metric") == "latency", "latency_us").otherwise(F.col("metric")))
    return rounded(serving.endpoint_alarms(points, "endpoint", "seconds"))


@query(
    "error_rate_alarm",
    """with v as (select 'ep' || (user_id % 5) as endpoint, epoch_us(ts) // 300000000 as period, count(*) filter (event_type = 'error') / count(*) * 100 as value from events group by all),
    l as (select max(period) as last from v), g as (select endpoint, unnest(range(min(period), (select last from l) + 1)) as period from v group by endpoint),
    f as (select g.endpoint, g.period, v.value, coalesce(value >= 1, false) as breaching from g left join v on v.endpoint = g.endpoint and v.period = g.period),
    a as (select endpoint, period, value, count(*) over w >= 3 and count(*) filter (not breaching) over w = 0 as in_alarm from f
      window w as (partition by endpoint order by period rows between 2 preceding and current row))
    select endpoint, count(*) as periods, count(*) filter (in_alarm) as in_alarm, round(max(value), 6)::double as worst from a group by endpoint""",
)
def _(spark, sf):
    events = _events(spark, sf).withColumns(
        {"endpoint": F.concat(F.lit("ep"), (F.col("user_id") % 5).cast("string")), "one": F.lit(1), "err": (F.col("event_type") == "error").cast("int")}
    )
    states = serving.error_rate_alarm(events, "endpoint", "seconds", "one", "err")
    return rounded(
        states.groupBy("endpoint").agg(F.count("*").alias("periods"), F.count_if("in_alarm").alias("in_alarm"), F.max("value").alias("worst"))
    )


def _nth(p: int) -> str:
    return f"round(coalesce(v[least(floor(len(v) * {p} / 100.0), len(v) - 1)::int + 1], 0), 2)::double as p{p}_ms"


@query(
    "latency_report",
    f"""with r as (select 'ep' || (user_id % 5) as endpoint, *, row_number() over (partition by user_id % 5 order by ts, event_id) as k from events),
    g as (select endpoint, list_sort(list(value) filter (event_type <> 'error')) as v, avg(value) filter (event_type <> 'error') as m, sum(value) filter (event_type <> 'error') as s,
      count(*) as n, count(*) filter (event_type = 'error') as e from r where k > 10 group by endpoint)
    select endpoint, {_nth(50)}, {_nth(90)}, {_nth(95)}, {_nth(99)}, round(m, 2)::double as mean_ms, round((n - e) / greatest(s / 1000, 0.001), 2)::double as throughput_rps,
      round(e / n, 4)::double as error_rate, n as total_requests, e as errors from g""",
)
def _(spark, sf):
    rows = load(spark, sf, "events").withColumns(
        {"endpoint": F.concat(F.lit("ep"), (F.col("user_id") % 5).cast("string")), "ok": F.col("event_type") != "error"}
    )
    return serving.latency_report(rows, "endpoint", "event_id", "ts", "value", "ok", warmup=10)


@query(
    "rate_test",
    """with g as (select user_id % 5 as test, list_sort(list(value) filter (event_type <> 'error')) as v, count(*) as n, count(*) filter (event_type = 'error') as e,
      count(*) filter (event_type = 'error' and value > 50) as t from events group by 1)
    select test, round((n - e) / 60.0, 2)::double as achieved_rpm, round(t / 3600.0, 4)::double as throttle_rate, round(e / 3600.0, 4)::double as error_rate,
      round(v[least(floor(len(v) * 50 / 100.0), len(v) - 1)::int + 1], 2)::double as latency_p50, round(v[least(floor(len(v) * 99 / 100.0), len(v) - 1)::int + 1], 2)::double as latency_p99 from g""",
)
def _(spark, sf):
    error = F.when(F.col("event_type") == "error", F.when(F.col("value") > 50, "ThrottlingException: slow down").otherwise("Timeout"))
    rows = load(spark, sf, "events").select((F.col("user_id") % 5).alias("test"), "value", error.alias("error"))
    return serving.rate_test(rows, "test", "value", "error", 60, 60)


@query(
    "smoke_check",
    f"""with c as (select role, trim(text, e' \\t\\n\\r') <> '' and length(text) * 30 < 30000 as ok from conversations)
    select role, bool_and(ok) as passed, count(*) filter (ok) as passes, count(*) as total from c group by role""",
)
def _(spark, sf):
    rows = load(spark, sf, "conversations").select("role", "text", (F.length("text") * 30).alias("latency_ms"), F.lit(200).alias("status"))
    return serving.smoke_verdict(serving.smoke_check(rows, "text", "latency_ms", "status"), ["role"])


@query(
    "correctness_check",
    """with c as (select doc_id, lower(text) as t from documents)
    select doc_id, case when not contains(t, 'the') then 'Missing expected: ''THE''' else '' end || case when not contains(t, 'the') and contains(t, 'idiot') then '; ' else '' end ||
      case when contains(t, 'idiot') then 'Contains forbidden: ''idiot''' else '' end as issues, contains(t, 'the') and not contains(t, 'idiot') as passed from c""",
)
def _(spark, sf):
    rows = load(spark, sf, "documents").withColumns({"must": F.array(F.lit("THE")), "must_not": F.array(F.lit("idiot"))})
    return serving.correctness_check(rows, "text", "must", "must_not").select("doc_id", F.array_join("issues", "; ").alias("issues"), "passed")


@query(
    "filter_confusion",
    """with x as (select event_type, value > 60 as was, user_id % 2 = 0 as should, value > 300 as failed from events)
    select event_type, count(*) filter (not failed and was = should) as passed, count(*) filter (failed or was <> should) as failed, count(*) as total,
      count(*) filter (not failed and was and not should) as false_positives, count(*) filter (not failed and not was and should) as false_negatives from x group by event_type""",
)
def _(spark, sf):
    rows = load(spark, sf, "events").select(
        "event_type",
        (F.col("value") > 60).alias("was"),
        (F.col("user_id") % 2 == 0).alias("should"),
        F.when(F.col("value") > 300, "timeout").alias("error"),
    )
    return serving.filter_confusion(rows, "was", "should", "error", ["event_type"])


@query(
    "backend_latency_compare",
    """with m as (select round(avg(value) filter (event_type = 'click'), 2) as a, round(avg(value) filter (event_type = 'view'), 2) as b from events)
    select a::double as first_latency_ms, b::double as second_latency_ms, case when b < a then 'view' else 'click' end as recommendation from m""",
)
def _(spark, sf):
    return serving.backend_latency_compare(load(spark, sf, "events"), "event_type", "value", "click", "view")


@query(
    "canary_verdict",
    """select d.event_id, case when exists (select 1 from events a where a.event_type = 'error' and a.user_id = d.user_id
        and epoch_us(a.ts) // 1000000 between epoch_us(d.ts) // 1000000 and epoch_us(d.ts) // 1000000 + 7200) then 'rolled_back' else 'completed' end as status
    from events d where d.event_type = 'purchase'""",
)
def _(spark, sf):
    events = _events(spark, sf).select("event_id", "user_id", "event_type", "seconds")
    deployments = events.filter("event_type = 'purchase'").select("event_id", "user_id", "seconds")
    alarms = events.filter("event_type = 'error'").select("user_id", F.col("seconds").alias("fired"))
    return serving.canary_verdict(deployments, alarms, "user_id", "seconds", "fired", 7200).select("event_id", "status")


def _alert_rows(spark, sf):
    kinds = {"signup": "training", "error": "drift", "click": "deployment", "view": "deployment", "purchase": "cost"}
    kind, event = F.lit(None), F.lit(None)
    for name, value in kinds.items():
        kind = F.when(F.col("event_type") == name, value).otherwise(kind)
    event = (
        F.when(F.col("event_type") == "signup", F.when(F.col("value") > 50, "Failed").otherwise("done"))
        .when(F.col("event_type") == "click", "rollback")
        .when(F.col("event_type") == "view", F.when(F.col("value") > 50, "complete").otherwise("paused"))
    )
    return load(spark, sf, "events").select(
        "event_id", "user_id", "ts", kind.alias("kind"), F.concat(F.lit("m"), F.col("user_id").cast("string")).alias("name"), event.alias("event"),
        F.create_map(F.lit("props"), F.col("props")).alias("details"), F.col("value").alias("cost"), F.lit(100.0).alias("budget"),
    )


@query(
    "alert_events",
    """select event_id, case event_type when 'signup' then case when value > 50 then 'CRITICAL' else 'INFO' end when 'error' then 'WARNING' when 'click' then 'CRITICAL'
      when 'view' then case when value > 50 then 'INFO' else 'WARNING' end else case when value >= 100 then 'CRITICAL' else 'WARNING' end end as severity,
      case event_type when 'signup' then 'Training Alert: ' || case when value > 50 then 'Failed' else 'done' end || ' - m' || user_id when 'error' then 'Drift Alert: m' || user_id
      when 'click' then 'Deployment rollback: m' || user_id when 'view' then 'Deployment ' || case when value > 50 then 'complete' else 'paused' end || ': m' || user_id
      else 'Cost Alert: ' || round(value / 100::double * 100)::bigint || '% of budget ($' || printf('%.2f', value) || '/$100.00)' end as subject from events""",
)
def _(spark, sf):
    return serving.alert_events(_alert_rows(spark, sf)).select("event_id", "severity", "subject")


@query(
    "alert_messages",
    """with a as (select event_id, event_type, 'm' || user_id as name, round(value / 100::double * 100, 2) as pct, value, json_object('props', props) as details from events),
    m as (select event_id, case event_type when 'signup' then case when value > 50 then 'CRITICAL' else 'INFO' end when 'error' then 'WARNING' when 'click' then 'CRITICAL'
        when 'view' then case when value > 50 then 'INFO' else 'WARNING' end else case when value >= 100 then 'CRITICAL' else 'WARNING' end end as severity,
      case event_type when 'signup' then json_object('model_id', name, 'event', case when value > 50 then 'Failed' else 'done' end, 'details', details)
        when 'error' then json_object('endpoint', name, 'drift', details)
        when 'click' then json_object('event_type', 'rollback', 'endpoint_name', name, 'details', details)
        when 'view' then json_object('event_type', case when value > 50 then 'complete' else 'paused' end, 'endpoint_name', name, 'details', details)
        else json_object('current_cost_usd', value, 'budget_limit_usd', 100.0::double, 'utilization_pct', pct, 'details', details) end as body from a)
    select event_id, '[' || severity || '] ' || body::varchar as message from m""",
)
def _(spark, sf):
    return serving.alert_events(_alert_rows(spark, sf)).select("event_id", "message")


_GREEDY_SQL = """with recursive a as (select event_type, epoch_us(ts) as at_us, min(event_id) as event_id from events group by all),
    walk as (select event_type, min(at_us) as at_us from a group by event_type
      union all select w.event_type, (select min(b.at_us) from a b where b.event_type = w.event_type and b.at_us >= w.at_us + 86400000000) as at_us
      from walk w where w.at_us is not null)
    select a.event_type, a.event_id from walk w join a on a.event_type = w.event_type and a.at_us = w.at_us"""


@query(
    "latency_sketches",
    """with r as (select event_type, epoch_us(ts) // 604800000000 as week, value, row_number() over w as r, count(*) over (partition by event_type, epoch_us(ts) // 604800000000) as n from events
      window w as (partition by event_type, epoch_us(ts) // 604800000000 order by value))
    select event_type, week, count(*) as n, min(case when r >= ceil(0.5 * n) then value end) as p50, min(case when r >= ceil(0.99 * n) then value end) as p99 from r group by all""",
)
def _(spark, sf):
    events = _events(spark, sf).withColumn("day", F.floor(F.col("seconds") / 86_400))
    daily = sketches.quantile_sketches(events, ["event_type", "day"], "value").withColumn("week", F.floor(F.col("day") / 7))
    return sketches.quantiles(daily, ["event_type", "week"], {"p50": 0.5, "p99": 0.99})


@query("alert_dedup", _GREEDY_SQL)
def _(spark, sf):
    alerts = load(spark, sf, "events").select("event_type", "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("at_us"))
    return serving.alert_dedup(alerts, "event_type", "event_id", "at_us", 86_400).select("event_type", "event_id")


@query(
    "budget_utilisation",
    """with s as (select event_type, strftime(ts, '%Y-%m-%d') as day, sum(value) as period_cost from events group by all),
    c as (select event_type, day, period_cost, sum(period_cost) over (partition by event_type order by day) as current_cost from s),
    p as (select *, round(current_cost / 100000.0 * 100, 2) as pct from c)
    select event_type, day, round(period_cost, 4)::double as period_cost, round(current_cost, 4)::double as current_cost, pct::double as utilization_pct,
      case when pct >= 100 then 'CRITICAL' when pct >= 80 then 'WARNING' else 'OK' end as level from p""",
)
def _(spark, sf):
    costs = load(spark, sf, "events").select("event_type", F.date_format("ts", "yyyy-MM-dd").alias("day"), "value")
    return rounded(serving.budget_utilisation(costs, "event_type", "day", "value", 100_000.0), 4)


# ---- training logs and runs --------------------------------------------------------------------


def _losses(spark, sf):
    return load(spark, sf, "events").select(F.col("user_id").alias("run"), F.col("event_id").alias("step"), F.col("value").alias("loss"))


@query(
    "run_cost",
    f"""with r as (select user_id, event_id, epoch_us(ts) / 1e6 - epoch_us(min(ts) over (partition by user_id)) / 1e6 as s from events),
    c as (select user_id, event_id, s, s / 3600 * {INSTANCE_PRICES['ml.g5.2xlarge']} * 2 as cost from r)
    select user_id, round(max(s) / 3600, 4)::double as elapsed_hours, round(max(cost), 4)::double as estimated_cost_usd, arg_min(event_id, s) filter (cost >= 500) as budget_stop_step
    from c group by user_id""",
)
def _(spark, sf):
    events = load(spark, sf, "events").select("user_id", "event_id", (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("at"))
    starts = events.groupBy("user_id").agg(F.min("at").alias("start"))
    logs = events.join(starts, "user_id").select(
        "user_id", "event_id", (F.col("at") - F.col("start")).alias("seconds"), F.lit("ml.g5.2xlarge").alias("instance"), F.lit(2).alias("count")
    )
    return runs.run_cost(logs, "user_id", "event_id", "seconds", "instance", "count", 500.0)


@query(
    "loss_spikes",
    """with m as (select user_id as run, event_id as step, value as loss, avg(value) over (partition by user_id order by event_id rows between 50 preceding and 1 preceding) as rolling_mean from events)
    select run, step, round(rolling_mean, 8)::double as rolling_mean, coalesce(rolling_mean > 0 and loss > 3 * rolling_mean, false) as is_spike from m""",
)
def _(spark, sf):
    return rounded(runs.loss_spikes(_losses(spark, sf), "run", "step", "loss").drop("loss"), 8)


@query(
    "nonfinite_stops",
    "select user_id as run, min(event_id) as stop_step from events where value > 400 group by user_id",
)
def _(spark, sf):
    logs = _losses(spark, sf).withColumn("loss", F.when(F.col("loss") > 450, float("inf")).when(F.col("loss") > 400, float("nan")).otherwise(F.col("loss")))
    return runs.nonfinite_stops(logs, "run", "step", "loss")


@query(
    "until_stop",
    """with s as (select user_id, min(event_id) as stop from events where value > 200 group by user_id)
    select e.user_id as run, count(*) as kept, max(event_id) as last_step from events e left join s on s.user_id = e.user_id where stop is null or event_id < stop group by e.user_id""",
)
def _(spark, sf):
    logs = _losses(spark, sf).withColumn("loss", F.when(F.col("loss") > 200, float("nan")).otherwise(F.col("loss")))
    return runs.until_stop(logs, "run", "step", "loss").groupBy("run").agg(F.count("*").alias("kept"), F.max("step").alias("last_step"))


@query(
    "loss_plateau",
    """with m as (select user_id as run, event_id as step, value as loss, min(value) over (partition by user_id order by event_id rows between unbounded preceding and 1 preceding) as prior from events),
    b as (select *, prior is null or loss < prior as is_best from m),
    c as (select *, max(case when is_best then step end) over (partition by run order by step) as best_step, min(loss) over (partition by run order by step) as best_loss from b)
    select run, step, best_loss, best_step, not is_best and step - best_step >= 500 as is_plateau from c""",
)
def _(spark, sf):
    return runs.loss_plateau(_losses(spark, sf), "run", "step", "loss").select("run", "step", "best_loss", "best_step", "is_plateau")


_EARLY_STOP_SQL = """with recursive r as (select user_id as run, event_id as step, value as loss, row_number() over (partition by user_id order by event_id) as k from events),
    walk as (select run, step, k, loss as best_loss, 0::bigint as counter from r where k = 1
      union all select r.run, r.step, r.k, case when r.loss < w.best_loss - 0.5 then r.loss else w.best_loss end, case when r.loss < w.best_loss - 0.5 then 0 else w.counter + 1 end
      from walk w join r on r.run = w.run and r.k = w.k + 1)
    select run, step, best_loss, counter, counter >= 5 as should_stop from walk"""


@query("early_stop", _EARLY_STOP_SQL)
def _(spark, sf):
    return runs.early_stop(_losses(spark, sf), "run", "step", "loss", 5, 0.5).drop("loss")


@query("stop_steps", f"select run, min(step) as stop_step from ({_EARLY_STOP_SQL}) where should_stop group by run")
def _(spark, sf):
    return runs.stop_steps(runs.early_stop(_losses(spark, sf), "run", "step", "loss", 5, 0.5), "run", "step")


@query("grad_norm_series", "select user_id as run, event_id as step, round(value / 7, 6)::double as grad_norm from events where event_type <> 'error'")
def _(spark, sf):
    logs = load(spark, sf, "events").select(
        F.col("user_id").alias("run"), F.col("event_id").alias("step"), F.when(F.col("event_type") != "error", F.col("value") / 7).alias("grad_norm")
    )
    return runs.grad_norm_series(logs, "run", "step", "grad_norm")


def _checkpoints(spark, sf):
    return load(spark, sf, "events").select(
        F.col("user_id").alias("run"), F.concat(F.lit("out/checkpoint-"), F.col("event_id").cast("string")).alias("path"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("best_metric"),
    )


@query(
    "checkpoint_retention",
    """select run, path, step from (select user_id as run, 'out/checkpoint-' || event_id as path, event_id as step, row_number() over (partition by user_id order by event_id desc) as k from events) where k > 3""",
)
def _(spark, sf):
    return runs.checkpoint_retention(_checkpoints(spark, sf), "run", "path").select("run", "path", "step")


@query(
    "best_checkpoint",
    """select user_id as run, 'out/checkpoint-' || arg_min(event_id, (value, event_id)) as path, min(value) as best_metric from events where event_type <> 'error' group by user_id""",
)
def _(spark, sf):
    return runs.best_checkpoint(_checkpoints(spark, sf), "run", "path", "best_metric").drop("step")


@query("latest_checkpoint", "select user_id as run, 'out/checkpoint-' || max(event_id) as path, max(event_id) as step from events group by user_id")
def _(spark, sf):
    return runs.latest_checkpoint(_checkpoints(spark, sf), "run", "path")


def _runs(spark, sf):
    return load(spark, sf, "events").groupBy(F.col("user_id").alias("run")).agg(
        F.create_map(F.lit("eval_loss"), F.avg("value"), F.lit("best"), F.min("value")).alias("metrics"),
        F.count("*").alias("total_steps"), F.avg("value").alias("final_eval_loss"), F.sum("value").alias("training_time_seconds"),
        F.max("value").alias("estimated_cost_usd"),
    )


@query("top_runs", "select user_id as run, round(avg(value), 6)::double as eval_loss from events group by user_id order by avg(value), user_id limit 5")
def _(spark, sf):
    top = runs.top_runs(_runs(spark, sf), "run", "metrics", "eval_loss")
    return rounded(top.select("run", F.col("metrics")["eval_loss"].alias("eval_loss")))


@query(
    "job_summary",
    """with r as (select user_id as run, sum(value) / 60 as a, avg(value) as b, max(value) as c, count(*)::double as d from events group by user_id)
    select run, 'TotalTrainingTimeMinutes' as metric, round(a, 4)::double as value, 'None' as unit from r union all select run, 'FinalEvalLoss', round(b, 4)::double, 'None' from r
    union all select run, 'EstimatedCostUSD', round(c, 4)::double, 'None' from r union all select run, 'TotalSteps', d, 'None' from r""",
)
def _(spark, sf):
    return rounded(runs.job_summary(_runs(spark, sf), "run"), 4)


@query(
    "training_metric_rows",
    "select event_id as step, 'TrainingLoss' as metric, value, 'None' as unit from events union all select event_id, 'Epoch', (event_id // 1000)::double, 'None' from events",
)
def _(spark, sf):
    logs = load(spark, sf, "events").select(F.col("event_id").alias("step"), F.col("value").alias("loss"), F.floor(F.col("event_id") / 1000).alias("epoch"))
    return runs.training_metric_rows(logs, ["step"])


@query(
    "inference_metric_rows",
    """select event_id, 'InferenceLatency' as metric, value, 'Milliseconds' as unit from events union all select event_id, 'TokensGenerated', length(props)::double, 'None' from events""",
)
def _(spark, sf):
    rows = load(spark, sf, "events").select("event_id", F.col("value").alias("latency_ms"), F.length("props").alias("tokens_generated"))
    return runs.inference_metric_rows(rows, ["event_id"])


def _models(spark, sf):
    status = F.when(F.col("event_type") == "purchase", "Approved").when(F.col("event_type") == "error", "Rejected").otherwise("PendingManualApproval")
    body = F.when(F.col("value") > 50, F.to_json(F.struct("value"))).otherwise("{broken")
    return load(spark, sf, "events").select(
        F.concat(F.lit("g"), (F.col("user_id") % 7).cast("string")).alias("model_group"), F.col("event_id").alias("created"), F.col("user_id").alias("run"),
        status.alias("status"), body.alias("metrics_json"),
    )


@query(
    "latest_approved_model",
    """select 'g' || (user_id % 7) as model_group, max(event_id) as created, round(max(case when value > 50 then value end) filter (event_id = m), 6)::double as metric
    from (select *, max(event_id) over (partition by user_id % 7) as m from events where event_type = 'purchase') group by user_id % 7""",
)
def _(spark, sf):
    newest = runs.latest_approved_model(_models(spark, sf), "model_group", "created", "status", "metrics_json")
    return rounded(newest.select("model_group", "created", F.try_element_at("metrics", F.lit("value")).alias("metric")))


@query("model_versions", "select event_id as created, case event_type when 'purchase' then 'Approved' when 'error' then 'Rejected' else 'PendingManualApproval' end as status from events where user_id % 7 = 3")
def _(spark, sf):
    return runs.model_versions(_models(spark, sf), "model_group", "g3").select("created", "status")


@query(
    "model_lineage",
    """with r as (select user_id, count(*) as total_steps, round(avg(value), 6)::double as eval_loss from events group by user_id)
    select event_id as created, r.total_steps, r.eval_loss from events e join r on r.user_id = e.user_id where event_type = 'purchase'""",
)
def _(spark, sf):
    table = _runs(spark, sf)
    results = table.select("run", F.explode("metrics").alias("metric", "value"))
    found = runs.model_lineage(_models(spark, sf).filter("status = 'Approved'"), table.select("run", "total_steps"), results, "run")
    return rounded(found.select("created", "total_steps", F.col("eval_results")["eval_loss"].alias("eval_loss")))


@query(
    "flatten_params",
    """select event_id, 'training.steps' as param, user_id::varchar as value from events union all
    select event_id, 'training.kind', case when event_type = 'error' then 'None' else event_type end from events union all select event_id, 'name', props from events where event_type <> 'view'""",
)
def _(spark, sf):
    kind = F.when(F.col("event_type") != "error", F.col("event_type"))
    rows = load(spark, sf, "events").select(
        "event_id", F.struct(F.col("user_id").alias("steps"), kind.alias("kind")).alias("training"), F.when(F.col("event_type") != "view", F.col("props")).alias("name")
    )
    return runs.flatten_params(rows, ["event_id"])


# ---- requests ----------------------------------------------------------------------------------

_BODIES = {
    "click": '{"prompt": "p", "temperature": 10, "max_new_tokens": -5}',
    "view": '"bare text"',
    "error": "{broken",
    "purchase": "[1, 2]",
}


def _bodies(spark, sf):
    made = F.to_json(F.struct(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("prompt"), (F.col("value") / 100).alias("temperature")))
    for name, body in _BODIES.items():
        made = F.when(F.col("event_type") == name, body).otherwise(made)
    return load(spark, sf, "events").select("event_id", made.alias("body"), F.lit("application/json").alias("content_type"))


@query(
    "normalise_requests",
    """select event_id, case event_type when 'click' then 'p' when 'view' then 'bare text' else 'u' || user_id end as prompt,
      case event_type when 'click' then 1 else 256 end::bigint as max_new_tokens,
      round(case event_type when 'click' then 2.0 when 'view' then 0.7 else least(value / 100, 2.0) end, 6)::double as temperature, 50::bigint as top_k, true as do_sample
    from events where event_type in ('click', 'view', 'signup')""",
)
def _(spark, sf):
    good, _ = requests.normalise_requests(_bodies(spark, sf), "body", "content_type")
    return rounded(good.select("event_id", "prompt", "max_new_tokens", "temperature", "top_k", "do_sample"))


@query(
    "rejected_requests",
    """select event_id, case event_type when 'error' then 'Invalid JSON' else 'Missing required field: ''prompt''' end as reject_reason from events where event_type in ('error', 'purchase')""",
)
def _(spark, sf):
    _, bad = requests.normalise_requests(_bodies(spark, sf), "body", "content_type")
    return bad.select("event_id", "reject_reason")


@query(
    "cut_at_stop_sequence",
    f"""select pair_id, md5(case when contains(reference, '. E') then substr(reference, 1, position('. E' in reference) - 1) when contains(reference, ', ') then substr(reference, 1, position(', ' in reference) - 1) else reference end) as text_md5,
      case when contains(reference, '. E') or contains(reference, ', ') then 'stop_sequence' when length(reference) < 300 then 'stop' else 'length' end as finish_reason from ({TURN_PAIRS_SQL})""",
)
def _(spark, sf):
    rows = turn_pairs(spark, sf).select(
        "pair_id", F.col("reference").alias("text"), F.array(F.lit(". E"), F.lit(", ")).alias("stops"), F.length("reference").alias("n"), F.lit(300).alias("top")
    )
    cut = requests.cut_at_stop_sequence(rows, "text", "stops", "n", "top")
    return cut.select("pair_id", F.md5("text").alias("text_md5"), "finish_reason")


@query(
    "with_request_id",
    "select event_id, case when event_type <> 'error' then 'r' || event_id end as kept_id, 'r'  || event_id is not null as has_id from events",
)
def _(spark, sf):
    rows = load(spark, sf, "events").select("event_id", F.when(F.col("event_type") != "error", F.concat(F.lit("r"), F.col("event_id").cast("string"))).alias("request_id"))
    done = requests.with_request_id(rows)
    return done.select("event_id", F.when(F.col("request_id").startswith("r"), F.col("request_id")).alias("kept_id"), F.col("request_id").isNotNull().alias("has_id"))
