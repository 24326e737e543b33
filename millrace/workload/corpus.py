"""Reading, validating, converting, cleaning, de-duplicating, redacting, rendering and cataloguing."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.fixed import ALPACA_PREAMBLE, PII_PATTERNS
from millrace.operators import catalog, clean, convert, dedup, pii, prepare, template, tokens, validate
from millrace.operators.names import person_spans
from millrace.plans.durable import materialise, new_path
from millrace.sources import readers, writers
from millrace.workload import TURN_PAIRS_SQL, hash_order, load, query, rounded, toks, turn_pairs

_STRIP = "e' \\t\\n\\r'"


def _instructions(spark, sf):
    return turn_pairs(spark, sf).withColumnsRenamed({"prediction": "instruction", "reference": "output"})


def _conversations(spark, sf):
    return validate.turns_from_rows(load(spark, sf, "conversations"), "conv_id", "turn", "role", "text")


_CONV_SQL = """select conv_id, list(role order by turn) as roles, list(text order by turn) as texts from conversations group by conv_id"""


# ---- sources and sinks -------------------------------------------------------------------------


@query("read_jsonl", "select doc_id, md5(text) as text_md5, lang from documents")
def _(spark, sf):
    path = new_path(spark, "docs-jsonl")
    docs = load(spark, sf, "documents").select("doc_id", "text", "lang")
    lines = docs.select(F.explode(F.array(F.to_json(F.struct("doc_id", "text", "lang")), F.lit(""), F.lit("not json"), F.lit("[1, 2]"))))
    lines.write.text(path)
    back = readers.read_jsonl(spark, path, "doc_id bigint, text string, lang string")
    return back.select("doc_id", F.md5("text").alias("text_md5"), "lang")


@query("infer_jsonl", "select lang, count(*) as n, sum(n_chars)::bigint as chars from documents group by lang")
def _(spark, sf):
    path = new_path(spark, "docs-json")
    load(spark, sf, "documents").select("doc_id", "lang", "n_chars").write.json(path)
    return readers.infer_jsonl(spark, path).groupBy("lang").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


@query("read_csv", "select doc_id::varchar as doc_id, md5(text) as text_md5, '' as blank from documents")
def _(spark, sf):
    path = f"{new_path(spark, 'docs')}.csv"
    docs = load(spark, sf, "documents").select("doc_id", "text", F.lit("").alias("blank"))
    docs.write.option("header", True).option("escape", '"').option("quoteAll", True).csv(path)
    back = readers.ingest(spark, path)
    return back.select("doc_id", F.md5("text").alias("text_md5"), "blank")


@query("read_parquet", "select label, count(*) as n, sum(len(embedding))::bigint as cells from embeddings group by label")
def _(spark, sf):
    rows = readers.load_by_uri(spark, f"{sf}/embeddings.parquet")
    return rows.groupBy("label").agg(F.count("*").alias("n"), F.sum(F.size("embedding")).alias("cells"))


@query(
    "read_split_dataset",
    f"""with r as (select doc_id, row_number() over (order by {hash_order(42, 'doc_id')}, doc_id) as k, count(*) over () as n from documents)
    select 'train' as part, count(*) as n from r where k <= n - greatest(1, floor(n * 0.05)) * 2
    union all select 'validation', greatest(1, floor(max(n) * 0.05))::bigint from r""",
)
def _(spark, sf):
    base = new_path(spark, "splits")
    parts = tokens.split_dataset(load(spark, sf, "documents").select("doc_id", "lang"), "doc_id")
    for name in ("train", "validation"):
        parts.filter(F.col("split") == name).write.parquet(f"{base}/{name}")
    train, validation = readers.read_split_dataset(spark, base)
    both = train.select(F.lit("train").alias("part")).unionByName(validation.select(F.lit("validation").alias("part")))
    return both.groupBy("part").agg(F.count("*").alias("n"))


@query(
    "read_eval_set",
    f"select md5(prediction) as prompt_md5, md5(case when pair_id % 2 = 0 then reference else '' end) as reference_md5 from ({TURN_PAIRS_SQL})",
)
def _(spark, sf):
    path = new_path(spark, "eval-set")
    even = F.col("pair_id") % 2 == 0
    pairs = turn_pairs(spark, sf)
    lines = pairs.select(
        F.when(even, F.to_json(F.struct(F.col("prediction").alias("input"), F.col("reference").alias("output")))).otherwise(
            F.to_json(F.struct(F.col("prediction").alias("prompt")))
        )
    )
    lines.write.text(path)
    rows = readers.read_eval_set(spark, path)
    return rows.select(F.md5("prompt").alias("prompt_md5"), F.md5("reference").alias("reference_md5"))


@query("write_splits", "select 'documents' as name, count(*) as num_samples from documents")
def _(spark, sf):
    parts = tokens.split_dataset(load(spark, sf, "documents").select("doc_id", "text"), "doc_id")
    return writers.write_splits(parts, new_path(spark, "written-splits"), "documents").select("name", "num_samples")


@query("write_results_json", "select event_type as task, 'mean_value' as metric, round(avg(value), 6)::double as value from events group by event_type")
def _(spark, sf):
    path = new_path(spark, "results")
    rows = load(spark, sf, "events").groupBy(F.col("event_type").alias("task")).agg(F.lit("mean_value").alias("metric"), F.avg("value").alias("value"))
    writers.write_results_json(rows, path, {"source": "events"})
    schema = "timestamp timestamp, metadata map<string,string>, results struct<task:string,metric:string,value:double>"
    return rounded(spark.read.schema(schema).json(path).select("results.*"))


# ---- validation and sampling -------------------------------------------------------------------

_CONV_CHECKS = """
    with c as (select conv_id, roles, texts, len(roles) as n, roles[1] as first, roles[len(roles)] as last,
        case when roles[1] = 'system' then roles[2:] else roles end as body from (%s)),
    j as (select *, list_filter([
        case when n < 2 then 'fewer than 2 turns' end,
        case when first not in ('user', 'system') then 'first turn is not user or system' end,
        case when last <> 'assistant' then 'last turn is not assistant' end,
        case when n >= 2 and first = 'system' and roles[2] <> 'user' then 'system is not followed by user' end,
        case when n >= 2 and len(list_filter(range(1, len(body) + 1), lambda i: body[i] <> case when i %% 2 = 1 then 'user' else 'assistant' end)) > 0 then 'turns do not alternate' end,
        case when len(list_filter(texts, lambda t: t = '')) > 0 then 'invalid turn' end], lambda r: r is not null) as reasons from c)""" % _CONV_SQL


@query("validate_conversation", f"{_CONV_CHECKS} select conv_id, array_to_string(reasons, '; ') as reasons from j")
def _(spark, sf):
    found = validate.conversation_violations(F.col("conversations"))
    return _conversations(spark, sf).select("conv_id", F.array_join(found, "; ").alias("reasons"))


@query("turn_row_violations", f"{_CONV_CHECKS} select conv_id, array_to_string(reasons, '; ') as reasons from j")
def _(spark, sf):
    found = validate.turn_row_violations(load(spark, sf, "conversations"), "conv_id", "turn", "role", "text")
    return found.select("conv_id", F.array_join("violations", "; ").alias("reasons"))


@query(
    "normalise",
    f"""{_CONV_CHECKS} select case when len(reasons) = 0 then 'conversation' else 'rejected' end as outcome, count(*) as n from j group by 1""",
)
def _(spark, sf):
    good, bad = validate.normalise(_conversations(spark, sf), "conversation")
    both = good.select(F.col("sample_kind").alias("outcome")).unionByName(bad.select(F.lit("rejected").alias("outcome")))
    return both.groupBy("outcome").agg(F.count("*").alias("n"))


@query(
    "validate_instruction",
    """select doc_id, array_to_string(list_filter([case when length(text) > 4096 then 'instruction is too long' end,
      case when length(lang) = 0 then 'output is empty' end, case when length(text) > 8192 then 'input is too long' end,
      case when length(text) > 2048 then 'system_prompt is too long' end], lambda r: r is not null), '; ') as violations from documents""",
)
def _(spark, sf):
    text = F.col("text")
    found = validate.instruction_violations(text, F.col("lang"), text, text)
    return load(spark, sf, "documents").select("doc_id", F.array_join(found, "; ").alias("violations"))


@query("validate_turn", "select role, count(*) filter (text = '') as empty_turns, count(*) filter (role not in ('system', 'user', 'assistant')) as unknown_roles, count(*) as turns from conversations group by role")
def _(spark, sf):
    found = validate.turn_violations(F.col("role"), F.col("text"))
    rows = load(spark, sf, "conversations").select("role", found.alias("v"))
    return rows.groupBy("role").agg(
        F.count_if(F.array_contains("v", "content is empty")).alias("empty_turns"),
        F.count_if(F.array_contains("v", "unknown role")).alias("unknown_roles"),
        F.count("*").alias("turns"),
    )


@query(
    "null_counts",
    """with d as (select d.doc_id, l.quality, l.toxic from documents d left join labels l on l.doc_id = d.doc_id)
    select 'doc_id' as "column", count(*) filter (doc_id is null) as nulls from d union all
    select 'quality', count(*) filter (quality is null) from d union all select 'toxic', count(*) filter (toxic is null) from d""",
)
def _(spark, sf):
    docs = load(spark, sf, "documents").select("doc_id").join(load(spark, sf, "labels"), "doc_id", "left")
    return validate.null_counts(docs, ["doc_id", "quality", "toxic"])


@query("duplicate_count", "select (count(*) - count(distinct text))::bigint as duplicates from documents")
def _(spark, sf):
    return validate.duplicate_count(load(spark, sf, "documents"), ["text"])


@query("dataset_shape", "select count(*) as num_rows, 11::bigint as num_columns from lineitem")
def _(spark, sf):
    return validate.dataset_shape(load(spark, sf, "lineitem"))


@query("sample_n", f"select doc_id, lang from documents order by {hash_order(42, 'doc_id')}, doc_id limit 100")
def _(spark, sf):
    return validate.sample_n(load(spark, sf, "documents").select("doc_id", "lang"), "doc_id", 100)


@query(
    "capture_sample",
    f"select event_id, event_type from events where ('0x' || substr({hash_order(42, 'event_id')}, 1, 8))::bigint % 10000 < 1000",
)
def _(spark, sf):
    return validate.capture_sample(load(spark, sf, "events"), "event_id", 10.0).select("event_id", "event_type")


@query(
    "validate_dataset",
    """select 'schema' as "check", true as passed, '' as detail union all select 'nulls', true, '' union all
    select 'duplicates', count(*) = count(distinct text), case when count(*) > count(distinct text) then (count(*) - count(distinct text))::varchar else '' end from documents""",
)
def _(spark, sf):
    return validate.validate_dataset(load(spark, sf, "documents"), ["text"])


# ---- conversions -------------------------------------------------------------------------------


@query(
    "instruction_to_conversation",
    f"""select pair_id, 'user assistant' as roles, md5(prediction || chr(10) || chr(10) || reference || chr(31) || reference) as content_md5 from ({TURN_PAIRS_SQL})""",
)
def _(spark, sf):
    rows = convert.instruction_to_conversation(_instructions(spark, sf).withColumn("input", F.col("output")))
    turns = F.col("conversations")
    return rows.select(
        "pair_id",
        F.array_join(turns["role"], " ").alias("roles"),
        F.md5(F.array_join(turns["content"], "\x1f")).alias("content_md5"),
    )


@query(
    "conversation_to_instruction",
    """select conv_id, max(case when turn = 0 and role = 'system' then md5(text) end) as system_md5,
      md5(arg_min(text, turn) filter (role = 'user')) as instruction_md5, md5(arg_max(text, turn) filter (role = 'assistant')) as output_md5
    from conversations group by conv_id""",
)
def _(spark, sf):
    rows = convert.conversation_to_instruction(_conversations(spark, sf))
    return rows.select(
        "conv_id",
        F.md5("system_prompt").alias("system_md5"),
        F.md5("instruction").alias("instruction_md5"),
        F.md5("output").alias("output_md5"),
    )


@query(
    "sharegpt_to_conversation",
    f"""select conv_id, array_to_string(roles, ' ') as roles, md5(array_to_string(texts, chr(31))) as content_md5 from ({_CONV_SQL}) where not list_contains(roles, 'system')
    union all select conv_id, 'unknown speaker', null from ({_CONV_SQL}) where list_contains(roles, 'system')""",
)
def _(spark, sf):
    speaker = lambda r: F.when(r == "user", "human").when(r == "assistant", "gpt").otherwise("narrator")
    raw = _conversations(spark, sf).select(
        "conv_id", F.transform("conversations", lambda t: F.struct(speaker(t["role"]).alias("from"), t["content"].alias("value"))).alias("conversations")
    )
    good, bad = convert.sharegpt_to_conversation(raw)
    turns = F.col("conversations")
    return good.select(
        "conv_id", F.array_join(turns["role"], " ").alias("roles"), F.md5(F.array_join(turns["content"], "\x1f")).alias("content_md5")
    ).unionByName(bad.select("conv_id", F.col("reject_reason").alias("roles"), F.lit(None).cast("string").alias("content_md5")))


@query(
    "alpaca_to_conversation",
    f"""select pair_id, case when pair_id % 3 = 0 then 'output is empty' else 'user assistant' end as outcome from ({TURN_PAIRS_SQL})""",
)
def _(spark, sf):
    rows = _instructions(spark, sf).withColumn("output", F.when(F.col("pair_id") % 3 != 0, F.col("output")).otherwise(""))
    good, bad = convert.alpaca_to_conversation(rows)
    return good.select("pair_id", F.array_join(F.col("conversations")["role"], " ").alias("outcome")).unionByName(
        bad.select("pair_id", F.col("reject_reason").alias("outcome"))
    )


_TRAIN_SQL = "'### Instruction:' || chr(10) || prediction || chr(10) || chr(10) || '### Response:' || chr(10) || reference"


@query("to_training_text", f"select md5({_TRAIN_SQL}) as text_md5, count(*) as n from ({TURN_PAIRS_SQL}) group by 1")
def _(spark, sf):
    return convert.to_training_text(_instructions(spark, sf)).groupBy(F.md5("text").alias("text_md5")).agg(F.count("*").alias("n"))


@query("apply_chat_template", f"select pair_id, md5({_TRAIN_SQL}) as text_md5 from ({TURN_PAIRS_SQL})")
def _(spark, sf):
    return convert.apply_chat_template(_instructions(spark, sf)).select("pair_id", F.md5("text").alias("text_md5"))


# ---- cleaning ----------------------------------------------------------------------------------

# Noise that cleaning must undo: outer space, controls, a decomposed accent, blank lines.
_NOISY_SQL = "'  ' || chr(9) || replace(text, '. ', '.' || chr(7) || chr(10) || chr(10) || chr(10) || chr(10)) || ' e' || chr(769) || chr(0) || chr(10)"
_CLEAN_SQL = f"""trim(regexp_replace(regexp_replace(nfc_normalize(noisy), '[\\x01-\\x08\\x0b-\\x0c\\x0e-\\x1f\\x7f]|\\x00', '', 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g'), {_STRIP})"""


def _noisy():
    blank = F.concat(F.lit("."), F.lit("\x07\n\n\n\n"))
    return F.concat(F.lit("  \t"), F.replace("text", F.lit(". "), blank), F.lit(" é\x07\n"))


@query(
    "clean_text",
    f"""select doc_id, md5({_CLEAN_SQL}) as text_md5 from (select doc_id, {_NOISY_SQL.replace("|| chr(0)", "|| chr(7)")} as noisy from documents)""",
)
def _(spark, sf):
    docs = load(spark, sf, "documents").withColumn("text", _noisy())
    return docs.select("doc_id", F.md5(clean.clean_text(F.col("text"))).alias("text_md5"))


@query(
    "clean_samples",
    f"""select conv_id, md5(array_to_string(list_transform(texts, lambda t: trim(t, {_STRIP}) || ' é'), chr(31))) as content_md5 from ({_CONV_SQL})""",
)
def _(spark, sf):
    said = lambda t: F.struct(t["role"].alias("role"), F.concat(F.lit("\x07 "), t["content"], F.lit(" é \n")).alias("content"))
    noisy = _conversations(spark, sf).withColumn("conversations", F.transform("conversations", said))
    cleaned = clean.clean_samples(noisy, turns="conversations")
    return cleaned.select("conv_id", F.md5(F.array_join(F.col("conversations")["content"], "\x1f")).alias("content_md5"))


@query("drop_empty", f"select count(*) as kept from documents where trim(replace(text, 'e', ''), {_STRIP}) <> '' and lang <> 'fr'")
def _(spark, sf):
    docs = load(spark, sf, "documents").withColumn("text", F.when(F.col("lang") == "fr", " \t\n").otherwise(F.col("text")))
    return clean.drop_empty(docs, ["text"]).agg(F.count("*").alias("kept"))


@query("primary_text", f"select conv_id, md5(array_to_string(texts, chr(10))) as text_md5 from ({_CONV_SQL})")
def _(spark, sf):
    return _conversations(spark, sf).select("conv_id", F.md5(clean.primary_text(turns="conversations")).alias("text_md5"))


@query("filter_by_length", "select doc_id, length(text)::bigint as n from documents where length(text) between 200 and 2000")
def _(spark, sf):
    kept = clean.filter_by_length(load(spark, sf, "documents"), "text", 200, 2000)
    return kept.select("doc_id", F.length("text").cast("bigint").alias("n"))


@query("dedup_exact", "select min(doc_id) as doc_id, md5(text) as text_md5 from documents group by text")
def _(spark, sf):
    return clean.dedup_exact(load(spark, sf, "documents"), "doc_id", "text").select("doc_id", F.md5("text").alias("text_md5"))


def _near_sql(threshold: float, where: str = "true") -> str:
    """Every pair of documents, then the drops in key order, each by its kept predecessors."""
    return f"""with recursive t as (select doc_id, {toks('text')} as t from documents where {where}),
    s as (select distinct doc_id, array_to_string(list_slice(t, i, i + least(5, len(t)) - 1), ' ') as g
      from (select doc_id, t, unnest(range(1, greatest(len(t) - 4, 1) + 1)) as i from t where len(t) > 0)),
    n as (select doc_id, count(*) as n from s group by doc_id),
    e as (select a.doc_id as a, b.doc_id as b from s a join s b on a.g = b.g and a.doc_id < b.doc_id
      join n na on na.doc_id = a.doc_id join n nb on nb.doc_id = b.doc_id group by a.doc_id, b.doc_id, na.n, nb.n
      having count(*) >= {threshold} * (na.n + nb.n - count(*))),
    todo as (select b, list(a) as earlier, row_number() over (order by b) as k from e group by b),
    walk(k, dropped) as (select 0::bigint, []::bigint[] union all
      select w.k + 1, case when len(list_filter(t.earlier, lambda x: not list_contains(w.dropped, x))) > 0 then list_append(w.dropped, t.b) else w.dropped end
      from walk w join todo t on t.k = w.k + 1)
    select unnest(dropped) as doc_id from (select dropped from walk order by k desc limit 1)"""


for _threshold in (0.5, 0.65, 0.8, 0.95):

    @query("near_duplicates" + ("" if _threshold == 0.8 else f"_{_threshold:.2f}".replace("0.", "")), _near_sql(_threshold))
    def _(spark, sf, threshold=_threshold):
        return dedup.near_duplicates(load(spark, sf, "documents"), "doc_id", "text", threshold)


@query(
    "dedup_near",
    f"select lang, count(*) as kept from documents where doc_id not in ({_near_sql(0.8)}) group by lang",
)
def _(spark, sf):
    kept = dedup.dedup_near(load(spark, sf, "documents"), "doc_id", "text", 0.8)
    return kept.groupBy("lang").agg(F.count("*").alias("kept"))


@query("filter_language", "select lang, count(*) as n from documents where lang in ('en', 'fr') group by lang")
def _(spark, sf):
    return clean.filter_language(load(spark, sf, "documents"), "lang", ["en", "fr"]).groupBy("lang").agg(F.count("*").alias("n"))


_STOP = {"de": ("der", "die", "und", "das"), "en": ("the", "and", "of", "to"), "es": ("el", "los", "y", "que"), "fr": ("le", "la", "et", "les")}
_STOP_SQL = ", ".join(
    f"len(list_filter(t, lambda x: list_contains([{', '.join(repr(w) for w in words)}], x))) as {name}" for name, words in sorted(_STOP.items())
)


@query(
    "guess_language",
    f"""with s as (select doc_id, {_STOP_SQL} from (select doc_id, {toks('lower(text)')} as t from documents))
    select doc_id, case when greatest(de, en, es, fr) = 0 then null when de = greatest(de, en, es, fr) then 'de' when en = greatest(de, en, es, fr) then 'en'
      when es = greatest(de, en, es, fr) then 'es' else 'fr' end as language from s""",
)
def _(spark, sf):
    return clean.guess_language(load(spark, sf, "documents"), "text", _STOP).select("doc_id", "language")


@query(
    "cleaning_report",
    f"""with near as ({_near_sql(0.8, "lang <> 'fr'")})
    select count(*) as total_input, count(*) filter (lang <> 'fr') - (select count(*) from near) as total_output,
      count(*) filter (lang = 'fr') as dropped_empty, (select count(*) from near) as near_duplicates_removed from documents""",
)
def _(spark, sf):
    docs = load(spark, sf, "documents").withColumn("text", F.when(F.col("lang") == "fr", " ").otherwise(F.col("text")))
    kept = clean.drop_empty(docs, ["text"])
    return clean.cleaning_report(docs, kept, dedup.dedup_near(kept, "doc_id", "text", 0.8))


# ---- personal data -----------------------------------------------------------------------------


def _luhn(number: str) -> str:
    d = f"regexp_replace({number}, '[ -]', '', 'g')"
    double = "case when 2 * substr(D, j, 1)::int > 9 then 2 * substr(D, j, 1)::int - 9 else 2 * substr(D, j, 1)::int end"
    digit = f"case when (length(D) - j) % 2 = 1 then {double} else substr(D, j, 1)::int end"
    return f"(list_sum(list_transform(range(1, length(D) + 1), lambda j: {digit})) % 10 = 0)".replace("D", d)


_HITS_SQL = " union all ".join(
    f"select doc_id, '{kind}' as entity_type, unnest(regexp_extract_all(text, '{pattern}')) as text_snippet from documents"
    for kind, (pattern, _) in PII_PATTERNS.items()
)
_PII_SQL = f"select * from ({_HITS_SQL}) where entity_type <> 'CREDIT_CARD' or {_luhn('text_snippet')}"


def _doc_texts(spark, sf):
    return pii.long_texts(load(spark, sf, "documents"), "doc_id", ["text"])


@query("pii_scan", f"select doc_id, entity_type, text_snippet, count(*) as n from ({_PII_SQL}) group by all")
def _(spark, sf):
    found = pii.pii_scan(_doc_texts(spark, sf), "doc_id", persons=False)
    return found.groupBy("doc_id", "entity_type", "text_snippet").agg(F.count("*").alias("n"))


@query("pii_spans")
def _(spark, sf):
    return pii.pii_scan(_doc_texts(spark, sf), "doc_id", threshold=0.7)


@query("pii_by_type", f"select entity_type, count(*) as entities, count(distinct doc_id) as samples from ({_PII_SQL}) group by entity_type")
def _(spark, sf):
    return pii.pii_by_type(_doc_texts(spark, sf), "doc_id")


@query(
    "pii_threshold",
    f"select entity_type, count(*) as entities, count(distinct doc_id) as samples from ({_PII_SQL}) where entity_type not in ('PHONE_NUMBER', 'US_SSN') group by entity_type",
)
def _(spark, sf):
    return pii.pii_by_type(_doc_texts(spark, sf), "doc_id", threshold=0.9)


@query(
    "pii_report",
    f"select (select count(distinct doc_id) from ({_PII_SQL})) as samples_with_pii, (count(*) - (select count(distinct doc_id) from ({_PII_SQL})))::bigint as samples_clean from documents",
)
def _(spark, sf):
    return pii.pii_report(_doc_texts(spark, sf), "doc_id")


_CARD = PII_PATTERNS["CREDIT_CARD"][0]


def _replaced(text: str, kind: str) -> str:
    return f"regexp_replace({text}, '{PII_PATTERNS[kind][0]}', '<{kind}>', 'g')"


_MASK_SQL = f"""with a as (select doc_id, {_replaced(_replaced('text', 'EMAIL_ADDRESS'), 'US_SSN')} as x from documents),
    b as (select doc_id, string_split_regex(x, '{_CARD}') as p, regexp_extract_all(x, '{_CARD}') as m from a),
    c as (select doc_id, array_to_string(list_transform(range(1, len(p) + 1), lambda i: p[i] || coalesce(case when {_luhn('m[i]')} then '<CREDIT_CARD>' else m[i] end, '')), '') as x from b)
    select doc_id, md5({_replaced(_replaced('x', 'PHONE_NUMBER'), 'IP_ADDRESS')}) as text_md5 from c"""


@query("pii_redact_mask", _MASK_SQL)
def _(spark, sf):
    docs = load(spark, sf, "documents")
    return pii.redact(docs, "mask", ["text"]).select("doc_id", F.md5("text").alias("text_md5"))


@query("pii_mask_expression", _MASK_SQL)
def _(spark, sf):
    return load(spark, sf, "documents").select("doc_id", F.md5(pii.mask(F.col("text"))).alias("text_md5"))


@query("pii_redact_remove", f"select doc_id from documents where doc_id not in (select doc_id from ({_PII_SQL}))")
def _(spark, sf):
    return pii.redact(load(spark, sf, "documents"), "remove", ["text"]).select("doc_id")


@query("pii_redact_replace")
def _(spark, sf):
    docs = load(spark, sf, "documents").select("doc_id", "text")
    changed = pii.redact(docs.withColumn("before", F.col("text")), "replace", ["text"])
    return changed.filter(F.col("text") != F.col("before")).select("doc_id", F.md5("text").alias("text_md5"))


@query(
    "pii_gate",
    f"""with hit as ({_PII_SQL}) select lang, count(*) as docs, count(*) filter (doc_id in (select doc_id from hit)) = 0 as passed from documents group by lang
    union all select 'without', count(*), count(*) filter (doc_id in (select doc_id from hit)) = 0 from documents where doc_id not in (select doc_id from hit)""",
)
def _(spark, sf):
    docs = load(spark, sf, "documents")
    clean_docs = pii.redact(docs, "remove", ["text"]).withColumn("lang", F.lit("without"))
    out = []
    # One gate for each language, a handful of names.
    for (lang,) in docs.select("lang").distinct().collect():
        out.append((lang, docs.filter(F.col("lang").eqNullSafe(F.lit(lang)))))
    rows = []
    for lang, part in [*out, ("without", clean_docs)]:
        try:
            pii.pii_gate(part.select("text"))
            passed = True
        except pii.PersonalDataFound:
            passed = False
        rows.append(part.agg(F.lit(lang).cast("string").alias("lang"), F.count("*").alias("docs"), F.lit(passed).alias("passed")))
    whole = rows[0]
    for row in rows[1:]:
        whole = whole.unionByName(row)
    return whole


@query("pii_person", f"select count(*) as docs, sum(len(regexp_extract_all(text, '{pii.person_pattern()}')))::bigint as names from documents")
def _(spark, sf):
    counts = pii.entity_counts(F.col("text"), persons=True)
    return load(spark, sf, "documents").agg(F.count("*").alias("docs"), F.sum(counts["PERSON"]).alias("names"))


_WORDS_SQL = r"unnest(regexp_extract_all(text, '\pL+(?:[-''’]\pL+)*'))"


# The capitalised first words of benchmark items stand in for a table of names.
@query(
    "pii_person_names",
    f"""with names as (select distinct regexp_extract(text, '^[A-Z][a-z]+') as name from benchmark where regexp_matches(text, '^[A-Z][a-z]+ ')),
    words as (select doc_id, {_WORDS_SQL} as word from documents)
    select word as text_snippet, count(*) as entities, count(distinct doc_id) as samples from words join names on name = word group by word""",
)
def _(spark, sf):
    listed = load(spark, sf, "benchmark").filter(F.col("text").rlike("^[A-Z][a-z]+ ")).select(F.regexp_extract("text", "^[A-Z][a-z]+", 0).alias("name"))
    spans = person_spans(_doc_texts(spark, sf), "doc_id", listed)
    per_doc = spans.groupBy("text_snippet", "doc_id").agg(F.count("*").alias("n"))
    return per_doc.groupBy("text_snippet").agg(F.sum("n").alias("entities"), F.count("*").alias("samples"))


_BLOCKED_SQL = f"len(list_intersect({toks('lower(text)')}, ['idiot', 'stupid'])) > 0 or contains(lower(text), 'of the')"


@query(
    "word_filter",
    f"select doc_id, md5({_replaced('text', 'EMAIL_ADDRESS')}) as text_md5 from documents where not ({_BLOCKED_SQL})",
)
def _(spark, sf):
    docs = load(spark, sf, "documents")
    kept = pii.word_filter(docs, "text", ["idiot", "stupid", "of the"], ["EMAIL_ADDRESS"])
    return kept.select("doc_id", F.md5("text").alias("text_md5"))


# ---- rendering, tokens, splits -----------------------------------------------------------------

_NL = "chr(10)"
_FORMATS = {
    "alpaca": f"'{ALPACA_PREAMBLE}' || {_NL} || {_NL} || '### Instruction:' || {_NL} || prediction || {_NL} || case when lang <> '' then {_NL} || '### Input:' || {_NL} || lang || {_NL} else '' end || {_NL} || '### Response:' || {_NL} || reference",
    "chatml": f"'<|im_start|>system' || {_NL} || lang || '<|im_end|>' || {_NL} || '<|im_start|>user' || {_NL} || prediction || '<|im_end|>' || {_NL} || '<|im_start|>assistant' || {_NL} || reference || '<|im_end|>'",
    "llama3": f"'<|begin_of_text|><|start_header_id|>system<|end_header_id|>' || {_NL} || {_NL} || lang || '<|eot_id|><|start_header_id|>user<|end_header_id|>' || {_NL} || {_NL} || prediction || '<|eot_id|><|start_header_id|>assistant<|end_header_id|>' || {_NL} || {_NL} || reference || '<|eot_id|>'",
    "mistral": f"'[INST] ' || lang || {_NL} || {_NL} || prediction || ' [/INST] ' || reference || '</s>'",
}

for _name, _sql in _FORMATS.items():

    @query(f"render_{_name}", f"select pair_id, md5({_sql}) as rendered_md5 from (select *, 'be brief' as lang from ({TURN_PAIRS_SQL}))")
    def _(spark, sf, name=_name):
        rows = _instructions(spark, sf).withColumn("extra", F.lit("be brief"))
        done = template.render_template(rows, name, input_="extra", system="extra")
        return done.select("pair_id", F.md5("rendered").alias("rendered_md5"))


@query("render_custom", f"select pair_id, md5('Task> ' || prediction || chr(10) || 'Result> ' || reference) as rendered_md5 from ({TURN_PAIRS_SQL})")
def _(spark, sf):
    done = template.render_custom(_instructions(spark, sf), "Task> {{ instruction }}\nResult> {{ output }}")
    return done.select("pair_id", F.md5("rendered").alias("rendered_md5"))


@query(
    "render_conversation",
    f"""with c as (select conv_id, case when roles[1] = 'system' then texts[1] end as sys, case when roles[1] = 'system' then texts[2:] else texts end as body from ({_CONV_SQL}))
    select conv_id, md5(array_to_string(list_transform(range(0, len(body) // 2), lambda i:
      case when i = 0 and sys <> '' then '<|im_start|>system' || {_NL} || sys || '<|im_end|>' || {_NL} else '' end || '<|im_start|>user' || {_NL} || body[2 * i + 1] || '<|im_end|>' || {_NL}
      || '<|im_start|>assistant' || {_NL} || body[2 * i + 2] || '<|im_end|>'), {_NL})) as rendered_md5 from c""",
)
def _(spark, sf):
    done = template.render_conversation(_conversations(spark, sf), "chatml")
    return done.select("conv_id", F.md5("rendered").alias("rendered_md5"))


@query("estimate_tokens", "select doc_id, ceil(length(text) / 4.0)::bigint as estimate from documents")
def _(spark, sf):
    return load(spark, sf, "documents").select("doc_id", template.estimate_tokens(F.col("text")).alias("estimate"))


_ALL_TOKENS_SQL = f"""with r as (select pair_id, '<|im_start|>user' || {_NL} || prediction || '<|im_end|>' || {_NL} || '<|im_start|>assistant' || {_NL} as prompt, reference || '<|im_end|>' as answer from ({TURN_PAIRS_SQL})),
    i as (select pair_id, list_append(list_transform(regexp_extract_all(prompt || answer, '{tokens.WORD_PATTERN}'), lambda x: ('0x' || substr(md5(x), 1, 8))::bigint % {tokens.EOS_ID}), {tokens.EOS_ID}) as ids,
      len(regexp_extract_all(prompt, '{tokens.WORD_PATTERN}')) as np from r)"""
_TOKEN_SQL = f"{_ALL_TOKENS_SQL}, s as (select pair_id, ids[1:128] as ids, least(np, len(ids), 128) as ignored, len(ids) > 128 as cut from i)"


def _tokenised(spark, sf, longest=128):
    done = template.render_template(_instructions(spark, sf), "chatml")
    return tokens.tokenize_with_labels(done, "rendered", "chatml", longest)


@query(
    "tokenize_with_labels",
    f"""{_TOKEN_SQL} select pair_id, len(ids)::bigint as n, list_sum(ids)::bigint as id_sum, ignored::bigint as ignored,
      coalesce(list_sum(ids[ignored + 1:]), 0)::bigint as label_sum, cut as was_truncated from s""",
)
def _(spark, sf):
    add = lambda c: F.aggregate(c, F.lit(0).cast("bigint"), lambda a, x: a + x)
    rows = _tokenised(spark, sf)
    return rows.select(
        "pair_id",
        F.size("input_ids").cast("bigint").alias("n"),
        add("input_ids").alias("id_sum"),
        F.size(F.filter("labels", lambda x: x == -100)).cast("bigint").alias("ignored"),
        add(F.filter("labels", lambda x: x != -100)).alias("label_sum"),
        "was_truncated",
    )


@query("drop_unlabeled", f"{_TOKEN_SQL} select pair_id, cut as was_truncated from s where ignored < len(ids)")
def _(spark, sf):
    return tokens.drop_unlabeled(_tokenised(spark, sf)).select("pair_id", "was_truncated")


@query(
    "token_statistics",
    f"""{_ALL_TOKENS_SQL}, s as (select pair_id, ids, least(np, len(ids)) as ignored from i) select count(*) as total_samples, round(avg(ignored), 6)::double as avg_input_tokens, round(avg(len(ids) - ignored), 6)::double as avg_output_tokens,
      max(ignored)::bigint as max_input_tokens, max(len(ids) - ignored)::bigint as max_output_tokens, round(quantile_cont(len(ids), 0.5), 6)::double as p50,
      round(quantile_cont(len(ids), 0.9), 6)::double as p90, round(quantile_cont(len(ids), 0.95), 6)::double as p95, round(quantile_cont(len(ids), 0.99), 6)::double as p99 from s""",
)
def _(spark, sf):
    stats = tokens.token_statistics(_tokenised(spark, sf, 2**30))
    return rounded(stats.withColumns({c: F.col(c).cast("bigint") for c in ("total_samples", "max_input_tokens", "max_output_tokens")}))


@query(
    "split_dataset",
    f"""with r as (select doc_id, row_number() over (order by {hash_order(7, 'doc_id')}, doc_id) as k, count(*) over () as n from documents),
    c as (select *, greatest(1, floor(n * 0.1 + 1e-9)) as v, greatest(1, floor(n * 0.1 + 1e-9)) as t from r)
    select doc_id, case when k <= n - v - t then 'train' when k <= n - t then 'validation' else 'test' end as split from c""",
)
def _(spark, sf):
    return tokens.split_dataset(load(spark, sf, "documents").select("doc_id"), "doc_id", 0.8, 0.1, seed=7)


@query(
    "split_dataset_in_order",
    """with r as (select event_id, row_number() over (order by event_id) as k, count(*) over () as n from events),
    c as (select *, greatest(1, floor(n * 0.05 + 1e-9)) as v, greatest(1, floor(n * 0.05 + 1e-9)) as t from r)
    select case when k <= n - v - t then 'train' when k <= n - t then 'validation' else 'test' end as split, count(*) as n, min(event_id) as first_id, max(event_id) as last_id from c group by 1""",
)
def _(spark, sf):
    parts = tokens.split_dataset(load(spark, sf, "events").select("event_id"), "event_id", shuffle=False)
    return parts.groupBy("split").agg(F.count("*").alias("n"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"))


@query("prepare_corpus")
def _(spark, sf):
    config = prepare.PrepareConfig(source="", work_dir=new_path(spark, "prepare"), template="chatml")
    rows = _instructions(spark, sf).select("instruction", "output")
    return prepare.prepare_corpus(spark, config, rows).select("step", "name", "input_count", "output_count")


_STEPS_SQL = ", ".join(f"({k + 1}, '{name}')" for k, name in enumerate(prepare.STEPS))


@query(
    "prepare_conversations",
    f"""{_CONV_CHECKS}, n as (select count(*) as whole, count(*) filter (len(reasons) = 0) as valid from j), steps(step, name) as (values {_STEPS_SQL})
    select step, name, case when step <= 2 then whole else valid end as input_count, case when step = 1 then whole else valid end as output_count, valid as published from steps, n""",
)
def _(spark, sf):
    work = new_path(spark, "prepare")
    config = prepare.PrepareConfig(source="", work_dir=work, kind="conversation", template="chatml", max_length=100_000, pii_strategy=None, near_threshold=None)
    steps = prepare.prepare_corpus(spark, config, _conversations(spark, sf).select("conversations"))
    version = catalog.find_version(spark, f"{work}/versions", config.name, config.version)
    return steps.select("step", "name", "input_count", "output_count", F.lit(version["num_samples"]).alias("published"))


@query("corpus_report")
def _(spark, sf):
    docs = load(spark, sf, "documents")
    # Cut points: both de-duplications read their input twice.
    cleaned = clean.drop_empty(clean.clean_samples(docs.select("doc_id", "lang", "text"), ["text"]), ["text"])
    unique = clean.dedup_exact(materialise(cleaned, "cleaned"), "doc_id", "text")
    masked = materialise(pii.redact(unique, "mask", ["text"]), "masked")
    kept = dedup.dedup_near(masked, "doc_id", "text", 0.8)
    return kept.groupBy("lang").agg(F.count("*").alias("documents"), F.sum(F.length("text")).alias("characters"))


# ---- catalog -----------------------------------------------------------------------------------

_VERSIONS = {"en": "1.0.0", "fr": "2.0.0", "de": "10.0.0", "es": "2.1.0"}
_VERSION_SQL = "case lang " + " ".join(f"when '{k}' then '{v}'" for k, v in _VERSIONS.items()) + " end"
_LANES_SQL = " || '|' || ".join(f"sum(('0x' || substr(d, {8 * i + 1}, 8))::hugeint)::varchar" for i in range(8))
_CHECKSUM_SQL = f"select source, lang, count(*) as num_samples, sha256('documents|' || count(*)::varchar || '|' || {_LANES_SQL}) as sha256_checksum from (select source, lang, sha256(text) as d from documents) group by source, lang"


@query("dataset_checksum", _CHECKSUM_SQL)
def _(spark, sf):
    return catalog.dataset_checksum(load(spark, sf, "documents"), ["text"], "documents", ["source", "lang"])


def _manifests(spark, sf):
    sums = catalog.dataset_checksum(load(spark, sf, "documents"), ["text"], "documents", ["source", "lang"])
    version = F.lit(None)
    for lang, number in _VERSIONS.items():
        version = F.when(F.col("lang") == lang, number).otherwise(version)
    return sums.select(F.col("source").alias("name"), version.alias("version"), "num_samples", "sha256_checksum")


@query("list_versions", f"select source as name, {_VERSION_SQL} as version, count(*) as num_samples from documents where source = 'src1' group by all")
def _(spark, sf):
    return catalog.list_versions(_manifests(spark, sf), "src1").select("name", "version", "num_samples")


@query(
    "diff_versions",
    """with m as (select source as name, count(*) filter (lang = 'en') as a, count(*) filter (lang = 'fr') as b from documents group by source)
    select name, '1.0.0' as version_old, '2.0.0' as version_new, greatest(b - a, 0)::bigint as samples_added, greatest(a - b, 0)::bigint as samples_removed from m where a > 0 and b > 0""",
)
def _(spark, sf):
    return catalog.diff_by_count(_manifests(spark, sf), "1.0.0", "2.0.0")


@query(
    "diff_content",
    """with a as (select lang, text from documents where source = 'src1'), b as (select lang, text from documents where source = 'src2')
    select change, count(*) as n from (select 'added' as change, * from (select * from b except all select * from a) union all select 'removed', * from (select * from a except all select * from b)) group by change""",
)
def _(spark, sf):
    docs = load(spark, sf, "documents")
    of = lambda s: docs.filter(F.col("source") == s).select("lang", "text")
    return catalog.diff_content(of("src1"), of("src2")).groupBy("change").agg(F.sum("copies").alias("n"))


@query(
    "publish_and_checkout",
    """select '1.0.0' as version, (select count(*) from documents) as num_samples union all
    select '2.0.0', (select count(*) from documents where doc_id in (select doc_id from labels where quality = 1))""",
)
def _(spark, sf):
    store = new_path(spark, "store")
    docs = load(spark, sf, "documents").select("doc_id", "text", "lang")
    good = load(spark, sf, "labels").filter("quality = 1")
    catalog.publish_version(docs, store, "documents", "1.0.0", source_path=sf)
    catalog.publish_version(docs.join(good, "doc_id", "left_semi"), store, "documents", "2.0.0", source_path=sf)
    parts = [
        spark.read.parquet(catalog.checkout_version(spark, store, "documents", v)).agg(
            F.lit(v).alias("version"), F.count("*").alias("num_samples")
        )
        for v in ("1.0.0", "2.0.0")
    ]
    return parts[0].unionByName(parts[1])


@query(
    "search_datasets",
    f"select source as name, {_VERSION_SQL} as version, count(*) as num_samples, 'not_scanned' as pii_scan_result from documents where lang = 'fr' group by all",
)
def _(spark, sf):
    registry = _manifests(spark, sf).select(
        F.sha2(F.concat_ws("|", "name", "version"), 256).alias("dataset_id"),
        F.struct("name", "version", "num_samples").alias("manifest"),
        catalog.lineage_of(sf, "parquet", "", "1", ["split by language"]).alias("lineage"),
    )
    found = catalog.search_datasets(registry, {"manifest.version": "2.0.0", "lineage.parent_dataset_id": None, "no.such.path": None})
    return found.select("manifest.name", "manifest.version", "manifest.num_samples", "lineage.pii_scan_result")


@query("get_lineage", "select 'parquet' as source_format, '2' as pipeline_version, count(*) as num_samples from documents")
def _(spark, sf):
    path = new_path(spark, "registry")
    documents = load(spark, sf, "documents")
    manifest = catalog.dataset_checksum(documents, ["text"], "documents").select(
        F.lit("documents").alias("name"), F.lit("2.0.0").alias("version"), F.lit(sf).alias("source_path"), "num_samples", "sha256_checksum"
    )
    dataset_id = catalog.register_dataset(manifest, catalog.lineage_of(sf, "parquet", "", "2", []), path, "tester")
    registry = spark.read.parquet(path)
    counted = catalog.get_dataset(registry, dataset_id).select("dataset_id", "manifest.num_samples")
    return catalog.get_lineage(registry, dataset_id).join(counted, "dataset_id").select(
        "source_format", "pipeline_version", "num_samples"
    )


@query("register_and_get", "select 'documents' as name, (select count(*) from documents) as num_samples, 'parquet' as source_format, true as has_train_path")
def _(spark, sf):
    path = new_path(spark, "registry")
    manifest = catalog.dataset_checksum(load(spark, sf, "documents"), ["text"], "documents").select(
        F.lit("documents").alias("name"), F.lit("1.0.0").alias("version"), F.lit(sf).alias("source_path"), "num_samples", "sha256_checksum"
    )
    lineage = catalog.lineage_of(sf, "parquet", "", "1", [])
    dataset_id = catalog.register_dataset(manifest, lineage, path, "tester")
    row = catalog.get_dataset(spark.read.parquet(path), dataset_id)
    return row.select(
        "manifest.name", "manifest.num_samples", "lineage.source_format", F.col("train_path").endswith("/train").alias("has_train_path")
    )
