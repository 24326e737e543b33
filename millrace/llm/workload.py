"""Registered queries of this package and, where SQL can say it, the same result as SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm import attribution, decontaminate, digest, infill, jaccard, kdtree, langid, linefreq, lm, mixing, toxicity, whitening, wrappers
from millrace.llm.common import crc_bucket, documents, materialise, numbered, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


@query("op7_token_counts")
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document, from one encoding of the whole text."""
    return attribution.section_tokens(documents(spark, sf_dir), ["doc_id"]).withColumn("tokens", F.col("tokens").cast("long"))


_WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"


@query("op1_toxicity")
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from labels of four fifths of them."""
    docs = documents(spark, sf_dir).select("doc_id", "text").withColumn("held_out", crc_bucket("doc_id", 5) == 0)
    chain = toxicity.train(docs.filter("not held_out"), table(spark, sf_dir, "labels"))
    return toxicity.tag(docs, chain).select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans")


@query("op2_jaccard_join")
def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents linked by four-word shingles at a Jaccard similarity of 0.85."""
    return jaccard.near_duplicates(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


@query("op3_fingerprints")
def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quartile bucket digests of every text and of its edit with the next document's start."""
    return digest.fingerprints(documents(spark, sf_dir))


_BENCH_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""


@query(
    "op4_decontamination",
    f"""
    with d as (select row_number() over () as r, doc_id, {_BENCH_WORDS} as w from documents),
    windows as (
      select distinct item_id, len, array_to_string(w[i : i + len - 1], ' ') as words
      from (select item_id, w, least(13, len(w)) as len, unnest(range(1, len(w) - least(13, len(w)) + 2)) as i
            from (select item_id, {_BENCH_WORDS} as w from benchmark) where len(w) > 0)),
    lengths as (select distinct len from windows),
    places as (
      select r, i, len, array_to_string(w[i : i + len - 1], ' ') as words
      from (select r, w, len, unnest(range(1, len(w) - len + 2)) as i from d, lengths where len(w) >= len)),
    hits as (select p.r, p.i, p.len, x.item_id from places p join windows x on p.len = x.len and p.words = x.words),
    words as (select r, count(distinct pos) as n_hit from (select r, unnest(range(i, i + len)) as pos from hits) group by r),
    items as (
      select r, count(*) as n_items, string_agg(item, ',' order by item) as ids
      from (select distinct r, cast(item_id as varchar) as item from hits where item_id is not null) group by r)
    select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
           sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
    from d left join words using (r) left join items using (r)""",
)
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside benchmark windows, and the items they belong to."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = decontaminate.find_occurrences(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "found.n_words", "found.n_hit", F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("found.items"), ","), 256).alias("items_sha256"),
        decontaminate.is_contaminated("found").alias("contaminated"),
    )


@query("op5_html_extraction")
def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Article text of every page by the wrapper of its host."""
    found = wrappers.main_text(table(spark, sf_dir, "pages"), ["page_id", "url"])
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


@query("op6_language_id")
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by code length, learned from two thirds of the documents."""
    docs = documents(spark, sf_dir).withColumn("held_out", crc_bucket("doc_id", 3) == 1)
    model = langid.train(docs.filter("not held_out"))
    return langid.predict(docs, model, ["doc_id", "held_out"])


@query(
    "op8_mixing",
    f"""
    with rows as (select doc_id, source, {_WORDS} as size, md5('mix|' || coalesce(cast(doc_id as varchar), '')) as h from documents),
    sources as (
      select *, case ord % 3 when 0 then 3 when 1 then 1 else 2 end as weight, 2 * source_size as cap from (
        select source, cast(sum(size) as bigint) as source_size, row_number() over (order by source nulls last) - 1 as ord
        from rows group by source)),
    levelled as (
      select *, (cast(1.5 as double) * cast(sum(source_size) over () as bigint) - cast(coalesce(sum(cap) over before, 0) as bigint))
          / cast(sum(weight) over () - coalesce(sum(weight) over before, 0) as bigint) as level
      from sources
      window before as (order by cast(cap as double) / weight, ord rows between unbounded preceding and 1 preceding)),
    targets as (
      select source, source_size, case when last is null then cast(cap as double) else least(cast(cap as double), last * weight) end as target
      from (select *, max(case when cast(cap as double) / weight > level then level end) over () as last from levelled)),
    placed as (
      select r.doc_id, r.size, t.source_size, t.target, cast(floor(t.target) as bigint) as wanted,
             cast(coalesce(sum(r.size) over (partition by r.source order by r.h, r.doc_id, r.size
                 rows between unbounded preceding and 1 preceding), 0) as bigint) as start
      from rows r join targets t on r.source is not distinct from t.source)
    select doc_id, cast(size as bigint) as size, source_size, target,
           cast(greatest(least(start + size, wanted) - start, 0)
              + greatest(least(start + source_size + size, wanted) - start - source_size, 0) as bigint) as taken
    from placed""",
)
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of 150% of all words, by cycling source weights, takes of every document."""
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


@query("op9_lm_scoring")
def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document under a backoff automaton of nine tenths of them."""
    docs = documents(spark, sf_dir).withColumn("held_out", crc_bucket("doc_id", 10) == 0)
    return lm.train_and_score(docs, ~F.col("held_out"), ["doc_id", "held_out"])


@query("op10_sharding")
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen shards of near-equal bytes from a k-d tree over what the texts say about themselves."""
    docs = documents(spark, sf_dir)
    point = kdtree.text_point("text")
    rows = materialise(
        docs.select("doc_id", F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), *[c.alias(n) for n, c in point.items()]),
        "shard-rows",
    )
    tree = kdtree.fit_tree(materialise(kdtree.groups(rows), "shard-points"), kdtree.TEXT_DIMS, shards=16)
    shard = tree.shard({d: F.col(d) for d in kdtree.TEXT_DIMS}, F.col("key"))
    placed = materialise(rows.select("doc_id", F.col("w").alias("size"), "text_crc32", "key", shard.alias("shard")), "shard-placed")
    return numbered(placed, "shard", ["doc_id", "key"], "slot", rows.count()).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


_LINE_KEY = r"""array_to_string(regexp_extract_all(translate(regexp_replace(l, '[0-9]', '0', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+'), ' ')"""


@query(
    "op11_line_frequency",
    rf"""
    with docs as (
      select row_number() over () as r, doc_id, source, coalesce(text, '') as t,
             regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
    lines as (
      select r, source, t, l, len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) as words, {_LINE_KEY} as key
      from (select r, source, t, unnest(string_split(t, chr(10))) as l from docs)
      where regexp_matches(l, '[^\x20\x09-\x0D]')),
    repeats as (select r, sum(n - 1) as n_dup_lines from (select r, l, count(*) as n from lines group by r, l) group by r),
    windows as (
      select r, i, array_to_string(w[i : i + 7], ' ') as k
      from (select r, w, unnest(range(1, len(w) - 6)) as i from docs where len(w) >= 8)),
    twice as (select r, i from (select r, i, count(*) over (partition by r, k) as n from windows) where n > 1),
    inside as (select r, count(distinct p) as n_repeat_words from (select r, unnest(range(i, i + 8)) as p from twice) group by r),
    hosts as (select source, count(distinct t) as host_docs from docs group by source),
    frequent as (
      select f.source, f.key from (select source, key, count(distinct t) as n from lines group by source, key) f
      join hosts h on f.source is not distinct from h.source where n >= {linefreq.LINE_DOCS} and n >= {linefreq.LINE_SHARE} * host_docs),
    gone as (
      select r, sum(words) as removed_words, count(*) as removed_lines
      from lines l join frequent f on l.source is not distinct from f.source and l.key = f.key group by r),
    base as (
      select r, doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as bigint) as word_chars,
             cast(len(regexp_extract_all(t, '[#*$%&|<>]')) as bigint) as n_symbols from docs),
    counted as (
      select b.*, cast(coalesce(n_dup_lines, 0) as bigint) as n_dup_lines, cast(coalesce(n_repeat_words, 0) as bigint) as n_repeat_words,
             cast(coalesce(removed_lines, 0) as bigint) as removed_lines, cast(n_words - coalesce(removed_words, 0) as bigint) as left_words
      from base b left join repeats using (r) left join inside using (r) left join gone using (r)),
    judged as (select *, n_words < {linefreq.LEAST_WORDS} or 100 * n_repeat_words > {linefreq.MOST_REPEATED} * n_words as base_failed from counted)
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, removed_lines, left_words,
           not base_failed and left_words >= {linefreq.LEFT_SHARE} * n_words and left_words >= {linefreq.LEAST_WORDS} as kept
    from judged""",
)
def op11_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts of every document and whether enough of it is left without the frequent lines of its source."""
    docs = documents(spark, sf_dir).select("doc_id", "text", "source")
    rows = linefreq.line_rules(docs, cleaned=False)
    return rows.select(
        "doc_id", *[f"quality.{c}" for c in linefreq.COUNTS], "quality.base_failed",
        F.size("quality.removed").cast("long").alias("removed_lines"), "quality.left_words", "quality.kept",
    )


@query(
    "op12_fill_in_middle",
    """
    with docs as (
      select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as u,
             sha256('1:' || coalesce(cast(doc_id as varchar), '')) as k from documents),
    keys as (
      select *, len(u) as n, cast('0x' || k[1:8] as bigint) as h1, cast('0x' || k[9:16] as bigint) as h2,
             cast('0x' || k[17:24] as bigint) as h3, cast('0x' || k[25:32] as bigint) as h4 from docs),
    cuts as (
      select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
             case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 90 then 'plain'
                  when h4 % 100 < 20 then 'spm' else 'psm' end as form from keys),
    parts as (
      select *, array_to_string(u[1 : a], '') as prefix, array_to_string(u[a + 1 : b], '') as middle, array_to_string(u[b + 1 : n], '') as suffix from cuts)
    select doc_id, cast(n as bigint) as n, form,
           case when form <> 'plain' then cast(length(prefix) as bigint) end as prefix_chars,
           case when form <> 'plain' then cast(length(middle) as bigint) end as middle_chars,
           sha256(case form when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                            when 'spm' then '<S>' || suffix || '<P>' || prefix || '<M>' || middle else t end) as output_sha256,
           sha256(t) as restored_sha256
    from parts""",
)
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix, suffix and middle of every document by cuts that its id decides, and the text rebuilt from them."""
    rows = infill.infill(documents(spark, sf_dir).select("doc_id", "text"))
    back = infill.restored("infill.output", "infill.form")
    return rows.select(
        "doc_id", "infill.n", "infill.form", "infill.prefix_chars", "infill.middle_chars",
        F.sha2("infill.output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"),
    )


@query("op13_whitening")
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four whitened components of every embedding, fitted on all distinct vectors."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"), ["vec_id"])
