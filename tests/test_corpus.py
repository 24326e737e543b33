"""Validation, conversion, cleaning, de-duplication, personal data, rendering, tokens."""

import random
import unicodedata

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from millrace.operators import clean, convert, dedup, pii, template, tokens, validate, names as names_module

TURNS = "id int, conversations array<struct<role:string,content:string>>"


def conv(spark, *role_lists):
    rows = [(i, [(r, f"text {j}") for j, r in enumerate(roles)]) for i, roles in enumerate(role_lists)]
    return spark.createDataFrame(rows, TURNS)


def reasons(spark, roles):
    df = conv(spark, roles)
    return df.select(validate.conversation_violations(F.col("conversations")).alias("v")).first()["v"]


# ---- validation


@pytest.mark.parametrize(
    "roles", ["user assistant", "system user assistant", "system user assistant user assistant", "user assistant user assistant"]
)
def test_valid_conversations(spark, roles):
    assert reasons(spark, roles.split()) == []


@pytest.mark.parametrize(
    "roles,part",
    [
        ("user", "fewer than 2"),
        ("", "fewer than 2"),
        ("assistant user", "first turn"),
        ("user user", "last turn"),
        ("user user assistant", "alternate"),
        ("user assistant assistant user assistant", "alternate"),
        ("system assistant", "system is not followed"),
    ],
)
def test_invalid_conversations(spark, roles, part):
    assert any(part in r for r in reasons(spark, roles.split()))


def test_unknown_role_and_empty_content(spark):
    df = spark.createDataFrame([("robot", "x"), ("user", ""), ("user", None), ("user", "ok")], "role string, content string")
    found = [r["v"] for r in df.select(validate.turn_violations(F.col("role"), F.col("content")).alias("v")).collect()]
    assert found == [["unknown role"], ["content is empty"], ["content is empty"], []]


@pytest.mark.parametrize(
    "row,bad",
    [
        (("", "o", None, None), True),
        (("i" * 4096, "o" * 8192, "x" * 8192, "s" * 2048), False),
        (("i" * 4097, "o", None, None), True),
        (("i", "o" * 8193, None, None), True),
        (("i", "", None, None), True),
        (("i", "o", "x" * 8193, None), True),
        (("i", "o", None, "s" * 2049), True),
        (("\U0001f600" * 4096, "o", None, None), False),
        ((" ", "o", None, None), False),
    ],
)
def test_instruction_bounds(spark, row, bad):
    df = spark.createDataFrame([row], "instruction string, output string, input string, system_prompt string")
    found = df.select(validate.instruction_violations(*[F.col(c) for c in ("instruction", "output", "input", "system_prompt")]).alias("v"))
    assert bool(found.first()["v"]) is bad


def test_normalise_auto_counts_rejects(spark):
    df = spark.createDataFrame(
        [("a", "b", None), (None, None, [("user", "q"), ("assistant", "a")]), (None, None, None)],
        "instruction string, output string, conversations array<struct<role:string,content:string>>",
    )
    good, bad = validate.normalise(df)
    assert sorted(r["sample_kind"] for r in good.collect()) == ["conversation", "instruction"]
    assert bad.count() == 1 and bad.first()["reject_reason"]
    with pytest.raises(ValueError):
        validate.normalise(df, "other")


def test_dataset_checks(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", None)], "t string, n int")
    with pytest.raises(ValueError, match="Missing required columns"):
        validate.validate_columns(df, ["t", "z"])
    with pytest.raises(ValueError):
        validate.validate_no_nulls(df, ["n"])
    validate.validate_no_nulls(df, ["t"])
    assert validate.duplicate_count(df, ["t"]).first()[0] == 1
    assert tuple(validate.dataset_shape(df).first()) == (3, 2)
    got = {r["check"]: r["passed"] for r in validate.validate_dataset(df, ["t", "n", "z"]).collect()}
    assert got == {"schema": False, "nulls": False, "duplicates": False}


def test_sample_n(spark):
    df = spark.range(50)
    assert validate.sample_n(df, "id", 100).count() == 50
    a = {r["id"] for r in validate.sample_n(df, "id", 10).collect()}
    assert len(a) == 10 and a == {r["id"] for r in validate.sample_n(df.repartition(7), "id", 10).collect()}
    assert a != {r["id"] for r in validate.sample_n(df, "id", 10, seed=1).collect()}


# ---- conversion


def test_conversation_to_instruction_keeps_first_and_last(spark):
    rows = [(0, [("user", "First Q"), ("assistant", "First A"), ("user", "Second Q"), ("assistant", "Second A")])]
    row = convert.conversation_to_instruction(spark.createDataFrame(rows, TURNS)).first()
    assert (row["instruction"], row["output"], row["system_prompt"]) == ("First Q", "Second A", None)


def test_sharegpt(spark):
    kind = "id int, conversations array<struct<from:string,value:string>>"
    rows = [(0, [("human", "Hello"), ("gpt", "Hi there!")]), (1, [("alien", "x")]), (2, None)]
    good, bad = convert.sharegpt_to_conversation(spark.createDataFrame(rows, kind))
    assert [t["role"] for t in good.first()["conversations"]] == ["user", "assistant"]
    assert {r["id"]: r["reject_reason"] for r in bad.collect()} == {1: "unknown speaker", 2: "no conversation list"}


def test_training_text(spark):
    df = spark.createDataFrame([("i", "x", "o"), ("i", "", "o"), ("i", None, None)], "instruction string, input string, output string")
    got = sorted(r["text"] for r in convert.to_training_text(df).collect())
    assert got == ["### Instruction:\ni\n\n### Input:\nx\n\n### Response:\no", "### Instruction:\ni\n\n### Response:\no"]
    assert convert.to_training_text(df.withColumn("input_ids", F.lit(1))).columns == [*df.columns, "input_ids"]
    assert "text" in convert.apply_chat_template(df).columns


words = st.text(st.characters(codec="utf-8", exclude_categories=("Cs", "Cc")), min_size=1, max_size=20)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(words, words, st.none() | words), min_size=1, max_size=6))
def test_round_trip(spark, samples):
    df = spark.createDataFrame([(i, *s) for i, s in enumerate(samples)], "id int, instruction string, output string, system_prompt string")
    there = convert.instruction_to_conversation(df)
    assert there.filter(F.size(validate.conversation_violations(F.col("conversations"))) > 0).count() == 0
    back = {r["id"]: r for r in convert.conversation_to_instruction(there.drop("instruction", "output", "system_prompt")).collect()}
    for i, (instruction, output, system) in enumerate(samples):
        assert (back[i]["instruction"], back[i]["output"], back[i]["system_prompt"]) == (instruction, output, system)


# ---- cleaning

CLEAN = {
    "  hello  ": "hello",
    "e\u0301": "\u00e9",
    "\u212b": "\u00c5",
    "hello\x00world": "helloworld",
    "line1\x07\x08line2\x0b\x1f": "line1line2",
    "e\x07\u0301": "e\u0301",
    "a\n\n\n\nb": "a\n\nb",
    "a\n\nb": "a\n\nb",
    "a\nb": "a\nb",
    "   \t  ": "",
    "\u00a0x\u3000": "x",
    "\u4f60\u597d \u0645\u0631 \U0001f468\u200d\U0001f469": "\u4f60\u597d \u0645\u0631 \U0001f468\u200d\U0001f469",
}


def test_clean_text_literals(spark):
    df = spark.createDataFrame(list(CLEAN.items()), "t string, want string")
    for r in df.withColumn("got", clean.clean_text(F.col("t"))).collect():
        assert r["got"] == r["want"], repr(r["t"])


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8", exclude_categories=("Cs", "Cc")), max_size=30), min_size=1, max_size=20))
def test_clean_text_composes_like_unicodedata(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.withColumn("got", clean.clean_text(F.col("t"))).collect():
        assert r["got"] == unicodedata.normalize("NFC", r["t"]).strip()


def test_clean_samples_and_empty(spark):
    df = spark.createDataFrame([(0, [("user", " e\u0301 "), ("assistant", "ok\x07")]), (1, [("user", "  "), ("assistant", "x")])], TURNS)
    done = clean.clean_samples(df, turns="conversations")
    assert [t["content"] for t in done.filter("id = 0").first()["conversations"]] == ["\u00e9", "ok"]
    assert [r["id"] for r in clean.drop_empty(done, turns="conversations").collect()] == [0]
    flat = spark.createDataFrame([("a", None), (" \x07 ", None)], "instruction string, input string")
    assert clean.drop_empty(flat, ["instruction"]).count() == 1
    assert clean.clean_samples(flat, ["instruction", "input"]).filter("input is null").count() == 2


def test_length_exact_and_report(spark):
    df = spark.createDataFrame([(0, "hello"), (1, "hello"), (2, "world is wide")], "id int, t string")
    assert [r["t"] for r in clean.filter_by_length(df, "t", 10, 100).collect()] == ["world is wide"]
    kept = clean.dedup_exact(df, "id", "t")
    assert sorted(r["id"] for r in kept.collect()) == [0, 2]
    assert tuple(clean.cleaning_report(df, df, kept).first()) == (3, 2, 0, 1)
    none = df.limit(0)
    assert tuple(clean.cleaning_report(none, none, none).first()) == (0, 0, 0, 0)


# ---- near duplicates


def shingle_set(text):
    t = text.split()
    return {tuple(t[i : i + 5]) for i in range(max(len(t) - 4, 1))} if t else set()


def greedy_drop(texts, threshold):
    kept, dropped, sets = [], set(), {k: shingle_set(t) for k, t in texts.items()}
    for k in sorted(texts):
        if any(len(sets[k] & sets[o]) >= threshold * len(sets[k] | sets[o]) for o in kept if sets[k]):
            dropped.add(k)
        else:
            kept.append(k)
    return dropped


def noisy_copies(seed, groups, copies, length, changes):
    rng = random.Random(seed)
    texts, key = {}, 0
    for _ in range(groups):
        base = [f"w{rng.randint(0, 5000)}" for _ in range(length)]
        for _ in range(copies):
            one = list(base)
            for _ in range(rng.randint(0, changes)):
                one[rng.randrange(length)] = f"x{rng.randint(0, 5000)}"
            texts[key] = " ".join(one)
            key += 1
    order = list(texts.values())
    rng.shuffle(order)
    return dict(enumerate(order))


@pytest.mark.parametrize("threshold, options", [(0.5, {}), (0.6, {"frequent_rows": 2, "small_total": 5}), (0.8, {"frequent_rows": 3}), (0.95, {"frequent_rows": 10**9})])
def test_near_duplicates_match_brute_force(spark, threshold, options):
    texts = noisy_copies(2, 12, 8, 60, 2)
    texts |= {len(texts) + k: t for k, t in enumerate(["", "one", "one", "two words", " ", texts[3]])}
    df = spark.createDataFrame(list(texts.items()), "id bigint, t string")
    got = [r["id"] for r in dedup.near_duplicates(df, "id", "t", threshold, **options).collect()]
    assert len(got) == len(set(got)) and set(got) == greedy_drop(texts, threshold)


def test_pairs_at_the_threshold_are_never_missed(spark):
    # 12 of 16 shingles in common, 14 in each set: similarity 0.75 exactly.
    texts = {}
    for i in range(400):
        words = [f"p{i}w{k}" for k in range(18)]
        texts[2 * i] = " ".join(words[:18])
        texts[2 * i + 1] = " ".join([*words[2:], f"p{i}x", f"p{i}y"])
    both, either = shingle_set(texts[0]) & shingle_set(texts[1]), shingle_set(texts[0]) | shingle_set(texts[1])
    assert 4 * len(both) == 3 * len(either)
    df = spark.createDataFrame(list(texts.items()), "id bigint, t string")
    assert {r["id"] for r in dedup.near_duplicates(df, "id", "t", 0.75).collect()} == set(range(1, 800, 2))


def test_shared_passage_does_not_make_copies(spark):
    # Half of every text is common: buckets are large, but no pair reaches the threshold.
    common = " ".join(f"c{i}" for i in range(40))
    texts = {i: common + " " + " ".join(f"u{i}_{j}" for j in range(40)) for i in range(120)}
    df = spark.createDataFrame(list(texts.items()), "id bigint, t string")
    got = dedup.near_duplicates(df, "id", "t", 0.5, frequent_rows=10)
    assert got.count() == 0


def test_sets_are_built_for_likely_pairs_only(spark, monkeypatch):
    # Every text shares 15 words with all others; only rows 0 and 500, and 1 and 501, are similar.
    common = " ".join(f"c{i}" for i in range(15))
    texts = {i: common + " " + " ".join(f"u{i}_{j}" for j in range(60)) for i in range(80)}
    texts |= {500: texts[0] + " more", 501: " ".join(f"u1_{j}" for j in range(60))}
    built, write = [], dedup.materialise

    def noted(df, label, **options):
        table = write(df, label, **options)
        if label == "near-sets":
            built.extend(r["id"] for r in table.select("id").collect())
        return table

    monkeypatch.setattr(dedup, "materialise", noted)
    df = spark.createDataFrame(list(texts.items()), "id bigint, t string")
    assert {r["id"] for r in dedup.near_duplicates(df, "id", "t", 0.5, frequent_rows=10**9).collect()} == {500, 501} == greedy_drop(texts, 0.5)
    assert {0, 1, 500, 501} <= set(built) and len(set(built)) <= 12


def test_parities_differ_in_no_more_bits_than_sets_in_elements(spark):
    from millrace.functions.kernels import _parities

    rng, rows = np.random.default_rng(3), []
    for k in range(200):
        left = rng.integers(0, 2**64, rng.integers(1, 400), dtype=np.uint64)
        right = np.concatenate([left[: rng.integers(0, len(left) + 1)], rng.integers(0, 2**64, rng.integers(1, 400), dtype=np.uint64)])
        short, long = sorted([np.unique(left), np.unique(right)], key=len)
        rows.append((len(np.setxor1d(short, long)), _parities(short).tolist(), _parities(long).tolist()))
    df = spark.createDataFrame(rows, "elements int, short array<long>, long array<long>")
    found = df.select("elements", F.size("long") / F.size("short"), dedup._differing(F.col("short"), F.col("long"))).collect()
    assert all(bits <= elements and (elements - bits) % 2 == 0 for elements, _, bits in found)
    assert max(folds for _, folds, _ in found) >= 4 and sum(bits for _, _, bits in found) > 0.4 * sum(elements for elements, _, _ in found)


def test_hot_group_of_copies(spark):
    texts = [(i, "the same words again and again " * 5 + (f"tail{i}" if i % 50 == 0 else "")) for i in range(600)]
    df = spark.createDataFrame(texts, "id bigint, t string")
    got = {r["id"] for r in dedup.near_duplicates(df, "id", "t", 0.8, small_total=10).collect()}
    assert got == greedy_drop(dict(texts), 0.8)


def test_buckets_of_the_same_rows_are_one(spark):
    # 40 texts without a first word, all of them copies of one: many shingles, one set of rows, one bucket.
    from millrace.functions.kernels import prefix_of

    words = [f"w{i}" for i in range(100)]
    texts = [(k, " ".join([f"own{k}", *words])) for k in range(40)] + [(99, "nothing in common with any other row")]
    df = spark.createDataFrame(texts, "id bigint, t string").select("id", F.xxhash64("id").alias("mark"), "t")
    none = spark.sparkContext.broadcast((np.zeros(0, np.int64), np.zeros(0, np.int64)))
    schema = "id bigint, mark long, n int, hi long, lo long, prefix array<long>"
    rows = df.mapInArrow(prefix_of(5, 0.5, none), schema)
    found = dedup._members(rows, "id").collect()
    assert {r["id"] for r in found} == set(range(40)) and len(found) < 40 * 10
    shared = next(iter({r["bucket"] for r in found}))
    assert sum(r["bucket"] == shared for r in found) > 1


def test_texts_travel_in_slices():
    from millrace.functions.exchange import sliced
    import pyarrow as pa

    texts = ["x" * 300] * 50 + [None, "y" * 5000] + ["z"] * 10
    parts = list(sliced(iter([pa.RecordBatch.from_pydict({"t": texts})]), 0, 1000))
    assert [t for p in parts for t in p.column(0).to_pylist()] == texts
    assert all(p.num_rows == 1 or sum(len(t or "") for t in p.column(0).to_pylist()) <= 1000 for p in parts)


def test_near_threshold_one_disables(spark):
    df = spark.createDataFrame([(0, "a b"), (1, "a b")], "id int, t string")
    assert dedup.dedup_near(df, "id", "t", 1.0).count() == 2
    assert dedup.dedup_near(df, "id", "t", 0.5).count() == 1


def test_near_dedup_is_idempotent_and_layout_independent(spark):
    texts = noisy_copies(7, 6, 6, 40, 3)
    df = spark.createDataFrame(list(texts.items()), "id bigint, t string")
    once = dedup.dedup_near(df, "id", "t", 0.5)
    ids = sorted(r["id"] for r in once.collect())
    assert sorted(r["id"] for r in dedup.dedup_near(once, "id", "t", 0.5).collect()) == ids
    assert sorted(r["id"] for r in dedup.dedup_near(df.repartition(16), "id", "t", 0.5).collect()) == ids


# ---- personal data

PII = {
    "Orders go to depot-7@mill.example, not to the shop.": "EMAIL_ADDRESS",
    "cc: weir.keeper@river.example": "EMAIL_ADDRESS",
    "写信给 lock@canal.example 即可": "EMAIL_ADDRESS",
    "Nice \U0001f33e harvest! (barn@field.example)": "EMAIL_ADDRESS",
    "Ring 555-010-4477 before noon.": "PHONE_NUMBER",
    "+1 (555) 010-4478": "PHONE_NUMBER",
    "Form 12 lists 078-05-1120 twice.": "US_SSN",
    "Paid with 5555 5555 5555 4444, signed.": "CREDIT_CARD",
    "Host 10.20.30.40 went silent.": "IP_ADDRESS",
    "Emma Millward ground the flour.": "PERSON",
    "Then George Weir closed the sluice.": "PERSON",
    "Ask Prof. Ida Lockhart's assistant.": "PERSON",
}


def entities(spark, texts, **options):
    df = spark.createDataFrame([(i, "output", t) for i, t in enumerate(texts)], "id int, field string, text string")
    return pii.pii_scan(df, "id", **options).collect()


def test_entities_found_with_spans(spark):
    texts = list(PII)
    found = entities(spark, texts)
    for i, t in enumerate(texts):
        assert PII[t] in {r["entity_type"] for r in found if r["id"] == i}, t
    for r in found:
        assert texts[r["id"]][r["start"] : r["end"]] == r["text_snippet"]


@pytest.mark.parametrize("text", ["Plants use sunlight.", "1234 5678 9012 3456", "999.999.1.1", "今天天气很好。", "a@b", "2024-01-02"])
def test_no_entities(spark, text):
    assert entities(spark, [text]) == []


def gazetteer(spark, more=()):
    """A hundred thousand made-up names, and some that the tests use."""
    own = ["Ada Lovelace", "Ada", "Grace Brewster Hopper", "Grace", "Jean-Luc  Picard", "Zoë Ångström", "Hopper", None, " ", *more]
    return spark.range(100_000).selectExpr("concat('Given', id % 400, 'a Sur', id)  as name").unionByName(spark.createDataFrame([(n,) for n in own], "name string"))


NAMED = {
    "Ada Lovelace wrote to Grace Brewster Hopper.": ["Ada Lovelace", "Grace Brewster Hopper"],
    "Grace Hopper met Ada.": ["Grace", "Hopper", "Ada"],
    "ada lovelace and Lovelace are no entries": [],
    "Captain Jean-Luc Picard's ship": ["Jean-Luc Picard"],
    "Zoë Ångström 😀 Zoë\nÅngström": ["Zoë Ångström", "Zoë\nÅngström"],
    "Ada, Grace; Brewster Hopper": ["Ada", "Grace", "Hopper"],
    "": [],
}


@pytest.mark.parametrize("broadcast", [True, False])
def test_names_of_a_table_are_found_longest_first(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(names_module, "BROADCAST_BYTES", 0)
    df = spark.createDataFrame([(i, "t", text) for i, text in enumerate(NAMED)] + [(99, "t", None)], "id int, field string, text string")
    found = names_module.person_spans(df, "id", gazetteer(spark)).orderBy("id", "start").collect()
    for i, (text, want) in enumerate(NAMED.items()):
        assert [r["text_snippet"] for r in found if r["id"] == i] == want
        assert all(text[r["start"] : r["end"]] == r["text_snippet"] for r in found if r["id"] == i)
    assert {r["entity_type"] for r in found} == {"PERSON"} and not [r for r in found if r["id"] == 99]


def test_names_in_scan_report_gate_and_redaction(spark):
    rows = [(0, "Ask Ada Lovelace.", "a@b.com"), (1, "Nobody here.", "nothing"), (2, None, "Hopper and Grace Hopper")]
    df = spark.createDataFrame(rows, "sample_id int, instruction string, output string")
    texts, table = pii.long_texts(df, "sample_id", ["instruction", "output"]), gazetteer(spark)
    scanned = pii.pii_scan(texts, "sample_id", persons=False, names=table)
    assert sorted((r["sample_id"], r["text_snippet"]) for r in scanned.collect()) == [(0, "Ada Lovelace"), (0, "a@b.com"), (2, "Grace"), (2, "Hopper"), (2, "Hopper")]
    assert tuple(pii.pii_report(texts, "sample_id", names=table).first()) == (2, 1)
    assert {r["sample_id"]: r["entities"] for r in pii.flag_samples(texts, "sample_id", names=table).collect()} == {0: 2, 1: 0, 2: 3}
    clean_rows = texts.filter("sample_id = 1")
    pii.pii_gate(clean_rows, names=table)
    with pytest.raises(pii.PersonalDataFound):
        pii.pii_gate(texts.filter("sample_id = 2"), names=table)
    masked = {r["sample_id"]: (r["instruction"], r["output"]) for r in pii.redact(df, "mask", ["instruction", "output"], names=table).collect()}
    assert masked == {0: ("Ask <PERSON>.", "<EMAIL_ADDRESS>"), 1: rows[1][1:], 2: (None, "<PERSON> and <PERSON> <PERSON>")}
    assert [r["sample_id"] for r in pii.redact(df, "remove", ["instruction", "output"], names=table).collect()] == [1]


def test_a_recogniser_joins_in(spark):
    @F.pandas_udf("array<struct<start int, end int, score double>>")
    def finder(text):
        import re

        return text.map(lambda t: [(m.start(), m.end(), 0.5) for m in re.finditer("the [a-z]+ lady", t or "")])

    df = spark.createDataFrame([(0, "t", "The tall one met the iron lady and Ada"), (1, "t", "x")], "id int, field string, text string")
    got = lambda **o: [r["text_snippet"] for r in pii.pii_scan(df, "id", persons=False, finder=finder, **o).orderBy("start").collect()]
    assert got() == ["the iron lady"] and got(names=gazetteer(spark)) == ["the iron lady", "Ada"]
    assert got(threshold=0.6) == []


def test_threshold_reports_and_gate(spark):
    assert entities(spark, ["My SSN is 219-09-9999."], threshold=0.99) == []
    df = spark.createDataFrame([(0, "Clean.", "No PII."), (1, "SSN.", "My SSN is 219-09-9999. a@b.com")], "id int, instruction string, output string")
    texts = pii.long_texts(df, "id", ["instruction", "output"])
    assert tuple(pii.pii_report(texts, "id").first()) == (1, 1)
    assert {r["entity_type"]: r["entities"] for r in pii.pii_by_type(texts, "id").collect()} == {"US_SSN": 1, "EMAIL_ADDRESS": 1}
    assert tuple(pii.pii_report(texts.limit(0), "id").first()) == (0, 0)
    with pytest.raises(pii.PersonalDataFound):
        pii.pii_gate(texts)
    pii.pii_gate(texts.filter("id = 0"))


def test_redaction_strategies(spark):
    df = spark.createDataFrame(
        [(0, "Contact alice@example.com please."), (1, "My SSN is 219-09-9999."), (2, "The sky is blue."), (3, "4111 1111 1111 1111, 1234 5678 9012 3456")],
        "id int, output string",
    )
    got = {r["id"]: r["output"] for r in pii.redact(df, "mask", ["output"]).collect()}
    assert got == {0: "Contact <EMAIL_ADDRESS> please.", 1: "My SSN is <US_SSN>.", 2: "The sky is blue.", 3: "<CREDIT_CARD>, 1234 5678 9012 3456"}
    assert got == {r["id"]: r["m"] for r in df.withColumn("m", pii.mask(F.col("output"))).collect()}
    assert [r["id"] for r in pii.redact(df, "remove", ["output"]).collect()] == [2]
    swapped = {r["id"]: r["output"] for r in pii.redact(df, "replace", ["output"]).collect()}
    assert "alice@" not in swapped[0] and "@example.com" in swapped[0] and swapped[2] == "The sky is blue."
    assert swapped == {r["id"]: r["output"] for r in pii.redact(df.repartition(3), "replace", ["output"]).collect()}


def test_redact_turns_and_word_filter(spark):
    df = spark.createDataFrame([(0, [("user", "My email is alice@test.com"), ("assistant", "Got it.")])], TURNS)
    said = pii.redact(df, "mask", turns="conversations").first()["conversations"]
    assert [t["content"] for t in said] == ["My email is <EMAIL_ADDRESS>", "Got it."]
    rows = spark.createDataFrame([(0, "you idiot"), (1, "idiotic of the"), (2, "mail a@b.com")], "id int, t string")
    assert [r["id"] for r in pii.word_filter(rows, "t", ["Idiot", "OF THE"]).collect()] == [2]
    assert pii.word_filter(rows, "t", [], ["EMAIL_ADDRESS"]).filter("id = 2").first()["t"] == "mail <EMAIL_ADDRESS>"
    assert pii.word_filter(rows, "t", [], ["EMAIL_ADDRESS"], "BLOCK").count() == 2


# ---- rendering and tokens


def rendered(spark, name, **columns):
    df = spark.createDataFrame([("Q", "A", "In", "Sys")], "instruction string, output string, input string, system_prompt string")
    return template.render_template(df, name, **columns).first()["rendered"]


def test_templates(spark):
    assert "### Input:\nIn\n" in rendered(spark, "alpaca", input_="input")
    assert "### Input:" not in rendered(spark, "alpaca")
    assert rendered(spark, "chatml") == "<|im_start|>user\nQ<|im_end|>\n<|im_start|>assistant\nA<|im_end|>"
    assert rendered(spark, "chatml", system="system_prompt").startswith("<|im_start|>system\nSys<|im_end|>\n<|im_start|>user")
    assert rendered(spark, "llama3").startswith("<|begin_of_text|><|start_header_id|>user")
    assert rendered(spark, "mistral", system="system_prompt") == "[INST] Sys\n\nQ [/INST] A</s>"
    for name in ("alpaca", "chatml", "llama3", "mistral"):
        assert template.response_marker(name) in rendered(spark, name)
    assert template.response_marker("custom") == ""
    with pytest.raises(FileNotFoundError, match="not found"):
        rendered(spark, "nothing")


def test_custom_template(spark):
    df = spark.createDataFrame([("What?", "This.")], "instruction string, output string")
    assert template.render_custom(df, "Task> {{ instruction }}\nResult> {{ output }}").first()["rendered"] == "Task> What?\nResult> This."
    for bad in ("{{ instruction.__class__ }}", "{{ missing }}", "{{ 1 + 1 }}"):
        with pytest.raises(ValueError):
            template.render_custom(df, bad)


def test_conversation_rendering(spark):
    df = spark.createDataFrame(
        [(0, [("system", "System instruction"), ("user", "Q1"), ("assistant", "A1"), ("user", "Q2"), ("assistant", "A2")]), (1, [])], TURNS
    )
    got = {r["id"]: r["rendered"] for r in template.render_conversation(df, "chatml").collect()}
    assert got[0].count("System instruction") == 1 and got[0].index("Q2") > got[0].index("A1") and got[1] == ""


def tokenised(spark, longest=512, **options):
    df = spark.createDataFrame([("What is two plus two?", "It is four.")], "instruction string, output string")
    done = template.render_template(df, "alpaca")
    return tokens.tokenize_with_labels(done, "rendered", "alpaca", longest, **options).first()


def test_labels(spark):
    row = tokenised(spark)
    assert len(row["input_ids"]) == len(row["labels"]) == len(row["attention_mask"])
    assert set(row["attention_mask"]) == {1} and row["labels"][0] == -100 and not row["was_truncated"]
    first = next(i for i, x in enumerate(row["labels"]) if x != -100)
    assert -100 not in row["labels"][first:] and row["labels"][first:] == row["input_ids"][first:]
    assert len(row["labels"][first:]) == 5  # It is four . EOS
    assert row["input_ids"][-1] == tokens.EOS_ID and tokenised(spark, add_eos=False)["input_ids"][-1] != tokens.EOS_ID
    short = tokenised(spark, 32)
    assert len(short["input_ids"]) == 32 and short["was_truncated"] and set(short["labels"]) == {-100}


def test_no_marker_means_no_labels_and_drop(spark):
    df = spark.createDataFrame([("plain text",)], "rendered string")
    done = tokens.tokenize_with_labels(df, "rendered", "custom", 64)
    assert set(done.first()["labels"]) == {-100}
    with pytest.raises(ValueError, match="No samples survived"):
        tokens.require_samples(tokens.drop_unlabeled(done))


@pytest.mark.parametrize("n", [3, 20, 100])
def test_splits(spark, n):
    df = spark.range(n)
    got = {r["split"]: r["n"] for r in tokens.split_dataset(df, "id").groupBy("split").agg(F.count("*").alias("n")).collect()}
    assert set(got) == {"train", "validation", "test"} and sum(got.values()) == n
    if n > 3:
        assert got["train"] > got["validation"] > 0
    a = {(r["id"], r["split"]) for r in tokens.split_dataset(df, "id", seed=1).collect()}
    assert a == {(r["id"], r["split"]) for r in tokens.split_dataset(df.repartition(9), "id", seed=1).collect()}
    in_order = tokens.split_dataset(df, "id", shuffle=False).collect()
    assert max(r["id"] for r in in_order if r["split"] == "train") < min(r["id"] for r in in_order if r["split"] != "train")


def test_token_statistics(spark):
    df = spark.createDataFrame([([-100] * p + [1] * r,) for p, r in [(1, 1), (2, 4), (3, 9)]], "labels array<int>")
    row = tokens.token_statistics(df).first()
    assert (row["total_samples"], row["avg_input_tokens"], row["max_output_tokens"], row["p50"]) == (3, 2.0, 9, 6.0)


def test_every_card_like_number_passes_the_pretest(spark):
    spaced = "card " + "-".join("4111111111111111") + " end"
    texts = spark.createDataFrame([(1, "f", spaced), (2, "f", None), (3, "f", "nothing")], "id long, field string, text string")
    assert [r["entity_type"] for r in pii.pii_scan(texts, "id", persons=False).collect()] == ["CREDIT_CARD"]
    assert texts.select(pii.mask(F.col("text")).alias("t")).first()["t"] == "card <CREDIT_CARD> end"
    report = pii.pii_report(texts, "id").first()
    assert (report["samples_with_pii"], report["samples_clean"]) == (1, 2)


@settings(max_examples=200, deadline=None)
@given(st.data())
def test_patterns_imply_their_pretests(data):
    import re

    from millrace.functions.fixed import PII_PATTERNS, PII_PRETESTS

    for kind, (pattern, _) in PII_PATTERNS.items():
        text = data.draw(st.from_regex(pattern))
        assert re.search(PII_PRETESTS[kind], text)


def test_rows_without_training_text_are_returned(spark):
    rows = spark.createDataFrame([("a", "b"), ("c", None)], "instruction string, output string")
    assert convert.to_training_text(rows).count() == 1
    assert [(r["instruction"], r["reason"]) for r in convert.training_text_rejects(rows).collect()] == [("c", "output is null")]
