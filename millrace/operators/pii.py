"""Personal data: entity spans, reports, redaction, blocked words."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.fixed import GIVEN_NAMES, NAME_TITLES, PERSON_SCORE, PII_PATTERNS, PII_PRETESTS
from millrace.functions.kernels import find_entities
from millrace.functions.text import tokens
from millrace.operators.names import mask_spans, person_spans
from millrace.plans.durable import materialise
from millrace.plans.skew import null_safe_join


def person_pattern(given_names: Sequence[str] = GIVEN_NAMES) -> str:
    """Title or listed given name followed by one or two capitalised words.

    A short list cannot match a language model: names outside it and without a title are missed.
    ``names`` and ``finder`` of the functions below take a table of any length or a recogniser.
    """
    titles = "|".join(NAME_TITLES)
    names = "|".join(given_names)
    word = "[A-Z][a-z]+"
    listed = rf"|(?:{names}) {word}" if names else ""
    return rf"\b(?:(?:{titles})\.? {word}(?: {word})?{listed})\b"


def _patterns(threshold: float, persons: bool, given_names: Sequence[str]) -> dict[str, tuple[str, float]]:
    known = dict(PII_PATTERNS)
    if persons:
        known["PERSON"] = (person_pattern(given_names), PERSON_SCORE)
    return {kind: (pattern, score) for kind, (pattern, score) in known.items() if score >= threshold}


def _worth_trying(text: Column, kind: str) -> Column:
    return text.rlike(PII_PRETESTS[kind]) if kind in PII_PRETESTS else F.lit(True)


def is_card(number: Column) -> Column:
    return F.call_function("luhn_check", F.regexp_replace(number, "[ -]", ""))


def long_texts(df: DataFrame, key: str, fields: Sequence[str] = (), turns: str | None = None) -> DataFrame:
    """(key, field, text) rows of the named columns and of every turn; a null text is a row too.

    A row without fields and turns gives one row with null field and text, so no sample is lost.
    """
    parts = [F.struct(F.lit(f).alias("field"), F.col(f).alias("text")) for f in fields]
    items = F.array(*parts) if parts else F.array().cast("array<struct<field:string,text:string>>")
    if turns is not None:
        said = F.transform(
            turns, lambda t, i: F.struct(F.concat(F.lit("turn_"), i.cast("string")).alias("field"), t["content"].alias("text"))
        )
        items = F.concat(items, F.coalesce(said, F.array().cast("array<struct<field:string,text:string>>")))
    return df.select(key, F.explode_outer(items).alias("x")).select(key, "x.field", "x.text")


def pii_scan(
    texts: DataFrame,
    key: str,
    threshold: float = 0.0,
    persons: bool = True,
    given_names: Sequence[str] = GIVEN_NAMES,
    names: DataFrame | None = None,
    finder: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Entity rows (key, field, entity_type, start, end, score, text_snippet) of (key, field, text).

    Texts that match no pattern are dropped on the JVM; only the rest go to Python for offsets.
    Card numbers must pass the Luhn check.  With a table of ``names`` or a ``finder`` (see
    ``names.person_spans``) persons come from these and from the pattern; one span is told once.
    """
    patterns = _patterns(threshold, persons, given_names)
    text = F.col("text")
    hit = F.lit(False)
    for kind, (pattern, _) in patterns.items():
        hit = hit | (_worth_trying(text, kind) & text.rlike(pattern))
    found = texts.filter(hit).select(key, "field", F.explode(find_entities(patterns)(text)).alias("e")).select(key, "field", "e.*")
    found = found.filter((F.col("entity_type") != "CREDIT_CARD") | is_card(F.col("text_snippet")))
    if not _by_table(names, finder) or threshold > PERSON_SCORE:
        return found
    listed = person_spans(texts, key, names, finder).filter(F.col("score") >= threshold)
    return found.unionByName(listed).dropDuplicates([key, "field", "entity_type", "start", "end"])


def _by_table(names: DataFrame | None, finder) -> bool:
    return names is not None or finder is not None


def entity_counts(text: Column, threshold: float = 0.0, persons: bool = False, given_names: Sequence[str] = GIVEN_NAMES) -> dict[str, Column]:
    """Matches per entity type as column expressions, without spans and without Python."""
    out = {}
    for kind, (pattern, _) in _patterns(threshold, persons, given_names).items():
        every = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        if kind == "CREDIT_CARD":
            every = F.filter(every, is_card)
        out[kind] = F.when(_worth_trying(text, kind), F.size(every)).otherwise(0)
    return out


def pii_by_type(texts: DataFrame, key: str, threshold: float = 0.0, persons: bool = False) -> DataFrame:
    """(entity_type, entities, samples) over (key, field, text) rows."""
    counts = entity_counts(F.col("text"), threshold, persons)
    per_row = texts.select(key, F.explode(F.filter(F.array(*[F.struct(F.lit(k).alias("entity_type"), c.alias("n")) for k, c in counts.items()]), lambda x: x["n"] > 0)).alias("x"))
    per_sample = per_row.groupBy(key, "x.entity_type").agg(F.sum("x.n").alias("n"))
    return per_sample.groupBy("entity_type").agg(F.sum("n").alias("entities"), F.count(F.lit(1)).alias("samples"))


def flag_samples(
    texts: DataFrame, key: str, threshold: float = 0.0, persons: bool = False,
    names: DataFrame | None = None, finder: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """(key, entities): every sample with its number of entities."""
    counts = entity_counts(F.col("text"), threshold, persons)
    rows = texts.select(key, sum(counts.values(), F.lit(0)).alias("_n"))
    if _by_table(names, finder) and threshold <= PERSON_SCORE:
        listed = person_spans(texts, key, names, finder).filter(F.col("score") >= threshold)
        rows = rows.unionByName(listed.select(key, F.lit(1).alias("_n")))
    return rows.groupBy(key).agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("entities"))


def pii_report(
    texts: DataFrame, key: str, threshold: float = 0.0, persons: bool = False,
    names: DataFrame | None = None, finder: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """samples_with_pii and samples_clean; the flagged ids are ``flag_samples`` with entities > 0."""
    flagged = flag_samples(texts, key, threshold, persons, names, finder)
    return flagged.agg(
        F.count_if(F.col("entities") > 0).alias("samples_with_pii"),
        F.count_if(F.col("entities") == 0).alias("samples_clean"),
    )


def _rewrite(text: Column, pattern: str, new: Callable[[Column], Column], cards: bool) -> Column:
    """Replace each match by new(match); with ``cards`` only where the Luhn check holds.

    The text is split at the matches and zipped back together: linear, and on the JVM.
    """
    pieces = F.split(text, pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def put(piece: Column, match: Column) -> Column:
        filled = F.when(is_card(match), new(match)).otherwise(match) if cards else new(match)
        return F.concat(piece, F.coalesce(filled, F.lit("")))

    return F.array_join(F.zip_with(pieces, matches, put), "")


def _tag(kind: str) -> Callable[[Column], Column]:
    return lambda match: F.when(match.isNotNull(), F.lit(f"<{kind}>"))


def mask(text: Column, persons: bool = False, given_names: Sequence[str] = GIVEN_NAMES) -> Column:
    """Each entity becomes <TYPE>, in the order email, SSN, card, phone, IP (, person)."""
    masked = text
    for kind, (pattern, _) in _patterns(0.0, persons, given_names).items():
        if kind == "CREDIT_CARD":
            masked = _rewrite(masked, pattern, _tag(kind), cards=True)
        else:
            masked = F.regexp_replace(masked, pattern, f"<{kind}>")
    # One cheap pass spares most texts the patterns.
    return masked if persons else F.when(text.rlike("|".join(PII_PRETESTS.values())), masked).otherwise(text)


def synthetic(kind: str, value: Column, seed: int) -> Column:
    """A made-up value of the same kind, the same for the same original and seed."""
    h = F.md5(F.concat(F.lit(f"{seed}|{kind}|"), value))
    digits = lambda start, n: F.lpad((F.conv(F.substring(h, start, 8), 16, 10).cast("bigint") % 10**n).cast("string"), n, "0")
    octet = lambda start: (F.conv(F.substring(h, start, 2), 16, 10).cast("int") % 254 + 1).cast("string")
    if kind == "EMAIL_ADDRESS":
        return F.concat(F.lit("user"), F.substring(h, 1, 10), F.lit("@example.com"))
    if kind == "US_SSN":
        return F.concat(F.lit("900-"), digits(1, 2), F.lit("-"), digits(9, 4))
    if kind == "CREDIT_CARD":
        return F.concat(F.lit("0000 0000 "), digits(1, 4), F.lit(" "), digits(9, 4))
    if kind == "PHONE_NUMBER":
        return F.concat(F.lit("555-01"), digits(1, 1), F.lit("-"), digits(9, 4))
    if kind == "IP_ADDRESS":
        return F.concat_ws(".", F.lit("10"), octet(1), octet(3), octet(5))
    return F.concat(F.lit("Person "), F.substring(h, 1, 8))


def _rewrite_columns(
    df: DataFrame,
    fields: Sequence[str],
    turns: str | None,
    patterns: dict[str, tuple[str, float]],
    new: Callable[[str], Callable[[Column], Column]],
) -> DataFrame:
    """Rewrite one entity type after the other; separate projections keep the expressions small."""
    for kind, (pattern, _) in patterns.items():

        def step(text: Column, kind: str = kind, pattern: str = pattern) -> Column:
            done = _rewrite(text, pattern, new(kind), cards=kind == "CREDIT_CARD")
            return F.when(_worth_trying(text, kind) & text.rlike(pattern), done).otherwise(text)

        changed = {f: step(F.col(f)) for f in fields}
        if turns is not None:
            changed[turns] = F.transform(
                turns, lambda t: F.struct(t["role"].alias("role"), step(t["content"]).alias("content"))
            )
        df = df.withColumns(changed)
    return df


def redact(
    df: DataFrame,
    strategy: str,
    fields: Sequence[str] = (),
    turns: str | None = None,
    seed: int = 42,
    persons: bool = False,
    given_names: Sequence[str] = GIVEN_NAMES,
    names: DataFrame | None = None,
    finder: Callable[[Column], Column] | None = None,
    key: str = "sample_id",
) -> DataFrame:
    """mask or replace the entities of every field and turn, or remove the rows that have any.

    Replacements are synthetic values; equal originals get equal replacements.  Persons of the
    fields found by ``names`` or ``finder`` are masked by span before the patterns run (``replace``
    masks them too), which needs the unique column ``key``.
    """
    if _by_table(names, finder):
        spans = person_spans(long_texts(df, key, fields), key, names, finder)
        if strategy == "remove":
            df = null_safe_join(df, spans.select(key).distinct(), [key], "left_anti")
        else:
            df = mask_spans(df, key, fields, materialise(spans, "person-spans"))
    patterns = _patterns(0.0, persons, given_names)
    if strategy == "mask":
        return _rewrite_columns(df, fields, turns, patterns, _tag)
    if strategy == "replace":
        return _rewrite_columns(df, fields, turns, patterns, lambda kind: lambda m: synthetic(kind, m, seed))
    if strategy != "remove":
        raise ValueError(f"Unknown redaction strategy: {strategy}")
    texts = [F.coalesce(F.col(f), F.lit("")) for f in fields]
    if turns is not None:
        texts.append(F.array_join(F.transform(turns, lambda t: F.coalesce(t["content"], F.lit(""))), "\n"))
    counts = [n for text in texts for n in entity_counts(text, 0.0, persons, given_names).values()]
    return df.filter(sum(counts, F.lit(0)) == 0)


class PersonalDataFound(Exception):
    """Raised by ``pii_gate``."""


def pii_gate(
    texts: DataFrame, threshold: float = 0.0, persons: bool = False,
    names: DataFrame | None = None, finder: Callable[[Column], Column] | None = None,
) -> None:
    """Fail if any text holds personal data; stops at the first hit.

    With ``names`` or ``finder`` the texts need their key ``sample_id`` and ``field`` too.
    """
    total = sum(entity_counts(F.col("text"), threshold, persons).values(), F.lit(0))
    found = not texts.filter(total > 0).isEmpty()
    if not found and _by_table(names, finder) and threshold <= PERSON_SCORE:
        found = not person_spans(texts, "sample_id", names, finder).filter(F.col("score") >= threshold).isEmpty()
    if found:
        raise PersonalDataFound("personal data found; no output was written")


def blocked(text: Column, words: Sequence[str]) -> Column:
    """Whether any blocked word (as a token) or phrase (anywhere) occurs, without regard to case."""
    single = [w.lower() for w in words if " " not in w]
    phrases = [w.lower() for w in words if " " in w]
    test = F.lit(False)
    if single:
        test = test | F.arrays_overlap(tokens(F.lower(text)), F.array(*[F.lit(w) for w in single]))
    for phrase in phrases:
        test = test | F.contains(F.lower(text), F.lit(phrase))
    return F.coalesce(test, F.lit(False))


def word_filter(
    df: DataFrame, text: str, words: Sequence[str] = (), pii_types: Sequence[str] = (), pii_action: str = "ANONYMIZE"
) -> DataFrame:
    """Drop rows with blocked words; mask the listed entity types, or drop rows that have them."""
    out = df.filter(~blocked(F.col(text), words)) if words else df
    if not pii_types:
        return out
    if pii_action == "BLOCK":
        counts = entity_counts(F.col(text), persons="PERSON" in pii_types)
        return out.filter(sum((counts[k] for k in pii_types), F.lit(0)) == 0)
    known = _patterns(0.0, "PERSON" in pii_types, GIVEN_NAMES)
    return _rewrite_columns(out, [text], None, {k: known[k] for k in known if k in pii_types}, _tag)
