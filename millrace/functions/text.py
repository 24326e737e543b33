"""Column expressions over text: tokens, n-grams, normal forms."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from millrace.functions.fixed import WHITESPACE


def tokens(text: Column) -> Column:
    """Whitespace tokens; empty and null texts give an empty array."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WHITESPACE), "")


def strip(text: Column) -> Column:
    """Remove white space of any kind from both ends."""
    return F.regexp_replace(text, f"^{WHITESPACE}|{WHITESPACE}$", "")


def ngrams(toks: Column, n: int) -> Column:
    """Array of structs (w1..wn), one per n-gram; empty for texts shorter than n."""
    length = F.greatest(F.size(toks) - (n - 1), F.lit(0))
    return F.arrays_zip(*[F.slice(toks, k + 1, length).alias(f"w{k + 1}") for k in range(n)])


def normalised_answer(text: Column) -> Column:
    """Lower case, articles a/an/the removed, white space collapsed; punctuation stays."""
    bare = F.regexp_replace(F.lower(text), r"(?U)\b(a|an|the)\b", " ")
    return F.array_join(tokens(bare), " ")


def word_share(part: Column, whole: Column) -> Column:
    """part / whole, 0 where whole is 0."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def rouge_text(text: Column) -> Column:
    """Lower-cased text with everything but a-z and 0-9 turned into single spaces."""
    return F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "))


def rouge_lines(text: Column) -> Column:
    """``rouge_text`` of every line that has words, one a line."""
    lines = F.transform(F.split(text, "\n"), rouge_text)
    return F.array_join(F.array_remove(lines, ""), "\n")


def bleu_text(text: Column) -> Column:
    """The mteval 13a word split, as space separated text."""
    out = F.regexp_replace(text, "-\n", "")
    out = F.regexp_replace(out, "\n", " ")
    for entity, char in (("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
        out = F.replace(out, F.lit(entity), F.lit(char))
    out = F.concat(F.lit(" "), out, F.lit(" "))
    out = F.regexp_replace(out, r"([\{-~\[-` -&\(-\+:-@/])", " $1 ")
    out = F.regexp_replace(out, r"([^0-9])([.,])", "$1 $2 ")
    out = F.regexp_replace(out, r"([.,])([^0-9])", " $1 $2")
    return F.regexp_replace(out, r"([0-9])(-)", "$1 $2 ")
