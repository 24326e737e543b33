"""The registered queries and, where SQL can say it, the same result as SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.sources.readers import spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


# Tables whose rows are long enough to make a single input task slow.
_TEXT_TABLES = ("documents", "conversations")


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{table}.parquet")) if table in _TEXT_TABLES else spark.read.parquet(f"{sf_dir}/{table}.parquet")


def toks(text: str) -> str:
    """SQL for whitespace tokens."""
    return f"list_filter(string_split_regex({text}, '\\s+'), lambda t: t <> '')"


def hash_order(seed: int, key: str) -> str:
    """SQL for the seeded order key."""
    return f"md5('{seed}|' || {key})"


# User turns with the assistant turn that answers them.
TURN_PAIRS_SQL = """
    select a.conv_id * 100 + a.turn as pair_id, a.text as prediction, b.text as reference
    from conversations a join conversations b on a.conv_id = b.conv_id and b.turn = a.turn + 1
    where a.role = 'user' and b.role = 'assistant'"""

# Documents against themselves without the word " the "; only labelled ones have a reference.
DOC_PAIRS_SQL = """
    select d.doc_id, d.lang, d.source, d.text as prediction,
           case when l.doc_id is not null then replace(d.text, ' the ', ' ') end as reference
    from documents d left join labels l on d.doc_id = l.doc_id"""


def turn_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    turns = load(spark, sf_dir, "conversations")
    asked = turns.filter("role = 'user'").select("conv_id", "turn", F.col("text").alias("prediction"))
    answered = turns.filter("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("reference"))
    return asked.join(answered, ["conv_id", "turn"]).select(
        (F.col("conv_id") * 100 + F.col("turn")).alias("pair_id"), "prediction", "reference"
    )


def doc_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from millrace.operators.metrics import pair_up

    docs = load(spark, sf_dir, "documents")
    references = docs.join(load(spark, sf_dir, "labels"), "doc_id", "left_semi").select(
        "doc_id", F.replace("text", F.lit(" the "), F.lit(" ")).alias("reference")
    )
    return pair_up(docs.select("doc_id", "lang", "source", F.col("text").alias("prediction")), references, "doc_id")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, so that summation order cannot show."""
    from pyspark.sql import functions as F

    return df.select(
        *[F.round(f.name, digits).alias(f.name) if f.dataType.typeName() == "double" else F.col(f.name) for f in df.schema.fields]
    )
