"""Training-corpus pipeline: documents through toxicity, near duplicates, decontamination, mixing and sharding.

Each stage is written as Parquet and read again before the next one.  All stages but the last
return the columns of documents; the last adds the shard.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm import decontaminate, jaccard, kdtree, mixing, toxicity
from millrace.llm.common import crc_bucket, documents, fresh, materialise, table, temporary

SHARDS = 16


def toxic_documents_go(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the conditional random field scores at 0.5 or more."""
    chain = toxicity.train(docs.filter(crc_bucket("doc_id", 5) != 0), table(spark, sf_dir, "labels"))
    score = fresh("score", docs.columns)
    return toxicity.tag(docs, chain, score, None).filter(F.col(score) < 0.5).drop(score)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group linked by five-word shingles at a Jaccard similarity of 0.8."""
    return jaccard.one_of_each(docs, width=5, similarity=80)


def contaminated_documents_go(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of which benchmark windows hit at least a twentieth of the words."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the schedule of weighted sources opens them."""
    return mixing.mixed_documents(docs)


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their shard among SHARDS of near-equal bytes; equal texts share a shard."""
    point = kdtree.text_point("text")
    points = materialise(kdtree.groups(docs.select(*[c.alias(n) for n, c in point.items()])), "shard-points")
    tree = kdtree.fit_tree(points, kdtree.TEXT_DIMS, shards=SHARDS)
    return docs.withColumn(fresh("shard", docs.columns), tree.shard({d: point[d] for d in kdtree.TEXT_DIMS}, point["key"]))


STAGES = [
    ("toxicity", toxic_documents_go),
    ("near_duplicates", one_of_each_group),
    ("decontamination", contaminated_documents_go),
    ("mixing", mix_sources),
    ("sharding", assign_shards),
]

# Two stages (a trained classifier, links across shingle sets) have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    with temporary(spark):
        for name, stage in STAGES:
            docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}", outlives=name == STAGES[-1][0])
    return docs
