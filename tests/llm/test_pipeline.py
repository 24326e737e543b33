"""The pipeline: stages in a row, odd rows, and every query with and without SQL."""

from collections import Counter

import corpus_pipeline
from millrace.llm import decontaminate, jaccard, workload
from millrace.llm.common import materialise


def tables(spark, tmp_path, documents):
    folder = str(tmp_path)
    documents.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, " ".join(f"long{i}" for i in range(100, 300)))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([(1, 0, 0), (8, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def test_stages_keep_the_columns(spark, tmp_path, odd_documents):
    folder = tables(spark, tmp_path, odd_documents)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "mixing", "sharding"]
    counts = []
    for name, stage in corpus_pipeline.STAGES:
        out = materialise(stage(spark, docs, folder), name)
        if name != "sharding":
            assert out.dtypes == docs.dtypes
        counts.append(out.count())
        docs = out
    assert counts[:3] == [13, 10, 9]
    assert docs.columns == [*odd_documents.columns, "_shard"]


def test_stages_of_an_empty_table(spark, tmp_path, odd_documents):
    folder = tables(spark, tmp_path, odd_documents.limit(0))
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, folder), name)
        assert docs.count() == 0


def test_run_equals_its_parts(spark):
    folder = "/root/testdata/sf0.001"
    found = corpus_pipeline.run(spark, folder).collect()
    docs = materialise(corpus_pipeline.toxic_documents_go(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder), "t")
    rows = jaccard.near_duplicates(docs, 5, 80).collect()
    firsts = {r["doc_id"] for r in rows if r["doc_id"] == r["component_id"]}
    found_clean = decontaminate.find_occurrences(docs, spark.read.parquet(f"{folder}/benchmark.parquet"))
    clean = {r["doc_id"] for r in found_clean.filter(~decontaminate.is_contaminated("found")).collect()}
    assert {r["doc_id"] for r in found} <= firsts & clean
    assert max(Counter(r["doc_id"] for r in found).values()) <= 2
    assert {r["shard"] for r in found} == set(range(16))


def test_queries_are_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in workload.QUERIES)
    assert numbers == list(range(1, 14))
