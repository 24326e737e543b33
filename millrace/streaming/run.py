"""Starting streaming queries."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from millrace.plans.durable import new_path


PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB, as timers and typed state need."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before) if before else spark.conf.unset(PROVIDER)


def drain_to_table(stream: DataFrame, label: str) -> DataFrame:
    """Process everything available now into a parquet table and return it as a batch table."""
    spark = stream.sparkSession
    out, state = new_path(spark, label), new_path(spark, f"{label}-state")
    with rocksdb_state(spark):
        query = (
            stream.writeStream.format("parquet")
            .option("path", out)
            .option("checkpointLocation", state)
            .outputMode("append")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)
