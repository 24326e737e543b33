"""Writing splits, manifests and result documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.operators.catalog import dataset_checksum


def write_splits(df: DataFrame, path: str, name: str = "dataset", split: str = "split", fmt: str = "json") -> DataFrame:
    """Write <path>/split=<name> folders and a one-row manifest; returns the manifest."""
    df.write.partitionBy(split).format(fmt).save(f"{path}/data")
    summary = dataset_checksum(df, sorted(df.columns), name)
    counts = df.groupBy(split).agg(F.count(F.lit(1)).alias("n"))
    sizes = [F.lit(x) for r in counts.collect() for x in (r[split], r["n"])]  # one row per split name
    splits = F.create_map(*sizes) if sizes else F.create_map().cast("map<string,bigint>")
    manifest = summary.select("*", splits.alias("splits"), F.lit(name).alias("name"))
    manifest.coalesce(1).write.mode("overwrite").json(f"{path}/manifest")
    return df.sparkSession.read.json(f"{path}/manifest")


def write_results_json(metrics: DataFrame, path: str, metadata: dict[str, str] | None = None) -> None:
    """Long metric rows as JSON lines, each with the time of the run and its metadata."""
    extra = [x for k, v in (metadata or {}).items() for x in (F.lit(k), F.lit(str(v)))]
    packed = F.create_map(*extra) if extra else F.create_map().cast("map<string,string>")
    metrics.select(
        F.current_timestamp().alias("timestamp"), packed.alias("metadata"), F.struct(*metrics.columns).alias("results")
    ).write.mode("overwrite").json(path)
