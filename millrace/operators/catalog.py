"""Checksums, dataset versions and the dataset registry."""

from __future__ import annotations

import getpass
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F, types as T

FORMATS = ("instruction", "conversation", "completion")
STATISTICS = (
    "struct<total_samples:bigint,avg_input_tokens:double,avg_output_tokens:double,max_input_tokens:bigint,"
    "max_output_tokens:bigint,token_distribution_percentiles:map<string,double>>"
)
MANIFEST = (
    "name string, version string, format string, source_path string, num_samples bigint, sha256_checksum string, "
    f"created_at timestamp, statistics {STATISTICS}, message string"
)
LINEAGE = (
    "struct<source_uri:string,source_format:string,pipeline_config_hash:string,pipeline_version:string,"
    "transformations_applied:array<string>,parent_dataset_id:string,pii_scan_result:string,created_at:timestamp>"
)

_LANES = 8


def row_digest(columns: Sequence[str]) -> Column:
    values = [F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in columns]
    return F.sha2(F.concat_ws("\x1f", *values), 256)


def dataset_checksum(df: DataFrame, columns: Sequence[str], name: str = "", by: Sequence[str] = ()) -> DataFrame:
    """64 hex digits that depend on the name and the multiset of rows, not on their layout.

    Row digests are summed in eight 32-bit lanes, so the aggregate is partial on the map side
    and only the sums are shuffled, however many rows or copies there are.
    """
    digests = df.select(*by, row_digest(columns).alias("_d"))
    lane = lambda i: F.conv(F.substring("_d", 8 * i + 1, 8), 16, 10).cast("decimal(20,0)")
    sums = digests.groupBy(*by).agg(
        F.count(F.lit(1)).alias("num_samples"),
        *[F.coalesce(F.sum(lane(i)), F.lit(0)).cast("decimal(38,0)").alias(f"_l{i}") for i in range(_LANES)],
    )
    parts = [F.col(c).cast("string") for c in ["num_samples", *[f"_l{i}" for i in range(_LANES)]]]
    return sums.select(*by, "num_samples", F.sha2(F.concat_ws("|", F.lit(name), *parts), 256).alias("sha256_checksum"))


def _manifests(spark: SparkSession, store: str) -> DataFrame | None:
    path = f"{store}/manifests"
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not fs_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs_path):
        return None
    return spark.read.schema(MANIFEST).parquet(path)


def version_path(store: str, name: str, version: str) -> str:
    return f"{store}/{name}_v{version}"


def publish_version(
    df: DataFrame,
    store: str,
    name: str,
    version: str,
    fmt: str = "instruction",
    source_path: str = "",
    statistics: DataFrame | None = None,
    message: str = "",
) -> str:
    """Write the data, then append its manifest row; returns the checksum."""
    if fmt not in FORMATS:
        raise ValueError(f"Unsupported dataset format: {fmt}")
    path = version_path(store, name, version)
    df.write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    summary = dataset_checksum(stored, sorted(stored.columns), name)
    packed = F.lit(None)
    if statistics is not None:
        s = statistics.first()  # one row
        marks = F.create_map(*[F.lit(x) for k in ("p50", "p90", "p95", "p99") for x in (k, s[k])])
        names = ("total_samples", "avg_input_tokens", "avg_output_tokens", "max_input_tokens", "max_output_tokens")
        packed = F.struct(*[F.lit(s[n]).alias(n) for n in names], marks.alias("token_distribution_percentiles"))
    row = summary.select(
        F.lit(name).alias("name"), F.lit(version).alias("version"), F.lit(fmt).alias("format"),
        F.lit(source_path).alias("source_path"), "num_samples", "sha256_checksum",
        F.current_timestamp().alias("created_at"),
        packed.cast(STATISTICS).alias("statistics"), F.lit(message).alias("message"),
    )
    row.coalesce(1).write.mode("append").parquet(f"{store}/manifests")
    return _manifests(df.sparkSession, store).filter((F.col("name") == name) & (F.col("version") == version)).first()[
        "sha256_checksum"
    ]


def list_versions(manifests: DataFrame, name: str, semantic: bool = False) -> DataFrame:
    """Versions of one dataset in file-name order (10.0.0 before 2.0.0), or by number."""
    rows = manifests.filter(F.col("name") == name)
    if semantic:
        return rows.orderBy(F.transform(F.split("version", r"\."), lambda p: p.try_cast("bigint")))
    return rows.orderBy("version")


def diff_versions(manifests: DataFrame, name: str, old: str, new: str) -> DataFrame:
    """Samples added and removed by the row counts of two manifests, with both statistics."""
    found = [r[0] for r in manifests.filter((F.col("name") == name) & F.col("version").isin(old, new)).select("version").distinct().collect()]
    for version in (old, new):
        if version not in found:
            raise ValueError(f"Manifest not found: {name}_v{version}")
    return diff_by_count(manifests.filter(F.col("name") == name), old, new)


def diff_by_count(manifests: DataFrame, old: str, new: str) -> DataFrame:
    """The same for every name that has both versions."""
    stats = ["statistics"] if "statistics" in manifests.columns else []
    a = manifests.filter(F.col("version") == old).select(
        "name", F.col("version").alias("version_old"), F.col("num_samples").alias("samples_old"), *[F.col(s).alias("stats_old") for s in stats]
    )
    b = manifests.filter(F.col("version") == new).select(
        "name", F.col("version").alias("version_new"), F.col("num_samples").alias("samples_new"), *[F.col(s).alias("stats_new") for s in stats]
    )
    zero = F.lit(0).cast("bigint")
    return a.join(b, "name").select(
        "name", "version_old", "version_new",
        F.greatest(F.col("samples_new") - F.col("samples_old"), zero).alias("samples_added"),
        F.greatest(F.col("samples_old") - F.col("samples_new"), zero).alias("samples_removed"),
        *[c for c in ("stats_old", "stats_new") if stats],
    )


def diff_content(old: DataFrame, new: DataFrame) -> DataFrame:
    """Distinct rows that one version has more copies of, with ``change`` and ``copies``.

    Copies are netted by map-side sums and stay a number, so a hot row is one row here.
    """
    both = new.withColumn("_n", F.lit(1).cast("bigint")).unionByName(old.withColumn("_n", F.lit(-1).cast("bigint")))
    net = both.groupBy(*new.columns).agg(F.sum("_n").alias("_n")).filter(F.col("_n") != 0)
    change = F.when(F.col("_n") > 0, "added").otherwise("removed")
    return net.select(*new.columns, change.alias("change"), F.abs("_n").alias("copies"))


def find_version(spark: SparkSession, store: str, name: str, version: str) -> Row | None:
    """The latest manifest row of a version."""
    manifests = _manifests(spark, store)
    return None if manifests is None else manifests.filter(
        (F.col("name") == name) & (F.col("version") == version)
    ).orderBy(F.desc("created_at")).first()


def checkout_version(spark: SparkSession, store: str, name: str, version: str) -> str:
    """Path of a stored version after its checksum has been recomputed and compared."""
    row = find_version(spark, store, name, version)
    if row is None:
        raise FileNotFoundError(f"Manifest not found: {name}_v{version}")
    path = version_path(store, name, version)
    stored = spark.read.parquet(path)
    found = dataset_checksum(stored, sorted(stored.columns), name).first()["sha256_checksum"]
    if found != row["sha256_checksum"]:
        raise ValueError(f"Checksum mismatch for {name}_v{version}")
    return path


def register_dataset(manifest: DataFrame, lineage: Column, registry: str, registered_by: str | None = None) -> str:
    """Append one registry row for a one-row manifest; earlier rows stay.  Returns the new id."""
    spark = manifest.sparkSession
    dataset_id = spark.range(1).select(F.uuid()).first()[0]
    columns = manifest.columns
    row = manifest.select(
        F.lit(dataset_id).alias("dataset_id"),
        F.struct(*columns).alias("manifest"),
        lineage.cast(LINEAGE).alias("lineage"),
        F.concat("source_path", F.lit("/train")).alias("train_path"),
        F.concat("source_path", F.lit("/validation")).alias("validation_path"),
        F.current_timestamp().alias("registered_at"),
        F.lit(registered_by or getpass.getuser()).alias("registered_by"),
    )
    row.write.mode("append").parquet(registry)
    return dataset_id


def lineage_of(
    source_uri: str, source_format: str, config_hash: str, version: str, transformations: Sequence[str],
    parent: str | None = None, pii_scan_result: str = "not_scanned",
) -> Column:
    return F.struct(
        F.lit(source_uri).alias("source_uri"), F.lit(source_format).alias("source_format"),
        F.lit(config_hash).alias("pipeline_config_hash"), F.lit(version).alias("pipeline_version"),
        F.array(*[F.lit(t) for t in transformations]).cast("array<string>").alias("transformations_applied"),
        F.lit(parent).cast("string").alias("parent_dataset_id"), F.lit(pii_scan_result).alias("pii_scan_result"),
        F.current_timestamp().alias("created_at"),
    )


def get_dataset(registry: DataFrame, dataset_id: str) -> DataFrame:
    found = registry.filter(F.col("dataset_id") == dataset_id)
    if found.isEmpty():
        raise KeyError(f"Dataset not found: {dataset_id}")
    return found


def _resolve(schema: T.StructType, path: str) -> Column:
    """The column at a dotted path, a null literal if there is none."""
    kind: T.DataType = schema
    for part in path.split("."):
        if not isinstance(kind, T.StructType) or part not in kind.names:
            return F.lit(None)
        kind = kind[part].dataType
    return F.col(path)


def search_datasets(registry: DataFrame, filters: dict[str, object]) -> DataFrame:
    """Rows equal on every dotted path; no filters give all rows, null matches an absent path."""
    for path, wanted in filters.items():
        registry = registry.filter(_resolve(registry.schema, path).eqNullSafe(F.lit(wanted)))
    return registry


def get_lineage(registry: DataFrame, dataset_id: str) -> DataFrame:
    return get_dataset(registry, dataset_id).select("dataset_id", "lineage.*")
