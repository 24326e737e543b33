"""Reading corpora, splits and evaluation sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

_EXTENSIONS = {".jsonl": "jsonl", ".json": "jsonl", ".parquet": "parquet", ".csv": "csv"}


def detect_format(path: str, fmt: str | None = None) -> str:
    """Format by explicit name or file extension of a local or object-store path."""
    if fmt is not None:
        if fmt not in ("jsonl", "parquet", "csv"):
            raise ValueError(f"Unsupported format: {fmt}")
        return fmt
    name = path.rstrip("/").lower()
    for extension, found in _EXTENSIONS.items():
        if name.endswith(extension):
            return found
    raise ValueError(f"Cannot detect format: {path}")


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """One row per line that holds a JSON object; blank, broken and other lines are skipped.

    With a schema the rows are typed columns, else one VARIANT column ``row``.
    """
    lines = spark.read.text(path)
    row = F.try_parse_json(F.col("value"))
    objects = lines.select(row.alias("row"), "value").filter(F.schema_of_variant("row").startswith("OBJECT"))
    if schema is None:
        return objects.select("row")
    return objects.select(F.from_json("value", schema).alias("r")).select("r.*")


def infer_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Typed rows of a JSONL file, its schema taken from the object lines in one extra pass."""
    objects = read_jsonl(spark, path)
    kind = objects.agg(F.schema_of_variant_agg("row")).first()[0]
    if kind in (None, "VOID"):
        return spark.createDataFrame([], T.StructType([]))
    return objects.select(F.variant_get("row", "$", _row_type(kind)).alias("r")).select("r.*")


def _row_type(kind: str) -> str:
    """The inferred variant type as a row type: objects as structs, values never seen as text."""

    def read(at: int) -> tuple[str, int]:
        if kind.startswith("OBJECT<", at):
            fields, at = [], at + len("OBJECT<")
            while kind[at] != ">":
                if kind[at] == "`":
                    end = at + 1
                    while kind[end] != "`" or kind.startswith("``", end):
                        end += 2 if kind[end] == "`" else 1
                    name, at = kind[at : end + 1], end + 1
                else:
                    end = kind.index(":", at)
                    name, at = f"`{kind[at:end]}`", end
                inner, at = read(at + len(": "))
                fields.append(f"{name}: {inner}")
                at += 2 if kind.startswith(", ", at) else 0
            return f"STRUCT<{', '.join(fields)}>", at + 1
        if kind.startswith("ARRAY<", at):
            inner, at = read(at + len("ARRAY<"))
            return f"ARRAY<{inner}>", at + 1
        end, deep = at, 0
        while end < len(kind) and (deep or kind[end] not in ",>"):
            deep += {"(": 1, ")": -1}.get(kind[end], 0)
            end += 1
        plain = kind[at:end]
        return "STRING" if plain == "VOID" else plain, end

    return read(0)[0]


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, multi_line: bool = True
) -> DataFrame:
    """Header row; quoted empty strings stay empty strings.

    Line breaks inside quotes make a file one task; without any, ``multi_line=False`` lets
    Spark split files.
    """
    reader = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
    reader = reader.option("nullValue", "\u0000").option("emptyValue", "")
    return (reader.schema(schema) if schema else reader).csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


# Files up to this size in all are dealt over all cores before long texts are worked on.
SPREAD_BYTES = 128 << 20


def spread(df: DataFrame) -> DataFrame:
    """Use all cores for a small input, which is often a single file; others are left as they are."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism) if size <= SPREAD_BYTES else df


def ingest(spark: SparkSession, path: str, fmt: str | None = None, schema: T.StructType | str | None = None) -> DataFrame:
    kind = detect_format(path, fmt)
    if kind == "jsonl":
        return read_jsonl(spark, path, schema) if schema is not None else infer_jsonl(spark, path)
    if kind == "csv":
        return read_csv(spark, path, schema)
    return read_parquet(spark, path)


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def read_split_dataset(
    spark: SparkSession, base: str | None = None, registry: DataFrame | None = None, dataset_id: str | None = None
) -> tuple[DataFrame, DataFrame | None]:
    """(train, validation): by registry id, else base/train and base/validation, else base alone."""
    if registry is not None and dataset_id is not None:
        from millrace.operators.catalog import get_dataset

        row = get_dataset(registry, dataset_id).first()
        train, validation = row["train_path"], row["validation_path"]
    elif _exists(spark, f"{base}/train"):
        train, validation = f"{base}/train", f"{base}/validation"
    else:
        return spark.read.parquet(base), None
    found = validation is not None and _exists(spark, validation)
    return spark.read.parquet(train), spark.read.parquet(validation) if found else None


def load_by_uri(spark: SparkSession, uri: str, fmt: str | None = None) -> DataFrame:
    """A path of any file system Spark can reach; names from model hubs need a download first."""
    if not (uri.startswith(("/", "./", "../")) or "://" in uri or uri.startswith("file:")):
        raise ValueError(f"Not a path: {uri}")
    return ingest(spark, uri, fmt)


PROMPT_COLUMNS = ("input", "prompt", "question", "text")
REFERENCE_COLUMNS = ("output", "reference", "answer", "target")


def eval_columns(df: DataFrame) -> tuple[Column, Column]:
    """Prompt and reference of a columnar set: the first name that exists as a column."""
    prompt = next((F.col(c) for c in PROMPT_COLUMNS if c in df.columns), None)
    reference = next((F.col(c) for c in REFERENCE_COLUMNS if c in df.columns), F.lit(""))
    if prompt is None:
        prompt = F.to_json(F.struct(*df.columns)) if df.columns else F.lit("")
    return prompt, reference


def read_eval_set(spark: SparkSession, path: str, missing_prompt: str = "") -> DataFrame:
    """(prompt, reference) of a JSONL file.  A missing key, not a null value, moves on to the next.

    ``missing_prompt`` is "" for evaluation; "row" gives the whole line as text, for comparison.
    """
    lines = read_jsonl(spark, path)

    def pick(names: tuple[str, ...], otherwise: Column) -> Column:
        branch = None
        for name in names:
            here = F.try_variant_get("row", f"$.{name}", "variant").isNotNull()
            text = F.try_variant_get("row", f"$.{name}", "string")
            branch = F.when(here, text) if branch is None else branch.when(here, text)
        return branch.otherwise(otherwise)

    whole = F.to_json("row") if missing_prompt == "row" else F.lit("")
    return lines.select(
        pick(("input", "prompt"), whole).alias("prompt"), pick(("output", "reference"), F.lit("")).alias("reference")
    )
