"""Reading and publishing named tables."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from functools import reduce
from pathlib import PurePosixPath
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsloom.errors import DataContractError, DataQualityError
from opsloom.operators.contracts import CANONICAL_CONTRACTS, TableContract, check_tables, data_dictionary
from opsloom.operators.quality import ValidationResult


def list_names(spark: SparkSession, directory: str) -> list[str]:
    """Entry names of a folder on any file system Spark can read."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(directory)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(path))


def path_exists(spark: SparkSession, target: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    return bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path))


def create_new(spark: SparkSession, target: str) -> bool:
    """Create an empty file that does not exist yet; false if someone else was first."""
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.getScheme() == "file":
        # Hadoop's local file system looks for the file first, so two writers could both create it.
        file = spark._jvm.java.io.File(path.toUri().getPath())
        file.getParentFile().mkdirs()
        return bool(file.createNewFile())
    return bool(fs.createNewFile(path))


def read_table_dir(spark: SparkSession, directory: str) -> dict[str, DataFrame]:
    """Every ``NAME.parquet`` of a folder as a lazy table."""
    names = [n for n in list_names(spark, directory) if n.endswith(".parquet")]
    if not names:
        raise FileNotFoundError(f"no Parquet tables in {directory}")
    return {
        PurePosixPath(n).stem: spark.read.parquet(f"{directory.rstrip('/')}/{n}") for n in names
    }


def table_counts(tables: Mapping[str, DataFrame], out: str = "rows") -> DataFrame:
    """Row count per table; each part is counted from file footers where possible."""
    parts = [
        t.agg(F.count("*").alias(out)).select(F.lit(n).alias("table_name"), out)
        for n, t in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


# Words that mark a column as a direct identifier of a person.
DIRECT_IDENTIFIERS = (
    "patient_name",
    "phone",
    "mobile",
    "address",
    "aadhaar",
    "abha",
)


def reject_identifiers(columns: Sequence[str], table: str) -> None:
    """Raise when a column name holds a direct identifier."""
    found = sorted(
        c
        for c in columns
        if any(word in c.lower().replace(" ", "_").replace("-", "_") for word in DIRECT_IDENTIFIERS)
    )
    if found:
        raise DataContractError(f"{table} holds direct identifiers: {found}")


def ingest_extract(
    spark: SparkSession,
    directory: str,
    contracts: Mapping[str, TableContract] = CANONICAL_CONTRACTS,
) -> dict[str, DataFrame]:
    """Read one CSV or Parquet table per contract, without direct identifiers.

    CSV text is parsed with the contract's types; a field that does not parse becomes null and is
    then a row failure of the not-null rule.
    """
    entries = {n for n in list_names(spark, directory)}
    base = directory.rstrip("/")
    tables: dict[str, DataFrame] = {}
    for name, contract in contracts.items():
        if f"{name}.parquet" in entries:
            frame = spark.read.parquet(f"{base}/{name}.parquet")
        elif f"{name}.csv" in entries:
            header = spark.read.option("header", True).csv(f"{base}/{name}.csv")
            reject_identifiers(header.columns, name)
            types = {f.name: f.dataType for f in contract.schema.fields}
            schema = T.StructType(
                [T.StructField(c, types.get(c, T.StringType())) for c in header.columns]
            )
            frame = spark.read.schema(schema).option("header", True).csv(f"{base}/{name}.csv")
        else:
            raise DataContractError(f"extract lacks a CSV or Parquet file for {name}")
        reject_identifiers(frame.columns, name)
        tables[name] = frame
    return tables


def table_fingerprints(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count and an order-free digest per table."""
    parts = []
    for name, frame in tables.items():
        row = F.xxhash64(*[F.col(c) for c in sorted(frame.columns)])
        parts.append(
            frame.select(row.alias("_h"))
            .agg(
                F.count("*").alias("rows"),
                F.coalesce(F.bit_xor("_h"), F.lit(0)).alias("xor_hash"),
                # Equal pairs cancel in an xor; the sum keeps them apart.
                F.coalesce(F.sum(F.col("_h").cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).alias("sum_hash"),
            )
            .select(F.lit(name).alias("table_name"), "rows", "xor_hash", "sum_hash")
        )
    return reduce(DataFrame.unionByName, parts)


def dataset_hash(tables: Mapping[str, DataFrame]) -> str:
    """SHA-256 over the table fingerprints: the version of an ingested dataset."""
    line = F.concat_ws(":", "table_name", "rows", "xor_hash", "sum_hash")
    joined = F.array_join(F.array_sort(F.collect_list(line)), "\n")
    return table_fingerprints(tables).agg(F.sha2(joined, 256).alias("h")).first().h


def configuration_hash(configuration: Mapping[str, Any]) -> str:
    """SHA-256 of the settings as JSON, without empty entries."""
    import hashlib

    kept = {k: v for k, v in configuration.items() if v is not None}
    return hashlib.sha256(json.dumps(kept, sort_keys=True, default=str).encode()).hexdigest()


def dataset_manifest(
    spark: SparkSession,
    report: DataFrame,
    configuration: Mapping[str, Any],
    *,
    name: str,
    date_range: tuple[str, str],
    contracts: Mapping[str, TableContract] = CANONICAL_CONTRACTS,
) -> DataFrame:
    """One row that describes a published dataset."""
    digest = configuration_hash(configuration)
    entries = F.struct("table_name", "valid_rows")
    lost = F.struct("table_name", "quarantined_rows")
    dictionary = data_dictionary(contracts)
    return report.agg(
        F.map_from_entries(F.collect_list(entries)).alias("row_counts"),
        F.map_from_entries(F.collect_list(lost)).alias("anomaly_counts"),
    ).select(
        F.lit(name).alias("dataset_name"),
        F.lit(digest).alias("configuration_hash"),
        F.lit(digest[:12]).alias("run_key"),
        F.lit(date_range[0]).alias("date_start"),
        F.lit(date_range[1]).alias("date_end"),
        F.current_timestamp().alias("generated_at"),
        "row_counts",
        "anomaly_counts",
        F.lit(json.dumps(dictionary)).alias("data_dictionary"),
    )


def data_dictionary_table(
    spark: SparkSession, contracts: Mapping[str, TableContract] = CANONICAL_CONTRACTS
) -> DataFrame:
    """Tidy data dictionary."""
    rows = [(t, c, k) for t, cols in data_dictionary(contracts).items() for c, k in cols.items()]
    return spark.createDataFrame(rows, "table_name string, column_name string, column_type string")


# Microseconds are kept in the raw text layer.
CSV_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def publish_dataset(
    inputs: Mapping[str, DataFrame],
    result: ValidationResult,
    root: str,
    *,
    name: str,
    configuration: Mapping[str, Any],
    date_range: tuple[str, str],
) -> str:
    """Write raw CSV, clean Parquet, quarantine Parquet, quality report and manifest.

    Layers go to ``<layer>/<name>/<run_key>/<attempt>``, a folder of this attempt alone. The manifest
    is written last and names the attempt, and readers go by the manifest, so an attempt that stops
    leaves nothing visible and can be repeated. A dataset that already has a complete manifest is
    never overwritten; of two attempts at a time either manifest names a complete one. Returns the
    run key.
    """
    check_tables(inputs, result.clean)
    first = next(iter(inputs.values()))
    spark = first.sparkSession
    run_key = configuration_hash(configuration)[:12]
    root = root.rstrip("/")
    manifest_path = _manifest_path(root, name, run_key)
    if path_exists(spark, f"{manifest_path}/_SUCCESS"):
        raise FileExistsError(f"dataset already published: {manifest_path}")
    attempt = uuid.uuid4().hex
    counts = {r.table_name: r for r in result.report.collect()}  # one row per table
    for table, frame in inputs.items():
        frame.write.mode("errorifexists").options(header=True, timestampFormat=CSV_TIME).csv(
            f"{root}/raw/{name}/{run_key}/{attempt}/{table}.csv"
        )
        result.clean[table].write.mode("errorifexists").parquet(
            f"{root}/bronze/{name}/{run_key}/{attempt}/{table}.parquet"
        )
        if counts[table].quarantined_rows:
            result.quarantine[table].write.mode("errorifexists").parquet(
                f"{root}/quarantine/{name}/{run_key}/{attempt}/{table}.parquet"
            )
    result.report.write.mode("errorifexists").json(f"{root}/reports/data_quality/{name}-{run_key}/{attempt}")
    manifest = dataset_manifest(
        spark, result.report, configuration, name=name, date_range=date_range
    )
    # Only a manifest whose write stopped can be there; the marker of a complete one comes last of all.
    manifest.withColumn("attempt", F.lit(attempt)).write.mode("overwrite").json(manifest_path)
    return run_key


def _manifest_path(root: str, name: str, run_key: str) -> str:
    return f"{root.rstrip('/')}/manifests/{name}-{run_key}"


def published_folder(spark: SparkSession, root: str, name: str, run_key: str, layer: str) -> str:
    """The folder of a layer of a published dataset, by its manifest; an error if there is no complete one."""
    path = _manifest_path(root, name, run_key)
    if not path_exists(spark, f"{path}/_SUCCESS"):
        raise FileNotFoundError(f"dataset is not published: {path}")
    attempt = spark.read.schema("attempt string").json(path).first().attempt
    return f"{root.rstrip('/')}/{layer}/{name}/{run_key}/{attempt}"


def finite_number(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value) & ~value.isin(float("inf"), float("-inf"))


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """A flat JSON object of finite numbers, as tidy ``(metric, value)`` rows."""
    text = spark.read.text(path, wholetext=True)
    parsed = text.select(F.try_parse_json("value").alias("v"))
    rows = parsed.select(
        F.schema_of_variant("v").alias("kind"), F.expr("try_variant_get(v, '$', 'map<string,variant>')").alias("m")
    )
    tidy = rows.select(F.explode_outer("m").alias("metric", "raw"), "kind").select(
        "kind",
        "metric",
        F.schema_of_variant("raw").alias("type"),
        F.try_variant_get("raw", "$", "double").alias("value"),
    )
    numeric = F.col("type").rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)") & finite_number(F.col("value"))
    bad = tidy.where(~F.coalesce(F.col("kind").startswith("OBJECT"), F.lit(False)) | (F.col("metric").isNotNull() & ~F.coalesce(numeric, F.lit(False))))
    if (row := bad.first()) is not None:
        raise DataQualityError(f"metrics must be an object of finite numbers: {row.metric}")
    return tidy.where("metric is not null").select("metric", "value")


def flatten_metrics(report: DataFrame) -> DataFrame:
    """Nested structs of a report row to ``(metric, value)`` rows with dotted names.

    Numbers only: booleans, texts and non-finite values are left out.
    """

    def walk(schema: T.StructType, prefix: str) -> list[tuple[str, str]]:
        found: list[tuple[str, str]] = []
        for f in schema.fields:
            path = f"{prefix}.`{f.name}`" if prefix else f"`{f.name}`"
            if isinstance(f.dataType, T.StructType):
                found += walk(f.dataType, path)
            elif isinstance(f.dataType, T.NumericType):
                found.append((path.replace("`", ""), path))
        return found

    pairs = walk(report.schema, "")
    items = F.array(*[
        F.struct(F.lit(name).alias("metric"), F.col(path).cast("double").alias("value"))
        for name, path in pairs
    ])
    return report.select(F.inline(items)).where(finite_number(F.col("value")))


def write_report(report: DataFrame, path: str) -> None:
    report.write.mode("overwrite").json(path)


def load_report(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Read a report with its declared schema; a malformed file stops the read."""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"report does not exist: {path}")
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
