"""Prediction records and training runs, kept as append-only tables."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsloom.errors import DataContractError
from opsloom.functions.staging import materialize
from opsloom.operators.contracts import Rule
from opsloom.operators.quality import ERRORS, tag_rows
from opsloom.sources.tables import list_names, path_exists

# The kinds of prediction a record may hold.
PREDICTION_TYPES = ("wait_time", "arrivals", "no_show", "occupancy")
RECORD_COLUMNS = (
    "id",
    "request_id",
    "prediction_type",
    "model_version",
    "schema_version",
    "request_payload",
    "response_payload",
    "created_at",
)
_IS_OBJECT = "coalesce(schema_of_variant(try_parse_json({0})) like 'OBJECT%', false)"
RECORD_RULES = (
    Rule.one_of("prediction_type", PREDICTION_TYPES),
    Rule("request_payload is a JSON object", _IS_OBJECT.format("request_payload")),
    Rule("response_payload is a JSON object", _IS_OBJECT.format("response_payload")),
)


def tag_predictions(records: DataFrame) -> DataFrame:
    return tag_rows(records.select(*RECORD_COLUMNS), not_null=RECORD_COLUMNS, rules=RECORD_RULES)


def append_predictions(records: DataFrame, path: str) -> str:
    """Append records after the type and payload checks; one bad row rejects the batch.

    A batch is named by a digest of its records' ids and requests, written to a folder of that name,
    and counts once its marker is there. The same batch again changes nothing, and a batch whose write
    stopped is written anew. Returns the batch.
    """
    tagged = materialize(tag_predictions(records), "prediction-batch")
    if (bad := tagged.where(F.size(ERRORS) > 0).first()) is not None:
        raise DataContractError(f"prediction {bad.request_id}: {'; '.join(bad[ERRORS])}")
    row = F.xxhash64("id", "request_id", "prediction_type")
    facts = tagged.agg(F.count("*").alias("n"), F.bit_xor(row).alias("x"), F.sum(row.cast("decimal(38,0)")).alias("s"))
    batch = "b" + hashlib.sha256(repr(tuple(facts.first())).encode()).hexdigest()[:24]
    folder = f"{path.rstrip('/')}/batch={batch}"
    if not path_exists(records.sparkSession, f"{folder}/_SUCCESS"):
        tagged.drop(ERRORS).write.mode("overwrite").partitionBy("prediction_type").parquet(folder)
    return batch


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """The records of all complete batches."""
    base = path.rstrip("/")
    names = [n for n in list_names(spark, base) if n.startswith("batch=") and path_exists(spark, f"{base}/{n}/_SUCCESS")]
    if not names:
        raise FileNotFoundError(f"no complete batch of predictions in {path}")
    return spark.read.option("basePath", base).parquet(*(f"{base}/{n}" for n in names)).select(*RECORD_COLUMNS)


def recent_predictions(records: DataFrame, limit: int) -> DataFrame:
    """The newest records; every task keeps at most ``limit`` rows."""
    if not 1 <= limit <= 100:
        raise ValueError("ask for 1 to 100 records")
    return records.orderBy(F.desc("created_at"), F.desc("id")).limit(limit)


def append_training_run(
    spark: SparkSession,
    path: str,
    *,
    kind: str,
    version: str,
    parameters: Mapping[str, object],
    metrics: DataFrame,
) -> str:
    """Append one run: its parameters and its tidy ``(metric, value)`` rows as maps."""
    run_id = uuid.uuid4().hex
    pairs = [F.lit(str(x)) for item in parameters.items() for x in item]
    entries = F.map_from_entries(F.collect_list(F.struct("metric", "value")))
    metrics.agg(entries.alias("metrics")).select(
        F.lit(run_id).alias("run_id"),
        F.lit(kind).alias("kind"),
        F.lit(version).alias("version"),
        F.current_timestamp().alias("logged_at"),
        F.create_map(*pairs).cast("map<string,string>").alias("parameters"),
        "metrics",
    ).write.mode("append").parquet(path)
    return run_id

