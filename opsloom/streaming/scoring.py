"""Scoring a stream of request rows and keeping each prediction.

Online prediction as Structured Streaming: every micro-batch is checked against the scoring
contract, scored with a batch operator, and written as prediction records. A batch has a folder
of its own that a retry overwrites, so a restart neither loses nor repeats records.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from opsloom.operators.contracts import Rule
from opsloom.operators.quality import ERRORS, tag_rows

REQUEST_COLUMNS = ("request_id", "created_at")


def prediction_records(
    scored: DataFrame, features: Sequence[str], outputs: Sequence[str], kind: str, model_version: str
) -> DataFrame:
    """Scored rows as prediction records with JSON payloads."""
    return scored.select(
        F.xxhash64("request_id").alias("id"),
        "request_id",
        F.lit(kind).alias("prediction_type"),
        F.lit(model_version).alias("model_version"),
        F.lit("1.0").alias("schema_version"),
        F.to_json(F.struct(*features)).alias("request_payload"),
        F.to_json(F.struct(*outputs)).alias("response_payload"),
        "created_at",
    )


def score_batch(
    requests: DataFrame,
    score: Callable[[DataFrame], DataFrame],
    *,
    features: Sequence[str],
    outputs: Sequence[str],
    rules: Sequence[Rule],
    kind: str,
    model_version: str,
) -> tuple[DataFrame, DataFrame]:
    """Records of the valid requests, and the rejected requests with their errors."""
    tagged = tag_rows(requests, not_null=[*REQUEST_COLUMNS, *features], rules=rules)
    valid = tagged.where(F.size(ERRORS) == 0).drop(ERRORS)
    rejected = tagged.where(F.size(ERRORS) > 0)
    return prediction_records(score(valid), features, outputs, kind, model_version), rejected


def score_stream(
    requests: DataFrame,
    score: Callable[[DataFrame], DataFrame],
    log_path: str,
    checkpoint: str,
    *,
    features: Sequence[str],
    outputs: Sequence[str],
    rules: Sequence[Rule],
    kind: str,
    model_version: str,
) -> StreamingQuery:
    """Score everything that is available, then stop; rerun it to go on where it stopped."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            records, rejected = score_batch(
                batch,
                score,
                features=features,
                outputs=outputs,
                rules=rules,
                kind=kind,
                model_version=model_version,
            )
            records.write.mode("overwrite").parquet(f"{log_path}/predictions/batch={batch_id}")
            rejected.write.mode("overwrite").parquet(f"{log_path}/rejected/batch={batch_id}")
        finally:
            batch.unpersist()

    return (
        requests.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
