"""An append-only log of model versions: whoever creates a number first may write its record.

Each record has a number. A writer takes the next one by creating its claim, which the file system
lets only one writer do, and then writes the record below it. A record counts once it is complete, so
a writer that dies leaves a claim without a record and changes nothing. The current version is the one
the newest complete promotion names; nothing is ever replaced or deleted.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsloom.operators.policy import retraining_gate
from opsloom.sources.tables import create_new, list_names, path_exists

RECORD_SCHEMA = "number long, version string, action string, previous string, value double, details map<string,string>, logged_at timestamp"
# What a record may say about a version.
TRAINED, BLOCKED, SKIPPED, REJECTED, ARCHIVED, PROMOTED = ("trained", "blocked", "skipped", "rejected", "archived", "promoted")


def _folder(root: str) -> str:
    return f"{root.rstrip('/')}/log"


def _numbers(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(n.split(".")[0]) for n in list_names(spark, _folder(root)) if n.endswith(".claim"))


def append_record(
    spark: SparkSession,
    root: str,
    *,
    version: str,
    action: str,
    previous: str | None = None,
    value: float | None = None,
    details: Mapping[str, object] | None = None,
) -> int:
    """Write one record under the next free number, which is returned."""
    number = (_numbers(spark, root) or [0])[-1] + 1
    while not create_new(spark, f"{_folder(root)}/{number:08d}.claim"):
        number += 1  # another writer was first
    row = (number, version, action, previous, value, {k: str(v) for k, v in (details or {}).items()}, None)
    record = spark.createDataFrame([row], RECORD_SCHEMA).withColumn("logged_at", F.current_timestamp())
    record.write.mode("errorifexists").json(f"{_folder(root)}/{number:08d}")
    return number


def version_records(spark: SparkSession, root: str) -> DataFrame:
    """All complete records by number."""
    complete = [
        f"{_folder(root)}/{n:08d}" for n in _numbers(spark, root) if path_exists(spark, f"{_folder(root)}/{n:08d}/_SUCCESS")
    ]
    if not complete:
        return spark.createDataFrame([], RECORD_SCHEMA)
    return spark.read.schema(RECORD_SCHEMA).json(complete)


def current_version(spark: SparkSession, root: str) -> str | None:
    """The version of the newest complete promotion."""
    newest = version_records(spark, root).where(F.col("action") == PROMOTED).agg(F.max_by("version", "number").alias("v"))
    return newest.first().v


def model_path(root: str, version: str) -> str:
    return f"{root.rstrip('/')}/models/{version}"


@dataclass(frozen=True)
class Candidate:
    """A trained version: how to save it, and its error next to that of the version it would replace."""

    save: Callable[[str], None]
    candidate_value: float
    # None where no version is current yet.
    current_value: float | None
    details: Mapping[str, object]


def run_retraining(
    spark: SparkSession,
    root: str,
    version: str,
    alerts: DataFrame,
    train: Callable[[str | None], Candidate],
    *,
    minimum_improvement: float = 0.02,
) -> str:
    """Retrain if the alerts ask for it and promote the candidate if it is good enough; returns the last action.

    A data-quality alert blocks; without a drift or performance alert nothing is trained, unless no
    version is current. ``train`` gets the path of the current version, or None. The candidate is saved
    under its version, which must be new, and recorded; the version it replaces is recorded as archived
    before the promotion, so that a run that stops in between leaves the old one current.
    """
    if path_exists(spark, model_path(root, version)):
        raise FileExistsError(f"version {version} was saved before")
    before = current_version(spark, root)
    nothing = spark.createDataFrame([(None, None)], "current_value double, candidate_value double")
    gate = retraining_gate(alerts, nothing, minimum_improvement=minimum_improvement).first()
    if gate.blocked:
        append_record(spark, root, version=version, action=BLOCKED, previous=before)
        return BLOCKED
    if before is not None and not gate.retrain:
        append_record(spark, root, version=version, action=SKIPPED, previous=before)
        return SKIPPED
    candidate = train(None if before is None else model_path(root, before))
    candidate.save(model_path(root, version))
    facts = {"value": candidate.candidate_value, "details": candidate.details}
    append_record(spark, root, version=version, action=TRAINED, previous=before, **facts)
    if before is not None:
        values = spark.createDataFrame([(candidate.current_value, candidate.candidate_value)], "current_value double, candidate_value double")
        if not retraining_gate(alerts, values, minimum_improvement=minimum_improvement).first().promote:
            append_record(spark, root, version=version, action=REJECTED, previous=before, **facts)
            return REJECTED
        append_record(spark, root, version=before, action=ARCHIVED, value=candidate.current_value)
    append_record(spark, root, version=version, action=PROMOTED, previous=before, **facts)
    return PROMOTED
