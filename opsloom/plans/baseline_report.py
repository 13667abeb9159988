"""The baseline analysis: targets, splits, leakage checks, naive models and data profile."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsloom.functions.staging import materialize
from opsloom.operators.baselines import arrival_baseline_report, waiting_baseline_report
from opsloom.operators.contracts import require_tables
from opsloom.operators.profile import demand_summary, profile_dataset, queue_summary
from opsloom.operators.splits import (
    TemporalSplit,
    assert_leakage_free,
    leakage_checks,
    split_boundaries,
    temporal_split,
)
from opsloom.operators.targets import arrival_target, check_waiting_times, waiting_time_target


@dataclass(frozen=True)
class BaselineReport:
    waiting_split: TemporalSplit
    arrival_split: TemporalSplit
    boundaries: DataFrame
    checks: DataFrame
    metrics: DataFrame
    profile: DataFrame
    queues: DataFrame
    demand: DataFrame


def baseline_analysis(
    tables: Mapping[str, DataFrame], *, verify: bool = True, verify_keys: bool = True
) -> BaselineReport:
    """Score the naive baselines on the newest part of the data.

    Both targets are written once: each is read by the split, its baselines and the summaries.
    """
    require_tables(tables, ["appointments", "encounters", "queue_events"])
    waiting = materialize(waiting_time_target(tables["encounters"], verify=False), "waiting")
    if verify:
        check_waiting_times(waiting)
    arrivals = arrival_target(
        tables["appointments"], tables["encounters"], verify=verify, verify_keys=verify_keys
    )
    if not verify:  # a verified series is a written table already
        arrivals = materialize(arrivals, "arrivals")
    wait_split = temporal_split(waiting, "queue_entered_at")
    series_split = temporal_split(arrivals, "interval_start")
    checks = leakage_checks(wait_split, series_split)
    if verify:
        assert_leakage_free(checks)
    metrics = (
        waiting_baseline_report(wait_split.train, wait_split.test)
        .withColumn("target", F.lit("waiting_time"))
        .unionByName(
            arrival_baseline_report(series_split.train, series_split.test).withColumn(
                "target", F.lit("arrivals")
            )
        )
        .select("target", "model", "metric", "value")
    )
    boundaries = (
        split_boundaries(wait_split.labelled, "queue_entered_at")
        .withColumn("target", F.lit("waiting_time"))
        .unionByName(
            split_boundaries(series_split.labelled, "interval_start").withColumn(
                "target", F.lit("arrivals")
            )
        )
    )
    return BaselineReport(
        waiting_split=wait_split,
        arrival_split=series_split,
        boundaries=boundaries,
        checks=checks,
        metrics=metrics,
        profile=profile_dataset(tables),
        queues=queue_summary(tables["queue_events"]),
        demand=demand_summary(arrivals),
    )


def report_tables(report: BaselineReport) -> dict[str, tuple[DataFrame, tuple[str, ...]]]:
    """The six result tables of the analysis with their keys."""
    return {
        "baseline_metrics": (report.metrics, ("target", "model", "metric")),
        "split_boundaries": (report.boundaries, ("target", "split")),
        "leakage_checks": (report.checks, ("check_name",)),
        "eda_profile": (report.profile, ("table_name", "column_name", "measure")),
        "eda_queue": (report.queues, ("department_id",)),
        "eda_demand": (report.demand, ("department_id",)),
    }


def report_rows(report: BaselineReport) -> DataFrame:
    """All six tables as ``part, item, field, value, instant`` rows, one per filled cell.

    ``item`` joins the keys of a row; numbers and flags fill ``value``, times ``instant``.
    """
    parts = []
    for part, (frame, keys) in report_tables(report).items():
        cells = []
        for f in frame.schema.fields:
            if f.name in keys:
                continue
            timed = f.dataType.typeName() == "timestamp"
            value = F.lit(None) if timed else F.col(f.name)
            instant = F.col(f.name) if timed else F.lit(None)
            cells.append(F.struct(
                F.lit(f.name).alias("field"),
                value.cast("double").alias("value"),
                instant.cast("timestamp").alias("instant"),
            ))
        item = F.concat_ws("/", *keys).alias("item")
        rows = frame.select(F.lit(part).alias("part"), item, F.inline(F.array(*cells)))
        parts.append(rows.where("value is not null or instant is not null"))
    return reduce(DataFrame.unionByName, parts)


def write_baseline_report(report: BaselineReport, output: str) -> None:
    """Metrics, exploratory tables and leakage checks as JSON folders."""
    for name, (frame, _) in report_tables(report).items():
        frame.write.mode("overwrite").json(f"{output.rstrip('/')}/{name}")
