"""Prediction targets and dense time series."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opsloom.errors import DataQualityError
from opsloom.functions.clock import floor_to_interval, interval_sequence, minutes_between
from opsloom.functions.running import previous_value, time_bucket
from opsloom.functions.staging import materialize
from opsloom.operators.contracts import require_columns, require_tables
from opsloom.operators.joins import checked_join

SERIES_KEYS = ("hospital_id", "department_id")


def waiting_time_target(
    encounters: DataFrame, *, carry: Sequence[str] = (), verify: bool = True
) -> DataFrame:
    """Minutes from queue entry to the start of the consultation, with weekday and hour.

    The start itself is dropped: it is not known at prediction time. ``carry`` keeps further
    columns, such as a key for a later join.
    """
    require_columns(
        encounters,
        ["encounter_id", "department_id", "queue_entered_at", "consultation_started_at"],
    )
    target = encounters.select(
        "encounter_id",
        "department_id",
        "queue_entered_at",
        minutes_between("queue_entered_at", "consultation_started_at").alias("wait_minutes"),
        F.weekday("queue_entered_at").alias("weekday"),
        F.hour("queue_entered_at").alias("hour"),
        *carry,
    )
    return check_waiting_times(target) if verify else target


def check_waiting_times(target: DataFrame) -> DataFrame:
    if not target.where("wait_minutes is null or wait_minutes < 0").isEmpty():
        raise DataQualityError("waiting times are missing or negative")
    return target


def interval_counts(
    events: DataFrame, groups: Sequence[str], time: str, *, frequency: str = "1h", out: str = "arrivals"
) -> DataFrame:
    """Events per group and interval."""
    start = floor_to_interval(time, frequency).alias("interval_start")
    return events.select(*groups, start).groupBy(*groups, "interval_start").agg(F.count("*").alias(out))


def densify_calendar(
    counts: DataFrame, groups: Sequence[str], values: Sequence[str], *, frequency: str = "1h"
) -> DataFrame:
    """Every interval between a group's own first and last one; gaps hold zero."""
    calendar = (
        counts.groupBy(*groups)
        .agg(F.min("interval_start").alias("_first"), F.max("interval_start").alias("_last"))
        .select(*groups, F.explode(interval_sequence("_first", "_last", frequency)).alias("interval_start"))
    )
    filled = calendar.join(counts, [*groups, "interval_start"], "left")
    return filled.select(
        *groups, "interval_start", *[F.coalesce(v, F.lit(0)).alias(v) for v in values]
    )


def arrival_target(
    appointments: DataFrame,
    encounters: DataFrame,
    frequency: str = "1h",
    *,
    verify_keys: bool = True,
    verify: bool = True,
) -> DataFrame:
    """Queue entries per hospital, department and interval, without gaps."""
    entries = checked_join(
        encounters.select("appointment_id", "department_id", "queue_entered_at"),
        appointments.select("appointment_id", "hospital_id"),
        ["appointment_id"],
        verify=verify_keys,
    )
    counts = interval_counts(entries, SERIES_KEYS, "queue_entered_at", frequency=frequency)
    target = densify_calendar(counts, SERIES_KEYS, ["arrivals"], frequency=frequency)
    if verify:
        # The series is far smaller than the events behind it, so it is written before the check.
        target = materialize(target, "arrival-target")
        if target.isEmpty():
            raise DataQualityError("no arrivals")
    return target


def state_violations(bed_events: DataFrame) -> DataFrame:
    """Events that break a bed's occupied / released alternation, which starts with occupied."""
    events = bed_events.select("bed_id", "bed_event_id", "event_time", "event_type")
    stepped = previous_value(
        events,
        ["bed_id"],
        ["event_time", "bed_event_id"],
        "event_type",
        "previous_type",
        time_bucket("event_time"),
    )
    before = F.coalesce(F.col("previous_type"), F.lit("released"))
    return stepped.where(F.col("event_type") == before).select(
        "bed_id", "bed_event_id", "event_time", "event_type", "previous_type"
    )


def check_state_alternation(bed_events: DataFrame) -> None:
    if (bad := state_violations(bed_events).first()) is not None:
        what = "overlapping occupancy" if bad.event_type == "occupied" else "release while unoccupied"
        raise DataQualityError(f"bed {bad.bed_id}: {what}")


def capacity_by_group(beds: DataFrame, group: str = "ward_id") -> DataFrame:
    return beds.groupBy(group).agg(F.count("*").alias("staffed_capacity"))


def expected_discharges(admissions: DataFrame) -> DataFrame:
    return interval_counts(admissions, ["ward_id"], "expected_discharge_at", out="expected_discharges")


def occupancy_target(
    tables: Mapping[str, DataFrame], *, verify: bool = True, verify_keys: bool = True
) -> DataFrame:
    """Occupied beds per ward and hour with capacity, expected discharges and ratio.

    Events collapse to one net change per ward and hour before anything is ordered, so the
    running sum works on at most one row per ward and calendar hour.
    """
    require_tables(tables, ["beds", "bed_events", "admissions"])
    beds = tables["beds"]
    if verify:
        check_state_alternation(tables["bed_events"])
    events = checked_join(
        tables["bed_events"].select("bed_id", "event_time", "event_type"),
        beds,
        ["bed_id"],
        verify=verify_keys,
    )
    change = F.when(F.col("event_type") == "occupied", 1).otherwise(-1)
    net = (
        events.select("ward_id", floor_to_interval("event_time").alias("interval_start"), change.alias("d"))
        .groupBy("ward_id", "interval_start")
        .agg(F.sum("d").alias("net_change"))
    )
    hours = densify_calendar(net, ["ward_id"], ["net_change"])
    so_far = Window.partitionBy("ward_id").orderBy("interval_start").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    running = hours.select(
        "ward_id", "interval_start", F.sum("net_change").over(so_far).alias("occupied_beds")
    )
    target = (
        running.join(capacity_by_group(beds), "ward_id")
        .join(expected_discharges(tables["admissions"]), ["ward_id", "interval_start"], "left")
        .select(
            "ward_id",
            "interval_start",
            "occupied_beds",
            "staffed_capacity",
            F.coalesce("expected_discharges", F.lit(0)).alias("expected_discharges"),
            (F.col("occupied_beds") / F.col("staffed_capacity")).alias("occupancy_ratio"),
        )
    )
    if verify:
        target = materialize(target, "occupancy-target")
        if target.isEmpty():
            raise DataQualityError("no bed events")
        if not target.where("occupied_beds < 0 or occupied_beds > staffed_capacity").isEmpty():
            raise DataQualityError("occupied beds must stay within capacity")
    return target
