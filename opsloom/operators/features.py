"""Leak-free features for waiting time, no-shows, arrivals and occupancy."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsloom.errors import TrainingDataError
from opsloom.functions.clock import hours_between, shift
from opsloom.functions.staging import materialize
from opsloom.operators.contracts import require_columns, require_tables
from opsloom.operators.joins import checked_join, point_in_time_history
from opsloom.operators.quality import assert_no_nulls
from opsloom.operators.targets import SERIES_KEYS, check_waiting_times, waiting_time_target

WAIT_CATEGORICAL = ("department_id", "appointment_type", "priority_type")
WAIT_NUMERIC = (
    "reminder_sent",
    "weekday",
    "hour",
    "queue_length",
    "available_doctors",
    "available_rooms",
)
NO_SHOW_CATEGORICAL = ("department_id", "appointment_type", "priority_type")
NO_SHOW_HISTORY = (
    "historical_appointments",
    "historical_no_shows",
    "historical_late_arrivals",
    "historical_reminders",
)
NO_SHOW_NUMERIC = (
    "booking_lead_hours",
    "scheduled_weekday",
    "scheduled_hour",
    *NO_SHOW_HISTORY,
    "historical_no_show_rate",
)
ARRIVAL_NUMERIC = ("hour", "weekday", "is_weekend", "lag_1", "lag_24", "lag_168", "rolling_24")
OCCUPANCY_NUMERIC = (
    "hour",
    "weekday",
    "staffed_capacity",
    "lag_1",
    "lag_24",
    "lag_168",
    "rolling_24",
    "expected_discharges",
)
LAGS = (1, 24, 168)
TRAILING_ROWS = 24


def wait_features(
    tables: Mapping[str, DataFrame], *, verify: bool = True, verify_keys: bool = True
) -> DataFrame:
    """Queue snapshot and appointment attributes known at queue entry, with the wait as label.

    What is checked is written first, each table with the columns used here, and with ``verify`` the
    features too, so no check computes its rows again.
    """
    require_tables(tables, ["appointments", "encounters", "queue_events"])
    waiting = waiting_time_target(tables["encounters"], carry=["appointment_id"], verify=False)
    appointments = tables["appointments"].select(
        "appointment_id", "appointment_type", "priority_type", "reminder_sent"
    )
    queues = tables["queue_events"].select(
        "encounter_id", "queue_length", "available_doctors", "available_rooms"
    )
    if verify or verify_keys:
        waiting = materialize(waiting, "wait-target")
        appointments = materialize(appointments, "wait-appointments")
        queues = materialize(queues, "wait-queues")
    if verify:
        check_waiting_times(waiting)
    joined = checked_join(waiting, queues, ["encounter_id"], cardinality="one_to_one", verify=verify_keys)
    joined = checked_join(joined, appointments, ["appointment_id"], verify=verify_keys)
    features = joined.select(
        "encounter_id", "queue_entered_at", *WAIT_CATEGORICAL, *WAIT_NUMERIC, "wait_minutes"
    )
    return assert_no_nulls(materialize(features, "wait-features"), error=TrainingDataError) if verify else features


def was_late(queue_entered_at: str, scheduled_at: str, late_minutes: int) -> Column:
    """Queue entry later than the tolerated delay; without an entry, false."""
    limit = shift(F.col(scheduled_at), minutes=late_minutes)
    return F.coalesce(F.col(queue_entered_at) > limit, F.lit(False))


def history_rate(events: Column, total: Column) -> Column:
    """Share of earlier events, 0 without history."""
    return F.when(total > 0, events / total).otherwise(F.lit(0.0))


def no_show_features(
    tables: Mapping[str, DataFrame],
    *,
    grace_minutes: int,
    late_minutes: int,
    verify: bool = True,
    verify_keys: bool = True,
) -> DataFrame:
    """Booking-time features with each patient's history as known when the booking was made.

    An appointment's outcome counts from ``scheduled_at`` plus the grace period, and only for
    bookings made strictly later.
    """
    if grace_minutes < 0 or late_minutes < 0:
        raise ValueError("grace_minutes and late_minutes must not be negative")
    require_tables(tables, ["appointments", "encounters"])
    visits = tables["encounters"].select("appointment_id", "queue_entered_at")
    booked = checked_join(
        tables["appointments"],
        visits,
        ["appointment_id"],
        how="left",
        cardinality="one_to_one",
        verify=verify_keys,
    ).select(
        "appointment_id",
        "patient_key",
        "booking_created_at",
        "scheduled_at",
        *NO_SHOW_CATEGORICAL,
        "reminder_sent",
        (F.col("status") == "no_show").cast("int").alias("no_show"),
        was_late("queue_entered_at", "scheduled_at", late_minutes).alias("_late"),
    )
    outcomes = booked.select(
        "patient_key",
        shift(F.col("scheduled_at"), minutes=grace_minutes).alias("_available_at"),
        "no_show",
        "_late",
        "reminder_sent",
    )
    decided = point_in_time_history(
        booked.drop("_late", "reminder_sent"),
        outcomes,
        "patient_key",
        "booking_created_at",
        "_available_at",
        {
            "historical_appointments": F.lit(1),
            "historical_no_shows": F.col("no_show"),
            "historical_late_arrivals": F.col("_late").cast("int"),
            "historical_reminders": F.col("reminder_sent").cast("int"),
        },
    )
    features = decided.withColumns({
        "historical_no_show_rate": history_rate(
            F.col("historical_no_shows"), F.col("historical_appointments")
        ),
        "booking_lead_hours": hours_between("booking_created_at", "scheduled_at"),
        "scheduled_weekday": F.weekday("scheduled_at"),
        "scheduled_hour": F.hour("scheduled_at"),
    }).select(
        "appointment_id",
        "patient_key",
        "booking_created_at",
        *NO_SHOW_CATEGORICAL,
        *NO_SHOW_NUMERIC,
        "no_show",
    )
    return assert_no_nulls(features, error=TrainingDataError) if verify else features


def with_history_rate(requests: DataFrame) -> DataFrame:
    """Add the no-show rate of a scoring row from the counts it supplies."""
    return requests.withColumn(
        "historical_no_show_rate",
        history_rate(F.col("historical_no_shows"), F.col("historical_appointments")),
    )


def calendar_columns(time: str, *, weekend: bool = True) -> dict[str, Column]:
    columns = {"hour": F.hour(time), "weekday": F.weekday(time)}
    if weekend:
        columns["is_weekend"] = (F.weekday(time) >= 5).cast("int")
    return columns


def lag_columns(
    value: str, groups: Sequence[str], time: str, lags: Sequence[int] = LAGS
) -> dict[str, Column]:
    ordered = Window.partitionBy(*groups).orderBy(time)
    return {f"lag_{k}": F.lag(value, k).over(ordered) for k in lags}


def trailing_mean(
    value: str, groups: Sequence[str], time: str, rows: int = TRAILING_ROWS
) -> Column:
    """Mean of the ``rows`` rows before the current one, null until they all exist."""
    frame = Window.partitionBy(*groups).orderBy(time).rowsBetween(-rows, -1)
    return F.when(F.count(value).over(frame) == rows, F.avg(value).over(frame))


def series_features(
    target: DataFrame,
    groups: Sequence[str],
    value: str,
    *,
    weekend: bool,
    verify: bool = True,
) -> DataFrame:
    """Calendar, lag and trailing-mean features of a dense hourly series.

    All windows share one partitioning and order, so the series is shuffled and sorted once. A
    group holds one row per calendar hour, never one per event. Rows without a full week of
    history are dropped.
    """
    time = "interval_start"
    features = target.withColumns({
        **calendar_columns(time, weekend=weekend),
        **lag_columns(value, groups, time),
        f"rolling_{TRAILING_ROWS}": trailing_mean(value, groups, time),
    }).na.drop()
    if verify and features.isEmpty():
        raise TrainingDataError("no row has a full week of lags before it")
    return features


def arrival_features(target: DataFrame, *, verify: bool = True) -> DataFrame:
    require_columns(target, [*SERIES_KEYS, "interval_start", "arrivals"], TrainingDataError)
    return series_features(target, SERIES_KEYS, "arrivals", weekend=True, verify=verify)


def occupancy_features(target: DataFrame, *, verify: bool = True) -> DataFrame:
    require_columns(
        target,
        ["ward_id", "interval_start", "occupied_beds", "staffed_capacity", "expected_discharges"],
        TrainingDataError,
    )
    return series_features(target, ["ward_id"], "occupied_beds", weekend=False, verify=verify)


def congestion_bucket(queue_length: Column) -> Column:
    """low up to 1, medium up to 3, high above."""
    return (
        F.when(queue_length <= 1, "low").when(queue_length <= 3, "medium").otherwise("high")
    )

