from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from opsloom.errors import ConfigurationError, DataQualityError, TrainingDataError
from opsloom.functions.clock import interval_micros
from opsloom.operators.features import NO_SHOW_NUMERIC, arrival_features, no_show_features
from opsloom.operators.joins import point_in_time_history
from opsloom.operators.splits import (
    first_rows,
    fraction_split,
    rolling_origin_windows,
    split_boundaries,
    temporal_split,
)
from opsloom.operators.targets import (
    arrival_target,
    check_state_alternation,
    occupancy_target,
    waiting_time_target,
)

UTC = timezone.utc
DAY = datetime(2026, 1, 1, tzinfo=UTC)


def at(day, hour, minute=0):
    return DAY + timedelta(days=day - 1, hours=hour, minutes=minute)


def test_wait_is_seventeen_minutes(spark):
    row = [("e", "d", at(5, 9), at(5, 9, 17))]
    ddl = "encounter_id string, department_id string, queue_entered_at timestamp, consultation_started_at timestamp"
    target = waiting_time_target(spark.createDataFrame(row, ddl))
    first = target.first()
    assert first.wait_minutes == 17 and first.hour == 9 and first.weekday == 0
    assert "consultation_started_at" not in target.columns
    with pytest.raises(DataQualityError):
        waiting_time_target(spark.createDataFrame([("e", "d", at(5, 9), at(5, 8))], ddl))


def test_history_counts_only_what_was_known(spark):
    ddl = (
        "appointment_id string, patient_key string, department_id string, appointment_type string, "
        "priority_type string, booking_created_at timestamp, scheduled_at timestamp, "
        "reminder_sent boolean, status string"
    )
    rows = [
        ("a1", "p1", "d", "new", "routine", at(1, 8), at(2, 10), True, "no_show"),
        ("a2", "p1", "d", "new", "routine", at(1, 12), at(3, 10), False, "completed"),
        ("a3", "p1", "d", "new", "routine", at(2, 12), at(4, 10), False, "completed"),
        # Booked exactly when the outcome of a1 becomes available: not strictly later.
        ("a4", "p1", "d", "new", "routine", at(2, 11), at(5, 10), False, "completed"),
    ]
    visits = spark.createDataFrame([], "appointment_id string, queue_entered_at timestamp")
    tables = {"appointments": spark.createDataFrame(rows, ddl), "encounters": visits}
    found = no_show_features(tables, grace_minutes=60, late_minutes=15)
    history = {r.appointment_id: (r.historical_appointments, r.historical_no_shows) for r in found.collect()}
    assert history == {"a1": (0, 0), "a2": (0, 0), "a3": (1, 1), "a4": (0, 0)}
    assert "reminder_sent" not in found.columns and set(NO_SHOW_NUMERIC) <= set(found.columns)
    with pytest.raises(ValueError):
        no_show_features(tables, grace_minutes=-1, late_minutes=15)


def test_history_of_a_hot_entity(spark):
    rows = spark.range(4_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("who"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 613).alias("asked"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 613 + F.col("id") % 977 * 60).alias("known"),
    )
    got = point_in_time_history(rows, rows, "who", "asked", "known", {"n": F.lit(1)}, bucket_hours=6)
    pdf = rows.toPandas()
    want = [int(((pdf.who == w) & (pdf.known < a)).sum()) for w, a in zip(pdf.who, pdf.asked)]
    merged = pdf.assign(want=want).merge(got.toPandas(), on=["who", "asked", "known"])
    assert len(merged) == 4_000 and (merged.want == merged.n).all()


def _series(spark, hours=336):
    rows = []
    for department, offset in (("a", 0), ("b", 2)):
        for i in range(hours):
            t = DAY + timedelta(hours=i)
            rows.append(("h", department, t, offset + 2 + 4 * (9 <= t.hour <= 17) + t.weekday() % 2))
    return spark.createDataFrame(
        rows, "hospital_id string, department_id string, interval_start timestamp, arrivals bigint"
    )


def test_features_need_a_week(spark):
    assert arrival_features(_series(spark)).count() == 2 * (336 - 168)
    with pytest.raises(TrainingDataError):
        arrival_features(_series(spark, 168))


def test_dense_calendar_per_group(spark):
    appointments = spark.createDataFrame([(str(i), "h") for i in range(3)], "appointment_id string, hospital_id string")
    encounters = spark.createDataFrame(
        [("0", "d", at(1, 8, 30)), ("1", "d", at(1, 11, 5)), ("2", "e", at(2, 0, 0))],
        "appointment_id string, department_id string, queue_entered_at timestamp",
    )
    target = arrival_target(appointments, encounters).orderBy("department_id", "interval_start").collect()
    assert [r.arrivals for r in target] == [1, 0, 0, 1, 1]
    with pytest.raises(DataQualityError):
        arrival_target(appointments, encounters.where("false"))


def test_intervals():
    assert interval_micros("15min") == 900_000_000
    with pytest.raises(ConfigurationError):
        interval_micros("0h")


def _beds(spark, kinds):
    events = [(f"x{i}", "b1", "a", at(1, i), k) for i, k in enumerate(kinds)]
    return {
        "beds": spark.createDataFrame([("b1", "w"), ("b2", "w")], "bed_id string, ward_id string"),
        "bed_events": spark.createDataFrame(
            events, "bed_event_id string, bed_id string, admission_id string, event_time timestamp, event_type string"
        ),
        "admissions": spark.createDataFrame(
            [("w", at(1, 1))], "ward_id string, expected_discharge_at timestamp"
        ),
    }


def test_occupancy(spark):
    target = occupancy_target(_beds(spark, ["occupied", "released", "occupied"]))
    rows = target.orderBy("interval_start").collect()
    assert [r.occupied_beds for r in rows] == [1, 0, 1]
    assert [r.expected_discharges for r in rows] == [0, 1, 0]
    assert {r.staffed_capacity for r in rows} == {2} and rows[0].occupancy_ratio == 0.5


def test_bed_alternation(spark):
    for kinds in (["released"], ["occupied", "occupied"]):
        with pytest.raises(DataQualityError):
            check_state_alternation(_beds(spark, kinds)["bed_events"])


def test_split_of_twenty_hours(spark):
    frame = spark.range(20).select(F.timestamp_seconds(F.lit(1_767_225_600) + F.col("id") * 3600).alias("t"))
    parts = temporal_split(frame, "t")
    assert (parts.train.count(), parts.validation.count(), parts.test.count()) == (14, 4, 2)
    bounds = {r.split: r for r in split_boundaries(parts.labelled, "t").collect()}
    assert bounds["train"].last_time < bounds["validation"].first_time
    assert bounds["validation"].last_time < bounds["test"].first_time
    with pytest.raises(DataQualityError):
        temporal_split(frame.limit(2), "t")
    with pytest.raises(ValueError):
        temporal_split(frame, "t", 0.9, 0.2)


@pytest.mark.parametrize("k", [0, 1, 7, 500, 999, 1000])
def test_first_rows_takes_exactly_k_with_ties(spark, k):
    rows = [(i, i % 3) for i in range(1000)]
    frame = spark.createDataFrame(rows, "id bigint, v int")
    got = {r.id for r in frame.where(first_rows(frame, F.col("v"), "id", lambda n: k)).collect()}
    want = {i for i, _ in sorted(rows, key=lambda r: (r[1], r[0]))[:k]}
    assert got == want


def test_fraction_split_with_text_ids(spark):
    frame = spark.range(101).select(F.concat(F.lit("id"), "id").alias("name"), F.lit(DAY).alias("t"))
    counts = {r.part: r["count"] for r in fraction_split(frame, "t", "name").groupBy("part").count().collect()}
    assert counts == {"reference": 70, "current": 31}


def test_rolling_windows(spark):
    windows = rolling_origin_windows(_series(spark), 2)
    assert [w.window for w in windows] == [2, 1]
    assert windows[1].future(_series(spark)).count() == 48
    with pytest.raises(TrainingDataError):
        rolling_origin_windows(_series(spark, 200), 2)


def test_three_times_leave_no_validation_part(spark):
    frame = spark.sql("select timestamp'2026-01-01' + make_dt_interval(0, id) as t from range(3)")
    with pytest.raises(DataQualityError):
        temporal_split(frame, "t")
    four = spark.sql("select timestamp'2026-01-01' + make_dt_interval(0, id) as t from range(4)")
    parts = {r.split: r.rows for r in split_boundaries(temporal_split(four, "t").labelled, "t").collect()}
    assert parts == {"train": 2, "validation": 1, "test": 1}


def test_text_ids_break_ties_in_byte_order(spark):
    ids = ["b", "a10", "a1", "a", "", "a10000000000", "a10000000001", "\u00e9", "z" * 30, "z" * 29]
    frame = spark.createDataFrame([(0.5, i) for i in ids], "p double, id string")
    for k in (1, 4, 9):
        got = {r.id for r in frame.where(first_rows(frame, -F.col("p"), "id", lambda n, k=k: k)).collect()}
        assert got == set(sorted(ids, key=str.encode)[:k])


def test_repeated_ids_at_the_cut_are_an_error(spark):
    frame = spark.createDataFrame([(0.5, "x")] * 4, "p double, id string")
    with pytest.raises(DataQualityError):
        first_rows(frame, -F.col("p"), "id", lambda n: 2)
