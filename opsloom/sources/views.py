"""Hospital-shaped views over the driver's ``events`` table.

Each view is a lazy projection; only ``beds``, ``departments``, ``doctors`` and the rosters
group rows, and ``bed_events`` numbers the events of a user in two levels.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opsloom.functions.running import running_totals, time_bucket
from opsloom.functions.staging import materialize

HOSPITAL = "hospital_demo"


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table with its zone-less timestamps read as UTC."""
    frame = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    stamps = [f.name for f in frame.schema.fields if f.dataType.typeName() == "timestamp_ntz"]
    return frame.withColumns({c: F.col(c).cast("timestamp") for c in stamps}) if stamps else frame


def _plus(ts: str | Column, unit: str, amount: Column | int) -> Column:
    amount = F.lit(amount) if isinstance(amount, int) else amount
    return F.timestamp_add(unit, amount, F.col(ts) if isinstance(ts, str) else ts)


def _times(event: str | Column) -> list[Column]:
    at = F.col(event) if isinstance(event, str) else event
    return [
        at.alias("event_time"),
        _plus(at, "MINUTE", 1).alias("recorded_time"),
        _plus(at, "MINUTE", 2).alias("ingested_time"),
    ]


def keyed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with ``k``, the integer inside ``props``."""
    events = driver_table(spark, sf_dir, "events")
    return events.withColumn("k", F.get_json_object("props", "$.k").cast("int")).drop("props")


def _doctor() -> Column:
    return F.concat_ws("-", "event_type", (F.col("user_id") % 4).cast("string"))


def appointments(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = keyed_events(spark, sf_dir)
    return e.select(
        F.col("event_id").cast("string").alias("appointment_id"),
        F.col("user_id").cast("string").alias("patient_key"),
        F.lit(HOSPITAL).alias("hospital_id"),
        F.col("event_type").alias("department_id"),
        _doctor().alias("doctor_id"),
        *_times("ts"),
        F.col("ts").alias("booking_created_at"),
        _plus("ts", "HOUR", F.col("k") + 1).alias("scheduled_at"),
        F.when(F.col("user_id") % 2 == 0, "new").otherwise("follow_up").alias("appointment_type"),
        F.when(F.col("value") > 100, "urgent").otherwise("routine").alias("priority_type"),
        (F.col("k") % 5 != 0).alias("reminder_sent"),
        F.when(F.col("k") % 4 == 0, "no_show").otherwise("completed").alias("status"),
    )


def _visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = keyed_events(spark, sf_dir).where("k % 4 <> 0")
    scheduled = _plus("ts", "HOUR", F.col("k") + 1)
    entered = _plus(scheduled, "MINUTE", (F.col("event_id") % 31 - 10).cast("int"))
    return e.withColumn("entered", entered)


def encounters(spark: SparkSession, sf_dir: str, *, anomalies: bool = False) -> DataFrame:
    """Completed appointments; with ``anomalies`` every tenth starts before its queue entry."""
    e = _visits(spark, sf_dir)
    started = _plus("entered", "SECOND", F.floor(F.col("value") * 60).cast("int"))
    if anomalies:
        started = F.when(F.col("event_id") % 10 == 0, _plus("entered", "MINUTE", -5)).otherwise(started)
    e = e.withColumn("started", started).withColumn("ended", _plus("started", "MINUTE", 16))
    return e.select(
        F.col("event_id").cast("string").alias("encounter_id"),
        F.col("event_id").cast("string").alias("appointment_id"),
        F.col("event_type").alias("department_id"),
        *_times("entered"),
        F.col("entered").alias("queue_entered_at"),
        F.col("started").alias("consultation_started_at"),
        F.col("ended").alias("consultation_ended_at"),
        _plus("ended", "MINUTE", 5).alias("checkout_at"),
    )


def queue_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _visits(spark, sf_dir)
    return e.select(
        F.concat(F.lit("q"), F.col("event_id").cast("string")).alias("queue_event_id"),
        F.col("event_id").cast("string").alias("encounter_id"),
        F.col("event_type").alias("department_id"),
        *_times("entered"),
        (F.col("k") % 7).cast("bigint").alias("queue_length"),
        (1 + F.col("user_id") % 4).alias("available_doctors"),
        (1 + F.col("user_id") % 5).alias("available_rooms"),
    )


def beds(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = driver_table(spark, sf_dir, "events").select("user_id").distinct()
    return users.select(
        F.col("user_id").cast("string").alias("bed_id"),
        (F.col("user_id") % 5).cast("string").alias("ward_id"),
    )


def _numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = keyed_events(spark, sf_dir).where("user_id is not null")
    numbered = running_totals(
        events, ["user_id"], ["ts", "event_id"], {"rn": F.lit(1)}, time_bucket("ts")
    )
    stay = F.concat_ws("-", F.col("user_id").cast("string"), F.floor((F.col("rn") + 1) / 2).cast("string"))
    return numbered.withColumn("admission_id", stay)


def bed_events(spark: SparkSession, sf_dir: str, *, numbered: DataFrame | None = None) -> DataFrame:
    return (_numbered(spark, sf_dir) if numbered is None else numbered).select(
        F.col("event_id").cast("string").alias("bed_event_id"),
        F.col("user_id").cast("string").alias("bed_id"),
        "admission_id",
        *_times("ts"),
        F.when(F.col("rn") % 2 == 1, "occupied").otherwise("released").alias("event_type"),
    )


def admissions(spark: SparkSession, sf_dir: str, *, numbered: DataFrame | None = None) -> DataFrame:
    return (_numbered(spark, sf_dir) if numbered is None else numbered).where("rn % 2 = 1").select(
        "admission_id",
        F.col("event_id").cast("string").alias("encounter_id"),
        F.col("user_id").cast("string").alias("patient_key"),
        (F.col("user_id") % 5).cast("string").alias("ward_id"),
        *_times("ts"),
        F.col("ts").alias("admitted_at"),
        _plus("ts", "HOUR", 48).alias("expected_discharge_at"),
        _plus("ts", "HOUR", F.col("k") + 24).alias("discharged_at"),
    )


def departments(spark: SparkSession, sf_dir: str) -> DataFrame:
    types = driver_table(spark, sf_dir, "events").select("event_type").distinct()
    return types.select(
        F.col("event_type").alias("department_id"),
        F.lit(HOSPITAL).alias("hospital_id"),
        F.initcap("event_type").alias("department_name"),
        F.length("event_type").cast("bigint").alias("nominal_capacity"),
    )


def doctors(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = driver_table(spark, sf_dir, "events")
    return events.select(_doctor().alias("doctor_id"), F.col("event_type").alias("department_id")).distinct()


def staffing_rosters(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = driver_table(spark, sf_dir, "events").select(
        "event_type", F.date_trunc("day", "ts").alias("day"), (F.col("user_id") % 4).alias("doctor")
    )
    days = events.groupBy("event_type", "day").agg(F.count_distinct("doctor").alias("n"))
    return days.select(
        F.concat_ws("-", "event_type", F.date_format("day", "yyyyMMdd")).alias("roster_id"),
        F.col("event_type").alias("department_id"),
        *_times("day"),
        _plus("day", "HOUR", 8).alias("shift_start"),
        _plus("day", "HOUR", 16).alias("shift_end"),
        F.col("n").alias("available_doctors"),
    )


def canonical_dataset(
    spark: SparkSession, sf_dir: str, *, anomalies: bool = False, stage: bool = False
) -> dict[str, DataFrame]:
    """All nine canonical tables; with ``stage`` each is written once, for jobs that read them several times."""
    numbered = materialize(_numbered(spark, sf_dir), "numbered-events") if stage else None
    tables = {
        "departments": departments(spark, sf_dir),
        "doctors": doctors(spark, sf_dir),
        "beds": beds(spark, sf_dir),
        "staffing_rosters": staffing_rosters(spark, sf_dir),
        "appointments": appointments(spark, sf_dir),
        "encounters": encounters(spark, sf_dir, anomalies=anomalies),
        "queue_events": queue_events(spark, sf_dir),
        "admissions": admissions(spark, sf_dir, numbered=numbered),
        "bed_events": bed_events(spark, sf_dir, numbered=numbered),
    }
    return {n: materialize(t, f"input-{n}") for n, t in tables.items()} if stage else tables
