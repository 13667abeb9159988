"""Where queries and their SQL register, and the column formats both sides share."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opsloom.session import configure

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without ``sql`` only its rows can be checked."""

    def register(function: Query) -> Query:
        @wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(configure(spark), sf_dir)

        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def rounded(frame: DataFrame, digits: int = 6) -> DataFrame:
    """Round doubles, as the SQL side does, and print times as text."""
    columns: list[Column] = []
    for f in frame.schema.fields:
        kind = f.dataType.typeName()
        if kind in ("double", "float"):
            # Adding zero turns a negative zero into a plain one.
            columns.append((F.round(F.col(f.name).cast("double"), digits) + F.lit(0.0)).alias(f.name))
        elif kind == "timestamp":
            columns.append(F.date_format(f.name, "yyyy-MM-dd HH:mm:ss").alias(f.name))
        else:
            columns.append(F.col(f.name))
    return frame.select(*columns)


# --- SQL views that mirror opsloom.sources.views -----------------------------------------

_VIEWS = {
    "keyed": """
        SELECT event_id, ts, user_id, event_type, value,
               CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
        FROM events""",
    "appointments": """
        SELECT CAST(event_id AS VARCHAR) AS appointment_id, CAST(user_id AS VARCHAR) AS patient_key,
               'hospital_demo' AS hospital_id, event_type AS department_id,
               event_type || '-' || CAST(user_id % 4 AS VARCHAR) AS doctor_id,
               ts AS event_time, ts + to_minutes(1) AS recorded_time, ts + to_minutes(2) AS ingested_time,
               ts AS booking_created_at, ts + to_hours(k + 1) AS scheduled_at,
               CASE WHEN user_id % 2 = 0 THEN 'new' ELSE 'follow_up' END AS appointment_type,
               CASE WHEN value > 100 THEN 'urgent' ELSE 'routine' END AS priority_type,
               k % 5 <> 0 AS reminder_sent,
               CASE WHEN k % 4 = 0 THEN 'no_show' ELSE 'completed' END AS status
        FROM keyed""",
    "visits": """
        SELECT *, ts + to_hours(k + 1) + to_minutes(CAST(event_id % 31 - 10 AS INTEGER)) AS entered
        FROM keyed WHERE k % 4 <> 0""",
    "encounters": """
        SELECT encounter_id, encounter_id AS appointment_id, department_id, queue_entered_at,
               consultation_started_at,
               consultation_started_at + to_minutes(16) AS consultation_ended_at,
               consultation_started_at + to_minutes(21) AS checkout_at
        FROM (SELECT CAST(event_id AS VARCHAR) AS encounter_id, event_type AS department_id,
                     entered AS queue_entered_at,
                     entered + to_seconds(CAST(floor(value * 60) AS INTEGER)) AS consultation_started_at
              FROM visits)""",
    "raw_encounters": """
        SELECT CAST(event_id AS VARCHAR) AS encounter_id, CAST(event_id AS VARCHAR) AS appointment_id,
               event_id % 10 = 0 AS early
        FROM visits""",
    "queue_events": """
        SELECT 'q' || CAST(event_id AS VARCHAR) AS queue_event_id, CAST(event_id AS VARCHAR) AS encounter_id,
               event_type AS department_id, k % 7 AS queue_length,
               1 + user_id % 4 AS available_doctors, 1 + user_id % 5 AS available_rooms
        FROM visits""",
    "beds": """
        SELECT DISTINCT CAST(user_id AS VARCHAR) AS bed_id, CAST(user_id % 5 AS VARCHAR) AS ward_id
        FROM events""",
    "numbered": """
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM keyed""",
    "bed_events": """
        SELECT CAST(event_id AS VARCHAR) AS bed_event_id, CAST(user_id AS VARCHAR) AS bed_id,
               CAST(user_id AS VARCHAR) || '-' || CAST((rn + 1) // 2 AS VARCHAR) AS admission_id,
               ts AS event_time, CASE WHEN rn % 2 = 1 THEN 'occupied' ELSE 'released' END AS event_type
        FROM numbered""",
    "admissions": """
        SELECT CAST(user_id AS VARCHAR) || '-' || CAST((rn + 1) // 2 AS VARCHAR) AS admission_id,
               CAST(event_id AS VARCHAR) AS encounter_id, CAST(user_id % 5 AS VARCHAR) AS ward_id,
               ts AS admitted_at, ts + to_hours(48) AS expected_discharge_at
        FROM numbered WHERE rn % 2 = 1""",
    "waiting": """
        SELECT encounter_id, department_id, queue_entered_at,
               (epoch_us(consultation_started_at) - epoch_us(queue_entered_at)) / 60000000.0::DOUBLE AS wait_minutes,
               isodow(queue_entered_at) - 1 AS weekday, hour(queue_entered_at) AS hour
        FROM encounters""",
    "arrival_counts": """
        SELECT 'hospital_demo' AS hospital_id, department_id,
               date_trunc('hour', queue_entered_at) AS interval_start, count(*) AS arrivals
        FROM encounters GROUP BY ALL""",
    "arrivals": """
        SELECT c.hospital_id, c.department_id, c.interval_start, coalesce(a.arrivals, 0) AS arrivals
        FROM (SELECT hospital_id, department_id,
                     unnest(generate_series(min(interval_start), max(interval_start), INTERVAL 1 HOUR))
                       AS interval_start
              FROM arrival_counts GROUP BY hospital_id, department_id) c
        LEFT JOIN arrival_counts a USING (hospital_id, department_id, interval_start)""",
    "net_changes": """
        SELECT b.ward_id, date_trunc('hour', e.event_time) AS interval_start,
               sum(CASE WHEN e.event_type = 'occupied' THEN 1 ELSE -1 END) AS net_change
        FROM bed_events e JOIN beds b USING (bed_id) GROUP BY ALL""",
    "occupancy": """
        SELECT r.ward_id, r.interval_start, CAST(r.occupied_beds AS BIGINT) AS occupied_beds,
               p.staffed_capacity, coalesce(x.expected_discharges, 0) AS expected_discharges,
               r.occupied_beds / p.staffed_capacity AS occupancy_ratio
        FROM (SELECT c.ward_id, c.interval_start,
                     sum(coalesce(n.net_change, 0)) OVER (PARTITION BY c.ward_id ORDER BY c.interval_start)
                       AS occupied_beds
              FROM (SELECT ward_id, unnest(generate_series(min(interval_start), max(interval_start),
                                                           INTERVAL 1 HOUR)) AS interval_start
                    FROM net_changes GROUP BY ward_id) c
              LEFT JOIN net_changes n USING (ward_id, interval_start)) r
        JOIN (SELECT ward_id, count(*) AS staffed_capacity FROM beds GROUP BY ward_id) p USING (ward_id)
        LEFT JOIN (SELECT ward_id, date_trunc('hour', expected_discharge_at) AS interval_start,
                          count(*) AS expected_discharges FROM admissions GROUP BY ALL) x
          USING (ward_id, interval_start)""",
    "arrival_features": """
        SELECT * FROM (
          SELECT *, hour(interval_start) AS hour, isodow(interval_start) - 1 AS weekday,
                 CAST(isodow(interval_start) >= 6 AS INTEGER) AS is_weekend,
                 lag(arrivals, 1) OVER w AS lag_1, lag(arrivals, 24) OVER w AS lag_24,
                 lag(arrivals, 168) OVER w AS lag_168,
                 avg(arrivals) OVER (PARTITION BY hospital_id, department_id ORDER BY interval_start
                                     ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS rolling_24
          FROM arrivals WINDOW w AS (PARTITION BY hospital_id, department_id ORDER BY interval_start))
        WHERE lag_168 IS NOT NULL""",
    "occupancy_features": """
        SELECT * FROM (
          SELECT *, hour(interval_start) AS hour, isodow(interval_start) - 1 AS weekday,
                 lag(occupied_beds, 1) OVER w AS lag_1, lag(occupied_beds, 24) OVER w AS lag_24,
                 lag(occupied_beds, 168) OVER w AS lag_168,
                 avg(occupied_beds) OVER (PARTITION BY ward_id ORDER BY interval_start
                                          ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS rolling_24
          FROM occupancy WINDOW w AS (PARTITION BY ward_id ORDER BY interval_start))
        WHERE lag_168 IS NOT NULL""",
    "wait_features": """
        SELECT w.encounter_id, w.queue_entered_at, w.department_id, a.appointment_type, a.priority_type,
               a.reminder_sent, w.weekday, w.hour, q.queue_length, q.available_doctors, q.available_rooms,
               w.wait_minutes
        FROM waiting w JOIN queue_events q USING (encounter_id)
        JOIN appointments a ON a.appointment_id = w.encounter_id""",
    "outcomes": """
        SELECT a.*, CAST(a.status = 'no_show' AS INTEGER) AS no_show,
               coalesce(e.queue_entered_at > a.scheduled_at + to_minutes(15), false) AS was_late,
               a.scheduled_at + to_minutes(60) AS available_at
        FROM appointments a LEFT JOIN encounters e USING (appointment_id)""",
    "histories": """
        SELECT d.appointment_id, count(o.appointment_id) AS historical_appointments,
               CAST(coalesce(sum(o.no_show), 0) AS BIGINT) AS historical_no_shows,
               count(*) FILTER (WHERE o.was_late) AS historical_late_arrivals,
               count(*) FILTER (WHERE o.reminder_sent) AS historical_reminders
        FROM outcomes d LEFT JOIN outcomes o
          ON o.patient_key = d.patient_key AND o.available_at < d.booking_created_at
        GROUP BY d.appointment_id""",
    "no_show_features": """
        SELECT o.appointment_id, o.patient_key, o.booking_created_at, o.department_id, o.appointment_type,
               o.priority_type,
               (epoch_us(o.scheduled_at) - epoch_us(o.booking_created_at)) / 3600000000.0::DOUBLE
                 AS booking_lead_hours,
               isodow(o.scheduled_at) - 1 AS scheduled_weekday, hour(o.scheduled_at) AS scheduled_hour,
               h.historical_appointments, h.historical_no_shows, h.historical_late_arrivals,
               h.historical_reminders,
               CASE WHEN h.historical_appointments > 0
                    THEN h.historical_no_shows / h.historical_appointments ELSE 0.0 END::DOUBLE
                 AS historical_no_show_rate,
               o.no_show
        FROM outcomes o JOIN histories h USING (appointment_id)""",
    # Positions of the split cuts among distinct times, with fractions as binary doubles.
    "wait_cuts": """
        SELECT t[greatest(1, CAST(floor(n * 0.7::DOUBLE) AS BIGINT))] AS train_end,
               t[least(greatest(greatest(1, CAST(floor(n * 0.7::DOUBLE) AS BIGINT)),
                                CAST(floor(n * 0.85::DOUBLE) AS BIGINT)), n - 2) + 1] AS validation_end
        FROM (SELECT list(DISTINCT queue_entered_at).list_sort() AS t,
                     count(DISTINCT queue_entered_at) AS n FROM encounters)""",
    "wait_split": """
        SELECT w.*, CASE WHEN queue_entered_at <= train_end THEN 'train'
                         WHEN queue_entered_at <= validation_end THEN 'validation' ELSE 'test' END AS split
        FROM waiting w, wait_cuts""",
    "arrival_cuts": """
        SELECT t[greatest(1, CAST(floor(n * 0.7::DOUBLE) AS BIGINT))] AS train_end,
               t[least(greatest(greatest(1, CAST(floor(n * 0.7::DOUBLE) AS BIGINT)),
                                CAST(floor(n * 0.85::DOUBLE) AS BIGINT)), n - 2) + 1] AS validation_end
        FROM (SELECT list(DISTINCT interval_start).list_sort() AS t,
                     count(DISTINCT interval_start) AS n FROM arrivals)""",
    "arrival_split": """
        SELECT a.*, CASE WHEN interval_start <= train_end THEN 'train'
                         WHEN interval_start <= validation_end THEN 'validation' ELSE 'test' END AS split
        FROM arrivals a, arrival_cuts""",
}
_NEEDS = {
    "appointments": ["keyed"],
    "visits": ["keyed"],
    "encounters": ["visits"],
    "raw_encounters": ["visits"],
    "queue_events": ["visits"],
    "numbered": ["keyed"],
    "bed_events": ["numbered"],
    "admissions": ["numbered"],
    "waiting": ["encounters"],
    "arrival_counts": ["encounters"],
    "arrivals": ["arrival_counts"],
    "net_changes": ["bed_events", "beds"],
    "occupancy": ["net_changes", "admissions"],
    "arrival_features": ["arrivals"],
    "occupancy_features": ["occupancy"],
    "wait_features": ["waiting", "queue_events", "appointments"],
    "outcomes": ["appointments", "encounters"],
    "histories": ["outcomes"],
    "no_show_features": ["histories"],
    "wait_cuts": ["encounters"],
    "wait_split": ["waiting", "wait_cuts"],
    "arrival_cuts": ["arrivals"],
    "arrival_split": ["arrivals", "arrival_cuts"],
}


def sql(body: str, *views: str, recursive: bool = False, **extra: str) -> str:
    """A query over named views; ``extra`` adds further common table expressions."""
    order: list[str] = []

    def need(name: str) -> None:
        for dependency in _NEEDS.get(name, []):
            need(dependency)
        if name not in order:
            order.append(name)

    for view in views:
        need(view)
    parts = [f"{v} AS ({_VIEWS[v]})" for v in order] + [f"{n} AS ({b})" for n, b in extra.items()]
    if not parts:
        return body
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(parts) + "\n" + body


def stamp(column: str, alias: str | None = None) -> str:
    """A time as text in SQL."""
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S') AS {alias or column.split('.')[-1]}"


def r6(expression: str, alias: str) -> str:
    return f"round(CAST({expression} AS DOUBLE), 6) + 0.0 AS {alias}"
