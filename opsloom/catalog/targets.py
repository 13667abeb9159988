"""Queries over prediction targets, dense series, profiles and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsloom.catalog.registry import query, r6, rounded, sql, stamp
from opsloom.operators.profile import demand_summary, profile_dataset, queue_summary
from opsloom.operators.targets import (
    arrival_target,
    capacity_by_group,
    densify_calendar,
    expected_discharges,
    interval_counts,
    occupancy_target,
    state_violations,
    waiting_time_target,
)
from opsloom.sources import views


def arrivals(spark: SparkSession, sf_dir: str, frequency: str = "1h") -> DataFrame:
    """The hourly arrival target; keys of the view are unique by construction."""
    return arrival_target(
        views.appointments(spark, sf_dir),
        views.encounters(spark, sf_dir),
        frequency,
    )


def occupancy(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {
        "beds": views.beds(spark, sf_dir),
        "bed_events": views.bed_events(spark, sf_dir),
        "admissions": views.admissions(spark, sf_dir),
    }
    return occupancy_target(tables)


@query(
    "waiting_target",
    sql(
        f"""SELECT encounter_id, department_id, {stamp("queue_entered_at")}, {r6("wait_minutes", "wait_minutes")},
                   weekday, hour FROM waiting""",
        "waiting",
    ),
)
def waiting_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(waiting_time_target(views.encounters(spark, sf_dir)))


@query(
    "quarter_hour_counts",
    f"""SELECT event_type, {stamp("time_bucket(INTERVAL 15 MINUTE, ts)", "interval_start")}, count(*) AS n
        FROM events GROUP BY ALL""",
)
def quarter_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = views.driver_table(spark, sf_dir, "events")
    return rounded(interval_counts(events, ["event_type"], "ts", frequency="15min", out="n"))


@query(
    "interval_counts",
    f"""SELECT event_type, {stamp("date_trunc('hour', ts)", "interval_start")}, count(*) AS arrivals
        FROM events GROUP BY ALL""",
)
def hourly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = views.driver_table(spark, sf_dir, "events")
    return rounded(interval_counts(events, ["event_type"], "ts"))


@query(
    "dense_calendar",
    f"""WITH c AS (SELECT user_id, date_trunc('hour', ts) AS t, count(*) AS n FROM events GROUP BY ALL)
        SELECT g.user_id, {stamp("g.t", "interval_start")}, coalesce(c.n, 0) AS n
        FROM (SELECT user_id, unnest(generate_series(min(t), max(t), INTERVAL 1 HOUR)) AS t
              FROM c GROUP BY user_id) g LEFT JOIN c USING (user_id, t)""",
)
def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = views.driver_table(spark, sf_dir, "events")
    counts = interval_counts(events, ["user_id"], "ts", out="n")
    return rounded(densify_calendar(counts, ["user_id"], ["n"]))


_ARRIVALS_SQL = f"SELECT hospital_id, department_id, {stamp('interval_start')}, arrivals FROM arrivals"


@query("arrival_target", sql(_ARRIVALS_SQL, "arrivals"))
def arrival_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(arrivals(spark, sf_dir))


@query(
    "state_violations",
    """SELECT bed_id, event_id, event_type, previous_type FROM (
         SELECT user_id AS bed_id, event_id, CASE WHEN value > 50 THEN 'occupied' ELSE 'released' END AS event_type,
                lag(CASE WHEN value > 50 THEN 'occupied' ELSE 'released' END)
                  OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous_type FROM events)
       WHERE event_type = coalesce(previous_type, 'released')""",
)
def violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = views.driver_table(spark, sf_dir, "events").select(
        F.col("user_id").alias("bed_id"),
        F.col("event_id").alias("bed_event_id"),
        F.col("ts").alias("event_time"),
        F.when(F.col("value") > 50, "occupied").otherwise("released").alias("event_type"),
    )
    return state_violations(events).select(
        "bed_id", F.col("bed_event_id").alias("event_id"), "event_type", "previous_type"
    )


@query(
    "ward_capacity",
    sql("SELECT ward_id, count(*) AS staffed_capacity FROM beds GROUP BY ward_id", "beds"),
)
def ward_capacity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capacity_by_group(views.beds(spark, sf_dir))


@query(
    "expected_discharges",
    sql(
        f"""SELECT ward_id, {stamp("date_trunc('hour', expected_discharge_at)", "interval_start")},
                   count(*) AS expected_discharges FROM admissions GROUP BY ALL""",
        "admissions",
    ),
)
def discharges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(expected_discharges(views.admissions(spark, sf_dir)))


@query(
    "occupancy_target",
    sql(
        f"""SELECT ward_id, {stamp("interval_start")}, occupied_beds, staffed_capacity, expected_discharges,
                   {r6("occupancy_ratio", "occupancy_ratio")} FROM occupancy""",
        "occupancy",
    ),
)
def occupancy_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {
        "beds": views.beds(spark, sf_dir),
        "bed_events": views.bed_events(spark, sf_dir),
        "admissions": views.admissions(spark, sf_dir),
    }
    return rounded(occupancy_target(tables))


@query(
    "queue_summary",
    sql(
        f"""SELECT department_id, count(*) AS events, {r6("avg(queue_length)", "average_queue")},
                   {r6("quantile_cont(queue_length, 0.95)", "p95_queue")},
                   {r6("avg(available_doctors)", "average_doctors")}
            FROM queue_events GROUP BY department_id""",
        "queue_events",
    ),
)
def queues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(queue_summary(views.queue_events(spark, sf_dir)))


@query(
    "demand_summary",
    sql(
        f"""SELECT department_id, {r6("avg(arrivals)", "average_hourly_arrivals")},
                   {r6("quantile_cont(arrivals, 0.95)", "p95_hourly_arrivals")},
                   max(arrivals) AS peak_hourly_arrivals FROM arrivals GROUP BY department_id""",
        "arrivals",
    ),
)
def demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(demand_summary(arrivals(spark, sf_dir)))


_PROFILED = {
    "region": ["r_regionkey", "r_name"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
    "documents": ["doc_id", "text", "lang", "source", "n_chars"],
    "embeddings": ["vec_id", "embedding", "label"],
    "pages": ["page_id", "url", "html"],
    "benchmark": ["item_id", "text"],
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority".split(),
    "lineitem": (
        "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax "
        "l_returnflag l_linestatus l_shipdate"
    ).split(),
    "labels": ["doc_id", "quality", "toxic"],
    "conversations": ["conv_id", "turn", "role", "text"],
    "encounters": (
        "encounter_id appointment_id department_id queue_entered_at consultation_started_at "
        "consultation_ended_at checkout_at"
    ).split(),
}
_TIMED = {"encounters": ["queue_entered_at", "consultation_started_at", "consultation_ended_at", "checkout_at"]}


def _profile_sql() -> str:
    parts = []
    for t, columns in _PROFILED.items():
        whole = f"(SELECT count(*) FROM {t})"
        kinds = f"(SELECT count(*) FROM (SELECT DISTINCT * FROM {t}))"
        for measure, value in (("rows", whole), ("columns", str(len(columns))), ("duplicate_rows", f"{whole} - {kinds}")):
            parts.append(f"SELECT '{t}' AS table_name, NULL AS column_name, '{measure}' AS measure, ({value})::DOUBLE AS value, NULL AS instant")
        for c in columns:
            parts.append(f"SELECT '{t}', '{c}', 'null_rate', round(avg(({c} IS NULL)::INTEGER), 6)::DOUBLE, NULL FROM {t}")
        for c in _TIMED.get(t, []):
            for f in ("minimum", "maximum"):
                parts.append(f"SELECT '{t}', '{c}', '{f}', NULL, strftime({f[:3]}({c}), '%Y-%m-%d %H:%M:%S') FROM {t}")
    return sql("\nUNION ALL ".join(parts), "encounters")


@query("profile_tables", _profile_sql())
def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {t: views.driver_table(spark, sf_dir, t) for t in _PROFILED if t != "encounters"}
    tables["encounters"] = views.encounters(spark, sf_dir).select(*_PROFILED["encounters"])
    return rounded(profile_dataset(tables))
