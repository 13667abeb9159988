"""Queries over features, splits and cut-offs."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsloom.catalog.registry import query, r6, rounded, sql, stamp
from opsloom.catalog.targets import arrivals, occupancy
from opsloom.functions.staging import materialize
from opsloom.operators import features as feats
from opsloom.operators.models import FeatureSet, encode, feature_names, fit_encoder
from opsloom.operators.splits import (
    capacity_threshold,
    class_counts,
    fraction_split,
    leakage_checks,
    rolling_origins,
    split_boundaries,
    split_points,
    temporal_split,
)
from opsloom.operators.targets import waiting_time_target
from opsloom.sources import views


def hospital_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "appointments": views.appointments(spark, sf_dir),
        "encounters": views.encounters(spark, sf_dir),
        "queue_events": views.queue_events(spark, sf_dir),
    }


def wait_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feats.wait_features(hospital_tables(spark, sf_dir))


def no_show_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feats.no_show_features(
        hospital_tables(spark, sf_dir), grace_minutes=60, late_minutes=15
    )


@query(
    "wait_features",
    sql(
        f"""SELECT encounter_id, {stamp("queue_entered_at")}, department_id, appointment_type, priority_type,
                   reminder_sent, weekday, hour, queue_length, available_doctors, available_rooms,
                   {r6("wait_minutes", "wait_minutes")} FROM wait_features""",
        "wait_features",
    ),
)
def wait(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(wait_rows(spark, sf_dir))


@query(
    "no_show_features",
    sql(
        f"""SELECT appointment_id, patient_key, {stamp("booking_created_at")}, department_id, appointment_type,
                   priority_type, {r6("booking_lead_hours", "booking_lead_hours")}, scheduled_weekday,
                   scheduled_hour, historical_appointments, historical_no_shows, historical_late_arrivals,
                   historical_reminders, {r6("historical_no_show_rate", "historical_no_show_rate")}, no_show
            FROM no_show_features""",
        "no_show_features",
    ),
)
def no_show(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(no_show_rows(spark, sf_dir))


@query(
    "late_arrivals",
    sql(
        """SELECT department_id, was_late, count(*) AS appointments FROM outcomes GROUP BY ALL""",
        "outcomes",
    ),
)
def late(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = hospital_tables(spark, sf_dir)
    visits = tables["encounters"].select("appointment_id", "queue_entered_at")
    joined = tables["appointments"].join(visits, "appointment_id", "left")
    flagged = joined.withColumn("was_late", feats.was_late("queue_entered_at", "scheduled_at", 15))
    return flagged.groupBy("department_id", "was_late").agg(F.count("*").alias("appointments"))


@query(
    "calendar_features",
    """SELECT hour(ts) AS hour, isodow(ts) - 1 AS weekday, (isodow(ts) >= 6)::INTEGER AS is_weekend, count(*) AS n
       FROM events GROUP BY ALL""",
)
def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = views.driver_table(spark, sf_dir, "events").select("ts")
    rows = events.withColumns(feats.calendar_columns("ts"))
    return rows.groupBy("hour", "weekday", "is_weekend").agg(F.count("*").alias("n"))


@query(
    "lag_features",
    sql(
        f"""SELECT department_id, {stamp("interval_start")}, arrivals,
                   lag(arrivals, 1) OVER w AS lag_1, lag(arrivals, 24) OVER w AS lag_24,
                   lag(arrivals, 168) OVER w AS lag_168
            FROM arrivals WINDOW w AS (PARTITION BY hospital_id, department_id ORDER BY interval_start)""",
        "arrivals",
    ),
)
def lags(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = arrivals(spark, sf_dir)
    keys = ["hospital_id", "department_id"]
    return rounded(
        target.withColumns(feats.lag_columns("arrivals", keys, "interval_start")).drop("hospital_id")
    )


@query(
    "trailing_mean",
    sql(
        f"""SELECT department_id, {stamp("interval_start")},
                   CASE WHEN count(*) OVER w = 24 THEN round(avg(arrivals) OVER w, 6) END AS rolling_24
            FROM arrivals WINDOW w AS (PARTITION BY hospital_id, department_id ORDER BY interval_start
                                       ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING)""",
        "arrivals",
    ),
)
def trailing(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["hospital_id", "department_id"]
    mean = feats.trailing_mean("arrivals", keys, "interval_start").alias("rolling_24")
    return rounded(arrivals(spark, sf_dir).select("department_id", "interval_start", mean))


@query(
    "arrival_features",
    sql(
        f"""SELECT hospital_id, department_id, {stamp("interval_start")}, arrivals, hour, weekday, is_weekend,
                   lag_1, lag_24, lag_168, {r6("rolling_24", "rolling_24")} FROM arrival_features""",
        "arrival_features",
    ),
)
def arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(feats.arrival_features(arrivals(spark, sf_dir)))


@query(
    "occupancy_features",
    sql(
        f"""SELECT ward_id, {stamp("interval_start")}, occupied_beds, staffed_capacity, expected_discharges,
                   {r6("occupancy_ratio", "occupancy_ratio")}, hour, weekday, lag_1, lag_24, lag_168,
                   {r6("rolling_24", "rolling_24")} FROM occupancy_features""",
        "occupancy_features",
    ),
)
def beds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(feats.occupancy_features(occupancy(spark, sf_dir)))


@query(
    "congestion_buckets",
    sql(
        """SELECT department_id, CASE WHEN queue_length <= 1 THEN 'low' WHEN queue_length <= 3 THEN 'medium'
                  ELSE 'high' END AS congestion, count(*) AS n FROM queue_events GROUP BY ALL""",
        "queue_events",
    ),
)
def congestion(spark: SparkSession, sf_dir: str) -> DataFrame:
    queues = views.queue_events(spark, sf_dir)
    bucket = feats.congestion_bucket(F.col("queue_length")).alias("congestion")
    return queues.groupBy("department_id", bucket).agg(F.count("*").alias("n"))


WAIT_SET = FeatureSet(feats.WAIT_CATEGORICAL, feats.WAIT_NUMERIC)
NO_SHOW_SET = FeatureSet(feats.NO_SHOW_CATEGORICAL, feats.NO_SHOW_NUMERIC)

_HOT = "\nUNION ALL ".join(
    f"SELECT '{c}_' || {c} AS feature, count(*)::DOUBLE AS square_sum FROM wait_features GROUP BY {c}"
    for c in feats.WAIT_CATEGORICAL
)
_SCALED = "\nUNION ALL ".join(
    f"""SELECT '{c}', round(sum(power(({c}::INTEGER - m) / s, 2)), 4)
        FROM wait_features, (SELECT avg({c}::INTEGER) AS m, stddev_samp({c}::INTEGER) AS s FROM wait_features)"""
    for c in feats.WAIT_NUMERIC
)


@query("encoded_features", sql(f"{_HOT}\nUNION ALL {_SCALED}", "wait_features"))
def encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = materialize(wait_rows(spark, sf_dir), "wait-features")
    encoder = fit_encoder(rows, WAIT_SET)
    names = F.array(*[F.lit(n) for n in feature_names(encoder, WAIT_SET)])
    vectors = encode(encoder, rows).select(F.posexplode(vector_to_array("features")).alias("at", "x"))
    sums = vectors.groupBy("at").agg(F.sum(F.col("x") * F.col("x")).alias("square_sum"))
    return rounded(sums.select(F.element_at(names, F.col("at") + 1).alias("feature"), "square_sum"), 4)


_BOUNDARY = """SELECT split, {first}, {last}, count(*) AS row_count FROM {view} GROUP BY split"""


def _boundary_sql(view: str, time: str) -> str:
    return sql(
        _BOUNDARY.format(
            first=stamp(f"min({time})", "first_time"), last=stamp(f"max({time})", "last_time"), view=view
        ),
        view,
    )


def waiting_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The waiting target, written once: the cut times and every part read it again."""
    return materialize(waiting_time_target(views.encounters(spark, sf_dir)), "waiting")


@query(
    "split_points",
    sql(
        """SELECT (SELECT count(DISTINCT queue_entered_at) FROM encounters) AS n,
                  epoch_us(train_end) AS train_end, epoch_us(validation_end) AS validation_end FROM wait_cuts""",
        "wait_cuts",
    ),
)
def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_points(waiting_rows(spark, sf_dir), "queue_entered_at")


@query(
    "temporal_split",
    sql(
        f"""SELECT encounter_id, split, {r6("wait_minutes", "wait_minutes")} FROM wait_split""", "wait_split"
    ),
)
def split(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = temporal_split(waiting_rows(spark, sf_dir), "queue_entered_at").labelled
    return rounded(labelled.select("encounter_id", "split", "wait_minutes"))


@query("split_boundaries", _boundary_sql("arrival_split", "interval_start"))
def boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = temporal_split(arrivals(spark, sf_dir), "interval_start")
    return rounded(split_boundaries(parts.labelled, "interval_start").withColumnRenamed("rows", "row_count"))


def _ordered_sql(view: str, time: str) -> str:
    def at(f: str, s: str) -> str:
        return f"(SELECT {f}({time}) FROM {view} WHERE split = '{s}')"

    train = f"{at('max', 'train')} < {at('min', 'validation')}"
    return f"{train} AND {at('max', 'validation')} < {at('min', 'test')}"


LEAKAGE_SQL = f"""SELECT 'waiting_split_order' AS check_name, {_ordered_sql("wait_split", "queue_entered_at")} AS passed
            UNION ALL SELECT 'arrival_split_order', {_ordered_sql("arrival_split", "interval_start")}
            UNION ALL SELECT 'waiting_features_exclude_future_events', true
            UNION ALL SELECT 'forecast_fit_precedes_test',
              (SELECT max(interval_start) FROM arrival_split WHERE split = 'train')
              < (SELECT min(interval_start) FROM arrival_split WHERE split = 'test')"""


@query("leakage_checks", sql(LEAKAGE_SQL, "wait_split", "arrival_split"))
def leakage(spark: SparkSession, sf_dir: str) -> DataFrame:
    waits = temporal_split(waiting_rows(spark, sf_dir), "queue_entered_at")
    series = temporal_split(arrivals(spark, sf_dir), "interval_start")
    return leakage_checks(waits, series)


@query(
    "fraction_split",
    """SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY o_orderdate, o_orderkey)
                <= (SELECT floor(count(*) * 0.7::DOUBLE) FROM orders) THEN 'reference' ELSE 'current' END AS part
       FROM orders""",
)
def fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = views.driver_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return fraction_split(orders, "o_orderdate", "o_orderkey").select("o_orderkey", "part")


@query(
    "rolling_origins",
    sql(
        f"""SELECT w AS window_id, {stamp("t[24 * w + 1]", "cutoff")} FROM (
              SELECT list(DISTINCT interval_start).list_sort('DESC') AS t FROM arrivals), (
              SELECT unnest([1, 2, 3]) AS w)""",
        "arrivals",
    ),
)
def origins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rolling_origins(arrivals(spark, sf_dir), 3))


@query(
    "class_counts",
    sql(
        """SELECT split, count(DISTINCT late) AS classes FROM (
             SELECT split, wait_minutes > 60 AS late FROM wait_split) GROUP BY split""",
        "wait_split",
    ),
)
def classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = temporal_split(waiting_rows(spark, sf_dir), "queue_entered_at")
    return class_counts(parts.labelled.withColumn("late", F.col("wait_minutes") > 60), "late")


@query(
    "capacity_threshold",
    """SELECT v[n - greatest(1, CAST(floor(n * 0.2::DOUBLE) AS BIGINT)) + 1] AS threshold FROM (
         SELECT list(l_extendedprice).list_sort() AS v, count(*) AS n FROM lineitem)""",
)
def threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = views.driver_table(spark, sf_dir, "lineitem")
    return capacity_threshold(items, "l_extendedprice", 0.2)
