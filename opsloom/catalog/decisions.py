"""Queries over forecasts of a closed-form model, policies and scenario comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsloom.catalog.evaluation import SCORED, scored_events
from opsloom.catalog.registry import query, r6, rounded, sql, stamp
from opsloom.catalog.targets import arrivals, occupancy
from opsloom.operators.forecast import LagModel, department_forecast, forecast_arrivals, forecast_occupancy
from opsloom.operators.policy import reminder_policy, retraining_gate, with_repaired_interval
from opsloom.operators.profile import alert_rows, forecast_level, occupancy_pivot
from opsloom.operators.scenario import flow_summary, max_queue_length, recommend_scenario
from opsloom.operators.splits import capacity, first_rows
from opsloom.sources import views

# Weighted lags stand in for a learned model, so every step can be recomputed in SQL.
STAND_IN = LagModel({"lag_1": 0.3, "lag_24": 0.4, "lag_168": 0.2, "rolling_24": 0.1}, below=0.5, above=1.5)
_VALUE = "0.3 * v[168] + 0.4 * v[145] + 0.2 * v[1] + 0.1 * (list_sum(v[145:168]) / 24.0::DOUBLE)"


def _recursion(target: str, keys: tuple[str, ...], value: str, top: str | None = None, carry: str = "") -> dict[str, str]:
    """Recursive SQL twin of the forecast: 168 newest values per group, one step per level."""
    k = ", ".join(keys)
    on = " AND ".join(f"t.{c} = m.{c}" for c in keys)
    groups = ", ".join(f"t.{c}" for c in keys)
    clip = f"greatest(0.0, {{0}})" if top is None else f"least(greatest(0.0, {{0}}), {top})"
    carried = f", arg_max({carry}, interval_start) AS {carry}" if carry else ""
    c2 = f", {carry}" if carry else ""
    raw = f"({_VALUE})"
    return {
        "state0": f"""SELECT {groups}, m.last_time, list(t.{value}::DOUBLE ORDER BY t.interval_start) AS v{carried}
                      FROM {target} t JOIN (SELECT {k}, max(interval_start) AS last_time FROM {target} GROUP BY ALL) m
                        ON {on} WHERE t.interval_start > m.last_time - INTERVAL 168 HOUR GROUP BY {groups}, m.last_time""",
        "steps": f"""SELECT {k}{c2}, last_time, 0 AS step, v, 0.0::DOUBLE AS raw, 0.0::DOUBLE AS point FROM state0
                     UNION ALL
                     SELECT {k}{c2}, last_time, step + 1, v[2:168] || [{clip.format(raw)}::DOUBLE], {raw}::DOUBLE,
                            {clip.format(raw)}::DOUBLE FROM steps WHERE step < 24""",
        "forecast": f"""SELECT {k}{c2}, last_time + to_hours(step) AS interval_start, step, point,
                               {clip.format("least(raw - 0.5, point)")} AS lower,
                               {clip.format("greatest(raw + 1.5, point)")} AS upper
                        FROM steps WHERE step > 0""",
    }


_ARRIVAL_STEPS = _recursion("arrivals", ("hospital_id", "department_id"), "arrivals")
_BED_STEPS = _recursion("occupancy", ("ward_id",), "occupied_beds", "staffed_capacity", "staffed_capacity")
_DEPARTMENTS = f"""
    SELECT {stamp("interval_start")}, hospital_id, department_id, {r6("point", "predicted_arrivals")},
           {r6("lower", "lower_arrivals")}, {r6("upper", "upper_arrivals")} FROM forecast"""


@query(
    "recursive_forecast",
    sql(_DEPARTMENTS, "arrivals", recursive=True, **_ARRIVAL_STEPS),
)
def recursive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(department_forecast(arrivals(spark, sf_dir), STAND_IN, 24))


_RECONCILED = f"""
    SELECT {stamp("interval_start")}, hospital_id, department_id, 'department' AS level,
           {r6("point", "predicted_arrivals")}, {r6("lower", "lower_arrivals")}, {r6("upper", "upper_arrivals")}
    FROM forecast WHERE step <= 12
    UNION ALL
    SELECT {stamp("interval_start")}, hospital_id, NULL, 'hospital', {r6("sum(point)", "predicted_arrivals")},
           {r6("sum(lower)", "lower_arrivals")}, {r6("sum(upper)", "upper_arrivals")}
    FROM forecast WHERE step <= 12 GROUP BY interval_start, hospital_id"""


@query("reconciled_forecast", sql(_RECONCILED, "arrivals", recursive=True, **_ARRIVAL_STEPS))
def reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(forecast_arrivals(arrivals(spark, sf_dir), STAND_IN, 12))


@query(
    "hospital_forecast_view",
    sql(
        f"SELECT * FROM ({_RECONCILED}) WHERE level = 'hospital'",
        "arrivals",
        recursive=True,
        **_ARRIVAL_STEPS,
    ),
)
def hospital_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(forecast_level(forecast_arrivals(arrivals(spark, sf_dir), STAND_IN, 12), "hospital"))


_BEDS = f"""
    SELECT {stamp("interval_start")}, ward_id, staffed_capacity, {r6("point", "predicted_occupied_beds")},
           {r6("lower", "lower_occupied_beds")}, {r6("upper", "upper_occupied_beds")},
           {r6("point / staffed_capacity", "predicted_occupancy_ratio")},
           point / staffed_capacity >= 0.45 AS capacity_alert
    FROM forecast"""


@query("occupancy_forecast", sql(_BEDS, "occupancy", recursive=True, **_BED_STEPS))
def bed_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(forecast_occupancy(occupancy(spark, sf_dir), STAND_IN, 24, 0.45))


@query(
    "capacity_alert_rows",
    sql(f"SELECT * FROM ({_BEDS}) WHERE capacity_alert", "occupancy", recursive=True, **_BED_STEPS),
)
def bed_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(alert_rows(forecast_occupancy(occupancy(spark, sf_dir), STAND_IN, 24, 0.45)))


_WARDS = ("0", "1", "2", "3", "4")


@query(
    "occupancy_pivot",
    sql(
        f"""SELECT {stamp("interval_start")}, {", ".join(
            f'max(CASE WHEN ward_id = {chr(39)}{w}{chr(39)} THEN round(occupancy_ratio, 6) END) AS "{w}"' for w in _WARDS
        )} FROM occupancy GROUP BY interval_start""",
        "occupancy",
    ),
)
def pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = occupancy(spark, sf_dir).withColumnRenamed("occupancy_ratio", "predicted_occupancy_ratio")
    return rounded(occupancy_pivot(points, _WARDS))


@query(
    "repaired_intervals",
    """SELECT l_orderkey, l_linenumber, l_partkey, greatest(0, p) AS p,
              greatest(0, least(lo, greatest(0, p))) AS lo, greatest(greatest(0, p), up) AS up
       FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity - 10 AS p, l_quantity - 15 + l_linenumber * 2 AS lo,
                    l_quantity - 12 + l_linenumber AS up FROM lineitem)""",
)
def repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = views.driver_table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        (F.col("l_quantity") - 10).alias("p"),
        (F.col("l_quantity") - 15 + F.col("l_linenumber") * 2).alias("lo"),
        (F.col("l_quantity") - 12 + F.col("l_linenumber")).alias("up"),
    )
    return rounded(with_repaired_interval(items, "p", "lo", "up"))


@query(
    "reminder_policy",
    sql(
        f"""SELECT (SELECT count(*) FROM scored) AS appointments, count(*) AS reminder_capacity,
                   sum(actual)::BIGINT AS observed_no_shows_prioritized,
                   {r6("sum(actual) / (SELECT greatest(sum(actual), 1) FROM scored)", "recall_at_capacity")},
                   {r6("sum(actual) * 0.25", "estimated_slots_recovered")}, false AS automatic_cancellation
            FROM (SELECT * FROM scored ORDER BY p DESC, event_id
                  LIMIT (SELECT greatest(1, floor(count(*) * 0.2::DOUBLE)::BIGINT) FROM scored))""",
        "keyed",
        scored=SCORED,
    ),
)
def reminders(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = scored_events(spark, sf_dir)
    return rounded(
        reminder_policy(scores, "actual", "p", "event_id", capacity_fraction=0.2, effectiveness=0.25)
    )


@query(
    "reminder_policy_text_ids",
    sql(
        """SELECT id, actual FROM (
             SELECT 'a' || CAST(event_id AS VARCHAR) AS id, actual, round(p, 1) AS coarse FROM scored)
           ORDER BY coarse DESC, id LIMIT (SELECT greatest(1, floor(count(*) * 0.2::DOUBLE)::BIGINT) FROM scored)""",
        "keyed",
        scored=SCORED,
    ),
)
def reminders_by_text_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chosen rows themselves; coarse scores make long runs of ties for the text ids to break."""
    scores = scored_events(spark, sf_dir).select(
        F.concat(F.lit("a"), F.col("event_id").cast("string")).alias("id"), "actual", F.round("p", 1).alias("coarse")
    )
    chosen = first_rows(scores, -F.col("coarse"), "id", lambda n: capacity(n, 0.2))
    return scores.where(chosen).select("id", "actual")


@query(
    "retraining_gate",
    f"""SELECT l_returnflag, {r6("c", "current_value")}, {r6("d", "candidate_value")}, blocked,
               triggered AND NOT blocked AS retrain, {r6("(c - d) / abs(c)", "relative_gain")},
               triggered AND NOT blocked AND (c - d) / abs(c) >= 0.02 AS promote
        FROM (SELECT l_returnflag, avg(abs(l_quantity * 2000 - l_extendedprice)) AS c,
                     avg(abs(l_quantity * 1500 - l_extendedprice)) AS d FROM lineitem GROUP BY 1),
             (SELECT bool_or(component = 'data_quality') AS blocked, bool_or(component = 'drift') AS triggered
              FROM (SELECT CASE WHEN o_orderpriority LIKE '1%' THEN 'drift' ELSE 'none' END AS component FROM orders))""",
)
def gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = views.driver_table(spark, sf_dir, "lineitem")
    metrics = items.groupBy("l_returnflag").agg(
        F.avg(F.abs(F.col("l_quantity") * 2000 - F.col("l_extendedprice"))).alias("current_value"),
        F.avg(F.abs(F.col("l_quantity") * 1500 - F.col("l_extendedprice"))).alias("candidate_value"),
    )
    orders = views.driver_table(spark, sf_dir, "orders")
    component = F.when(F.col("o_orderpriority").startswith("1"), "drift").otherwise("none")
    alerts = orders.select(component.alias("component"))
    return rounded(retraining_gate(alerts, metrics, minimum_improvement=0.02))


_SCENARIO = """(['baseline', 'doctor_shortage', 'additional_staffing'])[k % 3 + 1]"""


def scenario_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encounters tagged with a scenario; the staffed one serves in two thirds of the wait."""
    e = views.keyed_events(spark, sf_dir).where("k % 4 <> 0")
    names = F.array(*[F.lit(s) for s in ("baseline", "doctor_shortage", "additional_staffing")])
    seconds = F.when(F.col("k") % 3 == 2, F.floor(F.col("value") * 40)).otherwise(F.floor(F.col("value") * 60))
    started = F.timestamp_add("SECOND", seconds.cast("int"), F.col("ts"))
    return e.select(
        F.element_at(names, F.col("k") % 3 + 1).alias("scenario"),
        F.col("ts").alias("queue_entered_at"),
        started.alias("consultation_started_at"),
        F.timestamp_add("MINUTE", F.lit(16), started).alias("consultation_ended_at"),
    )


_FLOW = f"""
    SELECT {_SCENARIO} AS scenario, ts AS entered,
           ts + to_seconds((CASE WHEN k % 3 = 2 THEN floor(value * 40) ELSE floor(value * 60) END)::INTEGER) AS started
    FROM keyed WHERE k % 4 <> 0"""
_QUEUE = """
    SELECT scenario, max(waiting)::BIGINT AS max_queue_length FROM (
      SELECT scenario, sum(d) OVER (PARTITION BY scenario ORDER BY t) AS waiting
      FROM (SELECT scenario, entered AS t, 1 AS d FROM flow UNION ALL SELECT scenario, started, -1 FROM flow))
    GROUP BY scenario"""
_SUMMARY = """
    SELECT scenario, doctors, arrivals, arrivals AS completed, mean_wait_minutes, p50_wait_minutes, p90_wait_minutes,
           max_queue_length, busy / greatest(doctors * elapsed, 1.0) AS resource_utilization
    FROM (SELECT scenario, count(*) AS arrivals, avg(w) AS mean_wait_minutes,
                 quantile_cont(w, 0.5) AS p50_wait_minutes, quantile_cont(w, 0.9) AS p90_wait_minutes,
                 sum(16.0::DOUBLE) AS busy,
                 (epoch_us(max(started) + to_minutes(16)) - epoch_us(min(entered))) / 60000000.0::DOUBLE AS elapsed
          FROM (SELECT *, (epoch_us(started) - epoch_us(entered)) / 60000000.0::DOUBLE AS w FROM flow) GROUP BY scenario)
    JOIN queues USING (scenario)
    JOIN (SELECT {scenario} AS scenario, (max(user_id % 4) + 2 + max(CASE WHEN k % 3 = 2 THEN 1 ELSE 0 END)
            - max(CASE WHEN k % 3 = 1 THEN 1 ELSE 0 END))::BIGINT AS doctors FROM keyed GROUP BY 1) USING (scenario)""".replace(
    "{scenario}", _SCENARIO
)


def _resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = views.keyed_events(spark, sf_dir)
    names = F.array(*[F.lit(s) for s in ("baseline", "doctor_shortage", "additional_staffing")])
    step = F.col("k") % 3
    return e.groupBy(F.element_at(names, step + 1).alias("scenario")).agg(
        (
            F.max(F.col("user_id") % 4)
            + 2
            + F.max(F.when(step == 2, 1).otherwise(0))
            - F.max(F.when(step == 1, 1).otherwise(0))
        ).alias("doctors")
    )


@query("max_queue_length", sql("SELECT * FROM queues", "keyed", flow=_FLOW, queues=_QUEUE))
def longest_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return max_queue_length(scenario_rows(spark, sf_dir))


@query(
    "flow_summary",
    sql(
        f"""SELECT scenario, doctors, arrivals, completed, {r6("mean_wait_minutes", "mean_wait_minutes")},
                   {r6("p50_wait_minutes", "p50_wait_minutes")}, {r6("p90_wait_minutes", "p90_wait_minutes")},
                   max_queue_length, {r6("resource_utilization", "resource_utilization")} FROM summary""",
        "keyed",
        flow=_FLOW,
        queues=_QUEUE,
        summary=_SUMMARY,
    ),
)
def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(flow_summary(scenario_rows(spark, sf_dir), _resources(spark, sf_dir)))


@query(
    "scenario_recommendation",
    sql(
        f"""SELECT CASE WHEN extra > 0 AND gain >= 5 THEN 'additional_staffing' ELSE 'baseline' END AS recommended_scenario,
                   CASE WHEN extra > 0 AND gain >= 5 THEN extra ELSE 0 END AS additional_doctors,
                   {r6("gain", "expected_p90_wait_reduction_minutes")},
                   CASE WHEN extra > 0 AND gain >= 5
                        THEN 'Additional staffing meets the configured P90 wait-improvement threshold.'
                        ELSE 'Keep baseline staffing; constrained improvement is below the required threshold.' END AS reason,
                   true AS human_approval_required, false AS automatically_applied
            FROM (SELECT max(doctors) FILTER (WHERE scenario = 'additional_staffing')
                           - max(doctors) FILTER (WHERE scenario = 'baseline') AS extra,
                         greatest(0.0, max(p90_wait_minutes) FILTER (WHERE scenario = 'baseline')
                           - max(p90_wait_minutes) FILTER (WHERE scenario = 'additional_staffing')) AS gain
                  FROM summary)""",
        "keyed",
        flow=_FLOW,
        queues=_QUEUE,
        summary=_SUMMARY,
    ),
)
def recommendation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = flow_summary(scenario_rows(spark, sf_dir), _resources(spark, sf_dir))
    return rounded(recommend_scenario(rows, minimum_p90_improvement_minutes=5))
