import numpy as np
import pytest
from pyspark.sql import functions as F

from opsloom.errors import DataQualityError, RecommendationConstraintError
from opsloom.operators import monitoring as mon
from opsloom.operators.policy import (
    capacity_alerts,
    reconcile_bottom_up,
    reminder_policy,
    retraining_gate,
    with_repaired_interval,
)
from opsloom.operators.scenario import recommend_scenario


def scores(frame):
    return {r.feature: r.score for r in frame.collect()}


@pytest.fixture(scope="module")
def sides(spark):
    old = [(float(i), "ab"[i % 2], True) for i in range(100)]
    new = [(None if i == 100 else float(i), "c", False) for i in range(100, 200)]
    ddl = "queue_length double, department string, flag boolean"
    return spark.createDataFrame(old, ddl), spark.createDataFrame(new, ddl)


def numpy_psi(old, new, bins=10):
    edges = np.unique(np.quantile(old, np.linspace(0, 1, bins + 1)))
    edges[0], edges[-1] = -np.inf, np.inf
    a = np.clip(np.histogram(old, edges)[0] / len(old), 1e-6, None)
    b = np.clip(np.histogram(new, edges)[0] / len(new), 1e-6, None)
    return ((b - a) * np.log(b / a)).sum()


def test_report(spark, sides):
    ddl = "metric string, value double"
    before = spark.createDataFrame([("mae", 10.0), ("recall", 0.8), ("gone", 1.0)], ddl)
    after = spark.createDataFrame([("mae", 15.0), ("recall", 0.6)], ddl)
    report = mon.monitoring_report(*sides, before, after, ["queue_length", "department"])
    checks = report.checks
    rows = {r.metric: r for r in checks.collect()}
    assert rows["department"].observed == 1.0
    assert rows["mae"].observed == pytest.approx(0.5) and rows["gone"].observed == 1.0
    assert rows["missing_rate"].observed == pytest.approx(1 / 200)
    assert {r.component for r in mon.alerts(checks).collect()} >= {"drift", "performance"}
    status = mon.monitoring_status(report).first()
    assert (status.status, status.reference_rows, status.current_rows) == ("review_required", 100, 100)
    old, new = sides
    with pytest.raises(DataQualityError):
        mon.monitoring_report(old, new.limit(0), before, after, ["department"])
    with pytest.raises(DataQualityError, match="absent"):
        mon.monitoring_report(old, new, before, after, ["absent"])


def test_psi_equals_numpy(spark):
    rng = np.random.default_rng(9)
    old, new = np.round(rng.gamma(2, 3, 3000), 1), np.round(rng.gamma(2, 4, 2000), 1)
    frames = [spark.createDataFrame([(float(v),) for v in x], "v double") for x in (old, new)]
    assert scores(mon.numeric_drift(*frames, ["v"]))["v"] == pytest.approx(numpy_psi(old, new))


def test_constant_and_empty_columns(spark):
    ddl = "same double, moved double, gone double"
    old = spark.createDataFrame([(1.0, 1.0, 1.0)] * 3, ddl)
    new = spark.createDataFrame([(1.0, 2.0, None)] * 3, ddl)
    assert scores(mon.numeric_drift(old, new, ["same", "moved", "gone"])) == {
        "same": 0.0, "moved": 1.0, "gone": 1.0,
    }


def test_wide_counts_take_one_pass(spark, sides):
    edges = mon._edges(sides[0], ["queue_length"], 4)
    assert edges == {"queue_length": [0.0, 24.75, 49.5, 74.25, 99.0]}
    row = mon._wide_counts(sides[1], edges, ["queue_length", "department"]).first()
    assert (row.rows, row.nulls, row.c0.n, row.c0.far, row.c0.reach) == (100, 1, 99, 99, [99, 99, 99])
    plan = mon._wide_counts(sides[1], edges)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan and "Generate" not in plan


def test_flags_are_numbers_and_bins_at_least_two(sides):
    found = scores(mon.feature_drift(*sides))
    assert set(found) == {"queue_length", "department", "flag"}
    assert found["flag"] == 1.0
    with pytest.raises(ValueError):
        mon.numeric_drift(*sides, ["queue_length"], 1)


def test_duplicates_and_absent_columns(spark):
    rows = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    assert mon.duplicate_rate(rows).first().duplicate_rate == pytest.approx(1 / 3)
    assert mon.missing_rate(rows, ["a", "b", "zz"]).first().missing_rate == pytest.approx(5 / 9)


def test_interval_repair(spark):
    rows = spark.createDataFrame([(-1.0, 2.0, -3.0, 10), (20.0, 10.0, 30.0, 10)], "p double, lo double, up double, cap int")
    free = with_repaired_interval(rows, "p", "lo", "up").collect()
    assert [(r.p, r.lo, r.up) for r in free] == [(0.0, 0.0, 0.0), (20.0, 10.0, 30.0)]
    capped = with_repaired_interval(rows, "p", "lo", "up", "cap").collect()
    assert (capped[1].p, capped[1].lo, capped[1].up) == (10.0, 10.0, 10.0)


def test_reminders_fill_capacity_despite_ties(spark):
    rows = [(i, i % 2, 0.7 if i < 50 else 0.1) for i in range(100)]
    frame = spark.createDataFrame(rows, "id bigint, y int, p double")
    row = reminder_policy(frame, "y", "p", "id", capacity_fraction=0.2, effectiveness=0.25).first()
    assert (row.appointments, row.reminder_capacity, row.observed_no_shows_prioritized) == (100, 20, 10)
    assert row.recall_at_capacity == 0.2 and row.estimated_slots_recovered == 2.5
    assert row.automatic_cancellation is False


def test_alert_from_threshold_on(spark):
    rows = spark.createDataFrame([(8.0, 10), (7.9, 10)], "predicted_occupied_beds double, staffed_capacity int")
    assert [r.capacity_alert for r in capacity_alerts(rows, 0.8).collect()] == [True, False]


def test_hospital_is_the_sum_of_departments(spark):
    ddl = "interval_start timestamp_ntz, hospital_id string, department_id string, predicted_arrivals double, lower_arrivals double, upper_arrivals double"
    from datetime import datetime

    t = datetime(2026, 1, 1)
    rows = [(t, "h", "a", 5.0, 3.0, 7.0), (t, "h", "b", 1.0, 0.0, 2.0)]
    points = reconcile_bottom_up(spark.createDataFrame(rows, ddl)).where("level = 'hospital'").collect()
    assert [(p.department_id, p.predicted_arrivals, p.lower_arrivals, p.upper_arrivals) for p in points] == [(None, 6.0, 3.0, 9.0)]


@pytest.mark.parametrize(
    ("components", "candidate", "retrain", "promote"),
    [
        (["drift"], 9.0, True, True),
        (["drift"], 9.9, True, False),
        (["drift", "data_quality"], 5.0, False, False),
        ([], 5.0, False, False),
    ],
)
def test_gate(spark, components, candidate, retrain, promote):
    alerts = spark.createDataFrame([(c,) for c in components], "component string")
    metrics = spark.createDataFrame([(10.0, candidate)], "current_value double, candidate_value double")
    row = retraining_gate(alerts, metrics, minimum_improvement=0.02).first()
    assert (row.retrain, row.promote) == (retrain, promote)


def test_recommendation(spark):
    ddl = "scenario string, doctors int, p90_wait_minutes double"
    rows = [("baseline", 3, 30.0), ("additional_staffing", 4, 20.0)]
    row = recommend_scenario(spark.createDataFrame(rows, ddl), minimum_p90_improvement_minutes=1).first()
    assert row.recommended_scenario == "additional_staffing" and row.additional_doctors == 1
    assert row.human_approval_required and not row.automatically_applied
    row = recommend_scenario(spark.createDataFrame(rows, ddl), minimum_p90_improvement_minutes=50).first()
    assert row.recommended_scenario == "baseline" and row.additional_doctors == 0
    fewer = spark.createDataFrame([("baseline", 3, 30.0), ("additional_staffing", 2, 20.0)], ddl)
    with pytest.raises(RecommendationConstraintError):
        recommend_scenario(fewer, minimum_p90_improvement_minutes=1)
