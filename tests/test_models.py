"""Properties of learned models on small data with a known relation."""

from datetime import datetime, timedelta, timezone

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from opsloom.errors import FeatureSchemaMismatchError, ForecastHorizonError, TrainingDataError
from opsloom.operators.forecast import (
    LagModel,
    OCCUPANCY_FEATURES,
    department_forecast,
    fit_series_model,
    forecast_arrivals,
    forecast_occupancy,
)
from opsloom.operators.features import occupancy_features
from opsloom.operators.models import IntervalModel, NoShowModel, TrainingSettings, apply_sigmoid, fit_sigmoid, ridge, score_no_show, score_wait_time
from opsloom.plans.training import (
    NO_SHOW_FEATURES,
    WAIT_FEATURES,
    backtest_arrivals,
    backtest_occupancy,
    publish_version,
    train_no_show,
    train_wait_time,
)

START = datetime(2026, 1, 1, tzinfo=timezone.utc)
TINY = TrainingSettings(trees=5, boosting_rounds=5, interval_leaf_rows=20)


@pytest.fixture(scope="module")
def hospital(spark):
    """Waits grow with the queue; no-shows with the lead time."""
    n = 1_200
    base = spark.range(n, numPartitions=4).select(
        F.col("id").cast("string").alias("appointment_id"),
        (F.col("id") % 40).cast("string").alias("patient_key"),
        F.when(F.col("id") % 3 == 0, "d1").otherwise("d2").alias("department_id"),
        F.when(F.col("id") % 2 == 0, "new").otherwise("follow_up").alias("appointment_type"),
        F.when(F.col("id") % 5 == 0, "urgent").otherwise("routine").alias("priority_type"),
        F.timestamp_seconds(F.lit(1_767_225_600) + F.col("id") * 1_800).alias("booking_created_at"),
        (F.hash("id") % 100).alias("h"),
    )
    late = F.pmod(F.col("h"), F.lit(60))
    rows = base.withColumns({
        "scheduled_at": F.timestamp_add("HOUR", (late + 1).cast("int"), F.col("booking_created_at")),
        "reminder_sent": F.col("h") % 2 == 0,
        "status": F.when(late + F.pmod(F.hash("appointment_id"), F.lit(20)) > 45, "no_show").otherwise("completed"),
        "hospital_id": F.lit("h"),
    })
    visits = rows.where("status = 'completed'").withColumn("queue", F.pmod(F.hash("patient_key", "h"), F.lit(8)))
    encounters = visits.select(
        F.col("appointment_id").alias("encounter_id"),
        "appointment_id",
        "department_id",
        F.col("scheduled_at").alias("queue_entered_at"),
        F.timestamp_add("SECOND", (F.col("queue") * 300 + F.pmod(F.col("h"), F.lit(90))).cast("int"), F.col("scheduled_at")).alias("consultation_started_at"),
    )
    queues = visits.select(
        F.col("appointment_id").alias("encounter_id"),
        F.col("queue").cast("bigint").alias("queue_length"),
        F.lit(2).cast("bigint").alias("available_doctors"),
        F.lit(3).cast("bigint").alias("available_rooms"),
    )
    tables = {"appointments": rows.drop("h"), "encounters": encounters, "queue_events": queues}
    return {k: v.cache() for k, v in tables.items()}


def test_ridge_equals_closed_form(spark):
    x, y, alpha = np.array([1.0, 2.0, 4.0]), np.array([1.0, 3.0, 5.0]), 1.0
    rows = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    encoded = VectorAssembler(inputCols=["x"], outputCol="features").transform(rows)
    model = ridge(encoded, "y", alpha).fit(encoded)
    centred = x - x.mean()
    want = (centred * (y - y.mean())).sum() / ((centred**2).sum() + alpha)
    assert model.coefficients[0] == pytest.approx(want, rel=1e-6)


def test_platt_equals_newton(spark):
    rng = np.random.default_rng(1)
    s = np.round(rng.normal(size=300), 2)
    y = (rng.random(300) < 1 / (1 + np.exp(-1.3 * s + 0.4))).astype(int)
    frame = spark.createDataFrame([(float(a), int(b)) for a, b in zip(s, y)], "s double, y int")
    model = fit_sigmoid(frame, "s", "y")
    t = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
    X, w = np.column_stack([s, np.ones_like(s)]), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-X @ w))
        w -= np.linalg.solve(-(X.T * (p * (1 - p))) @ X, X.T @ (t - p))
    assert (model.coefficients[0], model.intercept) == pytest.approx(tuple(w), rel=1e-4)
    first = apply_sigmoid(frame, model, "s", "p").first()
    assert first.p == pytest.approx(1 / (1 + np.exp(-(w[0] * s[0] + w[1]))), rel=1e-4)


def test_wait_model_beats_the_median_and_reloads(spark, hospital, tmp_path):
    run = train_wait_time(hospital, TINY)
    report = {(r.stage, r.model, r.metric): r.value for r in run.report.collect()}
    assert report["test", run.selected, "mae"] < report["test", "median_baseline", "mae"]
    assert 0 <= report["test", run.selected, "interval_coverage"] <= 1
    rows = run.predictions.collect()
    assert all(0 <= r.lower_wait_minutes <= r.predicted_wait_minutes <= r.upper_wait_minutes for r in rows)
    top = run.importance.collect()
    assert 0 < len(top) <= 20 and top[0].feature == "queue_length"
    assert {r.dimension for r in run.slices.collect()} == {"department_id", "congestion"}
    path = publish_version(spark, run.model, str(tmp_path), "v1")
    again = IntervalModel.load(spark, path, WAIT_FEATURES)
    key = ["encounter_id", "predicted_wait_minutes"]
    frame = run.predictions.select("encounter_id", *WAIT_FEATURES.columns)
    assert {tuple(r) for r in score_wait_time(again, frame).select(key).collect()} == {
        (r.encounter_id, r.predicted_wait_minutes) for r in rows
    }
    with pytest.raises(Exception, match="exist"):
        publish_version(spark, run.model, str(tmp_path), "v1")
    with pytest.raises(FeatureSchemaMismatchError):
        score_wait_time(again, frame.drop("hour"))
    with pytest.raises(FeatureSchemaMismatchError):
        score_wait_time(again, frame.withColumn("hour", F.lit(None).cast("int")))


def test_no_show_model(spark, hospital, tmp_path):
    run = train_no_show(hospital, TINY, capacity_fraction=0.2, effectiveness=0.25, maximum_ece=0.4)
    assert run.selected in ("random_forest", "gradient_boosting")
    assert "reminder_sent" not in NO_SHOW_FEATURES.columns
    policy = run.policy.first()
    assert policy.reminder_capacity == max(1, int(policy.appointments * 0.2))
    rows = run.predictions.collect()
    assert all(0 < r.no_show_probability < 1 for r in rows)
    assert all(r.reminder_priority == (r.no_show_probability >= run.model.reminder_threshold) for r in rows)
    run.model.save(str(tmp_path / "m"), spark)
    again = NoShowModel.load(spark, str(tmp_path / "m"), NO_SHOW_FEATURES)
    frame = run.predictions.select("appointment_id", *NO_SHOW_FEATURES.columns)
    got = {r.appointment_id: r.no_show_probability for r in score_no_show(again, frame).collect()}
    assert got == pytest.approx({r.appointment_id: r.no_show_probability for r in rows})
    with pytest.raises(TrainingDataError, match="calibration"):
        train_no_show(hospital, TINY, capacity_fraction=0.2, effectiveness=0.25, maximum_ece=1e-9)


def _arrivals(spark):
    rows = []
    for department, offset in (("a", 0), ("b", 2)):
        for i in range(336):
            t = START + timedelta(hours=i)
            rows.append(("h", department, t, offset + 2 + 4 * (9 <= t.hour <= 17) + t.weekday() % 2))
    return spark.createDataFrame(
        rows, "hospital_id string, department_id string, interval_start timestamp, arrivals bigint"
    )


def _beds(spark):
    rows = []
    for ward, cap, offset in (("wa", 20, 7), ("wb", 10, 3)):
        for i in range(336):
            t = START + timedelta(hours=i)
            beds = min(cap, offset + (9 if 10 <= t.hour <= 18 else 3) + t.weekday() % 2)
            rows.append((ward, t, beds, cap, int(t.hour == 11), beds / cap))
    return spark.createDataFrame(
        rows,
        "ward_id string, interval_start timestamp, occupied_beds bigint, staffed_capacity bigint, "
        "expected_discharges bigint, occupancy_ratio double",
    )


def test_recursion_equals_a_python_loop(spark):
    target = _arrivals(spark)
    model = LagModel({"lag_1": 0.5, "lag_24": 0.3, "rolling_24": 0.2})
    got = {
        (r.department_id, r.interval_start): r.predicted_arrivals
        for r in department_forecast(target, model, 12).collect()
    }
    for department in ("a", "b"):
        rows = target.where(F.col("department_id") == department).orderBy("interval_start").collect()
        values, last = [float(r.arrivals) for r in rows], rows[-1].interval_start
        for step in range(1, 13):
            values.append(0.5 * values[-1] + 0.3 * values[-24] + 0.2 * sum(values[-24:]) / 24)
            assert got[department, last + timedelta(hours=step)] == pytest.approx(values[-1])
    assert len(got) == 24


def test_forecast_horizons_and_history(spark):
    with pytest.raises(ForecastHorizonError):
        forecast_arrivals(_arrivals(spark), LagModel({"lag_1": 1.0}), 5)
    short = _arrivals(spark).where(F.col("interval_start") < F.lit(START + timedelta(hours=100)))
    with pytest.raises(TrainingDataError):
        forecast_arrivals(short, LagModel({"lag_1": 1.0}), 6)


def test_learned_occupancy_stays_within_capacity(spark):
    target = _beds(spark)
    model = fit_series_model(occupancy_features(target), OCCUPANCY_FEATURES, "occupied_beds", TINY)
    points = forecast_occupancy(target, model, 6, 0.8).collect()
    assert len(points) == 12
    for p in points:
        assert 0 <= p.lower_occupied_beds <= p.predicted_occupied_beds <= p.upper_occupied_beds <= p.staffed_capacity
        assert p.capacity_alert == (p.predicted_occupied_beds / p.staffed_capacity >= 0.8)


def test_backtest_reports_all_horizons(spark):
    report = backtest_arrivals(_arrivals(spark), TINY, windows=2).collect()
    assert {r.horizon for r in report} == {6, 12, 24}
    assert {r.model for r in report} >= {"gradient_boosting", "seasonal_mean"}
    assert {r.metric for r in report} == {"mae", "rmse", "wape", "bias", "peak_mae", "interval_coverage"}


def test_occupancy_backtest(spark):
    report = backtest_occupancy(_beds(spark), TINY, alert_threshold=0.8, windows=2).collect()
    assert {"alert_recall", "false_alert_rate", "mae_beds", "interval_coverage"} <= {r.metric for r in report}
