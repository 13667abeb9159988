"""Queries over learned models. Where their numbers depend on the learner only rows are checked."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsloom.catalog.evaluation import scored_events
from opsloom.catalog.features import hospital_tables, wait_rows
from opsloom.catalog.registry import query, rounded, sql
from opsloom.catalog.targets import arrivals, occupancy
from opsloom.functions.staging import materialize, new_path
from opsloom.operators.boosting import HistogramModel, Tree, score_by_boxes
from opsloom.operators.metrics import interval_coverage
from opsloom.operators.models import (
    TrainingSettings,
    apply_sigmoid,
    encode,
    fit_encoder,
    fit_intervals,
    fit_sigmoid,
    log_odds,
)
from opsloom.operators.policy import with_repaired_interval
from opsloom.operators.splits import temporal_split
from opsloom.plans.retraining import retrain_wait_time
from opsloom.plans.training import (
    WAIT_FEATURES,
    backtest_arrivals,
    backtest_occupancy,
    train_arrivals,
    train_no_show,
    train_occupancy,
    train_wait_time,
)
from opsloom.sources.versions import version_records

# The models as they are trained in use: 100 trees, 100 rounds, forests as deep as the library allows.
FULL = TrainingSettings()
# Small models keep the check short; they read all rows and run all checks.
SMALL = TrainingSettings(trees=10, boosting_rounds=8, forest_depth=10)
# The retraining query trains twice, and its outcome does not depend on the size of the models.
SMALLEST = TrainingSettings(trees=2, boosting_rounds=2, forest_depth=5)


@query("train_wait_time")
def wait_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The events hold no relation between a visit's features and its wait, so the gate does not
    # raise; its outcome is a row of the report.
    run = train_wait_time(
        hospital_tables(spark, sf_dir), FULL, require_gain=False
    )
    return rounded(run.report)


@query("wait_time_importance")
def wait_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = train_wait_time(
        hospital_tables(spark, sf_dir), SMALL, require_gain=False
    )
    return rounded(run.importance)


@query("leaf_intervals")
def leaf_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test coverage of the 10 % to 90 % intervals."""
    parts = temporal_split(wait_rows(spark, sf_dir), "queue_entered_at")
    encoder = fit_encoder(parts.development, WAIT_FEATURES)
    intervals = fit_intervals(encode(encoder, parts.development), "wait_minutes", SMALL)
    bounded = intervals.add(encode(encoder, parts.test))
    return rounded(interval_coverage(bounded, "wait_minutes", "lower", "upper", ["department_id"]))


@query("train_no_show")
def no_show_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = train_no_show(
        hospital_tables(spark, sf_dir),
        SMALL,
        capacity_fraction=0.2,
        effectiveness=0.25,
        maximum_ece=0.35,
    )
    return rounded(run.report)


@query("calibrated_scores")
def calibrated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Platt scaling of a closed-form score in two folds: each event's fit is that of the other fold."""
    margin = scored_events(spark, sf_dir).withColumn("margin", log_odds("p"))
    even = F.col("event_id") % 2 == 0
    folds = []
    for fitted, scored in ((even, ~even), (~even, even)):
        model = fit_sigmoid(margin.where(fitted), "margin", "actual")
        folds.append(apply_sigmoid(margin.where(scored), model, "margin", "calibrated"))
    return rounded(folds[0].unionByName(folds[1]).select("event_id", "actual", "p", "calibrated"))


@query("train_arrivals")
def arrival_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Back-test, fit on everything and the 24-hour forecast, departments and hospital."""
    return rounded(train_arrivals(arrivals(spark, sf_dir), SMALL).forecast)


@query("train_occupancy")
def occupancy_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Back-test, fit on everything and the 24-hour forecast of beds with its alerts."""
    return rounded(train_occupancy(occupancy(spark, sf_dir), SMALL, alert_threshold=0.5).forecast)


_FIXED_TREE = Tree(feature=[4, -1, 5, -1, -1], cut=[2.0, 0.0, 1.0, 0.0, 0.0], bin=[0] * 5, left=[1, 0, 3, 0, 0], right=[2, 0, 4, 0, 0],
                   value=[0.0, 12.5, 0.0, 30.0, 21.25])


@query(
    "score_table",
    sql(
        """SELECT encounter_id, CASE WHEN queue_length <= 2 THEN 14.5 WHEN available_doctors <= 1 THEN 32.0 ELSE 23.25 END::DOUBLE AS predicted_wait_minutes,
                  CASE WHEN queue_length <= 2 THEN 12.5 WHEN available_doctors <= 1 THEN 30.0 ELSE 21.25 END::DOUBLE AS lower_wait_minutes,
                  CASE WHEN queue_length <= 2 THEN 16.5 WHEN available_doctors <= 1 THEN 34.0 ELSE 25.25 END::DOUBLE AS upper_wait_minutes
           FROM queue_events""",
        "queue_events",
    ),
)
def scored_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every wait row scored by a fixed tree saved as leaf boxes and read back as expressions."""
    rows = wait_rows(spark, sf_dir)
    columns = ("department_id", "appointment_type", "priority_type", "hour", "queue_length", "available_doctors")
    model = HistogramModel(2.0, (_FIXED_TREE,))
    path = new_path(spark, "boxes")
    model.table(spark).write.parquet(path)
    scored = score_by_boxes(rows, spark.read.parquet(path), columns, "predicted_wait_minutes")
    scored = scored.withColumns({
        "lower_wait_minutes": F.col("predicted_wait_minutes") - 2.0,
        "upper_wait_minutes": F.col("predicted_wait_minutes") + 2.0,
    })
    fixed = with_repaired_interval(scored, "predicted_wait_minutes", "lower_wait_minutes", "upper_wait_minutes")
    return rounded(fixed.select("encounter_id", "predicted_wait_minutes", "lower_wait_minutes", "upper_wait_minutes"))


@query(
    "retraining_run",
    sql(
        """SELECT unnest([1, 2, 3, 4]) AS number, unnest(['v1', 'v1', 'v2', 'v2']) AS version,
                  unnest(['trained', 'promoted', 'trained', 'rejected']) AS action,
                  unnest([NULL, NULL, 'v1', 'v1']) AS previous,
                  (SELECT count(*) FROM wait_split WHERE split = 'test') AS test_rows""",
        "wait_split",
    ),
)
def retraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first version is promoted; a second one on the same data brings no gain and is rejected."""
    root = new_path(spark, "wait-models")
    alerts = spark.createDataFrame([("drift",)], "component string")
    for version in ("v1", "v2"):
        retrain_wait_time(hospital_tables(spark, sf_dir), alerts, root, version, SMALLEST, require_gain=False)
    records = version_records(spark, root)
    return records.select("number", "version", "action", "previous", F.col("details")["test_rows"].cast("long").alias("test_rows"))


@query("backtest_arrivals")
def arrival_backtest(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = materialize(arrivals(spark, sf_dir), "arrivals")
    return rounded(backtest_arrivals(target, SMALL, windows=3))


@query("backtest_occupancy")
def occupancy_backtest(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = materialize(occupancy(spark, sf_dir), "occupancy")
    return rounded(backtest_occupancy(target, FULL, alert_threshold=0.5, windows=3))
