"""Decisions on scored rows: interval repair, reminders, capacity alerts, reconciliation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsloom.operators.metrics import safe_ratio
from opsloom.operators.splits import capacity, first_rows


def repair_interval(
    point: Column, lower: Column, upper: Column, ceiling: Column | None = None
) -> tuple[Column, Column, Column]:
    """Order and clip a prediction and its bounds: nothing below 0 or above ``ceiling``."""
    zero = F.lit(0.0)

    def clip(value: Column) -> Column:
        kept = F.greatest(zero, value)
        return kept if ceiling is None else F.least(kept, ceiling.cast("double"))

    middle = clip(point)
    return middle, clip(F.least(lower, middle)), clip(F.greatest(upper, middle))


def with_repaired_interval(
    frame: DataFrame, point: str, lower: str, upper: str, ceiling: str | None = None
) -> DataFrame:
    top = F.col(ceiling) if ceiling else None
    p, l, u = repair_interval(F.col(point), F.col(lower), F.col(upper), top)
    return frame.withColumns({point: p, lower: l, upper: u})


def reminder_policy(
    scores: DataFrame,
    actual: str,
    probability: str,
    tie: str,
    *,
    capacity_fraction: float,
    effectiveness: float,
) -> DataFrame:
    """Outcome of reminding the highest probabilities up to capacity. Nothing is cancelled.

    Equal probabilities at the cut are taken in id order, so the selection has exactly the
    capacity's size.
    """
    chosen = first_rows(scores, -F.col(probability), tie, lambda n: capacity(n, capacity_fraction))
    counted = scores.agg(
        F.count("*").alias("appointments"),
        F.count_if(chosen).alias("reminder_capacity"),
        F.coalesce(F.sum(F.when(chosen, F.col(actual))), F.lit(0)).alias("observed_no_shows_prioritized"),
        F.coalesce(F.sum(actual), F.lit(0)).alias("_total"),
    )
    hits = F.col("observed_no_shows_prioritized")
    return counted.select(
        "appointments",
        "reminder_capacity",
        "observed_no_shows_prioritized",
        (hits / F.greatest(F.col("_total"), F.lit(1))).alias("recall_at_capacity"),
        (hits * F.lit(float(effectiveness))).alias("estimated_slots_recovered"),
        F.lit(False).alias("automatic_cancellation"),
    )


ARRIVAL_VALUES = ("predicted_arrivals", "lower_arrivals", "upper_arrivals")


def reconcile_bottom_up(
    departments: DataFrame, values: Sequence[str] = ARRIVAL_VALUES
) -> DataFrame:
    """Department rows plus hospital rows that sum them hour by hour."""
    hospital = departments.groupBy("interval_start", "hospital_id").agg(
        *[F.sum(v).alias(v) for v in values]
    )
    columns = ["interval_start", "hospital_id", "department_id", "level", *values]
    return (
        departments.withColumn("level", F.lit("department"))
        .select(*columns)
        .unionByName(
            hospital.withColumns({
                "department_id": F.lit(None).cast("string"),
                "level": F.lit("hospital"),
            }).select(*columns)
        )
    )


def capacity_alerts(points: DataFrame, threshold: float) -> DataFrame:
    """Ratio of predicted beds to capacity, and an alert from ``threshold`` on."""
    ratio = F.col("predicted_occupied_beds") / F.col("staffed_capacity")
    return points.withColumn("predicted_occupancy_ratio", ratio).withColumn(
        "capacity_alert", F.col("predicted_occupancy_ratio") >= F.lit(float(threshold))
    )


def retraining_gate(
    alerts: DataFrame,
    metrics: DataFrame,
    *,
    minimum_improvement: float,
) -> DataFrame:
    """Whether to retrain and whether to promote the candidate.

    ``alerts`` has a ``component`` per alert; ``metrics`` one row with ``current_value`` and
    ``candidate_value`` of an error metric. A data-quality alert blocks, a drift or performance
    alert triggers, and a candidate is promoted only with the minimum relative gain.
    """
    found = alerts.agg(
        F.coalesce(F.bool_or(F.col("component") == "data_quality"), F.lit(False)).alias("blocked"),
        F.coalesce(F.bool_or(F.col("component").isin("drift", "performance")), F.lit(False)).alias("triggered"),
    )
    state = found.select(F.struct("blocked", "triggered")).scalar()
    gain = safe_ratio(F.col("current_value") - F.col("candidate_value"), F.abs("current_value"))
    decided = metrics.withColumn("_s", state).withColumns({
        "blocked": F.col("_s.blocked"),
        "retrain": F.col("_s.triggered") & ~F.col("_s.blocked"),
        "relative_gain": gain,
    })
    promote = F.col("retrain") & (F.col("relative_gain") >= F.lit(float(minimum_improvement)))
    return decided.withColumn("promote", promote).drop("_s")
