"""Patient-flow summaries per scenario and the staffing recommendation drawn from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsloom.errors import RecommendationConstraintError
from opsloom.functions.clock import micros, minutes_between
from opsloom.functions.ranks import exact_percentiles
from opsloom.functions.running import running_totals, time_bucket
from opsloom.functions.staging import materialize

BASELINE = "baseline"
ADDITIONAL_STAFFING = "additional_staffing"


def max_queue_length(encounters: DataFrame) -> DataFrame:
    """Largest number of patients waiting at once, per scenario.

    Entries and starts combine to one net change per instant; the running sum is carried from
    day to day, so a scenario is not one task. A start at the instant of an entry counts first.
    """
    changes = encounters.select(
        "scenario",
        F.inline(
            F.array(
                F.struct(micros("queue_entered_at").alias("_at"), F.lit(1).alias("_change")),
                F.struct(micros("consultation_started_at").alias("_at"), F.lit(-1).alias("_change")),
            )
        ),
    )
    net = changes.groupBy("scenario", "_at").agg(F.sum("_change").alias("_net"))
    waiting = running_totals(
        net,
        ["scenario"],
        ["_at"],
        {"_waiting": F.col("_net")},
        time_bucket(F.timestamp_micros("_at")),
    )
    return waiting.groupBy("scenario").agg(F.max("_waiting").alias("max_queue_length"))


def flow_summary(encounters: DataFrame, resources: DataFrame) -> DataFrame:
    """Arrivals, waits, longest queue and doctor utilisation per scenario.

    ``encounters`` rows carry a ``scenario``; ``resources`` holds its ``doctors``. The four columns
    in use are written once and read by every part.
    """
    columns = ("scenario", "queue_entered_at", "consultation_started_at", "consultation_ended_at")
    encounters = materialize(encounters.select(*columns), "flow-rows")
    rows = encounters.select(
        "scenario",
        "queue_entered_at",
        "consultation_ended_at",
        minutes_between("queue_entered_at", "consultation_started_at").alias("_wait"),
        minutes_between("consultation_started_at", "consultation_ended_at").alias("_service"),
    )
    totals = rows.groupBy("scenario").agg(
        F.count("*").alias("arrivals"),
        F.count("consultation_ended_at").alias("completed"),
        F.avg("_wait").alias("mean_wait_minutes"),
        F.sum("_service").alias("_busy"),
        ((F.max(micros("consultation_ended_at")) - F.min(micros("queue_entered_at"))) / 60e6).alias("_elapsed"),
    )
    waits = exact_percentiles(
        rows, ["scenario"], "_wait", {"p50_wait_minutes": 0.5, "p90_wait_minutes": 0.9}
    ).drop("n")
    capacity = F.greatest(F.col("doctors") * F.col("_elapsed"), F.lit(1.0))
    return (
        totals.join(waits, "scenario")
        .join(max_queue_length(encounters), "scenario")
        .join(resources.select("scenario", "doctors"), "scenario")
        .select(
            "scenario",
            "doctors",
            "arrivals",
            "completed",
            "mean_wait_minutes",
            "p50_wait_minutes",
            "p90_wait_minutes",
            "max_queue_length",
            (F.col("_busy") / capacity).alias("resource_utilization"),
        )
    )


# The two reasons a recommendation may give.
STAFF_REASON = "Additional staffing meets the configured P90 wait-improvement threshold."
KEEP_REASON = "Keep baseline staffing; constrained improvement is below the required threshold."


def recommend_scenario(
    summary: DataFrame, *, minimum_p90_improvement_minutes: float, verify: bool = True
) -> DataFrame:
    """One row: extra staffing if it brings enough, otherwise the baseline. Never applied alone."""

    def of(name: str, column: str):
        return F.max(F.when(F.col("scenario") == name, F.col(column)))

    pair = summary.agg(
        of(BASELINE, "p90_wait_minutes").alias("_p_base"),
        of(ADDITIONAL_STAFFING, "p90_wait_minutes").alias("_p_more"),
        (of(ADDITIONAL_STAFFING, "doctors") - of(BASELINE, "doctors")).alias("_extra"),
    )
    if verify and (row := pair.first())._extra is not None and row._extra < 0:
        raise RecommendationConstraintError("the scenario with more staff has fewer doctors")
    gain = F.greatest(F.lit(0.0), F.col("_p_base") - F.col("_p_more"))
    worth = (F.col("_extra") > 0) & (gain >= F.lit(float(minimum_p90_improvement_minutes)))
    return pair.select(
        F.when(worth, ADDITIONAL_STAFFING).otherwise(BASELINE).alias("recommended_scenario"),
        F.when(worth, F.col("_extra")).otherwise(0).alias("additional_doctors"),
        gain.alias("expected_p90_wait_reduction_minutes"),
        F.when(worth, STAFF_REASON).otherwise(KEEP_REASON).alias("reason"),
        F.lit(True).alias("human_approval_required"),
        F.lit(False).alias("automatically_applied"),
    )
