"""The retraining run: alerts, a candidate trained on the newest tables, and its promotion."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsloom.operators.models import IntervalModel, TrainingSettings, score_wait_time
from opsloom.plans.training import WAIT_FEATURES, train_wait_time
from opsloom.sources.versions import Candidate, run_retraining


def retrain_wait_time(
    tables: Mapping[str, DataFrame],
    alerts: DataFrame,
    root: str,
    version: str,
    settings: TrainingSettings = TrainingSettings(),  # noqa: B008
    *,
    minimum_improvement: float = 0.02,
    require_gain: bool = True,
) -> str:
    """Train a wait-time model if the alerts ask for it, and promote it if its test error is enough lower.

    Candidate and current version are held against each other on the test rows of the newest split.
    Returns the last action recorded; the evaluation stays with the version's record.
    """
    spark = alerts.sparkSession

    def train(current: str | None) -> Candidate:
        run = train_wait_time(tables, settings, require_gain=require_gain)
        rows = run.predictions
        error = F.avg(F.abs(F.col("predicted_wait_minutes") - F.col("wait_minutes")))
        before = None
        if current is not None:
            test = rows.select("wait_minutes", *WAIT_FEATURES.columns)
            before = score_wait_time(IntervalModel.load(spark, current, WAIT_FEATURES), test).agg(error.alias("e")).first().e
        tested = run.report.where("stage = 'test'").collect()  # a handful of metrics
        facts = {f"{r.model}.{r.metric}": r.value for r in tested}
        after = rows.agg(error.alias("e")).first().e
        return Candidate(lambda path: run.model.save(path, spark), after, before, {"selected": run.selected, "test_rows": rows.count(), **facts})

    return run_retraining(spark, root, version, alerts, train, minimum_improvement=minimum_improvement)
