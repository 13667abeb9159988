"""The queries that stand for a whole training job fit models of full size."""

from types import SimpleNamespace

import pytest

from opsloom.catalog import learned
from opsloom.operators.models import HistogramBoosting, TrainingSettings, boosting_settings, regressors


@pytest.fixture
def given(monkeypatch):
    """The settings and options a training job was called with; nothing is trained."""
    calls = {}

    def noted(name, result):
        def call(tables, settings, **options):
            calls[name] = (settings, options)
            return result

        return call

    monkeypatch.setattr(learned, "hospital_tables", lambda *a: {})
    monkeypatch.setattr(learned, "occupancy", lambda *a: None)
    monkeypatch.setattr(learned, "materialize", lambda frame, name: frame)
    monkeypatch.setattr(learned, "rounded", lambda frame: frame)
    monkeypatch.setattr(learned, "train_wait_time", noted("train_wait_time", SimpleNamespace(report="report")))
    monkeypatch.setattr(learned, "backtest_occupancy", noted("backtest_occupancy", "metrics"))
    return calls


def test_train_wait_time_fits_whole_models(spark, given):
    assert learned.wait_training(spark, "") == "report"
    settings, _ = given["train_wait_time"]
    assert settings == TrainingSettings()
    rows = spark.createDataFrame([(1.0,), (2.0,)], "wait_minutes double")
    models = regressors(rows, "wait_minutes", settings)
    assert models["random_forest"].getNumTrees() == 100 and models["random_forest"].getMaxDepth() == 30
    assert models["gradient_boosting"] == HistogramBoosting("wait_minutes", settings)
    assert boosting_settings(settings).rounds == 100


def test_backtest_occupancy_fits_whole_models(spark, given):
    assert learned.occupancy_backtest(spark, "") == "metrics"
    settings, options = given["backtest_occupancy"]
    assert boosting_settings(settings).rounds == 100 and options["windows"] == 3
