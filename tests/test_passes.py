"""What the passes of a boosting fit read."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler

from opsloom.operators import boosting
from opsloom.operators.boosting import BoostedModel, BoostingSettings, fit_boosting


@pytest.fixture
def small_batches(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "16")
    yield
    spark.conf.set(name, before)


def test_passes_read_blocks_and_old_margins_are_deleted(spark, small_batches, monkeypatch):
    rng = np.random.default_rng(3)
    made = [(float(a), float(b), float(a * 2 + b)) for a, b in rng.integers(0, 9, (700, 2))]
    frame = spark.createDataFrame(made, "a double, b double, y double").repartition(2)
    encoded = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(frame)
    read, dropped = [], []
    real, drop = boosting._cuts, boosting.discard
    monkeypatch.setattr(boosting, "_cuts", lambda rows, *a: read.append(rows) or real(rows, *a))
    monkeypatch.setattr(boosting, "discard", lambda table: dropped.append(table.inputFiles()) or drop(table))
    settings = BoostingSettings(rounds=boosting.WRITE_EVERY + 1, leaves=3)
    model = fit_boosting(encoded, "y", [BoostedModel("m")], settings)["m"]
    # 700 rows in Arrow batches of 16 are a block per task, not a row each.
    assert read[-1].count() <= 2
    assert len(dropped) == 1 and not set(dropped[0]) & set(read[-1].inputFiles())
    y = np.array([r[2] for r in made])
    errors = np.abs(model.values(np.array([r[:2] for r in made])) - y).mean()
    assert errors < np.abs(y.mean() - y).mean()
