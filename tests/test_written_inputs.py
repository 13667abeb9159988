"""Checks read written rows and do not compute them again."""

from opsloom.operators import features
from opsloom.sources import views


def test_feature_checks_read_written_rows(spark, sf_dir, monkeypatch):
    tables = {"appointments": views.appointments(spark, sf_dir), "encounters": views.encounters(spark, sf_dir), "queue_events": views.queue_events(spark, sf_dir)}
    events = set(spark.read.parquet(f"{sf_dir}/events.parquet").inputFiles())
    checked = []
    for name in ("check_waiting_times", "checked_join", "assert_no_nulls"):
        real = getattr(features, name)
        monkeypatch.setattr(features, name, lambda first, *a, real=real, **k: checked.append(first) or real(first, *a, **k))
    features.wait_features(tables)
    assert len(checked) == 4
    assert not any(set(frame.inputFiles()) & events for frame in checked)
