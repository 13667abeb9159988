"""The log of model versions: two writers, writers that die, and the gate of a retraining run."""

from concurrent.futures import ThreadPoolExecutor

import pytest

from opsloom.sources import versions
from opsloom.sources.tables import create_new
from opsloom.sources.versions import Candidate, append_record, current_version, run_retraining, version_records


def _alerts(spark, *components):
    return spark.createDataFrame([(c,) for c in components], "component string")


def _candidate(spark, after, before=None):
    saved = []

    def train(current):
        def save(path):
            saved.append((current, path))
            spark.range(1).write.parquet(path)

        return Candidate(save, after, before if current else None, {"selected": "ridge"})

    return train, saved


def _actions(spark, root):
    return [(r.action, r.version) for r in version_records(spark, root).orderBy("number").collect()]


def test_first_version_then_gate(spark, tmp_path):
    root = str(tmp_path)
    assert current_version(spark, root) is None and version_records(spark, root).count() == 0
    first, saved = _candidate(spark, 10.0)
    assert run_retraining(spark, root, "v1", _alerts(spark), first) == "promoted"
    assert current_version(spark, root) == "v1" and saved == [(None, versions.model_path(root, "v1"))]
    train, saved = _candidate(spark, 9.0, 10.0)
    assert run_retraining(spark, root, "v2", _alerts(spark), train) == "skipped"
    assert run_retraining(spark, root, "v2", _alerts(spark, "drift", "data_quality"), train) == "blocked"
    assert saved == [] and current_version(spark, root) == "v1"
    little, _ = _candidate(spark, 9.9, 10.0)
    assert run_retraining(spark, root, "v2", _alerts(spark, "drift"), little) == "rejected"
    assert current_version(spark, root) == "v1"
    assert run_retraining(spark, root, "v3", _alerts(spark, "performance"), train) == "promoted"
    assert saved == [(versions.model_path(root, "v1"), versions.model_path(root, "v3"))]
    assert current_version(spark, root) == "v3"
    assert _actions(spark, root) == [
        ("trained", "v1"), ("promoted", "v1"), ("skipped", "v2"), ("blocked", "v2"), ("trained", "v2"), ("rejected", "v2"),
        ("trained", "v3"), ("archived", "v1"), ("promoted", "v3"),
    ]
    with pytest.raises(FileExistsError):
        run_retraining(spark, root, "v2", _alerts(spark, "drift"), train)


def test_two_writers_at_a_time(spark, tmp_path):
    root = str(tmp_path)
    with ThreadPoolExecutor(4) as pool:
        numbers = list(pool.map(lambda i: append_record(spark, root, version=f"v{i}", action="trained"), range(8)))
    assert sorted(numbers) == list(range(1, 9))
    assert sorted(r.version for r in version_records(spark, root).collect()) == [f"v{i}" for i in range(8)]


def test_a_writer_that_dies_changes_nothing(spark, tmp_path):
    root = str(tmp_path)
    append_record(spark, root, version="v1", action="promoted")
    # It claimed a number and wrote nothing, or not all.
    assert create_new(spark, f"{root}/log/00000002.claim") and not create_new(spark, f"{root}/log/00000002.claim")
    number = append_record(spark, root, version="v9", action="promoted")
    (tmp_path / "log" / f"{number:08d}" / "_SUCCESS").unlink()
    assert current_version(spark, root) == "v1"
    assert append_record(spark, root, version="v2", action="promoted") == number + 1
    assert current_version(spark, root) == "v2"


def test_a_run_that_stops_before_the_promotion_keeps_the_old_version(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    train, _ = _candidate(spark, 5.0, 10.0)
    run_retraining(spark, root, "v1", _alerts(spark), train)
    real = append_record

    def stops(*args, action, **more):
        if action == "promoted":
            raise RuntimeError("stopped")
        return real(*args, action=action, **more)

    monkeypatch.setattr(versions, "append_record", stops)
    with pytest.raises(RuntimeError):
        run_retraining(spark, root, "v2", _alerts(spark, "drift"), train)
    assert current_version(spark, root) == "v1" and _actions(spark, root)[-1] == ("archived", "v1")
