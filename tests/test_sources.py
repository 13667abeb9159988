import json

import pytest
from pyspark.sql import functions as F

from opsloom.errors import ConfigurationError, DataContractError, DataQualityError
from opsloom.functions import staging
from opsloom.operators.quality import ValidationResult, WAIT_REQUEST_RULES, validate_dataset
from opsloom.plans.baseline_report import baseline_analysis, report_rows, write_baseline_report
from opsloom.plans.training import WAIT_FEATURES
from opsloom.sources import views
from opsloom.sources.records import append_predictions, read_predictions, recent_predictions
from opsloom.sources.tables import (
    configuration_hash,
    dataset_hash,
    flatten_metrics,
    ingest_extract,
    load_report,
    publish_dataset,
    published_folder,
    read_metrics,
    read_table_dir,
    reject_identifiers,
)
from opsloom.streaming.scoring import score_stream


def test_publication_is_immutable_and_reads_back(spark, sf_dir, tmp_path):
    tables = views.canonical_dataset(spark, sf_dir, anomalies=True)
    result = validate_dataset(tables)
    settings = dict(name="week", configuration={"seed": 31}, date_range=("a", "b"))
    key = publish_dataset(tables, result, str(tmp_path), **settings)
    assert key == configuration_hash({"seed": 31})[:12] and len(key) == 12
    with pytest.raises(FileExistsError):
        publish_dataset(tables, result, str(tmp_path), **settings)
    # Another dataset may share the root.
    assert publish_dataset(tables, result, str(tmp_path), name="week", configuration={"seed": 32}, date_range=("a", "b")) != key
    raw = ingest_extract(spark, published_folder(spark, str(tmp_path), "week", key, "raw"))
    assert dataset_hash(raw) == dataset_hash(tables)
    bronze = read_table_dir(spark, published_folder(spark, str(tmp_path), "week", key, "bronze"))
    assert set(bronze) == set(tables)
    quarantine = read_table_dir(spark, published_folder(spark, str(tmp_path), "week", key, "quarantine"))
    assert "encounters" in quarantine and "beds" not in quarantine
    manifest = spark.read.json(f"{tmp_path}/manifests/week-{key}").first()
    assert manifest.run_key == key and manifest.row_counts.beds == tables["beds"].count()


def test_a_publication_that_stops_is_not_visible(spark, sf_dir, tmp_path):
    """It stops between two tables, then between the tables and the marker of the manifest."""
    tables = views.canonical_dataset(spark, sf_dir)
    result = validate_dataset(tables)
    settings = dict(name="week", configuration={"seed": 1}, date_range=("a", "b"))
    key = configuration_hash({"seed": 1})[:12]
    broken = dict(result.clean)
    broken["appointments"] = tables["appointments"].withColumn("status", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        publish_dataset(tables, ValidationResult(result.tagged, broken, result.quarantine, result.report), str(tmp_path), **settings)
    assert any((tmp_path / "raw/week" / key).iterdir())
    with pytest.raises(FileNotFoundError):
        published_folder(spark, str(tmp_path), "week", key, "raw")
    (tmp_path / "manifests" / f"week-{key}").mkdir(parents=True)
    with pytest.raises(FileNotFoundError):
        published_folder(spark, str(tmp_path), "week", key, "raw")
    assert publish_dataset(tables, result, str(tmp_path), **settings) == key
    assert len(list((tmp_path / "raw/week" / key).iterdir())) == 2
    bronze = read_table_dir(spark, published_folder(spark, str(tmp_path), "week", key, "bronze"))
    assert {n: t.count() for n, t in bronze.items()} == {n: t.count() for n, t in result.clean.items()}


def test_extract_checks(spark, tmp_path):
    with pytest.raises(DataContractError, match="lacks"):
        ingest_extract(spark, str(tmp_path))
    for column in ("Patient Name", "phone_number", "home_address", "AADHAAR", "abha_id"):
        with pytest.raises(DataContractError, match="identifiers"):
            reject_identifiers(["bed_id", column], "beds")
    reject_identifiers(["bed_id", "ward_id"], "beds")
    with pytest.raises(FileNotFoundError):
        read_table_dir(spark, str(tmp_path))


def test_dataset_hash_ignores_order_but_not_copies(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "i int, s string")
    same = dataset_hash({"t": rows.orderBy(F.desc("i")).repartition(3)})
    assert dataset_hash({"t": rows}) == same
    assert dataset_hash({"t": rows.distinct()}) != same
    four = spark.createDataFrame([(1, "a"), (3, "c"), (3, "c")], "i int, s string")
    assert dataset_hash({"t": four}) != same


@pytest.mark.parametrize(
    ("text", "ok"),
    [
        ('{"mae": 1.5, "n": 3}', True),
        ('{"mae": true}', False),
        ('{"mae": "1"}', False),
        ('{"mae": null}', False),
        ('{"mae": {"x": 1}}', False),
        ("[1, 2]", False),
        ('{"mae": 1e999}', False),
    ],
)
def test_metrics_must_be_finite_numbers(spark, tmp_path, text, ok):
    path = tmp_path / "metrics.json"
    path.write_text(text)
    if ok:
        assert {r.metric: r.value for r in read_metrics(spark, str(path)).collect()} == {"mae": 1.5, "n": 3.0}
    else:
        with pytest.raises(DataQualityError):
            read_metrics(spark, str(path))


def test_flatten_drops_flags_text_and_infinity(spark):
    row = spark.sql("select named_struct('b', 1, 'c', named_struct('d', 2.5D)) a, true t, 'x' s, double('inf') i")
    assert {r.metric: r.value for r in flatten_metrics(row).collect()} == {"a.b": 1.0, "a.c.d": 2.5}


def test_malformed_report_is_refused(spark, tmp_path):
    (tmp_path / "r.json").write_text('{"status": "healthy", "alerts": "many"}')
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        load_report(spark, str(tmp_path / "r.json"), "status string, alerts int").collect()
    with pytest.raises(FileNotFoundError):
        load_report(spark, str(tmp_path / "none"), "status string")


def _record(spark, **changes):
    row = dict(id=1, request_id="r", prediction_type="wait_time", model_version="v", schema_version="1.0",
               request_payload='{"a": 1}', response_payload='{"b": 2}')
    row.update(changes)
    return spark.createDataFrame([row]).withColumn("created_at", F.current_timestamp())


def test_prediction_records(spark, tmp_path):
    path = str(tmp_path / "log")
    for i in range(3):
        append_predictions(_record(spark, id=i), path)
        assert append_predictions(_record(spark, id=i), path) == append_predictions(_record(spark, id=i), path)
    log = read_predictions(spark, path)
    assert log.count() == 3
    assert [r.id for r in recent_predictions(log, 2).collect()] == [2, 1]
    # A batch without its marker is not there, and is written anew.
    lost = append_predictions(_record(spark, id=9), path)
    (tmp_path / "log" / f"batch={lost}" / "_SUCCESS").unlink()
    assert read_predictions(spark, path).count() == 3
    append_predictions(_record(spark, id=9), path)
    assert read_predictions(spark, path).count() == 4
    with pytest.raises(FileNotFoundError):
        read_predictions(spark, str(tmp_path / "none"))
    for bad in (dict(prediction_type="weather"), dict(request_payload="[1]"), dict(response_payload="nope")):
        with pytest.raises(DataContractError):
            append_predictions(_record(spark, **bad), path)
    for limit in (0, 101):
        with pytest.raises(ValueError):
            recent_predictions(log, limit)


def test_staging_folder_comes_from_the_session(spark, monkeypatch):
    class Conf:
        def __init__(self, values):
            self.values = values

        def get(self, key, default=None):
            return self.values.get(key, default)

    class Session:
        def __init__(self, **values):
            self.conf = Conf({k.replace("_", "."): v for k, v in values.items()})

    shared = {"spark.checkpoint.dir": "hdfs:///shared/", "spark.master": "yarn"}
    session = Session()
    session.conf = Conf(shared)
    assert staging.staging_root(session) == "hdfs:///shared/opsloom"
    session.conf = Conf({"spark.sql.warehouse.dir": "hdfs:///warehouse"})
    assert staging.staging_root(session) == "hdfs:///warehouse/opsloom"


def test_baseline_report_files(spark, sf_dir, tmp_path):
    tables = {n: t for n, t in views.canonical_dataset(spark, sf_dir).items() if n in ("appointments", "encounters", "queue_events")}
    report = baseline_analysis(tables)
    assert report.checks.where("not passed").count() == 0 and report.checks.count() == 4
    write_baseline_report(report, str(tmp_path))
    assert {p.name for p in tmp_path.iterdir()} >= {"baseline_metrics", "eda_profile", "leakage_checks"}
    rows = report_rows(report)
    parts = {r.part: r["count"] for r in rows.groupBy("part").count().collect()}
    assert set(parts) == {p.name for p in tmp_path.iterdir()} and parts["leakage_checks"] == 4
    counted = rows.where("part = 'eda_profile' and item = 'appointments/rows'").first()
    assert counted.value == tables["appointments"].count() and counted.instant is None
    assert rows.where("field in ('first_time', 'last_time') and instant is null").isEmpty()


def test_stream_scores_valid_rows_once(spark, tmp_path):
    rows = [
        {"request_id": f"r{i}", "created_at": "2026-01-05T09:00:00Z", "department_id": "d", "appointment_type": "new",
         "priority_type": "routine", "reminder_sent": True, "weekday": 9 if i == 2 else 1, "hour": 9,
         "queue_length": i, "available_doctors": 1, "available_rooms": 1}
        for i in range(3)
    ]
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.json").write_text("\n".join(json.dumps(r) for r in rows))
    ddl = ("request_id string, created_at timestamp, department_id string, appointment_type string, priority_type string, "
           "reminder_sent boolean, weekday int, hour int, queue_length bigint, available_doctors bigint, available_rooms bigint")

    def run():
        stream = spark.readStream.schema(ddl).json(str(source))
        score_stream(
            stream, lambda f: f.withColumn("predicted_wait_minutes", F.lit(20.0)), str(tmp_path / "log"), str(tmp_path / "cp"),
            features=WAIT_FEATURES.columns, outputs=["predicted_wait_minutes"], rules=WAIT_REQUEST_RULES,
            kind="wait_time", model_version="v1",
        ).awaitTermination()

    run()
    run()
    log = spark.read.parquet(str(tmp_path / "log/predictions"))
    assert sorted(r.request_id for r in log.collect()) == ["r0", "r1"]
    assert log.first().response_payload == '{"predicted_wait_minutes":20.0}'
    rejected = spark.read.parquet(str(tmp_path / "log/rejected")).collect()
    assert [(r.request_id, r.row_errors) for r in rejected] == [("r2", ["weekday between 0 and 6"])]
