"""Queries over readers, writers and record tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsloom.catalog.registry import query, r6, rounded, sql, stamp
from opsloom.functions.staging import new_path
from opsloom.operators.profile import prediction_counts, queue_summary
from opsloom.operators.quality import validate_dataset
from opsloom.sources import views
from opsloom.sources.records import (
    PREDICTION_TYPES,
    append_predictions,
    append_training_run,
    read_predictions,
    recent_predictions,
)
from opsloom.sources.tables import (
    flatten_metrics,
    ingest_extract,
    dataset_manifest,
    load_report,
    publish_dataset,
    published_folder,
    read_metrics,
    read_table_dir,
    table_counts,
    write_report,
)

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@query(
    "table_row_counts",
    "\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in DRIVER_TABLES
    ),
)
def table_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_counts(read_table_dir(spark, sf_dir), "row_count")


def prediction_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as prediction records."""
    e = views.keyed_events(spark, sf_dir)
    kinds = F.array(*[F.lit(k) for k in PREDICTION_TYPES])
    return e.select(
        F.col("event_id").alias("id"),
        F.concat(F.lit("req-"), F.col("event_id").cast("string")).alias("request_id"),
        F.element_at(kinds, (F.col("k") % 4 + 1).cast("int")).alias("prediction_type"),
        F.lit("v1").alias("model_version"),
        F.lit("1.0").alias("schema_version"),
        F.to_json(F.struct("user_id", "event_type")).alias("request_payload"),
        F.to_json(F.struct("value")).alias("response_payload"),
        F.date_trunc("hour", "ts").alias("created_at"),
    )


_KIND = "(['wait_time', 'arrivals', 'no_show', 'occupancy'])[k % 4 + 1]"


@query(
    "recent_predictions",
    sql(
        f"""SELECT event_id AS id, 'req-' || event_id AS request_id, {_KIND} AS prediction_type,
                   {stamp("date_trunc('hour', ts)", "created_at")}
            FROM keyed ORDER BY date_trunc('hour', ts) DESC, event_id DESC LIMIT 50""",
        "keyed",
    ),
)
def recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = recent_predictions(prediction_records(spark, sf_dir), 50)
    return rounded(newest.select("id", "request_id", "prediction_type", "created_at"))


@query(
    "prediction_counts",
    sql(f"SELECT {_KIND} AS prediction_type, count(*) AS requests FROM keyed GROUP BY 1", "keyed"),
)
def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prediction_counts(prediction_records(spark, sf_dir))


@query(
    "prediction_log",
    sql(
        f"""SELECT {_KIND} AS prediction_type, count(*) AS requests, count(DISTINCT user_id) AS users,
                   {r6("sum(value)", "total")}
            FROM keyed GROUP BY 1""",
        "keyed",
    ),
)
def prediction_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append all records, read them back and look into their payloads."""
    path = new_path(spark, "predictions")
    for _ in range(2):  # the second time changes nothing
        append_predictions(prediction_records(spark, sf_dir), path)
    log = read_predictions(spark, path)
    return rounded(
        log.groupBy("prediction_type").agg(
            F.count("*").alias("requests"),
            F.count_distinct(F.get_json_object("request_payload", "$.user_id")).alias("users"),
            F.sum(F.get_json_object("response_payload", "$.value").cast("double")).alias("total"),
        )
    )


_NESTED = """
    SELECT avg(l_quantity) AS mean_quantity, max(l_quantity) AS max_quantity, avg(l_tax) AS mean_tax,
           count(*) AS n FROM lineitem"""


@query(
    "flat_metrics",
    f"""SELECT unnest(['quantity.mean', 'quantity.limits.max', 'tax.mean', 'n']) AS metric,
               round(unnest([mean_quantity, max_quantity, mean_tax, n::DOUBLE]), 6) AS value
        FROM ({_NESTED})""",
)
def flat_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = views.driver_table(spark, sf_dir, "lineitem")
    report = items.agg(
        F.struct(
            F.avg("l_quantity").alias("mean"),
            F.struct(F.max("l_quantity").alias("max"), F.lit("items").alias("unit")).alias("limits"),
            (F.count("*") > 0).alias("present"),
        ).alias("quantity"),
        F.struct(F.avg("l_tax").alias("mean"), F.lit(float("nan")).alias("spread")).alias("tax"),
        F.count("*").alias("n"),
    )
    return rounded(flatten_metrics(report))


@query(
    "metrics_file",
    f"""SELECT unnest(['mean_quantity', 'max_quantity', 'mean_tax', 'n']) AS metric,
               round(unnest([mean_quantity, max_quantity, mean_tax, n::DOUBLE]), 6) AS value
        FROM ({_NESTED})""",
)
def metrics_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of a table written as a flat JSON object and read back with all checks."""
    path = new_path(spark, "metrics")
    items = views.driver_table(spark, sf_dir, "lineitem")
    write_report(
        items.agg(
            F.avg("l_quantity").alias("mean_quantity"),
            F.max("l_quantity").alias("max_quantity"),
            F.avg("l_tax").alias("mean_tax"),
            F.count("*").alias("n"),
        ),
        path,
    )
    return rounded(read_metrics(spark, path + "/*.json"))


@query(
    "training_run_log",
    """SELECT 'wait_time' AS kind, l_returnflag AS metric, round(avg(l_quantity), 6) AS value
       FROM lineitem GROUP BY 2""",
)
def training_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "runs")
    items = views.driver_table(spark, sf_dir, "lineitem")
    metrics = items.groupBy(F.col("l_returnflag").alias("metric")).agg(F.avg("l_quantity").alias("value"))
    append_training_run(
        spark, path, kind="wait_time", version="v1", parameters={"random_seed": 11}, metrics=metrics
    )
    runs = spark.read.parquet(path)
    return rounded(runs.select("kind", F.explode("metrics").alias("metric", "value")))


_QUEUE_SQL = f"""
    SELECT department_id, count(*) AS events, {r6("avg(queue_length)", "average_queue")},
           {r6("quantile_cont(queue_length, 0.95)", "p95_queue")},
           {r6("avg(available_doctors)", "average_doctors")}
    FROM queue_events GROUP BY department_id"""


@query("report_file", sql(_QUEUE_SQL, "queue_events"))
def report_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "report")
    report = queue_summary(views.queue_events(spark, sf_dir))
    write_report(report, path)
    return rounded(load_report(spark, path, report.schema))


_CANONICAL_COUNTS = """
    SELECT 'departments' AS table_name, count(DISTINCT event_type) AS input_rows FROM keyed
    UNION ALL SELECT 'doctors', count(DISTINCT event_type || '-' || user_id % 4) FROM keyed
    UNION ALL SELECT 'beds', count(DISTINCT user_id) FROM keyed
    UNION ALL SELECT 'staffing_rosters', count(DISTINCT event_type || '-' || date_trunc('day', ts)) FROM keyed
    UNION ALL SELECT 'appointments', count(*) FROM keyed
    UNION ALL SELECT 'encounters', count(*) FROM visits
    UNION ALL SELECT 'queue_events', count(*) FROM visits
    UNION ALL SELECT 'admissions', count_if(rn % 2 = 1) FROM numbered
    UNION ALL SELECT 'bed_events', count(*) FROM numbered"""

# Encounters that start before their queue entry break a row rule; everything below them in the
# reference graph is lost with them, and so is what hangs on a no-show's missing encounter.
_LOST = """
    SELECT 'encounters' AS table_name, count(*) AS lost FROM raw_encounters WHERE early
    UNION ALL SELECT 'queue_events', count(*) FROM raw_encounters WHERE early
    UNION ALL SELECT 'admissions', count(*) FROM admissions
      WHERE encounter_id NOT IN (SELECT encounter_id FROM raw_encounters WHERE NOT early)
    UNION ALL SELECT 'bed_events', count(*) FROM bed_events WHERE admission_id IN (
      SELECT admission_id FROM admissions
      WHERE encounter_id NOT IN (SELECT encounter_id FROM raw_encounters WHERE NOT early))"""
REPORT_SQL = sql(
    """SELECT table_name, input_rows, input_rows - coalesce(lost, 0) AS valid_rows,
              coalesce(lost, 0) AS quarantined_rows
       FROM canonical_counts LEFT JOIN losses USING (table_name)""",
    "raw_encounters",
    "bed_events",
    "admissions",
    canonical_counts=_CANONICAL_COUNTS,
    losses=_LOST,
)


@query("validation_report", REPORT_SQL)
def validation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate_dataset(views.canonical_dataset(spark, sf_dir, anomalies=True, stage=True)).report


def _publish(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    tables = views.canonical_dataset(spark, sf_dir, anomalies=True, stage=True)
    root = new_path(spark, "publication")
    key = publish_dataset(
        tables,
        validate_dataset(tables),
        root,
        name="events",
        configuration={"source": "events", "anomalies": True},
        date_range=("2024-01-01", "2024-01-31"),
    )
    return root, key


@query(
    "published_layers",
    REPORT_SQL.replace("SELECT table_name, input_rows, input_rows - coalesce(lost, 0) AS valid_rows,\n"
                       "              coalesce(lost, 0) AS quarantined_rows",
                       "SELECT table_name, input_rows AS raw_rows, input_rows - coalesce(lost, 0) AS bronze_rows"),
)
def published_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish, then ingest the raw text layer again and read the clean layer."""
    root, key = _publish(spark, sf_dir)
    raw = ingest_extract(spark, published_folder(spark, root, "events", key, "raw"))
    bronze = read_table_dir(spark, published_folder(spark, root, "events", key, "bronze"))
    return table_counts(raw, "raw_rows").join(table_counts(bronze, "bronze_rows"), "table_name")


@query(
    "dataset_manifest",
    REPORT_SQL.replace("SELECT table_name, input_rows, input_rows - coalesce(lost, 0) AS valid_rows,\n"
                       "              coalesce(lost, 0) AS quarantined_rows",
                       "SELECT 'events' AS dataset_name, table_name, "
                       "input_rows - coalesce(lost, 0) AS row_count, coalesce(lost, 0) AS anomaly_count"),
)
def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = views.canonical_dataset(spark, sf_dir, anomalies=True, stage=True)
    row = dataset_manifest(
        spark,
        validate_dataset(tables).report,
        {"source": "events"},
        name="events",
        date_range=("2024-01-01", "2024-01-31"),
    )
    entries = row.select("dataset_name", "anomaly_counts", F.explode("row_counts").alias("table_name", "row_count"))
    return entries.select(
        "dataset_name", "table_name", "row_count",
        F.col("anomaly_counts")[F.col("table_name")].alias("anomaly_count"),
    )
