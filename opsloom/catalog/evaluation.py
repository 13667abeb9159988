"""Queries over evaluation metrics, on closed-form predictions of table columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsloom.catalog.baselines import forecast_sql, regression_sql
from opsloom.catalog.features import wait_rows
from opsloom.catalog.registry import query, rounded, sql
from opsloom.catalog.targets import occupancy
from opsloom.operators import metrics
from opsloom.sources import views

# The closed-form "model": unit price times quantity predicts the extended price.
_PREDICTED = "l_quantity * 2000.0::DOUBLE"


def _priced(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = views.driver_table(spark, sf_dir, "lineitem")
    return items.select(
        "l_returnflag",
        F.col("l_linenumber").alias("horizon"),
        F.col("l_extendedprice").alias("actual"),
        (F.col("l_quantity") * 2000.0).alias("predicted"),
    )


_ROWS = f"""(SELECT l_returnflag, l_linenumber AS horizon, l_extendedprice AS actual, {_PREDICTED} AS predicted
            FROM lineitem) AS scored"""


@query("regression_metrics", regression_sql(_ROWS, "actual", "predicted", "l_returnflag"))
def regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.regression_metrics(_priced(spark, sf_dir), "actual", "predicted", ["l_returnflag"]))


@query("regression_metrics_total", regression_sql(_ROWS, "actual", "predicted"))
def regression_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.regression_metrics(_priced(spark, sf_dir), "actual", "predicted"))


@query("forecast_metrics", forecast_sql(_ROWS, "actual", "predicted", "horizon"))
def forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.forecast_metrics(_priced(spark, sf_dir), "actual", "predicted", ["horizon"]))


@query(
    "peak_mae",
    f"""SELECT horizon, 'peak_mae' AS metric, round(avg(abs(predicted - actual)), 6) AS value
        FROM (SELECT *, quantile_cont(actual, 0.9) OVER (PARTITION BY horizon) AS peak FROM {_ROWS})
        WHERE actual >= peak GROUP BY horizon""",
)
def peaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.peak_mae(_priced(spark, sf_dir), "actual", "predicted", ["horizon"]))


@query(
    "slice_metrics",
    sql(
        regression_sql(
            """(SELECT 'department_id' AS dimension, department_id AS slice, wait_minutes, 10.0 * queue_length::DOUBLE AS p
                FROM wait_features
                UNION ALL SELECT 'congestion', CASE WHEN queue_length <= 1 THEN 'low' WHEN queue_length <= 3
                  THEN 'medium' ELSE 'high' END, wait_minutes, 10.0 * queue_length::DOUBLE FROM wait_features) AS slices""",
            "wait_minutes",
            "p",
            "dimension, slice",
        ),
        "wait_features",
    ),
)
def slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = wait_rows(spark, sf_dir).withColumn("p", F.lit(10.0) * F.col("queue_length"))
    return rounded(metrics.slice_metrics(rows, "wait_minutes", "p"))


@query(
    "interval_coverage",
    """SELECT l_returnflag, 'interval_coverage' AS metric,
              round(avg((l_extendedprice BETWEEN l_quantity * 1500 AND l_quantity * 2500)::INTEGER), 6) AS value
       FROM lineitem GROUP BY 1""",
)
def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = views.driver_table(spark, sf_dir, "lineitem").withColumns(
        {"low": F.col("l_quantity") * 1500, "high": F.col("l_quantity") * 2500}
    )
    return rounded(metrics.interval_coverage(items, "l_extendedprice", "low", "high", ["l_returnflag"]))


def scored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No-show label and a closed-form probability with ties."""
    e = views.keyed_events(spark, sf_dir)
    p = (F.col("k") * 7 + F.col("user_id") * 3) % 101 / F.lit(101.0)
    return e.select(
        "event_id",
        "event_type",
        (F.col("k") % 4 == 0).cast("int").alias("actual"),
        p.alias("p"),
    )


SCORED = """SELECT event_id, event_type, (k % 4 = 0)::INTEGER AS actual,
                   ((k * 7 + user_id * 3) % 101) / 101.0::DOUBLE AS p FROM keyed"""
_ECE = """(SELECT {lead} count(*) AS n, avg(actual) AS rate, avg(p) AS mean FROM scored
           GROUP BY {lead} (p >= 0.1)::INT + (p >= 0.2)::INT + (p >= 0.3)::INT + (p >= 0.4)::INT + (p >= 0.5)::INT
             + (p >= 0.6)::INT + (p >= 0.7)::INT + (p >= 0.8)::INT + (p >= 0.9)::INT) AS bins"""


@query(
    "expected_calibration_error",
    sql(
        f"""SELECT event_type, 'expected_calibration_error' AS metric,
                   round(sum(n * abs(rate - mean)) / sum(n), 6) AS value
            FROM {_ECE.format(lead="event_type,")} GROUP BY event_type""",
        "keyed",
        scored=SCORED,
    ),
)
def calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scored_events(spark, sf_dir)
    return rounded(metrics.expected_calibration_error(rows, "actual", "p", ["event_type"]))


_RANKED = """
    SELECT event_type, p, pos, n, sum(pos) OVER w AS pos_upto, sum(n) OVER w AS n_upto
    FROM (SELECT event_type, p, sum(actual) AS pos, count(*) AS n FROM scored GROUP BY ALL)
    WINDOW w AS (PARTITION BY event_type ORDER BY p DESC)"""


@query(
    "classification_metrics",
    sql(
        f"""SELECT event_type, 'pr_auc' AS metric, round(sum(pos * pos_upto / n_upto) / sum(pos), 6) AS value
            FROM ranked GROUP BY event_type
            UNION ALL
            SELECT event_type, 'roc_auc', round(1 - sum(pos * ((n_upto - n) - (pos_upto - pos) + (n - pos) / 2))
              / (sum(pos) * sum(n - pos)), 6) FROM ranked GROUP BY event_type
            UNION ALL
            SELECT event_type, 'expected_calibration_error', round(sum(n * abs(rate - mean)) / sum(n), 6)
            FROM {_ECE.format(lead="event_type,")} GROUP BY event_type
            UNION ALL
            SELECT event_type, unnest(['brier_score', 'selection_rate', 'precision', 'recall', 'f1']),
                   unnest([round(avg(power(p - actual, 2)), 6), round(avg((p >= 0.6)::INTEGER), 6),
                     round(sum(actual * (p >= 0.6)::INTEGER) / greatest(sum((p >= 0.6)::INTEGER), 1), 6),
                     round(sum(actual * (p >= 0.6)::INTEGER) / greatest(sum(actual), 1), 6),
                     round(2 * sum(actual * (p >= 0.6)::INTEGER) / greatest(sum(actual) + sum((p >= 0.6)::INTEGER), 1), 6)])
            FROM scored GROUP BY event_type""",
        "keyed",
        scored=SCORED,
        ranked=_RANKED,
    ),
)
def classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scored_events(spark, sf_dir)
    return rounded(metrics.classification_metrics(rows, "actual", "p", 0.6, ["event_type"]))


@query(
    "confusion_counts",
    sql(
        """SELECT event_type, count(*) FILTER (WHERE actual = 1 AND p >= 0.6) AS true_positive,
                  count(*) FILTER (WHERE actual = 0 AND p >= 0.6) AS false_positive,
                  count(*) FILTER (WHERE actual = 1 AND p < 0.6) AS false_negative,
                  count(*) FILTER (WHERE actual = 0 AND p < 0.6) AS true_negative
           FROM scored GROUP BY event_type""",
        "keyed",
        scored=SCORED,
    ),
)
def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scored_events(spark, sf_dir)
    return metrics.confusion_counts(rows, F.col("actual") == 1, F.col("p") >= 0.6, ["event_type"])


@query(
    "occupancy_metrics",
    sql(
        forecast_sql(
            """(SELECT ward_id, occupied_beds, lag(occupied_beds) OVER (PARTITION BY ward_id ORDER BY interval_start)
                  AS p FROM occupancy QUALIFY p IS NOT NULL) AS scored""",
            "occupied_beds",
            "p",
            "ward_id",
            beds=True,
        ),
        "occupancy",
    ),
)
def bed_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(
        metrics.occupancy_metrics(_hour_before(spark, sf_dir), "occupied_beds", "lag_1", ["ward_id"])
    )


def _hour_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    from opsloom.operators.features import lag_columns

    target = occupancy(spark, sf_dir)
    lagged = target.withColumns(lag_columns("occupied_beds", ["ward_id"], "interval_start", [1]))
    return lagged.where("lag_1 is not null")


@query(
    "alert_metrics",
    sql(
        """SELECT ward_id, unnest(['alert_recall', 'false_alert_rate']) AS metric,
                  unnest([round(tp / greatest(tp + fn, 1), 6), round(fp / greatest(fp + tn, 1), 6)]) AS value
           FROM (SELECT ward_id, count(*) FILTER (WHERE a AND b) AS tp, count(*) FILTER (WHERE NOT a AND b) AS fp,
                        count(*) FILTER (WHERE a AND NOT b) AS fn, count(*) FILTER (WHERE NOT a AND NOT b) AS tn
                 FROM (SELECT ward_id, occupied_beds / staffed_capacity >= 0.5 AS a, p / staffed_capacity >= 0.5 AS b
                       FROM (SELECT *, lag(occupied_beds) OVER (PARTITION BY ward_id ORDER BY interval_start) AS p
                             FROM occupancy) WHERE p IS NOT NULL)
                 GROUP BY ward_id)""",
        "occupancy",
    ),
)
def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _hour_before(spark, sf_dir)
    return rounded(
        metrics.alert_metrics(rows, "occupied_beds", "lag_1", "staffed_capacity", 0.5, ["ward_id"])
    )
