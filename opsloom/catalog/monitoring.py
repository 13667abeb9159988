"""Queries over missing and duplicate rates, drift, degradation and alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsloom.catalog.registry import query, rounded
from opsloom.operators import monitoring as mon
from opsloom.operators.metrics import regression_metrics
from opsloom.operators.profile import ranked_drift
from opsloom.operators.splits import fraction_split
from opsloom.sources import views

# --- reference and current halves of lineitem by ship date -------------------------------

_NUMERIC = ("l_quantity", "l_extendedprice", "l_discount", "l_linenumber", "l_late")
_TEXT = ("l_returnflag", "l_note", "l_shipdate")
_COLUMNS = (*_NUMERIC, *_TEXT)
_CUT = "TIMESTAMP '2000-01-01 00:00:00'"


def _sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    items = views.driver_table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_quantity",
        F.when(F.col("l_discount") < 0.09, F.col("l_extendedprice")).alias("l_extendedprice"),
        "l_discount",
        "l_linenumber",
        (F.col("l_tax") > 0.04).alias("l_late"),
        "l_returnflag",
        F.when(F.col("l_discount") >= 0.05, F.col("l_linestatus")).alias("l_note"),
        "l_shipdate",
    )
    return items.where(f"l_shipdate < {_CUT}"), items.where(f"l_shipdate >= {_CUT}")


_ITEMS = """
    SELECT l_orderkey, l_quantity, CASE WHEN l_discount < 0.09 THEN l_extendedprice END AS l_extendedprice,
           l_discount, l_linenumber, l_tax > 0.04 AS l_late, l_returnflag,
           CASE WHEN l_discount >= 0.05 THEN l_linestatus END AS l_note, l_shipdate FROM lineitem"""
_CTES = f"""
    items AS ({_ITEMS}),
    old_rows AS (SELECT * FROM items WHERE l_shipdate < {_CUT}),
    new_rows AS (SELECT * FROM items WHERE l_shipdate >= {_CUT})"""


def _psi_sql() -> str:
    """Index per column from sorted values, with the quantile positions as binary doubles."""
    long = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {c}::DOUBLE AS value, {side} AS is_new FROM {table} WHERE {c} IS NOT NULL"
        for c in _NUMERIC
        for side, table in ((0, "old_rows"), (1, "new_rows"))
    )
    return f"""
    long_rows AS ({long}),
    sorted AS (SELECT feature, list(value ORDER BY value) AS v, count(*) AS n FROM long_rows WHERE is_new = 0 GROUP BY 1),
    positions AS (SELECT feature, v, n, i, CASE WHEN i = 10 THEN (n - 1)::DOUBLE ELSE (n - 1) * (i * 0.1::DOUBLE) END AS pos
                  FROM sorted, (SELECT unnest(range(0, 11)) AS i)),
    parts AS (SELECT feature, i, v[floor(pos)::BIGINT + 1] AS a, v[ceil(pos)::BIGINT + 1] AS b, pos - floor(pos) AS t FROM positions),
    edges AS (SELECT feature, list_sort(list(DISTINCT CASE WHEN t >= 0.5 THEN b - (b - a) * (1 - t) ELSE a + (b - a) * t END)) AS e
              FROM parts GROUP BY 1),
    binned AS (SELECT l.feature, is_new, len(list_filter(e[2:len(e) - 1], lambda x: x <= value)) AS bin
               FROM long_rows l JOIN edges USING (feature)),
    slots AS (SELECT feature, unnest(range(0, len(e) - 1)) AS bin FROM edges),
    totals AS (SELECT feature, count(*) FILTER (WHERE is_new = 0) AS old_n, count(*) FILTER (WHERE is_new = 1) AS new_n
               FROM long_rows GROUP BY feature),
    shares AS (SELECT feature, bin, greatest(old_count / old_n, 1e-6) AS old_share,
                      greatest(new_count / new_n, 1e-6) AS new_share
               FROM (SELECT s.feature, s.bin, count(*) FILTER (WHERE is_new = 0) AS old_count,
                            count(*) FILTER (WHERE is_new = 1) AS new_count
                     FROM slots s LEFT JOIN binned b ON b.feature = s.feature AND b.bin = s.bin
                     GROUP BY s.feature, s.bin) JOIN totals USING (feature)),
    numeric_scores AS (SELECT feature, sum((new_share - old_share) * ln(new_share / old_share)) AS score
                       FROM shares GROUP BY feature)"""


def _text_sql() -> str:
    parts = []
    for c in _TEXT:
        parts.append(
            f"""SELECT '{c}' AS feature, sum(abs(o / (SELECT count(*) FROM old_rows) - n / (SELECT count(*) FROM new_rows))) / 2 AS score
                FROM (SELECT coalesce({c}::VARCHAR, '<missing>') AS v, count(*) FILTER (WHERE s = 0) AS o,
                             count(*) FILTER (WHERE s = 1) AS n
                      FROM (SELECT {c}, 0 AS s FROM old_rows UNION ALL SELECT {c}, 1 FROM new_rows) GROUP BY 1)"""
        )
    return "text_scores AS (" + " UNION ALL ".join(parts) + ")"


_NUMERIC_SQL = f"WITH {_CTES}, {_psi_sql()}"
_ALL_SQL = f"{_NUMERIC_SQL}, {_text_sql()}"


@query("numeric_drift", f"{_NUMERIC_SQL} SELECT feature, round(score, 6) AS score FROM numeric_scores WHERE feature <> 'l_late'")
def numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(mon.numeric_drift(*_sides(spark, sf_dir), [c for c in _NUMERIC if c != "l_late"]))


@query("categorical_drift", f"WITH {_CTES}, {_text_sql()} SELECT feature, round(score, 6) AS score FROM text_scores")
def categorical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(mon.categorical_drift(*_sides(spark, sf_dir), _TEXT))


@query(
    "feature_drift",
    f"""{_ALL_SQL} SELECT feature, round(score, 6) AS score
        FROM (SELECT * FROM numeric_scores UNION ALL SELECT * FROM text_scores)""",
)
def drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _sides(spark, sf_dir)
    return rounded(ranked_drift(mon.feature_drift(old.select(*_COLUMNS), new.select(*_COLUMNS))))


_MISSING = """(SELECT (count(*) FILTER (WHERE l_extendedprice IS NULL) + count(*) FILTER (WHERE l_note IS NULL)
                        + count(*)) / (4.0::DOUBLE * count(*)) FROM new_rows)"""
_REQUIRED = ("l_quantity", "l_extendedprice", "l_note", "l_gone")


@query("missing_rate", f"WITH {_CTES} SELECT round({_MISSING}, 6) AS missing_rate")
def missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(mon.missing_rate(_sides(spark, sf_dir)[1], _REQUIRED))


@query(
    "duplicate_rate",
    """SELECT round(1 - (SELECT count(*) FROM (SELECT DISTINCT * FROM lineitem))
              / (SELECT count(*) FROM lineitem), 6) AS duplicate_rate""",
)
def duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(mon.duplicate_rate(views.driver_table(spark, sf_dir, "lineitem")))


def _metrics(frame: DataFrame, factor: float) -> DataFrame:
    rows = frame.where("l_extendedprice is not null").withColumn("p", F.col("l_quantity") * factor)
    return regression_metrics(rows, "l_extendedprice", "p")


def _metric_sql(table: str, factor: float, names: tuple[str, ...]) -> str:
    error = f"(l_quantity * {factor}::DOUBLE - l_extendedprice)"
    formulas = {
        "mae": f"avg(abs({error}))",
        "rmse": f"sqrt(avg({error} * {error}))",
        "underprediction_rate": f"avg(({error} < 0)::INTEGER)",
        "median_absolute_error": f"quantile_cont(abs({error}), 0.5)",
        "p90_absolute_error": f"quantile_cont(abs({error}), 0.9)",
    }
    listed = ", ".join(f"'{n}'" for n in names)
    values = ", ".join(f"({formulas[n]})::DOUBLE" for n in names)
    return f"SELECT unnest([{listed}]) AS metric, unnest([{values}]) AS value FROM {table} WHERE l_extendedprice IS NOT NULL"


_ALL_METRICS = ("mae", "rmse", "underprediction_rate", "median_absolute_error", "p90_absolute_error")
_DEGRADED = f"""
    old_metrics AS ({_metric_sql("old_rows", 2000.0, _ALL_METRICS)}
                    UNION ALL SELECT 'recall', 0.8::DOUBLE),
    new_metrics AS ({_metric_sql("new_rows", 1500.0, _ALL_METRICS[:-1])}
                    UNION ALL SELECT 'recall', 0.6::DOUBLE),
    degradation AS (SELECT o.metric, CASE WHEN n.metric IS NULL THEN 1.0::DOUBLE ELSE greatest(0.0,
                      CASE WHEN o.metric = 'recall' THEN o.value - n.value ELSE n.value - o.value END
                      / greatest(abs(o.value), 1e-9)) END AS degradation
                    FROM old_metrics o LEFT JOIN new_metrics n USING (metric))"""


def _metric_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    old, new = _sides(spark, sf_dir)
    recall = "metric string, value double"
    before = _metrics(old, 2000.0).unionByName(spark.createDataFrame([("recall", 0.8)], recall))
    after = _metrics(new, 1500.0).where("metric <> 'p90_absolute_error'")
    return before, after.unionByName(spark.createDataFrame([("recall", 0.6)], recall))


@query(
    "metric_degradation",
    f"WITH {_CTES}, {_DEGRADED} SELECT metric, round(degradation, 6) AS degradation FROM degradation",
)
def degradation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(mon.metric_degradation(*_metric_tables(spark, sf_dir)))


_REPORT_COLUMNS = ("l_quantity", "l_extendedprice", "l_late", "l_returnflag", "l_note", "l_shipdate")
_CHECKS = f"""{_ALL_SQL}, {_DEGRADED},
    checks AS (
      SELECT 'data_quality' AS component, 'missing_rate' AS metric,
             (SELECT (count(*) FILTER (WHERE l_extendedprice IS NULL) + count(*) FILTER (WHERE l_note IS NULL))
                     / (6.0::DOUBLE * count(*)) FROM new_rows) AS observed, 0.05::DOUBLE AS threshold,
             'Required-field missing rate exceeded its threshold.' AS message
      UNION ALL SELECT 'data_quality', 'duplicate_rate',
             1 - (SELECT count(*) FROM (SELECT DISTINCT * FROM new_rows)) / (SELECT count(*) FROM new_rows),
             0.01, 'Duplicate-row rate exceeded its threshold.'
      UNION ALL SELECT 'drift', feature, score, 0.2, 'Feature drift requires review.'
        FROM (SELECT * FROM numeric_scores UNION ALL SELECT * FROM text_scores)
        WHERE feature IN ({", ".join(f"'{c}'" for c in _REPORT_COLUMNS)})
      UNION ALL SELECT 'performance', metric, degradation, 0.1, 'Model metric degradation requires review.'
        FROM degradation)"""


def _report(spark: SparkSession, sf_dir: str) -> mon.MonitoringReport:
    old, new = _sides(spark, sf_dir)
    return mon.monitoring_report(old, new, *_metric_tables(spark, sf_dir), _REPORT_COLUMNS)


@query(
    "monitoring_checks",
    f"""{_CHECKS} SELECT component, metric, round(observed, 6) AS observed, threshold, message,
                         observed > threshold AS alert FROM checks""",
)
def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_report(spark, sf_dir).checks)


@query(
    "monitoring_status",
    f"""{_CHECKS} SELECT CASE WHEN count(*) FILTER (WHERE observed > threshold) > 0 THEN 'review_required'
                              ELSE 'healthy' END AS status,
                         count(*) FILTER (WHERE observed > threshold) AS alerts,
                         (SELECT count(*) FROM old_rows) AS reference_rows, (SELECT count(*) FROM new_rows) AS current_rows
                  FROM checks""",
)
def status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mon.monitoring_status(_report(spark, sf_dir))


@query(
    "appointment_drift",
    """WITH rows AS (SELECT event_type, value, row_number() OVER (ORDER BY ts, event_id)
                            <= (SELECT floor(count(*) * 0.7::DOUBLE) FROM events) AS old FROM events)
       SELECT 'event_type' AS feature, round(sum(abs(o / (SELECT count(*) FROM rows WHERE old)
                - n / (SELECT count(*) FROM rows WHERE NOT old))) / 2, 6) AS score
       FROM (SELECT event_type, count(*) FILTER (WHERE old) AS o, count(*) FILTER (WHERE NOT old) AS n
             FROM rows GROUP BY 1)""",
)
def appointment_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drift of the newest 30 % of the events against the first 70 %."""
    events = views.driver_table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    parts = fraction_split(events, "ts", "event_id")
    old, new = (parts.where(f"part = '{p}'").select("event_type") for p in ("reference", "current"))
    return rounded(mon.feature_drift(old, new))
