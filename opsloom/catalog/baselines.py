"""Queries over naive baselines and the flagship baseline report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsloom.catalog.features import LEAKAGE_SQL, hospital_tables, waiting_rows
from opsloom.catalog.registry import query, r6, rounded, sql, stamp
from opsloom.catalog.targets import arrivals, occupancy
from opsloom.functions.staging import materialize
from opsloom.operators.baselines import (
    SERIES_BASELINES,
    arrival_baseline_report,
    backtest_arrival_baselines,
    backtest_baseline_metrics,
    backtest_occupancy_baselines,
    last_observed,
    median_baselines,
    median_of,
    seasonal_mean,
    series_baselines,
    waiting_baseline_report,
)
from opsloom.operators.metrics import regression_metrics
from opsloom.operators.splits import TemporalSplit, rolling_origin_windows, temporal_split
from opsloom.plans.baseline_report import baseline_analysis, report_rows


def wait_split(spark: SparkSession, sf_dir: str) -> TemporalSplit:
    return temporal_split(waiting_rows(spark, sf_dir), "queue_entered_at")


def arrival_split(spark: SparkSession, sf_dir: str) -> TemporalSplit:
    return temporal_split(materialize(arrivals(spark, sf_dir), "arrivals"), "interval_start")


MEDIANS_SQL = """
    SELECT t.encounter_id, t.wait_minutes, g.m AS global_median, coalesce(d.m, g.m) AS department_median,
           coalesce(x.m, g.m) AS department_weekday_hour_median
    FROM (SELECT * FROM wait_split WHERE split = 'test') t
    CROSS JOIN (SELECT quantile_cont(wait_minutes, 0.5) AS m FROM wait_split WHERE split = 'train') g
    LEFT JOIN (SELECT department_id, quantile_cont(wait_minutes, 0.5) AS m FROM wait_split
               WHERE split = 'train' GROUP BY ALL) d USING (department_id)
    LEFT JOIN (SELECT department_id, weekday, hour, quantile_cont(wait_minutes, 0.5) AS m FROM wait_split
               WHERE split = 'train' GROUP BY ALL) x USING (department_id, weekday, hour)"""


def regression_sql(source: str, actual: str, predicted: str, keys: str = "") -> str:
    """Tidy regression metrics in SQL."""
    lead = f"{keys}, " if keys else ""
    error = f"({predicted} - {actual})"
    measures = {
        "mae": f"avg(abs({error}))",
        "rmse": f"sqrt(avg({error} * {error}))",
        "underprediction_rate": f"avg(CASE WHEN {error} < 0 THEN 1.0 ELSE 0.0 END)",
        "median_absolute_error": f"quantile_cont(abs({error}), 0.5)",
        "p90_absolute_error": f"quantile_cont(abs({error}), 0.9)",
    }
    return _tidy(source, measures, lead)


def forecast_sql(source: str, actual: str, predicted: str, keys: str = "", beds: bool = False) -> str:
    lead = f"{keys}, " if keys else ""
    error = f"({predicted} - {actual})"
    suffix = "_beds" if beds else ""
    measures = {
        f"mae{suffix}": f"avg(abs({error}))",
        f"rmse{suffix}": f"sqrt(avg({error} * {error}))",
        "wape": f"sum(abs({error})) / greatest(sum(abs({actual})), 1.0)",
    }
    if not beds:
        measures["bias"] = f"avg({error})"
    return _tidy(source, measures, lead)


def _tidy(source: str, measures: dict[str, str], lead: str) -> str:
    names = ", ".join(f"'{m}'" for m in measures)
    values = ", ".join(f"round(CAST({v} AS DOUBLE), 6)" for v in measures.values())
    group = f"GROUP BY {lead[:-2]}" if lead else ""
    return f"SELECT {lead}unnest([{names}]) AS metric, unnest([{values}]) + 0.0 AS value FROM {source} {group}"


MEDIANS_LONG = """
    SELECT 'global_median' AS model, wait_minutes, global_median AS prediction FROM medians
    UNION ALL SELECT 'department_median', wait_minutes, department_median FROM medians
    UNION ALL SELECT 'department_weekday_hour_median', wait_minutes, department_weekday_hour_median FROM medians"""
WAIT_REPORT_SQL = regression_sql("(" + MEDIANS_LONG + ") AS long_rows", "wait_minutes", "prediction", "model")


@query(
    "median_baselines",
    sql(
        f"""SELECT encounter_id, {r6("global_median", "global_median")}, {r6("department_median", "department_median")},
                   {r6("department_weekday_hour_median", "department_weekday_hour_median")} FROM medians""",
        "wait_split",
        medians=MEDIANS_SQL,
    ),
)
def medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = wait_split(spark, sf_dir)
    predicted = median_baselines(parts.train, parts.test)
    return rounded(
        predicted.select(
            "encounter_id", "global_median", "department_median", "department_weekday_hour_median"
        )
    )


@query("waiting_baseline_report", sql(WAIT_REPORT_SQL, "wait_split", medians=MEDIANS_SQL))
def wait_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = wait_split(spark, sf_dir)
    return rounded(waiting_baseline_report(parts.train, parts.test))


@query(
    "median_gate",
    sql(
        regression_sql(
            """(SELECT wait_minutes, (SELECT quantile_cont(wait_minutes, 0.5) FROM wait_split
                                      WHERE split <> 'test') AS prediction
                FROM wait_split WHERE split = 'test') AS scored""",
            "wait_minutes",
            "prediction",
        ),
        "wait_split",
    ),
)
def median_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of the constant median of train and validation: what a model has to beat."""
    parts = wait_split(spark, sf_dir)
    constant = median_of(parts.development, "wait_minutes").scalar()
    return rounded(
        regression_metrics(parts.test.withColumn("prediction", constant), "wait_minutes", "prediction")
    )


@query(
    "last_observed",
    sql(
        """SELECT department_id, arg_max(arrivals, interval_start)::DOUBLE AS last_observed
           FROM arrival_split WHERE split = 'train' GROUP BY 1""",
        "arrival_split",
    ),
)
def last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return last_observed(arrival_split(spark, sf_dir).train).select("department_id", "last_observed")


@query(
    "seasonal_mean",
    sql(
        f"""SELECT department_id, isodow(interval_start) - 1 AS weekday, hour(interval_start) AS hour,
                   {r6("avg(arrivals)", "seasonal_mean")}
            FROM arrival_split WHERE split = 'train' GROUP BY 1, 2, 3""",
        "arrival_split",
    ),
)
def seasonal(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = seasonal_mean(arrival_split(spark, sf_dir).train)
    return rounded(
        means.select(
            "department_id", F.col("_weekday").alias("weekday"), F.col("_hour").alias("hour"), "seasonal_mean"
        )
    )


def _series_sql(history: str, future: str, groups: tuple[str, ...], value: str, carry: str) -> str:
    keys = ", ".join(groups)
    return f"""
    SELECT {", ".join("f." + g for g in groups)}, f.interval_start, f.{value}{carry},
           coalesce(l.v, g.m)::DOUBLE AS last_observed,
           coalesce(d.{value}, s.m, g.m)::DOUBLE AS same_hour_previous_day,
           coalesce(w.{value}, s.m, g.m)::DOUBLE AS same_hour_previous_week,
           coalesce(s.m, g.m)::DOUBLE AS seasonal_mean
    FROM {future} f
    CROSS JOIN (SELECT quantile_cont({value}, 0.5) AS m FROM {history}) g
    LEFT JOIN (SELECT {keys}, arg_max({value}, interval_start) AS v FROM {history} GROUP BY ALL) l USING ({keys})
    LEFT JOIN (SELECT {keys}, isodow(interval_start) AS dow, hour(interval_start) AS h, avg({value}) AS m
               FROM {history} GROUP BY ALL) s
      ON {" AND ".join(f"s.{g} = f.{g}" for g in groups)} AND s.dow = isodow(f.interval_start) AND s.h = hour(f.interval_start)
    LEFT JOIN {history} d
      ON {" AND ".join(f"d.{g} = f.{g}" for g in groups)} AND d.interval_start = f.interval_start - INTERVAL 24 HOUR
    LEFT JOIN {history} w
      ON {" AND ".join(f"w.{g} = f.{g}" for g in groups)} AND w.interval_start = f.interval_start - INTERVAL 168 HOUR"""


_TRAIN = "(SELECT * FROM arrival_split WHERE split = 'train')"
_TEST = "(SELECT * FROM arrival_split WHERE split = 'test')"
SERIES_SQL = _series_sql(_TRAIN, _TEST, ("hospital_id", "department_id"), "arrivals", "")


def long_sql(source: str, models: tuple[str, ...], columns: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{m}' AS model, {columns}, {m} AS prediction FROM {source}" for m in models
    )


SERIES_REPORT_SQL = forecast_sql(
    f"({long_sql('predicted', SERIES_BASELINES, 'arrivals')}) AS long_rows", "arrivals", "prediction", "model"
)


@query(
    "seasonal_naive",
    sql(
        f"""SELECT department_id, {stamp("interval_start")}, arrivals, last_observed,
                   {r6("same_hour_previous_day", "same_hour_previous_day")},
                   {r6("same_hour_previous_week", "same_hour_previous_week")},
                   {r6("seasonal_mean", "seasonal_mean")}
            FROM predicted""",
        "arrival_split",
        predicted=SERIES_SQL,
    ),
)
def naive(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = arrival_split(spark, sf_dir)
    predicted = series_baselines(parts.train, parts.test)
    return rounded(predicted.drop("hospital_id"))


@query("arrival_baseline_report", sql(SERIES_REPORT_SQL, "arrival_split", predicted=SERIES_SQL))
def arrival_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = arrival_split(spark, sf_dir)
    return rounded(arrival_baseline_report(parts.train, parts.test))


@query(
    "baseline_report",
    sql(
        f"""SELECT 'waiting_time' AS target, * FROM ({WAIT_REPORT_SQL})
            UNION ALL SELECT 'arrivals', * FROM ({SERIES_REPORT_SQL})""",
        "wait_split",
        "arrival_split",
        medians=MEDIANS_SQL,
        predicted=SERIES_SQL,
    ),
)
def baseline_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: the whole baseline analysis, as its metrics table."""
    report = baseline_analysis(hospital_tables(spark, sf_dir))
    return rounded(report.metrics)


def _cells_sql(part: str, source: str, item: str, fields: dict[str, str]) -> str:
    """The cells of one result table: ``fields`` gives the expression of each number."""
    names = ", ".join(f"'{f}'" for f in fields)
    values = ", ".join(f"round(CAST({v} AS DOUBLE), 6) + 0.0" for v in fields.values())
    return f"""SELECT '{part}' AS part, {item} AS item, unnest([{names}]) AS field, unnest([{values}]) AS value,
                      CAST(NULL AS VARCHAR) AS instant FROM {source}"""


def _boundary_cells_sql(target: str, view: str, time: str) -> str:
    item = f"'{target}/' || split"
    group = f"FROM {view} GROUP BY split"
    times = "\nUNION ALL ".join(
        f"SELECT 'split_boundaries', {item}, '{field}', NULL, {stamp(f'{f}({time})', 'instant')} {group}"
        for field, f in (("first_time", "min"), ("last_time", "max"))
    )
    return _cells_sql("split_boundaries", f"{view} GROUP BY split", item, {"rows": "count(*)"}) + "\nUNION ALL " + times


_PROFILED = {
    "appointments": (
        "appointment_id patient_key hospital_id department_id doctor_id event_time recorded_time ingested_time "
        "booking_created_at scheduled_at appointment_type priority_type reminder_sent status"
    ).split(),
    "encounters": (
        "encounter_id appointment_id department_id event_time recorded_time ingested_time queue_entered_at "
        "consultation_started_at consultation_ended_at checkout_at"
    ).split(),
    "queue_events": (
        "queue_event_id encounter_id department_id event_time recorded_time ingested_time queue_length "
        "available_doctors available_rooms"
    ).split(),
}


def _profile_cells_sql() -> str:
    parts = []
    for table, columns in _PROFILED.items():
        kinds = f"(SELECT count(*) FROM (SELECT DISTINCT * FROM {table}_rows))"
        whole = {"rows": "count(*)", "columns": f"count(*) * 0 + {len(columns)}", "duplicate_rows": f"count(*) - {kinds}"}
        cells = {f"{table}/{m}": v for m, v in whole.items()}
        cells.update({f"{table}/{c}/null_rate": f"avg(({c} IS NULL)::INTEGER)" for c in columns})
        for item, value in cells.items():
            parts.append(_cells_sql("eda_profile", f"{table}_rows", f"'{item}'", {"value": value}))
        for c in columns:
            for f in ("minimum", "maximum") if c.endswith(("_at", "_time")) else ():
                at = stamp(f"{f[:3]}({c})", "instant")
                parts.append(f"SELECT 'eda_profile', '{table}/{c}/{f}', 'instant', NULL, {at} FROM {table}_rows")
    return "\nUNION ALL ".join(parts)


_RECORDED = "event_time + to_minutes(1) AS recorded_time, event_time + to_minutes(2) AS ingested_time"
_REPORT_PARTS = [
    f"SELECT 'baseline_metrics' AS part, 'waiting_time/' || model || '/' || metric AS item, 'value' AS field, value, NULL AS instant FROM ({WAIT_REPORT_SQL})",
    f"SELECT 'baseline_metrics', 'arrivals/' || model || '/' || metric, 'value', value, NULL FROM ({SERIES_REPORT_SQL})",
    _boundary_cells_sql("waiting_time", "wait_split", "queue_entered_at"),
    _boundary_cells_sql("arrivals", "arrival_split", "interval_start"),
    _cells_sql("leakage_checks", f"({LEAKAGE_SQL})", "check_name", {"passed": "passed::INTEGER"}),
    _profile_cells_sql(),
    _cells_sql("eda_queue", "queue_events GROUP BY department_id", "department_id", {
        "events": "count(*)",
        "average_queue": "avg(queue_length)",
        "p95_queue": "quantile_cont(queue_length, 0.95)",
        "average_doctors": "avg(available_doctors)",
    }),
    _cells_sql("eda_demand", "arrivals GROUP BY department_id", "department_id", {
        "average_hourly_arrivals": "avg(arrivals)",
        "p95_hourly_arrivals": "quantile_cont(arrivals, 0.95)",
        "peak_hourly_arrivals": "max(arrivals)",
    }),
]


@query(
    "baseline_report_tables",
    sql(
        "SELECT * FROM (" + "\nUNION ALL ".join(_REPORT_PARTS) + ") WHERE value IS NOT NULL OR instant IS NOT NULL",
        "appointments",
        "queue_events",
        "wait_split",
        "arrival_split",
        medians=MEDIANS_SQL,
        predicted=SERIES_SQL,
        appointments_rows="SELECT * FROM appointments",
        encounters_rows=f"SELECT *, {_RECORDED} FROM (SELECT *, queue_entered_at AS event_time FROM encounters)",
        queue_events_rows=f"""SELECT *, {_RECORDED} FROM (SELECT q.*, entered AS event_time FROM queue_events q
                              JOIN visits ON encounter_id = CAST(event_id AS VARCHAR))""",
    ),
)
def whole_baseline_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All result tables of the baseline analysis: metrics, boundaries, checks, profile, queues, demand."""
    return rounded(report_rows(baseline_analysis(hospital_tables(spark, sf_dir))))


def _windows_sql(view: str) -> dict[str, str]:
    return {
        "origins": f"""SELECT w AS window_id, t[24 * w + 1] AS cutoff FROM (
                         SELECT list(DISTINCT interval_start).list_sort('DESC') AS t FROM {view}), (
                         SELECT unnest([1, 2, 3]) AS w)""",
        "history": f"SELECT a.*, window_id, cutoff FROM {view} a JOIN origins ON interval_start <= cutoff",
        "future": f"""SELECT a.*, window_id, cutoff FROM {view} a JOIN origins
                      ON interval_start > cutoff AND interval_start <= cutoff + INTERVAL 24 HOUR""",
    }


_POOLED = """(SELECT h AS horizon, l.* FROM ({long}) l, (SELECT unnest([6, 12, 24]) AS h)
              WHERE interval_start <= cutoff + to_hours(h)) AS pooled"""
_BACKTEST_MODELS = SERIES_BASELINES[1:]


@query(
    "backtest_arrival_baselines",
    sql(
        forecast_sql(
            _POOLED.format(long=long_sql("predicted", _BACKTEST_MODELS, "interval_start, cutoff, arrivals")),
            "arrivals",
            "prediction",
            "horizon, model",
        ),
        "arrivals",
        **_windows_sql("arrivals"),
        predicted=_series_sql(
            "history", "future", ("window_id", "hospital_id", "department_id"), "arrivals", ", f.cutoff"
        ),
    ),
)
def backtest_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = materialize(arrivals(spark, sf_dir), "arrivals")
    predicted = backtest_arrival_baselines(target, rolling_origin_windows(target, 3))
    return rounded(backtest_baseline_metrics(predicted, _BACKTEST_MODELS, "arrivals"))


_BED_MODELS = ("same_hour_previous_day", "same_hour_previous_week")


@query(
    "backtest_occupancy_baselines",
    sql(
        forecast_sql(
            _POOLED.format(long=long_sql("predicted", _BED_MODELS, "interval_start, cutoff, occupied_beds")),
            "occupied_beds",
            "prediction",
            "horizon, model",
            beds=True,
        ),
        "occupancy",
        **_windows_sql("occupancy"),
        predicted="""
            SELECT f.interval_start, f.cutoff, f.occupied_beds, d.occupied_beds AS same_hour_previous_day,
                   w.occupied_beds AS same_hour_previous_week
            FROM future f
            LEFT JOIN history d ON d.window_id = f.window_id AND d.ward_id = f.ward_id
              AND d.interval_start = f.interval_start - INTERVAL 24 HOUR
            LEFT JOIN history w ON w.window_id = f.window_id AND w.ward_id = f.ward_id
              AND w.interval_start = f.interval_start - INTERVAL 168 HOUR""",
    ),
)
def backtest_beds(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = materialize(occupancy(spark, sf_dir), "occupancy")
    predicted = backtest_occupancy_baselines(target, rolling_origin_windows(target, 3))
    return rounded(backtest_baseline_metrics(predicted, _BED_MODELS, "occupied_beds", beds=True))
