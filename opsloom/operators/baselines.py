"""Naive predictions from training history, scored on later rows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsloom.functions.ranks import exact_percentiles
from opsloom.functions.staging import materialize
from opsloom.operators.joins import join_with_fallback, lookup_shifted
from opsloom.operators.metrics import (
    forecast_metrics,
    occupancy_metrics,
    pivot_models,
    regression_metrics,
)
from opsloom.operators.splits import Window24, future_rows, seen_by
from opsloom.operators.targets import SERIES_KEYS

# The wait baselines and the columns each one groups by.
MEDIAN_BASELINES = {
    "global_median": (),
    "department_median": ("department_id",),
    "department_weekday_hour_median": ("department_id", "weekday", "hour"),
}
SERIES_BASELINES = (
    "last_observed",
    "same_hour_previous_day",
    "same_hour_previous_week",
    "seasonal_mean",
)


def median_of(frame: DataFrame, value: str, keys: Sequence[str] = (), out: str = "median") -> DataFrame:
    return exact_percentiles(frame, keys, value, {out: 0.5}).drop("n")


def baseline_medians(train: DataFrame, label: str = "wait_minutes") -> DataFrame:
    """Medians of all baselines: ``model``, its group columns and ``median``.

    Training rows are counted once per finest group and value; the counts, not the rows, are rolled up
    to the coarser groups, and all medians are ranks among the counts. Columns a baseline does not
    group by are blank. Rows with a null in a column are left out of the groups by that column.
    """
    columns = MEDIAN_BASELINES["department_weekday_hour_median"]
    counted = train.where(F.col(label).isNotNull()).groupBy(*columns, F.col(label).alias("_label")).agg(F.count("*").alias("_n"))
    counted = materialize(counted, "value-counts")
    level, parts = counted, []
    for name, groups in reversed(MEDIAN_BASELINES.items()):
        if len(groups) < len(columns):
            level = level.groupBy(*groups, "_label").agg(F.sum("_n").alias("_n"))
        keys = [(F.col(c).cast("string") if c in groups else F.lit("")).alias(f"_{c}") for c in columns]
        parts.append(level.select(F.lit(name).alias("model"), *keys, "_label", "_n"))
    rolled = reduce(DataFrame.unionByName, parts)
    medians = exact_percentiles(rolled, ["model", *[f"_{c}" for c in columns]], "_label", {"median": 0.5}, weight="_n")
    return medians.drop("n")


def median_baselines(train: DataFrame, test: DataFrame, label: str = "wait_minutes") -> DataFrame:
    """Test rows with one prediction column per median baseline.

    The medians come from training rows only and are written once, a row per group; a group
    unseen in training takes the global median.
    """
    medians = materialize(baseline_medians(train, label), "baseline-medians")
    predicted = test
    fallback = F.lit(None).cast("double")
    for name, groups in MEDIAN_BASELINES.items():
        level = medians.where(F.col("model") == name)
        if not groups:
            predicted = predicted.withColumn(name, level.select("median").scalar())
            fallback = F.col(name)
            continue
        kinds = {c: test.schema[c].dataType for c in groups}
        found = level.select(
            *[F.col(f"_{c}").cast(kinds[c]).alias(c) for c in groups], F.col("median").alias(name)
        )
        predicted = join_with_fallback(predicted, found, groups, {name: fallback})
    return predicted


def waiting_baseline_report(
    train: DataFrame, test: DataFrame, label: str = "wait_minutes"
) -> DataFrame:
    """Regression metrics of the median baselines: ``(model, metric, value)``."""
    predicted = median_baselines(train, test, label)
    long = pivot_models(predicted, {m: m for m in MEDIAN_BASELINES}, label)
    # Scored several times over, so the predictions are written once.
    written = materialize(long, "median-predictions")
    return regression_metrics(written, label, "prediction", ["model"], few_groups=True)


def last_observed(
    train: DataFrame, groups: Sequence[str] = SERIES_KEYS, value: str = "arrivals"
) -> DataFrame:
    """Newest training value per group."""
    newest = F.max_by(value, "interval_start").cast("double")
    return train.groupBy(*groups).agg(newest.alias("last_observed"))


def seasonal_mean(
    train: DataFrame, groups: Sequence[str] = SERIES_KEYS, value: str = "arrivals"
) -> DataFrame:
    """Mean by group, weekday and hour."""
    return train.groupBy(
        *groups,
        F.weekday("interval_start").alias("_weekday"),
        F.hour("interval_start").alias("_hour"),
    ).agg(F.avg(value).alias("seasonal_mean"))


def series_baselines(
    train: DataFrame,
    test: DataFrame,
    groups: Sequence[str] = SERIES_KEYS,
    value: str = "arrivals",
    *,
    names: Sequence[str] = SERIES_BASELINES,
) -> DataFrame:
    """Test rows with one prediction column per series baseline.

    Lookups reach into training rows only. The seasonal mean, and behind it the training median,
    stands in where history has no value.
    """
    calendar = test.withColumns(
        {"_weekday": F.weekday("interval_start"), "_hour": F.hour("interval_start")}
    ).withColumn("_median", median_of(train, value).scalar())
    median = F.col("_median")
    rows = join_with_fallback(
        calendar,
        seasonal_mean(train, groups, value),
        [*groups, "_weekday", "_hour"],
        {"seasonal_mean": median},
    )
    if "last_observed" in names:
        rows = join_with_fallback(
            rows, last_observed(train, groups, value), groups, {"last_observed": median}
        )
    for name, hours in (("same_hour_previous_day", 24), ("same_hour_previous_week", 168)):
        if name in names:
            rows = lookup_shifted(
                rows, train, groups, "interval_start", value, hours=hours, out=name
            ).withColumn(name, F.coalesce(name, "seasonal_mean"))
    return rows.select(*test.columns, *names)


def arrival_baseline_report(train: DataFrame, test: DataFrame) -> DataFrame:
    """Forecast metrics of the series baselines: ``(model, metric, value)``."""
    predicted = series_baselines(train, test)
    long = pivot_models(predicted, {m: m for m in SERIES_BASELINES}, "arrivals")
    return forecast_metrics(long, "arrivals", "prediction", ["model"])


def _recent(target: DataFrame, windows: Sequence[Window24]) -> DataFrame:
    """The rows a lookup of the week before a cut-off can reach.

    A predicted hour lies 24 hours after its cut-off at most, so the hours a day or a week before
    it are in the history of every window that predicts it.
    """
    first, last = min(w.cutoff for w in windows), max(w.cutoff for w in windows)
    since = first - timedelta(hours=168)
    return target.where((F.col("interval_start") > F.lit(since)) & (F.col("interval_start") <= F.lit(last)))


def backtest_arrival_baselines(target: DataFrame, windows: Sequence[Window24]) -> DataFrame:
    """Day, week and seasonal baselines of the predicted hours of all back-test windows.

    Rows carry the windows that see them as bits. Seasonal means of all windows come from one
    grouped pass, the median behind them from counts of values weighted by the number of bits.
    """
    groups, value = list(SERIES_KEYS), "arrivals"
    seen = target.withColumn("_seen", seen_by(windows)).where("_seen <> 0")
    season = [F.weekday("interval_start").alias("_weekday"), F.hour("interval_start").alias("_hour")]
    means = seen.groupBy(*groups, *season).agg(*[
        F.avg(F.when(F.col("_seen").bitwiseAND(F.lit(1 << i).cast("long")) != 0, F.col(value))).alias(f"_mean_{i}")
        for i in range(len(windows))
    ])
    cells = [F.struct(F.lit(w.window).alias("window_id"), F.col(f"_mean_{i}").alias("seasonal_mean")) for i, w in enumerate(windows)]
    means = means.select(*groups, "_weekday", "_hour", F.inline(F.array(*cells))).where("seasonal_mean is not null")
    weights = seen.groupBy(value).agg(F.sum(F.bit_count("_seen")).alias("_weight"))
    median = weights.select(F.percentile(value, 0.5, F.col("_weight"))).scalar()
    future = future_rows(target, windows)
    calendar = future.withColumns({
        "_weekday": F.weekday("interval_start"), "_hour": F.hour("interval_start"), "_median": median
    })
    rows = join_with_fallback(calendar, means, ["window_id", *groups, "_weekday", "_hour"], {"seasonal_mean": F.col("_median")})
    near = _recent(target, windows)
    for name, hours in (("same_hour_previous_day", 24), ("same_hour_previous_week", 168)):
        rows = lookup_shifted(rows, near, groups, "interval_start", value, hours=hours, out=name)
        rows = rows.withColumn(name, F.coalesce(name, "seasonal_mean"))
    return rows.select(*future.columns, *SERIES_BASELINES[1:])


def backtest_occupancy_baselines(target: DataFrame, windows: Sequence[Window24]) -> DataFrame:
    """Beds at the same hour of the previous day and week, per window."""
    rows, near = future_rows(target, windows), _recent(target, windows)
    for name, hours in (("same_hour_previous_day", 24), ("same_hour_previous_week", 168)):
        rows = lookup_shifted(rows, near, ["ward_id"], "interval_start", "occupied_beds", hours=hours, out=name)
    return rows


def backtest_baseline_metrics(
    predicted: DataFrame, models: Sequence[str], value: str, *, beds: bool = False
) -> DataFrame:
    """Metrics per horizon and model, pooled over windows: ``(horizon, model, metric, value)``."""
    long = pivot_models(predicted, {m: m for m in models}, value, "interval_start", "cutoff")
    score = occupancy_metrics if beds else forecast_metrics
    return score(within_horizons(long), value, "prediction", ["horizon", "model"])


# The supported forecast horizons in hours.
HORIZONS = (6, 12, 24)


def within_horizons(rows: DataFrame, horizons: Sequence[int] = HORIZONS) -> DataFrame:
    """Repeat each row for every horizon that still covers it."""
    ahead = (F.unix_micros("interval_start") - F.unix_micros("cutoff")) / F.lit(3_600_000_000)
    listed = F.array(*[F.lit(h) for h in horizons])
    return rows.withColumn("horizon", F.explode(F.filter(listed, lambda h: h >= ahead)))
