"""Table profiles, department summaries and forecast views."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsloom.operators.targets import arrival_target


def duplicate_rows(frame: DataFrame) -> DataFrame:
    """One row: ``rows`` and ``duplicates``, the rows beyond the first of each kind.

    Rows are counted by two hashes first; whole rows meet only where a pair of hashes repeats.
    """
    columns = [F.col(f"`{c}`") for c in frame.columns]
    hashed = frame.withColumns({"_h1": F.xxhash64(*columns), "_h2": F.xxhash64(F.lit(1), *reversed(columns))})
    pairs = hashed.groupBy("_h1", "_h2").agg(F.count("*").alias("_copies"))
    total = pairs.agg(F.coalesce(F.sum("_copies"), F.lit(0)).alias("rows"))
    repeated = hashed.join(pairs.where("_copies > 1").select("_h1", "_h2"), ["_h1", "_h2"], "left_semi")
    kinds = repeated.groupBy("_h1", "_h2", *columns).agg(F.count("*").alias("_copies"))
    extra = kinds.agg(F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicates"))
    return total.select("rows", extra.scalar().alias("duplicates"))


def profile_table(frame: DataFrame, name: str) -> DataFrame:
    """Tidy profile: table size, duplicates, null rate per column, range per time column.

    Rows are ``(table_name, column_name, measure, value, instant)``; counts and rates fill
    ``value``, times fill ``instant``. Nulls and ranges come from one wide aggregation.
    """
    columns = frame.columns
    timed = [c for c in columns if c.endswith(("_at", "_time"))]
    rate = {
        f"null_{i}": F.round(F.coalesce(F.avg(F.col(c).isNull().cast("double")), F.lit(0.0)), 6)
        for i, c in enumerate(columns)
    }
    span = {}
    for i, c in enumerate(timed):
        span[f"min_{i}"], span[f"max_{i}"] = F.min(c), F.max(c)
    wide = frame.agg(*[e.alias(n) for n, e in {**rate, **span}.items()])
    number = F.lit(None).cast("double")
    instant = F.lit(None).cast("timestamp")

    def entry(column, measure, value=number, at=instant):
        return F.struct(
            F.lit(column).alias("column_name"),
            F.lit(measure).alias("measure"),
            value.alias("value"),
            at.alias("instant"),
        )

    cells = [entry(c, "null_rate", F.col(f"null_{i}")) for i, c in enumerate(columns)]
    for i, c in enumerate(timed):
        cells += [
            entry(c, "minimum", at=F.col(f"min_{i}")),
            entry(c, "maximum", at=F.col(f"max_{i}")),
        ]
    per_column = wide.select(F.inline(F.array(*cells))).where(
        (F.col("measure") == "null_rate") | F.col("instant").isNotNull()
    )
    whole = duplicate_rows(frame).select(
        F.inline(
            F.array(
                entry(None, "rows", F.col("rows").cast("double")),
                entry(None, "columns", F.lit(float(len(columns)))),
                entry(None, "duplicate_rows", F.col("duplicates").cast("double")),
            )
        )
    )
    tidy = per_column.unionByName(whole)
    return tidy.select(F.lit(name).alias("table_name"), *tidy.columns)


def profile_dataset(tables: Mapping[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [profile_table(t, n) for n, t in tables.items()])


def queue_summary(queue_events: DataFrame) -> DataFrame:
    """Per department: snapshots, mean and p95 queue length, mean doctors.

    Equal queue lengths are counted before the shuffle, and the exact percentile then works on
    the few distinct lengths with their counts.
    """
    lengths = queue_events.groupBy("department_id", "queue_length").agg(
        F.count("*").alias("n"),
        F.sum("available_doctors").alias("doctors"),
        F.count("available_doctors").alias("known"),
    )
    measured = F.when(F.col("queue_length").isNotNull(), F.col("n"))
    return lengths.groupBy("department_id").agg(
        F.sum("n").alias("events"),
        (F.sum(F.col("queue_length") * F.col("n")) / F.sum(measured)).alias("average_queue"),
        F.percentile("queue_length", 0.95, F.col("n")).alias("p95_queue"),
        (F.sum("doctors") / F.sum("known")).alias("average_doctors"),
    )


def demand_summary(arrivals: DataFrame) -> DataFrame:
    """Per department: mean, p95 and peak arrivals per interval.

    Like the queue lengths, arrivals per interval are small counts, combined before the shuffle.
    """
    counts = arrivals.groupBy("department_id", "arrivals").agg(F.count("*").alias("n"))
    return counts.groupBy("department_id").agg(
        (F.sum(F.col("arrivals") * F.col("n")) / F.sum("n")).alias("average_hourly_arrivals"),
        F.percentile("arrivals", 0.95, F.col("n")).alias("p95_hourly_arrivals"),
        F.max("arrivals").alias("peak_hourly_arrivals"),
    )


def prediction_counts(records: DataFrame) -> DataFrame:
    return records.groupBy("prediction_type").agg(F.count("*").alias("requests"))


def occupancy_pivot(points: DataFrame, wards: Sequence[str]) -> DataFrame:
    """Interval by ward matrix of the predicted ratio; naming the wards avoids a second scan.

    A ward that is not named stops the query instead of vanishing from it.
    """
    named = F.coalesce(F.col("ward_id").isin(list(wards)), F.lit(True))
    checked = points.where(F.assert_true(named, F.lit("a ward is missing from the list of wards")).isNull())
    return checked.groupBy("interval_start").pivot("ward_id", list(wards)).agg(
        F.first("predicted_occupancy_ratio")
    )


def forecast_level(points: DataFrame, level: str) -> DataFrame:
    """Hospital or department rows of a forecast, in time order."""
    return points.where(F.col("level") == level).orderBy("interval_start", "hospital_id", "department_id")


def alert_rows(points: DataFrame) -> DataFrame:
    return points.where("capacity_alert").orderBy("interval_start", "ward_id")


def ranked_drift(scores: DataFrame) -> DataFrame:
    return scores.orderBy(F.desc("score"), "feature")
