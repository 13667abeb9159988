"""Equi-joins with declared cardinality, fallbacks, and lookups into the past."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsloom.errors import DataQualityError
from opsloom.functions.clock import micros
from opsloom.functions.running import running_totals, time_bucket


def assert_unique(frame: DataFrame, key: Sequence[str], side: str) -> None:
    """Raise when ``key`` repeats; counted with a map-side combine, one row comes back."""
    repeated = frame.groupBy(*key).agg(F.count("*").alias("copies")).where("copies > 1")
    if not repeated.isEmpty():
        raise DataQualityError(f"{side} side repeats its key {list(key)}")


def with_unique_keys(frame: DataFrame, key: Sequence[str], side: str) -> DataFrame:
    """``frame``, whose reading stops when ``key`` repeats; a null key counts as a key."""
    copy = "_copy"
    while copy in frame.columns:
        copy += "_"
    names = [F.col(f"`{k}`") for k in key]
    refused = F.raise_error(F.lit(f"{side} side repeats its key {list(key)}")).cast("boolean")
    numbered = frame.withColumn(copy, F.row_number().over(Window.partitionBy(*names).orderBy(*names)))
    return numbered.where(F.when(F.col(copy) > 1, refused).otherwise(True)).drop(copy)


def checked_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    *,
    how: str = "inner",
    cardinality: str = "many_to_one",
    verify: bool = True,
    in_plan: bool = False,
) -> DataFrame:
    """Equi-join that refuses an undeclared multiplicity.

    By default the keys are counted first, and ``DataQualityError`` is raised here. With ``in_plan``
    the proof of a one-to-one join rides on the join's own exchange, one per side: copies are numbered
    on its sorted keys, and a second one stops the job that reads the result. Many-to-one joins have no
    such form, since the adaptive split of a hot left key needs the exchange right below the join.
    ``verify=False`` skips the proof where a contract has already proven the keys unique.
    """
    if cardinality not in {"one_to_one", "many_to_one"}:
        raise ValueError(f"unknown cardinality {cardinality!r}")
    if in_plan and cardinality != "one_to_one":
        raise ValueError("only a one-to-one join is proven in its plan")
    if verify and in_plan:
        left, right = with_unique_keys(left, on, "left"), with_unique_keys(right, on, "right")
    elif verify:
        assert_unique(right, on, "right")
        if cardinality == "one_to_one":
            assert_unique(left, on, "left")
    return left.join(right, list(on), how)


def join_with_fallback(
    left: DataFrame, statistics: DataFrame, on: Sequence[str], fallbacks: Mapping[str, Column]
) -> DataFrame:
    """Left join of group statistics; misses take the fallback."""
    joined = left.join(statistics, list(on), "left")
    return joined.withColumns({c: F.coalesce(F.col(c), f) for c, f in fallbacks.items()})


def lookup_shifted(
    rows: DataFrame,
    history: DataFrame,
    groups: Sequence[str],
    time: str,
    value: str,
    *,
    hours: int,
    out: str,
) -> DataFrame:
    """Value of the same group exactly ``hours`` earlier, null where ``history`` has none.

    ``history`` holds one row per group and time; its time is moved forward, so the lookup is a
    plain equi-join.
    """
    moved = history.select(
        *groups,
        F.timestamp_add("HOUR", F.lit(hours), F.col(time)).alias(time),
        F.col(value).cast("double").alias(out),
    )
    return rows.join(moved, [*groups, time], "left")


def point_in_time_history(
    decisions: DataFrame,
    events: DataFrame,
    entity: str,
    decided_at: str,
    available_at: str,
    counts: Mapping[str, Column],
    *,
    bucket_hours: int = 24,
) -> DataFrame:
    """Add, per decision, totals over the entity's events available strictly earlier.

    Both sides are first combined to one row per entity and instant. The running totals then
    work on entity-days, so an entity with a large share of all rows is spread over its days,
    and no decision is ever paired with single events.
    """
    names = list(counts)
    zeros = [F.lit(0).cast("long").alias(n) for n in names]
    happened = events.select(
        F.col(entity),
        micros(available_at).alias("_at"),
        *[counts[n].cast("long").alias(n) for n in names],
        F.lit(False).alias("_asked"),
    )
    asked = decisions.select(
        F.col(entity), micros(decided_at).alias("_at"), *zeros, F.lit(True).alias("_asked")
    )
    instants = (
        happened.unionByName(asked)
        .groupBy(entity, "_at")
        .agg(*[F.sum(n).alias(f"_sum_{n}") for n in names], F.bool_or("_asked").alias("_asked"))
    )
    history = running_totals(
        instants,
        [entity],
        ["_at"],
        {n: F.col(f"_sum_{n}") for n in names},
        time_bucket(F.timestamp_micros("_at"), bucket_hours),
        include_current=False,
    )
    answers = history.where("_asked").select(entity, F.col("_at").alias("_decided"), *names)
    return (
        decisions.withColumn("_decided", micros(decided_at))
        .join(answers, [entity, "_decided"], "left")
        .drop("_decided")
        .select(*decisions.columns, *names)
    )
