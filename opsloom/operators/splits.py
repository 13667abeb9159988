"""Splits by time, cut-off windows and thresholds found by exact ranks."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsloom.errors import DataQualityError, FeatureLeakageError, TrainingDataError
from opsloom.functions.clock import micros
from opsloom.functions.ranks import Rank, values_at_ranks
from opsloom.functions.staging import materialize

SPLITS = ("train", "validation", "test")
MINIMUM_HISTORY_HOURS = 168


@dataclass(frozen=True)
class TemporalSplit:
    """A table labelled by split, and the two cut times as microseconds since the epoch."""

    labelled: DataFrame
    time_column: str
    train_end: int
    validation_end: int

    def _until(self, micros_end: int) -> Column:
        return F.col(self.time_column) <= F.timestamp_micros(F.lit(micros_end))

    @property
    def train(self) -> DataFrame:
        return self._part(self._until(self.train_end))

    @property
    def validation(self) -> DataFrame:
        return self._part(~self._until(self.train_end) & self._until(self.validation_end))

    @property
    def test(self) -> DataFrame:
        return self._part(~self._until(self.validation_end))

    @property
    def development(self) -> DataFrame:
        """Train and validation together."""
        return self._part(self._until(self.validation_end))

    def _part(self, condition: Column) -> DataFrame:
        return self.labelled.where(condition).drop("split")


def split_points(
    frame: DataFrame, time_column: str, train_fraction: float = 0.7, validation_fraction: float = 0.15
) -> DataFrame:
    """One row: number of distinct times and the last time of train and of validation.

    Positions count distinct times and truncate the fraction of their number, with at least one
    time per part. Only the few times near each cut are ranked.
    """
    if train_fraction <= 0 or validation_fraction <= 0 or train_fraction + validation_fraction >= 1:
        raise ValueError("train and validation fractions must each be above 0 and leave a share for the test part")
    both = train_fraction + validation_fraction
    # Fractions stay binary doubles: a decimal literal would round positions differently.
    train = f"(greatest(1, floor(double(n) * {train_fraction!r}D)) - 1)"
    validation = f"least(greatest({train} + 1, floor(double(n) * {both!r}D)), n - 2)"
    times = frame.select(micros(time_column).alias("_t")).distinct()
    return values_at_ranks(
        times,
        [],
        "_t",
        {"train_end": Rank(train), "validation_end": Rank(validation)},
    )


def temporal_split(
    frame: DataFrame, time_column: str, train_fraction: float = 0.7, validation_fraction: float = 0.15
) -> TemporalSplit:
    """Label rows train, validation or test by two cut times.

    The cut times come to the driver as two numbers, so that each part is a plain range filter
    the scan can push down.
    """
    points = split_points(frame, time_column, train_fraction, validation_fraction).first()
    if points is None or points.n < 3:
        raise DataQualityError("at least three distinct times are required for a temporal split")
    if points.validation_end <= points.train_end:
        raise DataQualityError("too few distinct times: the validation part would be empty")
    train_end = F.timestamp_micros(F.lit(points.train_end))
    validation_end = F.timestamp_micros(F.lit(points.validation_end))
    time = F.col(time_column)
    label = F.when(time <= train_end, "train").when(time <= validation_end, "validation")
    labelled = frame.where(time.isNotNull()).withColumn("split", label.otherwise("test"))
    return TemporalSplit(labelled, time_column, points.train_end, points.validation_end)


def split_boundaries(labelled: DataFrame, time_column: str) -> DataFrame:
    """First and last time and row count per split."""
    return labelled.groupBy("split").agg(
        F.min(time_column).alias("first_time"),
        F.max(time_column).alias("last_time"),
        F.count("*").alias("rows"),
    )


def split_order(boundaries: DataFrame) -> DataFrame:
    """One row: whether the parts follow each other without overlap."""
    of = {
        s: (
            F.max(F.when(F.col("split") == s, F.col("first_time"))),
            F.max(F.when(F.col("split") == s, F.col("last_time"))),
        )
        for s in SPLITS
    }
    train, validation, test = (of[s] for s in SPLITS)
    return boundaries.agg(
        F.coalesce((train[1] < validation[0]) & (validation[1] < test[0]), F.lit(False)).alias("ordered"),
        F.coalesce(train[1] < test[0], F.lit(False)).alias("fit_precedes_test"),
    )


# Columns that are only known after the prediction time of a wait.
FUTURE_COLUMNS = ("consultation_started_at", "consultation_ended_at", "checkout_at")


def leakage_checks(
    waiting: TemporalSplit, arrivals: TemporalSplit, *, future: Sequence[str] = FUTURE_COLUMNS
) -> DataFrame:
    """Tidy ``(check_name, passed)`` rows for the two target tables."""
    wait_order = split_order(split_boundaries(waiting.labelled, waiting.time_column))
    series_order = split_order(split_boundaries(arrivals.labelled, arrivals.time_column))
    excluded = not set(future) & set(waiting.labelled.columns)
    waits = wait_order.select(
        F.inline(
            F.array(
                F.struct(F.lit("waiting_split_order").alias("check_name"), F.col("ordered").alias("passed")),
                F.struct(
                    F.lit("waiting_features_exclude_future_events").alias("check_name"),
                    F.lit(excluded).alias("passed"),
                ),
            )
        )
    )
    series = series_order.select(
        F.inline(
            F.array(
                F.struct(F.lit("arrival_split_order").alias("check_name"), F.col("ordered").alias("passed")),
                F.struct(
                    F.lit("forecast_fit_precedes_test").alias("check_name"),
                    F.col("fit_precedes_test").alias("passed"),
                ),
            )
        )
    )
    return waits.unionByName(series)


def assert_leakage_free(checks: DataFrame) -> None:
    failed = [r.check_name for r in checks.where(~F.col("passed")).collect()]  # four rows at most
    if failed:
        raise FeatureLeakageError(f"leakage checks failed: {sorted(failed)}")


# Bytes of a text id that are ranked at once, as one number.
ID_BYTES = 7


def _id_number(column: str, step: int) -> Column:
    """Bytes ``7 step`` to ``7 step + 6`` of a text as a number that orders like them, 0 past its end."""
    part = F.substring(F.col(column).cast("binary"), step * ID_BYTES + 1, ID_BYTES)
    # One digit for the length keeps a text before the texts it begins.
    digits = F.concat(F.rpad(F.hex(part), 2 * ID_BYTES, "0"), F.octet_length(part).cast("string"))
    return F.conv(digits, 16, 10).cast("long")


def _id_at(rows: DataFrame, column: str, index: int, n: int) -> Column:
    """Condition that holds for the ids up to the one at ``index`` among the ``n`` rows, in id order."""
    if isinstance(rows.schema[column].dataType, T.IntegralType):
        return F.col(column) <= F.lit(_at(rows, column, index))
    longest = rows.agg(F.max(F.octet_length(F.col(column).cast("binary")))).first()[0] or 0
    steps = longest // ID_BYTES + 1
    below, equal = F.lit(False), F.lit(True)
    for step in range(steps):
        numbered = rows.where(equal).withColumn("_number", _id_number(column, step))
        cut = F.lit(_at(numbered, "_number", index))
        sizes = numbered.agg(F.count_if(F.col("_number") < cut).alias("less"), F.count_if(F.col("_number") == cut).alias("same")).first()
        below = below | (equal & (_id_number(column, step) < cut))
        equal = equal & (_id_number(column, step) == cut)
        index, n = index - sizes.less, sizes.same
    return below | equal


def first_rows(frame: DataFrame, value: Column, tie: str, share: Callable[[int], int]) -> Column:
    """Condition that holds for exactly the first ``share(n)`` rows in the order ``(value, tie)``.

    The cut is an order statistic: the value at the last wanted rank, then the id at the rank that
    remains among the rows with just that value. The driver receives these numbers only; no table
    is sorted as a whole and no large limit passes through one task. Text ids order by their bytes.
    Ids repeated at the cut cannot be told apart and are an error.
    """
    # Counted and cut several times over: the two columns are written once.
    rows = materialize(frame.select(value.alias("_order"), F.col(tie)).where("_order is not null"), "cut-rows")
    n = rows.count()
    k = min(share(n), n)
    if k <= 0:
        return F.lit(False)
    cut = F.lit(_at(rows, "_order", k - 1))
    sizes = rows.agg(
        F.count_if(F.col("_order") < cut).alias("before"),
        F.count_if(F.col("_order") == cut).alias("ties"),
    ).first()
    wanted = k - sizes.before
    if wanted == sizes.ties:
        return F.coalesce(value <= cut, F.lit(False))
    tied = rows.where((F.col("_order") == cut) & F.col(tie).isNotNull())
    first = _id_at(tied, tie, wanted - 1, sizes.ties)
    if tied.where(first).count() != wanted:
        raise DataQualityError(f"column {tie} does not tell the rows at the cut apart")
    return F.coalesce((value < cut) | ((value == cut) & first), F.lit(False))


def _at(rows: DataFrame, column: str, index: int) -> float | int:
    return values_at_ranks(rows, [], column, {"at": Rank(str(index))}).first().at


def fraction_split(frame: DataFrame, time_column: str, tie: str, fraction: float = 0.7) -> DataFrame:
    """Label the first ``fraction`` of the rows by time ``reference``, the others ``current``."""
    early = first_rows(frame, micros(time_column), tie, lambda n: int(n * fraction))
    return frame.withColumn("part", F.when(early, "reference").otherwise("current"))


def capacity(n: int, fraction: float) -> int:
    return max(1, int(n * fraction))


def capacity_threshold(scores: DataFrame, probability: str, fraction: float) -> DataFrame:
    """One row: the ``max(1, int(n * fraction))``-th largest probability."""

    from_below = f"n - greatest(1, floor(double(n) * {float(fraction)!r}D))"
    found = values_at_ranks(scores, [], probability, {"threshold": Rank(from_below)})
    return found.select("threshold")


@dataclass(frozen=True)
class Window24:
    """One back-test window: history up to ``cutoff``, the future 24 hours after it."""

    window: int
    cutoff: datetime

    def history(self, target: DataFrame, time: str = "interval_start") -> DataFrame:
        return target.where(F.col(time) <= F.lit(self.cutoff))

    def future(self, target: DataFrame, time: str = "interval_start") -> DataFrame:
        end = self.cutoff + timedelta(hours=24)
        return target.where((F.col(time) > F.lit(self.cutoff)) & (F.col(time) <= F.lit(end)))


def rolling_origins(
    target: DataFrame, windows: int = 3, time_column: str = "interval_start"
) -> DataFrame:
    """Cut-off time per window; window ``w`` ends ``24 w`` distinct hours before the last one.

    A dense series has one distinct time per hour, and only the newest ``24 * windows + 1`` of
    them are kept.
    """
    if not 2 <= windows <= 8:
        raise ValueError("windows must be between 2 and 8")
    newest = 24 * windows + 1
    times = target.select(F.col(time_column).alias("cutoff")).distinct()
    latest = times.orderBy(F.desc("cutoff")).limit(newest)
    ranked = latest.agg(F.sort_array(F.collect_list("cutoff"), asc=False).alias("t"))
    return ranked.select(
        F.inline(
            F.array(*[
                F.struct(F.lit(w).alias("window_id"), F.get("t", F.lit(24 * w)).alias("cutoff"))
                for w in range(windows, 0, -1)
            ])
        )
    )


def rolling_origin_windows(
    target: DataFrame, windows: int = 3, time_column: str = "interval_start"
) -> list[Window24]:
    """Back-test windows, oldest first; raises when the series is too short."""
    required = MINIMUM_HISTORY_HOURS + 24 * windows
    hours = target.select(time_column).distinct().count()
    if hours < required:
        raise TrainingDataError(f"a back-test needs at least {required} hourly intervals")
    rows = rolling_origins(target, windows, time_column).orderBy(F.desc("window_id")).collect()
    return [Window24(r.window_id, r.cutoff) for r in rows]


def seen_by(windows: Sequence[Window24], time: str = "interval_start") -> Column:
    """Bits of the windows whose history holds the row: bit i for ``windows[i]``."""
    bits = [F.when(F.col(time) <= F.lit(w.cutoff), F.lit(1 << i)).otherwise(F.lit(0)) for i, w in enumerate(windows)]
    return reduce(Column.__add__, bits).cast("long")


def future_rows(target: DataFrame, windows: Sequence[Window24], time: str = "interval_start") -> DataFrame:
    """The rows of the 24 hours after each cut-off, with ``window_id`` and ``cutoff``, in one scan.

    A row that several windows predict is repeated; history is never copied.
    """
    ends = [(w, w.cutoff + timedelta(hours=24)) for w in windows]
    inside = [
        F.when((F.col(time) > F.lit(w.cutoff)) & (F.col(time) <= F.lit(end)), F.struct(F.lit(w.window).alias("window_id"), F.lit(w.cutoff).alias("cutoff")))
        for w, end in ends
    ]
    near = target.where((F.col(time) > F.lit(min(w.cutoff for w in windows))) & (F.col(time) <= F.lit(max(end for _, end in ends))))
    return near.select(*target.columns, F.inline(F.array_compact(F.array(*inside))))


def class_counts(labelled: DataFrame, label: str) -> DataFrame:
    """Distinct label values per split."""
    return labelled.groupBy("split").agg(F.count_distinct(label).alias("classes"))


def require_both_classes(labelled: DataFrame, label: str) -> None:
    found = {r.split: r.classes for r in class_counts(labelled, label).collect()}  # three rows
    short = [s for s in SPLITS if found.get(s, 0) != 2]
    if short:
        raise TrainingDataError(f"splits without both classes: {short}")
