"""Recursive hourly forecasts of arrivals and bed occupancy."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Protocol

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsloom.errors import ForecastHorizonError, TrainingDataError
from opsloom.functions.staging import materialize
from opsloom.operators.baselines import HORIZONS
from opsloom.operators.boosting import BoostedModel, HistogramModel, fit_boosting
from opsloom.operators.features import ARRIVAL_NUMERIC, OCCUPANCY_NUMERIC
from opsloom.operators.models import (
    INTERVAL_LEVELS,
    BoostedIntervals,
    FeatureSet,
    IntervalModel,
    TrainingSettings,
    WindowModels,
    boosting_settings,
    encode,
    fit_encoder,
)
from opsloom.operators.policy import capacity_alerts, reconcile_bottom_up, repair_interval
from opsloom.operators.splits import Window24, seen_by
from opsloom.operators.targets import SERIES_KEYS

ARRIVAL_FEATURES = FeatureSet(("department_id",), ARRIVAL_NUMERIC)
OCCUPANCY_FEATURES = FeatureSet(("ward_id",), OCCUPANCY_NUMERIC)
HISTORY_HOURS = 168


class SeriesModel(Protocol):
    """What a forecast needs: ``point`` per step, ``interval`` once at the end."""

    def point(self, frame: DataFrame) -> DataFrame: ...

    def interval(self, frame: DataFrame) -> DataFrame: ...


@dataclass(frozen=True)
class LagModel:
    """A closed-form series model: weighted lags, and bounds at fixed distances.

    It is the naive member of the model family and lets a forecast be checked by hand.
    """

    weights: dict[str, float]
    below: float = 0.0
    above: float = 0.0

    def _value(self) -> Column:
        return sum((F.col(c) * F.lit(float(w)) for c, w in self.weights.items()), F.lit(0.0))

    def point(self, frame: DataFrame) -> DataFrame:
        return frame.withColumn("point", self._value())

    def interval(self, frame: DataFrame) -> DataFrame:
        return frame.withColumns(
            {"lower": self._value() - F.lit(self.below), "upper": self._value() + F.lit(self.above)}
        )


# The parts of a series model: no quantile is the point.
_PARTS = {"point": None, **INTERVAL_LEVELS}


def _fit_series(
    features: DataFrame, feature_set: FeatureSet, label: str, settings: TrainingSettings, names: dict[int, int], mask: str | None
) -> tuple[PipelineModel, dict[int, dict[str, HistogramModel]]]:
    """Encoder, and point and interval models for the windows ``names`` by their bit, all in one fit."""
    encoder = fit_encoder(features, feature_set)
    models = [
        BoostedModel(f"{bit}-{part}", bit, q, None if q is None else settings.interval_leaves)
        for bit in names
        for part, q in _PARTS.items()
    ]
    fitted = fit_boosting(encode(encoder, features), label, models, boosting_settings(settings), mask=mask)
    return encoder, {name: {part: fitted[f"{bit}-{part}"] for part in _PARTS} for bit, name in names.items()}


def fit_series_model(
    features: DataFrame, feature_set: FeatureSet, label: str, settings: TrainingSettings
) -> IntervalModel:
    """One boosted model for all groups; point and both bounds grow together."""
    encoder, fitted = _fit_series(features, feature_set, label, settings, {0: 0}, None)
    parts = fitted[0]
    return IntervalModel(feature_set, encoder, parts["point"], BoostedIntervals(parts["lower"], parts["upper"]))


def fit_series_windows(
    features: DataFrame, feature_set: FeatureSet, label: str, settings: TrainingSettings, windows: Sequence[Window24]
) -> WindowModels:
    """The models of all back-test windows in one fit; a window's models see the rows up to its cut-off."""
    seen = features.withColumn("_seen", seen_by(windows)).where("_seen <> 0")
    names = {i: w.window for i, w in enumerate(windows)}
    encoder, fitted = _fit_series(seen, feature_set, label, settings, names, "_seen")
    return WindowModels(feature_set, encoder, fitted)


def forecast_state(
    target: DataFrame,
    groups: Sequence[str],
    value: str,
    carried: Sequence[str] = (),
    windows: Sequence[Window24] = (),
) -> DataFrame:
    """One row per group: its last hour and its newest 168 values, oldest first.

    Only the last week of a group is gathered, so the array has a fixed length however long the
    history is. ``carried`` columns keep their newest value. With ``windows`` there is a row per
    group and ``window_id``, which ends at the window's cut-off; of the history only those weeks are
    repeated.
    """
    time = F.col("interval_start")
    cuts = [(w.window, time <= F.lit(w.cutoff)) for w in windows] or [(0, F.lit(True))]
    newest = [F.struct(F.lit(name).alias("window_id"), F.max(F.when(seen, time)).alias("last_time")) for name, seen in cuts]
    ends = target.groupBy(*groups).agg(F.array(*newest).alias("_ends"))
    hours = F.expr(f"interval {HISTORY_HOURS} hours")
    covering = F.filter("_ends", lambda e: (time <= e["last_time"]) & (time > e["last_time"] - hours))
    recent = target.join(ends, list(groups)).select(*target.columns, F.inline(covering))
    keys = [*(["window_id"] if windows else []), *groups]
    pairs = F.array_sort(
        F.collect_list(F.struct("interval_start", F.col(value).cast("double").alias("v")))
    )
    return recent.groupBy(*keys, "last_time").agg(
        F.transform(pairs, lambda p: p["v"]).alias("values"),
        *[F.max_by(c, "interval_start").alias(c) for c in carried],
    )


def _step_features(step: int, weekend: bool) -> dict[str, Column]:
    at = F.timestamp_add("HOUR", F.lit(step), F.col("last_time"))
    day = F.slice("values", -24, 24)
    columns = {
        "interval_start": at,
        "hour": F.hour(at),
        "weekday": F.weekday(at),
        "lag_1": F.element_at("values", -1),
        "lag_24": F.element_at("values", -24),
        "lag_168": F.element_at("values", -HISTORY_HOURS),
        "rolling_24": F.aggregate(day, F.lit(0.0), lambda total, v: total + v) / F.lit(24.0),
    }
    if weekend:
        columns["is_weekend"] = (F.weekday(at) >= 5).cast("int")
    return columns


def recursive_forecast(
    target: DataFrame,
    groups: Sequence[str],
    value: str,
    model: SeriesModel,
    horizon: int,
    *,
    weekend: bool,
    carried: Sequence[str] = (),
    constants: dict[str, int] | None = None,
    ceiling: str | None = None,
    write_every: int = 6,
    verify: bool = True,
    windows: Sequence[Window24] = (),
) -> DataFrame:
    """``horizon`` hours per group, and per window if there are any, each step fed by those before it.

    Groups advance in parallel, one row each. Only the point prediction is fed back, so bounds
    are scored once over all steps at the end. The state is written every few steps, which keeps
    the plan short and survives lost executors.
    """
    if horizon not in HORIZONS:
        raise ForecastHorizonError(f"supported horizons: {HORIZONS}")
    constants = constants or {}
    state = forecast_state(target, groups, value, carried, windows)
    groups = [*(["window_id"] if windows else []), *groups]
    state = materialize(state, "forecast-state")
    if verify and not state.where(F.size("values") < HISTORY_HOURS).isEmpty():
        raise TrainingDataError(f"every group needs {HISTORY_HOURS} hours of history")
    base = [*groups, *carried, "last_time", "values"]
    top = F.col(ceiling).cast("double") if ceiling else None
    names: list[str] = []
    for step in range(1, horizon + 1):
        features = _step_features(step, weekend)
        ready = state.withColumns({**features, **{c: F.lit(v) for c, v in constants.items()}})
        scored = model.point(ready)
        kept = F.greatest(F.lit(0.0), F.col("point"))
        scored = scored.withColumn("point", F.least(kept, top) if top is not None else kept)
        made = F.struct(*features, *constants, "point")
        past = F.col("steps") if step > 1 else None
        steps = F.concat(past, F.array(made)) if past is not None else F.array(made)
        state = scored.select(
            *base[:-1],
            F.concat(F.slice("values", 2, HISTORY_HOURS - 1), F.array("point")).alias("values"),
            steps.alias("steps"),
        )
        names = [*features, *constants, "point"]
        # Also after the last step: unnesting would otherwise push its filter through all steps.
        if step % write_every == 0 or step == horizon:
            state = materialize(state, "forecast-state")
    long = state.select(*groups, *carried, F.inline("steps")).select(*groups, *carried, *names)
    bounded = model.interval(long)
    _, low, high = repair_interval(F.col("point"), F.col("lower"), F.col("upper"), top)
    return bounded.select(
        *groups, *carried, "interval_start", "point", low.alias("lower"), high.alias("upper")
    )


def department_forecast(
    target: DataFrame,
    model: SeriesModel,
    horizon: int,
    *,
    groups: Sequence[str] = SERIES_KEYS,
    windows: Sequence[Window24] = (),
) -> DataFrame:
    points = recursive_forecast(target, groups, "arrivals", model, horizon, weekend=True, windows=windows)
    return points.withColumnsRenamed({
        "point": "predicted_arrivals",
        "lower": "lower_arrivals",
        "upper": "upper_arrivals",
    })


def forecast_arrivals(target: DataFrame, model: SeriesModel, horizon: int) -> DataFrame:
    """Department and hospital rows; hospital rows are sums of departments."""
    return reconcile_bottom_up(department_forecast(target, model, horizon))


def ward_forecast(target: DataFrame, model: SeriesModel, horizon: int, *, windows: Sequence[Window24] = ()) -> DataFrame:
    """Beds per ward within ``[0, capacity]``; no discharges are expected in the future."""
    points = recursive_forecast(
        target,
        ["ward_id"],
        "occupied_beds",
        model,
        horizon,
        weekend=False,
        carried=["staffed_capacity"],
        constants={"expected_discharges": 0},
        ceiling="staffed_capacity",
        windows=windows,
    )
    return points.withColumnsRenamed({
        "point": "predicted_occupied_beds",
        "lower": "lower_occupied_beds",
        "upper": "upper_occupied_beds",
    })


def forecast_occupancy(
    target: DataFrame, model: SeriesModel, horizon: int, alert_threshold: float
) -> DataFrame:
    return capacity_alerts(ward_forecast(target, model, horizon), alert_threshold)
