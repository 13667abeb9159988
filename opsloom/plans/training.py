"""Training jobs: choose, refit, gate, and report, all on written feature tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsloom.errors import TrainingDataError
from opsloom.functions.staging import materialize
from opsloom.operators.baselines import (
    HORIZONS,
    backtest_arrival_baselines,
    backtest_baseline_metrics,
    backtest_occupancy_baselines,
    median_of,
    within_horizons,
)
from opsloom.operators.boosting import path_importance
from opsloom.operators.features import (
    NO_SHOW_CATEGORICAL,
    NO_SHOW_NUMERIC,
    WAIT_CATEGORICAL,
    WAIT_NUMERIC,
    arrival_features,
    no_show_features,
    occupancy_features,
    wait_features,
)
from opsloom.operators.forecast import (
    ARRIVAL_FEATURES,
    OCCUPANCY_FEATURES,
    department_forecast,
    fit_series_model,
    fit_series_windows,
    forecast_arrivals,
    forecast_occupancy,
    ward_forecast,
)
from opsloom.operators.metrics import (
    alert_metrics,
    classification_metrics,
    interval_coverage,
    peak_mae,
    regression_metrics,
    slice_metrics,
)
from opsloom.operators.models import (
    FEATURES,
    FeatureSet,
    IntervalModel,
    NoShowModel,
    TrainingSettings,
    apply_sigmoid,
    balance_weights,
    classifiers,
    encode,
    feature_names,
    fit_encoder,
    fit_intervals,
    fit_sigmoid,
    linear_importance,
    log_odds,
    positive_probability,
    regressors,
    score_no_show,
    score_wait_time,
    shuffled_importance,
    top_importance,
)
from opsloom.operators.policy import reminder_policy
from opsloom.operators.quality import assert_no_nulls
from opsloom.operators.splits import (
    Window24,
    capacity_threshold,
    require_both_classes,
    future_rows,
    rolling_origin_windows,
    split_boundaries,
    temporal_split,
)
from opsloom.operators.targets import SERIES_KEYS, check_waiting_times

WAIT_FEATURES = FeatureSet(WAIT_CATEGORICAL, WAIT_NUMERIC)
NO_SHOW_FEATURES = FeatureSet(NO_SHOW_CATEGORICAL, NO_SHOW_NUMERIC)


def union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _checked(features: DataFrame, name: str, verify: bool) -> DataFrame:
    """Write the features and look for nulls in the written table, not by building them twice."""
    rows = materialize(features, name)
    return assert_no_nulls(rows, error=TrainingDataError) if verify else rows


def _encoded(encoder: PipelineModel, part: DataFrame, label: str) -> DataFrame:
    """Label and feature vector, written: a learner reads them many times."""
    return materialize(encode(encoder, part).select(label, FEATURES), "encoded")


def metric_values(metrics: DataFrame, metric: str, keys: Sequence[str]) -> dict:
    """One metric per model on the driver: a handful of candidates."""
    rows = metrics.where(F.col("metric") == metric).collect()
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r.value for r in rows}


@dataclass(frozen=True)
class WaitTraining:
    model: IntervalModel
    selected: str
    boundaries: DataFrame
    report: DataFrame
    slices: DataFrame
    importance: DataFrame
    predictions: DataFrame


def train_wait_time(
    tables: Mapping[str, DataFrame],
    settings: TrainingSettings = TrainingSettings(),
    *,
    require_gain: bool = True,
    verify: bool = True,
    verify_keys: bool = True,
) -> WaitTraining:
    """Pick the candidate with the lowest validation MAE, refit it and hold it to the median.

    ``report`` rows are ``(stage, model, metric, value)``, the gate's outcome among them. With ``require_gain`` a model that does
    not beat the constant median on the test period is an error.
    """
    label = "wait_minutes"
    features = wait_features(tables, verify=False, verify_keys=verify_keys)
    rows = _checked(features, "wait-features", verify)
    if verify:
        check_waiting_times(rows)
    parts = temporal_split(rows, "queue_entered_at")
    encoder = fit_encoder(parts.train, WAIT_FEATURES)
    train, validation = _encoded(encoder, parts.train, label), _encoded(encoder, parts.validation, label)
    candidates = regressors(train, label, settings)
    scored = [
        candidate.fit(train).transform(validation).select(F.lit(name).alias("model"), label, "prediction")
        for name, candidate in candidates.items()
    ]
    validated = materialize(
        regression_metrics(
            materialize(union(scored), "candidates"), label, "prediction", ["model"], few_groups=True
        ),
        "candidate-metrics",
    )
    mae = metric_values(validated, "mae", ["model"])
    selected = min(candidates, key=lambda name: mae[name])

    final_encoder = fit_encoder(parts.development, WAIT_FEATURES)
    development = _encoded(final_encoder, parts.development, label)
    # The ridge penalty depends on the rows it is fitted on.
    point = regressors(development, label, settings)[selected].fit(development)
    model = IntervalModel(
        WAIT_FEATURES, final_encoder, point, fit_intervals(development, label, settings)
    )
    predictions = materialize(score_wait_time(model, parts.test, verify=verify), "wait-predictions")
    constant = predictions.withColumn("median", median_of(parts.development, label).scalar())
    tested = materialize(
        regression_metrics(constant, label, "predicted_wait_minutes")
        .withColumn("model", F.lit(selected))
        .unionByName(
            regression_metrics(constant, label, "median").withColumn("model", F.lit("median_baseline"))
        )
        .unionByName(
            interval_coverage(predictions, label, "lower_wait_minutes", "upper_wait_minutes").withColumn(
                "model", F.lit(selected)
            )
        ),
        "wait-test-metrics",
    )
    test_mae = metric_values(tested, "mae", ["model"])
    gain = test_mae[selected] < test_mae["median_baseline"]
    if require_gain and not gain:
        raise TrainingDataError("the selected model does not beat the median on the test period")
    if selected == "ridge":
        names = feature_names(final_encoder, WAIT_FEATURES)
        importance = linear_importance(encode(final_encoder, parts.test), point.coefficients, names)
    elif selected == "gradient_boosting":
        names = feature_names(final_encoder, WAIT_FEATURES)
        importance = path_importance(point, development, encode(final_encoder, parts.test), names)
    else:
        importance = shuffled_importance(model, parts.test, ["queue_entered_at", "encounter_id"])
    return WaitTraining(
        model=model,
        selected=selected,
        boundaries=split_boundaries(parts.labelled, "queue_entered_at"),
        report=validated.withColumn("stage", F.lit("validation")).unionByName(
            tested.withColumn("stage", F.lit("test"))
        ).unionByName(
            tested.limit(1).select(
                F.lit("gate").alias("stage"),
                F.lit(selected).alias("model"),
                F.lit("beats_median").alias("metric"),
                F.lit(float(gain)).alias("value"),
            )
        ),
        slices=slice_metrics(predictions, label, "predicted_wait_minutes"),
        importance=top_importance(importance),
        predictions=predictions,
    )


@dataclass(frozen=True)
class NoShowTraining:
    model: NoShowModel
    selected: str
    boundaries: DataFrame
    report: DataFrame
    policy: DataFrame
    predictions: DataFrame


def train_no_show(
    tables: Mapping[str, DataFrame],
    settings: TrainingSettings = TrainingSettings(),
    *,
    capacity_fraction: float,
    effectiveness: float,
    grace_minutes: int = 60,
    late_minutes: int = 15,
    maximum_ece: float = 0.25,
    verify: bool = True,
    verify_keys: bool = True,
) -> NoShowTraining:
    """Pick by validation Brier score, calibrate on validation, gate on test calibration.

    The logistic baseline is reported but never selected.
    """
    label, p = "no_show", "no_show_probability"
    features = no_show_features(
        tables,
        grace_minutes=grace_minutes,
        late_minutes=late_minutes,
        verify=False,
        verify_keys=verify_keys,
    )
    rows = _checked(features, "no-show-features", verify)
    parts = temporal_split(rows, "booking_created_at")
    require_both_classes(parts.labelled, label)
    encoder = fit_encoder(parts.train, NO_SHOW_FEATURES)
    train = balance_weights(encode(encoder, parts.train), label)
    validation = encode(encoder, parts.validation)
    fitted = {n: c.fit(train) for n, c in classifiers(label, "class_weight", settings).items()}
    scored = materialize(
        union([
            positive_probability(m, validation).select(F.lit(n).alias("model"), label, "probability_of_one")
            for n, m in fitted.items()
        ]),
        "no-show-candidates",
    )
    validated = materialize(
        classification_metrics(scored, label, "probability_of_one", 0.5, ["model"]),
        "no-show-candidate-metrics",
    )
    brier = metric_values(validated, "brier_score", ["model"])
    selected = min((n for n in fitted if n != "logistic_baseline"), key=lambda n: brier[n])

    chosen = scored.where(F.col("model") == selected).withColumn("_margin", log_odds("probability_of_one"))
    sigmoid = fit_sigmoid(chosen, "_margin", label)
    calibrated = apply_sigmoid(chosen, sigmoid, "_margin", p)
    threshold = capacity_threshold(calibrated, p, capacity_fraction).first().threshold
    model = NoShowModel(NO_SHOW_FEATURES, encoder, fitted[selected], sigmoid, threshold)
    predictions = materialize(score_no_show(model, parts.test, verify=verify), "no-show-predictions")
    tested = materialize(classification_metrics(predictions, label, p, threshold), "no-show-test")
    ece = tested.where("metric = 'expected_calibration_error'").first().value
    if ece > maximum_ece:
        raise TrainingDataError(f"calibration error {ece:.3f} exceeds {maximum_ece:.3f}")
    return NoShowTraining(
        model=model,
        selected=selected,
        boundaries=split_boundaries(parts.labelled, "booking_created_at"),
        report=validated.withColumn("stage", F.lit("validation")).unionByName(
            tested.withColumns({"stage": F.lit("test"), "model": F.lit(selected)})
        ),
        policy=reminder_policy(
            predictions,
            label,
            p,
            "appointment_id",
            capacity_fraction=capacity_fraction,
            effectiveness=effectiveness,
        ),
        predictions=predictions,
    )


@dataclass(frozen=True)
class SeriesTraining:
    model: IntervalModel
    backtest: DataFrame
    forecast: DataFrame


MODEL_NAME = "gradient_boosting"


def _backtest_forecasts(
    target: DataFrame,
    cuts: Sequence[Window24],
    features: DataFrame,
    feature_set: FeatureSet,
    value: str,
    settings: TrainingSettings,
    predict: Callable[..., DataFrame],
    keys: Sequence[str],
) -> DataFrame:
    """Forecasts of all windows joined to what happened.

    The models of all windows grow in one fit and forecast in one recursion, so the jobs do not grow
    with the windows. Features only look back, so those of the whole series serve every window.
    """
    models = fit_series_windows(features, feature_set, value, settings, cuts)
    points = predict(target, models, 24, windows=cuts)
    return materialize(future_rows(target, cuts).join(points, ["window_id", *keys, "interval_start"]), "backtest")


def backtest_arrivals(
    target: DataFrame, settings: TrainingSettings = TrainingSettings(), *, windows: int = 3
) -> DataFrame:
    """Model and naive baselines per horizon: ``(horizon, model, metric, value)``."""
    features = materialize(arrival_features(target), "arrival-features")
    cuts = rolling_origin_windows(target, windows)
    joined = _backtest_forecasts(
        target, cuts, features, ARRIVAL_FEATURES, "arrivals", settings, department_forecast, SERIES_KEYS
    )
    keys = ["window_id", *SERIES_KEYS, "interval_start"]
    naive = backtest_arrival_baselines(target, cuts)
    names = ["same_hour_previous_day", "same_hour_previous_week", "seasonal_mean"]
    scored = joined.join(naive.select(*keys, *names), keys).withColumn(
        MODEL_NAME, F.col("predicted_arrivals")
    )
    scored = materialize(scored, "backtest-scored")
    models = [MODEL_NAME, *names]
    long = _long(scored, models, "arrivals")
    return (
        backtest_baseline_metrics(scored, models, "arrivals")
        .unionByName(peak_mae(long, "arrivals", "prediction", ["horizon", "model"]))
        .unionByName(_coverage(scored, "arrivals", "lower_arrivals", "upper_arrivals"))
    )


def _long(scored: DataFrame, models: Sequence[str], value: str) -> DataFrame:
    items = F.array(*[
        F.struct(F.lit(m).alias("model"), F.col(m).cast("double").alias("prediction")) for m in models
    ])
    return within_horizons(scored.select("interval_start", "cutoff", value, F.inline(items)))


def _coverage(scored: DataFrame, value: str, lower: str, upper: str) -> DataFrame:
    rows = within_horizons(scored)
    covered = interval_coverage(rows, value, lower, upper, ["horizon"])
    return covered.withColumn("model", F.lit(MODEL_NAME)).select("horizon", "model", "metric", "value")


def backtest_occupancy(
    target: DataFrame,
    settings: TrainingSettings = TrainingSettings(),
    *,
    alert_threshold: float,
    windows: int = 3,
) -> DataFrame:
    """As ``backtest_arrivals``, in beds, with the quality of capacity alerts."""
    features = materialize(occupancy_features(target), "occupancy-features")
    cuts = rolling_origin_windows(target, windows)
    joined = _backtest_forecasts(
        target, cuts, features, OCCUPANCY_FEATURES, "occupied_beds", settings, ward_forecast, ["ward_id", "staffed_capacity"]
    )
    keys = ["window_id", "ward_id", "interval_start"]
    naive = backtest_occupancy_baselines(target, cuts)
    names = ["same_hour_previous_day", "same_hour_previous_week"]
    scored = joined.join(naive.select(*keys, *names), keys).withColumn(
        MODEL_NAME, F.col("predicted_occupied_beds")
    )
    scored = materialize(scored, "backtest-scored")
    alerts = alert_metrics(
        within_horizons(scored),
        "occupied_beds",
        MODEL_NAME,
        "staffed_capacity",
        alert_threshold,
        ["horizon"],
    ).withColumn("model", F.lit(MODEL_NAME))
    return (
        backtest_baseline_metrics(scored, [MODEL_NAME, *names], "occupied_beds", beds=True)
        .unionByName(alerts.select("horizon", "model", "metric", "value"))
        .unionByName(_coverage(scored, "occupied_beds", "lower_occupied_beds", "upper_occupied_beds"))
    )


def train_arrivals(
    target: DataFrame,
    settings: TrainingSettings = TrainingSettings(),
    *,
    windows: int = 3,
    horizon: int = max(HORIZONS),
) -> SeriesTraining:
    """Back-test, fit on everything, and forecast from the end of the series."""
    target = materialize(target, "arrivals")
    backtest = backtest_arrivals(target, settings, windows=windows)
    model = fit_series_model(
        materialize(arrival_features(target), "arrival-features"), ARRIVAL_FEATURES, "arrivals", settings
    )
    return SeriesTraining(model, backtest, forecast_arrivals(target, model, horizon))


def train_occupancy(
    target: DataFrame,
    settings: TrainingSettings = TrainingSettings(),
    *,
    alert_threshold: float,
    windows: int = 3,
    horizon: int = max(HORIZONS),
) -> SeriesTraining:
    target = materialize(target, "occupancy")
    backtest = backtest_occupancy(target, settings, alert_threshold=alert_threshold, windows=windows)
    model = fit_series_model(
        materialize(occupancy_features(target), "occupancy-features"),
        OCCUPANCY_FEATURES,
        "occupied_beds",
        settings,
    )
    return SeriesTraining(model, backtest, forecast_occupancy(target, model, horizon, alert_threshold))


def publish_version(spark: SparkSession, model: IntervalModel, root: str, version: str) -> str:
    """Save a model under its version; older versions stay where they are."""
    path = f"{root.rstrip('/')}/{version}"
    model.save(path, spark)
    return path

