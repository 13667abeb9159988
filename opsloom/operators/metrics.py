"""Evaluation metrics as tidy ``(keys..., metric, value)`` rows.

Every function takes optional keys (model, horizon, slice), so that all models are scored in one
job. Medians and p90 use the exact rank operator, so a model's errors are never gathered.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsloom.functions.ranks import exact_percentiles
from opsloom.functions.running import running_totals, with_ranges
from opsloom.functions.staging import materialize
from opsloom.operators.features import congestion_bucket


def tidy(frame: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Unpivot metric columns."""
    items = F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics
    ])
    return frame.select(*keys, F.inline(items))


def _errors(frame: DataFrame, keys: Sequence[str], actual: str, predicted: str) -> DataFrame:
    error = F.col(predicted).cast("double") - F.col(actual).cast("double")
    return frame.select(*keys, F.col(actual).cast("double").alias("_actual"), error.alias("_error")).withColumn(
        "_absolute", F.abs("_error")
    )


def regression_metrics(
    frame: DataFrame,
    actual: str,
    predicted: str,
    keys: Sequence[str] = (),
    *,
    few_groups: bool = False,
) -> DataFrame:
    """MAE, median and p90 absolute error, RMSE and the share of under-predictions.

    ``few_groups`` says that the keys are proven to take few values, such as candidate models. The
    errors are written once, so the input is computed once.
    """
    errors = materialize(_errors(frame, keys, actual, predicted), "errors")
    plain = errors.groupBy(*keys).agg(
        F.avg("_absolute").alias("mae"),
        F.sqrt(F.avg(F.col("_error") * F.col("_error"))).alias("rmse"),
        F.avg((F.col("_error") < 0).cast("double")).alias("underprediction_rate"),
    )
    ranked = exact_percentiles(
        errors,
        keys,
        "_absolute",
        {"median_absolute_error": 0.5, "p90_absolute_error": 0.9},
        few_groups=few_groups,
    )
    return tidy(plain, keys, ["mae", "rmse", "underprediction_rate"]).unionByName(
        tidy(ranked, keys, ["median_absolute_error", "p90_absolute_error"])
    )


def forecast_metrics(
    frame: DataFrame, actual: str, predicted: str, keys: Sequence[str] = ()
) -> DataFrame:
    """MAE, RMSE, WAPE with a denominator of at least one, and bias."""
    errors = _errors(frame, keys, actual, predicted)
    total = F.greatest(F.sum(F.abs("_actual")), F.lit(1.0))
    scored = errors.groupBy(*keys).agg(
        F.avg("_absolute").alias("mae"),
        F.sqrt(F.avg(F.col("_error") * F.col("_error"))).alias("rmse"),
        (F.sum("_absolute") / total).alias("wape"),
        F.avg("_error").alias("bias"),
    )
    return tidy(scored, keys, ["mae", "rmse", "wape", "bias"])


def occupancy_metrics(
    frame: DataFrame, actual: str, predicted: str, keys: Sequence[str] = ()
) -> DataFrame:
    """The forecast metrics in beds, without bias."""
    names = F.create_map(*[F.lit(x) for x in ("mae", "mae_beds", "rmse", "rmse_beds", "wape", "wape")])
    scored = forecast_metrics(frame, actual, predicted, keys).where("metric <> 'bias'")
    return scored.withColumn("metric", names[F.col("metric")])


def slice_metrics(
    frame: DataFrame,
    actual: str,
    predicted: str,
    *,
    department: str = "department_id",
    queue_length: str = "queue_length",
) -> DataFrame:
    """Regression metrics per department and per congestion level, in one grouped job."""
    slices = F.array(
        F.struct(F.lit("department_id").alias("dimension"), F.col(department).alias("slice")),
        F.struct(
            F.lit("congestion").alias("dimension"),
            congestion_bucket(F.col(queue_length)).alias("slice"),
        ),
    )
    long = frame.select(F.inline(slices), actual, predicted)
    return regression_metrics(long, actual, predicted, ["dimension", "slice"])


# The inner edges of ten equal probability bins as binary floating point numbers.
CALIBRATION_EDGES = (
    0.1, 0.2, 0.30000000000000004, 0.4, 0.5, 0.6000000000000001, 0.7000000000000001, 0.8, 0.9,
)


def expected_calibration_error(
    frame: DataFrame, actual: str, probability: str, keys: Sequence[str] = ()
) -> DataFrame:
    """Mean gap between observed rate and mean probability over ten equal bins."""
    p = F.col(probability)
    bin_id = sum((p >= F.lit(edge)).cast("int") for edge in CALIBRATION_EDGES)
    inside = frame.where(p.between(0, 1))
    bins = inside.groupBy(*keys, bin_id.alias("_bin")).agg(
        F.count("*").alias("_n"),
        F.avg(F.col(actual).cast("double")).alias("_rate"),
        F.avg(p).alias("_mean"),
    )
    gap = F.sum(F.col("_n") * F.abs(F.col("_rate") - F.col("_mean"))) / F.sum("_n")
    scored = bins.groupBy(*keys).agg(gap.alias("expected_calibration_error"))
    return tidy(scored, keys, ["expected_calibration_error"])


def interval_coverage(
    frame: DataFrame, actual: str, lower: str, upper: str, keys: Sequence[str] = ()
) -> DataFrame:
    """Share of actual values inside their interval, bounds included."""
    covered = F.avg(F.col(actual).between(F.col(lower), F.col(upper)).cast("double"))
    return tidy(frame.groupBy(*keys).agg(covered.alias("interval_coverage")), keys, ["interval_coverage"])


def confusion_counts(
    frame: DataFrame, actual: Column, predicted: Column, keys: Sequence[str] = ()
) -> DataFrame:
    """True and false positives and negatives of two boolean columns."""
    marked = frame.select(*keys, actual.alias("_a"), predicted.alias("_p"))
    return marked.groupBy(*keys).agg(
        F.count_if(F.col("_a") & F.col("_p")).alias("true_positive"),
        F.count_if(~F.col("_a") & F.col("_p")).alias("false_positive"),
        F.count_if(F.col("_a") & ~F.col("_p")).alias("false_negative"),
        F.count_if(~F.col("_a") & ~F.col("_p")).alias("true_negative"),
    )


def safe_ratio(part: Column, total: Column) -> Column:
    """0 when the denominator is 0."""
    return F.when(total > 0, part / total).otherwise(F.lit(0.0))


def ranking_metrics(
    frame: DataFrame, actual: str, probability: str, keys: Sequence[str] = ()
) -> DataFrame:
    """Step-wise average precision and ROC AUC with average ranks for ties.

    Rows combine to one per distinct score first. Counts above a score are running totals over
    ranges of scores between sampled splitters, so neither a popular score nor a crowd of close
    scores ends up in one task.
    """
    positive = F.col(actual).cast("int")
    scores = frame.groupBy(*keys, F.col(probability).cast("double").alias("_p")).agg(
        F.sum(positive).cast("long").alias("_pos"), F.count("*").alias("_all")
    )
    ranked = running_totals(
        with_ranges(scores.withColumn("_down", -F.col("_p")), "_down"),
        keys,
        ["_down"],
        {"_pos_upto": F.col("_pos"), "_all_upto": F.col("_all")},
        F.col("_range"),
    )
    negatives = F.col("_all") - F.col("_pos")
    above = (F.col("_all_upto") - F.col("_all")) - (F.col("_pos_upto") - F.col("_pos"))
    # A positive outranks the negatives below its score and shares those at its score.
    scored = ranked.groupBy(*keys).agg(
        F.sum("_pos").alias("_P"),
        F.sum(negatives).alias("_N"),
        F.sum(F.col("_pos") * F.col("_pos_upto") / F.col("_all_upto")).alias("_ap"),
        F.sum(F.col("_pos") * (above + negatives / 2.0)).alias("_behind"),
    )
    area = 1 - F.col("_behind") / (F.col("_P") * F.col("_N").cast("double"))
    return tidy(
        scored.select(
            *keys,
            F.when(F.col("_P") > 0, F.col("_ap") / F.col("_P")).otherwise(F.lit(0.0)).alias("pr_auc"),
            F.when((F.col("_P") > 0) & (F.col("_N") > 0), area).alias("roc_auc"),
        ),
        keys,
        ["pr_auc", "roc_auc"],
    )


def classification_metrics(
    frame: DataFrame, actual: str, probability: str, threshold: float | Column, keys: Sequence[str] = ()
) -> DataFrame:
    """Ranking, calibration and decision metrics of a binary classifier."""
    cut = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    truth, chosen = F.col(actual) == 1, F.col(probability) >= cut
    squared = (F.col(probability) - F.col(actual)) * (F.col(probability) - F.col(actual))
    marked = frame.select(*keys, truth.alias("_a"), chosen.alias("_p"), squared.alias("_s"))
    counts = marked.groupBy(*keys).agg(
        F.count_if(F.col("_a") & F.col("_p")).alias("_tp"),
        F.count_if("_a").alias("_actual"),
        F.count_if("_p").alias("_chosen"),
        F.avg("_s").alias("brier_score"),
        F.avg(F.col("_p").cast("double")).alias("selection_rate"),
    )
    decided = counts.select(
        *keys,
        "brier_score",
        "selection_rate",
        safe_ratio(F.col("_tp"), F.col("_chosen")).alias("precision"),
        safe_ratio(F.col("_tp"), F.col("_actual")).alias("recall"),
        safe_ratio(2 * F.col("_tp"), F.col("_actual") + F.col("_chosen")).alias("f1"),
    )
    return (
        ranking_metrics(frame, actual, probability, keys)
        .unionByName(expected_calibration_error(frame, actual, probability, keys))
        .unionByName(tidy(decided, keys, ["brier_score", "precision", "recall", "f1", "selection_rate"]))
    )


def peak_mae(frame: DataFrame, actual: str, predicted: str, keys: Sequence[str]) -> DataFrame:
    """MAE over the rows whose actual value reaches its own p90 within ``keys``."""
    rows = materialize(frame.select(*keys, actual, predicted), "peak-rows")
    peaks = exact_percentiles(rows, keys, actual, {"_peak": 0.9}).select(*keys, "_peak")
    top = rows.join(peaks, list(keys), "left").where(F.col(actual) >= F.col("_peak"))
    error = F.avg(F.abs(F.col(predicted) - F.col(actual)))
    return tidy(top.groupBy(*keys).agg(error.alias("peak_mae")), keys, ["peak_mae"])


def alert_metrics(
    frame: DataFrame,
    actual: str,
    predicted: str,
    capacity: str,
    threshold: float,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Recall of capacity alerts and rate of false alerts."""
    limit = F.lit(float(threshold))
    counts = confusion_counts(
        frame,
        F.col(actual) / F.col(capacity) >= limit,
        F.col(predicted) / F.col(capacity) >= limit,
        keys,
    )
    one = F.lit(1)
    rates = counts.select(
        *keys,
        (
            F.col("true_positive")
            / F.greatest(F.col("true_positive") + F.col("false_negative"), one)
        ).alias("alert_recall"),
        (
            F.col("false_positive")
            / F.greatest(F.col("false_positive") + F.col("true_negative"), one)
        ).alias("false_alert_rate"),
    )
    return tidy(rates, keys, ["alert_recall", "false_alert_rate"])


def pivot_models(frame: DataFrame, predictions: Mapping[str, str], actual: str, *keep: str) -> DataFrame:
    """Long rows ``(model, actual, prediction)`` from one prediction column per model."""
    items = F.array(*[
        F.struct(F.lit(m).alias("model"), F.col(c).cast("double").alias("prediction"))
        for m, c in predictions.items()
    ])
    return frame.select(*keep, actual, F.inline(items))
