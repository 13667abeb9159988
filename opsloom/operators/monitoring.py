"""Data quality, drift and metric degradation against a reference, with alerts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsloom.errors import DataQualityError
from opsloom.functions.ranks import exact_percentiles
from opsloom.functions.staging import materialize
from opsloom.operators.profile import duplicate_rows

MISSING = "<missing>"
SHARE_FLOOR = 1e-6

# Metrics that are better when higher; all others are better when lower.
HIGHER_IS_BETTER = ("f1", "interval_coverage", "pr_auc", "precision", "recall", "roc_auc")


@dataclass(frozen=True)
class Thresholds:
    max_missing_rate: float = 0.05
    max_duplicate_rate: float = 0.01
    max_drift_score: float = 0.2
    max_relative_metric_degradation: float = 0.1


def missing_rate(current: DataFrame, required: Sequence[str]) -> DataFrame:
    """One row: null cells of required columns, absent columns counting as null throughout."""
    present = [c for c in required if c in current.columns]
    nulls = sum((F.col(c).isNull().cast("long") for c in present), F.lit(0))
    absent = len(required) - len(present)
    cells = F.count("*") * F.lit(max(len(required), 1))
    return current.agg(
        ((F.sum(nulls) + F.count("*") * F.lit(absent)) / cells).alias("missing_rate")
    )


def duplicate_rate(current: DataFrame) -> DataFrame:
    """One row: share of rows that repeat an earlier one in all columns."""
    return duplicate_rows(current).select(
        (F.col("duplicates") / F.col("rows")).alias("duplicate_rate")
    )


def _long(frame: DataFrame, columns: Sequence[str], as_text: bool) -> DataFrame:
    """Unpivot columns to ``(feature, value)``."""

    def value(c: str) -> Column:
        if as_text:
            return F.coalesce(F.col(c).cast("string"), F.lit(MISSING))
        return F.col(c).cast("double")

    return frame.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), value(c).alias("value")) for c in columns]))
    )


def _edges(reference: DataFrame, columns: Sequence[str], bins: int) -> dict[str, list[float]]:
    """Exact quantiles of each column without repeats, ascending; ``bins + 1`` numbers per column at most."""
    if bins < 2:
        raise ValueError("drift needs two or more bins")
    if not columns:
        return {}
    values = _long(reference, columns, False).where(F.col("value").isNotNull() & ~F.isnan("value"))
    points = {f"q{i}": i * (1.0 / bins) if i < bins else 1.0 for i in range(bins + 1)}
    found = exact_percentiles(values, ["feature"], "value", points, few_groups=True)
    listed = found.select("feature", F.array_sort(F.array_distinct(F.array(*points))).alias("edges")).collect()
    known = {r.feature: r.edges for r in listed}
    return {c: known.get(c, []) for c in columns}


def _wide_counts(frame: DataFrame, edges: Mapping[str, Sequence[float]], required: Sequence[str] = ()) -> DataFrame:
    """One row from one pass: ``rows``, null cells of ``required`` as ``nulls``, and counts per column.

    Column i of ``edges`` gives ``c{i}``: its numbers, those far from the first edge, and how many
    reach each inner edge. The edges are literals, so nothing is joined or unpivoted.
    """

    def counts(column: str, cuts: Sequence[float]) -> Column:
        x = F.col(column).cast("double")
        number = x.isNotNull() & ~F.isnan(x)
        first = cuts[0] if cuts else 0.0
        far = F.abs(x - F.lit(first)) > F.lit(1e-8 + 1e-5 * abs(first))
        reach = [F.count_if(number & (x >= F.lit(cut))) for cut in cuts[1:-1]]
        upto = F.array(*reach) if reach else F.array().cast("array<long>")
        return F.struct(F.count_if(number).alias("n"), F.count_if(number & far).alias("far"), upto.alias("reach"))

    nulls = sum((F.col(c).isNull().cast("long") for c in required), F.lit(0).cast("long"))
    cells = [counts(c, cuts).alias(f"c{i}") for i, (c, cuts) in enumerate(edges.items())]
    return frame.agg(F.count("*").alias("rows"), F.coalesce(F.sum(nulls), F.lit(0).cast("long")).alias("nulls"), *cells)


def _stability(before: DataFrame, after: DataFrame, edges: Mapping[str, Sequence[float]]) -> DataFrame:
    """``(feature, score)`` from the wide counts of both sides."""

    def tidy(side: DataFrame, name: str) -> DataFrame:
        cells = [
            F.struct(F.lit(c).alias("feature"), F.lit(len(cuts)).alias("edges"), F.col(f"c{i}").alias(name))
            for i, (c, cuts) in enumerate(edges.items())
        ]
        return side.select(F.inline(F.array(*cells)))

    def shares(name: str) -> Column:
        # Rows of a bin: those that reach its lower edge less those that reach the next one.
        reach, n = F.col(f"{name}.reach"), F.col(f"{name}.n")
        lower, upper = F.concat(F.array(n), reach), F.concat(reach, F.array(F.lit(0).cast("long")))
        return F.zip_with(lower, upper, lambda a, b: F.greatest((a - b) / n, F.lit(SHARE_FLOOR)))

    both = tidy(before, "old").join(tidy(after, "new").drop("edges"), "feature")
    terms = F.zip_with(shares("old"), shares("new"), lambda o, n: (n - o) * F.ln(n / o))
    score = (
        F.when((F.col("old.n") == 0) | (F.col("new.n") == 0), 1.0)
        .when(F.col("edges") < 2, F.when(F.col("new.far") == 0, 0.0).otherwise(1.0))
        .otherwise(F.aggregate(terms, F.lit(0.0), lambda total, term: total + term))
    )
    return both.select("feature", score.alias("score"))


def numeric_drift(
    reference: DataFrame, current: DataFrame, columns: Sequence[str], bins: int = 10
) -> DataFrame:
    """Population stability index per numeric column: ``(feature, score)``.

    Edges are exact quantiles of the reference without repeats; the outer bins are open. The edges,
    a few numbers per column, come to the driver; each side is then counted in one wide pass.
    """
    edges = _edges(reference, columns, bins)
    return _stability(_wide_counts(reference, edges), _wide_counts(current, edges), edges)


def categorical_drift(
    reference: DataFrame, current: DataFrame, columns: Sequence[str], *, rows: tuple[int, int] | None = None
) -> DataFrame:
    """Total variation distance per column: ``(feature, score)``; nulls are a category.

    Both sides are counted in one grouping, which combines equal values before the shuffle. ``rows``
    are the sizes of both sides where the caller has them already.
    """
    old = _long(reference, columns, True).select("*", F.lit(1).alias("_old"), F.lit(0).alias("_new"))
    new = _long(current, columns, True).select("*", F.lit(0).alias("_old"), F.lit(1).alias("_new"))
    counts = (
        old.unionByName(new)
        .groupBy("feature", "value")
        .agg(F.sum("_old").alias("old"), F.sum("_new").alias("new"))
    )
    if rows is None:
        rows_old, rows_new = (side.select(F.count("*")).scalar() for side in (reference, current))
    else:
        rows_old, rows_new = map(F.lit, rows)
    distance = F.abs(F.col("old") / rows_old - F.col("new") / rows_new)
    return counts.select("feature", distance.alias("_d")).groupBy("feature").agg(
        (F.sum("_d") / 2).alias("score")
    )


def _is_numeric(kind: T.DataType) -> bool:
    return isinstance(kind, (T.NumericType, T.BooleanType))


def _kinds(reference: DataFrame, current: DataFrame) -> tuple[list[str], list[str]]:
    """Shared columns by kind: numbers, booleans among them, and categories, times among them."""
    shared = sorted(set(reference.columns) & set(current.columns))
    numeric = [
        c
        for c in shared
        if _is_numeric(reference.schema[c].dataType) and _is_numeric(current.schema[c].dataType)
    ]
    return numeric, [c for c in shared if c not in numeric]


def feature_drift(reference: DataFrame, current: DataFrame, *, bins: int = 10) -> DataFrame:
    """Drift score per shared column; booleans count as numbers, times as categories."""
    numeric, other = _kinds(reference, current)
    parts = []
    if numeric:
        parts.append(numeric_drift(reference, current, numeric, bins))
    if other:
        parts.append(categorical_drift(reference, current, other))
    if not parts:
        return reference.sparkSession.createDataFrame([], "feature string, score double")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def metric_degradation(reference: DataFrame, current: DataFrame) -> DataFrame:
    """Relative worsening per reference metric; a metric that is gone counts as 1."""
    both = reference.select("metric", F.col("value").alias("_old")).join(
        current.select("metric", F.col("value").alias("_new"), F.lit(True).alias("_found")),
        "metric",
        "left",
    )
    worse = F.when(F.col("metric").isin(*HIGHER_IS_BETTER), F.col("_old") - F.col("_new")).otherwise(
        F.col("_new") - F.col("_old")
    )
    relative = F.greatest(F.lit(0.0), worse / F.greatest(F.abs("_old"), F.lit(1e-9)))
    return both.select(
        "metric", F.when(F.col("_found"), relative).otherwise(F.lit(1.0)).alias("degradation")
    )


# What each alert says.
MISSING_MESSAGE = "Required-field missing rate exceeded its threshold."
DUPLICATE_MESSAGE = "Duplicate-row rate exceeded its threshold."
DRIFT_MESSAGE = "Feature drift requires review."
PERFORMANCE_MESSAGE = "Model metric degradation requires review."


@dataclass(frozen=True)
class MonitoringReport:
    """All checks as ``(component, metric, observed, threshold, message, alert)`` rows, and both sizes."""

    checks: DataFrame
    reference_rows: int
    current_rows: int


def monitoring_report(
    reference: DataFrame,
    current: DataFrame,
    reference_metrics: DataFrame,
    current_metrics: DataFrame,
    required: Sequence[str],
    thresholds: Thresholds = Thresholds(),  # noqa: B008
    *,
    bins: int = 10,
) -> MonitoringReport:
    """Data quality, drift and metric degradation against their thresholds.

    Sizes, missing cells and the bins of all numeric columns come from one pass per side, whose
    single row is written; the categories of both sides are counted in one grouping.
    """
    if absent := sorted(set(required) - set(reference.columns)):
        raise DataQualityError(f"reference data lacks columns: {absent}")
    present = [c for c in required if c in current.columns]
    numeric, other = _kinds(reference.select(*present), current.select(*present))
    edges = _edges(reference, numeric, bins)
    before, after = (
        materialize(_wide_counts(side, edges, [c for c in present if c in side.columns]), "monitoring-counts")
        for side in (reference, current)
    )
    sizes = before.first().rows, after.first().rows
    if 0 in sizes:
        raise DataQualityError("monitoring data must not be empty")

    def checks(frame: DataFrame, component: str, name: Column, value: str, limit: float, message: str) -> DataFrame:
        return frame.select(
            F.lit(component).alias("component"),
            name.alias("metric"),
            F.col(value).cast("double").alias("observed"),
            F.lit(float(limit)).alias("threshold"),
            F.lit(message).alias("message"),
        )

    t = thresholds
    absent_cells = F.lit(len(required) - len(present)) * F.col("rows")
    missing = after.select(((F.col("nulls") + absent_cells) / (F.col("rows") * F.lit(max(len(required), 1)))).alias("rate"))
    found = checks(missing, "data_quality", F.lit("missing_rate"), "rate", t.max_missing_rate, MISSING_MESSAGE)
    repeated = duplicate_rate(current)
    found = found.unionByName(
        checks(repeated, "data_quality", F.lit("duplicate_rate"), "duplicate_rate", t.max_duplicate_rate, DUPLICATE_MESSAGE)
    )
    drift = []
    if numeric:
        drift.append(_stability(before, after, edges))
    if other:
        drift.append(categorical_drift(reference, current, other, rows=sizes))
    for scores in drift:
        found = found.unionByName(checks(scores, "drift", F.col("feature"), "score", t.max_drift_score, DRIFT_MESSAGE))
    worse = metric_degradation(reference_metrics, current_metrics)
    found = found.unionByName(
        checks(worse, "performance", F.col("metric"), "degradation", t.max_relative_metric_degradation, PERFORMANCE_MESSAGE)
    )
    return MonitoringReport(found.withColumn("alert", F.col("observed") > F.col("threshold")), *sizes)


def alerts(checks: DataFrame) -> DataFrame:
    return checks.where("alert").drop("alert")


def monitoring_status(report: MonitoringReport) -> DataFrame:
    """One row: ``healthy`` or ``review_required``, the number of alerts and the sizes of both sides."""
    return report.checks.agg(
        F.when(F.count_if("alert") > 0, "review_required").otherwise("healthy").alias("status"),
        F.count_if("alert").alias("alerts"),
        F.lit(report.reference_rows).cast("long").alias("reference_rows"),
        F.lit(report.current_rows).cast("long").alias("current_rows"),
    )
