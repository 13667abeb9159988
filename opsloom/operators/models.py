"""Learned models as Spark ML jobs: encoding, candidates, intervals, calibration, importance."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    LogisticRegressionModel,
    RandomForestClassifier,
)
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from opsloom.errors import FeatureSchemaMismatchError
from opsloom.functions.shipping import ship
from opsloom.operators.boosting import BoostedModel, BoostingSettings, HistogramModel, fit_boosting, stacked
from opsloom.operators.contracts import require_columns
from opsloom.operators.policy import with_repaired_interval
from opsloom.operators.quality import assert_no_nulls

FEATURES = "features"


@dataclass(frozen=True)
class TrainingSettings:
    """Size and seed of the learned models."""

    seed: int = 17
    trees: int = 100
    boosting_rounds: int = 100
    boosting_leaves: int = 15
    # Depth of the boosted classifier's trees.
    boosting_depth: int = 4
    # The deepest trees the library can grow.
    forest_depth: int = 30
    ridge_alpha: float = 1.0
    interval_leaves: int = 31
    interval_leaf_rows: int = 20


@dataclass(frozen=True)
class FeatureSet:
    categorical: tuple[str, ...]
    numeric: tuple[str, ...]

    @property
    def columns(self) -> tuple[str, ...]:
        return (*self.categorical, *self.numeric)


def fit_encoder(frame: DataFrame, features: FeatureSet) -> PipelineModel:
    """One-hot categories, where an unseen one is all zeros, and standardised numbers."""
    indexed = [f"{c}_index" for c in features.categorical]
    hot = [f"{c}_hot" for c in features.categorical]
    stages = [
        StringIndexer(
            inputCols=list(features.categorical),
            outputCols=indexed,
            handleInvalid="keep",
            stringOrderType="alphabetAsc",
        ),
        OneHotEncoder(inputCols=indexed, outputCols=hot, dropLast=True),
        VectorAssembler(inputCols=list(features.numeric), outputCol="numbers"),
        StandardScaler(inputCol="numbers", outputCol="scaled", withMean=True, withStd=True),
        VectorAssembler(inputCols=[*hot, "scaled"], outputCol=FEATURES),
    ]
    return Pipeline(stages=stages).fit(frame)


def encode(encoder: PipelineModel, frame: DataFrame) -> DataFrame:
    """Add the feature vector without the intermediate columns."""
    return encoder.transform(frame).select(*frame.columns, FEATURES)


def feature_names(encoder: PipelineModel, features: FeatureSet) -> list[str]:
    labels = encoder.stages[0].labelsArray
    hot = [f"{c}_{v}" for c, values in zip(features.categorical, labels) for v in values]
    return [*hot, *features.numeric]


def ridge(encoded: DataFrame, label: str, alpha: float) -> LinearRegression:
    """Linear regression whose penalty equals ``alpha * |w|^2`` on the summed squared error.

    The library divides the penalty by the label's standard deviation and by the row count.
    """
    stats = encoded.agg(F.stddev_pop(label).alias("s"), F.count("*").alias("n")).first()
    return LinearRegression(
        labelCol=label,
        regParam=alpha * (stats.s or 1.0) / stats.n,
        elasticNetParam=0.0,
        standardization=False,
        solver="normal",
    )


def regressors(encoded: DataFrame, label: str, settings: TrainingSettings) -> dict:
    """The wait-time candidates."""
    return {
        "ridge": ridge(encoded, label, settings.ridge_alpha),
        "random_forest": RandomForestRegressor(
            labelCol=label,
            numTrees=settings.trees,
            minInstancesPerNode=3,
            maxDepth=settings.forest_depth,
            featureSubsetStrategy="all",
            seed=settings.seed,
        ),
        "gradient_boosting": HistogramBoosting(label, settings),
    }


def boosting_settings(settings: TrainingSettings) -> BoostingSettings:
    return BoostingSettings(
        rounds=settings.boosting_rounds, leaves=settings.boosting_leaves, leaf_rows=settings.interval_leaf_rows
    )


@dataclass(frozen=True)
class HistogramBoosting:
    """The boosted candidate, used like the library's estimators."""

    label: str
    settings: TrainingSettings

    def fit(self, encoded: DataFrame) -> HistogramModel:
        return fit_boosting(encoded, self.label, [BoostedModel("point")], boosting_settings(self.settings))["point"]


def classifiers(label: str, weight: str, settings: TrainingSettings) -> dict:
    """Logistic baseline and the no-show candidates; ``weight`` balances the classes."""
    return {
        "logistic_baseline": LogisticRegression(
            labelCol=label, weightCol=weight, maxIter=1000, regParam=0.0
        ),
        "random_forest": RandomForestClassifier(
            labelCol=label,
            weightCol=weight,
            numTrees=settings.trees,
            minInstancesPerNode=4,
            maxDepth=settings.forest_depth,
            seed=settings.seed,
        ),
        "gradient_boosting": GBTClassifier(
            labelCol=label,
            maxIter=settings.boosting_rounds,
            maxDepth=settings.boosting_depth,
            seed=settings.seed,
        ),
    }


def balance_weights(frame: DataFrame, label: str, out: str = "class_weight") -> DataFrame:
    """Weight ``n / (2 * n_class)`` per row, from two counts."""
    counts = frame.agg(F.count("*").alias("n"), F.sum(label).alias("ones")).first()
    one, zero = counts.n / (2 * counts.ones), counts.n / (2 * (counts.n - counts.ones))
    return frame.withColumn(out, F.when(F.col(label) == 1, F.lit(one)).otherwise(F.lit(zero)))


def positive_probability(model, encoded: DataFrame, out: str = "probability_of_one") -> DataFrame:
    scored = model.transform(encoded)
    return scored.select(
        *[c for c in encoded.columns if c != FEATURES],
        FEATURES,
        vector_to_array("probability")[1].alias(out),
    )


def fit_sigmoid(scores: DataFrame, score: str, label: str) -> LogisticRegressionModel:
    """Platt scaling: a one-variable logistic fit on soft targets.

    A soft target ``t`` is two weighted rows, one per class, so the plain logistic fit applies.
    """
    counts = scores.agg(F.sum(label).alias("p"), F.count("*").alias("n")).first()
    high = (counts.p + 1.0) / (counts.p + 2.0)
    low = 1.0 / (counts.n - counts.p + 2.0)
    target = F.when(F.col(label) == 1, F.lit(high)).otherwise(F.lit(low))
    # The fit reads rows by their score alone: equal scores and labels combine.
    combined = scores.groupBy(score, target.alias("t")).agg(F.count("*").alias("n"))
    rows = combined.select(
        score,
        F.inline(
            F.array(
                F.struct(F.lit(1.0).alias("label"), (F.col("t") * F.col("n")).alias("weight")),
                F.struct(F.lit(0.0).alias("label"), ((1 - F.col("t")) * F.col("n")).alias("weight")),
            )
        ),
    )
    assembled = VectorAssembler(inputCols=[score], outputCol=FEATURES).transform(rows)
    return LogisticRegression(
        labelCol="label", weightCol="weight", regParam=0.0, maxIter=1000, tol=1e-10
    ).fit(assembled)


def apply_sigmoid(scores: DataFrame, model: LogisticRegressionModel, score: str, out: str) -> DataFrame:
    """Calibrated probability from the two fitted numbers."""
    slope, intercept = float(model.coefficients[0]), float(model.intercept)
    margin = F.lit(slope) * F.col(score) + F.lit(intercept)
    return scores.withColumn(out, 1 / (1 + F.exp(-margin)))


def log_odds(probability: str):
    """Margin of a probability, bounded away from 0 and 1."""
    p = F.least(F.greatest(F.col(probability), F.lit(1e-9)), F.lit(1 - 1e-9))
    return F.ln(p / (1 - p))


# The quantiles of the interval models.
INTERVAL_LEVELS = {"lower": 0.1, "upper": 0.9}


@dataclass(frozen=True)
class BoostedIntervals:
    """Conditional quantiles: a model with pinball loss for each bound."""

    lower: HistogramModel
    upper: HistogramModel

    def add(self, encoded: DataFrame) -> DataFrame:
        return self.upper.transform(self.lower.transform(encoded, out="lower"), out="upper")


def fit_intervals(encoded: DataFrame, label: str, settings: TrainingSettings) -> BoostedIntervals:
    """10 % and 90 % quantiles of the label, both models in one fit."""
    models = [BoostedModel(name, 0, q, settings.interval_leaves) for name, q in INTERVAL_LEVELS.items()]
    return BoostedIntervals(**fit_boosting(encoded, label, models, boosting_settings(settings)))


@dataclass(frozen=True)
class IntervalModel:
    """A point model with its encoder and interval; adds ``point``, ``lower`` and ``upper``."""

    features: FeatureSet
    encoder: PipelineModel
    predictor: object
    intervals: BoostedIntervals

    def point(self, frame: DataFrame) -> DataFrame:
        scored = self.predictor.transform(encode(self.encoder, frame))
        return scored.select(*frame.columns, F.col("prediction").alias("point"))

    def interval(self, frame: DataFrame) -> DataFrame:
        return self.intervals.add(encode(self.encoder, frame)).select(*frame.columns, "lower", "upper")

    def score(self, frame: DataFrame) -> DataFrame:
        encoded = encode(self.encoder, frame)
        scored = self.predictor.transform(encoded).select(
            *encoded.columns, F.col("prediction").alias("point")
        )
        return self.intervals.add(scored).select(*frame.columns, "point", "lower", "upper")

    def save(self, path: str, spark: SparkSession) -> None:
        """Write the model parts as folders; an existing version is never replaced."""
        self.encoder.save(f"{path}/encoder")
        own = isinstance(self.predictor, HistogramModel)
        spark.createDataFrame([(own,)], "own_trees boolean").write.parquet(f"{path}/kind")
        if own:
            self.predictor.nodes(spark).write.parquet(f"{path}/point")
        else:
            PipelineModel([self.predictor]).save(f"{path}/point")
        self.intervals.lower.nodes(spark).write.parquet(f"{path}/lower")
        self.intervals.upper.nodes(spark).write.parquet(f"{path}/upper")

    @classmethod
    def load(cls, spark: SparkSession, path: str, features: FeatureSet) -> IntervalModel:
        def trees(part: str) -> HistogramModel:
            return HistogramModel.from_nodes(spark.read.parquet(f"{path}/{part}"))

        own = spark.read.parquet(f"{path}/kind").first().own_trees
        return cls(
            features,
            PipelineModel.load(f"{path}/encoder"),
            trees("point") if own else PipelineModel.load(f"{path}/point").stages[0],
            BoostedIntervals(trees("lower"), trees("upper")),
        )


@dataclass(frozen=True)
class WindowModels:
    """Point and interval models of several back-test windows; rows name theirs in ``window_id``."""

    features: FeatureSet
    encoder: PipelineModel
    # By window and part: point, lower, upper.
    models: dict[int, dict[str, HistogramModel]]

    def _with(self, frame: DataFrame, parts: Sequence[str]) -> DataFrame:
        ship(frame.sparkSession)
        encoded = encode(self.encoder, frame).withColumn("_vector", vector_to_array(F.col(FEATURES)))
        for part in parts:
            own = {window: by_part[part] for window, by_part in self.models.items()}
            encoded = encoded.withColumn(part, _by_window(own)(F.col("window_id"), F.col("_vector")))
        return encoded.select(*frame.columns, *parts)

    def point(self, frame: DataFrame) -> DataFrame:
        return self._with(frame, ["point"])

    def interval(self, frame: DataFrame) -> DataFrame:
        return self._with(frame, ["lower", "upper"])


def _by_window(models: dict[int, HistogramModel]):
    @F.pandas_udf("double")
    def predict(windows: pd.Series, vectors: pd.Series) -> pd.Series:
        matrix = stacked(vectors)
        result = np.zeros(len(matrix))
        for window in windows.unique():
            here = (windows == window).to_numpy()
            result[here] = models[int(window)].values(matrix[here])
        return pd.Series(result)

    return predict


def check_scoring_input(frame: DataFrame, features: FeatureSet) -> DataFrame:
    """Raise when a model feature is missing or holds a null."""
    require_columns(frame, features.columns, FeatureSchemaMismatchError)
    return assert_no_nulls(frame, features.columns, FeatureSchemaMismatchError)


def score_wait_time(model: IntervalModel, frame: DataFrame, *, verify: bool = True) -> DataFrame:
    """Predicted wait with an ordered, non-negative interval."""
    checked = check_scoring_input(frame, model.features) if verify else frame
    scored = with_repaired_interval(model.score(checked), "point", "lower", "upper")
    return scored.withColumnsRenamed({
        "point": "predicted_wait_minutes",
        "lower": "lower_wait_minutes",
        "upper": "upper_wait_minutes",
    })


@dataclass(frozen=True)
class NoShowModel:
    """Classifier with Platt scaling and the reminder threshold."""

    features: FeatureSet
    encoder: PipelineModel
    classifier: object
    sigmoid: LogisticRegressionModel
    reminder_threshold: float

    def probability(self, frame: DataFrame, out: str = "no_show_probability") -> DataFrame:
        raw = positive_probability(self.classifier, encode(self.encoder, frame))
        margin = raw.withColumn("_margin", log_odds("probability_of_one"))
        return apply_sigmoid(margin, self.sigmoid, "_margin", out).select(*frame.columns, out)

    def save(self, path: str, spark: SparkSession) -> None:
        self.encoder.save(f"{path}/encoder")
        PipelineModel([self.classifier]).save(f"{path}/classifier")
        PipelineModel([self.sigmoid]).save(f"{path}/sigmoid")
        spark.createDataFrame([(self.reminder_threshold,)], "reminder_threshold double").write.parquet(
            f"{path}/threshold"
        )

    @classmethod
    def load(cls, spark: SparkSession, path: str, features: FeatureSet) -> NoShowModel:
        return cls(
            features,
            PipelineModel.load(f"{path}/encoder"),
            PipelineModel.load(f"{path}/classifier").stages[0],
            PipelineModel.load(f"{path}/sigmoid").stages[0],
            spark.read.parquet(f"{path}/threshold").first().reminder_threshold,
        )


def score_no_show(model: NoShowModel, frame: DataFrame, *, verify: bool = True) -> DataFrame:
    """Calibrated probability and whether it reaches the reminder threshold."""
    checked = check_scoring_input(frame, model.features) if verify else frame
    return model.probability(checked).withColumn(
        "reminder_priority", F.col("no_show_probability") >= F.lit(model.reminder_threshold)
    )


def linear_importance(encoded: DataFrame, coefficients: DenseVector, names: Sequence[str]) -> DataFrame:
    """Mean absolute contribution ``coef * (x - mean)`` per feature of a linear model, over all rows.

    Two aggregations of vectors; no row is unpivoted.
    """
    centre = StandardScaler(inputCol=FEATURES, outputCol="_centred", withMean=True, withStd=False).fit(encoded)
    sums = centre.transform(encoded).agg(
        Summarizer.normL1(F.col("_centred")).alias("_l1"), F.count("*").alias("_n")
    )
    weights = F.array(*[F.lit(float(c)) for c in coefficients])
    labels = F.array(*[F.lit(n) for n in names])
    long = sums.select("_n", F.posexplode(vector_to_array("_l1")).alias("_at", "_sum"))
    return long.select(
        F.get(labels, F.col("_at")).alias("feature"),
        (F.abs(F.get(weights, F.col("_at"))) * F.col("_sum") / F.col("_n")).alias("importance"),
    )


# Rows that exchange values with one another in the importance of tree models, about.
EXCHANGE_ROWS = 20_000


def shuffled_importance(model: IntervalModel, frame: DataFrame, order: Sequence[str]) -> DataFrame:
    """Mean absolute change of the prediction when one feature takes another row's value.

    All rows count. They are dealt by a hash of ``order`` to groups of about ``EXCHANGE_ROWS``, and
    a row takes the values of the row after it in the order of another hash, the last those of the
    first: an unrelated row's at every size of the table. All features are scored in one pass.
    """
    names = list(model.features.columns)
    groups = frame.count() // EXCHANGE_ROWS + 1
    rows = frame.select(*order, *names, F.pmod(F.xxhash64(*order), F.lit(groups)).alias("_group"))
    ordered = Window.partitionBy("_group").orderBy(F.xxhash64(F.lit(1), *order), *order)
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    neighbours = rows.withColumns({
        f"_next_{c}": F.coalesce(F.lead(c).over(ordered), F.first(c).over(whole)) for c in names
    })
    variants = [
        F.struct(
            F.lit(changed or "").alias("feature"),
            *[F.col(f"_next_{c}" if c == changed else c).alias(c) for c in names],
        )
        for changed in [None, *names]
    ]
    scored = model.point(
        neighbours.select(*[F.col(c).alias(f"_key_{c}") for c in order], F.inline(F.array(*variants)))
    )
    keys = [f"_key_{c}" for c in order]
    base = scored.where("feature = ''").select(*keys, F.col("point").alias("_base"))
    moved = scored.where("feature <> ''").join(base, keys)
    return moved.groupBy("feature").agg(F.avg(F.abs(F.col("point") - F.col("_base"))).alias("importance"))


def top_importance(importance: DataFrame, k: int = 20) -> DataFrame:
    return importance.orderBy(F.desc("importance"), "feature").limit(k)
