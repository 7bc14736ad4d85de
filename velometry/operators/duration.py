"""How long a taxi trip takes: features, split, regression and its error."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velometry.functions.sampling import drawn
from velometry.functions.timeparts import seconds_between

# The published feature list.  Two of them contain the label:
# travel_time is the duration in seconds and speed_mph is computed from it.
FEATURES_FULL = (
    "passenger_count",
    "trip_distance",
    "rate_code",
    "payment_type",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "total_amount",
    "travel_time",
    "tolls_amount",
    "imp_surcharge",
    "velocity",
    "pickup_hour",
    "pickup_month",
    "speed_mph",
)
_LEAKS = ("travel_time", "velocity", "speed_mph")
FEATURES_NO_LEAK = tuple(f for f in FEATURES_FULL if f not in _LEAKS)


def features(slow: DataFrame, max_miles: float = 20.0) -> DataFrame:
    """Label (minutes) and the full feature list of trips that carry a velocity."""
    minutes = seconds_between("pickup_datetime", "dropoff_datetime") / 60
    return (
        slow.filter(F.col("trip_distance") < max_miles)
        .na.drop("any")
        .withColumns(
            {
                "label": minutes,
                "pickup_hour": F.hour("pickup_datetime"),
                "pickup_month": F.month("pickup_datetime"),
                "speed_mph": F.try_divide("trip_distance", minutes / 60),
            }
        )
        # Nothing else can be null by now: a trip that took no time has no speed.
        .filter(F.col("speed_mph").isNotNull())
        .select("label", *FEATURES_FULL)
    )


def split(
    data: DataFrame, seed: int = 1, train_share: float = 0.75
) -> tuple[DataFrame, DataFrame]:
    """Random train and validation rows; the share is exact.

    A seeded hash of the row draws its side, so rows that are computed again land on the
    same ones, and SQL can draw them, too.  Copies of one row may be on both sides.
    """
    sides = drawn(data, train_share, seed, out="__train")
    return (
        sides.filter("__train").drop("__train"),
        sides.filter("not __train").drop("__train"),
    )


def fit(
    train: DataFrame,
    features: Sequence[str] = FEATURES_FULL,
    # Iterations, penalty and its mix.
    max_iter: int = 10,
    penalty: float = 0.3,
    mix: float = 0.8,
) -> PipelineModel:
    """Assemble, scale to unit deviation, and fit an elastic-net regression."""
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=list(features), outputCol="unscaled_features"),
            StandardScaler(
                inputCol="unscaled_features", outputCol="features", withStd=True, withMean=False
            ),
            LinearRegression(maxIter=max_iter, regParam=penalty, elasticNetParam=mix),
        ]
    ).fit(train)


def elastic_net(
    train: DataFrame,
    features: Sequence[str] = FEATURES_FULL,
    penalty: float = 0.3,
    mix: float = 0.8,
    tolerance: float = 1e-10,
) -> tuple[list[float], float]:
    """Coefficients (of features of unit deviation) and intercept that ``fit`` tends to.

    A check of a fit that is cut off after a few iterations, not a replacement: one
    aggregate yields all sums of products, which are as many as pairs of columns, and
    coordinate descent on those goes on until nothing moves.
    """
    names = [*features, "label"]
    cells = [F.col(c).cast("double") for c in names]
    size = len(names)
    sums = [F.sum(c) for c in cells]
    products = [F.sum(cells[i] * cells[j]) for i in range(size) for j in range(i, size)]
    row = iter(train.agg(F.count(F.lit(1)), *sums, *products).first())
    n = next(row)
    mean = np.array([next(row) / n for _ in names])
    spread = np.empty((size, size))
    for i in range(size):
        for j in range(i, size):
            spread[i, j] = spread[j, i] = next(row) / n - mean[i] * mean[j]
    deviation = np.sqrt(np.maximum(spread.diagonal(), 0.0) * n / (n - 1))
    scale = np.where(deviation > 0, deviation, np.inf)  # a constant explains nothing
    unit = spread / np.outer(scale, scale)
    gram, towards = unit[:-1, :-1], unit[:-1, -1]
    strength = penalty / deviation[-1]
    weights = np.zeros(size - 1)
    while True:
        before = weights.copy()
        for j in range(size - 1):
            if gram[j, j] > 0:
                pull = towards[j] - gram[j] @ weights + gram[j, j] * weights[j]
                shrunk = np.sign(pull) * max(abs(pull) - strength * mix, 0.0)
                weights[j] = shrunk / (gram[j, j] + strength * (1 - mix))
        if np.abs(weights - before).max() <= tolerance:
            break
    weights *= deviation[-1]
    return weights.tolist(), float(mean[-1] - (weights / scale[:-1]) @ mean[:-1])


def predict(model: PipelineModel, data: DataFrame) -> DataFrame:
    """``data`` with the predicted minutes in ``prediction``."""
    return model.transform(data).drop("unscaled_features", "features")


def rmse(predictions: DataFrame) -> float:
    """Root mean square error of the predictions."""
    return RegressionEvaluator(metricName="rmse").evaluate(predictions)


def evaluate(model: PipelineModel, data: DataFrame) -> tuple[DataFrame, float]:
    """Predictions on ``data`` and their root mean square error."""
    predictions = predict(model, data)
    return predictions, rmse(predictions)
