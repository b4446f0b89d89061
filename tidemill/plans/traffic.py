"""Road traffic: features per minute, recent windows, next-minute flow, forecast errors."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions.scalar import moment, span
from tidemill.operators import lagged, tumble

# (batch, steps, features) -> (batch,) of scaled flow
Model = Callable[[np.ndarray], np.ndarray]
FEATURES = ("vehicle_count", "avg_speed_kph")


def road_features(sensors: DataFrame, cameras: DataFrame, size: str = "1 minute") -> DataFrame:
    """Vehicles per road and window, with the average speed where a camera saw any."""
    counts = tumble(sensors, "timestamp_entry", size).groupBy("road_id", "window_start").agg(
        F.count(F.lit(1)).alias("vehicle_count"))
    speeds = tumble(cameras, "timestamp", size).groupBy("road_id", "window_start").agg(
        F.avg("vehicle_speed_kph").alias("avg_speed_kph"))
    return counts.join(speeds, ["road_id", "window_start"], "left")


def recent_features(features: DataFrame, as_of: Column | str | None = None, newest: str = "1 minute",
                    oldest: str = "6 minutes") -> DataFrame:
    """Closed windows between ``oldest`` and ``newest`` ago, both ends included."""
    now = moment(as_of)
    return features.filter((F.col("window_start") <= now - span(newest)) & (F.col("window_start") >= now - span(oldest)))


def flow_history(flow: DataFrame, as_of: Column | str | None = None, within: str = "3 hours") -> DataFrame:
    return flow.filter(F.col("datetime") >= moment(as_of) - span(within)).select(
        "road_id", "datetime", "avg_speed_kph", "traffic_flow", "predicted_flow_next_minute")


# -- scoring ---------------------------------------------------------------------------------

def feature_ranges(features: DataFrame) -> DataFrame:
    """One row with the minimum and maximum of each feature."""
    return features.agg(*[f(c).alias(f"{n}_{c}") for c in FEATURES for n, f in (("lo", F.min), ("hi", F.max))])


def _bounds(column: str, ranges: DataFrame) -> tuple[Column, Column]:
    """Minimum and maximum of a feature, from one scalar that all features share."""
    both = ranges.select(F.struct(*ranges.columns)).scalar()
    return both[f"lo_{column}"], both[f"hi_{column}"]


def _scaled(column: str, ranges: DataFrame) -> Column:
    low, high = _bounds(column, ranges)
    # A constant feature scales to 0, as min-max scalers do; a missing value stays missing.
    scaled = F.coalesce(F.try_divide(F.col(column) - low, (high - low).cast("double")), F.lit(0.0))
    return F.when(F.col(column).isNotNull(), scaled)


def sequences(features: DataFrame, steps: int = 5, ranges: DataFrame | None = None, slot: str = "7 days") -> DataFrame:
    """The ``steps`` scaled feature vectors before each row of a road, plus the row's own scaled flow.

    Rows with a shorter past are left out.  ``ranges`` (one row) is where the
    scale was learnt; by default it is the input itself.  A road's history is
    worked on by ``slot``.
    """
    ranges = feature_ranges(features) if ranges is None else ranges
    vector = F.array(*[_scaled(c, ranges).cast("double") for c in FEATURES])
    past = lagged(features.select("road_id", "window_start", vector.alias("_v")), ["road_id"], "window_start",
                  {f"_v{i}": ("_v", i) for i in range(1, steps + 1)}, slot)
    return (
        past
        .withColumn("x", F.array(*[F.col(f"_v{i}") for i in range(steps, 0, -1)]))
        .filter(F.element_at("x", 1).isNotNull())
        .select("road_id", "window_start", "x", F.col("_v")[0].alias("y"))
    )


def mean_model(batch: np.ndarray) -> np.ndarray:
    """Default model: the mean flow of the steps."""
    return batch[:, :, 0].mean(axis=1)


def next_flow(recent: DataFrame, model: Model = mean_model, steps: int = 5) -> DataFrame:
    """Predicted flow per road from its last ``steps`` windows; NULL where fewer are known.

    A road's sequence is one row with a bounded array, so the model runs on
    Arrow batches of many roads, in place; only the latest ``steps`` rows of a
    road are kept before they are gathered.
    """
    ranges = feature_ranges(recent)
    newest = Window.partitionBy("road_id").orderBy(F.desc("window_start"))
    last = recent.withColumn("_rn", F.row_number().over(newest)).filter(F.col("_rn") <= steps)
    row = F.struct("window_start", *[_scaled(c, ranges).cast("double").alias(c) for c in FEATURES],
                   F.col("vehicle_count").alias("_flow"), F.col("avg_speed_kph").alias("_speed"))
    roads = last.groupBy("road_id").agg(F.sort_array(F.collect_list(row)).alias("_rows")).select(
        "road_id", F.transform("_rows", lambda r: F.array(*[r[c] for c in FEATURES])).alias("x"),
        F.element_at("_rows", -1).alias("_last"))

    def predict(x: pd.Series) -> pd.Series:
        whole = x.map(lambda v: len(v) == steps and all(y is not None and not np.isnan(y) for s in v for y in s))
        out = pd.Series(np.nan, index=x.index)
        if whole.any():
            out[whole] = model(np.array([[list(s) for s in v] for v in x[whole]], dtype="float64"))
        return out

    low, high = _bounds("vehicle_count", ranges)
    guess = F.pandas_udf(predict, "double")("x")
    return roads.select(
        "road_id", F.col("_last.window_start").alias("datetime"), F.col("_last._flow").alias("traffic_flow"),
        F.col("_last._speed").alias("avg_speed_kph"), (guess * (high - low) + low).alias("predicted_flow_next_minute"))


def forecast_errors(pairs: DataFrame, actual: str, predicted: str) -> DataFrame:
    """MSE, RMSE and MAE in one aggregate."""
    gap = F.col(actual) - F.col(predicted)
    return pairs.agg(F.avg(gap * gap).alias("mse"), F.sqrt(F.avg(gap * gap)).alias("rmse"),
                     F.avg(F.abs(gap)).alias("mae"))
