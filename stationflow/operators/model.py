"""Time-based splits, boosted forecasts and station vectors."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.operators.boosting import BoostSettings, Model, binned, fitted, predicted
from stationflow.session import stored
from stationflow.sources.schemas import FLOWS


# Stations on either side that are a station's context.
WINDOW = 5


# Depth, leaves, penalties, row and feature share of each kind of model.
MINUTE = BoostSettings(depth=5, leaves=30, row_share=0.7, feature_share=0.7)
PEAK = BoostSettings(depth=8, leaves=100, l1=0.0, l2=0.0, row_share=0.7, feature_share=0.7)
HOUR = BoostSettings(depth=8, leaves=63, row_share=0.8, feature_share=0.8)
DAY_BEFORE = BoostSettings(depth=6, leaves=63, row_share=0.9, feature_share=0.9)


def label_split(df: DataFrame, validation: date, target: date) -> DataFrame:
    """``split``: train before the validation day, valid on it, test at the target day."""
    day = F.col("date")
    return df.withColumn(
        "split",
        F.when(day == F.lit(target), "test")
        .when(day == F.lit(validation), "valid")
        .when(day < F.lit(validation), "train"),
    )


def boosted_forecast(
    features: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str],
    validation: date,
    target: date,
    settings: BoostSettings = BoostSettings(),
) -> tuple[DataFrame, list[Model]]:
    """Predictions of both flows at the target day, negatives clipped to 0."""
    data = binned(label_split(features, validation, target), columns, FLOWS, keys, settings.bins)
    models = fitted(data, settings)
    clipped = [F.greatest(F.col(f"{f}_predicted"), F.lit(0.0)).alias(f) for f in FLOWS]
    return predicted(data, models, "test", keys).select(*keys, *clipped), models


def line_neighbours(stations: DataFrame, window: int = WINDOW) -> DataFrame:
    """stationID, otherID and n: how often two stations lie within ``window`` places on a line.

    Places are joined by equality, one row per distance, so a long line costs its
    length, not its square.
    """
    away = F.explode(F.array(*[F.lit(k) for k in range(-window, window + 1) if k])).alias("away")
    near = stations.select("stationID", "lineID", "linePos", away).withColumn("linePos", F.col("linePos") + F.col("away"))
    other = stations.select("lineID", "linePos", F.col("stationID").alias("otherID"))
    both = near.join(other, ["lineID", "linePos"]).filter("stationID <> otherID")
    return both.groupBy("stationID", "otherID").agg(F.count("*").alias("n"))


def line_weights(pairs: DataFrame) -> DataFrame:
    """stationID, otherID and p: positive pointwise mutual information, as shares of a station's sum."""
    per = stored(pairs, "line-pairs")
    alone = per.groupBy("stationID").agg(F.sum("n").alias("own"))
    other = alone.select(F.col("stationID").alias("otherID"), F.col("own").alias("others"))
    total = per.agg(F.sum("n")).first()[0] or 0
    both = per.join(alone, "stationID").join(other, "otherID")
    pmi = F.greatest(F.log(F.col("n") * F.lit(float(total)) / (F.col("own") * F.col("others"))), F.lit(0.0))
    known = both.select("stationID", "otherID", pmi.alias("m"))
    sums = known.groupBy("stationID").agg(F.sum("m").alias("s")).filter("s > 0")
    return known.join(sums, "stationID").select("stationID", "otherID", (F.col("m") / F.col("s")).alias("p"))


def station_vectors(stations: DataFrame, size: int = 8, steps: int = 3, window: int = WINDOW) -> DataFrame:
    """stationID and v1 .. v<size>: stations that share the surroundings of a line lie close together.

    With a line as a sentence and a station as a word: random numbers, fixed by
    a hash of the station, are carried ``steps`` times along the weights of
    :func:`line_weights`, each step a join and a sum. A vector is the sum of the
    steps' vectors, each of length 1. Stations without neighbours have zeros.
    """
    weights = stored(line_weights(line_neighbours(stations, window)), "line-weights")
    digest = F.md5(F.concat_ws(":", "stationID", "k"))
    start = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(2.0**32) - 0.5
    now = stations.select("stationID").distinct().withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(size)))).withColumn("x", start)
    every, total = now.select("stationID", "k"), None
    for _ in range(steps):
        sent = now.withColumnRenamed("stationID", "otherID")
        now = stored(weights.join(sent, "otherID").groupBy("stationID", "k").agg(F.sum(F.col("p") * F.col("x")).alias("x")), "station-step")
        length = now.groupBy("stationID").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("length"))
        unit = now.join(length, "stationID").select("stationID", "k", F.try_divide("x", "length").alias("x"))
        total = unit if total is None else total.unionByName(unit)
    parts = every.select("*", F.lit(0.0).alias("x")).unionByName(total)
    return parts.groupBy("stationID").agg(*[F.sum(F.when(F.col("k") == k, F.col("x")).otherwise(0.0)).alias(f"v{k}") for k in range(1, size + 1)])
