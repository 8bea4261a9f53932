"""Sinks: partitioned slot tables, tap files, and forecasts in fixed column order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.sources import schemas
from stationflow.sources.readers import TIME_FORMAT


def write_slots(slots: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Parquet by date. Overwriting replaces the days written and leaves the others.

    The rebalance hint lets Spark gather a day's rows into few files and split
    a day that is larger than one task should hold.
    """
    writer = slots.hint("rebalance", "date").write.mode(mode).partitionBy("date")
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def _write_csv(df: DataFrame, path: str, mode: str) -> None:
    (
        df.write.mode(mode)
        .option("header", True)
        .option("timestampNTZFormat", TIME_FORMAT)
        .csv(path)
    )


def write_taps(taps: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Tap CSV in one folder per day."""
    columns = ["time", "stationID", "deviceID", "status"]
    daily = taps.select(F.to_date("time").alias(schemas.TAP_DAY), *columns)
    (
        daily.hint("rebalance", schemas.TAP_DAY)
        .write.mode(mode)
        .option("header", True)
        .option("timestampNTZFormat", TIME_FORMAT)
        .partitionBy(schemas.TAP_DAY)
        .csv(path)
    )


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    _write_csv(df, path, mode)


def write_forecast(forecast: DataFrame, path: str, mode: str = "overwrite") -> None:
    _write_csv(forecast.select(*schemas.FORECAST_COLUMNS), path, mode)


def write_hour_forecast(forecast: DataFrame, path: str, mode: str = "overwrite") -> None:
    _write_csv(forecast.select(*schemas.HOUR_FORECAST_COLUMNS), path, mode)
