"""Readers for tap files, slot tables, templates, dimensions and forecasts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stationflow.sources import schemas

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"


def _csv(
    spark: SparkSession, path: str | list[str], schema: str, glob: str = "*.csv", nested: bool = True
) -> DataFrame:
    reader = (
        spark.read.schema(schema)
        .option("header", True)
        .option("timestampNTZFormat", TIME_FORMAT)
        .option("pathGlobFilter", glob)
    )
    # Looking for files at any depth switches partition folders off.
    return (reader.option("recursiveFileLookup", True) if nested else reader).csv(path)


def read_taps(spark: SparkSession, path: str | list[str], by_day: bool = False) -> DataFrame:
    """All daily tap files under ``path``: files of other types are left out.

    One scan covers every file, so the union of days needs no loop and the
    files are split over tasks by size rather than by day. With ``by_day``
    the path holds folders named ``record_day=...`` only, as ``write_taps`` makes
    them: they become a column, and a filter on it leaves out other days' files.
    """
    return _csv(spark, path, schemas.TAP, nested=not by_day)


def read_slots(spark: SparkSession, path: str) -> DataFrame:
    """A slot table; date filters prune its partitions. Columns it lacks are null."""
    return spark.read.schema(schemas.SLOT).parquet(path)


def read_in_out(spark: SparkSession, in_path: str, out_path: str) -> tuple[DataFrame, DataFrame]:
    return _csv(spark, in_path, schemas.FLOW_IN), _csv(spark, out_path, schemas.FLOW_OUT)


def read_template(spark: SparkSession, path: str) -> DataFrame:
    """The slots to forecast, without the empty flows the file carries."""
    return _csv(spark, path, schemas.FORECAST).drop(*schemas.FLOWS)


def read_stations(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path, schemas.STATION)


def read_forecast(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path, schemas.FORECAST)


def read_hour_forecast(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path, schemas.HOUR_FORECAST)
