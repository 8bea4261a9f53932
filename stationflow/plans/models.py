"""From slots to a model forecast: features, boosted trees, clipping, template."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame

from stationflow.operators import features as ft
from stationflow.operators import forecast as fc
from stationflow.operators import model as md
from stationflow.operators import slots as sl
from stationflow.plans import features as plans
from stationflow.sources.schemas import FLOWS

Fitted = tuple[DataFrame, list[md.Model]]
# Labels, keys without meaning to a tree, and columns empty at the target day.
NOT_FEATURES = ("date", "weekend", "day_since_first", *FLOWS, *sl.DEVICE_COUNTS)
SLOT = ["stationID", "hour", "minute"]


def _boost(
    matrix: DataFrame,
    keys: list[str],
    validation: date,
    target: date,
    settings: md.BoostSettings,
) -> Fitted:
    columns = ft.feature_columns(matrix, NOT_FEATURES)
    return md.boosted_forecast(matrix, columns, keys, validation, target, settings)


def hour_model(
    slot_table: DataFrame,
    stations: DataFrame,
    days: Sequence[date],
    validation: date,
    target: date,
    special: Sequence[int],
    history: Sequence[date],
    settings: md.BoostSettings = md.HOUR,
) -> Fitted:
    """Hourly forecast of the ordinary stations."""
    matrix = plans.hour_features(slot_table, stations, days, target, history)
    ordinary, _ = sl.split_stations(matrix, special)
    return _boost(ordinary, ["stationID", "hour"], validation, target, settings)


def minute_model(
    slots: DataFrame,
    stations: DataFrame,
    template: DataFrame,
    days: Sequence[date],
    validation: date,
    target: date,
    closed: Sequence[int],
    settings: md.BoostSettings = md.MINUTE,
) -> Fitted:
    """Ten-minute forecast for the template, closed stations at 0."""
    matrix = plans.minute_features(slots, stations, days, target)
    predicted, results = _boost(matrix, SLOT, validation, target, settings)
    forecast = fc.attach_to_template(template, predicted, fill=False)
    return fc.close_stations(forecast, closed), results


def peak_model(
    slots: DataFrame,
    stations: DataFrame,
    days: Sequence[date],
    validation: date,
    target: date,
    special: Sequence[int],
    hours: Sequence[int],
    settings: md.BoostSettings = md.PEAK,
) -> Fitted:
    """Ten-minute forecast of the peak hours of the ordinary stations."""
    matrix = plans.minute_features(slots, stations, days, target)
    ordinary, _ = sl.split_stations(matrix, special)
    return _boost(sl.peak_hours(ordinary, hours), SLOT, validation, target, settings)


def day_before_model(
    slots: DataFrame,
    stations: DataFrame,
    template: DataFrame,
    days: Sequence[date],
    validation: date,
    target: date,
    first: str,
    closed: Sequence[int] = (),
    settings: md.BoostSettings = md.DAY_BEFORE,
) -> Fitted:
    """Ten-minute forecast from the previous kept day and weekday statistics."""
    matrix = plans.day_before_features(slots, stations, days, target, first)
    predicted, results = _boost(matrix, SLOT, validation, target, settings)
    forecast = fc.attach_to_template(template, predicted, fill=False)
    return fc.close_stations(forecast, closed), results
