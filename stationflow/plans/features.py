"""Whole feature plans, from slots and stations to a feature matrix.

Each plan exchanges the filled table once, by station and hour; every window
after that stays inside its partition.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame

from stationflow.operators import features as ft
from stationflow.operators import slots as sl
from stationflow.sources.schemas import FLOWS, HOUR_KEYS

SHORT_STATS = ("max", "min", "mean")


def minute_features(
    slots: DataFrame,
    stations: DataFrame,
    days: Sequence[date],
    target: date,
    warm_up: int = 5,
    exclude_target: bool = True,
) -> DataFrame:
    """Lags, changes, row and share statistics, weekday statistics, opening flag."""
    filled = sl.fill_gaps(sl.on_days(slots, days), sl.station_grid(stations, days))
    base = sl.mask_days(sl.with_calendar(filled), [target])
    hidden = [target] if exclude_target else []
    # Windows sort and buffer rows, so they come first, while rows are narrow.
    stats = ft.hour_statistics(ft.slot_statistics(base, exclude_days=hidden), exclude_days=hidden)
    rows = ft.past_stats(ft.change_features(ft.lag_features(stats)))
    return sl.drop_warm_up(ft.opening_flag(rows, stations), days, warm_up)


def hour_features(
    slot_table: DataFrame,
    stations: DataFrame,
    days: Sequence[date],
    target: date,
    history: Sequence[date],
    warm_up: int = 5,
) -> DataFrame:
    """The same at hour grain; weekday statistics come from the unfiltered roll-up.

    ``history`` lists all days of the roll-up, kept or not. The grid covers
    both, a marker tells hours with taps from filled ones, and the statistics
    are windows over the marked hours: the roll-up is neither read twice nor
    joined to itself.
    """
    every = sorted({*history, *days})
    rollup = sl.hour_rollup(sl.on_days(slot_table, every)).selectExpr("*", "1 AS has_taps")
    filled = sl.fill_gaps(rollup, sl.station_grid(stations, every, "hour"), HOUR_KEYS)
    measures = [c for c in rollup.columns if c not in HOUR_KEYS]
    base = sl.mask_days(sl.with_calendar(filled), [target], measures)
    stats = ft.hour_statistics(base, only="has_taps = 1").drop("has_taps")
    lagged = ft.lag_features(sl.on_days(stats, days), ft.HOUR_SERIES)
    rows = ft.past_stats(ft.change_features(lagged))
    return sl.drop_warm_up(ft.opening_flag(rows, stations), days, warm_up)


def day_before_features(
    slots: DataFrame,
    stations: DataFrame,
    days: Sequence[date],
    target: date,
    first: str,
    exclude_target: bool = True,
) -> DataFrame:
    """Previous kept day plus weekday statistics, for workdays or weekends."""
    filled = sl.fill_gaps(sl.on_days(slots, days), sl.station_grid(stations, days))
    base = sl.mask_days(sl.with_calendar(filled), [target])
    hidden = [target] if exclude_target else []
    lagged = ft.previous_kept_day(base, first)
    stats = ft.slot_statistics(lagged, stats=SHORT_STATS, exclude_days=hidden)
    stats = ft.hour_statistics(stats, FLOWS[:1], SHORT_STATS, hidden)
    return ft.hour_statistics(stats, FLOWS[1:], ("mean",), hidden)
