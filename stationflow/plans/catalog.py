"""One entry per operator over the driver's tables, for checks and benchmarks.

Values are rounded here, for comparison only; the library does not round.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.functions import calendar as cal
from stationflow.operators import boosting as bo
from stationflow.operators import features as ft
from stationflow.operators import forecast as fc
from stationflow.operators import model as md
from stationflow.operators import neighbours as nb
from stationflow.operators import slots as sl
from stationflow.plans import features as plans
from stationflow.plans import fixture as fx
from stationflow.plans import models
from stationflow.plans.fixture import PLAN, Fixture
from stationflow.session import scratch_path, tuned
from stationflow.sources import readers, writers
from stationflow.sources.schemas import FLOWS, FORECAST_COLUMNS, HOUR_KEYS, SLOT_KEYS, TAP_DAY

Query = Callable[[SparkSession, str], DataFrame]
CATALOG: dict[str, Query] = {}

WORK, WEEKEND = PLAN.workdays(), PLAN.weekends()
HOUR_COLUMNS = (*HOUR_KEYS, *FLOWS)
SLOT_COLUMNS = (*SLOT_KEYS, *FLOWS)


def rounded(df: DataFrame) -> DataFrame:
    """Doubles at six places, and no negative zero."""
    return df.select(
        *[
            (F.round(F.col(c), 6) + F.lit(0.0)).alias(c) if t == "double" else F.col(c)
            for c, t in df.dtypes
        ]
    )


def entry(name: str):
    def register(build: Callable[[Fixture], DataFrame]):
        CATALOG[name] = lambda spark, sf_dir: rounded(build(Fixture(tuned(spark), sf_dir)))
        return build

    return register


def added(df: DataFrame, keys, *prefixes: str) -> DataFrame:
    """Keys plus the columns whose names start with one of the prefixes."""
    return df.select(*keys, *[c for c in df.columns if c.startswith(prefixes) and c not in keys])


# --- sources and sinks: written to the shared folder and read back ---


@entry("S1_read_tap_files")
def _(f: Fixture) -> DataFrame:
    path = scratch_path(f.spark, "taps")
    writers.write_taps(f.taps(), path)
    return readers.read_taps(f.spark, path, by_day=True).drop(TAP_DAY)


@entry("S2_scan_by_extension")
def _(f: Fixture) -> DataFrame:
    path = scratch_path(f.spark, "mixed")
    writers.write_taps(f.taps(), f"{path}/daily")
    f.taps().write.parquet(f"{path}/other")
    taps = readers.read_taps(f.spark, path)
    return taps.groupBy(F.to_date("time").alias("date")).agg(F.count("*").alias("taps"))


@entry("S3_read_slot_table")
def _(f: Fixture) -> DataFrame:
    path = scratch_path(f.spark, "slots")
    writers.write_slots(f.slots(), path)
    return readers.read_slots(f.spark, path).select(*SLOT_COLUMNS)


@entry("S4_read_in_out_tables")
def _(f: Fixture) -> DataFrame:
    f = f.stored()
    path = scratch_path(f.spark, "in-out")
    ins, outs = _in_and_out(f)
    writers.write_csv(ins, f"{path}/in")
    writers.write_csv(outs, f"{path}/out")
    ins, outs = readers.read_in_out(f.spark, f"{path}/in", f"{path}/out")
    return ins.select("stationID", "time", F.lit("in").alias("flow"), F.col("inNums").alias("n")).unionByName(
        outs.select("stationID", "time", F.lit("out").alias("flow"), F.col("outNums").alias("n"))
    )


@entry("S5_read_template")
def _(f: Fixture) -> DataFrame:
    path = scratch_path(f.spark, "template")
    blank = f.template().withColumns({c: F.lit(0.0) for c in FLOWS})
    writers.write_forecast(blank, path)
    return readers.read_template(f.spark, path)


@entry("S6_read_stations")
def _(f: Fixture) -> DataFrame:
    path = scratch_path(f.spark, "stations")
    writers.write_csv(f.stations(), path)
    return readers.read_stations(f.spark, path)


@entry("S7_read_forecast")
def _(f: Fixture) -> DataFrame:
    path = scratch_path(f.spark, "forecast")
    writers.write_forecast(f.weekday_rule(), path)
    return readers.read_forecast(f.spark, path)


@entry("S8_write_slot_table")
def _(f: Fixture) -> DataFrame:
    path = scratch_path(f.spark, "slot-table")
    writers.write_slots(f.slot_table(), path)
    return readers.read_slots(f.spark, path).select(*SLOT_KEYS, *FLOWS, *sl.DEVICE_COUNTS)


@entry("S9_write_forecast")
def _(f: Fixture) -> DataFrame:
    path = scratch_path(f.spark, "forecast")
    forecast = f.same_as(fx.WEEKDAY_SOURCE, fx.WEEKDAY_TARGET).fillna(0.0)
    writers.write_forecast(forecast.withColumn("extra", F.lit(1)), path)
    return readers.read_forecast(f.spark, path).select(*FORECAST_COLUMNS)


@entry("S10_write_hour_forecast")
def _(f: Fixture) -> DataFrame:
    path = scratch_path(f.spark, "hour-forecast")
    writers.write_hour_forecast(fc.trend_forecast(f.work_hours(), WORK, fx.WEEKDAY_TARGET), path)
    return readers.read_hour_forecast(f.spark, path)


# --- projections, filters, predicates ---


@entry("P1_base_time_fields")
def _(f: Fixture) -> DataFrame:
    return sl.with_calendar(sl.with_slot_keys(f.taps())).select(
        "time", "stationID", "day", "week", "weekend", "hour", "minute"
    )


@entry("P2_timestamp_parts")
def _(f: Fixture) -> DataFrame:
    text = F.date_format("time", "yyyy-MM-dd HH:mm:ss")
    return f.taps().select("stationID", cal.parse_time(text).alias("time")).withColumns(
        cal.time_parts(F.col("time"))
    )


@entry("P3_calendar_fill")
def _(f: Fixture) -> DataFrame:
    return f.filled_hours().select(*HOUR_KEYS, "week", "weekend")


@entry("P4_days_since_first")
def _(f: Fixture) -> DataFrame:
    return sl.with_calendar(f.slots(), PLAN.start).select(*SLOT_KEYS, "day_since_first")


@entry("P5_day_in_list")
def _(f: Fixture) -> DataFrame:
    return f.slots(fx.REST_AND_SOURCE)


@entry("P6_drop_days")
def _(f: Fixture) -> DataFrame:
    return sl.drop_days(f.slots(), PLAN.rest_days())


@entry("P7_day_range")
def _(f: Fixture) -> DataFrame:
    return sl.day_range(f.slots(), fx.REFERENCE[0], fx.REFERENCE[-1])


@entry("P8_single_day")
def _(f: Fixture) -> DataFrame:
    return f.slots([fx.WEEKDAY_SOURCE])


@entry("P9_drop_warm_up")
def _(f: Fixture) -> DataFrame:
    return sl.drop_warm_up(f.workdays(), WORK).select(*SLOT_COLUMNS)


@entry("P10_special_stations")
def _(f: Fixture) -> DataFrame:
    special = F.col("stationID").isin(list(fx.SPECIAL))
    return f.slots().withColumn("part", F.when(special, "special").otherwise("ordinary"))


@entry("P11_peak_hours")
def _(f: Fixture) -> DataFrame:
    return sl.peak_hours(f.slots(), fx.PEAK)


@entry("P12_day_reindex")
def _(f: Fixture) -> DataFrame:
    kept = f.slots(WORK)
    indexed = kept.withColumn("day_index", cal.day_index(F.col("date"), WORK))
    return indexed.withColumn("day_back", cal.day_at(F.col("day_index"), WORK)).select(
        *SLOT_KEYS, "day_index", "day_back"
    )


@entry("P13_clock_label")
def _(f: Fixture) -> DataFrame:
    label = cal.clock_label(F.col("hour"), F.col("minute"))
    return f.slots().select(*SLOT_KEYS, label.alias("label"))


@entry("P14_opening_flag")
def _(f: Fixture) -> DataFrame:
    return ft.opening_flag(f.filled(), f.stations()).select(*SLOT_KEYS, "is_run")


@entry("P15_rename_drop_select")
def _(f: Fixture) -> DataFrame:
    renamed = f.slots().withColumnsRenamed({c: f"{c}_last" for c in FLOWS})
    return renamed.drop("minute").select("stationID", "date", "hour", "inNums_last", "outNums_last")


@entry("P16_feature_columns")
def _(f: Fixture) -> DataFrame:
    table = f.slot_table()
    return table.select(
        ft.feature_columns(table, ["weekend", *FLOWS, *sl.DEVICE_COUNTS[:2]])
    )


@entry("P17_fill_nulls")
def _(f: Fixture) -> DataFrame:
    day = f.same_as(fx.WEEKDAY_SOURCE, fx.WEEKDAY_TARGET)
    return day.fillna({"inNums": 0.0, "outNums": 1.0})


@entry("P18_replace_infinite_ratio")
def _(f: Fixture) -> DataFrame:
    ratio = F.coalesce(F.try_divide("inNums", "outNums"), F.lit(1.0))
    return f.slots().select(*SLOT_KEYS, ratio.alias("in_out_ratio"))


# --- joins ---


def _in_and_out(f: Fixture) -> tuple[DataFrame, DataFrame]:
    start = cal.slot_start(F.col("date"), F.col("hour"), F.col("minute")).alias("time")
    slots = f.slots()
    return (
        slots.filter("inNums > 0").select("stationID", start, "inNums"),
        slots.filter("outNums > 0").select("stationID", start, "outNums"),
    )


@entry("J1_slot_grid")
def _(f: Fixture) -> DataFrame:
    return f.filled().select(*SLOT_COLUMNS, "day", "week", "weekend")


@entry("J2_hour_grid")
def _(f: Fixture) -> DataFrame:
    facts = sl.hour_rollup(f.slot_table())
    grid = sl.station_grid(f.stations(), PLAN.days(), "hour")
    return sl.fill_gaps(facts, grid, HOUR_KEYS)


@entry("J3_grid")
def _(f: Fixture) -> DataFrame:
    return sl.station_grid(f.stations(), PLAN.days())


@entry("J4_combine_in_out")
def _(f: Fixture) -> DataFrame:
    f = f.stored()
    return sl.combine_in_out(*_in_and_out(f))


@entry("J5_station_join")
def _(f: Fixture) -> DataFrame:
    return ft.join_stations(f.slots(), f.stations())


@entry("J6_attach_aggregate")
def _(f: Fixture) -> DataFrame:
    attached = ft.slot_statistics(sl.with_calendar(f.slots()), stats=("mean",))
    return added(attached, SLOT_KEYS, "inNums_whm", "outNums_whm")


@entry("J7_shifted_day")
def _(f: Fixture) -> DataFrame:
    shifted = ft.shifted_day(f.filled(), PLAN.days())
    return added(shifted, SLOT_KEYS, "inNums_last", "outNums_last")


@entry("J7_shifted_kept_day")
def _(f: Fixture) -> DataFrame:
    """Slots with taps only: most have no row on the workday before."""
    shifted = ft.shifted_day(sl.on_days(f.slots(WORK), WORK), WORK)
    return added(shifted, SLOT_KEYS, "inNums_last", "outNums_last")


@entry("J8_days_side_by_side")
def _(f: Fixture) -> DataFrame:
    days = {"12": PLAN.on(13)[0], "13": PLAN.on(14)[0], "19": PLAN.on(20)[0], "20": PLAN.on(21)[0]}
    return fc.days_side_by_side(f.slots(list(days.values())), days)


@entry("J9_template_join")
def _(f: Fixture) -> DataFrame:
    shares = fc.slot_shares(f.slots(fx.REFERENCE), fx.REFERENCE)
    joined = fc.with_template_slot(f.template()).join(shares, list(fc.SLOT), "left")
    return joined.select(*fc.TEMPLATE_KEYS, "inNums_share", "outNums_share").fillna(0.0)


@entry("J10_forecast_join")
def _(f: Fixture) -> DataFrame:
    f = f.stored(fx.RULE_DAYS)
    return fc.join_forecasts([f.weekday_rule(), f.same_as(fx.WEEKDAY_SOURCE, fx.WEEKDAY_TARGET)])


@entry("J11_attach_by_key")
def _(f: Fixture) -> DataFrame:
    values = sl.on_days(f.workdays(), [fx.WEEKDAY_SOURCE]).select(
        *fc.SLOT, *[F.col(c).cast("double").alias(c) for c in FLOWS]
    )
    return fc.attach_to_template(f.template(), values)


# --- aggregations ---


@entry("A1_slot_flow")
def _(f: Fixture) -> DataFrame:
    return sl.with_calendar(f.slots()).select(
        "stationID", "date", "week", "weekend", "day", "hour", "minute", *FLOWS
    )


@entry("A2_distinct_devices")
def _(f: Fixture) -> DataFrame:
    return f.slot_table().select(*SLOT_KEYS, *sl.DEVICE_COUNTS)


@entry("A3_hour_rollup")
def _(f: Fixture) -> DataFrame:
    return sl.hour_rollup(f.slot_table())


@entry("A4_slot_statistics")
def _(f: Fixture) -> DataFrame:
    stats = ft.slot_statistics(f.workdays(), exclude_days=[fx.WEEKDAY_TARGET])
    return added(stats, SLOT_KEYS, "inNums_whm", "outNums_whm")


@entry("A5_hour_statistics")
def _(f: Fixture) -> DataFrame:
    stats = ft.hour_statistics(f.workdays(), exclude_days=[fx.WEEKDAY_TARGET])
    return added(stats, SLOT_KEYS, "inNums_wh_", "outNums_wh_")


@entry("A5_hour_statistics_of_rollup")
def _(f: Fixture) -> DataFrame:
    f = f.stored()
    rollup = sl.with_calendar(sl.hour_rollup(sl.drop_days(f.slots(), [fx.WEEKDAY_TARGET])))
    stats = ft.attach_hour_statistics(f.work_hours(), rollup)
    return added(stats, HOUR_KEYS, "inNums_wh_", "outNums_wh_")


@entry("A6_slot_mean")
def _(f: Fixture) -> DataFrame:
    return fc.slot_means(f.slots(fx.REFERENCE), fx.REFERENCE)


@entry("A7_hour_mean")
def _(f: Fixture) -> DataFrame:
    return fc.hour_means(f.slots(fx.REFERENCE), fx.REFERENCE)


@entry("A8_slot_share")
def _(f: Fixture) -> DataFrame:
    return fc.slot_shares(f.slots(fx.REFERENCE), fx.REFERENCE)


@entry("A9_source_hour_mean")
def _(f: Fixture) -> DataFrame:
    return fc.source_hour_means(f.slots([fx.WEEKDAY_SOURCE]), fx.WEEKDAY_SOURCE)


@entry("A10_weekend_ratio")
def _(f: Fixture) -> DataFrame:
    return fc.weekend_ratios(f.filled([d for pair in fx.PAIRS for d in pair]), fx.PAIRS)


@entry("A11_distinct_values")
def _(f: Fixture) -> DataFrame:
    label = cal.clock_label(F.col("hour"), F.col("minute"))
    return sl.distinct_sorted(f.slots().withColumn("label", label), "label")


@entry("A12_slot_series")
def _(f: Fixture) -> DataFrame:
    return _joined_series(sl.slot_series(f.filled(fx.REST_AND_SOURCE), fx.REST_AND_SOURCE, ft.SLOT_SERIES, PLAN.start))


@entry("A12_hour_series")
def _(f: Fixture) -> DataFrame:
    return _joined_series(sl.slot_series(f.slots(WEEKEND), WEEKEND, ft.HOUR_SERIES, PLAN.start))


def _joined_series(df: DataFrame) -> DataFrame:
    text = lambda c: F.array_join(F.col(c).cast("array<string>"), ",").alias(c)
    return df.withColumns({c: text(c) for c in ("days", "in_series", "out_series")})


@entry("A13_plain_aggregates")
def _(f: Fixture) -> DataFrame:
    return f.slots().groupBy("stationID").agg(
        F.sum("inNums").alias("sum_in"),
        F.avg("inNums").alias("mean_in"),
        F.max("inNums").alias("max_in"),
        F.min("inNums").alias("min_in"),
        F.stddev_samp("inNums").alias("std_in"),
        F.count("inNums").alias("count_in"),
        F.count_distinct("inNums").alias("nunique_in"),
    )


# --- lags and row statistics ---


@entry("W1_lags")
def _(f: Fixture) -> DataFrame:
    return added(ft.lag_features(f.workdays()), SLOT_COLUMNS, "inNums_last", "outNums_last")


@entry("W1_hour_lags")
def _(f: Fixture) -> DataFrame:
    lagged = ft.lag_features(f.work_hours(), ft.HOUR_SERIES)
    return added(lagged, HOUR_COLUMNS, "inNums_last", "outNums_last")


@entry("W2_previous_kept_day_self")
def _(f: Fixture) -> DataFrame:
    return ft.previous_kept_day(f.weekends(), "self").select(*SLOT_KEYS, "inNums_last", "outNums_last")


@entry("W3_previous_kept_day_zero")
def _(f: Fixture) -> DataFrame:
    return ft.previous_kept_day(f.workdays(), "zero").select(*SLOT_KEYS, "inNums_last", "outNums_last")


@entry("W4_changes")
def _(f: Fixture) -> DataFrame:
    changed = ft.change_features(ft.lag_features(f.workdays(), lags=(1, 2, 3)))
    names = [c for c in changed.columns if "mean_3" in c or "diff" in c or "divide" in c]
    return changed.select(*SLOT_KEYS, *names)


@entry("W5_past_values")
def _(f: Fixture) -> DataFrame:
    return added(ft.past_value_stats(ft.lag_features(f.workdays())), SLOT_KEYS, "district_")


@entry("W6_past_shares")
def _(f: Fixture) -> DataFrame:
    return added(ft.past_share_stats(ft.lag_features(f.workdays())), SLOT_KEYS, "district_percent_")


@entry("W7_past_n")
def _(f: Fixture) -> DataFrame:
    return added(ft.past_n_features(f.filled_hours(), ft.HOUR_SERIES), HOUR_KEYS, "district_")


@entry("W8_same_weekday")
def _(f: Fixture) -> DataFrame:
    stats = ft.same_weekday_features(f.filled())
    return stats.select(*SLOT_KEYS, *[c for c in stats.columns if "_last_week" in c or "Nums_w" in c])


@entry("W9_group_shift")
def _(f: Fixture) -> DataFrame:
    order = ("date", "hour", "minute")
    return ft.group_shift(f.slots(), "inNums", 2, ["stationID"], order).select(
        *SLOT_KEYS, "inNums_shift_2"
    )


# --- sorts and set operations ---


@entry("O1_sorted_series")
def _(f: Fixture) -> DataFrame:
    return f.slots(fx.REST_AND_SOURCE).orderBy("stationID", "hour", "minute", "date")


@entry("O2_union_days")
def _(f: Fixture) -> DataFrame:
    path = scratch_path(f.spark, "daily-taps")
    writers.write_taps(f.taps(), path)
    return sl.slot_flows(readers.read_taps(f.spark, path, by_day=True))


@entry("O3_append_template")
def _(f: Fixture) -> DataFrame:
    past = sl.drop_days(f.slot_table(), [fx.WEEKDAY_TARGET])
    return sl.append_template(past, f.template(), PLAN.start)


@entry("O4_rejoin_stations")
def _(f: Fixture) -> DataFrame:
    f = f.stored()
    last = sl.on_days(f.work_hours(), [fx.WEEKDAY_TARGET]).select("stationID", "hour", *FLOWS)
    trend = fc.trend_forecast(f.work_hours(), WORK, fx.WEEKDAY_TARGET)
    ordinary, _ = sl.split_stations(trend, fx.SPECIAL)
    _, special = sl.split_stations(last, fx.SPECIAL)
    as_double = [F.col(c).cast("double").alias(c) for c in FLOWS]
    return sl.rejoin_stations(ordinary, special.select("stationID", "hour", *as_double))


# --- forecasts ---


def _naive(f: Fixture) -> DataFrame:
    return f.same_as(fx.WEEKDAY_SOURCE, fx.WEEKDAY_TARGET).fillna(0.0)


@entry("F1_weekday_rule")
def _(f: Fixture) -> DataFrame:
    return f.weekday_rule()


@entry("F2_weekend_rule")
def _(f: Fixture) -> DataFrame:
    return f.weekend_rule()


@entry("F3_blend")
def _(f: Fixture) -> DataFrame:
    f = f.stored(fx.RULE_DAYS)
    return fc.blend([_naive(f), f.weekday_rule()], [0.6, 0.4])


@entry("F3_blend_unmatched")
def _(f: Fixture) -> DataFrame:
    f = f.stored(fx.RULE_DAYS)
    ordinary, _ = sl.split_stations(f.weekday_rule(), fx.SPECIAL)
    return fc.blend([_naive(f), ordinary], [0.5, 0.5])


@entry("F4_three_way_blend")
def _(f: Fixture) -> DataFrame:
    f = f.stored(fx.RULE_DAYS)
    last_week = f.same_as(PLAN.on(23)[0], fx.WEEKDAY_TARGET).fillna(0.0)
    return fc.blend([f.weekday_rule(), _naive(f), last_week], [0.25, 0.25, 0.5])


@entry("F5_night_override")
def _(f: Fixture) -> DataFrame:
    f = f.stored(fx.WEEKEND_RULE_DAYS)
    return fc.night_override(f.weekend_rule(), f.slots(), fx.SUNDAYS[-1])


@entry("F6_rescale")
def _(f: Fixture) -> DataFrame:
    return fc.rescale(f.weekday_rule(), 0.965 / 1.02, [(7, range(6, 24), "outNums", 1.05)])


@entry("F7_closed_stations")
def _(f: Fixture) -> DataFrame:
    return fc.close_stations(f.weekday_rule(), fx.CLOSED)


@entry("F8_clip_negative")
def _(f: Fixture) -> DataFrame:
    f = f.stored([PLAN.on(23)[0], fx.WEEKDAY_SOURCE])
    # Twice today minus last week: a forecast that does go below zero.
    last_week = f.same_as(PLAN.on(23)[0], fx.WEEKDAY_TARGET).fillna(0.0)
    return fc.clip_negative(fc.blend([_naive(f), last_week], [2.0, -1.0]))


@entry("F9_hours_to_slots")
def _(f: Fixture) -> DataFrame:
    f = f.stored()
    hourly = fc.trend_forecast(f.work_hours(), WORK, fx.WEEKDAY_TARGET)
    return fc.hours_to_slots(f.template(), hourly, fc.slot_shares(f.slots(fx.REFERENCE), fx.REFERENCE))


@entry("F10_time_split")
def _(f: Fixture) -> DataFrame:
    split = md.label_split(f.workdays(), fx.WEEKDAY_SOURCE, fx.WEEKDAY_TARGET)
    return split.select(*SLOT_COLUMNS, "split")


@entry("F11_boosted_stumps")
def _(f: Fixture) -> DataFrame:
    """Three rounds of one split each, small enough for a twin."""
    features = ("stationID", "hour", "minute", "week", "inNums_last_1", "outNums_last_1")
    rows = md.label_split(ft.lag_features(f.workdays()), fx.WEEKDAY_TARGET, fx.WEEKDAY_TARGET)
    data = bo.binned(rows, features, FLOWS, SLOT_KEYS, bins=8, edges=dict(zip(features, fx.STUMP_EDGES, strict=True)))
    forecast = bo.predicted(data, bo.boosted(data, ["train"], fx.STUMPS), "test", SLOT_KEYS)
    return forecast.select(*SLOT_KEYS, *[F.col(f"{x}_predicted").alias(x) for x in FLOWS])


@entry("F11_boosted_hours")
def _(f: Fixture) -> DataFrame:
    return models.hour_model(
        f.slot_table(), f.stations(), WORK,
        fx.WEEKDAY_SOURCE, fx.WEEKDAY_TARGET, fx.SPECIAL, PLAN.days(),
    )[0]


@entry("F11_boosted_minutes")
def _(f: Fixture) -> DataFrame:
    return models.minute_model(
        f.slots(), f.stations(), f.template(), WORK,
        fx.WEEKDAY_SOURCE, fx.WEEKDAY_TARGET, fx.CLOSED,
    )[0]


@entry("F11_boosted_peak")
def _(f: Fixture) -> DataFrame:
    return models.peak_model(
        f.slots(), f.stations(), WORK,
        fx.WEEKDAY_SOURCE, fx.WEEKDAY_TARGET, fx.SPECIAL, fx.PEAK,
    )[0]


@entry("F11_boosted_workday")
def _(f: Fixture) -> DataFrame:
    return models.day_before_model(
        f.slots(), f.stations(), f.template(), WORK,
        fx.WEEKDAY_SOURCE, fx.WEEKDAY_TARGET, "zero", fx.CLOSED,
    )[0]


@entry("F11_boosted_weekend")
def _(f: Fixture) -> DataFrame:
    return models.day_before_model(
        f.slots(), f.stations(), f.template(fx.WEEKEND_TARGET), WEEKEND,
        fx.WEEKEND_SOURCE, fx.WEEKEND_TARGET, "self", fx.CLOSED,
    )[0]


@entry("F12_trend")
def _(f: Fixture) -> DataFrame:
    return fc.trend_forecast(f.work_hours(), WORK, fx.WEEKDAY_TARGET)


@entry("F12_piecewise_trend")
def _(f: Fixture) -> DataFrame:
    return fc.piecewise_trend(f.work_hours(), WORK, fx.WEEKDAY_TARGET, fx.TREND_CHANGES)


@entry("F13_mean_absolute_error")
def _(f: Fixture) -> DataFrame:
    f = f.stored([*fx.RULE_DAYS, fx.WEEKDAY_TARGET])
    actual = f.same_as(fx.WEEKDAY_TARGET, fx.WEEKDAY_TARGET).fillna(0.0)
    return fc.absolute_error(actual, f.weekday_rule(), fc.TEMPLATE_KEYS)


@entry("F14_choose_by_station")
def _(f: Fixture) -> DataFrame:
    f = f.stored(fx.RULE_DAYS)
    return fc.choose_by_station(_naive(f), f.weekday_rule(), fx.SPECIAL)


# --- neighbours and longer history ---


@entry("R1_neighbour_slots")
def _(f: Fixture) -> DataFrame:
    return added(nb.neighbour_slots(f.filled()), SLOT_KEYS, "inNums_", "outNums_")


@entry("R1_neighbour_hours")
def _(f: Fixture) -> DataFrame:
    return added(nb.neighbour_slots(f.filled_hours(), "hour"), HOUR_KEYS, "inNums_", "outNums_")


@entry("R2_neighbour_history")
def _(f: Fixture) -> DataFrame:
    history = nb.neighbour_history(nb.neighbour_slots(f.workdays()))
    return history.select(*SLOT_KEYS, *[c for c in history.columns if "past3" in c])


@entry("R2_neighbour_hour_history")
def _(f: Fixture) -> DataFrame:
    history = nb.neighbour_history(nb.neighbour_slots(f.work_hours(), "hour"), 5, ft.HOUR_SERIES)
    return history.select(*HOUR_KEYS, *[c for c in history.columns if "past5" in c])


@entry("R3_adjacent_flow")
def _(f: Fixture) -> DataFrame:
    table = nb.adjacent_flow(f.filled(), nb.line_edges(f.stations()), SLOT_KEYS)
    return added(table, SLOT_KEYS, "inNums_adj", "outNums_adj")


@entry("R3_adjacent_hour_flow")
def _(f: Fixture) -> DataFrame:
    table = nb.adjacent_flow(f.filled_hours(), nb.line_edges(f.stations()), HOUR_KEYS)
    return added(table, HOUR_KEYS, "inNums_adj", "outNums_adj")


@entry("R4_sliding_history")
def _(f: Fixture) -> DataFrame:
    return added(nb.sliding_history(f.workdays()), SLOT_KEYS, "inNums_y", "outNums_y")


@entry("R5_slot_trend")
def _(f: Fixture) -> DataFrame:
    return added(nb.slot_trend(f.filled()), SLOT_KEYS, "inNums_", "outNums_")


@entry("R6_linear_history")
def _(f: Fixture) -> DataFrame:
    return added(nb.linear_history(f.workdays()), SLOT_KEYS, "inNums_", "outNums_")


@entry("R7_station_vectors")
def _(f: Fixture) -> DataFrame:
    return md.station_vectors(f.stations())


@entry("R8_line_number")
def _(f: Fixture) -> DataFrame:
    return ft.join_stations(f.filled(), f.stations()).select(*SLOT_KEYS, "lineID")


@entry("R9_weekday_history")
def _(f: Fixture) -> DataFrame:
    history = ft.weekday_history(f.workdays())
    return added(history, SLOT_KEYS, "inNums_weekday", "outNums_weekday")


@entry("R9_weekday_hour_history")
def _(f: Fixture) -> DataFrame:
    history = ft.weekday_history(f.work_hours(), ft.HOUR_SERIES)
    return added(history, HOUR_KEYS, "inNums_weekday", "outNums_weekday")


@entry("R10_past_means")
def _(f: Fixture) -> DataFrame:
    means = ft.past_means(ft.lag_features(f.workdays()))
    return added(means, SLOT_KEYS, "inNums_past", "outNums_past")


# --- whole feature plans ---


@entry("M1_minute_features")
def _(f: Fixture) -> DataFrame:
    return plans.minute_features(f.slots(WORK), f.stations(), WORK, fx.WEEKDAY_TARGET)


@entry("M2_peak_features")
def _(f: Fixture) -> DataFrame:
    matrix = plans.minute_features(f.slots(WORK), f.stations(), WORK, fx.WEEKDAY_TARGET)
    ordinary, _ = sl.split_stations(matrix, fx.SPECIAL)
    return sl.peak_hours(ordinary, fx.PEAK)


@entry("M3_hour_features")
def _(f: Fixture) -> DataFrame:
    return plans.hour_features(
        f.slot_table(), f.stations(), WORK, fx.WEEKDAY_TARGET, PLAN.days()
    )


@entry("M4_workday_features")
def _(f: Fixture) -> DataFrame:
    return plans.day_before_features(f.slots(WORK), f.stations(), WORK, fx.WEEKDAY_TARGET, "zero")


@entry("M5_weekend_features")
def _(f: Fixture) -> DataFrame:
    return plans.day_before_features(f.slots(WEEKEND), f.stations(), WEEKEND, fx.WEEKEND_TARGET, "self")
