"""Small tables worked out by hand, one per trap in the semantics."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from stationflow.functions import calendar as cal
from stationflow.functions import rowstats as rs
from stationflow.operators import features as ft
from stationflow.operators import forecast as fc
from stationflow.operators import neighbours as nb
from stationflow.operators import slots as sl

SLOT = "stationID int, date date, hour int, minute int, inNums bigint, outNums bigint"
FORECAST = "stationID int, startTime timestamp_ntz, endTime timestamp_ntz, inNums double, outNums double"
D = lambda n: date(2019, 1, n)
T = lambda h, m=0: datetime(2019, 1, 29, h, m)


def slots(spark, *rows):
    return spark.createDataFrame([(1, D(d), h, m, i, o) for d, h, m, i, o in rows], SLOT)


def values(df, *columns, by=("date",)):
    return [tuple(r) for r in df.orderBy(*by).select(*columns).collect()]


def test_lag_counts_kept_rows(spark):
    df = slots(spark, (4, 8, 0, 10, 1), (7, 8, 0, 20, 2), (8, 8, 0, 30, 3), (9, 8, 0, 40, 4))
    lagged = ft.lag_features(df, lags=(1, 2))
    assert values(lagged, "inNums_last_1", "inNums_last_2") == [(0, 0), (10, 0), (20, 10), (30, 20)]


def test_first_kept_day(spark):
    df = slots(spark, (5, 8, 0, 10, 1), (6, 8, 0, 20, 2))
    assert values(ft.previous_kept_day(df, "self"), "inNums_last") == [(10,), (10,)]
    assert values(ft.previous_kept_day(df, "zero"), "inNums_last") == [(0,), (10,)]
    with pytest.raises(ValueError):
        ft.previous_kept_day(df, "other")


def test_devices_are_counted_per_day(spark):
    at = lambda d, h, m: datetime(2019, 1, d, h, m)
    taps = spark.createDataFrame(
        [
            (at(1, 8, 3), 1, 5, 1),
            (at(1, 8, 14), 1, 5, 0),
            (at(1, 9, 1), 1, 5, 1),
            (at(1, 9, 2), 1, 6, None),
            (at(2, 8, 5), 1, 5, 1),
            (at(2, 8, 6), 1, None, 0),
        ],
        "time timestamp_ntz, stationID int, deviceID int, status int",
    )
    table = sl.slot_table(taps)
    got = values(table, "day", "hour", "minute", *sl.FLOWS, *sl.DEVICE_COUNTS, by=("date", "hour", "minute"))
    assert got == [
        (1, 8, 0, 1, 0, 2, 1, 1),
        (1, 8, 10, 0, 1, 2, 1, 1),
        (1, 9, 0, 1, 0, 2, 2, 2),
        (2, 8, 0, 1, 1, 1, 1, 1),
    ]
    # A slot whose only status is null is there, with both flows 0.
    alone = sl.slot_flows(taps.filter("deviceID = 6"))
    assert values(alone, *sl.FLOWS) == [(0, 0)]


def test_week_starts_on_monday(spark):
    days = spark.createDataFrame([(D(5),), (D(6),), (D(7),)], "date date")
    assert values(sl.with_calendar(days), "week", "weekend") == [(6, 1), (7, 1), (1, 0)]


def test_row_statistics(spark):
    rows = [(1, 2, 3, 4, 10), (7, 7, 7, 7, 7), (0, 0, 0, 0, 0)]
    df = spark.createDataFrame(rows, "a long, b long, c long, d long, e long")
    group = rs.RowGroup(("a", "b", "c", "d", "e"), values="v", shares="s")
    got = {r["a"]: r for r in rs.with_row_stats(df, [group]).collect()}
    rising = got[1]
    assert (rising.v_sum, rising.v_median, rising.v_min, rising.v_max) == (20, 3.0, 1, 10)
    assert rising.v_std == pytest.approx(10**0.5)
    assert rising.v_mean_change == pytest.approx(2.25)
    assert rising.s_max == pytest.approx(10 / 20.001)
    # Deviations -3 -2 -1 0 6: third moment 180 / 5, second 10.
    assert rising.s_skew == pytest.approx(36 / 10**1.5)
    assert (got[7].v_std, got[7].s_skew, got[7].s_std) == (0.0, 0.0, 0.0)
    assert (got[0].s_median, got[0].s_skew) == (0.0, 0.0)


def test_share_order_survives_a_negative_total(spark):
    df = spark.createDataFrame([(-4, 1)], "a long, b long")
    row = rs.with_row_stats(df, [rs.RowGroup(("a", "b"), shares="s", guard=0.0)]).first()
    assert (row.s_min, row.s_max) == pytest.approx((1 / -3, 4 / 3))


def test_medians_of_every_length(spark):
    data = [9, 1, 8, 2, 7, 3]
    names = [f"c{i}" for i in range(6)]
    df = spark.createDataFrame([tuple(data)], ", ".join(f"{n} long" for n in names))
    for n in range(2, 7):
        row = rs.with_row_stats(df, [rs.RowGroup(tuple(names[:n]), values="v")]).first()
        ordered = sorted(data[:n])
        want = ordered[n // 2] if n % 2 else (ordered[n // 2 - 1] + ordered[n // 2]) / 2
        assert row.v_median == want


def test_single_row_group_has_std_zero(spark):
    df = sl.with_calendar(slots(spark, (7, 8, 0, 3, 1)))
    assert values(ft.slot_statistics(df), "inNums_whm_std", "inNums_whm_mean") == [(0.0, 3.0)]


def test_target_day_can_be_kept_out_of_statistics(spark):
    df = sl.with_calendar(slots(spark, (7, 8, 0, 4, 1), (14, 8, 0, 6, 1), (21, 8, 0, 0, 0)))
    with_target = ft.slot_statistics(df, ["inNums"])
    without = ft.slot_statistics(df, ["inNums"], exclude_days=[D(21)])
    assert values(with_target, "inNums_whm_min", "inNums_whm_mean")[0] == pytest.approx((0, 10 / 3))
    assert values(without, "inNums_whm_min", "inNums_whm_mean")[2] == (4, 5.0)


def test_weekend_ratio_guards(spark):
    rows = []
    for hour, (a, b, c, d) in enumerate([(2, 4, 2, 6), (0, 0, 2, 6), (0, 3, 2, 6), (2, 0, 0, 0)]):
        rows += [(d_, hour, 0, x, x) for d_, x in zip((12, 13, 19, 20), (a, b, c, d), strict=True)]
    ratio = fc.weekend_ratios(slots(spark, *rows), [(D(12), D(13)), (D(19), D(20))])
    assert values(ratio, "inNums_ratio", by=("hour",)) == [(2.5,), (1.0,), (1.0,), (1.0,)]


def test_weekday_rule_needs_the_source_slot(spark):
    df = slots(
        spark, (21, 8, 0, 2, 0), (22, 8, 0, 4, 0), (21, 8, 10, 6, 0), (28, 8, 0, 10, 0), (28, 9, 0, 5, 5)
    )
    template = spark.createDataFrame(
        [(1, T(8), T(8, 10)), (1, T(8, 10), T(8, 20)), (1, T(9), T(9, 10))],
        "stationID int, startTime timestamp_ntz, endTime timestamp_ntz",
    )
    got = values(fc.weekday_rule(df, template, [D(21), D(22)], D(28)), "inNums", by=("startTime",))
    # Slot mean 3, hour mean of the three slot values 4, source hour mean 10.
    assert got[0][0] == pytest.approx(3 / 4.001 * 10 * 0.965)
    assert got[1:] == [(0.0,), (0.0,)]


def test_blend_of_a_missing_key_is_null(spark):
    left = spark.createDataFrame([(1, T(h), T(h, 10), 2.0, 4.0) for h in (1, 2, 3)], FORECAST)
    right = spark.createDataFrame([(1, T(h), T(h, 10), 4.0, 0.0) for h in (1, 2)], FORECAST)
    blended = values(fc.blend([left, right], [0.5, 0.5]), "inNums", "outNums", by=("startTime",))
    assert blended == [(3.0, 2.0), (3.0, 2.0), (None, None)]
    kept = values(fc.blend([left, right], [0.5, 0.5], fallback=True), "inNums", by=("startTime",))
    assert kept[2] == (2.0,)
    same = values(fc.blend([left, left], [0.6, 0.4]), "inNums", by=("startTime",))
    assert [v[0] for v in same] == pytest.approx([2.0] * 3)
    with pytest.raises(ValueError):
        fc.blend([left], [0.5, 0.5])


def test_night_override_writes_null_for_a_missing_slot(spark):
    forecast = spark.createDataFrame([(1, T(h), T(h, 10), 2.0, 4.0) for h in (0, 4, 5)], FORECAST)
    got = values(fc.night_override(forecast, slots(spark, (20, 0, 0, 7, 8)), D(20)), *sl.FLOWS, by=("startTime",))
    assert got == [(7.0, 8.0), (None, None), (2.0, 4.0)]


def test_opening_hours_include_both_ends(spark):
    times = "stationID int, start_time string, start_time2 string, end_time string, end_time2 string"
    stations = spark.createDataFrame([(1, "06:10", "06:00", "22:50", "23:00"), (2,) + (None,) * 4], times)
    clock = [(5, 50), (6, 0), (12, 0), (23, 0), (23, 10)]
    df = spark.createDataFrame([(s, h, m) for s in (1, 2) for h, m in clock], "stationID int, hour int, minute int")
    got = values(ft.opening_flag(df, stations), "is_run", by=("stationID", "hour", "minute"))
    assert [g[0] for g in got] == [0, 1, 1, 1, 0] + [0] * 5


def test_append_template_fills_with_zero(spark):
    df = sl.with_calendar(slots(spark, (28, 8, 0, 3, 1)))
    template = spark.createDataFrame(
        [(1, T(8), T(8, 10))], "stationID int, startTime timestamp_ntz, endTime timestamp_ntz"
    )
    got = values(sl.append_template(df, template), "day", "week", "weekend", "inNums", "day_since_first")
    assert got == [(28, 1, 0, 3, 27), (29, 2, 0, 0, 28)]


def test_fill_gaps_drops_facts_outside_the_grid(spark):
    stations = spark.createDataFrame([(1,)], "stationID int")
    facts = slots(spark, (1, 8, 0, 3, 1), (9, 8, 0, 5, 5))
    filled = sl.fill_gaps(facts, sl.station_grid(stations, [D(1), D(2)]))
    assert filled.count() == 2 * 144
    assert filled.agg(F.sum("inNums"), F.sum("outNums")).first() == (3, 1)


def test_day_index_round_trip(spark):
    kept = [D(4), D(2), D(7)]
    df = spark.createDataFrame([(D(n),) for n in (2, 3, 4, 7)], "date date")
    indexed = df.withColumn("i", cal.day_index(F.col("date"), kept))
    back = indexed.withColumn("b", cal.day_at(F.col("i"), kept))
    assert values(back, "i", "b") == [(1, D(2)), (None, None), (2, D(4)), (3, D(7))]


def test_rescale_and_choice(spark):
    forecast = spark.createDataFrame([(s, T(8), T(8, 10), 10.0, 20.0) for s in (7, 8)], FORECAST)
    scaled = fc.rescale(forecast, 0.5, [(7, range(6, 24), "outNums", 1.1)])
    assert [v for r in values(scaled, *sl.FLOWS, by=("stationID",)) for v in r] == pytest.approx([5, 11, 5, 10])
    rule = forecast.withColumn("inNums", F.lit(99.0))
    chosen = fc.choose_by_station(forecast, rule, [7])
    assert values(chosen, "inNums", by=("stationID",)) == [(99.0,), (10.0,)]


def test_linear_history_uses_earlier_days_only(spark):
    df = slots(spark, (1, 8, 0, 1, 0), (2, 8, 0, 3, 0), (3, 8, 0, 8, 0), (4, 8, 0, 1000, 0))
    got = values(nb.linear_history(df), "inNums_slope", "inNums_residual")
    assert got[0] == got[1] == (0.0, 0.0)
    assert got[2] == pytest.approx((2.0, 0.0))
    # Line through (1,1), (2,3), (3,8): slope 3.5, value 7.5 at day 3.
    assert got[3] == pytest.approx((3.5, 0.5))


def test_trend_reads_the_line_at_the_target(spark):
    df = slots(spark, (1, 8, 0, 1, 9), (2, 8, 0, 3, 6), (4, 8, 0, 7, 0)).drop("minute")
    got = values(fc.trend_forecast(df, [D(1), D(2), D(4)], D(7)), *sl.FLOWS, by=("hour",))
    assert got[0] == pytest.approx((13.0, 0.0))


def test_days_count_across_months(spark):
    from datetime import date

    from stationflow.operators import slots as sl

    rows = [(0, date(2024, 1, 31), 5, 0, 1, 2), (0, date(2024, 2, 1), 5, 0, 3, 4), (0, date(2024, 2, 29), 5, 0, 5, 6)]
    df = spark.createDataFrame(rows, "stationID int, date date, hour int, minute int, inNums long, outNums long")
    counted = sl.with_calendar(df, date(2024, 1, 1)).orderBy("date").collect()
    assert [r.day_since_first for r in counted] == [30, 31, 59]
    series = sl.slot_series(df, [r[1] for r in rows], ["stationID"]).first()
    assert series.days == [1, 2, 30] and series.in_series == [1, 3, 5]
    assert sl.day_runs([r[1] for r in rows]) == [(rows[0][1], rows[1][1]), (rows[2][1], rows[2][1])]


def test_shifted_day_does_not_pass_over_a_missing_day(spark):
    """Kept days 4, 5, 8 and 9; the slot has no row on day 5, and day 6 is not kept."""
    from datetime import date

    from stationflow.operators import features as ft

    kept = [date(2024, 1, d) for d in (4, 5, 8, 9)]
    rows = [(1, date(2024, 1, d), 7, 0, n, 2 * n) for d, n in ((4, 10), (6, 99), (8, 30), (9, 40))]
    df = spark.createDataFrame(rows, "stationID int, date date, hour int, minute int, inNums long, outNums long")
    got = {r.date.day: (r.inNums_last_1, r.outNums_last_1) for r in ft.shifted_day(df, kept).collect()}
    assert got == {4: (0, 0), 6: (0, 0), 8: (0, 0), 9: (30, 60)}
    twice = {r.date.day: r.inNums_last_2 for r in ft.shifted_day(df, kept, by=2).collect()}
    assert twice == {4: 0, 6: 0, 8: 10, 9: 0}


def test_piecewise_trend_follows_a_bend(spark):
    """Flat, then rising by 2 a day from day 8: the broken line goes on rising, the straight one falls short."""
    from datetime import date

    import numpy as np

    from stationflow.operators import forecast as fc

    kept, target, change = [date(2024, 1, d) for d in range(1, 16)], date(2024, 1, 18), date(2024, 1, 8)
    level = lambda d: 10 + 2 * max(d - 8, 0)
    rows = [(1, d, 7, level(d.day), 5) for d in kept] + [(2, kept[0], 7, 4, 4)]
    df = spark.createDataFrame(rows, "stationID int, date date, hour int, inNums long, outNums long")
    bent = {r.stationID: r for r in fc.piecewise_trend(df, kept, target, [change], ridge=0.001).collect()}
    line = {r.stationID: r for r in fc.trend_forecast(df, kept, target).collect()}
    assert abs(bent[1].inNums - 30) < 0.1 and abs(line[1].inNums - 30) > 3 and abs(bent[1].outNums - 5) < 0.01
    x = np.array([(d - target).days for d in kept], float)
    b = np.stack([np.ones(15), x, np.maximum(x + 10, 0)], 1)
    for ridge in (0.001, 3.0):
        want = np.linalg.solve(b.T @ b + ridge * np.diag([0, 1, 1]), b.T @ [level(d.day) for d in kept]) @ [1, 0, 10]
        got = {r.stationID: r for r in fc.piecewise_trend(df, kept, target, [change], ridge).collect()}
        assert abs(got[1].inNums - want) < 1e-6
    assert bent[2].inNums > 0  # one day is enough for a value
