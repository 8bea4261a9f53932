"""Hot keys, plan shapes and invariants."""

import re
from datetime import date, datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stationflow.operators import features as ft
from stationflow.operators import neighbours as nb
from stationflow.operators import slots as sl
from stationflow.plans import features as plans
from stationflow.plans import fixture as fx
from stationflow.plans.catalog import CATALOG
from stationflow.plans.fixture import PLAN, Fixture
from stationflow.sources.schemas import SLOT_KEYS


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(plan: str) -> int:
    return len(re.findall(r"\bExchange hashpartitioning", plan))


@pytest.fixture(scope="module")
def hot_taps():
    """Taps of 20 stations, a third of them at station 0, half of those in one slot."""
    rng = np.random.default_rng(7)
    n = 30_000
    station = np.where(rng.random(n) < 1 / 3, 0, rng.integers(1, 20, n))
    seconds = rng.integers(0, 3 * 86_400, n)
    seconds = np.where((station == 0) & (rng.random(n) < 0.5), 30_000 + seconds % 500, seconds)
    start = datetime(2024, 1, 1)
    return pd.DataFrame(
        {
            "time": [start + timedelta(seconds=int(s)) for s in seconds],
            "stationID": station.astype("int32"),
            "deviceID": rng.integers(0, 50, n).astype("int32"),
            "status": rng.integers(0, 2, n).astype("int32"),
        }
    )


def test_hot_station_against_brute_force(spark, hot_taps):
    schema = "time timestamp_ntz, stationID int, deviceID int, status int"
    got = sl.slot_table(spark.createDataFrame(hot_taps, schema)).toPandas()
    t = hot_taps.assign(
        day=hot_taps.time.dt.day, hour=hot_taps.time.dt.hour, minute=hot_taps.time.dt.minute // 10 * 10
    )
    keys = ["stationID", "day", "hour", "minute"]
    want = t.groupby(keys).agg(inNums=("status", "sum"), n=("status", "count")).reset_index()
    for name, k in zip(sl.DEVICE_COUNTS, (keys[:2], keys[:3], keys), strict=True):
        want = want.merge(t.groupby(k).deviceID.nunique().rename(name).reset_index(), on=k)
    want["outNums"] = want.n - want.inNums
    columns = [*keys, "inNums", "outNums", *sl.DEVICE_COUNTS]
    tidy = lambda d: d[columns].astype("int64").sort_values(keys).reset_index(drop=True)
    pd.testing.assert_frame_equal(tidy(got), tidy(want))


def test_hub_station_against_brute_force(spark):
    """One station that neighbours all others, with every salt giving the same result."""
    rows = [(s, date(2024, 1, d), 8, 0, s * d, s + d) for s in range(30) for d in range(1, 11)]
    slots = spark.createDataFrame(
        rows, "stationID int, date date, hour int, minute int, inNums bigint, outNums bigint"
    )
    pairs = [(0, s, 1) for s in range(1, 30)] + [(s, 0, -1) for s in range(1, 30)]
    edges = spark.createDataFrame(pairs, "stationID int, neighborID int, side int")
    got = {
        salts: nb.adjacent_flow(slots, edges, SLOT_KEYS, salts=salts).orderBy(*SLOT_KEYS).collect()
        for salts in (1, 7)
    }
    for one, seven in zip(got[1], got[7], strict=True):
        assert one.asDict() == pytest.approx(seven.asDict(), abs=1e-9)
    for r in got[7]:
        d = r.date.day
        near = [s * d for s in range(1, 30)] if r.stationID == 0 else [0]
        assert (r.inNums_adj_min, r.inNums_adj_max) == (min(near), max(near))
        assert r.inNums_adj_mean == pytest.approx(np.mean(near))


def test_line_edges_with_gaps_shared_places_and_nulls(spark):
    rows = [(1, 1, 1), (2, 1, 2), (3, 1, 2), (4, 1, 4), (5, 2, 1), (6, 2, 2), (7, None, 1), (8, 2, None), (9, 2, None)]
    stations = spark.createDataFrame(rows, "stationID int, lineID int, linePos int")
    got = sorted(tuple(r) for r in nb.line_edges(stations).collect())
    want = [
        (s, t, q - p) for s, line, p in rows for t, other, q in rows
        if None not in (line, p, q) and line == other and abs(p - q) == 1
    ]
    assert got == sorted(want)


def test_repeated_edges_count_again(spark):
    slots = spark.createDataFrame(
        [(s, date(2024, 1, 1), 8, 0, 10 * s, s) for s in (1, 2)],
        "stationID int, date date, hour int, minute int, inNums bigint, outNums bigint",
    )
    edges = spark.createDataFrame([(1, 2, 1), (1, 2, 1), (2, 1, -1)], "stationID int, neighborID int, side int")
    got = {r.stationID: r for r in nb.adjacent_flow(slots, edges, SLOT_KEYS).collect()}
    assert (got[1].inNums, got[1].inNums_adj_after, got[2].inNums, got[2].inNums_adj_before) == (10, 40, 20, 10)


def test_adjacent_flow_joins_no_stations_with_stations(spark, sf_dir):
    plan = plan_of(CATALOG["R3_adjacent_flow"](spark, sf_dir))
    assert plan.count("FileScan") == 4  # taps, grid, edges, own rows
    assert len(re.findall(r"(SortMerge|BroadcastHash|ShuffledHash)Join", plan)) == 1


def test_grid_and_tap_counts(spark, sf_dir):
    f = Fixture(spark, sf_dir)
    stations = f.stations().count()
    total = f.filled().agg(F.count("*"), F.sum(F.col("inNums") + F.col("outNums"))).first()
    assert total == (stations * 30 * 144, f.taps().count())


def test_shares_of_an_hour_sum_to_six(spark, sf_dir):
    from stationflow.operators import forecast as fc

    shares = fc.slot_shares(Fixture(spark, sf_dir).filled(fx.REFERENCE), fx.REFERENCE)
    sums = shares.filter("inNums_mean_hour > 0").groupBy("stationID", "hour").agg(
        F.sum("inNums_share").alias("s"), F.max("inNums_mean_hour").alias("m")
    )
    for r in sums.collect():
        assert r.s == pytest.approx(6 * r.m / (r.m + 0.001))


def test_minute_features_exchange_slots_once(spark, sf_dir):
    """After the slots exist, one exchange by station and hour serves every window."""
    f = Fixture(spark, sf_dir)
    matrix = plans.minute_features(f.slots(), f.stations(), PLAN.workdays(), fx.WEEKDAY_TARGET)
    plan = plan_of(matrix.drop("lineID", "linePos", "is_run"))
    by_cluster = re.findall(r"Exchange hashpartitioning\(stationID#\d+, hour#\d+, \d+\)", plan)
    assert len(by_cluster) == 2  # slots, and the grid's hour rows
    assert len(re.findall(r"\bWindow \[", plan)) == 3


def test_slots_combine_before_their_only_exchange(spark, sf_dir):
    plan = plan_of(Fixture(spark, sf_dir).slots())
    assert exchanges(plan) == 1
    assert "partial_sum" in plan.split("Exchange")[1]


def test_scan_reads_used_columns_only(spark, sf_dir):
    plan = plan_of(Fixture(spark, sf_dir).slots())
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in plan


def test_day_filter_prunes_slot_partitions(spark, sf_dir, tmp_path):
    from stationflow.sources import readers, writers

    writers.write_slots(Fixture(spark, sf_dir).slots(), str(tmp_path / "slots"))
    back = sl.on_days(readers.read_slots(spark, str(tmp_path / "slots")), fx.SUNDAYS)
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan_of(back)).group(1)
    assert "date" in filters and ("2024-01-07" in filters or "19729" in filters)


def test_station_filter_reaches_below_the_windows(spark, sf_dir):
    f = Fixture(spark, sf_dir)
    one = ft.slot_statistics(ft.lag_features(f.workdays())).filter("stationID = 1")
    scan = plan_of(one).split("FileScan")[0]
    assert scan.rindex("Filter") > scan.rindex("Window")


def test_one_day_reads_one_file(spark, sf_dir, tmp_path):
    from stationflow.sources import readers, writers

    writers.write_taps(Fixture(spark, sf_dir).taps(), str(tmp_path / "taps"))
    taps = readers.read_taps(spark, str(tmp_path / "taps"), by_day=True)
    files = lambda df: df.selectExpr("input_file_name() AS file").distinct().count()
    day = fx.WEEKDAY_SOURCE
    one = sl.taps_on_days(taps, [day])
    assert "record_day" in re.search(r"PartitionFilters: \[(.*?)\]", plan_of(one)).group(1)
    assert files(taps) >= 30
    assert files(one) == 1
    same = sl.taps_on_days(Fixture(spark, sf_dir).taps(), [day])
    assert one.count() == same.count() > 0


def test_scattered_days_push_a_range_each(spark, sf_dir):
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    plan = plan_of(sl.taps_on_days(Fixture(spark, sf_dir).taps(), fx.WEEKEND_RULE_DAYS))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan.split("PushedFilters:")[1].split("ReadSchema")[0]
    assert pushed.count("GreaterThanOrEqual") == len(sl.day_runs(fx.WEEKEND_RULE_DAYS)) == 4


SLOW = ("F11", "R7", "S")


@pytest.mark.parametrize("name", [n for n in CATALOG if not n.startswith(SLOW)])
def test_one_tap_scan_no_python_no_cross_join(spark, sf_dir, name):
    plan = plan_of(CATALOG[name](spark, sf_dir))
    assert plan.count("events.parquet") <= 1, "the taps are read more than once"
    for word in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "ExistingRDD"):
        assert word not in plan
