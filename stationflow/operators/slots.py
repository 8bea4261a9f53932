"""From taps to a gap-free slot table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationflow.functions import calendar as cal
from stationflow.sources.schemas import FLOWS, HOUR_KEYS, SLOT_KEYS, TAP_DAY

DEVICE_COUNTS = (
    "nuni_deviceID_of_stationID",
    "nuni_deviceID_of_stationID_hour",
    "nuni_deviceID_of_stationID_hour_minute",
)
# Every later window and join clusters on at least these two columns, so a
# table partitioned by them needs no further exchange.
CLUSTER = ("stationID", "hour")


def clustered(df: DataFrame) -> DataFrame:
    """Partition by station and hour into a fixed number of partitions.

    The number is named so that adaptive execution does not merge them: the
    rows are few bytes here but grow many features afterwards, and the size of
    this exchange says nothing about the work behind it.
    """
    spark = df.sparkSession
    partitions = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism
    )
    return df.repartition(partitions, *CLUSTER)


def with_slot_keys(taps: DataFrame, ts: str = "time") -> DataFrame:
    """Add the columns that name a tap's slot."""
    return taps.selectExpr(
        "*",
        f"to_date({ts}) AS date",
        f"hour({ts}) AS hour",
        f"minute({ts}) - minute({ts}) % 10 AS minute",
    )


def with_calendar(df: DataFrame, first: date | None = None) -> DataFrame:
    """Day of month, weekday, weekend flag and days since the first, from ``date``.

    They are functions of the date alone, so rows without taps get them too.
    ``first`` is the first day of the data; without it days count from the first
    of their month.
    """
    start = f"DATE'{first}'" if first else "trunc(date, 'MM')"
    return df.selectExpr(
        "*",
        "dayofmonth(date) AS day",
        "weekday(date) + 1 AS week",
        "CAST(weekday(date) >= 5 AS INT) AS weekend",
        f"datediff(date, {start}) AS day_since_first",
    )


def _flows(entered: str, counted: str) -> list[Column]:
    # A slot whose statuses are all null has a null sum but counts as empty.
    ins = f"coalesce({entered}, 0L)"
    return [F.expr(ins).alias("inNums"), F.expr(f"{counted} - {ins}").alias("outNums")]


def slot_flows_by(taps: DataFrame, keys: Sequence[str]) -> DataFrame:
    return taps.groupBy(*keys).agg(*_flows("sum(status)", "count(status)"))


def slot_flows(taps: DataFrame) -> DataFrame:
    """Entries and exits per slot: one scan, one exchange, combined before it.

    However many taps one station has, each task sends at most one row per slot.
    """
    return slot_flows_by(with_slot_keys(taps), SLOT_KEYS)


def slot_table(taps: DataFrame, first: date | None = None) -> DataFrame:
    """Flows plus distinct devices per station, hour and slot, each within a day.

    Taps are combined to one row per slot and device first. A device's earlier
    slot on the same day tells whether it is new to the day and to the hour, so
    all three distinct counts become sums and the taps are read once.
    """
    used = (
        with_slot_keys(taps)
        .groupBy(*SLOT_KEYS, "deviceID")
        .agg(F.expr("sum(status)").alias("entered"), F.expr("count(status)").alias("counted"))
    )
    history = "(PARTITION BY stationID, date, deviceID ORDER BY hour, minute)"
    seen = used.selectExpr("*", f"lag(hour) OVER {history} AS seen_hour")
    known = seen.selectExpr(
        "*",
        "deviceID IS NOT NULL AND seen_hour IS NULL AS new_today",
        "deviceID IS NOT NULL AND NOT seen_hour <=> hour AS new_hour",
    )
    slots = known.groupBy(*SLOT_KEYS).agg(
        *_flows("sum(entered)", "sum(counted)"),
        F.expr("count_if(new_today)").alias("new_today"),
        F.expr("count_if(new_hour)").alias("new_hour"),
        F.expr("count(deviceID)").alias(DEVICE_COUNTS[2]),
    )
    counted = slots.selectExpr(
        "*",
        f"sum(new_today) OVER (PARTITION BY stationID, date) AS {DEVICE_COUNTS[0]}",
        f"sum(new_hour) OVER (PARTITION BY stationID, date, hour) AS {DEVICE_COUNTS[1]}",
    )
    return with_calendar(counted, first).select(
        "stationID", "date", "day", "week", "weekend", "hour", "minute",
        *FLOWS, *DEVICE_COUNTS, "day_since_first",
    )


def station_grid(stations: DataFrame, days: Sequence[date], grain: str = "slot") -> DataFrame:
    """Every station x day x hour (x ten minutes), without a join.

    ``stations`` holds one row per ``stationID``. Only stations x hours are
    exchanged; days and minutes are added where the rows will stay, so neither
    one task nor the exchange carries the full grid.
    """
    if grain not in ("slot", "hour"):
        raise ValueError(f"unknown grain {grain!r}")
    spread = clustered(stations.selectExpr("stationID", "explode(sequence(0, 23)) AS hour"))
    hours = spread.selectExpr(
        "stationID", f"explode(array({cal.date_sql(days)})) AS date", "hour"
    )
    if grain == "hour":
        return hours
    return hours.selectExpr("*", "explode(sequence(0, 50, 10)) AS minute")


def fill_gaps(facts: DataFrame, grid: DataFrame, keys: Sequence[str] = SLOT_KEYS) -> DataFrame:
    """Grid left join facts, missing measures 0, for facts unique per key.

    Facts and grid are partitioned alike and stacked, then combined per key
    inside each partition: no sort, no join. Facts outside the grid drop out.
    """
    types = {c: t for c, t in facts.dtypes if c not in keys}
    rows = clustered(facts).selectExpr(*keys, *types, "0 AS in_grid")
    empty = grid.selectExpr(
        *keys, *[f"CAST(NULL AS {t}) AS {m}" for m, t in types.items()], "1 AS in_grid"
    )
    merged = rows.unionByName(empty).groupBy(*keys).agg(
        *[F.expr(f"coalesce(max({m}), 0)").alias(m) for m in types],
        F.expr("max(in_grid)").alias("in_grid"),
    )
    return merged.filter("in_grid = 1").drop("in_grid")


def hour_rollup(slots: DataFrame) -> DataFrame:
    """Hourly sums of the flows and means of the device counts."""
    means = [c for c in DEVICE_COUNTS[:2] if c in slots.columns]
    return slots.groupBy(*HOUR_KEYS).agg(
        *[F.sum(f).alias(f) for f in FLOWS],
        *[F.avg(c).alias(c) for c in means],
    )


def combine_in_out(ins: DataFrame, outs: DataFrame) -> DataFrame:
    """Inner join of the entry and the exit table on station and slot start."""
    return ins.join(outs, ["stationID", "time"], "inner")


def union_days(*tables: DataFrame) -> DataFrame:
    """Stack daily tables by column name."""
    stacked = tables[0]
    for table in tables[1:]:
        stacked = stacked.unionByName(table)
    return stacked


def append_template(slots: DataFrame, template: DataFrame, first: date | None = None) -> DataFrame:
    """Add the slots to forecast as rows; columns the template lacks become 0."""
    rows = with_calendar(with_slot_keys(template, "startTime"), first).drop("startTime", "endTime")
    return slots.unionByName(rows, allowMissingColumns=True).fillna(0)


def rejoin_stations(forecast: DataFrame, special: DataFrame) -> DataFrame:
    """Put stations left out of modelling back under the modelled ones."""
    return forecast.unionByName(special.select(*forecast.columns))


def taps_on_days(taps: DataFrame, days: Sequence[date]) -> DataFrame:
    """Taps of the given days.

    One range on the raw time per run of consecutive days reaches the scan and
    skips whole row groups between them; where the files lie in folders by day,
    the folders of other days are not read at all.
    """
    if not days:
        return taps.filter("FALSE")
    ranges = " OR ".join(
        f"(time >= TIMESTAMP_NTZ'{first} 00:00:00' AND time < TIMESTAMP_NTZ'{last + timedelta(1)} 00:00:00')"
        for first, last in day_runs(days)
    )
    taken = taps.filter(ranges)
    return taken.filter(cal.in_days(days, TAP_DAY)) if TAP_DAY in taps.columns else taken


def day_runs(days: Sequence[date]) -> list[tuple[date, date]]:
    """First and last day of each run of consecutive days."""
    runs: list[tuple[date, date]] = []
    for day in sorted(set(days)):
        if runs and day == runs[-1][1] + timedelta(1):
            runs[-1] = (runs[-1][0], day)
        else:
            runs.append((day, day))
    return runs


def on_days(df: DataFrame, days: Sequence[date]) -> DataFrame:
    return df.filter(cal.in_days(days))


def drop_days(df: DataFrame, days: Sequence[date]) -> DataFrame:
    return df.filter(f"NOT ({cal.in_days(days)})")


def day_range(df: DataFrame, first: date, last: date) -> DataFrame:
    return df.filter(F.col("date").between(first, last))


def split_stations(df: DataFrame, special: Sequence[int]) -> tuple[DataFrame, DataFrame]:
    """(ordinary stations, special stations)."""
    is_special = F.col("stationID").isin(list(special))
    return df.filter(~is_special), df.filter(is_special)


def peak_hours(df: DataFrame, hours: Sequence[int] = (7, 8, 9, 17, 18)) -> DataFrame:
    return df.filter(F.col("hour").isin(list(hours)))


def drop_warm_up(df: DataFrame, kept: Sequence[date], n: int = 5) -> DataFrame:
    """Drop the first ``n`` kept days, whose lags are incomplete."""
    return df.filter(cal.day_index(F.col("date"), kept) > n)


def mask_days(df: DataFrame, days: Sequence[date], columns: Sequence[str] = FLOWS) -> DataFrame:
    """Set measures to 0 on the days to forecast, as the template rows have them."""
    hidden = cal.in_days(days)
    return df.selectExpr(
        *[f"CASE WHEN {hidden} THEN 0 ELSE {c} END AS {c}" if c in columns else c for c in df.columns]
    )


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def slot_series(
    df: DataFrame, days: Sequence[date], keys: Sequence[str], first: date | None = None
) -> DataFrame:
    """Per key, the flows ordered by day: one entry for each listed day at most.

    Flows are summed to one row per key and day first, so an array is never
    longer than the day list, whatever the data holds. Days are numbered from 1
    at ``first`` (default: the first listed).
    """
    start = f"DATE'{first or min(days)}'" if first or days else "c.date"
    daily = (
        on_days(df, days)
        .groupBy(*keys, "date")
        .agg(*[F.sum(f).alias(f) for f in FLOWS])
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_list(F.struct("date", *FLOWS))).alias("cells"))
    )
    return daily.select(
        *keys,
        F.expr(f"transform(cells, c -> datediff(c.date, {start}) + 1)").alias("days"),
        F.col("cells.inNums").alias("in_series"),
        F.col("cells.outNums").alias("out_series"),
    )
