"""Lag, change, row-statistic and slot-statistic features.

All windows are keyed by a station and an hour at least, with the station and
the hour leading the key. A table partitioned by ``slots.CLUSTER`` therefore
needs no exchange for any of them, and a window never holds more rows than its
station has days (or days x 6) in the calendar.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.functions import calendar as cal
from stationflow.functions import rowstats as rs
from stationflow.sources.schemas import FLOWS

SLOT_SERIES = ("stationID", "hour", "minute")
HOUR_SERIES = ("stationID", "hour")
GUARD = 0.001


def series_window(keys: Sequence[str]) -> str:
    return f"(PARTITION BY {', '.join(keys)} ORDER BY date)"


def _lagged(source: str, k: int, window: str, name: str) -> str:
    return f"coalesce(lag({source}, {k}) OVER {window}, 0) AS {name}"


def lag_name(flow: str, k: int) -> str:
    return f"{flow}_last_{k}"


def lag_features(
    df: DataFrame,
    keys: Sequence[str] = SLOT_SERIES,
    flows: Sequence[str] = FLOWS,
    lags: Sequence[int] = (1, 2, 3, 4, 5),
) -> DataFrame:
    """Flows of the k-th kept day before, 0 where there is none."""
    window = series_window(keys)
    return df.selectExpr(
        "*", *[_lagged(f, k, window, lag_name(f, k)) for k in lags for f in flows]
    )


def previous_kept_day(
    df: DataFrame,
    first: str,
    keys: Sequence[str] = SLOT_SERIES,
    flows: Sequence[str] = FLOWS,
) -> DataFrame:
    """``<flow>_last``: the kept day before.

    The first kept day takes its own value (``first="self"``) or 0
    (``first="zero"``).
    """
    if first not in ("self", "zero"):
        raise ValueError(f"first must be 'self' or 'zero', not {first!r}")
    window = series_window(keys)
    start = (lambda f: f) if first == "self" else (lambda f: "0")
    return df.selectExpr(
        "*", *[f"coalesce(lag({f}) OVER {window}, {start(f)}) AS {f}_last" for f in flows]
    )


def shifted_day(
    df: DataFrame,
    kept: Sequence[date],
    by: int = 1,
    keys: Sequence[str] = SLOT_SERIES,
    flows: Sequence[str] = FLOWS,
) -> DataFrame:
    """Flows of the kept day ``by`` places earlier, 0 where it has no row.

    The frame is a range of the day's place among the kept days, so a slot that
    is absent on a day is not passed over, as it is by a row lag. Rows of other
    days get 0. One window over the series, no join of the table with itself.
    """
    frame = f"(PARTITION BY {', '.join(keys)} ORDER BY _place RANGE BETWEEN {by} PRECEDING AND {by} PRECEDING)"
    placed = df.withColumn("_place", cal.day_index(F.col("date"), kept))
    earlier = [f"if(_place IS NULL, 0, coalesce(sum({f}) OVER {frame}, 0)) AS {lag_name(f, by)}" for f in flows]
    return placed.selectExpr("*", *earlier).drop("_place")


def group_shift(
    df: DataFrame, column: str, k: int, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """One column shifted by ``k`` rows inside its group."""
    window = f"(PARTITION BY {', '.join(keys)} ORDER BY {', '.join(order)})"
    return df.selectExpr("*", f"lag({column}, {k}) OVER {window} AS {column}_shift_{k}")


def change_features(
    df: DataFrame, flows: Sequence[str] = FLOWS, guard: float = GUARD
) -> DataFrame:
    """Mean of three lags, differences between them, and guarded ratios."""
    added = []
    for f in flows:
        one, two, three = (lag_name(f, k) for k in (1, 2, 3))
        added += [
            f"{rs.row_mean([one, two, three])} AS {f}_mean_3",
            f"{one} - {two} AS {f}_diff_1",
            f"{two} - {three} AS {f}_diff_2",
            f"({one} - {two}) - ({two} - {three}) AS {f}_diff_diff",
            f"{one} / ({two} + {guard}D) AS {f}_divide_1",
            f"{two} / ({three} + {guard}D) AS {f}_divide_2",
        ]
    return df.selectExpr("*", *added)


def _lag_names(flow: str, window: int) -> tuple[str, ...]:
    return tuple(lag_name(flow, k) for k in range(1, window + 1))


def past_value_stats(
    df: DataFrame, flows: Sequence[str] = FLOWS, windows: Sequence[int] = (3, 5)
) -> DataFrame:
    """Sum, median, std, min, max and mean change over the last 3 and 5 lags."""
    groups = [
        rs.RowGroup(_lag_names(f, n), values=f"district_{f}_last{n}") for f in flows for n in windows
    ]
    return rs.with_row_stats(df, groups)


def past_share_stats(
    df: DataFrame,
    flows: Sequence[str] = FLOWS,
    windows: Sequence[int] = (3, 5),
    guard: float = GUARD,
) -> DataFrame:
    """The same windows as shares of their sum, plus the skew of the values."""
    groups = [
        rs.RowGroup(_lag_names(f, n), shares=f"district_percent_{f}_last{n}", guard=guard)
        for f in flows
        for n in windows
    ]
    return rs.with_row_stats(df, groups)


def past_stats(
    df: DataFrame,
    flows: Sequence[str] = FLOWS,
    windows: Sequence[int] = (3, 5),
    guard: float = GUARD,
) -> DataFrame:
    """Value and share statistics together, from the same sums and moments."""
    groups = [
        rs.RowGroup(
            _lag_names(f, n),
            values=f"district_{f}_last{n}",
            shares=f"district_percent_{f}_last{n}",
            guard=guard,
        )
        for f in flows
        for n in windows
    ]
    return rs.with_row_stats(df, groups)


def past_means(
    df: DataFrame, flows: Sequence[str] = FLOWS, windows: Sequence[int] = (3, 5)
) -> DataFrame:
    """Plain mean over the past n kept days."""
    return df.selectExpr(
        "*", *[f"{rs.row_mean(_lag_names(f, n))} AS {f}_past{n}_mean" for f in flows for n in windows]
    )


def past_n_features(
    df: DataFrame,
    keys: Sequence[str] = SLOT_SERIES,
    flows: Sequence[str] = FLOWS,
    windows: Sequence[int] = (3, 6, 13, 20, 27),
    include_current: bool = True,
    guard: float = 1e-5,
) -> DataFrame:
    """Value and share statistics over ``before_1 .. before_n`` and the current value.

    The lags are computed once for the longest window. Missing lags count as 0.
    """
    window = series_window(keys)
    before = lambda f, k: f"{f}_before_{k}"
    depth = range(1, max(windows) + 1)
    lagged = df.selectExpr("*", *[_lagged(f, k, window, before(f, k)) for f in flows for k in depth])
    groups = [
        rs.RowGroup(
            tuple(before(f, k) for k in range(1, n + 1)) + ((f,) if include_current else ()),
            values=f"district_{f}_last{n}",
            shares=f"district_percent_{f}_last{n}",
            guard=guard,
        )
        for f in flows
        for n in windows
    ]
    return rs.with_row_stats(lagged, groups, keep=df.columns)


def same_weekday_features(
    df: DataFrame,
    keys: Sequence[str] = SLOT_SERIES,
    flows: Sequence[str] = FLOWS,
    weeks: Sequence[int] = (1, 2, 3),
) -> DataFrame:
    """The value a week back, and statistics over 1 to 3 weeks and the current value.

    Expects every calendar day to be present, so that seven rows are a week.
    """
    window = series_window(keys)
    back = lambda f, w: f"{f}_last_week" if w == 1 else f"{f}_week_back_{w}"
    lagged = df.selectExpr(
        "*", *[_lagged(f, 7 * w, window, back(f, w)) for f in flows for w in weeks]
    )
    groups = [
        rs.RowGroup(
            (*[back(f, k) for k in range(1, w + 1)], f),
            values=f"{f}_w{w}",
            stats=rs.HISTORY_STATS if w > 1 else ("mean",),
        )
        for f in flows
        for w in weeks
    ]
    return rs.with_row_stats(lagged, groups, keep=[*df.columns, *[back(f, 1) for f in flows]])


def weekday_history(
    df: DataFrame,
    keys: Sequence[str] = SLOT_SERIES,
    flows: Sequence[str] = FLOWS,
    weeks: Sequence[int] = (1, 2, 3),
) -> DataFrame:
    """Like :func:`same_weekday_features`, by the rows of the same weekday.

    Holds when some days are missing: the k-th earlier row of that weekday is
    taken, wherever it lies. The current value is not part of the statistics.
    """
    window = series_window([*keys, "week"])
    back = lambda f, w: f"{f}_weekday_back_{w}"
    lagged = df.selectExpr("*", *[_lagged(f, w, window, back(f, w)) for f in flows for w in weeks])
    groups = [
        rs.RowGroup(
            tuple(back(f, w) for w in weeks), values=f"{f}_weekday", stats=rs.HISTORY_STATS
        )
        for f in flows
    ]
    return rs.with_row_stats(lagged, groups)


AGGREGATES = {"max": "max", "min": "min", "mean": "avg", "std": "stddev_samp"}


def _group_stats(
    flows: Sequence[str], prefix: str, keys: str, stats: Sequence[str], only: str | None
) -> list[str]:
    seen = (lambda f: f"CASE WHEN {only} THEN {f} END") if only else str
    # The sample std of a single row is null and counts as 0.
    return [
        f"coalesce({AGGREGATES[s]}({seen(f)}) OVER (PARTITION BY {keys}), 0) AS {f}_{prefix}_{s}"
        for f in flows
        for s in stats
    ]


def _shown(exclude_days: Sequence[date], only: str | None) -> str | None:
    terms = [f"NOT ({cal.in_days(exclude_days)})"] if exclude_days else []
    return " AND ".join(terms + ([f"({only})"] if only else [])) or None


def slot_statistics(
    df: DataFrame,
    flows: Sequence[str] = FLOWS,
    stats: Sequence[str] = ("max", "min", "mean", "std"),
    exclude_days: Sequence[date] = (),
    only: str | None = None,
) -> DataFrame:
    """Per station, weekday and slot: max, min, mean, sample std of each flow.

    Attached by window, so there is no aggregate-and-join. ``exclude_days``
    keeps the placeholder rows of the days to forecast out of the statistics,
    ``only`` is a predicate for the rows to take them from.
    """
    keys = "stationID, hour, week, minute"
    shown = _shown(exclude_days, only)
    return df.selectExpr("*", *_group_stats(flows, "whm", keys, stats, shown))


def hour_statistics(
    df: DataFrame,
    flows: Sequence[str] = FLOWS,
    stats: Sequence[str] = ("max", "min", "mean", "std"),
    exclude_days: Sequence[date] = (),
    only: str | None = None,
) -> DataFrame:
    """Per station, weekday and hour: max, min, mean, sample std of each flow."""
    keys = "stationID, hour, week"
    shown = _shown(exclude_days, only)
    return df.selectExpr("*", *_group_stats(flows, "wh", keys, stats, shown))


def attach_hour_statistics(
    df: DataFrame,
    hours: DataFrame,
    flows: Sequence[str] = FLOWS,
    stats: Sequence[str] = ("max", "min", "mean", "std"),
) -> DataFrame:
    """Hour statistics taken from another table, for instance the unfiltered roll-up."""
    keys = ["stationID", "week", "hour"]
    names = {f"{f}_wh_{s}": f"{AGGREGATES[s]}({f})" for f in flows for s in stats}
    table = hours.groupBy(*keys).agg(*[F.expr(a).alias(n) for n, a in names.items()])
    joined = df.join(table, keys, "left")
    return joined.selectExpr(*df.columns, *[f"coalesce({n}, 0) AS {n}" for n in names])


def join_stations(df: DataFrame, stations: DataFrame) -> DataFrame:
    """Left join of the station dimension.

    No broadcast is forced: Spark sends the dimension to every task only while
    its measured size is under the session's threshold, and else joins by key.
    """
    return df.join(stations, "stationID", "left")


def opening_flag(df: DataFrame, stations: DataFrame) -> DataFrame:
    """Join the station dimension and replace its four times by ``is_run``."""
    times = ("start_time", "start_time2", "end_time", "end_time2")
    minute = F.col("minute") if "minute" in df.columns else F.lit(0)
    flag = cal.running_flag(
        cal.clock_label(F.col("hour"), minute),
        opens=[F.col(t) for t in times[:2]],
        closes=[F.col(t) for t in times[2:]],
    )
    return join_stations(df, stations).withColumn("is_run", flag).drop(*times)


def feature_columns(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    """All columns but the labels and the chosen ones, in table order."""
    left_out = set(exclude)
    return [c for c in df.columns if c not in left_out]
