"""Features from neighbouring slots, adjacent stations and longer history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.functions import rowstats as rs
from stationflow.operators.features import SLOT_SERIES, series_window
from stationflow.sources.schemas import FLOWS

OFFSETS = {"prev2": -2, "prev1": -1, "next1": 1, "next2": 2}
DAY = {
    "slot": "(PARTITION BY stationID, date ORDER BY hour, minute)",
    "hour": "(PARTITION BY stationID, date ORDER BY hour)",
}


def _at(column: str, offset: int, window: str) -> str:
    """The column ``offset`` rows later (earlier if negative)."""
    if offset == 0:
        return column
    return f"{'lead' if offset > 0 else 'lag'}({column}, {abs(offset)}) OVER {window}"


def neighbour_slots(
    df: DataFrame, grain: str = "slot", flows: Sequence[str] = FLOWS
) -> DataFrame:
    """One and two slots before and after, null beyond the day's ends."""
    return df.selectExpr(
        "*", *[f"{_at(f, k, DAY[grain])} AS {f}_{name}" for f in flows for name, k in OFFSETS.items()]
    )


def neighbour_history(
    df: DataFrame,
    past_days: int = 3,
    keys: Sequence[str] = SLOT_SERIES,
    flows: Sequence[str] = FLOWS,
) -> DataFrame:
    """Statistics over the past days for the current and each neighbour slot.

    ``df`` comes from :func:`neighbour_slots`; missing values count as 0.
    """
    window = series_window(keys)
    names = [f if not where else f"{f}_{where}" for f in flows for where in ("", *OFFSETS)]
    past = range(1, past_days + 1)
    lagged = df.selectExpr(
        "*", *[f"coalesce({_at(n, -k, window)}, 0) AS {n}_d{k}" for n in names for k in past]
    )
    groups = [
        rs.RowGroup(tuple(f"{n}_d{k}" for k in past), values=f"{n}_past{past_days}") for n in names
    ]
    return rs.with_row_stats(lagged, groups, keep=df.columns)


def slot_trend(df: DataFrame, flows: Sequence[str] = FLOWS) -> DataFrame:
    """Difference and ratio to the following slot, for the previous, current and next slot."""
    added = []
    for f in flows:
        for name, k in (("prev", -1), ("cur", 0), ("next", 1)):
            here, after = _at(f, k, DAY["slot"]), _at(f, k + 1, DAY["slot"])
            added.append(f"{after} - {here} AS {f}_diff_{name}")
            added.append(f"try_divide({after}, {here}) AS {f}_ratio_{name}")
    return df.selectExpr("*", *added)


def sliding_history(
    df: DataFrame, flows: Sequence[str] = FLOWS, minutes: Sequence[int] = (60, 120)
) -> DataFrame:
    """The flows of the last 60 and 120 minutes up to this slot, on the kept day before.

    Sums start at midnight; the first kept day gets 0.
    """
    window = series_window(SLOT_SERIES)
    sums = df.selectExpr(
        "*",
        *[
            f"sum({f}) OVER (PARTITION BY stationID, date ORDER BY hour, minute "
            f"ROWS BETWEEN {m // 10 - 1} PRECEDING AND CURRENT ROW) AS _{f}_{m}"
            for f in flows
            for m in minutes
        ],
    )
    return sums.selectExpr(
        *df.columns,
        *[
            f"coalesce({_at(f'_{f}_{m}', -1, window)}, 0) AS {f}_yesterday_{m}"
            for f in flows
            for m in minutes
        ],
    )


def linear_history(
    df: DataFrame,
    keys: Sequence[str] = SLOT_SERIES,
    flows: Sequence[str] = FLOWS,
) -> DataFrame:
    """Slope of all earlier days, and the residual of the latest of them.

    The line is fitted to the rows before the current one, so a row's own
    value never enters its features. 0 with fewer than two earlier days.
    """
    by = ", ".join(keys)
    past = f"(PARTITION BY {by} ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    latest = series_window(keys)
    fitted = df.selectExpr("*", "CAST(unix_date(date) AS DOUBLE) AS _x").selectExpr(
        "*",
        f"avg(_x) OVER {past} AS _x_mean",
        f"lag(_x) OVER {latest} AS _x_last",
        *[
            expression
            for f in flows
            for expression in (
                f"regr_slope({f}, _x) OVER {past} AS _{f}_slope",
                f"avg({f}) OVER {past} AS _{f}_mean",
                f"lag({f}) OVER {latest} AS _{f}_last",
            )
        ],
    )
    return fitted.selectExpr(
        *df.columns,
        *[
            expression
            for f in flows
            for expression in (
                f"coalesce(_{f}_slope, 0D) AS {f}_slope",
                f"coalesce(_{f}_last - (_{f}_mean + _{f}_slope * (_x_last - _x_mean)), 0D) "
                f"AS {f}_residual",
            )
        ],
    )


def line_edges(stations: DataFrame) -> DataFrame:
    """(stationID, neighborID, side) for the stations before and after on a line.

    One window over the stations: the frame of exactly one position further
    holds the neighbours of that side.
    """
    line = "(PARTITION BY lineID ORDER BY linePos RANGE BETWEEN {0} AND {0})"
    beside = stations.filter("lineID IS NOT NULL AND linePos IS NOT NULL").selectExpr(
        "stationID",
        f"collect_list(stationID) OVER {line.format('1 PRECEDING')} AS _before",
        f"collect_list(stationID) OVER {line.format('1 FOLLOWING')} AS _after",
    )
    return beside.selectExpr(
        "stationID",
        "inline(concat(transform(_before, x -> named_struct('neighborID', x, 'side', -1)), "
        "transform(_after, x -> named_struct('neighborID', x, 'side', 1))))",
    )


ADJACENT = {
    "before": "sum({f}) FILTER (WHERE side = -1)",
    "after": "sum({f}) FILTER (WHERE side = 1)",
    "min": "min({f}) FILTER (WHERE side <> 0)",
    "max": "max({f}) FILTER (WHERE side <> 0)",
    "mean": "avg({f}) FILTER (WHERE side <> 0)",
    "std": "stddev_samp({f}) FILTER (WHERE side <> 0)",
    "skew": "skewness({f}) FILTER (WHERE side <> 0)",
}


def adjacent_flow(
    df: DataFrame,
    edges: DataFrame,
    keys: Sequence[str],
    flows: Sequence[str] = FLOWS,
    salts: int = 8,
) -> DataFrame:
    """Flows of the two neighbours and statistics over all connected stations.

    Every station is also joined to itself (side 0), so one pass over the slots
    yields both a row and its neighbours' flows, with one aggregate after it.

    A hub that neighbours many stations would send all its slots, times all its
    edges, through one task. Edges are repeated per salt and slots carry one
    salt by day, which spreads a hub over ``salts`` tasks and keeps every pair.
    Sums are combined before the second exchange.
    """
    itself = edges.select("neighborID").distinct().selectExpr(
        "neighborID AS stationID", "neighborID", "0 AS side"
    )
    targets = (
        edges.select("stationID", "neighborID", "side")
        .unionByName(itself)
        .selectExpr("stationID AS _to", "neighborID AS stationID", "side", "explode(sequence(0, {})) AS _salt".format(salts - 1))
    )
    salted = df.selectExpr("*", f"pmod(unix_date(date), {salts}) AS _salt")
    # A station without edges has no row here and is its own only target.
    pairs = salted.join(targets, ["stationID", "_salt"], "left").selectExpr(
        "coalesce(_to, stationID) AS stationID",
        "coalesce(side, 0) AS side",
        *[c for c in df.columns if c != "stationID"],
    )
    own = [c for c in df.columns if c not in keys]
    stats = {f"{f}_adj_{n}": a.format(f=f) for f in flows for n, a in ADJACENT.items()}
    table = pairs.groupBy(*keys).agg(
        F.expr("max(side) FILTER (WHERE side = 0)").alias("_self"),
        *[F.expr(f"max({c}) FILTER (WHERE side = 0)").alias(f"_own_{c}") for c in own],
        *[F.expr(a).alias(n) for n, a in stats.items()],
    )
    columns = [c if c in keys else f"_own_{c} AS {c}" for c in df.columns]
    return table.filter("_self = 0").selectExpr(
        *columns, *[f"coalesce({n}, 0) AS {n}" for n in stats]
    )
