"""The same results in DuckDB SQL, written from the definitions, not from the plans."""

from __future__ import annotations

BASE = """
WITH tap AS (
  SELECT ts AS time, CAST(user_id // 10 AS INT) AS stationID,
         CAST(event_id % 13 AS INT) AS deviceID,
         CASE WHEN event_type IN ('view','click') THEN 1 ELSE 0 END AS status,
         CAST(ts AS DATE) AS date, CAST(hour(ts) AS INT) AS hour,
         CAST(minute(ts) // 10 * 10 AS INT) AS minute
  FROM events),
station AS (
  SELECT s AS stationID, CAST(s // 5 AS INT) AS lineID, CAST(s % 5 AS INT) AS linePos,
         '0' || (5 + s % 2) || ':30' AS start_time, '0' || (5 + s % 2) || ':40' AS start_time2,
         '22:50' AS end_time, '23:' || (s % 2) || '0' AS end_time2
  FROM (SELECT DISTINCT CAST(c_custkey // 100 AS INT) AS s FROM customer)),
edge AS (
  SELECT a.stationID, b.stationID AS neighborID, b.stationID - a.stationID AS side
  FROM station a JOIN station b ON a.lineID = b.lineID AND abs(a.stationID - b.stationID) = 1),
slot AS (
  SELECT stationID, date, hour, minute, CAST(sum(status) AS BIGINT) AS inNums,
         CAST(count(status) - sum(status) AS BIGINT) AS outNums
  FROM tap GROUP BY ALL),
alld AS (
  SELECT CAST(d AS DATE) AS date, CAST(day(d) AS INT) AS day, CAST(isodow(d) AS INT) AS week,
         CAST(isodow(d) >= 6 AS INT) AS weekend, CAST(day(d) - 1 AS INT) AS day_since_first
  FROM range(DATE '2024-01-01', DATE '2024-01-31', INTERVAL 1 DAY) t(d)),
clock AS (
  SELECT CAST(h AS INT) AS hour, CAST(m AS INT) AS minute
  FROM range(0, 24) a(h), range(0, 60, 10) b(m)),
grid AS (
  SELECT stationID, date, hour, minute, day, week, weekend FROM station, alld, clock),
slot_table AS (
  SELECT s.stationID, s.date, d.day, d.week, d.weekend, s.hour, s.minute, s.inNums, s.outNums,
         a.n AS nuni_deviceID_of_stationID, b.n AS nuni_deviceID_of_stationID_hour,
         c.n AS nuni_deviceID_of_stationID_hour_minute, d.day_since_first
  FROM slot s JOIN alld d USING (date)
  JOIN (SELECT stationID, date, count(DISTINCT deviceID) n FROM tap GROUP BY ALL) a USING (stationID, date)
  JOIN (SELECT stationID, date, hour, count(DISTINCT deviceID) n FROM tap GROUP BY ALL) b USING (stationID, date, hour)
  JOIN (SELECT stationID, date, hour, minute, count(DISTINCT deviceID) n FROM tap GROUP BY ALL) c USING (stationID, date, hour, minute)),
filled AS (
  SELECT g.*, coalesce(s.inNums, 0) AS inNums, coalesce(s.outNums, 0) AS outNums
  FROM grid g LEFT JOIN slot s USING (stationID, date, hour, minute)),
filled_hour AS (
  SELECT stationID, date, hour, day, week, weekend, CAST(sum(inNums) AS BIGINT) AS inNums,
         CAST(sum(outNums) AS BIGINT) AS outNums
  FROM filled GROUP BY ALL),
work AS (
  SELECT * REPLACE (CASE WHEN day = 30 THEN 0 ELSE inNums END AS inNums,
                    CASE WHEN day = 30 THEN 0 ELSE outNums END AS outNums)
  FROM filled WHERE weekend = 0 AND day <> 1),
work_hour AS (
  SELECT stationID, date, hour, day, week, weekend, CAST(sum(inNums) AS BIGINT) AS inNums,
         CAST(sum(outNums) AS BIGINT) AS outNums
  FROM work GROUP BY ALL),
wend AS (
  SELECT * REPLACE (CASE WHEN day = 28 THEN 0 ELSE inNums END AS inNums,
                    CASE WHEN day = 28 THEN 0 ELSE outNums END AS outNums)
  FROM filled WHERE weekend = 1),
template AS (
  SELECT stationID, hour, minute,
         TIMESTAMP '2024-01-30 00:00:00' + to_minutes(hour * 60 + minute) AS startTime,
         TIMESTAMP '2024-01-30 00:10:00' + to_minutes(hour * 60 + minute) AS endTime
  FROM station, clock),
template28 AS (
  SELECT stationID, hour, minute,
         TIMESTAMP '2024-01-28 00:00:00' + to_minutes(hour * 60 + minute) AS startTime,
         TIMESTAMP '2024-01-28 00:10:00' + to_minutes(hour * 60 + minute) AS endTime
  FROM station, clock),
refm AS (
  SELECT stationID, hour, minute, avg(inNums) AS inNums_mean, avg(outNums) AS outNums_mean
  FROM slot WHERE day(date) BETWEEN 22 AND 26 GROUP BY ALL),
refh AS (
  SELECT stationID, hour, avg(inNums) AS inNums_mean_hour, avg(outNums) AS outNums_mean_hour
  FROM slot WHERE day(date) BETWEEN 22 AND 26 GROUP BY ALL),
share AS (
  SELECT *, inNums_mean / (inNums_mean_hour + 0.001) AS inNums_share,
         outNums_mean / (outNums_mean_hour + 0.001) AS outNums_share
  FROM refm JOIN refh USING (stationID, hour)),
srch AS (
  SELECT stationID, hour, avg(inNums) AS inNums_source_hour, avg(outNums) AS outNums_source_hour
  FROM slot WHERE day(date) = 29 GROUP BY ALL),
src AS (
  SELECT stationID, hour, minute, inNums, outNums, inNums_source_hour, outNums_source_hour
  FROM slot JOIN srch USING (stationID, hour) WHERE day(date) = 29),
rule AS (
  SELECT t.*, coalesce(inNums_share * inNums_source_hour * 0.965, 0) AS inNums,
         coalesce(outNums_share * outNums_source_hour * 0.965, 0) AS outNums
  FROM template t LEFT JOIN share USING (stationID, hour, minute)
  LEFT JOIN src USING (stationID, hour, minute)),
naive AS (
  SELECT t.*, CAST(s.inNums AS DOUBLE) AS inNums, CAST(s.outNums AS DOUBLE) AS outNums
  FROM template t LEFT JOIN (SELECT * FROM slot WHERE day(date) = 29) s USING (stationID, hour, minute)),
naive0 AS (SELECT * REPLACE (coalesce(inNums, 0) AS inNums, coalesce(outNums, 0) AS outNums) FROM naive),
week0 AS (
  SELECT t.*, CAST(coalesce(s.inNums, 0) AS DOUBLE) AS inNums, CAST(coalesce(s.outNums, 0) AS DOUBLE) AS outNums
  FROM template t LEFT JOIN (SELECT * FROM slot WHERE day(date) = 23) s USING (stationID, hour, minute)),
ratio_means AS (
  SELECT stationID, hour,
         avg(CASE WHEN day = 13 THEN inNums END) i13, avg(CASE WHEN day = 14 THEN inNums END) i14,
         avg(CASE WHEN day = 20 THEN inNums END) i20, avg(CASE WHEN day = 21 THEN inNums END) i21,
         avg(CASE WHEN day = 13 THEN outNums END) o13, avg(CASE WHEN day = 14 THEN outNums END) o14,
         avg(CASE WHEN day = 20 THEN outNums END) o20, avg(CASE WHEN day = 21 THEN outNums END) o21
  FROM filled WHERE day IN (13, 14, 20, 21) GROUP BY ALL),
ratio AS (
  SELECT stationID, hour,
         CASE WHEN i13 = 0 OR i20 = 0 THEN 1 ELSE (i14 / i13 + i21 / i20) / 2 END AS inNums_ratio,
         CASE WHEN o13 = 0 OR o20 = 0 THEN 1 ELSE (o14 / o13 + o21 / o20) / 2 END AS outNums_ratio
  FROM ratio_means),
sunm AS (
  SELECT stationID, hour, minute, avg(inNums) AS im, avg(outNums) AS om
  FROM filled WHERE day IN (7, 14, 21) GROUP BY ALL),
sunh AS (
  SELECT stationID, hour, avg(inNums) AS ih, avg(outNums) AS oh
  FROM filled WHERE day IN (7, 14, 21) GROUP BY ALL),
sath AS (
  SELECT stationID, hour, avg(inNums) AS si, avg(outNums) AS so FROM filled WHERE day = 27 GROUP BY ALL),
rule28 AS (
  SELECT t.*, si * inNums_ratio * (im / (ih + 0.001)) AS inNums,
         so * outNums_ratio * (om / (oh + 0.001)) AS outNums
  FROM template28 t JOIN sunm USING (stationID, hour, minute) JOIN sunh USING (stationID, hour)
  JOIN sath USING (stationID, hour) JOIN ratio USING (stationID, hour)),
trend AS (
  SELECT stationID, hour,
         greatest(0, avg(inNums) + regr_slope(inNums, CAST(day AS DOUBLE)) * (30 - avg(day))) AS inNums,
         greatest(0, avg(outNums) + regr_slope(outNums, CAST(day AS DOUBLE)) * (30 - avg(day))) AS outNums
  FROM work_hour WHERE day <> 30 GROUP BY ALL)
"""

FLOWS = ("inNums", "outNums")
SLOT_KEYS = "stationID, date, hour, minute"
HOUR_KEYS = "stationID, date, hour"
FLOW_COLS = "inNums, outNums"
TEMPLATE_KEYS = "stationID, startTime, endTime"
DEVICES = (
    "nuni_deviceID_of_stationID, nuni_deviceID_of_stationID_hour, "
    "nuni_deviceID_of_stationID_hour_minute"
)


def r6(expression: str, name: str) -> str:
    return f"round(CAST({expression} AS DOUBLE), 6) + 0.0 AS {name}"


def flows6(a: str = "inNums", b: str = "outNums") -> str:
    return f"{r6(a, 'inNums')}, {r6(b, 'outNums')}"


def each(make) -> str:
    """One SQL fragment per flow."""
    return ", ".join(make(f) for f in FLOWS)


def lags(flow: str, ks, name: str, over: str) -> str:
    return ", ".join(f"coalesce(lag({flow}, {k}) OVER {over}, 0) AS {name.format(f=flow, k=k)}" for k in ks)


SERIES = "(PARTITION BY stationID, hour, minute ORDER BY date)"
HOUR_SERIES = "(PARTITION BY stationID, hour ORDER BY date)"
IN_DAY = "(PARTITION BY stationID, date ORDER BY hour, minute)"
HOUR_IN_DAY = "(PARTITION BY stationID, date ORDER BY hour)"


def skew(xs: str) -> str:
    """Population skewness of a list from its moments; 0 for a constant list."""
    m2 = f"list_avg(list_transform({xs}, lambda x: (x - list_avg({xs})) ** 2))"
    m3 = f"list_avg(list_transform({xs}, lambda x: (x - list_avg({xs})) ** 3))"
    return f"CASE WHEN list_min({xs}) = list_max({xs}) THEN 0 ELSE {m3} / ({m2} ** 1.5) END"


def value_stats(xs: str, n: int, prefix: str) -> list[str]:
    return [
        f"CAST(list_sum({xs}) AS BIGINT) AS {prefix}_sum",
        r6(f"list_median({xs})", f"{prefix}_median"),
        r6(f"list_stddev_pop({xs})", f"{prefix}_std"),
        f"list_min({xs}) AS {prefix}_min",
        f"list_max({xs}) AS {prefix}_max",
        r6(f"({xs}[{n}] - {xs}[1]) / {n - 1}", f"{prefix}_mean_change"),
    ]


def share_stats(xs: str, prefix: str, guard: float) -> list[str]:
    shares = f"list_transform({xs}, lambda x: x / (list_sum({xs}) + CAST({guard} AS DOUBLE)))"
    return [
        r6(f"list_median({shares})", f"{prefix}_median"),
        r6(f"list_stddev_pop({shares})", f"{prefix}_std"),
        r6(f"list_min({shares})", f"{prefix}_min"),
        r6(f"list_max({shares})", f"{prefix}_max"),
        r6(skew(xs), f"{prefix}_skew"),
    ]


def lag_list(flow: str, n: int) -> str:
    return "[" + ", ".join(f"{flow}_last_{k}" for k in range(1, n + 1)) + "]"


def lagged(table: str, over: str, ks=(1, 2, 3, 4, 5)) -> str:
    return f"SELECT *, {each(lambda f: lags(f, ks, '{f}_last_{k}', over))} FROM {table}"


def changes() -> list[str]:
    cols = []
    for f in FLOWS:
        a, b, c = (f"{f}_last_{k}" for k in (1, 2, 3))
        cols += [
            r6(f"({a} + {b} + {c}) / 3.0", f"{f}_mean_3"),
            f"{a} - {b} AS {f}_diff_1",
            f"{b} - {c} AS {f}_diff_2",
            f"{a} - 2 * {b} + {c} AS {f}_diff_diff",
            r6(f"{a} / ({b} + CAST(0.001 AS DOUBLE))", f"{f}_divide_1"),
            r6(f"{b} / ({c} + CAST(0.001 AS DOUBLE))", f"{f}_divide_2"),
        ]
    return cols


def past_stats(values: bool = True, shares: bool = True) -> list[str]:
    cols = []
    for f in FLOWS:
        for n in (3, 5):
            if values:
                cols += value_stats(lag_list(f, n), n, f"district_{f}_last{n}")
            if shares:
                cols += share_stats(lag_list(f, n), f"district_percent_{f}_last{n}", 0.001)
    return cols


def group_stats(grain: str, target: int, stats=("max", "min", "mean", "std"), flows=FLOWS) -> list[str]:
    keys = "stationID, week, hour, minute" if grain == "whm" else "stationID, week, hour"
    cols = []
    for f in flows:
        x = f"CASE WHEN day <> {target} THEN {f} END"
        over = f"OVER (PARTITION BY {keys})"
        made = {
            "max": f"coalesce(max({x}) {over}, 0) AS {f}_{grain}_max",
            "min": f"coalesce(min({x}) {over}, 0) AS {f}_{grain}_min",
            "mean": r6(f"coalesce(avg({x}) {over}, 0)", f"{f}_{grain}_mean"),
            "std": r6(f"coalesce(stddev_samp({x}) {over}, 0)", f"{f}_{grain}_std"),
        }
        cols += [made[s] for s in stats]
    return cols


def rollup_stats(table: str) -> str:
    """Grouped hour statistics of an unfiltered roll-up."""
    return f"""SELECT stationID, isodow(date) AS week, hour, {each(lambda f:
        f'CAST(max({f}) AS BIGINT) AS {f}_max, CAST(min({f}) AS BIGINT) AS {f}_min, avg({f}) AS {f}_mean, stddev_samp({f}) AS {f}_std')}
        FROM {table} GROUP BY ALL"""


def rollup_columns() -> str:
    return each(
        lambda f: f"coalesce(r.{f}_max, 0) AS {f}_wh_max, coalesce(r.{f}_min, 0) AS {f}_wh_min, "
        + r6(f"coalesce(r.{f}_mean, 0)", f"{f}_wh_mean") + ", " + r6(f"coalesce(r.{f}_std, 0)", f"{f}_wh_std")
    )


IS_RUN = """CASE WHEN {t} < least(start_time, start_time2) OR {t} > greatest(end_time, end_time2)
  THEN 0 ELSE 1 END AS is_run"""
LABEL = "lpad(CAST(hour AS VARCHAR), 2, '0') || ':' || lpad(CAST(minute AS VARCHAR), 2, '0')"
HOUR_LABEL = "lpad(CAST(hour AS VARCHAR), 2, '0') || ':00'"
START = "CAST(date AS TIMESTAMP) + to_minutes(hour * 60 + minute)"
FORECAST = f"SELECT {TEMPLATE_KEYS}, {flows6()} FROM "
REST_AND_SOURCE = "(1, 6, 7, 13, 14, 20, 21, 27, 28, 29)"
SPECIAL = "(2, 7, 11)"
PEAK = "(7, 8, 9, 17, 18)"


def series(table: str, where: str, keys: str) -> str:
    joined = lambda x: f"string_agg(CAST({x} AS VARCHAR), ',' ORDER BY date)"
    return f"""SELECT {keys}, {joined('day(date)')} AS days, {joined('inNums')} AS in_series,
      {joined('outNums')} AS out_series
      FROM (SELECT {keys}, date, CAST(sum(inNums) AS BIGINT) AS inNums, CAST(sum(outNums) AS BIGINT) AS outNums
            FROM {table} WHERE {where} GROUP BY {keys}, date) GROUP BY {keys}"""


def neighbours(table: str, over: str, cast_zero: bool = False) -> str:
    cols = []
    for f in FLOWS:
        for name, k in (("prev2", 2), ("prev1", 1)):
            cols.append(f"lag({f}, {k}) OVER {over} AS {f}_{name}")
        for name, k in (("next1", 1), ("next2", 2)):
            cols.append(f"lead({f}, {k}) OVER {over} AS {f}_{name}")
    return f"SELECT *, {', '.join(cols)} FROM {table}"


def neighbour_history(table: str, day_over: str, over: str, keys: str, n: int) -> str:
    names = [f + w for f in FLOWS for w in ("", "_prev2", "_prev1", "_next1", "_next2")]
    lag_cols = ", ".join(
        f"coalesce(lag({x}, {k}) OVER {over}, 0) AS {x}_d{k}" for x in names for k in range(1, n + 1)
    )
    cols = []
    for x in names:
        xs = "[" + ", ".join(f"{x}_d{k}" for k in range(1, n + 1)) + "]"
        cols += value_stats(xs, n, f"{x}_past{n}")
    return f"""SELECT {keys}, {', '.join(cols)} FROM
      (SELECT *, {lag_cols} FROM ({neighbours(table, day_over)}))"""


def adjacent(table: str, keys: str, extra: str) -> str:
    cols = []
    for f in FLOWS:
        m = f"(list_avg({f}_l))"
        cols += [
            f"CAST(coalesce({f}_before, 0) AS BIGINT) AS {f}_adj_before",
            f"CAST(coalesce({f}_after, 0) AS BIGINT) AS {f}_adj_after",
            f"coalesce(list_min({f}_l), 0) AS {f}_adj_min",
            f"coalesce(list_max({f}_l), 0) AS {f}_adj_max",
            r6(f"coalesce({m}, 0)", f"{f}_adj_mean"),
            r6(f"coalesce(list_stddev_samp({f}_l), 0)", f"{f}_adj_std"),
            r6(f"CASE WHEN {f}_l IS NULL THEN 0 ELSE {skew(f'{f}_l')} END", f"{f}_adj_skew"),
        ]
    return f"""SELECT {keys}, {', '.join(cols)} FROM {table} LEFT JOIN
      (SELECT e.stationID, t.date, {extra},
        {each(lambda f: f"list(t.{f}) AS {f}_l, sum(CASE WHEN side = -1 THEN t.{f} END) AS {f}_before, sum(CASE WHEN side = 1 THEN t.{f} END) AS {f}_after")}
       FROM edge e JOIN {table} t ON t.stationID = e.neighborID GROUP BY ALL)
      USING ({keys})"""


def weekday_history(table: str, keys: str, part: str) -> str:
    over = f"(PARTITION BY {part}, week ORDER BY date)"
    cols = []
    for f in FLOWS:
        xs = f"[{f}_weekday_back_1, {f}_weekday_back_2, {f}_weekday_back_3]"
        cols += [f"{f}_weekday_back_{k}" for k in (1, 2, 3)]
        cols += [
            r6(f"list_avg({xs})", f"{f}_weekday_mean"),
            r6(f"list_median({xs})", f"{f}_weekday_median"),
            r6(f"list_stddev_pop({xs})", f"{f}_weekday_std"),
            r6(f"({xs}[3] - {xs}[1]) / 2", f"{f}_weekday_mean_change"),
        ]
    return f"""SELECT {keys}, {', '.join(cols)} FROM (
      SELECT *, {each(lambda f: lags(f, (1, 2, 3), '{f}_weekday_back_{k}', over))} FROM {table})"""


def same_weekday() -> str:
    cols = []
    for f in FLOWS:
        cols.append(f"{f}_b7 AS {f}_last_week")
        for w in (1, 2, 3):
            xs = "[" + ", ".join([f"{f}_b{7 * k}" for k in range(1, w + 1)] + [f]) + "]"
            cols.append(r6(f"list_avg({xs})", f"{f}_w{w}_mean"))
            if w > 1:
                cols += [
                    r6(f"list_median({xs})", f"{f}_w{w}_median"),
                    r6(f"list_stddev_pop({xs})", f"{f}_w{w}_std"),
                    r6(f"({xs}[{w + 1}] - {xs}[1]) / {w}", f"{f}_w{w}_mean_change"),
                ]
    return f"""SELECT {SLOT_KEYS}, {', '.join(cols)} FROM (
      SELECT *, {each(lambda f: lags(f, (7, 14, 21), '{f}_b{k}', SERIES))} FROM filled)"""


def past_n() -> str:
    cols = []
    for f in FLOWS:
        for n in (3, 6, 13, 20, 27):
            xs = "[" + ", ".join([f"{f}_before_{k}" for k in range(1, n + 1)] + [f]) + "]"
            cols += value_stats(xs, n + 1, f"district_{f}_last{n}")
            cols += share_stats(xs, f"district_percent_{f}_last{n}", 1e-5)
    return f"""SELECT {HOUR_KEYS}, {', '.join(cols)} FROM (
      SELECT *, {each(lambda f: lags(f, range(1, 28), '{f}_before_{k}', HOUR_SERIES))} FROM filled_hour)"""


def linear_history() -> str:
    """Least squares from sums over the rows before, guarded for fewer than two days."""
    cols, sums = [], []
    for f in FLOWS:
        slope = f"(n * {f}_xy - sx * {f}_y) / (n * sxx - sx * sx)"
        line = f"({f}_y / n + ({slope}) * (lx - sx / n))"
        cols += [
            r6(f"CASE WHEN n >= 2 THEN {slope} ELSE 0 END", f"{f}_slope"),
            r6(f"CASE WHEN n >= 2 THEN {f}_l - {line} ELSE 0 END", f"{f}_residual"),
        ]
        sums += [
            f"CAST(sum({f}) OVER p AS DOUBLE) AS {f}_y",
            f"CAST(sum({f} * day) OVER p AS DOUBLE) AS {f}_xy",
            f"lag({f}) OVER s AS {f}_l",
        ]
    return f"""SELECT {SLOT_KEYS}, {', '.join(cols)} FROM (
      SELECT *, {', '.join(sums)}, count(*) OVER p AS n, CAST(sum(day) OVER p AS DOUBLE) AS sx,
        CAST(sum(day * day) OVER p AS DOUBLE) AS sxx, lag(day) OVER s AS lx
      FROM work WINDOW s AS (PARTITION BY stationID, hour, minute ORDER BY date),
        p AS (PARTITION BY stationID, hour, minute ORDER BY date
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""


def slot_trend() -> str:
    cols = []
    for f in FLOWS:
        at = {-1: f"lag({f}) OVER d", 0: f, 1: f"lead({f}) OVER d", 2: f"lead({f}, 2) OVER d"}
        for name, k in (("prev", -1), ("cur", 0), ("next", 1)):
            cols.append(f"{at[k + 1]} - {at[k]} AS {f}_diff_{name}")
            cols.append(r6(f"({at[k + 1]}) / nullif({at[k]}, 0)", f"{f}_ratio_{name}"))
    return f"""SELECT {SLOT_KEYS}, {', '.join(cols)} FROM filled
      WINDOW d AS (PARTITION BY stationID, date ORDER BY hour, minute)"""


def minute_matrix(where: str = "true") -> str:
    first = ["stationID", "date", "hour", "minute", "inNums", "outNums", "day", "week", "weekend", "day_since_first"]
    cols = first + [f"{f}_last_{k}" for k in (1, 2, 3, 4, 5) for f in FLOWS]
    cols += changes() + past_stats() + group_stats("whm", 30) + group_stats("wh", 30)
    return f"""SELECT m.*, lineID, linePos, {IS_RUN.format(t=LABEL)} FROM (
      SELECT {', '.join(cols)} FROM ({lagged('(SELECT *, day - 1 AS day_since_first FROM work)', SERIES)})) m
      LEFT JOIN station USING (stationID) WHERE day NOT IN (2, 3, 4, 5, 8) AND {where}"""


def hour_matrix() -> str:
    first = ["stationID", "date", "hour", "inNums", "outNums",
             "round(nuni_deviceID_of_stationID, 6) AS nuni_deviceID_of_stationID",
             "round(nuni_deviceID_of_stationID_hour, 6) AS nuni_deviceID_of_stationID_hour",
             "day", "week", "weekend", "CAST(day - 1 AS INT) AS day_since_first"]
    cols = first + [f"{f}_last_{k}" for k in (1, 2, 3, 4, 5) for f in FLOWS] + changes() + past_stats()
    base = """(SELECT w.*, coalesce(d.a, 0.0) AS nuni_deviceID_of_stationID,
        coalesce(d.b, 0.0) AS nuni_deviceID_of_stationID_hour FROM work_hour w LEFT JOIN
        (SELECT stationID, date, hour, avg(nuni_deviceID_of_stationID) a, avg(nuni_deviceID_of_stationID_hour) b
         FROM slot_table WHERE day <> 30 GROUP BY ALL) d USING (stationID, date, hour))"""
    rollup = "(SELECT stationID, date, hour, sum(inNums) AS inNums, sum(outNums) AS outNums FROM slot WHERE day(date) <> 30 GROUP BY ALL)"
    return f"""SELECT m.*, {rollup_columns()}, lineID, linePos,
      {IS_RUN.format(t=HOUR_LABEL)}
      FROM (SELECT {', '.join(cols)} FROM ({lagged(base, HOUR_SERIES)})) m
      LEFT JOIN ({rollup_stats(rollup)}) r USING (stationID, week, hour)
      LEFT JOIN station USING (stationID) WHERE day NOT IN (2, 3, 4, 5, 8)"""


def day_before_matrix(table: str, target: int, first: str) -> str:
    short = ("max", "min", "mean")
    cols = ["stationID", "date", "hour", "minute", "inNums", "outNums", "day", "week", "weekend",
            "day - 1 AS day_since_first"]
    cols += [f"coalesce(lag({f}) OVER {SERIES}, {first.format(f=f)}) AS {f}_last" for f in FLOWS]
    cols += group_stats("whm", target, short)
    cols += group_stats("wh", target, short, FLOWS[:1]) + group_stats("wh", target, ("mean",), FLOWS[1:])
    return f"SELECT {', '.join(cols)} FROM {table}"


def statements() -> dict[str, str]:
    """Statement bodies, to be put after :data:`BASE`."""
    q: dict[str, str] = {}
    q["S1_read_tap_files"] = "SELECT time, stationID, deviceID, status FROM tap"
    q["S2_scan_by_extension"] = "SELECT date, count(*) AS taps FROM tap GROUP BY date"
    q["S3_read_slot_table"] = f"SELECT {SLOT_KEYS}, {FLOW_COLS} FROM slot"
    q["S4_read_in_out_tables"] = f"""SELECT stationID, {START} AS time, 'in' AS flow, inNums AS n FROM slot WHERE inNums > 0
      UNION ALL SELECT stationID, {START}, 'out', outNums FROM slot WHERE outNums > 0"""
    q["S5_read_template"] = f"SELECT {TEMPLATE_KEYS} FROM template"
    q["S6_read_stations"] = "SELECT * FROM station"
    q["S7_read_forecast"] = FORECAST + "rule"
    q["S8_write_slot_table"] = f"SELECT {SLOT_KEYS}, {FLOW_COLS}, {DEVICES} FROM slot_table"
    q["S9_write_forecast"] = FORECAST + "naive0"
    q["S10_write_hour_forecast"] = f"SELECT stationID, hour, {flows6()} FROM trend"

    q["P1_base_time_fields"] = """SELECT time, stationID, CAST(day(time) AS INT) AS day,
      CAST(isodow(time) AS INT) AS week, CAST(isodow(time) >= 6 AS INT) AS weekend, hour, minute FROM tap"""
    q["P2_timestamp_parts"] = """SELECT stationID, date_trunc('second', time) AS time, CAST(day(time) AS INT) AS days,
      CAST(hour(time) AS INT) AS hours, CAST(minute(time) AS INT) AS minutes,
      CAST(isodow(time) - 1 AS INT) AS wkday FROM tap"""
    q["P3_calendar_fill"] = f"SELECT {HOUR_KEYS}, week, weekend FROM filled_hour"
    q["P4_days_since_first"] = f"SELECT {SLOT_KEYS}, CAST(day(date) - 1 AS INT) AS day_since_first FROM slot"
    q["P5_day_in_list"] = f"SELECT * FROM slot WHERE day(date) IN {REST_AND_SOURCE}"
    q["P6_drop_days"] = "SELECT * FROM slot WHERE isodow(date) < 6 AND day(date) <> 1"
    q["P7_day_range"] = "SELECT * FROM slot WHERE day(date) BETWEEN 22 AND 26"
    q["P8_single_day"] = "SELECT * FROM slot WHERE day(date) = 29"
    q["P9_drop_warm_up"] = f"""SELECT {SLOT_KEYS}, {FLOW_COLS} FROM
      (SELECT *, dense_rank() OVER (ORDER BY date) AS k FROM work) WHERE k > 5"""
    q["P10_special_stations"] = f"""SELECT *, CASE WHEN stationID IN {SPECIAL} THEN 'special' ELSE 'ordinary' END AS part
      FROM slot"""
    q["P11_peak_hours"] = "SELECT * FROM slot WHERE hour IN (7, 8, 9, 17, 18)"
    q["P12_day_reindex"] = f"""SELECT {SLOT_KEYS}, CAST(i AS INT) AS day_index, date AS day_back
      FROM slot JOIN (SELECT date, dense_rank() OVER (ORDER BY date) AS i FROM alld
                      WHERE weekend = 0 AND day <> 1) USING (date)"""
    q["P13_clock_label"] = f"SELECT {SLOT_KEYS}, {LABEL} AS label FROM slot"
    q["P14_opening_flag"] = f"SELECT {SLOT_KEYS}, {IS_RUN.format(t=LABEL)} FROM filled LEFT JOIN station USING (stationID)"
    q["P15_rename_drop_select"] = "SELECT stationID, date, hour, inNums AS inNums_last, outNums AS outNums_last FROM slot"
    q["P16_feature_columns"] = """SELECT * EXCLUDE (weekend, inNums, outNums, nuni_deviceID_of_stationID,
      nuni_deviceID_of_stationID_hour) FROM slot_table"""
    q["P17_fill_nulls"] = f"SELECT {TEMPLATE_KEYS}, {flows6('coalesce(inNums, 0)', 'coalesce(outNums, 1)')} FROM naive"
    q["P18_replace_infinite_ratio"] = f"""SELECT {SLOT_KEYS},
      {r6('CASE WHEN outNums = 0 THEN 1 ELSE inNums / outNums END', 'in_out_ratio')} FROM slot"""

    q["J1_slot_grid"] = "SELECT * FROM filled"
    q["J2_hour_grid"] = f"""SELECT {HOUR_KEYS}, inNums, outNums,
      {r6('coalesce(a, 0)', 'nuni_deviceID_of_stationID')}, {r6('coalesce(b, 0)', 'nuni_deviceID_of_stationID_hour')}
      FROM filled_hour LEFT JOIN (SELECT {HOUR_KEYS}, avg(nuni_deviceID_of_stationID) AS a,
        avg(nuni_deviceID_of_stationID_hour) AS b FROM slot_table GROUP BY ALL) USING ({HOUR_KEYS})"""
    q["J3_grid"] = f"SELECT {SLOT_KEYS} FROM grid"
    q["J4_combine_in_out"] = f"SELECT stationID, {START} AS time, inNums, outNums FROM slot WHERE inNums > 0 AND outNums > 0"
    q["J5_station_join"] = "SELECT * FROM slot LEFT JOIN station USING (stationID)"
    q["J6_attach_aggregate"] = f"""SELECT {SLOT_KEYS}, {r6('a', 'inNums_whm_mean')}, {r6('b', 'outNums_whm_mean')}
      FROM slot JOIN (SELECT stationID, isodow(date) AS w, hour, minute, avg(inNums) AS a, avg(outNums) AS b
                      FROM slot GROUP BY ALL) m USING (stationID, hour, minute) WHERE m.w = isodow(date)"""
    earlier = lambda place: each(
        lambda f: f"CAST(coalesce(sum({f}) OVER (PARTITION BY stationID, hour, minute ORDER BY {place} "
        f"RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS {f}_last_1"
    )
    q["J7_shifted_day"] = f"SELECT {SLOT_KEYS}, {earlier('day')} FROM filled"
    q["J7_shifted_kept_day"] = f"""SELECT {SLOT_KEYS}, {earlier('place')} FROM slot JOIN
      (SELECT date, row_number() OVER (ORDER BY date) AS place FROM alld WHERE weekend = 0 AND day <> 1) USING (date)"""
    q["J8_days_side_by_side"] = """SELECT stationID, hour, minute, a.inNums AS inNums_12, a.outNums AS outNums_12,
      b.inNums AS inNums_13, b.outNums AS outNums_13, c.inNums AS inNums_19, c.outNums AS outNums_19,
      d.inNums AS inNums_20, d.outNums AS outNums_20
      FROM (SELECT * FROM slot WHERE day(date) = 13) a
      LEFT JOIN (SELECT * FROM slot WHERE day(date) = 14) b USING (stationID, hour, minute)
      LEFT JOIN (SELECT * FROM slot WHERE day(date) = 20) c USING (stationID, hour, minute)
      LEFT JOIN (SELECT * FROM slot WHERE day(date) = 21) d USING (stationID, hour, minute)"""
    q["J9_template_join"] = f"""SELECT {TEMPLATE_KEYS}, {r6('coalesce(inNums_share, 0)', 'inNums_share')},
      {r6('coalesce(outNums_share, 0)', 'outNums_share')} FROM template LEFT JOIN share USING (stationID, hour, minute)"""
    q["J10_forecast_join"] = f"""SELECT {TEMPLATE_KEYS}, {r6('a.inNums', 'inNums_0')}, {r6('a.outNums', 'outNums_0')},
      {r6('b.inNums', 'inNums_1')}, {r6('b.outNums', 'outNums_1')}
      FROM rule a LEFT JOIN naive b USING ({TEMPLATE_KEYS})"""
    q["J11_attach_by_key"] = FORECAST + "naive0"

    q["A1_slot_flow"] = f"SELECT {SLOT_KEYS}, week, weekend, day, {FLOW_COLS} FROM slot_table"
    q["A2_distinct_devices"] = f"SELECT {SLOT_KEYS}, {DEVICES} FROM slot_table"
    q["A3_hour_rollup"] = f"""SELECT {HOUR_KEYS}, CAST(sum(inNums) AS BIGINT) AS inNums, CAST(sum(outNums) AS BIGINT) AS outNums,
      {r6('avg(nuni_deviceID_of_stationID)', 'nuni_deviceID_of_stationID')},
      {r6('avg(nuni_deviceID_of_stationID_hour)', 'nuni_deviceID_of_stationID_hour')} FROM slot_table GROUP BY {HOUR_KEYS}"""
    q["A4_slot_statistics"] = f"SELECT {SLOT_KEYS}, {', '.join(group_stats('whm', 30))} FROM work"
    q["A5_hour_statistics"] = f"SELECT {SLOT_KEYS}, {', '.join(group_stats('wh', 30))} FROM work"
    q["A5_hour_statistics_of_rollup"] = f"""SELECT stationID, date, hour, {rollup_columns()} FROM work_hour
      LEFT JOIN ({rollup_stats('(SELECT stationID, date, hour, sum(inNums) AS inNums, sum(outNums) AS outNums FROM slot WHERE day(date) <> 30 GROUP BY ALL)')}) r
      USING (stationID, week, hour)"""
    q["A6_slot_mean"] = f"SELECT stationID, hour, minute, {r6('inNums_mean', 'inNums_mean')}, {r6('outNums_mean', 'outNums_mean')} FROM refm"
    q["A7_hour_mean"] = f"SELECT stationID, hour, {r6('inNums_mean_hour', 'inNums_mean_hour')}, {r6('outNums_mean_hour', 'outNums_mean_hour')} FROM refh"
    q["A8_slot_share"] = "SELECT stationID, hour, minute, " + each(
        lambda f: ", ".join(r6(f"{f}_{s}", f"{f}_{s}") for s in ("mean", "mean_hour", "share"))
    ) + " FROM share"
    q["A9_source_hour_mean"] = f"""SELECT stationID, hour, minute, {FLOW_COLS}, {r6('inNums_source_hour', 'inNums_source_hour')},
      {r6('outNums_source_hour', 'outNums_source_hour')} FROM src"""
    q["A10_weekend_ratio"] = f"SELECT stationID, hour, {r6('inNums_ratio', 'inNums_ratio')}, {r6('outNums_ratio', 'outNums_ratio')} FROM ratio"
    q["A11_distinct_values"] = f"SELECT DISTINCT {LABEL} AS label FROM slot ORDER BY label"
    q["A12_slot_series"] = series("filled", f"day IN {REST_AND_SOURCE}", "stationID, hour, minute")
    q["A12_hour_series"] = series("slot", "isodow(date) >= 6", "stationID, hour")
    q["A13_plain_aggregates"] = f"""SELECT stationID, CAST(sum(inNums) AS BIGINT) AS sum_in, {r6('avg(inNums)', 'mean_in')},
      max(inNums) AS max_in, min(inNums) AS min_in, {r6('stddev_samp(inNums)', 'std_in')}, count(inNums) AS count_in,
      count(DISTINCT inNums) AS nunique_in FROM slot GROUP BY stationID"""

    q["W1_lags"] = f"SELECT {SLOT_KEYS}, {FLOW_COLS}, COLUMNS('_last_') FROM ({lagged('work', SERIES)})"
    q["W1_hour_lags"] = f"SELECT {HOUR_KEYS}, {FLOW_COLS}, COLUMNS('_last_') FROM ({lagged('work_hour', HOUR_SERIES)})"
    q["W2_previous_kept_day_self"] = f"SELECT {SLOT_KEYS}, {each(lambda f: f'coalesce(lag({f}) OVER {SERIES}, {f}) AS {f}_last')} FROM wend"
    q["W3_previous_kept_day_zero"] = f"SELECT {SLOT_KEYS}, {each(lambda f: f'coalesce(lag({f}) OVER {SERIES}, 0) AS {f}_last')} FROM work"
    q["W4_changes"] = f"SELECT {SLOT_KEYS}, {', '.join(changes())} FROM ({lagged('work', SERIES)})"
    q["W5_past_values"] = f"SELECT {SLOT_KEYS}, {', '.join(past_stats(shares=False))} FROM ({lagged('work', SERIES)})"
    q["W6_past_shares"] = f"SELECT {SLOT_KEYS}, {', '.join(past_stats(values=False))} FROM ({lagged('work', SERIES)})"
    q["W7_past_n"] = past_n()
    q["W8_same_weekday"] = same_weekday()
    q["W9_group_shift"] = f"""SELECT {SLOT_KEYS}, lag(inNums, 2) OVER (PARTITION BY stationID ORDER BY date, hour, minute)
      AS inNums_shift_2 FROM slot"""

    q["O1_sorted_series"] = f"SELECT * FROM slot WHERE day(date) IN {REST_AND_SOURCE} ORDER BY stationID, hour, minute, date"
    q["O2_union_days"] = "SELECT * FROM slot"
    q["O3_append_template"] = f"""SELECT * FROM slot_table WHERE day <> 30
      UNION ALL SELECT stationID, DATE '2024-01-30', 30, 2, 0, hour, minute, 0, 0, 0, 0, 0, 29 FROM template"""
    q["O4_rejoin_stations"] = f"""SELECT stationID, hour, {flows6()} FROM trend WHERE stationID NOT IN {SPECIAL}
      UNION ALL SELECT stationID, hour, CAST(inNums AS DOUBLE), CAST(outNums AS DOUBLE) FROM work_hour
      WHERE day = 30 AND stationID IN {SPECIAL}"""

    two = lambda a, b: f"{a} x LEFT JOIN {b} y USING ({TEMPLATE_KEYS})"
    q["F1_weekday_rule"] = FORECAST + "rule"
    q["F2_weekend_rule"] = FORECAST + "rule28"
    mix = lambda a, b: flows6(f"x.inNums * {a} + y.inNums * {b}", f"x.outNums * {a} + y.outNums * {b}")
    q["F3_blend"] = f"SELECT {TEMPLATE_KEYS}, {mix(0.6, 0.4)} FROM {two('naive0', 'rule')}"
    q["F3_blend_unmatched"] = f"""SELECT {TEMPLATE_KEYS}, {mix(0.5, 0.5)}
      FROM {two('naive0', f'(SELECT * FROM rule WHERE stationID NOT IN {SPECIAL})')}"""
    q["F4_three_way_blend"] = f"""SELECT {TEMPLATE_KEYS},
      {flows6('x.inNums * 0.25 + y.inNums * 0.25 + z.inNums * 0.5', 'x.outNums * 0.25 + y.outNums * 0.25 + z.outNums * 0.5')}
      FROM {two('rule', 'naive0')} LEFT JOIN week0 z USING ({TEMPLATE_KEYS})"""
    q["F5_night_override"] = f"""SELECT {TEMPLATE_KEYS},
      {flows6('CASE WHEN r.hour <= 4 THEN s.inNums ELSE r.inNums END', 'CASE WHEN r.hour <= 4 THEN s.outNums ELSE r.outNums END')}
      FROM rule28 r LEFT JOIN (SELECT * FROM slot WHERE day(date) = 21) s USING (stationID, hour, minute)"""
    scale = "CAST(0.965 AS DOUBLE) / CAST(1.02 AS DOUBLE)"
    q["F6_rescale"] = f"""SELECT {TEMPLATE_KEYS}, {flows6(f'inNums * ({scale})',
      f'outNums * ({scale}) * CASE WHEN stationID = 7 AND hour BETWEEN 6 AND 23 THEN 1.05 ELSE 1 END')} FROM rule"""
    q["F7_closed_stations"] = f"""SELECT {TEMPLATE_KEYS}, {flows6('CASE WHEN stationID = 4 THEN 0 ELSE inNums END',
      'CASE WHEN stationID = 4 THEN 0 ELSE outNums END')} FROM rule"""
    q["F8_clip_negative"] = f"""SELECT {TEMPLATE_KEYS}, {flows6('greatest(0, 2 * x.inNums - y.inNums)',
      'greatest(0, 2 * x.outNums - y.outNums)')} FROM {two('naive0', 'week0')}"""
    q["F9_hours_to_slots"] = f"""SELECT {TEMPLATE_KEYS}, {flows6('coalesce(h.inNums / 6 * inNums_share, 0)',
      'coalesce(h.outNums / 6 * outNums_share, 0)')}
      FROM template LEFT JOIN share USING (stationID, hour, minute) LEFT JOIN trend h USING (stationID, hour)"""
    q["F10_time_split"] = f"""SELECT {SLOT_KEYS}, {FLOW_COLS},
      CASE WHEN day < 29 THEN 'train' WHEN day = 29 THEN 'valid' ELSE 'test' END AS split FROM work"""
    q["F12_trend"] = f"SELECT stationID, hour, {flows6()} FROM trend"
    q["F13_mean_absolute_error"] = f"""SELECT {r6('avg(abs(a.inNums - r.inNums))', 'inNums_mae')},
      {r6('avg(abs(a.outNums - r.outNums))', 'outNums_mae')}, count(*) AS n
      FROM rule r JOIN (SELECT * FROM filled WHERE day = 30) a USING (stationID, hour, minute)"""
    q["F14_choose_by_station"] = f"""SELECT {TEMPLATE_KEYS}, {flows6(f'CASE WHEN stationID IN {SPECIAL} THEN y.inNums ELSE x.inNums END',
      f'CASE WHEN stationID IN {SPECIAL} THEN y.outNums ELSE x.outNums END')} FROM {two('naive0', 'rule')}"""

    next_prev = "COLUMNS('_prev|_next')"
    q["R1_neighbour_slots"] = f"SELECT {SLOT_KEYS}, {next_prev} FROM ({neighbours('filled', IN_DAY)})"
    q["R1_neighbour_hours"] = f"SELECT {HOUR_KEYS}, {next_prev} FROM ({neighbours('filled_hour', HOUR_IN_DAY)})"
    q["R2_neighbour_history"] = neighbour_history("work", IN_DAY, SERIES, SLOT_KEYS, 3)
    q["R2_neighbour_hour_history"] = neighbour_history("work_hour", HOUR_IN_DAY, HOUR_SERIES, HOUR_KEYS, 5)
    q["R3_adjacent_flow"] = adjacent("filled", SLOT_KEYS, "t.hour, t.minute")
    q["R3_adjacent_hour_flow"] = adjacent("filled_hour", HOUR_KEYS, "t.hour")
    slide = lambda f, m: f"CAST(sum({f}) OVER (PARTITION BY stationID, date ORDER BY hour, minute ROWS BETWEEN {m // 10 - 1} PRECEDING AND CURRENT ROW) AS BIGINT) AS {f}_{m}"
    q["R4_sliding_history"] = f"""SELECT {SLOT_KEYS}, {each(lambda f: ', '.join(
        f'coalesce(lag({f}_{m}) OVER {SERIES}, 0) AS {f}_yesterday_{m}' for m in (60, 120)))}
      FROM (SELECT *, {each(lambda f: slide(f, 60) + ', ' + slide(f, 120))} FROM work)"""
    q["R5_slot_trend"] = slot_trend()
    q["R6_linear_history"] = linear_history()
    q["F12_piecewise_trend"] = piecewise_trend()
    q["F11_boosted_stumps"] = boosted_stumps()
    q["R7_station_vectors"] = station_vectors()
    q["R8_line_number"] = f"SELECT {SLOT_KEYS}, lineID FROM filled JOIN station USING (stationID)"
    q["R9_weekday_history"] = weekday_history("work", SLOT_KEYS, "stationID, hour, minute")
    q["R9_weekday_hour_history"] = weekday_history("work_hour", HOUR_KEYS, "stationID, hour")
    q["R10_past_means"] = f"""SELECT {SLOT_KEYS}, {each(lambda f: ', '.join(
        r6(f'list_avg({lag_list(f, n)})', f'{f}_past{n}_mean') for n in (3, 5)))} FROM ({lagged('work', SERIES)})"""

    q["M1_minute_features"] = minute_matrix()
    q["M2_peak_features"] = minute_matrix(f"hour IN (7, 8, 9, 17, 18) AND stationID NOT IN {SPECIAL}")
    q["M3_hour_features"] = hour_matrix()
    q["M4_workday_features"] = day_before_matrix("work", 30, "0")
    q["M5_weekend_features"] = day_before_matrix("wend", 28, "{f}")
    return q


def piecewise_trend(bends=(11, 20)) -> str:
    """Ridge regression on 1, the day and hinges at the bends, by the determinants of its normal equations (Cramer's rule)."""
    basis = ["1.0", "CAST(day - 30 AS DOUBLE)", *[f"CAST(greatest(day - {b}, 0) AS DOUBLE)" for b in bends]]
    m, at = len(basis), [1, 0, *[30 - b for b in bends]]
    sums = ", ".join(f"sum({basis[i]} * {basis[j]}) + {int(i == j and i > 0)} AS a{i}_{j}" for i in range(m) for j in range(m))
    sides = ", ".join(f"sum({basis[i]} * {f}) AS {f}_{i}" for f in FLOWS for i in range(m))

    def determinant(rows: list[list[str]]) -> str:
        if len(rows) == 1:
            return rows[0][0]
        minors = (determinant([r[:k] + r[k + 1 :] for r in rows[1:]]) for k in range(len(rows)))
        return "(" + " ".join(f"{'-' if k % 2 else '+'} {rows[0][k]} * {d}" for k, d in enumerate(minors)) + ")"

    whole = [[f"a{i}_{j}" for j in range(m)] for i in range(m)]

    def solved(f: str) -> str:
        parts = [f"{at[k]} * {determinant([r[:k] + [f'{f}_{i}'] + r[k + 1 :] for i, r in enumerate(whole)])}" for k in range(m) if at[k]]
        return f"round(greatest(0, ({' + '.join(parts)}) / {determinant(whole)}), 6) + 0.0 AS {f}"

    return f"""SELECT stationID, hour, {each(solved)}
      FROM (SELECT stationID, hour, {sums}, {sides} FROM work_hour WHERE day <> 30 GROUP BY ALL)"""


def boosted_stumps(rounds: int = 3) -> str:
    """Least-squares boosting by one split a round: step 0.5, L1 1, L2 2, trained on the days before the target."""
    edges = {"stationID": (0, 7, 11), "hour": (5, 8, 12, 16, 20), "minute": (20,), "week": (2, 4), "inNums_last_1": (0,), "outNums_last_1": (0,)}
    bins = [" + ".join(f"CAST({c} > {e} AS INT)" for e in cuts) for c, cuts in edges.items()]
    shrunk = lambda g: f"sign({g}) * greatest(abs({g}) - 1, 0)"
    score = lambda g, n: f"pow({shrunk(g)}, 2) / ({n} + 2)"
    leaf = lambda g, n: f"({shrunk(g)}) / ({n} + 2)"
    parts = [f"seen AS (SELECT {SLOT_KEYS}, day, inNums, outNums, {', '.join(f'{b} AS b{i}' for i, b in enumerate(bins))} FROM ({lagged('work', SERIES, (1,))}))"]
    for f in FLOWS:
        parts.append(f"{f}0 AS (SELECT *, CAST({f} AS DOUBLE) AS y, avg(CASE WHEN day <> 30 THEN {f} END) OVER () AS p FROM seen)")
        for r in range(rounds):
            items = ", ".join(f"{{'feature': {i}, 'bin': b{i}}}" for i in range(len(edges)))
            parts.append(f"""{f}cell{r} AS (
  SELECT t.c.feature AS feature, t.c.bin AS bin, sum(y - p) AS s, count(*) AS n
  FROM {f}{r}, unnest([{items}]) AS t(c) WHERE day <> 30 GROUP BY ALL)""")
            parts.append(f"""{f}side{r} AS (
  SELECT feature, bin, sum(s) OVER upto AS l, sum(n) OVER upto AS ln, sum(s) OVER whole AS g, sum(n) OVER whole AS n
  FROM {f}cell{r} WINDOW upto AS (PARTITION BY feature ORDER BY bin), whole AS (PARTITION BY feature))""")
            parts.append(f"""{f}best{r} AS (
  SELECT *, {score('l', 'ln')} + {score('g - l', 'n - ln')} - {score('g', 'n')} AS gain
  FROM {f}side{r} ORDER BY ln < n DESC, gain DESC, feature, bin LIMIT 1)""")
            bin_ = "CASE feature " + " ".join(f"WHEN {i} THEN b{i}" for i in range(len(edges))) + " END"
            parts.append(f"""{f}{r + 1} AS (
  SELECT d.* REPLACE (p + 0.5 * CASE WHEN gain <= 0 OR ln = n THEN {leaf('g', 'n')}
    WHEN {bin_} <= bin THEN {leaf('l', 'ln')} ELSE {leaf('g - l', 'n - ln')} END AS p)
  FROM {f}{r} d, {f}best{r})""")
    return f""", {', '.join(parts)}
SELECT {SLOT_KEYS}, round(i.p, 6) + 0.0 AS inNums, round(o.p, 6) + 0.0 AS outNums
FROM inNums{rounds} i JOIN outNums{rounds} o USING ({SLOT_KEYS}) WHERE i.day = 30"""


def station_vectors(size: int = 8, steps: int = 3) -> str:
    """Hashed numbers carried along the lines' positive mutual information; the sum of the steps' unit vectors."""
    walk = "".join(
        f""", step{t} AS (SELECT a AS stationID, k, sum(w * x) AS x FROM weight JOIN step{t - 1} ON b = stationID GROUP BY ALL)
, unit{t} AS (SELECT stationID, k, x / nullif(sqrt(sum(x * x) OVER (PARTITION BY stationID)), 0) AS x FROM step{t})"""
        for t in range(1, steps + 1)
    )
    columns = ", ".join(f"round(coalesce(sum(x) FILTER (k = {k}), 0.0), 6) + 0.0 AS v{k}" for k in range(1, size + 1))
    return f""", pair AS (
  SELECT a.stationID AS a, b.stationID AS b, count(*) AS n FROM station a JOIN station b
  ON a.lineID = b.lineID AND a.stationID <> b.stationID AND abs(a.linePos - b.linePos) BETWEEN 1 AND 5 GROUP BY ALL)
, own AS (SELECT a, sum(n) AS n FROM pair GROUP BY a)
, pmi AS (
  SELECT pair.a, pair.b, greatest(ln(pair.n * (SELECT sum(n) FROM pair) / (x.n * y.n)), 0) AS m
  FROM pair JOIN own x ON x.a = pair.a JOIN own y ON y.a = pair.b)
, weight AS (SELECT a, b, m / sum(m) OVER (PARTITION BY a) AS w FROM pmi QUALIFY sum(m) OVER (PARTITION BY a) > 0)
, step0 AS (
  SELECT stationID, k, CAST('0x' || substr(md5(stationID || ':' || k), 1, 8) AS BIGINT) / 4294967296.0 - 0.5 AS x
  FROM station, range(1, {size + 1}) AS t(k)){walk}
SELECT s.stationID, {columns} FROM station s LEFT JOIN ({' UNION ALL '.join(f'SELECT * FROM unit{t}' for t in range(1, steps + 1))}) USING (stationID)
GROUP BY s.stationID"""


def oracles() -> dict[str, str]:
    return {name: BASE + body for name, body in statements().items()}
