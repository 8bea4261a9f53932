"""Rule forecasts and the operations that combine and correct forecasts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationflow.functions import calendar as cal
from stationflow.operators.slots import on_days
from stationflow.sources.schemas import FLOWS

SLOT = ("stationID", "hour", "minute")
HOUR = ("stationID", "hour")
TEMPLATE_KEYS = ("stationID", "startTime", "endTime")
GUARD = 0.001


def _over_hour(total: Column, rows: Column) -> Column:
    """Mean per (station, hour) from sums and counts already held per slot."""
    hour = Window.partitionBy(*HOUR)
    return F.sum(total).over(hour) / F.nullif(F.sum(rows).over(hour), F.lit(0))


def slot_means(slots: DataFrame, days: Sequence[date], flows: Sequence[str] = FLOWS) -> DataFrame:
    """Mean flow per station and slot over the given days."""
    return on_days(slots, days).groupBy(*SLOT).agg(*[F.avg(f).alias(f"{f}_mean") for f in flows])


def hour_means(slots: DataFrame, days: Sequence[date], flows: Sequence[str] = FLOWS) -> DataFrame:
    """Mean of the slot values (not of hourly totals) per station and hour."""
    return on_days(slots, days).groupBy(*HOUR).agg(*[F.avg(f).alias(f"{f}_mean_hour") for f in flows])


def slot_shares(
    slots: DataFrame,
    days: Sequence[date],
    flows: Sequence[str] = FLOWS,
    guard: float = GUARD,
) -> DataFrame:
    """Slot mean, hour mean and their ratio over the given days.

    The days are summed once per slot; the hour means come from those sums by
    a window, not from a second pass over the slots.
    """
    sums = on_days(slots, days).groupBy(*SLOT).agg(
        *[c for f in flows for c in (F.sum(f).alias(f"_{f}_sum"), F.count(f).alias(f"_{f}_n"))]
    )
    means = sums.withColumns(
        {
            name: column
            for f in flows
            for name, column in (
                (f"{f}_mean", F.try_divide(F.col(f"_{f}_sum"), F.col(f"_{f}_n"))),
                (f"{f}_mean_hour", _over_hour(F.col(f"_{f}_sum"), F.col(f"_{f}_n"))),
            )
        }
    )
    return means.select(
        *SLOT,
        *[F.col(f"{f}_mean") for f in flows],
        *[F.col(f"{f}_mean_hour") for f in flows],
        *[
            (F.col(f"{f}_mean") / (F.col(f"{f}_mean_hour") + F.lit(guard))).alias(f"{f}_share")
            for f in flows
        ],
    )


def source_hour_means(
    slots: DataFrame, day: date, flows: Sequence[str] = FLOWS
) -> DataFrame:
    """Each slot of the source day with the mean of its hour.

    It stays at slot grain: a slot the source day lacks gets no hour mean.
    """
    hour = Window.partitionBy(*HOUR)
    return on_days(slots, [day]).select(
        *SLOT, *flows, *[F.avg(f).over(hour).alias(f"{f}_source_hour") for f in flows]
    )


def days_side_by_side(
    slots: DataFrame, days: Mapping[str, date], flows: Sequence[str] = FLOWS
) -> DataFrame:
    """One column per flow and day, for the slots the first day has."""
    first = next(iter(days.values()))
    cells = [
        F.max(F.when(F.col("date") == F.lit(d), F.col(f))).alias(f"{f}_{name}")
        for name, d in days.items()
        for f in flows
    ]
    has_first = F.max((F.col("date") == F.lit(first)).cast("int"))
    wide = on_days(slots, list(days.values())).groupBy(*SLOT).agg(*cells, has_first.alias("_base"))
    return wide.filter("_base = 1").drop("_base")


def weekend_ratios(
    slots: DataFrame, pairs: Sequence[tuple[date, date]], flows: Sequence[str] = FLOWS
) -> DataFrame:
    """Sunday over Saturday per station and hour, averaged over the weekend pairs.

    One undefined or infinite weekly ratio makes the mean 1.
    """
    days = {f"{side}{i}": d for i, pair in enumerate(pairs) for side, d in zip(("sat", "sun"), pair, strict=True)}
    wide = days_side_by_side(slots, days, flows)
    means = wide.groupBy(*HOUR).agg(
        *[F.avg(f"{f}_{name}").alias(f"{f}_{name}") for f in flows for name in days]
    )
    ratio = lambda f, i: F.try_divide(F.col(f"{f}_sun{i}"), F.col(f"{f}_sat{i}"))
    n = len(pairs)
    return means.select(
        *HOUR,
        *[
            F.coalesce(reduce(add, [ratio(f, i) for i in range(n)]) / F.lit(float(n)), F.lit(1.0)).alias(f"{f}_ratio")
            for f in flows
        ],
    )


def with_template_slot(template: DataFrame) -> DataFrame:
    return template.withColumns({"hour": F.hour("startTime"), "minute": F.minute("startTime")})


def _sum_and_count(f: str, tag: str, when: str) -> list[Column]:
    return [
        F.expr(f"sum({f}) FILTER (WHERE {when})").alias(f"_{f}_{tag}"),
        F.expr(f"count({f}) FILTER (WHERE {when})").alias(f"_{f}_{tag}_n"),
    ]


def _share(f: str, tag: str, guard: float) -> Column:
    total, rows = F.col(f"_{f}_{tag}"), F.col(f"_{f}_{tag}_n")
    return F.try_divide(total, rows) / (_over_hour(total, rows) + F.lit(guard))


def _level(f: str, tag: str) -> Column:
    """The hour mean of a day, for the slots that day has."""
    total, rows = F.col(f"_{f}_{tag}"), F.col(f"_{f}_{tag}_n")
    return F.when(rows > 0, _over_hour(total, rows))


def weekday_rule(
    slots: DataFrame,
    template: DataFrame,
    reference: Sequence[date],
    source: date,
    factor: float = 0.965,
    guard: float = GUARD,
) -> DataFrame:
    """Slot share over the reference days x hour mean of the source day x factor.

    Slots missing on either side forecast 0. Reference and source days are read
    in one pass: one aggregate per slot, then one window per hour.
    """
    sums = on_days(slots, [*reference, source]).groupBy(*SLOT).agg(
        *[
            c
            for f in FLOWS
            for tag, days in (("ref", reference), ("src", [source]))
            for c in _sum_and_count(f, tag, cal.in_days(days))
        ]
    )
    forecast = sums.select(
        *SLOT,
        *[(_share(f, "ref", guard) * _level(f, "src") * F.lit(factor)).alias(f) for f in FLOWS],
    )
    return attach_to_template(template, forecast)


def weekend_rule(
    slots: DataFrame,
    template: DataFrame,
    sundays: Sequence[date],
    pairs: Sequence[tuple[date, date]],
    source: date,
    guard: float = GUARD,
) -> DataFrame:
    """Saturday's hour mean x Sunday/Saturday ratio x slot share of past Sundays.

    The same rule as :func:`slot_shares`, :func:`source_hour_means` and
    :func:`weekend_ratios` multiplied, but all days are read in one pass: one
    aggregate per slot and one window per hour, where the three operators would
    each read the slots and then be joined.
    """
    weekend = {f"{side}{i}": d for i, pair in enumerate(pairs) for side, d in zip(("sat", "sun"), pair, strict=True)}
    first = cal.in_days([pairs[0][0]])
    sums = on_days(slots, sorted({*sundays, source, *weekend.values()})).groupBy(*SLOT).agg(
        *[c for f in FLOWS for c in _sum_and_count(f, "ref", cal.in_days(sundays))],
        *[c for f in FLOWS for c in _sum_and_count(f, "src", cal.in_days([source]))],
        *[
            F.expr(f"max({f}) FILTER (WHERE {cal.in_days([d])})").alias(f"_{f}_{name}")
            for f in FLOWS
            for name, d in weekend.items()
        ],
        F.expr(f"count_if({first}) > 0").alias("_base"),
    )
    hour = "(PARTITION BY stationID, hour)"

    def ratio(f: str) -> Column:
        # Means over the slots the first Saturday has, as when days are joined to it.
        mean = lambda name: f"avg(CASE WHEN _base THEN _{f}_{name} END) OVER {hour}"
        weekly = [f"try_divide({mean(f'sun{i}')}, {mean(f'sat{i}')})" for i in range(len(pairs))]
        some = f"count_if(_base) OVER {hour} > 0"
        return F.expr(f"CASE WHEN {some} THEN coalesce(({' + '.join(weekly)}) / {len(pairs)}D, 1D) END")

    forecast = sums.select(
        *SLOT,
        *[(_level(f, "src") * ratio(f) * _share(f, "ref", guard)).alias(f) for f in FLOWS],
    )
    return attach_to_template(template, forecast)


def attach_to_template(
    template: DataFrame, values: DataFrame, keys: Sequence[str] = SLOT, fill: bool = True
) -> DataFrame:
    """Forecast rows for the template's slots, joined by key, never by row order."""
    joined = with_template_slot(template).join(values, list(keys), "left")
    flows = [
        F.coalesce(F.col(f), F.lit(0.0)).alias(f) if fill else F.col(f).alias(f) for f in FLOWS
    ]
    return joined.select(*TEMPLATE_KEYS, *flows)


def join_forecasts(forecasts: Sequence[DataFrame]) -> DataFrame:
    """Left join on the template key; flows get the suffix of their position."""
    numbered = [
        one.select(*TEMPLATE_KEYS, *[F.col(f).alias(f"{f}_{i}") for f in FLOWS])
        for i, one in enumerate(forecasts)
    ]
    return reduce(lambda a, b: a.join(b, list(TEMPLATE_KEYS), "left"), numbered)


def blend(
    forecasts: Sequence[DataFrame], weights: Sequence[float], fallback: bool = False
) -> DataFrame:
    """Weighted sum of forecasts, by template key, for the rows of the first one.

    A key missing from a later forecast makes the blend null; with ``fallback``
    the first forecast stands in for the missing one.
    """
    if len(forecasts) != len(weights):
        raise ValueError("one weight per forecast")

    def value(f: str, i: int) -> Column:
        own = F.col(f"{f}_{i}")
        return F.coalesce(own, F.col(f"{f}_0")) if fallback else own

    return join_forecasts(forecasts).select(
        *TEMPLATE_KEYS,
        *[
            reduce(add, [value(f, i) * F.lit(float(w)) for i, w in enumerate(weights)]).alias(f)
            for f in FLOWS
        ],
    )


def night_override(
    forecast: DataFrame, slots: DataFrame, day: date, hours: Sequence[int] = (0, 1, 2, 3, 4)
) -> DataFrame:
    """In the given hours, the flows of an earlier day; null where it lacks the slot."""
    earlier = (
        on_days(slots, [day])
        .filter(F.col("hour").isin(list(hours)))
        .select(*SLOT, *[F.col(f).cast("double").alias(f"_{f}") for f in FLOWS])
    )
    joined = with_template_slot(forecast).join(earlier, list(SLOT), "left")
    at_night = F.col("hour").isin(list(hours))
    return joined.select(
        *TEMPLATE_KEYS,
        *[F.when(at_night, F.col(f"_{f}")).otherwise(F.col(f)).alias(f) for f in FLOWS],
    )


def rescale(
    forecast: DataFrame,
    factor: float,
    multipliers: Sequence[tuple[int, Sequence[int], str, float]] = (),
) -> DataFrame:
    """All flows x ``factor``; then (station, hours, flow, multiplier) corrections."""
    hour = F.hour("startTime")
    scaled = {f: F.col(f) * F.lit(factor) for f in FLOWS}
    for station, hours, flow, by in multipliers:
        hit = (F.col("stationID") == station) & hour.isin(list(hours))
        scaled[flow] = F.when(hit, scaled[flow] * F.lit(by)).otherwise(scaled[flow])
    return forecast.select(*TEMPLATE_KEYS, *[c.alias(f) for f, c in scaled.items()])


def close_stations(forecast: DataFrame, closed: Sequence[int]) -> DataFrame:
    """Closed stations forecast 0."""
    shut = F.col("stationID").isin(list(closed))
    return forecast.withColumns({f: F.when(shut, 0.0).otherwise(F.col(f)) for f in FLOWS})


def clip_negative(forecast: DataFrame) -> DataFrame:
    return forecast.withColumns(
        {f: F.when(F.col(f) >= 0, F.col(f)).otherwise(F.lit(0).cast(forecast.schema[f].dataType)) for f in FLOWS}
    )


def hours_to_slots(
    template: DataFrame, hour_forecast: DataFrame, shares: DataFrame
) -> DataFrame:
    """Hour total / 6 x slot share, for the template's slots."""
    hourly = hour_forecast.select(*HOUR, *[(F.col(f) / F.lit(6.0)).alias(f"_{f}") for f in FLOWS])
    values = shares.join(hourly, list(HOUR)).select(
        *SLOT, *[(F.col(f"{f}_share") * F.col(f"_{f}")).alias(f) for f in FLOWS]
    )
    return attach_to_template(template, values)


def choose_by_station(model: DataFrame, rule: DataFrame, special: Sequence[int]) -> DataFrame:
    """Special stations take the rule's forecast, all others the model's."""
    side = rule.select(*TEMPLATE_KEYS, *[F.col(f).alias(f"_{f}") for f in FLOWS])
    chosen = F.col("stationID").isin(list(special))
    return model.join(side, list(TEMPLATE_KEYS), "left").select(
        *TEMPLATE_KEYS,
        *[F.when(chosen, F.col(f"_{f}")).otherwise(F.col(f)).alias(f) for f in FLOWS],
    )


def trend_forecast(hours: DataFrame, kept: Sequence[date], target: date) -> DataFrame:
    """A straight line per station and hour through the kept days, read off at the target.

    All lines are fitted in one aggregate; negative values become 0.
    """
    x = F.datediff(F.col("date"), F.lit(target)).cast("double")
    # With x counted from the target day, the intercept is the forecast.
    fitted = on_days(hours, [d for d in kept if d != target]).groupBy(*HOUR).agg(
        *[F.regr_intercept(F.col(f), x).alias(f) for f in FLOWS]
    )
    return clip_negative(fitted)


def piecewise_trend(
    hours: DataFrame, kept: Sequence[date], target: date, changes: Sequence[date], ridge: float = 1.0
) -> DataFrame:
    """A broken line per station and hour through the kept days, read off at the target.

    The slope may change at the days of ``changes``, which lie before the target.
    The line is a sum of 1, the day and a hinge per change; ``ridge`` shrinks the
    slope and the changes, so that few days still give one solution. Normal
    equations of all keys are summed in one aggregate and solved by elimination
    in column expressions. Negative values become 0.
    """
    x = F.datediff(F.col("date"), F.lit(target)).cast("double")
    bends = [float((day - target).days) for day in sorted(changes)]
    basis = [F.lit(1.0), x, *[F.greatest(x - F.lit(c), F.lit(0.0)) for c in bends]]
    at_target = [1.0, 0.0, *[-c for c in bends]]
    n, ends = len(basis), range(len(basis))
    products = [F.sum(basis[i] * basis[j]).alias(f"a{i}_{j}") for i in ends for j in ends if i <= j]
    sides = [F.sum(basis[i] * F.col(f)).alias(f"{f}_{i}") for f in FLOWS for i in ends]
    rows = on_days(hours, [d for d in kept if d != target]).groupBy(*HOUR).agg(*products, *sides)
    rows = rows.withColumns({f"a{i}_{i}": F.col(f"a{i}_{i}") + ridge for i in ends if i})
    for p in ends:  # The matrix is symmetric and positive, so its diagonal can always be divided by.
        share = {i: F.col(f"a{p}_{i}") / F.col(f"a{p}_{p}") for i in range(p + 1, n)}
        less = {f"a{i}_{j}": F.col(f"a{i}_{j}") - share[i] * F.col(f"a{p}_{j}") for i in share for j in share if i <= j}
        less |= {f"{f}_{i}": F.col(f"{f}_{i}") - share[i] * F.col(f"{f}_{p}") for f in FLOWS for i in share}
        rows = rows.withColumns(less) if less else rows
    for p in reversed(ends):
        known = {f: reduce(add, [F.col(f"a{p}_{j}") * F.col(f"{f}_{j}") for j in range(p + 1, n)], F.lit(0.0)) for f in FLOWS}
        rows = rows.withColumns({f"{f}_{p}": (F.col(f"{f}_{p}") - known[f]) / F.col(f"a{p}_{p}") for f in FLOWS})
    read = {f: reduce(add, [F.col(f"{f}_{i}") * F.lit(at_target[i]) for i in ends]) for f in FLOWS}
    return clip_negative(rows.select(*HOUR, *[read[f].alias(f) for f in FLOWS]))


def absolute_error(actual: DataFrame, forecast: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mean absolute error of each flow over the keys both tables have."""
    side = forecast.select(*keys, *[F.col(f).alias(f"_{f}") for f in FLOWS])
    return actual.join(side, list(keys)).agg(
        *[F.avg(F.abs(F.col(f) - F.col(f"_{f}"))).alias(f"{f}_mae") for f in FLOWS],
        F.count(F.lit(1)).alias("n"),
    )


def template_for(stations: DataFrame, day: date) -> DataFrame:
    """The template of one day: every station's ten-minute slots."""
    start = cal.slot_start(F.lit(day), F.col("hour"), F.col("minute"))
    slots = stations.select("stationID").withColumn(
        "hour", F.explode(F.sequence(F.lit(0), F.lit(23)))
    ).withColumn("minute", F.explode(F.sequence(F.lit(0), F.lit(50), F.lit(10))))
    return slots.select(
        "stationID",
        start.alias("startTime"),
        (start + F.expr("INTERVAL 10 MINUTES")).alias("endTime"),
    )

