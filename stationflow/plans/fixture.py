"""The driver's tables seen as taps, stations, templates and a calendar.

Ten users make a station and a hundred customers its dimension row, so stations,
slots and features all grow with the tables.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.functions.calendar import DayPlan
from stationflow.operators import forecast as fc
from stationflow.operators import slots as sl
from stationflow.operators.boosting import BoostSettings
from stationflow.session import stored

PLAN = DayPlan(date(2024, 1, 1), date(2024, 1, 30), holidays=(date(2024, 1, 1),))
REFERENCE = PLAN.on(22, 23, 24, 25, 26)
WEEKDAY_SOURCE, WEEKDAY_TARGET = PLAN.on(29, 30)
SUNDAYS = PLAN.on(7, 14, 21)
PAIRS = [tuple(PLAN.on(13, 14)), tuple(PLAN.on(20, 21))]
WEEKEND_SOURCE, WEEKEND_TARGET = PLAN.on(27, 28)
REST_AND_SOURCE = PLAN.on(1, 6, 7, 13, 14, 20, 21, 27, 28, 29)
RULE_DAYS = [*REFERENCE, WEEKDAY_SOURCE]
WEEKEND_RULE_DAYS = sorted({*SUNDAYS, *[d for pair in PAIRS for d in pair], WEEKEND_SOURCE})
SPECIAL = (2, 7, 11)
CLOSED = (4,)
PEAK = (7, 8, 9, 17, 18)
# Only the columns used; naming them spares the footer reads of schema inference.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string",
    "customer": "c_custkey bigint",
}


# Days at which the trend may bend.
TREND_CHANGES = PLAN.on(11, 20)
# Three rounds of one split each, and the cut points of their features.
STUMPS = BoostSettings(rounds=3, step=0.5, depth=1, leaves=2, l1=1.0, l2=2.0, row_share=1.0, feature_share=1.0)
STUMP_EDGES = ((0, 7, 11), (5, 8, 12, 16, 20), (20,), (2, 4), (0,), (0,))


@dataclass(frozen=True)
class Fixture:
    spark: SparkSession
    sf_dir: str
    kept_slots: DataFrame | None = None

    def _table(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.sf_dir}/{name}.parquet")

    def taps(self) -> DataFrame:
        return self._table("events").selectExpr(
            "ts AS time",
            "CAST(user_id DIV 10 AS INT) AS stationID",
            "CAST(event_id % 13 AS INT) AS deviceID",
            "CASE WHEN event_type IN ('view', 'click') THEN 1 ELSE 0 END AS status",
        )

    def stations(self) -> DataFrame:
        numbers = self._table("customer").selectExpr("CAST(c_custkey DIV 100 AS INT) AS stationID")
        return numbers.distinct().selectExpr(
            "stationID",
            "CAST(stationID DIV 5 AS INT) AS lineID",
            "stationID % 5 AS linePos",
            "concat('0', stationID % 2 + 5, ':30') AS start_time",
            "concat('0', stationID % 2 + 5, ':40') AS start_time2",
            "'22:50' AS end_time",
            "concat('23:', stationID % 2, '0') AS end_time2",
        )

    def slots(self, days: Sequence[date] | None = None) -> DataFrame:
        """Flows of the slots that have taps, of the given days (default: all)."""
        if self.kept_slots is not None:
            return self.kept_slots if days is None else sl.on_days(self.kept_slots, days)
        taps = self.taps()
        return sl.slot_flows(taps if days is None else sl.taps_on_days(taps, days))

    def stored(self, days: Sequence[date] | None = None) -> Fixture:
        """The same with the slots of the given days (default: all) written once to the shared folder.

        For queries that use the slots in several branches: the taps, by far
        the largest table, are then read once.
        """
        return replace(self, kept_slots=stored(self.slots(days), "slots"))

    def slot_table(self) -> DataFrame:
        return sl.slot_table(self.taps(), PLAN.start)

    def filled(self, days: list[date] | None = None) -> DataFrame:
        """Gap-free slots of the given days (default: all) with calendar columns."""
        days = PLAN.days() if days is None else days
        grid = sl.station_grid(self.stations(), days)
        return sl.with_calendar(sl.fill_gaps(self.slots(days), grid), PLAN.start)

    def filled_hours(self, days: list[date] | None = None) -> DataFrame:
        days = PLAN.days() if days is None else days
        facts = sl.hour_rollup(self.slots(days))
        grid = sl.station_grid(self.stations(), days, "hour")
        return sl.with_calendar(sl.fill_gaps(facts, grid, ("stationID", "date", "hour")), PLAN.start)

    def workdays(self) -> DataFrame:
        """Gap-free workday slots, the target day masked."""
        return sl.mask_days(self.filled(PLAN.workdays()), [WEEKDAY_TARGET])

    def work_hours(self) -> DataFrame:
        return sl.mask_days(self.filled_hours(PLAN.workdays()), [WEEKDAY_TARGET])

    def weekends(self) -> DataFrame:
        """Gap-free weekend slots, the target day masked."""
        return sl.mask_days(self.filled(PLAN.weekends()), [WEEKEND_TARGET])

    def template(self, day: date = WEEKDAY_TARGET) -> DataFrame:
        return fc.template_for(self.stations(), day)

    def weekday_rule(self) -> DataFrame:
        slots = self.slots(RULE_DAYS)
        return fc.weekday_rule(slots, self.template(), REFERENCE, WEEKDAY_SOURCE)

    def weekend_rule(self) -> DataFrame:
        return fc.weekend_rule(
            self.filled(WEEKEND_RULE_DAYS), self.template(WEEKEND_TARGET), SUNDAYS, PAIRS, WEEKEND_SOURCE
        )

    def same_as(self, day: date, target: date) -> DataFrame:
        """A forecast that repeats an earlier day, for the slots that day has."""
        flows = [F.col(f).cast("double").alias(f) for f in sl.FLOWS]
        earlier = self.slots([day]).select("stationID", "hour", "minute", *flows)
        return fc.attach_to_template(self.template(target), earlier, fill=False)
