"""Calendar lists (driver side, small) and time expressions (executor side)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class DayPlan:
    """The days of a study: its span and the holidays inside it.

    Every list below comes from these arguments, so no plan scans the data to
    find out which days exist.
    """

    start: date
    end: date
    holidays: tuple[date, ...] = ()

    def days(self) -> list[date]:
        return [self.start + timedelta(n) for n in range((self.end - self.start).days + 1)]

    def weekends(self) -> list[date]:
        return [d for d in self.days() if d.weekday() >= 5]

    def rest_days(self) -> list[date]:
        return [d for d in self.days() if d.weekday() >= 5 or d in self.holidays]

    def workdays(self) -> list[date]:
        rest = set(self.rest_days())
        return [d for d in self.days() if d not in rest]

    def on(self, *days: int) -> list[date]:
        """Days of the start month, by number."""
        return [self.start.replace(day=n) for n in days]


def date_sql(days: Iterable[date]) -> str:
    return ", ".join(f"DATE'{d.isoformat()}'" for d in days)


def in_days(days: Iterable[date], column: str = "date") -> str:
    """Predicate text; a list of literals prunes partitions and reaches the scan."""
    listed = date_sql(days)
    return f"{column} IN ({listed})" if listed else "FALSE"


def date_array(days: Iterable[date]) -> Column:
    return F.expr(f"array({date_sql(days)})")


def week_of(day: Column) -> Column:
    """Monday 1 to Sunday 7."""
    return F.weekday(day) + F.lit(1)


def weekend_of(day: Column) -> Column:
    return (F.weekday(day) >= 5).cast("int")


def slot_minute(ts: Column) -> Column:
    """The start of the ten-minute slot a timestamp falls in."""
    return F.minute(ts) - F.minute(ts) % F.lit(10)


def clock_label(hour: Column, minute: Column) -> Column:
    """``HH:MM`` text, zero padded, so that text order is time order."""
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    return F.concat(two(hour), F.lit(":"), two(minute))


def slot_start(day: Column, hour: Column, minute: Column) -> Column:
    """Zone-free timestamp at which a slot begins."""
    clock = F.make_dt_interval(F.lit(0), hour, minute, F.lit(0))
    return day.cast("timestamp_ntz") + clock


def running_flag(label: Column, *, opens: Sequence[Column], closes: Sequence[Column]) -> Column:
    """1 inside opening hours, both ends included, 0 outside or when unknown."""
    before = label < F.least(*opens)
    after = label > F.greatest(*closes)
    known = F.coalesce(*opens, *closes).isNotNull()
    return F.when(~known | before | after, 0).otherwise(1)


def day_index(day: Column, kept: Sequence[date]) -> Column:
    """1-based rank of a day among the kept days; null for any other day."""
    position = F.array_position(date_array(sorted(kept)), day).cast("int")
    return F.when(position > 0, position)


def day_at(index: Column, kept: Sequence[date]) -> Column:
    """Inverse of :func:`day_index`."""
    return F.try_element_at(date_array(sorted(kept)), index)


def parse_time(text: Column, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.to_timestamp_ntz(text, F.lit(pattern))


def time_parts(ts: Column) -> dict[str, Column]:
    """Day, hour, full minute and weekday (Monday 0) of a timestamp."""
    return {
        "days": F.dayofmonth(ts),
        "hours": F.hour(ts),
        "minutes": F.minute(ts),
        "wkday": F.weekday(ts),
    }
