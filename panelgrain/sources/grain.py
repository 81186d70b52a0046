"""Time grains and the calendar truncation that goes with each of them."""

from __future__ import annotations

from datetime import date as Day
from datetime import timedelta
from enum import IntEnum

from pyspark.sql import Column
from pyspark.sql import functions as F


class Grain(IntEnum):
    """Ordered from fine to coarse; SNAPSHOT has no time axis and stands apart."""

    INTRADAY = 0
    DAILY = 1
    WEEKLY = 2
    MONTHLY = 3
    QUARTERLY = 4
    ANNUAL = 5
    SNAPSHOT = 99

    @classmethod
    def parse(cls, value: "Grain | str") -> "Grain":
        if isinstance(value, Grain):
            return value
        try:
            return cls[str(value).upper()]
        except KeyError:
            names = ", ".join(g.name.lower() for g in cls)
            raise ValueError(f"unknown grain {value!r}; expected one of {names}") from None

    @property
    def unit(self) -> str:
        units = {
            Grain.WEEKLY: "week",
            Grain.MONTHLY: "month",
            Grain.QUARTERLY: "quarter",
            Grain.ANNUAL: "year",
        }
        return units.get(self, "day")

    @property
    def timed(self) -> bool:
        return self is not Grain.SNAPSHOT

    def period_start(self, date: Column | str) -> Column:
        """First day of the period holding ``date`` (weeks start on Monday)."""
        date = F.col(date) if isinstance(date, str) else date
        # F.trunc has no day unit, and a DATE is already a day.
        return date if self.unit == "day" else F.trunc(date, self.unit)

    def first_day(self, day: Day | str) -> Day:
        """First day of the period holding the given day."""
        day = Day.fromisoformat(str(day)[:10])
        if self.unit == "week":
            return day - timedelta(day.weekday())
        month = {"month": day.month, "quarter": (day.month - 1) // 3 * 3 + 1, "year": 1}.get(self.unit)
        return day if month is None else day.replace(month=month, day=1)
