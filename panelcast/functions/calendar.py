"""Period labels, calendar steps and calendar features as column expressions."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, replace

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted frequency codes and the label convention each stands for.
FREQ_ALIASES = {
    "M": "ME",
    "Q": "QE",
    "Y": "YE",
    "D": "D",
    "W": "W",
    "MS": "MS",
    "QS": "QS",
    "YS": "YS",
}

# Display name of each frequency.
FREQ_LABELS = {
    "ME": "Monthly",
    "MS": "Monthly",
    "QE": "Quarterly",
    "QS": "Quarterly",
    "YE": "Yearly",
    "YS": "Yearly",
    "D": "Daily",
    "W": "Weekly",
}

# Months counted as festive.
FESTIVE_MONTHS = (3, 9, 10, 11)

# A "B" before a month code puts its labels on business days (Monday to Friday).
_MONTHS_PER_STEP = {b + c + side: n for b in ("", "B") for c, n in (("M", 1), ("Q", 3), ("Y", 12)) for side in "SE"}
_DAYS_PER_STEP = {"D": 1, "W": 7}
# Grids without a step in months or days: business days, and the 1st or 15th, or 15th and last day, of a month.
_GRIDS = ("B", "SMS", "SME")
_SEASONS = {"M": 12, "Q": 4, "Y": 1, "W": 52, "D": 7, "B": 5, "SMS": 24, "SME": 24}
_UNIT_SECONDS = {"h": 3600, "min": 60, "s": 1}
# Weekday codes of anchored weeks, Monday first, as next_day reads them.
_WEEKDAYS = ("MON", "TUE", "WED", "THU", "FRI", "SAT", "SUN")
# Month codes of anchored quarters and years, January first.
_MONTHS = ("JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC")
_DAY = 86_400


@dataclass(frozen=True)
class Frequency:
    """A resolved frequency: calendar months, whole days, a grid of dates, or seconds.

    ``multiple`` periods of ``single`` are one period; ``months``, ``days`` and ``seconds`` are those of
    the whole. ``weekday`` ends a week, ``first_month`` begins a quarter or year. Durations that do not
    divide a day are multiples of their greatest part that does.
    """

    code: str
    months: int = 0
    days: int = 0
    seconds: int = 0
    multiple: int = 1
    weekday: str = "SUN"
    first_month: int = 1

    @property
    def on_grid(self) -> bool:
        return self.code in _GRIDS

    @property
    def on_business_days(self) -> bool:
        return self.months > 0 and self.code.startswith("B")

    @property
    def is_end_label(self) -> bool:
        return self.months > 0 and self.code.endswith("E")

    @property
    def closes_right(self) -> bool:
        """Whether a label stands at the end of its period."""
        return self.is_end_label or self.code == "W"

    @property
    def single(self) -> Frequency:
        """One period of the same code."""
        n = self.multiple
        return replace(self, months=self.months // n, days=self.days // n, seconds=self.seconds // n, multiple=1)

    @property
    def label(self) -> str:
        name = FREQ_LABELS.get(self.code, self.code)
        return name if self.multiple == 1 or self.seconds else f"{self.multiple} x {name}"

    @property
    def season_length(self) -> int:
        if self.seconds:
            return max(1, _DAY // self.seconds) if _DAY % self.seconds == 0 else 1
        code = self.code.removeprefix("B")[0] if self.months else self.code
        season, n = _SEASONS[code], self.multiple
        return season // n if season % n == 0 else 1


def resolve_freq(freq: str | Frequency) -> Frequency:
    """Map a frequency string to a :class:`Frequency`.

    A code (``MS``, ``QE``, ``W``, ``D``), on business days with a ``B`` in front (``BMS``, ``BQE``), or a grid
    (``B`` business days, ``SMS`` and ``SME`` half months); a multiple of it (``2MS``); weeks that end on a weekday
    (``W-MON``); quarters and years that begin (``QS-APR``) or end (``YE-MAR``) with a month; or a duration
    (``15min``, ``5h``, ``36h``).
    """
    if isinstance(freq, Frequency):
        return freq
    parts = re.fullmatch(r"(\d*)([A-Z]+)(?:-([A-Z]{3}))?", freq)
    if parts:
        n, code, anchor = int(parts.group(1) or 1), parts.group(2), parts.group(3)
        code = FREQ_ALIASES.get(code, code)
        if n > 0 and code in _MONTHS_PER_STEP and (anchor is None or (anchor in _MONTHS and _MONTHS_PER_STEP[code] > 1)):
            month = _MONTHS.index(anchor) + 1 if anchor else None
            if month and code.endswith("E"):
                month = month % 12 + 1  # the month after the last one begins the next period
            return Frequency(code, months=n * _MONTHS_PER_STEP[code], multiple=n, first_month=month or 1)
        if n > 0 and code in _DAYS_PER_STEP and (anchor is None or (code == "W" and anchor in _WEEKDAYS)):
            return Frequency(code, days=n * _DAYS_PER_STEP[code], multiple=n, weekday=anchor or "SUN")
        if n > 0 and code in _GRIDS and anchor is None:
            return Frequency(code, multiple=n)
    match = re.fullmatch(r"(\d*)(h|min|s)", freq)
    seconds = int(match.group(1) or 1) * _UNIT_SECONDS[match.group(2)] if match else 0
    if seconds:
        return Frequency(freq, seconds=seconds, multiple=seconds // math.gcd(seconds, _DAY))
    raise ValueError(f"unsupported frequency {freq!r}")


def _business(day: Column, forward: bool) -> Column:
    """The nearest business day on or after (or before) ``day``."""
    over = F.greatest(F.weekday(day) - 4, F.lit(0))  # 1 on Saturdays, 2 on Sundays
    return F.date_add(day, F.when(over > 0, 3 - over).otherwise(0)) if forward else F.date_sub(day, over)


def _month_label(begin: Column, f: Frequency) -> Column:
    """The label of the months from ``begin``, the first day of a single period."""
    label = F.last_day(F.add_months(begin, f.single.months - 1)) if f.is_end_label else begin
    return _business(label, not f.is_end_label) if f.on_business_days else label


def _month_begin(day: Column, f: Frequency) -> Column:
    size = f.single.months
    if f.first_month == 1 or size == 1:
        return F.trunc(day, {1: "MM", 3: "QUARTER", 12: "YEAR"}[size])
    return F.add_months(F.trunc(day, "MM"), -F.pmod(F.month(day) - f.first_month, F.lit(size)))


def _ordinal(label: Column, f: Frequency) -> Column:
    """Place of a label among all labels of its grid."""
    if f.code == "B":
        days = F.unix_date(label) + 3  # since a Monday
        return (F.floor(days / 7) * 5 + F.pmod(days, F.lit(7))).cast("int")
    half = F.day(label) >= 15 if f.code == "SMS" else F.day(label) != 15
    return (F.year(label) * 24 + (F.month(label) - 1) * 2 + half.cast("int")).cast("int")


def _at_ordinal(place: Column, f: Frequency) -> Column:
    if f.code == "B":
        return F.date_from_unix_date((F.floor(place / 5) * 7 + F.pmod(place, F.lit(5)) - 3).cast("int"))
    begin = F.make_date(F.floor(place / 24).cast("int"), (F.floor(F.pmod(place, F.lit(24)) / 2) + 1).cast("int"), F.lit(1))
    second = F.pmod(place, F.lit(2)) == 1
    if f.code == "SMS":
        return F.date_add(begin, F.when(second, 14).otherwise(0))
    return F.when(second, F.last_day(begin)).otherwise(F.date_add(begin, 14))


def period_label(ts: Column, freq: str | Frequency) -> Column:
    """Label of the period that holds ``ts`` (a date, or a timestamp for durations); of the single period
    for a multiple, whose periods depend on where a series begins (see ``regrouped``)."""
    f = resolve_freq(freq)
    if f.seconds:
        return F.window(ts.cast("timestamp_ntz"), f"{f.single.seconds} seconds")["start"]
    day = ts.cast("date")
    if f.months:
        begin = _month_begin(day, f)
        label = _month_label(begin, f)
        if f.on_business_days:
            # Days before the first business day belong to the period before, days after the last to the next.
            size = f.single.months
            beyond = day > label if f.is_end_label else day < label
            label = F.when(beyond, _month_label(F.add_months(begin, size if f.is_end_label else -size), f)).otherwise(label)
        return label
    if f.code == "W":
        return F.next_day(F.date_sub(day, 1), f.weekday)
    if f.code == "B":
        return _business(day, forward=False)
    if f.code == "SMS":
        return F.date_add(F.trunc(day, "MM"), F.when(F.day(day) >= 15, 14).otherwise(0))
    if f.code == "SME":
        last, begin = F.last_day(day), F.trunc(day, "MM")
        return F.when(day == last, last).when(F.day(day) >= 15, F.date_add(begin, 14)).otherwise(F.date_sub(begin, 1))
    return day


def regrouped(label: Column, first: Column, freq: str | Frequency) -> Column:
    """The label of a multiple's period from the single period's ``label``; periods count from ``first``,
    the first label of the series, which is a label of the multiple too. Durations count from the
    midnight before it."""
    f = resolve_freq(freq)
    if f.seconds:
        first = F.date_trunc("DAY", first).cast("timestamp_ntz")
    steps = periods_between(first, label, f.single)
    whole = F.ceil(steps / f.multiple) if f.closes_right else F.floor(steps / f.multiple)
    return shift_label(first, f, whole.cast("int"))


def shift_label(label: Column, freq: str | Frequency, steps: Column) -> Column:
    """The label ``steps`` periods after ``label``."""
    f = resolve_freq(freq)
    steps = steps.cast("int")
    if f.on_grid:
        return _at_ordinal(_ordinal(label, f) + steps * f.multiple, f)
    if f.months:
        moved = F.add_months(F.trunc(label, "MM") if f.on_business_days else label, steps * f.months)
        moved = F.last_day(moved) if f.is_end_label else moved
        return _business(moved, not f.is_end_label) if f.on_business_days else moved
    if f.days:
        return F.date_add(label, steps * f.days)
    return label + F.make_dt_interval(secs=(steps * f.seconds).cast("decimal(18,6)"))


def periods_between(start: Column, end: Column, freq: str | Frequency) -> Column:
    """Number of calendar steps from label ``start`` to label ``end``."""
    f = resolve_freq(freq)
    if f.on_grid:
        return ((_ordinal(end, f) - _ordinal(start, f)) / f.multiple).cast("int")
    if f.months:
        months = (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)
        return (months / f.months).cast("int")
    if f.days:
        return (F.date_diff(end, start) / f.days).cast("int")
    return (F.timestamp_diff("SECOND", start, end) / f.seconds).cast("int")


def day_number(label: Column) -> Column:
    """Days since 1970-01-01 as a double; keeps the time of day of timestamps."""
    seconds = F.hour(label) * 3600 + F.minute(label) * 60 + F.second(label)
    return F.unix_date(label.cast("date")).cast("double") + seconds / _DAY


def fiscal_quarter(day: Column, start_month: int = 4) -> Column:
    """Quarter of the financial year that begins in ``start_month`` (April by default)."""
    return (F.floor(F.pmod(F.month(day) - start_month, F.lit(12)) / 3) + 1).cast("int")


def calendar_columns(
    day: Column,
    festive_months=FESTIVE_MONTHS,
    fy_start: int = 4,
    month_flags: dict[str, tuple[int, ...]] | None = None,
) -> dict[str, Column]:
    """Calendar features of ``day``; ``month_flags`` adds 0/1 columns such as ``is_summer``."""
    month = F.month(day)
    out = {
        "dayofweek": F.weekday(day),
        "day": F.dayofmonth(day),
        "month": month,
        "quarter": F.quarter(day),
        "year": F.year(day),
        "dayofyear": F.dayofyear(day),
        "is_weekend": (F.weekday(day) >= 5).cast("int"),
        "is_festive_month": month.isin(*festive_months).cast("int"),
        "india_fy_quarter": fiscal_quarter(day, fy_start),
    }
    for name, months in (month_flags or {}).items():
        out[name] = month.isin(*months).cast("int")
    return out
