"""DT / STR scalars and generators as Column expressions (all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def minutes(n: int | Column) -> Column:
    """A day-time interval of ``n`` minutes."""
    if isinstance(n, int):
        return F.expr(f"INTERVAL {n} MINUTES")
    return F.make_dt_interval(F.lit(0), F.lit(0), n)


def day_start(ts: str | Column) -> Column:
    """Midnight of the timestamp's day, as timestamp_ntz."""
    return F.to_date(_c(ts)).cast("timestamp_ntz")


def day_points(day: str | Column, step_minutes: int) -> Column:
    """DT-1 / DT-2: every scheduled timestamp of a day (1440 / step of them)."""
    start = _c(day).cast("timestamp_ntz")
    last = start + minutes(1440 - step_minutes)
    return F.sequence(start, last, minutes(step_minutes))


# Wall-clock helpers for timestamp_ntz.  ``date_format`` / ``date_trunc`` /
# ``try_to_timestamp`` pass through the session time zone, which moves wall
# clocks that do not exist there (daylight-saving gaps); these work on fields.


def ntz_text(ts: str | Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of a timestamp_ntz (fraction dropped), independent of the session zone."""
    return F.substring(_c(ts).cast("string"), 1, 19)


def trunc_hour(ts: str | Column) -> Column:
    t = _c(ts)
    return F.make_timestamp_ntz(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), F.lit(0), F.lit(0))


def trunc_minute(ts: str | Column) -> Column:
    t = _c(ts)
    return F.make_timestamp_ntz(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), F.minute(t), F.lit(0))


def trunc_second(ts: str | Column) -> Column:
    t = _c(ts)
    return F.make_timestamp_ntz(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), F.minute(t), F.second(t))


def time_label(ts: str | Column) -> Column:
    """DT-9: ``HH:mm`` label of a timestamp."""
    t = _c(ts)
    return F.format_string("%02d:%02d", F.hour(t), F.minute(t))


def day_labels(step_minutes: int) -> Column:
    """DT-1: the ``HH:mm`` labels of all scheduled points of a day, in order."""
    return F.transform(day_points(F.lit("2000-01-01").cast("date"), step_minutes), time_label)


def seconds_of_day(ts: str | Column) -> Column:
    """Wall-clock seconds since midnight (independent of the session time zone)."""
    t = _c(ts)
    return F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)


def epoch_seconds(ts: str | Column) -> Column:
    """Wall-clock seconds since 1970-01-01 for a timestamp_ntz (no time-zone shifts, no DST)."""
    t = _c(ts)
    return F.unix_date(F.to_date(t)).cast("bigint") * 86400 + seconds_of_day(t)


def on_schedule(ts: str | Column, step_minutes: int) -> Column:
    """True when the timestamp sits exactly on the step grid of its day."""
    t = _c(ts)
    return (seconds_of_day(t) % (step_minutes * 60) == 0) & (trunc_second(t) == t)


def step_of_day(ts: str | Column, step_minutes: int) -> Column:
    """Position of a scheduled timestamp within its day (0-based)."""
    return F.floor(seconds_of_day(ts) / (step_minutes * 60)).cast("int")


def compact_time(ts: str | Column) -> Column:
    """STR-2: ``yyyyMMdd_HHmmss``."""
    t = _c(ts)
    return F.format_string("%04d%02d%02d_%02d%02d%02d", F.year(t), F.month(t), F.dayofmonth(t),
                           F.hour(t), F.minute(t), F.second(t))


def parse_fields(s: str | Column, pattern: str) -> Column:
    """timestamp_ntz from text whose regex groups are year, month, day[, hour, minute, second].

    Text that does not match, or names an impossible date or time, gives NULL.
    """
    t = _c(s)
    parts = [F.regexp_extract(t, pattern, i) for i in range(1, 7)]
    n = pattern.count("(")
    vals = [parts[i].cast("int") if i < n else F.lit(0) for i in range(6)]
    return F.when(t.rlike(pattern), F.try_make_timestamp_ntz(*vals[:5], vals[5].cast("decimal(8,6)")))


COMPACT_PATTERN = r"^(\d{4})(\d{2})(\d{2})_(\d{2})(\d{2})(\d{2})$"
EXACT_PATTERN = r"^(\d{4})-(\d{2})-(\d{2}) (\d{2}):(\d{2}):(\d{2})$"


def parse_compact_time(s: str | Column) -> Column:
    """Inverse of STR-2; unparsable text gives NULL."""
    return parse_fields(s, COMPACT_PATTERN)


def try_parse_exact(s: str | Column) -> Column:
    """DT-10 that gives NULL instead of failing (for reading files that may hold bad rows)."""
    return parse_fields(s, EXACT_PATTERN)


def parse_exact(s: str | Column) -> Column:
    """DT-10: exact ``yyyy-MM-dd HH:mm:ss``."""
    return F.to_timestamp_ntz(_c(s), F.lit("yyyy-MM-dd HH:mm:ss"))


def calendar(start: str | Column, end: str | Column) -> Column:
    """DT-3: inclusive array of dates."""
    return F.sequence(F.to_date(_c(start)), F.to_date(_c(end)), F.expr("INTERVAL 1 DAY"))


def chunk_index(day: str | Column, first_day: str | Column, days_per_chunk: int) -> Column:
    """DT-4: number of the k-day block a date falls in."""
    return F.floor(F.datediff(_c(day), _c(first_day)) / days_per_chunk).cast("bigint")


def regular_timestamp(start: str | Column, index: str | Column, step_minutes: int) -> Column:
    """DT-5: ``start + index * step`` with true calendar arithmetic (quirk Q13 not reproduced)."""
    total = _c(index).cast("bigint") * step_minutes
    return _c(start).cast("timestamp_ntz") + F.make_dt_interval(
        F.floor(total / 1440).cast("int"), F.lit(0), F.pmod(total, F.lit(1440)).cast("int"))


def slot_timestamp(s: str | Column) -> Column:
    """DT-6: ``yyyyMMddSS`` with half-hour slot 1..48 → timestamp."""
    t = _c(s)
    slot = F.substring(t, 9, 2).cast("int")
    return F.make_timestamp_ntz(
        F.substring(t, 1, 4).cast("int"), F.substring(t, 5, 2).cast("int"),
        F.substring(t, 7, 2).cast("int"), F.floor((slot - 1) / 2).cast("int"),
        ((slot - 1) % 2) * 30, F.lit(0))


# The layouts tried, in order, by the mixed-format parser (DT-7), as regexes whose
# groups are year, month, day, hour, minute, second (absent trailing groups are 0).
MIXED_FORMATS = (
    r"^(\d{4})-(\d{2})-(\d{2}) (\d{2}):(\d{2}):(\d{2})$",    # yyyy-MM-dd HH:mm:ss
    r"^(\d{4})-(\d{2})-(\d{2}) (\d{2}):(\d{2})$",            # yyyy-MM-dd HH:mm
    r"^(\d{4})-(\d{2})-(\d{2})T(\d{2}):(\d{2}):(\d{2})$",    # yyyy-MM-ddTHH:mm:ss
    r"^(\d{4})/(\d{2})/(\d{2}) (\d{2}):(\d{2}):(\d{2})$",    # yyyy/MM/dd HH:mm:ss
    r"^(\d{4})/(\d{2})/(\d{2}) (\d{2}):(\d{2})$",            # yyyy/MM/dd HH:mm
    r"^(\d{4})-(\d{2})-(\d{2})$",                             # yyyy-MM-dd
    r"^(\d{4})/(\d{2})/(\d{2})$",                             # yyyy/MM/dd
    r"^(\d{4})(\d{2})(\d{2})$",                               # yyyyMMdd
)


def parse_mixed(s: str | Column, formats: tuple[str, ...] = MIXED_FORMATS) -> Column:
    """DT-7: the first layout that matches wins; unparsable text gives NULL; seconds precision."""
    t = F.trim(_c(s))
    return F.coalesce(*[parse_fields(t, f) for f in formats])


def datetime_parts(ts: str | Column) -> Column:
    """DT-8: ``[year, month, day, hour, minute]``."""
    t = _c(ts)
    return F.array(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), F.minute(t))


def page_number(name: str | Column) -> Column:
    """STR-1: page number from a ``page<N>_...csv`` name; NULL when the name does not match."""
    n = _c(name)
    return F.when(n.rlike(r"^page\d+_.*\.csv$"),
                  F.regexp_extract(n, r"^page(\d+)_", 1).cast("bigint"))
