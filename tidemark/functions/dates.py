"""Calendar helpers: business days, sessions, vendor period formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.numeric import as_col


def next_business_day(d: Column | str) -> Column:
    """Following weekday; holidays are not considered."""
    d = as_col(d)
    step = F.when(F.weekday(d) == 4, 3).when(F.weekday(d) == 5, 2).otherwise(1)
    return F.date_add(d, step)


def shift_back_business_days(d: Column | str, n: int) -> Column:
    """Weekday ``n`` business days earlier (weekends first roll back to Friday)."""
    d = as_col(d)
    wd = F.weekday(d)
    rolled = F.when(wd >= 5, F.date_sub(d, wd - 4)).otherwise(d)
    weeks, rest = divmod(n, 5)
    extra = F.when(F.weekday(rolled) < rest, rest + 2).otherwise(rest)
    return F.date_sub(rolled, extra + weeks * 7)


def in_preview_window(ts: Column | str) -> Column:
    """P29. From 18:00 or up to 08:30 inclusive."""
    t = F.date_format(as_col(ts), "HH:mm:ss.SSSSSS")
    return (t >= "18:00:00.000000") | (t <= "08:30:00.000000")


def reference_session(ts: Column | str) -> Column:
    """P29. Session a preview made at ``ts`` refers to."""
    ts = as_col(ts)
    day = ts.cast("date")
    early = F.date_format(ts, "HH:mm:ss.SSSSSS") <= "08:30:00.000000"
    return F.when(early & (F.weekday(day) < 5), day).otherwise(next_business_day(day))


def month_from_period(year: Column | str, period: Column | str) -> Column:
    """S9. Year and M01..M12 to the month start; M13 and other codes give null."""
    p = as_col(period)
    ok = p.rlike("^M(0[1-9]|1[0-2])$")
    return F.when(ok, F.make_date(as_col(year).cast("int"), F.substring(p, 2, 2).try_cast("int"), F.lit(1)))


def date_from_period(period: Column | str) -> Column:
    """S10. YYYYQn, YYYYMmm or YYYY to the first day of the period."""
    p = F.upper(F.trim(as_col(period)))
    year = F.substring(p, 1, 4).try_cast("int")
    tail = F.substring(p, 6, 2).try_cast("int")
    return (F.when(p.rlike("^[0-9]{4}Q[1-4]$"), F.make_date(year, (tail - 1) * 3 + 1, F.lit(1)))
            .when(p.rlike("^[0-9]{4}M(0[1-9]|1[0-2])$"), F.make_date(year, tail, F.lit(1)))
            .when(p.rlike("^[0-9]{4}$"), F.make_date(year, F.lit(1), F.lit(1))))


def date_from_length(period: Column | str) -> Column:
    """S11, S13. Period text of 10, 8, 7, 6 or 4 characters to a date."""
    p = F.trim(as_col(period))
    n = F.length(p)
    return (F.when(n == 10, F.try_to_date(p, "yyyy-MM-dd")).when(n == 8, F.try_to_date(p, "yyyyMMdd"))
            .when(n == 7, F.try_to_date(F.concat(p, F.lit("-01")), "yyyy-MM-dd"))
            .when(n == 6, F.try_to_date(F.concat(p, F.lit("01")), "yyyyMMdd"))
            .when(n == 4, F.try_to_date(F.concat(p, F.lit("-01-01")), "yyyy-MM-dd")))


def epoch_day(seconds: Column | str) -> Column:
    """UTC date of an epoch second, whatever the session zone."""
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(as_col(seconds) / 86400).cast("int"))


def elapsed_hours(later: Column | str, earlier: Column | str) -> Column:
    return F.timestamp_diff("SECOND", as_col(earlier), as_col(later)).cast("double") / 3600.0


def normalise_asof(text: Column | str, now: Column) -> Column:
    """Instant of an ISO text, capped at ``now``."""
    return F.least(F.try_to_timestamp(as_col(text)), now)


def as_instant(wall: Column | str) -> Column:
    """Instant whose UTC wall time is the zone-less timestamp, whatever the session zone."""
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), as_col(wall)).cast("timestamp")


def as_wall(instant: Column | str) -> Column:
    """UTC wall time of an instant as a zone-less timestamp."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), as_col(instant).cast("timestamp_ntz"))
