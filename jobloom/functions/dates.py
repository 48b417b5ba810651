"""Date functions.  Dates stay ISO text; comparisons are on the first ten characters, never on shifted instants."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from jobloom import fixed_values as fx
from jobloom.functions.text import lookup, once, squeeze, strip, text_or_blank


def day(c: Column) -> Column:
    """First ten characters."""
    return F.substring(text_or_blank(c), 1, 10)


def _utc_text(seconds: Column) -> Column:
    """Epoch seconds as ISO text with offset, independent of the session time zone."""
    days = F.floor(seconds / 86400)
    rest = seconds - days * 86400
    clock = F.concat_ws(
        ":",
        F.lpad(F.floor(rest / 3600).cast("string"), 2, "0"),
        F.lpad((F.floor(rest / 60) % 60).cast("string"), 2, "0"),
        F.lpad((rest % 60).cast("string"), 2, "0"),
    )
    date = F.date_add(F.lit("1970-01-01").cast("date"), days.cast("int"))
    return F.concat(date.cast("string"), F.lit("T"), clock, F.lit("+00:00"))


def epoch_date(c: Column) -> Column:
    """Epoch seconds or milliseconds as ISO text; blank when not an integer."""
    number = strip(c.cast("string")).try_cast("bigint")
    seconds = F.when(number > 10_000_000_000, F.floor(number / 1000)).otherwise(number)
    return once(seconds, lambda s: F.coalesce(F.when(s.between(-62135596800, 253402300799), _utc_text(s)), F.lit("")))


_STAMP = r"^(\d{4}-\d{2}-\d{2})[T\s](\d{2}):(\d{2})(?::(\d{2})(?:[.,]\d+)?)?(Z|[+-]\d{2}:?\d{2})?$"


def iso_date(c: Column | str) -> Column:
    """Normalise a portal date.

    Integers above ten million are epoch seconds (milliseconds above ten billion), whatever they look like; ISO
    date-times keep their offset; otherwise the leading date, or blank.
    """
    raw = (F.col(c) if isinstance(c, str) else c).cast("string")
    return once(strip(raw), _iso_date)


def _iso_date(text: Column) -> Column:
    number = text.try_cast("bigint")
    date, hour, minute, second, zone = (F.regexp_extract(text, _STAMP, g) for g in range(1, 6))
    real = (
        F.try_to_date(F.nullif(date, F.lit("")), "yyyy-MM-dd").isNotNull()
        & (hour <= "23") & (minute <= "59") & (second <= "59")
    )
    offset = (
        F.when(zone == "Z", "+00:00")
        .when(zone.rlike(r"^[+-]\d{4}$"), F.concat(F.substring(zone, 1, 3), F.lit(":"), F.substring(zone, 4, 2)))
        .otherwise(zone)
    )
    stamp = F.concat(
        date, F.lit("T"), hour, F.lit(":"), minute, F.lit(":"), F.coalesce(F.nullif(second, F.lit("")), F.lit("00")), offset
    )
    return F.coalesce(
        F.when(number > 10_000_000, epoch_date(text)),
        F.when((date != "") & real, stamp),
        F.regexp_extract(text, r"^(\d{4}-\d{2}-\d{2})", 1),
        F.lit(""),
    )


def publication_cutoff(today: Column, months: int = 2) -> Column:
    """Same day some months earlier, clamped to the end of a shorter month, as ISO text."""
    return F.add_months(today.cast("date"), -max(0, months)).cast("string")


def local_day(moment: Column | str, zone: str = "America/Fortaleza") -> Column:
    """Calendar day of the newsroom at a moment in UTC."""
    return F.from_utc_timestamp(moment, zone).cast("date")


def local_today(zone: str = "America/Fortaleza") -> Column:
    """The newsroom's day now; jobs should pass ``today`` explicitly and only default to this."""
    return local_day(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), zone)


def _iso(year: Column, month: Column, dom: Column) -> Column:
    """ISO text for a date given as numbers, NULL when there is no such day."""
    text = F.concat_ws(
        "-", F.lpad(year.cast("string"), 4, "0"), F.lpad(month.cast("string"), 2, "0"), F.lpad(dom.cast("string"), 2, "0")
    )
    return F.try_to_date(text, "yyyy-MM-dd").cast("string")


def _month_number(name: Column) -> Column:
    return lookup({k: str(v) for k, v in fx.MONTHS.items()}, name).cast("int")


def relative_date(c: Column | str, today: Column) -> Column:
    """``hoje``, ``ontem``, ``há 3 dias``, ``12 mar``, ``12 mar 2024``; a day further ahead than tomorrow is last year's."""
    text = F.lower(squeeze(text_or_blank(c)))
    today = today.cast("date")
    ago, dom, month, year = (F.regexp_extract(text, fx.CARD_DATE_LINE, g) for g in range(1, 5))
    in_year = _iso(F.when(year != "", year.try_cast("int")).otherwise(F.year(today)), _month_number(month), dom)
    last_year = _iso(F.year(today) - 1, _month_number(month), dom)
    rolls_back = (year == "") & (in_year > F.date_add(today, 1).cast("string"))
    return F.coalesce(
        F.when(text == "hoje", today.cast("string"))
        .when(text == "ontem", F.date_sub(today, 1).cast("string"))
        .when(ago != "", F.date_sub(today, ago.try_cast("int")).cast("string"))
        .when(month != "", F.when(rolls_back, last_year).otherwise(in_year)),
        F.lit(""),
    )


def short_date(c: Column | str, today: Column) -> Column:
    """``12 mar``; a month after the current one belongs to last year.  The day itself is not checked."""
    text = F.lower(text_or_blank(c))
    dom, name = (F.regexp_extract(text, r"(\d{1,2})\s+([a-zç]{3})", g) for g in (1, 2))
    month = _month_number(name)
    year = F.year(today.cast("date")) - (month > F.month(today.cast("date"))).cast("int")
    iso = F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), F.lpad(month.cast("string"), 2, "0"), F.lpad(dom, 2, "0"))
    return F.coalesce(F.when(month.isNotNull() & (dom != ""), iso), F.lit(""))


def english_date(c: Column | str) -> Column:
    """``Mar 5, 2024``."""
    return F.coalesce(F.try_to_date(squeeze(text_or_blank(c)), "MMM d, yyyy").cast("string"), F.lit(""))


def slash_date(c: Column | str) -> Column:
    """``05/03/2024`` (day first), anything after ten characters ignored."""
    return F.coalesce(F.try_to_date(F.substring(strip(text_or_blank(c)), 1, 10), "dd/MM/yyyy").cast("string"), F.lit(""))


_RFC = r"^(?:[A-Za-z]{3},\s*)?(\d{1,2})\s+([A-Za-z]{3})\s+(\d{4})\s+(\d{2}:\d{2})(:\d{2})?\s*([+-]\d{4}|GMT|UTC|UT|Z)?$"
_ENGLISH_MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")


def mail_date(c: Column | str) -> Column:
    """RFC 822 date as ISO text that keeps its offset; the weekday is ignored."""
    text = squeeze(text_or_blank(c))
    dom, name, year, clock, second, zone = (F.regexp_extract(text, _RFC, g) for g in range(1, 7))
    month = lookup({m: str(i + 1) for i, m in enumerate(_ENGLISH_MONTHS)}, F.lower(name))
    offset = (
        F.when(zone.rlike(r"^[+-]"), F.concat(F.substring(zone, 1, 3), F.lit(":"), F.substring(zone, 4, 2)))
        .when(zone == "", "")
        .otherwise("+00:00")
    )
    seconds = F.coalesce(F.nullif(second, F.lit("")), F.lit(":00"))
    return F.coalesce(F.concat(_iso(year, month, dom), F.lit("T"), clock, seconds, offset), F.lit(""))


def iso_instant(c: Column | str) -> Column:
    """Any valid ISO date or date-time as a UTC instant ``…T….mmmZ``; blank when it is not one."""
    text = strip(text_or_blank(c))
    millis = F.unix_millis(as_timestamp(text))
    seconds = F.floor(millis / 1000)
    part = F.lpad((millis - seconds * 1000).cast("string"), 3, "0")
    stamp = F.concat(F.substring(_utc_text(seconds), 1, 19), F.lit("."), part, F.lit("Z"))
    return F.coalesce(stamp, F.lit(""))


_ZONED = r"\d{2}:\d{2}.*(Z|[+-]\d{2}:?\d{2})$"


def as_timestamp(c: Column, clock: str = "00:00:00") -> Column:
    """ISO text to an instant; text without an offset is read as UTC, a bare date at ``clock``."""
    zoned = (
        F.when(F.length(c) == 10, F.concat(c, F.lit(f"T{clock}Z")))
        .when(c.rlike(_ZONED), c)
        .otherwise(F.concat(c, F.lit("Z")))
    )
    return F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}(?:$|[T\s])"), zoned.try_cast("timestamp"))


def activity_seconds(published: Column, seen: Column, now: Column) -> Column:
    """Epoch seconds of the last activity: publication, else last sighting, never later than ``now``; 0 if unknown.

    A date without a clock counts as noon UTC.
    """
    seconds = [F.nullif(F.unix_seconds(as_timestamp(c, "12:00:00")), F.lit(0)) for c in (published, seen)]
    return F.least(F.coalesce(*seconds, F.lit(0)), F.unix_seconds(now))
