"""Text to calendar parts, and the offsets of a time zone as a table of intervals."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone
from functools import lru_cache
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession

# Month names and abbreviations, English and French, lower case without accents.
MONTHS = {
    "jan": 1, "january": 1, "janv": 1, "janvier": 1,
    "feb": 2, "february": 2, "fev": 2, "fevr": 2, "fevrier": 2,
    "mar": 3, "march": 3, "mars": 3,
    "apr": 4, "april": 4, "avr": 4, "avril": 4,
    "may": 5, "mai": 5,
    "jun": 6, "june": 6, "juin": 6,
    "jul": 7, "july": 7, "juil": 7, "juillet": 7,
    "aug": 8, "august": 8, "aout": 8,
    "sep": 9, "sept": 9, "september": 9, "septembre": 9,
    "oct": 10, "october": 10, "octobre": 10,
    "nov": 11, "november": 11, "novembre": 11,
    "dec": 12, "december": 12, "decembre": 12,
}

_TIME = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d{1,9}))?)?\s*([AaPp]\.?[Mm]\.?)?"
_ZONE = r"\s*([Zz]|UTC|GMT|EST|EDT|[+-]\d{2}(?::?\d{2})?)?"
_WEEKDAY = r"(?:[A-Za-z]{3,9}\.?,?\s+)?"
_TAIL = rf"(?:[Tt,\s]\s*{_TIME}{_ZONE})?$"
_YMD = rf"^(\d{{4}})[-/.](\d{{1,2}})[-/.](\d{{1,2}}){_TAIL}"
_COMPACT = r"^(\d{4})(\d{2})(\d{2})(?:[Tt ]?(\d{2})(\d{2})(\d{2})?(?:[.,](\d{1,9}))?" + _ZONE + r")?$"
_DMY_NAME = rf"^{_WEEKDAY}(\d{{1,2}})(?:er|st|nd|rd|th)?[-\s/]+(\p{{L}}{{3,9}})\.?[-\s/,]+(\d{{4}}|\d{{2}}){_TAIL}"
_MDY_NAME = rf"^{_WEEKDAY}(\p{{L}}{{3,9}})\.?\s+(\d{{1,2}})(?:st|nd|rd|th)?,?\s+(\d{{4}}|\d{{2}}){_TAIL}"
SLASHED = rf"^(\d{{1,2}})/(\d{{1,2}})/(\d{{4}}|\d{{2}}){_TAIL}"
_NUMBER = r"^-?\d+(?:\.\d+)?$"
DAY_US = 86_400_000_000


def text(c: str) -> str:
    """Without white space, of any script, at the ends. (The functions here give SQL text: a plan
    built of a few texts is made far sooner than one of hundreds of Column calls.)"""
    return rf"regexp_replace({c}, r'(?U)^[\s\u00a0]+|[\s\u00a0]+$', '')"


def canonical(s: str) -> str:
    """kind~year~month~day~hour~minute~second~fraction~am/pm~zone. Kind s: month and day as they
    stand between slashes; n: a number, in place of the year; null: no notation that is known."""
    to = lambda pattern, form: f"regexp_replace({s}, r'{pattern}', '{form}')"
    return rf"""case
        when {s} rlike r'{_YMD}' then {to(_YMD, "c~$1~$2~$3~$4~$5~$6~$7~$8~$9")}
        when {s} rlike r'{SLASHED}' then {to(SLASHED, "s~$3~$1~$2~$4~$5~$6~$7~$8~$9")}
        when {s} rlike r'{_NUMBER}' then case
            when {s} rlike r'^(19\d\d|20\d\d|2100)$' then concat('c~', {s}, '~1~1~~~~~~')
            when {s} rlike r'^(19|20)\d\d(0[1-9]|1[0-2])$' then concat('c~', left({s}, 4), '~', right({s}, 2), '~1~~~~~~')
            when length(substring_index({s}, '.', 1)) in (8, 12, 14) and {s} rlike r'^(19|20)\d+$' then {to(_COMPACT, "c~$1~$2~$3~$4~$5~$6~$7~~$8")}
            else concat('n~', {s}, '~~~~~~~~') end
        when {s} rlike r'{_COMPACT}' then {to(_COMPACT, "c~$1~$2~$3~$4~$5~$6~$7~~$8")}
        when {s} rlike r'{_DMY_NAME}' then {to(_DMY_NAME, "c~$3~$2~$1~$4~$5~$6~$7~$8~$9")}
        when {s} rlike r'{_MDY_NAME}' then {to(_MDY_NAME, "c~$3~$1~$2~$4~$5~$6~$7~$8~$9")}
        end"""


def month_of(c: str) -> str:
    names = ", ".join(f"'{k}', {v}" for k, v in MONTHS.items())
    folded = f"translate(lower({c}), 'éèêàâäùûüôöîïç', 'eeeaaauuuooiic')"
    return rf"case when {c} rlike r'^\d' then try_cast({c} as int) else try_element_at(map({names}), {folded}) end"


def epoch_days(y: str, m: str, d: str) -> str:
    """Days since 1970-01-01 in the Gregorian calendar, null where there is no such date."""
    yy = f"(cast({y} as bigint) + 4800 - (14 - {m}) div 12)"
    mm = f"({m} + 12 * ((14 - {m}) div 12) - 3)"
    jdn = f"({d} + (153 * {mm} + 2) div 5 + 365 * {yy} + {yy} div 4 - {yy} div 100 + {yy} div 400 - 32045)"
    leap = f"(({y} % 4 = 0 and {y} % 100 != 0) or {y} % 400 = 0)"
    last = f"(case when {m} = 2 then case when {leap} then 29 else 28 end when {m} in (4, 6, 9, 11) then 30 else 31 end)"
    return f"case when {y} between 1000 and 9999 and {m} between 1 and 12 and {d} >= 1 and {d} <= {last} then {jdn} - 2440588 end"


def day_us(h: str, mi: str, s: str, frac: str, ap: str) -> str:
    """Microseconds since midnight; 0 where there is no time, null where it is impossible."""
    hi, mii, si = (f"try_cast({x} as int)" for x in (h, mi, s))
    pm = f"case when lower(left({ap}, 1)) = 'p' then 12 else 0 end"
    hour = f"case when {ap} = '' then case when {hi} <= 23 then {hi} end when {hi} between 1 and 12 then {hi} % 12 + {pm} end"
    us = f"coalesce(try_cast(rpad(left({frac}, 6), 6, '0') as bigint), 0)"
    return f"""case when {h} = '' then 0L when coalesce({mii}, 0) <= 59 and coalesce({si}, 0) <= 59 then
        (cast({hour} as bigint) * 3600 + coalesce({mii}, 0) * 60 + coalesce({si}, 0)) * 1000000L + {us} end"""


def zone_us(z: str) -> str:
    """The offset stated, in microseconds; null where none is."""
    digits = f"rpad(regexp_replace({z}, r'[^0-9]', ''), 4, '0')"
    minutes = f"(try_cast(left({digits}, 2) as int) * 60 + try_cast(substr({digits}, 3, 2) as int))"
    return f"""case when {z} in ('Z', 'z', 'UTC', 'GMT') then 0L when {z} = 'EST' then -18000000000L when {z} = 'EDT' then -14400000000L
        when left({z}, 1) = '-' then -60000000L * {minutes} when left({z}, 1) = '+' then 60000000L * {minutes} end"""


def number_us(s: str) -> tuple[str, str]:
    """Of a number: (local microseconds, of spreadsheet days; UTC microseconds, of seconds,
    milliseconds, microseconds or nanoseconds since 1970), by its magnitude: days up to the last one
    spreadsheets know (9999-12-31), seconds up to the year 5138, then the finer units, each from
    March 1973 on. Days before 61 are one later, as spreadsheets count a 29 February 1900."""
    x = f"try_cast({s} as decimal(28,9))"
    days = f"case when {x} >= 1 and {x} < 2958466 then cast(round(({x} - 25569 + case when {x} < 60 then 1 else 0 end) * {DAY_US}L, 0) as bigint) end"
    utc = f"""case when abs({x}) < 2958466 then null when abs({x}) < 100000000000 then cast(floor({x} * 1000000) as bigint)
        when abs({x}) < 100000000000000 then cast(floor({x} * 1000) as bigint) when abs({x}) < 100000000000000000 then cast(floor({x}) as bigint)
        else cast(floor({x} / 1000) as bigint) end"""
    return days, utc


FIRST_YEAR, LAST_YEAR = 1840, 2100


def zone_year(y: str) -> str:
    """The year of the offset table that holds for a local year: before the table its first one
    (zones had one offset then), after it one of its last 28 that begins on the same day of the
    week and is as long, as the rules in force go by days of the week."""
    from datetime import date

    leap = lambda n: n % 4 == 0 and (n % 100 != 0 or n % 400 == 0)
    like = {(leap(n), (date(n, 1, 1) - date(1970, 1, 1)).days % 7): n for n in range(2072, 2100)}
    names = ", ".join(f"{7 * a + b}, {n}" for (a, b), n in sorted(like.items()))
    long = f"case when ({y} % 4 = 0 and {y} % 100 != 0) or {y} % 400 = 0 then 7 else 0 end"
    after = f"try_element_at(map({names}), cast({long} + pmod({epoch_days(y, '1', '1')}, 7) as int))"
    return f"case when {y} > {LAST_YEAR} then {after} else greatest({y}, {FIRST_YEAR}) end"


@lru_cache
def offset_intervals(zone: str, first_year: int = FIRST_YEAR, last_year: int = LAST_YEAR) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """For each local year the intervals of constant offset that touch it, as (year,
    [(local start, local end, offset)]) in microseconds, the end exclusive. Where clocks go back two
    intervals overlap in local time; where they go forward there is a gap. The size is bounded by
    the years and the zone's rules: about five intervals a year at most."""
    tz, epoch = ZoneInfo(zone), datetime(1970, 1, 1, tzinfo=timezone.utc)
    off = lambda s: int((epoch + timedelta(seconds=s)).astimezone(tz).utcoffset().total_seconds())
    begin = int((datetime(first_year, 1, 1, tzinfo=timezone.utc) - epoch).total_seconds()) - 86400
    end = int((datetime(last_year + 1, 1, 1, tzinfo=timezone.utc) - epoch).total_seconds()) + 86400
    spans, start, at = [], begin, off(begin)
    for day in range(begin, end, 86400):
        if (b := off(day + 86400)) != at:
            lo, hi = day, day + 86400
            while hi - lo > 1:
                mid = (lo + hi) // 2
                lo, hi = (mid, hi) if off(mid) == at else (lo, mid)
            spans.append((start, hi, at))
            start, at = hi, b
    spans.append((start, end, at))
    out = []
    for y in range(first_year, last_year + 1):
        lo = int((datetime(y, 1, 1, tzinfo=timezone.utc) - epoch).total_seconds())
        hi = int((datetime(y + 1, 1, 1, tzinfo=timezone.utc) - epoch).total_seconds())
        own = [((a + o) * 1_000_000, (b + o) * 1_000_000, o * 1_000_000) for a, b, o in spans if a + o < hi and b + o > lo]
        out.append((y, own))
    return out


def offset_table(spark: SparkSession, zone: str, first_year: int = FIRST_YEAR, last_year: int = LAST_YEAR) -> DataFrame:
    rows = ", ".join(
        f"({y}, array({', '.join(f'struct({lo}L as lo, {hi}L as hi, {off}L as off)' for lo, hi, off in own)}))" for y, own in offset_intervals(zone, first_year, last_year)
    )
    return spark.sql(f"select * from values {rows} as t(zone_year, spans)")
