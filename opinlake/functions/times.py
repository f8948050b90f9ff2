"""Time functions on Columns: lenient parses that give null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def lenient_ntz(s: Column) -> Column:
    """A wall clock; an offset is dropped, not applied; a bare year is no time."""
    iso = F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?)?(Z|[+-]\d{2}:?\d{2})?$"), F.regexp_replace(s, r"(Z|[+-]\d{2}:?\d{2})$", "").try_cast("timestamp_ntz"))
    compact = F.when(s.rlike(r"^\d{8}T\d{6}Z?$"), F.try_to_timestamp(F.regexp_replace(s, "Z$", ""), F.lit("yyyyMMdd'T'HHmmss")).cast("timestamp_ntz"))
    return F.coalesce(iso, compact)


def iso_utc(s: Column) -> Column:
    """An instant in the form ...Z at seconds; no offset means UTC; null where it can't be read."""
    compact = F.when(s.rlike(r"^\d{8}T\d{6}Z?$"), F.try_to_timestamp(F.regexp_replace(s, "Z$", ""), F.lit("yyyyMMdd'T'HHmmss")))
    ts = F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}"), s.try_cast("timestamp"))
    return F.date_format(F.coalesce(ts, compact), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def forum_time(s: Column, year: Column) -> Column:
    """Forum stamps with a year, or without one in the post's year; 29 February needs its year written."""
    full = F.when(s.rlike(r"^\d{4}\.\d{2}\.\d{2} \d{2}:\d{2}:\d{2}$"), F.try_to_timestamp(s, F.lit("yyyy.MM.dd HH:mm:ss")))
    short = F.when(s.rlike(r"^\d{2}\.\d{2} \d{2}:\d{2}:\d{2}$") & ~F.startswith(s, F.lit("02.29")), F.try_to_timestamp(F.concat(year.cast("string"), F.lit("."), s), F.lit("yyyy.MM.dd HH:mm:ss")))
    return F.coalesce(full, short).cast("timestamp_ntz")


_DAY = r"(\d{1,2})[./-](\d{1,2})(?:\s+(\d{1,2}):(\d{2})(?::(\d{2}))?)?"


def _moment(year: Column, parts: list[Column]) -> Column:
    whole = [F.coalesce(F.nullif(x, F.lit("")), F.lit("0")) for x in parts]
    return F.try_to_timestamp(F.concat(year.cast("string"), F.lit("-"), whole[0], F.lit("-"), whole[1], F.lit(" "), F.array_join(F.array(*whole[2:]), ":")), F.lit("yyyy-M-d H:m:s")).cast("timestamp_ntz")


def loose(s: Column) -> Column:
    """A wall clock out of a stamp among other words: parentheses dropped, ISO (an offset is dropped), else the first date with a year of four digits, of
    two (below 70 of this century), or the compact form."""
    t = F.trim(F.regexp_replace(F.regexp_replace(s, r"\([^)]*\)", " "), r"\s+", " "))
    get = lambda p, i: F.regexp_extract(t, p, i)
    long, short, compact = r"(\d{4})[./-]" + _DAY, r"(\d{2})[./-]" + _DAY, r"(\d{4})(\d{2})(\d{2})T(\d{2})(\d{2})(\d{2})Z?"
    y2 = get(short, 1).try_cast("int")
    by = lambda p, year: F.when(t.rlike(p), _moment(year, [get(p, i) for i in range(2, 7)]))
    iso = F.when(t.rlike(r"^\d{4}-?\d{2}-?\d{2}([T ]\d{2}:?\d{2}(:?\d{2}(\.\d{1,6})?)?)?(Z|[+-]\d{2}:?\d{2})?$"), lenient_ntz(t))
    return F.coalesce(iso, by(long, get(long, 1)), by(short, F.when(y2 < 70, y2 + 2000).otherwise(y2 + 1900)), by(compact, get(compact, 1)))


def listing(s: Column) -> Column:
    """A wall clock in one of the 18 forms of listings: a year of four or two digits (below 69 of this century), one separator among - . /, with or without a
    time of day; else the digits alone as yyyyMMddHHmmss, yyyyMMddHHmm or yyyyMMdd."""
    t = F.trim(s)
    form = r"^(\d{4}|\d{2})([-./])(\d{1,2})\2(\d{1,2})(?:\s+(\d{1,2}):(\d{1,2})(?::(\d{1,2}))?)?$"
    get = lambda i: F.regexp_extract(t, form, i)
    y = get(1).try_cast("int")
    year = F.when(F.length(get(1)) == 4, y).when(y < 69, y + 2000).otherwise(y + 1900)
    digits = F.regexp_replace(t, r"\D", "")
    fixed = lambda n, f: F.when(F.length(digits) == n, F.try_to_timestamp(digits, F.lit(f)).cast("timestamp_ntz"))
    return F.coalesce(F.when(t.rlike(form), _moment(year, [get(i) for i in range(3, 8)])), fixed(14, "yyyyMMddHHmmss"), fixed(12, "yyyyMMddHHmm"), fixed(8, "yyyyMMdd"))


def comment_clock(post_time: Column, comment_time: Column) -> Column:
    """A comment's stamp; a time of day alone takes its post's date, if that can be read."""
    c = F.trim(comment_time)
    day = F.date_format(lenient_ntz(F.trim(post_time)), "yyyy-MM-dd")
    return F.when(c == "", F.lit(None)).when(day.isNotNull() & F.contains(c, F.lit(":")) & ~F.contains(c, F.lit(" ")), F.concat(day, F.lit(" "), c)).otherwise(c)


def mentions(text: Column) -> tuple[Column, Column]:
    """(all moments with a time of day, all dates) that a text mentions, each sorted; two-digit years below 70 are of this century."""
    with_time = F.regexp_extract_all(text, F.lit(r"((?:\d{4}|\d{2})[./-]\d{1,2}[./-]\d{1,2} \d{1,2}:\d{2}(?::\d{2})?)"), F.lit(1))
    dates = F.regexp_extract_all(text, F.lit(r"((?:\d{4}|\d{2})[./-]\d{1,2}[./-]\d{1,2})"), F.lit(1))

    def read(x: Column, timed: bool) -> Column:
        n = lambda i: F.regexp_extract(x, r"^(\d+)[./-](\d+)[./-](\d+)(?: (\d+):(\d+)(?::(\d+))?)?", i)
        y = n(1).cast("int")
        year = F.when(F.length(n(1)) == 4, y).when(y < 70, y + 2000).otherwise(y + 1900)
        part = lambda i: F.coalesce(F.nullif(n(i), F.lit("")), F.lit("0"))
        clock = F.concat(part(4), F.lit(":"), part(5), F.lit(":"), part(6)) if timed else F.lit("0:0:0")
        return F.try_to_timestamp(F.concat(year.cast("string"), F.lit("-"), n(2), F.lit("-"), n(3), F.lit(" "), clock), F.lit("yyyy-M-d H:m:s")).cast("timestamp_ntz")

    keep = lambda a, timed: F.array_sort(F.filter(F.transform(a, lambda x: read(x, timed)), lambda t: t.isNotNull()))
    return keep(with_time, True), keep(dates, False)


def local_bounds(day: Column, zone: str) -> tuple[Column, Column]:
    """The UTC instants at which a local day begins and ends."""
    start = F.to_utc_timestamp(day.cast("timestamp"), zone)
    return start, F.to_utc_timestamp(F.date_add(day, 1).cast("timestamp"), zone)


def selection_date(value: Column) -> Column:
    """The date of a chart selection: epoch milliseconds or seconds, or an ISO string."""
    n = value.try_cast("double")
    return F.when(n > 1e12, F.timestamp_millis(n.cast("long"))).when(n > 1e9, F.timestamp_seconds(n.cast("long"))).otherwise(F.when(value.rlike(r"^\d{4}-\d{2}-\d{2}"), value.try_cast("timestamp"))).cast("date")
