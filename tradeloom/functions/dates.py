"""Dates, times and calendar arithmetic. Time is always a parameter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradeloom.functions.numbers import WHITE_SPACE, as_column, strip

ISO_TEXT = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"
    r"([T ][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,9})?)?)?"
    r"(Z|[+-][0-9]{2}:[0-9]{2})?$"
)
OFFSET_TEXT = r"(Z|[+-][0-9]{2}:[0-9]{2})$"

# Russian month names, nominative and genitive.
RU_MONTHS = {
    "январь": 1, "января": 1, "февраль": 2, "февраля": 2, "март": 3, "марта": 3,
    "апрель": 4, "апреля": 4, "май": 5, "мая": 5, "июнь": 6, "июня": 6,
    "июль": 7, "июля": 7, "август": 8, "августа": 8, "сентябрь": 9, "сентября": 9,
    "октябрь": 10, "октября": 10, "ноябрь": 11, "ноября": 11, "декабрь": 12, "декабря": 12,
}


def ensure_offset(value: Column | str, naive_offset: str = "+03:00") -> Column:
    """Append an offset to ISO text that has none."""
    text = strip(as_column(value).cast("string"))
    has_offset = (F.length(text) > 10) & F.substring(text, 11, 40).rlike(OFFSET_TEXT)
    return F.when((text == "") | has_offset, text).otherwise(F.concat(text, F.lit(naive_offset)))


def parse_ts(value: Column | str, naive_offset: str = "Z") -> Column:
    """ISO 8601 text to TIMESTAMP; text without an offset is read at ``naive_offset``."""
    text = strip(as_column(value).cast("string"))
    tail = F.substring(text, 17, 40)
    clock = F.when(F.length(text) == 10, "00:00").otherwise(F.substring(text, 12, 5))
    seconds = F.when(tail.startswith(":"), F.lit("")).otherwise(":00")
    sign = F.substring(text, -6, 1)
    has_offset = (F.length(text) > 16) & (text.endswith("Z") | (sign == "+") | (sign == "-"))
    offset = F.when(has_offset, F.lit("")).otherwise(naive_offset)
    full = F.concat(F.substring(text, 1, 10), F.lit("T"), clock, seconds, tail, offset)
    return F.when(text.rlike(ISO_TEXT), full.try_cast("timestamp"))


def parse_date_iso(value: Column | str) -> Column:
    """Calendar date of ISO text, in the text's own offset."""
    text = strip(as_column(value).cast("string"))
    return F.when(text.rlike(ISO_TEXT), F.substring(text, 1, 10).try_cast("date"))


def parse_ru_month_year(value: Column | str) -> Column:
    """Month name and four-digit year in any order to the first of that month."""
    # what ``strip`` gives, with the text searched once
    text = F.btrim(F.regexp_replace(F.lower(as_column(value).cast("string")), r"[,\s]+", " "), F.lit(WHITE_SPACE))
    words = F.transform(F.split(text, " "), lambda w: F.regexp_replace(w, r"^[.]+|[.]+$", ""))
    pairs: list[Column] = []
    for name, number in RU_MONTHS.items():
        pairs += [F.lit(name), F.lit(number)]
    month_of = F.create_map(*pairs)
    months = F.filter(F.transform(words, lambda w: F.try_element_at(month_of, w)), lambda m: m.isNotNull())
    years = F.filter(words, lambda w: w.rlike("^[0-9]{4}$"))
    month = F.try_element_at(months, F.lit(-1))
    year = F.try_element_at(years, F.lit(-1))
    return F.concat_ws("-", year, F.lpad(month.cast("string"), 2, "0"), F.lit("01")).try_cast("date")


def parse_date_multi(value: Column | str) -> Column:
    """yyyy-MM-dd, dd.MM.yyyy, dd/MM/yyyy on the first ten characters, then ISO, then month name."""
    text = strip(as_column(value).cast("string"))
    head = F.btrim(F.substring(text, 1, 10), F.lit(WHITE_SPACE))
    iso = F.when(head.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"), head.try_cast("date"))
    turned = F.regexp_replace(head, r"^([0-9]{1,2})[./]([0-9]{1,2})[./]([0-9]{4})$", "$3-$2-$1")
    dotted = F.when(
        head.rlike(r"^[0-9]{1,2}[.][0-9]{1,2}[.][0-9]{4}$")
        | head.rlike(r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$"),
        turned.try_cast("date"),
    )
    return F.coalesce(iso, dotted, parse_date_iso(text), parse_ru_month_year(text))


def report_date(value: Column | str) -> Column:
    """Date at the start of report text; other text gives null."""
    text = as_column(value)
    return F.when(text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"), F.substring(text, 1, 10).try_cast("date"))


def local_date(ts: Column | str, zone: str = "UTC") -> Column:
    """Calendar date of an instant in ``zone``; the session works in UTC."""
    if zone == "UTC":
        return F.to_date(as_column(ts))
    return F.to_date(F.from_utc_timestamp(as_column(ts), zone))


def on_local_days(times: list[str], zone: str, first: Column, last: Column) -> Column:
    """The first filled time column falls on a day of ``zone`` from ``first`` to ``last``.

    The exact test on the shifted date is preceded by a wider range on the bare columns,
    which reaches the scan.
    """
    wide = F.lit(False)
    earlier_empty = F.lit(True)
    for name in times:
        inside = (F.col(name) >= F.date_sub(first, 1)) & (F.col(name) < F.date_add(last, 2))
        wide = wide | (earlier_empty & inside)
        earlier_empty = earlier_empty & F.col(name).isNull()
    return wide & local_date(F.coalesce(*times), zone).between(first, last)


def utc(ts: Column | str) -> Column:
    """TIMESTAMP_NTZ holding UTC wall time to TIMESTAMP, whatever the session zone is."""
    return F.from_utc_timestamp(as_column(ts).cast("timestamp"), F.current_timezone())


def month_start_back(day: Column | str, months: int = 2) -> Column:
    """First day of the month ``months`` before ``day``."""
    return F.trunc(F.add_months(as_column(day), -months), "MM")


def same_day_last_month(day: Column | str) -> Column:
    """Same day of the previous month, clamped to its end."""
    return F.add_months(as_column(day), -1)


def minus_minutes(ts: Column | str, minutes: Column | int) -> Column:
    """Cursor moved back; negative lookbacks count as 0, seconds are whole."""
    amount = F.greatest(minutes if isinstance(minutes, Column) else F.lit(minutes), F.lit(0))
    return F.date_trunc("second", as_column(ts)) - F.make_dt_interval(mins=amount.cast("int"))


def first_run_cursor(as_of: Column | str, days_back: int) -> Column:
    """Start of the first load: at least one day before ``as_of``."""
    return F.date_trunc("second", as_column(as_of)) - F.make_dt_interval(days=F.lit(max(1, days_back)))


def year_start(as_of: Column | str) -> Column:
    return F.date_trunc("year", as_column(as_of))
