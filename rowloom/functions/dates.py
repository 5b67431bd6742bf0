"""Dates of postings and reports as ISO text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rowloom.functions.text import clean_text

# Forms tried after ISO, day first.
DAY_FIRST = ["d/M/yyyy H:mm:ss", "d/M/yyyy H:mm", "d/M/yyyy", "d-M-yyyy H:mm", "d-M-yyyy", "d.M.yyyy", "d MMM yyyy", "d MMMM yyyy"]


def _iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


# English names of months by their first three letters.
MONTHS = "jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec"
# Dates within other text: a pattern and the form of its rewriting, tried in this order.
WITHIN = [
    (r".*?\b(\d{4})-(\d{2})-(\d{2})\b.*", "$3 $2 $1", "d M yyyy"),
    (r".*?\b(\d{1,2})[/.-](\d{1,2})[/.-](\d{4})\b.*", "$1 $2 $3", "d M yyyy"),
    (rf"(?i).*?\b(\d{{1,2}})(?:st|nd|rd|th)?(?: of)? ({MONTHS})[a-z]*\.?,? (\d{{4}})\b.*", "$1 $2 $3", "d MMM yyyy"),
    (rf"(?i).*?\b({MONTHS})[a-z]*\.? (\d{{1,2}})(?:st|nd|rd|th)?,? (\d{{4}})\b.*", "$2 $1 $3", "d MMM yyyy"),
]


def _within(text: Column) -> list[Column]:
    found = []
    for pattern, rewriting, form in WITHIN:
        date = F.initcap(F.regexp_replace(text, pattern, rewriting))
        found.append(F.when(text.rlike(pattern), _iso(F.try_to_timestamp(date, F.lit(form)))))
    return found


def parse_date(col: Column, cleaned: bool = False) -> Column:
    """ISO form of a date; ISO input is read as such, other numeric dates day first.  A date within
    other text is found by its digits or its English month.  Text without a date stays as it is, null
    stays null."""
    text = col if cleaned else clean_text(col)
    iso = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), _iso(text.try_cast("timestamp")))
    found = [_iso(F.try_to_timestamp(text, F.lit(form))) for form in DAY_FIRST]
    return F.coalesce(iso, *found, *_within(text), text)


def iso_or_same(col: Column) -> Column:
    """ISO form of an ISO timestamp, with ``Z`` or offset; anything else stays."""
    return F.coalesce(F.when(col.rlike(r"^\d{4}-\d{2}-\d{2}"), _iso(col.try_cast("timestamp"))), col)


def mail_date(col: Column) -> Column:
    """The day of an RFC 2822 date, null if it is none."""
    ts = F.try_to_timestamp(F.regexp_extract(col, r"^\w{3}, (\d{2} \w{3} \d{4} \d{2}:\d{2}:\d{2})", 1), F.lit("dd MMM yyyy HH:mm:ss"))
    return F.date_format(ts, "yyyy-MM-dd")


def report_year(col: Column) -> Column:
    """The first year between 1900 and 2099, else -1."""
    return F.coalesce(F.regexp_extract(F.coalesce(col, F.lit("")), r"(19|20)\d{2}", 0).try_cast("int"), F.lit(-1))


def in_window(ts: Column, start: str, end: str, zone: str = "Europe/Madrid") -> Column:
    """Whether the local time lies in the window, which may cross midnight; equal ends are always."""
    at = F.date_format(F.from_utc_timestamp(ts, zone), "HH:mm")
    if start == end:
        return ts.isNotNull()
    return (at >= start) & (at < end) if start < end else (at >= start) | (at < end)


def seconds_until(ts: Column, start: str, zone: str = "Europe/Madrid") -> Column:
    """Seconds of local time until the next start of the window, at least 1."""
    local = F.from_utc_timestamp(ts, zone)
    now = F.hour(local) * 3600 + F.minute(local) * 60 + F.second(local)
    hour, minute = start.split(":")
    return F.greatest(F.lit(1), F.pmod(F.lit(int(hour) * 3600 + int(minute) * 60) - now - 1, F.lit(86400)) + 1)
