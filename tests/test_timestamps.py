"""Timestamps against a plain version with the standard library."""

from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest

from rowloom.operators.timestamps import normalise_timestamps

SOURCES = [("es", "Europe/Madrid", "DMY"), ("ca", "Atlantic/Canary", "DMY"), ("us", "UTC", "MDY")]


def wall(y, mo, d, h=0, mi=0, s=0, us=0, zone="Europe/Madrid"):
    """The earlier instant of a wall time that occurs twice; a skipped one moves forward."""
    t = datetime(y, mo, d, h, mi, s, us, ZoneInfo(zone), fold=0)
    return t.astimezone(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%fZ")


CASES = [
    ("es", "2024-01-08", wall(2024, 1, 8)),
    ("es", "2024-07-08T10:00", wall(2024, 7, 8, 10)),
    ("us", "2024-01-08 06:24:41.782", "2024-01-08T06:24:41.782000Z"),
    ("es", "2024-01-13T09:25:30+05:30", "2024-01-13T03:55:30.000000Z"),
    ("es", "2024-02-21 18:49:42-03", "2024-02-21T21:49:42.000000Z"),
    ("es", "2024-02-02 04:31:17-1000", "2024-02-02T14:31:17.000000Z"),
    ("es", "2024-01-09T23:42:43+01:00[Europe/Madrid]", "2024-01-09T22:42:43.000000Z"),
    ("us", "2024-07-09 17:43:17 CEST", "2024-07-09T15:43:17.000000Z"),
    ("us", "20240108T161713Z", "2024-01-08T16:17:13.000000Z"),
    ("ca", "1704941169", "2024-01-11T02:46:09.000000Z"),
    ("ca", "1704887270112", "2024-01-10T11:47:50.112000Z"),
    ("es", "8 de enero de 2024, 09:44", wall(2024, 1, 8, 9, 44)),
    ("es", "10-ENE-2024 16:32", wall(2024, 1, 10, 16, 32)),
    ("us", "Feb 8, 2024 12:58 AM", "2024-02-08T00:58:00.000000Z"),
    ("us", "Mon, 08 Jan 2024 06:26:14 +0100", "2024-01-08T05:26:14.000000Z"),
    ("es", "27/10/2024 02:19", wall(2024, 10, 27, 2, 19)),
    ("es", "31-03-2024 02:30", wall(2024, 3, 31, 3, 30)),
    ("ca", "30-03-2025 01:30", wall(2025, 3, 30, 2, 30, zone="Atlantic/Canary")),
    ("us", "01/13/24 05:13", "2024-01-13T05:13:00.000000Z"),
    ("es", "05/04/2024", wall(2024, 4, 5)),
    ("us", "05/04/2024", "2024-05-04T00:00:00.000000Z"),
    *[("es", x, "unresolved") for x in ("31/02/2026", "99/99/9999", "0000-00-00 00:00:00", "hace 3 días", "Hoy", "n/d", "", "2025-13-45", "x" * 5000)],
]


def test_forms(spark):
    df = spark.createDataFrame([(k, s, v, "extra", 1.0) for k, (s, v, _) in enumerate(CASES)], "id int, source string, at string, raw string, field double")
    got = {r.id: r for r in normalise_timestamps(df, ["id"], ["at"], "source", sources(spark)).collect()}
    for k, (_, value, wanted) in enumerate(CASES):
        assert got[k].utc_ts == wanted, value
        assert (got[k].status == "unresolved") == (wanted == "unresolved")


def sources(spark):
    return spark.createDataFrame(SOURCES, "source string, time_zone string, date_order string")


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo"])
def test_session_zone_does_not_matter(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(1, "es", "2024-10-27T02:30:00"), (2, "es", "1704941169")], "id int, source string, at string")
        got = [r.utc_ts for r in normalise_timestamps(df, ["id"], ["at"], "source", sources(spark)).orderBy("id").collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == ["2024-10-27T00:30:00.000000Z", "2024-01-11T02:46:09.000000Z"]


def test_source_that_writes_the_other_order(spark):
    """What a source writes outweighs what is declared, and a mixed source is marked."""
    days = [f"{m:02d}/{d:02d}/2024" for m in range(1, 5) for d in range(13, 28)]
    rows = [(k, "es", v) for k, v in enumerate([*days, "03/04/2024"])]
    mixed = [(1000 + k, "ca", v) for k, v in enumerate(["13/01/2024", "01/13/2024", "14/02/2024", "02/14/2024", "03/04/2024"])]
    df = spark.createDataFrame(rows + mixed, "id int, source string, at string")
    got = {r.id: r for r in normalise_timestamps(df, ["id"], ["at"], "source", sources(spark)).collect()}
    assert got[len(days)].utc_ts.startswith("2024-03-03T23") and got[len(days)].status == "chosen"
    assert got[1004].status == "ambiguous" and got[1004].posterior < 0.9


def test_edges(spark):
    empty = spark.createDataFrame([], "id int, source string, at string, update string")
    assert normalise_timestamps(empty, ["id"], ["at", "update"], "source", sources(spark)).count() == 0
    df = spark.createDataFrame([(1, None, "2024-01-01"), (1, None, "2024-01-01"), (2, "other", None)], "id int, source string, at string")
    got = normalise_timestamps(df, ["id"], ["at"], "source", sources(spark)).collect()
    assert [r.utc_ts for r in got] == ["2024-01-01T00:00:00.000000Z"] * 2


def test_every_hour_of_changing_days(spark):
    start, rows, wanted = datetime(2024, 3, 30), [], []
    for day in (start, datetime(2024, 10, 26)):
        for k in range(96):
            t = day + timedelta(minutes=30 * k)
            rows.append((len(rows), "es", t.strftime("%Y-%m-%d %H:%M:%S.000")))
            z = t.replace(tzinfo=ZoneInfo("Europe/Madrid"), fold=0)
            wanted.append(z.astimezone(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%fZ"))
    df = spark.createDataFrame(rows, "id int, source string, at string")
    got = [r.utc_ts for r in normalise_timestamps(df, ["id"], ["at"], "source", sources(spark)).orderBy("id").collect()]
    assert got == wanted
