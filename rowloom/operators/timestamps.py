"""Timestamps in mixed written forms, precisions and zones, brought to one UTC form.

A value is matched against a few grammars, each of which rewrites it to one list of
fields.  All-numeric dates with the year last can be read day first or month first.  For each
source an expectation-maximisation estimates the mixture of orders together with how its dates
are spread over months; values with one reading count fully, the others by their posterior.  A
value's likelihood under a reading is the share of the order times that of the month it names,
0 for a date that does not exist, and the posterior of each value chooses.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.operators.joins import join_dimension
from rowloom.session import cut_lineage

#: Already in the target form.
TARGET_FORM = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{6}Z$"

# Month names by their first three letters, Spanish, English, German, French,
# Italian and Portuguese, lower case without accents.
MONTHS = {
    1: ["ene", "jan", "gen"], 2: ["feb", "fev"], 3: ["mar", "mae", "mrz"], 4: ["abr", "apr", "avr"],
    5: ["may", "mai", "mag"], 6: ["jun", "giu"], 7: ["jul", "lug"], 8: ["ago", "aug", "aou"],
    9: ["sep", "set"], 10: ["oct", "okt", "ott", "out"], 11: ["nov"], 12: ["dic", "dec", "dez"],
}

# Offsets that zone abbreviations stand for.
ZONES = {
    "Z": "+00:00", "UTC": "+00:00", "GMT": "+00:00", "WET": "+00:00", "WEST": "+01:00", "BST": "+01:00",
    "CET": "+01:00", "CEST": "+02:00", "EET": "+02:00", "EEST": "+03:00", "EST": "-05:00", "EDT": "-04:00",
    "CST": "-06:00", "CDT": "-05:00", "MST": "-07:00", "MDT": "-06:00", "PST": "-08:00", "PDT": "-07:00",
}

_TIME = r"(?:[T ,]+(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d{1,9}))?)?)?(?: ?([ap])\.? ?m\.?)?"
_ZONE = r" ?(z|[a-z]{3,4}|[+-]\d{2}(?::?\d{2})?)?(?:\[[\w/+-]+\])?"
_NAME = r"([^\W\d_]{3,10})\.?"
# Each grammar with the rewriting of its groups to kind|day-or-first|month-or-second|year|h|m|s|fraction|ampm|zone
GRAMMARS = [
    (rf"(?i)^(\d{{4}})-(\d{{2}})-(\d{{2}}){_TIME}{_ZONE}$", "ymd|$3|$2|$1|$4|$5|$6|$7|$8|$9"),
    (rf"(?i)^(\d{{4}})(\d{{2}})(\d{{2}})T(\d{{2}})(\d{{2}})(\d{{2}})?{_ZONE}$", "ymd|$3|$2|$1|$4|$5|$6|||$7"),
    (r"^(-?\d{1,15})$", "epoch|$1||||||||"),
    (rf"(?i)^(\d{{1,2}})[-/.](\d{{1,2}})[-/.](\d{{4}}|\d{{2}}){_TIME}{_ZONE}$", "num|$1|$2|$3|$4|$5|$6|$7|$8|$9"),
    (rf"(?iU)^(?:[^\W\d_]{{2,10}}\.?,? )?(\d{{1,2}})(?: de |[ -]){_NAME}(?: de |[ -])(\d{{4}}){_TIME}{_ZONE}$",
     "name|$1|$2|$3|$4|$5|$6|$7|$8|$9"),
    (rf"(?iU)^(?:[^\W\d_]{{2,10}}\.?, )?{_NAME} (\d{{1,2}}),? (\d{{4}}){_TIME}{_ZONE}$",
     "name|$2|$1|$3|$4|$5|$6|$7|$8|$9"),
]


def _fields(value: Column) -> Column:
    text = F.trim(F.regexp_replace(value, r"\s+", " "))
    out = F.lit(None).cast("string")
    for pattern, rewriting in reversed(GRAMMARS):
        out = F.when(text.rlike(pattern), F.regexp_replace(text, pattern, rewriting)).otherwise(out)
    return F.split(out, r"\|", 10)


def _map(pairs: dict[str, str | int]) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])


def _int(col: Column) -> Column:
    return F.nullif(col, F.lit("")).try_cast("int")


def read_fields(df: DataFrame, value: str) -> DataFrame:
    """Adds ``__f``, a struct of the fields of ``value``; null if no grammar matches."""
    p = lambda k: F.get(F.col("__p"), F.lit(k))
    month_of = _map({name: k for k, names in MONTHS.items() for name in names})
    first3 = F.substring(F.translate(F.lower(p(2)), "áàâäéèêëíìîïóòôöúùûü", "aaaaeeeeiiiioooouuuu"), 1, 3)
    hour = F.coalesce(_int(p(4)), F.lit(0))
    noon = F.lower(p(8))
    hour = (
        F.when(noon == "", hour)
        .when((hour < 1) | (hour > 12), F.lit(None).cast("int"))
        .otherwise(hour % 12 + F.when(noon == "p", 12).otherwise(0))
    )
    year = _int(p(3))
    zone = F.upper(p(9))
    offset = (
        F.when(zone == "", F.lit(None).cast("string"))
        .when(zone.rlike(r"^[+-]\d{2}$"), F.concat(zone, F.lit(":00")))
        .when(zone.rlike(r"^[+-]\d{4}$"), F.concat(F.substring(zone, 1, 3), F.lit(":"), F.substring(zone, 4, 2)))
        .when(zone.rlike(r"^[+-]"), zone)
        .otherwise(F.coalesce(F.element_at(_map(ZONES), zone), F.lit("unknown")))
    )
    second = F.concat(F.when(p(6) == "", "0").otherwise(p(6)), F.lit("."), F.rpad(F.substring(p(7), 1, 6), 6, "0"))
    # An explode of one element evaluates the expression once, where a projection would be
    # merged into the next and evaluated for each of its uses.
    return (
        df.select("*", F.explode(F.array(_fields(F.col(value)))).alias("__p"))
        .select(
            "*",
            F.explode(F.array(F.when(
                F.col("__p").isNotNull(),
                F.struct(
                    p(0).alias("kind"),
                    p(1).try_cast("bigint").alias("a"),
                    F.when(p(0) == "name", F.element_at(month_of, first3)).otherwise(_int(p(2))).alias("b"),
                    F.when((p(0) == "num") & (F.length(p(3)) == 2), year + 2000).otherwise(year).alias("y"),
                    hour.alias("h"),
                    F.coalesce(_int(p(5)), F.lit(0)).alias("mi"),
                    second.try_cast("decimal(16,6)").alias("s"),
                    offset.alias("zone"),
                ),
            ))).alias("__f"),
        )
        .drop("__p")
    )


def _instant(day: Column, month: Column, zone: Column) -> Column:
    f = lambda k: F.col("__f")[k]
    return F.try_make_timestamp(f("y"), month.try_cast("int"), day.try_cast("int"), f("h"), f("mi"), f("s"), zone)


#: Weight of the months that a source has not been seen to write, in dates.
UNSEEN = 1.0


def order_posteriors(counts: DataFrame, rounds: int = 200) -> DataFrame:
    """Rows ``(__source, __month_d, __month_m, __dmy)``: the posterior of the day-first reading of a date
    of a source, by the months of its two readings (null for a reading that names no date).

    ``counts`` has ``__source, declared, __month_d, __month_m, numeric, n``: one row for each pair of
    months, so a source is as many rows as it writes pairs of months, whatever its size.  Dates that are
    not ``numeric`` have one reading, ``__month_d``, and only tell of the months.  The declared order
    enters as a prior of one observation.
    """

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        prior = {"DMY": 0.9, "MDY": 0.1}.get(pdf["declared"].iloc[0], 0.5)
        n, numeric = pdf["n"].to_numpy(float), pdf["numeric"].to_numpy(bool)
        months = {m: k for k, m in enumerate(sorted({*pdf["__month_d"].dropna(), *pdf["__month_m"].dropna()}))}
        day, month = (pdf[c].map(months).fillna(len(months)).to_numpy(int) for c in ("__month_d", "__month_m"))
        share, spread, last = prior, np.full(len(months) + 1, 1 / max(1, len(months))), -np.inf
        for _ in range(rounds):
            spread[-1] = 0.0
            first = np.where(numeric, share, 1.0) * spread[day]
            second = np.where(numeric, 1 - share, 0.0) * spread[month]
            total = first + second
            now = float((n * np.log(total)).sum())
            if now - last < 1e-9:
                break
            last, post = now, first / total
            share = float(((post * n)[numeric].sum() + prior) / (n[numeric].sum() + 1))
            share = min(max(share, 1e-9), 1 - 1e-9)
            seen = np.bincount(day, post * n, len(months) + 1) + np.bincount(month, (1 - post) * n, len(months) + 1)
            spread = (seen + UNSEEN) / (seen[:-1].sum() + UNSEEN * len(months))
        out = pdf.assign(__dmy=first / total)[numeric]
        return out[["__source", "__month_d", "__month_m", "__dmy"]]

    schema = "__source string, __month_d string, __month_m string, __dmy double"
    some = counts.where("__month_d IS NOT NULL OR __month_m IS NOT NULL")
    return some.groupBy("__source").applyInPandas(fit, schema)


def normalise_timestamps(
    df: DataFrame, id_cols: list[str], fields: list[str], source: str, sources: DataFrame
) -> DataFrame:
    """One row per non-null value of ``fields``: ids, ``field``, ``raw``, ``utc_ts``, ``status``, ``posterior``.

    ``sources`` has ``source, time_zone, date_order``.  ``utc_ts`` has the form
    ``YYYY-MM-DDTHH:MM:SS.ffffffZ`` or is ``unresolved``.  ``status`` is ``exact`` (one
    reading), ``chosen`` (two readings, the posterior says which), ``ambiguous`` (two
    readings and a posterior under 0.9, the likelier one is given) or ``unresolved``.

    * Null values give no row; empty text, words and dates that do not exist are unresolved.
    * A source that ``sources`` does not list, or a null source, is taken to write UTC.
    * A wall time that occurs twice is the earlier instant, a skipped one moves forward.
    * Two-digit years are 20YY; bare integers are seconds, or milliseconds from 12 digits on.
    * Repeated rows are kept; other columns of ``df`` are not read.
    """
    values = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("raw")) for c in fields]))
    rows = df.select(*id_cols, F.col(source).alias("__source"), values.alias("__v"))
    rows = rows.select(*id_cols, "__source", "__v.field", "__v.raw").where(F.col("raw").isNotNull())
    rows = read_fields(rows, "raw")
    profile = sources.select(
        F.col("source").alias("__source"), F.col("time_zone").alias("__tz"), F.col("date_order").alias("__declared")
    ).dropDuplicates(["__source"])

    f = lambda k: F.col("__f")[k]
    utc = F.lit("UTC")
    # The months of both readings, as written; null for a reading that names no date.
    month = lambda a, b: F.date_format(_instant(f(a), f(b), utc), "yyyy-MM")
    numeric = (f("kind") == "num") & f("b").isNotNull()
    months = F.struct(month("a", "b").alias("d"), F.when(numeric, month("b", "a")).alias("m"))
    rows = rows.select("*", F.explode(F.array(F.when(f("kind") != "epoch", months))).alias("__m"))
    rows = rows.select("*", F.col("__m.d").alias("__month_d"), F.col("__m.m").alias("__month_m")).drop("__m")
    counts = rows.where(f("kind") != "epoch").groupBy("__source", "__month_d", "__month_m", F.coalesce(numeric, F.lit(False)).alias("numeric"))
    counts = counts.agg(F.count("*").alias("n"))
    counts = join_dimension(counts, profile.select("__source", F.col("__declared").alias("declared")), ["__source"])
    # A posterior matters only where there are two readings.
    shares = order_posteriors(counts).where("__month_d IS NOT NULL AND __month_m IS NOT NULL")
    shares = shares.withColumn("__source", F.coalesce("__source", F.lit("\u001f")))
    rows = join_dimension(rows, profile, ["__source"])
    rows = rows.withColumn("__source", F.coalesce("__source", F.lit("\u001f")))
    rows = join_dimension(rows, cut_lineage(shares), ["__source", "__month_d", "__month_m"])

    zone = F.coalesce(f("zone"), F.col("__tz"), utc)
    zone = F.when(zone == "unknown", F.lit(None).cast("string")).otherwise(zone)
    readings = F.struct(_instant(f("a"), f("b"), zone).alias("d"), _instant(f("b"), f("a"), zone).alias("m"))
    rows = rows.select("*", F.explode(F.array(readings)).alias("__r"))
    day_first, month_first = F.col("__r.d"), F.col("__r.m")
    share = F.coalesce(F.col("__dmy"), F.when(F.col("__declared") == "MDY", 0.1).otherwise(0.9))
    epoch = F.when(
        F.abs(f("a")) < F.lit(10**11), F.timestamp_micros(f("a") * 1_000_000)
    ).otherwise(F.timestamp_micros(f("a") * 1000))
    both = (f("kind") == "num") & day_first.isNotNull() & month_first.isNotNull()
    instant = (
        F.when(f("kind") == "epoch", epoch)
        .when(f("kind") != "num", day_first)
        .when(both, F.when(share >= 0.5, day_first).otherwise(month_first))
        .otherwise(F.coalesce(day_first, month_first))
    )
    wall = F.convert_timezone(F.current_timezone(), F.lit("UTC"), instant.cast("timestamp_ntz")).cast("string")
    rows = rows.select("*", F.explode(F.array(wall)).alias("__wall"))
    wall, posterior = F.col("__wall"), F.when(both, F.greatest(share, 1 - share)).otherwise(F.lit(1.0))
    same = both & (f("a") == f("b"))
    text = F.concat(
        F.substring(wall, 1, 10), F.lit("T"), F.substring(wall, 12, 8), F.lit("."),
        F.rpad(F.substring(wall, 21, 6), 6, "0"), F.lit("Z"),
    )
    status = (
        F.when(wall.isNull(), "unresolved")
        .when(~both | same, "exact")
        .when(posterior >= 0.9, "chosen")
        .otherwise("ambiguous")
    )
    return rows.select(
        *id_cols, "field", "raw", F.coalesce(text, F.lit("unresolved")).alias("utc_ts"),
        status.alias("status"), F.when(wall.isNotNull(), posterior).alias("posterior"),
    )
