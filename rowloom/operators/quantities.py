"""Pay written in differing periods, currencies and scales, brought to euro cents a year.

A small grammar reads numbers and unit words; a unit is a scale with an exponent vector over
the dimensions (money, time).  Pay is money per time, the vector (1, -1); an amount without
a time unit takes the period stated elsewhere in the row, and is no pay if there is none.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from decimal import ROUND_HALF_UP, Decimal
from functools import lru_cache
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.operators.joins import join_dimension


class Unit(NamedTuple):
    """A scale to canonical units, exponents over (money, time), and what is added after scaling
    (as a temperature scale needs; of composed units only one may have an offset)."""

    scale: Decimal
    dims: tuple[int, int]
    offset: Decimal = Decimal(0)

    def times(self, other: Unit) -> Unit:
        dims = (self.dims[0] + other.dims[0], self.dims[1] + other.dims[1])
        return Unit(self.scale * other.scale, dims, self.offset * other.scale + other.offset * self.scale)

    def canonical(self, value: Decimal) -> Decimal:
        return value * self.scale + self.offset


PAY = (1, -1)
#: Exponents of the kinds of units; units of another kind measure neither money nor time.
DIMENSIONS = {"currency": (1, 0), "period": (0, -1)}

# Words of the grammar.
PERIOD_WORDS = [
    ("hour", r"/ ?h\b|/ ?hr\b|\bhoras?\b|\bhours?\b|\bhourly\b|/ ?hora"),
    ("day", r"\bd[ií]as?\b|\bdiari[oa]s?\b|\bdays?\b|\bdaily\b"),
    ("week", r"\bsemanas?\b|\bsemanal(?:es)?\b|\bweeks?\b|\bweekly\b"),
    ("month", r"\bmes(?:es)?\b|\bmensual(?:es)?\b|\bmonths?\b|\bmonthly\b"),
    ("year", r"\ba[nñ]os?\b|\banual(?:es)?\b|\bb/a\b|\bp\. ?a\.|\bannum\b|/ ?yr\b|\byears?\b|\byearly\b|\bannual(?:ly)?\b"),
]
CURRENCY_WORDS = [
    ("EUR", r"€|\beur\b|\beuros?\b"),
    ("USD", r"\$|\busd\b|\bd[oó]lar(?:es)?\b|\bdollars?\b"),
    ("GBP", r"£|\bgbp\b|\blibras?\b|\bpounds?\b"),
]
LOWER_WORDS = r"\bdesde\b|\ba partir de\b|\bfrom\b|\bm[ií]nimo\b|\bmin\b|\bat least\b|\bal menos\b"
UPPER_WORDS = r"\bhasta\b|\bup to\b|\bm[aá]ximo\b|\bm[aá]x\b|\bat most\b"
#: Numbers that are no pay: working hours, the year of a contract, the number of instalments.
NOT_PAY = (
    r"jornada de \d+(?:[.,]\d+)? ?h(?:oras?)?\b(?: semanales| a la semana)?|\d+(?:[.,]\d+)? ?h(?:oras?|rs?)? ?/ ?(?:semana|sem|week)\b"
    r"|\d+(?:[.,]\d+)? (?:horas|hours) (?:semanales|a la semana|por semana|a week|per week|weekly)"
    r"|\bcontrato(?: de)? (?:19|20)\d\d\b|\b(?:19|20)\d\d/(?:19|20)?\d\d\b"
)
_PAGAS = re.compile(r"(?:\bx ?|\ben )?\b(\d{1,2}) ?(?:pagas|payments|instal+ments)\b")
_NUMBER = re.compile(r"\d+(?:[.,]\d+)*(?: ?(?:k\b|k(?=€|\$|£|eur|usd|gbp)|mil\b|mil(?=€|eur)))?")
_PERIODS = [(name, re.compile(p)) for name, p in PERIOD_WORDS]
_CURRENCIES = [(name, re.compile(p)) for name, p in CURRENCY_WORDS]
_NOT_PAY, _LOWER, _UPPER = re.compile(NOT_PAY), re.compile(LOWER_WORDS), re.compile(UPPER_WORDS)


def number(text: str) -> Decimal | None:
    """``1.234,56``, ``1,234.56``, ``22,5k``, ``18 mil``: the last separator is decimal unless three digits follow it."""
    text = text.strip().lower()
    scale = Decimal(1000) if text.endswith(("k", "mil")) else Decimal(1)
    digits = re.sub(r"[^\d.,]", "", text).strip(".,")
    if not digits:
        return None
    seps = re.findall(r"[.,]", digits)
    if seps:
        last = max(digits.rfind("."), digits.rfind(","))
        grouped = len(set(seps)) == 1 and (len(seps) > 1 or len(digits) - last - 1 == 3) and scale == 1
        if grouped:
            digits = re.sub(r"[.,]", "", digits)
        else:
            digits = re.sub(r"[.,]", "", digits[:last]) + "." + digits[last + 1 :]
    return Decimal(digits) * scale


def _first(patterns: list, text: str) -> str | None:
    found = [(m.start(), name) for name, p in patterns if (m := p.search(text))]
    return min(found)[1] if found else None


class Stated(NamedTuple):
    """What a pay text states; each part may be missing."""

    low: Decimal | None
    high: Decimal | None
    period: str | None
    currency: str | None


@lru_cache(maxsize=50_000)
def read_pay(text: str) -> Stated:
    """The amounts, the period and the currency that a free text states."""
    t = re.sub(r"\s+", " ", text.lower())
    t = _NOT_PAY.sub(" ; ", t)
    pagas = _PAGAS.search(t)
    t = _PAGAS.sub(" ", t)
    period = _first(_PERIODS, t)
    if pagas and period in ("month", None):
        n = int(pagas.group(1))
        period = period and ("month14" if n == 14 else "month" if n == 12 else f"month{n}")
    amounts = [x for x in (number(m.group()) for m in _NUMBER.finditer(t)) if x is not None and x > 0]
    if len(amounts) == 2 and re.search(r"\d ?(?:-|–|—| a | to | y ) ?\d[\d.,]* ?(?:k|mil)\b", t) and not re.search(
        r"\d ?(?:k|mil)\b[^\d]*\d", t
    ):
        amounts[0] *= 1000  # "18 - 20k": the scale is written once
    low = high = None
    if len(amounts) >= 2:
        low, high = amounts[0], amounts[1]
    elif amounts:
        low = None if _UPPER.search(t) else amounts[0]
        high = None if _LOWER.search(t) else amounts[0]
    return Stated(low, high, period, _first(_CURRENCIES, t))


def _column_period(value: str) -> str | None:
    return _first(_PERIODS, value.lower())


def annual_cents(
    text: str | None, low: str | None, high: str | None, currency: str | None, period: str | None,
    scale: float | None, units: dict[str, Unit],
) -> tuple[int, int] | None:
    """Lower and upper pay in euro cents a year, 0 where the row gives no such bound; None if it states no pay."""
    stated = read_pay(text) if text and text.strip() else Stated(None, None, None, None)
    divisor = Decimal(str(scale)) if scale and scale == scale and scale > 0 else Decimal(1)
    column = [number(x) if x and x.strip() else None for x in (low, high)]
    column = [x / divisor if x is not None and x > 0 else None for x in column]
    bounds = [stated.low or column[0], stated.high or column[1]]
    when = stated.period or (_column_period(period) if period else None)
    money = stated.currency or (_first(_CURRENCIES, currency.lower()) if currency else None) or "EUR"
    if not any(bounds) or when is None or money not in units:
        return None
    if when not in units:  # a monthly amount paid so many times a year
        units = units | {when: Unit(Decimal(when[5:]), (0, -1))}
    unit = units[money].times(units[when])
    if unit.dims != PAY:  # a table may list units that are no money or no time
        return None
    cents = [int((unit.canonical(x) * 100).quantize(Decimal(1), ROUND_HALF_UP)) if x else 0 for x in bounds]
    return cents[0], cents[1]


def unit_table(units: DataFrame, rows: int = 1000) -> dict[str, Unit]:
    """The units as a dict; a column ``offset`` is optional.  The table is fixed and small, more than
    ``rows`` rows are an error."""
    offset = F.col("offset") if "offset" in units.columns else F.lit(0.0)
    found = units.select("unit", "kind", "factor", F.coalesce(offset, F.lit(0.0)).alias("o")).limit(rows + 1).collect()
    if len(found) > rows:
        raise ValueError("the table of units is larger than expected")
    return {r.unit: Unit(Decimal(str(r.factor)), DIMENSIONS.get(r.kind, (0, 0)), Decimal(str(r.o))) for r in found}


def normalise_pay(df: DataFrame, id_col: str, units: DataFrame, sources: DataFrame) -> DataFrame:
    """Rows ``(id, min_cents, max_cents)`` of the rows that state an amount of pay and a period.

    * What ``salary_text`` states holds over the other columns; a bound it leaves open is
      taken from its column, and is 0 if that is null too.
    * Null, empty and wordy values state nothing; a row that states no amount, or no period,
      gives no row.  No currency anywhere means euro.
    * ``salary_min`` and ``salary_max`` are divided by the source's ``amount_scale``; an
      unlisted or null source divides by 1.
    * Repeated rows are kept; other columns of ``df`` are not read.
    """
    known = unit_table(units)
    cols = ["salary_text", "salary_min", "salary_max", "salary_currency", "salary_period"]
    scales = sources.select(F.col("source").alias("__source"), F.col("amount_scale").cast("double").alias("__scale"))
    rows = df.select(F.col(id_col).alias("__id"), F.col("source").alias("__source"), *cols)
    rows = rows.where(F.coalesce("salary_text", "salary_min", "salary_max").isNotNull())
    rows = join_dimension(rows, scales.dropDuplicates(["__source"]), ["__source"]).drop("__source")

    def convert(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            values = zip(*(b[c].where(b[c].notna(), None) for c in [*cols, "__scale"]), strict=True)
            found = [annual_cents(*v, units=known) for v in values]
            keep = [k for k, x in enumerate(found) if x]
            yield pd.DataFrame(
                {
                    id_col: b["__id"].iloc[keep].to_numpy(),
                    "min_cents": pd.Series([found[k][0] for k in keep], dtype="int64"),
                    "max_cents": pd.Series([found[k][1] for k in keep], dtype="int64"),
                }
            )

    kind = dict(df.dtypes)[id_col]
    return rows.mapInPandas(convert, f"`{id_col}` {kind}, min_cents bigint, max_cents bigint")


def states_amount(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds a boolean column: whether the pay text states an amount of money."""

    @F.pandas_udf("boolean")
    def has(values: pd.Series) -> pd.Series:
        return values.map(lambda v: bool(v) and (s := read_pay(v)) and (s.low or s.high) is not None).astype(bool)

    return df.withColumn(out, F.when(F.col(text).isNotNull(), has(F.col(text))).otherwise(F.lit(False)))
