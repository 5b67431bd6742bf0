from decimal import Decimal

import pytest

from rowloom.operators.quantities import PAY, annual_cents, normalise_pay, number, read_pay, states_amount, unit_table

UNITS = [("year", "period", 1.0), ("month", "period", 12.0), ("month14", "period", 14.0), ("week", "period", 52.0), ("day", "period", 220.0),
         ("hour", "period", 1760.0), ("EUR", "currency", 1.0), ("USD", "currency", 0.92), ("GBP", "currency", 1.15)]


@pytest.mark.parametrize("text,value", [
    ("1.234,56", "1234.56"), ("1,234.56", "1234.56"), ("22,5k", "22500"), ("18 mil", "18000"), ("2.625", "2625"), ("12.50", "12.5"),
    ("3.075,00", "3075"), ("27,5 K", "27500"), ("1.234.567", "1234567"), ("30,70", "30.7"), ("14", "14"),
])
def test_number(text, value):
    assert number(text) == Decimal(value)


@pytest.mark.parametrize("text,stated", [
    ("Entre 18k EUR y 22,5k EUR b/a", (18000, 22500, "year", "EUR")),
    ("2575,00€ - 2.675€/mes en 14 pagas", (2575, 2675, "month14", "EUR")),
    ("Jornada de 30 horas: máximo 20500,00 €/año", (None, 20500, "year", "EUR")),
    ("40 h/semana · 28,05 euros/hora", (28.05, 28.05, "hour", "EUR")),
    ("Contrato 2026. 2775–3.250 EUR/mes", (2775, 3250, "month", "EUR")),
    ("From €23500/yr", (23500, None, "year", "EUR")), ("Up to 25.00 GBP/hr", (None, 25, "hour", "GBP")),
    ("£32,500 - £38,500/yr", (32500, 38500, "year", "GBP")), ("$12.00 per hour", (12, 12, "hour", "USD")),
    ("Según convenio (14 pagas)", (None, None, None, None)), ("Pago brutos/mes", (None, None, "month", None)),
    ("A partir de 480€ a la semana según experiencia", (480, None, "week", "EUR")), ("95€/día + comisiones", (95, 95, "day", "EUR")),
    ("30,70€", (30.7, 30.7, None, "EUR")), ("", (None, None, None, None)), ("18 - 20k €/año", (18000, 20000, "year", "EUR")),
])
def test_read_pay(text, stated):
    got = read_pay(text)
    low, high = (None if x is None else float(x) for x in got[:2])
    assert (low, high, got.period, got.currency) == (*[None if x is None else float(x) for x in stated[:2]], *stated[2:])


def table(spark):
    return spark.createDataFrame(UNITS, "unit string, kind string, factor double")


def test_units(spark):
    units = unit_table(table(spark))
    assert units["EUR"].times(units["month"]).dims == PAY and units["EUR"].times(units["EUR"]).dims != PAY
    assert annual_cents("1000 €/mes", None, None, None, None, None, units) == (1_200_000, 1_200_000)
    assert annual_cents(None, "100000", "120000", "EUR", "Mes", 100.0, units) == (1_200_000, 1_440_000)
    assert annual_cents("Pago/hora", "10,00", None, None, None, 1.0, units) == (1_760_000, 0)
    assert annual_cents("30,70€", None, None, None, None, None, units) is None
    assert annual_cents("30,70€", None, None, None, "por hora", None, units)[0] == 5_403_200
    assert annual_cents(None, None, None, "EUR", "year", 1.0, units) is None


def test_operator(spark):
    schema = "row_id bigint, source string, salary_text string, salary_min string, salary_max string, salary_currency string, salary_period string, scale double, min_cents string"
    rows = [
        (1, "a", "1000 €/mes", None, None, None, None, 9.0, "x"), (2, "b", None, "250000", None, None, "month", 9.0, "x"),
        (3, None, None, "10", "12", "USD", "hour", None, None), (4, "a", None, None, None, None, None, None, None),
        (5, "a", "", " ", "", "", "", None, None), (1, "a", "1000 €/mes", None, None, None, None, 9.0, "x"), (6, "a", "x" * 20000, None, None, None, None, None, None),
    ]
    sources = spark.createDataFrame([("a", 1.0), ("b", 100.0)], "source string, amount_scale double")
    got = sorted(tuple(r) for r in normalise_pay(spark.createDataFrame(rows, schema), "row_id", table(spark), sources).collect())
    assert got == [(1, 1_200_000, 1_200_000), (1, 1_200_000, 1_200_000), (2, 3_000_000, 0), (3, 1_619_200, 1_943_040)]
    assert normalise_pay(spark.createDataFrame([], schema), "row_id", table(spark), sources).count() == 0


def test_states_amount(spark):
    df = spark.createDataFrame([("1000 €",), ("A convenir",), (None,), ("Según convenio (14 pagas)",)], "t string")
    assert [r.a for r in states_amount(df, "t", "a").collect()] == [True, False, False, False]
