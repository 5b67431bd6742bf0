"""Records of further sources, index pages, budgets of feeds, dates in text, reports."""

import math

import pytest
from pyspark.sql import functions as F

from rowloom.functions.dates import parse_date
from rowloom.operators import analytics, catalog, select
from rowloom.operators.quantities import PAY, Unit, annual_cents, unit_table
from rowloom.operators.timestamps import normalise_timestamps
from rowloom.sources import feed, records, tables

VALUE = "struct<value:string,periodValue:string>"
OFFER = (
    f"id string, title string, profile struct<name:string>, description string, minPay {VALUE}, maxPay {VALUE}, salaryDescription string, "
    f"cityPD {VALUE}, city string, province {VALUE}, contractType {VALUE}, journey {VALUE}, creationDate string, updatedAt string, link string"
)


def test_portal_records(spark):
    v = lambda x, p=None: (x, p)
    rows = [
        ("1", "Cocinero", ("Hotel",), "d", v("1000", "mes"), v("1200"), None, v("Arona"), "arona", v("Tenerife"), v("temporal"), v("completa"), "2024-05-06T07:08:09", None, "http://x/1"),
        ("2", None, None, None, None, None, " 20 euros ", None, "Telde", None, None, None, None, None, None),
    ]
    got = {r.external_id: r for r in records.portal_records(spark.createDataFrame(rows, OFFER), F.lit("t")).collect()}
    one, two = got["1"], got["2"]
    assert (one.salary_text, one.salary_period, one.salary_currency, one.municipality, one.raw_location) == ("1000 - 1200", "mes", "EUR", "Arona", "arona / Tenerife")
    assert (one.publication_date, one.contract_type, one.workday, one.source_url) == ("2024-05-06T07:08:09", "temporal", "completa", "http://x/1")
    assert (two.title, two.salary_text, two.salary_min, two.municipality) == ("Oferta InfoJobs", "20 euros", None, "Telde")
    assert two.source_url == "https://www.infojobs.net/oferta/2"


def test_listed_records(spark):
    listing = [("a", "T", "C", "Arona, Tenerife", "10", "2024-01-02"), ("a", "U", "C", "x", None, None), ("b", "V", None, "Telde", None, None), (None, "W", None, None, None, None)]
    listing = spark.createDataFrame(listing, "jobkey string, title string, companyName string, formattedLocation string, salary string, date string")
    details = spark.createDataFrame([("a", "largo", "20 al mes", "fijo", None, "noche")], "jobkey string, description string, salary_text string, contract_type string, workday string, schedule string")
    got = {r.external_id: r for r in records.listed_records(listing, details, "indeed", F.lit("t"), "http://i/%s").collect()}
    assert set(got) == {"a", "b"} and got["a"].title == "T" and got["a"].salary_text == "20 al mes" and got["a"].schedule == "noche"
    assert (got["a"].municipality, got["a"].province) == ("Arona", "Tenerife") and (got["b"].municipality, got["b"].province) == ("Telde", "Las Palmas")
    assert got["b"].salary_text is None and got["b"].source_url == "http://i/b"


def test_contract_told(spark):
    rows = [("Fijo", "temporal"), (None, "Contrato TEMPORAL o indefinido"), ("", "de duración determinada"), (None, "prácticas"), (None, "becario"), (None, "nada"), (None, None)]
    df = spark.createDataFrame(rows, "k string, d string")
    got = [r[0] for r in df.select(records.contract_told(F.col("k"), F.col("d"))).collect()]
    assert got == ["Fijo", "Contrato Indefinido", "Contrato Temporal", "Prácticas", "Beca", None, None]


def test_index_pages(spark):
    link = lambda title, at: f'<a href="/{at}">{title}</a>'
    page = "<main>" + link("Grado en Derecho", "g1") + link("Máster en Turismo", "m1") + link("Grado en Derecho", "g2") + "</main>"
    other = "<main>" + link("Grado en Derecho", "g3") + link("Grado en Historia", "g4") + "</main>"
    pages = spark.createDataFrame([("ull", 1, page, "http://u/"), ("ull", 2, other, "http://u/"), ("zz", 1, page, "http://z/")], "university_id string, path_no int, html string, url string")
    registry = spark.createDataFrame([("ull", "La Laguna", "publica", "x")], "university_id string, canonical_name string, university_type string, title string")
    details = spark.createDataFrame([("http://u/g1", "<main><p>" + "texto largo " * 60 + "</p></main>"), ("http://u/g4", "<main></main>")], "source_url string, html string")
    got = {r.source_url: r for r in catalog.crawl_indexes(pages, registry, F.lit("t"), ["grado"], details=details).collect()}
    assert set(got) == {"http://u/g1", "http://u/g4"} and got["http://u/g1"].university == "La Laguna"
    assert [(got[u].description_status, got[u].description_quality_flag) for u in ("http://u/g1", "http://u/g4")] == [("ok", "high"), ("missing", None)]
    assert catalog.crawl_indexes(pages, registry, F.lit("t"), most=1).count() == 1
    with pytest.raises(ValueError):
        catalog.crawl_indexes(pages, registry, F.lit("t"), ["curso"])


def test_budget_of_a_feed(spark):
    def pages(source, query, offset, size):
        if query == "stuck":
            return [{"id": str(k % 3), "url": ""} for k in range(size)]
        return [{"id": str(offset + k), "url": "u" if (offset + k) % 2 else ""} for k in range(size)]

    got = feed.payloads(feed.read_feed(spark, pages, "s", ["stuck"], page=10, unique=["id"]), "id string").collect()
    assert [r.id for r in got] == ["0", "1", "2"]
    got = feed.payloads(feed.read_feed(spark, pages, "s", ["a"], page=10, limit=7, unique=["id", "url"]), "id string").collect()
    assert [r.id for r in got] == ["0", "1", "2", "4", "6", "8", "10"]
    assert feed.read_feed(spark, pages, "s", ["a"], page=10, seconds=0.0).count() == 0

    def broken(source, query, offset, size):
        raise RuntimeError("down")

    with pytest.raises(feed.FeedError):
        feed.require_answers(feed.read_feed(spark, broken, "s", ["a", "b"]))
    assert feed.require_answers(feed.read_feed(spark, pages, "s", ["a"], limit=3)).count() == 3


@pytest.mark.parametrize("text,iso", [
    ("Publicado el 05/06/2024 a mano", "2024-06-05T00:00:00"), ("posted June 7th, 2024", "2024-06-07T00:00:00"), ("on 7th of march 2023.", "2023-03-07T00:00:00"),
    ("ver 2024-02-03!", "2024-02-03T00:00:00"), ("hace tres semanas", "hace tres semanas"), ("31/02/2024 x", "31/02/2024 x"), (None, None),
])
def test_dates_in_text(spark, text, iso):
    assert spark.createDataFrame([(text,)], "t string").select(parse_date(F.col("t"))).first()[0] == iso


def test_sector_rows_and_memo(spark):
    df = spark.createDataFrame([("publica", 0.5, "a"), ("publica", 0.7, "b")], "sector string, score double, pair_key string")
    got = {r.sector: r for r in analytics.sector_rows(df, "sector", "score", "pair_key", draws=50).collect()}
    assert got["publica"].n == 2 and 0.5 <= got["publica"].low <= got["publica"].high <= 0.7
    assert got["privada"].n == 0 and math.isnan(got["privada"].mean) and math.isnan(got["privada"].low)
    memo = tables.markdown_memo("Report", {"pairs": 2}, {"Rows": df})
    assert memo.startswith("# Report") and "- pairs: 2" in memo and "| publica | 0.50000 | a |" in memo
    with pytest.raises(ValueError):
        tables.markdown_memo("x", {}, {"Rows": df}, rows=1)


def test_all_rows_that_fit(spark):
    df = spark.createDataFrame([(1, "s", "u"), (2, "s", "u")], "id int, source string, url string")
    assert select.cover_sources(df, "source", "url", [F.col("id")], 5).count() == 2 and select.cover_sources(df, "source", "url", [F.col("id")], 1).count() == 1


def test_dimensions_decide(spark):
    rows = [("month", "period", 12.0, 0.0), ("EUR", "currency", 1.0, 0.0), ("USD", "length", 0.9, 0.0), ("GBP", "currency", 2.0, 5.0)]
    units = unit_table(spark.createDataFrame(rows, "unit string, kind string, factor double, offset double"))
    assert annual_cents("1000 EUR al mes", None, None, None, None, None, units) == (1_200_000, 1_200_000)
    assert annual_cents("1000 USD al mes", None, None, None, None, None, units) is None
    assert annual_cents("1000 GBP al mes", None, None, None, None, None, units) == (2_406_000, 2_406_000)
    assert units["EUR"].times(units["month"]).dims == PAY and Unit(2, (1, 0), 3).canonical(4) == 11


def test_months_choose_the_reading(spark):
    """Without a declared order the months that a source is known to write decide each date."""
    known = [(k, f"2024-03-{k + 10:02d}", "s") for k in range(15)]
    asked = [(100, "03/04/2024", "s"), (101, "04/03/2024", "s")]
    sources = spark.createDataFrame([("s", "UTC", None)], "source string, time_zone string, date_order string")
    df = spark.createDataFrame(known + asked, "row_id bigint, d string, source string")
    got = {r.row_id: r for r in normalise_timestamps(df, ["row_id"], ["d"], "source", sources).collect()}
    assert got[100].utc_ts[:10] == "2024-03-04" and got[101].utc_ts[:10] == "2024-03-04" and got[100].posterior > 0.8
