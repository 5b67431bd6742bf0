from pyspark.sql import functions as F

from rowloom.functions import dates, keys, normalize, scores, text


def one(spark, expr, **cols):
    schema = ", ".join(f"{k} string" for k in cols) or "x string"
    row = spark.createDataFrame([tuple(cols.values()) or (None,)], schema).select(expr.alias("v")).first()
    return row.v


def test_clean_text(spark):
    c = text.clean_text(F.col("x"))
    assert one(spark, c, x="  <b>Hola</b>\n mundo ") == "Hola mundo"
    for word in ("nan", "None", " NULL ", "", "  ", "<br>", None):
        assert one(spark, c, x=word) is None


def test_normalisers(spark):
    assert one(spark, text.norm_words(F.col("x")), x="  Grado en Psicología, (Ñandú)! ") == "grado en psicologia nandu"
    assert one(spark, text.norm_ascii(F.col("x")), x="Grado € en SS") == "grado en ss"
    assert one(spark, text.norm_match(F.col("x")), x=" Máster: en  X ") == "master: en x"
    assert one(spark, text.norm_match(F.col("x")), x=None) == ""
    assert one(spark, text.tokens(F.lit("grado en ingenieria de la ingenieria"))) == ["ingenieria", "ingenieria"]
    assert one(spark, text.title_tokens(F.col("x")), x="Grado Oficial en Náutica y Mar") == ["náutica"]
    assert one(spark, text.repair_encoding(F.col("x")), x="AgÃ¼eral") == "Agüeral"
    assert one(spark, text.repair_encoding(F.col("x")), x="Ã mal € x") == "Ã mal € x"


def test_lists_and_chunks(spark):
    assert one(spark, text.pipe_values(F.col("x")), x=" a | b||a ") == ["a", "b"]
    assert one(spark, text.pipe_values(F.col("x")), x=None) == []
    assert one(spark, text.pipe_join(F.array(F.lit("a"), F.lit(None), F.lit("a"), F.lit("")))) == "a"
    assert [len(c) for c in one(spark, text.chunks(F.col("x")), x="a" * 6500)] == [3000, 3000, 500]
    assert one(spark, text.chunks(F.col("x")), x=" \n ") == []
    assert one(spark, text.estimated_tokens(F.col("x")), x=None) == 1


def test_titles(spark):
    assert one(spark, text.program_title(F.col("x")), x="Doble titulación: Grado en A y B  Nuevo") == "Doble Grado en A y B"
    assert one(spark, text.program_title(F.col("x")), x=" ") == "Unknown title"
    assert one(spark, text.degree_title(F.col("x")), x="Grado en Grado en Historia") == "Grado en Historia"
    assert one(spark, text.title_from_slug(F.col("x")), x="https://a.b/grado-en-mar/") == "Grado En Mar"
    assert one(spark, text.report_section(F.col("x")), x="x MOTIVACIÓN la  razón RECOMENDACIONES y") == "la razón"
    assert one(spark, text.plain_description(F.col("x")), x="**Hola**\nLocation: X\n mundo") == "Hola mundo"


def test_places_and_contracts(spark):
    def at(p, m, i, r):
        cols = [F.lit(v).cast("string") for v in (p, m, i, r)]
        return tuple(one(spark, normalize.place(*cols)))

    assert at(None, "Las Palmas de G.C.", None, None) == ("Las Palmas", "Las Palmas de Gran Canaria", "Gran Canaria", None, "municipality_index")
    assert at(None, "X", "TENERIFE", "r") == ("Santa Cruz de Tenerife", "X", "Tenerife", "r", "island")
    assert at("las palmas", None, None, None)[::4] == ("Las Palmas", "province")
    assert at(None, None, None, "arrecife")[1] == "Arrecife"
    assert at(None, None, None, "x")[4] == "unresolved" and at(None, None, None, None)[4] == "missing"
    kind = lambda v: tuple(one(spark, normalize.contract(F.lit(v).cast("string"))))
    assert kind("INDEFINIDO") == ("indefinido", "exact")
    assert kind("Contrato de prácticas en beca") == ("formacion", "alias")
    assert kind("modalidad rara") == ("other", "unresolved") and kind("nan") == (None, "missing")


def test_dates(spark):
    d = dates.parse_date(F.col("x"))
    assert one(spark, d, x="2026-04-09") == "2026-04-09T00:00:00"
    assert one(spark, d, x="05/04/2026") == "2026-04-05T00:00:00"
    assert one(spark, d, x="mañana") == "mañana" and one(spark, d, x=None) is None
    assert one(spark, dates.mail_date(F.col("x")), x="Thu, 09 Apr 2026 10:00:00 GMT") == "2026-04-09"
    assert one(spark, dates.report_year(F.col("x")), x="informe 2019/20") == 2019
    assert one(spark, dates.report_year(F.col("x")), x=None) == -1
    at = lambda hhmm: F.lit(f"2024-01-10 {hhmm}:00").cast("timestamp")
    inside = [one(spark, dates.in_window(at(t), "22:00", "07:30", "UTC")) for t in ("23:15", "03:05", "08:00", "22:00", "07:30")]
    assert inside == [True, True, False, True, False]
    assert one(spark, dates.in_window(at("12:00"), "08:00", "08:00")) is True
    assert one(spark, dates.seconds_until(at("12:00"), "22:00", "UTC")) == 36_000
    assert one(spark, dates.seconds_until(at("22:00"), "22:00", "UTC")) == 86_400


def test_keys(spark, frame):
    cols = "source, external_id, title, company, publication_date, raw_location, municipality, island, province, source_url"
    schema = ", ".join(f"{c.strip()} string" for c in cols.split(","))
    rows = [
        {"source": "A", "external_id": "1", "source_url": " HTTP://X "},
        {"source": "A", "external_id": "1", "title": "T", "company": "C", "publication_date": "2024", "municipality": "M", "island": "I"},
        {"source": "A", "title": "T"},
        {},
    ]
    df = frame(rows, schema).select(keys.storage_key().alias("k"), keys.secondary_key().alias("s"), keys.job_key(F.lit(7)).alias("j"))
    got = [tuple(r) for r in df.collect()]
    assert got[0] == ("url::http://x", None, "job::a::1")
    assert got[1] == ("id::a::1", "sec::a::t::c::2024::m / i", "job::a::1")
    assert got[2][0] == "row::a::t::::::" and got[3] == (None, None, "job_row::unknown::7")


def test_cosine(spark):
    arr = lambda *xs: F.array(*[F.lit(float(x)) for x in xs])
    assert one(spark, scores.cosine(arr(1, 0), arr(1, 0))) == 1.0
    assert one(spark, scores.cosine(arr(1, 0), arr(0, 1))) == 0.0
    for a, b in ((arr(0, 0), arr(1, 1)), (arr(1), arr(1, 2)), (F.lit(None).cast("array<double>"), arr(1))):
        assert one(spark, scores.cosine(a, b)) == 0.0
    assert one(spark, scores.document_link_score(F.lit("Memoria verificada"), F.lit("http://x/nautica.pdf"), F.lit("Grado en Nautica"))) == 20
    assert one(spark, scores.page_link_score(F.lit("x"), F.lit("http://x/estudios/nautica"), F.lit("Grado en Nautica"))) == 8
