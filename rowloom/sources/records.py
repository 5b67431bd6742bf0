"""Raw offers of each source brought to the columns of a posting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from rowloom.functions.dates import parse_date
from rowloom.functions.keys import posting_id
from rowloom.functions.normalize import contract, place, province_of
from rowloom.functions.text import clean_text, plain_description

JOB_COLUMNS = [
    "source", "external_id", "title", "company", "description", "salary_text", "salary_min", "salary_max",
    "salary_currency", "salary_period", "publication_date", "update_date", "province", "province_raw", "municipality",
    "municipality_raw", "island", "island_raw", "raw_location", "contract_type", "contract_type_raw", "workday", "schedule",
    "vacancies", "target_degree_branches", "target_degree_titles", "degree_match_status", "source_url", "scraped_at",
]
JOB_SCHEMA = StructType([StructField(c, StringType()) for c in JOB_COLUMNS])
STATE_COLUMNS = [*JOB_COLUMNS, "job_key", "secondary_key", "payload_hash", "first_seen_at", "last_seen_at", "updated_at"]
STATE_SCHEMA = StructType([StructField(c, StringType()) for c in STATE_COLUMNS])


def _dash(col: Column) -> Column:
    """Null for a lone dash."""
    return F.nullif(clean_text(col), F.lit("-"))


def _job(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    return df.select(*[values.get(c, F.lit(None)).cast("string").alias(c) for c in JOB_COLUMNS])


def sce_records(offers: DataFrame, url_form: str, scraped_at: Column) -> DataFrame:
    """Offers of the public employment service; a dash is null, the id is joined with dots."""
    low, high = _dash(F.col("salarioMinimo")), _dash(F.col("salarioMaximo"))
    pay = F.nullif(F.concat_ws(" - ", low, high), F.lit(""))
    island, town = clean_text(F.col("islaUbicacionPuesto")), clean_text(F.col("municipioUbicacionPuesto"))
    sequence = clean_text(F.col("codigoSecuenciaOferta"))
    return _job(offers, {
        "source": F.lit("sce"),
        "external_id": F.concat_ws(".", clean_text(F.col("codigoCAOferta")), clean_text(F.col("codigoAnioOferta")), sequence),
        "title": F.coalesce(clean_text(F.col("ocupacionSolicitadaDefinicion")), F.lit("Oferta SCE")),
        "company": _dash(F.col("razonSocialEmpresario")), "description": _dash(F.col("informacionAdicional")),
        "salary_text": pay, "salary_min": low, "salary_max": high, "salary_currency": F.when(pay.isNotNull(), "EUR"),
        "publication_date": parse_date(F.col("fechaPublicacion")), "province": province_of(island), "municipality": town,
        "island": island, "raw_location": F.nullif(F.concat_ws(" / ", town, island), F.lit("")),
        "contract_type": _dash(F.col("tipoRelacionContractual")), "schedule": _dash(F.col("horarioTrabajo")),
        "vacancies": _dash(F.col("numeroPuestosOfrecidos")), "scraped_at": scraped_at,
        "source_url": F.format_string(url_form, F.url_encode(F.coalesce(sequence, F.lit("")))),
    })


def tourism_records(offers: DataFrame, scraped_at: Column) -> DataFrame:
    """Offer details ``(url, detail)`` of the tourism board, ``detail`` a struct of the page's JSON."""
    d = F.col("detail")
    number = lambda c: F.nullif(F.regexp_replace(c.cast("string"), r"\.0+$", ""), F.lit("0"))
    low, high = number(d.salary.salaryMin), number(d.salary.salaryMax)
    pay = F.nullif(F.concat_ws(" - ", low, high), F.lit(""))
    kind = clean_text(d.salary.salaryType)
    pay = F.when(F.coalesce(d.salary.salaryVisible.cast("boolean"), F.lit(False)) & pay.isNotNull(), F.concat_ws(" ", pay, kind))
    town, region = clean_text(d.location.cityName), clean_text(d.location.regionName)
    near = F.lower(F.concat_ws(" ", "url", region)).contains("canarias")
    return _job(offers, {
        "source": F.lit("turijobs"), "external_id": d.id, "title": F.coalesce(clean_text(d.title), F.lit("Oferta Turijobs")),
        "company": clean_text(d.company.enterpriseName), "description": clean_text(d.description), "salary_text": pay,
        "salary_min": low, "salary_max": high, "salary_currency": F.when(pay.isNotNull(), "EUR"), "salary_period": kind,
        "publication_date": parse_date(d.publicationDate), "province": region, "municipality": town,
        "island": F.when(near, "Islas Canarias"), "raw_location": F.nullif(F.concat_ws(" / ", town, region), F.lit("")),
        "source_url": F.col("url"), "scraped_at": scraped_at,
    })


def portal_records(offers: DataFrame, scraped_at: Column) -> DataFrame:
    """Offer details of a job portal's interface: ``id, title, profile, description, minPay, maxPay,
    salaryDescription, cityPD, city, province, contractType, journey, creationDate, updatedAt, link``,
    nested values as structs with a field ``value`` (pay with ``periodValue`` too).  Nulls stay null."""
    value = lambda c: clean_text(F.col(c)["value"].cast("string"))
    low, high = value("minPay"), value("maxPay")
    pay = F.coalesce(clean_text(F.col("salaryDescription")), F.nullif(F.concat_ws(" - ", low, high), F.lit("")))
    place = clean_text(F.concat_ws(" / ", F.nullif("city", F.lit("")), F.nullif(F.col("province")["value"], F.lit(""))))
    return _job(offers, {
        "source": F.lit("infojobs"), "external_id": F.col("id").cast("string"), "title": F.coalesce(clean_text(F.col("title")), F.lit("Oferta InfoJobs")),
        "company": clean_text(F.col("profile")["name"]), "description": clean_text(F.col("description")), "salary_text": pay, "salary_min": low,
        "salary_max": high, "salary_currency": F.when(pay.isNotNull(), "EUR"),
        "salary_period": clean_text(F.coalesce(F.nullif(F.col("minPay")["periodValue"], F.lit("")), F.col("maxPay")["periodValue"])),
        "publication_date": parse_date(F.col("creationDate")), "update_date": parse_date(F.col("updatedAt")), "province": value("province"),
        "municipality": F.coalesce(value("cityPD"), clean_text(F.col("city"))), "raw_location": place, "contract_type": value("contractType"),
        "workday": value("journey"), "scraped_at": scraped_at,
        "source_url": F.coalesce(F.nullif("link", F.lit("")), F.concat(F.lit("https://www.infojobs.net/oferta/"), F.col("id").cast("string"))),
    })


def listed_records(listing: DataFrame, details: DataFrame, source: str, scraped_at: Column, url_form: str = "%s") -> DataFrame:
    """Postings of a listing ``jobkey, title, companyName, formattedLocation, salary, date`` joined with what
    their pages say: ``details`` has ``jobkey`` and the fields of ``html.POSTING``, one row a key.

    Of repeated keys of the listing the first by title counts; a posting without a page keeps what the
    listing says.  A place "town, province" is split, without a comma it is the town."""
    one = listing.where(F.col("jobkey").isNotNull()).groupBy("jobkey").agg(F.min(F.struct("title", *[c for c in listing.columns if c not in ("jobkey", "title")])).alias("l"))
    rows = one.select("jobkey", "l.*").join(details.withColumnRenamed("salary_text", "page_salary"), "jobkey", "left")
    place = F.coalesce(clean_text(F.col("formattedLocation")), F.lit(""))
    parts = F.split(place, ",", 2)
    pay = F.coalesce(F.nullif("page_salary", F.lit("")), clean_text(F.col("salary")))
    return _job(rows, {
        "source": F.lit(source), "external_id": F.col("jobkey"), "title": F.coalesce(clean_text(F.col("title")), F.lit("Oferta Indeed")),
        "company": clean_text(F.col("companyName")), "description": clean_text(F.col("description")), "salary_text": pay,
        "salary_currency": F.when(pay.isNotNull(), "EUR"), "publication_date": parse_date(F.col("date")),
        "province": F.coalesce(clean_text(F.get(parts, F.lit(1))), F.lit("Las Palmas")), "municipality": clean_text(F.get(parts, F.lit(0))),
        "raw_location": place, "contract_type": F.col("contract_type"), "workday": F.col("workday"), "schedule": F.col("schedule"),
        "source_url": F.format_string(url_form, F.col("jobkey")), "scraped_at": scraped_at,
    })


# Words of a description and the contract that they tell, tried in this order.
DESCRIBED_CONTRACTS = [
    ("indefinido", "Contrato Indefinido"), ("temporal|duración determinada", "Contrato Temporal"), ("prácticas", "Prácticas"), ("becario", "Beca"),
]


def contract_told(kind: Column, description: Column) -> Column:
    """The contract type, or what the description tells of it; null if neither says one."""
    low, out = F.lower(description), F.lit(None).cast("string")
    for words, name in reversed(DESCRIBED_CONTRACTS):
        out = F.when(low.rlike(words), name).otherwise(out)
    return F.when(F.length(kind) > 0, clean_text(kind)).otherwise(out)


# Names of pay intervals and the periods they mean.
INTERVALS = {"yearly": "year", "monthly": "month", "weekly": "week", "daily": "day", "hourly": "hour"}


def board_records(rows: DataFrame, source: str, scraped_at: Column) -> DataFrame:
    """Rows of a job-board scraper; rows without a title are dropped, NaN amounts are null."""
    amount = lambda c: F.nanvl(F.col(c).try_cast("double"), F.lit(None)).try_cast("bigint")
    low, high = F.nullif(amount("min_amount"), F.lit(0)), F.nullif(amount("max_amount"), F.lit(0))
    interval = F.lower(clean_text(F.col("interval")))
    period = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in INTERVALS.items() for x in kv]), interval), interval)
    pay = F.nullif(F.concat_ws(" - ", low.cast("string"), high.cast("string")), F.lit(""))
    location = clean_text(F.col("location"))
    parts = F.split(location, ",")
    island = F.initcap(F.regexp_extract(F.lower(location), "(tenerife|gran canaria|lanzarote|fuerteventura|la palma|la gomera|el hierro)", 1))
    low_place = F.lower(F.coalesce(location, F.lit("")))
    province = F.when(low_place.rlike("las palmas|gran canaria|lanzarote|fuerteventura"), "Las Palmas").when(
        low_place.rlike("tenerife|la palma|gomera|hierro"), "Santa Cruz de Tenerife"
    )
    return _job(rows.where(clean_text(F.col("title")).isNotNull()), {
        "source": F.concat_ws("_", F.lit(source), F.coalesce(clean_text(F.col("site")), F.lit("unknown"))),
        "external_id": posting_id(F.col("job_url")), "title": clean_text(F.col("title")), "company": clean_text(F.col("company")),
        "description": plain_description(F.col("description")), "salary_text": F.concat_ws(" ", pay, F.when(pay.isNotNull(), period)),
        "salary_min": low, "salary_max": high, "salary_currency": F.when(pay.isNotNull(), "EUR"), "salary_period": F.when(pay.isNotNull(), period),
        "publication_date": parse_date(F.col("date_posted")), "province": province, "municipality": F.nullif(F.trim(F.get(parts, F.lit(0))), F.lit("")),
        "island": F.nullif(island, F.lit("")), "raw_location": location, "contract_type": contract_told(F.col("job_type"), F.col("description")),
        "source_url": F.coalesce(clean_text(F.col("job_url")), F.lit("")), "scraped_at": scraped_at,
    })


def clean_records(df: DataFrame) -> DataFrame:
    """Every column cleaned, dates in ISO form, place and contract canonical with the raw values
    beside them.  Rows without a title are dropped; columns that are not of a posting stay."""
    there = [c for c in JOB_COLUMNS if c in df.columns and c != "scraped_at"]
    rest = [c for c in df.columns if c not in there]
    # An explode of one element evaluates what follows from it once, however often it is used.
    once = lambda x, name: F.explode(F.array(x)).alias(name)
    rows = df.select(*rest, once(F.struct(*[clean_text(F.col(c)).alias(c) for c in there]), "__c")).select(*rest, "__c.*")
    spot = place(F.col("province"), F.col("municipality"), F.col("island"), F.col("raw_location"), cleaned=True)
    kind = contract(F.col("contract_type"), cleaned=True)
    day = {c: parse_date(F.col(c), cleaned=True).alias(c) for c in ("publication_date", "update_date")}
    rows = rows.where(F.col("title").isNotNull()).select("*", once(F.struct(spot.alias("p"), kind.alias("k"), *day.values()), "__n"))
    p = F.col("__n.p")
    rebuilt = F.nullif(F.concat_ws(" / ", p.municipality, p.island, p.province), F.lit(""))
    values = {
        "source": F.lower(F.coalesce("source", F.lit("unknown"))), "external_id": F.coalesce("external_id", F.lit("")),
        "publication_date": F.col("__n.publication_date"), "update_date": F.col("__n.update_date"),
        "province_raw": F.col("province"), "municipality_raw": F.col("municipality"), "island_raw": F.col("island"),
        "contract_type_raw": F.col("contract_type"), "province": p.province, "municipality": p.municipality, "island": p.island,
        "raw_location": F.coalesce(p.raw_location, rebuilt), "contract_type": F.col("__n.k.contract_type"),
        "source_url": F.coalesce("source_url", F.lit("")),
    }
    return rows.select(*[values.get(c, F.col(c)).alias(c) for c in df.columns])
