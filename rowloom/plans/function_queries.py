"""Named queries of single functions and small operators over whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.functions import scores, text
from rowloom.functions.dates import in_window, report_year, seconds_until
from rowloom.operators import catalog, mapping, vectors
from rowloom.plans.core_queries import _ASCII, _MATCH, _REGISTRY_SQL, SQL_CLEAN, SQL_SPACE, norm_sql
from rowloom.plans.registry import query
from rowloom.session import shared_dir, table
from rowloom.sources import tables
from rowloom.sources.records import contract_told

# --- texts -----------------------------------------------------------------------------------------

_WORDS = "list_filter(string_split_regex(lower(title), '[^\\p{L}\\p{N}]+'), lambda w: length(w) > 3 AND w NOT IN ('grado', 'master', 'doctorado', 'universitario', 'oficial', 'titulo'))"


@query(
    "title_forms",
    f"""SELECT row_id, {_ASCII.format("title")} AS ascii, {_MATCH.format("coalesce(title, '')")} AS match, coalesce(list_aggregate({_WORDS}, 'string_agg', '|'), '') AS words FROM degrees""",
)
def q_title_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.col("title")
    return table(spark, sf_dir, "degrees").select(
        "row_id", text.norm_ascii(F.coalesce(title, F.lit(""))).alias("ascii"), text.norm_match(title).alias("match"),
        F.coalesce(F.array_join(text.title_tokens(title), "|"), F.lit("")).alias("words"),
    )


_DOUBLED = SQL_SPACE.format("title")
for _prefix in ("Grado", "M[aá]ster Universitario", "M[aá]ster", "Doctorado", "Programa de Doctorado"):
    _DOUBLED = f"regexp_replace({_DOUBLED}, '(?i)^({_prefix}) en (?:{_prefix}) en ', '\\1 en ')"


@query("degree_titles", f"SELECT row_id, {_DOUBLED} AS title FROM (SELECT row_id, 'Grado en ' || title AS title FROM degrees)")
def q_degree_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles with a prefix that many of them have already."""
    rows = table(spark, sf_dir, "degrees")
    return rows.select("row_id", text.degree_title(F.concat(F.lit("Grado en "), F.col("title"))).alias("title"))


_MARKED = f"trim(replace({SQL_SPACE.format('t')}, 'Nuevo/New', ''))"
for _mark in ("Nuevo en 2026/2027", "Nuevo en 2026", "Plan nuevo \\(2026\\)", "Plan nuevo", "Nuevo"):
    _MARKED = f"trim(regexp_replace({_MARKED}, '{_mark}$', ''))"


@query(
    "program_titles",
    f"""WITH m AS (SELECT row_id, {_MARKED} AS t FROM (SELECT row_id, coalesce(title, '') || CASE row_id % 3 WHEN 0 THEN ' Nuevo en 2026' WHEN 1 THEN '  Plan nuevo' ELSE '' END AS t FROM degrees))
        SELECT row_id, CASE WHEN t = '' THEN 'Unknown title' ELSE substr(t, 1, 250) END AS title FROM m""",
)
def q_program_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles with novelty marks behind them."""
    mark = F.when(F.col("row_id") % 3 == 0, " Nuevo en 2026").when(F.col("row_id") % 3 == 1, "  Plan nuevo").otherwise("")
    label = F.concat(F.coalesce("title", F.lit("")), mark)
    return table(spark, sf_dir, "degrees").select("row_id", text.program_title(label).alias("title"))


@query(
    "report_sections",
    f"""WITH t AS (SELECT doc_id, 'Cabecera MOTIVACIÓN ' || text || ' RECOMENDACIONES fin' AS t FROM documents)
        SELECT doc_id, nullif(substr(trim(regexp_replace(regexp_extract(t, '(?is)MOTIVACI[OÓ]N(.*?)(?:RECOMENDACIONES|En Madrid, a)', 1), '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g')), 1, 4000), '') AS section FROM t""",
)
def q_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents between the headings of a report."""
    body = F.concat(F.lit("Cabecera MOTIVACIÓN "), F.col("text"), F.lit(" RECOMENDACIONES fin"))
    return table(spark, sf_dir, "documents").select("doc_id", text.report_section(body).alias("section"))


@query(
    "contract_told",
    f"""SELECT row_id, CASE WHEN length(contract_type_raw) > 0 AND row_id % 2 = 0 THEN {SQL_CLEAN.format('contract_type_raw')}
        WHEN regexp_matches(lower(description), 'indefinido') THEN 'Contrato Indefinido' WHEN regexp_matches(lower(description), 'temporal|duración determinada') THEN 'Contrato Temporal'
        WHEN regexp_matches(lower(description), 'prácticas') THEN 'Prácticas' WHEN regexp_matches(lower(description), 'becario') THEN 'Beca' END AS contract FROM jobs""",
)
def q_contract_told(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract types of every second row, the others by their descriptions."""
    kind = F.when(F.col("row_id") % 2 == 0, F.col("contract_type_raw"))
    return table(spark, sf_dir, "jobs").select("row_id", contract_told(kind, F.col("description")).alias("contract"))


# --- dates -----------------------------------------------------------------------------------------


@query("report_years", "SELECT row_id, coalesce(TRY_CAST(nullif(regexp_extract(coalesce(scraped_at, ''), '(19|20)[0-9]{2}', 0), '') AS INTEGER), -1) AS year FROM degrees")
def q_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "degrees").select("row_id", report_year(F.col("scraped_at")).alias("year"))


def _last_sunday(month: int) -> str:
    """The change of summer time of a year in UTC: one o'clock of the last Sunday of a month."""
    end = f"make_date(year(ts), {month}, 31)"
    return f"({end} - CAST(dayofweek({end}) AS INTEGER)) + INTERVAL 1 HOUR"


_MADRID = f"ts + CASE WHEN ts >= {_last_sunday(3)} AND ts < {_last_sunday(10)} THEN INTERVAL 2 HOUR ELSE INTERVAL 1 HOUR END"


@query(
    "madrid_window",
    f"""SELECT event_id, (strftime(l, '%H:%M') >= '22:00' OR strftime(l, '%H:%M') < '07:30') AS active,
        greatest(1, (79200 - (hour(l) * 3600 + minute(l) * 60 + second(l)) - 1 + 86400) % 86400 + 1) AS wait FROM (SELECT event_id, {_MADRID} AS l FROM events)""",
)
def q_madrid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The night window in a zone with summer time, and the seconds until its start."""
    events = table(spark, sf_dir, "events")
    wait = seconds_until(F.col("ts"), "22:00").cast("bigint")
    return events.select("event_id", in_window(F.col("ts"), "22:00", "07:30").alias("active"), wait.alias("wait"))


# --- links -----------------------------------------------------------------------------------------


@query(
    "link_scores",
    f"""WITH t AS (SELECT row_id, lower(concat_ws(' ', title, source_url)) AS x, lower(source_url) AS u, title, {_WORDS} AS w FROM degrees WHERE title IS NOT NULL AND source_url IS NOT NULL)
        SELECT row_id, CASE WHEN contains(x, 'memoria') THEN 10 ELSE 0 END + CASE WHEN contains(x, 'verifica') THEN 6 ELSE 0 END
               + 3 * CAST(length(list_filter(w, lambda k: contains(x, k))) AS INTEGER) + CASE WHEN ends_with(u, '.pdf') THEN 1 ELSE 0 END AS document,
               CASE WHEN regexp_matches(u, 'grado|master|doctorado|estudios') THEN 3 ELSE 0 END
               + CASE WHEN length(list_filter(w, lambda k: contains(lower(title) || ' ' || u, k))) > 0 THEN 5 ELSE 0 END + CASE WHEN length(title) >= 20 THEN 1 ELSE 0 END AS page FROM t""",
)
def q_link_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "degrees").where("title is not null and source_url is not null")
    args = (F.col("title"), F.col("source_url"), F.col("title"))
    return rows.select("row_id", scores.document_link_score(*args).alias("document"), scores.page_link_score(*args).alias("page"))


@query(
    "memory_ladder",
    """WITH f AS (SELECT university_id, title, min(source_url) AS found FROM degrees WHERE university_id IS NOT NULL AND title IS NOT NULL AND source_url IS NOT NULL AND row_id % 2 = 0 GROUP BY ALL),
            r AS (SELECT DISTINCT university_id FROM universities WHERE university_type = 'publica'),
            d AS (SELECT d.*, f.found, len(list_filter(string_split(coalesce(memory_url, ''), '|'), lambda u: u <> '' AND NOT contains(lower(u), 'aneca'))) > 0 AS own,
                  d.university_id IN (SELECT university_id FROM r) AS known FROM degrees d LEFT JOIN f USING (university_id, title))
       SELECT row_id, CASE WHEN own THEN 'already_present' WHEN known AND found IS NOT NULL THEN 'resolved' ELSE 'unresolved' END AS status,
              CASE WHEN own THEN NULL WHEN NOT coalesce(known, false) THEN 'no_resolver' WHEN found IS NULL THEN 'no_memory_link_found' END AS error FROM d""",
)
def q_memories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses of every second degree taken for the memories that a resolver found."""
    degrees = table(spark, sf_dir, "degrees")
    found = degrees.where("university_id is not null and title is not null and source_url is not null and row_id % 2 = 0")
    found = found.groupBy("university_id", "title").agg(F.min("source_url").alias("memory_url"))
    # The registry is fixed and small.
    known = [r[0] for r in table(spark, sf_dir, "universities").where("university_type = 'publica'").select("university_id").distinct().limit(1000).collect()]
    rows = catalog.memory_resolution(degrees, found, known)
    return rows.select("row_id", F.col("memory_resolution_status").alias("status"), F.col("memory_resolution_error").alias("error"))


# --- catalogue and files ---------------------------------------------------------------------------


@query(
    "preferred_reports",
    """WITH r AS (SELECT university, source_url AS url, coalesce(TRY_CAST(nullif(regexp_extract(coalesce(scraped_at, ''), '(19|20)[0-9]{2}', 0), '') AS INTEGER), -1) AS year
                  FROM degrees WHERE source_url IS NOT NULL AND university IS NOT NULL)
       SELECT university, url, year FROM r QUALIFY row_number() OVER (PARTITION BY university ORDER BY year DESC, url DESC) = 1""",
)
def q_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses as reports: the newest of each university."""
    rows = table(spark, sf_dir, "degrees").where("source_url is not null and university is not null")
    return catalog.preferred_report(rows.select("university", F.col("source_url").alias("url"), F.col("scraped_at").alias("year")), "university")


@query("registered", f"WITH {_REGISTRY_SQL} SELECT row_id FROM degrees d WHERE {_MATCH.format("coalesce(d.university, '')")} IN (SELECT alias FROM al)")
def q_registered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.only_registered(table(spark, sf_dir, "degrees"), table(spark, sf_dir, "universities")).select("row_id")


@query(
    "description_fields",
    """SELECT row_id, coalesce(description_status, CASE WHEN has_text THEN 'ok' ELSE 'missing' END) AS status,
       coalesce(description_source_type, CASE WHEN has_text THEN coalesce(description_source, 'unknown') END) AS kind,
       coalesce(description_source_url, CASE WHEN has_text THEN coalesce(report_url, nullif(string_split(memory_url, '|')[1], ''), source_url) END) AS url
       FROM (SELECT *, length(trim(coalesce(description, ''))) > 0 AS has_text FROM degrees)""",
)
def q_description_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = catalog.description_fields(table(spark, sf_dir, "degrees"))
    return rows.select("row_id", F.col("description_status").alias("status"), F.col("description_source_type").alias("kind"), F.col("description_source_url").alias("url"))


@query(
    "canonical_names",
    f"""WITH c AS (SELECT {norm_sql('title')} AS n, title FROM degrees WHERE title IS NOT NULL QUALIFY row_number() OVER (PARTITION BY {norm_sql('title')} ORDER BY row_id) = 1)
        SELECT row_id, coalesce(c.title, j.title) AS canonical FROM jobs j LEFT JOIN c ON c.n = {norm_sql('j.title')}""",
)
def q_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles of postings in the catalogue's spelling, where it has them."""
    names = table(spark, sf_dir, "jobs").select("row_id", F.col("title").alias("name"))
    return mapping.canonical_names(names, table(spark, sf_dir, "degrees").select("row_id", "title"), "row_id").select("row_id", "canonical")


@query(
    "csv_round_trip",
    "SELECT CAST(row_id AS VARCHAR) AS row_id, title, description, source_url FROM jobs QUALIFY row_number() OVER (PARTITION BY coalesce(source_url, '') ORDER BY row_id) = 1",
)
def q_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings written as CSV, read again, the first of each address."""
    path = f"{shared_dir(spark).rstrip('/')}/csv-jobs-{abs(hash(sf_dir))}"
    rows = table(spark, sf_dir, "jobs").select("row_id", "title", "description", "source_url").orderBy("row_id")
    tables.write_csv(rows, path)
    again = tables.read_csv(spark, path, ["row_id", "title", "description", "source_url"])
    return tables.first_per_url(again)


@query(
    "embedding_pairs",
    """WITH h AS (SELECT DISTINCT trim(coalesce(nullif(description, ''), title, '')) AS t FROM jobs) SELECT count(*) AS texts, count(*) AS embedded FROM h WHERE length(t) > 0""",
)
def q_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each distinct text of the postings embedded once."""
    from rowloom.operators.pairing import gate_text

    texts = table(spark, sf_dir, "jobs").select(gate_text().alias("t"))
    distinct = texts.where(F.length("t") > 0).distinct().withColumn("text_hash", F.sha2("t", 256)).withColumnRenamed("t", "text")
    made = vectors.embed_texts(distinct, vectors.hashing_provider(16))
    return made.agg(F.count("*").alias("texts"), F.count_if(F.size("vector") == 16).alias("embedded"))
