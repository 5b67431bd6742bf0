"""The degree catalogue: records, registry, duplicates, gates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rowloom.functions.dates import report_year
from rowloom.functions.keys import catalogue_key, stable_source_id
from rowloom.functions.text import norm_match
from rowloom.operators.joins import is_small
from rowloom.operators.select import first_per_key
from rowloom.sources import html

DEGREE_COLUMNS = [
    "source", "source_id", "university", "title", "title_type", "university_id", "university_type", "branch", "center",
    "modality", "language", "credits", "status", "memory_url", "report_url", "source_url", "memory_resolution_source",
    "memory_resolution_status", "memory_resolution_error", "description", "description_source", "scraped_at",
    "description_source_type", "description_source_url", "description_status", "description_quality_flag",
]
TITLE_TYPES = ["grado", "master", "doctorado"]

# The names under which payloads carry a column, first choice first.
PAYLOAD_NAMES = {
    "source_id": ["source_id", "id", "codigo"], "university": ["university", "universidad"], "title": ["title", "titulo"],
    "title_type": ["title_type", "tipo"], "branch": ["branch", "rama"], "center": ["center", "centro"],
    "modality": ["modality", "modalidad"], "language": ["language", "idioma"], "credits": ["credits", "creditos"],
    "status": ["status", "estado"], "memory_url": ["memory_url", "url_memoria"], "report_url": ["report_url", "url_informe"],
    "source_url": ["source_url", "url"], "description": ["description", "descripcion"],
}


def payload_records(payload: DataFrame, source: str, scraped_at: Column) -> DataFrame:
    """Records of one source in the catalogue's columns, all text.  A column may come under
    several names; university and title that are missing become ``Unknown``."""
    there = set(payload.columns)

    def value(name: str) -> Column:
        found = [F.nullif(F.col(n).cast("string"), F.lit("")) for n in PAYLOAD_NAMES.get(name, [name]) if n in there]
        return F.coalesce(*found) if found else F.lit(None).cast("string")

    fixed = {"source": F.lit(source), "scraped_at": scraped_at.cast("string")}
    fixed |= {n: F.coalesce(value(n), F.lit("Unknown")) for n in ("university", "title")}
    return payload.select(*[fixed.get(n, value(n)).alias(n) for n in DEGREE_COLUMNS])


def payload_arrays(document: DataFrame, names: list[str]) -> dict[str, DataFrame]:
    """The arrays of structs of a nested document as tables; missing ones are left out."""
    fields: StructType = document.schema
    return {n: document.select(F.explode(n).alias("r")).select("r.*") for n in names if n in fields.names}


def registry_aliases(registry: DataFrame) -> DataFrame:
    """``(alias, university_id, canonical_name, university_type)``: every normalised name once, the
    canonical one included; of several entries with one name the first by id."""
    names = F.concat(F.array("canonical_name"), F.split(F.coalesce("aliases", F.lit("")), r"\|"))
    rows = registry.select("university_id", "canonical_name", "university_type", F.explode(names).alias("name"))
    rows = rows.select(norm_match(F.col("name")).alias("alias"), "university_id", "canonical_name", "university_type")
    return first_per_key(rows.where("alias <> ''"), F.col("alias"), [F.col("university_id")])


def attach_registry(records: DataFrame, registry: DataFrame) -> DataFrame:
    """University columns overwritten where the name is known, untouched elsewhere."""
    names = registry_aliases(registry).select(
        "alias", F.col("university_id").alias("__id"), F.col("canonical_name").alias("__name"), F.col("university_type").alias("__type")
    )
    names = F.broadcast(names) if is_small(names) else names
    joined = records.withColumn("alias", norm_match(F.col("university"))).join(names, "alias", "left")
    found = {"university_id": "__id", "university": "__name", "university_type": "__type"}
    return joined.withColumns({c: F.coalesce(n, c) for c, n in found.items()}).drop("alias", "__id", "__name", "__type")


def last_per_title(records: DataFrame, ordinal: Column) -> DataFrame:
    """Of records with one university, title and type the last; sorted by university and title."""
    kept = first_per_key(records.withColumn("__k", catalogue_key()), F.col("__k"), [ordinal.desc()])
    return kept.drop("__k").orderBy("university", "title")


def description_fields(records: DataFrame) -> DataFrame:
    """Status, type and address of the description filled in from what is there."""
    some = F.length(F.trim(F.coalesce("description", F.lit("")))) > 0
    memory = F.nullif(F.get(F.split("memory_url", r"\|"), F.lit(0)), F.lit(""))
    return records.withColumns({
        "description_status": F.coalesce("description_status", F.when(some, "ok").otherwise("missing")),
        "description_source_type": F.coalesce("description_source_type", F.when(some, F.coalesce("description_source", F.lit("unknown")))),
        "description_source_url": F.coalesce("description_source_url", F.when(some, F.coalesce("report_url", memory, "source_url"))),
    })


def description_coverage(records: DataFrame) -> DataFrame:
    """One row: records, described ones, their ratio and a map of described records per source."""
    some = F.length(F.trim(F.coalesce("description", F.lit("")))) > 0
    per = records.groupBy(F.coalesce("description_source", F.lit("unknown")).alias("s")).agg(
        F.count("*").alias("n"), F.count_if(some).alias("d")
    )
    return per.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.coalesce(F.sum("d"), F.lit(0)).alias("described"),
        F.coalesce(F.sum("d") / F.sum("n"), F.lit(0.0)).alias("ratio"),
        F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("d") > 0, F.struct("s", "d"))))).alias("per_source"),
    )


def inventory_grid(records: DataFrame, universities: DataFrame, types: list[str] = TITLE_TYPES) -> DataFrame:
    """``(university_id, title_type, n)`` of every wanted combination, 0 where there is none.

    The wanted grid is an explode of the universities by the few types, no cross join."""
    wanted = universities.select("university_id").distinct()
    wanted = wanted.select("university_id", F.explode(F.array(*map(F.lit, types))).alias("title_type"))
    there = records.groupBy("university_id", "title_type").agg(F.count("*").alias("n"))
    joined = wanted.join(there, ["university_id", "title_type"], "left")
    return joined.select("university_id", "title_type", F.coalesce("n", F.lit(0)).alias("n"))


def inventory_completeness(records: DataFrame, universities: DataFrame, types: list[str] = TITLE_TYPES) -> DataFrame:
    """One row: ratios of universities, types and combinations that occur, and those that are missing."""
    grid = inventory_grid(records, universities, types)
    per = grid.groupBy("university_id").agg(F.sum("n").alias("n"))
    absent = per.agg(
        F.array_sort(F.collect_list(F.when(F.col("n") == 0, F.col("university_id")))).alias("missing_universities"),
        F.avg((F.col("n") > 0).cast("double")).alias("university_ratio"), F.lit(1).alias("j"),
    )
    combos = grid.agg(
        F.array_sort(F.collect_list(F.when(F.col("n") == 0, F.struct("university_id", "title_type")))).alias("missing_pairs"),
        F.avg((F.col("n") > 0).cast("double")).alias("pair_ratio"), F.lit(1).alias("j"),
    )
    kinds = grid.groupBy("title_type").agg(F.sum("n").alias("n")).agg(
        F.array_sort(F.collect_list(F.when(F.col("n") == 0, F.col("title_type")))).alias("missing_types"),
        F.avg((F.col("n") > 0).cast("double")).alias("type_ratio"), F.lit(1).alias("j"),
    )
    return absent.join(kinds, "j").join(combos, "j").drop("j")


def gate(report: DataFrame, column: str, least: float | None) -> tuple[bool, str]:
    """Whether the one-row report reaches a ratio; no threshold passes."""
    if least is None:
        return True, "no threshold"
    value = report.select(column).first()[0] or 0.0
    return value >= least, f"{column} {value:.3f}, wanted {least:.3f}"


def blocked_records(records: DataFrame, valid_title: Column, valid_url: Column) -> DataFrame:
    """Records that a gate stops, each with the first reason."""
    empty = lambda c: F.length(F.trim(F.coalesce(c, F.lit("")))) == 0
    # An explode of one element evaluates the two tests once.
    tests = F.explode(F.array(F.struct(valid_title.alias("title"), valid_url.alias("url")))).alias("__valid")
    reason = (
        F.when(empty("title"), "missing_title").when(empty("source_url"), "missing_url").when(empty("university_id"), "missing_university")
        .when(~F.coalesce("__valid.title", F.lit(False)), "invalid_title").when(~F.coalesce("__valid.url", F.lit(False)), "invalid_url")
    )
    return records.select("*", tests).withColumn("reason", reason).where(F.col("reason").isNotNull()).drop("__valid")


def preferred_report(reports: DataFrame, key: str) -> DataFrame:
    """``(key, url, year)``: the newest report, a missing year counting as -1, ties by address."""
    best = reports.groupBy(key).agg(F.max(F.struct(report_year(F.col("year")).alias("year"), F.col("url"))).alias("b"))
    return best.select(key, "b.url", "b.year")


def best_link(links: DataFrame, key: str, score: Column, position: str) -> DataFrame:
    """The link with the highest score per key, the first of equals."""
    return first_per_key(links.withColumn("score", score), F.col(key), [F.desc("score"), F.col(position)])


def best_programme(candidates: DataFrame, position: str) -> DataFrame:
    """Per lower-case title and type the candidate of the highest rank, the first of equals.

    A page outranks a PDF, plans of studies outrank other pages, evidence adds one each."""
    url = F.lower("source_url")
    # Marks of addresses of plans of studies, and the weights.
    rank = (
        F.size("evidence_urls") + F.when(url.endswith(".pdf"), 0).otherwise(5)
        + F.when(url.contains("www2.ulpgc.es") | url.contains("plan-estudio"), 3).otherwise(0)
    )
    keyed = candidates.withColumn("rank", rank).withColumn("__k", F.concat_ws("\u001f", F.lower("title"), "title_type"))
    return first_per_key(keyed, F.col("__k"), [F.desc("rank"), F.col(position)]).drop("__k")


def memory_resolution(records: DataFrame, found: DataFrame, resolvers: list[str]) -> DataFrame:
    """The ladder of a degree's memory: an address that is no agency report is there already,
    a university without resolver is unresolved, else what the resolver found.

    ``found`` has ``(university_id, title, memory_url)``, at most one row per pair."""
    own = F.filter(F.split(F.coalesce("memory_url", F.lit("")), r"\|"), lambda u: (u != "") & ~F.lower(u).contains("aneca"))
    hit = found.select("university_id", "title", F.col("memory_url").alias("__found"))
    joined = records.join(hit, ["university_id", "title"], "left")
    known = F.col("university_id").isin(resolvers)
    there = F.size(own) > 0
    status = F.when(there, "already_present").when(known & F.col("__found").isNotNull(), "resolved").otherwise("unresolved")
    error = F.when(there, None).when(~F.coalesce(known, F.lit(False)), "no_resolver").when(F.col("__found").isNull(), "no_memory_link_found")
    return joined.withColumns({
        "memory_resolution_status": status, "memory_resolution_error": error,
        "memory_resolution_source": F.when(~there & known, F.concat(F.lit("university_"), "university_id")),
        "memory_url": F.when(there, F.col("memory_url")).otherwise(F.coalesce("__found", "memory_url")),
    }).drop("__found")


def crawl_indexes(
    pages: DataFrame, registry: DataFrame, scraped_at: Column, cycles: list[str] = TITLE_TYPES, most: int = 120, details: DataFrame | None = None,
) -> DataFrame:
    """Degrees of the universities' own index pages in the catalogue's columns.

    ``pages`` has ``university_id, path_no, html, url``.  Of each page the first ``most`` candidates
    count; of candidates with one university, title and type the first by path and place; then the
    cycles that were not asked for are left out.  ``details`` (``source_url, html``) gives the
    descriptions; a page that is missing there is an ``error``.  Unknown cycles are an error.
    """
    unknown = set(cycles) - set(TITLE_TYPES)
    if unknown:
        raise ValueError(f"unknown cycles {sorted(unknown)}")
    how = F.create_map(*[F.lit(x) for kv in html.STRATEGIES.items() for x in kv])
    known = registry.select("university_id", "canonical_name", "university_type").dropDuplicates(["university_id"])
    pages = pages.withColumn("how", F.element_at(how, F.col("university_id")))
    found = html.programme_candidates(pages, "how", keep=["university_id", "path_no"])
    place = F.row_number().over(Window.partitionBy("university_id", "path_no").orderBy("position", "source_url"))
    found = found.withColumn("__place", place).where(F.col("__place") <= most)
    key = F.concat_ws("\u001f", "university_id", F.lower("title"), "title_type")
    found = first_per_key(found.withColumn("__k", key), F.col("__k"), [F.col("path_no"), F.col("__place")]).where(F.col("title_type").isin(cycles))
    rows = found.join(F.broadcast(known) if is_small(known) else known, "university_id")
    rows = rows.withColumn("source_id", stable_source_id(F.col("university_id"), F.col("title"), F.col("source_url")))
    values = {
        "source": F.lit("university_official_live"), "university": F.col("canonical_name"), "scraped_at": scraped_at.cast("string"),
        "description_status": F.lit("missing"),
    }
    if details is not None:
        read = details.groupBy("source_url").agg(F.min("html").alias("html")).select("source_url", F.lit(True).alias("__read"), html.description_udf(F.col("html")).alias("__text"))
        rows = rows.join(read, "source_url", "left")
        some = F.col("__text").isNotNull()
        values |= {
            "description": F.col("__text"), "description_quality_flag": page_quality(F.col("__text")),
            "description_status": F.when(F.col("__read").isNull(), "error").when(some, "ok").otherwise("missing"),
            "description_source": F.when(some, "university_program_page"), "description_source_type": F.when(some, "university_program_page"),
            "description_source_url": F.when(some, F.col("source_url")),
        }
    there = {"source_id", "title", "title_type", "university_id", "university_type", "source_url"}
    return rows.select(*[values.get(c, F.col(c) if c in there else F.lit(None)).cast("string").alias(c) for c in DEGREE_COLUMNS])


def only_registered(records: DataFrame, registry: DataFrame) -> DataFrame:
    """Records of universities that the registry knows under any name."""
    names = registry_aliases(registry).select("alias")
    names = F.broadcast(names) if is_small(names) else names
    return records.withColumn("alias", norm_match(F.col("university"))).join(names, "alias", "left_semi").drop("alias")


def resolve_links(records: DataFrame, links: DataFrame, score: Callable[[Column, Column, Column], Column], least: int = 1) -> DataFrame:
    """``(university_id, title, url, score)``: for each degree the best link of its university.

    ``links`` has ``university_id, label, url, position``; ``score`` takes label, address and
    title.  Of equal scores the first link wins; degrees without a link of ``least`` give no row."""
    wanted = records.select("university_id", "title").where("university_id is not null and title is not null").distinct()
    pairs = wanted.join(links.select("university_id", "label", "url", "position"), "university_id")
    pairs = pairs.withColumn("score", score(F.col("label"), F.col("url"), F.col("title"))).where(F.col("score") >= least)
    key = F.struct("university_id", "title")
    best = first_per_key(pairs.withColumn("__k", key), F.col("__k"), [F.desc("score"), F.col("position")])
    return best.select("university_id", "title", "url", "score")


def page_quality(description: Column) -> Column:
    """``high`` from 500 characters, else ``medium``; null without a description."""
    return F.when(F.length(description) >= 500, "high").when(F.length(description) > 0, "medium")


def description_urls(with_report: bool) -> Column:
    """Addresses that may hold a description, in order and distinct: the memories, then the report."""
    memories = F.filter(F.split(F.coalesce("memory_url", F.lit("")), r"\|"), lambda u: u != "")
    report = F.array("report_url") if with_report else F.array().cast("array<string>")
    return F.array_distinct(F.filter(F.concat(memories, report), lambda u: u.isNotNull() & (u != "")))
