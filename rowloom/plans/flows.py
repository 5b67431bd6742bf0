"""Complete pipelines: postings, catalogue, alignment, and all of them in a row.

A flow is a function of DataFrames; where it keeps state it takes a ``StateTable``.  Nothing
here reads the network or the clock: the caller hands over records and ``as_of``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowloom.functions.keys import degree_key, job_key, pair_key, storage_key
from rowloom.operators import analytics, catalog, mapping, pairing, select, state, vectors
from rowloom.operators.state import StateTable
from rowloom.session import cut_lineage
from rowloom.sources.records import JOB_COLUMNS, clean_records
from rowloom.sources.html import is_programme_title, is_programme_url
from rowloom.streaming.cycles import keyed, run_cycle

# Shares of the scaled collection, its ceiling and the cap of one source.
SHARES = {"indeed": 0.82, "sce": 0.13, "turijobs": 0.05}
MOST_ROWS = 40_000
SOURCE_CAPS = {"turijobs": 120}
PER_SOURCE = 50


@dataclass
class Outcome:
    """What a flow did: counters by name, and a message where a gate stopped it."""

    ok: bool
    counts: dict[str, int]
    message: str = ""


def select_standard(records: DataFrame, most: int) -> DataFrame:
    """Cleaned postings, every source represented, newest first; ties by address and id."""
    order = [F.coalesce("publication_date", F.lit("")).desc(), F.col("source").desc(), F.col("source_url"), F.col("external_id")]
    return select.cover_sources(clean_records(records), "source", "source_url", order, most)


def select_scaled(records: DataFrame, most: int = MOST_ROWS, shares: dict[str, float] = SHARES) -> DataFrame:
    """Cleaned postings, the first of each identity, at most a quota per source family."""
    rows = clean_records(records).withColumn("__k", storage_key(lower_source=False, full_place=False))
    rows = select.first_per_key(rows.where("__k is not null"), F.col("__k"), [F.col("scraped_at"), F.col("external_id")]).drop("__k")
    family = F.when(F.col("source").contains("indeed"), "indeed").otherwise(F.get(F.split("source", "_"), F.lit(0)))
    quota = select.quotas(shares, most, "turijobs", SOURCE_CAPS, "indeed", SHARES)
    order = [F.coalesce("publication_date", F.lit("")).desc(), F.col("source").desc(), F.col("source_url"), F.col("external_id")]
    return select.take_quotas(rows.withColumn("__f", family), "__f", quota, order).drop("__f")


def limit_sources(records: DataFrame, most: int = PER_SOURCE) -> DataFrame:
    """At most ``most`` records of each source, the first by address and id."""
    ranked = records.withColumn("__rn", F.row_number().over(Window.partitionBy("source").orderBy("source_url", "external_id", "title")))
    return ranked.where(F.col("__rn") <= most).drop("__rn")


def annotate(records: DataFrame, catalogue: DataFrame, ordinal: str) -> DataFrame:
    """Postings with their degree candidates in the three target columns."""
    rows = records.drop("target_degree_titles", "target_degree_branches", "degree_match_status").withColumn("__id", F.col("job_key"))
    found = mapping.map_degrees(rows.dropDuplicates(["__id"]), catalogue, "__id", ordinal)
    return rows.join(found.drop("best_score", "n_kept"), "__id", "left").drop("__id")


def jobs_flow(records: DataFrame, catalogue: DataFrame, table: StateTable, as_of: str, most: int = 10_000, scaled: bool = False) -> Outcome:
    """Collect, clean, select, map, upsert."""
    chosen = select_scaled(records, most) if scaled else select_standard(records, most)
    rows = keyed(chosen).drop("secondary_key", "payload_hash", "__ordinal")
    ordered = catalogue.withColumn("__o", F.monotonically_increasing_id())
    mapped = cut_lineage(annotate(rows, ordered, "__o").select(*JOB_COLUMNS))
    counts = run_cycle(mapped, table, as_of, clean=False)
    return Outcome(True, counts)


def compact_flow(table: StateTable) -> Outcome:
    before = table.read()
    n = before.count()
    after = cut_lineage(state.compact(before))
    table.write(after)
    return Outcome(True, {"before": n, "after": after.count()})


def catalogue_flow(
    document: DataFrame, registry: DataFrame, scraped_at: str, table: StateTable | None = None, *, names: dict[str, str] | None = None,
    least_described: float | None = None, least_complete: float | None = None, strict: bool = False,
) -> tuple[DataFrame, Outcome]:
    """Parse, enrich, dedupe, gate, write.  A gate that fails stops the flow before it writes."""
    names = names or {"aneca": "aneca", "ruct": "ruct"}
    found = catalog.payload_arrays(document, list(names))
    parts = [catalog.payload_records(p, names[k], F.lit(scraped_at)) for k, p in found.items()]
    if not parts:
        return document.sparkSession.createDataFrame([], ", ".join(f"{c} string" for c in catalog.DEGREE_COLUMNS)), Outcome(False, {}, "no source")
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    rows = catalog.attach_registry(rows, registry).withColumn("__o", F.monotonically_increasing_id())
    rows = cut_lineage(catalog.description_fields(catalog.last_per_title(rows, F.col("__o")).drop("__o")))
    if strict:
        bad = catalog.blocked_records(rows, is_programme_title(F.col("title"), F.col("title_type")), is_programme_url(F.col("source_url")))
        if n := bad.count():
            return rows, Outcome(False, {"blocked": n}, "blocked records")
    for report, column, least in (
        (catalog.inventory_completeness(rows, registry), "pair_ratio", least_complete),
        (catalog.description_coverage(rows), "ratio", least_described),
    ):
        ok, message = catalog.gate(report, column, least)
        if not ok:
            return rows, Outcome(False, {}, message)
    if table is not None:
        table.write(rows)
    return rows, Outcome(True, {"rows": rows.count()})


def align_flow(
    jobs: DataFrame, degrees: DataFrame, cache: StateTable, pairs: StateTable, provider: str, model: str, as_of: str, least: int = 40
) -> Outcome:
    """Gate pairs, embed each distinct text once, score, merge, drop what is stale."""
    j = jobs.withColumn("__o", F.monotonically_increasing_id()).withColumn("job_key", job_key(F.col("__o")))
    d = degrees.withColumn("__o", F.monotonically_increasing_id()).withColumn("degree_key", degree_key(F.col("__o")))
    gated = cut_lineage(pairing.candidate_pairs(j, d, least))
    texts = vectors.distinct_texts(gated.select(F.explode(F.array("job_text", "degree_text")).alias("t")), "t")
    stored = cache.read()
    made, entries = vectors.embed_with_cache(texts, stored, provider, model, vectors.provider_named(provider))
    entries = cut_lineage(entries)
    cache.write(state.upsert_cache(stored, entries, F.lit(as_of)))
    known = stored.where((F.col("provider") == provider) & (F.col("model") == model)).select("text_hash", "vector")
    scored = vectors.pair_similarity(gated, known.unionByName(entries.select("text_hash", "vector")).dropDuplicates(["text_hash"]))
    fresh = scored.withColumns({"provider": F.lit(provider), "model": F.lit(model)}).withColumn("pair_key", pair_key())
    fresh = cut_lineage(fresh.drop("job_text", "degree_text"))
    old = pairs.read()
    merged, counts = state.upsert_pairs(fresh, old, F.lit(as_of))
    stale = state.stale_pairs(merged, fresh, provider, model).count()
    pairs.write(state.drop_stale_pairs(merged, fresh, provider, model))
    done = {r.action: r.n for r in counts.collect()}
    return Outcome(True, done | {"stale": stale, "embedded": entries.count()})


def embed_flow(corpus: DataFrame, cache: StateTable, provider: str, model: str, as_of: str, dry_run: bool = False) -> DataFrame:
    """The manifest of a corpus; unless it is a dry run the texts are embedded through the cache."""
    rows = corpus.withColumn("__o", F.monotonically_increasing_id())
    chunked = vectors.chunk_rows(rows, "__o", "text")
    texts = vectors.distinct_texts(chunked, "chunk")
    stored = cache.read()
    hits, misses = vectors.split_cache(texts, stored, provider, model)
    n_hits, n_misses = hits.count(), misses.count()
    if not dry_run:
        _, entries = vectors.embed_with_cache(texts, stored, provider, model, vectors.provider_named(provider))
        cache.write(state.upsert_cache(stored, cut_lineage(entries), F.lit(as_of)))
    return vectors.manifest(corpus, chunked, n_hits, n_misses)


@dataclass
class Stores:
    """The states of a complete run."""

    jobs: StateTable
    catalogue: StateTable
    cache: StateTable
    pairs: StateTable


def full_flow(
    records: DataFrame, document: DataFrame, registry: DataFrame, stores: Stores, provider: str, model: str, as_of: str,
    most: int = 10_000, per_source: int | None = None, least: int = 40, names: dict[str, str] | None = None,
) -> tuple[dict[str, Outcome], dict[str, DataFrame]]:
    """Catalogue, postings, alignment and the sector report, one after the other; a flow that fails
    ends the run, and the outcomes say where."""
    _, catalogue = catalogue_flow(document, registry, as_of, stores.catalogue, names=names)
    done = {"catalogue": catalogue}
    if not catalogue.ok:
        return done, {}
    degrees = stores.catalogue.read()
    wanted = limit_sources(records, per_source) if per_source else records
    done["jobs"] = jobs_flow(wanted, degrees, stores.jobs, as_of, most)
    done["align"] = align_flow(stores.jobs.read(), degrees, stores.cache, stores.pairs, provider, model, as_of, least)
    keyed_rows = degrees.withColumn("degree_key", degree_key(F.monotonically_increasing_id())).dropDuplicates(["degree_key"])
    return done, sector_report(stores.pairs.read(), keyed_rows, registry)


def sector_report(pairs: DataFrame, degrees: DataFrame, registry: DataFrame) -> dict[str, DataFrame]:
    """Summaries of scored pairs by the sector of the university."""
    keyed_degrees = catalog.attach_registry(degrees, registry)
    facts, lost = analytics.attach(pairs, keyed_degrees, "degree_key")
    facts = analytics.in_sectors(facts, "university_type")
    best = analytics.best_per_sector(facts, "job_key", "university_type", "score")
    return {
        "lost": lost, "summary": analytics.sector_summary(facts, "university_type", "score"),
        "intervals": analytics.bootstrap_mean(facts, "university_type", "score", "pair_key"),
        "metrics": analytics.key_metrics(best), "gaps": analytics.sector_gaps(best, "job_key"),
        "composition": analytics.composition(facts, F.coalesce("branch", F.lit("")), "university_type"),
    }
