"""Named queries of the core, each a function of (spark, sf_dir), and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.functions import keys, normalize, scores, text
from rowloom.functions.dates import in_window
from rowloom.operators import analytics, catalog, mapping, pairing, select, state, vectors
from rowloom.operators.quantities import normalise_pay
from rowloom.operators.timestamps import TARGET_FORM, normalise_timestamps
from rowloom.plans.registry import QUERIES, SQL, query
from rowloom.session import cut_lineage, table
from rowloom.sources import html
from rowloom.sources.tables import keyed_degrees
from rowloom.streaming import cycles

@query("p3_timestamps")
def p3_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every written timestamp with its UTC form, its status and the posterior of the reading."""
    sources = table(spark, sf_dir, "sources")
    parts = []
    for tbl, fields in (("jobs", ["publication_date", "update_date"]), ("degrees", ["scraped_at"])):
        rows = normalise_timestamps(table(spark, sf_dir, tbl), ["row_id"], fields, "source", sources)
        parts.append(rows.select(F.lit(tbl).alias("tbl"), "*"))
    return parts[0].unionByName(parts[1])


@query("p3_found")
def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = p3_timestamps(spark, sf_dir).where(~F.col("raw").rlike(TARGET_FORM))
    return rows.select("tbl", "row_id", "field", "utc_ts")


@query("p4_found")
def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs, units, sources = (table(spark, sf_dir, t) for t in ("jobs", "salary_units", "sources"))
    return normalise_pay(jobs, "row_id", units, sources)

# Pieces of SQL that several queries share.
SQL_ACCENT = "regexp_replace(strip_accents(lower({0})), '[^a-z0-9]+', ' ', 'g')"
SQL_SPACE = r"trim(regexp_replace({0}, '[ \t\n\x0B\f\r]+', ' ', 'g'))"
SQL_CLEAN = (
    "(CASE WHEN lower(trim({0})) IN ('nan', 'none', 'null', 'nat') THEN NULL ELSE "
    r"nullif(trim(regexp_replace(regexp_replace({0}, '<[^>]+>', ' ', 'g'), '[ \t\n\x0B\f\r]+', ' ', 'g')), '') END)"
)
SQL_STOP = "('grado','master','máster','en','de','la','el','los','las','y','del','un','una','programa','formacion','formación','general','tecnico','tecnicos','tecnica','tecnicas','apoyo','asistencia')"


def norm_sql(col: str) -> str:
    return f"trim({SQL_ACCENT.format(col)})"


# --- scalar functions over whole tables ---------------------------------------------------


@query(
    "clean_text",
    f"SELECT row_id, {SQL_CLEAN.format('title')} AS title, {SQL_CLEAN.format('company')} AS company, "
    f"{SQL_CLEAN.format('description')} AS description FROM jobs",
)
def q_clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs = table(spark, sf_dir, "jobs")
    return jobs.select("row_id", *[text.clean_text(F.col(c)).alias(c) for c in ("title", "company", "description")])


@query(
    "norm_tokens",
    f"""SELECT row_id, coalesce({norm_sql('title')}, '') AS title_norm,
        array_to_string(list_filter(string_split(coalesce({norm_sql('title')}, ''), ' '), lambda w: w <> '' AND w NOT IN {SQL_STOP}), '|') AS tokens
        FROM degrees""",
)
def q_norm_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    norm = F.coalesce(text.norm_words(F.col("title")), F.lit(""))
    rows = table(spark, sf_dir, "degrees").select("row_id", norm.alias("title_norm"))
    return rows.withColumn("tokens", F.array_join(text.tokens(F.col("title_norm")), "|"))


@query("text_fingerprint", f"SELECT doc_id, sha256({SQL_SPACE.format('text')}) AS text_hash FROM documents")
def q_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.text_hash(F.col("text")).alias("text_hash"))


@query(
    "chunk_text",
    f"""WITH t AS (SELECT doc_id, {SQL_SPACE.format('text')} AS t FROM documents)
        SELECT doc_id, CAST(p // 3000 AS INTEGER) AS chunk_no, substr(t, CAST(p AS BIGINT) + 1, 3000) AS chunk
        FROM t, unnest(range(0, length(t), 3000)) AS u(p)""",
)
def q_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.chunk_rows(table(spark, sf_dir, "documents"), "doc_id", "text")


@query(
    "estimate_tokens",
    "SELECT source, CAST(sum(greatest(1, length(text) // 4)) AS BIGINT) AS tokens, count(*) AS n FROM documents GROUP BY source",
)
def q_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").groupBy("source")
    return rows.agg(F.sum(text.estimated_tokens(F.col("text"))).alias("tokens"), F.count("*").alias("n"))


_CONTRACT_EXACT = " ".join(
    f"WHEN c IN ({', '.join(repr(n) for n in names)}) THEN '{kind}'" for kind, names in normalize.CONTRACTS.items()
)
_CONTRACT_PART = " ".join(f"WHEN regexp_matches(c, '{p}') THEN '{kind}'" for kind, p in normalize.CONTRACT_PARTS.items())


@query(
    "contract_type",
    f"""WITH t AS (SELECT row_id, coalesce(lower({SQL_CLEAN.format('contract_type_raw')}), '') AS c FROM jobs)
        SELECT row_id, CASE WHEN c = '' THEN NULL {_CONTRACT_EXACT} {_CONTRACT_PART} ELSE 'other' END AS contract_type,
        CASE WHEN c = '' THEN 'missing' WHEN (CASE {_CONTRACT_EXACT} END) IS NOT NULL THEN 'exact'
             WHEN (CASE {_CONTRACT_PART} END) IS NOT NULL THEN 'alias' ELSE 'unresolved' END AS confidence FROM t""",
)
def q_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "jobs").select("row_id", normalize.contract(F.col("contract_type_raw")).alias("c"))
    return rows.select("row_id", "c.*")


def _case(pairs: dict[str, str], col: str, rest: str) -> str:
    inner = " ".join(f"WHEN {k!r} THEN {v!r}" for k, v in pairs.items())
    return f"CASE {col} {inner} ELSE {rest} END"


_ISLAND = _case({k.lower(): k for k in normalize.ISLANDS}, "lower(i)", "i")
_OF_ISLAND = _case({k.upper(): v for k, v in normalize.ISLANDS.items()}, f"upper({_ISLAND})", "p")
_PROVINCE = _case({v.lower(): v for v in normalize.ISLANDS.values()}, "lower(p)", "p")
_TOWNS = ", ".join(repr(k) for k in normalize.MUNICIPALITIES)


def _town(col: str, k: int) -> str:
    return _case({n: v[k] for n, v in normalize.MUNICIPALITIES.items()}, f"lower({col})", "NULL")


@query(
    "geo_ladder",
    f"""WITH t AS (SELECT row_id, {SQL_CLEAN.format('province_raw')} AS p, {SQL_CLEAN.format('municipality_raw')} AS m,
                   {SQL_CLEAN.format('island_raw')} AS i, {SQL_CLEAN.format('raw_location')} AS r FROM jobs)
        SELECT row_id,
          CASE WHEN lower(m) IN ({_TOWNS}) THEN {_town('m', 2)} WHEN i IS NOT NULL THEN {_OF_ISLAND} WHEN p IS NOT NULL THEN {_PROVINCE}
               WHEN lower(r) IN ({_TOWNS}) THEN {_town('r', 2)} ELSE p END AS province,
          CASE WHEN lower(m) IN ({_TOWNS}) THEN {_town('m', 0)} WHEN i IS NOT NULL OR p IS NOT NULL THEN m
               WHEN lower(r) IN ({_TOWNS}) THEN {_town('r', 0)} ELSE m END AS municipality,
          CASE WHEN lower(m) IN ({_TOWNS}) THEN {_town('m', 1)} WHEN i IS NOT NULL THEN {_ISLAND} WHEN p IS NOT NULL THEN i
               WHEN lower(r) IN ({_TOWNS}) THEN {_town('r', 1)} ELSE i END AS island,
          CASE WHEN lower(m) IN ({_TOWNS}) THEN 'municipality_index' WHEN i IS NOT NULL THEN 'island' WHEN p IS NOT NULL THEN 'province'
               WHEN lower(r) IN ({_TOWNS}) THEN 'raw_location_index' WHEN r IS NOT NULL THEN 'unresolved' ELSE 'missing' END AS confidence FROM t""",
)
def q_geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = [F.col(c) for c in ("province_raw", "municipality_raw", "island_raw", "raw_location")]
    rows = table(spark, sf_dir, "jobs").select("row_id", F.explode(F.array(normalize.place(*raw))).alias("g"))
    return rows.select("row_id", "g.province", "g.municipality", "g.island", "g.confidence")


def _some(c: str) -> str:
    return f"nullif(trim({c}), '')"


@query(
    "identity_keys",
    f"""SELECT row_id,
        coalesce('url::' || lower({_some('source_url')}),
                 CASE WHEN coalesce({_some('source')}, '') <> '' THEN 'id::' || lower({_some('source')}) || '::' || {_some('external_id')} END,
                 CASE WHEN coalesce({_some('title')}, '') <> '' OR coalesce({_some('company')}, '') <> '' THEN
                   concat_ws('::', 'row', lower(coalesce({_some('source')}, '')), lower(coalesce({_some('title')}, '')), lower(coalesce({_some('company')}, '')),
                   lower(coalesce({_some('publication_date')}, '')), lower(coalesce({_some('raw_location')}, nullif(concat_ws(' / ', {_some('municipality')}, {_some('island')}, {_some('province')}), ''), ''))) END
        ) AS storage_key,
        CASE WHEN {_some('source')} IS NOT NULL AND {_some('title')} IS NOT NULL AND {_some('company')} IS NOT NULL AND {_some('publication_date')} IS NOT NULL THEN
          lower(concat_ws('::', 'sec', {_some('source')}, {_some('title')}, {_some('company')}, {_some('publication_date')},
          coalesce({_some('raw_location')}, nullif(concat_ws(' / ', {_some('municipality')}, {_some('island')}, {_some('province')}), ''), ''))) END AS second_key,
        CASE WHEN {_some('external_id')} IS NOT NULL THEN 'job::' || lower(coalesce({_some('source')}, 'unknown')) || '::' || {_some('external_id')}
             WHEN {_some('source_url')} IS NOT NULL THEN 'job_url::' || {_some('source_url')}
             ELSE 'job_row::' || lower(coalesce({_some('source')}, 'unknown')) || '::' || row_id END AS align_key FROM jobs""",
)
def q_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "jobs").select(
        "row_id", keys.storage_key().alias("storage_key"), keys.secondary_key().alias("second_key"), keys.job_key(F.col("row_id")).alias("align_key")
    )


@query("payload_hash", "SELECT row_id, payload_hash AS content_hash FROM jobs")
def q_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rowloom.sources.records import JOB_COLUMNS

    return table(spark, sf_dir, "jobs").select("row_id", keys.payload_hash(JOB_COLUMNS).alias("content_hash"))


@query(
    "json_props",
    "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
)
def q_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k bigint").k.alias("k"))


# --- choosing rows ---------------------------------------------------------------------------


@query(
    "dedupe_first",
    "SELECT row_id, source_url FROM jobs QUALIFY row_number() OVER (PARTITION BY coalesce(source_url, '') ORDER BY row_id) = 1",
)
def q_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "jobs").select("row_id", "source_url")
    return select.first_per_key(rows, F.coalesce("source_url", F.lit("")), [F.col("row_id")])


@query(
    "dedupe_last",
    """SELECT row_id, university, title, title_type FROM degrees QUALIFY row_number() OVER
       (PARTITION BY lower(coalesce(university, '')), lower(coalesce(title, '')), lower(coalesce(title_type, '')) ORDER BY row_id DESC) = 1""",
)
def q_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "degrees").select("row_id", "university", "title", "title_type")
    return catalog.last_per_title(rows, F.col("row_id"))


_NEWEST = "coalesce(update_date,'') DESC, coalesce(publication_date,'') DESC, coalesce(updated_at,'') DESC, coalesce(payload_hash,'') DESC, row_id DESC"


@query(
    "latest_two_pass",
    f"""WITH one AS (SELECT * FROM jobs QUALIFY row_number() OVER (PARTITION BY job_key ORDER BY {_NEWEST}) = 1)
        SELECT row_id, job_key, secondary_key FROM one
        QUALIFY row_number() OVER (PARTITION BY coalesce(secondary_key, chr(31) || job_key) ORDER BY {_NEWEST}) = 1""",
)
def q_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = ["row_id", "job_key", "secondary_key", "update_date", "publication_date", "updated_at", "payload_hash"]
    rows = table(spark, sf_dir, "jobs").select(*cols)
    order = [F.coalesce(c, F.lit("")) for c in cols[3:]]
    newest = select.latest_two_pass(rows, F.col("job_key"), F.col("secondary_key"), order, F.col("row_id"))
    return newest.select("row_id", "job_key", "secondary_key")


@query(
    "newest_ties",
    """WITH b AS (SELECT job_key AS key, last_seen_at, count(*) AS n FROM jobs WHERE job_key IS NOT NULL GROUP BY ALL)
       SELECT key, n - 1 AS ties FROM b QUALIFY row_number() OVER (PARTITION BY key ORDER BY last_seen_at DESC NULLS LAST) = 1""",
)
def q_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.tied_rows(table(spark, sf_dir, "jobs"), F.col("job_key"), [F.col("last_seen_at")])


@query(
    "source_coverage_select",
    """WITH u AS (SELECT row_id, source, source_url, coalesce(publication_date, '') AS d FROM jobs
                  QUALIFY row_number() OVER (PARTITION BY coalesce(source_url, chr(31) || row_id) ORDER BY coalesce(publication_date, '') DESC, source DESC, row_id) = 1),
            s AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY d DESC, source DESC, row_id) AS rn FROM u)
       SELECT row_id, source, source_url FROM s
       ORDER BY CASE WHEN rn = 1 THEN 0 ELSE 1 END, CASE WHEN rn = 1 THEN source END NULLS FIRST, d DESC, source DESC, row_id LIMIT 100""",
)
def q_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "jobs").select("row_id", "source", "source_url", "publication_date")
    order = [F.coalesce("publication_date", F.lit("")).desc(), F.col("source").desc(), F.col("row_id")]
    return select.cover_sources(rows, "source", "source_url", order, 100).drop("publication_date")


@query(
    "quota_split",
    """WITH q(source, n) AS (VALUES ('jobspy_indeed', 820), ('sce', 130), ('turijobs', 50))
       SELECT row_id, jobs.source FROM jobs JOIN q ON jobs.source = q.source
       QUALIFY row_number() OVER (PARTITION BY jobs.source ORDER BY coalesce(publication_date, '') DESC, row_id) <= any_value(q.n) OVER (PARTITION BY jobs.source)""",
)
def q_quota(spark: SparkSession, sf_dir: str) -> DataFrame:
    quota = select.quotas({"jobspy_indeed": 0.82, "sce": 0.13, "turijobs": 0.05}, 1000, "turijobs")
    rows = table(spark, sf_dir, "jobs").select("row_id", "source", "publication_date")
    order = [F.coalesce("publication_date", F.lit("")).desc(), F.col("row_id")]
    return select.take_quotas(rows, "source", quota, order).select("row_id", "source")


@query(
    "topk_relative_cut",
    """WITH b AS (SELECT job_key, degree_key, max(score) AS score FROM program_job_similarity WHERE score IS NOT NULL AND NOT isnan(score) GROUP BY ALL),
            r AS (SELECT *, row_number() OVER w AS rn, max(score) OVER (PARTITION BY job_key) AS best FROM b WHERE score >= 0.28
                  WINDOW w AS (PARTITION BY job_key ORDER BY score DESC, degree_key))
       SELECT job_key, degree_key, score FROM r WHERE rn <= 5 AND score >= best - 0.10""",
)
def q_relative(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = table(spark, sf_dir, "program_job_similarity").where("score is not null and not isnan(score)")
    best = pairs.groupBy("job_key", "degree_key").agg(F.max("score").alias("score"))
    return select.relative_top(best, "job_key", "score", "degree_key")


# --- mapping and pairing ---------------------------------------------------------------------


def _distinct_titles(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    jobs = table(spark, sf_dir, "jobs").select(text.norm_words(F.col("title")).alias("job_title")).where("job_title <> ''").distinct()
    degrees = table(spark, sf_dir, "degrees").select(text.norm_words(F.col("title")).alias("degree_title")).where("degree_title <> ''").distinct()
    return jobs, degrees


@query(
    "token_overlap_score",
    f"""WITH j AS (SELECT DISTINCT {norm_sql('title')} AS job_title FROM jobs WHERE {norm_sql('title')} <> ''),
             d AS (SELECT DISTINCT {norm_sql('title')} AS degree_title FROM degrees WHERE {norm_sql('title')} <> ''),
             jk AS (SELECT DISTINCT job_title, substr(w, 1, 5) AS k FROM j, unnest(string_split(job_title, ' ')) AS u(w) WHERE w <> '' AND w NOT IN {SQL_STOP}),
             dt AS (SELECT degree_title, substr(w, 1, 5) AS k FROM d, unnest(string_split(degree_title, ' ')) AS u(w) WHERE w <> '' AND w NOT IN {SQL_STOP}),
             n AS (SELECT degree_title, count(*) AS n FROM dt GROUP BY ALL)
        SELECT job_title, degree_title, round(count(*) / any_value(n.n), 9) AS score FROM jk JOIN dt USING (k) JOIN n USING (degree_title)
        GROUP BY job_title, degree_title""",
)
def q_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs, degrees = _distinct_titles(spark, sf_dir)
    scored = mapping.overlap_scores(
        jobs.withColumn("t", F.col("job_title")), degrees.withColumn("u", F.col("degree_title")), "job_title", "t", "degree_title", "u"
    )
    return scored.withColumn("score", F.round("score", 9))


@query(
    "rule_match",
    f"""WITH t AS (SELECT row_id, coalesce({norm_sql('title')}, '') AS t, coalesce({norm_sql("concat_ws(' ', title, description)")}, '') AS a FROM jobs)
        SELECT row_id, rule FROM t, (VALUES {', '.join("('" + r[0] + "')" for r in mapping.RULES)}) AS r(rule) WHERE CASE rule
        {' '.join(f"WHEN '{n}' THEN (" + ' OR '.join(f"contains({'t' if s == 'title' else 'a'}, '{k}')" for k in kw) + ')' + (" AND NOT (" + ' OR '.join(f"contains(t, '{x}')" for x in mapping.TEACHING) + ')' if n in mapping.NOT_FOR_TEACHING else '') for n, s, kw, _, _ in mapping.RULES)}
        END""",
)
def q_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs = table(spark, sf_dir, "jobs")
    rows = jobs.select(
        "row_id", F.coalesce(text.norm_words(F.col("title")), F.lit("")).alias("t"),
        text.norm_words(F.concat_ws(" ", "title", "description")).alias("a"),
    )
    teaching = text.mentions(F.col("t"), mapping.TEACHING)
    hits = []
    for name, scope, words, _, _ in mapping.RULES:
        hit = text.mentions(F.col("t" if scope == "title" else "a"), words)
        hits.append(F.when(hit & ~teaching if name in mapping.NOT_FOR_TEACHING else hit, F.lit(name)))
    return rows.select("row_id", F.explode(F.filter(F.array(*hits), lambda h: h.isNotNull())).alias("rule"))


def _mentions_sql(col: str, words: list[str]) -> str:
    return f"({col} <> '' AND (" + " OR ".join(f"contains({col}, '{w}')" for w in words) + "))"


def _rule_sql(name: str, scope: str, words: list[str]) -> str:
    teaching = f" AND NOT {_mentions_sql('t', mapping.TEACHING)}" if name in mapping.NOT_FOR_TEACHING else ""
    return f"WHEN '{name}' THEN {_mentions_sql('t' if scope == 'title' else 'a', words)}{teaching}"


def _values_sql(k: int) -> str:
    return ", ".join(f"('{r[0]}', {norm_sql(repr(x))})" for r in mapping.RULES for x in r[k])


def _shares_sql(name: str, jobs: str, catalogue: str) -> str:
    """CTEs for the share of a catalogue text's tokens that match a token of a posting's text."""
    words = f"unnest(string_split({{0}}, ' ')) AS u(w) WHERE w <> '' AND w NOT IN {SQL_STOP}"
    return f"""{name}_j AS (SELECT DISTINCT text_id, substr(w, 1, 5) AS k FROM j, {words.format(jobs)}),
        {name}_c AS (SELECT title_norm, substr(w, 1, 5) AS k FROM c, {words.format(catalogue)}),
        {name}_n AS (SELECT title_norm, count(*) AS n FROM {name}_c GROUP BY ALL),
        {name} AS (SELECT text_id, title_norm, sum(times) / any_value(n) AS s FROM {name}_j
                   JOIN (SELECT title_norm, k, count(*) AS times FROM {name}_c GROUP BY ALL) USING (k) JOIN {name}_n USING (title_norm) GROUP BY ALL)"""


_MAPPING_SQL = f"""
    WITH g AS (SELECT sha256(concat_ws(chr(31), coalesce(title, ''), coalesce(description, ''))) AS text_id, min(title) AS title,
                      min(description) AS description, count(*) AS n_rows FROM jobs GROUP BY 1),
    j AS (SELECT text_id, n_rows, {norm_sql("coalesce(title, '')")} AS t, {norm_sql("concat_ws(' ', title, description)")} AS a FROM g),
    hit AS (SELECT text_id, rule FROM j, (VALUES {", ".join(f"('{r[0]}')" for r in mapping.RULES)}) AS r(rule)
            WHERE CASE rule {" ".join(_rule_sql(n, s, kw) for n, s, kw, _, _ in mapping.RULES)} END),
    hint AS (SELECT DISTINCT text_id, title_norm FROM hit JOIN (VALUES {_values_sql(4)}) AS v(rule, title_norm) USING (rule)),
    hint_branch AS (SELECT DISTINCT text_id, branch_norm FROM hit JOIN (VALUES {_values_sql(3)}) AS v(rule, branch_norm) USING (rule)),
    electric AS (SELECT text_id FROM (SELECT text_id, concat_ws(' ', t, a) AS ta FROM j) WHERE {_mentions_sql("ta", mapping.ELECTRIC)}),
    c0 AS (SELECT row_id, {SQL_CLEAN.format("title")} AS title, {SQL_CLEAN.format("branch")} AS branch, {norm_sql(SQL_CLEAN.format("description"))} AS dn FROM degrees),
    c1 AS (SELECT row_id, title, dn, {norm_sql("title")} AS tn, branch FROM c0 WHERE title IS NOT NULL),
    c2 AS (SELECT row_id, title, dn, tn, coalesce(branch, CASE {" ".join(f"WHEN {_mentions_sql('tn', w)} THEN '{b}'" for b, w in mapping.BRANCH_WORDS.items())} END) AS branch FROM c1),
    c AS (SELECT tn AS title_norm, arg_min(title, row_id) AS title, arg_min(branch, row_id) FILTER (WHERE branch IS NOT NULL) AS branch,
                 arg_min(dn, row_id) FILTER (WHERE dn IS NOT NULL) AS description_norm FROM c2 GROUP BY tn),
    {_shares_sql("ts", "t", "title_norm")}, {_shares_sql("ds", "a", "description_norm")},
    p AS (SELECT text_id, title_norm, ts.s AS t, ds.s AS d FROM ts FULL JOIN ds USING (text_id, title_norm)),
    q AS (SELECT text_id, title_norm, coalesce(t, 0.0::DOUBLE) AS t, coalesce(d, 0.0::DOUBLE) AS d, hint.title_norm IS NOT NULL AS h FROM p FULL JOIN hint USING (text_id, title_norm)),
    f AS (SELECT q.text_id, c.title, c.branch, q.t, q.d, q.h, b.text_id IS NOT NULL AS hb, e.text_id IS NOT NULL AS el,
                 coalesce({norm_sql("c.branch")}, '') <> '' AS has_b, coalesce({norm_sql("c.branch")} = '{mapping.TECHNICAL}', false) AS tech
          FROM q JOIN c USING (title_norm) LEFT JOIN hint_branch b ON b.text_id = q.text_id AND b.branch_norm = {norm_sql("c.branch")} LEFT JOIN electric e ON e.text_id = q.text_id),
    s AS (SELECT text_id, title, branch, el AND has_b AND NOT tech AS other,
                 greatest(0.0::DOUBLE, least(1.0::DOUBLE, 0.7::DOUBLE * t + 0.3::DOUBLE * d
                 + (CASE WHEN h THEN 0.15::DOUBLE ELSE 0.0 END + CASE WHEN has_b AND hb THEN 0.10::DOUBLE ELSE 0.0 END + CASE WHEN el AND tech THEN 0.15::DOUBLE ELSE 0.0 END)
                 - CASE WHEN el AND has_b AND NOT tech THEN 0.30::DOUBLE ELSE 0.0 END)) AS score FROM f),
    r AS (SELECT *, row_number() OVER (PARTITION BY text_id ORDER BY score DESC, title) AS rn, max(score) OVER (PARTITION BY text_id) AS best
          FROM s WHERE score >= 0.28::DOUBLE AND NOT (other AND score < 0.65::DOUBLE)),
    k AS (SELECT * FROM r WHERE rn <= 5 AND score >= best - 0.1::DOUBLE),
    titles AS (SELECT text_id, string_agg(title, '|' ORDER BY rn) AS target_degree_titles, round(max(score), 9) AS best_score, count(*) AS n_kept FROM k GROUP BY text_id),
    branches AS (SELECT text_id, nullif(string_agg(branch, '|' ORDER BY rn), '') AS target_degree_branches
                 FROM (SELECT text_id, branch, min(rn) AS rn FROM k WHERE branch IS NOT NULL GROUP BY ALL) GROUP BY text_id)
    SELECT text_id, target_degree_titles, best_score, coalesce(n_kept, 0) AS n_kept, target_degree_branches,
           CASE WHEN target_degree_titles IS NULL THEN 'no_match' ELSE 'matched' END AS degree_match_status, n_rows
    FROM j LEFT JOIN titles USING (text_id) LEFT JOIN branches USING (text_id)"""


@query("job_degree_mapping", _MAPPING_SQL)
def q_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per distinct posting text the selected degrees."""
    jobs = table(spark, sf_dir, "jobs").select("title", "description")
    # Repeated postings have one text; it is scored once and joined back by its hash.
    rows = jobs.withColumn("text_id", F.sha2(F.concat_ws("\u001f", F.coalesce("title", F.lit("")), F.coalesce("description", F.lit(""))), 256))
    rows = cut_lineage(rows.groupBy("text_id").agg(F.min("title").alias("title"), F.min("description").alias("description"), F.count("*").alias("n_rows")))
    degrees = table(spark, sf_dir, "degrees").select("row_id", "title", "branch", "description")
    found = mapping.map_degrees(rows, degrees, "text_id", "row_id").withColumn("best_score", F.round("best_score", 9))
    return found.join(rows.select("text_id", "n_rows"), "text_id")


def _class_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Postings and degrees that pass the gates of pairing, row by row, with the key of their class:
    postings with the same targets, degrees with the same title and branch.  Null counts as empty."""
    target = ["target_degree_titles", "target_degree_branches", "degree_match_status"]
    out = []
    for tbl, key, of in (("jobs", "job_key", target), ("degrees", "degree_key", ["title", "branch"])):
        rows = table(spark, sf_dir, tbl).withColumn("text", pairing.gate_text()).where(F.length("text") >= 40)
        rows = rows.where("degree_match_status = 'matched'") if tbl == "jobs" else rows
        rows = rows.select("row_id", "text", *[F.coalesce(c, F.lit("")).alias(c) for c in of])
        out.append(rows.withColumn(key, F.sha2(F.concat_ws("\u001f", *of), 256)))
    return out[0], out[1]


_ASCII = "trim(regexp_replace(lower(regexp_replace(strip_accents(coalesce({0}, '')), '[^\\x00-\\x7F]+', '', 'g')), '[^a-z0-9]+', ' ', 'g'))"
_NAME_END = f"trim(regexp_replace(regexp_replace({{0}}, '(?:{pairing.TAIL}).*$', ''), ' +', ' ', 'g'))"


def _families_sql(col: str) -> str:
    norm = _ASCII.format(col)
    single = _NAME_END.format(f"regexp_extract({norm}, '\\bgrado en ([a-z0-9 ]+)', 1)")
    double = _NAME_END.format(f"regexp_extract({norm}, '\\bdoble grado en ([a-z0-9 ]+)', 1)")
    parts = f"list_transform(string_split_regex({double}, '\\by\\b'), lambda p: trim(p))"
    return f"list_distinct(list_filter(list_concat([{single}], {parts}), lambda k: k <> ''))"


def _list_sql(col: str) -> str:
    return f"list_distinct(list_filter(list_transform(string_split({col}, '|'), lambda x: trim(x)), lambda x: x <> ''))"


_GATE = "length(trim(coalesce(nullif(description, ''), title, ''))) >= 40"
_CLASSES_SQL = f"""jr AS (SELECT row_id, coalesce(target_degree_titles, '') AS tt, coalesce(target_degree_branches, '') AS tb FROM jobs WHERE degree_match_status = 'matched' AND {_GATE}),
    dr AS (SELECT row_id, coalesce(title, '') AS title, coalesce(branch, '') AS branch FROM degrees WHERE {_GATE}),
    jm AS (SELECT row_id, sha256(concat_ws(chr(31), tt, tb, 'matched')) AS job_key, tt, tb FROM jr),
    dm AS (SELECT row_id, sha256(concat_ws(chr(31), title, branch)) AS degree_key, title, branch FROM dr)"""


@query(
    "candidate_pair_classes",
    f"""WITH {_CLASSES_SQL}, jc AS (SELECT job_key, tt, tb, count(*) AS n_jobs FROM jm GROUP BY ALL),
        dc AS (SELECT degree_key, title, branch, {_families_sql("title")} AS families, count(*) AS n_degrees FROM dm GROUP BY ALL),
        w AS (SELECT job_key, unnest({_list_sql("tt")}) AS target FROM jc),
        wf AS (SELECT DISTINCT job_key, unnest({_families_sql("target")}) AS family FROM w),
        df AS (SELECT degree_key, unnest(families) AS family FROM dc),
        fam AS (SELECT job_key, list(family) AS wanted FROM wf GROUP BY job_key),
        br AS (SELECT job_key, unnest({_list_sql("tb")}) AS branch FROM jc),
        p AS (SELECT job_key, degree_key FROM w JOIN dc ON w.target = dc.title
              UNION SELECT job_key, degree_key FROM wf JOIN df USING (family)
              UNION SELECT br.job_key, degree_key FROM br JOIN dc USING (branch) LEFT JOIN fam ON fam.job_key = br.job_key
                    WHERE fam.wanted IS NULL OR list_has_any(fam.wanted, dc.families))
        SELECT job_key, degree_key, n_jobs, n_degrees FROM p JOIN jc USING (job_key) JOIN dc USING (degree_key)""",
)
def q_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate pairs between classes, with the number of members on both sides; the members are
    the rows of ``candidate_pair_members``, and every member of one side pairs with every one of the other."""
    jobs, degrees = _class_rows(spark, sf_dir)
    target = ["job_key", "target_degree_titles", "target_degree_branches", "degree_match_status"]
    job_class = jobs.groupBy(*target).agg(F.max("text").alias("description"), F.count("*").alias("n_jobs"))
    job_class = job_class.withColumn("title", F.lit(None).cast("string"))
    degrees = degrees.groupBy("degree_key", "title", "branch").agg(F.max("text").alias("description"), F.count("*").alias("n_degrees"))
    pairs = pairing.candidate_pairs(job_class, degrees).select("job_key", "degree_key")
    return pairs.join(job_class.select("job_key", "n_jobs"), "job_key").join(degrees.select("degree_key", "n_degrees"), "degree_key")


@query(
    "candidate_pair_members",
    f"""WITH {_CLASSES_SQL} SELECT 'jobs' AS tbl, row_id, job_key AS class_key FROM jm UNION ALL SELECT 'degrees', row_id, degree_key FROM dm""",
)
def q_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of each row that takes part in ``candidate_pair_classes``."""
    jobs, degrees = _class_rows(spark, sf_dir)
    members = jobs.select(F.lit("jobs").alias("tbl"), "row_id", F.col("job_key").alias("class_key"))
    return members.unionByName(degrees.select(F.lit("degrees").alias("tbl"), "row_id", F.col("degree_key").alias("class_key")))


@query(
    "matched_gate",
    """SELECT degree_match_status, count(*) AS n, count(*) FILTER (WHERE length(trim(coalesce(nullif(description, ''), title, ''))) >= 40) AS n_long
       FROM jobs GROUP BY ALL""",
)
def q_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "jobs").groupBy("degree_match_status")
    return rows.agg(F.count("*").alias("n"), F.count_if(F.length(pairing.gate_text()) >= 40).alias("n_long"))


@query(
    "pipe_values",
    """SELECT row_id, trim(v) AS value FROM (SELECT DISTINCT row_id, unnest(list_transform(string_split(target_degree_titles, '|'), lambda x: trim(x))) AS v FROM jobs) WHERE v <> ''""",
)
def q_pipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "jobs").select("row_id", F.explode(text.pipe_values(F.col("target_degree_titles"))).alias("value"))


# --- vectors -----------------------------------------------------------------------------------


@query(
    "cosine_pairs",
    """SELECT q.vec_id AS query_id, v.vec_id, round(list_cosine_similarity(q.embedding::DOUBLE[], v.embedding::DOUBLE[]), 6) AS score
       FROM embeddings q, embeddings v WHERE q.vec_id % 50 = 0 AND q.vec_id <> v.vec_id""",
)
def q_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector whose id is divisible by 50, in blocks, against all vectors."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", scores.norm(F.col("embedding")).alias("size"))
    asked = rows.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("q"), F.col("size").alias("qs"))
    blocks = max(1, -(-asked.count() // 2000))
    out = None
    for k in range(blocks):
        part = asked.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == k)
        met = rows.join(F.broadcast(part), F.col("query_id") != F.col("vec_id"))
        met = met.select("query_id", "vec_id", F.round(scores.cosine(F.col("q"), F.col("embedding"), F.col("qs"), F.col("size")), 6).alias("score"))
        out = met if out is None else out.unionByName(met)
    return out


@query(
    "cache_split",
    f"""WITH t AS (SELECT sha256({SQL_SPACE.format('text')}) AS h, source, collected_at FROM documents WHERE length(trim(text)) > 0),
             c AS (SELECT DISTINCT sha256('hashing:demo:' || h) AS k FROM t WHERE collected_at < TIMESTAMP '2024-02-01'),
             d AS (SELECT DISTINCT h FROM t)
        SELECT CASE WHEN k IS NULL THEN 'miss' ELSE 'hit' END AS kind, count(*) AS n FROM d LEFT JOIN c ON c.k = sha256('hashing:demo:' || d.h) GROUP BY ALL""",
)
def q_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts against a cache that was filled before February 2024."""
    docs = table(spark, sf_dir, "documents")
    texts = vectors.distinct_texts(docs, "text")
    old = vectors.distinct_texts(docs.where(F.col("collected_at") < F.lit("2024-02-01").cast("timestamp_ntz")), "text")
    stored = old.select(text.cache_key(F.lit("hashing"), F.lit("demo"), F.col("text_hash")).alias("cache_key"), F.array(F.lit(0.0)).alias("vector"))
    hits, misses = vectors.split_cache(texts, stored, "hashing", "demo")
    kinds = hits.select(F.lit("hit").alias("kind")).unionByName(misses.select(F.lit("miss").alias("kind")))
    return kinds.groupBy("kind").agg(F.count("*").alias("n"))


# --- catalogue -----------------------------------------------------------------------------------

_MATCH = r"trim(regexp_replace(strip_accents(lower({0})), '[ \t\n\x0B\f\r]+', ' ', 'g'))"
_REGISTRY_SQL = f"""al AS (SELECT alias, university_id AS uid, canonical_name, university_type AS utype FROM
        (SELECT {_MATCH.format('name')} AS alias, university_id, canonical_name, university_type FROM
          (SELECT *, unnest(list_concat([canonical_name], string_split(coalesce(aliases, ''), '|'))) AS name FROM universities)) WHERE alias <> ''
        QUALIFY row_number() OVER (PARTITION BY alias ORDER BY university_id) = 1),
    dg AS (SELECT d.* REPLACE (coalesce(canonical_name, university) AS university, coalesce(uid, university_id) AS university_id, coalesce(utype, university_type) AS university_type)
           FROM degrees d LEFT JOIN al ON al.alias = {_MATCH.format("coalesce(d.university, '')")})"""


@query("registry_attach", f"WITH {_REGISTRY_SQL} SELECT row_id, university, university_id, university_type FROM dg")
def q_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    degrees = table(spark, sf_dir, "degrees").select("row_id", "university", "university_id", "university_type")
    return catalog.attach_registry(degrees, table(spark, sf_dir, "universities"))


@query(
    "completeness_grid",
    f"""WITH {_REGISTRY_SQL}, g AS (SELECT u.university_id, t.title_type FROM (SELECT DISTINCT university_id FROM universities) u, (VALUES ('grado'), ('master'), ('doctorado')) AS t(title_type))
        SELECT g.university_id, g.title_type, count(dg.row_id) AS n FROM g LEFT JOIN dg ON dg.university_id = g.university_id AND dg.title_type = g.title_type GROUP BY ALL""",
)
def q_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    registry = table(spark, sf_dir, "universities")
    degrees = catalog.attach_registry(table(spark, sf_dir, "degrees").select("row_id", "university", "university_id", "university_type", "title_type"), registry)
    return catalog.inventory_grid(degrees, registry)


@query(
    "completeness",
    f"""WITH {_REGISTRY_SQL}, g AS (SELECT u.university_id, t.title_type FROM (SELECT DISTINCT university_id FROM universities) u, (VALUES ('grado'), ('master'), ('doctorado')) AS t(title_type)),
          n AS (SELECT g.university_id, g.title_type, count(dg.row_id) AS n FROM g LEFT JOIN dg ON dg.university_id = g.university_id AND dg.title_type = g.title_type GROUP BY ALL)
        SELECT (SELECT round(avg(CASE WHEN s > 0 THEN 1.0 ELSE 0 END), 9) FROM (SELECT sum(n) AS s FROM n GROUP BY university_id)) AS university_ratio,
               (SELECT round(avg(CASE WHEN s > 0 THEN 1.0 ELSE 0 END), 9) FROM (SELECT sum(n) AS s FROM n GROUP BY title_type)) AS type_ratio,
               round(avg(CASE WHEN n > 0 THEN 1.0 ELSE 0 END), 9) AS pair_ratio, count(*) FILTER (WHERE n = 0) AS n_missing_pairs FROM n""",
)
def q_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    registry = table(spark, sf_dir, "universities")
    degrees = catalog.attach_registry(table(spark, sf_dir, "degrees").select("row_id", "university", "university_id", "university_type", "title_type"), registry)
    report = catalog.inventory_completeness(degrees, registry)
    return report.select(
        F.round("university_ratio", 9).alias("university_ratio"), F.round("type_ratio", 9).alias("type_ratio"),
        F.round("pair_ratio", 9).alias("pair_ratio"), F.size("missing_pairs").cast("bigint").alias("n_missing_pairs"),
    )


@query(
    "description_coverage",
    """SELECT count(*) AS total, count(*) FILTER (WHERE length(trim(coalesce(description, ''))) > 0) AS described,
       round(count(*) FILTER (WHERE length(trim(coalesce(description, ''))) > 0) / count(*), 9) AS ratio FROM degrees""",
)
def q_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = catalog.description_coverage(table(spark, sf_dir, "degrees"))
    return report.select("total", "described", F.round("ratio", 9).alias("ratio"))


_PATH = "regexp_extract(source_url, '^(?:[A-Za-z][A-Za-z0-9_+.-]*:)?(?://[^/?#]*)?([^?#]*)', 1)"


def _told_type(norm: str) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({norm}, '{'|'.join(w)}') THEN '{k}'" for k, w in html.TYPE_WORDS.items()) + " END"


@query(
    "quality_gate",
    f"""WITH x AS (SELECT row_id, title, source_url, university_id, coalesce({_MATCH.format('title')}, '') AS n, title_type,
            lower(regexp_replace({_PATH}, '/+$', '')) AS path FROM degrees),
        y AS (SELECT *, coalesce(title_type, {_told_type('n')}) AS kind FROM x),
        z AS (SELECT *, length(n) >= 8 AND n NOT IN ({", ".join(repr(t) for t in html.GENERAL_TITLES)})
                AND NOT ({" OR ".join(f"contains(n, {repr(w) if chr(39) not in w else chr(39) + w.replace(chr(39), chr(39) * 2) + chr(39)})" for w in html.NOT_TITLES)})
                AND coalesce({" OR ".join(f"(kind = '{k}' AND regexp_matches(title, '{f}', 'i'))" for k, f in html.TYPE_FORMS.items())}, false) AS good_title,
                NOT regexp_matches(source_url, '^(mailto|tel):', 'i') AND path <> '' AND NOT regexp_matches(path, '{"|".join(html.NOT_PATHS)}') AND NOT ends_with(path, '.pdf') AS good_url FROM y),
        r AS (SELECT row_id, title, source_url, CASE WHEN length(trim(coalesce(title, ''))) = 0 THEN 'missing_title'
                WHEN length(trim(coalesce(source_url, ''))) = 0 THEN 'missing_url' WHEN length(trim(coalesce(university_id, ''))) = 0 THEN 'missing_university'
                WHEN NOT coalesce(good_title, false) THEN 'invalid_title' WHEN NOT coalesce(good_url, false) THEN 'invalid_url' END AS reason FROM z)
        SELECT * FROM r WHERE reason IS NOT NULL""",
)
def q_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Degrees as they come, before the registry fills in the universities."""
    degrees = table(spark, sf_dir, "degrees")
    title, url = html.is_programme_title(F.col("title"), F.col("title_type")), html.is_programme_url(F.col("source_url"))
    return catalog.blocked_records(degrees, title, url).select("row_id", "title", "source_url", "reason")


@query(
    "title_types",
    f"""WITH t AS (SELECT row_id, title, coalesce({_MATCH.format('title')}, '') AS n FROM degrees)
        SELECT row_id, CASE {' '.join(f"WHEN regexp_matches(n, '{'|'.join(w)}') THEN '{k}'" for k, w in html.TYPE_WORDS.items())} END AS title_kind,
        regexp_extract(source_url, '^(?:[A-Za-z][A-Za-z0-9_+.-]*:)?(?://[^/?#]*)?([^?#]*)', 1) AS path FROM (SELECT t.*, d.source_url FROM t JOIN degrees d USING (row_id))""",
)
def q_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "degrees")
    return rows.select("row_id", html.title_type(F.col("title")).alias("title_kind"), html.url_path(F.col("source_url")).alias("path"))


@query(
    "page_links",
    """SELECT row_id, trim(regexp_replace(title, '[ \t\n\r]+', ' ', 'g')) AS label, source_url AS url FROM degrees WHERE length(trim(source_url)) > 0 AND title IS NOT NULL""",
)
def q_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages made of the degrees, one link each, parsed again."""
    rows = table(spark, sf_dir, "degrees").where("length(trim(source_url)) > 0 and title is not null")
    esc = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit('"'), F.lit("&quot;"))
    page = F.concat(F.lit('<main><a href="#top">x</a><a href="'), esc(F.col("source_url")), F.lit('">'), esc(F.col("title")), F.lit("</a></main>"))
    pages = rows.select("row_id", page.alias("html"), F.lit("https://base.example/").alias("url"))
    return html.page_links(pages).select("row_id", "label", "url")


@query(
    "page_description",
    """SELECT doc_id, CASE WHEN length(t) >= 120 THEN substr(t, 1, 4000) END AS description FROM
       (SELECT doc_id, trim(regexp_replace(text, '[ \t\n\x0B\f\r]+', ' ', 'g')) AS t FROM documents)""",
)
def q_description(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages made of the documents, one paragraph each, parsed again."""
    esc = F.replace(F.replace(F.col("text"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    page = F.concat(F.lit("<article><p>"), esc, F.lit("</p></article>"))
    return table(spark, sf_dir, "documents").select("doc_id", html.description_udf(page).alias("description"))


# --- sectors -------------------------------------------------------------------------------------

_KEYED = """kd AS (SELECT *, 'degree::' || lower(trim(source)) || '::' || trim(source_id) AS degree_key FROM dg WHERE length(trim(coalesce(source_id, ''))) > 0
            QUALIFY row_number() OVER (PARTITION BY 'degree::' || lower(trim(source)) || '::' || trim(source_id) ORDER BY row_id DESC) = 1),
    fx AS (SELECT s.job_key, s.degree_key, s.pair_key, s.score, lower(trim(kd.university_type)) AS sector, coalesce(kd.branch, '') AS branch
           FROM program_job_similarity s JOIN kd USING (degree_key) WHERE s.score IS NOT NULL AND NOT isnan(s.score) AND lower(trim(kd.university_type)) IN ('publica', 'privada'))"""


def _facts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    degrees = table(spark, sf_dir, "degrees").select("row_id", "source", "source_id", "university", "university_id", "university_type", "branch")
    degrees = keyed_degrees(catalog.attach_registry(degrees, table(spark, sf_dir, "universities")), F.col("row_id"))
    pairs = table(spark, sf_dir, "program_job_similarity").select("pair_key", "job_key", "degree_key", "score")
    facts, lost = analytics.attach(pairs.where("score is not null and not isnan(score)"), degrees.select("degree_key", "university_type", "branch"), "degree_key")
    return analytics.in_sectors(facts, "university_type").withColumnRenamed("university_type", "sector"), lost


@query(
    "join_losses",
    f"WITH {_REGISTRY_SQL}, {_KEYED} SELECT count(*) AS n_lost FROM program_job_similarity s ANTI JOIN kd USING (degree_key) WHERE s.score IS NOT NULL AND NOT isnan(s.score)",
)
def q_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _facts(spark, sf_dir)[1]


@query("sector_summary", f"WITH {_REGISTRY_SQL}, {_KEYED} SELECT sector, count(*) AS n, round(avg(score), 9) AS mean, round(stddev_samp(score), 9) AS sd FROM fx GROUP BY sector")
def q_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = analytics.sector_summary(_facts(spark, sf_dir)[0], "sector", "score")
    return rows.withColumns({c: F.round(c, 9) for c in ("mean", "sd")})


@query(
    "sector_best",
    f"""WITH {_REGISTRY_SQL}, {_KEYED} SELECT job_key, max(score) FILTER (WHERE sector = 'publica') AS best_publica,
        max(score) FILTER (WHERE sector = 'privada') AS best_privada FROM fx GROUP BY job_key""",
)
def q_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.best_per_sector(_facts(spark, sf_dir)[0], "job_key", "sector", "score")


@query(
    "sector_gap",
    f"""WITH {_REGISTRY_SQL}, {_KEYED}, b AS (SELECT job_key, max(score) FILTER (WHERE sector = 'publica') AS best_publica,
        max(score) FILTER (WHERE sector = 'privada') AS best_privada FROM fx GROUP BY job_key)
        SELECT job_key, best_publica, best_privada, round(best_publica - best_privada, 9) AS gap FROM b WHERE best_publica IS NOT NULL AND best_privada IS NOT NULL""",
)
def q_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = analytics.best_per_sector(_facts(spark, sf_dir)[0], "job_key", "sector", "score")
    return analytics.sector_gaps(best, "job_key").withColumn("gap", F.round("gap", 9))


@query(
    "sector_metrics",
    f"""WITH {_REGISTRY_SQL}, {_KEYED}, b AS (SELECT job_key, max(score) FILTER (WHERE sector = 'publica') AS a, max(score) FILTER (WHERE sector = 'privada') AS p FROM fx GROUP BY job_key)
        UNPIVOT (SELECT CAST(count(*) AS DOUBLE) AS keys, CAST(count(a) AS DOUBLE) AS with_publica, CAST(count(p) AS DOUBLE) AS with_privada,
                 CAST(count(*) FILTER (WHERE a IS NOT NULL AND p IS NOT NULL) AS DOUBLE) AS with_both, round(avg(a), 9) AS mean_publica, round(avg(p), 9) AS mean_privada FROM b)
        ON COLUMNS(*) INTO NAME metric VALUE value""",
)
def q_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = analytics.best_per_sector(_facts(spark, sf_dir)[0], "job_key", "sector", "score")
    return analytics.key_metrics(best).withColumn("value", F.round("value", 9))


@query(
    "branch_composition",
    f"""WITH {_REGISTRY_SQL}, {_KEYED} SELECT branch, count(*) FILTER (WHERE sector = 'publica') AS publica, count(*) FILTER (WHERE sector = 'privada') AS privada,
        count(*) AS total, round(count(*) FILTER (WHERE sector = 'publica') / count(*), 9) AS share FROM fx GROUP BY branch""",
)
def q_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = analytics.composition(_facts(spark, sf_dir)[0], F.coalesce("branch", F.lit("")), "sector")
    return rows.withColumn("share", F.round("share", 9))


@query(
    "quantiles",
    """SELECT model, round(quantile_cont(score, 0.25), 9) AS q25, round(quantile_cont(score, 0.5), 9) AS q50, round(quantile_cont(score, 0.95), 9) AS q95
       FROM program_job_similarity WHERE score IS NOT NULL AND NOT isnan(score) GROUP BY model""",
)
def q_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "program_job_similarity").where("score is not null and not isnan(score)")
    found = analytics.quantiles(rows, ["model"], "score", [0.25, 0.5, 0.95])
    return found.withColumns({c: F.round(c, 9) for c in ("q25", "q50", "q95")})


@query("bootstrap_ci")
def q_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.bootstrap_mean(_facts(spark, sf_dir)[0], "sector", "score", "pair_key")


@query("source_roots", "SELECT string_split(source, '_')[1] AS root, count(*) AS n FROM jobs GROUP BY ALL")
def q_roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.source_roots(table(spark, sf_dir, "jobs"))


# --- state -----------------------------------------------------------------------------------------

#: Rows last seen before this are the stored state, later ones arrive as a batch.
SPLIT = "2025-03-01"
#: When the batch arrives.
NOW = "2026-07-01T00:00:00+00:00"
_STATE_COLUMNS = ["row_id", "job_key", "secondary_key", "payload_hash", "update_date", "publication_date", "first_seen_at", "last_seen_at", "updated_at"]


def _state_and_batch(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    jobs = table(spark, sf_dir, "jobs").select(*_STATE_COLUMNS)
    stored = state.compact(jobs.where(F.col("last_seen_at") < SPLIT))
    batch = jobs.where(F.col("last_seen_at") >= SPLIT).withColumn("__ordinal", F.concat_ws("|", "last_seen_at", F.lpad(F.col("row_id").cast("string"), 20, "0")))
    return stored, batch


_BY_DATE = "coalesce(update_date,'') DESC, coalesce(publication_date,'') DESC, coalesce(updated_at,'') DESC, coalesce(payload_hash,'') DESC, job_key DESC"


def _compact_sql(source: str) -> str:
    return f"""(SELECT * FROM (SELECT * FROM {source} WHERE job_key IS NOT NULL QUALIFY row_number() OVER (PARTITION BY job_key ORDER BY {_BY_DATE}, last_seen_at DESC, first_seen_at DESC, row_id DESC) = 1)
        QUALIFY row_number() OVER (PARTITION BY coalesce(secondary_key, chr(31) || job_key) ORDER BY {_BY_DATE}) = 1)"""


_UPSERT_SQL = f"""st AS {_compact_sql(f"(SELECT * FROM jobs WHERE last_seen_at < '{SPLIT}')")},
    b0 AS (SELECT *, last_seen_at || '|' || lpad(CAST(row_id AS VARCHAR), 20, '0') AS o FROM jobs WHERE last_seen_at >= '{SPLIT}' AND job_key IS NOT NULL),
    b1 AS (SELECT * FROM b0 QUALIFY row_number() OVER (PARTITION BY job_key ORDER BY o DESC) = 1),
    b AS (SELECT * FROM b1 QUALIFY row_number() OVER (PARTITION BY coalesce(secondary_key, chr(31) || job_key) ORDER BY o DESC) = 1),
    m AS (SELECT b.row_id, st.job_key AS old, st.updated_at AS upd, st.first_seen_at AS fst, st.payload_hash AS h FROM b JOIN st ON b.job_key = st.job_key
          UNION SELECT b.row_id, st.job_key, st.updated_at, st.first_seen_at, st.payload_hash FROM b JOIN st ON b.secondary_key = st.secondary_key),
    best AS (SELECT row_id, old, h FROM m QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY upd DESC, old DESC) = 1),
    firsts AS (SELECT row_id, min(fst) AS fst FROM m GROUP BY row_id),
    act AS (SELECT b.*, best.old, firsts.fst, CASE WHEN best.old IS NULL THEN 'inserted' WHEN b.payload_hash = best.h THEN 'unchanged' ELSE 'updated' END AS action
            FROM b LEFT JOIN best USING (row_id) LEFT JOIN firsts USING (row_id)
            QUALIFY row_number() OVER (PARTITION BY coalesce(best.old, chr(31) || b.job_key) ORDER BY o DESC, b.job_key) = 1)"""


@query("upsert_actions", f"WITH {_UPSERT_SQL} SELECT row_id, job_key, action FROM act")
def q_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored, batch = _state_and_batch(spark, sf_dir)
    return state.upsert_actions(batch, stored).select("row_id", "job_key", "action")


@query(
    "upsert_state",
    f"""WITH {_UPSERT_SQL}, gone AS (SELECT DISTINCT m.old AS job_key FROM m JOIN act USING (row_id) WHERE action = 'updated'),
        seen AS (SELECT old AS job_key, secondary_key AS sec FROM act WHERE action = 'unchanged' AND old NOT IN (SELECT job_key FROM gone))
        SELECT row_id, job_key, secondary_key, payload_hash, first_seen_at, last_seen_at, updated_at FROM st
        WHERE job_key NOT IN (SELECT job_key FROM gone) AND job_key NOT IN (SELECT job_key FROM seen)
        UNION ALL SELECT row_id, st.job_key, seen.sec, payload_hash, first_seen_at, '{NOW}', updated_at FROM st JOIN seen USING (job_key)
        UNION ALL SELECT row_id, job_key, secondary_key, payload_hash, coalesce(fst, '{NOW}'), '{NOW}', '{NOW}' FROM act WHERE action <> 'unchanged'""",
)
def q_upsert_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole state after the batch."""
    stored, batch = (cut_lineage(x) for x in _state_and_batch(spark, sf_dir))
    new = state.apply_actions(cut_lineage(state.upsert_actions(batch, stored)), stored, F.lit(NOW))
    return new.select("row_id", "job_key", "secondary_key", "payload_hash", "first_seen_at", "last_seen_at", "updated_at")


@query(
    "compaction",
    f"SELECT job_key, secondary_key, payload_hash, update_date, publication_date, updated_at FROM {_compact_sql('jobs')}",
)
def q_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["job_key", "secondary_key", "payload_hash", "update_date", "publication_date", "updated_at"]
    return state.compact(table(spark, sf_dir, "jobs").where("job_key is not null").select(*columns))


#: Pairs written since then are kept, older ones of the same provider and model are stale.
PAIRS_SINCE = "2025-09-01"
_SCOPE_SQL = "provider = (SELECT min(provider) FROM program_job_similarity) AND model = (SELECT min(model) FROM program_job_similarity)"


@query(
    "stale_pairs",
    f"""SELECT pair_key, count(*) AS n FROM program_job_similarity s WHERE {_SCOPE_SQL}
        AND NOT EXISTS (SELECT 1 FROM program_job_similarity k WHERE k.pair_key = s.pair_key AND k.updated_at >= '{PAIRS_SINCE}') GROUP BY pair_key""",
)
def q_stale(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = table(spark, sf_dir, "program_job_similarity").select("pair_key", "provider", "model", "updated_at")
    first = pairs.agg(F.min("provider"), F.min("model")).first()
    keep = pairs.where(F.col("updated_at") >= PAIRS_SINCE).select("pair_key")
    return state.stale_pairs(pairs, keep, first[0], first[1]).groupBy("pair_key").agg(F.count("*").alias("n"))


@query(
    "upsert_pairs",
    f"""WITH p AS (SELECT * FROM program_job_similarity WHERE pair_key IS NOT NULL),
        old AS (SELECT pair_key, min(created_at) AS created_at, max(updated_at) AS updated_at, max(score) FILTER (WHERE NOT isnan(score)) AS score FROM p WHERE updated_at < '{PAIRS_SINCE}' GROUP BY pair_key),
        new AS (SELECT pair_key, max(score) FILTER (WHERE NOT isnan(score)) AS score FROM p WHERE updated_at >= '{PAIRS_SINCE}' GROUP BY pair_key)
        SELECT pair_key, score, created_at, updated_at FROM old WHERE pair_key NOT IN (SELECT pair_key FROM new)
        UNION ALL SELECT pair_key, new.score, coalesce(old.created_at, '{NOW}'), '{NOW}' FROM new LEFT JOIN old USING (pair_key)""",
)
def q_upsert_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs written since a day merged into those written before."""
    pairs = table(spark, sf_dir, "program_job_similarity").where("pair_key is not null")
    pairs = pairs.withColumn("score", F.when(~F.isnan("score"), F.col("score")))
    columns = [F.max("score").alias("score"), F.min("created_at").alias("created_at"), F.max("updated_at").alias("updated_at"), F.max("degree_key").alias("degree_key")]
    old = pairs.where(F.col("updated_at") < PAIRS_SINCE).groupBy("pair_key").agg(*columns)
    new = pairs.where(F.col("updated_at") >= PAIRS_SINCE).select("pair_key", "score", "degree_key")
    return state.upsert_pairs(new, old, F.lit(NOW))[0].select("pair_key", "score", "created_at", "updated_at")


# --- streams ---------------------------------------------------------------------------------------


@query(
    "night_window",
    """SELECT event_id, (strftime(ts, '%H:%M') >= '22:00' OR strftime(ts, '%H:%M') < '07:30') AS active FROM events""",
)
def q_night(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.select("event_id", in_window(F.col("ts"), "22:00", "07:30", "UTC").alias("active"))


@query(
    "stagnation_runs",
    """WITH c AS (SELECT date_trunc('hour', ts) AS hour, count(*) FILTER (WHERE event_type = 'purchase') AS changed FROM events GROUP BY ALL),
            m AS (SELECT *, sum(CASE WHEN changed > 0 THEN 1 ELSE 0 END) OVER (ORDER BY hour) AS island FROM c)
       SELECT min(hour) AS run_start, max(hour) AS run_end, count(*) AS n FROM m WHERE changed = 0 GROUP BY island HAVING count(*) >= 1""",
)
def q_stagnation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours as cycles, purchases as changes."""
    hours = table(spark, sf_dir, "events").groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"))
    counted = hours.agg(F.count_if(F.col("event_type") == "purchase").alias("changed"))
    return cycles.stagnation_runs(counted, "hour", "changed", 1)


@query(
    "hourly_windows",
    "SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, event_type, count(*) AS n FROM events GROUP BY ALL",
)
def q_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cycles.windowed_counts(table(spark, sf_dir, "events"), "ts", "event_type", "1 hour")


@query(
    "user_sessions",
    """WITH g AS (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER w + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
            s AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
       SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS n FROM s GROUP BY user_id, k""",
)
def q_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cycles.sessions(table(spark, sf_dir, "events"), "ts", "user_id", "30 minutes")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from rowloom.plans import function_queries  # noqa: F401 registers its queries

    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    from rowloom.plans import function_queries  # noqa: F401

    return dict(SQL)
