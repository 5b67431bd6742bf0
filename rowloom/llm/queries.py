"""The queries pN_... of the training-data operators, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.llm.canonical import map_to_canonical
from rowloom.llm.cut import CutModel, cut_rows, fit_cut_model, score_cuts, source_shares
from rowloom.llm.fuse import Bundle, Dependency, fuse_groups
from rowloom.llm.language import label_languages, train_language_model
from rowloom.llm.leak import find_leaks
from rowloom.llm.packing import pack_each, pack_table
from rowloom.llm.residue import find_residue
from rowloom.llm.topn import top_n_per_group
from rowloom.operators.quantities import states_amount
from rowloom.session import cut_lineage, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


#: The fields of problem 1 and the kind of entry each of them names.
PLACE_FIELDS = {
    "municipality_raw": "municipality",
    "province_raw": "province",
    "contract_type_raw": "contract_type",
    "raw_location": "municipality",
}


@query("p1_canonical")
def p1_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every value of the four fields that is not canonical, its entry and its similarity."""
    jobs, canon = table(spark, sf_dir, "jobs"), table(spark, sf_dir, "canonical_values")
    return map_to_canonical(jobs, "row_id", PLACE_FIELDS, canon)


@query("p1_found")
def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p1_canonical(spark, sf_dir).select("row_id", "field", "canon_id")


@query("p2_residue")
def p2_residue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every value that holds no content, with the evidence that speaks against it."""
    jobs, degrees = table(spark, sf_dir, "jobs"), table(spark, sf_dir, "degrees")
    found = [
        find_residue(jobs, "row_id", ["title", "description"], "title", "source_url"),
        find_residue(degrees, "row_id", ["description"], "title", "source_url"),
    ]
    named = [x.select(F.lit(t).alias("tbl"), "*") for t, x in zip(("jobs", "degrees"), found, strict=True)]
    return named[0].unionByName(named[1])


@query("p2_found")
def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p2_residue(spark, sf_dir).select("tbl", "row_id", "field")


@query(
    "p5_found",
    """
    WITH best AS (
        SELECT job_key, degree_key, max(score) AS score FROM program_job_similarity
        WHERE score IS NOT NULL AND NOT isnan(score) AND job_key IS NOT NULL AND degree_key IS NOT NULL
        GROUP BY job_key, degree_key)
    SELECT job_key, degree_key FROM best
    QUALIFY row_number() OVER (PARTITION BY job_key ORDER BY score DESC, degree_key) <= 5
    """,
)
def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = table(spark, sf_dir, "program_job_similarity")
    return top_n_per_group(pairs, "job_key", "degree_key", "score", 5).select("job_key", "degree_key")


@query(
    "p5_top_n",
    """
    WITH best AS (
        SELECT job_key, degree_key, max(score) AS score FROM program_job_similarity
        WHERE score IS NOT NULL AND NOT isnan(score) AND job_key IS NOT NULL AND degree_key IS NOT NULL
        GROUP BY job_key, degree_key)
    SELECT job_key, degree_key, score,
           CAST(row_number() OVER (PARTITION BY job_key ORDER BY score DESC, degree_key) AS INTEGER) AS rank
    FROM best QUALIFY rank <= 5
    """,
)
def p5_top_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = table(spark, sf_dir, "program_job_similarity")
    return top_n_per_group(pairs, "job_key", "degree_key", "score", 5)


#: Tables with descriptions, and the score from which a description counts as cut.
DESCRIBED = ("jobs", "degrees")
CUT = 0.5


def cut_model(spark: SparkSession, sf_dir: str) -> CutModel:
    rows = [cut_rows(table(spark, sf_dir, t), "row_id", "description", "source") for t in DESCRIBED]
    return fit_cut_model(rows[0].unionByName(rows[1]))


def scored_descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = cut_model(spark, sf_dir)
    parts = [
        score_cuts(table(spark, sf_dir, t), "row_id", "description", "source", model).select(F.lit(t).alias("tbl"), "*")
        for t in DESCRIBED
    ]
    return parts[0].unionByName(parts[1])


def cut_descriptions(spark: SparkSession, sf_dir: str, scored: DataFrame) -> DataFrame:
    """Cut descriptions that hold content; residue is a case of its own.  Only what is cut is
    searched for residue."""
    cut = cut_lineage(scored.where(F.col("score") >= CUT))
    parts = []
    for t in DESCRIBED:
        asked = cut.where(F.col("tbl") == t)
        residue = find_residue(table(spark, sf_dir, t), "row_id", ["description"], "title", "source_url", asked)
        parts.append(asked.join(residue.select("row_id"), "row_id", "left_anti").select(*cut.columns))
    return parts[0].unionByName(parts[1])


@query("p6_found")
def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_descriptions(spark, sf_dir, scored_descriptions(spark, sf_dir)).select("tbl", "row_id")


@query("p6_sources")
def p6_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each source truncates."""
    scored = cut_lineage(scored_descriptions(spark, sf_dir))
    return source_shares(scored, cut_descriptions(spark, sf_dir, scored), ["tbl", "row_id"])


def survivor_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[Bundle]]:
    """Jobs of postings with two rows or more, with what the bundles need to know of them, and the
    bundles.  The island of a place determines the province.  The rows are written once."""
    everything = table(spark, sf_dir, "jobs")
    several = everything.where(F.col("job_key").isNotNull()).groupBy("job_key").agg(F.count("*").alias("n")).where("n > 1").select("job_key")
    jobs = everything.join(cut_lineage(several), "job_key", "left_semi")
    ids = cut_lineage(jobs.select("row_id"))
    residue = find_residue(everything, "row_id", ["description"], "title", "source_url", ids).select("row_id")
    cut = score_cuts(jobs, "row_id", "description", "source", cut_model(spark, sf_dir)).where(F.col("score") >= CUT)
    bad = residue.unionByName(cut.select("row_id")).distinct().withColumn("__bad", F.lit(True))
    rows = jobs.select(
        "row_id", "job_key", "island_raw", "province_raw", "municipality_raw", "raw_location", "salary_text",
        F.length("description").alias("__len"), F.unix_micros(F.col("last_seen_at").try_cast("timestamp")).alias("__seen"),
    )
    rows = cut_lineage(states_amount(rows, "salary_text", "__pays").drop("salary_text").join(bad, "row_id", "left"))
    seen, first = F.coalesce("__seen", F.lit(0)), -F.col("row_id")
    described = F.col("__len").isNotNull() & F.col("__bad").isNull()
    parts = sum(F.col(c).isNotNull().cast("int") for c in ("municipality_raw", "island_raw", "raw_location"))
    island, province = F.lower(F.trim("island_raw")), F.lower(F.trim("province_raw"))
    bundles = [
        Bundle("survivor", F.lit(True), [seen, first]),
        Bundle("description", described, [F.col("__len"), seen, first]),
        Bundle("salary", F.col("__pays"), [seen, first]),
        Bundle("place", parts > 0, [parts, seen, first], {"island": island}),
        Bundle("province", F.col("province_raw").isNotNull(), [F.lit(1), seen, first], {"province": province}),
    ]
    return rows, bundles


@query("p7_survivors")
def p7_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source rows of each survivor's bundles, chosen together: description, pay, place and province."""
    rows, bundles = survivor_rows(spark, sf_dir)
    return fuse_groups(rows, "job_key", "row_id", bundles, [Dependency("island", "province")])


@query("p7_found")
def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = {f"{n}_id": f"{n}_row_id" for n in ("survivor", "description", "salary")}
    return p7_survivors(spark, sf_dir).select("job_key", *[F.col(a).alias(b) for a, b in wanted.items()])


@query("p9_leaks")
def p9_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and leaked item with the repeated words and the exact containment."""
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


@query("p9_found")
def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p9_leaks(spark, sf_dir).select("doc_id", "item_id")


@query("p9_items")
def p9_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which test items leaked, and into how many documents."""
    leaks = p9_leaks(spark, sf_dir).groupBy("item_id").agg(F.count("*").alias("n_docs"), F.max("n_words").alias("most_words"))
    return table(spark, sf_dir, "eval_items").select("item_id", "benchmark").join(leaks, "item_id")


@query("p8_containers")
def p8_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one container; the capacities are used together."""
    return pack_table(table(spark, sf_dir, "documents"), table(spark, sf_dir, "containers"), "doc_id", "text")


@query("p8_each_capacity")
def p8_each_capacity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One complete packing of all documents for each capacity by itself."""
    return pack_each(table(spark, sf_dir, "documents"), table(spark, sf_dir, "containers"), "doc_id", "text")


@query("p10_languages")
def p10_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language and confidence of every document and every paragraph."""
    documents = table(spark, sf_dir, "documents")
    model = train_language_model(documents, "text", "lang", "doc_id")
    return label_languages(documents, model, "doc_id", "text", "lang")


@query("p10_found")
def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = p10_languages(spark, sf_dir)
    case = F.col("label").isNull() | (F.col("label") != F.col("main")) | F.col("mixed")
    return rows.where(case).select("doc_id", "para_no", "lang")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
