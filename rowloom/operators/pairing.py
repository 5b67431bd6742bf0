"""Candidate pairs of postings and degrees, gated before anything expensive is computed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.functions.text import norm_ascii, pipe_values

# Words after which a programme's name ends.
TAIL = r"\bonline\b|\bpresencial\b|\bsemipresencial\b|\bmodalidad\b|\bduracion\b"


def _tail(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.get(F.split(text, TAIL, 2), F.lit(0)), r" +", " "))


def family_keys(title: Column) -> Column:
    """Programmes a title belongs to; a double degree has its whole name and each part."""
    norm = norm_ascii(F.coalesce(title, F.lit("")))
    single = _tail(F.regexp_extract(norm, r"\bgrado en ([a-z0-9 ]+)", 1))
    double = _tail(F.regexp_extract(norm, r"\bdoble grado en ([a-z0-9 ]+)", 1))
    parts = F.transform(F.split(double, r"\by\b"), lambda p: F.trim(p))
    return F.array_distinct(F.filter(F.concat(F.array(single), parts), lambda k: k != ""))


def gate_text(description: str = "description", title: str = "title") -> Column:
    """The description, or the title where it is null or empty."""
    return F.trim(F.coalesce(F.nullif(F.col(description), F.lit("")), F.col(title), F.lit("")))


def candidate_pairs(jobs: DataFrame, degrees: DataFrame, least: int = 40) -> DataFrame:
    """Distinct ``(job_key, degree_key)`` with titles and texts.

    ``jobs`` has ``job_key, title, description, target_degree_titles, target_degree_branches,
    degree_match_status``; ``degrees`` has ``degree_key, title, description, branch``.  A pair
    arises from a target title, from a title of the same family, or from a target branch if the
    families of targets and degree overlap or the targets have none.

    * Only postings that are ``matched`` and sides with texts of ``least`` characters take part.
    * Null keys give no pair; of several rows with one key the smallest title and text count.
    * Texts are joined to the surviving pairs only, so the joins move keys and titles.
    """
    jobs = jobs.where((F.col("degree_match_status") == "matched") & F.col("job_key").isNotNull())
    jobs = jobs.withColumn("job_text", gate_text()).where(F.length("job_text") >= least)
    degrees = degrees.where(F.col("degree_key").isNotNull()).withColumn("degree_text", gate_text())
    degrees = degrees.where(F.length("degree_text") >= least)
    wanted = jobs.select("job_key", F.explode(pipe_values(F.col("target_degree_titles"))).alias("target")).distinct()
    titles = degrees.select("degree_key", "title", family_keys(F.col("title")).alias("families"))

    by_title = wanted.join(titles.select("degree_key", F.col("title").alias("target")), "target").select("job_key", "degree_key")
    wanted_families = wanted.select("job_key", F.explode(family_keys(F.col("target"))).alias("family")).distinct()
    known_families = titles.select("degree_key", F.explode("families").alias("family"))
    by_family = wanted_families.join(known_families, "family").select("job_key", "degree_key")

    families = wanted_families.groupBy("job_key").agg(F.collect_set("family").alias("wanted_families"))
    branches = jobs.select("job_key", F.explode(pipe_values(F.col("target_degree_branches"))).alias("branch")).distinct()
    branches = branches.join(families, "job_key", "left")
    by_branch = branches.join(degrees.select("degree_key", "branch", family_keys(F.col("title")).alias("families")), "branch")
    free = F.col("wanted_families").isNull()
    by_branch = by_branch.where(free | F.arrays_overlap("wanted_families", "families")).select("job_key", "degree_key")

    keys = by_title.unionByName(by_family).unionByName(by_branch).distinct()
    job_side = jobs.groupBy("job_key").agg(F.min(F.struct(F.col("title").alias("job_title"), "job_text")).alias("j"))
    degree_side = degrees.groupBy("degree_key").agg(F.min(F.struct(F.col("title").alias("degree_title"), "degree_text")).alias("d"))
    return keys.join(job_side, "job_key").join(degree_side, "degree_key").select("job_key", "degree_key", "j.*", "d.*")
