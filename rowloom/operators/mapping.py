"""Degree candidates of postings: keyword rules and token-overlap scores.

The pairwise comparison of tokens is an equality of five-letter keys.  Titles are short, so
their scores come from an inverted index.  A degree that shares no title key with a posting
reaches the least score only if the posting has a large share of its description, at least
``(SCORE_MIN - bonus) / TEXT_WEIGHT``; so only the rarest keys of a description, which cannot
all be missing then, are joined (a prefix filter), and the pairs that meet are scored exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowloom.functions.text import clean_text, mentions, norm_words, token_key, tokens
from rowloom.operators.joins import is_small
from rowloom.operators.select import first_per_key, relative_top
from rowloom.session import cut_lineage

# Thresholds, weights, bonuses and the malus of the score.
SCORE_MIN, SCORE_DELTA, MOST = 0.28, 0.10, 5
TITLE_WEIGHT, TEXT_WEIGHT = 0.70, 0.30
HINT_BONUS, BRANCH_BONUS, ELECTRIC_BONUS, ELECTRIC_MALUS, ELECTRIC_LEAST = 0.15, 0.10, 0.15, 0.30, 0.65
TECHNICAL = "ingenieria y arquitectura"

# Fixed values: (name, scope, keywords, branches, titles) of the rules.
_SALUD, _SOC, _ING, _CI = "Ciencias de la Salud", "Ciencias Sociales y Juridicas", "Ingenieria y Arquitectura", "Ciencias"
RULES: list[tuple[str, str, list[str], list[str], list[str]]] = [
    ("health_nursing", "all", ["enfermer"], [_SALUD], ["Grado en Enfermeria"]),
    ("health_medicine", "all", ["medic", "facultativo"], [_SALUD], ["Grado en Medicina"]),
    ("health_psychology", "all", ["psicolog"], [_SOC, _SALUD], ["Grado en Psicologia"]),
    ("health_physiotherapy", "all", ["fisioterap"], [_SALUD], ["Grado en Fisioterapia"]),
    ("health_dentistry", "all", ["odontolog", "dentista"], [_SALUD], ["Grado en Odontologia"]),
    ("health_nutrition", "all", ["nutricion", "dietista"], [_SALUD], ["Grado en Nutricion Humana y Dietetica"]),
    ("health_occupational_therapy", "all", ["terapia ocupacional", "terapeuta ocupacional"], [_SALUD], ["Grado en Terapia Ocupacional"]),
    ("law", "all", ["abogad", "juridic", "asesor legal"], [_SOC], ["Grado en Derecho"]),
    ("education", "title", ["maestro", "docente", "profesor", "profesora"], [_SOC],
     ["Grado en Maestro en Educacion Infantil", "Grado en Maestro en Educacion Primaria"]),
    ("education_science", "title", ["profesor", "profesora", "docente", "matematic", "fisic", "quimic", "biolog"], [_CI], []),
    ("data_science", "all", ["cientifico de datos", "data scientist", "analista de datos"], [_ING, _CI], ["Grado en Ciencia e Ingenieria de Datos"]),
    ("software", "all", ["desarrollador", "developer", "programador", "software", "full stack", "backend", "frontend"], [_ING],
     ["Grado en Ingenieria Informatica"]),
    ("engineering_generic", "all", ["ingenier"], [_ING], []),
    ("engineering_mechanical", "all", ["ingeniero mecanico", "ingenieria mecanica"], [_ING], ["Grado en Ingenieria Mecanica"]),
    ("engineering_electrical", "all", ["ingeniero electrico", "ingenieria electrica", "electricista", "electrico", "instalaciones electricas"],
     [_ING], ["Grado en Ingenieria Electrica"]),
    ("engineering_electronics", "all", ["ingeniero electronico", "ingenieria electronica"], [_ING],
     ["Grado en Ingenieria Electronica Industrial y Automatica"]),
    ("engineering_chemical", "all", ["ingeniero quimico", "ingenieria quimica"], [_ING], ["Grado en Ingenieria Quimica Industrial"]),
    ("tourism", "title", ["turismo"], [_SOC], ["Grado en Turismo"]),
    ("communication_periodism", "title", ["periodista", "periodismo", "comunicacion audiovisual"], [_SOC],
     ["Grado en Periodismo", "Grado en Comunicacion"]),
    ("economics", "title", ["economista", "economia", "finanzas"], [_SOC], ["Grado en Economia"]),
    ("business_admin", "title", ["administracion de empresas", "direccion de empresas", "business analyst"], [_SOC],
     ["Grado en Administracion y Direccion de Empresas"]),
    ("social_work", "title", ["trabajador social", "trabajo social"], [_SOC], ["Grado en Trabajo Social"]),
]
# Titles of teaching posts, the rules they switch off, and signs of electric work.
TEACHING = ["profesor", "profesora", "docente", "maestro"]
NOT_FOR_TEACHING = [
    "engineering_generic", "engineering_mechanical", "engineering_electrical", "engineering_electronics",
    "engineering_chemical", "software", "data_science",
]
ELECTRIC = [
    "electricista", "electrico", "electrica", "instalaciones electricas", "cuadro electrico", "baja tension",
    "alta tension", "electrotecn",
]
# Branches by parts of words, tried in this order.
BRANCH_WORDS = {
    _SALUD: ["enfermer", "medicin", "fisioterap", "odontolog", "sanitari", "logoped", "terapia ocupacional"],
    _ING: ["ingenier", "electron", "electr", "telecom", "industrial", "informatic", "software", "sistemas", "renovables"],
    _SOC: ["derecho", "juridic", "econom", "turismo", "marketing", "administracion", "empresa", "docente", "maestro"],
    "Artes y Humanidades": ["diseno", "historia", "filologia", "idiomas", "traduccion", "comunicacion audiovisual"],
    _CI: ["matematic", "fisic", "quimic", "biolog", "ciencias"],
}


def branch_from_text(norm: Column) -> Column:
    out = F.lit(None).cast("string")
    for branch, words in reversed(BRANCH_WORDS.items()):
        out = F.when(mentions(norm, words), branch).otherwise(out)
    return out


def matched_rules(title: Column, text: Column) -> Column:
    """The places in ``RULES``, from 1, of the rules that a normalised title and text meet."""
    teaching = mentions(title, TEACHING)
    found = []
    for k, (name, scope, words, _, _) in enumerate(RULES, 1):
        hit = mentions(title if scope == "title" else text, words)
        found.append(F.when(hit & ~teaching if name in NOT_FOR_TEACHING else hit, F.lit(k)))
    return F.filter(F.array(*found), lambda k: k.isNotNull())


def rule_hints(rules: Column) -> tuple[Column, Column]:
    """Normalised titles and branches that matched rules suggest.  The rules are literals of one
    projection; no join with a rule table is needed."""
    values = lambda k: F.array(*[F.array(*[norm_words(F.lit(x)) for x in r[k]]).cast("array<string>") for r in RULES])
    keep = lambda k: F.array_distinct(F.flatten(F.transform(rules, lambda i: F.element_at(values(k), i))))
    return keep(4), keep(3)


def catalogue_index(catalogue: DataFrame, ordinal: str) -> DataFrame:
    """One row per normalised title: ``(title_norm, title, branch, branch_norm, description_norm)``.
    Of several rows the first non-null value of each column by ``ordinal`` counts."""
    # Explodes of one element evaluate each long expression once.
    once = lambda x, name: F.explode(F.array(x)).alias(name)
    cleaned = F.struct(*[clean_text(F.col(c)).alias(c) for c in ("title", "branch", "description")])
    rows = catalogue.select(F.col(ordinal).alias("__o"), once(cleaned, "c")).select("__o", "c.*").where("title is not null")
    norms = F.struct(norm_words(F.col("title")).alias("title_norm"), norm_words(F.col("description")).alias("description_norm"))
    rows = rows.select("__o", "title", "branch", once(norms, "n")).select("__o", "title", "branch", "n.*")
    rows = rows.select("__o", "title", "title_norm", "description_norm", once(F.coalesce("branch", branch_from_text(F.col("title_norm"))), "branch"))
    first = lambda c: F.min(F.when(F.col(c).isNotNull(), F.struct("__o", c))).alias(c)
    rows = rows.groupBy("title_norm").agg(first("title"), first("branch"), first("description_norm"))
    return rows.select(
        "title_norm", "title.title", "branch.branch", norm_words(F.col("branch.branch")).alias("branch_norm"),
        "description_norm.description_norm",
    )


def overlap_scores(texts: DataFrame, targets: DataFrame, text_id: str, text: str, target_id: str, target: str) -> DataFrame:
    """``(text_id, target_id, score)``: the share of the target's tokens, repetitions counted,
    that match a token of the text.  Only pairs with a match are given; null texts match nothing."""
    left = texts.select(text_id, F.explode(F.array_distinct(F.transform(tokens(F.col(text)), token_key))).alias("key"))
    right = targets.select(target_id, F.size(tokens(F.col(target))).alias("n"), F.explode(F.transform(tokens(F.col(target)), token_key)).alias("key"))
    right = right.groupBy(target_id, "n", "key").agg(F.count("*").alias("times"))
    right = F.broadcast(right) if is_small(right, 200_000) else right
    hits = left.join(right, "key").groupBy(text_id, target_id).agg((F.sum("times") / F.max("n")).alias("score"))
    return hits


def _key_counts(index: DataFrame, text: str) -> DataFrame:
    """``(title_norm, n, key, times)``: the keys of a text of the catalogue, how often each occurs and
    how many there are."""
    keys = F.transform(tokens(F.col(text)), token_key)
    rows = index.select("title_norm", F.size(keys).alias("n"), F.explode(keys).alias("key"))
    return rows.groupBy("title_norm", "n", "key").agg(F.count("*").alias("times"))


def text_candidates(rows: DataFrame, index: DataFrame, counts: DataFrame) -> DataFrame:
    """Distinct ``(__job, title_norm)`` that may reach the least score by the description alone.

    With the keys of a description from rare to frequent, a posting that has a share of at least
    ``s`` of them has one of the first, namely of those before which at most ``1 - s`` lies.
    """
    text_keys = rows.select("__job", F.explode("text_keys").alias("key"))
    frequency = text_keys.groupBy("key").agg(F.count("*").alias("df"))
    by_rarity = Window.partitionBy("title_norm").orderBy("df", "key")
    ranked = counts.join(frequency, "key", "left").withColumn("df", F.coalesce("df", F.lit(0)))
    before = F.sum("times").over(by_rarity) - F.col("times")
    # Keys that no posting has take part in the order but need no join.
    ranked = ranked.withColumn("before", before / F.col("n")).where("df > 0")
    ranked = ranked.join(index.select("title_norm", "branch_norm"), "title_norm").select("title_norm", "branch_norm", "key", "before")
    ranked = cut_lineage(ranked)
    room = lambda bonus: 1 - max(0.0, (SCORE_MIN - bonus) / TEXT_WEIGHT) + 1e-9

    def met(left: DataFrame, bonus: float, on: list[str]) -> DataFrame:
        return left.join(ranked.where(F.col("before") <= room(bonus)).drop(*{"branch_norm"}.difference(on)), on).select("__job", "title_norm")

    hinted = rows.where(F.size("hint_branches") > 0).select("__job", "electric", "text_keys", F.explode("hint_branches").alias("branch_norm"))
    hinted = hinted.select("__job", "electric", "branch_norm", F.explode("text_keys").alias("key"))
    electric = rows.where("electric").select("__job", F.lit(TECHNICAL).alias("branch_norm"), F.explode("text_keys").alias("key"))
    on = ["branch_norm", "key"]
    found = met(text_keys, 0.0, ["key"]).unionByName(met(hinted, BRANCH_BONUS, on)).unionByName(met(electric, ELECTRIC_BONUS, on))
    both = hinted.where(F.col("electric") & (F.col("branch_norm") == TECHNICAL))
    return found.unionByName(met(both, BRANCH_BONUS + ELECTRIC_BONUS, on)).distinct()


def score_candidates(jobs: DataFrame, catalogue: DataFrame, job_id: str, ordinal: str) -> DataFrame:
    """``(job_id, title, branch, score)`` of every catalogue title with a score of at least
    ``SCORE_MIN``.  Null titles and descriptions count as empty; an empty table gives none."""
    words = norm_words(F.coalesce(F.col("title"), F.lit("")))
    both = norm_words(F.concat_ws(" ", "title", "description"))
    rows = jobs.select(F.col(job_id).alias("__job"), F.explode(F.array(F.struct(words.alias("title_only"), both.alias("text_all")))).alias("t"))
    rows = rows.select("__job", "t.*")
    rows = rows.select("*", F.explode(F.array(matched_rules(F.col("title_only"), F.col("text_all")))).alias("rules"))
    hinted, branches = rule_hints(F.col("rules"))
    keys = lambda c: F.array_distinct(F.transform(tokens(F.col(c)), token_key))
    # Sets of numbers are compared faster than sets of texts; 64 bits tell all keys apart.
    hashed = lambda keys: F.transform(keys, lambda k: F.xxhash64(k))
    rows = cut_lineage(rows.select(
        "__job", keys("title_only").alias("title_keys"), keys("text_all").alias("text_keys"), hashed(keys("text_all")).alias("hashes"), hinted.alias("hints"),
        branches.alias("hint_branches"), mentions(F.concat_ws(" ", "title_only", "text_all"), ELECTRIC).alias("electric"),
    ))
    index = cut_lineage(catalogue_index(catalogue, ordinal))

    titles = _key_counts(index, "title_norm")
    titles = F.broadcast(titles) if is_small(titles) else titles
    by_title = rows.select("__job", F.explode("title_keys").alias("key")).join(titles, "key")
    by_title = by_title.groupBy("__job", "title_norm").agg((F.sum("times") / F.max("n")).alias("t"))
    counts = cut_lineage(_key_counts(index.where("description_norm <> ''"), "description_norm"))
    by_text = text_candidates(rows, index, counts).withColumn("by_text", F.lit(True))
    hints = rows.select("__job", F.explode("hints").alias("title_norm")).withColumn("h", F.lit(True))
    pairs = by_title.join(by_text, ["__job", "title_norm"], "full").join(hints, ["__job", "title_norm"], "full")

    # Keys that occur more than once lie on several levels; what a posting has of all levels is its share.
    leveled = counts.select("title_norm", "n", F.xxhash64("key").alias("key"), F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("level"))
    leveled = leveled.groupBy("title_norm", "n", "level").agg(F.collect_list("key").alias("keys"))
    levels = leveled.groupBy("title_norm").agg(
        F.max("n").alias("n"), F.max(F.when(F.col("level") == 1, F.col("keys"))).alias("all_keys"),
        F.collect_list(F.when(F.col("level") > 1, F.col("keys"))).alias("levels"),
    )
    facts = index.select("title_norm", "title", "branch", "branch_norm").join(levels, "title_norm", "left")
    scored = pairs.drop("by_text").join(cut_lineage(facts), "title_norm").join(rows.select("__job", "hashes", "hint_branches", "electric"), "__job")
    scored = scored.select("*", F.explode(F.array(F.array_intersect("hashes", "all_keys"))).alias("common"))

    has = F.aggregate("levels", F.size("common"), lambda total, keys: total + F.size(F.array_intersect("common", keys)))
    share = F.when(F.col("n").isNull(), 0.0).otherwise(has / F.col("n"))
    has_branch = F.coalesce(F.col("branch_norm"), F.lit("")) != ""
    technical = F.coalesce(F.col("branch_norm") == TECHNICAL, F.lit(False))
    bonus = (
        F.when(F.coalesce("h", F.lit(False)), HINT_BONUS).otherwise(0.0)
        + F.when(has_branch & F.array_contains("hint_branches", F.col("branch_norm")), BRANCH_BONUS).otherwise(0.0)
        + F.when(F.col("electric") & technical, ELECTRIC_BONUS).otherwise(0.0)
    )
    scored = scored.select(
        "__job", "title", "branch", F.coalesce("t", F.lit(0.0)).alias("t"), bonus.alias("bonus"),
        (F.col("electric") & has_branch & ~technical).alias("other"), F.explode(F.array(share)).alias("d"),
    )
    base = TITLE_WEIGHT * F.col("t") + TEXT_WEIGHT * F.col("d")
    score = F.greatest(F.lit(0.0), F.least(F.lit(1.0), base + F.col("bonus") - F.when(F.col("other"), ELECTRIC_MALUS).otherwise(0.0)))
    scored = scored.withColumn("score", score).where((F.col("score") >= SCORE_MIN) & ~(F.col("other") & (F.col("score") < ELECTRIC_LEAST)))
    return scored.select(F.col("__job").alias(job_id), "title", "branch", "score")


def map_degrees(jobs: DataFrame, catalogue: DataFrame, job_id: str, ordinal: str) -> DataFrame:
    """Per posting the selected titles and their branches as pipe lists and ``matched`` or
    ``no_match``; ``best_score`` and ``n_kept`` say how the selection came about."""
    kept = relative_top(score_candidates(jobs, catalogue, job_id, ordinal), job_id, "score", "title", MOST, SCORE_DELTA, SCORE_MIN)
    listed = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "title", "branch")))
    found = kept.groupBy(job_id).agg(listed.alias("k"), F.max("score").alias("best_score"), F.count("*").alias("n_kept"))
    found = found.select(
        job_id, F.array_join("k.title", "|").alias("target_degree_titles"), "best_score", "n_kept",
        F.nullif(F.array_join(F.array_distinct(F.filter("k.branch", lambda b: b.isNotNull())), "|"), F.lit("")).alias("target_degree_branches"),
    )
    out = jobs.select(job_id).join(found, job_id, "left")
    status = F.when(F.col("target_degree_titles").isNull(), "no_match").otherwise("matched")
    return out.withColumn("degree_match_status", status).withColumn("n_kept", F.coalesce("n_kept", F.lit(0)))


def canonical_names(names: DataFrame, catalogue: DataFrame, ordinal: str) -> DataFrame:
    """Adds ``canonical``: the catalogue's spelling of a title, else the name itself."""
    first = first_per_key(catalogue.where("title is not null").withColumn("name_norm", norm_words(F.col("title"))), F.col("name_norm"), [F.col(ordinal)])
    index = first.select("name_norm", F.col("title").alias("spelling"))
    index = F.broadcast(index) if is_small(index) else index
    joined = names.withColumn("name_norm", norm_words(F.col("name"))).join(index, "name_norm", "left")
    return joined.withColumn("canonical", F.coalesce("spelling", "name")).drop("spelling", "name_norm")
