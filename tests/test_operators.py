"""Selection, mapping, pairing, vectors, analytics, catalogue."""

import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from rowloom.functions.text import STOPWORDS, strip_accents
from rowloom.operators import analytics, catalog, mapping, pairing, select, vectors
from rowloom.operators.joins import is_small, join_dimension

DEGREES = "row_id int, title string, branch string, description string"


def test_first_and_two_pass(spark):
    df = spark.createDataFrame([(1, "a", "s", 1), (2, "a", None, 2), (3, "b", "s", 3), (4, None, None, 4)], "id int, k string, s string, o int")
    assert [r.id for r in select.first_per_key(df, F.col("k"), [F.col("o")]).orderBy("id").collect()] == [1, 3, 4]
    assert [r.id for r in select.first_per_key(df, F.col("k"), [F.col("o")], last=True).orderBy("id").collect()] == [2, 3, 4]
    two = select.latest_two_pass(df.where("k is not null"), F.col("k"), F.col("s"), [F.col("o")], F.col("id"))
    assert [r.id for r in two.orderBy("id").collect()] == [2, 3]


def test_cover_sources(spark):
    rows = [(k, f"s{k % 3}", f"u{k}", k) for k in range(6)] + [(6, "s0", "u0", 99), (7, "s1", None, 0), (8, "s1", None, 0)]
    df = spark.createDataFrame(rows, "id int, source string, url string, o int")
    got = select.cover_sources(df, "source", "url", [F.col("o").desc(), F.col("id")], 4).collect()
    assert len(got) == 4 and {r.source for r in got} == {"s0", "s1", "s2"} and 6 in [r.id for r in got] and 0 not in [r.id for r in got]
    assert select.cover_sources(df.limit(0), "source", "url", [F.col("o")], 4).count() == 0


def test_quotas(spark):
    assert select.quotas({"a": 0.82, "b": 0.13, "c": 0.05}, 1000, "c") == {"a": 820, "b": 130, "c": 50}
    assert select.quotas({"a": 0, "b": 0}, 9, "b", defaults={"a": 1, "b": 1}) == {"a": 4, "b": 5}
    assert select.quotas({"a": 0.5, "c": 0.5}, 1000, "c", {"c": 120}, "a") == {"a": 880, "c": 120}
    df = spark.createDataFrame([(k, "a" if k % 2 else "z") for k in range(10)], "id int, source string")
    assert sorted(r.id for r in select.take_quotas(df, "source", {"a": 2}, [F.col("id")]).collect()) == [1, 3]


def test_relative_top(spark):
    df = spark.createDataFrame([("g", "a", 0.5), ("g", "b", 0.5), ("g", "c", 0.41), ("g", "d", 0.39), ("h", "a", 0.2)], "g string, i string, s double")
    assert [(r.g, r.i) for r in select.relative_top(df, "g", "s", "i").orderBy("i").collect()] == [("g", "a"), ("g", "b"), ("g", "c")]


def test_join_dimension(spark):
    facts = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    dim = spark.createDataFrame([("a", "x")], "k string, d string")
    assert sorted((r.v, r.d) for r in join_dimension(facts, dim, ["k"]).collect()) == [(1, "x"), (2, None)]
    assert is_small(facts, 2) and not is_small(facts, 1)


def plain_scores(jobs, degrees):
    """The scores by comparing every token with every token."""
    stop = set(STOPWORDS)
    tok = lambda t: [w for w in t.split() if w not in stop]

    def match(a, b):
        return a == b or (len(a) >= 5 and len(b) >= 5 and (a.startswith(b[:5]) or b.startswith(a[:5])))

    def sim(job, degree):
        d = tok(degree)
        return sum(any(match(x, y) for y in tok(job)) for x in d) / len(d) if d and tok(job) else 0.0

    return {(j, d): sim(j, d) for j in jobs for d in degrees}


def test_overlap_is_the_pairwise_comparison(spark):
    rng = random.Random(3)
    words = ["ingenieria", "ingeniero", "ingen", "datos", "dato", "mar", "salud", "grado", "en", "saludable", "datosx"]
    texts = sorted({" ".join(rng.choices(words, k=rng.randint(1, 5))) for _ in range(60)})
    jobs, degrees = texts[:30], texts[30:]
    left = spark.createDataFrame([(t, t) for t in jobs], "a string, t string")
    right = spark.createDataFrame([(t, t) for t in degrees], "b string, u string")
    got = {(r.a, r.b): r.score for r in mapping.overlap_scores(left, right, "a", "t", "b", "u").collect()}
    wanted = {k: v for k, v in plain_scores(jobs, degrees).items() if v}
    assert got.keys() == wanted.keys() and all(abs(got[k] - wanted[k]) < 1e-12 for k in got)


def catalogue(spark, rows):
    return spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], DEGREES)


def mapped(spark, title, rows, text=None):
    jobs = spark.createDataFrame([(1, title, text)], "id int, title string, description string")
    return mapping.map_degrees(jobs, catalogue(spark, rows), "id", "row_id").first()


THREE = [
    ("Grado en Ingenieria Electrica", "Ingenieria y Arquitectura", "electricidad y maquinas"),
    ("Grado en Turismo", "Ciencias Sociales y Juridicas", "hoteles"),
    ("Grado en Enfermeria", "Ciencias de la Salud", "cuidados"),
]


def test_mapping_expectations(spark):
    assert mapped(spark, "Personal de limpieza", THREE).degree_match_status == "no_match"
    electric = mapped(spark, "Electricista de instalaciones", THREE)
    assert electric.target_degree_titles == "Grado en Ingenieria Electrica" and electric.target_degree_branches == "Ingenieria y Arquitectura"
    many = [(f"Grado en Ingenieria {x}", "Ingenieria y Arquitectura", None) for x in "ABCDEFGHIJKL"]
    assert len(mapped(spark, "Ingeniero", many).target_degree_titles.split("|")) == 5
    assert mapped(spark, None, THREE).degree_match_status == "no_match"
    assert mapped(spark, "A", []).degree_match_status == "no_match"


def plain_norm(text):
    bare = "".join(c for c in unicodedata.normalize("NFD", (text or "").lower()) if unicodedata.category(c) != "Mn")
    return " ".join(re.sub("[^a-z0-9]", " ", bare).split())


def full_scores(jobs, rows):
    """Scores of every posting and title without the inverted index."""
    stop = set(STOPWORDS)
    norm = plain_norm
    tok = lambda t: [w for w in t.split() if w not in stop]
    sim = lambda job, deg: sum(x[:5] in {y[:5] for y in tok(job)} for x in tok(deg)) / len(tok(deg)) if tok(deg) and tok(job) else 0.0
    out = {}
    for i, (title, text) in enumerate(jobs):
        t, a = norm(title), norm(f"{title} {text}")
        teaching = any(x in t for x in mapping.TEACHING)
        titles, branches = set(), set()
        for name, scope, words, bs, ts in mapping.RULES:
            if any(w in (t if scope == "title" else a) for w in words) and not (teaching and name in mapping.NOT_FOR_TEACHING):
                titles |= {norm(x) for x in ts}
                branches |= {norm(x) for x in bs}
        electric = any(x in f"{t} {a}" for x in mapping.ELECTRIC)
        scored = []
        for name, branch, desc in rows:
            n, b = norm(name), norm(branch)
            base = 0.7 * sim(t, n) + 0.3 * (sim(a, norm(desc)) if desc else 0.0)
            bonus = 0.15 * (n in titles) + 0.10 * (b in branches) + (0.15 if electric and b == mapping.TECHNICAL else 0)
            other = electric and b != mapping.TECHNICAL
            s = max(0.0, min(1.0, base + bonus - (0.3 if other else 0)))
            if not (other and s < 0.65):
                scored.append((-round(s, 9), name))
        scored.sort()
        best = -scored[0][0] if scored else 0
        out[i] = [n for s, n in scored if -s >= 0.28 and -s >= best - 0.1][:5] if best >= 0.28 else []
    return out


def test_mapping_against_full_scoring(spark):
    rng = random.Random(5)
    words = ["enfermera", "ingeniera", "electrica", "software", "turismo", "docente", "datos", "planta", "obra", "derecho", "juridico"]
    jobs = [(" ".join(rng.choices(words, k=2)), " ".join(rng.choices(words, k=4))) for _ in range(12)]
    rows = [(f"Grado en {w.title()}", b, " ".join(rng.choices(words, k=3)) if rng.random() < 0.7 else None)
            for w, b in (("Enfermeria", "Ciencias de la Salud"), ("Ingenieria Electrica", "Ingenieria y Arquitectura"), ("Turismo", "Ciencias Sociales y Juridicas"),
                         ("Derecho", "Ciencias Sociales y Juridicas"), ("Ingenieria Informatica", "Ingenieria y Arquitectura"))]
    df = spark.createDataFrame([(i, t, d) for i, (t, d) in enumerate(jobs)], "id int, title string, description string")
    got = {r.id: (r.target_degree_titles or "").split("|") for r in mapping.map_degrees(df, catalogue(spark, rows), "id", "row_id").collect()}
    for i, wanted in full_scores(jobs, rows).items():
        assert [x for x in got[i] if x] == wanted, jobs[i]


JOB = "job_key string, title string, description string, target_degree_titles string, target_degree_branches string, degree_match_status string"
DEG = "degree_key string, title string, description string, branch string"


def test_pairing(spark):
    text = "x" * 50
    jobs = spark.createDataFrame([
        ("j1", "a", text, "Grado en Psicología", None, "matched"), ("j2", "a", text, "Grado en Psicología", None, "no_rule"),
        ("j3", "short", None, "Grado en Psicología", None, "matched"), ("j4", "a", text, None, "Salud", "matched"), (None, "a", text, "Grado en Turismo", None, "matched"),
    ], JOB)
    degrees = spark.createDataFrame([
        ("d1", "Grado en Psicología", text, "Salud"), ("d2", "Grado en Psicología online", text, "X"), ("d3", "Grado en Psicología - Presencial Duración: 4 años", text, "X"),
        ("d4", "Grado en Turismo", text, "Y"), ("d5", "Grado en Psicología", "short", "Salud"),
    ], DEG)
    got = sorted((r.job_key, r.degree_key) for r in pairing.candidate_pairs(jobs, degrees).collect())
    assert got == [("j1", "d1"), ("j1", "d2"), ("j1", "d3"), ("j4", "d1")]
    assert pairing.candidate_pairs(jobs.limit(0), degrees).count() == 0


def plain_families(title):
    """Family keys as the reference has them."""
    clean = lambda t: " ".join(re.split(pairing.TAIL, t)[0].split())
    norm = plain_norm(title)
    single, double = (re.search(p + r"\bgrado en ([a-z0-9 ]+)", norm) for p in ("", r"\bdoble "))
    keys = {clean(single[1])} if single else set()
    return (keys | {p.strip() for p in re.split(r"\by\b", clean(double[1]))} if double else keys) - {""}


def plain_pairs(jobs, degrees):
    """JN1 to JN4 of every posting row with every degree row."""
    text = lambda r: (r["description"] or r["title"] or "").strip()
    pipes = lambda v: {x.strip() for x in (v or "").split("|")} - {""}
    out = set()
    for j in jobs:
        titles, branches = pipes(j["target_degree_titles"]), pipes(j["target_degree_branches"])
        wanted = {f for t in titles for f in plain_families(t)}
        for d in degrees:
            own = plain_families(d["title"])
            met = d["title"] in titles or own & wanted or (d["branch"] in branches and (not wanted or own & wanted))
            if met and j["degree_match_status"] == "matched" and min(len(text(j)), len(text(d))) >= 40:
                out.add((j["row_id"], d["row_id"]))
    return out


def test_pair_classes_hold_every_pair_of_rows(spark, frame, tmp_path):
    from rowloom.plans import core_queries

    rng = random.Random(11)
    texts = ["a" * 50, "zz short", None, "", "m" * 40, "zz" + " " * 60]
    names = ["Grado en Psicología", "Doble Grado en Psicología y Turismo", "Grado en Turismo online", "Máster en X", None, ""]
    jobs = [{"row_id": k, "title": rng.choice(["t", "t" * 45]), "description": rng.choice(texts), "target_degree_titles": rng.choice([*names, "Grado en Turismo | Máster en X"]),
             "target_degree_branches": rng.choice(["Salud", "Salud|Artes", None, ""]), "degree_match_status": rng.choice(["matched", "matched", "matched", "no_rule"])} for k in range(90)]
    degrees = [{"row_id": k, "title": rng.choice(names), "branch": rng.choice(["Salud", "Artes", None, ""]), "description": rng.choice(texts)} for k in range(70)]
    frame(jobs, "row_id bigint, title string, description string, target_degree_titles string, target_degree_branches string, degree_match_status string").write.parquet(f"{tmp_path}/jobs.parquet")
    frame(degrees, "row_id bigint, title string, branch string, description string").write.parquet(f"{tmp_path}/degrees.parquet")
    members = {}
    for r in core_queries.queries()["candidate_pair_members"](spark, str(tmp_path)).collect():
        members.setdefault((r.tbl, r.class_key), []).append(r.row_id)
    got = []
    for r in core_queries.queries()["candidate_pair_classes"](spark, str(tmp_path)).collect():
        left, right = members["jobs", r.job_key], members["degrees", r.degree_key]
        assert (r.n_jobs, r.n_degrees) == (len(left), len(right))
        got += [(a, b) for a in left for b in right]
    assert len(got) == len(set(got)) and set(got) == plain_pairs(jobs, degrees) and got


def test_families(spark):
    df = spark.createDataFrame([("Doble Grado en Psicología y Criminología",), ("Máster en X",), (None,)], "t string")
    got = [r.k for r in df.select(pairing.family_keys(F.col("t")).alias("k")).collect()]
    assert set(got[0]) == {"psicologia y criminologia", "psicologia", "criminologia"} and got[1] == [] and got[2] == []


def test_vectors(spark):
    texts = vectors.distinct_texts(spark.createDataFrame([("a b",), ("a  b",), ("c",), (None,), (" ",)], "t string"), "t")
    assert texts.count() == 2
    empty = spark.createDataFrame([], "cache_key string, vector array<double>")
    embed = vectors.hashing_provider(8)
    made, entries = vectors.embed_with_cache(texts, empty, "hashing", "m", embed)
    assert made.count() == 2 and entries.count() == 2
    hits, misses = vectors.split_cache(texts, entries, "hashing", "m")
    assert hits.count() == 2 and misses.count() == 0
    assert vectors.split_cache(texts, entries, "hashing", "other")[1].count() == 2
    pairs = spark.createDataFrame([("j", "d", "a b", "a b"), ("j", "e", "a b", "zzz")], "job_key string, degree_key string, job_text string, degree_text string")
    scored = vectors.pair_similarity(pairs, made).collect()
    assert [(r.degree_key, round(r.score, 9)) for r in scored] == [("d", 1.0)]
    with pytest.raises(ValueError):
        vectors.provider_named("nobody")
    m = vectors.manifest(pairs, vectors.chunk_rows(pairs.withColumn("i", F.lit(1)), "i", "job_text"), 1, 2).first()
    assert (m["items"], m.chunks, m.tokens, m.hits, m.misses) == (2, 2, 2, 1, 2)


def test_analytics(spark):
    df = spark.createDataFrame([("j1", "publica", 0.9, "a"), ("j1", "privada", 0.5, "b"), ("j2", "Privada ", 0.7, "c"), ("j3", "otra", 1.0, "d")], "k string, s string, v double, o string")
    inside = analytics.in_sectors(df, "s")
    best = analytics.best_per_sector(inside, "k", "s", "v")
    assert sorted(map(tuple, best.collect())) == [("j1", 0.9, 0.5), ("j2", None, 0.7)]
    assert round(analytics.sector_gaps(best, "k").first().gap, 9) == 0.4
    metrics = {r.metric: r.value for r in analytics.key_metrics(best).collect()}
    assert metrics["keys"] == 2 and metrics["with_both"] == 1
    assert analytics.composition(inside, F.lit(""), "s").first().total == 3
    assert analytics.quantiles(df, ["s"], "v", [0.5]).count() == 4
    many = spark.range(400).select(F.lit("g").alias("g"), (F.col("id") % 10).cast("double").alias("v"), F.col("id").cast("string").alias("o"))
    r = analytics.bootstrap_mean(many, "g", "v", "o", draws=400).first()
    assert r.n == 400 and abs(r["mean"] - 4.5) < 1e-9 and abs((r.high - r.low) / 2 - 1.96 * 2.8722 / 20) < 0.06
    assert analytics.bootstrap_mean(many.limit(0), "g", "v", "o", draws=5).count() == 0


def test_bootstrap_draws_and_repeated_rows(spark, monkeypatch):
    from rowloom.plans import core_queries

    rows = spark.range(400).select(F.lit("g").alias("g"), (F.col("id") % 10).cast("double").alias("v"), F.lit("same").alias("o"))
    r = analytics.bootstrap_mean(rows, "g", "v", "o", draws=2000).first()
    # With one key for all rows the bounds are still those of 400 rows.
    assert abs((r.high - r.low) / 2 - 1.96 * 2.8722 / 20) < 0.03
    one = analytics.bootstrap_mean(rows.limit(1), "g", "v", "o", draws=50).first()
    assert one.low == one.high == one["mean"]
    asked = []
    monkeypatch.setattr(analytics, "bootstrap_mean", lambda *a, draws=5000, **k: asked.append(draws))
    monkeypatch.setattr(core_queries, "_facts", lambda *a: (None, None))
    core_queries.queries()["bootstrap_ci"](spark, "")
    assert asked == [5000]


def registry(spark):
    return spark.createDataFrame([("u1", "Universidad Á", "publica", "u. a|ua"), ("u2", "Universidad B", "privada", None)],
                                 "university_id string, canonical_name string, university_type string, aliases string")


def test_catalogue(spark):
    doc = spark.createDataFrame([([("1", "Universidad a", "Grado en X", 240)], [("2", "U. A", "GRADO EN X", 180), ("3", "Nadie", "Grado en Y", 240)])],
                                "aneca array<struct<id:string,universidad:string,titulo:string,credits:int>>, ruct array<struct<id:string,university:string,title:string,credits:int>>")
    parts = catalog.payload_arrays(doc, ["aneca", "ruct", "none"])
    rows = catalog.payload_records(parts["aneca"], "aneca", F.lit("t")).unionByName(catalog.payload_records(parts["ruct"], "ruct", F.lit("t")))
    rows = catalog.attach_registry(rows, registry(spark))
    assert {(r.source_id, r.university_id) for r in rows.collect()} == {("1", "u1"), ("2", "u1"), ("3", None)}
    kept = catalog.last_per_title(rows.withColumn("o", F.col("source_id").cast("int")), F.col("o"))
    assert [r.source_id for r in kept.collect()] == ["3", "2"]
    filled = catalog.description_fields(kept.drop("o"))
    assert {r.description_status for r in filled.collect()} == {"missing"}
    report = catalog.description_coverage(filled).first()
    assert (report.total, report.described, report.ratio) == (2, 0, 0.0)
    assert catalog.description_coverage(filled.limit(0)).first().total == 0


def test_completeness_and_gates(spark):
    rows = spark.createDataFrame([("u1", "grado"), ("u1", "master"), ("u2", "grado")], "university_id string, title_type string")
    r = catalog.inventory_completeness(rows, registry(spark)).first()
    assert r.university_ratio == 1.0 and round(r.type_ratio, 6) == round(2 / 3, 6) and len(r.missing_pairs) == 3 and r.missing_types == ["doctorado"]
    report = catalog.inventory_completeness(rows, registry(spark))
    assert catalog.gate(report, "pair_ratio", None)[0] and catalog.gate(report, "pair_ratio", 0.5)[0] and not catalog.gate(report, "pair_ratio", 0.6)[0]


def test_links_and_reports(spark):
    reports = spark.createDataFrame([("k", "u1", "2019"), ("k", "u2", "2021"), ("k", "u3", None)], "k string, url string, year string")
    assert catalog.preferred_report(reports, "k").first().url == "u2"
    cands = spark.createDataFrame([("Grado X", "grado", "http://a/x.pdf", ["1"], 1), ("GRADO X", "grado", "http://a/x", [], 2), ("Grado X", "grado", "http://a/y", [], 3)],
                                  "title string, title_type string, source_url string, evidence_urls array<string>, position int")
    assert catalog.best_programme(cands, "position").first().source_url == "http://a/x"
    degrees = spark.createDataFrame([("u1", "T", None), ("u1", "S", "http://uni/m.pdf"), ("u9", "T", "http://aneca/x"), ("u1", "Q", None)], "university_id string, title string, memory_url string")
    found = spark.createDataFrame([("u1", "T", "http://m")], "university_id string, title string, memory_url string")
    got = {(r.university_id, r.title): (r.memory_resolution_status, r.memory_url) for r in catalog.memory_resolution(degrees, found, ["u1"]).collect()}
    assert got == {("u1", "T"): ("resolved", "http://m"), ("u1", "S"): ("already_present", "http://uni/m.pdf"), ("u9", "T"): ("unresolved", "http://aneca/x"), ("u1", "Q"): ("unresolved", None)}


def test_accents_cover_latin(spark):
    assert spark.range(1).select(strip_accents(F.lit("ÀÉÎõüñçŠž é"))).first()[0] == "AEIounc" + "Sz e"
