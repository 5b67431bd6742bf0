"""Mapping to canonical entries and top-n, against plain versions and on edge cases."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rowloom.llm.canonical import THRESHOLD, map_to_canonical, similarity_join, token_rows
from rowloom.llm.topn import top_n_per_group

CANON = [
    (1, "municipality", "Puerto Alisio", "Alisio Viejo", "Gran Canaria", "Las Palmas"), (2, "municipality", "El Sauzalillo", None, "Tenerife", "Santa Cruz de Tenerife"),
    (3, "municipality", "Santa Cruzada del Risco", "", "La Palma", "Santa Cruz de Tenerife"), (4, "municipality", "Agüeral del Norte", None, "Gran Canaria", "Las Palmas"),
    (5, "municipality", "Agüeral del Sur", None, "Gran Canaria", "Las Palmas"), (11, "province", "Las Palmas", "LPGC|Provincia de Las Palmas", None, None),
    (12, "province", "Santa Cruz de Tenerife", "S/C de Tenerife|Tenerife", None, None), (21, "contract_type", "indefinido", "fijo|contrato fijo", None, None),
    (22, "contract_type", "temporal", "eventual|sustitución", None, None), (23, "contract_type", "fijo_discontinuo", "fijo discontinuo", None, None), (24, "contract_type", "autonomo", "contractor", None, None),
]
SCHEMA = "canon_id bigint, kind string, canon_value string, aliases string, island string, province string"
FIELDS = {"town": "municipality", "prov": "province", "kind": "contract_type"}


def mapped(spark, field, *values):
    kind = {**FIELDS, "kind": "contract_type"}[field]
    df = spark.createDataFrame([(k, v, "x", 1.0) for k, v in enumerate(values)], f"id bigint, {field} string, value string, canon_id double")
    got = map_to_canonical(df, "id", {field: kind}, spark.createDataFrame(CANON, SCHEMA)).collect()
    return {values[r.id]: r.canon_id for r in got}


def test_places(spark):
    wanted = {
        "PTO. ALISIO": 1, "Sauzalillo, El": 2, "el sauzalilo (Tenerife)": 2, "c/ Del Mar 3, 38444 Puerto Alsiio": 1, "GRAN CANARIA - AGUERAL DEL SUR": 5,
        "Las Palmas > Gran Canaria > AgÃ¼eral del Norte": 4, "Santa Cruz de Tenerife": 0, "Gran Canaria": 0, "Tenerife": 0, "Zarzosa la Mayor": 0,
        "Remoto": 0, "": 0, " - ": 0, "x" * 3000: 0, "Alisio Viejo, Islas Canarias, ES": 1,
    }
    assert mapped(spark, "town", *wanted) == wanted


def test_provinces_and_contracts(spark):
    wanted = {"Palmas (Las)": 11, "S/C-de-Teenrife": 12, "Provnicia de Las Palmas": 11, "Otra provincia": 0, "tenerife": 12, "N/D": 0}
    assert mapped(spark, "prov", *wanted) == wanted
    wanted = {
        "Fijo, 6 meses": 21, "contrtao fijo": 21, "Temporal con posible paso a indefinido": 22, "Sustitución de personal fijo": 22, "fijo-dsicontinuo": 23,
        "Contrato fijo_discontinuo": 23, "indefinido, no temporal": 21, "Media jornada": 0, "Tipo: CONTRACTOR + incentivos": 24, "Consultar": 0,
    }
    assert mapped(spark, "kind", *wanted) == wanted


def test_exact_values_nulls_and_repetitions(spark):
    assert mapped(spark, "town", "Puerto Alisio", None) == {}
    df = spark.createDataFrame([(7, "pto alisio"), (7, "pto alisio")], "id bigint, town string")
    canon = spark.createDataFrame(CANON, SCHEMA)
    assert [r.canon_id for r in map_to_canonical(df, "id", {"town": "municipality"}, canon).collect()] == [1, 1]
    assert map_to_canonical(df.limit(0), "id", {"town": "municipality"}, canon).count() == 0
    assert [r.canon_id for r in map_to_canonical(df, "id", {"town": "municipality"}, canon.limit(0)).collect()] == [0, 0]


def test_join_against_all_pairs(spark):
    rng = random.Random(1)
    words = ["alisio", "alisto", "puerto", "puerta", "norte", "sur", "risco", "rico", "verde"]
    texts = sorted({" ".join(rng.choices(words, k=rng.randint(1, 3))) for _ in range(60)})
    left = spark.createDataFrame([("k", t) for t in texts[:40]], "kind string, text string")
    right = spark.createDataFrame([("k", t, k) for k, t in enumerate(texts[20:])], "kind string, text string, canon_id bigint")
    sets = {}
    for r in token_rows(left.unionByName(right.select("kind", "text")).distinct()).collect():
        sets.setdefault(r.text, set()).add(r.token)
    jac = lambda a, b: len(sets[a] & sets[b]) / len(sets[a] | sets[b])
    wanted = {(a, k): jac(a, b) for a in texts[:40] for k, b in enumerate(texts[20:]) if jac(a, b) >= THRESHOLD}
    got = {(r.text, r.canon_id): r.sim for r in similarity_join(left, right).collect()}
    assert got.keys() == wanted.keys() and all(abs(got[k] - wanted[k]) < 1e-9 for k in got)


def test_top_n_against_sorting(spark):
    rng = random.Random(2)
    rows = [("hot" if rng.random() < 0.4 else f"g{rng.randint(0, 20)}", f"i{rng.randint(0, 60)}", rng.choice([0.1, 0.5, 0.5, 0.9, None, float("nan")])) for _ in range(3000)]
    rows += [(None, "i", 1.0), ("g", None, 1.0), ("only", "i", None)]
    df = spark.createDataFrame([(*r, "x", 3) for r in rows], "g string, i string, s double, rank string, __s int")
    best = {}
    for g, i, s in rows:
        if g and i and s is not None and s == s:
            best.setdefault(g, Counter())[i] = max(best.get(g, {}).get(i, s), s)
    wanted = {(g, i, s, k + 1) for g, items in best.items() for k, (i, s) in enumerate(sorted(items.items(), key=lambda x: (-x[1], x[0]))[:5])}
    assert {tuple(r) for r in top_n_per_group(df, "g", "i", "s").collect()} == wanted
    assert top_n_per_group(df.limit(0), "g", "i", "s").count() == 0
    with pytest.raises(ValueError):
        top_n_per_group(df, "g", "i", "s", 0)


def test_top_n_is_pruned_before_the_shuffle(spark):
    df = spark.createDataFrame([("g", "i", 1.0)], "g string, i string, s double")
    plan = top_n_per_group(df, "g", "i", "s")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
