"""Residue, cut texts and fusion."""

import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from rowloom.llm.cut import artificial_cuts, cut_rows, fit_cut_model, last_segment, length_limits, score_cuts, source_shares, split_mark
from rowloom.llm.fuse import Bundle, Dependency, fuse_groups, search
from rowloom.llm.residue import ERRORS, FILLER, NOTICES, any_of, find_residue

REAL = "Se encargará de revisar los partes diarios. Valoramos depuración de errores 404 y 500, programación en JavaScript y plantillas de correo con campos variables."
SCHEMA = "id bigint, title string, description string, url string, host string, reason string"


def found(spark, *texts, title="Cajera", url="https://h/oferta/1/"):
    rows = [(k, title, t, url, "x", "y") for k, t in enumerate(texts)]
    got = find_residue(spark.createDataFrame(rows, SCHEMA), "id", ["title", "description"], "title", "url").collect()
    return {(texts[r.id] if r.field == "description" else r.field): r.reason for r in got}


def test_detectors(spark):
    bad = [
        "Hola, {{ contacto }}: te esperamos", "En [INSERTAR ciudad] buscamos", "${EMPRESA} x", "Contacte con ______ antes de enero.", "La empresa TODO ofrece una vacante.",
        "%(titulo)s en <ciudad>.", "Lorem ipsum dolor sit", "Consectetur aliqua sit sit dolor minim nostrud", "prueba test asdf", "Texto de prueba!!", "HTTP 403: Acceso denegado.",
        "Error 410 - La oferta ya no está disponible en esta dirección", REAL + " Página no encontrada (404). Vuelva a la página de inicio.", "Activa JavaScript en tu navegador",
        "Verifica que eres una persona para continuar", "Traceback (most recent call last): x", "[object Object]", "Hola, undefined: ven", "x" * 20000 + " {{a}}",
    ]
    good = [REAL, REAL.upper(), "PRÁCTICAS PARA TODO EL MUNDO", "Camarero [Ref. 2605]", "100% presencial y 50% de descuento", "", None, "Un <b>buen</b> puesto", "- Inglés B2\n- Carné B", "¿A qué esperas...?"]
    got = found(spark, *bad, *good)
    assert set(bad) <= set(got) and not set(good) & set(got)


def test_a_word_is_compared_once_with_what_many_patterns_begin_with():
    """Nothing is tried twice at a word, and the tree finds what the single patterns find."""
    assert any_of(["abc d", "abx?", "(?:abc|d) f", "[45]00"]) == r"\b(?=[45ad])(?:ab(?:c (?:d|f)|x?)|d f|400|500)"
    assert any_of(["ab", "abc", r"a\b", "a+"]) == r"\b(?=[a])(?:a(?:b|\b)|a+)"
    patterns = [*NOTICES, *ERRORS, *FILLER]
    each, tree = [re.compile(r"\b(?:" + p + ")") for p in patterns], re.compile(any_of(patterns))
    texts = [
        "activa javascript", "active el javascript", "mi sesión caducada", "mi sesion ha caducad", "http/1.1 503 x", "410 la oferta", "50). ", "(404). ", "500). ", "h1>404</h1", "xh1>404</h1",
        "título aquí", "titulo del puesto aqui", "java.io.ioexception", "org.x.error", "test foo, bar", "test", "testfoo bar", "ut, et ea ex do.", "ut et ea ex", "ut et ea exdo", "dolor dolore do ut sed",
        "aceptar todo·rechazar", "aceptar todo - rechazar", "desactiva javascript", "servicio no disponible", "descripcion de ejemplo", "un momento por favor", "no eres robot", "insert your name here",
    ]
    assert [bool(tree.search(t)) for t in texts] == [any(p.search(t) for p in each) for t in texts]


def test_titles_and_empty(spark):
    assert found(spark, REAL, title="Oferta de [[titulo]]") == {"title": "placeholder"}
    df = spark.createDataFrame([], SCHEMA)
    assert find_residue(df, "id", ["title", "description"], "title", "url").count() == 0


def test_host_evidence(spark):
    """A message no detector knows, served under several titles, and one that is known wording."""
    rows = [(k, f"Titulo {w}", f"Vuelva dentro de unos instantes, operacion {k}{k}1 aplazada", f"https://h/{k}", "", "") for k, w in enumerate("abcd")]
    words = "cocina sala turno equipo cliente almacén pedido reparto hotel limpieza".split()
    rng = random.Random(4)
    rows += [(100 + k, "Cocinera", " ".join(rng.choices(words, k=60)), "https://h/z", "", "") for k in range(50)]
    rows += [(200 + k, f"Titulo {w}", "equipo turno sala cliente", "https://h/z", "", "") for k, w in enumerate("abcd")]
    got = find_residue(spark.createDataFrame(rows, SCHEMA), "id", ["title", "description"], "title", "url").collect()
    assert {(r.id, r.reason) for r in got} == {(k, "host") for k in range(4)}


def test_long_page_of_a_host(spark):
    """A response of any length that no list knows, with identifiers that differ, under two titles."""
    page = "Regrese luego, por favor: nuestras colas procesan peticiones acumuladas desde anoche. Referencia {0}. " * 9
    rows = [(k, f"Titulo {w}", page.format(f"a{k}f{k}"), f"https://h/{k}", "", "") for k, w in enumerate("ab")]
    rows += [(k + 10, "Titulo a", page.format(k) + " Otra.", "https://h/9", "", "") for k in range(2)]
    rng = random.Random(4)
    rows += [(100 + k, "Cocinera", " ".join(rng.choices("cocina sala turno equipo cliente pedido".split(), k=90)), "https://h/z", "", "") for k in range(200)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert len(page) > 800
    got = find_residue(df, "id", ["title", "description"], "title", "url").collect()
    assert {(r.id, r.reason) for r in got} == {(0, "host"), (1, "host")}
    asked = find_residue(df, "id", ["description"], "title", "url", df.where("id in (1, 100)").select("id")).collect()
    assert {(r.id, r.reason) for r in asked} == {(1, "host")}


def test_all_limits_of_a_source(spark):
    """Seven lengths at which texts of one source pile up, among texts of all lengths."""
    rng, at = random.Random(3), [200, 300, 400, 500, 600, 700, 800]
    rows = [("s", "x", n, k * 1000 + j) for k, n in enumerate(at) for j in range(14)]
    rows += [("s", "x", rng.randint(100, 2000), 10**6 + k) for k in range(1500)]
    df = spark.createDataFrame(rows, "__source string, __tail string, __len int, __hash bigint")
    got = length_limits(df).collect()
    assert [r[0] for r in got] == ["s"] and got[0][1] == at
    many = df.withColumn("__source", F.concat("__source", (F.col("__hash") % 3).cast("string")))
    assert length_limits(many).count() <= 3 and length_limits(df.limit(0)).count() == 0


def test_copies_count_once_in_the_sample(spark):
    """A text that most rows share changes nothing in what is learned."""
    texts = sentences(60, 5)
    rows = [(k, t, "s") for k, t in enumerate(texts)]
    models = [
        fit_cut_model(cut_rows(spark.createDataFrame(x, "id bigint, d string, source string"), "id", "d", "source"), train_rows=100)
        for x in (rows, rows + [(1000 + k, texts[0], "s") for k in range(3000)])
    ]
    assert models[0].weights.any() and (models[0].weights == models[1].weights).all()


def sentences(n, seed):
    rng = random.Random(seed)
    subjects = ["El equipo", "La persona elegida", "Nuestro centro", "La jornada", "El puesto"]
    verbs = ["necesita", "incluye", "ofrece", "prepara", "revisa"]
    things = ["plan de carrera", "horario flexible", "partes diarios", "rutas de entrega", "informes mensuales", "atención al detalle"]
    return [" ".join(f"{rng.choice(subjects)} {rng.choice(verbs)} {rng.choice(things)} y {rng.choice(things)}." for _ in range(rng.randint(3, 6))) for _ in range(n)]


def test_cut_model_on_held_out_texts(spark):
    ends = ["Jornada completa", "Plazas: 12", "- Carné B", ""]
    whole = [t + ("\n" + e if e else "") for t, e in zip(sentences(900, 1), itertools.cycle(ends))]
    cut = [t for _, t in artificial_cuts(sentences(120, 2), seed=9)]
    train = spark.createDataFrame([(k, t, "s") for k, t in enumerate(whole)], "id bigint, d string, source string")
    model = fit_cut_model(cut_rows(train, "id", "d", "source"))
    test = [(k, t, "s") for k, t in enumerate([t + "\n" + e for t, e in zip(sentences(120, 3), itertools.cycle(ends[:3]))] + cut)]
    scored = {r.id: r.score for r in score_cuts(spark.createDataFrame(test, "id bigint, d string, source string"), "id", "d", "source", model).collect()}
    assert sum(scored[k] >= 0.5 for k in range(120)) <= 2
    assert sum(scored[k] >= 0.5 for k in range(120, 120 + len(cut))) >= 0.97 * len(cut)


def test_cut_edges(spark):
    schema = "id bigint, d string, source string, score string"
    df = spark.createDataFrame([(1, None, "s", ""), (2, " ", "s", ""), (3, "x" * 50000, None, ""), (3, "x" * 50000, None, "")], schema)
    model = fit_cut_model(cut_rows(df, "id", "d", "source"))
    assert [r.id for r in score_cuts(df, "id", "d", "source", model).collect()] == [3, 3]
    none = fit_cut_model(cut_rows(df.limit(0), "id", "d", "source"))
    assert score_cuts(df.limit(0), "id", "d", "source", none).count() == 0
    assert split_mark("los pedidos del... Leer más")[0] == "los pedidos del" and split_mark("fin.") == ("fin.", "")
    assert last_segment("Uno. Plazas: 12") == "plazas: 9"
    scored = spark.createDataFrame([(1, "a", 0.9), (2, "a", 0.1)], "id bigint, source string, score double")
    assert tuple(source_shares(scored, scored.where("score > 0.5"), ["id"]).first()) == ("a", 2, 1, 0.5)


# --- fusion ---------------------------------------------------------------------------------


def test_survivors(spark):
    rows = [("k", 1, 10, 5.0, "a", "b"), ("k", 2, 20, None, "a", "b"), ("k", 3, 20, 7.0, "a", "b"), ("one", 4, 1, 1.0, "a", "b"), (None, 5, 1, 1.0, "a", "b"), (None, 6, 1, 1.0, "a", "b"), ("n", 7, None, None, "", ""), ("n", 8, None, None, "", "")]
    df = spark.createDataFrame(rows, "k string, id bigint, seen bigint, v double, best string, __n string")
    seen = F.coalesce("seen", F.lit(0))
    bundles = [Bundle("last", F.lit(True), [seen, -F.col("id")]), Bundle("value", F.col("v").isNotNull(), [F.col("v"), -F.col("id")])]
    got = {r.k: (r.last_id, r.value_id) for r in fuse_groups(df, "k", "id", bundles).collect()}
    assert got == {"k": (2, 3), "n": (7, 0)}
    assert fuse_groups(df.limit(0), "k", "id", bundles).count() == 0


def test_dependencies_choose_the_best_allowed_combination(spark):
    rows = [("g", 1, 3, "tenerife", 1, "lp"), ("g", 2, 2, "lanzarote", 2, "sc"), ("g", 3, 1, "lanzarote", 3, "lp"), ("g", 9, 0, None, 0, None)]
    rows += [(f"o{k}", 10 + k, 1, "tenerife", 1, "sc") for k in range(5)] + [(f"p{k}", 30 + k, 1, "lanzarote", 1, "lp") for k in range(5)]
    df = spark.createDataFrame(rows, "k string, id bigint, tp int, island string, tq int, prov string")
    bundles = [Bundle("place", F.col("island").isNotNull(), [F.col("tp"), -F.col("id")], {"island": F.col("island")}),
               Bundle("region", F.col("prov").isNotNull(), [F.col("tq"), -F.col("id")], {"prov": F.col("prov")})]
    got = {r.k: (r.place_id, r.region_id) for r in fuse_groups(df, "k", "id", bundles, [Dependency("island", "prov")]).collect()}
    assert got == {"g": (1, 2)} or got == {"g": (2, 3)}
    assert fuse_groups(df, "k", "id", bundles).first()[1:] == (1, 3)


def test_search_against_all_combinations():
    rng = random.Random(6)
    for _ in range(200):
        cands = {}
        for b, sig in (("a", "x"), ("b", "y"), ("c", "z")):
            cs = [(rng.randint(1, 9), f"{b}{k}", {sig: rng.choice(["p", "q", None])}) for k in range(rng.randint(1, 4))]
            cands[b] = sorted(cs, key=lambda c: -c[0])
        allowed = {("x", "y"): {"p": "p", "q": "q"}, ("y", "z"): {"p": "q"}}

        def ok(combo):
            v = {n: x for c in combo for n, x in c[2].items()}
            return all(v.get(a) is None or v.get(b) is None or known.get(v[a], v[b]) == v[b] for (a, b), known in allowed.items())

        # Every bundle may stay empty, which counts 0.
        options = [[*c, (0, None, {})] for c in cands.values()]
        best = max(sum(c[0] for c in combo) for combo in itertools.product(*options) if ok(combo))
        got = search(cands, allowed)
        chosen = [next(c for c in cands[b] if c[1] == got[b]) for b in cands if b in got]
        assert ok(chosen) and sum(c[0] for c in chosen) == best


def test_search_leaves_out_what_nothing_allows():
    """Two bundles that contradict each other whatever is taken: the one with less trust stays empty."""
    cands = {"a": [(1.0, "a1", {"x": "p"})], "b": [(0.6, "b1", {"y": "q"}), (0.5, "b2", {"y": "r"})]}
    assert search(cands, {("x", "y"): {"p": "p"}}) == {"a": "a1"}


@pytest.mark.parametrize("n", [0, 1])
def test_search_small(n):
    assert search({"a": [(1.0, "i", {})][:n]}, {}) == ({"a": "i"} if n else {})
