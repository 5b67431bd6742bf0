"""State tables, cycles, streams, feeds and flows."""

import json
import os

from pyspark.sql import functions as F

from rowloom.operators import state
from rowloom.operators.state import StateTable
from rowloom.plans import flows
from rowloom.sources import feed, records, tables
from rowloom.streaming import cycles

PAIR = "pair_key string, job_key string, degree_key string, score double, provider string, model string, created_at string, updated_at string"
CACHE = "cache_key string, text_hash string, provider string, model string, vector array<double>, vector_dim int, created_at string, updated_at string"


def posting(spark, *rows):
    base = dict.fromkeys(records.JOB_COLUMNS)
    full = [tuple((base | {"source": "x", "scraped_at": "2024-01-01"} | r).values()) for r in rows]
    return spark.createDataFrame(full, records.JOB_SCHEMA)


def test_two_cycles(spark, tmp_path):
    table = StateTable(spark, str(tmp_path / "jobs"), records.STATE_SCHEMA)
    one = {"external_id": "1", "title": "v1", "source_url": "http://a/1"}
    two = {"external_id": "2", "title": "v1", "source_url": "http://a/2"}
    assert cycles.run_cycle(posting(spark, one, two), table, "t1") == {"inserted": 2, "updated": 0, "unchanged": 0}
    assert cycles.run_cycle(posting(spark, one | {"title": "v2"}, two), table, "t2") == {"inserted": 0, "updated": 1, "unchanged": 1}
    rows = {r.source_url: r for r in table.read().collect()}
    assert rows["http://a/1"].title == "v2" and rows["http://a/1"].first_seen_at == "t1" and rows["http://a/1"].updated_at == "t2"
    assert rows["http://a/2"].last_seen_at == "t2" and rows["http://a/2"].updated_at == "t1"
    assert cycles.run_cycle(posting(spark, one).limit(0), table, "t3") == {"inserted": 0, "updated": 0, "unchanged": 0}
    assert table.versions() == [1, 2]
    table.forget(1)
    assert table.versions() == [2] and table.read().count() == 2


def test_secondary_key_and_order_in_batch(spark, tmp_path):
    table = StateTable(spark, str(tmp_path / "jobs"), records.STATE_SCHEMA)
    same = {"title": "T", "company": "C", "publication_date": "2024-01-01", "raw_location": "L"}
    cycles.run_cycle(posting(spark, same | {"source_url": "http://a/1"}), table, "t1")
    got = cycles.run_cycle(posting(spark, same | {"source_url": "http://a/2"}), table, "t2")
    assert got["updated"] == 1 and table.read().count() == 1 and table.read().first().first_seen_at == "t1"
    both = posting(spark, {"source_url": "u", "title": "old", "scraped_at": "1"}, {"source_url": "u", "title": "new", "scraped_at": "2"}, {"title": None})
    assert cycles.run_cycle(both, table, "t3")["inserted"] == 1
    assert "new" in [r.title for r in table.read().collect()]
    assert cycles.rejected(posting(spark, {"source": None})).count() == 1


STORED = "job_key string, secondary_key string, payload_hash string, first_seen_at string, last_seen_at string, updated_at string"


def test_upsert_merges_all_matches(spark, tmp_path):
    """Both stored rows that an incoming row means make place for it; a row seen again is only touched."""
    stored = [("k1", None, "h1", "t0", "t1", "t1"), ("k2", "s", "h2", "t1", "t2", "t2"), ("k3", "u", "h3", "t0", "t0", "t0"), ("k4", None, "h4", "t0", "t0", "t0")]
    old = spark.createDataFrame(stored, STORED)
    batch = spark.createDataFrame([("k1", "s", "h9", "1"), ("k9", "u", "h3", "2"), ("k5", None, "h5", "3"), (None, "s", "h", "4")], "job_key string, secondary_key string, payload_hash string, __ordinal string")
    new, counts = state.upsert(batch, old, F.lit("t5"))
    wanted = [("k1", "s", "h9", "t0", "t5", "t5"), ("k3", "u", "h3", "t0", "t5", "t0"), ("k4", None, "h4", "t0", "t0", "t0"), ("k5", None, "h5", "t5", "t5", "t5")]
    assert sorted(map(tuple, new.collect())) == wanted and {r.action: r.n for r in counts.collect()} == {"updated": 1, "unchanged": 1, "inserted": 1}
    table = state.StateTable(spark, str(tmp_path / "s"), STORED, buckets=5)
    table.write(old)
    table.merge(*state.changes(state.upsert_actions(batch, table.read()), table.read(), F.lit("t5")))
    assert sorted(map(tuple, table.read().collect())) == wanted
    assert new.groupBy("job_key").count().where("count > 1").isEmpty()


def test_sighting_of_a_replaced_row(spark):
    """k2 is both replaced (by the row with its key) and seen again (by secondary key): no key comes twice."""
    old = spark.createDataFrame([("k1", "s1", "h1", "t0", "t3", "t3"), ("k2", "s2", "h2", "t1", "t1", "t1")], STORED)
    batch = spark.createDataFrame([("k2", "s1", "h7", "1"), ("k3", "s2", "h2", "2")], "job_key string, secondary_key string, payload_hash string, __ordinal string")
    new = state.upsert(batch, old, F.lit("t5"))[0]
    assert sorted(map(tuple, new.collect())) == [("k2", "s1", "h7", "t0", "t5", "t5")]


def test_only_touched_buckets_are_written(spark, tmp_path):
    table = state.StateTable(spark, str(tmp_path / "s"), STORED, buckets=16)
    rows = [(f"k{k}", None, "h", "t", "t", "t") for k in range(200)]
    table.write(spark.createDataFrame(rows, STORED))
    before = table._manifest(1)["folders"]
    table.merge(spark.createDataFrame([("k7", None, "h2", "t", "u", "u")], STORED), spark.createDataFrame([("k7",)], "job_key string"))
    after = table._manifest(2)["folders"]
    assert len([b for b in after if after[b] != before.get(b)]) == 1 and table.read().count() == 200
    assert [r.payload_hash for r in table.read().where("job_key = 'k7'").collect()] == ["h2"]
    table.forget(1)
    assert table.versions() == [2] and table.read().count() == 200


def test_compact(spark):
    rows = [("a", "s", "2024-02-01"), ("a", "s", "2024-03-01"), ("b", "s", "2024-01-01"), ("c", None, None)]
    df = spark.createDataFrame([(k, s, u, None, u, "h") for k, s, u in rows], "job_key string, secondary_key string, update_date string, publication_date string, updated_at string, payload_hash string")
    assert sorted((r.job_key, r.update_date) for r in state.compact(df).collect()) == [("a", "2024-03-01"), ("c", None)]


def test_pairs_and_cache(spark):
    old = spark.createDataFrame([("p1", "j", "d", 0.1, "x", "m", "t0", "t0"), ("p2", "j", "e", 0.2, "x", "m", "t0", "t0"), ("p3", "j", "f", 0.2, "y", "m", "t0", "t0")], PAIR)
    new = spark.createDataFrame([("p1", "j", "d", 0.9, "x", "m", None, None), ("p4", "k", "d", 0.3, "x", "m", None, None)], PAIR)
    merged, counts = state.upsert_pairs(new, old, F.lit("t1"))
    assert {r.action: r.n for r in counts.collect()} == {"inserted": 1, "updated": 1}
    got = {r.pair_key: (r.score, r.created_at, r.updated_at) for r in merged.collect()}
    assert got["p1"] == (0.9, "t0", "t1") and got["p4"] == (0.3, "t1", "t1") and len(got) == 4
    assert [r.pair_key for r in state.stale_pairs(merged, new, "x", "m").collect()] == ["p2"]
    assert sorted(r.pair_key for r in state.drop_stale_pairs(merged, new, "x", "m").collect()) == ["p1", "p3", "p4"]
    cache = spark.createDataFrame([("k", "h", "x", "m", [0.0], 1, "t0", "t0")], CACHE)
    fresh = spark.createDataFrame([("k", "h", "x", "m", [1.0], 1), ("l", "i", "x", "m", [2.0], 1)], "cache_key string, text_hash string, provider string, model string, vector array<double>, vector_dim int")
    got = {r.cache_key: (r.vector, r.created_at) for r in state.upsert_cache(cache, fresh, F.lit("t1")).collect()}
    assert got == {"k": ([1.0], "t0"), "l": ([2.0], "t1")}


def test_stream_of_files_is_the_batch(spark, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()
    for k in range(3):
        rows = [{"source": "x", "title": f"t{k}", "source_url": f"http://a/{j}", "scraped_at": str(k)} for j in range(k + 2)]
        (landing / f"{k}.json").write_text("\n".join(map(json.dumps, rows)))
        os.utime(landing / f"{k}.json", (1_700_000_000 + k, 1_700_000_000 + k))
    table = StateTable(spark, str(tmp_path / "jobs"), records.STATE_SCHEMA)
    schema = ", ".join(f"{c} string" for c in records.JOB_COLUMNS)
    calls = []
    stream = cycles.read_landing(spark, str(landing), schema, 1)
    cycles.start_cycles(stream, table, str(tmp_path / "cp"), stagnation=1, on_stagnation=calls.append).awaitTermination(120)
    assert sorted((r.source_url, r.title) for r in table.read().collect()) == [(f"http://a/{j}", "t2") for j in range(4)]
    (landing / "9.json").write_text((landing / "2.json").read_text())
    cycles.start_cycles(cycles.read_landing(spark, str(landing), schema, 1), table, str(tmp_path / "cp"), stagnation=1, on_stagnation=calls.append).awaitTermination(120)
    assert calls == [1]


def test_windows_in_a_stream(spark, tmp_path):
    (tmp_path / "ev").mkdir()
    spark.createDataFrame([("2024-01-01 00:10:00", "a"), ("2024-01-01 00:50:00", "a"), ("2024-01-01 01:10:00", "b")], "ts string, k string").select(
        F.col("ts").cast("timestamp").alias("ts"), "k"
    ).write.mode("overwrite").parquet(str(tmp_path / "ev"))
    batch = cycles.windowed_counts(spark.read.parquet(str(tmp_path / "ev")), "ts", "k", "1 hour")
    stream = cycles.windowed_counts(spark.readStream.schema("ts timestamp, k string").parquet(str(tmp_path / "ev")), "ts", "k", "1 hour", late="1 hour")
    q = stream.writeStream.format("memory").queryName("w").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted(map(tuple, spark.table("w").collect())) == sorted(map(tuple, batch.collect())) and batch.count() == 2
    assert cycles.sessions(spark.read.parquet(str(tmp_path / "ev")), "ts", "k", "30 minutes").count() == 3


def test_feed(spark):
    def pages(source, query, offset, size):
        if query == "bad":
            raise RuntimeError("no answer")
        return [{"id": f"{query}{k}"} for k in range(offset, min(offset + size, 5))]

    got = feed.read_feed(spark, pages, "s", ["a", "bad", "b"], page=2)
    assert sorted(r.id for r in feed.payloads(got, "id string").collect()) == [f"{q}{k}" for q in "ab" for k in range(5)]
    assert [(r.query, r.failure) for r in feed.failures(got).collect()] == [("bad", "RuntimeError: no answer")]
    assert feed.payloads(feed.read_feed(spark, pages, "s", ["a"], page=2, limit=3), "id string").count() == 3


def test_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text('source_url,title\nu1,"x\ny"\n,e1\n', encoding="utf-8")
    (tmp_path / "b.csv").write_text("source_url,title\nu1,later\n,e2\n", encoding="utf-8")
    rows = tables.read_csv(spark, [str(tmp_path / "b.csv"), str(tmp_path / "a.csv")])
    assert sorted((r.source_url or "", r.title) for r in tables.first_per_url(rows).collect()) == [("", "e1"), ("u1", "x\ny")]
    (tmp_path / "c.jsonl").write_text('{"text": "a"}\n\n{"text": "b"}\n')
    assert tables.read_jsonl(spark, str(tmp_path / "c.jsonl"), "text string").count() == 2
    assert tables.read_jsonl(spark, str(tmp_path / "none"), "text string").count() == 0
    df = spark.createDataFrame([("a_b", 0.5, None)], "k string, v double, n string")
    assert tables.write_csv(df, str(tmp_path / "out"), ["k", "v"]) and not tables.write_csv(df.limit(0), str(tmp_path / "out"))
    assert tables.read_csv(spark, str(tmp_path / "out"), ["k", "v"]).first().k == "a_b"
    assert "a\\_b & 0.50000 &" in tables.latex_table(df)
    assert df.select(tables.percent(F.col("v"))).first()[0] == "50.0%"


def test_flows(spark, tmp_path):
    schema = "title string, branch string, description string"
    degrees = spark.createDataFrame([("Grado en Enfermeria", "Ciencias de la Salud", "cuidados " * 10), ("Grado en Turismo", "Ciencias Sociales y Juridicas", "hoteles " * 10)], schema)
    table = StateTable(spark, str(tmp_path / "jobs"), records.STATE_SCHEMA)
    raw = posting(spark, {"title": "Enfermera de planta", "source_url": "http://a/1", "external_id": "1", "description": "cuidados de salud " * 5, "island": "tenerife"},
                  {"title": "Otra cosa", "source_url": "http://a/2", "external_id": "2"})
    assert flows.jobs_flow(raw, degrees, table, "t1").counts["inserted"] == 2
    state_rows = {r.source_url: r for r in table.read().collect()}
    assert state_rows["http://a/1"].target_degree_titles == "Grado en Enfermeria" and state_rows["http://a/1"].island == "Tenerife"
    assert state_rows["http://a/1"].island_raw == "tenerife" and state_rows["http://a/2"].degree_match_status == "no_match"
    cache, pairs = StateTable(spark, str(tmp_path / "cache"), CACHE), StateTable(spark, str(tmp_path / "pairs"), PAIR + ", job_title string, degree_title string, job_text_hash string, degree_text_hash string")
    catalogue = degrees.withColumns({"source": F.lit("ruct"), "source_id": F.monotonically_increasing_id().cast("string")})
    first = flows.align_flow(table.read(), catalogue, cache, pairs, "hashing", "m", "t1").counts
    assert first["inserted"] == 1 and first["embedded"] == 2
    again = flows.align_flow(table.read(), catalogue, cache, pairs, "hashing", "m", "t2").counts
    assert again["updated"] == 1 and again["embedded"] == 0 and again["stale"] == 0
    assert flows.compact_flow(table).counts == {"before": 2, "after": 2}
    assert flows.select_scaled(raw, 100).count() == 0  # a source without a quota gives none
    assert flows.select_scaled(raw.withColumn("source", F.lit("SCE")), 100).count() == 2


def test_full_flow(spark, tmp_path):
    (tmp_path / "doc.json").write_text(json.dumps({"ruct": [
        {"id": "1", "titulo": "Grado en Enfermeria", "universidad": "La Laguna", "tipo": "grado", "rama": "Ciencias de la Salud", "url": "http://u/1", "descripcion": "cuidados " * 10},
        {"id": "2", "titulo": "Grado en Turismo", "universidad": "Privada", "tipo": "grado", "rama": "Ciencias Sociales y Juridicas", "url": "http://u/2", "descripcion": "hoteles " * 10},
    ]}))
    registry = spark.createDataFrame([("ull", "Universidad de La Laguna", "publica", "La Laguna"), ("pri", "Privada", "privada", "")], "university_id string, canonical_name string, university_type string, aliases string")
    from rowloom.operators.catalog import DEGREE_COLUMNS

    more = ", job_title string, degree_title string, job_text_hash string, degree_text_hash string"
    schemas = {"jobs": records.STATE_SCHEMA, "catalogue": ", ".join(f"{c} string" for c in DEGREE_COLUMNS), "cache": CACHE, "pairs": PAIR + more}
    stores = flows.Stores(**{n: StateTable(spark, str(tmp_path / n), s, buckets=2) for n, s in schemas.items()})
    raw = posting(spark, {"title": "Enfermera de planta", "source_url": "http://a/1", "external_id": "1", "description": "cuidados de salud " * 5}, {"title": "Otra cosa", "source_url": "http://a/2", "external_id": "2"})
    document = tables.read_document(spark, str(tmp_path / "doc.json"))
    done, report = flows.full_flow(raw, document, registry, stores, "hashing", "m", "t1", names={"ruct": "ruct"})
    assert done["catalogue"].counts == {"rows": 2} and done["jobs"].counts["inserted"] == 2 and done["align"].counts["inserted"] == 1
    assert [(r.university_type, r.n) for r in report["summary"].collect()] == [("publica", 1)]
    assert flows.limit_sources(raw, 1).count() == 1
    none, report = flows.full_flow(raw, spark.createDataFrame([(1,)], "other int"), registry, stores, "hashing", "m", "t2", names={"ruct": "ruct"})
    assert not none["catalogue"].ok and report == {}


def test_embed_and_catalogue_flow(spark, tmp_path):
    corpus = spark.createDataFrame([("a b c",), ("d e",)], "text string")
    cache = StateTable(spark, str(tmp_path / "cache"), CACHE)
    assert tuple(flows.embed_flow(corpus, cache, "hashing", "m", "t", dry_run=True).first())[:2] == (2, 2)
    flows.embed_flow(corpus, cache, "hashing", "m", "t")
    m = flows.embed_flow(corpus, cache, "hashing", "m", "t", dry_run=True).first()
    assert (m.hits, m.misses) == (2, 0)
    doc = spark.createDataFrame([([("1", "Universidad A", "Grado en X")],)], "ruct array<struct<id:string,university:string,title:string>>")
    reg = spark.createDataFrame([("u1", "Universidad A", "publica", None)], "university_id string, canonical_name string, university_type string, aliases string")
    rows, outcome = flows.catalogue_flow(doc, reg, "t")
    assert outcome.ok and rows.first().university_id == "u1"
    assert not flows.catalogue_flow(doc, reg, "t", least_described=0.5)[1].ok
