"""The registered queries run over whole tables and agree with SQL or with a plain version."""

import os

import oracle
import pytest

from rowloom.llm import queries as q

FOLDER = f"{oracle.DATA}/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")
COLUMNS = {
    "p1_found": {"row_id": "bigint", "field": "string", "canon_id": "bigint"},
    "p2_found": {"tbl": "string", "row_id": "bigint", "field": "string"},
    "p5_found": {"job_key": "string", "degree_key": "string"},
    "p6_found": {"tbl": "string", "row_id": "bigint"},
    "p7_found": {"job_key": "string", "survivor_row_id": "bigint", "description_row_id": "bigint", "salary_row_id": "bigint"},
    "p9_found": {"doc_id": "bigint", "item_id": "bigint"},
    "p10_found": {"doc_id": "bigint", "para_no": "bigint", "lang": "string"},
}
KEPT = {}


def rows(spark, name):
    if name not in KEPT:
        df = q.queries()[name](spark, FOLDER)
        KEPT[name] = (dict(df.dtypes), df.columns, [tuple(r) for r in df.collect()])
    return KEPT[name]


@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(q.queries()))
def test_query(spark, con, name):
    kinds, columns, found = rows(spark, name)
    assert found
    if name in COLUMNS:
        assert kinds == COLUMNS[name]
        assert len(set(found)) == len(found) and all(v is not None for r in found for v in r)
    sql = q.oracle_sql().get(name)
    if sql:
        con.execute(sql)
        assert oracle.rows_of(columns, found) == oracle.rows_of([d[0] for d in con.description], con.fetchall())


def test_survivors_of_a_plain_loop(spark, con):
    """p7_found against a loop over the rows of each posting."""
    bad = {r[1] for r in rows(spark, "p2_found")[2] if r[0] == "jobs" and r[2] == "description"}
    bad |= {r[1] for r in rows(spark, "p6_found")[2] if r[0] == "jobs"}
    from rowloom.operators.quantities import read_pay

    groups = {}
    for key, row, text, pay, seen in con.execute("SELECT job_key, row_id, description, salary_text, last_seen_at FROM jobs WHERE job_key IS NOT NULL").fetchall():
        groups.setdefault(key, []).append((row, text, pay, seen))
    wanted = set()
    for key, group in groups.items():
        if len(group) < 2:
            continue
        newest = sorted(group, key=lambda r: (r[3], -r[0]), reverse=True)
        described = sorted((r for r in newest if r[1] is not None and r[0] not in bad), key=lambda r: -len(r[1]))
        paid = [r for r in newest if r[2] and (read_pay(r[2]).low or read_pay(r[2]).high)]
        wanted.add((key, newest[0][0], described[0][0] if described else 0, paid[0][0] if paid else 0))
    assert set(rows(spark, "p7_found")[2]) == wanted


def test_every_document_is_placed_once(spark, con):
    _, columns, found = rows(spark, "p8_containers")
    at = {c: k for k, c in enumerate(columns)}
    ids = [r[at["doc_id"]] for r in found if r[at["piece_no"]] == 0]
    assert sorted(ids) == sorted(r[0] for r in con.execute("SELECT doc_id FROM documents").fetchall())
    used = {}
    for r in found:
        used[r[at["container_id"]]] = used.get(r[at["container_id"]], 0) + r[at["n_tokens"]]
    assert all(used[r[at["container_id"]]] <= r[at["capacity_tokens"]] for r in found)


def test_without_the_search_no_pair_is_found(spark, monkeypatch):
    """The pairs come through the sketches: without hash values there are none."""
    from rowloom.llm import leak

    monkeypatch.setattr(leak, "item_keys", lambda *a: leak.np.zeros(0, leak.np.int64))
    items = spark.read.parquet(f"{FOLDER}/eval_items.parquet")
    docs = items.selectExpr("item_id AS doc_id", "text")
    monkeypatch.setattr(leak, "LEAST_HITS", 10**6)
    assert leak.find_leaks(docs, items).count() == 0
