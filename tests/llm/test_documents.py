"""Containers, leaks and languages."""

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowloom.llm.language import TRAIN_ROWS, label_code, label_languages, languages_of, proportions, train_language_model
from rowloom.llm import leak
from rowloom.llm.leak import align_all, find_leaks, hash_words, hashes_needed, item_keys, shingles_of
from rowloom.llm.packing import TOKENIZERS, best_fit, count_tokens, pack_documents

KINDS = [("short", 512), ("standard", 2048), ("long", 8192)]


def test_best_fit():
    rng = random.Random(1)
    sizes = [min(8192, int(rng.lognormvariate(5.5, 1.2))) for _ in range(5000)]
    place, capacity = best_fit(sizes, [512, 2048, 8192])
    used = [0] * len(capacity)
    for s, p in zip(sizes, place):
        used[p] += s
    assert all(u <= c for u, c in zip(used, capacity)) and sum(used) == sum(sizes)
    assert sum(used) / sum(capacity) > 0.995
    assert best_fit([], [512]) == ([], []) and best_fit([0, 512, 0], [512])[1] in ([512], [512, 512])


def test_the_least_costly_capacity_is_opened():
    """Documents just under a small capacity waste room in the large one."""
    place, capacity = best_fit([2900] * 60, [3000, 8192])
    assert capacity == [3000] * 60
    place, capacity = best_fit([4000] * 40 + [190] * 20, [3000, 8192])
    assert set(capacity) == {8192} and len(capacity) == 20
    sizes = [2900] * 50 + [4096] * 50 + [700] * 20
    held = sum(best_fit(sizes, [1000, 3000, 8192])[1])
    assert held <= 25 * 8192 + 50 * 3000 + 20 * 1000 and sum(sizes) / held > 0.95
    alone = [sum(best_fit(sizes, [c])[1]) for c in (8192,)]
    assert held < min(alone)


def test_packing_places_each_once(spark):
    rows = [(k, n, "x") for k, n in enumerate([0, 1, 511, 512, 513, 8192, 8193, 30000, 0] + [37] * 500)] + [(3, 512, "x"), (None, 5, "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, n_tokens bigint, container_id string").select("doc_id", "n_tokens")
    got = pack_documents(df, KINDS, block_tokens=20_000).collect()
    per = {}
    for r in got:
        per.setdefault(r.container_id, [0, r.capacity_tokens, r.container_kind])[0] += r.n_tokens
    assert all(u <= c and dict(KINDS)[k] == c for u, c, k in per.values())
    pieces = {}
    for r in got:
        pieces.setdefault(r.doc_id, []).append((r.piece_no, r.start_token, r.n_tokens))
    assert sum(n for _, n, _ in rows) == sum(r.n_tokens for r in got) and len(pieces[7]) == 4 and len(pieces[6]) == 2 and len(pieces[3]) == 2
    assert all(len(p) == 1 for k, p in pieces.items() if k not in (3, 6, 7))
    again = {(r.doc_id, r.piece_no, r.container_id) for r in pack_documents(df, KINDS, block_tokens=20_000).collect()}
    assert again == {(r.doc_id, r.piece_no, r.container_id) for r in got}
    assert pack_documents(df.limit(0), KINDS).count() == 0
    with pytest.raises(ValueError):
        pack_documents(df, [])


@pytest.mark.skipif(not os.path.isdir(TOKENIZERS), reason="no tokenizers")
@pytest.mark.parametrize("name", ["byte_bpe_50k.tiktoken", "byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_token_counts(spark, name):
    df = spark.createDataFrame([(1, "Hola mundo <|endoftext|>"), (2, ""), (3, None)], "doc_id bigint, text string")
    got = {r.doc_id: r.n_tokens for r in count_tokens(df, "doc_id", "text", name).collect()}
    assert got[1] > 5 and got[2] == got[3] == 0


# --- leaks ------------------------------------------------------------------------------------


def made_items(n=30, seed=3):
    rng = random.Random(seed)
    phrases = ["la rotacion del primer curso", "quedo por encima de lo previsto", "segun el anexo", "en las islas menores", "con datos de la oficina"]
    return [(k, " ".join(f"{rng.choice(phrases)} {rng.randint(100, 9999)}" for _ in range(14)).capitalize()) for k in range(n)]


def changed(words, rng, share=0.08):
    out = []
    for w in words:
        x = rng.random()
        out += [] if x < share / 3 else ["cosa"] if x < 2 * share / 3 else [w, "mas"] if x < share else [w]
    return out


def test_leaks(spark):
    items, rng = made_items(), random.Random(8)
    filler = lambda n: " ".join(rng.choices("uno dos tres cuatro cinco seis siete ocho nueve diez".split(), k=n))
    docs, wanted = [], set()
    for k in range(120):
        i, text = items[k % len(items)]
        words = text.split()
        kind = k % 6
        if kind == 0:
            body = filler(3000) + " " + " ".join(changed(words[10:50], rng)) + " " + filler(2000)
        elif kind == 1:
            body = filler(40) + " " + " ".join(words).upper().replace(" ", ",  ")
        elif kind == 2:
            body = filler(30) + " " + " ".join(words[:18]) + " " + filler(30) + " " + " ".join(words[40:60])
        elif kind == 3:
            body = filler(30) + " " + " ".join(words[5:12]) + " " + filler(20)
        elif kind == 4:
            body = " ".join(w if not w.isdigit() else str(rng.randint(100, 9999)) for w in words)
        else:
            body = filler(60)
        docs.append((k, body, "x"))
        if kind < 3:
            wanted.add((k, i))
    schema = "doc_id bigint, text string, item_id string"
    items_df = spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in find_leaks(spark.createDataFrame(docs, schema), items_df).collect()}
    assert got == wanted


def test_leaks_of_common_words(spark):
    """Items whose words are all common: the order of the words tells a passage."""
    rng = random.Random(21)
    vocabulary = [f"palabra{chr(97 + k)}" for k in range(26)]
    items = [(k, " ".join(rng.choices(vocabulary, k=70))) for k in range(30)]
    filler = lambda n: rng.choices("uno dos tres cuatro cinco".split(), k=n)
    docs, wanted = [], set()
    for k in range(60):
        i, words = k % 30, items[k % 30][1].split()
        body = [words[20:45], words[8:30] + ["cosa", "otra"] + words[32:50], words[5:18] + filler(50) + words[18:30], words[5:17]][k % 4]
        docs.append((k, " ".join(filler(40) + body + filler(40))))
        wanted |= {(k, i)} if k % 4 < 3 else set()
    got = find_leaks(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == wanted


def test_leak_edges(spark):
    items = spark.createDataFrame([(1, made_items()[0][1]), (2, made_items()[0][1]), (3, None), (4, ""), (5, "dos palabras")], "item_id bigint, text string")
    text = made_items()[0][1]
    docs = spark.createDataFrame([(1, text), (1, text), (2, None), (3, ""), (4, "dos palabras"), (5, "z " * 50000)], "doc_id bigint, text string")
    got = sorted((r.doc_id, r.item_id) for r in find_leaks(docs, items).collect())
    assert got == [(1, 1), (1, 1), (1, 2), (1, 2)]
    assert find_leaks(docs.limit(0), items).count() == 0 and find_leaks(docs, items.limit(0)).count() == 0


class Plain:
    """An item without anything in common with others."""

    def __init__(self, words):
        self.words, self.rare = words, np.ones(len(words), bool)


def test_alignment_and_hashes():
    a, b = np.arange(1, 30, dtype=np.uint32), np.arange(1, 30, dtype=np.uint32)
    a[10] = 99
    (score, matched, rare, span, _), none = align_all([a, a[:0]], [Plain(b), Plain(b)])
    assert (score, matched, rare, span) == (26, 28, 28, (0, 29)) and none[0] == 0
    # An added and a dropped word cost two each.
    assert align_all([np.concatenate([b[:9], [77], b[9:20], b[21:]]).astype(np.uint32)], [Plain(b)])[0][:2] == (24, 28)
    assert hashes_needed(4) < hashes_needed(16)


def test_words():
    h, bounds = hash_words(["¿Qué? A\u0301rbol—7", "", "que arbol 7 ß Ω 中文"])
    assert bounds.tolist() == [0, 3, 3, 9] and (h[:3] == h[3:6]).all() and len(set(h.tolist())) == 6
    assert hash_words([])[1].tolist() == [0] and len(shingles_of(h[:3])) == 0


def full_table():
    return leak.BitTable(10, np.full(128, 255, np.uint8))


def test_candidates_recall():
    """Every altered piece of 25 words shares enough hash values with its item, wherever it stands."""
    items = made_items(60, 5)
    hashed = {i: hash_words([t])[0] for i, t in items}
    df = {}
    for h in hashed.values():
        for x in set(shingles_of(h).tolist()):
            df[x] = df.get(x, 0) + 1
    shared = np.array(sorted(x for x, n in df.items() if n > 1), np.uint64)
    keys = {i: item_keys(shingles_of(h), shared, np.array([df[x] for x in shared.tolist()])) for i, h in hashed.items()}
    rng, missed = random.Random(7), 0
    for i, t in items:
        w = t.lower().split()
        at = rng.randint(0, len(w) - 25)
        doc = rng.choices("uno dos tres cuatro".split(), k=rng.randint(0, 300)) + changed(w[at : at + 25], rng) + rng.choices("uno dos tres".split(), k=200)
        _, _, key = leak.part_hits(*hash_words([" ".join(doc)]), full_table())
        missed += np.isin(np.unique(key), keys[i]).sum() < leak.LEAST_HITS
    assert missed <= 1


def test_no_order_or_number_of_items_matters(spark):
    """Further items, of other words, change no result; every document stands by itself."""
    items, rng = made_items(40, 11), random.Random(4)
    docs = [(k, " ".join(changed(items[k % 40][1].lower().split()[8:40], rng))) for k in range(80)]
    docs_df = spark.createDataFrame(docs, "doc_id bigint, text string")
    more = [(1000 + k, " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(60))) for k in range(400)]
    few, many = (spark.createDataFrame(x, "item_id bigint, text string") for x in (items, items + more))
    found = [sorted((r.doc_id, r.item_id) for r in find_leaks(docs_df, x).collect()) for x in (few, many)]
    assert found[0] == found[1] and len(found[0]) >= 76
    one_by_one = find_leaks(docs_df.where("doc_id % 7 = 3"), few).collect()
    assert sorted((r.doc_id, r.item_id) for r in one_by_one) == [x for x in found[0] if x[0] % 7 == 3]


def test_passages_far_apart(spark):
    """Two passages in different parts of a long document make one leak."""
    i, text = made_items()[2]
    w = text.lower().split()
    filler = "uno dos tres cuatro".split() * 500
    doc = " ".join(filler[:700] + w[:14] + filler + w[40:55] + filler[:99])
    got = find_leaks(spark.createDataFrame([(1, doc)], "doc_id bigint, text string"), spark.createDataFrame(made_items(), "item_id bigint, text string"))
    assert [(r.doc_id, r.item_id) for r in got.collect()] == [(1, i)]


# --- languages --------------------------------------------------------------------------------

WORDS = {
    "es": "el equipo de la empresa busca una persona para trabajar con nosotros en las islas durante este año porque ofrecemos formación",
    "en": "the company is looking for a person who wants to work with our team on the islands during this year because we offer training",
    "de": "das unternehmen sucht eine person die mit unserem team auf den inseln während dieses jahres arbeiten möchte weil wir schulung bieten",
    "fr": "la société cherche une personne pour travailler avec notre équipe dans les îles pendant cette année parce que nous offrons une formation",
}


def text_in(lang, n, rng):
    return " ".join(rng.choices(WORDS[lang].split(), k=n)).capitalize() + "."


def trained(spark):
    rng = random.Random(2)
    rows = []
    for k in range(400):
        lang = list(WORDS)[k % 4]
        label = lang if rng.random() > 0.06 else rng.choice(list(WORDS))
        rows.append((k, text_in(lang, 40, rng), label.upper() if k % 3 else f"{label}-XX"))
    return train_language_model(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), "text", "lang", "doc_id", TRAIN_ROWS)


def test_languages(spark):
    model, rng = trained(spark), random.Random(9)
    assert model.names == sorted(WORDS)
    docs, wanted = [], {}
    for k in range(80):
        a, b = rng.sample(list(WORDS), 2)
        parts = [a] * 3 if k % 2 else [a, b, a]
        text = "\n\n".join(text_in(x, 30 if x == a else 12, rng) for x in parts)
        text = text.upper() if k % 5 == 0 else text
        docs.append((k, text, [a, None, "und", b][k % 4], 1))
        wanted[k] = (a, parts)
    docs += [(100, None, "es", 1), (101, "", "es", 1), (102, "123 456", "es", 1), (103, "x" * 100_000, "es", 1)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang string, para_no int")
    rows = label_languages(df, model, "doc_id", "text", "lang").collect()
    got = {(r.doc_id, r.para_no): r for r in rows}
    right = sum(got[k, 0].lang == a and [got[k, j + 1].lang for j in range(3)] == parts for k, (a, parts) in wanted.items())
    assert right >= 78
    assert all(0 <= r.confidence <= 1 for r in rows) and {r.doc_id for r in rows} == {*range(80), 102, 103}
    assert got[102, 0].lang == "und" and got[1, 0].label is None and got[0, 0].mixed and not got[1, 0].mixed
    assert label_languages(df.limit(0), model, "doc_id", "text", "lang").count() == 0


def test_mixture():
    like = np.array([[-10.0, -60, -90], [-80, -20, -90], [-12, -50, -90]])
    best, sure = languages_of(like, np.array([10.0, 10, 10]))
    assert best.tolist() == [0, 1, 0] and (sure > 0.9).all()
    loan = np.array([[-100.0, -180], [-31, -30]])
    assert languages_of(loan, np.array([50.0, 3]))[0].tolist() == [0, 0]
    ll, share = proportions(like, [0, 1])
    assert abs(share.sum() - 1) < 1e-9 and ll < 0
    # No other proportions are likelier.
    others = [np.log(np.exp(like[:, :2]) @ np.array([x, 1 - x])).sum() for x in np.linspace(0.01, 0.99, 99)]
    assert ll >= max(others) - 1e-6


def test_rare_language(spark):
    """A language that a few rows in a thousand carry is learned too."""
    rng = random.Random(5)
    rows = [(k, text_in("es", 40, rng), "es") for k in range(1200)] + [(2000 + k, text_in("de", 40, rng), "de") for k in range(4)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = train_language_model(df, "text", "lang", "doc_id")
    assert model.names == ["de", "es"]
    new = spark.createDataFrame([(1, text_in("de", 30, rng), None)], "doc_id bigint, text string, lang string")
    assert {r.lang for r in label_languages(new, model, "doc_id", "text", "lang").collect()} == {"de"}


def test_labels(spark):
    df = spark.createDataFrame([("es-ES",), ("EN",), ("und",), ("",), (None,), ("unknown",), ("123",)], "l string")
    assert [r.c for r in df.select(label_code(F.col("l")).alias("c")).collect()] == ["es", "en", None, None, None, None, None]


def test_no_labels(spark):
    df = spark.createDataFrame([(1, "hola", None)], "doc_id bigint, text string, lang string")
    model = train_language_model(df, "text", "lang", "doc_id")
    assert [r.lang for r in label_languages(df, model, "doc_id", "text", "lang").collect()] == ["und", "und"]
