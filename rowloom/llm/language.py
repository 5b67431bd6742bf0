"""The language of every document and of every paragraph of a mixed one.

Letter n-gram models of the languages are trained here on a bounded sample of labelled rows.
Each paragraph gets a likelihood under each language; expectation-maximisation estimates the
proportions of the languages in a document, and a language belongs to the document's set if
it raises the likelihood by more than a penalty.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.functions.text import strip_accents
from rowloom.llm.sample import hash_share

#: Labelled rows that the models are trained on, and the longest text among them.
TRAIN_ROWS = 6_000
TRAIN_CHARS = 20_000
BITS = 17
#: A label is taken for a language if so many rows carry it: of one text nothing can be checked.
LEAST_LABELLED = 2
#: What a language must add to the likelihood of a document, besides half the log of its words.
PENALTY = 4.0

#: Likelihoods are divided by this for the confidence.
TEMPER = 4.0

# Marks that stand where a label should be and name no language.
NO_LANGUAGE = ["", "und", "unk", "unknown", "mul", "zxx", "xx", "none", "null", "nan", "na", "n/a", "other", "-", "?"]


def label_code(lang: Column) -> Column:
    """The part of a label before any hyphen, lower case; null if it names no language."""
    code = F.regexp_replace(F.lower(F.trim(lang)), r"[-_].*$", "")
    known = ~F.lower(F.trim(lang)).isin(NO_LANGUAGE) & ~code.isin(NO_LANGUAGE) & code.rlike("^[a-z]{2,3}$")
    return F.when(known, code)


def letters(text: Column) -> Column:
    """Lower case words without accents; line breaks stay, so paragraphs do."""
    return F.regexp_replace(strip_accents(F.lower(text)), r"[^\p{L}\n]+", " ")


def grams(word: str) -> list[int]:
    """Hashed n-grams of one to four letters with word ends, and the word itself."""
    w = f" {word} "
    found = [f"={word}"]
    for n in (2, 3, 4):
        found += [w[k : k + n] for k in range(len(w) - n + 1)]
    return [zlib.crc32(g.encode()) & ((1 << BITS) - 1) for g in found]


class LanguageModel:
    """Log-likelihoods of words under each language: the mean over their n-grams."""

    def __init__(self, names: list[str], table: np.ndarray) -> None:
        self.names, self.table = names, table.astype("float32")
        self._reset()

    def _reset(self) -> None:
        self.index: dict[str, int] = defaultdict(lambda: len(self.index))
        self.rows = np.zeros((0, len(self.names)), "float32")

    def __getstate__(self) -> dict:
        return {"names": self.names, "table": self.table}

    def __setstate__(self, state: dict) -> None:
        self.__init__(state["names"], state["table"])

    def of_words(self, words: list[str]) -> np.ndarray:
        if len(self.index) > 300_000:
            self._reset()
        codes = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        if len(self.index) > len(self.rows):
            new = list(self.index)[len(self.rows) :]
            more = np.array([self.table[grams(w)].mean(0) for w in new], "float32")
            self.rows = np.concatenate([self.rows, more])
        return self.rows[codes]


def _fit(names: list[str], counts: list[Counter], labels: np.ndarray, alpha: float = 0.3) -> LanguageModel:
    table = np.zeros((1 << BITS, len(names)))
    cache: dict[str, list[int]] = {}
    for words, label in zip(counts, labels, strict=True):
        for w, n in words.items():
            g = cache.get(w)
            if g is None:
                g = cache[w] = grams(w)
            np.add.at(table[:, label], g, n)
    total = table.sum(0) + alpha * (1 << BITS)
    return LanguageModel(names, np.log((table + alpha) / total) * 2)


def train_language_model(df: DataFrame, text: str, lang: str, key: str, train_rows: int = TRAIN_ROWS) -> LanguageModel:
    """Trains on ``train_rows`` labelled rows, chosen by hash.  Some labels are wrong: rows that
    the first models contradict are relabelled and the models are fitted again, twice."""
    rows = df.select(F.col(text).alias("t"), label_code(F.col(lang)).alias("l"), F.col(key).alias("k"))
    rows = rows.where((F.length("t") > 0) & F.col("l").isNotNull())
    found = {r.l: r.n for r in rows.groupBy("l").agg(F.count("*").alias("n")).collect()}
    # Codes have two or three letters, so there are at most some thousands of them.
    names = sorted(k for k, n in found.items() if n >= LEAST_LABELLED)
    if not names:
        return LanguageModel(["und"], np.zeros((1 << BITS, 1)))
    # The same number of rows of each language, as far as it has so many.
    each = max(1, train_rows // len(names))
    share = F.create_map(*[F.lit(x) for k in names for x in (k, min(1.0, each / found[k]))])
    kept = rows.where(F.col("l").isin(names) & (F.length("t") <= TRAIN_CHARS))
    kept = kept.where(hash_share("k", F.element_at(share, F.col("l")), 23)).limit(2 * train_rows)
    pdf = kept.select(letters(F.col("t")).alias("t"), "l", "k").toPandas().sort_values("k", kind="stable")
    counts = [Counter(t.split()) for t in pdf["t"]]
    labels = np.array([names.index(x) for x in pdf["l"]])
    model = _fit(names, counts, labels)
    for _ in range(2):
        best = np.array([
            int((model.of_words(list(c)) * np.array(list(c.values()), "float32")[:, None]).sum(0).argmax()) if c else k
            for c, k in zip(counts, labels, strict=True)
        ])
        model = _fit(names, counts, best)
    return model


def log_sum(a: np.ndarray) -> np.ndarray:
    top = a.max(1, keepdims=True)
    return top[:, 0] + np.log(np.exp(a - top).sum(1))


def proportions(like: np.ndarray, chosen: list[int], rounds: int = 200) -> tuple[float, np.ndarray]:
    """Expectation-maximisation over the proportions of the chosen languages among the paragraphs,
    until the log-likelihood of the document stands still; gives it and the proportions."""
    part = like[:, chosen]
    share, last = np.full(len(chosen), 1 / len(chosen)), -np.inf
    for _ in range(rounds):
        joint = part + np.log(share + 1e-12)
        each = log_sum(joint)
        now = float(each.sum())
        if now - last < 1e-6:
            break
        share, last = np.exp(joint - each[:, None]).mean(0), now
    return now, share


def languages_of(like: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The language of each paragraph and its confidence.

    The set starts with the best single language and grows by the language that raises the
    likelihood most, as long as that outweighs the penalty."""
    total = like.sum(0)
    chosen = [int(total.argmax())]
    now, share = float(total[chosen[0]]), np.ones(1)
    rest = set(like.argmax(1).tolist()) - set(chosen)
    penalty = PENALTY + 0.5 * np.log(sizes.sum() + 1)
    while rest:
        tried = [(*proportions(like, [*chosen, k]), k) for k in sorted(rest)]
        gain, new_share, k = max(tried, key=lambda x: x[0])
        if gain - now <= penalty:
            break
        now, share = gain, new_share
        chosen.append(k)
        rest.discard(k)
    joint = like[:, chosen] + np.log(share + 1e-12)
    best = np.array(chosen)[joint.argmax(1)]
    # Neighbouring n-grams and words are no independent witnesses: a confidence counts a part of them.
    calm = like / TEMPER
    post = np.exp(calm - log_sum(calm)[:, None])
    return best, post[np.arange(len(best)), best]


def label_languages(df: DataFrame, model: LanguageModel, doc_id: str, text: str, lang: str) -> DataFrame:
    """Rows ``(doc_id, para_no, lang, confidence, main, mixed, label)``.

    ``para_no`` 0 is the document: the language with the most characters.  One row per
    paragraph follows, numbered from 1.  ``main`` is the document's language, ``mixed`` says whether the paragraphs are in several
    languages, ``label`` is the code that the row came with, null if it names no language.

    * Null and empty texts have no language and give no row.
    * A paragraph without words has the document's language, a document without words the
      language ``und`` with confidence 0.
    * Whole texts are read, however long; repeated rows are kept; an empty table gives an
      empty result; other columns are not read.
    """
    kind = dict(df.dtypes)[doc_id]
    rows = df.where(F.length(text) > 0).select(
        F.col(doc_id).alias("__id"), letters(F.col(text)).alias("__words"), label_code(F.col(lang)).alias("__label"),
        F.transform(F.split(F.col(text), "\n\n"), lambda p: F.length(p)).alias("__chars"),
    )
    names = np.array([*model.names, "und"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in range(0, len(b), 500):
                yield one(b.iloc[at : at + 500])

    def one(b: pd.DataFrame) -> pd.DataFrame:
        words: list[str] = []
        sizes: list[int] = []
        counts: list[int] = []
        for t in b["__words"]:
            paragraphs = t.split("\n\n")
            counts.append(len(paragraphs))
            for p in paragraphs:
                own = p.split()
                sizes.append(len(own))
                words += own
        size = np.array(sizes, float)
        ends = np.cumsum(sizes)
        scores = np.concatenate([np.zeros((1, len(model.names))), np.cumsum(model.of_words(words), 0, dtype=float)])
        like = scores[ends] - scores[ends - np.array(sizes, int)]
        out: dict[str, list] = {k: [] for k in (doc_id, "para_no", "lang", "confidence", "main", "mixed", "label")}
        at = 0
        for i, label, chars, n in zip(b["__id"], b["__label"], b["__chars"], counts, strict=True):
            part, width = like[at : at + n], size[at : at + n]
            at += n
            some = width > 0
            best, sure = np.full(n, len(model.names)), np.zeros(n)
            if some.any():
                best[some], sure[some] = languages_of(part[some], width[some])
                by = np.bincount(best[some], np.asarray(chars)[some], len(names))
                main = int(by.argmax())
                best[~some], sure[~some] = main, 0.0
                confidence = float((sure[some] * width[some]).sum() / width[some].sum())
            else:
                main, confidence = len(model.names), 0.0
            out[doc_id] += [i] * (n + 1)
            out["para_no"] += range(n + 1)
            out["lang"] += [names[main], *names[best]]
            out["confidence"] += [round(confidence, 6), *sure.round(6)]
            out["main"] += [names[main]] * (n + 1)
            out["mixed"] += [bool((best != main).any())] * (n + 1)
            out["label"] += [label] * (n + 1)
        return pd.DataFrame(out)

    schema = f"`{doc_id}` {kind}, para_no bigint, lang string, confidence double, main string, mixed boolean, label string"
    return rows.mapInPandas(run, schema)
