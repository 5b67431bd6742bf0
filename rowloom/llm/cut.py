"""Texts that were cut off by a field limit or in transfer.

Intact values are cut artificially to make positives.  A logistic regression on hashed
features of the closing characters, the last words, punctuation and the distance to the
source's length limits is trained on a bounded sample and then scores every record.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rowloom.llm.sample import hash_share
from rowloom.operators.joins import join_dimension
from rowloom.session import cut_lineage

#: Rows of the labelled sample that the model is trained on.
TRAIN_ROWS = 20_000
#: Characters of the end of a text that features look at: of the last sentence they tell apart its
#: last 60 characters, up to twelve words and its brackets.
TAIL = 240
BITS = 16

# What sites put after a text they shortened, and traces of a cut transfer.
MARKS = ["…", "...", " …", " ...", " [...]", " […]", " (...)", "... Leer más", " Leer más", "… ver más", " Read more", "&nb", "&am", "�"]
_MARK = re.compile(
    r"(?:\s*(?:…|\.{3,}|\.\.(?=$)|\[(?:…|\.{2,})\]|\((?:…|\.{2,})\)|&#?\w{0,6}|�+|(?:leer|ver|read|see|show) (?:m[aá]s|more)))+\s*$",
    re.IGNORECASE,
)
_SENTENCE_END = re.compile(r"(?<=[.!?…])[\"'»”)\]]*\s+|\n+")
_TERMINAL = re.compile(r"[.!?][\"'»”)\]]*$")


def last_segment(text: str) -> str:
    """What follows the last sentence end or line break, with numbers masked."""
    return re.sub(r"\d+", "9", _SENTENCE_END.split(text.rstrip())[-1].strip().lower())


def split_mark(text: str) -> tuple[str, str]:
    """The text without a mark at its end, and the kind of the mark."""
    text = text.rstrip()
    m = _MARK.search(text)
    if not m:
        return text, ""
    mark = m.group().strip().lower()
    kind = "entity" if "&" in mark else "broken" if "�" in mark else "more" if mark[-1:].isalpha() else "dots"
    return text[: m.start()].rstrip(), kind


def _class(char: str) -> str:
    if not char:
        return "empty"
    if char in ".!?":
        return "end"
    if char in "\"'»”)]":
        return "close"
    return "letter" if char.isalpha() else "digit" if char.isdigit() else char


def features(tail: str, length: int, limits: tuple[int, ...], closings: frozenset[str]) -> list[int]:
    """Hashed features of the end of one text."""
    base, mark = split_mark(tail)
    segment = last_segment(tail)
    words = re.findall(r"\w+|[^\w\s]", base.lower())[-3:]
    ends = bool(_TERMINAL.search(base))
    known = segment in closings
    near = min((length - x for x in limits if -2 <= length - x <= 16), key=abs, default=None)
    kind = _class(base[-1:])
    last, two = words[-1] if words else "", " ".join(words[-2:])
    found = [
        "bias", f"mark={mark}", f"class={kind}", f"mark={mark},end={ends}", f"known={known}", f"known={known},mark={mark}",
        f"limit={'no' if near is None else 'at' if abs(near) <= 1 else 'near'},end={ends}", f"word={last if not last.isdigit() else '9'}",
        f"two={re.sub(r'[0-9]+', '9', two)}", f"segment={segment[-60:]}", f"s2={base[-2:].lower()}", f"s3={base[-3:].lower()}",
        f"words={min(len(segment.split()), 12)},end={ends}", f"size={min(length // 100, 12)}", f"end={ends},known={known}",
        f"open={segment.count('(') > segment.count(')')}",
    ]
    return [zlib.crc32(x.encode()) & ((1 << BITS) - 1) for x in found]


def train(x: np.ndarray, y: np.ndarray, rounds: int = 150, rate: float = 0.15, l2: float = 1e-4) -> np.ndarray:
    """Logistic regression by Adam on full batches; ``x`` holds the indices of the features that are 1."""
    w = np.zeros(1 << BITS)
    m, v = np.zeros_like(w), np.zeros_like(w)
    flat, k = x.ravel(), x.shape[1]
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    for t in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(w[x].sum(1), -30, 30)))
        g = np.bincount(flat, np.repeat((p - y) * weight, k), len(w)) + l2 * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def artificial_cuts(texts: list[str], seed: int = 7) -> list[tuple[int, str]]:
    """Texts cut once within a word or sentence, half of them with a mark after the cut, with the
    place of the text that each was made of."""
    rng = np.random.default_rng(seed)
    out = []
    for k, text in enumerate(texts):
        if len(text) < 12:
            continue
        for _ in range(20):
            at = int(rng.integers(max(4, len(text) - 150), len(text) - 2))
            base = text[:at].rstrip() if rng.random() < 0.7 else text[:at].rsplit(" ", 1)[0].rstrip()
            if base and not _TERMINAL.search(base) and base[-1] not in ":;":
                break
        else:
            continue
        out.append((k, base + (MARKS[int(rng.integers(len(MARKS)))] if rng.random() < 0.5 else "")))
    return out


class CutModel:
    """Weights with the statistics that the features need.  ``limits`` is a table ``(__source,
    __limits)``, joined to the rows; the rest is small enough to ship to every task."""

    def __init__(self, weights: np.ndarray, limits: DataFrame, closings: frozenset[str]) -> None:
        self.weights, self.limits, self.closings = weights.astype("float32"), limits, closings


def score_tails(weights: np.ndarray, closings: frozenset[str], tails: pd.Series, lengths: pd.Series, limits: pd.Series) -> np.ndarray:
    rows = [
        features(t, int(n), () if at is None else tuple(int(x) for x in at), closings)
        for t, n, at in zip(tails, lengths, limits, strict=True)
    ]
    if not rows:
        return np.zeros(0)
    return 1 / (1 + np.exp(-np.clip(weights[np.array(rows)].sum(1), -30, 30)))


def length_limits(rows: DataFrame, least: float = 9.0) -> DataFrame:
    """``(__source, __limits)``: the lengths at which a source's texts pile up, as many as there are.

    A length piles up if its number of different texts is improbable (a log-likelihood ratio of
    ``least``) for a Poisson count with the mean of the 20 lengths around it."""
    counts = rows.groupBy("__source", "__len").agg(F.count_distinct("__hash").alias("n"))
    near = Window.partitionBy("__source").orderBy("__len").rangeBetween(-10, 10)
    counts = counts.withColumn("around", F.greatest((F.sum("n").over(near) - F.col("n")) / 20, F.lit(0.1)))
    ratio = F.col("n") * F.log(F.col("n") / F.col("around")) - (F.col("n") - F.col("around"))
    spikes = counts.where((F.col("n") >= 8 * F.col("around")) & (ratio >= least))
    return spikes.groupBy("__source").agg(F.sort_array(F.collect_list("__len")).alias("__limits"))


def usual_closings(rows: DataFrame, share: float = 0.01) -> frozenset[str]:
    """Last segments without a full stop that so many different texts share that they are the
    usual end of a text.  The lower bound of their share must reach ``share``, so at most
    ``1 / share`` segments reach the driver."""

    @F.pandas_udf("string")
    def segment(tails: pd.Series) -> pd.Series:
        return tails.map(last_segment)

    ends = F.col("__tail").rlike(r"[.!?][\"'»”)\]]*\s*$") & ~F.col("__tail").rlike(r"(\.\.\.|…)\s*$")
    open_ = rows.where(~ends).select("__hash", segment("__tail").alias("segment")).distinct()
    counts = cut_lineage(open_.groupBy("segment").agg(F.count("*").alias("n")))
    total = counts.agg(F.sum("n")).first()[0] or 1
    p = F.col("n") / total
    lower = p - 1.64 * F.sqrt(p * (1 - p) / total)
    common = counts.where((lower >= share) & (F.col("n") >= 3))
    return frozenset(r.segment for r in common.select("segment").limit(int(2 / share)).collect() if r.segment)


def fit_cut_model(rows: DataFrame, train_rows: int = TRAIN_ROWS) -> CutModel:
    """Trains on ``train_rows`` intact values, chosen by hash so that every run takes the same."""
    limits, closings = cut_lineage(length_limits(rows)), usual_closings(rows)
    total = rows.agg(F.count_distinct("__hash")).first()[0]
    # Copies of a text are one before the bound counts them.
    sample = rows.where(hash_share("__hash", min(1.0, train_rows / max(1, total)), 17))
    sample = sample.groupBy("__hash").agg(F.min(F.struct("__tail", "__len", "__source")).alias("r")).select("__hash", "r.*").limit(2 * train_rows)
    pdf = join_dimension(sample, limits, ["__source"]).orderBy("__hash").select("__tail", "__len", "__limits").toPandas()
    dots = pdf["__tail"].str.rstrip().str.endswith(("...", "…"))
    terminal = pdf["__tail"].map(lambda t: bool(_TERMINAL.search(t.rstrip()))).astype(bool) & ~dots.astype(bool)
    usual = pdf["__tail"].map(lambda t: last_segment(t) in closings).astype(bool)
    intact = pdf[terminal | usual]
    tails, lengths = intact["__tail"].tolist(), intact["__len"].tolist()
    at = [() if x is None else tuple(int(v) for v in x) for x in intact["__limits"]]
    x, y = [], []
    for tail, n, own in zip(tails, lengths, at, strict=True):
        x.append(features(tail, n, own, closings))
        y.append(0)
        # A text shortened at a sentence end is intact, also with a mark after it.
        parts = _SENTENCE_END.split(tail.rstrip())
        if len(parts) > 1 and _TERMINAL.search(parts[-2]):
            mark = MARKS[(n * 7) % 11] if n % 2 else ""
            x.append(features(tail.rstrip()[: -len(parts[-1])].rstrip() + mark, n, own, closings))
            y.append(0)
    for k, (of, cut) in enumerate(artificial_cuts(tails)):
        own = at[of]
        n = own[k % len(own)] if own and k % 3 == 0 else int(lengths[of])
        x.append(features(cut, n, own, closings))
        y.append(1)
    if not any(y) or all(y):
        return CutModel(np.zeros(1 << BITS), limits, closings)
    return CutModel(train(np.array(x), np.array(y, dtype=float)), limits, closings)


def cut_rows(df: DataFrame, id_col: str, text: str, source: str) -> DataFrame:
    """The part of each text that the model needs: its end, its length and a hash."""
    return df.where(F.length(F.trim(text)) > 0).select(
        F.col(id_col).alias("__id"), F.coalesce(F.col(source), F.lit("")).alias("__source"), F.right(text, F.lit(TAIL)).alias("__tail"),
        F.length(text).alias("__len"), F.xxhash64(text).alias("__hash"),
    )


def score_cuts(df: DataFrame, id_col: str, text: str, source: str, model: CutModel) -> DataFrame:
    """Rows ``(id, source, score)``, one per row whose text is neither null nor blank.

    ``score`` is the probability that the text was cut.  Short and very long texts are
    treated alike, a null source has no limits, repeated rows are kept, an empty table gives
    no rows and other columns are not read.
    """
    rows = join_dimension(cut_rows(df, id_col, text, source), model.limits, ["__source"])
    kind = dict(df.dtypes)[id_col]
    weights, closings = model.weights, model.closings

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            score = score_tails(weights, closings, b["__tail"], b["__len"], b["__limits"])
            yield pd.DataFrame({id_col: b["__id"], "source": b["__source"], "score": score})

    rows = rows.select("__id", "__source", "__tail", "__len", "__limits")
    return rows.mapInPandas(run, f"`{id_col}` {kind}, source string, score double")


def source_shares(scored: DataFrame, cut: DataFrame, id_cols: list[str]) -> DataFrame:
    """Per source the number of texts, of cut texts and their share."""
    flagged = scored.join(cut.select(*id_cols).distinct().withColumn("__cut", F.lit(1)), id_cols, "left")
    return flagged.groupBy("source").agg(
        F.count("*").alias("n_texts"), F.coalesce(F.sum("__cut"), F.lit(0)).alias("n_cut")
    ).withColumn("share", F.round(F.col("n_cut") / F.col("n_texts"), 6))
