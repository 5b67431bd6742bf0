"""Embedding of texts through a cache, and similarities of gated pairs."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.functions.scores import cosine, norm
from rowloom.functions.text import cache_key, chunks, estimated_tokens, text_hash

#: A provider turns a list of texts into a list of vectors.
Provider = Callable[[list[str]], list[list[float]]]


def hashing_provider(dims: int = 64) -> Provider:
    """Deterministic vectors from hashed words, for tests and runs without a service."""

    def embed(texts: list[str]) -> list[list[float]]:
        out = np.zeros((len(texts), dims))
        for row, text in zip(out, texts, strict=True):
            for word in text.lower().split():
                h = int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "little")
                row[h % dims] += 1 if (h >> 32) & 1 else -1
        return out.tolist()

    return embed


# Names under which providers are known.
PROVIDERS: dict[str, Callable[[], Provider]] = {"hashing": hashing_provider}


def provider_named(name: str) -> Provider:
    if name not in PROVIDERS:
        raise ValueError(f"no provider named {name!r}; register it in PROVIDERS")
    return PROVIDERS[name]()


def distinct_texts(texts: DataFrame, text: str) -> DataFrame:
    """``(text_hash, text)``, one row per text; null and blank texts are left out."""
    rows = texts.select(text_hash(F.col(text)).alias("text_hash"), F.col(text).alias("text")).where(F.length(F.trim("text")) > 0)
    return rows.groupBy("text_hash").agg(F.min("text").alias("text"))


def split_cache(texts: DataFrame, cache: DataFrame, provider: str, model: str) -> tuple[DataFrame, DataFrame]:
    """Hits ``(text_hash, vector)`` and misses ``(text_hash, text)`` of ``(text_hash, text)``."""
    keyed = texts.withColumn("cache_key", cache_key(F.lit(provider), F.lit(model), F.col("text_hash")))
    known = cache.select("cache_key", "vector")
    hits = keyed.join(known, "cache_key").select("text_hash", "vector")
    return hits, keyed.join(known, "cache_key", "left_anti").select("text_hash", "text")


def embed_texts(texts: DataFrame, embed: Provider) -> DataFrame:
    """``(text_hash, vector)``; the provider is called once per Arrow batch."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"text_hash": b["text_hash"], "vector": embed(b["text"].tolist()) if len(b) else []})

    return texts.select("text_hash", "text").mapInPandas(run, "text_hash string, vector array<double>")


def embed_with_cache(texts: DataFrame, cache: DataFrame, provider: str, model: str, embed: Provider) -> tuple[DataFrame, DataFrame]:
    """Vectors of all texts, and the rows to add to the cache."""
    hits, misses = split_cache(texts, cache, provider, model)
    made = embed_texts(misses, embed)
    entry = made.select(
        cache_key(F.lit(provider), F.lit(model), F.col("text_hash")).alias("cache_key"), "text_hash",
        F.lit(provider).alias("provider"), F.lit(model).alias("model"), "vector", F.size("vector").alias("vector_dim"),
    )
    return hits.unionByName(made), entry


def pair_similarity(pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    """Adds ``score`` to pairs with texts; pairs without two vectors of one length are dropped.

    Norms are computed once a vector; both joins are by the hash of a text."""
    sized = vectors.select("text_hash", "vector", norm(F.col("vector")).alias("size"))
    left = sized.select(F.col("text_hash").alias("job_text_hash"), F.col("vector").alias("a"), F.col("size").alias("na"))
    right = sized.select(F.col("text_hash").alias("degree_text_hash"), F.col("vector").alias("b"), F.col("size").alias("nb"))
    hashed = pairs.withColumn("job_text_hash", text_hash(F.col("job_text"))).withColumn("degree_text_hash", text_hash(F.col("degree_text")))
    both = hashed.join(left, "job_text_hash").join(right, "degree_text_hash")
    both = both.where((F.size("a") > 0) & (F.size("a") == F.size("b")))
    score = cosine(F.col("a"), F.col("b"), F.col("na"), F.col("nb"))
    return both.withColumn("score", score).drop("a", "b", "na", "nb")


def chunk_rows(texts: DataFrame, text_id: str, text: str, size: int = 3000) -> DataFrame:
    """``(text_id, chunk_no, chunk)``; empty texts have no chunk."""
    return texts.select(text_id, F.posexplode(chunks(F.col(text), size)).alias("chunk_no", "chunk"))


def manifest(texts: DataFrame, chunked: DataFrame, hits: int, misses: int) -> DataFrame:
    """One row: items, chunks, estimated tokens, cache hits and misses."""
    rows = texts.select(F.lit(1).alias("item"), F.lit(None).cast("string").alias("chunk")).unionByName(
        chunked.select(F.lit(None).cast("int").alias("item"), "chunk")
    )
    return rows.agg(
        F.count("item").alias("items"), F.count("chunk").alias("chunks"),
        F.coalesce(F.sum(F.when(F.col("chunk").isNotNull(), estimated_tokens(F.col("chunk")))), F.lit(0)).alias("tokens"),
        F.lit(hits).alias("hits"), F.lit(misses).alias("misses"),
    )
