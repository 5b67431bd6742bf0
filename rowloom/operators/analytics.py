"""Summaries of scored pairs by sector, with quantiles and bootstrap intervals."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SECTORS = ["publica", "privada"]


def attach(facts: DataFrame, dim: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Facts joined to a dimension by key, and a one-row table ``n_lost`` of facts without one."""
    joined = facts.join(dim.withColumn("__there", F.lit(True)), key, "left")
    lost = joined.agg(F.count_if(F.col("__there").isNull()).alias("n_lost"))
    return joined.where(F.col("__there")).drop("__there"), lost


def in_sectors(df: DataFrame, sector: str, sectors: list[str] = SECTORS) -> DataFrame:
    """Rows of the given sectors, the name trimmed and in lower case."""
    return df.withColumn(sector, F.lower(F.trim(sector))).where(F.col(sector).isin(sectors))


def quantiles(df: DataFrame, group: list[str], value: str, qs: list[float]) -> DataFrame:
    """Exact quantiles with linear interpolation, one column ``q<percent>`` each."""
    found = [F.percentile(value, F.lit(q)).alias(f"q{round(100 * q)}") for q in qs]
    return df.groupBy(*group).agg(*found)


def bootstrap_mean(df: DataFrame, group: str, value: str, order: str, draws: int = 5000, seed: int = 42) -> DataFrame:
    """``(group, n, mean, low, high)``: mean and the 2.5 and 97.5 per cent bounds of resampled means.

    Instead of drawing indices and joining rows to them, each row gets the number of times a
    draw takes it, a Poisson count of mean 1; the resampled mean is the ratio of two sums.  Rows
    that agree in group, value and ``order`` get the sum of their counts, a Poisson count with
    their number as mean, from a generator seeded by a hash of the three: rows written twice
    weigh independently, no draw needs all rows in one place, and equal input gives equal bounds.
    Each task adds up its rows before anything is shuffled.  Null values are left out.
    """
    rows = df.where(F.col(value).isNotNull()).select(group, value, order)
    counted = rows.groupBy(group, value, order).agg(F.count("*").alias("__n"))
    counted = counted.select(
        F.col(group).alias("__g"), F.col(value).cast("double").alias("__v"), "__n", F.xxhash64(group, value, order, F.lit(seed)).alias("__seed")
    )

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict = {}
        for b in batches:
            for g, v, n, s in zip(b["__g"], b["__v"], b["__n"], b["__seed"], strict=True):
                w = np.random.Generator(np.random.SFC64(int(s) & (2**64 - 1))).poisson(n, draws)
                total = sums.setdefault(g, np.zeros((2, draws)))
                total[0] += w
                total[1] += w * v
        for g, (w, x) in sums.items():
            yield pd.DataFrame({"__g": [g] * draws, "draw": np.arange(draws), "w": w, "x": x})

    drawn = counted.mapInPandas(draw, f"__g {dict(df.dtypes)[group]}, draw int, w double, x double")
    # A draw that takes no row at all has no mean.
    means = drawn.groupBy(F.col("__g").alias(group), "draw").agg(F.try_divide(F.sum("x"), F.sum("w")).alias("m"))
    bounds = means.groupBy(group).agg(F.percentile("m", F.lit(0.025)).alias("low"), F.percentile("m", F.lit(0.975)).alias("high"))
    plain = rows.groupBy(group).agg(F.count("*").alias("n"), F.avg(value).alias("mean"))
    return plain.join(bounds, group)


def sector_summary(df: DataFrame, sector: str, score: str) -> DataFrame:
    """Count, mean and standard deviation per sector."""
    return df.groupBy(sector).agg(F.count("*").alias("n"), F.avg(score).alias("mean"), F.stddev_samp(score).alias("sd"))


def sector_rows(df: DataFrame, sector: str, score: str, order: str, sectors: list[str] = SECTORS, draws: int = 5000) -> DataFrame:
    """``(sector, n, mean, sd, low, high)``: one row for each sector, also for one without pairs, which has
    n 0 and NaN for the rest."""
    wanted = df.sparkSession.createDataFrame([(s,) for s in sectors], f"`{sector}` string")
    intervals = bootstrap_mean(df, sector, score, order, draws).select(sector, "low", "high")
    rows = wanted.join(sector_summary(df, sector, score), sector, "left").join(intervals, sector, "left")
    nan = F.lit(float("nan"))
    return rows.select(sector, F.coalesce("n", F.lit(0)).alias("n"), *[F.coalesce(c, nan).alias(c) for c in ("mean", "sd", "low", "high")])


def best_per_sector(df: DataFrame, key: str, sector: str, score: str, sectors: list[str] = SECTORS) -> DataFrame:
    """``(key, best_<sector> ...)``: the best score of each sector, null where it has none."""
    return df.groupBy(key).agg(*[F.max(F.when(F.col(sector) == s, F.col(score))).alias(f"best_{s}") for s in sectors])


def sector_gaps(best: DataFrame, key: str, sectors: list[str] = SECTORS) -> DataFrame:
    """Keys that have both sectors, with the gap of the best scores, largest first."""
    a, b = (F.col(f"best_{s}") for s in sectors)
    return best.where(a.isNotNull() & b.isNotNull()).withColumn("gap", a - b).orderBy(F.desc("gap"), key)


def key_metrics(best: DataFrame, sectors: list[str] = SECTORS) -> DataFrame:
    """Rows ``(metric, value)``: how many keys there are, have each sector, have both, and mean bests."""
    a, b = (F.col(f"best_{s}") for s in sectors)
    one = best.agg(
        F.count("*").cast("double").alias("keys"), F.count(a).cast("double").alias(f"with_{sectors[0]}"),
        F.count(b).cast("double").alias(f"with_{sectors[1]}"), F.count(F.when(a.isNotNull() & b.isNotNull(), 1)).cast("double").alias("with_both"),
        F.avg(a).alias(f"mean_{sectors[0]}"), F.avg(b).alias(f"mean_{sectors[1]}"),
    )
    return one.unpivot([], one.columns, "metric", "value")


def composition(df: DataFrame, branch: Column, sector: str, sectors: list[str] = SECTORS) -> DataFrame:
    """Per branch the rows of each sector, their total and the share of the first sector."""
    counts = df.groupBy(branch.alias("branch")).agg(*[F.count_if(F.col(sector) == s).alias(s) for s in sectors])
    total = sum((F.col(s) for s in sectors[1:]), F.col(sectors[0]))
    out = counts.withColumn("total", total).where(F.col("total") > 0)
    return out.withColumn("share", F.col(sectors[0]) / F.col("total")).orderBy(F.desc("total"), "branch")


def source_roots(df: DataFrame, source: str = "source") -> DataFrame:
    """Rows per first part of the source name, most first."""
    root = F.get(F.split(F.col(source), "_"), F.lit(0)).alias("root")
    return df.groupBy(root).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "root")
