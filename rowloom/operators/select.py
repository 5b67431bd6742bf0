"""Choosing rows: first, last and newest per key, coverage of sources, quotas, relative cuts.

Ties are broken by an ordinal or an id that the caller names, so every run gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, key: Column, order: list[Column], last: bool = False) -> DataFrame:
    """The first row of each key by ``order``, or the last.  Null keys form one group, as an
    empty key does in a merge.  An empty table gives an empty result."""
    if last:
        order = [F.desc_nulls_first(c) if isinstance(c, str) else c.desc() for c in order]
    ranked = df.withColumn("__rn", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return ranked.where(F.col("__rn") == 1).drop("__rn")


def latest_two_pass(df: DataFrame, primary: Column, secondary: Column, order: list[Column], tie: Column) -> DataFrame:
    """The newest row per primary key, then of those the newest per secondary key.

    Rows without a secondary key stand for themselves in the second pass.  ``order`` compares
    from left to right, newest is largest; ``tie`` decides among equals, largest wins.
    """
    newest = [c.desc_nulls_last() for c in order] + [tie.desc()]
    one = first_per_key(df.withColumn("__p", primary), F.col("__p"), newest)
    second = F.coalesce(secondary, F.concat(F.lit("\u001f"), F.col("__p")))
    return first_per_key(one.withColumn("__s", second), F.col("__s"), newest).drop("__p", "__s")


def tied_rows(df: DataFrame, key: Column, order: list[Column]) -> DataFrame:
    """``(key, ties)``: how many rows besides one equal the newest row of their key."""
    ranked = df.select(key.alias("key"), F.struct(*order).alias("o")).where("key is not null")
    best = ranked.groupBy("key", "o").agg(F.count("*").alias("n"))
    top = best.groupBy("key").agg(F.max(F.struct("o", "n")).alias("b"))
    return top.select("key", (F.col("b.n") - 1).alias("ties"))


def cover_sources(df: DataFrame, source: str, url: str, order: list[Column], most: int) -> DataFrame:
    """At most ``most`` rows: the best row of each source first, then the best of the rest.

    If all rows fit they are all taken.  Else rows that repeat an address are skipped, the best one
    stays; a null address repeats nothing.  If there are more sources than ``most``, the alphabetically first are kept.
    """
    if df.limit(most + 1).count() <= most:
        return df.orderBy(*order)
    one = Window.partitionBy(F.coalesce(F.col(url), F.concat(F.lit("\u001f"), F.monotonically_increasing_id()))).orderBy(*order)
    rows = df.withColumn("__u", F.row_number().over(one)).where("__u = 1")
    rows = rows.withColumn("__s", F.row_number().over(Window.partitionBy(F.col(source)).orderBy(*order)))
    first = F.when(F.col("__s") == 1, 0).otherwise(1)
    by_source = F.when(F.col("__s") == 1, F.col(source))
    return rows.orderBy(first, by_source.asc_nulls_first(), *order).limit(most).drop("__u", "__s")


def quotas(shares: dict[str, float], total: int, remainder_to: str, caps: dict[str, int] | None = None, spill_to: str | None = None,
           defaults: dict[str, float] | None = None) -> dict[str, int]:
    """Whole numbers per source: shares scaled to one and rounded down, the remainder to one
    source; what a cap cuts off goes to ``spill_to``.  Shares without a positive sum are
    replaced by ``defaults``."""
    used = shares if sum(max(0.0, x) for x in shares.values()) > 0 else (defaults or {k: 1.0 for k in shares})
    whole = sum(max(0.0, x) for x in used.values())
    out = {k: int(total * max(0.0, x) / whole) for k, x in used.items()}
    out[remainder_to] += total - sum(out.values())
    for name, cap in (caps or {}).items():
        if out[name] > cap:
            if spill_to:
                out[spill_to] += out[name] - cap
            out[name] = cap
    return out


def take_quotas(df: DataFrame, source: str, quota: dict[str, int], order: list[Column]) -> DataFrame:
    """The best ``quota[source]`` rows of each source; sources without a quota give none."""
    wanted = F.create_map(*[F.lit(x) for kv in quota.items() for x in kv])
    ranked = df.withColumn("__rn", F.row_number().over(Window.partitionBy(source).orderBy(*order)))
    limit = F.coalesce(F.element_at(wanted, F.col(source)), F.lit(0))
    # The constant bound lets the optimiser prune groups before the shuffle.
    return ranked.where((F.col("__rn") <= max(quota.values(), default=0)) & (F.col("__rn") <= limit)).drop("__rn")


def relative_top(
    df: DataFrame, group: str, score: str, tie: str, k: int = 5, delta: float = 0.10, least: float = 0.28
) -> DataFrame:
    """Rows of each group within ``delta`` of its best score, at least ``least``, at most ``k``.

    The best score of a group is that of its first row in the order of the rank, so one
    sort serves both; ties go to the smaller ``tie``.
    """
    order = Window.partitionBy(group).orderBy(F.col(score).desc(), F.col(tie).asc())
    ranked = df.where(F.col(score) >= least).withColumn("__rn", F.row_number().over(order))
    ranked = ranked.where(F.col("__rn") <= k).withColumn("__best", F.first(score).over(order))
    return ranked.where(F.col(score) >= F.col("__best") - delta).drop("__rn", "__best")
