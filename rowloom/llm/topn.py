"""The N best items of every group, with one tie rule, however large a group is."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_n_per_group(df: DataFrame, group: str, item: str, score: str, n: int = 5) -> DataFrame:
    """Rows ``(group, item, score, rank)`` of the ``n`` best distinct items of each group.

    An item that occurs several times in a group counts with its highest score.  Ties go
    to the item that is smaller in byte order, so every run gives the same rows.

    * Null and NaN scores do not count; a group with no other score gives no row.
    * Rows with a null group or item belong nowhere and give no row.
    * Repeated rows count once.  An empty table gives an empty result.
    * Other columns of ``df`` are not read, whatever their names.

    The first aggregation is keyed by (group, item), so a hot group is spread over all
    tasks and combined before the shuffle.  The rank filter lets the optimiser put a group
    limit before the second shuffle: of a group at most ``n`` rows per task are moved.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    rows = df.select(
        F.col(group).alias("__g"), F.col(item).alias("__i"), F.col(score).cast("double").alias("__s")
    ).where(F.col("__g").isNotNull() & F.col("__i").isNotNull() & F.col("__s").isNotNull() & ~F.isnan("__s"))
    best = rows.groupBy("__g", "__i").agg(F.max("__s").alias("__s"))
    order = Window.partitionBy("__g").orderBy(F.col("__s").desc(), F.col("__i").asc())
    ranked = best.withColumn("__r", F.row_number().over(order)).where(F.col("__r") <= n)
    return ranked.select(
        F.col("__g").alias(group), F.col("__i").alias(item), F.col("__s").alias(score), F.col("__r").alias("rank")
    )
