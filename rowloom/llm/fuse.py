"""One surviving record for each group of duplicates, put together from consistent bundles.

Fields that belong together form a bundle and are taken whole from one row.  Each bundle
takes its most trusted candidate; functional dependencies between bundles may forbid a
combination, and then branch-and-bound finds the allowed one with the highest trust.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.session import cut_lineage


@dataclass(frozen=True)
class Bundle:
    """``trust``: columns compared from left to right, larger is better.  ``signature``: values that
    dependencies speak of.  Within a group the best candidate of a bundle has the trust 1, the others
    less by their rank, so the trusts of bundles with different measures can be added up."""

    name: str
    eligible: Column
    trust: list[Column]
    signature: dict[str, Column] = field(default_factory=dict)


@dataclass(frozen=True)
class Dependency:
    """The value of ``left`` (of one bundle) determines that of ``right`` (of another)."""

    left: str
    right: str


def _owner(bundles: list[Bundle], name: str) -> str:
    return next(b.name for b in bundles if name in b.signature)


def _candidates(rows: DataFrame, bundle: Bundle) -> DataFrame:
    """The best row of each (group, signature) of a bundle.  A row that equals another in all
    that the dependencies see, with less trust, can never be chosen."""
    names = list(bundle.signature)
    part = rows.where(bundle.eligible).select(
        "__key", *[c.cast("string").alias(n) for n, c in bundle.signature.items()],
        F.struct(*[c.alias(f"t{k}") for k, c in enumerate(bundle.trust)], F.col("__id")).alias("best"),
    )
    return part.groupBy("__key", *names).agg(F.max("best").alias("best"))


def search(candidates: dict[str, list[tuple]], allowed: dict[tuple[str, str], dict[str, str]]) -> dict:
    """Best-first branch-and-bound over one candidate per bundle.

    ``candidates``: per bundle ``(trust, id, signature)`` from best to worst.  ``allowed``: for each
    dependency the value of the right side that goes with a left value; unknown and null values are
    free.  The bound of a partial choice is its trust plus the best trust of every open bundle, so the
    first complete choice taken is the best one.  A bundle may stay empty, with trust 0, so there is
    always a choice: where no candidate is allowed beside better ones it is left out.
    """
    order = [b for b, c in candidates.items() if c]
    options = {b: [*candidates[b], (0.0, None, {})] for b in order}
    ahead = [sum(options[b][0][0] for b in order[k:]) for k in range(len(order) + 1)]

    def ok(chosen: list[tuple]) -> bool:
        values = {n: v for c in chosen for n, v in c[2].items()}
        for (left, right), known in allowed.items():
            x, y = values.get(left), values.get(right)
            if x is not None and y is not None and known.get(x, y) != y:
                return False
        return True

    heap = [(-ahead[0], (), 0, [0])] if order else []
    while heap:
        _, ranks, depth, picks = heapq.heappop(heap)
        k = picks[-1]
        chosen = [options[order[i]][p] for i, p in enumerate(picks)]
        here = sum(c[0] for c in chosen[:-1])
        if k + 1 < len(options[order[depth]]):
            worse = options[order[depth]][k + 1]
            heapq.heappush(heap, (-(here + worse[0] + ahead[depth + 1]), (*ranks[:depth], k + 1), depth, [*picks[:-1], k + 1]))
        if not ok(chosen):
            continue
        if depth + 1 == len(order):
            return {b: c[1] for b, c in zip(order, chosen, strict=True) if c[1] is not None}
        heapq.heappush(heap, (-(here + chosen[-1][0] + ahead[depth + 1]), (*ranks[:depth], k, 0), depth + 1, [*picks, 0]))
    return {}


def fuse_groups(
    df: DataFrame, key: str, id_col: str, bundles: list[Bundle],
    dependencies: list[Dependency] | None = None, least: int = 2,
) -> DataFrame:
    """Rows ``(key, <bundle>_id ...)``: the row each bundle is taken from, 0 if none qualifies or none
    is allowed beside the others.

    * Only groups of ``least`` rows or more; rows with a null key belong to no group.
    * The last trust column is followed by the id, so trusts must make the order total;
      a tie left open goes to the larger id.
    * Repeated rows count as rows; an empty table gives an empty result; other columns of
      ``df`` are not read unless a bundle names them.

    The best candidates come from one aggregation with map-side combine, so a group of any
    size costs its task only one row per map task.  That is the root of the search: its bound is
    reached where the best candidates agree with all dependencies.  Other groups are branched on,
    with their candidates reduced to one per signature, so a group of any size costs as many as it
    has different values.  The allowed right value of a left value is the one that most rows of the
    whole table have.
    """
    dependencies = dependencies or []
    rows = df.where(F.col(key).isNotNull()).withColumn("__key", F.col(key)).withColumn("__id", F.col(id_col))
    best = [
        F.max(F.when(b.eligible, F.struct(
            *[c.alias(f"t{k}") for k, c in enumerate(b.trust)],
            F.struct("__id", *[c.cast("string").alias(n) for n, c in b.signature.items()]).alias("pick"),
        ))).alias(b.name)
        for b in bundles
    ]
    top = rows.groupBy("__key").agg(F.count("*").alias("__n"), *best).where(F.col("__n") >= least)
    ids = [F.coalesce(F.col(f"`{b.name}`.pick.__id"), F.lit(0)).alias(f"{b.name}_id") for b in bundles]
    if not dependencies:
        return top.select(F.col("__key").alias(key), *ids)

    # The best candidates and the broken groups are written once; all that follows reads them.
    top = cut_lineage(top)

    # What goes with what, by majority over all rows.
    sides = {n: c.cast("string") for b in bundles for n, c in b.signature.items()}
    maps: dict[tuple[str, str], DataFrame] = {}
    for d in dependencies:
        pairs = rows.select(sides[d.left].alias("x"), sides[d.right].alias("y")).where("x is not null and y is not null")
        counts = pairs.groupBy("x", "y").agg(F.count("*").alias("n"))
        maps[d.left, d.right] = counts.groupBy("x").agg(F.max(F.struct("n", "y")).alias("m")).select("x", F.col("m.y").alias("y"))
    broken = None
    for (left, right), known in maps.items():
        value = lambda n: F.col(f"`{_owner(bundles, n)}`.pick.`{n}`")
        wrong = top.select("__key", value(left).alias("x"), value(right).alias("z")).join(known, "x")
        wrong = wrong.where("z is not null and z <> y").select("__key")
        broken = wrong if broken is None else broken.unionByName(wrong)
    broken = cut_lineage(broken.distinct())

    union = None
    for b in bundles:
        part = _candidates(rows.join(broken, "__key", "left_semi"), b)
        signature = F.to_json(F.struct(*b.signature)) if b.signature else F.lit("{}")
        trusts = [F.col(f"best.t{k}").cast("double").alias(f"t{k}") for k in range(len(b.trust))]
        part = part.select(
            "__key", F.lit(b.name).alias("bundle"), F.array(*trusts).alias("trust"),
            F.col("best.__id").alias("id"), signature.alias("signature"),
        )
        union = part if union is None else union.unionByName(part)
    union = cut_lineage(union)
    rules = None
    for (left, right), known in maps.items():
        part = union.select("__key", F.explode(F.array(F.get_json_object("signature", f"$.{left}"))).alias("x"))
        part = part.where("x is not null").distinct().join(known, "x").groupBy("__key").agg(
            F.to_json(F.map_from_entries(F.collect_list(F.struct("x", "y")))).alias("known")
        ).select("__key", F.lit(f"{left}\x1f{right}").alias("rule"), "known")
        rules = part if rules is None else rules.unionByName(part)
    rules = cut_lineage(rules)
    names = [b.name for b in bundles]
    kinds = dict(df.dtypes)

    def solve(keys: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        import json

        ranked: dict[str, list[tuple]] = {n: [] for n in names}
        for row in left.itertuples(index=False):
            trust = tuple(float("-inf") if x is None else x for x in row.trust)
            ranked[row.bundle].append((trust, row.id, json.loads(row.signature)))
        candidates: dict[str, list[tuple]] = {}
        for n, c in ranked.items():
            c.sort(key=lambda x: x[:2], reverse=True)
            candidates[n] = [(1 - k / len(c), i, signature) for k, (_, i, signature) in enumerate(c)]
        allowed = {tuple(r.rule.split("\x1f")): json.loads(r.known) for r in right.itertuples(index=False)}
        chosen = search(candidates, allowed)
        return pd.DataFrame({key: [keys[0]], **{f"{n}_id": [chosen.get(n, 0)] for n in names}})

    schema = f"`{key}` {kinds[key]}, " + ", ".join(f"`{n}_id` {kinds[id_col]}" for n in names)
    solved = union.groupBy("__key").cogroup(rules.groupBy("__key")).applyInPandas(solve, schema)
    easy = top.join(broken, "__key", "left_anti").select(F.col("__key").alias(key), *ids)
    large = top.select(F.col("__key").alias(key))
    return easy.unionByName(solved.join(large, key, "left_semi"))
