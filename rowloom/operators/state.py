"""State tables kept by content: upsert, compaction, stale rows.

A state is a folder of numbered versions.  Rows lie in buckets by a hash of their key, and a
version names for each bucket the folder that holds it, so an upsert writes only the buckets
it changes.  A version becomes current when its manifest is there: readers and failed writers
never see half a state, and a folder that is read is never overwritten.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rowloom.operators.select import first_per_key, latest_two_pass

#: Buckets of a new state; a large one is given more.  A state keeps the number it was made with.
BUCKETS = 32
#: Columns that identify a row of a state.
KEYS = ("pair_key", "cache_key", "job_key")


class StateTable:
    """Versions of a table under one folder, in buckets by the hash of ``key``.

    Without ``key`` the first of ``KEYS`` among the columns is taken; a table that has none of them
    is spread by the hash of its rows and can only be replaced."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType | str, key: str | None = None, buckets: int = BUCKETS) -> None:
        self.spark, self.path, self._buckets = spark, path.rstrip("/"), buckets
        self.schema = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
        self.key = key or next((k for k in KEYS if k in self.schema.names), None)

    def _fs(self):
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        return root.getFileSystem(self.spark._jsc.hadoopConfiguration()), jvm

    def _at(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _names(self, folder: str = "") -> list[str]:
        fs, _ = self._fs()
        at = self._at(folder) if folder else self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []

    def versions(self) -> list[int]:
        found = [re.fullmatch(r"manifest-(\d+)\.json", n) for n in self._names()]
        return sorted(int(m[1]) for m in found if m)

    def _manifest(self, version: int) -> dict:
        fs, jvm = self._fs()
        stream = fs.open(self._at(f"manifest-{version}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _publish(self, version: int, buckets: int, folders: dict[str, str]) -> int:
        fs, jvm = self._fs()
        draft = self._at(f".manifest-{version}")
        stream = fs.create(draft, True)
        stream.write(bytearray(json.dumps({"buckets": buckets, "folders": folders}).encode()))
        stream.close()
        if not fs.rename(draft, self._at(f"manifest-{version}.json")):
            raise RuntimeError(f"another writer has made version {version}")
        return version

    def _current(self) -> tuple[int, int, dict[str, str]]:
        found = self.versions()
        if not found:
            return 0, self._buckets, {}
        m = self._manifest(found[-1])
        return found[-1], m["buckets"], m["folders"]

    def _read(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{f}" for f in sorted(folders)])

    def read(self) -> DataFrame:
        return self._read(list(self._current()[2].values()))

    def bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(*([self.key] if self.key else self.schema.names)), F.lit(buckets))

    def _write(self, df: DataFrame, version: int, buckets: int) -> dict[str, str]:
        out = df.select(*self.schema.names, self.bucket(buckets).alias("__bucket"))
        out.repartition("__bucket").write.mode("overwrite").partitionBy("__bucket").parquet(f"{self.path}/v{version}")
        return {n.split("=")[1]: f"v{version}/{n}" for n in self._names(f"v{version}") if n.startswith("__bucket=")}

    def write(self, df: DataFrame) -> int:
        """Replace the state by ``df``."""
        version, buckets, _ = self._current()
        return self._publish(version + 1, buckets, self._write(df, version + 1, buckets))

    def merge(self, fresh: DataFrame, gone: DataFrame) -> int:
        """Add ``fresh`` and drop the rows with a key of ``gone``; other buckets stay where they are."""
        if self.key is None:
            raise ValueError("a state without a key can only be replaced")
        version, buckets, folders = self._current()
        keys = fresh.select(self.key).unionByName(gone.select(self.key))
        touched = {str(r.b) for r in keys.select(self.bucket(buckets).alias("b")).distinct().collect()}
        kept = self._read([f for b, f in folders.items() if b in touched]).join(gone.select(self.key).distinct(), self.key, "left_anti")
        new = self._write(kept.unionByName(fresh.select(*self.schema.names)), version + 1, buckets)
        return self._publish(version + 1, buckets, {b: f for b, f in folders.items() if b not in touched} | new)

    def forget(self, keep: int = 2) -> None:
        """Delete all but the newest versions, and the folders that none of those names."""
        fs, _ = self._fs()
        found = self.versions()
        used = {f for v in found[-keep:] for f in self._manifest(v)["folders"].values()}
        for v in found[:-keep]:
            fs.delete(self._at(f"manifest-{v}.json"), False)
            for name in self._names(f"v{v}"):
                if f"v{v}/{name}" not in used:
                    fs.delete(self._at(f"v{v}/{name}"), True)


def match_state(batch: DataFrame, state: DataFrame) -> DataFrame:
    """``(job_key, __old, __at, __first, __old_hash)``: for each incoming row every stored row that it
    means, by equal primary or equal secondary key.  Two equi-joins, never a join with OR; a null
    secondary key matches nothing."""
    stored = state.select(
        F.col("job_key").alias("__old"), F.col("secondary_key").alias("__sec"), F.col("updated_at").alias("__at"),
        F.col("first_seen_at").alias("__first"), F.col("payload_hash").alias("__old_hash"),
    )
    by_key = batch.select("job_key").join(stored, F.col("job_key") == F.col("__old"))
    by_second = batch.select("job_key", "secondary_key").join(stored, F.col("secondary_key") == F.col("__sec"))
    columns = ["job_key", "__old", "__at", "__first", "__old_hash"]
    return by_key.select(*columns).unionByName(by_second.select(*columns)).distinct()


def upsert_actions(batch: DataFrame, state: DataFrame) -> DataFrame:
    """Incoming rows with ``action``: ``inserted``, ``unchanged`` (same hash) or ``updated``.

    Within the batch the last row of a key by ``__ordinal`` counts, then of rows that share a
    secondary key the last; the batch needs ``job_key, secondary_key, payload_hash, __ordinal``.
    An incoming row is compared with the newest stored row that it means (``__old``, null if
    there is none); ``__replaced`` lists all of them and ``__first`` is their first sighting.
    """
    last = latest_two_pass(
        batch.where(F.col("job_key").isNotNull()), F.col("job_key"), F.col("secondary_key"), [F.col("__ordinal")], F.col("payload_hash")
    )
    found = match_state(last, state).groupBy("job_key").agg(
        F.max(F.struct("__at", "__old", "__old_hash")).alias("__m"), F.collect_set("__old").alias("__replaced"), F.min("__first").alias("__first")
    )
    joined = last.join(found, "job_key", "left").withColumn("__old", F.col("__m.__old"))
    same = F.col("payload_hash") == F.col("__m.__old_hash")
    action = F.when(F.col("__old").isNull(), "inserted").when(same, "unchanged").otherwise("updated")
    # Of incoming rows that mean one stored row the last one replaces it.
    keyed = joined.withColumn("action", action).withColumn("__slot", F.coalesce("__old", F.concat(F.lit("\u001f"), "job_key")))
    return first_per_key(keyed, F.col("__slot"), [F.desc("__ordinal"), F.col("job_key")]).drop("__slot", "__m")


def changes(actions: DataFrame, state: DataFrame, as_of: Column) -> tuple[DataFrame, DataFrame]:
    """What ``actions`` do to a state: rows to add, and keys of rows to drop before.

    An updated row takes the place of every stored row that it means and keeps their earliest
    ``first_seen_at``.  An unchanged row is only a sighting: the stored row keeps its key, values
    and ``updated_at`` and gets the new ``last_seen_at`` and ``secondary_key``; if another incoming
    row replaces it, it is gone."""
    at = as_of.cast("string")
    fresh = actions.where("action <> 'unchanged'").withColumns({"first_seen_at": F.coalesce("__first", at), "last_seen_at": at, "updated_at": at})
    replaced = actions.where("action = 'updated'").select(F.explode("__replaced").alias("job_key")).distinct()
    seen = actions.where("action = 'unchanged'").select(F.col("__old").alias("job_key"), F.col("secondary_key").alias("__second"))
    seen = seen.join(replaced, "job_key", "left_anti")
    touched = state.join(seen, "job_key").withColumns({"last_seen_at": at, "secondary_key": F.col("__second")})
    return fresh.select(*state.columns).unionByName(touched.select(*state.columns)), replaced.unionByName(seen.select("job_key"))


def apply_actions(actions: DataFrame, state: DataFrame, as_of: Column) -> DataFrame:
    """The new state after ``upsert_actions``."""
    fresh, gone = changes(actions, state, as_of)
    return state.join(gone, "job_key", "left_anti").unionByName(fresh)


def upsert(batch: DataFrame, state: DataFrame, as_of: Column) -> tuple[DataFrame, DataFrame]:
    """The new state and the counts ``(action, n)``."""
    done = upsert_actions(batch, state)
    return apply_actions(done, state, as_of), done.groupBy("action").agg(F.count("*").alias("n"))


def compact(state: DataFrame) -> DataFrame:
    """One row per posting: the newest by update, publication and storage date, then by hash, then by
    key and, of equal rows, the last seen."""
    order = [F.coalesce(c, F.lit("")) for c in ("update_date", "publication_date", "updated_at", "payload_hash")]
    return latest_two_pass(state, F.col("job_key"), F.col("secondary_key"), order, F.struct("job_key", *[c for c in ("last_seen_at", "first_seen_at", "row_id") if c in state.columns]))


def upsert_pairs(batch: DataFrame, state: DataFrame, as_of: Column) -> tuple[DataFrame, DataFrame]:
    """Scored pairs merged by ``pair_key``; a stored pair counts as updated even if equal."""
    last = first_per_key(batch.where(F.col("pair_key").isNotNull()), F.col("pair_key"), [F.col("score").desc_nulls_last(), F.col("degree_key")])
    old = state.select("pair_key", F.col("created_at").alias("__created"))
    joined = last.join(old, "pair_key", "left").withColumn("action", F.when(F.col("__created").isNull(), "inserted").otherwise("updated"))
    at = as_of.cast("string")
    fresh = joined.withColumns({"created_at": F.coalesce("__created", at), "updated_at": at})
    kept = state.join(last.select("pair_key"), "pair_key", "left_anti")
    return kept.unionByName(fresh.select(*state.columns)), joined.groupBy("action").agg(F.count("*").alias("n"))


def stale_pairs(state: DataFrame, keep: DataFrame, provider: str, model: str) -> DataFrame:
    """Stored pairs of one provider and model that are not among the kept keys."""
    scope = state.where((F.col("provider") == provider) & (F.col("model") == model))
    return scope.join(keep.select("pair_key").distinct(), "pair_key", "left_anti")


def drop_stale_pairs(state: DataFrame, keep: DataFrame, provider: str, model: str) -> DataFrame:
    return state.join(stale_pairs(state, keep, provider, model).select("pair_key"), "pair_key", "left_anti")


def upsert_cache(cache: DataFrame, new: DataFrame, as_of: Column) -> DataFrame:
    """Vectors added by ``cache_key``; a stored one is replaced but keeps its creation time."""
    at = as_of.cast("string")
    old = cache.select("cache_key", F.col("created_at").alias("__created"))
    fresh = new.dropDuplicates(["cache_key"]).join(old, "cache_key", "left")
    fresh = fresh.withColumns({"created_at": F.coalesce("__created", at), "updated_at": at})
    return cache.join(new.select("cache_key"), "cache_key", "left_anti").unionByName(fresh.select(*cache.columns))
