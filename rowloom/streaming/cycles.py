"""Postings as a stream: every micro-batch is one cycle of the upsert.

The checkpoint of the query gives what a lock file would: one writer, and a cycle that is
repeated after a failure.  Because a version of the state counts only when it is complete and
the upsert of equal rows changes nothing, repeating a cycle is harmless.  A cycle reads the keys
of the stored rows and writes the buckets that it changes.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rowloom.functions.dates import in_window
from rowloom.functions.keys import payload_hash, secondary_key, storage_key
from rowloom.operators.state import StateTable, changes, upsert_actions
from rowloom.session import cut_lineage
from rowloom.sources.records import JOB_COLUMNS, clean_records


def keyed(records: DataFrame, order: Column | None = None) -> DataFrame:
    """Records with their keys, hash and ordinal; records that nothing identifies are dropped."""
    rows = records.withColumns({
        "job_key": storage_key(), "secondary_key": secondary_key(), "payload_hash": payload_hash(JOB_COLUMNS),
        "__ordinal": F.coalesce(order.cast("string"), F.lit("")) if order is not None else F.coalesce("scraped_at", F.lit("")),
    })
    return rows.where(F.col("job_key").isNotNull())


def rejected(records: DataFrame) -> DataFrame:
    """Records that have no key."""
    return records.where(storage_key().isNull())


def run_cycle(batch: DataFrame, state: StateTable, as_of: str | None = None, clean: bool = True) -> dict[str, int]:
    """One cycle: clean, key, upsert, write the changed buckets; gives the counts of the actions.
    Records are cleaned once; a caller that has done so says ``clean=False``."""
    at = F.lit(as_of or datetime.now(UTC).isoformat())
    rows = cut_lineage(keyed(clean_records(batch) if clean else batch))
    stored = state.read()
    actions = cut_lineage(upsert_actions(rows, stored))
    done = {r.action: r["count"] for r in actions.groupBy("action").count().collect()}
    if done:
        state.merge(*map(cut_lineage, changes(actions, stored, at)))
    return {k: done.get(k, 0) for k in ("inserted", "updated", "unchanged")}


def start_cycles(
    stream: DataFrame, state: StateTable, checkpoint: str, available_now: bool = True, interval: str = "10 minutes",
    stagnation: int | None = None, on_stagnation: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """Runs a cycle per micro-batch; after ``stagnation`` cycles without a change it calls back."""
    idle = [0]

    def cycle(batch: DataFrame, _: int) -> None:
        counts = run_cycle(batch, state)
        idle[0] = 0 if counts["inserted"] + counts["updated"] else idle[0] + 1
        if stagnation and idle[0] >= stagnation and on_stagnation:
            on_stagnation(idle[0])

    writer = stream.writeStream.foreachBatch(cycle).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()


def read_landing(spark: SparkSession, path: str, schema: str, files_per_cycle: int = 100) -> DataFrame:
    """JSON files as they arrive in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_cycle).json(path)


def stagnation_runs(cycles: DataFrame, order: str, changed: str, least: int) -> DataFrame:
    """Runs of at least ``least`` consecutive cycles without a change: ``(run_start, run_end, n)``.

    Gaps and islands; a run is found from the change before it.  Cycles are few, one row each."""
    by = Window.orderBy(order)
    marked = cycles.withColumn("island", F.sum((F.col(changed) > 0).cast("int")).over(by)).where(F.col(changed) == 0)
    runs = marked.groupBy("island").agg(F.min(order).alias("run_start"), F.max(order).alias("run_end"), F.count("*").alias("n"))
    return runs.where(F.col("n") >= least).select("run_start", "run_end", "n")


def night_events(events: DataFrame, ts: str, start: str = "22:00", end: str = "07:30", zone: str = "Europe/Madrid") -> DataFrame:
    """Adds ``active``: whether the local time lies in the window."""
    return events.withColumn("active", in_window(F.col(ts), start, end, zone))


def dedupe_stream(stream: DataFrame, key: list[str], ts: str, horizon: str = "7 days") -> DataFrame:
    """Drops repetitions of a key within a horizon of event time, with bounded state."""
    return stream.withWatermark(ts, horizon).dropDuplicatesWithinWatermark(key)


def windowed_counts(events: DataFrame, ts: str, group: str, width: str, slide: str | None = None, late: str | None = None) -> DataFrame:
    """Counts per group and event-time window; works on tables and streams."""
    rows = events.withWatermark(ts, late) if late else events
    span = F.window(ts, width, slide) if slide else F.window(ts, width)
    counts = rows.groupBy(span.alias("w"), group).agg(F.count("*").alias("n"))
    return counts.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), group, "n")


def sessions(events: DataFrame, ts: str, group: str, gap: str, late: str | None = None) -> DataFrame:
    """Sessions of a group that end after a gap without events."""
    rows = events.withWatermark(ts, late) if late else events
    found = rows.groupBy(F.session_window(ts, gap).alias("w"), group).agg(F.count("*").alias("n"))
    return found.select(group, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")
