"""Message stream -> stage tables, and on to the warehouse, one micro-batch at a time."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tonearm.operators.stage import (
    decode_envelope,
    dedupe_events,
    event_month,
    judge_events,
    quarantined_events,
    stage_rows,
    unrouted_events,
    with_event_id,
)
from tonearm.plans.load_plan import run_load_plan
from tonearm.session import shuffles_removed, state_on_disk
from tonearm.sources.store import COMPRESSION, TableStore
from tonearm.streaming.unique import unique_within

QUARANTINE, UNROUTED, EVENT_IDS = "quarantine", "unrouted", "event_ids"


def _id() -> Column:
    """What is kept of a stored event to find its copies: the bytes of its id, and its month (`event_month`)."""
    return F.unhex("event_id").alias("id")


def known_among(events: DataFrame, earlier: DataFrame) -> DataFrame:
    """The ids of events that are in `earlier`, the stored ids of earlier batches, too."""
    same = F.col("known_id").eqNullSafe(F.col("id"))
    return earlier.select(F.col("id").alias("known_id")).join(events.select(_id()), same, "left_semi")


def drop_known(events: DataFrame, known: DataFrame, months: Sequence[int]) -> DataFrame:
    """Events (one copy each) whose id is not in `known`. Those of other months than `months`, the months in which
    there are known ones at all, go through without being looked up."""
    held = F.col("event_month").isin(*months)
    named = events.where(held).withColumn("id", _id())
    unknown = named.join(known, F.col("known_id").eqNullSafe(F.col("id")), "left_anti").drop("id")
    return events.where(~held).unionByName(unknown)


def append_stage(events: DataFrame, store: TableStore, batch_id: int, at_once: int = 8, unique: bool = False) -> None:
    """Decoded events of one batch -> one append per stage table, quarantine and unrouted.

    The batch is read, freed of copies and judged once, and written to a draft, one folder per target, from
    which the tables are written; the draft goes when they are. Executors hold none of it, and files of a
    coder for text take less room than blocks of a cache. Which targets and months have rows at all is
    found first (at most one line for each reaches the driver), so an empty or narrow batch
    starts few jobs.

    The ids of all batches are kept by event month, and a copy has the month of its original; so only the months
    that this batch and earlier ones have are read, however old they are. A batch that is run again sees the same
    earlier batches, and each write replaces only its own batch folder: a repeated batch leaves no second copy.
    `unique` says that the events are free of copies already; then no ids are looked up or kept.
    """
    with shuffles_removed(events.sparkSession, store.spark), store.draft(batch_id) as folder:
        once = events.select("event_id", "type", "data") if unique else dedupe_events(events)
        refused = F.size("missing") > 0
        target = F.when(refused, QUARANTINE).otherwise(F.coalesce("stage_table", F.lit(UNROUTED)))
        judged = judge_events(once).withColumns({"target": target, "event_month": event_month(F.col("data"))})
        # an id follows from type and data, and is made again where it is read
        judged.drop("event_id").write.mode("overwrite").partitionBy("target").parquet(folder, compression=COMPRESSION)
        columns = T.StructType([f for f in judged.schema if f.name != "event_id"])
        draft = with_event_id(store.spark.read.schema(columns).parquet(folder))
        told = draft.groupBy("target", "event_month").count().persist(StorageLevel.MEMORY_AND_DISK)
        known = None
        try:
            present = [row.target for row in told.select("target").distinct().collect()]
            months = [row.event_month for row in told.select("event_month").distinct().collect()]
            earlier = None if unique else store.read(EVENT_IDS, before_batch=batch_id)
            stored = set() if earlier is None else store.parts(EVENT_IDS, "event_month")
            held = [m for m in months if m in stored]
            fresh = draft
            if held:
                inside = F.col("event_month").isin(*held)
                known = known_among(draft.where(inside), earlier.where(inside)).persist(StorageLevel.MEMORY_AND_DISK)
                fresh = drop_known(draft, known, held)

            def write(name: str) -> None:
                mine = fresh.where(F.col("target") == name)
                if name == EVENT_IDS:
                    store.append(name, fresh.select(_id(), "event_month"), batch_id, month="event_month")
                elif name == QUARANTINE:
                    store.append(name, quarantined_events(mine), batch_id)
                elif name == UNROUTED:
                    store.append(name, unrouted_events(mine), batch_id)
                else:
                    rows = stage_rows(mine, name)
                    made = {c: c for c in rows.columns} | {"event_id": F.lower(F.hex("_event"))}
                    rows = rows.withColumn("_event", F.unhex("event_id")).drop("event_id")
                    store.append(name, rows, batch_id, "event_time", made=made)

            with ThreadPoolExecutor(at_once) as pool:
                list(pool.map(write, present + [EVENT_IDS] if present and not unique else present))
            store.commit(batch_id)
        finally:
            told.unpersist()
            if known is not None:
                known.unpersist()


def start_ingest(
    messages: DataFrame,
    stage: TableStore,
    checkpoint: str,
    vault: TableStore | None = None,
    interval: str | None = None,
    after_batch: Callable[[int], None] | None = None,
    within: str | None = None,
    **options,
) -> StreamingQuery:
    """Starts the ingest; with `vault`, each batch is loaded to the warehouse as well, with the
    `options` of the load plan. `after_batch` is called with the number of each stored batch.

    Without `interval` everything available is read, in bounded batches, and the query ends; with it,
    the query runs on until it is stopped (`streaming.progress.serve`).

    Copies are found among the ids of all stored messages. With `within`, a delay, they are found by
    the state of the stream instead (`streaming.unique`): it is bounded by the messages of that time, no
    batch reads earlier ones, and what comes later than the delay is dropped and counted.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        append_stage(batch, stage, batch_id, unique=within is not None)
        if vault is not None:
            run_load_plan(stage, vault, batch_id, **options)
        if after_batch is not None:
            after_batch(batch_id)

    events = decode_envelope(messages)
    if within is not None:
        events = unique_within(events, within)
    writer = events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    with state_on_disk(messages.sparkSession):
        return writer.trigger(**trigger).start()
