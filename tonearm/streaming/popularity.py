"""Song popularity, kept up to date from the stage batches of the ingest, or as a stateful aggregate of a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from tonearm.operators.activity import long_listens
from tonearm.operators.stage import stage_rows
from tonearm.session import shuffles_removed, state_on_disk
from tonearm.sources.store import TableStore

POPULARITY, CURRENT = "song_popularity", "song_popularity_current"


def append_popularity(stage: TableStore, store: TableStore, batch_id: int) -> None:
    """Adds what one stage batch has: stops per song and position.

    The stage holds each message once, so a copy that is sent again counts nothing. Positions are
    judged when the counts are read, so that songs that become known later lose no listens. A batch
    that is run again replaces its counts.
    """
    rows = stage.read("kafka_playback", batches=[batch_id])
    if rows is not None:
        stops = rows.where(F.col("event_type") == "SongStopEvent")
        counts = stops.groupBy("song_id", "event_type", "at_time_sec").agg(F.count(F.lit(1)).alias("stops"))
        store.append(POPULARITY, counts, batch_id)


def read_popularity(store: TableStore, songs: DataFrame) -> DataFrame:
    """Listens per song over all batches, as `listen_count` (the first listen counts as 0)."""
    sums = store.read(POPULARITY).groupBy("song_id", "event_type", "at_time_sec").agg(F.sum("stops").alias("stops"))
    heard = long_listens(sums, songs).groupBy("song_id").agg(F.sum("stops").alias("stops"))
    return heard.select("song_id", (F.col("stops") - 1).alias("listen_count"))


def start_popularity(
    events: DataFrame, store: TableStore, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Keeps the number of stops of each song at each position as the state of a streaming aggregate.

    `events` are decoded messages without copies, as `streaming.unique` gives them. Each batch writes the
    counts that it changed, whole and not as differences, and a batch that is run again writes the same
    ones; `current_popularity` reads the last count of each. The state has one number per song
    and second that was ever stopped at, whatever the number of listens.
    """
    stops = stage_rows(events, "kafka_playback").where(F.col("event_type") == "SongStopEvent")
    counts = stops.groupBy("song_id", "at_time_sec").agg(F.count(F.lit(1)).alias("stops"))

    def upsert(batch: DataFrame, batch_id: int) -> None:
        store.append(CURRENT, batch, batch_id)
        store.commit(batch_id)

    writer = counts.writeStream.outputMode("update").foreachBatch(upsert).option("checkpointLocation", checkpoint)
    with state_on_disk(events.sparkSession), shuffles_removed(events.sparkSession):
        return writer.trigger(**({"processingTime": interval} if interval else {"availableNow": True})).start()


def current_popularity(store: TableStore, songs: DataFrame) -> DataFrame:
    """Listens per song as `listen_count` (the first listen counts as 0), after the last whole batch.

    Songs are joined here and not in the stream, so that songs that become known later lose no listens.
    """
    last = store.last_complete()
    rows = store.read(CURRENT) if last is not None else None
    if rows is None:
        return songs.limit(0).select(F.col("id").alias("song_id"), F.lit(0).cast("long").alias("listen_count"))
    counts = rows.where(F.col("batch_id") <= last).groupBy("song_id", "at_time_sec").agg(F.max_by("stops", "batch_id").alias("stops"))
    heard = long_listens(counts.withColumn("event_type", F.lit("SongStopEvent")), songs)
    return heard.groupBy("song_id").agg((F.sum("stops") - 1).alias("listen_count"))
