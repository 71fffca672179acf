"""Messages without copies, by event time and a bounded state.

The other way to free a stream of copies, the table of all ids in `streaming.ingest`, finds a copy
however late it comes and keeps one row per message for ever. Here the state store keeps the id of
a message until the watermark has passed its event time by the given delay, so that state is as large
as the messages of that time span, not as the whole stream. What comes later than the delay is
dropped as late, copy or not, and counted (`streaming.progress`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tonearm.operators.stage import decode_envelope
from tonearm.session import shuffles_removed, state_on_disk
from tonearm.sources.store import COMPRESSION

MOMENT = "moment"
UNIQUE = "event_id string, type string, data string"


def event_moment() -> Column:
    """Event time of a payload, as the zoned type that watermarks need, and not later than its arrival, so that
    a wrong clock can't carry the watermark into the future. NULL where the payload has no time."""
    moment = F.get_json_object("data", "$.event_time").try_cast("timestamp")
    return F.when(moment > F.col("arrived"), F.col("arrived")).otherwise(moment)


def unique_within(decoded: DataFrame, delay: str) -> DataFrame:
    """One copy per event id, as long as copies come within `delay` of the newest event time seen.

    Equal messages have equal event times, so that a copy is either found in the state or late. A message
    without an event time (no table takes such a one) moves no watermark and is never late; its copies
    are found within a batch only. On a batch frame this is a plain removal of copies.
    """
    timed = decoded.withColumn(MOMENT, event_moment()).withWatermark(MOMENT, delay)
    if not decoded.isStreaming:
        return timed.dropDuplicates(["event_id"]).drop(MOMENT, "arrived")
    # the state and its shuffle have the bytes of the id, of which it is made again
    named = timed.withColumn("id", F.unhex("event_id")).select("id", "type", "data", MOMENT)
    once = named.dropDuplicatesWithinWatermark(["id"])
    return once.select(F.lower(F.hex("id")).alias("event_id"), "type", "data")


def start_unique(messages: DataFrame, target: str, checkpoint: str, delay: str, interval: str | None = None) -> StreamingQuery:
    """Writes unique messages to the folder `target`, each once also over restarts; see `read_unique`.

    The sink lists its files in a log of its own, so that readers see whole batches only.
    """
    rows = unique_within(decode_envelope(messages), delay)
    writer = rows.writeStream.format("parquet").option("compression", COMPRESSION).option("checkpointLocation", checkpoint).option("path", target)
    with state_on_disk(messages.sparkSession), shuffles_removed(messages.sparkSession):
        return writer.trigger(**({"processingTime": interval} if interval else {"availableNow": True})).start()


def read_unique(spark: SparkSession, target: str, per_batch: int = 1000) -> DataFrame:
    """The unique messages as a stream, `per_batch` files at a time."""
    return spark.readStream.schema(UNIQUE).option("maxFilesPerTrigger", per_batch).parquet(target)
