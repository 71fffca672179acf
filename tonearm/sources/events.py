"""Message sources and sinks: Kafka topics, or folders with one JSON message per line."""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from tonearm.operators.stage import encode_event
from tonearm.schemas import STAGE_TABLES
from tonearm.session import shuffles_removed

log = logging.getLogger(__name__)

# fixed value: topic the producers write to
TOPIC = "dwh_events"

OFFSETS_PER_BATCH = 20_000_000
FILES_PER_BATCH = 1000


def read_events(
    spark: SparkSession,
    folder: str | None = None,
    servers: str | None = None,
    topic: str = TOPIC,
    per_batch: int | None = None,
) -> DataFrame:
    """Streaming frame with `value` and `arrived`, from the start of the topic or folder.

    `per_batch` bounds a micro-batch: offsets of a topic, files of a folder. A long backlog
    is thus read in steps, each of which is stored before the next. The streaming checkpoint
    remembers the position, so a restart goes on where it stopped.
    """
    if servers is not None:
        reader = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic)
            .option("startingOffsets", "earliest")
        )
        reader = reader.option("maxOffsetsPerTrigger", per_batch or OFFSETS_PER_BATCH)
        messages = reader.load().select("value")
    else:
        reader = spark.readStream.format("text")
        reader = reader.option("maxFilesPerTrigger", per_batch or FILES_PER_BATCH)
        messages = reader.load(folder).select("value")
    return messages.withColumn("arrived", F.current_timestamp())


def publish_events(
    messages: DataFrame, folder: str | None = None, servers: str | None = None, topic: str = TOPIC,
    required: bool = False,
) -> bool:
    """Sends messages; as with the producers, a failure is logged and not raised unless `required`. Files of a
    folder are compressed, as batches of a topic are."""
    try:
        if servers is not None:
            writer = messages.select("value").write.format("kafka")
            writer.option("kafka.bootstrap.servers", servers).option("topic", topic).save()
        else:
            with shuffles_removed(messages.sparkSession):
                messages.select("value").write.mode("append").text(folder, compression="gzip")
        return True
    except Exception:
        if required:
            raise
        log.exception("publishing events failed")
        return False


def messages_of(stage: Mapping[str, DataFrame], tables: list[str] | None = None) -> DataFrame:
    """Stage rows as the messages they came from."""
    out = None
    for table in STAGE_TABLES.values():
        if tables is not None and table.name not in tables:
            continue
        for event_type in table.event_types:
            rows = stage[table.name]
            if len(table.event_types) > 1:
                rows = rows.where(F.col("event_type") == event_type)
            encoded = encode_event(rows, event_type)
            out = encoded if out is None else out.unionByName(encoded)
    return out
