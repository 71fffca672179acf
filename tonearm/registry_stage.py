"""Registered queries of the ingest layer: message operators, streams, stored loads."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tonearm.operators import stage as ops
from tonearm.plans.asof import CATALOGUE_SATS, HISTORY
from tonearm.plans.histories import fold_histories, read_history, refresh_histories
from tonearm.plans.load_plan import VAULT_TABLES, load_one, run_load_plan
from tonearm.plans.specs import BY_TARGET
from tonearm.registry import CUT_DT, Context, Query, lists_as_json, query
from tonearm.schemas import STAGE_TABLES
from tonearm.session import shared_folder
from tonearm.sources.events import messages_of, publish_events, read_events
from tonearm.sources.fixtures import edge_messages, with_history
from tonearm.sources.store import StoredTables, TableStore
from tonearm.streaming.ingest import QUARANTINE, UNROUTED, append_stage, start_ingest
from tonearm.streaming.popularity import append_popularity, current_popularity, read_popularity, start_popularity
from tonearm.streaming.progress import serve
from tonearm.streaming.unique import UNIQUE, read_unique, start_unique


def _edges(c: Context) -> DataFrame:
    """All messages of the stage tables, and the edge cases."""
    return ops.decode_envelope(messages_of(c.stage).unionByName(edge_messages(c.given)))


def _messages(c: Context, *tables: str) -> DataFrame:
    own = messages_of(c.stage, list(tables) or None)
    return ops.dedupe_events(ops.decode_envelope(own.unionByName(edge_messages(c.given))))


def _stage_query(name: str) -> Query:
    return query(lambda c: ops.stage_rows(_messages(c, name), name))


def _refused_playback(c: Context) -> DataFrame:
    table = STAGE_TABLES["kafka_playback"]
    return ops.enforce_required(ops.project_payload(_edges(c), table), table)[1]


def _event_times(c: Context) -> DataFrame:
    override = F.when(F.col("event_id") % 2 == 0, F.col("ts"))
    requests = c.given["events"].select(
        "event_id", override.alias("override_time"), F.lit(CUT_DT).cast("timestamp_ntz").alias("ingest_time")
    )
    return ops.resolve_event_time(requests, "override_time", "ingest_time").select("event_id", "event_time")


def _stored(c: Context) -> DataFrame:
    """All stage tables written in two batches (one of them twice) and read back."""
    store = TableStore(c.spark, shared_folder(c.spark, "append"))
    early = F.col("event_time") < F.lit(CUT_DT).cast("timestamp_ntz")
    for name, rows in c.stage.items():
        store.append(name, rows.where(early), 0, "event_time")
        for _ in range(2):
            store.append(name, rows.where(~early), 1, "event_time")
    return _summary(dict(StoredTables(store, tuple(c.stage))))


def _compacted(c: Context) -> DataFrame:
    """All stage tables written in four batches, the first three rewritten as one, and their folders dropped."""
    store = TableStore(c.spark, shared_folder(c.spark, "compact"))
    number = F.pmod(F.xxhash64("event_time"), F.lit(4))
    for batch_id in range(4):
        for name, rows in c.stage.items():
            store.append(name, rows.where(number == batch_id), batch_id, "event_time")
        store.commit(batch_id)
    for name in c.stage:
        store.compact(name, 0, 2)
        store.drop_compacted(name)
    return _summary(dict(StoredTables(store, tuple(c.stage))))


def _stored_histories(c: Context) -> DataFrame:
    """Intervals kept by two loads, the change sets of the first one folded into a base."""
    root = shared_folder(c.spark, "histories")
    stage, vault = TableStore(c.spark, root + "/stage"), TableStore(c.spark, root + "/vault")
    given, early = with_history(c.stage), F.col("event_time") < F.lit(CUT_DT).cast("timestamp_ntz")
    for batch_id, part in enumerate((early, ~early)):
        for spec in (BY_TARGET[sat] for sat in CATALOGUE_SATS):
            stage.append(spec.stage, given[spec.stage].where(part), batch_id, "event_time")
            load_one(spec, stage, vault, batch_id)
        refresh_histories(vault, batch_id)
        vault.commit(batch_id)
    fold_histories(vault, 0)
    return _summary({sat + HISTORY: read_history(vault, sat) for sat in CATALOGUE_SATS})


def _published(c: Context) -> tuple[str, DataFrame]:
    root = shared_folder(c.spark, "publish")
    publish_events(messages_of(c.stage), root + "/messages", required=True)
    return root, c.spark.read.text(root + "/messages")


def _read_back(c: Context) -> DataFrame:
    """Published messages, read as a stream to its end."""
    root, _ = _published(c)
    messages = read_events(c.spark, root + "/messages").select("value")
    sink = messages.writeStream.format("parquet").option("checkpointLocation", root + "/checkpoint")
    sink.trigger(availableNow=True).start(root + "/read").awaitTermination()
    return c.spark.read.parquet(root + "/read")


STAGED = (*STAGE_TABLES, QUARANTINE, UNROUTED)


def _appended(c: Context) -> DataFrame:
    store = TableStore(c.spark, shared_folder(c.spark, "batch"))
    append_stage(_messages(c), store, 0)
    return _summary(dict(StoredTables(store, STAGED)))


def _summary(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of each table, and the sum of 60-bit digests of whole records: all columns, by name."""
    out = None
    for name, df in tables.items():
        df = lists_as_json(df)
        values = [F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in sorted(df.columns)]
        digest = F.conv(F.substring(F.sha2(F.concat_ws("|", *values), 256), 1, 15), 16, 10).cast("decimal(38,0)")
        row = df.agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("n"),
            F.coalesce(F.sum(digest).cast("string"), F.lit("0")).alias("checksum"),
        )
        out = row if out is None else out.unionByName(row)
    return out


def _loaded_in_two(c: Context) -> DataFrame:
    """The load plan over two stored stage batches, split at the cut date."""
    stage = TableStore(c.spark, shared_folder(c.spark, "stage"))
    vault = TableStore(c.spark, shared_folder(c.spark, "vault"))
    early = F.col("event_time") < F.lit(CUT_DT).cast("timestamp_ntz")
    for batch_id, part in enumerate((early, ~early)):
        for name, rows in c.stage.items():
            stage.append(name, rows.where(part), batch_id, "event_time")
        tables = run_load_plan(stage, vault, batch_id)
    return _summary(dict(tables))


def _ingested(
    c: Context, tables: tuple[str, ...] = (), vault: bool = False, popularity: TableStore | None = None
) -> tuple[TableStore, TableStore]:
    """Streams all messages in two runs with a restart; the edge cases are sent in both."""
    root = shared_folder(c.spark, "stream")
    stage, store = TableStore(c.spark, root + "/stage"), TableStore(c.spark, root + "/vault")
    early = F.col("event_time") < F.lit(CUT_DT).cast("timestamp_ntz")
    counted = (lambda batch_id: append_popularity(stage, popularity, batch_id)) if popularity else None
    for part in (early, ~early):
        rows = {name: df.where(part) for name, df in c.stage.items() if not tables or name in tables}
        publish_events(messages_of(rows, list(rows)), root + "/messages", required=True)
        publish_events(edge_messages(c.given), root + "/messages", required=True)
        ingest = start_ingest(
            read_events(c.spark, root + "/messages"), stage, root + "/checkpoint", store if vault else None,
            after_batch=counted,
        )
        ingest.awaitTermination()
    return stage, store


def _streamed_stage(c: Context) -> DataFrame:
    stage, _ = _ingested(c)
    return _summary(dict(StoredTables(stage, STAGED)))


def _streamed_playback(c: Context) -> DataFrame:
    stage, _ = _ingested(c, ("kafka_playback",))
    return StoredTables(stage, ("kafka_playback",))["kafka_playback"]


def _streamed_vault(c: Context) -> DataFrame:
    _, vault = _ingested(c, vault=True)
    return _summary(dict(StoredTables(vault, VAULT_TABLES)))


def _streamed_popularity(c: Context) -> DataFrame:
    store = TableStore(c.spark, shared_folder(c.spark, "popularity"))
    _ingested(c, ("kafka_playback",), popularity=store)
    return read_popularity(store, c.library["songs"])


#: Longer than the time that the messages span, so that none of the tests' messages is late.
DELAY = "100000 days"


def _unique(c: Context) -> str:
    """All messages streamed in two runs with a restart, the edge cases in both; returns the folder of unique ones."""
    root = shared_folder(c.spark, "unique")
    early = F.col("event_time") < F.lit(CUT_DT).cast("timestamp_ntz")
    for part in (early, ~early):
        publish_events(messages_of({n: df.where(part) for n, df in c.stage.items()}), root + "/messages", required=True)
        publish_events(edge_messages(c.given), root + "/messages", required=True)
        messages = read_events(c.spark, root + "/messages")
        start_unique(messages, root + "/unique", root + "/checkpoint", DELAY).awaitTermination()
    return root + "/unique"


def _current_popularity(c: Context) -> DataFrame:
    root = shared_folder(c.spark, "current")
    store = TableStore(c.spark, root + "/store")
    events = read_unique(c.spark, _unique(c), per_batch=20)
    start_popularity(events, store, root + "/checkpoint").awaitTermination()
    return current_popularity(store, c.library["songs"])


def _polled_playback(c: Context) -> DataFrame:
    """An endless ingest that is sent messages while it runs, stopped between batches, and started again."""
    root = shared_folder(c.spark, "polled")
    stage = TableStore(c.spark, root + "/stage")
    rows = c.stage["kafka_playback"]
    early = F.col("event_time") < F.lit(CUT_DT).cast("timestamp_ntz")
    edges = edge_messages(c.given)
    publish_events(edges, root + "/messages", required=True)
    for part in (early, ~early):
        done: list[int] = []
        ingest = start_ingest(
            read_events(c.spark, root + "/messages"), stage, root + "/checkpoint", interval="200 milliseconds",
            after_batch=done.append, within=DELAY,
        )
        publish_events(messages_of({"kafka_playback": rows.where(part)}, ["kafka_playback"]), root + "/messages", required=True)
        publish_events(edges, root + "/messages", required=True)
        ingest.processAllAvailable()
        serve(ingest, lambda: bool(done), poll_s=0.2)
    return StoredTables(stage, ("kafka_playback",))["kafka_playback"]


def stage_queries() -> dict[str, Query]:
    playback = STAGE_TABLES["kafka_playback"]
    required = ["user_id", "song_id"]
    return {
        "decode_envelope": query(_edges),
        "route_events": query(lambda c: ops.route_events(_edges(c)).select("event_id", "type", "stage_table")),
        "project_payload": query(lambda c: ops.project_payload(_messages(c, "kafka_playback"), playback).drop("data")),
        "surrogate_event_id": query(lambda c: _edges(c).select("data", "event_id")),
        "enforce_required": query(lambda c: lists_as_json(_refused_playback(c))),
        "quarantined_events": query(lambda c: lists_as_json(ops.quarantined_events(_edges(c)))),
        "unrouted_events": query(lambda c: ops.unrouted_events(_edges(c))),
        "dedupe_events": query(lambda c: ops.dedupe_events(_edges(c))),
        "encode_event": query(lambda c: messages_of(c.stage)),
        "resolve_event_time": query(_event_times),
        "missing_fields": query(
            lambda c: lists_as_json(ops.missing_fields(_edges(c).select("event_id", "data"), "data", required))
        ),
        **{"stage_" + name.removeprefix("kafka_"): _stage_query(name) for name in STAGE_TABLES},
        "publish_events": query(lambda c: _published(c)[1]),
        "read_events": query(_read_back),
        "append_stage": query(_appended),
        "append_table": query(_stored),
        "append_table_compacted": query(_compacted),
        "stored_histories": query(_stored_histories),
        "run_load_plan": query(_loaded_in_two),
        "stream_stage": query(_streamed_stage),
        "stream_stage_playback": query(_streamed_playback),
        "stream_vault": query(_streamed_vault),
        "stream_song_popularity": query(_streamed_popularity),
        "stream_unique_events": query(
            lambda c: c.spark.read.schema(UNIQUE).parquet(_unique(c)).where(ops.event_month(F.col("data")) > 0)
        ),
        "stream_current_popularity": query(_current_popularity),
        "stream_polled_playback": query(_polled_playback),
    }
