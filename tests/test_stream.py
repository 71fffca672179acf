import json
import time
from pathlib import Path

import pytest

from tonearm.operators.stage import decode_envelope, dedupe_events
from tonearm.plans.load_plan import VAULT_TABLES, run_load_plan
from tonearm.sources.events import publish_events, read_events
from tonearm.sources.store import StoredTables, TableStore
from tonearm.streaming.ingest import append_stage, start_ingest
from tonearm.streaming.popularity import append_popularity, read_popularity

PLAY = ("kafka_playback",)


def publish(spark, folder, rows):
    texts = [
        (json.dumps({"type": "SongPlayEvent", "data": {
            "event_time": f"{1995 + i % 3}-05-01T00:00:00", "user_id": f"u{i}", "session_id": "x", "song_id": "s",
            "at_time_sec": 0}}),)
        for i in rows
    ]
    publish_events(spark.createDataFrame(texts, "value string"), folder + "/messages")


def ingest(spark, folder, vault=None):
    stage = TableStore(spark, folder + "/stage")
    query = start_ingest(
        read_events(spark, folder + "/messages", per_batch=2), stage, folder + "/checkpoint", vault
    )
    query.awaitTermination()
    return stage


def test_restart_and_copies(spark, folder):
    """A third of the messages are copies of one; they come in several batches and runs."""
    publish(spark, folder, [*range(20), *[3] * 10])
    ingest(spark, folder)
    publish(spark, folder, [*range(15, 30), *[3] * 10])
    stage = ingest(spark, folder)
    rows = StoredTables(stage, PLAY)["kafka_playback"]
    assert rows.count() == 30 and rows.select("user_id").distinct().count() == 30


def test_repeated_batch_replaces_itself(spark, folder):
    store = TableStore(spark, folder)
    df = spark.range(5).selectExpr("id", "timestamp_ntz '1996-01-01' AS event_time")
    for _ in range(2):
        store.append("t", df, 0, "event_time")
    store.append("t", df, 1, "event_time")
    assert store.read("t").count() == 10
    assert store.read("t", before_batch=1).count() == 5
    assert store.read("t", batches=[1]).count() == 5
    assert store.read("none") is None and store.read("t", batches=[7]) is None


def test_batch_without_rows(spark, folder):
    store = TableStore(spark, folder)
    df = spark.range(5).selectExpr("id", "timestamp_ntz '1996-01-01' AS event_time")
    store.append("t", df.where("id > 9"), 0, "event_time")
    assert store.read("t") is None
    store.append("t", df, 1, "event_time")
    assert store.read("t").count() == 5


def test_stream_to_warehouse_twice(spark, folder):
    vault = TableStore(spark, folder + "/vault")
    publish(spark, folder, range(10))
    stage = ingest(spark, folder, vault)
    listens = StoredTables(vault, VAULT_TABLES)["lsat_session_song_user_listen"]
    assert listens.count() == 10 and "insert_dtm" not in listens.columns
    batches = [r.batch_id for r in stage.read("kafka_playback").select("batch_id").distinct().collect()]
    run_load_plan(stage, vault, max(batches))
    assert StoredTables(vault, VAULT_TABLES)["lsat_session_song_user_listen"].count() == 10


def test_copies_are_found_however_late(spark, folder):
    store = TableStore(spark, folder)
    row = ops_events(spark, "u1")
    for batch_id in (0, 1):
        append_stage(row, store, batch_id)
    assert StoredTables(store, PLAY)["kafka_playback"].count() == 1
    for _ in range(2):  # batch 2 is run again
        append_stage(ops_events(spark, "u2"), store, 2)
    assert StoredTables(store, PLAY)["kafka_playback"].count() == 2
    append_stage(row, store, 500)
    assert StoredTables(store, PLAY)["kafka_playback"].count() == 2


def test_popularity_counts_a_copy_once_and_waits_for_songs(spark, folder):
    stage, store = TableStore(spark, folder + "/stage"), TableStore(spark, folder + "/counts")
    for batch_id, user in enumerate(("u1", "u1", "u2")):
        append_stage(ops_events(spark, user, "SongStopEvent", 60), stage, batch_id)
        append_popularity(stage, store, batch_id)
    songs = spark.createDataFrame([("s", 100)], "id string, duration_sec int")
    assert [(r.song_id, r.listen_count) for r in read_popularity(store, songs).collect()] == [("s", 1)]


def test_failed_publish_raises_if_required(spark, folder):
    rows = spark.sql("SELECT raise_error('no') AS value")
    assert publish_events(rows, folder + "/m") is False
    with pytest.raises(Exception):
        publish_events(rows, folder + "/m", required=True)


def ops_events(spark, user, kind="SongPlayEvent", at=0):
    data = {"event_time": "1995-05-01T00:00:00", "user_id": user, "session_id": "x", "song_id": "s", "at_time_sec": at}
    return decode_envelope(spark.createDataFrame([(json.dumps({"type": kind, "data": data}),)], "value string"))


def test_readers_see_complete_batches_only(spark, folder):
    store = TableStore(spark, folder)
    df = spark.range(5).selectExpr("id", "timestamp_ntz '1996-01-01' AS event_time")
    store.append("t", df, 0, "event_time")
    store.commit(0)
    store.append("t", df, 1, "event_time")  # its load isn't complete
    assert StoredTables(store, ("t",))["t"].count() == 5
    store.commit(1)
    assert StoredTables(store, ("t",))["t"].count() == 10 and store.last_complete() == 1


def test_messages_and_batches_lie_compressed_on_disk(spark, tmp_path):
    """Text of messages by a general coder, ids and hash keys in tables by an entropy coder."""
    rows = [('{"type":"SongPlayEvent","data":{"event_time":"2024-01-01T00:00:00"}}',)]
    publish_events(spark.createDataFrame(rows, "value string"), f"file://{tmp_path}/m", required=True)
    assert {p.suffix for p in (tmp_path / "m").glob("part-*")} == {".gz"}
    assert [r.value for r in spark.read.text(f"file://{tmp_path}/m").collect()] == [rows[0][0]]
    TableStore(spark, f"file://{tmp_path}/s").append("t", spark.range(3), 0)
    assert all(".zstd." in p.name for p in (tmp_path / "s").rglob("part-*")) and list((tmp_path / "s").rglob("part-*"))


def test_first_batch_is_kept_once(spark, folder, monkeypatch):
    """Only a batch with earlier ids to look up is kept before it is judged."""
    kept, store = [], TableStore(spark, folder + "/stage")
    frame = type(spark.range(1))
    persist = frame.persist
    monkeypatch.setattr(frame, "persist", lambda df, *a: kept.append(df) or persist(df, *a))
    append_stage(ops_events(spark, "u1"), store, 0)
    assert len(kept) == 1
    append_stage(ops_events(spark, "u1"), store, 1)
    assert len(kept) == 3
    assert store.read("kafka_playback").count() == 1


def test_event_ids_are_made_behind_the_shuffle(spark):
    sent = [('{"type":"A","data":{"x":1}}',)] * 2 + [("no event",)] * 2
    decoded = decode_envelope(spark.createDataFrame(sent, "value string"))
    once = dedupe_events(decoded)
    plan = once._jdf.queryExecution().executedPlan().toString()
    assert "event_id" in plan.split("Exchange")[0] and "event_id" not in plan.split("Exchange")[1]
    assert sorted(once.collect()) == sorted(decoded.distinct().select(once.columns).collect())


def test_executors_hold_no_text_of_a_batch_and_its_draft_goes(spark, tmp_path, monkeypatch):
    """What is kept in blocks are counts and known ids; payloads lie in a draft while the tables are written."""
    kept, seen, store = [], [], TableStore(spark, f"file://{tmp_path}")
    frame, append = type(spark.range(1)), store.append
    persist = frame.persist
    monkeypatch.setattr(frame, "persist", lambda df, *a: kept.append(df.columns) or persist(df, *a))
    monkeypatch.setattr(store, "append", lambda *a, **b: seen.extend(tmp_path.glob("_drafts/*/target=*")) or append(*a, **b))
    for batch_id in range(2):
        append_stage(ops_events(spark, "u1"), store, batch_id)
    assert kept and not any({"data", "type"} & set(columns) for columns in kept)
    assert {p.name for p in seen} == {"target=kafka_playback"} and not list(tmp_path.glob("_drafts/*"))


def test_a_load_leaves_no_shuffle_files(spark, folder):
    """Shuffles go when a table is written, not when the driver collects garbage."""
    stage, vault = TableStore(spark, folder + "/stage"), TableStore(spark, folder + "/vault")
    append_stage(ops_events(spark, "u1").union(ops_events(spark, "u2")), stage, 0)
    append_stage(ops_events(spark, "u3"), stage, 1)
    before = blocks(spark)
    for batch_id in range(2):
        run_load_plan(stage, vault, batch_id)
    end = time.monotonic() + 20
    while blocks(spark) - before and time.monotonic() < end:
        time.sleep(0.2)
    assert not blocks(spark) - before
    assert StoredTables(vault, VAULT_TABLES)["link_session_song_user_listen"].count() == 3


def blocks(spark):
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {p.name for d in folders for p in Path(d.getPath()).rglob("shuffle_*.data")}


def test_events_of_tables_with_an_id_and_without_text(spark, folder):
    """The id of an event and the `id` of what it tells of are two; a message without text is kept once."""
    data = {"event_time": "1995-05-01T00:00:00", "id": "g1", "name": "n", "happiness_index": 1}
    rows = [(json.dumps({"type": "GenreCreated", "data": data}),), (None,)]
    events, store = decode_envelope(spark.createDataFrame(rows, "value string")), TableStore(spark, folder)
    for batch_id in range(2):
        append_stage(events, store, batch_id)
    genre = store.read("kafka_genre").collect()
    assert [(r.id, r.event_id) for r in genre] == [("g1", events.where("type IS NOT NULL").first().event_id)]
    assert store.read("quarantine").count() == 1
