"""Streams with state: unique messages by watermark, popularity as an aggregate, and a stream without an end."""

import json
import time

import pytest
from pyspark.sql import functions as F

from tonearm.operators.activity import song_popularity
from tonearm.operators.stage import decode_envelope, dedupe_events, stage_rows
from tonearm.sources.events import read_events
from tonearm.sources.store import StoredTables, TableStore
from tonearm.streaming.ingest import start_ingest
from tonearm.streaming.popularity import current_popularity, start_popularity
from tonearm.streaming.progress import Progress, serve
from tonearm.streaming.unique import UNIQUE, read_unique, start_unique, unique_within

PLAY = ("kafka_playback",)


def message(user, at, song="s", kind="SongStopEvent", sec=60):
    data = {"event_time": at, "user_id": user, "session_id": "x", "song_id": song, "at_time_sec": sec, "finished": False}
    return json.dumps({"type": kind, "data": data})


def send(folder, name, *messages):
    """A file that appears as a whole, as those of a producer do."""
    path = folder.removeprefix("file://") + "/messages"
    import os

    os.makedirs(path, exist_ok=True)
    with open(f"{path}/.{name}", "w") as out:
        out.write("\n".join(messages) + "\n")
    os.rename(f"{path}/.{name}", f"{path}/{name}")
    time.sleep(0.02)  # files are read in the order of their times


def unique(spark, folder, delay="1 hour"):
    start_unique(
        read_events(spark, folder + "/messages", per_batch=1), folder + "/unique", folder + "/checkpoint", delay
    ).awaitTermination()
    return spark.read.schema(UNIQUE).parquet(folder + "/unique")


def until(condition, seconds=60):
    end = time.monotonic() + seconds
    while not condition():
        assert time.monotonic() < end, "waited in vain"
        time.sleep(0.1)


def test_copies_vanish_across_batches_and_restart_and_late_ones_are_counted(spark, folder):
    old, new = message("u1", "1995-05-01T10:00:00"), message("u2", "1995-05-01T20:00:00")
    with Progress(spark) as progress:
        send(folder, "1", old, old, old)
        send(folder, "2", old, new)
        assert unique(spark, folder).count() == 2
        # after the restart: a copy inside the delay, a late copy, a late message that is no copy, and a message on time
        send(folder, "3", new, old, message("u3", "1995-05-01T11:00:00"), message("u4", "1995-05-01T19:30:00"))
        users = [json.loads(r.data)["user_id"] for r in unique(spark, folder).collect()]
        assert sorted(users) == ["u1", "u2", "u4"]
        until(lambda: progress.late == 2)
        assert progress.rows == 9


def test_state_is_bounded_by_the_delay(spark, folder):
    """A thousand messages over forty days: the state holds those of the last hours."""
    with Progress(spark) as progress:
        for day in range(1, 41, 4):
            sent = [message(f"u{k}", f"1995-{5 + day // 29:02d}-{day % 28 + 1:02d}T{k % 24:02d}:00:{k % 60:02d}") for k in range(100)]
            send(folder, f"{day:02d}", *sent)
        unique(spark, folder, "2 hours")
        until(lambda: progress.rows == 1000)
        until(lambda: len({b.batch_id for b in progress.batches}) >= 10)
        assert max(b.state_rows for b in progress.batches) <= 300


def test_messages_without_a_time_and_batch_frames(spark):
    rows = [(message("u", None),), (message("u", None),), ("no event",), ("no event",), (None,)]
    frame = decode_envelope(spark.createDataFrame(rows, "value string")).withColumn("arrived", F.current_timestamp())
    assert unique_within(frame, "1 hour").count() == 3
    assert unique_within(frame.where("false"), "1 hour").count() == 0


def test_popularity_equals_the_batch_query_after_every_batch(spark, folder):
    songs = spark.createDataFrame([("s", 100), ("t", 100)], "id string, duration_sec int")
    store = TableStore(spark, folder + "/store")
    sent = []
    assert current_popularity(store, songs).count() == 0
    for batch in range(4):
        day = f"1995-05-0{batch + 1}T10:00"
        new = [message(f"u{k % 5}", f"{day}:{k:02d}", "st"[k % 2], "SongStopEvent" if k % 7 else "SongPlayEvent", 20 * k) for k in range(12)]
        sent += [*new, *sent[:3]]
        send(folder, f"{batch}", *new, *sent[:3], "no event")
        unique(spark, folder, "30 days")
        # each round is a restart of both streams
        start_popularity(read_unique(spark, folder + "/unique", 1), store, folder + "/counts").awaitTermination()
        decoded = dedupe_events(decode_envelope(spark.createDataFrame([(m,) for m in sent], "value string")))
        want = song_popularity(stage_rows(decoded, "kafka_playback"), songs).collect()
        assert sorted(current_popularity(store, songs).collect()) == sorted(want) and want
    # songs that become known later lose nothing
    known = songs.where("id = 's'")
    assert [r.song_id for r in current_popularity(store, known).collect()] == ["s"]


def test_a_batch_without_its_mark_is_not_read(spark, folder):
    songs = spark.createDataFrame([("s", 100)], "id string, duration_sec int")
    store = TableStore(spark, folder)
    counts = spark.createDataFrame([("s", 60, 3)], "song_id string, at_time_sec int, stops long")
    store.append("song_popularity_current", counts, 0)
    assert current_popularity(store, songs).count() == 0
    store.commit(0)
    store.append("song_popularity_current", counts.withColumn("stops", F.lit(9).cast("long")), 1)
    assert current_popularity(store, songs).first().listen_count == 2


def endless(spark, folder, **options):
    stage = TableStore(spark, folder + "/stage")
    query = start_ingest(
        read_events(spark, folder + "/messages", per_batch=1), stage, folder + "/checkpoint", interval="100 milliseconds", **options
    )
    return stage, query


@pytest.mark.parametrize("within", [None, "30 days"])
def test_endless_ingest_takes_what_arrives_later(spark, folder, within):
    send(folder, "1", message("u1", "1995-05-01T10:00:00"))
    with Progress(spark) as progress:
        stage, query = endless(spark, folder, within=within)
        until(lambda: progress.rows >= 1)
        send(folder, "2", message("u2", "1995-05-01T10:00:01"), message("u1", "1995-05-01T10:00:00"))
        until(lambda: progress.rows >= 3)
        assert query.isActive
        serve(query, lambda: True, poll_s=0.1)
        assert not query.isActive
        until(lambda: str(query.id) in progress.ended)
        assert progress.ended[str(query.id)] is None
    users = [r.user_id for r in StoredTables(stage, PLAY)["kafka_playback"].collect()]
    assert sorted(users) == ["u1", "u2"]
    if within:
        assert all(b.lag_s > 9e8 for b in progress.batches if b.rows)  # the messages are of 1995


@pytest.mark.parametrize("within", [None, "30 days"])
def test_a_stop_within_a_batch_loses_and_doubles_nothing(spark, folder, within):
    sent = [message(f"u{k}", f"1995-05-01T10:00:{k:02d}") for k in range(20)]
    send(folder, "1", *sent[:10])
    begun = []

    def hang(batch_id):
        begun.append(batch_id)
        if len(begun) == 1:
            time.sleep(30)  # the batch is stored, and its end never recorded

    stage, query = endless(spark, folder, within=within, after_batch=hang)
    until(lambda: begun)
    serve(query, lambda: True, poll_s=0.1, patience_s=0.5)
    assert not query.isActive
    send(folder, "2", *sent[5:])
    stage, query = endless(spark, folder, within=within)
    query.processAllAvailable()
    serve(query, lambda: True, poll_s=0.1)
    users = [r.user_id for r in StoredTables(stage, PLAY)["kafka_playback"].collect()]
    assert sorted(users) == sorted(f"u{k}" for k in range(20))


def test_an_error_in_a_batch_is_raised_to_who_serves(spark, folder):
    send(folder, "1", message("u1", "1995-05-01T10:00:00"))

    def fail(batch_id):
        raise ValueError("no room")

    _, query = endless(spark, folder, after_batch=fail)
    with pytest.raises(Exception, match="no room"):
        serve(query, lambda: False, poll_s=0.1)


def test_state_lies_in_files_and_has_ids_as_bytes(spark, tmp_path):
    """Executors keep the state of copies and of counts on disk (RocksDB), not in their heap; the session is as it was."""
    name = "spark.sql.streaming.stateStore.providerClass"
    folder, before = f"file://{tmp_path}", spark.conf.get(name)
    send(folder, "1", *[message(f"u{k}", "1995-05-01T10:00:00") for k in range(20)])
    assert unique(spark, folder).count() == 20
    start_popularity(read_unique(spark, folder + "/unique"), TableStore(spark, folder + "/store"), folder + "/counts").awaitTermination()
    for checkpoint in ("checkpoint", "counts"):
        kinds = {p.suffix for p in (tmp_path / checkpoint / "state").rglob("*") if p.is_file() and not p.name.startswith(".")}
        assert ".changelog" in kinds and ".delta" not in kinds
    assert spark.conf.get(name) == before
    plan = unique_within(read_events(spark, folder + "/messages").transform(decode_envelope), "1 day")
    assert plan.columns == ["event_id", "type", "data"] and "DeduplicateWithinWatermark [id#" in plan._jdf.queryExecution().analyzed().toString()
