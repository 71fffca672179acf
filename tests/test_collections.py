"""Nested collections: documents, parts of large ones, and requests to create them, against plain Python."""

import json
import re

from pyspark.sql import functions as F

from tonearm.operators import collections as ops

COLLECTION = "id string, name string, collection_type string, genre_id string, released_dt string, artist_id string"
SONG = "id string, name string, duration_sec int, artist_id string, genre_id string, collection_id string"
def at():
    return F.lit("1999-06-01").cast("timestamp_ntz")


def catalogue(spark, sizes):
    """Collections c0, c1, .. with the given numbers of songs, and songs that belong nowhere."""
    collections = [(f"c{k}", f'Name "{k}"', "LP", "g1", "1990-01-02" if k else None, f"a{k % 2}") for k in range(len(sizes))]
    songs = [(f"s{k}-{i:05d}", f"Söng {i}", i, "a0", None if i == 1 else "g1", f"c{k}") for k, n in enumerate(sizes) for i in range(n)]
    songs += [("lost", "x", 1, "a0", "g1", None), ("other", "x", 1, "a0", "g1", "unknown")]
    return spark.createDataFrame(collections, COLLECTION), spark.createDataFrame(songs, SONG)


def expected(collections, songs):
    fields = [c.split()[0] for c in COLLECTION.split(", ")]
    out = {}
    for row in collections.collect():
        own = sorted((s for s in songs.collect() if s.collection_id == row.id), key=lambda s: s.id)
        out[row.id] = {f: row[f] for f in fields} | {"songs": [{f: s[f] for f in ops.SONG_FIELDS} for s in own]}
    return out


def test_documents_of_all_sizes(spark):
    collections, songs = catalogue(spark, [0, 1, 3, 12])
    docs = ops.documents_of(ops.collection_parts(collections, songs)).collect()
    assert {d.id: json.loads(d.document) for d in docs} == expected(collections, songs)
    assert {(d.part, d.parts) for d in docs} == {(0, 1)}
    assert list(json.loads(docs[0].document)) == [*ops.FIELDS, "songs"]


def test_a_very_large_collection_is_several_bounded_parts(spark):
    collections, songs = catalogue(spark, [2, 25_000, 300])
    parts = ops.collection_parts(collections, songs, part_songs=100)
    rows = parts.select("id", "part", "parts", F.size("songs").alias("n"), "songs.id").toDF("id", "part", "parts", "n", "song").collect()
    large = [r for r in rows if r.id == "c1"]
    assert [r.part for r in sorted(large, key=lambda r: r.part)] == list(range(250)) and {(r.parts, r.n) for r in large} == {(250, 100)}
    assert len({s for r in large for s in r.song}) == 25_000 and all(r.song == sorted(r.song) for r in rows)
    assert {(r.id, r.parts, r.n) for r in rows} == {("c0", 1, 2), ("c1", 250, 100), ("c2", 3, 100)}
    events = ops.explode_documents(ops.documents_of(parts), at())
    kinds = {r.type: r["count"] for r in events.select(F.get_json_object("value", "$.type").alias("type")).groupBy("type").count().collect()}
    assert kinds == {"CollectionCreated": 3, "SongCreated": 25_302}


def test_answers_for_unknown_and_empty(spark):
    collections, songs = catalogue(spark, [0, 1])
    docs = ops.documents_of(ops.collection_parts(collections, songs))
    asked = spark.createDataFrame([("c0",), ("c0",), ("none",), (None,)], "collection_id string")
    found = {r.collection_id: (r.found, r.part) for r in ops.collection_by_id(asked, docs).collect()}
    assert found == {"c0": (True, 0), "none": (False, None), None: (False, None)}
    artists = spark.createDataFrame([("a0",), ("a1",), ("idle",)], "id string")
    asked = spark.createDataFrame([("a0",), ("idle",), ("none",)], "artist_id string")
    found = sorted((r.artist_id, r.found, r.collection_id) for r in ops.documents_of_artist(asked, artists, docs).collect())
    assert found == [("a0", True, "c0"), ("idle", True, None), ("none", False, None)]
    assert ops.collection_parts(collections.where("false"), songs).count() == 0
    assert [r.songs for r in ops.collection_parts(collections, songs.where("false")).collect()] == [[], []]


def request(**changes):
    made = {
        "artist_id": "a0", "name": "N", "type": "EP", "genre_id": "g1", "released_dt": "2022-12-31",
        "songs": [{"name": "one", "duration_sec": 10}, {"name": "two", "duration_sec": 20}],
    } | changes
    return json.dumps({k: v for k, v in made.items() if v != "-"})


REQUESTS = {
    "ok": (request(), "ok", []),
    "empty": (request(songs=[]), "ok", []),
    "artist": (request(artist_id="x", genre_id="x"), "ArtistNotFound", []),
    "genre": (request(genre_id="x", released_dt="never"), "GenreNotFound", []),
    "date": (request(released_dt="2022-31-12"), "InvalidDate", []),
    "keys": (request(name="-", songs="-"), "MissingFields", ["name", "songs"]),
    "song": (request(songs=[{"name": "one", "duration_sec": 1}, {"name": "two"}]), "MissingFields", ["songs.duration_sec"]),
    "null": (request(songs=[{"name": None, "duration_sec": 1}]), "InvalidSong", []),
    "text": ("no json", "MissingFields", ops.REQUEST_FIELDS),
    "nothing": (None, "MissingFields", ops.REQUEST_FIELDS),
    "list": (request(songs=7), "InvalidSong", []),
}


def test_requests_are_checked_in_order(spark):
    rows = spark.createDataFrame([(k, v[0]) for k, v in REQUESTS.items()], "request_id string, document string")
    artists = spark.createDataFrame([("a0",), ("a0",), (None,)], "id string")
    genres = spark.createDataFrame([("g1",)], "id string")
    answered = ops.answer_requests(rows, artists, genres)
    got = {r.request_id: r for r in answered.collect()}
    assert {k: (r.status, r.missing) for k, r in got.items()} == {k: v[1:] for k, v in REQUESTS.items()}
    assert {k for k, r in got.items() if r.collection_id} == {"ok", "empty"}
    events = [json.loads(r.value) for r in ops.created_events(answered, at()).collect()]
    again = [json.loads(r.value) for r in ops.created_events(answered.repartition(3), at()).collect()]
    assert sorted(map(str, events)) == sorted(map(str, again))
    ids = {k: got[k].collection_id for k in ("ok", "empty")}
    made = {e["data"]["id"]: e["data"] for e in events if e["type"] == "CollectionCreated"}
    assert set(made) == set(ids.values()) and all(re.fullmatch("[0-9a-f]{32}", i) for i in made)
    songs = [e["data"] for e in events if e["type"] == "SongCreated"]
    assert {(s["collection_id"], s["artist_id"], s["genre_id"], s["name"], s["duration_sec"]) for s in songs} == {
        (ids["ok"], "a0", "g1", "one", 10), (ids["ok"], "a0", "g1", "two", 20)
    }
    assert made[ids["ok"]]["released_dt"] == "2022-12-31" and made[ids["ok"]]["event_time"] == "1999-06-01T00:00:00"
    assert len({s["id"] for s in songs} | set(made)) == 4
