"""Grouped positions, weighted draws and nested documents against plain Python."""

import hashlib
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tonearm.functions.ranking import positions
from tonearm.operators import activity, catalogue


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_positions_of_a_hot_group(spark):
    rows = [("hot" if i % 3 else f"g{i % 5}", f"k{i}") for i in range(600)]
    got = positions(spark.createDataFrame(rows, "g string, k string"), ["g"], "k").collect()
    sizes = Counter(g for g, _ in rows)
    for group, n in sizes.items():
        mine = sorted((r.position, r.k) for r in got if r.g == group)
        assert [p for p, _ in mine] == list(range(1, n + 1))
        assert [k for _, k in mine] == sorted((k for g, k in rows if g == group), key=lambda k: (sha(k)[:2], k))
        assert {r.position_all for r in got if r.g == group} == {n}


def expected_choice(weights, request, with_none):
    order = sorted(weights, key=lambda c: (sha(c)[:2], c))
    total = sum(weights.values())
    scale = max(total, 1.0) if with_none else total
    point = int(sha(f"{request}#0")[:8], 16) / 2**32
    low = 0.0
    for choice in order:
        high = low + weights[choice]
        if low / scale <= point < high / scale:
            return choice
        low = high
    return None


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.text("abc", min_size=1, max_size=4), st.integers(1, 1000), min_size=1), st.booleans())
def test_weighted_choice(spark, weights, with_none):
    weights = {k: v / 4096 for k, v in weights.items()}
    choices = spark.createDataFrame(list(weights.items()), "choice string, weight double")
    got = activity.weighted_choice(spark.range(200), choices, "id", with_none=with_none).collect()
    assert len(got) == 200
    assert {r.id: r.choice for r in got} == {i: expected_choice(weights, i, with_none) for i in range(200)}


def test_more_choices_than_cells(spark):
    weights = {f"c{i}": 1 / 8192 for i in range(3000)}
    choices = spark.createDataFrame(list(weights.items()), "choice string, weight double")
    got = activity.weighted_choice(spark.range(300), choices, "id").collect()
    assert {r.id: r.choice for r in got} == {i: expected_choice(weights, i, False) for i in range(300)}


def test_one_choice_with_nearly_all_the_weight(spark):
    """It covers whole blocks of cells, and shares cells with the small ones."""
    weights = {f"c{i}": 1 / 1024 for i in range(40)} | {"big": 200.0}
    choices = spark.createDataFrame(list(weights.items()), "choice string, weight double")
    got = activity.weighted_choice(spark.range(2000), choices, "id").collect()
    assert len(got) == 2000
    assert {r.id: r.choice for r in got} == {i: expected_choice(weights, i, False) for i in range(2000)}


def test_draws_for_requests(spark):
    artists = spark.createDataFrame([("a", "01", "g"), ("b", None, None)], "id string, country_code string, genre_id string")
    songs = spark.createDataFrame([("s", "a")], "id string, artist_id string")
    countries = spark.createDataFrame([("01",), ("02",)], "code string")
    genres = spark.createDataFrame([("g",), ("h",)], "id string")
    wanted = [(1, "01", None), (2, "02", "g"), (3, "xx", "zz"), (4, "01", "zz"), (5, None, "h"), (6, None, "g")]
    requests = spark.createDataFrame(wanted, "request_id int, country_code string, genre_id string")
    songs_drawn = catalogue.random_song_for(requests.drop("genre_id"), songs, artists, countries).collect()
    assert {r.request_id: (r.song_id, r.status) for r in songs_drawn} == {
        1: ("s", "ok"), 2: (None, "NoSong"), 3: (None, "CountryNotFound"), 4: ("s", "ok"), 5: ("s", "ok"), 6: ("s", "ok")
    }
    drawn = catalogue.random_artist_for(requests, artists, countries, genres).collect()
    assert {r.request_id: (r.artist_id, r.status) for r in drawn} == {
        1: ("a", "ok"), 2: (None, "NoArtist"), 3: (None, "CountryNotFound"), 4: (None, "GenreNotFound"),
        5: (None, "NoArtist"), 6: ("a", "ok"),
    }


def test_any_artist_where_none_has_the_genre(spark):
    users = spark.createDataFrame([("u", "01"), ("v", "01"), ("w", "02")], "id string, country_code string")
    likes = spark.createDataFrame([("u", "s"), ("v", "t")], "user_id string, song_id string")
    songs = spark.createDataFrame([("s", "g"), ("t", "h")], "id string, genre_id string")
    artists = spark.createDataFrame([("a", "01", "g")], "id string, country_code string, genre_id string")
    rows = catalogue.suggested_artists(users, likes, songs, artists).collect()
    assert {r.user_id: (r.by_genre, r.artist_id) for r in rows} == {"u": (True, "a"), "v": (False, "a"), "w": (False, "a")}
    home = catalogue.suggested_artists(users, likes, songs, artists, same_country=True).collect()
    assert {r.user_id: r.artist_id for r in home} == {"u": "a", "v": "a", "w": None}


def test_documents_have_one_layout_for_any_size(spark):
    collections = spark.createDataFrame(
        [("c", "n", "LP", "a", "g", "1990-01-01"), ("d", "n", "LP", "a", "g", "1990-01-01")],
        "id string, name string, collection_type string, artist_id string, genre_id string, released_dt string",
    )
    songs = spark.range(2500).select(
        F.concat(F.lit("s"), "id").alias("id"), F.lit("n").alias("name"), F.lit(1).alias("duration_sec"),
        F.lit("a").alias("artist_id"), F.lit("g").alias("genre_id"), F.lit("c").alias("collection_id"),
    )
    documents = catalogue.collection_documents(collections, songs)
    rows = documents.collect()
    assert {r.song.id for r in rows if r.id == "c"} == {f"s{i}" for i in range(2500)} and len(rows) == 2501
    assert [r.song for r in rows if r.id == "d"] == [None]
    events = catalogue.explode_collection(catalogue.collection_document(documents), F.lit("1999-06-01").cast("timestamp_ntz"))
    kinds = Counter(events.select(F.get_json_object("value", "$.type").alias("t")).toPandas()["t"])
    assert kinds == {"CollectionCreated": 2, "SongCreated": 2500}


def test_first_request_wins(spark):
    requests = spark.createDataFrame(
        [(1, "e", "99", 1), (2, "e", "01", 2), (3, "e", "01", 3), (4, "e", "99", 4), (5, "f", "02", 1), (6, "old", "01", 1)],
        "request_id int, email string, country_code string, t int",
    ).withColumn("event_time", F.timestamp_seconds("t").cast("timestamp_ntz")).drop("t")
    users = spark.createDataFrame([("old",)], "email string")
    countries = spark.createDataFrame([("01", 1), ("02", None)], "code string, enabled_at int")
    got = {r.request_id: r.status for r in activity.signup_eligibility(requests, users, countries).collect()}
    assert got == {
        1: "CountryNotFound", 2: "ok", 3: "UserAlreadyExists", 4: "UserAlreadyExists",
        5: "CountryNotEnabled", 6: "UserAlreadyExists",
    }


@pytest.mark.parametrize("at, play, stop, finished", [
    (-1, "PlaybackError", "PlaybackError", None), (0, "ok", "ok", False), (99, "ok", "ok", False),
    (100, "PlaybackError", "ok", True), (101, "PlaybackError", "PlaybackError", None),
])
def test_playback_limits(spark, at, play, stop, finished):
    songs = spark.createDataFrame([("s", 100)], "id string, duration_sec int")
    request = spark.createDataFrame([("s", at)], "song_id string, at_time_sec int")
    assert activity.validate_play(request, songs).first().status == play
    row = activity.validate_stop(request, songs).first()
    assert (row.status, row.finished) == (stop, finished)


def test_first_listen_counts_as_zero(spark):
    songs = spark.createDataFrame([("s", 100)], "id string, duration_sec int")
    plays = spark.createDataFrame(
        [("s", 51, "SongStopEvent"), ("s", 50, "SongStopEvent"), ("s", 60, "SongPlayEvent")],
        "song_id string, at_time_sec int, event_type string",
    )
    assert [tuple(r) for r in activity.song_popularity(plays, songs).collect()] == [("s", 0)]


def test_ranks_of_a_large_group_equal_one_window(spark):
    """One group with two thirds of the rows, ties, missing names and all sizes of counts."""
    from tonearm.functions.ranking import count_and_name, ranked, ranked_in_buckets

    rows = spark.range(3000).selectExpr(
        "if(id % 3 < 2, 'hot', concat('g', id % 40)) AS g", "CAST(pow(2, (id * 37) % 23) AS bigint) * (id % 4) AS n",
        "if(id % 50 = 0, NULL, concat(char(65 + id % 7), char(97 + (id * 11) % 26), 'é', id)) AS name", "id",
    )
    order = [F.desc("n"), F.asc_nulls_last("name"), F.asc("id")]
    got = ranked_in_buckets(rows, ["g"], count_and_name("n", "name"), order)
    assert got.exceptAll(ranked(rows, ["g"], order)).isEmpty() and got.count() == 3000
