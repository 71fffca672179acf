"""Edge rows of the marts on tiny warehouses: published behaviour and its corrected form."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from tonearm.plans import mart_artist, mart_song, mart_user
from tonearm.plans.load_plan import derive_vault
from tonearm.registry import open_context
from tonearm.schemas import STAGE_TABLES
from tonearm.sources.fixtures import LazyTables

X = "1999-06-01"
OLD, YESTERDAY = datetime(1996, 1, 1), datetime(1999, 5, 31, 12)


class World:
    """Stage rows by table; missing columns are NULL."""

    def __init__(self, spark):
        self.spark, self.rows = spark, {name: [] for name in STAGE_TABLES}

    def add(self, table, time=OLD, kind=None, **values):
        t = STAGE_TABLES["kafka_" + table]
        values.update(event_type=kind or t.event_types[0], event_time=time)
        self.rows[t.name].append(tuple(values.get(c) for c in t.columns))
        return self

    def vault(self):
        def frame(name):
            t = STAGE_TABLES[name]
            fields = {f.name: f for f in t.payload}
            fields["event_type"] = T.StructField("event_type", T.StringType())
            schema = T.StructType([fields[c] for c in t.columns])
            return self.spark.createDataFrame(self.rows[name], schema)

        return derive_vault(LazyTables({n: (lambda n=n: frame(n)) for n in STAGE_TABLES}))


@pytest.fixture
def world(spark):
    w = World(spark)
    w.add("country_enabled", country_code="01")
    w.add("genre", id="g", name="rock", happiness_index=5, mean_duration_sec=Decimal(1), country_code="01")
    w.add("artist", id="a", name="ann", founded_year=1990, country_code="01")
    w.add("collection", id="c", name="col", collection_type="LP", artist_id="a", genre_id="g", released_dt="1990-01-01")
    w.add("song", id="s", name="tune", duration_sec=100, artist_id="a", genre_id="g", collection_id="c")
    w.add("user_history", user_id="u", email="u@x", country_code="01", birth_date=date(1970, 1, 1))
    return w


def play(w, user="u", song="s", time=YESTERDAY, at=0, session="x"):
    return w.add("playback", time, "SongPlayEvent", user_id=user, session_id=session, song_id=song, at_time_sec=at)


def stop(w, user="u", song="s", time=YESTERDAY, at=100, finished=True, session="x"):
    return w.add(
        "playback", time, "SongStopEvent",
        user_id=user, session_id=session, song_id=song, at_time_sec=at, finished=finished,
    )


def test_song_without_listens_is_left_out(world):
    assert mart_song.mart_song(world.vault(), X).isEmpty()


def test_song_counts(world):
    play(world)
    stop(world)
    world.add("song_like", YESTERDAY, user_id="u", session_id="x", song_id="s")
    row = mart_song.mart_song(world.vault(), X).first()
    assert (row.world_listenings, row.home_listenings, row.world_listenings_1d, row.home_listenings_1d) == (2, 2, 1, 1)
    assert (row.world_likes, row.home_likes, row.world_likes_1d, row.home_likes_1d) == (1, 1, 1, 1)
    assert row.top3_country == ["01"] and row.genre_name == "rock" and row.actual_dtm == date(1999, 6, 1)


def test_unknown_country_uses_up_a_rank(world):
    """Listeners without a profile have no country; it is ranked but not listed."""
    for i, (user, code) in enumerate([("b", "02"), ("c", "03"), ("d", "04")]):
        world.add("user_history", user_id=user, email=user, country_code=code, birth_date=date(1970, 1, 1))
        play(world, user, session=f"y{i}")
    for i in range(3):
        play(world, f"nobody{i}", session=f"z{i}")
    row = mart_song.mart_song(world.vault(), X).first()
    assert row.top3_country == ["02", "03"]


def test_two_versions_count_twice_unless_corrected(world):
    world.add("user_history", datetime(1997, 1, 1), user_id="u", email="u2", country_code="02", birth_date=date(1970, 1, 1))
    play(world)
    v = world.vault()
    assert mart_song.mart_song(v, X).first().world_listenings == 2
    assert mart_song.mart_song(v, X, corrected=True).first().world_listenings == 1


def test_first_release_is_published_as_latest(world):
    world.add("collection", id="c2", name="new", collection_type="EP", artist_id="a", genre_id="g", released_dt="1995-01-01")
    v = world.vault()
    assert mart_artist.mart_artist(v, X).first().latest_release_dt == "1990-01-01"
    assert mart_artist.mart_artist(v, X, corrected=True).first().latest_release_dt == "1995-01-01"


def test_artist_measures(world):
    stop(world, at=11, finished=False)
    stop(world, at=10, finished=False, session="y")
    stop(world, session="z")
    world.add("artist_follow", YESTERDAY, user_id="u", session_id="x", artist_id="a")
    world.add("user_subscription", OLD, user_id="u", session_id="x")
    v = world.vault()
    row = mart_artist.mart_artist(v, X).first()
    assert (row.song_listen_full, row.song_listen_10p, row.follow_all, row.follow_1d) == (1, 1, 1, 1)
    assert row.calculated_rating == Decimal("1.0")
    premium = v["ref_country_subscription_cost"].where("subscription_type = 'Premium'").first()
    assert row.royalty_1d == 3 * premium.royalty
    assert row.top3_songs == ["tune"] and row.top3_countries_1d == ["01"]


def test_prolific_artist_has_exact_top_songs(world):
    """The two-level top list equals a plain sort, also with an unlistened (unnamed) song."""
    for i in range(300):
        world.add("song", id=f"s{i}", name=f"n{i:03d}", duration_sec=100, artist_id="a", genre_id="g", collection_id="c")
        if i % 2:
            for j in range(1 + i % 7):
                play(world, song=f"s{i}", session=f"{i}-{j}")
    v = world.vault()
    songs = mart_artist.artist_popular_songs(v, X)
    want = [r.song_name for r in songs.orderBy(F.desc("song_listen"), F.asc_nulls_last("song_name")).limit(3).collect()]
    got = mart_artist.artist_top3_songs(songs).first()
    assert got.top3_songs == [n for n in want if n is not None]


def test_old_versions_stay_unless_corrected(world):
    world.add("user_history", datetime(1997, 1, 1), user_id="u", email="u2", country_code="01", birth_date=date(1970, 1, 1))
    v = world.vault()
    assert mart_user.mart_user(v, X).count() == 4  # two versions, each with the payments of both
    assert [r.email for r in mart_user.mart_user(v, X, corrected=True).collect()] == ["u2"]


def test_swapped_range_and_integer_share(world):
    stop(world, at=50, finished=False)
    stop(world, session="y")
    v = world.vault()
    plain = mart_user.mart_user(v, X).first()
    assert (plain.world_listenings_1d_cnt, plain.p10_world_listenings_1d_cnt) == (0, 0)
    assert plain.p10_world_listenings_whole_cnt == 1 and plain.avg_percent_listening == 50.0
    fixed = mart_user.mart_user(v, X, corrected=True).first()
    assert (fixed.world_listenings_1d_cnt, fixed.p10_world_listenings_1d_cnt) == (1, 1)
    assert fixed.avg_percent_listening == 75.0


def test_unknown_genre_doubles_the_user_unless_corrected(world):
    world.add("song", id="s2", name="odd", duration_sec=100, artist_id="a", genre_id="none", collection_id="c")
    play(world)
    play(world, song="s2", session="y")
    v = world.vault()
    assert mart_user.mart_user(v, X).count() == 2
    row = mart_user.mart_user(v, X, corrected=True).first()
    assert row.top5_songs == ["odd", "tune"] and row.top3_genres == ["rock"]
    assert row.turn_world_listenings_whole_cnt == 2


def test_payments(world):
    world.add("user_subscription", datetime(1996, 1, 11, 6), user_id="u", session_id="x")
    v = world.vault()
    row = mart_user.user_payments(mart_user.user_subscriptions(v, X), v, X).first()
    assert (row.basic_days, row.premium_days) == ((date(1999, 6, 1) - date(1996, 1, 1)).days, 10)
    total = row.basic_subscription_cost * row.basic_days + row.premium_subscription_cost * row.premium_days
    assert mart_user.mart_user(v, X).first().total_payment == total


def test_lists_are_arrays(spark):
    vault = open_context(spark, "/root/testdata/sf0.001").vault
    marts = (mart_song.mart_song, mart_artist.mart_artist, mart_user.mart_user)
    lists = [f.name for m in marts for f in m(vault, X).schema if isinstance(f.dataType, T.ArrayType)]
    assert len(lists) == 7
