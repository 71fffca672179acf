"""Song mart: listens and likes per song at home and abroad, top countries.

Counting happens before joining: listens are first reduced to one row per listen key
(the key they have to be shuffled by anyway), then to one row per song and listener
country, and only those rows meet the catalogue. A song or a key that holds a third of all
listens is thus combined on the map side and never forms one large group.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tonearm.functions.ranking import ranked, top_list
from tonearm.plans.asof import current, day_before, midnight

Tables = Mapping[str, DataFrame]

LISTEN = "session_song_user_listen_id"
LIKE = "session_song_user_like_id"


def _count(condition: Column, weight: str | None = None) -> Column:
    return F.sum(F.when(condition, F.col(weight) if weight else F.lit(1)).otherwise(0))


def _counted_listens(tables: Tables) -> DataFrame:
    is_start = (F.col("action_type") == "Start") & (F.col("at_time_sec") == 0)
    return tables["lsat_session_song_user_listen"].where((F.col("action_type") == "Complete") | is_start)


def _song_home(tables: Tables) -> DataFrame:
    """Home country per song: one row per (song, collection, artist version)."""
    artists = tables["sat_artist"].select("artist_id", F.col("country_code").alias("home_country"))
    return (
        tables["link_collection_song"].select("collection_id", "song_id")
        .join(tables["link_artist_collection"].select("collection_id", "artist_id"), "collection_id", "left")
        .join(artists, "artist_id", "left")
        .select("song_id", "home_country")
    )


def _country_of(tables: Tables, name: str) -> DataFrame:
    return tables["sat_user"].select("user_id", F.col("country_code").alias(name))


def song_listening(tables: Tables, corrected: bool = False) -> DataFrame:
    """Listens that count (started at 0, or complete) with home and listener country."""
    tables = current(tables) if corrected else tables
    link = tables["link_session_song_user_listen"].select(LISTEN, "song_id", "user_id")
    return (
        _counted_listens(tables)
        .join(link, LISTEN, "left")
        .join(_country_of(tables, "listener_country"), "user_id", "left")
        .join(_song_home(tables), "song_id", "left")
        .select("song_id", "actual_dtm", "home_country", "listener_country", "action_type")
    )


def _per_country(per_key: DataFrame, link: DataFrame, key: str, users: DataFrame, measures: list[str]) -> DataFrame:
    """Measures per key -> measures per (song, country of the user)."""
    country = [c for c in users.columns if c != "user_id"]
    return (
        per_key.join(link.select(key, "song_id", "user_id"), key, "left")
        .join(users, "user_id", "left")
        .groupBy("song_id", *country)
        .agg(*[F.sum(m).alias(m) for m in measures])
    )


def listens_by_country(tables: Tables, execution_dt: str) -> DataFrame:
    """Counted listens per (song, listener country): all, started, complete in the last day."""
    last_day = F.col("actual_dtm").between(day_before(execution_dt), midnight(execution_dt))
    per_key = (
        _counted_listens(tables)
        .groupBy(LISTEN)
        .agg(
            F.count(F.lit(1)).alias("listens"),
            _count(F.col("action_type") == "Start").alias("starts"),
            _count((F.col("action_type") == "Complete") & last_day).alias("complete_1d"),
        )
    )
    return _per_country(
        per_key, tables["link_session_song_user_listen"], LISTEN,
        _country_of(tables, "listener_country"), ["listens", "starts", "complete_1d"],
    )


def _home_and_away(by_country: DataFrame, homes: DataFrame) -> DataFrame:
    """Adds the home counts. A song in several collections counts once per collection."""
    at_home = F.col("home_country") == F.col("listener_country")
    return (
        by_country.join(homes, "song_id", "left")
        .groupBy("song_id", "listener_country")
        .agg(
            F.sum("listens").alias("listens"),
            _count(at_home, "listens").alias("home_listens"),
            F.sum("complete_1d").alias("complete_1d"),
            _count(at_home, "complete_1d").alias("home_complete_1d"),
            F.sum("starts").alias("starts"),
        )
    )


def _song_counts() -> list[Column]:
    known_song = F.when(F.col("song_id").isNotNull(), F.col("listens"))
    return [
        F.sum(known_song).alias("world_listenings"),
        F.sum("home_listens").alias("home_listenings"),
        F.sum("complete_1d").alias("world_listenings_1d"),
        F.sum("home_complete_1d").alias("home_listenings_1d"),
    ]


def _listens_per_song_country(tables: Tables, execution_dt: str) -> DataFrame:
    return _home_and_away(listens_by_country(tables, execution_dt), _song_home(tables))


def song_listening_agg(tables: Tables, execution_dt: str, corrected: bool = False) -> DataFrame:
    tables = current(tables, execution_dt) if corrected else tables
    return _listens_per_song_country(tables, execution_dt).groupBy("song_id").agg(*_song_counts())


def song_listening_countries(tables: Tables, execution_dt: str, corrected: bool = False) -> DataFrame:
    """Starts per (song, listener country)."""
    tables = current(tables, execution_dt) if corrected else tables
    started = _listens_per_song_country(tables, execution_dt).where(F.col("starts") > 0)
    starts = F.when(F.col("song_id").isNull(), 0).otherwise(F.col("starts"))
    return started.select("song_id", "listener_country", starts.alias("listenings_by_country"))


def _listened_songs(tables: Tables, execution_dt: str) -> DataFrame:
    """Counts and top countries per song in one pass (a song has one row per country here)."""
    per_country = _listens_per_song_country(tables, execution_dt)
    order = [F.desc("starts"), F.asc_nulls_last("listener_country")]
    started_rank = F.when(F.col("starts") > 0, F.col("rnum"))
    return (
        ranked(per_country, ["song_id"], order)
        .groupBy("song_id")
        .agg(*_song_counts(), top_list(started_rank, "listener_country", 3).alias("top3_country"))
    )


def song_country_rank(countries: DataFrame) -> DataFrame:
    """Rank of countries per song; ties go by country code, an unknown country last."""
    order = [F.desc("listenings_by_country"), F.asc_nulls_last("listener_country")]
    return ranked(countries, ["song_id"], order).select("song_id", "listener_country", "rnum")


def song_top3_countries(ranks: DataFrame) -> DataFrame:
    top = ranks.where(F.col("rnum") <= 3)
    return top.groupBy("song_id").agg(top_list("rnum", "listener_country", 3).alias("top3_country"))


def song_likes_countries(tables: Tables, corrected: bool = False) -> DataFrame:
    tables = current(tables) if corrected else tables
    likes = tables["lsat_session_song_user_like"].select(LIKE, "actual_dtm")
    return (
        tables["link_session_song_user_like"].select(LIKE, "song_id", "user_id")
        .join(likes, LIKE, "left")
        .join(_country_of(tables, "liker_country"), "user_id", "left")
        .join(_song_home(tables), "song_id", "left")
        .select("song_id", "actual_dtm", "home_country", "liker_country")
    )


def song_likes_agg(tables: Tables, execution_dt: str, corrected: bool = False) -> DataFrame:
    tables = current(tables, execution_dt) if corrected else tables
    last_day = F.col("actual_dtm").between(day_before(execution_dt), midnight(execution_dt))
    per_key = tables["lsat_session_song_user_like"].groupBy(LIKE).agg(
        F.count(F.lit(1)).alias("likes"), _count(last_day).alias("likes_1d")
    )
    # a like without a dated fact still counts as one row of the left join
    link = tables["link_session_song_user_like"].select(LIKE, "song_id", "user_id")
    per_song = (
        link.join(per_key, LIKE, "left")
        .join(_country_of(tables, "liker_country"), "user_id", "left")
        .groupBy("song_id", "liker_country")
        .agg(
            F.sum(F.coalesce("likes", F.lit(1))).alias("likes"),
            F.sum(F.coalesce("likes_1d", F.lit(0))).alias("likes_1d"),
        )
    )
    at_home = F.col("home_country") == F.col("liker_country")
    return (
        per_song.join(_song_home(tables), "song_id", "left")
        .groupBy("song_id")
        .agg(
            F.sum(F.when(F.col("song_id").isNotNull(), F.col("likes"))).alias("world_likes"),
            _count(at_home, "likes").alias("home_likes"),
            F.sum("likes_1d").alias("world_likes_1d"),
            _count(at_home, "likes_1d").alias("home_likes_1d"),
        )
    )


def mart_song(tables: Tables, execution_dt: str, corrected: bool = False) -> DataFrame:
    tables = current(tables, execution_dt) if corrected else tables
    listened = _listened_songs(tables, execution_dt).where(F.col("world_listenings") > 0)
    likes = song_likes_agg(tables, execution_dt)

    songs = tables["sat_song"].select("song_id", F.col("name").alias("song_name"))
    collections = tables["sat_collection"].select(
        "collection_id", F.col("name").alias("collection_name"), "release_dt", "original_genre_id"
    )
    artists = tables["sat_artist"].select("artist_id", F.col("name").alias("artist_name"), "country_code")
    genres = tables["ref_genre"].select("original_genre_id", "genre_name")
    owners = tables["link_artist_collection"].select(
        "artist_id", F.col("collection_id").alias("_owned")
    )
    zero = ["world_listenings", "world_listenings_1d", "home_listenings", "home_listenings_1d"]
    zero_likes = ["world_likes", "world_likes_1d", "home_likes", "home_likes_1d"]
    described = collections.join(owners, collections["collection_id"] == owners["_owned"], "left").join(
        artists, "artist_id", "left"
    ).join(genres, "original_genre_id", "left")
    return (
        songs.join(listened, "song_id")
        .join(likes, "song_id", "left")
        .join(tables["link_collection_song"].select("song_id", "collection_id"), "song_id", "left")
        .join(described, "collection_id", "left")
        .select(
            "song_id",
            F.lit(execution_dt).cast("date").alias("actual_dtm"),
            "song_name",
            "collection_name",
            "release_dt",
            "artist_name",
            "genre_name",
            "country_code",
            *[F.coalesce(c, F.lit(0)).alias(c) for c in zero],
            F.coalesce("top3_country", F.array().cast("array<string>")).alias("top3_country"),
            *[F.coalesce(c, F.lit(0)).alias(c) for c in zero_likes],
        )
    )
