"""Every operator as a named query over the given tables: (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tonearm.functions.keys import hash_key, hash_uniform
from tonearm.operators.history import intervals
from tonearm.operators.vault import latest_version, load
from tonearm.plans import mart_artist, mart_song, mart_user
from tonearm.plans.asof import CATALOGUE_SATS, HISTORY
from tonearm.plans.load_plan import derive_vault
from tonearm.plans.specs import BY_TARGET, SPECS
from tonearm.sources.fixtures import LazyTables, given_tables, incomplete_updates, library_tables, stage_tables, with_history

EXECUTION_DT = "1999-06-01"
SECOND_DT = "2000-03-15"
CUT_DT = "1998-01-01"

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Context:
    """All frames one query may start from; each is declared only when used."""

    spark: SparkSession
    given: Mapping[str, DataFrame]
    stage: Mapping[str, DataFrame]
    library: Mapping[str, DataFrame]
    vault: Mapping[str, DataFrame]


def open_context(spark: SparkSession, folder: str) -> Context:
    given = given_tables(spark, folder)
    stage = stage_tables(given)
    return Context(spark, given, stage, library_tables(given, stage), derive_vault(stage))


def query(build: Callable[[Context], DataFrame]) -> Query:
    return lambda spark, folder: build(open_context(spark, folder))


def lists_as_json(df: DataFrame) -> DataFrame:
    """Renders list columns as JSON text, which compares the same in every engine."""
    lists = [f.name for f in df.schema if isinstance(f.dataType, T.ArrayType)]
    return df.withColumns({name: F.to_json(name) for name in lists}) if lists else df


def _first_load(target: str) -> Query:
    spec = BY_TARGET[target]
    return query(lambda c: load(spec, c.stage[spec.stage]))


def _second_load(target: str, **options) -> Query:
    """The whole stage against a target that holds the rows before the cut date."""
    spec = BY_TARGET[target]

    def build(c: Context) -> DataFrame:
        stage = c.stage[spec.stage]
        loaded = load(spec, stage.where(F.col("event_time") < F.lit(CUT_DT).cast("timestamp_ntz")))
        return load(spec, stage, loaded, **options)

    return query(build)


def _split_load(target: str, first: Callable[[], Column], twin: str | None = None) -> Query:
    """Two loads of a stage that is cut by a condition on its fields, so that equal moments lie on both
    sides; together they give what one load gives. With `twin`, each row has a second one with
    another value in that field and the same key and moment."""
    spec = BY_TARGET[target]

    def build(c: Context) -> DataFrame:
        stage = c.stage[spec.stage]
        if twin:
            stage = stage.unionByName(stage.withColumn(twin, F.col(twin) + 1))
        loaded = load(spec, stage.where(first()))
        return loaded.unionByName(load(spec, stage.where(~first()), loaded))

    return query(build)


def _filled_load(target: str) -> Query:
    """Updates that lack fields, on top of the whole stage; the last version of the key fills them in."""
    spec = BY_TARGET[target]
    return query(
        lambda c: load(spec, incomplete_updates(c.stage)[spec.stage], load(spec, c.stage[spec.stage]), corrected=True)
    )


def _history(c: Context) -> Mapping[str, DataFrame]:
    """The warehouse of a catalogue whose songs, artists and collections have changed."""
    return derive_vault(with_history(c.stage))


def _with_intervals(tables: Mapping[str, DataFrame]) -> LazyTables:
    """The tables and the intervals of their catalogue satellites."""
    own = {name: (lambda name=name: tables[name]) for name in tables}
    made = {sat + HISTORY: (lambda sat=sat, key=key: intervals(tables[sat], key)) for sat, key in CATALOGUE_SATS.items()}
    return LazyTables({**own, **made})


def _keys_of_users(c: Context) -> DataFrame:
    user, session = F.col("user_id"), F.col("session_id")
    return c.stage["kafka_user_subscription"].select(
        user,
        hash_key([user]).alias("user_key"),
        hash_key([user, F.lit(None).cast("string"), session]).alias("pair_key"),
        hash_uniform(user, "seed").alias("draw"),
    )


def vault_queries() -> dict[str, Query]:
    out = {
        "hash_key": query(_keys_of_users),
        "latest_version": query(lambda c: latest_version(c.vault["sat_user"], "user_id")),
    }
    for spec in SPECS:
        out[spec.target] = _first_load(spec.target)
        literal = {"published": True} if spec.kind in ("sat", "lsat") else {}
        out[spec.target + "_second_load"] = _second_load(spec.target, **literal)
        if spec.kind == "sat":
            out[spec.target + "_second_load_corrected"] = _second_load(spec.target, corrected=True)
    for target in ("sat_song", "sat_artist", "sat_user"):
        out[target + "_filled_load"] = _filled_load(target)
    for sat in CATALOGUE_SATS:
        out[sat + HISTORY] = query(lambda c, sat=sat: _with_intervals(_history(c))[sat + HISTORY])
    even = lambda column: lambda: F.crc32(F.col(column)) % 2 == 0
    out["sat_session_split_load"] = _split_load("sat_session", even("session_id"))
    out["sat_user_subscription_split_load"] = _split_load("sat_user_subscription", even("user_id"))
    out["lsat_session_song_user_listen_split_load"] = _split_load(
        "lsat_session_song_user_listen", lambda: F.col("at_time_sec") % 2 == 0, twin="at_time_sec"
    )
    return out


def song_queries() -> dict[str, Query]:
    m, x = mart_song, EXECUTION_DT
    ranks = lambda c: m.song_country_rank(m.song_listening_countries(c.vault, x))
    return {
        "song_listening": query(lambda c: m.song_listening(c.vault)),
        "song_listening_corrected": query(lambda c: m.song_listening(c.vault, corrected=True)),
        "song_listening_agg": query(lambda c: m.song_listening_agg(c.vault, x)),
        "song_listening_countries": query(lambda c: m.song_listening_countries(c.vault, x)),
        "song_country_rank": query(ranks),
        "song_top3_countries": query(lambda c: lists_as_json(m.song_top3_countries(ranks(c)))),
        "song_top3_countries_long": query(
            lambda c: ranks(c).where((F.col("rnum") <= 3) & F.col("listener_country").isNotNull())
        ),
        "song_likes_countries": query(lambda c: m.song_likes_countries(c.vault)),
        "song_likes_agg": query(lambda c: m.song_likes_agg(c.vault, x)),
        "mart_song": query(lambda c: lists_as_json(m.mart_song(c.vault, x))),
        "mart_song_corrected": query(lambda c: lists_as_json(m.mart_song(c.vault, x, corrected=True))),
        "mart_song_history": query(lambda c: lists_as_json(m.mart_song(_history(c), x))),
        "mart_song_history_corrected": query(lambda c: lists_as_json(m.mart_song(_history(c), x, corrected=True))),
        "mart_song_by_intervals": query(
            lambda c: lists_as_json(m.mart_song(_with_intervals(_history(c)), x, corrected=True))
        ),
        "mart_song_2000": query(lambda c: lists_as_json(m.mart_song(c.vault, SECOND_DT))),
    }


def artist_queries() -> dict[str, Query]:
    m, x = mart_artist, EXECUTION_DT
    countries = lambda c: m.artist_listen_country(c.vault, x)
    genres = lambda c: m.artist_main_genre(c.vault, x)
    songs = lambda c: m.artist_popular_songs(c.vault, x)
    ranks = lambda c: m.artist_country_rank(countries(c)).select("artist_id", "country_code", "top_7d", "top_1d")
    return {
        "artist_latest_release": query(lambda c: m.artist_latest_release(c.vault, x)),
        "artist_latest_release_corrected": query(lambda c: m.artist_latest_release(c.vault, x, corrected=True)),
        "artist_main_genre": query(genres),
        "artist_main_genre_rank": query(lambda c: m.artist_main_genre_rank(genres(c))),
        "artist_listen_country": query(countries),
        "artist_royalty": query(lambda c: m.artist_royalty(countries(c), c.vault)),
        "artist_country_rank": query(ranks),
        "artist_popular_songs": query(songs),
        "artist_song_rank": query(lambda c: m.artist_song_rank(songs(c))),
        "artist_top3_countries": query(lambda c: lists_as_json(m.artist_top3_countries(ranks(c)))),
        "artist_top3_songs": query(lambda c: lists_as_json(m.artist_top3_songs(songs(c)))),
        "artist_followed": query(lambda c: m.artist_followed(c.vault, x)),
        "mart_artist": query(lambda c: lists_as_json(m.mart_artist(c.vault, x))),
        "mart_artist_corrected": query(lambda c: lists_as_json(m.mart_artist(c.vault, x, corrected=True))),
        "mart_artist_history": query(lambda c: lists_as_json(m.mart_artist(_history(c), x))),
        "mart_artist_history_corrected": query(lambda c: lists_as_json(m.mart_artist(_history(c), x, corrected=True))),
        "mart_artist_by_intervals": query(
            lambda c: lists_as_json(m.mart_artist(_with_intervals(_history(c)), x, corrected=True))
        ),
        "mart_artist_2000": query(lambda c: lists_as_json(m.mart_artist(c.vault, SECOND_DT))),
    }


def user_queries() -> dict[str, Query]:
    m, x = mart_user, EXECUTION_DT
    agg = lambda c: m.user_listenings_agg(c.vault, x)
    subscriptions = lambda c: m.user_subscriptions(c.vault, x)
    return {
        "user_versions": query(lambda c: m.user_versions(c.vault, x)),
        "user_subscriptions": query(subscriptions),
        "user_subscriptions_corrected": query(lambda c: m.user_subscriptions(c.vault, x, corrected=True)),
        "user_listenings": query(lambda c: m.user_listenings(c.vault, x)),
        "user_listenings_corrected": query(lambda c: m.user_listenings(c.vault, x, corrected=True)),
        "user_listenings_agg": query(agg),
        "user_listenings_agg_corrected": query(lambda c: m.user_listenings_agg(c.vault, x, corrected=True)),
        "user_top_artists": query(lambda c: m.favourites_rank(agg(c), "artist")),
        "user_top_genres": query(lambda c: m.favourites_rank(agg(c), "genre")),
        "user_top_songs": query(lambda c: m.favourites_rank(agg(c), "song")),
        "user_top5_artists": query(lambda c: lists_as_json(m.favourites_list(agg(c), "artist"))),
        "user_top5_songs": query(lambda c: lists_as_json(m.favourites_list(agg(c), "song"))),
        "user_top3_genres": query(lambda c: lists_as_json(m.favourites_list(agg(c), "genre"))),
        "user_payments": query(lambda c: m.user_payments(subscriptions(c), c.vault, x)),
        "mart_user": query(lambda c: lists_as_json(m.mart_user(c.vault, x))),
        "mart_user_corrected": query(lambda c: lists_as_json(m.mart_user(c.vault, x, corrected=True))),
        "mart_user_history": query(lambda c: lists_as_json(m.mart_user(_history(c), x))),
        "mart_user_history_corrected": query(lambda c: lists_as_json(m.mart_user(_history(c), x, corrected=True))),
        "mart_user_by_intervals": query(
            lambda c: lists_as_json(m.mart_user(_with_intervals(_history(c)), x, corrected=True))
        ),
        "mart_user_2000": query(lambda c: lists_as_json(m.mart_user(c.vault, SECOND_DT))),
    }


def all_queries() -> dict[str, Query]:
    from tonearm.registry_library import library_queries
    from tonearm.registry_stage import stage_queries

    groups = (
        stage_queries, vault_queries, song_queries, artist_queries, user_queries, library_queries,
    )
    return {name: run for group in groups for name, run in group().items()}
