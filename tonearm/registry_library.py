"""Registered queries over the catalogue and over batches of user requests."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tonearm.operators import activity, catalogue, collections
from tonearm.registry import EXECUTION_DT, Context, Query, lists_as_json, query

WEIGHTS_AT = "1995-03-01"


def _midnight(text: str):
    return F.lit(text).cast("timestamp_ntz")


def _documents(c: Context) -> DataFrame:
    return catalogue.collection_documents(c.library["collections"], c.library["songs"])


def _collection_requests(c: Context) -> DataFrame:
    """Every collection, and as many unknown ones."""
    return c.library["collections"].select(
        F.explode(F.array(F.col("id"), F.concat(F.col("id"), F.lit("x")))).alias("collection_id")
    )


def _artist_requests(c: Context) -> DataFrame:
    return c.library["artists"].select(
        F.explode(F.array(F.col("id"), F.concat(F.col("id"), F.lit("x")))).alias("artist_id")
    )


def _lookups(c: Context) -> DataFrame:
    """One kind of entity per request, by key."""
    number = F.col("event_id")
    kinds = {
        "country": ("countries", "code", F.lpad((number % 40).cast("string"), 2, "0")),
        "user": ("users", "email", F.concat(F.lit("customer#"), F.lpad(number.cast("string"), 9, "0"), F.lit("@example.com"))),
        "artist": ("artists", "id", F.concat(F.lit("A"), number.cast("string"))),
        "collection": ("collections", "id", F.concat(F.lit("C"), number.cast("string"))),
        "song": ("songs", "id", F.concat(F.lit("S"), number.cast("string"))),
        "genre": ("genres", "id", F.concat(F.lit("Brand#"), (number % 40).cast("string"))),
    }
    out = None
    for entity, (table, key, value) in kinds.items():
        requests = c.given["events"].select(F.lit(entity).alias("entity"), value.alias("key"))
        found = catalogue.lookup_entities(requests, c.library[table], key)
        out = found if out is None else out.unionByName(found)
    return out


def _like_lists(c: Context) -> DataFrame:
    """All likes of the even users; of the odd ones, those of one artist."""
    number = F.substring("id", 2, 20).cast("bigint")
    one = F.when(number % 2 == 1, F.concat(F.lit("A"), (number % 10).cast("string")))
    return c.library["users"].select(F.col("id").alias("user_id"), one.alias("artist_id"))


def _draw_requests(c: Context) -> DataFrame:
    """A request per event: for a country, a genre, both or neither; some of them unknown."""
    number = F.col("event_id")
    return c.given["events"].select(
        number.alias("request_id"),
        F.when(number % 5 != 0, F.lpad((number % 28).cast("string"), 2, "0")).alias("country_code"),
        F.when(number % 3 != 0, F.concat(F.lit("Brand#"), (number % 40).cast("string"))).alias("genre_id"),
    )


def _staggered_countries(c: Context) -> DataFrame:
    """Countries enabled on different days."""
    later = F.make_dt_interval(F.col("code").cast("int"))
    return c.library["countries"].withColumn("enabled_at", F.col("enabled_at") + later)


def _choices(c: Context, share: float) -> DataFrame:
    weights = activity.country_decay_weight(_staggered_countries(c), _midnight(WEIGHTS_AT))
    return weights.select(F.col("code").alias("choice"), (F.col("weight") * F.lit(share)).alias("weight"))


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(n, 9).alias(n) if t == "double" else n for n, t in df.dtypes])


def _explode(c: Context) -> DataFrame:
    return catalogue.explode_collection(catalogue.collection_document(_documents(c)), _midnight(EXECUTION_DT))


def _nested(c: Context) -> DataFrame:
    return collections.documents_of(collections.collection_parts(c.library["collections"], c.library["songs"]))


def _create_requests(c: Context) -> DataFrame:
    """A request for every collection to create it once more; some lack keys or name what does not exist."""
    parts = collections.collection_parts(c.library["collections"], c.library["songs"])
    number = F.substring("id", 2, 20).cast("bigint")
    brief = F.transform(
        "songs", lambda s: F.struct(s["name"].alias("name"), F.when(number % 19 != 0, s["duration_sec"]).alias("duration_sec"))
    )
    return parts.select(
        F.concat(F.lit("R"), F.col("id")).alias("request_id"),
        F.to_json(
            F.struct(
                F.when(number % 7 == 0, F.concat("artist_id", F.lit("x"))).otherwise(F.col("artist_id")).alias("artist_id"),
                "name",
                F.when(number % 13 != 0, F.col("collection_type")).alias("type"),
                F.when(number % 11 == 0, F.lit("unknown")).otherwise(F.col("genre_id")).alias("genre_id"),
                F.when(number % 17 == 0, F.lit("2022-31-12")).otherwise(F.col("released_dt")).alias("released_dt"),
                F.when(number % 23 != 0, brief).otherwise(F.slice(brief, 1, 0)).alias("songs"),
            )
        ).alias("document"),
    )


def _answers(c: Context) -> DataFrame:
    return collections.answer_requests(_create_requests(c), c.library["artists"], c.library["genres"])


def library_queries() -> dict[str, Query]:
    a, k = activity, catalogue
    popularity = lambda c: a.song_popularity(c.stage["kafka_playback"], c.library["songs"])
    similar = lambda c, **options: k.same_genre_artists(
        c.library["users"], c.library["song_likes"], c.library["songs"], c.library["artists"], **options
    )
    factors = lambda c, **options: k.genre_candidates(
        c.library["users"], c.library["song_likes"], c.library["songs"], c.library["artists"], **options
    )
    suggested = lambda c, **options: k.suggested_artists(
        c.library["users"], c.library["song_likes"], c.library["songs"], c.library["artists"], **options
    )
    draw = lambda c, share, **options: a.weighted_choice(
        c.given["events"], _choices(c, share), "event_id", **options
    )
    return {
        "countries_list": query(lambda c: k.countries_list(c.library["countries"])),
        "countries_list_enabled": query(lambda c: k.countries_list(c.library["countries"], enabled_only=True)),
        "genres_by_country": query(lambda c: k.genres_by_country(c.library["genres"], "05")),
        "genres_all": query(lambda c: k.genres_by_country(c.library["genres"])),
        "songs_of_collection": query(lambda c: k.songs_of_collection(c.library["songs"], _collection_requests(c))),
        "collections_of_artist": query(
            lambda c: k.collections_of_artist(_artist_requests(c), c.library["artists"], _documents(c))
        ),
        "collection_document": query(lambda c: k.collection_document(_documents(c))),
        "collection_document_nested": query(_nested),
        "collections_of_artist_nested": query(
            lambda c: collections.documents_of_artist(_artist_requests(c), c.library["artists"], _nested(c))
        ),
        "collection_by_id": query(lambda c: collections.collection_by_id(_collection_requests(c), _nested(c))),
        "explode_collection_nested": query(lambda c: collections.explode_documents(_nested(c), _midnight(EXECUTION_DT))),
        "create_collections": query(
            lambda c: lists_as_json(_answers(c).select("request_id", "status", "missing", "collection_id"))
        ),
        "create_collections_events": query(lambda c: collections.created_events(_answers(c), _midnight(EXECUTION_DT))),
        "lookup_entities": query(_lookups),
        "random_song_per_country": query(
            lambda c: k.random_song_per_country(c.library["songs"], c.library["artists"])
        ),
        "random_artist": query(lambda c: k.random_artist(c.library["artists"])),
        "random_song_for": query(
            lambda c: k.random_song_for(
                _draw_requests(c).drop("genre_id"), c.library["songs"], c.library["artists"], c.library["countries"]
            )
        ),
        "random_artist_for": query(
            lambda c: k.random_artist_for(
                _draw_requests(c), c.library["artists"], c.library["countries"], c.library["genres"]
            )
        ),
        "sample_rows": query(lambda c: k.sample_rows(c.library["users"], "id", 5)),
        "sample_rows_artists": query(lambda c: k.sample_rows(c.library["artists"], "id", 1)),
        "sample_rows_disabled_country": query(
            lambda c: k.sample_rows(c.library["countries"].where(F.col("enabled_at").isNull()), "code", 1)
        ),
        "liked_songs": query(lambda c: a.liked_songs(_like_lists(c), c.library["song_likes"], c.library["songs"])),
        "followed_artists": query(
            lambda c: a.followed_artists(
                c.library["users"].select(F.col("id").alias("user_id")), c.library["artist_follows"]
            )
        ),
        "song_popularity": query(popularity),
        "top_songs": query(lambda c: a.top_songs(popularity(c), 5)),
        "follow_candidates": query(
            lambda c: a.follow_candidates(c.library["song_likes"], c.library["songs"], c.library["artist_follows"])
        ),
        "same_genre_artists": query(similar),
        "same_genre_artists_at_home": query(lambda c: similar(c, same_country=True)),
        "candidate_tastes": query(lambda c: factors(c)[0]),
        "candidate_tastes_at_home": query(lambda c: factors(c, same_country=True)[0]),
        "candidate_members": query(lambda c: factors(c)[1]),
        "candidate_members_at_home": query(lambda c: factors(c, same_country=True)[1]),
        "suggested_artists": query(lambda c: suggested(c)),
        "suggested_artists_at_home": query(lambda c: suggested(c, same_country=True)),
        "country_decay_weight": query(
            lambda c: _rounded(a.country_decay_weight(_staggered_countries(c), _midnight(WEIGHTS_AT)))
        ),
        "weighted_choice": query(lambda c: draw(c, 1.0)),
        "weighted_choice_or_none": query(lambda c: draw(c, 0.1, with_none=True)),
        "artist_last_release": query(lambda c: a.artist_last_release(c.stage["kafka_collection"])),
        "validate_play": query(lambda c: a.validate_play(c.library["play_requests"], c.library["songs"])),
        "validate_stop": query(lambda c: a.validate_stop(c.library["play_requests"], c.library["songs"])),
        "signup_eligibility": query(
            lambda c: a.signup_eligibility(c.library["signup_requests"], c.library["users"], c.library["countries"])
        ),
        "validate_like": query(lambda c: a.validate_like(c.library["like_requests"], c.library["songs"])),
        "validate_follow": query(lambda c: a.validate_follow(c.library["follow_requests"], c.library["artists"])),
        "subscribe_once": query(lambda c: a.subscribe_once(c.library["subscribe_requests"])),
        "catalogue_integrity": query(lambda c: k.catalogue_integrity(c.library)),
        "explode_collection": query(_explode),
    }
