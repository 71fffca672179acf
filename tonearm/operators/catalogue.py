"""Catalogue queries over whole tables of requests instead of one id per call."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tonearm.functions.keys import draw_order, hash_uniform
from tonearm.functions.ranking import positions
from tonearm.operators.stage import encode_event


def countries_list(countries: DataFrame, enabled_only: bool = False) -> DataFrame:
    enabled = F.col("enabled_at").isNotNull()
    rows = countries.where(enabled) if enabled_only else countries
    return rows.select("code", "name", "enabled_at", enabled.alias("enabled")).orderBy("code")


def genres_by_country(genres: DataFrame, country: str | None = None) -> DataFrame:
    return genres if country is None else genres.where(F.col("country_code") == F.upper(F.lit(country)))


def songs_of_collection(songs: DataFrame, collections: DataFrame) -> DataFrame:
    """Songs of the requested collections (`collection_id`)."""
    return songs.join(collections.select("collection_id"), "collection_id", "left_semi").select(*songs.columns)


def lookup_entities(requests: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Requests (`entity`, `key`) with a flag whether the table has a row of that key."""
    known = table.select(F.col(key).alias("key")).distinct().withColumn("_found", F.lit(True))
    return requests.join(known, "key", "left").select("entity", "key", F.col("_found").isNotNull().alias("found"))


def collection_documents(collections: DataFrame, songs: DataFrame) -> DataFrame:
    """One line per song with the fields of its collection, and one line without a song for an empty
    collection. The layout is the same for collections of any size; no row holds a whole one."""
    entry = F.struct("id", "name", "duration_sec", "collection_id", "artist_id", "genre_id")
    lines = songs.select(F.col("collection_id").alias("_collection"), entry.alias("song"))
    return collections.join(lines, F.col("id") == F.col("_collection"), "left").select(*DOCUMENT)


DOCUMENT = ("id", "name", "collection_type", "genre_id", "released_dt", "artist_id", "song")


def collection_document(documents: DataFrame) -> DataFrame:
    """One JSON text per line of a collection's document."""
    text = F.to_json(F.struct(*DOCUMENT), {"ignoreNullFields": "false"})
    return documents.select("id", text.alias("document"))


def collections_of_artist(requests: DataFrame, artists: DataFrame, documents: DataFrame) -> DataFrame:
    """Document lines of the requested artists (`artist_id`); an unknown artist gets one row with found = false."""
    known = artists.select(F.col("id").alias("artist_id"), F.lit(True).alias("_found"))
    text = F.to_json(F.struct(*DOCUMENT), {"ignoreNullFields": "false"})
    owned = documents.select("artist_id", F.col("id").alias("collection_id"), text.alias("document"))
    return (
        requests.select("artist_id").join(known, "artist_id", "left")
        .join(owned, "artist_id", "left")
        .select("artist_id", F.col("_found").isNotNull().alias("found"), "collection_id", "document")
    )


def _drawn(key: str, seed: str) -> Column:
    """Aggregate: the id a repeatable uniform draw picks. A running minimum, so groups of
    any size are combined on the map side."""
    return F.min(F.struct(draw_order(F.col(key), seed).alias("draw"), F.col(key).alias("id")))["id"]


def random_song_per_country(songs: DataFrame, artists: DataFrame, seed: str = "0") -> DataFrame:
    """A random song per country of the artist, and one over all countries (country NULL)."""
    per_artist = songs.groupBy("artist_id").agg(_drawn("id", seed).alias("song_id"))
    homes = artists.select(F.col("id").alias("artist_id"), "country_code")
    placed = per_artist.join(homes, "artist_id", "left")
    by_country = placed.where(F.col("country_code").isNotNull()).groupBy("country_code").agg(
        _drawn("song_id", seed).alias("song_id")
    )
    overall = per_artist.agg(_drawn("song_id", seed).alias("song_id"))
    return by_country.unionByName(overall.withColumn("country_code", F.lit(None).cast("string")))


def random_artist(artists: DataFrame, seed: str = "0") -> DataFrame:
    """A random artist for every filter on country, genre, both or none.

    A NULL in `country_code` or `genre_id` together with its flag = false means "any".
    """
    country, genre = F.col("country_code"), F.col("genre_id")
    return (
        artists.groupingSets([[country, genre], [country], [genre], []], country, genre)
        .agg(
            (F.grouping("country_code") == 0).alias("by_country"),
            (F.grouping("genre_id") == 0).alias("by_genre"),
            _drawn("id", seed).alias("artist_id"),
        )
    )


def _known(table: DataFrame, key: str, name: str) -> DataFrame:
    return table.select(F.col(key).alias(name)).distinct().withColumn("_known_" + name, F.lit(True))


def _unknown(name: str, status: str) -> Column:
    return F.when(F.col(name).isNotNull() & F.col("_known_" + name).isNull(), status)


def random_song_for(
    requests: DataFrame, songs: DataFrame, artists: DataFrame, countries: DataFrame, seed: str = "0"
) -> DataFrame:
    """Requests with a `country_code` (NULL: any) -> `song_id` and `status`: 'ok', 'NoSong' or 'CountryNotFound'."""
    drawn = random_song_per_country(songs, artists, seed).select(F.col("country_code").alias("_country"), "song_id")
    answered = requests.join(_known(countries, "code", "country_code"), "country_code", "left").join(
        drawn, F.col("country_code").eqNullSafe(F.col("_country")), "left"
    )
    refused = _unknown("country_code", "CountryNotFound")
    status = F.coalesce(refused, F.when(F.col("song_id").isNull(), "NoSong"), F.lit("ok"))
    return answered.select(*requests.columns, F.when(refused.isNull(), F.col("song_id")).alias("song_id"), status.alias("status"))


def random_artist_for(
    requests: DataFrame, artists: DataFrame, countries: DataFrame, genres: DataFrame, seed: str = "0"
) -> DataFrame:
    """Requests with a `country_code` and a `genre_id` (NULL: any) -> `artist_id` and `status`: 'ok',
    'NoArtist', 'CountryNotFound' or, for a known country, 'GenreNotFound'."""
    filters = ("country_code", "genre_id")
    drawn = random_artist(artists, seed).select(
        *[F.col(f).alias("_" + f) for f in filters], "by_country", "by_genre", "artist_id"
    )
    same = (
        F.col("country_code").eqNullSafe(F.col("_country_code"))
        & F.col("genre_id").eqNullSafe(F.col("_genre_id"))
        & (F.col("country_code").isNotNull() == F.col("by_country"))
        & (F.col("genre_id").isNotNull() == F.col("by_genre"))
    )
    answered = (
        requests.join(_known(countries, "code", "country_code"), "country_code", "left")
        .join(_known(genres, "id", "genre_id"), "genre_id", "left")
        .join(drawn, same, "left")
    )
    refused = F.coalesce(_unknown("country_code", "CountryNotFound"), _unknown("genre_id", "GenreNotFound"))
    status = F.coalesce(refused, F.when(F.col("artist_id").isNull(), "NoArtist"), F.lit("ok"))
    return answered.select(
        *requests.columns, F.when(refused.isNull(), F.col("artist_id")).alias("artist_id"), status.alias("status")
    )


def sample_rows(rows: DataFrame, key: str, n: int, seed: str = "0") -> DataFrame:
    """`n` random rows: per-partition top n by hash, merged. Nothing else is sorted or moved."""
    return rows.withColumn("_draw", draw_order(F.col(key), seed)).orderBy("_draw").limit(n).drop("_draw")


def same_genre_artists(
    users: DataFrame,
    likes: DataFrame,
    songs: DataFrame,
    artists: DataFrame,
    seed: str = "0",
    same_country: bool = False,
) -> DataFrame:
    """Per user and genre of the songs they like: how many artists to choose from, and one drawn.

    Users and artists of a genre are never paired up: artists are numbered within their
    genre (and country), a user draws a number and looks that artist up.
    """
    group = ["genre_id", "country_code"] if same_country else ["genre_id"]
    tastes = likes.join(songs.select(F.col("id").alias("song_id"), "genre_id"), "song_id").select(
        "user_id", "genre_id"
    ).distinct()
    wanted = tastes.join(users.select(F.col("id").alias("user_id"), "country_code"), "user_id")
    if not same_country:
        wanted = wanted.drop("country_code")
    sizes = artists.groupBy(*group).agg(F.count(F.lit(1)).alias("n_artists"))
    numbered = positions(artists.select(*group, F.col("id").alias("artist_id")), group, "artist_id")
    draw = F.floor(hash_uniform(F.col("user_id"), F.col("genre_id"), seed) * F.col("n_artists")) + 1
    picked = wanted.join(sizes, group, "left").withColumn("position", draw)
    return (
        picked.join(numbered.drop("position_all"), [*group, "position"], "left")
        .select("user_id", *group, F.coalesce("n_artists", F.lit(0)).alias("n_artists"), "artist_id")
    )


def genre_candidates(
    users: DataFrame, likes: DataFrame, songs: DataFrame, artists: DataFrame, same_country: bool = False
) -> tuple[DataFrame, DataFrame]:
    """All artists of the genres of the songs that each user likes, as two factors instead of all pairs.

    The first has a row per user and genre (and country of the user): how many liked songs lead there and
    how many artists it offers. The second has the artists of each genre (and country). Joined on these
    columns they are the pairs; an artist has one genre, so a pair comes from one row. Their size is that
    of the likes and of the catalogue, however many pairs they stand for.
    """
    group = ["genre_id", "country_code"] if same_country else ["genre_id"]
    members = artists.select(*group, F.col("id").alias("artist_id")).dropna(subset=group)
    sizes = members.groupBy(*group).agg(F.count(F.lit(1)).alias("n_artists"))
    genre_of = songs.select(F.col("id").alias("song_id"), "genre_id").where(F.col("genre_id").isNotNull())
    tastes = likes.join(genre_of, "song_id").groupBy("user_id", "genre_id").agg(F.count(F.lit(1)).alias("liked"))
    wanted = tastes.join(users.select(F.col("id").alias("user_id"), "country_code"), "user_id")
    rows = wanted.join(sizes, group, "left").select(
        "user_id", *group, "liked", F.coalesce("n_artists", F.lit(0)).cast("long").alias("n_artists")
    )
    return rows, members


def candidates_of(requests: DataFrame, tastes: DataFrame, members: DataFrame) -> DataFrame:
    """The pairs of the requested users (`user_id`): user, artist and how many liked songs lead to the artist."""
    group = [c for c in members.columns if c != "artist_id"]
    asked = tastes.join(requests.select("user_id").distinct(), "user_id", "left_semi")
    return asked.join(members, group).select("user_id", "artist_id", "liked")


def suggested_artists(
    users: DataFrame,
    likes: DataFrame,
    songs: DataFrame,
    artists: DataFrame,
    seed: str = "0",
    same_country: bool = False,
) -> DataFrame:
    """An artist to listen to next for every user: one of the genre of a drawn liked song, or any artist
    where there is none (`by_genre` is false), with `same_country` of the user's country.

    The genre is a running minimum over the likes; artists are looked up by their number in the
    genre or country, as in `same_genre_artists`.
    """
    place = ["country_code"] if same_country else []
    people = users.select(F.col("id").alias("user_id"), "country_code")
    genre_of = songs.select(F.col("id").alias("song_id"), "genre_id")
    first = F.min(F.struct(draw_order(F.col("user_id"), F.col("song_id"), seed).alias("draw"), F.col("genre_id").alias("genre_id")))
    taste = likes.join(genre_of, "song_id").groupBy("user_id").agg(first["genre_id"].alias("genre_id"))

    def pick(rows: DataFrame, group: list[str], name: str) -> DataFrame:
        numbered = positions(artists.select(*group, F.col("id").alias(name)), group, name)
        sizes = artists.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"))
        if group:
            rows = rows.join(sizes, group, "left")
        else:
            rows = rows.withColumn("_n", sizes.select("_n").scalar())
        draw = F.floor(hash_uniform(F.col("user_id"), F.lit(name), seed) * F.col("_n")) + 1
        return rows.withColumn("position", draw).join(
            numbered.drop("position_all"), [*group, "position"], "left"
        ).drop("position", "_n")

    chosen = pick(people.join(taste, "user_id", "left"), ["genre_id", *place], "similar")
    chosen = pick(chosen, place, "any")
    return chosen.select(
        "user_id", "genre_id", F.col("similar").isNotNull().alias("by_genre"), F.coalesce("similar", "any").alias("artist_id")
    )


def catalogue_integrity(tables: Mapping[str, DataFrame]) -> DataFrame:
    """References to a country, genre, artist or collection that does not exist."""
    references = (
        ("genres", "country_code", "countries", "code"),
        ("artists", "country_code", "countries", "code"),
        ("artists", "genre_id", "genres", "id"),
        ("collections", "artist_id", "artists", "id"),
        ("collections", "genre_id", "genres", "id"),
        ("songs", "collection_id", "collections", "id"),
        ("songs", "artist_id", "artists", "id"),
        ("songs", "genre_id", "genres", "id"),
    )
    found = None
    for entity, column, target, key in references:
        known = tables[target].select(F.col(key).alias("value"))
        rows = tables[entity].select(
            F.lit(entity).alias("entity"), "id", F.lit(column).alias("reference"), F.col(column).alias("value")
        ).where(F.col("value").isNotNull())
        bad = rows.join(known, "value", "left_anti").select("entity", "id", "reference", "value")
        found = bad if found is None else found.unionByName(bad)
    return found


DOCUMENT_SCHEMA = (
    "id string, name string, collection_type string, genre_id string, released_dt string, artist_id string, "
    "song struct<id: string, name: string, duration_sec: int>"
)


def explode_collection(documents: DataFrame, event_time: Column) -> DataFrame:
    """Document lines -> messages: one for each collection, one per song. Songs take collection,
    artist and genre from the line."""
    doc = documents.select(F.from_json("document", DOCUMENT_SCHEMA).alias("d")).select("d.*")
    collections = doc.drop("song").distinct().withColumn("released_dt", F.col("released_dt").cast("date"))
    songs = doc.where(F.col("song").isNotNull()).select(
        F.col("id").alias("collection_id"), "artist_id", "genre_id", "song.id", "song.name", "song.duration_sec"
    )
    collections, songs = (rows.withColumn("event_time", event_time) for rows in (collections, songs))
    return encode_event(collections, "CollectionCreated").unionByName(encode_event(songs, "SongCreated"))
