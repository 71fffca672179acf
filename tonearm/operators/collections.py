"""Collections as documents that hold their songs, and such documents as requests and messages.

A document is one row with a list of songs. Lists are bounded: a collection of more than
`PART_SONGS` songs is several parts, each with the fields of the collection and its share of the
songs, so that a collection of any size is spread over tasks; a normal one is one part. The parts
are cut by two-level positions and collected by (collection, part).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tonearm.functions.keys import draw_order
from tonearm.functions.ranking import positions
from tonearm.operators.stage import encode_event, missing_fields

PART_SONGS = 1000
FIELDS = ("id", "name", "collection_type", "genre_id", "released_dt", "artist_id")
SONG_FIELDS = ("id", "name", "duration_sec", "collection_id", "artist_id", "genre_id")

# fixed values: keys a request to create a collection must have, and those of each of its songs
REQUEST_FIELDS = ["artist_id", "name", "type", "genre_id", "released_dt", "songs"]
REQUEST_SONG_FIELDS = ["name", "duration_sec"]

_DOCUMENT = (
    "id string, name string, collection_type string, genre_id string, released_dt string, artist_id string, "
    "songs array<struct<id: string, name: string, duration_sec: int>>"
)
_REQUEST = (
    "artist_id string, name string, type string, genre_id string, released_dt string, "
    "songs array<struct<name: string, duration_sec: int>>"
)


def collection_parts(collections: DataFrame, songs: DataFrame, part_songs: int = PART_SONGS) -> DataFrame:
    """Collections with `songs`, a list sorted by id, in parts 0 .. parts - 1 of at most `part_songs` songs.

    A collection without songs is one part with an empty list. Songs of no or an unknown collection
    are in no document.
    """
    placed = positions(songs.where(F.col("collection_id").isNotNull()), ["collection_id"], "id")
    part = F.floor((F.col("position") - 1) / part_songs).cast("int")
    parts = F.ceil(F.col("position_all") / part_songs).cast("int")
    lists = placed.groupBy(F.col("collection_id").alias("_collection"), part.alias("part")).agg(
        F.max(parts).alias("parts"), F.array_sort(F.collect_list(F.struct(*SONG_FIELDS))).alias("songs")
    )
    empty = F.array().cast(lists.schema["songs"].dataType)
    return collections.join(lists, F.col("id") == F.col("_collection"), "left").select(
        *FIELDS, F.coalesce("part", F.lit(0)).alias("part"), F.coalesce("parts", F.lit(1)).alias("parts"),
        F.coalesce("songs", empty).alias("songs"),
    )


def documents_of(parts: DataFrame) -> DataFrame:
    """One JSON document per part: the fields of the collection and `songs`."""
    text = F.to_json(F.struct(*FIELDS, "songs"), {"ignoreNullFields": "false"})
    return parts.select("id", "artist_id", "part", "parts", text.alias("document"))


def collection_by_id(requests: DataFrame, documents: DataFrame) -> DataFrame:
    """Documents of the requested collections (`collection_id`); an unknown one gets a row with found = false."""
    owned = documents.select(F.col("id").alias("collection_id"), "part", "parts", "document")
    answered = requests.select("collection_id").distinct().join(owned, "collection_id", "left")
    return answered.select("collection_id", F.col("document").isNotNull().alias("found"), "part", "parts", "document")


def documents_of_artist(requests: DataFrame, artists: DataFrame, documents: DataFrame) -> DataFrame:
    """Documents of all collections of the requested artists (`artist_id`).

    An unknown artist gets one row with found = false, a known one without collections one with found = true
    and no document. Collections of one artist are rows, not a list, so an artist may have any number.
    """
    known = artists.select(F.col("id").alias("artist_id"), F.lit(True).alias("_found"))
    owned = documents.select("artist_id", F.col("id").alias("collection_id"), "part", "parts", "document")
    answered = requests.select("artist_id").distinct().join(known, "artist_id", "left").join(owned, "artist_id", "left")
    found = F.col("_found").isNotNull()
    kept = [F.when(found, F.col(c)).alias(c) for c in ("collection_id", "part", "parts", "document")]
    return answered.select("artist_id", found.alias("found"), *kept)


def _messages(collections: DataFrame, songs: DataFrame, event_time: Column) -> DataFrame:
    collections, songs = (rows.withColumn("event_time", event_time) for rows in (collections, songs))
    return encode_event(collections, "CollectionCreated").unionByName(encode_event(songs, "SongCreated"))


def explode_documents(documents: DataFrame, event_time: Column) -> DataFrame:
    """Documents -> messages: one for each collection, one per song, which takes its ids from the document.

    Of a collection in several parts, the first part gives the message of the collection.
    """
    part = F.col("part") if "part" in documents.columns else F.lit(0)
    doc = documents.select(part.alias("_part"), F.inline(F.array(F.from_json("document", _DOCUMENT))))
    released = F.col("released_dt").try_cast("date")
    collections = doc.where("_part = 0").drop("songs", "_part").withColumn("released_dt", released)
    inherited = doc.select(F.col("id").alias("collection_id"), "artist_id", "genre_id", F.inline("songs"))
    return _messages(collections, inherited, event_time)


def _new_id(*parts: Column | str) -> Column:
    """A repeatable id of 32 hex digits."""
    return F.substring(draw_order(*parts), 1, 32)


def _any_lacks(keys: Column, key: str) -> Column:
    return F.exists(keys, lambda have: ~F.array_contains(have, key))


def answer_requests(requests: DataFrame, artists: DataFrame, genres: DataFrame, seed: str = "0") -> DataFrame:
    """Requests to create a collection (`request_id`, `document`) -> `status`, `missing` and the new `collection_id`.

    The checks are made in this order: 'MissingFields' (a key of the document, or `songs.` and a key that any
    song lacks, with their list in `missing`), 'ArtistNotFound', 'GenreNotFound', 'InvalidDate', 'InvalidSong'
    (a song without a name or a whole number of seconds), else 'ok'. A document that is no object misses all keys. The parsed fields are kept.
    """
    checked = missing_fields(requests.select("request_id", "document"), "document", REQUEST_FIELDS)
    texts = F.from_json("document", "songs array<string>")["songs"]
    keys = F.transform(texts, lambda song: F.coalesce(F.json_object_keys(song), F.array().cast("array<string>")))
    lacking = [F.when(_any_lacks(keys, key), F.lit("songs." + key)) for key in REQUEST_SONG_FIELDS]
    missing = F.concat("missing", F.array_compact(F.array(*lacking)))
    rows = checked.select(
        "request_id", missing.alias("missing"), F.inline_outer(F.array(F.from_json("document", _REQUEST)))
    )
    for table, name in ((artists, "artist_id"), (genres, "genre_id")):
        known = table.select(F.col("id").alias(name)).distinct().withColumn("_known_" + name, F.lit(True))
        rows = rows.join(known, name, "left")
    is_date = F.col("released_dt").rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & F.col("released_dt").try_cast("date").isNotNull()
    bad_song = F.exists("songs", lambda song: song["name"].isNull() | song["duration_sec"].isNull())
    status = (
        F.when(F.size("missing") > 0, "MissingFields")
        .when(F.col("_known_artist_id").isNull(), "ArtistNotFound")
        .when(F.col("_known_genre_id").isNull(), "GenreNotFound")
        .when(~F.coalesce(is_date, F.lit(False)), "InvalidDate")
        .when(F.col("songs").isNull() | bad_song, "InvalidSong")
        .otherwise("ok")
    )
    new = F.when(F.col("status") == "ok", _new_id("collection", F.col("request_id"), seed))
    return rows.withColumn("status", status).select(
        "request_id", "status", "missing", new.alias("collection_id"), "artist_id", "genre_id", "name",
        F.col("type").alias("collection_type"), "released_dt", "songs",
    )


def created_events(answered: DataFrame, event_time: Column, seed: str = "0") -> DataFrame:
    """Messages of the collections that requests created, and of their songs with new ids in the order of the list."""
    made = answered.where(F.col("status") == "ok")
    collections = made.withColumns({"id": F.col("collection_id"), "released_dt": F.col("released_dt").cast("date")})
    songs = made.select("collection_id", "artist_id", "genre_id", "request_id", F.posexplode("songs").alias("at", "song"))
    songs = songs.withColumn("id", _new_id("song", F.col("request_id"), F.col("at"), seed)).select("*", "song.*")
    return _messages(collections, songs, event_time)
