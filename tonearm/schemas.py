"""Event, stage and warehouse schemas.

The names and column lists are fixed values: producers and report users know them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# fixed values: event type -> payload fields besides event_time
EVENT_FIELDS = {
    "SignUpEvent": (
        "user_id string, email string, country_code string, first_name string, "
        "last_name string, birth_date date"
    ),
    "SignInSuccessEvent": "user_id string, session_id string",
    "SignInFailureEvent": "reason string",
    "UserSubscriptionEvent": "user_id string, session_id string",
    "SongPlayEvent": "user_id string, session_id string, song_id string, at_time_sec int",
    "SongStopEvent": (
        "user_id string, session_id string, song_id string, at_time_sec int, finished boolean"
    ),
    "SongLikedEvent": "user_id string, session_id string, song_id string",
    "ArtistFollowedEvent": "user_id string, session_id string, artist_id string",
    "ArtistCreated": "id string, name string, founded_year int, country_code string, genre_id string",
    "CollectionCreated": (
        "id string, name string, collection_type string, artist_id string, genre_id string, "
        "released_dt date"
    ),
    "SongCreated": (
        "collection_id string, artist_id string, genre_id string, id string, name string, "
        "duration_sec int"
    ),
    "GenreCreated": (
        "id string, name string, happiness_index int, mean_duration_sec int, country_code string"
    ),
    "CountryEnabled": "country_code string",
}

# fixed values: payload fields that carry a UUID
ID_FIELDS = ("id", "user_id", "session_id", "song_id", "artist_id", "collection_id", "genre_id")


@dataclass(frozen=True)
class StageTable:
    name: str
    event_types: tuple[str, ...]
    fields: str
    required: tuple[str, ...]

    @property
    def payload(self) -> T.StructType:
        return T.StructType.fromDDL(self.fields + ", event_time timestamp_ntz")

    @property
    def columns(self) -> list[str]:
        return [f for f in self.payload.names if f != "event_time"] + ["event_type", "event_time"]


# fixed values: stage table, routed event types, columns, NOT NULL columns
_STAGE = (
    (
        "kafka_user_history",
        ("SignUpEvent",),
        "user_id string, email string, country_code string, first_name string, last_name string, "
        "birth_date date",
        ("user_id", "birth_date"),
    ),
    ("kafka_country_enabled", ("CountryEnabled",), "country_code string", ()),
    (
        "kafka_genre",
        ("GenreCreated",),
        "id string, name string, happiness_index int, mean_duration_sec decimal(10,2), "
        "country_code string",
        ("id",),
    ),
    (
        "kafka_artist",
        ("ArtistCreated",),
        "id string, name string, founded_year int, country_code string",
        ("id",),
    ),
    (
        "kafka_collection",
        ("CollectionCreated",),
        "id string, name string, collection_type string, artist_id string, genre_id string, "
        "released_dt string",
        ("id",),
    ),
    (
        "kafka_song",
        ("SongCreated",),
        "id string, name string, duration_sec int, artist_id string, genre_id string, "
        "collection_id string",
        ("id",),
    ),
    (
        "kafka_user_authorization",
        ("SignInSuccessEvent",),
        "user_id string, session_id string",
        ("user_id", "session_id"),
    ),
    (
        "kafka_playback",
        ("SongPlayEvent", "SongStopEvent"),
        "user_id string, session_id string, song_id string, at_time_sec int, finished boolean",
        ("user_id", "session_id", "song_id", "at_time_sec"),
    ),
    (
        "kafka_song_like",
        ("SongLikedEvent",),
        "user_id string, session_id string, song_id string",
        ("user_id", "session_id", "song_id"),
    ),
    (
        "kafka_artist_follow",
        ("ArtistFollowedEvent",),
        "user_id string, session_id string, artist_id string",
        ("user_id", "session_id", "artist_id"),
    ),
    (
        "kafka_user_subscription",
        ("UserSubscriptionEvent",),
        "user_id string, session_id string",
        ("user_id", "session_id"),
    ),
)

STAGE_TABLES = {
    name: StageTable(name, types, fields, required + ("event_time",))
    for name, types, fields, required in _STAGE
}
ROUTED_TYPES = tuple(t for table in STAGE_TABLES.values() for t in table.event_types)
