"""The 21 load processes of the warehouse, as data."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class LoadSpec:
    """One process: `stage` table -> `target` table.

    `parts` are the stage columns of the business key in hashing order, `part_names` the
    hashed columns of a link. `fields` maps target columns to Spark SQL expressions over
    the stage row.
    """

    kind: str
    target: str
    stage: str
    key: str
    parts: tuple[str, ...]
    part_names: tuple[str, ...] = ()
    fields: dict[str, str] = field(default_factory=dict)


def _hub(entity: str, stage: str, part: str) -> LoadSpec:
    return LoadSpec("hub", f"hub_{entity}", stage, f"{entity}_id", (part,))


def _sat(target: str, stage: str, key: str, part: str, **fields: str) -> LoadSpec:
    return LoadSpec("sat", target, stage, key, (part,), fields={"actual_dtm": "event_time", **fields})


def _link(target: str, stage: str, parts: dict[str, str]) -> LoadSpec:
    key = target.removeprefix("link_") + "_id"
    return LoadSpec("link", target, stage, key, tuple(parts), tuple(parts.values()))


def _lsat(target: str, stage: str, parts: tuple[str, ...], **fields: str) -> LoadSpec:
    key = target.removeprefix("lsat_") + "_id"
    return LoadSpec("lsat", target, stage, key, parts, fields={"actual_dtm": "event_time", **fields})


ACTION_TYPE = """
    CASE event_type
      WHEN 'SongPlayEvent' THEN if(at_time_sec = 0, 'Start', if(at_time_sec <> 0, 'Restart', 'Complete'))
      WHEN 'SongStopEvent' THEN if(finished <=> false, 'Pause', 'Complete')
      ELSE 'Complete'
    END
"""

# fixed values: table names, business keys in hashing order, columns of each process
SPECS = (
    _hub("user", "kafka_user_history", "user_id"),
    _hub("artist", "kafka_artist", "id"),
    _hub("song", "kafka_song", "id"),
    _hub("session", "kafka_user_authorization", "session_id"),
    _hub("collection", "kafka_collection", "id"),
    _sat(
        "sat_user", "kafka_user_history", "user_id", "user_id",
        email="email",
        birth_dt="CAST(birth_date AS timestamp_ntz)",
        first_name="first_name",
        last_name="last_name",
        registration_dtm="event_time",
        country_code="country_code",
    ),
    _sat("sat_user_subscription", "kafka_user_subscription", "user_id", "user_id", is_premium="true"),
    _sat(
        "sat_song", "kafka_song", "song_id", "id",
        name="name", duration_sec="duration_sec", original_genre_id="genre_id",
    ),
    _sat(
        "sat_collection", "kafka_collection", "collection_id", "id",
        name="name",
        collection_type="collection_type",
        original_genre_id="genre_id",
        release_dt="released_dt",
    ),
    _sat("sat_session", "kafka_user_authorization", "session_id", "session_id"),
    _sat(
        "sat_artist", "kafka_artist", "artist_id", "id",
        name="name", country_code="country_code", founded_year="founded_year",
    ),
    _link(
        "link_session_song_user_like", "kafka_song_like",
        {"session_id": "session_id", "song_id": "song_id", "user_id": "user_id"},
    ),
    _link(
        "link_session_song_user_listen", "kafka_playback",
        {"session_id": "session_id", "song_id": "song_id", "user_id": "user_id"},
    ),
    _link("link_collection_song", "kafka_song", {"collection_id": "collection_id", "id": "song_id"}),
    _link("link_artist_collection", "kafka_collection", {"id": "collection_id", "artist_id": "artist_id"}),
    _link(
        "link_session_artist_user_follow", "kafka_artist_follow",
        {"session_id": "session_id", "artist_id": "artist_id", "user_id": "user_id"},
    ),
    _lsat(
        "lsat_session_song_user_listen", "kafka_playback", ("session_id", "song_id", "user_id"),
        at_time_sec="at_time_sec", action_type=ACTION_TYPE,
    ),
    _lsat("lsat_session_song_user_like", "kafka_song_like", ("session_id", "song_id", "user_id")),
    _lsat("lsat_session_artist_user_follow", "kafka_artist_follow", ("session_id", "artist_id", "user_id")),
    LoadSpec(
        "ref", "ref_country_subscription_cost", "kafka_country_enabled", "country_code", ("country_code",),
        fields={"enabled_dt": "event_time"},
    ),
    LoadSpec(
        "ref", "ref_genre", "kafka_genre", "original_genre_id", ("id",),
        fields={
            "genre_name": "name",
            "creation_dtm": "event_time",
            "country_code": "country_code",
            "happiness_index": "happiness_index",
            "average_duration_sec": "CAST(round(mean_duration_sec) AS int)",
        },
    ),
)

BY_TARGET = {spec.target: spec for spec in SPECS}

# groups in load order; the processes of one group do not depend on each other
LOAD_ORDER = ("hub", "sat", "link", "lsat", "ref")
