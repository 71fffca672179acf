"""Oracle SQL of the ingest layer. Messages are written here with string functions, not parsed."""

from oracles.base import HISTORY, HUBS, LINKS, LSATS, SATS, VAULT
from oracles.vault import CATALOGUE, intervals_sql

TIME = "strftime(event_time, '%Y-%m-%dT%H:%M:%S')"

# event type -> (stage table, condition, payload in event order)
EVENTS = {
    "SignUpEvent": ("kafka_user_history", "true", "'user_id': user_id, 'email': email, 'country_code': country_code, "
                    "'first_name': first_name, 'last_name': last_name, 'birth_date': strftime(birth_date, '%Y-%m-%d')"),
    "CountryEnabled": ("kafka_country_enabled", "true", "'country_code': country_code"),
    "GenreCreated": ("kafka_genre", "true", "'id': id, 'name': name, 'happiness_index': happiness_index, "
                     "'mean_duration_sec': CAST(mean_duration_sec AS INT), 'country_code': country_code"),
    "ArtistCreated": ("kafka_artist", "true", "'id': id, 'name': name, 'founded_year': founded_year, "
                      "'country_code': country_code, 'genre_id': NULL::VARCHAR"),
    "CollectionCreated": ("kafka_collection", "true", "'id': id, 'name': name, 'collection_type': collection_type, "
                          "'artist_id': artist_id, 'genre_id': genre_id, 'released_dt': released_dt"),
    "SongCreated": ("kafka_song", "true", "'collection_id': collection_id, 'artist_id': artist_id, 'genre_id': genre_id, "
                    "'id': id, 'name': name, 'duration_sec': duration_sec"),
    "SignInSuccessEvent": ("kafka_user_authorization", "true", "'user_id': user_id, 'session_id': session_id"),
    "SongPlayEvent": ("kafka_playback", "event_type = 'SongPlayEvent'",
                      "'user_id': user_id, 'session_id': session_id, 'song_id': song_id, 'at_time_sec': at_time_sec"),
    "SongStopEvent": ("kafka_playback", "event_type = 'SongStopEvent'",
                      "'user_id': user_id, 'session_id': session_id, 'song_id': song_id, 'at_time_sec': at_time_sec, "
                      "'finished': finished"),
    "SongLikedEvent": ("kafka_song_like", "true", "'user_id': user_id, 'session_id': session_id, 'song_id': song_id"),
    "ArtistFollowedEvent": ("kafka_artist_follow", "true", "'user_id': user_id, 'session_id': session_id, 'artist_id': artist_id"),
    "UserSubscriptionEvent": ("kafka_user_subscription", "true", "'user_id': user_id, 'session_id': session_id"),
}


def encoded(event_type: str) -> str:
    table, where, payload = EVENTS[event_type]
    data = f"to_json({{'event_time': {TIME}, {payload}}})::VARCHAR"
    return f"SELECT *, {data} AS data, sha256('{event_type}' || {data}) AS event_id FROM {table} WHERE {where}"


EDGE = {
    "e_src": """
        SELECT *, event_id % 8 AS kind, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS tm, 'U' || user_id AS u,
               'X' || event_id AS x, 'S' || (event_id % 3000) AS s, event_id % 60 AS pos
        FROM events""",
    "e_data": """
        SELECT *, CASE kind
            WHEN 0 THEN event_type WHEN 1 THEN 'SignInFailureEvent' WHEN 2 THEN 'SongPlayEvent' WHEN 3 THEN 'SignUpEvent'
            WHEN 4 THEN 'SongPlayEvent' WHEN 6 THEN 'SignUpEvent' WHEN 7 THEN 'SongStopEvent' END AS type,
          CASE kind
            WHEN 0 THEN '{"event_time":"' || tm || '","user_id":"' || u || '"}'
            WHEN 1 THEN '{"event_time":"' || tm || '","reason":"bad ' || event_type || '"}'
            WHEN 2 THEN '{"event_time":"' || tm || '","user_id":"' || u || '","session_id":"' || x || '","song_id":"' || s
                        || '","at_time_sec":' || pos || ',"device":"phone"}'
            WHEN 3 THEN '{"event_time":"' || tm || '","user_id":"N' || event_id
                        || '","country_code":"01","first_name":"A","last_name":"B","birth_date":"2001-02-03"}'
            WHEN 4 THEN '{"event_time":"' || tm || '","session_id":"' || x || '","song_id":"' || s || '","at_time_sec":' || pos || '}'
            WHEN 5 THEN '{"type":"SongPlayEvent","data":{' || event_id
            WHEN 6 THEN '{"event_time":"' || tm || '","user_id":"N' || event_id || '","email":"n' || event_id
                        || '@example.com","country_code":"01","first_name":"A","last_name":"B","birth_date":null}'
            WHEN 7 THEN '{"event_time":"' || tm || '","user_id":"' || u || '","session_id":"' || x || '","song_id":"' || s
                        || '","at_time_sec":' || pos || ',"finished":false}' END AS data
        FROM e_src""",
    "e_once": "SELECT * EXCLUDE (event_id), event_id AS n, sha256(coalesce(type, '') || data) AS event_id FROM e_data",
    "e_all": "SELECT * FROM e_once UNION ALL SELECT * FROM e_once WHERE kind = 7",
    "e_table": """
        SELECT *, CASE WHEN kind IN (2, 4, 7) THEN 'kafka_playback' WHEN kind IN (3, 6) THEN 'kafka_user_history' END AS stage_table,
               CASE kind WHEN 4 THEN '["user_id"]' WHEN 5 THEN '["type"]' WHEN 6 THEN '["birth_date"]' END AS missing
        FROM e_all""",
}

COLUMNS = {
    "kafka_user_history": "user_id, email, country_code, first_name, last_name, birth_date",
    "kafka_country_enabled": "country_code",
    "kafka_genre": "id, name, happiness_index, mean_duration_sec, country_code",
    "kafka_artist": "id, name, founded_year, country_code",
    "kafka_collection": "id, name, collection_type, artist_id, genre_id, released_dt",
    "kafka_song": "id, name, duration_sec, artist_id, genre_id, collection_id",
    "kafka_user_authorization": "user_id, session_id",
    "kafka_playback": "user_id, session_id, song_id, at_time_sec, finished",
    "kafka_song_like": "user_id, session_id, song_id",
    "kafka_artist_follow": "user_id, session_id, artist_id",
    "kafka_user_subscription": "user_id, session_id",
}

EDGE_ROWS = {
    "kafka_user_history": """
        SELECT event_id, 'N' || n AS user_id, NULL AS email, '01' AS country_code, 'A' AS first_name, 'B' AS last_name,
               DATE '2001-02-03' AS birth_date, type AS event_type, ts AS event_time FROM e_once WHERE kind = 3""",
    "kafka_playback": """
        SELECT event_id, u AS user_id, x AS session_id, s AS song_id, CAST(pos AS INT) AS at_time_sec,
               CASE WHEN kind = 7 THEN false END AS finished, type AS event_type, ts AS event_time
        FROM e_once WHERE kind IN (2, 7)""",
}


def stage_sql(table: str, refused: bool = False) -> str:
    """Distinct messages of one table, with the accepted edge rows; an exact copy counts once."""
    own = [f"SELECT event_id, {COLUMNS[table]}, event_type, event_time FROM ({encoded(t)}) x"
           for t, (name, _, _) in EVENTS.items() if name == table]
    sql = f"SELECT DISTINCT * FROM ({' UNION ALL '.join(own)}) rows_of_table"
    if table in EDGE_ROWS:
        sql = f"SELECT * FROM ({sql}) m UNION ALL {EDGE_ROWS[table]}"
    if refused:
        sql += """ UNION ALL SELECT event_id, NULL, x, s, CAST(pos AS INT), NULL, type, ts FROM e_once WHERE kind = 4"""
    return sql


def summary(tables: dict[str, tuple[str, str]]) -> str:
    """{table: (sql, columns)} -> rows and a checksum over whole records per table."""

    def record(columns):
        return "concat_ws('|', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c in sorted(columns)) + ")"

    parts = [
        f"""SELECT '{name}' AS table_name, count(*) AS n,
            CAST(coalesce(sum(concat('0x', substr(sha256({record(columns)}), 1, 15))::BIGINT), 0) AS VARCHAR) AS checksum
            FROM ({sql}) q_{name}"""
        for name, (sql, columns) in tables.items()
    ]
    return " UNION ALL ".join(parts)


def _given_messages() -> str:
    """Messages of all stage tables; `absent` are the keys of (user_id, song_id) that a payload lacks."""
    parts = []
    for t, (table, _, payload) in EVENTS.items():
        absent = ",".join(f'"{k}"' for k in ("user_id", "song_id") if f"'{k}':" not in payload)
        parts.append(f"""SELECT '{t}' AS type, data, event_id, '{table}' AS stage_table, '[{absent}]' AS absent
            FROM ({encoded(t)}) g_{t}""")
    return " UNION ALL ".join(parts)


def _messages(*types: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{{"type":"{t}","data":' || data || '}}' AS value FROM ({encoded(t)}) m_{t}""" for t in types or EVENTS
    )


def stage_columns(table: str) -> list[str]:
    return [*COLUMNS[table].split(", "), "event_type", "event_time"]


QUARANTINE = "SELECT event_id, type, stage_table, missing, data FROM e_table WHERE missing IS NOT NULL"
UNROUTED = """SELECT event_id, type, CASE WHEN kind = 1 THEN 'bad ' || event_type END AS reason, data
    FROM e_all WHERE kind IN (0, 1)"""

VAULT_COLUMNS = {
    **{t: (v[1], "original_id", "source") for t, v in HUBS.items()},
    **{t: (v[1], *[f[0] for f in v[3]], "row_hash", "source") for t, v in SATS.items()},
    **{t: (t.removeprefix("link_") + "_id", *[name for _, name in v[1]]) for t, v in LINKS.items()},
    **{t: (t.removeprefix("lsat_") + "_id", *[f[0] for f in v[2]], "source") for t, v in LSATS.items()},
    "ref_country_subscription_cost": (
        "country_code", "enabled_dt", "subscription_type", "subscription_cost", "royalty", "source"),
    "ref_genre": (
        "original_genre_id", "genre_name", "happiness_index", "average_duration_sec", "country_code", "creation_dtm", "source"),
}


def streamed_vault() -> tuple[dict[str, str], dict[str, tuple[str, str]]]:
    """Stage tables as the stream leaves them: given rows plus accepted edge rows."""
    widened = {}
    for table, sql in EDGE_ROWS.items():
        columns = COLUMNS[table] + ", event_type, event_time"
        widened["all_" + table] = f"SELECT {columns} FROM {table} UNION ALL SELECT {columns} FROM ({sql}) e"
    out = {}
    for target, sql in VAULT.items():
        for table in EDGE_ROWS:
            sql = sql.replace(f"FROM {table} ", f"FROM all_{table} ")
        out[target] = (sql, VAULT_COLUMNS[target])
    return widened, out


def oracles(with_ctes) -> dict[str, str]:
    def edge(sql):
        return with_ctes(sql, {**EDGE, "m_given": _given_messages()})

    out = {
        "decode_envelope": edge("SELECT type, data, event_id FROM e_all UNION ALL SELECT type, data, event_id FROM m_given"),
        "route_events": edge("""SELECT event_id, type, stage_table FROM e_table
            UNION ALL SELECT event_id, type, stage_table FROM m_given"""),
        "project_payload": edge(stage_sql("kafka_playback", refused=True)),
        "surrogate_event_id": edge("SELECT data, event_id FROM e_all UNION ALL SELECT data, event_id FROM m_given"),
        "enforce_required": edge(QUARANTINE + " AND stage_table = 'kafka_playback'"),
        "quarantined_events": edge(QUARANTINE),
        "unrouted_events": edge(UNROUTED),
        "dedupe_events": edge("SELECT event_id, type, data FROM e_once UNION ALL SELECT DISTINCT event_id, type, data FROM m_given"),
        "encode_event": with_ctes(_messages()),
        "resolve_event_time": """SELECT event_id, CASE WHEN event_id % 2 = 0 THEN ts ELSE TIMESTAMP '1998-01-01' END AS event_time
            FROM events""",
        "missing_fields": edge("""SELECT event_id, data, CASE WHEN kind IN (2, 7) THEN '[]' WHEN kind IN (0, 3, 6) THEN '["song_id"]'
            WHEN kind = 4 THEN '["user_id"]' ELSE '["user_id","song_id"]' END AS missing FROM e_all
            UNION ALL SELECT event_id, data, absent FROM m_given"""),
        "publish_events": with_ctes(_messages()),
        "read_events": with_ctes(_messages()),
        "append_table": with_ctes(summary({t: (f"SELECT * FROM {t}", stage_columns(t)) for t in COLUMNS})),
        "stream_stage_playback": edge(stage_sql("kafka_playback")),
        "run_load_plan": with_ctes(summary({t: (f"SELECT * FROM {t}", VAULT_COLUMNS[t]) for t in VAULT})),
        "stored_histories": with_ctes(
            summary({t + "_history": (intervals_sql(t), (*VAULT_COLUMNS[t], "valid_to")) for t in CATALOGUE}), HISTORY
        ),
        "stream_song_popularity": edge(f"""
            SELECT song_id, count(*) - 1 AS listen_count
            FROM ({stage_sql("kafka_playback")}) p JOIN kafka_song s ON s.id = p.song_id
            WHERE p.event_type = 'SongStopEvent' AND p.at_time_sec > 0.5 * s.duration_sec GROUP BY song_id"""),
    }
    has_time = "TRY_CAST(CASE WHEN json_valid(data) THEN data ->> '$.event_time' END AS TIMESTAMP) IS NOT NULL"
    out["stream_unique_events"] = f"SELECT * FROM ({out['dedupe_events']}) WHERE {has_time}"
    out["stream_polled_playback"] = out["stream_stage_playback"]
    out["append_table_compacted"] = out["append_table"]
    out["stream_current_popularity"] = out["stream_song_popularity"]
    for table in COLUMNS:
        out["stage_" + table.removeprefix("kafka_")] = edge(stage_sql(table))
    tables = {t: (stage_sql(t), (*stage_columns(t), "event_id")) for t in COLUMNS}
    tables["quarantine"] = (QUARANTINE, ("event_id", "type", "stage_table", "missing", "data"))
    tables["unrouted"] = (UNROUTED, ("event_id", "type", "reason", "data"))
    out["stream_stage"] = out["append_stage"] = edge(summary(tables))
    widened, loaded = streamed_vault()
    out["stream_vault"] = with_ctes(summary(loaded), {**EDGE, **widened})
    return out
