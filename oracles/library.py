"""Oracle SQL of the catalogue and activity queries."""

from oracles.base import LIBRARY, X, _uniform

LIBRARY["like_requests"] = """
    SELECT event_id AS request_id, 'U' || user_id AS user_id, 'S' || (event_id % 40 * 100) AS song_id, ts AS event_time FROM events"""
LIBRARY["follow_requests"] = """
    SELECT event_id AS request_id, 'U' || user_id AS user_id, 'A' || (event_id % 130) AS artist_id, ts AS event_time FROM events"""
LIBRARY["subscribe_requests"] = """
    SELECT event_id AS request_id, 'U' || user_id AS user_id, ts AS event_time FROM events WHERE event_type = 'purchase'"""

DOCUMENT = """to_json({'id': c.id, 'name': c.name, 'collection_type': c.collection_type, 'genre_id': c.genre_id,
    'released_dt': c.released_dt, 'artist_id': c.artist_id, 'song': CASE WHEN s.id IS NOT NULL THEN
        {'id': s.id, 'name': s.name, 'duration_sec': s.duration_sec, 'collection_id': s.collection_id,
         'artist_id': s.artist_id, 'genre_id': s.genre_id} END})::VARCHAR"""

CTES = {
    "l_document": f"""
        SELECT c.artist_id, c.id, {DOCUMENT} AS document
        FROM collections c LEFT JOIN songs s ON s.collection_id = c.id""",
    "l_nested": """
        SELECT c.id, c.artist_id, 0 AS part, 1 AS parts, to_json({'id': c.id, 'name': any_value(c.name),
               'collection_type': any_value(c.collection_type), 'genre_id': any_value(c.genre_id),
               'released_dt': any_value(c.released_dt), 'artist_id': c.artist_id,
               'songs': coalesce(list({'id': s.id, 'name': s.name, 'duration_sec': s.duration_sec, 'collection_id': s.collection_id,
                   'artist_id': s.artist_id, 'genre_id': s.genre_id} ORDER BY s.id) FILTER (s.id IS NOT NULL), [])})::VARCHAR AS document
        FROM collections c LEFT JOIN songs s ON s.collection_id = c.id GROUP BY c.id, c.artist_id""",
    "l_create": """
        SELECT 'R' || id AS request_id, name, artist_id, collection_type, genre_id, released_dt, id AS old_id,
               CAST(substr(id, 2) AS BIGINT) AS k, (SELECT count(*) FROM songs WHERE collection_id = c.id) AS n_songs
        FROM collections c""",
    "l_answer": """
        SELECT *, CASE WHEN k % 13 = 0 OR (k % 19 = 0 AND k % 23 <> 0 AND n_songs > 0) THEN 'MissingFields'
                       WHEN k % 7 = 0 OR artist_id NOT IN (SELECT id FROM artists) THEN 'ArtistNotFound'
                       WHEN k % 11 = 0 OR genre_id NOT IN (SELECT id FROM genres) THEN 'GenreNotFound'
                       WHEN k % 17 = 0 THEN 'InvalidDate' ELSE 'ok' END AS status,
               substr(sha256(concat_ws('#', 'collection', request_id, '0')), 1, 32) AS collection_id
        FROM l_create""",
    "l_staggered": "SELECT code, name, enabled_at + CAST(code AS INT) * INTERVAL 1 DAY AS enabled_at FROM countries",
    "l_weight": """
        SELECT code, exp(-ln(2) / 14 * date_diff('microsecond', enabled_at, TIMESTAMP '1995-03-01') / 86400e6) AS weight,
               exp(-0.009 * date_diff('microsecond', enabled_at, TIMESTAMP '1995-03-01') / 3600e6) AS hourly_weight
        FROM l_staggered WHERE enabled_at IS NOT NULL""",
    "l_like_list": """
        SELECT id AS user_id, CASE WHEN CAST(substr(id, 2) AS BIGINT) % 2 = 1
               THEN 'A' || (CAST(substr(id, 2) AS BIGINT) % 10) END AS artist_id FROM users""",
    "l_popular": """
        SELECT song_id, count(*) - 1 AS listen_count
        FROM kafka_playback p JOIN songs s ON s.id = p.song_id
        WHERE p.event_type = 'SongStopEvent' AND at_time_sec > 0.5 * duration_sec GROUP BY song_id""",
    "l_taste": "SELECT DISTINCT l.user_id, s.genre_id FROM song_likes l JOIN songs s ON s.id = l.song_id",
}


def draw(column: str) -> str:
    return f"sha256(concat_ws('#', {column}, '0'))"


def sample(table: str, key: str, n: int, where: str = "true") -> str:
    return f"SELECT * FROM {table} WHERE {where} ORDER BY {draw(key)} LIMIT {n}"


def similar(same_country: bool) -> str:
    group = "genre_id, country_code" if same_country else "genre_id"
    same = "a.genre_id = t.genre_id" + (" AND a.country_code = t.country_code" if same_country else "")
    taste = (
        "SELECT l_taste.*, country_code FROM l_taste JOIN users ON users.id = user_id"
        if same_country else "SELECT l_taste.* FROM l_taste JOIN users ON users.id = user_id"
    )
    number = f"""SELECT {group}, id AS artist_id, count(*) OVER (PARTITION BY {group}) AS n_artists,
        row_number() OVER (PARTITION BY {group} ORDER BY substr(sha256(id), 1, 2), id) AS position FROM artists"""
    return f"""
        SELECT t.*, coalesce(a.n_artists, 0) AS n_artists, a.artist_id
        FROM ({taste}) t LEFT JOIN ({number}) a
          ON {same} AND a.position = floor({_uniform('t.user_id', 't.genre_id', "'0'")} * a.n_artists) + 1"""


def tastes(same_country: bool) -> str:
    home = ", u.country_code" if same_country else ""
    same = " AND a.country_code = u.country_code" if same_country else ""
    return f"""
        SELECT l.user_id, s.genre_id{home}, count(*) AS liked,
               (SELECT count(*) FROM artists a WHERE a.genre_id = s.genre_id{same}) AS n_artists
        FROM song_likes l JOIN songs s ON s.id = l.song_id JOIN users u ON u.id = l.user_id
        WHERE s.genre_id IS NOT NULL GROUP BY l.user_id, s.genre_id{home}"""


def suggested(same_country: bool) -> str:
    def numbered(group: tuple[str, ...]) -> str:
        parts = "PARTITION BY " + ", ".join(group) if group else ""
        return f"""SELECT *, count(*) OVER ({parts}) AS n,
            row_number() OVER ({parts} ORDER BY substr(sha256(id), 1, 2), id) AS position FROM artists"""

    def picked(name: str) -> str:
        return f"position = floor({_uniform('t.user_id', repr(name), "'0'")} * n) + 1"

    home = " AND {0}.country_code = t.country_code" if same_country else ""
    place = ("country_code",) if same_country else ()
    return f"""
        SELECT t.user_id, t.genre_id, s.id IS NOT NULL AS by_genre, coalesce(s.id, y.id) AS artist_id
        FROM (SELECT u.id AS user_id, u.country_code, g.genre_id FROM users u LEFT JOIN (
                  SELECT l.user_id, arg_min(genre_id, {draw('l.user_id, l.song_id')}) AS genre_id
                  FROM song_likes l JOIN songs ON songs.id = l.song_id GROUP BY l.user_id) g ON g.user_id = u.id) t
        LEFT JOIN ({numbered(('genre_id', *place))}) s
          ON s.genre_id = t.genre_id{home.format('s')} AND s.{picked('similar').replace('* n)', '* s.n)')}
        LEFT JOIN ({numbered(place)}) y
          ON {'true' + home.format('y')} AND y.{picked('any').replace('* n)', '* y.n)')}"""


def weighted(share: float, with_none: bool) -> str:
    scale = "greatest(total, 1.0)" if with_none else "total"
    return f"""
        SELECT e.event_id, c.choice
        FROM (SELECT event_id, {_uniform('event_id::VARCHAR', "'0'")} AS point FROM events) e
        LEFT JOIN (
            SELECT choice, (upto - weight) / {scale} AS low, upto / {scale} AS high
            FROM (SELECT code AS choice, weight * {share} AS weight,
                         sum(weight * {share}) OVER (ORDER BY substr(sha256(code), 1, 2), code) AS upto,
                         sum(weight * {share}) OVER () AS total FROM l_weight) w) c
          ON e.point >= c.low AND e.point < c.high"""


def playback(end: str, extra: str = "") -> str:
    return f"""
        SELECT r.*, CASE WHEN s.id IS NULL THEN 'SongNotFound'
                         WHEN r.at_time_sec < 0 OR r.at_time_sec {end} s.duration_sec THEN 'PlaybackError' ELSE 'ok' END AS status{extra}
        FROM play_requests r LEFT JOIN songs s ON s.id = r.song_id"""


def once(requests: str, key: str, target: str, column: str, unknown: str, again: str) -> str:
    return f"""
        SELECT r.*, CASE WHEN t.id IS NULL THEN '{unknown}'
               WHEN row_number() OVER (PARTITION BY t.id IS NULL, r.user_id, r.{column} ORDER BY event_time, request_id) = 1
               THEN 'ok' ELSE '{again}' END AS status
        FROM {requests} r LEFT JOIN {target} t ON t.id = r.{column}"""


SIGNUP = """
    WITH s AS (
        SELECT r.*, u.email IS NOT NULL AS taken, c.code IS NOT NULL AS known, c.enabled_at IS NOT NULL AS enabled
        FROM signup_requests r LEFT JOIN (SELECT DISTINCT email FROM users) u USING (email)
        LEFT JOIN countries c ON c.code = r.country_code),
    w AS (SELECT *, count(*) FILTER (WHERE NOT taken AND enabled) OVER (PARTITION BY email ORDER BY event_time, request_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM s)
    SELECT request_id, email, country_code, event_time,
           CASE WHEN taken OR before > 0 THEN 'UserAlreadyExists' WHEN NOT known THEN 'CountryNotFound'
                WHEN NOT enabled THEN 'CountryNotEnabled' ELSE 'ok' END AS status FROM w"""

REFERENCES = (
    ("genres", "country_code", "countries", "code"), ("artists", "country_code", "countries", "code"),
    ("artists", "genre_id", "genres", "id"), ("collections", "artist_id", "artists", "id"),
    ("collections", "genre_id", "genres", "id"), ("songs", "collection_id", "collections", "id"),
    ("songs", "artist_id", "artists", "id"), ("songs", "genre_id", "genres", "id"),
)

LOOKUPS = (
    ("country", "lpad(CAST(event_id % 40 AS VARCHAR), 2, '0')", "countries", "code"),
    ("user", "'customer#' || lpad(CAST(event_id AS VARCHAR), 9, '0') || '@example.com'", "users", "email"),
    ("artist", "'A' || event_id", "artists", "id"), ("collection", "'C' || event_id", "collections", "id"),
    ("song", "'S' || event_id", "songs", "id"), ("genre", "'Brand#' || (event_id % 40)", "genres", "id"),
)

DRAWS = """SELECT event_id AS request_id, CASE WHEN event_id % 5 <> 0 THEN lpad(CAST(event_id % 28 AS VARCHAR), 2, '0') END AS country_code,
    CASE WHEN event_id % 3 <> 0 THEN 'Brand#' || (event_id % 40) END AS genre_id FROM events"""

REQUESTED = "SELECT id AS collection_id FROM collections"

QUERIES = {
    "countries_list": "SELECT code, name, enabled_at, enabled_at IS NOT NULL AS enabled FROM countries",
    "countries_list_enabled": "SELECT code, name, enabled_at, true AS enabled FROM countries WHERE enabled_at IS NOT NULL",
    "genres_by_country": "SELECT * FROM genres WHERE country_code = '05'",
    "genres_all": "SELECT * FROM genres",
    "songs_of_collection": f"SELECT * FROM songs WHERE collection_id IN ({REQUESTED})",
    "collections_of_artist": """
        SELECT a.id AS artist_id, true AS found, d.id AS collection_id, d.document
        FROM artists a LEFT JOIN l_document d ON d.artist_id = a.id
        UNION ALL SELECT id || 'x', false, NULL, NULL FROM artists""",
    "collection_document": "SELECT id, document FROM l_document",
    "collection_document_nested": "SELECT * FROM l_nested",
    "collections_of_artist_nested": """
        SELECT r.artist_id, r.found, n.id AS collection_id, n.part, n.parts, n.document
        FROM (SELECT id AS artist_id, true AS found FROM artists UNION ALL SELECT id || 'x', false FROM artists) r
        LEFT JOIN l_nested n ON n.artist_id = r.artist_id AND r.found""",
    "collection_by_id": """
        SELECT r.collection_id, n.id IS NOT NULL AS found, n.part, n.parts, n.document
        FROM (SELECT id AS collection_id FROM collections UNION ALL SELECT id || 'x' FROM collections) r
        LEFT JOIN l_nested n ON n.id = r.collection_id""",
    "create_collections": """
        SELECT request_id, status, CASE WHEN status = 'ok' THEN collection_id END AS collection_id,
               CASE WHEN status <> 'MissingFields' THEN '[]' ELSE '[' || concat_ws(',', CASE WHEN k % 13 = 0 THEN '"type"' END,
                    CASE WHEN k % 19 = 0 AND k % 23 <> 0 AND n_songs > 0 THEN '"songs.duration_sec"' END) || ']' END AS missing
        FROM l_answer""",
    "create_collections_events": f"""
        SELECT to_json({{'type': 'CollectionCreated', 'data': {{'event_time': '{X}T00:00:00', 'id': collection_id, 'name': name,
               'collection_type': collection_type, 'artist_id': artist_id, 'genre_id': genre_id,
               'released_dt': released_dt}}}})::VARCHAR AS value FROM l_answer WHERE status = 'ok'
        UNION ALL
        SELECT to_json({{'type': 'SongCreated', 'data': {{'event_time': '{X}T00:00:00', 'collection_id': a.collection_id,
               'artist_id': a.artist_id, 'genre_id': a.genre_id,
               'id': substr(sha256(concat_ws('#', 'song', a.request_id, s.at, '0')), 1, 32), 'name': s.name,
               'duration_sec': s.duration_sec}}}})::VARCHAR
        FROM l_answer a JOIN (SELECT *, row_number() OVER (PARTITION BY collection_id ORDER BY id) - 1 AS at FROM songs) s
          ON s.collection_id = a.old_id
        WHERE a.status = 'ok' AND a.k % 23 <> 0""",
    "lookup_entities": " UNION ALL ".join(
        f"SELECT '{e}' AS entity, {v} AS key, {v} IN (SELECT {k} FROM {t}) AS found FROM events" for e, v, t, k in LOOKUPS
    ),
    "random_song_per_country": f"""
        SELECT country_code, arg_min(song_id, {draw('song_id')}) AS song_id FROM (
            SELECT s.artist_id, arg_min(s.id, {draw('s.id')}) AS song_id FROM songs s GROUP BY ALL) p
        JOIN artists a ON a.id = p.artist_id GROUP BY country_code
        UNION ALL SELECT NULL, arg_min(id, {draw('id')}) FROM songs""",
    "random_artist": f"""
        SELECT country_code, genre_id, grouping(country_code) = 0 AS by_country, grouping(genre_id) = 0 AS by_genre,
               arg_min(id, {draw('id')}) AS artist_id
        FROM artists GROUP BY GROUPING SETS ((country_code, genre_id), (country_code), (genre_id), ())""",
    "random_song_for": f"""
        SELECT r.request_id, r.country_code, CASE WHEN {{known_country}} THEN d.song_id END AS song_id,
               CASE WHEN NOT ({{known_country}}) THEN 'CountryNotFound' WHEN d.song_id IS NULL THEN 'NoSong' ELSE 'ok' END AS status
        FROM ({DRAWS}) r LEFT JOIN ({{random_song_per_country}}) d ON d.country_code IS NOT DISTINCT FROM r.country_code""",
    "random_artist_for": f"""
        SELECT r.*, CASE WHEN ({{known_country}}) AND ({{known_genre}}) THEN d.artist_id END AS artist_id,
               CASE WHEN NOT ({{known_country}}) THEN 'CountryNotFound' WHEN NOT ({{known_genre}}) THEN 'GenreNotFound'
                    WHEN d.artist_id IS NULL THEN 'NoArtist' ELSE 'ok' END AS status
        FROM ({DRAWS}) r LEFT JOIN ({{random_artist}}) d
          ON d.country_code IS NOT DISTINCT FROM r.country_code AND d.genre_id IS NOT DISTINCT FROM r.genre_id
             AND d.by_country = (r.country_code IS NOT NULL) AND d.by_genre = (r.genre_id IS NOT NULL)""",
    "suggested_artists": suggested(False),
    "suggested_artists_at_home": suggested(True),
    "sample_rows": sample("users", "id", 5),
    "sample_rows_artists": sample("artists", "id", 1),
    "sample_rows_disabled_country": sample("countries", "code", 1, "enabled_at IS NULL"),
    "liked_songs": """
        SELECT r.user_id, r.artist_id, l.song_id FROM l_like_list r JOIN song_likes l ON l.user_id = r.user_id
        LEFT JOIN songs s ON s.id = l.song_id WHERE r.artist_id IS NULL OR s.artist_id = r.artist_id""",
    "followed_artists": "SELECT user_id, artist_id FROM artist_follows WHERE user_id IN (SELECT id FROM users)",
    "song_popularity": "SELECT * FROM l_popular",
    "top_songs": "SELECT * FROM l_popular ORDER BY listen_count DESC, song_id LIMIT 5",
    "follow_candidates": """
        SELECT l.user_id, s.artist_id, count(*) AS liked FROM song_likes l JOIN songs s ON s.id = l.song_id
        WHERE NOT EXISTS (SELECT 1 FROM artist_follows f WHERE f.user_id = l.user_id AND f.artist_id = s.artist_id)
        GROUP BY ALL HAVING count(*) >= 3""",
    "same_genre_artists": similar(False),
    "same_genre_artists_at_home": similar(True),
    "candidate_tastes": tastes(False),
    "candidate_tastes_at_home": tastes(True),
    "candidate_members": "SELECT genre_id, id AS artist_id FROM artists WHERE genre_id IS NOT NULL",
    "candidate_members_at_home": """SELECT genre_id, country_code, id AS artist_id FROM artists
        WHERE genre_id IS NOT NULL AND country_code IS NOT NULL""",
    "country_decay_weight": """
        SELECT code, round(weight, 9) AS weight, round(hourly_weight, 9) AS hourly_weight,
               round(sum(weight) OVER (), 9) AS total_weight FROM l_weight""",
    "weighted_choice": weighted(1.0, False),
    "weighted_choice_or_none": weighted(0.1, True),
    "artist_last_release": "SELECT artist_id, max(event_time) AS last_release_dtm FROM kafka_collection GROUP BY artist_id",
    "validate_play": playback(">="),
    "validate_stop": playback(">", """,
        CASE WHEN r.at_time_sec BETWEEN 0 AND s.duration_sec THEN r.at_time_sec = s.duration_sec END AS finished"""),
    "signup_eligibility": f"SELECT * FROM ({SIGNUP}) answered",
    "validate_like": once("like_requests", "user_id", "songs", "song_id", "SongNotFound", "AlreadyLiked"),
    "validate_follow": once("follow_requests", "user_id", "artists", "artist_id", "ArtistNotFound", "AlreadyFollowed"),
    "subscribe_once": """
        SELECT *, CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY event_time, request_id) = 1 THEN 'ok'
               ELSE 'UserAlreadySubscribed' END AS status FROM subscribe_requests""",
    "catalogue_integrity": " UNION ALL ".join(
        f"""SELECT '{e}' AS entity, id, '{c}' AS reference, {c} AS value FROM {e}
            WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {k} FROM {t})""" for e, c, t, k in REFERENCES
    ),
    "explode_collection": f"""
        SELECT to_json({{'type': 'CollectionCreated', 'data': {{'event_time': '{X}T00:00:00', 'id': id, 'name': name,
               'collection_type': collection_type, 'artist_id': artist_id, 'genre_id': genre_id,
               'released_dt': released_dt}}}})::VARCHAR AS value FROM collections
        UNION ALL
        SELECT to_json({{'type': 'SongCreated', 'data': {{'event_time': '{X}T00:00:00', 'collection_id': c.id,
               'artist_id': c.artist_id, 'genre_id': c.genre_id, 'id': s.id, 'name': s.name,
               'duration_sec': s.duration_sec}}}})::VARCHAR FROM songs s JOIN collections c ON c.id = s.collection_id""",
}


QUERIES["explode_collection_nested"] = QUERIES["explode_collection"]

for _name in ("random_song_for", "random_artist_for"):
    QUERIES[_name] = QUERIES[_name].format(
        known_country="r.country_code IS NULL OR r.country_code IN (SELECT code FROM countries)",
        known_genre="r.genre_id IS NULL OR r.genre_id IN (SELECT id FROM genres)",
        random_song_per_country=QUERIES["random_song_per_country"],
        random_artist=QUERIES["random_artist"],
    )


def oracles(with_ctes) -> dict[str, str]:
    return {name: with_ctes(sql, {**LIBRARY, **CTES}) for name, sql in QUERIES.items()}
