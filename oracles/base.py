"""DuckDB side: CTEs for the derived stage, library and warehouse tables, and their assembly."""

from __future__ import annotations

import re

X = "1999-06-01"
X2 = "2000-03-15"
CUT = "1998-01-01"


def _b64(*parts: str) -> str:
    return f"to_base64(unhex(sha256(concat_ws('#', {', '.join(parts)}) || '#kafka')))"


def _uniform(*parts: str) -> str:
    return f"(concat('0x', substr(sha256(concat_ws('#', {', '.join(parts)})), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"


STAGE = {
    "kafka_country_enabled": """
        SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS country_code,
               'CountryEnabled' AS event_type, TIMESTAMP '1995-01-01 00:00:00' AS event_time
        FROM nation WHERE n_nationkey % 5 <> 4""",
    "kafka_genre": """
        SELECT p_brand AS id, p_brand AS name,
               CAST((b * 37) % 201 - 100 AS INT) AS happiness_index,
               CAST(200 + b AS DECIMAL(10, 2)) AS mean_duration_sec,
               lpad(CAST(b % 25 AS VARCHAR), 2, '0') AS country_code,
               'GenreCreated' AS event_type, TIMESTAMP '1995-01-01 00:00:00' AS event_time
        FROM (SELECT DISTINCT p_brand, CAST(substr(p_brand, 7) AS INT) AS b FROM part) t
        WHERE b <> 7""",
    "kafka_artist": """
        SELECT 'A' || CAST(s_suppkey AS VARCHAR) AS id, s_name AS name,
               CAST(1950 + s_suppkey % 70 AS INT) AS founded_year,
               lpad(CAST(s_nationkey AS VARCHAR), 2, '0') AS country_code,
               'ArtistCreated' AS event_type, TIMESTAMP '1995-01-01 00:00:00' AS event_time
        FROM supplier""",
    "kafka_collection": """
        SELECT 'C' || CAST(c AS VARCHAR) AS id, 'Collection ' || CAST(c AS VARCHAR) AS name,
               CASE c % 3 WHEN 0 THEN 'LP' WHEN 1 THEN 'EP' ELSE 'SINGLE' END AS collection_type,
               'A' || CAST(c % (SELECT count(*) FROM supplier) AS VARCHAR) AS artist_id,
               p_brand AS genre_id,
               CAST(CAST(TIMESTAMP '1990-01-01 00:00:00' + CAST(p_size * 60 AS INT) * INTERVAL '1' DAY AS DATE) AS VARCHAR) AS released_dt,
               'CollectionCreated' AS event_type,
               TIMESTAMP '1995-01-01 00:00:00' + CAST((c * 31) % 2200 AS INT) * INTERVAL '1' DAY AS event_time
        FROM (SELECT *, CAST(floor(p_partkey / 10) AS BIGINT) AS c FROM part WHERE p_partkey % 10 = 0) t""",
    "kafka_song": """
        SELECT 'S' || CAST(p_partkey AS VARCHAR) AS id, p_name AS name,
               CAST(60 + p_size * 6 AS INT) AS duration_sec,
               'A' || CAST(c % (SELECT count(*) FROM supplier) AS VARCHAR) AS artist_id,
               p_brand AS genre_id, 'C' || CAST(c AS VARCHAR) AS collection_id,
               'SongCreated' AS event_type, TIMESTAMP '1995-01-01 00:00:00' AS event_time
        FROM (SELECT *, CAST(floor(p_partkey / 10) AS BIGINT) AS c FROM part) t""",
    "kafka_user_history": """
        SELECT 'U' || CAST(c_custkey AS VARCHAR) AS user_id,
               lower(c_name) || CASE v WHEN 0 THEN '' ELSE '.new' END || '@example.com' AS email,
               lpad(CAST((c_nationkey + v) % 25 AS VARCHAR), 2, '0') AS country_code,
               c_name AS first_name, c_mktsegment AS last_name,
               CAST(TIMESTAMP '1970-01-01 00:00:00' + CAST(c_custkey % 9000 AS INT) * INTERVAL '1' DAY AS DATE) AS birth_date,
               'SignUpEvent' AS event_type,
               TIMESTAMP '1995-01-01 00:00:00' + CAST(c_custkey % 365 + v * (400 + (c_custkey * 7) % 2000) AS INT) * INTERVAL '1' DAY AS event_time
        FROM customer CROSS JOIN (SELECT 0 AS v UNION ALL SELECT 1 AS v) h
        WHERE v = 0 OR c_custkey % 10 = 0""",
    "kafka_user_subscription": """
        SELECT 'U' || CAST(c_custkey AS VARCHAR) AS user_id, 'X' || CAST(c_custkey AS VARCHAR) AS session_id,
               'UserSubscriptionEvent' AS event_type,
               TIMESTAMP '1996-03-01 00:00:00' + CAST((c_custkey * 37) % 2000 AS INT) * INTERVAL '1' DAY AS event_time
        FROM customer WHERE c_mktsegment = 'BUILDING'""",
    "kafka_user_authorization": """
        SELECT 'U' || CAST(o_custkey AS VARCHAR) AS user_id, 'X' || CAST(o_orderkey AS VARCHAR) AS session_id,
               'SignInSuccessEvent' AS event_type, o_orderdate AS event_time
        FROM orders""",
    "kafka_playback": """
        SELECT 'U' || CAST(o_custkey AS VARCHAR) AS user_id, 'X' || CAST(l_orderkey AS VARCHAR) AS session_id,
               'S' || CAST(l_partkey AS VARCHAR) AS song_id,
               CAST(CASE WHEN l_linestatus = 'O' AND l_returnflag = 'R' THEN l_quantity
                         WHEN l_linestatus = 'O' THEN 0
                         WHEN l_returnflag = 'A' THEN 60 + p_size * 6
                         ELSE floor((60 + p_size * 6) * l_quantity / 51) END AS INT) AS at_time_sec,
               CASE WHEN l_linestatus = 'F' THEN l_returnflag = 'A' END AS finished,
               CASE WHEN l_linestatus = 'O' THEN 'SongPlayEvent' ELSE 'SongStopEvent' END AS event_type,
               l_shipdate AS event_time
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "kafka_song_like": """
        SELECT 'U' || CAST(o_custkey AS VARCHAR) AS user_id, 'X' || CAST(l_orderkey AS VARCHAR) AS session_id,
               'S' || CAST(l_partkey AS VARCHAR) AS song_id, 'SongLikedEvent' AS event_type, l_shipdate AS event_time
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_quantity >= 40""",
    "kafka_artist_follow": """
        SELECT 'U' || CAST(o_custkey AS VARCHAR) AS user_id, 'X' || CAST(l_orderkey AS VARCHAR) AS session_id,
               'A' || CAST(l_suppkey AS VARCHAR) AS artist_id, 'ArtistFollowedEvent' AS event_type, l_shipdate AS event_time
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_quantity <= 5""",
}

LIBRARY = {
    "countries": """
        SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS code, n_name AS name,
               CASE WHEN n_nationkey % 5 <> 4 THEN TIMESTAMP '1995-01-01 00:00:00' END AS enabled_at
        FROM nation""",
    "genres": "SELECT id, name, happiness_index, mean_duration_sec, country_code FROM kafka_genre",
    "artists": """
        SELECT id, name, founded_year, country_code,
               'Brand#' || CAST(CAST(substr(id, 2) AS BIGINT) % 30 + 1 AS VARCHAR) AS genre_id
        FROM kafka_artist""",
    "collections": "SELECT * EXCLUDE (event_type, event_time) FROM kafka_collection",
    "songs": "SELECT * EXCLUDE (event_type, event_time) FROM kafka_song",
    "users": """
        SELECT user_id AS id, email, country_code, first_name, last_name, birth_date
        FROM kafka_user_history WHERE email NOT LIKE '%.new@example.com'""",
    "song_likes": "SELECT DISTINCT user_id, song_id FROM kafka_song_like",
    "artist_follows": "SELECT DISTINCT user_id, artist_id FROM kafka_artist_follow",
    "play_requests": """
        SELECT event_id AS request_id, 'U' || user_id AS user_id, 'X' || event_id AS session_id,
               'S' || (event_id % 3000) AS song_id, CAST(floor(value * 10) AS INT) - 20 AS at_time_sec,
               ts AS event_time
        FROM events""",
    "signup_requests": """
        SELECT event_id AS request_id,
               CASE WHEN event_id % 3 = 0 THEN 'customer#' || lpad(CAST(user_id AS VARCHAR), 9, '0')
                    ELSE 'guest' || (event_id % 700) END || '@example.com' AS email,
               lpad(CAST(event_id % 28 AS VARCHAR), 2, '0') AS country_code,
               ts AS event_time
        FROM events""",
}

def _later(table: str, *versions: tuple[str, str]) -> str:
    """A stage table with further versions of some rows: (replaced columns, condition on the number)."""
    number = "CAST(substr(id, 2) AS BIGINT)"
    more = [f"SELECT * REPLACE ({columns}) FROM ({STAGE[table]}) v WHERE {number} % {where}" for columns, where in versions]
    return " UNION ALL ".join([f"SELECT * FROM ({STAGE[table]}) v", *more])


# the catalogue with history: changes before and after the date of the marts
HISTORY = {
    "kafka_song": _later(
        "kafka_song",
        ("name || ' live' AS name, CAST(duration_sec + 30 AS INT) AS duration_sec, TIMESTAMP '1998-01-01' AS event_time", "7 = 3"),
        ("name || ' lost' AS name, TIMESTAMP '2002-01-01' AS event_time", "7 IN (3, 4)"),
    ),
    "kafka_artist": _later(
        "kafka_artist",
        ("lpad(CAST((CAST(country_code AS INT) + 1) % 25 AS VARCHAR), 2, '0') AS country_code, TIMESTAMP '1998-06-01' AS event_time", "3 = 1"),
        ("name || ' II' AS name, TIMESTAMP '2003-01-01' AS event_time", "3 IN (1, 2)"),
    ),
    "kafka_collection": _later(
        "kafka_collection",
        ("name || ' again' AS name, event_time + INTERVAL 300 DAY AS event_time", "4 = 2"),
        ("name || ' late' AS name, TIMESTAMP '2005-01-01' AS event_time", "4 IN (2, 3)"),
    ),
}

# target: (stage table, key column, business key parts, {part: link column}, {column: expression})
HUBS = {
    "hub_user": ("kafka_user_history", "user_id", "user_id"),
    "hub_artist": ("kafka_artist", "artist_id", "id"),
    "hub_song": ("kafka_song", "song_id", "id"),
    "hub_session": ("kafka_user_authorization", "session_id", "session_id"),
    "hub_collection": ("kafka_collection", "collection_id", "id"),
}
SATS = {
    "sat_user": ("kafka_user_history", "user_id", "user_id", (
        ("actual_dtm", "event_time", "event_time"), ("email", "email", "email"),
        ("birth_dt", "birth_date::TIMESTAMP", "birth_date::TIMESTAMP"),
        ("first_name", "first_name", "first_name"), ("last_name", "last_name", "last_name"),
        ("registration_dtm", "event_time", "event_time"), ("country_code", "country_code", "country_code"))),
    "sat_user_subscription": ("kafka_user_subscription", "user_id", "user_id", (
        ("actual_dtm", "event_time", "event_time"), ("is_premium", "true", "'t'"))),
    "sat_song": ("kafka_song", "song_id", "id", (
        ("actual_dtm", "event_time", "event_time"), ("name", "name", "name"),
        ("duration_sec", "duration_sec", "duration_sec"), ("original_genre_id", "genre_id", "genre_id"))),
    "sat_collection": ("kafka_collection", "collection_id", "id", (
        ("actual_dtm", "event_time", "event_time"), ("name", "name", "name"),
        ("collection_type", "collection_type", "collection_type"),
        ("original_genre_id", "genre_id", "genre_id"), ("release_dt", "released_dt", "released_dt"))),
    "sat_session": ("kafka_user_authorization", "session_id", "session_id", (
        ("actual_dtm", "event_time", "event_time"),)),
    "sat_artist": ("kafka_artist", "artist_id", "id", (
        ("actual_dtm", "event_time", "event_time"), ("name", "name", "name"),
        ("country_code", "country_code", "country_code"), ("founded_year", "founded_year", "founded_year"))),
}
LINKS = {
    "link_session_song_user_like": ("kafka_song_like", (("session_id", "session_id"), ("song_id", "song_id"), ("user_id", "user_id"))),
    "link_session_song_user_listen": ("kafka_playback", (("session_id", "session_id"), ("song_id", "song_id"), ("user_id", "user_id"))),
    "link_collection_song": ("kafka_song", (("collection_id", "collection_id"), ("id", "song_id"))),
    "link_artist_collection": ("kafka_collection", (("id", "collection_id"), ("artist_id", "artist_id"))),
    "link_session_artist_user_follow": ("kafka_artist_follow", (("session_id", "session_id"), ("artist_id", "artist_id"), ("user_id", "user_id"))),
}
LSATS = {
    "lsat_session_song_user_listen": ("kafka_playback", ("session_id", "song_id", "user_id"), (
        ("actual_dtm", "event_time"), ("at_time_sec", "at_time_sec"),
        ("action_type", """CASE WHEN event_type = 'SongStopEvent' THEN (CASE WHEN finished IS NOT DISTINCT FROM false THEN 'Pause' ELSE 'Complete' END)
                                WHEN at_time_sec = 0 THEN 'Start' WHEN at_time_sec IS NOT NULL THEN 'Restart' ELSE 'Complete' END"""))),
    "lsat_session_song_user_like": ("kafka_song_like", ("session_id", "song_id", "user_id"), (("actual_dtm", "event_time"),)),
    "lsat_session_artist_user_follow": ("kafka_artist_follow", ("session_id", "artist_id", "user_id"), (("actual_dtm", "event_time"),)),
}


def hub_sql(target, where="true"):
    stage, key, part = HUBS[target]
    return f"""SELECT DISTINCT {_b64(part)} AS {key}, {part} AS original_id, 'kafka' AS source
        FROM {stage} WHERE {where}"""


def sat_sql(target, where="true"):
    stage, key, part, fields = SATS[target]
    columns = ", ".join(f"{sql} AS {name}" for name, sql, _ in fields)
    return f"""SELECT DISTINCT {_b64(part)} AS {key}, {columns},
        {_b64(*[text for _, _, text in fields])} AS row_hash, 'kafka' AS source
        FROM {stage} WHERE {where}"""


def link_sql(target, where="true"):
    stage, parts = LINKS[target]
    key = target.removeprefix("link_") + "_id"
    columns = ", ".join(f"{_b64(part)} AS {name}" for part, name in parts)
    return f"SELECT DISTINCT {_b64(*[p for p, _ in parts])} AS {key}, {columns} FROM {stage} WHERE {where}"


def lsat_sql(target, where="true"):
    stage, parts, fields = LSATS[target]
    key = target.removeprefix("lsat_") + "_id"
    columns = ", ".join(f"{sql} AS {name}" for name, sql in fields)
    return f"SELECT DISTINCT {_b64(*parts)} AS {key}, {columns}, 'kafka' AS source FROM {stage} WHERE {where}"


def cost_sql():
    def u(name):
        return _uniform("country_code", f"'{name}'", "'0'")

    return f"""
        SELECT * FROM (WITH p AS (SELECT country_code, event_time AS enabled_dt,
                          CAST(round({u('basic')} * (15.0::DOUBLE - 8.0::DOUBLE) + 8.0::DOUBLE, 2) AS DECIMAL(5,2)) AS cost,
                          CAST(round({u('royalty')} * (0.1::DOUBLE - 0.01::DOUBLE) + 0.01::DOUBLE, 2) AS DECIMAL(5,2)) AS royalty,
                          {u('factor')} * (1.6::DOUBLE - 1.1::DOUBLE) + 1.1::DOUBLE AS factor
                   FROM kafka_country_enabled)
        SELECT country_code, enabled_dt, 'Basic' AS subscription_type, cost AS subscription_cost, royalty, 'kafka' AS source FROM p
        UNION ALL
        SELECT country_code, enabled_dt, 'Premium', CAST(round(cost::DOUBLE * factor, 2) AS DECIMAL(5,2)),
               CAST(round(royalty::DOUBLE * 1.2::DOUBLE, 2) AS DECIMAL(5,2)), 'kafka' FROM p) prices"""


GENRE_SQL = """SELECT DISTINCT id AS original_genre_id, name AS genre_name, event_time AS creation_dtm, country_code,
    happiness_index, CAST(round(mean_duration_sec) AS INT) AS average_duration_sec, 'kafka' AS source FROM kafka_genre"""

VAULT = {
    **{t: hub_sql(t) for t in HUBS},
    **{t: sat_sql(t) for t in SATS},
    **{t: link_sql(t) for t in LINKS},
    **{t: lsat_sql(t) for t in LSATS},
    "ref_country_subscription_cost": cost_sql(),
    "ref_genre": GENRE_SQL,
}


def current_sql(sat, key, until=None):
    known = f"WHERE actual_dtm <= TIMESTAMP '{until}'" if until else ""
    return f"""SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER
        (PARTITION BY {key} ORDER BY actual_dtm DESC, row_hash) AS n FROM {sat} {known}) WHERE n = 1"""


CURRENT = {
    "now_user": current_sql("sat_user", "user_id"),
    "now_song": current_sql("sat_song", "song_id"),
    "now_collection": current_sql("sat_collection", "collection_id"),
    "now_artist": current_sql("sat_artist", "artist_id"),
}


def then(x: str) -> dict[str, str]:
    """The last versions up to a date, as then_user, then_song, then_collection, then_artist."""
    keys = {"user": "user_id", "song": "song_id", "collection": "collection_id", "artist": "artist_id"}
    return {f"then_{name}": current_sql(f"sat_{name}", key, x) for name, key in keys.items()}


KNOWN = {**STAGE, **LIBRARY, **VAULT, **CURRENT}


def with_ctes(query: str, extra: dict[str, str] | None = None, once: bool = False) -> str:
    """Prepends exactly the CTEs the query needs, in dependency order; with `once`, those that are read
    more than once are computed once, whatever the engine would choose."""
    known = {**KNOWN, **(extra or {})}
    names = re.compile(r"\b(" + "|".join(sorted(known, key=len, reverse=True)) + r")\b")
    done: list[str] = []

    def visit(sql: str, trail: tuple[str, ...] = ()) -> None:
        for name in dict.fromkeys(names.findall(sql)):
            if name not in done and name not in trail:
                visit(known[name], trail + (name,))
                done.append(name)

    visit(query)
    if not done:
        return query
    read = [name for sql in [query, *(known[name] for name in done)] for name in names.findall(sql)]
    kept = {name for name in done if once and read.count(name) > 1}
    ctes = ",\n".join(f"{name} AS {'MATERIALIZED ' if name in kept else ''}({known[name]})" for name in done)
    return f"WITH {ctes}\n{query}"
