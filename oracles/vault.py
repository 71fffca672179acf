"""Oracle SQL of the 21 loads: first load, and second load against rows before the cut date."""

from oracles.base import (
    _b64, _uniform, CUT, GENRE_SQL, HISTORY, HUBS, LINKS, LSATS, SATS, STAGE, cost_sql, hub_sql, link_sql, lsat_sql, sat_sql,
)

BEFORE = f"event_time < TIMESTAMP '{CUT}'"


def second(new: str, old: str, keys: tuple[str, ...]) -> str:
    same = " AND ".join(f"o.{k} = n.{k}" for k in keys)
    return f"SELECT n.* FROM ({new}) n WHERE NOT EXISTS (SELECT 1 FROM ({old}) o WHERE {same})"


def filled(target: str, key: str, fields) -> str:
    """Corrected satellites: every attribute of the given tables is present, so filling in
    from the previous version leaves the row as it is; versions are compared per key."""
    return second(sat_sql(target), sat_sql(target, BEFORE), (key, "row_hash"))


def intervals_sql(sat: str) -> str:
    key = sat.removeprefix("sat_") + "_id"
    return f"SELECT *, lead(actual_dtm) OVER (PARTITION BY {key} ORDER BY actual_dtm, row_hash DESC) AS valid_to FROM {sat}"


CATALOGUE = ("sat_user", "sat_song", "sat_collection", "sat_artist")


def oracles(with_ctes) -> dict[str, str]:
    out = {
        "hash_key": with_ctes(f"""
            SELECT user_id, {_b64('user_id')} AS user_key, {_b64('user_id', 'NULL', 'session_id')} AS pair_key,
                   {_uniform('user_id', "'seed'")} AS draw FROM kafka_user_subscription"""),
        "latest_version": with_ctes("SELECT * FROM now_user"),
    }
    for t in CATALOGUE:
        out[t + "_history"] = with_ctes(intervals_sql(t), HISTORY)
    for t, (_, key, _) in HUBS.items():
        out[t] = with_ctes(hub_sql(t))
        out[t + "_second_load"] = with_ctes(second(hub_sql(t), hub_sql(t, BEFORE), ("original_id",)))
    for t, (_, key, _, fields) in SATS.items():
        out[t] = with_ctes(sat_sql(t))
        out[t + "_second_load"] = with_ctes(second(sat_sql(t), sat_sql(t, BEFORE), ("row_hash",)))
        out[t + "_second_load_corrected"] = with_ctes(filled(t, key, fields))
    for t in LINKS:
        key = t.removeprefix("link_") + "_id"
        out[t] = with_ctes(link_sql(t))
        out[t + "_second_load"] = with_ctes(second(link_sql(t), link_sql(t, BEFORE), (key,)))
    for t in LSATS:
        key = t.removeprefix("lsat_") + "_id"
        out[t] = with_ctes(lsat_sql(t))
        out[t + "_second_load"] = with_ctes(second(lsat_sql(t), lsat_sql(t, BEFORE), (key, "actual_dtm")))
    # updates that lack fields, as the last version of their key fills them in
    updates = {
        "sat_song": ("kafka_song", "CAST(duration_sec + 30 AS INT) AS duration_sec, TIMESTAMP '1998-01-01' AS event_time",
                     "CAST(substr(id, 2) AS BIGINT) % 7 = 3"),
        "sat_artist": ("kafka_artist", "TIMESTAMP '1998-06-01' AS event_time", "CAST(substr(id, 2) AS BIGINT) % 3 = 1"),
        "sat_user": ("kafka_user_history", "last_name || ' Jr' AS last_name, TIMESTAMP '2004-01-01' AS event_time, "
                     "coalesce(newer, email) AS email",
                     "email NOT LIKE '%.new@example.com' AND CAST(substr(user_id, 2) AS BIGINT) % 5 = 0"),
    }
    for t, (stage, columns, where) in updates.items():
        rows = f"SELECT * FROM ({STAGE[stage]}) b"
        if t == "sat_user":
            rows = f"""SELECT b.*, n.newer FROM ({STAGE[stage]}) b LEFT JOIN (SELECT user_id, email AS newer
                FROM ({STAGE[stage]}) m WHERE email LIKE '%.new@example.com') n USING (user_id)"""
        out[t + "_filled_load"] = with_ctes(sat_sql(t), {stage: f"SELECT * REPLACE ({columns}) FROM ({rows}) u WHERE {where}"})
    # loaded in two parts that share moments: the same as one load
    for t in ("sat_session", "sat_user_subscription"):
        out[t + "_split_load"] = with_ctes(sat_sql(t))
    twins = "SELECT * FROM kafka_playback UNION ALL SELECT * REPLACE (at_time_sec + 1 AS at_time_sec) FROM kafka_playback"
    listen = lsat_sql("lsat_session_song_user_listen")
    assert "FROM kafka_playback" in listen
    out["lsat_session_song_user_listen_split_load"] = with_ctes(
        listen.replace("FROM kafka_playback", "FROM twin_playback"), {"twin_playback": twins}
    )
    out["ref_country_subscription_cost"] = with_ctes(cost_sql())
    out["ref_genre"] = with_ctes(GENRE_SQL)
    # all countries and genres are older than the cut date: nothing is new
    out["ref_country_subscription_cost_second_load"] = with_ctes(
        f"SELECT * FROM ({cost_sql()}) n WHERE n.enabled_dt >= TIMESTAMP '{CUT}'"
    )
    out["ref_genre_second_load"] = with_ctes(
        f"SELECT * FROM ({GENRE_SQL}) n WHERE n.creation_dtm >= TIMESTAMP '{CUT}'"
    )
    return out
