"""Oracle SQL of the user mart, row by row."""

from oracles.base import HISTORY, X, X2, then

COUNTS = (
    "home_listenings_whole_cnt, world_listenings_whole_cnt, world_listenings_1d_cnt, p10_world_listenings_1d_cnt, "
    "turn_world_listenings_1d_cnt, p10_world_listenings_whole_cnt, turn_world_listenings_whole_cnt, "
    "avg_percent_listening, avg_happiness_index"
)


def _mean2(value: str) -> str:
    """Mean of integers rounded half away from zero to two digits, in integer arithmetic."""
    s, n = f"sum({value})::BIGINT", f"count({value})"
    return f"(CASE WHEN {n} > 0 THEN (sign({s}) * ((200 * abs({s}) + {n}) // (2 * {n})))::DOUBLE / 100 END)"


def ctes(x: str, corrected: bool = False) -> dict[str, str]:
    t = f"TIMESTAMP '{x}'"
    songs, artists = ("then_song", "then_artist") if corrected else ("sat_song", "sat_artist")
    day = f"actual_dtm BETWEEN {t} - INTERVAL 1 DAY AND {t}" if corrected else f"actual_dtm BETWEEN {t} AND {t} - INTERVAL 1 DAY"
    if corrected:
        over, under = "at_time_sec::DOUBLE / duration_sec > 0.1", "at_time_sec::DOUBLE / duration_sec < 0.1"
        percent = "round(avg((at_time_sec * 100)::DOUBLE / duration_sec) FILTER (WHERE action_type IN ('Pause', 'Complete')), 2)"
    else:
        over, under = "1 - ((1 - at_time_sec) // duration_sec) > 0.1", "1 - ((1 - at_time_sec) // duration_sec) < 0.1"
        percent = _mean2("CASE WHEN action_type IN ('Pause', 'Complete') THEN (at_time_sec // duration_sec) * 100 END")
    return {
        **then(x),
        "u_version": f"""
            SELECT user_id, registration_dtm, email, country_code, first_name, last_name, birth_dt,
                   CAST(row_number() OVER (PARTITION BY user_id ORDER BY actual_dtm DESC, row_hash) AS INT) AS rnum
            FROM sat_user WHERE actual_dtm <= {t}""",
        "u_sub": f"""
            SELECT v.* EXCLUDE (rnum), b.actual_dtm AS subscription_update_dtm,
                   CASE WHEN b.is_premium IS NULL THEN 'Basic' ELSE 'Premium' END AS subscription_type
            FROM u_version v LEFT JOIN sat_user_subscription b
              ON b.user_id = v.user_id AND v.rnum = 1 AND b.actual_dtm <= {t}
            {'WHERE v.rnum = 1' if corrected else ''}""",
        "u_listen": f"""
            SELECT v.user_id, f.actual_dtm, v.country_code AS user_country, a.country_code AS song_country,
                   f.at_time_sec, f.action_type, s.duration_sec, g.genre_name, a.name AS artist_name,
                   s.name AS song_name, g.happiness_index
            FROM u_version v
            JOIN link_session_song_user_listen k ON k.user_id = v.user_id
            JOIN lsat_session_song_user_listen f USING (session_song_user_listen_id)
            LEFT JOIN link_collection_song p ON p.song_id = k.song_id
            LEFT JOIN link_artist_collection o ON o.collection_id = p.collection_id
            LEFT JOIN {artists} a ON a.artist_id = o.artist_id
            LEFT JOIN {songs} s ON s.song_id = k.song_id
            LEFT JOIN ref_genre g ON g.original_genre_id = s.original_genre_id
            WHERE v.rnum = 1 AND f.actual_dtm <= {t}""",
        "u_agg": f"""
            SELECT CASE WHEN grouping(genre_name) = 0 THEN 'genre' WHEN grouping(artist_name) = 0 THEN 'artist'
                        WHEN grouping(song_name) = 0 THEN 'song' ELSE 'user' END AS level,
                   user_id, genre_name, artist_name, song_name,
                   count(*) FILTER (WHERE action_type = 'Complete' AND user_country = song_country) AS home_listenings_whole_cnt,
                   count(*) FILTER (WHERE action_type = 'Complete') AS world_listenings_whole_cnt,
                   count(*) FILTER (WHERE action_type = 'Complete' AND {day}) AS world_listenings_1d_cnt,
                   count(*) FILTER (WHERE action_type = 'Pause' AND {over} AND {day}) AS p10_world_listenings_1d_cnt,
                   count(*) FILTER (WHERE action_type = 'Pause' AND {under} AND {day}) AS turn_world_listenings_1d_cnt,
                   count(*) FILTER (WHERE action_type = 'Pause' AND {over}) AS p10_world_listenings_whole_cnt,
                   count(*) FILTER (WHERE action_type = 'Start' AND at_time_sec = 0) AS turn_world_listenings_whole_cnt,
                   {percent} AS avg_percent_listening,
                   {_mean2('happiness_index')} AS avg_happiness_index
            FROM u_listen
            GROUP BY GROUPING SETS ((user_id), (user_id, genre_name), (user_id, artist_name), (user_id, song_name))""",
        **{
            f"u_top_{level}": f"""
                SELECT user_id, {level}_name, CAST(row_number() OVER (PARTITION BY user_id
                       ORDER BY turn_world_listenings_whole_cnt DESC, {level}_name) AS INT) AS top
                FROM u_agg WHERE level = '{level}' AND {level}_name IS NOT NULL"""
            for level in ("artist", "song", "genre")
        },
        **{
            f"u_list_{level}": f"""
                SELECT user_id, list({level}_name ORDER BY top) FILTER (WHERE top <= {k}) AS top{k}_{level}s
                FROM u_top_{level} GROUP BY user_id"""
            for level, k in (("artist", 5), ("song", 5), ("genre", 3))
        },
        "u_pay": f"""
            SELECT s.user_id, s.registration_dtm, s.country_code, s.subscription_type AS current_subscription_type,
                   b.subscription_cost AS basic_subscription_cost, p.subscription_cost AS premium_subscription_cost,
                   CAST(ceil((epoch_us({t}) - epoch_us(registration_dtm))::DOUBLE / 86400000000) AS BIGINT) AS basic_days,
                   CAST(floor((epoch_us(coalesce(subscription_update_dtm, registration_dtm)) - epoch_us(registration_dtm))::DOUBLE
                        / 86400000000) AS BIGINT) AS premium_days
            FROM u_sub s
            JOIN ref_country_subscription_cost b ON b.country_code = s.country_code AND b.subscription_type = 'Basic'
            JOIN ref_country_subscription_cost p ON p.country_code = s.country_code AND p.subscription_type = 'Premium'""",
    }


def mart(corrected: bool = False) -> str:
    total_row = "l.level = 'user'" if corrected else "coalesce(l.genre_name, l.artist_name, l.song_name) IS NULL"
    return f"""
        SELECT s.*, to_json(a.top5_artists)::VARCHAR AS top5_artists, to_json(n.top5_songs)::VARCHAR AS top5_songs,
               to_json(g.top3_genres)::VARCHAR AS top3_genres, {COUNTS},
               CAST(basic_subscription_cost * basic_days::DECIMAL(12,0)
                    + premium_subscription_cost * premium_days::DECIMAL(12,0) AS DECIMAL(18,2)) AS total_payment
        FROM u_sub s
        LEFT JOIN u_agg l ON l.user_id = s.user_id AND {total_row}
        LEFT JOIN u_list_artist a ON a.user_id = s.user_id
        LEFT JOIN u_list_song n ON n.user_id = s.user_id
        LEFT JOIN u_list_genre g ON g.user_id = s.user_id
        LEFT JOIN u_pay p ON p.user_id = s.user_id"""


STEPS = {
    "user_versions": "SELECT * FROM u_version",
    "user_subscriptions": "SELECT * FROM u_sub",
    "user_listenings": "SELECT * FROM u_listen",
    "user_listenings_agg": "SELECT * FROM u_agg",
    "user_top_artists": "SELECT * FROM u_top_artist",
    "user_top_genres": "SELECT * FROM u_top_genre",
    "user_top_songs": "SELECT * FROM u_top_song",
    "user_top5_artists": "SELECT user_id, to_json(top5_artists)::VARCHAR AS top5_artists FROM u_list_artist",
    "user_top5_songs": "SELECT user_id, to_json(top5_songs)::VARCHAR AS top5_songs FROM u_list_song",
    "user_top3_genres": "SELECT user_id, to_json(top3_genres)::VARCHAR AS top3_genres FROM u_list_genre",
    "user_payments": "SELECT * FROM u_pay",
}


def oracles(with_ctes) -> dict[str, str]:
    out = {name: with_ctes(sql, ctes(X)) for name, sql in STEPS.items()}
    for name in ("user_subscriptions", "user_listenings", "user_listenings_agg"):
        out[name + "_corrected"] = with_ctes(STEPS[name], ctes(X, True))
    out["mart_user"] = with_ctes(mart(), ctes(X), once=True)
    out["mart_user_corrected"] = with_ctes(mart(True), ctes(X, True), once=True)
    for name, corrected in (("mart_user_history", False), ("mart_user_history_corrected", True)):
        out[name] = with_ctes(mart(corrected), {**ctes(X, corrected), **HISTORY}, once=True)
    out["mart_user_2000"] = with_ctes(mart(), ctes(X2), once=True)
    out["mart_user_by_intervals"] = out["mart_user_history_corrected"]
    return out
