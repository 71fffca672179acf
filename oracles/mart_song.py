"""Oracle SQL of the song mart, written row by row (no pre-aggregation)."""

from oracles.base import HISTORY, X, X2, then


def ctes(x: str, corrected: bool = False, form: str = "then") -> dict[str, str]:
    users = f"{form}_user" if corrected else "sat_user"
    artists = f"{form}_artist" if corrected else "sat_artist"
    day = f"BETWEEN TIMESTAMP '{x}' - INTERVAL 1 DAY AND TIMESTAMP '{x}'"
    home = f"""
        SELECT song_id, country_code AS home_country
        FROM link_collection_song LEFT JOIN link_artist_collection USING (collection_id)
             LEFT JOIN {artists} USING (artist_id)"""
    return {
        **then(x),
        "o_home": home,
        "o_listens": f"""
            SELECT k.song_id, f.actual_dtm, h.home_country, u.country_code AS listener_country, f.action_type
            FROM lsat_session_song_user_listen f
            LEFT JOIN link_session_song_user_listen k USING (session_song_user_listen_id)
            LEFT JOIN o_home h ON h.song_id = k.song_id
            LEFT JOIN {users} u ON u.user_id = k.user_id
            WHERE f.action_type = 'Complete' OR (f.action_type = 'Start' AND f.at_time_sec = 0)""",
        "o_listen_agg": f"""
            SELECT song_id, count(song_id) AS world_listenings,
                   count(*) FILTER (WHERE home_country = listener_country) AS home_listenings,
                   count(*) FILTER (WHERE action_type = 'Complete' AND actual_dtm {day}) AS world_listenings_1d,
                   count(*) FILTER (WHERE action_type = 'Complete' AND actual_dtm {day}
                                      AND home_country = listener_country) AS home_listenings_1d
            FROM o_listens GROUP BY ALL""",
        "o_by_country": """
            SELECT song_id, listener_country, count(song_id) AS listenings_by_country
            FROM o_listens WHERE action_type = 'Start' GROUP BY ALL""",
        "o_rank": """
            SELECT song_id, listener_country, CAST(row_number() OVER (PARTITION BY song_id
                   ORDER BY listenings_by_country DESC, listener_country ASC NULLS LAST) AS INT) AS rnum
            FROM o_by_country""",
        "o_top3": """
            SELECT song_id, coalesce(list(listener_country ORDER BY rnum)
                   FILTER (WHERE rnum < 4 AND listener_country IS NOT NULL), []::VARCHAR[]) AS top3_country
            FROM o_rank GROUP BY song_id""",
        "o_likes": f"""
            SELECT k.song_id, f.actual_dtm, h.home_country, u.country_code AS liker_country
            FROM link_session_song_user_like k
            LEFT JOIN lsat_session_song_user_like f USING (session_song_user_like_id)
            LEFT JOIN o_home h ON h.song_id = k.song_id
            LEFT JOIN {users} u ON u.user_id = k.user_id""",
        "o_like_agg": f"""
            SELECT song_id, count(song_id) AS world_likes,
                   count(*) FILTER (WHERE home_country = liker_country) AS home_likes,
                   count(*) FILTER (WHERE actual_dtm {day}) AS world_likes_1d,
                   count(*) FILTER (WHERE actual_dtm {day} AND home_country = liker_country) AS home_likes_1d
            FROM o_likes GROUP BY ALL""",
    }


def mart(x: str, corrected: bool = False) -> str:
    songs, collections, artists = (
        ("then_song", "then_collection", "then_artist") if corrected else ("sat_song", "sat_collection", "sat_artist")
    )
    return f"""
        SELECT s.song_id, DATE '{x}' AS actual_dtm, s.name AS song_name, c.name AS collection_name, c.release_dt,
               a.name AS artist_name, g.genre_name, a.country_code,
               l.world_listenings, l.world_listenings_1d, l.home_listenings, l.home_listenings_1d,
               to_json(coalesce(t.top3_country, []::VARCHAR[]))::VARCHAR AS top3_country,
               coalesce(k.world_likes, 0) AS world_likes, coalesce(k.world_likes_1d, 0) AS world_likes_1d,
               coalesce(k.home_likes, 0) AS home_likes, coalesce(k.home_likes_1d, 0) AS home_likes_1d
        FROM {songs} s JOIN o_listen_agg l ON l.song_id = s.song_id AND l.world_listenings > 0
        LEFT JOIN link_collection_song p ON p.song_id = s.song_id
        LEFT JOIN {collections} c ON c.collection_id = p.collection_id
        LEFT JOIN link_artist_collection o ON o.collection_id = c.collection_id
        LEFT JOIN {artists} a ON a.artist_id = o.artist_id
        LEFT JOIN ref_genre g ON g.original_genre_id = c.original_genre_id
        LEFT JOIN o_top3 t ON t.song_id = s.song_id
        LEFT JOIN o_like_agg k ON k.song_id = s.song_id"""


STEPS = {
    "song_listening": "SELECT * FROM o_listens",
    "song_listening_agg": "SELECT * FROM o_listen_agg",
    "song_listening_countries": "SELECT * FROM o_by_country",
    "song_country_rank": "SELECT * FROM o_rank",
    "song_top3_countries": "SELECT song_id, to_json(top3_country)::VARCHAR AS top3_country FROM o_top3",
    "song_likes_countries": "SELECT * FROM o_likes",
    "song_likes_agg": "SELECT * FROM o_like_agg",
}


def oracles(with_ctes) -> dict[str, str]:
    out = {name: with_ctes(sql, ctes(X)) for name, sql in STEPS.items()}
    out["song_listening_corrected"] = with_ctes(STEPS["song_listening"], ctes(X, True, "now"))
    out["song_top3_countries_long"] = with_ctes(
        "SELECT song_id, rnum, listener_country FROM o_rank WHERE rnum < 4 AND listener_country IS NOT NULL", ctes(X)
    )
    out["mart_song"] = with_ctes(mart(X), ctes(X))
    out["mart_song_corrected"] = with_ctes(mart(X, True), ctes(X, True))
    for name, corrected in (("mart_song_history", False), ("mart_song_history_corrected", True)):
        out[name] = with_ctes(mart(X, corrected), {**ctes(X, corrected), **HISTORY})
    out["mart_song_2000"] = with_ctes(mart(X2), ctes(X2))
    out["mart_song_by_intervals"] = out["mart_song_history_corrected"]
    return out
