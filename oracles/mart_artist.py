"""Oracle SQL of the artist mart, row by row."""

from oracles.base import HISTORY, X, X2, then


def ctes(x: str, corrected: bool = False) -> dict[str, str]:
    t = f"TIMESTAMP '{x}'"
    day = f"BETWEEN {t} - INTERVAL 1 DAY AND {t}"
    week = f"BETWEEN {t} - INTERVAL 7 DAY AND {t}"
    users, songs, collections = (
        ("then_user", "then_song", "then_collection") if corrected else ("sat_user", "sat_song", "sat_collection")
    )
    direction = "DESC" if corrected else "ASC"
    return {
        **then(x),
        "a_release": f"""
            SELECT o.artist_id, c.release_dt,
                   CAST(row_number() OVER (PARTITION BY o.artist_id
                        ORDER BY c.release_dt {direction} NULLS LAST, c.actual_dtm DESC) AS INT) AS rnum
            FROM {collections} c LEFT JOIN link_artist_collection o USING (collection_id)
            WHERE c.actual_dtm <= {t}""",
        "a_genre": f"""
            SELECT o.artist_id, g.genre_name, count(p.song_id) AS genre_cnt, c.release_dt
            FROM {collections} c
            LEFT JOIN link_collection_song p ON p.collection_id = c.collection_id
            LEFT JOIN link_artist_collection o ON o.collection_id = c.collection_id
            LEFT JOIN ref_genre g ON g.original_genre_id = c.original_genre_id
            WHERE c.actual_dtm <= {t} GROUP BY ALL""",
        "a_genre_rank": """
            SELECT artist_id, genre_name, genre_cnt, release_dt,
                   CAST(row_number() OVER (PARTITION BY artist_id ORDER BY genre_cnt DESC,
                        length(genre_name) NULLS LAST, genre_name NULLS LAST, release_dt NULLS LAST) AS INT) AS rnum
            FROM a_genre""",
        "a_user": f"""
            SELECT u.user_id, u.country_code,
                   CASE WHEN u.user_id IN (SELECT user_id FROM sat_user_subscription WHERE actual_dtm <= {t})
                        THEN 'Premium' ELSE 'Basic' END AS plan
            FROM {users} u""",
        "a_country": f"""
            SELECT o.artist_id, u.country_code, count(*) AS country_listen_7d,
                   count(*) FILTER (WHERE f.actual_dtm {day}) AS country_listen_1d,
                   count(*) FILTER (WHERE f.actual_dtm {day} AND u.plan = 'Basic') AS country_listen_basic_1d,
                   count(*) FILTER (WHERE f.actual_dtm {day} AND u.plan = 'Premium') AS country_listen_premium_1d
            FROM link_artist_collection o
            JOIN link_collection_song p ON p.collection_id = o.collection_id
            JOIN link_session_song_user_listen k ON k.song_id = p.song_id
            JOIN lsat_session_song_user_listen f USING (session_song_user_listen_id)
            LEFT JOIN a_user u ON u.user_id = k.user_id
            WHERE f.actual_dtm {week} GROUP BY ALL""",
        "a_royalty": """
            SELECT artist_id, CAST(sum(country_listen_basic_1d::DECIMAL(18,0) * b.royalty
                   + country_listen_premium_1d::DECIMAL(18,0) * p.royalty) AS DECIMAL(18,2)) AS royalty
            FROM a_country c
            JOIN ref_country_subscription_cost b ON b.country_code = c.country_code AND b.subscription_type = 'Basic'
            JOIN ref_country_subscription_cost p ON p.country_code = c.country_code AND p.subscription_type = 'Premium'
            GROUP BY artist_id""",
        "a_country_rank": """
            SELECT artist_id, country_code,
                   CAST(row_number() OVER (PARTITION BY artist_id
                        ORDER BY country_listen_7d DESC, country_code NULLS LAST) AS INT) AS top_7d,
                   CAST(row_number() OVER (PARTITION BY artist_id
                        ORDER BY country_listen_1d DESC, country_code NULLS LAST) AS INT) AS top_1d
            FROM a_country""",
        "a_songs": f"""
            SELECT o.artist_id, s.name AS song_name,
                   count(*) FILTER (WHERE f.actual_dtm < {t}) AS song_listen,
                   count(*) FILTER (WHERE f.actual_dtm < {t} AND f.action_type = 'Complete') AS song_listen_full,
                   count(*) FILTER (WHERE f.actual_dtm < {t} AND f.action_type = 'Pause'
                                      AND f.at_time_sec::DOUBLE / s.duration_sec * 100 > 10) AS song_listen_10
            FROM link_artist_collection o
            LEFT JOIN link_collection_song p ON p.collection_id = o.collection_id
            LEFT JOIN link_session_song_user_listen k ON k.song_id = p.song_id
            LEFT JOIN lsat_session_song_user_listen f USING (session_song_user_listen_id)
            LEFT JOIN {songs} s ON s.song_id = k.song_id
            GROUP BY ALL""",
        "a_song_rank": """
            SELECT artist_id, song_name, CAST(row_number() OVER (PARTITION BY artist_id
                   ORDER BY song_listen DESC, song_name NULLS LAST) AS INT) AS top, song_listen_full, song_listen_10
            FROM a_songs""",
        "a_top_countries": """
            SELECT artist_id,
                   coalesce(list(country_code ORDER BY top_7d) FILTER (WHERE top_7d < 4 AND country_code IS NOT NULL), []::VARCHAR[]) AS top3_countries_7d,
                   coalesce(list(country_code ORDER BY top_1d) FILTER (WHERE top_1d < 4 AND country_code IS NOT NULL), []::VARCHAR[]) AS top3_countries_1d
            FROM a_country_rank GROUP BY artist_id""",
        "a_top_songs": """
            SELECT artist_id,
                   coalesce(list(song_name ORDER BY top) FILTER (WHERE top < 4 AND song_name IS NOT NULL), []::VARCHAR[]) AS top3_songs,
                   CAST(sum(song_listen_full) AS BIGINT) AS song_listen_full, CAST(sum(song_listen_10) AS BIGINT) AS song_listen_10
            FROM a_song_rank GROUP BY artist_id""",
        "a_followed": f"""
            SELECT k.artist_id, count(*) FILTER (WHERE f.actual_dtm < {t}) AS follow_all,
                   count(*) FILTER (WHERE f.actual_dtm {day}) AS follow_1d
            FROM link_session_artist_user_follow k JOIN lsat_session_artist_user_follow f USING (session_artist_user_follow_id)
            GROUP BY ALL""",
    }


def mart(x: str, corrected: bool = False) -> str:
    artists = "then_artist" if corrected else "sat_artist"
    return f"""
        SELECT DATE '{x}' AS actual_dtm, a.artist_id, a.name, a.country_code, a.founded_year,
               r.release_dt AS latest_release_dt, g.genre_name AS main_genre,
               to_json(coalesce(c.top3_countries_7d, []::VARCHAR[]))::VARCHAR AS top3_countries_7d,
               to_json(coalesce(c.top3_countries_1d, []::VARCHAR[]))::VARCHAR AS top3_countries_1d,
               to_json(coalesce(s.top3_songs, []::VARCHAR[]))::VARCHAR AS top3_songs,
               coalesce(s.song_listen_full, 0) AS song_listen_full, coalesce(s.song_listen_10, 0) AS song_listen_10p,
               CAST(coalesce(y.royalty, 0) AS DECIMAL(18,2)) AS royalty_1d,
               coalesce(f.follow_1d, 0) AS follow_1d, coalesce(f.follow_all, 0) AS follow_all,
               CAST((4 * coalesce(s.song_listen_full, 0) + 4 * coalesce(s.song_listen_10, 0) + 2 * coalesce(f.follow_all, 0))::DOUBLE / 10
                    AS DECIMAL(18,1)) AS calculated_rating
        FROM {artists} a
        LEFT JOIN a_release r ON r.artist_id = a.artist_id AND r.rnum = 1
        LEFT JOIN a_genre_rank g ON g.artist_id = a.artist_id AND g.rnum = 1
        LEFT JOIN a_top_countries c ON c.artist_id = a.artist_id
        LEFT JOIN a_top_songs s ON s.artist_id = a.artist_id
        LEFT JOIN a_royalty y ON y.artist_id = a.artist_id
        LEFT JOIN a_followed f ON f.artist_id = a.artist_id"""


STEPS = {
    "artist_latest_release": "SELECT * FROM a_release",
    "artist_main_genre": "SELECT * FROM a_genre",
    "artist_main_genre_rank": "SELECT * FROM a_genre_rank",
    "artist_listen_country": "SELECT * FROM a_country",
    "artist_royalty": "SELECT * FROM a_royalty",
    "artist_country_rank": "SELECT * FROM a_country_rank",
    "artist_popular_songs": "SELECT * FROM a_songs",
    "artist_song_rank": "SELECT * FROM a_song_rank",
    "artist_top3_countries": """SELECT artist_id, to_json(top3_countries_7d)::VARCHAR AS top3_countries_7d,
        to_json(top3_countries_1d)::VARCHAR AS top3_countries_1d FROM a_top_countries""",
    "artist_top3_songs": """SELECT artist_id, to_json(top3_songs)::VARCHAR AS top3_songs, song_listen_full,
        song_listen_10 FROM a_top_songs""",
    "artist_followed": "SELECT * FROM a_followed",
}


def oracles(with_ctes) -> dict[str, str]:
    out = {name: with_ctes(sql, ctes(X)) for name, sql in STEPS.items()}
    out["artist_latest_release_corrected"] = with_ctes(
        STEPS["artist_latest_release"], {**ctes(X, True), "then_collection": "SELECT * FROM sat_collection"}
    )
    out["mart_artist"] = with_ctes(mart(X), ctes(X))
    out["mart_artist_corrected"] = with_ctes(mart(X, True), ctes(X, True))
    for name, corrected in (("mart_artist_history", False), ("mart_artist_history_corrected", True)):
        out[name] = with_ctes(mart(X, corrected), {**ctes(X, corrected), **HISTORY})
    out["mart_artist_2000"] = with_ctes(mart(X2), ctes(X2))
    out["mart_artist_by_intervals"] = out["mart_artist_history_corrected"]
    return out
