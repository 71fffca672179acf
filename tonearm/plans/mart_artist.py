"""Artist mart: releases, main genre, listener countries, royalties, songs, followers.

Facts are counted per link key before they are joined (see `mart_song`); the date filter
of the one-week measures reaches the scan of the dated link satellite.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tonearm.functions.ranking import bucket_of, count_and_name, ranked, ranked_in_buckets, top_list
from tonearm.plans.asof import current, day_before, midnight
from tonearm.plans.mart_song import LISTEN

Tables = Mapping[str, DataFrame]

FOLLOW = "session_artist_user_follow_id"

# fixed values: weights of the rating
FULL_WEIGHT, OVER10_WEIGHT, FOLLOWER_WEIGHT = "0.4", "0.4", "0.2"


def _listen_links(tables: Tables) -> DataFrame:
    """Song and user of each listen key. All measures take the same columns and filters, so that Spark deals the
    links of a lazy warehouse once and uses that shuffle again."""
    links = tables["link_session_song_user_listen"].select(LISTEN, "song_id", "user_id")
    return links.where(F.col(LISTEN).isNotNull() & F.col("song_id").isNotNull())


def _count(condition: Column, weight: str | None = None) -> Column:
    return F.sum(F.when(condition, F.col(weight) if weight else F.lit(1)).otherwise(0))


def _owners(tables: Tables) -> DataFrame:
    return tables["link_artist_collection"].select("artist_id", "collection_id")


def _shelf(tables: Tables) -> DataFrame:
    return tables["link_collection_song"].select("collection_id", "song_id")


def _released(tables: Tables, execution_dt: str) -> DataFrame:
    return tables["sat_collection"].where(F.col("actual_dtm") <= midnight(execution_dt))


def artist_latest_release(
    tables: Tables, execution_dt: str, corrected: bool = False, first_only: bool = False
) -> DataFrame:
    """Releases of an artist in order. As published the order is ascending, so that rank 1
    is the earliest release; `corrected` puts the latest first. All releases are ranked date by
    date; `first_only` cuts each artist before the shuffle."""
    release = F.desc_nulls_last("release_dt") if corrected else F.asc_nulls_last("release_dt")
    releases = _released(tables, execution_dt).join(_owners(tables), "collection_id", "left")
    order = [release, F.desc("actual_dtm")]
    if first_only:
        rows = ranked(releases, ["artist_id"], order).where(F.col("rnum") <= 1)
    else:
        rows = ranked_in_buckets(releases, ["artist_id"], [(F.col("release_dt"), corrected)], order)
    return rows.select("artist_id", "release_dt", "rnum")


def artist_main_genre(tables: Tables, execution_dt: str) -> DataFrame:
    """Songs per (artist, genre, release date). Songs are counted per collection first."""
    songs = _shelf(tables).groupBy("collection_id").agg(F.count("song_id").alias("songs"))
    genres = tables["ref_genre"].select("original_genre_id", "genre_name")
    return (
        _released(tables, execution_dt)
        .join(songs, "collection_id", "left")
        .join(_owners(tables), "collection_id", "left")
        .join(genres, "original_genre_id", "left")
        .groupBy("artist_id", "genre_name", "release_dt")
        .agg(F.sum(F.coalesce("songs", F.lit(0))).alias("genre_cnt"))
    )


def artist_main_genre_rank(genres: DataFrame, first_only: bool = False) -> DataFrame:
    order = [
        F.desc("genre_cnt"),
        F.length("genre_name").asc_nulls_last(),
        F.asc_nulls_last("genre_name"),
        F.asc_nulls_last("release_dt"),
    ]
    if first_only:
        rows = ranked(genres, ["artist_id"], order).where(F.col("rnum") <= 1)
    else:
        count, _, letters = count_and_name("genre_cnt", "genre_name")
        length = F.when(F.col("genre_cnt") < 16, F.length("genre_name"))
        rows = ranked_in_buckets(genres, ["artist_id"], [count, (length, False), letters], order)
    return rows.select("artist_id", "genre_name", "rnum", "genre_cnt", "release_dt")


def _subscribed_users(tables: Tables, execution_dt: str) -> DataFrame:
    """Country and subscription of each user version; Premium means a subscription as of the date."""
    premium = (
        tables["sat_user_subscription"]
        .where(F.col("actual_dtm") <= midnight(execution_dt))
        .select("user_id")
        .distinct()
        .withColumn("subscription_type", F.lit("Premium"))
    )
    return (
        tables["sat_user"].select("user_id", "country_code")
        .join(premium, "user_id", "left")
        .withColumn("subscription_type", F.coalesce("subscription_type", F.lit("Basic")))
    )


def artist_listen_country(tables: Tables, execution_dt: str) -> DataFrame:
    """Listens of the last seven days per (artist, country)."""
    week = F.col("actual_dtm").between(day_before(execution_dt, 7), midnight(execution_dt))
    last_day = F.col("actual_dtm").between(day_before(execution_dt), midnight(execution_dt))
    per_key = (
        tables["lsat_session_song_user_listen"].where(week)
        .groupBy(LISTEN)
        .agg(F.count(F.lit(1)).alias("n7"), _count(last_day).alias("n1"))
    )
    per_song = (
        per_key.join(_listen_links(tables), LISTEN)
        .join(_subscribed_users(tables, execution_dt), "user_id", "left")
        .groupBy("song_id", "country_code")
        .agg(
            F.sum("n7").alias("n7"),
            F.sum("n1").alias("n1"),
            _count(F.col("subscription_type") == "Basic", "n1").alias("basic"),
            _count(F.col("subscription_type") == "Premium", "n1").alias("premium"),
        )
    )
    return (
        per_song.join(_shelf(tables), "song_id")
        .join(_owners(tables), "collection_id")
        .groupBy("artist_id", "country_code")
        .agg(
            F.sum("n7").alias("country_listen_7d"),
            F.sum("n1").alias("country_listen_1d"),
            F.sum("basic").alias("country_listen_basic_1d"),
            F.sum("premium").alias("country_listen_premium_1d"),
        )
    )


def _prices(tables: Tables, kind: str, column: str, name: str) -> DataFrame:
    prices = tables["ref_country_subscription_cost"].where(F.col("subscription_type") == kind)
    return prices.select("country_code", F.col(column).alias(name))


def _priced(listen_country: DataFrame, tables: Tables, how: str) -> DataFrame:
    basic = _prices(tables, "Basic", "royalty", "basic_royalty")
    premium = _prices(tables, "Premium", "royalty", "premium_royalty")
    return listen_country.join(basic, "country_code", how).join(premium, "country_code", how)


def _royalty() -> Column:
    """Sum of listens times royalty; countries without prices add nothing."""
    basic = F.col("country_listen_basic_1d").cast("decimal(18,0)") * F.col("basic_royalty")
    premium = F.col("country_listen_premium_1d").cast("decimal(18,0)") * F.col("premium_royalty")
    return F.sum(basic + premium).cast("decimal(18,2)").alias("royalty")


def artist_royalty(listen_country: DataFrame, tables: Tables) -> DataFrame:
    return _priced(listen_country, tables, "inner").groupBy("artist_id").agg(_royalty())


def artist_country_rank(listen_country: DataFrame) -> DataFrame:
    """Two ranks per artist: by listens of seven days and of one day. A group has one row per country."""
    code = F.asc_nulls_last("country_code")
    week = ranked(listen_country, ["artist_id"], [F.desc("country_listen_7d"), code], "top_7d")
    both = ranked(week, ["artist_id"], [F.desc("country_listen_1d"), code], "top_1d")
    return both


def _listened_artists(listen_country: DataFrame, tables: Tables) -> DataFrame:
    """Country lists and royalty per artist from one pass over its countries."""
    rows = _priced(artist_country_rank(listen_country), tables, "left")
    return rows.groupBy("artist_id").agg(*_top_countries(), _royalty())


def artist_popular_songs(tables: Tables, execution_dt: str) -> DataFrame:
    """Listens before the date per (artist, song name): all, complete, paused after 10 %.

    Facts are cut at the date in the scan and counted per (song, pause position) before they
    meet the catalogue. They are the outer side of the link join, the side Spark can split when
    one key is hot. Every owned song keeps a row; the name of one that nobody ever listened to
    is unknown, as published, and so the link tells which songs have a name.
    """
    listens = (
        tables["lsat_session_song_user_listen"]
        .where(F.col("actual_dtm") < midnight(execution_dt))
        .withColumn("pause_at", F.when(F.col("action_type") == "Pause", F.col("at_time_sec")))
        .withColumn("listen", F.lit(1))
        .withColumn("full", F.when(F.col("action_type") == "Complete", 1).otherwise(0))
        .select(LISTEN, "pause_at", "listen", "full")
    )
    link = _listen_links(tables).select(LISTEN, "song_id")
    per_song = (
        listens.join(link, LISTEN, "left")
        .groupBy("song_id", "pause_at")
        .agg(
            F.sum("listen").alias("listen"),
            F.sum("full").alias("full"),
            F.count("pause_at").alias("pauses"),
        )
    )
    named = tables["sat_song"].select("song_id", F.col("name").alias("song_name"), "duration_sec")
    heard = link.select("song_id").distinct().join(named, "song_id", "left").join(per_song, "song_id", "left")
    # at / duration * 100 > 10, without a division
    over10 = (F.col("duration_sec") > 0) & (F.col("pause_at") * 10 > F.col("duration_sec"))
    return (
        _owners(tables)
        .join(_shelf(tables), "collection_id", "left")
        .join(heard, "song_id", "left")
        .groupBy("artist_id", "song_name")
        .agg(
            F.sum(F.coalesce("listen", F.lit(0))).alias("song_listen"),
            F.sum(F.coalesce("full", F.lit(0))).alias("song_listen_full"),
            _count(over10, "pauses").alias("song_listen_10"),
        )
    )


def artist_song_rank(songs: DataFrame) -> DataFrame:
    order = [F.desc("song_listen"), F.asc_nulls_last("song_name")]
    parts = count_and_name("song_listen", "song_name")
    return ranked_in_buckets(songs, ["artist_id"], parts, order, "top").select(
        "artist_id", "song_name", "top", "song_listen_full", "song_listen_10"
    )


def _top_countries() -> list[Column]:
    return [
        top_list("top_7d", "country_code", 3).alias("top3_countries_7d"),
        top_list("top_1d", "country_code", 3).alias("top3_countries_1d"),
    ]


def artist_top3_countries(ranks: DataFrame) -> DataFrame:
    return ranks.groupBy("artist_id").agg(*_top_countries())


def artist_top3_songs(songs: DataFrame) -> DataFrame:
    """Top songs and the sums over all songs of an artist, in one pass over the songs.

    Songs are ranked and summed per (artist, bucket of the name); an artist then has at most
    BUCKETS rows with three candidates each, so that an artist who owns a third of the
    catalogue is no larger task than the others.
    """
    order = [F.desc("song_listen"), F.asc_nulls_last("song_name")]
    bucketed = ranked(songs.withColumn("bucket", bucket_of(F.col("song_name"))), ["artist_id", "bucket"], order, "top")
    candidate = F.struct(
        (-F.col("song_listen")).alias("less"), F.col("song_name").isNull().alias("unnamed"), "song_name"
    )
    sums = [F.sum(c).alias(c) for c in ("song_listen_full", "song_listen_10")]
    partial = bucketed.groupBy("artist_id", "bucket").agg(
        *sums, F.collect_list(F.when(F.col("top") <= 3, candidate)).alias("candidates")
    )
    whole = partial.groupBy("artist_id").agg(*sums, F.flatten(F.collect_list("candidates")).alias("candidates"))
    first3 = F.slice(F.array_sort("candidates"), 1, 3)
    return whole.select(
        "artist_id",
        F.array_compact(F.transform(first3, lambda s: s["song_name"])).alias("top3_songs"),
        "song_listen_full",
        "song_listen_10",
    )


def artist_followed(tables: Tables, execution_dt: str) -> DataFrame:
    last_day = F.col("actual_dtm").between(day_before(execution_dt), midnight(execution_dt))
    per_key = tables["lsat_session_artist_user_follow"].groupBy(FOLLOW).agg(
        _count(F.col("actual_dtm") < midnight(execution_dt)).alias("follow_all"),
        _count(last_day).alias("follow_1d"),
    )
    return (
        tables["link_session_artist_user_follow"].select(FOLLOW, "artist_id")
        .join(per_key, FOLLOW)
        .groupBy("artist_id")
        .agg(F.sum("follow_all").alias("follow_all"), F.sum("follow_1d").alias("follow_1d"))
    )


def mart_artist(tables: Tables, execution_dt: str, corrected: bool = False) -> DataFrame:
    tables = current(tables, execution_dt) if corrected else tables
    release = artist_latest_release(tables, execution_dt, corrected, first_only=True)
    genre = artist_main_genre_rank(artist_main_genre(tables, execution_dt), first_only=True)
    countries = _listened_artists(artist_listen_country(tables, execution_dt), tables)
    songs = artist_top3_songs(artist_popular_songs(tables, execution_dt))
    followers = artist_followed(tables, execution_dt)

    def points(column: str, weight: str) -> Column:
        return F.col(column).cast("decimal(18,0)") * F.lit(weight).cast("decimal(2,1)")

    no_names = F.array().cast("array<string>")
    rows = (
        tables["sat_artist"].select("artist_id", "name", "country_code", "founded_year")
        .join(release.select("artist_id", F.col("release_dt").alias("latest_release_dt")), "artist_id", "left")
        .join(genre.select("artist_id", F.col("genre_name").alias("main_genre")), "artist_id", "left")
        .join(countries, "artist_id", "left")
        .join(songs, "artist_id", "left")
        .join(followers, "artist_id", "left")
        .select(
            F.lit(execution_dt).cast("date").alias("actual_dtm"),
            "artist_id",
            "name",
            "country_code",
            "founded_year",
            "latest_release_dt",
            "main_genre",
            *[F.coalesce(c, no_names).alias(c) for c in ("top3_countries_7d", "top3_countries_1d", "top3_songs")],
            F.coalesce("song_listen_full", F.lit(0)).alias("song_listen_full"),
            F.coalesce("song_listen_10", F.lit(0)).alias("song_listen_10p"),
            F.coalesce("royalty", F.lit(0).cast("decimal(18,2)")).alias("royalty_1d"),
            F.coalesce("follow_1d", F.lit(0)).alias("follow_1d"),
            F.coalesce("follow_all", F.lit(0)).alias("follow_all"),
        )
    )
    rating = (
        points("song_listen_full", FULL_WEIGHT)
        + points("song_listen_10p", OVER10_WEIGHT)
        + points("follow_all", FOLLOWER_WEIGHT)
    )
    return rows.withColumn("calculated_rating", rating.cast("decimal(18,1)")).orderBy(
        F.desc("calculated_rating"), F.desc("song_listen_full")
    )
