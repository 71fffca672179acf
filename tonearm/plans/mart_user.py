"""User mart: subscription, listening measures, favourites and payments per user.

Measures are first reduced to one row per (user, genre, artist, song); only those rows are
expanded into the four grouping levels. All measures are sums and counts, so this is exact.
Favourites come from a rank limit that Spark applies before the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tonearm.functions.keys import micros_between
from tonearm.functions.ranking import count_and_name, ranked, ranked_in_buckets, top_list
from tonearm.plans.asof import current, day_before, midnight
from tonearm.plans.mart_song import LISTEN

Tables = Mapping[str, DataFrame]

PROFILE = ["user_id", "registration_dtm", "email", "country_code", "first_name", "last_name", "birth_dt"]

# favourites: grouping level -> (name column, list column, length of the list)
FAVOURITES = {
    "artist": ("artist_name", "top5_artists", 5),
    "song": ("song_name", "top5_songs", 5),
    "genre": ("genre_name", "top3_genres", 3),
}

COUNTS = [
    "home_listenings_whole_cnt",
    "world_listenings_whole_cnt",
    "world_listenings_1d_cnt",
    "p10_world_listenings_1d_cnt",
    "turn_world_listenings_1d_cnt",
    "p10_world_listenings_whole_cnt",
    "turn_world_listenings_whole_cnt",
]
MEASURES = COUNTS + ["avg_percent_listening", "avg_happiness_index"]


def user_versions(tables: Tables, execution_dt: str) -> DataFrame:
    known = tables["sat_user"].where(F.col("actual_dtm") <= midnight(execution_dt))
    order = [F.desc("actual_dtm"), F.asc("row_hash")]
    return ranked(known, ["user_id"], order).select(*PROFILE, "rnum")


def user_subscriptions(tables: Tables, execution_dt: str, corrected: bool = False) -> DataFrame:
    """User versions with their subscription. As published, old versions stay in as Basic
    rows; `corrected` keeps the last version only."""
    versions = user_versions(tables, execution_dt)
    if corrected:
        versions = versions.where(F.col("rnum") <= 1)
    bought = (
        tables["sat_user_subscription"]
        .where(F.col("actual_dtm") <= midnight(execution_dt))
        .select(
            F.col("user_id").alias("_user"),
            F.col("actual_dtm").alias("subscription_update_dtm"),
            "is_premium",
        )
    )
    matched = versions.join(bought, (F.col("user_id") == F.col("_user")) & (F.col("rnum") == 1), "left")
    kind = F.when(F.col("is_premium").isNotNull(), "Premium").otherwise("Basic")
    return matched.select(*PROFILE, "subscription_update_dtm", kind.alias("subscription_type"))


def _song_facts(tables: Tables) -> DataFrame:
    """What a listen needs to know about its song: one row per (collection, versions of it)."""
    artists = tables["sat_artist"].select(
        "artist_id", F.col("name").alias("artist_name"), F.col("country_code").alias("song_country")
    )
    genres = tables["ref_genre"].select("original_genre_id", "genre_name", "happiness_index")
    songs = (
        tables["sat_song"]
        .select("song_id", F.col("name").alias("song_name"), "duration_sec", "original_genre_id")
        .join(genres, "original_genre_id", "left")
        .drop("original_genre_id")
    )
    homes = (
        tables["link_collection_song"].select("collection_id", "song_id")
        .join(tables["link_artist_collection"].select("artist_id", "collection_id"), "collection_id", "left")
        .join(artists, "artist_id", "left")
        .select("song_id", "artist_name", "song_country")
    )
    # a listened song may lack either side, as with two left joins
    return songs.join(homes, "song_id", "full")


def _listens(tables: Tables, execution_dt: str) -> DataFrame:
    """Listens until the date with user and song; the date filter reaches the scan."""
    facts = tables["lsat_session_song_user_listen"].where(F.col("actual_dtm") <= midnight(execution_dt))
    link = tables["link_session_song_user_listen"].select(LISTEN, "song_id", "user_id")
    return facts.join(link, LISTEN).join(_song_facts(tables), "song_id", "left")


def _current_users(tables: Tables, execution_dt: str) -> DataFrame:
    latest = user_versions(tables, execution_dt).where(F.col("rnum") <= 1)
    return latest.select("user_id", F.col("country_code").alias("user_country"))


def user_listenings(tables: Tables, execution_dt: str, corrected: bool = False) -> DataFrame:
    tables = current(tables, execution_dt) if corrected else tables
    return (
        _listens(tables, execution_dt)
        .join(_current_users(tables, execution_dt), "user_id")
        .select(
            "user_id", "actual_dtm", "user_country", "song_country", "at_time_sec", "action_type",
            "duration_sec", "genre_name", "artist_name", "song_name", "happiness_index",
        )
    )


def _listen_counts(tables: Tables, execution_dt: str, corrected: bool) -> DataFrame:
    """Listens until the date with their song, counted per link key, position, action and whether they are
    of the last day. Link and facts lie together by that key, so that the count needs no shuffle; the counts
    are the outer side of the song join, the side Spark can split when a song is hot."""
    facts = tables["lsat_session_song_user_listen"].where(F.col("actual_dtm") <= midnight(execution_dt))
    link = tables["link_session_song_user_listen"].select(LISTEN, "song_id", "user_id")
    last_day = F.col("actual_dtm").between(day_before(execution_dt), midnight(execution_dt)) if corrected else F.lit(False)
    counted = facts.join(link, LISTEN).groupBy(
        "user_id", "song_id", "at_time_sec", "action_type", LISTEN, last_day.alias("last_day")
    ).agg(F.count(F.lit(1)).alias("n")).drop(LISTEN)
    return counted.join(_song_facts(tables), "song_id", "left")


def _listen_measures(corrected: bool) -> dict[str, Column]:
    """Sums over counted listens. As published, the one-day range is empty (its bounds are swapped) and
    the listened share is an integer quotient; `corrected` uses the range and the real share."""
    at, duration = F.col("at_time_sec"), F.col("duration_sec")
    action = F.col("action_type")
    complete, pause = action == "Complete", action == "Pause"
    whole_seconds = F.when(duration != 0, duration)
    if corrected:
        over10, under10 = at * 10 > whole_seconds, at * 10 < whole_seconds
        percent = (at * 100).cast("double") / whole_seconds
    else:
        share = 1 - _quotient(1 - at, whole_seconds)
        over10, under10 = share > 0.1, share < 0.1
        percent = _quotient(at, whole_seconds) * 100
    finished_part = F.when(pause | complete, percent)
    last_day, n = F.col("last_day"), F.col("n")

    def times(condition: Column) -> Column:
        return F.sum(F.when(condition, n).otherwise(0))

    return {
        "complete": times(complete),
        "world_listenings_1d_cnt": times(complete & last_day),
        "p10_world_listenings_1d_cnt": times(pause & over10 & last_day),
        "turn_world_listenings_1d_cnt": times(pause & under10 & last_day),
        "p10_world_listenings_whole_cnt": times(pause & over10),
        "turn_world_listenings_whole_cnt": times((action == "Start") & (at == 0)),
        "percent_sum": F.sum(finished_part * n),
        "percent_cnt": times(finished_part.isNotNull()),
        "happiness_sum": F.sum(F.col("happiness_index") * n),
        "happiness_cnt": times(F.col("happiness_index").isNotNull()),
    }


def _quotient(a: Column, b: Column) -> Column:
    """Integer division, truncating toward zero."""
    return F.call_function("div", a, b)


def _mean(total: str, count: str, exact: bool) -> Column:
    total_col = F.sum(total)
    if exact:
        total_col = total_col.cast("decimal(28,6)")
    counted = F.sum(count)
    return F.round(total_col / F.when(counted > 0, counted), 2)


def user_listenings_agg(tables: Tables, execution_dt: str, corrected: bool = False) -> DataFrame:
    """Measures per user, (user, genre), (user, artist) and (user, song); `level` names the set.

    Counted listens are dealt by user once; the sums per song, the user's country, the four sets and the ranks
    that marts take of them all keep that order, so that the sets, four times as many rows, are not shuffled.
    """
    tables = current(tables, execution_dt) if corrected else tables
    measures = _listen_measures(corrected)
    names = ["genre_name", "artist_name", "song_name"]
    per_song = (
        _listen_counts(tables, execution_dt, corrected)
        .repartition("user_id")
        .groupBy("user_id", "song_country", *names)
        .agg(*[c.alias(n) for n, c in measures.items()])
    )
    at_home = F.col("user_country") == F.col("song_country")
    combined = per_song.join(_current_users(tables, execution_dt), "user_id").withColumn(
        "home", F.when(at_home, F.col("complete")).otherwise(0)
    )
    none = F.lit(None).cast("string")
    sets = [
        F.struct(F.lit(level).alias("level"), *[(F.col(n) if n == own else none).alias(n) for n in names])
        for level, own in (("user", None), ("genre", "genre_name"), ("artist", "artist_name"), ("song", "song_name"))
    ]
    expanded = combined.select("user_id", "home", *measures, F.inline(F.array(*sets)))
    return expanded.groupBy("level", "user_id", *names).agg(
        F.sum("home").alias("home_listenings_whole_cnt"),
        F.sum("complete").alias("world_listenings_whole_cnt"),
        *[F.sum(c).alias(c) for c in COUNTS[2:]],
        _mean("percent_sum", "percent_cnt", exact=not corrected).cast("double").alias("avg_percent_listening"),
        _mean("happiness_sum", "happiness_cnt", exact=True).cast("double").alias("avg_happiness_index"),
    )


def favourites_rank(agg: DataFrame, level: str, first: int | None = None) -> DataFrame:
    """Rank of the known names of one level per user, by started listens; with `first`, the first ones only."""
    name = FAVOURITES[level][0]
    order = [F.desc("turn_world_listenings_whole_cnt"), F.asc(name)]
    known = agg.where((F.col("level") == level) & F.col(name).isNotNull())
    if first is None:
        rows = ranked_in_buckets(known, ["user_id"], count_and_name("turn_world_listenings_whole_cnt", name), order, "top")
    else:
        rows = ranked(known, ["user_id"], order, "top").where(F.col("top") <= first)
    return rows.select("user_id", name, "top")


def favourites_list(agg: DataFrame, level: str) -> DataFrame:
    name, alias, k = FAVOURITES[level]
    top = favourites_rank(agg, level, first=k)
    return top.groupBy("user_id").agg(top_list("top", name, k).alias(alias))


def user_payments(subscriptions: DataFrame, tables: Tables, execution_dt: str) -> DataFrame:
    """Prices of the user's country and the days they are paid for."""

    def price(kind: str, name: str) -> DataFrame:
        prices = tables["ref_country_subscription_cost"].where(F.col("subscription_type") == kind)
        return prices.select("country_code", F.col("subscription_cost").alias(name))

    registered = F.col("registration_dtm")

    def days(end: Column) -> Column:
        return micros_between(registered, end) / F.lit(86400e6)

    premium_until = F.coalesce("subscription_update_dtm", registered)
    return (
        subscriptions.join(price("Basic", "basic_subscription_cost"), "country_code")
        .join(price("Premium", "premium_subscription_cost"), "country_code")
        .select(
            "user_id",
            "registration_dtm",
            "country_code",
            F.col("subscription_type").alias("current_subscription_type"),
            "basic_subscription_cost",
            "premium_subscription_cost",
            F.ceil(days(midnight(execution_dt))).alias("basic_days"),
            F.floor(days(premium_until)).alias("premium_days"),
        )
    )


def _listener_profiles(agg: DataFrame, corrected: bool) -> DataFrame:
    """Favourite lists and user-level measures, one pass over the grouping levels.

    As published, a row without any name counts as user level, so a user with listens of
    an unknown genre, artist or song has several; `corrected` keeps the real one. Rows with
    and without a name are ranked apart; at most five per level survive the shuffle.
    """
    name = F.coalesce("genre_name", "artist_name", "song_name")
    order = [F.desc("turn_world_listenings_whole_cnt"), F.asc("name")]
    rows = agg.withColumn("name", name).withColumn("unnamed", name.isNull())
    top = ranked(rows, ["user_id", "level", "unnamed"], order, "top").where(F.col("top") <= 5)
    is_total = (F.col("level") == "user") if corrected else F.col("unnamed")
    lists = [
        top_list(F.when(F.col("level") == level, F.col("top")), "name", k).alias(alias)
        for level, (_, alias, k) in FAVOURITES.items()
    ]
    totals = F.collect_list(F.when(is_total, F.struct(*MEASURES))).alias("totals")
    profile = top.groupBy("user_id").agg(totals, *lists)
    return profile.select("user_id", *[a for _, a, _ in FAVOURITES.values()], F.inline("totals"))


def mart_user(tables: Tables, execution_dt: str, corrected: bool = False) -> DataFrame:
    tables = current(tables, execution_dt) if corrected else tables
    subscriptions = user_subscriptions(tables, execution_dt, corrected)
    agg = user_listenings_agg(tables, execution_dt, corrected)
    profiles = _listener_profiles(agg, corrected)
    lists = [a for _, a, _ in FAVOURITES.values()]
    # a list that would be empty is missing, as with a left join to the list table
    profiles = profiles.withColumns({a: F.when(F.size(a) > 0, F.col(a)) for a in lists})
    days = user_payments(subscriptions, tables, execution_dt).select(
        "user_id",
        (
            F.col("basic_subscription_cost") * F.col("basic_days").cast("decimal(12,0)")
            + F.col("premium_subscription_cost") * F.col("premium_days").cast("decimal(12,0)")
        ).cast("decimal(18,2)").alias("total_payment"),
    )
    return (
        subscriptions.join(profiles, "user_id", "left")
        .join(days, "user_id", "left")
        .select(
            *PROFILE, "subscription_update_dtm", "subscription_type", *lists, *MEASURES, "total_payment"
        )
    )
