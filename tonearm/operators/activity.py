"""Activity queries: popularity, follows, validation of requests, weights and draws."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tonearm.functions.keys import hash_uniform, micros_between
from tonearm.functions.ranking import running_total

# fixed values: liked songs that make a follower, decay of country weights
LIKES_TO_FOLLOW = 3
HALF_LIFE_DAYS = 14
HOURLY_DECAY = 0.009

GRID = 1024


def liked_songs(requests: DataFrame, likes: DataFrame, songs: DataFrame) -> DataFrame:
    """Songs liked by the requested users (`user_id`), only of `artist_id` where one is given."""
    owner = songs.select(F.col("id").alias("song_id"), F.col("artist_id").alias("_artist"))
    liked = requests.join(likes, "user_id").join(owner, "song_id", "left")
    wanted = F.col("artist_id").isNull() | (F.col("artist_id") == F.col("_artist"))
    return liked.where(wanted).select("user_id", "artist_id", "song_id")


def followed_artists(requests: DataFrame, follows: DataFrame) -> DataFrame:
    return follows.join(requests.select("user_id"), "user_id", "left_semi").select("user_id", "artist_id")


def long_listens(playback: DataFrame, songs: DataFrame) -> DataFrame:
    """Stops after more than half of the song."""
    lengths = songs.select(F.col("id").alias("song_id"), "duration_sec")
    stops = playback.where(F.col("event_type") == "SongStopEvent").join(lengths, "song_id")
    return stops.where(F.col("at_time_sec") * 2 > F.col("duration_sec"))


def song_popularity(playback: DataFrame, songs: DataFrame) -> DataFrame:
    """Long listens per song; as published, the first one counts as 0.

    Stops are counted per (song, position) before the song lengths are joined.
    """
    stops = playback.where(F.col("event_type") == "SongStopEvent")
    counted = stops.groupBy("song_id", "at_time_sec", "event_type").agg(F.count(F.lit(1)).alias("n"))
    total = long_listens(counted, songs).groupBy("song_id").agg(F.sum("n").alias("listens"))
    return total.select("song_id", (F.col("listens") - 1).alias("listen_count"))


def top_songs(popularity: DataFrame, k: int) -> DataFrame:
    return popularity.orderBy(F.desc("listen_count"), "song_id").limit(k)


def follow_candidates(likes: DataFrame, songs: DataFrame, follows: DataFrame) -> DataFrame:
    """(user, artist) pairs with enough liked songs and no follow yet."""
    owner = songs.select(F.col("id").alias("song_id"), "artist_id")
    fans = likes.join(owner, "song_id").groupBy("user_id", "artist_id").agg(F.count(F.lit(1)).alias("liked"))
    keys = ["user_id", "artist_id"]
    return fans.where(F.col("liked") >= LIKES_TO_FOLLOW).join(follows, keys, "left_anti").select(*keys, "liked")


def country_decay_weight(countries: DataFrame, now: Column, half_life_days: float = HALF_LIFE_DAYS) -> DataFrame:
    """Weight of each enabled country, halved every `half_life_days`, the hourly form, and the total."""
    micros = micros_between(F.col("enabled_at"), now)
    days, hours = micros / F.lit(86400e6), micros / F.lit(3600e6)
    weight = F.exp(-F.log(F.lit(2.0)) / F.lit(float(half_life_days)) * days)
    rows = countries.where(F.col("enabled_at").isNotNull()).select(
        "code", weight.alias("weight"), F.exp(F.lit(-HOURLY_DECAY) * hours).alias("hourly_weight")
    )
    return rows.withColumn("total_weight", rows.agg(F.sum("weight")).scalar())


def weighted_choice(
    requests: DataFrame,
    choices: DataFrame,
    request_key: str,
    seed: str = "0",
    with_none: bool = False,
) -> DataFrame:
    """One draw by weight per request. `choices` has `choice` and `weight`.

    Choices get adjoining ranges of a running total; a request draws a point. Point and
    ranges meet in the cells of a grid as fine as there are choices: an equi join, in which
    a request sees about two ranges, however many choices there are. Cells lie in blocks of
    their square root; a range names the cells of its first and last block and the blocks between,
    so that a choice with nearly all the weight is no long list either. With `with_none`, a
    total below 1 leaves the rest of the unit range to "no choice".
    """
    ranges = running_total(choices, [], "choice", F.col("weight").cast("double"), prefix="upto")
    total = choices.agg(F.sum(F.col("weight").cast("double"))).scalar()
    scale = F.greatest(total, F.lit(1.0)) if with_none else total
    cells = F.greatest(choices.agg(F.count(F.lit(1))).scalar(), F.lit(GRID))
    ranges = ranges.select(
        "choice",
        ((F.col("upto") - F.col("weight")) / scale).alias("low"),
        (F.col("upto") / scale).alias("high"),
    )
    block = F.ceil(F.sqrt(cells.cast("double")))

    def steps(start: Column, end: Column) -> Column:
        return F.when(start <= end, F.sequence(start, end)).otherwise(F.array().cast("array<bigint>"))

    first, last = F.floor(F.col("low") * cells), F.floor(F.col("high") * cells)
    spans = ranges.where(F.col("high") > F.col("low")).withColumns(
        {"first": first, "last": last, "head": F.floor(first / block), "tail": F.floor(last / block)}
    )
    head_end = F.least(F.col("last"), (F.col("head") + 1) * block - 1)
    tail_start = F.greatest(F.col("tail") * block, head_end + 1)
    near = F.concat(steps(F.col("first"), head_end), steps(tail_start, F.col("last")))
    tiles = {"cell": near, "block": steps(F.col("head") + 1, F.col("tail") - 1)}

    point = hash_uniform(F.col(request_key), seed)
    drawn = requests.select(request_key).withColumn("point", point).withColumn("cell", F.floor(point * cells))
    drawn = drawn.withColumn("block", F.floor(F.col("cell") / block))
    for level, places in tiles.items():
        names = {f"{level}_{n}": F.col(n) for n in ("choice", "low", "high")}
        tiled = spans.select(*[c.alias(n) for n, c in names.items()], F.explode(places).alias("_place"))
        within = (F.col("point") >= F.col(level + "_low")) & (F.col("point") < F.col(level + "_high"))
        drawn = drawn.join(tiled, (F.col(level) == F.col("_place")) & within, "left").drop("_place")
    return drawn.select(request_key, F.coalesce("cell_choice", "block_choice").alias("choice"))


def artist_last_release(collections: DataFrame) -> DataFrame:
    """`collections` as staged: the event time is the time of the release."""
    return collections.groupBy("artist_id").agg(F.max("event_time").alias("last_release_dtm"))


def _with_length(requests: DataFrame, songs: DataFrame) -> DataFrame:
    lengths = songs.select(F.col("id").alias("song_id"), F.col("duration_sec").alias("_length"))
    return requests.join(lengths, "song_id", "left")


def _playback_status(in_range: Column) -> Column:
    return F.when(F.col("_length").isNull(), "SongNotFound").when(~in_range, "PlaybackError").otherwise("ok")


def validate_play(requests: DataFrame, songs: DataFrame) -> DataFrame:
    """A play starts at 0 <= at_time_sec < duration of an existing song."""
    at = F.col("at_time_sec")
    status = _playback_status((at >= 0) & (at < F.col("_length")))
    return _with_length(requests, songs).withColumn("status", status).select(*requests.columns, "status")


def validate_stop(requests: DataFrame, songs: DataFrame) -> DataFrame:
    """A stop lies at 0 <= at_time_sec <= duration; exactly at the end the song is finished."""
    at = F.col("at_time_sec")
    status = _playback_status((at >= 0) & (at <= F.col("_length")))
    checked = _with_length(requests, songs).withColumn("status", status)
    finished = F.when(F.col("status") == "ok", at == F.col("_length"))
    return checked.withColumn("finished", finished).select(*requests.columns, "status", "finished")


def _first_of(requests: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Earliest request per key as `_first_time`, `_first_id`. A running minimum: a key with
    very many requests is combined on the map side and never sorted in one task."""
    first = F.min(F.struct("event_time", "request_id"))
    rows = requests.groupBy(*keys).agg(first.alias("_first"))
    return rows.select(*keys, F.col("_first.event_time").alias("_first_time"), F.col("_first.request_id").alias("_first_id"))


def signup_eligibility(requests: DataFrame, users: DataFrame, countries: DataFrame) -> DataFrame:
    """Sign-ups in request order: e-mail unused, country exists, country enabled.

    The first request of an e-mail that passes takes it; later ones find it in use.
    """
    taken = users.select("email").distinct().withColumn("_taken", F.lit(True))
    places = countries.select(
        F.col("code").alias("country_code"), F.col("enabled_at").isNotNull().alias("_enabled")
    )
    checked = requests.join(places, "country_code", "left").join(taken, "email", "left")
    winners = _first_of(checked.where(F.col("_taken").isNull() & F.col("_enabled")), ["email"])
    now = F.struct("event_time", "request_id")
    later = now > F.struct(F.col("_first_time").alias("event_time"), F.col("_first_id").alias("request_id"))
    status = (
        F.when(F.col("_taken") | (F.col("_first_id").isNotNull() & later), "UserAlreadyExists")
        .when(F.col("_enabled").isNull(), "CountryNotFound")
        .when(~F.col("_enabled"), "CountryNotEnabled")
        .otherwise("ok")
    )
    return checked.join(winners, "email", "left").withColumn("status", status).select(*requests.columns, "status")


def _once(requests: DataFrame, keys: Sequence[str], refused: Column, again: str) -> DataFrame:
    """Status 'ok' for the first accepted request per key, `again` for the following ones."""
    first = _first_of(requests.where(refused.isNull()), keys)
    status = F.coalesce(refused, F.when(F.col("_first_id") == F.col("request_id"), "ok").otherwise(again))
    return requests.join(first, list(keys), "left").withColumn("status", status)


def validate_like(requests: DataFrame, songs: DataFrame) -> DataFrame:
    known = songs.select(F.col("id").alias("song_id")).distinct().withColumn("_known", F.lit(True))
    refused = F.when(F.col("_known").isNull(), "SongNotFound")
    checked = _once(requests.join(known, "song_id", "left"), ["user_id", "song_id"], refused, "AlreadyLiked")
    return checked.select(*requests.columns, "status")


def validate_follow(requests: DataFrame, artists: DataFrame) -> DataFrame:
    known = artists.select(F.col("id").alias("artist_id")).distinct().withColumn("_known", F.lit(True))
    refused = F.when(F.col("_known").isNull(), "ArtistNotFound")
    checked = _once(requests.join(known, "artist_id", "left"), ["user_id", "artist_id"], refused, "AlreadyFollowed")
    return checked.select(*requests.columns, "status")


def subscribe_once(requests: DataFrame) -> DataFrame:
    nothing = F.lit(None).cast("string")
    return _once(requests, ["user_id"], nothing, "UserAlreadySubscribed").select(*requests.columns, "status")
