"""Stage and library tables derived from the given TPC-H-like tables (FIXTURES.md section 2)."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

CATALOGUE_START = "1995-01-01 00:00:00"


class LazyTables(Mapping):
    """Name -> DataFrame; a frame is declared on first use and kept."""

    def __init__(self, builders: Mapping[str, Callable[[], DataFrame]]) -> None:
        self._builders = dict(builders)
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self._builders[name]()
        return self._frames[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def given_tables(spark: SparkSession, folder: str) -> LazyTables:
    names = ("nation", "customer", "supplier", "part", "orders", "lineitem", "events")
    return LazyTables({n: (lambda n=n: spark.read.parquet(f"{folder}/{n}.parquet")) for n in names})


def _ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def _days(start: str, days: Column) -> Column:
    """Timestamp `days` whole days after `start`."""
    return F.date_add(F.lit(start[:10]).cast("date"), days.cast("int")).cast("timestamp_ntz")


def _id(prefix: str, key: str | Column) -> Column:
    key = F.col(key) if isinstance(key, str) else key
    return F.concat(F.lit(prefix), key.cast("string"))


def _two_digits(number: Column) -> Column:
    return F.lpad(number.cast("string"), 2, "0")


def _event(df: DataFrame, event_type: str, event_time: Column, **columns: Column) -> DataFrame:
    named = [c.alias(n) for n, c in columns.items()]
    return df.select(*named, F.lit(event_type).alias("event_type"), event_time.alias("event_time"))


def stage_tables(given: Mapping[str, DataFrame]) -> LazyTables:
    """The 11 stage tables as derived rows."""
    col = F.col
    owner = lambda c: _id("A", c % given["supplier"].agg(F.count("*")).scalar())
    shelf = (col("p_partkey") - col("p_partkey") % 10) / 10
    parts = lambda: given["part"].withColumn("c", shelf.cast("bigint"))
    lines = lambda: given["lineitem"].join(
        given["orders"].select("o_orderkey", "o_custkey"), col("l_orderkey") == col("o_orderkey")
    )

    def country_enabled() -> DataFrame:
        enabled = given["nation"].where(col("n_nationkey") % 5 != 4)
        return _event(
            enabled, "CountryEnabled", _ntz(CATALOGUE_START),
            country_code=_two_digits(col("n_nationkey")),
        )

    def genre() -> DataFrame:
        brands = given["part"].select("p_brand").distinct()
        brands = brands.withColumn("b", F.substring("p_brand", 7, 10).cast("int"))
        return _event(
            brands.where(col("b") != 7), "GenreCreated", _ntz(CATALOGUE_START),
            id=col("p_brand"),
            name=col("p_brand"),
            happiness_index=(col("b") * 37 % 201 - 100).cast("int"),
            mean_duration_sec=(col("b") + 200).cast("decimal(10,2)"),
            country_code=_two_digits(col("b") % 25),
        )

    def artist() -> DataFrame:
        return _event(
            given["supplier"], "ArtistCreated", _ntz(CATALOGUE_START),
            id=_id("A", "s_suppkey"),
            name=col("s_name"),
            founded_year=(col("s_suppkey") % 70 + 1950).cast("int"),
            country_code=_two_digits(col("s_nationkey")),
        )

    def collection() -> DataFrame:
        kind = F.element_at(F.array(F.lit("LP"), F.lit("EP"), F.lit("SINGLE")), (col("c") % 3 + 1).cast("int"))
        return _event(
            parts().where(col("p_partkey") % 10 == 0),
            "CollectionCreated",
            _days(CATALOGUE_START, col("c") * 31 % 2200),
            id=_id("C", "c"),
            name=_id("Collection ", "c"),
            collection_type=kind,
            artist_id=owner(col("c")),
            genre_id=col("p_brand"),
            released_dt=F.date_add(F.lit("1990-01-01").cast("date"), (col("p_size") * 60).cast("int")).cast("string"),
        )

    def song() -> DataFrame:
        return _event(
            parts(), "SongCreated", _ntz(CATALOGUE_START),
            id=_id("S", "p_partkey"),
            name=col("p_name"),
            duration_sec=(col("p_size") * 6 + 60).cast("int"),
            artist_id=owner(col("c")),
            genre_id=col("p_brand"),
            collection_id=_id("C", "c"),
        )

    def user_history() -> DataFrame:
        versions = given["customer"].withColumn(
            "v", F.explode(F.when(col("c_custkey") % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
        )
        return _event(
            versions,
            "SignUpEvent",
            _days(CATALOGUE_START, col("c_custkey") % 365 + col("v") * (col("c_custkey") * 7 % 2000 + 400)),
            user_id=_id("U", "c_custkey"),
            email=F.concat(F.lower("c_name"), F.when(col("v") == 1, ".new").otherwise(""), F.lit("@example.com")),
            country_code=_two_digits((col("c_nationkey") + col("v")) % 25),
            first_name=col("c_name"),
            last_name=col("c_mktsegment"),
            birth_date=F.date_add(F.lit("1970-01-01").cast("date"), (col("c_custkey") % 9000).cast("int")),
        )

    def user_subscription() -> DataFrame:
        return _event(
            given["customer"].where(col("c_mktsegment") == "BUILDING"),
            "UserSubscriptionEvent",
            _days("1996-03-01", col("c_custkey") * 37 % 2000),
            user_id=_id("U", "c_custkey"),
            session_id=_id("X", "c_custkey"),
        )

    def user_authorization() -> DataFrame:
        return _event(
            given["orders"], "SignInSuccessEvent", col("o_orderdate"),
            user_id=_id("U", "o_custkey"), session_id=_id("X", "o_orderkey"),
        )

    def playback() -> DataFrame:
        played = lines().join(given["part"].select("p_partkey", "p_size"), col("l_partkey") == col("p_partkey"))
        duration = col("p_size") * 6 + 60
        is_play = col("l_linestatus") == "O"
        at_time = (
            F.when(is_play & (col("l_returnflag") == "R"), col("l_quantity"))
            .when(is_play, 0)
            .when(col("l_returnflag") == "A", duration)
            .otherwise(F.floor(duration * col("l_quantity") / 51))
        )
        return played.select(
            _id("U", "o_custkey").alias("user_id"),
            _id("X", "l_orderkey").alias("session_id"),
            _id("S", "l_partkey").alias("song_id"),
            at_time.cast("int").alias("at_time_sec"),
            F.when(col("l_linestatus") == "F", col("l_returnflag") == "A").alias("finished"),
            F.when(is_play, "SongPlayEvent").otherwise("SongStopEvent").alias("event_type"),
            col("l_shipdate").alias("event_time"),
        )

    def song_like() -> DataFrame:
        return _event(
            lines().where(col("l_quantity") >= 40), "SongLikedEvent", col("l_shipdate"),
            user_id=_id("U", "o_custkey"),
            session_id=_id("X", "l_orderkey"),
            song_id=_id("S", "l_partkey"),
        )

    def artist_follow() -> DataFrame:
        return _event(
            lines().where(col("l_quantity") <= 5), "ArtistFollowedEvent", col("l_shipdate"),
            user_id=_id("U", "o_custkey"),
            session_id=_id("X", "l_orderkey"),
            artist_id=_id("A", "l_suppkey"),
        )

    return LazyTables(
        {
            "kafka_country_enabled": country_enabled,
            "kafka_genre": genre,
            "kafka_artist": artist,
            "kafka_collection": collection,
            "kafka_song": song,
            "kafka_user_history": user_history,
            "kafka_user_subscription": user_subscription,
            "kafka_user_authorization": user_authorization,
            "kafka_playback": playback,
            "kafka_song_like": song_like,
            "kafka_artist_follow": artist_follow,
        }
    )


def with_history(stage: Mapping[str, DataFrame]) -> LazyTables:
    """The stage tables with further versions of some songs, artists and collections, before and after
    the dates of the marts."""
    col = F.col
    number = F.substring("id", 2, 20).cast("bigint")

    def versions(name: str, *changes: tuple[Column, dict[str, Column]]) -> DataFrame:
        rows = stage[name]
        out = rows
        for which, columns in changes:
            out = out.unionByName(rows.where(which).withColumns(columns))
        return out

    def renamed(suffix: str) -> Column:
        return F.concat("name", F.lit(suffix))

    songs = lambda: versions(
        "kafka_song",
        (
            number % 7 == 3,
            {"name": renamed(" live"), "duration_sec": col("duration_sec") + 30, "event_time": _ntz("1998-01-01")},
        ),
        ((number % 7).isin(3, 4), {"name": renamed(" lost"), "event_time": _ntz("2002-01-01")}),
    )
    artists = lambda: versions(
        "kafka_artist",
        (
            number % 3 == 1,
            {"country_code": _two_digits((col("country_code").cast("int") + 1) % 25), "event_time": _ntz("1998-06-01")},
        ),
        ((number % 3).isin(1, 2), {"name": renamed(" II"), "event_time": _ntz("2003-01-01")}),
    )
    collections = lambda: versions(
        "kafka_collection",
        (number % 4 == 2, {"name": renamed(" again"), "event_time": col("event_time") + F.expr("INTERVAL 300 DAYS")}),
        ((number % 4).isin(2, 3), {"name": renamed(" late"), "event_time": _ntz("2005-01-01")}),
    )
    changed = {"kafka_song": songs, "kafka_artist": artists, "kafka_collection": collections}
    return LazyTables({name: changed.get(name, lambda name=name: stage[name]) for name in stage})


def incomplete_updates(stage: Mapping[str, DataFrame]) -> LazyTables:
    """Updates of some songs, artists and users that lack fields their first version has."""
    col, text = F.col, F.lit(None).cast("string")
    number = lambda key: F.substring(key, 2, 20).cast("bigint")
    first_users = lambda: stage["kafka_user_history"].where(~col("email").endswith(".new@example.com"))
    return LazyTables(
        {
            "kafka_song": lambda: stage["kafka_song"].where(number("id") % 7 == 3).withColumns(
                {"name": text, "duration_sec": col("duration_sec") + 30, "event_time": _ntz("1998-01-01")}
            ),
            "kafka_artist": lambda: stage["kafka_artist"].where(number("id") % 3 == 1).withColumns(
                {"country_code": text, "founded_year": F.lit(None).cast("int"), "event_time": _ntz("1998-06-01")}
            ),
            "kafka_user_history": lambda: first_users().where(number("user_id") % 5 == 0).withColumns(
                {"email": text, "last_name": F.concat("last_name", F.lit(" Jr")), "event_time": _ntz("2004-01-01")}
            ),
        }
    )


def library_tables(given: Mapping[str, DataFrame], stage: Mapping[str, DataFrame]) -> LazyTables:
    """Catalogue tables (countries, genres, artists, ...) and batches of requests against them."""
    col = F.col

    def countries() -> DataFrame:
        enabled = stage["kafka_country_enabled"].select(
            col("country_code").alias("code"), col("event_time").alias("enabled_at")
        )
        named = given["nation"].select(_two_digits(col("n_nationkey")).alias("code"), col("n_name").alias("name"))
        return named.join(enabled, "code", "left")

    def artists() -> DataFrame:
        number = F.substring("id", 2, 20).cast("bigint")
        return stage["kafka_artist"].select(
            "id", "name", "founded_year", "country_code",
            _id("Brand#", number % 30 + 1).alias("genre_id"),
        )

    def users() -> DataFrame:
        return stage["kafka_user_history"].where(~col("email").endswith(".new@example.com")).select(
            col("user_id").alias("id"), "email", "country_code", "first_name", "last_name", "birth_date"
        )

    def play_requests() -> DataFrame:
        return given["events"].select(
            col("event_id").alias("request_id"),
            _id("U", "user_id").alias("user_id"),
            _id("X", "event_id").alias("session_id"),
            _id("S", col("event_id") % 3000).alias("song_id"),
            (F.floor(col("value") * 10).cast("int") - 20).alias("at_time_sec"),
            col("ts").alias("event_time"),
        )

    def signup_requests() -> DataFrame:
        is_old = col("event_id") % 3 == 0
        return given["events"].select(
            col("event_id").alias("request_id"),
            F.concat(
                F.when(is_old, F.concat(F.lit("customer#"), F.lpad(col("user_id").cast("string"), 9, "0"))).otherwise(
                    F.concat(F.lit("guest"), (col("event_id") % 700).cast("string"))
                ),
                F.lit("@example.com"),
            ).alias("email"),
            _two_digits(col("event_id") % 28).alias("country_code"),
            col("ts").alias("event_time"),
        )

    def like_requests() -> DataFrame:
        return given["events"].select(
            col("event_id").alias("request_id"),
            _id("U", "user_id").alias("user_id"),
            _id("S", col("event_id") % 40 * 100).alias("song_id"),
            col("ts").alias("event_time"),
        )

    def follow_requests() -> DataFrame:
        return given["events"].select(
            col("event_id").alias("request_id"),
            _id("U", "user_id").alias("user_id"),
            _id("A", col("event_id") % 130).alias("artist_id"),
            col("ts").alias("event_time"),
        )

    def subscribe_requests() -> DataFrame:
        return given["events"].where(col("event_type") == "purchase").select(
            col("event_id").alias("request_id"), _id("U", "user_id").alias("user_id"), col("ts").alias("event_time")
        )

    return LazyTables(
        {
            "like_requests": like_requests,
            "follow_requests": follow_requests,
            "subscribe_requests": subscribe_requests,
            "countries": countries,
            "genres": lambda: stage["kafka_genre"].drop("event_type", "event_time"),
            "artists": artists,
            "collections": lambda: stage["kafka_collection"].drop("event_type", "event_time"),
            "songs": lambda: stage["kafka_song"].drop("event_type", "event_time"),
            "users": users,
            "song_likes": lambda: stage["kafka_song_like"].select("user_id", "song_id").distinct(),
            "artist_follows": lambda: stage["kafka_artist_follow"].select("user_id", "artist_id").distinct(),
            "play_requests": play_requests,
            "signup_requests": signup_requests,
        }
    )


def edge_messages(given: Mapping[str, DataFrame]) -> DataFrame:
    """Messages a stage has to cope with, one kind per remainder of the event number:
    unknown type, unrouted type, unknown key, missing optional key, missing required key,
    malformed text, required key with null, and the same message twice."""
    col = F.col
    text = F.translate(col("ts").cast("string"), " ", "T")
    time = F.concat(F.substring(text, 1, 19), F.lit("."), F.rpad(F.substring(text, 21, 6), 6, "0"))
    user, session, song = _id("U", "user_id"), _id("X", "event_id"), _id("S", col("event_id") % 3000)

    def message(event_type: str, fields: str, *values: Column) -> Column:
        text = '{"type":"' + event_type + '","data":{"event_time":"%s",' + fields + "}}"
        return F.format_string(text, time, *values)

    play = (user, session, song, col("event_id") % 60)
    kinds = [
        F.format_string('{"type":"%s","data":{"event_time":"%s","user_id":"%s"}}', col("event_type"), time, user),
        message("SignInFailureEvent", '"reason":"bad %s"', col("event_type")),
        message(
            "SongPlayEvent",
            '"user_id":"%s","session_id":"%s","song_id":"%s","at_time_sec":%d,"device":"phone"', *play,
        ),
        message(
            "SignUpEvent",
            '"user_id":"N%d","country_code":"01","first_name":"A","last_name":"B","birth_date":"2001-02-03"',
            col("event_id"),
        ),
        message("SongPlayEvent", '"session_id":"%s","song_id":"%s","at_time_sec":%d', *play[1:]),
        F.format_string('{"type":"SongPlayEvent","data":{%d', col("event_id")),
        message(
            "SignUpEvent",
            '"user_id":"N%d","email":"n%d@example.com","country_code":"01","first_name":"A","last_name":"B",'
            '"birth_date":null',
            col("event_id"), col("event_id"),
        ),
        message(
            "SongStopEvent",
            '"user_id":"%s","session_id":"%s","song_id":"%s","at_time_sec":%d,"finished":false', *play,
        ),
    ]
    kind = col("event_id") % 8
    value = F.coalesce(*[F.when(kind == i, text) for i, text in enumerate(kinds)])
    copies = F.when(kind == 7, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return given["events"].select(value.alias("value"), F.explode(copies).alias("copy")).select("value")
