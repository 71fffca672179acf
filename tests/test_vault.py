import base64
import hashlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tonearm.operators.vault import latest_version, load
from tonearm.plans.specs import BY_TARGET, SPECS

T1, T2, T3 = datetime(1996, 1, 1), datetime(1997, 1, 1), datetime(1998, 1, 1)
USER = (
    "user_id string, email string, country_code string, first_name string, last_name string, "
    "birth_date date, event_type string, event_time timestamp_ntz"
)
PLAY = (
    "user_id string, session_id string, song_id string, at_time_sec int, finished boolean, "
    "event_type string, event_time timestamp_ntz"
)


def key(*parts):
    return base64.b64encode(hashlib.sha256("#".join([*parts, "kafka"]).encode()).digest()).decode()


def users(spark, *rows):
    return spark.createDataFrame([(*r[:5], None, "SignUpEvent", r[5]) for r in rows], USER)


def plays(spark, *rows):
    return spark.createDataFrame(list(rows), PLAY)


def test_hash_keys(spark):
    stage = plays(spark, ("u", "x", "s", 0, None, "SongPlayEvent", T1))
    hub = load(BY_TARGET["hub_user"], users(spark, ("u", "e", "01", "a", "b", T1))).collect()
    link = load(BY_TARGET["link_session_song_user_listen"], stage).collect()
    assert [(r.user_id, r.original_id, r.source) for r in hub] == [(key("u"), "u", "kafka")]
    assert link[0].session_song_user_listen_id == key("x", "s", "u")
    assert (link[0].session_id, link[0].song_id, link[0].user_id) == (key("x"), key("s"), key("u"))


def test_boolean_and_timestamp_text_in_row_hash(spark):
    stage = spark.createDataFrame([("u", "x", "UserSubscriptionEvent", T1)], "user_id string, session_id string, event_type string, event_time timestamp_ntz")
    row = load(BY_TARGET["sat_user_subscription"], stage).first()
    assert row.row_hash == key("1996-01-01 00:00:00", "t")


def test_duplicates_and_missing_keys(spark):
    stage = users(spark, ("u", "e", "01", "a", "b", T1), ("u", "e", "01", "a", "b", T1), (None, "e", "01", "a", "b", T1))
    assert load(BY_TARGET["hub_user"], stage).count() == 1
    assert load(BY_TARGET["sat_user"], stage).count() == 1


@pytest.mark.parametrize("spec", SPECS, ids=lambda s: s.target)
def test_second_load_adds_nothing(spark, spec):
    from tonearm.registry import open_context

    stage = open_context(spark, "/root/testdata/sf0.001").stage[spec.stage]
    loaded = load(spec, stage)
    assert load(spec, stage, loaded).isEmpty()


@pytest.mark.parametrize("target", ["hub_user", "link_session_song_user_listen", "lsat_session_song_user_listen"])
def test_two_batches_load_what_one_does(spark, target):
    from tonearm.registry import open_context

    spec = BY_TARGET[target]
    stage = open_context(spark, "/root/testdata/sf0.001").stage[spec.stage]
    early = F.col("event_time") < F.lit(T3)
    first = load(spec, stage.where(early))
    both = first.unionByName(load(spec, stage.where(~early), first))
    whole = load(spec, stage)
    assert both.exceptAll(whole).isEmpty() and whole.exceptAll(both).isEmpty()


def test_sat_fills_from_previous_version_when_corrected(spark):
    spec = BY_TARGET["sat_user"]
    known = load(spec, users(spark, ("u", "old@x", "01", "a", "b", T1), ("u", "new@x", "02", "a", "b", T2)))
    update = users(spark, ("u", None, "03", None, "c", T3))
    plain = load(spec, update, known).first()
    assert (plain.email, plain.first_name, plain.last_name) == (None, None, "c")
    filled = load(spec, update, known, corrected=True).first()
    assert (filled.email, filled.first_name, filled.last_name) == ("new@x", "a", "c")


def test_equal_attributes_of_another_key(spark):
    """Versions are compared per key; as published, one is known if any key has its row hash."""
    spec = BY_TARGET["sat_session"]
    schema = "user_id string, session_id string, event_type string, event_time timestamp_ntz"
    known = load(spec, spark.createDataFrame([("u", "x", "SignInSuccessEvent", T1)], schema))
    other = spark.createDataFrame([("u", "y", "SignInSuccessEvent", T1)], schema)
    assert load(spec, other, known, published=True).isEmpty()
    assert load(spec, other, known).count() == 1
    assert load(spec, other, known, corrected=True).count() == 1


def test_action_types(spark):
    stage = plays(
        spark,
        ("u", "x", "s", 0, None, "SongPlayEvent", T1),
        ("u", "x", "s", 5, None, "SongPlayEvent", T2),
        ("u", "x", "s", 6, False, "SongStopEvent", T2),
        ("u", "x", "s", 7, True, "SongStopEvent", T2),
        ("u", "x", "s", 8, None, "SongStopEvent", T3),
    )
    rows = load(BY_TARGET["lsat_session_song_user_listen"], stage).collect()
    assert {r.at_time_sec: r.action_type for r in rows} == {
        0: "Start", 5: "Restart", 6: "Pause", 7: "Complete", 8: "Complete"
    }


def test_fact_with_other_fields_is_another_fact(spark):
    """Also with a missing field; as published, a fact is known by its key and moment."""
    spec = BY_TARGET["lsat_session_song_user_listen"]
    known = load(spec, plays(spark, ("u", "x", "s", None, None, "SongPlayEvent", T1)))
    other = plays(spark, ("u", "x", "s", 9, None, "SongPlayEvent", T1), ("u", "x", "s", None, None, "SongPlayEvent", T1))
    assert [r.at_time_sec for r in load(spec, other, known).collect()] == [9]
    assert load(spec, other, known, published=True).isEmpty()


def test_genre_duration_is_rounded(spark):
    from decimal import Decimal

    schema = "id string, name string, happiness_index int, mean_duration_sec decimal(10,2), country_code string, event_type string, event_time timestamp_ntz"
    stage = spark.createDataFrame([("g", "n", 1, Decimal("200.50"), "01", "GenreCreated", T1)], schema)
    assert load(BY_TARGET["ref_genre"], stage).first().average_duration_sec == 201


def test_prices_are_in_range(spark):
    schema = "country_code string, event_type string, event_time timestamp_ntz"
    stage = spark.createDataFrame([(f"{i:02d}", "CountryEnabled", T1) for i in range(50)], schema)
    rows = load(BY_TARGET["ref_country_subscription_cost"], stage).collect()
    basic = {r.country_code: r for r in rows if r.subscription_type == "Basic"}
    premium = {r.country_code: r for r in rows if r.subscription_type == "Premium"}
    assert len(basic) == len(premium) == 50
    for code, b in basic.items():
        p = premium[code]
        assert 8 <= b.subscription_cost <= 15
        assert 1.09 <= float(p.subscription_cost / b.subscription_cost) <= 1.61
        assert abs(float(p.royalty) - round(float(b.royalty) * 1.2, 2)) < 0.011


def test_latest_version(spark):
    sat = load(BY_TARGET["sat_user"], users(spark, ("u", "1", "01", "a", "b", T1), ("u", "2", "01", "a", "b", T2)))
    assert [r.email for r in latest_version(sat, "user_id").collect()] == ["2"]


def test_placed_loads_give_the_same_rows(spark):
    """Dealt by key or not: copies go, rows without a key part go, keys that collide in their text stay two rows."""
    from tonearm.operators.vault import load
    from tonearm.plans.specs import BY_TARGET

    moment = datetime(1999, 1, 1)
    rows = [("a", "x", "s", 1, True, "SongStopEvent", moment)] * 3
    rows += [("a", "x", "s", 2, True, "SongStopEvent", moment), (None, "x", "s", 1, True, "SongStopEvent", moment)]
    rows += [("c", "a#b", "s", 1, None, "SongPlayEvent", None), ("c", "a", "b#s", 1, None, "SongPlayEvent", None)]
    stage = spark.createDataFrame(
        rows,
        "user_id string, session_id string, song_id string, at_time_sec int, finished boolean, event_type string, "
        "event_time timestamp_ntz",
    )
    for target, n in (("link_session_song_user_listen", 3), ("lsat_session_song_user_listen", 4)):
        spec = BY_TARGET[target]
        plain, placed = load(spec, stage), load(spec, stage, placed=True)
        assert placed.columns == plain.columns and placed.count() == plain.count() == n
        assert placed.exceptAll(plain).isEmpty()


def test_hashed_keys_are_made_behind_the_shuffles(spark, folder):
    """What a load looks up and lays out are raw ids (facts: bytes of their key); the columns made of them are those of the table."""
    from tonearm.operators.vault import fresh_rows, load
    from tonearm.plans.specs import BY_TARGET
    from tonearm.sources.store import TableStore

    day, later = datetime(1999, 1, 1), datetime(1999, 1, 2)
    fields = "user_id string, session_id string, song_id string, at_time_sec int, finished boolean, event_type string, event_time timestamp_ntz"
    row = lambda user, moment: (user, "x", "s", 1, True, "SongStopEvent", moment)
    first = spark.createDataFrame([row("a", day), row("b", day)], fields)
    second = spark.createDataFrame([row("b", day), row("b", later), row("c", day), (None, "x", "s", 1, True, "SongStopEvent", day)], fields)
    store = TableStore(spark, folder)
    for target, n, dated in (("link_session_song_user_listen", 1, None), ("lsat_session_song_user_listen", 2, "actual_dtm")):
        spec = BY_TARGET[target]
        store.append(target, load(spec, first), 0, dated, key=None if dated else spec.key)
        for known in (None, store.read(target)):
            rows, made = fresh_rows(spec, second, known)
            assert not {spec.key, *spec.part_names} & (set(rows.columns) - set(spec.parts))
            assert list(made) == load(spec, second, known).columns
        fresh = load(spec, second, store.read(target))
        plain = load(spec, second).exceptAll(load(spec, first))
        assert fresh.count() == n and fresh.exceptAll(plain).isEmpty()
        store.append(target, rows, 1, dated, key=None if dated else spec.key, made=made)
        assert store.read(target, batches=[1]).select(fresh.columns).exceptAll(plain).isEmpty()
        assert store.read(target).count() == 2 + n
