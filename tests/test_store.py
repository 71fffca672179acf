"""Compaction of stored batches, and the factors of candidate pairs."""

import pytest
from pyspark.sql import functions as F

from tonearm.operators.catalogue import candidates_of, genre_candidates
from tonearm.sources.store import StoredTables, TableStore


def batch(spark, number, rows=20):
    """Rows of two months; every third batch has none."""
    rows = 0 if number % 3 == 2 else rows
    moment = f"timestamp_ntz '1996-01-20' + make_interval(0, 0, 0, CAST(id AS INT))"
    return spark.range(rows).selectExpr(f"concat('k', {number}, '-', id) AS song_id", f"{moment} AS event_time", f"{number} AS made_in")


def fill(spark, folder, batches, **layout):
    store = TableStore(spark, folder)
    for number in batches:
        store.append("t", batch(spark, number), number, **layout)
        store.commit(number)
    return store


def seen(df):
    return sorted((r.song_id, r.made_in, r.batch_id) for r in df.collect())


LAYOUTS = [{"dated_by": "event_time"}, {"key": "song_id"}, {}]


@pytest.mark.parametrize("layout", LAYOUTS)
def test_reads_are_equal_before_during_and_after(spark, folder, layout):
    store = fill(spark, folder, range(8), **layout)
    before = seen(store.read("t"))
    earlier, some = seen(store.read("t", before_batch=4)), seen(store.read("t", batches=[1, 6, 2, 99]))
    held = store.read("t")  # a reader that began before
    assert len(before) == 6 * 20 and {b for *_, b in some} == {1, 6}

    # a job that died: a folder without a mark, with half of the rows
    draft = f"{store._generations('t')}/0-4"
    batch(spark, 0, 5).withColumn("batch_id", F.lit(0)).write.parquet(draft)
    assert seen(store.read("t")) == before and store.generations("t") == []

    store.compact("t", 0, 4)
    assert store.generations("t") == [(0, 4)]
    for _ in range(2):
        assert seen(store.read("t")) == before == seen(held)
        assert seen(store.read("t", before_batch=4)) == earlier
        assert seen(store.read("t", batches=[1, 6, 2, 99])) == some
        if _ == 0:
            store.drop_compacted("t")
            held = store.read("t")
    assert store._batches("t") == [5, 6, 7]
    assert store.read("t").columns == [*TableStore(spark, folder).read("t").columns]
    assert StoredTables(store, ("t",))["t"].columns == ["song_id", "event_time", "made_in"]

    store.append("t", batch(spark, 9), 9, **layout)
    store.commit(9)
    after = seen(store.read("t"))
    store.compact("t", 0, 7)  # a generation of a generation and batches
    assert store.generations("t") == [(0, 7)] and seen(store.read("t")) == after
    store.drop_compacted("t")
    assert seen(store.read("t")) == after and store._marked("t") == [(0, 7)]
    assert store.read("t", batches=[2]) is None or store.read("t", batches=[2]).isEmpty()


def test_generations_keep_partitions_and_filters(spark, folder):
    store = fill(spark, folder, range(4), dated_by="event_time")
    store.compact("t", 0, 2)
    store.drop_compacted("t")
    january = store.read("t").where("event_month = 199601")
    plan = january._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert len(scans) == 2 and all("event_month" in line.split("PartitionFilters")[1].split("]")[0] for line in scans)
    assert january.count() == 3 * 12


def test_only_settled_whole_batches_are_compacted(spark, folder):
    store = fill(spark, folder, range(6))
    with pytest.raises(ValueError):
        store.compact("t", 0, 5)  # the last complete batch may be run again
    store.compact("t", 0, 2)
    with pytest.raises(ValueError):
        store.compact("t", 2, 4)  # would cut through 0-2
    with pytest.raises(ValueError):
        store.compact("t", 1, 2 + 1)
    assert store.generations("t") == [(0, 2)]


def test_due_generations_grow_with_the_logarithm(spark, folder):
    store = TableStore(spark, folder)
    made = []
    for number in range(14):
        store.append("t", spark.range(1).selectExpr(f"{number} AS made_in"), number)
        store.commit(number)
        made += store.compact_due("t", fanout=3)
        store.drop_compacted("t")
        assert [r.made_in for r in store.read("t").orderBy("made_in").collect()] == list(range(number + 1))
    assert made == [(0, 2), (3, 5), (6, 8), (0, 8), (9, 11)]
    assert store.generations("t") == [(0, 8), (9, 11)] and store._batches("t") == [12, 13]
    assert store.compact_due("none") == []


@pytest.mark.parametrize("at_home", [False, True])
def test_factors_expand_to_the_published_pairs(spark, at_home):
    users = spark.createDataFrame([(f"u{k}", f"{k % 3}") for k in range(12)] + [("idle", "0"), ("lost", None)], "id string, country_code string")
    songs = spark.createDataFrame([(f"s{k}", f"g{k % 4}" if k % 5 else None) for k in range(20)], "id string, genre_id string")
    artists = spark.createDataFrame(
        [(f"a{k}", f"g{k % 3}" if k % 7 else None, f"{k % 3}") for k in range(30)] + [("nowhere", "g1", None)],
        "id string, genre_id string, country_code string",
    )
    likes = spark.createDataFrame([(f"u{k % 12}", f"s{(k * k) % 25}") for k in range(60)] + [("lost", "s1"), ("unknown", "s1")], "user_id string, song_id string").distinct()
    tastes, members = genre_candidates(users, likes, songs, artists, same_country=at_home)
    home, genre = dict(users.collect()), dict(songs.collect())
    want = {}
    for like in likes.collect():
        for a in artists.collect():
            if like.user_id in home and genre.get(like.song_id) and a.genre_id == genre[like.song_id]:
                if not at_home or (a.country_code is not None and a.country_code == home[like.user_id]):
                    want[(like.user_id, a.id)] = want.get((like.user_id, a.id), 0) + 1
    got = candidates_of(users.withColumnRenamed("id", "user_id"), tastes, members).collect()
    assert {(r.user_id, r.artist_id): r.liked for r in got} == want and len(got) == len(want)
    sums = {r.user_id: r.n for r in tastes.groupBy("user_id").agg(F.sum("n_artists").alias("n")).collect()}
    assert all(n == sum(u == user for u, _ in want) for user, n in sums.items())
    one = candidates_of(spark.createDataFrame([("u1",), ("u1",), ("idle",)], "user_id string"), tastes, members).collect()
    assert {(r.user_id, r.artist_id) for r in one} == {p for p in want if p[0] == "u1"}
