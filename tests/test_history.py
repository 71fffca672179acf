"""Satellite intervals: against the ranking of versions, over loads, late versions, repeats and folding."""

from datetime import datetime

from pyspark.sql import functions as F

from tonearm.operators.history import as_of, change_set, current_intervals, intervals, merged
from tonearm.operators.vault import latest_version
from tonearm.plans.asof import HISTORY, current, midnight
from tonearm.plans.histories import fold_histories, read_history, refresh_histories, with_histories
from tonearm.plans.load_plan import VAULT_TABLES, run_load_plan
from tonearm.sources.store import StoredTables, TableStore

VERSION = "user_id string, actual_dtm timestamp_ntz, email string, row_hash string"


def day(n):
    return datetime(1996, 1, n)


#: Two versions of one moment, one key with a single version, and one with many.
ROWS = [("a", day(1), "x", "h1"), ("a", day(5), "y", "h3"), ("a", day(5), "z", "h2"), ("b", day(3), "p", "h4")] + [
    ("c", day(k), f"e{k}", f"k{k}") for k in range(1, 28, 3)
]


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_a_filter_gives_what_the_ranking_gives(spark):
    versions = spark.createDataFrame(ROWS, VERSION)
    history = intervals(versions, "user_id")
    assert rows(as_of(history)) == rows(latest_version(versions, "user_id"))
    for d in ("1995-12-31", "1996-01-01", "1996-01-04", "1996-01-05", "1996-01-06", "1996-01-28"):
        want = latest_version(versions.where(F.col("actual_dtm") <= midnight(d)), "user_id")
        assert rows(as_of(history, midnight(d))) == rows(want)
    assert "Window" not in as_of(history.persist())._jdf.queryExecution().optimizedPlan().toString().split("InMemoryRelation")[0]
    assert intervals(versions.where("false"), "user_id").count() == 0


def test_change_sets_with_late_versions_and_a_base(spark):
    versions = spark.createDataFrame(ROWS, VERSION)
    late = [("a", day(2), "late", "l1"), ("b", day(20), "q", "h5"), ("d", day(9), "new", "h6")]
    parts = [versions.where("day(actual_dtm) < 6"), versions.where("day(actual_dtm) >= 6"), spark.createDataFrame(late, VERSION)]
    known, sets = None, None
    for number, fresh in enumerate(parts):
        known = fresh if known is None else known.unionByName(fresh)
        made = change_set(known, fresh, "user_id").withColumn("batch_id", F.lit(number))
        sets = made if sets is None else sets.unionByName(made)
        want = rows(intervals(known, "user_id"))
        assert rows(merged(sets, "user_id").drop("batch_id")) == want
        base = merged(sets.where("batch_id = 0"), "user_id")
        later = sets.where("batch_id > 0") if number else None
        assert rows(current_intervals(base, later, "user_id").drop("batch_id")) == want
    assert current_intervals(None, None, "user_id") is None


def sign_ups(spark, number, users, name):
    return spark.createDataFrame(
        [(u, f"{u}@x", "05", name, "last", datetime(1980, 1, 1).date(), "SignUpEvent", day(number + 1)) for u in users],
        "user_id string, email string, country_code string, first_name string, last_name string, birth_date date, "
        "event_type string, event_time timestamp_ntz",
    )


def test_stored_histories_over_loads_repeats_and_folds(spark, folder):
    stage, vault = TableStore(spark, folder + "/stage"), TableStore(spark, folder + "/vault")
    batches = [(["u1", "u2", "u3"], "first"), (["u2"], "second"), (["u4", "u2"], "third"), (["u1"], "fourth")]
    for number, (users, name) in enumerate(batches):
        stage.append("kafka_user_history", sign_ups(spark, number, users, name), number, "event_time")
        for _ in range(2 if number == 2 else 1):  # one batch is run again
            tables = run_load_plan(stage, vault, number, histories=True)
        want = rows(intervals(tables["sat_user"], "user_id"))
        assert rows(read_history(vault, "sat_user").select(*tables["sat_user"].columns, "valid_to")) == want
        if number == 2:
            fold_histories(vault, 1)
            assert rows(read_history(vault, "sat_user").select(*tables["sat_user"].columns, "valid_to")) == want
            vault.drop_compacted("sat_user" + HISTORY)
    assert len(want) == 7
    # a change set of a batch that isn't complete yet is not seen
    stage.append("kafka_user_history", sign_ups(spark, 9, ["u1"], "later"), 4, "event_time")
    from tonearm.plans.load_plan import load_one
    from tonearm.plans.specs import BY_TARGET

    load_one(BY_TARGET["sat_user"], stage, vault, 4)
    refresh_histories(vault, 4)
    tables = StoredTables(vault, VAULT_TABLES)
    assert rows(read_history(vault, "sat_user").select(*tables["sat_user"].columns, "valid_to")) == want
    by_rank, by_filter = current(tables, "1996-01-04")["sat_user"], current(with_histories(tables, vault), "1996-01-04")["sat_user"]
    assert rows(by_filter.select(*by_rank.columns)) == rows(by_rank)
    plan = by_filter._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_a_narrow_change_set_reads_few_parts(spark, folder):
    stage, vault = TableStore(spark, folder + "/stage"), TableStore(spark, folder + "/vault")
    stage.append("kafka_user_history", sign_ups(spark, 0, [f"u{k}" for k in range(200)], "n"), 0, "event_time")
    stage.append("kafka_user_history", sign_ups(spark, 1, ["u7"], "m"), 1, "event_time")
    for number in range(2):
        run_load_plan(stage, vault, number, histories=True)
    assert vault.read("sat_user" + HISTORY, batches=[1]).count() == 2
    assert read_history(vault, "sat_user").count() == 201
