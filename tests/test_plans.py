"""Plans: everything stays in the JVM, filters reach the scans, nothing is cross joined."""

import ast
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tonearm.plans import mart_artist, mart_user
from tonearm.plans.load_plan import VAULT_TABLES, run_load_plan
from tonearm.registry import EXECUTION_DT, all_queries, open_context
from tonearm.sources.store import StoredTables, TableStore

FOLDER = "/root/testdata/sf0.001"
EAGER = ("run_load_plan", "stored_histories", "append_table", "append_stage", "read_events", "publish_events", "stream_")
QUERIES = {n: q for n, q in all_queries().items() if not n.startswith(EAGER)}
PACKAGE = Path(__file__).resolve().parents[1] / "tonearm"
OWN = [p for p in PACKAGE.rglob("*.py") if "llm" not in p.parts]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_python_and_no_cross_join(spark, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    for word in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "MapInArrow"):
        assert word not in plan, word


def test_rows_never_pass_the_driver():
    """What is collected are the targets a batch has rows for, and the months and key parts it has."""
    calls = []
    for path in OWN:
        for node in ast.walk(ast.parse(path.read_text())):
            if isinstance(node, ast.Attribute) and node.attr in ("collect", "toPandas", "toLocalIterator", "rdd"):
                calls.append((path.name, node.attr))
    assert sorted(calls) == [("ingest.py", "collect"), ("ingest.py", "collect"), ("vault.py", "collect"), ("vault.py", "collect")]


def test_no_forced_broadcast_and_no_local_checkpoint():
    text = "".join(p.read_text() for p in OWN)
    assert not re.search(r"broadcast\(|localCheckpoint|monotonically_increasing", text)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = f"file://{tmp_path_factory.mktemp('warehouse')}"
    stage, vault = TableStore(spark, root + "/stage"), TableStore(spark, root + "/vault")
    for name, rows in open_context(spark, FOLDER).stage.items():
        stage.append(name, rows, 0, "event_time")
    return run_load_plan(stage, vault, 0)


def scan_of(plan, table):
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line and f"/{table}]" in line]
    assert scans
    return scans


def test_stored_warehouse_equals_derived(spark, stored):
    derived = open_context(spark, FOLDER).vault
    assert set(stored) == set(VAULT_TABLES)
    for name in ("hub_song", "sat_user", "link_collection_song", "lsat_session_song_user_like", "ref_genre"):
        a, b = stored[name], derived[name]
        assert a.exceptAll(b.select(a.columns)).isEmpty() and a.count() == b.count()


def test_week_filter_and_columns_reach_the_scan(spark, stored):
    plan = plan_of(mart_artist.artist_listen_country(stored, EXECUTION_DT))
    for scan in scan_of(plan, "lsat_session_song_user_listen"):
        assert "GreaterThanOrEqual(actual_dtm,1999-05-25T00:00)" in scan
        assert "LessThanOrEqual(actual_dtm,1999-06-01T00:00)" in scan
        assert "at_time_sec" not in scan.split("ReadSchema")[1]


def test_facts_are_scanned_once(spark, stored):
    plan = plan_of(mart_user.mart_user(stored, EXECUTION_DT))
    assert len(scan_of(plan, "lsat_session_song_user_listen")) == 1
    plan = plan_of(mart_artist.mart_artist(stored, EXECUTION_DT))
    assert len(scan_of(plan, "lsat_session_song_user_listen")) == 2  # one week, and all time


def test_rank_limits_are_applied_before_the_shuffle(spark, stored):
    for df in (
        mart_user.mart_user(stored, EXECUTION_DT),
        mart_user.favourites_list(mart_user.user_listenings_agg(stored, EXECUTION_DT), "song"),
    ):
        assert re.search(r"WindowGroupLimit.*Partial", plan_of(df))


def test_second_load_skips_files_outside_the_batch(spark, tmp_path):
    from tonearm.operators.vault import load
    from tonearm.plans.specs import BY_TARGET

    spec = BY_TARGET["lsat_session_song_user_like"]
    store = TableStore(spark, f"file://{tmp_path}")
    stage = open_context(spark, FOLDER).stage[spec.stage]
    store.append(spec.target, load(spec, stage), 0, "actual_dtm")
    plan = plan_of(load(spec, stage.where("event_time >= timestamp_ntz '2001-01-01'"), store.read(spec.target)))
    scan = " ".join(scan_of(plan, spec.target))
    assert re.search(r"PartitionFilters: \[[^\]]*actual_month", scan)


@pytest.mark.parametrize("target", ["hub_user", "sat_user", "link_session_song_user_like"])
def test_a_narrow_batch_reads_few_parts_of_the_target(spark, tmp_path, target):
    from tonearm.operators.vault import load
    from tonearm.plans.specs import BY_TARGET
    from tonearm.sources.store import part_of

    spec = BY_TARGET[target]
    store = TableStore(spark, f"file://{tmp_path}")
    stage = open_context(spark, FOLDER).stage[spec.stage]
    loaded = load(spec, stage)
    store.append(target, loaded, 0, key=spec.key)
    one = stage.orderBy(*spec.parts).limit(1)
    parts = {r.p for r in load(spec, one).select(part_of(F.col(spec.key)).alias("p")).collect()}
    fresh = load(spec, one, store.read(target))
    scan = " ".join(scan_of(plan_of(fresh), target))
    named = re.search(r"PartitionFilters: \[[^\]]*key_part#\d+ (?:IN \(|= )([\d,]+)", scan)
    assert named and {int(n) for n in named[1].split(",")} == parts and len(parts) == 1
    assert fresh.isEmpty()
    assert load(spec, stage, store.read(target)).isEmpty()
    assert store.read(target).select(spec.key, "key_part").where(part_of(F.col(spec.key)) != F.col("key_part")).isEmpty()


def test_one_late_event_adds_its_own_month_only(spark, tmp_path):
    from tonearm.operators.vault import load
    from tonearm.plans.specs import BY_TARGET

    spec = BY_TARGET["lsat_session_song_user_like"]
    store = TableStore(spark, f"file://{tmp_path}")
    stage = open_context(spark, FOLDER).stage[spec.stage]
    store.append(spec.target, load(spec, stage), 0, "actual_dtm")
    late = stage.where("event_time >= timestamp_ntz '1998-08-01' OR event_time < timestamp_ntz '1992-04-01'")
    months = {r.m for r in late.selectExpr("year(event_time) * 100 + month(event_time) AS m").distinct().collect()}
    plan = plan_of(load(spec, late, store.read(spec.target)))
    named = re.search(r"PartitionFilters: \[[^\]]*actual_month#\d+ (?:IN|INSET) \(?([^\])]*)", " ".join(scan_of(plan, spec.target)))
    assert named and {int(n) for n in re.findall(r"\d{6}", named[1])} <= months
    assert not any(199300 < m < 199800 for m in months)


def test_old_facts_stay_unread_by_the_song_counts(spark, stored):
    plan = plan_of(mart_artist.artist_popular_songs(stored, "1995-01-01"))
    scan = " ".join(scan_of(plan, "lsat_session_song_user_listen"))
    assert "LessThan(actual_dtm,1995-01-01T00:00)" in scan


def test_listens_meet_songs_when_they_are_counted(spark, stored):
    """Between the scan of the facts and the join with the songs there is an aggregate."""
    plan = plan_of(mart_user.user_listenings_agg(stored, EXECUTION_DT))
    counted = re.search(r"HashAggregate\(keys=\[user_id#\d+, song_id#\d+, at_time_sec#\d+, action_type#\d+", plan)
    assert counted


def test_link_is_dealt_by_its_key_as_raw_ids(spark):
    """The hashed keys of a link are made behind the shuffle by its key, which serves the join as well."""
    link = open_context(spark, FOLDER).vault["link_session_song_user_listen"]
    plan = plan_of(link.groupBy("session_song_user_listen_id").count())
    assert plan.count("REPARTITION_BY_COL") == 1
    assert "Exchange" not in plan.split("REPARTITION_BY_COL")[0].replace("Exchange hashpartitioning(static_invoke", "")


def test_grouping_sets_are_not_shuffled(spark):
    """Four sets of rows, their sums and the first ranks follow one shuffle by user."""
    size = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        agg = mart_user.user_listenings_agg(open_context(spark, FOLDER).vault, EXECUTION_DT)
        plan = plan_of(mart_user._listener_profiles(agg, corrected=False))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)
    assert "Expand" not in plan and plan.count("Generate inline") == 2
    above = plan.split("hashpartitioning(user_id")[0]
    assert above.count("Exchange") == 1


def test_facts_are_dealt_once_by_the_key_of_their_link(spark):
    """Copies, the join with the links and the counts per key share one shuffle of raw ids, on either side."""
    vault = open_context(spark, FOLDER).vault
    key = "session_song_user_listen_id"
    size = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts = plan_of(vault["lsat_session_song_user_listen"].groupBy(key).count())
        joined = vault["lsat_session_song_user_listen"].join(vault["link_session_song_user_listen"], key)
        plan = plan_of(joined.groupBy(key, "user_id").count())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)
    dealt = re.findall(r"Exchange .*REPARTITION_BY_COL", facts)
    assert len(dealt) == 1 and "Exchange" not in facts.split(dealt[0])[0]
    assert plan.count("REPARTITION_BY_COL") == 2
    assert not re.search(r"Exchange hashpartitioning\((_session_id|_user_id|_song_id|session_song_user_listen_id)#", plan)


def test_artist_mart_deals_its_links_once(spark):
    """Weekly listens, all listens and the list of heard songs use one shuffle of the links."""
    size = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = plan_of(mart_artist.mart_artist(open_context(spark, FOLDER).vault, EXECUTION_DT))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    dealt = re.findall(r"^[ :]*\+- Exchange .*concat_ws\(#, session_id#\d+, song_id#\d+, user_id.*REPARTITION_BY_COL", plan, re.M)
    again = re.findall(r"ReusedExchange \[session_id#\d+, song_id#\d+, user_id#\d+\]", plan)
    assert (len(dealt), len(again)) == (1, 2)
