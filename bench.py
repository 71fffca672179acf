"""Benchmark: prints one JSON line. BENCH_SF_DIR and BENCH_CPUS choose data and cores.

Marts and queries are timed from the raw tables to the counted result; the `stored_` lines
time the marts over a warehouse that was loaded once, as they run in production.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tonearm.registry import EXECUTION_DT, all_queries, open_context
from tonearm.plans.load_plan import VAULT_TABLES, run_load_plan
from tonearm.plans.mart_artist import mart_artist
from tonearm.plans.mart_song import mart_song
from tonearm.plans.mart_user import mart_user
from tonearm.session import local_session, shared_folder
from tonearm.sources.events import messages_of, publish_events, read_events
from tonearm.sources.store import StoredTables, TableStore
from tonearm.streaming.ingest import start_ingest

HEADLINE = (
    "mart_song", "mart_artist", "mart_user",
    "link_session_song_user_listen", "lsat_session_song_user_listen", "sat_user",
    "lsat_session_song_user_listen_second_load",
    "stage_playback", "song_popularity", "follow_candidates", "same_genre_artists",
    "validate_stop", "weighted_choice",
)


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(job, repeats: int) -> float:
    times = []
    for _ in range(repeats):
        start = time.perf_counter()
        job()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = local_session(cpus, **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g"})
    registry = all_queries()
    run(registry["mart_song"](spark, folder))

    out = {name: timed(lambda: run(registry[name](spark, folder)), repeats) for name in HEADLINE}

    c = open_context(spark, folder)
    root = shared_folder(spark, "bench")
    stage, vault = TableStore(spark, root + "/stage"), TableStore(spark, root + "/vault")

    def ingest() -> None:
        read = read_events(spark, root + "/messages")
        start_ingest(read, TableStore(spark, root + "/streamed"), root + "/checkpoint").awaitTermination()

    publish_events(messages_of(c.stage, ["kafka_playback"]), root + "/messages")
    out["ingest_playback_stream"] = timed(ingest, 1)
    for batch_id in (0, 1):
        for name, rows in c.stage.items():
            stage.append(name, rows, batch_id, "event_time")
    out["vault_first_load"] = timed(lambda: run_load_plan(stage, vault, 0), 1)
    out["vault_second_load"] = timed(lambda: run_load_plan(stage, vault, 1), 1)
    tables = StoredTables(vault, VAULT_TABLES)
    for name, mart in (("mart_song", mart_song), ("mart_artist", mart_artist), ("mart_user", mart_user)):
        out["stored_" + name] = timed(lambda: run(mart(tables, EXECUTION_DT)), repeats)

    print(json.dumps({
        "metric": "total_seconds",
        "value": round(sum(out.values()), 3),
        "unit": "sec",
        "queries": out,
        "sf": Path(folder).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
