"""Session settings the engine relies on, and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

#: State of streams: in RocksDB files of the executors instead of their heap, with one bound for the memory of all of an
#: executor's stores; batches write what they change.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    "spark.sql.streaming.stateStore.compression.codec": "zstd",
}


def local_session(cores: int | str = "*", **extra: str) -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("tonearm")
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder for this run under the cluster's `spark.checkpoint.dir`.

    Only a local session without that setting gets a temporary folder of its own:
    on a cluster the executors could not see it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="tonearm-")
    return f"{root.rstrip('/')}/tonearm/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def _with_settings(settings: Mapping[str, str], *sessions: SparkSession) -> Iterator[None]:
    before = [{name: s.conf.get(name, None) for name in settings} for s in sessions]
    for s in sessions:
        for name, value in settings.items():
            s.conf.set(name, value)
    try:
        yield
    finally:
        for s, values in zip(sessions, before):
            for name, value in values.items():
                if value is None:
                    s.conf.unset(name)
                else:
                    s.conf.set(name, value)


def shuffles_removed(*sessions: SparkSession) -> AbstractContextManager[None]:
    """Tables written in the block leave no shuffle files behind; otherwise these stay until the driver collects garbage."""
    return _with_settings({"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}, *sessions)


def state_on_disk(spark: SparkSession) -> AbstractContextManager[None]:
    """Streams started in the block keep their state in files. A stream that began otherwise goes on as it began."""
    return _with_settings(STATE, spark)
