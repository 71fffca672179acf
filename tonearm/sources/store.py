"""Append-only parquet tables: one folder per batch, partitioned by month where rows are dated.

Within a month files are sorted by time, so a filter on days skips row groups; daily folders
would mean thousands of small files for every batch that spans years.

A batch that is run again replaces its own folder and nothing else, so a job that dies
between two appends is simply repeated.

Keyed rows can be laid out by a part of their hash key, so that a load which has few keys reads
only the parts of the target where these would be.

Many batches leave many small folders. `compact` rewrites a run of complete batches as one
generation, which keeps the number of each row's batch; readers take a generation instead of its
batches from the moment its mark is written, and what was written without a mark is never read.
Generations of generations are made the same way, so that a row is rewritten a number of times
that grows with the logarithm of the number of batches. `drop_compacted` removes what no reader takes any more.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

DATED_BY = {"event_time": "event_month", "actual_dtm": "actual_month"}
KEY_PART, KEY_PARTS = "key_part", 16
#: Ids and hash keys are hex or base64 text; only an entropy coder makes files of them as small as their bits.
COMPRESSION = "zstd"
FANOUT = 10


def month_of(moment: Column) -> Column:
    """Partition value of a moment: year * 100 + month."""
    return (F.year(moment) * 100 + F.month(moment)).cast("int")


def part_of(key: Column) -> Column:
    """Partition value of a hash key: one of KEY_PARTS numbers, by its first letter."""
    return F.pmod(F.ascii(F.substring(key, 1, 1)), F.lit(KEY_PARTS)).cast("int")


def _level(batches: int, fanout: int) -> int:
    """How often generations of that many batches have been made of smaller ones."""
    level = 0
    while batches >= fanout:
        batches, level = batches // fanout, level + 1
    return level


class TableStore:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    def _place(self, folder: str):
        """File system and path of a folder."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def _names(self, folder: str) -> list[str]:
        system, path = self._place(folder)
        return [s.getPath().getName() for s in system.listStatus(path)] if system.exists(path) else []

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _exists(self, folder: str) -> bool:
        system, path = self._place(folder)
        return system.exists(path)

    def _read_folders(self, base: str, folders: list[str]) -> DataFrame | None:
        try:
            return self.spark.read.option("basePath", base).parquet(*folders) if folders else None
        except AnalysisException as e:
            if e.getCondition() == "UNABLE_TO_INFER_SCHEMA":  # only batches without rows so far
                return None
            raise

    def read(
        self, name: str, before_batch: int | None = None, batches: Iterable[int] | None = None
    ) -> DataFrame | None:
        """All batches, those before `before_batch`, or just `batches`; None if there are none.

        Given batches are read from their own folders, without listing the others; those whose folder is
        gone are taken from their generation.
        """
        base, wanted = self.path(name), None
        if batches is not None:
            wanted = list(batches)
            own = [b for b in wanted if self._exists(f"{base}/batch_id={b}")]
            folders, gone = [f"{base}/batch_id={b}" for b in own], sorted(set(wanted) - set(own))
            ranges = [r for r in self.generations(name) if any(r[0] <= b <= r[1] for b in gone)] if gone else []
            wanted = gone
        else:
            ranges = self.generations(name)
            folders = [base] if not ranges and self._exists(base) else []
            if ranges:
                folders = [f"{base}/batch_id={b}" for b in self._batches(name) if not any(r[0] <= b <= r[1] for r in ranges)]
        df = self._read_folders(base, folders)
        for low, high in ranges:
            folder = f"{self._generations(name)}/{low}-{high}"
            rows = self._read_folders(folder, [folder])
            if rows is not None:
                rows = rows if wanted is None else rows.where(F.col("batch_id").isin(wanted))
                df = rows if df is None else df.unionByName(rows)
        return df if before_batch is None or df is None else df.where(F.col("batch_id") < before_batch)

    def _batches(self, name: str) -> list[int]:
        """Numbers of the batches that have a folder."""
        return sorted(int(n.removeprefix("batch_id=")) for n in self._names(self.path(name)) if n.startswith("batch_id="))

    def parts(self, name: str, column: str) -> set[int]:
        """Partition values of a column that any batch of a table has, by the names of its folders."""
        ranges = self.generations(name)
        own = [f"{self.path(name)}/batch_id={b}" for b in self._batches(name) if not any(r[0] <= b <= r[1] for r in ranges)]
        folders = own + [f"{self._generations(name)}/{low}-{high}" for low, high in ranges]
        ends = [n.partition("=") for folder in folders for n in self._names(folder)]
        return {int(value) for key, _, value in ends if key == column}

    def _generations(self, name: str) -> str:
        return f"{self.root}/_generations/{name}"

    def _marked(self, name: str) -> list[tuple[int, int]]:
        marks = [n.removesuffix(".done") for n in self._names(self._generations(name)) if n.endswith(".done")]
        return [(int(low), int(high)) for low, _, high in (m.partition("-") for m in marks)]

    def generations(self, name: str) -> list[tuple[int, int]]:
        """First and last batch of the generations that readers take, in order: the widest ones, none within another."""
        taken: list[tuple[int, int]] = []
        for low, high in sorted(self._marked(name), key=lambda r: (r[0], -r[1])):
            if not taken or low > taken[-1][1]:
                taken.append((low, high))
        return taken

    def compact(
        self, name: str, low: int, high: int, changed: Callable[[DataFrame], DataFrame] | None = None
    ) -> None:
        """Rewrites the batches low .. high as one generation, laid out as they are; `changed` leaves out
        rows that others have taken the place of.

        All of them must lie before the last complete batch, which may still be run again. A job that
        dies leaves a folder without a mark, which nobody reads and the next one replaces.
        """
        last = self.last_complete()
        if last is None or high >= last:
            raise ValueError(f"batch {high} of {name} may still be written")
        if any(r[0] < low <= r[1] < high or low < r[0] <= high < r[1] for r in self._marked(name)):
            raise ValueError(f"{low}-{high} of {name} cuts through a generation")
        rows = self.read(name)
        rows = rows.where(F.col("batch_id").between(low, high)) if rows is not None else None
        folder = f"{self._generations(name)}/{low}-{high}"
        if rows is None:
            return
        rows = rows if changed is None else changed(rows)
        parts = [c for c in (KEY_PART, *DATED_BY.values()) if c in rows.columns]
        order = [c for c in rows.columns if c in DATED_BY or c.endswith("_id") and c != "batch_id"]
        laid = rows.hint("rebalance", *[F.col(c) for c in parts])
        laid = laid.sortWithinPartitions(*parts, *order) if parts or order else laid
        laid.write.mode("overwrite").partitionBy(*parts).parquet(folder, compression=COMPRESSION)
        system, mark = self._place(folder + ".done")
        system.create(mark, True).close()

    def compact_due(self, name: str, fanout: int = FANOUT) -> list[tuple[int, int]]:
        """Makes a generation wherever `fanout` neighbours of one size have come together; returns those made."""
        made: list[tuple[int, int]] = []
        while True:
            last = self.last_complete()
            taken = self.generations(name)
            single = [(b, b) for b in self._batches(name) if not any(r[0] <= b <= r[1] for r in taken)]
            units = sorted(r for r in (*taken, *single) if last is not None and r[1] < last)
            runs: list[list[tuple[int, int]]] = []
            for unit in units:
                level = _level(unit[1] - unit[0] + 1, fanout)
                if runs and runs[-1][0] == level:
                    runs[-1].append(unit)
                else:
                    runs.append([level, unit])
            due = next((run[1:] for run in runs if len(run) > fanout), None)
            if due is None:
                return made
            made.append((due[0][0], due[-1][1]))
            self.compact(name, *made[-1])

    def drop_compacted(self, name: str) -> None:
        """Removes the folders of batches and smaller generations that a generation has taken the place of.

        For a time when no reader is at work that began before that generation was marked.
        """
        taken = self.generations(name)
        inside = lambda low, high: any(r[0] <= low and high <= r[1] and r != (low, high) for r in taken)
        for low, high in self._marked(name):
            if inside(low, high):
                for suffix in (".done", ""):
                    system, path = self._place(f"{self._generations(name)}/{low}-{high}{suffix}")
                    system.delete(path, True)
        for batch in self._batches(name):
            if any(r[0] <= batch <= r[1] for r in taken):
                system, path = self._place(f"{self.path(name)}/batch_id={batch}")
                system.delete(path, True)

    def commit(self, batch_id: int) -> None:
        """Marks a batch as complete: all its tables are written."""
        system, path = self._place(f"{self.root}/_complete/{batch_id}")
        system.create(path, True).close()

    def last_complete(self) -> int | None:
        """The last batch that is complete; None where no batch is marked."""
        return max(map(int, self._names(f"{self.root}/_complete")), default=None)

    @contextmanager
    def draft(self, batch_id: int) -> Iterator[str]:
        """A folder for what a batch is made of while its tables are written. It goes with them, and a batch that
        is run again after a loss replaces what was left of it."""
        folder = f"{self.root}/_drafts/{batch_id}"
        try:
            yield folder
        finally:
            system, path = self._place(folder)
            system.delete(path, True)

    def append(
        self, name: str, df: DataFrame, batch_id: int, dated_by: str | None = None, month: str | None = None,
        key: str | None = None, made: Mapping[str, Column | str] | None = None,
    ) -> None:
        """Writes the rows of one batch, with `insert_dtm`. Files are sized by rebalancing,
        which also splits a month that holds most of the rows. `month` names a month column
        that the rows have already, `key` a hash key by whose parts they are laid out. With `made`, these are the
        columns of the table, computed from the rows behind the shuffle that lays them out: ids and keys that
        don't compress stay out of it."""
        target = f"{self.path(name)}/batch_id={batch_id}"
        moment = F.current_timestamp().cast("timestamp_ntz").alias("insert_dtm")
        made = {c: c for c in df.columns} if made is None else made
        own = [(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in made.items()]
        rows, part, order = df, month, []
        if key is not None:
            # hashed keys are random and don't compress in any order; of the other ids the last has most rows
            part, order = KEY_PART, [KEY_PART, *[n for n in reversed(list(made)) if n.endswith("_id") and n != key], key]
            rows = rows.withColumn(part, part_of(F.col(made[key]) if isinstance(made[key], str) else made[key]))
        elif dated_by is not None:
            part, order = DATED_BY[dated_by], [DATED_BY[dated_by], dated_by]
            rows = rows.withColumn(part, month_of(F.col(dated_by)))
        parts = [part] if part else []
        rows = rows.hint("rebalance", *[F.col(p) for p in parts])
        rows = rows.select(*own, moment, *[p for p in parts if p not in made])
        rows = rows.sortWithinPartitions(*order) if order else rows
        rows.write.mode("overwrite").partitionBy(*parts).parquet(target, compression=COMPRESSION)


class StoredTables(Mapping):
    """Name -> DataFrame over the tables of a store, without the storage columns.

    Where batches are marked as complete, those behind the last mark are not seen: a reader never
    finds links without their facts while a batch is being loaded, or after it failed.
    """

    STORAGE_COLUMNS = ("batch_id", "insert_dtm", *DATED_BY.values(), KEY_PART)

    def __init__(self, store: TableStore, names: tuple[str, ...]) -> None:
        self._store = store
        self._names = names

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        df = self._store.read(name)
        if df is None:
            raise KeyError(f"{name} has not been loaded")
        last = self._store.last_complete()
        if last is not None:
            df = df.where(F.col("batch_id") <= last)
        return df.drop(*self.STORAGE_COLUMNS)

    def __iter__(self) -> Iterator[str]:
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)
