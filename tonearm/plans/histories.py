"""Stored intervals of the catalogue's satellites, next to the warehouse tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tonearm.operators.history import change_set, current_intervals, merged
from tonearm.operators.vault import within_batch_parts
from tonearm.plans.asof import CATALOGUE_SATS, HISTORY
from tonearm.sources.fixtures import LazyTables
from tonearm.sources.store import StoredTables, TableStore


def refresh_histories(vault: TableStore, batch_id: int) -> None:
    """Writes the change set of one batch for each satellite that it added versions to.

    The satellites are read in the key parts of the batch only. A batch that is run again replaces
    its change set.
    """
    for sat, key in CATALOGUE_SATS.items():
        fresh = vault.read(sat, batches=[batch_id])
        if fresh is None:
            continue
        versions = within_batch_parts(F.col(key), fresh, vault.read(sat, before_batch=batch_id + 1))
        plain = versions.drop(*StoredTables.STORAGE_COLUMNS)
        vault.append(sat + HISTORY, change_set(plain, fresh, key), batch_id, key=key)


def fold_histories(vault: TableStore, upto: int) -> None:
    """Merges all change sets up to a batch into one generation, the base that later ones are laid on."""
    for sat, key in CATALOGUE_SATS.items():
        vault.compact(sat + HISTORY, 0, upto, lambda rows, key=key: merged(rows, key))


def read_history(vault: TableStore, sat: str) -> DataFrame:
    """All versions of a satellite with `valid_to`, as of the last complete batch."""
    name, key = sat + HISTORY, CATALOGUE_SATS[sat]
    rows, last = vault.read(name), vault.last_complete()
    if rows is None:
        raise KeyError(f"{name} has not been written")
    rows = rows if last is None else rows.where(F.col("batch_id") <= last)
    folded = [high for low, high in vault.generations(name) if low == 0]
    base = rows.where(F.col("batch_id") <= folded[0]) if folded else None
    later = rows.where(F.col("batch_id") > folded[0]) if folded else rows
    return current_intervals(base, later, key).drop(*StoredTables.STORAGE_COLUMNS)


def with_histories(tables: StoredTables, vault: TableStore) -> LazyTables:
    """The stored tables, and the intervals that corrected marts take their versions from."""
    histories = {sat + HISTORY: (lambda sat=sat: read_history(vault, sat)) for sat in CATALOGUE_SATS}
    return LazyTables({**{name: (lambda name=name: tables[name]) for name in tables}, **histories})
