"""Runs the load processes: lazily over given stage frames, or from store to store."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame

from tonearm.operators.vault import fresh_rows, load
from tonearm.plans.specs import LOAD_ORDER, SPECS, LoadSpec
from tonearm.session import shuffles_removed
from tonearm.sources.fixtures import LazyTables
from tonearm.sources.store import StoredTables, TableStore

VAULT_TABLES = tuple(spec.target for spec in SPECS)
DATED_KINDS, KEYED_KINDS = ("lsat",), ("hub", "sat", "link")
OPTIONS = {"sat": ("corrected", "published"), "lsat": ("published",)}


def derive_vault(stage: Mapping[str, DataFrame]) -> LazyTables:
    """The warehouse as one lazy first load; links and their facts are dealt by the key on which marts join them."""
    placed = {"link": {"placed": True}, "lsat": {"placed": True}}
    return LazyTables({s.target: (lambda s=s: load(s, stage[s.stage], **placed.get(s.kind, {}))) for s in SPECS})


def load_one(spec: LoadSpec, stage: TableStore, vault: TableStore, batch_id: int, **options) -> bool:
    """Loads what batch `batch_id` of the stage adds to one target; False if it has no rows for it."""
    rows = stage.read(spec.stage, batches=[batch_id])
    if rows is None:
        return False
    target = vault.read(spec.target, before_batch=batch_id)
    own = {k: v for k, v in options.items() if k in OPTIONS.get(spec.kind, ())}
    fresh, made = fresh_rows(spec, rows, target, **own)
    vault.append(
        spec.target, fresh, batch_id, "actual_dtm" if spec.kind in DATED_KINDS else None,
        key=spec.key if spec.kind in KEYED_KINDS else None, made=made,
    )
    return True


def run_load_plan(
    stage: TableStore, vault: TableStore, batch_id: int, at_once: int = 8, histories: bool = False, **options
) -> StoredTables:
    """All processes for one stage batch: hubs, satellites, links, link satellites, references, and with
    `histories` the intervals of the catalogue's satellites.

    Within a group the jobs are submitted side by side, so that short ones fill the
    cluster while a long one finishes. The driver only submits jobs; no rows pass it.
    """
    with shuffles_removed(vault.spark), ThreadPoolExecutor(at_once) as pool:
        for kind in LOAD_ORDER:
            group = [s for s in SPECS if s.kind == kind]
            list(pool.map(lambda s: load_one(s, stage, vault, batch_id, **options), group))
    if histories:
        from tonearm.plans.histories import refresh_histories

        refresh_histories(vault, batch_id)
    vault.commit(batch_id)
    return StoredTables(vault, VAULT_TABLES)
