"""Versions of satellites as intervals: what was valid on a date is a filter instead of a ranking.

A satellite only grows, and the version of a key on a date is found by ranking all its versions.
Here every version also has `valid_to`, the moment of the next one, so that readers need neither a window
nor a shuffle. Change sets keep the intervals up to date: a change set holds all versions of the
keys that a batch touched, late versions included, and replaces what was known of these keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

VALID_TO = "valid_to"


def intervals(versions: DataFrame, key: str) -> DataFrame:
    """Adds `valid_to`, NULL for the last version of a key. Of versions of one moment, the one with the
    smallest row hash is the valid one, as in `latest_version`; the others end when they begin."""
    order = Window.partitionBy(key).orderBy(F.asc("actual_dtm"), F.desc("row_hash"))
    return versions.withColumn(VALID_TO, F.lead("actual_dtm").over(order))


def as_of(history: DataFrame, moment: Column | None = None) -> DataFrame:
    """The version of each key at a moment, or the last one, without `valid_to`."""
    until = F.col(VALID_TO)
    valid = until.isNull() if moment is None else (F.col("actual_dtm") <= moment) & (until.isNull() | (until > moment))
    return history.where(valid).drop(VALID_TO)


def change_set(versions: DataFrame, fresh: DataFrame, key: str) -> DataFrame:
    """Intervals of all versions of the keys that occur in `fresh`; `versions` has the fresh ones too."""
    return intervals(versions.join(fresh.select(key).distinct(), key, "left_semi"), key)


def merged(change_sets: DataFrame, key: str, number: str = "batch_id") -> DataFrame:
    """Of several change sets the rows that hold: those of the last set that has the key."""
    last = change_sets.groupBy(key).agg(F.max(number).alias("_last"))
    return change_sets.join(last, key).where(F.col(number) == F.col("_last")).drop("_last")


def current_intervals(base: DataFrame | None, change_sets: DataFrame | None, key: str) -> DataFrame | None:
    """A merged base with later change sets on top. Only the change sets are ranked; a few touched keys are
    broadcast to the base, which is then read once and not shuffled."""
    if base is None or change_sets is None:
        return base if change_sets is None else merged(change_sets, key)
    untouched = base.join(change_sets.select(key).distinct(), key, "left_anti")
    return untouched.unionByName(merged(change_sets, key))
