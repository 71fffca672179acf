"""As-of dates of the marts and the choice between all and current satellite versions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tonearm.operators.history import as_of
from tonearm.operators.vault import latest_version
from tonearm.sources.fixtures import LazyTables

CATALOGUE_SATS = {
    "sat_user": "user_id",
    "sat_song": "song_id",
    "sat_collection": "collection_id",
    "sat_artist": "artist_id",
}
#: Ending of the name under which the intervals of a satellite stand among the tables.
HISTORY = "_history"


def midnight(execution_dt: str) -> Column:
    """Start of the day as a zone-less literal, the type of the columns it is compared to."""
    return F.lit(execution_dt).cast("timestamp_ntz")


def day_before(execution_dt: str, days: int = 1) -> Column:
    return midnight(execution_dt) - F.expr(f"INTERVAL '{days}' DAY")


def current(tables: Mapping[str, DataFrame], execution_dt: str | None = None) -> LazyTables:
    """The same tables with only the last version of each user, song, collection and artist.

    With a date, versions up to it count, so that a mart for an old date can be repeated later. Where the
    tables have the intervals of a satellite (`plans.histories`), these are filtered instead of ranked.
    """

    def pick(name: str) -> DataFrame:
        key = CATALOGUE_SATS.get(name)
        if key is None:
            return tables[name]
        if name + HISTORY in tables:
            return as_of(tables[name + HISTORY], None if execution_dt is None else midnight(execution_dt))
        versions = tables[name]
        if execution_dt is not None:
            versions = versions.where(F.col("actual_dtm") <= midnight(execution_dt))
        return latest_version(versions, key)

    return LazyTables({name: (lambda name=name: pick(name)) for name in tables})
