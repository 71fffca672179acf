"""Independent SQL for every registered query, for DuckDB over the same parquet tables."""

from __future__ import annotations


def all_oracles() -> dict[str, str]:
    from oracles import library, mart_artist, mart_song, mart_user, stage, vault
    from oracles.base import with_ctes

    out: dict[str, str] = {}
    for module in (stage, vault, mart_song, mart_artist, mart_user, library):
        out.update(module.oracles(with_ctes))
    return out
