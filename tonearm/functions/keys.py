"""Hash keys and hash-based uniform draws, built from JVM-side expressions only."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T

SOURCE = "kafka"


def text_form(column: Column, data_type: T.DataType | None = None) -> Column:
    """Text that enters a hash. Booleans read 't' / 'f', everything else its plain cast."""
    if isinstance(data_type, T.BooleanType):
        return F.when(column, F.lit("t")).when(~column, F.lit("f"))
    return column.cast("string")


def hash_key(parts: Iterable[Column], source: str = SOURCE) -> Column:
    """base64(sha256(part#part#...#source)); NULL parts are skipped, as `concat_ws` does."""
    text = F.concat(F.concat_ws("#", *parts), F.lit("#" + source))
    return F.base64(F.unhex(F.sha2(text, 256)))


def row_hash(df: DataFrame, fields: Iterable[str], source: str = SOURCE) -> Column:
    """Hash over the attribute columns of a satellite row (the business key is not part of it)."""
    return hash_key([text_form(F.col(f), df.schema[f].dataType) for f in fields], source)


def hash_uniform(*parts: Column | str) -> Column:
    """Repeatable uniform number in [0, 1): the first 32 bits of a SHA-256 over the parts."""
    digits = F.substring(draw_order(*parts), 1, 8)
    return F.conv(digits, 16, 10).cast("double") / F.lit(4294967296.0)


def draw_order(*parts: Column | str) -> Column:
    """Hex digest that puts rows in a repeatable random order; include the seed as a part."""
    columns = [F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]
    return F.sha2(F.concat_ws("#", *columns), 256)


def micros_between(start: Column, end: Column) -> Column:
    """Microseconds from `start` to `end`, both without zone: every day has 24 hours."""

    def of_day(moment: Column) -> Column:
        seconds = F.extract(F.lit("SECOND"), moment)
        return (F.hour(moment) * 60 + F.minute(moment)).cast("bigint") * 60_000_000 + (seconds * 1_000_000).cast("bigint")

    days = F.date_diff(end.cast("date"), start.cast("date")).cast("bigint")
    return days * 86_400_000_000 + of_day(end) - of_day(start)
