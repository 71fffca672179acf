"""Event messages -> typed stage rows. All functions work on batch and streaming frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tonearm.schemas import EVENT_FIELDS, ID_FIELDS, ROUTED_TYPES, STAGE_TABLES, StageTable

ENVELOPE = "type string, data string"


def event_id(event_type: Column, data: Column) -> Column:
    """Repeatable id of a message: equal messages, equal id."""
    return F.sha2(F.concat(event_type, data), 256)


def with_event_id(events: DataFrame) -> DataFrame:
    """The id of each event, made of its type and data, as the first column."""
    made = event_id(F.coalesce("type", F.lit("")), F.col("data")).alias("event_id")
    return events.select(made, *[c for c in events.columns if c != "event_id"])


def parsed(df: DataFrame, json_column: str, schema: T.StructType | str, *keep: Column | str) -> DataFrame:
    """`keep` columns and the fields of a JSON column. Going through a generator, the text is
    parsed once per row; as plain expressions the optimizer would copy the parse into every
    field and filter that uses it."""
    return df.select(*keep, F.inline(F.array(F.from_json(json_column, schema))))


def decode_envelope(messages: DataFrame) -> DataFrame:
    """UTF-8 JSON in `value` -> type and data (the payload as JSON text).

    A message that is no envelope has a NULL type and keeps its text in `data`.
    """
    kept = [c for c in messages.columns if c != "value"]
    text = messages.withColumn("_text", F.col("value").cast("string"))
    is_event = F.col("type").isNotNull() & F.col("data").isNotNull()
    decoded = parsed(text, "_text", ENVELOPE, "_text", *kept).select(
        *kept,
        F.when(is_event, F.col("type")).alias("type"),
        F.when(is_event, F.col("data")).otherwise(F.col("_text")).alias("data"),
    )
    return decoded.withColumn("event_id", event_id(F.coalesce("type", F.lit("")), F.col("data")))


def route_events(decoded: DataFrame) -> DataFrame:
    """Adds the stage table of each event; NULL for types that have none."""
    targets = F.create_map(
        *[F.lit(v) for table in STAGE_TABLES.values() for t in table.event_types for v in (t, table.name)]
    )
    return decoded.withColumn("stage_table", targets[F.col("type")])


def project_payload(decoded: DataFrame, table: StageTable) -> DataFrame:
    """Events of one table with typed columns: unknown keys are dropped, missing ones NULL."""
    mine = decoded.where(F.col("type").isin(*table.event_types))
    rows = parsed(mine, "data", table.payload, "event_id", F.col("type").alias("event_type"), "data")
    return rows.select("event_id", *table.columns, "data")


def missing_required(table: StageTable) -> Column:
    """Array with the names of the required columns that are NULL."""
    names = [F.when(F.col(c).isNull(), F.lit(c)) for c in table.required]
    return F.array_compact(F.array(*names))


def enforce_required(projected: DataFrame, table: StageTable) -> tuple[DataFrame, DataFrame]:
    """Splits into rows the table accepts and quarantined events with their missing columns."""
    checked = projected.withColumn("missing", missing_required(table))
    valid = checked.where(F.size("missing") == 0).drop("missing", "data")
    refused = checked.where(F.size("missing") > 0).select(
        "event_id", F.col("event_type").alias("type"), F.lit(table.name).alias("stage_table"), "missing", "data"
    )
    return valid, refused


def stage_rows(decoded: DataFrame, name: str) -> DataFrame:
    """Accepted rows of one stage table."""
    return enforce_required(project_payload(decoded, STAGE_TABLES[name]), STAGE_TABLES[name])[0]


def judge_events(decoded: DataFrame) -> DataFrame:
    """Adds the stage table and the missing required columns of each event, parsing it once.

    A message that is no event misses its `type`; an event without a table misses nothing.
    """
    required = {f.name: f for t in STAGE_TABLES.values() for f in t.payload if f.name in t.required}
    schema = T.StructType([T.StructField("_" + n, f.dataType) for n, f in required.items()])
    renamed = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in required.items())
    checked = decoded.withColumn("_row", F.from_json("data", renamed))
    out = decoded.columns
    checked = checked.select(*out, F.inline(F.array(F.col("_row").cast(schema))))
    missing = F.array().cast("array<string>")
    for table in STAGE_TABLES.values():
        names = F.array_compact(F.array(*[F.when(F.col("_" + c).isNull(), F.lit(c)) for c in table.required]))
        missing = F.when(F.col("type").isin(*table.event_types), names).otherwise(missing)
    missing = F.when(F.col("type").isNull(), F.array(F.lit("type"))).otherwise(missing)
    return route_events(checked.withColumn("missing", missing)).select(*out, "stage_table", "missing")


def quarantined_events(decoded: DataFrame) -> DataFrame:
    """Malformed messages and events that lack a required column."""
    judged = decoded if "missing" in decoded.columns else judge_events(decoded)
    return judged.where(F.size("missing") > 0).select("event_id", "type", "stage_table", "missing", "data")


def unrouted_events(decoded: DataFrame) -> DataFrame:
    """Well-formed events without a stage table, kept aside with the reason if they give one."""
    other = decoded.where(F.col("type").isNotNull() & ~F.col("type").isin(*ROUTED_TYPES))
    return other.select("event_id", "type", F.get_json_object("data", "$.reason").alias("reason"), "data")


def dedupe_events(decoded: DataFrame) -> DataFrame:
    """One copy per event id; copies are combined on the map side. The id follows from type and data, so
    that it is made again behind the shuffle instead of going through it."""
    return with_event_id(decoded.select("type", "data").distinct())


def event_month(data: Column) -> Column:
    """Year * 100 + month of the event time in a payload; 0 where it has none. Copies have the same month."""
    moment = F.get_json_object(data, "$.event_time").try_cast("timestamp_ntz")
    return F.coalesce(F.year(moment) * 100 + F.month(moment), F.lit(0)).cast("int")


def iso_text(column: Column, data_type: T.DataType) -> Column:
    """ISO-8601 text; six digits of microseconds where there are any. No time zone enters."""
    text = F.translate(column.cast("string"), " ", "T")
    if isinstance(data_type, T.DateType):
        return text
    return F.when(F.length(text) > 19, F.rpad(text, 26, "0")).otherwise(text)


def encode_event(rows: DataFrame, event_type: str) -> DataFrame:
    """Typed rows -> message text in `value`: {"type", "data"}, ISO dates, UUIDs as plain hex."""
    declared = T.StructType.fromDDL(EVENT_FIELDS[event_type])
    data = [iso_text(F.col("event_time"), T.TimestampNTZType()).alias("event_time")]
    for field in declared:
        column = (F.col(field.name) if field.name in rows.columns else F.lit(None)).cast(field.dataType)
        if isinstance(field.dataType, T.DateType):
            column = iso_text(column, field.dataType)
        elif field.name in ID_FIELDS:
            column = F.translate(column, "-", "")
        data.append(column.alias(field.name))
    envelope = F.struct(F.lit(event_type).alias("type"), F.struct(*data).alias("data"))
    return rows.select(F.to_json(envelope, {"ignoreNullFields": "false"}).alias("value"))


def resolve_event_time(requests: DataFrame, override: str, now: str) -> DataFrame:
    """Time of a request: the one it carries, else the time it came in."""
    return requests.withColumn("event_time", F.coalesce(override, now))


def missing_fields(requests: DataFrame, json_column: str, required: list[str]) -> DataFrame:
    """Required keys a JSON request lacks; a key that is present with null is not missing."""
    keys = F.coalesce(F.json_object_keys(json_column), F.array().cast("array<string>"))
    wanted = F.array(*[F.lit(r) for r in required])
    return requests.withColumn("missing", F.array_except(wanted, keys))
