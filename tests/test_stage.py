import json
from datetime import date, datetime

from pyspark.sql import functions as F

from tonearm.operators import stage as ops
from tonearm.schemas import EVENT_FIELDS, STAGE_TABLES
from tonearm.sources.events import publish_events

T1 = datetime(1996, 1, 1, 10, 20, 30, 450000)


def decoded(spark, *messages):
    return ops.decode_envelope(spark.createDataFrame([(m,) for m in messages], "value string"))


def message(kind, **data):
    return json.dumps({"type": kind, "data": data})


def test_binary_messages(spark):
    df = spark.createDataFrame([(bytearray(message("CountryEnabled", country_code="ä1").encode()),)], "value binary")
    row = ops.decode_envelope(df).first()
    assert row.type == "CountryEnabled" and json.loads(row.data)["country_code"] == "ä1"


def test_unknown_and_missing_keys(spark):
    events = decoded(
        spark,
        message("ArtistCreated", event_time="1996-01-01T00:00:00", id="a", name="n", genre_id="g", other=1),
        message("ArtistCreated", event_time="1996-01-01T00:00:00", name="n"),
        message("Other", event_time="1996-01-01T00:00:00"),
        "{broken",
    )
    rows = ops.stage_rows(events, "kafka_artist").collect()
    assert [(r.id, r.name, r.founded_year, r.country_code) for r in rows] == [("a", "n", None, None)]
    bad = {(r.type, r.stage_table): r.missing for r in ops.quarantined_events(events).collect()}
    assert bad == {("ArtistCreated", "kafka_artist"): ["id"], (None, None): ["type"]}
    assert [r.type for r in ops.unrouted_events(events).collect()] == ["Other"]


def test_quarantine_equals_the_split_per_table(spark):
    messages = [message(t, event_time="1996-01-01T00:00:00") for t in EVENT_FIELDS] + [message("SongPlayEvent")]
    events = decoded(spark, *messages)
    split = [
        (r.type, tuple(r.missing))
        for table in STAGE_TABLES.values()
        for r in ops.enforce_required(ops.project_payload(events, table), table)[1].collect()
    ]
    assert sorted(split) == sorted((r.type, tuple(r.missing)) for r in ops.quarantined_events(events).collect())


def test_encode_then_decode(spark):
    schema = EVENT_FIELDS["SignUpEvent"] + ", event_type string, event_time timestamp_ntz"
    row = ("ab-cd", "e@x", "01", "A", 'B"q', date(2000, 2, 3), "SignUpEvent", T1)
    value = ops.encode_event(spark.createDataFrame([row], schema), "SignUpEvent").first().value
    data = json.loads(value)["data"]
    assert data["user_id"] == "abcd" and data["birth_date"] == "2000-02-03"
    assert data["event_time"] == "1996-01-01T10:20:30.450000"
    back = ops.stage_rows(decoded(spark, value), "kafka_user_history").drop("event_id").first()
    assert tuple(back) == ("abcd", *row[1:])


def test_null_stays_in_the_message(spark):
    rows = spark.createDataFrame([(None, T1)], "country_code string, event_time timestamp_ntz")
    assert json.loads(ops.encode_event(rows, "CountryEnabled").first().value)["data"]["country_code"] is None


def test_missing_fields(spark):
    df = spark.createDataFrame([('{"a": null}',), ("{}",), ("broken",), (None,)], "body string")
    rows = ops.missing_fields(df, "body", ["a", "b"]).collect()
    assert [r.missing for r in rows] == [["b"], ["a", "b"], ["a", "b"], ["a", "b"]]


def test_event_time_override(spark):
    df = spark.createDataFrame([(T1, datetime(2000, 1, 1)), (None, datetime(2000, 1, 1))], "o timestamp_ntz, n timestamp_ntz")
    assert [r.event_time for r in ops.resolve_event_time(df, "o", "n").collect()] == [T1, datetime(2000, 1, 1)]


def test_failed_publish_is_not_raised(spark):
    assert publish_events(spark.range(1).select(F.lit("x").alias("value")), folder="nosuchfs://x/y") is False
