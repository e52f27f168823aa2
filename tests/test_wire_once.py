"""Messages of the wire are parsed once, whatever is filtered behind the parse."""

from pyspark.sql import functions as F

from reviewguard.operators import windows as W
from reviewguard.operators.wire import parse_wire, stream_events
from reviewguard.schema import REVIEW_WIRE

MESSAGES = [
    (1, '{"review_id":"r1","user_id":"u1","product_id":"p1","rating":2.0,"timestamp":"2024-01-01 10:00:00.000","source":"amazon"}'),
    (2, '{"review_id":"r2","user_id":"u1","product_id":"p2","rating":5.0,"timestamp":"2024-01-01 10:00:00.000","label":1}'),
    (3, None), (4, ""), (5, "no json"), (6, "null"), (7, "[]"), (8, "{}"), (9, '{"review_id":"r9","rating":"x"}'),
    (10, '[{"review_id":"a"},{"review_id":"b"}]'), (11, '{"review_id":"r11"'), (12, '{"user_id":7,"timestamp":null}'),
    (1, '{"review_id":"r1","user_id":"u1","product_id":"p1","rating":2.0,"timestamp":"2024-01-01 10:00:00.000","source":"amazon"}'),
]


def test_messages_are_parsed_once(spark):
    wire = spark.createDataFrame(MESSAGES, "n int, value string")
    rows = W.user_windows(stream_events(wire), W.WindowParams(duration="1 day"))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
    assert [(r.user_id, r.low_rating_reviews_by_user_5m) for r in rows.collect()] == [("u1", 2)]


def test_every_message_gives_the_row_of_its_struct(spark):
    wire = spark.createDataFrame(MESSAGES, "n int, value string")
    for df in (wire, wire.withColumn("value", F.col("value").cast("binary"))):
        js = F.col("value").cast("string")
        plain = df.select(js.alias("json_string"), F.from_json(js, REVIEW_WIRE).alias("data")).select("json_string", "data.*")
        got = parse_wire(df, keep_raw=True)
        assert got.columns == plain.columns and [f.dataType for f in got.schema] == [f.dataType for f in plain.schema]
        assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))
        assert parse_wire(df).columns == plain.columns[1:] and parse_wire(df).count() == len(MESSAGES)
