"""NaN, infinite and huge numbers become null; they never abort a query."""

from reviewguard.functions.labels import num
from reviewguard.operators.graph import review_graph
from reviewguard.operators.ingest import epoch_to_ts

NAN = float("nan")


def test_num_and_epoch(spark):
    df = spark.createDataFrame([("nan",), ("inf",), ("-Infinity",), ("1e30",), ("1600000000",), ("x",), (None,)], "t string")
    assert [r[0] for r in df.select(num("t")).collect()] == [None, None, None, 1e30, 1.6e9, None, None]
    got = df.where("t <> '1e30'").select(epoch_to_ts(df.where("t <> '1e30'"), "t").alias("ts")).collect()
    assert sum(r.ts is not None for r in got) == 1
    assert df.select(epoch_to_ts(df, "t", "s").alias("ts")).where("ts is not null").count() == 1


def test_review_graph_with_nan(spark):
    df = spark.createDataFrame([("r1", "u", "p", NAN, "t", "2020", NAN, "s"), ("r2", "u", "p", 4.0, "t", "2020", 1.0, "s")],
                               "review_id string, user_id string, product_id string, rating double, review_text string, timestamp string, label double, source string")
    for part in review_graph(df).values() if isinstance(review_graph(df), dict) else review_graph(df):
        part.collect()
