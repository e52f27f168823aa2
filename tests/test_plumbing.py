import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from reviewguard.operators import graph as G
from reviewguard.operators import windows as W
from reviewguard.plans.q_windows import DAY, events_stream
from reviewguard.streaming.pipeline import await_any, events_source, start_console


def test_graph_store_roundtrip(spark):
    g = G.window_graph(W.user_windows(events_stream(spark, SF_SMALL), DAY))
    root = tempfile.mkdtemp(prefix="rg-graph-")
    G.save_graph(g, root)
    back = G.load_graph(spark, root)
    a = G.user_features(g["review_windows"], g["targeted_product"]).orderBy("user_id").collect()
    b = G.user_features(back["review_windows"], back["targeted_product"]).orderBy("user_id").collect()
    assert a == b and len(a) > 0


def test_console_sink_and_await_any(spark, capsys):
    agg = (events_source(spark, SF_SMALL).select(F.get_json_object("value", "$.source").alias("source"))
           .groupBy("source").count())
    q = start_console(agg, "console_preview", mode="complete", rows=5)
    q.processAllAvailable()
    q.stop()
    assert await_any(spark, 1) in (True, False, None)
    assert q.lastProgress is not None
