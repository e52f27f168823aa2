import random

from pyspark.sql import functions as F

from reviewguard.operators import anomaly as An


def test_forest_flags_contamination_share_and_planted_outliers(spark):
    rng = random.Random(1)
    rows = []
    for i in range(3000):
        base = [rng.gauss(5, 1) for _ in An.FEATURES]
        rows.append((f"u{i}", "2024-01-01 00:00:00", 1 if i % 10 == 0 else 0, *base))
    for j in range(15):  # planted outliers
        rows.append((f"o{j}", "2024-01-01 00:00:00", 1, *[rng.gauss(40, 1) for _ in An.FEATURES]))
    schema = "user_id string, window_start string, source_spam_label int, " + ", ".join(
        f"{c} double" for c in An.FEATURES)
    df = spark.createDataFrame(rows, schema)
    nodes = An.fit(df, ["user_id", "window_start"])
    assert nodes.select("tree").distinct().count() == An.N_TREES
    assert nodes.filter("node = 0").agg(F.max("size")).first()[0] <= An.MAX_SAMPLES
    out = An.score(df, nodes)
    share = out.agg(F.avg("predicted_suspicious")).first()[0]
    cont = An.contamination(df)
    assert abs(share - cont) < 0.02
    top = [r.user_id for r in An.top(out, 15).collect()]
    assert sum(u.startswith("o") for u in top) >= 14
