"""Step 7: isolation forest over the merged features (rows-only checks;
property tests in tests/test_anomaly.py)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import anomaly as An
from ..operators import features as Fe
from ..session import checkpoint
from .q_risk import merged
from .registry import query


def anomaly_results(spark, sf_dir):
    m = checkpoint(Fe.require(merged(spark, sf_dir), An.FEATURES + ["source_spam_label"]))
    nodes = An.fit(m, ["user_id", "window_start"])
    return An.score(m, nodes)


@query("anomaly_scores")
def q_anomaly_scores(spark, sf_dir):
    return anomaly_results(spark, sf_dir).select(
        "user_id", "window_start", "window_end", "source_spam_label", "predicted_suspicious", "anomaly_score")


@query("anomaly_top20")
def q_anomaly_top20(spark, sf_dir):
    return An.top(anomaly_results(spark, sf_dir), 20).select(
        "user_id", "window_start", "window_end", "source_spam_label", "predicted_suspicious", "anomaly_score",
        *An.FEATURES)


@query("anomaly_report")
def q_anomaly_report(spark, sf_dir):
    from ..operators import metrics as M
    r = anomaly_results(spark, sf_dir)
    return M.class_report(r, "source_spam_label", "predicted_suspicious").withColumn(
        "f1", F.round("f1", 6))
