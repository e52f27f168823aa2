"""Evaluation against the injected-spam label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EPS = 1e-9


def confusion(df: DataFrame, label: str = "source_spam_label", score: str = "risk_score",
              threshold: float | None = 0.55, pred: str | None = None) -> DataFrame:
    """tn, fp, fn, tp in one aggregate; prediction = score >= threshold, or
    the given prediction column."""
    p = F.col(pred).cast("int") if pred else (F.col(score) >= threshold).cast("int")
    a = F.coalesce(F.col(label), F.lit(0)).cast("int")
    return df.agg(F.count_if((p == 0) & (a == 0)).alias("tn"), F.count_if((p == 1) & (a == 0)).alias("fp"),
                  F.count_if((p == 0) & (a == 1)).alias("fn"), F.count_if((p == 1) & (a == 1)).alias("tp"))


def prf(conf: DataFrame) -> DataFrame:
    """Precision, recall, F1 with 1e-9 in every denominator."""
    p = F.col("tp") / (F.col("tp") + F.col("fp") + EPS)
    r = F.col("tp") / (F.col("tp") + F.col("fn") + EPS)
    return conf.select("tn", "fp", "fn", "tp", p.alias("precision"), r.alias("recall")).withColumn(
        "f1", 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall") + EPS))


def class_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Per class precision / recall / F1 / support, then accuracy, macro and
    weighted averages (0 where a denominator is 0), as rows."""
    pairs = df.groupBy(F.col(label).cast("int").alias("y"), F.col(pred).cast("int").alias("p")).agg(
        F.count(F.lit(1)).alias("n"))
    # each (label, prediction) cell counts once for its true class and once
    # for its predicted class
    t = pairs.select(F.explode(F.array(
        F.struct(F.col("y").alias("c"), F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0).alias("tp"),
                 F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted")),
        F.struct(F.col("p").alias("c"), F.lit(0).cast("long").alias("tp"), F.lit(0).cast("long").alias("support"),
                 F.col("n").alias("predicted")))).alias("r")).select("r.*").groupBy("c").agg(
        F.sum("tp").alias("tp"), F.sum("support").alias("support"), F.sum("predicted").alias("predicted"))
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(0.0)
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    per = t.select(F.col("c").cast("string").alias("class"), prec.alias("precision"), rec.alias("recall"),
                   "support", "tp")
    per = per.withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0,
                                      2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")))
                         .otherwise(0.0))
    tot = per.agg(F.sum("support").alias("n"), F.sum("tp").alias("tp"), F.avg("precision").alias("mp"),
                  F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
                  F.sum(F.col("precision") * F.col("support")).alias("wp"),
                  F.sum(F.col("recall") * F.col("support")).alias("wr"),
                  F.sum(F.col("f1") * F.col("support")).alias("wf"))
    acc = tot.select(F.lit("accuracy").alias("class"), F.lit(None).cast("double").alias("precision"),
                     F.lit(None).cast("double").alias("recall"), (F.col("tp") / F.col("n")).alias("f1"),
                     F.col("n").alias("support"))
    macro = tot.select(F.lit("macro avg").alias("class"), F.col("mp").alias("precision"),
                       F.col("mr").alias("recall"), F.col("mf").alias("f1"), F.col("n").alias("support"))
    weighted = tot.select(F.lit("weighted avg").alias("class"), (F.col("wp") / F.col("n")).alias("precision"),
                          (F.col("wr") / F.col("n")).alias("recall"), (F.col("wf") / F.col("n")).alias("f1"),
                          F.col("n").alias("support"))
    return per.select("class", "precision", "recall", "f1", "support").unionByName(acc).unionByName(
        macro).unionByName(weighted)


def freq(df: DataFrame, col: str) -> DataFrame:
    """Value counts including missing."""
    return df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("count"))
