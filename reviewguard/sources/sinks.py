"""Sinks (A9-A11, A16, A17). Writes are partition-parallel; nothing is
funnelled through the driver in chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.wire import to_wire_json


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    """Single-table export (parquet by default; csv with header; json lines)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    elif fmt == "json":
        w.json(path)
    else:
        w.format(fmt).save(path)


def arrays_to_text(df: DataFrame, sep: str = ",") -> DataFrame:
    """Array columns -> sorted delimited text (stable across runs)."""
    out = df
    for f in df.schema.fields:
        if f.dataType.typeName() == "array":
            out = out.withColumn(f"{f.name}_str", F.array_join(F.array_sort(F.col(f.name)), sep)).drop(f.name)
    return out


def write_feature_batch(batch_df: DataFrame, batch_id: int, root: str, fmt: str = "parquet") -> None:
    """One folder per micro-batch, overwritten on replay (idempotent)."""
    write_table(arrays_to_text(batch_df), f"{root}/batch_id={batch_id}", fmt)


def to_wire(df: DataFrame, fmt: str = "text", path: str | None = None, **options) -> None:
    """Publish reviews as JSON messages: ``kafka`` (needs the connector;
    options such as ``kafka.bootstrap.servers`` and ``topic``) or a text
    file sink with one JSON object per line."""
    msgs = to_wire_json(df)
    if fmt == "kafka":
        msgs.selectExpr("CAST(key AS STRING) AS key", "value").write.format("kafka").options(**options).save()
    else:
        msgs.select("value").write.mode("overwrite").text(path)
