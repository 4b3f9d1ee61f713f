"""Sinks: CSV, JSON, text, Parquet and node-link graph documents."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatelake.session import settings, shared_dir


def _target(df: DataFrame, name: str) -> str:
    """A path as given, or a new folder below the shared folder for a bare name."""
    if "/" in name:
        return name
    return f"{shared_dir(df.sparkSession)}/gatelake/{name}-{uuid.uuid4().hex}"


def _writer(df: DataFrame, partition_by: str | None, compression: str | None = None):
    writer = df.write.option("compression", compression) if compression else df.write
    return writer.partitionBy(partition_by) if partition_by else writer


def _unsorted(df: DataFrame):
    """Rows of few partition values go straight to open files, without a sort of the text."""
    return settings(df.sparkSession, spark_sql_maxConcurrentOutputFileWriters="16")


def write_csv(df: DataFrame, name: str, *, partition_by: str | None = None, header: bool = True, compression: str | None = None) -> str:
    """CSV with quotes doubled inside fields and blanks kept, as common readers expect."""
    path = _target(df, name)
    with _unsorted(df):
        (
            _writer(df, partition_by, compression)
            .options(header=header, escape='"', quoteAll=True)
            .options(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
            .csv(path)
        )
    return path


def write_json(df: DataFrame, name: str, *, partition_by: str | None = None, compression: str | None = None) -> str:
    path = _target(df, name)
    with _unsorted(df):
        _writer(df, partition_by, compression).json(path)
    return path


def write_text(df: DataFrame, name: str, column: str = "text") -> str:
    path = _target(df, name)
    df.select(F.col(column).cast("string").alias("value")).write.text(path)
    return path


def write_parquet(df: DataFrame, name: str, *, partition_by: str | None = "dataset_name") -> str:
    path = _target(df, name)
    with _unsorted(df):
        _writer(df, partition_by).parquet(path)
    return path


def graph_records(nodes: DataFrame, edges: DataFrame, key: str = "design_name") -> DataFrame:
    """Node-link JSON, one record per item: ``(key, kind, json)`` with ``kind`` ``node`` or ``edge``.

    ``nodes(key, id, …)`` and ``edges(key, source, target, …)``. The form does not
    depend on the size of a graph, and no graph is collected in one place: written
    with ``write_json(…, partition_by=key)`` or ``write_text`` it is a line-wise
    directed graph, of which every line is an item with all its attributes.
    """
    def items(df: DataFrame, kind: str) -> DataFrame:
        return df.select(key, F.lit(kind).alias("kind"), F.to_json(F.struct(*[c for c in df.columns if c != key])).alias("json"))

    return items(nodes, "node").unionByName(items(edges, "edge"))
