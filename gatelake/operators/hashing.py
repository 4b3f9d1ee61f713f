"""Duplicate-module reports over the module-hash table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatelake.operators.grouping import attach_group_count
from gatelake.session import materialize


def hash_report(hashes: DataFrame, *, write_once: bool = True) -> DataFrame:
    """Every module occurrence with the size of its duplicate group (``unique_count``).

    ``hashes`` is ``module_hashes(files, position=True)``.

    The hash table is written once and read for both the counts and the
    join-back, so the source text is parsed a single time.
    """
    table = materialize(hashes, "module_hashes") if write_once else hashes
    return attach_group_count(
        table, "module_hash", "unique_count", spread=["design_name", "file_name", "pos"]
    ).select(
        "module_hash", "module_name", "design_name", "dataset_name", "unique_count"
    )


def sorted_listing(report: DataFrame) -> DataFrame:
    """Five-key descending listing, a range-partitioned sort."""
    return report.orderBy(
        *[F.col(c).desc() for c in ("unique_count", "module_hash", "module_name", "design_name", "dataset_name")]
    )


def hash_counts(hashes: DataFrame) -> DataFrame:
    """Occurrences per module hash."""
    return hashes.groupBy("module_hash").agg(F.count(F.lit(1)).alias("unique_count"))


def hash_totals(hashes: DataFrame, *, approximate: bool = False) -> DataFrame:
    """Total occurrences, distinct hashes and distinct designs in one row."""
    distinct = F.approx_count_distinct if approximate else F.countDistinct
    return hashes.agg(
        F.count(F.lit(1)).alias("n_modules"),
        distinct("module_hash").alias("n_hashes"),
        distinct("design_name").alias("n_designs"),
    )
