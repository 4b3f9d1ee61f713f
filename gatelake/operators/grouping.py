"""Skew-safe grouping helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 64


def attach_group_count(df: DataFrame, key: str, out: str, spread: list[str], salts: int = SALTS) -> DataFrame:
    """Add the size of each row's ``key`` group without putting a group into one task.

    Rows get a salt from ``spread`` (columns that tell rows of a group apart),
    counts are built per (key, salt) with map-side combine, summed per key, and
    handed back to each (key, salt) bucket. A key that holds a third of all
    rows is spread over ``salts`` join buckets, and has at most ``salts`` rows
    on the count side. The salt depends on row contents only, so both
    evaluations of ``df`` agree.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))
    per_salt = salted.groupBy(key, "_salt").agg(F.count(F.lit(1)).alias("_n"))
    totals = (
        per_salt.groupBy(key)
        .agg(F.sum("_n").alias(out), F.collect_list("_salt").alias("_salts"))
        .select(key, out, F.explode("_salts").alias("_salt"))
    )
    return salted.join(totals, [key, "_salt"]).drop("_salt")


def duplicated(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
