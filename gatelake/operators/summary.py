"""Corpus summaries, rank and histogram series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gatelake.functions import text as X
from gatelake.session import checkpoint, materialize


def dataset_summary(designs: DataFrame) -> DataFrame:
    """Design count per source and in total (``dataset_name`` NULL)."""
    return designs.rollup("dataset_name").agg(F.count(F.lit(1)).alias("n_designs"))


def designs_per_source(files: DataFrame) -> DataFrame:
    """Distinct designs per source, largest first, and the grand total (NULL source)."""
    return (
        files.select("dataset_name", "design_name").distinct()
        .rollup("dataset_name").agg(F.count(F.lit(1)).alias("num_designs"))
        .orderBy(F.col("num_designs").desc(), "dataset_name")
    )


def file_sizes(files: DataFrame) -> DataFrame:
    """Per-file metrics in one pass over the text."""
    t = F.col("text")
    return files.select(
        "dataset_name", "design_name", "file_name",
        X.non_whitespace_chars(t).alias("num_chars"),
        X.count_modules(t).alias("num_modules"),
        X.non_blank_lines(t).alias("num_lines"),
        X.byte_size(t).alias("num_bytes"),
    )


def sizes_by(sizes: DataFrame, *keys: str) -> DataFrame:
    return sizes.groupBy(*keys).agg(
        F.sum("num_chars").alias("num_chars"), F.sum("num_modules").alias("num_modules"))


def size_report(sizes: DataFrame) -> DataFrame:
    """Sums per design, per source and overall from one scan (``level`` tells them apart)."""
    sets = sizes.groupingSets([["design_name"], ["dataset_name"], []], "design_name", "dataset_name")
    return sets.agg(
        F.grouping_id().alias("_g"),
        F.sum("num_chars").alias("num_chars"),
        F.sum("num_modules").alias("num_modules"),
    ).select(
        F.when(F.col("_g") == 1, "design").when(F.col("_g") == 2, "dataset").otherwise("total").alias("level"),
        F.coalesce("design_name", "dataset_name").alias("name"),
        "num_chars", "num_modules",
    )


def corpus_totals(files: DataFrame) -> DataFrame:
    """Non-blank lines, bytes, modules, files and designs of the whole corpus."""
    return file_sizes(files).agg(
        F.sum("num_lines").alias("total_lines"),
        F.sum("num_bytes").alias("total_bytes"),
        F.sum("num_modules").alias("total_modules"),
        F.count(F.lit(1)).alias("n_files"),
        F.countDistinct("design_name").alias("n_designs"),
    )


def expansion_factor(sub_design_counts: DataFrame, *by: str) -> DataFrame:
    """Σ sub-designs / #designs over ``(design_name, num_sub_designs)`` rows, per ``by`` (over all rows without)."""
    return sub_design_counts.groupBy(*by).agg(
        F.count(F.lit(1)).alias("original_designs"),
        F.sum("num_sub_designs").alias("sub_designs"),
        (F.sum("num_sub_designs") / F.count(F.lit(1))).alias("expansion_factor"),
    )


def rank_series(df: DataFrame, value: str, key: str) -> DataFrame:
    """Ascending rank (0-based, ties broken by ``key``) without a single-partition window.

    A range-partitioned sort numbers rows inside each partition; partition
    sizes (one row per partition) are accumulated and added. The sort is
    checkpointed, so both steps see the same partitions.
    """
    ordered = checkpoint(
        df.select(key, value).orderBy(value, key).withColumn("_id", F.monotonically_increasing_id())
    )
    part = F.shiftright("_id", 33)
    sizes = ordered.groupBy(part.alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    before = W.orderBy("_p").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    # bounded: one row per sort partition
    return (
        ordered.withColumn("_p", part)
        .join(F.broadcast(offsets), "_p")
        .select(key, value, (F.col("_off") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))).alias("idx"))
    )


def log_histogram(df: DataFrame, value: str, bins: int = 100) -> DataFrame:
    """Counts in ``bins`` log-spaced bins between the smallest and largest positive value.

    Zeros have a bin of their own (``bin = -1``). The data is read once, into its
    distinct values and how often each occurs; bounds and bins come from those.
    """
    values = materialize(df.groupBy(F.col(value).alias("v")).agg(F.count(F.lit(1)).alias("n")), "values")
    positive = values.filter("v > 0")
    lo = positive.select(F.ln(F.min("v"))).scalar()
    hi = positive.select(F.ln(F.max("v"))).scalar()
    width = hi - lo
    raw = F.when(width == 0, F.lit(0)).otherwise(F.floor((F.ln("v") - lo) * bins / width + F.lit(1e-9)))
    binned = F.when(F.col("v") <= 0, F.lit(-1)).otherwise(F.least(raw, F.lit(bins - 1)))
    return values.groupBy(binned.cast("int").alias("bin")).agg(F.sum("n").alias("n"))


def bar_series(df: DataFrame, category: str, value: str | Column) -> DataFrame:
    """Category sums in ascending order."""
    return df.groupBy(category).agg(F.sum(value).alias("total")).orderBy("total", category)


def module_count(modules: DataFrame) -> DataFrame:
    return modules.select("design_name", "module_name").distinct().groupBy("design_name").agg(
        F.count(F.lit(1)).alias("num_modules"))


def top_one(df: DataFrame, group: str, name: str, score: str) -> DataFrame:
    """Best-scoring row per group; a tie at the top is reported, not resolved.

    One aggregation with map-side combine: the maximum, how many rows reach
    it, and one name.
    """
    best = df.groupBy(group, score).agg(F.count(F.lit(1)).alias("_n"), F.min(name).alias("_name"))
    top = best.groupBy(group).agg(F.max(F.struct(score, "_n", "_name")).alias("_t"))
    tie = F.col("_t._n") > 1
    return top.select(
        group,
        F.when(~tie, F.col("_t._name")).alias(name),
        F.col(f"_t.{score}").alias(score),
        F.when(tie, "tie").otherwise("ok").alias("status"),
    )
