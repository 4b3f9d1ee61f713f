"""Bipartite cell/signal graphs from connectivity rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatelake import schemas

D = "design_name"

# --- fixed values: port directions ---
INTO_CELL = ["in", "pi"]
OUT_OF_CELL = ["out", "po"]
BOTH_WAYS = ["inout", "pio"]
KNOWN = INTO_CELL + OUT_OF_CELL + BOTH_WAYS


def scan_connectivity(spark: SparkSession, path: str, design: str = r"^(?:.*[/=])?([^/=]+)/[^/]*$") -> DataFrame:
    """Headerless six-column TSV files as rows of their designs, ready for the graph.

    ``design`` is a pattern whose first group takes the design from the file's
    path (by default its folder, without a ``name=``). ``row_idx`` rises with the
    row's place in its file: the start of the split it was read from plus its
    number within the task, which is below the length of a split.
    """
    place = F.col("_metadata.file_block_start") + F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return (
        spark.read.schema(schemas.CONNECTIVITY).option("sep", "\t").option("quote", "").csv(path)
        .select(F.regexp_extract(F.col("_metadata.file_path"), design, 1).alias(D), place.alias("row_idx"), *[f.name for f in schemas.CONNECTIVITY])
    )


def parse_rows(lines: DataFrame) -> DataFrame:
    """``line`` column holding one TSV row each → six columns plus the other columns."""
    parts = F.split("line", "\t")
    names = [f.name for f in schemas.CONNECTIVITY]
    others = [c for c in lines.columns if c != "line"]
    return lines.select(*others, *[F.get(parts, i).alias(n) for i, n in enumerate(names)])


def connectivity_nodes(rows: DataFrame) -> DataFrame:
    """One node per name. A name that is both cell and signal is a signal that keeps its cell attributes.

    The last row (``row_idx``) decides the cell attributes. Rows are read once. Equal
    ones become one by a hash with map-side combine (numbers only besides the keys), so a
    signal with very many pins is reduced before the shuffle and nothing is sorted but what is left.
    """
    attrs = F.struct("cell_type", "module_name")
    item = lambda node, signal, attrs, at: F.struct(
        F.col(node).alias("node"), F.lit(signal).alias("is_signal"), attrs.alias("attrs"), at.alias("at"))
    none = F.lit(None).cast("struct<cell_type:string,module_name:string>")
    items = rows.select(D, F.inline(F.array(
        item("cell_name", False, attrs, F.col("row_idx")), item("signal", True, none, F.lit(None).cast("long")))))
    merged = items.groupBy(D, "node", "is_signal", "attrs").agg(F.max("at").alias("at")).groupBy(D, "node").agg(
        F.bool_or("is_signal").alias("is_signal"), F.max_by("attrs", "at").alias("attrs"))
    return merged.select(
        D, "node", F.when(F.col("is_signal"), "signal").otherwise("cell").alias("node_type"),
        F.col("attrs.cell_type").alias("cell_type"), F.col("attrs.module_name").alias("module_name"))


def connectivity_edges(rows: DataFrame) -> DataFrame:
    """Directed edges with their port and direction; the last row wins per (source, target). Equal ones are combined first."""
    def edge(src, dst):
        return F.struct(F.col(src).alias("source"), F.col(dst).alias("target"))

    d = F.col("direction")
    into, out = edge("signal", "cell_name"), edge("cell_name", "signal")
    ends = F.when(d.isin(INTO_CELL), F.array(into)).when(d.isin(OUT_OF_CELL), F.array(out)).when(
        d.isin(BOTH_WAYS), F.array(into, out))
    return (
        rows.select(D, "row_idx", "cell_port", "direction", F.explode(ends).alias("e"))
        .groupBy(D, "e.source", "e.target", "cell_port", "direction").agg(F.max("row_idx").alias("row_idx"))
        .groupBy(D, "source", "target").agg(F.max_by(F.struct("cell_port", "direction"), "row_idx").alias("a"))
        .select(D, "source", "target", "a.cell_port", "a.direction")
    )


def unknown_directions(rows: DataFrame) -> DataFrame:
    """Rows that make a graph invalid."""
    return rows.filter(~F.coalesce(F.col("direction").isin(KNOWN), F.lit(False))).select(
        D, "row_idx", F.concat(F.lit("unknown direction: "), F.coalesce("direction", F.lit("NULL"))).alias("detail"))
