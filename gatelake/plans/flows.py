"""Named, tagged computations per design, over all designs in one job."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatelake.functions import text as X
from gatelake.operators import modules, rtlil

D = "design_name"


@dataclass(frozen=True)
class Flow:
    """``compute(inputs)`` returns one row per design: ``design_name`` and metric columns."""

    name: str
    tags: tuple[str, ...]
    compute: Callable[[DataFrame], DataFrame]


def per_file_flow(
    name: str, tags: tuple[str, ...], fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str, reduce: dict[str, Column]
) -> Flow:
    """A flow from a user function over batches of files plus a reduction per design.

    ``fn`` sees Arrow batches of any files (``design_name, file_name, text``)
    and returns rows of ``schema``; ``reduce`` maps metric names to aggregates
    over those rows. The reduction combines on the map side, so a design with
    very many files never has to fit into one task.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield fn(pdf)

    def compute(files: DataFrame) -> DataFrame:
        mapped = files.select(D, "file_name", "text").mapInPandas(run, schema)
        return mapped.groupBy(D).agg(*[c.alias(n) for n, c in reduce.items()])

    return Flow(name, tags, compute)


def run_flow(flow: Flow, inputs: DataFrame) -> DataFrame:
    """``flow_runs`` rows: ``(design_name, flow_name, flow_tags, metrics MAP<STRING,STRING>)``."""
    out = flow.compute(inputs)
    pairs = [x for c in out.columns if c != D for x in (F.lit(c), F.col(c).cast("string"))]
    return out.select(
        D, F.lit(flow.name).alias("flow_name"), F.array(*[F.lit(t) for t in flow.tags]).alias("flow_tags"),
        F.create_map(*pairs).alias("metrics"))


def replace_runs(runs: DataFrame, new: DataFrame) -> DataFrame:
    """Re-running a flow replaces its earlier rows for the same designs."""
    return runs.join(new.select(D, "flow_name"), [D, "flow_name"], "left_anti").unionByName(new)


# ------------------------------------------------------------------ built-in flows
LINE_COUNT = Flow(
    "line_count", ("text",),
    lambda files: files.groupBy(D).agg(F.sum(X.line_count(F.col("text"))).alias("num_lines")))

MODULE_COUNT = Flow(
    "module_count", ("text",),
    lambda files: files.select(D).distinct().join(
        modules.extract_modules(files.filter("role = 'verilog'") if "role" in files.columns else files)
        .select(D, "module_name").distinct().groupBy(D).agg(F.count(F.lit(1)).alias("n")), D, "left",
    ).select(D, F.coalesce("n", F.lit(0)).alias("num_modules")))

CLOCK_DETECT = Flow(
    "clock_detect", ("hdl", "netlist", "clock"),
    lambda texts: texts.select(D).join(
        rtlil.clock_candidates(texts).groupBy(D).agg(F.count(F.lit(1)).alias("n"), F.min("candidate").alias("first")), D, "left",
    ).select(D, F.coalesce("n", F.lit(0)).alias("num_candidates"), F.col("first").alias("first_candidate")))

FLOWS = {f.name: f for f in (LINE_COUNT, MODULE_COUNT, CLOCK_DETECT)}
