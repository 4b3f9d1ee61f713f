"""Data-quality checks of loaded designs and the error policy."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatelake.operators import graph, modules
from gatelake.operators.grouping import duplicated
from gatelake.session import materialize

D = "design_name"


class ViolationError(ValueError):
    """Raised by ``enforce`` in strict mode."""


def violations(designs: DataFrame, files: DataFrame) -> DataFrame:
    """``(design_name, check, detail)`` for every loaded design that breaks a rule.

    Checks: at least one module, no duplicate module name, each module in one
    file, and an acyclic hierarchy. Modules are extracted once; their bodies are not written.
    """
    mods = materialize(modules.module_heads(files), "checked_modules")  # names and heads only
    names = mods.select(D, "module_name").distinct()
    none = designs.select(D).join(names, D, "left_anti").select(
        D, F.lit("has_module").alias("check"), F.lit("no module found").alias("detail"))
    twice = duplicated(mods, D, "module_name").select(
        D, F.lit("duplicate_module").alias("check"), F.concat("module_name", F.lit(" x"), F.col("n").cast("string")).alias("detail"))
    spread = modules.locate_modules(mods, names).filter("status <> 'ok'").select(
        D, F.lit("one_file").alias("check"), F.concat("module_name", F.lit(" in "), F.col("n_files").cast("string"), F.lit(" files")).alias("detail"))
    cyclic = graph.is_dag(names, modules.instances_from_text(mods)).filter("NOT is_dag").select(
        D, F.lit("acyclic").alias("check"), F.concat(F.col("n_cyclic").cast("string"), F.lit(" modules on or behind a cycle")).alias("detail"))
    return reduce(DataFrame.unionByName, [none, twice, spread, cyclic])


def enforce(found: DataFrame, *, strict: bool = True, show: int = 10) -> DataFrame:
    """Raise with the first offenders when ``strict`` and any row exists; else pass the rows on."""
    if strict:
        first = found.take(show)
        if first:
            raise ViolationError("; ".join(str(r.asDict()) for r in first))
    return found


def split_status(df: DataFrame, status: str = "status") -> tuple[DataFrame, DataFrame]:
    """Rows whose status is ``ok`` and the others."""
    ok = F.col(status) == "ok"
    return df.filter(ok), df.filter(~F.coalesce(ok, F.lit(False)))
