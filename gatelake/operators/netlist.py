"""Netlist JSON and statistics JSON as rows; instance edges from cells."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatelake import schemas
from gatelake.session import materialize

D = "design_name"


def netlist_modules(netlists: DataFrame) -> DataFrame:
    """``(design_name, module, hdlname, cells)`` from ``netlists(design_name, json)``. Narrow."""
    parsed = netlists.select(D, F.from_json("json", schemas.NETLIST_JSON).alias("j"))
    return parsed.select(D, F.explode("j.modules").alias("module", "m")).select(
        D, "module", F.col("m.attributes")["hdlname"].alias("hdlname"), F.col("m.cells").alias("cells")
    )


def netlist_cells(netlists: DataFrame) -> DataFrame:
    """``(design_name, module, cell, type)``; map side only."""
    return netlist_modules(netlists).select(D, "module", F.explode("cells").alias("cell", "c")).select(
        D, "module", "cell", F.col("c.type").alias("type"))


def hdl_names(modules: DataFrame) -> DataFrame:
    """Parametrised modules take their source name; others keep their own."""
    return modules.withColumn("base", F.coalesce("hdlname", "module"))


def module_cells(cells: DataFrame, modules: DataFrame) -> DataFrame:
    """Cells whose type is a module of the same netlist."""
    defined = modules.select(D, F.col("module").alias("type"))
    return cells.join(defined, [D, "type"], "left_semi")


def netlist_instances(netlists: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``modules(design_name, module_name)`` and distinct ``inst(design_name, parent, child)``.

    The JSON is parsed once into a thin written table (module, source name,
    distinct cell types). Keeping only cells that are modules and mapping
    parametrised types to their source name is one join on (design, module).
    """
    types = F.array_distinct(F.transform(F.map_values("cells"), lambda c: c["type"]))
    table = materialize(
        hdl_names(netlist_modules(netlists)).select(D, "module", "base", types.alias("types")), "netlist_modules")
    modules = table.select(D, F.col("base").alias("module_name")).distinct()
    defined = table.select(D, F.col("module").alias("type"), F.col("base").alias("child"))
    inst = (
        table.select(D, F.col("base").alias("parent"), F.explode("types").alias("type"))
        .join(defined, [D, "type"]).select(D, "parent", "child").distinct()
    )
    return modules, inst


def empty_netlists(netlists: DataFrame) -> DataFrame:
    """Designs whose netlist has no module, or is not readable: an error for every consumer."""
    parsed = netlists.select(D, F.from_json("json", schemas.NETLIST_JSON).alias("j"))
    return parsed.filter(F.coalesce(F.size("j.modules"), F.lit(0)) <= 0).select(D, F.lit("no_modules").alias("status"))


def structured_parts(netlists: DataFrame, closed: DataFrame) -> DataFrame:
    """Sub-designs as cell lists: ``(design_name, root, module_name, cell, type)`` per root.

    ``closed`` is the closure over ``netlist_instances``; the cells of every
    module below a root belong to its sub-design.
    """
    modules = hdl_names(netlist_modules(netlists))
    cells = modules.select(D, F.col("base").alias("node"), F.explode_outer("cells").alias("cell", "c")).select(
        D, "node", "cell", F.col("c.type").alias("type"))
    return closed.select(D, "root", "node").join(cells, [D, "node"]).select(
        D, "root", F.col("node").alias("module_name"), "cell", "type")


_PARTS = {"\\": "\\\\", ".": "\\."}


def _leaves(value: object, path: str = ""):
    """``(path, value)`` of every leaf, depth first; empty objects and arrays are leaves."""
    stack = [(path, value)]
    while stack:
        at, v = stack.pop()
        pairs = v.pairs if isinstance(v, _Object) else list(enumerate(v)) if isinstance(v, list) else []
        if pairs:
            for k, x in reversed(pairs):
                part = str(k).translate(str.maketrans(_PARTS))
                stack.append((f"{at}.{part}" if at else part, x))
        elif isinstance(v, (_Object, list)):
            yield at, "[]" if isinstance(v, list) else "{}"
        else:
            yield at, None if v is None else {True: "true", False: "false"}[v] if isinstance(v, bool) else v


class _Object:
    def __init__(self, pairs: list) -> None:
        self.pairs = list(dict(pairs).items())


def stat_metrics(stats: DataFrame, json_col: str = "json") -> DataFrame:
    """Flatten statistics JSON to ``(design_name, path, value)``: one row per leaf, at any depth.

    Path parts are joined by dots; array items are numbered from 0; a dot or
    backslash in a key is escaped by a backslash, so different keys never share
    a path. Numbers keep their spelling. An unreadable document gives one row
    with a NULL path. Narrow: rows leave in bounded batches.
    """

    def run(batches):
        for pdf in batches:
            rows = []
            for name, doc in zip(pdf[D], pdf["json"]):
                try:
                    parsed = json.loads(doc, object_pairs_hook=_Object, parse_int=str, parse_float=str, parse_constant=str)
                except (TypeError, ValueError):
                    rows.append((name, None, None))
                    continue
                for path, value in _leaves(parsed):
                    rows.append((name, path, value))
                    if len(rows) >= 20_000:
                        yield pd.DataFrame(rows, columns=[D, "path", "value"])
                        rows = []
            yield pd.DataFrame(rows, columns=[D, "path", "value"])

    return stats.select(D, F.col(json_col).alias("json")).mapInPandas(run, f"{D} string, path string, value string")


def module_list(listings: DataFrame) -> DataFrame:
    """Module names from a listing: two header lines, then one name per line."""
    lines = F.split("listing", "\n")
    names = F.filter(
        F.transform(F.slice(lines, 3, F.greatest(F.size(lines), F.lit(1))), lambda x: F.trim(F.regexp_replace(x, r"^\s+|\s+$", ""))),
        lambda x: x != "",
    )
    return listings.select(D, F.explode(names).alias("module_name"))
