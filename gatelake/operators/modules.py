"""Module extraction, hashing and instance edges from source text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatelake.functions import patterns as P
from gatelake.functions import text as X


def extract_modules(
    files: DataFrame, *, comments: str = "strip", compat: str | None = None, keep: list[str] | None = None
) -> DataFrame:
    """One row per module definition: ``(*keep, pos, module_name, body)``.

    ``comments="strip"`` removes comments first (the hashing form);
    ``"keep"`` leaves the text as written and only skips modules that sit
    inside a comment. The first ``endmodule`` ends a module, ``module a;``
    counts, and a name is an identifier. ``compat="strict_header"`` accepts
    only headers that open a port or parameter list right after the name.

    Narrow: no shuffle, one row in gives that file's modules out.
    """
    keep = keep or [c for c in ("dataset_name", "design_name", "file_name") if c in files.columns]
    if comments == "strip":
        found = X.find_all(X.strip_comments_loose(F.col("text")), P.MODULE)
    else:
        found = F.filter(X.find_all(F.col("text"), P.MODULE_OR_COMMENT), lambda t: F.startswith(t, F.lit("m")))
    out = files.select(*keep, F.posexplode(found).alias("pos", "body"))
    if compat == "strict_header":
        out = out.filter(F.col("body").rlike(P.STRICT_HEADER))
    return out.select(*keep, "pos", X.module_name(F.col("body")).alias("module_name"), "body")


def module_hashes(files: DataFrame, *, compat: str | None = None, position: bool = False) -> DataFrame:
    """``(module_hash, module_name, design_name, dataset_name)``; text never leaves the map side.

    ``position=True`` also keeps ``file_name, pos``, which identify a row.
    """
    where = ["file_name", "pos"] if position else []
    mods = extract_modules(files, compat=compat)
    return mods.select(
        X.module_hash(F.col("body")).alias("module_hash"), "module_name", "design_name", "dataset_name", *where
    )


def instance_heads(body: Column) -> Column:
    """Names at the head of a statement that may be an instance; the module's own header is left out."""
    return F.array_distinct(X.find_all(X.strip_comments_loose(F.regexp_replace(body, P.MODULE_NAME, "")), P.INSTANCE_HEAD, 1))


def module_heads(files: DataFrame, *, comments: str = "strip") -> DataFrame:
    """``(*keep, pos, module_name, heads)``: what hierarchy checks need of a module, without its body."""
    mods = extract_modules(files, comments=comments)
    return mods.withColumn("heads", instance_heads(F.col("body"))).drop("body")


def instances_from_text(modules: DataFrame) -> DataFrame:
    """Distinct ``(design_name, parent, child)`` where a body instantiates a known module.

    ``modules`` has bodies or, as ``module_heads`` gives them, heads. The semi join
    with the module names drops keywords and unknown cells. Only names are
    shuffled, and heads repeat at most once per body.
    """
    heads = F.col("heads") if "heads" in modules.columns else instance_heads(F.col("body"))
    cand = modules.select("design_name", F.col("module_name").alias("parent"), F.explode(heads).alias("child"))
    names = modules.select("design_name", F.col("module_name").alias("child"))
    return cand.join(names, ["design_name", "child"], "left_semi").select("design_name", "parent", "child").distinct()


def body_of(modules: DataFrame, wanted: DataFrame) -> DataFrame:
    """Bodies of the named modules ``wanted(design_name, module_name)``, by one join."""
    return wanted.join(modules, ["design_name", "module_name"])


def locate_modules(modules: DataFrame, wanted: DataFrame) -> DataFrame:
    """How many files define each wanted module; anything but one file is an error.

    ``(design_name, module_name, n_files, status)``.
    """
    found = modules.groupBy("design_name", "module_name").agg(F.countDistinct("file_name").alias("n_files"))
    return (
        wanted.join(found, ["design_name", "module_name"], "left")
        .withColumn("n_files", F.coalesce("n_files", F.lit(0)).cast("long"))
        .withColumn(
            "status",
            F.when(F.col("n_files") == 1, "ok").when(F.col("n_files") == 0, "missing").otherwise("ambiguous"),
        )
        .select("design_name", "module_name", "n_files", "status")
    )
