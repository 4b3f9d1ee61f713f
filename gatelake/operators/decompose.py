"""Sub-design sources: each module's closure cut out of the original files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from gatelake.functions import patterns as P
from gatelake.functions import text as X
from gatelake.operators import graph, modules, small_texts
from gatelake.session import materialize, n_buckets

D = "design_name"
SMALL_TOKENS, SMALL_BYTES = 1 << 8, 1 << 15  # tokens and text of a design that one task takes at once


def segmented(files: DataFrame, *, heads: bool = False) -> DataFrame:
    """Files as alternating gaps and tokens. Narrow.

    Tokens are modules or comments as written, each with the name of the
    module it defines (empty for comments); ``heads`` adds a module's ``modules.instance_heads``,
    and the file's ``bytes``.
    """
    t = F.col("text")

    def token(k: Column) -> Column:
        also = [F.when(F.startswith(k, F.lit("m")), modules.instance_heads(k)).alias("heads")] if heads else []
        return F.struct(k.alias("text"), X.module_name(k).alias("name"), *also)

    return files.select(
        D, "file_name",
        F.split(t, P.MODULE_OR_COMMENT).alias("gaps"),
        F.transform(X.find_all(t, P.MODULE_OR_COMMENT), token).alias("toks"),
        *([X.byte_size(t).alias("bytes")] if heads else []),
    )


def kept_text(gaps: Column, toks: Column, kept: Column) -> Column:
    """The file with every module whose token number is not in ``kept`` replaced by one newline, outer newlines trimmed.

    ``kept`` is sorted; one mark per token is built from it, so no token searches a list.
    """
    before = lambda s, j: F.when(j > 0, F.get(s, j - 1)).otherwise(F.lit(-1))
    marks = X.let(kept, lambda s: F.split(F.array_join(F.transform(
        s, lambda k, j: F.concat(F.repeat(F.lit("0"), k - before(s, j) - 1), F.lit("1"))), ""), ""))

    def piece(g: Column, i: Column, m: Column) -> Column:
        t = F.get(toks, i)  # the last gap has none, and marks end with the last kept one
        cut = F.when((t["name"] == "") | (F.get(m, i) == "1"), t["text"]).otherwise(F.lit("\n"))
        return F.concat(g, F.when(t.isNull(), F.lit("")).otherwise(cut))

    body = X.let(marks, lambda m: F.array_join(F.transform(gaps, lambda g, i: piece(g, i, m)), ""))
    return F.concat(F.trim(body, F.lit("\n")), F.lit("\n"))


def subdesign_text(files: DataFrame, closed: DataFrame, roots: DataFrame | None = None) -> DataFrame:
    """``(design_name, root, file_name, text)``: every file of a design, cut down per root; blank files drop out.

    Text is split once per file, into a written table of tokens and one of their
    names. Per root only the numbers of the tokens a file keeps are collected (at
    most the modules of that one file), and the wide rows meet them in a single
    join keyed by (design, file), so a large design is spread over its files.
    """
    return _cut(materialize(segmented(files), "segments"), closed, roots)


def _cut(parts: DataFrame, closed: DataFrame, roots: DataFrame | None = None) -> DataFrame:
    """``subdesign_text`` from the written table of tokens."""
    defined = parts.select(D, "file_name", F.posexplode("toks.name").alias("tok", "node")).filter("node <> ''")
    sub = closed if roots is None else closed.join(
        roots.select(D, F.col("module_name").alias("root")), [D, "root"], "left_semi")
    kept = sub.select(D, "root", "node").join(defined, [D, "node"]).groupBy(D, "root", "file_name").agg(
        F.sort_array(F.collect_set("tok")).alias("kept"))
    # every file belongs to every sub-design of its design, so the pairs are the size of the output
    pairs = sub.filter("root = node").select(D, "root").join(parts.select(D, "file_name"), D)
    wanted = pairs.join(kept, [D, "root", "file_name"], "left").withColumn("kept", F.coalesce("kept", F.array().cast("array<int>")))
    out = wanted.join(parts, [D, "file_name"]).select(
        D, "root", "file_name", kept_text(F.col("gaps"), F.col("toks"), F.col("kept")).alias("text"))
    return out.filter(F.col("text").rlike(P.NON_WHITESPACE))


def _by_size(parts: DataFrame) -> tuple[DataFrame | None, DataFrame | None]:
    """The written tokens of small designs and of the others, where there are any.

    Fewer small designs than tasks would leave tasks idle: then all go by (design, file).
    """
    is_large = (F.coalesce("n", F.lit(0)) > SMALL_TOKENS) | (F.coalesce("bytes", F.lit(0)) > SMALL_BYTES)
    seen, sizes = Observation(), parts.groupBy(F.col(D).alias("large")).agg(F.sum(F.size("toks.name")).alias("n"), F.sum("bytes").alias("bytes"))
    large = materialize(sizes.observe(seen, F.count_if(~is_large).alias("small")).where(is_large).select("large"), "large_designs")
    if seen.get["small"] < n_buckets(parts.sparkSession):
        return None, parts
    if large.isEmpty():
        return parts, None
    same = parts[D].eqNullSafe(large["large"])
    return parts.join(large, same, "left_anti"), parts.join(large, same, "left_semi")


def decompose_text(files: DataFrame, roots: DataFrame | None = None) -> DataFrame:
    """Decomposition from text alone: modules, instances, closure, then the cut files.

    Modules and their heads are taken from the tokens the files are cut by: the text is split once.
    Small designs are dealt by design and take all further steps within a task, a batch of
    designs at a time (``small_texts``); others, and all where ``roots`` are given, go by (design, file).
    """
    parts = materialize(segmented(files, heads=True), "segments")
    small, rest = _by_size(parts) if roots is None else (None, parts)
    if small is None:
        return _decomposed(rest, roots)
    rows = small.repartition(D).sortWithinPartitions(D).select(
        F.col(D).cast("string"), F.col("file_name").cast("string"), "gaps", F.col("toks.text").alias("texts"), F.col("toks.name").alias("names"), F.col("toks.heads").alias("heads"))
    out = rows.mapInArrow(small_texts.cut, f"{D} string, root string, file_name string, text string").filter(F.col("text").rlike(P.NON_WHITESPACE))
    return out if rest is None else out.unionByName(_decomposed(rest))


def _decomposed(parts: DataFrame, roots: DataFrame | None = None) -> DataFrame:
    """``decompose_text`` of designs of any size from the written table of tokens."""
    found = F.filter(F.transform("toks", lambda t: F.struct(t["name"].alias("module_name"), t["heads"].alias("heads"))), lambda t: t["module_name"] != "")
    mods = parts.select(D, F.inline(found))
    nodes = mods.select(D, "module_name").distinct()
    edges = modules.instances_from_text(mods)
    return _cut(parts, graph.closure(nodes, edges, roots))


def decompose_structured(closed: DataFrame) -> DataFrame:
    """Sub-designs as module lists: one ``(design_name, root, module_name)`` row per member."""
    return closed.select(D, "root", F.col("node").alias("module_name"))
