"""Syntax trees as node and edge rows."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = ["design_name", "file_name"]
BATCH_ROWS = 20_000
_CHUNKS = "design_name string, file_name string, first int, nodes array<struct<parent_idx: int, depth: int, tag: string, attrs: string{}>>"


def _walk(tree: dict) -> Iterator[tuple[int, int | None, int, dict]]:
    """Pre-order (idx, parent_idx, depth, node) with an explicit stack; NULL children are skipped."""
    stack: list[tuple[dict, int | None, int]] = [(tree, None, 0)]
    idx = 0
    pop, push = stack.pop, stack.append
    while stack:
        node, parent, depth = pop()
        yield idx, parent, depth, node
        kids = node.get("children")
        if kids:
            depth += 1
            for c in reversed(kids):
                if c is not None:
                    push((c, idx, depth))
        idx += 1


def _tree_of(text: str) -> dict | None:
    """The tree of a document's first entry; None when there is none."""
    try:
        entry = next(iter(json.loads(text).values()))
    except (ValueError, StopIteration, AttributeError, TypeError):
        return None
    if not isinstance(entry, dict) or "errors" in entry or not isinstance(entry.get("tree"), dict):
        return None
    return entry["tree"]


def _flattened(attrs: bool, named: list[str]):
    """Arrow batches of documents to batches of chunks: a file's nodes as one list, long files as several.

    Attributes in ``named`` stand beside the node where they are text or whole numbers; a
    node with one of another type keeps ``attrs`` for Spark to read.
    """
    encode = json.JSONEncoder(check_circular=False).encode
    names = [("parent_idx", pa.int32()), ("depth", pa.int32()), ("tag", pa.string()), ("attrs", pa.string()), *((f"f{i}", pa.string()) for i in range(len(named)))]
    fields = [pa.field(n, t) for n, t in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, rows, first, ends, absent = [batch.column(i) for i in range(2)], [], [], [0], []
            columns = [[] for _ in fields]

            def chunks() -> pa.RecordBatch:
                values = [pa.array(c, f.type) for c, f in zip(columns, fields)]
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(values, fields=fields), mask=pa.array(absent, pa.bool_()))
                at = pa.array(rows, pa.int32())
                return pa.RecordBatch.from_arrays([*(k.take(at) for k in keys), pa.array(first, pa.int32()), lists], names=["design_name", "file_name", "first", "nodes"])

            def end(row: int, at: int, none: bool = False) -> None:
                rows.append(row)
                first.append(at)
                absent.append(none)
                ends.append(len(columns[0]))

            parents, depths, tags, others, *asked = columns
            wanted = [*zip(named, asked)]
            for row, text in enumerate(batch.column(2).to_pylist()):
                tree = _tree_of(text)
                if tree is None:
                    end(row, 0, none=True)
                    continue
                at, idx = 0, -1
                for idx, parent, depth, node in _walk(tree):
                    parents.append(parent)
                    depths.append(depth)
                    tag = node.get("tag")
                    tags.append(tag if tag is None or type(tag) is str else str(tag))
                    whole = attrs
                    for name, column in wanted:
                        value = node.get(name)
                        if value is None or type(value) is str:
                            column.append(value)
                        elif type(value) is int:
                            column.append(str(value))
                        else:
                            column.append(None)
                            whole = True
                    others.append(encode({k: v for k, v in node.items() if k != "children"}) if whole else None)
                    if len(parents) >= BATCH_ROWS:  # output batches are bounded however large a file is
                        end(row, at)
                        yield chunks()
                        at = idx + 1
                        for c in (rows, first, absent, *columns):
                            c.clear()
                        ends[:] = [0]
                if idx >= at:
                    end(row, at)
            if rows:
                yield chunks()

    return run


def ast_nodes(trees: DataFrame, *, attrs: bool = True, fields: dict[str, str] | None = None) -> DataFrame:
    """``trees(design_name, file_name, json)`` → one row per tree node in pre-order.

    JSON trees have no fixed depth, so each file is walked in an Arrow-batched
    task; files are independent rows and nothing is shuffled. Tasks hand back a
    list per file, which Spark explodes. Only the first
    entry of a document is used. ``attrs`` is JSON text (``parse_json`` gives
    the VARIANT), or left out; ``fields`` names columns to take from single attributes,
    as ``get_json_object`` would give them. A document without a tree is one row with ``status='no_tree'``.
    """
    fields = fields or {}
    extra = "".join(f", f{i}: string" for i in range(len(fields)))
    chunks = trees.select(*KEY, "json").mapInArrow(_flattened(attrs, [*fields.values()]), _CHUNKS.format(extra))
    nodes = chunks.select(*KEY, "first", F.posexplode_outer("nodes").alias("pos", "n"))
    asked = [F.coalesce(f"n.f{i}", F.get_json_object("n.attrs", f"$['{a}']")).alias(c) for i, (c, a) in enumerate(fields.items())]
    return nodes.select(
        *KEY, (F.col("first") + F.col("pos")).alias("idx"), "n.parent_idx", "n.depth", "n.tag", *(["n.attrs"] if attrs else []), *asked,
        F.when(F.col("pos").isNull(), "no_tree").otherwise("ok").alias("status"))


def ast_edges(nodes: DataFrame, *, multi: bool = False, nested: bool = False) -> DataFrame:
    """``(design_name, file_name, src, dst, t_edge_type)``.

    ``ast`` parent→child and back, ``nco`` i→i+1 and back. A graph holds one
    edge per (src, dst), so ``nco`` replaces ``ast`` where the child is the
    next node; ``multi=True`` keeps both. Every edge follows from one node
    row (indexes are dense), so this is a narrow explode, no self-join: only
    the last node of a file has no successor, which is the predecessor edge
    seen from the other side. ``nested=True`` leaves them in their node rows, as
    ``(design_name, file_name, status, edges)`` (see ``graph_counts``).
    """
    i, p = F.col("idx"), F.col("parent_idx")

    def edge(src, dst, kind):
        return F.struct(src.alias("src"), dst.alias("dst"), F.lit(kind).alias("t_edge_type"))

    order = F.array(edge(i - 1, i, "nco"), edge(i, i - 1, "nco_reverse"))
    tree = F.array(edge(p, i, "ast"), edge(i, p, "ast_reverse"))
    replaced = F.lit(False) if multi else p == i - 1
    edges = F.when(replaced, order).otherwise(F.concat(order, tree))
    edges = F.when((F.col("status") == "ok") & (i > 0), edges)
    if nested:
        return nodes.select(*KEY, "status", edges.alias("edges"))
    return nodes.select(*KEY, F.explode(edges).alias("e")).select(*KEY, "e.src", "e.dst", "e.t_edge_type")


def tree_violations(nodes: DataFrame) -> DataFrame:
    """Files whose nodes do not form one tree: a node count other than edges + 1, or no tree at all."""
    n = nodes.groupBy(*KEY).agg(
        F.count_if(F.col("parent_idx").isNull()).alias("n_roots"),
        F.count_if(F.col("status") != "ok").alias("n_bad"))
    return n.filter("n_roots <> 1 OR n_bad > 0").select(*KEY, F.lit("not_a_tree").alias("status"))


def graph_counts(edges: DataFrame) -> DataFrame:
    """Node and edge counts per file from ``ast_edges(…, nested=True)``: its edges become rows and are counted as such, beside the nodes.

    Every node has a row in ``edges``, and its edges are rows numbered from 0, or one
    row without an edge; so one aggregation counts both, and trees are walked once.
    A file without a name has no edges to its name.
    """
    rows = edges.filter("status = 'ok'").select(*KEY, F.posexplode_outer("edges").alias("pos", "edge"))
    named = F.col("design_name").isNotNull() & F.col("file_name").isNotNull()
    return rows.groupBy(*KEY).agg(F.count_if(F.coalesce("pos", F.lit(0)) == 0).alias("n_nodes"), F.count("edge").alias("n_edges")).withColumn(
        "n_edges", F.when(named, F.col("n_edges")).otherwise(F.lit(0)))


def _shape(parents: list[int | None]) -> tuple[int, float]:
    """Diameter and mean distance over all ordered pairs of a tree given by its pre-order parents.

    A tree edge above a node separates its ``size`` nodes from the rest, so all
    distances sum to Σ 2·size·(n−size). The diameter is the largest sum of the two
    highest branches at a node. Both fold upwards in one backward pass.
    """
    n = len(parents)
    size, height, bend, total = [1] * n, [0] * n, 0, 0
    for i in range(n - 1, 0, -1):
        p = parents[i]
        bend = max(bend, height[p] + height[i] + 1)
        height[p] = max(height[p], height[i] + 1)
        size[p] += size[i]
        total += 2 * size[i] * (n - size[i])
    return bend, total / (n * n)


def _measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for design, file, text in zip(pdf["design_name"], pdf["file_name"], pdf["json"]):
            tree = _tree_of(text)
            if tree is not None:
                rows.append((design, file, *_shape([p for _, p, _, _ in _walk(tree)])))
        yield pd.DataFrame(rows, columns=[*KEY, "diameter", "mean_distance"])


def tree_distances(trees: DataFrame) -> DataFrame:
    """``(design_name, file_name, diameter, mean_distance)`` of ``trees(design_name, file_name, json)``.

    Measured in the walk of the tree, without node pairs, shuffles or a loop over
    levels. Documents without a tree have no row.
    """
    return trees.select(*KEY, "json").mapInPandas(_measure, "design_name string, file_name string, diameter long, mean_distance double")
