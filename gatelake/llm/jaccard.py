"""Exact n-gram Jaccard join and its components, by rare-first prefix filtering.

A set of shingles is a node; equal sets are one node. Shingles are ordered rare
first by a table of hashed document frequencies (a fixed number of counters: it
only orders, so collisions cost time and never a link). Two sets of similarity
``t`` or more share a shingle of their prefixes, and the first one they share
also passes the length and the positional filter.

Linking needs no list of all pairs. First every member of a prefix group is
verified against the member in which the shared shingle stands earliest, which
joins a group of near copies at once. Only members that are then still in
different components are paired, filtered and verified, so no link is lost.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatelake.llm.common import content_key, free_names
from gatelake.llm.graph import components
from gatelake.session import materialize

SHINGLE = 3
THRESHOLD = 90  # percent
COUNTERS = 1 << 22
BLOCK = 1 << 16
BINS = 16
BROADCAST_IDS = 1_000_000  # 8 MB of ids; more are joined by a shuffle

_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, n: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``n``-word shingles; fewer words are one shingle, none give none."""
    tokens = ("" if text is None else text).encode().lower().split()
    if not tokens:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))
    k = min(n, len(h))
    acc = np.full(len(h) - k + 1, k, np.uint64)
    for i in range(k):
        acc = _mix(acc * _M1 + h[i : len(h) - k + 1 + i])
    return np.unique(acc)


def _node(s: np.ndarray, seed: int) -> int:
    return int(np.array(xxhash.xxh3_64_intdigest(s.tobytes(), seed), np.uint64).view(np.int64))


def _check(s: np.ndarray) -> int:
    return int(np.array(xxhash.xxh64_intdigest(s.tobytes(), 7), np.uint64).view(np.int64))


def _bins(s: np.ndarray) -> list[int]:
    return np.bincount((s >> np.uint64(60)).astype(np.int64), minlength=BINS).tolist()


def _rows(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[tuple]:
    for b in batches:
        for at in range(0, b.num_rows, 256):
            part = b.slice(at, 256)
            yield part.column(0).to_pylist(), [shingles(x, n) for x in part.column(1).to_pylist()]


def _with_keys(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[tuple]:
    for b in batches:
        for at in range(0, b.num_rows, 256):
            part = b.slice(at, 256)
            yield next(_rows(iter([part]), n)), (part.column(2), part.column(3))


def _first_pass(docs: DataFrame, n: int, seed: int) -> DataFrame:
    """A row per document with its node and content key, and per partition the counters it filled."""
    names = ["doc_id", "k1", "k2", "n", "node", "same", "bins", "block", "counts"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.int32(), pa.binary()]

    def run(batches):
        counts, any_row = np.zeros(COUNTERS, np.uint32), False
        for (ids, sets), (k1, k2) in _with_keys(batches, n):
            any_row = True
            flat = np.concatenate(sets) & np.uint64(COUNTERS - 1)
            np.add.at(counts, flat.astype(np.int64), 1)
            cols = [ids, k1, k2, [len(s) for s in sets], [_node(s, seed) for s in sets], [_check(s) for s in sets], [_bins(s) for s in sets]]
            none = [None] * len(ids)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip([*cols, none, none], types)], names=names)
        for i in range(COUNTERS // BLOCK if any_row else 0):
            piece = counts[i * BLOCK : (i + 1) * BLOCK]
            if piece.any():
                row = [None] * 7 + [i, zlib.compress(piece.tobytes(), 1)]
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=names)

    k1, k2 = content_key(F.col("doc_id"), F.col("text"))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", k1.alias("k1"), k2.alias("k2")).mapInArrow(
        run, "doc_id bigint, k1 bigint, k2 bigint, n int, node bigint, same bigint, bins array<int>, block int, counts binary"
    )


def _sum_blocks(group: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(BLOCK, np.uint64)
    for c in group["counts"]:
        total += np.frombuffer(zlib.decompress(c), np.uint32)
    total = np.minimum(total, np.iinfo(np.uint32).max).astype(np.uint32)
    return pd.DataFrame({"block": [group["block"].iloc[0]], "salt": [0], "counts": [zlib.compress(total.tobytes(), 1)]})


def _frequencies(first: DataFrame) -> np.ndarray:
    """The counters summed over all partitions, in two steps so that no group grows with the number of partitions at once."""
    blocks = first.where("block is not null").select("block", F.pmod(F.xxhash64("counts"), F.lit(32)).cast("int").alias("salt"), "counts")
    part = blocks.groupBy("block", "salt").applyInPandas(_sum_blocks, "block int, salt int, counts binary")
    table = np.zeros(COUNTERS, np.uint32)
    for r in part.groupBy("block").applyInPandas(_sum_blocks, "block int, salt int, counts binary").collect():  # COUNTERS numbers in all
        table[r["block"] * BLOCK : (r["block"] + 1) * BLOCK] = np.frombuffer(zlib.decompress(r["counts"]), np.uint32)
    return table


def _prefixes(docs: DataFrame, table: np.ndarray, n: int, threshold: int, seed: int) -> DataFrame:
    """``s, node, pos, n``: the shingles of each node's prefix, rare first (once per node and partition)."""
    shared = docs.sparkSession.sparkContext.broadcast(table)
    names = ["s", "node", "pos", "n"]

    def run(batches):
        freq, seen = shared.value, set()
        for _, sets in _rows(batches, n):
            out = ([], [], [], [])
            for s in sets:
                node = _node(s, seed)
                if not len(s) or node in seen:
                    continue
                seen.add(node)
                size = len(s) - -(-threshold * len(s) // 100) + 1
                order = np.lexsort((s, freq[(s & np.uint64(COUNTERS - 1)).astype(np.int64)]))[:size]
                out[0].append(s[order].view(np.int64))
                out[1].append(np.full(size, node, np.int64))
                out[2].append(np.arange(size, dtype=np.int32))
                out[3].append(np.full(size, len(s), np.int32))
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], names=names)

    return docs.select(F.lit(None).cast("bigint").alias("doc_id"), "text").mapInArrow(run, "s bigint, node bigint, pos int, n int")


def _may_match(n1: str, p1: str, n2: str, p2: str, threshold: int) -> Column:
    """Length and positional filter for two sets whose first shared shingle stands at ``p1`` and ``p2``."""
    a, b, i, j = F.col(n1), F.col(n2), F.col(p1), F.col(p2)
    most = 1 + F.least(a - i - 1, b - j - 1)  # shared shingles, if none stands earlier
    return (100 * F.least(a, b) >= threshold * F.greatest(a, b)) & ((100 + threshold) * most >= threshold * (a + b))


def _verified(docs: DataFrame, pairs: DataFrame, nodes: DataFrame, n: int, threshold: int, seed: int) -> DataFrame:
    """The ``pairs(a, b)`` whose sets really are similar, each compared once.

    Before any set is read, the suffix filter bounds the overlap by the sizes of
    the parts into which fixed pivots divide both sets.
    """
    side = lambda x: nodes.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("bins").alias(f"bins{x}"), F.col("min_id").alias(f"id{x}"))
    at_most = F.aggregate(F.zip_with("binsa", "binsb", lambda x, y: F.least(x, y)), F.lit(0), lambda s, x: s + x)
    fine = pairs.join(side("a"), "a").join(side("b"), "b").where((100 + threshold) * at_most >= threshold * (F.col("na") + F.col("nb")))
    fine = materialize(fine.select("a", "b", "ida", "idb"), "pairs")
    ids = materialize(fine.select(F.explode(F.array("ida", "idb")).alias("doc_id")).distinct(), "ids")
    small = ids.count() <= BROADCAST_IDS
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(F.broadcast(ids) if small else ids, "doc_id", "left_semi")
    names = ["node", "items"]

    def pack(batches):
        for _, sets in _rows(batches, n):
            yield pa.RecordBatch.from_arrays(
                [pa.array([_node(s, seed) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], names=names
            )

    def compare(batches):
        for b in batches:
            x, y = b.column(2).to_pylist(), b.column(3).to_pylist()
            keep = []
            for p, q in zip(x, y):
                p, q = np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(100 * both >= threshold * (len(p) + len(q) - both))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    sets = materialize(rows.mapInArrow(pack, "node bigint, items binary"), "sets").dropDuplicates(["node"])
    joined = fine.select("a", "b").join(sets.select(F.col("node").alias("a"), F.col("items").alias("x")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("items").alias("y")), "b"
    )
    return materialize(joined.select("a", "b", "x", "y").mapInArrow(compare, "a bigint, b bigint"), "links")


def _nodes(docs: DataFrame, n: int) -> tuple[DataFrame, DataFrame, int]:
    """First pass and its node table; the hash is seeded anew if two different sets ever share a node number."""
    seed = 0
    while True:
        first = materialize(_first_pass(docs, n, seed), "first")
        nodes = materialize(
            first.where("block is null and doc_id is not null and n > 0").groupBy("node").agg(
                F.min("doc_id").alias("min_id"), F.min("n").alias("n"), F.first("bins").alias("bins"),
                F.min("same").alias("s1"), F.max("same").alias("s2"),
            ), "nodes",
        )
        if nodes.where("s1 <> s2").isEmpty():
            return first, nodes, seed
        seed += 1


def _members(docs: DataFrame, n: int, threshold: int) -> tuple[DataFrame, DataFrame]:
    """The first pass and, per node, its component: ``node, node_id, root, component_id, n_links``."""
    first, nodes, seed = _nodes(docs, n)
    named = docs.where("doc_id is not null")
    prefix = materialize(_prefixes(named, _frequencies(first), n, threshold, seed), "prefix")
    groups = prefix.groupBy("s").agg(
        F.min(F.struct("pos", "node", "n")).alias("lead"), F.min("node").alias("x"), F.max("node").alias("y")
    ).where("x <> y").select("s", F.col("lead.node").alias("a"), F.col("lead.pos").alias("pa"), F.col("lead.n").alias("na"))
    shared = materialize(prefix.join(groups, "s"), "shared")
    stars = shared.where(F.col("node") != F.col("a")).where(_may_match("n", "pos", "na", "pa", threshold)).select("a", F.col("node").alias("b"))
    pair = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    stars = materialize(stars.select(*pair).distinct(), "stars")
    links = _verified(named, stars, nodes, n, threshold, seed)
    roots = components(links)
    rooted = shared.select("s", "node", "pos", "n").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    apart = rooted.groupBy("s").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("s")
    left = materialize(rooted.join(apart, "s"), "apart")
    other = left.select("s", *[F.col(c).alias(f"{c}2") for c in ("node", "pos", "n", "root")])
    rest = left.join(other, "s").where((F.col("root") < F.col("root2")) & _may_match("n", "pos", "n2", "pos2", threshold))
    rest = rest.select(F.col("node").alias("a"), F.col("node2").alias("b")).select(*pair).distinct().join(stars, ["a", "b"], "left_anti")
    more = _verified(named, rest, nodes, n, threshold, seed)
    every = links.unionByName(more)
    roots = components(every)
    degree = every.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("n_links"))
    of_node = nodes.select("node", "min_id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = of_node.groupBy("root").agg(F.min("min_id").alias("component_id"))
    of_node = of_node.join(least, "root").join(degree, "node", "left")
    return first, materialize(of_node.select("node", F.col("min_id").alias("node_id"), "root", "component_id", "n_links"), "members")


def join_components(docs: DataFrame, n: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_shingles, component_id, node_id, n_links``.

    ``component_id`` is the smallest ``doc_id`` reachable over links, ``node_id`` the
    smallest with the same set, ``n_links`` the verified links that hold the node's
    component together at it (a spanning set, not all pairs). Null or empty texts have
    no shingles and link with nothing. A row with a null ``doc_id`` gets a null
    component and links nothing; rows that repeat an id each get a row. Other columns
    are ignored; an empty table gives no rows.
    """
    first, of_node = _members(docs, n, threshold)
    rows = first.where("block is null").select("doc_id", F.col("n").cast("bigint").alias("n_shingles"), F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("node")).alias("node"))
    out = rows.join(of_node, "node", "left")
    return out.select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce("node_id", "doc_id").alias("node_id"), F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
    )


def keep_one(docs: DataFrame, n: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """``docs`` with one row of each component, of the smallest id; columns as given, whatever their names.

    Rows are told apart by id and text: rows that share an id but no similar text each
    stand for themselves. Of rows equal in both one stays. Rows without words stay, as
    do all rows with a null id. An empty table gives no rows.
    """
    first, of_node = _members(docs, n, threshold)
    k1, k2 = free_names(docs, "_k1", "_k2")
    rows = first.where("block is null and doc_id is not null")
    alone = rows.where("n = 0").select("k1", "k2")
    least = rows.where("n > 0").join(of_node.select("node", "root"), "node").groupBy("root").agg(F.min(F.struct("doc_id", "k1", "k2")).alias("m"))
    chosen = least.select("m.k1", "m.k2").unionByName(alone).select(F.col("k1").alias(k1), F.col("k2").alias(k2)).distinct()
    keyed = docs.where("doc_id is not null").withColumns(dict(zip((k1, k2), content_key(F.col("doc_id"), F.col("text")))))
    named = keyed.join(chosen, [k1, k2], "left_semi").dropDuplicates([k1, k2])
    return named.select(*docs.columns).unionByName(docs.where("doc_id is null"))
