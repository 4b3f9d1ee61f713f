"""Graph operators over all designs at once.

Nodes are ``(design_name, module_name)``, edges ``(design_name, parent, child)``.
Designs of up to ``SMALL`` rows are dealt by design and take all their rounds within a
task, a batch of designs at a time. The work of larger ones is keyed by (design, node),
so that a very large design is spread over all tasks. Loops keep their tables in buckets of those keys: edges, known pairs and
counters are written once and lie where they are in every round; what a round
shuffles are the rows it finds. Each round is a written table, so a lost executor
costs tasks and never a round.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from gatelake.operators import small_graphs
from gatelake.operators.summary import top_one
from gatelake.session import bucketed, checkpoint, materialize, n_buckets, settings

D, ROOT, NODE = "design_name", "root", "node"
HUB = 1 << 20  # edges of a node, or start nodes of a design, that one bucket takes
TIER = 8
SMALL = 1 << 10  # nodes and edges of a design that one task takes at once


def _written(df: DataFrame, keys: list[str], label: str, **counts: Column) -> tuple[DataFrame, dict]:
    """``bucketed`` for rows that come dealt by ``keys``, with counts taken while they are written."""
    seen = Observation()
    table = bucketed(df.observe(seen, *[c.alias(k) for k, c in counts.items()]), keys, label, dealt=True)
    return table, seen.get


class _Tiers:
    """Tables of many rounds, all in the same buckets: eight of one tier become one of the next.

    A row is rewritten once per tier, so all that a loop writes stays within the
    logarithm of its rounds times the rows it finds, and a lookup reads few tables.
    """

    def __init__(self, keys: list[str], label: str, merge: Callable[[DataFrame], DataFrame] = lambda t: t):
        self.keys, self.label, self._merge = keys, label, merge
        self._tiers: list[list[DataFrame]] = [[]]

    def add(self, table: DataFrame) -> None:
        self._tiers[0].append(table)
        for i, tables in enumerate(self._tiers):
            if len(tables) == TIER:
                if i + 1 == len(self._tiers):
                    self._tiers.append([])
                self._tiers[i + 1].append(bucketed(self._merge(reduce(DataFrame.unionByName, tables)), self.keys, self.label))
                self._tiers[i] = []

    @property
    def tables(self) -> list[DataFrame]:
        """Newest rows first."""
        return [t for tables in self._tiers for t in reversed(tables)]


def _by_size(nodes: DataFrame, edges: DataFrame) -> tuple[DataFrame | None, DataFrame | None, DataFrame | None]:
    """Rows of small designs for ``small_graphs``, sorted by design, and nodes and edges of the others, where there are any.

    All rows are written once; what decides is the count of a design's rows. Fewer small
    designs than tasks would leave tasks idle: then all go by (design, node).
    """
    name = lambda c: F.col(c).cast("string")
    rows = materialize(nodes.select(name(D).alias(D), name("module_name").alias("a"), F.lit(None).cast("string").alias("b"), F.lit(False).alias("edge")).unionByName(
        edges.select(name(D).alias(D), name("parent").alias("a"), name("child").alias("b"), F.lit(True).alias("edge"))), "graphs")
    seen, sizes = Observation(), rows.groupBy(F.col(D).alias("large")).agg(F.count(F.lit(1)).alias("n"))
    large = materialize(sizes.observe(seen, F.count_if(F.col("n") <= SMALL).alias("small")).where(F.col("n") > SMALL), "large_designs")
    if seen.get["small"] < n_buckets(rows.sparkSession):
        small, rest = None, rows
    elif large.isEmpty():
        small, rest = rows, None
    else:
        same = rows[D].eqNullSafe(large["large"])
        small, rest = rows.join(large, same, "left_anti"), rows.join(large, same, "left_semi")
    small = None if small is None else small.repartition(D).sortWithinPartitions(D)
    if rest is None:
        return small, None, None
    return small, rest.where("NOT edge").select(D, F.col("a").alias("module_name")), rest.where("edge").select(
        D, F.col("a").alias("parent"), F.col("b").alias("child"))


def closure(nodes: DataFrame, edges: DataFrame, roots: DataFrame | None = None) -> DataFrame:
    """``(design_name, root, node, level)``: everything below each root, the root itself at level 0.

    Semi-naive: each round extends only pairs found in the round before and
    drops pairs already known, so cycles end. ``level`` is the shortest
    distance. ``roots`` limits the start nodes (all nodes by default).
    Small designs are closed over by ``small_graphs``, others by ``_closure``.
    """
    known = edges.where(F.col(D).isNotNull() & F.col("parent").isNotNull() & F.col("child").isNotNull())
    small, start, links = _by_size(roots if roots is not None else nodes, known)
    if small is None:
        return _closure(start, links)
    out = materialize(small.mapInArrow(small_graphs.close, f"{D} string, {ROOT} string, {NODE} string, level int"), "closure")
    return out if start is None else out.unionByName(_closure(start, links))


def _closure(roots: DataFrame, edges: DataFrame) -> DataFrame:
    """``closure`` of designs of any size, round by round.

    Edges and known pairs lie in the same buckets of (design, node): a round joins
    its frontier with both in place and shuffles only the pairs it reaches. Out-edges
    of a hub are dealt over several buckets by child, and pairs of a design with
    very many start nodes by root; the pairs of a hub stand once in each bucket of
    its edges.
    """
    spark, keys = edges.sparkSession, [D, NODE]
    # read by the first round and again for the result: written once, where the edges lie
    start = bucketed(roots.select(D, F.col("module_name").alias(NODE)).repartition(n_buckets(spark), *keys).distinct(), keys, "starts", dealt=True)
    links, n = _written(edges.select(D, F.col("parent").alias(NODE), "child").repartition(n_buckets(spark), *keys).distinct(), keys, "edges", n=F.count(F.lit(1)))
    salts = _salts(links, start) if n["n"] > HUB else None  # a node with fewer edges above it is in fewer pairs
    if salts is not None:
        keys = [D, NODE, "salt"]
        links = bucketed(salts.edges(links), keys, "edges")
    pair = [D, ROOT, *keys[1:]]
    frontier = start.withColumn(ROOT, F.col(NODE))
    if salts is not None:
        frontier = salts.starts(frontier)
    known, level = _Tiers(keys, "pairs"), 0
    with settings(spark, spark_sql_requireAllClusterKeysForCoPartition="false"):
        while True:
            level += 1
            reached = frontier.join(links, keys).filter(F.col("child") != F.col(ROOT))  # a root is known from the start
            if salts is not None:
                reached = salts.reached(reached)
            reached = reached.select(D, ROOT, F.col("child").alias(NODE), *keys[2:]).repartition(n_buckets(spark), *keys).distinct()
            for table in known.tables:
                reached = reached.join(table.select(*pair), pair, "left_anti")
            found, n = _written(reached.withColumn("level", F.lit(level)), keys, "pairs", n=F.count(F.lit(1)))
            if not n["n"]:
                break
            known.add(found)
            frontier = found.drop("level")
    out = start.select(D, F.col(NODE).alias(ROOT), NODE, F.lit(0).alias("level"))
    if not known.tables:
        return out
    pairs = reduce(DataFrame.unionByName, known.tables)
    return out.unionByName((pairs if salts is None else salts.once(pairs)).select(D, ROOT, NODE, "level"))


def _salts(links: DataFrame, start: DataFrame) -> _Salts | None:
    """Bucket numbers for the hubs of ``links`` and the designs with most start nodes; nothing where there are none."""
    wide = links.groupBy(D, NODE).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HUB)
    tall = start.groupBy(D).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HUB)
    wide, tall = materialize(wide, "hubs"), materialize(tall, "hubs")
    return None if wide.isEmpty() and tall.isEmpty() else _Salts(wide, tall)


class _Salts:
    """Numbers of buckets for hubs and for designs with very many start nodes.

    A node's bucket number is ``row * parts + part``: ``part`` of its edges goes by
    child, ``row`` of its pairs by root. Edges stand in all rows, pairs in all parts.
    """

    def __init__(self, wide: DataFrame, tall: DataFrame):
        size = F.ceil(F.col("n") / HUB).cast("int")
        self._wide = wide.select(D, NODE, size.alias("parts"))
        self._tall = tall.select(D, size.alias("rows"))

    def _sized(self, df: DataFrame, node: str, parts: str) -> DataFrame:
        wide = self._wide.select(D, F.col(NODE).alias(node), F.col("parts").alias(parts))
        return df.join(wide, [D, node], "left").withColumn(parts, F.coalesce(parts, F.lit(1)))

    def _with_rows(self, df: DataFrame) -> DataFrame:
        return df.join(self._tall, D, "left").withColumn("rows", F.coalesce("rows", F.lit(1)))

    @staticmethod
    def _copies(parts: Column, rows: Column) -> Column:
        """Bucket numbers of a pair: its row, in all parts."""
        row = F.pmod(F.xxhash64(ROOT), rows).cast("int")
        return F.explode(F.transform(F.sequence(F.lit(0), parts - 1), lambda p: row * parts + p))

    def edges(self, links: DataFrame) -> DataFrame:
        sized = self._with_rows(self._sized(self._sized(links, NODE, "parts"), "child", "next_parts"))
        part = F.pmod(F.xxhash64("child"), F.col("parts")).cast("int")
        return sized.withColumn("salt", F.explode(F.transform(F.sequence(F.lit(0), F.col("rows") - 1), lambda r: r * F.col("parts") + part))).drop("parts")

    def starts(self, start: DataFrame) -> DataFrame:
        sized = self._with_rows(self._sized(start, NODE, "parts"))
        return sized.withColumn("salt", self._copies(F.col("parts"), F.col("rows"))).drop("parts", "rows")

    def reached(self, joined: DataFrame) -> DataFrame:
        return joined.drop("salt").withColumn("salt", self._copies(F.col("next_parts"), F.col("rows")))

    def once(self, pairs: DataFrame) -> DataFrame:
        sized = self._sized(pairs, NODE, "parts")
        return sized.where(F.col("salt") % F.col("parts") == 0)


_VALUE = ("v1", "v2")


def _merkle(sums: list[str]) -> list[Column]:
    """A node's hash from its name and the sums of its children's hashes; an order-free sum needs no sorted list."""
    return [F.xxhash64(F.lit(i + 1), NODE, *sums).alias(v) for i, v in enumerate(_VALUE)]


def _waves(nodes: DataFrame, edges: DataFrame, *, from_leaves: bool, hashes: bool = False) -> DataFrame:
    """``(design_name, node, level)`` by removing free nodes round by round; with ``hashes`` also ``v1, v2``.

    All tables lie in buckets of (design, node). A node's number of open edges is
    written when it is first known and again only in rounds that free one of its
    edges, so the rounds together write rows in proportion to nodes and edges.
    Nodes that free nothing (no edges out) are kept out of the rounds and follow
    from their neighbours in one join at the end; where after some rounds only half
    of the waiting nodes is left, their counters and edges are written anew, so that
    later rounds do not read what is done. Edges of hubs lie in files of even size.
    """
    a, b = ("child", "parent") if from_leaves else ("parent", "child")
    spark, keys, sums = edges.sparkSession, [D, NODE], ["s1", "s2"] if hashes else []
    zero = F.lit(0).cast("bigint")
    nothing = [F.lit(0).cast("decimal(38,0)").alias(s) for s in sums]
    links = bucketed(edges.select(D, F.col(a).alias("src"), F.col(b).alias("dst")).distinct(), [D, "src"], "links")
    ends = links.select(D, F.col("src").alias(NODE), zero.alias("ins"), (zero + 1).alias("outs")).unionByName(
        links.select(D, F.col("dst").alias(NODE), (zero + 1).alias("ins"), zero.alias("outs"))).unionByName(
        nodes.select(D, F.col("module_name").alias(NODE), zero.alias("ins"), zero.alias("outs")))
    inner = (F.col("ins") > 0) & (F.col("outs") > 0)
    state, n = _written(
        ends.groupBy(*keys).agg(F.sum("ins").alias("ins"), F.sum("outs").alias("outs")), keys, "nodes",
        free=F.count_if(F.col("ins") == 0), waiting=F.count_if(inner), most=F.max("outs"))
    hubs = None
    if (n["most"] or 0) > HUB:
        wide = state.where(F.col("outs") > HUB).select(D, F.col(NODE).alias("src"))
        hubs = materialize(links.join(wide, [D, "src"]), "hubs")
        links = bucketed(links.join(wide, [D, "src"], "left_anti"), [D, "src"], "links")
    all_links = links

    def messages(open_links: DataFrame, freed: DataFrame, also: list[Column]) -> DataFrame:
        out = freed.withColumnRenamed(NODE, "src") if not hashes else freed.select(
            "*", *_merkle(sums)).withColumnRenamed(NODE, "src")
        met = [t.join(out, [D, "src"]) for t in (open_links, hubs) if t is not None]
        sent = [F.sum(F.xxhash64(F.lit(i + 3), *_VALUE).cast("decimal(38,0)")).alias(s) for i, s in enumerate(sums)]
        return reduce(DataFrame.unionByName, [t.select(D, F.col("dst").alias(NODE), *[c for c in ("level", *_VALUE) if c in out.columns]) for t in met]).groupBy(*keys).agg(
            F.count(F.lit(1)).alias("n"), *also, *sent)

    freed = state.where("ins = 0").select(*keys, F.lit(0).alias("level"), *nothing)
    need = state.where(inner).select(*keys, F.col("ins").alias("left"), *nothing)
    done = _Tiers(keys, "done")
    done.add(freed)
    counters = _Tiers(keys, "open", lambda t: t.groupBy(*keys).agg(F.max_by(F.struct("left", "level", *sums), "level").alias("x")).select(*keys, "x.*"))
    free, waiting, based, level = n["free"], n["waiting"], n["waiting"], 0
    while free and waiting:
        level += 1
        hit = messages(links, freed, [])
        now = hit.join(need.select(*keys, F.struct("left", *sums).alias("c0")), keys)
        latest = [F.col("c0")]
        for i, table in enumerate(reversed(counters.tables)):  # oldest first
            now = now.join(table.select(*keys, F.struct("left", *sums).alias(f"c{i + 1}")), keys, "left")
            latest.insert(0, F.col(f"c{i + 1}"))
        now = now.withColumn("c", F.coalesce(*latest)).select(
            *keys, (F.col("c.left") - F.col("n")).alias("left"), F.lit(level).alias("level"), *[(F.col(f"c.{s}") + F.col(s)).cast("decimal(38,0)").alias(s) for s in sums])
        touched, n = _written(now, keys, "round", free=F.count_if(F.col("left") == 0), rest=F.count_if(F.col("left") > 0))
        freed, free = touched.where("left = 0").drop("left"), n["free"]
        waiting -= free
        if free:
            done.add(freed)
        if n["rest"]:
            counters.add(touched.where("left > 0"))
        if waiting and level % TIER == 0 and 2 * waiting < based:
            for table in done.tables:
                need = need.join(table.select(*keys), keys, "left_anti")
            need = bucketed(need, keys, "waiting")
            links = bucketed(links.join(need.select(D, F.col(NODE).alias("dst")), [D, "dst"], "left_semi"), [D, "src"], "links")
            based = waiting
    freed = reduce(DataFrame.unionByName, done.tables)
    far = messages(all_links, freed, [F.max("level").alias("last")])
    last = state.where("ins > 0 AND outs = 0").join(far, keys).where("n = ins").select(
        *keys, (F.col("last") + 1).alias("level"), *sums).withColumnsRenamed({c: f"_{c}" for c in ("level", *sums)})
    both = state.select(*keys).join(freed, keys, "left").join(last, keys, "left")
    out = both.select(*keys, *[F.coalesce(c, f"_{c}").alias(c) for c in ("level", *sums)])
    values = [F.when(F.col("level").isNotNull(), v).alias(n) for v, n in zip(_merkle(sums), _VALUE)] if hashes else []
    return out.select(*keys, "level", *values)


def peel(nodes: DataFrame, edges: DataFrame, *, from_leaves: bool = False) -> DataFrame:
    """``(design_name, module_name, level)`` by removing free nodes round by round.

    From the roots, ``level`` is the longest path from any root (a
    topological level); from the leaves it is the longest path below the node
    (its depth). Nodes on or behind a cycle never become free: their level is
    NULL. Ends of edges are nodes, whether ``nodes`` lists them or not.
    """
    small, some, links = _by_size(nodes, edges)
    out = [] if small is None else [small.mapInArrow(small_graphs.peel(from_leaves), f"{D} string, module_name string, level int")]
    if some is not None:
        out.append(_waves(some, links, from_leaves=from_leaves).withColumnRenamed(NODE, "module_name"))
    return reduce(DataFrame.unionByName, out)


def is_dag(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``(design_name, is_dag, n_cyclic)``; a node without a topological level lies on or behind a cycle."""
    return peel(nodes, edges).groupBy(D).agg(
        F.count_if(F.col("level").isNull()).alias("n_cyclic")
    ).select(D, (F.col("n_cyclic") == 0).alias("is_dag"), "n_cyclic")


def top_modules(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Modules nobody instantiates."""
    children = edges.select(D, F.col("child").alias("module_name"))
    return nodes.select(D, "module_name").distinct().join(children, [D, "module_name"], "left_anti")


def topological_order(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Modules with their level (longest path from a root); order by (level, name) is topological."""
    return peel(nodes, edges)


def depths(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``(design_name, module_name, depth)``: longest path, in edges, below each module."""
    return peel(nodes, edges, from_leaves=True).withColumnRenamed("level", "depth")


def subgraph_sizes(closed: DataFrame, edges: DataFrame) -> DataFrame:
    """``(design_name, root, n_nodes, n_edges)``.

    A descendant's children are descendants too, so the edges of a sub-graph
    are the out-edges of its nodes: out-degrees are summed, no edge list is joined.
    """
    degree = edges.select(D, "parent", "child").distinct().groupBy(D, F.col("parent").alias(NODE)).agg(
        F.count(F.lit(1)).alias("_deg"))
    return (
        closed.join(degree, [D, NODE], "left").groupBy(D, ROOT)
        .agg(F.count(F.lit(1)).alias("n_nodes"), F.coalesce(F.sum("_deg"), F.lit(0)).alias("n_edges"))
    )


def root_of_subgraph(closed: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes with no incoming edge inside each sub-graph; anything but one is an error.

    An edge into a non-root node of a closure starts inside it by
    construction, so only edges back into the root need checking.
    """
    back = (
        closed.select(D, ROOT, NODE).join(
            edges.select(D, F.col("parent").alias(NODE), F.col("child").alias(ROOT)).distinct(), [D, ROOT, NODE])
        .select(D, ROOT).distinct().withColumn("_back", F.lit(True))
    )
    return (
        closed.select(D, ROOT).distinct().join(back, [D, ROOT], "left")
        .select(D, ROOT, F.when(F.col("_back"), "no_unique_root").otherwise("ok").alias("status"))
    )


def top_scores(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Heuristic score of every top module: (depth+1)(nodes+1)(edges+1), and its share per design.

    Only top modules are closed over, not all modules.
    """
    nodes, edges = checkpoint(nodes), checkpoint(edges)  # each is read several times
    tops = checkpoint(top_modules(nodes, edges))
    sizes = subgraph_sizes(closure(nodes, edges, tops), edges).withColumnRenamed(ROOT, "module_name")
    # read twice below: for the rows and for their sum
    scored = checkpoint(
        sizes.join(depths(nodes, edges), [D, "module_name"])
        .select(
            D, "module_name", F.col("depth").cast("long").alias("depth"), "n_nodes", "n_edges",
            ((F.col("depth") + 1) * (F.col("n_nodes") + 1) * (F.col("n_edges") + 1)).cast("long").alias("raw_score"),
        )
    )
    # tops of one design are summed by key and joined back: no per-design window
    total = scored.groupBy(D).agg(F.sum("raw_score").alias("_total"))
    return scored.join(total, D).withColumn("score", F.col("raw_score") / F.col("_total")).drop("_total")


def auto_top(scores: DataFrame) -> DataFrame:
    """Highest-scoring top module per design; equal best scores are a ``tie``."""
    return top_one(scores, D, "module_name", "raw_score")


def resolve_top(nodes: DataFrame, edges: DataFrame, *, allow_auto: bool = True) -> DataFrame:
    """The only top module of a design, else the scored choice, else an error status."""
    nodes, edges = checkpoint(nodes), checkpoint(edges)  # each is read several times
    tops = top_modules(nodes, edges).groupBy(D).agg(
        F.count(F.lit(1)).alias("n_tops"), F.min("module_name").alias("_only"))
    single = tops.filter("n_tops = 1").select(
        D, "n_tops", F.col("_only").alias("module_name"), F.lit("single").alias("status"))
    several = tops.filter("n_tops > 1")
    if not allow_auto:
        rest = several.select(D, "n_tops", F.lit(None).cast("string").alias("module_name"),
                              F.lit("multiple_tops").alias("status"))
    else:
        # score only the designs that need it
        some_nodes = nodes.join(several.select(D), D, "left_semi")
        some_edges = edges.join(several.select(D), D, "left_semi")
        picked = auto_top(top_scores(some_nodes, some_edges))
        rest = several.join(picked, D).select(
            D, "n_tops", "module_name",
            F.when(F.col("status") == "ok", "auto").otherwise(F.col("status")).alias("status"))
    return single.unionByName(rest)


def hierarchy_diff(left_nodes: DataFrame, left_edges: DataFrame, right_nodes: DataFrame, right_edges: DataFrame) -> DataFrame:
    """Per design, whether two hierarchies have equal node and edge sets.

    Names are unique in a design, so isomorphism with equal names is set
    equality. One aggregation over tagged items; an item seen on one side only
    is a difference.
    """
    def items(nodes: DataFrame, edges: DataFrame, side: int) -> DataFrame:
        n = nodes.select(D, F.lit("").alias("a"), F.col("module_name").alias("b"))
        e = edges.select(D, F.col("parent").alias("a"), F.col("child").alias("b"))
        return n.unionByName(e).withColumn("side", F.lit(side))

    seen = items(left_nodes, left_edges, 1).unionByName(items(right_nodes, right_edges, 2)).groupBy(D, "a", "b").agg(
        F.bit_or("side").alias("sides"))
    return seen.groupBy(D).agg(
        F.count_if(F.col("sides") == 1).alias("only_left"), F.count_if(F.col("sides") == 2).alias("only_right"),
    ).withColumn("equal", (F.col("only_left") == 0) & (F.col("only_right") == 0))


def sub_designs(nodes: DataFrame) -> DataFrame:
    """Sub-designs per design: one per module, since closures of a named DAG differ. No closure is built."""
    return nodes.select(D, "module_name").distinct().groupBy(D).agg(F.count(F.lit(1)).alias("num_sub_designs"))


def fingerprints(closed: DataFrame, edges: DataFrame) -> DataFrame:
    """``(design_name, root, n_nodes, n_edges, fingerprint)`` of each sub-graph.

    The fingerprint adds up 64-bit hashes of the items (three seeds): the sum
    needs no order, so items combine on the map side and no sub-graph is
    collected in one place.
    """
    def parts(*item):
        return [F.xxhash64(F.lit(s), *item).cast("decimal(20,0)") for s in (1, 2, 3)]

    per_node = edges.select(D, F.col("parent").alias(NODE), "child").distinct()
    edge_sums = per_node.groupBy(D, NODE).agg(
        F.count(F.lit(1)).alias("_deg"),
        *[F.sum(p).alias(f"_e{i}") for i, p in enumerate(parts(F.col(NODE), F.lit(">"), F.col("child")))],
    )
    node_parts = parts(F.col(NODE))
    zero = F.lit(0).cast("decimal(30,0)")
    joined = closed.join(edge_sums, [D, NODE], "left")
    return joined.groupBy(D, ROOT).agg(
        F.count(F.lit(1)).alias("n_nodes"),
        F.coalesce(F.sum("_deg"), F.lit(0)).alias("n_edges"),
        *[F.sum(p + F.coalesce(f"_e{i}", zero)).alias(f"_f{i}") for i, p in enumerate(node_parts)],
    ).select(D, ROOT, "n_nodes", "n_edges", F.concat_ws(":", "_f0", "_f1", "_f2").alias("fingerprint"))


def shared_sub_designs(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``(root, n_nodes, n_edges, n_occurrences)``: corpus-wide distinct sub-designs and how many designs hold each.

    Sub-designs are equal where their root's name and its children's sub-designs
    are, so every module gets a hash of its name and its children's hashes, from the
    leaves up. Only one design of each distinct hash is closed over, for its size.
    Modules on or above a cycle have no such hash: their closures are compared.
    """
    edges = checkpoint(edges)
    found = materialize(_waves(nodes, edges, from_leaves=True, hashes=True), "hashes")
    kinds = materialize(found.where("level IS NOT NULL").groupBy(*_VALUE).agg(
        F.min(F.struct(D, NODE)).alias("one"), F.count(F.lit(1)).alias("n_occurrences")).select("one.*", "n_occurrences"), "kinds")
    ones = kinds.select(D, F.col(NODE).alias("module_name"))
    some = checkpoint(edges.join(ones.select(D).distinct(), D, "left_semi"))
    sizes = subgraph_sizes(closure(ones, some), some)
    out = sizes.join(kinds.withColumnRenamed(NODE, ROOT), [D, ROOT]).select(ROOT, "n_nodes", "n_edges", "n_occurrences")
    stuck = found.where("level IS NULL").select(D, F.col(NODE).alias("module_name"))
    if stuck.isEmpty():
        return out
    own = edges.join(stuck.select(D).distinct(), D, "left_semi")
    return out.unionByName(dedup_sub_designs(fingerprints(closure(stuck, own), own)).drop("fingerprint"))


def dedup_sub_designs(prints: DataFrame) -> DataFrame:
    """Corpus-wide distinct sub-designs and how many designs hold each."""
    return prints.groupBy("fingerprint", ROOT, "n_nodes", "n_edges").agg(F.count(F.lit(1)).alias("n_occurrences"))


def modules_outside(closed: DataFrame, nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """``(design_name, root, module_name)``: modules of the design that a chosen root does not reach."""
    pairs = roots.select(D, F.col("module_name").alias(ROOT)).distinct().join(nodes.select(D, "module_name").distinct(), D)
    return pairs.join(
        closed.select(D, ROOT, F.col(NODE).alias("module_name")), [D, ROOT, "module_name"], "left_anti")


def trace(connections: DataFrame, starts: DataFrame) -> DataFrame:
    """``(design_name, port, signal)``: every signal reachable from each start, start included."""
    edges = connections.select(D, F.col("source").alias("parent"), F.col("target").alias("child"))
    roots = starts.select(D, F.col("name").alias("module_name"))
    return closure(roots, edges).select(D, F.col(ROOT).alias("port"), F.col(NODE).alias("signal"))
