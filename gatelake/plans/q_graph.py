"""Queries over module hierarchies."""

from pyspark.sql import functions as F

from gatelake.operators import graph, summary
from gatelake.plans.registry import query
from gatelake.session import materialize

_MI = ("modules", "inst")
_WALK = """RECURSIVE walk AS (SELECT design_name, module_name AS root, module_name AS node, 0 AS level FROM modules
  UNION ALL SELECT w.design_name, w.root, i.child, w.level + 1 FROM walk w JOIN inst i
  ON i.design_name = w.design_name AND i.parent = w.node),
  closed AS (SELECT design_name, root, node, CAST(min(level) AS INT) AS level FROM walk GROUP BY ALL),
  depth AS (SELECT design_name, root, max(level) AS depth FROM walk GROUP BY ALL),
  tops AS (SELECT m.design_name, m.module_name FROM modules m WHERE NOT EXISTS
    (SELECT 1 FROM inst i WHERE i.design_name = m.design_name AND i.child = m.module_name)),
  sizes AS (SELECT c.design_name, c.root, count(DISTINCT c.node) AS n_nodes, count(i.child) AS n_edges FROM closed c
    LEFT JOIN inst i ON i.design_name = c.design_name AND i.parent = c.node GROUP BY ALL),
  raw AS (SELECT t.design_name, t.module_name, d.depth, s.n_nodes, s.n_edges,
    (d.depth + 1) * (s.n_nodes + 1) * (s.n_edges + 1) AS raw_score FROM tops t
    JOIN depth d ON d.design_name = t.design_name AND d.root = t.module_name
    JOIN sizes s ON s.design_name = t.design_name AND s.root = t.module_name),
  ranked AS (SELECT design_name, raw_score, count(*) AS n, min(module_name) AS module_name,
    row_number() OVER (PARTITION BY design_name ORDER BY raw_score DESC) AS rn FROM raw GROUP BY design_name, raw_score),
  auto AS (SELECT design_name, CASE WHEN n = 1 THEN module_name END AS module_name, raw_score,
    CASE WHEN n = 1 THEN 'ok' ELSE 'tie' END AS status FROM ranked WHERE rn = 1)"""


def _sql(body: str) -> str:
    return f"WITH {_WALK} {body}"


def _ni(src):
    return src("modules"), src("inst")


@query("closure", _sql("SELECT * FROM closed"), _MI)
def closure(src):
    return graph.closure(*_ni(src))


# two back edges make every design with m1→m2→m4→m7 (or m1→m3) cyclic
_CYC = """cyc AS (SELECT design_name, parent, child FROM inst UNION ALL
  SELECT DISTINCT design_name, 'm7', 'm4' FROM inst WHERE parent = 'm4' AND child = 'm7' UNION ALL
  SELECT DISTINCT design_name, 'm3', 'm3' FROM inst WHERE child = 'm3')"""


def _cyclic(src):
    inst = src("inst")
    back = inst.filter("parent = 'm4' AND child = 'm7'").select(
        "design_name", F.lit("m7").alias("parent"), F.lit("m4").alias("child"))
    loop = inst.filter("child = 'm3'").select("design_name", F.lit("m3").alias("parent"), F.lit("m3").alias("child")).distinct()
    return inst.unionByName(back).unionByName(loop)


@query(
    "is_dag",
    f"""WITH RECURSIVE {_CYC}, walk AS (SELECT DISTINCT design_name, parent AS root, child AS node FROM cyc UNION
        SELECT w.design_name, w.root, c.child FROM walk w JOIN cyc c ON c.design_name = w.design_name AND c.parent = w.node),
        onc AS (SELECT design_name, root AS x FROM walk WHERE root = node),
        bad AS (SELECT DISTINCT w.design_name, w.node AS x FROM walk w JOIN onc o ON o.design_name = w.design_name AND o.x = w.root)
        SELECT m.design_name, count(b.x) = 0 AS is_dag, count(b.x) AS n_cyclic FROM modules m
        LEFT JOIN bad b ON b.design_name = m.design_name AND b.x = m.module_name GROUP BY m.design_name""",
    _MI,
)
def is_dag(src):
    return graph.is_dag(src("modules"), _cyclic(src))


@query("top_modules", _sql("SELECT design_name, module_name FROM tops"), _MI)
def top_modules(src):
    return graph.top_modules(*_ni(src))


@query(
    "root_of_subgraph",
    f"""WITH RECURSIVE {_CYC}, walk AS (SELECT design_name, module_name AS root, module_name AS node FROM modules UNION
        SELECT w.design_name, w.root, c.child FROM walk w JOIN cyc c ON c.design_name = w.design_name AND c.parent = w.node),
        inner_edges AS (SELECT DISTINCT w.design_name, w.root, c.child FROM walk w JOIN cyc c ON c.design_name = w.design_name AND c.parent = w.node)
        SELECT w.design_name, w.root, CASE WHEN count(*) - count(e.child) = 1 THEN 'ok' ELSE 'no_unique_root' END AS status
        FROM walk w LEFT JOIN inner_edges e ON e.design_name = w.design_name AND e.root = w.root AND e.child = w.node
        GROUP BY w.design_name, w.root""",
    _MI,
)
def root_of_subgraph(src):
    edges = _cyclic(src)
    return graph.root_of_subgraph(graph.closure(src("modules"), edges), edges)


@query("module_depth", _sql("SELECT design_name, root AS module_name, CAST(depth AS INT) AS depth FROM depth"), _MI)
def module_depth(src):
    return graph.depths(*_ni(src))


@query("subgraph_sizes", _sql("SELECT * FROM sizes"), _MI)
def subgraph_sizes(src):
    nodes, edges = _ni(src)
    return graph.subgraph_sizes(graph.closure(nodes, edges), edges)


@query(
    "top_scores",
    _sql("""SELECT design_name, module_name, depth, n_nodes, n_edges, raw_score,
         round(raw_score / sum(raw_score) OVER (PARTITION BY design_name), 9) AS score FROM raw"""), _MI)
def top_scores(src):
    return graph.top_scores(*_ni(src)).withColumn("score", F.round("score", 9))


@query("auto_top", _sql("SELECT * FROM auto"), _MI)
def auto_top(src):
    return graph.auto_top(graph.top_scores(*_ni(src)))


@query(
    "top_one_with_tie",
    """SELECT o_custkey, CASE WHEN n = 1 THEN k END AS o_orderkey, o_orderpriority, CASE WHEN n = 1 THEN 'ok' ELSE 'tie' END AS status FROM
       (SELECT o_custkey, o_orderpriority, count(*) AS n, min(o_orderkey) AS k, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority DESC) AS rn
        FROM orders GROUP BY o_custkey, o_orderpriority) t WHERE rn = 1""",
)
def top_one_with_tie(src):
    return summary.top_one(src("orders"), "o_custkey", "o_orderkey", "o_orderpriority")


@query(
    "topological_level",
    """WITH RECURSIVE walk AS (SELECT m.design_name, m.module_name AS node, 0 AS level FROM modules m WHERE NOT EXISTS
       (SELECT 1 FROM inst i WHERE i.design_name = m.design_name AND i.child = m.module_name)
       UNION ALL SELECT w.design_name, i.child, w.level + 1 FROM walk w JOIN inst i ON i.design_name = w.design_name AND i.parent = w.node)
       SELECT design_name, node AS module_name, CAST(max(level) AS INT) AS level FROM walk GROUP BY ALL""",
    _MI,
)
def topological_level(src):
    return graph.topological_order(*_ni(src))


@query("sub_designs", "SELECT design_name, count(*) AS num_sub_designs FROM modules GROUP BY design_name", ("modules",))
def sub_designs(src):
    return graph.sub_designs(src("modules"))


@query(
    "expansion_factor",
    """WITH t AS (SELECT d.dataset_name, m.design_name, count(*) AS n FROM modules m JOIN hdl_designs d ON d.design_name = m.design_name GROUP BY ALL)
       SELECT coalesce(dataset_name, '*') AS dataset_name, count(*) AS original_designs, CAST(sum(n) AS BIGINT) AS sub_designs,
       round(sum(n) / count(*), 9) AS expansion_factor FROM t GROUP BY GROUPING SETS ((dataset_name), ())""",
    ("modules", "hdl_designs"),
)
def expansion_factor(src):
    counts = graph.sub_designs(src("modules")).join(src("hdl_designs"), "design_name")
    per = summary.expansion_factor(counts, "dataset_name").unionByName(
        summary.expansion_factor(counts).withColumn("dataset_name", F.lit("*")))
    return per.withColumn("expansion_factor", F.round("expansion_factor", 9))


@query(
    "sub_design_dedup",
    _sql("""SELECT root, n_nodes, n_edges, count(*) AS n_occurrences FROM (
        SELECT c.design_name, c.root, (SELECT n_nodes FROM sizes s WHERE s.design_name = c.design_name AND s.root = c.root) AS n_nodes,
        (SELECT n_edges FROM sizes s WHERE s.design_name = c.design_name AND s.root = c.root) AS n_edges,
        string_agg(c.node || '(' || coalesce(k.kids, '') || ')', ';' ORDER BY c.node) AS fp FROM closed c
        LEFT JOIN (SELECT design_name, parent, string_agg(child, ',' ORDER BY child) AS kids FROM inst GROUP BY ALL) k
        ON k.design_name = c.design_name AND k.parent = c.node GROUP BY c.design_name, c.root) t GROUP BY root, n_nodes, n_edges, fp"""),
    _MI,
)
def sub_design_dedup(src):
    return graph.shared_sub_designs(*_ni(src))


@query(
    "modules_outside_closure",
    _sql("""SELECT t.design_name, t.module_name AS root, m.module_name FROM tops t JOIN modules m ON m.design_name = t.design_name
        WHERE NOT EXISTS (SELECT 1 FROM closed c WHERE c.design_name = t.design_name AND c.root = t.module_name AND c.node = m.module_name)"""),
    _MI,
)
def modules_outside_closure(src):
    nodes, edges = (materialize(t, "hierarchy") for t in _ni(src))  # each is read several times
    tops = materialize(graph.top_modules(nodes, edges), "tops")
    return graph.modules_outside(graph.closure(nodes, edges, tops), nodes, tops)


@query(
    "hierarchy_equality",
    """WITH other AS (SELECT * FROM inst WHERE NOT (child = 'm7' AND parent = 'm3')),
       s AS (SELECT design_name, count(*) AS only_left FROM inst WHERE child = 'm7' AND parent = 'm3' GROUP BY ALL)
       SELECT d.design_name, coalesce(s.only_left, 0) AS only_left, CAST(0 AS BIGINT) AS only_right, s.only_left IS NULL AS equal
       FROM (SELECT DISTINCT design_name FROM modules) d LEFT JOIN s USING (design_name)""",
    _MI,
)
def hierarchy_equality(src):
    nodes, edges = _ni(src)
    return graph.hierarchy_diff(nodes, edges, nodes, edges.filter("NOT (child = 'm7' AND parent = 'm3')"))


@query(
    "resolve_top",
    _sql("""SELECT t.design_name, t.n_tops, CASE WHEN t.n_tops = 1 THEN t.only ELSE a.module_name END AS module_name,
        CASE WHEN t.n_tops = 1 THEN 'single' WHEN a.status = 'ok' THEN 'auto' ELSE 'tie' END AS status
        FROM (SELECT design_name, count(*) AS n_tops, min(module_name) AS only FROM tops GROUP BY design_name) t
        JOIN auto a ON a.design_name = t.design_name"""),
    _MI,
)
def resolve_top(src):
    return graph.resolve_top(*_ni(src))


@query(
    "resolve_top_strict",
    _sql("""SELECT design_name, count(*) AS n_tops, CASE WHEN count(*) = 1 THEN min(module_name) END AS module_name,
        CASE WHEN count(*) = 1 THEN 'single' ELSE 'multiple_tops' END AS status FROM tops GROUP BY design_name"""),
    _MI,
)
def resolve_top_strict(src):
    return graph.resolve_top(*_ni(src), allow_auto=False)
