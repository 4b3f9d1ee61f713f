"""Queries over tool outputs: netlists, processes, connectivity, syntax trees; clock candidates."""

import uuid

from pyspark.sql import functions as F

from gatelake.functions import text as X
from gatelake.operators import ast, connectivity, netlist, rtlil
from gatelake.operators import graph
from gatelake.plans.registry import query
from gatelake.session import materialize, shared_dir
from gatelake.sources import sinks

_NM = """raw AS (SELECT design_name, unnest(map_entries(CAST(json_extract(json, '$.modules') AS MAP(VARCHAR, JSON)))) AS e FROM netlist_json),
  nmod AS (SELECT design_name, e.key AS module, json_extract_string(e.value, '$.attributes.hdlname') AS hdlname, e.value AS m FROM raw),
  ncell AS (SELECT design_name, module, c.key AS cell, json_extract_string(c.value, '$.type') AS type FROM
     (SELECT design_name, module, unnest(map_entries(CAST(json_extract(m, '$.cells') AS MAP(VARCHAR, JSON)))) AS c FROM nmod) x)"""


@query("netlist_modules", f"WITH {_NM} SELECT design_name, module, hdlname FROM nmod", ("netlist_json",))
def netlist_modules(src):
    return netlist.netlist_modules(src("netlist_json")).drop("cells")


@query("netlist_cells", f"WITH {_NM} SELECT * FROM ncell", ("netlist_json",))
def netlist_cells(src):
    return netlist.netlist_cells(src("netlist_json"))


@query(
    "module_cells_semi_join",
    f"WITH {_NM} SELECT * FROM ncell c WHERE EXISTS (SELECT 1 FROM nmod m WHERE m.design_name = c.design_name AND m.module = c.type)",
    ("netlist_json",))
def module_cells(src):
    n = src("netlist_json")
    return netlist.module_cells(netlist.netlist_cells(n), netlist.netlist_modules(n)).select("design_name", "module", "cell", "type")


@query("hdlname_mapping", f"WITH {_NM} SELECT design_name, module, coalesce(hdlname, module) AS base FROM nmod", ("netlist_json",))
def hdlname_mapping(src):
    return netlist.hdl_names(netlist.netlist_modules(src("netlist_json"))).select("design_name", "module", "base")


@query(
    "netlist_instances",
    f"""WITH {_NM} SELECT DISTINCT c.design_name, coalesce(p.hdlname, p.module) AS parent, coalesce(t.hdlname, t.module) AS child
        FROM ncell c JOIN nmod p ON p.design_name = c.design_name AND p.module = c.module
        JOIN nmod t ON t.design_name = c.design_name AND t.module = c.type""",
    ("netlist_json",))
def netlist_instances(src):
    return netlist.netlist_instances(src("netlist_json"))[1]


@query(
    "empty_netlists",
    "SELECT design_name, 'no_modules' AS status FROM netlist_json WHERE design_name LIKE 'vtr%'", ("netlist_json",))
def empty_netlists(src):
    emptied = src("netlist_json").withColumn(
        "json", F.when(F.col("design_name").like("vtr%"), F.lit('{"modules":{}}')).otherwise(F.col("json")))
    return netlist.empty_netlists(emptied)


@query(
    "decompose_structured",
    """WITH RECURSIVE walk AS (SELECT design_name, module_name AS root, module_name AS node FROM modules UNION
       SELECT w.design_name, w.root, i.child FROM walk w JOIN inst i ON i.design_name = w.design_name AND i.parent = w.node)
       SELECT design_name, root, node AS module_name FROM walk""",
    ("modules", "inst"))
def decompose_structured(src):
    from gatelake.operators.decompose import decompose_structured as parts

    nodes, edges = netlist.netlist_instances(src("netlist_json"))
    return parts(graph.closure(nodes, edges))


@query(
    "sub_design_cells",
    f"""WITH RECURSIVE {_NM}, walk AS (SELECT design_name, module_name AS root, module_name AS node FROM modules UNION
       SELECT w.design_name, w.root, i.child FROM walk w JOIN inst i ON i.design_name = w.design_name AND i.parent = w.node)
       SELECT w.design_name, w.root, w.node AS module_name, c.cell, c.type FROM walk w
       JOIN nmod m ON m.design_name = w.design_name AND coalesce(m.hdlname, m.module) = w.node
       LEFT JOIN ncell c ON c.design_name = m.design_name AND c.module = m.module""",
    ("modules", "inst", "netlist_json"))
def sub_design_cells(src):
    netlists = materialize(src("netlist_json"), "netlists")  # read for the hierarchy and for the cells
    nodes, edges = netlist.netlist_instances(netlists)
    return netlist.structured_parts(netlists, graph.closure(nodes, edges))


_STAT = [  # path and the value's SQL, four levels deep, with an array and a key that holds a dot
    ("creator", "'gen'"), ("k", "CAST(event_id % 7 AS VARCHAR)"), ("design.kind", "event_type"), ("design.none", "NULL"), ("design.ok", "'true'"),
    ("modules.top.num_cells", "CAST(event_id % 5 AS VARCHAR)"), ("modules.top.num_cells_by_type.$add", "CAST(event_id % 3 AS VARCHAR)"),
    ("modules.top.num_cells_by_type.a\\.b", "'2.50'"), ("modules.top.sizes.0", "CAST(event_id AS VARCHAR)"), ("modules.top.sizes.1.deep.x", "'y'"),
    ("modules.top.empty", "'{}'"),
]
_STAT_ROWS = " UNION ALL ".join(
    f"SELECT CAST(event_id AS VARCHAR) AS design_name, '{path.replace(chr(92) * 2, chr(92))}' AS path, {value} AS value FROM events" for path, value in _STAT)


@query("stat_flatten", _STAT_ROWS)
def stat_flatten(src):
    n = lambda m: (F.col("event_id") % m).cast("string")
    doc = F.concat(
        F.lit('{"creator": "gen", "k": '), n(7), F.lit(', "design": {"kind": "'), "event_type", F.lit('", "none": null, "ok": true}, "modules": {"top": {"num_cells": '),
        n(5), F.lit(', "num_cells_by_type": {"$add": '), n(3), F.lit(', "a.b": 2.50}, "sizes": ['), F.col("event_id").cast("string"),
        F.lit(', {"deep": {"x": "y"}}], "empty": {}}}}'))
    return netlist.stat_metrics(src("events").select(F.col("event_id").cast("string").alias("design_name"), doc.alias("json")))


@query(
    "module_list", "SELECT design_name, module_name FROM modules", ("modules",))
def module_list(src):
    listed = src("mods").select(
        "design_name", F.concat(F.lit("\n2 modules:\n  m"), F.col("n").cast("string"), F.lit(" \n\n")).alias("listing"))
    return netlist.module_list(listed)


# ------------------------------------------------------------------ processes and clocks
_SY = r"""blocks AS (SELECT design_name, unnest(list_zip(regexp_extract_all(rtlil, '(?s)process (.*?)\n(.*?)\nend', 1),
    regexp_extract_all(rtlil, '(?s)process (.*?)\n(.*?)\nend', 2))) AS b FROM rtlil),
  syncs AS (SELECT design_name, e[2] AS signal, process, e[1] AS edge FROM (SELECT design_name, trim(b[1]) AS process,
    unnest(list_zip(regexp_extract_all(b[2], 'sync (posedge|negedge) (\\\S+)', 1), regexp_extract_all(b[2], 'sync (posedge|negedge) (\\\S+)', 2))) AS e FROM blocks) x),
  conns AS (SELECT design_name, c[1] AS source, c[2] AS target FROM (SELECT design_name, unnest(list_zip(
    regexp_extract_all(rtlil, 'connect\s+\\(\S+)\s+\\(\S+)', 2), regexp_extract_all(rtlil, 'connect\s+\\(\S+)\s+\\(\S+)', 1))) AS c FROM rtlil) x),
  port_lines AS (SELECT design_name, trim(unnest(string_split(portlist, chr(10)))) AS l FROM rtlil),
  ports AS (SELECT design_name, regexp_extract(l, '^(input|output)\s+\[(\d+):(\d+)\]\s+(\w+)', 1) AS direction,
    regexp_extract(l, '^(input|output)\s+\[(\d+):(\d+)\]\s+(\w+)', 4) AS name,
    CAST(regexp_extract(l, '^(input|output)\s+\[(\d+):(\d+)\]\s+(\w+)', 2) AS INT) AS msb,
    CAST(regexp_extract(l, '^(input|output)\s+\[(\d+):(\d+)\]\s+(\w+)', 3) AS INT) AS lsb FROM port_lines
    WHERE regexp_matches(l, '^(input|output)\s+\[(\d+):(\d+)\]\s+(\w+)'))"""
_TRACE = """traced AS (SELECT DISTINCT design_name, name AS port, name AS signal FROM ports WHERE direction = 'input' AND msb = lsb
    UNION SELECT t.design_name, t.port, c.target FROM traced t JOIN conns c ON c.design_name = t.design_name AND c.source = t.signal),
  hit AS (SELECT DISTINCT t.design_name, t.port FROM traced t JOIN syncs s ON s.design_name = t.design_name
    AND t.signal = ltrim(s.signal, chr(92)))"""


@query("parse_syncs", f"WITH {_SY} SELECT * FROM syncs", ("rtlil",))
def parse_syncs(src):
    return rtlil.parse_syncs(src("rtlil"))


@query(
    "parse_ports",
    f"WITH {_SY} SELECT *, '[' || msb || ':' || lsb || ']' AS width, msb = lsb AS is_single_bit FROM ports", ("rtlil",))
def parse_ports(src):
    return rtlil.parse_ports(src("rtlil"))


@query("parse_connections", f"WITH {_SY} SELECT * FROM conns", ("rtlil",))
def parse_connections(src):
    return rtlil.parse_connections(src("rtlil"))


@query("single_bit_inputs", f"WITH {_SY} SELECT design_name, name FROM ports WHERE direction = 'input' AND msb = lsb", ("rtlil",))
def single_bit_inputs(src):
    return rtlil.single_bit_inputs(rtlil.parse_ports(src("rtlil"))).select("design_name", "name")


@query("trace_signal", f"WITH RECURSIVE {_SY}, {_TRACE} SELECT * FROM traced", ("rtlil",))
def trace_signal(src):
    r = src("rtlil")
    return graph.trace(rtlil.parse_connections(r), rtlil.single_bit_inputs(rtlil.parse_ports(r)))


@query("sync_trace_semi_join", f"WITH RECURSIVE {_SY}, {_TRACE} SELECT * FROM hit", ("rtlil",))
def sync_trace(src):
    r = src("rtlil")
    traced = graph.trace(rtlil.parse_connections(r), rtlil.single_bit_inputs(rtlil.parse_ports(r)))
    return rtlil.ports_reaching_sync(traced, rtlil.parse_syncs(r))


@query(
    "clock_candidates",
    f"""WITH RECURSIVE {_SY}, {_TRACE} SELECT design_name, port AS candidate FROM hit
        WHERE NOT regexp_matches(lower(port), '(^|_)(rst|reset|en|enable|rdy|ready|vld|valid)(_|$)')""",
    ("rtlil",))
def clock_candidates(src):
    return rtlil.clock_candidates(src("rtlil"))


@query(
    "clock_name_filter",
    """SELECT page_id, name FROM (SELECT page_id, CASE page_id % 8 WHEN 0 THEN 'rst_' || page_id WHEN 1 THEN 'clk' || page_id
       WHEN 2 THEN 'a_EN' WHEN 3 THEN 'first' WHEN 4 THEN 'x_valid_y' WHEN 5 THEN 'READY' WHEN 6 THEN 'envelope' ELSE 'clk_en_' || host END AS name
       FROM member_paths) t WHERE NOT (lower(name) LIKE 'rst^_%' ESCAPE '^' OR lower(name) LIKE '%^_en' ESCAPE '^'
       OR lower(name) LIKE '%^_valid^_%' ESCAPE '^' OR lower(name) = 'ready' OR lower(name) LIKE '%^_en^_%' ESCAPE '^')""",
    ("member_paths",))
def clock_name_filter(src):
    k = F.col("page_id") % 8
    p = F.col("page_id").cast("string")
    name = (F.when(k == 0, F.concat(F.lit("rst_"), p)).when(k == 1, F.concat(F.lit("clk"), p)).when(k == 2, "a_EN")
            .when(k == 3, "first").when(k == 4, "x_valid_y").when(k == 5, "READY").when(k == 6, "envelope")
            .otherwise(F.concat(F.lit("clk_en_"), "host")))
    return src("member_paths").select("page_id", name.alias("name")).filter(X.clock_like(F.col("name")))


# ------------------------------------------------------------------ connectivity
_CR = """cr AS (SELECT design_name, row_idx, p[1] AS module_name, p[2] AS cell_name, p[3] AS cell_type, p[4] AS cell_port,
  p[5] AS direction, p[6] AS signal FROM (SELECT design_name, row_idx, string_split(line, chr(9)) AS p FROM connectivity) x)"""


@query("scan_connectivity", f"WITH {_CR} SELECT * FROM cr", ("connectivity",))
def scan_connectivity(src):
    return connectivity.parse_rows(src("connectivity"))


@query(
    "scan_connectivity_files",
    f"WITH {_CR} SELECT module_name, cell_name, cell_type, cell_port, direction, signal FROM cr", ("connectivity",))
def scan_connectivity_files(src):
    path = sinks.write_text(src("connectivity"), "connectivity", "line")
    return connectivity.scan_connectivity(src.spark, path).drop("design_name", "row_idx")


@query(
    "connectivity_nodes",
    f"""WITH {_CR}, n AS (SELECT design_name, cell_name AS node, false AS s, row_idx, cell_type, module_name FROM cr
        UNION ALL SELECT design_name, signal, true, NULL, NULL, NULL FROM cr)
        SELECT design_name, node, CASE WHEN bool_or(s) THEN 'signal' ELSE 'cell' END AS node_type,
        arg_max(cell_type, row_idx) AS cell_type, arg_max(module_name, row_idx) AS module_name FROM n GROUP BY design_name, node""",
    ("connectivity",))
def connectivity_nodes(src):
    return connectivity.connectivity_nodes(connectivity.parse_rows(src("connectivity")))


@query(
    "connectivity_edges",
    f"""WITH {_CR}, e AS (SELECT design_name, row_idx, signal AS source, cell_name AS target, cell_port, direction FROM cr
        WHERE direction IN ('in', 'pi', 'inout', 'pio') UNION ALL SELECT design_name, row_idx, cell_name, signal, cell_port, direction
        FROM cr WHERE direction IN ('out', 'po', 'inout', 'pio'))
        SELECT design_name, source, target, cell_port, direction FROM (SELECT *, row_number() OVER (PARTITION BY design_name, source, target
        ORDER BY row_idx DESC) AS rn FROM e) x WHERE rn = 1""",
    ("connectivity",))
def connectivity_edges(src):
    return connectivity.connectivity_edges(connectivity.parse_rows(src("connectivity")))


@query(
    "connectivity_unknown_direction",
    f"WITH {_CR} SELECT design_name, row_idx, 'unknown direction: ' || direction AS detail FROM cr WHERE direction = 'weird'", ("connectivity",))
def connectivity_unknown(src):
    return connectivity.unknown_directions(connectivity.parse_rows(src("connectivity")))


# ------------------------------------------------------------------ syntax trees
# the checking SQL parses the documents itself; a node's place among its ancestors' children orders it
_AST = """walk AS (SELECT design_name, file_name, json_extract(json, '$."f.v".tree') AS node, CAST([] AS INT[]) AS pos FROM ast_json
    UNION ALL SELECT design_name, file_name, list_extract(kids, CAST(i AS BIGINT)) AS node, list_append(pos, CAST(i AS INT)) FROM (
      SELECT design_name, file_name, pos, kids, unnest(range(1, len(kids) + 1)) AS i FROM (
        SELECT design_name, file_name, pos, list_filter(json_extract(node, '$.children[*]'), lambda c: json_type(c) <> 'NULL') AS kids FROM walk) x) y),
  ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY design_name, file_name ORDER BY pos) - 1 AS INT) AS idx FROM walk),
  tree AS (SELECT r.design_name, r.file_name, r.idx, p.idx AS parent_idx, CAST(len(r.pos) AS INT) AS depth, json_extract_string(r.node, '$.tag') AS tag,
    json_extract_string(r.node, '$.text') AS name, CAST(json_extract_string(r.node, '$.start') AS INT) AS start_at
    FROM ranked r LEFT JOIN ranked p ON p.design_name = r.design_name AND p.file_name = r.file_name AND len(r.pos) > 0 AND p.pos = r.pos[:len(r.pos) - 1]),
  te AS (SELECT design_name, file_name, idx - 1 AS src, idx AS dst, 'nco' AS t_edge_type, 1 AS prio FROM tree WHERE idx > 0
    UNION ALL SELECT design_name, file_name, idx, idx - 1, 'nco_reverse', 1 FROM tree WHERE idx > 0
    UNION ALL SELECT design_name, file_name, parent_idx, idx, 'ast', 0 FROM tree WHERE parent_idx IS NOT NULL
    UNION ALL SELECT design_name, file_name, idx, parent_idx, 'ast_reverse', 0 FROM tree WHERE parent_idx IS NOT NULL),
  edges AS (SELECT design_name, file_name, src, dst, t_edge_type FROM (SELECT *, row_number() OVER (PARTITION BY design_name, file_name, src, dst
    ORDER BY prio DESC) AS rn FROM te) x WHERE rn = 1)"""


@query("ast_flatten", f"WITH RECURSIVE {_AST} SELECT *, 'ok' AS status FROM tree", ("ast_json",))
def ast_flatten(src):
    return ast.ast_nodes(src("ast_json"), attrs=False, fields={"name": "text", "start_at": "start"}).withColumn("start_at", F.col("start_at").cast("int"))


@query("ast_edges", f"WITH RECURSIVE {_AST} SELECT * FROM edges", ("ast_json",))
def ast_edges(src):
    return ast.ast_edges(ast.ast_nodes(src("ast_json"), attrs=False))


@query("ast_edges_multi", f"WITH RECURSIVE {_AST} SELECT design_name, file_name, src, dst, t_edge_type FROM te", ("ast_json",))
def ast_edges_multi(src):
    return ast.ast_edges(ast.ast_nodes(src("ast_json"), attrs=False), multi=True)


@query(
    "graph_stats",
    f"""WITH RECURSIVE {_AST}, e AS (SELECT design_name, file_name, count(*) AS n_edges FROM edges GROUP BY ALL)
        SELECT t.design_name, t.file_name, count(*) AS n_nodes, any_value(e.n_edges) AS n_edges FROM tree t
        JOIN e ON e.design_name = t.design_name AND e.file_name = t.file_name GROUP BY t.design_name, t.file_name""",
    ("ast_json",))
def graph_stats(src):
    return ast.graph_counts(ast.ast_edges(ast.ast_nodes(src("ast_json"), attrs=False), nested=True))


@query(
    "tree_distances",
    f"""WITH RECURSIVE {_AST}, up AS (SELECT design_name, file_name, idx AS a, idx AS b, 0 AS k FROM tree UNION ALL
          SELECT u.design_name, u.file_name, u.a, t.parent_idx, u.k + 1 FROM up u JOIN tree t ON t.design_name = u.design_name
          AND t.file_name = u.file_name AND t.idx = u.b WHERE t.parent_idx IS NOT NULL),
        dist AS (SELECT x.design_name, x.file_name, x.a, y.a AS b, min(x.k + y.k) AS d FROM up x JOIN up y ON x.design_name = y.design_name
          AND x.file_name = y.file_name AND x.b = y.b GROUP BY ALL)
        SELECT design_name, file_name, CAST(max(d) AS BIGINT) AS diameter, round(avg(d), 9) AS mean_distance FROM dist GROUP BY ALL""",
    ("ast_json",))
def tree_distances(src):
    return ast.tree_distances(src("ast_json")).withColumn("mean_distance", F.round("mean_distance", 9))


_NODES = f"""n AS (SELECT design_name, cell_name AS node, false AS s, row_idx, cell_type, module_name FROM cr
        UNION ALL SELECT design_name, signal, true, NULL, NULL, NULL FROM cr),
      nodes AS (SELECT design_name, node, CASE WHEN bool_or(s) THEN 'signal' ELSE 'cell' END AS node_type,
        arg_max(cell_type, row_idx) AS cell_type, arg_max(module_name, row_idx) AS module_name FROM n GROUP BY design_name, node)"""
_EDGES = """e AS (SELECT design_name, row_idx, signal AS source, cell_name AS target, cell_port, direction FROM cr
        WHERE direction IN ('in', 'pi', 'inout', 'pio') UNION ALL SELECT design_name, row_idx, cell_name, signal, cell_port, direction
        FROM cr WHERE direction IN ('out', 'po', 'inout', 'pio')),
      edges AS (SELECT design_name, source, target, cell_port, direction FROM (SELECT *, row_number() OVER (PARTITION BY design_name, source, target
        ORDER BY row_idx DESC) AS rn FROM e) x WHERE rn = 1)"""
_GRAPH = """SELECT design_name, 'node' AS kind, node AS a, node_type AS b, cell_type AS c, module_name AS d FROM nodes
      UNION ALL SELECT design_name, 'edge', source, target, cell_port, direction FROM edges"""


@query("graph_json_sink", f"WITH {_CR}, {_NODES}, {_EDGES} {_GRAPH}", ("connectivity",))
def graph_json_sink(src):
    rows = connectivity.parse_rows(src("connectivity"))
    nodes = connectivity.connectivity_nodes(rows).withColumnRenamed("node", "id")
    records = sinks.graph_records(nodes, connectivity.connectivity_edges(rows))
    back = src.spark.read.json(sinks.write_json(records, "graph"))
    item = F.from_json("json", "id string, node_type string, cell_type string, module_name string, source string, target string, cell_port string, direction string")
    node = F.col("kind") == "node"
    either = lambda x, y: F.when(node, F.col(f"i.{x}")).otherwise(F.col(f"i.{y}"))
    return back.select("design_name", "kind", item.alias("i")).select(
        "design_name", "kind", either("id", "source").alias("a"), either("node_type", "target").alias("b"),
        either("cell_type", "cell_port").alias("c"), either("module_name", "direction").alias("d"))


@query(
    "connectivity_files_graph",
    f"""WITH cr AS (SELECT 'g' || CAST((row_idx // 100) % 16 AS VARCHAR) AS design_name, CAST(k.i AS BIGINT) * 100000000000 + row_idx AS row_idx,
        p[1] AS module_name, p[2] AS cell_name, CASE k.i WHEN 0 THEN 'early' ELSE p[3] END AS cell_type, p[4] AS cell_port, p[5] AS direction, p[6] AS signal
        FROM (SELECT row_idx, string_split(line, chr(9)) AS p FROM connectivity) x, (VALUES (0), (1)) k(i)),
      {_NODES}, {_EDGES} {_GRAPH}""",
    ("connectivity",))
def connectivity_files_graph(src):
    """From TSV files on disk to the graph: every row twice, first with a type that the later row must replace."""
    lines = src("connectivity").select(
        F.concat(F.lit("g"), ((F.floor(F.col("row_idx") / 100)) % 16).cast("string")).alias("design_name"), "row_idx", F.split("line", "\t").alias("p"))
    early = F.concat(F.slice("p", 1, 2), F.array(F.lit("early")), F.slice("p", 4, 3))
    both = lines.select("design_name", F.explode(F.array(
        F.struct(F.lit(0).alias("i"), "row_idx", F.array_join(early, "\t").alias("line")),
        F.struct(F.lit(1).alias("i"), "row_idx", F.array_join("p", "\t").alias("line")))).alias("x"))
    path = f"{shared_dir(src.spark)}/gatelake/tsv-{uuid.uuid4().hex}"
    both.repartition("design_name").sortWithinPartitions("design_name", "x.i", "x.row_idx").select(
        "design_name", "x.line").write.partitionBy("design_name").text(path)
    rows = materialize(connectivity.scan_connectivity(src.spark, f"{path}/*"), "connectivity")  # for nodes and edges
    nodes, edges = connectivity.connectivity_nodes(rows), connectivity.connectivity_edges(rows)
    return nodes.select("design_name", F.lit("node").alias("kind"), F.col("node").alias("a"), F.col("node_type").alias("b"),
                        F.col("cell_type").alias("c"), F.col("module_name").alias("d")).unionByName(
        edges.select("design_name", F.lit("edge").alias("kind"), F.col("source").alias("a"), F.col("target").alias("b"),
                     F.col("cell_port").alias("c"), F.col("direction").alias("d")))
