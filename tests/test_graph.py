"""Hierarchies: the four hand-made designs, properties, cycles and hot keys."""

import random

import pytest
from pyspark.sql import functions as F

from gatelake import session
from gatelake.operators import connectivity, decompose, graph, modules, netlist, rtlil
from gatelake.operators.grouping import attach_group_count
from gatelake.sources import sinks

HAND = {
    "h0": {"cnt": [], "sq": ["cnt"], "tri": ["cnt"]},
    "h1": {"a": ["b", "c"], "b": [], "c": []},
    "h2": {"a": ["b", "c"], "b": [], "c": ["d"], "d": []},
    "h3": {"a": ["b", "c"], "a_prime": ["b", "c"], "b": [], "c": []},
}


def frames(spark, designs):
    nodes = [(d, m) for d, g in designs.items() for m in g]
    edges = [(d, m, c) for d, g in designs.items() for m, cs in g.items() for c in cs]
    return (spark.createDataFrame(nodes, "design_name string, module_name string"),
            spark.createDataFrame(edges, "design_name string, parent string, child string"))


def test_hand_made_scores(spark):
    nodes, edges = frames(spark, HAND)
    rows = {(r.design_name, r.module_name): r for r in graph.top_scores(nodes, edges).collect()}
    assert {k: (r.depth, r.n_nodes, r.n_edges, r.raw_score) for k, r in rows.items()} == {
        ("h0", "sq"): (1, 2, 1, 12), ("h0", "tri"): (1, 2, 1, 12), ("h1", "a"): (1, 3, 2, 24),
        ("h2", "a"): (2, 4, 3, 60), ("h3", "a"): (1, 3, 2, 24), ("h3", "a_prime"): (1, 3, 2, 24)}
    tops = {r.design_name: (r.module_name, r.status) for r in graph.resolve_top(nodes, edges).collect()}
    assert tops == {"h0": (None, "tie"), "h1": ("a", "single"), "h2": ("a", "single"), "h3": (None, "tie")}
    subs = {r.design_name: r.num_sub_designs for r in graph.sub_designs(nodes).collect()}
    assert subs == {"h0": 3, "h1": 3, "h2": 4, "h3": 4}


def random_graphs(n, acyclic):
    rng = random.Random(5)
    out = {}
    for i in range(n):
        k = rng.randint(1, 9)
        out[f"r{i}"] = {f"n{a}": sorted({f"n{rng.randrange(k)}" for _ in range(rng.randint(0, 2))}) for a in range(k)}
        if acyclic:
            out[f"r{i}"] = {m: [c for c in cs if c > m] for m, cs in out[f"r{i}"].items()}
    return out


def reach(g, start):
    seen, todo = {start: 0}, [start]
    while todo:
        m = todo.pop(0)
        for c in g[m]:
            if c not in seen:
                seen[c] = seen[m] + 1
                todo.append(c)
    return seen


@pytest.mark.parametrize("acyclic", [True, False])
def test_closure_matches_search(spark, acyclic):
    designs = random_graphs(30, acyclic)
    nodes, edges = frames(spark, designs)
    got = {(r.design_name, r.root, r.node): r.level for r in graph.closure(nodes, edges).collect()}
    assert got == {(d, m, n): k for d, g in designs.items() for m in g for n, k in reach(g, m).items()}
    cyclic = {d: any(m in {x for c in g[m] for x in reach(g, c)} for m in g) for d, g in designs.items()}
    assert {r.design_name: not r.is_dag for r in graph.is_dag(nodes, edges).collect()} == cyclic


def test_depth_matches_recursion(spark):
    designs = random_graphs(30, True)
    nodes, edges = frames(spark, designs)

    def depth(g, m):
        return max((1 + depth(g, c) for c in g[m]), default=0)

    got = {(r.design_name, r.module_name): r.depth for r in graph.depths(nodes, edges).collect()}
    assert got == {(d, m): depth(g, m) for d, g in designs.items() for m in g}
    shares = graph.top_scores(nodes, edges).groupBy("design_name").agg(F.sum("score").alias("s")).collect()
    assert all(abs(r.s - 1) < 1e-9 for r in shares)


def test_long_chain_and_self_loop(spark):
    chain = {"c": {f"n{i:02d}": [f"n{i + 1:02d}"] if i < 19 else [] for i in range(20)}, "s": {"x": ["x"], "y": []}}
    nodes, edges = frames(spark, chain)
    got = graph.closure(nodes, edges)
    assert got.filter("design_name = 'c'").count() == 20 * 21 // 2
    assert {r.design_name: r.is_dag for r in graph.is_dag(nodes, edges).collect()} == {"c": True, "s": False}
    roots = {(r.design_name, r.root): r.status for r in graph.root_of_subgraph(got, edges).collect()}
    assert roots[("s", "x")] == "no_unique_root" and roots[("c", "n00")] == "ok"


def verilog(designs):
    return [("ds", d, f"{m}.v", "verilog", f"// {m}\nmodule {m};\n" + "".join(f"{c} i_{c} ();\n" for c in cs) + "endmodule\n")
            for d, g in designs.items() for m, cs in g.items()]


def test_text_and_netlist_hierarchies_agree(spark):
    schema = "dataset_name string, design_name string, file_name string, role string, text string"
    mods = modules.extract_modules(spark.createDataFrame(verilog(HAND), schema), comments="keep")
    import json
    docs = [(d, json.dumps({"modules": {
        **{m: {"attributes": {}, "cells": {f"i{i}": {"type": "$paramod\\b" if c == "b" else c} for i, c in enumerate(cs)} | {"g": {"type": "$and"}}}
           for m, cs in g.items()},
        **({"$paramod\\b": {"attributes": {"hdlname": "b"}, "cells": {}}} if "b" in g else {})}})) for d, g in HAND.items()]
    n_nodes, n_edges = netlist.netlist_instances(spark.createDataFrame(docs, "design_name string, json string"))
    t_nodes, t_edges = mods.select("design_name", "module_name"), modules.instances_from_text(mods)
    assert all(r.equal for r in graph.hierarchy_diff(n_nodes, n_edges, t_nodes, t_edges).collect())
    worse = graph.hierarchy_diff(n_nodes, n_edges, t_nodes, t_edges.filter("child <> 'd'")).collect()
    assert {r.design_name: r.equal for r in worse} == {"h0": True, "h1": True, "h2": False, "h3": True}


def test_decompose_keeps_only_the_closure(spark):
    schema = "dataset_name string, design_name string, file_name string, role string, text string"
    two = "`define X\n\nmodule b;\nendmodule\n\nmodule c;\nd i ();\nendmodule\n"
    files = spark.createDataFrame(
        [("ds", "h2", "a.v", "verilog", "module a;\nb i();\nc j();\nendmodule\n"), ("ds", "h2", "bc.v", "verilog", two),
         ("ds", "h2", "d.v", "verilog", "\nmodule d;\nendmodule\n\n")], schema)
    got = {(r.root, r.file_name): r.text for r in decompose.decompose_text(files).collect()}
    assert got[("c", "bc.v")] == "`define X\n\n\n\n\nmodule c;\nd i ();\nendmodule\n"
    assert got[("d", "d.v")] == "module d;\nendmodule\n" and got[("d", "bc.v")] == "`define X\n"
    assert ("d", "a.v") not in got and ("b", "d.v") not in got
    assert got[("a", "bc.v")] == two


def test_clock_candidates(spark):
    rtlil_text = (
        "connect \\u.clk \\clk\nconnect \\v.clk \\u.clk\nconnect \\r.x \\rst_n\nconnect \\clk \\v.clk\n"
        "process $p$1\n  sync posedge \\v.clk\nend\nprocess $p$2\n  sync negedge \\r.x\n  sync posedge \\wide\nend\n")
    ports = "input [0:0] clk\ninput [0:0] rst_n\ninput [7:0] wide\ninput [0:0] idle\ninout [0:0] pad\n output [0:0] q"
    df = spark.createDataFrame([("d", rtlil_text, ports)], "design_name string, rtlil string, portlist string")
    assert [r.candidate for r in rtlil.clock_candidates(df).collect()] == ["clk"]
    assert rtlil.parse_ports(df).count() == 5


def test_connectivity_collisions(spark):
    lines = ["m\tx\tAND\tA\tin\ts", "m\ty\tOR\tB\tout\tx", "m\tx\tXOR\tC\tinout\ts", "m\tz\tOR\tB\tbad\ts"]
    df = spark.createDataFrame([("d", i, s) for i, s in enumerate(lines)], "design_name string, row_idx long, line string")
    rows = connectivity.parse_rows(df)
    nodes = {r.node: (r.node_type, r.cell_type) for r in connectivity.connectivity_nodes(rows).collect()}
    assert nodes == {"x": ("signal", "XOR"), "y": ("cell", "OR"), "s": ("signal", None), "z": ("cell", "OR")}
    edges = {(r.source, r.target): r.cell_port for r in connectivity.connectivity_edges(rows).collect()}
    assert edges == {("s", "x"): "C", ("x", "s"): "C", ("y", "x"): "B"}
    assert connectivity.unknown_directions(rows).count() == 1


def test_group_count_with_a_hot_key(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("row"))
    got = attach_group_count(df, "k", "n", ["row"], salts=8)
    assert got.count() == 3000
    assert {r.n for r in got.filter("k = 'hot'").collect()} == {1000}
    assert got.filter("k <> 'hot' AND n <> 1").count() == 0


def test_graph_records_have_one_form(spark):
    import json
    for size in (3, 500):
        nodes = spark.range(size).select(F.lit("g").alias("design_name"), F.col("id").cast("string").alias("id"), F.lit("cell").alias("kind_of"))
        edges = spark.range(size - 1).select(
            F.lit("g").alias("design_name"), F.col("id").cast("string").alias("source"), (F.col("id") + 1).cast("string").alias("target"))
        got = [(r.kind, json.loads(r.json)) for r in sinks.graph_records(nodes, edges).collect()]
        assert sorted((int(d["id"]), d["kind_of"]) for k, d in got if k == "node") == [(i, "cell") for i in range(size)]
        assert sorted((int(d["source"]), int(d["target"])) for k, d in got if k == "edge") == [(i, i + 1) for i in range(size - 1)]


def test_edge_ends_are_nodes(spark):
    nodes = spark.createDataFrame([("d", "b")], "design_name string, module_name string")
    edges = spark.createDataFrame([("d", "x", "b")], "design_name string, parent string, child string")
    assert [tuple(r) for r in graph.is_dag(nodes, edges).collect()] == [("d", True, 0)]
    assert {(r.module_name, r.level) for r in graph.peel(nodes, edges).collect()} == {("x", 0), ("b", 1)}


def test_hub_and_chain(spark):
    hub = spark.range(100_000).select(F.lit("hub").alias("design_name"), F.lit("h").alias("parent"), F.concat(F.lit("c"), "id").alias("child"))
    chain = spark.range(200).select(
        F.lit("chain").alias("design_name"), F.concat(F.lit("n"), "id").alias("parent"), F.concat(F.lit("n"), F.col("id") + 1).alias("child"))
    edges = hub.unionByName(chain)
    nodes = edges.select("design_name", F.col("parent").alias("module_name")).distinct()
    got = graph.peel(nodes, edges).groupBy("design_name").agg(F.max("level").alias("top"), F.count(F.lit(1)).alias("n")).collect()
    assert {tuple(r) for r in got} == {("hub", 1, 100_001), ("chain", 200, 201)}


def no_broadcast(spark):
    return session.settings(spark, spark_sql_autoBroadcastJoinThreshold="-1")


def test_a_round_shuffles_only_what_it_finds(spark, monkeypatch):
    plans, write = [], graph.bucketed

    def seen(df, keys, label="table", **kw):
        plans.append((label, df._jdf.queryExecution().executedPlan().toString()))
        return write(df, keys, label, **kw)

    monkeypatch.setattr(graph, "bucketed", seen)
    with no_broadcast(spark):
        chain = {"c": {f"n{i:02d}": [f"n{i + 1:02d}"] if i < 9 else [] for i in range(10)}}
        nodes, edges = frames(spark, chain)
        assert graph.closure(nodes, edges).count() == 55
        rounds = [p for label, p in plans if label == "pairs"]
        assert len(rounds) == 11 and all(p.count("Exchange") == 1 for p in rounds[1:8])
        # a round's only exchange lies above the join of frontier and edges and below all known pairs
        assert all(p.index("LeftAnti") < p.index("Exchange") < p.index("Inner") for p in rounds[1:8])
        plans.clear()
        assert graph.peel(nodes, edges).count() == 10
        waves = [p for label, p in plans if label == "round"]
        assert len(waves) == 8 and all(p.count("Exchange") == 1 for p in waves[1:])


def test_hubs_are_dealt_over_buckets(spark, monkeypatch):
    monkeypatch.setattr(graph, "HUB", 10_000)
    ids = spark.range(100_000).select(F.lit("hub").alias("design_name"), F.concat(F.lit("c"), F.col("id").cast("string")).alias("c"))
    out = ids.select("design_name", F.lit("h").alias("parent"), F.col("c").alias("child"))
    into = ids.select("design_name", F.col("c").alias("parent"), F.lit("z").alias("child"))
    more = spark.createDataFrame([("hub", "top", "h"), ("hub", "h", "top"), ("small", "a", "b")], "design_name string, parent string, child string")
    edges = out.unionByName(into).unionByName(more)
    salts = graph._salts(edges.select("design_name", F.col("parent").alias("node"), "child"), edges.select("design_name", F.col("parent").alias("node")).distinct())
    dealt = salts.edges(edges.select("design_name", F.col("parent").alias("node"), "child"))
    sizes = [r["count"] for r in dealt.groupBy("design_name", "node", "salt").count().where("node = 'h'").collect()]
    assert len(sizes) > 50 and max(sizes) < 15_000
    roots = spark.createDataFrame([("hub", "top"), ("hub", "c5"), ("small", "a")], "design_name string, module_name string")
    got = {(r.root, r.level): r.n for r in graph.closure(roots, edges, roots).groupBy("root", "level").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == {("top", 0): 1, ("top", 1): 1, ("top", 2): 100_000, ("top", 3): 1, ("c5", 0): 1, ("c5", 1): 1, ("a", 0): 1, ("a", 1): 1}
    every = edges.select("design_name", F.col("parent").alias("module_name")).distinct()
    into_z = graph.closure(every, into.unionByName(more.where("design_name = 'small'")))
    assert into_z.where("node = 'z' AND level = 1").count() == 100_000 and into_z.count() == 200_004
    acyclic = out.unionByName(into)
    levels = graph.peel(every.where("module_name <> 'top'"), acyclic).groupBy("level").count().collect()
    assert {r["level"]: r["count"] for r in levels} == {0: 2, 1: 100_000, 2: 1}


def test_rounds_write_in_proportion_to_the_graph(spark, monkeypatch):
    rows, write = [], graph._written

    def seen(df, keys, label, **counts):
        table, n = write(df, keys, label, **counts)
        rows.extend([n["free"] + n["rest"]] if label == "round" else [])
        return table, n

    monkeypatch.setattr(graph, "_written", seen)
    # a chain beside nodes that wait for its end: none of them is written before
    chain = {"c": {f"n{i:02d}": [f"n{i + 1:02d}"] if i < 30 else [f"w{k}" for k in range(300)] for i in range(31)}
             | {f"w{k}": [f"x{k}"] for k in range(300)} | {f"x{k}": [] for k in range(300)}}
    nodes, edges = frames(spark, chain)
    got = {r.module_name: r.level for r in graph.peel(nodes, edges).collect()}
    assert got["n30"] == 30 and got["w7"] == 31 and got["x7"] == 32 and len(got) == 631
    assert sum(rows) == 330


def test_shared_sub_designs_match_closures(spark):
    for designs in (random_graphs(25, True), random_graphs(25, False)):
        nodes, edges = frames(spark, designs)
        old = graph.dedup_sub_designs(graph.fingerprints(graph.closure(nodes, edges), edges)).drop("fingerprint")
        got = graph.shared_sub_designs(nodes, edges)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, old.select(*got.columns).collect()))


def test_drop_written_forgets_tables(spark):
    nodes, edges = frames(spark, HAND)
    graph.closure(nodes, edges).count()
    names = list(session._TABLES)
    assert names and all(spark.catalog.tableExists(n) for n in names)
    assert session.drop_written(spark) > 0 and not any(spark.catalog.tableExists(n) for n in names)
