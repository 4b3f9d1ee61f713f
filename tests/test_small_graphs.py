"""Both ways through a hierarchy agree; small designs take no rounds; lines are derived once for the pairs."""

import random

import pyarrow as pa
import pytest

from gatelake.operators import graph, small_graphs
from gatelake.plans import corpora

D = "design_name"


def _rows(df):
    return sorted(map(str, df.collect()))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def graphs(spark):
    pick = random.Random(5)
    names, designs = [None, *"abcdef"], [None, *"opqrstuvwxyz"]
    nodes = spark.createDataFrame([(pick.choice(designs), pick.choice(names)) for _ in range(120)], f"{D} string, module_name string")
    edges = spark.createDataFrame(
        [(pick.choice(designs), pick.choice(names), pick.choice(names)) for _ in range(90)], f"{D} string, parent string, child string")
    return nodes, edges


@pytest.mark.parametrize("limit", [-1, 16])  # all designs, then the larger ones, take the loop
def test_small_designs_give_the_rows_of_the_loop(graphs, monkeypatch, limit):
    nodes, edges = graphs
    acyclic = edges.where("parent < child OR parent IS NULL")
    work = [
        lambda: graph.closure(nodes, edges), lambda: graph.closure(nodes, edges, nodes.where("module_name = 'a'")),
        lambda: graph.peel(nodes, edges), lambda: graph.peel(nodes, acyclic, from_leaves=True)]
    small = [_rows(f()) for f in work]
    monkeypatch.setattr(graph, "SMALL", limit)
    assert [_rows(f()) for f in work] == small


def test_small_designs_are_closed_without_rounds(spark, graphs, monkeypatch):
    monkeypatch.setattr(graph, "_closure", lambda *a: pytest.fail("a round was taken"))
    nodes, edges = graphs
    chain = spark.range(200).selectExpr("'long' AS design_name", "concat('n', id) AS parent", "concat('n', id + 1) AS child")
    starts = chain.selectExpr("design_name", "parent AS module_name").where("parent = 'n0'")
    found = graph.closure(nodes.unionByName(starts), edges.unionByName(chain)).where("root = 'n0'")
    assert sorted((r.node, r.level) for r in found.collect()) == sorted((f"n{i}", i) for i in range(201))


def test_a_design_may_span_batches():
    rows = [("d1", "a", None, False), ("d1", "a", "b", True), ("d1", "b", "c", True), ("d2", "a", None, False), ("d2", "a", "a", True)]
    schema = pa.schema([(D, pa.string()), ("a", pa.string()), ("b", pa.string()), ("edge", pa.bool_())])
    batches = [pa.RecordBatch.from_arrays([pa.array([r[i]], f.type) for i, f in enumerate(schema)], schema=schema) for r in rows]
    out = pa.Table.from_batches(small_graphs.close(iter(batches))).to_pylist()
    assert sorted((r[D], r["root"], r["node"], r["level"]) for r in out) == [
        ("d1", "a", "a", 0), ("d1", "a", "b", 1), ("d1", "a", "c", 2), ("d2", "a", "a", 0)]


def test_pairs_derive_the_lines_once(spark):
    lines = [(o, n, "A") for o, ns in ((1, (1, 2, 3, 4, 6, 7)), (2, (2, 5)), (3, (3, 3, 6)), (None, (1, 2)), (4, (None, 1, 4))) for n in ns]
    table = spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_returnflag string")
    deps = {"lineitem": table}
    mods = spark.sql(corpora._render(corpora.CORPORA["mods"][1], "spark").replace("@parts", "2"), **deps)
    new = spark.sql(corpora._render(corpora.SPARK["pairs"], "spark"), mods=mods)
    old = spark.sql(corpora._render(corpora.CORPORA["pairs"][1], "spark"), mods=mods)
    assert _rows(new) == _rows(old) and new.schema.simpleString() == old.schema.simpleString()
    assert "Union" not in _plan(new)
