"""Projections and counts against dense brute force."""

import json
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gatelake.operators import ast, summary, tokens, vectors

DOCS = [
    (1, "module a;  assign b = c;\n\nendmodule"), (2, "module bb (input x);\nendmodule"), (3, "aaa bbb ccc ddd eee"),
    (4, "the quick brown fox the quick brown dog"), (5, "the quick fox"), (6, ""), (7, "the the the the quick"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "k int, text string")


def dense(weights):
    rows = weights.collect()
    m = np.zeros((len(DOCS), max(r.term_idx for r in rows) + 1))
    for r in rows:
        m[r.k - 1, r.term_idx] = r.weight
    return m


def same_up_to_sign(got, want):
    for i in range(2):
        assert np.allclose(got[:, i], want[:, i], atol=1e-8) or np.allclose(got[:, i], -want[:, i], atol=1e-8)


def test_projections(spark, docs):
    w = vectors.tfidf_char(docs, "k")
    a = dense(w)
    norms = np.linalg.norm(a, axis=1)
    assert np.allclose(norms[norms > 0], 1) and norms[5] == 0
    keys = docs.select("k")
    pca = np.array([(r.x, r.y) for r in vectors.pca_2d(w, keys, "k").orderBy("k").collect()])
    c = a - a.mean(axis=0)
    same_up_to_sign(pca, c @ np.linalg.svd(c)[2][:2].T)
    svd = np.array([(r.x, r.y) for r in vectors.svd_2d(w, keys, "k").orderBy("k").collect()])
    same_up_to_sign(svd, a @ np.linalg.svd(a)[2][:2].T)


def test_gram_adds_up_over_a_tree(spark, docs, monkeypatch):
    monkeypatch.setattr(vectors, "FAN_IN", 2)
    rng = np.random.default_rng(1)
    dense_rows = rng.random((40, 9)) * (rng.random((40, 9)) < 0.4)
    rows = [(i, j, float(dense_rows[i, j])) for i in range(40) for j in range(9) if dense_rows[i, j]]
    w = spark.createDataFrame(rows, "k int, term_idx int, weight double").repartition(7, "k")
    assert np.allclose(vectors.gram(w, "k", 9), dense_rows.T @ dense_rows)
    one = spark.createDataFrame([(1, 0, 1.0), (2, 0, 3.0)], "k int, term_idx int, weight double")
    assert sorted((r.x, r.y) for r in vectors.pca_2d(one, one.select("k"), "k").collect()) == [(-1.0, 0.0), (1.0, 0.0)]


@pytest.mark.parametrize("size", [2, 3, 5, 8, 1000])
def test_pruned_vocabulary_is_exact(docs, size):
    import re
    counts = Counter()
    for _, t in DOCS:
        w = re.findall(r"\b\w\w+\b", t.lower())
        counts.update(" ".join(w[i:i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1))
    want = [t for t, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:size]]
    got = [r.term for r in vectors.word_vocabulary(docs, "k", max_features=size).collect()]
    assert sorted(got) == sorted(want)


def test_char_frequencies(docs):
    got = {(r.k, r.ch): r.n for r in tokens.char_frequencies(docs, ["k"]).collect()}
    assert got == {(k, c): n for k, t in DOCS for c, n in Counter(t).items()}


def test_rank_series_has_no_gaps(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 3).alias("v")).repartition(7)
    rows = summary.rank_series(df, "v", "k").orderBy("idx").collect()
    assert [r.idx for r in rows] == list(range(5000))
    assert [(r.v, r.k) for r in rows] == sorted((r.v, r.k) for r in rows)


def test_ast_shapes(spark):
    deep = '{"tag":"x","children":[' * 300 + '{"tag":"leaf"}' + "]}" * 300
    rows = [("d", "deep", '{"f":{"tree":' + deep + "}}"), ("d", "err", '{"f":{"errors":[]}}'), ("d", "junk", "nope"), ("d", "empty", "{}")]
    nodes = ast.ast_nodes(spark.createDataFrame(rows, "design_name string, file_name string, json string"))
    assert nodes.filter("file_name = 'deep'").count() == 301
    assert {r.file_name for r in ast.tree_violations(nodes).collect()} == {"err", "junk", "empty"}
    edges = ast.ast_edges(nodes)
    assert {r.t_edge_type for r in edges.select("t_edge_type").distinct().collect()} == {"nco", "nco_reverse"}
    assert ast.ast_edges(nodes, multi=True).count() == 1200


def test_ast_nodes_of_odd_documents(spark):
    """Trees longer than an output batch, no trees, attributes of all types; fields as get_json_object gives them."""
    from gatelake.operators.ast import BATCH_ROWS

    wide = {"tag": "top", "children": [{"tag": f"c{i}", "start": i} for i in range(2 * BATCH_ROWS + 5)]}
    odd = {"tag": "t", "text": 1.5, "start": True, "children": [None, {"text": {"a": [1, "é"]}, "start": "7"}, {"tag": "x", "text": None}, {"text": "é\"", "start": 12}]}
    doc = lambda t: json.dumps({"f": {"tree": t}})
    rows = [("d", "none", "{}"), ("d", "wide", doc(wide)), ("d", "odd", doc(odd)), (None, "odd", doc(odd)), ("d", "null", None), ("d", "odd", doc(odd))]
    trees = spark.createDataFrame(rows, "design_name string, file_name string, json string").coalesce(1)
    nodes = ast.ast_nodes(trees, fields={"name": "text", "start_at": "start"}).cache()
    assert nodes.filter("status = 'no_tree' AND idx IS NULL AND depth IS NULL").count() == 2
    big = nodes.filter("file_name = 'wide'")
    assert [r.idx for r in big.orderBy("idx").collect()] == list(range(2 * BATCH_ROWS + 6))
    assert big.filter("idx > 0 AND NOT (parent_idx = 0 AND depth = 1 AND tag = 'c' || (idx - 1) AND start_at = CAST(idx - 1 AS STRING))").isEmpty()
    differ = ~(F.col("name").eqNullSafe(F.get_json_object("attrs", "$.text")) & F.col("start_at").eqNullSafe(F.get_json_object("attrs", "$.start")))
    assert nodes.filter(differ).isEmpty()
    slim = ast.ast_nodes(trees, attrs=False, fields={"name": "text", "start_at": "start"})
    assert "attrs" not in slim.columns and slim.exceptAll(nodes.drop("attrs")).isEmpty()
    counts = {(r.design_name, r.file_name): (r.n_nodes, r.n_edges) for r in ast.graph_counts(ast.ast_edges(nodes, nested=True)).collect()}
    one = 6 + 2 * 3 - 2  # three nodes below the first, one of them next to its parent
    assert counts == {("d", "wide"): (2 * BATCH_ROWS + 6, 4 * (2 * BATCH_ROWS + 5) - 2), ("d", "odd"): (8, 2 * one), (None, "odd"): (4, 0)}
    assert ast.ast_edges(nodes).filter("file_name = 'odd' AND design_name = 'd'").count() == 2 * one


def test_graph_counts_counts_edges(spark):
    """Edges are rows that are counted, not lengths of lists: what is no edge does not count, and the plan makes the rows."""
    kind = "design_name string, file_name string, status string, edges array<struct<src: int, dst: int, t_edge_type: string>>"
    rows = [("d", "f", "ok", None), ("d", "f", "ok", [(0, 1, "nco"), None, (1, 0, "nco_reverse")]), ("d", "f", "ok", []), ("d", "one", "ok", None), ("d", "bad", "no_tree", None)]
    counts = ast.graph_counts(spark.createDataFrame(rows, kind))
    assert {tuple(r) for r in counts.collect()} == {("d", "f", 3, 2), ("d", "one", 1, 0)}
    assert "posexplode(edges" in counts._jdf.queryExecution().optimizedPlan().toString()
    trees = spark.createDataFrame([("d", f"f{i}", json.dumps({"f": {"tree": {"tag": "t", "children": [{"tag": "c", "children": [None, {"tag": "e"}]}] * i}}})) for i in range(4)], "design_name string, file_name string, json string")
    nodes = ast.ast_nodes(trees, attrs=False)
    n = {r.file_name: r.n for r in nodes.groupBy("file_name").agg(F.count(F.lit(1)).alias("n")).collect()}
    e = {r.file_name: r.n for r in ast.ast_edges(nodes).groupBy("file_name").agg(F.count(F.lit(1)).alias("n")).collect()}
    found = ast.graph_counts(ast.ast_edges(nodes, nested=True)).collect()
    assert {r.file_name: (r.n_nodes, r.n_edges) for r in found} == {f: (n[f], e.get(f, 0)) for f in n}
