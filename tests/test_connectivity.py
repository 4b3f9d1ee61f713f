"""Connectivity rows are read once; designs of files."""

from gatelake.operators import connectivity
from gatelake.sources import sinks

D = "design_name"


def test_connectivity_nodes_read_rows_once(spark):
    rows = [("g", 1, "top", "u", "early", "p", "in", "s"), ("g", 2, "top", "u", "late", "p", "in", "s"),
            ("g", 3, "top", "s", "cell", "p", "out", "u"), ("g", None, None, "v", None, None, None, None)]
    names = "design_name string, row_idx long, module_name string, cell_name string, cell_type string, cell_port string, direction string, signal string"
    table = spark.read.parquet(sinks.write_parquet(spark.createDataFrame(rows, names), "connectivity_rows", partition_by=None))
    nodes = connectivity.connectivity_nodes(table)
    assert nodes._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert sorted(map(str, ((r.node, r.node_type, r.cell_type, r.module_name) for r in nodes.collect()))) == sorted(map(str, [
        ("u", "signal", "late", "top"), ("s", "signal", "cell", "top"), ("v", "cell", None, None), (None, "signal", None, None)]))
    edges = connectivity.connectivity_edges(table)
    assert sorted((r.source, r.target, r.cell_port, r.direction) for r in edges.collect()) == [("s", "u", "p", "out")]


def test_the_design_of_a_connectivity_file(spark, tmp_path):
    for folder in ("design_name=g1", "g2", "a=b=g3"):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "x=y.txt").write_text("m\tc\tt\tp\tin\ts\n")
    found = connectivity.scan_connectivity(spark, f"{tmp_path}/*")
    assert sorted(r[D] for r in found.select(D).collect()) == ["g1", "g2", "g3"]
