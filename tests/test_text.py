"""Adversarial text, by literal expectation or by a small row-wise re-implementation."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from gatelake.functions import text as X
from gatelake.operators import modules, repair

CASES = [
    "", "a", "a\n", "a\n\n b", "\n", "x\u00a0y\x0bz", "s = \"// no\"; // yes\nn", "/* a\nb */c",
    "w = 4'b0; // hidden\nv = 2'd1; // seen", "a / b /* x */ / c", "\"open /* no end", "'\\'' // c",
    "module a;\nendmodule", "module foo#(parameter W=1) (input a);\n  endmodule module b(); endmodule",
    "// module no (\nmodule yes (input a); /* endmodule? */ endmodule", "module open (input a);\n",
]


def one(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, text string")
    return [r[1] for r in sorted(df.select("i", expr.alias("v")).collect())]


def strip_comments(s):
    pat = re.compile(r"""'(?:\\.|[^\\'])*'|"(?:\\.|[^\\"])*"|//.*?$|/\*.*?\*/""", re.S | re.M)
    return pat.sub(lambda m: " " if m[0][0] == "/" else m[0], s)


def test_strip_comments(spark):
    assert one(spark, CASES, X.strip_comments(F.col("text"))) == [strip_comments(c) for c in CASES]


def test_strip_comments_long_literal_and_idempotent(spark):
    long = '"' + "x\\n" * 20_000 + '" // c'
    assert one(spark, [long], X.strip_comments(F.col("text"))) == [strip_comments(long)]
    free = [c for c in CASES if "'" not in c and '"' not in c]
    once = one(spark, free, X.strip_comments(F.col("text")))
    assert one(spark, once, X.strip_comments(F.col("text"))) == once


def test_counts(spark):
    t = F.col("text")
    assert one(spark, CASES, X.line_count(t)) == [len(c.split("\n")) - c.endswith("\n") if c else 0 for c in CASES]
    assert one(spark, CASES, X.non_blank_lines(t)) == [sum(bool(x.strip()) for x in c.split("\n")) for c in CASES]
    assert one(spark, CASES, X.non_whitespace_chars(t)) == [len("".join(c.split())) for c in CASES]
    assert one(spark, CASES, X.count_modules(t)) == [len(re.findall(r"module\s+\S+[\s\S]*?endmodule", c)) for c in CASES]
    assert one(spark, ["a\r\nb\rc"], X.normalize_newlines(t)) == ["a\nb\nc"]


def files(spark, *texts):
    return spark.createDataFrame(
        [("ds", "d", f"f{i}.v", t) for i, t in enumerate(texts)],
        "dataset_name string, design_name string, file_name string, text string")


def test_module_names(spark):
    got = {r.file_name: [] for r in files(spark, *CASES).collect()}
    for r in modules.extract_modules(files(spark, *CASES)).orderBy("file_name", "pos").collect():
        got[r.file_name].append(r.module_name)
    assert got["f12.v"] == ["a"] and got["f13.v"] == ["foo", "b"] and got["f14.v"] == ["yes"] and got["f15.v"] == []
    strict = modules.extract_modules(files(spark, *CASES), compat="strict_header")
    assert sorted(r.module_name for r in strict.collect()) == ["b", "foo", "yes"]


def test_kept_comments_do_not_start_a_module(spark):
    text = "// my module\nm2 inst (\n);\n/* module x; */ module real (a);\n// endless\nendmodule\n"
    rows = modules.extract_modules(files(spark, text), comments="keep").collect()
    assert [r.module_name for r in rows] == ["real"]
    assert rows[0].body == "module real (a);\n// endless\nendmodule"


def test_hash_ignores_layout_and_comments(spark):
    a = "module m (input a);\n  assign b = a;\nendmodule"
    b = "module m(input a); // c\n assign b /* d */ = a ;\n\nendmodule"
    rows = modules.module_hashes(files(spark, a, b)).collect()
    assert len({r.module_hash for r in rows}) == 1
    assert rows[0].module_hash == hashlib.sha256(re.sub(r"\s", "", a).encode()).hexdigest()


def test_very_long_module(spark):
    body = "module big (input a);\n" + "  assign x = y; // z\n" * 40_000 + "endmodule"
    row = modules.extract_modules(files(spark, body)).select("module_name", F.length("body")).collect()[0]
    assert row[0] == "big" and row[1] > 600_000
    assert one(spark, [body], X.count_modules(F.col("text"))) == [1]


@pytest.mark.parametrize("name,ok", [
    ("rst_n", False), ("clk_en", False), ("CLK", True), ("first", True), ("valid", False), ("A_RST", False),
    ("x_ready_y", False), ("enabled", True), ("", True), ("vld2", True)])
def test_clock_like(spark, name, ok):
    assert one(spark, [name], X.clock_like(F.col("text"))) == [ok]


def test_testbench_names(spark):
    names = ["a_tb.v", "a_tb", "tb.v", "a_tb.x.v", "a_tbs.v"]
    assert one(spark, names, X.is_testbench(F.col("text"))) == [True, True, False, False, False]


# ------------------------------------------------------------------ repairs
def test_constants_move_before_end(spark):
    t = ".model m\n.names a\n1\n.names  b \n 0 \n.names c d\n-\n.names e f\n1 1\n.end\ntail\n"
    assert one(spark, [t, ".model x\n"], repair.fix_constants(F.col("text"))) == [
        ".model m\n\n\n\n.names e f\n1 1\n \n.names b \n0\n.names a\n1\n.end\ntail", None]


def test_duplicate_models(spark):
    a, a2, b = ".model a\nx\n.end", ".model a\ny\n.end", ".model b\n.end"
    fix = repair.drop_duplicate_models(F.col("text"))
    assert one(spark, [f"{a}\n{b}\n{a2}\n", f"{a}\n{b}\n{a}\n", f"{a}\n{a2}\n{a}", "none"], fix) == [
        f"{a}\n{b}\n\n\n\n", f"\n\n\n{b}\n{a}\n", f"\n\n\n\n\n\n{a}", "none"]


def test_global_clock(spark):
    two = ".model a\n.inputs x\n.outputs q\n.latch x q re c 0\n.end\n.model b\n.inputs y\n.outputs z\n.latch  y z 2\n.end"
    got = one(spark, [two, ".latch a b 0\n", ".model a\n.end\n"], repair.add_global_clock(F.col("text")))
    assert got == [
        ".model a\n.inputs x\n.outputs q\n.latch x q re c 0\n.end\n.model b\n.inputs y\n.inputs clk\n.outputs z\n.latch y z re clk 2\n.end",
        None, ".model a\n.end\n"]


def test_global_clock_of_repeated_models(spark):
    block = ".model a\n.inputs x\n.outputs q\n.latch x q 2\n.end"
    fixed = ".model a\n.inputs x\n.inputs clk\n.outputs q\n.latch x q re clk 2\n.end"
    assert one(spark, [f"{block}\n{block}"], repair.add_global_clock(F.col("text"))) == [f"{fixed}\n{fixed}"]


def test_cell_arrays(spark):
    good = "fa u[0:2](a[0:2],s[5:3]);\n  keep me\nfa #(.W(2)) v[1:0] (b[7:6]);\n"
    out = one(spark, [good, "fa u[0:2](a[0:1]);", "fa u[0:1](a);"], repair.unroll_cell_arrays(F.col("text")))
    assert out == [
        "fa u__0 (a[0], s[5]);\nfa u__1 (a[1], s[4]);\nfa u__2 (a[2], s[3]);\n  keep me\n"
        "fa #(.W(2)) v__1 (b[7]);\nfa #(.W(2)) v__0 (b[6]);", None, None]


def test_exdc(spark):
    assert one(spark, [".a\n.exdc\n.names z\n1\n.end\n"], repair.remove_exdc(F.col("text"))) == [".a\n.end\n"]


def test_many_models_in_one_file(spark):
    """20,000 blocks of 10,000 names: each name's first text stays, at its last place."""
    import time
    block = lambda i, v: f".model m{i % 10_000}\n.inputs {v}\n.end\n"
    blocks = [block(i, "a" if i < 10_000 or i % 3 else "b") for i in range(20_000)]
    df = spark.createDataFrame([("".join(blocks),)], "text string")
    start = time.time()
    got = df.select(repair.drop_duplicate_models(F.col("text")).alias("t")).first()["t"]
    assert time.time() - start < 60
    kept = [line.split()[1] for line in got.splitlines() if line.startswith(".model")]
    # a name whose second block is another text keeps the first one, the others keep the second one's place
    assert len(kept) == 10_000 == len(set(kept))
    assert kept == [f"m{i}" for i in range(10_000) if (i + 10_000) % 3 == 0] + [f"m{i}" for i in range(10_000) if (i + 10_000) % 3]
    assert ".inputs b" not in got


def test_long_bodies_are_scanned_at_the_speed_of_a_dot(spark):
    """Bodies with all sorts of line ends, and 32 MB of them in seconds."""
    import time

    from gatelake.functions import patterns as P

    odd = "module a;\r\n  /* \u0085 endmodule */ \U0001F600 x\nendmodule /* module c; \r endmodule */ module b (\n);endmodule module d"
    df = spark.createDataFrame([(odd,)], "text string")
    row = df.select(X.count_modules(F.col("text")).alias("n"), X.find_all(F.col("text"), P.MODULE_OR_COMMENT).alias("m")).first()
    assert row.n == 3 and row.m == ["module a;\r\n  /* \u0085 endmodule", "/ \U0001F600 x\nendmodule /* module c; \r endmodule */"] or row.n == 3 and row.m[0].startswith("module a;")
    long = spark.range(1).select(F.concat(F.lit("module a;\n"), F.repeat(F.lit("  assign q = d;\n"), 1 << 21), F.lit("endmodule\n")).alias("text"))
    start = time.time()
    assert long.select(X.count_modules(F.col("text")).alias("n")).first().n == 1
    assert time.time() - start < 8


def test_corpora_deal_the_lines_once(spark, tmp_path):
    """Repeated and null order numbers; one shuffle, the rows of a plain grouping."""
    from gatelake.plans.corpora import corpus

    rows = [(k, n, f) for k in (1, 2, 3, 7, None) for n in (1, 2, 4, 7) for f in ("A", "N")] + [(1, 2, "R"), (5, 3, "R")]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_returnflag string").write.parquet(f"{tmp_path}/lineitem.parquet")
    for name in ("hdl_files", "netlist_json", "rtlil", "blif", "cell_array_files"):
        df = corpus(spark, str(tmp_path), name)
        executed = df._jdf.queryExecution().executedPlan().toString()
        assert executed.count("Exchange hashpartitioning") == 1, executed
        assert df.count() == (11 if name == "hdl_files" else 6)
