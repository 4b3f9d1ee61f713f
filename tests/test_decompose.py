"""Decomposition splits each text once."""

from collections import Counter

import pytest

from gatelake.operators import decompose, modules


def test_text_is_split_once(spark, monkeypatch):
    monkeypatch.setattr(modules, "extract_modules", lambda *a, **k: pytest.fail("modules were extracted a second time"))
    text = "// module no;\nmodule a;\n  b u1 (x);\n  /* b */\nendmodule\nmodule b; endmodule\n"
    files = spark.createDataFrame([("d", "f.v", text), ("d", "g.v", "module c; a u (y); endmodule\n"), ("d", "n.v", None)], "design_name string, file_name string, text string")
    out = {(r.root, r.file_name): r.text for r in decompose.decompose_text(files).collect()}
    assert out["c", "f.v"] == text and out["b", "f.v"] == "// module no;\n\n\nmodule b; endmodule\n"
    assert set(out) == {(r, "f.v") for r in "abc"} | {("c", "g.v")}


def test_small_designs_are_cut_within_a_task(spark, monkeypatch):
    """Small designs give the rows that the joins by (design, file) give, and need none of these; large ones take the joins."""
    mod = lambda n, *kids: f"module {n} (input a);\n" + "".join(f"  {k} u{i} (a); // {k}\n" for i, k in enumerate(kids)) + "endmodule\n"
    rows = []
    for i in range(30):
        rows += [(f"d{i}", "a.v", "// head é\n" + mod("top", "x", "y", "nand") + "\n" + mod("x", "z")), (f"d{i}", "b.v", mod("y", "x") + mod("z")), (f"d{i}", "c.v", " \n\n")]
    rows += [("cyc", "a.v", mod("p", "q") + mod("q", "p") + mod("s", "s")), ("twice", "a.v", mod("k") + mod("l", "k")), ("twice", "a.v", mod("l") + mod("m", "l") + mod("k")),
             ("twice", "b.v", mod("k")), ("empty", "a.v", ""), ("null", "a.v", None), ("null", "b.v", mod("n")), ("null", None, mod("o", "n")), (None, "a.v", mod("n")),
             ("bare", "a.v", "no module here\n"), ("many", "a.v", "".join(mod(f"m{i}", f"m{i + 1}") for i in range(decompose.SMALL_TOKENS))), ("wide", "a.v", mod("w") + "// x\n" * decompose.SMALL_BYTES)]
    files = spark.createDataFrame(rows, "design_name string, file_name string, text string").repartition(3)
    found = lambda df: Counter(map(tuple, df.select("design_name", "root", "file_name", "text").collect()))
    small = files.filter("design_name IS NULL OR design_name NOT IN ('many', 'wide')")
    joins = lambda f: decompose._decomposed(decompose.materialize(decompose.segmented(f, heads=True)))
    want, want_small = found(joins(files)), found(joins(small))
    assert sum(want_small.values()) > 200 and ("twice", "l", "a.v") in {k[:3] for k in want_small}
    assert found(decompose.decompose_text(files)) == want
    monkeypatch.setattr(decompose, "_decomposed", lambda *a, **k: pytest.fail("small designs took the joins"))
    assert found(decompose.decompose_text(small)) == want_small
