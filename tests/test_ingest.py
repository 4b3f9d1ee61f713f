"""Directory trees, archives and source rules on disk."""

import bz2
import gzip
import hashlib
import io
import json
import lzma
import random
import tarfile
import zipfile
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

from gatelake.operators import quality
from gatelake.plans import flows
from gatelake.session import materialize
from gatelake.sources import archives, catalog, rules
from gatelake.sources.rules import RULES, SOURCES, SourcePlugin


def tree(root, designs):
    for name, (dataset, files) in designs.items():
        d = root / "designs" / name
        (d / "sources").mkdir(parents=True)
        (d / "design.json").write_text(json.dumps({"design_name": name, "dataset_name": dataset, "dataset_tags": ["t"]}, indent=4))
        for f, text in files.items():
            (d / f).parent.mkdir(exist_ok=True)
            (d / f).write_bytes(text.encode())


def test_scan_tree(spark, tmp_path):
    tree(tmp_path, {
        "b": ("x", {"sources/m.v": "a\r\nb\rc", "sources/R.MEM": "0", "aux_files/notes.txt": "n", "top.txt": "m"}),
        "a": ("y", {"sources/k.Sv": "q", "sources_blif/z.blif": ".end"})})
    root = f"file://{tmp_path}"
    assert [r.design_name for r in catalog.scan_designs(spark, root).orderBy("design_name").collect()] == ["a", "b"]
    sources = {(r.design_name, r.file_name): (r.dataset_name, r.role, r.text) for r in catalog.scan_files(spark, root).collect()}
    assert sources == {("b", "m.v"): ("x", "verilog", "a\nb\nc"), ("b", "R.MEM"): ("x", "data", "0"), ("a", "k.Sv"): ("y", "aux", "q")}
    every = {(r.design_name, r.file_name): r.role for r in catalog.scan_files(spark, root, sources_only=False).collect()}
    assert every[("b", "notes.txt")] == "aux" and every[("b", "top.txt")] == "top" and every[("a", "z.blif")] == "blif"


def test_catalogue_life_cycle(spark, tmp_path):
    cat = catalog.Catalogue(spark, f"file://{tmp_path}/cat")

    def rows(spec):
        d = spark.createDataFrame([(n, s, ["t"]) for n, s, _ in spec], "design_name string, dataset_name string, dataset_tags array<string>")
        f = spark.createDataFrame([(s, n, "f.v", "verilog", t) for n, s, t in spec],
                                  "dataset_name string, design_name string, file_name string, role string, text string")
        return d, f

    def state():
        names = {r.design_name: r.dataset_name for r in cat.designs.collect()}
        texts = {r.design_name: r.text for r in cat.files.collect()}
        assert set(names) == set(texts)
        return {n: (names[n], texts[n]) for n in names}

    assert state() == {}
    cat.create(*rows([("a", "x", "1"), ("b", "x", "2"), ("c", "y", "3")]))
    with pytest.raises(FileExistsError):
        cat.create(*rows([("z", "x", "1")]))
    new = rows([("b", "y", "22"), ("d", "z", "4")])
    for _ in range(2):  # idempotent; b moves from x to y
        cat.upsert(*new)
        assert state() == {"a": ("x", "1"), "b": ("y", "22"), "c": ("y", "3"), "d": ("z", "4")}
    with pytest.raises(ValueError, match="nope"):
        cat.delete(["a", "nope"])
    cat.delete(["a"])
    assert set(state()) == {"b", "c", "d"}
    cat.remove_dataset("y")
    assert set(state()) == {"d"}
    cat.delete_all()
    assert state() == {}


def test_upsert_rewrites_only_touched_parts(spark, tmp_path):
    cat = catalog.Catalogue(spark, f"file://{tmp_path}/cat")
    n = 2000
    designs = spark.range(n).select(F.concat(F.lit("d"), F.col("id").cast("string")).alias("design_name"), F.lit("one").alias("dataset_name"), F.array(F.lit("t")).alias("dataset_tags"))
    files = designs.select("dataset_name", "design_name", F.lit("f.v").alias("file_name"), F.lit("verilog").alias("role"), F.lit("old").alias("text"))
    cat.create(designs, files)
    stored = lambda t: {str(p): p.stat().st_mtime_ns for p in (tmp_path / "cat" / t).rglob("*.parquet")}
    before = {t: stored(t) for t in ("designs", "files")}
    assert len(before["files"]) >= catalog.BUCKETS
    cat.upsert(designs.where("design_name = 'd7'"), files.where("design_name = 'd7'").withColumn("text", F.lit("new")))
    for t in before:
        after = stored(t)
        assert len(before[t].keys() - after.keys()) == 1 == len(after.keys() - before[t].keys())
        assert all(after[p] == v for p, v in before[t].items() if p in after)
    assert {r.text: r["count"] for r in cat.files.groupBy("text").count().collect()} == {"old": n - 1, "new": 1}
    # files of a design that is not listed are added to its part
    cat.upsert(designs.where("false"), files.where("design_name = 'd9'").withColumn("file_name", F.lit("g.v")))
    assert cat.files.count() == n + 1 and cat.designs.count() == n


def zip_bytes(members):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        for p, t in members.items():
            z.writestr(p, t)
    return buf.getvalue()


def tar_bytes(members, mode="w:gz"):
    buf = io.BytesIO()
    with tarfile.open(fileobj=buf, mode=mode) as t:
        for p, data in members.items():
            data = data if isinstance(data, bytes) else data.encode()
            info = tarfile.TarInfo(p)
            info.size = len(data)
            t.addfile(info, io.BytesIO(data))
    return buf.getvalue()


def test_polybench_from_nested_archives(spark, tmp_path):
    ip = zip_bytes({"hdl/verilog/k.v": "module k; endmodule", "hdl/verilog/d.dat": "1", "hdl/vhdl/k.vhd": "x"})
    (tmp_path / "hls_polybench__fixed__mini__build.tar.gz").write_bytes(
        tar_bytes({"2mm-x/ip_2mm-x.zip": ip, "2mm-x/README": "r"}))
    raw = archives.scan_archives(spark, f"file://{tmp_path}/*.tar.gz", "polybench")
    designs, files = SOURCES["polybench"]().load(materialize(archives.expand_archives(raw)))
    assert [(r.design_name, r.dataset_tags) for r in designs.collect()] == [("hls_polybench__fixed__mini__2mm_x", ["hls"])]
    assert {(r.file_name, r.role) for r in files.collect()} == {("k.v", "verilog"), ("d.dat", "data")}


@pytest.mark.parametrize("mode", ["w", "w:gz", "w:bz2", "w:xz"])
def test_tar_kinds(spark, mode):
    df = spark.createDataFrame([("s", "a", bytearray(tar_bytes({"x/1": "one", "x/2": "two"}, mode)))],
                               "dataset_name string, archive string, content binary")
    got = archives.expand_archives(df, spread=4).collect()
    assert {(r.path, bytes(r.content), r.load_seq) for r in got} == {("x/1", b"one", 0), ("x/2", b"two", 1)}


def test_members_after_a_damaged_one_are_kept(spark):
    whole = bytearray(zip_bytes({"x/1": "one", "x/2": "two", "x/3": "three"}))
    at = whole.index(b"PK\x01\x02", whole.index(b"PK\x01\x02") + 1)  # directory entry of the second member
    whole[at + 16] ^= 1  # its checksum
    got = archives.expand_archives(spark.createDataFrame([("s", "a", whole)], "dataset_name string, archive string, content binary"))
    assert {(r.path, r.content and bytes(r.content), r.load_seq) for r in got.collect()} == {("x/1", b"one", 0), (None, None, 1), ("x/3", b"three", 2)}
    assert [r.n_members for r in archives.unreadable(got).collect()] == [1]


def members(spark, dataset, paths):
    rows = [(dataset, "arc", p, bytearray(t.encode()), i) for i, (p, t) in enumerate(paths.items())]
    return materialize(spark.createDataFrame(
        rows, "dataset_name string, archive string, path string, content binary, load_seq long"))


RULE_CASES = {
    "opencores": ({"designs/a/rtl/x.v": "1", "designs/a/y/x.v": "2", "designs/a/top.txt": "a", "designs/6809_6309_compatible_core/z.v": "z"},
                  {("opencores__a", "x.v", "verilog", "2"), ("opencores__a", "top.txt", "top", "a"), ("opencores__a", "top.txt", "aux", "a")}),
    "hw_2_vec": ({"t/AES-T1/a.v": "1", "t/RS232-T100/u.v": "2", "t/T100/u.v": "3", "t/RS232-T1000/u.v": "4"},
                 {("hw2vec__AES_T1", "a.v", "verilog", "1"), ("hw2vec__RS232_T1000", "u.v", "verilog", "4")}),
    "koios": ({"vtr_flow/benchmarks/verilog/koios/a.v": "1", "vtr_flow/benchmarks/verilog/koios/a_include.v": "2"},
              {("koios__a", "a.v", "verilog", "1")}),
    "opdb": ({"modules/piton_baseline_designs.txt": "modules/l2/x.pickle.v\n\nmodules/z.v", "modules/l2/x.pickle.v": "1", "modules/n.v": "3", "modules/z.v": "2"},
             {("opdb__l2_x", "l2_x.v", "verilog", "1"), ("opdb__z", "z.v", "verilog", "2")}),
    "iscas89": ({"Verilog/s27.v": "1", "Verilog/lib.v": "L", "Verilog/DFF2.v": "D", "Verilog/c17.v": "x"},
                {("iscas89__S27", "s27.v", "verilog", "1"), ("iscas89__S27", "lib.v", "verilog", "L"), ("iscas89__S27", "DFF2.v", "verilog", "D")}),
    "vtr": ({"vtr_flow/benchmarks/verilog/ch.v": "1", "vtr_flow/benchmarks/verilog/mcml.v": "2", "vtr_flow/primitives.v": "module single_port_ram #("},
            {("vtr__ch", "ch.v", "verilog", "1"), ("vtr__ch", "primitives.v", "verilog", "(* nomem2reg *)\nmodule single_port_ram #(")}),
    "i99t": ({"i99t/b01/b01.vhd": "1", "i99t/b08/b08.vhd": "2", "i99t/b01/other.vhd": "3"}, {("i99t_b01", "b01.vhdl", "vhdl", "1")}),
    "iwls93": ({"blif/a.blif": ".model a\n.names x\n1\n.end\n", "blif/frisc.blif": "x"},
               {("iwls93__a", "a.blif", "blif", ".model a\n\n.names x\n1\n.end")}),
    "mcnc20": ({"x/i2.blif": ".model i2\n.names a", "x/s.blif": ".model s\n.outputs q\n.latch a q 2\n.end"},
               {("mcnc20__i2", "i2.blif", "blif", ".model i2\n.names a\n.end"),
                ("mcnc20__s", "s.blif", "blif", ".model s\n.inputs clk\n.outputs q\n.latch a q re clk 2\n.end")}),
    "adders_cvut": ({"A/add-4.blif": "1", "A/add_col.blif": "2"}, {("adders_cvut__add_4", "add-4.blif", "blif", "1")}),
    "xact": ({"d1/vlib.v": "v", "d1/d1.v": "1", "d1/other.v": "o", "d1/top.txt": "t"},
             {("xact__d1", "vlib.v", "verilog", "v"), ("xact__d1", "d1.v", "verilog", "1"), ("xact__d1", "top.txt", "top", "t")}),
    "espresso_pla": ({"generated_designs/p/p.v": "1"},
                     {("espresso_pla__p", "p.v", "verilog", "1"), ("espresso_pla__p", "top.txt", "top", "p")}),
    "deepbenchverilog": ({"verilog/inference/Conv/conv_b2_in_7_7_32_f_1_1_128_s_1_p_valid/ap_fixed_8_4/a.v": "1",
                          "verilog/training/RNN/Vanilla_2560_32_Core_256_32_256_Reuse_10_1_20/w.dat": "2", "verilog/training/RNN/not_listed/w.v": "3"},
                         {("deepbenchverilog__conv_b2_in_7_7_32_f_1_1_128_s_1_p_valid_ap_fixed_8_4", "a.v", "verilog", "1"),
                          ("deepbenchverilog__Vanilla_2560_32_Core_256_32_256_Reuse_10_1_20", "w.dat", "data", "2")}),
    "fpga_micro_benchmarks": ({"ram/fifo/rtl/f.v": "1", "ram/fifo/rtl/readme.md": "r", "dsp/mac/mac_8/mac.v": "2", "dsp/mac/mac_8/mac_tb.v": "3",
                               "simple_registers/ff/dffnr/d_tb.v": "4", "fsm/FSM_three_code/FSM_top.v": "5", "simple_registers/signal_gen/clock_divider.v": "6"},
                              {("fpga_micro_benchmarks__ram_fifo", "f.v", "verilog", "1"), ("fpga_micro_benchmarks__mac_8", "mac.v", "verilog", "2"),
                               ("fpga_micro_benchmarks__simple_registers_ff_dffnr", "d_tb.v", "verilog", "4"),
                               ("fpga_micro_benchmarks__FSM_three_code", "FSM_top.v", "verilog", "5"),
                               ("fpga_micro_benchmarks__clock_divider", "clock_divider.v", "verilog", "6")}),
    "verilog_adders_mongrelgem": ({"Hybrid Adder/HybridAdder.v": "fa u[0:1](a[0:1]);\n", "Hybrid Adder/x.v": "n"},
                                  {("verilog_adders_mongrelgem__HybridAdder", "HybridAdder.v", "verilog", "fa u__0 (a[0]);\nfa u__1 (a[1]);")}),
}


@pytest.mark.parametrize("dataset", sorted(RULE_CASES))
def test_source_rules(spark, dataset):
    paths, want = RULE_CASES[dataset]
    _, files = SOURCES[dataset]().load(members(spark, dataset, paths))
    assert {(r.design_name, r.file_name, r.role, r.text) for r in files.collect()} == want


def test_every_source_has_rules_and_unknown_ones_do_not():
    assert len({r.dataset for r in RULES}) == 21
    with pytest.raises(NotImplementedError):
        SourcePlugin("texas97")


def test_strict_error_policy(spark):
    bad = spark.createDataFrame([("d", "acyclic", "x")], "design_name string, check string, detail string")
    with pytest.raises(quality.ViolationError, match="acyclic"):
        quality.enforce(bad)
    assert quality.enforce(bad, strict=False).count() == 1
    assert quality.enforce(bad.limit(0)).count() == 0


def test_flow_rerun_replaces(spark):
    files = spark.createDataFrame([("d", "a.v", "verilog", "x\ny")], "design_name string, file_name string, role string, text string")
    first = flows.run_flow(flows.LINE_COUNT, files)
    again = flows.run_flow(flows.LINE_COUNT, files.withColumn("text", F.lit("x")))
    merged = flows.replace_runs(first, again).collect()
    assert [(r.flow_name, r.flow_tags, r.metrics) for r in merged] == [("line_count", ["text"], {"num_lines": "1"})]


def test_classify_and_list(spark):
    rows = [(r.path, r.role) for r in rules.classify_members(members(spark, "s", {"a/top.txt": "", "b.V": "", "c.Vh": ""})).collect()]
    assert sorted(rows) == [("a/top.txt", "aux"), ("a/top.txt", "top"), ("b.V", "verilog"), ("c.Vh", "aux")]


# --- archives by path ------------------------------------------------------------------


def listed(spark, path):
    return archives.list_archives(spark, f"file://{path}", "s")


def plain(rows):
    return sorted((r.archive, r.load_seq, r.path, bytes(r.content) if r.content is not None else None) for r in rows)


def test_archives_by_path_equal_archives_by_content(spark, tmp_path):
    members = {f"d/{i:03d}.v": f"module m{i}; endmodule\n" * (i % 7) for i in range(300)}
    (tmp_path / "a.zip").write_bytes(zip_bytes(members))
    with zipfile.ZipFile(tmp_path / "b.zip", "w", zipfile.ZIP_BZIP2) as z:
        for name, text in members.items():
            z.writestr(zipfile.ZipInfo(name), text, zipfile.ZIP_DEFLATED if name[-3] in "12" else None)
    for mode, end in (("w", "tar"), ("w:gz", "tar.gz"), ("w:xz", "tar.xz"), ("w:bz2", "tar.bz2")):
        (tmp_path / f"c.{end}").write_bytes(tar_bytes(members, mode))
    (tmp_path / "empty.zip").write_bytes(zip_bytes({}))
    (tmp_path / "broken.zip").write_bytes(zip_bytes(members)[:-40])
    (tmp_path / "no archive.zip").write_bytes(b"something else")
    (tmp_path / "cut.tar.gz").write_bytes(tar_bytes(members)[:900])
    (tmp_path / "cut.tar").write_bytes(tar_bytes(members, "w")[:100_000])
    by_content = archives.expand_archives(archives.scan_archives(spark, f"file://{tmp_path}/*", "s"))
    got = archives.expand_listed(listed(spark, f"{tmp_path}/*"), group_bytes=1000)
    assert plain(got.collect()) == plain(by_content.collect())
    assert {(r.archive, r.n_members) for r in archives.unreadable(got).collect()} == {
        (r.archive, r.n_members) for r in archives.unreadable(by_content).collect()}


def test_one_zip_over_many_tasks(spark, tmp_path):
    (tmp_path / "a.zip").write_bytes(zip_bytes({f"{i}.v": "x" * 500 for i in range(400)}))
    got = archives.expand_listed(listed(spark, tmp_path / "a.zip"), group_bytes=5000, spread=8)
    rows = got.select("load_seq", "path", F.spark_partition_id().alias("task")).collect()
    assert sorted((r.load_seq, r.path) for r in rows) == [(i, f"{i}.v") for i in range(400)]
    assert len({r.task for r in rows}) >= 5


def test_archives_over_two_gib(spark, tmp_path):
    """Sparse files: a zip behind 2.2 GiB of nothing, and a tar with a member of 2.2 GiB between small ones."""
    far = (2 << 30) + (200 << 20)
    with open(tmp_path / "far.zip", "wb") as f:
        f.seek(far)
        f.write(zip_bytes({"a.v": "one", "b.v": "two"}))
    with open(tmp_path / "far.tar", "wb") as f:
        for name, size in (("a.v", 3), ("huge", far), ("b.v", 3)):
            info = tarfile.TarInfo(name)
            info.size = size
            f.write(info.tobuf(tarfile.GNU_FORMAT))
            f.write(b"abc") if size == 3 else f.seek(size, 1)
            f.seek(-size % 512, 1)
        f.write(b"\0" * 1024)
    assert min(r.length for r in listed(spark, f"{tmp_path}/far.*").collect()) > 2 << 30
    got = plain(archives.expand_listed(listed(spark, f"{tmp_path}/far.*")).collect())
    assert got == [("far.tar", 0, "a.v", b"abc"), ("far.tar", 1, None, None), ("far.tar", 2, "b.v", b"abc"), ("far.zip", 0, "a.v", b"one"), ("far.zip", 1, "b.v", b"two")]


def test_archives_are_packed_by_many_tasks(spark, tmp_path, monkeypatch):
    """Each archive is put together from the pieces of many tasks, and any reader takes it."""
    monkeypatch.setattr(archives.shutil, "rmtree", lambda *a, **k: None)
    rows = [(a, 3 * i, f"d/{'long' * 40}/{i}.v" if i % 50 == 1 else f"d/\u00e4{i}.v" if i % 50 == 2 else f"d/{i}.v", random.Random(i).randbytes(i * 7 % 3000))
            for a in ("a.zip", "b.tar", "c.tar.gz") for i in range(600)] + [("one.tgz", 5, "x", b"")]
    df = spark.createDataFrame(rows, "archive string, load_seq bigint, path string, content binary").orderBy("content")
    assert archives.pack_listed(df, str(tmp_path), piece_bytes=50_000) == len(rows)
    pieces = [f.stat().st_size for f in tmp_path.glob(".parts*/*")]
    assert len(pieces) > 40 and max(pieces) < 250_000 < min((tmp_path / a).stat().st_size for a in ("a.zip", "b.tar", "c.tar.gz"))
    want = [(a, i % 600, path, content) for i, (a, _, path, content) in enumerate(rows)]
    assert plain(archives.expand_listed(listed(spark, f"{tmp_path}/[a-z]*"), group_bytes=20_000).collect()) == sorted(want)
    assert plain(archives.expand_archives(archives.scan_archives(spark, f"file://{tmp_path}/[a-z]*", "s")).collect()) == sorted(want)
    with zipfile.ZipFile(tmp_path / "a.zip") as z:
        assert [("a.zip", i, m.filename, z.read(m)) for i, m in enumerate(z.infolist())] == want[:600]
    for name, lo in (("b.tar", 600), ("c.tar.gz", 1200)):
        with tarfile.open(tmp_path / name) as t:
            assert [(name, i, m.name, t.extractfile(m).read()) for i, m in enumerate(t)] == want[lo:lo + 600]


def test_pieces_beyond_four_gib(spark, tmp_path):
    """A piece at its place behind 5 GiB of nothing (a sparse file)."""
    piece = archives._Piece("far.zip", 0, f"{tmp_path}/part")
    piece.add("a.v", b"one")
    piece.add("b.v", b"two")
    row = dict(zip(("archive", "first", "part", "n", "size", "directory"), piece.end()))
    row |= {"at": 5 << 30, "directory_at": 0, "all_n": 2, "all_size": (5 << 30) + row["size"], "all_directory": row["directory"], "last": True}
    assert list(next(archives._place_pieces(str(tmp_path))(iter([pd.DataFrame([row])])))["n"]) == [2]
    with zipfile.ZipFile(tmp_path / "far.zip") as z:
        assert z.testzip() is None and z.infolist()[0].header_offset == 5 << 30
    assert plain(archives.expand_listed(listed(spark, tmp_path / "far.zip")).collect()) == [("far.zip", 0, "a.v", b"one"), ("far.zip", 1, "b.v", b"two")]


def test_gzip_tar_of_many_members_over_many_tasks(spark, tmp_path):
    """What is cut at entries is shared out, what is cut elsewhere or damaged is streamed; no member is lost."""
    tar = tar_bytes({f"{i}.v": random.Random(i).randbytes(900) for i in range(300)}, "w")
    pieces = [tar[i:i + 15 * 1536] for i in range(0, len(tar), 15 * 1536)]  # an entry has 1536 bytes
    (tmp_path / "cut.tgz").write_bytes(b"".join(map(archives._gzip_member, pieces)))
    (tmp_path / "elsewhere.tgz").write_bytes(b"".join(archives._gzip_member(tar[i:i + 10_000]) for i in range(0, len(tar), 10_000)))
    (tmp_path / "plain.tgz").write_bytes(b"".join(map(gzip.compress, pieces)))
    (tmp_path / "two.tbz").write_bytes(b"".join(map(bz2.compress, pieces)))
    (tmp_path / "two.txz").write_bytes(b"".join(map(lzma.compress, pieces)))
    bad = bytearray(b"".join(map(archives._gzip_member, pieces)))
    bad[len(bad) // 2] ^= 1
    (tmp_path / "bad.tgz").write_bytes(bad)
    got = archives.expand_listed(listed(spark, f"{tmp_path}/*"), group_bytes=30_000, spread=8)
    rows = got.withColumn("task", F.spark_partition_id()).collect()
    whole = ["cut.tgz", "elsewhere.tgz", "plain.tgz", "two.tbz", "two.txz"]
    want = [(a, i, f"{i}.v", random.Random(i).randbytes(900)) for a in whole for i in range(300)]
    assert plain(r for r in rows if r.archive in whole) == sorted(want)
    tasks = {a: len({r.task for r in rows if r.archive == a}) for a in whole}
    assert tasks["cut.tgz"] >= 4 and {tasks[a] for a in whole[1:]} == {1}
    by_content = archives.expand_archives(archives.scan_archives(spark, f"file://{tmp_path}/*", "s"))
    assert plain(rows) == plain(by_content.collect())
    broken = plain(r for r in rows if r.archive == "bad.tgz")
    assert 100 < len(broken) < 300 and broken[-1][2:] == (None, None)


def test_listed_archives_query_packs_in_pieces(spark, tmp_path, monkeypatch):
    from gatelake.plans import q_ingest
    from gatelake.plans.queries import QUERIES

    monkeypatch.setattr(q_ingest, "_mounted", lambda src, label: (f"file://{tmp_path}/{label}", f"{tmp_path}/{label}"))
    texts = {i: "".join(random.Random(i).choices("abc \n\u00e4", k=3000)) for i in range(400)}
    spark.createDataFrame([(i, t, "en", "s") for i, t in texts.items()], "doc_id bigint, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["expand_listed_archives"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == sorted((("all.zip", "all.tar", "all.tgz")[i % 3], f"{i}.v", hashlib.md5(t.encode()).hexdigest(), i // 3) for i, t in texts.items())
    with open(tmp_path / "archives" / "all.tgz", "rb") as f:
        assert len(archives._gzip_members(f)) > 2  # of several tasks, and the tar's end


def test_damaged_zip_member_by_path(spark, tmp_path):
    whole = bytearray(zip_bytes({"x/1": "one", "x/2": "two", "x/3": "three"}))
    whole[whole.index(b"two")] ^= 1
    (tmp_path / "a.zip").write_bytes(whole)
    got = archives.expand_listed(listed(spark, tmp_path / "a.zip"))
    assert [(n, p) for _, n, p, _ in plain(got.collect())] == [(0, "x/1"), (1, None), (2, "x/3")]


def test_scan_lists_folders_not_files(spark, tmp_path):
    """One path for a design however many files it has; files and folders beside and below the sources stay out."""
    tree(tmp_path, {"a": ("x", {**{f"sources/f{i}.v": str(i) for i in range(40)}, "sources.txt": "no", "sources_vhdl/z.vhd": "z", "top.txt": "t"})})
    for odd in ("sub", "k=1", "sources"):
        (tmp_path / "designs" / "a" / "sources" / odd).mkdir()
        (tmp_path / "designs" / "a" / "sources" / odd / "low.v").write_text("no")
    files = catalog.scan_files(spark, f"file://{tmp_path}")
    assert "InMemoryFileIndex(1 paths)" in files.select("text")._jdf.queryExecution().executedPlan().toString()
    assert {(r.file_name, r.text) for r in files.collect()} == {(f"f{i}.v", str(i)) for i in range(40)}
    every = {(r.file_name, r.role) for r in catalog.scan_files(spark, f"file://{tmp_path}", sources_only=False).collect()}
    assert every == {(f"f{i}.v", "verilog") for i in range(40)} | {("z.vhd", "vhdl"), ("top.txt", "top")}


def test_packed_archives_leave_tasks_in_slices():
    """A batch of many archives is handed on in slices, with the same rows."""
    import os

    import pandas as pd

    from gatelake.plans.q_ingest import _tars

    n = 40
    entries = pd.DataFrame({"dataset_name": ["x"] * n, "archive": [f"{i}.zip" for i in range(n)], "entries": [[{"path": "a.v", "text": os.urandom(300_000).hex()}] for _ in range(n)]})
    packed = list(archives._pack(iter([entries])))
    size = lambda pdf: sum(map(len, pdf["content"]))
    assert len(packed) > 1 and max(map(size, packed)) < 2 * archives.SLICE_BYTES and sum(map(len, packed)) == n
    tars = list(_tars(iter([pd.concat(packed[:1])])))
    assert len(tars) > 1 and max(map(size, tars)) < 2 * archives.SLICE_BYTES and sum(map(len, tars)) == 3 * len(packed[0])
    members = pd.concat(archives._expand(iter(tars)))
    assert sorted(members["content"]) == sorted(e[0]["text"].encode() for e in entries["entries"][:len(packed[0])] for _ in range(3))


def test_written_formats_are_small_and_whole(spark, tmp_path):
    """Compressed text formats read back as they were written, with rows of each partition value."""
    from gatelake.sources import sinks

    rows = [("x", f"d{i}", 'say "no"\r\n, ' + "  assign q = d;\n" * 500) for i in range(200)] + [("y", "e", " "), (None, "f", "g")]
    df = spark.createDataFrame(rows, "dataset_name string, design_name string, text string").repartition(2)
    csv = sinks.write_csv(df, f"{tmp_path}/csv", partition_by="dataset_name", compression="gzip")
    js = sinks.write_json(df, f"{tmp_path}/json", partition_by="dataset_name", compression="gzip")
    size = sum(f.stat().st_size for p in ("csv", "json") for f in (tmp_path / p).rglob("*.gz"))
    assert 0 < size < 200_000
    for back in (spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(csv), spark.read.schema(df.schema).json(js)):
        assert Counter(map(tuple, back.select(*df.columns).collect())) == Counter(rows)


def test_tree_is_listed_by_tasks(spark, tmp_path):
    """The driver lists no file of a mounted tree; rows are those of Spark's own scan, odd names and empty files included."""
    tree(tmp_path, {
        "a": ("x", {**{f"sources/f{i}.v": str(i) for i in range(40)}, "sources/_no.v": "n", "sources/.no.v": "n", "sources/_k=1.v": "y", "sources/x._COPYING_": "n",
                    "sources/e.v": "", "sources/a b%20#?.v": "\r\n", "sources.txt": "no", "sources_blif/z.blif": ".end", "top.txt": "t", "top.txt.bak": "o"}),
        "_b": ("y", {"sources/L.MIF": "0", "aux_files/n.txt": "n", "top.txt": ""}),
        "none": ("z", {"aux_files/.h": "n"})})
    (tmp_path / "designs" / "a" / "sources" / "latin.v").write_bytes(b"\xe9")
    (tmp_path / "designs" / "a" / "sources" / "sub").mkdir()
    (tmp_path / "designs" / "a" / "sources" / "sub" / "low.v").write_text("no")
    (tmp_path / "designs" / "readme").write_text("no design")
    (tmp_path / "designs" / "a" / "sources" / "link.v").symlink_to(tmp_path / "designs" / "a" / "top.txt")
    for root in (f"file://{tmp_path}", f"file:{tmp_path}", str(tmp_path)):
        for only in (True, False):
            raw = catalog._decode(catalog._scanned(spark, root, only)).drop("role").join(catalog.scan_designs(spark, root).select("design_name", "dataset_name"), "design_name")
            found = catalog.scan_files(spark, root, sources_only=only)
            plan = found._jdf.queryExecution().executedPlan().toString()
            assert "binaryFile" not in plan and plan.count("InMemoryFileIndex(") == 1  # design.json
            cols = ["design_name", "dataset_name", "file_name", "text"]
            assert Counter(map(tuple, found.select(*cols).collect())) == Counter(map(tuple, raw.select(*cols).collect()))
            roles = {(r.design_name, r.file_name): r.role for r in found.collect()}
            assert len(roles) == (45 if only else 48) and roles["_b", "L.MIF"] == "data"
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        catalog.scan_files(spark, f"file://{tmp_path}/designs")
    assert catalog.scan_files(spark, f"file://{tmp_path.parent}/{tmp_path.name[:-1]}?").count() == 45
