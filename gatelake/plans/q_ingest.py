"""Queries over ingest: archives, rules, shared files, index pages, sinks, flows and quality checks."""

import json
import os
import uuid

import pandas as pd
from pyspark.sql import functions as F

from gatelake.functions import text as X
from gatelake.operators import quality
from gatelake.plans import flows
from gatelake.plans.registry import query
from gatelake.session import materialize, shared_dir
from gatelake.sources import archives, catalog, index_pages, rules, sinks


def _archives(src):
    """One zip per document with three members; the text is the document's."""
    doc = F.col("doc_id").cast("string")
    stem = F.concat_ws("/", F.lit("designs"), "source", "lang")

    def entry(path, text):
        return F.struct(path.alias("path"), text.alias("text"))

    packed = src("documents").select(
        F.lit("opencores").alias("dataset_name"), F.concat(doc, F.lit(".zip")).alias("archive"),
        F.array(
            entry(F.concat(stem, F.lit("/"), doc, F.lit(".v")), F.col("text")),
            entry(F.concat(stem, F.lit("/top.txt")), F.col("lang")),
            entry(F.concat(stem, F.lit("/README.md")), F.col("source")),
        ).alias("entries"))
    return archives.pack_archives(packed)


_MEMBERS = """members AS (SELECT CAST(doc_id AS STRING) || '.zip' AS archive, 'designs/' || source || '/' || lang || '/' || doc_id || '.v' AS path, md5(text) AS h, 0 AS load_seq FROM documents
  UNION ALL SELECT CAST(doc_id AS STRING) || '.zip', 'designs/' || source || '/' || lang || '/top.txt', md5(lang), 1 FROM documents
  UNION ALL SELECT CAST(doc_id AS STRING) || '.zip', 'designs/' || source || '/' || lang || '/README.md', md5(source), 2 FROM documents)"""


@query("expand_archives", f"WITH {_MEMBERS} SELECT archive, path, h, CAST(load_seq AS BIGINT) AS load_seq FROM members")
def expand_archives(src):
    return archives.expand_archives(_archives(src)).select("archive", "path", F.md5("content").alias("h"), "load_seq")


@query(
    "expand_nested_archives",
    f"WITH {_MEMBERS} SELECT 'outer' || archive || '!in/' || archive AS archive, path, h FROM members")
def expand_nested(src):
    """Zips inside zips: the outer member is the inner archive's bytes."""
    inner = _archives(src)
    outer = inner.mapInPandas(_wrap, "dataset_name string, archive string, content binary")
    return archives.expand_nested(archives.expand_archives(outer)).select("archive", "path", F.md5("content").alias("h"))


@query(
    "expand_tar_archives",
    f"WITH {_MEMBERS} SELECT kind || '.' || archive AS archive, path, h, CAST(load_seq AS BIGINT) AS load_seq FROM members, (VALUES ('tar'), ('tgz'), ('txz')) k(kind)")
def expand_tars(src):
    """Plain, gzip and xz tars of the same members."""
    packed = _archives(src).mapInPandas(_tars, "dataset_name string, archive string, content binary")
    return archives.expand_archives(packed).select("archive", "path", F.md5("content").alias("h"), "load_seq")


def _tars(batches):
    import io
    import tarfile
    import zipfile

    cols = ["dataset_name", "archive", "content"]
    for pdf in batches:
        rows, size = [], 0
        for dataset, name, content in zip(pdf["dataset_name"], pdf["archive"], pdf["content"]):
            with zipfile.ZipFile(io.BytesIO(content)) as z:
                members = [(i.filename, z.read(i)) for i in z.infolist()]
            for kind, mode in (("tar", "w"), ("tgz", "w:gz"), ("txz", "w:xz")):
                buf = io.BytesIO()
                with tarfile.open(fileobj=buf, mode=mode) as t:
                    for path, data in members:
                        info = tarfile.TarInfo(path)
                        info.size = len(data)
                        t.addfile(info, io.BytesIO(data))
                rows.append((dataset, f"{kind}.{name}", buf.getvalue()))
                size += len(rows[-1][2])
            if size >= archives.SLICE_BYTES:  # bounded output batches
                yield pd.DataFrame(rows, columns=cols)
                rows, size = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=cols)


def _wrap(batches):
    import io
    import zipfile

    for pdf in batches:
        out = []
        for name, content in zip(pdf["archive"], pdf["content"]):
            buf = io.BytesIO()
            with zipfile.ZipFile(buf, "w") as z:
                z.writestr(f"in/{name}", content)
            out.append(buf.getvalue())
        yield pdf.assign(archive="outer" + pdf["archive"], content=out)[["dataset_name", "archive", "content"]]


@query(
    "classify_members",
    """SELECT page_id, path, role FROM (SELECT page_id, path, CASE WHEN ends_with(path, '.v') THEN 'verilog' ELSE 'aux' END AS role FROM member_paths
       UNION ALL SELECT page_id, path, 'top' FROM member_paths WHERE ends_with(path, '/top.txt')) t""",
    ("member_paths",))
def classify_members(src):
    return rules.classify_members(src("member_paths")).select("page_id", "path", "role")


@query(
    "apply_source_rules",
    r"""SELECT page_id, design_name, file_name, role FROM (
        SELECT page_id, 'opencores__' || split_part(path, '/', 2) AS design_name, split_part(path, '/', -1) AS file_name,
          unnest(CASE WHEN ends_with(path, '/top.txt') THEN ['top', 'aux'] WHEN ends_with(path, '.v') THEN ['verilog'] ELSE ['aux'] END) AS role
          FROM member_paths WHERE dataset_name = 'opencores' AND path LIKE 'designs/%' AND split_part(path, '/', 2) <> '6809_6309_compatible_core'
        UNION ALL SELECT page_id, 'hw2vec__' || replace(split_part(path, '/', -2), '-', '_'), split_part(path, '/', -1), 'verilog'
          FROM member_paths WHERE dataset_name = 'hw_2_vec' AND NOT contains('RS232-T100', split_part(path, '/', -2))
        UNION ALL SELECT page_id, 'vtr__' || replace(split_part(path, '/', -1), '.v', ''), split_part(path, '/', -1), 'verilog'
          FROM member_paths WHERE dataset_name = 'vtr' AND split_part(path, '/', -1) <> 'mcml.v'
        UNION ALL SELECT page_id, dataset_name || '__' || upper(replace(split_part(path, '/', -1), '.v', '')), split_part(path, '/', -1), 'verilog'
          FROM member_paths WHERE dataset_name IN ('iscas85', 'iscas89')
        UNION ALL SELECT page_id, 'lgsynth91__' || replace(replace(split_part(path, '/', -1), '_orig.v', ''), '.', '_'), split_part(path, '/', -1), 'verilog'
          FROM member_paths WHERE dataset_name = 'lgsynth91') t""",
    ("member_paths",))
def apply_source_rules(src):
    return rules.apply_rules(src("member_paths")).select("page_id", "design_name", "file_name", "role")


_SHARED = """shared AS (SELECT * FROM (VALUES ('vtr', 'primitives.v', 'verilog', 'p'), ('koios', 'lib.v', 'verilog', 'l'),
  ('koios', 'DFF2.v', 'verilog', 'd')) v(dataset_name, file_name, role, text))"""


@query(
    "attach_shared_files",
    f"""WITH {_SHARED} SELECT dataset_name, design_name, file_name, md5(text) AS h FROM hdl_files UNION ALL
        SELECT d.dataset_name, d.design_name, s.file_name, md5(s.text) FROM hdl_designs d JOIN shared s ON s.dataset_name = d.dataset_name""",
    ("hdl_files", "hdl_designs"))
def attach_shared_files(src):
    shared = src.spark.createDataFrame(
        [("vtr", "primitives.v", "verilog", "p"), ("koios", "lib.v", "verilog", "l"), ("koios", "DFF2.v", "verilog", "d")],
        "dataset_name string, file_name string, role string, text string")
    return rules.attach_shared_files(src("hdl_files"), src("hdl_designs"), shared).select(
        "dataset_name", "design_name", "file_name", F.md5("text").alias("h"))


@query(
    "source_plugin_load",
    """WITH d AS (SELECT 'opencores__' || source AS design_name, doc_id, lang, text,
         row_number() OVER (PARTITION BY source ORDER BY CAST(doc_id AS STRING) || '.zip' DESC) AS late FROM documents)
       SELECT 'files' AS t, design_name, CAST(doc_id AS STRING) || '.v' AS file_name, 'verilog' AS role, md5(text) AS h FROM d
       UNION ALL SELECT DISTINCT 'files', 'opencores__' || source, 'README.md', 'aux', md5(source) FROM documents
       UNION ALL SELECT 'files', design_name, 'top.txt', unnest(['top', 'aux']), md5(lang) FROM d WHERE late = 1
       UNION ALL SELECT DISTINCT 'designs', 'opencores__' || source, 'opencores', 'open_source', NULL FROM documents""")
def source_plugin_load(src):
    """Every document writes ``top.txt``: the member of the last archive by name stays."""
    members = materialize(archives.expand_archives(_archives(src)), "members")
    designs, files = rules.SOURCES["opencores"]().load(members)
    return files.select(F.lit("files").alias("t"), "design_name", "file_name", "role", F.md5("text").alias("h")).unionByName(
        designs.select(F.lit("designs").alias("t"), "design_name", F.col("dataset_name").alias("file_name"),
                       F.array_join("dataset_tags", ",").alias("role"), F.lit(None).cast("string").alias("h")))


@query(
    "bad_input_ingest",
    """SELECT 'file' AS kind, CAST(doc_id AS STRING) AS name, CASE WHEN doc_id % 5 = 0 THEN 'not_utf8' ELSE 'ok' END AS status,
         CAST(CASE WHEN doc_id % 5 = 0 THEN strlen(text) + 1 ELSE length(text) END AS BIGINT) AS n FROM documents
       UNION ALL SELECT 'archive', doc_id || '.zip', 'unreadable_archive', 0 FROM documents WHERE doc_id % 7 = 0
       UNION ALL SELECT 'members', doc_id || '.zip', 'ok', 3 FROM documents WHERE doc_id % 7 <> 0""")
def bad_input_ingest(src):
    """Every fifth file has a byte that is no UTF-8, every seventh archive is cut off: both are named, the rest is kept."""
    content = F.when(F.col("doc_id") % 5 == 0, F.concat(F.col("text").cast("binary"), F.lit(bytes([0xE9])))).otherwise(F.col("text").cast("binary"))
    read = src("documents").select("doc_id", content.alias("c")).select(
        F.lit("file").alias("kind"), F.col("doc_id").cast("string").alias("name"), X.decode_status(F.col("c")).alias("status"),
        F.char_length(X.decode_text(F.col("c"))).cast("long").alias("n"))
    cut = F.split("archive", "[.]")[0].cast("long") % 7 == 0
    packed = _archives(src).withColumn("content", F.when(cut, F.expr("substring(content, 1, octet_length(content) - 30)")).otherwise(F.col("content")))
    members = materialize(archives.expand_archives(packed), "members")
    broken = archives.unreadable(members).select(F.lit("archive").alias("kind"), F.col("archive").alias("name"), "status", F.col("n_members").alias("n"))
    whole = members.filter("path IS NOT NULL").groupBy(F.col("archive").alias("name")).agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("members").alias("kind"), "name", F.lit("ok").alias("status"), "n")
    return read.unionByName(broken).unionByName(whole)


def _mounted(src, label: str) -> tuple[str, str]:
    """A new place in the shared folder as Spark and as a task's ``open`` name it."""
    shared = shared_dir(src.spark)
    if not shared.startswith(("file:", "/")):
        raise ValueError(f"tasks write files to {shared}: the shared folder has to be mounted on all machines")
    path = "/" + shared.removeprefix("file:").lstrip("/") + f"/gatelake/{label}-{uuid.uuid4().hex}"
    return f"file://{path}", path


_PLACES = """WITH f AS (SELECT doc_id % 3 AS k, doc_id, text FROM documents), o AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id) - 1 AS n FROM f)
  SELECT CASE k WHEN 0 THEN 'all.zip' WHEN 1 THEN 'all.tar' ELSE 'all.tgz' END AS archive, CAST(doc_id AS STRING) || '.v' AS path, md5(text) AS h, CAST(n AS BIGINT) AS load_seq FROM o"""


@query("expand_listed_archives", _PLACES)
def expand_listed(src):
    """A zip, a tar and a gzip tar of a third of the documents each, written and read by path in groups of members."""
    root, local = _mounted(src, "archives")
    k = F.col("doc_id") % 3
    archives.pack_listed(src("documents").select(
        F.when(k == 0, "all.zip").when(k == 1, "all.tar").otherwise("all.tgz").alias("archive"),
        F.concat(F.col("doc_id").cast("string"), F.lit(".v")).alias("path"), F.col("text").cast("binary").alias("content"),
        F.col("doc_id").alias("load_seq")), local)
    listed = archives.list_archives(src.spark, f"{root}/all.*", "opencores")
    return archives.expand_listed(listed, group_bytes=1 << 20).select("archive", "path", F.md5("content").alias("h"), "load_seq")


def _tree(src) -> str:
    """A design tree of the text corpus in the shared folder, written by the tasks: one design per source and language."""
    root, local = _mounted(src, "tree")

    def write(batches):
        begun = set()  # a task writes what belongs to a design once
        for pdf in batches:
            for design, dataset, name, text in zip(pdf["design_name"], pdf["dataset_name"], pdf["file_name"], pdf["text"]):
                folder, files = f"{local}/designs/{design}", [(f"sources/{name}", text)]
                if (design, dataset) not in begun:
                    begun.add((design, dataset))
                    os.makedirs(f"{folder}/sources", exist_ok=True)
                    os.makedirs(f"{folder}/aux_files", exist_ok=True)
                    meta = {"design_name": design, "dataset_name": dataset, "dataset_tags": ["benchmark"]}
                    files += [("design.json", json.dumps(meta)), ("aux_files/note.txt", dataset), ("top.txt", "top")]
                for path, body in files:
                    part = f"{folder}/.{uuid.uuid4().hex}"
                    with open(part, "w", newline="") as f:
                        f.write(body)
                    os.replace(part, f"{folder}/{path}")
            yield pd.DataFrame({"n": [len(pdf)]})

    src("text_files").mapInPandas(write, "n long").agg(F.sum("n")).first()
    return root


@query(
    "scan_design_tree",
    """WITH d AS (SELECT DISTINCT source || '__' || lang AS design_name, source AS dataset_name FROM documents),
         t AS (SELECT source || '__' || lang AS design_name, source AS dataset_name, CAST(doc_id AS STRING) || '.v' AS file_name,
           md5(replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10))) AS h FROM documents)
       SELECT 'designs' AS t, design_name, dataset_name, 'benchmark' AS file_name, NULL AS role, NULL AS h FROM d
       UNION ALL SELECT k, design_name, dataset_name, file_name, 'verilog', h FROM t, (VALUES ('sources'), ('all')) v(k)
       UNION ALL SELECT 'all', design_name, dataset_name, 'note.txt', 'aux', md5(dataset_name) FROM d
       UNION ALL SELECT 'all', design_name, dataset_name, 'top.txt', 'top', md5('top') FROM d""")
def scan_design_tree(src):
    """Both scans over a real directory tree."""
    root = _tree(src)
    designs = catalog.scan_designs(src.spark, root).select(
        F.lit("designs").alias("t"), "design_name", "dataset_name", F.array_join("dataset_tags", ",").alias("file_name"),
        F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("h"))
    both = [
        catalog.scan_files(src.spark, root, sources_only=only).select(F.lit(t).alias("t"), "design_name", "dataset_name", "file_name", "role", F.md5("text").alias("h"))
        for t, only in (("sources", True), ("all", False))
    ]
    return designs.unionByName(both[0]).unionByName(both[1])


@query(
    "stored_catalogue",
    """SELECT design_name, dataset_name, file_name, CASE WHEN design_name LIKE '%0' THEN 'new' ELSE md5(text) END AS h FROM hdl_files
       WHERE dataset_name <> 'koios' AND design_name NOT LIKE '%1'
       AND (design_name NOT LIKE '%0' OR file_name = 'core.v' OR NOT EXISTS (SELECT 1 FROM hdl_files o WHERE o.design_name = hdl_files.design_name AND o.file_name = 'core.v'))""",
    ("hdl_files",))
def stored_catalogue(src):
    """Upsert all designs, upsert some again with one file each, delete by a table, remove one source."""
    store = catalog.Catalogue(src.spark, f"{shared_dir(src.spark)}/gatelake/store-{uuid.uuid4().hex}", buckets=8)
    files = src("hdl_files")
    designs = src("hdl_designs").withColumn("dataset_tags", F.array(F.lit("x")))
    store.upsert(designs, files)
    again = files.filter("design_name LIKE '%0'").groupBy("dataset_name", "design_name").agg(F.min("file_name").alias("file_name")).select(
        "dataset_name", "design_name", "file_name", F.lit("verilog").alias("role"), F.lit("new").alias("text"))
    store.upsert(designs.filter("design_name LIKE '%0'"), again)
    store.delete_by_table(designs.filter("design_name LIKE '%1'").select("design_name"))
    store.remove_dataset("koios")
    return store.files.join(store.designs.select("design_name"), "design_name", "left_semi").select(
        "design_name", "dataset_name", "file_name", F.when(F.col("text") == "new", "new").otherwise(F.md5("text")).alias("h"))


_ITEMS = "SELECT p_partkey AS id, p_type || '/' || p_name AS full_name, 'https://x.org/' || p_partkey AS html_url FROM part"


@query("merge_index_pages", _ITEMS)
def merge_index_pages(src):
    return index_pages.merge_index_pages(src("search_pages"))


@query("distinct_repos", f"SELECT DISTINCT full_name FROM ({_ITEMS}) t")
def distinct_repos(src):
    return index_pages.distinct_repos(src("search_pages"))


@query("core_manifests", "SELECT p_partkey, split_part(p_name, ' ', 1) AS name FROM part")
def core_manifests(src):
    text = F.concat(F.lit("CAPI=2:\n  name: inner\nname : "), "p_name", F.lit("\ndescription: name: x\n"))
    return index_pages.manifest_names(src("part").select("p_partkey", text.alias("text")))


@query(
    "write_sinks",
    "SELECT fmt, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS chars FROM hdl_files, (VALUES ('csv'), ('json'), ('parquet')) f(fmt) GROUP BY fmt",
    ("hdl_files",))
def write_sinks(src):
    """Write the files table in each format, partitioned by source, and read it back."""
    spark, schema = src.spark, src("hdl_files").schema
    pq = spark.read.parquet(sinks.write_parquet(src("hdl_files"), "files_parquet"))
    files = pq.select(*schema.names)  # the text formats are written from the table, not from the lines once more
    csv = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(
        sinks.write_csv(files, "files_csv", partition_by="dataset_name", compression="gzip"))
    js = spark.read.schema(schema).json(sinks.write_json(files, "files_json", partition_by="dataset_name", compression="gzip"))
    parts = [df.select(F.lit(f).alias("fmt"), "text") for f, df in (("csv", csv), ("json", js), ("parquet", pq))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("fmt").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars"))


@query(
    "run_flow",
    """SELECT design_name, 'line_count' AS flow_name, 'text' AS flow_tags, CAST(sum(len(string_split(text, chr(10))) - 1) AS STRING) AS value FROM hdl_files GROUP BY design_name
       UNION ALL SELECT design_name, 'module_count', 'text', CAST(count(*) AS STRING) FROM modules GROUP BY design_name
       UNION ALL SELECT design_name, 'user', 'text,demo', CAST(count(*) AS STRING) FROM hdl_files GROUP BY design_name""",
    ("hdl_files", "modules"))
def run_flow(src):
    user = flows.per_file_flow(
        "user", ("text", "demo"), lambda pdf: pdf[["design_name"]].assign(n=1), "design_name string, n bigint", {"n_files": F.sum("n")})
    files = src("hdl_files")
    runs = [(flows.LINE_COUNT, "num_lines"), (flows.MODULE_COUNT, "num_modules"), (user, "n_files")]
    out = None
    for flow, metric in runs:
        rows = flows.run_flow(flow, files).select(
            "design_name", "flow_name", F.concat_ws(",", "flow_tags").alias("flow_tags"), F.col("metrics")[metric].alias("value"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query(
    "validate_source",
    """SELECT design_name || '_empty' AS design_name, 'has_module' AS "check", 'no module found' AS detail FROM hdl_designs WHERE design_name LIKE '%9'
       UNION ALL SELECT design_name, 'duplicate_module', 'm4 x2' FROM modules WHERE module_name = 'm4'
       UNION ALL SELECT design_name, 'one_file', 'm4 in 2 files' FROM modules WHERE module_name = 'm4'
       UNION ALL SELECT i.design_name, 'acyclic', CAST(1 + count(c.child) AS STRING) || ' modules on or behind a cycle' FROM
         (SELECT design_name FROM modules WHERE module_name = 'm4') i
         LEFT JOIN inst c ON c.design_name = i.design_name AND c.parent = 'm4' GROUP BY i.design_name""",
    ("hdl_designs", "modules", "inst"))
def validate_source(src):
    """Some designs without files are added; designs with m4 get a second, self-instantiating m4."""
    files, designs = materialize(src("hdl_files"), "files"), materialize(src("hdl_designs"), "designs")  # each is read twice
    extra = files.filter(F.col("text").rlike("module m4[ ;]")).select(
        "dataset_name", "design_name", F.lit("dup.v").alias("file_name"), "role",
        F.lit("module m4 (input a);\n  m4 again (.a(a));\nendmodule\n").alias("text"))
    empty = designs.filter("design_name LIKE '%9'").withColumn("design_name", F.concat("design_name", F.lit("_empty")))
    return quality.violations(designs.unionByName(empty), files.unionByName(extra))


@query(
    "error_policy_split",
    """SELECT status, count(*) AS n FROM (SELECT CASE count(DISTINCT CASE WHEN n <= 3 THEN 'core.v' ELSE 'leaf.v' END) WHEN 1 THEN 'ok' ELSE 'ambiguous' END AS status
       FROM (SELECT design_name, n, CAST(least(n, 5) AS INT) % 4 AS k FROM mods) t GROUP BY design_name, k) s GROUP BY status""",
    ("mods",))
def error_policy_split(src):
    mods = src("mods").select(
        "design_name", F.concat(F.lit("k"), (F.least("n", F.lit(5)) % 4).cast("string")).alias("module_name"),
        F.when(F.col("n") <= 3, "core.v").otherwise("leaf.v").alias("file_name"))
    from gatelake.operators.modules import locate_modules

    ok, bad = quality.split_status(locate_modules(mods, mods.select("design_name", "module_name").distinct()))
    return ok.unionByName(bad).groupBy("status").agg(F.count(F.lit(1)).alias("n"))
