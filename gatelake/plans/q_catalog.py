"""Queries over the design catalogue and corpus summaries."""

from pyspark.sql import functions as F

from gatelake.functions import text as X
from gatelake.operators import summary
from gatelake.plans.registry import query
from gatelake.session import materialize
from gatelake.sources import catalog

_SIZES = r"""sizes AS (SELECT dataset_name, design_name, file_name,
  length(regexp_replace(text, '[\t-\r\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+', '', 'g')) AS num_chars,
  len(regexp_extract_all(text, 'module\s+\S+[\s\S]*?endmodule')) AS num_modules,
  len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\t-\r\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]'))) AS num_lines,
  strlen(text) AS num_bytes FROM
  (SELECT dataset_name, design_name, file_name, text FROM hdl_files UNION ALL SELECT dataset_name, design_name, file_name, text FROM text_files) u)"""
_READS = ("hdl_files", "text_files")
_COLS = ["dataset_name", "design_name", "file_name", "text"]


def _files(src):
    return src("hdl_files").select(_COLS).unionByName(src("text_files").select(_COLS))


def _designs(src):
    return src("hdl_designs").unionByName(src("text_designs"))


_ALL = "(SELECT design_name, dataset_name FROM hdl_designs UNION ALL SELECT design_name, dataset_name FROM text_designs)"
_ALL_READS = ("hdl_designs", "text_designs")


@query("scan_designs", f"SELECT * FROM {_ALL} ORDER BY design_name", _ALL_READS)
def scan_designs(src):
    return _designs(src).orderBy("design_name")


@query(
    "scan_files",
    f"""SELECT f.dataset_name, f.design_name, f.file_name,
        CASE WHEN ends_with(f.file_name, '.v') THEN 'verilog' ELSE 'aux' END AS role
        FROM (SELECT * FROM hdl_files UNION ALL SELECT dataset_name, design_name, file_name, 'x', text FROM text_files) f
        JOIN {_ALL} d ON d.design_name = f.design_name""",
    _READS + _ALL_READS,
)
def scan_files(src):
    joined = catalog.with_files(_designs(src), _files(src).drop("dataset_name"))
    return joined.select("dataset_name", "design_name", "file_name", X.file_role(F.col("file_name")).alias("role"))


@query("design_by_name", f"SELECT * FROM {_ALL} WHERE design_name = 'src3__en'", _ALL_READS)
def design_by_name(src):
    return catalog.by_name(_designs(src), "src3__en")


@query(
    "designs_by_regex",
    f"SELECT * FROM {_ALL} WHERE regexp_matches(design_name, '^(?:src1|.*__d1\\d)')", _ALL_READS)
def designs_by_regex(src):
    return catalog.by_name_regex(_designs(src), r"src1|.*__d1\d")


@query("designs_by_dataset", f"SELECT * FROM {_ALL} WHERE dataset_name = 'opencores'", _ALL_READS)
def designs_by_dataset(src):
    return catalog.by_dataset(_designs(src), "opencores")


@query(
    "files_by_extension",
    """SELECT page_id, path, 'any' AS form FROM p WHERE regexp_matches(path, '\\.(v|sv|svh|vh|h|inc|V|SV|SVH|VH|H|INC|coe|mif|mem|COE|MIF|MEM)$')
       UNION ALL SELECT page_id, path, 'lower' FROM p WHERE regexp_matches(path, '\\.(v|sv|svh|vh|h|inc)$')""".replace(
        "FROM p", "FROM (SELECT page_id, CASE WHEN page_id % 4 = 0 THEN upper(path) WHEN page_id % 4 = 1 THEN path || '.Sv' ELSE path END AS path FROM member_paths) p"),
    ("member_paths",),
)
def files_by_extension(src):
    k = F.col("page_id") % 4
    paths = src("member_paths").select(
        "page_id",
        F.when(k == 0, F.upper("path")).when(k == 1, F.concat("path", F.lit(".Sv"))).otherwise(F.col("path")).alias("file_name"))
    either = catalog.files_by_extension(paths, "source").withColumn("form", F.lit("any"))
    lower = catalog.files_by_extension(paths, "verilog", lower_only=True).withColumn("form", F.lit("lower"))
    return either.unionByName(lower).select("page_id", F.col("file_name").alias("path"), "form")


@query(
    "drop_testbenches",
    """SELECT page_id, file_name FROM (SELECT page_id, CASE WHEN page_id % 3 = 0 THEN replace(path, '.v', '_tb.v') ELSE path END AS file_name
       FROM member_paths) t WHERE NOT regexp_matches(file_name, '_tb(\\.[^.]*)?$')""",
    ("member_paths",),
)
def drop_testbenches(src):
    named = src("member_paths").select(
        "page_id", F.when(F.col("page_id") % 3 == 0, F.replace("path", F.lit(".v"), F.lit("_tb.v"))).otherwise(F.col("path")).alias("file_name"))
    return catalog.drop_testbenches(named)


@query(
    "design_name_derivation",
    "SELECT page_id, dataset_name || '__' || split_part(path, '/', -1) AS design_name FROM member_paths", ("member_paths",))
def design_name_derivation(src):
    return src("member_paths").select(
        "page_id", X.design_name(F.col("dataset_name"), X.base_name(F.col("path"))).alias("design_name"))


@query(
    "design_file_join",
    f"""SELECT d.dataset_name, d.design_name, f.file_name, length(f.text) AS n FROM {_ALL} d
        JOIN (SELECT design_name, file_name, text FROM hdl_files UNION ALL SELECT design_name, file_name, text FROM text_files) f
        ON f.design_name = d.design_name""",
    _READS + _ALL_READS,
)
def design_file_join(src):
    slim = _files(src).select("design_name", "file_name", F.length("text").cast("long").alias("n"))
    return catalog.with_files(_designs(src), slim).select("dataset_name", "design_name", "file_name", "n")


def _writes(src):
    """Two loads of the same designs: the later one rewrites some files of some designs."""
    first = src("hdl_files").select(*_COLS, F.lit(1).cast("long").alias("load_seq"))
    second = first.filter("design_name LIKE '%7'").withColumn("text", F.concat("text", F.lit("// v2"))).withColumn(
        "load_seq", F.lit(2).cast("long"))
    return first, second


@query(
    "last_written_files",
    """SELECT design_name, file_name, text, load_seq FROM (SELECT *, row_number() OVER (PARTITION BY design_name, file_name
       ORDER BY load_seq DESC) AS rn FROM (SELECT design_name, file_name, text, 1 AS load_seq FROM hdl_files UNION ALL
       SELECT design_name, file_name, text || '// v2', 2 FROM hdl_files WHERE design_name LIKE '%7') u) t WHERE rn = 1""",
    ("hdl_files",),
)
def last_written_files(src):
    first, second = _writes(src)
    return catalog.last_written(first.unionByName(second)).select("design_name", "file_name", "text", "load_seq")


@query(
    "upsert_designs",
    """SELECT design_name, file_name, text, 1 AS load_seq FROM hdl_files WHERE design_name NOT LIKE '%7' UNION ALL
       SELECT design_name, file_name, text || '// v2', 2 FROM hdl_files WHERE design_name LIKE '%7' AND file_name = 'core.v'
       UNION ALL SELECT design_name, file_name, text, 1 FROM hdl_files h WHERE design_name LIKE '%7' AND NOT EXISTS
       (SELECT 1 FROM hdl_files c WHERE c.design_name = h.design_name AND c.file_name = 'core.v')""",
    ("hdl_files",),
)
def upsert_designs(src):
    first, second = _writes(src)
    return catalog.upsert(first, second.filter("file_name = 'core.v'")).select("design_name", "file_name", "text", "load_seq")


@query(
    "delete_designs",
    f"SELECT * FROM {_ALL} WHERE design_name NOT IN ('src0__en', 'src2__en') AND design_name NOT LIKE 'koios%5'", _ALL_READS)
def delete_designs(src):
    kept = catalog.delete(_designs(src), ["src0__en", "src2__en"])
    return catalog.delete_by_table(kept, src("hdl_designs").filter("design_name LIKE 'koios%5'"))


@query("delete_unknown_names", f"SELECT 'nope__' || dataset_name AS design_name FROM hdl_designs GROUP BY 1", ("hdl_designs",))
def delete_unknown_names(src):
    designs = src("hdl_designs")
    asked = designs.select("design_name").unionByName(
        designs.select(F.concat(F.lit("nope__"), "dataset_name").alias("design_name")))
    return catalog.unknown_names(designs, asked)


@query("remove_dataset", f"SELECT * FROM {_ALL} WHERE dataset_name <> 'opencores'", _ALL_READS)
def remove_dataset(src):
    return catalog.remove_dataset(_designs(src), "opencores")


@query(
    "dataset_summary",
    f"SELECT dataset_name, count(*) AS n_designs FROM {_ALL} GROUP BY ROLLUP (dataset_name)", _ALL_READS)
def dataset_summary(src):
    return summary.dataset_summary(_designs(src))


@query(
    "designs_per_source",
    """SELECT dataset_name, count(DISTINCT design_name) AS num_designs FROM (SELECT dataset_name, design_name FROM hdl_files
       UNION ALL SELECT dataset_name, design_name FROM text_files) u GROUP BY ROLLUP (dataset_name)""",
    _READS,
)
def designs_per_source(src):
    return summary.designs_per_source(_files(src))


@query(
    "sizes_by_design",
    f"WITH {_SIZES} SELECT design_name, CAST(sum(num_chars) AS BIGINT) AS num_chars, CAST(sum(num_modules) AS BIGINT) AS num_modules FROM sizes GROUP BY design_name",
    _READS)
def sizes_by_design(src):
    return summary.sizes_by(summary.file_sizes(_files(src)), "design_name")


@query(
    "sizes_by_dataset",
    f"WITH {_SIZES} SELECT dataset_name, CAST(sum(num_chars) AS BIGINT) AS num_chars, CAST(sum(num_modules) AS BIGINT) AS num_modules FROM sizes GROUP BY dataset_name",
    _READS)
def sizes_by_dataset(src):
    return summary.sizes_by(summary.file_sizes(_files(src)), "dataset_name")


@query(
    "size_report",
    f"""WITH {_SIZES} SELECT 'design' AS level, design_name AS name, CAST(sum(num_chars) AS BIGINT) AS num_chars, CAST(sum(num_modules) AS BIGINT) AS num_modules
        FROM sizes GROUP BY design_name UNION ALL SELECT 'dataset', dataset_name, CAST(sum(num_chars) AS BIGINT), CAST(sum(num_modules) AS BIGINT) FROM sizes GROUP BY dataset_name
        UNION ALL SELECT 'total', NULL, CAST(sum(num_chars) AS BIGINT), CAST(sum(num_modules) AS BIGINT) FROM sizes""",
    _READS)
def size_report(src):
    return summary.size_report(summary.file_sizes(_files(src)))


@query(
    "corpus_totals",
    f"""WITH {_SIZES} SELECT CAST(sum(num_lines) AS BIGINT) AS total_lines, CAST(sum(num_bytes) AS BIGINT) AS total_bytes,
        CAST(sum(num_modules) AS BIGINT) AS total_modules, count(*) AS n_files, count(DISTINCT design_name) AS n_designs FROM sizes""",
    _READS)
def corpus_totals(src):
    return summary.corpus_totals(_files(src))


@query(
    "rank_series",
    """SELECT design_name, n_chars, row_number() OVER (ORDER BY n_chars, design_name) - 1 AS idx FROM
       (SELECT CAST(doc_id AS STRING) AS design_name, n_chars FROM documents) t""",
)
def rank_series(src):
    return summary.rank_series(
        src("documents").select(F.col("doc_id").cast("string").alias("design_name"), "n_chars"), "n_chars", "design_name")


@query(
    "histogram_log",
    """SELECT CAST(CASE WHEN v <= 0 THEN -1 ELSE least(floor((ln(v) - lo) * 100 / (hi - lo) + 1e-9), 99) END AS INT) AS bin, count(*) AS n FROM
       (SELECT n_chars - 1 AS v FROM documents UNION ALL SELECT 0 FROM labels) d,
       (SELECT ln(min(n_chars - 1)) AS lo, ln(max(n_chars - 1)) AS hi FROM documents WHERE n_chars > 1) b GROUP BY 1""",
)
def histogram_log(src):
    values = src("documents").select((F.col("n_chars") - 1).alias("v")).unionByName(
        src("labels").select(F.lit(0).cast("long").alias("v")))
    return summary.log_histogram(values, "v", 100)


@query("bar_series", "SELECT source, CAST(sum(n_chars) AS BIGINT) AS total FROM documents GROUP BY source")
def bar_series(src):
    return summary.bar_series(src("documents"), "source", "n_chars")


@query(
    "duplicate_modules_check",
    """SELECT design_name, module_name, count(*) AS n FROM (SELECT design_name, 'm' || CAST(least(n, 5) AS STRING) AS module_name
       FROM mods) t GROUP BY ALL HAVING count(*) > 1""",
    ("mods",),
)
def duplicate_modules_check(src):
    from gatelake.operators.grouping import duplicated

    named = src("mods").select("design_name", F.concat(F.lit("m"), F.least("n", F.lit(5)).cast("string")).alias("module_name"))
    return duplicated(named, "design_name", "module_name")


@query("module_count", "SELECT design_name, count(DISTINCT module_name) AS num_modules FROM modules GROUP BY design_name", ("modules",))
def module_count(src):
    return summary.module_count(src("modules"))


@query(
    "external_corpus_scan",
    "SELECT md5(text) AS h, length(text) AS n FROM conversations")
def external_corpus_scan(src):
    """Round trip through a CSV corpus with multi-line text."""
    from gatelake.sources.sinks import write_csv

    path = write_csv(src("conversations").select("text"), "external_corpus")
    return catalog.scan_external_corpus(src.spark, path).select(F.md5("text").alias("h"), F.length("text").cast("long").alias("n"))
