"""Queries over source text: counts, cleaning, module extraction and hashing."""

from pyspark.sql import functions as F

from gatelake.functions import text as X
from gatelake.operators import hashing, modules
from gatelake.plans import oracle_sql as O
from gatelake.plans.registry import query
from gatelake.session import materialize

_EX = f"extracted AS ({O.extracted()})"
_HS = f"{_EX}, hashes AS ({O.HASHES})"


@query(
    "line_count",
    """SELECT design_name, CAST(sum(CASE WHEN text = '' THEN 0 ELSE len(string_split(text, chr(10)))
       - CASE WHEN ends_with(text, chr(10)) THEN 1 ELSE 0 END END) AS BIGINT) AS num_lines
       FROM (SELECT design_name, text FROM text_files UNION ALL SELECT design_name, text FROM hdl_files) t
       GROUP BY design_name""",
    ("text_files", "hdl_files"),
)
def line_count(src):
    both = src("text_files").select("design_name", "text").unionByName(
        src("hdl_files").select("design_name", "text"))
    return both.groupBy("design_name").agg(F.sum(X.line_count(F.col("text"))).alias("num_lines"))


@query(
    "non_blank_lines",
    f"""SELECT design_name, file_name,
        len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{O.NON_WS}'))) AS num_lines
        FROM text_files""",
    ("text_files",),
)
def non_blank_lines(src):
    return src("text_files").select("design_name", "file_name", X.non_blank_lines(F.col("text")).alias("num_lines"))


@query(
    "non_whitespace_chars",
    f"SELECT design_name, file_name, length(regexp_replace(text, '{O.WS}+', '', 'g')) AS num_chars FROM text_files",
    ("text_files",),
)
def non_whitespace_chars(src):
    return src("text_files").select("design_name", "file_name", X.non_whitespace_chars(F.col("text")).alias("num_chars"))


@query(
    "strip_comments",
    f"""SELECT design_name, file_name, list_aggregate(list_transform(range(len(toks) + 1),
          lambda i: gaps[i + 1] || CASE WHEN i < len(toks) THEN
            CASE WHEN toks[i + 1][1] = '/' THEN ' ' ELSE toks[i + 1] END ELSE '' END), 'string_agg', '') AS text
        FROM (SELECT design_name, file_name, string_split_regex(text, '{O.COMMENT}') AS gaps,
              regexp_extract_all(text, '{O.COMMENT}') AS toks FROM
              (SELECT design_name, file_name, text FROM hdl_files UNION ALL
               SELECT design_name, file_name, text FROM text_files) u) t""",
    ("hdl_files", "text_files"),
)
def strip_comments(src):
    cols = ["design_name", "file_name", "text"]
    both = src("hdl_files").select(cols).unionByName(src("text_files").select(cols))
    return both.withColumn("text", X.strip_comments(F.col("text")))


@query(
    "extract_modules",
    f"WITH {_EX} SELECT design_name, file_name, regexp_extract(body, '{'^module\\s+(' + O.IDENT + ')'}', 1) AS module_name, "
    "length(body) AS body_chars FROM extracted",
    ("hdl_files",),
)
def extract_modules(src):
    return modules.extract_modules(src("hdl_files")).select(
        "design_name", "file_name", "module_name", F.length("body").cast("long").alias("body_chars"))


@query(
    "count_modules",
    r"""SELECT design_name, file_name, len(regexp_extract_all(text, 'module\s+\S+[\s\S]*?endmodule')) AS num_modules,
        len(regexp_extract_all(text, 'module[\s\S]*?endmodule')) AS num_definitions FROM hdl_files""",
    ("hdl_files",),
)
def count_modules(src):
    t = F.col("text")
    return src("hdl_files").select(
        "design_name", "file_name", X.count_modules(t).alias("num_modules"),
        X.count_modules(t, definition_only=True).alias("num_definitions"))


@query("module_hash", f"WITH {_HS} SELECT * FROM hashes", ("hdl_files",))
def module_hash(src):
    return modules.module_hashes(src("hdl_files"))


@query(
    "module_hash_strict_header",
    f"WITH {_HS.replace('FROM extracted', 'FROM (SELECT * FROM extracted WHERE regexp_matches(body, ' + chr(39) + '^module\\s+[A-Za-z_][\\w$]*\\s*[(#]' + chr(39) + ')) e')} SELECT * FROM hashes",
    ("hdl_files",),
)
def module_hash_strict(src):
    return modules.module_hashes(src("hdl_files"), compat="strict_header")


@query(
    "hash_frequency",
    f"WITH {_HS} SELECT h.*, count(*) OVER (PARTITION BY module_hash) AS unique_count FROM hashes h",
    ("hdl_files",),
)
def hash_frequency(src):
    return hashing.hash_report(modules.module_hashes(src("hdl_files"), position=True))


@query(
    "module_hash_counts",
    f"WITH {_HS} SELECT module_hash, count(*) AS unique_count FROM hashes GROUP BY module_hash",
    ("hdl_files",),
)
def module_hash_counts(src):
    return hashing.hash_counts(modules.module_hashes(src("hdl_files")))


@query(
    "module_hash_totals",
    f"""WITH {_HS} SELECT count(*) AS n_modules, count(DISTINCT module_hash) AS n_hashes,
        count(DISTINCT design_name) AS n_designs FROM hashes""",
    ("hdl_files",),
)
def module_hash_totals(src):
    return hashing.hash_totals(modules.module_hashes(src("hdl_files")))


@query(
    "sorted_hash_listing",
    f"""WITH {_HS} SELECT h.*, count(*) OVER (PARTITION BY module_hash) AS unique_count FROM hashes h
        ORDER BY unique_count DESC, module_hash DESC, module_name DESC, design_name DESC, dataset_name DESC""",
    ("hdl_files",),
)
def sorted_hash_listing(src):
    return hashing.sorted_listing(hashing.hash_report(modules.module_hashes(src("hdl_files"), position=True)))


@query(
    "literal_rewrites",
    """SELECT design_name, file_name, replace(replace(text, 'module m1', '(* keep *)' || chr(10) || 'module m1'),
       'wire clk', 'wire [0:0] clk') AS text FROM hdl_files""",
    ("hdl_files",),
)
def literal_rewrites(src):
    pairs = [("module m1", "(* keep *)\nmodule m1"), ("wire clk", "wire [0:0] clk")]
    return src("hdl_files").select("design_name", "file_name", X.literal_rewrites(F.col("text"), pairs).alias("text"))


@query(
    "name_cleanup",
    """SELECT page_id, upper(replace(replace(CASE WHEN ends_with(b, '_orig.v') THEN left(b, length(b) - 7) ELSE b END,
       '-', '_'), '.', '_')) AS name FROM (SELECT page_id, split_part(path, '/', -1) AS b FROM member_paths) t""",
    ("member_paths",),
)
def name_cleanup(src):
    base = X.base_name(F.col("path"))
    return src("member_paths").select(
        "page_id", X.clean_name(base, {"-": "_", ".": "_"}, upper=True, suffix="_orig.v").alias("name"))


@query(
    "module_body_lookup",
    f"""WITH bodies AS (SELECT design_name, file_name, unnest(regexp_extract_all(text, '{O.MODULE_OR_COMMENT}')) AS body
        FROM hdl_files) SELECT design_name, file_name, regexp_extract(body, '^module\\s+([A-Za-z_][\\w$]*)', 1) AS module_name,
        body FROM bodies WHERE body LIKE 'module%' AND regexp_extract(body, '^module\\s+([A-Za-z_][\\w$]*)', 1) IN ('m2', 'm5')""",
    ("hdl_files",),
)
def module_body_lookup(src):
    wanted = src("modules").filter(F.col("module_name").isin("m2", "m5"))
    found = modules.body_of(modules.extract_modules(src("hdl_files"), comments="keep"), wanted)
    return found.select("design_name", "file_name", "module_name", "body")


@query(
    "hierarchy_from_text",
    f"""WITH {_EX}, named AS (SELECT design_name, regexp_extract(body, '^module\\s+([A-Za-z_][\\w$]*)', 1) AS parent,
        regexp_replace(body, '^module\\s+[A-Za-z_][\\w$]*', '') AS rest FROM extracted)
        SELECT DISTINCT h.design_name, h.parent, h.child FROM (SELECT design_name, parent,
        unnest(regexp_extract_all(rest, '{O.INSTANCE_HEAD}', 1)) AS child FROM named) h
        JOIN (SELECT DISTINCT design_name, parent FROM named) m ON m.design_name = h.design_name AND m.parent = h.child""",
    ("hdl_files",),
)
def hierarchy_from_text(src):
    return modules.instances_from_text(materialize(modules.module_heads(src("hdl_files")), "heads"))


@query(
    "exactly_one_file_check",
    f"""WITH {_EX}, named AS (SELECT DISTINCT design_name, file_name,
        regexp_extract(body, '^module\\s+([A-Za-z_][\\w$]*)', 1) AS module_name FROM extracted),
        wanted AS (SELECT design_name, module_name FROM modules UNION ALL
                   SELECT design_name, 'absent' FROM hdl_designs)
        SELECT w.design_name, w.module_name, count(n.file_name) AS n_files,
        CASE count(n.file_name) WHEN 1 THEN 'ok' WHEN 0 THEN 'missing' ELSE 'ambiguous' END AS status
        FROM wanted w LEFT JOIN named n USING (design_name, module_name) GROUP BY ALL""",
    ("hdl_files", "modules", "hdl_designs"),
)
def exactly_one_file_check(src):
    wanted = src("modules").unionByName(
        src("hdl_designs").select("design_name", F.lit("absent").alias("module_name")))
    return modules.locate_modules(modules.extract_modules(src("hdl_files")), wanted)
