"""Corpora derived from the given tables in portable SQL.

Each entry is one SELECT that both Spark and the checking engine accept (ordered
concatenation is rendered per engine), with ``{name}`` for the tables it reads. ``corpus(spark, sf_dir, name)`` builds the
DataFrame; ``corpus_ctes(names)`` renders the same SELECTs as a WITH clause.

A design is an order, its modules are the order's distinct line numbers (1–7).
Module *a* instantiates *b* when both exist and b is 2a, 2a+1 or a+3.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gatelake.session import n_buckets

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

_NL = "chr(10)"
_LINES = "SELECT /*+ REPARTITION(@parts, l_orderkey) */ l_orderkey, l_linenumber, l_returnflag FROM {lineitem}"


def _per_line(expr: str, sep: str = "''") -> str:
    """Concatenation over the lines of a design in order of n; rendered per engine."""
    return f"@ordered[{expr}@sep{sep}@]"


def _render(sql: str, engine: str) -> str:
    """What differs between the engines: ordered concatenation, and in Spark how rows are dealt.

    Spark deals the lines by order once, in three columns; a design is an order, so all
    that is grouped by design is grouped by its order as well and stays where it lies.
    """
    spark = engine == "spark"
    sql = sql.replace("@lines", f"({_LINES}) l" if spark else "lineitem").replace("@by_design", "okey, design_name" if spark else "design_name")
    while "@ordered[" in sql:
        head, rest = sql.split("@ordered[", 1)
        expr, rest = rest.split("@sep", 1)
        sep, tail = rest.split("@]", 1)
        if spark:
            call = f"array_join(transform(sort_array(collect_list(struct(n, {expr} AS t))), x -> x.t), {sep})"
        else:
            call = f"string_agg({expr}, {sep} ORDER BY n)"
        sql = head + call + tail
    return sql


def _has(b: str) -> str:
    """Whether the design also has module number ``b``."""
    return f"(mask & CAST(pow(2, {b}) AS BIGINT)) <> 0"


_SN = "CAST(n AS STRING)"
_MODULE_TEXT = (
    "'// unit ' || design_name || '.m' || " + _SN + " || " + _NL + " || "
    "CASE flag WHEN 'A' THEN 'module m' || " + _SN + " || ' #(parameter W = 8) ('"
    "          WHEN 'N' THEN 'module m' || " + _SN + " || ' ('"
    "          ELSE 'module m' || " + _SN + " || ';' END || " + _NL + " || "
    "CASE WHEN flag = 'R' THEN '' ELSE '    input wire clk, input wire d, output wire q);' || " + _NL + " END || "
    "'  /* flag ' || flag || ' in ' || design_name || ' */' || " + _NL + " || "
    "'  initial $display(\"lit // ' || flag || ' /* x */\");' || " + _NL + " || "
    "CASE WHEN " + _has("2 * n") + " THEN '  m' || CAST(2 * n AS STRING) || ' u_a (.clk(clk));' || chr(10) ELSE '' END || "
    "CASE WHEN " + _has("2 * n + 1") + " THEN '  m' || CAST(2 * n + 1 AS STRING) || ' #(.W(8)) u_b (.clk(clk));' || chr(10) ELSE '' END || "
    "CASE WHEN n NOT IN (2, 3) AND " + _has("n + 3") + " THEN '  m' || CAST(n + 3 AS STRING) || ' u_c (.clk(clk));' || chr(10) ELSE '' END || "
    "'  assign q = d; // tail' || " + _NL + " || 'endmodule' || " + _NL
)

CORPORA: dict[str, tuple[list[str], str]] = {
    # --- text corpus -----------------------------------------------------------
    "text_files": (
        ["documents"],
        "SELECT source AS dataset_name, source || '__' || lang AS design_name, "
        "CAST(doc_id AS STRING) || '.v' AS file_name, text FROM {documents}",
    ),
    "text_designs": (
        ["documents"],
        "SELECT DISTINCT source || '__' || lang AS design_name, source AS dataset_name FROM {documents}",
    ),
    # --- HDL corpus ------------------------------------------------------------
    "mods": (
        ["lineitem"],
        "SELECT *, dataset_name || '__d' || CAST(okey AS STRING) AS design_name, "
        # numbers of all modules of the design as bits (at most seven rows per order)
        "CAST(sum(CAST(pow(2, n) AS BIGINT)) OVER (PARTITION BY okey) AS BIGINT) AS mask FROM ("
        "SELECT l_orderkey AS okey, CAST(l_linenumber AS INT) AS n, min(l_returnflag) AS flag, "
        "CASE WHEN l_orderkey % 3 = 0 THEN 'opencores' WHEN l_orderkey % 7 = 0 THEN 'vtr' "
        "WHEN l_orderkey % 7 IN (1, 2) THEN 'koios' ELSE 'epfl' END AS dataset_name "
        "FROM @lines GROUP BY l_orderkey, l_linenumber) t",
    ),
    "hdl_designs": (
        ["mods"],
        "SELECT DISTINCT design_name, dataset_name FROM {mods}",
    ),
    "modules": (
        ["mods"],
        "SELECT design_name, 'm' || CAST(n AS STRING) AS module_name FROM {mods}",
    ),
    "pairs": (
        ["mods"],
        "SELECT design_name, okey, n, 2 * n AS b FROM {mods} WHERE " + _has("2 * n") + " UNION ALL "
        "SELECT design_name, okey, n, 2 * n + 1 AS b FROM {mods} WHERE " + _has("2 * n + 1") + " UNION ALL "
        "SELECT design_name, okey, n, n + 3 AS b FROM {mods} WHERE n NOT IN (2, 3) AND " + _has("n + 3"),
    ),
    "inst": (
        ["pairs"],
        "SELECT design_name, 'm' || CAST(n AS STRING) AS parent, 'm' || CAST(b AS STRING) AS child FROM {pairs}",
    ),
    "module_texts": (
        ["mods"],
        "SELECT dataset_name, @by_design, n, flag, " + _MODULE_TEXT + " AS module_text FROM {mods}",
    ),
    "hdl_files": (
        ["module_texts"],
        "SELECT dataset_name, design_name, file_name, 'verilog' AS role, '`timescale 1ns/1ps' || chr(10) || "
        + _per_line("module_text || chr(10)")
        + " AS text FROM (SELECT *, CASE WHEN n <= 3 THEN 'core.v' ELSE 'leaf.v' END AS file_name FROM {module_texts}) t "
        "GROUP BY dataset_name, @by_design, file_name",
    ),
    # --- tool outputs as text ---------------------------------------------------
    "netlist_json": (
        ["mods"],
        "SELECT design_name, '{{\"creator\":\"gen\",\"modules\":{{' || "
        + _per_line(
            "'\"m' || CAST(n AS STRING) || '\":{{\"attributes\":{{}},\"cells\":{{\"g\":{{\"type\":\"$add\"}}' || "
            "CASE WHEN " + _has("2 * n") + " THEN ',\"u_a\":{{\"type\":\"m' || CAST(2 * n AS STRING) || '\"}}' ELSE '' END || "
            "CASE WHEN " + _has("2 * n + 1") + " THEN ',\"u_b\":{{\"type\":\"m' || CAST(2 * n + 1 AS STRING) || '\"}}' ELSE '' END || "
            "CASE WHEN " + _has("n + 3") + " THEN ',\"u_c\":{{\"type\":\"' || "
            "CASE WHEN n IN (2, 3) THEN '$paramod' || chr(92) || chr(92) || 'm' || CAST(n + 3 AS STRING) || '-W8' "
            "ELSE 'm' || CAST(n + 3 AS STRING) END || '\"}}' ELSE '' END || '}}}}' || "
            "CASE WHEN n = 5 OR n = 6 THEN ',\"$paramod' || chr(92) || chr(92) || 'm' || CAST(n AS STRING) || "
            "'-W8\":{{\"attributes\":{{\"hdlname\":\"m' || CAST(n AS STRING) || '\"}},\"cells\":{{}}}}' ELSE '' END",
            "','",
        )
        + " || '}}}}' AS json FROM {mods} GROUP BY @by_design",
    ),
    "rtlil": (
        ["mods"],
        "SELECT design_name, "
        + _per_line(
            "'connect ' || chr(92) || 'u' || CAST(n AS STRING) || '.clk ' || chr(92) || "
            "CASE WHEN n = 1 THEN 'CLK' WHEN n % 2 = 0 THEN 'u' || CAST(n / 2 AS INT) || '.clk' "
            "WHEN n = 3 THEN 'clk_b' WHEN n = 5 THEN 'rst_n' ELSE 'data' END || chr(10) || "
            "CASE flag WHEN 'A' THEN 'process $proc$' || CAST(n AS STRING) || chr(10) || "
            "'  sync posedge ' || chr(92) || 'u' || CAST(n AS STRING) || '.clk' || chr(10) || "
            "'    update q' || chr(10) || 'end' || chr(10) "
            "WHEN 'N' THEN 'process $proc$' || CAST(n AS STRING) || chr(10) || "
            "'  sync negedge ' || chr(92) || 'u' || CAST(n AS STRING) || '.clk' || chr(10) || "
            "'  sync posedge ' || chr(92) || 'rst_n' || chr(10) || 'end' || chr(10) ELSE '' END"
        )
        + " AS rtlil, 'input [0:0] CLK' || chr(10) || 'input [0:0] clk_b' || chr(10) || '  input [0:0] rst_n ' || chr(10) || "
        "'input [7:0] data' || chr(10) || 'inout [0:0] pad' || chr(10) || "
        + _per_line("'output [' || CAST(n AS STRING) || ':0] q' || CAST(n AS STRING) || chr(10)")
        + " AS portlist FROM {mods} GROUP BY @by_design",
    ),
    "connectivity": (
        ["pairs"],
        "SELECT design_name, okey * 100 + n * 10 + b AS row_idx, "
        "'top' || chr(9) || 'u' || CAST(b AS STRING) || chr(9) || 'm' || CAST(b AS STRING) || chr(9) || "
        "'p' || CAST(n AS STRING) || chr(9) || CASE (n + b) % 6 WHEN 0 THEN 'in' WHEN 1 THEN 'out' WHEN 2 THEN 'inout' "
        "WHEN 3 THEN 'pi' WHEN 4 THEN 'po' ELSE CASE WHEN okey % 11 = 0 THEN 'weird' ELSE 'pio' END END || chr(9) || "
        "CASE WHEN n = 3 THEN 'u' || CAST(n AS STRING) ELSE 's' || CAST(n AS STRING) END AS line FROM {pairs}",
    ),
    "ast_json": (  # trees of depth 2 to 9: a chain as long as the module's number, with leaves beside it
        ["mods"],
        "SELECT t.design_name, 'm' || CAST(t.n AS STRING) || '.v' AS file_name, "
        "'{{\"f.v\":{{\"tree\":{{\"tag\":\"kModule\",\"children\":[{{\"tag\":\"id\",\"text\":\"m' || CAST(t.n AS STRING) || "
        "'\"}},null,{{\"tag\":\"kBody\",\"children\":[' || "
        "CASE t.flag WHEN 'A' THEN repeat('{{\"tag\":\"a\",\"children\":[', CAST(t.n AS INT)) || '{{\"tag\":\"z\"}}' || repeat(']}}', CAST(t.n AS INT)) "
        "WHEN 'N' THEN '{{\"tag\":\"a\",\"children\":[{{\"tag\":\"b\",\"start\":3}}]}},' || "
        "repeat('{{\"tag\":\"c\",\"children\":[{{\"tag\":\"d\"}},null,', CAST(t.n AS INT)) || '{{\"tag\":\"e\"}}' || repeat(']}}', CAST(t.n AS INT)) "
        "ELSE '' END || ']}},{{\"tag\":\"end\"}}]}}}},\"g.v\":{{\"tree\":{{\"tag\":\"other\"}}}}}}' AS json FROM {mods} t",
    ),
    "blif": (
        ["mods"],
        "SELECT design_name, "
        + _per_line(
            "'.model b' || CAST(CASE WHEN n = 4 THEN 1 WHEN n = 7 THEN 3 ELSE n END AS STRING) || chr(10) || "
            "'.inputs a' || CAST(n AS STRING) || ' b' || chr(10) || '.outputs q' || chr(10) || "
            "CASE flag WHEN 'A' THEN '.latch  a' || CAST(n AS STRING) || '   q 2' || chr(10) "
            "WHEN 'N' THEN '.latch a q re b 0' || chr(10) || '.names  c' || CAST(n AS STRING) || ' ' || chr(10) || ' 1 ' || chr(10) "
            "ELSE '.names d' || CAST(n AS STRING) || chr(10) || '0' || chr(10) || '.names e  f' || chr(10) || '-' || chr(10) END || "
            "CASE WHEN n = 2 THEN '.exdc' || chr(10) || '.names z' || chr(10) || '1' || chr(10) ELSE '' END || "
            "'.end' || chr(10)"
        )
        + " AS text FROM {mods} GROUP BY @by_design",
    ),
    "cell_array_files": (
        ["mods"],
        "SELECT design_name, 'arr.v' AS file_name, 'module top;' || chr(10) || "
        + _per_line(
            "CASE flag WHEN 'A' THEN 'fa #(.W(2)) u' || CAST(n AS STRING) || '[0:' || CAST(n AS STRING) || '](a[0:' || CAST(n AS STRING) || "
            "'],s[' || CAST(n AS STRING) || ':0]);' WHEN 'N' THEN 'ha x' || CAST(n AS STRING) || '[3:1] (p[5:7],q[2:0]);' "
            "ELSE CASE WHEN n = 7 THEN 'ha bad[0:3](a[0:2]);' ELSE '  wire w' || CAST(n AS STRING) || ';' END END || chr(10)"
        )
        + " || 'endmodule' || chr(10) AS text FROM {mods} GROUP BY @by_design",
    ),
    # --- paths and catalogue rows -------------------------------------------------
    "member_paths": (
        ["pages"],
        "SELECT page_id, regexp_extract(url, '^https?://([a-z]+)', 1) AS host, "
        "CASE page_id % 10 WHEN 0 THEN 'designs/' || CAST(page_id AS STRING) || '/rtl/top.v' "
        "WHEN 1 THEN 'designs/6809_6309_compatible_core/x.v' WHEN 2 THEN 'designs/d' || CAST(page_id % 40 AS STRING) || '/top.txt' "
        "WHEN 3 THEN 'trojan/RS232-T' || CAST(page_id % 200 AS STRING) || '/uart.v' WHEN 4 THEN 'vtr_flow/benchmarks/verilog/mcml.v' "
        "WHEN 5 THEN 'vtr_flow/benchmarks/verilog/b' || CAST(page_id AS STRING) || '.v' "
        "WHEN 6 THEN 'Verilog/c' || CAST(page_id AS STRING) || '.v' WHEN 7 THEN 'Verilog/s' || CAST(page_id AS STRING) || '.v' "
        "WHEN 8 THEN 'LGSynth91/Verilog/x/e' || CAST(page_id AS STRING) || '.1_orig.v' "
        "ELSE 'designs/d' || CAST(page_id AS STRING) || '/doc/notes.md' END AS path, "
        "CASE page_id % 10 WHEN 3 THEN 'hw_2_vec' WHEN 4 THEN 'vtr' WHEN 5 THEN 'vtr' WHEN 6 THEN 'iscas85' "
        "WHEN 7 THEN 'iscas89' WHEN 8 THEN 'lgsynth91' ELSE 'opencores' END AS dataset_name FROM {pages}",
    ),
    "search_pages": (
        ["part"],
        "SELECT CAST(floor(p_partkey / 100) AS INT) AS page, '{{\"total_count\":1,\"items\":[' || "
        "string_agg('{{\"id\":' || CAST(p_partkey AS STRING) || ',\"full_name\":\"' || p_type || '/' || p_name || "
        "'\",\"html_url\":\"https://x.org/' || CAST(p_partkey AS STRING) || '\",\"stars\":3}}', ',') || ']}}' AS json "
        "FROM {part} GROUP BY CAST(floor(p_partkey / 100) AS INT)",
    ),
}

# the same rows where Spark would derive the lines again for each branch of a union
SPARK: dict[str, str] = {
    "pairs": "SELECT design_name, okey, n, b FROM (SELECT design_name, okey, n, explode(filter("
    "array(2 * n, 2 * n + 1, CASE WHEN n NOT IN (2, 3) THEN n + 3 END), b -> " + _has("b") + ")) AS b FROM {mods}) t",
}


def corpus(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    deps, sql = CORPORA[name]
    return spark.sql(_render(SPARK.get(name, sql), "spark").replace("@parts", str(n_buckets(spark))), **{d: corpus(spark, sf_dir, d) for d in deps})


def corpus_ctes(*names: str) -> str:
    """``name AS (SELECT …)`` for the named corpora and what they read, in order."""
    seen: list[str] = []

    def visit(name: str) -> None:
        if name in TABLES or name in seen:
            return
        for d in CORPORA[name][0]:
            visit(d)
        seen.append(name)

    for n in names:
        visit(n)
    render = {n: n for n in TABLES + list(CORPORA)}
    return ", ".join(f"{n} AS ({_render(CORPORA[n][1].format(**render), 'duckdb')})" for n in seen)
