"""Queries over decomposition, text repair, tokens and vectors."""

from pyspark.sql import functions as F

from gatelake.operators import decompose, graph, modules, repair, tokens, vectors
from gatelake.plans import oracle_sql as O
from gatelake.plans.registry import query
from gatelake.session import materialize

_CLOSED = """walk AS (SELECT design_name, module_name AS root, module_name AS node FROM modules UNION
  SELECT w.design_name, w.root, i.child FROM walk w JOIN inst i ON i.design_name = w.design_name AND i.parent = w.node)"""


_SUBTEXT = rf"""bodies AS (SELECT design_name, file_name, regexp_extract(b, '^module\s+([A-Za-z_][\w$]*)', 1) AS m, b FROM
    (SELECT design_name, file_name, unnest(regexp_extract_all(text, '{O.MODULE_OR_COMMENT}')) AS b FROM hdl_files) x WHERE b LIKE 'module%'),
  gone AS (SELECT r.design_name, r.module_name AS root, b.file_name, list(b.b) AS bs FROM modules r
    JOIN bodies b ON b.design_name = r.design_name
    WHERE NOT EXISTS (SELECT 1 FROM walk w WHERE w.design_name = r.design_name AND w.root = r.module_name AND w.node = b.m) GROUP BY ALL),
  cut AS (SELECT r.design_name, r.module_name AS root, f.file_name, CASE WHEN g.bs IS NULL THEN f.text ELSE
    list_reduce(list_prepend(f.text, g.bs), lambda acc, b: replace(acc, b, chr(10))) END AS t
    FROM modules r JOIN hdl_files f ON f.design_name = r.design_name
    LEFT JOIN gone g ON g.design_name = r.design_name AND g.root = r.module_name AND g.file_name = f.file_name)"""


@query(
    "subdesign_text",
    f"""WITH RECURSIVE {_CLOSED}, {_SUBTEXT} SELECT design_name, root, file_name, trim(t, chr(10)) || chr(10) AS text FROM cut
        WHERE regexp_matches(t, '{O.NON_WS}')""",
    ("hdl_files", "modules", "inst"))
def subdesign_text(src):
    nodes, edges = src("modules"), src("inst")
    return decompose.subdesign_text(src("hdl_files"), graph.closure(nodes, edges))


@query(
    "decompose_text",
    f"""WITH RECURSIVE {_CLOSED}, {_SUBTEXT} SELECT design_name, root, file_name, md5(trim(t, chr(10)) || chr(10)) AS text_md5 FROM cut
        WHERE regexp_matches(t, '{O.NON_WS}')""",
    ("hdl_files", "modules", "inst"))
def decompose_text(src):
    return decompose.decompose_text(src("hdl_files")).select(
        "design_name", "root", "file_name", F.md5("text").alias("text_md5"))


# ------------------------------------------------------------------ text repair
_LINES = "string_split(regexp_replace({t}, '\\n$', ''), chr(10))"


@query(
    "blif_fix_constants",
    r"""SELECT design_name, array_to_string(list_concat(list_concat(rest[1:e - 1], list_reverse(moved)), rest[e:]), chr(10)) AS text FROM (
        SELECT design_name, list_transform(range(1, len(ns) + 1), lambda i: CASE WHEN vs[i] = '-' THEN ' ' ELSE replace(ns[i], '  ', ' ') || vs[i] END) AS moved,
        rest, list_position(rest, '.end') AS e FROM (
          SELECT design_name, regexp_extract_all(text, '(?m)(.names +.*? *\n) *([01-]) *$', 1) AS ns,
          regexp_extract_all(text, '(?m)(.names +.*? *\n) *([01-]) *$', 2) AS vs,
          string_split(regexp_replace(regexp_replace(text, '(?m)(.names +.*? *\n) *([01-]) *$', '', 'g'), '\n\z', ''), chr(10)) AS rest FROM blif) a) b""",
    ("blif",))
def blif_fix_constants(src):
    return src("blif").select("design_name", repair.fix_constants(F.col("text")).alias("text"))


@query(
    "blif_drop_duplicate_models",
    r"""WITH b AS (SELECT design_name, text, unnest(regexp_extract_all(text, '\.model +(.+)[\s\S]*?\.end')) AS block,
          unnest(regexp_extract_all(text, '\.model +(.+)[\s\S]*?\.end', 1)) AS name,
          unnest(range(len(regexp_extract_all(text, '\.model +(.+)[\s\S]*?\.end')))) AS i,
          unnest(string_split_regex(text, '\.model +(.+)[\s\S]*?\.end')[:-2]) AS gap FROM blif),
        t AS (SELECT design_name, string_split_regex(text, '\.model +(.+)[\s\S]*?\.end')[-1] AS tail FROM blif),
        f AS (SELECT *, first_value(block) OVER (PARTITION BY design_name, name ORDER BY i) AS first_block,
          max(i) OVER (PARTITION BY design_name, block) AS last_i FROM b)
        SELECT f.design_name, string_agg(gap || CASE WHEN block = first_block AND i = last_i THEN block ELSE chr(10) || chr(10) END, '' ORDER BY i)
          || any_value(t.tail) AS text FROM f JOIN t ON t.design_name = f.design_name GROUP BY f.design_name""",
    ("blif",))
def blif_drop_duplicate_models(src):
    return src("blif").select("design_name", repair.drop_duplicate_models(F.col("text")).alias("text"))


@query(
    "blif_remove_exdc",
    r"SELECT design_name, regexp_replace(text, '\.exdc[\s\S]*?\.end', '.end', 'g') AS text FROM blif", ("blif",))
def blif_remove_exdc(src):
    return src("blif").select("design_name", repair.remove_exdc(F.col("text")).alias("text"))


@query("blif_append_end", "SELECT design_name, text || chr(10) || '.end' AS text FROM blif", ("blif",))
def blif_append_end(src):
    return src("blif").select("design_name", repair.append_end(F.col("text")).alias("text"))


@query(
    "blif_add_global_clock",
    r"""WITH lines AS (SELECT design_name, unnest(string_split(regexp_replace(text, '\n\z', ''), chr(10))) AS l,
          unnest(range(len(string_split(regexp_replace(text, '\n\z', ''), chr(10))))) AS i FROM blif),
        owned AS (SELECT *, count(*) FILTER (WHERE l LIKE '.model%') OVER (PARTITION BY design_name ORDER BY i) AS m FROM lines),
        need AS (SELECT design_name, m FROM owned WHERE regexp_matches(l, '\.latch\s+(\S+)\s+(\S+)\s+([0123])') GROUP BY ALL),
        spot AS (SELECT o.design_name, min(o.i) AS i FROM owned o JOIN need n ON n.design_name = o.design_name AND n.m = o.m
          WHERE ltrim(l) LIKE '.%' AND ltrim(l) NOT LIKE '.inputs%' AND l NOT LIKE '.model%' GROUP BY o.design_name, o.m)
        SELECT o.design_name, CASE WHEN count(n.m) > 0 THEN string_agg(CASE WHEN s.i IS NOT NULL THEN '.inputs clk' || chr(10) ELSE '' END ||
          regexp_replace(l, '\.latch\s+(\S+)\s+(\S+)\s+([0123])', '.latch \1 \2 re clk \3', 'g'), chr(10) ORDER BY o.i)
          ELSE any_value(b.text) END AS text FROM owned o
        JOIN blif b ON b.design_name = o.design_name LEFT JOIN (SELECT DISTINCT design_name, 1 AS m FROM need) n ON n.design_name = o.design_name
        LEFT JOIN spot s ON s.design_name = o.design_name AND s.i = o.i GROUP BY o.design_name""",
    ("blif",))
def blif_add_global_clock(src):
    return src("blif").select("design_name", repair.add_global_clock(F.col("text")).alias("text"))


_CA = r"'^(\w+) +((?:#\(.*?\) +)*)(\w+)\[(\d+):(\d+)\] *(.*)$'"
_CELLS = rf"""lines AS (SELECT design_name, unnest(string_split(regexp_replace(text, '\n\z', ''), chr(10))) AS l,
    unnest(range(len(string_split(regexp_replace(text, '\n\z', ''), chr(10))))) AS i FROM cell_array_files),
  arr AS (SELECT design_name, i, l, regexp_extract(l, {_CA}, 1) AS cell, regexp_extract(l, {_CA}, 2) AS par, regexp_extract(l, {_CA}, 3) AS inst,
    CAST(regexp_extract(l, {_CA}, 4) AS INT) AS a, CAST(regexp_extract(l, {_CA}, 5) AS INT) AS b,
    unnest(regexp_extract_all(regexp_extract(l, {_CA}, 6), '(\w+)\[(\d+):(\d+)\]', 1)) AS p,
    CAST(unnest(regexp_extract_all(regexp_extract(l, {_CA}, 6), '(\w+)\[(\d+):(\d+)\]', 2)) AS INT) AS c,
    CAST(unnest(regexp_extract_all(regexp_extract(l, {_CA}, 6), '(\w+)\[(\d+):(\d+)\]', 3)) AS INT) AS d,
    unnest(range(len(regexp_extract_all(regexp_extract(l, {_CA}, 6), '(\w+)\[(\d+):(\d+)\]')))) AS q
    FROM lines WHERE regexp_matches(l, {_CA})),
  bad AS (SELECT DISTINCT design_name, i, l FROM arr WHERE abs(a - b) <> abs(c - d)),
  bits AS (SELECT design_name, i, k, any_value(cell) || ' ' || any_value(par) || any_value(inst) || '__' ||
    any_value(CASE WHEN a <= b THEN a + k ELSE a - k END) || ' (' ||
    string_agg(p || '[' || (CASE WHEN c <= d THEN c + k ELSE c - k END) || ']', ', ' ORDER BY q) || ');' AS t
    FROM (SELECT *, unnest(range(abs(a - b) + 1)) AS k FROM arr) x GROUP BY design_name, i, k),
  unrolled AS (SELECT design_name, i, string_agg(t, chr(10) ORDER BY k) AS t FROM bits GROUP BY ALL)"""


@query(
    "unroll_cell_arrays",
    rf"""WITH {_CELLS} SELECT l.design_name, CASE WHEN EXISTS (SELECT 1 FROM bad WHERE bad.design_name = l.design_name) THEN NULL ELSE
        string_agg(coalesce(u.t, l.l), chr(10) ORDER BY l.i) END AS text FROM lines l
        LEFT JOIN unrolled u ON u.design_name = l.design_name AND u.i = l.i GROUP BY l.design_name""",
    ("cell_array_files",))
def unroll_cell_arrays(src):
    return src("cell_array_files").select("design_name", repair.unroll_cell_arrays(F.col("text")).alias("text"))


@query(
    "cell_array_errors",
    f"WITH {_CELLS} SELECT design_name, 'arr.v' AS file_name, CAST(i AS INT) AS line_no, l AS line FROM bad", ("cell_array_files",))
def cell_array_errors(src):
    return repair.cell_array_errors(src("cell_array_files"))


# ------------------------------------------------------------------ tokens and characters
_TOK = r"""tok AS (SELECT dataset_name, design_name, file_name, 'chars4' AS tokenizer, CAST(ceil(length(text) / 4.0) AS BIGINT) AS num_tokens FROM hdl_files
  UNION ALL SELECT dataset_name, design_name, file_name, 'word_punct', len(regexp_extract_all(text, '\w+|[^\w\s]')) FROM hdl_files
  UNION ALL SELECT dataset_name, design_name, file_name, 'hdl', len(regexp_extract_all(text,
    '[A-Za-z_][A-Za-z0-9_$]*|[0-9]+(?:''[sS]?[bodhBODH][0-9a-fA-FxXzZ_?]+)?|[^A-Za-z0-9_$\s]')) FROM hdl_files)"""


@query("token_count", f"WITH {_TOK} SELECT * FROM tok", ("hdl_files",))
def token_count(src):
    return tokens.token_counts(src("hdl_files"))


@query(
    "tokens_by_dataset",
    f"WITH {_TOK} SELECT dataset_name, CAST(sum(num_tokens) AS BIGINT) AS num_tokens FROM tok WHERE tokenizer = 'hdl' GROUP BY dataset_name", ("hdl_files",))
def tokens_by_dataset(src):
    return tokens.tokens_by(tokens.token_counts(src("hdl_files"), ["hdl"]), "dataset_name", tokenizer="hdl")


@query(
    "tokens_by_design",
    f"WITH {_TOK} SELECT design_name, CAST(sum(num_tokens) AS BIGINT) AS num_tokens FROM tok WHERE tokenizer = 'word_punct' GROUP BY design_name", ("hdl_files",))
def tokens_by_design(src):
    return tokens.tokens_by(tokens.token_counts(src("hdl_files"), ["word_punct"]), "design_name", tokenizer="word_punct")


@query(
    "tokens_total",
    f"WITH {_TOK} SELECT tokenizer, CAST(sum(num_tokens) AS BIGINT) AS num_tokens FROM tok GROUP BY tokenizer", ("hdl_files",))
def tokens_total(src):
    return tokens.tokens_by(tokens.token_counts(src("hdl_files")), "tokenizer")


@query(
    "token_count_encoder",
    "SELECT dataset_name, design_name, file_name, 'split' AS tokenizer, len(string_split(text, ' ')) AS num_tokens FROM text_files", ("text_files",))
def token_count_encoder(src):
    """The plug-in path: any ``encode`` function, here splitting at blanks."""
    return tokens.token_counts(src("text_files"), rules=[], encoders={"split": lambda: (lambda s: s.split(" "))})


@query(
    "char_counts",
    """SELECT dataset_name, design_name, file_name, ch, count(*) AS n FROM (SELECT dataset_name, design_name, file_name,
       unnest(string_split(text, '')) AS ch FROM text_files) t WHERE ascii(ch) BETWEEN 32 AND 126 OR ascii(ch) BETWEEN 9 AND 13 GROUP BY ALL""",
    ("text_files",))
def char_counts(src):
    return tokens.printable_counts(src("text_files"))


# ------------------------------------------------------------------ vectors
_WEIGHTS = """voc AS (SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS INT) AS term_idx, df FROM
    (SELECT term, sum(tf) AS n, count(*) AS df FROM terms GROUP BY term ORDER BY n DESC, term LIMIT 1024) t),
  w AS (SELECT doc_id, term, term_idx, tf * (ln((1.0 + nd.n) / (1.0 + df)) + 1) AS w FROM terms JOIN voc USING (term), (SELECT count(*) AS n FROM documents) nd)
  SELECT doc_id, term, term_idx, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 7) AS weight FROM w"""


@query(
    "tfidf_char",
    f"""WITH terms AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id,
        unnest(string_split(regexp_replace(text, '{O.WS}{O.WS}+', ' ', 'g'), '')) AS term FROM documents) t GROUP BY ALL), {_WEIGHTS}""")
def tfidf_char(src):
    return vectors.tfidf_char(src("documents"), "doc_id").withColumn("weight", F.round("weight", 7))


@query(
    "tfidf_word_ngrams",
    rf"""WITH ws AS (SELECT doc_id, regexp_extract_all(lower(text), '[\pL\pN\pM_][\pL\pN\pM_]+') AS ws FROM documents),
        terms AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(ws) AS term FROM ws UNION ALL
          SELECT doc_id, array_to_string(ws[i:i + 1], ' ') FROM (SELECT doc_id, ws, unnest(range(1, len(ws))) AS i FROM ws) a UNION ALL
          SELECT doc_id, array_to_string(ws[i:i + 2], ' ') FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM ws) b) t GROUP BY ALL), {_WEIGHTS}""")
def tfidf_word_ngrams(src):
    return vectors.tfidf_word_ngrams(src("documents"), "doc_id").withColumn("weight", F.round("weight", 7))


def _projected(centred: bool) -> str:
    """Two leading eigenvectors by 3,000 steps of power iteration, the second after taking the first out."""
    unit = "list_transform([{0}], lambda u: list_transform(u, lambda e: e / sqrt(list_inner_product(u, u))))[1]"
    step = unit.format("list_transform({0}, lambda r: list_inner_product(r, v))")
    top = "list_reduce(list_resize([{1}], 3001, {1}), lambda v, z: " + step + ")"
    start = "list_transform(range(len({0})), lambda i: 1.0::DOUBLE + (i % 7) / 10.0)"
    less = "- (SELECT n FROM docs) * a.m * b.m" if centred else ""
    sign = lambda v: f"CASE WHEN list_extract({v}, list_position(list_transform({v}, lambda e: abs(e)), list_max(list_transform({v}, lambda e: abs(e))))) < 0 THEN -1 ELSE 1 END"
    return f"""WITH terms AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id,
        unnest(string_split(regexp_replace(text, '{O.WS}{O.WS}+', ' ', 'g'), '')) AS term FROM documents) t GROUP BY ALL),
      raw AS MATERIALIZED (WITH {_WEIGHTS.replace('round(w /', '(w /').replace(', 7) AS', ') AS')}), docs AS MATERIALIZED (SELECT count(DISTINCT doc_id) AS n FROM documents),
      voc AS MATERIALIZED (SELECT term, row_number() OVER (ORDER BY term) AS i, sum(weight) / (SELECT n FROM docs) AS m FROM raw GROUP BY term),
      w AS MATERIALIZED (SELECT doc_id, i, weight FROM raw JOIN voc USING (term)),
      gram AS (SELECT x.i, y.i AS j, sum(x.weight * y.weight) AS g FROM w x JOIN w y ON x.doc_id = y.doc_id GROUP BY ALL),
      mat AS MATERIALIZED (SELECT list(r ORDER BY i) AS m FROM (SELECT a.i, list(coalesce(g, 0) {less} ORDER BY b.i) AS r FROM voc a CROSS JOIN voc b
        LEFT JOIN gram ON gram.i = a.i AND gram.j = b.i GROUP BY a.i) t),
      one AS MATERIALIZED (SELECT m, {top.format("m", start.format("m"))} AS v1 FROM mat),
      rest AS MATERIALIZED (SELECT v1, list_transform(m, lambda r, i: list_transform(r, lambda e, j: e - lam * v1[i] * v1[j])) AS m FROM (
        SELECT *, list_inner_product(v1, list_transform(m, lambda r: list_inner_product(r, v1))) AS lam FROM one) t),
      two AS MATERIALIZED (SELECT v1, {top.format("m", start.format("m"))} AS v2 FROM rest),
      load AS MATERIALIZED (SELECT i, m, v1[i] * {sign("v1")} AS l1, v2[i] * {sign("v2")} AS l2 FROM voc, two),
      sums AS (SELECT doc_id, sum(weight * l1) AS x, sum(weight * l2) AS y FROM w JOIN load USING (i) GROUP BY doc_id),
      mid AS (SELECT {"sum(m * l1)" if centred else "max(0)"} AS x, {"sum(m * l2)" if centred else "max(0)"} AS y FROM load)
      SELECT doc_id, round(coalesce(s.x, 0) - mid.x, 5) + 0.0 AS x, round(coalesce(s.y, 0) - mid.y, 5) + 0.0 AS y
      FROM (SELECT DISTINCT doc_id FROM documents) d LEFT JOIN sums s USING (doc_id), mid"""


def _rounded(df):
    return df.withColumns({c: F.round(c, 5) + F.lit(0.0) for c in ("x", "y")})


@query("pca_2d", _projected(True))
def pca_2d(src):
    weights = materialize(vectors.tfidf_char(src("documents"), "doc_id"), "weights")
    return _rounded(vectors.pca_2d(weights, src("documents").select("doc_id"), "doc_id"))


@query("svd_2d", _projected(False))
def svd_2d(src):
    weights = materialize(vectors.tfidf_char(src("documents"), "doc_id"), "weights")
    return _rounded(vectors.svd_2d(weights, src("documents").select("doc_id"), "doc_id"))
