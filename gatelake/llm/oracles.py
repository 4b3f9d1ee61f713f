"""SQL (DuckDB) for the queries that SQL can express."""

from __future__ import annotations

from gatelake.llm import rules, urls

ORACLES: dict[str, str] = {}

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORD = r"[^\x20\x09-\x0D]+"

ORACLES["op3_decontaminate"] = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_ALNUM}') AS w FROM documents),
b AS (SELECT item_id, w, least(len(w), 13) AS k FROM (
  SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_ALNUM}') AS w FROM benchmark) t WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, k, array_to_string(w[i + 1:i + k], ' ') AS win FROM (SELECT *, unnest(range(0, len(w) - k + 1)) AS i FROM b) t),
dw AS (SELECT rid, k, i, array_to_string(w[i + 1:i + k], ' ') AS win FROM (
  SELECT rid, w, k, unnest(range(0, len(w) - k + 1)) AS i FROM d, (SELECT DISTINCT k FROM bw) ks WHERE len(w) >= k) t),
h AS (SELECT rid, i, dw.k, item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.k = bw.k),
hw AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + k)) AS p FROM h) t GROUP BY rid),
hi AS (SELECT rid, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS id FROM h) t GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hw USING (rid) LEFT JOIN hi USING (rid)
"""


def _rules() -> str:
    stop = ", ".join(f"'{w}'" for w in rules.STOP_WORDS)
    n = lambda chars: f"CAST(len(regexp_extract_all(t, '{chars}')) AS BIGINT)"
    sql = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS lines FROM documents),
g AS (SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM d) x),
r AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + 3)) AS p FROM
  (SELECT *, count(*) OVER (PARTITION BY rid, g) AS c FROM g) x WHERE c > 1) y GROUP BY rid),
f AS (SELECT rid, doc_id, CAST(len(w) AS BIGINT) AS n_words, length(array_to_string(w, '')) AS word_chars, {n("[#*$%&|<>]")} AS n_symbols,
  CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words, CAST(len(lines) AS BIGINT) AS n_lines,
  {n("[A-Z]")} AS n_upper, {n("[!-/:-@\\[-`{-~]")} AS n_punct,
  CAST(len(list_filter(w, lambda x: regexp_matches(x, '[#*$%&|<>]'))) AS BIGINT) AS n_marked,
  CAST(len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z]|[^\\x00-\\x7F]'))) AS BIGINT) AS n_lettered,
  {n("[.!?]")} AS n_ends, CAST(len(list_filter(w, lambda x: x IN ({stop}))) AS BIGINT) AS n_stop FROM d LEFT JOIN r USING (rid)),
v AS MATERIALIZED (SELECT *, {", ".join(f"{rules.vote(x)} AS v_{x}" for x in rules.RULES)} FROM f),
pat AS MATERIALIZED (SELECT {", ".join(f"v_{x}" for x in rules.RULES)}, CAST(count(*) AS DOUBLE) AS c FROM v WHERE NOT ({rules.BASE}) GROUP BY ALL),
p0 AS (SELECT {", ".join(f"CAST({rules.START} AS DOUBLE) AS {k}" for k in rules.updates())})"""
    good, bad = {x: f"g_{x}" for x in rules.RULES}, {x: f"b_{x}" for x in rules.RULES}
    q = rules.posterior("prior", good, bad)
    for i in range(rules.STEPS):
        new = ", ".join(f"{x} AS {k}" for k, x in rules.updates().items())
        sql += f",\np{i + 1} AS MATERIALIZED (SELECT {new} FROM (SELECT *, {q} AS q FROM pat, p{i}) x)"
    return sql + f"""
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND q >= {rules.KEEP} AS kept, round(q, 4) AS posterior
FROM (SELECT *, {rules.BASE} AS base_failed, {q} AS q FROM v, p{rules.STEPS}) x
"""


ORACLES["op1_quality_rules"] = _rules()

_CRC = (
    "xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), "
    "lambda x: list_prepend(CAST(ord(x) AS BIGINT), list_transform(range(8), lambda y: CAST(-1 AS BIGINT)))))), "
    "lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END), 4294967295)"
)


def _discounts(name: str, table: str, count: str) -> str:
    """Discounts of one order as a one-row table, clamped and with halves where counts of counts are missing."""
    n = {i: f"count(*) FILTER ({count} = {i})" for i in range(1, 5)}
    clamp = lambda x, most: f"CASE WHEN n1 > 0 AND n2 > 0 THEN least(greatest({x}, 0), {most}) ELSE 0.5 END"
    y = "(CAST(n1 AS DOUBLE) / (n1 + 2 * n2))"
    third = f"CASE WHEN n3 > 0 THEN 3 - 4 * {y} * n4 / n3 ELSE 0.5 END"
    return (
        f"{name} AS MATERIALIZED (SELECT {clamp(f'1 - 2 * {y} * n2 / n1', 1)} AS d1, {clamp(f'2 - 3 * {y} * n3 / n2', 2)} AS d2, {clamp(third, 3)} AS d3, "
        f"n1, n2, n - n1 - n2 AS more, total FROM (SELECT {', '.join(f'{x} AS n{i}' for i, x in n.items())}, count(*) AS n, sum({count}) AS total FROM {table}) x)"
    )


_CUT = "CASE WHEN {0} = 0 THEN 0 WHEN {0} = 1 THEN {1}.d1 WHEN {0} = 2 THEN {1}.d2 ELSE {1}.d3 END"

ORACLES["op2_ngram_model"] = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce({_CRC} % 10 = 0, true) AS held_out,
  list_append(regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_WORD}'), chr(10)) AS w FROM documents),
t AS MATERIALIZED (SELECT rid, held_out, CASE WHEN i = 1 THEN chr(9) ELSE w[i - 1] END AS u, w[i] AS w FROM (SELECT *, unnest(range(1, len(w) + 1)) AS i FROM d) x),
tr AS (SELECT u, w FROM t WHERE NOT held_out),
uni AS MATERIALIZED (SELECT w, count(*) AS c FROM tr GROUP BY w),
tot AS MATERIALIZED (SELECT coalesce(CAST(sum(c) AS BIGINT), 0) AS n, count(*) AS v FROM uni),
bi AS MATERIALIZED (SELECT u, w, count(*) AS c FROM tr GROUP BY u, w),
con AS MATERIALIZED (SELECT w, count(*) AS k FROM bi GROUP BY w),
ctx AS MATERIALIZED (SELECT u, sum(c) AS s, count(*) FILTER (c = 1) AS n1, count(*) FILTER (c = 2) AS n2, count(*) FILTER (c >= 3) AS n3 FROM bi GROUP BY u),
{_discounts("a", "bi", "c")}, {_discounts("b", "con", "k")},
p AS (SELECT rid, coalesce(uni.c, 0) AS c, log10((coalesce(uni.c, 0) + 0.1) / (tot.n + 0.1 * (tot.v + 1))) AS base, coalesce(bi.c, 0) AS c2, ctx.s, ctx.n1, ctx.n2, ctx.n3,
  greatest(coalesce(k, 0) - {_CUT.format("coalesce(k, 0)", "b")}, 0) / b.total + (b.d1 * b.n1 + b.d2 * b.n2 + b.d3 * b.more) / b.total / (tot.v + 1) AS p1
  FROM t LEFT JOIN uni USING (w) LEFT JOIN con USING (w) LEFT JOIN bi USING (u, w) LEFT JOIN ctx USING (u), tot, b),
s AS (SELECT rid, count(*) AS n_tokens, count(*) FILTER (c > 0) AS n_known, sum(base) AS base_score, sum(log10(CASE WHEN s IS NULL THEN p1 ELSE
  greatest(c2 - {_CUT.format("c2", "a")}, 0) / s + (a.d1 * p.n1 + a.d2 * p.n2 + a.d3 * p.n3) / s * p1 END)) AS score FROM p, a GROUP BY rid)
SELECT doc_id, held_out, n_tokens, n_known, n AS train_tokens, round(base_score, 6) AS base_score, round(score, 6) AS score FROM d JOIN s USING (rid), tot
"""


def _urls() -> str:
    second = "|".join(urls.SECOND)
    cases = " ".join(
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN {{'rule': '{h}{p}', 'action': '{a}'}}"
        for a, h, p in sorted(urls.RULES, key=lambda r: -len(r[1] + r[2]))
    )
    low, high = urls.STRENGTH
    sql = f"""
WITH p AS (SELECT page_id, {_LOWER.format("regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1)")} AS host,
  regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
q AS MATERIALIZED (SELECT *, CASE {cases} END AS r, coalesce(nullif(regexp_extract(host, '\\.((?:{second})\\.[a-z]{{2}})$', 1), ''), regexp_extract(host, '([^.]*)$', 1)) AS suffix,
  coalesce(nullif(regexp_extract(host, '([^.]+\\.(?:{second})\\.[a-z]{{2}})$', 1), ''), nullif(regexp_extract(host, '([^.]+\\.[^.]+)$', 1), ''), host) AS domain FROM p),
lab AS (SELECT doc_id AS page_id, max(CASE WHEN quality = 0 OR coalesce(toxic, 0) = 1 THEN 1 ELSE 0 END) AS bad FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY 1),
o AS MATERIALIZED (SELECT host, any_value(suffix) AS suffix, any_value(domain) AS domain, CAST(count(*) AS DOUBLE) AS n, CAST(sum(bad) AS DOUBLE) AS x FROM q JOIN lab USING (page_id) GROUP BY host),
t0 AS MATERIALIZED (SELECT '' AS key, coalesce(sum(x), 0) + 1 AS a, coalesce(sum(n), 0) - coalesce(sum(x), 0) + 1 AS b FROM o)"""
    up = "''"
    for i, level in enumerate(urls.LEVELS, 1):
        sql += f""",
j{i} AS MATERIALIZED (SELECT h.key, n, x, a / (a + b) AS m FROM (SELECT {level} AS key, any_value({up}) AS up, sum(n) AS n, sum(x) AS x FROM o GROUP BY 1) h JOIN t{i - 1} u ON u.key = h.up),
k{i} AS (SELECT coalesce(CASE WHEN s > c THEN greatest({low}, least({high}, t / (s - c))) ELSE {high} END, {high}) AS k FROM
  (SELECT sum(n * (x / n - m) * (x / n - m)) AS s, sum(m * (1 - m)) AS c, sum(n * m * (1 - m)) AS t FROM j{i}) z),
t{i} AS MATERIALIZED (SELECT key, k * m + x AS a, k * (1 - m) + n - x AS b FROM j{i}, k{i})"""
        up = level
    return sql + f"""
, f AS (SELECT page_id, q.host, path, r, coalesce(t3.a, t2.a, t1.a, t0.a) AS a, coalesce(t3.b, t2.b, t1.b, t0.b) AS b
  FROM q LEFT JOIN t3 ON t3.key = q.host LEFT JOIN t2 ON t2.key = q.domain LEFT JOIN t1 ON t1.key = q.suffix, t0),
g AS (SELECT *, round(a / (a + b), 6) AS bad_rate, round(greatest(0, a / (a + b) - {urls.Z} * sqrt(a / (a + b) * (1 - a / (a + b)) / (a + b + 1))), 6) AS bound FROM f)
SELECT page_id, host, path, r.rule AS rule, coalesce(r.action, CASE WHEN bound > {urls.MOST} THEN 'block' ELSE 'allow' END) AS verdict, bad_rate, bound FROM g
"""


ORACLES["op9_url_filter"] = _urls()

ORACLES["op11_fill_in_middle"] = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
  sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
g AS (SELECT *, CAST(len(u) AS BIGINT) AS n, list_transform(range(4), lambda i: CAST('0x' || substr(h, 8 * i + 1, 8) AS BIGINT)) AS r FROM d),
k AS (SELECT *, least(r[1] % (n + 1), r[2] % (n + 1)) AS a, greatest(r[1] % (n + 1), r[2] % (n + 1)) AS b,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR r[3] % 100 >= 100 THEN 'plain' WHEN r[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM g),
p AS (SELECT *, array_to_string(u[1:a], '') AS pre, array_to_string(u[a + 1:b], '') AS mid, array_to_string(u[b + 1:n], '') AS suf FROM k)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(t) AS restored_sha256 FROM p
"""


def _repair() -> str:
    crc = _CRC.replace("CAST(doc_id AS VARCHAR)", "coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")
    name = {"u": "user", "a": "assistant"}
    # grammar states 1 to 4: nothing yet, behind system, user, assistant
    fill, goes = {1: "u", 2: "u", 3: "a", 4: "u"}, {"s": 2, "u": 3, "a": 4}
    edit = lambda cost, initial, line, q: f"{{'c': {cost} + f[{q}].c, 'a': '{initial}' || f[{q}].a, 't': {line} || f[{q}].t}}"

    def best(q: int) -> str:
        keep = [f"WHEN lower(l) = '{r}' THEN {edit('w', 'K', 'line', goes[r])}" for r in ("s" if q == 1 else "", fill[q]) if r]
        none = "{'c': 1000000, 'a': '', 't': ''}"
        rename = edit("1 + w", "R", f"(chr(10) || '{name[fill[q]]}:' || text)", goes[fill[q]])
        return f"list_sort([{edit(2, 'D', chr(39) * 2, q)}, CASE {' '.join(keep)} ELSE {none} END, CASE WHEN l = 'X' THEN {none} ELSE {rename} END])[1]"

    def insert(q: int) -> str:
        return f"list_sort([f[{q}], {edit(5, 'I', f'(chr(10) || {chr(39)}{name[fill[q]]}:{chr(39)})', goes[fill[q]])}])[1]"

    four = lambda one: "[" + ", ".join(one(q) for q in range(1, 5)) + "]"
    end = "[{'c': 0, 'a': '', 't': ''}, {'c': 10, 'a': 'II', 't': chr(10) || 'user:' || chr(10) || 'assistant:'}, {'c': 5, 'a': 'I', 't': chr(10) || 'assistant:'}, {'c': 0, 'a': '', 't': ''}]"
    return f"""
WITH RECURSIVE k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, ({crc}) % 20 AS k FROM conversations),
rows_ AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role, CASE k WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM (SELECT * FROM k WHERE k <> 0 UNION ALL SELECT * FROM k WHERE k = 3) x),
pos AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(CAST(length(role) AS VARCHAR) || ':' || role || text)) AS i FROM rows_),
fault AS (SELECT *, left(role, 1) AS r, NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') AS b, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS dup,
  NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') AS cut, lead(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS nxt FROM pos),
letter AS MATERIALIZED (SELECT *, chr(10) || role || ':' || text AS line, CASE WHEN NOT b AND NOT dup AND cut THEN 5 ELSE 0 END AS w,
  CASE WHEN b OR dup THEN 'X' WHEN r IN ('s', 'u', 'a') THEN r ELSE 'o' END AS l FROM fault),
sums AS MATERIALIZED (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, CAST(count(*) FILTER (b) AS BIGINT) AS blank,
  CAST(count(*) FILTER (NOT b AND dup) AS BIGINT) AS duplicate, CAST(count(*) FILTER (w > 0) AS BIGINT) AS truncated,
  CAST(count(*) FILTER (nxt IS NOT NULL AND r || nxt NOT IN ('su', 'ua', 'au')) AS BIGINT) AS illegal FROM letter GROUP BY conv_id),
walk AS (SELECT conv_id, n AS i, {end} AS f FROM sums
  UNION ALL SELECT conv_id, i, {four(insert)} FROM (SELECT conv_id, i, {four(insert)} AS f FROM (
    SELECT walk.conv_id, walk.i - 1 AS i, {four(best)} AS f FROM walk JOIN letter ON letter.conv_id IS NOT DISTINCT FROM walk.conv_id AND letter.i = walk.i) x) y)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  CAST(coalesce(f[1].c, 0) AS BIGINT) AS cost, coalesce(f[1].a, '') AS audit, sha256(coalesce(substr(f[1].t, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN (SELECT walk.conv_id, f, sums.* EXCLUDE (conv_id) FROM walk JOIN sums ON walk.conv_id IS NOT DISTINCT FROM sums.conv_id WHERE i = 0) z ON o.conv_id IS NOT DISTINCT FROM z.conv_id
"""


ORACLES["op12_conversation_repair"] = _repair()
