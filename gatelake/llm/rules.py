"""Weak supervision of document quality: rules vote or abstain, EM weighs them.

Every rule turns counts of a text into good (+1), bad (-1) or no vote (0). Texts
with the same votes are interchangeable, so expectation-maximisation runs on the
table of vote patterns and their counts: at most 3 to the power of the number of
rules, however many documents there are. Its parameters are the share of good
documents and, per rule, how often a vote is right on good and on bad documents.
Only documents that pass the base rules teach it: else short and repeated texts,
which the base drops anyway, would be all it learns of bad ones.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatelake.llm.common import bind, words
from gatelake.session import materialize

# at most so many rounds; they end earlier once no parameter moves by more than TOLERANCE
STEPS, TOLERANCE = 200, 1e-9
KEEP = 0.5
# share of good documents at the start, and how often a vote is right on good and on bad
# documents: junk trips a few rules and passes the others, prose trips hardly any
START, RIGHT_GOOD, RIGHT_BAD = 0.8, 0.95, 0.6
# pseudo-votes at these values as a share of the documents of a class, so that the size of
# the table does not matter
WEIGHT = 0.1
# least accuracy on good and on bad documents: without the first, one class that trips
# three rules half of the time explains a table as well as prose and junk do
LEAST_GOOD, LEAST_BAD = 0.9, 0.5

# fixed values: frequent function words of the languages covered
STOP_WORDS = (
    "the of and to in is was for on with that this as be by it are at an or "
    "de la que le les des et un une en el los las y del se der die das und den von zu mit ist ein eine"
).split()

# name -> (condition of a good vote, condition of a bad vote), over the counts below
RULES = {
    "word_length": ("word_chars >= 3 * n_words AND word_chars <= 10 * n_words", "word_chars < 2 * n_words OR word_chars > 14 * n_words"),
    "symbols": ("100 * n_symbols <= 2 * n_words", "100 * n_symbols > 10 * n_words"),
    "marked_words": ("100 * n_marked <= 5 * n_words", "100 * n_marked > 20 * n_words"),
    "letter_words": ("100 * n_lettered >= 90 * n_words", "100 * n_lettered < 80 * n_words"),
    "punctuation": ("100 * n_punct <= 6 * word_chars", "100 * n_punct > 12 * word_chars"),
    "lines": ("n_dup_lines = 0", "100 * n_dup_lines > 30 * n_lines"),
    "repeats": ("100 * n_repeat_words <= 10 * n_words", "100 * n_repeat_words > 30 * n_words"),
    "case": ("100 * n_upper <= 15 * word_chars", "100 * n_upper > 40 * word_chars"),
    "stop_words": ("100 * n_stop >= 5 * n_words", "100 * n_stop < n_words"),
    "sentences": ("50 * n_ends >= n_words AND 2 * n_ends <= n_words", "200 * n_ends < n_words OR 10 * n_ends > 9 * n_words"),
}
BASE = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"


def counts(docs: DataFrame) -> DataFrame:
    """``docs`` with the counts the rules read; a null text counts as an empty one."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = docs.withColumns({"_w": words(text), "_lines": lines})
    gone = lambda chars: (F.char_length(text) - F.char_length(F.regexp_replace(text, chars, ""))).cast("bigint")
    stop = F.filter("_w", lambda w: w.isin(STOP_WORDS))
    return out.withColumns({
        "n_words": F.size("_w").cast("bigint"),
        "word_chars": F.char_length(F.array_join("_w", "")).cast("bigint"),
        "n_symbols": gone(r"[#*$%&|<>]"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
        "n_repeat_words": repeated_words(F.col("_w")),
        "n_lines": F.size("_lines").cast("bigint"),
        "n_upper": gone("[A-Z]"),
        "n_ends": gone("[.!?]"),
        "n_stop": F.size(stop).cast("bigint"),
        # words with a symbol, words with a letter (any non-ASCII character is taken for one), ASCII punctuation
        "n_marked": F.size(F.filter("_w", lambda w: w.rlike(r"[#*$%&|<>]"))).cast("bigint"),
        "n_lettered": F.size(F.filter("_w", lambda w: w.rlike(r"[A-Za-z]|[^\x00-\x7F]"))).cast("bigint"),
        "n_punct": gone(r"[!-/:-@\[-`{-~]"),
    }).drop("_w", "_lines")


def repeated_words(w: Column, k: int = 3) -> Column:
    """Words of ``w`` in a window of ``k`` words that the list holds twice or more."""
    windows = F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(w) - k, F.lit(0))), lambda i: F.concat_ws(" ", *[F.get(w, i + j) for j in range(k)])
    )

    def covered(sorted_windows: Column) -> Column:
        s = sorted_windows
        same = lambda x, at: F.coalesce(F.get(s, at)["g"] == x["g"], F.lit(False))
        twice = F.filter(s, lambda x, i: same(x, i + 1) | same(x, i - 1))
        starts = F.sort_array(F.transform(twice, lambda x: x["i"]))
        step = lambda acc, p: F.struct(p.alias("last"), (acc["n"] + F.least(F.lit(k), p - acc["last"])).alias("n"))
        return F.aggregate(starts, F.struct(F.lit(-k).alias("last"), F.lit(0).alias("n")), step, lambda acc: acc["n"])

    def count(all_windows: Column) -> Column:
        numbered = F.transform(all_windows, lambda g, i: F.struct(g.alias("g"), i.alias("i")))
        return F.when(F.size(F.array_distinct(all_windows)) == F.size(all_windows), F.lit(0)).otherwise(bind(F.sort_array(numbered), covered))

    return F.when(F.size(w) < k, F.lit(0)).otherwise(bind(windows, count)).cast("bigint")


def vote(name: str) -> str:
    good, bad = RULES[name]
    return f"CASE WHEN {bad} THEN -1 WHEN {good} THEN 1 ELSE 0 END"


def posterior(prior: str, right_good: dict[str, str], right_bad: dict[str, str]) -> str:
    """SQL of the probability that a document of given votes ``v_<rule>`` is good."""
    terms = [f"ln({prior} / (1 - {prior}))"] + [
        f"CASE v_{r} WHEN 1 THEN ln({right_good[r]} / (1 - {right_bad[r]})) WHEN -1 THEN ln((1 - {right_good[r]}) / {right_bad[r]}) ELSE 0 END"
        for r in RULES
    ]
    return "1 / (1 + exp(-(" + " + ".join(terms) + ")))"


def updates() -> dict[str, str]:
    """SQL of the next parameters, from patterns with their count ``c`` and posterior ``q``."""
    cap = "least(0.99, greatest({}, {}))"
    # the tiny share keeps a class without documents at the start values
    good_held, bad_held = (f"{WEIGHT} * (sum({x}) + 1e-9)" for x in ("c * q", "c * (1 - q)"))
    out = {"prior": "least(0.99, greatest(0.01, sum(c * q) / sum(c)))"}
    for r in RULES:
        good = f"(sum(CASE WHEN v_{r} = 1 THEN c * q ELSE 0 END) + {RIGHT_GOOD} * {good_held}) / (sum(CASE WHEN v_{r} <> 0 THEN c * q ELSE 0 END) + {good_held})"
        bad = f"(sum(CASE WHEN v_{r} = -1 THEN c * (1 - q) ELSE 0 END) + {RIGHT_BAD} * {bad_held}) / (sum(CASE WHEN v_{r} <> 0 THEN c * (1 - q) ELSE 0 END) + {bad_held})"
        out |= {f"g_{r}": cap.format(LEAST_GOOD, good), f"b_{r}": cap.format(LEAST_BAD, bad)}
    return out


def fit(votes: DataFrame, steps: int = STEPS) -> dict[str, float]:
    """Parameters once they stand, or after ``steps`` rounds over the vote patterns; the start values for an empty table.

    The rounds run in one expression over the patterns as an array, which has at most
    3 to the power of the number of rules entries.
    """
    names = list(updates())
    held = votes.groupBy(*[f"v_{r}" for r in RULES]).agg(F.count(F.lit(1)).cast("double").alias("c"))
    row = held.agg(F.array_sort(F.collect_list(F.struct(*[f"v_{r}" for r in RULES], "c"))).alias("pats"))
    at = {k: f"p[{i}]" for i, k in enumerate(names)}
    q = posterior(at["prior"], {r: at[f"g_{r}"] for r in RULES}, {r: at[f"b_{r}"] for r in RULES})
    q = re.sub(r"\bv_", "x.v_", q)
    new = [re.sub(r"\bsum\(", "total(", v) for v in updates().values()]
    first = {"p": START, "g": RIGHT_GOOD, "b": RIGHT_BAD}
    start = f"array({', '.join(f'{first[k[0]]}D' for k in names)}, 1D)"  # the last entry is the largest move
    moved = f"array_max(zip_with(n, slice(p, 1, {len(names)}), (a, b) -> abs(a - b)))"
    rounds = (
        f"aggregate(sequence(1, {steps}), {start}, (p, i) -> if(p[{len(names)}] <= {TOLERANCE!r}D, p, "
        f"element_at(transform(transform(array(transform(pats, x -> struct(x AS x, {q} AS q))), "
        f"y -> array({', '.join(_over_array(v) for v in new)})), n -> concat(n, array({moved}))), 1)))"
    )
    found = row.select(F.when(F.size("pats") > 0, F.expr(rounds)).otherwise(F.expr(start)).alias("p")).first()["p"]
    return dict(zip(names, found))


def _over_array(update: str) -> str:
    """An update with its sums taken over the array ``y`` of patterns and posteriors."""
    out, rest = "", update
    while "total(" in rest:
        head, rest = rest.split("total(", 1)
        depth = 1
        end = next(i for i, ch in enumerate(rest) if (depth := depth + (ch == "(") - (ch == ")")) == 0)
        term = re.sub(r"\bv_", "z.x.v_", re.sub(r"\bc\b", "z.x.c", re.sub(r"\bq\b", "z.q", rest[:end])))
        out, rest = out + head + f"aggregate(y, 0D, (s, z) -> s + ({term}))", rest[end + 1 :]
    return f"CAST({out + rest} AS DOUBLE)"


def _with(now: dict[str, float]) -> str:
    lit = {k: f"{v!r}D" for k, v in now.items()}
    return posterior(lit["prior"], {r: lit[f"g_{r}"] for r in RULES}, {r: lit[f"b_{r}"] for r in RULES})


def judge(docs: DataFrame, keep: float = KEEP) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, the counts, ``base_failed``, ``posterior`` and ``kept``.

    The model is fitted on the rows that pass the base rules and gives all rows their
    posterior. Null and empty texts have no words and fail the base rules. Repeated rows
    are judged one by one and count as often as they occur. Other columns are ignored;
    an empty table gives no rows.
    """
    base = counts(docs.select("doc_id", "text")).drop("text")
    rows = materialize(base.withColumns({f"v_{r}": F.expr(vote(r)) for r in RULES} | {"base_failed": F.expr(BASE)}), "votes")
    good = F.expr(_with(fit(rows.where("NOT base_failed"))))
    return rows.withColumns({"posterior": good, "kept": ~F.col("base_failed") & (good >= keep)})
