"""Text repairs of logic-network and netlist files. Row-wise JVM expressions, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatelake.functions import patterns as P
from gatelake.functions import text as X


def lines_of(text: Column) -> Column:
    """Lines without the empty piece after a final newline."""
    return F.split(F.regexp_replace(text, r"\n\z", ""), "\n")


def fix_constants(text: Column) -> Column:
    """Move constant ``.names`` entries before the first ``.end``, later ones first.

    ``-`` entries become one blank. NULL when a file has no ``.end`` line.
    """
    moved = F.reverse(
        F.zip_with(
            X.find_all(text, P.BLIF_CONSTANT, 1), X.find_all(text, P.BLIF_CONSTANT, 2),
            lambda n, v: F.when(v == "-", F.lit(" ")).otherwise(F.concat(F.replace(n, F.lit("  "), F.lit(" ")), v)),
        )
    )

    def rebuilt(rest: Column) -> Column:
        end = F.array_position(rest, ".end").cast("int")
        parts = F.concat(
            F.slice(rest, F.lit(1), F.greatest(end - 1, F.lit(0))), moved,
            F.slice(rest, F.greatest(end, F.lit(1)), F.size(rest)),
        )
        return F.when(end > 0, F.array_join(parts, "\n"))

    return X.let(lines_of(F.regexp_replace(text, P.BLIF_CONSTANT, "")), rebuilt)


def drop_duplicate_models(text: Column) -> Column:
    """One ``.model`` block per name; dropped blocks leave two newlines.

    The text of a name's first block decides. When the same text occurs again
    the last occurrence stays, because replacing a block's text hits its
    first occurrence.
    """
    blocks = F.transform(
        F.arrays_zip(X.find_all(text, P.BLIF_MODEL, 1).alias("name"), X.find_all(text, P.BLIF_MODEL, 0).alias("text")),
        lambda b, i: F.struct(b["name"].alias("name"), b["text"].alias("text"), i.alias("i")),
    )

    def starts(entries: Column, field: str) -> Column:
        """The first of each run of entries that agree in ``field``."""
        return F.filter(entries, lambda e, k: (k == 0) | (F.get(entries, k - 1)[field] != e[field]))

    def ends(entries: Column, field: str) -> Column:
        return F.filter(entries, lambda e, k: (k == F.size(entries) - 1) | (F.get(entries, k + 1)[field] != e[field]))

    def marked(bs: Column) -> Column:
        # sorted by name, text and place, equal texts are neighbours: a run has a first and a last place
        runs = X.let(F.array_sort(bs), lambda s: F.zip_with(
            starts(s, "text"), ends(s, "text"), lambda a, z: F.struct(a["name"].alias("name"), a["i"].alias("first"), z["i"].alias("last"))))
        # sorted by name and first place, the run that decides is the first of its name
        kept = X.let(F.array_sort(runs), lambda r: F.array_sort(F.transform(starts(r, "name"), lambda e: e["last"])))
        before = lambda s, j: F.when(j > 0, F.get(s, j - 1)).otherwise(F.lit(-1))
        marks = X.let(kept, lambda s: F.split(F.array_join(F.transform(
            s, lambda k, j: F.concat(F.repeat(F.lit("0"), k - before(s, j) - 1), F.lit("1"))), ""), ""))
        return F.slice(F.zip_with(bs, marks, lambda b, m: F.when(m == "1", b["text"]).otherwise(F.lit("\n\n"))), F.lit(1), F.size(bs))

    return X.interleave(F.split(text, P.BLIF_MODEL), X.let(blocks, marked), lambda t: t)


def remove_exdc(text: Column) -> Column:
    return F.regexp_replace(text, P.BLIF_EXDC, ".end")


def append_end(text: Column) -> Column:
    return F.concat(text, F.lit("\n.end"))


def add_global_clock(text: Column) -> Column:
    """Give latches without a control a global clock.

    Every model that owns such a latch gets ``.inputs clk`` before its first
    directive other than ``.inputs``; the latch becomes ``re clk``. NULL when
    a latch has no model or its model no such directive. Text without such
    latches is returned as it is.
    """
    chunks = F.split(F.regexp_replace(F.array_join(lines_of(text), "\n"), r"(?m)^\.model", "\u0001.model"), "\u0001")

    def insert(lines: Column) -> Column:
        at = F.array_position(
            F.transform(lines, lambda s, i: (i > 0) & F.ltrim(s).startswith(".") & ~F.ltrim(s).startswith(".inputs")), True
        ).cast("int")
        head = F.slice(lines, F.lit(1), F.greatest(at - 1, F.lit(0)))
        tail = F.slice(lines, F.greatest(at, F.lit(1)), F.size(lines))
        return F.when(at > 1, F.array_join(F.concat(head, F.array(F.lit(".inputs clk")), tail), "\n"))

    def clocked(chunk: Column, i: Column) -> Column:
        return F.when(~chunk.rlike(P.BLIF_LATCH), chunk).when(i > 0, X.let(F.split(chunk, "\n"), insert))

    def joined(parts: Column) -> Column:
        return F.when(
            ~F.exists(parts, lambda c: c.isNull()),
            F.regexp_replace(F.array_join(parts, ""), P.BLIF_LATCH, ".latch $1 $2 re clk $3"))

    return F.when(text.rlike(P.BLIF_LATCH), X.let(F.transform(chunks, clocked), joined)).otherwise(text)


# ------------------------------------------------------------------ cell arrays
def _ports(rest: Column) -> Column:
    """``array<struct<name, bits>>``; bits NULL for a port without a range."""
    plain = F.regexp_replace(F.translate(rest, "()", ""), r";\s*$", "")

    def port(p: Column) -> Column:
        has = p.rlike(P.PORT_RANGE)
        bits = F.when(
            has,
            F.sequence(
                F.regexp_extract(F.when(has, p).otherwise("x[0:0]"), P.PORT_RANGE, 2).cast("int"),
                F.regexp_extract(F.when(has, p).otherwise("x[0:0]"), P.PORT_RANGE, 3).cast("int")),
        )
        return F.struct(F.regexp_extract(p, P.PORT_RANGE, 1).alias("name"), bits.alias("bits"))

    return F.transform(F.transform(F.split(plain, ","), lambda p: F.trim(p)), port)


def _array_line(line: Column) -> Column:
    """Unrolled text of one instance-array line; NULL when widths differ or a port has no range."""
    safe = F.when(line.rlike(P.CELL_ARRAY_LINE), line).otherwise(F.lit("x y[0:0] (z[0:0]);"))

    def g(i: int) -> Column:
        return F.regexp_extract(safe, P.CELL_ARRAY_LINE, i)

    head = F.struct(
        F.concat(g(1), F.lit(" "), g(2), g(3), F.lit("__")).alias("name"),
        F.sequence(g(4).cast("int"), g(5).cast("int")).alias("index"),
        _ports(g(6)).alias("ports"),
    )

    def unrolled(h: Column) -> Column:
        valid = F.forall(h["ports"], lambda p: F.coalesce(F.size(p["bits"]), F.lit(-1)) == F.size(h["index"]))

        def instance(n: Column, i: Column) -> Column:
            wired = F.array_join(
                F.transform(h["ports"], lambda p: F.concat(p["name"], F.lit("["), F.get(p["bits"], i).cast("string"), F.lit("]"))), ", ")
            return F.concat(h["name"], n.cast("string"), F.lit(" ("), wired, F.lit(");"))

        return F.when(valid, F.array_join(F.transform(h["index"], instance), "\n"))

    return X.let(head, unrolled)


def unroll_cell_arrays(text: Column) -> Column:
    """One instance per index for every ``cell name[a:b] (…)`` line that starts at the margin.

    NULL when any such line is invalid (see ``cell_array_errors``).
    """
    out = F.transform(
        lines_of(text), lambda s: F.when(s.rlike(P.CELL_ARRAY_LINE), _array_line(s)).otherwise(s))
    return X.let(out, lambda ls: F.when(~F.exists(ls, lambda s: s.isNull()), F.array_join(ls, "\n")))


def cell_array_errors(files: DataFrame) -> DataFrame:
    """Instance-array lines whose port and index ranges disagree: ``(design_name, file_name, line_no, line)``."""
    lines = files.select("design_name", "file_name", F.posexplode(lines_of(F.col("text"))).alias("line_no", "line"))
    return lines.filter(F.col("line").rlike(P.CELL_ARRAY_LINE)).filter(_array_line(F.col("line")).isNull())
