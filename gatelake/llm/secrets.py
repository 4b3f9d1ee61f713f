"""Secrets in texts: fixed shapes, and strings that a battery of tests takes for random.

For every long run of key characters an encoding is inferred (decimal, hex, letters,
base 32, 36, 62 or 64); a run that fits none, such as a key behind a path with dashes, is
taken apart into its longest parts of either base 64. Three tests ask whether its symbols look uniform and
independent: chi-squared of the symbol counts, runs above and below the middle,
correlation of neighbours. Their p-values are combined (Bonferroni) and, within
each band of lengths, words and names are rejected as not random by the
Benjamini-Hochberg rule over all candidates of the corpus. What stands is random.
Bands keep short strings, whose tests are weak, from loosening the rule for long
ones. The rule needs only counts per band and p-value bin, a table of fixed size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gatelake.llm.common import bind
from gatelake.session import materialize

ASSIGN = (
    r"(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
# '=' is padding at the end of a run only, so that a value behind its name is a run of its own
PADDING = r"(?:={1,2}(?![A-Za-z0-9+/_=-]))?"
CANDIDATE, *PARTS = (f"{chars}{{20,}}{PADDING}" for chars in ("[A-Za-z0-9+/_-]", "[A-Za-z0-9+/]", "[A-Za-z0-9_-]"))
KINDS = ("assign", "access", "hex", "random")
LENGTHS = (32, 48, 64, 128)  # upper ends of the bands but the last
BINS_PER_DECADE, BINS = 50, 400
FALSE_DISCOVERY = 0.05

# alphabets in order of preference: size, symbols in order, shape
ALPHABETS = [
    (10, "0123456789", "^[0-9]+$"),
    (16, "0123456789abcdef", "^[0-9a-f]+$"),
    (16, "0123456789ABCDEF", "^[0-9A-F]+$"),
    (26, "abcdefghijklmnopqrstuvwxyz", "^[a-z]+$"),
    (26, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "^[A-Z]+$"),
    (52, "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", "^[A-Za-z]+$"),
    (32, "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "^[A-Z2-7]+$"),
    (36, "0123456789abcdefghijklmnopqrstuvwxyz", "^[0-9a-z]+$"),
    (62, "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", "^[0-9A-Za-z]+$"),
    (64, "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", "^[A-Za-z0-9+/]+$"),
    (64, "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_", "^[A-Za-z0-9_-]+$"),
]


def places(text: Column, pattern: str) -> Column:
    """``start, end, m`` of the leftmost non-overlapping matches, in code points; linear in the text."""
    lengths = F.zip_with(
        F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda g, m: F.struct(F.char_length(g).alias("g"), F.char_length(m).alias("n"), m.alias("m")),
    )
    none = F.array().cast("array<struct<start:int,end:int,m:string>>")

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["g"]
        return F.struct((start + x["n"]).alias("at"), F.concat(acc["out"], F.array(F.struct(start.alias("start"), (start + x["n"]).alias("end"), x["m"].alias("m")))).alias("out"))

    found = F.aggregate(F.filter(lengths, lambda x: x["m"].isNotNull()), F.struct(F.lit(0).alias("at"), none.alias("out")), step, lambda acc: acc["out"])
    return F.when(text.rlike(pattern), found).otherwise(none)


def upper_tail(z: Column) -> Column:
    """Probability that a standard normal exceeds ``z`` (rational approximation, error below 1e-7)."""
    x = F.abs(z) / 1.4142135623730951
    t = 1 / (1 + 0.3275911 * x)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    tail = poly * F.exp(-x * x) / 2
    return F.when(z >= 0, tail).otherwise(1 - tail)


def _p_value(values: Column, m: Column) -> Column:
    """Combined p-value of the battery for symbols ``values`` of an alphabet of ``m``."""
    n = F.size(values).cast("double")

    def run(counts: Column) -> Column:
        squares = F.aggregate(counts, F.lit(0.0), lambda a, c: a + c * c)
        uniform = upper_tail((m / n * squares - n - (m - 1)) / F.sqrt(2 * (m - 1) * (n - 1) / n))
        high = F.transform(values, lambda v: (v * 2 >= m).cast("int"))
        pairs = lambda x: F.zip_with(F.slice(x, 1, F.size(x) - 1), F.slice(x, 2, F.size(x) - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))

        def runs(h: Column) -> Column:
            up = F.aggregate(h, F.lit(0), lambda a, v: a + v).cast("double")
            turns = 1.0 + F.size(F.filter(pairs(h), lambda p: p["a"] != p["b"]))
            mean = 2 * up * (n - up) / n + 1
            spread = F.greatest((mean - 1) * (mean - 2) / (n - 1), F.lit(1e-9))
            return 2 * upper_tail(F.abs(turns - mean) / F.sqrt(spread))

        mean = F.aggregate(values, F.lit(0.0), lambda a, v: a + v) / n

        def serial(mu: Column) -> Column:
            total = F.aggregate(values, F.lit(0.0), lambda a, v: a + (v - mu) * (v - mu))
            lag = F.aggregate(pairs(values), F.lit(0.0), lambda a, p: a + (p["a"] - mu) * (p["b"] - mu))
            return F.when(total > 0, 2 * upper_tail(F.abs(lag / total + 1 / n) * F.sqrt(n))).otherwise(0.0)

        return F.least(F.lit(1.0), 3 * F.least(uniform, bind(high, runs), bind(mean, serial)))

    symbols = F.array_distinct(values)
    counts = F.transform(symbols, lambda s: F.size(F.filter(values, lambda v: v == s)).cast("double"))
    return bind(counts, run)


def candidates(text: Column) -> Column:
    """``start, end, m`` of the runs to test: whole where one alphabet may fit, else their parts."""
    def parts(x: Column) -> Column:
        at = lambda y: F.struct((x["start"] + y["start"]).alias("start"), (x["start"] + y["end"]).alias("end"), y["m"].alias("m"))
        mixed = x["m"].rlike("[+/]") & x["m"].rlike("[_-]")
        return F.when(mixed, F.array_distinct(F.concat(*[F.transform(places(x["m"], p), at) for p in PARTS]))).otherwise(F.array(x))

    return F.flatten(F.transform(places(text, CANDIDATE), parts))


def merged(spans: Column) -> Column:
    """Spans ``start, rank, end`` of one kind, with those that overlap as one."""
    def step(acc: Column, x: Column) -> Column:
        last = F.get(acc, F.size(acc) - 1)
        both = F.struct(last["start"].alias("start"), x["rank"].alias("rank"), F.greatest(last["end"], x["end"]).alias("end"))
        return F.when(last["end"] > x["start"], F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(both))).otherwise(F.concat(acc, F.array(x)))

    return F.aggregate(F.sort_array(spans), F.array().cast("array<struct<start:int,rank:int,end:int>>"), step)


def tested(m: Column) -> Column:
    """Length band and p-value bin of a candidate; null where no alphabet fits or neither letters nor digits are in it."""
    body = F.rtrim(m, F.lit("="))
    which = F.lit(None).cast("int")
    for i, (_, _, shape) in reversed(list(enumerate(ALPHABETS))):
        which = F.when(body.rlike(shape), i).otherwise(which)
    symbols = F.array(*[F.lit(a[1]) for a in ALPHABETS])
    sizes = F.array(*[F.lit(float(a[0])) for a in ALPHABETS])
    fits = body.rlike("[A-Za-z0-9]") & (F.char_length(body) >= 16)

    def run(i: Column) -> Column:
        chars = F.filter(F.split(body, ""), lambda c: c != "")
        values = F.transform(chars, lambda c: F.instr(F.get(symbols, i), c).cast("double") - 1)
        p = bind(values, lambda v: _p_value(v, F.get(sizes, i)))
        band = F.lit(len(LENGTHS))
        for k, top in reversed(list(enumerate(LENGTHS))):
            band = F.when(F.char_length(body) < top, k).otherwise(band)
        bin_ = F.floor(-F.log10(F.greatest(p, F.lit(1e-300))) * BINS_PER_DECADE).cast("int")
        return F.struct(band.alias("band"), F.least(bin_, F.lit(BINS)).alias("bin"))

    return bind(which, lambda i: F.when(i.isNotNull() & fits, run(i)))


def rejection(found: DataFrame, q: float = FALSE_DISCOVERY) -> dict[int, int]:
    """Per band the least bin that is rejected as not random; ``found(band, bin)``."""
    held = found.groupBy("band", "bin").agg(F.count(F.lit(1)).alias("c"))
    by_band = W.partitionBy("band")
    ranked = held.withColumns({
        "rank": F.sum("c").over(by_band.orderBy(F.desc("bin"))), "m": F.sum("c").over(by_band),
    })
    passed = ranked.where(F.pow(F.lit(10.0), -F.col("bin") / BINS_PER_DECADE) <= q * F.col("rank") / F.col("m"))
    return {r["band"]: r["bin"] for r in passed.groupBy("band").agg(F.min("bin").alias("bin")).collect()}  # one row per band


def _kept(spans: Column, kind: str, condition=None) -> Column:
    chosen = F.filter(spans, condition) if condition is not None else spans
    rank = KINDS.index(kind)
    return F.transform(chosen, lambda x: F.struct(x["start"].alias("start"), F.lit(rank).alias("rank"), x["end"].alias("end")))


def _listed(spans: Column) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    text = lambda x: F.concat_ws(":", F.get(kinds, x["rank"]), x["start"].cast("string"), x["end"].cast("string"))
    return F.array_join(F.transform(F.sort_array(spans), text), ",")


def scan(docs: DataFrame, q: float = FALSE_DISCOVERY) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_assign, n_access, n_hex, base_sha256, spans``, and ``found`` as an array.

    A null text is an empty one: no spans. Repeated rows are scanned one by one and
    count as often as they occur. Other columns are ignored; an empty table gives no rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    long_value = lambda x: F.char_length(F.regexp_extract(x["m"], ASSIGN, 1)) >= 6
    spot = F.transform(candidates(text), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), tested(x["m"]).alias("t")))
    rows = materialize(docs.select(
        "doc_id", _kept(places(text, ASSIGN), "assign", long_value).alias("assign"), _kept(places(text, ACCESS), "access").alias("access"),
        _kept(places(text, HEX), "hex").alias("hex"), F.filter(spot, lambda x: x["t"].isNotNull()).alias("spots"),
    ), "secrets")
    limits = rejection(rows.select(F.explode("spots").alias("x")).select("x.t.band", "x.t.bin"), q)
    bands = F.array(*[F.lit(limits.get(b, BINS + 1)) for b in range(len(LENGTHS) + 1)])
    random = merged(_kept(F.filter("spots", lambda x: x["t"]["bin"] < F.get(bands, x["t"]["band"])), "random"))
    base = F.concat("assign", "access", "hex")
    return rows.select(
        "doc_id", *[F.size(k).cast("bigint").alias(f"n_{k}") for k in KINDS[:3]], F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.concat(base, random)).alias("spans"), F.size(random).cast("bigint").alias("n_random"),
        F.sort_array(F.concat(base, random)).alias("found"),
    )
