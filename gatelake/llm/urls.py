"""URL filter: fixed rules by host and path, and else the reputation of the host.

Labelled pages are outcomes, good or bad. The bad rate of a host is shrunk to
that of its registered domain, that to its suffix, and that to all pages: each
level is a beta prior around the posterior mean of the level above, as strong as
the spread between its children allows (method of moments). A page is blocked
where the lower bound of its host's posterior bad rate exceeds ``most``. Hosts
without labels inherit the prior of the nearest level that has some.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatelake.session import materialize

MOST = 0.5
Z = 1.645  # one-sided 95 %
# fixed values: action, host, path
RULES = [
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"),
]
# fixed values: second labels that belong to the suffix
SECOND = ("ac", "co", "com", "edu", "gov", "net", "org")
STRENGTH = (2.0, 1000.0)  # bounds of a prior's weight, in pages

LEVELS = ("suffix", "domain", "host")


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def suffix_of(host: Column) -> Column:
    second = "|".join(SECOND)
    return F.coalesce(F.nullif(F.regexp_extract(host, rf"\.((?:{second})\.[a-z]{{2}})$", 1), F.lit("")), F.regexp_extract(host, r"([^.]*)$", 1))


def domain_of(host: Column) -> Column:
    second = "|".join(SECOND)
    deep = F.regexp_extract(host, rf"([^.]+\.(?:{second})\.[a-z]{{2}})$", 1)
    return F.coalesce(F.nullif(deep, F.lit("")), F.nullif(F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1), F.lit("")), host)


def rule_of(host: Column, path: Column) -> Column:
    """``rule`` and ``action`` of the longest rule that fits; null where none does."""
    out = F.lit(None).cast("struct<rule:string,action:string>")
    for action, h, p in sorted(RULES, key=lambda r: len(r[1] + r[2])):  # later ones win
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(action).alias("action"))).otherwise(out)
    return out


def reputation(outcomes: DataFrame) -> dict[str, DataFrame]:
    """Per level a table of posteriors from ``outcomes(host, bad)``: the key, ``a`` and ``b`` of the beta distribution.

    Also ``all``: one row for pages of unknown hosts. Sums over hosts come first, so a
    busy host costs no more than a quiet one.
    """
    hosts = materialize(outcomes.groupBy("host").agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum(F.col("bad").cast("double")).alias("x")), "hosts")
    named = hosts.withColumns({"suffix": suffix_of(F.col("host")), "domain": domain_of(F.col("host"))})
    top = named.agg(F.coalesce(F.sum("n"), F.lit(0.0)).alias("n"), F.coalesce(F.sum("x"), F.lit(0.0)).alias("x"))
    above = top.select(F.lit("").alias("up"), (F.col("x") + 1).alias("a"), (F.col("n") - F.col("x") + 1).alias("b"))
    out, parent = {"all": above}, F.lit("")
    for level in LEVELS:
        here = named.groupBy(F.col(level).alias("key")).agg(F.sum("n").alias("n"), F.sum("x").alias("x"), F.first(parent).alias("up"))
        joined = here.join(above, "up").withColumn("mean", F.col("a") / (F.col("a") + F.col("b")))
        # spread of the children's rates around the mean above, less what chance explains
        moment = joined.agg(
            F.sum(F.col("n") * F.pow(F.col("x") / F.col("n") - F.col("mean"), 2)).alias("s"),
            F.sum(F.col("mean") * (1 - F.col("mean"))).alias("c"), F.sum(F.col("n") * F.col("mean") * (1 - F.col("mean"))).alias("t"),
        ).select(F.when(F.col("s") > F.col("c"), F.greatest(F.lit(STRENGTH[0]), F.least(F.lit(STRENGTH[1]), F.col("t") / (F.col("s") - F.col("c"))))).otherwise(STRENGTH[1]).alias("k")).first()
        k = moment["k"] if moment["k"] is not None else STRENGTH[1]
        post = joined.select("key", (k * F.col("mean") + F.col("x")).alias("a"), (k * (1 - F.col("mean")) + F.col("n") - F.col("x")).alias("b"))
        out[level] = materialize(post, level)
        above, parent = out[level].select(F.col("key").alias("up"), "a", "b"), F.col(level)
    return out


def lower_bound(a: Column, b: Column, z: float = Z) -> Column:
    """Normal approximation of the lower end of a beta distribution."""
    mean = a / (a + b)
    return F.greatest(F.lit(0.0), mean - z * F.sqrt(mean * (1 - mean) / (a + b + 1)))


def judge(pages: DataFrame, labels: DataFrame, most: float = MOST) -> DataFrame:
    """Per row of ``pages``: ``page_id, host, path, rule, verdict, bad_rate, bound``.

    ``labels`` gives outcomes by ``doc_id``, the number of the page: bad where quality
    is 0 or toxic is 1. A null url or one without ``://`` has an empty host and path;
    repeated pages each get a row and count as often as they occur; of repeated labels
    the worst counts. Other columns are ignored; without labels nothing is blocked but by rule.
    """
    base = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    worst = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").alias("page_id")).agg(
        F.max(F.when((F.col("quality") == 0) | (F.coalesce(F.col("toxic"), F.lit(0)) == 1), 1).otherwise(0)).alias("bad")
    )
    post = reputation(base.join(worst, "page_id").select("host", "bad"))
    out = base.withColumns({"domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host")), "_r": rule_of(F.col("host"), F.col("path"))})
    for level in LEVELS:
        out = out.join(post[level].select(F.col("key").alias(level), F.struct("a", "b").alias(f"_{level}")), level, "left")
    a0, b0 = post["all"].select("a", "b").first()
    known = F.coalesce("_host", "_domain", "_suffix", F.struct(F.lit(float(a0)).alias("a"), F.lit(float(b0)).alias("b")))
    bound = F.round(lower_bound(known["a"], known["b"]), 6)
    verdict = F.coalesce(F.col("_r.action"), F.when(bound > most, "block").otherwise("allow"))
    return out.select(
        "page_id", "host", "path", F.col("_r.rule").alias("rule"), verdict.alias("verdict"),
        F.round(known["a"] / (known["a"] + known["b"]), 6).alias("bad_rate"), bound.alias("bound"),
    )
