"""License notices by a positional index of the rarest template words.

The templates are fixed notices. Their words are weighed by inverse document
frequency, counted over all documents; each template is indexed by its
``anchors`` rarest words and where they stand. A document's words are looked up
in the index, and postings of one template that agree on where it would start
add up. The best start whose share of the template's weight reaches ``least``
and one of whose mandatory phrases really stands in the document gives a label.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatelake.llm.common import alnum_words, bind
from gatelake.session import materialize

ANCHORS = 12
LEAST = 0.6

# fixed values: phrases that give a base label
BASE = [("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license")]

# fixed values: label, notice, mandatory phrases (any of them)
TEMPLATES = [
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license "
     "you may obtain a copy of the license at", ["compliance with the license"]),
    ("apache-short", "licensed under the apache license version 2 0", ["apache license version 2"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following "
     "conditions are met", ["redistribution and use in source and binary forms"]),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", ["creative commons attribution"]),
    ("cc-by-nc", "licensed under cc by nc 4 0", ["cc by nc"]),
    ("cc-by-sa", "licensed under cc by sa 4 0", ["cc by sa"]),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as "
     "published by the free software foundation either version", ["terms of the gnu general public license"]),
    ("gpl-short", "this work is licensed under the gnu general public license version 3", ["gnu general public license version"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
     ["with or without fee is hereby granted"]),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation "
     "files the software to deal in the software without restriction", ["permission is hereby granted free of charge"]),
    ("mit-short", "released under the mit license", ["under the mit license"]),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", ["mozilla public license"]),
    ("unlicense", "this is free and unencumbered software released into the public domain", ["free and unencumbered software"]),
]


def _vocabulary() -> list[str]:
    return sorted({w for _, notice, _ in TEMPLATES for w in notice.split()})


def _phrase_starts(words: Column, phrase: str) -> Column:
    parts = phrase.split()
    at = F.sequence(F.lit(0), F.greatest(F.size(words) - len(parts), F.lit(0)))
    same = lambda i: F.forall(F.array(*[F.coalesce(F.get(words, i + j) == p, F.lit(False)) for j, p in enumerate(parts)]), lambda ok: ok)
    return F.filter(at, same)


def scan(docs: DataFrame, anchors: int = ANCHORS, least: float = LEAST) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``.

    ``score`` is the best share of a verified template, 1 where a base phrase stands
    without one. Null and empty texts have no words and no labels; repeated rows each
    get a row. Other columns are ignored; an empty table gives no rows.
    """
    spark, vocabulary = docs.sparkSession, _vocabulary()
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", alnum_words(text).alias("w"))
    hits = F.filter(F.transform("w", lambda w, i: F.when(w.isin(vocabulary), F.struct(w.alias("w"), i.alias("i")))), lambda x: x.isNotNull())
    holds = lambda t, p: F.contains(t, F.lit(f" {p} "))
    keys = bind(F.concat(F.lit(" "), F.array_join("w", " "), F.lit(" ")), lambda t: F.array(
        *[holds(t, p) for _, p in BASE], *[F.array_max(F.array(*[holds(t, p) for p in ps])) for _, _, ps in TEMPLATES]
    ))
    base = base.withColumn("keys", keys)
    starts = [F.when(F.get("keys", i), _phrase_starts(F.col("w"), p)).otherwise(F.array().cast("array<int>")) for i, (_, p) in enumerate(BASE)]
    rows = materialize(base.select(
        "rid", "doc_id", F.size("w").cast("bigint").alias("n_words"), F.array(*starts).alias("starts"), hits.alias("hits"),
        F.slice("keys", len(BASE) + 1, len(TEMPLATES)).alias("keys"),
    ), "licenses")
    weights = _weights(rows, vocabulary)
    index = _index(weights, anchors)
    table = spark.createDataFrame(index, "w string, template int, at int, weight double")  # a few hundred rows at most
    total = {t: sum(x[3] for x in index if x[1] == t) or 1.0 for t in range(len(TEMPLATES))}
    share = F.element_at(F.array(*[F.lit(total[t]) for t in range(len(TEMPLATES))]), F.col("template") + 1)
    # only documents that hold a mandatory phrase can get a label
    found = rows.where(F.exists("keys", lambda k: k)).select("rid", "keys", F.explode("hits").alias("h")).select("rid", "keys", "h.w", "h.i")
    scored = (
        found.join(F.broadcast(table), "w").where(F.get("keys", F.col("template")))
        .groupBy("rid", "template", (F.col("i") - F.col("at")).alias("start")).agg(F.sum("weight").alias("got"))
        .withColumn("share", F.least(F.lit(1.0), F.round(F.col("got") / share, 6))).where(F.col("share") >= least)
        .groupBy("rid", "template").agg(F.max("share").alias("share"))
        .groupBy("rid").agg(F.collect_set(_label(F.col("template"))).alias("more"), F.max("share").alias("best"))
    )
    out = rows.join(scored, "rid", "left")
    places = F.flatten("starts")
    named = F.filter(F.array(*[F.when(F.size(F.get("starts", i)) > 0, label) for i, (label, _) in enumerate(BASE)]), lambda x: x.isNotNull())
    more = F.coalesce("more", F.array().cast("array<string>"))
    return out.select(
        "doc_id", "n_words", F.size(places).cast("bigint").alias("n_base"), F.array_min(places).cast("bigint").alias("first_word"),
        F.array_max(places).cast("bigint").alias("last_word"), F.array_join(F.array_sort(named), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(named, more))), ",").alias("labels"),
        F.greatest(F.coalesce("best", F.lit(0.0)), F.when(F.size(places) > 0, 1.0).otherwise(0.0)).alias("score"),
    )


def _label(template: Column) -> Column:
    names = [label.removesuffix("-short") for label, _, _ in TEMPLATES]
    return F.element_at(F.array(*map(F.lit, names)), template + 1)


def _weights(rows: DataFrame, vocabulary: list[str]) -> dict[str, float]:
    """Inverse document frequency of the vocabulary over all documents; one number per template word."""
    n = rows.count()
    seen = rows.select(F.explode(F.array_distinct(F.transform("hits", lambda h: h["w"]))).alias("w")).groupBy("w").count()
    df = {r["w"]: r["count"] for r in seen.collect()}
    return {w: math.log((n + 1) / (df.get(w, 0) + 1)) + 1 for w in vocabulary}


def _index(weights: dict[str, float], anchors: int) -> list[tuple[str, int, int, float]]:
    """Postings of the ``anchors`` heaviest words of each template."""
    out = []
    for t, (_, notice, _) in enumerate(TEMPLATES):
        rare = set(sorted(set(notice.split()), key=lambda w: (-weights[w], w))[:anchors])
        out += [(w, t, i, weights[w]) for i, w in enumerate(notice.split()) if w in rare]
    return out
