"""Small tables that hold the awkward rows every operator must take."""

import random

from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names the operators use for their own columns
    T.StructField("score", T.StringType()), T.StructField("n_words", T.StringType()), T.StructField("h", T.StringType()),
    T.StructField("w", T.StringType()), T.StructField("rid", T.StringType()), T.StructField("keep", T.StringType()),
    T.StructField("ids", T.StringType()), T.StructField("held_out", T.StringType()), T.StructField("node", T.StringType()),
])


def frame(spark, rows):
    """``rows`` of (doc_id, text), with the other columns filled or null."""
    full = [(i, t, None if k % 3 == 0 else "en", None if k % 4 == 0 else f"s{k % 2}", None if t is None or k % 5 == 0 else len(t), *["x"] * 9)
            for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, DOCS)


def prose(n, seed=0):
    r = random.Random(seed)
    return " ".join("".join(r.choice("etaoinshrdlu") for _ in range(r.randint(2, 7))) for _ in range(n))


def awkward():
    long = prose(30_000, 1)
    return [
        (1, None), (2, ""), (3, " \t\r\n\x0b\x0c "), (4, "word"), (5, "two words"), (6, long), (7, long), (7, long), (None, prose(60, 2)), (None, None),
        (8, "é É K İ 日本語 \U0001f600"), (9, "x" * 40_000), (10, "a b c " * 200), (11, prose(60, 3)), (12, prose(60, 3)), (13, "\n\n|\n"),
    ]


def texts(sf="/root/testdata/sf0.001"):
    import duckdb

    return duckdb.sql(f"SELECT doc_id + 100000, text FROM '{sf}/documents.parquet' ORDER BY doc_id").fetchall()
