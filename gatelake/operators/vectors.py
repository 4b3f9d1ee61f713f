"""TF-IDF vectors and their 2-D projections."""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatelake.functions import patterns as P
from gatelake.functions import text as X
from gatelake.operators.tokens import char_frequencies
from gatelake.session import materialize

MAX_FEATURES = 1024
WORD = r"(?U)\w\w+"


def char_terms(docs: DataFrame, key: str) -> DataFrame:
    """``(key, term, tf)`` over single characters; runs of two or more blanks count as one."""
    text = F.regexp_replace("text", rf"[{P.WS_CLASS}][{P.WS_CLASS}]+", " ")
    return char_frequencies(docs.select(key, text.alias("text")), [key]).select(
        key, F.col("ch").alias("term"), F.col("n").alias("tf"))


MARKS = 1 << 20  # places of a bit map


def _place(word: Column) -> Column:
    """Place of a word in a bit map."""
    return F.pmod(F.xxhash64(word), F.lit(MARKS)).cast("int")


def _bit_map(places: DataFrame) -> DataFrame:
    """One row with a bit map of ``places(place)``, of a fixed size however many there are."""
    longs = places.groupBy(F.shiftright("place", 6).alias("i")).agg(
        F.bit_or(F.expr("shiftleft(1L, place % 64)")).alias("bits")).unionByName(
        places.sparkSession.range(MARKS // 64).select(F.col("id").cast("int").alias("i"), F.lit(0).cast("bigint").alias("bits")))
    return longs.groupBy("i").agg(F.bit_or("bits").alias("bits")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("i", "bits"))), lambda x: x["bits"]).alias("marks"))


def _marked(place: Column) -> Column:
    return F.get(F.col("marks"), F.shiftright(place, 6)).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("bigint"), place % 64)) != 0


def _grams(n: int) -> Column:
    """n-grams of ``w`` with no gap in them."""
    whole = lambda i: reduce(Column.__and__, [F.get("w", i + k).isNotNull() for k in range(n)])
    starts = F.when(F.size("w") >= n, F.sequence(F.lit(0), F.size("w") - n)).otherwise(F.array().cast("array<int>"))
    return F.transform(F.filter(starts, whole), lambda i: F.concat_ws(" ", *[F.get("w", i + k) for k in range(n)])) if n > 1 else F.filter("w", lambda x: x.isNotNull())


def _frequent_words(docs: DataFrame, key: str, max_features: int) -> tuple[DataFrame, DataFrame]:
    """``(term, n)`` of all words, and ``(key, w)``: each document's words, with a null in place of those that cannot be part of a frequent n-gram.

    An n-gram is at most as frequent as its rarest word, and ``max_features`` words
    alone reach the count of the last of them, so n-grams with a rarer word cannot
    be among the first. The words frequent enough stand in a bit map that every task
    holds; it has a fixed size, takes any number of ties, and words that share a
    place with a frequent one only lead to more counted n-grams.
    """
    words = docs.select(key, X.find_all(F.lower("text"), WORD).alias("w"))
    single = materialize(words.select(F.explode("w").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n")), "word_counts")
    last = single.orderBy(F.col("n").desc()).limit(max_features).agg(F.when(F.count(F.lit(1)) == max_features, F.min("n")).otherwise(0).alias("cut"))
    marks = _bit_map(single.where(F.col("n") >= last.scalar()).select(_place(F.col("term")).alias("place")))
    kept = F.transform("w", lambda x: F.when(_marked(_place(x)), x))
    # one row of fixed size
    return single, materialize(words.crossJoin(F.broadcast(marks)).select(key, kept.alias("w")), "frequent_words")


def _vocabulary_of(single: DataFrame, kept: DataFrame, max_n: int, max_features: int) -> DataFrame:
    longer = kept.select(F.explode(F.concat(F.array().cast("array<string>"), *[_grams(n) for n in range(2, max_n + 1)])).alias("term")).groupBy("term").agg(
        F.count(F.lit(1)).alias("n"))
    return single.unionByName(longer).orderBy(F.col("n").desc(), "term").limit(max_features).select("term")


def word_vocabulary(docs: DataFrame, key: str, max_n: int = 3, max_features: int = MAX_FEATURES) -> DataFrame:
    """The ``max_features`` most frequent lower-case word 1..n-grams (words of two or more characters), by exact counts."""
    return _vocabulary_of(*_frequent_words(docs, key, max_features), max_n, max_features)


def word_terms(docs: DataFrame, key: str, max_n: int = 3, max_features: int = MAX_FEATURES) -> DataFrame:
    """``(key, term, tf)`` of the vocabulary's terms; others are dropped in the task that reads them."""
    single, kept = _frequent_words(docs, key, max_features)
    vocab = materialize(_vocabulary_of(single, kept, max_n, max_features), "vocabulary")
    # bounded: max_features rows
    return kept.select(key, F.explode(F.concat(*[_grams(n) for n in range(1, max_n + 1)])).alias("term")).join(
        F.broadcast(vocab), "term").groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))


def vocabulary(terms: DataFrame, max_features: int = MAX_FEATURES) -> DataFrame:
    """The ``max_features`` terms most frequent in the corpus (name breaks ties): ``(term, term_idx, df)``.

    Counts combine on the map side, the top-k is a per-partition heap merge.
    """
    top = (
        terms.groupBy("term").agg(F.sum("tf").alias("_n"), F.count(F.lit(1)).alias("df"))
        .orderBy(F.col("_n").desc(), "term").limit(max_features)
    )
    # bounded: max_features rows, numbered in term order
    listed = top.agg(F.sort_array(F.collect_list(F.struct("term", "df"))).alias("v"))
    return listed.select(F.posexplode("v").alias("term_idx", "t")).select("t.term", "term_idx", "t.df")


def tfidf(terms: DataFrame, n_docs: DataFrame, key: str, vocab: DataFrame) -> DataFrame:
    """``(key, term, term_idx, weight)``: tf · (ln((1+n)/(1+df)) + 1), scaled to unit length per document.

    ``n_docs`` is a one-row count. Norms are summed by key and joined back;
    a document has at most ``max_features`` terms.
    """
    n = n_docs.scalar()
    raw = terms.join(F.broadcast(vocab), "term").select(
        key, "term", "term_idx", (F.col("tf") * (F.ln((F.lit(1) + n) / (F.lit(1) + F.col("df"))) + 1)).alias("w"))
    # terms of one document as one bounded array: the norm needs no second pass over the rows
    packed = raw.groupBy(key).agg(
        F.collect_list(F.struct("term_idx", "term", "w")).alias("ts"), F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return packed.select(key, F.explode("ts").alias("t"), "norm").select(
        key, "t.term", "t.term_idx", (F.col("t.w") / F.col("norm")).alias("weight"))


def tfidf_char(docs: DataFrame, key: str) -> DataFrame:
    """Case-kept character TF-IDF of ``docs(key, text)``; documents without terms have no row."""
    terms = materialize(char_terms(docs, key), "char_terms")
    return tfidf(terms, docs.agg(F.count(F.lit(1))), key, vocabulary(terms))


def tfidf_word_ngrams(docs: DataFrame, key: str) -> DataFrame:
    """Word 1–3-gram TF-IDF."""
    terms = materialize(word_terms(docs, key), "word_terms")
    return tfidf(terms, docs.agg(F.count(F.lit(1))), key, vocabulary(terms))


# ------------------------------------------------------------------ projections
FAN_IN = 16


def _packed(total: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([total[np.triu_indices(len(total))].tobytes()], pa.binary())], ["g"])


def _outer_products(size: int):
    """Sum of the outer products of a task's rows, as one packed upper triangle; a row costs the square of its own terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            rows = batch.column("r")
            terms, weights = (rows.values.field(i).to_numpy() for i in (0, 1))
            for start, end in itertools.pairwise(rows.offsets.to_numpy()):
                t, w = terms[start:end], weights[start:end]
                total[np.ix_(t, t)] += np.outer(w, w)
        yield _packed(total)

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        for g in batch.column("g"):
            part = np.frombuffer(g.as_py())
            total = part.copy() if total is None else total + part
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["g"])


def gram(weights: DataFrame, key: str, size: int) -> np.ndarray:
    """Σ x·xᵀ over the documents' sparse rows (``size`` is at most ``max_features``).

    Tasks add up their rows, and a tree of tasks adds up their sums, ``FAN_IN`` at a
    time; the driver gets that many triangles at most.
    """
    rows = weights.groupBy(key).agg(F.collect_list(F.struct("term_idx", "weight")).alias("r")).select("r")
    parts = materialize(rows.mapInArrow(_outer_products(size), "g binary"), "gram")
    while (n := parts.count()) > FAN_IN:
        parts = materialize(parts.repartition(math.ceil(n / FAN_IN)).mapInArrow(_added, "g binary"), "gram")
    upper = np.zeros((size, size))
    for row in parts.collect():
        upper[np.triu_indices(size)] += np.frombuffer(row["g"])
    return upper + np.triu(upper, 1).T


def _project(weights: DataFrame, keys: DataFrame, key: str, loadings: np.ndarray, offset: np.ndarray) -> DataFrame:
    """Σ weight · loading per document; ``loadings`` has at most ``max_features`` rows, one column where there is one term."""
    if loadings.shape[1] < 2:
        loadings, offset = np.hstack([loadings, np.zeros_like(loadings)]), np.append(offset, 0.0)
    spark = weights.sparkSession
    table = spark.createDataFrame(
        [(i, float(r[0]), float(r[1])) for i, r in enumerate(loadings)], "term_idx int, l1 double, l2 double")
    sums = weights.join(F.broadcast(table), "term_idx").groupBy(key).agg(
        F.sum(F.col("weight") * F.col("l1")).alias("s1"), F.sum(F.col("weight") * F.col("l2")).alias("s2"))
    return keys.select(key).distinct().join(sums, key, "left").select(
        key,
        (F.coalesce("s1", F.lit(0.0)) - F.lit(float(offset[0]))).alias("x"),
        (F.coalesce("s2", F.lit(0.0)) - F.lit(float(offset[1]))).alias("y"))


def _fix_signs(loadings: np.ndarray) -> np.ndarray:
    """A component's sign is arbitrary: make its largest loading positive."""
    top = np.abs(loadings).argmax(axis=0)
    return loadings * np.where(loadings[top, range(loadings.shape[1])] < 0, -1.0, 1.0)


def _size(weights: DataFrame) -> int:
    return (weights.agg(F.max("term_idx")).collect()[0][0] or 0) + 1


def _leading(matrix: np.ndarray) -> np.ndarray:
    return _fix_signs(np.linalg.eigh(matrix)[1][:, :-3:-1])


def pca_2d(weights: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Centred 2-D projection ``(key, x, y)`` of ``weights(key, term_idx, weight)`` for all ``keys``.

    The Gram matrix (at most 1024²) is summed by the tasks and centred afterwards;
    documents are projected with a broadcast table of loadings, so vectors never
    reach the driver. Documents without weights count as zero vectors.
    """
    size = _size(weights)
    n_docs = keys.select(key).distinct().count()
    mean = np.zeros(size)
    for idx, total in weights.groupBy("term_idx").agg(F.sum("weight")).collect():  # at most max_features rows
        mean[idx] = total / max(n_docs, 1)
    loadings = _leading(gram(weights, key, size) - n_docs * np.outer(mean, mean))
    return _project(weights, keys, key, loadings, mean @ loadings)


def svd_2d(weights: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Uncentred truncated-SVD projection ``(key, x, y)``: the Gram matrix's leading eigenvectors are the right singular vectors."""
    return _project(weights, keys, key, _leading(gram(weights, key, _size(weights))), np.zeros(2))
