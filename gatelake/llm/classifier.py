"""Quality classifier by co-training on two views of a document.

The text view sees the words and the shape of the text; the metadata view sees
source, language and length. Both start from the labelled rows; in each round a
view scores all unlabelled documents and passes those it is sure of, with their
labels, to the other, unless that one is sure of the opposite.
A calibration on held-out labelled rows then weighs the two, and every document
is scored. A document is good when it is labelled of quality and not toxic.

A fit takes bounded samples, picked by hash: of the labelled rows (``labelled_rows``)
and, after all were scored, of those pseudo-labelled for a view (``pseudo_rows``).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gatelake.llm.common import free_names
from gatelake.session import materialize

LABELLED_ROWS = 12_000
PSEUDO_ROWS = 6_000
ROUNDS = 3
CONFIDENT = 0.97
PSEUDO_WEIGHT = 0.1  # of all pseudo-labelled rows, against all labelled ones, at most
TEXT_TERMS = 200
META_BUCKETS = 512

_WORD = re.compile(rb"[a-z0-9\x80-\xff]+")
_SHAPE = ("symbols", "upper", "bars", "shouts", "repeats", "digits", "word_length", "same_lines", "short")


def _terms(low: bytes) -> np.ndarray:
    found = set(_WORD.findall(low))
    return np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))


def _shape(raw: bytes, low: bytes) -> list[float]:
    """Rates that describe a text whatever its words; all are 0 to about 1."""
    tokens, size = low.split(), max(1, len(raw))
    n = max(1, len(tokens))
    lines = [x for x in low.split(b"\n") if x.strip()]
    symbols = size - len(raw.translate(None, b"#*$%&<>{}\\^~"))
    upper = size - len(raw.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    digits = size - len(raw.translate(None, b"0123456789"))
    return [
        min(1.0, symbols / n), upper / size, min(1.0, raw.count(b"|") / n), min(1.0, raw.count(b"!") / n),
        1 - len(set(zip(tokens, tokens[1:], tokens[2:]))) / max(1, len(tokens) - 2) if len(tokens) > 2 else 0.0,
        digits / size, min(1.0, len(b"".join(tokens)) / n / 20), 1 - len(set(lines)) / max(1, len(lines)) if lines else 0.0,
        float(len(tokens) < 20),
    ]


def _meta(source, lang, n_chars) -> list[int]:
    length = -1 if n_chars is None or n_chars != n_chars else int(np.log2(1 + max(0, n_chars)))
    parts = (f"s={source}", f"l={lang}", f"n={length}", f"sl={source}|{lang}")
    return [xxhash.xxh3_64_intdigest(p.encode()) % META_BUCKETS for p in parts]


def _clean(v):
    return None if v is None or v != v else v


def _batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        raws = [("" if x is None else x).encode() for x in b["text"]]
        yield pd.DataFrame({
            "y": b["y"].astype("float64"),
            "terms": [_terms(r.lower()).tobytes() for r in raws],
            "shape": [np.array(_shape(r, r.lower())).tobytes() for r in raws],
            "meta": [np.array(_meta(_clean(s), _clean(g), n), np.int64).tobytes() for s, g, n in zip(b["source"], b["lang"], b["n_chars"])],
        })


@dataclass
class Model:
    """Weights of both views and of their combination; a few thousand numbers."""

    terms: dict[int, float]
    shape: np.ndarray
    text_bias: float
    meta: np.ndarray
    mix: np.ndarray


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray | float = 1.0, l2: float = 0.1, steps: int = 25) -> np.ndarray:
    """Ridge logistic regression with an unpenalised bias (last weight), by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))]).astype(np.float64)
    w, ridge = np.zeros(x.shape[1]), np.full(x.shape[1], l2)
    ridge[-1] = 1e-6
    for _ in range(steps):
        p = _sigmoid(x @ w)
        grad = x.T @ (weight * (p - y)) + ridge * w
        hess = (x * (weight * (p * (1 - p) + 1e-6))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-4:
            break
    return w


def _choose_terms(docs: list[np.ndarray], y: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` terms in at least three documents whose presence tells most about ``y``."""
    if not docs:
        return np.zeros(0, np.uint64)
    flat = np.concatenate(docs)
    terms, inverse, df = np.unique(flat, return_inverse=True, return_counts=True)
    good = np.bincount(inverse, weights=np.repeat(y, [len(d) for d in docs]), minlength=len(terms))
    n, pos = len(y), y.sum()
    expected = df * pos / n
    chi = (good - expected) ** 2 * (1 / np.maximum(expected, 1e-9) + 1 / np.maximum(df - expected, 1e-9))
    chi[df < 3] = 0
    best = np.lexsort((terms, -chi))[:k]
    return np.sort(terms[best[chi[best] > 0]])


def _present(docs: list[np.ndarray], terms: np.ndarray) -> np.ndarray:
    x = np.zeros((len(docs), len(terms)), np.float32)
    if len(terms):
        for i, d in enumerate(docs):
            at = np.minimum(np.searchsorted(terms, d), len(terms) - 1)
            x[i, at[terms[at] == d]] = 1
    return x


def _weights(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights of all columns and the bias; columns that no row has get none."""
    cols = np.flatnonzero(x.any(axis=0))
    w = _logistic(x[:, cols], y, weight)
    out = np.zeros(x.shape[1] + 1)
    out[cols], out[-1] = w[:-1], w[-1]
    return out


def _truth(labels: DataFrame) -> DataFrame:
    return labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.min(F.when((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0), 1.0).otherwise(0.0)).alias("y")
    )


def sample(docs: DataFrame, labels: DataFrame, labelled_rows: int) -> pd.DataFrame:
    """Features of the labelled sample."""
    mark = F.xxhash64(F.lit("sample"), F.col("doc_id"))
    ids = docs.where("doc_id is not null").select("doc_id").distinct().join(_truth(labels), "doc_id").withColumn("o", mark)
    top = ids.orderBy("o", "doc_id").limit(labelled_rows)
    rows = docs.join(F.broadcast(top), "doc_id").dropDuplicates(["doc_id"])
    packed = rows.select("y", "text", "source", "lang", "n_chars").mapInPandas(
        _batches, "y double, terms binary, shape binary, meta binary"
    )
    return packed.toPandas()


def pool(docs: DataFrame, labels: DataFrame, chosen: np.ndarray) -> DataFrame:
    """Features of every document without a label, written once: the presence of the ``chosen`` terms as bits, shape and metadata."""
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for at in range(0, len(whole), 1000):
                b = whole.iloc[at : at + 1000]
                f = next(_batches(iter([b.assign(y=0.0)])))
                here = _present([np.frombuffer(x, np.uint64) for x in f["terms"]], chosen)
                yield pd.DataFrame({
                    "doc_id": b["doc_id"].array, "o": b["o"].array, "terms": [np.packbits(x > 0).tobytes() for x in here],
                    "shape": f["shape"], "meta": f["meta"],
                })

    got = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.xxhash64(F.lit("sample"), "doc_id", "text").alias("o"), "text", "source", "lang", "n_chars")
    packed = got.mapInPandas(pack, "doc_id string, o long, terms binary, shape binary, meta binary")
    known = _truth(labels).select(F.col("doc_id").cast("string").alias("doc_id"))
    return materialize(packed.join(known, "doc_id", "left_anti").drop("doc_id"), "pool")


def _matrices(rows: pd.DataFrame, n: int) -> dict[str, np.ndarray]:
    """Both views of rows of ``pool``, for ``n`` chosen terms."""
    text = np.zeros((len(rows), n + len(_SHAPE)), np.float32)
    meta = np.zeros((len(rows), META_BUCKETS), np.float32)
    for i, (t, s, m) in enumerate(zip(rows["terms"], rows["shape"], rows["meta"])):
        text[i, :n] = np.unpackbits(np.frombuffer(t, np.uint8), count=n)
        text[i, n:] = np.frombuffer(s) * 10
        meta[i, np.frombuffer(m, np.int64)] = 1
    return {"text": text, "meta": meta}


def pseudo_labelled(rows: DataFrame, view: str, w: dict[str, np.ndarray], n: int) -> DataFrame:
    """Of all ``rows`` of the pool, those that a view is sure of and the other not of the opposite, with the label ``y``; ``w``: weights by view."""
    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for at in range(0, len(whole), 1000):
                b = whole.iloc[at : at + 1000]
                p = {v: _sigmoid(x @ w[v][:-1] + w[v][-1]) for v, x in _matrices(b, n).items()}
                good = np.all([p[v] >= (CONFIDENT if v == view else 1 - CONFIDENT) for v in p], axis=0)
                bad = np.all([p[v] <= (1 - CONFIDENT if v == view else CONFIDENT) for v in p], axis=0)
                yield b.assign(y=good.astype(float))[good | bad]

    return rows.mapInPandas(judge, "o long, terms binary, shape binary, meta binary, y double")


def fit(docs: DataFrame, labels: DataFrame, labelled_rows: int = LABELLED_ROWS, pseudo_rows: int = PSEUDO_ROWS,
        rounds: int = ROUNDS, terms: int = TEXT_TERMS) -> Model:
    """Co-trains both views; with no labelled rows, or only one class, every document scores as that class (good if none)."""
    data = sample(docs, labels, labelled_rows)
    data = data.sort_values(["terms", "shape", "meta"], ignore_index=True)  # the order of arrival must not matter
    words = [np.frombuffer(b, np.uint64) for b in data["terms"]]
    shape = np.array([np.frombuffer(b) for b in data["shape"]]).reshape(len(data), len(_SHAPE))
    meta = np.zeros((len(data), META_BUCKETS), np.float32)
    for i, b in enumerate(data["meta"]):
        meta[i, np.frombuffer(b, np.int64)] = 1
    y = data["y"].to_numpy(float)
    known = np.arange(len(y))
    held = known[known % 5 == 0]
    base = np.setdiff1d(known, held)
    if len(set(y[base])) < 2 or len(held) < 5:
        bias = 8.0 if not len(known) or y[known].mean() >= 0.5 else -8.0
        return Model({}, np.zeros(len(_SHAPE)), bias, np.zeros(META_BUCKETS), np.array([1.0, 0.0, 0.0]))
    chosen = _choose_terms([words[i] for i in base], y[base], terms)
    text = np.hstack([_present(words, chosen), shape * 10]).astype(np.float32)
    del words, data
    own, n = {"text": text, "meta": meta}, len(chosen)
    rest = pool(docs, labels, chosen)
    given = {view: (x[:0], np.zeros(0)) for view, x in own.items()}  # rows and labels, as taught by the other view
    for r in range(rounds + 1):
        w = {}
        for view, x in own.items():
            more, taught = given[view]
            weight = np.repeat([1.0, min(1.0, PSEUDO_WEIGHT * len(base) / max(1, len(more)))], [len(base), len(more)])
            w[view] = _weights(np.vstack([x[base], more]), np.concatenate([y[base], taught]), weight)
        if r == rounds:
            break
        for view, other in (("text", "meta"), ("meta", "text")):
            sure = pseudo_labelled(rest, view, w, n).orderBy("o", "terms", "shape", "meta").limit(pseudo_rows).toPandas()
            given[other] = (_matrices(sure, n)[other], sure["y"].to_numpy(float))
    both = np.column_stack([x @ w[view][:-1] + w[view][-1] for view, x in own.items()])
    mix = _logistic(both[held], y[held])
    t, m = w["text"], w["meta"]
    full = m[:-1] + m[-1] / 4  # each document has four metadata features
    return Model(dict(zip(chosen.tolist(), t[:n].tolist())), t[n:-1] * 10, float(t[-1]), full, mix)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``p_text``, ``p_meta``, ``score`` (probability of good) and ``keep``.

    A null text is scored as an empty one, null metadata as values of their own;
    an empty table gives no rows. Repeated rows score alike and texts are read whole.
    Columns of ``docs`` with those names are replaced, others may have any names.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = ("p_text", "p_meta", "score", "keep")
    kept = [c for c in docs.columns if c not in names]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                b = whole.slice(at, 256)
                text, source, lang, chars = (b.column(len(kept) + j).to_pylist() for j in range(4))
                t, a = np.empty(b.num_rows), np.empty(b.num_rows)
                for i, raw in enumerate(("" if x is None else x).encode() for x in text):
                    low = raw.lower()
                    hits = [m.terms.get(xxhash.xxh3_64_intdigest(w), 0.0) for w in set(_WORD.findall(low))]
                    t[i] = sum(sorted(h for h in hits if h)) + float(np.dot(m.shape, _shape(raw, low))) + m.text_bias
                    a[i] = sum({j: m.meta[j] for j in _meta(source[i], lang[i], chars[i])}.values())
                p = _sigmoid(m.mix[0] * t + m.mix[1] * a + m.mix[2])
                scores = [pa.array(x) for x in (_sigmoid(t), _sigmoid(a), p, p >= 0.5)]
                yield pa.RecordBatch.from_arrays([*b.columns[: len(kept)], *scores], names=[*kept, *names])

    schema = T.StructType([*docs.select(*kept).schema, *(T.StructField(n, T.DoubleType()) for n in names[:3]), T.StructField("keep", T.BooleanType())])
    text, source, lang, n = free_names(docs, "_text", "_source", "_lang", "_n")
    return docs.select(
        *kept, F.col("text").alias(text), F.col("source").alias(source), F.col("lang").alias(lang),
        F.col("n_chars").cast("double").alias(n),
    ).mapInArrow(apply, schema)
