"""Interpolated modified Kneser-Ney language model in sorted hash arrays.

Counting: words come first; a word's number is its place in the sorted array of
all training words. Then every task counts the n-grams of its documents as rows of
word numbers, deals them by hash into shards and sends one packed block per shard,
and a shard's task merges its blocks. From the distinct n-grams of one order come
the continuation counts of the next lower order (number of left neighbours) and
the statistics of their contexts (sum of counts, how many followers were seen once,
twice, more often), each dealt again by its own hash, so no task sees more than its
shard. All orders run in one plan; only packed blocks are shuffled.

Storage: each shard writes sorted arrays of 64-bit hashes and their values to the
shared folder, complete before they get their final name, so a repeated task
writes the same file. Workers memory-map the shards and look up sorted batches of
queries; pages are read on demand and belong to the page cache.

The shared folder must be a mounted path (``file:``) on all machines.
"""

from __future__ import annotations

import itertools
import os
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gatelake.llm.common import free_names
from gatelake.session import shared_dir

ORDER = 2
SHARD_BYTES = 8 << 20  # text per shard
HELD = 10  # one document in so many is held out

_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
END = np.uint64(0xE0D0E0D0E0D0E0D1)

def tokens(text: str | None) -> np.ndarray:
    """Hashes of the lower-cased words of a text and of its end."""
    found = ("" if text is None else text).encode().lower().split()
    out = np.empty(len(found) + 1, np.uint64)
    out[:-1] = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    out[-1] = END
    return out


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


def gram_hash(columns: np.ndarray) -> np.ndarray:
    """One hash per row of numbers (shape rows x length); without collisions for single numbers."""
    acc = np.full(len(columns), columns.shape[1], np.uint64)
    for i in range(columns.shape[1]):
        acc = _mix(acc * _M1 + columns[:, i])
    return acc


def grams(numbers: np.ndarray, order: int, start: int) -> np.ndarray:
    """Rows of ``order`` word numbers, one per token; ``start`` stands before the first word."""
    padded = np.concatenate([np.full(order - 1, start, np.uint64), numbers])
    return np.lib.stride_tricks.sliding_window_view(padded, order)


def _summed(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct rows in order of their hash, the sums of their values (shape rows x k), and the hashes."""
    h = gram_hash(rows)
    order = np.argsort(h, kind="stable")
    h = h[order]
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
    return rows[order[first]], np.add.reduceat(values[order], first, axis=0) if len(h) else values, h[first]


def _planes(x: np.ndarray) -> bytes:
    """Bytes of like weight together, which compresses small numbers to little."""
    return np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1).T.tobytes()


def _pack(rows: np.ndarray, values: np.ndarray) -> bytes:
    order = np.lexsort(rows.T[::-1])
    rows, values = rows[order], values[order].astype(np.int64)
    first = np.diff(rows[:, 0], prepend=np.uint64(0))
    parts = [np.array([*rows.shape, values.shape[1]], np.int64).tobytes(), _planes(first)]
    parts += [_planes(rows[:, i].copy()) for i in range(1, rows.shape[1])] + [_planes(values[:, i].copy()) for i in range(values.shape[1])]
    return zlib.compress(b"".join(parts), 3)


def _unpack(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = zlib.decompress(raw)
    n, k, m = np.frombuffer(raw, np.int64, 3).tolist()
    columns = [np.frombuffer(raw, np.uint8, 8 * n, 24 + 8 * n * i).reshape(8, n).T.copy().view(np.uint64)[:, 0] for i in range(k + m)]
    columns[0] = np.cumsum(columns[0], dtype=np.uint64)
    return np.column_stack(columns[:k]), np.column_stack(columns[k:]).view(np.int64)


def _shard(h: np.ndarray, shards: int) -> np.ndarray:
    return (h >> np.uint64(32)) % np.uint64(shards)


def _dealt(rows: np.ndarray, values: np.ndarray, h: np.ndarray, shards: int, what: str) -> Iterator[dict]:
    to = _shard(h, shards)
    order = np.argsort(to, kind="stable")
    edges = np.searchsorted(to[order], np.arange(shards + 1, dtype=np.uint64))
    for s in range(shards):
        part = order[edges[s] : edges[s + 1]]
        if len(part):
            yield {"what": what, "shard": s, "block": _pack(rows[part], values[part])}


_KINDS = {"what": pa.string(), "shard": pa.int32(), "block": pa.binary()}
_BLOCKS = "what string, shard int, block binary"


def _counted(docs: DataFrame, what: str, shards: int, count, limit: int = 2_000_000) -> DataFrame:
    """Blocks from tokens; a task holds up to ``limit`` tokens at a time. ``count`` gives a function from token lists to rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, rows_of = [], 0, count()

        def flush():
            rows = rows_of(held)
            got = list(_dealt(*_summed(rows, np.ones((len(rows), 1), np.int64)), shards, what))
            return pa.RecordBatch.from_arrays([pa.array([r[c] for r in got], t) for c, t in _KINDS.items()], names=list(_KINDS))

        for b in batches:
            for at in range(0, b.num_rows, 256):
                for text in b.column(0).slice(at, 256).to_pylist():
                    held.append(tokens(text))
                    size += len(held[-1])
                    if size > limit:
                        yield flush()
                        held, size = [], 0
        if held:
            yield flush()

    return docs.select("text").mapInArrow(run, _BLOCKS)


def _merged(group: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    blocks = [_unpack(b) for b in group["block"]]
    return _summed(np.concatenate([r for r, _ in blocks]), np.concatenate([v for _, v in blocks]))


def _save(folder: str, name: str, shard: int, hashes: np.ndarray, values: np.ndarray) -> None:
    for kind, data in (("h", hashes), ("v", values)):
        path = f"{folder}/{name}-{shard}.{kind}"
        part = f"{path}.{uuid.uuid4().hex}"
        with open(part, "wb") as f:
            f.write(np.ascontiguousarray(data).tobytes())
        os.replace(part, path)


def _narrow(values: np.ndarray) -> np.ndarray:
    return np.minimum(values, np.iinfo(np.uint32).max).astype(np.uint32)


_STATS = ("n1", "n2", "n3", "n4", "rows", "total")
_LEVEL = f"{_BLOCKS}, level int, " + ", ".join(f"{c} bigint" for c in _STATS)


def _words(docs: DataFrame, shards: int, folder: str) -> list:
    """Writes the sorted words with their counts; gives ``shard, rows, total``."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        _, values, h = _merged(group)
        shard = int(group["shard"].iloc[0])
        _save(folder, "w", shard, h, _narrow(values))
        return pd.DataFrame([{"shard": shard, "rows": len(h), "total": int(values.sum())}])

    def count():
        return lambda held: np.concatenate(held)[:, None]

    blocks = _counted(docs, "word", shards, count)
    by_word = blocks.groupBy("shard").applyInPandas(run, "shard int, rows bigint, total bigint")
    return by_word.collect()  # one row per shard


def _level(blocks: DataFrame, order: int, shards: int, folder: str) -> DataFrame:
    """Merges and writes one order's counts and the contexts found by the order above; passes on finished figures.

    Gives the counts of counts of this order, and blocks of the next lower order and of this order's contexts.
    """

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        what, shard = key
        columns = ["what", "shard", "block", "level", *_STATS]
        if what == "stats":
            return group[columns]
        shard = int(shard)
        rows, values, h = _merged(group)
        if what == "context":
            _save(folder, f"c{order + 1}", shard, h, _narrow(values))
            return pd.DataFrame([], columns=columns)
        count, out = values[:, 0], []
        _save(folder, f"g{order}", shard, h, _narrow(count))
        if order > 1:
            out += _dealt(*_summed(rows[:, 1:], np.ones((len(rows), 1), np.int64)), shards, "gram")
            stats = np.column_stack([count, count == 1, count == 2, count >= 3]).astype(np.int64)
            out += _dealt(*_summed(rows[:, :-1], stats), shards, "context")
        own = {f"n{i}": int((count == i).sum()) for i in range(1, 5)} | {"rows": len(rows), "total": int(count.sum())}
        return pd.DataFrame([{"what": "stats", "shard": shard, "level": order, **own}, *out], columns=columns)

    return blocks.groupBy("what", "shard").applyInPandas(run, _LEVEL)


@dataclass
class Model:
    """Where the arrays are, and the few numbers that are not in them."""

    folder: str
    order: int
    shards: int
    discounts: dict[int, tuple[float, float, float]]  # by order
    unigrams: int  # sum of the continuation counts
    free: float  # share of it that discounting sets free
    vocabulary: int  # distinct training tokens
    train_tokens: int
    offsets: tuple[int, ...]  # number of the first word of each shard


def discounts(n1: float, n2: float, n3: float, n4: float) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts for counts of 1, 2 and more; halves where the corpus is too small to tell."""
    if not (n1 and n2):
        return 0.5, 0.5, 0.5
    y = n1 / (n1 + 2 * n2)
    found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 0.5)
    return tuple(float(min(max(d, 0.0), i)) for i, d in enumerate(found, 1))


def fit(docs: DataFrame, order: int = ORDER, shard_bytes: int = SHARD_BYTES) -> Model:
    """Counts all of ``docs``; null texts are empty ones, which still have an end. Needs an order of 2 or more."""
    if order < 2:
        raise ValueError("order")
    spark = docs.sparkSession
    root = shared_dir(spark)
    if not root.startswith(("file:", "/")):
        raise ValueError(f"memory-mapped arrays need a mounted folder, not {root}")
    folder = root.removeprefix("file://") + f"/gatelake/ngrams-{uuid.uuid4().hex}"
    os.makedirs(folder)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(4, -(-size // shard_bytes))
    words = {r["shard"]: r for r in _words(docs, shards, folder)}
    sizes = [words[i]["rows"] if i in words else 0 for i in range(shards)]
    offsets, vocabulary = tuple(itertools.accumulate([0, *sizes[:-1]])), sum(sizes)
    known = Model(folder, order, shards, {}, 0, 0.0, vocabulary, sum(r["total"] for r in words.values()), offsets)

    def count():
        arrays = Arrays(known)

        def rows_of(held: list[np.ndarray]) -> np.ndarray:
            numbers, _ = arrays.words(np.concatenate(held))
            ends = np.cumsum([len(t) for t in held])[:-1]
            return np.concatenate([grams(t, order, vocabulary + 1) for t in np.split(numbers, ends)])

        return rows_of

    level = _counted(docs, "gram", shards, count)
    level = level.select("*", F.lit(None).cast("int").alias("level"), *[F.lit(None).cast("bigint").alias(c) for c in _STATS])
    for k in range(order, 0, -1):
        level = _level(level, k, shards, folder)
    figures = level.where("what = 'stats'").groupBy("level").agg(*[F.sum(c).alias(c) for c in _STATS]).collect()  # one row per order
    found, unigrams, free = {k: (0.5, 0.5, 0.5) for k in range(1, order + 1)}, 0, 0.0
    for r in figures:
        found[r["level"]] = d = discounts(r["n1"], r["n2"], r["n3"], r["n4"])
        if r["level"] == 1:
            unigrams = r["total"]
            free = (d[0] * r["n1"] + d[1] * r["n2"] + d[2] * (r["rows"] - r["n1"] - r["n2"])) / max(1, unigrams)
    return replace(known, discounts=found, unigrams=unigrams, free=free)


class Arrays:
    """The arrays of a model as a worker sees them."""

    def __init__(self, model: Model) -> None:
        self.model, self.open = model, {}

    def _shard(self, name: str, shard: int, width: int) -> tuple[np.ndarray, np.ndarray] | None:
        if (name, shard) not in self.open:
            path = f"{self.model.folder}/{name}-{shard}"
            if not os.path.exists(f"{path}.h") or not os.path.getsize(f"{path}.h"):
                self.open[name, shard] = None
            else:
                values = np.memmap(f"{path}.v", np.uint32, "r").reshape(-1, width)
                self.open[name, shard] = np.memmap(f"{path}.h", np.uint64, "r"), values
        return self.open[name, shard]

    def find(self, name: str, hashes: np.ndarray, width: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Values, places and shards of sorted distinct ``hashes``; zeros and a place of -1 where absent."""
        out, place = np.zeros((len(hashes), width), np.int64), np.full(len(hashes), -1, np.int64)
        to = _shard(hashes, self.model.shards)
        order = np.argsort(to, kind="stable")  # within a shard the hashes stay sorted
        edges = np.searchsorted(to[order], np.arange(self.model.shards + 1, dtype=np.uint64))
        for s in np.flatnonzero(np.diff(edges)):
            held = self._shard(name, int(s), width)
            if held is None:
                continue
            rows = order[edges[s] : edges[s + 1]]
            at = np.minimum(np.searchsorted(held[0], hashes[rows]), len(held[0]) - 1)
            hit = held[0][at] == hashes[rows]
            out[rows[hit]] = held[1][at[hit]]
            place[rows[hit]] = at[hit]
        return out, place, to

    def words(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and counts of words; the number after the last for unknown ones."""
        distinct, back = np.unique(gram_hash(hashes[:, None]), return_inverse=True)
        count, place, shard = self.find("w", distinct)
        number = np.where(place < 0, self.model.vocabulary, place + np.array(self.model.offsets)[shard.astype(np.int64)])
        return number.astype(np.uint64)[back], count[back, 0]

    def probability(self, rows: np.ndarray) -> np.ndarray:
        """Interpolated probability of the last word of each row after the words before it."""
        m = self.model
        p = np.full(len(rows), 1.0 / (m.vocabulary + 1))  # one share for any unknown word
        if not m.train_tokens:
            return p
        for k in range(1, m.order + 1):
            part = rows[:, m.order - k :]
            count = self._each(f"g{k}", gram_hash(part))[:, 0]
            d = np.array([0.0, *m.discounts[k]])
            cut = d[np.minimum(count, 3)]
            if k == 1:
                p = np.maximum(count - cut, 0) / m.unigrams + m.free * p
                continue
            ctx = self._each(f"c{k}", gram_hash(part[:, :-1]), 4).astype(float)
            total = ctx[:, 0]
            free = (ctx[:, 1] * d[1] + ctx[:, 2] * d[2] + ctx[:, 3] * d[3]) / np.maximum(total, 1)
            p = np.where(total > 0, np.maximum(count - cut, 0) / np.maximum(total, 1) + free * p, p)
        return p

    def _each(self, name: str, hashes: np.ndarray, width: int = 1) -> np.ndarray:
        distinct, back = np.unique(hashes, return_inverse=True)
        return self.find(name, distinct, width)[0][back]


_OPEN: dict[str, Arrays] = {}


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``n_tokens, n_known, base_score, score`` and ``perplexity``; columns of those names are replaced.

    A null text is an empty one, of one token. Scores are log10 probabilities. Repeated
    rows score alike, texts are scored whole whatever their length, an empty table gives
    no rows, and other columns may have any names.
    """
    names = ("n_tokens", "n_known", "base_score", "score", "perplexity")
    kept = [c for c in docs.columns if c not in names]

    def some(arrays: Arrays, texts: list) -> list[pa.Array]:
        m, each = arrays.model, [tokens(t) for t in texts]
        sizes = np.array([len(t) for t in each])
        edges = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        numbers, count = arrays.words(np.concatenate(each))
        rows = np.concatenate([grams(t, m.order, m.vocabulary + 1) for t in np.split(numbers, edges[1:])])
        base = np.log10((count + 0.1) / (m.train_tokens + 0.1 * (m.vocabulary + 1)))
        full = np.log10(arrays.probability(rows))
        total = np.add.reduceat(full, edges)
        known = np.add.reduceat((count > 0).astype(np.int64), edges)
        out = [sizes.astype(np.int64), known, np.add.reduceat(base, edges), total, 10 ** (-total / sizes)]
        return [pa.array(x) for x in out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = _OPEN.setdefault(model.folder, Arrays(model))
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                made = some(arrays, part.column(len(kept)).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns[: len(kept)], *made], names=[*kept, *names])

    kinds = (T.LongType(), T.LongType(), T.DoubleType(), T.DoubleType(), T.DoubleType())
    schema = T.StructType([*docs.select(*kept).schema, *(T.StructField(n, k) for n, k in zip(names, kinds))])
    return docs.select(*kept, F.col("text").alias(*free_names(docs, "_text"))).mapInArrow(run, schema)


def judge(docs: DataFrame, order: int = ORDER, held: int = HELD) -> DataFrame:
    """Learns from all but every ``held``-th document by hash of its id and scores all; ``held_out`` and ``train_tokens`` are added.

    A null id counts as held out. An empty table gives no rows.
    """
    marked = docs.withColumn("held_out", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % held == 0, F.lit(True)))
    model = fit(marked.where(~F.col("held_out")), order)
    return score(marked, model).withColumn("train_tokens", F.lit(model.train_tokens).cast("bigint"))
