"""Hierarchical best-fit packing of tokenised documents into sequences of bounded length.

Every task tokenises its documents, cuts longer ones and packs what is left by
best fit. Nearly full sequences are written as they are; underfull ones go up a
tree as items of the next round, in as many tasks as their bytes ask for, until
one task holds them all or nothing fits together any more.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterable, Iterator
from itertools import chain
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gatelake.session import materialize

CAPACITY = 2048
SLACK = 8  # a sequence with fewer free places is finished
BUFFER_BYTES = 64 << 20  # ids that a task holds while it packs
BATCH_BYTES = 8 << 20
CHUNK_CHARS = 1 << 20
# white space of the pre-tokenizer's pattern, fixed values; a token never goes on over a blank behind anything else
_WHITE = "\\t-\\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_BLANK = re.compile(f"(?<=[^{_WHITE}])\x20")
BPE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

Member = tuple[Any, int, int, bytes]  # doc_id, piece, start, ids
Item = tuple[int, list[Member]]


# ------------------------------------------------------------------ tokens
def _byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable Latin-1 as is, others from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Encoder:
    """Token ids of a text by a tokenizer file, equal to the tokenizers library's without special tokens added.

    A byte-level BPE whose merges are in id order is run by tiktoken over the same
    vocabulary, several times faster; other files, and texts that hold one of the
    file's added tokens, are encoded by the library itself.
    """

    def __init__(self, source: str):
        from tokenizers import Tokenizer

        self._library, spec = Tokenizer.from_str(source), json.loads(source)
        self._added = [t["content"] for t in spec.get("added_tokens") or []]
        self._fast = self._build(spec)

    @staticmethod
    def _build(spec: dict):
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        plain = model["type"] == "BPE" and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre["add_prefix_space"]
        if not plain or spec.get("normalizer") or any(model.get(k) for k in ("dropout", "ignore_merges", "byte_fallback", "end_of_word_suffix", "continuing_subword_prefix")):
            return None
        vocab, letters = model["vocab"], _byte_letters()
        merged = [vocab.get("".join(m) if isinstance(m, list) else m.replace(" ", "")) for m in model["merges"]]
        if None in merged or any(a >= b for a, b in zip(merged, merged[1:])) or any(set(t) - letters.keys() for t in vocab):
            return None
        import tiktoken

        ranks = {bytes(letters[c] for c in t): i for t, i in vocab.items()}
        if len(merged) + 256 != len(ranks) or any(bytes([b]) not in ranks for b in range(256)):
            return None
        return tiktoken.Encoding("file", pat_str=BPE_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _part(self, text: str) -> np.ndarray:
        if self._fast is None or any(t in text for t in self._added):
            return np.array(self._library.encode(text, add_special_tokens=False).ids, "<u4")
        return np.array(self._fast.encode_ordinary(text), "<u4")

    def encode(self, text: str) -> np.ndarray:
        """Long texts are encoded in parts that end before a blank behind a word, where a token ends in any case."""
        if len(text) <= CHUNK_CHARS or self._fast is None or any(t in text for t in self._added):
            return self._part(text)
        parts, at = [], 0
        while at < len(text):
            blank = _BLANK.search(text, at + CHUNK_CHARS)
            end = blank.start() if blank else len(text)
            parts.append(self._part(text[at:end]))
            at = end
        return np.concatenate(parts)


def cut(ids: bytes, capacity: int) -> list[tuple[int, int, bytes]]:
    """Pieces ``(piece, start, ids)``: of full length behind a first one that may be shorter."""
    n = len(ids) // 4
    first = n % capacity or min(n, capacity)
    starts = [0, *range(first, n, capacity)]
    return [(i, a, ids[4 * a:4 * b]) for i, (a, b) in enumerate(zip(starts, [*starts[1:], n]))]


# ------------------------------------------------------------------ one round
def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins of item numbers: largest items first, each into the smallest gap that takes it.

    Bins stand in lists by their gap; a bit per gap finds the smallest one, so a
    round is linear in the items.
    """
    bins: list[list[int]] = []
    by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_gaps = 0
    for i in sorted(range(len(sizes)), key=sizes.__getitem__, reverse=True):
        fits = open_gaps >> sizes[i]
        if fits:
            gap = sizes[i] + (fits & -fits).bit_length() - 1
            b = by_gap[gap].pop()
            if not by_gap[gap]:
                open_gaps ^= 1 << gap
        else:
            b, gap = len(bins), capacity
            bins.append([])
        bins[b].append(i)
        gap -= sizes[i]
        if gap:
            by_gap[gap].append(b)
            open_gaps |= 1 << gap
    return bins


def _merge(items: list[Item], capacity: int) -> list[Item]:
    return [(sum(items[i][0] for i in b), [m for i in b for m in items[i][1]]) for b in best_fit([i[0] for i in items], capacity)]


def _round(items: Iterable[Item], capacity: int, slack: int) -> Iterator[tuple[bool, Item]]:
    """Packs a stream of items in bounded memory: ``(finished, bin)``."""
    held, size = [], 0
    for item in items:
        if capacity - item[0] < slack:
            yield True, item
            continue
        held.append(item)
        size += 4 * item[0]
        if size >= BUFFER_BYTES:
            packed = _merge(held, capacity)
            yield from ((True, b) for b in packed if capacity - b[0] < slack)
            held = [b for b in packed if capacity - b[0] >= slack]
            size = 4 * sum(b[0] for b in held)
            if 2 * size > BUFFER_BYTES:  # nothing fits here: others may take them in the next round
                yield from ((False, b) for b in held)
                held, size = [], 0
    yield from ((capacity - b[0] < slack, b) for b in _merge(held, capacity))


def _schema(id_type: T.DataType) -> T.StructType:
    member = T.StructType([
        T.StructField("doc_id", id_type), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("ids", T.BinaryType())])
    return T.StructType([
        T.StructField("sequence_id", T.LongType()), T.StructField("finished", T.BooleanType()), T.StructField("load", T.IntegerType()),
        T.StructField("members", T.ArrayType(member))])


def _batches(bins: Iterator[tuple[bool, Item]], id_type: pa.DataType, depth: int) -> Iterator[pa.RecordBatch]:
    """Arrow batches of bins; a sequence's number says round, task and place in the task."""
    number = (depth << 56) + (TaskContext.get().partitionId() << 32)
    done, size = [], 0
    for done_bin in chain(bins, [None]):
        if done_bin is not None:
            done.append(done_bin)
            size += 4 * done_bin[1][0]
        if done and (done_bin is None or size >= BATCH_BYTES):
            docs, piece, start, ids = zip(*(m for _, (_, ms) in done for m in ms))
            members = pa.StructArray.from_arrays(
                [pa.array(docs, id_type), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(ids, pa.binary())], ["doc_id", "piece", "start", "ids"])
            offsets = np.cumsum([0, *(len(ms) for _, (_, ms) in done)]).astype("i4")
            yield pa.RecordBatch.from_arrays([
                pa.array(range(number, number + len(done)), pa.int64()), pa.array([f for f, _ in done], pa.bool_()), pa.array([b[0] for _, b in done], pa.int32()),
                pa.ListArray.from_arrays(offsets, members)], ["sequence_id", "finished", "load", "members"])
            number += len(done)
            done, size = [], 0


def _first_round(source: str, end_id: int, capacity: int, slack: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = Encoder(source), np.array([end_id], "<u4").tobytes()
        first = next(batches, None)
        if first is None:
            return
        id_type = first.schema.field("doc_id").type

        def items() -> Iterator[Item]:
            for batch in chain([first], batches):
                ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
                for doc_id, text in zip(ids, texts):
                    coded = encoder.encode(text.as_py() or "").tobytes() + end
                    for piece, start, part in cut(coded, capacity):
                        yield len(part) // 4, [(doc_id, piece, start, part)]

        yield from _batches(_round(items(), capacity, slack), id_type, 0)

    return run


def _next_round(depth: int, capacity: int, slack: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return
        id_type = first.schema.field("members").type.value_type.field("doc_id").type

        def items() -> Iterator[Item]:
            for batch in chain([first], batches):
                for load, members in zip(batch.column("load").to_pylist(), batch.column("members")):
                    yield load, [tuple(m.values()) for m in members.as_py()]

        yield from _batches(_round(items(), capacity, slack), id_type, depth)

    return run


# ------------------------------------------------------------------ the operator
def pack(docs: DataFrame, source: str, *, end_id: int = 0, capacity: int = CAPACITY, slack: int = SLACK) -> DataFrame:
    """``(sequence_id, finished, load, members array<struct<doc_id, piece, start, ids>>)``: one row per sequence.

    ``docs`` has ``doc_id`` (any type) and ``text``; ``source`` is the content of a
    tokenizer file. A document is its ids and ``end_id``; one longer than
    ``capacity`` is cut into pieces of that length, the first of which may be
    shorter. ``ids`` are little-endian unsigned 32-bit numbers in sequence order.

    Rounds end when all sequences are finished, when one task has packed all that
    was left, or when a round joined fewer than one in fifty of its items. A
    sequence that the smallest open one would overfill is finished at once, so
    corpora whose documents never fit together do not go through the rounds.

    Every row is one document: repeated rows and null ids are packed each by
    itself. A null or empty text is its ``end_id`` alone. Other columns are ignored
    whatever their names. An empty table gives no sequences. Long texts are encoded
    in parts and held as ids of one document; ties between equal gaps go to the
    bin opened or filled last. Any number of documents of any length gives
    sequences whose members have no gaps between them.
    """
    if not 0 <= end_id < 1 << 32 or capacity < 1:
        raise ValueError("end_id is an unsigned 32-bit number, capacity is 1 or more")
    schema = _schema(docs.schema["doc_id"].dataType)
    bins = materialize(docs.select("doc_id", "text").mapInArrow(_first_round(source, end_id, capacity, slack), schema), "packed", apart="finished")
    done, depth = [bins.where("finished")], 0
    still = bins.where("not finished")
    while True:
        n, total, least = still.agg(F.count(F.lit(1)), F.sum("load"), F.min("load")).first()
        if not n:
            break
        depth += 1
        done.append(still.where(F.col("load") > capacity - least))
        still = still.where(F.col("load") <= capacity - least)
        tasks = max(1, math.ceil(4 * total / BUFFER_BYTES))
        merged = materialize(still.coalesce(tasks).mapInArrow(_next_round(depth, capacity, slack), schema), "packed", apart="finished")
        left = merged.where("not finished").count()
        if tasks == 1 or left > 0.98 * n:
            done.append(merged)
            break
        done.append(merged.where("finished"))
        still = merged.where("not finished")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def pieces(packed: DataFrame) -> DataFrame:
    """``(doc_id, piece, start, length, ids, sequence_id, offset)``: one row per piece of ``pack``'s sequences; ``offset`` is its place."""
    lengths = F.transform("members", lambda m: (F.octet_length(m["ids"]) / 4).cast("bigint"))
    offsets = F.transform("members", lambda _, i: F.aggregate(F.slice("lengths", F.lit(1), i), F.lit(0).cast("bigint"), lambda a, x: a + x))
    return packed.withColumn("lengths", lengths).select(
        "sequence_id", F.explode(F.arrays_zip("members", "lengths", offsets.alias("offsets"))).alias("m")).select(
        "m.members.doc_id", "m.members.piece", "m.members.start", F.col("m.lengths").alias("length"), "m.members.ids", "sequence_id", F.col("m.offsets").alias("offset"))


def sequence_ids() -> Column:
    """The ids of a whole sequence of ``pack``, as one binary value."""
    return F.aggregate("members", F.lit(b""), lambda a, m: F.concat(a, m["ids"]))
