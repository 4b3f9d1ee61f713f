"""SentencePiece encoding and decoding as shortest paths through weighted transducers.

A model file is compiled into three parts: the normaliser (space to the meta
symbol, dummy prefix), the piece acceptor (a prefix table) and the byte fallback
for characters of no piece. An input is composed with them into a lattice whose
arcs are pieces, and the tropical-semiring shortest path is the encoding.

* unigram models: an arc weighs minus the piece's score;
* merge models: an arc weighs 0 where its piece may follow the piece before it,
  and infinity elsewhere. A piece may follow another if merging the two texts
  together yields exactly these two pieces; a path of such pairs is the one the
  merges produce, so exactly one path has a finite weight.

Normalisers with character maps are not supported and raise.
"""

from __future__ import annotations

import re
import struct
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPACE = "▁"
CACHED = 200_000  # encoded words kept per worker, twice; under 100 MB
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
INF = float("inf")


def _fields(raw: bytes) -> Iterator[tuple[int, object]]:
    """Numbered fields of a protocol-buffer message."""

    def varint(i: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            value |= (raw[i] & 127) << shift
            i, shift = i + 1, shift + 7
            if raw[i - 1] < 128:
                return value, i

    i = 0
    while i < len(raw):
        tag, i = varint(i)
        if tag & 7 == 0:
            value, i = varint(i)
        elif tag & 7 == 2:
            size, i = varint(i)
            value, i = raw[i : i + size], i + size
        else:
            size = 4 if tag & 7 == 5 else 8
            value, i = raw[i : i + size], i + size
        yield tag >> 3, value


class Transducer:
    """A compiled model; ``encode`` and ``decode`` are inverse up to normalisation."""

    def __init__(self, raw: bytes) -> None:
        pieces, trainer, norm = [], {}, {}
        for k, v in _fields(raw):
            if k == 1:
                pieces.append(dict(_fields(v)))
            elif k in (2, 3):
                (trainer if k == 2 else norm).update(_fields(v))
        if norm.get(2):
            raise ValueError("models with a character map are not supported")
        self.merges = trainer.get(3, 1) == 2
        self.dummy, self.squeeze = bool(norm.get(3, 1)), bool(norm.get(4, 1))
        self.text = [p[1].decode() for p in pieces]
        self.score = [struct.unpack("<f", p[2])[0] if 2 in p else 0.0 for p in pieces]
        self.kind = [p.get(3, NORMAL) for p in pieces]
        self.unknown = self.kind.index(UNKNOWN)
        self.bytes = {int(t[3:5], 16): i for i, (t, k) in enumerate(zip(self.text, self.kind)) if k == BYTE}
        self.ids = {t: i for i, (t, k) in enumerate(zip(self.text, self.kind)) if k in (NORMAL, USER)}
        self.trie: dict[str, tuple[int, dict]] = {}
        for t in sorted(self.ids, key=len):  # short ones first: a node's number is known when it is made
            node = self.trie
            for c in t[:-1]:
                node = node.setdefault(c, (-1, {}))[1]
            node[t[-1]] = (self.ids[t], node.get(t[-1], (-1, {}))[1])
        chars = {c for t in self.ids for c in t}
        # no piece crosses from another character into the meta symbol: units are independent
        self.apart = not any(re.search(f"[^{SPACE}]{SPACE}", t) for t in self.ids)
        inside = re.escape("".join(sorted(chars - {SPACE})))
        unit = f"{SPACE}+[{inside}]*|[{inside}]+" if self.apart else f"[{SPACE}{inside}]+"
        self.units = re.compile(f"{unit}|.", re.S)
        self.pairs: dict[tuple[int, int], float] = {}
        self.edges: dict[int, tuple | None] = {}
        self.paths = _Kept(self.shortest)
        self.chunks = _Kept(lambda word: self.shortest(SPACE + word))
        self.surface = [self.bytes_of(t, k) for t, k in zip(self.text, self.kind)]
        # all surfaces behind each other: a batch of pieces is decoded by one gather
        self.blob = np.frombuffer(b"".join(self.surface), np.uint8)
        self.lengths = np.array([len(x) for x in self.surface], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths

    @staticmethod
    def bytes_of(text: str, kind: int) -> bytes:
        """What a piece adds to a decoded text."""
        if kind == BYTE:
            return bytes([int(text[3:5], 16)])
        return " ⁇ ".encode() if kind == UNKNOWN else text.replace(SPACE, " ").encode() if kind in (NORMAL, USER) else b""

    def normalise(self, text: str) -> str:
        if self.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        return (SPACE if self.dummy and text else "") + text.replace(" ", SPACE)

    def spines(self, piece: int) -> tuple[list, list] | None:
        """What stands at the right and at the left edge of a piece while it is merged, with the cost of the next merge there.

        None for a piece that its own merges do not produce.
        """
        if piece not in self.edges:
            parts = [(c, [(c, INF)], [(c, INF)]) for c in self.text[piece]]
            while len(parts) > 1:
                scored = [self.ids.get(x[0] + y[0]) for x, y in zip(parts, parts[1:])]
                best = max((self.score[j] for j in scored if j is not None), default=None)
                if best is None:
                    break
                i = next(i for i, j in enumerate(scored) if j is not None and self.score[j] == best)
                (x, _, left), (y, right, _) = parts[i], parts[i + 1]
                grow = lambda spine: [*spine[:-1], (spine[-1][0], -best), (x + y, INF)]  # noqa: B023, E731
                parts[i : i + 2] = [(x + y, grow(right), grow(left))]
            self.edges[piece] = (parts[0][1], parts[0][2]) if len(parts) == 1 else None
        return self.edges[piece]

    def may_follow(self, before: int, piece: int) -> bool:
        """Whether no merge crosses the edge between two pieces.

        Merges run in order of cost, leftmost first. A crossing merge happens when both
        of its parts stand at the edge before a dearer merge takes one of them away.
        """
        a, b = self.spines(before), self.spines(piece)
        if a is None or b is None:
            return False
        a, b, i, j = a[0], b[1], 0, 0
        while True:
            (x, after_x), (y, after_y) = a[i], b[j]
            across = self.ids.get(x + y)
            if across is not None and -self.score[across] < after_x and -self.score[across] <= after_y:
                return False
            if after_x == INF and after_y == INF:
                return True
            if after_x <= after_y:
                i += 1
            else:
                j += 1

    def weight(self, before: int, piece: int) -> float:
        """Weight of the arc of ``piece`` after ``before`` (-1: the start of a unit)."""
        if not self.merges:
            return -self.score[piece]
        if len(self.pairs) > CACHED:
            self.pairs.clear()
        fits = self.spines(piece) is not None if before < 0 else self.may_follow(before, piece)
        self.pairs[before, piece] = cost = 0.0 if fits else INF
        return cost

    def arcs(self, unit: str, i: int) -> list[tuple[int, int]]:
        """Pieces that stand at ``i`` and where they end, longest last; a character of no piece is the byte arc -1."""
        out, node = [], self.trie
        for j in range(i, len(unit)):
            step = node.get(unit[j])
            if step is None:
                break
            piece, node = step
            if piece >= 0:
                out.append((piece, j + 1))
        return out if out and out[0][1] == i + 1 else [(-1, i + 1), *out]

    def shortest(self, unit: str) -> bytes:
        """Pieces of the lightest path over one unit, as 32-bit numbers."""
        path = self.finite(unit) if self.merges else self.lightest(unit)
        if -1 in path:
            out, at = [], 0
            for p in path:
                out += [p] if p >= 0 else self.fallback(unit[at])
                at += len(self.text[p]) if p >= 0 else 1
            path = out
        return array("i", path).tobytes()

    def finite(self, unit: str) -> list[int]:
        """The one path without an infinite arc, depth first with long pieces first; a place left once is dead."""
        size, pairs, trie, path, ends, todo, dead = len(unit), self.pairs, self.trie, [], [0], [], set()
        at, before = 0, -1
        while at < size:
            if len(todo) < len(ends):  # first time here: the pieces that stand at this place, longest last
                options, node = [], trie
                for j in range(at, size):
                    step = node.get(unit[j])
                    if step is None:
                        break
                    if step[0] >= 0:
                        options.append((step[0], j + 1))
                    node = step[1]
                if not options or options[0][1] != at + 1:
                    options.insert(0, (-1, at + 1))
                todo.append(options)
            options = todo[-1]
            while options:
                p, end = options.pop()
                if end in dead:
                    continue
                fits = pairs.get((before, p)) if p >= 0 else 0.0
                if fits is None:
                    fits = self.weight(before, p)
                if fits == 0.0:
                    path.append(p)
                    ends.append(end)
                    at, before = end, p
                    break
            else:
                dead.add(ends.pop())
                todo.pop(), path.pop()
                at, before = ends[-1], path[-1] if path else -1
        return path

    def lightest(self, unit: str) -> list[int]:
        """Forward relaxation in tropical arithmetic; a byte arc is dearer than any piece."""
        size = len(unit)
        cost, by, start = [INF] * (size + 1), [-1] * (size + 1), [0] * (size + 1)
        cost[0] = 0.0
        for i in range(size):
            for p, j in self.arcs(unit, i):
                total = cost[i] + (self.weight(-1, p) if p >= 0 else 1e6)
                if total < cost[j]:
                    cost[j], by[j], start[j] = total, p, i
        out, at = [], size
        while at > 0:
            out.append(by[at])
            at = start[at]
        return out[::-1]

    def fallback(self, char: str) -> list[int]:
        return [self.bytes.get(b, self.unknown) for b in char.encode()] if self.bytes else [self.unknown]

    def encode(self, text: str) -> np.ndarray:
        if self.apart and self.dummy and not self.squeeze and text and text[0] != " " and "  " not in text and SPACE not in text:
            return np.frombuffer(b"".join(map(self.chunks.__getitem__, text.split(" "))), np.int32)  # single spaces
        return np.frombuffer(b"".join(map(self.paths.__getitem__, self.units.findall(self.normalise(text)))), np.int32)

    def decode(self, ids) -> str:
        return self.decode_all(np.asarray(ids, np.int64), [len(ids)])[0]

    def decode_all(self, ids: np.ndarray, sizes: list[int]) -> list[str]:
        """Texts of lists of pieces that stand behind each other, of the given sizes."""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[ids] - ends + lengths, lengths)
        data, at, done, out = self.blob[places].tobytes(), 0, 0, []
        for n in sizes:
            done += n
            end = int(ends[done - 1]) if done else 0
            text = data[at:end].decode(errors="replace")
            out.append(text[1:] if self.dummy and text.startswith(" ") else text)
            at = end
        return out


class _Kept(dict):
    """Bounded memory of what ``make`` gives for short keys; when full, only what was used since the last time stays."""

    def __init__(self, make) -> None:
        super().__init__()
        self.make, self.before = make, {}

    def __missing__(self, key: str) -> bytes:
        value = self.before.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= 32:
            if len(self) >= CACHED:
                self.before = dict(self)
                self.clear()
            self[key] = value
        return value


_COMPILED: dict[int, Transducer] = {}


def _compiled(raw: bytes) -> Transducer:
    key = hash(raw)
    if key not in _COMPILED:
        _COMPILED[key] = Transducer(raw)
    return _COMPILED[key]


def read_model(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def _mapped(df: DataFrame, raw: bytes, source: str, targets: dict[str, T.DataType], make) -> DataFrame:
    """``df`` with the columns ``targets``, made from ``source`` in slices of bounded size. Other columns may have any names."""
    shared = df.sparkSession.sparkContext.broadcast(raw)
    kept = [c for c in df.columns if c not in targets]
    sent = kept if source in kept else [*kept, source]
    at = sent.index(source)

    def run(batches):
        model = _compiled(shared.value)
        for whole in batches:
            for start in range(0, whole.num_rows, 128):
                b = whole.slice(start, 128)
                yield pa.RecordBatch.from_arrays([*b.columns[: len(kept)], *make(model, b.column(at))], names=[*kept, *targets])

    schema = T.StructType([*df.select(*kept).schema, *(T.StructField(c, t) for c, t in targets.items())])
    return df.select(*sent).mapInArrow(run, schema)


_IDS = T.ArrayType(T.IntegerType())


def _encoded(model: Transducer, texts: pa.Array) -> pa.Array:
    rows = [None if t is None else model.encode(t) for t in texts.to_pylist()]
    return pa.array(rows, pa.list_(pa.int32()))


def _decoded(model: Transducer, ids: pa.Array) -> pa.Array:
    sizes = pc.list_value_length(ids).to_pylist()
    texts = iter(model.decode_all(ids.flatten().to_numpy(zero_copy_only=False), [n for n in sizes if n is not None]))
    return pa.array([None if n is None else next(texts) for n in sizes], pa.string())


def encode(df: DataFrame, raw: bytes, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with the piece numbers of ``text`` in ``ids`` (replaced if there): null for null, empty for empty."""
    return _mapped(df, raw, text, {ids: _IDS}, lambda model, texts: [_encoded(model, texts)])


def decode(df: DataFrame, raw: bytes, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with the text of the piece numbers in ``ids``; bytes that are no UTF-8 become replacement characters."""
    return _mapped(df, raw, ids, {text: T.StringType()}, lambda model, v: [_decoded(model, v)])


def round_trip(df: DataFrame, raw: bytes, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``encode`` and ``decode`` of its result in one pass: the piece numbers never leave the task between the two."""
    def make(model: Transducer, texts: pa.Array) -> list[pa.Array]:
        coded = _encoded(model, texts)
        return [coded, _decoded(model, coded)]

    return _mapped(df, raw, text, {ids: _IDS, decoded: T.StringType()}, make)
