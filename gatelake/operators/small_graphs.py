"""Closure and peeling of designs that fit a row batch, many designs at once.

Rows are ``(design_name, a, b, edge)``: a node ``a``, or an edge from ``a`` to ``b``. They
come sorted by design, so a task holds one batch and the rows of one design beyond it.
All designs of a batch take their rounds together, as arrays of node numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

D = "design_name"
OUT_ROWS = 1 << 16


def _codes(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Numbers of equal values (NULL is a value) and the values."""
    coded = pc.dictionary_encode(column, null_encoding="encode")
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary


def _whole_designs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows cut where a design ends."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        codes = _codes(table.column(D).combine_chunks())[0]
        ends = np.flatnonzero(codes[1:] != codes[:-1]) + 1
        if len(ends):
            yield table.slice(0, ends[-1])
        rest = table.slice(ends[-1]) if len(ends) else table
    if rest is not None and len(rest):
        yield rest


class _Graphs:
    """Nodes of a table's designs as numbers 0..n-1, those of one design side by side, and the distinct edges."""

    def __init__(self, table: pa.Table, *, backwards: bool = False):
        design, self._designs = _codes(table.column(D).combine_chunks())
        ends = pa.concat_arrays([table.column(c).combine_chunks() for c in ("a", "b")])
        name, self._names = _codes(ends)
        edge = table.column("edge").to_numpy(zero_copy_only=False).astype(bool)
        k = len(self._names)
        a, b = design * k + name[:len(design)], design * k + name[len(design):]
        keys, ids = np.unique(np.concatenate([a, b[edge]]), return_inverse=True)
        self._design, self._name, self.n = keys // k, keys % k, len(keys)
        self.listed = np.unique(ids[:len(a)][~edge])
        src, dst = ids[:len(a)][edge], ids[len(a):]
        if backwards:
            src, dst = dst, src
        pairs = np.unique(src * max(self.n, 1) + dst)  # also sorts the edges by their source
        src, dst = pairs // max(self.n, 1), pairs % max(self.n, 1)
        self.ins = np.bincount(dst, minlength=self.n)
        self.known = ~(self._null(self._names)[self._name] | self._null(self._designs)[self._design])
        open_ = self.known[src] & self.known[dst]  # what is NULL equals nothing
        self._dst, self._at = dst[open_], np.searchsorted(src[open_], np.arange(self.n + 1))
        self.first = np.searchsorted(self._design, self._design)
        self.size = np.searchsorted(self._design, self._design, side="right") - self.first

    @staticmethod
    def _null(values: pa.Array) -> np.ndarray:
        return values.is_null().to_numpy(zero_copy_only=False)

    def below(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each edge out of ``nodes`` its place in ``nodes`` and the node it leads to."""
        n = self._at[nodes + 1] - self._at[nodes]
        place = np.repeat(np.arange(len(nodes)), n)
        return place, self._dst[np.arange(len(place)) + np.repeat(self._at[nodes] - (np.cumsum(n) - n), n)]

    def rows(self, names: dict[str, np.ndarray], levels: np.ndarray) -> Iterator[pa.RecordBatch]:
        """The design's name and those of the given nodes, with their levels (below 0: NULL)."""
        columns = list(names.values())
        for i in range(0, len(levels), OUT_ROWS):
            part = [c[i:i + OUT_ROWS] for c in columns]
            level = levels[i:i + OUT_ROWS].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [self._designs.take(pa.array(self._design[part[0]])), *[self._names.take(pa.array(self._name[c])) for c in part], pa.array(level, mask=level < 0)],
                names=[D, *names, "level"])


def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(design_name, root, node, level)``: all that is below each listed node, by shortest distance."""
    for table in _whole_designs(batches):
        g = _Graphs(table)
        size = g.size[g.listed]
        cell = np.cumsum(size) - size - g.first[g.listed]  # a mark for each pair of a root and a node of its design
        seen = np.zeros(size.sum(), dtype=bool)
        root, node, level = np.arange(len(g.listed)), g.listed, 0
        while len(node):
            seen[cell[root] + node] = True
            yield from g.rows({"root": g.listed[root], "node": node}, np.full(len(node), level))
            place, node = g.below(node)
            root, level = root[place], level + 1
            new, one = np.unique(cell[root] + node, return_index=True)
            one = one[~seen[new]]
            root, node = root[one], node[one]


def peel(backwards: bool):
    """``(design_name, module_name, level)``: the longest path to each node, NULL on and behind cycles and where a name is NULL."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_designs(batches):
            g = _Graphs(table, backwards=backwards)
            left, levels = g.ins.copy(), np.full(g.n, -1)
            free, level = np.flatnonzero(left == 0), 0
            while len(free):
                levels[free] = level
                node, n = np.unique(g.below(free)[1], return_counts=True)
                left[node] -= n
                free, level = node[left[node] == 0], level + 1
            yield from g.rows({"module_name": np.arange(g.n)}, np.where(g.known, levels, -1))

    return run
