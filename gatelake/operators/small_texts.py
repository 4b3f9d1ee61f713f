"""Decomposition of designs whose files fit a row batch, many designs at once.

Rows are ``(design_name, file_name, gaps, texts, names, heads)``: a file split at its tokens.
They come sorted by design, so a task holds one batch and the rows of one design beyond it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from gatelake.operators import small_graphs

D = small_graphs.D
SLICE_BYTES = 4 << 20
_OUT = pa.schema([(D, pa.string()), ("root", pa.string()), ("file_name", pa.string()), ("text", pa.string())])
_GRAPH = pa.schema([(D, pa.int32()), ("a", pa.string()), ("b", pa.string()), ("edge", pa.bool_())])


def _values(column: pa.Array) -> list:
    """A column's texts, or lists of them, as Python values; whole columns are turned at once, not value by value."""
    if not pa.types.is_list(column.type):
        return column.to_numpy(zero_copy_only=False).tolist()
    values, lengths = _values(column.flatten()), pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    out = [values[a:b] for a, b in zip((ends - lengths).tolist(), ends.tolist())]
    if column.null_count:
        out = [v if known else None for v, known in zip(out, column.is_valid().to_pylist())]
    return out


def _below(designs: list[list[tuple]]) -> list[dict[str, set[str]]]:
    """For each design its modules and all that is below each of them, the module itself included (``small_graphs.close``)."""
    rows: list[tuple] = []
    for i, files in enumerate(designs):
        modules = {n for f in files for n in f[3] or () if n}
        for f in files:
            for name, heads in zip(f[3] or (), f[4] or ()):
                if name:
                    rows.append((i, name, None, False))
                    rows.extend((i, name, h, True) for h in heads or () if h in modules)
    below: list[dict[str, set[str]]] = [{} for _ in designs]
    if rows:
        batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _GRAPH.types)], schema=_GRAPH)
        for found in small_graphs.close(iter([batch])):
            for i, root, node in zip(*(_values(found.column(c)) for c in (D, "root", "node"))):
                below[i].setdefault(root, set()).add(node)
    return below


def _texts(files: list[tuple], below: dict[str, set[str]]) -> Iterator[tuple[str, str, str]]:
    """``(root, file_name, text)`` of a design: each file with the modules outside a root's closure replaced by a newline.

    Rows of one file name keep the same token numbers, and each of them stands once for each of these rows.
    """
    same: dict[str, list[tuple]] = {}
    for f in files:
        if f[0] is not None:
            same.setdefault(f[0], []).append(f)
    for file, rows in same.items():
        named = [(j, name) for _, _, _, names, _ in rows for j, name in enumerate(names or ()) if name]
        whole = []
        for _, gaps, texts, names, _ in rows:
            if gaps is not None and texts is not None:
                pieces = [""] * (2 * len(gaps))
                pieces[::2] = gaps
                pieces[1:2 * len(texts):2] = texts
                whole.append((pieces, [j for j, name in enumerate(names) if name]))
        for root, nodes in below.items():
            kept = {j for j, name in named if name in nodes}
            for pieces, modules in whole:
                cut = pieces.copy()
                for j in modules:
                    if j not in kept:
                        cut[2 * j + 1] = "\n"
                text = "".join(cut).strip("\n") + "\n"
                for _ in rows:
                    yield root, file, text


def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(design_name, root, file_name, text)`` of all modules as roots, blank texts included, in batches of bounded size."""
    for table in small_graphs._whole_designs(batches):
        designs: list[list[tuple]] = []
        names: list[str] = []
        for design, *file in zip(*(_values(c.combine_chunks()) for c in table.columns)):
            if design is None:  # what is NULL equals nothing
                continue
            if not names or names[-1] != design:
                names.append(design)
                designs.append([])
            designs[-1].append(tuple(file))
        out, size = [], 0
        for design, files, below in zip(names, designs, _below(designs)):
            for row in _texts(files, below):
                out.append((design, *row))
                size += len(row[2])
                if size >= SLICE_BYTES:
                    yield _batch(out)
                    out, size = [], 0
        if out:
            yield _batch(out)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], schema=_OUT)
