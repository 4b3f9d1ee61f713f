"""Fill-in-middle over seekable compressed texts.

A text is stored as independent zstandard frames with counts of the units and
characters before each. A cut is found by those counts and needs only its own
frame; the transformed text is a list of frames again, most of them taken over
as they are, so that it is a valid multi-frame zstandard stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gatelake.session import materialize

FRAME_CHARS = 1 << 15
LEVEL = 3
BATCH_BYTES = 8 << 20
# fixed values of the output format
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"

FRAME = T.StructType([
    T.StructField("data", T.BinaryType()), T.StructField("units", T.LongType()), T.StructField("chars", T.LongType())])
_FRAME = pa.struct([("data", pa.binary()), ("units", pa.int64()), ("chars", pa.int64())])


def to_frames(text: str, pack: zstandard.ZstdCompressor) -> list[dict]:
    """Frames with the number of lines that end, and of characters that stand, up to each frame's end."""
    out, units, chars = [], 0, 0
    for at in range(0, len(text), FRAME_CHARS):
        part = text[at:at + FRAME_CHARS]
        units, chars = units + part.count("\n"), chars + len(part)
        out.append({"data": pack.compress(part.encode()), "units": units, "chars": chars})
    return out


def n_units(frames: list[dict], open_end: bool) -> int:
    """Lines of a framed text; an unterminated last line counts."""
    return (frames[-1]["units"] if frames else 0) + open_end


class Framed:
    """Random access to a framed text; a frame is decompressed when a cut falls into it, and only then."""

    def __init__(self, frames: list[dict], packer: zstandard.ZstdCompressor, reader: zstandard.ZstdDecompressor):
        self.frames, self._pack, self._read, self._open, self.n_read = frames, packer, reader, {}, 0

    def _data(self, i: int) -> bytes:
        if i not in self._open:
            self._open[i] = self._read.decompress(self.frames[i]["data"])
            self.n_read += 1
        return self._open[i]

    def cut(self, unit: int, total: int) -> tuple[int, int, int]:
        """Frame, byte in it and characters before the end of the first ``unit`` units of ``total``."""
        if unit == 0 or unit >= total:
            return (0, 0, 0) if unit == 0 else (len(self.frames), 0, self.frames[-1]["chars"] if self.frames else 0)
        low, high = 0, len(self.frames) - 1
        while low < high:  # the first frame up to whose end so many units are complete
            mid = (low + high) // 2
            low, high = (low, mid) if self.frames[mid]["units"] >= unit else (mid + 1, high)
        before = self.frames[low - 1] if low else {"units": 0, "chars": 0}
        data = self._data(low)
        byte = len(data) - len(data.split(b"\n", unit - before["units"])[-1])
        return low, byte, before["chars"] + len(data[:byte].decode())

    def between(self, start: tuple[int, int, int], end: tuple[int, int, int]) -> list[bytes]:
        """Frames of the text between two cuts: whole ones as stored, cut ones compressed anew."""
        (i, a, _), (j, b, _) = start, end
        if i == j:
            return [self._pack.compress(self._data(i)[a:b])] if b > a else []
        head = [self._pack.compress(self._data(i)[a:])] if a and a < len(self._data(i)) else [] if a else [self.frames[i]["data"]]
        tail = [self._pack.compress(self._data(j)[:b])] if b else []
        return head + [f["data"] for f in self.frames[i + 1:j]] + tail


def _tools():
    return zstandard.ZstdCompressor(level=LEVEL), zstandard.ZstdDecompressor()


def _store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    packer, _ = _tools()
    for batch in batches:
        start, size, rows = 0, 0, []

        def flush(end: int) -> pa.RecordBatch:
            ids = batch.column("doc_id").slice(start, end - start)
            return pa.RecordBatch.from_arrays([ids, pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.bool_()),
                                               pa.array([r[2] for r in rows], pa.list_(_FRAME))], ["doc_id", "n", "marked", "frames"])

        for i, value in enumerate(batch.column("text")):
            text = value.as_py() or ""
            frames = to_frames(text, packer)
            rows.append((n_units(frames, bool(text) and text[-1] != "\n"), any(m.decode() in text for m in (PREFIX, SUFFIX, MIDDLE)), frames))
            size += sum(len(f["data"]) for f in frames)
            if size >= BATCH_BYTES:
                yield flush(i + 1)
                start, size, rows = i + 1, 0, []
        if rows:
            yield flush(batch.num_rows)


def store(docs: DataFrame) -> DataFrame:
    """``(doc_id, n, marked, frames array<struct<data, units, chars>>)``, written to the shared folder.

    ``n`` counts the text's lines (``[^\\n]*\\n|[^\\n]+``), ``marked`` says whether it
    holds one of the markers, ``units`` and ``chars`` are cumulative counts up to the
    frame's end. A frame has ``FRAME_CHARS`` characters at most and is compressed by
    itself. A null or empty text has no frames. One row per row of ``docs``, repeated
    rows and null ids included; other columns are ignored whatever their names; an
    empty table gives none. Of a long text one frame at a time is compressed.
    """
    schema = T.StructType([
        docs.schema["doc_id"], T.StructField("n", T.LongType()), T.StructField("marked", T.BooleanType()), T.StructField("frames", T.ArrayType(FRAME))])
    return materialize(docs.select("doc_id", "text").mapInArrow(_store, schema), "frames")


def _draw(seed: int, group: int) -> Column:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * group - 7, 8), 16, 10).cast("bigint")


def plan(stored: DataFrame, *, seed: int = 7, rate: int = 100, spm_rate: int = 50) -> DataFrame:
    """``stored`` with ``form`` (plain, psm or spm) and the units before each cut (``first``, ``second``), from the hash of the id. Native."""
    a, b = _draw(seed, 1) % (F.col("n") + 1), _draw(seed, 2) % (F.col("n") + 1)
    plain = (F.col("n") == 0) | F.col("marked") | (_draw(seed, 3) % 100 >= rate)
    return stored.select(
        "doc_id", "n", F.when(plain, "plain").when(_draw(seed, 4) % 100 < spm_rate, "spm").otherwise("psm").alias("form"),
        F.least(a, b).alias("first"), F.greatest(a, b).alias("second"), "frames")


def _rearrange(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    packer, reader = _tools()
    p, s, m = ([packer.compress(x)] for x in (PREFIX, SUFFIX, MIDDLE))
    for batch in batches:
        n, form, first, second = (batch.column(c).to_pylist() for c in ("n", "form", "first", "second"))
        outs, sizes, start, size = [], [], 0, 0

        def flush(end: int) -> pa.RecordBatch:
            keep = [batch.column(c).slice(start, end - start) for c in ("doc_id", "n", "form")]
            return pa.RecordBatch.from_arrays([*keep, *(pa.array([x[k] for x in sizes], pa.int64()) for k in (0, 1)), pa.array(outs, pa.list_(pa.binary()))],
                                              ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

        for i, value in enumerate(batch.column("frames")):
            text = Framed(value.as_py(), packer, reader)
            if form[i] == "plain":
                outs.append([f["data"] for f in text.frames])
                sizes.append((None, None))
            else:
                a, b = text.cut(first[i], n[i]), text.cut(second[i], n[i])
                begin, end = (0, 0, 0), (len(text.frames), 0, 0)
                prefix, middle, suffix = text.between(begin, a), text.between(a, b), text.between(b, end)
                outs.append(p + prefix + s + suffix + m + middle if form[i] == "psm" else s + suffix + p + prefix + m + middle)
                sizes.append((a[2], b[2] - a[2]))
            size += sum(map(len, outs[-1]))
            if size >= BATCH_BYTES:
                yield flush(i + 1)
                outs, sizes, start, size = [], [], i + 1, 0
        if outs:
            yield flush(batch.num_rows)


def transform(planned: DataFrame) -> DataFrame:
    """``(doc_id, n, form, prefix_chars, middle_chars, output array<binary>)``: the rearranged texts as frames.

    The frames of ``output`` joined are one zstandard stream of the transformed
    text. At most the two frames that hold cuts are decompressed and compressed
    anew; a text without cuts inside (plain, or cut at its ends) is not touched.
    """
    schema = T.StructType([
        planned.schema["doc_id"], T.StructField("n", T.LongType()), T.StructField("form", T.StringType()), T.StructField("prefix_chars", T.LongType()),
        T.StructField("middle_chars", T.LongType()), T.StructField("output", T.ArrayType(T.BinaryType()))])
    return planned.mapInArrow(_rearrange, schema)


def restored_order(frames: list[bytes], form: str, marks: dict[bytes, bytes]) -> list[bytes]:
    """Frames of the text before the transformation, found by the marker frames of the output and its form."""
    if form == "plain":
        return frames
    parts, here = {}, None
    for f in frames:
        if f in marks and marks[f] not in parts:
            here = parts[marks[f]] = []
        else:
            here.append(f)
    return parts[PREFIX] + parts[MIDDLE] + parts[SUFFIX]


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    packer, reader = _tools()
    marks = {packer.compress(x): x for x in (PREFIX, SUFFIX, MIDDLE)}

    def digest(frames: list[bytes]) -> str:
        total = hashlib.sha256()
        for f in frames:  # one frame in memory at a time
            total.update(reader.decompress(f))
        return total.hexdigest()

    for batch in batches:
        form, made, back = batch.column("form").to_pylist(), [], []
        for i, value in enumerate(batch.column("output")):
            frames = value.as_py()
            made.append(digest(frames))
            back.append(digest(restored_order(frames, form[i], marks)))
        keep = [c for c in batch.schema.names if c != "output"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(made), pa.array(back)], [*keep, "output_sha256", "restored_sha256"])


def digests(transformed: DataFrame) -> DataFrame:
    """``transform``'s rows with ``output_sha256`` and ``restored_sha256`` (the text rebuilt from output and form) in place of the frames."""
    kept = [f for f in transformed.schema.fields if f.name != "output"]
    schema = T.StructType([*kept, T.StructField("output_sha256", T.StringType()), T.StructField("restored_sha256", T.StringType())])
    return transformed.mapInArrow(_digests, schema)


def read(frames: list[bytes]) -> str:
    """The text of a list of frames."""
    reader = zstandard.ZstdDecompressor()
    return b"".join(reader.decompress(f) for f in frames).decode()


def fill_in_middle(docs: DataFrame, *, seed: int = 7, rate: int = 100, spm_rate: int = 50) -> DataFrame:
    """``docs(doc_id, text)`` stored, cut at line ends and rearranged: ``transform``'s rows.

    Prefix and middle end after numbers of lines drawn from a hash of ``seed`` and
    ``doc_id`` (a null id is an empty string there); ``form`` is plain for an empty
    or null text, one that holds a marker, and the share of others beyond ``rate``.
    One row per row of ``docs``: equal rows are cut alike, ids are not compared.
    """
    return transform(plan(store(docs), seed=seed, rate=rate, spm_rate=spm_rate))

