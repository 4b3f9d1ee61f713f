"""Archive members as rows.

Archives come as bytes in a column (``expand_archives``) or by path
(``expand_listed``): the second way reads no archive as a whole, so that its size
has no limit, and deals the members of one zip or uncompressed tar over many tasks.
``pack_listed`` writes such archives, each by many tasks.
"""

from __future__ import annotations

import bz2
import gzip
import io
import lzma
import os
import shutil
import struct
import tarfile
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gatelake import schemas
from gatelake.session import materialize

BATCH_BYTES = 32 << 20
SLICE_BYTES = 4 << 20  # archives packed by one task that stand in memory at once
UNREADABLE = (zipfile.BadZipFile, tarfile.TarError, zlib.error, lzma.LZMAError, EOFError, OSError, RuntimeError, NotImplementedError)
NESTED = r"(?i)\.(zip|tar|tgz|tar\.gz|tar\.bz2|tar\.xz)$"


def scan_archives(spark: SparkSession, path: str, dataset: str) -> DataFrame:
    """Archive files as ``(dataset_name, archive, content)``; one archive is one row."""
    return spark.read.format("binaryFile").load(path).select(
        F.lit(dataset).alias("dataset_name"), F.substring_index("path", "/", -1).alias("archive"), "content")


def _members(content: bytes) -> Iterator[tuple[str | None, bytes | None]]:
    """Name and bytes of each member; a zip member that cannot be read has neither, those after it are read."""
    if content[:2] == b"PK":
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            for info in z.infolist():
                if not info.is_dir():
                    try:
                        data = z.read(info)
                    except UNREADABLE:
                        yield None, None
                    else:
                        yield info.filename, data
    else:  # streamed: members are read in order, never all at once
        with _tar_stream(io.BytesIO(content)) as t:
            for info in t:
                if info.isfile():
                    yield info.name, t.extractfile(info).read()


class _Unpacked:
    """What a compressed file holds, in all its members; what was unpacked before a fault is handed on first."""

    def __init__(self, file) -> None:
        self.read = file.read1


def _tar_stream(f) -> tarfile.TarFile:
    """A tar read in order. (``r|*`` ends with the first member of a gzip, bzip2 or xz file and takes no extra fields.)"""
    head = f.read(10)
    f.seek(0)
    if head[:3] == b"\x1f\x8b\x08":
        f = _Unpacked(gzip.GzipFile(fileobj=f))
    elif head[:3] == b"BZh" and head[4:] == b"1AY&SY":
        f = _Unpacked(bz2.BZ2File(f))
    elif head.startswith((b"\x5d\x00\x00\x80", b"\xfd7zXZ")):
        f = _Unpacked(lzma.LZMAFile(f))
    return tarfile.open(fileobj=f, mode="r|")


def _expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    cols = [f.name for f in schemas.MEMBERS]
    rows, size = [], 0
    for pdf in batches:
        for dataset, archive, content in zip(pdf["dataset_name"], pdf["archive"], pdf["content"]):
            seq = 0
            try:
                for path, data in _members(content):
                    rows.append((dataset, archive, path, data, seq))
                    seq, size = seq + 1, size + len(data or b"") + 200
                    if size >= BATCH_BYTES:  # bounded output batches
                        yield pd.DataFrame(rows, columns=cols)
                        rows, size = [], 0
            except UNREADABLE:
                rows.append((dataset, archive, None, None, seq))
    if rows:
        yield pd.DataFrame(rows, columns=cols)


def expand_archives(archives: DataFrame, *, spread: int | None = None) -> DataFrame:
    """One row per regular member of each zip or tar (any compression), in archive order (``load_seq``).

    An archive that cannot be read to its end keeps the members before the fault
    and adds a row without path and content (see ``unreadable``); the job goes on.
    A zip member that cannot be read (damaged, encrypted, unsupported) adds such a row
    in its place, and the members after it are kept.
    An archive is read by one task, since compressed tars cannot be split;
    ``spread`` redistributes the members over that many tasks, for archives
    that hold a large share of all files.
    """
    out = archives.select("dataset_name", "archive", "content").mapInPandas(_expand, schemas.MEMBERS)
    return out.repartition(spread, "archive", "path") if spread else out


def unreadable(members: DataFrame) -> DataFrame:
    """``(dataset_name, archive, n_members, status)``: archives that broke off and zip members that cannot be read, and after how many members."""
    return members.filter("path IS NULL").select(
        "dataset_name", "archive", F.col("load_seq").alias("n_members"), F.lit("unreadable_archive").alias("status"))


def expand_nested(members: DataFrame) -> DataFrame:
    """Members of archives that are members themselves; the name becomes ``outer!inner``."""
    inner = members.filter(F.col("path").rlike(NESTED)).select(
        "dataset_name", F.concat_ws("!", "archive", "path").alias("archive"), "content")
    return expand_archives(inner)


# ------------------------------------------------------------------ archives by path
GROUP_BYTES = 64 << 20  # content of the members that one row of the plan stands for
GROUP_MEMBERS = 4096
MAX_MEMBER = 1 << 30  # one value of a table holds no more than two of these
GZIP_LIMIT = 256 << 20  # content of a gzip member that is unpacked at once
_GROUPS = (
    "dataset_name string, archive string, location string, kind string, "
    "members array<struct<seq: bigint, name: string, at: bigint, packed: bigint, size: bigint, method: int, crc: bigint>>")
_WHOLE, _CUT = "stream", "gzip"


def list_archives(spark: SparkSession, path: str, dataset: str) -> DataFrame:
    """``(dataset_name, archive, location, length)`` of the archive files at ``path``; none is read."""
    return spark.read.format("binaryFile").load(path).select(
        F.lit(dataset).alias("dataset_name"), F.substring_index("path", "/", -1).alias("archive"), F.col("path").alias("location"), "length")


class _Ranges(io.RawIOBase):
    """A file of the shared store, read by ranges; a place before its start is an OSError, as with files."""

    def __init__(self, location: str):
        if location.startswith("file:"):
            system, path = fs.LocalFileSystem(), "/" + location.removeprefix("file:").lstrip("/")
        else:
            system, path = fs.FileSystem.from_uri(location)
        self._file = system.open_input_file(path)
        self._size, self._at = self._file.size(), 0

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self._at

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        at = offset + (0, self._at, self._size)[whence]
        if at < 0:
            raise OSError(f"place {at} of {self._size} bytes")
        self._at = at
        return at

    def readinto(self, buffer) -> int:
        data = self._file.read_at(max(0, min(len(buffer), self._size - self._at)), self._at)
        buffer[:len(data)] = data
        self._at += len(data)
        return len(data)

    def close(self) -> None:
        self._file.close()
        super().close()


def _opened(location: str, buffer: int = 1 << 18) -> io.BufferedReader:
    return io.BufferedReader(_Ranges(location), buffer)


def _zip_members(f) -> list[dict]:
    """Places of a zip's members from its central directory; place -1 for a member that cannot be read by itself."""
    with zipfile.ZipFile(f) as z:
        infos = [i for i in z.infolist() if not i.is_dir()]
    return [{"seq": n, "name": i.filename, "at": -1 if i.flag_bits & 0x1 or i.compress_type not in (0, 8, 12) else i.header_offset,
             "packed": i.compress_size, "size": i.file_size, "method": i.compress_type, "crc": i.CRC} for n, i in enumerate(infos)]


def _tar_members(f) -> list[dict] | None:
    """Places of the members of an uncompressed tar, from its headers; none for a tar with sparse members."""
    out = []
    with tarfile.open(fileobj=f, mode="r:") as t:
        try:
            for info in t:
                if info.issparse():
                    return None
                if info.isreg():
                    out.append({"seq": len(out), "name": info.name, "at": info.offset_data, "packed": info.size, "size": info.size, "method": -1, "crc": 0})
                t.members.clear()  # not needed again
        except UNREADABLE:  # the members before the fault are kept
            out.append({"seq": len(out), "name": None, "at": -1, "packed": 0, "size": 0, "method": -1, "crc": 0})
    return out


def _gzip_members(f) -> list[dict]:
    """Places of the members of a gzip file whose headers tell their length (extra field ``SZ``); none if one does not. The last is marked by ``crc``."""
    out, at, end = [], 0, f.seek(0, io.SEEK_END)
    while at < end:
        f.seek(at)
        head = f.read(24)
        size = int.from_bytes(head[16:], "little")
        if head[:4] != b"\x1f\x8b\x08\x04" or head[10:16] != b"\x0c\x00SZ\x08\x00" or size < 32 or at + size > end:
            return []
        out.append({"seq": len(out), "name": None, "at": at, "packed": size, "size": size, "method": 8, "crc": int(at + size == end)})
        at += size
    return out if len(out) > 1 else []


def _gzip_tar(f, m: dict) -> tarfile.TarFile:
    """The tar entries of one gzip member."""
    f.seek(m["at"])
    z = zlib.decompressobj(zlib.MAX_WBITS | 16)
    body = z.decompress(f.read(m["packed"]), GZIP_LIMIT + 1)
    if not z.eof or z.unused_data or len(body) > GZIP_LIMIT:
        raise EOFError(f"no gzip member of {m['packed']} bytes at {m['at']}")
    return tarfile.open(fileobj=io.BytesIO(body), mode="r:")


def _count_members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """How many files the gzip members of a group hold, and whether each is of whole tar entries that can be read without the others."""
    for pdf in batches:
        rows = []
        for location, first, members in zip(pdf["location"], pdf["first"], pdf["members"]):
            n, fits = 0, True
            with _opened(location) as f:
                for m in members:
                    try:
                        with _gzip_tar(f, m) as t:
                            n += sum(info.isfile() for info in t)
                            rest = t.fileobj.getbuffer()[t.offset:]
                            fits &= not t.pax_headers and (not any(rest) if m["crc"] else len(rest) == 0)
                    except UNREADABLE:
                        fits = False
            rows.append((location, first, n, fits))
        yield pd.DataFrame(rows, columns=["location", "first", "n", "fits"])


def _cut_members(f, members, seq: int) -> Iterator[tuple[int, str | None, bytes | None]]:
    for m in members:
        with _gzip_tar(f, m) as t:
            for info in t:
                if info.isfile():
                    yield seq, info.name, t.extractfile(info).read()
                    seq += 1


def _plan(group_bytes: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cols = ["dataset_name", "archive", "location", "kind", "members"]
        for pdf in batches:
            for dataset, archive, location in zip(pdf["dataset_name"], pdf["archive"], pdf["location"]):
                kind, members = _WHOLE, []
                near = tarfile.BLOCKSIZE + 1 if location.startswith("file:") else 1 << 18  # a header, and what tarfile reads before it
                try:
                    with _opened(location) as f:
                        head = f.read(262)
                        f.seek(0)
                        if head[:2] == b"PK" or not (head[257:262] == b"ustar" or _compressed(head)) and zipfile.is_zipfile(f):
                            f.seek(0)
                            kind, members = "zip", _zip_members(f)
                        elif head[257:262] == b"ustar":
                            with _opened(location, near) as headers:
                                found = _tar_members(headers)
                            kind, members = ("tar", found) if found is not None else (_WHOLE, [])
                        elif head[:2] == b"\x1f\x8b":
                            with _opened(location, near) as headers:
                                members = _gzip_members(headers)
                            kind = _CUT if members else _WHOLE
                except UNREADABLE:
                    kind, members = "zip", [{"seq": 0, "name": None, "at": -1, "packed": 0, "size": 0, "method": -1, "crc": 0}]
                if kind == _WHOLE:
                    yield pd.DataFrame([(dataset, archive, location, kind, [])], columns=cols)
                group, size = [], 0
                for m in [*members, None]:
                    if group and (m is None or len(group) >= GROUP_MEMBERS or size + m["size"] > group_bytes):
                        yield pd.DataFrame([(dataset, archive, location, kind, group)], columns=cols)
                        group, size = [], 0
                    if m is not None:
                        group.append(m)
                        size += m["size"]

    return run


def _compressed(head: bytes) -> bool:
    return head[:2] == b"\x1f\x8b" or head[:3] == b"BZh" or head[:6] == b"\xfd7zXZ\x00"


def _read_range(f, m: dict) -> bytes | None:
    """One member by its place: its header, its packed bytes, its length and checksum."""
    if m["at"] < 0 or m["size"] > MAX_MEMBER:
        return None
    f.seek(m["at"])
    if m["method"] < 0:
        data = f.read(m["packed"])
        return data if len(data) == m["size"] else None
    head = f.read(30)
    if head[:4] != b"PK\x03\x04":
        return None
    f.seek(m["at"] + 30 + int.from_bytes(head[26:28], "little") + int.from_bytes(head[28:30], "little"))
    packed = f.read(m["packed"])
    try:  # no more is unpacked than the directory says
        data = packed if m["method"] == 0 else zlib.decompressobj(-15).decompress(packed, m["size"] + 1) if m["method"] == 8 else bz2.BZ2Decompressor().decompress(packed, m["size"] + 1)
    except (*UNREADABLE, ValueError):
        return None
    return data if len(data) == m["size"] and zlib.crc32(data) == m["crc"] else None


def _read_groups(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    cols = [f.name for f in schemas.MEMBERS]
    rows, size = [], 0
    for pdf in batches:
        for dataset, archive, location, kind, members, start in zip(*(pdf[c] for c in ("dataset_name", "archive", "location", "kind", "members", "start"))):
            with _opened(location) as f:
                if kind == _WHOLE:
                    found = _streamed(f)
                elif kind == _CUT:
                    found = _cut_members(f, members, start)
                else:
                    found = ((m["seq"], m["name"], _read_range(f, m)) for m in members)
                for seq, name, data in found:
                    rows.append((dataset, archive, name if data is not None else None, data, seq))
                    size += len(data or b"") + 200
                    if size >= BATCH_BYTES:
                        yield pd.DataFrame(rows, columns=cols)
                        rows, size = [], 0
    if rows:
        yield pd.DataFrame(rows, columns=cols)


def _streamed(f) -> Iterator[tuple[int, str | None, bytes | None]]:
    """Members of a compressed tar in order, one in memory at a time."""
    seq = 0
    try:
        with _tar_stream(f) as t:
            for info in t:
                if info.isfile():
                    yield seq, info.name, t.extractfile(info).read() if info.size <= MAX_MEMBER else None
                    seq += 1
                t.members.clear()
    except UNREADABLE:
        yield seq, None, None


def expand_listed(listed: DataFrame, *, group_bytes: int = GROUP_BYTES, spread: int | None = None) -> DataFrame:
    """Members of ``list_archives``' files, as ``expand_archives`` gives them, for archives of any size.

    First only directories are read: the central directory of a zip, the headers of
    an uncompressed tar. They give groups of members of about ``group_bytes``, which
    are dealt over ``spread`` tasks (the session's shuffle partitions by default) and read as
    byte ranges of the file, so one archive is shared out among many tasks. So is a gzip tar
    that is a row of gzip members, if their headers tell their lengths (as those of
    ``pack_listed``) and each is found to hold whole entries, which many tasks count first. Any other
    compressed tar can only be read from its start: one task streams it, a member
    at a time. ``load_seq`` is a member's place in its archive in all cases.

    A member that cannot be read (damaged, encrypted, packed by a method other than
    store, deflate or bzip2, or longer than ``MAX_MEMBER``) is a row without path and content in its
    place; those after it are kept. So is the rest of an archive that breaks off.
    Locations are files that all machines can open: mounted ones, or a store that
    Arrow's file systems read.
    """
    planned = materialize(listed.select("dataset_name", "archive", "location").mapInPandas(_plan(group_bytes), _GROUPS), "groups")
    tasks = spread or int(listed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups = planned.withColumn("first", F.coalesce(F.get("members", F.lit(0))["seq"], F.lit(0)))
    cut = F.col("kind") == _CUT
    counted = groups.filter(cut).select("location", "first", "members").repartition(tasks, "location", "first").mapInPandas(
        _count_members, "location string, first bigint, n bigint, fits boolean").dropDuplicates(["location", "first"])  # an archive may be listed twice
    every = Window.partitionBy("location")
    before = every.orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    starts = counted.select("location", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"), F.bool_and("fits").over(every).alias("fits"))
    placed = groups.filter(cut).join(starts, ["location", "first"]).filter("fits OR first = 0")  # what does not fit is streamed, once
    rows = groups.filter(~cut).withColumn("start", F.lit(0).cast("long")).unionByName(
        placed.withColumn("kind", F.when(F.col("fits"), _CUT).otherwise(_WHOLE)).drop("fits"))
    return rows.repartition(tasks, "location", "first").mapInPandas(_read_groups, schemas.MEMBERS)


def _pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows, size = [], 0
        for dataset, archive, entries in zip(pdf["dataset_name"], pdf["archive"], pdf["entries"]):
            buf = io.BytesIO()
            with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
                for e in entries:
                    z.writestr(e["path"], e["text"])
            rows.append((dataset, archive, buf.getvalue()))
            size += len(rows[-1][2])
            if size >= SLICE_BYTES:
                yield pd.DataFrame(rows, columns=["dataset_name", "archive", "content"])
                rows, size = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=["dataset_name", "archive", "content"])


def pack_archives(entries: DataFrame) -> DataFrame:
    """The reverse, row by row: ``(dataset_name, archive, entries array<struct<path,text>>)`` → zip bytes."""
    return entries.mapInPandas(_pack, "dataset_name string, archive string, content binary")


# ------------------------------------------------------------------ writing by path
PIECE_BYTES = 32 << 20  # content that one task packs
GZIP_BYTES = 1 << 20  # content of one gzip member
_PIECES = "archive string, first bigint, part string, n bigint, size bigint, directory bigint"
_TAR_END = bytes(2 * tarfile.BLOCKSIZE)


def _gzip_member(body: bytes) -> bytes:
    """One gzip member; its extra field ``SZ`` tells its packed length, so that a reader can pass over it."""
    z = zlib.compressobj(9, zlib.DEFLATED, -zlib.MAX_WBITS)
    packed = z.compress(body) + z.flush()
    return struct.pack("<4BL2BH2sHQ", 0x1F, 0x8B, 8, 4, 0, 2, 255, 12, b"SZ", 8, 24 + len(packed) + 8) + packed + struct.pack(
        "<2L", zlib.crc32(body), len(body) & 0xFFFFFFFF)


class _Piece:
    """A part of one archive in a file of its own: a zip, or the tar entries in a row, plain or as gzip members."""

    def __init__(self, archive: str, first: int, part: str) -> None:
        self.archive, self.first, self.part, self.n, self.directory = archive, first, part, 0, 0
        self.kind = _written_kind(archive)
        self.file = open(part, "wb")
        self.out = self.file if self.kind != "tgz" else io.BytesIO()
        self.pack = zipfile.ZipFile(self.out, "w") if self.kind == "zip" else tarfile.open(fileobj=self.out, mode="w")

    def add(self, path: str, content: bytes) -> None:
        self.n += 1
        if self.kind == "zip":
            info = zipfile.ZipInfo(path)
            self.pack.writestr(info, content, zipfile.ZIP_DEFLATED)
            self.directory += len(_zip_entry(info, 0))
            return
        info = tarfile.TarInfo(path)
        info.size = len(content)
        self.pack.addfile(info, io.BytesIO(content))
        if self.kind == "tgz" and self.out.tell() >= GZIP_BYTES:
            self._flush()

    def _flush(self) -> None:
        if self.out.tell():
            self.file.write(_gzip_member(self.out.getvalue()))
            self.out.seek(0)
            self.out.truncate()

    def end(self) -> tuple:
        if self.kind == "zip":
            size = self.pack.start_dir
            self.pack.close()
        else:  # an open tar: its end comes once, behind the last piece
            if self.kind == "tgz":
                self._flush()
            size = self.file.tell()
        self.file.close()
        return self.archive, self.first, self.part, self.n, size, self.directory


def _written_kind(archive: str) -> str:
    for kind, ends in (("zip", ".zip"), ("tar", ".tar"), ("tgz", (".tgz", ".tar.gz"))):
        if archive.lower().endswith(ends):
            return kind
    raise ValueError(f"{archive}: no zip, tar or gzip tar by its name")


def _zip_entry(info: zipfile.ZipInfo, at: int) -> bytes:
    """A member's record in the directory of a zip whose piece begins at ``at``; places are always of eight bytes, so its length is known before."""
    name, (y, mo, d, h, mi, s) = info.filename.encode(), info.date_time
    return struct.pack(
        "<4s6H3L5H2L", b"PK\x01\x02", 3 << 8 | 45, 45, info.flag_bits, info.compress_type, h << 11 | mi << 5 | s // 2, y - 1980 << 9 | mo << 5 | d,
        info.CRC, info.compress_size, info.file_size, len(name), 12, 0, 0, 0, info.external_attr, 0xFFFFFFFF) + name + struct.pack("<2HQ", 1, 8, info.header_offset + at)


def _zip_end(n: int, at: int, size: int) -> bytes:
    """What ends a zip of ``n`` members with a directory of ``size`` bytes at ``at``."""
    return (struct.pack("<4sQ2H2L4Q", b"PK\x06\x06", 44, 45, 45, 0, 0, n, n, size, at) + struct.pack("<4sLQL", b"PK\x06\x07", 0, at + size, 1)
            + struct.pack("<4s4H2LH", b"PK\x05\x06", 0, 0, min(n, 0xFFFF), min(n, 0xFFFF), min(size, 0xFFFFFFFF), min(at, 0xFFFFFFFF), 0))


def _write_pieces(parts: str) -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.makedirs(parts, exist_ok=True)
        rows, piece = [], None
        for pdf in batches:
            for archive, seq, path, content in zip(*(pdf[c] for c in ("archive", "load_seq", "path", "content"))):
                if piece is None or piece.archive != archive:  # rows come sorted: one archive after the other
                    if piece is not None:
                        rows.append(piece.end())
                    piece = _Piece(archive, seq, f"{parts}/{uuid.uuid4().hex}")
                piece.add(path, content)
        if piece is not None:
            rows.append(piece.end())
        yield pd.DataFrame(rows, columns=["archive", "first", "part", "n", "size", "directory"])

    return run


def _place_pieces(folder: str) -> Callable:
    """Each piece to its place in the one file; a task that is run again writes the same bytes there."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for p in pdf.itertuples():
                kind, left = _written_kind(p.archive), p.size
                with open(os.open(f"{folder}/{p.archive}", os.O_WRONLY | os.O_CREAT, 0o644), "wb") as out, open(p.part, "rb") as part:
                    out.seek(p.at)
                    while left:
                        data = part.read(min(left, 1 << 20))
                        out.write(data)
                        left -= len(data)
                    if kind == "zip":
                        out.seek(p.all_size + p.directory_at)
                        with zipfile.ZipFile(part) as z:
                            for info in z.infolist():
                                out.write(_zip_entry(info, p.at))
                    if p.last:
                        out.write(_zip_end(p.all_n, p.all_size, p.all_directory) if kind == "zip" else _TAR_END if kind == "tar" else _gzip_member(_TAR_END))
            yield pd.DataFrame({"n": [int(pdf["n"].sum())]})

    return run


def pack_listed(members: DataFrame, folder: str, *, piece_bytes: int = PIECE_BYTES) -> int:
    """The reverse of ``expand_listed``: ``(archive, path, content, load_seq)`` as archive files in a mounted ``folder``; the number of members.

    The name's ending tells a zip, a tar or a gzip tar; members stand by ``load_seq``.
    No task packs or copies a whole archive: members are dealt by ranges of ``load_seq``
    of about ``piece_bytes``, and each task packs its own into a file. The sizes of these pieces
    give their places in the archive, and many tasks write them there. A gzip tar is a
    row of gzip members, each of whole tar entries.
    """
    spark = members.sparkSession
    total = members.agg(F.sum(F.octet_length("content"))).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // piece_bytes + 1)
    parts = f"{folder}/.parts-{uuid.uuid4().hex}"
    dealt = members.select("archive", "load_seq", "path", "content").repartitionByRange(tasks, "archive", "load_seq")
    pieces = materialize(dealt.sortWithinPartitions("archive", "load_seq").mapInPandas(_write_pieces(parts), _PIECES), "pieces")
    every = Window.partitionBy("archive")
    until = every.orderBy("first")  # rows of one archive and load_seq lie in one range, so no two pieces begin alike
    before = until.rowsBetween(Window.unboundedPreceding, -1)
    placed = pieces.select(
        "*", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("at"), F.coalesce(F.sum("directory").over(before), F.lit(0)).alias("directory_at"),
        *(F.sum(c).over(every).alias(f"all_{c}") for c in ("n", "size", "directory")), F.lead("part").over(until).isNull().alias("last"))
    n = placed.repartition(tasks, "part").mapInPandas(_place_pieces(folder), "n bigint").agg(F.sum("n")).first()[0] or 0
    shutil.rmtree(parts, ignore_errors=True)
    return n
