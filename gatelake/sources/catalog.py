"""The design catalogue: scan, look up, upsert and delete designs and their files."""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import reduce
from glob import iglob
from itertools import chain, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gatelake import schemas
from gatelake.functions import text as X
from gatelake.session import materialize, n_buckets

# --- fixed values: side directories and the role their files get ---
SIDE_ROLES = {"aux_files": "aux", "sources_blif": "blif", "sources_vhdl": "vhdl"}

SLICE_ROWS = 10_000  # names of files, and bytes of their content, that a task hands on at once
SLICE_BYTES = 4 << 20


# ------------------------------------------------------------------ scans
def scan_designs(spark: SparkSession, root: str) -> DataFrame:
    """Design metadata of a directory tree ``<root>/designs/<design>/design.json``."""
    return (
        spark.read.schema(schemas.DESIGNS)
        .option("multiLine", True)
        .json(f"{root}/designs/*/design.json")
    )


def scan_files(spark: SparkSession, root: str, *, sources_only: bool = True) -> DataFrame:
    """Source files of every design in a directory tree, joined to its metadata.

    Design, directory and file name come from the path, so nothing is listed
    design by design. A mounted tree (``file:``) is listed and read by tasks, and the driver
    holds nothing of its files. In another store, which only Spark reads, folders are given to
    the scan, not their files; the driver then holds a status of each file.
    ``sources_only=False`` adds the side directories and ``top.txt`` with their roles.
    """
    local, meta = _mounted(spark, root, sources_only), scan_designs(spark, root).select("design_name", "dataset_name")
    if local is None:
        files = _decode(_scanned(spark, root, sources_only)).join(meta, "design_name")
    else:
        files = _decode(_walked(spark, local, meta, sources_only), "dataset_name")
    return files.select(*[f.name for f in schemas.FILES])


def _scanned(spark: SparkSession, root: str, sources_only: bool) -> DataFrame:
    """``(path, content)`` of the files by Spark's scan of the folders."""
    folder = "sources" if sources_only else "{sources*,aux_files}"
    name = "sources" if sources_only else "(sources[^/]*|aux_files)"
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{root}/designs/*/{folder}").filter(
        F.col("path").rlike(f"/designs/[^/]+/{name}/[^/]+$"))
    if not sources_only:
        tops = spark.read.format("binaryFile").load(f"{root}/designs/*/top.txt*")
        raw = raw.unionByName(tops)
    return raw.select("path", "content")


def _mounted(spark: SparkSession, root: str, sources_only: bool) -> str | None:
    """A tree's folder as tasks name it; None for other stores, for patterns, and where Spark's scan finds no folder and says so."""
    if root.startswith("file:"):
        local = "/" + root.removeprefix("file:").lstrip("/")
    elif root.startswith("/") and spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:").startswith("file:"):
        local = root
    else:
        return None
    if any(c in local for c in "*?[]{}\\"):
        return None
    for names in [["sources"]] if sources_only else [["sources*", "aux_files"], ["top.txt*"]]:
        found = (iglob(f"{local}/designs/*/{n}", include_hidden=True) for n in names)
        if next(chain.from_iterable(found), None) is None:
            return None
    return local


def _walked(spark: SparkSession, local: str, meta: DataFrame, sources_only: bool) -> DataFrame:
    """``(path, dataset_name, content)`` of the files of the designs in ``meta`` by tasks: one lists the designs, many their folders, then the files are dealt over all.

    Only names are shuffled; as bytes, as the file system has them. Designs meet their
    metadata before they are listed, so no join has a row for a file.
    """
    tasks = n_buckets(spark)
    root = spark.range(0, 1, 1, 1).select(F.lit(local).cast("binary").alias("path"))
    designs = root.mapInArrow(_list_designs, "design_name string, path binary")
    known = designs.join(meta.hint("merge"), "design_name").select("path", "dataset_name")  # what tasks list has no size to plan by
    files = known.repartition(tasks, "path").mapInArrow(_list_files(sources_only), "path binary, dataset_name string").repartition(tasks)
    return files.mapInArrow(_read_files, "path string, dataset_name string, content binary")


def _list_designs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for root in batch.column(0).to_pylist():
            with os.scandir(root + b"/designs") as found:
                designs = ((e.name, e.path) for e in found if e.is_dir())
                while some := list(islice(designs, SLICE_ROWS)):
                    names, paths = zip(*some)
                    yield pa.RecordBatch.from_arrays([pa.array([n.decode(errors="replace") for n in names], pa.string()), pa.array(paths, pa.binary())], names=["design_name", "path"])


def _is_data(name: bytes) -> bool:
    """Names that Spark's scans read: no hidden files, and none that are being copied."""
    hidden = name.startswith(b".") or name.startswith(b"_") and b"=" not in name or name.endswith(b"._COPYING_")
    return not hidden or name.startswith((b"_metadata", b"_common_metadata"))


def _list_files(sources_only: bool):
    def of_folder(folder: bytes) -> Iterator[bytes]:
        with os.scandir(folder) as found:
            yield from (e.path for e in found if _is_data(e.name) and e.is_file())

    def of_design(design: bytes) -> Iterator[bytes]:
        with os.scandir(design) as found:
            for e in found:
                top = not sources_only and e.name.startswith(b"top.txt")
                if e.is_dir():
                    if top or (e.name == b"sources" if sources_only else e.name.startswith(b"sources") or e.name == b"aux_files"):
                        yield from of_folder(e.path)
                elif top and e.name == b"top.txt" and e.is_file():
                    yield e.path

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for design, dataset in zip(batch.column(0).to_pylist(), batch.column(1)):
                files = of_design(design)
                while some := list(islice(files, SLICE_ROWS)):
                    yield pa.RecordBatch.from_arrays([pa.array(some, pa.binary()), pa.repeat(dataset, len(some))], names=["path", "dataset_name"])

    return run


def _read_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Files with their content, in batches of bounded size; empty files have no row, as in Spark's scans."""
    for batch in batches:
        rows, size, last = [], 0, batch.num_rows - 1
        for i, (path, dataset) in enumerate(zip(*(c.to_pylist() for c in batch.columns))):
            with open(path, "rb") as f:
                content = f.read()
            if content:
                rows.append((f"file:{path.decode(errors='replace')}", dataset, content))
                size += len(content)
            if rows and (size >= SLICE_BYTES or i == last):
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.string(), pa.binary()))]
                yield pa.RecordBatch.from_arrays(columns, names=["path", "dataset_name", "content"])
                rows, size = [], 0


def _decode(raw: DataFrame, *keep: str) -> DataFrame:
    parts = F.split("path", "/")
    folder = F.element_at(parts, -2)
    is_top = F.element_at(parts, -1) == "top.txt"
    at_root = is_top & ~folder.isin("sources", *SIDE_ROLES)
    role = F.when(at_root, "top")
    for name, r in SIDE_ROLES.items():
        role = role.when(folder == name, r)
    return raw.select(
        *keep,
        F.when(at_root, folder).otherwise(F.element_at(parts, -3)).alias("design_name"),
        F.element_at(parts, -1).alias("file_name"),
        role.otherwise(X.file_role(F.col("path"))).alias("role"),
        X.normalize_newlines(X.decode_text(F.col("content"))).alias("text"),
    )


def scan_external_corpus(spark: SparkSession, path: str, text_col: str = "text") -> DataFrame:
    """A corpus given as CSV with a multi-line text column, or as Parquet."""
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path).select(text_col)
    return (
        spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path).select(text_col)
    )


# ------------------------------------------------------------------ lookups
def by_name(designs: DataFrame, name: str) -> DataFrame:
    """The design of that name: one row or none (names are unique). Pushed to the scan."""
    return designs.filter(F.col("design_name") == name).limit(1)


def by_name_regex(designs: DataFrame, pattern: str) -> DataFrame:
    """Designs whose name matches from the start (not necessarily to the end)."""
    return designs.filter(F.col("design_name").rlike(f"^(?:{pattern})"))


def by_dataset(designs: DataFrame, dataset: str) -> DataFrame:
    return designs.filter(F.col("dataset_name") == dataset)


def with_files(designs: DataFrame, files: DataFrame) -> DataFrame:
    """Corpus table: one row per file with its design's metadata."""
    meta = [c for c in designs.columns if c not in files.columns or c == "design_name"]
    return files.join(designs.select(meta), "design_name")


def files_by_extension(files: DataFrame, role: str, *, lower_only: bool = False) -> DataFrame:
    """Files of a role by extension; ``lower_only`` is the list form without upper-case names."""
    from gatelake.functions import patterns as P

    allowed = {"verilog": P.VERILOG_EXTENSIONS, "data": P.DATA_EXTENSIONS}
    allowed["source"] = allowed["verilog"] + allowed["data"]
    exts = allowed[role] if lower_only else allowed[role] + [e.upper() for e in allowed[role]]
    has_dot = F.contains(X.base_name(F.col("file_name")), F.lit("."))
    return files.filter(has_dot & X.extension(F.col("file_name")).isin(exts))


def drop_testbenches(files: DataFrame) -> DataFrame:
    return files.filter(~X.is_testbench(F.col("file_name")))


# ------------------------------------------------------------------ changes
def last_written(files: DataFrame, order: list[str] | None = None) -> DataFrame:
    """One row per (design, file name): the last write by ``order`` (default ``load_seq``) wins.

    ``files`` is a written table whose ``order`` values are unique per key.
    The losers are found from the key columns alone and taken out by an anti
    join, so the text is shuffled only when the losers are too many for the
    planner to broadcast.
    """
    keys, order = ["design_name", "file_name"], order or ["load_seq"]
    at = files.select(*keys, *order, F.struct(*order).alias("_at"))
    rewritten = at.groupBy(*keys).agg(F.max("_at").alias("_last"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    losers = at.join(rewritten, keys).filter(F.col("_at") < F.col("_last")).select(*keys, *order)
    return files.join(losers, [*keys, *order], "left_anti")


def upsert(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """Rows of designs present in ``incoming`` are replaced as a whole."""
    names = incoming.select("design_name").distinct()
    return current.join(names, "design_name", "left_anti").unionByName(incoming, allowMissingColumns=True)


def delete(designs: DataFrame, names: list[str], *, strict: bool = True) -> DataFrame:
    """All designs but the named ones. Unknown names raise when ``strict``."""
    gone = designs.filter(F.col("design_name").isin(names))
    if strict:
        known = {r[0] for r in gone.select("design_name").distinct().collect()}
        missing = sorted(set(names) - known)
        if missing:
            raise ValueError(f"designs not found: {missing}")
    return designs.filter(~F.col("design_name").isin(names))


def delete_by_table(designs: DataFrame, names: DataFrame) -> DataFrame:
    """Same for a table of names of any size."""
    return designs.join(names.select("design_name"), "design_name", "left_anti")


def unknown_names(designs: DataFrame, names: DataFrame) -> DataFrame:
    """Requested names the catalogue does not hold."""
    return names.select("design_name").distinct().join(designs, "design_name", "left_anti")


def remove_dataset(designs: DataFrame, dataset: str) -> DataFrame:
    return designs.filter(F.col("dataset_name") != dataset)


# ------------------------------------------------------------------ stored catalogue
BUCKETS = 64


class Catalogue:
    """``designs`` and ``files`` stored as Parquet, partitioned by ``dataset_name`` and by a hash of the design's name.

    Changes read and rewrite only the parts of sources that hold a design they
    touch. The new rows of both tables are written aside first; then both are
    switched, one after the other. ``buckets`` parts a source has; the number is
    the same whenever a catalogue is opened.
    """

    TABLES = {"designs": schemas.DESIGNS, "files": schemas.FILES}

    def __init__(self, spark: SparkSession, root: str, *, buckets: int = BUCKETS) -> None:
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets

    def _path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _bucket(self) -> Column:
        """Part of a source that a design belongs to."""
        return F.pmod(F.xxhash64("design_name"), F.lit(self.buckets)).cast("int").alias("bucket")

    def _stored(self, name: str) -> DataFrame:
        """A table with its ``bucket``, which filters on it prune folders by."""
        schema = T.StructType([*self.TABLES[name].fields, T.StructField("bucket", T.IntegerType())])
        try:
            return self.spark.read.schema(schema).parquet(self._path(name))
        except Exception as e:  # a catalogue that was never written is empty
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return self.spark.createDataFrame([], schema)

    def _table(self, name: str) -> DataFrame:
        return self._stored(name).select(*self.TABLES[name].fieldNames())

    @property
    def designs(self) -> DataFrame:
        return self._table("designs")

    @property
    def files(self) -> DataFrame:
        return self._table("files")

    def index(self) -> DataFrame:
        return self.designs.orderBy("design_name")

    def create(self, designs: DataFrame, files: DataFrame, *, overwrite: bool = False) -> None:
        """First load. A catalogue that already holds designs is an error unless ``overwrite``."""
        if not overwrite and not self.designs.isEmpty():
            raise FileExistsError(f"catalogue at {self.root} is not empty")
        for name, df in (("designs", designs), ("files", files)):
            self._write(df, name, "overwrite")

    def upsert(self, designs: DataFrame, files: DataFrame) -> None:
        """Replace designs by name; a design that moved to another source leaves its old one."""
        designs = materialize(designs, "incoming_designs")
        files = materialize(files, "incoming_files")
        self._change(designs.select("design_name"), {"designs": designs, "files": files})

    def delete(self, names: list[str]) -> None:
        delete(self.designs, names)  # raises on unknown names
        self.delete_by_table(self.spark.createDataFrame([(n,) for n in names], "design_name string"))

    def delete_by_table(self, names: DataFrame) -> None:
        """Same for a table of names of any size; unknown names are no error (``unknown_names`` lists them)."""
        self._change(names.select("design_name"), {})

    def delete_all(self) -> None:
        for name, schema in self.TABLES.items():
            self._write(self.spark.createDataFrame([], schema), name, "overwrite")

    def remove_dataset(self, dataset: str) -> None:
        """Drops the folders of a source; nothing is rewritten."""
        for name in self.TABLES:
            self._remove(f"{self._path(name)}/dataset_name={dataset}")

    def _change(self, names: DataFrame, incoming: dict[str, DataFrame]) -> None:
        """Takes the named designs out of both tables and puts ``incoming`` rows in."""
        names = materialize(names.distinct(), "names")
        every = reduce(DataFrame.unionByName, [df.select("design_name") for df in (names, *incoming.values())])
        buckets = [r[0] for r in every.select(self._bucket()).distinct().collect()]  # as many numbers as buckets
        changes = {}
        for name in self.TABLES:
            current = self._stored(name).where(F.col("bucket").isin(buckets))
            parts = current.join(names, "design_name", "left_semi").select("dataset_name", "bucket")
            new = incoming.get(name)
            if new is not None:
                parts = parts.unionByName(new.select("dataset_name", self._bucket()))
            touched = {tuple(r) for r in parts.distinct().collect()}  # at most sources times buckets
            if touched:
                of = {s: [b for t, b in touched if t == s] for s in {t for t, _ in touched}}
                here = reduce(Column.__or__, [(F.col("dataset_name") == s) & F.col("bucket").isin(bs) for s, bs in of.items()])
                rows = current.where(here).join(names, "design_name", "left_anti").select(*self.TABLES[name].fieldNames())
                if new is not None:
                    rows = rows.unionByName(new.select(*rows.columns))
                changes[name] = (materialize(rows, f"staged_{name}"), touched)
        for name, (rows, touched) in changes.items():
            left = {tuple(r) for r in rows.select("dataset_name", self._bucket()).distinct().collect()}
            self._write(rows, name, "overwrite", dynamic=True)
            for source, bucket in touched - left:
                self._remove(f"{self._path(name)}/dataset_name={source}/bucket={bucket}")

    def _remove(self, folder: str) -> None:
        """Drop the folder of a part that has no rows left."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def _write(self, df: DataFrame, name: str, mode: str, *, dynamic: bool = False) -> None:
        # rows of a part meet in one task; parts larger than the advisory partition size are split over several
        writer = df.withColumn("bucket", self._bucket()).hint("rebalance", "dataset_name", "bucket").write.mode(mode).partitionBy("dataset_name", "bucket")
        if dynamic:
            writer = writer.option("partitionOverwriteMode", "dynamic")
        writer.parquet(self._path(name))
