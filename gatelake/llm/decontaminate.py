"""Benchmark decontamination by word windows.

Every window of ``n`` consecutive words of a benchmark item (or the whole item
where it is shorter) goes into a hash table. Document windows are hashed in the
row, looked up by a broadcast hash join and verified by comparing the words.
The table is broadcast only up to ``max_windows`` windows; a larger benchmark is
scanned in blocks of that size, each against all documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatelake.llm.common import alnum_words, bind, content_key, free_names
from gatelake.session import materialize

WINDOW = 13
MAX_WINDOWS = 500_000


def _window_hashes(hashes: Column, k: int) -> Column:
    last = F.size(hashes) - k
    return F.when(last < 0, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.xxhash64(F.slice(hashes, i + 1, k)))
    )


def _word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def benchmark_windows(benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """``item_id, k, h, window``: one row per item and distinct window; items without words have none."""
    items = benchmark.select(
        F.col("item_id"), alnum_words(F.col("text")).alias("w")
    ).where(F.size("w") > 0).withColumn("k", F.least(F.size("w"), F.lit(n)))
    starts = F.sequence(F.lit(0), F.size("w") - F.col("k"))
    return (
        items.select("item_id", "k", F.explode(F.transform(starts, lambda i: F.slice("w", i + 1, F.col("k")))).alias("s"))
        .select("item_id", "k", F.xxhash64(_word_hashes(F.col("s"))).alias("h"), F.array_join("s", " ").alias("window"))
        .distinct()
    )


def _scan(numbered: DataFrame, windows: DataFrame, lengths: list[int]) -> DataFrame:
    """One row per document (``pos`` 0) and one per verified window occurrence."""
    base = numbered.select("rid", "doc_id", alnum_words(F.col("text")).alias("w"))
    marks = F.array(F.lit(None).cast("bigint"))
    hashed = base.select(
        "rid", "doc_id", "w", F.size("w").alias("n_words"),
        bind(_word_hashes(F.col("w")), lambda hw: F.concat(marks, *[_window_hashes(hw, k) for k in lengths])).alias("hs"),
    )
    rows = hashed.select("rid", "doc_id", "w", "n_words", F.posexplode("hs").alias("pos", "h"))
    # the array holds the mark, then the windows of each length in turn
    k, start, offset = F.lit(None).cast("int"), F.lit(None).cast("int"), F.lit(1)
    for length in lengths:
        here = F.col("pos") >= offset
        k, start = F.when(here, F.lit(length)).otherwise(k), F.when(here, F.col("pos") - offset).otherwise(start)
        offset = offset + F.greatest(F.col("n_words") - length + 1, F.lit(0))
    found = rows.join(F.broadcast(windows), "h", "left").where(
        (F.col("pos") == 0)
        | ((F.col("window_k") == k) & (F.col("window") == F.array_join(F.slice("w", start + 1, F.greatest(k, F.lit(0))), " ")))
    )
    return found.select("rid", "doc_id", "n_words", "pos", start.alias("start"), k.alias("k"), "wid")


def find_hits(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans``.

    ``spans`` are the merged ``[start, end)`` ranges of hit words. Null or empty
    texts have no words and no hits; repeated rows each get their own row; a null
    ``doc_id`` is kept. An empty benchmark gives no hits. Other columns are ignored.
    """
    members = materialize(benchmark_windows(benchmark, n), "windows")
    distinct = members.select("h", "k", "window").distinct()
    size = distinct.groupBy("k").count().collect()  # at most n rows
    lengths = sorted(r["k"] for r in size) or [n]
    blocks = max(1, -(-sum(r["count"] for r in size) // max_windows))
    keyed = distinct.select("h", F.col("k").alias("window_k"), "window", F.sha2("window", 256).alias("wid"))
    numbered = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "text")
    if blocks > 1:  # every block's scan must see the same numbers
        numbered = materialize(numbered, "numbered")
    scans = []
    for b in range(blocks):
        part = keyed.where(F.pmod(F.xxhash64("wid"), F.lit(blocks)) == b) if blocks > 1 else keyed
        scan = _scan(numbered, part, lengths)
        scans.append(scan if b == 0 else scan.where("pos > 0"))
    hits = scans[0]
    for s in scans[1:]:
        hits = hits.unionByName(s)
    hits = materialize(hits, "hits")
    ranges = F.array_sort(F.collect_set(F.when(F.col("pos") > 0, F.struct(F.col("start").alias("s"), (F.col("start") + F.col("k")).alias("e")))))
    per_doc = hits.groupBy("rid").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_words").cast("bigint").alias("n_words"), ranges.alias("ranges")
    )
    item_ids = (
        hits.where("pos > 0").select("rid", "wid").distinct()
        .join(members.select("item_id", F.sha2("window", 256).alias("wid")), "wid")
        .groupBy("rid").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("ids"))
    )
    out = per_doc.join(item_ids, "rid", "left").withColumn("spans", _merged(F.col("ranges")))
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, r: a + r["e"] - r["s"])
    ids = F.coalesce(F.col("ids"), F.array().cast("array<string>"))
    return out.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(ids).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"), "spans",
    )


def _merged(ranges: Column) -> Column:
    """Overlapping or touching ranges, sorted by start, joined into one each."""
    empty = F.array().cast("array<struct<s:int,e:int>>")

    def step(acc: Column, r: Column) -> Column:
        last = F.get(acc, F.size(acc) - 1)
        grown = F.concat(
            F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))),
            F.array(F.struct(last["s"].alias("s"), F.greatest(last["e"], r["e"]).alias("e"))),
        )
        return F.when((F.size(acc) > 0) & (r["s"] <= last["e"]), grown).otherwise(F.concat(acc, F.array(r)))

    return F.aggregate(ranges, empty, step)


def remove(docs: DataFrame, benchmark: DataFrame, mode: str = "documents", n: int = WINDOW) -> DataFrame:
    """``docs`` without what the benchmark contaminates; columns as given.

    ``documents`` drops contaminated documents; ``spans`` keeps every document and
    cuts the hit words, with the separator before each, out of its text. Null and
    empty texts stay; repeated rows and rows with a null ``doc_id`` are judged one by
    one by their texts; other columns may have any names.
    """
    k1, k2, spans = free_names(docs, "_k1", "_k2", "_spans")
    keyed = docs.withColumns(dict(zip((k1, k2), content_key(F.col("doc_id"), F.col("text")))))
    hits = find_hits(keyed.select(F.struct(F.col(k1).alias("a"), F.col(k2).alias("b")).alias("doc_id"), "text"), benchmark, n)
    key = [F.col("doc_id.a").alias(k1), F.col("doc_id.b").alias(k2)]
    if mode == "documents":
        bad = hits.where("contaminated").select(*key).distinct()
        return keyed.join(bad, [k1, k2], "left_anti").select(*docs.columns)
    if mode != "spans":
        raise ValueError(f"mode {mode!r}")
    cut = hits.where("n_hit > 0").select(*key, F.col("spans").alias(spans)).distinct()
    word = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]*[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    pieces = F.regexp_extract_all(F.col("text"), F.lit(word), F.lit(0))
    kept = F.filter(pieces, lambda p, i: ~F.exists(F.col(spans), lambda r: (i >= r["s"]) & (i < r["e"])))
    tail = F.regexp_extract("text", r"[\x00-\x2F\x3A-\x60\x7B-\x7F]*\z", 0)
    text = F.when(F.col(spans).isNull(), F.col("text")).otherwise(F.concat(F.array_join(kept, ""), tail))
    return keyed.join(cut, [k1, k2], "left").withColumn("text", text).select(*docs.columns)
