"""Token and character counts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatelake.functions import patterns as P
from gatelake.functions import text as X

FILE_KEYS = ["dataset_name", "design_name", "file_name"]


def token_counts(
    files: DataFrame,
    rules: list[str] | None = None,
    encoders: dict[str, Callable[[], Callable[[str], list]]] | None = None,
) -> DataFrame:
    """Long table ``(dataset_name, design_name, file_name, tokenizer, num_tokens)``.

    ``rules`` are built-in: ``chars4`` (a quarter of the characters, rounded
    up), ``word_punct`` and ``hdl``. ``encoders`` maps a name to a factory of
    an ``encode(text) -> tokens`` function; each is built once per Python
    worker and applied to Arrow batches. All tokenizers share one scan.
    """
    rules = rules if rules is not None else ["chars4", *P.TOKEN_RULES]
    t = F.col("text")
    counts = []
    for r in rules:
        n = F.ceil(F.length(t) / 4) if r == "chars4" else X.count_matches(t, P.TOKEN_RULES[r])
        counts.append(F.struct(F.lit(r).alias("tokenizer"), n.cast("long").alias("num_tokens")))
    for name, factory in (encoders or {}).items():
        counts.append(F.struct(F.lit(name).alias("tokenizer"), _encoder_udf(factory)(t).alias("num_tokens")))
    return files.select(*FILE_KEYS, F.explode(F.array(*counts)).alias("c")).select(
        *FILE_KEYS, "c.tokenizer", "c.num_tokens")


def _encoder_udf(factory: Callable[[], Callable[[str], list]]):
    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = factory()
        for texts in batches:
            yield texts.map(lambda s: len(encode(s)))

    return count


def tokens_by(counts: DataFrame, *keys: str, tokenizer: str | None = None) -> DataFrame:
    """Token sums by any keys (none for the total), for one tokenizer or for each."""
    if tokenizer is not None:
        counts = counts.filter(F.col("tokenizer") == tokenizer)
    return counts.groupBy(*keys).agg(F.sum("num_tokens").alias("num_tokens"))


def _char_rows(keys: list[str], only: np.ndarray | None):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows, codes, counts = [], [], []
            for i, text in enumerate(pdf["text"]):
                points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
                c, n = np.unique(points, return_counts=True)
                if only is not None:
                    m = np.isin(c, only)
                    c, n = c[m], n[m]
                rows.append(np.full(len(c), i))
                codes.append(c)
                counts.append(n)
            if not rows or not sum(map(len, rows)):
                continue  # only empty texts in this batch
            out = pdf[keys].iloc[np.concatenate(rows)].reset_index(drop=True)
            out["ch"] = [chr(x) for x in np.concatenate(codes)]
            out["n"] = np.concatenate(counts).astype("int64")
            yield out

    return run


def char_frequencies(files: DataFrame, keys: list[str], vocabulary: str | None = None) -> DataFrame:
    """``(*keys, ch, n)``: characters of each text with their counts.

    One row per text and distinct character is produced inside the task
    (vectorised over code points), instead of exploding one row per character.
    """
    only = np.array([ord(c) for c in vocabulary], dtype=np.uint32) if vocabulary else None
    fields = ", ".join(f"`{k}` {files.schema[k].dataType.simpleString()}" for k in keys)
    return files.select(*keys, "text").mapInPandas(_char_rows(keys, only), f"{fields}, ch string, n bigint")


def printable_counts(files: DataFrame) -> DataFrame:
    """Counts over the fixed 100 printable characters, case kept, per file."""
    return char_frequencies(files, FILE_KEYS, P.PRINTABLE)
