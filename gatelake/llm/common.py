"""Column helpers shared by the operators: word lists, keys, tables."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WHITE = r"[\x20\x09-\x0D]+"
NON_ALNUM = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only; the fast ``lower`` is the same where every character is ASCII."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def words(text: Column, separator: str = WHITE) -> Column:
    """Words of a text between separators; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separator), "")


def alnum_words(text: Column) -> Column:
    """Lower-cased words of ASCII letters, digits and any non-ASCII characters."""
    return words(ascii_lower(F.coalesce(text, F.lit(""))), NON_ALNUM)


def bind(value: Column, body) -> Column:
    """``body(x)`` with ``x`` evaluated once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def content_key(*cols: Column) -> list[Column]:
    """128 bits over the given columns: equal rows share a key, nulls included."""
    return [F.xxhash64(*cols), F.xxhash64(F.lit(1), *reversed(cols))]


def free_names(df: DataFrame, *names: str) -> list[str]:
    """``names`` for helper columns, lengthened where ``df`` has a column of that name."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out
