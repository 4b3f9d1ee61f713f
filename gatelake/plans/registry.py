"""Registry of named queries and the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gatelake.plans.corpora import corpus, corpus_ctes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Source:
    """Given and derived tables of one scale-factor folder, by name."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir

    def __call__(self, name: str) -> DataFrame:
        return corpus(self.spark, self.sf_dir, name)


def query(name: str, oracle: str | None = None, reads: tuple[str, ...] = ()):
    """Register ``fn(src) -> DataFrame``; ``oracle`` may use the CTEs of ``reads``."""

    def register(fn: Callable[[Source], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(Source(spark, sf_dir))
        if oracle is not None:
            ctes = corpus_ctes(*reads)
            body = oracle.strip()
            if not ctes:
                ORACLES[name] = body
            elif body.upper().startswith("WITH RECURSIVE "):
                ORACLES[name] = f"WITH RECURSIVE {ctes}, {body[len('WITH RECURSIVE '):]}"
            elif body.upper().startswith("WITH "):
                ORACLES[name] = f"WITH {ctes}, {body[5:]}"
            else:
                ORACLES[name] = f"WITH {ctes} {body}"
        return fn

    return register
