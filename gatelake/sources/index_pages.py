"""Repository index pages and core manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatelake import schemas
from gatelake.sources.sinks import write_csv


def page_items(pages: DataFrame) -> DataFrame:
    """``pages(page, json)`` → ``(page, id, full_name, html_url)`` per search hit."""
    return pages.select("page", F.explode(F.from_json("json", schemas.REPO_PAGE)["items"]).alias("i")).select(
        "page", "i.id", "i.full_name", "i.html_url")


def merge_index_pages(pages: DataFrame, target: str = "repo_index") -> DataFrame:
    """Write the hits of all pages as CSV and read them back as one table; files follow the tasks, not the pages."""
    path = write_csv(page_items(pages).drop("page"), target)
    return pages.sparkSession.read.schema(schemas.REPO_INDEX).option("header", True).option("escape", '"').csv(path)


def distinct_repos(pages: DataFrame) -> DataFrame:
    return page_items(pages).select("full_name").distinct()


def manifest_names(manifests: DataFrame) -> DataFrame:
    """The top-level ``name:`` field of each YAML-like manifest text."""
    others = [c for c in manifests.columns if c != "text"]
    return manifests.select(*others, F.regexp_extract("text", r"(?m)^name\s*:\s*(\S+)", 1).alias("name"))
