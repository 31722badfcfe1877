"""Listing of input files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_files(
    spark: SparkSession, folder: str, glob: str = "*.pdf", contains: str | None = None, skip: list[str] | None = None,
    with_content: bool = False
) -> DataFrame:
    """Files directly in ``folder``, by name: name, path, size_bytes, modified (and content).

    The reader prunes the content column when it is not asked for, and passes by
    files without content.  ``contains``
    is a part of the name in any case, ``skip`` a list of names to leave out.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option(
        "recursiveFileLookup", "false"
    ).load(folder)
    name = F.url_decode(F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\+", "%2B"))
    out = files.select(
        name.alias("name"), "path", F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified"),
        *(["content"] if with_content else [])
    )
    if contains is not None:
        out = out.where(F.contains(F.lower("name"), F.lit(contains.lower())))
    if skip:
        out = out.where(~F.col("name").isin(*skip))
    return out.orderBy("name")


def size_mb(size_bytes):
    return size_bytes / 1e6


def page_counts(pages: DataFrame) -> DataFrame:
    """doc, pages: highest page number of each document."""
    return pages.groupBy("doc").agg(F.max("page").alias("pages"))


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """query_id, payload: payloads kept as text, to be parsed with a fixed schema later (no inference pass)."""
    return spark.read.schema("query_id bigint, payload string").json(path)
