"""Mixing of sources to target shares of the corpus's tokens.

Each document gets a hash as random key.  The keys of a source are cut into
equal ranges; token sums of the ranges give distributed prefix sums, and a
window inside a range continues them, so no source is ever sorted in one task.
A source whose budget exceeds its tokens runs in whole epochs and one part of
an epoch, up to its cap.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.functions.scale import cut
from foliospark.llm.tokenize import encode_table


@dataclass(frozen=True)
class Settings:
    #: Ranges of keys that each source is cut into; null: as many as hold about ``range_rows`` documents each, so they
    #: follow the data (the choice does not depend on them).
    ranges: int | None = None
    range_rows: int = 50_000
    seed: int = 42
    #: Tokens of the mixed corpus; null: as many as the sources can give at their shares.
    total_tokens: int | None = None


def source_key(source: Column) -> Column:
    """Spelling-free name of a source: lower case, blanks and hyphens as one underscore, none at the ends; null for an
    empty one.
    """
    name = F.regexp_replace(F.lower(source), r"[\s\p{Z}_-]+", "_")
    name = F.regexp_replace(name, r"^_+|_+$", "")
    return F.when(name != "", name)


def budgets(sizes: DataFrame, targets: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per target source: source, target_share, max_repeats, docs, source_tokens, budget (tokens).

    The corpus is as large as the scarcest source allows: the least of
    ``source_tokens * max_repeats / share`` over the sources with a positive
    share, and at most ``total_tokens``.  A source without tokens is left out of
    that (its budget is 0), as is a share that is null or not positive, or a cap
    under 1; the budgets of the others keep their proportions.
    """
    wanted = targets.select(source_key(F.col("source")).alias("source"), "target_share", "max_repeats").where(F.col("source").isNotNull()).groupBy("source").agg(
        F.sum("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats")
    )
    have = sizes.groupBy("source").agg(F.count("*").alias("docs"), F.sum("n_tokens").alias("source_tokens"))
    rows = wanted.join(have, "source", "left").select(
        "source", "target_share", "max_repeats", F.coalesce("docs", F.lit(0)).alias("docs"),
        F.coalesce("source_tokens", F.lit(0)).alias("source_tokens")
    )
    usable = (F.col("target_share") > 0) & (F.col("max_repeats") >= 1) & (F.col("source_tokens") > 0)
    reach = F.min(  # a row per source
        F.when(usable, F.col("source_tokens") * F.col("max_repeats") / F.col("target_share"))
    ).over(Window.partitionBy())
    if settings.total_tokens is not None:
        reach = F.least(reach, F.lit(float(settings.total_tokens)))
    return rows.withColumn(
        "budget",
        F.when(usable, F.round(reach * F.col("target_share")).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
    )


def sized(documents: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, source (spelling-free), n_tokens of the documents that have a source."""
    return encode_sizes(
        documents.select(
            "doc_id", "text", source_key(F.col("source")).alias("source")
        ).where(F.col("source").isNotNull()),
        path
    )


def encode_sizes(df: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, source, n_tokens``."""
    return encode_table(df, "doc_id", "text", path, count_only=True, keep=("source",))


def mix(sizes: DataFrame, targets: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, source, n_tokens, copies of each document in the mixed corpus (documents that are not in it have no row).

    Every document of a source is taken for each whole epoch of its budget; of
    the last, partial epoch those whose prefix sum of tokens, in key order, stays
    within the rest, and the next one too if that comes nearer to it (never above
    max_repeats).  Documents without tokens have no size and no row.
    """
    plan = budgets(sizes, targets, settings).withColumn(
        "ranges", F.lit(settings.ranges) if settings.ranges else F.ceil((F.col("docs") + 1) / settings.range_rows)
    ).where(F.col("budget") > 0).withColumn("epochs", F.floor(F.col("budget") / F.col("source_tokens"))).withColumn(
        "rest", F.col("budget") - F.col("epochs") * F.col("source_tokens")
    )
    # a row per target source (Spark broadcasts it if its size allows); other sources end here
    keyed = sizes.where(F.col("n_tokens") > 0).join(
        plan.select("source", "max_repeats", "epochs", "rest", "ranges"), "source"
    ).withColumn("key", F.xxhash64(F.lit(settings.seed), "doc_id"))
    # division rounds, but never against the order of the keys
    keyed = keyed.withColumn("range", F.floor(F.col("key") / (F.lit(2.0**64) / F.col("ranges"))))
    sums = keyed.groupBy("source", "range").agg(F.sum("n_tokens").alias("tokens"))
    # a row for each range: one short sort per source
    before = F.coalesce(
        F.sum("tokens").over(Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)
    )
    starts = sums.select("source", "range", before.alias("before"))
    inner = F.sum("n_tokens").over(
        Window.partitionBy("source", "range").orderBy("key", "doc_id").rowsBetween(
            Window.unboundedPreceding, Window.currentRow
        )
    )
    placed = keyed.withColumn("within", inner).join(starts, ["source", "range"])
    end = F.col("before") + F.col("within")
    begin = end - F.col("n_tokens")
    partly = (end <= F.col("rest")) | ((begin < F.col("rest")) & (end - F.col("rest") < F.col("rest") - begin))
    copies = F.col("epochs") + F.when(partly & (F.col("epochs") < F.col("max_repeats")), 1).otherwise(0)
    return placed.select("doc_id", "source", "n_tokens", copies.cast("int").alias("copies")).where("copies > 0")


def shares(sizes: DataFrame, targets: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Of each target source: target_share, actual_share, budget, tokens, source_tokens, docs, docs_used, most_copies.
    """
    sizes = cut(sizes)
    taken = mix(sizes, targets, settings).groupBy("source").agg(
        F.sum(F.col("n_tokens") * F.col("copies")).alias("tokens"), F.count("*").alias("docs_used"),
        F.max("copies").alias("most_copies")
    )
    rows = budgets(sizes, targets, settings).join(taken, "source", "left").select(
        "source", "target_share", "max_repeats", "docs", "source_tokens", "budget",
        F.coalesce("tokens", F.lit(0)).alias("tokens"), F.coalesce("docs_used", F.lit(0)).alias("docs_used"),
        F.coalesce("most_copies", F.lit(0)).alias("most_copies")
    )
    total = F.sum("tokens").over(Window.partitionBy())  # a row per source
    return rows.withColumn("actual_share", F.when(total > 0, F.col("tokens") / total))
