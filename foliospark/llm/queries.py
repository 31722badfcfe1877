"""Named queries of the operators for training-data text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from foliospark.functions.scale import cut
from foliospark.llm import lookalike, mixture, quality, reading, scan, split, tokenize
from foliospark.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]


def _pieces(spark: SparkSession, sf_dir: str, with_text: bool) -> DataFrame:
    items = split.all_items(table(spark, sf_dir, "document_blocks"), table(spark, sf_dir, "page_results"))
    return split.split_items(items, table(spark, sf_dir, "split_limits"), with_text)


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan.found(table(spark, sf_dir, "document_blocks"))


def p1_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan.repair_both(table(spark, sf_dir, "document_blocks"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pieces(spark, sf_dir, False).where("piece_no = 2").select("item_kind", "item_id")


def p2_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pieces(spark, sf_dir, True)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.found(table(spark, sf_dir, "document_blocks"))


def p3_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.document_stats(table(spark, sf_dir, "document_blocks"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalike.found(table(spark, sf_dir, "document_blocks"), table(spark, sf_dir, "courses"))


def p4_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalike.consistent_names(table(spark, sf_dir, "courses"), table(spark, sf_dir, "course_names"))


def p4_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalike.fold_table(table(spark, sf_dir, "document_blocks"), "block_uid", "raw_content")


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenize.encode_table(table(spark, sf_dir, "documents"))


def p7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.mix(cut(mixture.sized(table(spark, sf_dir, "documents"))), table(spark, sf_dir, "mix_targets"))


def p7_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.shares(mixture.sized(table(spark, sf_dir, "documents")), table(spark, sf_dir, "mix_targets"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reading.found(table(spark, sf_dir, "documents"), table(spark, sf_dir, "level_labels"))


def p8_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reading.levels(table(spark, sf_dir, "documents"), table(spark, sf_dir, "level_labels"))


QUERIES: dict[str, Query] = {
    "p1_found": p1_found, "p1_repair": p1_repair, "p2_found": p2_found, "p2_pieces": p2_pieces, "p3_found": p3_found,
    "p3_stats": p3_stats, "p4_found": p4_found, "p4_names": p4_names, "p4_blocks": p4_blocks, "p6_ids": p6_ids,
    "p7_mix": p7_mix, "p7_shares": p7_shares, "p8_found": p8_found, "p8_levels": p8_levels
}
_WHITE = "'[\\s\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}\\x0b\\x1c-\\x1f]+'"


def _strip(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^' || {_WHITE}, ''), {_WHITE} || '$', '')"


ORACLE: dict[str, str] = {
    "p2_found": f"""SELECT DISTINCT 'block' AS item_kind, block_uid AS item_id FROM document_blocks JOIN split_limits ON item_kind = block_type WHERE length({_strip('markdown_result')}) > max_chars
UNION SELECT 'page', page_uid FROM (SELECT page_uid, string_agg(t, E'\\n\\n' ORDER BY block_id) AS t FROM (SELECT page_uid, b.block_id AS block_id, any_value({_strip('b.markdown_result')}) AS t FROM (SELECT page_uid, unnest(blocks) AS b FROM page_results) WHERE b.markdown_result IS NOT NULL AND {_strip('b.markdown_result')} <> '' GROUP BY ALL) GROUP BY page_uid), split_limits WHERE item_kind = 'page' AND length(t) > max_chars""",
}
