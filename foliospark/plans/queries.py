"""Named queries of the core on the project's tables, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.functions import text as T
from foliospark.functions.scale import broadcast_if, cut
from foliospark.operators import assemble, context, layout, pages, retrieval, transcript, units, weather
from foliospark.plans.oracle import ORACLE as ORACLE
from foliospark.sources import files
from foliospark.sources.tables import table
from foliospark.streaming import events as streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
PAGE = (595.0, 842.0)
#: The what-if grades of the simulation queries: ord, code, semester, whether it is given, grade.
OVERRIDES = [
    (0, "KD2416", None, False, "C"), (1, "KD2416", None, False, "A"), (2, "QX1010", "20201", True, "B+"),
    (3, "VT1047", None, True, "F"), (4, "ZN1121", None, False, "W")
]


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _once(df: DataFrame, key: str, *drop: str, by: tuple[str, ...] = ()) -> DataFrame:
    """A table without its repeated deliveries.  ``by`` are columns that the key decides and that later steps group
    by: rows are then shuffled by them once, for both.
    """
    df = df.drop(*drop)
    return df.repartition(*by).dropDuplicates([*by, key]) if by else df.dropDuplicates([key])


def _courses(spark: SparkSession, sf: str) -> DataFrame:
    return _once(table(spark, sf, "courses"), "course_uid", "loaded_at", by=("transcript_id",))


def _blocks(spark: SparkSession, sf: str) -> DataFrame:
    return _once(table(spark, sf, "document_blocks"), "block_uid", "ingested_at", by=("doc", "page"))


def _pages(spark: SparkSession, sf: str) -> DataFrame:
    return assemble.page_markdown(_blocks(spark, sf)).select("doc", "page", "markdown")


def _dims(blocks: DataFrame) -> DataFrame:
    return blocks.select("doc", "page").distinct().select(
        "doc", "page", F.lit(PAGE[0]).alias("width"), F.lit(PAGE[1]).alias("height")
    )


def _boxes(blocks: DataFrame) -> DataFrame:
    return blocks.where(F.col("block_type").isin("text", "unknown")).select(
        "doc", "page", "bbox.x0", "bbox.y0", "bbox.x1", "bbox.y1"
    )


def _headings(blocks: DataFrame) -> DataFrame:
    return blocks.where(F.col("heading_level").isNotNull()).select(
        "doc", (F.col("page").cast("bigint") * 100000 + F.col("block_id")).alias("ord"),
        F.col("heading_level").alias("level"), T.strip(F.col("raw_content")).alias("title"), "page"
    )


# transcripts


@query
def gpa_by_semester(spark: SparkSession, sf: str) -> DataFrame:
    return transcript.gpa_by_semester(_courses(spark, sf), ("transcript_id",))


@query
def cpa_best_attempt(spark: SparkSession, sf: str) -> DataFrame:
    return transcript.cpa(_courses(spark, sf), ("transcript_id",))


@query
def cpa_up_to(spark: SparkSession, sf: str) -> DataFrame:
    return transcript.cpa(_courses(spark, sf), ("transcript_id",), "20203")


@query
def best_attempts(spark: SparkSession, sf: str) -> DataFrame:
    best = transcript.best_attempts(_courses(spark, sf), ("transcript_id",))
    return best.select(
        "transcript_id", "code", "semester", "credits", "letter_grade", "points",
        F.col("first_attempt.semester").alias("first_semester")
    )


@query
def cpa_per_semester(spark: SparkSession, sf: str) -> DataFrame:
    return transcript.cpa_per_semester(_courses(spark, sf), ("transcript_id",))


def _overrides(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        OVERRIDES, "ord int, code string, semester string, semester_given boolean, letter_grade string"
    )


@query
def simulate_gpas(spark: SparkSession, sf: str) -> DataFrame:
    return transcript.simulate(_courses(spark, sf), _overrides(spark), ("transcript_id",))[0]


@query
def simulate_cpa(spark: SparkSession, sf: str) -> DataFrame:
    return transcript.simulate(_courses(spark, sf), _overrides(spark), ("transcript_id",), "20231")[1]


@query
def semester_list(spark: SparkSession, sf: str) -> DataFrame:
    return transcript.semesters(table(spark, sf, "courses"))


def _positioned(courses: DataFrame) -> DataFrame:
    """Courses as positioned text: each transcript a document, a semester header above each semester's first row,
    cells side by side.
    """
    c = courses.withColumn("name", F.regexp_replace("name", r"[\p{Z}\s]+", " "))
    cells = F.array(
        "code", "name", F.col("credits").cast("string"), "class_id", F.col("process_score").cast("string"),
        F.col("exam_score").cast("string"), "letter_grade"
    )
    rows = c.select(
        "transcript_id", "ord", "semester", F.posexplode(cells).alias("i", "text")
    ).where(F.col("text").isNotNull())
    y = (F.col("ord") * 2 + 1) * 12.0
    cell_rows = rows.select(
        F.col("transcript_id").cast("string").alias("doc"), F.lit(1).alias("page"),
        (F.col("ord") * 20 + F.col("i") + 1).alias("ord"), (F.col("i") * 60.0).alias("x0"), y.alias("y0"), "text"
    )
    heads = c.select(
        F.col("transcript_id").cast("string").alias("doc"), F.lit(1).alias("page"), (F.col("ord") * 20).alias("ord"),
        F.lit(0.0).alias("x0"), (F.col("ord") * 24.0).alias("y0"), F.col("semester").alias("text")
    )
    # after the fifth course of every seventh transcript stands the caption that ends them
    ends = c.where((F.col("transcript_id") % 7 == 0) & (F.col("ord") == 0)).select(
        F.col("transcript_id").cast("string").alias("doc"), F.lit(1).alias("page"), F.lit(99).alias("ord"),
        F.lit(0.0).alias("x0"), F.lit(0.0).alias("y0"), F.lit(f"  {transcript.END_MARKER}: ").alias("text")
    )
    return cell_rows.unionByName(heads).unionByName(ends)


@query
def parse_courses(spark: SparkSession, sf: str) -> DataFrame:
    return transcript.parse_courses(_positioned(_courses(spark, sf))).drop("page", "y")


@query
def transcript_json(spark: SparkSession, sf: str) -> DataFrame:
    return transcript.transcript_json(_courses(spark, sf), ("transcript_id",), "ord")


@query
def page_raw_text(spark: SparkSession, sf: str) -> DataFrame:
    return transcript.page_text(
        _blocks(spark, sf).select("doc", "page", F.col("block_id").alias("ord"), F.col("raw_content").alias("text"))
    ).select("doc", F.md5("text").alias("digest"))


# weather


@query
def code_labels(spark: SparkSession, sf: str) -> DataFrame:
    return _once(table(spark, sf, "current_weather"), "obs_id", "received_at").select(
        "obs_id", weather.describe(F.col("weather_code")).alias("label")
    )


def _weather_inputs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Requests, lookup payloads and forecast payloads as a service would have sent them; every seventh place is not
    found, every eleventh payload is no object, every thirteenth request has unknown units and every seventeenth no
    location.
    """
    w = _once(table(spark, sf, "current_weather"), "obs_id", "received_at").join(table(spark, sf, "places"), "place_id")
    queries = w.select(
        F.col("obs_id").alias("query_id"),
        F.when(F.col("obs_id") % 17 == 0, "").otherwise(F.col("name")).alias("location"),
        F.lit(None).cast("string").alias("language"),
        F.when(F.col("obs_id") % 13 == 0, "stone").otherwise(F.col("units")).alias("units"), (F.col("obs_id") % 2 == 0).alias("include_forecast")
    )
    place = F.struct("name", "country", "admin1", "latitude", "longitude", "timezone")
    found = F.when(F.col("obs_id") % 7 == 0, F.lit('{"results": []}')).otherwise(
        F.to_json(F.struct(F.array(place).alias("results")))
    )
    now = F.struct("time", "weather_code", *[F.col(k).alias(v) for k, v in weather.MEASURES.items()])
    given = F.struct(
        F.col("temperature_unit").alias("temperature_2m"), F.col("wind_speed_unit").alias("wind_speed_10m")
    )
    days = F.struct(
        F.transform(F.sequence(F.lit(1), F.lit(3)), lambda i: F.concat(F.lit("d"), i.cast("string"))).alias("time"),
        F.array("weather_code").alias("weather_code"),
        F.array("temperature", "apparent_temperature").alias("temperature_2m_max")
    )
    body = F.to_json(
        F.struct(
            now.alias("current"), given.alias("current_units"), F.when(F.col("obs_id") % 2 == 0, days).alias("daily")
        )
    )
    return queries, w.select(F.col("obs_id").alias("query_id"), found.alias("payload")), w.select(
        F.col("obs_id").alias("query_id"),
        F.when(F.col("obs_id") % 11 == 0, F.lit("[1]")).otherwise(body).alias("payload")
    )


@query
def weather_results(spark: SparkSession, sf: str) -> DataFrame:
    q, places, forecasts = _weather_inputs(spark, sf)
    r = weather.parse_forecasts(weather.locate(weather.check_queries(q), places), forecasts)
    return r.select(
        "query_id", F.col("result.location.name").alias("place"),
        F.col("result.current.temperature").alias("temperature"),
        F.col("result.current.weather_description").alias("label"),
        F.col("result.current.temperature_unit").alias("unit"),
        F.col("result.current.precipitation_unit").alias("rain_unit"),
        F.when(F.col("result").isNotNull(), F.size("result.daily_forecast")).alias("days"), "error"
    )


@query
def weather_days(spark: SparkSession, sf: str) -> DataFrame:
    q, places, forecasts = _weather_inputs(spark, sf)
    r = weather.parse_forecasts(weather.locate(weather.check_queries(q), places), forecasts)
    return r.select("query_id", F.inline("result.daily_forecast"))


@query
def weather_answer_json(spark: SparkSession, sf: str) -> DataFrame:
    return weather.current_weather(*_weather_inputs(spark, sf))


@query
def request_parameters(spark: SparkSession, sf: str) -> DataFrame:
    q = weather.request_parameters(weather.check_queries(_weather_inputs(spark, sf)[0]))
    return q.groupBy(
        "units", "include_forecast", "temperature_unit", "wind_speed_unit", "precipitation_unit", "forecast_days"
    ).count()


@query
def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return units.agreeing(table(spark, sf, "current_weather"))


@query
def p5_convert(spark: SparkSession, sf: str) -> DataFrame:
    return units.convert(table(spark, sf, "current_weather"))


# layout


@query
def box_measures(spark: SparkSession, sf: str) -> DataFrame:
    return layout.box_measures(_blocks(spark, sf)).select("block_uid", "width", "height", "area", "needs_ocr")


@query
def weighted_mode(spark: SparkSession, sf: str) -> DataFrame:
    b = _blocks(spark, sf)
    spans = b.select(
        "doc", "page", F.col("block_id").alias("block"), F.lit(0).alias("line"), F.lit(0).alias("span"),
        F.lit("Times").alias("font"), F.col("font_size").alias("size"), F.col("raw_content").alias("text")
    )
    return layout.font_hierarchy(spans)


@query
def coverage_histogram(spark: SparkSession, sf: str) -> DataFrame:
    b = _blocks(spark, sf)
    return layout.coverage(_boxes(b), _dims(b)).select(
        "doc", "page", "slot", F.round("covered", 6).alias("covered")
    ).where("covered > 0")


@query
def gutter_runs(spark: SparkSession, sf: str) -> DataFrame:
    b = _blocks(spark, sf)
    return layout.gutters(_boxes(b), _dims(b))


@query
def page_layouts(spark: SparkSession, sf: str) -> DataFrame:
    b = _blocks(spark, sf)
    return layout.page_layouts(_boxes(b), _dims(b))


def _votes(spark: SparkSession, sf: str) -> DataFrame:
    results = _once(table(spark, sf, "page_results"), "page_uid", "ingested_at")
    return layout.document_layouts(results.select("doc", "page", "layout"))


@query
def layout_vote(spark: SparkSession, sf: str) -> DataFrame:
    return _votes(spark, sf)


def _ordered(spark: SparkSession, sf: str) -> DataFrame:
    b = _blocks(spark, sf)
    given = _once(table(spark, sf, "page_results"), "page_uid", "ingested_at").select(
        "doc", "page", "layout", F.lit(None).cast("double").alias("gutter")
    )
    plain = b.select(
        "doc", "page", F.col("block_uid").alias("ord"), "bbox", "block_type", F.col("raw_content").alias("content"),
        "heading_level", "font_size", "has_inline_math", "ocr_mode", F.coalesce("caption", F.lit("")).alias("caption")
    )
    return layout.reading_order(plain, given, _dims(b))


@query
def reading_order(spark: SparkSession, sf: str) -> DataFrame:
    return _ordered(spark, sf).select("doc", "page", "ord", "place")


@query
def merge_formulas(spark: SparkSession, sf: str) -> DataFrame:
    m = layout.merge_formulas(
        _ordered(spark, sf).withColumn(
            "block_type",
            F.when(F.col("block_type").isin("math", "algorithm", "text"), "math").otherwise(F.col("block_type"))
        )
    )
    return m.select(
        "doc", "page", "place", "ord", F.round("bbox.y0", 3).alias("y0"), F.round("bbox.y1", 3).alias("y1"),
        F.length("content").alias("chars")
    )


@query
def number_blocks(spark: SparkSession, sf: str) -> DataFrame:
    n = layout.number_blocks(layout.merge_formulas(_ordered(spark, sf)))
    return n.select("doc", "page", "block_id", "block_type", "has_crop", "is_done")


@query
def anti_overlap(spark: SparkSession, sf: str) -> DataFrame:
    b = _blocks(spark, sf)
    tables = b.where("block_type = 'table'").select(
        "doc", "page", F.lit(0).alias("ord"), "bbox", F.array(F.array(F.lit("x"))).alias("cells")
    )
    return layout.outside_tables(b.where("block_type <> 'table'"), tables).select("block_uid")


@query
def image_captions(spark: SparkSession, sf: str) -> DataFrame:
    b = _blocks(spark, sf)
    # the captions of the table stand just below their pictures
    images = b.where(F.col("block_type").isin("image", "figure")).select(
        "doc", "page", F.col("block_uid").alias("ord"), "bbox"
    )
    below = b.where(F.coalesce(F.length("caption"), F.lit(0)) > 0).select(
        "doc", "page", F.col("block_uid").alias("ord"),
        F.struct(
            F.col("bbox.x0").alias("x0"), (F.col("bbox.y1") + 5).alias("y0"), F.col("bbox.x1").alias("x1"),
            (F.col("bbox.y1") + 17).alias("y1")
        ).alias("bbox"),
        F.col("caption").alias("content")
    )
    return layout.captioned_images(images, below).select("doc", "page", "ord", "block_type", "caption")


def _spans(spark: SparkSession, sf: str) -> DataFrame:
    """Blocks as the spans a page reader gives: a line each, in a font by type of block."""
    b = _blocks(spark, sf).where(F.col("block_type").isin("text", "unknown", "math", "algorithm"))
    font = F.when(F.col("block_type") == "math", "CMMI10").when(F.col("block_type") == "algorithm", "Courier").when(
        F.col("heading_level").isNotNull(), "Times-Bold"
    ).otherwise("Times")
    rows = b.select(
        "doc", "page", F.col("block_id").alias("block"), "bbox.x0", "bbox.y0", "bbox.x1", "bbox.y1", font.alias("font"),
        F.coalesce(F.nanvl("font_size", F.lit(None).cast("double")), F.lit(10.0)).alias("size"),
        F.posexplode(F.split("raw_content", "\n")).alias("line", "text")
    )
    return rows.select(
        "doc", "page", "block", "line", F.lit(0).alias("span"), "x0", "y0", "x1", "y1", "font", "size",
        F.lit(0).alias("flags"), "text"
    )


@query
def analyze_blocks(spark: SparkSession, sf: str) -> DataFrame:
    s = _spans(spark, sf)
    return layout.analyze_blocks(s, layout.font_hierarchy(s)).select(
        "doc", "page", "ord", "block_type", "heading_level", "font_size", "has_inline_math",
        F.md5("content").alias("digest")
    )


@query
def font_headings(spark: SparkSession, sf: str) -> DataFrame:
    return pages.font_headings(_spans(spark, sf))


@query
def segment_pages(spark: SparkSession, sf: str) -> DataFrame:
    b = _blocks(spark, sf)
    tables = b.where("block_type = 'table'").select(
        "doc", "page", "block_id", "bbox",
        F.transform(F.split("raw_content", "\n"), lambda r: F.split(r, r"\|")).alias("cells")
    ).withColumnRenamed("block_id", "ord")
    images = b.where(F.col("block_type").isin("image", "figure")).select(
        "doc", "page", F.col("block_id").alias("ord"), "bbox"
    )
    out = layout.segment_pages(_spans(spark, sf), tables, images, _dims(b))
    return out.select(
        "doc", "page", "block_id", "block_type", "heading_level", "ocr_mode", "is_done",
        F.md5("raw_content").alias("digest")
    )


# page texts


@query
def page_markdown(spark: SparkSession, sf: str) -> DataFrame:
    return assemble.page_markdown(_blocks(spark, sf)).select(
        "doc", "page", F.md5("markdown").alias("digest"), "has_ocr_blocks"
    )


@query
def document_markdown(spark: SparkSession, sf: str) -> DataFrame:
    return assemble.document_markdown(_pages(spark, sf)).select("doc", F.md5("markdown").alias("digest"))


@query
def final_markdown(spark: SparkSession, sf: str) -> DataFrame:
    made = assemble.final_markdown(_pages(spark, sf), _votes(spark, sf))
    return made.select("doc", F.md5("markdown").alias("digest"))


@query
def repeated_lines(spark: SparkSession, sf: str) -> DataFrame:
    return pages.repeated_lines(_pages(spark, sf))


@query
def drop_repeated(spark: SparkSession, sf: str) -> DataFrame:
    p = _pages(spark, sf)
    return pages.drop_repeated(p, pages.repeated_lines(p)).select("doc", "page", F.md5("markdown").alias("digest"))


@query
def references_pages(spark: SparkSession, sf: str) -> DataFrame:
    return pages.references_pages(_pages(spark, sf))


@query
def hyphen_repair(spark: SparkSession, sf: str) -> DataFrame:
    return _blocks(spark, sf).select("block_uid", F.md5(T.repair_hyphens(F.col("raw_content"))).alias("digest"))


@query
def whitespace_norm(spark: SparkSession, sf: str) -> DataFrame:
    return _blocks(spark, sf).select("block_uid", F.md5(T.normalize_space(F.col("raw_content"))).alias("digest"))


@query
def paragraph_merge(spark: SparkSession, sf: str) -> DataFrame:
    return _blocks(spark, sf).select("block_uid", T.merge_split_paragraphs(F.col("raw_content")).alias("text"))


@query
def finish_texts(spark: SparkSession, sf: str) -> DataFrame:
    b = assemble.finish_texts(_blocks(spark, sf).withColumn("is_done", F.lit(False)))
    return b.select("block_uid", "markdown_result", "is_done")


@query
def section_paths(spark: SparkSession, sf: str) -> DataFrame:
    return pages.section_paths(_headings(_blocks(spark, sf))).select("doc", "ord", "path")


@query
def section_map(spark: SparkSession, sf: str) -> DataFrame:
    b = _blocks(spark, sf)
    return pages.section_map(_dims(b), _headings(b))


@query
def postprocessed_pages(spark: SparkSession, sf: str) -> DataFrame:
    return pages.postprocess(_pages(spark, sf), _headings(_blocks(spark, sf)))


# assembly


@query
def type_counts(spark: SparkSession, sf: str) -> DataFrame:
    return assemble.block_counts(_blocks(spark, sf))


@query
def run_summary(spark: SparkSession, sf: str) -> DataFrame:
    return assemble.run_summary(assemble.block_counts(_blocks(spark, sf)), 1.5)


@query
def metadata_json(spark: SparkSession, sf: str) -> DataFrame:
    b = _blocks(spark, sf)
    sections = pages.section_map(_dims(b), _headings(b))
    return assemble.metadata_json(
        assemble.block_counts(b), _votes(spark, sf), pages.references_pages(_pages(spark, sf)), sections
    )


@query
def placeholders(spark: SparkSession, sf: str) -> DataFrame:
    b = _blocks(spark, sf).withColumn(
        "has_crop", F.col("image_rel_path").isNotNull()
    ).withColumn("is_done", F.lit(False))
    return assemble.placeholders(b).where(layout.needs_ocr(F.col("block_type"))).select(
        "block_uid", "image_rel_path", "markdown_result"
    )


@query
def apply_readings(spark: SparkSession, sf: str) -> DataFrame:
    b = _blocks(spark, sf).withColumn("has_crop", F.col("image_rel_path").isNotNull()).withColumn(
        "is_done", ~layout.needs_ocr(F.col("block_type"))
    )
    readings = b.where(layout.needs_ocr(F.col("block_type")) & (F.col("block_uid") % 3 > 0)).select(
        "doc", "page", "block_id",
        F.when(F.col("block_uid") % 3 == 1, F.lit(" read ")).otherwise(F.lit("[OCR Failed: x]")).alias("reading")
    )
    return assemble.apply_readings(b, readings).where(
        layout.needs_ocr(F.col("block_type"))
    ).select("block_uid", "markdown_result")


@query
def reading_modes(spark: SparkSession, sf: str) -> DataFrame:
    return _blocks(spark, sf).groupBy(
        "block_type", "ocr_mode", assemble.reading_mode(F.col("block_type"), F.col("ocr_mode")).alias("mode")
    ).count()


def _files(spark: SparkSession, sf: str) -> DataFrame:
    p = files.page_counts(_once(table(spark, sf, "page_results"), "page_uid", "ingested_at"))
    return p.select(
        F.concat("doc", F.lit(".pdf")).alias("name"), (F.col("pages").cast("bigint") * 250000).alias("size_bytes"),
        "pages", F.when(F.length("doc") % 3 == 0, F.col("pages").cast("bigint") - 1).alias("output_size")
    )


@query
def chunk_ranges(spark: SparkSession, sf: str) -> DataFrame:
    image = assemble.chunk_image_name(F.col("chunk_no"), F.lit("fig.png"))
    return assemble.chunk_ranges(_files(spark, sf), 4).withColumn("image", image)


@query
def resized_crops(spark: SparkSession, sf: str) -> DataFrame:
    b = _blocks(spark, sf)
    w, h = (F.round((F.col(f"bbox.{a}1") - F.col(f"bbox.{a}0")) * 300 / 72).cast("int") for a in "xy")
    sizes = b.select("block_uid", w.alias("w"), h.alias("h")).where("w > 0 AND h > 0")
    width, height = assemble.resized(F.col("w"), F.col("h"))
    return sizes.select("block_uid", width.alias("width"), height.alias("height"))


@query
def file_plan(spark: SparkSession, sf: str) -> DataFrame:
    return assemble.plan_files(
        _files(spark, sf), skip=["bg-00000004.pdf"], contains="-0000", resume=True
    ).select("name", "route", "status")


@query
def status_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return assemble.status_rollup(
        table(spark, sf, "orders").select(
            F.col("o_orderstatus").alias("status"), F.col("o_orderkey").cast("string").alias("name")
        )
    )


@query
def merge_chunks(spark: SparkSession, sf: str) -> DataFrame:
    p = _pages(spark, sf).select(
        F.col("doc").alias("name"), F.format_string("chunk_%03d", "page").alias("path"),
        F.when(F.col("page") % 5 > 0, F.col("markdown")).alias("content")
    )
    return assemble.merge_chunks(p, "foliospark").select("name", F.md5("markdown").alias("digest"))


# retrieval


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents")


@query
def token_chunks(spark: SparkSession, sf: str) -> DataFrame:
    return retrieval.token_chunks(_documents(spark, sf)).select(
        "doc_id", "chunk_no", "chunk_id", "n_tokens", F.md5("content").alias("digest")
    )


@query
def heading_chunks(spark: SparkSession, sf: str) -> DataFrame:
    return retrieval.token_chunks(_documents(spark, sf), 100, 12, by_heading=True).select(
        "doc_id", "chunk_no", "n_tokens", F.md5("content").alias("digest")
    )


@query
def metadata_filter(spark: SparkSession, sf: str) -> DataFrame:
    return retrieval.metadata_filter(
        _documents(spark, sf), ["handbook", "lecture_notes"], "2015-01-01", 0.5
    ).select("doc_id")


def _bm25(spark: SparkSession, sf: str, k: int) -> DataFrame:
    """Keyword search with all shared terms of each query document."""
    d = _documents(spark, sf)
    # a few parts for each core, whatever the files are like: each gives the best of every query
    index = cut(retrieval.packed_texts(d, 3 * spark.sparkContext.defaultParallelism))
    df = cut(retrieval.document_frequencies(index))
    ids = d.where("doc_id % 100 = 0").select(F.col("doc_id").alias("query_id"))
    return retrieval.bm25(
        retrieval.specific_terms(retrieval.postings(d), df, ids), index, df, retrieval.corpus_stats(d, frequencies=df), k
    )


@query
def bm25_topk(spark: SparkSession, sf: str) -> DataFrame:
    return _bm25(spark, sf, 10)


def _vectors(spark: SparkSession, sf: str, k: int) -> DataFrame:
    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    return retrieval.vector_search(
        e.where("doc_id % 100 = 0").select(F.col("doc_id").alias("query_id"), "embedding"), e, k
    )


@query
def vector_topk(spark: SparkSession, sf: str) -> DataFrame:
    return _vectors(spark, sf, 10)


@query
def rrf_fusion(spark: SparkSession, sf: str) -> DataFrame:
    return retrieval.fuse([_bm25(spark, sf, 30), _vectors(spark, sf, 30)], 10)


@query
def recall_at_k(spark: SparkSession, sf: str) -> DataFrame:
    ranked = _vectors(spark, sf, 10)
    e = table(spark, sf, "embeddings").select("vec_id", "label")
    relevant = e.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "label").join(
        e.select(F.col("vec_id").alias("doc_id"), "label"), "label"
    )
    return retrieval.evaluate(ranked, relevant, 10).select(
        "query_id", "hits", F.round("recall", 9).alias("recall"), "precision"
    )


@query
def exact_classes(spark: SparkSession, sf: str) -> DataFrame:
    return retrieval.exact_classes(_documents(spark, sf))


def _with_near_copies(spark: SparkSession, sf: str) -> DataFrame:
    """All documents and, of every third, two near copies: one without its last word, one with a word put before it;
    and of every ninth a copy with a word in each place of twenty changed, which is none.
    """
    d = _documents(spark, sf).select("doc_id", "text")
    own = d.where("doc_id % 3 = 0 AND text IS NOT NULL")
    base = F.lit(1 << 40)
    short = own.select(base + F.col("doc_id") * 4, F.regexp_replace("text", r"\s+\S+\s*$", ""))
    longer = own.select(base + F.col("doc_id") * 4 + 1, F.concat(F.lit("Copy "), F.col("text")))
    words = F.transform(
        T.word_tokens(F.col("text")), lambda w, i: F.when(i % 20 == 10, F.concat(w, F.lit("x"))).otherwise(w)
    )
    other = own.where("doc_id % 9 = 0").select(base + F.col("doc_id") * 4 + 2, F.array_join(words, " "))
    return d.union(short).union(longer).union(other)


@query
def near_duplicate_classes(spark: SparkSession, sf: str) -> DataFrame:
    return retrieval.near_duplicate_classes(_with_near_copies(spark, sf))


@query
def drop_similar(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    return retrieval.drop_similar(_vectors(spark, sf, 30), e, 0.92).select("query_id", "doc_id", "rank")


@query
def fan_out(spark: SparkSession, sf: str) -> DataFrame:
    plans = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("query_id"), F.col("o_orderpriority").alias("rewritten_query"),
        F.when(
            F.col("o_orderkey") % 3 > 0,
            F.transform(
                F.sequence(F.lit(1), (F.col("o_orderkey") % 3).cast("int")),
                lambda i: F.concat(F.col("o_orderpriority"), F.lit(" "), i.cast("string"))
            )
        ).alias("sub_queries")
    )
    return retrieval.fan_out(plans)


@query
def cache_keys(spark: SparkSession, sf: str) -> DataFrame:
    return _documents(spark, sf).select("doc_id", retrieval.cache_key(F.col("text")).alias("key"))


@query
def new_chunks(spark: SparkSession, sf: str) -> DataFrame:
    c = retrieval.token_chunks(_documents(spark, sf))
    return retrieval.new_chunks(c, c.where("doc_id % 3 > 0")).select("chunk_id", "n_tokens")


@query
def drop_near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return retrieval.drop_near_duplicates(
        _bm25(spark, sf, 20).select("query_id", "doc_id"), retrieval.near_duplicate_classes(_documents(spark, sf))
    )


@query
def cached(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's text as a query; the store holds the results of those with an even id."""
    d = _documents(spark, sf)
    store = d.where("doc_id % 2 = 0").groupBy(
        retrieval.cache_key(F.col("text")).alias("key")
    ).agg(F.min("doc_id").alias("result"))
    hit, miss = retrieval.cached(d.select(F.col("doc_id").alias("query_id"), F.col("text").alias("query")), store)
    return hit.select("query_id", "result").unionByName(
        miss.select("query_id", F.lit(None).cast("bigint").alias("result"))
    )


# context


@query
def pii_redact(spark: SparkSession, sf: str) -> DataFrame:
    return _documents(spark, sf).select("doc_id", F.md5(context.redact(F.col("text"))).alias("digest"))


@query
def injection_flags(spark: SparkSession, sf: str) -> DataFrame:
    return context.injection_flags(_documents(spark, sf)).select("doc_id", F.array_join("flags", ",").alias("flags"))


def _candidates(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Queries (documents with an id divisible by 100) and their keyword and vector candidates with texts."""
    d = _documents(spark, sf)
    queries = d.where("doc_id % 100 = 0").select(
        F.col("doc_id").alias("query_id"), F.coalesce("text", F.lit("")).alias("query")
    )
    both = context.union_sources({"knowledge": _bm25(spark, sf, 20), "memory": _vectors(spark, sf, 20), "tool": None})
    texts = d.select(
        "doc_id", F.coalesce("text", F.lit("")).alias("content"), "doc_name", "page_number", "trust", "updated_at"
    )
    # the candidates, a few of each query, go to the texts; the texts are not shuffled.  Every candidate has a score; that
    # the content asks for it keeps conditions on the content from being tried on the texts of all documents
    c = texts.join(broadcast_if(cut(both)), "doc_id").withColumn(
        "content", F.when(F.col("score").isNotNull(), F.col("content"))
    ).withColumn("chunk_id", F.col("doc_id").cast("string")).withColumn(
        "tokens", F.size(T.word_tokens(F.col("content")))
    )
    return c, queries


@query
def over_fetch(spark: SparkSession, sf: str) -> DataFrame:
    return context.over_fetch(_candidates(spark, sf)[0], 5).select("query_id", "source_kind", "chunk_id")


@query
def rerank(spark: SparkSession, sf: str) -> DataFrame:
    c, q = _candidates(spark, sf)
    return context.rerank(
        context.safe_candidates(c), q, trust_weight=0.1, recency_weight=0.2, now="2026-01-01"
    ).select("query_id", "source_kind", "chunk_id", "rerank_score", "rank")


@query
def compress(spark: SparkSession, sf: str) -> DataFrame:
    c, q = _candidates(spark, sf)
    r = context.compress(context.rerank(c, q), q, 0.3)
    return r.select("query_id", "source_kind", "chunk_id", "content")


@query
def token_budget(spark: SparkSession, sf: str) -> DataFrame:
    return context.within_budget(_candidates(spark, sf)[0], 4000).select(
        "query_id", "source_kind", "chunk_id", "tokens", "used"
    )


@query
def prompt_build(spark: SparkSession, sf: str) -> DataFrame:
    c, q = _candidates(spark, sf)
    # by query, for the budget of each kind and for the prompt: the texts are shuffled once
    c = c.repartition("query_id")
    return context.build_prompt(context.within_budget(c, 4000), q).select("query_id", F.md5("prompt").alias("digest"))


@query
def context_usage(spark: SparkSession, sf: str) -> DataFrame:
    """Context of each query as far as its own text, as an answer, uses it."""
    c, q = _candidates(spark, sf)
    u = retrieval.usage(context.within_budget(c, 4000), q.select("query_id", F.col("query").alias("answer")))
    return u.select(
        "query_id", "parts", "tokens", "used", F.round("utilisation", 9).alias("utilisation"),
        F.round("unsupported", 9).alias("unsupported")
    )


@query
def stage_latencies(spark: SparkSession, sf: str) -> DataFrame:
    log = table(spark, sf, "events").select(
        F.col("user_id").alias("query_id"), F.col("event_type").alias("stage"), F.col("value").alias("ms")
    )
    return retrieval.latencies(log).select("stage", "requests", F.round("mean_ms", 6).alias("mean_ms"))


def _turns(spark: SparkSession, sf: str) -> DataFrame:
    """Events as turns of conversations, with a few sentences each."""
    text = F.concat_ws(
        " ", F.concat(F.lit("The user made a "), F.col("event_type"), F.lit(".")),
        F.concat(F.lit("It had "), F.col("props"), F.lit("!")),
        F.concat(F.lit("Value "), F.floor("value").cast("string"), F.lit(" was noted."))
    )
    return table(spark, sf, "events").select(
        F.col("user_id").alias("conv_id"), F.col("event_id").alias("turn"), F.length("props").alias("tokens"),
        text.alias("text")
    )


@query
def session_window(spark: SparkSession, sf: str) -> DataFrame:
    return context.session_window(_turns(spark, sf), 200, 15).select("conv_id", "turn", "kept")


@query
def rolling_summary(spark: SparkSession, sf: str) -> DataFrame:
    return context.rolling_summary(context.session_window(_turns(spark, sf), 200, 15))


@query
def latest_facts(spark: SparkSession, sf: str) -> DataFrame:
    return context.latest_facts(
        table(spark, sf, "events").select("user_id", F.col("event_type").alias("key"), "value", "ts")
    ).drop("ts")


# events


@query
def forward_fill(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").withColumn("known", F.when(F.col("event_id") % 4 == 0, F.col("value")))
    return streams.forward_fill(e, "known").select("event_id", "filled")


@query
def event_sessions(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    s = streams.sessions(e)
    return s.select(
        "user_id", F.col("start").cast("timestamp_ntz").alias("start"), "events", F.round("value", 6).alias("value")
    )


@query
def event_windows(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return streams.windows(e).select(
        F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "events", F.round("value", 6).alias("value")
    )
