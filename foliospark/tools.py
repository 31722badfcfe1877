"""The tools of the agents as functions from DataFrames to DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.operators import transcript, weather


def list_courses(blocks: DataFrame) -> DataFrame:
    """All courses of the transcripts, as JSON lists."""
    return transcript.transcript_json(transcript.parse_courses(blocks))


def get_semester_gpa(courses: DataFrame, semester: str, ord_col: str = "ord") -> DataFrame:
    """One row: semester, gpa, credits_counted and the counted courses in order (0, 0 and none where the semester has
    no counted course).
    """
    own = transcript.counted(courses.where(F.col("semester") == semester))
    average, total = transcript.average(), F.coalesce(F.sum("credits"), F.lit(0)).cast("bigint")
    return own.agg(
        F.lit(semester).alias("semester"), average.alias("gpa"), total.alias("credits_counted"),
        transcript.course_list(ord_col).alias("courses")
    )


def get_cpa(courses: DataFrame, up_to: str | None = None, ord_col: str = "ord") -> DataFrame:
    """One row: up_to_semester, cpa, cumulative_credits, and the counted courses in order of their codes' first
    attempts.

    ``courses`` are those of one transcript, so one row holds them; averages of
    many transcripts are ``transcript.cpa``.
    """
    best = transcript.best_attempts(courses, up_to=up_to, ord_col=ord_col)
    total = F.coalesce(F.sum("credits"), F.lit(0)).cast("bigint")
    return best.agg(
        F.lit(up_to).alias("up_to_semester"), transcript.average().alias("cpa"), total.alias("cumulative_credits"),
        transcript.course_list("first_attempt").alias("courses")
    )


def simulate_grades(
    courses: DataFrame, overrides: DataFrame, up_to: str | None = None, ord_col: str = "ord"
) -> tuple[DataFrame, DataFrame]:
    """Averages of all semesters in order with their counted courses, and the answer of ``get_cpa``, under what-if
    grades.
    """
    changed = transcript.apply_overrides(courses, overrides)
    lists = transcript.counted(changed).groupBy("semester").agg(transcript.course_list(ord_col).alias("courses"))
    gpas = transcript.gpa_by_semester(changed).join(lists, "semester", "left").withColumn(
        "courses", F.coalesce("courses", F.array().cast(lists.schema["courses"].dataType))
    )
    return gpas.orderBy("semester"), get_cpa(changed, up_to, ord_col)


def get_weather(queries: DataFrame, places: DataFrame, forecasts: DataFrame) -> DataFrame:
    """JSON answers of weather queries."""
    return weather.current_weather(queries, places, forecasts)


def raw_text(blocks: DataFrame) -> DataFrame:
    """Raw text of each transcript."""
    return transcript.page_text(blocks)
