"""Transcripts: course rows from positioned text, grade averages, best attempts and what-if grades."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.functions import text as T

#: Points of the letter grades that count (P, I and W do not).
GRADE_POINTS = {"A+": 4.0, "A": 4.0, "B+": 3.5, "B": 3.0, "C+": 2.5, "C": 2.0, "D+": 1.5, "D": 1.0, "F": 0.0}
#: Fixed value: the caption after which a page has no courses.
END_MARKER = "Kết quả học tập sinh viên"
#: Fixed value: a course row: optional semester, code, name, credits, class, optional process score, exam score, letter.
COURSE_ROW = (
    r"^(\d{5})?\s*([A-Z]{1,5}[A-Z0-9_-]*\d{3,5}[A-Z0-9_-]*)\s+(.+)\s+(\d+)\s+(\d+)\s+(?:([\d.,-]+)\s+)?([\d.,-]+)\s+(A\+?|B\+?|C\+?|D\+?|F|P|I|W)(?=\s|$)"
)


def points(grade: Column) -> Column:
    """Points of a letter grade; null where it has none."""
    table = F.create_map(*[F.lit(x) for pair in GRADE_POINTS.items() for x in pair])
    return F.try_element_at(table, grade)


def before_marker(blocks: DataFrame) -> DataFrame:
    """Blocks of each page (doc, page, ord) before the first that holds the end marker."""
    seen = F.max(F.coalesce(F.col("text").contains(END_MARKER), F.lit(False)).cast("int")).over(
        Window.partitionBy("doc", "page").orderBy("ord").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return blocks.withColumn("_seen", seen).where("_seen = 0").drop("_seen")


def page_rows(blocks: DataFrame) -> DataFrame:
    """Rows of cells: doc, page, y (multiple of 3), cells (texts from left to right, in order of ``ord`` at one x);
    blank cells are dropped.
    """
    cells = before_marker(blocks).select(
        "doc", "page", "ord", "x0", (F.bround(F.col("y0") / 3) * 3).cast("int").alias("y"),
        T.strip(F.col("text")).alias("text")
    ).where(F.length("text") > 0)
    ordered = F.array_sort(F.collect_list(F.struct("x0", "ord", "text")))
    return cells.groupBy("doc", "page", "y").agg(F.transform(ordered, lambda c: c["text"]).alias("cells"))


def parse_courses(blocks: DataFrame) -> DataFrame:
    """Courses of positioned text blocks (doc, page, ord, x0, y0, text).

    Result: doc, page, y, semester, code, name, credits, class_id, process_score,
    exam_score, letter_grade.  A row of one cell that is a semester holds for the
    rows below it on the page, unless they carry their own; rows without either
    have no course.  Pages are the grain of all windows.
    """
    rows = page_rows(blocks)
    header = (F.size("cells") == 1) & F.get("cells", F.lit(0)).rlike(r"(?U)^\s*20\d{3}\s*$")
    filled = F.last(F.when(header, F.get("cells", F.lit(0))), ignorenulls=True).over(
        Window.partitionBy("doc", "page").orderBy("y").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    rows = rows.withColumn("_semester", filled).where(~header).withColumn(
        "_row", F.array_join("cells", " ")
    ).where(F.col("_row").rlike(COURSE_ROW))
    g = [F.nullif(F.regexp_extract("_row", COURSE_ROW, i), F.lit("")) for i in range(1, 9)]
    out = rows.select(
        "doc", "page", "y", F.coalesce(g[0], "_semester").alias("semester"), g[1].alias("code"),
        T.strip(g[2]).alias("name"), g[3].try_cast("int").alias("credits"), g[4].alias("class_id"),
        T.to_float(g[5]).alias("process_score"), T.to_float(g[6]).alias("exam_score"), g[7].alias("letter_grade")
    )
    return out.where(F.col("semester").isNotNull())


def page_text(blocks: DataFrame) -> DataFrame:
    """Raw text of each doc: the texts of its pages, joined by line ends."""
    return blocks.groupBy("doc").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("page", "ord", "text"))), lambda x: x["text"]), "\n"
        ).alias("text")
    )


def counted(courses: DataFrame) -> DataFrame:
    """Courses with credits and a grade that has points, with ``points``."""
    return courses.withColumn("points", points(F.col("letter_grade"))).where(
        (F.col("credits") > 0) & F.col("points").isNotNull()
    )


def average() -> Column:
    """Aggregate: the credits' average of ``points``, rounded."""
    return _rounded(F.try_divide(F.sum(F.col("credits") * F.col("points")), F.sum("credits")))


def _rounded(ratio: Column) -> Column:
    """Two digits of the exact binary value, ties to even; 0 for null."""
    return F.coalesce(T.round_binary(ratio, 2), F.lit(0.0))


def gpa_by_semester(courses: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Grade average and credits of each semester (and of ``keys``, as a transcript id); semesters without counted
    courses have 0.

    A plain aggregation with map-side sums; averages are rounded as described in
    ``round_binary``.
    """
    graded = courses.withColumn("points", points(F.col("letter_grade")))
    ok = (F.col("credits") > 0) & F.col("points").isNotNull()
    graded = graded.withColumn(
        "credits", F.when(ok, F.col("credits")).otherwise(0)
    ).withColumn("points", F.when(ok, F.col("points")).otherwise(0.0))
    return graded.groupBy(*keys, "semester").agg(
        average().alias("gpa"), F.sum("credits").cast("bigint").alias("credits_counted")
    )


def best_attempts(
    courses: DataFrame, keys: tuple[str, ...] = (), up_to: str | None = None, ord_col: str = "ord"
) -> DataFrame:
    """The counted attempt of each code: most points, then the earliest semester, then ``ord``; with the place of the
    code's first attempt.

    ``max_by`` over an ordered struct instead of a sort: partial aggregation
    keeps one row per code and task, so a code with a third of the rows is no hot
    group.
    """
    rows = counted(courses)
    if up_to is not None:
        rows = rows.where(F.col("semester") <= up_to)
    kept = [c for c in rows.columns if c not in (*keys, "code")]
    place = F.struct("semester", ord_col)
    earliest_best = F.min_by(F.struct(*kept), F.struct(-F.col("points"), F.col("semester"), F.col(ord_col)))
    out = rows.groupBy(*keys, "code").agg(earliest_best.alias("_b"), F.min(place).alias("first_attempt"))
    return out.select(*keys, "code", "_b.*", "first_attempt")


def cpa(courses: DataFrame, keys: tuple[str, ...] = (), up_to: str | None = None, ord_col: str = "ord") -> DataFrame:
    """Cumulative average over the best attempts: ``keys``, cpa, cumulative_credits (0 and 0 without any when there
    are no keys).
    """
    best = best_attempts(courses, keys, up_to, ord_col)
    return best.groupBy(*keys).agg(
        average().alias("cpa"), F.coalesce(F.sum("credits"), F.lit(0)).cast("bigint").alias("cumulative_credits")
    )


def cpa_per_semester(courses: DataFrame, keys: tuple[str, ...] = (), ord_col: str = "ord") -> DataFrame:
    """GPA of each semester and the CPA as of it.

    A later better attempt replaces an earlier one, so this is no running sum of
    rows: for each code the running best changes at some semesters only, and the
    changes (new credits and points less the old ones) are what is summed.
    """
    rows = counted(courses)
    # one row per code and semester: its best attempt there (earliest of equal ones)
    per = rows.groupBy(*keys, "code", "semester").agg(
        F.min_by(F.struct("credits", "points"), F.struct(-F.col("points"), F.col(ord_col))).alias("b")
    )
    order = Window.partitionBy(*keys, "code").orderBy("semester")
    before = F.max("b.points").over(order.rowsBetween(Window.unboundedPreceding, -1))
    better = per.withColumn("before", before).where(F.col("before").isNull() | (F.col("b.points") > F.col("before")))
    old = F.lag("b").over(order)
    change = better.select(
        *keys, "semester", (F.col("b.credits") - F.coalesce(old["credits"], F.lit(0))).alias("dc"),
        (F.col("b.credits") * F.col("b.points") - F.coalesce(old["credits"] * old["points"], F.lit(0.0))).alias("dp")
    )
    sums = change.groupBy(*keys, "semester").agg(F.sum("dc").alias("dc"), F.sum("dp").alias("dp"))
    semesters = gpa_by_semester(courses, keys).join(sums, [*keys, "semester"], "left")
    run = Window.partitionBy(*keys).orderBy("semester").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # a row per semester
    total_c, total_p = F.coalesce(F.sum("dc").over(run), F.lit(0)), F.sum("dp").over(run)
    return semesters.select(
        *keys, "semester", "gpa", _rounded(F.try_divide(total_p, total_c)).alias("cpa"), "credits_counted",
        total_c.cast("bigint").alias("cumulative_credits")
    )


def apply_overrides(courses: DataFrame, overrides: DataFrame) -> DataFrame:
    """Courses with the letter grades of ``overrides`` (ord, code, semester?, semester_given, letter_grade).

    An override without a semester holds for all attempts of its code, one with a
    null semester for none; of several the last by ``ord`` wins.  Overrides are
    reduced to one per code (and semester) before the join, so it never
    multiplies rows, and Spark broadcasts them where their size allows.
    """
    any_semester = overrides.where(~F.col("semester_given")).groupBy("code").agg(
        F.max_by(F.struct("ord", "letter_grade"), "ord").alias("_any")
    )
    own = overrides.where(F.col("semester_given") & F.col("semester").isNotNull()).groupBy("code", "semester").agg(
        F.max_by(F.struct("ord", "letter_grade"), "ord").alias("_own")
    )
    joined = courses.join(any_semester, "code", "left").join(own, ["code", "semester"], "left")
    wins = F.when(
        F.coalesce(F.col("_own.ord"), F.lit(-1)) >= F.coalesce(F.col("_any.ord"), F.lit(-1)), F.col("_own.letter_grade")
    ).otherwise(F.col("_any.letter_grade"))
    return joined.withColumn("letter_grade", F.coalesce(wins, "letter_grade")).select(*courses.columns)


def simulate(
    courses: DataFrame, overrides: DataFrame, keys: tuple[str, ...] = (), up_to: str | None = None, ord_col: str = "ord"
) -> tuple[DataFrame, DataFrame]:
    """Semester averages (all semesters) and the CPA (up to ``up_to``) under what-if grades."""
    changed = apply_overrides(courses, overrides)
    return gpa_by_semester(changed, keys), cpa(changed, keys, up_to, ord_col)


def semesters(courses: DataFrame) -> DataFrame:
    return courses.select("semester").distinct().orderBy("semester")


#: Fields of a course, in the order of its JSON.
COURSE = ("semester", "code", "name", "credits", "class_id", "process_score", "exam_score", "letter_grade")
#: JSON keeps fields that are null.
NULLS = {"ignoreNullFields": "false"}


def course_list(*order: str) -> Column:
    """Aggregate: the courses of a group as an array in the given order."""
    sorted_ = F.array_sort(F.collect_list(F.struct(F.struct(*order).alias("at"), F.struct(*COURSE).alias("course"))))
    return F.transform(sorted_, lambda c: c["course"])


def transcript_json(courses: DataFrame, keys: tuple[str, ...] = ("doc",), ord_col: str = "y") -> DataFrame:
    """One JSON list of courses per transcript, in order; null fields are kept."""
    return courses.groupBy(*keys).agg(F.to_json(course_list(ord_col), NULLS).alias("courses"))
