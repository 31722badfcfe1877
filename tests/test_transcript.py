from foliospark.operators import transcript as T

C = "ord int, semester string, code string, name string, credits int, class_id string, process_score double, exam_score double, letter_grade string"


def courses(spark, rows):
    return spark.createDataFrame([(i, s, c, c, n, None, None, None, g) for i, (s, c, n, g) in enumerate(rows)], C)


ROWS = [
    ("20201", "A1", 3, "B"), ("20211", "A1", 3, "B"), ("20202", "B1", 2, "F"), ("20211", "B1", 4, "A"),
    ("20201", "C1", 2, "P"), ("20202", "D1", 0, "A"), ("20202", "E1", 1, "I")
]


def test_gpa(spark):
    got = {r["semester"]: (r["gpa"], r["credits_counted"]) for r in T.gpa_by_semester(courses(spark, ROWS)).collect()}
    assert got == {"20201": (3.0, 3), "20202": (0.0, 2), "20211": (3.57, 7)}


def test_cpa_and_best_attempt(spark):
    c = courses(spark, ROWS)
    assert T.cpa(c).first().asDict() == {"cpa": 3.57, "cumulative_credits": 7}
    assert T.cpa(c, up_to="20202").first().asDict() == {"cpa": 1.8, "cumulative_credits": 5}
    best = {r["code"]: (r["semester"], r["first_attempt"]["semester"]) for r in T.best_attempts(c).collect()}
    assert best == {"A1": ("20201", "20201"), "B1": ("20211", "20202")}
    assert T.cpa(courses(spark, [])).first().asDict() == {"cpa": 0.0, "cumulative_credits": 0}


def test_exact_rounding(spark):
    rows = [("1", f"X{i}", n, g) for i, (n, g) in enumerate([(26, "B"), (14, "C"), ])]
    assert T.gpa_by_semester(courses(spark, rows)).first()["gpa"] == round(106 / 40, 2)


def test_per_semester(spark):
    got = {
        r["semester"]: (r["cpa"], r["cumulative_credits"]) for r in T.cpa_per_semester(courses(spark, ROWS)).collect()
    }
    assert got == {"20201": (3.0, 3), "20202": (1.8, 5), "20211": (3.57, 7)}


def test_overrides(spark):
    o = spark.createDataFrame(
        [
            (0, "A1", None, False, "C"), (1, "A1", "20211", True, "A"), (2, "B1", None, True, "D"),
            (3, "E1", None, False, "Z"), (4, "E1", None, False, "B")
        ],
        "ord int, code string, semester string, semester_given boolean, letter_grade string"
    )
    got = {(r["semester"], r["code"]): r["letter_grade"] for r in T.apply_overrides(courses(spark, ROWS), o).collect()}
    assert got == {
        ("20201", "A1"): "C", ("20211", "A1"): "A", ("20202", "B1"): "F", ("20211", "B1"): "A", ("20201", "C1"): "P",
        ("20202", "D1"): "A", ("20202", "E1"): "B"
    }


def test_parse(spark):
    rows = [
        ("d", 1, 1, 0.0, 9.0, "20231"), ("d", 1, 2, 0.0, 20.9, "ET2000"), ("d", 1, 3, 50.0, 21.4, " Nhập môn 2 "),
        ("d", 1, 4, 60.0, 21.0, " "), ("d", 1, 5, 90.0, 21.0, "3 123456 7,5 - B+"),
        ("d", 1, 6, 0.0, 33.0, "20221 EM10 X 2 9 8.0 A"),
        ("d", 1, 7, 0.0, 45.0, "EM11 Y 2 9 8.0 W x"), ("d", 1, 8, 0.0, 60.0, "Kết quả học tập sinh viên"),
        ("d", 1, 9, 0.0, 70.0, "EM12 Z 2 9 8.0 A"), ("d", 2, 1, 0.0, 10.0, "EM13 Z 2 9 8.0 A"),
        ("d", 2, 2, 0.0, 20.0, "EM104 Z 2 9 8.0 A"),
    ]
    got = T.parse_courses(
        spark.createDataFrame(rows, "doc string, page int, ord int, x0 double, y0 double, text string")
    ).orderBy("y").collect()
    assert [
        (
            r["semester"], r["code"], r["name"], r["credits"], r["class_id"], r["process_score"], r["exam_score"],
            r["letter_grade"]
        ) for r in got
    ] == [("20231", "ET2000", "Nhập môn 2", 3, "123456", 7.5, None, "B+")]
