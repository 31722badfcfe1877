import json

import pytest
from pyspark.sql import functions as F

from foliospark import tools
from foliospark.operators import transcript as T
from foliospark.sources import settings as S

C = "ord int, semester string, code string, name string, credits int, class_id string, process_score double, exam_score double, letter_grade string"


def test_tools(spark):
    c = spark.createDataFrame(
        [
            (0, "20201", "A1", "a", 3, None, None, None, "B"), (1, "20211", "A1", "a", 3, None, None, None, "A"),
            (2, "20211", "B1", "b", 2, None, None, None, "C")
        ],
        C
    )
    one = tools.get_semester_gpa(c, "20201").first().asDict()
    assert [x["code"] for x in one.pop("courses")] == ["A1"] and one == {
        "semester": "20201", "gpa": 3.0, "credits_counted": 3
    }
    assert tools.get_semester_gpa(c, "19991").first().asDict() == {
        "semester": "19991", "gpa": 0.0, "credits_counted": 0, "courses": []
    }
    got = tools.get_cpa(c).first()
    assert (got["cpa"], got["cumulative_credits"], [x["code"] for x in got["courses"]]) == (3.2, 5, ["A1", "B1"])
    o = spark.createDataFrame(
        [(0, "B1", None, False, "A")],
        "ord int, code string, semester string, semester_given boolean, letter_grade string"
    )
    gpas, total = tools.simulate_grades(c, o, "20211")
    assert [
        (r["gpa"], [x["code"] for x in r["courses"]]) for r in gpas.collect()
    ] == [(3.0, ["A1"]), (4.0, ["A1", "B1"])] and total.first()["cpa"] == 4.0
    text = spark.createDataFrame(
        [("d", 1, 2, 0.0, 9.0, "b"), ("d", 1, 1, 0.0, 9.0, "a"), ("d", 2, 1, 0.0, 9.0, "c")],
        "doc string, page int, ord int, x0 double, y0 double, text string"
    )
    assert tools.raw_text(text).first()["text"] == "a\nb\nc" and tools.list_courses(text).collect() == []


def test_settings(tmp_path, monkeypatch):
    for name in ("GOOGLE_API_KEY", "GEMINI_API_KEY", "GEMINI_MODEL", "REQUEST_TIMEOUT_SECONDS"):
        monkeypatch.delenv(name, raising=False)
    file = tmp_path / ".env"
    file.write_text("# keys\nGEMINI_API_KEY='secret'\nREQUEST_TIMEOUT_SECONDS=5\n")
    s = S.load_settings(str(file))
    assert s.api_key == "secret" and s.timeout_seconds == 5 and "secret" not in repr(s)
    monkeypatch.setenv("GOOGLE_API_KEY", "first")
    assert S.load_settings(str(file)).api_key == "first"
    with pytest.raises(ValueError):
        S.Settings().api_key  # noqa: B018


def test_averages_round_alike_everywhere(spark):
    # 21 / 8 is 2.625: half-even gives 2.62
    c = spark.createDataFrame(
        [(0, "20201", "A1", "a", 5, None, None, None, "B"), (1, "20201", "B1", "b", 3, None, None, None, "C")], C
    )
    none = spark.createDataFrame(
        [], "ord int, code string, semester string, semester_given boolean, letter_grade string"
    )
    gpas, total = tools.simulate_grades(c, none)
    assert {
        tools.get_semester_gpa(c, "20201").first()["gpa"], tools.get_cpa(c).first()["cpa"], gpas.first()["gpa"],
        total.first()["cpa"], T.cpa_per_semester(c).first()["cpa"]
    } == {2.62}


def test_json_keeps_nulls(spark):
    c = spark.createDataFrame([(0, "20201", "A1", "a", 3, None, None, 8.0, "B")], C)
    assert T.transcript_json(
        c.withColumn("doc", F.lit("d")), ord_col="ord"
    ).first()[
        "courses"
    ] == '[{"semester":"20201","code":"A1","name":"a","credits":3,"class_id":null,"process_score":null,"exam_score":8.0,"letter_grade":"B"}]'


def test_weather_tool(spark):
    q = spark.createDataFrame(
        [
            (1, "Hue", None, None, None), (2, "", "vi", "metric", True), (3, "X", "toolong", None, None),
            (4, "Y", "en", "stone", None), (5, None, None, None, None), (6, "Z", None, None, None),
            (7, "W", None, "imperial", True)
        ],
        "query_id bigint, location string, language string, units string, include_forecast boolean"
    )
    places = spark.createDataFrame(
        [
            (1, '{"results": [{"name": "Huế", "latitude": 16.5, "longitude": 107.6}, {"name": "no"}]}'),
            (6, '{"results": []}'), (7, '{"results": [{"name": "W", "latitude": 1.0, "longitude": 2.0}]}')
        ],
        "query_id bigint, payload string"
    )
    forecasts = spark.createDataFrame(
        [(1, '{"current": {"time": "t", "temperature_2m": 20.5, "weather_code": 61}}'), (7, "[]")],
        "query_id bigint, payload string"
    )
    got = {r["query_id"]: json.loads(r["answer"]) for r in tools.get_weather(q, places, forecasts).collect()}
    assert got[1]["location"] == {
        "name": "Huế", "country": None, "admin1": None, "latitude": 16.5, "longitude": 107.6, "timezone": None
    }
    assert got[1]["current"]["temperature"] == 20.5 and got[1]["current"]["rain"] is None and got[1]["current"][
        "temperature_unit"
    ] == "degC" and got[1]["daily_forecast"] == []
    assert {k: v["error"] for k, v in got.items() if "error" in v} == {
        2: "location is empty", 3: "language has not 2 to 5 characters", 4: "units is neither metric nor imperial",
        5: "location is empty",
        6: "Could not find coordinates for location: Z", 7: "Weather service returned an invalid response.",
    }
    one = tools.get_weather(q.where("query_id = 1"), places, forecasts).first()["answer"]
    assert one == json.dumps(json.loads(one), indent=2, ensure_ascii=False)
