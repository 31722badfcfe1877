import json

from foliospark.operators import weather as W


def test_tool(spark):
    q = spark.createDataFrame(
        [
            (1, "Hanoi", None, None, True), (2, "", "vi", "metric", False), (3, "Nowhere", "vi", "imperial", False),
            (4, "Oslo", "vi", "kelvin", False), (5, "Hue", "vi", "imperial", False)
        ],
        "query_id bigint, location string, language string, units string, include_forecast boolean"
    )
    places = spark.createDataFrame(
        [
            (
                1,
                json.dumps(
                    {
                        "results": [
                            {"name": "Hà Nội", "latitude": 21.0, "longitude": 105.8},
                            {"name": "other", "latitude": 0, "longitude": 0}
                        ]
                    }
                )
            ),
            (3, '{"results": []}'), (5, '{"results": [{"name": "Huế", "latitude": 16.5, "longitude": 107.6}]}')
        ],
        "query_id bigint, payload string"
    )
    day = {"time": ["d1", "d2"], "weather_code": [3], "temperature_2m_max": [30.5, None, 9]}
    f = spark.createDataFrame(
        [
            (
                1,
                json.dumps(
                    {
                        "current": {"time": "t", "temperature_2m": 30, "weather_code": 42},
                        "current_units": {"wind_speed_10m": "m/s"}, "daily": day
                    }
                )
            ),
            (5, "[1]")
        ],
        "query_id bigint, payload string"
    )
    got = {r["query_id"]: json.loads(r["answer"]) for r in W.current_weather(q, places, f).collect()}
    assert got[1]["current"][
        "weather_description"
    ] == "Ma thoi tiet 42" and got[1]["current"]["wind_speed_unit"] == "m/s" and got[1]["current"][
        "temperature_unit"
    ] == "degC"
    assert [
        d["weather_description"] for d in got[1]["daily_forecast"]
    ] == ["Nhieu may", "Khong ro"] and got[1]["source"] == "Open-Meteo"
    assert got[3]["error"] == "Could not find coordinates for location: Nowhere" and got[3]["hint"]
    assert "invalid" in got[5]["error"] and "location" in got[2]["error"] and "units" in got[4]["error"]


def test_codes(spark):
    df = spark.createDataFrame([(0,), (99,), (42,), (None,)], "c int")
    assert [r[0] for r in df.select(W.describe(df.c)).collect()] == [
        "Troi quang", "Giong bao kem mua da nang", "Ma thoi tiet 42", "Khong ro"
    ]
