"""Weather answers: place lookup and forecast payloads (JSON strings) to typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.functions import text as T

#: Labels of the weather codes.
WEATHER_CODES = {
    0: "Troi quang", 1: "Gan nhu quang", 2: "May rai rac", 3: "Nhieu may", 45: "Suong mu", 48: "Suong mu dong bang",
    51: "Mua phun nhe", 53: "Mua phun vua", 55: "Mua phun nang", 56: "Mua phun dong bang nhe",
    57: "Mua phun dong bang nang",
    61: "Mua nhe", 63: "Mua vua", 65: "Mua nang", 66: "Mua dong bang nhe", 67: "Mua dong bang nang",
    71: "Tuyet roi nhe", 73: "Tuyet roi vua", 75: "Tuyet roi nang", 77: "Hat tuyet",
    80: "Mua rao nhe", 81: "Mua rao vua", 82: "Mua rao du doi", 85: "Mua tuyet rao nhe", 86: "Mua tuyet rao nang",
    95: "Giong bao", 96: "Giong bao kem mua da nhe", 99: "Giong bao kem mua da nang",
}
UNKNOWN_CODE, NO_CODE = "Ma thoi tiet ", "Khong ro"
SOURCE = "Open-Meteo"
HINT = "Try a more specific location such as city, country, or landmark."
#: Messages of the service's faults; the second is followed by the location.
INVALID, NOT_FOUND = "Weather service returned an invalid response.", "Could not find coordinates for location: "
GEOCODE = "results array<struct<name:string,country:string,admin1:string,latitude:double,longitude:double,timezone:string>>"
MEASURES = {
    "temperature": "temperature_2m", "apparent_temperature": "apparent_temperature",
    "relative_humidity": "relative_humidity_2m", "precipitation": "precipitation", "rain": "rain", "showers": "showers",
    "snowfall": "snowfall", "cloud_cover": "cloud_cover", "surface_pressure": "surface_pressure",
    "wind_speed": "wind_speed_10m", "wind_direction": "wind_direction_10m"
}
FORECAST = (
    "current struct<time:string,weather_code:int," + ",".join(f"{v}:double" for v in MEASURES.values()) + ">,"
    " current_units struct<temperature_2m:string,wind_speed_10m:string,precipitation:string>,"
    " daily struct<time:array<string>,weather_code:array<int>,temperature_2m_max:array<double>,temperature_2m_min:array<double>,precipitation_sum:array<double>>"
)


def describe(code: Column) -> Column:
    """Label of a weather code; codes without one are named by number, null has its own label."""
    table = F.create_map(*[F.lit(x) for pair in WEATHER_CODES.items() for x in pair])
    return F.when(code.isNull(), NO_CODE).otherwise(
        F.coalesce(F.try_element_at(table, code.cast("int")), F.concat(F.lit(UNKNOWN_CODE), code.cast("string")))
    )


def check_queries(queries: DataFrame) -> DataFrame:
    """Queries (query_id, location, language, units, include_forecast) with defaults filled in and ``error`` (null
    where they are valid).
    """
    q = queries.withColumn("language", F.coalesce("language", F.lit("vi"))).withColumn("units", F.coalesce("units", F.lit("metric"))).withColumn(
        "include_forecast", F.coalesce("include_forecast", F.lit(False))
    )
    error = (
        F.when(F.col("location").isNull() | (F.length("location") < 1), "location is empty")
        .when(~F.length("language").between(2, 5), "language has not 2 to 5 characters")
        .when(~F.col("units").isin("metric", "imperial"), "units is neither metric nor imperial")
    )
    return q.withColumn("error", error)


def request_parameters(queries: DataFrame) -> DataFrame:
    """Units and days that a forecast request asks for."""
    metric = F.col("units") == "metric"
    pick = lambda a, b: F.when(metric, a).otherwise(b)
    return queries.withColumns(
        {
            "temperature_unit": pick("celsius", "fahrenheit"), "wind_speed_unit": pick("kmh", "mph"),
            "precipitation_unit": pick("mm", "inch"), "forecast_days": F.when(F.col("include_forecast"), 3).otherwise(1)
        }
    )


def _object(payload: Column) -> Column:
    return payload.rlike(r"(?s)^\s*\{") & F.try_parse_json(payload).isNotNull()


def locate(queries: DataFrame, payloads: DataFrame) -> DataFrame:
    """Queries with ``place`` (the first result of their lookup payload) or ``error``; payloads has query_id, payload
    (at most one each).
    """
    known = payloads.select("query_id", F.col("payload").alias("_p"))
    out = queries.join(known, "query_id", "left").withColumn(
        "place", F.get(F.from_json("_p", GEOCODE)["results"], F.lit(0))
    )
    error = F.coalesce(
        "error",
        F.when(F.col("_p").isNull(), "no answer").when(~_object(F.col("_p")), INVALID),
        F.when(F.col("place").isNull(), F.concat(F.lit(NOT_FOUND), F.col("location"))),
    )
    return out.withColumn("error", error).withColumn("place", F.when(error.isNull(), F.col("place"))).drop("_p")


def parse_forecasts(located: DataFrame, payloads: DataFrame) -> DataFrame:
    """query_id, ``result`` (location, current, daily_forecast, source) or ``error`` of each located query."""
    out = located.join(payloads.select("query_id", F.col("payload").alias("_p")), "query_id", "left")
    out = out.withColumn(
        "error", F.coalesce("error", F.when(F.col("_p").isNull(), "no answer").when(~_object(F.col("_p")), INVALID))
    )
    out = out.withColumn("_f", F.from_json("_p", FORECAST))
    now, units, metric = F.col("_f.current"), F.col("_f.current_units"), F.col("units") == "metric"
    pick = lambda given, a, b: F.coalesce(given, F.when(metric, a).otherwise(b))
    current = F.struct(
        F.coalesce(now["time"], F.lit("")).alias("time"), *[now[v].alias(k) for k, v in MEASURES.items()],
        now["weather_code"].alias("weather_code"), describe(now["weather_code"]).alias("weather_description"),
        pick(units["temperature_2m"], "degC", "degF").alias("temperature_unit"),
        pick(units["wind_speed_10m"], "km/h", "mph").alias("wind_speed_unit"),
        pick(units["precipitation"], "mm", "inch").alias("precipitation_unit"),
    )
    result = F.struct(
        F.col("place").alias("location"), current.alias("current"),
        daily_rows(F.col("_f.daily")).alias("daily_forecast"), F.lit(SOURCE).alias("source")
    )
    return out.select("query_id", F.when(F.col("error").isNull(), result).alias("result"), "error")


def daily_rows(daily: Column) -> Column:
    """Parallel arrays as an array of days, one per ``time``; shorter arrays are padded with nulls, longer ones cut;
    without ``time`` it is empty.
    """
    day = lambda t, i: F.struct(
        t.alias("date"), F.get(daily["weather_code"], i).alias("weather_code"),
        describe(F.get(daily["weather_code"], i)).alias("weather_description"),
        F.get(daily["temperature_2m_max"], i).alias("temperature_max"),
        F.get(daily["temperature_2m_min"], i).alias("temperature_min"),
        F.get(daily["precipitation_sum"], i).alias("precipitation_sum"),
    )
    return F.coalesce(F.transform(daily["time"], day), F.transform(F.array().cast("array<string>"), day))


def answers(parsed: DataFrame) -> DataFrame:
    """query_id and the JSON answer, indented and with its null fields: the result, or an error with a hint."""
    fault = F.struct("error", F.lit(HINT).alias("hint"))
    shown = lambda c: T.json_indented(c, parsed.select(c.alias("c")).schema["c"].dataType)
    return parsed.select(
        "query_id", F.when(F.col("error").isNull(), shown(F.col("result"))).otherwise(shown(fault)).alias("answer")
    )


def current_weather(queries: DataFrame, places: DataFrame, forecasts: DataFrame) -> DataFrame:
    """The whole tool: validated queries, lookup and forecast payloads to JSON answers; a faulty row gives an error
    answer and stops no other.
    """
    return answers(parse_forecasts(locate(check_queries(queries), places), forecasts))
