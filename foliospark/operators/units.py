"""Quantities of weather readings in common units, whatever the units and places they were recorded in."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.functions.automaton import AliasFinder, longest

#: Canonical unit -> (quantity, factor, offset, spellings); value * factor + offset is in °C, km/h or mm.
UNITS = {
    "celsius": (
        "temperature", 1.0, 0.0,
        "°c|℃|c|celsius|centigrade|degc|deg c|deg. c|degree c|degrees c|degree celsius|degrees celsius|deg celsius|° c|º c|ºc|độ c|do c|độ|oc"
    ),
    "decicelsius": (
        "temperature", 0.1, 0.0,
        "degc x10|degc*10|°c x10|°c*10|c x10|celsius x10|deg c x10|degc ×10|0.1 degc|0.1 deg c|0.1degc|0.1 °c|0.1°c|0.1 c|0,1 degc|0,1 °c|0.1 celsius|1/10 °c|1/10 ℃|0.1 ℃|1/10°c|1/10 degc|1/10 deg c|1/10 c|1/10 celsius|tenths of °c|tenths degc|tenth degc|decidegree c|ddegc"
    ),
    "fahrenheit": (
        "temperature", 5.0 / 9.0, -160.0 / 9.0,
        "°f|℉|f|fahrenheit|degf|deg f|deg. f|degree f|degrees f|degree fahrenheit|degrees fahrenheit|deg fahrenheit|° f|º f|ºf|độ f|do f"
    ),
    "kelvin": ("temperature", 1.0, -273.15, "k|kelvin|kelvins|°k|degk|deg k|độ k"),
    "kilometres_per_hour": (
        "wind_speed", 1.0, 0.0,
        "km/h|kmh|kph|kmph|km/hr|km/hour|km h-1|kmh-1|km.h-1|km/giờ|km/gio|kilometres per hour|kilometers per hour|km per hour"
    ),
    "miles_per_hour": ("wind_speed", 1.609344, 0.0, "mph|mi/h|mi/hr|mile/h|miles/h|miles per hour|dặm/giờ|mp/h"),
    "metres_per_second": (
        "wind_speed", 3.6, 0.0,
        "m/s|mps|ms-1|m s-1|m.s-1|m/sec|m/giây|m/giay|metres per second|meters per second|ms^-1|m s^-1|m·s-1"
    ),
    "knots": ("wind_speed", 1.852, 0.0, "kn|kt|kts|knot|knots|hải lý/giờ"),
    "millimetres": (
        "precipitation", 1.0, 0.0,
        "mm|millimetre|millimetres|millimeter|millimeters|milimet|l/m2|l/m²|l/m^2|lm-2|l m-2|litre/m2|lít/m2|kg/m2|kg/m²"
    ),
    "centimetres": ("precipitation", 10.0, 0.0, "cm|centimetre|centimetres|centimeter|centimeters|centimet"),
    "inches": ("precipitation", 25.4, 0.0, "in|in.|inch|inches|inch(es)|\"|″|''"),
    "hundredths_inch": (
        "precipitation", 0.254, 0.0,
        "0.01 in|0.01in|0.01 inch|0.01 inches|0.01\"|0.01 \"|0,01 in|0,01 inch|1/100 inch|1/100 in|1/100 inches|1/100in|1/100 \"|1/100\"|hundredths of an inch|hundredths in|in/100|inch/100"
    ),
}
#: Words that name a quantity before its number or unit.
LABELS = {
    "temperature": "temperature|temp|temp.|t|air temp|nhiệt độ|nhiet do",
    "wind_speed": "wind speed|wind|w|windspeed|ws|tốc độ gió|gió|gio",
    "precipitation": "precipitation|precip|precip.|p|rainfall|rain|lượng mưa|luong mua|mưa",
    "other": "humidity|độ ẩm|do am|pressure|cloud|sensor|gust|dew point|dewpoint|áp suất",
}
#: The units of a query that asked for metric or imperial ones.
DEFAULTS = {
    "metric": {"temperature": "celsius", "wind_speed": "kilometres_per_hour", "precipitation": "millimetres"},
    "imperial": {"temperature": "fahrenheit", "wind_speed": "miles_per_hour", "precipitation": "inches"},
}
#: Conversion is exact to this.
TOLERANCE = 1e-9
QUANTITIES = ("temperature", "wind_speed", "precipitation")
_NUMBER = re.compile(r"(?<![\w.,/-])[-+−]?\d+(?:[.,]\d+)?")
_GAP = re.compile(r"[\s:=\[(]*(?:is|are|was|of|là|at|about|~|≈)?[\s:=\[(]*")
_IN = re.compile(r"[\s:=]*(?:in|unit|units|đơn vị|tính bằng)[\s:=\[(]+")
_NEAR = re.compile(r"[\s\[(]*")


class RemarkReader:
    """Finds values and units of the three quantities in free text."""

    def __init__(self):
        self.units = AliasFinder(
            (a, name) for name, (_, _, _, spellings) in UNITS.items() for a in spellings.split("|")
        )
        self.labels = AliasFinder((a, quantity) for quantity, words in LABELS.items() for a in words.split("|"))
        self.columns: dict[tuple[str, str], str | None] = {}

    def unit(self, text: str | None, quantity: str) -> str | None:
        """The unit that a unit column names: its longest alias of a unit of ``quantity``, with no further letters or
        digits; null where it is null, empty or a filler.
        """
        if text is None:
            return None
        at = (text, quantity)
        if at not in self.columns:
            if len(self.columns) > 100_000:  # spellings are few; free text in the column must not fill the memory
                self.columns.clear()
            key = " ".join(text.lower().split())
            whole = [
                h for h in self.units.hits(key) if UNITS[h[2]][0] == quantity and not re.search(
                    r"\w", key[: h[0]] + key[h[1] :]
                )
            ]
            self.columns[at] = max(whole, key=lambda h: h[1] - h[0])[2] if whole else None
        return self.columns[at]

    def read(self, text: str | None) -> dict[str, tuple[float | None, str | None]]:
        """``quantity -> (value, unit)`` as far as the remark states them; the first statement of a quantity holds."""
        found: dict[str, tuple[float | None, str | None]] = {}
        if not text:
            return found
        low = text.lower()
        if len(low) != len(text):  # a character whose lower case is longer: positions only serve the lower-cased text
            text = low
        hits = self.units.hits(low)
        for start, end, quantity in self.labels.find(low):
            if start and low[start - 1] in "-_/" or quantity == "other":
                continue
            named = _IN.match(low, end)
            if named and (hit := self._unit_at(named.end(), hits, quantity)):
                found.setdefault(quantity, (None, hit))
                continue
            at = _GAP.match(low, end).end()
            number = _NUMBER.match(low, at)
            if not number or at == end:
                continue
            value = float(number.group().replace(",", ".").replace("−", "-"))
            unit = self._unit_at(_NEAR.match(low, number.end()).end(), hits, quantity)
            found.setdefault(quantity, (value, unit))
        for start, end, name in longest(hits):  # a number with a unit that only one quantity has, without a label
            quantity = UNITS[name][0]
            if quantity in found or end - start < 2 or not any(c.isalpha() or c in "°℃℉" for c in low[start:end]):
                continue
            before = re.search(r"(?<![\w.,/-])([-+−]?\d+(?:[.,]\d+)?)[\s\[(]*$", low[:start])
            if before and not self._labelled_other(low[: before.start()]):
                found[quantity] = (float(before.group(1).replace(",", ".").replace("−", "-")), name)
        return found

    @staticmethod
    def _unit_at(at: int, hits: list, quantity: str) -> str | None:
        """The longest alias of a unit of ``quantity`` that begins at ``at``."""
        here = [h for h in hits if h[0] == at and UNITS[h[2]][0] == quantity]
        return max(here, key=lambda h: h[1])[2] if here else None

    def _labelled_other(self, before: str) -> bool:
        hits = self.labels.find(before)
        return bool(hits) and not re.search(r"[;,.]\s", before[hits[-1][1] :])


def minute(time: Column) -> Column:
    """Local time to the minute of its several spellings, as ``yyyy-MM-dd HH:mm``; null where there is none."""
    parts = r"^\s*(\d{4})[-/.]?(\d{2})[-/.]?(\d{2})[T\s]+(\d{1,2}):?(\d{2})"
    g = [F.regexp_extract(time, parts, i) for i in range(1, 6)]
    return F.when(
        time.rlike(parts),
        F.concat(g[0], F.lit("-"), g[1], F.lit("-"), g[2], F.lit(" "), F.lpad(g[3], 2, "0"), F.lit(":"), g[4])
    )


def factors(df: DataFrame) -> DataFrame:
    """The fixed table of conversion factors (one row per canonical unit)."""
    return df.sparkSession.createDataFrame(
        [(name, q, f, o) for name, (q, f, o, _) in UNITS.items()],
        "unit string, quantity string, factor double, offset double"
    )


def readings(weather: DataFrame) -> DataFrame:
    """One row per observation and quantity that has a value: obs_id, place_id, minute, quantity, recorded, unit, value.

    ``recorded`` is the number as written, ``value`` the number in °C, km/h or
    mm, ``unit`` the canonical unit.  The unit is that of the unit column, else
    that of the remark, else the default of ``units`` (anything but imperial
    counts as metric).  A value missing in its column is taken from the remark;
    missing in both it has no row, nor has NaN.  Repeated deliveries of an obs_id
    give one row.  Units that are no known spelling count as missing.  A row
    with null obs_id is kept (all of them as one).  The remark is searched where
    the row is; then the fixed factors (a dozen rows) are joined.
    """
    narrow = weather.select(
        "obs_id", "place_id", minute(F.col("time")).alias("minute"),
        F.when(F.lower(F.trim("units")) == "imperial", "imperial").otherwise("metric").alias("units"),
        *[F.col(q).cast("double").alias(q) for q in QUANTITIES], *[f"{q}_unit" for q in QUANTITIES], "remark",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = RemarkReader()
        for batch in batches:
            column = {n: batch.column(i).to_pylist() for i, n in enumerate(batch.schema.names)}
            rows: list[int] = []
            out: tuple[list, list, list] = ([], [], [])
            for i, (remark, system) in enumerate(zip(column["remark"], column["units"])):
                said = reader.read(remark)
                for q in QUANTITIES:
                    value, unit = column[q][i], reader.unit(column[f"{q}_unit"][i], q)
                    noted, noted_unit = said.get(q, (None, None))
                    value = noted if value is None or value != value else value
                    if value is not None:
                        rows.append(i)
                        for o, x in zip(out, (q, value, unit or noted_unit or DEFAULTS[system][q])):
                            o.append(x)
            keys = [batch.column(i).take(pa.array(rows, pa.int64())) for i in range(3)]
            yield pa.RecordBatch.from_arrays(
                [*keys, pa.array(out[0], pa.string()), pa.array(out[1], pa.float64()), pa.array(out[2], pa.string())],
                ["obs_id", "place_id", "minute", "quantity", "recorded", "unit"]
            )

    types = {f.name: f.dataType.simpleString() for f in narrow.schema.fields}
    found = narrow.mapInArrow(
        run,
        f"obs_id {types['obs_id']}, place_id {types['place_id']}, minute string, quantity string, recorded double, unit string"
    )
    found = found.dropDuplicates(["obs_id", "quantity"])
    known = F.broadcast(factors(weather))  # a dozen fixed rows
    return found.join(known, ["quantity", "unit"]).select(
        "obs_id", "place_id", "minute", "quantity", "recorded", "unit",
        (F.col("recorded") * F.col("factor") + F.col("offset")).alias("value")
    )


def convert(weather: DataFrame) -> DataFrame:
    """One row per observation that has any of the values: obs_id, temperature_c, wind_speed_kmh, precipitation_mm
    (null where missing).
    """
    out = readings(weather).groupBy("obs_id")
    names = {"temperature": "temperature_c", "wind_speed": "wind_speed_kmh", "precipitation": "precipitation_mm"}
    return out.agg(*[F.max(F.when(F.col("quantity") == q, F.col("value"))).alias(n) for q, n in names.items()])


def agreeing(weather: DataFrame, within: float = 0.5) -> DataFrame:
    """Pairs obs_id_a < obs_id_b of one place and minute that agree in a quantity within ``within`` though recorded in
    different units.

    ``within`` is meant for the values as they are written: after conversion they
    may differ by ``TOLERANCE`` more.  Values are put into bins a little wider
    than both, so a pair lies in equal or neighbouring bins, and a place with very
    many readings at one time is compared bin by bin.  Rows without a place, time
    or obs_id have no pair.
    """
    found = readings(weather).where(
        F.col("place_id").isNotNull() & F.col("minute").isNotNull() & F.col("obs_id").isNotNull()
    )
    found = found.withColumn("bin", F.floor(F.col("value") / (within + 1000 * TOLERANCE)))
    keys = ["place_id", "minute", "quantity"]
    a = found.select(
        *keys, "bin", F.col("obs_id").alias("obs_id_a"), F.col("unit").alias("unit_a"), F.col("value").alias("value_a")
    )
    b = found.select(
        *keys, F.explode(F.array(F.col("bin") - 1, F.col("bin"), F.col("bin") + 1)).alias("bin"),
        F.col("obs_id").alias("obs_id_b"), F.col("unit").alias("unit_b"), F.col("value").alias("value_b")
    )
    pairs = a.join(b, [*keys, "bin"]).where(
        (F.col("obs_id_a") < F.col("obs_id_b")) & (F.col("unit_a") != F.col("unit_b")) & (
            F.abs(F.col("value_a") - F.col("value_b")) <= within + TOLERANCE
        )
    )
    return pairs.select("obs_id_a", "obs_id_b", "quantity")
