"""DuckDB SQL with the same results as the core's queries."""

from __future__ import annotations

from foliospark.operators import layout, units, weather
from foliospark.operators.context import BUDGET_SHARES, INJECTION, PERSONAL

ORACLE: dict[str, str] = {}
_COURSES = "c AS (SELECT DISTINCT course_uid, transcript_id, ord, semester, code, name, credits, class_id, process_score, exam_score, letter_grade FROM courses)"
_POINTS = "CASE letter_grade WHEN 'A+' THEN 4.0 WHEN 'A' THEN 4.0 WHEN 'B+' THEN 3.5 WHEN 'B' THEN 3.0 WHEN 'C+' THEN 2.5 WHEN 'C' THEN 2.0 WHEN 'D+' THEN 1.5 WHEN 'D' THEN 1.0 WHEN 'F' THEN 0.0 END::DOUBLE"
_OK = f"credits > 0 AND {_POINTS} IS NOT NULL"
_GRADED = f"g AS (SELECT *, {_POINTS} AS points FROM c WHERE {_OK})"
_BLOCKS = "b AS (SELECT * EXCLUDE (ingested_at) FROM document_blocks QUALIFY row_number() OVER (PARTITION BY block_uid ORDER BY ingested_at) = 1)"
_PR = "pr AS (SELECT * EXCLUDE (ingested_at) FROM page_results QUALIFY row_number() OVER (PARTITION BY page_uid ORDER BY ingested_at) = 1)"
_W = "w AS (SELECT * EXCLUDE (received_at) FROM current_weather QUALIFY row_number() OVER (PARTITION BY obs_id ORDER BY received_at) = 1)"
_WHITE = "'[\\s\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}\\x0b\\x1c-\\x1f]+'"


def _strip(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^' || {_WHITE}, ''), {_WHITE} || '$', '')"


_PAGES = f"p AS (SELECT doc, page, coalesce(string_agg(t, E'\\n\\n' ORDER BY block_id) FILTER (t <> ''), '') AS markdown, bool_or(block_type IN ('image', 'figure', 'math', 'algorithm')) AS has_ocr_blocks FROM (SELECT *, {_strip('coalesce(markdown_result, chr(10))')} AS t FROM b) GROUP BY doc, page)"
_DIMS = "dims AS (SELECT DISTINCT doc, page, 595.0::DOUBLE AS width, 842.0::DOUBLE AS height FROM b)"
_BOXES = "boxes AS (SELECT doc, page, bbox.x0 AS x0, bbox.y0 AS y0, bbox.x1 AS x1, bbox.y1 AS y1 FROM b WHERE block_type IN ('text', 'unknown'))"
_HEADS = f"h AS (SELECT doc, page::BIGINT * 100000 + block_id AS ord, heading_level AS level, {_strip('raw_content')} AS title, page FROM b WHERE heading_level IS NOT NULL)"


def _two(x: str) -> str:
    """Two digits of the exact binary value, ties to even (printf works on it)."""
    return f"coalesce(printf('%.2f', ({x})::DOUBLE)::DOUBLE, 0.0::DOUBLE)"


def _gpa(source: str) -> str:
    return f"SELECT transcript_id, semester, {_two(f'sum(CASE WHEN {_OK} THEN credits * {_POINTS} END) / nullif(sum(CASE WHEN {_OK} THEN credits END), 0)')} AS gpa, coalesce(sum(CASE WHEN {_OK} THEN credits END), 0)::BIGINT AS credits_counted FROM {source} GROUP BY ALL"


def _cpa(where: str, source: str = "g") -> str:
    return f"SELECT transcript_id, {_two('sum(credits * points) / nullif(sum(credits), 0)')} AS cpa, sum(credits)::BIGINT AS cumulative_credits FROM (SELECT * FROM {source} WHERE {where} QUALIFY row_number() OVER (PARTITION BY transcript_id, code ORDER BY points DESC, semester, ord) = 1) GROUP BY ALL"


_CHANGED = "x AS (SELECT c.* REPLACE (CASE WHEN code = 'KD2416' THEN 'A' WHEN code = 'QX1010' AND semester = '20201' THEN 'B+' WHEN code = 'ZN1121' THEN 'W' ELSE letter_grade END AS letter_grade) FROM c)"
ORACLE["gpa_by_semester"] = f"WITH {_COURSES} {_gpa('c')}"
ORACLE["cpa_best_attempt"] = f"WITH {_COURSES}, {_GRADED} {_cpa('true')}"
ORACLE["cpa_up_to"] = f"WITH {_COURSES}, {_GRADED} {_cpa('semester <= ' + chr(39) + '20203' + chr(39))}"
ORACLE["best_attempts"] = f"WITH {_COURSES}, {_GRADED} SELECT transcript_id, code, semester, credits, letter_grade, points, first_semester FROM (SELECT *, min(semester) OVER (PARTITION BY transcript_id, code) AS first_semester FROM g) QUALIFY row_number() OVER (PARTITION BY transcript_id, code ORDER BY points DESC, semester, ord) = 1"
ORACLE["cpa_per_semester"] = f"""WITH {_COURSES}, {_GRADED}, s AS (SELECT DISTINCT transcript_id, semester FROM c),
best AS (SELECT s.transcript_id, s.semester, g.credits, g.points FROM s JOIN g ON g.transcript_id = s.transcript_id AND g.semester <= s.semester QUALIFY row_number() OVER (PARTITION BY s.transcript_id, s.semester, g.code ORDER BY g.points DESC, g.semester, g.ord) = 1),
k AS (SELECT transcript_id, semester, sum(credits * points) / nullif(sum(credits), 0) AS cpa, sum(credits) AS n FROM best GROUP BY ALL), q AS ({_gpa('c')})
SELECT q.transcript_id, q.semester, q.gpa, {_two('k.cpa')} AS cpa, q.credits_counted, coalesce(k.n, 0)::BIGINT AS cumulative_credits FROM q LEFT JOIN k USING (transcript_id, semester)"""
ORACLE["simulate_gpas"] = f"WITH {_COURSES}, {_CHANGED} {_gpa('x')}"
ORACLE["simulate_cpa"] = f"WITH {_COURSES}, {_CHANGED}, g AS (SELECT *, {_POINTS} AS points FROM x WHERE {_OK}) {_cpa('semester <= ' + chr(39) + '20231' + chr(39))}"
ORACLE["semester_list"] = "SELECT DISTINCT semester FROM courses"
# a row without a class or without scores reads a number at the end of its name as credits, and the numbers after it
# one place further on
ORACLE["parse_courses"] = f"""WITH {_COURSES}, n AS (SELECT * REPLACE (trim(regexp_replace(name, '[\\p{{Z}}\\s]+', ' ', 'g')) AS name) FROM c WHERE transcript_id % 7 <> 0 OR ord < 5),
r AS (SELECT * FROM n WHERE class_id IS NOT NULL UNION ALL SELECT * REPLACE (regexp_replace(name, ' [0-9]+$', '') AS name, regexp_extract(name, '([0-9]+)$', 1)::INT AS credits, credits::VARCHAR AS class_id) FROM n WHERE class_id IS NULL AND regexp_matches(name, ' [0-9]+$')
UNION ALL SELECT * REPLACE (regexp_replace(name, ' [0-9]+$', '') AS name, regexp_extract(name, '([0-9]+)$', 1)::INT AS credits, credits::VARCHAR AS class_id, class_id::DOUBLE AS exam_score) FROM n WHERE class_id IS NOT NULL AND exam_score IS NULL AND process_score IS NULL AND regexp_matches(name, ' [0-9]+$'))
SELECT transcript_id::VARCHAR AS doc, semester, code, name, credits, class_id, CASE WHEN exam_score IS NOT NULL THEN process_score END AS process_score, coalesce(exam_score, process_score) AS exam_score, letter_grade FROM r WHERE coalesce(exam_score, process_score) IS NOT NULL"""
ORACLE["transcript_json"] = f"WITH {_COURSES} SELECT transcript_id, to_json(list({{'semester': semester, 'code': code, 'name': name, 'credits': credits, 'class_id': class_id, 'process_score': process_score, 'exam_score': exam_score, 'letter_grade': letter_grade}} ORDER BY ord))::VARCHAR AS courses FROM c GROUP BY ALL"
_LABELS = "CASE weather_code " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in weather.WEATHER_CODES.items()) + f" ELSE coalesce('{weather.UNKNOWN_CODE}' || weather_code, '{weather.NO_CODE}') END"
ORACLE["code_labels"] = f"WITH {_W} SELECT obs_id, {_LABELS} AS label FROM w"
_ERR = "CASE WHEN obs_id % 17 = 0 THEN 'location is empty' WHEN obs_id % 13 = 0 THEN 'units is neither metric nor imperial' WHEN obs_id % 7 = 0 THEN 'Could not find coordinates for location: ' || name WHEN obs_id % 11 = 0 THEN 'Weather service returned an invalid response.' END"
ORACLE["weather_results"] = f"WITH {_W}, r AS (SELECT w.*, p.name, {_ERR.replace('name', 'p.name')} AS error FROM w JOIN places p USING (place_id)) SELECT obs_id AS query_id, CASE WHEN error IS NULL THEN name END AS place, CASE WHEN error IS NULL THEN temperature END AS temperature, CASE WHEN error IS NULL THEN {_LABELS} END AS label, CASE WHEN error IS NULL THEN coalesce(temperature_unit, CASE units WHEN 'metric' THEN 'degC' ELSE 'degF' END) END AS unit, CASE WHEN error IS NULL THEN CASE units WHEN 'metric' THEN 'mm' ELSE 'inch' END END AS rain_unit, CASE WHEN error IS NULL THEN CASE WHEN obs_id % 2 = 0 THEN 3 ELSE 0 END END AS days, error FROM r"
_NONE = weather.NO_CODE
ORACLE["weather_days"] = f"WITH {_W}, r AS (SELECT w.*, i FROM w JOIN places p USING (place_id), generate_series(1, 3) AS t(i) WHERE obs_id % 7 <> 0 AND obs_id % 11 <> 0 AND obs_id % 13 <> 0 AND obs_id % 17 <> 0 AND obs_id % 2 = 0) SELECT obs_id AS query_id, 'd' || i AS date, CASE WHEN i = 1 THEN weather_code END AS weather_code, CASE WHEN i = 1 THEN {_LABELS} ELSE '{_NONE}' END AS weather_description, CASE i WHEN 1 THEN temperature WHEN 2 THEN apparent_temperature END AS temperature_max, NULL::DOUBLE AS temperature_min, NULL::DOUBLE AS precipitation_sum FROM r"


def _object(fields: dict[str, str], level: int = 0) -> str:
    """SQL of an indented JSON object of SQL values; values that begin with a brace or bracket are JSON already."""
    pad = "  " * (level + 1)
    parts = [_q(f'{pad}"{k}": ') + " || " + (v if v.startswith("(/*json*/") else f"coalesce(to_json({v})::VARCHAR, 'null')") for k, v in fields.items()]
    return "(/*json*/" + _q("{\n") + " || " + f" || {_q(',' + chr(10))} || ".join(parts) + " || " + _q("\n" + "  " * level + "}") + ")"


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_DAY = lambda i, code, label, most: _object({"date": f"'d{i}'", "weather_code": code, "weather_description": label, "temperature_max": most, "temperature_min": "NULL", "precipitation_sum": "NULL"}, 2)
_DAYS = " || ',\n    ' || ".join((_DAY(1, "weather_code", _LABELS, "temperature"), _DAY(2, "NULL", f"'{weather.NO_CODE}'", "apparent_temperature"), _DAY(3, "NULL", f"'{weather.NO_CODE}'", "NULL")))
_NOW = {k: k for k in ("time", *weather.MEASURES, "weather_code")} | {
    "weather_description": _LABELS, "temperature_unit": "coalesce(temperature_unit, CASE units WHEN 'metric' THEN 'degC' ELSE 'degF' END)",
    "wind_speed_unit": "coalesce(wind_speed_unit, CASE units WHEN 'metric' THEN 'km/h' ELSE 'mph' END)", "precipitation_unit": "CASE units WHEN 'metric' THEN 'mm' ELSE 'inch' END",
}
_ANSWER = _object({
    "location": _object({k: f"p.{k}" for k in ("name", "country", "admin1", "latitude", "longitude", "timezone")}, 1), "current": _object(_NOW, 1),
    "daily_forecast": f"(/*json*/CASE WHEN obs_id % 2 = 0 THEN E'[\\n    ' || {_DAYS} || E'\\n  ]' ELSE '[]' END)", "source": f"'{weather.SOURCE}'",
})
_FAULT = _object({"error": _ERR.replace("name", "p.name"), "hint": f"'{weather.HINT}'"})
ORACLE["weather_answer_json"] = f"WITH {_W} SELECT obs_id AS query_id, CASE WHEN obs_id % 7 = 0 OR obs_id % 11 = 0 OR obs_id % 13 = 0 OR obs_id % 17 = 0 THEN {_FAULT} ELSE {_ANSWER} END AS answer FROM w JOIN places p USING (place_id)"
ORACLE["request_parameters"] = f"WITH {_W}, r AS (SELECT CASE WHEN obs_id % 13 = 0 THEN 'stone' ELSE units END AS units, obs_id % 2 = 0 AS include_forecast FROM w JOIN places USING (place_id)) SELECT units, include_forecast, CASE units WHEN 'metric' THEN 'celsius' ELSE 'fahrenheit' END AS temperature_unit, CASE units WHEN 'metric' THEN 'kmh' ELSE 'mph' END AS wind_speed_unit, CASE units WHEN 'metric' THEN 'mm' ELSE 'inch' END AS precipitation_unit, CASE WHEN include_forecast THEN 3 ELSE 1 END AS forecast_days, count(*) AS count FROM r GROUP BY ALL"


def _units() -> str:
    """Values and units of the three quantities, by patterns over remark instead of an automaton."""
    spelled = ", ".join(f"({_q(name)}, {_q(q)}, {f!r}::DOUBLE, {o!r}::DOUBLE, {_q(s)})" for name, (q, f, o, spellings) in units.UNITS.items() for s in spellings.split("|"))
    labels = {"temperature": "temperature|temp|t|nhiệt độ", "wind_speed": "wind speed|wind|w|gió", "precipitation": "precip|p|rainfall|lượng mưa"}
    parts = []
    for q, words in labels.items():
        head = f"(?:^|[^a-zà-ỹ])(?:{words})"
        value = f"{head}(?:[:= ]|is)+ ?(-?[0-9]+(?:[.,][0-9]+)?)"
        stated = f"{head}(?:(?:[:= ]|is)+ ?-?[0-9]+(?:[.,][0-9]+)?[ \\[]*| in )([^;,\\]\\[]*?)(?:\\]|[;,.] |[;,.]?$)"
        parts.append(
            f"SELECT obs_id, place_id, time, units, {_q(q)} AS quantity, {q} AS given, {q}_unit AS gu, try_cast(replace(nullif(regexp_extract(r, {_q(value)}, 1), ''), ',', '.') AS DOUBLE) AS noted, trim(regexp_extract(r, {_q(stated)}, 1)) AS nu FROM (SELECT *, lower(coalesce(remark, '')) AS r FROM w)"
        )
    return (
        f"WITH {_W}, sp(unit, quantity, factor, off, spelling) AS (VALUES {spelled}), found AS ({' UNION ALL '.join(parts)}), "
        "named AS (SELECT f.*, coalesce(f.given, f.noted) AS v, coalesce(a.unit, n.unit, CASE f.quantity WHEN 'temperature' THEN CASE f.units WHEN 'imperial' THEN 'fahrenheit' ELSE 'celsius' END WHEN 'wind_speed' THEN CASE f.units WHEN 'imperial' THEN 'miles_per_hour' ELSE 'kilometres_per_hour' END ELSE CASE f.units WHEN 'imperial' THEN 'inches' ELSE 'millimetres' END END) AS unit "
        "FROM found f LEFT JOIN sp a ON a.quantity = f.quantity AND a.spelling = lower(trim(f.gu)) LEFT JOIN sp n ON n.quantity = f.quantity AND n.spelling = f.nu), "
        "k AS (SELECT DISTINCT unit, factor, off FROM sp), val AS (SELECT obs_id, place_id, substr(replace(time, 'T', ' '), 1, 16) AS m, n.quantity, n.unit, v * factor + off AS x FROM named n JOIN k ON k.unit = n.unit WHERE v IS NOT NULL) "
    )


ORACLE["p5_convert"] = _units() + "SELECT obs_id, max(CASE quantity WHEN 'temperature' THEN x END) AS temperature_c, max(CASE quantity WHEN 'wind_speed' THEN x END) AS wind_speed_kmh, max(CASE quantity WHEN 'precipitation' THEN x END) AS precipitation_mm FROM val GROUP BY obs_id"
ORACLE["p5_found"] = _units() + "SELECT a.obs_id AS obs_id_a, b.obs_id AS obs_id_b, a.quantity FROM val a JOIN val b ON a.place_id = b.place_id AND a.m = b.m AND a.quantity = b.quantity AND a.obs_id < b.obs_id AND a.unit <> b.unit AND abs(a.x - b.x) <= 0.5 + 1e-9"
ORACLE["box_measures"] = f"WITH {_BLOCKS} SELECT block_uid, bbox.x1 - bbox.x0 AS width, bbox.y1 - bbox.y0 AS height, (bbox.x1 - bbox.x0) * (bbox.y1 - bbox.y0) AS area, block_type IN ('image', 'figure', 'math', 'algorithm') AS needs_ocr FROM b"
ORACLE["weighted_mode"] = f"""WITH {_BLOCKS}, s AS (SELECT doc, page, round(font_size, 1) AS size, sum(length({_strip('raw_content')})) AS n, min(block_id) AS seen FROM b WHERE font_size > 0 AND length({_strip('raw_content')}) > 0 GROUP BY ALL),
m AS (SELECT doc, page, greatest(size, 6.0) AS body FROM s QUALIFY row_number() OVER (PARTITION BY doc, page ORDER BY n DESC, seen) = 1), p AS (SELECT DISTINCT doc, page FROM b), k AS (SELECT doc, page, coalesce(body, 10.0)::DOUBLE AS body FROM p LEFT JOIN m USING (doc, page))
SELECT *, round(body * 1.6::DOUBLE, 2) AS h1, round(body * 1.35::DOUBLE, 2) AS h2, round(body * 1.15::DOUBLE, 2) AS h3 FROM k"""
_COVER = "cov AS (SELECT d.doc, d.page, d.width, d.height, s.slot::INT AS slot, coalesce(sum(greatest(x.y1 - x.y0, 0)), 0) AS covered FROM dims d, generate_series(0, 297) AS s(slot) LEFT JOIN boxes x ON x.doc = d.doc AND x.page = d.page AND s.slot BETWEEN greatest(trunc(x.x0 / 2), 0) AND least(trunc(x.x1 / 2), 297) GROUP BY ALL)"
_GUT = """f AS (SELECT *, slot - row_number() OVER (PARTITION BY doc, page ORDER BY slot) AS run FROM cov WHERE covered < 0.4 * height AND slot * 2.0 BETWEEN 0.3::DOUBLE * width AND 0.7::DOUBLE * width),
r AS (SELECT doc, page, min(slot) * 2.0 AS st, max(slot) * 2.0 + 2.0 - min(slot) * 2.0 AS wd FROM f GROUP BY doc, page, run HAVING wd >= 8),
gut AS (SELECT doc, page, (st + wd / 2)::DOUBLE AS gutter FROM r QUALIFY row_number() OVER (PARTITION BY doc, page ORDER BY wd DESC, st) = 1)"""
ORACLE["coverage_histogram"] = f"WITH {_BLOCKS}, {_DIMS}, {_BOXES}, {_COVER} SELECT doc, page, slot, round(covered, 6) AS covered FROM cov WHERE covered > 0"
ORACLE["gutter_runs"] = f"WITH {_BLOCKS}, {_DIMS}, {_BOXES}, {_COVER}, {_GUT} SELECT doc, page, gutter FROM gut SEMI JOIN boxes USING (doc, page)"  # a page without boxes has none
_BODY = "boxes AS (SELECT * FROM all_boxes WHERE NOT (y1 < 48 OR y0 > 842 - 48)), bdims AS (SELECT * FROM dims SEMI JOIN boxes USING (doc, page))"
ORACLE["page_layouts"] = f"""WITH {_BLOCKS}, {_DIMS}, {_BOXES.replace('boxes AS', 'all_boxes AS')}, {_BODY}, {_COVER.replace('FROM dims d', 'FROM bdims d')}, {_GUT},
sides AS (SELECT doc, page, count(*) FILTER (x1 <= 297.5 - 20) AS l, count(*) FILTER (x0 >= 297.5 + 20) AS r FROM boxes GROUP BY ALL)
SELECT doc, page, CASE WHEN g IS NULL THEN '1-column' ELSE '2-column' END AS layout, g AS gutter FROM (SELECT d.doc, d.page, coalesce(gut.gutter, CASE WHEN l >= 3 AND r >= 3 THEN 297.5::DOUBLE END) AS g FROM dims d LEFT JOIN gut USING (doc, page) LEFT JOIN sides USING (doc, page))"""
_VOTE = "n AS (SELECT doc, max(page) AS n FROM pr GROUP BY doc), sampled AS (SELECT DISTINCT doc, least(i, n - 1) + 1 AS page FROM n, generate_series(1, 4) AS t(i)), vote AS (SELECT doc, CASE WHEN avg(CASE layout WHEN '2-column' THEN 1.0 ELSE 0.0 END) > 0.5 THEN '2-column' ELSE '1-column' END AS layout FROM pr JOIN sampled USING (doc, page) GROUP BY doc)"
ORACLE["layout_vote"] = f"WITH {_PR}, {_VOTE} SELECT doc, layout FROM vote"
_ORDERED = """o AS (SELECT b.*, pr.layout, CASE WHEN bbox.x1 - bbox.x0 > 595.0 * 0.65::DOUBLE THEN 'full' WHEN bbox.x1 <= 317.5 THEN 'left' WHEN bbox.x0 >= 277.5 THEN 'right' ELSE 'full' END AS side FROM b JOIN pr USING (doc, page)),
ord AS (SELECT *, row_number() OVER (PARTITION BY doc, page ORDER BY CASE layout WHEN '2-column' THEN (side = 'right')::INT ELSE round_even(bbox.y0 / 5, 0) * 5 END, CASE layout WHEN '2-column' THEN bbox.y0 ELSE bbox.x0 END, CASE WHEN layout = '2-column' AND side = 'left' THEN 1 ELSE 0 END, block_uid)::INT AS place FROM o)"""
ORACLE["reading_order"] = f"WITH {_BLOCKS}, {_PR.replace('page_uid ORDER', 'page_uid ORDER')}, {_ORDERED} SELECT doc, page, block_uid AS ord, place FROM ord"


def _islands(types: str) -> str:
    return f"""t AS (SELECT *, block_type IN ({types}) AS m FROM ord), l AS (SELECT *, lag(m) OVER w AS pm, lag(bbox) OVER w AS pb FROM t WINDOW w AS (PARTITION BY doc, page ORDER BY place)),
j AS (SELECT *, coalesce(m AND pm AND bbox.y0 - pb.y1 <= 14 AND (least(pb.x1 - pb.x0, bbox.x1 - bbox.x0) <= 0 OR least(pb.x1, bbox.x1) - greatest(pb.x0, bbox.x0) >= 0.2::DOUBLE * least(pb.x1 - pb.x0, bbox.x1 - bbox.x0)), false) AS joins FROM l),
i AS (SELECT *, sum(CASE WHEN joins THEN 0 ELSE 1 END) OVER (PARTITION BY doc, page ORDER BY place) AS island FROM j)"""


ORACLE["merge_formulas"] = f"""WITH {_BLOCKS}, {_PR}, {_ORDERED}, {_islands("'math', 'algorithm', 'text'")} SELECT doc, page, island::BIGINT AS place, arg_min(block_uid, place) AS ord, round(min(bbox.y0), 3) AS y0, round(max(bbox.y1), 3) AS y1, length(coalesce(string_agg(raw_content, chr(10) ORDER BY place) FILTER (raw_content <> ''), ''))::INT AS chars FROM i GROUP BY doc, page, island"""
ORACLE["number_blocks"] = f"""WITH {_BLOCKS}, {_PR}, {_ORDERED}, {_islands("'math'")}, m AS (SELECT doc, page, island, arg_min(block_type, place) AS block_type, min(bbox.x0) AS x0, min(bbox.y0) AS y0, max(bbox.x1) AS x1, max(bbox.y1) AS y1 FROM i GROUP BY ALL),
k AS (SELECT *, block_type IN ('image', 'figure', 'math', 'algorithm') AND round((x1 - x0) * CASE block_type WHEN 'math' THEN 200 ELSE 150 END / 72) * round((y1 - y0) * CASE block_type WHEN 'math' THEN 200 ELSE 150 END / 72) >= 1600 AS has_crop FROM m)
SELECT doc, page, (row_number() OVER (PARTITION BY doc, page ORDER BY island) - 1)::INT AS block_id, t AS block_type, has_crop, t NOT IN ('image', 'figure', 'math', 'algorithm') AS is_done FROM (SELECT *, CASE WHEN block_type IN ('image', 'figure') AND NOT has_crop THEN 'text' ELSE block_type END AS t FROM k)"""
ORACLE["anti_overlap"] = f"WITH {_BLOCKS} SELECT block_uid FROM b x WHERE block_type <> 'table' AND NOT EXISTS (SELECT 1 FROM b t WHERE t.block_type = 'table' AND t.doc = x.doc AND t.page = x.page AND x.bbox.x0 < t.bbox.x1 AND t.bbox.x0 < x.bbox.x1 AND x.bbox.y0 < t.bbox.y1 AND t.bbox.y0 < x.bbox.y1)"
ORACLE["image_captions"] = f"""WITH {_BLOCKS}, im AS (SELECT doc, page, block_uid, bbox FROM b WHERE block_type IN ('image', 'figure')), cp AS (SELECT doc, page, block_uid AS o, bbox AS c, {_strip('caption')} AS t FROM b WHERE length(caption) > 0 AND regexp_matches({_strip('caption')}, '(?i)^(Figure|Fig\\.|Table|Tbl\\.|Hình|Bảng|Algorithm|Alg\\.)\\s*[0-9]+')),
n AS (SELECT im.block_uid, t, o FROM im JOIN cp USING (doc, page) WHERE c.y1 + 5 - bbox.y1 BETWEEN 0 AND 30 AND bbox.x1 > bbox.x0 AND (least(bbox.x1, c.x1) - greatest(bbox.x0, c.x0)) / (bbox.x1 - bbox.x0) > 0.3), f AS (SELECT block_uid, arg_min(t, o) AS t FROM n GROUP BY ALL)
SELECT doc, page, im.block_uid AS ord, CASE WHEN t IS NULL THEN 'image' ELSE 'figure' END AS block_type, coalesce(t, '') AS caption FROM im LEFT JOIN f USING (block_uid)"""
ORACLE["page_markdown"] = f"WITH {_BLOCKS}, {_PAGES} SELECT doc, page, md5(markdown) AS digest, has_ocr_blocks FROM p"
ORACLE["document_markdown"] = f"WITH {_BLOCKS}, {_PAGES} SELECT doc, md5(coalesce(string_agg('<!-- page ' || page || E' -->\\n\\n' || markdown, E'\\n\\n---\\n\\n' ORDER BY page) FILTER (markdown <> ''), '')) AS digest FROM p GROUP BY doc"
_LINES = f"ln AS (SELECT doc, page, list_filter(list_transform(string_split(markdown, chr(10)), lambda x: {_strip('x')}), lambda x: x <> '') AS l FROM p)"
_REP = f"rep AS (SELECT doc, line, count(*) AS n FROM (SELECT doc, unnest(list_concat(l[1:2], CASE WHEN len(l) <= 2 THEN l ELSE l[-2:] END)) AS line FROM ln) WHERE length(line) BETWEEN 4 AND 80 AND len(list_filter(regexp_split_to_array(line, {_WHITE}), lambda x: x <> '')) <= 10 GROUP BY ALL HAVING n >= 4)"
ORACLE["repeated_lines"] = f"WITH {_BLOCKS}, {_PAGES}, {_LINES}, {_REP} SELECT doc, line, n FROM rep"
ORACLE["drop_repeated"] = f"WITH {_BLOCKS}, {_PAGES}, {_LINES}, {_REP}, r AS (SELECT doc, list(line) AS rs FROM rep GROUP BY doc) SELECT doc, page, md5(CASE WHEN rs IS NULL THEN markdown ELSE array_to_string(list_filter(string_split(markdown, chr(10)), lambda x: NOT list_contains(rs, {_strip('x')})), chr(10)) END) AS digest FROM p LEFT JOIN r USING (doc)"
_REFS = "SELECT doc, max(page) FILTER (regexp_matches(markdown, '(?m)^(#+)?\\s*(References|REFERENCES)\\s*$') OR regexp_matches(markdown, '(?m)^\\s*(Bibliography|BIBLIOGRAPHY|TÀI LIỆU THAM KHẢO)\\s*$') OR regexp_matches(markdown, '(?im)^\\s*References and Further Reading\\s*$')) AS references_page FROM p GROUP BY doc"
ORACLE["references_pages"] = f"WITH {_BLOCKS}, {_PAGES} {_REFS}"
ORACLE["whitespace_norm"] = f"WITH {_BLOCKS} SELECT block_uid, md5({_strip(chr(10).join(['regexp_replace(regexp_replace(raw_content, ' + _q('(?m)[ ' + chr(92) + 't]+$') + ', ' + _q('') + ', ' + _q('g') + '), ' + _q(chr(92) + 'n{3,}') + ', E' + _q(chr(92) + 'n' + chr(92) + 'n') + ', ' + _q('g') + ')']))}) AS digest FROM b"
ORACLE["section_paths"] = f"""WITH RECURSIVE {_BLOCKS}, {_HEADS}, s AS (SELECT doc, ord, level, title, row_number() OVER (PARTITION BY doc ORDER BY ord) AS i FROM h),
st(doc, i, ord, ls, ts) AS (SELECT doc, i, ord, [level], [title] FROM s WHERE i = 1 UNION ALL SELECT s.doc, s.i, s.ord, list_append(list_filter(st.ls, lambda x: x < s.level), s.level), list_append(st.ts[1:len(list_filter(st.ls, lambda x: x < s.level))], s.title) FROM st JOIN s ON s.doc = st.doc AND s.i = st.i + 1)
SELECT doc, ord, array_to_string(ts, ' > ') AS path FROM st"""
ORACLE["section_map"] = ORACLE["section_paths"].replace("SELECT doc, ord, array_to_string(ts, ' > ') AS path FROM st", ", l AS (SELECT doc, (ord // 100000)::INT AS page, arg_max(array_to_string(ts, ' > '), ord) AS path FROM st GROUP BY ALL) SELECT doc, page, coalesce(last_value(path IGNORE NULLS) OVER (PARTITION BY doc ORDER BY page), '') AS section FROM (SELECT DISTINCT doc, page FROM b) LEFT JOIN l USING (doc, page)")
_COUNTS = "SELECT doc, count(DISTINCT page) AS total_pages, count(*) AS total_blocks, count(*) FILTER (block_type = 'text') AS text_blocks, count(*) FILTER (block_type = 'table') AS table_blocks, count(*) FILTER (block_type = 'image') AS image_blocks, count(*) FILTER (block_type = 'math') AS math_blocks, 0::BIGINT AS ocr_failed FROM b GROUP BY doc"
ORACLE["type_counts"] = f"WITH {_BLOCKS} {_COUNTS}"
_NAMES = ("total_pages", "total_blocks", "text_blocks", "table_blocks", "image_blocks", "math_blocks", "ocr_failed", "ocr_blocks")
ORACLE["run_summary"] = f"WITH {_BLOCKS}, k AS (SELECT *, image_blocks + math_blocks AS ocr_blocks FROM ({_COUNTS})) SELECT doc AS doc_name, NULL::BIGINT AS total_files, {', '.join(_NAMES)}, NULL::DOUBLE AS elapsed_sec FROM k UNION ALL SELECT NULL, count(*), {', '.join(f'sum({n})::BIGINT' for n in _NAMES)}, 1.5 FROM k"
ORACLE["reading_modes"] = f"WITH {_BLOCKS} SELECT block_type, ocr_mode, CASE WHEN block_type IN ('math', 'figure', 'algorithm') THEN block_type WHEN block_type = 'table' THEN 'table_complex' WHEN ocr_mode = 'text' THEN 'math' WHEN ocr_mode = 'table_simple' THEN 'table_complex' WHEN ocr_mode IN ('figure', 'math', 'table_complex', 'algorithm') THEN ocr_mode ELSE 'image' END AS mode, count(*) AS count FROM b GROUP BY ALL"
_PATH = "'images/' || doc || '_p' || page || '_b' || block_id || '_' || block_type || '.png'"
_IMG = f"'![Image p' || page || ' #' || block_id || '](' || {_PATH} || ')'"
_OCR = "block_type IN ('image', 'figure', 'math', 'algorithm')"
ORACLE["placeholders"] = f"WITH {_BLOCKS} SELECT block_uid, CASE WHEN image_rel_path IS NOT NULL THEN {_PATH} END AS image_rel_path, CASE WHEN block_type = 'math' THEN '$[Formula block #' || block_id || ']$' WHEN image_rel_path IS NOT NULL THEN {_IMG} ELSE '> [Image block #' || block_id || ']' END AS markdown_result FROM b WHERE {_OCR}"
ORACLE["apply_readings"] = f"""WITH {_BLOCKS} SELECT block_uid, CASE WHEN image_rel_path IS NULL THEN '' WHEN block_uid % 3 <> 1 THEN CASE block_type WHEN 'math' THEN '$$ [Formula p' || page || ' #' || block_id || '] $$' WHEN 'algorithm' THEN E'```algorithm\\n// [Algorithm p' || page || ' #' || block_id || E']\\n' || raw_content || E'\\n```' ELSE {_IMG} END
WHEN block_type IN ('image', 'figure') THEN {_IMG} || CASE WHEN length(caption) > 0 THEN E'\\n\\n> ' || caption ELSE '' END || E'\\n\\nread' ELSE 'read' END AS markdown_result FROM b WHERE {_OCR}"""
_FILES = f"{_PR}, files AS (SELECT doc || '.pdf' AS name, max(page)::BIGINT * 250000 AS size_bytes, max(page) AS pages, CASE WHEN length(doc) % 3 = 0 THEN max(page)::BIGINT - 1 END AS output_size FROM pr GROUP BY doc)"
ORACLE["chunk_ranges"] = f"WITH {_FILES}, r AS (SELECT name, i::INT AS chunk_no, ((i - 1) * 4 + 1)::INT AS first_page, least(i * 4, pages)::INT AS last_page FROM files, generate_series(1, 100000) AS t(i) WHERE (i - 1) * 4 < pages) SELECT *, replace(name, '.pdf', '') || '_chunk_' || lpad(chunk_no::VARCHAR, greatest(3, length(chunk_no::VARCHAR))::INT, '0') || '_p' || first_page || '-' || last_page AS chunk_name, 'chunk' || lpad(chunk_no::VARCHAR, greatest(3, length(chunk_no::VARCHAR))::INT, '0') || '_fig.png' AS image FROM r"
ORACLE["file_plan"] = f"WITH {_FILES} SELECT name, CASE WHEN size_bytes / 1e6 >= 5 OR pages >= 100 THEN 'chunked' ELSE 'normal' END AS route, CASE WHEN output_size > 0 THEN 'skipped' END AS status FROM files WHERE name <> 'bg-00000004.pdf' AND contains(lower(name), '-0000')"
ORACLE["status_rollup"] = "SELECT o_orderstatus AS status, count(*) OVER (PARTITION BY o_orderstatus) AS n, o_orderkey::VARCHAR AS name FROM orders"
ORACLE["merge_chunks"] = f"WITH {_BLOCKS}, {_PAGES}, k AS (SELECT doc, page, 'chunk_' || lpad(page::VARCHAR, greatest(3, length(page::VARCHAR))::INT, '0') AS path, CASE WHEN page % 5 > 0 THEN markdown END AS t FROM p), r AS (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY path) AS i FROM k) SELECT doc AS name, md5('<!-- Source: ' || doc || E' -->\\n<!-- Generated by foliospark -->\\n\\n' || coalesce(string_agg(CASE WHEN i > 1 THEN E'\\n\\n' ELSE '' END || {_strip('t')} || chr(10), '' ORDER BY path), '')) AS digest FROM r GROUP BY doc"
_TOK = f"list_filter(regexp_split_to_array(coalesce(text, ''), {_WHITE}), lambda x: x <> '')"
ORACLE["token_chunks"] = f"WITH d AS (SELECT doc_id, {_TOK} AS w FROM documents), k AS (SELECT doc_id, w, i FROM d, generate_series(0, 100000) AS t(i) WHERE len(w) > 0 AND i < greatest(ceil((len(w) - 50) / 350.0), 1)) SELECT doc_id, (i + 1)::INT AS chunk_no, doc_id || '_chunk_' || (i + 1) AS chunk_id, len(w[i * 350 + 1 : i * 350 + 400])::INT AS n_tokens, md5(array_to_string(w[i * 350 + 1 : i * 350 + 400], ' ')) AS digest FROM k"
ORACLE["metadata_filter"] = "SELECT doc_id FROM documents WHERE source IN ('handbook', 'lecture_notes') AND updated_at >= TIMESTAMP '2015-01-01' AND trust >= 0.5"
_BM = """t AS (SELECT doc_id, unnest(regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{M}\\p{N}]+')) AS term FROM documents), l AS (SELECT doc_id, count(*) AS length FROM t GROUP BY ALL), ix AS (SELECT doc_id, term, count(*) AS tf, any_value(length) AS length FROM t JOIN l USING (doc_id) GROUP BY ALL), df AS (SELECT term, count(*) AS df FROM ix GROUP BY ALL),
st AS (SELECT count(*) AS n, avg(coalesce(length, 0)) AS avgdl FROM documents LEFT JOIN l USING (doc_id)), q AS (SELECT doc_id AS query_id, term, df FROM ix JOIN df USING (term) WHERE doc_id % 100 = 0 AND df > 1),
sc AS (SELECT query_id, doc_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2::DOUBLE / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * length / avgdl))), 6) AS score FROM q JOIN ix USING (term), st GROUP BY ALL)"""
_VEC = "e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings), vs AS (SELECT a.vec_id AS query_id, b.vec_id AS doc_id, round(list_cosine_similarity(a.v, b.v), 6) + 0.0 AS score FROM e a, e b WHERE a.vec_id % 100 = 0)"


def _top(source: str, k: int) -> str:
    return f"SELECT query_id, doc_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id)::INT AS rank FROM {source} QUALIFY rank <= {k}"


ORACLE["bm25_topk"] = f"WITH {_BM} {_top('sc', 10)}"
ORACLE["vector_topk"] = f"WITH {_VEC} {_top('vs', 10)}"
ORACLE["rrf_fusion"] = f"WITH {_BM}, {_VEC}, a AS ({_top('sc', 30)}), z AS ({_top('vs', 30)}), f AS (SELECT query_id, doc_id, round(sum(1.0::DOUBLE / (60 + rank)), 9) AS score FROM (SELECT query_id, doc_id, rank FROM a UNION ALL SELECT query_id, doc_id, rank FROM z) GROUP BY ALL) {_top('f', 10)}"
ORACLE["recall_at_k"] = f"WITH {_VEC}, z AS ({_top('vs', 10)}), r AS (SELECT a.vec_id AS query_id, b.vec_id AS doc_id FROM embeddings a JOIN embeddings b USING (label) WHERE a.vec_id % 100 = 0) SELECT query_id, count(z.doc_id) AS hits, round(count(z.doc_id) / count(*)::DOUBLE, 9) AS recall, count(z.doc_id) / 10.0::DOUBLE AS precision FROM r LEFT JOIN z USING (query_id, doc_id) GROUP BY query_id"
ORACLE["exact_classes"] = "SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS class_id, count(*) OVER (PARTITION BY text) AS copies FROM documents"
ORACLE["fan_out"] = "SELECT o_orderkey AS query_id, greatest(i - 1, 0)::INT AS sub_no, CASE WHEN i = 0 THEN o_orderpriority ELSE o_orderpriority || ' ' || i END AS sub_query FROM orders, generate_series(0, 2) AS t(i) WHERE CASE WHEN o_orderkey % 3 = 0 THEN i = 0 ELSE i BETWEEN 1 AND o_orderkey % 3 END"
ORACLE["cache_keys"] = f"SELECT doc_id, sha256(array_to_string({_TOK.replace("coalesce(text, '')", "coalesce(lower(text), '')")}, ' ')) AS key FROM documents"
_RED = "text"
for _name, _pattern in PERSONAL:
    _RED = f"regexp_replace({_RED}, {_q(_pattern)}, '[{_name}]', 'g')"
ORACLE["pii_redact"] = f"SELECT doc_id, md5({_RED}) AS digest FROM documents"
ORACLE["injection_flags"] = "SELECT doc_id, concat_ws(',', " + ", ".join(f"CASE WHEN regexp_matches(text, {_q(p)}) THEN '{name}' END" for name, p in INJECTION.items()) + ") AS flags FROM documents"
_CAND = f"""{_BM}, {_VEC}, a AS ({_top('sc', 20)}), z AS ({_top('vs', 20)}), u AS (SELECT 'knowledge' AS source_kind, * FROM a UNION ALL SELECT 'memory', * FROM z),
cd AS (SELECT u.*, doc_id::VARCHAR AS chunk_id, coalesce(text, '') AS content, doc_name, page_number, len({_TOK}) AS tokens FROM u JOIN documents USING (doc_id))"""
ORACLE["over_fetch"] = f"WITH {_CAND} SELECT query_id, source_kind, chunk_id FROM cd QUALIFY row_number() OVER (PARTITION BY query_id, source_kind ORDER BY score DESC, chunk_id) <= 5"
_SHARE = "CASE source_kind " + " ".join(f"WHEN '{k}' THEN {int(4000 * v)}" for k, v in BUDGET_SHARES.items()) + " END"
_FIT = f"fit AS (SELECT *, sum(tokens) OVER (PARTITION BY query_id, source_kind ORDER BY score DESC, chunk_id ROWS UNBOUNDED PRECEDING)::BIGINT AS used FROM cd QUALIFY used <= {_SHARE})"
ORACLE["token_budget"] = f"WITH {_CAND}, {_FIT} SELECT query_id, source_kind, chunk_id, tokens::INT AS tokens, used FROM fit"
ORACLE["prompt_build"] = f"WITH {_CAND}, {_FIT}, b AS (SELECT query_id, string_agg(CASE WHEN source_kind = 'knowledge' AND doc_name IS NOT NULL THEN '[' || doc_name || ', p. ' || coalesce(page_number::VARCHAR, '?') || '] ' ELSE '' END || content, E'\\n\\n' ORDER BY source_kind, score DESC, chunk_id) AS t FROM fit GROUP BY query_id) SELECT d.doc_id AS query_id, md5(coalesce(t || E'\\n\\n', '') || coalesce(text, '')) AS digest FROM documents d LEFT JOIN b ON b.query_id = d.doc_id WHERE d.doc_id % 100 = 0"
_SESSION = "s AS (SELECT user_id AS conv_id, event_id AS turn, concat_ws(' ', 'The user made a ' || event_type || '.', 'It had ' || props || '!', 'Value ' || floor(value)::BIGINT || ' was noted.') AS text, sum(length(props)) OVER w <= 200 AND row_number() OVER w <= 15 AS kept FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id DESC ROWS UNBOUNDED PRECEDING))"
ORACLE["session_window"] = f"WITH {_SESSION} SELECT conv_id, turn, kept FROM s"
_TERMS = lambda x: f"regexp_extract_all(lower({x}), '[\\p{{L}}\\p{{M}}\\p{{N}}]+')"
#: Sentences of ``x``: a mark that stands for a break is put after each end.
_SENTENCES = lambda x: f"string_split(regexp_replace({x}, '([.!?…])[ \\t\\n\\x0b\\f\\r]+', '\\1' || chr(57344), 'g'), chr(57344))"
ORACLE["rolling_summary"] = f"""WITH {_SESSION}, o AS (SELECT conv_id, turn, unnest({_SENTENCES('text')}) AS s, generate_subscripts({_SENTENCES('text')}, 1) AS i FROM s WHERE NOT kept),
t AS (SELECT *, list_distinct({_TERMS('s')}) AS t FROM o), e AS (SELECT conv_id, turn, i, len(t) AS n, unnest(t) AS term FROM t), w AS (SELECT conv_id, term, count(DISTINCT turn) AS w FROM e GROUP BY ALL),
sc AS (SELECT conv_id, turn, i, round(sum(w) / sqrt(any_value(n)), 9) AS score FROM e JOIN w USING (conv_id, term) GROUP BY ALL), b AS (SELECT * FROM sc QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY score DESC, turn, i) <= 3)
SELECT conv_id, string_agg(s, ' ' ORDER BY turn, i) AS summary FROM b JOIN o USING (conv_id, turn, i) GROUP BY conv_id"""
ORACLE["latest_facts"] = "SELECT user_id, event_type AS key, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, value DESC) = 1"
ORACLE["forward_fill"] = "SELECT event_id, last_value(CASE WHEN event_id % 4 = 0 THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS filled FROM events"
ORACLE["event_sessions"] = "WITH l AS (SELECT *, coalesce(ts - lag(ts) OVER w >= INTERVAL 30 MINUTE, true) AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), g AS (SELECT *, sum(fresh::INT) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM l) SELECT user_id, min(ts) AS start, count(*) AS events, round(sum(value), 6) AS value FROM g GROUP BY user_id, s"
ORACLE["event_windows"] = "SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS events, round(sum(value), 6) AS value FROM events GROUP BY ALL"
ORACLE["page_raw_text"] = f"WITH {_BLOCKS} SELECT doc, md5(string_agg(raw_content, chr(10) ORDER BY page, block_id)) AS digest FROM b GROUP BY doc"
ORACLE["new_chunks"] = ORACLE["token_chunks"].replace("SELECT doc_id, (i + 1)::INT AS chunk_no, doc_id ||", "SELECT doc_id ||").replace(", md5(array_to_string(w[i * 350 + 1 : i * 350 + 400], ' ')) AS digest FROM k", " FROM k WHERE doc_id % 3 = 0")
_W3, _S = "[\\p{L}\\p{M}\\p{Nd}\\p{Pc}]{3,}", "[\\s\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}\\x0b\\x1c-\\x1f]*"
_M = "\\$[^$\\n]+\\$|\\$\\$[\\s\\S]+?\\$\\$"
_J1 = f"regexp_replace(raw_content, {_q(f'({_M})|({_W3})-{_S}' + chr(92) + f'n{_S}([a-z])')}, '\\1\\2\\3', 'g')"
_J2 = f"regexp_replace({_J1}, {_q(f'({_M})|([a-z,;:])[ ' + chr(92) + 't]*' + chr(92) + 'n[ ' + chr(92) + 't]*([a-z])')}, '\\1' || chr(57344) || '\\2' || chr(57345) || '\\3' || chr(57346), 'g')"
ORACLE["hyphen_repair"] = f"WITH {_BLOCKS} SELECT block_uid, md5(replace(replace(replace(replace({_J2}, chr(57344) || chr(57345) || chr(57346), ''), chr(57345), ' '), chr(57344), ''), chr(57346), '')) AS digest FROM b"
_MAP = ORACLE["section_map"].partition("WITH RECURSIVE ")[2].rpartition(" SELECT doc, page, coalesce(last_value")
_META = ("doc_name", "total_pages", "total_blocks", "text_blocks", "table_blocks", "image_blocks", "math_blocks", "ocr_failed", "layout", "references_page", "section_map")
ORACLE["metadata_json"] = f"WITH RECURSIVE {_PR}, {_VOTE}, {_MAP[0]}, sec AS (SELECT doc, page, coalesce(last_value{_MAP[2]}), maps AS (SELECT doc, map(list(page::VARCHAR ORDER BY page), list(section ORDER BY page)) AS section_map FROM sec GROUP BY doc), {_PAGES}, k AS ({_COUNTS}), refs AS ({_REFS}) SELECT doc, to_json({{{', '.join(f"'{n}': {n}" for n in _META)}}})::VARCHAR AS metadata FROM (SELECT *, doc AS doc_name FROM k LEFT JOIN vote USING (doc) LEFT JOIN refs USING (doc) LEFT JOIN maps USING (doc))"
_RANK = f"""{_CAND}, sf AS (SELECT cd.*, d.trust AS tr, d.updated_at AS up, {_RED.replace('(text,', '(cd.content,')} AS safe FROM cd JOIN documents d USING (doc_id) WHERE {' AND '.join(f'NOT regexp_matches(cd.content, {_q(p)})' for p in INJECTION.values())}),
qs AS (SELECT doc_id AS query_id, list_distinct(regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{M}}\\p{{N}}]+')) AS qt FROM documents WHERE doc_id % 100 = 0),
rk AS (SELECT query_id, source_kind, chunk_id, round(coalesce(len(list_intersect(qt, regexp_extract_all(lower(safe), '[\\p{{L}}\\p{{M}}\\p{{N}}]+')))::DOUBLE / nullif(len(qt), 0), 0.0) + 0.1::DOUBLE * coalesce(tr, 0.0) + 0.2::DOUBLE * coalesce(pow(0.5::DOUBLE, date_diff('day', up::DATE, DATE '2026-01-01') / 30.0::DOUBLE), 0.0), 9) AS rerank_score FROM sf JOIN qs USING (query_id))"""
ORACLE["rerank"] = f"WITH {_RANK} SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rerank_score DESC, chunk_id, source_kind)::INT AS rank FROM rk"
ORACLE["cached"] = f"WITH k AS ({ORACLE['cache_keys']}), st AS (SELECT key, min(doc_id) AS result FROM k WHERE doc_id % 2 = 0 GROUP BY key) SELECT doc_id AS query_id, result FROM k LEFT JOIN st USING (key)"
ORACLE["stage_latencies"] = "SELECT event_type AS stage, count(DISTINCT user_id) AS requests, round(avg(value), 6) AS mean_ms FROM events GROUP BY ALL"
ORACLE["drop_similar"] = f"""WITH RECURSIVE {_VEC}, z AS ({_top('vs', 30)}), c AS (SELECT query_id, doc_id, rank, v FROM z JOIN e ON vec_id = doc_id),
g AS (SELECT query_id, doc_id, rank, true AS kept, [v] AS vs FROM c WHERE rank = 1 UNION ALL SELECT query_id, doc_id, rank, kept, CASE WHEN kept THEN list_append(vs, v) ELSE vs END FROM (SELECT c.*, g.vs, len(list_filter(g.vs, lambda x: list_cosine_similarity(x, c.v) > 0.92)) = 0 AS kept FROM g JOIN c ON c.query_id = g.query_id AND c.rank = g.rank + 1))
SELECT query_id, doc_id, rank FROM g WHERE kept"""
_HALF = "list_transform(s, lambda x: len(list_intersect(x, t)) * 2 >= len(x))"
ORACLE["context_usage"] = f"""WITH {_CAND}, {_FIT}, an AS (SELECT doc_id AS query_id, list_transform(list_filter({_SENTENCES("coalesce(text, '')")}, lambda x: len({_TERMS('x')}) > 0), lambda x: list_distinct({_TERMS('x')})) AS s FROM documents WHERE doc_id % 100 = 0),
r AS (SELECT query_id, tokens, {_HALF} AS h FROM (SELECT query_id, tokens, list_distinct({_TERMS('content')}) AS t, s FROM fit JOIN an USING (query_id))), k AS (SELECT query_id, count(*) AS parts, sum(tokens)::BIGINT AS tokens, count(*) FILTER (len(list_filter(h, lambda x: x)) > 0) AS used FROM r GROUP BY ALL),
un AS (SELECT query_id, avg(1 - x) AS unsupported FROM (SELECT query_id, i, max(x::INT) AS x FROM (SELECT query_id, unnest(h) AS x, generate_subscripts(h, 1) AS i FROM r) GROUP BY ALL) GROUP BY ALL)
SELECT query_id, parts, tokens, used, round(used / parts, 9) AS utilisation, round(unsupported, 9) AS unsupported FROM k LEFT JOIN un USING (query_id)"""
_SPLIT = _SENTENCES("content")
ORACLE["compress"] = f"""WITH {_CAND}, qs AS (SELECT doc_id AS query_id, list_distinct({_TERMS("coalesce(text, '')")}) AS qt FROM documents WHERE doc_id % 100 = 0),
r AS (SELECT query_id, source_kind, chunk_id, content, qt, round(coalesce(len(list_intersect(qt, {_TERMS('content')}))::DOUBLE / nullif(len(qt), 0), 0.0), 9) AS score FROM cd JOIN qs USING (query_id)),
s AS (SELECT * EXCLUDE (content), unnest(list_filter({_SPLIT}, lambda x: x <> '')) AS s, generate_subscripts(list_filter({_SPLIT}, lambda x: x <> ''), 1) AS i FROM r WHERE score < 0.3),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id, source_kind, chunk_id ORDER BY len(list_intersect(qt, {_TERMS('s')})) DESC, i) AS o FROM s) WHERE o <= 3), k AS (SELECT query_id, source_kind, chunk_id, string_agg(s, ' ' ORDER BY i) AS short FROM b GROUP BY ALL)
SELECT query_id, source_kind, chunk_id, CASE WHEN score >= 0.3 THEN content ELSE coalesce(short, '') END AS content FROM r LEFT JOIN k USING (query_id, source_kind, chunk_id)"""

# page texts and layout from their parts
_SP = (
    "sp AS (SELECT doc, page, block_id AS block, bbox.x0 AS x0, bbox.y0 AS y0, bbox.x1 AS x1, bbox.y1 AS y1, CASE WHEN block_type = 'math' THEN 'CMMI10' WHEN block_type = 'algorithm' THEN 'Courier' WHEN heading_level IS NOT NULL THEN 'Times-Bold' ELSE 'Times' END AS font, "
    "coalesce(CASE WHEN isnan(font_size) THEN NULL ELSE font_size END, 10.0::DOUBLE) AS size, unnest(string_split(raw_content, chr(10))) AS text, generate_subscripts(string_split(raw_content, chr(10)), 1) - 1 AS line FROM b WHERE block_type IN ('text', 'unknown', 'math', 'algorithm')), "
    f"sx AS (SELECT *, {_strip('text')} AS bare, font = 'CMMI10' AS math_font, font = 'Courier' AS mono, font LIKE '%Bold%' AS bold FROM sp)"
)
ORACLE["font_headings"] = f"""WITH {_BLOCKS}, {_SP}, s AS (SELECT doc, round(size, 1) AS size, sum(length(bare)) AS n, min((page, block, line)) AS seen FROM sx WHERE page <= 10 AND round(size, 1) > 0 AND length(bare) > 0 GROUP BY ALL),
m AS (SELECT doc, greatest(size, 6.0) AS body FROM s QUALIFY row_number() OVER (PARTITION BY doc ORDER BY n DESC, seen) = 1),
k AS (SELECT doc, page, block, count(DISTINCT line) AS lines, {_strip("string_agg(text, '' ORDER BY line)")} AS title, max(size) AS size, bool_or(bold) AS bold FROM sx GROUP BY ALL),
h AS (SELECT doc, page::BIGINT * 4294967296 + block AS ord, CASE WHEN size >= body * 1.6::DOUBLE THEN 1 WHEN size >= body * 1.35::DOUBLE THEN 2 WHEN size >= body * 1.15::DOUBLE OR (bold AND size >= body) THEN 3 END AS level, title, page FROM k JOIN m USING (doc) WHERE lines <= 3 AND length(title) BETWEEN 3 AND 200 AND NOT regexp_matches(title, '^\\p{{Nd}}+$'))
SELECT * FROM h WHERE level IS NOT NULL"""
_AB = f"""fs AS (SELECT doc, page, round(size, 1) AS size, sum(length(bare)) AS n, min((block, line)) AS seen FROM sx WHERE NOT math_font AND round(size, 1) > 0 AND length(bare) > 0 GROUP BY ALL),
fm AS (SELECT doc, page, greatest(size, 6.0) AS body FROM fs QUALIFY row_number() OVER (PARTITION BY doc, page ORDER BY n DESC, seen) = 1),
fh AS (SELECT doc, page, coalesce(body, 10.0)::DOUBLE AS body FROM (SELECT DISTINCT doc, page FROM sp) LEFT JOIN fm USING (doc, page)),
ln2 AS (SELECT *, (math_font OR (length(bare) > 0 AND length(text) - length(translate(text, {_q(layout.MATH_CHARS)}, '')) > 0.05::DOUBLE * length(text))) AS math FROM sx),
lm AS (SELECT *, CASE WHEN math AND NOT mono THEN CASE WHEN bare <> '' THEN '$' || bare || '$' ELSE '' END ELSE bare END AS merged FROM ln2),
ak AS (SELECT doc, page, block AS ord, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1, CASE WHEN count(*) FILTER (mono) / count(*) >= 0.6 THEN 'algorithm' WHEN count(*) FILTER (math AND NOT mono) / count(*) >= 0.75 THEN 'math' ELSE 'text' END AS block_type, string_agg(bare, chr(10) ORDER BY line) FILTER (bare <> '') AS spaced, string_agg(text, chr(10) ORDER BY line) FILTER (bare <> '') AS closed,
string_agg(merged, chr(10) ORDER BY line) FILTER (merged <> '') AS inl, {_strip("coalesce(string_agg(CASE WHEN math_font OR mono THEN '' ELSE text END, '' ORDER BY line), '')")} AS plain, count(*) AS lines, max(size) AS size, coalesce(max(size) FILTER (NOT math_font AND NOT mono), 0) AS ps, bool_or(bold AND NOT math_font AND NOT mono) AS bold, bool_or(contains(merged, '$')) AS dollar FROM lm GROUP BY doc, page, block),
ab AS (SELECT doc, page, ord, x0, y0, x1, y1, block_type, CASE block_type WHEN 'math' THEN spaced WHEN 'algorithm' THEN closed ELSE inl END AS content,
CASE WHEN lines <= 3 AND length(plain) BETWEEN 3 AND 200 AND NOT regexp_matches(plain, '^\\p{{Nd}}+$') THEN CASE WHEN ps >= round(body * 1.6::DOUBLE, 2) THEN 1 WHEN ps >= round(body * 1.35::DOUBLE, 2) THEN 2 WHEN ps >= round(body * 1.15::DOUBLE, 2) THEN 3 WHEN bold AND ps >= body AND length(plain) <= 100 THEN 3 END END AS heading_level,
CASE WHEN size > 0 THEN size END AS font_size, block_type = 'text' AND dollar AS has_inline_math FROM ak JOIN fh USING (doc, page) WHERE length({_strip("CASE block_type WHEN 'math' THEN spaced WHEN 'algorithm' THEN closed ELSE inl END")}) > 0)"""
ORACLE["analyze_blocks"] = f"WITH {_BLOCKS}, {_SP}, {_AB} SELECT doc, page, ord::BIGINT AS ord, block_type, heading_level, font_size, has_inline_math, md5(content) AS digest FROM ab"
_EDGE = "NOT (y1 < 48 OR y0 > 842 - 48)"
_CELLS = "string_split({}, '|')"
_ROW = lambda r: f"'| ' || array_to_string(list_transform(string_split({r}, '|'), lambda c: {_strip('c')}), ' | ') || ' |'"
_WIDTH = "len(string_split(string_split(raw_content, chr(10))[1], '|'))"
ORACLE["segment_pages"] = f"""WITH {_BLOCKS}, {_DIMS}, {_SP}, {_AB}, all_boxes AS (SELECT doc, page, x0, y0, x1, y1 FROM (SELECT doc, page, block, max(length(bare)) AS n, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM sx GROUP BY ALL) WHERE n > 0), {_BODY}, {_COVER.replace('FROM dims d', 'FROM bdims d')}, {_GUT},
sides AS (SELECT doc, page, count(*) FILTER (x1 <= 297.5 - 20) AS l, count(*) FILTER (x0 >= 297.5 + 20) AS r FROM boxes GROUP BY ALL),
lay AS (SELECT d.doc, d.page, coalesce(gut.gutter, CASE WHEN l >= 3 AND r >= 3 THEN 297.5::DOUBLE END) AS g FROM dims d LEFT JOIN gut USING (doc, page) LEFT JOIN sides USING (doc, page)),
tb AS (SELECT doc, page, block_id AS ord, bbox.x0 AS x0, bbox.y0 AS y0, bbox.x1 AS x1, bbox.y1 AS y1, array_to_string(list_concat([{_ROW('string_split(raw_content, chr(10))[1]')}, '| ' || array_to_string(list_transform(generate_series(1, {_WIDTH}), lambda i: '---'), ' | ') || ' |'], list_transform(string_split(raw_content, chr(10))[2:], lambda r: {_ROW('r')})), chr(10)) AS content, CASE WHEN {_WIDTH} >= 5 THEN 'table_complex' ELSE 'table_simple' END AS ocr_mode FROM b WHERE block_type = 'table' AND raw_content IS NOT NULL),
tx AS (SELECT * FROM ab a WHERE {_EDGE} AND NOT EXISTS (SELECT 1 FROM tb t WHERE t.doc = a.doc AND t.page = a.page AND a.x0 < t.x1 AND t.x0 < a.x1 AND a.y0 < t.y1 AND t.y0 < a.y1)),
im AS (SELECT * FROM (SELECT doc, page, block_id AS ord, bbox.x0 AS x0, bbox.y0 AS y0, bbox.x1 AS x1, bbox.y1 AS y1 FROM b WHERE block_type IN ('image', 'figure')) WHERE {_EDGE}),
cp AS (SELECT i.doc, i.page, i.ord, arg_min(t.c, t.ord) AS caption FROM im i JOIN (SELECT *, {_strip('content')} AS c FROM tx) t ON i.doc = t.doc AND i.page = t.page AND regexp_matches(c, '(?i)^(Figure|Fig\\.|Table|Tbl\\.|Hình|Bảng|Algorithm|Alg\\.)\\s*[0-9]+') AND t.y0 - i.y1 BETWEEN 0 AND 30 AND i.x1 > i.x0 AND (least(i.x1, t.x1) - greatest(i.x0, t.x0)) / (i.x1 - i.x0) > 0.3::DOUBLE GROUP BY ALL),
ev AS (SELECT doc, page, ord::BIGINT AS ord, x0, y0, x1, y1, 'table' AS block_type, content, NULL::INT AS heading_level, ocr_mode, '' AS caption FROM tb UNION ALL SELECT doc, page, ord + 1099511627776, x0, y0, x1, y1, block_type, content, heading_level, block_type, '' FROM tx
UNION ALL SELECT doc, page, ord + 2199023255552, x0, y0, x1, y1, CASE WHEN caption IS NULL THEN 'image' ELSE 'figure' END, '', NULL, CASE WHEN caption IS NULL THEN 'image' ELSE 'figure' END, coalesce(caption, '') FROM im LEFT JOIN cp USING (doc, page, ord)),
sd AS (SELECT ev.*, g IS NOT NULL AS two, CASE WHEN x1 - x0 > 595.0 * 0.65::DOUBLE THEN 'full' WHEN x1 <= coalesce(g, 297.5) + 20 THEN 'left' WHEN x0 >= coalesce(g, 297.5) - 20 THEN 'right' ELSE 'full' END AS side FROM ev JOIN lay USING (doc, page)),
ord AS (SELECT *, {{'x0': x0, 'y0': y0, 'x1': x1, 'y1': y1}} AS bbox, row_number() OVER (PARTITION BY doc, page ORDER BY CASE WHEN two THEN (side = 'right')::INT ELSE round_even(y0 / 5, 0) * 5 END, CASE WHEN two THEN y0 ELSE x0 END, CASE WHEN two AND side = 'left' THEN 1 ELSE 0 END, ord)::INT AS place FROM sd), {_islands("'math'")},
mg AS (SELECT doc, page, island, arg_min(block_type, place) AS block_type, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1, coalesce(string_agg(content, chr(10) ORDER BY place) FILTER (content <> ''), '') AS content, CASE WHEN count(*) = 1 THEN min(heading_level) END AS heading_level, arg_min(ocr_mode, place) AS ocr_mode, CASE WHEN count(*) = 1 THEN min(caption) ELSE '' END AS caption FROM i GROUP BY doc, page, island),
kk AS (SELECT *, block_type IN ('image', 'figure', 'math', 'algorithm') AND round((x1 - x0) * CASE block_type WHEN 'math' THEN 200 ELSE 150 END / 72) * round((y1 - y0) * CASE block_type WHEN 'math' THEN 200 ELSE 150 END / 72) >= 1600 AS has_crop FROM mg), ks AS (SELECT *, block_type IN ('image', 'figure') AND NOT has_crop AS lost FROM kk)
SELECT doc, page, (row_number() OVER (PARTITION BY doc, page ORDER BY island) - 1)::INT AS block_id, CASE WHEN lost THEN 'text' ELSE block_type END AS block_type, heading_level, ocr_mode, lost OR block_type NOT IN ('image', 'figure', 'math', 'algorithm') AS is_done, md5(CASE WHEN lost THEN coalesce(nullif(caption, ''), '{layout.NO_IMAGE}') ELSE content END) AS digest FROM ks"""
_ANY = "\\r\\n|[\\n\\r\\x0b\\x0c\\x1c\\x1d\\x1e\\x{85}\\x{2028}\\x{2029}]"
_HS = "[\\t\\x0b\\x0c\\r\\x1c-\\x1f \\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"


def _merged_paragraphs(x: str) -> str:
    """Line after line is put to the text so far; a mark at its end says that its last line is a joined one."""
    one = f"regexp_replace(regexp_replace({x}, {_q('(?:' + _ANY + ')$')}, ''), {_q(_ANY)}, chr(10), 'g')"
    last = "regexp_extract(acc, '([^\\n]*)$', 1)"
    opens = f"NOT contains(acc, chr(57347)) AND NOT regexp_matches({last}, '^(#|- |\\* |\\p{{Nd}}+\\.|\\$\\$|\\|)') AND regexp_matches({last}, {_q('[^.?!:' + _HS[1:-1] + ']' + _HS + '*$')}) AND NOT regexp_matches({last}, {_q('[$][$]' + _HS + '*$')}) AND regexp_matches(x, '^\\p{{Ll}}')"
    return f"replace(list_reduce(string_split({one}, chr(10)), lambda acc, x: CASE WHEN {opens} THEN regexp_replace(acc, {_q(_HS + '*$')}, '') || ' ' || x || chr(57347) ELSE replace(acc, chr(57347), '') || chr(10) || x END), chr(57347), '')"


def _hyphens(x: str) -> str:
    return f"replace(replace(replace(replace({_J2.replace('raw_content', x)}, chr(57344) || chr(57345) || chr(57346), ''), chr(57345), ' '), chr(57344), ''), chr(57346), '')"


def _spaces(x: str) -> str:
    return _strip(f"regexp_replace(regexp_replace({x}, '(?m)[ \\t]+$', '', 'g'), '\\n{{3,}}', E'\\n\\n', 'g')")


ORACLE["paragraph_merge"] = f"WITH {_BLOCKS} SELECT block_uid, {_merged_paragraphs('raw_content')} AS text FROM b"
_CLEAN = "coalesce(raw_content, '')"
_CLEAN = f"regexp_replace({_CLEAN}, {_q('([$][^$' + chr(92) + 'n]+[$])|(' + _W3.replace('{3,}', '+') + ')-' + chr(92) + 'n(' + _W3.replace('{3,}', '+') + ')')}, '\\1\\2\\3', 'g')"
_CLEAN = f"regexp_replace({_CLEAN}, '(?m)([$][^$\\n]+[$])|[ \\t]+$', '\\1', 'g')"
_CLEAN = _strip(f"regexp_replace({_CLEAN}, '\\n{{3,}}', E'\\n\\n', 'g')")
_HEADED = f"CASE WHEN heading_level BETWEEN 1 AND 3 AND c <> '' THEN repeat('#', heading_level) || ' ' || regexp_replace(c, {_q('^([^' + chr(92) + 'n]*[^' + chr(92) + 'n' + _HS[1:-1] + '])' + _HS + '*')}, '\\1') ELSE c END"
ORACLE["finish_texts"] = f"""WITH {_BLOCKS}, x AS (SELECT *, {_CLEAN} AS c, list_filter(list_transform(regexp_split_to_array({_strip("coalesce(raw_content, '')")}, {_q(_ANY)}), lambda r: {_strip('r')}), lambda r: r <> '') AS l FROM b),
y AS (SELECT *, greatest(length(l[1]) - length(replace(l[1], '|', '')) - 1, 0) AS w, regexp_matches(coalesce(l[2], ''), '^\\|[' || {_q(_WHITE[2:-3])} || '\\-|]+\\|$') AS ruled FROM x)
SELECT block_uid, CASE WHEN block_type = 'text' THEN {_HEADED} WHEN block_type = 'table' AND ocr_mode = 'table_simple' THEN CASE WHEN len(l) < 2 THEN raw_content WHEN ruled THEN array_to_string(l, chr(10)) ELSE array_to_string(list_concat([l[1], '| ' || coalesce(array_to_string(list_transform(generate_series(1, w), lambda i: '---'), ' | '), '') || ' |'], l[2:]), chr(10)) END ELSE markdown_result END AS markdown_result, block_type = 'text' OR (block_type = 'table' AND coalesce(ocr_mode = 'table_simple', false)) AS is_done FROM y"""
_CLEANED = "CASE WHEN rs IS NULL THEN markdown ELSE array_to_string(list_filter(string_split(markdown, chr(10)), lambda x: NOT list_contains(rs, " + _strip("x") + ")), chr(10)) END"
ORACLE["postprocessed_pages"] = f"""WITH RECURSIVE {_MAP[0]}, sec AS (SELECT doc, page, coalesce(last_value{_MAP[2]}), {_PAGES}, {_LINES}, {_REP}, rr AS (SELECT doc, list(line) AS rs FROM rep GROUP BY doc), refs AS ({_REFS}),
c AS (SELECT doc, page, {_CLEANED} AS t FROM p LEFT JOIN rr USING (doc)), g AS (SELECT doc, page, {_hyphens('t')} AS t FROM c), m AS (SELECT doc, page, {_merged_paragraphs('t')} AS t FROM g), n AS (SELECT doc, page, {_spaces('t')} AS t FROM m),
ch AS (SELECT doc, page, section, section <> '' AND section IS DISTINCT FROM lag(section) OVER (PARTITION BY doc ORDER BY page) AS fresh FROM sec)
SELECT doc, page, CASE WHEN fresh THEN '<!-- section: ' || section || E' -->\\n\\n' ELSE '' END || CASE WHEN page >= references_page THEN E'<!-- references section -->\\n\\n' ELSE '' END || t AS markdown FROM n LEFT JOIN ch USING (doc, page) LEFT JOIN refs USING (doc)"""
_PARTS = f"string_split(regexp_replace(coalesce(text, ''), {_q('(^|' + _ANY.replace(chr(92) + 'x0b' + chr(92) + 'x0c' + chr(92) + 'x1c' + chr(92) + 'x1d' + chr(92) + 'x1e', '') + ')(#{1,6} )')}, '\\1' || chr(57344) || '\\2', 'g'), chr(57344))"
ORACLE["heading_chunks"] = f"""WITH d AS (SELECT doc_id, unnest({_PARTS}) AS text, generate_subscripts({_PARTS}, 1) AS part FROM documents), w AS (SELECT doc_id, part, {_TOK} AS w FROM d), k AS (SELECT doc_id, part, w, i FROM w, generate_series(0, 100000) AS t(i) WHERE len(w) > 0 AND i < greatest(ceil((len(w) - 12) / 88.0), 1))
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY part, i)::INT AS chunk_no, len(w[i * 88 + 1 : i * 88 + 100])::INT AS n_tokens, md5(array_to_string(w[i * 88 + 1 : i * 88 + 100], ' ')) AS digest FROM k"""
_PIX = "round((bbox.x1 - bbox.x0) * 300 / 72)::INT AS w, round((bbox.y1 - bbox.y0) * 300 / 72)::INT AS h"
ORACLE["resized_crops"] = f"WITH {_BLOCKS}, s AS (SELECT block_uid, {_PIX} FROM b) SELECT block_uid, CASE WHEN greatest(w, h) <= 896 THEN w WHEN w >= h THEN 896 ELSE (w * 896) // h END::INT AS width, CASE WHEN greatest(w, h) <= 896 THEN h WHEN w >= h THEN (h * 896) // w ELSE 896 END::INT AS height FROM s WHERE w > 0 AND h > 0"
_BODY_TEXT = ORACLE["document_markdown"].partition("SELECT doc, md5(")[2].rpartition(") AS digest FROM p GROUP BY doc")[0]
ORACLE["final_markdown"] = f"""WITH {_BLOCKS}, {_PAGES}, {_PR}, {_VOTE}, t AS (SELECT doc, count(*) AS n, {_BODY_TEXT} AS m FROM p GROUP BY doc)
SELECT doc, md5('---' || chr(10) || 'title: "' || regexp_replace(doc, '(.)\\.[^./]*$', '\\1') || '"' || chr(10) || 'source: "' || doc || '"' || chr(10) || 'pages: ' || n || chr(10) || 'layout: "' || coalesce(layout, '1-column') || '"' || chr(10) || '---' || chr(10) || CASE WHEN m <> '' THEN E'\\n\\n---\\n\\n' || m ELSE '' END) AS digest FROM t LEFT JOIN vote USING (doc)"""
