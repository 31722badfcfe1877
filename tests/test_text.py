import random
import re

import pytest
from pyspark.sql import functions as F

from foliospark.functions import text as T


def apply(spark, function, values, *more):
    rows = [(i, v, *[m[i] for m in more]) for i, v in enumerate(values)]
    schema = "i int, t string" + "".join(f", c{j} int" for j in range(len(more)))
    df = spark.createDataFrame(rows, schema)
    out = df.select(
        "i", function(F.col("t"), *[F.col(f"c{j}") for j in range(len(more))]).alias("r")
    ).orderBy("i").collect()
    return [r["r"] for r in out]


def test_strip_and_numbers(spark):
    assert apply(spark, T.strip, ["  a　\n", None, ""]) == ["a", None, ""]
    assert apply(spark, T.to_float, ["7,5", "8.0", "-", "", None, "1,2,3"]) == [7.5, 8.0, None, None, None, None]


def test_round_binary(spark):
    df = spark.createDataFrame([(107 / 40,), (0.125,), (None,)], "x double")
    assert [r[0] for r in df.select(T.round_binary("x", F.lit(2))).collect()] == [2.67, 0.12, None]


def test_lines(spark):
    assert apply(spark, T.lines, ["a\nb\n", "a\r\nb c", "", "\n"]) == [["a", "b"], ["a", "b", "c"], [""], [""]]


@pytest.mark.parametrize(
    "given, wanted",
    [
        ("auto-regres-\nsive", "auto-regressive"), ("represen-\n  tation", "representation"), ("a\nb\nc", "a b\nc"),
        ("$x-\ny$ is\nhere", "$x-\ny$ is here"), ("$$abcd-\nefg$$", "$$abcd-\nefg$$"),
        ("thườ-\nng", "thường"), ("ab-\ncd", "ab-\ncd"), ("End.\nnext", "End.\nnext"),
        ("x $a$\nb $c\nd$ e", "x $a$\nb $c d$ e"),
    ],
)
def test_repair_hyphens(spark, given, wanted):
    assert apply(spark, T.repair_hyphens, [given]) == [wanted]


def test_normalize_space(spark):
    assert apply(spark, T.normalize_space, [" a \t\n\n\n\nb  \n", None]) == ["a\n\nb", None]


def pair_lines(text):
    """Independent model: lines pair from the left."""
    lines = text.splitlines()
    out, i = [], 0
    guard = re.compile(r"#|- |\* |\d+\.|\$\$|\|")
    while i < len(lines):
        now = lines[i].rstrip()
        if i + 1 < len(lines) and not guard.match(
            lines[i]
        ) and now and now[-1] not in ".?!:" and not now.endswith("$$") and lines[i + 1][:1].islower():
            out.append(now + " " + lines[i + 1])
            i += 2
        else:
            out.append(lines[i])
            i += 1
    return "\n".join(out)


def test_merge_split_paragraphs(spark):
    rng = random.Random(3)
    pieces = ["a", "ab ", "End.", "x$$", "", "# h", "- i", "1. n", "|t|", "đi", "Bé", "$$m", "q:", " s", "z\t"]
    texts = ["\n".join(rng.choice(pieces) for _ in range(rng.randrange(0, 9))) for _ in range(800)]
    assert apply(spark, T.merge_split_paragraphs, texts) == [pair_lines(t) for t in texts]


def test_clean_text_and_headings(spark):
    assert apply(
        spark, T.clean_text, ["hy-\nphen \n\n\n\nx $a-\nb$", None]
    ) == ["hyphen\n\nx $a-\nb$".replace("$a-\nb$", "$ab$"), ""]
    assert apply(
        spark, T.heading_prefix, ["Intro", "\n  Two \nrest", "plain", " "], [1, 2, None, 3]
    ) == ["# Intro", "\n## Two\nrest", "plain", " "]


def test_tables(spark):
    df = spark.createDataFrame([([["a|b", None], ["1", " 2 "]],), ([],), ([[]],)], "c array<array<string>>")
    assert [
        r[0] for r in df.select(T.table_markdown(F.col("c"))).collect()
    ] == ["| a\\|b |  |\n| --- | --- |\n| 1 | 2 |", None, None]
    assert apply(
        spark, T.repair_table, ["|a|b|\n\n |1|2| ", "|a|b|\n|---|---|\n|1|2|", "|a|", None]
    ) == ["|a|b|\n| --- | --- |\n|1|2|", "|a|b|\n|---|---|\n|1|2|", "", ""]


def test_image_tag(spark):
    from urllib.parse import quote

    names = ["a b(c).png", "x*~%[é].png", "d\\e/f.png"]
    assert apply(spark, T.url_path, names) == [quote(n.replace("\\", "/"), safe="/") for n in names]
    df = spark.createDataFrame([("a]b", "p q.png")], "a string, p string")
    assert df.select(T.image_tag(F.col("a"), F.col("p"))).first()[0] == "![a\\]b](p%20q.png)"


def test_round_binary_as_python_does(spark):
    import random

    rng = random.Random(2)
    values = [
        n / d for n in range(0, 800, 7) for d in (8, 16, 40, 200, 3, 7)
    ] + [rng.uniform(-5, 5) for _ in range(500)] + [k / 200 for k in range(-900, 900)] + [
        0.0, -0.005, 1e12 + 0.125, 2.0**60, 1e300, 4503599627370497.5
    ]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = df.select(
        "x", T.round_binary(F.col("x"), 2).alias("two"), T.round_binary(F.col("x"), 0).alias("none"),
        T.round_binary(F.col("x"), 5).alias("five")
    ).collect()
    assert [(r["two"], r["none"], r["five"]) for r in got] == [(round(v, 2), round(v, 0), round(v, 5)) for v in values]


def test_json_indented(spark):
    import json

    kind = "a string, b double, c struct<d:int,e:array<struct<f:string>>>, g array<int>"
    value = {"a": 'x"\\\n[é]', "b": None, "c": {"d": None, "e": [{"f": "y"}, {"f": None}]}, "g": []}
    df = spark.createDataFrame([(value,)], f"v struct<{kind.replace(' ', ':').replace(',:', ',')}>")
    assert df.select(
        T.json_indented(F.col("v"), df.schema["v"].dataType)
    ).first()[0] == json.dumps(value, indent=2, ensure_ascii=False)
