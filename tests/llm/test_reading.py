import numpy as np

from foliospark.llm import reading as R


def test_held_out_accuracy(spark, sf):
    folder = sf.replace("sf0.001", "sf0.01")
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(
        f"{folder}/level_labels.parquet"
    )
    fit, held = labels.where("doc_id % 2 = 0"), labels.where("doc_id % 2 = 1")
    got = {r["doc_id"]: r["level"] for r in R.levels(docs, fit).collect()}
    rows = held.collect()
    assert len(rows) > 20 and sum(got[r["doc_id"]] == r["level"] for r in rows) >= 0.85 * len(rows)


def test_odd_documents(spark):
    table = "| a | b |\n" * 60
    rows = [(1, None), (2, ""), (3, "too short"), (4, table), (5, "- item here\n" * 50), (6, "zq xw vk " * 60)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id bigint, text string, level string")
    labels = spark.createDataFrame([(1, "low"), (99, "high"), (2, None), (3, "other")], "doc_id bigint, level string")
    got = {r["doc_id"]: r["level"] for r in R.levels(docs, labels).collect()}
    assert got == {i: None for i in range(1, 7)}
    assert R.found(docs.limit(0), labels).collect() == []


def test_sentences():
    reader = R.Reader({}, R.Settings())
    lang, words, prose, *_, length = reader.features(
        "The dog ran (e.g. No. 4) to the hill i.e. ver. 2.1 again. It was\nlate. Then Bob slept."
    )
    assert (lang, words) == ("en", 19) and round(length, 2) == 6.33 and not prose
    assert reader.features(None) is None and reader.features(" 1 2 ") is None


def test_fit_is_deterministic():
    rng = np.random.default_rng(0)
    level = np.repeat([0, 1, 2], 40)
    rows = np.column_stack([level * 0.2 + rng.normal(0, 0.02, 120), 5.0 + level * 10])
    vi = np.arange(120) % 2 == 1
    a, b = R.fit(rows, vi, level), R.fit(rows, vi, level)
    assert all(
        np.array_equal(a.weights[k], b.weights[k]) for k in (False, True)
    ) and (a.predict(rows, vi) == level).mean() > 0.95
    assert all(w[0] > 0 and w[1] > 0 and w[2] < w[3] for w in a.weights.values())


def test_one_formula_for_any_number_of_labels():
    rows, vi, level = np.array([[0.1, 8.0], [0.4, 25.0], [0.25, 15.0]]), np.zeros(3, bool), np.array([0, 2, 1])
    none = R.fit(rows[:0], vi[:0], level[:0])
    assert all(np.allclose(w, R.CLASSIC) for w in none.weights.values())
    # each further label moves it a little; a language without labels follows the others
    one, three = R.fit(rows[:1], vi[:1], level[:1]), R.fit(rows, vi, level)
    assert not np.allclose(one.weights[False], R.CLASSIC) and not np.allclose(three.weights[True], R.CLASSIC)
    assert three.predict(rows, vi).tolist() == [0, 2, 1]


def test_familiar_words_of_any_length(spark):
    word = "x" * 90
    docs = spark.createDataFrame(
        [(i, f"{word} " + " ".join(f"w{c}" for c in "abcdefghij") + " and so on " * 12) for i in range(4)],
        "doc_id bigint, text string"
    )
    assert word in {r["word"] for r in R.familiar_words(docs).collect()}


def test_words_of_latin_texts(spark, sf):
    reader = R.Reader({}, R.Settings())
    every = "".join(chr(c) for c in [*range(0x250), *range(0x1E00, 0x1F00), *range(0x2000, 0x2065)] if c != 0x130)
    texts = [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect() if r["text"]]
    texts += [every, every[::-1], "-a--b-c- d-É", "".join(f"a{c}-b" for c in every)]
    latin = [t for t in texts if not reader.other(t)]
    assert len(latin) > 20 and all(reader.latin_words(t.lower()) == reader.all_words(t.lower()) for t in latin)
    assert all(map(reader.other, ("İ", "é́", "α", "中")))
