"""Fits on labels of one class or one language alone, and decontamination against brute force over all pairs."""

import random

import pytest

from hitloom.llm import decontaminate, language, quality, toxicity

DOCS = "doc_id long, text string, lang string, y int, terms string, leaks string"
LABELS = "doc_id long, quality int, toxic int"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, 3, "clash", "clash") for i, t, lang in rows], DOCS)


def prose(rng, n):
    return " ".join("".join(rng.choice("aeiou") + rng.choice("bcdfglmnprst") for _ in range(rng.randrange(1, 5))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    return [(i, prose(rng, 40), "en") for i in range(60)] + [(900, None, "en"), (901, "", None), (902, "x " * 50000, "en"), (None, "y z", "en")]


@pytest.mark.parametrize("label", [0, 1])
def test_toxicity_of_one_class(spark, rows, label):
    model = toxicity.train(docs(spark, rows), spark.createDataFrame([(i, 1, label) for i in range(60)], LABELS))
    scores = [r.toxicity_score for r in toxicity.score(docs(spark, rows), model).collect()]
    assert len(scores) == len(rows) and all((s > 0.9) == bool(label) and 0 <= s <= 1 for s in scores)


def test_one_language(spark, rows):
    model = language.train(docs(spark, rows))
    got = {r.doc_id: (r.lang_pred, r.lang_score) for r in language.predict(docs(spark, rows), model).collect()}
    assert got[900] == ("und", 0) and got[901] == ("und", 0)
    assert all(v[0] == "en" and 0 <= v[1] <= 1 for k, v in got.items() if k not in (900, 901))


@pytest.mark.parametrize("label", [0, 1])
def test_quality_of_one_class(spark, rows, tmp_path, label):
    docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, label, 0) for i in range(60)], LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    got = quality.op10_quality(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    assert all(not r.kept for r in got if r.base_failed)
    assert all(r.kept == bool(label) for r in got if not r.base_failed)


def least_edits(item, text):
    """The least number of word edits between item and any stretch of text, by the whole table."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item):
        new = [i + 1]
        for j, y in enumerate(text):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def test_leaks_against_all_pairs(spark):
    rng = random.Random(11)
    items = [prose(rng, rng.choice([6, 10, 15, 25])).split() for _ in range(25)]
    texts = []
    for i in range(60):
        words = prose(rng, 30).split()
        for item in rng.sample(items, 2):
            copy = list(item)
            for _ in range(rng.randrange(0, len(item) // 3 + 1)):
                at = rng.randrange(len(copy))
                copy[at : at + rng.randrange(2)] = rng.choice([[], [prose(rng, 1)], [rng.choice(item)]])
                copy = copy or ["empty"]
            words += copy + prose(rng, 12).split()
        texts.append(words)
    want = {(t, k): d for t, words in enumerate(texts) for k, item in enumerate(items) if (d := least_edits(item, words)) <= len(item) // 5}
    bench = spark.createDataFrame([(k, " ".join(item)) for k, item in enumerate(items)], "item_id long, text string")
    table = docs(spark, [(t, " ".join(w), "en") for t, w in enumerate(texts)])
    for block in (decontaminate.BLOCK, 10):  # in one pass, and in several
        got = {(r.doc_id, r.item_id): r.distance for r in decontaminate.find_leaks(table, bench, block).selectExpr("doc_id", "inline(leaks)").collect()}
        assert set(got) <= set(want) and all(got[p] >= want[p] for p in got)
        assert len(got) >= 0.95 * len(want) and len(want) > 40
        assert sum(got[p] == want[p] for p in got) >= 0.95 * len(got)
