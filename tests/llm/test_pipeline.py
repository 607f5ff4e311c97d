"""The pipeline's stages on a small corpus with planted cases."""

import random

import corpus_pipeline
from hitloom.llm import pieces, simhash


def corpus(rng):
    word = lambda: "".join(rng.choice("aeiou") + rng.choice("bcdfglmnprst") for _ in range(rng.randrange(1, 5)))
    text = lambda n: " ".join(word() for _ in range(n))
    item = text(30)
    rows, labels = [], []
    for i in range(240):
        body = text(80)
        if i % 6 == 0:
            body += " blarg snotz"
        rows.append((i, body, "en", "s", len(body)))
        labels.append((i, 1, int(i % 6 == 0)))
    rows.append((500, rows[1][1], "en", "s", 0))  # an exact copy
    near = text(400)
    rows.append((600, near, "en", "s", 0))
    rows.append((601, near.rsplit(" ", 1)[0], "en", "s", 0))  # a near copy
    rows.append((602, text(30) + " " + item + " " + text(30), "en", "s", 0))  # a leak
    rows.append((603, text(20) + "\nthis line is in two documents", "en", "s", 0))
    rows.append((604, text(20) + "\nthis line is in two documents", "en", "s", 0))
    rows += [(605, None, None, None, None), (606, "", "en", "s", 0), (None, text(30), "en", "s", 7), (None, text(30), "en", "s", 8), (605, text(40), "en", "s", 9), (607, "x y " * 20000, "en", "s", 1), (607, "x y " * 20000, "en", "s", 1)]
    return rows, labels, item


def test_stages(spark, tmp_path):
    rows, labels, item = corpus(random.Random(12))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    seen = {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(str(tmp_path / f"s{i}"))
        docs = spark.read.parquet(str(tmp_path / f"s{i}"))
        seen[name] = {(r.doc_id, r.text) for r in docs.collect()}
        if i < 4:
            assert docs.columns == corpus_pipeline.COLUMNS
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert not {d for d, _ in seen[names[0]] if d is not None and d < 240 and d % 6 == 0}
    clean = {(i, t) for i, t, *_ in rows if i is not None and i < 240 and i % 6}
    assert clean <= seen[names[0]]
    texts = dict(seen[names[1]])
    assert texts[603].endswith("two documents") and "two documents" not in texts[604] and texts[500] == ""
    ids = {d for d, _ in seen[names[2]]}
    assert 600 in ids and 601 not in ids and sum(d is None for d, _ in seen[names[2]]) == 2
    assert {d for d, _ in clean} <= ids and 602 in ids
    assert 602 not in {d for d, _ in seen[names[3]]} and {d for d, _ in clean} <= {d for d, _ in seen[names[3]]}
    table = pieces.ChunkTable(pieces.model_path())
    final = docs.collect()
    assert len(final) == len(seen[names[3]])
    for r in final:
        assert r.ids == table.sp.encode(r.text or "") and r.decoded == table.sp.decode(r.ids)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(final)


def test_stages_on_an_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.count() == 0


def test_one_of_each_keeps_the_first(spark):
    docs = spark.createDataFrame([(5, "a b c d"), (3, "A B C D"), (9, "unlike the others here"), (9, "unlike the others here")], "doc_id long, text string")
    assert sorted(r.doc_id for r in simhash.one_of_each(docs).collect()) == [3, 9]
