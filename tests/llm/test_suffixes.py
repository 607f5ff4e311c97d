"""Repeated strings against a plain version."""

import hashlib
import random

import pytest

from hitloom.llm import suffixes


def test_suffix_order():
    rng = random.Random(1)
    for _ in range(600):
        s = [rng.randrange(rng.choice([1, 2, 3, 26])) for _ in range(rng.randrange(40))]
        assert suffixes.suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])


def plain(rows, span):
    seen = {}
    texts = [(t or "").encode() for _, t in rows]
    for k, d in enumerate(texts):
        for i in range(len(d) - span + 1):
            seen.setdefault(d[i : i + span], []).append((k, i))
    gone = [bytearray(len(d)) for d in texts]
    for at in seen.values():
        if len(at) > 1:
            for k, i in at:
                gone[k][i : i + span] = b"\1" * span
    return [(r[0], len(d), [x.span() for x in __import__("re").finditer(b"\1+", bytes(g))], bytes(b for b, x in zip(d, g) if not x)) for r, d, g in zip(rows, texts, gone)]


def corpus(rng, size):
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randrange(1, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(rng.randrange(10, 50)) for _ in range(5)]
    rows = []
    for i in range(size):
        parts = [text(rng.randrange(1, 60))]
        for _ in range(rng.randrange(3)):
            parts += [rng.choice(passages), text(rng.randrange(0, 20))]
        rows.append((i, " ".join(parts)))
    base = text(150)
    for i in range(12):
        words = base.split()
        for _ in range(3):
            words[rng.randrange(len(words))] = word()
        rows.append((size + i, " ".join(words)))
    return rows + [(900, None), (901, ""), (902, "ab " * 400), (903, base), (904, base), (904, base), (None, passages[0] + passages[1]), (None, "x" * 90), (905, text(8))]


@pytest.mark.parametrize("hot", [1500, 3, 0])
def test_remove_repeats(spark, hot):
    rows = corpus(random.Random(8), 60)
    docs = spark.createDataFrame([(i, t, b"clash", "clash") for i, t in rows], "doc_id long, text string, data binary, spans string")
    got = [(r.doc_id, r.n_bytes, [(s.start, s.end) for s in r.spans], bytes(r.kept)) for r in suffixes.remove_repeats(docs, span=60, q=20, step=16, hot_pieces=hot).collect()]
    assert sorted(got, key=str) == sorted(plain(rows, 60), key=str)
    assert any(s for _, _, s, _ in got)


def test_texts_beyond_a_block(spark):
    """Strings of 600 bytes across the seam of two blocks in two long texts, and once more in a short one."""
    rng = random.Random(5)
    noise = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    shared, block = noise(600), suffixes.BLOCK
    rows = [(1, noise(block - 300) + shared + noise(2000)), (2, noise(block - 17) + shared + noise(50)), (3, noise(40) + shared)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: [(x.start, x.end) for x in r.spans] for r in suffixes.remove_repeats(docs).collect()}
    for i, text in rows:
        at = text.index(shared)
        (span,) = got[i]
        assert at - 1 <= span[0] <= at and at + 600 <= span[1] <= at + 601  # a neighbour may be the same by chance


def test_passages_are_cut_by_bytes_not_words(spark):
    """A passage of over 50 words in two texts goes if it has 400 bytes, and stays if it has fewer."""
    rng = random.Random(6)
    long_, short = " ".join("abcdefghi"[: 6 + i % 3] + str(i) for i in range(60)), " ".join(f"a{i}" for i in range(60))
    assert len(long_) >= 400 > len(short)
    noise = lambda: " ".join(str(rng.random()) for _ in range(20))
    rows = [(k, f"{noise()} {p} {noise()}") for k, p in enumerate([long_, long_, short, short])]
    got = {r.doc_id: bytes(r.kept).decode() for r in suffixes.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(("abcdef" not in got[k]) for k in (0, 1)) and all(short in got[k] for k in (2, 3))


def test_empty(spark):
    assert suffixes.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query_columns(spark, tmp_path):
    rows = [(1, "a" * 500), (2, "b" * 399), (3, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in suffixes.op5_suffixes(spark, str(tmp_path)).collect()}
    assert (got[1].n_removed, got[1].n_spans, got[2].n_removed, got[3].n_bytes) == (500, 1, 0, 0)
    assert got[2].kept_sha256 == hashlib.sha256(b"b" * 399).hexdigest() and got[3].kept_sha256 == hashlib.sha256(b"").hexdigest()
