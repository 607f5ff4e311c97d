"""Token counts, periodic runs and the filter audit against plain versions."""

import hashlib
import itertools
import random
import uuid
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hitloom.functions.stage import own_dir
from hitloom.llm import audit, runs, tokens
from hitloom.llm.pieces import model_path

SCHEMA = "doc_id long, text string, lang string, digest string, n_bytes string, mask int, part string, runs string, letter string, first int"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, "clash", "clash", 9, "clash", "clash", "Z", 9) for i, t, lang in rows], SCHEMA)


def english(rows):
    return [(i, t, "en") for i, t in rows]


@pytest.fixture(scope="module")
def sp():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=model_path())


TEXTS = [(1, None), (2, ""), (3, " "), (4, "a  b\n\nc"), (5, "word " * 30000), (5, "word"), (6, "word"), (6, "word"), (None, "word"), (None, "x y"), (7, "x▁y"), (8, "<s>émoi 漢字 </s><unk>")]


def test_token_counts_equal_library(spark, sp):
    cache = f"{own_dir(spark)}/tokens-{uuid.uuid4().hex}"
    got = sorted((tuple(r) for r in tokens.count_tokens(docs(spark, english(TEXTS)), cache, limit=4).collect()), key=str)
    assert got == sorted(((i, len((t or "").encode()), len(sp.encode(t or "")), len(sp.encode(t or "")) > 4) for i, t in TEXTS), key=str)


def test_cache_is_used_and_appended_to(spark, sp):
    """Distinct contents are stored once; a second run with two new ones appends these two; another version's counts aren't taken."""
    cache, path = f"{own_dir(spark)}/tokens-{uuid.uuid4().hex}", model_path()
    table = lambda: spark.read.parquet(cache)
    tokens.count_tokens(docs(spark, english(TEXTS)), cache)
    distinct = len({(t or "").replace(" ", "▁") for _, t in TEXTS})
    assert table().count() == table().select("digest").distinct().count() == distinct
    tokens.count_tokens(docs(spark, english([*TEXTS, (9, "new"), (10, "new"), (11, "newer")])), cache)
    assert table().count() == distinct + 2
    tokens.count_tokens(docs(spark, english(TEXTS)), cache)
    assert table().count() == distinct + 2
    # what is stored is what is returned, so nothing is encoded again; under another version nothing is found
    digest = bytearray(hashlib.sha256("planted".encode()).digest())
    for version, n in ((tokens.tokenizer_digest(path), 77), ("another version", 78)):
        spark.createDataFrame([(digest, n, version)], "digest binary, n_tokens long, tokenizer string").write.mode("append").partitionBy("tokenizer").parquet(cache)
    assert [r.n_tokens for r in tokens.count_tokens(docs(spark, [(1, "planted", "en")]), cache).collect()] == [77]


def test_no_documents_append_nothing(spark):
    cache = f"{own_dir(spark)}/tokens-{uuid.uuid4().hex}"
    assert tokens.count_tokens(docs(spark, []), cache).count() == 0
    assert tokens.stored(spark, cache, tokens.tokenizer_digest(model_path())).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from(" ▁ab<s>0\n漢"), max_size=30))
def test_normal_form_has_the_same_ids(text):
    import sentencepiece

    own = test_normal_form_has_the_same_ids.__dict__.setdefault("sp", sentencepiece.SentencePieceProcessor(model_file=model_path()))
    assert tokens.only_escapes(model_path())
    assert own.encode(text) == own.encode(text.replace(" ", "▁"))


def test_another_tokenizer_file(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    cache = f"{own_dir(spark)}/tokens-{uuid.uuid4().hex}"
    own = Tokenizer.from_file(path)
    got = sorted((r.doc_id, r.n_tokens) for r in tokens.count_tokens(docs(spark, english([(1, None), (2, "a <|endoftext|> b"), (3, "word " * 3000)])), cache, path).collect())
    assert got == [(i, len(own.encode(t, add_special_tokens=False).ids)) for i, t in ((1, ""), (2, "a <|endoftext|> b"), (3, "word " * 3000))]


def plain_runs(words, min_words=6, min_turns=4):
    """All stretches that keep a period as far as it goes; of equal stretches the smallest period."""
    n, best = len(words), {}
    for p in range(1, n // min_turns + 1):
        i = 0
        while i + p < n:
            start = i
            while i + p < n and words[i] == words[i + p]:
                i += 1
            if i - start + p >= max(min_words, min_turns * p):
                best.setdefault((start, i - start + p), p)
            i += 1
    return sorted((s, length, p) for (s, length), p in best.items())


@settings(max_examples=400, deadline=None)
@given(
    st.lists(st.lists(st.tuples(st.lists(st.sampled_from("abc"), max_size=6), st.integers(1, 9)), max_size=5), min_size=1, max_size=3),
    st.sampled_from([(6, 4), (2, 2), (6, 2), (5, 3), (12, 4)]),
)
def test_runs_equal_brute_force(parts, least):
    texts = [[w.encode() for words, times in text for w in words * times] for text in parts]
    assert runs.block_runs(texts, *least) == [plain_runs(t, *least) for t in texts]


def test_runs_of_many_lengths():
    rng = random.Random(5)
    for alphabet, n in ((1, 5000), (2, 3000), (3, 3000), (50, 3000)):
        words = [str(rng.randrange(alphabet)) for _ in range(n)]
        for _ in range(8):
            i, q = rng.randrange(n), rng.randint(1, 200)
            words[i : i + q * 5] = (words[i : i + q] * 5)[: len(words[i : i + q * 5])]
        assert runs.block_runs([[w.encode() for w in words]], 6, 4) == [plain_runs(words)]


def test_unions_keep_positions_in_order():
    """Neighbours that come up at a union are neighbours in their class of that LCP, by comparing all suffixes."""
    rng = random.Random(9)
    for _ in range(60):
        ids = np.array([rng.randrange(2) for _ in range(40)] + [2])
        ranks, suffixes = runs.ranked(ids, 1)
        lcp = runs.neighbours(ranks, suffixes)
        common = lambda a, b: next(k for k in range(len(ids)) if ids[a + k : a + k + 1] != ids[b + k : b + k + 1] or a + k >= len(ids))
        assert [common(x, y) for x, y in zip(suffixes, suffixes[1:])] == lcp.tolist()
        for a, b, l in runs.united(suffixes, lcp, 1):
            assert common(min(a, b), max(a, b)) == l and a < b


def repeated(doc_id, text):
    """The words of a text after the contract's rewriting."""
    words = [w.decode() for w in (text or "").encode().split()]
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    a = h // 10 % n
    p = 1 + (n - a) // (3 + h // 10 % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_run_digests(spark, tmp_path):
    rng = random.Random(2)
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "a b a b"), (5, "x " * 50), (5, "x " * 50), (None, "q r " * 9), (6, "a b c " * 20 + "d " * 7 + "a b c d " * 5), (7, "w " * 200000)]
    rows += [(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 80)))) for i in range(10, 200)]
    docs(spark, english(rows)).write.parquet(f"{tmp_path}/documents.parquet")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for i, t in rows:
        words = repeated(i, t)
        found = [(0, len(words), 1)] if i == 7 else plain_runs(words)
        drop = {k for s, length, q in found for k in range(s + q, s + length)}
        best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
        kept = " ".join(w for k, w in enumerate(words) if k not in drop)
        want.append((i, len(found), *((*best, 1000 * best[1] // best[2]) if best else [None] * 4), sha("".join(f"{a},{b},{c}\n" for a, b, c in found)), sha(kept)))
    got = [tuple(r) for r in runs.op12_runs(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert runs.collapse_runs(docs(spark, [])).count() == 0


def plain_audit(rows, labels):
    """Every order for every part, document by document."""
    least, marks = {}, {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    for i, good, toxic in labels:
        old = marks.get(i, (False, False))
        marks[i] = (old[0] or good == 1, old[1] or toxic == 1)
    parts = {}
    for i, t, lang in rows:
        t = t or ""
        words = t.encode().split()
        fails = {c for c, bad in zip("ABCDE", (len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t), any(c in "#$%&*|" for c in t), i is not None and least[t] < i)) if bad}
        parts.setdefault(lang or "", []).append((fails, *(marks.get(i, (False, False)) if i is not None else (False, False))))
    out = []
    for part, own in parts.items():
        steps = []
        for order in itertools.permutations("ABCDE"):
            there = own
            for k, c in enumerate(order):
                here = [d for d in there if c in d[0]]
                there = [d for d in there if c not in d[0]]
                failing = sum(c in d[0] for d in own)
                steps.append((part, "".join(order), k + 1, len(there), len(here), failing - len(here), sum(d[0] == {c} for d in own), sum(d[1] for d in here), sum(d[2] for d in here)))
        total = {c: sum(s[4] for s in steps if s[1][s[2] - 1] == c) for c in "ABCDE"}
        out += [(*s, total[s[1][s[2] - 1]]) for s in steps]
    return out


def test_audit_equals_brute_force(spark):
    rng = random.Random(4)
    texts = [None, "", "a b", " ".join(map(str, range(120))), "ABC " * 150, "A# b", "x " * 200000, *(" ".join(str(rng.randrange(90)) + rng.choice(["", "", "A", "BCD", "$"]) for _ in range(rng.choice([40, 99, 100, 101, 200]))) for _ in range(25))]
    rows = [(rng.choice([None, *range(60)]), rng.choice(texts), rng.choice(["en", "en", "fr", "", None])) for _ in range(200)]
    labels = [(rng.choice([None, *range(60)]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(60)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = [tuple(r) for r in audit.audit(docs(spark, rows), table).collect()]
    assert sorted(got) == sorted(plain_audit(rows, labels))
    assert len(got) == 3 * 600
    assert audit.audit(docs(spark, []), table).count() == 0
    assert spark.conf.get(audit.ROW_LIMIT) != "-1"


def test_audit_of_many_parts(spark):
    """More rows of recursion than Spark allows by default: 326 for each part."""
    rows = [(i, "#" if i % 2 else "b", f"lang {i:04d}") for i in range(3200)]
    out = audit.audit(docs(spark, rows), spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert out.count() == 3200 * 600
    assert out.where("part = 'lang 0001' and filter_order = 'DABCE'").orderBy("step").select("kept", "removed", "redundant").collect()[:2] == [(0, 1, 0), (0, 0, 1)]
