"""Sharding, pieces and SimHash against plain versions."""

import hashlib
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hitloom.llm import pieces, sharding, simhash
from hitloom.llm.components import components

SCHEMA = "doc_id long, text string, lang string, group_key string, slot long, ids string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "clash", 1, "clash") for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def table():
    return pieces.ChunkTable(pieces.model_path())


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t\r▁ab<s>0x\x00é漢😀 "), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_pieces_equal_library(text):
    table = test_pieces_equal_library.__dict__.setdefault("table", pieces.ChunkTable(pieces.model_path()))
    ids = table.sp.encode(text)
    assert table.text(text) == (",".join(map(str, ids)), table.sp.decode(ids))


def test_pieces_query(spark, table):
    rows = [(1, None), (2, ""), (3, " "), (4, "a  b\n\nc"), (5, "word " * 30000), (5, "word"), (None, "x")]
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in pieces.digests(docs(spark, rows)).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = set()
    for i, t in rows:
        ids = table.sp.encode(t or "")
        want.add((i, len(ids), sha(",".join(map(str, ids))), sha(table.sp.decode(ids))))
    assert got == want
    kept = pieces.encode(docs(spark, rows)).collect()
    assert all(table.sp.decode(r.ids) == r.decoded for r in kept) and len(kept) == len(rows)
    assert pieces.digests(docs(spark, [])).count() == 0


def test_chunk_table_is_bounded(table):
    """Long unbroken chunks aren't kept, and the table is emptied by its characters."""
    for i in range(50):
        text = f"{i}x" * 900
        ids = table.sp.encode(text)
        assert table.text(text) == (",".join(map(str, ids)), table.sp.decode(ids))
    assert max(map(len, table), default=0) <= pieces.CHUNK_CHARS
    for i in range(4000):
        table.text(f"{i}y" * 200)
    assert sum(map(len, table)) <= pieces.TABLE_CHARS + pieces.CHUNK_CHARS


def plain_lpt(sizes, shards):
    """The loads after placing each group by itself, largest first, on the least-loaded shard."""
    load = [0] * shards
    for size in sorted(sizes, reverse=True):
        load[load.index(min(load))] += size
    return load


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 60), st.integers(1, 700)), max_size=8), st.integers(1, 5))
def test_lpt_by_size_classes(classes, shards):
    classes = sorted(dict(classes).items(), reverse=True)
    load = [0] * shards
    for (size, count), got in zip(classes, sharding.lpt(classes, shards), strict=True):
        assert sum(got) == count
        load = [x + size * n for x, n in zip(load, got, strict=True)]
    assert load == plain_lpt([size for size, count in classes for _ in range(count)], shards)


def test_sharding(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice([None, "", "same text"]) if i % 5 == 0 else "w" * rng.randrange(1, 60) + str(i)) for i in range(900)]
    rows += [(7, rows[7][1]), (None, "null id"), (None, None)]
    got = sharding.shard_documents(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    of = {}
    for r in got:
        assert r.law == "bytes" and r.grown_shard is None
        of.setdefault((r.size, r.text_crc32), set()).add(r.shard)
    groups = {}
    for _, t in rows:
        data = (t or "").encode()
        assert len(of[len(data) + 1, zlib.crc32(data)]) == 1
        groups[data] = groups.get(data, 0) + len(data) + 1
    for s in range(16):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))
    assert plain_lpt(groups.values(), 16) == [sum(r.size for r in got if r.shard == s) for s in range(16)]
    assert sharding.shard_documents(docs(spark, [])).count() == 0


def plain_components(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in linked:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(5)
    links = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(90), rng.randrange(90)) for _ in range(70)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = plain_components({n for x in links for n in x}, links)
    alone = {n for n in want if not any(n in x and x[0] != x[1] for x in links)}
    assert got == {n: r for n, r in want.items() if n not in alone}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_fingerprint_by_definition():
    import xxhash

    text = "The quick\tbrown  FOX É jumps over the quick brown fox"
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text).split()
    h = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(len(words) - 2)]
    want = sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))
    assert simhash.fingerprint(text.encode()) == want
    assert simhash.fingerprint(b"one two") == xxhash.xxh64_intdigest(b"one two", 42)
    assert simhash.fingerprint(None) == simhash.fingerprint(b" \n") == 0


@pytest.mark.parametrize("hot,budget,agree", [(16384, 2, 1), (20, 2, 1), (16384, 3, 2), (20, 6, 2)])
def test_trie_join(spark, hot, budget, agree):
    rng = random.Random(9)
    fps = {rng.getrandbits(64) for _ in range(300)}
    for f in rng.sample(sorted(fps), 60):
        for _ in range(12):
            fps.add(f ^ sum({1 << rng.randrange(64) for _ in range(rng.randrange(budget + 2))}))
    fps = [f - (1 << 64) if f >> 63 else f for f in fps]
    links = simhash.trie_links(spark.createDataFrame([(1, f) for f in fps], "plane int, fp long"), budget, hot, agree)
    got = plain_components(fps, [(r.a, r.b) for r in links.collect()])
    want = plain_components(fps, [(a, b) for i, a in enumerate(fps) for b in fps[:i] if ((a ^ b) & (2**64 - 1)).bit_count() <= budget])
    assert got == want


def test_near_duplicates(spark):
    rows = [(9, "a b c d e f"), (4, "A  b c d e F"), (8, None), (3, ""), (None, " \n"), (5, "other words here and there"), (5, "other words here and there"), (None, "only null ids here"), (6, "x " * 50000)]
    got = {(r.doc_id, r.fingerprint): r.component_id for r in simhash.near_duplicates(docs(spark, rows)).collect()}
    by_id = {k[0]: v for k, v in got.items() if k[0]}
    assert by_id[9] == by_id[4] == 4 and by_id[8] == by_id[3] == 3 and by_id[5] == 5 and by_id[6] == 6
    assert got[None, "0" * 16] == 3
    assert simhash.near_duplicates(docs(spark, rows)).count() == len(rows)
    assert simhash.near_duplicates(docs(spark, [])).count() == 0


def test_one_of_each_against_all_pairs(spark, monkeypatch):
    """Recall of near copies at similarities of 0.8 to 1, none lost below, large and small batches of leaders alike."""
    rng = random.Random(21)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(5))
    rows = []
    for base in range(60):
        text = [word() for _ in range(rng.randrange(60, 300))]
        rows.append((len(rows), " ".join(text)))
        for _ in range(rng.randrange(1, 9)):
            copy = list(text)
            for at in rng.sample(range(len(copy)), max(1, int(rng.choice([0.01, 0.02, 0.05]) * len(copy)))):
                copy[at] = word()
            rows.append((len(rows), " ".join(copy)))
    rows += [(900, None), (901, ""), (902, rows[0][1].upper()), (903, rows[3][1]), (None, rows[3][1]), (904, "a b"), (905, "a b c")]
    sets = {i: set(simhash.shingles_of((t or "").encode())) for i, t in rows}
    alike = lambda a, b: 5 * len(a & b) >= 4 * len(a | b)
    kept = {r.doc_id for r in simhash.one_of_each(docs(spark, rows)).collect()}
    dropped = [i for i, _ in rows if i not in kept]
    for i in dropped:  # nothing goes that isn't like a lesser one
        assert any(alike(sets[i], sets[j]) for j, _ in rows if j is not None and j in kept and (i is None or j < i))
    want = [i for i, _ in rows if i is not None and any(alike(sets[i], sets[j]) for j, _ in rows if j is not None and j < i and j in kept)]
    assert len({*want} & {*dropped}) >= 0.9 * len(want) > 60
    assert {901, 902, 903, None} <= {*dropped} and {900, 904, 905} <= kept
    monkeypatch.setattr(simhash, "FOLLOWERS", 3)
    one = simhash.unlike
    monkeypatch.setattr(simhash, "unlike", lambda members: one(members, 2))
    assert {r.doc_id for r in simhash.one_of_each(docs(spark, rows)).collect()} == kept


def test_one_of_each_keeps_all_columns(spark):
    rows = [(1, "a b c d e f", 5, 6), (2, "a b c d e f", 7, 8), (3, "other words", 9, 10)]
    got = simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string, id long, h long")).collect()
    assert sorted(map(tuple, got)) == [rows[0], rows[2]]


def test_one_of_each_of_repeated_rows(spark):
    rows = [(5, None), (5, ""), (5, " "), (6, "one text"), (6, "one text"), (None, "one text"), (6, "quite another text here"), (7, None)]
    got = sorted(((r.doc_id, r.text) for r in simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert len(got) == 3 and got[1:] == [(6, "one text"), (6, "quite another text here")] and got[0][0] == 5
