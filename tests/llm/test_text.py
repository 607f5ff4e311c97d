"""Line dedup, decontamination, classifiers and URL filters against plain versions."""

import random
import zlib

import numpy as np
import pytest

from hitloom.llm import decontaminate, language, lines, quality, toxicity, urls

DOCS = "doc_id long, text string, lang string, y int, at string, leaks string, dh long, score double"
LABELS = "doc_id long, quality int, toxic int, text string"


def docs(spark, rows):
    return spark.createDataFrame([(r[0], r[1], r[2] if len(r) > 2 else "en", 3, "x", "y", 1, 0.5) for r in rows], DOCS)


def prose(rng, n, stem=""):
    return " ".join(stem + "".join(rng.choice("aeiou") + rng.choice("bcdfglmnprst") for _ in range(rng.randrange(1, 5))) for _ in range(n))


# --- lines


def plain_words(line):
    words = line.split()
    digits = [any(c in "0123456789" for c in w) for w in words]
    return tuple("<*>" if d and 2 * sum(digits) <= len(words) else w for w, d in zip(words, digits))


def plain_nodes(rows):
    """The sets of lines (tuples of words of one length) that are one template, by counting in lists."""
    n, width = len(rows), len(rows[0]) if rows else 0
    if n < 2:
        return []
    column = lambda p: [r[p] for r in rows]
    constant = {p: v for p in range(width) for v in set(column(p)) if 2 * column(p).count(v) > n}
    own = [r for r in rows if 2 * sum(r[p] == v for p, v in constant.items()) >= width]
    if 2 * len(constant) >= width and (2 * len(own) >= n or len(constant) == width):
        return ([own] if len(own) > 1 else []) + plain_nodes([r for r in rows if r not in own])
    if n == 2:
        return []
    place = max((p for p in range(width) if p not in constant), key=lambda p: (sum(column(p).count(v) ** 2 for v in set(column(p))), -p))
    return [t for v in set(column(place)) for t in plain_nodes([r for r in rows if r[place] == v])]


def plain_dedup(rows):
    """The same templates in plain Python, for lines of MIN_WORDS words or more."""
    docs_of = {}
    for i, t in rows:
        for x in (t or "").split("\n"):
            if len(w := plain_words(x)) >= lines.MIN_WORDS:
                docs_of.setdefault(w, set()).add((i, t))
    leaves = {}
    for w in docs_of:
        last = len(w) - 3
        for at in {0, last // 3, last * 2 // 3, last}:
            leaves.setdefault((len(w), at, w[at : at + 3]), []).append(w)
    held = {w: [{w}] for w in docs_of}
    for own in leaves.values():
        if len({d for w in own for d in docs_of[w]}) > 1:
            for group in plain_nodes(sorted(own)):
                for w in group:
                    held[w].append(set(group))
    order = lambda k: (k[0] is None, k[0] or 0)
    firsts = {w: [min({d for v in g for d in docs_of[v]}, key=order) for g in groups] for w, groups in held.items()}
    out = []
    for i, t in rows:
        if t is None:
            out.append((i, None, 0))
            continue
        kept = [x for x in t.split("\n") if all(f == (i, t) for f in firsts.get(plain_words(x), ()))]
        out.append((i, "\n".join(kept), len(t.split("\n")) - len(kept)))
    return out


def test_dedup_lines(spark):
    rng = random.Random(1)
    shared = ["error 17 at host alpha", "error 23 at host beta", "terms of use apply to all", "terms of use apply to none"]
    rows = [(i, "\n".join([prose(rng, 8), rng.choice(shared), prose(rng, 6), "", rng.choice(["short line", prose(rng, 5)])])) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "x " * 40000), (103, rows[3][1]), (103, rows[3][1]), (None, rows[4][1]), (104, "\n\n")]
    got = sorted(((r.doc_id, r.text, r.n_dropped) for r in lines.dedup_lines(docs(spark, rows)).collect()), key=str)
    assert got == sorted(plain_dedup(rows), key=str)
    assert any(n for _, _, n in got)
    assert lines.dedup_lines(docs(spark, [])).count() == 0


def test_line_templates_generalise(spark):
    rows = [(1, "user 12 logged in from 10.0.0.1\nonly here and there now"), (2, "user 99 logged in from 10.9.9.9"), (3, "a b c same words but one x"), (4, "a b c same words but one y")]
    got = {r.doc_id: r.text for r in lines.dedup_lines(docs(spark, rows)).collect()}
    assert got == {1: rows[0][1], 2: "", 3: rows[2][1], 4: ""}


def test_line_templates_vary_by_word(spark):
    """A line of 20 words of which five, far apart, vary: they lie in five of eight runs of words."""
    rng = random.Random(8)
    fixed = prose(rng, 20).split()
    rows = []
    for i in range(6):
        words = list(fixed)
        for at in (4, 7, 10, 13, 17):
            words[at] = f"v{'abcdef'[i]}{'ghijk'[at % 5]}"
        rows.append((i, " ".join(words)))
    got = {r.doc_id: r.text for r in lines.dedup_lines(docs(spark, rows)).collect()}
    assert got == {i: rows[0][1] if i == 0 else "" for i in range(6)}


def test_line_templates_do_not_fade(spark):
    """Names and places from small pools, each of them in many lines, beside lines that have only the leaf in common."""
    rng = random.Random(9)
    pairs = [(a, b) for a in ("Al", "Bob", "Cy", "Di") for b in ("Paris", "London", "Rome", "Oslo", "Bonn")]
    rows = [(i, f"today the user {a} logged in from {b} again") for i, (a, b) in enumerate(pairs)]
    rows += [(100 + i, "today the user " + prose(rng, 6)) for i in range(8)]
    rows += [(200, "now the user Bob went to Paris"), (201, "now the user Bob went to London"), (202, "now the user Al went to Paris")]
    got = {r.doc_id: r.text for r in lines.dedup_lines(docs(spark, rows)).collect()}
    assert got == {i: "" if 0 < i < 100 or i > 200 else t for i, t in rows}


def test_line_templates_with_variable_leading_words(spark):
    rows = [(1, "bob came in from paris late"), (2, "ann came in from paris late"), (3, "12 34 56 78"), (4, "98 76 54 32"), (5, "user Bob logged in from Paris today"), (6, "user Al logged in from London today")]
    got = {r.doc_id: r.text for r in lines.dedup_lines(docs(spark, rows)).collect()}
    assert got == {i: "" if i in (2, 6) else t for i, t in rows}
    more = [(7, "user Bob logged in from London today"), (8, "user Al logged in from Paris today")]
    got = {r.doc_id: r.text for r in lines.dedup_lines(docs(spark, rows + more)).collect()}
    assert got == {i: "" if i in (2, 6, 7, 8) else t for i, t in rows + more}


@pytest.mark.parametrize("share", [0.1, 0.2, 0.3])
def test_recall_of_planted_templates(spark, share):
    """Logs of 60 templates with variable words anywhere, among prose: recurrences found, and prose left alone."""
    rng = random.Random(19)
    rows, planted = [], 0
    vocabulary = prose(rng, 400).split()
    made = []
    for _ in range(60):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(8, 25))]
        made.append((words, rng.sample(range(len(words)), max(1, int(share * len(words))))))
    for i in range(600):
        words, places = made[i % 60]
        line = [rng.choice(vocabulary) if k in places else w for k, w in enumerate(words)]
        own = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(8, 25))) for _ in range(3)]
        rows.append((i, "\n".join([*own, " ".join(line)])))
    found = left = 0
    for r in lines.dedup_lines(docs(spark, rows)).collect():
        text = rows[r.doc_id][1].split("\n")
        found += r.doc_id >= 60 and text[-1] not in r.text
        left += sum(x in r.text for x in text[:-1])
    assert found >= 0.9 * 540 and left == 1800


def test_noise_breaks_no_template(spark):
    """400 copies of a line with a word or two changed anywhere: every place varies somewhere, as it does in large tables."""
    rng = random.Random(20)
    line = prose(rng, 16).split()
    rows = []
    for i in range(400):
        words = list(line)
        for _ in range(rng.randrange(1, 3)):
            words[rng.randrange(16)] = prose(rng, 1, "x")
        rows.append((i, " ".join(words)))
    got = {r.doc_id: r.text for r in lines.dedup_lines(docs(spark, rows)).collect()}
    assert got[0] == rows[0][1] and sum(t != "" for t in got.values()) == 1


def test_large_and_small_nodes_alike(spark, monkeypatch):
    rng = random.Random(10)
    some = [(1, 1 + i, [7, 7, rng.choice([1, 2]), rng.choice([3, 4, 5]), *(rng.randrange(20) for _ in range(3))]) for i in range(60)]
    table = spark.createDataFrame(some, "leaf long, line long, fields array<int>")
    found = []
    for words in (lines.NODE_WORDS, 20):
        monkeypatch.setattr(lines, "NODE_WORDS", words)
        groups = {}
        for r in lines.templates(table).collect():
            groups.setdefault(r.template, set()).add(r.line)
        found.append({frozenset(g) for g in groups.values()})
    assert found[0] == found[1] and found[0]


def test_short_lines_and_lines_without_blanks(spark):
    n = lines.SHORT_DOCS
    rows = [(i, f"All rights reserved\n{'Read more' if i else 'Page'}\nNr 17" if i < n else f"Read on{i}") for i in range(n + 5)]
    rows += [(1, rows[1][1])]  # a repeated row is no further document
    cjk, url = "本网站所有内容均受版权法保护未经许可不得转载", "https://host.example/articles/"
    rows += [(900, cjk), (901, cjk + "\n短い行"), (902, url + "1"), (903, url + "2"), (904, "短い行"), (905, "17"), (906, "18")]
    got = sorted((r.doc_id, r.text) for r in lines.dedup_lines(docs(spark, rows)).collect())
    want = {i: t for i, t in rows} | {i: "Read more" for i in range(1, n)} | {901: "短い行", 903: ""}
    assert got == sorted([*want.items(), (1, want[1])])


# --- decontamination


def edits(rng, words, n):
    words = list(words)
    for _ in range(n):
        at = rng.randrange(len(words))
        kind = rng.randrange(3)
        words[at : at + (kind != 0)] = [] if kind == 1 else ["edited" + str(rng.randrange(99))]
    return words


def test_edit_span():
    assert decontaminate.edit_span("a b c d".split(), "x a b z c d y".split()) == (1, 1, 5)
    assert decontaminate.edit_span(["a"], []) == (1, 0, 0)


def test_leaks_recall(spark):
    rng = random.Random(2)
    items = [(i, prose(rng, rng.randrange(12, 60))) for i in range(40)]
    bench = spark.createDataFrame([*items, (90, None), (91, ""), (92, " ")], "item_id long, text string")
    rows, want = [], set()
    for d in range(200):
        body = prose(rng, 150).split()
        if d % 2:
            i, text = rng.choice(items)
            words = text.split()
            body[40:40] = edits(rng, words, rng.randrange(0, len(words) // 10 + 1))
            want.add((d, i))
        rows.append((d, " ".join(body)))
    rows += [(300, None), (301, ""), (302, "word " * 60000), (None, items[0][1].upper()), (5, rows[5][1])]
    got = decontaminate.find_leaks(docs(spark, rows), bench).selectExpr("doc_id", "inline(leaks)").collect()
    found = {(r.doc_id, r.item_id) for r in got}
    assert (None, 0) in found and sum(r.doc_id == 5 for r in got) == 2
    found.discard((None, 0))
    assert found <= want and len(found & want) >= 0.95 * len(want)
    exact = {(d, i) for d, i in want if dict(items)[i] in rows[d][1]}
    assert exact <= found
    for r in got:
        size = len(dict(items)[r.item_id].split())
        assert r.distance <= 0.2 * size
    assert decontaminate.find_leaks(docs(spark, []), bench).count() == 0
    assert decontaminate.find_leaks(docs(spark, rows), bench.limit(0)).where("size(leaks) > 0").count() == 0


def substituted(rng, words, share, rarest):
    """words with `share` of them changed, deleted or preceded by another; rarest: at the places of the words given there first."""
    places = [i for w in rarest for i, x in enumerate(words) if x == w] if rarest else rng.sample(range(len(words)), len(words))
    out = {i: [w] for i, w in enumerate(words)}
    for i in places[: int(share * len(words) + 1e-9)]:
        out[i] = rng.choice([[f"edited{i}"], [], [f"edited{i}", words[i]]])
    return [w for i in range(len(words)) for w in out[i]]


@pytest.mark.parametrize("share", [0.1, 0.15, 0.2])
@pytest.mark.parametrize("rare_first", [False, True])
def test_leaks_at_all_shares_of_edits(share, rare_first):
    """Against the edit distance at every place: recall at the full budget, names and numbers edited first or not."""
    rng = random.Random(17)
    vocabulary = prose(rng, 300).split()
    items = [(i, " ".join(f"name{i}x{k}" if k % 4 == 0 else rng.choice(vocabulary) for k in range(rng.randrange(8, 61)))) for i in range(120)]
    model = decontaminate.Benchmark(items)
    texts, want = [], set()
    for t, (_, text) in enumerate(items):
        words = text.split()
        rare = [w for w in words if w.startswith("name")] if rare_first else None
        body = [rng.choice(vocabulary) for _ in range(120)]
        body[50:50] = substituted(rng, words, share, rare)
        texts.append(body)
        d, *_ = decontaminate.edit_span(words, body)
        assert d <= decontaminate.budget(len(words))
        want.add((t, t))
    found = {(t, k) for t, own in model.leaks(texts).items() for k in own}
    for t, k in found:
        assert decontaminate.edit_span(model.items[k][1], texts[t])[0] <= decontaminate.budget(len(model.items[k][1]))
    assert len(found & want) >= 0.95 * len(want)


def test_leaks_in_blocks_equal_those_in_one(spark):
    rng = random.Random(18)
    items = [(f"i{i}" if i else None, prose(rng, 20)) for i in range(60)]
    bench = spark.createDataFrame(items, "item_id string, text string")
    rows = [(i, prose(rng, 30) + " " + items[i % 60][1] + " " + items[(i * 7 + 1) % 60][1]) for i in range(80)]
    rows += [(5, rows[5][1]), (None, rows[6][1]), (300, None), (301, "")]
    d = docs(spark, rows)
    found = [sorted(((r.doc_id, sorted(map(str, r.leaks))) for r in decontaminate.find_leaks(d, bench, block).collect()), key=str) for block in (5000, 20)]
    assert found[0] == found[1] and len(found[0]) == len(rows)
    assert any("item_id=None" in x for _, own in found[0] for x in own)


# --- classifiers


def test_toxicity(spark):
    rng = random.Random(3)
    bad = ["blarg", "snotz", "grumb"]
    rows, labels = [], []
    for i in range(600):
        words = prose(rng, rng.randrange(5, 120)).split()
        if i % 4 == 0:
            for w in rng.sample(bad, 2):
                words.insert(rng.randrange(len(words)), w + rng.choice(["", ".", "ish"]))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(i % 4 == 0), "clash"))
    rows += [(900, None), (901, ""), (None, "blarg snotz"), (902, "x " * 50000), (3, rows[3][1])]
    labels += [(None, None, None, None), (5, None, None, "clash"), (902, 1, None, "")]
    d, lab = docs(spark, rows), spark.createDataFrame(labels, LABELS)
    model = toxicity.train(d.select("doc_id", "text"), lab)
    got = toxicity.score(d, model).collect()
    assert len(got) == len(rows)
    right = [(r.toxicity_score >= 0.7) == (r.doc_id % 4 == 0) for r in got if r.doc_id is not None and r.doc_id < 600 and zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert np.mean(right) > 0.97
    by = {r.doc_id: r.toxicity_score for r in got}
    assert by[900] == by[901] < 0.5 and by[None] > 0.7
    empty = toxicity.train(d, lab.limit(0))
    assert {r.toxicity_score < 0.01 for r in toxicity.score(d, empty).collect()} == {True}


def test_pairwise_interactions():
    """An insult alone and a group alone are harmless, both together aren't: no additive weights do that as well."""
    rng = random.Random(4)
    rows = []
    for _ in range(800):
        a, b = rng.random() < 0.4, rng.random() < 0.4
        rows.append((np.array(sorted({rng.randrange(100, 130), *([1] if a else []), *([2] if b else [])})), int(a and b)))
    model = toxicity.fit_machine(rows)
    place = {int(t): i for i, t in enumerate(model.terms)}
    both, one, two = (model.score(np.array([place[t] for t in s])) for s in ([1, 2], [1], [2]))
    assert both > 0.7 > 0.5 > max(one, two)


def test_language(spark):
    rng = random.Random(5)
    letters = {"en": "theandwi", "de": "derußmgk", "fr": "éèlaux", "es": "ñóadocr", "zz": "жцы"}
    rows = [(i, " ".join("".join(rng.choice(letters[lang]) for _ in range(rng.randrange(2, 8))) for _ in range(rng.randrange(8, 60))), lang) for i in range(500) for lang in [sorted(letters)[i % 5]]]
    rows += [(900, None, "en"), (901, "12 34 !", None), (902, "the and", None), (None, "the and then", "en"), (903, "the " * 50000, None)]
    d = docs(spark, rows)
    model = language.train(d)
    got = {r.doc_id: r for r in language.predict(d, model).collect()}
    assert len(got) == len(rows) and got[900].lang_pred == got[901].lang_pred == "und"
    held = [i for i in range(500) if zlib.crc32(str(i).encode()) % 3 == 1]
    assert np.mean([got[i].lang_pred == got[i].lang for i in held]) > 0.98
    assert all(0 <= r.lang_score <= 1 for r in got.values())
    assert {r.lang_pred for r in language.predict(d, language.train(d.limit(0))).collect()} == {"und"}


def test_classifiers_take_any_id_and_repeated_ids(spark):
    """String ids, labels that contradict each other, and texts that share an id give the same models on every run."""
    rng = random.Random(11)
    rows = [(f"d{i}", prose(rng, 30) + (" blarg snotz" if i % 4 == 0 else ""), ["en", "de"][i % 2], "s") for i in range(200)]
    rows += [("d4", "another text of d4", "en", "s"), (None, "no id", "en", "s")]
    labels = [(f"d{i}", int(i % 4 != 0), int(i % 4 == 0)) for i in range(200)] + [("d3", 0, 1), (None, 1, 1), ("d5", None, None)]
    kind, label_kind = "doc_id string, text string, lang string, source string", "doc_id string, quality int, toxic int"
    found = []
    for parts in (1, 4):
        d, lab = spark.createDataFrame(rows, kind).repartition(parts), spark.createDataFrame(labels, label_kind).repartition(parts)
        tox = {(r.doc_id, r.text): r.toxicity_score for r in toxicity.score(d, toxicity.train(d, lab)).collect()}
        good = {(r.doc_id, r.n_words): r.quality_score for r in quality.assess(d, quality.train(d, lab)).collect()}
        langs = {(r.doc_id, r.text): r.lang_pred for r in language.predict(d, language.train(d)).collect()}
        found.append((tox, good, langs))
    assert found[0] == found[1] and len(found[0][0]) == len(rows)


def plain_counts(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = {}
    for i in range(len(words) - 4):
        windows.setdefault(tuple(words[i : i + 5]), []).append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(5)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)]


@pytest.mark.parametrize("text", [None, "", " \n\t", "a b c d e f a b c d e", "é ñ\x0bz|<>\n\nq\nq\n q\n", "w " * 9000, "a\u2028b\u00a0c d\x1ce", "x y z w v x y z w v x"])
def test_quality_counts(text):
    assert quality.judge(text.encode() if text is not None else None)[0] == plain_counts(text)


def test_quality(spark):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(500):
        text = prose(rng, rng.randrange(12, 90))
        rows.append((i, text.upper().replace(" ", "!! ") if i % 3 == 0 else text))
        labels.append((i, int(i % 3 != 0), 0, "clash"))
    rows += [(900, None), (901, ""), (None, rows[1][1]), (902, "same words again and " * 20000), (1, rows[1][1])]
    d, lab = docs(spark, rows), spark.createDataFrame([*labels, (None, None, None, None)], LABELS)
    got = quality.assess(d, quality.train(d, lab)).collect()
    assert len(got) == len(rows)
    held = [r for r in got if r.doc_id is not None and r.doc_id < 500 and zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert np.mean([r.kept == (r.doc_id % 3 != 0) for r in held]) > 0.97
    by = {r.doc_id: r for r in got}
    assert by[900].base_failed and by[901].base_failed and by[902].base_failed and not by[902].kept
    none = quality.assess(d, quality.train(d, lab.limit(0)))
    assert none.where("kept = base_failed").count() == 0
    assert quality.assess(docs(spark, []), quality.train(d, lab)).count() == 0


# --- urls


def test_urls_equal_sql(spark):
    import duckdb
    import pandas as pd

    rng = random.Random(7)
    hosts = ["a.example.org", "B.Example.ORG", "www.example.com", "example.com", "x.example.net", "net", "hot.org"]
    tails = ["/en/{}", "/fr/{}/", "/es/{}.html?x=1", "/shop/{}/cart/deep/er", "", "/", "#top", "/user{}/p{}", "?q=/a", "//en//{}"]
    pages = [(i, "https://" + (rng.choice(hosts) if i % 3 else "hot.org") + rng.choice(tails).format(rng.randrange(400), rng.randrange(9))) for i in range(600)]
    pages += [(700, None), (701, ""), (702, "no scheme"), (703, "://"), (704, "x://y://z/q"), (5, pages[5][1]), (None, "http://h.org/1\n/2")]
    pages += [(800 + i, f"http://wide.org/name{chr(97 + i)}x/{i}") for i in range(26)]
    # branches that differ from the fourth segment on, wildcards below them, paths that end on the way, one very long path
    pages += [(900 + i, f"http://deep.org/shop/en/items/{rng.choice(['spam', 'good'])}/of/{rng.choice('abcdefghijklmno')}y/view") for i in range(120)]
    pages += [(1100 + i, "http://deep.org/shop/en/items" + "/spam" * (i % 3)) for i in range(6)] + [(1110, "http://deep.org" + "/s" * 3000), (1111, "http://deep.org" + "/s" * 2999 + "/t")]
    labels = [(i, int(rng.random() < 0.7), int(rng.random() < 0.1), "clash") for i in range(400)] + [(None, 1, 0, None), (3, None, None, None), (4, 0, None, "")]
    got = urls.judge_urls(spark.createDataFrame([(*p, "h") for p in pages], "page_id long, url string, host string"), spark.createDataFrame(labels, LABELS))
    columns = ["page_id", "host", "path", "rule", "verdict", "template", "purity"]
    key = lambda rows: sorted((tuple(None if v is None or v != v else round(v, 9) if isinstance(v, float) else v for v in r) for r in rows), key=str)
    con = duckdb.connect()
    con.register("pages", pd.DataFrame(pages, columns=["page_id", "url"]).astype({"page_id": "Int64"}))
    con.register("labels", pd.DataFrame(labels, columns=["doc_id", "quality", "toxic", "text"]).astype({"doc_id": "Int64", "quality": "Int64", "toxic": "Int64"}))
    want = con.sql(f"SELECT {', '.join(columns)} FROM ({urls.URL_SQL})").fetchall()
    assert key(got.select(columns).collect()) == key(want)
    assert {r.rule for r in got.collect()} >= {"com/", "net/es/", "example.com/en/"}
    empty = spark.createDataFrame([], "page_id long, url string")
    assert urls.judge_urls(empty, spark.createDataFrame(labels, LABELS)).count() == 0


def test_url_branches_below_the_third_segment(spark):
    pages = [(i, f"http://deep.org/shop/en/items/{'spam' if i % 2 else 'good'}/p{i}") for i in range(80)]
    labels = [(i, int(i % 2 == 0), 0, "") for i in range(80)]
    got = {r.page_id: r for r in urls.judge_urls(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labels, LABELS)).collect()}
    assert {(r.template, r.verdict) for r in got.values()} == {("/shop/en/items/good/p*", "allow"), ("/shop/en/items/spam/p*", "block")}


def test_url_rules(spark):
    rows = [("http://WWW.Example.com/en/x", "www.example.com/en/", "allow"), ("http://m.example.com/en/", "example.com/en/", "block"), ("http://badexample.com/en/", "com/", "allow"), ("http://a.net/fr/1", "net/fr/", "block"), ("http://a.net/fr", None, "allow"), ("http://com", None, "allow")]
    got = urls.judge_urls(spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], "page_id long, url string"), spark.createDataFrame([], LABELS))
    assert {r.page_id: (r.rule, r.verdict) for r in got.collect()} == {i: r[1:] for i, r in enumerate(rows)}
