"""Both strands, records over splits, reports as scans, exact tests, block distances and coordinates, nested bins: against plain versions."""

import random

import numpy as np
import pyarrow as pa
import pytest

from hitloom.functions import kmers
from hitloom.operators import cohort, distances, hits, reads
from hitloom.sources import readers

BACK = str.maketrans("ACGT", "TGCA")


def back(s):
    return s[::-1].translate(BACK)


def number(s):
    return sum("ACGT".index(c) << 2 * i for i, c in enumerate(reversed(s)))


def plain_minimizers(s, k, w):
    s, mask = s.upper(), kmers.MASK & ((1 << 2 * k) - 1)
    words = [s[i : i + k] for i in range(len(s) - k + 1)]
    order = [None if set(x) - set("ACGT") else min(number(x), number(back(x))) ^ mask for x in words]
    out = set()
    for at in range(max(len(words) - w, 0) + 1):
        window = range(at, min(at + w, len(words)))
        least = min((order[i] for i in window if order[i] is not None), default=None)
        out |= {(i, order[i] ^ mask, number(words[i]) == order[i] ^ mask) for i in window if order[i] is not None and order[i] == least}
    return out


def test_minimizers_equal_brute_force(monkeypatch):
    rng = random.Random(1)
    for _ in range(150):
        k, w = rng.choice([1, 2, 3, 5, 15, 31]), rng.choice([1, 2, 5, 19])
        seqs = ["".join(rng.choice("ACGTACGTACGTacgtN"[: rng.choice([4, 8, 17])]) for _ in range(rng.randint(0, 90))) for _ in range(rng.randint(1, 5))] + [None]
        monkeypatch.setattr(kmers, "BLOCK", rng.choice([20, 50, 1 << 20]))  # long sequences are cut
        got = {i: set() for i in range(len(seqs))}
        for batch in kmers._minimizers(iter([pa.RecordBatch.from_pydict({"id": list(range(len(seqs))), "seq": pa.array(seqs, pa.string())})]), k, w):
            for r in batch.to_pylist():
                got[r["id"]].add((r["pos"], r["kmer"], r["forward"]))
        assert got == {i: plain_minimizers(s or "", k, w) for i, s in enumerate(seqs)}


def dna(rng, n):
    return "".join(rng.choice("ACGT") for _ in range(n))


def test_host_reads_of_both_strands_go(spark):
    rng = random.Random(2)
    host = [dna(rng, 400) for _ in range(3)]
    rows, host_ids = [], set()
    for i in range(60):
        piece = host[i % 3][i * 3 : i * 3 + 100]
        kind = i % 4
        seq = [piece, back(piece), piece[:20] + "N" + back(piece)[21:], dna(rng, 100)][kind]
        rows.append(("s", f"r{i}", seq))
        if kind < 3:
            host_ids.add(f"r{i}")
    rows += [("s", "empty", ""), ("s", "none", None), ("s", "short", "ACGT")]
    table = spark.createDataFrame(rows, "sample string, read_id string, seq string")
    hosts = spark.createDataFrame([(s,) for s in host], "seq string")
    kept, removed = reads.remove_host_reads(table, hosts, window=19)
    assert {r.read_id for r in removed.collect()} == host_ids
    assert {r.read_id for r in kept.collect()} == {r[1] for r in rows} - host_ids
    every = reads.remove_host_reads(table, hosts)[1]
    assert {r.read_id for r in every.collect()} == host_ids


def plain_chains(seeds, k, band, least):
    """seeds (qpos, tpos) of one read, reference and strand -> (seeds, bases, q0, q1, t0, t1) of each chain."""
    groups, last = [], None
    for d, q, t in sorted((t - q, q, t) for q, t in seeds):
        if last is None or d - last > band:
            groups.append([])
        groups[-1].append((q, t))
        last = d
    out = []
    for own in groups:
        first = {}
        for q, t in own:
            first[q] = min(t, first.get(q, t))
        chain, top = [], -1
        for q in sorted(first):
            if first[q] > top:
                chain.append((q, first[q]))
            top = max(top, first[q])
        if len(chain) >= least:
            covered = {x for q, _ in chain for x in range(q, q + k)}
            out.append((len(chain), len(covered), chain[0][0], chain[-1][0] + k, min(t for _, t in chain), max(t for _, t in chain) + k))
    return sorted(out)


def test_chains_equal_brute_force(spark):
    rng = random.Random(3)
    k, w = 7, 3
    refs = [("A", dna(rng, 300)), ("B", dna(rng, 120) + "ACGACGACGACGACG" + dna(rng, 60))]
    rows = []
    for i in range(30):
        a = refs[i % 2][1][i * 3 : i * 3 + 40]
        seq = a + dna(rng, rng.randint(0, 25)) + refs[i % 2][1][i * 3 + 50 : i * 3 + 90]
        rows.append(("s", f"r{i}", seq if i % 3 else back(seq)))
    want = {}
    for _, name, seq in rows:
        for target, ref in refs:
            mine, other = plain_minimizers(seq, k, w), plain_minimizers(ref, k, w)
            for strand in "+-":
                seeds = [(q if strand == "+" else len(seq) - k - q, t) for q, x, f in mine for t, y, g in other if x == y and (f == g) == (strand == "+")]
                for n, bases, q0, q1, t0, t1 in plain_chains(seeds, k, 16, 2):
                    lo, hi = (q0 + 1, q1) if strand == "+" else (len(seq) - q1 + 1, len(seq) - q0)
                    want.setdefault(name, []).append((target, strand, n, float(bases), max(q1 - q0, t1 - t0), lo, hi, t0 + 1, t1))
    table = spark.createDataFrame(rows, "sample string, read_id string, seq string")
    got = {}
    for r in reads.chained_hits(table, spark.createDataFrame(refs, "target string, seq string"), k, w).collect():
        got.setdefault(r.query, []).append((r.target, r.strand, r.seeds, r.bits, r.alnlen, r.qstart, r.qend, r.tstart, r.tend, r.place))
        assert abs(r.fident - r.bits / r.alnlen) < 1e-12
    assert {q: sorted(h[:-1] for h in v) for q, v in got.items()} == {q: sorted(v) for q, v in want.items()}
    for v in got.values():
        assert [h[3] for h in sorted(v, key=lambda h: h[-1])] == sorted((h[3] for h in v), reverse=True)
    assert any(h[1] == "-" for v in got.values() for h in v)


def test_fasta_records_over_splits(spark, tmp_path):
    rng = random.Random(4)
    records = [(f"acc{i} a->b >c protein", dna(rng, rng.choice([0, 5, 80, 4000]))) for i in range(40)] + [("", "ACGT")]
    for crlf in (False, True):
        path, end = tmp_path / f"x{crlf}", "\r\n" if crlf else "\n"
        path.mkdir()
        for part in range(2):
            lines = ["no record"] if part else []
            for header, seq in records:
                lines += [f">{header}", *(seq[i : i + 60] for i in range(0, len(seq), 60)), ""]
            (path / f"{part}.fa").write_bytes(end.join(lines).encode())
        for size in ("128m", "700"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "0" if size == "700" else "4194304")
            try:
                got = sorted((r.header, r.seq) for r in readers.read_fasta(spark, str(path)).collect())
                lengths = sorted(map(tuple, readers.fasta_lengths(spark, str(path)).collect()))
            finally:
                spark.conf.unset("spark.sql.files.maxPartitionBytes")
                spark.conf.unset("spark.sql.files.openCostInBytes")
            assert got == sorted(records * 2)
            assert lengths == sorted((h, len(s)) for h, s in records * 2)


def test_long_fasta_records_stand_in_pieces(spark, tmp_path, monkeypatch):
    rows = pa.RecordBatch.from_pydict({"value": [">a", *["ACGT" * 15] * 50, ">b", "AC"], "file": ["f"] * 53, "block": [0] * 53})
    monkeypatch.setattr(readers, "PIECE", 600)
    out = [r for b in readers._fasta_pieces(iter([rows])) for r in b.to_pylist()]
    assert [(r["k"], r["part"], r["length"], r["whole"]) for r in out] == [(1, 0, 600, False), (1, 1, 600, False), (1, 2, 600, False), (1, 3, 600, False), (1, 4, 600, False), (1, 5, 0, False), (2, 0, 2, False)]
    assert "".join(r["seq"] for r in out if r["k"] == 1) == "ACGT" * 750


def test_parents_and_levels_of_reports(spark):
    """Parents by a stack and levels one by one, for any depths."""
    rng = random.Random(5)
    rows, want = [], set()
    for s in "abc":
        stack, level = [], -1
        for line in range(80):
            depth = rng.randrange(6)
            while stack and stack[-1][0] >= depth:
                stack.pop()
            level = min(depth, level + 1)
            want.add((s, line, depth, stack[-1][1] if stack else None, level))
            rows.append((s, line, "genus", depth, 1000 + line))
            stack.append((depth, 1000 + line))
    table = spark.createDataFrame(rows, "sample string, line int, rank string, depth int, taxid int")
    parents = {(r.sample, r.line): r for r in readers.with_parents(table).collect()}
    levels = {(r.sample, r.line): r for r in readers.relevel_report(table).collect()}
    assert {(s, i, r.depth, r.parent_taxid, levels[s, i].depth) for (s, i), r in parents.items()} == want
    assert {r.rank_code for r in levels.values()} == {"G"}


def plain_edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return row[-1]


@pytest.mark.parametrize("errors", [0, 1, 2])
def test_adapter_edits_equal_brute_force(spark, errors):
    rng = random.Random(6)
    adapter, rows = "GTTTCCCAGT", []
    for i in range(200):
        seq = adapter
        for _ in range(rng.randrange(3)):
            at, kind = rng.randrange(len(seq)), rng.randrange(3)
            seq = seq[:at] + ("" if kind == 0 else dna(rng, 1)) + seq[at + (kind < 2) :]
        rows.append((i, rng.choice([seq, seq * 2, seq[:6], ""]) + dna(rng, rng.randrange(30)) if i % 5 else dna(rng, 12)))
    rows += [(900, ""), (901, None), (902, "NNNN"), (903, "gtttcccagtAC")]

    def plain(seq):
        found = [(e, abs(n - 10), -n) for n in range(1, min(len(seq), 10 + errors) + 1) if (e := plain_edits(seq[:n], adapter)) <= errors]
        return -min(found)[2] if found else 0

    from pyspark.sql import functions as F

    table = spark.createDataFrame(rows, "i int, seq string")
    got = {r.i: r.n for r in table.select("i", reads.adapter_length(F.col("seq"), adapter, errors).alias("n")).collect()}
    assert got == {i: plain((s or "").upper()) for i, s in rows}
    if errors:
        table = table.where("seq is not null").selectExpr("'s' AS sample", "1 AS mate", "cast(i as string) AS read_id", "seq", "seq AS qual")
        for r in reads.trim_adapter(table, adapter, times=3, min_length=0, errors=errors).collect():
            want = dict(rows)[int(r.read_id)]
            for _ in range(3):
                want = want[plain(want.upper()) :]
            assert (r.seq, r.qual) == (want, want)


def cohort_table(rng, n, taxa):
    m = rng.poisson(rng.gamma(0.5, 4, size=(n, taxa)))
    m[:, 0] += 1
    return m, [f"s{i:03d}" for i in range(n)]


def plain_distances(m):
    return np.array([[1 - 2 * np.minimum(a, b).sum() / (a.sum() + b.sum()) for b in m] for a in m])


@pytest.mark.parametrize(("n", "size"), [(2, 64), (23, 5), (70, 64)])
def test_distances_and_coordinates_equal_numpy(spark, monkeypatch, n, size):
    monkeypatch.setattr(distances, "WIDE", 7)
    m, names = cohort_table(np.random.default_rng(7), n, 40)
    rows = [(names[i], t, int(m[i, t])) for i in range(n) for t in range(40) if m[i, t]]
    found = distances.stage(distances.bray_curtis(spark.createDataFrame(rows, "sample string, taxid int, reads int"), size))
    d = plain_distances(m)
    got = {(r.a, r.b): r.distance for r in found.collect()}
    assert set(got) == {(a, b) for a in names for b in names if a < b}
    assert all(abs(got[names[i], names[j]] - d[i, j]) < 1e-12 for i in range(n) for j in range(i + 1, n))
    g = -0.5 * d**2
    g = g - g.mean(0) - g.mean(1)[:, None] + g.mean()
    values, vectors = np.linalg.eigh(g)
    order = np.argsort(-values)[:2]
    want = vectors[:, order] * np.sqrt(np.maximum(values[order], 0))
    points = sorted(distances.pcoa(found).collect())
    mine = np.array([(p.axis1, p.axis2) for p in points])
    assert [p["sample"] for p in points] == names
    for k in range(2):
        far = np.abs(mine[:, k]).argmax()
        assert mine[far, k] >= 0
        assert np.allclose(mine[:, k], want[:, k] * (1 if want[far, k] * mine[far, k] >= 0 else -1), atol=1e-7)
    assert abs(points[0].explained1 - values[order[0]] / np.trace(g)) < 1e-9


def test_coordinates_of_nothing(spark):
    none = spark.createDataFrame([], "a string, b string, distance double")
    assert distances.pcoa(none).count() == 0
    same = spark.createDataFrame([("x", "y", 0.0), ("x", "z", 0.0), ("y", "z", 0.0)], "a string, b string, distance double")
    assert [tuple(r)[1:3] for r in distances.pcoa(same).collect()] == [(0.0, 0.0)] * 3


def test_permutations_equal_numpy(spark):
    """F and p over the very permutations that the labels' arrays hold."""
    m, names = cohort_table(np.random.default_rng(8), 21, 30)
    m[:9, :5] *= 3
    d = plain_distances(m)
    pairs = spark.createDataFrame([(names[i], names[j], float(d[i, j])) for i in range(21) for j in range(i + 1, 21)], "a string, b string, distance double")
    groups = spark.createDataFrame([(s, "xyz"[min(i // 8, 2)]) for i, s in enumerate(names)], "sample string, group string")
    labels = {r["sample"]: r.labels for r in distances.permuted(groups, 99, 3).collect()}
    table = np.array([labels[s] for s in names])
    assert table.shape == (21, 100) and all(sorted(c) == sorted(table[:, 0]) for c in table.T)

    def pseudo_f(own):
        within = sum((d[np.ix_(own == g, own == g)] ** 2).sum() / 2 / (own == g).sum() for g in set(own))
        return (((d**2).sum() / 2 / 21 - within) / 2) / (within / 18)

    f = [pseudo_f(table[:, p]) for p in range(100)]
    got = distances.permanova(pairs, groups, 99, 3, size=6).first()
    assert abs(got.pseudo_f - f[0]) < 1e-9 and (got.samples, got.n_groups) == (21, 3)
    assert got.p_value == (sum(x >= f[0] - 1e-12 for x in f[1:]) + 1) / 100


def test_exact_rank_sums(spark):
    import itertools

    rng = random.Random(9)
    rows, want = [], {}
    for k, (a, b) in enumerate([(1, 1), (2, 3), (3, 5), (4, 4), (5, 2), (1, 9), (8, 3)]):
        values = rng.sample(range(100), a + b)
        rows += [(k, "x" if i < a else "y", float(v)) for i, v in enumerate(values)]
        u = sum(x > y for x in values[:a] for y in values[a:])
        order = sorted(values)
        every = [sum(r for r in draw) - a * (a - 1) // 2 for draw in itertools.combinations(range(a + b), a)]
        assert len(order) == len(set(order))
        want[k] = (float(u), min(1.0, 2 * sum(e >= max(u, a * b - u) for e in every) / len(every)))
    rows += [(90, "x", 1.0), (90, "y", 1.0), (90, "y", 2.0)]  # a tie: not exact
    got = {r.k: (r.u, r.p_value) for r in cohort.mann_whitney(spark.createDataFrame(rows, "k int, group string, value double"), ("k",), "x", "y").collect()}
    tied = got.pop(90)
    assert set(got) == set(want) and all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 1e-12 for k in want)
    assert 0 < tied[1] <= 1


def test_draws_do_not_depend_on_partitions(spark):
    rows = spark.createDataFrame([(f"s{i}", f"f{j}", float(v)) for i in range(3) for j, v in enumerate([0, 3, 50, 1000])], "sample string, feature string, value double")
    key = lambda df: sorted((r["sample"], r.feature, r.instance, round(r.clr, 9)) for r in df.collect())
    one, many = key(cohort.clr_draws(rows.coalesce(1), 64)), key(cohort.clr_draws(rows.repartition(7), 64))
    assert one == many and one != key(cohort.clr_draws(rows, 64, seed=1))
    by = {}
    for s, f, i, x in key(cohort.clr_draws(rows, 1500)):
        by.setdefault((s, f), []).append(x)
        by.setdefault((s, i), []).append(x)
    assert all(abs(sum(v)) < 1e-6 for (_, i), v in by.items() if isinstance(i, int))
    # the mean of a gamma variable's logarithm is the digamma function of its shape
    psi = lambda x: np.log(x + 6) - 1 / (2 * (x + 6)) - 1 / (12 * (x + 6) ** 2) - sum(1 / (x + k) for k in range(6))
    shapes = [psi(v + 0.5) for v in (0, 3, 50, 1000)]
    for s in ("s0", "s1", "s2"):
        for j in range(4):
            assert abs(np.mean(by[s, f"f{j}"]) - (shapes[j] - np.mean(shapes))) < 0.2


def test_regions_stand_in_one_bin(spark):
    rng = random.Random(10)
    width = hits.BIN
    regions = {("T", a, a + rng.choice([1, 10, 3 * width, 40 * width])) for a in (rng.randrange(60 * width) for _ in range(80))}
    regions |= {("T", 0, 2_000_000_000), ("T", width - 1, width + 1), ("T", 5, 5)}
    tree = hits.mask_tree(spark.createDataFrame(sorted(regions), "target string, start int, end int")).collect()
    stood = [(r.level, r.bin, x.start, x.end) for r in tree for x in r.regions]
    assert sorted((a, b) for _, _, a, b in stood) == sorted((a, b) for _, a, b in regions if a < b)
    for level, at, a, b in stood:
        assert level == hits.LEVELS - 1 or a // (width * 8**level) == at == (b - 1) // (width * 8**level)
        assert not level or a // (width * 8 ** (level - 1)) != (b - 1) // (width * 8 ** (level - 1))


def test_tables_of_a_database_in_parts(spark):
    url = "jdbc:derby:memory:references;create=true"
    rows = [(f"A{i}", i * 7 - 50) for i in range(100)] + [("none", None)]
    try:
        spark.createDataFrame(rows, "accession string, taxid int").write.format("jdbc").option("url", url).option("dbtable", "refs").mode("overwrite").save()
    except Exception as e:  # Spark's own test database may be left out of an installation
        pytest.skip(str(e)[:80])
    whole = readers.read_reference_tables(spark, url, ["refs"])["refs"]
    parts = readers.read_reference_tables(spark, url, ["refs"], {"refs": "taxid"}, rows_each=30)["refs"]
    assert (whole.rdd.getNumPartitions(), parts.rdd.getNumPartitions()) == (1, 4)
    for table in (whole, parts):
        assert sorted((tuple(r) for r in table.collect()), key=str) == sorted(rows, key=str)


def test_hosts_by_rules_in_order(spark):
    from hitloom.operators import host

    rows = [
        ("a", 1, "Vibriophage X", "Given host"), ("b", 2, "Vibriophage X", ""), ("c", 3, "Vibriophage X", None), ("d", 3, "Klebsiella phage K", " "), ("e", 3, "Marine phage M", ""),
        ("f", 3, "Bacteriophage T4", ""), ("g", 9, "Cyanophage S", ""), ("h", 3, "Mycobacteriophage L5", ""), ("i", 3, None, ""), ("j", 3, "Klebsiellaphage", ""),
    ]
    lineage = spark.createDataFrame([(1, "x"), (2, "Crassvirales"), (3, "y")], "taxid int, name string").selectExpr("taxid", "array(named_struct('name', name)) AS path")
    genera = spark.createDataFrame([("Vibrio",), ("Klebsiella",), ("Mycobacterium",), ("Mycobacter",)], "name string")
    got = {r.accession: (r.host, r.host_rule) for r in host.hosts_by_rules(spark.createDataFrame(rows, "accession string, taxid int, title string, host string"), genera, lineage).collect()}
    assert got == {
        "a": ("Given host", "given"), "b": ("Bacteroides", "clade"), "c": ("Vibrio", "stem"), "d": ("Klebsiella", "title"), "e": ("", None), "f": ("", None),
        "g": ("Cyanobacteria", "stem"), "h": ("Mycobacterium", "stem"), "i": ("", None), "j": ("Klebsiella", "stem"),
    }
