"""Read-level tables: reads (sample, mate, read_id, seq, qual). Screening and seeds by k-mers of both strands, not alignment."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitloom.functions.adapters import cutter
from hitloom.functions.kmers import minimizers


def fastq_quality_profile(reads: DataFrame, offset: int = 33) -> DataFrame:
    """Per (sample, mate, pos): bases, mean quality, its quartiles, and the share of each base. Rows are combined by quality first."""
    each = reads.where("length(seq) > 0").select("sample", "mate", F.posexplode(F.arrays_zip(F.split("seq", "").alias("b"), F.split("qual", "").alias("q"))).alias("pos", "x"))
    counts = each.groupBy("sample", "mate", "pos", F.upper("x.b").alias("base"), (F.ascii("x.q") - offset).alias("q")).agg(F.count("*").alias("n"))
    share = [(F.sum(F.when(F.col("base") == b, F.col("n")).otherwise(0)) / F.sum("n")).alias(f"share_{b.lower()}") for b in "ACGTN"]
    return counts.groupBy("sample", "mate", "pos").agg(F.sum("n").alias("bases"), (F.sum(F.col("q") * F.col("n")) / F.sum("n")).alias("mean_q"), *[F.percentile("q", p, F.col("n")).alias(f"q{int(p * 100)}") for p in (0.25, 0.5, 0.75)], *share)


def read_histograms(reads: DataFrame) -> DataFrame:
    """Per (sample, mate): histograms of length and of GC percent, and how many sequences occur how often, as (kind, bin, n)."""
    gc = F.round(100 * (F.length("seq") - F.length(F.translate("seq", "GCgc", ""))) / F.greatest(F.length("seq"), F.lit(1))).cast("int")
    one = reads.select("sample", "mate", F.inline(F.array(F.struct(F.lit("length").alias("kind"), F.length("seq").alias("bin")), F.struct(F.lit("gc").alias("kind"), gc.alias("bin")))))
    repeats = reads.groupBy("sample", "mate", "seq").agg(F.count("*").cast("int").alias("bin")).select("sample", "mate", F.lit("copies").alias("kind"), "bin")
    return one.unionByName(repeats).groupBy("sample", "mate", "kind", "bin").agg(F.count("*").alias("n"))


def _cut(reads: DataFrame, seq: Column) -> DataFrame:
    return reads.withColumn("new", seq)


def trim_tails(reads: DataFrame, least_run: int = 10, min_length: int = 15) -> DataFrame:
    """Cut runs of G, then of any one base, of least_run or more from the 3' end, with their qualities; short reads are dropped."""
    g = F.regexp_replace("seq", f"G{{{least_run},}}$", "")
    x = F.regexp_replace(g, rf"([ACGTN])\1{{{least_run - 1},}}$", "")
    rows = _cut(reads, x)
    rows = rows.withColumn("qual", F.substring("qual", F.lit(1), F.length("new"))).withColumn("seq", F.col("new")).drop("new")
    return rows.where(F.length("seq") >= min_length)


def trim_totals(before: DataFrame, after: DataFrame) -> DataFrame:
    """Per (sample, mate): reads and bases before and after."""
    def sums(rows, name):
        return rows.groupBy("sample", "mate").agg(F.count("*").alias(f"reads_{name}"), F.sum(F.length("seq")).alias(f"bases_{name}"))

    return sums(before, "before").join(sums(after, "after"), ["sample", "mate"], "left").fillna(0)


def adapter_length(seq: Column, adapter: str, errors: int, times: int = 1) -> Column:
    """Length of the prefix of seq that is the adapter with the fewest edits, `errors` at most; 0 if there is none.

    Of prefixes with equally few edits the one nearest to the adapter's length counts, then the longer. With times, the
    length of up to that many adapters in a row, each found in what the one before leaves. Whole batches are matched in NumPy.
    """
    if not 0 <= errors < len(adapter) <= 60:
        raise ValueError("an adapter of 60 bases at most, with fewer errors than bases")
    cut = cutter(adapter, errors, times)

    @F.arrow_udf("int")
    def of(seq: pa.Array) -> pa.Array:
        return cut(seq)

    return of(seq)


def trim_adapter(reads: DataFrame, adapter: str, times: int = 8, min_length: int = 70, errors: int = 0) -> DataFrame:
    """Cut the adapter, with up to `errors` edits each time and up to `times` in a row, from the 5' end; a pair with a short mate is dropped."""
    if not errors:
        rows = _cut(reads, F.regexp_replace("seq", f"^(?:{adapter}){{1,{times}}}", ""))
    else:
        rows = _cut(reads.withColumn("cut", adapter_length(F.col("seq"), adapter, errors, times)), F.substring("seq", F.col("cut") + 1, F.length("seq"))).drop("cut")
    rows = rows.withColumn("qual", F.expr("substring(qual, length(seq) - length(new) + 1)")).withColumn("seq", F.col("new")).drop("new")
    # a pair's least length is seen by a window, so no read is trimmed a second time to be joined; a read without a key has no pair
    pair = Window.partitionBy("sample", "read_id")
    short = F.coalesce(F.min(F.length("seq")).over(pair) < min_length, F.lit(False)) & F.col("sample").isNotNull() & F.col("read_id").isNotNull()
    return rows.withColumn("short", short).where("not short").drop("short")


def drop_pairs(reads: DataFrame, bad: DataFrame) -> DataFrame:
    return reads.join(bad.select("sample", "read_id").distinct(), ["sample", "read_id"], "left_anti")


def shingles(text: Column, k: int, sep: str = "") -> Column:
    """All k-mers of a sequence (sep empty), or k-word shingles of a text (sep a blank)."""
    if sep:  # the words are bound once, else they would be split anew for each shingle
        def of(words):
            n = F.size(words) - k + 1
            return F.when(n > 0, F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(words, i, k), sep))).otherwise(F.array().cast("array<string>"))

        return F.transform(F.array(F.split(text, r"\s+")), of)[0]
    n = F.length(text) - k + 1
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(text, i, F.lit(k)))).otherwise(F.array().cast("array<string>"))


def remove_host_reads(reads: DataFrame, host: DataFrame, k: int = 31, least: int = 2, sep: str = "", window: int = 1) -> tuple[DataFrame, DataFrame]:
    """Pairs with fewer than `least` distinct k-mers of the host, and the ids of the others with their counts.

    Of sequences, on either strand, minimizers stand for the k-mers: with a window of 19 a tenth of them is shuffled, with
    one of 1 all are. A read that has window + k - 1 bases in common with the host has one of its minimizers at least.
    With sep, k-word shingles of texts.
    """
    if sep:
        own = host.select(F.explode(shingles(F.col("seq"), k, sep)).alias("kmer")).distinct()
        mine = reads.select("sample", "read_id", F.explode(F.array_distinct(shingles(F.col("seq"), k, sep))).alias("kmer"))
    else:
        own = minimizers(host.select("seq"), k, window).select("kmer").distinct()
        mine = minimizers(reads.select("sample", "read_id", "seq"), k, window).select("sample", "read_id", "kmer")
    # the host's k-mers are distinct, so those of a read are counted once when only the shared ones are left
    shared = mine.join(own, "kmer").distinct()
    removed = shared.groupBy("sample", "read_id").agg(F.count("*").alias("host_kmers")).where(F.col("host_kmers") >= least)
    return drop_pairs(reads, removed), removed


def kmer_seed_search(reads: DataFrame, references: DataFrame, k: int = 15, least: int = 2, sep: str = "") -> DataFrame:
    """(sample, read_id, target, diagonal, seeds, qstart, qend): k-mers that a read and a reference share on one diagonal.

    Of sequences, on either strand (a column more); with sep, k-word shingles of texts.
    """
    key = ["sample", "read_id", "target"]
    if sep:
        a = reads.select("sample", "read_id", F.posexplode(shingles(F.col("seq"), k, sep)).alias("qpos", "kmer"))
        b = references.select("target", F.posexplode(shingles(F.col("seq"), k, sep)).alias("tpos", "kmer"))
        rows = a.join(b, "kmer")
    else:
        rows, key = seeds(reads, references, k, 1), [*key, "strand"]
    rows = rows.groupBy(*key, (F.col("tpos") - F.col("qpos")).alias("diagonal")).agg(F.count("*").alias("seeds"), F.min("qpos").alias("qstart"), F.max("qpos").alias("qend"))
    return rows.where(F.col("seeds") >= least)


def seeds(reads: DataFrame, references: DataFrame, k: int = 15, window: int = 5) -> DataFrame:
    """(sample, read_id, qlen, target, tlen, strand, qpos, tpos): minimizers that a read and a reference share, on either strand.

    qpos is the seed's place in the read, or on the - strand in its reverse complement, from 0. The join has a row for
    each pair of places; a window of w leaves some 4 / (w + 1)^2 of the pairs of all k-mers.
    """
    a = minimizers(reads.select("sample", "read_id", F.length("seq").alias("qlen"), "seq"), k, window).distinct().withColumnsRenamed({"pos": "qpos", "forward": "q_forward"})
    b = minimizers(references.select("target", F.length("seq").alias("tlen"), "seq"), k, window).distinct().withColumnsRenamed({"pos": "tpos", "forward": "t_forward"})
    same = F.col("q_forward") == F.col("t_forward")
    qpos = F.when(same, F.col("qpos")).otherwise(F.col("qlen") - k - F.col("qpos"))
    return a.join(b, "kmer").select("sample", "read_id", "qlen", "target", "tlen", F.when(same, "+").otherwise("-").alias("strand"), qpos.alias("qpos"), "tpos")


def in_bands(seeds: DataFrame, band: int = 16) -> DataFrame:
    """Add band: seeds of a read and a reference's strand whose diagonals (tpos - qpos) follow each other by `band` at most have the same."""
    of = Window.partitionBy("sample", "read_id", "target", "strand").orderBy("diagonal")
    rows = seeds.withColumn("diagonal", F.col("tpos") - F.col("qpos"))
    fresh = (F.col("diagonal") - F.lag("diagonal").over(of) > band).cast("int")
    return rows.withColumn("fresh", F.coalesce(fresh, F.lit(0))).withColumn("band", F.sum("fresh").over(of.rangeBetween(Window.unboundedPreceding, 0))).drop("fresh")


def chained_hits(reads: DataFrame, references: DataFrame, k: int = 15, window: int = 5, band: int = 16, least: int = 2) -> DataFrame:
    """Hits of reads on references by chained seeds, best first by `place`: the columns of a hit table, strand and seeds.

    Seeds stand in bands of diagonals. In a band's order along the read, a seed is chained if it lies further along the
    reference than every one before it (a running maximum); of the places of a minimizer in a band, the first counts.
    alnlen is the longer of the two stretches, bits the bases of the chained seeds, fident their share of alnlen;
    positions count from 1, on the read's own strand. evalue and taxid are null. Chains of fewer than `least` seeds are left out. Ties go by target, strand and place.
    """
    key = ["sample", "read_id", "target", "strand", "band"]
    rows = in_bands(seeds(reads, references, k, window), band).groupBy(*key, "qlen", "tlen", "qpos").agg(F.min("tpos").alias("tpos"))
    along = Window.partitionBy(*key).orderBy("qpos")
    furthest = F.max("tpos").over(along.rowsBetween(Window.unboundedPreceding, -1))
    chained = rows.withColumn("furthest", furthest).where("furthest IS NULL OR tpos > furthest")
    new = F.least(F.lit(k), F.col("qpos") - F.lag("qpos").over(along))
    s = chained.withColumn("bases", F.coalesce(new, F.lit(k))).groupBy(*key, "qlen", "tlen").agg(
        F.count("*").alias("seeds"), F.sum("bases").alias("bases"), F.min("qpos").alias("q0"), (F.max("qpos") + k).alias("q1"), F.min("tpos").alias("t0"), (F.max("tpos") + k).alias("t1"),
    ).where(F.col("seeds") >= least)
    plus = F.col("strand") == "+"
    alnlen = F.greatest(F.col("q1") - F.col("q0"), F.col("t1") - F.col("t0"))
    s = s.withColumn("alnlen", alnlen).withColumn("qstart", F.when(plus, F.col("q0") + 1).otherwise(F.col("qlen") - F.col("q1") + 1)).withColumn("qend", F.when(plus, F.col("q1")).otherwise(F.col("qlen") - F.col("q0")))
    best = Window.partitionBy("sample", "read_id").orderBy(F.desc("bases"), "target", "strand", "t0", "band")
    as_int = {c: F.col(c).cast("int") for c in ("alnlen", "qstart", "qend", "qlen", "tlen")}
    return s.withColumns(as_int).select(
        "sample", F.col("read_id").alias("query"), "target", "strand", (F.col("bases") / F.col("alnlen")).alias("fident"), "alnlen", "qstart", "qend", (F.col("t0") + 1).cast("int").alias("tstart"), F.col("t1").cast("int").alias("tend"),
        F.lit(None).cast("double").alias("evalue"), F.col("bases").cast("double").alias("bits"), "qlen", "tlen", F.lit(None).cast("int").alias("taxid"), "seeds", F.row_number().over(best).alias("place"),
    )


def fastq_to_fasta(reads: DataFrame) -> DataFrame:
    return reads.select(F.concat(F.lit(">"), "read_id", F.lit("\n"), "seq").alias("value"))


def merge_lanes(lanes: list[DataFrame]) -> DataFrame:
    out = lanes[0]
    for lane in lanes[1:]:
        out = out.unionByName(lane)
    return out


def qc_summary(counters: list[DataFrame]) -> DataFrame:
    """Counter tables (sample, name, value) as one row per (sample, name)."""
    return merge_lanes(counters).groupBy("sample", "name").agg(F.sum("value").alias("value"))
