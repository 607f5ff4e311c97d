"""Distances between all samples of a cohort, their coordinates, and a permutation test on them, by blocks of samples."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hitloom.functions.stage import stage

BLOCK = 64  # samples
WIDE = 1 << 16  # taxa of a block that stand in one dense matrix
AXES, WIDTH, STEPS, TOLERANCE = 2, 8, 24, 1e-9


def blocked(samples: DataFrame, size: int = BLOCK) -> tuple[DataFrame, int]:
    """samples with `block`, a number that some `size` of them share, by hash; and the number of blocks."""
    blocks = max(1, -(-samples.count() // size))
    return samples.withColumn("block", F.pmod(F.xxhash64("sample"), F.lit(blocks)).cast("int")), blocks


def in_pairs(rows: DataFrame, blocks: int) -> DataFrame:
    """rows once for each pair of blocks (i <= j) that their own block is in, with i and j."""
    other = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("other")
    return rows.select("*", other).select(*rows.columns, F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))


def _least_sums(table: pa.Table) -> pa.Table:
    """(sample, block, i, j, taxids, reads) of a pair of blocks -> (a, b, shared): the sum of least reads of each two samples."""
    names, block = table.column("sample").to_pylist(), np.array(table.column("block"))
    if not names:
        return pa.table({"a": pa.array([], pa.string()), "b": pa.array([], pa.string()), "shared": pa.array([], pa.float64())})
    taxids, reads = (table.column(c).combine_chunks() for c in ("taxids", "reads"))
    of = np.repeat(np.arange(len(names)), np.diff(taxids.offsets.to_numpy()))
    taxa, at = np.unique(taxids.values.to_numpy(), return_inverse=True)
    values = reads.values.to_numpy().astype(float)
    i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
    left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
    shared = np.zeros((len(left), len(right)))
    for lo in range(0, len(taxa), WIDE):
        inside = (at >= lo) & (at < lo + WIDE)
        dense = np.zeros((len(names), min(WIDE, len(taxa) - lo)))
        dense[of[inside], at[inside] - lo] = values[inside]
        for k, x in enumerate(left):
            shared[k] += np.minimum(dense[x], dense[right]).sum(axis=1)
    pairs = [(names[x], names[y], shared[k, m]) for k, x in enumerate(left) for m, y in enumerate(right) if i != j or names[x] < names[y]]
    a, b, s = zip(*pairs, strict=True) if pairs else ((), (), ())
    swap = [x > y for x, y in zip(a, b, strict=True)]
    first = [y if w else x for x, y, w in zip(a, b, swap, strict=True)]
    second = [x if w else y for x, y, w in zip(a, b, swap, strict=True)]
    return pa.table({"a": pa.array(first, pa.string()), "b": pa.array(second, pa.string()), "shared": pa.array(s, pa.float64())})


def bray_curtis(counts: DataFrame, size: int = BLOCK) -> DataFrame:
    """(a, b, distance) for all pairs of samples a < b: 1 - 2 sum(min) / (sum a + sum b); 1 where nothing is shared.

    A sample is one row of taxids and reads. Blocks of samples meet in pairs, so each row is sent once for each block,
    and no taxon, however common, is joined with itself. Several rows of a sample and taxon are added up.
    """
    sums = counts.groupBy("sample", "taxid").agg(F.sum("reads").alias("reads")).groupBy("sample").agg(
        F.sum("reads").alias("total"), F.collect_list(F.col("taxid").cast("long")).alias("taxids"), F.collect_list(F.col("reads").cast("double")).alias("reads"),
    )
    rows, blocks = blocked(stage(sums.withColumn("sample", F.col("sample").cast("string"))), size)
    units = in_pairs(rows.drop("total"), blocks).groupBy("i", "j").applyInArrow(_least_sums, "a string, b string, shared double")
    left, right = rows.select(F.col("sample").alias("a"), F.col("total").alias("ta")), rows.select(F.col("sample").alias("b"), F.col("total").alias("tb"))
    return units.join(left, "a").join(right, "b").select("a", "b", (1 - 2 * F.col("shared") / (F.col("ta") + F.col("tb"))).alias("distance"))


# --- coordinates


def _gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = 0.0
    for batch in batches:
        if batch.num_rows:
            rows = np.hstack([c.flatten().to_numpy().reshape(batch.num_rows, -1) for c in batch.columns])
            total = total + rows.T @ rows
    if not np.isscalar(total):
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel()], pa.list_(pa.float64()))], ["products"])


def gram(rows: DataFrame, *columns: str) -> np.ndarray:
    """The products of all columns (of numbers, in arrays of one length), summed over the rows: as many numbers as columns squared."""
    parts = rows.select(*columns).mapInArrow(_gram, "products array<double>")
    sums = parts.select(F.posexplode("products").alias("at", "x")).groupBy("at").agg(F.sum("x").alias("x")).orderBy("at").collect()
    n = int(round(len(sums) ** 0.5))
    return np.array([r["x"] for r in sums]).reshape(n, n)


def _combine(batches: Iterator[pa.RecordBatch], names: list[str], weights: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [c for c, name in zip(batch.columns, batch.schema.names, strict=True) if name not in names]
        kept = [n for n in batch.schema.names if n not in names]
        parts = [batch.column(n).flatten().to_numpy().reshape(batch.num_rows, -1) @ w for n, w in zip(names, weights, strict=True)]
        sums = pa.array(list(np.sum(parts, axis=0)), pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([*out, sums], [*kept, "sum"])


def combined(rows: DataFrame, keep: list[str], parts: dict[str, np.ndarray]) -> DataFrame:
    """keep, and `sum`: the sum of the array columns, each times its matrix."""
    rows = rows.select(*keep, *(F.col(c).alias(f"{c}_") for c in parts))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keep).schema.fields), "sum array<double>"])
    return rows.mapInArrow(partial(_combine, names=[f"{c}_" for c in parts], weights=list(parts.values())), schema)


def basis(products: np.ndarray) -> np.ndarray:
    """The matrix that makes columns with these products orthonormal; directions that are nothing but rounding are left out."""
    values, vectors = np.linalg.eigh(products)
    good = values > max(values.max(), 0) * 1e-14
    return vectors[:, good] / np.sqrt(values[good])


def pcoa(distances: DataFrame, tolerance: float = TOLERANCE, steps: int = STEPS, seed: int = 0) -> DataFrame:
    """sample, axis1, axis2 (principal coordinates), explained1, explained2 (the eigenvalues' shares of the trace).

    A block Lanczos iteration with full reorthogonalisation on the double-centred squares of the distances, which are
    never put in one place: a step joins the table of pairs with WIDTH numbers a sample and sums by sample. What comes to the driver
    are products of at most WIDTH * steps columns. It ends when both residuals are `tolerance` times the largest
    eigenvalue at most, when the whole space is spanned, or after `steps`. Of an axis, the value furthest from 0
    is positive (of several, that of the first sample). An axis without a positive eigenvalue is 0.
    """
    square = F.col("distance") * F.col("distance")
    half = distances.select("a", "b", square.alias("d2"))
    both = stage(half.unionByName(half.select(F.col("b").alias("a"), F.col("a").alias("b"), "d2")))
    totals = both.groupBy("a").agg(F.sum("d2").alias("d2"))
    n, grand = totals.agg(F.count("*"), F.sum("d2")).first()
    if not n:
        return distances.sparkSession.createDataFrame([], "sample string, axis1 double, axis2 double, explained1 double, explained2 double")
    start = F.array(*(F.xxhash64("a", F.lit(seed), F.lit(k)) / F.lit(2.0**63) for k in range(WIDTH)))
    rows = stage(totals.select(F.col("a").alias("sample"), F.array(F.col("d2") / n, F.lit(1.0)).alias("mean"), start.alias("start")))
    first = basis(gram(rows, "start"))
    q = stage(combined(rows, ["sample", "mean"], {"start": first}).withColumnRenamed("sum", "q"))
    grand, width, d = grand / n / n, first.shape[1], first.shape[1]
    projected = np.zeros((0, 0))
    for step in range(steps):
        x = q.select(F.col("sample").alias("b"), *(F.col("q")[d - width + k].alias(f"x{k}") for k in range(width)))
        times = both.join(x, "b").groupBy("a").agg(F.array(*(F.sum(F.col("d2") * F.col(f"x{k}")) for k in range(width))).alias("t"))
        sums = gram(q.select("mean", F.slice("q", d - width + 1, width).alias("x")), "mean", "x")[:2, 2:]  # of mean * x and of x
        y = q.join(times.withColumnRenamed("a", "sample"), "sample")
        centre = np.vstack([sums[1], sums[0] - grand * sums[1]]) / 2  # rows of `mean` are (its mean, 1)
        y = stage(combined(y.withColumn("mean2", F.col("mean")).withColumn("q2", F.col("q")), ["sample", "mean2", "q2"], {"t": -np.eye(width) / 2, "mean": centre}).withColumnsRenamed({"mean2": "mean", "q2": "q", "sum": "y"}))
        h = gram(y, "q", "y")[:d, d:]
        w = stage(combined(y.withColumn("q2", F.col("q")), ["sample", "mean", "q2"], {"y": np.eye(width), "q": -h}).withColumnsRenamed({"q2": "q", "sum": "w"}))
        products = gram(w, "q", "w")
        again = products[:d, d:]
        rest = products[d:, d:] - again.T @ again
        h = h + again
        wider = np.zeros((d, d))
        wider[: len(projected), : len(projected)] = projected
        wider[:, d - width :] = h
        wider[d - width :, :] = h.T
        projected = wider
        values, vectors = np.linalg.eigh((projected + projected.T) / 2)
        top = np.argsort(-values)[:AXES]
        last = vectors[d - width :, top]
        residual = np.sqrt(np.maximum(np.einsum("ik,ij,jk->k", last, rest, last), 0))
        scale = np.abs(values).max()
        if d >= n or scale == 0 or rest.trace() <= (1e-13 * scale) ** 2 * width or step + 1 == steps or residual.max() <= tolerance * scale:
            break
        fresh = basis(rest)
        new = combined(w.withColumn("q2", F.col("q")), ["sample", "mean", "q2"], {"w": fresh, "q": -again @ fresh})
        q = stage(new.select("sample", "mean", F.concat("q2", "sum").alias("q")))
        width = fresh.shape[1]
        d += width
    weights = np.zeros((d, AXES))
    weights[:, : len(top)] = vectors[:, top] * np.sqrt(np.maximum(values[top], 0))
    shares = np.zeros(AXES)
    trace = (grand * n) / 2  # of the centred matrix: half the sum of the mean squares
    shares[: len(top)] = np.maximum(values[top], 0) / trace if trace > 0 else 0
    axes = stage(combined(q, ["sample"], {"q": weights}).select("sample", F.col("sum")[0].alias("axis1"), F.col("sum")[1].alias("axis2")))
    far = axes.agg(*(F.max(F.abs(c)).alias(c) for c in ("axis1", "axis2"))).first()
    signs = axes.agg(*(F.min_by(F.signum(c), F.when(F.abs(c) >= far[c] * (1 - 1e-6), F.col("sample"))).alias(c) for c in ("axis1", "axis2"))).first()
    return axes.select("sample", *((F.col(c) * (signs[c] or 1.0)).alias(c) for c in ("axis1", "axis2")), F.lit(float(shares[0])).alias("explained1"), F.lit(float(shares[1])).alias("explained2"))


# --- permutations


def permuted(groups: DataFrame, permutations: int, seed: int) -> DataFrame:
    """sample, labels: its group's number in each permutation, the first of which is none. Labels are permuted by sorting on a seeded hash."""
    spark = groups.sparkSession
    numbers = groups.select("group").distinct().select("group", F.dense_rank().over(Window.orderBy("group")).alias("number"))  # one row for each group
    own = groups.join(numbers, "group").select("sample", "number")
    perms = spark.range(permutations + 1).withColumnRenamed("id", "perm")
    order = F.when(F.col("perm") == 0, F.lit(0)).otherwise(F.xxhash64("s", "perm", F.lit(seed)))
    rows = perms.crossJoin(own.select("number", F.col("sample").alias("s"))).withColumn("k", F.row_number().over(Window.partitionBy("perm").orderBy(order, "s")))
    fixed = rows.where("perm = 0").select("k", F.col("s").alias("sample"))
    labels = rows.join(fixed, "k").groupBy("sample").agg(F.array_sort(F.collect_list(F.struct("perm", F.col("number").cast("int").alias("number")))).alias("labels"))
    return labels.select("sample", F.col("labels.number").alias("labels"))


def _within(sizes: dict[int, int]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def of(pairs: pa.Table, labels: pa.Table) -> pa.Table:
        """Pairs (a, b, distance) and the labels of two blocks -> one row: the sums of squares within groups, of each permutation."""
        if not pairs.num_rows or not labels.num_rows:
            return pa.table({"sums": pa.array([], pa.list_(pa.float64()))})
        place = {s: k for k, s in enumerate(labels.column("sample").to_pylist())}
        matrix = np.array(labels.column("labels").combine_chunks().flatten()).reshape(len(place), -1)
        weight = np.zeros(max(sizes) + 1)
        weight[list(sizes)] = [1 / x for x in sizes.values()]
        a, b = (np.array([place.get(s, -1) for s in pairs.column(c).to_pylist()]) for c in ("a", "b"))
        known = (a >= 0) & (b >= 0)
        squares, total = np.array(pairs.column("distance")) ** 2, np.zeros(matrix.shape[1])
        for k in np.flatnonzero(known):
            total += np.where(matrix[a[k]] == matrix[b[k]], squares[k] * weight[matrix[a[k]]], 0)
        return pa.table({"sums": pa.array([total], pa.list_(pa.float64()))})

    return of


def permanova(distances: DataFrame, groups: DataFrame, permutations: int = 999, seed: int = 0, size: int = BLOCK) -> DataFrame:
    """One row: pseudo_f, p_value, samples, n_groups. Labels are permuted by sorting on a seeded hash.

    A sample carries all its permuted labels in one array. Pairs are shuffled once, by pairs of sample blocks, where they meet the arrays
    of these blocks; each unit gives one row of sums.
    """
    labels, blocks = blocked(stage(permuted(groups.select("sample", "group"), permutations, seed)), size)
    counts = labels.groupBy(F.col("labels")[0].alias("number")).agg(F.count("*").alias("n")).collect()  # a row for each group
    sizes = {r["number"]: r["n"] for r in counts}
    n, g = sum(sizes.values()), len(sizes)
    block = lambda c: F.pmod(F.xxhash64(c), F.lit(blocks)).cast("int")
    pairs = stage(distances.select("a", "b", "distance", F.least(block("a"), block("b")).alias("i"), F.greatest(block("a"), block("b")).alias("j")))
    units = pairs.groupBy("i", "j").cogroup(in_pairs(labels, blocks).select("sample", "labels", "i", "j").groupBy("i", "j")).applyInArrow(_within(sizes), "sums array<double>")
    within = units.select(F.posexplode("sums").alias("perm", "x")).groupBy("perm").agg(F.sum("x").alias("sw"))
    total = pairs.agg(F.sum(F.col("distance") * F.col("distance"))).first()[0]
    if total is None or g < 2 or n <= g:
        return distances.sparkSession.createDataFrame([(None, None, n, g)], "pseudo_f double, p_value double, samples int, n_groups int")
    f = ((total / n - F.col("sw")) / (g - 1)) / (F.col("sw") / (n - g))
    rows = stage(within.select("perm", f.alias("f")))
    seen = rows.where("perm = 0").first()["f"]
    beyond = F.count_if((F.col("perm") > 0) & (F.col("f") >= seen - 1e-12))
    return rows.agg(F.lit(seen).alias("pseudo_f"), ((beyond + 1) / (permutations + 1)).alias("p_value"), F.lit(n).cast("int").alias("samples"), F.lit(g).cast("int").alias("n_groups"))
