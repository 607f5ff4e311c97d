"""Line dedup by a log-template tree: fixed-depth parsing, wildcards for variable fields, recurring templates dropped.

A line's leaf is its number of words and its first LEADING words; words with a digit count as a wildcard from the start,
unless they are more than half of the line. So that a variable field among these doesn't hide a template, a line of more words has leaves at PLACES places, from its
first words to its last; lines are alike if they are so in any leaf.
A line's fields are its words. A node of the tree (a leaf, at first) has a constant at a place where more than half of
its distinct lines have the same word; where no word has more than half, the place is variable. If at least half of the
places are constant, the node is a template, and the lines that agree with it in at least half of their words belong to
it. A template is seen only if one of its leaves holds none of its variable words, which becomes less likely the more of
its words are variable; the README has measured shares. Both are shares, so neither noise nor a growing corpus makes a template fade. If half of the lines don't belong, the
node is split instead by the variable place at which two of its lines agree most often, and its parts, of at most half
the lines each, are looked at in turn: so lines that have only the leaf in common come apart.
A line that is alone in its node is its own template. A template that occurs in several documents is dropped from all
but the one with the least doc_id.

Lines of fewer than MIN_WORDS words coincide by chance: they are taken as they are, digits included, and count as
recurring only in SHORT_DOCS documents or more. A line without blanks, as in Chinese, Japanese or Thai, is long from
MIN_CHARS characters besides digits on; it too is a template by itself, with its runs of digits as wildcards.

Only hashes of lines and fields are shuffled and counted, a distinct line once. Fields are hashed in a second pass over
the texts, for the lines of leaves that have several; these are looked up in a bitmap of 16 bits for each of them (up to MOST_BITS), in which a few other
lines are found by chance and fall out in a join. Texts move once, to meet the positions that they lose.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, read

LEADING, PLACES, MIN_WORDS = 3, 4, 4
MIN_CHARS, SHORT_DOCS = 16, 100
LEAST_BITS, MOST_BITS, ROWS = 1 << 20, 1 << 27, 1 << 12
NODE_WORDS = 1 << 18
DIGIT, DIGITS = re.compile("[0-9]"), re.compile("[0-9]+")


def masked(line: str) -> list[str]:
    """The words of a line, those with a digit as wildcards; a line of more digits than words stays as it is."""
    words = line.split()
    if not DIGIT.search(line):
        return words
    out = [("<*>" if DIGIT.search(w) else w) for w in words]
    return out if 2 * out.count("<*>") <= len(out) else words


def h64(text: str, seed: int = 0) -> int:
    h = xxhash.xxh64_intdigest(text, seed)
    return h - (1 << 64) if h >> 63 else h


def leaves_of(words: list[str]) -> list[int]:
    """The leaves of a line: its number of words, a place, and the LEADING words from there."""
    n = len(words)
    places = sorted({(n - LEADING) * k // (PLACES - 1) for k in range(PLACES)})
    return [h64(" ".join(words[at : at + LEADING]), n << 16 | at) for at in places]


def key_of(line: str) -> tuple[int, bool, list[int]] | None:
    """(line, short, leaves) of a line; None if it is blank. Lines of fewer than MIN_WORDS words have no leaves."""
    words = masked(line)
    if len(words) >= MIN_WORDS:
        return h64(" ".join(words)), False, leaves_of(words)
    if not words:
        return None
    words = line.split()
    long = len(words) == 1 and len(DIGITS.sub("", words[0])) >= MIN_CHARS
    return h64("long " + DIGITS.sub("<*>", words[0]) if long else "short " + " ".join(words)), not long, []


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, dh, text) -> (doc_id, dh, at, line, short, leaves) of each distinct line that isn't blank."""
    names = ["doc_id", "dh", "at", "line", "short", "leaves"]
    for batch in batches:
        out: list[list] = [[] for _ in names]
        for doc_id, dh, text in zip(*(batch.column(c) for c in ("doc_id", "dh", "text")), strict=True):
            own: dict[int, list[int]] = {}
            for pos, line in enumerate((text.as_py() or "").split("\n")):
                if key := key_of(line):
                    at = own.setdefault(key[0], [])
                    if not at:
                        for column, value in zip(out, (doc_id.as_py(), dh.as_py(), at, *key), strict=True):
                            column.append(value)
                    at.append(pos)
        types = [batch.schema.field("doc_id").type, pa.int64(), pa.list_(pa.int32()), pa.int64(), pa.bool_(), pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names)


def _fields(batches: Iterator[pa.RecordBatch], bitmap: bytes) -> Iterator[pa.RecordBatch]:
    """text -> (line, fields) of each line in the bitmap; a line once for some texts."""
    def rows(found):
        return pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.list_(pa.int32()))], ["line", "fields"])

    found: dict[int, list[int]] = {}
    bits = 8 * len(bitmap)
    for batch in batches:
        for text in batch.column("text"):
            for line in (text.as_py() or "").split("\n"):
                words = masked(line)
                if len(words) >= MIN_WORDS and bitmap[(bit := (h := h64(" ".join(words))) % bits) >> 3] >> (bit & 7) & 1 and h not in found:
                    found[h] = [xxhash.xxh32_intdigest(x) - (1 << 31) for x in words]
            if len(found) >= ROWS:
                yield rows(found)
                found = {}
    yield rows(found)


def bitmap_of(lines: DataFrame) -> bytes:
    """A power of two of bits, 16 for each line at least (up to MOST_BITS), with that of each line set; a row for each 64 bits at most comes to the driver."""
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (16 * lines.count()).bit_length()))
    bit = F.pmod("line", F.lit(bits))
    words = lines.groupBy(F.floor(bit / 64).alias("at")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(line, {bits}L) % 64 as int))")).alias("word"))
    out = np.zeros(bits // 64, "<i8")
    for r in words.toLocalIterator():
        out[r["at"]] = r["word"]
    return out.tobytes()


def keyed(docs: DataFrame) -> DataFrame:
    """Add dh, a hash of id and text: with doc_id it names a document, and rows alike in both are one."""
    return docs.withColumn("dh", F.xxhash64("doc_id", "text"))


def several_lines(docs: DataFrame, distinct: DataFrame) -> DataFrame:
    """(leaf, line, fields) of the distinct lines (line, leaves, x, y) in leaves with several lines and several documents.

    x and y are the least and greatest hash of a line's documents; a leaf within one document needs no templates.
    """
    members = distinct.select(F.explode("leaves").alias("leaf"), "line", "x", "y")
    several = members.groupBy("leaf").agg(F.min("line").alias("a"), F.max("line").alias("b"), F.min("x").alias("x"), F.max("y").alias("y")).where("a != b and x != y").select("leaf")
    wanted = cut(members.select("leaf", "line").join(several, "leaf").groupBy("line").agg(F.collect_list("leaf").alias("leaves")))  # PLACES at most
    fields = docs.select("text").mapInArrow(partial(_fields, bitmap=bitmap_of(wanted)), "line long, fields array<int>")
    fields = fields.groupBy("line").agg(F.first("fields").alias("fields")).join(wanted, "line")
    return cut(fields.select(F.explode("leaves").alias("leaf"), "line", "fields"))


def grown(node: int, fields: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
    """The rows and the node of each template under a node; fields has a row for each line."""
    open_ = [(node, np.arange(len(fields)))]
    while open_:
        node, rows = open_.pop()
        part, n, width = fields[rows], len(rows), fields.shape[1]
        middle = np.partition(part, n // 2, axis=0)[n // 2]  # a word of more than half of the lines stands in the middle
        same = part == middle
        constant = 2 * same.sum(axis=0) > n
        own = 2 * (same & constant).sum(axis=1) >= width
        if 2 * constant.sum() >= width and (2 * own.sum() >= n or constant.all()):
            if own.sum() > 1:
                yield rows[own], node
            if (~own).sum() > 1:
                open_.append((h64(f"{node} rest"), rows[~own]))
        elif n > 2:
            varies = np.flatnonzero(~constant)
            alike = [(np.unique(part[:, p], return_counts=True)[1] ** 2).sum() for p in varies]
            place = varies[int(np.argmax(alike))]
            values, of = np.unique(part[:, place], return_inverse=True)
            sizes = np.bincount(of)
            open_ += [(h64(f"{node} {place} {values[i]}"), rows[of == i]) for i in np.flatnonzero(sizes > 1)]


def _grown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, lines: leaf, line, fields) of whole nodes -> (leaf, line, template)."""
    for batch in batches:
        lists = batch.column("lines")
        starts = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        leaf, line, fields = lists.flatten().flatten()
        leaf, line, at = leaf.to_numpy(), line.to_numpy(), fields.offsets.to_numpy()
        words = fields.values.to_numpy()
        out, name = [np.zeros(0, np.int64)], []
        for node, lo, hi in zip(batch.column("node").to_pylist(), starts[:-1], starts[1:], strict=True):
            own = words[at[lo] : at[hi]].reshape(hi - lo, -1)  # lines of a node are equally long
            if hi - lo == 2:
                found = [(np.arange(2), node)] if 2 * (own[0] == own[1]).sum() >= own.shape[1] else []
            else:
                found = grown(node, own)
            for rows, template in found:
                out.append(rows + lo)
                name.append(np.full(len(rows), template, np.int64))
        rows = np.concatenate(out)
        yield pa.RecordBatch.from_arrays([pa.array(leaf[rows]), pa.array(line[rows]), pa.array(np.concatenate([np.zeros(0, np.int64), *name]))], ["leaf", "line", "template"])


def templates(lines: DataFrame) -> DataFrame:
    """lines of several_lines() -> (leaf, line, template) of those that share their template with other lines.

    Nodes of up to NODE_WORDS words are grown within a task; larger ones by rounds of aggregations, in the same way. What
    goes on after a round is at most half of its node, so there are as many rounds as a node can be halved.
    """
    open_, done = lines.withColumn("node", F.col("leaf")), []
    while True:
        sizes = open_.groupBy("node").agg(F.count("*").alias("lines"), F.sum(F.size("fields")).alias("words")).where("lines > 1")
        sized = cut(open_.join(sizes, "node"))
        small = sized.where(f"words <= {NODE_WORDS}").groupBy("node").agg(F.collect_list(F.struct("leaf", "line", "fields")).alias("lines"))
        done.append(small.mapInArrow(_grown, "leaf long, line long, template long"))
        large = sized.where(f"words > {NODE_WORDS}").drop("words")
        if large.isEmpty():
            return reduce(DataFrame.unionByName, done)
        values = large.select("node", "lines", F.posexplode("fields").alias("place", "field")).groupBy("node", "lines", "place", "field").agg(F.count("*").alias("n"))
        places = values.groupBy("node", "lines", "place").agg(F.max(F.struct("n", "field")).alias("most"), F.sum(F.col("n").cast("double") * F.col("n")).alias("alike"))
        constant = 2 * F.col("most.n") > F.col("lines")
        nodes = places.groupBy("node").agg(
            F.count("*").alias("size"), F.collect_list(F.when(constant, F.struct("place", "most.field"))).alias("constants"),
            F.max(F.when(~constant, F.struct("alike", (-F.col("place")).alias("place")))).alias("best"),
        )
        own = 2 * F.size(F.filter("constants", lambda c: F.get("fields", c["place"]) == c["field"])) >= F.col("size")
        rows = cut(large.join(nodes, "node").select("node", "leaf", "line", "fields", "lines", "size", F.size("constants").alias("n"), (-F.col("best.place")).alias("place"), own.alias("own")))
        enough = rows.groupBy("node").agg(F.count_if("own").alias("owned"))
        fits = (2 * F.col("n") >= F.col("size")) & ((2 * F.col("owned") >= F.col("lines")) | F.col("place").isNull())
        rows = cut(rows.join(enough, "node").withColumn("fits", fits))
        done.append(rows.where("fits and own and owned > 1").select("leaf", "line", F.col("node").alias("template")))
        rest = rows.where("fits and not own").withColumn("node", F.xxhash64("node", F.lit("rest")))
        parts = rows.where("not fits").withColumn("node", F.xxhash64("node", "place", F.get("fields", "place")))
        open_ = rest.unionByName(parts).select("leaf", "line", "fields", "node")


def often(lines: DataFrame, distinct: DataFrame) -> DataFrame:
    """distinct without the short lines in fewer than SHORT_DOCS documents; repeated rows are one document."""
    short = lines.where("short").join(distinct.where("short").select("line"), "line").select("line", "dh").distinct()
    enough = cut(short.groupBy("line").count().where(f"count >= {SHORT_DOCS}").select("line"))
    return distinct.where("not short").unionByName(distinct.where("short").join(enough, "line", "left_semi"))


def recurring_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, dh, at): the line positions to drop from each document of keyed().

    A line drops out of a document if any of its templates also occurs in a document with a lesser doc_id, so whatever
    is dropped has a like in a lesser document, and the least of them keeps its line.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    lines = cut(docs.select("doc_id", "dh", "text").mapInArrow(_lines, f"doc_id {id_type}, dh long, at array<int>, line long, short boolean, leaves array<long>"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "dh"))
    distinct = lines.groupBy("line", "short").agg(F.min("dh").alias("x"), F.max("dh").alias("y"), first.alias("first"), F.count("*").alias("rows"), F.first("leaves").alias("leaves"))
    distinct = often(lines, cut(distinct.where(f"not short or rows >= {SHORT_DOCS}")))
    found = templates(several_lines(docs, distinct)).select("line", "template")
    own = cut(distinct.join(found, "line", "left").select("line", F.coalesce("template", "line").alias("template"), "x", "y", "first"))
    recurring = own.groupBy("template").agg(F.min("x").alias("x"), F.max("y").alias("y"), F.min("first").alias("first")).where("x != y")
    drop = own.select("line", "template").join(recurring.select("template", F.col("first.dh").alias("keep")), "template").select("line", "keep").distinct()
    later = lines.select("doc_id", "dh", "at", "line").join(drop, "line").where("dh != keep")
    return later.groupBy("doc_id", "dh").agg(F.array_distinct(F.flatten(F.collect_list("at"))).alias("at"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """docs with recurring lines taken out of text, and n_dropped (lines).

    Rows and other columns stay, but for one called n_dropped; a document can end up with an empty text. Null and empty texts stay as they are, and
    rows equal in doc_id and text are one document. A null doc_id comes after all others in the choice of the first.
    """
    docs = docs.drop("n_dropped")
    drop = recurring_lines(keyed(docs.select("doc_id", "text")))
    same = F.col("d.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.xxhash64("d.doc_id", "d.text") == F.col("r.dh"))
    joined = docs.alias("d").join(drop.alias("r"), same, "left")
    def without(lines):  # the lines are bound once, else the text would be split anew for each of them
        kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("r.at"))
        return F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")

    text = F.transform(F.array(F.split("d.text", "\n", -1)), without)[0]
    text = F.when(F.col("r.at").isNull(), F.col("d.text")).otherwise(text)
    dropped = F.when(F.col("r.at").isNull(), 0).otherwise(F.size("r.at"))
    return joined.select(*(text.alias("text") if c == "text" else F.col(f"d.`{c}`") for c in docs.columns), dropped.alias("n_dropped"))


def op1_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines whose templates recur; null and empty texts stay as they are."""
    return dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
