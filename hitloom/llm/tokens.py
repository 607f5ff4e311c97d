"""Token counts through a digest cache.

The key of a count is the digest of the normalised content and the digest of the tokenizer's version: its file, its
library and that library's version. Contents are joined to the counts stored under this tokenizer; of those that aren't
there, each distinct one is encoded once, where its document with the least doc_id stands, and its count is appended.
Then every document's digest meets its count.

Only ids and digests are shuffled, and the texts to be encoded: these are found by digest and doc_id together, so that
copies, however many, don't meet. Where few contents are new, their table is small and Spark broadcasts it by size.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitloom.functions.stage import own_dir

from .common import cut, read
from .pieces import model_path

LIMIT = 4096
BATCH_CHARS = 1 << 20


def tokenizer_digest(path: str) -> str:
    """Digest of a tokenizer's file, library and library version."""
    import sentencepiece
    import tokenizers

    library = f"tokenizers {tokenizers.__version__}" if path.endswith(".json") else f"sentencepiece {sentencepiece.__version__}"
    with open(path, "rb") as f:
        return hashlib.sha256(library.encode() + b"\n" + f.read()).hexdigest()


def only_escapes(path: str) -> bool:
    """True for a sentencepiece model that changes nothing in a text but spaces, which it writes as markers."""
    from sentencepiece import sentencepiece_model_pb2

    if path.endswith(".json"):
        return False
    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    spec = model.normalizer_spec
    own = any(p.type == p.USER_DEFINED for p in model.pieces)  # these are looked for before spaces are escaped
    return spec.name == "identity" and spec.escape_whitespaces and not spec.remove_extra_whitespaces and not own


def content(path: str):
    """The normalised content of `text`: null as empty, and what the model can't tell apart written in one way."""
    text = F.coalesce("text", F.lit(""))
    return F.replace(text, F.lit(" "), F.lit("▁")) if only_escapes(path) else text


def counter(path: str) -> Callable[[list[str]], list[int]]:
    """Texts -> numbers of tokens, without tokens added at the ends."""
    if path.endswith(".json"):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        return lambda texts: [len(e) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return lambda texts: [len(ids) for ids in sp.encode(texts, num_threads=1)]


def _count(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """(digest, text) -> (digest, n_tokens), a digest once for each task."""
    count, seen = counter(path), set()

    def rows(texts: dict[bytes, str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(texts), pa.binary()), pa.array(count(list(texts.values())), pa.int64())], ["digest", "n_tokens"])

    for batch in batches:
        texts, chars = {}, 0
        for digest, text in zip(batch.column("digest").to_pylist(), batch.column("text"), strict=True):
            if digest not in seen:
                seen.add(digest)
                texts[digest] = text.as_py() or ""
                chars += len(texts[digest])
            if chars >= BATCH_CHARS:
                yield rows(texts)
                texts, chars = {}, 0
        if texts:
            yield rows(texts)


def stored(spark: SparkSession, cache: str, tokenizer: str) -> DataFrame:
    """(digest, n_tokens) in the cache for a tokenizer; one row for each digest, even if two jobs have appended it."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(cache)
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], "digest binary, n_tokens long")
    table = spark.read.schema("digest binary, n_tokens long, tokenizer string").parquet(cache)
    return table.where(F.col("tokenizer") == tokenizer).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def looked_up(docs: DataFrame, keys: DataFrame, cache: str, path: str) -> DataFrame:
    """(digest, n_tokens) of every content of docs (doc_id, text, digest); keys: (doc_id, digest). Those that the cache lacks are appended to it."""
    tokenizer = tokenizer_digest(path)
    distinct = keys.groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    found = cut(distinct.join(stored(docs.sparkSession, cache, tokenizer), "digest", "left"))
    known, misses = found.where("n_tokens IS NOT NULL").select("digest", "n_tokens"), found.where("n_tokens IS NULL")
    if misses.isEmpty():
        return known
    same = (F.col("d.digest") == F.col("m.digest")) & F.col("d.doc_id").eqNullSafe(F.col("m.doc_id"))
    texts = docs.alias("d").join(misses.alias("m"), same, "left_semi").select("digest", "text")
    counts = cut(texts.mapInArrow(partial(_count, path=path), "digest binary, n_tokens long").distinct())
    counts.withColumn("tokenizer", F.lit(tokenizer)).write.mode("append").partitionBy("tokenizer").parquet(cache)
    return known.unionByName(counts)


def count_tokens(docs: DataFrame, cache: str, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (n_tokens > limit) of each document; new contents are appended to the cache.

    cache: a folder that all executors share. A null text counts as empty, and an empty one has no tokens. Repeated rows
    stay; rows of a null doc_id are counted like others; extra columns, whatever their names, are left out. A text with
    the digest of another takes its count (SHA-256; ties of equal texts are the point of the cache). An empty table
    gives no rows and appends nothing.
    """
    path = path or model_path()
    docs = docs.select("doc_id", "text", F.unhex(F.sha2(content(path).cast("binary"), 256)).alias("digest"))
    keys = cut(docs.select("doc_id", "digest", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes")))
    counts = looked_up(docs, keys, cache, path)
    return keys.join(counts, "digest").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def op11_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents. The cache is a new folder for each call, so all distinct texts are encoded in it."""
    return count_tokens(read(spark, sf_dir, "documents"), f"{own_dir(spark)}/tokens-{uuid.uuid4().hex}")
