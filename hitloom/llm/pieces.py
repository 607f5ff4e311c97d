"""SentencePiece encoding and decoding through a table of distinct chunks.

In the models accepted here no piece runs from another character into a whitespace marker, and none holds a line
feed, so no merge crosses those places. A text is therefore cut into marked words (a run of markers and the characters
after it) and line feeds; each distinct chunk is segmented and decoded once per task by the library, and ids and
surfaces are put back by position. The table of a task is emptied at TABLE_CHARS characters, and chunks of more than
CHUNK_CHARS are segmented without being kept, so memory stays bounded whatever the vocabulary of the corpus.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read

MODEL = "piece_bpe_32k.model"
TABLE_CHARS, CHUNK_CHARS = 2_000_000, 1000
CHUNK = re.compile("[ ▁]*[^ ▁\n]+|[ ▁]+|\n")


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class ChunkTable(dict):
    """chunk -> (its ids as text, each with a comma after it; its decoded surface)."""

    def __init__(self, path: str):
        import sentencepiece

        self.chars = 0
        self.sp = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.head = sp.encode("\n")  # the marker that the library puts before every text, and the line feed
        for piece in map(sp.id_to_piece, range(sp.get_piece_size())):
            if re.search("[^▁]▁|\n", piece):
                raise ValueError(f"the piece {piece!r} crosses a whitespace marker; chunks of this model can't be encoded apart")
        if len(self.head) != 2 or sp.decode(self.head) != "\n":
            raise ValueError("the model doesn't put one marker before a text")

    def __missing__(self, chunk: str) -> tuple[str, str]:
        ids = self.sp.encode("\n" + chunk)
        surface = self.sp.decode(ids)[1:]
        out = ("".join([f"{i}," for i in ids[2:]]), surface)
        if len(chunk) <= CHUNK_CHARS:
            if self.chars >= TABLE_CHARS:
                self.clear()
                self.chars = 0
            self.chars += len(chunk)
            self[chunk] = out
        return out

    def text(self, text: str | None) -> tuple[str, str]:
        """The ids of a whole text, joined by commas, and the text that they decode to. A null or empty text has none."""
        if not text:
            return "", ""
        ids, surface = zip(*map(self.__getitem__, CHUNK.findall(" " + text)), strict=True)
        return "".join(ids)[:-1], "".join(surface)[1:]


def _encode(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    table = ChunkTable(path)
    for batch in batches:
        found = [table.text(t) for t in batch.column("text").to_pylist()]
        ids = pa.array([[int(i) for i in x.split(",")] if x else [] for x, _ in found], pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([*batch.columns, ids, pa.array([s for _, s in found], pa.string())], [*batch.schema.names, "ids", "decoded"])


def _digest(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    table = ChunkTable(path)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for batch in batches:
        n, ids, decoded = [], [], []
        for x in batch.column("text"):
            i, s = table.text(x.as_py())
            n.append(i.count(",") + 1 if i else 0)
            ids.append(sha(i))
            decoded.append(sha(s))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, text, ids (array of int) and decoded (the text of these ids) of each document.

    Null and empty texts have no ids and decode to the empty text. Repeated rows stay; extra columns are left out.
    """
    docs = docs.select("doc_id", "text")
    schema = "doc_id " + docs.schema["doc_id"].dataType.simpleString() + ", text string, ids array<int>, decoded string"
    return docs.mapInArrow(partial(_encode, path=path or model_path()), schema)


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """The digests of what encode() gives: doc_id, n_tokens, ids_sha256, decoded_sha256; the ids don't leave the task."""
    docs = docs.select("doc_id", F.col("text"))
    schema = "doc_id " + docs.schema["doc_id"].dataType.simpleString() + ", n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.mapInArrow(partial(_digest, path=path or model_path()), schema)


def op2_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids and the decoded text of every document; a null or empty text has 0 tokens. Repeated rows stay; other columns of the table aren't read."""
    return digests(read(spark, sf_dir, "documents"))
