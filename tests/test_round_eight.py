"""What the findings of the fourth round were about, on small tables."""

import gzip
import os
from xml.etree import ElementTree

import pyarrow as pa
import pytest

from hitloom.plans import q_sources

DATA = "/root/testdata/sf0.001"


def test_documents_are_whole_and_of_a_size():
    for batches in ([], [0], [3], [4], [2, 3], [4, 4, 1], [0, 11, 0, 1]):
        rows = [f"<x>{i}</x>" for i in range(sum(batches))]
        ends = [sum(batches[:i]) for i in range(len(batches) + 1)]
        given = (pa.RecordBatch.from_arrays([pa.array(rows[lo:hi], pa.string())], ["value"]) for lo, hi in zip(ends, ends[1:]))
        lines = [v for b in q_sources._documents(given, 6) for v in b.column("value").to_pylist()]
        documents = [lines[i : i + 6] for i in range(0, len(lines), 6)]
        assert len(documents) == max(1, -(-len(rows) // 4))
        assert [f"<x>{x.text}</x>" for d in documents for x in ElementTree.fromstring("".join(d)).iter("x")] == rows


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables here")
def test_blast_xml_takes_a_tenth_of_its_text_on_disk(spark, tmp_path, monkeypatch):
    path, size = tmp_path / "xml", 1000
    monkeypatch.setattr(q_sources, "folder", lambda session: str(path))
    monkeypatch.setattr(q_sources, "DOCUMENT", size, raising=False)
    n = spark.read.parquet(f"{DATA}/lineitem.parquet").count()
    assert q_sources.source_blast_xml(spark, DATA).count() == n
    files = sorted(path.glob("part-*"))
    texts = [(gzip.decompress(f.read_bytes()) if f.suffix == ".gz" else f.read_bytes()).decode() for f in files]
    assert sum(f.stat().st_size for f in files) * 10 < sum(len(t) for t in texts)
    assert max(t.count("\n") for t in texts) <= size
    assert sum(len(ElementTree.fromstring(t).findall("BlastOutput_iterations/Iteration")) for t in texts) == n
