"""Canonical k-mers of nucleotide sequences and their minimizers, computed for whole batches in NumPy.

A k-mer is a number, two bits a base (A 0, C 1, G 2, T 3); its canonical form is the lesser of it and its reverse
complement, so both strands have the same ones. Of every `window` k-mers in a row, the one that is least after an exclusive or with MASK is a minimizer; a sequence of
fewer k-mers has one window. Sequences that share window + k - 1 bases, on either strand, share a minimizer, while only
some 2 / (window + 1) of all k-mers are one. k-mers with other letters than ACGT (in either case) are none, and windows pass them over.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

MASK = 0x2B5C9A7E1D3F4687  # mixes the order, so that runs of A aren't always least
BLOCK = 1 << 20  # bases looked at together
CODES = np.full(256, 4, np.int64)
CODES[np.frombuffer(b"ACGTacgt", np.uint8)] = [0, 1, 2, 3, 0, 1, 2, 3]
NONE = np.int64(1 << 62)


def packed(codes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k-mer from each place on, forward and reverse complement, put together from shorter ones; NONE where it isn't whole."""
    n = len(codes)
    made = {1: (codes & 3, 3 - (codes & 3))}

    def of(size: int) -> tuple[np.ndarray, np.ndarray]:
        if size not in made:
            a, b = size // 2, size - size // 2
            (f1, r1), (f2, r2) = of(a), of(b)
            m = n - size + 1
            made[size] = (f1[:m] << 2 * b) | f2[a : a + m], (r2[a : a + m] << 2 * a) | r1[:m]
        return made[size]

    if n < k:
        return np.full(n, NONE), np.full(n, NONE)
    bad = np.append(0, np.cumsum(codes > 3))
    broken = bad[k:] != bad[:-k]
    return tuple(np.append(np.where(broken, NONE, x), np.full(k - 1, NONE)) for x in of(k))


def sliding(values: np.ndarray, width: int, f: np.ufunc, fill: int) -> np.ndarray:
    """f over each value and the width - 1 after it, by doubling."""
    out, done = values, 1
    while done < width:
        step = min(done, width - done)
        out = f(out, np.append(out[step:], np.full(min(step, len(out)), fill)))
        done += step
    return out


def select(starts: np.ndarray, lengths: np.ndarray, codes: np.ndarray, k: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, canonical k-mer, whether it is the forward one) of the minimizers; `window` bad codes stand between sequences."""
    forward, reverse = packed(codes, k)
    canonical = np.minimum(forward, reverse)
    order = np.where(canonical == NONE, NONE, canonical ^ (MASK & ((1 << 2 * k) - 1)))
    least = sliding(order, window, np.minimum, NONE)
    kmers = lengths - k + 1  # a window begins where all its k-mers lie in the sequence, or at its first k-mer
    some = kmers > 0
    ends = starts[some] + np.maximum(kmers[some] - window, 0) + 1
    begins = np.bincount(starts[some], minlength=len(codes) + 1) - np.bincount(ends, minlength=len(codes) + 1)
    least = np.where(np.cumsum(begins[:-1]) > 0, least, -1)
    best = sliding(least[::-1], window, np.maximum, -1)[::-1]  # the greatest least of the windows that hold a place
    at = np.flatnonzero((order == best) & (order != NONE))
    return at, canonical[at], forward[at] == canonical[at]


def _pieces(seqs: Iterator[tuple[int, bytes]], k: int, window: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """(row, offset, piece) up to BLOCK bases together; a longer sequence is cut so that each window lies in one piece."""
    out, n, over = [], 0, k + window - 2
    for row, seq in seqs:
        for lo in range(0, max(len(seq) - over, 1), BLOCK):
            out.append((row, lo, seq[lo : lo + BLOCK + over]))
            n += len(out[-1][2])
            if n >= BLOCK:
                yield out
                out, n = [], 0
    if out:
        yield out


def _minimizers(batches: Iterator[pa.RecordBatch], k: int, window: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = batch.select([c for c in batch.schema.names if c != "seq"])
        seqs = ((i, (s.as_py() or "").encode("ascii", "replace")) for i, s in enumerate(batch.column("seq")))
        for pieces in _pieces(seqs, k, window):
            lengths = np.array([len(p) for _, _, p in pieces])
            starts = np.cumsum(lengths + window) - lengths - window
            codes = CODES[np.frombuffer((b"\n" * window).join(p for _, _, p in pieces) + b"\n" * window, np.uint8)]
            at, kmers, forward = select(starts, lengths, codes, k, window)
            of = np.searchsorted(starts, at, side="right") - 1
            rows = np.array([r for r, _, _ in pieces])[of]
            pos = at - starts[of] + np.array([lo for _, lo, _ in pieces])[of]
            own = keys.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([*own.columns, pa.array(pos), pa.array(kmers), pa.array(forward)], [*own.schema.names, "pos", "kmer", "forward"])


def minimizers(rows: DataFrame, k: int, window: int = 1) -> DataFrame:
    """rows (..., seq) -> (..., pos, kmer, forward): the minimizers of seq, from 0; with a window of 1, all its k-mers.

    A null, empty or short sequence has none. A minimizer of two pieces of a long sequence is given twice at most.
    """
    if not 1 <= k <= 31 or window < 1:
        raise ValueError("k-mers of 1 to 31 bases fit in a number")
    keys = rows.drop("seq")
    clash = {"pos", "kmer", "forward"} & set(keys.columns)
    if clash:
        raise ValueError(f"columns of the result: {sorted(clash)}")
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in keys.schema.fields), "pos long, kmer long, forward boolean"])
    return rows.select(*keys.columns, "seq").mapInArrow(partial(_minimizers, k=k, window=window), schema)
