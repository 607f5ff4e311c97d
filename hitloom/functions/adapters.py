"""Adapters at the start of sequences within an edit budget, matched bit-parallel for whole batches in NumPy."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

NONE = np.int64(1 << 40)


def prefix_lengths(codes: np.ndarray, starts: np.ndarray, left: np.ndarray, masks: np.ndarray, m: int, errors: int) -> np.ndarray:
    """Of each sequence (its start in codes and the bases left), the length of the prefix that is the adapter; 0 if none is.

    State j has bit i set if the first i bases of the adapter match the prefix so far with j edits; a base shifts all of
    them at once. Of prefixes with equally few edits the one nearest to m counts, then the longer.
    """
    state = [np.full(len(starts), (1 << (j + 1)) - 1, np.int64) for j in range(errors + 1)]
    best = np.full(len(starts), NONE)
    for at in range(1, m + errors + 1):
        fits = masks[codes[np.minimum(starts + at - 1, len(codes) - 1)]]
        # a substitution or an insertion leaves the edits before it; a deletion then follows without a base of the read
        raw = [(state[0] << 1) & fits]
        for j in range(1, errors + 1):
            raw.append(((state[j] << 1) & fits) | state[j - 1] | (state[j - 1] << 1))
        state = []
        for j in range(errors + 1):  # up to j - i deletions after i edits
            x = raw[j]
            for i in range(j):
                x = x | (raw[i] << (j - i))
            state.append(x)
        rank = np.full(len(starts), NONE)
        for j in reversed(range(errors + 1)):
            rank[(state[j] >> m) & 1 == 1] = (j * 1000 + abs(at - m)) * 1000 + (999 - at)
        best = np.where(left >= at, np.minimum(best, rank), best)
    return np.where(best < NONE, 999 - best % 1000, 0)


def cutter(adapter: str, errors: int, times: int = 1) -> Callable[[pa.Array], pa.Array]:
    """A function of a batch's sequences: how many bases up to `times` adapters in a row take at the start, 0 for null.

    Either case matches; letters beyond ASCII match nothing.
    """
    m = len(adapter)
    masks = np.zeros(256, np.int64)
    for i, x in enumerate(adapter):
        for c in {x.upper(), x.lower()}:
            masks[ord(c)] |= 1 << (i + 1)

    def cut(seq: pa.Array) -> pa.Array:
        heads = [(s or "").encode("ascii", "replace") for s in pc.utf8_slice_codeunits(seq, 0, times * (m + errors)).to_pylist()]
        left = np.array([len(s) for s in heads], np.int64)
        starts = np.cumsum(left) - left
        codes = np.frombuffer(b"".join(heads) + b"\n", np.uint8)
        done, rows = np.zeros(len(heads), np.int64), np.arange(len(heads))
        for _ in range(times):
            n = prefix_lengths(codes, starts[rows] + done[rows], left[rows] - done[rows], masks, m, errors)
            done[rows] += n
            rows = rows[n > 0]
            if not len(rows):
                break
        return pa.array(done.astype(np.int32))

    return cut
