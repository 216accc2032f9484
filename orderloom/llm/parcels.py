"""Records of many documents sent through a shuffle as one row per task's chunk and bucket."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from orderloom.llm import kernels as K

#: Text that a task gathers before it sends.
GATHER_BYTES = 4 << 20


def planes(values: np.ndarray) -> bytes:
    """First bytes of all values, then their second bytes, and so on: the high bytes of small numbers are runs, which
    the compression of shuffles takes away."""
    return np.ascontiguousarray(values).view("u1").reshape(len(values), values.itemsize).T.tobytes()


def from_planes(raw: bytes, kind: np.dtype) -> np.ndarray:
    kind = np.dtype(kind)
    return np.ascontiguousarray(np.frombuffer(raw, "u1").reshape(kind.itemsize, -1).T).view(kind).ravel()


def packed(records: np.ndarray) -> bytes:
    """Column after column, each in planes."""
    return b"".join(planes(records[n]) for n in records.dtype.names)


def unpacked(raw: bytes, kind: np.dtype) -> np.ndarray:
    n, at = len(raw) // kind.itemsize, 0
    out = np.empty(n, kind)
    for name in kind.names:
        size = n * kind[name].itemsize
        out[name] = from_planes(raw[at : at + size], kind[name])
        at += size
    return out


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Chunks joined to about GATHER_BYTES of text and at most 65,535 documents."""
    held, size, rows = [], 0, 0
    for batch in K.chunks(batches, "text"):
        if held and (size > GATHER_BYTES or rows + batch.num_rows > 65_535):
            yield pa.Table.from_batches(held)
            held, size, rows = [], 0, 0
        for part in (batch.slice(i, 60_000) for i in range(0, batch.num_rows, 60_000)):
            held.append(part)
            size, rows = size + part.nbytes, rows + part.num_rows
    if held:
        yield pa.Table.from_batches(held)
