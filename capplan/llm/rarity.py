"""A fixed-size count of hashes over a whole table, to order hashes from rare to frequent.

Any order that all tasks share keeps prefix filters exact; this one keeps what is frequent out of the
prefixes. Counts are kept per bucket of hashes, so their size does not depend on the data: rare hashes in
one bucket share their counts, and frequent ones stand out from them.
"""

from __future__ import annotations

import zlib

import numpy as np

#: Buckets, and the slices in which counts travel (rows of about this many bytes, before compression).
BITS = 20
SLICES = 16

COUNTS = "slice int, counts binary"


class Counter:
    """Counts of one task."""

    def __init__(self):
        self.counts = np.zeros(1 << BITS, dtype=np.int64)

    def add(self, hashes: np.ndarray) -> None:
        self.counts += np.bincount((hashes >> np.uint64(64 - BITS)).astype(np.int64), minlength=1 << BITS)

    def rows(self) -> list[tuple[int, bytes]]:
        return [(i, zlib.compress(s.tobytes(), 1)) for i, s in enumerate(np.split(self.counts, SLICES))]


def total(rows: list[tuple[int, bytes]]) -> np.ndarray:
    """The sum of slices; all slices of a table together have ``8 << BITS`` bytes, however large the table."""
    out = np.zeros((SLICES, (1 << BITS) // SLICES), dtype=np.int64)
    for number, raw in rows:
        out[number] += np.frombuffer(zlib.decompress(raw), dtype=np.int64)
    return out.reshape(-1)


def levels(counts: np.ndarray) -> np.ndarray:
    """One byte per bucket: eight steps for each doubling of its count."""
    return np.minimum(255, np.log2(np.maximum(counts, 1)) * 8).astype(np.uint8)


def ranked(hashes: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """The hashes with their level as the top byte: smaller is rarer; 56 bits of the hash stay."""
    bucket = (hashes >> np.uint64(64 - BITS)).astype(np.int64)
    return (steps[bucket].astype(np.uint64) << np.uint64(56)) | (hashes & np.uint64((1 << 56) - 1))


def summed(counted):
    """Counts of a whole table, from the rows (``slice``, ``counts``) of its tasks.

    Slices are added up by the executors first, so the driver gets one row per slice.
    """
    import pyarrow as pa

    def add(rows: pa.Table) -> pa.Table:
        number = rows.column("slice")[0].as_py()
        whole = np.zeros((1 << BITS) // SLICES, dtype=np.int64)
        for raw in rows.column("counts"):
            whole += np.frombuffer(zlib.decompress(raw.as_py()), dtype=np.int64)
        return pa.table({"slice": pa.array([number], pa.int32()), "counts": pa.array([zlib.compress(whole.tobytes(), 1)])})

    return total([tuple(r) for r in counted.groupBy("slice").applyInArrow(add, COUNTS).collect()])
