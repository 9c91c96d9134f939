"""Runs of letters in many texts at once: their bytes, hashes, and which of them are equal (by their bytes)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from capplan.llm.common import Words

#: A-Z as a-z, by byte.
LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], dtype=np.uint8)


class Runs(Words):
    """Words by another rule for their bytes (``member``); equal runs are told by their bytes, not by hashes."""

    def __init__(self, texts: pa.Array):
        super().__init__(texts)
        self.bytes = LOWER[self.data]

    def text(self, k: int) -> np.ndarray:
        """The number of the text that holds run k (or each of some)."""
        return np.searchsorted(self.bounds, k, side="right") - 1

    def owners(self) -> np.ndarray:
        """The number of the text of every run."""
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))

    def raw(self, k: int) -> bytes:
        return self.bytes[self.starts[k] : self.ends[k]].tobytes()

    def pick(self, some: np.ndarray) -> pa.Array:
        """The bytes of some runs."""
        return self.all().take(pa.array(some)).cast(pa.binary())

    def all(self) -> pa.Array:
        """The bytes of all runs."""
        # nothing but runs consists of member bytes, so these are all runs one after the other
        data = self.bytes[self.member(self.data)]
        offsets = np.concatenate([[0], np.cumsum(self.ends - self.starts)])
        return pa.Array.from_buffers(pa.large_binary(), len(self.starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """The first run of each different one, and for each run the number of it among those."""
        number = self.all().dictionary_encode().indices.to_numpy().astype(np.int64)
        new = np.ones(len(number), dtype=bool)
        new[1:] = number[1:] > np.maximum.accumulate(number)[:-1]
        return np.flatnonzero(new), number


class Terms(Runs):
    """Maximal runs of ASCII letters and code points from 128 on."""

    @staticmethod
    def member(data: np.ndarray) -> np.ndarray:
        return _IS_TERM[data]


_IS_TERM = np.array([65 <= c <= 90 or 97 <= c <= 122 or c >= 128 for c in range(256)])


class Latin(Runs):
    """Maximal runs of ASCII letters and U+00C0 to U+00FF (in UTF-8: byte C3 and the byte after it)."""

    @staticmethod
    def member(data: np.ndarray) -> np.ndarray:
        out = _IS_LATIN[data]
        out[1:] |= (data[:-1] == 0xC3) & (data[1:] >= 128)
        return out


_IS_LATIN = np.array([65 <= c <= 90 or 97 <= c <= 122 or c == 0xC3 for c in range(256)])
