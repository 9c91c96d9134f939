"""What the text operators share: reading tables, cutting lineage, word rules, Arrow helpers."""

from __future__ import annotations

import ctypes
import os
import shutil
import tempfile
from collections.abc import Callable, Iterator
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word rules: space and the controls from tab to carriage return.
SPACES = "[ \\t\\n\\x0B\\f\\r]+"

#: Prefix of columns that an operator adds beside columns of its caller.
OWN = "__llm_"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, or one made where it is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoints-"))
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Computes ``df`` once into the shared folder; what follows reads that copy."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def ship(spark: SparkSession) -> None:
    """Sends this library to the executors once per context, for where it isn't installed."""
    context, package = spark.sparkContext, Path(__file__).resolve().parents[1]
    name = f"{package.name}-{os.getpid()}"
    if any(f"{name}.zip" in f for f in context.listFiles):
        return
    made = shutil.make_archive(str(Path(tempfile.mkdtemp(), name)), "zip", package.parent, package.name)
    context.addPyFile(made)


def only(df: DataFrame, *names: str) -> DataFrame:
    """The named columns alone, so that further columns of any name do no harm."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def released(task: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A task over batches that gives back to the system what it has freed.

    Workers are used again and wait beside the JVM of their executor, several for each of its cores.
    """

    def run(batches: Iterator) -> Iterator:
        yield from task(batches)
        release()

    return run


def release() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def map_arrow(
    df: DataFrame,
    build: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch | Iterator[pa.RecordBatch] | None]],
    schema: str,
) -> DataFrame:
    """Maps Arrow batches; ``build`` runs once per task and returns the function for a batch, which may give several."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = build()
        for batch in batches:
            if batch.num_rows:
                out = step(batch)
                for part in [out] if out is None or isinstance(out, pa.RecordBatch) else out:
                    if part is not None and part.num_rows:
                        yield part

    ship(df.sparkSession)
    return df.mapInArrow(released(task), schema)


def squeezed(
    texts: DataFrame, *keep: str, some: Callable[[pa.RecordBatch], np.ndarray] | None = None
) -> DataFrame:
    """The columns ``keep`` and ``text`` compressed, for texts that have to cross the network whole.

    With ``some`` only the rows that it marks, told before anything is compressed.
    """
    fields = [texts.schema[c] for c in keep]

    def build():
        squeeze = zstandard.ZstdCompressor(level=3).compress

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            batch = batch if some is None else batch.filter(pa.array(some(batch)))
            raw = pa.array([squeeze((t or "").encode()) for t in batch.column("text").to_pylist()], pa.binary())
            return pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], raw], names=[*keep, "text"])

        return step

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in fields], "text binary"])
    return map_arrow(texts.select(*keep, "text"), build, schema)


def expanded(batch: pa.RecordBatch, some: int = 1024) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of squeezed texts, with the texts whole again."""
    expand = zstandard.ZstdDecompressor().decompress
    at = batch.schema.get_field_index("text")
    for start in range(0, batch.num_rows, some):
        part = batch.slice(start, some)
        texts = pa.array([expand(t).decode() for t in part.column(at).to_pylist()], pa.large_string())
        yield part.set_column(at, "text", texts)


def blocks(batch: pa.RecordBatch, column: str = "text", limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts have about ``limit`` bytes together, a longer text alone."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
    group = np.cumsum(sizes) // limit
    edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for start, end in zip(edges[:-1], edges[1:], strict=True):
        if end > start:
            yield batch.slice(start, end - start)


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts one after the other, and where each begins and the last ends."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if texts.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


_IS_WORD = np.array([c != 32 and not 9 <= c <= 13 for c in range(256)])
_FOLD = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], dtype=np.uint64)
_STEP = 0x9E3779B97F4A7C13  # 3 modulo 8, so that differences of its powers keep few factors of 2
_CHUNK = 1 << 19


@cache
def _powers(first: int, n: int) -> np.ndarray:
    out = np.full(n, first, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Words:
    """All words of some texts: maximal runs without ASCII white space, A-Z hashed as a-z.

    ``hashes`` has a 64-bit hash per word, ``starts`` and ``ends`` its bytes, ``bounds`` the number of the
    first word of each text and, last, of all words. With ``lines`` a text is each line of the given ones,
    and ``line_of`` is the number of the first line of each given text.
    """

    def __init__(self, texts: pa.Array, lines: bool = False):
        self.data, offsets = _bytes(texts)
        if lines:
            breaks = np.flatnonzero(self.data == 10) + 1
            firsts = np.searchsorted(breaks, offsets[:-1], side="right") + np.arange(len(offsets) - 1)
            offsets = np.sort(np.concatenate([offsets[:-1], breaks[breaks < 1 << 62], offsets[-1:]]))
            self.line_of = np.append(firsts, len(offsets) - 1)
        self.offsets = offsets
        inside = np.concatenate([[False], self.member(self.data), [False]])
        cut = np.zeros(len(self.data) + 1, dtype=bool)
        cut[offsets] = True
        self.starts = np.flatnonzero(inside[1:] & (~inside[:-1] | cut))
        self.ends = np.flatnonzero(inside[:-1] & (~inside[1:] | cut))
        self.bounds = np.searchsorted(self.starts, offsets)
        self.hashes = self._hash()

    @staticmethod
    def member(data: np.ndarray) -> np.ndarray:
        """Which bytes belong to words; other kinds of words have another rule."""
        return _IS_WORD[data]

    def _hash(self) -> np.ndarray:
        table = scramble(_FOLD + np.uint64(1))
        ups, downs = _powers(_STEP, 2 * _CHUNK), _powers(pow(_STEP, -1, 1 << 64), 2 * _CHUNK)
        out = np.zeros(len(self.starts), dtype=np.uint64)
        k = 0
        while k < len(out):
            first = self.starts[k]
            stop = max(k + 1, int(np.searchsorted(self.ends, first + _CHUNK, side="right")))
            part = table[self.data[first : self.ends[stop - 1]]]
            if len(part) > len(ups):  # one word longer than a chunk
                out[k] = (part * _powers.__wrapped__(_STEP, len(part))).sum(dtype=np.uint64)
            else:
                total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(part * ups[: len(part)])])
                s, e = self.starts[k:stop] - first, self.ends[k:stop] - first
                out[k:stop] = (total[e] - total[s]) * downs[s]
            k = stop
        return scramble(out + (self.ends - self.starts).astype(np.uint64))


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of two (order matters)."""
    x = (a * np.uint64(0x9E3779B97F4A7C15)) ^ (b + np.uint64(0x7F4A7C159E3779B9) + (a << np.uint64(6)))
    return scramble(x)


def scramble(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values evenly (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
