"""Helpers shared by the operators: written intermediate tables and vectorised text batches."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from addrweave.session import remove_scratch, scratch_path

# Words of every operator: runs of anything but the six ASCII white-space characters.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

# Text worked on at once by the vectorised helpers (several times this is held as 64-bit arrays).
CHUNK_BYTES = 2 << 20


_PASSING: ContextVar[list[str] | None] = ContextVar("passing", default=None)  # tables to delete at the end of ``passing``


def cut(df: DataFrame, name: str, stays: bool = False) -> DataFrame:
    """Write ``df`` into the shared checkpoint folder and read it back: later steps restart from
    these files, not from the work before, when executors are lost. Texts take a third less of the folder with zstd."""
    path = scratch_path(df.sparkSession, name)
    made = _PASSING.get()
    if made is not None and not stays:
        made.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Tables that are cut inside are deleted at the end, but those that ``stays`` names: nothing that is read later may be
    planned over the others."""
    made: list[str] = []
    token = _PASSING.set(made)
    try:
        yield
    finally:
        _PASSING.reset(token)
        for path in made:
            remove_scratch(spark, path)


def release() -> None:
    """Give freed memory back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


_KEPT: dict[tuple[str, str], object] = {}  # tables that a worker keeps between the tasks of one operator


def kept(operator: str, name: str, make):
    """The operator's table of this name, made once in a worker."""
    if (operator, name) not in _KEPT:
        _KEPT[operator, name] = make()
    return _KEPT[operator, name]


def give_up(but: str | None = None) -> None:
    """Free the tables of all operators but one."""
    others = [k for k in _KEPT if k[0] != but]
    for k in others:
        del _KEPT[k]
    if others:
        gc.collect()
        release()


def tidy(run, operator: str | None = None):
    """``run`` for mapInArrow or mapInPandas, with memory given back at the end: Python workers live on between tasks,
    beside others and the JVM of their executor. Tables that another ``operator`` keeps in the worker are freed first."""

    def clean(batches: Iterator) -> Iterator:
        give_up(operator)
        try:
            yield from run(batches)
        finally:
            release()

    return clean


class Texts:
    """UTF-8 bytes of a run of texts: ``buf`` (padded by 64 zero bytes) and text i at offs[i]:offs[i+1]."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray):
        self.buf, self.offs = buf, offs

    def __len__(self) -> int:
        return len(self.offs) - 1


def text_chunks(column: pa.Array | pa.ChunkedArray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, Texts]]:
    """Split a string or binary column into (first row, end row, Texts) of about ``limit`` bytes; a null is an empty
    text, and a text longer than the limit comes alone and whole."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    n = len(column)
    if not n:
        return
    offs = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, side="right")) - 1)
        buf = np.zeros(offs[j] - offs[i] + 64, np.uint8)
        buf[:-64] = data[offs[i] : offs[j]]
        yield i, j, Texts(buf, offs[i : j + 1] - offs[i])
        i = j


def lower_ascii(t: Texts) -> Texts:
    """A-Z lower-cased, every other byte as it is."""
    return Texts(_LOWER[t.buf], t.offs)


def word_spans(t: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of all texts: (start, length, number of words of each text)."""
    n = int(t.offs[-1])
    ink = ~_SPACE[t.buf[:n]]
    first = np.zeros(n + 1, bool)
    first[t.offs] = True
    start = np.flatnonzero(ink & (first[:n] | np.r_[True, ~ink[:-1]][:n]))
    end = np.flatnonzero(ink & (first[1:] | np.r_[~ink[1:], True][:n])) + 1
    return start, end - start, np.diff(np.searchsorted(start, t.offs))


_U = np.uint64


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (bijective), element by element."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def hash_spans(buf: np.ndarray, start: np.ndarray, length: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of byte spans of a padded buffer, eight bytes of all spans at a time."""
    eight = np.ndarray((len(buf) - 7,), "<u8", buffer=buf, strides=(1,))
    mask = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)
    h = mix64(length.astype(np.uint64) + _U((seed * 0x9E3779B97F4A7C15 + 0x1234567) & (2**64 - 1)))
    live, at, left = np.arange(len(start)), start, length
    if len(start) and not (left > 0).all():
        live = np.flatnonzero(left > 0)
        at, left = at[live], left[live]
    while len(live):
        h[live] = mix64(h[live] * _U(0x9E3779B97F4A7C15) + (eight[at] & mask[np.minimum(left, 8)]))
        more = np.flatnonzero(left > 8)
        live, at, left = live[more], at[more] + 8, left[more] - 8
    return h


def runs(sorted_keys: np.ndarray) -> np.ndarray:
    """First index of each run of equal values in a sorted array."""
    if not len(sorted_keys):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.r_[True, sorted_keys[1:] != sorted_keys[:-1]])


def shared_file(path: str):
    """(file system, path in it) for a file in the shared folder, for use inside tasks: a mounted folder
    (``file:`` or a plain path) or a store that Arrow's file systems reach (hdfs, s3, gs, abfs)."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if "://" not in path:
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def write_shared(path: str, parts: list) -> int:
    """Write the buffers one after the other as a new file of the shared folder; returns its size."""
    system, at = shared_file(path)
    system.create_dir(at.rsplit("/", 1)[0], recursive=True)
    with system.open_output_stream(at) as out:
        for p in parts:
            out.write(memoryview(np.ascontiguousarray(p)).cast("B") if isinstance(p, np.ndarray) else p)
        return out.tell()


def read_shared(path: str, start: int = 0, size: int | None = None) -> np.ndarray:
    """Bytes of a file of the shared folder, or a part: mapped into memory if the folder is mounted, else read."""
    from pyarrow import fs

    system, at = shared_file(path)
    if isinstance(system, fs.LocalFileSystem):
        whole = system.get_file_info(at).size - start
        return np.memmap(at, np.uint8, "r", start, whole if size is None else size) if whole else np.zeros(0, np.uint8)
    with system.open_input_file(at) as src:
        return np.frombuffer(src.read_at(src.size() - start if size is None else size, start), np.uint8)


def among(x: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Which of x are in the sorted array ``found``."""
    if not len(found):
        return np.zeros(len(x), bool)
    return found[np.minimum(np.searchsorted(found, x), len(found) - 1)] == x


def pack(**columns: np.ndarray) -> bytes:
    """Columns as compressed bytes: one row of a shuffle carries many values."""
    out = pa.BufferOutputStream()
    batch = pa.record_batch({k: pa.array(v) for k, v in columns.items()})
    with pa.ipc.new_stream(out, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_batch(batch)
    return out.getvalue().to_pybytes()


def unpack(blobs) -> dict[str, np.ndarray]:
    """Columns of all blobs one after the other; ``__size`` has the rows of each."""
    parts = [pa.ipc.open_stream(b).read_all() for b in blobs]
    if not parts:
        return {}
    t = pa.concat_tables(parts)
    return {c: t.column(c).to_numpy() for c in t.column_names} | {"__size": np.array([p.num_rows for p in parts])}


def deal(key: np.ndarray, tasks: int) -> Iterator[tuple[int, np.ndarray]]:
    """Rows of each of ``tasks`` tasks, by the upper bits of hashed keys."""
    task = ((key >> _U(32)) * _U(tasks)) >> _U(32)
    order = np.argsort(task, kind="stable")
    at = runs(task[order])
    for a, b in zip(at, [*at[1:], len(order)]):
        yield int(task[order[a]]), order[a:b]
