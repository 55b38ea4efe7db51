"""Removal of passages that documents share, byte-exact, by refining buckets of suffixes.

A suffix starts in the bucket of its first q = 16 bytes. Buckets are refined on bucket identifiers of later
offsets, with the refined ones used again: identifiers of 16 bytes at i and i + 16 give those of 32, these at i and
i + 18 those of 50, the length of a match. An identifier is a hash of the bytes it stands for, so that it means the
same in every task; what is 64 bits wide and equal is taken as equal.

Only some suffixes need to meet others. Of the 35 q-gram buckets that begin in a 50-byte window one is the smallest
(by identifier, then the leftmost), and equal windows have equal ones: it is the window's *pointer*. Neighbouring
windows mostly share it. Such a run of windows, a *span*, is dealt out to a task by its pointer's bucket:

1. Spans that are equal in all bytes: all but those of the smallest document are covered whole.
2. Different spans in one bucket are refined by the 32 bytes ending or beginning with the pointer's 16, one of which
   any shared window must have in common. What remains shared stays open; a span alone in its bucket is done.
3. The windows of open spans are refined to 50 bytes and meet by that identifier; all but those of
   the smallest document are covered.

A task combines equal spans and windows of its unit (some MB of text) before they travel. A bucket that holds more
than ``HOT`` different spans in any unit is skipped at step 2: its windows go to step 3 at once, where they are
equal (and combined) or spread out. Texts are written to the shared folder once, as units that the steps read by
reference; between the steps travel only identifiers and smallest documents.

Defined results: a null text is an empty one; texts of less than 50 bytes keep all; a text of any length is one row of one task,
which holds a few 64-bit values for each of its bytes; a null id counts as larger than any
other; rows that repeat an id remove nothing from each other; an empty table gives an empty result. A character
of which a part is removed is dropped from the text (``kept`` has the bytes as they are). Other columns pass through.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from addrweave.llm.shared import Texts, among, cut, deal, mix64, pack, read_shared, runs, text_chunks, tidy, unpack, write_shared
from addrweave.session import scratch_path

MATCH, Q = 50, 16
REACH = MATCH - Q  # furthest that a pointer stands from its window's start
UNIT_BYTES = 8 << 20  # text of a unit
CHUNK = 1 << 18  # text worked on at once: some dozen arrays of 64-bit values for its bytes are held
LONG = 32 << 20  # a longer text is taken in pieces of this size (below 2 ** _PLACE bytes)
HOT = 256  # different spans of one bucket in a unit, from which on its windows are compared at once
_U = np.uint64
_PLACE = 28  # bits for a place in a chunk; the others order the q-grams
_BYTE = mix64(np.arange(256, dtype=np.uint64) + _U(0x51ED2701))
_NO_ID = np.iinfo(np.int64).max


def _refine(a: np.ndarray, later: int) -> np.ndarray:
    """Bucket identifiers refined by those ``later`` bytes on."""
    x = a[: len(a) - later] * _U(0x9E3779B97F4A7C15 + 2 * later) + a[later:]
    x ^= x >> _U(29)
    return x


class Spans:
    """Runs of windows with one pointer, of a chunk of texts. Arrays by span: ``doc`` (row), ``first`` and ``last``
    (window starts), ``bucket``, ``name`` (of all its bytes), ``left`` and ``right`` (short identifiers of the 32 bytes
    that end or begin with the pointer's; 0 if no window has them); ``window`` by place."""

    def __init__(self, t: Texts):
        n = int(t.offs[-1])
        g = _BYTE[t.buf]
        for k in (1, 2, 4, 8):
            g = _refine(g, k)
        g16 = g
        g32 = _refine(g16, 16)
        self.window = _refine(g32, 18)
        low = (g16 >> _U(_PLACE)) << _U(_PLACE)
        low |= np.arange(len(low), dtype=np.uint64)
        for k in (1, 2, 4, 8, 16, 3):  # smallest of 35
            low = np.minimum(low[: len(low) - k], low[k:])
        start = np.flatnonzero(np.repeat(t.offs[1:], np.diff(t.offs)) - np.arange(n) >= MATCH)
        place = (low[start] & _U((1 << _PLACE) - 1)).astype(np.int64)
        at = runs(place)
        p = place[at]
        self.first, self.last = start[at], start[np.r_[at[1:] - 1, len(start) - 1]] if len(at) else start[at]
        self.doc = np.searchsorted(t.offs, self.first, "right") - 1
        key = mix64(g16[p])
        self.task_key, self.bucket = key, key.astype(np.uint32)  # upper bits choose the task, lower ones the bucket in it
        length = (self.last - self.first).astype(np.uint64)
        self.name = mix64(self.window[self.first] * _U(0xD6E8FEB86659FD93) + mix64(self.window[self.last] + length))
        short = lambda g: (mix64(g) % _U(255) + _U(1)).astype(np.uint8)
        self.left = np.where(self.first <= p - Q, short(g32[np.maximum(p - Q, 0)]), 0).astype(np.uint8)
        self.right = np.where(self.last > p - Q, short(g32[p]), 0).astype(np.uint8)

    @classmethod
    def of(cls, t: Texts) -> Spans:
        """Spans of a chunk; a text longer than ``LONG`` is taken in pieces that overlap by a window less a byte, so that each
        window lies whole in one. A span that a piece's end divides is two: different spans of one bucket, as any others."""
        n = int(t.offs[-1])
        if n <= LONG:
            return cls(t)
        out, parts = cls.__new__(cls), []
        for a in range(0, n, LONG):
            b = min(a + LONG + MATCH - 1, n)
            buf = np.zeros(b - a + 64, np.uint8)
            buf[:-64] = t.buf[a:b]
            part = cls(Texts(buf, np.array([0, b - a])))
            part.first, part.last, part.window = part.first + a, part.last + a, part.window[: min(LONG, b - a)]
            parts.append(part)
        for name in vars(parts[0]):
            setattr(out, name, np.concatenate([getattr(p, name) for p in parts]))
        return out

    def among(self, open_names: np.ndarray, hot: np.ndarray) -> np.ndarray:
        """Spans that are open or in a hot bucket."""
        return np.flatnonzero(among(self.name, open_names) | among(self.bucket, hot))

    def windows(self, spans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of all windows of the given spans, and the span of each."""
        size = self.last[spans] - self.first[spans] + 1
        of = np.repeat(spans, size)
        return np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size) + self.first[of], of


def _least_by(key: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, the smallest document of each, and a row that holds it."""
    order = np.lexsort((doc, key))
    first = order[runs(key[order])]
    return key[first], doc[first], first


class Unit:
    """Some rows of the table, as written: chunks of texts with the ids of their rows."""

    def __init__(self, file: str, start: int, size: int, id_col: str, text_col: str):
        raw = read_shared(file, start, size)
        self.table = pa.ipc.open_stream(pa.py_buffer(raw)).read_all()
        ids = self.table.column(id_col).cast(pa.int64())
        self.ids = ids.fill_null(_NO_ID).to_numpy()
        self.text = self.table.column(text_col)

    def chunks(self) -> Iterator[tuple[int, int, Texts, Spans]]:
        for i, j, t in text_chunks(self.text, CHUNK):
            yield i, j, t, Spans.of(t)

    def spans(self) -> dict[str, np.ndarray]:
        """Distinct spans with their smallest documents."""
        found = [(s.task_key, s.name, s.left, s.right, self.ids[i:j][s.doc]) for i, j, _, s in self.chunks()]
        key, name, left, right, doc = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, d) for d in "QQBBq")
        name, doc, row = _least_by(name, doc)
        return {"key": key[row], "name": name, "left": left[row], "right": right[row], "doc": doc}

    def open_windows(self, open_names: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct windows of open spans with their smallest documents."""
        key, doc = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for i, j, _, s in self.chunks():
            start, of = s.windows(s.among(open_names, hot))
            key.append(s.window[start])
            doc.append(self.ids[i:j][s.doc[of]])
        return _least_by(np.concatenate(key), np.concatenate(doc))[:2]


def _owner(x: np.ndarray, key: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Smallest document of each x by a sorted table, or no id."""
    if not len(key):
        return np.full(len(x), _NO_ID)
    at = np.minimum(np.searchsorted(key, x), len(key) - 1)
    return np.where(key[at] == x, doc[at], _NO_ID)


def _store(docs: DataFrame, text_col: str) -> DataFrame:
    """Write the rows as units into the shared folder: unit, file, start, size."""
    folder = scratch_path(docs.sparkSession, "units")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def flush() -> pa.RecordBatch:
            out = pa.BufferOutputStream()
            with pa.ipc.new_stream(out, held[0].schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))) as w:
                for b in held:
                    w.write_batch(b)
            name = f"{folder}/unit-{uuid.uuid4().hex}.arrow"
            n = write_shared(name, [out.getvalue()])
            return pa.RecordBatch.from_pydict({"file": [name], "start": [0], "size": [n]}, schema=pa.schema([("file", pa.string()), ("start", pa.int64()), ("size", pa.int64())]))

        for batch in batches:
            for i, j, t in text_chunks(batch.column(batch.schema.get_field_index(text_col)), CHUNK):
                held.append(batch.slice(i, j - i))
                size += int(t.offs[-1])
                if size >= UNIT_BYTES:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    files = cut(docs.mapInArrow(tidy(run), "file string, start bigint, size bigint"), "unit-files")
    # one row for each unit: numbers without gaps, by which units are dealt out one to a task
    return cut(files.withColumn("unit", F.row_number().over(Window.orderBy("file")).cast("bigint") - 1), "units")


def _send(units: DataFrame, work, tasks: int) -> DataFrame:
    """Rows (task, unit, blob) that ``work(unit row)`` gives as (key, columns)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for t in frames:
            for row in t.itertuples(index=False):
                key, columns = work(row)
                out = [(task, row.unit, pack(**{k: v[of] for k, v in columns.items()})) for task, of in deal(key, tasks)]
                yield pd.DataFrame(out, columns=["task", "unit", "blob"])

    return units.mapInPandas(tidy(run), "task int, unit bigint, blob binary").repartitionById(tasks, "task")


def _meet(sent: DataFrame, resolve) -> DataFrame:
    """Blobs (unit, kind, blob) that ``resolve(columns, unit of each row)`` gives as {kind: (rows, columns)}, all rows
    of one task together."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = [t[["unit", "blob"]] for t in frames if len(t)]
        if not got:
            return
        t = pd.concat(got)
        columns = unpack(t.blob)
        unit = np.repeat(t.unit.to_numpy(), columns.pop("__size"))
        del t, got
        for kind, (rows, give) in resolve(columns, unit).items():
            rows = rows[np.argsort(unit[rows], kind="stable")]
            at = runs(unit[rows])
            out = [(unit[rows[a]], kind, pack(**{k: v[rows[a:b]] for k, v in give.items()})) for a, b in zip(at, [*at[1:], len(rows)])]
            yield pd.DataFrame(out, columns=["unit", "kind", "blob"])

    return sent.mapInPandas(tidy(run), "unit bigint, kind string, blob binary")


def _resolve_spans(c: dict[str, np.ndarray], unit: np.ndarray) -> dict:
    """Steps 1 and 2: spans with a smaller owner, open spans, and buckets that are hot."""
    bucket, name, left, right, doc = (c[k] for k in ("bucket", "name", "left", "right", "doc"))
    marker = left == 255  # a unit that holds too many spans of this bucket
    hot = np.unique(bucket[marker])
    in_hot = among(bucket, hot)
    rows = np.flatnonzero(~marker)
    order = rows[np.lexsort((doc[rows], name[rows], bucket[rows]))]
    at = runs(name[order])
    size = np.diff(np.r_[at, len(order)])
    owner = np.full(len(doc), _NO_ID)
    owner[order] = np.repeat(doc[order[at]], size)
    of = np.zeros(len(doc), np.int64)
    of[order] = np.repeat(np.arange(len(at)), size)
    rep = order[at]
    rep = rep[~in_hot[rep]]
    shared = np.zeros(len(doc), bool)
    for side in (left, right):
        k = rep[side[rep] > 0]
        k = k[np.lexsort((doc[k], side[k], bucket[k]))]
        if not len(k):
            continue
        new = np.r_[True, (bucket[k][1:] != bucket[k][:-1]) | (side[k][1:] != side[k][:-1])]
        first = np.flatnonzero(new)
        last = np.r_[first[1:] - 1, len(k) - 1]
        several = doc[k[first]] != doc[k[last]]
        shared[k[np.repeat(several, last - first + 1)]] = True
    # a span shared by a smaller document is open in that one's row only; rows that repeat an id are equal in this
    opened = np.zeros(len(at), bool)
    opened[of[shared]] = True
    is_open = ~marker & ~in_hot & opened[of] & (doc == owner)
    covered = np.flatnonzero(~marker & (doc > owner))
    return {"covered": (covered, {"name": name, "doc": owner}), "open": (np.flatnonzero(is_open), {"name": name}), "hot": (np.flatnonzero(in_hot), {"bucket": bucket})}


def _resolve_windows(c: dict[str, np.ndarray], unit: np.ndarray) -> dict:
    """Step 3: windows with a smaller owner."""
    key, doc = c["window"], c["doc"]
    order = np.lexsort((doc, key))
    at = runs(key[order])
    owner = np.empty(len(doc), np.int64)
    owner[order] = np.repeat(doc[order[at]], np.diff(np.r_[at, len(order)]))
    return {"window": (np.flatnonzero(doc > owner), {"name": key, "doc": owner})}


def _status(units: DataFrame, *found: DataFrame) -> DataFrame:
    """Units with what was found for each, as an array of (kind, blob)."""
    rows = found[0]
    for f in found[1:]:
        rows = rows.unionByName(f)
    of = rows.groupBy("unit").agg(F.collect_list(F.struct("kind", "blob")).alias("status"))
    return units.join(of, "unit", "left")


def _of(status, kind: str, *names: str) -> list[np.ndarray]:
    got = unpack([x["blob"] for x in status if x["kind"] == kind] if status is not None else [])
    if not got:
        return [np.zeros(0, np.int64 if n == "doc" else np.uint64) for n in names]
    order = np.argsort(got[names[0]], kind="stable")
    return [got[n][order] for n in names]


def remove_shared(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """All rows with their other columns, ``text_col`` without the bytes that a 50-byte string shared with a smaller id
    covers, and n_bytes, n_removed, n_spans (maximal removed runs), kept (binary: the remaining bytes). Columns of these
    names in the input are replaced."""
    spark = docs.sparkSession
    added = {"n_bytes": T.LongType(), "n_removed": T.LongType(), "n_spans": T.LongType(), "kept": T.BinaryType()}
    docs = docs.drop(*added)
    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    units = _store(docs, text_col)
    n_units = max(1, units.count())

    def dealt(d: DataFrame) -> DataFrame:
        return d.repartitionById(n_units, F.col("unit").cast("int"))  # a unit is much work for a small row

    def send_spans(row) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        s = Unit(row.file, row.start, row.size, id_col, text_col).spans()
        order = np.argsort(s["key"], kind="stable")
        at = runs(s["key"][order])
        size = np.diff(np.r_[at, len(order)])
        many = np.zeros(len(order), bool)
        many[order] = np.repeat(size > hot, size)
        marks = order[at[size > hot]]
        keep = np.r_[np.flatnonzero(~many), marks]
        s = {k: v[keep] for k, v in s.items()}
        s["left"] = np.minimum(s["left"], 254)
        s["left"][len(keep) - len(marks) :] = 255
        key = s.pop("key")
        return key, s | {"bucket": key.astype(np.uint32)}

    def send_windows(row) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        unit = Unit(row.file, row.start, row.size, id_col, text_col)
        key, doc = unit.open_windows(_of(row.status, "open", "name")[0], np.unique(_of(row.status, "hot", "bucket")[0]))
        return key, {"window": key, "doc": doc}

    found = cut(_meet(_send(dealt(units), send_spans, tasks), _resolve_spans), "spans-met")
    windows = cut(_meet(_send(dealt(_status(units, found.where("kind != 'covered'")).where("status IS NOT NULL")), send_windows, tasks), _resolve_windows), "windows-met")

    schema = T.StructType([*docs.schema.fields, *(T.StructField(k, t) for k, t in added.items())])

    def finish(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in frames:
            for row in t.to_pandas().itertuples(index=False):
                yield from _finish(row, id_col, text_col, schema.names)

    return dealt(_status(units, found, windows)).mapInArrow(tidy(finish), schema)


def _finish(row, id_col: str, text_col: str, names: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows of a unit without their covered bytes."""
    unit = Unit(row.file, row.start, row.size, id_col, text_col)
    far, far_windows = _of(row.status, "covered", "name", "doc"), _of(row.status, "window", "name", "doc")
    open_names, hot = _of(row.status, "open", "name")[0], np.unique(_of(row.status, "hot", "bucket")[0])
    held = []
    for i, j, t, s in unit.chunks():
        at, of = s.windows(s.among(open_names, hot))
        held.append((i, j, t, s, at, of, s.window[at], unit.ids[i:j][s.doc]))
        del s.window
    if not held:
        return
    near = _least_by(np.concatenate([x[3].name for x in held]), np.concatenate([x[7] for x in held]))[:2]
    near_windows = _least_by(np.concatenate([x[6] for x in held]), np.concatenate([x[7][x[5]] for x in held]))[:2]
    for i, j, t, s, at, of, w, doc in held:
        whole = (_owner(s.name, *near) < doc) | (_owner(s.name, *far) < doc)
        steps = np.zeros(len(t.buf) + 1, np.int32)
        np.add.at(steps, s.first[whole], 1)
        np.add.at(steps, s.last[whole] + MATCH, -1)
        hit = at[(_owner(w, *near_windows) < doc[of]) | (_owner(w, *far_windows) < doc[of])]
        np.add.at(steps, hit, 1)
        np.add.at(steps, hit + MATCH, -1)
        n = int(t.offs[-1])
        gone = np.cumsum(steps[:n]) > 0
        total = np.r_[0, np.cumsum(gone)]
        begins = gone & np.r_[True, ~gone[:-1]][:n]
        begins[t.offs[:-1][np.diff(t.offs) > 0]] |= gone[t.offs[:-1][np.diff(t.offs) > 0]]
        n_spans = np.r_[0, np.cumsum(begins)]
        left = t.buf[:n][~gone]
        offs = t.offs - total[t.offs]
        kept = pa.LargeBinaryArray.from_buffers(pa.large_binary(), j - i, [None, pa.py_buffer(offs.astype(np.int64).tobytes()), pa.py_buffer(left.tobytes())]).cast(pa.binary())
        part = unit.table.slice(i, j - i).combine_chunks()
        null = part.column(text_col).is_null().to_numpy()
        texts = pa.array([None if x else b.as_py().decode("utf-8", "ignore") for b, x in zip(kept, null, strict=True)], pa.string())
        new = {
            text_col: texts,
            "n_bytes": pa.array(np.diff(t.offs)),
            "n_removed": pa.array(np.diff(total[t.offs])),
            "n_spans": pa.array(np.diff(n_spans[t.offs])),
            "kept": kept,
        }
        columns = [new[c] if c in new else _whole(part.column(c)) for c in names]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def _whole(column: pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
