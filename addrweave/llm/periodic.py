"""Periodic runs of words: maximal stretches that repeat a block of words four times or more.

A run of smallest period q is at least ``max(MIN_WORDS, EXPONENT * q)`` words long, and no neighbouring word extends it
with that period. Two ways find all of them:

* Periods below ``LAGS`` are too short for minimizers: words are compared with those q places later, lag by lag.
* Longer periods are sought scale by scale, [2^k, 2^(k+1)) at a time. Every block of 2^(k+1) words has a hash, and of each
  2^k neighbouring blocks the smallest hash is a minimizer. Inside a run, windows one period apart hold the same blocks, so
  they have the same minimizer one period apart; and as a block spans a whole smallest period, it does not occur in
  between. So neighbouring occurrences of a minimizer, at a distance that the scale covers, seed an extension word by word to
  both sides. A run has about 2 * EXPONENT places to seed it; one is enough, and seeds inside a known run of their period are left out.

Hashes only pick places: what is reported has been compared word by word. A stretch found under a multiple of its period is
found under the period too (its exponent is larger there), with the same ends; the smallest period stays.

Work for a text of n words is O(n log n), memory a few 64-bit values for each of its words (texts are worked on a few at a
time, a long one alone and whole).

Defined results: a null or empty text, or one of white space, has no words, no runs and an empty collapsed text; a null
id stays null; rows that repeat (an id, a text, or both) are judged each for itself; other columns are ignored, whatever
their names; an empty table gives no rows. Runs are ordered by start, then period; they may overlap or nest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from addrweave.llm.shared import Texts, mix64, text_chunks, tidy, word_spans

MIN_WORDS = 6  # words of the shortest run
EXPONENT = 4  # periods of the shortest run
LAGS = 8  # periods below this are scanned lag by lag (a power of two)

_U = np.uint64
_LOW = _U(0xFFFFFFFF)


def word_codes(t: Texts, start: np.ndarray, length: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A number for each word: equal for equal words of one text, different for all others."""
    inside = np.zeros(len(t.buf) + 1, np.int8)
    inside[start] = 1
    np.add.at(inside, start + length, -1)
    ink = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    data, offs = t.buf[ink], np.r_[0, np.cumsum(length)].astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offs), pa.py_buffer(data)])
    code = words.dictionary_encode().indices.to_numpy().astype(np.uint64)
    return code | np.repeat(np.arange(len(counts), dtype=np.uint64) << _U(32), counts)


def lag_stretches(codes: np.ndarray, q: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, length) of all maximal stretches of period q that are long enough."""
    if len(codes) <= q:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.diff(np.r_[np.int8(0), (codes[:-q] == codes[q:]).view(np.int8), np.int8(0)])
    start = np.flatnonzero(edge == 1)
    length = np.flatnonzero(edge == -1) - start + q
    long = length >= max(MIN_WORDS, EXPONENT * q)
    return start[long], length[long]


def seeds(blocks: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Minimizers (place, distance to its next occurrence) whose distance lies in [scale, 2 * scale)."""
    least = (blocks & ~_LOW) | np.arange(len(blocks), dtype=np.uint64)  # ties go to the left
    reach = 1
    while reach < scale and reach < len(least):
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    place = (least & _LOW).astype(np.int64)
    place = place[np.r_[True, place[1:] != place[:-1]]]  # windows move right, and so do their minima
    value = blocks[place]
    order = np.argsort(value, kind="stable")
    gap = place[order[1:]] - place[order[:-1]]
    hit = (value[order[1:]] == value[order[:-1]]) & (gap >= scale) & (gap < 2 * scale)
    return place[order[:-1][hit]], gap[hit]


def extend(codes: np.ndarray, x: int, q: int) -> tuple[int, int]:
    """(start, end) of the longest stretch of period q that holds the words from x to x + q."""
    a, last, step = x, len(codes) - q, 256
    while a > 0:
        to = max(0, a - step)
        odd = codes[to:a] != codes[to + q : a + q]
        if odd.any():
            a -= int(odd[::-1].argmax())
            break
        a, step = to, 2 * step
    b, step = x, 256
    while b < last:
        to = min(last, b + step)
        odd = codes[b:to] != codes[b + q : to + q]
        if odd.any():
            b += int(odd.argmax())
            break
        b, step = to, 2 * step
    return a, b + q


def scale_stretches(codes: np.ndarray, blocks: np.ndarray, scale: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of stretches with a period of this scale that are long enough."""
    out, seen = [], (0, 0, 0)  # start, end, period
    place, gap = seeds(blocks, scale)
    order = np.lexsort((place, gap))
    for x, q in zip(place[order].tolist(), gap[order].tolist()):
        if q == seen[2] and seen[0] <= x and x + q <= seen[1]:
            continue
        a, b = extend(codes, x, q)
        seen = (a, b, q)
        if b - a >= max(MIN_WORDS, EXPONENT * q):
            out.append((a, b - a, q))
    return out


def find_runs(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs of the texts with these word codes, ordered by start and period; starts count
    from the first word of the first text."""
    found = []
    for q in range(1, LAGS):
        start, length = lag_stretches(codes, q)
        found.append(np.column_stack([start, length, np.full(len(start), q)]))
    home = np.arange(len(codes))
    blocks, width, scale = mix64(codes + _U(0x9E3779B97F4A7C15)), 1, LAGS
    while True:
        long = counts >= EXPONENT * scale  # shorter texts have no run of this scale
        if not long.any():
            break
        if not long.all():
            stay = np.repeat(long, counts)
            codes, home, blocks, counts = codes[stay], home[stay], blocks[stay], counts[long]
        while width < 2 * scale:
            later = np.zeros_like(blocks)
            if width < len(blocks):
                later[:-width] = blocks[width:]
            blocks, width = mix64(blocks * _U(0xD6E8FEB86659FD93) + later), 2 * width
        here = np.array(scale_stretches(codes, blocks, scale), np.int64).reshape(-1, 3)
        here[:, 0] = home[here[:, 0]]
        found.append(here)
        scale *= 2
    r = np.concatenate(found)
    r = r[np.lexsort((r[:, 2], r[:, 1], r[:, 0]))]
    if len(r):  # of equal stretches the smallest period
        r = r[np.r_[True, (r[1:, :2] != r[:-1, :2]).any(1)]]
        r = r[np.lexsort((r[:, 2], r[:, 0]))]
    return r[:, 0], r[:, 1], r[:, 2]


def join_words(t: Texts, start: np.ndarray, length: np.ndarray, text_of: np.ndarray, n_texts: int) -> pa.StringArray:
    """Words joined by one space, text by text."""
    last = np.r_[text_of[1:] != text_of[:-1], True][: len(start)]
    size = length + ~last  # a space after each word but the last
    end = np.cumsum(size)
    out = t.buf[np.repeat(start - (end - size), size) + np.arange(int(end[-1]) if len(end) else 0)]
    out[end[~last] - 1] = 0x20
    ends = np.r_[0, end][np.searchsorted(text_of, np.arange(n_texts + 1))]
    return pa.LargeStringArray.from_buffers(n_texts, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(out))


RUN = "struct<start:bigint,length:bigint,period:bigint>"
_RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def collapse_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``n_words``, ``runs`` (array of start, length, period in words) and ``collapsed``: the words
    that no run holds after its first period, joined by single spaces."""
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = d.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, t in text_chunks(batch.column(1)):
                start, length, counts = word_spans(t)
                a, size, q = find_runs(word_codes(t, start, length, counts), counts)
                first = np.r_[0, np.cumsum(counts)]
                text_of = np.repeat(np.arange(j - i), counts)
                covered = np.zeros(len(start) + 1, np.int64)
                np.add.at(covered, a + q, 1)
                np.add.at(covered, a + size, -1)
                kept = np.cumsum(covered[:-1]) == 0
                home = text_of[a] if len(a) else a
                offs = pa.array(np.searchsorted(home, np.arange(j - i + 1)).astype(np.int32))
                values = pa.StructArray.from_arrays([pa.array(x.astype(np.int64)) for x in (a - first[home], size, q)], names=["start", "length", "period"])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(i, j - i),
                        pa.array(counts.astype(np.int64)),
                        pa.ListArray.from_arrays(offs, values).cast(_RUN),
                        join_words(t, start[kept], length[kept], text_of[kept], j - i).cast(pa.string()),
                    ],
                    names=["doc_id", "n_words", "runs", "collapsed"],
                )

    return d.mapInArrow(tidy(run), f"doc_id {kind}, n_words bigint, runs array<{RUN}>, collapsed string")
