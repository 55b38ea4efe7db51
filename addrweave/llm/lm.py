"""Language-model scores from an n-gram trie in Elias-Fano levels.

Tokens are lower-cased words and an end after each text. The model is a bigram model smoothed towards
the base distribution, p(w | c) = (n(c, w) + MU p(w)) / (n(c) + MU) with p(w) = (n(w) + 0.1) / (N + 0.1 (V + 1)), so
the probabilities after each context sum to one.

Level 1, the vocabulary: sorted 64-bit hashes of the tokens as an Elias-Fano sequence, with counts. A token's place
is its id. Level 2: for each context a range of followers. The ranges' starts (pointers) are one
Elias-Fano sequence; follower w of the k-th context is stored as w + k V, which makes the followers another. Beside each
follower stands its smoothed probability, quantised to 256 values of a codebook. A follower is looked up
by successor search within its context's range; one that is not there has the context's share of the base.

Both levels are cut into shards, written to the shared folder by the tasks that count them and mapped
into memory by the tasks that score, which look up the bigrams of many texts together, shard by shard. A level-2 shard holds a range of contexts; contexts that hold more than
half a shard's tokens are dealt out by follower over all shards. Tokens are counted within a task
before they travel, so a frequent one is one row for each task.

Defined results: a null text is an empty one (its end alone is scored); a null id counts as held out;
repeated rows are counted as often as they occur; without training rows N = V = 0 and every base probability is
1; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from addrweave.llm.shared import Texts, among, cut, deal, hash_spans, lower_ascii, mix64, pack, read_shared, runs, text_chunks, tidy, unpack, word_spans, write_shared
from addrweave.session import scratch_path

MU = 2.0
HELD_OUT = 10
SENT = 2_000_000  # distinct n-grams that a task gathers before it sends them on
AT_ONCE = 2_000_000  # bigrams of several chunks of text that are looked up together, so that each shard is searched once for all of them
OPEN = 256  # shards of a level that stay mapped
_U = np.uint64
_END = _U(0xE0D0E0D0E0D0E0D1)  # the hash that stands for the end of a text


# ---------------------------------------------------------------- Elias-Fano


def _bits(places: np.ndarray, n: int) -> np.ndarray:
    """A bitmap of n bits (64-bit words, whole blocks of 512) with the given bits set."""
    words = np.zeros((n // 512 + 1) * 8, np.uint64)
    np.bitwise_or.at(words, places >> 6, _U(1) << (places & 63).astype(np.uint64))
    return words


_SELECT = np.zeros((256, 8), np.uint8)  # place of the k-th set bit of a byte
for _b in range(256):
    for _k, _p in enumerate(i for i in range(8) if _b >> i & 1):
        _SELECT[_b, _k] = _p


def _select(words: np.ndarray, before: np.ndarray, k: np.ndarray, ones: bool) -> np.ndarray:
    """Place of the k-th (from 0) set or clear bit; ``before``: set bits before each block."""
    if not ones:
        before = np.arange(len(before), dtype=np.uint64) * _U(512) - before
    block = np.searchsorted(before, k.astype(np.uint64), "right") - 1
    rest = (k - before[block].astype(np.int64)).astype(np.int64)
    w = words.reshape(-1, 8)[block]
    w = w if ones else ~w
    sums = np.cumsum(np.bitwise_count(w), 1, dtype=np.int64)
    word = (sums <= rest[:, None]).sum(1)
    row = np.arange(len(k))
    rest -= np.where(word > 0, sums[row, np.maximum(word - 1, 0)], 0)
    octets = w[row, word].view(np.uint8).reshape(-1, 8)
    sums = np.cumsum(np.bitwise_count(octets), 1, dtype=np.int64)
    octet = (sums <= rest[:, None]).sum(1)
    rest -= np.where(octet > 0, sums[row, np.maximum(octet - 1, 0)], 0)
    return block * 512 + word * 64 + octet * 8 + _SELECT[octets[row, octet], rest]


class EliasFano:
    """A sorted sequence of integers: low bits as they are, high parts as a unary bitmap with a rank directory."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, before: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.before = n, low_bits, low, high, before

    @classmethod
    def build(cls, values: np.ndarray, universe: int) -> EliasFano:
        values = values.astype(np.uint64)
        n = len(values)
        low_bits = min(56, max(0, (universe // max(n, 1)).bit_length() - 1))
        top = (universe >> low_bits) + 1
        places = (values >> _U(low_bits)).astype(np.int64) + np.arange(n)
        high = _bits(places, n + top + 1)
        sums = np.bitwise_count(high).reshape(-1, 8).sum(1, dtype=np.uint64)
        low = np.zeros(n * low_bits // 8 + 9, np.uint8)
        if low_bits and n:
            rest = values & _U((1 << low_bits) - 1)
            at = np.arange(n, dtype=np.int64) * low_bits
            for b in range(low_bits // 8 + 2):  # each value touches so many bytes at most
                shift = b * 8 - (at & 7)
                part = np.where(shift >= 0, rest >> np.maximum(shift, 0).astype(np.uint64), rest << np.maximum(-shift, 0).astype(np.uint64))
                np.bitwise_or.at(low, (at >> 3) + b, (part & _U(255)).astype(np.uint8))
        return cls(n, low_bits, low, high, np.r_[_U(0), np.cumsum(sums)[:-1]])

    def lows(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        at = i.astype(np.int64) * self.low_bits
        eight = np.ndarray((len(self.low) - 7,), "<u8", buffer=self.low, strides=(1,))
        part = eight[at >> 3] >> (at & 7).astype(np.uint64)
        # low parts of more than 57 bits do not occur, so one load holds each
        return part & _U((1 << self.low_bits) - 1)

    def access(self, i: np.ndarray) -> np.ndarray:
        high = (_select(self.high, self.before, i, True) - i).astype(np.uint64)
        return (high << _U(self.low_bits)) | self.lows(i)

    def find(self, x: np.ndarray, start: np.ndarray | None = None, end: np.ndarray | None = None) -> np.ndarray:
        """Place of each value, or -1; searched from its successor within [start, end) if given."""
        x = x.astype(np.uint64)
        h = (x >> _U(self.low_bits)).astype(np.int64)
        b, e = np.split(_select(self.high, self.before, np.r_[np.maximum(h - 1, 0), h], False), 2)
        b, e = np.where(h > 0, b - (h - 1), 0), e - h
        if start is not None:
            b, e = np.maximum(b, start), np.minimum(e, end)
        low, limit = x & _U((1 << self.low_bits) - 1), e.copy()
        live = np.flatnonzero(b < e)
        while len(live):
            mid = (b[live] + e[live]) >> 1
            less = self.lows(mid) < low[live]
            b[live[less]] = mid[less] + 1
            e[live[~less]] = mid[~less]
            live = live[b[live] < e[live]]
        hit = np.flatnonzero(b < limit)
        out = np.full(len(x), -1, np.int64)
        hit = hit[self.lows(b[hit]) == low[hit]]
        out[hit] = b[hit]
        return out

    def parts(self) -> list[np.ndarray]:
        low = np.zeros(-(-len(self.low) // 8) * 8, np.uint8)
        low[: len(self.low)] = self.low
        return [np.array([self.n, self.low_bits, len(low), len(self.high), len(self.before)], "<i8"), low, self.high, self.before]


class _Reader:
    def __init__(self, path: str):
        self.raw, self.at = read_shared(path), 0

    def take(self, n: int, kind: str) -> np.ndarray:
        out = np.ndarray((n,), kind, buffer=self.raw, offset=self.at)
        self.at += n * np.dtype(kind).itemsize
        return out

    def elias_fano(self) -> EliasFano:
        n, low_bits, low, high, before = map(int, self.take(5, "<i8"))
        return EliasFano(n, low_bits, self.take(low, "u1"), self.take(high, "<u8"), self.take(before, "<u8"))


# ---------------------------------------------------------------- level 1


def _tokens(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, ends included, and the number of each text's."""
    low = lower_ascii(t)
    start, length, n = word_spans(low)
    out = np.full(len(start) + len(n), _END)
    out[np.arange(len(start)) + np.repeat(np.arange(len(n)), n)] = hash_spans(low.buf, start, length)
    return out, n + 1


@dataclass
class Chunk:
    """The distinct tokens of some texts (hashes, sorted) and their distinct bigrams (places of context and token among
    these, sorted); the bigram that each token closes, and the number of each text's tokens."""

    hashes: np.ndarray
    context: np.ndarray
    token: np.ndarray
    back: np.ndarray
    n: np.ndarray


def _bigrams(t: Texts) -> Chunk:
    h, n = _tokens(t)
    distinct, token = np.unique(h, return_inverse=True)
    ends = np.cumsum(n)
    context = np.r_[0, token[:-1]]
    context[ends - n] = token[ends - 1]  # every text closes with the end, which also stands before it
    pair, back = np.unique(context * len(distinct) + token, return_inverse=True)
    return Chunk(distinct, *(x.astype(np.int32) for x in (*np.divmod(pair, len(distinct)), back)), n)


def _groups(chunks: Iterator, size) -> Iterator[list]:
    """Lists of chunks with AT_ONCE bigrams or one chunk more."""
    group, held = [], 0
    for c in chunks:
        group.append(c)
        held += size(c)
        if held >= AT_ONCE:
            yield group
            group, held = [], 0
    if group:
        yield group


def _together(chunks: list[Chunk]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Distinct hashes of all chunks, and the places of each chunk's among them."""
    distinct, back = np.unique(np.concatenate([c.hashes for c in chunks]), return_inverse=True)
    return distinct, np.split(back, np.cumsum([len(c.hashes) for c in chunks])[:-1])


def _add_up(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and their sums."""
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    at = runs(key)
    return key[at], np.add.reduceat(n, at) if len(at) else n


class _Gather:
    """Sums of keys that come in parts; what grows too large is handed out."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, key: np.ndarray, n: np.ndarray) -> None:
        self.parts.append((key, n))
        self.size += len(key)

    def sums(self) -> tuple[np.ndarray, np.ndarray]:
        key, n = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        self.parts, self.size = [], 0
        return _add_up(key, n)

    def full(self) -> bool:
        if self.size >= 2 * SENT:
            self.parts = [self.sums()]
            self.size = len(self.parts[0][0])
        return self.size >= SENT


@dataclass
class Vocabulary:
    """Level 1 as its shards' files tell: (file, number of tokens) of each, all counted tokens, distinct ones."""

    files: list[tuple[str, int]]
    total: int
    hot: tuple[int, ...] = ()

    def __post_init__(self):
        self.first = np.r_[0, np.cumsum([n for _, n in self.files])].astype(np.int64)
        self._open: dict[int, tuple[EliasFano, np.ndarray]] = {}

    def __getstate__(self):
        return self.__dict__ | {"_open": {}}

    @property
    def size(self) -> int:
        return int(self.first[-1])

    def shard(self, s: int) -> tuple[EliasFano, np.ndarray]:
        if s not in self._open:
            if len(self._open) >= OPEN:
                self._open.clear()
            r = _Reader(self.files[s][0])
            ef = r.elias_fano()
            self._open[s] = ef, r.take(ef.n, "<u8")
        return self._open[s]

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """id (-1: unknown) and count of each distinct hash."""
        ids, counts = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        for s, rows in deal(hashes, max(1, len(self.files))):
            if s < len(self.files) and self.files[s][1]:
                ef, n = self.shard(s)
                at = ef.find(hashes[rows] >> _U(8))
                known = at >= 0
                ids[rows[known]], counts[rows[known]] = self.first[s] + at[known], n[at[known]]
        return ids, counts

    def counts(self, ids: np.ndarray) -> np.ndarray:
        out = np.zeros(len(ids), np.int64)
        of = np.searchsorted(self.first, ids, "right") - 1
        order = np.argsort(of, kind="stable")
        at = runs(of[order])
        for a, b in zip(at, [*at[1:], len(order)]):
            rows = order[a:b]
            out[rows] = self.shard(int(of[rows[0]]))[1][ids[rows] - self.first[of[rows[0]]]]
        return out

    def base(self, counts: np.ndarray) -> np.ndarray:
        return (counts + 0.1) / (self.total + 0.1 * (self.size + 1))


def _tasks(df: DataFrame) -> int:
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _gathered(train: DataFrame, counted, dealt_by, tasks: int) -> DataFrame:
    """Rows (task, blob) of the sums of ``counted(chunks of texts)``, distinct keys and their numbers; ``dealt_by(keys)`` gives hashes to deal them by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = _Gather()

        def flush() -> pa.RecordBatch:
            key, n = g.sums()
            # sorted keys travel as differences
            rows = [(task, pack(key=np.diff(key[of], prepend=key.dtype.type(0)), n=n[of])) for task, of in ((t, np.sort(of)) for t, of in deal(dealt_by(key), tasks))]
            return pa.RecordBatch.from_pydict({"task": [r[0] for r in rows], "blob": [r[1] for r in rows]}, schema=pa.schema([("task", pa.int32()), ("blob", pa.binary())]))

        for key, n in counted(t for batch in batches for _, _, t in text_chunks(batch.column(0))):
            g.add(key, n)
            if g.full():
                yield flush()
        if g.size:
            yield flush()

    return train.mapInArrow(tidy(run), "task int, blob binary").repartitionById(tasks, "task")


def _sums(frames: Iterator[pd.DataFrame]) -> tuple[int, np.ndarray, np.ndarray] | None:
    """Task number, keys and sums of all blobs of a task."""
    parts, task = [], None
    for t in frames:
        for task, blob in zip(t.task, t.blob, strict=True):
            c = unpack([blob])
            parts.append((np.cumsum(c["key"], dtype=c["key"].dtype), c["n"]))
    return None if task is None else (int(task), *_add_up(*(np.concatenate(x) for x in zip(*parts, strict=True))))


def build_vocabulary(train: DataFrame) -> Vocabulary:
    """Count the tokens of the training texts (one column) and write level 1."""
    tasks, folder = _tasks(train), scratch_path(train.sparkSession, "lm-vocabulary")

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = _sums(frames)
        if got:
            task, key, n = got
            name = f"{folder}/{task:06d}-{uuid.uuid4().hex[:12]}.ef"
            # 56 bits of the hash tell the tokens of a shard apart
            write_shared(name, [*EliasFano.build(key >> _U(8), 1 << 56).parts(), n.astype("<u8")])
            yield pd.DataFrame({"task": [task], "file": [name], "size": [len(key)], "total": [int(n.sum())]})

    def counted(texts: Iterator[Texts]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        return (np.unique(_tokens(t)[0], return_counts=True) for t in texts)

    found = cut(_gathered(train, counted, lambda key: key, tasks).mapInPandas(tidy(write), "task int, file string, size bigint, total bigint"), "lm-vocabulary-files")
    rows = {r.task: r for r in found.collect()}  # one row per shard
    files = [(rows[s].file, rows[s].size) if s in rows else ("", 0) for s in range(tasks)]
    vocabulary = Vocabulary(files, sum(r.total for r in rows.values()))

    def frequent(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for t in frames:
            for s in t.task:
                ids = np.flatnonzero(vocabulary.shard(int(s))[1] > vocabulary.total / (2 * tasks)) + vocabulary.first[int(s)]
                yield pd.DataFrame({"id": ids})

    # fewer than twice as many as there are shards
    vocabulary.hot = tuple(sorted(r.id for r in found.select("task").mapInPandas(tidy(frequent), "id bigint").collect()))
    return vocabulary


# ---------------------------------------------------------------- level 2


@dataclass
class Trie:
    """Level 2: the file of each shard. Contexts c of shard s are those with c * shards // V = s, and a share of
    the followers of each hot context."""

    vocabulary: Vocabulary
    files: list[str]

    def __post_init__(self):
        self._open: dict[int, list] = {}

    def __getstate__(self):
        return self.__dict__ | {"_open": {}}

    def shard(self, s: int) -> list:
        if s not in self._open:
            if len(self._open) >= OPEN:
                self._open.clear()
            out = []
            if self.files[s]:
                r = _Reader(self.files[s])
                for _ in range(2):
                    pointers, followers = r.elias_fano(), r.elias_fano()
                    book = r.take(256, "<f8")
                    out.append((pointers, followers, book, r.take(-(-followers.n // 8) * 8, "u1")))
            self._open[s] = out
        return self._open[s]

    def log10(self, context: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Quantised log10 probability of each follower; NaN if it is not in the trie. Sorted contexts are found fastest."""
        v, out = self.vocabulary, np.full(len(context), np.nan)
        shard, ordinal, is_hot = _placed(v, context, token, len(self.files))
        group = shard * 2 + is_hot
        order = np.argsort(group.astype(np.uint16) if len(self.files) < 1 << 15 else group, kind="stable")  # 16 bits: a radix sort
        at = runs(group[order])
        for a, b in zip(at, [*at[1:], len(order)]):
            rows = order[a:b]
            levels = self.shard(int(shard[rows[0]]))
            if not levels:
                continue
            pointers, followers, book, codes = levels[int(is_hot[rows[0]])]
            if not followers.n:
                continue
            first = runs(ordinal[rows])
            k = ordinal[rows[first]]
            start, end = np.repeat(pointers.access(np.r_[k, k + 1]).astype(np.int64).reshape(2, -1), np.diff(np.r_[first, len(rows)]), 1)
            i = followers.find(token[rows].astype(np.uint64) + ordinal[rows].astype(np.uint64) * _U(v.size), start, end)
            out[rows[i >= 0]] = book[codes[i[i >= 0]]]
        return out


def _placed(v: Vocabulary, context: np.ndarray, token: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shard of each bigram, ordinal of its context there, and whether the context is hot."""
    hot = np.array(v.hot, np.int64)
    shard = context * shards // max(v.size, 1)
    ordinal = context + -shard * v.size // shards  # less the smallest id of the shard
    is_hot = among(context, hot)
    at = np.flatnonzero(is_hot)
    spread = mix64(context[at].astype(np.uint64) * _U(0x9E3779B97F4A7C15) + token[at].astype(np.uint64)) % _U(shards)
    shard[at], ordinal[at] = spread.astype(np.int64), np.searchsorted(hot, context[at])
    return shard, ordinal, is_hot


def _hash_of(shard: np.ndarray, tasks: int) -> np.ndarray:
    """The least hash that deal() gives to each shard."""
    return ((shard.astype(np.uint64) << _U(32)) + _U(tasks - 1)) // _U(tasks) << _U(32)  # rounded up


def _quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A codebook of 256 means of equally filled bins, and the code of each value."""
    if not len(x):
        return np.zeros(256), np.zeros(0, np.uint8)
    edges = np.unique(np.quantile(x, np.arange(1, 256) / 256, method="nearest"))
    code = np.searchsorted(edges, x, "left").astype(np.uint8)
    n = np.bincount(code, minlength=256)
    return np.bincount(code, x, 256) / np.maximum(n, 1), code


def build_trie(train: DataFrame, v: Vocabulary) -> Trie:
    """Count the bigrams of the training texts and write level 2."""
    tasks, folder = _tasks(train), scratch_path(train.sparkSession, "lm-trie")

    def counted(texts: Iterator[Texts]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for chunks in _groups(map(_bigrams, texts), lambda c: len(c.context)):
            distinct, places = _together(chunks)
            ids = v.find(distinct)[0].astype(np.uint64)
            for c, at in zip(chunks, places, strict=True):
                yield ids[at[c.context]] * _U(v.size) + ids[at[c.token]], np.bincount(c.back)

    def by_shard(key: np.ndarray) -> np.ndarray:
        shard = _placed(v, (key // _U(v.size)).astype(np.int64), (key % _U(v.size)).astype(np.int64), tasks)[0]
        return _hash_of(shard, tasks)

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = _sums(frames)
        if got:
            task, key, n = got
            context, token = (key // _U(v.size)).astype(np.int64), (key % _U(v.size)).astype(np.int64)
            _, ordinal, is_hot = _placed(v, context, token, tasks)
            distinct, back = np.unique(token, return_inverse=True)
            first = runs(context)
            counts = v.counts(np.r_[distinct, context[first]])  # one visit to the shards of level 1
            base = v.base(counts[: len(distinct)])[back]
            p = np.log10((n + MU * base) / (np.repeat(counts[len(distinct) :], np.diff(np.r_[first, len(context)])) + MU))
            parts = []
            for side in (False, True):
                rows = is_hot == side
                n_contexts = len(v.hot) if side else -(-(task + 1) * v.size // tasks) - (-(-task * v.size // tasks))
                book, code = _quantise(p[rows])
                starts = np.searchsorted(ordinal[rows], np.arange(n_contexts + 1))
                parts += EliasFano.build(starts, len(code) + 1).parts()
                values = token[rows].astype(np.uint64) + ordinal[rows].astype(np.uint64) * _U(v.size)
                parts += EliasFano.build(values, max(1, n_contexts) * v.size).parts()
                parts += [book.astype("<f8"), np.r_[code, np.zeros(-len(code) % 8, np.uint8)]]
            name = f"{folder}/{task:06d}-{uuid.uuid4().hex[:12]}.trie"
            write_shared(name, parts)
            yield pd.DataFrame({"task": [task], "file": [name]})

    rows = cut(_gathered(train, counted, by_shard, tasks).mapInPandas(tidy(write), "task int, file string"), "lm-trie-files").collect()  # one row per shard
    files = {r.task: r.file for r in rows}
    return Trie(v, [files.get(s, "") for s in range(tasks)])


# ---------------------------------------------------------------- scores


def held_out(doc_id: Column, one_in: int = HELD_OUT) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(one_in)) == 0


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", one_in: int = HELD_OUT) -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score, score of every text, by a model of those not held out."""
    d = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")).withColumn("held_out", held_out(F.col("id"), one_in))
    train = d.where(~F.col("held_out")).select("text")
    vocabulary = build_vocabulary(train)
    trie = build_trie(train, vocabulary)

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[pa.Array], Chunk]]:
        for batch in batches:
            for i, j, t in text_chunks(batch.column(1)):
                yield [batch.column(k).take(pa.array(np.arange(i, j))) for k in (0, 2)], _bigrams(t)  # copies: the batch is not held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(chunks(batches), lambda x: len(x[1].context)):
            for (rows, c), (known, base, score) in zip(group, score_chunks([c for _, c in group], vocabulary, trie), strict=True):
                columns = [*rows, pa.array(c.n), pa.array(known), pa.array(np.full(len(c.n), vocabulary.total)), pa.array(base), pa.array(score)]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    out = d.mapInArrow(tidy(run), "id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
    return out.withColumnRenamed("id", id_col)


def score_chunks(chunks: list[Chunk], v: Vocabulary, trie: Trie) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Known tokens, base score and score of each text, chunk by chunk."""
    distinct, places = _together(chunks)
    ids, counts = v.find(distinct)
    base = np.log10(v.base(counts))
    # each distinct bigram once; an unknown context or token leaves the base
    pair, again = np.unique(np.concatenate([at[c.context] * len(distinct) + at[c.token] for c, at in zip(chunks, places, strict=True)]), return_inverse=True)
    b, w = (x.astype(np.int32) for x in np.divmod(pair, len(distinct)))
    again = again.astype(np.int32)
    del pair
    p = base[w]
    known = ids[b] >= 0
    p[known] = np.log10(MU * v.base(counts[w[known]]) / (counts[b[known]] + MU))
    both = np.flatnonzero(known & (ids[w] >= 0))
    found = trie.log10(ids[b[both]], ids[w[both]])
    hit = ~np.isnan(found)
    p[both[hit]] = found[hit]
    for c, of in zip(chunks, np.split(again, np.cumsum([len(c.context) for c in chunks])[:-1]), strict=True):
        at = np.cumsum(c.n) - c.n
        yield tuple(np.add.reduceat(x[c.back], at) for x in ((counts[w[of]] > 0).astype(np.int64), base[w[of]], p[of]))
