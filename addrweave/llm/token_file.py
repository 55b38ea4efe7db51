"""Token files of directly addressable codes.

An id is split into chunks of eight bits. Level 0 holds the lowest chunk of every token, level k
the next chunk of those tokens that need it. A bitmap beside each level says which tokens go
on, and a directory of set bits before each 512-bit block gives a token's place in the next
level by one look-up. So any token, or any run of tokens, is read without decoding what
stands before it.

A file holds documents in order: the number of tokens before each, then the levels. The files
of a table, taken in the order of the manifest, hold all documents by ascending id. A task writes
a new file under a name of its own and reports it in its manifest row; a file of a failed or
repeated attempt is in no manifest and is never read.

Defined results: a null text is an empty one (end token only); a null id comes first; rows that repeat
an id stand side by side, ordered by text; an empty table gives an empty manifest; other columns are ignored.
"""

from __future__ import annotations

import re
import sys
import uuid
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from addrweave.llm.shared import Texts, cut, read_shared, text_chunks, tidy, write_shared
from addrweave.session import scratch_path

MAGIC = b"DACTOK01"
BLOCK = 512  # bits of a bitmap for each entry of its rank directory
FILE_TOKENS = 8_000_000  # tokens after which a task begins a new file
PIECES = 500_000  # distinct pieces kept by a worker, and as many older ones
_LITTLE = sys.byteorder == "little" and array("I").itemsize == 4

# White space of the byte-level splitter.
_WS = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_LETTERS, _MARKS = "A-Za-zÀ-ÖØ-öø-ÿ", r"!-&(-/:-@\[-`{-~"  # the apostrophe begins pieces of its own
#: Cuts a text where the splitter cuts it, or more coarsely; no piece depends on its neighbours. Letters before a mark and
#: marks before a letter are cut off, the rest up to white space stays whole.
_PIECE = re.compile(
    f" ?[{_LETTERS}]+(?=[{_MARKS}]|[{_WS}]|$)| ?[{_MARKS}]+(?=[{_LETTERS}]|[{_WS}]|$)| ?[^{_WS}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+"
)
#: Pieces that the splitter leaves whole.
_SINGLE = re.compile(f" ?(?:[{_LETTERS}]+|[{_MARKS}]+|[0-9]+)")


def dac_levels(ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Levels of (chunks, bitmap bytes, rank directory)."""
    levels, rest = [], ids.astype(np.uint32)
    while True:
        more = rest > 0xFF
        bits = np.packbits(more, bitorder="little")
        bits = np.concatenate([bits, np.zeros(-len(bits) % (BLOCK // 8), np.uint8)])
        in_block = np.unpackbits(bits).reshape(-1, BLOCK).sum(1, dtype=np.uint64) if len(bits) else np.zeros(0, np.uint64)
        levels.append(((rest & 0xFF).astype(np.uint8), bits, np.r_[np.uint64(0), np.cumsum(in_block)].astype("<u8")))
        if not more.any():
            return levels
        rest = rest[more] >> 8


def file_parts(doc_ids: list[int | None], counts: np.ndarray, ids: np.ndarray) -> list:
    """Buffers of one file: magic, header (documents, tokens, levels, size of each level), document ids (and which
    of them are null), starts, levels."""
    levels = dac_levels(ids)
    names = [np.array([x or 0 for x in doc_ids], "<i8"), np.array([x is None for x in doc_ids], "<u8")]
    header = np.array([len(counts), len(ids), len(levels), *(len(x[0]) for x in levels)], "<u8")
    return [MAGIC, header, *names, np.r_[0, np.cumsum(counts)].astype("<u8"), *(p for level in levels for p in (level[2], level[1], level[0]))]


class TokenFile:
    """Random access to the tokens of one file."""

    def __init__(self, path: str):
        raw = read_shared(path)
        if raw[:8].tobytes() != MAGIC:
            raise ValueError(f"{path}: not a token file")
        at = 8

        def take(n: int, kind: str) -> np.ndarray:
            nonlocal at
            size = n * np.dtype(kind).itemsize
            out = np.ndarray((n,), kind, buffer=raw, offset=at)
            at += size
            return out

        n_docs, self.n_tokens, n_levels = map(int, take(3, "<u8"))
        sizes = [int(n) for n in take(n_levels, "<u8")]
        doc_ids, null = take(n_docs, "<i8"), take(n_docs, "<u8")
        self.doc_ids = pd.array(doc_ids, "Int64")
        self.doc_ids[null.astype(bool)] = pd.NA
        self.starts = take(n_docs + 1, "<u8")
        self.levels = []
        for n in sizes:
            blocks = -(-n // BLOCK)
            ranks, bits, chunks = take(blocks + 1, "<u8"), take(blocks * BLOCK // 8, "u1"), take(n, "u1")
            self.levels.append((chunks, bits, ranks))

    def _rank(self, level: int, i: int) -> int:
        """Tokens before place ``i`` of a level that go on."""
        _, bits, ranks = self.levels[level]
        block = i // BLOCK
        part = np.unpackbits(bits[block * BLOCK // 8 : -(-i // 8)], bitorder="little")
        return int(ranks[block]) + int(part[: i - block * BLOCK].sum())

    def tokens(self, a: int, b: int) -> np.ndarray:
        """Tokens a to b - 1."""
        out = np.zeros(b - a, np.uint32)
        places = np.arange(b - a)
        for level, (chunks, bits, _) in enumerate(self.levels):
            if a == b:
                break
            out[places] |= chunks[a:b].astype(np.uint32) << np.uint32(8 * level)
            on = np.unpackbits(bits[a // 8 : -(-b // 8)], bitorder="little")[a % 8 : a % 8 + b - a].astype(bool)
            places = places[on]
            a = self._rank(level, a)
            b = a + len(places)
        return out

    def document(self, k: int) -> np.ndarray:
        return self.tokens(int(self.starts[k]), int(self.starts[k + 1]))


class BytePieces(dict):
    """Ids of a piece of text by the tokenizers library, as little-endian 32-bit integers; filled on demand.

    The library's model encodes a piece that its splitter would leave whole; others go through all its steps."""

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.normalizer is not None or not isinstance(self.tokenizer.pre_tokenizer, ByteLevel):
            raise ValueError("only byte-level definitions without a normalizer can be cut into pieces beforehand")
        self.model = self.tokenizer.model
        # the character that stands for each byte
        split = ByteLevel(add_prefix_space=False, use_regex=False)
        self.byte_names = {b: split.pre_tokenize_str(chr(b))[0][0] for b in range(128)}
        for b in range(128, 256):  # as the last byte of a two-byte character, or its first
            pair = bytes([0xC3, b]) if b < 0xC0 else bytes([b, 0x80])
            if b < 0xC0 or 0xC2 <= b <= 0xDF:
                self.byte_names[b] = split.pre_tokenize_str(pair.decode())[0][0][1 if b < 0xC0 else 0]
        self.special = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.older: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        out = self.older.get(piece)
        if out is None:
            if _SINGLE.fullmatch(piece):
                name = piece.encode().decode("latin-1").translate(self.byte_names)
                ids = [t.id for t in self.model.tokenize(name)]
            else:
                ids = self.tokenizer.encode(piece, add_special_tokens=False).ids
            out = array("I", ids).tobytes() if _LITTLE else np.array(ids, "<u4").tobytes()
        if len(self) >= PIECES:  # the last pieces met are kept, twice as many at most
            self.older = dict(self)
            self.clear()
        if len(piece) <= 256:
            self[piece] = out
        return out

    def encode_all(self, t: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the number of each. Pieces of whole runs of texts are cut and told apart at
        once, so that a distinct piece is looked up once; texts with characters beyond À to ÿ or with special tokens go one by one."""
        n = int(t.offs[-1])
        buf = t.buf[:n]
        kind = byte_classes(t.buf[: n + 1])[:n]
        beyond = np.r_[0, np.cumsum(kind == _BEYOND)]
        alone = beyond[t.offs[1:]] > beyond[t.offs[:-1]]
        if self.cut:
            whole = buf.tobytes()
            for name in self.special:
                raw, at = name.encode(), whole.find(name.encode())
                while at >= 0:
                    alone[np.searchsorted(t.offs, at, side="right") - 1] = True
                    at = whole.find(raw, at + 1)
        ids, counts = [], np.zeros(len(t), np.int64)
        edges = np.r_[0, np.flatnonzero(alone[1:] != alone[:-1]) + 1, len(t)]
        for i, j in zip(edges[:-1].tolist(), edges[1:].tolist()):
            a, b = int(t.offs[i]), int(t.offs[j])
            if i < j and alone[i]:
                for k in range(i, j):
                    ids.append(np.frombuffer(self.encode(buf[t.offs[k] : t.offs[k + 1]].tobytes().decode("utf-8", "replace")), "<u4"))
                    counts[k] = len(ids[-1])
            elif a < b:
                starts = piece_starts(buf[a:b], kind[a:b], t.offs[i : j + 1] - a)
                offs = pa.py_buffer(np.r_[starts, b - a].astype(np.int64))
                pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, offs, pa.py_buffer(np.ascontiguousarray(buf[a:b]))]).dictionary_encode()
                coded = [self[p.decode()] for p in pieces.dictionary.to_pylist()]
                size = np.array([len(x) // 4 for x in coded])
                table, index = np.frombuffer(b"".join(coded), "<u4"), pieces.indices.to_numpy()
                length = size[index]
                end = np.cumsum(length)
                ids.append(table[np.repeat((np.cumsum(size) - size)[index] - (end - length), length) + np.arange(int(end[-1]))])
                counts[i:j] = np.diff(np.r_[0, end][np.searchsorted(starts, t.offs[i : j + 1] - a)])
        return np.concatenate(ids) if ids else np.zeros(0, "<u4"), counts

    def encode(self, text: str) -> bytes:
        if self.cut and any(s in text for s in self.special):
            parts = (np.array([self.special[p]], "<u4").tobytes() if p in self.special else self.encode(p) for p in self.cut.split(text) if p)
            return b"".join(parts)
        return b"".join(map(self.__getitem__, _PIECE.findall(text)))


#: Classes of bytes for cutting whole chunks: white space, letters, marks, digits, apostrophe and control characters.
_SPACE, _LETTER, _MARK, _DIGIT, _OTHER, _BEYOND = range(6)
_CLASS = np.full(256, _BEYOND, np.uint8)
_CLASS[:128] = [
    _SPACE if re.fullmatch(f"[{_WS}]", chr(b)) else _LETTER if re.fullmatch(f"[{_LETTERS}]", chr(b)) else _MARK if re.fullmatch(f"[{_MARKS}]", chr(b))
    else _DIGIT if chr(b).isdigit() else _OTHER
    for b in range(128)
]


def byte_classes(buf: np.ndarray) -> np.ndarray:
    """The class of each byte of UTF-8 text; both bytes of a letter from À to ÿ are letters, others beyond ASCII ``_BEYOND``."""
    kind = _CLASS[buf]
    lead = np.flatnonzero(buf[:-1] == 0xC3)
    lead = lead[(buf[lead + 1] != 0x97) & (buf[lead + 1] != 0xB7)]  # the signs × and ÷
    kind[lead] = kind[lead + 1] = _LETTER
    return kind


def piece_starts(buf: np.ndarray, kind: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Where the pieces of texts without bytes ``_BEYOND`` begin: at changes between letters, marks and digits, and around
    white space as the splitter does: a run of it leaves its last character to what follows, which takes a blank along."""
    n = len(buf)
    space = kind == _SPACE
    first = np.zeros(n + 1, bool)
    first[offs] = True
    before = np.r_[False, space[:-1]]
    after_ink = np.r_[~space[1:], False] & ~first[1:]  # the next byte is of the same text and no white space
    cut = space & (~before | after_ink)
    blank = np.r_[False, buf[:-1] == 0x20]
    cut |= ~space & before & ~blank
    prev = np.r_[np.uint8(_SPACE), kind[:-1]]
    cut |= (kind != prev) & ~space & ~before & (kind != _OTHER) & (prev != _OTHER)
    cut |= first[:n]
    return np.flatnonzero(cut)


_PIECES: dict[str, BytePieces] = {}


def write_token_files(docs: DataFrame, path: str, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2) -> DataFrame:
    """Encode every text, append ``end_id``, and write the ids in files under ``folder`` (by default a new one in the
    shared checkpoint folder). Returns the manifest: file, part, piece (the order of files), n_docs, n_tokens."""
    from pyspark import TaskContext

    folder = folder or scratch_path(docs.sparkSession, "token-files")
    d = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    # the hash of the text deals out rows that repeat one id
    d = d.repartitionByRange(F.col("id").asc_nulls_first(), F.xxhash64("text")).sortWithinPartitions(F.col("id").asc_nulls_first(), F.xxhash64("text"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _PIECES:
            _PIECES[path] = BytePieces(path)
        pieces, part, piece = _PIECES[path], TaskContext.get().partitionId(), 0
        doc_ids: list[int | None] = []
        coded: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            name = f"{folder}/part-{part:06d}-{piece:06d}-{uuid.uuid4().hex[:12]}.dac"
            ids, counts = (np.concatenate(x) for x in zip(*coded))
            write_shared(name, file_parts(doc_ids, counts, ids))
            row = {"file": [name], "part": [part], "piece": [piece], "n_docs": [len(doc_ids)], "n_tokens": [len(ids)]}
            return pa.RecordBatch.from_pydict(row, schema=_MANIFEST)

        for batch in batches:
            names = batch.column(0).to_pylist()
            for i, j, texts in text_chunks(batch.column(1), 4 << 20):
                ids, counts = pieces.encode_all(texts)
                coded.append((np.insert(ids, np.cumsum(counts), end_id), counts + 1))
                size += len(coded[-1][0])
                doc_ids += names[i:j]
                if size >= FILE_TOKENS:
                    yield flush()
                    piece, size = piece + 1, 0
                    doc_ids.clear()
                    coded.clear()
        if doc_ids:
            yield flush()

    manifest = d.mapInArrow(tidy(run), "file string, part int, piece int, n_docs bigint, n_tokens bigint")
    return cut(manifest, "token-manifest")


_MANIFEST = pa.schema([("file", pa.string()), ("part", pa.int32()), ("piece", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())])


def with_starts(manifest: DataFrame) -> DataFrame:
    """The manifest with ``start``: tokens of all files before. The window runs over one row per file."""
    before = Window.orderBy("part", "piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = manifest.select("file", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("start"))
    return manifest.join(starts, "file")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """Every document of the files: doc_id, start (ids of all documents before it), n_tokens, ids (binary)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                f = TokenFile(row.file)
                size = np.diff(f.starts.astype(np.int64))
                for a in range(0, len(size), 2000):
                    b = min(a + 2000, len(size))
                    ids = [f.document(k).astype("<u4").tobytes() for k in range(a, b)]
                    yield pd.DataFrame({"doc_id": f.doc_ids[a:b], "start": f.starts[a:b].astype(np.int64) + row.start, "n_tokens": size[a:b], "ids": ids})

    files = with_starts(manifest).select("file", "start")
    return files.repartition(max(1, manifest.count()), "file").mapInPandas(tidy(run), "doc_id bigint, start bigint, n_tokens bigint, ids binary")
