"""Exact BPE encoding by backtracking over longest matches, and decoding by an offset table.

A tokenizer definition (a ``tokenizers`` JSON file, given by path) is turned into

* one Aho-Corasick automaton over all tokens, giving the longest token that begins at each place;
* for each token its longest proper prefix that is a token;
* a pair-compatibility table, filled on demand: two tokens may stand side by side if no merge
  across their border would have come first.

A token sequence in which all neighbours are compatible is the one that the merges produce, so the
encoder walks along the text with the longest token that is compatible with the one before, tries
shorter prefixes if none is, and steps back over places proven to lead nowhere. Every place is
ruled out at most once: linear time.

Text is cut at ASCII white space; each distinct piece is normalized, split and encoded once and
kept in a bounded table. The normalizer and the splitter are the definition's own.

Defined results: a null text is an empty one, without tokens; special tokens written out in a text
become their ids, as in the definition; an empty table gives an empty result; repeated rows get
equal results; all other columns of the input pass through untouched.
"""

from __future__ import annotations

import json
import re
import sys
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from addrweave.llm.shared import kept, release, text_chunks, tidy

#: Distinct pieces kept by a worker (and as many older ones), and pairs of tokens.
PIECES, PAIRS = 300_000, 400_000
_LITTLE = sys.byteorder == "little" and array("I").itemsize == 4
_FINAL = 0xE000  # a last character carrying the end-of-word suffix is one symbol: moved to the private use area


class Merges:
    """Encoder for one string of symbols. Inner ids follow the order of merges: base symbols come first."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str = ""):
        def symbols(token: str) -> str:
            if suffix and token.endswith(suffix) and len(token) > len(suffix):
                body = token[: -len(suffix)]
                return body[:-1] + chr(_FINAL + ord(body[-1]))
            return token

        made = {symbols(a) + symbols(b): (symbols(a), symbols(b)) for a, b in merges}
        if len(made) != len(merges):
            raise ValueError("two merges make the same token: compatibility of neighbours does not decide here")
        outer = {symbols(t): i for t, i in vocab.items()}
        base = [s for s in outer if len(s) == 1]
        names = [*base, *made]
        inner = {s: k for k, s in enumerate(names)}
        self.n_base = len(base)
        self.length = [len(s) for s in names]
        self.outer = [outer[s] for s in names]
        self.left = [-1] * len(base) + [inner[a] for a, _ in made.values()]
        self.right = [-1] * len(base) + [inner[b] for _, b in made.values()]
        self.merged = {(a, b): k for k, (a, b) in enumerate(zip(self.left, self.right, strict=True)) if a >= 0}
        # a token that its own text does not become (an earlier merge takes a part away) never occurs
        self.occurs = [True] * len(base)
        for k in range(len(base), len(names)):
            a, b = self.left[k], self.right[k]
            self.occurs.append(self.occurs[a] and self.occurs[b] and self._apart(a, b, k))
        self.machine = ahocorasick.Automaton()
        for s, k in inner.items():
            if self.occurs[k]:
                self.machine.add_word(s, k)
        self.machine.make_automaton()
        self.prefix = [-1] * len(names)
        for s, k in inner.items():
            shorter = (inner.get(s[:n], -1) for n in range(len(s) - 1, 0, -1))
            self.prefix[k] = next((p for p in shorter if p >= 0 and self.occurs[p]), -1)
        self._pairs: dict[int, bool] = {}  # by a * number of tokens + b

    def compatible(self, a: int, b: int) -> bool:
        """Whether tokens a, b stay side by side: undo the latest merge at the border, again and again; no two
        pieces met on the way may have a merge that comes before the one just undone (at a tie the left one comes first)."""
        pair = a * len(self.left) + b
        known = self._pairs.get(pair)
        if known is None:
            known = (a, b) not in self.merged and self._apart(a, b, len(self.left))
            if len(self._pairs) >= PAIRS:
                self._pairs.clear()
            self._pairs[pair] = known
        return known

    def _apart(self, left: int, right: int, before: int) -> bool:
        """Whether no merge across the border of two tokens comes before ``before``, or before a merge within them
        that would take its piece away (their own merge is left out)."""
        while max(left, right) >= self.n_base:
            if left > right:
                before, left = min(before, left), self.right[left]
            else:
                before, right = min(before, right + 1), self.left[right]
            m = self.merged.get((left, right))
            if m is not None and m < before:
                return False
        return True

    def encode(self, text: str) -> list[int]:
        """Ids of a string of symbols."""
        n = len(text)
        longest = [-1] * n
        length, prefix, compatible = self.length, self.prefix, self.compatible
        for end, k in self.machine.iter(text):
            begin = end + 1 - length[k]
            if longest[begin] < 0 or length[longest[begin]] < length[k]:
                longest[begin] = k
        if -1 in longest:
            raise ValueError("a symbol of the text is not in the vocabulary")
        if n and length[longest[0]] == n:
            return [self.outer[longest[0]]]
        out: list[int] = []
        dead = bytearray(n + 1)  # places where no way to the end begins
        at = 0
        token = longest[0] if n else -1
        while at < n:
            end = at + length[token]
            if not dead[end] and (not out or compatible(out[-1], token)):
                out.append(token)
                at = end
                if at < n:
                    token = longest[at]
                continue
            token = prefix[token]
            while token == -1:
                dead[at] = 1
                last = out.pop()
                at -= length[last]
                token = prefix[last]
        return [self.outer[k] for k in out]


class WordPieces(dict):
    """Ids of a piece of text without ASCII white space, as little-endian 32-bit integers; filled on demand."""

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("dropout") or model.get("byte_fallback") or model.get("ignore_merges"):
            raise ValueError("only plain BPE definitions are supported")
        self.tokenizer = Tokenizer.from_file(path)
        self.suffix = model.get("end_of_word_suffix") or ""
        merges = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]]
        self.merges = Merges(model["vocab"], merges, self.suffix)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        names = {i: t for t, i in model["vocab"].items()} | {i: t for t, i in self.special.items()}
        self.names = [names.get(i, "") for i in range(max(names) + 1)]
        self.older: dict[bytes, bytes] = {}
        self.words = _ascii_words(spec)

    def __missing__(self, piece: bytes) -> bytes:
        out = self.older.get(piece)
        if out is None:
            out = self.encode(piece)
        if len(self) >= PIECES:  # the last pieces met are kept, twice as many at most
            self.older = dict(self)
            self.clear()
        if len(piece) <= 256:
            self[piece] = out
        return out

    def encode(self, piece: bytes) -> bytes:
        text = piece.decode("utf-8", "replace")
        ids: list[int] = []
        for part in self.cut.split(text) if self.cut and "<" in text else (text,):
            if part in self.special:
                ids.append(self.special[part])
            elif self.words and part.isascii() and part.isprintable():
                for word in self.words.findall(part.lower()):
                    ids += self.merges.encode(word[:-1] + chr(_FINAL + ord(word[-1])) if self.suffix else word)
            elif part:
                if self.tokenizer.normalizer is not None:
                    part = self.tokenizer.normalizer.normalize_str(part)
                for word, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(part):
                    ids += self.merges.encode(word[:-1] + chr(_FINAL + ord(word[-1])) if self.suffix else word)
        return array("I", ids).tobytes() if _LITTLE else np.array(ids, "<u4").tobytes()


def _ascii_words(spec: dict) -> regex.Pattern | None:
    """The definition's splitter, for printable ASCII in lower case, where its normalizer and its byte alphabet change
    nothing else; None if it is made of other parts than these."""
    normal, split = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}
    steps = [x["type"] for x in normal.get("normalizers", [])]
    parts = split.get("pretokenizers", [])
    if steps != ["NFC", "Replace", "Lowercase"] or normal["normalizers"][1] != {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}:
        return None
    if [x["type"] for x in parts] != ["Split", "ByteLevel"] or parts[1]["add_prefix_space"] or parts[1]["use_regex"]:
        return None
    if parts[0]["behavior"] != "Removed" or not parts[0]["invert"] or "Regex" not in parts[0]["pattern"]:
        return None
    return regex.compile(parts[0]["pattern"]["Regex"])


class OffsetTable:
    """Names of all tokens in one run of bytes, with their offsets; texts are gathered from it."""

    def __init__(self, names: list[str], joint: str = " "):
        raw = [(n + joint).encode("utf-8") for n in names]
        self.joint = len(joint.encode("utf-8"))
        self.offs = np.cumsum([0, *map(len, raw)])
        self.blob = np.frombuffer(b"".join(raw), np.uint8)

    def decode(self, ids: np.ndarray) -> bytes:
        """Names of the tokens with the joint between them."""
        if not len(ids):
            return b""
        size = self.offs[ids + 1] - self.offs[ids]
        ends = np.cumsum(size)
        place = np.arange(ends[-1]) + np.repeat(self.offs[ids] - (ends - size), size)
        return self.blob[place][: len(place) - self.joint].tobytes()


def _tables(path: str) -> tuple[WordPieces, OffsetTable]:
    def make() -> tuple[WordPieces, OffsetTable]:
        pieces = WordPieces(path)
        return pieces, OffsetTable(pieces.names)

    return kept("bpe", path, make)


def bpe_encode(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids", decoded_col: str | None = "decoded") -> DataFrame:
    """The input's columns and, for every whole text, its ids (``ids_col``, binary: little-endian unsigned 32-bit
    integers) and the text decoded from them (``decoded_col``, left out if None). Columns of these names in the input
    are replaced.

    ``path`` names the tokenizer file at the same place on all machines. No shuffle: each batch is
    encoded where it is read.
    """
    added = [T.StructField(ids_col, T.BinaryType())] + ([T.StructField(decoded_col, T.StringType())] if decoded_col else [])
    docs = docs.drop(*(f.name for f in added))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, table = _tables(path)
        for batch in batches:
            for i, j, texts in text_chunks(batch.column(batch.schema.get_field_index(text_col))):
                raw, offs = texts.buf, texts.offs
                ids = [b"".join(map(pieces.__getitem__, raw[offs[k] : offs[k + 1]].tobytes().split())) for k in range(j - i)]
                new = [pa.array(ids, pa.binary())]
                if decoded_col:
                    new.append(pa.array([table.decode(np.frombuffer(x, "<u4").astype(np.int64)) for x in ids], pa.binary()).cast(pa.string()))
                yield pa.RecordBatch.from_arrays([*batch.slice(i, j - i).columns, *new], names=[*batch.schema.names, *(f.name for f in added)])
                del ids, new
                release()

    return docs.mapInArrow(tidy(run, "bpe"), T.StructType([*docs.schema.fields, *added]))
