"""Periodic runs, ranked search and archives against plain versions, odd cases included."""

import hashlib
import io
import math
import random
import re
import zipfile
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from addrweave.llm import periodic, ranked, warc
from addrweave.llm.queries import with_planted_runs
from addrweave.llm.shared import text_chunks, word_spans

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def key(row):
    return tuple((x is None, x if x is not None else 0) for x in row)


# ------------------------------------------------------------------ periodic runs


def plain_runs(w):
    """Every lag, word by word."""
    found = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted((a, n, q) for (a, n), q in found.items())


def runs_of(texts):
    out = [[] for _ in texts]
    for i, _, t in text_chunks(pa.array(texts)):
        start, length, counts = word_spans(t)
        a, n, q = periodic.find_runs(periodic.word_codes(t, start, length, counts), counts)
        first = np.r_[0, np.cumsum(counts)]
        for x, y, z in zip(a.tolist(), n.tolist(), q.tolist()):
            doc = int(np.searchsorted(first, x, side="right")) - 1
            out[i + doc].append((x - int(first[doc]), y, z))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_runs_against_every_lag(seed):
    rng = random.Random(seed)
    texts = []
    for _ in range(60):
        letters = [f"w{k}" for k in range(rng.choice([1, 2, 3, 8, 100]))]
        w = []
        for _ in range(rng.randint(0, 6)):
            block = [rng.choice(letters) for _ in range(rng.randint(1, 70))]
            w += block * rng.randint(1, 6) + block[: rng.randint(0, len(block))] + [rng.choice(letters) for _ in range(rng.randint(0, 4))]
        texts.append(" ".join(w))
    assert runs_of(texts) == [plain_runs(t.split()) for t in texts]


def test_periods_at_the_ends_of_scales():
    """Exactly four periods, no words beside them: the shortest run of each period."""
    rng = random.Random(1)
    for q in (1, 2, 3, 6, 7, 8, 9, 15, 16, 17, 31, 32, 33, 63, 64, 65, 127, 128, 255, 256):
        block = [f"w{rng.randint(0, 5)}" for _ in range(q - 1)] + ["last"]
        w = block * 4
        assert runs_of([" ".join(w), " ".join(w[1:]), " ".join(w * 3)]) == [plain_runs(w), plain_runs(w[1:]), plain_runs(w * 3)]


def test_runs_nest_and_stop_at_texts():
    inner = "a a a a a a a a".split()
    w = (inner + ["x", "y"]) * 5
    assert runs_of([" ".join(w)]) == [plain_runs(w)] and len(plain_runs(w)) == 6
    assert runs_of(["a a a a a", "a a a a a", "a a a a a a"]) == [[], [], [(0, 6, 1)]]
    one = ["a"] * 5000
    assert runs_of([" ".join(one)]) == [[(0, 5000, 1)]]


def plain_collapse(text):
    w = WORD.findall(text or "")
    runs = plain_runs(w)
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    return len(w), runs, " ".join(x for i, x in enumerate(w) if i not in gone)


def test_collapse_runs(docs, doc_rows, no_docs):
    got = periodic.collapse_runs(docs)
    assert got.columns == ["doc_id", "n_words", "runs", "collapsed"]
    rows = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got.collect()), key=key)
    assert rows == sorted(((i, *plain_collapse(t)) for i, t, *_ in doc_rows), key=key)
    assert any(r[2] for r in rows)
    assert periodic.collapse_runs(no_docs).collect() == []


def test_planted_runs(docs, doc_rows, no_docs):
    def plant(i, t):
        if i is None or zlib.crc32(str(i).encode()) % 10:
            return t
        w, g = WORD.findall(t or ""), zlib.crc32(str(i).encode()) // 10
        if not w:
            return t
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        return " ".join(w[k if k < a else a + (k - a) % p] for k in range(len(w)))

    got = sorted(map(tuple, with_planted_runs(docs).collect()), key=lambda r: key((r[0], r[1])))
    want = sorted(((i, plant(i, t)) for i, t, *_ in doc_rows), key=lambda r: key((r[0], r[1])))
    assert got == want and any(a[1] != b[1] for a, b in zip(sorted(want, key=key), sorted(((i, t) for i, t, *_ in doc_rows), key=key)))
    assert with_planted_runs(no_docs).collect() == []


# ------------------------------------------------------------------ ranked search

TERM = re.compile(ranked.TERM_PATTERN)
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain_search(docs, items, k):
    held = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scores, asked = [], Counter(terms(text))
        for i, c in held:
            m = 75 + 25 * sum(c.values()) * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) * x for t, x in asked.items() if t in c)
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, rank, x[3], -x[0]) for rank, x in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=key)


ITEMS = [
    (1, "The STONE1 river5 river5, stone1-river6! walking300"),
    (2, None),
    (3, " ,;!"),
    (4, "nowhere-found"),
    (5, "ünï cödé ß ÑÑ Σας don't"),
    (6, "lang"),
    (7, "the of and to in under7 over8 light9 y z"),
    (7, "stone4 stone4 stone5"),
    (None, "moon1 moon2 moon3 table4 x"),
    (8, "aaaa a"),
] + [(20 + k, " ".join(f"window{k}{j} garden{j}" for j in range(k))) for k in range(30)]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in ITEMS], "item_id bigint, text string, term string, score string")


@pytest.mark.parametrize("limits", [{}, {"GROUP_BYTES": 200, "CELLS": 50, "SLICE": 64, "SHARES": 2}])
def test_search(docs, doc_rows, items, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(ranked, name, value)
    for k in (20, 3):
        got = ranked.search(docs, items, k=k)
        assert got.columns == ["item_id", "rank", "doc_id", "score"]
        # a document's text stands in its rank; rows that repeat an item id keep their ranks apart
        assert sorted(map(tuple, got.collect()), key=key) == plain_search([(i, t) for i, t, *_ in doc_rows], ITEMS, k)


def test_search_of_nothing(spark, docs, no_docs, items):
    assert ranked.search(no_docs, items).collect() == []
    assert ranked.search(docs, items.where("false")).collect() == []
    assert ranked.search(docs, items.where("item_id IN (2, 3, 4)")).collect() == []
    assert ranked.search(docs.where("text IS NULL"), items).collect() == []


def test_scores_beyond_doubles(spark):
    """A term repeated so often that sums leave the whole numbers of a double."""
    docs = [(k, "rare " * (k + 1) + f"other{k}") for k in range(4)] + [(10 + k, "filler text") for k in range(3000)]
    items = [(1, "rare " * 3_000_000)]
    got = ranked.search(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"), k=2)
    assert sorted(map(tuple, got.collect())) == plain_search(docs, items, 2)
    assert got.agg(F.max("score")).first()[0] > 2**53


def test_terms_of_long_texts_in_slices(monkeypatch):
    monkeypatch.setattr(ranked, "SLICE", 7)
    group = ranked.Terms(pa.table({"term": ["ab", "longer" * 5, "é"], "item": [0, 0, 1], "times": [1, 1, 1]}))
    texts = ["ab ab xab " + "longer" * 5 + " ab", "", "É é é-ab"] * 3
    for _, _, text, place in ranked.term_text(pa.array(texts), 1 << 20):
        got = list(zip(*(x.tolist() for x in group.counts(text, place))))
        want = [(i, group.terms.index(t), n) for i, x in enumerate(texts) for t, n in sorted(Counter(terms(x)).items()) if t in group.terms]
        assert got == sorted(want)
        assert ranked.n_terms(text, place).tolist() == [len(terms(x)) for x in texts]


# ------------------------------------------------------------------ archives

LONG = "<p>" + "a page whose payload is long enough; " * 40 + "</p>"
PAGES = [
    (1, "http://a.example/1", LONG),
    (5, "http://a.example/5", LONG),
    (3, "http://ü.example/3?q=a b\r\nWARC-Type: x", LONG),
    (None, "http://null.example/", LONG),
    (7, None, "short"),
    (8, "http://b.example", "short"),
    (9, "http://b.example", None),
    (10, "http://b.example", ""),
    (11, "x", "é" * 499),  # 998 bytes
    (12, "x", "é" * 499),
    (13, "x", "é" * 500),
    (14, "x", "é" * 500),
    (14, "x", "é" * 500),
    (15, "x", "body\r\n\r\nWARC/1.1\r\n\r\n" * 60),
    (None, None, None),
    (None, "n", "n" * 2000),
    (None, "n", "n" * 2000),
    (20, "big", "0123456789" * 300_000),
]


def plain_pages(rows):
    stored = {}
    for i, _, h in rows:
        if len((h or "").encode()) >= 1000:
            stored[h] = max(stored.get(h, (False, 0)), (i is not None, i or 0))
    out = []
    for i, _, h in rows:
        raw = (h or "").encode()
        to = (stored[h][1] if stored[h][0] else None) if len(raw) >= 1000 else i
        revisit = len(raw) >= 1000 and to != i
        out.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", to if revisit else None))
    return sorted(out, key=key)


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, u, h, "x", 1, "y", b"z") for i, u, h in PAGES]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, digest string, size int, stored string, payload binary").repartition(3)


@pytest.mark.parametrize("settings", [{}, {"BROADCAST_ROWS": 0, "SALTS": 3, "PACKAGE_BYTES": 300, "RANGE_BYTES": 100}])
def test_archives_read_back(pages, monkeypatch, settings):
    for name, value in settings.items():
        monkeypatch.setattr(warc, name, value)
    manifest = warc.write_warc(pages, zip64=bool(settings))
    got = warc.read_warc(manifest).collect()
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r[c] for c in columns) for r in got), key=key) == plain_pages(PAGES)
    assert manifest.agg(F.sum("n_records")).first()[0] == len(PAGES)
    payloads = {i: h or "" for i, _, h in PAGES if i is not None}
    for r in got:
        assert (r.payload is None) == (r.record_type == "revisit")
        if r.payload is not None and r.page_id is not None:
            assert bytes(r.payload).decode() == payloads[r.page_id]
    urls = {r.page_id: r.url for r in got}
    assert urls[3] == "http://%C3%BC.example/3?q=a%20b%0D%0AWARC-Type:%20x" and urls[7] is None
    for r in manifest.collect():  # another reader finds the same members, and gzip streams that can be read on their own
        with zipfile.ZipFile(r.file.removeprefix("file:")) as z:
            assert z.testzip() is None
            inside = warc.members(r.file)
            assert {(m.filename, m.file_size, m.CRC) for m in z.infolist()} == {(m.name, m.size, m.crc) for m in inside.values()}
            with open(r.file.removeprefix("file:"), "rb") as f:
                raw = f.read()
            at, size = warc.stored_range(r.file, inside[warc.DATA])
            assert raw[at : at + size] == z.read(warc.DATA)


def test_archive_of_nothing(pages):
    manifest = warc.write_warc(pages.where("false"))
    assert manifest.collect() == [] and warc.read_warc(manifest).collect() == []


def _record(page_id=1, payload=b"x" * 10):
    return warc.page_record(page_id, "http://x", payload, hashlib.sha1(payload).digest(), None)


def test_directories(tmp_path):
    """Comments, bytes before the archive, ZIP64 records, foreign members; what is cut off or compressed is refused."""
    records = [zlib.compress(_record(k, b"p" * k), wbits=31) for k in range(5)]
    index = [{"id": k, "offset": sum(map(len, records[:k])), "length": len(records[k])} for k in range(5)]
    path = str(tmp_path / "p.wacz")
    for zip64 in (False, True):
        plain = warc.package(records, index, zip64)
        out = io.BytesIO(plain)
        with zipfile.ZipFile(out, "a", zipfile.ZIP_DEFLATED) as z:
            z.writestr("notes/ü.txt", "n" * 100)
            z.comment = b"PK\x05\x06 a comment like an end record"
        for raw in (plain, out.getvalue(), b"leading bytes" + out.getvalue()):
            (tmp_path / "p.wacz").write_bytes(raw)
            assert [s for _, s in warc.package_ranges(path)] == [[len(r) for r in records]]
            (at, sizes), *_ = warc.package_ranges(path)
            assert [warc.read_record(zlib.decompress(raw[at + o["offset"] :][: o["length"]], 31))["page_id"] for o in index] == list(range(5))
        assert warc.members(path)["notes/ü.txt"].size == 100
        with pytest.raises(warc.NotAPackage):
            warc.stored_range(path, warc.members(path)["notes/ü.txt"])
    # more entries than the short end record can count
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for k in range(66_000):
            z.writestr(f"m{k}", b"")
    (tmp_path / "many.zip").write_bytes(out.getvalue())
    assert len(warc.members(str(tmp_path / "many.zip"))) == 66_000
    for cut in (plain[:-1], plain[: len(plain) // 2], b"", b"PK"):
        (tmp_path / "cut.zip").write_bytes(cut)
        with pytest.raises(warc.NotAPackage):
            warc.members(str(tmp_path / "cut.zip"))


def test_sizes_in_zip64_fields(tmp_path):
    """A central entry whose sizes and place all stand in its ZIP64 field."""
    import struct

    local = b"PK\x03\x04" + struct.pack("<HHHHHIIIHH", 45, 0, 0, 0, 33, zlib.crc32(b"data"), 4, 4, 1, 0) + b"m" + b"data"
    field = struct.pack("<HHQQQ", 1, 24, 4, 4, 0)
    entry = b"PK\x01\x02" + struct.pack("<HHHHHHIIIHHHHHII", 45, 45, 0, 0, 0, 33, zlib.crc32(b"data"), 0xFFFFFFFF, 0xFFFFFFFF, 1, len(field), 0, 0, 0, 0, 0xFFFFFFFF) + b"m" + field
    end64 = b"PK\x06\x06" + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, 1, 1, len(entry), len(local))
    place = struct.pack("<IQI", 0, len(local) + len(entry), 1)
    end = b"PK\x05\x06" + struct.pack("<HHHHIIH", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    path = tmp_path / "z.zip"
    path.write_bytes(local + entry + end64 + b"PK\x06\x07" + place + end)
    m = warc.members(str(path))["m"]
    at, size = warc.stored_range(str(path), m)
    assert path.read_bytes()[at : at + size] == b"data"
    path.write_bytes(local + entry + end)
    with pytest.raises(warc.NotAPackage):
        warc.members(str(path))


def test_damaged_records():
    raw = _record()
    assert warc.read_record(raw)["payload"] == b"x" * 10
    for bad in (raw.replace(b"xxx", b"xyx"), raw[:-1], raw[:50], b"WARC/9" + raw[6:]):
        with pytest.raises(ValueError):
            warc.read_record(bad)


# ------------------------------------------------------------------ pieces of token files


def test_pieces_of_whole_chunks_against_the_library():
    """Random texts of blanks, apostrophes, marks, digits, letters of two bytes, and of what is encoded alone."""
    from tokenizers import Tokenizer

    from addrweave.llm.queries import tokenizer_file
    from addrweave.llm.token_file import BytePieces

    path = tokenizer_file("byte_bpe_50k.json")
    pieces, library = BytePieces(path), Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    rng = random.Random(3)
    usual = [*"aab z  \n\n\t'',.!;12é×÷ß\x1c\x00-_", "'s", "'re", " \n", "don't", "  ", "ÿ", "À"]
    rare = ["\xa0", "　", "中", "<|endoftext|>", "œ", "٣", "́", "\x85"]
    for share in (0.0, 0.02):
        texts = ["".join(rng.choice(rare if rng.random() < share else usual) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
        for limit in (1 << 20, 300):
            for i, j, t in text_chunks(pa.array(texts), limit):
                ids, counts = pieces.encode_all(t)
                ends = np.r_[0, np.cumsum(counts)]
                got = [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])]
                assert len(got) == j - i and got == [library.encode(x, add_special_tokens=False).ids for x in texts[i:j]]


# ------------------------------------------------------------------ long texts of the suffix operator


def test_spans_of_long_texts_in_pieces(monkeypatch):
    """Pieces give every window once, with the pointer's bucket and the identifier that the whole text gives, and a side for each."""
    from addrweave.llm import suffix
    from addrweave.llm.shared import Texts

    rng = np.random.default_rng(1)
    for n in (0, 10, 49, 50, 99, 100, 101, 149, 150, 1000, 1234):
        for letters in (2, 150):
            buf = np.r_[rng.integers(97, 97 + letters, n, dtype=np.uint8), np.zeros(64, np.uint8)]
            t = Texts(buf, np.array([0, n]))
            monkeypatch.setattr(suffix, "LONG", 1 << 20)
            whole = suffix.Spans.of(t)
            monkeypatch.setattr(suffix, "LONG", 100)
            parts = suffix.Spans.of(t)

            def windows(s):
                at, of = s.windows(np.arange(len(s.first)))
                return {i: (int(s.window[i]), int(s.bucket[k]), int(s.task_key[k]), bool(s.left[k]) or bool(s.right[k])) for i, k in zip(at.tolist(), of.tolist())}

            assert windows(parts) == windows(whole) and set(windows(whole)) == set(range(max(0, n - 49)))
            assert all(side for *_, side in windows(parts).values())
            assert (parts.doc == 0).all() and len(parts.name) == len(parts.first)
