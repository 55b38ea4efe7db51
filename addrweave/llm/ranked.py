"""Ranked lexical search without an index of the documents: every text is scanned with the items' terms.

All terms of the items stand in one Aho-Corasick automaton, each guarded by a boundary on either side, so a term inside a
longer word is no match. Its outputs are term numbers, and a list of postings maps a term to the items that hold it.
Texts are read twice: the first scan counts the documents that hold each term (and all documents and their terms), the second
scores. Every task keeps the best documents of each item as it goes, so what leaves it is bounded by items, not by documents;
these are merged in two steps, first a share of the tasks at a time.

Items and their terms are written to the shared folder in groups of about ``GROUP_BYTES`` of item text, which a task loads
one at a time: items of any number are searched, each group by a scan of its own.

Long texts are scanned in slices that meet at blanks; a text's bytes are held whole by one task, its matches slice by slice.

A term is a maximal run of ASCII letters, digits and characters beyond ASCII; only A-Z are lower-cased. Scores are whole numbers,
see ``weight`` and ``term_scores``.

Defined results: a null text or one without terms is no document and is never ranked; an item without terms (or null) has no rows.
Items that repeat an id are ranked each for itself; documents that repeat an id likewise take a rank each. Equal scores come
by ascending doc_id, nulls last. Other columns are ignored. No documents, or no items: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from addrweave.llm.shared import cut, shared_file, text_chunks, tidy
from addrweave.session import scratch_path

TERM_PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
GROUP_BYTES = 16 << 20  # item text of one automaton, about
SLICE = 2 << 20  # bytes scanned at once, of a long text too
CELLS = 2_000_000  # scores (documents x items) held at once
SHARES = 256  # merges of a first step, so that no task meets the best documents of all others

# bytes of terms, lower-cased; a blank stands for every other byte
_TERM = np.full(256, 0x20, np.uint8)
for _a, _b in ((0x30, 0x3A), (0x61, 0x7B), (0x80, 0x100)):
    _TERM[_a:_b] = np.arange(_a, _b)
_TERM[0x41:0x5B] = np.arange(0x61, 0x7B)


def term_text(column: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, place of each text): texts with a blank before each and after the last, every byte that is
    part of no term a blank."""
    for i, j, t in text_chunks(column, limit):
        n = int(t.offs[-1])
        out = np.full(n + j - i + 1, 0x20, np.uint8)
        at = np.arange(n) + np.repeat(np.arange(1, j - i + 1), np.diff(t.offs))
        out[at] = _TERM[t.buf[:n]]
        yield i, j, out, t.offs[:-1] + np.arange(1, j - i + 1)


class Terms:
    """Automaton of one group of items, the postings of its terms, and their weights."""

    def __init__(self, rows: pa.Table):
        names, number = np.unique(rows.column("term").to_numpy(zero_copy_only=False), return_inverse=True)
        keys, item = np.unique(rows.column("item").to_numpy(), return_inverse=True)
        self.terms, self.items = names.tolist(), keys
        order = np.argsort(number, kind="stable")
        self.first = np.searchsorted(number[order], np.arange(len(names) + 1))
        self.item, self.times = item[order], rows.column("times").to_numpy()[order]
        self.weight = np.zeros(len(names), np.int64)
        if "weight" in rows.column_names:
            self.weight[number] = rows.column("weight").to_numpy()
        self.machine = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for k, name in enumerate(self.terms):  # a character for each byte
            self.machine.add_word(" " + name.encode().decode("latin-1") + " ", k)
        if self.terms:
            self.machine.make_automaton()

    def counts(self, text: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, term, times) of every term that a text holds, ordered by text and term."""
        pairs, times = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for a, b in _slices(text) if self.terms else ():
            hits = list(self.machine.iter(text[a:b].tobytes().decode("latin-1")))
            if hits:
                ends, terms = (np.fromiter(x, np.int64, len(hits)) for x in zip(*hits))
                here = np.searchsorted(place, a + ends - 1, side="right") - 1  # the last byte of the term
                for to, x in zip((pairs, times), np.unique(here * len(self.terms) + terms, return_counts=True)):
                    to.append(x)
        pair, which = np.unique(np.concatenate(pairs), return_inverse=True)
        total = np.zeros(len(pair), np.int64)
        np.add.at(total, which, np.concatenate(times))
        return pair // max(1, len(self.terms)), pair % max(1, len(self.terms)), total


def _slices(text: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pieces of about ``SLICE`` bytes that begin and end at a blank, which neighbours share: each term is in one of them."""
    a = 0
    while a < len(text) - 1:
        b = min(a + SLICE, len(text) - 1)
        while text[b] != 0x20:  # the last byte is a blank
            ahead = np.flatnonzero(text[b : b + SLICE] == 0x20)
            b = b + int(ahead[0]) if len(ahead) else min(b + SLICE, len(text) - 1)
        yield a, b + 1
        a = b


def n_terms(text: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Terms of each text, with repeats."""
    ink = text != 0x20
    begins = np.flatnonzero(ink[1:] & ~ink[:-1]) + 1
    return np.diff(np.searchsorted(begins, np.r_[place, len(text)]))


def term_scores(times: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What one unit of weight counts for a term found ``times`` times in a document with length measure ``m``."""
    return 1_000_000_000 * times // (1000 * times + 12 * m)


def length_measure(n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """Length of a document of n terms against the mean, in percent, a quarter of it fixed to 75."""
    return np.array([100 - 25 + 25 * int(x) * documents // terms for x in n], np.int64)


class Best:
    """The k best documents of each item among those seen."""

    def __init__(self, k: int, n_items: int, limit: int):
        self.limit = limit  # rows held back before they are ranked
        self.k, self.least = k, np.zeros(n_items, np.int64)  # scores from here on can still be among the best
        self.item, self.score, self.doc, self.null = ([np.zeros(0, np.int64)] for _ in range(4))
        self.waiting = 0

    def add(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        for to, x in zip((self.item, self.score, self.doc, self.null), (item, score, doc, null)):
            to.append(x)
        self.waiting += len(item)
        if self.waiting > self.limit:
            self.settle()

    def settle(self) -> tuple[np.ndarray, ...]:
        item, score, doc, null = (np.concatenate(x) for x in (self.item, self.score, self.doc, self.null))
        order = np.lexsort((doc, null, -score, item))
        item, score, doc, null = item[order], score[order], doc[order], null[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        keep = rank < self.k
        last = rank == self.k - 1
        self.least[item[last]] = score[last]
        out = item[keep], score[keep], doc[keep], null[keep]
        self.item, self.score, self.doc, self.null = ([x] for x in out)
        self.waiting = 0
        return out


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``item`` (a row's key), ``item_id``, ``group``, ``term``, ``times``, written. Items are dealt to groups by hash."""
    d = items.select(F.col(id_col).alias("item_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    total = d.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    group = F.pmod(F.xxhash64("item_id", "text"), F.lit(1 + total // GROUP_BYTES)).cast("int")
    low = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    d = cut(d.select(F.monotonically_increasing_id().alias("item"), "item_id", group.alias("group"), low.alias("text")), "items")
    d = d.select("item", "item_id", "group", F.explode(F.regexp_extract_all("text", F.lit(TERM_PATTERN), F.lit(0))).alias("term"))
    return cut(d.groupBy("item", "item_id", "group", "term").agg(F.count(F.lit(1)).alias("times")), "item-terms")


def _by_group(d: DataFrame, name: str) -> str:
    """Write the rows of each group into a folder of its own."""
    path = scratch_path(d.sparkSession, name)
    d.repartition("group").write.partitionBy("group").parquet(path)
    return path


_LOADED: dict[tuple[str, int], Terms] = {}


def _load(path: str, group: int) -> Terms:
    """The group's automaton; a worker keeps the one it used last."""
    from pyarrow import dataset

    if (path, group) not in _LOADED:
        system, at = shared_file(path)
        rows = dataset.dataset(f"{at}/group={group}", filesystem=system, format="parquet").to_table()
        _LOADED.clear()
        _LOADED[path, group] = Terms(rows)
    return _LOADED[path, group]


def _count(d: DataFrame, path: str, group: int, totals: bool) -> DataFrame:
    """First scan: ``term, n_docs`` by task; with ``totals`` also a row without term: documents, and terms in ``n_terms``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = _load(path, group)
        held, documents, all_terms = np.zeros(len(terms.terms), np.int64), 0, 0
        for batch in batches:
            for _, _, text, place in term_text(batch.column(1)):
                _, term, _ = terms.counts(text, place)
                held += np.bincount(term, minlength=len(held))
                n = n_terms(text, place)
                documents, all_terms = documents + int((n > 0).sum()), all_terms + int(n.sum())
        found = np.flatnonzero(held)
        names, docs, sizes = [terms.terms[k] for k in found], held[found].tolist(), [0] * len(found)
        if totals:
            names, docs, sizes = [*names, None], [*docs, documents], [*sizes, all_terms]
        yield pa.RecordBatch.from_pydict({"term": pa.array(names, pa.string()), "n_docs": pa.array(docs, pa.int64()), "n_terms": pa.array(sizes, pa.int64())})

    return d.mapInArrow(tidy(run), "term string, n_docs bigint, n_terms bigint").withColumn("group", F.lit(group))


def _score(d: DataFrame, path: str, group: int, documents: int, all_terms: int, k: int) -> DataFrame:
    """Second scan: ``item, doc_id, score``, the best of each task."""
    cells = CELLS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = _load(path, group)
        best, n_items = Best(k, len(terms.items), cells), len(terms.items)
        # in doubles while no sum leaves the whole numbers that they hold
        exact = float((terms.weight[np.repeat(np.arange(len(terms.weight)), np.diff(terms.first))] * terms.times).sum()) * 1e6 < 2**53
        for batch in batches:
            ids = batch.column(0)
            null, ids = np.asarray(ids.is_null()).astype(np.int64), ids.fill_null(0).to_numpy()
            for i, _, text, place in term_text(batch.column(1)):
                doc, term, times = terms.counts(text, place)
                part = terms.weight[term] * term_scores(times, length_measure(n_terms(text, place), documents, all_terms)[doc])
                fan = terms.first[term + 1] - terms.first[term]
                # blocks of documents whose scores (and postings) fit
                a, step = 0, max(1, cells // n_items)
                before = np.r_[0, np.cumsum(fan)]
                while a < len(place):
                    lo = int(np.searchsorted(doc, a))
                    b = min(a + step, len(place))
                    full = int(np.searchsorted(before, before[lo] + 4 * cells, side="right")) - 1
                    if full < len(doc):
                        b = max(a + 1, min(b, int(doc[full])))
                    hi = int(np.searchsorted(doc, b))
                    f, at = fan[lo:hi], terms.first[term[lo:hi]]
                    posting = np.repeat(at - np.r_[0, np.cumsum(f)[:-1]][: len(f)], f) + np.arange(int(f.sum()))
                    cell = np.repeat(doc[lo:hi] - a, f) * n_items + terms.item[posting]
                    gain = np.repeat(part[lo:hi], f) * terms.times[posting]
                    if exact:
                        score = np.bincount(cell, gain, (b - a) * n_items).astype(np.int64)
                    else:
                        score = np.zeros((b - a) * n_items, np.int64)
                        np.add.at(score, cell, gain)
                    score = score.reshape(b - a, n_items)
                    row, item = np.nonzero((score > 0) & (score >= best.least))
                    best.add(item, score[row, item], ids[i + a + row], null[i + a + row])
                    a = b
        item, score, doc, null = best.settle()
        yield pa.RecordBatch.from_pydict(
            {"item": terms.items[item], "doc_id": pa.array(doc, pa.int64(), mask=null.astype(bool)), "score": score},
        )

    return d.mapInArrow(tidy(run), "item bigint, doc_id bigint, score bigint")


def _top(d: DataFrame, keys: list[str], k: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return d.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The ``k`` best documents of each item: item_id, rank (from 1), doc_id, score (above 0)."""
    spark = docs.sparkSession
    d = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    terms = item_terms(items, item_col, item_text_col)
    empty = spark.createDataFrame([], f"item_id {items.schema[item_col].dataType.simpleString()}, rank int, doc_id bigint, score bigint")
    groups = sorted(r[0] for r in terms.select("group").distinct().collect())
    if not groups:
        return empty
    path = _by_group(terms.select("group", "item", "term", "times"), "terms")
    counts = reduce(DataFrame.unionByName, (_count(d, path, g, g == groups[0]) for g in groups))
    counts = cut(counts.groupBy("group", "term").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_terms").alias("n_terms")), "term-counts")
    totals = counts.where("term IS NULL").select("n_docs", "n_terms").first()
    if totals is None or not totals.n_docs:
        return empty
    weight = F.floor(F.lit(1000.0) * F.ln(F.lit(float(2 * totals.n_docs + 2)) / (2 * F.col("n_docs") + 1)))
    weighted = terms.join(counts.where("term IS NOT NULL").select("group", "term", weight.cast("bigint").alias("weight")), ["group", "term"])
    path = _by_group(weighted.select("group", "item", "term", "times", "weight"), "weighted-terms")
    found = sorted(r[0] for r in counts.where("term IS NOT NULL").select("group").distinct().collect())
    if not found:
        return empty
    best = reduce(DataFrame.unionByName, (_score(d, path, g, totals.n_docs, totals.n_terms, k) for g in found))
    best = cut(best.withColumn("share", F.spark_partition_id() % SHARES), "best")
    top = _top(_top(best, ["item", "share"], k).drop("rank", "share"), ["item"], k)
    names = terms.select("item", "item_id").distinct()
    return top.join(names, "item").select("item_id", "rank", "doc_id", "score")
