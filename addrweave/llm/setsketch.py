"""Near-duplicate documents by SetSketch registers over word shingles.

A register holds floor(1 - log_b(x)) of the smallest x among exponentially distributed
numbers that the shingles of a document draw for it, cut off to 16 bits. The numbers of a shingle come as one
ascending stream dealt out to random registers, so a document's streams are followed only until its
registers are full. Registers of a union are the maxima of the registers (``merge``); equal
registers are as likely as the sets are similar.

1. Documents with the same set are one class, represented by the smallest id.
2. Bands of registers are hashed; classes that share a band are candidates. Of each bucket only
   the pairs with its hub are looked at first, the class that meets most others in all its buckets (an original is
   closer to its copies than these to each other): those whose likelihood estimate is not clearly too low are
   confirmed on the full sets.
3. Buckets that still hold several components are compared in blocks, register by register,
   and only pairs from different components that pass the estimate are confirmed. A large group of
   copies is one component by then and costs no pairs.

With six registers a band and 42 bands, two sets of similarity 0.8 miss each other with a probability of 3e-6; the
estimate (standard deviation 0.02 at 0.8) passes from 0.72 on.

Defined results: no words (empty or null text) make an empty set that links with nothing; a row with a
null id links with nothing and has a null component; rows that repeat an id are one node; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from addrweave.llm.components import components
from addrweave.llm.shared import Texts, cut, hash_spans, lower_ascii, mix64, passing, runs, text_chunks, tidy, word_spans

REGISTERS, BASE, RATE = 384, 1.001, 20.0
BAND, BANDS = 6, 42
ESTIMATE = 0.72
BLOCK = 1000  # classes of a bucket compared with as many others in one step
_U = np.uint64
_GOLDEN = _U(0x9E3779B97F4A7C15)


def shingle_sets(texts: Texts, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of every text as 64-bit hashes, sorted: (hashes, number of each text). A text with fewer
    words than ``width`` has one shingle of all its words, one without words has none."""
    low = lower_ascii(texts)
    start, length, n_words = word_spans(low)
    word = hash_spans(low.buf, start, length)
    doc = np.repeat(np.arange(len(n_words)), n_words)
    first = np.repeat(np.cumsum(n_words) - n_words, n_words)
    after = np.repeat(n_words, n_words) - (np.arange(len(word)) - first)  # words of the text from here on
    padded = np.r_[word, np.zeros(width, np.uint64)]
    h = np.full(len(word), 0xABCD, np.uint64)
    for k in range(width):
        h = np.where(k < after, mix64(h * _GOLDEN + padded[k : k + len(word)]), h)
    whole = (after >= width) | (np.arange(len(word)) == first)
    doc, h = doc[whole], h[whole]
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return h[new], np.bincount(doc[new], minlength=len(n_words))


def _least_draws(hashes: np.ndarray, doc: np.ndarray, n: np.ndarray, m: int, reach: float) -> np.ndarray:
    """Least draw of each register (document by register), of draws up to ``reach`` / n; infinite if there is none."""
    out = np.full(len(n) * m, np.inf)
    limit = (reach / np.maximum(n, 1))[doc]
    x, step = np.zeros(len(hashes)), hashes.copy()
    while len(step):
        step = step + _GOLDEN
        r = mix64(step)
        x = x - np.log(((r >> _U(11)).astype(np.float64) + 0.5) * 2.0**-53) / m
        live = np.flatnonzero(x <= limit)
        x, step, doc, limit = x[live], step[live], doc[live], limit[live]
        place = (((r[live] & _U(0x7FF)) * _U(m)) >> _U(11)).astype(np.int64)  # from bits that x does not depend on
        np.minimum.at(out, doc * m + place, x)
    return out.reshape(len(n), m)


def registers(hashes: np.ndarray, n: np.ndarray, m: int = REGISTERS) -> np.ndarray:
    """SetSketch registers (documents by m, 16 bits) of sets given by their shingle hashes; zeros for empty sets."""
    doc = np.repeat(np.arange(len(n)), n)
    reach = np.log(m) + 3
    least = _least_draws(hashes, doc, n, m, reach)
    while True:
        short = np.flatnonzero(np.isinf(least).any(1) & (n > 0))
        if not len(short):
            break
        reach *= 2
        place = np.full(len(n), -1)
        place[short] = np.arange(len(short))
        of = place[doc] >= 0
        least[short] = _least_draws(hashes[of], place[doc[of]], n[short], m, reach)
    with np.errstate(divide="ignore"):
        k = np.floor(1 - np.log(least / RATE) / np.log(BASE))
    return np.where(n[:, None] > 0, np.clip(k, 0, 65535), 0).astype(np.uint16)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the unions."""
    return np.maximum(a, b)


def jaccard_estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Likeliest similarity of sets of known sizes, row by row, given how many registers are larger, smaller, equal."""
    more, less = (a > b).sum(1), (a < b).sum(1)
    same = a.shape[1] - more - less
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    c = (BASE - 1) / BASE
    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(20):  # the slope of the likelihood falls: find where it is zero
        j = (low + high) / 2
        x, y = np.maximum(u - v * j, 1e-12), np.maximum(v - u * j, 1e-12)
        p, q = -np.log1p(-x * c) / np.log(BASE), -np.log1p(-y * c) / np.log(BASE)
        dp, dq = -v * c / (1 - x * c) / np.log(BASE), -u * c / (1 - y * c) / np.log(BASE)
        slope = more * dp / p + less * dq / q - same * (dp + dq) / np.maximum(1 - p - q, 1e-12)
        low, high = np.where(slope > 0, j, low), np.where(slope > 0, high, j)
    return (low + high) / 2


def jaccard_parts(a: pa.Array, b: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sizes of intersection and union of the full shingle sets of two columns of texts, row by row."""
    both, total = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
    mixed = pa.concat_arrays([x for k in range(len(a)) for x in (a.slice(k, 1), b.slice(k, 1))]) if len(a) else a
    for i in range(0, len(a), 64):
        for first, _, texts in text_chunks(mixed.slice(2 * i, 128), 1 << 62):
            h, n = shingle_sets(texts, width)
            row = np.repeat(np.arange(len(n)) // 2, n)
            order = np.lexsort((h, row))
            h, row = h[order], row[order]
            twice = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
            k = i + first // 2
            met = np.bincount(row[1:][twice], minlength=len(n) // 2)
            both[k : k + len(met)] = met
            total[k : k + len(met)] = n.reshape(-1, 2).sum(1) - met
    return both, total


def _names(hashes: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
    """Two words that name each set."""
    ends, names = np.cumsum(n), []
    for seed in (1, 2):
        total = np.r_[_U(0), np.cumsum(mix64(hashes ^ _U(seed * 0x5851F42D4C957F2D)))]
        names.append((total[ends] - total[ends - n]).view(np.int64))
    return names


def sketches(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """id, n_shingles, two words that name the set, and the registers of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, texts in text_chunks(batch.column(1)):
                h, n = shingle_sets(texts, width)
                names, k = _names(h, n), registers(h, n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(n, pa.int64()), *map(pa.array, names), pa.array([x.tobytes() for x in k], pa.binary())],
                    names=["id", "n", "s1", "s2", "sketch"],
                )

    d = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    return d.mapInArrow(tidy(run), "id bigint, n bigint, s1 bigint, s2 bigint, sketch binary")


def _bands(classes: DataFrame) -> DataFrame:
    """A row (key, band, rep) for each band of each class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            k = _sketch_rows(batch.column(1))[:, : BAND * BANDS].astype(np.uint64).reshape(batch.num_rows, -1, BAND)
            h = np.broadcast_to(mix64(np.arange(k.shape[1], dtype=np.uint64)), k.shape[:2])
            for r in range(BAND):
                h = mix64(h * _GOLDEN + k[:, :, r])
            reps = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), k.shape[1])
            band = np.tile(np.arange(k.shape[1], dtype=np.int32), batch.num_rows)
            yield pa.RecordBatch.from_arrays([pa.array(h.ravel().view(np.int64)), pa.array(band), pa.array(reps)], names=["key", "band", "rep"])

    return classes.select("rep", "sketch").mapInArrow(tidy(run), "key bigint, band int, rep bigint")


def _sketch_rows(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), -1)


def _likely(pairs: DataFrame, classes: DataFrame, least: float) -> DataFrame:
    """Of pairs (a, b), those with an estimate from ``least`` on, with the estimate."""
    side = lambda x: classes.select(F.col("rep").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                n_a, n_b = (batch.column(k).to_numpy(zero_copy_only=False).astype(float) for k in (2, 4))
                j = jaccard_estimate(_sketch_rows(batch.column(3)), _sketch_rows(batch.column(5)), n_a, n_b)
                out = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(j)], names=["a", "b", "j"])
                yield out.filter(pa.array(j >= least))

    d = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "s_a", "n_b", "s_b")
    return d.mapInArrow(tidy(run), "a bigint, b bigint, j double")


def _confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Of pairs (a, b), those whose full sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                both, total = jaccard_parts(part.column(2), part.column(3), width)
                yield part.select([0, 1]).filter(pa.array(100 * both >= percent * total))

    side = lambda x: texts.select(F.col("rep").alias(x), F.col("text").alias(f"t_{x}"))
    d = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b").select("a", "b", "t_a", "t_b")
    return d.mapInArrow(tidy(run), "a bigint, b bigint")


def _across(rows: DataFrame, least: float) -> DataFrame:
    """Likely pairs (a, b) of different components within buckets, each in the bucket of the first band they share; rows:
    key, band, rep, n, component, sketch.

    A bucket of up to ``BLOCK`` classes is one step; a larger one is dealt out to blocks, and every
    two blocks meet in a step of their own, so no step holds more than two blocks.
    """
    size = rows.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    d = rows.join(size, "key").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    d = d.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    d = d.select("key", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "block", "band", "rep", "n", "component", "sketch")
    d = d.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y")

    def compare(t: pd.DataFrame) -> pd.DataFrame:
        s = np.frombuffer(b"".join(t.sketch), np.uint16).reshape(len(t), -1)
        rep, n, comp, block = (t[c].to_numpy() for c in ("rep", "n", "component", "block"))
        found = []
        for i in range(len(t) - 1):
            # between two blocks, or within one; sizes alone rule out most pairs of unlike texts
            k = np.arange(i + 1, len(t))
            k = k[(comp[k] != comp[i]) & ((block[k] != block[i]) | (t.x.iat[0] == t.y.iat[0]))]
            k = k[np.minimum(n[k], n[i]) >= least * np.maximum(n[k], n[i])]
            same = s[k] == s[i]
            fair = same.mean(1) >= least - 0.05  # about the similarity, before the sizes are considered
            fair[fair] = same[fair, : BAND * BANDS].reshape(-1, BANDS, BAND).all(2).argmax(1) == t.band.iat[0]
            k = k[fair]
            if len(k):
                k = k[jaccard_estimate(s[k], np.broadcast_to(s[i], (len(k), s.shape[1])), n[k].astype(float), np.full(len(k), float(n[i]))) >= least]
                found.append(pd.DataFrame({"a": np.minimum(rep[k], rep[i]), "b": np.maximum(rep[k], rep[i])}))
        return pd.concat(found) if found else pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for t in frames:
            t = t if rest is None else pd.concat([rest, t], ignore_index=True)
            edge = t[["key", "x", "y"]].to_numpy()
            begins = np.flatnonzero(np.r_[True, (edge[1:] != edge[:-1]).any(1)]) if len(t) else np.zeros(0, int)
            for a, b in zip(begins[:-1], begins[1:], strict=True):
                if b - a > 1:
                    yield compare(t.iloc[a:b])
            rest = t.iloc[begins[-1] :].reset_index(drop=True) if len(begins) else None
        if rest is not None and len(rest) > 1:
            yield compare(rest)

    return d.mapInPandas(tidy(run), "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """id, n_shingles, component_id (smallest id reachable by links), kept, of every row of ``docs``. Bands and
    estimate are made for a ``percent`` of 80 and more; a smaller one is refused, as most of its pairs would be missed.
    The result is written; sketches, buckets and texts that led to it are deleted."""
    if percent < 80:
        raise ValueError(f"bands and estimate hold from 80 percent on, not for {percent}")
    with passing(docs.sparkSession):
        return cut(_components(docs, id_col, text_col, width, percent), "near-duplicates", stays=True)


def _components(docs: DataFrame, id_col: str, text_col: str, width: int, percent: int) -> DataFrame:
    """The rows of ``near_duplicates``, planned over tables written on the way."""
    all_sketches = cut(sketches(docs, id_col, text_col, width), "sketches")
    named = ["s1", "s2", "n"]
    sets = all_sketches.where("n > 0 AND id IS NOT NULL").groupBy(*named).agg(F.min("id").alias("first_id"))
    sets = cut(sets.withColumn("rep", F.monotonically_increasing_id()), "classes")  # numbers are fixed once written
    # the registers go along for one document of each class only
    classes = all_sketches.join(sets, named).where("id = first_id").select("rep", "n", "sketch")
    classes = cut(classes.dropDuplicates(["rep"]), "class-sketches")

    bands = _bands(classes)
    shared = bands.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    buckets = cut(bands.join(shared, "key"), "buckets")
    met = sets.join(buckets.select("rep").distinct(), "rep", "left_semi").withColumnRenamed("first_id", "id")
    texts = cut(_class_texts(docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")), met, width), "class-texts")

    # pairs with the hub of a bucket
    weight = buckets.groupBy("rep").agg(F.sum("size").alias("weight"))
    hubs = buckets.join(weight, "rep").groupBy("key").agg(F.max(F.struct("weight", -F.col("rep")))["col2"].alias("hub"))
    pairs = buckets.join(hubs.select("key", (-F.col("hub")).alias("hub")), "key").where("rep != hub").select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct()
    pairs = cut(_likely(pairs, classes, ESTIMATE), "likely")
    links = cut(_confirmed(pairs, texts, width, percent), "links-hub")
    found = components(links)

    # buckets that hold several components
    rows = buckets.select("key", "band", "rep").join(found.withColumnRenamed("id", "rep"), "rep", "left")
    rows = rows.withColumn("component", F.coalesce("component", "rep"))
    several = rows.groupBy("key").agg(F.min("component").alias("p"), F.max("component").alias("q")).where("p < q").select("key")
    rows = rows.join(several, "key").join(classes, "rep").select("key", "band", "rep", "n", "component", "sketch")
    tried = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    across = cut(_across(rows, ESTIMATE), "across").join(tried, ["a", "b"], "left_anti")
    links = links.unionByName(cut(_confirmed(across, texts, width, percent), "links-across"))
    found = components(links).withColumnRenamed("id", "rep")

    # the smallest id of each component, of its classes first
    whole = sets.join(found, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    least = whole.groupBy("component").agg(F.min("first_id").alias("component_id"))
    whole = whole.join(least, "component").select("rep", "component_id")
    out = all_sketches.select("id", *named).join(sets.select("rep", *named), named, "left").join(whole, "rep", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    out = out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"))
    return out.withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))


def _class_texts(docs: DataFrame, met: DataFrame, width: int) -> DataFrame:
    """rep and one text of each class in ``met`` (id, rep and the name of its set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, texts in text_chunks(batch.column(1)):
                h, n = shingle_sets(texts, width)
                part = batch.slice(i, j - i)
                # rows that repeat an id may hold other texts
                same = np.logical_and.reduce([part.column(2 + k).to_numpy(zero_copy_only=False) == x for k, x in enumerate([*_names(h, n), n])])
                yield part.select([0, 1]).filter(pa.array(same))

    d = docs.join(met, "id").select("rep", "text", "s1", "s2", "n")
    return d.mapInArrow(tidy(run), "rep bigint, text string").dropDuplicates(["rep"])
