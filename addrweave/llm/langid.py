"""Language identification in two steps: the language family first, then the language within it.

Texts become square roots of counts of hashed letter pairs and triples, scaled to length 1. One linear support
vector machine for each pair of families, and for each pair of languages within a family, votes; equal
votes go to the larger sum of margins. The score is the mean confidence against the other families times that
against the other languages of the family.

Every label of the table is learned, however many there are, from a bounded sample: about ``SAMPLE`` distinct (id, text)
rows of each language, chosen by a hash of both, and of these about ``2 * SAMPLE`` of each family (at least ``LEAST`` of a
language) for the machines between families. Counts that fix the sampling rates, and all predictions, cover every row.
Machines are trained in parallel, those between two blocks of ``BLOCK`` classes in one task; their number grows with the
square of the families, and of the languages within one.

Defined results: a text that is null or has no letter is ``und`` with score 0, and so is every text if there is nothing to
learn from; a null id counts as an empty one in the held-out rule; rows that repeat an id or a text get equal
results; with one language learned, every text with a letter is of that language (score 1); an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from addrweave.llm.shared import Texts, mix64, text_chunks, tidy

SAMPLE = 500
LEAST = 20
BLOCK = 8
BUCKETS = 4096
TEXTS, BYTES = 200, 1 << 19  # texts, and bytes of text, whose features are held at once
UND = "und"

#: Families of ISO 639-1 codes. A language not listed is a family of its own, with its variants (zh, zh-Hans, ZH).
FAMILIES = {
    "germanic": "en de nl af sv da no nb nn is fy lb yi".split(),
    "romance": "fr es it pt ro ca gl oc".split(),
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk".split(),
    "uralic": "fi et hu".split(),
    "celtic": "ga gd cy br".split(),
    "turkic": "tr az kk uz".split(),
    "indo-aryan": "hi bn ur mr gu pa ne".split(),
    "semitic": "ar he am mt".split(),
}
_FAMILY = {lang: family for family, langs in FAMILIES.items() for lang in langs}


def family_of(lang: str) -> str:
    code = re.split("[-_]", lang.strip().lower())[0]
    return _FAMILY.get(code, code)


_LETTER = np.zeros(256, np.uint8)  # other characters become 0
_LETTER[65:91] = np.arange(97, 123)
_LETTER[97:123] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)


def features(t: Texts) -> np.ndarray:
    """Rows of length 1 (zero for a text without letters)."""
    n = int(t.offs[-1])
    c = np.zeros(n + 2, np.uint64)
    c[1:-1] = _LETTER[t.buf[:n]]
    doc = np.repeat(np.arange(len(t)), np.diff(t.offs))
    first, last = np.zeros(n + 1, bool), np.zeros(n + 1, bool)
    first[t.offs[:-1]] = True
    last[t.offs[1:]] = True
    at = np.flatnonzero(c[1:-1])
    before = np.where(first[at], 0, c[at]).astype(np.uint64)
    after = np.where(last[at + 1], 0, c[at + 2]).astype(np.uint64)
    pair = (before << np.uint64(8)) | c[at + 1]
    triple = (pair << np.uint64(8)) | after | np.uint64(1 << 32)
    slot = np.r_[mix64(pair), mix64(triple)] & np.uint64(BUCKETS - 1)
    row = np.r_[doc[at], doc[at]]
    x = np.sqrt(np.bincount(row * BUCKETS + slot.astype(np.int64), minlength=len(t) * BUCKETS)).reshape(len(t), BUCKETS)
    return x / np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-12)


def train_svm(x: np.ndarray, y: np.ndarray, c: float = 4.0, rounds: int = 300) -> np.ndarray:
    """Weights and offset (last) of a linear machine for y = +1 / -1: squared hinge loss, by accelerated descent. Both
    sides weigh the same however many rows they have."""
    x = np.hstack([x, np.ones((len(x), 1))])
    weight = c * len(y) / 2 / np.where(y > 0, max(1, (y > 0).sum()), max(1, (y < 0).sum()))
    v = np.ones(x.shape[1])
    for _ in range(20):
        v = x.T @ (weight * (x @ v))
        v /= np.linalg.norm(v)
    step = 1 / (1 + 2 * np.linalg.norm(x.T @ (weight * (x @ v))))
    w = z = np.zeros(x.shape[1])
    for k in range(rounds):
        slack = np.maximum(0, 1 - y * (x @ z))
        new = z - step * (z - 2 * (x.T @ (weight * y * slack)))
        w, z = new, new + k / (k + 3) * (new - w)
    return w


class _Vote:
    """One machine for each pair of classes."""

    def __init__(self, names: list[str], machines: dict[tuple[int, int], np.ndarray]):
        self.names, self.pairs = names, sorted(machines)
        self.w = np.array([machines[p] for p in self.pairs]).T if machines else np.zeros((BUCKETS + 1, 0))

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        margin = x @ self.w[:-1] + self.w[-1]
        votes, total, sure = (np.zeros((len(x), len(self.names))) for _ in range(3))
        for k, (a, b) in enumerate(self.pairs):
            p = 1 / (1 + np.exp(-4 * np.clip(margin[:, k], -9, 9)))
            votes[:, a] += margin[:, k] >= 0
            votes[:, b] += margin[:, k] < 0
            total[:, a] += margin[:, k]
            total[:, b] -= margin[:, k]
            sure[:, a] += p
            sure[:, b] += 1 - p
        best = _best(votes, total)
        others = max(1, len(self.names) - 1)
        return best, sure[np.arange(len(x)), best] / others if self.pairs else np.ones(len(x))


class Model:
    """Machines between families and between the languages of each family."""

    def __init__(self, families: _Vote, languages: dict[str, _Vote]):
        self.families, self.languages = families, languages

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        family, score = self.families.predict(x)
        out = np.empty(len(x), object)
        for k, name in enumerate(self.families.names):
            rows = np.flatnonzero(family == k)
            if len(rows):
                lang, within = self.languages[name].predict(x[rows])
                out[rows] = np.array(self.languages[name].names, object)[lang]
                score[rows] *= within
        return out, score


def _best(votes: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Most votes; of equal ones the largest sum of margins, then the first."""
    return np.where(votes == votes.max(1, keepdims=True), total, -np.inf).argmax(1)


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2


def has_letter(text: Column) -> Column:
    return F.coalesce(F.rlike(text, F.lit(r"\p{L}")), F.lit(False))


def _pack(v: np.ndarray) -> bytes:
    """Values and places of what is not zero."""
    at = np.flatnonzero(v)
    return v[at].astype(np.float32).tobytes() + at.astype(np.uint16).tobytes()


def _unpack(rows: list[bytes]) -> np.ndarray:
    x = np.zeros((len(rows), BUCKETS))
    for k, row in enumerate(rows):
        n = len(row) // 6
        x[k, np.frombuffer(row, np.uint16, n, 4 * n)] = np.frombuffer(row, np.float32, n)
    return x


def learn(labelled: DataFrame, sample: int = SAMPLE) -> Model | None:
    """A model from rows (id, text, lang) with a letter and a language; None if there are none."""
    # one key for rows that repeat an id with its text: they count, and are learned, once
    keyed = labelled.select("text", "lang", F.xxhash64("id", "text").alias("key"))
    counts = {r.lang: max(1, r.n) for r in keyed.groupBy("lang").agg(F.approx_count_distinct("key").alias("n")).collect()}
    if not counts:
        return None
    families: dict[str, list[str]] = {}
    for lang in sorted(counts):
        families.setdefault(family_of(lang), []).append(lang)
    votes = [sorted(families), *(families[f] for f in sorted(families))]  # the classes of each vote; the first is the families'

    slots = 1 << 30
    plan = []  # lang, rate of its rows, and their uses: vote, class, rate among the chosen
    for f, (family, langs) in enumerate(sorted(families.items())):
        share = max(LEAST, 2 * sample // len(langs))
        for k, lang in enumerate(langs):
            among = min(slots, slots * share // min(sample, counts[lang]) + 1)
            uses = [(0, f, among)] * (len(votes[0]) > 1) + [(f + 1, k, slots)] * (len(langs) > 1)
            plan.append((lang, min(slots, slots * sample // counts[lang] + 1), uses))
    machines: list[dict[tuple[int, int], np.ndarray]] = [{} for _ in votes]
    if any(uses for *_, uses in plan):
        use = "array<struct<vote: int, class: int, rate: long>>"
        plans = F.broadcast(labelled.sparkSession.createDataFrame(plan, f"lang string, rate long, uses {use}"))
        blocks = F.create_map(*[x for v, names in enumerate(votes) for x in (F.lit(v), F.lit((len(names) - 1) // BLOCK))])
        for r in _train(keyed, plans, blocks, slots).collect():  # rows: the weights
            machines[r.vote][r.a, r.b] = np.frombuffer(r.w)
    voters = [_Vote(names, m) for names, m in zip(votes, machines)]
    return Model(voters[0], dict(zip(votes[0], voters[1:])))


def _train(keyed: DataFrame, plans: DataFrame, blocks: Column, slots: int) -> DataFrame:
    """vote, a, b, w: a machine for each pair of classes a < b of a vote."""

    def draw(seed: int) -> Column:
        return F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(slots))

    def to_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, t in _small_chunks(batch.column(0)):
                rows = pa.array([_pack(v) for v in features(t)], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(i, j - i), batch.column(2).slice(i, j - i), rows], names=["lang", "key", "x"])

    def fit(t: pd.DataFrame) -> pd.DataFrame:
        t = t.sort_values(["class", "key", "x"], kind="stable")
        of, x = t["class"].to_numpy(), list(t.x)
        vote, p, q = (int(t[c].iloc[0]) for c in ("vote", "p", "q"))
        out = []
        for a, b in combinations(sorted(set(of.tolist())), 2):
            if a // BLOCK == p and b // BLOCK == q:
                rows = np.flatnonzero((of == a) | (of == b))
                w = train_svm(_unpack([x[k] for k in rows]), np.where(of[rows] == a, 1.0, -1.0))
                out.append((vote, a, b, w.tobytes()))
        return pd.DataFrame(out, columns=["vote", "a", "b", "w"])

    chosen = keyed.join(plans.select("lang", "rate"), "lang").where(draw(8) < F.col("rate")).dropDuplicates(["lang", "key"])
    rows = chosen.select("text", "lang", "key").mapInArrow(tidy(to_features), "lang string, key bigint, x binary")
    used = rows.join(plans.select("lang", F.inline("uses").alias("vote", "class", "use_rate")), "lang").where(draw(9) < F.col("use_rate"))
    block = F.floor(F.col("class") / BLOCK).cast("int")
    other = F.explode(F.sequence(F.lit(0), blocks[F.col("vote")]))
    tasks = used.select("vote", "class", "key", "x", block.alias("block"), other.alias("other"))
    tasks = tasks.select("vote", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"), "class", "key", "x")
    return tasks.groupBy("vote", "p", "q").applyInPandas(fit, "vote int, a int, b int, w binary")


def _small_chunks(column: pa.Array) -> Iterator[tuple[int, int, Texts]]:
    for a in range(0, len(column), TEXTS):
        for i, j, t in text_chunks(column.slice(a, TEXTS), BYTES):
            yield a + i, a + j, t


def with_language(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """The input's columns, lang_pred and score; columns of these names in the input are replaced."""
    from pyspark.sql import types as T

    docs = docs.drop("lang_pred", "score")
    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, t in _small_chunks(batch.column(batch.schema.get_field_index(text_col))):
                part = batch.slice(i, j - i)
                letter = part.column(part.num_columns - 1).to_numpy(zero_copy_only=False).astype(bool)
                lang, score = np.full(j - i, UND, object), np.zeros(j - i)
                if model is not None and letter.any():
                    got, sure = model.predict(features(t))
                    lang, score = np.where(letter, got, UND), np.where(letter, sure, 0.0)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(lang, pa.string()), pa.array(score)], names=[*part.schema.names[:-1], "lang_pred", "score"])

    # the last column, whatever others are named
    return docs.select("*", has_letter(F.col(text_col)).alias("__letter")).mapInArrow(tidy(run), T.StructType([*docs.schema.fields, *added]))


def labelled_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Rows to learn from: not held out, with a language and a letter."""
    d = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    return d.where(~held_out(F.col("id")) & F.col("lang").isNotNull() & has_letter(F.col("text")))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """id, held_out, lang_pred, score of every row, by a model of the labelled rows that are not held out."""
    model = learn(labelled_rows(docs, id_col, text_col, lang_col))
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return with_language(d, model).select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "lang_pred", "score")
