import random

import pytest
from pyspark.sql import types as T

WORDS = "the of and to in stone river window garden paper little yellow seven moon table carpet walking under over light".split()

# names that clash with columns the operators make
EXTRA = ("score", "lang_pred", "__size", "__copies", "ids", "kept", "n_bytes", "row", "rep", "key", "vec", "n")

DOC_SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType())]
    + [T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
    + [T.StructField(c, T.StringType()) for c in EXTRA]
)


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 300)) for _ in range(n))


@pytest.fixture(scope="session")
def doc_rows():
    """(doc_id, text, lang, source): near copies, chains, shared passages, and every odd case."""
    rng = random.Random(7)
    passage = prose(rng, 30)
    texts = [prose(rng, rng.randint(5, 120)) for _ in range(30)]
    base = prose(rng, 150).split()
    for k in range(25):  # near copies: a word or two changed
        w = list(base)
        w[rng.randrange(len(w))] = f"changed{k}"
        texts.append(" ".join(w))
    chain = prose(rng, 200).split()
    for k in range(6):  # each like the one before, the ends not alike
        w = chain[:]
        w[: 8 * k] = [f"c{j}" for j in range(8 * k)]
        texts.append(" ".join(w))
    texts += [prose(rng, 20) + " " + passage + " " + prose(rng, 20) for _ in range(5)]
    texts += [texts[3]] * 4 + [texts[3].upper()]
    texts += [None, "", " \n\t ", "one", "one two three", "ONE two three", "12 34 !!", "ünï cödé ß ÑÑ Σας <|endoftext|> don't\x1c \x85x", "a" * 60, "a" * 400, "line\nline\nline\nother " + "x y z " * 30]
    texts += ["é" * 70, "xé" + "é" * 70, passage, "lang " * 3000]
    rows = [(100 + 3 * i, t, ("en", "de", None)[i % 3], (None, "b", "a", "b")[i % 4]) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    rows += [(None, "a null id " + passage, "en", "a"), (None, texts[3], "en", "a"), (None, None, None, None), rows[0], rows[0], (rows[1][0], "another text under an id that repeats", "en", "b")]
    return rows


@pytest.fixture(scope="session")
def docs(spark, doc_rows):
    rows = [(i, t, lang, source, None if t is None else len(t), *("x",) * len(EXTRA)) for i, t, lang, source in doc_rows]
    return spark.createDataFrame(rows, DOC_SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
