"""Operators on documents against plain versions, odd cases included."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from addrweave.llm import lm, shared, suffix
from addrweave.llm.bpe import bpe_encode
from addrweave.llm.langid import features, identify, learn
from addrweave.llm.lm import MU, EliasFano, _hash_of, lm_scores
from addrweave.llm.mixing import draw, mix, mix_plan, source_targets
from addrweave.llm.quality import quality_rules
from addrweave.llm.queries import tokenizer_file
from addrweave.llm.setsketch import jaccard_estimate, merge, near_duplicates, registers
from addrweave.llm.shared import deal, text_chunks
from addrweave.llm.suffix import remove_shared
from addrweave.llm.token_file import TokenFile, read_token_files, write_token_files

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def words(text, lower=True):
    raw = (text or "").encode()
    return WORD.findall(raw.translate(LOWER) if lower else raw)


def key(row):
    return tuple((x is None, x if x is not None else 0) for x in row)


# ------------------------------------------------------------------ near duplicates


def plain_groups(rows, width, percent):
    sets = []
    for i, t, *_ in rows:
        w = words(t)
        s = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()
        sets.append((i, frozenset(s)))
    classes = {s for i, s in sets if i is not None and s}
    parent = {s: s for s in classes}

    def top(s):
        while parent[s] is not s:
            s = parent[s]
        return s

    order = list(classes)
    for a in range(len(order)):
        for b in range(a):
            x, y = order[a], order[b]
            if 100 * len(x & y) >= percent * len(x | y):
                parent[top(x)] = top(y)
    least = {}
    for i, s in sets:
        if i is not None and s:
            least[top(s)] = min(i, least.get(top(s), i))
    out = []
    for i, s in sets:
        c = least[top(s)] if i is not None and s else i
        out.append((i, len(s), c, i == c))
    return sorted(out, key=key)


@pytest.mark.parametrize("width", [4, 5])
def test_near_duplicates(docs, doc_rows, width):
    got = near_duplicates(docs, width=width, percent=80)
    assert sorted(map(tuple, got.collect()), key=key) == plain_groups(doc_rows, width, 80)


def test_registers_estimate_and_merge():
    rng = np.random.default_rng(1)
    for shared, own in ((800, 100), (300, 300), (5, 1), (1, 0)):
        h = [rng.integers(0, 1 << 63, k).astype(np.uint64) for k in (shared, own, own)]
        a, b = np.r_[h[0], h[1]], np.r_[h[0], h[2]]
        both = np.r_[h[0], h[1], h[2]]
        k = registers(np.r_[a, b, both], np.array([len(a), len(b), len(both)]), 1024)
        assert (merge(k[0], k[1]) == k[2]).all()
        j = jaccard_estimate(k[:1], k[1:2], np.array([float(len(a))]), np.array([float(len(b))]))[0]
        assert abs(j - shared / len(both)) < 0.08


def test_buckets_with_several_components(spark, monkeypatch):
    """Pairs that only the block comparison finds: every class leads a bucket of others."""
    from addrweave.llm import setsketch

    monkeypatch.setattr(setsketch, "BLOCK", 3)
    rng = np.random.default_rng(5)
    rows = []
    for g in range(6):
        base = [f"w{g}_{k}" for k in range(60)]
        for c in range(8):
            w = list(base)
            for _ in range(c // 2):
                w[int(rng.integers(60))] = f"n{g}_{c}"
            rows.append((g * 100 + c, " ".join(w)))
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=4, percent=80)
    assert sorted(map(tuple, got.collect()), key=key) == plain_groups(rows, 4, 80)


# ------------------------------------------------------------------ tokenizers


def test_bpe(docs, doc_rows):
    from tokenizers import Tokenizer

    path = tokenizer_file("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    got = sorted(((r.doc_id, bytes(r.ids), r.decoded) for r in bpe_encode(docs, path).collect()), key=key)
    want = []
    for i, x, *_ in doc_rows:
        ids = t.encode(x or "", add_special_tokens=False).ids
        want.append((i, np.array(ids, "<u4").tobytes(), t.decode(ids, skip_special_tokens=False)))
    assert got == sorted(want, key=key)


@pytest.mark.parametrize("text", ["a" * 5000, "abab" * 300, "</w>x</w>", "q\u0301\u0327 \u212b \ufb01 \u0130", "the" * 2000])
def test_bpe_words(text):
    from tokenizers import Tokenizer

    from addrweave.llm.bpe import WordPieces

    path = tokenizer_file("word_bpe_49k.json")
    ids = b"".join(map(WordPieces(path).__getitem__, text.encode().split()))
    assert np.frombuffer(ids, "<u4").tolist() == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def test_bpe_random_merges():
    """Any list of merges, those that make tokens which never occur included, against merging step by step."""
    import random

    from addrweave.llm.bpe import Merges

    rng = random.Random(0)
    for _ in range(150):
        tokens, merges = list("abc"), []
        vocab = {t: i for i, t in enumerate(tokens)}
        for _ in range(60):
            a, b = rng.choice(tokens), rng.choice(tokens)
            if a + b not in vocab and len(merges) < 25:
                vocab[a + b] = len(vocab)
                merges.append((a, b))
                tokens.append(a + b)
        m, rank = Merges(vocab, merges), {p: i for i, p in enumerate(merges)}
        for _ in range(30):
            text = "".join(rng.choice("abc") for _ in range(rng.randint(1, 25)))
            parts = list(text)
            while found := min(((rank[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in rank), default=None):
                i = found[1]
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            assert m.encode(text) == [vocab[t] for t in parts]


def test_byte_pieces():
    """Texts cut into pieces give the library's ids."""
    import random

    from tokenizers import Tokenizer

    from addrweave.llm.token_file import BytePieces

    path = tokenizer_file("byte_bpe_50k.json")
    pieces, t, rng = BytePieces(path), Tokenizer.from_file(path), random.Random(1)
    signs = "aZé ñ,.'!-—’\n\t  s d ll 3 ٣½_×÷\xa0 😀\x1c\x85$^`~[]{}|\\\"#<>"
    for _ in range(5000):
        text = "".join(rng.choice(signs) for _ in range(rng.randint(0, 14)))
        assert np.frombuffer(pieces.encode(text), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids


def test_token_files(docs, doc_rows, tmp_path):
    from tokenizers import Tokenizer

    path = tokenizer_file("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    coded = {x: t.encode(x or "", add_special_tokens=False).ids + [2] for _, x, *_ in doc_rows}
    manifest = write_token_files(docs, path, folder=str(tmp_path))
    got = sorted(read_token_files(manifest).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((i for i, *_ in doc_rows), key=lambda i: (i is not None, i))
    start = 0
    for r in got:
        ids = np.frombuffer(bytes(r.ids), "<u4").tolist()
        assert (r.start, r.n_tokens) == (start, len(ids))
        assert ids in [coded[x] for i, x, *_ in doc_rows if i == r.doc_id]
        start += len(ids)
    assert sorted(map(len, coded.values()))  # whole files, then any token and any run
    rng = np.random.default_rng(0)
    for row in manifest.collect():
        f = TokenFile(row.file)
        whole = f.tokens(0, f.n_tokens)
        assert [int(f.tokens(k, k + 1)[0]) for k in range(0, f.n_tokens, 97)] == whole[::97].tolist()
        for _ in range(20):
            a, b = sorted(rng.integers(0, f.n_tokens + 1, 2).tolist())
            assert (f.tokens(a, b) == whole[a:b]).all()


# ------------------------------------------------------------------ mixing


def test_mixing_targets(spark):
    def water(sizes, weights, share, most):
        total, target = share * sum(sizes), [0.0] * len(sizes)
        free = set(range(len(sizes)))
        while free:
            level = (total - sum(most * sizes[i] for i in range(len(sizes)) if i not in free)) / sum(weights[i] for i in free)
            full = {i for i in free if weights[i] * level > most * sizes[i]}
            if not full:
                break
            free -= full
        for i in range(len(sizes)):
            target[i] = weights[i] * level if i in free else float(most * sizes[i])
        return target

    for sizes in ([10, 20, 30, 40, 5], [1000, 1, 1, 1], [7], [0, 5, 9], [100] * 7):
        names = [f"s{i}" for i in range(len(sizes) - 1)] + [None]
        d = spark.createDataFrame(list(zip(names, sizes)), "__source string, __source_size long")
        got = {r["__source"]: r["__target"] for r in source_targets(d).collect()}
        want = water(sizes, [(3, 1, 2)[i % 3] for i in range(len(sizes))], 1.5, 2)
        assert [got[n] for n in names] == pytest.approx(want)


def test_mixing_copies(spark, docs, doc_rows):
    plan = mix_plan(docs).collect()
    assert len(plan) == len(doc_rows)
    sizes = Counter()
    for i, t, _, s in doc_rows:
        sizes[s] += len(words(t))
    for r in plan:
        assert r["__size"] == len(words(r.text)) and r["__source_size"] == sizes[r.source]
        rate = r["__target"] / r["__source_size"]
        assert r["__copies"] in (math.floor(rate), math.floor(rate) + 1) and r["__copies"] <= 2
    want = Counter((r.doc_id, r.text) for r in plan for _ in range(r["__copies"]))
    mixed = mix(docs)
    assert mixed.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in mixed.collect()) == want
    u = [r.u for r in spark.range(4000).select(draw(F.col("id")).alias("u")).collect()]
    assert 0 <= min(u) and max(u) < 1 and abs(np.mean(u) - 0.5) < 0.02


# ------------------------------------------------------------------ language model


def test_elias_fano():
    rng = np.random.default_rng(0)
    for n, u in ((0, 9), (1, 1), (900, 1000), (700, 1 << 40), (5000, 1 << 56)):
        v = np.unique(rng.integers(0, u, n)) if n else np.zeros(0, int)
        e = EliasFano.build(v, u)
        assert (e.access(np.arange(len(v))) == v).all()
        q = np.r_[v, rng.integers(0, u, 300)]
        f = e.find(q)
        assert all((k >= 0) == (x in set(v.tolist())) and (k < 0 or v[k] == x) for x, k in zip(q.tolist(), f.tolist()))


def test_lm_scores(docs, doc_rows):
    got = {(r.doc_id, r.n_tokens, round(r.base_score, 6)): r for r in lm_scores(docs).collect()}
    out = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 10 == 0
    uni, bi = Counter(), Counter()
    for i, t, *_ in doc_rows:
        if not out(i):
            w = [*words(t), None]
            uni.update(w)
            bi.update(zip([None, *w[:-1]], w))
    n, v = sum(uni.values()), len(uni)
    p = lambda w: (uni[w] + 0.1) / (n + 0.1 * (v + 1))
    for i, t, *_ in doc_rows:
        w = [*words(t), None]
        base = sum(math.log10(p(x)) for x in w)
        r = got[i, len(w), round(base, 6)]
        assert (r.held_out, r.n_known, r.train_tokens) == (out(i), sum(uni[x] > 0 for x in w), n)
        score = sum(math.log10((bi[c, x] + MU * p(x)) / (uni[c] + MU)) if uni[c] else math.log10(p(x)) for c, x in zip([None, *w[:-1]], w))
        assert abs(r.score - score) < 0.1 * len(w)  # 256 values hold the probabilities


def test_shards_are_dealt_to_their_own_tasks():
    """Only powers of two gave the shard back."""
    for tasks in (1, 2, 3, 7, 8, 12, 51, 200, 600, 4096, 99_999):
        shard = np.arange(tasks)
        assert [(t, of.tolist()) for t, of in deal(_hash_of(shard, tasks), tasks)] == [(t, [t]) for t in range(tasks)]


@pytest.mark.parametrize("shards", [1, 3, 12, 51])
def test_lm_scores_for_any_number_of_shards(spark, shards):
    """Level-2 shards were written under the numbers of others: bigrams were not found, and some shards raised an IndexError."""
    rnd = random.Random(7)
    rows = [(i, " ".join(f"w{int(300 * rnd.random() ** 3)}" for _ in range(rnd.randrange(60)))) for i in range(300)]
    uni, bi = Counter(), Counter()
    for i, t in rows:
        if zlib.crc32(str(i).encode()) % 10:
            w = [*words(t), None]
            uni.update(w)
            bi.update(zip([None, *w[:-1]], w))
    n, v = sum(uni.values()), len(uni)
    p = lambda w: (uni[w] + 0.1) / (n + 0.1 * (v + 1))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", shards)
    try:
        got = {r.doc_id: r.score for r in lm_scores(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for i, t in rows:
        w = [*words(t), None]
        score = sum(math.log10((bi[c, x] + MU * p(x)) / (uni[c] + MU)) if uni[c] else math.log10(p(x)) for c, x in zip([None, *w[:-1]], w))
        assert abs(got[i] - score) < 0.1 * len(w)  # 256 values hold the probabilities


def test_bigrams_of_many_chunks_are_looked_up_together(spark, monkeypatch):
    """Every chunk searched every shard, and all shards stayed mapped."""
    monkeypatch.setattr(lm, "OPEN", 2)
    rnd = random.Random(8)
    texts = [" ".join(f"w{int(200 * rnd.random() ** 2)}" for _ in range(rnd.randrange(40))) for _ in range(120)]
    train = spark.createDataFrame([(x,) for x in texts[:90]], "text string")
    v = lm.build_vocabulary(train)
    trie = lm.build_trie(train, v)
    chunks = [lm._bigrams(t) for _, _, t in text_chunks(pa.array(texts), 400)]
    assert len(chunks) > 20 and [len(g) for g in lm._groups(iter(chunks), lambda c: len(c.context))] == [len(chunks)]
    alone = [x for c in chunks for x in lm.score_chunks([c], v, trie)]
    searched = []
    find = EliasFano.find
    monkeypatch.setattr(EliasFano, "find", lambda *a: searched.append(1) or find(*a))
    together = list(lm.score_chunks(chunks, v, trie))
    assert len(searched) <= 3 * 8  # shards of the vocabulary, and twice of the trie
    assert len(v._open) <= 2 and len(trie._open) <= 2
    for a, b in zip(alone, together, strict=True):
        assert all((x == y).all() for x, y in zip(a, b, strict=True))


# ------------------------------------------------------------------ quality


def test_quality(docs, doc_rows):
    want = []
    for i, t, *_ in doc_rows:
        w = words(t, lower=False)
        grams = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        covered = {k + j for k in range(len(w) - 4) if grams[tuple(w[k : k + 5])] > 1 for j in range(5)}
        lines = [x for x in (t or "").split("\n") if words(x)]
        failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
        want.append((i, len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(covered), failed))
    cols = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    got = quality_rules(docs)
    assert sorted(map(tuple, got.select(*cols).collect()), key=key) == sorted(want, key=key)
    assert got.where("kept AND base_failed").count() == 0


def test_quality_rules_bite(spark):
    fine = "the river and the stone of a garden in the light of seven moons"
    rows = [(1, fine), (2, fine.replace(" ", "### ")), (3, " ".join("abcdefghijklmnopqrst" + str(k) for k in range(60))), (4, "x y z " + " ".join(f"{k}" for k in range(80)))]
    got = {r.doc_id: r.failed for r in quality_rules(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == [] and "symbols" in got[2] and {"word_length", "stop_words"} <= set(got[3]) and got[4]


def test_quality_keeps_clean_texts_of_other_languages(spark):
    """No clean text goes because of its language; word salad in the same scripts does."""
    clean = {
        "ru": "весной река поднимается и не сразу уходит с полей но люди знают что вода даст земле силу на всё лето как это было раньше",
        "tr": "bu köyde yaşayan insanlar için bahar çok güzel bir zamandır ve çocuklar bütün gün ile akşam arasında bahçede oynar",
        "ar": "يعيش الناس في هذا الوادي منذ زمن طويل وهم يعملون في الحقول من الصباح إلى المساء ثم يعودون إلى البيوت على ضوء القمر",
        "fi": "kevät tuli kylään myöhään mutta ihmiset tiesivät että aurinko palaa ja joki sulaa kun tuuli kääntyy etelään se oli selvää",
        "hi": "गाँव के लोग सुबह से खेत में काम करते हैं और शाम को नदी के किनारे बैठकर पुरानी बातें याद करते हैं यह अच्छा है",
        "vi": "người dân trong làng làm việc từ sáng đến tối và trẻ em chơi bên bờ sông khi trời không có mưa",
        "ko": "마을 사람들은 아침부터 저녁까지 들판에서 일하고 아이들은 강가에서 놀며 밤이 되면 모두 집으로 돌아와 이야기를 나눈다",
        "ta": "கிராமத்து மக்கள் காலை முதல் மாலை வரை வயலில் வேலை செய்கிறார்கள் குழந்தைகள் ஆற்றங்கரையில் விளையாடுகிறார்கள் இரவு வீடு திரும்புகிறார்கள் கதைகள் சொல்கிறார்கள்",
        "th": "\n".join(f"ชาวบ้านทำงานในทุ่งนาตั้งแต่เช้าจนถึงเย็นทุกวันบรรทัดที่{k}" for k in "กขคงจฉชซญดตถ"),
        "zh": "\n".join(f"村里的人们从早到晚在田里劳动孩子们在河边玩耍第{k}天" for k in "一二三四五六七八九十百千"),
    }
    salad = {"salad-ru": " ".join(f"кра{a}ло{b}" for a in "бвгджзкл" for b in "бвгджзкл"), "salad-la": " ".join(f"kra{a}lo{b}" for a in "bcdfghjk" for b in "bcdfghjk")}
    rows = list((clean | salad).items())
    got = {r.doc_id: r.failed for r in quality_rules(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    assert {k: got[k] for k in clean} == {k: [] for k in clean}
    assert all(got[k] == ["stop_words"] for k in salad), got


def test_quality_sql_agrees_on_other_scripts(spark):
    """The SQL's verdicts on texts beside, at and beyond half of a script without a list."""
    import duckdb

    from addrweave.llm import oracle

    rows = [(i, " ".join(["한국어"] * i + [f"krab{c}" for c in "abcdefghijklmnopqrstuvwxyz"] * 4 + ["ไทยภาษาที่ไม่มีช่องว่างระหว่างคำ"] * (i // 3))) for i in range(0, 240, 7)]
    want = duckdb.connect()
    documents = pd.DataFrame(rows, columns=["doc_id", "text"])  # noqa: F841
    sql = want.execute(oracle.quality()).df()
    got = quality_rules(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "kept").collect()
    assert {r.doc_id: r.kept for r in got} == dict(zip(sql.doc_id, sql.kept, strict=True))


@pytest.mark.parametrize("percent", [79, 50])
def test_near_duplicates_refuse_smaller_thresholds(docs, percent):
    with pytest.raises(ValueError, match="80"):
        near_duplicates(docs, percent=percent)


# ------------------------------------------------------------------ language id


def test_language_id(spark, docs):
    rng = np.random.default_rng(3)
    parts = {"en": "th er on an ing the ly", "de": "sch ein en ung ge ich ß", "fr": "eau ou é ai ment que è", "es": "ción os ado la ñ ar el", "xx": "kk zz qu vv"}
    rows = []
    for i in range(1500):
        lang = list(parts)[i % 5]
        p = parts[lang].split()
        text = " ".join("".join(rng.choice(p, rng.integers(1, 4))) for _ in range(rng.integers(3, 30)))
        rows.append((i, text, lang))
    rows += [(9001, None, "en"), (9002, "", "en"), (9003, "123 !?", "en"), (None, "ein sch ung", None)]
    got = {r.doc_id: r for r in identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    held = [(i, lang) for i, t, lang in rows[:1500] if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(got[i].held_out for i, _ in held)
    assert np.mean([got[i].lang_pred == lang for i, lang in held]) > 0.97
    assert all((got[i].lang_pred, got[i].score) == ("und", 0.0) for i in (9001, 9002, 9003))
    assert got[None].lang_pred == "de" and all(0 <= r.score <= 1 for r in got.values())
    assert identify(docs).count() == docs.count()
    alone = identify(docs.withColumn("lang", F.lit("en"))).where("lang_pred != 'und'")
    assert {(r.lang_pred, r.score) for r in alone.collect()} == {("en", 1.0)}
    assert identify(docs.withColumn("lang", F.lit(None).cast("string"))).where("lang_pred != 'und'").count() == 0


def test_every_language_is_learned(spark):
    """More labels than 64, noisy ones, and rows of one id (null) whose copies outnumber all others."""
    rng = np.random.default_rng(5)
    labels = [f"{a}{b}-{k}" for a, b in "xa xb xc xd xe xf xg xh xi xj xk xl xm xn".split() for k in range(5)] + ["EN", "en-US"]
    parts = {lang: ["".join(chr(c) for c in rng.integers(97, 123, 3)) for _ in range(6)] for lang in labels}
    rows = [(72 * i + k, " ".join(rng.choice(parts[lang], 12)), lang) for i in range(16) for k, lang in enumerate(labels)]
    copies = [(None, rows[0][1], labels[0])] * 4000
    table = spark.createDataFrame(rows + copies, "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in identify(table).where("doc_id is not null").collect()}
    assert set(got.values()) == set(labels)
    assert np.mean([got[i] == lang for i, _, lang in rows]) > 0.95


def test_rare_rows_beside_copies_are_learned(spark):
    """A sample of few: copies of a row take one place in it, whatever their number."""
    words = {"en": "the and of river", "fr": "les et de rivière", "de": "der und von fluss"}
    rows = [(i, f"{words[lang]} {i}", lang) for i in range(300) for lang in words]
    rows += [(None, "und und und", "de")] * 20000
    model = learn(spark.createDataFrame(rows, "id long, text string, lang string"), sample=20)
    assert model.languages["germanic"].names == ["de", "en"] and model.families.names == ["germanic", "romance"]
    (_, _, t), = text_chunks(pa.array([words[k] for k in words]), 1 << 19)
    assert list(model.predict(features(t))[0]) == list(words)


# ------------------------------------------------------------------ shared passages


def plain_removed(rows):
    owner = {}
    big = float("inf")
    raw = [(i, (t or "").encode()) for i, t, *_ in rows]
    for i, b in raw:
        for k in range(len(b) - 49):
            owner[b[k : k + 50]] = min(owner.get(b[k : k + 50], big), big if i is None else i)
    out = []
    for i, b in raw:
        gone = bytearray(len(b))
        for k in range(len(b) - 49):
            if owner[b[k : k + 50]] < (big if i is None else i):
                gone[k : k + 50] = b"\x01" * 50
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), len(re.findall(rb"\x01+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=key)


@pytest.mark.parametrize("hot", [256, 1])
def test_remove_shared(docs, doc_rows, hot, monkeypatch):
    from addrweave.llm import suffix

    monkeypatch.setattr(suffix, "UNIT_BYTES", 4000)
    d = remove_shared(docs, hot=hot)
    got = d.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()
    assert sorted(map(tuple, got), key=key) == plain_removed(doc_rows)
    assert d.where("text IS NULL").count() == sum(t is None for _, t, *_ in doc_rows)


def test_remove_shared_random(spark):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(120):
        size = int(rng.integers(0, 400))
        rows.append((int(rng.integers(0, 100)), "".join(rng.choice(list("ab"), size, p=[0.97, 0.03]))))
    got = remove_shared(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert sorted(map(tuple, got.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()), key=key) == plain_removed(rows)


# ------------------------------------------------------------------ empty tables


def test_empty_tables(no_docs, tmp_path):
    assert near_duplicates(no_docs).count() == 0
    assert bpe_encode(no_docs, tokenizer_file("word_bpe_49k.json")).count() == 0
    assert mix_plan(no_docs).count() == 0 and mix(no_docs).count() == 0
    assert lm_scores(no_docs).count() == 0
    assert quality_rules(no_docs).count() == 0
    assert identify(no_docs).count() == 0
    assert read_token_files(write_token_files(no_docs, tokenizer_file("byte_bpe_50k.json"), folder=str(tmp_path))).count() == 0
    assert remove_shared(no_docs).count() == 0


def test_a_chunk_of_spans_is_small():
    """Several workers stand beside the JVM of an executor: 4 MB of texts are never held as 64-bit arrays at once."""
    import tracemalloc

    rng = random.Random(3)
    texts = pa.array(["".join(rng.choices("abcdefgh ", k=20_000)) for _ in range(200)])
    tracemalloc.start()
    n = 0
    for _, _, t in text_chunks(texts, suffix.CHUNK):
        n += len(suffix.Spans.of(t).first)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n > 0 and peak < 48 << 20


def test_tables_of_another_operator_are_freed():
    shared.kept("one", "table", lambda: [1])
    list(shared.tidy(iter, "one")([]))
    assert shared.kept("one", "table", lambda: [2]) == [1]
    list(shared.tidy(iter)([]))  # another operator's task in the same worker
    assert shared.kept("one", "table", lambda: [2]) == [2]
    shared.give_up()
