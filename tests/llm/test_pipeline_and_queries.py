"""The pipeline stage by stage against plain versions, components, and the registered queries against SQL."""

import os
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from addrweave.llm.components import components
from addrweave.llm.shared import cut, passing

from tests.llm.test_documents import key, plain_groups, plain_removed, words

SF = "/root/testdata/sf0.001"


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 90), (90, 95), (95, 100), (7, 7), (None, 3), (200, 100)]
    d = spark.createDataFrame(links, "a long, b long")
    got = {r.id: r.component for r in components(d).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 95: 90, 100: 90, 200: 90}
    assert components(d.limit(0)).count() == 0


def test_stages(spark, docs, doc_rows):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "suffix_dedup", "mixing", "bpe"]
    stage = dict(corpus_pipeline.STAGES)
    d = cut(stage["language_id"](spark, docs, SF), "t")
    assert d.columns == docs.columns
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in d.collect()]
    letters = [r for r in doc_rows if r[1] and any(c.isalpha() for c in r[1])]
    assert set(rows) <= set(letters) and len(rows) >= 0.9 * len(letters)

    # every row under a number of its own: one of each component stays, with the smallest id
    numbered = [(n, r[1]) for n, r in enumerate(rows)]
    groups = {}
    for n, _, c, _ in plain_groups(numbered, 5, 80):
        groups.setdefault(c, []).append(rows[n])
    d = cut(stage["near_dedup"](spark, d, SF), "t")
    before, rows = rows, [(r.doc_id, r.text, r.lang, r.source) for r in d.collect()]
    assert d.columns == docs.columns and not Counter(rows) - Counter(before) and len(rows) == len(groups)
    smallest = [min((r[0] is None, r[0] or 0) for r in g) for g in groups.values()]
    assert Counter((r[0] is None, r[0] or 0) for r in rows) == Counter(smallest)
    assert any(len(g) > 1 and any(r[0] is None for r in g) for g in groups.values())

    removed = plain_removed(rows)
    d = cut(stage["suffix_dedup"](spark, d, SF), "t")
    assert d.columns == docs.columns and d.count() == len(rows)
    got = d.select("doc_id", F.sha2(F.col("text").cast("binary"), 256), "n_chars", F.length("text")).collect()
    whole = {(i, h) for i, _, _, _, h in removed}
    cut_chars = [r for r in got if (r[0], r[1]) not in whole]  # texts that lost part of a character
    assert all(r[2] == r[3] for r in got) and len(cut_chars) <= 3
    before = Counter((r.doc_id, r.text) for r in d.collect())

    d = cut(stage["mixing"](spark, d, SF), "t")
    after = Counter((r.doc_id, r.text) for r in d.collect())
    assert d.columns == docs.columns and set(after) <= set(before) and all(after[k] <= 2 * before[k] for k in after)
    size = sum(len(words(t)) * n for (_, t), n in before.items())
    assert sum(len(words(t)) * n for (_, t), n in after.items()) <= 2 * size

    last = stage["bpe"](spark, d, SF).collect()
    assert Counter(r.doc_id for r in last) == Counter(i for (i, _), n in after.items() for _ in range(n))
    assert all(len(r.ids) == 4 * r.n_tokens for r in last)


def test_near_dedup_leaves_its_result_only(spark, docs, tmp_path, monkeypatch):
    """Sketches, classes, buckets and texts of near_dedup are deleted before its rows are written: later stages have their disk."""
    from addrweave import session
    from addrweave.llm import shared

    made = []
    monkeypatch.setattr(shared, "scratch_path", lambda spark, name: made.append((name, session.scratch_path(spark, name))) or made[-1][1])
    d = corpus_pipeline.near_dedup(spark, docs, SF)
    there = [name for name, path in made if os.path.exists(path.removeprefix("file:"))]
    assert {"sketches", "class-sketches", "class-texts", "links"} <= {name for name, _ in made}
    assert sorted(there) == ["copies", "near-duplicates", "rows"]
    assert d.count() and cut(d, "t").count() == d.count()


def test_cut_tables_are_deleted_after_an_error_too(spark):
    with pytest.raises(ValueError), passing(spark):
        gone, stays = cut(spark.range(3), "a"), cut(spark.range(3), "b", stays=True)
        raise ValueError
    files = [Path(d.inputFiles()[0].removeprefix("file://")) for d in (stays, gone)]
    assert [f.exists() for f in files] == [True, False] and files[0].name.endswith(".zstd.parquet")
    assert cut(spark.range(3), "c").count() == 3  # tables outside stay


def test_one_row_of_each_group_stays(spark):
    """Rows that repeat an id or have none, and texts that share an id without being alike."""
    a, b = " ".join(f"word{k}" for k in range(40)), " ".join(f"other{k}" for k in range(40))
    rows = [(5, a), (5, a), (5, a), (9, a + " more"), (None, a), (None, b), (None, b), (5, b + " end"), (7, None), (7, None), (8, " "), (None, "")]
    d = spark.createDataFrame([(i, t, "x", "y", "z") for i, t in rows], "doc_id bigint, text string, row string, ROW_ string, component_id string").repartition(4)
    got = corpus_pipeline.near_dedup(spark, d, SF)
    assert got.columns == d.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=lambda r: (str(r[0]), str(r[1]))) == sorted(
        [(5, a), (5, b + " end"), (7, None), (7, None), (8, " "), (None, "")], key=lambda r: (str(r[0]), str(r[1]))
    )


def test_stages_of_nothing(spark, no_docs):
    d = no_docs
    for _, f in corpus_pipeline.STAGES:
        d = cut(f(spark, d, SF), "t")
        assert d.count() == 0


def test_run(spark):
    d = corpus_pipeline.run(spark, SF)
    assert d.count() > 0 and set(d.columns) >= {"doc_id", "n_tokens", "ids"}
    assert entry.queries()["pipeline"].__name__ == "run"


def test_one_query_for_each_operator():
    names = [q for q in entry.queries() if q.startswith("op")]
    assert sorted(int(q[2:].split("_")[0]) for q in names) == list(range(1, 14))


@pytest.mark.parametrize("name", ["op1_near_vectors", "op2_minhash", "op4_mixing", "op6_url_filters", "op7_quality_rules", "op10_suffix_array", "op11_periodic_runs", "op12_ranked_search", "op13_warc"])
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    cur = con.execute(entry.oracle_sql()[name])
    cols = [c[0] for c in cur.description]
    got = entry.queries()[name](spark, SF).select(*cols).collect()
    assert sorted(map(tuple, got), key=key) == sorted(cur.fetchall(), key=key)


def test_held_out_rules(spark):
    """The rule of the queries: CRC-32 of the id as text."""
    from addrweave.llm.langid import held_out as of_four
    from addrweave.llm.lm import held_out as of_ten

    for r in spark.range(200).select("id", of_four(F.col("id")).alias("four"), of_ten(F.col("id")).alias("ten")).collect():
        c = zlib.crc32(str(r.id).encode())
        assert (r.four, r.ten) == (c % 4 == 2, c % 10 == 0)
