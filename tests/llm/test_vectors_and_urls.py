"""Threshold pairs of vectors and the URL filter against plain versions."""

import math
import re

import numpy as np
import pytest

from addrweave.llm.covertree import Tree, build_tree, near_vectors, traverse
from addrweave.llm.urls import SOFT_TERMS, STRICT_TERMS, forms_of, judge_urls


def plain_links(rows, cosine):
    """(id, n_links, component, kept) of rows (id, vector); vectors that link with nothing included."""

    def fine(v):
        return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    unit = [np.array(v) / np.linalg.norm(v) if fine(v) else None for _, v in rows]
    links = [[b for b in range(len(rows)) if b != a and unit[a] is not None and unit[b] is not None and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= cosine] for a in range(len(rows))]
    out, seen = [None] * len(rows), set()
    for a in range(len(rows)):
        if a in seen:
            continue
        group, todo = {a}, [a]
        while todo:
            for b in links[todo.pop()]:
                if b not in group:
                    group.add(b)
                    todo.append(b)
        seen |= group
        least = min((rows[b][0] for b in group if rows[b][0] is not None), default=None)
        for b in group:
            out[b] = (rows[b][0], len(links[b]), least, rows[b][0] == least)
    return sorted(out, key=lambda r: tuple((x is None, x or 0) for x in r))


def test_near_vectors(spark, monkeypatch):
    from addrweave.llm import covertree

    monkeypatch.setattr(covertree, "BLOCK", 60)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(25, 8))
    rows = []
    for i in range(260):
        v = centres[i % 25 if i > 80 else 0] + rng.normal(size=8) * rng.choice([0.0, 0.03, 0.2])
        rows.append((1000 - i, [float(x) for x in np.round(v, 6)]))
    rows += [(1, None), (2, []), (3, [0.0] * 8), (4, [1.0, None] + [0.0] * 6), (5, [float("nan")] + [1.0] * 7), (6, [float("inf")] + [1.0] * 7)]
    rows += [(7, [1.0, 0.0]), (8, [2.0, 0.0]), (None, [3.0, 0.0]), (9, [1.0]), (None, [0.0, 1.0]), rows[5], (rows[6][0], rows[7][1])]
    d = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], "vec_id long, embedding array<double>, vec string, point string")
    got = [tuple(r) for r in near_vectors(d.repartition(3), cosine=0.95).collect()]
    assert sorted(got, key=lambda r: tuple((x is None, x or 0) for x in r)) == plain_links(rows, 0.95)
    assert near_vectors(d.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(12))
def test_trees(seed):
    rng = np.random.default_rng(seed)
    dim, n = int(rng.integers(2, 20)), int(rng.integers(2, 300))
    x = rng.normal(size=(n, dim)) * rng.uniform(0.02, 2) + rng.normal(size=dim)
    x[: n // 3] = x[0] + rng.normal(size=(n // 3, dim)) * rng.choice([0, 0.01, 0.1, 0.3])
    x = np.unique(x / np.linalg.norm(x, axis=1, keepdims=True), axis=0)
    rng.shuffle(x)
    w, c = rng.integers(1, 4, len(x)), float(rng.choice([0.5, 0.8, 0.95, 0.99]))
    near = x @ x.T >= c
    np.fill_diagonal(near, False)
    limit = math.sqrt(2 - 2 * c)
    half = len(x) // 2
    trees = []
    for rows in (np.arange(half), np.arange(half, len(x))):
        if len(rows):
            order, nodes = build_tree(x[rows], limit)
            for k in range(len(nodes["radius"])):  # radii cover, children halve and are nested
                inside = x[rows][order][nodes["start"][k] : nodes["end"][k]]
                assert np.linalg.norm(inside - x[rows][order][nodes["centre"][k]], axis=1).max() <= nodes["radius"][k] + 1e-6
            trees.append(Tree(x[rows][order], rows[order], w[rows][order], nodes))
    n_links = np.zeros(len(x), int)
    for a in range(len(trees)):
        for b in range(a, len(trees)):
            found = traverse(trees[a], trees[b], c)
            np.add.at(n_links, found.point.to_numpy(), found.n.to_numpy())
    assert (n_links == near @ w).all()


def test_urls(spark):
    rows = [
        (1, "http://www.Example.NET/en/x?y", "www.example.net", "/en/x", "example.net/en/", "allow"),
        (2, "https://a.net/de/", "a.net", "/de/", "net/", "block"),
        (3, "https://a.net", "a.net", "", None, "allow"),
        (4, "https://example.com/de/casino", "example.com", "/de/casino", "example.com/de/", "block"),
        (5, "https://notexample.com/de/", "notexample.com", "/de/", None, "allow"),
        (6, "https://x.org/fr/porn", "x.org", "/fr/porn", "org/fr/", "allow"),
        (7, "https://x.org/en/porn", "x.org", "/en/porn", None, "block"),
        (8, "https://x.org/en/pornography", "x.org", "/en/pornography", None, "allow"),
        (9, "https://x.org/free-casino", "x.org", "/free-casino", None, "block"),
        (10, "https://x.org/free-free", "x.org", "/free-free", None, "allow"),
        (11, "https://x.org/FREE#Casino", "x.org", "/FREE", None, "block"),
        (12, None, "", "", None, "allow"),
        (13, "", "", "", None, "allow"),
        (14, "no scheme casino poker", "", "", None, "block"),
        (None, "x://net/", "net", "/", "net/", "block"),
        (15, "http://h?q=://a.net/", "h", "", None, "allow"),
        (15, "http://h?q=://a.net/", "h", "", None, "allow"),
        (16, "a\n://b.net/\nc?d", "b.net", "/\nc", "net/", "block"),
        (17, "http://x.org/" + "a/" * 20000 + "xxx", "x.org", "/" + "a/" * 20000 + "xxx", None, "block"),
    ]
    d = spark.createDataFrame([(i, u, "h", "v") for i, u, *_ in rows], "page_id long, url string, host string, verdict string")
    got = judge_urls(d).select("page_id", "host", "path", "rule", "verdict").collect()
    order = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(map(tuple, got), key=order) == sorted(((i, h, p, r, v) for i, _, h, p, r, v in rows), key=order)
    assert judge_urls(d.limit(0)).count() == 0


def test_url_vocabulary(spark):
    """Hosts that are in none of the tables: each family blocks, ordinary addresses pass, forms of one entry count once."""
    junk = """casinos-royal.test/x gambling.test online-betting.test best-bets.test/bonus poker-room.test lotto-odds.test spammer.test/a
        spam.test/list adserver.test/p?x=1 ads.trackers.test banner-ads.test/ porno.test escorts.city.test nude-dating.test cialis.test
        pills-pharmacy.test xanax.test/buy payday-loans.test keygens.test viagra.test/FREE""".split()
    fine = """bank.test/loans/personal-loan news.test/story?ad=5&tracking=1 city.test/adults/adult-education museum.test/free shop.test/download/downloads radio.test/track/tracks
        race.test/track alphabet.test/between/betray spamalot.test/tickets adsorption.test/tracking newyork.test/windows/win wiki.test/pornography
        library.test/pharmacy/pharmacies sussex.test/sex""".split()
    d = spark.createDataFrame([(i, "https://" + u) for i, u in enumerate(junk + fine)], "page_id long, url string")
    got = {(junk + fine)[r.page_id]: r.verdict for r in judge_urls(d, rules=()).collect()}
    assert {u: got[u] for u in junk} == dict.fromkeys(junk, "block")
    assert {u: got[u] for u in fine} == dict.fromkeys(fine, "allow")


def test_url_terms_file():
    """Entries are words of their own; none stands twice."""
    forms = [f for t in (*STRICT_TERMS, *SOFT_TERMS) for f in forms_of(t)]
    assert all(re.fullmatch("[a-z0-9]+", f) for f in forms) and len(forms) == len(set(forms))
    assert {1, 2} <= set(SOFT_TERMS.values())
