"""DuckDB SQL for the operators that SQL can express, written independently of the Spark side."""

from __future__ import annotations

from addrweave.llm import mixing as M
from addrweave.llm import quality as Q
from addrweave.llm import urls as U

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def mixing() -> str:
    return f"""
WITH d AS (SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CAST([{", ".join(map(str, M.WEIGHTS))}][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(M.WEIGHTS)} + 1] AS BIGINT) AS weight,
      CAST(source_size * {M.MAX_REPEAT} AS DOUBLE) AS lim FROM s),
o AS (SELECT *, row_number() OVER (ORDER BY lim / weight, source NULLS LAST) AS r FROM w),
l AS (SELECT a.*, ((SELECT sum(source_size) FROM o) * CAST({M.SHARE} AS DOUBLE)
        - coalesce((SELECT sum(b.lim) FROM o b WHERE b.r < a.r), 0.0))
        / (SELECT sum(b.weight) FROM o b WHERE b.r >= a.r) AS here FROM o a),
t AS (SELECT source, source_size, least(lim, (SELECT max(here) FROM l) * weight) AS target FROM l),
p AS (SELECT d.doc_id, d.size, t.source_size, CAST(t.target AS DOUBLE) AS target,
        CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
        CAST(CAST('0x' || substr(md5('{M.SEED}:' || coalesce(CAST(d.doc_id AS VARCHAR), 'null')), 1, 15) AS BIGINT) AS DOUBLE) / {float(16**15)!r} AS draw
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  size * (CAST(floor(rate) AS BIGINT) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) AS taken
FROM p"""


def url_filters() -> str:
    def hit(term: str) -> str:
        return rf"regexp_matches(u, '(^|[^a-z0-9]){term}($|[^a-z0-9])')"

    strict = " OR ".join(hit(t) for t in U.STRICT_TERMS)
    soft = " + ".join(f"CASE WHEN {hit(t)} THEN {w} ELSE 0 END" for t, w in U.SOFT_TERMS.items())
    ordered = sorted(U.PATH_RULES, key=lambda r: -len(r.name))

    def fit(r: U.PathRule) -> str:
        return f"((host = '{r.host}' OR host LIKE '%.{r.host}') AND starts_with(path, '{r.path}'))"

    rule = " ".join(f"WHEN {fit(r)} THEN '{r.name}'" for r in ordered)
    by_rule = " ".join(f"WHEN {fit(r)} THEN '{r.verdict}'" for r in ordered)
    return rf"""
WITH p AS (SELECT page_id, translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS u,
    CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, u, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p)
SELECT page_id, host, path, CASE {rule} END AS rule,
  CASE {by_rule} WHEN {strict} OR ({soft}) >= {U.SOFT_LIMIT} THEN 'block' ELSE 'allow' END AS verdict
FROM h"""


def quality() -> str:
    stops = ", ".join(f"'{w}'" for w in Q.STOP_WORDS)
    rules = []
    for r in Q.RULES:
        sides = [f"{r.figure} {sign} {bound!r}" for sign, bound in ((">=", r.least), ("<=", r.most)) if bound is not None]
        rules.append(f"coalesce({' AND '.join(sides)}{f' OR {r.unless}' if r.unless else ''}, false)")
    return rf"""
WITH t AS (SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text, {_WORDS} AS ws,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls FROM documents),
g AS (SELECT row_id, i, ws[i:i + {Q.WINDOW - 1}] AS gram FROM (SELECT row_id, ws, unnest(range(1, len(ws) - {Q.WINDOW - 2})) AS i FROM t)),
c AS (SELECT row_id, i, count(*) OVER (PARTITION BY row_id, gram) AS n FROM g),
r AS (SELECT row_id, count(DISTINCT k) AS n_repeat_words FROM (SELECT row_id, unnest(range(i, i + {Q.WINDOW})) AS k FROM c WHERE n > 1) GROUP BY row_id),
f AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, len(list_filter(ws, lambda w: lower(w) IN ({stops}))) AS n_stop_words, len(ls) AS n_lines,
    length(regexp_replace(text, '[^{Q.UNLISTED}]', '', 'g')) AS n_unlisted, length(regexp_replace(text, '[^{Q.UNSPACED}]', '', 'g')) AS n_unspaced
  FROM t LEFT JOIN r USING (row_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND {" AND ".join(rules)} AS kept FROM b"""


def _components(nodes: str, links: str, node: str, name: str) -> str:
    """CTEs ``reach`` and ``comp`` (node, component): the smallest ``name`` reachable over ``links`` (a, b; both ways)."""
    return f"""
reach AS (SELECT {node} AS k, {node} AS m FROM {nodes} UNION SELECT reach.k, l.b FROM reach JOIN {links} l ON l.a = reach.m),
comp AS (SELECT reach.k, min(n.{name}) AS component_id FROM reach JOIN {nodes} n ON n.{node} = reach.m GROUP BY reach.k)"""


def near_vectors() -> str:
    fine = "list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))"
    return f"""
WITH RECURSIVE v AS (SELECT row_number() OVER () AS r, vec_id,
    CASE WHEN len({fine}) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0 THEN list_transform(embedding, lambda x: CAST(x AS DOUBLE)) END AS e FROM embeddings),
n AS (SELECT *, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS size FROM v WHERE e IS NOT NULL),
links AS (SELECT a.r AS a, b.r AS b FROM n a JOIN n b ON a.r <> b.r AND len(a.e) = len(b.e) AND list_inner_product(a.e, b.e) / (a.size * b.size) >= 0.95),
{_components("v", "links", "r", "vec_id").strip()}
SELECT vec_id, CAST((SELECT count(*) FROM links WHERE a = r) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN comp ON comp.k = v.r"""


def near_documents() -> str:
    words = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, {words} AS ws FROM documents),
s AS (SELECT doc_id, list_sort(CASE WHEN len(ws) >= 4 THEN list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')))
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS sh FROM d),
c AS (SELECT row_number() OVER () AS k, sh, len(sh) AS n, min(doc_id) AS first_id FROM s WHERE len(sh) > 0 GROUP BY sh),
u AS (SELECT k, n, unnest(sh) AS g FROM c),
half AS (SELECT a.k AS a, b.k AS b FROM u a JOIN u b ON a.g = b.g AND a.k < b.k GROUP BY a.k, b.k, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
links AS (SELECT a, b FROM half UNION ALL SELECT b, a FROM half),
{_components("c", "links", "k", "first_id").strip()}
SELECT doc_id, CAST(len(s.sh) AS BIGINT) AS n_shingles, coalesce(component_id, doc_id) AS component_id, doc_id = coalesce(component_id, doc_id) AS kept
FROM s LEFT JOIN c ON c.sh = s.sh LEFT JOIN comp ON comp.k = c.k"""


def shared_passages() -> str:
    return """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT r, doc_id, i, substr(h, CAST(2 * i + 1 AS BIGINT), 100) AS g FROM (SELECT r, doc_id, h, unnest(range(0, length(h) // 2 - 49)) AS i FROM d)),
o AS (SELECT g, min(doc_id) AS owner FROM w GROUP BY g HAVING min(doc_id) < max(doc_id)),
hit AS (SELECT r, i FROM w JOIN o USING (g) WHERE doc_id > owner),
part AS (SELECT r, i, sum(CASE WHEN i - before <= 50 THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY i) AS p
  FROM (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS before FROM hit)),
run AS (SELECT r, p, min(i) AS a, max(i) + 50 AS b FROM part GROUP BY r, p),
piece AS (SELECT r, p, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY p), 0) AS begins FROM run),
cut AS (SELECT d.r, sum(b - a) AS n_removed, count(*) AS n_spans,
    string_agg(substr(h, CAST(2 * begins + 1 AS BIGINT), CAST(2 * (a - begins) AS BIGINT)), '' ORDER BY p) || substr(any_value(h), CAST(2 * max(b) + 1 AS BIGINT)) AS kept
  FROM piece JOIN d USING (r) GROUP BY d.r)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(kept, h))) AS kept_sha256 FROM d LEFT JOIN cut USING (r)"""


def _crc32(text: str) -> str:
    """The CRC-32 of ``text`` (ASCII) byte by byte; wants the CTE ``crc_table``."""
    return (
        f"xor(list_reduce(list_transform(string_split({text}, ''), lambda x: CAST(ord(x) AS BIGINT)), "
        "lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), CAST(4294967295 AS BIGINT)), 4294967295)"
    )


_CRC_TABLE = """crc_table AS (SELECT list(list_reduce(range(8), lambda c, b: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS t
    FROM (SELECT unnest(range(256)) AS i))"""


def periodic_runs() -> str:
    """Every pair of equal words at every distance, as islands; meant for tables of some million words."""
    return f"""
WITH {_CRC_TABLE},
d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS ws FROM documents),
k AS (SELECT doc_id, {_crc32("CAST(doc_id AS VARCHAR)")} AS h FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL), crc_table),
g AS (SELECT r, d.doc_id, ws, CAST(len(ws) AS BIGINT) AS n, h % 10 = 0 AND len(ws) > 0 AS planted, h // 10 AS g FROM d LEFT JOIN k USING (doc_id)),
e AS (SELECT *, CASE WHEN planted THEN g % n END AS a FROM g),
p AS (SELECT r, doc_id, n, CASE WHEN planted THEN list_transform(range(n), lambda i: ws[CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END + 1]) ELSE ws END AS ws FROM e),
w AS (SELECT r, n, generate_subscripts(ws, 1) - 1 AS i, unnest(ws) AS word FROM p),
eq AS (SELECT x.r, y.i - x.i AS q, x.i FROM w x JOIN w y ON x.r = y.r AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
isle AS (SELECT r, q, min(i) AS start, count(*) + q AS length FROM (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS part FROM eq) GROUP BY r, q, part),
run AS (SELECT r, start, length, min(q) AS period FROM isle WHERE length >= greatest(6, 4 * q) GROUP BY r, start, length),
gone AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM run),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS text FROM w ANTI JOIN gone USING (r, i) GROUP BY r),
best AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY CAST(length AS DOUBLE) / period DESC, start, period) AS place FROM run),
lines AS (SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS text FROM run GROUP BY r)
SELECT doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(start AS BIGINT) AS start, CAST(length AS BIGINT) AS length, CAST(period AS BIGINT) AS period,
  CAST(1000 * length // period AS BIGINT) AS exponent_milli, sha256(coalesce(lines.text, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM p LEFT JOIN lines USING (r) LEFT JOIN kept USING (r) LEFT JOIN (SELECT * FROM best WHERE place = 1) USING (r)"""


def ranked_search() -> str:
    terms = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {terms} AS ts FROM documents),
f AS (SELECT * FROM d WHERE len(ts) > 0),
s AS (SELECT CAST(count(*) AS BIGINT) AS big_n, CAST(sum(len(ts)) AS BIGINT) AS big_l FROM f),
m AS (SELECT r, doc_id, 75 + (25 * len(ts) * big_n) // big_l AS m FROM f, s),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ts) AS term FROM f) GROUP BY r, term),
q AS (SELECT item, item_id, term, count(*) AS times FROM (SELECT row_number() OVER () AS item, item_id, unnest({terms}) AS term FROM benchmark) GROUP BY item, item_id, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(big_n) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, s WHERE term IN (SELECT term FROM q) GROUP BY term),
sc AS (SELECT item, item_id, m.r, m.doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM q JOIN w USING (term) JOIN tf USING (term) JOIN m ON m.r = tf.r GROUP BY item, item_id, m.r, m.doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM sc WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 20"""


def warc() -> str:
    return """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS size FROM pages),
s AS (SELECT html, max(page_id) AS stored FROM p WHERE size >= 1000 GROUP BY html)
SELECT page_id, CAST(size AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest,
  CASE WHEN stored IS NOT NULL AND stored IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN stored IS DISTINCT FROM page_id THEN stored END AS refers_to
FROM p LEFT JOIN s USING (html)"""
