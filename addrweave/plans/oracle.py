"""DuckDB SQL that recomputes every registered query independently of the Spark code.

Geometry is not shared with the Spark side: the fixture squares are axis-aligned,
so distances use closed forms (point-to-box, point-to-box-boundary); lines that are
not boxes (bowties) go through a generic edge table and a point-to-segment formula.
"D3"/"D5" picks are ``row_number`` windows here (the Spark side uses ``min_by``).
"""

from __future__ import annotations

from addrweave.functions.geo import M_PER_DEG
from addrweave.sources.area import parse_wkt_area
from addrweave.sources.fixtures import BLOCK_DEG, BOUNDS_WIDE, SAMPLE_STRIP_KEYS, STRIP_FILE_LINES, fixture_sql_for, holed_bounds

MD = f"{M_PER_DEG!r}e0" if "e" not in repr(M_PER_DEG) else repr(M_PER_DEG)


def _bounds(wkt: str) -> tuple[str, str, str, str]:
    x0, y0, x1, y1 = parse_wkt_area(wkt).bbox
    return tuple(f"{v!r}e0" for v in (x0, y0, x1, y1))  # type: ignore[return-value]


def _tags(pairs: list[tuple[str, str]]) -> str:
    """Sorted ``k=v;...`` text from (key, SQL expression) pairs; NULL values dropped."""
    items = ", ".join(f"'{k}=' || ({e})" for k, e in pairs)
    return f"array_to_string(list_sort(list_filter([{items}], lambda x: x IS NOT NULL)), ';')"


def _d_point(px: str, py: str, qx: str, qy: str) -> str:
    return f"sqrt(power(({qy} - {py}) * {MD}, 2) + power(({qx} - {px}) * cos(radians({py})) * {MD}, 2))"


def _d_box(px: str, py: str, cx: str, cy: str, h: str) -> str:
    """Point to the filled axis-aligned box (0 inside)."""
    return (
        f"sqrt(power(greatest(abs({py} - {cy}) - {h}, 0) * {MD}, 2)"
        f" + power(greatest(abs({px} - {cx}) - {h}, 0) * cos(radians({py})) * {MD}, 2))"
    )


def _d_box_edge(px: str, py: str, cx: str, cy: str, h: str) -> str:
    """Point to the boundary of the box."""
    inside = f"(abs({px} - {cx}) <= {h} AND abs({py} - {cy}) <= {h})"
    return (
        f"CASE WHEN {inside} THEN least(({h} - abs({py} - {cy})) * {MD},"
        f" ({h} - abs({px} - {cx})) * cos(radians({py})) * {MD}) ELSE {_d_box(px, py, cx, cy, h)} END"
    )


def _d_seg(px: str, py: str, ax: str, ay: str, bx: str, by: str) -> str:
    """Point to segment in the local plane at the point."""
    kx = f"(cos(radians({py})) * {MD})"
    Ax, Ay = f"(({ax}) - ({px})) * {kx}", f"(({ay}) - ({py})) * {MD}"
    Bx, By = f"(({bx}) - ({px})) * {kx}", f"(({by}) - ({py})) * {MD}"
    dx, dy = f"(({Bx}) - ({Ax}))", f"(({By}) - ({Ay}))"
    dd = f"({dx} * {dx} + {dy} * {dy})"
    t = f"(CASE WHEN {dd} > 0 THEN greatest(0, least(1, -(({Ax}) * {dx} + ({Ay}) * {dy}) / {dd})) ELSE 0 END)"
    return f"sqrt(power(({Ax}) + {t} * {dx}, 2) + power(({Ay}) + {t} * {dy}, 2))"


def _cm(expr: str) -> str:
    return f"CAST(round(({expr}) * 100) AS BIGINT)"


def base_ctes(bounds: str = BOUNDS_WIDE, nocity: float = 5.0, buffer: float = 0.5, building: float = 10.0,
              semantics: str = "as_coded") -> str:
    x0, y0, x1, y1 = _bounds(bounds)

    def in_block(x: str) -> str:
        """Degrees east of the block's western edge: the area has one strip for each block of the lattice."""
        return f"(({x} - ({x0})) - {BLOCK_DEG!r}e0 * floor(({x} - ({x0})) / {BLOCK_DEG!r}e0))"

    strip = sorted(set(SAMPLE_STRIP_KEYS) | {"created_by", "odbl", "odbl:note"})
    strip_list = "[" + ", ".join(f"'{k}'" for k in strip) + "]"
    sw = "cx - half, cy - half"
    se = "cx + half, cy - half"
    ne = "cx + half, cy + half"
    nw = "cx - half, cy + half"
    shape_pts = {
        "square": [sw, se, ne, nw, sw],
        "bowtie": [sw, ne, se, nw, sw],
        "line": [sw, ne],
        "half_se": [sw, se, ne],
        "half_nw": [ne, nw, sw],
    }
    vert_rows = []
    edge_rows = []
    for shape, pts in shape_pts.items():
        for pos, p in enumerate(pts):
            vert_rows.append(f"SELECT id, {pos} AS pos, {p.split(', ')[0]} AS vx, {p.split(', ')[1]} AS vy FROM fx_ways WHERE shape = '{shape}'")
        for a, b in zip(pts[:-1], pts[1:]):
            ax, ay = a.split(", ")
            bx, by = b.split(", ")
            edge_rows.append(
                f"SELECT type, id, {ax} AS ax, {ay} AS ay, {bx} AS bx, {by} AS by FROM area_feats WHERE shape = '{shape}'"
            )
    def node_case(p: str) -> str:
        lists = {
            "square": [0, 1, 2, 3, 0],
            "bowtie": [0, 1, 2, 3, 0],
            "line": [0, 1],
            "half_se": [0, 1, 2],
            "half_nw": [0, 1, 2],
        }
        whens = " ".join(
            f"WHEN {p}shape = '{sh}' THEN [" + ", ".join(f"{p}id * 10 + {k}" for k in ks) + "]" for sh, ks in lists.items()
        )
        return f"CASE {whens} END"

    nv_case = "CASE " + " ".join(f"WHEN shape = '{s}' THEN {len(p)}" for s, p in shape_pts.items()) + " END"
    intended = semantics == "intended"
    city_cond = "AND f.city IS NULL" if intended else ""
    j9_id = "" if intended else "AND n.id <> b.id"
    j10 = (
        f"""AND NOT EXISTS (SELECT 1 FROM area_near an WHERE an.import_id = c.import_id
                 AND NOT (an.type = c.type AND an.id = c.id))"""
        if intended
        else ""
    )
    bld_types = "('W', 'M')" if intended else "('W')"
    return f"""
WITH
fx_import AS ({fixture_sql_for("fx_import")}),
fx_nodes AS ({fixture_sql_for("fx_nodes")}),
fx_ways AS ({fixture_sql_for("fx_ways")}),
fx_relations AS ({fixture_sql_for("fx_relations")}),
fx_members AS ({fixture_sql_for("fx_relation_members")}),
imp AS (
  SELECT CAST(import_id AS INTEGER) AS import_id, lon, lat, hn, street, city, note,
         {_tags([("addr:housenumber", "hn"), ("addr:street", "street"), ("addr:city", "city"), ("note", "note")])} AS tags_text
  FROM fx_import),
ln AS (SELECT * FROM fx_nodes WHERE lon >= {x0} AND {in_block("lon")} <= {x1} - {x0} AND lat BETWEEN {y0} AND {y1}),
lw AS (SELECT * FROM fx_ways WHERE cx + half >= {x0} AND {in_block("cx + half")} <= {x1} - {x0} + 2 * half AND cy + half >= {y0} AND cy - half <= {y1}),
way_verts AS ({" UNION ALL ".join(vert_rows)}),
mp_parts AS (
  SELECT m.relation_id, m.sequence_id, w.id AS way_id, w.cx, w.cy, w.half
  FROM fx_members m JOIN lw w ON w.id = m.member_id AND m.member_type = 'W'
  JOIN fx_relations r ON r.id = m.relation_id AND r.rel_type = 'multipolygon'),
mp_verts AS (
  SELECT p.relation_id, p.sequence_id, v.pos, v.vx, v.vy,
         lag(v.vx) OVER (PARTITION BY p.relation_id ORDER BY p.sequence_id, v.pos) AS px,
         lag(v.vy) OVER (PARTITION BY p.relation_id ORDER BY p.sequence_id, v.pos) AS py
  FROM mp_parts p JOIN way_verts v ON v.id = p.way_id),
mp_line AS (
  SELECT relation_id,
         count(*) AS n_vertices,
         arg_min(vx, sequence_id * 1000 + pos) AS first_lon, arg_min(vy, sequence_id * 1000 + pos) AS first_lat,
         arg_max(vx, sequence_id * 1000 + pos) AS last_lon, arg_max(vy, sequence_id * 1000 + pos) AS last_lat
  FROM mp_verts
  WHERE NOT (pos = 0 AND sequence_id > (SELECT min(sequence_id) FROM mp_parts q WHERE q.relation_id = mp_verts.relation_id)
             AND vx = px AND vy = py)
  GROUP BY relation_id),
lmp AS (
  SELECT r.id, r.version, r.rel_type, r.building, r.hn, r.street,
         any_value(p.cx) AS cx, any_value(p.cy) AS cy, any_value(p.half) AS half, count(*) AS n_ways
  FROM fx_relations r JOIN mp_parts p ON p.relation_id = r.id
  GROUP BY r.id, r.version, r.rel_type, r.building, r.hn, r.street),
la AS (
  SELECT 'N' AS type, CAST(id AS BIGINT) AS id, hn, street, city, NULL AS building, NULL AS highway, NULL AS rel_type,
         created_by, note, lon AS cx, lat AS cy, 0.0e0 AS half, 'point' AS shape, 1 AS n_vertices
  FROM ln
  UNION ALL
  SELECT 'W', CAST(id AS BIGINT), hn, street, NULL, building, highway, NULL, NULL, NULL, cx, cy, half, shape, {nv_case}
  FROM lw
  UNION ALL
  SELECT 'M', CAST(l.id AS BIGINT), hn, street, NULL, building, NULL, rel_type, NULL, NULL, cx, cy, half, 'square', m.n_vertices
  FROM lmp l JOIN mp_line m ON m.relation_id = l.id),
la_tags AS (
  SELECT *, {_tags([("addr:housenumber", "hn"), ("addr:street", "street"), ("addr:city", "city"), ("building", "building"),
                    ("highway", "highway"), ("type", "rel_type"), ("created_by", "created_by"), ("note", "note")])} AS tags_text,
         {_tags([("addr:housenumber", "hn"), ("addr:street", "street"), ("addr:city", "city"), ("building", "building"),
                 ("highway", "highway"), ("type", "rel_type"), ("created_by", "CASE WHEN list_contains(" + strip_list + ", 'created_by') THEN NULL ELSE created_by END"), ("note", "note")])} AS stripped_text
  FROM la),
dups AS (
  SELECT i.* FROM imp i
  WHERE EXISTS (SELECT 1 FROM la f WHERE f.hn = i.hn AND f.street = i.street AND f.city = i.city)),
pool AS (
  SELECT i.* FROM imp i
  WHERE NOT EXISTS (SELECT 1 FROM la f WHERE f.hn = i.hn AND f.street = i.street AND f.city = i.city)),
nocity_pairs AS (
  SELECT i.import_id, f.type, f.id,
         CASE WHEN f.type = 'N' THEN {_d_point("i.lon", "i.lat", "f.cx", "f.cy")}
              ELSE {_d_box_edge("i.lon", "i.lat", "f.cx", "f.cy", "f.half")} END AS dist,
         {_tags([("addr:housenumber", "coalesce(f.hn, i.hn)"), ("addr:street", "coalesce(f.street, i.street)"),
                 ("addr:city", "coalesce(f.city, i.city)"), ("building", "f.building"), ("highway", "f.highway"),
                 ("type", "f.rel_type"), ("created_by", "f.created_by"), ("note", "coalesce(f.note, i.note)")])} AS tags_text,
         coalesce(f.hn, i.hn) AS m_hn, coalesce(f.street, i.street) AS m_street, coalesce(f.city, i.city) AS m_city,
         f.building AS m_building, f.highway AS m_highway, f.rel_type AS m_type, f.created_by AS m_created_by,
         coalesce(f.note, i.note) AS m_note
  FROM pool i JOIN la f ON f.hn = i.hn AND f.street = i.street {city_cond}),
nocity_pairs_in AS (SELECT * FROM nocity_pairs WHERE dist <= {nocity!r}e0),
nocity_pick AS (
  SELECT * EXCLUDE (rn), 'nocity_' || type AS pass FROM (
    SELECT *, row_number() OVER (PARTITION BY import_id, type ORDER BY dist, id) AS rn FROM nocity_pairs_in) WHERE rn = 1),
bfeat AS (
  SELECT * FROM la WHERE type IN ('W', 'M') AND building IS NOT NULL AND hn IS NULL AND shape IN ('square', 'bowtie')),
cands AS (
  SELECT i.import_id, b.type, b.id, b.cx, b.cy, b.half, i.lon, i.lat,
         {_d_box("i.lon", "i.lat", "b.cx", "b.cy", "b.half")} AS dist,
         {_tags([("addr:housenumber", "i.hn"), ("addr:street", "i.street"), ("addr:city", "i.city"), ("building", "b.building"),
                 ("type", "b.rel_type"), ("note", "i.note")])} AS tags_text,
         i.hn AS m_hn, i.street AS m_street, i.city AS m_city, b.building AS m_building, NULL AS m_highway,
         b.rel_type AS m_type, NULL AS m_created_by, i.note AS m_note
  FROM pool i JOIN bfeat b ON b.shape = 'square'
   AND abs(i.lon - b.cx) <= b.half + 0.001 AND abs(i.lat - b.cy) <= b.half + 0.001
  WHERE {_d_box("i.lon", "i.lat", "b.cx", "b.cy", "b.half")} <= {buffer!r}e0),
area_feats AS (
  SELECT * FROM la WHERE type IN ('W', 'M') AND (building IS NOT NULL OR hn IS NOT NULL)),
area_edges AS ({" UNION ALL ".join(edge_rows)}),
area_near AS (
  SELECT DISTINCT c.import_id, e.type, e.id
  FROM (SELECT DISTINCT import_id, lon, lat FROM cands) c
  JOIN area_edges e ON abs(c.lon - (e.ax + e.bx) / 2) <= 0.01 AND abs(c.lat - (e.ay + e.by) / 2) <= 0.01
  WHERE {_d_seg("c.lon", "c.lat", "e.ax", "e.ay", "e.bx", "e.by")} <= {building!r}e0),
bmatch AS (
  SELECT c.* FROM cands c
  WHERE NOT EXISTS (
          SELECT 1 FROM pool j WHERE j.import_id <> c.import_id
            AND abs(j.lon - c.cx) <= 0.01 AND abs(j.lat - c.cy) <= 0.01
            AND {_d_box("j.lon", "j.lat", "c.cx", "c.cy", "c.half")} <= {building!r}e0)
    AND NOT EXISTS (
          SELECT 1 FROM la n WHERE n.type = 'N' AND n.hn IS NOT NULL {j9_id.replace("b.id", "c.id")}
            AND abs(n.cx - c.cx) <= 0.01 AND abs(n.cy - c.cy) <= 0.01
            AND {_d_box("n.cx", "n.cy", "c.cx", "c.cy", "c.half")} <= {building!r}e0)
    {j10}),
building_pick AS (
  SELECT * EXCLUDE (rn), 'building_' || type AS pass FROM (
    SELECT *, row_number() OVER (PARTITION BY import_id, type ORDER BY dist, id) AS rn
    FROM bmatch WHERE type IN {bld_types}) WHERE rn = 1),
raw_matches AS (
  SELECT import_id, type, id, dist, tags_text, pass, m_hn, m_street, m_city, m_building, m_highway, m_type, m_created_by, m_note
  FROM nocity_pick
  UNION ALL
  SELECT import_id, type, id, dist, tags_text, pass, m_hn, m_street, m_city, m_building, m_highway, m_type, m_created_by, m_note
  FROM building_pick),
resolved AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY type, id ORDER BY dist, import_id) AS rn FROM raw_matches) WHERE rn = 1),
resolved_t AS (
  SELECT *, {_tags([("addr:housenumber", "m_hn"), ("addr:street", "m_street"), ("addr:city", "m_city"), ("building", "m_building"),
                    ("highway", "m_highway"), ("type", "m_type"),
                    ("created_by", "CASE WHEN list_contains(" + strip_list + ", 'created_by') THEN NULL ELSE m_created_by END"),
                    ("note", "m_note")])} AS stripped_text
  FROM resolved),
ch_nodes AS (
  SELECT CAST(n.id AS BIGINT) AS id, CAST(n.version AS INTEGER) AS version, r.stripped_text AS tags_text, n.lon, n.lat
  FROM resolved_t r JOIN fx_nodes n ON r.type = 'N' AND n.id = r.id),
ch_ways AS (
  SELECT CAST(w.id AS BIGINT) AS id, CAST(w.version AS INTEGER) AS version, r.stripped_text AS tags_text,
         array_to_string(list_transform({node_case("w.")}, lambda x: CAST(x AS VARCHAR)), ',') AS nodes_text,
         {node_case("w.")} AS node_list
  FROM resolved_t r JOIN fx_ways w ON r.type = 'W' AND w.id = r.id),
ch_rels AS (
  SELECT CAST(rel.id AS BIGINT) AS id, CAST(rel.version + 1 AS INTEGER) AS version, r.stripped_text AS tags_text,
         string_agg(m.member_type, ',' ORDER BY m.sequence_id) AS types_text,
         string_agg(CAST(m.member_id AS VARCHAR), ',' ORDER BY m.sequence_id) AS ids_text,
         string_agg(m.member_role, ',' ORDER BY m.sequence_id) AS roles_text,
         count(*) AS n_members
  FROM resolved_t r JOIN fx_relations rel ON r.type = 'M' AND rel.id = r.id
  JOIN fx_members m ON m.relation_id = rel.id
  GROUP BY rel.id, rel.version, r.stripped_text),
remaining AS (
  SELECT p.* FROM pool p WHERE NOT EXISTS (SELECT 1 FROM resolved r WHERE r.import_id = p.import_id))
"""


def _q(body: str, **kw) -> str:
    return base_ctes(**kw) + body


def _holed() -> str:
    """Vertices inside a general area, or edges that cross one of its edges, by winding sums instead of crossings."""
    rings = parse_wkt_area(holed_bounds(1)).rings  # of the first block: all others are moved there
    edges = ", ".join(f"({i}, {a[0]!r}e0, {a[1]!r}e0, {b[0]!r}e0, {b[1]!r}e0)" for i, (a, b) in enumerate((a, b) for r in rings for a, b in zip(r[:-1], r[1:])))
    turn = "atan2((e.ax - x) * (e.byy - y) - (e.bx - x) * (e.ay - y), (e.ax - x) * (e.bx - x) + (e.ay - y) * (e.byy - y))"
    side = lambda ax, ay, bx, by, px, py: f"sign(({bx} - {ax}) * ({py} - {ay}) - ({by} - {ay}) * ({px} - {ax}))"
    apart = " AND ".join(
        f"{side(*s, *p)} * {side(*s, *q)} < 0"
        for s, p, q in (
            (("e.ax", "e.ay", "e.bx", "e.byy"), ("w.x", "w.y"), ("w.x2", "w.y2")),
            (("w.x", "w.y", "w.x2", "w.y2"), ("e.ax", "e.ay"), ("e.bx", "e.byy")),
        )
    )
    # each ring turns around a point by a whole circle or not at all; a hole turns it out again
    sizes = [len(r) - 1 for r in rings]
    starts = [sum(sizes[:k]) for k in range(len(rings))]
    ring = "CASE " + " ".join(f"WHEN e.i >= {s} THEN {k}" for k, s in reversed(list(enumerate(starts)))) + " END"
    return f"""
, edges AS (SELECT * FROM (VALUES {edges}) v(i, ax, ay, bx, byy)),
pts AS (
  SELECT type, id, pos, x - {BLOCK_DEG!r}e0 * floor((x + 123.102e0) / {BLOCK_DEG!r}e0) AS x, y FROM (
    SELECT 'N' AS type, CAST(id AS BIGINT) AS id, 0 AS pos, lon AS x, lat AS y FROM fx_nodes
    UNION ALL SELECT 'W', CAST(id AS BIGINT), pos, vx, vy FROM way_verts)),
around AS (SELECT type, id, pos, {ring} AS ring, abs(sum({turn})) > 3 AS within FROM pts, edges e GROUP BY ALL),
inside AS (SELECT DISTINCT type, id FROM (SELECT type, id, pos, count(*) FILTER (within) % 2 = 1 AS within FROM around GROUP BY ALL) WHERE within),
segs AS (SELECT type, id, x, y, lead(x) OVER o AS x2, lead(y) OVER o AS y2 FROM pts WHERE type = 'W' WINDOW o AS (PARTITION BY id ORDER BY pos)),
crossing AS (SELECT DISTINCT w.type, w.id FROM segs w, edges e WHERE w.x2 IS NOT NULL AND {apart}),
held AS (SELECT * FROM inside UNION SELECT * FROM crossing),
joined AS (
  SELECT m.relation_id, p.pos, p.x = lag(p.x) OVER o AND p.y = lag(p.y) OVER o AS same
  FROM fx_members m JOIN fx_relations r ON r.id = m.relation_id AND r.rel_type = 'multipolygon'
  JOIN held k ON k.type = 'W' AND k.id = m.member_id JOIN pts p ON p.type = 'W' AND p.id = k.id
  WINDOW o AS (PARTITION BY m.relation_id ORDER BY m.sequence_id, p.pos))
SELECT k.type, k.id, CAST((SELECT count(*) FROM pts p WHERE p.type = k.type AND p.id = k.id) AS INTEGER) AS n_vertices FROM held k
UNION ALL SELECT 'M', relation_id, CAST(count(*) FILTER (NOT (pos = 0 AND coalesce(same, false))) AS INTEGER) FROM joined GROUP BY relation_id"""


def _stripped(keys: list[str]) -> str:
    """Tag text without keys, taken from the text itself."""
    gone = "[" + ", ".join(f"'{k}'" for k in keys) + "]"
    return f"array_to_string(list_filter(string_split(tags_text, ';'), lambda t: NOT list_contains({gone}, split_part(t, '=', 1))), ';')"


def oracle_queries() -> dict[str, str]:
    tag_count = "len(string_split(tags_text, ';'))"
    return {
        "local_nodes": _q("SELECT CAST(id AS BIGINT) AS id, tags_text, cx AS lon, cy AS lat FROM la_tags WHERE type = 'N'"),
        "local_ways": _q("SELECT id, tags_text, CAST(n_vertices AS INTEGER) AS n_vertices FROM la_tags WHERE type = 'W'"),
        "multipolygon_lines": _q(
            """SELECT CAST(l.id AS BIGINT) AS id, t.tags_text, CAST(m.n_vertices AS INTEGER) AS n_vertices,
                      m.first_lon, m.first_lat, m.last_lon, m.last_lat, CAST(l.n_ways AS BIGINT) AS n_ways
               FROM lmp l JOIN mp_line m ON m.relation_id = l.id JOIN la_tags t ON t.type = 'M' AND t.id = l.id"""
        ),
        "local_features": _q("SELECT type, id, tags_text, CAST(n_vertices AS INTEGER) AS n_vertices FROM la_tags"),
        "snapshot_features": _q("SELECT type, id, tags_text, CAST(n_vertices AS INTEGER) AS n_vertices FROM la_tags"),
        "local_features_holed": _q(_holed()),
        "area_latitude": _q(f"SELECT {_bounds(BOUNDS_WIDE)[3]} AS area_max_abs_lat, max(abs(lat)) AS max_abs_lat FROM ln"),
        "nocity_nodes_intended": _q(
            f"SELECT import_id, id, {_cm('dist')} AS dist_cm, tags_text FROM nocity_pick WHERE type = 'N'", semantics="intended"
        ),
        "nocity_nodes_1m": _q(f"SELECT import_id, id, {_cm('dist')} AS dist_cm, tags_text FROM nocity_pick WHERE type = 'N'", nocity=1.0),
        "stripped_by_file": _q(
            f"SELECT type, id, {_stripped([*(x.strip() for x in STRIP_FILE_LINES if x.strip()), 'created_by', 'odbl', 'odbl:note'])} AS tags_text FROM la_tags"
        ),
        "changed_relations_intended": _q("SELECT id, version, tags_text, ids_text FROM ch_rels", semantics="intended"),
        "xml_exact_values": _q(
            """SELECT import_id, lon, lat, rank() OVER (ORDER BY import_id) AS place, array_to_string(list_sort(list_concat(
                 list_filter(string_split(tags_text, ';'), lambda t: split_part(t, '=', 1) <> 'note'),
                 ['note=  <a b=''c''> & "d"  ' || CAST(import_id AS VARCHAR) || ' </node> '])), ';') AS tags_text FROM imp"""
        ),
        "xml_faults": _q(
            """SELECT 'node' AS kind, CAST(import_id AS BIGINT) AS id, NULL AS reason FROM imp WHERE abs(import_id) % 13 > 5
               UNION ALL SELECT 'bad', CASE WHEN abs(import_id) % 13 <> 2 THEN import_id END, CASE abs(import_id) % 13
                 WHEN 4 THEN 'element can''t be parsed' WHEN 5 THEN 'end tag without its element' ELSE 'element is not closed' END
               FROM imp WHERE abs(import_id) % 13 <= 5
               UNION ALL VALUES ('bad', NULL, 'element is not closed'), ('file', NULL, 'file is not closed'), ('file', NULL, 'file has no head')"""
        ),
        "osc_file": _q(
            """SELECT 'node' AS kind, id, version, lon, lat, tags_text, '' AS nd_text, '' AS member_text FROM ch_nodes
               UNION ALL SELECT 'way', id, version, NULL, NULL, tags_text, nodes_text, '' FROM ch_ways
               UNION ALL SELECT 'relation', c.id, c.version, NULL, NULL, c.tags_text, '',
                 (SELECT string_agg(CASE m.member_type WHEN 'N' THEN 'node' WHEN 'W' THEN 'way' ELSE 'relation' END || ':' ||
                    CAST(m.member_id AS VARCHAR) || ':' || m.member_role, ',' ORDER BY m.sequence_id) FROM fx_members m WHERE m.relation_id = c.id)
               FROM ch_rels c"""
        ),
        "invalid_merge_rows": _q(
            """SELECT CASE type WHEN 'N' THEN 'nodes' WHEN 'W' THEN 'ways' ELSE 'relations' END AS "table", id AS key, 'duplicate id' AS reason
               FROM raw_matches GROUP BY type, id HAVING count(*) > 1"""
        ),
        "exact_duplicates": _q("SELECT import_id, hn, street, city FROM dups"),
        "remaining_after_duplicates": _q("SELECT import_id, tags_text, lon, lat FROM pool"),
        "nocity_nodes": _q(f"SELECT import_id, id, {_cm('dist')} AS dist_cm, tags_text FROM nocity_pick WHERE type = 'N'"),
        "nocity_ways": _q(f"SELECT import_id, id, {_cm('dist')} AS dist_cm, tags_text FROM nocity_pick WHERE type = 'W'"),
        "nocity_relations": _q(
            f"SELECT import_id, id, {_cm('dist')} AS dist_cm, tags_text FROM nocity_pick WHERE type = 'M'"
        ),
        "merged_tags": _q("SELECT import_id, type, id, tags_text FROM nocity_pairs_in"),
        "stripped_tags": _q("SELECT type, id, stripped_text AS tags_text FROM la_tags"),
        "building_candidates": _q(f"SELECT import_id, type, id, {_cm('dist')} AS dist_cm FROM cands"),
        "building_matches": _q(f"SELECT import_id, type, id, {_cm('dist')} AS dist_cm, tags_text FROM bmatch"),
        "building_matches_intended": _q(
            f"SELECT import_id, type, id, {_cm('dist')} AS dist_cm, tags_text FROM bmatch", semantics="intended"
        ),
        "conflicts": _q(
            """SELECT type, id, count(*) AS n_imports, min(import_id) AS min_import_id, max(import_id) AS max_import_id
               FROM raw_matches GROUP BY type, id HAVING count(*) > 1"""
        ),
        "resolved_nearest": _q(f"SELECT import_id, type, id, pass, {_cm('dist')} AS dist_cm FROM resolved"),
        "changed_nodes": _q("SELECT id, version, tags_text, lon, lat FROM ch_nodes"),
        "changed_ways": _q("SELECT id, version, tags_text, nodes_text FROM ch_ways"),
        "changed_relations": _q("SELECT id, version, tags_text, types_text, ids_text, roles_text FROM ch_rels"),
        "remaining_final": _q("SELECT import_id, tags_text, lon, lat FROM remaining"),
        "xml_roundtrip": _q("SELECT import_id, tags_text, lon, lat FROM remaining"),
        "merge_summary": _q(
            """SELECT 'imports' AS stage, (SELECT count(*) FROM imp) AS n
               UNION ALL SELECT 'duplicates', (SELECT count(*) FROM dups)
               UNION ALL SELECT 'remaining_after_duplicates', (SELECT count(*) FROM pool)
               UNION ALL SELECT 'matched_imports', (SELECT count(DISTINCT import_id) FROM resolved)
               UNION ALL SELECT 'changed_nodes', (SELECT count(*) FROM ch_nodes)
               UNION ALL SELECT 'changed_ways', (SELECT count(*) FROM ch_ways)
               UNION ALL SELECT 'changed_relations', (SELECT count(*) FROM ch_rels)
               UNION ALL SELECT 'remaining', (SELECT count(*) FROM remaining)"""
        ),
        "osc_rows": _q(
            f"""SELECT 'node' AS kind, id, version, 0 AS n_nd, 0 AS n_member, {tag_count} AS n_tag FROM ch_nodes
                UNION ALL SELECT 'way', id, version, len(node_list), 0, {tag_count} FROM ch_ways
                UNION ALL SELECT 'relation', id, version, 0, n_members, {tag_count} FROM ch_rels"""
        ),
        "invalid_rows": _q(
            """, dirty_imp AS (
                 SELECT import_id FROM imp
                 UNION ALL SELECT CAST(-(s_suppkey + 1) AS INTEGER) FROM supplier),
               dirty_nodes AS (SELECT id, version - 1 AS version FROM fx_nodes)
               SELECT 'imports' AS "table", CAST(import_id AS BIGINT) AS key, 'duplicate import_id' AS reason
               FROM dirty_imp GROUP BY import_id HAVING count(*) > 1
               UNION ALL
               SELECT 'nodes', CAST(id AS BIGINT), 'duplicate id' FROM dirty_nodes GROUP BY id HAVING count(*) > 1
               UNION ALL
               SELECT 'nodes', CAST(id AS BIGINT), 'id not positive' FROM dirty_nodes WHERE id <= 0
               UNION ALL
               SELECT 'nodes', CAST(id AS BIGINT), 'version below 1' FROM dirty_nodes WHERE version < 1"""
        ),
    }
