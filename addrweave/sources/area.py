"""The area of interest, one WKT (Multi)Polygon parsed once on the driver.

The area is a run parameter, not data: it becomes a literal edge array (P1/P2).
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from dataclasses import dataclass
from functools import lru_cache

_NUM = r"[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?"


@dataclass(frozen=True)
class Area:
    """Rings of the area (outer rings and holes alike; even-odd rule) in lon/lat."""

    rings: tuple[tuple[tuple[float, float], ...], ...]

    @property
    def bbox(self) -> tuple[float, float, float, float]:
        xs = [x for r in self.rings for x, _ in r]
        ys = [y for r in self.rings for _, y in r]
        return (min(xs), min(ys), max(xs), max(ys))

    @property
    def max_abs_lat(self) -> float:
        """A4: the greatest absolute latitude of the area."""
        _, y0, _, y1 = self.bbox
        return max(abs(y0), abs(y1))

    def ring_lists(self) -> list[list[tuple[float, float]]]:
        return [list(r) for r in self.rings]


_TOKEN = re.compile(rf"\s*({_NUM}(?![\w.+-])|[A-Za-z]+|[(),;=])")


class _Wkt:
    """Tokens of a WKT text, read from the front; everything must be used up."""

    def __init__(self, text: str):
        self.tokens, at = [], 0
        text = text.strip()
        while at < len(text):
            m = _TOKEN.match(text, at)
            if not m:
                raise ValueError(f"invalid WKT near {text[at:at + 30]!r}")
            self.tokens.append(m.group(1))
            at = m.end()
        self.at = 0

    def peek(self) -> str:
        return self.tokens[self.at].upper() if self.at < len(self.tokens) else ""

    def take(self, *expected: str) -> str:
        t = self.peek()
        if expected and t not in expected:
            raise ValueError(f"invalid WKT: {' or '.join(expected)} expected, not {t or 'the end'!r}")
        self.at += 1
        return t

    def list_of(self, item) -> list:
        self.take("(")
        out = [item()]
        while self.take(",", ")") == ",":
            out.append(item())
        return out

    def ring(self, numbers: int) -> tuple[tuple[float, float], ...]:
        def point() -> tuple[float, float]:
            values = []
            for _ in range(numbers):
                if not re.fullmatch(_NUM, self.peek()):
                    raise ValueError(f"invalid WKT coordinate: {self.peek() or 'the end'!r}")
                values.append(float(self.take()))
            return values[0], values[1]

        pts = self.list_of(point)
        if len(pts) < 4 or pts[0] != pts[-1]:
            raise ValueError("invalid WKT ring: needs at least 4 points and must be closed")
        return tuple(pts)

    def geometry(self) -> list[tuple[tuple[float, float], ...]]:
        """Rings of a polygon, a multipolygon or a collection of these."""
        kind = self.take("POLYGON", "MULTIPOLYGON", "GEOMETRYCOLLECTION")
        dims = 2 + len(self.take("Z", "M", "ZM")) if self.peek() in ("Z", "M", "ZM") else 2
        if kind == "GEOMETRYCOLLECTION":
            return [r for g in self.list_of(self.geometry) for r in g]
        polygon = lambda: self.list_of(lambda: self.ring(dims))
        return polygon() if kind == "POLYGON" else [r for g in self.list_of(polygon) for r in g]


def parse_wkt_area(wkt: str) -> Area:
    """Parse a WKT polygon, multipolygon or collection of these (Z and M are ignored), optionally after
    ``SRID=4326;``; raise ValueError for anything else, so that no area is used that was not meant."""
    w = _Wkt(wkt)
    if w.peek() == "SRID":
        w.take()
        w.take("=")
        if w.take() != "4326":
            raise ValueError("only areas in longitude and latitude (SRID 4326) are supported")
        w.take(";")
    rings = w.geometry()
    if w.peek() == ";":
        w.take()
    if w.peek():
        raise ValueError(f"invalid WKT: {w.peek()!r} after the area")
    return Area(tuple(rings))


def read_wkt_file(spark, path: str) -> Area:
    """The area of a file on any storage that Spark reads."""
    rows = spark.read.text(path, wholetext=True).collect()  # a run parameter: one file
    if len(rows) != 1:
        raise ValueError(f"{path}: one file with the area expected")
    return parse_wkt_area(rows[0][0])


# --------------------------------------------------------------------------- area index

Edge = tuple[float, float, float, float]


@dataclass(frozen=True)
class AreaIndex:
    """A grid over the area's box, built once on the driver from the area parameter.

    ``cells`` holds one letter per cell (row-major from the south-west): ``I`` (wholly
    inside), ``O`` (wholly outside) or ``B`` (an area edge passes within ``eps``). A
    point in an ``I``/``O`` cell is decided without looking at any edge.
    ``bands[j]`` lists every edge whose latitude range meets row ``j`` (widened by
    ``eps``); an exact even-odd test for a point in row ``j`` only needs those edges,
    since an edge that straddles the point's latitude must meet its row.
    """

    x0: float
    y0: float
    dx: float
    dy: float
    nx: int
    ny: int
    cells: str
    bands: tuple[tuple[Edge, ...], ...]


def _edges(area: Area) -> list[Edge]:
    return [(a[0], a[1], b[0], b[1]) for r in area.rings for a, b in zip(r[:-1], r[1:])]


def _crossings(py: float, edges: list[Edge]) -> list[float]:
    """Sorted longitudes at which edges cross the latitude ``py``; a point is inside if an odd number is further east."""
    return sorted(ax + (bx - ax) * (py - ay) / (by - ay) for ax, ay, bx, by in edges if (ay > py) != (by > py))


def _seg_hits_box(e: Edge, bx0: float, by0: float, bx1: float, by1: float) -> bool:
    """Closed segment meets the closed box (Liang-Barsky clipping)."""
    ax, ay, ex, ey = e
    t0, t1 = 0.0, 1.0
    dx, dy = ex - ax, ey - ay
    for p, q in ((-dx, ax - bx0), (dx, bx1 - ax), (-dy, ay - by0), (dy, by1 - ay)):
        if p == 0:
            if q < 0:
                return False
        else:
            t = q / p
            if p < 0:
                t0 = max(t0, t)
            else:
                t1 = min(t1, t)
            if t0 > t1:
                return False
    return True


@lru_cache(maxsize=8)
def build_area_index(area: Area, max_side: int = 128) -> AreaIndex:
    """Grid of about two cells per edge in each direction (at most ``max_side`` per side)."""
    edges = _edges(area)
    x0, y0, x1, y1 = area.bbox
    n = max(1, min(max_side, int(math.sqrt(len(edges)) * 2)))
    dx = (x1 - x0) / n or 1.0
    dy = (y1 - y0) / n or 1.0
    eps = 1e-9 * max(abs(x0), abs(x1), abs(y0), abs(y1), 1.0)
    boundary = set()
    bands: list[list[Edge]] = [[] for _ in range(n)]
    for e in edges:
        ex0, ex1 = min(e[0], e[2]) - eps, max(e[0], e[2]) + eps
        ey0, ey1 = min(e[1], e[3]) - eps, max(e[1], e[3]) + eps
        i0, i1 = max(0, int((ex0 - x0) // dx)), min(n - 1, int((ex1 - x0) // dx))
        j0, j1 = max(0, int((ey0 - y0) // dy)), min(n - 1, int((ey1 - y0) // dy))
        for j in range(j0, j1 + 1):
            bands[j].append(e)
            for i in range(i0, i1 + 1):
                cx0, cy0 = x0 + i * dx, y0 + j * dy
                if _seg_hits_box(e, cx0 - eps, cy0 - eps, cx0 + dx + eps, cy0 + dy + eps):
                    boundary.add((i, j))
    cells = []
    for j in range(n):
        east = _crossings(y0 + (j + 0.5) * dy, bands[j])
        for i in range(n):
            if (i, j) in boundary:
                cells.append("B")
            else:
                cells.append("OI"[(len(east) - bisect_right(east, x0 + (i + 0.5) * dx)) % 2])
    return AreaIndex(x0, y0, dx, dy, n, n, "".join(cells), tuple(tuple(b) for b in bands))
