"""Tag (hstore-like) functions on MAP<STRING,STRING> columns.

All are SQL expressions, so they stay inside the JVM; arguments are SQL
expressions (usually column names).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# OSM address tag keys and the keys that are always stripped from changed objects.
HOUSENUMBER = "addr:housenumber"
STREET = "addr:street"
CITY = "addr:city"
ALWAYS_STRIPPED = ["created_by", "odbl", "odbl:note"]

_EMPTY = "CAST(map() AS MAP<STRING,STRING>)"


def _q(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_tags_or_empty(tags: str) -> str:
    return f"coalesce({tags}, {_EMPTY})"


def tags_or_empty(tags: str) -> Column:
    """NULL tag map -> empty map (an OSM object without tags)."""
    return F.expr(sql_tags_or_empty(tags))


def tag(tags: str, key: str) -> Column:
    """``tags -> key``; a missing key gives NULL."""
    return F.expr(f"{tags}[{_q(key)}]")


def sql_has_tag(tags: str, key: str) -> str:
    return f"coalesce(map_contains_key({tags}, {_q(key)}), false)"


def has_tag(tags: str, key: str) -> Column:
    """``tags ? key`` (any value counts, even ``no``)."""
    return F.expr(sql_has_tag(tags, key))


def address_columns(tags: str, prefix: str = "") -> list[Column]:
    """P5: project number, street and city once, as ``hn``, ``street``, ``city``."""
    return [
        tag(tags, HOUSENUMBER).alias(prefix + "hn"),
        tag(tags, STREET).alias(prefix + "street"),
        tag(tags, CITY).alias(prefix + "city"),
    ]


def merge_tags(import_tags: str, osm_tags: str) -> Column:
    """``import || osm`` with the right side winning, so existing OSM values are kept.

    ``map_concat`` alone raises on duplicate keys, so the import side is first
    filtered to keys the OSM side lacks.
    """
    imp = sql_tags_or_empty(import_tags)
    osm = sql_tags_or_empty(osm_tags)
    return F.expr(f"map_concat(map_filter({imp}, (k, v) -> NOT map_contains_key({osm}, k)), {osm})")


def strip_tags(tags: str, keys: Iterable[str]) -> Column:
    """``tags - text[]``: drop every key in ``keys``."""
    ks = sorted(set(keys))
    arr = f"array({', '.join(_q(k) for k in ks)})" if ks else "CAST(array() AS ARRAY<STRING>)"
    return F.expr(f"map_filter({sql_tags_or_empty(tags)}, (k, v) -> NOT array_contains({arr}, k))")


def tags_from_columns(pairs: dict[str, str]) -> Column:
    """Build a tag map from scalar columns, dropping NULL values (no NULL values in OSM tags)."""
    args = ", ".join(f"{_q(k)}, CAST({c} AS STRING)" for k, c in pairs.items())
    return F.expr(f"map_filter(map({args}), (k, v) -> v IS NOT NULL)")


def sql_tags_text(tags: str) -> str:
    return f"array_join(array_sort(transform(map_entries({sql_tags_or_empty(tags)}), e -> concat(e.key, '=', e.value))), ';')"


def tags_text(tags: str) -> Column:
    """Canonical text of a map: sorted ``k=v`` entries joined by ``;`` (for comparisons)."""
    return F.expr(sql_tags_text(tags))
