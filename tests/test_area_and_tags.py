import pytest
from pyspark.sql import functions as F

from addrweave.functions.tags import merge_tags, strip_tags, tags_text
from addrweave.sources.area import parse_wkt_area


def test_parse_polygon_with_hole():
    a = parse_wkt_area("POLYGON((0 0, 10 0, 10 10, 0 10, 0 0), (4 4, 6 4, 6 6, 4 6, 4 4))")
    assert len(a.rings) == 2
    assert a.bbox == (0.0, 0.0, 10.0, 10.0)
    assert a.max_abs_lat == 10.0


def test_parse_multipolygon():
    a = parse_wkt_area("MULTIPOLYGON(((0 0, 1 0, 1 1, 0 0)), ((5 5, 6 5, 6 6, 5 5)))")
    assert len(a.rings) == 2


@pytest.mark.parametrize("bad", ["POINT(1 2)", "POLYGON((0 0, 1 0, 1 1))", "POLYGON((0 0, 1 0, 1 1, 0 1, 0 0)", "garbage"])
def test_invalid_wkt_raises(bad):
    with pytest.raises(ValueError):
        parse_wkt_area(bad)


@pytest.mark.parametrize(
    "bad",
    [
        "POLYGON((0 0 junk, 1 0, 1 1, 0 0))",
        "POLYGON((a0 b0, 1 0, 1 1, a0 b0))",
        "POLYGON((1-2 3, 1 0, 1 1, 1-2 3))",
        "POLYGON((0 0, 1 0, 1 1, 0 0), 5 5)",
        "POLYGON(((0 0, 1 0, 1 1, 0 0)))",
        "MULTIPOLYGON((0 0, 1 0, 1 1, 0 0))",
        "SRID=3857;POLYGON((0 0, 1 0, 1 1, 0 0))",
        "POLYGON((0 0, 1 0, 1 1, 0 0)) POINT(1 2)",
        "POLYGON((0 0 0, 1 0 0, 1 1 0, 0 0 0))",
        "POLYGON Z((0 0, 1 0, 1 1, 0 0))",
        "POLYGON EMPTY",
        "",
    ],
)
def test_wkt_that_is_nearly_an_area_raises(bad):
    with pytest.raises(ValueError):
        parse_wkt_area(bad)


def test_other_area_types():
    ring = ((0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0))
    for good in (
        "SRID=4326;POLYGON((0 0, 1 0, 1 1, 0 0));",
        "polygon z ((0 0 5, 1 0 5, 1 1 5, 0 0 5))",
        "POLYGON ZM((0 0 5 6,1 0 5 6,1 1 5 6,0 0 5 6))",
        "GEOMETRYCOLLECTION(POLYGON((0 0, 1 0, 1 1, 0 0)))",
        "GEOMETRYCOLLECTION(MULTIPOLYGON(((0 0, 1.0e0 0, 1 +1, 0 0))))",
    ):
        assert parse_wkt_area(good).rings == (ring,)


def test_area_file(spark, tmp_path):
    from addrweave.sources.area import read_wkt_file

    (tmp_path / "area.wkt").write_text("POLYGON((0 0,\n 1 0, 1 1, 0 0))\n")
    assert read_wkt_file(spark, str(tmp_path / "area.wkt")).bbox == (0.0, 0.0, 1.0, 1.0)


def test_large_area_plans_quickly(spark):
    """A boundary of 20,000 vertices is planned in a moment, and decides as a circle does."""
    import math
    import time

    from addrweave.operators.local import local_nodes

    n = 20_000
    pts = [(10 + math.cos(2 * math.pi * k / n), 50 + math.sin(2 * math.pi * k / n)) for k in range(n)]
    area = parse_wkt_area("POLYGON((" + ", ".join(f"{x!r} {y!r}" for x, y in [*pts, pts[0]]) + "))")
    nodes = spark.range(4000).select(
        F.col("id"), F.lit(1).alias("version"), F.expr("map('a', 'b')").alias("tags"),
        (8.8 + F.pmod(F.col("id") * 0.0377, F.lit(2.4))).alias("lon"), (48.8 + F.pmod(F.col("id") * 0.0913, F.lit(2.4))).alias("lat"),
    )
    local_nodes(nodes.limit(1), area).collect()  # the first use loads classes and builds the index
    began = time.time()
    inside = local_nodes(nodes, area)
    inside._jdf.queryExecution().executedPlan()
    assert time.time() - began < 2
    near = (F.col("lon") - 10) ** 2 + (F.col("lat") - 50) ** 2
    assert inside.count() == nodes.where(near < 1 - 1e-7).count() + inside.where(near >= 1 - 1e-7).count() > 1000


def test_merge_tags_right_side_wins(spark):
    df = spark.sql(
        "SELECT map('addr:city', 'A', 'note', 'import', 'addr:street', 'S') AS i, map('addr:city', 'B', 'building', 'yes') AS o"
    )
    got = df.select(merge_tags("i", "o").alias("m"))
    m = got.collect()[0]["m"]
    assert m == {"addr:city": "B", "note": "import", "addr:street": "S", "building": "yes"}


def test_merge_tags_null_maps(spark):
    df = spark.sql("SELECT CAST(NULL AS MAP<STRING,STRING>) AS i, map('a', '1') AS o")
    assert df.select(merge_tags("i", "o").alias("m")).collect()[0]["m"] == {"a": "1"}
    df = spark.sql("SELECT map('a', '1') AS i, CAST(NULL AS MAP<STRING,STRING>) AS o")
    assert df.select(merge_tags("i", "o").alias("m")).collect()[0]["m"] == {"a": "1"}


def test_strip_and_text(spark):
    df = spark.sql("SELECT map('created_by', 'x', 'b', '2', 'a', '1', 'odbl', 'y') AS t")
    row = df.select(strip_tags("t", ["created_by", "odbl"]).alias("s")).select("s", tags_text("s").alias("txt")).collect()[0]
    assert row["s"] == {"b": "2", "a": "1"}
    assert row["txt"] == "a=1;b=2"


def test_missing_key_is_null_under_ansi(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    df = spark.sql("SELECT map('a', '1') AS t")
    assert df.select(F.expr("t['missing']").alias("v")).collect()[0]["v"] is None
