"""One XML file from parts of many tasks (K1, K5): the bytes that one task writes, whatever the number of parts."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from addrweave.operators.changes import Changes
from addrweave.session import ensure_checkpoint_dir
from addrweave.sinks.one_file import join_parts, write_one_file, xml_parts
from addrweave.sinks.osm_xml import OSC_ROOT, OSM_ROOT, osc_rows, osm_node_rows, write_osc, write_osm


@pytest.fixture
def many_parts(spark):
    """Ranges stay as they are, however few rows they hold."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, old)


def _imports(spark, n):
    tags = F.when(F.col("id") % 3 == 0, F.expr("map()").cast("map<string,string>")).otherwise(F.expr("map('b', concat('é<&\">\n', id), 'a', '  </node> ')"))
    d = spark.range(n).repartition(7)
    return d.select((-F.col("id") - 1).alias("import_id"), tags.alias("tags"), (F.col("id") / 7).alias("lon"), (F.col("id") / 9).alias("lat"))


def _one_task(rows, order, root, tag, path):
    """As one task writes it: everything sorted in one partition."""
    rows.coalesce(1).sortWithinPartitions(*order).drop(*order).write.format("xml").option("rootTag", root).option("rowTag", tag).save(path)


def _bytes(folder):
    files = [f for f in os.listdir(folder) if not f.startswith((".", "_"))]
    assert len(files) == 1 and files[0].startswith("part-") and os.path.exists(f"{folder}/_SUCCESS"), files
    assert not [f for f in os.listdir(folder) if f.startswith("_joined")]
    with open(f"{folder}/{files[0]}", "rb") as f:
        return f.read()


@pytest.mark.parametrize("n", [0, 1, 5, 300])
def test_same_bytes_as_one_task_for_imports(spark, tmp_path, many_parts, n):
    d = _imports(spark, n)
    write_osm(d, f"{tmp_path}/got", single_file=True)
    _one_task(osm_node_rows(d, d["import_id"].alias("number")), ["number"], OSM_ROOT, "node", f"{tmp_path}/want")
    assert _bytes(f"{tmp_path}/got") == _bytes(f"{tmp_path}/want")


def test_order_of_the_file_comes_before_the_ids(spark, tmp_path, many_parts):
    d = _imports(spark, 50).withColumn("position", F.struct(F.lit("f").alias("file"), ((F.col("import_id") * 17) % 101).alias("row")))
    write_osm(d, f"{tmp_path}/got", single_file=True)
    _one_task(osm_node_rows(d, d["position"].alias("place")), ["place"], OSM_ROOT, "node", f"{tmp_path}/want")
    assert _bytes(f"{tmp_path}/got") == _bytes(f"{tmp_path}/want")


def test_same_bytes_as_one_task_for_changes(spark, tmp_path, many_parts):
    n = spark.range(40).repartition(5)
    tags = F.expr("map('k', concat('v', id))").alias("tags")
    version = F.lit(2).alias("version")
    nodes = n.select("id", version, tags, F.lit(1.5).alias("lon"), F.lit(2.5).alias("lat"))
    ways = n.select("id", version, tags, F.expr("sequence(id, id + 3)").alias("nodes"))
    members = [F.expr(e).alias(a) for e, a in (("array('W', 'N')", "types"), ("array(id, id + 1)", "ids"), ("array('outer', '')", "roles"))]
    changes = Changes(nodes, ways, n.select("id", version, tags, *members))
    write_osc(changes, f"{tmp_path}/got", single_file=True)
    _one_task(osc_rows(changes), ["kind_order", "id"], OSC_ROOT, "modify", f"{tmp_path}/want")
    got = _bytes(f"{tmp_path}/got")
    assert got == _bytes(f"{tmp_path}/want") and got.count(b"<modify>") == 120


def test_many_tasks_write_the_rows(spark, tmp_path, many_parts):
    d = osm_node_rows(_imports(spark, 300), F.col("import_id").alias("number"))
    parts = xml_parts(d, f"{tmp_path}/parts", [F.col("number")], ["number"], OSM_ROOT, "node")
    assert len(parts) > 3 and parts == sorted(parts)
    counts = [open(p.removeprefix("file:"), encoding="utf-8").read().count("<node ") for p in parts]
    assert sum(counts) == 300 and max(counts) < 150


def test_a_damaged_part_is_an_error(spark, tmp_path):
    os.mkdir(tmp_path / "out")
    for name, text in (("head", "<osm>\n    <node/>\n</osm>"), ("end", f'<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n<{OSM_ROOT}>\n    <node/>')):
        (tmp_path / name).write_text(text)
        with pytest.raises(Exception, match="does not begin"):
            join_parts(spark, [f"file:{tmp_path}/{name}"], f"file:{tmp_path}/out", OSM_ROOT)


def test_modes_and_scratch(spark, tmp_path):
    before = set(os.listdir(ensure_checkpoint_dir(spark).removeprefix("file:")))
    one, two = _imports(spark, 1), _imports(spark, 2)
    path = f"{tmp_path}/out"
    write_osm(two, path, single_file=True)
    first = _bytes(path)
    write_osm(one, path, single_file=True, mode="ignore")
    assert _bytes(path) == first
    with pytest.raises(FileExistsError):
        write_osm(one, path, single_file=True, mode="error")
    with pytest.raises(ValueError, match="mode"):
        write_osm(one, path, single_file=True, mode="replace")
    write_osm(one, path, single_file=True, mode="append")
    assert len(glob.glob(path + "/part-*")) == 2
    write_osm(one, path, single_file=True)
    assert _bytes(path).count(b"<node ") == 1
    # a failing write leaves the old file and no tables of its own
    broken = one.withColumn("lon", F.expr("raise_error('broken')").cast("double"))
    with pytest.raises(Exception, match="broken"):
        write_one_file(osm_node_rows(broken, F.col("import_id").alias("n")), [F.col("n")], ["n"], path, OSM_ROOT, "node", "overwrite")
    assert _bytes(path).count(b"<node ") == 1
    assert set(os.listdir(ensure_checkpoint_dir(spark).removeprefix("file:"))) == before
