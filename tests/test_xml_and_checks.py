"""OSM XML round trip (K1 -> S1), osmChange rows, strip list file, integrity checks."""

import glob
import os
import tempfile

import pytest

from addrweave.functions.tags import tags_text
from addrweave.operators.changes import Changes, strip_keys
from addrweave.operators.checks import check_changes, check_imports
from addrweave.sinks.osm_xml import write_osc, write_osm
from addrweave.sources.osm_xml import read_osm_nodes, read_osm_nodes_report
from addrweave.sources.striplist import read_strip_list


def test_xml_round_trip_special_characters(spark):
    rows = [
        (-1, {"addr:street": "Rue & Co <1>", "name": "Zürich \"x\" 'y'"}, -123.1, 49.2),
        (-2, {}, 10.5, -45.25),
        (-3, {"addr:housenumber": "12½"}, 0.00001, 0.0),
    ]
    df = spark.createDataFrame(rows, "import_id int, tags map<string,string>, lon double, lat double")
    d = tempfile.mkdtemp(prefix="xmlrt-")
    write_osm(df, d + "/osm", single_file=True)
    text = open(glob.glob(d + "/osm/part-*")[0], encoding="utf-8").read()
    assert text.count("<node") == 3 and 'visible="true"' in text and "&amp;" in text
    back = read_osm_nodes(spark, d + "/osm")
    a = sorted(back.select("import_id", tags_text("tags").alias("t"), "lon", "lat").collect())
    b = sorted(df.select("import_id", tags_text("tags").alias("t"), "lon", "lat").collect())
    assert a == b


def test_xml_repeated_key_keeps_last(spark):
    d = tempfile.mkdtemp(prefix="xmldup-")
    with open(os.path.join(d, "in.osm"), "w", encoding="utf-8") as f:
        f.write('<?xml version="1.0"?>\n<osm version="0.6">\n')
        f.write('<node id="7" lon="1.5" lat="2.5"><tag k="a" v="1"/><tag k="a" v="2"/><tag k="b" v="3"/></node>\n')
        f.write('<node id="8" lon="1.0" lat="2.0"/>\n</osm>\n')
    got = {r["import_id"]: r["tags"] for r in read_osm_nodes(spark, d).collect()}
    assert got == {7: {"a": "2", "b": "3"}, 8: {}}
    assert [r["import_id"] for r in read_osm_nodes(spark, d, drop_untagged=True).collect()] == [7]


def test_osc_file(spark):
    nodes = spark.createDataFrame([(5, 2, {"a": "1"}, 1.0, 2.0)], "id bigint, version int, tags map<string,string>, lon double, lat double")
    ways = spark.createDataFrame([(6, 3, {"building": "yes"}, [60, 61, 62, 60])], "id bigint, version int, tags map<string,string>, nodes array<bigint>")
    rels = spark.createDataFrame(
        [(7, 4, {"type": "multipolygon"}, ["W", "N"], [70, 71], ["outer", ""])],
        "id bigint, version int, tags map<string,string>, types array<string>, ids array<bigint>, roles array<string>",
    )
    d = tempfile.mkdtemp(prefix="osc-")
    write_osc(Changes(nodes, ways, rels), d + "/osc", single_file=True)
    text = open(glob.glob(d + "/osc/part-*")[0], encoding="utf-8").read()
    assert "<osmChange" in text and text.count("<modify>") == 3
    assert text.index("<node") < text.index("<way") < text.index("<relation")
    assert '<nd ref="61"' in text and 'type="way"' in text and 'type="node"' in text


def test_strip_list_file(spark):
    d = tempfile.mkdtemp(prefix="strip-")
    with open(os.path.join(d, "remove.txt"), "w") as f:
        f.write("tiger:tlid\n  yh:TOTYUMONO\t\n\nsub_sea:type\n")
    keys = read_strip_list(spark, os.path.join(d, "remove.txt"))
    assert keys == ["created_by", "odbl", "odbl:note", "sub_sea:type", "tiger:tlid", "yh:TOTYUMONO"]
    assert strip_keys(["x"]) == ["created_by", "odbl", "odbl:note", "x"]


def test_integrity_checks(spark):
    imp = spark.createDataFrame([(1, 0.0, 0.0), (1, 1.0, 1.0), (None, 2.0, 2.0), (3, None, 1.0)], "import_id int, lon double, lat double")
    got = sorted((r["reason"], r["key"] if r["key"] is not None else -1) for r in check_imports(imp).collect())
    assert got == [("duplicate import_id", 1), ("missing coordinates", 3), ("missing import_id", -1)]
    ch = spark.createDataFrame([(5, 1), (5, 2), (0, 1), (6, 0)], "id bigint, version int")
    got = sorted((r["key"], r["reason"]) for r in check_changes(ch, "nodes").collect())
    assert got == [(0, "id not positive"), (5, "duplicate id"), (6, "version below 1")]


def _osm(path, body, head='<?xml version="1.0"?>\n<osm version="0.6">\n'):
    with open(path, "w", encoding="utf-8") as f:
        f.write(head + body)
    return str(path)


def test_xml_values_are_kept_as_they_are(spark, tmp_path):
    body = """ <node id="1" lon="1.5" lat="2">
      <tag k="a" v=" Main  St "/><tag k='b' v="x > y &amp; &lt;node z &lt;/node>"/>
     </node>\n<node id="2" lon="1" lat="2"/><node visible="true" id="-3" lon="1" lat="2"></node>
     <way id="5"><nd ref="1"/><tag k="a" v="no node"/></way></osm>\n"""
    path = _osm(tmp_path / "in.osm", body)
    got = read_osm_nodes(spark, path, with_position=True).orderBy("position").collect()
    assert [r.import_id for r in got] == [1, 2, -3]
    assert got[0].tags == {"a": " Main  St ", "b": "x > y & <node z </node>"} and got[1].tags == got[2].tags == {}


@pytest.mark.parametrize(
    "body,good",
    [
        ('<node id="1" lon="1" lat="2"><tag k="a" v="b></node>\n<node id="4" lon="1" lat="2"/>\n</osm>', [4]),
        ('<node id="x" lon="1" lat="2"/>\n<node id="4" lon="1" lat="2"/>\n</osm>', [4]),
        ('<node id="1" lon="1" lat="2"/>\n<node id="4" lon="1" lat="2"><tag k="a"', [1]),
        ('<node id="1" lon="1" lat="2"/>\n', [1]),
        ('<!-- <node id="9" lon="1" lat="2"/> --><node id="1" lon="1" lat="2"/></osm>', None),
        # a damaged start tag between two good nodes
        ('<node id="1" lon="1" lat="2"/><node\n<tag k="a" v="b"/></node><node id="2" lon="1" lat="2"/></osm>', [1, 2]),
        ('<node id="1" lon="1" lat="2"/><node <tag k="a" v="b"/></node><node id="2" lon="1" lat="2"/></osm>', [1, 2]),
        ('<node id="1" lon="1" lat="2"/><node<node id="2" lon="1" lat="2"/></osm>', [1, 2]),
        ('<node id="1" lon="1" lat="2"/><node\n\n<node id="2" lon="1" lat="2"/></osm>', [1, 2]),
        ('<node id="1" lon="1" lat="2"/><node <?xml version="1.0"?><osm><node id="2" lon="1" lat="2"/></osm>', None),
        ('<node id="1" lon="1" lat="2"/><node id="2" lon="1" lat="2"/></node></osm>', [1]),
        ('<node id="1" lon="1" lat="2"/></osm><node id="2" lon="1" lat="2"/></osm>', None),
        ('<node id="1" lon="1" lat="2"/></osm>\ntext', None),
        ('<node id="1" lon="1" lat="2"/></osm><?xml version="1.0"?><osm><node id="2" lon="1" lat="2"/></osm>', None),
    ],
)
def test_xml_malformed_input_stops_or_is_reported(spark, tmp_path, body, good):
    path = _osm(tmp_path / "in.osm", body)
    with pytest.raises(Exception, match="malformed OSM XML"):
        read_osm_nodes(spark, path).collect()
    nodes, bad = read_osm_nodes_report(spark, path)
    assert bad.count() > 0
    if good is not None:
        assert [r.import_id for r in nodes.collect()] == good


@pytest.mark.parametrize("head", ["", "\n ", "text <osm>", '<?xmlish version="1.0"?>', "<nodes><osm>"])
def test_xml_without_a_head(spark, tmp_path, head):
    path = _osm(tmp_path / "in.osm", '<node id="1" lon="1" lat="2"/></osm>', head=head)
    with pytest.raises(Exception, match="malformed OSM XML"):
        read_osm_nodes(spark, path)
    _, bad = read_osm_nodes_report(spark, path)
    assert "file has no head" in [r.reason for r in bad.collect()]


@pytest.mark.parametrize("text", ['\ufeff<?xml version="1.0"?><osm><bounds minlat="1"/></osm>', '<osm version="0.6"/>', "\n<osm>\n</osm>\n"])
def test_xml_without_nodes(spark, tmp_path, text):
    path = _osm(tmp_path / "in.osm", "", head=text)
    assert read_osm_nodes(spark, path).collect() == []
    nodes, bad = read_osm_nodes_report(spark, path)
    assert nodes.collect() == [] and bad.collect() == []


def test_large_xml_file_is_split(spark, tmp_path):
    n = 60_000
    body = "".join(f'<node id="{i}" lon="1.5" lat="2"><tag k="addr:street" v="Street number {i}"/></node>\n' for i in range(n))
    path = _osm(tmp_path / "big.osm", body + "</osm>")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        d = read_osm_nodes(spark, path, with_position=True)
        assert d.rdd.getNumPartitions() > 1
        assert [r.import_id for r in d.orderBy("position").select("import_id").collect()] == list(range(n))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
