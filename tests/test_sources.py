import json
import struct
import threading
import time
import zipfile
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest

from cedarloom.operators import infer
from cedarloom.operators.stores import Store
from cedarloom.sources import catalogue, feeds, files, shapes, sheets
from cedarloom.streaming.sync import index_enriched


def test_csv_encodings(spark, tmp_path):
    for enc in ("utf-8", "latin-1", "utf-16"):
        p = tmp_path / f"{enc}.csv"
        p.write_bytes("name,n\ncafé,1\nété,2\n".encode(enc))
        assert sorted((r["name"], r["n"]) for r in files.read_csv(spark, str(p)).collect()) == [("café", 1), ("été", 2)]


@pytest.mark.parametrize("doc,n,kind", [
    ([{"a": 1}, {"a": 2}], 2, "array"), ({"records": [{"a": 1}]}, 1, "records"), ({"result": {"records": [{"a": 1}, {"a": 2}]}}, 2, "ckan"), ({"success": True, "things": [{"a": 1}, 2]}, 2, "object"),
    ({"a": 1}, 1, "object"), ({"data": []}, 0, None), (5, 0, None), ({"type": "FeatureCollection", "features": [{"type": "Feature"}]}, 1, "geojson"),
])
def test_json_shapes(spark, tmp_path, doc, n, kind):
    (tmp_path / "d.json").write_text(json.dumps(doc, indent=1))
    rows = files.read_json(spark, str(tmp_path / "d.json")).selectExpr("structure", "to_json(record) as r").collect()
    assert len(rows) == n and (not n or rows[0]["structure"] == kind)


def test_features(spark, tmp_path):
    g = {"type": "FeatureCollection", "features": [{"type": "Feature", "id": 7, "properties": {"n": "x"}, "geometry": {"type": "Point", "coordinates": [1, 2]}}, 3]}
    (tmp_path / "f.geojson").write_text(json.dumps(g))
    r = files.flatten_features(files.read_json(spark, str(tmp_path / "f.geojson"))).selectExpr("cast(fields['n'] as string) as n", "geometry", "_feature_id").collect()
    assert [(x["n"], json.loads(x["geometry"])["coordinates"], x["_feature_id"]) for x in r] == [("x", [1, 2], "7")]


def test_xml(spark, tmp_path):
    (tmp_path / "r.xml").write_text('<r xmlns="urn:x"><row><a>1</a><b> two </b></row><leaf k="v"/><empty/></r>')
    assert [r["fields"] for r in files.read_xml(spark, str(tmp_path / "r.xml")).orderBy("position").collect()] == [{"a": "1", "b": "two"}, {"k": "v"}]


def test_text(spark, tmp_path):
    (tmp_path / "pipe.txt").write_text("A Name|B|C|D\n" + "x|1||\n" * 12)
    assert files.read_txt(spark, str(tmp_path / "pipe.txt")).columns == ["a_name", "b"]
    (tmp_path / "prose.txt").write_text("one\n\n two \n")
    assert [tuple(r) for r in files.read_txt(spark, str(tmp_path / "prose.txt")).collect()] == [(1, "one"), (3, "two")]
    (tmp_path / "fixed.txt").write_text("id  name\n1   ann\n22  bob\n")
    assert sorted(tuple(r) for r in files.read_fixed_width(spark, str(tmp_path / "fixed.txt")).collect()) == [("1", "ann"), ("22", "bob")]


def xlsx(path, rows):
    cell = lambda v: f'<c t="inlineStr"><is><t>{v}</t></is></c>' if isinstance(v, str) else "<c/>" if v is None else f"<c><v>{v}</v></c>"
    body = "".join(f"<row>{''.join(map(cell, r))}</row>" for r in rows)
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="S" sheetId="1" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Target="worksheets/s.xml"/></Relationships>')
        z.writestr("xl/worksheets/s.xml", f"<worksheet {main}><sheetData>{body}</sheetData></worksheet>")


def test_workbook(spark, tmp_path):
    p = str(tmp_path / "u.xlsx")
    xlsx(p, [["Report", None, None, None], ["Ward Name", "Units", "%", None], ["North", 10, 0.25, 1], ["South", 30, 0.755, 2], ["Total", 40, 1, 3], [None, None, None, None]])
    got = sheets.read_xlsx(spark, p)
    assert got.columns == ["ward_name", "units", "units_pct", "id"]
    assert [tuple(r) for r in got.collect()] == [("North", "10", "25.0", "1"), ("South", "30", "75.5", "2")]
    assert sheets.read_xlsx_sheets(spark, p).count() == 3


def shp(tmp_path):
    ring = [(0, 0), (0, 2), (2, 2), (2, 0), (0, 0)]
    poly = struct.pack("<i4d2ii", 5, 0, 0, 2, 2, 1, 5, 0) + b"".join(struct.pack("<2d", *p) for p in ring)
    rec = [poly, struct.pack("<i", 0)]
    body = b"".join(struct.pack(">2i", i + 1, len(r) // 2) + r for i, r in enumerate(rec))
    (tmp_path / "a.shp").write_bytes(b"\0" * 100 + body)
    field = b"NAME".ljust(11, b"\0") + b"C" + b"\0" * 4 + bytes([5]) + b"\0" * 15
    (tmp_path / "a.dbf").write_bytes(b"\3\0\0\0" + struct.pack("<IHH", 2, 32 + 32 + 1, 6) + b"\0" * 20 + field + b"\r" + b" one  " + b" two  ")
    return str(tmp_path / "a.shp")


def test_shapefile(spark, tmp_path):
    r = shapes.read_shp(spark, shp(tmp_path)).orderBy("position").collect()
    assert [(x["fields"]["name"], x["geometry_type"], x["centroid_lat"], x["centroid_lon"]) for x in r] == [("one", "Polygon", 1.0, 1.0), ("two", None, None, None)]
    assert json.loads(shapes.geojson_features(shapes.read_shp(spark, shp(tmp_path))).first()["value"])["type"] == "Feature"
    lon, lat = shapes.from_utm(630084, 4833438, 17)
    assert abs(lon + 79.387) < 0.01 and abs(lat - 43.642) < 0.01


def test_zip_refuses_to_leave_its_folder(spark, tmp_path):
    p = tmp_path / "m.zip"
    with zipfile.ZipFile(p, "w") as z:
        z.writestr("b.json", "[]")
        z.writestr("a.csv", "n\n1\n")
        z.writestr("../evil.csv", "n\n2\n")
    (tmp_path / "out").mkdir()
    assert [r["n"] for r in files.read_zip(spark, str(p), str(tmp_path / "out")).collect()] == [1]
    assert not (tmp_path / "evil.csv").exists()
    assert files.list_files(str(tmp_path / "out")) == ["a.csv", "b.json"]


class Portal(BaseHTTPRequestHandler):
    def do_GET(self):
        from urllib.parse import parse_qs, urlparse

        u = urlparse(self.path)
        q = {k: v[0] for k, v in parse_qs(u.query).items()}
        if "missing" in u.path:
            self.send_error(404)
            return
        if "package_show" in u.path:
            out = {"result": {"resources": [{"id": "r", "name": "n", "format": "CSV", "url": "u", "datastore_active": True}]}}
        else:
            rows = [{"i": i} for i in range(25)]
            o, n = int(q.get("offset", 0)), int(q.get("limit", 10))
            out = {"result": {"total": 25, "records": rows[o : o + n]}}
        self.send_response(200)
        self.end_headers()
        self.wfile.write(json.dumps(out).encode())

    def log_message(self, *a):
        pass


def test_portal(spark, tmp_path):
    server = HTTPServer(("127.0.0.1", 0), Portal)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_port}"
    rows = catalogue.read_records(spark, base, "r", limit=10)
    assert rows.rdd.getNumPartitions() == 3
    assert sorted(json.loads(r["record"])["i"] for r in rows.collect()) == list(range(25))
    assert catalogue.resources_of(spark, base, "p").count() == 1
    assert catalogue.download(f"{base}/missing", str(tmp_path / "x")).reason == "not found"
    assert catalogue.download(f"{base}/a", str(tmp_path / "d/x")).ok
    server.shutdown()


def test_feeds(spark):
    html = '<link type="application/rss+xml" href="/f.rss" title="T"><link type="text/css" href="/x.xml"><a href="/news/x">N <b>x</b></a><a href="/a.html">p</a><a href="../feed#f">q</a>'
    rows = feeds.feeds(spark.createDataFrame([(1, "http://h/p/q", html), (2, "http://h/", None)], "page_id bigint, url string, html string")).collect()
    assert {(r["url"], r["title"], r["source"]) for r in rows} == {("http://h/f.rss", "T", "link_tag"), ("http://h/news/x", "N x", "a_tag")}


def test_inference(spark):
    recs = [
        {"n": 1, "x": 1, "flag": True, "mixed": 1, "overdose_count": 3, "d": "2020-01-02", "location": {"lat": 1, "lon": 2}, "geometry": {"type": "Point", "coordinates": [1, 2]}, "tags": ["a"], "empty": None},
        {"n": 2, "x": 2.5, "flag": False, "mixed": True, "overdose_count": 4, "d": "2020-01-03", "tags": ["b"], "empty": "", "long": "w" * 200},
        {"long": "w" * 200}, {"long": "v" * 200},
    ]
    df = spark.createDataFrame([("f", json.dumps(r)) for r in recs], "source_file string, s string").selectExpr("source_file", "parse_json(s) as record")
    types = infer.field_types(infer.fields(df)).cache()
    got = {r["path"]: r["type"] for r in types.collect()}
    want = {"n": "long", "x": "float", "flag": "boolean", "mixed": "keyword", "overdose_count": "date", "d": "date", "location": "geo_point", "geometry": "geo_shape", "tags": "keyword", "empty": "keyword", "long": "text"}
    assert {k: got[k] for k in want} == want and got["location.lat"] in ("long", "float")
    m = infer.mapping(types)
    assert m["overdose_count"] == "date" and infer.schema(m)["location"].dataType.simpleString() == "struct<lat:double,lon:double>"
    assert infer.report(types).count() == len(got)


def test_encodings_are_those_of_each_value(spark, tmp_path):
    from cedarloom.sources import files as F

    (tmp_path / "a.csv").write_bytes(b"Ville,n\n" + b"Paris,1\n" * 200_000 + "Québec,2\n".encode("cp1252"))
    df = F.read_csv(spark, str(tmp_path / "a.csv"))
    assert df.where("n = 2").first()[0] == "Québec" and df.count() == 200_001
    (tmp_path / "b.csv").write_bytes("﻿Été,n\nMontréal,1\n\"a, “b”\",2\n".encode())
    assert [tuple(r) for r in F.read_csv(spark, str(tmp_path / "b.csv")).collect()] == [("Montréal", 1), ("a, “b”", 2)]
    assert F.read_csv(spark, str(tmp_path / "b.csv")).columns == ["Été", "n"]
    (tmp_path / "c.txt").write_bytes("Montréal – un\n\nQuébec €\n".encode("cp1252"))
    assert [tuple(r) for r in F.read_txt(spark, str(tmp_path / "c.txt")).collect()] == [(1, "Montréal – un"), (3, "Québec €")]
    (tmp_path / "d.csv").write_bytes("Ville,n\nQuébec,2\n".encode("utf-16"))
    assert F.read_csv(spark, str(tmp_path / "d.csv")).first()[0] == "Québec"


def test_malformed_lines_are_reported(spark, tmp_path):
    from cedarloom.sources import files as F

    (tmp_path / "a.csv").write_text("a,b\n1,x\n2,y,z\n3,w\n")
    assert [tuple(r) for r in F.read_csv(spark, str(tmp_path / "a.csv")).collect()] == [(1, "x"), (3, "w")]
    assert [r[0] for r in F.malformed(spark, str(tmp_path / "a.csv")).collect()] == ["2,y,z"]


def test_lines_keep_their_numbers_in_any_number_of_splits(spark, tmp_path):
    from cedarloom.sources import files as F

    for name in ("a.txt", "b.txt"):
        (tmp_path / name).write_text("".join(f"{name} line {i}\n" for i in range(1, 4001)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        got = F.lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(got) == 8000 and all(r["value"].endswith(f"line {r['line_number']}") for r in got)


def test_fixed_width_text_is_found(spark, tmp_path):
    from cedarloom.sources import files as F

    (tmp_path / "w.txt").write_bytes("City        Ward    Name\nMontréal    5       A b\nCity        Ward    Name\nTamsley     12      C d e f\n".encode("latin-1"))
    got = F.read_txt(spark, str(tmp_path / "w.txt"))
    assert got.columns == ["city", "ward", "name"] and [tuple(r) for r in got.collect()] == [("Montréal", "5", "A b"), ("City", "Ward", "Name"), ("Tamsley", "12", "C d e f")]


def test_malformed_xml_spoils_nothing_else(spark, tmp_path):
    from cedarloom.sources import files as F

    (tmp_path / "a.xml").write_text("<r><i><n>A & B</n></i></r>")
    (tmp_path / "b.xml").write_text("<r><i><n>broken</i></r>")
    (tmp_path / "c.xml").write_text("<r><i><n>C</n></i></r>")
    assert sorted(r["fields"]["n"] for r in F.read_xml(spark, str(tmp_path)).collect()) == ["A & B", "C"]


def test_records_of_a_published_file_carry_no_copy_of_it(spark, tmp_path):
    doc = {"_metadata": {"dataset_id": "d"}, "records": [{"n": i, "t": "x" * 60} for i in range(60_000)] + [5]}
    (tmp_path / "d.json").write_text(json.dumps(doc))
    began = time.time()
    store = Store(spark, str(tmp_path / "g"), "_unique_id")
    assert index_enriched(files.read_enriched(spark, str(tmp_path / "d.json")), store) == {"indexed": 60_000, "failed": 1, "files": 1}
    assert time.time() - began < 60
    assert store.read().where("_unique_id = 'd:59999'").selectExpr("get_json_object(record, '$.n') as n").first()[0] == "59999"


def test_a_published_file_beyond_the_size_of_a_variant_is_read(spark, tmp_path):
    n = 70_000
    with open(tmp_path / "d.json", "w") as f:
        f.write('{"_metadata": {"dataset_id": "d"}, "records": [' + ",".join(json.dumps({"n": i, "t": "x" * 2_000}) for i in range(n)) + "]}")
    got = files.read_enriched(spark, str(tmp_path / "d.json")).selectExpr("dataset_id", "position", "try_variant_get(record, '$.n', 'int') as n")
    assert tuple(got.selectExpr("count(*)", "count_if(n = position)", "min(dataset_id)").first()) == (n, n, "d")
