"""Readers of files as their makers lay them out, what they reject, and the sink by folder."""

import pytest

from terrapop.sources import files

GRID = """<?xml version="1.0" encoding="UTF-8" standalone="yes"?>
<shakemap_grid xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance" xmlns="http://host.invalid/shakemap" event_id="us7000abcd" shakemap_id="us7000abcd" map_status="RELEASED">
  <event event_id="us7000abcd" magnitude="6.1" lat="1.0" lon="2.0"/>
  <grid_specification lon_min="1.500" lat_min="0.0" lon_max="2.5" lat_max="3.0" nominal_lon_spacing="0.5" nominal_lat_spacing="1.0" nlon="3" nlat="2"/>
  <event_specific_uncertainty name="pga" value="0.0"/>
  <grid_field index="1" name="LON" units="dd"/>
  <grid_field index="2" name="LAT" units="dd"/>
  <grid_field index="3" name="{name}" units="intensity"/>
  <grid_data>
{data}
  </grid_data>
</shakemap_grid>
"""
DATA = "1.5 3.0 4.25\n2.0 3.0 5\t\n2.5 3.0 6.5\n1.5 2.0 -1e-1\n2.0 2.0 nan\n2.5 2.0 7.0"


def test_grid_documents(spark, tmp_path):
    docs = {"good": GRID.format(name="mmi", data=DATA), "other": GRID.format(name="PGA", data=DATA), "short": GRID.format(name="MMI", data="1 2 3"), "empty": GRID.format(name="MMI", data=""), "none": '<shakemap_grid event_id="x"><grid_data>1</grid_data></shakemap_grid>', "broken": GRID.format(name="MMI", data=DATA).replace('nlat="2"', 'nlat="two"'), "cut": GRID.format(name="MMI", data=DATA)[:400]}
    for name, text in docs.items():
        (tmp_path / f"{name}.xml").write_text(text)
    read = lambda name: files.grid_documents(spark, str(tmp_path / f"{name}.xml"))
    reasons = {n: [r.reason for r in read(n).collect()] for n in docs}
    assert reasons["good"] == [None] and reasons["other"] == ["no_mmi_field"] and reasons["short"] == ["wrong_size"] and reasons["empty"] == ["no_data"] and reasons["none"] == ["no_specification"]
    assert reasons["broken"] == ["unreadable"] and reasons["cut"] in (["unreadable"], [])
    rows = files.read_grid_xml(spark, str(tmp_path / "good.xml"), ("LON", "LAT", "MMI", "PSA")).orderBy("i").collect()
    assert [(r.event_id, r.i, round(r.lon, 6), round(r.lat, 6), r.psa) for r in rows] == [("us7000abcd", i, 1.5 + i % 3 * 0.5, 3.0 - i // 3, None) for i in range(6)]
    assert [r.mmi if r.mmi == r.mmi else None for r in rows] == [4.25, 5.0, 6.5, -0.1, None, 7.0]


def test_catalog_over_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text('{\n "type": "FeatureCollection",\n "features": [\n  {"id": "us1", "properties": {"title": "M 6", "mag": 6.0,\n   "types": ",shakemap,"}, "geometry": {"coordinates": [1.0, 2.0, 9.5]}},\n  {"id": "us2", "properties": {"mag": null}, "geometry": null}\n ]\n}\n')
    (tmp_path / "b.json").write_text('{"features": [\n {"id": "us3"')
    (tmp_path / "c.json").write_text('{"type": "Feature"}')
    got = {r.event_id: (r.title, r.magnitude, r.types, r.depth) for r in files.read_catalog_json(spark, str(tmp_path)).collect()}
    assert got == {"us1": ("M 6", 6.0, ",shakemap,", 9.5), "us2": (None, None, "", None)}
    assert {r.file.rpartition("/")[2]: r.reason for r in files.catalog_documents(spark, str(tmp_path)).collect()} == {"a.json": None, "b.json": "unreadable", "c.json": "no_features"}


@pytest.mark.parametrize("multi_line", [False, True])
def test_items(spark, tmp_path, multi_line):
    item = '{"id": "%s", "bbox": %s, "properties": {"datetime": "2024-01-05T10:11:12Z"}, "assets": {"%s": {"href": "s3://x/y.tif"}}}'
    items = [item % ("a", "[1, 2, 3, 4]", "water"), item % ("b", "[1, 2, -9, 3, 4, 90]", "water"), item % ("c", "[1, 2, 3, 4]", "ice"), item % ("d", "null", "water"), '{"id": "e", ', item % ("f", "[1, 2]", "water")]
    if multi_line:
        for k, x in enumerate(items):
            (tmp_path / f"{k}.json").write_text(x.replace(", ", ",\n  "))
    else:
        (tmp_path / "items.json").write_text("\n".join(items))
    rows = files.item_documents(spark, str(tmp_path), "water", multi_line).collect()
    assert sorted(str(r.reason) for r in rows) == ["None", "None", "no_asset", "no_bbox", "no_bbox", "unreadable"]
    good = {r.item_id: (r.west, r.south, r.east, r.north, str(r.item_ts)) for r in rows if r.reason is None}
    assert good == dict.fromkeys("ab", (1.0, 2.0, 3.0, 4.0, "2024-01-05 10:11:12"))


def test_lookup_with_byte_order_mark(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("﻿ISO-alpha3 Code;M49 Code;Country or Area\nfra;250;First\n BEL ;056;Belgium\n;1;None\nDEU;;None\n".encode())
    (tmp_path / "b.csv").write_bytes("﻿ISO-alpha3 Code;M49 Code;Country or Area\nFRA;249;Later\nFRA;25;Last\n".encode())
    got = {r.iso3: (r.m49, r.country) for r in files.read_iso_lookup(spark, str(tmp_path)).collect()}
    assert got == {"FRA": ("25", "Last"), "BEL": ("056", "Belgium")}
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "d.csv").write_text("code;name\nFRA;x\n")
    assert files.read_iso_lookup(spark, str(tmp_path / "c")).count() == 0


def test_folders_are_written_when_they_change(spark, tmp_path):
    import os

    base = f"file://{tmp_path}/out"
    rows = [("A", 1), ("A", 2), ("B", 3), ("C", 4)]
    frame = lambda r: spark.createDataFrame(r, "iso3 string, v int").repartition(3)
    written = lambda r: sorted((x.key, x.rows) for x in files.write_changed(frame(r), "iso3", base).collect())
    held = lambda: sorted((r.iso3, r.v) for r in spark.read.parquet(f"{base}/data").collect())
    times = lambda: {d: max(os.stat(f"{tmp_path}/out/data/{d}/{f}").st_mtime_ns for f in os.listdir(f"{tmp_path}/out/data/{d}")) for d in os.listdir(f"{tmp_path}/out/data") if "=" in d}
    assert written(rows) == [("A", 2), ("B", 1), ("C", 1)] and held() == rows
    before = times()
    assert written(rows[::-1]) == [] and times() == before
    assert written(rows[:3] + [("C", 5), ("D", 6)]) == [("C", 1), ("D", 1)]
    assert held() == rows[:3] + [("C", 5), ("D", 6)]
    assert {k for k, t in times().items() if t == before.get(k)} == {"iso3=A", "iso3=B"}
    assert {r.key: r.writes for r in files.ledger(spark, base).collect()} == {"A": 1, "B": 1, "C": 2, "D": 1}


def test_cubes(spark, tmp_path):
    cube = lambda name, cols: (spark.createDataFrame([(1.0, 2.0, "2024-01-01", 5.0, 6)], cols).write.parquet(str(tmp_path / name)), str(tmp_path / name))[1]
    one = lambda path, *v: tuple(files.read_cube(spark, path, v).first())
    a = cube("a", ["Latitude", "lon", "valid_time", "t2m", "UTCI"])
    assert one(a, "utci", "t2m") == (1.0, 2.0, "2024-01-01", 6.0) and one(a, "t2m") == (1.0, 2.0, "2024-01-01", 5.0) and one(a, "none")[3] == 5.0
    with pytest.raises(ValueError, match="lat"):
        files.read_cube(spark, cube("b", ["row", "x", "time", "v", "w"]), ("v",))
    with pytest.raises(ValueError, match="no variable"):
        files.read_cube(spark, (spark.createDataFrame([(1.0, 2.0, "t")], ["y", "x", "time"]).write.parquet(str(tmp_path / "c")), str(tmp_path / "c"))[1], ("v",))
