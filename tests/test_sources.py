"""Readers on small files of every kind they tell apart."""

from __future__ import annotations

import gzip
import json
import struct

import pytest
from pyspark.sql import functions as F

from addrloom.plans.boundaries import load_counties, load_states
from addrloom.operators.quality import KeyViolationError
from addrloom.sources import geojson
from addrloom.sources.boundaries import COUNTY_MEMBER, read_boundaries, to_wkb
from addrloom.sources.manifest import read_manifest
from checks.archives import COUNTY_FIELDS, dbf_file, polygon, shp_file, square, zip_file

LINES = [
    '{"type":"Feature","properties":{"number":7,"street":"A"},"geometry":{"x":[1]}}',
    '\x1e{"type":"Feature","properties":{"number":"0","street":"B"}}',
    "",
    '{"type":"Feature","properties":{"number":',
    "[1]",
    '{"type":"FeatureCollection","features":[{"properties":{"number":"1","street":"C"}},null,{"properties":null}]}',
    '{"type":"Other","properties":{"number":0,"street":"D"}}',
    '{"type":"Other","properties":3}',
    '{"type":"Feature","properties":{"number":"2","street":5}}',
    '{"type":"Feature","properties":{"number":"3","street":"last"}}',
]


def write_gzip(path, text: str) -> None:
    path.write_bytes(gzip.compress(text.encode()))


def test_feature_file(spark, tmp_path):
    write_gzip(tmp_path / "17.geojson.gz", "\n".join(LINES))
    rows = geojson.read_features(spark, str(tmp_path)).collect()
    assert {row.job_id for row in rows} == {"17"}
    assert sorted((r.number or "", r.street or "", r.not_text) for r in rows) == sorted(
        [
            ("7", "A", False), ("0", "B", False), ("1", "C", False), ("", "", False),
            ("", "D", False), ("2", "5", True), ("3", "last", False),
        ]
    )
    bad = geojson.malformed(geojson.parse(geojson.read_lines(spark, str(tmp_path))))
    assert bad.count() == 2


def test_cut_file_keeps_earlier_rows_and_other_files(spark, tmp_path):
    line = '{"type":"Feature","properties":{"number":"%d","street":"S%d"}}\n'
    body = "".join(line % (i, i * 7919 % 10007) for i in range(50_000))
    whole = gzip.compress(body.encode())
    (tmp_path / "1.geojson.gz").write_bytes(whole[: len(whole) // 2])
    write_gzip(tmp_path / "2.geojson.gz", line % (1, 1))
    rows = geojson.read_features(spark, str(tmp_path), skip_cut_files=True)
    counts = dict(rows.groupBy("job_id").count().collect())
    assert counts["2"] == 1
    assert 0 < counts["1"] < 50_000
    cut = geojson.cut_files(spark, str(tmp_path)).collect()
    assert [r.file_path.rsplit("/", 1)[1] for r in cut] == ["1.geojson.gz"]
    with pytest.raises(Exception):
        geojson.read_features(spark, str(tmp_path)).count()
    # Files of other jobs are not opened, so a broken one among them does not matter.
    chosen = spark.createDataFrame([("2",)], "job_id STRING")
    assert geojson.read_features(spark, str(tmp_path), jobs=chosen).count() == 1


def test_spread_keeps_all_rows(spark, tmp_path):
    write_gzip(tmp_path / "1.geojson.gz", "\n".join(LINES))
    lines = geojson.read_lines(spark, str(tmp_path))
    assert geojson.spread(lines).rdd.getNumPartitions() > 1
    assert geojson.spread(lines).count() == len(LINES)


def test_manifest(spark, tmp_path):
    (tmp_path / "m.json").write_text(
        '[{"job":5,"source":"us/ca/x","layer":"addresses"},{"job":0,"source":"us/ca/y","layer":"addresses"},'
        '{"job":"a","source":"us/ca","layer":"addresses"},{"job":9,"source":"us/cal/x","layer":"addresses"},'
        '{"job":8,"source":"us/ca/z","layer":"buildings"},{"source":"us/ca/q","layer":"addresses"}]'
    )
    path = str(tmp_path / "m.json")
    assert [r.job_id for r in read_manifest(spark, path, source="us/ca").orderBy("position").collect()] == ["5", "a"]
    assert [r.job_id for r in read_manifest(spark, path, jobs_limit=1).collect()] == ["5"]
    assert read_manifest(spark, path, jobs_limit=0).count() == 0


def test_manifest_layouts_and_order(spark, tmp_path):
    entries = [{"job": k, "source": "us/ca/x", "layer": "addresses"} for k in range(1, 7)]
    (tmp_path / "a.json").write_text(json.dumps(entries[:2], indent=2))
    (tmp_path / "b.json").write_text("\n".join([json.dumps(entries[2]), "no json", "", json.dumps(entries[3])]))
    (tmp_path / "c.json").write_text(json.dumps(entries[4], indent=4) + "\n")
    (tmp_path / "d.json").write_text(json.dumps(entries[5:]))
    for files, limit in ((1, 6), (1, 3), (4, 3)):
        spark.conf.set("spark.sql.files.openCostInBytes", 1 if files > 1 else 4 << 20)
        got = read_manifest(spark, str(tmp_path), jobs_limit=limit).orderBy("position").collect()
        assert [r.job_id for r in got] == [str(k) for k in range(1, limit + 1)]
    spark.conf.unset("spark.sql.files.openCostInBytes")


def county_zip(rows, shapes=None) -> bytes:
    shapes = shapes or [square(i, i) for i in range(len(rows))]
    return zip_file(
        {
            "tl_2021_us_county.shp": shp_file(shapes),
            "tl_2021_us_county.dbf": dbf_file(COUNTY_FIELDS, rows),
            "readme.txt": b"x",
        }
    )


def test_boundary_attributes_and_geometry(spark, tmp_path):
    rows = [("06", "001", "06001", "Ñame", "0012"), (None, "x", "x", "x", "1"), ("06", "003", "06003", "", "")]
    (tmp_path / "c.zip").write_bytes(county_zip(rows))
    got = read_boundaries(spark, str(tmp_path), COUNTY_MEMBER).orderBy("geoid").collect()
    assert [(r.geoid, r.name, r.aland, r.srid) for r in got] == [
        ("06001", "Ñame", "12", 4269), ("06003", "", None, 4269),
    ]
    ring = [(0, 0), (0, 1), (1, 1), (1, 0), (0, 0)]
    wkb = struct.pack("<BIII", 1, 3, 1, 5) + b"".join(struct.pack("<2d", *p) for p in ring)
    assert bytes(got[0].the_geom) == wkb


def box(x, y, size, clockwise):
    ring = [(x, y), (x, y + size), (x + size, y + size), (x + size, y), (x, y)]
    return ring if clockwise else ring[::-1]


def test_rings_are_grouped_into_polygons():
    one_hole = to_wkb(polygon([box(0, 0, 10, True), box(1, 1, 2, False)]))
    assert struct.unpack_from("<BII", one_hole) == (1, 3, 2)
    shells = [box(0, 0, 10, True), box(20, 0, 10, True), box(21, 1, 2, False)]
    many = to_wkb(polygon(shells))
    assert struct.unpack_from("<BII", many) == (1, 6, 2)
    first_rings = struct.unpack_from("<BII", many, 9)
    second_rings = struct.unpack_from("<BII", many, 9 + 9 + 4 + 5 * 16)
    assert (first_rings, second_rings) == ((1, 3, 1), (1, 3, 2))
    assert to_wkb(struct.pack("<i", 0)) is None
    assert to_wkb(struct.pack("<i2d", 1, 2, 3)) == struct.pack("<BI2d", 1, 1, 2, 3)


def test_boundary_jobs(spark, tmp_path):
    state_fields = [("STATEFP", "C", 2, 0), ("STUSPS", "C", 2, 0)]
    (tmp_path / "s").mkdir()
    (tmp_path / "c").mkdir()
    (tmp_path / "s" / "s.zip").write_bytes(
        zip_file({"tl_2021_us_state.shp": shp_file([square(0, 0), square(1, 1)]),
                  "tl_2021_us_state.dbf": dbf_file(state_fields, [("06", "CA"), ("36", "NY")])})
    )
    rows = [("06", "001", "06001", "Alameda", "1"), ("36", "061", "36061", "New York", "2"), ("99", "001", "99001", "Nowhere", "3")]
    (tmp_path / "c" / "c.zip").write_bytes(county_zip(rows))
    for _ in range(2):
        states = load_states(spark, str(tmp_path / "s"), path=str(tmp_path / "state_all"))
        lookup_states = states.select("statefp", F.col("stusps").alias("abbrev"))
        counties, lookup = load_counties(
            spark, str(tmp_path / "c"), lookup_states,
            path=str(tmp_path / "county_all"), lookup_path=str(tmp_path / "lookup"),
        )
        assert counties.count() == 3
        assert sorted(map(tuple, lookup.collect())) == [(6, "CA", 1, "Alameda"), (36, "NY", 61, "New York")]
    (tmp_path / "c" / "c.zip").write_bytes(county_zip(rows + rows[:1]))
    with pytest.raises(KeyViolationError, match="pk_county_all"):
        load_counties(spark, str(tmp_path / "c"), lookup_states, path=str(tmp_path / "x"), lookup_path=str(tmp_path / "y"))


def test_archives_with_different_layouts(spark, tmp_path):
    """Each archive is read by its own field order; a field that one lacks is null there."""
    swapped = list(reversed(COUNTY_FIELDS))
    rows = [[str(k) for k in range(len(COUNTY_FIELDS))]]
    (tmp_path / "a.zip").write_bytes(county_zip(rows))
    (tmp_path / "b.zip").write_bytes(
        zip_file(
            {
                "tl_2022_us_county.shp": shp_file([square(1, 1)]),
                "tl_2022_us_county.dbf": dbf_file(swapped[1:], [list(reversed(rows[0]))[1:]]),
            }
        )
    )
    names = [field[0].lower() for field in COUNTY_FIELDS]
    got = read_boundaries(spark, str(tmp_path), COUNTY_MEMBER).select(*names).collect()
    whole, part = sorted(map(tuple, got), key=lambda r: r[-1] is None)
    assert part[-1] is None and part[:-1] == whole[:-1]
