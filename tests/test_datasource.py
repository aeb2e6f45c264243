from __future__ import annotations

import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from addrloom.sources import geojson
from addrloom.sources.datasource import register
from test_sources import LINES

MORE = [
    '{"properties":{"number":1.5,"street":"x","unit":2.0,"city":[1,"a"],"region":{"b":1,"a":null},"state":true}}',
    '{"type":"FeatureCollection","features":[]}', '{"type":"FeatureCollection"}', "{}", '{"a":1} {"b":2}',
    ' \x1e\x1e {"properties":{"number":"9","street_name":7,"locality":"é"}} \r', '{"properties":{"number":NaN}}',
    '{"type":"Feature","properties":{"number":12345678901234567890,"street":"","street_name":"s","country":5}}',
]
COLUMNS = ["job_id", "item", *geojson.PROPERTIES, "not_text"]


@pytest.fixture
def folder(tmp_path):
    for job, lines in (("17", LINES), ("18", MORE), ("x-9", LINES[:2])):
        (tmp_path / f"{job}.geojson.gz").write_bytes(gzip.compress("\n".join(lines).encode()))
    (tmp_path / "20.geojson").write_text("\n".join(LINES) + "\n")
    (tmp_path / "_hidden.geojson").write_text(LINES[0])
    return tmp_path


def rows(df):
    return sorted(df.select(*COLUMNS).collect(), key=repr)


def test_same_rows_as_the_jvm_reader(spark, folder):
    found = register(spark).read.format("address_features").load(str(folder))
    assert rows(found) == rows(geojson.read_features(spark, str(folder)))
    single = spark.read.format("address_features").load(str(folder / "20.geojson"))
    assert {r.job_id for r in single.collect()} == {"20"}
    wild = spark.read.format("address_features").load(f"{folder}/1*.gz")
    assert {r.job_id for r in wild.collect()} == {"17", "18"}


def test_conditions_choose_files(spark, folder):
    """A broken file that no condition names is not opened."""
    (folder / "99.geojson.gz").write_bytes(b"\x1f\x8bbroken")
    source = register(spark).read.format("address_features").load(str(folder))
    with pytest.raises(Exception, match="99.geojson.gz|gzip|EOF|Compressed"):
        source.count()
    one = source.where("job_id = '17' AND street = 'A'")
    assert one.count() == 1
    assert source.where(F.col("job_id").isin("17", "18")).select("job_id").distinct().count() == 2
    assert source.where(F.col("job_id").startswith("x-")).count() == 2
    assert source.where("street = 'A' AND job_id IN ('20', 'none')").count() == 1


def test_cut_files(spark, folder):
    line = json.dumps({"properties": {"number": "1", "street": "S"}}) + "\n"
    whole = gzip.compress("".join(line.replace("S", f"S{i * 7919 % 10007}") for i in range(20_000)).encode())
    (folder / "30.geojson.gz").write_bytes(whole[: len(whole) // 2])
    reader = register(spark).read.format("address_features").option("whole_files", "true")
    with pytest.raises(Exception, match="30.geojson.gz"):
        reader.load(str(folder)).count()
    skipped = reader.option("on_broken", "skip").load(str(folder))
    assert {r.job_id for r in skipped.select("job_id").distinct().collect()} == {"17", "18", "x-9", "20"}
    with pytest.raises(Exception, match="whole_files"):
        spark.read.format("address_features").option("on_broken", "skip").load(str(folder)).count()


def test_stream_takes_new_files_once(spark, folder, tmp_path_factory):
    work = tmp_path_factory.mktemp("stream")

    def run():
        source = register(spark).readStream.format("address_features").load(str(folder))
        query = (
            source.writeStream.format("parquet")
            .option("checkpointLocation", str(work / "state"))
            .trigger(availableNow=True)
            .start(str(work / "out"))
        )
        query.awaitTermination()
        return spark.read.parquet(str(work / "out"))

    assert rows(run()) == rows(geojson.read_features(spark, str(folder)))
    late = folder / "40.geojson"
    late.write_text("\n".join(MORE))
    os.utime(late, ns=(2_000_000_000 * 10**9,) * 2)
    assert rows(run()) == rows(geojson.read_features(spark, str(folder)))
    assert run().where("job_id = '40'").count() == len(rows(geojson.read_features(spark, str(late))))
