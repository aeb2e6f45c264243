from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from addrloom.streaming.normalize import batch_output, checked_stream, start_unique_stream

DAY = 86_400


def land(folder, name, streets, day):
    lines = [
        json.dumps({"type": "Feature", "properties": {
            "number": "1", "street": s, "city": "Town", "region": "NY", "postcode": "10001", "country": "US"}})
        for s in streets
    ]
    path = folder / f"{name}.geojson"
    path.write_text("\n".join(lines))
    os.utime(path, (1_700_000_000 + day * DAY,) * 2)


@pytest.fixture
def jobs(spark):
    return spark.createDataFrame(
        [(n, "us/ny/town", k) for k, n in enumerate("abcdef")], "job_id string, source_name string, position int"
    )


def run(spark, folder, jobs, keep=None):
    rows = checked_stream(spark, str(folder / "in"), jobs, max_files=1)
    out = str(folder / "out")
    start_unique_stream(rows, batch_output(out), str(folder / "state"), keep=keep).awaitTermination()
    found = spark.read.parquet(out).groupBy("address_norm").agg(F.count("*").alias("n")).collect()
    return {r.address_norm.split("|")[0] if "|" in r.address_norm else r.address_norm: r.n for r in found}


def test_repeats_across_batches_and_starts(spark, jobs, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    land(folder, "a", ["main", "main", "oak"], 0)
    land(folder, "b", ["main", "elm"], 400)
    first = run(spark, tmp_path, jobs)
    assert len(first) == 3 and set(first.values()) == {1}
    land(folder, "c", ["oak", "elm", "ash"], 900)
    again = run(spark, tmp_path, jobs)
    assert len(again) == 4 and set(again.values()) == {1}


def test_bounded_state(spark, jobs, tmp_path):
    """A repeat within the interval is dropped; far behind it the string is forgotten and may pass."""
    folder = tmp_path / "in"
    folder.mkdir()
    land(folder, "a", ["main"], 0)
    land(folder, "b", ["main", "oak"], 1)
    land(folder, "c", ["elm"], 100)
    found = run(spark, tmp_path, jobs, keep="30 days")
    assert len(found) == 3 and set(found.values()) == {1}
    progress = spark.read.json(str(tmp_path / "state" / "metadata"))
    assert progress.count() == 1
    land(folder, "d", ["main", "elm"], 101)
    found = run(spark, tmp_path, jobs, keep="30 days")
    assert sorted(found.values()) == [1, 1, 2]
