"""Whole jobs: counters, duplicates, sinks, streams, skew."""

from __future__ import annotations

import gzip

import pytest
from pyspark.sql import functions as F

from addrloom.operators import search, tables
from addrloom.operators.counters import run_counters
from addrloom.operators.dedupe import dedupe, number_batches
from addrloom.operators.joins import lookup_join, top_k
from addrloom.operators.records import RECORD_COLUMNS, with_canonical
from addrloom.plans.normalize import canonical_rows, checked_records, normalize_job
from addrloom.streaming.normalize import (
    StatusLog, batch_output, checked_stream, merged_output, start_normalize_stream,
)
from checks import fixtures


@pytest.fixture(scope="module")
def inputs(spark, sf_dir):
    return fixtures.features(spark, sf_dir)


def test_job_report_adds_up_and_matches_the_exact_query(spark, sf_dir, inputs, tmp_path):
    jobs = fixtures.jobs(spark, sf_dir)
    report = normalize_job(
        inputs, jobs, sink=tables.sink_for(csv_path=str(tmp_path / "csv")),
        rejects=lambda rows: rows.write.parquet(str(tmp_path / "rejects")),
    )
    exact = run_counters(with_canonical(checked_records(inputs, jobs))).head()
    assert (report.processed, report.written, report.deduped, report.invalids) == tuple(exact)
    assert report.processed == report.written + report.deduped + report.invalids
    assert spark.read.parquet(str(tmp_path / "rejects")).count() == report.invalids
    part = next((tmp_path / "csv").glob("*.csv.gz"))
    text = gzip.decompress(part.read_bytes()).decode()
    assert text.startswith("address_norm\r\n\"") and text.endswith("\"\r\n")
    assert tables.read_csv(spark, str(tmp_path / "csv")).count() == report.written


def test_ready_records_are_checked_too(spark, sf_dir, inputs, tmp_path):
    columns = ", ".join(f"{name} STRING" for name in RECORD_COLUMNS)
    ready = spark.createDataFrame(
        [("US", "10001", "NY", None, "x", None, "y st", "1", None), ("USA",) + (None,) * 8], columns
    )
    report = normalize_job(
        inputs, fixtures.jobs(spark, sf_dir), sink=tables.sink_for(csv_path=str(tmp_path / "a")),
        ready_records=ready, jobs_limit=0,
    )
    assert (report.processed, report.written, report.invalids) == (2, 1, 1)


def test_hot_key_dedupe_and_batches(spark):
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.lit("job")).alias("job_id"),
        F.col("id").alias("line_id"),
        F.when(F.col("id") % 3 == 0, F.lit("same")).otherwise(F.col("id").cast("string")).alias("address_norm"),
    )
    assert dedupe(rows.select("address_norm")).count() == 20_001
    numbered = number_batches(rows, position="line_id", batch_rows=1_000, chunk_rows=700)
    sizes = numbered.groupBy("job_id", "batch_id").count().collect()
    assert numbered.count() == 30_000
    assert {row["count"] for row in sizes} == {1_000}
    # Ten batches of the hot job collapse to one row each.
    named = numbered.select("job_id", "batch_id", "address_norm")
    assert dedupe(named, "batch").count() == 20_010
    # A string in the first batch of two jobs is kept in both.
    both = spark.createDataFrame([("a", 0, "x"), ("b", 0, "x"), ("b", 0, "x")], named.schema)
    assert dedupe(both, "batch").count() == 2
    ranges = numbered.groupBy("job_id", "batch_id").agg(F.min("line_id").alias("a"), F.max("line_id").alias("b")).orderBy("job_id", "batch_id").collect()
    for left, right in zip(ranges, ranges[1:]):
        assert left.job_id != right.job_id or left.b < right.a


def test_lookup_join_beyond_the_broadcast_bound(spark):
    large = spark.range(5_000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    small = spark.createDataFrame([(0, "a"), (1, "b"), (5, "c")], "k BIGINT, name STRING")
    for how, rows in (("inner", 3334), ("left", 5_000), ("left_semi", 3334), ("left_anti", 1666)):
        fast = lookup_join(large, small, ["k"], how=how)
        shuffled = lookup_join(large, small, ["k"], how=how, max_bytes=0)
        assert sorted(map(tuple, fast.collect())) == sorted(map(tuple, shuffled.collect()))
        assert fast.count() == rows
    for how in ("right", "full"):
        with pytest.raises(ValueError):
            lookup_join(large, small, ["k"], how=how)


def test_top_k_beyond_the_rank_limit(spark):
    rows = spark.range(9_000).select((F.col("id") % 2).alias("g"), F.col("id").alias("v"))
    got = top_k(rows, ["g"], [F.col("v").desc()], 1_500).groupBy("g").agg(F.count("*"), F.min("v"))
    assert sorted(map(tuple, got.collect())) == [(0, 1500, 6000), (1, 1500, 6001)]


def test_similarity_match_equals_brute_force(spark):
    words = ["red", "river", "road", "rose", "main", "maine", "street", "straße", "12", "123"]
    texts = [f"{a} {b} {i % 7}" for i, a in enumerate(words) for b in words]
    rows = spark.createDataFrame(list(enumerate(texts)), "id INT, address_norm STRING")
    asked = spark.createDataFrame(list(enumerate(texts[::9])), "query_id INT, query_text STRING")
    for threshold in (0.2, 0.5, 1.0):
        got = search.match_similar(rows, asked, id_column="id", threshold=threshold).collect()
        brute = rows.crossJoin(asked).select(
            "query_id", "id",
            search.trigram_similarity("address_norm", "query_text").alias("similarity"),
        ).where(F.col("similarity") >= threshold).collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, brute))


def test_merge_is_repeatable(spark, tmp_path):
    base, staging = str(tmp_path / "base"), str(tmp_path / "staging")
    rows = spark.createDataFrame([("a",), ("b",), ("a",)], "address_norm STRING")
    for _ in range(3):
        tables.stage(rows, staging)
        tables.merge_absent(spark, staging, base, rows.schema)
    assert sorted(r[0] for r in spark.read.parquet(base).collect()) == ["a", "b"]
    assert tables.read_staging(spark, staging, rows.schema).count() == 0


def test_plans(spark, sf_dir, inputs, tmp_path):
    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    distinct = plan(canonical_rows(checked_records(inputs, fixtures.jobs(spark, sf_dir))))
    assert distinct.count("Exchange hashpartitioning") == 1
    assert "SortMergeJoin" not in distinct and "Python" not in distinct
    rows = tables.address_rows(canonical_rows(checked_records(inputs, fixtures.jobs(spark, sf_dir)), all_columns=True))
    rows.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    assert "EqualTo(postal_code,10003)" in plan(search.by_postal_code(stored, "US", "10003"))
    assert "StringStartsWith(thoroughfare,rue)" in plan(search.by_street_prefix(stored, "rue"))
    tables.write_bucketed(rows, "plan_addresses", str(tmp_path / "b"), buckets=4)
    both = spark.table("plan_addresses").alias("a").join(
        spark.table("plan_addresses").alias("b").hint("merge"), "uuid"
    )
    assert "Exchange hashpartitioning" not in plan(both)


def test_stream_equals_batch(spark, sf_dir, inputs, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    properties = F.struct("number", "street", "unit", "city", "region", "postcode", "country")
    lines = inputs.select(
        "job_id", F.to_json(F.struct(F.lit("Feature").alias("type"), properties.alias("properties")))
    ).collect()
    for job in {row[0] for row in lines}:
        text = "\n".join(row[1] for row in lines if row[0] == job)
        (source / f"{job}.geojson.gz").write_bytes(gzip.compress(text.encode()))
    jobs = fixtures.jobs(spark, sf_dir)
    expected = {r[0] for r in canonical_rows(checked_records(inputs, jobs)).collect()}
    status = StatusLog(seconds=None)
    spark.streams.addListener(status)
    try:
        for writer, name in ((batch_output, "plain"), (merged_output, "merged")):
            checked = checked_stream(spark, str(source), jobs, max_files=4)
            out = str(tmp_path / name)
            start_normalize_stream(checked, writer(out), f"{out}-state").awaitTermination()
            got = [r[0] for r in spark.read.parquet(out).select("address_norm").collect()]
            assert set(got) == expected
            if name == "merged":
                assert len(got) == len(expected)
    finally:
        spark.streams.removeListener(status)


def test_batches_of_long_collections(spark):
    """Lines of many features, some longer than a chunk: numbers follow line and item."""
    rows = spark.range(9_000).select(
        F.lit("job").alias("job_id"), (F.col("id") / 4_000).cast("long").alias("line_id"),
        (F.col("id") % 4_000).cast("int").alias("item"), "id",
    )
    numbered = number_batches(rows, batch_rows=1_000, chunk_rows=1)
    assert {(r.batch_id == r.id // 1_000) for r in numbered.collect()} == {True}


def stream_rows(spark, tmp_path, names):
    schema = "address_norm STRING"
    return spark.createDataFrame([(n,) for n in names], schema)


def test_writers_keep_the_batches_of_other_queries(spark, tmp_path):
    for writer, total in ((batch_output, 5), (merged_output, 4)):
        write = writer(str(tmp_path / writer.__name__))
        write(stream_rows(spark, tmp_path, ["p", "q"]), "first-0")
        write(stream_rows(spark, tmp_path, ["q", "s"]), "second-0")
        write(stream_rows(spark, tmp_path, ["q", "s"]), "second-0")
        write(stream_rows(spark, tmp_path, ["t"]), "second-1")
        got = [r[0] for r in spark.read.parquet(str(tmp_path / writer.__name__)).select("address_norm").collect()]
        assert set(got) == {"p", "q", "s", "t"} and len(got) == total


def test_repeated_queries_lose_no_match(spark):
    texts = [f"{a} {b} river" for a in ("red", "rose", "main", "oak") for b in ("road", "street", "lane", "way")]
    rows = spark.createDataFrame(list(enumerate(texts)), "id INT, address_norm STRING")
    once_asked = [(k, t[: len(t) - 3]) for k, t in enumerate(texts)]
    schema = "query_id INT, query_text STRING"
    got = []
    for asked in (once_asked, once_asked * 3):
        found = search.match_similar(rows, spark.createDataFrame(asked, schema), id_column="id", threshold=0.3)
        got.append(sorted(map(tuple, found.collect())))
    assert got[0] == got[1] and len(got[0]) > 16


def test_loads_do_not_touch_each_other(spark, tmp_path):
    rows = canonical_rows_of(spark, ["a", "b"])
    path = str(tmp_path / "addresses")
    # What a broken load has left in staging is neither replaced nor merged.
    tables.stage(tables.address_rows(rows), f"{path}_staging/run=broken")
    tables.load_addresses(rows, path)
    tables.load_addresses(canonical_rows_of(spark, ["b", "c"]), path)
    stored = spark.read.parquet(path)
    assert "batch_id" not in stored.columns and "run" not in stored.columns
    assert sorted(r.address_norm for r in stored.collect()) == ["a", "b", "c"]
    with pytest.raises(ValueError):
        tables.align_by_name(spark.createDataFrame([(1, 2)], "a INT, b INT").toDF("a", "A"), stored.schema)


def canonical_rows_of(spark, names):
    return spark.createDataFrame([(n,) for n in names], "address_norm STRING")


def test_no_shared_folder_is_an_error():
    from types import SimpleNamespace

    from addrloom import session

    def bare(master):
        named = {}
        conf = SimpleNamespace(get=named.get, set=named.__setitem__)
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))

    cluster, local = bare("spark://host:7077"), bare("local[4]")
    for spark in (cluster, local):
        with pytest.raises(ValueError):
            session.shared_root(spark)
    for master in ("spark://host:7077", "local-cluster[3,2,1000]", "yarn"):
        with pytest.raises(ValueError):
            session.name_local_shared(bare(master), "/shared")
    session.name_local_shared(local, "/own/")
    assert session.shared_root(local) == "/own"
