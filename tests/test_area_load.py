from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from addrloom.operators import tables


def addresses(spark, names):
    return spark.createDataFrame([(n,) for n in names], "address_norm STRING")


def names(area, numbers):
    return [f"{k} main st, town, {area}{k % 10:02d}, us" for k in numbers]


def stored(spark, path):
    return sorted(r[0] for r in tables.read_addresses(spark, path).select("address_norm").collect())


def parts_in(df):
    return {part for f in df.inputFiles() for part in f.split("/") if part.startswith("part=")}


def test_part_follows_the_area(spark):
    rows = addresses(spark, [*names("941", range(50)), *names("100", range(50)), "x", "", "a, b", "st, 941, us"])
    found = rows.select("address_norm", tables.area_part().alias("p")).collect()
    areas = {a: {r.p for r in found if f", {a}" in r.address_norm} for a in ("941", "100")}
    assert all(len(p) == 1 for p in areas.values()) and areas["941"] != areas["100"]
    assert all(0 <= r.p < tables.AREA_PARTS for r in found)


def test_a_load_reads_only_its_parts(spark, tmp_path):
    path = str(tmp_path / "t")
    west, east = names("941", range(40)), names("100", range(40))
    tables.load_addresses_by_area(addresses(spark, west), path)
    tables.load_addresses_by_area(addresses(spark, east), path)
    assert len(parts_in(tables.read_or_empty(spark, path, tables.read_addresses(spark, path).schema))) == 2
    more = tables.address_rows(addresses(spark, names("941", range(30, 60)))).withColumn(
        "part", tables.area_part()
    )
    base = tables.read_parts(spark, path, more, more.schema)
    plan = base._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [part" in plan or "PartitionFilters: [isnotnull(part" in plan
    assert base.count() == 40 and base.select(F.input_file_name().alias("f")).distinct().where(
        ~F.col("f").contains(f"part={more.first()['part']}/")
    ).isEmpty()
    tables.load_addresses_by_area(addresses(spark, names("941", range(30, 60))), path)
    assert stored(spark, path) == sorted({*west, *east, *names("941", range(60))})


def test_repeated_empty_and_concurrent_loads(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.load_addresses_by_area(addresses(spark, []), path)
    for _ in range(2):
        tables.load_addresses_by_area(addresses(spark, names("941", range(20)) * 2), path)
    with ThreadPoolExecutor(3) as pool:
        list(
            pool.map(
                lambda a: tables.load_addresses_by_area(addresses(spark, names(a, range(20))), path),
                ["100", "200", "300"],
            )
        )
    wanted = [n for a in ("941", "100", "200", "300") for n in names(a, range(20))]
    assert stored(spark, path) == sorted(wanted)
    tables.load_addresses_by_area(addresses(spark, names("941", range(3))), path, key=None)
    assert len(stored(spark, path)) == len(wanted) + 3
