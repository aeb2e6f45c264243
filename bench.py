"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from addrloom.functions.text import ascii_fold
from addrloom.functions.tokens import tokens
from addrloom.operators import search
from addrloom.plans.normalize import canonical_rows, checked_records
from addrloom.session import name_local_shared, shared_path, tune
from addrloom.streaming.normalize import batch_output
from checks import fixtures, queries
from checks.fixtures import table

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count()))


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", CPUS)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    tune(spark)
    name_local_shared(spark, os.path.join(tempfile.gettempdir(), "addrloom-bench"))
    lines = fixtures.line_features(spark, SF_DIR)
    jobs = fixtures.jobs(spark, SF_DIR)
    documents = table(spark, SF_DIR, "documents")
    checked = checked_records(lines, jobs)
    # Stored once, outside the measured time, for the searches.
    stored = shared_path(spark, "bench")
    rows = canonical_rows(checked, all_columns=True)
    rows.repartition(int(CPUS), "address_norm").write.parquet(stored)
    addresses = spark.read.parquet(stored)
    # Whole addresses with their end cut off, as someone types them.
    asked = addresses.orderBy(F.xxhash64("address_norm")).limit(100).select(
        F.xxhash64("address_norm").alias("query_id"),
        F.expr("substring(address_norm, 1, length(address_norm) - 8)").alias("query_text"),
    )

    # The same street in every query, as when all of a street is looked up.
    shared_street = asked.select(
        "query_id",
        F.concat(F.lit("rue de la liberte "), (F.col("query_id") % 97).cast("string")).alias("query_text"),
    )

    def match(queries_: DataFrame, threshold: float):
        return lambda: drain(
            search.match_similar(
                addresses, queries_, id_column="address_norm", threshold=threshold, k=10
            )
        )

    def stream() -> None:
        queries.run_stream(
            queries.job_from_folder(spark, SF_DIR), batch_output(shared_path(spark, "out"))
        )

    runs = {
        "normalise_checked": lambda: drain(checked),
        "normalise_distinct": lambda: drain(canonical_rows(checked)),
        "normalise_all_columns": lambda: drain(canonical_rows(checked, all_columns=True)),
        "geojson_job": lambda: drain(queries.QUERIES["geojson_job"](spark, SF_DIR)),
        "stream_job": stream,
        "ascii_fold": lambda: drain(documents.select(ascii_fold("text").alias("t"))),
        "token_vectors": lambda: drain(documents.select(tokens("text").alias("t"))),
        "token_search": lambda: drain(search.by_tokens(documents, "de la", column="text")),
        "trigram_topk": lambda: drain(
            search.by_similarity(addresses, "12 rue de la liberte 4321", k=10)
        ),
        "trigram_match_100": match(asked, 0.7),
        "trigram_match_100_at_03": match(asked, 0.3),
        "trigram_match_100_street": match(shared_street, 0.5),
        "street_prefix": lambda: drain(search.by_street_prefix(addresses, "rue de la liberté 12")),
    }
    seconds = {}
    chosen = os.environ.get("BENCH_ONLY", "").split(",")
    for name, run in runs.items():
        if chosen != [""] and name not in chosen:
            continue
        best = None
        for _ in range(1 if name.startswith("trigram_match_100") else 2):
            started = time.perf_counter()
            run()
            took = time.perf_counter() - started
            best = took if best is None else min(best, took)
        seconds[name] = round(best, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
