"""One Spark callable per operator, over whole tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from addrloom.functions.components import COMPONENTS, LABELS, component_columns, tag_arrays
from addrloom.functions.regions import normalize_region
from addrloom.functions.text import ascii_fold, clean_ws, title_case
from addrloom.functions.tokens import tokens, trigram_similarity, trigrams
from addrloom.functions.validate import postal_shape_ok, rejection_reason
from addrloom.operators import search, tables
from addrloom.operators.batches import unique_batches as batches_of_unique_rows
from addrloom.operators.compose import input_addresses, join_jobs, required_fields
from addrloom.operators.counters import (
    bytes_per_job,
    features_per_job,
    run_counters,
    with_rates,
)
from addrloom.operators.dedupe import dedupe, number_batches
from addrloom.operators.joins import lookup_join
from addrloom.operators.lookup import county_lookup, county_rows
from addrloom.operators.quality import (
    COUNTY_KEYS,
    Key,
    column_violations,
    key_violations,
    table_statistics,
)
from addrloom.operators.records import (
    RECORD_COLUMNS,
    normalise,
    plausible,
    with_canonical,
    with_reason,
)
from addrloom.operators.tagging import with_custom_tags, with_free_text_tags, with_structured_tags
from addrloom.plans.boundaries import load_counties, load_states, post_load_maintenance, save
from addrloom.plans.normalize import canonical_rows, checked_records, normalize_job
from addrloom.session import name_local_shared, shared_path, tune
from addrloom.sources import datasource, geojson
from addrloom.sources.boundaries import COUNTY_MEMBER, boundaries
from addrloom.sources.landing import list_files, log_entries, new_files, record_ingested
from addrloom.sources.manifest import (
    city_from_job,
    count_jobs,
    limit_jobs,
    read_manifest,
    rejected_jobs,
    split_source_name,
)
from addrloom.streaming.normalize import (
    batch_output,
    csv_output,
    merged_output,
    start_normalize_stream,
    start_unique_stream,
)
from checks import fixtures
from checks.archives import customer_archives, nation_archives, write_archives
from checks.fixtures import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        # Only a local session that names no shared folder gets one here.
        name_local_shared(spark, os.path.join(tempfile.gettempdir(), "addrloom-checks"))
        return build(tune(spark), sf_dir)

    QUERIES[build.__name__] = run
    return run


def checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checked_records(fixtures.features(spark, sf_dir), fixtures.jobs(spark, sf_dir))


def address_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Address rows of the customer features, one per canonical string."""
    return canonical_rows(checked(spark, sf_dir), all_columns=True)


def inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = required_fields(fixtures.features(spark, sf_dir))
    return input_addresses(join_jobs(wanted, fixtures.jobs(spark, sf_dir)))


def feature_files(spark: SparkSession, sf_dir: str, *, files: int = 4) -> str:
    """Write the customer features as gzipped GeoJSON lines, one folder per job id."""
    properties = F.struct("number", "street", "unit", "city", "region", "postcode", "country")
    lines = fixtures.features(spark, sf_dir).select(
        "job_id",
        F.to_json(
            F.struct(
                F.lit("Feature").alias("type"),
                properties.alias("properties"),
                F.lit(None).cast("string").alias("geometry"),
            )
        ).alias("value"),
    )
    path = shared_path(spark, "features")
    for_files = lines.repartition(files, "job_id")
    for_files.write.partitionBy("job_id").option("compression", "gzip").text(path)
    return path


def read_feature_files(spark: SparkSession, path: str) -> DataFrame:
    """Features of ``feature_files``: the job id is the name of the folder."""
    lines = geojson.read_lines(spark, path).withColumn(
        "job_id", F.regexp_extract("file_path", r"job_id=([^/]+)/", 1)
    )
    return geojson.features(geojson.parse(geojson.spread(lines)))


# --- scalar functions -------------------------------------------------------------------------


@query
def ascii_fold_documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", ascii_fold("text").alias("folded"))


@query
def ascii_fold_turns(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", ascii_fold("text").alias("folded")
    )


@query
def clean_ws_documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", clean_ws("text").alias("cleaned"))


@query
def title_documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", title_case("text").alias("titled"))


@query
def region_codes(spark, sf_dir):
    return fixtures.features(spark, sf_dir).select(
        "feature_id", normalize_region("region", "country").alias("region_code")
    )


@query
def token_vectors(spark, sf_dir):
    words = tokens("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.array_join(words, "|").alias("words"), F.size(words).cast("bigint").alias("n")
    )


@query
def trigram_sets(spark, sf_dir):
    grams = F.array_sort(trigrams("p_name"))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(grams, "|").alias("grams"))


# --- features to input records ----------------------------------------------------------------


@query
def required_fields_filter(spark, sf_dir):
    return required_fields(fixtures.features(spark, sf_dir)).select(
        "feature_id", "number", "street"
    )


@query
def compose_raw(spark, sf_dir):
    return inputs(spark, sf_dir).select("feature_id", "address_raw", "language_code")


@query
def country_code(spark, sf_dir):
    return inputs(spark, sf_dir).select("feature_id", "country_code")


@query
def job_name_parts(spark, sf_dir):
    return split_source_name(fixtures.jobs(spark, sf_dir)).select(
        "job_id", "job_country", "job_region", "job_city", city_from_job().alias("city")
    )


@query
def job_name_rejects(spark, sf_dir):
    return rejected_jobs(fixtures.jobs(spark, sf_dir)).select("job_id", "source_name")


@query
def jobs_limit(spark, sf_dir):
    chosen = limit_jobs(fixtures.jobs(spark, sf_dir), 5)
    joined = join_jobs(required_fields(fixtures.features(spark, sf_dir)), chosen)
    return features_per_job(joined)


# --- tags to records --------------------------------------------------------------------------


def tag_rows(tagged: DataFrame) -> DataFrame:
    return tagged.select("feature_id", F.inline("tags")).select("feature_id", "label", "value")


@query
def structured_tags(spark, sf_dir):
    return tag_rows(with_structured_tags(inputs(spark, sf_dir)))


@query
def free_text_tags(spark, sf_dir):
    tagged = with_free_text_tags(inputs(spark, sf_dir))
    return tag_rows(tagged.withColumn("tags", F.transform("tags", lambda t: F.struct(
        F.upper(t.getField("value")).alias("value"), t.getField("label").alias("label")))))


@query
def custom_tags(spark, sf_dir):
    def first_word(text, language, country):
        return [(text.split(" ")[0], "house_number"), (country or "", "country")]

    return tag_rows(with_custom_tags(inputs(spark, sf_dir), first_word))


@query
def components(spark, sf_dir):
    tagged = (
        fixtures.pairs(spark, sf_dir)
        .groupBy("feature_id")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "value", "label"))).alias("tags"))
        .select("feature_id", *tag_arrays())
    )
    mapped = component_columns()
    return tagged.select("feature_id", *[mapped[name].alias(name) for name in COMPONENTS])


def every_label() -> list[str]:
    singles = ["house_number", "level", "unit", "postcode", "country"]
    return [label for labels in LABELS.values() for label in labels] + singles


@query
def label_priority(spark, sf_dir):
    key = F.col("c_custkey")
    pairs = [
        F.when(
            (key * (i + 3) + i) % 5 < 2,
            F.struct(
                F.concat(F.lit(f"{label} "), key.cast("string")).alias("value"),
                F.lit(label).alias("label"),
            ),
        )
        for i, label in enumerate(every_label())
    ]
    tagged = table(spark, sf_dir, "customer").select(
        key.alias("feature_id"), *tag_arrays(F.array_compact(F.array(*pairs)))
    )
    mapped = component_columns()
    return tagged.select(
        "feature_id", *[mapped[name].alias(name) for name in (*COMPONENTS, "country")]
    )


def untagged_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inputs whose tags hold number and street only, so the places must be filled in."""
    kept = F.filter("tags", lambda t: t.getField("label").isin("house_number", "road"))
    return with_structured_tags(inputs(spark, sf_dir)).withColumn("tags", kept)


@query
def backfill(spark, sf_dir):
    return normalise(untagged_places(spark, sf_dir)).select(
        "feature_id", "country_code", "admin_area_1", "locality"
    )


@query
def backfill_none_text(spark, sf_dir):
    filled = normalise(untagged_places(spark, sf_dir), missing_region="none_text")
    return filled.select("feature_id", "admin_area_1")


@query
def normalised_records(spark, sf_dir):
    return checked(spark, sf_dir).select("feature_id", *RECORD_COLUMNS)


# --- plausibility -----------------------------------------------------------------------------


@query
def validation_reasons(spark, sf_dir):
    return checked(spark, sf_dir).groupBy("reason").agg(F.count("*").alias("rows"))


@query
def valid_rows(spark, sf_dir):
    return plausible(checked(spark, sf_dir)).select("feature_id", *RECORD_COLUMNS)


@query
def validation_cases(spark, sf_dir):
    records = fixtures.run_sql(spark, sf_dir, fixtures.RECORD_CASES, "customer")
    return records.select("case_id", rejection_reason().alias("reason"))


@query
def postal_shapes(spark, sf_dir):
    rows = fixtures.run_sql(spark, sf_dir, fixtures.POSTAL_CASES, "customer")
    return rows.select(
        "case_id", postal_shape_ok("country_code", "postal_code").alias("shape_ok")
    )


# --- canonical strings and duplicates ---------------------------------------------------------


@query
def canonical(spark, sf_dir):
    return with_canonical(plausible(checked(spark, sf_dir))).select("feature_id", "address_norm")


@query
def dedupe_global(spark, sf_dir):
    return canonical_rows(checked(spark, sf_dir))


@query
def dedupe_all_columns(spark, sf_dir):
    return address_table(spark, sf_dir)


@query
def no_dedupe(spark, sf_dir):
    return canonical_rows(checked(spark, sf_dir), scope=None)


def order_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = checked_records(fixtures.order_features(spark, sf_dir), fixtures.jobs(spark, sf_dir))
    return number_batches(rows, position="feature_id", batch_rows=1_000)


@query
def batch_numbers(spark, sf_dir):
    return order_batches(spark, sf_dir).select("feature_id", "job_id", "batch_id")


@query
def dedupe_batch(spark, sf_dir):
    valid = with_canonical(plausible(order_batches(spark, sf_dir)))
    return dedupe(valid.select("job_id", "batch_id", "address_norm"), "batch").groupBy(
        "address_norm"
    ).agg(F.count("*").alias("batches"))


def valid_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Position, job and canonical string of the plausible orders; customers recur as addresses."""
    rows = checked_records(fixtures.order_features(spark, sf_dir), fixtures.jobs(spark, sf_dir))
    return with_canonical(plausible(rows)).select("feature_id", "job_id", "address_norm")


@query
def unique_batches(spark, sf_dir):
    """Batches over all jobs that close at their 200th unique row."""
    found = batches_of_unique_rows(
        valid_orders(spark, sf_dir), job=None, position="feature_id", batch_rows=200, least_rows=200
    )
    return found.select("feature_id", "batch_id", "kept")


@query
def unique_batches_per_job(spark, sf_dir):
    """Rows seen and kept of every batch of every job, cut into chunks of fewer rows than a batch."""
    found = batches_of_unique_rows(
        valid_orders(spark, sf_dir),
        position="feature_id",
        batch_rows=200,
        least_rows=200,
        chunk_rows=128,
    )
    return found.groupBy("job_id", "batch_id").agg(
        F.count("*").alias("rows"), F.count_if("kept").alias("kept_rows")
    )


@query
def batch_job(spark, sf_dir):
    """The whole job with duplicates removed per batch: how often each string is written."""
    features = (
        fixtures.order_features(spark, sf_dir)
        .withColumn("line_id", F.col("feature_id"))
        .withColumn("item", F.lit(0))
    )
    path = shared_path(spark, "batch-job")
    normalize_job(
        features,
        fixtures.jobs(spark, sf_dir),
        sink=tables.sink_for(csv_path=path),
        scope="batch",
        batch_rows=1_000,
    )
    return tables.read_csv(spark, path).groupBy("address_norm").agg(F.count("*").alias("batches"))


@query
def dedupe_lines(spark, sf_dir):
    rows = checked_records(fixtures.line_features(spark, sf_dir), fixtures.jobs(spark, sf_dir))
    return canonical_rows(rows)


# --- counters and quality ---------------------------------------------------------------------


@query
def counters(spark, sf_dir):
    return run_counters(with_canonical(checked(spark, sf_dir)))


@query
def counters_per_job(spark, sf_dir):
    return features_per_job(fixtures.features(spark, sf_dir))


@query
def file_bytes_per_job(spark, sf_dir):
    lines = geojson.read_lines(spark, feature_files(spark, sf_dir)).withColumn(
        "job_id", F.regexp_extract("file_path", r"job_id=([^/]+)/", 1)
    )
    return bytes_per_job(lines)


@query
def column_rule_violations(spark, sf_dir):
    return column_violations(address_table(spark, sf_dir))


@query
def column_rule_cases(spark, sf_dir):
    rows = fixtures.run_sql(spark, sf_dir, fixtures.RECORD_CASES, "customer")
    return column_violations(
        rows.withColumn("address_norm", F.when(F.col("thoroughfare") != "", F.col("thoroughfare")))
    )


@query
def key_rule_violations(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn(
        "part_key", F.when(F.col("o_orderkey") % 7 > 0, F.col("o_orderkey") % 1000)
    )
    return key_violations(
        orders,
        Key("pk_orders", ("o_orderkey",), primary=True),
        Key("pk_part", ("part_key",), primary=True),
        Key("uidx_part", ("part_key", "o_orderstatus")),
    )


@query
def county_key_violations(spark, sf_dir):
    rows = county_rows(fixtures.counties(spark, sf_dir))
    doubled = rows.unionAll(rows.where("statefp = '01'"))
    return key_violations(doubled, *[key for key in COUNTY_KEYS if "gid" not in key.columns])


@query
def table_stats(spark, sf_dir):
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]
    return table_statistics(table(spark, sf_dir, "orders"), columns).drop("distinct_estimate")


# --- boundaries -------------------------------------------------------------------------------


@query
def county_look_up(spark, sf_dir):
    return county_lookup(
        county_rows(fixtures.counties(spark, sf_dir)), fixtures.states(spark, sf_dir)
    )


@query
def customer_county_look_up(spark, sf_dir):
    counties = boundaries(customer_archives(table(spark, sf_dir, "customer")), COUNTY_MEMBER)
    states = table(spark, sf_dir, "nation").select(
        F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("statefp"),
        F.col("n_name").alias("abbrev"),
    )
    return county_lookup(counties, states)


@query
def shapefile_scan(spark, sf_dir):
    rows = boundaries(customer_archives(table(spark, sf_dir, "customer")), COUNTY_MEMBER)
    return rows.select(
        "statefp", "countyfp", "geoid", "name", "aland", "srid",
        F.lower(F.hex("the_geom")).alias("wkb"),
    )


@query
def parent_child_view(spark, sf_dir):
    parent = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nation"),
    )
    child = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), "c_acctbal"
    )
    return tables.parent_view(parent, child)


@query
def load_by_name(spark, sf_dir):
    staged = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("ID"), F.col("c_name").alias("Name"), "c_acctbal"
    )
    target = spark.createDataFrame([], "id BIGINT, name STRING, note STRING").schema
    return tables.align_by_name(staged, target)


@query
def stored_table(spark, sf_dir):
    rows = fixtures.order_features(spark, sf_dir).select("feature_id", "street", "postcode")
    return save(spark, rows, None, shared_path(spark, "stored"))


# --- search -----------------------------------------------------------------------------------


@query
def postal_filter(spark, sf_dir):
    return search.by_postal_code(address_table(spark, sf_dir), "US", "10003").select(
        "address_norm", "country_code", "postal_code"
    )


@query
def street_prefix(spark, sf_dir):
    found = search.by_street_prefix(address_table(spark, sf_dir), "rue de la liberté 1")
    return found.select("thoroughfare", "address_norm")


@query
def substring_search(spark, sf_dir):
    return search.by_substring(address_table(spark, sf_dir), "liberte 1").select("address_norm")


@query
def trigram_scores(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey", trigram_similarity("p_name", F.lit("small red widget")).alias("similarity")
    )


@query
def trigram_topk(spark, sf_dir):
    names = table(spark, sf_dir, "part").select(
        "p_partkey", F.concat_ws(" ", "p_name", "p_brand", "p_type").alias("full_name")
    )
    named = names.withColumn(
        "full_name", F.concat_ws(" ", "full_name", F.col("p_partkey").cast("string"))
    )
    return search.by_similarity(
        named, "red widget brand 17 economy 12", k=20, column="full_name"
    ).select("p_partkey", "full_name", "similarity")


@query
def trigram_match(spark, sf_dir):
    asked = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("query_id"),
        F.concat(
            F.lit("rue de la libert "), (F.col("s_suppkey") % 97).cast("string")
        ).alias("query_text"),
    )
    return search.match_similar(
        address_table(spark, sf_dir), asked, id_column="address_norm", threshold=0.45
    )


@query
def trigram_match_topk(spark, sf_dir):
    asked = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("query_id"), F.col("s_name").alias("query_text")
    )
    return search.match_similar(
        table(spark, sf_dir, "customer"), asked, id_column="c_custkey", column="c_name",
        threshold=0.3, k=3,
    )


@query
def token_search(spark, sf_dir):
    return search.by_tokens(table(spark, sf_dir, "documents"), "de la", column="text").select(
        "doc_id"
    )


@query
def token_index_search(spark, sf_dir):
    path = shared_path(spark, "postings")
    documents = table(spark, sf_dir, "documents")
    search.write_postings(search.postings(documents, "doc_id", tokens("text")), path)
    stored = spark.read.schema("term STRING, id BIGINT").parquet(path)
    return search.ids_with_all_terms(stored, ["the", "of"])


# --- sinks and sources ------------------------------------------------------------------------


@query
def csv_round_trip(spark, sf_dir):
    path = shared_path(spark, "csv")
    normalize_job(
        fixtures.features(spark, sf_dir), fixtures.jobs(spark, sf_dir),
        sink=tables.sink_for(csv_path=path),
    )
    return tables.read_csv(spark, path)


@query
def csv_quoting(spark, sf_dir):
    path = shared_path(spark, "csv")
    rows = table(spark, sf_dir, "events").select(
        F.concat_ws(", ", "props", F.concat(F.lit('"'), "event_type", F.lit(' "'))).alias(
            "address_norm"
        )
    )
    tables.write_csv(rows, path)
    return tables.read_csv(spark, path)


@query
def insert_if_absent(spark, sf_dir):
    path = shared_path(spark, "addresses")
    job_features = fixtures.features(spark, sf_dir)
    first = job_features.where("job_id < '5'")
    for batch in (first, job_features, job_features):
        rows = canonical_rows(checked_records(batch, fixtures.jobs(spark, sf_dir)), all_columns=True)
        tables.load_addresses(rows, path)
    stored = spark.read.schema(tables.ADDRESS_SCHEMA).parquet(path)
    return stored.groupBy("address_norm", "uuid").agg(F.count("*").alias("copies"))


@query
def area_load(spark, sf_dir):
    """The same loads into a table in parts by area."""
    path = shared_path(spark, "addresses")
    job_features = fixtures.features(spark, sf_dir)
    first = job_features.where("job_id < '5'")
    for batch in (first, job_features, job_features):
        rows = canonical_rows(checked_records(batch, fixtures.jobs(spark, sf_dir)), all_columns=True)
        tables.load_addresses_by_area(rows, path, parts=64)
    stored = tables.read_addresses(spark, path)
    return stored.groupBy("address_norm", "uuid").agg(F.count("*").alias("copies"))


@query
def append_without_key(spark, sf_dir):
    path = shared_path(spark, "addresses")
    rows = canonical_rows(checked(spark, sf_dir), all_columns=True)
    for _ in range(2):
        tables.load_addresses(rows, path, key=None)
    stored = spark.read.schema(tables.ADDRESS_SCHEMA).parquet(path)
    return stored.groupBy("address_norm").agg(F.count("*").alias("copies"))


@query
def bucketed_round_trip(spark, sf_dir):
    name = shared_path(spark, "t").rsplit("-", 1)[1]
    target = f"addresses_{name}"
    path = shared_path(spark, "bucketed")
    rows = tables.address_rows(address_table(spark, sf_dir))
    tables.write_bucketed(rows.where("postal_code IS NULL"), target, path, buckets=8)
    tables.insert_absent(rows, target, path, buckets=8)
    return spark.table(target).select("uuid", "address_norm")


@query
def search_layout_round_trip(spark, sf_dir):
    path = shared_path(spark, "layout")
    rows = address_table(spark, sf_dir)
    tables.write_search_layout(rows, path)
    stored = spark.read.schema(rows.schema).parquet(path)
    return search.by_street_prefix(stored, "rue de la liberté 2").select("address_norm")


@query
def geojson_scan(spark, sf_dir):
    found = read_feature_files(spark, feature_files(spark, sf_dir))
    return found.select(
        "job_id", "number", "street", "unit", "city", "region", "postcode", "country"
    )


def feature_source(spark: SparkSession, reader, path: str) -> DataFrame:
    """The registered source over ``feature_files``, for batch and stream readers."""
    named = reader.format(datasource.FORMAT).option("job_pattern", JOB_FOLDER)
    return named.option("whole_files", "true").load(path).select(
        "job_id", "number", "street", "unit", "city", "region", "postcode", "country"
    )


@query
def source_scan(spark, sf_dir):
    datasource.register(spark)
    return feature_source(spark, spark.read, feature_files(spark, sf_dir))


@query
def source_scan_jobs(spark, sf_dir):
    """Only the files of these jobs are opened."""
    datasource.register(spark)
    rows = feature_source(spark, spark.read, feature_files(spark, sf_dir))
    return rows.where(F.col("job_id").isin("3", "14", "24") & F.col("street").isNotNull())


@query
def source_stream(spark, sf_dir):
    """The same source as a stream into Parquet files."""
    datasource.register(spark)
    rows = feature_source(spark, spark.readStream, feature_files(spark, sf_dir))
    out, state = (shared_path(spark, n) for n in ("source-out", "source-state"))
    writer = rows.writeStream.format("parquet").option("checkpointLocation", state)
    writer.trigger(availableNow=True).start(out).awaitTermination()
    return spark.read.parquet(out)


@query
def geojson_job(spark, sf_dir):
    found = read_feature_files(spark, feature_files(spark, sf_dir))
    return canonical_rows(checked_records(found, fixtures.jobs(spark, sf_dir)))


@query
def json_truthiness(spark, sf_dir):
    lines = table(spark, sf_dir, "events").select(
        "event_id",
        F.format_string(
            '{"type":"Feature","properties":%s}', F.regexp_replace("props", '"k"', '"number"')
        ).alias("value"),
    )
    return geojson.features(geojson.parse(lines)).select("event_id", "number")


@query
def feature_collections(spark, sf_dir):
    lines = fixtures.run_sql(spark, sf_dir, fixtures.LINE_CASES, "events")
    return geojson.features(geojson.parse(lines)).select(
        "event_id", F.col("item").cast("bigint").alias("item"), "number", "street"
    )


@query
def malformed_lines(spark, sf_dir):
    lines = fixtures.run_sql(spark, sf_dir, fixtures.LINE_CASES, "events")
    return geojson.malformed(geojson.parse(lines)).select("event_id")


@query
def manifest_scan(spark, sf_dir):
    path = shared_path(spark, "manifest")
    fixtures.run_sql(spark, sf_dir, fixtures.MANIFEST, "customer").write.text(path)
    return read_manifest(spark, path, source="us/ca").select("job_id", "source_name")


@query
def incremental_landing(spark, sf_dir):
    path, log_path = feature_files(spark, sf_dir), shared_path(spark, "ingest-log")
    found = list_files(spark, path, "*.gz")
    record_ingested(found.where(F.col("path").contains("job_id=1")), log_path)
    ingested = spark.read.schema("path STRING, length BIGINT, modificationTime TIMESTAMP").parquet(
        log_path
    )
    left = new_files(found, ingested).select("path", F.lit("new").alias("state"))
    skipped = log_entries(found, ingested).where("skipped").select(
        "path", F.lit("skipped").alias("state")
    )
    job_id = F.regexp_extract("path", r"job_id=([^/]+)/", 1)
    return left.unionAll(skipped).select(job_id.alias("job_id"), "state").distinct()


# --- streaming --------------------------------------------------------------------------------


def stream_files(spark: SparkSession, sf_dir: str) -> str:
    """The customer features as one file per job, named after the job."""
    path = feature_files(spark, sf_dir)
    return f"{path}/*"


def job_from_folder(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    path = path or stream_files(spark, sf_dir)
    lines = geojson.stream_lines(spark, path, max_files=3).withColumn(
        "job_id", F.regexp_extract("file_path", r"job_id=([^/]+)/", 1)
    )
    return checked_records(
        geojson.features(geojson.parse(lines)), fixtures.jobs(spark, sf_dir)
    )


def run_stream(checked_rows: DataFrame, write, checkpoint: str | None = None) -> None:
    checkpoint = checkpoint or shared_path(checked_rows.sparkSession, "stream-state")
    start_normalize_stream(checked_rows, write, checkpoint).awaitTermination()


@query
def stream_normalize(spark, sf_dir):
    out = shared_path(spark, "stream-out")
    run_stream(job_from_folder(spark, sf_dir), batch_output(out))
    return spark.read.parquet(out).select("address_norm").distinct()


@query
def stream_dedupe(spark, sf_dir):
    out = shared_path(spark, "stream-out")
    run_stream(job_from_folder(spark, sf_dir), merged_output(out))
    return spark.read.parquet(out).select("address_norm")


@query
def stream_restart(spark, sf_dir):
    """Two starts on one checkpoint; between them the files of the other jobs arrive."""
    out, state, landing = (shared_path(spark, n) for n in ("stream-out", "state", "landing"))
    for odd in (0, 1):
        feature_part(spark, sf_dir, odd).write.mode("append").partitionBy("job_id").text(landing)
        run_stream(job_from_folder(spark, sf_dir, f"{landing}/*"), batch_output(out), state)
    return spark.read.parquet(out).groupBy("address_norm").agg(
        F.count_distinct("batch_id").alias("batches")
    ).select("address_norm", (F.col("batches") > 0).alias("found"))


@query
def stream_second_run(spark, sf_dir):
    """Another query, with a new checkpoint, into the same folder: both outputs stay whole."""
    out = shared_path(spark, "stream-out")
    for odd in (0, 1):
        landing = shared_path(spark, "landing")
        feature_part(spark, sf_dir, odd).write.partitionBy("job_id").text(landing)
        run_stream(job_from_folder(spark, sf_dir, f"{landing}/*"), merged_output(out))
    return spark.read.parquet(out).select("address_norm")


@query
def stream_unique(spark, sf_dir):
    """Repeats dropped across micro-batches and a restart: the first files come once more with the others."""
    out, state, landing = (shared_path(spark, n) for n in ("stream-out", "state", "landing"))
    for odd in (0, 1):
        for part in range(odd + 1):
            feature_part(spark, sf_dir, part).write.mode("append").partitionBy("job_id").text(landing)
        rows = job_from_folder(spark, sf_dir, f"{landing}/*")
        start_unique_stream(rows, batch_output(out), state).awaitTermination()
    return spark.read.parquet(out).select("address_norm")


@query
def stream_csv(spark, sf_dir):
    out = shared_path(spark, "stream-out")
    run_stream(job_from_folder(spark, sf_dir), csv_output(out))
    return spark.read.option("header", True).option("escape", '"').csv(out).select(
        "address_norm"
    ).distinct()


def feature_part(spark: SparkSession, sf_dir: str, odd: int) -> DataFrame:
    """GeoJSON lines of the jobs with even or odd numbers."""
    properties = F.struct("number", "street", "unit", "city", "region", "postcode", "country")
    wanted = fixtures.features(spark, sf_dir).where(F.col("job_id").cast("int") % 2 == odd)
    return wanted.select(
        "job_id",
        F.to_json(F.struct(F.lit("Feature").alias("type"), properties.alias("properties"))).alias(
            "value"
        ),
    )


JOB_FOLDER = r"job_id=([^/]+)/"


@query
def jobs_limit_files(spark, sf_dir):
    """Only the files of the first five jobs of the manifest are opened."""
    chosen = limit_jobs(fixtures.jobs(spark, sf_dir), 5)
    rows = geojson.read_features(
        spark, f"{feature_files(spark, sf_dir)}/*", jobs=chosen, job_pattern=JOB_FOLDER
    )
    return rows.groupBy("job_id").agg(F.count("*").alias("features"))


@query
def manifest_indented(spark, sf_dir):
    """The manifest as one indented JSON array."""
    path = shared_path(spark, "manifest")
    entries = fixtures.run_sql(spark, sf_dir, fixtures.MANIFEST, "customer")
    whole = entries.agg(
        F.concat(
            F.lit("[\n  "),
            F.concat_ws(",\n  ", F.transform(
                F.sort_array(F.collect_list("value")),
                lambda v: F.replace(v, F.lit(","), F.lit(",\n    ")),
            )),
            F.lit("\n]\n"),
        ).alias("value")
    )
    whole.write.text(path)
    return read_manifest(spark, path, source="us/ca").select("job_id", "source_name")


@query
def cut_files(spark, sf_dir):
    """Gzip files with the last bytes missing for odd jobs."""
    files = spark.read.format("binaryFile").load(f"{feature_files(spark, sf_dir)}/*").where(
        F.col("path").endswith(".gz")
    )
    job = F.regexp_extract("path", JOB_FOLDER, 1)
    problem = F.pandas_udf(
        lambda contents: contents.map(geojson.gzip_problem), "string"
    )
    size = F.length("content") - F.when(job.cast("int") % 2 == 1, 12).otherwise(0)
    cut = F.expr("substring(content, 1, size)")
    return (
        files.withColumn("size", size)
        .select(job.alias("job_id"), problem(cut).alias("problem"))
        .groupBy("job_id")
        .agg(F.max(F.col("problem").isNotNull()).alias("is_cut"))
    )


@query
def trigram_match_repeated(spark, sf_dir):
    """Every query twice, once more under another id: the same matches as once."""
    asked = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("query_id"), F.col("s_name").alias("query_text")
    )
    other = asked.withColumn("query_id", -F.col("query_id"))
    return search.match_similar(
        table(spark, sf_dir, "customer"), asked.unionAll(asked).unionAll(other),
        id_column="c_custkey", column="c_name", threshold=0.3,
    )


@query
def lookup_join_large(spark, sf_dir):
    """Beyond the broadcast bound, with a third of the rows on one key and exact copies."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_linenumber") % 3 == 0, F.lit(1)).otherwise(F.col("l_suppkey")).alias(
            "s_suppkey"
        )
    )
    names = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    joined = lookup_join(lines, names, ["s_suppkey"], max_bytes=0)
    return joined.groupBy("s_name").agg(F.count("*").alias("rows"))


@query
def run_rates(spark, sf_dir):
    counted = run_counters(with_canonical(checked(spark, sf_dir)))
    slow, none = with_rates(counted, 4.0), with_rates(counted, 0.0)
    return slow.select("rate_in", "rate_out").unionAll(none.select("rate_in", "rate_out"))


@query
def ready_records(spark, sf_dir):
    """Records that are normalised already pass the same check and duplicate removal."""
    out = shared_path(spark, "csv")
    records = fixtures.run_sql(spark, sf_dir, fixtures.RECORD_CASES, "customer")
    normalize_job(
        fixtures.features(spark, sf_dir), fixtures.jobs(spark, sf_dir),
        sink=tables.sink_for(csv_path=out), ready_records=records.select(*RECORD_COLUMNS),
    )
    return spark.read.option("header", True).option("escape", '"').csv(out).select("address_norm")


@query
def base_columns(spark, sf_dir):
    """Two loads of one table: its own columns and each address once."""
    path = shared_path(spark, "addresses")
    rows = address_table(spark, sf_dir)
    for _ in range(2):
        tables.load_addresses(rows, path)
    stored = spark.read.parquet(path)
    return stored.select(
        F.explode(F.array(*[F.lit(c) for c in stored.columns])).alias("column_name")
    ).groupBy("column_name").agg(F.count("*").alias("rows"))


@query
def street_fallback(spark, sf_dir):
    """Half of the features name their street in the other property; no required field is asked for here."""
    moved = F.col("feature_id") % 2 == 0
    rows = fixtures.features(spark, sf_dir).withColumns(
        {
            "street_name": F.when(moved, F.col("street")),
            "street": F.when(~moved, F.col("street")),
        }
    )
    named = rows.where("number <> '' AND coalesce(street, street_name) <> ''")
    joined = join_jobs(named, fixtures.jobs(spark, sf_dir))
    return input_addresses(joined).select("feature_id", "address_raw", "language_code")


@query
def single_records(spark, sf_dir):
    """One canonical string after the other into one folder."""
    path = shared_path(spark, "single")
    for row in table(spark, sf_dir, "region").select(F.lower("r_name").alias("name")).collect():
        tables.write_one(spark, row["name"], path)
    return tables.read_csv(spark, path)


@query
def staging_replaced(spark, sf_dir):
    """Staging holds what came last, also where that is less."""
    path, suppliers = shared_path(spark, "staging"), table(spark, sf_dir, "supplier")
    for rows in (suppliers, suppliers.where("s_nationkey > 4")):
        tables.replace_staging(rows.select("s_suppkey", "s_name"), path)
    return spark.read.parquet(path)


@query
def created_table(spark, sf_dir):
    """A table is created once; a second call leaves its rows."""
    path = shared_path(spark, "created")
    name = f"created_{uuid.uuid4().hex}"
    for k in range(2):
        tables.create_if_missing(spark, name, "id BIGINT, name STRING", path)
        if k == 0:
            rows = table(spark, sf_dir, "supplier").select(
                F.col("s_suppkey").cast("bigint").alias("id"), F.col("s_name").alias("name")
            )
            rows.write.insertInto(name)
    return spark.table(name)


@query
def job_counts(spark, sf_dir):
    found = fixtures.jobs(spark, sf_dir)
    counts = [("all", count_jobs(found)), ("limited", count_jobs(limit_jobs(found, 7), 7))]
    return spark.createDataFrame(counts, "chosen STRING, jobs BIGINT")


@query
def boundary_loads(spark, sf_dir):
    """State and county archives, made of all nations and customers, into their tables and the look-up."""
    folders = [shared_path(spark, n) for n in ("states", "counties", "state_all", "county_all", "lookup")]
    write_archives(nation_archives(table(spark, sf_dir, "nation")), folders[0])
    write_archives(customer_archives(table(spark, sf_dir, "customer")), folders[1])
    states = load_states(spark, folders[0], path=folders[2])
    counties, lookup = load_counties(
        spark,
        folders[1],
        states.select("statefp", F.col("name").alias("abbrev")),
        path=folders[3],
        lookup_path=folders[4],
    )
    return (
        counties.select(F.lit("county").alias("kind"), "statefp", F.col("countyfp").alias("code"), "name")
        .unionAll(states.select(F.lit("state"), "statefp", "statens", "name"))
        .unionAll(
            lookup.select(
                F.lit("look-up"), F.col("st_code").cast("string"), F.col("co_code").cast("string"), "name"
            )
        )
    )


@query
def analyzed_tables(spark, sf_dir):
    """Row counts that the catalog knows after the maintenance of a database."""
    database = f"maintained_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{shared_path(spark, 'database')}'")
    names = ("orders", "supplier")
    for name in names:
        table(spark, sf_dir, name).write.saveAsTable(f"{database}.{name}")
    post_load_maintenance(spark, database)
    rows = []
    for name in names:
        described = spark.sql(f"DESCRIBE EXTENDED {database}.{name}").where("col_name = 'Statistics'")
        rows.append((name, described.first()["data_type"]))
    return spark.createDataFrame(rows, "name STRING, known STRING").select(
        "name", F.regexp_extract("known", r"(\d+) rows", 1).cast("bigint").alias("rows")
    )
