"""Test inputs derived from the given tables; the same SQL text runs in Spark and DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from addrloom.sources.geojson import spread

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def run_sql(spark: SparkSession, sf_dir: str, sql: str, *names: str) -> DataFrame:
    """Run SQL text over the given tables without leaving views behind."""
    return spark.sql(sql, **{name: table(spark, sf_dir, name) for name in names})


def feature_sql(rows: str) -> str:
    """Address features of ``rows``, a query giving ``feature_id`` and a variety number ``k``."""
    return f"""
SELECT feature_id, CAST(feature_id % 25 AS STRING) AS job_id,
  CASE WHEN k % 17 = 0 THEN NULL WHEN k % 19 = 0 THEN '' ELSE CAST(1 + k % 97 AS STRING) END
    AS number,
  CASE WHEN k % 23 = 0 THEN NULL WHEN k % 29 = 0 THEN '#'
       ELSE concat('  rue  de la Liberté ', CAST(k AS STRING), ' ') END AS street,
  CASE WHEN k % 5 = 0 THEN concat('unit ', CAST(feature_id % 7 AS STRING)) END AS unit,
  CASE WHEN k % 4 = 0 THEN NULL ELSE lower(n_name) END AS city,
  CASE k % 6 WHEN 0 THEN 'California' WHEN 1 THEN 'ny' WHEN 2 THEN 'district of columbia'
             WHEN 3 THEN ' Puerto Rico' WHEN 4 THEN NULL ELSE 'WYOMING' END AS region,
  CASE k % 8 WHEN 0 THEN NULL WHEN 1 THEN '1234' WHEN 2 THEN 'K1A 0B1'
             ELSE CAST(10000 + k % 13 AS STRING) END AS postcode,
  CASE k % 10 WHEN 0 THEN 'CA' WHEN 1 THEN 'DE' WHEN 2 THEN 'USA' WHEN 3 THEN NULL
              ELSE 'us' END AS country
FROM ({rows}) numbered JOIN {{nation}} AS n ON n_nationkey = k % 25"""


# One feature per customer, nearly all addresses different.
FEATURES = feature_sql("SELECT c_custkey AS feature_id, c_custkey AS k FROM {customer} AS c")

# Size for measuring: one feature per order line, as many different addresses as parts.
LINE_FEATURES = feature_sql(
    "SELECT l_orderkey * 10 + l_linenumber AS feature_id, l_partkey AS k FROM {lineitem} AS l"
)

# One feature per order: the order key is a unique position.
ORDER_FEATURES = feature_sql(
    "SELECT o_orderkey AS feature_id, o_custkey AS k FROM {orders} AS o"
)

JOBS = """
SELECT CAST(n_nationkey AS STRING) AS job_id, n_nationkey AS position,
  CASE WHEN n_nationkey = 11 THEN 'us/ca'
       ELSE concat('us/',
         CASE n_nationkey % 3 WHEN 0 THEN 'ca' WHEN 1 THEN 'ny' ELSE 'wy' END, '/',
         CASE n_nationkey % 4 WHEN 0 THEN 'statewide'
              WHEN 1 THEN concat('city_of_', lower(n_name)) ELSE lower(n_name) END)
  END AS source_name
FROM {nation} AS n"""

PAIRS = f"""
SELECT feature_id, 'house_number' AS label, number AS value, 1 AS pos FROM ({FEATURES}) f
  WHERE number IS NOT NULL
UNION ALL SELECT feature_id, 'road', street, 2 FROM ({FEATURES}) f WHERE street IS NOT NULL
UNION ALL SELECT feature_id, 'city', city, 3 FROM ({FEATURES}) f WHERE city IS NOT NULL
UNION ALL SELECT feature_id, 'city', concat(city, ' B'), 4 FROM ({FEATURES}) f
  WHERE city IS NOT NULL AND feature_id % 9 = 0
UNION ALL SELECT feature_id, 'town', 'Old Town', 5 FROM ({FEATURES}) f WHERE feature_id % 2 = 0
UNION ALL SELECT feature_id, 'state', region, 6 FROM ({FEATURES}) f WHERE region IS NOT NULL"""

STATES = """
SELECT lpad(CAST(r_regionkey AS STRING), 2, '0') AS statefp, substring(r_name, 1, 2) AS abbrev,
  r_name AS name FROM {region} AS r"""

COUNTIES = """
SELECT concat(lpad(CAST(n_regionkey AS STRING), 2, '0'), lpad(CAST(n_nationkey AS STRING), 3, '0'))
    AS geoid,
  lpad(CAST(n_regionkey AS STRING), 2, '0') AS statefp,
  lpad(CAST(n_nationkey AS STRING), 3, '0') AS countyfp, n_name AS name FROM {nation} AS n"""


def record_field(name: str, number: int, base: str, cases: str = "") -> str:
    """A record column: too long in case ``3 + number``, a control character in ``11 + number``."""
    return (
        f"CASE c_custkey % 26 WHEN {3 + number} THEN repeat('a', 257) "
        f"WHEN {11 + number} THEN concat('b', chr(7)) {cases} ELSE {base} END AS {name}"
    )


# Records that break one rule each, by customer number; cases 22 to 24 are plausible.
RECORD_CASES = f"""
SELECT c_custkey AS case_id,
  CASE c_custkey % 26 WHEN 0 THEN 'USA' WHEN 24 THEN ' us ' WHEN 25 THEN '4A' ELSE 'US' END
    AS country_code,
  {record_field("postal_code", 0, "'12345'", "WHEN 2 THEN NULL WHEN 19 THEN '1234'")},
  {record_field("admin_area_1", 1, "'ny'", "WHEN 2 THEN '' WHEN 20 THEN 'new york'")},
  {record_field("admin_area_2", 2, "NULL")},
  {record_field("locality", 3, "'town'", "WHEN 2 THEN NULL WHEN 23 THEN repeat('a', 256)")},
  {record_field("dependent_locality", 4, "'part'")},
  {record_field("thoroughfare", 5, "'main st'", "WHEN 1 THEN '' WHEN 21 THEN '--'")},
  {record_field("premise", 6, "'5'", "WHEN 1 THEN NULL WHEN 21 THEN '#'")},
  {record_field("sub_premise", 7, "NULL")}
FROM {{customer}} AS c"""

# Every country with a known shape, and two others, with codes of several shapes.
POSTAL_CASES = """
SELECT c_custkey AS case_id,
  CASE c_custkey % 12 WHEN 0 THEN 'US' WHEN 1 THEN 'CA' WHEN 2 THEN 'GB' WHEN 3 THEN 'AU'
    WHEN 4 THEN 'NZ' WHEN 5 THEN 'FR' WHEN 6 THEN 'DE' WHEN 7 THEN 'NL' WHEN 8 THEN 'ES'
    WHEN 9 THEN 'IT' WHEN 10 THEN 'BR' ELSE 'us' END AS country_code,
  CASE c_custkey % 13 WHEN 0 THEN '12345' WHEN 1 THEN '12345-6789' WHEN 2 THEN '1234'
    WHEN 3 THEN 'k1a 0b1' WHEN 4 THEN 'K1A0B1' WHEN 5 THEN 'K1A-0B1' WHEN 6 THEN 'SW1A 1AA'
    WHEN 7 THEN 'M11AE' WHEN 8 THEN '1234 ab' WHEN 9 THEN '1234AB' WHEN 10 THEN '123456'
    WHEN 11 THEN ' 12345 ' ELSE 'ABCDE' END AS postal_code
FROM {customer} AS c"""

# Lines of every kind the reader tells apart, by event number.
LINE_CASES = """
SELECT event_id, CASE event_id % 8
  WHEN 0 THEN concat('{{"type":"Feature","properties":{{"number":', CAST(event_id AS STRING),
                     ',"street":"s"}}}}')
  WHEN 1 THEN concat('{{"type":"FeatureCollection","features":[{{"properties":{{"number":"',
                     CAST(event_id AS STRING),
                     '"}}}},{{"properties":null}},{{"properties":{{"street":"t"}}}}]}}')
  WHEN 2 THEN concat(' ', chr(30), ' {{"type":"Feature","properties":{{"number":"0","street":""}}}} ')
  WHEN 3 THEN '{{"type":"Feature","properties":{{"number":'
  WHEN 4 THEN '[1]'
  WHEN 5 THEN '{{"type":"Other","properties":{{"number":0,"street":"q"}}}}'
  WHEN 6 THEN '{{"type":"Other","properties":[1]}}'
  ELSE '{{"type":"Feature","properties":null}} {{"type":"Feature"}}' END AS value
FROM {events} AS e"""

# Manifest lines, by customer number: numeric, text, zero and absent jobs of several places.
MANIFEST = """
SELECT concat('{{"job":', CASE c_custkey % 7 WHEN 0 THEN '0' WHEN 2 THEN 'null'
    WHEN 1 THEN concat('"j', CAST(c_custkey AS STRING), '"') ELSE CAST(c_custkey AS STRING) END,
  ',"source":"', CASE c_custkey % 5 WHEN 0 THEN 'us/ca/x' WHEN 1 THEN 'us/ca' WHEN 2 THEN 'us/cal/x'
    WHEN 3 THEN '' ELSE 'us/ny/y' END,
  '","layer":"', CASE c_custkey % 3 WHEN 0 THEN 'buildings' ELSE 'addresses' END, '"}}') AS value
FROM {customer} AS c"""


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_sql(spark, sf_dir, FEATURES, "customer", "nation")


def line_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = run_sql(spark, sf_dir, LINE_FEATURES, "lineitem", "nation")
    return spread(rows, key="feature_id")


def order_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_sql(spark, sf_dir, ORDER_FEATURES, "orders", "nation")


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_sql(spark, sf_dir, JOBS, "nation")


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_sql(spark, sf_dir, PAIRS, "customer", "nation")


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_sql(spark, sf_dir, STATES, "region")


def counties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_sql(spark, sf_dir, COUNTIES, "nation")


def for_duckdb(sql: str) -> str:
    """The same text with plain table names."""
    return sql.format(**{name: name for name in TABLES})
