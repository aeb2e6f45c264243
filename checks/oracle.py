"""The SQL that DuckDB runs for each query, written from the operators' definitions."""

from __future__ import annotations

from addrloom.functions.components import LABELS
from addrloom.functions.regions import US_STATES
from checks import fixtures
from checks.fixtures import for_duckdb

FEATURES = for_duckdb(fixtures.FEATURES)
LINE_FEATURES = for_duckdb(fixtures.LINE_FEATURES)
ORDER_FEATURES = for_duckdb(fixtures.ORDER_FEATURES)
JOBS = for_duckdb(fixtures.JOBS)

STATE_CASES = " ".join(
    f"WHEN '{name.upper()}' THEN '{code}' WHEN '{code}' THEN '{code}'"
    for name, code in US_STATES.items()
)


def state_code(region: str, country: str) -> str:
    upper = f"upper(trim({region}))"
    return f"""CASE WHEN {region} IS NULL OR {region} = '' THEN ''
      WHEN upper({country}) = 'US' THEN CASE {upper} {STATE_CASES} ELSE substring({upper}, 1, 2) END
      ELSE {upper} END"""


def ws(text: str) -> str:
    return f"trim(regexp_replace({text}, '\\s+', ' ', 'g'))"


def parts_ctes(features: str, jobs: str = JOBS) -> str:
    country = "coalesce(nullif(country, ''), job_country)"
    region = "coalesce(nullif(region, ''), job_region)"
    return f"""
feat AS ({features}),
jobs AS (SELECT *, split_part(source_name, '/', 1) AS job_country,
    split_part(source_name, '/', 2) AS job_region, split_part(source_name, '/', 3) AS job_city
  FROM ({jobs}) WHERE len(string_split(source_name, '/')) = 3),
parts AS (SELECT feature_id, feat.job_id, city AS own_city, region AS own_region,
    nullif(trim(number), '') AS p_number, nullif(upper(trim(street)), '') AS p_street,
    nullif(trim(unit), '') AS p_unit,
    upper(trim(coalesce(nullif(city, ''),
      replace(replace(job_city, 'city_of_', ''), '_', ' ')))) AS p_city,
    upper({state_code(region, country)}) AS p_region, nullif(trim(postcode), '') AS p_postcode,
    upper({country}) AS p_country
  FROM feat JOIN jobs ON feat.job_id = jobs.job_id
  WHERE number <> '' AND street <> ''),
inputs AS (SELECT *, upper(trim(p_country)) AS cc,
    {ws("concat_ws(', ', concat_ws(' ', p_number, p_street, p_unit), nullif(concat_ws(', ', p_city, p_region, p_postcode), ''), p_country)")}
      AS address_raw FROM parts)"""


POSTAL = {
    "US": r"^\d{5}(-\d{4})?$",
    "CA": r"^[A-Z]\d[A-Z][ -]?\d[A-Z]\d$",
    "GB": r"^[A-Z]{1,2}\d[A-Z\d]?\s*\d[A-Z]{2}$",
    "AU": r"^\d{4}$",
    "NZ": r"^\d{4}$",
    "FR": r"^\d{5}$",
    "DE": r"^\d{5}$",
    "NL": r"^\d{4}\s?[A-Z]{2}$",
    "ES": r"^\d{5}$",
    "IT": r"^\d{5}$",
}
SHAPE_OK = (
    "CASE {cc} "
    + " ".join(
        f"WHEN '{cc}' THEN regexp_matches(upper(trim(postal_code)), '{shape}')"
        for cc, shape in POSTAL.items()
    ).replace("{", "{{").replace("}", "}}")
    + " ELSE TRUE END"
)
FIELDS = (
    "postal_code", "admin_area_1", "admin_area_2", "locality", "dependent_locality",
    "thoroughfare", "premise", "sub_premise",
)
HYGIENE = "\n".join(
    f"""WHEN length({name}) > 256 THEN '{name}_too_long'
    WHEN regexp_matches({name}, '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]')
      THEN '{name}_has_control_chars'"""
    for name in FIELDS
)
CC = "upper(trim(coalesce(country_code, '')))"
REASON = f"""CASE WHEN NOT regexp_matches({CC}, '^\\p{{L}}{{2}}$') THEN 'invalid country_code'
    WHEN coalesce(nullif(thoroughfare, ''), nullif(premise, '')) IS NULL
      THEN 'missing thoroughfare_or_premise'
    WHEN coalesce(nullif(locality, ''), nullif(admin_area_1, ''), nullif(admin_area_2, ''),
      nullif(postal_code, '')) IS NULL THEN 'missing locality_admin_or_postal'
    {HYGIENE}
    WHEN postal_code <> '' AND NOT {SHAPE_OK.format(cc=CC)} THEN 'postal_code_shape_mismatch'
    WHEN {CC} = 'US' AND admin_area_1 <> ''
      AND NOT regexp_matches(upper(trim(admin_area_1)), '^[A-Z]{{2}}$')
      THEN 'admin_area_1_not_two_letter_state'
    WHEN NOT (coalesce(regexp_matches(thoroughfare, '[A-Za-z0-9]'), FALSE)
      OR coalesce(regexp_matches(premise, '[A-Za-z0-9]'), FALSE))
      THEN 'empty_delivery_line_content' END"""
RECORD_COLUMNS = "country_code, " + ", ".join(FIELDS)


CANONICAL = ws(
    """lower(strip_accents(concat_ws(', ',
    nullif(concat_ws(' ', nullif(premise, ''), nullif(thoroughfare, '')), ''),
    nullif(dependent_locality, ''), nullif(locality, ''), nullif(admin_area_2, ''),
    nullif(admin_area_1, ''), nullif(postal_code, ''), nullif(lower(country_code), ''))))"""
)


def record_ctes(features: str, jobs: str = JOBS) -> str:
    low = {
        name: f"nullif({ws(f'lower(p_{name})')}, '')"
        for name in ("number", "street", "unit", "city", "region", "postcode")
    }
    return f"""{parts_ctes(features, jobs)},
records AS (SELECT feature_id, job_id, cc AS country_code, {low['postcode']} AS postal_code,
    {low['region']} AS admin_area_1, CAST(NULL AS VARCHAR) AS admin_area_2,
    {low['city']} AS locality, CAST(NULL AS VARCHAR) AS dependent_locality,
    {low['street']} AS thoroughfare, {low['number']} AS premise, {low['unit']} AS sub_premise
  FROM inputs),
checked AS (SELECT *, {REASON} AS reason FROM records),
canon AS (SELECT *, {CANONICAL} AS address_norm FROM checked WHERE reason IS NULL)"""


CUSTOMER = record_ctes(FEATURES)
# The survivor of a key is the least row in record column order, nulls first.
ADDRESSES = f"""{CUSTOMER},
addresses AS (SELECT {RECORD_COLUMNS}, address_norm FROM (SELECT *, row_number() OVER (
    PARTITION BY address_norm ORDER BY {", ".join(f"{name} NULLS FIRST" for name in ("country_code", *FIELDS))}) AS rn
  FROM canon) WHERE rn = 1)"""


def grams(text: str) -> str:
    words = f"regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}]+')"
    return (
        f"list_distinct(flatten(list_transform({words}, lambda w: list_transform("
        f"range(1, length(w) + 2), lambda i: substring('  ' || w || ' ', i, 3)))))"
    )


def similarity(left: str, right: str) -> str:
    shared = f"len(list_intersect({left}, {right}))"
    return f"(CAST({shared} AS DOUBLE) / CAST(len({left}) + len({right}) - {shared} AS DOUBLE))"


def title(text: str) -> str:
    cased = "\\p{Lu}\\p{Ll}\\p{Lt}"
    runs = f"regexp_extract_all({text}, '[{cased}]+|[^{cased}]+')"
    return (
        f"array_to_string(list_transform({runs}, "
        f"lambda x: CASE substring(x, 1, 1) WHEN 'ß' THEN 'Ss' ELSE upper(substring(x, 1, 1)) END "
        f"|| lower(substring(x, 2))), '')"
    )


def label_text(labels: tuple[str, ...], known: dict[str, str]) -> str:
    return "coalesce(" + ", ".join(f"nullif({known[label]}, '')" for label in labels) + ")"


def component_list(known: dict[str, str]) -> str:
    """Component columns from one expression per label."""
    joined = "nullif(concat_ws(' ', nullif({}, ''), nullif({}, '')), '')"
    house = label_text(LABELS["house"], known)
    return f"""{known['postcode']} AS postal_code,
  {label_text(LABELS['admin_area_1'], known)} AS admin_area_1,
  {label_text(LABELS['admin_area_2'], known)} AS admin_area_2,
  {label_text(LABELS['locality'], known)} AS locality,
  {label_text(LABELS['dependent_locality'], known)} AS dependent_locality,
  {label_text(LABELS['thoroughfare'], known)} AS thoroughfare,
  {joined.format(known['house_number'], house)} AS premise,
  {joined.format(known['level'], known['unit'])} AS sub_premise"""


ALL_LABELS = [label for labels in LABELS.values() for label in labels] + [
    "house_number", "level", "unit", "postcode", "country",
]
FROM_CUSTOMER = {
    label: f"CASE WHEN (c_custkey * {i + 3} + {i}) % 5 < 2 THEN "
    f"concat('{label} ', CAST(c_custkey AS STRING)) END"
    for i, label in enumerate(ALL_LABELS)
}
FROM_PAIRS = {
    label: ws(f"lower(max_by(value, pos) FILTER (label = '{label}'))") for label in ALL_LABELS
}

WORDS = "regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')"
SPACE = r"[\t-\r\x1c-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
TAGS = """SELECT feature_id, label, value FROM (
  SELECT feature_id, 'house_number' AS label, {n} AS value FROM inputs
  UNION ALL SELECT feature_id, 'road', {s} FROM inputs
  UNION ALL SELECT feature_id, 'unit', {u} FROM inputs
  UNION ALL SELECT feature_id, 'city', p_city FROM inputs
  UNION ALL SELECT feature_id, 'state', p_region FROM inputs
  UNION ALL SELECT feature_id, 'postcode', {p} FROM inputs
  UNION ALL SELECT feature_id, 'country', p_country FROM inputs) WHERE value <> ''"""

# Batches of unique rows, one recursive step per batch: the place behind the last row of it that no row
# since the batch's start has the string of.
UNIQUE_BATCHES = """placed AS (
    SELECT feature_id, {job} AS job, address_norm, row_number() OVER (PARTITION BY {job} ORDER BY feature_id) - 1
      AS place FROM canon JOIN (SELECT feature_id, job_id FROM checked) AS j USING (feature_id)
  ), prior AS (
    SELECT *, coalesce(lag(place) OVER (PARTITION BY job, address_norm ORDER BY place), -1) AS before
    FROM placed
  ), starts AS (
    SELECT DISTINCT job, CAST(0 AS BIGINT) AS batch_id, CAST(0 AS BIGINT) AS start FROM prior
    UNION ALL
    SELECT job, batch_id + 1, place + 1 FROM (
      SELECT s.job, s.batch_id, p.place, row_number() OVER (PARTITION BY s.job ORDER BY p.place) AS n
      FROM starts s JOIN prior p ON p.job = s.job AND p.place >= s.start AND p.before < s.start)
    WHERE n = {size}
  ), marked AS (
    SELECT feature_id, p.job, address_norm, batch_id, before < start AS kept
    FROM prior p ASOF JOIN starts s ON p.job = s.job AND p.place >= s.start
  )"""

ORACLE: dict[str, str] = {
    "ascii_fold_documents": "SELECT doc_id, strip_accents(text) AS folded FROM documents",
    "ascii_fold_turns": "SELECT conv_id, turn, strip_accents(text) AS folded FROM conversations",
    "clean_ws_documents": f"""SELECT doc_id, trim(regexp_replace(text, '{SPACE}', ' ', 'g'))
      AS cleaned FROM documents""",
    "title_documents": f"SELECT doc_id, {title('text')} AS titled FROM documents",
    "region_codes": f"""SELECT feature_id, {state_code('region', 'country')} AS region_code
      FROM ({FEATURES})""",
    "token_vectors": f"""SELECT doc_id, array_to_string({WORDS}, '|') AS words,
      CAST(len({WORDS}) AS BIGINT) AS n FROM documents""",
    "trigram_sets": f"""SELECT p_partkey, array_to_string(list_sort({grams('p_name')}), '|') AS grams
      FROM part""",
    "required_fields_filter": f"""SELECT feature_id, number, street FROM ({FEATURES})
      WHERE number <> '' AND street <> ''""",
    "compose_raw": f"""WITH {parts_ctes(FEATURES)}
      SELECT feature_id, address_raw, 'en' AS language_code FROM inputs""",
    "country_code": f"""WITH {parts_ctes(FEATURES)}
      SELECT feature_id, cc AS country_code FROM inputs""",
    "job_name_parts": f"""SELECT job_id, split_part(source_name, '/', 1) AS job_country,
      split_part(source_name, '/', 2) AS job_region, split_part(source_name, '/', 3) AS job_city,
      replace(replace(split_part(source_name, '/', 3), 'city_of_', ''), '_', ' ') AS city
      FROM ({JOBS}) WHERE len(string_split(source_name, '/')) = 3""",
    "job_name_rejects": f"""SELECT job_id, source_name FROM ({JOBS})
      WHERE len(string_split(source_name, '/')) <> 3""",
    "jobs_limit": f"""WITH {parts_ctes(FEATURES, f"SELECT * FROM ({JOBS}) ORDER BY position LIMIT 5")}
      SELECT job_id, count(*) AS features FROM inputs GROUP BY job_id""",
    "structured_tags": f"""WITH {parts_ctes(FEATURES)}
      {TAGS.format(n='p_number', s='p_street', u='p_unit', p='p_postcode')}""",
    "free_text_tags": f"""WITH {parts_ctes(FEATURES)}
      {TAGS.format(n='p_number', s=ws('p_street'), u='upper(p_unit)', p='upper(p_postcode)')}""",
    "custom_tags": f"""WITH {parts_ctes(FEATURES)}
      SELECT feature_id, 'house_number' AS label, split_part(address_raw, ' ', 1) AS value FROM inputs
      UNION ALL SELECT feature_id, 'country', cc FROM inputs""",
    "components": f"""SELECT feature_id, {component_list(FROM_PAIRS)}
      FROM ({for_duckdb(fixtures.PAIRS)}) GROUP BY feature_id""",
    "label_priority": f"""SELECT c_custkey AS feature_id, {component_list(FROM_CUSTOMER)},
      {FROM_CUSTOMER['country']} AS country FROM customer""",
    "backfill": f"""WITH {parts_ctes(FEATURES)}
      SELECT feature_id, cc AS country_code,
        nullif({state_code("nullif(own_region, '')", 'cc')}, '') AS admin_area_1,
        {title(ws("nullif(own_city, '')"))} AS locality FROM inputs""",
    "backfill_none_text": f"""WITH {parts_ctes(FEATURES)}
      SELECT feature_id, {state_code("coalesce(nullif(own_region, ''), 'None')", 'cc')}
        AS admin_area_1 FROM inputs""",
    "normalised_records": f"WITH {CUSTOMER} SELECT feature_id, {RECORD_COLUMNS} FROM records",
    "validation_reasons": f"WITH {CUSTOMER} SELECT reason, count(*) AS rows FROM checked GROUP BY reason",
    "valid_rows": f"""WITH {CUSTOMER} SELECT feature_id, {RECORD_COLUMNS} FROM checked
      WHERE reason IS NULL""",
    "validation_cases": f"""SELECT case_id, {REASON} AS reason
      FROM ({for_duckdb(fixtures.RECORD_CASES)})""",
    "postal_shapes": f"""SELECT case_id, {SHAPE_OK.format(cc='country_code')} AS shape_ok
      FROM ({for_duckdb(fixtures.POSTAL_CASES)})""",
    "canonical": f"WITH {CUSTOMER} SELECT feature_id, address_norm FROM canon",
    "dedupe_global": f"WITH {CUSTOMER} SELECT DISTINCT address_norm FROM canon",
    "dedupe_all_columns": f"WITH {ADDRESSES} SELECT {RECORD_COLUMNS}, address_norm FROM addresses",
    "no_dedupe": f"WITH {CUSTOMER} SELECT address_norm FROM canon",
    "batch_numbers": f"""WITH {record_ctes(ORDER_FEATURES)} SELECT feature_id, job_id,
      CAST((row_number() OVER (PARTITION BY job_id ORDER BY feature_id) - 1) // 1000 AS BIGINT)
        AS batch_id FROM checked""",
    "dedupe_batch": f"""WITH {record_ctes(ORDER_FEATURES)}, numbered AS (SELECT feature_id,
        CAST((row_number() OVER (PARTITION BY job_id ORDER BY feature_id) - 1) // 1000 AS BIGINT)
        AS batch_id, job_id FROM checked)
      SELECT address_norm, count(DISTINCT (numbered.job_id, batch_id)) AS batches
      FROM canon JOIN numbered USING (feature_id) GROUP BY address_norm""",
    "unique_batches": f"""WITH RECURSIVE {record_ctes(ORDER_FEATURES)}, {UNIQUE_BATCHES.format(job="''", size=200)}
      SELECT feature_id, batch_id, kept FROM marked""",
    "unique_batches_per_job": f"""WITH RECURSIVE {record_ctes(ORDER_FEATURES)},
      {UNIQUE_BATCHES.format(job="j.job_id", size=200)}
      SELECT job AS job_id, batch_id, count(*) AS rows, count(*) FILTER (kept) AS kept_rows
      FROM marked GROUP BY job, batch_id""",
    "batch_job": f"""WITH RECURSIVE {record_ctes(ORDER_FEATURES)}, {UNIQUE_BATCHES.format(job="j.job_id", size=1000)}
      SELECT address_norm, count(*) AS batches FROM marked WHERE kept GROUP BY address_norm""",
    "dedupe_lines": f"WITH {record_ctes(LINE_FEATURES)} SELECT DISTINCT address_norm FROM canon",
    "counters": f"""WITH {CUSTOMER}, n AS (SELECT (SELECT count(*) FROM checked) AS processed,
        (SELECT count(DISTINCT address_norm) FROM canon) AS written,
        (SELECT count(*) FROM canon) AS valid)
      SELECT processed, written, valid - written AS deduped, processed - valid AS invalids FROM n""",
    "counters_per_job": f"SELECT job_id, count(*) AS features FROM ({FEATURES}) GROUP BY job_id",
    "county_look_up": f"""SELECT CAST(s.statefp AS INTEGER) AS st_code, s.abbrev AS state,
      CAST(c.countyfp AS INTEGER) AS co_code, c.name FROM ({for_duckdb(fixtures.COUNTIES)}) c
      JOIN ({for_duckdb(fixtures.STATES)}) s ON s.statefp = c.statefp""",
    "customer_county_look_up": """SELECT n_nationkey AS st_code, n_name AS state,
      CAST(c_custkey AS INTEGER) AS co_code, c_name AS name
      FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "parent_child_view": """SELECT s_suppkey AS id, s_name AS name, s_nationkey AS nation
      FROM supplier UNION ALL SELECT c_custkey, c_name, NULL FROM customer""",
    "load_by_name": """SELECT c_custkey AS id, c_name AS name, CAST(NULL AS VARCHAR) AS note
      FROM customer""",
    "stored_table": f"SELECT feature_id, street, postcode FROM ({ORDER_FEATURES})",
    "postal_filter": f"""WITH {ADDRESSES} SELECT address_norm, country_code, postal_code
      FROM addresses WHERE country_code = 'US' AND postal_code = '10003'""",
    "street_prefix": f"""WITH {ADDRESSES} SELECT thoroughfare, address_norm FROM addresses
      WHERE starts_with(thoroughfare, 'rue de la liberté 1')""",
    "substring_search": f"""WITH {ADDRESSES} SELECT address_norm FROM addresses
      WHERE contains(address_norm, 'liberte 1')""",
    "trigram_scores": f"""SELECT p_partkey, {similarity('a', 'b')} AS similarity FROM (
      SELECT p_partkey, {grams('p_name')} AS a, {grams("'small red widget'")} AS b FROM part)""",
    "trigram_topk": f"""SELECT p_partkey, full_name, similarity FROM (
      SELECT p_partkey, full_name, {similarity('a', 'b')} AS similarity FROM (
        SELECT p_partkey, full_name, {grams('full_name')} AS a,
          {grams("'red widget brand 17 economy 12'")} AS b FROM (SELECT p_partkey, concat_ws(' ',
            p_name, p_brand, p_type, CAST(p_partkey AS VARCHAR)) AS full_name FROM part)))
      WHERE similarity >= 0.3 ORDER BY similarity DESC, full_name LIMIT 20""",
    "trigram_match": f"""WITH {ADDRESSES},
      q AS (SELECT s_suppkey AS query_id, {grams(
        "concat('rue de la libert ', CAST(s_suppkey % 97 AS VARCHAR))")} AS b FROM supplier),
      a AS (SELECT address_norm AS id, {grams('address_norm')} AS a FROM addresses)
      SELECT query_id, id, {similarity('a', 'b')} AS similarity FROM a, q
      WHERE {similarity('a', 'b')} >= 0.45""",
    "trigram_match_topk": f"""WITH q AS (SELECT s_suppkey AS query_id, {grams('s_name')} AS b
        FROM supplier),
      a AS (SELECT c_custkey AS id, c_name, {grams('c_name')} AS a FROM customer),
      scored AS (SELECT query_id, id, c_name, {similarity('a', 'b')} AS similarity FROM a, q)
      SELECT query_id, id, similarity FROM (SELECT *, row_number() OVER (PARTITION BY query_id
        ORDER BY similarity DESC, c_name, id) AS rn FROM scored WHERE similarity >= 0.3)
      WHERE rn <= 3""",
    "token_search": f"SELECT doc_id FROM documents WHERE list_has_all({WORDS}, ['de', 'la'])",
    "token_index_search": f"""SELECT doc_id AS id FROM documents
      WHERE list_has_all({WORDS}, ['the', 'of'])""",
    "csv_round_trip": f"WITH {CUSTOMER} SELECT DISTINCT address_norm FROM canon",
    "csv_quoting": """SELECT concat(props, ', "', event_type, ' "') AS address_norm FROM events""",
    "insert_if_absent": f"""WITH {CUSTOMER} SELECT address_norm, concat_ws('-', substring(h, 1, 8),
        substring(h, 9, 4), substring(h, 13, 4), substring(h, 17, 4), substring(h, 21, 12)) AS uuid,
        CAST(1 AS BIGINT) AS copies
      FROM (SELECT DISTINCT address_norm, sha256(address_norm) AS h FROM canon)""",
    "append_without_key": f"""WITH {CUSTOMER} SELECT DISTINCT address_norm, CAST(2 AS BIGINT) AS copies
      FROM canon""",
    "bucketed_round_trip": f"""WITH {CUSTOMER} SELECT concat_ws('-', substring(h, 1, 8),
        substring(h, 9, 4), substring(h, 13, 4), substring(h, 17, 4), substring(h, 21, 12)) AS uuid,
        address_norm
      FROM (SELECT DISTINCT address_norm, sha256(address_norm) AS h FROM canon)""",
    "search_layout_round_trip": f"""WITH {ADDRESSES} SELECT address_norm FROM addresses
      WHERE starts_with(thoroughfare, 'rue de la liberté 2')""",
    "geojson_scan": f"""SELECT job_id, nullif(number, '') AS number, nullif(street, '') AS street,
      unit, city, region, postcode, country FROM ({FEATURES})""",
    "geojson_job": f"WITH {CUSTOMER} SELECT DISTINCT address_norm FROM canon",
    "json_truthiness": """SELECT event_id, nullif(json_extract_string(props, '$.k'), '0') AS number
      FROM events""",
    "feature_collections": """
      SELECT event_id, CAST(0 AS BIGINT) AS item,
        nullif(CAST(event_id AS VARCHAR), '0') AS number, 's' AS street
        FROM events WHERE event_id % 8 = 0
      UNION ALL SELECT event_id, 0, CAST(event_id AS VARCHAR), NULL FROM events WHERE event_id % 8 = 1
      UNION ALL SELECT event_id, 1, NULL, NULL FROM events WHERE event_id % 8 = 1
      UNION ALL SELECT event_id, 2, NULL, 't' FROM events WHERE event_id % 8 = 1
      UNION ALL SELECT event_id, 0, '0', NULL FROM events WHERE event_id % 8 = 2
      UNION ALL SELECT event_id, 0, NULL, 'q' FROM events WHERE event_id % 8 = 5""",
    "malformed_lines": "SELECT event_id FROM events WHERE event_id % 8 IN (3, 4, 7)",
    "manifest_scan": """SELECT CASE c_custkey % 7 WHEN 1 THEN concat('j', CAST(c_custkey AS VARCHAR))
        ELSE CAST(c_custkey AS VARCHAR) END AS job_id,
      CASE c_custkey % 5 WHEN 0 THEN 'us/ca/x' ELSE 'us/ca' END AS source_name FROM customer
      WHERE c_custkey % 7 NOT IN (0, 2) AND c_custkey % 5 IN (0, 1) AND c_custkey % 3 <> 0""",
    "incremental_landing": f"""SELECT DISTINCT job_id,
      CASE WHEN starts_with(job_id, '1') THEN 'skipped' ELSE 'new' END AS state
      FROM ({FEATURES})""",
    "stream_normalize": f"WITH {CUSTOMER} SELECT DISTINCT address_norm FROM canon",
    "stream_dedupe": f"WITH {CUSTOMER} SELECT DISTINCT address_norm FROM canon",
    "key_rule_violations": """WITH o AS (SELECT *, CASE WHEN o_orderkey % 7 > 0
        THEN o_orderkey % 1000 END AS part_key FROM orders)
      SELECT 'pk_orders' AS key_name, 'duplicate' AS problem, CAST(o_orderkey AS VARCHAR) AS key_value,
        count(*) AS rows FROM o GROUP BY o_orderkey HAVING count(*) > 1
      UNION ALL SELECT 'pk_part', CASE WHEN part_key IS NULL THEN 'null' ELSE 'duplicate' END,
        coalesce(CAST(part_key AS VARCHAR), 'NULL'), count(*) FROM o GROUP BY part_key
        HAVING part_key IS NULL OR count(*) > 1
      UNION ALL SELECT 'uidx_part', 'duplicate', concat_ws('|', CAST(part_key AS VARCHAR),
        o_orderstatus), count(*) FROM o WHERE part_key IS NOT NULL AND o_orderstatus IS NOT NULL
        GROUP BY part_key, o_orderstatus HAVING count(*) > 1""",
    "county_key_violations": f"""WITH c AS (SELECT * FROM ({for_duckdb(fixtures.COUNTIES)})
        WHERE statefp = '01')
      SELECT 'pk_county_all' AS key_name, 'duplicate' AS problem, geoid AS key_value,
        CAST(2 AS BIGINT) AS rows FROM c
      UNION ALL SELECT 'uidx_county_all_statefp_countyfp', 'duplicate',
        concat(statefp, '|', countyfp), 2 FROM c""",
}

LIMITS = {
    "country_code": 2, "postal_code": 20, "admin_area_1": 80, "admin_area_2": 80, "locality": 120,
    "dependent_locality": 120, "thoroughfare": 160, "premise": 60, "sub_premise": 30,
}


def rule_counts(source: str) -> str:
    counts = [
        f"SELECT '{name}' AS column_name, 'max_length' AS rule, "
        f"count(*) FILTER (length({name}) > {limit}) AS rows FROM {source}"
        for name, limit in LIMITS.items()
    ] + [
        f"SELECT '{name}', 'not_null', count(*) FILTER ({name} IS NULL) FROM {source}"
        for name in ("country_code", "address_norm")
    ]
    return " UNION ALL ".join(counts)


ORACLE["column_rule_violations"] = f"WITH {ADDRESSES} {rule_counts('addresses')}"
ORACLE["column_rule_cases"] = f"""WITH cases AS (SELECT *,
    CASE WHEN thoroughfare <> '' THEN thoroughfare END AS address_norm
  FROM ({for_duckdb(fixtures.RECORD_CASES)})) {rule_counts('cases')}"""
ORACLE["table_stats"] = " UNION ALL ".join(
    f"SELECT '{name}' AS column_name, count(*) AS rows, "
    f"count(*) FILTER ({name} IS NULL) AS nulls, CAST(min({name}) AS VARCHAR) AS min_value, "
    f"CAST(max({name}) AS VARCHAR) AS max_value FROM orders"
    for name in ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
)

ORACLE["stream_restart"] = f"""WITH {CUSTOMER}
  SELECT DISTINCT address_norm, true AS found FROM canon"""
ORACLE["stream_second_run"] = ORACLE["stream_dedupe"]
ORACLE["stream_csv"] = ORACLE["stream_dedupe"]
ORACLE["jobs_limit_files"] = f"""SELECT job_id, count(*) AS features FROM ({FEATURES})
  WHERE job_id IN (SELECT job_id FROM ({JOBS}) ORDER BY position LIMIT 5) GROUP BY job_id"""
ORACLE["manifest_indented"] = ORACLE["manifest_scan"]
ORACLE["cut_files"] = f"""SELECT DISTINCT job_id, CAST(job_id AS INT) % 2 = 1 AS is_cut
  FROM ({FEATURES})"""
ORACLE["trigram_match_repeated"] = f"""WITH q AS (
    SELECT s_suppkey * sign AS query_id, {grams('s_name')} AS b
    FROM supplier, (VALUES (1), (-1)) AS signs(sign)),
  a AS (SELECT c_custkey AS id, {grams('c_name')} AS a FROM customer)
  SELECT query_id, id, {similarity('a', 'b')} AS similarity FROM a, q
  WHERE {similarity('a', 'b')} >= 0.3"""
ORACLE["lookup_join_large"] = """SELECT s_name, count(*) AS rows FROM lineitem JOIN supplier
  ON s_suppkey = CASE WHEN l_linenumber % 3 = 0 THEN 1 ELSE l_suppkey END GROUP BY s_name"""
ORACLE["run_rates"] = f"""WITH {CUSTOMER}, n AS (SELECT (SELECT count(*) FROM checked) AS processed,
    (SELECT count(DISTINCT address_norm) FROM canon) AS written)
  SELECT processed / 4.0::DOUBLE AS rate_in, written / 4.0::DOUBLE AS rate_out FROM n
  UNION ALL SELECT 0.0::DOUBLE, 0.0::DOUBLE"""
ORACLE["base_columns"] = f"""WITH {CUSTOMER}
  SELECT unnest(['uuid', 'country_code', 'postal_code', 'admin_area_1', 'admin_area_2', 'locality',
    'dependent_locality', 'thoroughfare', 'premise', 'sub_premise', 'address_norm', 'search_vector'])
    AS column_name, (SELECT count(DISTINCT address_norm) FROM canon) AS rows"""
ORACLE["stream_unique"] = ORACLE["stream_dedupe"]
ORACLE["source_scan"] = ORACLE["source_stream"] = ORACLE["geojson_scan"]
ORACLE["source_scan_jobs"] = f"""SELECT * FROM ({ORACLE["geojson_scan"]})
  WHERE job_id IN ('3', '14', '24') AND street IS NOT NULL"""
ORACLE["area_load"] = ORACLE["insert_if_absent"]
ORACLE["ready_records"] = f"""WITH {CUSTOMER},
  ready AS (SELECT *, {REASON} AS reason FROM ({for_duckdb(fixtures.RECORD_CASES)}))
  SELECT address_norm FROM canon UNION SELECT {CANONICAL} FROM ready WHERE reason IS NULL"""
ORACLE["street_fallback"] = ORACLE["compose_raw"]
ORACLE["single_records"] = "SELECT lower(r_name) AS address_norm FROM region"
ORACLE["staging_replaced"] = "SELECT s_suppkey, s_name FROM supplier WHERE s_nationkey > 4"
ORACLE["created_table"] = "SELECT s_suppkey AS id, s_name AS name FROM supplier"
ORACLE["job_counts"] = f"""SELECT 'all' AS chosen, count(*) AS jobs FROM ({JOBS})
  UNION ALL SELECT 'limited', least(count(*), 7) FROM ({JOBS})"""
ORACLE["boundary_loads"] = """SELECT 'county' AS kind, lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS statefp,
    lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS code, c_name AS name FROM customer
  UNION ALL SELECT 'state', lpad(CAST(n_nationkey AS VARCHAR), 2, '0'), CAST(n_nationkey AS VARCHAR), n_name
  FROM nation
  UNION ALL SELECT 'look-up', CAST(n_nationkey AS VARCHAR), CAST(c_custkey AS VARCHAR), c_name
  FROM customer JOIN nation ON c_nationkey = n_nationkey"""
ORACLE["analyzed_tables"] = """SELECT 'orders' AS name, count(*) AS rows FROM orders
  UNION ALL SELECT 'supplier', count(*) FROM supplier"""
