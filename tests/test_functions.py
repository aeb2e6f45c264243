"""Column functions against definitions in plain Python."""

from __future__ import annotations

import random
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from addrloom.functions.components import COMPONENTS, canonical_string
from addrloom.functions.regions import US_STATES, normalize_region
from addrloom.functions.text import ascii_fold, clean_ws, first_non_empty, strip, title_case
from addrloom.functions.tokens import token_positions, trigram_similarity, trigrams
from addrloom.functions.validate import rejection_reason


def fold(text: str) -> str:
    plain = unicodedata.normalize("NFKD", text)
    return "".join(ch for ch in plain if not unicodedata.combining(ch))


SPACES = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())
ALPHABET = SPACES + "abcAB1é ñÅﬁß½Ωж中'-.#​"


def texts(count: int) -> list[str]:
    rng = random.Random(7)
    return ["".join(rng.choices(ALPHABET, k=rng.randint(0, 9))) for _ in range(count)]


def test_text_functions_match_python(spark):
    rows = spark.createDataFrame([(text,) for text in texts(5000)], "s STRING")
    got = rows.select("s", strip("s"), clean_ws("s"), ascii_fold("s"), title_case("s")).collect()
    for text, stripped, cleaned, folded, titled in got:
        assert stripped == text.strip()
        assert cleaned == " ".join(text.split())
        assert folded == fold(text)
        assert titled == text.title()


def test_fold_covers_every_assigned_character(spark):
    points = [c for c in range(1, 0x30000) if unicodedata.category(chr(c)) not in ("Cn", "Cs")]
    rows = spark.createDataFrame([(c, f"a{chr(c)}b") for c in points], "c INT, s STRING")
    got = rows.select("c", ascii_fold("s").alias("f")).collect()
    assert [hex(c) for c, f in got if f != fold(f"a{chr(c)}b")] == []


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(max_size=12), min_size=20, max_size=40))
def test_clean_ws_is_idempotent(spark, values):
    rows = spark.createDataFrame([(v,) for v in values], "s STRING")
    once = rows.select(clean_ws("s").alias("a")).select("a", clean_ws("a").alias("b")).collect()
    assert all(a == b for a, b in once)


@pytest.mark.parametrize(
    ("region", "country", "code"),
    [
        ("California", "us", "CA"), (" ny ", "US", "NY"), ("district OF columbia", "US", "DC"),
        ("Puerto Rico", "US", "PU"), ("Calif.", "US", "CA"), ("Ontario", "CA", "ONTARIO"),
        ("x", None, "X"), (None, "US", ""), ("", "US", ""), ("new  york", "US", "NE"),
        ("ca", " US", "CA"),
    ],
)
def test_normalize_region(spark, region, country, code):
    rows = spark.createDataFrame([(region, country)], "r STRING, c STRING")
    assert rows.select(normalize_region("r", "c")).head()[0] == code


def test_all_states_by_name_and_code(spark):
    rows = spark.createDataFrame(list(US_STATES.items()), "n STRING, c STRING")
    got = rows.select("c", normalize_region("n", F.lit("US")), normalize_region("c", F.lit("US")))
    assert len(US_STATES) == 51
    assert all(a == b == c for a, b, c in got.collect())


def test_first_non_empty(spark):
    row = spark.createDataFrame([("", None, "x", "y")], "a STRING, b STRING, c STRING, d STRING")
    assert row.select(first_non_empty("a", "b", "c", "d")).head()[0] == "x"


RECORD = {
    "country_code": "US", "postal_code": "10003", "admin_area_1": "NY", "admin_area_2": None,
    "locality": "New York", "dependent_locality": "", "thoroughfare": "Rúe  Été", "premise": "5",
    "sub_premise": "unit 1",
}
RECORD_SCHEMA = ", ".join(f"{name} STRING" for name in RECORD)


def record(spark, **changes):
    return spark.createDataFrame([tuple({**RECORD, **changes}.values())], RECORD_SCHEMA)


def test_canonical_string_leaves_the_unit_out(spark):
    expected = "5 rue ete, new york, ny, 10003, us"
    for unit in ("unit 1", None, "é"):
        assert record(spark, sub_premise=unit).select(canonical_string()).head()[0] == expected


REASONS = [
    ({"country_code": "USA"}, "invalid country_code"),
    ({"country_code": None}, "invalid country_code"),
    ({"thoroughfare": "", "premise": None}, "missing thoroughfare_or_premise"),
    (
        {"locality": None, "admin_area_1": "", "postal_code": None, "dependent_locality": "x"},
        "missing locality_admin_or_postal",
    ),
    *[({name: "a" * 257}, f"{name}_too_long") for name in COMPONENTS],
    *[({name: "a\x07"}, f"{name}_has_control_chars") for name in COMPONENTS],
    ({"postal_code": "a\x07" * 200}, "postal_code_too_long"),
    ({"postal_code": "1234"}, "postal_code_shape_mismatch"),
    ({"admin_area_1": "New York"}, "admin_area_1_not_two_letter_state"),
    ({"thoroughfare": "--", "premise": "#"}, "empty_delivery_line_content"),
    ({"thoroughfare": "улица", "premise": None}, "empty_delivery_line_content"),
    ({"thoroughfare": "a\tb", "locality": "a" * 256}, None),
    ({"country_code": " us "}, None),
    ({"country_code": "CA", "postal_code": "k1a 0b1", "admin_area_1": "ontario"}, None),
    ({"country_code": "GB", "postal_code": "SW1A 1AA"}, None),
    ({"country_code": "NL", "postal_code": "1234ab"}, None),
    ({"country_code": "DE", "postal_code": "١٢٣٤٥"}, None),
    ({"country_code": "BR", "postal_code": "anything"}, None),
]


def test_rejection_reasons(spark):
    rows = [tuple({**RECORD, **changes}.values()) for changes, _ in REASONS]
    frame = spark.createDataFrame(
        [(i, *row) for i, row in enumerate(rows)], f"i INT, {RECORD_SCHEMA}"
    )
    got = {row.i: row.reason for row in frame.select("i", rejection_reason().alias("reason")).collect()}
    for i, (changes, reason) in enumerate(REASONS):
        assert got[i] == reason, changes


def test_trigrams_and_similarity(spark):
    row = spark.createDataFrame([("cat", "word", "two words", "")], "a STRING, b STRING, c STRING, d STRING")
    grams, score, empty = row.select(
        trigrams("a"), trigram_similarity("b", "c"), trigram_similarity("d", "d")
    ).head()
    assert sorted(grams) == ["  c", " ca", "at ", "cat"]
    assert score == pytest.approx(4 / 11)
    assert empty == 0.0


def test_token_positions(spark):
    row = spark.createDataFrame([("Été, 5th-St",)], "a STRING")
    assert [tuple(t) for t in row.select(token_positions("a")).head()[0]] == [
        ("été", 1), ("5th", 2), ("st", 3),
    ]
