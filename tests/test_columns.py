from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfmark.functions import columns as C
from shelfmark.functions.fields import field, has_field


def values(spark, inputs, expression, dtype="string"):
    rows = [(at, value) for at, value in enumerate(inputs)]
    df = spark.createDataFrame(rows, f"at int, v {dtype}")
    return [row[0] for row in df.orderBy("at").select(expression).collect()]


def test_safe_int_never_raises(spark):
    cases = {
        "2002": 2002,
        " 1999 ": 1999,
        "2002.0": 2002,
        "2002.": 2002,
        "+7": 7,
        "-3.9": -3,
        "1e3": None,
        "0": 0,
        "DK Publishing": None,
        "": None,
        "99999999999": None,
        "99999999999.5": None,
        None: None,
    }
    assert values(spark, list(cases), C.safe_int("v")) == list(cases.values())


def test_safe_double_takes_plain_decimals_only(spark):
    cases = {
        "51.77": 51.77,
        " 1 ": 1.0,
        ".5": 0.5,
        "5.": 5.0,
        "1e3": 1000.0,
        "-2.5": -2.5,
        "1.0d": None,
        "nan": None,
        "": None,
        "free": None,
        None: None,
    }
    assert values(spark, list(cases), C.safe_double("v")) == list(cases.values())


def test_trim_strips_spaces_and_strip_ws_all_whitespace(spark):
    padded = ["  a  ", "\t a \n", " a ", "\x1ca\x85", "a b"]
    assert values(spark, padded, F.trim("v"))[:2] == ["a", "\t a \n"]
    assert values(spark, padded, C.strip_ws("v")) == [text.strip() for text in padded]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet=" \t\n 　\x1fab", max_size=6), min_size=1, max_size=20))
def test_strip_ws_equals_python_strip(spark, texts):
    assert values(spark, texts, C.strip_ws("v")) == [text.strip() for text in texts]


def test_clean_price(spark):
    cases = {"£51.77": 51.77, "Â£51.77": 51.77, " £3 \n": 3.0, "free": None, "": None}
    assert values(spark, list(cases), C.clean_price("v")) == list(cases.values())


def test_rating_words(spark):
    words = ["One", "Two", "Three", "Four", "Five", "Six", None]
    assert values(spark, words, C.rating_from_word("v")) == [1, 2, 3, 4, 5, 0, 0]


def test_second_class_token(spark):
    classes = ["star-rating Three", "star-rating", " a  b ", None]
    assert values(spark, classes, C.token("v", 2)) == ["Three", None, "b", None]


def test_na_tokens(spark):
    texts = ["NA", "n/a", "", "null", "na", "x", None]
    assert values(spark, texts, C.null_if_in("v", C.NA_TOKENS)) == [
        None,
        None,
        None,
        None,
        "na",
        "x",
        None,
    ]


def test_array_text(spark):
    arrays = [["A", "B"], [], None, ["A", None]]
    assert values(spark, arrays, C.array_text("v"), "array<string>") == [
        "[A, B]",
        "[]",
        None,
        "[A, null]",
    ]


def test_batch_stamp(spark):
    moments = [datetime(2025, 1, 31, 23, 59, 58)]
    assert values(spark, moments, C.batch_stamp("v"), "timestamp_ntz") == ["20250131_235958"]


@pytest.mark.parametrize(
    ("body", "given", "value"),
    [
        ("{}", False, "none"),
        ('{"k": null}', True, None),
        ('{"k": "x"}', True, "x"),
        ('{"k": 3}', True, "3"),
    ],
)
def test_absent_field_differs_from_null(spark, body, given, value):
    parsed = F.try_parse_json("v")
    assert values(spark, [body], has_field(parsed, "$.k")) == [given]
    assert values(spark, [body], field(parsed, "$.k", "string", "none")) == [value]
