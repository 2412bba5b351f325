import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from predia.fixed_values import DOCUMENT_TYPES, PROPERTY_STATUS, SERVICE_STATUS
from predia.functions import (
    chosen_by_class, clock_text, days_since, decode, first_positive, fold_accents, grouped_code, is_known_flag,
    one_of_flag, or_constant, pad_city_code, parse_time, part_of, presence_flag, price_per_unit, slug, state_code,
    to_area, to_int, yes_no,
)


def values(spark, data, schema, expression):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expression).collect()]


def texts(spark, data, expression):
    return values(spark, [(v,) for v in data], "v string", expression)


def test_city_codes_of_three_four_and_five_characters(spark):
    assert texts(spark, ["800", "5001", "11001", None], pad_city_code(F.col("v"))) == ["800", "05001", "11001", None]
    assert texts(spark, ["05001", None], state_code(F.col("v"))) == ["05", None]


def test_slug_trims_or_not_and_folds_only_five_vowels(spark):
    assert texts(spark, [" La Peña Ñú ", None], slug(F.col("v"))) == ["la-peña-ñú", None]
    assert texts(spark, [" A b"], slug(F.col("v"), trimmed=False)) == ["-a-b"]
    assert texts(spark, ["áéíóúñüÁ"], fold_accents(F.col("v"))) == ["aeiouñüÁ"]
    assert texts(spark, [None, "x"], or_constant(F.col("v"), "home")) == ["home", "x"]


def test_part_of_a_code_without_separator_is_null(spark):
    assert texts(spark, ["PY1-A", "PY1", "a-b-c", None], part_of(F.col("v"), 1)) == ["A", None, "b", None]


def test_decode_compares_numbers_and_text_alike(spark):
    assert values(spark, [(0,), (4,), (9,), (None,)], "v int", decode(F.col("v"), *PROPERTY_STATUS)) == [
        "Activo", "Repetido", "Otro", "Otro"]
    assert texts(spark, ["0", "1", None], decode(F.col("v"), *SERVICE_STATUS)) == ["Inactivo", "Activo", "No"]


@pytest.mark.parametrize("spelling, code", [(s, c) for c, group in DOCUMENT_TYPES.items() for s in group])
def test_every_document_spelling(spark, spelling, code):
    assert texts(spark, [spelling], grouped_code(F.col("v"), DOCUMENT_TYPES)) == [code]


def test_unknown_document_type_stays(spark):
    assert texts(spark, ["XX", None], grouped_code(F.col("v"), DOCUMENT_TYPES)) == ["XX", None]


def test_flags(spark):
    flags = ["0", "1", "true", "false", "TRUE", "x", None]
    assert texts(spark, flags, yes_no(F.col("v"))) == ["No", "Si", "Si", "No", "No", "No", "No"]
    assert texts(spark, ["0", "gas", "1", "", None], is_known_flag(F.col("v"))) == ["No", "Si", "Si", "Si", "No"]
    assert values(spark, [(0,), (1,), (2,), (3,), (None,)], "v int", one_of_flag(F.col("v"), ["1", "2"])) == [
        "No", "Si", "Si", "No", "No"]
    both = [(None, None), ("a", None), (None, "b")]
    assert values(spark, both, "a string, b string", presence_flag(F.col("a"), F.col("b"))) == ["No", "Si", "Si"]


def test_first_positive_falls_back_to_the_first(spark):
    data = [(5, 9, 9), (0, 0, 7), (0, 8, 7), (0, 0, 0), (-3, 0, 0)]
    expression = first_positive(F.col("a"), F.col("b"), F.col("c"))
    assert values(spark, data, "a int, b int, c int", expression) == [5, 7, 8, 0, -3]


def test_chosen_by_class(spark):
    data = [("P", "id", "tax"), ("C", "id", "tax"), (None, "id", "tax"), ("P", None, "tax")]
    expression = chosen_by_class(F.col("k"), "P", F.col("a"), F.col("b"))
    assert values(spark, data, "k string, a string, b string", expression) == ["id", "tax", None, None]


def test_numbers_that_are_none(spark):
    assert texts(spark, ["3", "3.9", "-3.9", "", "x", "99999999999", None], to_int(F.col("v"))) == [
        3, 3, -3, None, None, None, None]
    assert texts(spark, ["-2.5", None], to_area(F.col("v"))) == [Decimal("2.5000"), Decimal("0.0000")]


def test_price_per_unit_rounds_half_up_and_survives_zero(spark):
    data = [("100", "3"), ("0.05", "2"), ("10", "0"), (None, "2"), ("abc", "2")]
    assert values(spark, data, "p string, u string", price_per_unit(F.col("p"), F.col("u"))) == [
        Decimal("33.33"), Decimal("0.03"), None, None, None]


def test_times(spark):
    moment = dt.datetime(2024, 5, 1, 10, 20, 30)
    forms = ["2024-05-01 10:20:30", "2024-05-0110:20:30.000+0000", "never", "", None]
    assert texts(spark, forms, parse_time(F.col("v"))) == [moment, moment, None, None, None]
    assert values(spark, [(moment,)], "v timestamp", parse_time(F.col("v"))) == [moment]
    assert values(spark, [(moment,)], "v timestamp", days_since(F.lit("2024-06-30").cast("date"), F.col("v"))) == [60]
    assert values(spark, [(moment,)], "v timestamp", clock_text(F.col("v"))) == ["2024-05-01 05:20:30"]


def test_initcap_splits_on_blanks_only(spark):
    assert texts(spark, ["ANA-maría del río", None], F.initcap("v")) == ["Ana-maría Del Río", None]
