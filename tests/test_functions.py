"""Column functions on edge values."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from saleweft.functions import dates, nulls, rates, text, typed


def one(frame, kind, value, expression):
    return frame(f"v {kind}", (value,)).select(expression).first()[0]


@pytest.mark.parametrize("rate, expected", [(-2.0, 0.5), (0.0, 0.0), (1.0, 1.0), (None, None)])
def test_signed_rate(frame, rate, expected):
    assert one(frame, "double", rate, rates.signed_rate("v")) == expected


@pytest.mark.parametrize("value, expected", [
    ("/1,25", 0.8), ("1,25", 1.25), ("2", 2.0), ("/0", None), ("x", None), (None, None)])
def test_text_rate(frame, value, expected):
    assert one(frame, "string", value, rates.text_rate("v")) == expected


def test_coalesce_zero(frame, rows):
    df = frame("a double, b double", (None, 2.0), (0.0, 3.0), (1.0, 4.0), (None, 0.0), (0.0, None))
    assert [r[0] for r in df.select(nulls.coalesce_zero("a", "b")).collect()] == [
        2.0, 3.0, 1.0, 0.0, 0.0]


def test_coalesce_blank(frame):
    df = frame("a string, b string", (None, "x"), (" ", "x"), ("", "x"), ("y", "x"))
    assert [r[0] for r in df.select(nulls.coalesce_blank("a", "b")).collect()] == ["x", "x", "x", "y"]


@pytest.mark.parametrize("value, width, expected", [
    ("66-J0", None, "66J0"), ("7", 2, "07"), (" - ", 2, None), ("", None, None), (None, 2, None),
    ("123", 2, "123")])
def test_clean_code(frame, value, width, expected):
    assert one(frame, "string", value, text.clean_code("v", width)) == expected


@pytest.mark.parametrize("name", [
    "Natural Oil Qty (g) [26529]", "R&D Tree", "SKU [item_id]", "Max. Load", "a__b", "Énergie (kWh)"])
def test_standard_name_in_python_and_on_spark_agree(frame, name):
    assert one(frame, "string", name, text.standard_name_column("v")) == text.standard_name(name)


def test_standard_name():
    assert text.standard_name("Natural Oil Qty (g) [26529]") == "Natural_Oil_Qty_g"
    assert text.standard_name("Natural Oil. [1]", keep_brackets=True) == "Natural Oil [1]"


def test_keys_skip_or_spread_nulls(frame):
    df = frame("a string, b string", ("x", None))
    row = df.select(text.make_key("|", "a", "b"), text.strict_key("|", "a", "b")).first()
    assert tuple(row) == ("x", None)


def test_split_part_outside_is_null(frame):
    assert one(frame, "string", "a_b", text.split_part("v", "_", 5)) is None


@pytest.mark.parametrize("label, following", [("2024Q1", "2024Q2"), ("2024Q4", "2025Q1")])
def test_next_quarter(frame, label, following):
    assert one(frame, "string", label, dates.next_quarter_label(F.col("v"))) == following


def test_serial_day_and_fiscal_year(frame):
    assert one(frame, "string", "1900-01-01", dates.serial_day(F.col("v").cast("date"))) == 2
    assert one(frame, "string", "FY24", dates.fiscal_year("v")) == 2024
    assert one(frame, "string", "FYxx", dates.fiscal_year("v")) is None


@pytest.mark.parametrize("kind, value, expected", [
    ("Number", "12.50", "12.5"), ("Number", "n/a", None), ("Date", "2024-02-30", None),
    ("Date", "2024-02-03", "2024-02-03"), ("Array", "a~b", "a; b"), ("Array", "a", "a"),
    (None, "x", "x")])
def test_typed_value(frame, kind, value, expected):
    df = frame("v string, k string", (value, kind))
    assert df.select(typed.typed_value("v", "k")).first()[0] == expected
