"""Cells and dates, one case per rule."""

import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from narrowlake.functions.cells import decode_cell, decode_regex, encode_cell
from narrowlake.functions.dates import as_date
from narrowlake.model import COLLECTIONS

CONTEXT = "context_level{}_mdrm string, context_level{}_value string"
SCHEMA = "item_value string, " + ", ".join(CONTEXT.format(n, n) for n in (1, 2, 3))


def cells(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA)
    return [r[0] for r in frame.select(encode_cell(COLLECTIONS)).collect()]


@pytest.mark.parametrize(
    "row, cell",
    [
        (("244360", "GSWA0001", "1", None, None, None, None), "GSWA0001=1:244360"),
        (("6382456", "", "", "", "", "", ""), "6382456"),
        (("6382456", None, None, None, None, None, None), "6382456"),
        (("5", "GSWA0001", None, None, None, None, None), "GSWA0001=:5"),
        ((None, "GSWA0001", "1", None, None, None, None), None),
        ((None, None, None, None, None, None, None), None),
        (("5", "A", "1", "B", "2", "C", "3"), "A=1:B=2:C=3:5"),
        (("5", "A", "1", "B", None, "", "3"), "A=1:B=:5"),
        (("5", "A", "1", None, "2", "C", "3"), "A=1:C=3:5"),
        (("5", None, "1", "B", "2", "C", "3"), "5"),
        (("5", "", "1", "B", "2", "C", "3"), "5"),
        (("", "A", "1", None, None, None, None), "A=1:"),
    ],
)
def test_encode(spark, row, cell):
    assert cells(spark, [row]) == [cell]


def test_typed_columns_become_text(spark):
    schema = SCHEMA.replace("item_value string", "item_value double").replace(
        "context_level1_value string", "context_level1_value int"
    )
    frame = spark.createDataFrame([(244361.0, "A", 1, None, None, None, None)], schema)
    assert frame.select(encode_cell()).first()[0] == "A=1:244361.0"


def test_documented_decoding(spark):
    frame = spark.createDataFrame(
        [("GSWA0001=1:244360",), ("244360",), ("A=1:-5",), ("A=1:1.5",), (None,)], "c string"
    )
    assert [tuple(r) for r in frame.select(*decode_regex("c", "x")).collect()] == [
        ("244360", "GSWA0001", "1"),
        ("", "", ""),
        ("", "A", "1"),
        ("", "A", "1"),
        (None, None, None),
    ]


def test_decoding_of_all_parts(spark):
    frame = spark.createDataFrame(
        [("A=1:B=:C=3:-1.5",), ("244360",), ("A=x=y:5",), ("A=:",), (None,)], "c string"
    )
    assert [tuple(r) for r in frame.select(*decode_cell("c", "x")).collect()] == [
        ("-1.5", "A", "1", "B", "", "C", "3"),
        ("244360", None, None, None, None, None, None),
        ("5", "A", "x=y", None, None, None, None),
        ("", "A", "", None, None, None, None),
        (None, None, None, None, None, None, None),
    ]


CODE = st.text("AB0", min_size=1, max_size=3)
TEXT = st.text("xyz9.- ", max_size=4)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(TEXT, st.lists(st.tuples(CODE, TEXT), max_size=3)), min_size=1, max_size=40))
def test_decoding_undoes_encoding(spark, filings):
    rows = []
    for value, levels in filings:
        flat = [part for level in levels for part in level]
        rows.append((value, *flat, *[None] * (6 - len(flat))))
    frame = spark.createDataFrame(rows, SCHEMA).select("*", encode_cell().alias("c"))
    for got in frame.select("*", *decode_cell("c", "x")).collect():
        assert got.x_value == got.item_value
        for n in (1, 2, 3):
            assert got[f"x_context{n}_mdrm"] == got[f"context_level{n}_mdrm"]
            assert got[f"x_context{n}_value"] == got[f"context_level{n}_value"]


def test_dates(spark):
    frame = spark.createDataFrame([("20230131",), ("2023-01-31",), ("aod_set1",), (None,)], "d string")
    day = datetime.date(2023, 1, 31)
    assert [r[0] for r in frame.select(as_date("d")).collect()] == [day, day, None, None]
