"""Pivots: worked examples, rules for odd rows, and agreement of the forms."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from narrowlake.model import COLLECTIONS, ENTITY, KV
from narrowlake.operators import pivots, quality, sets

FORMS = ["case", "block"]
KV_SCHEMA = "seriesid string, aod string, rssdid string, submissionts string, key string, value string"


def collections(spark, rows):
    """Rows of (series, aod, rssdid, submission, item, value, level-1 code, level-1 value)."""
    schema = ", ".join(
        f"{c} string"
        for c in (*COLLECTIONS.keys, "item_mdrm", "item_value", "context_level1_mdrm", "context_level1_value")
    )
    frame = spark.createDataFrame(rows, schema)
    for c in COLLECTIONS.columns:
        if c not in frame.columns:
            frame = frame.withColumn(c, F.lit(None).cast("string"))
    return frame.select(*COLLECTIONS.columns)


def filing(item, value, code=None, context=None, submission="1", aod="20230131"):
    return ("FRY9C", aod, "1", submission, item, value, code, context)


@pytest.mark.parametrize("form", FORMS)
def test_worked_example(spark, form):
    key = ("fry9c", "2024-03-31", "123456", "1711900800")
    rows = [(*key, "RCON2170", "50000"), (*key, "RCON0010", "25000"), (*key, "RCON2200", "75000")]
    wide = pivots.pivot_kv(spark.createDataFrame(rows, KV_SCHEMA), "fry9c", form=form)
    assert wide.columns == [*KV.keys, "RCON0010", "RCON2170", "RCON2200"]
    assert [tuple(r) for r in wide.collect()] == [(*key, "25000", "50000", "75000")]


@pytest.mark.parametrize("form", FORMS)
def test_largest_text_wins_and_largest_number_wins(spark, form):
    rows = [filing("A", "9"), filing("A", "10")]
    assert pivots.pivot_encoded(collections(spark, rows), form=form).first().A == "9"
    numbers = spark.createDataFrame(
        [("s", "a", "r", "t", "K", 9.0), ("s", "a", "r", "t", "K", 10.0)],
        KV_SCHEMA.replace("value string", "value double"),
    )
    assert pivots.pivot_kv(numbers, form=form).first().K == 10.0


@pytest.mark.parametrize("form", FORMS)
def test_filing_without_values_and_without_codes_keeps_its_row(spark, form):
    rows = [filing("A", None), filing(None, "5", submission="2"), filing("A", "7", submission="3")]
    wide = pivots.pivot_encoded(collections(spark, rows), form=form)
    assert sorted((r.submission_ts, r.A) for r in wide.collect()) == [("1", None), ("2", None), ("3", "7")]


@pytest.mark.parametrize("form", FORMS)
def test_filing_ingested_twice_is_one_row_unless_asked(spark, form):
    once = collections(spark, [filing("A", "1"), filing("B", "2")]).withColumn("ingest_timestamp", F.lit("1"))
    rows = once.unionByName(once.withColumn("ingest_timestamp", F.lit("2")))
    assert pivots.pivot_encoded(rows, form=form).count() == 1
    assert pivots.pivot_encoded(rows, extra_keys=["ingest_timestamp"], form=form).count() == 2


@pytest.mark.parametrize("form", FORMS)
def test_chosen_items_keep_all_filings(spark, form):
    rows = [filing("A", "1"), filing("B", "2", submission="2")]
    wide = pivots.pivot_encoded(collections(spark, rows), items=["B", "Z"], form=form)
    assert sorted((r.submission_ts, r.B, r.Z) for r in wide.collect()) == [("1", None, None), ("2", "2", None)]


@pytest.mark.parametrize("form", FORMS)
def test_context_columns_are_independent_maxima(spark, form):
    rows = [filing("A", "1", "X", "1"), filing("B", "2", "W", "9")]
    got = pivots.pivot_items_with_context(collections(spark, rows), form=form).first()
    assert (got.A, got.B, got.context_level1_mdrm, got.context_level1_value) == ("1", "2", "X", "9")


@pytest.mark.parametrize("form", FORMS)
def test_composite_columns(spark, form):
    rows = [filing("A", "1", "X", "1"), filing("A", "2", "X", "2"), filing("A", "3"), filing("B", "4", "X", "1")]
    wide = pivots.pivot_composite(collections(spark, rows), form=form)
    assert wide.columns[4:] == ["A", "A_CTX1", "A_CTX2", "B_CTX1"]
    assert tuple(wide.first())[4:] == ("3", "1", "2", "4")


@pytest.mark.parametrize("form", FORMS)
def test_codes_may_hold_any_character(spark, form):
    codes = ["a.b", "it's", "back`tick", "sp ace", "q\"uote", "ünï", ""]
    rows = [filing(c, str(n)) for n, c in enumerate(codes)]
    wide = pivots.pivot_encoded(collections(spark, rows), form=form)
    assert wide.first().asDict() | {} == {
        "seriesid": "FRY9C", "aod": "20230131", "rssdid": "1", "submission_ts": "1",
        **{c: str(n) for n, c in enumerate(codes)},
    }


def test_codes_that_differ_by_case_are_refused(spark):
    with pytest.raises(pivots.PivotError, match="told apart"):
        pivots.pivot_encoded(collections(spark, [filing("Ab", "1"), filing("aB", "2")]))
    with pytest.raises(pivots.PivotError, match="told apart"):
        pivots.pivot_encoded(collections(spark, [filing("AOD", "1")]))


def test_more_codes_than_columns_are_refused(spark):
    rows = collections(spark, [filing(f"C{n}", "1") for n in range(6)])
    old = spark.conf.get("spark.sql.pivotMaxValues")
    spark.conf.set("spark.sql.pivotMaxValues", "5")
    try:
        for call in (
            lambda: pivots.pivot_encoded(rows),
            lambda: pivots.discover_items(rows),
            lambda: pivots.pivot_encoded(rows, items=[f"C{n}" for n in range(6)], form="block"),
        ):
            with pytest.raises(pivots.PivotError):
                call()
    finally:
        spark.conf.set("spark.sql.pivotMaxValues", old)


def test_items_by_series(spark):
    rows = [filing("B", "1"), filing("A", "1"), filing("A", "2"), filing(None, "2")]
    rows.append(("FRY15", "d", "1", "1", None, "1", None, None))
    frame = collections(spark, rows)
    assert pivots.discover_items(frame) == {"FRY15": [], "FRY9C": ["A", "B"]}
    found = {r.seriesid: r["items"] for r in pivots.items_by_series(frame).collect()}
    assert found == {"FRY15": [], "FRY9C": ["A", "B"]}


def test_groups_of_codes(spark):
    rows = [filing("BHCK1", "1"), filing("BHCK2", "2"), filing("BHDM1", "3")]
    wide, groups = pivots.pivot_by_group(collections(spark, rows))
    assert groups == {"BHCK": ["BHCK1", "BHCK2"], "BHDM": ["BHDM1"]}
    assert wide.columns[4:] == ["BHCK1", "BHCK2", "BHDM1"] and wide.count() == 1


@pytest.mark.parametrize("form", ["case", "block"])
def test_codes_of_any_type(spark, form):
    frame = spark.createDataFrame([("a", 7, 1.0), ("a", 7, 2.0), ("b", 12, 3.0)], "k string, code int, v double")
    codes = pivots.discover_codes(frame, "code")
    assert codes == ["12", "7"]
    wide = pivots.pivot(frame, F.col("v"), codes, keys=["k"], item="code", form=form)
    assert sorted((r.k, r["7"], r["12"]) for r in wide.collect()) == [("a", 2.0, None), ("b", None, 3.0)]


def test_custom_pivot(spark):
    rows = [("e1", "x", "c", "d", "k1", "1"), ("e1", None, "c", "d", "k1", "2"), ("e1", "x", "c", "f", "k2", "3")]
    frame = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in ENTITY.columns))
    wide = pivots.pivot_custom(
        frame, F.col("value"), keys=["entity1"], item="key", items=["k1", "k2"],
        where=F.col("entity2").isNotNull(), extra_columns={"created_at": F.current_timestamp()},
    )
    row = wide.first()
    assert (row.entity1, row.k1, row.k2) == ("e1", "1", "3") and row.created_at is not None


ROW = st.tuples(
    st.sampled_from(["FRY9C"]),
    st.sampled_from(["d1", "d2", None]),
    st.sampled_from(["1", "2"]),
    st.sampled_from(["1", "2", None]),
    st.sampled_from(["A", "B", "C", "D", None]),
    st.one_of(st.none(), st.text("0123456789", max_size=3)),
    st.sampled_from([None, "", "X", "Y"]),
    st.sampled_from([None, "", "1", "2"]),
)


@settings(max_examples=6, deadline=None)
@given(st.lists(ROW, min_size=1, max_size=60))
def test_forms_agree_and_unpivot_undoes(spark, rows):
    frame = collections(spark, rows)
    codes = ["A", "B", "C", "D"]
    case = pivots.pivot_encoded(frame, items=codes, form="case")
    block = pivots.pivot_encoded(frame, items=codes, form="block")
    assert sets.compare_outputs(case, block).isEmpty()
    cells = frame.select(*COLLECTIONS.keys, "item_mdrm", pivots.encode_cell().alias("cell"))
    largest = cells.groupBy(*COLLECTIONS.keys, "item_mdrm").agg(F.max("cell").alias("cell"))
    largest = largest.where("item_mdrm IS NOT NULL AND cell IS NOT NULL")
    back = pivots.unpivot(case, COLLECTIONS.keys, item="item_mdrm", value="cell")
    assert sets.compare_outputs(largest, back).isEmpty()
    assert quality.filing_row_check(block, frame).isEmpty()


@pytest.mark.parametrize("width", [1, 127, 128, 129, 300])
def test_block_form_at_block_edges(spark, width):
    rows = [filing(f"C{n:04d}", str(n), submission=str(n % 3)) for n in range(width)]
    frame = collections(spark, rows)
    case = pivots.pivot_encoded(frame, form="case")
    block = pivots.pivot_encoded(frame, form="block")
    assert case.columns == block.columns
    assert sets.compare_outputs(case, block).isEmpty()


def test_hot_filing_is_cut_down_before_its_rows_meet(spark):
    """A third of all rows in one cell: the shuffle carries one row per task and cell."""
    rows = spark.range(0, 300_000, numPartitions=8).select(
        F.lit("FRY9C").alias("seriesid"),
        F.lit("d").alias("aod"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("rssdid"),
        F.lit("1").alias("submissionts"),
        F.concat(F.lit("K"), (F.col("id") % 50).cast("string")).alias("key"),
        F.col("id").cast("string").alias("value"),
    )
    hot = pivots.pivot_kv(rows.where("rssdid = 'hot'"), form="block")
    assert hot.count() == 1
    wide = pivots.pivot_kv(rows, form="block")
    assert wide.count() == 200_001
    expected = rows.where("rssdid = 'hot' AND key = 'K3'").agg(F.max("value")).first()[0]
    assert wide.where("rssdid = 'hot'").first().K3 == expected


def test_wide_block_form_gathers_one_list_per_filing(spark):
    rows = spark.createDataFrame(
        [("k1", "C000", "a"), ("k1", "C000", "b"), ("k1", "C299", "z"), ("k1", "C150", None), ("k1", "other", "x"),
         ("k2", None, "q"), ("k3", "C298", "y"), (None, "C001", "n")],
        "k string, code string, v string",
    )
    codes = [f"C{n:03}" for n in range(300)]
    wide, narrow = (
        pivots.pivot(rows, F.col("v"), codes, keys=["k"], item="code", form=form) for form in ("block", "case")
    )
    assert wide.columns == narrow.columns
    assert sorted(map(str, wide.collect())) == sorted(map(str, narrow.collect()))
    numbers = pivots.pivot(rows, F.length("v"), codes, keys=["k"], item="code", form="block")
    assert numbers.where("k = 'k1'").select("C000", "C150", "C299").first() == (1, None, 1)
    # However wide, a filing's cells are gathered once, not once for each block of columns.
    assert wide._jdf.queryExecution().optimizedPlan().toString().count("collect_list(") == 1


def test_blocks_of_columns_that_a_filing_has_no_cell_of_are_one_null(spark):
    edge = pivots.BLOCK_COLUMNS
    slots = {"k1": [0], "k2": [edge - 1, edge], "k3": [3 * edge - 1], "k4": [1, 3 * edge, 3 * edge + 1], "k5": []}
    rows = [(k, f"C{n:03}", f"{k}-{n}") for k, some in slots.items() for n in some] + [("k5", "other", "x"), (None, "C064", "n")]
    frame = spark.createDataFrame(rows, "k string, code string, v string")
    codes = [f"C{n:03}" for n in range(3 * edge + 2)]
    wide, narrow = (
        pivots.pivot(frame, F.col("v"), codes, keys=["k"], item="code", form=form) for form in ("block", "case")
    )
    assert wide.schema == narrow.schema
    assert sorted(map(str, wide.collect())) == sorted(map(str, narrow.collect()))
    # No array is made with a place for each column.
    assert "AS _blocks#" in wide._jdf.queryExecution().optimizedPlan().toString()
