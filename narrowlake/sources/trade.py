"""Trade and event tables read as filings.

Each relation is a projection of one table, so a query over it scans that table
once, reads only the columns it needs and shuffles only for its own operator.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from narrowlake.model import COLLECTIONS, ENTITY, KV


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _text(column: Column | str) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return column.cast("string")


SERIES = "CASE l_returnflag WHEN 'A' THEN 'FRY9C' WHEN 'N' THEN 'FRY15' ELSE 'FR2004A' END"
ITEM = "concat('ITEM', l_linenumber)"


def _month(day: str) -> str:
    return f"cast(year({day}) * 100 + month({day}) as string)"


def line_columns(item: str = ITEM, series: str = SERIES) -> dict[str, str]:
    """Narrow columns over ``lineitem``, as SQL text.

    Quarter-end filings of suppliers, submitted monthly; a submission may arrive
    in two ingests.  Some codes, values and contexts are missing on purpose.
    """
    shipped = "cast(l_shipdate as date)"
    is_open, discounted, taxed = "l_linestatus = 'O'", "l_discount > 0.05D", "l_tax > 0.04D"
    return {
        "seriesid": series,
        "aod": f"concat(year({shipped}), CASE quarter({shipped}) WHEN 1 THEN '0331' "
        "WHEN 2 THEN '0630' WHEN 3 THEN '0930' ELSE '1231' END)",
        "rssdid": "cast(l_suppkey as string)",
        "submission_ts": _month(shipped),
        "item_mdrm": f"CASE WHEN l_linenumber = 7 AND l_quantity = 50 THEN null ELSE {item} END",
        "item_desc": "concat('Line, item ', l_linenumber)",
        "item_value": "CASE WHEN l_quantity != 13 THEN cast(cast(l_quantity as bigint) as string) END",
        "context_level1_mdrm": f"if({is_open}, 'CTX1', '')",
        "context_level1_desc": f"if({is_open}, 'Open line', '')",
        "context_level1_value": f"if({is_open}, cast(l_partkey % 2 as string), '')",
        "context_level2_mdrm": f"if({discounted}, 'CTX2', null)",
        "context_level2_desc": f"if({discounted}, 'Discounted', null)",
        "context_level2_value": "CASE WHEN l_partkey % 5 != 0 THEN cast(l_partkey % 5 as string) END",
        "context_level3_mdrm": f"if({taxed}, 'CTX3', '')",
        "context_level3_desc": f"if({taxed}, 'Taxed', '')",
        "context_level3_value": "cast(l_partkey % 3 as string)",
        "ingest_timestamp": _month(f"date_add({shipped}, 20)"),
    }


def _selected(columns: dict[str, str], *names: str) -> list[str]:
    return [f"{columns[name]} AS {name}" for name in names]


def collections(
    spark: SparkSession, folder: str, item: str = ITEM, series: str = SERIES
) -> DataFrame:
    """Narrow rows in the current schema."""
    names = (*COLLECTIONS.columns, COLLECTIONS.ingest)
    lines = read_table(spark, folder, "lineitem")
    return lines.selectExpr(*_selected(line_columns(item, series), *names))


def coded_collections(spark: SparkSession, folder: str, n_codes: int) -> DataFrame:
    """The same rows with many item codes, spread over the parts."""
    return collections(
        spark, folder, f"concat('M', lpad(cast(l_partkey % {n_codes} as string), 5, '0'))"
    )


def raw_collections(spark: SparkSession, folder: str) -> DataFrame:
    """The rows before validation: some series missing, blank or unknown."""
    damaged = f"""CASE l_quantity WHEN 1 THEN null WHEN 2 THEN '' WHEN 3 THEN '  '
        WHEN 4 THEN concat('X', {SERIES}) WHEN 5 THEN concat({SERIES}, 'X') ELSE {SERIES} END"""
    return collections(spark, folder, series=damaged)


def kv(spark: SparkSession, folder: str) -> DataFrame:
    """Key/value rows over ``events``, values as numbers."""
    number = F.get_json_object("props", "$.k").cast("int")
    return (
        read_table(spark, folder, "events")
        .select(
            F.col("event_type").alias("seriesid"),
            F.date_format("ts", "yyyyMMdd").alias("aod"),
            _text("user_id").alias("rssdid"),
            F.date_format("ts", "yyyyMMddHH").alias("submissionts"),
            F.concat(
                F.when(number % 2 == 0, "RCON").otherwise("RCFD"),
                F.lpad(_text(F.floor(number / 10)), 4, "0"),
            ).alias("key"),
            F.col("value"),
            F.date_format("ts", "yyyyMMdd").alias("ingest_timestamp"),
        )
        .select(*KV.columns, KV.ingest)
    )


def entity(spark: SparkSession, folder: str) -> DataFrame:
    """Entity rows over ``orders``; the second attribute may be missing."""
    return (
        read_table(spark, folder, "orders")
        .select(
            F.col("o_orderstatus").alias("entity1"),
            F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED")).alias("entity2"),
            _text("o_custkey").alias("entity3"),
            F.date_format("o_orderdate", "yyyyMM").alias("entity4"),
            F.concat(F.lit("key_"), _text(F.col("o_orderkey") % 10)).alias("key"),
            F.concat(F.lit("value_"), _text("o_orderkey")).alias("value"),
        )
        .select(*ENTITY.columns)
    )


def items(spark: SparkSession, folder: str) -> DataFrame:
    """Items of filings as the report of items has them; an order is a filing."""
    columns = {
        **line_columns(),
        "filing_id": "cast(l_orderkey as string)",
        "submission_datetime": "date_format(l_shipdate, 'yyyy-MM-dd HH:mm:ss')",
        "filing_status": "l_linestatus",
        "estimated_flag": "if(l_quantity = 13, 'Y', 'N')",
        "estimated_by": "if(l_quantity = 13, 'estimate', null)",
    }
    del columns["submission_ts"], columns["ingest_timestamp"]
    names = {
        "seriesid": "series_id",
        "aod": "as_of_date",
        "rssdid": "rssd_id",
        "item_desc": "item_description",
    }
    rows = read_table(spark, folder, "lineitem").selectExpr(*_selected(columns, *columns))
    return rows.withColumnsRenamed(names)


def schedule(spark: SparkSession, folder: str) -> DataFrame:
    """Schedules of filings, one per order."""
    return read_table(spark, folder, "orders").select(
        _text("o_orderkey").alias("filing_id"), F.col("o_orderpriority").alias("schedule_id")
    )


def dictionary(spark: SparkSession, folder: str) -> DataFrame:
    """One described item per part; the context's code, name and value are fixed values of the format."""
    return read_table(spark, folder, "part").select(
        F.concat(F.lit("P"), F.lpad(_text("p_partkey"), 9, "0")).alias("item_mdrm"),
        F.col("p_name").alias("item_desc"),
        F.when(F.col("p_size") > 25, "GSWA0001").otherwise("").alias("context_level1_mdrm"),
        F.when(F.col("p_size") > 25, "Long  1").otherwise("").alias("context_level1_desc"),
        F.when(F.col("p_size") > 25, "1").otherwise("").alias("context_level1_value"),
    )


def document_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Whole documents as item values: long text with line breaks and quotes.

    Series, dates and times are fixed values in the form that drops have.
    """
    return (
        read_table(spark, folder, "documents")
        .withColumns({c: F.lit("") for c in COLLECTIONS.columns})
        .withColumns(
            {
                "seriesid": F.lit("FRY9C"),
                "aod": F.lit("20241231"),
                "rssdid": F.col("source"),
                "submission_ts": F.lit("1740000002"),
                "item_mdrm": _text("doc_id"),
                "item_desc": F.col("lang"),
                "item_value": F.col("text"),
                "ingest_timestamp": F.concat(F.lit("17400000"), F.lpad(_text(F.length("lang")), 2, "0")),
            }
        )
        .select(*COLLECTIONS.columns, COLLECTIONS.ingest)
    )
