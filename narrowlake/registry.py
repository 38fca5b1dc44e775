"""Every operator as a query over the trade, event and document tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from narrowlake.functions.cells import decode_cell, decode_regex, encode_cell
from narrowlake.model import COLLECTIONS, ENTITY, KV, UNKNOWN_INGEST
from narrowlake.operators import aggregates as agg
from narrowlake.operators import filters as flt
from narrowlake.operators import joins, latest, pivots, quality, sets
from narrowlake.operators import projections as prj
from narrowlake.plans import derived, publish, refresh
from narrowlake.plans import ingest as loads
from narrowlake.session import work_dir
from narrowlake.sinks import tables as sink
from narrowlake.sources import csv as csv_source
from narrowlake.sources import files, trade
from narrowlake.sources import tables as table_source
from narrowlake.streaming import ingest as streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# One filing series and one day that exist in the tables of every size.
SERIES, OTHER_SERIES = "FRY9C", "FRY15"
QUARTER = "19981231"
INGEST = "199811"
KEYS = list(COLLECTIONS.keys)


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# ---------------------------------------------------------------- pivots


@query
def wide_encoded(spark, folder):
    return pivots.pivot_encoded(trade.collections(spark, folder), SERIES)


@query
def wide_encoded_multi(spark, folder):
    """All accepted series in one pass, the ingest time kept as a key."""
    rows = flt.valid_series(trade.collections(spark, folder))
    return pivots.pivot_encoded(rows, extra_keys=[COLLECTIONS.ingest])


@query
def wide_encoded_80(spark, folder):
    return _coded(spark, folder, 80)


@query
def wide_encoded_550(spark, folder):
    return _coded(spark, folder, 550)


@query
def wide_encoded_1900(spark, folder):
    return _coded(spark, folder, 1900)


def _coded(spark, folder, width):
    """A row for each filing with all its keys, a column for each of very many codes."""
    rows = trade.coded_collections(spark, folder, width)
    codes = pivots.discover_codes(rows, COLLECTIONS.item)
    return pivots.pivot(rows, encode_cell(), codes, keys=KEYS, item=COLLECTIONS.item)


@query
def wide_kv(spark, folder):
    return pivots.pivot_kv(trade.kv(spark, folder), "click")


@query
def wide_entity(spark, folder):
    return pivots.pivot_kv(trade.entity(spark, folder), "O", roles=ENTITY)


@query
def wide_items(spark, folder):
    return pivots.pivot_items(trade.collections(spark, folder), SERIES)


@query
def wide_items_ctx(spark, folder):
    return pivots.pivot_items_with_context(trade.collections(spark, folder), "FR2004A")


@query
def wide_composite(spark, folder):
    return pivots.pivot_composite(trade.collections(spark, folder), "FR2004A")


@query
def wide_api(spark, folder):
    return pivots.pivot_api(trade.kv(spark, folder), "purchase")


@query
def wide_by_group(spark, folder):
    """Groups of codes side by side, out of one pivot."""
    rows = trade.coded_collections(spark, folder, 160)
    wide, groups = pivots.pivot_by_group(rows, SERIES, prefix_length=4)
    return wide.select(*KEYS, *[c for codes in groups.values() for c in codes])


@query
def pivot_custom(spark, folder):
    return pivots.pivot_custom(
        trade.collections(spark, folder),
        encode_cell(),
        keys=["seriesid", "aod"],
        item="item_mdrm",
        items=["ITEM1", "ITEM3"],
        where=F.col("item_value").isNotNull(),
        extra_columns={"has_created_at": F.current_timestamp().isNotNull()},
    )


@query
def items_by_series(spark, folder):
    found = pivots.items_by_series(trade.collections(spark, folder))
    return found.select("seriesid", F.array_join("items", ",").alias("items"))


@query
def kept_codes(spark, folder):
    """Item codes by series as they are kept load by load."""
    path, rows = work_dir(spark, "codes"), trade.collections(spark, folder)
    for line in range(1, 8, 3):
        derived.merge_codes(rows.where(F.substring("item_mdrm", 5, 1).between(str(line), str(line + 2))), path)
    found = pivots.items_by_series(derived.read_codes(spark, path))
    return found.select("seriesid", F.array_join("items", ",").alias("items"))


@query
def unpivot_roundtrip(spark, folder):
    wide = pivots.pivot_encoded(trade.collections(spark, folder), SERIES)
    return pivots.unpivot(wide, KEYS, item="item_mdrm", value="cell")


# ---------------------------------------------------------------- rows and columns


@query
def all_data(spark, folder):
    return trade.collections(spark, folder)


@query
def one_series(spark, folder):
    return flt.by_series(trade.collections(spark, folder), OTHER_SERIES)


@query
def by_partition(spark, folder):
    return flt.by_partition(trade.collections(spark, folder), SERIES, INGEST)


@query
def by_key(spark, folder):
    return flt.by_key(trade.kv(spark, folder), "RCON0003")


@query
def by_aod(spark, folder):
    wide = pivots.pivot_encoded(trade.collections(spark, folder), SERIES)
    return flt.by_as_of(wide, QUARTER)


@query
def by_ingest(spark, folder):
    rows = flt.by_ingest(trade.collections(spark, folder), INGEST)
    return prj.first_rows(rows, 100, *COLLECTIONS.columns)


@query
def by_entity(spark, folder):
    return flt.by_columns(trade.entity(spark, folder), entity1="O", entity2="2-HIGH")


@query
def not_null_entity(spark, folder):
    rows = flt.not_null(trade.entity(spark, folder), "entity2")
    return pivots.pivot_kv(rows, "F", roles=ENTITY)


@query
def recent_days(spark, folder):
    summary = agg.daily_summary(trade.kv(spark, folder))
    return flt.recent_days(summary, "report_date", 30, date(2024, 2, 10))


@query
def recent_filings(spark, folder):
    rows = flt.recent_as_of(trade.collections(spark, folder), 100, date(2001, 12, 31))
    return agg.rows_by(rows, "seriesid", "report_date")


@query
def valid_series(spark, folder):
    return flt.valid_series(trade.raw_collections(spark, folder))


@query
def rejected_rows(spark, folder):
    return flt.rejected_rows(trade.raw_collections(spark, folder))


@query
def valid_discriminators(spark, folder):
    return flt.valid_discriminators(trade.raw_collections(spark, folder))


@query
def invalid_count(spark, folder):
    return agg.validity_counts(trade.raw_collections(spark, folder))


@query
def series_difference(spark, folder):
    return sets.series_difference(trade.raw_collections(spark, folder))


@query
def renamed_items(spark, folder):
    wide = pivots.pivot_items(trade.collections(spark, folder), SERIES)
    return prj.rename_items(
        flt.by_as_of(wide, QUARTER),
        ["aod", "rssdid"],
        {"ITEM1": "first_line", "ITEM2": "second_line"},
    ).orderBy("rssdid")


@query
def column_subset(spark, folder):
    wide = pivots.pivot_encoded(trade.collections(spark, folder), SERIES)
    return prj.select_items(wide, ["seriesid"], 5)


@query
def report_items(spark, folder):
    joined = joins.items_schedule_join(trade.items(spark, folder), trade.schedule(spark, folder))
    return prj.report_items(joined)


@query
def without_desc(spark, folder):
    return prj.without_desc(trade.collections(spark, folder))


@query
def first_rows(spark, folder):
    wide = pivots.pivot_encoded(trade.collections(spark, folder), SERIES)
    return prj.first_rows(wide, 10, *KEYS)


@query
def add_literal(spark, folder):
    return prj.add_literal(trade.entity(spark, folder), "ingest_timestamp", "20240229")


@query
def add_created_at(spark, folder):
    wide = pivots.pivot_encoded(trade.collections(spark, folder), SERIES)
    stamped = prj.add_created_at(wide)
    return stamped.select(*KEYS, F.col("created_at").isNotNull().alias("is_stamped"))


# ---------------------------------------------------------------- joins


@query
def cross_series_join(spark, folder):
    rows = trade.collections(spark, folder)
    return joins.cross_series_join(
        pivots.pivot_items(rows, SERIES),
        pivots.pivot_items(rows, OTHER_SERIES),
        left_columns={"seriesid": "fry9c_series", "ITEM1": "fry9c_value"},
        right_columns={"ITEM2": "fry15_value"},
        where=F.col("aod") == QUARTER,
    )


@query
def entity_view_join(spark, folder):
    rows = trade.entity(spark, folder)
    return joins.entity_view_join(
        pivots.pivot_kv(rows, "O", roles=ENTITY),
        pivots.pivot_kv(rows, "P", roles=ENTITY),
        on="entity3",
        left_columns=["entity1", "entity2", "key_1"],
        right_columns={"entity2": "other_entity2", "key_6": "other_key_6"},
    )


@query
def items_schedule_join(spark, folder):
    joined = joins.items_schedule_join(trade.items(spark, folder), trade.schedule(spark, folder))
    return joined.select("filing_id", "schedule_id", "item_mdrm", "item_value")


@query
def item_desc_lookup(spark, folder):
    rows = trade.collections(spark, folder)
    lines = trade.read_table(spark, folder, "lineitem").select("l_linenumber").distinct()
    number = F.col("l_linenumber").cast("string")
    names = lines.select(
        F.concat(F.lit("ITEM"), number).alias("item_mdrm"),
        F.concat(F.lit("Line number "), number).alias("item_desc"),
    )
    described = joins.item_desc_lookup(rows, names)
    return described.select(*KEYS, "item_mdrm", "item_desc", "item_value")


@query
def code_assignment(spark, folder):
    rows = trade.read_table(spark, folder, "orders").select("o_orderkey")
    codes = trade.read_table(spark, folder, "nation").select(F.col("n_name").alias("code"))
    return joins.assign_codes(rows, codes, row_id=F.col("o_orderkey"), order="code")


# ---------------------------------------------------------------- counts and summaries


@query
def total_rows(spark, folder):
    return agg.total_rows(trade.collections(spark, folder))


@query
def view_rows(spark, folder):
    return agg.total_rows(pivots.pivot_encoded(trade.collections(spark, folder), SERIES))


@query
def rows_by_series(spark, folder):
    return agg.rows_by(trade.collections(spark, folder), "seriesid")


@query
def rows_by_partition(spark, folder):
    return agg.rows_by(trade.collections(spark, folder), "seriesid", "ingest_timestamp")


@query
def rows_by_pair(spark, folder):
    return agg.rows_by(trade.entity(spark, folder), "entity1", "entity2").orderBy("entity1", "entity2")


@query
def rows_by_series_aod(spark, folder):
    wide = pivots.pivot_encoded(trade.collections(spark, folder), SERIES)
    return prj.first_rows(agg.rows_by(wide, "seriesid", "aod"), 5, "seriesid", "aod")


@query
def distinct_series(spark, folder):
    return agg.distinct_values(trade.collections(spark, folder), "seriesid")


@query
def distinct_items(spark, folder):
    return agg.distinct_items(trade.coded_collections(spark, folder, 550), SERIES)


@query
def distinct_ingests(spark, folder):
    return agg.distinct_values(trade.collections(spark, folder), "ingest_timestamp")


@query
def filing_summary(spark, folder):
    return agg.filing_summary(trade.collections(spark, folder), SERIES)


@query
def daily_summary(spark, folder):
    return agg.daily_summary(trade.kv(spark, folder))


@query
def distinct_rows(spark, folder):
    rows = trade.collections(spark, folder).select("seriesid", "rssdid", "item_mdrm", "item_desc")
    return agg.distinct_rows(rows)


@query
def refresh_summary(spark, folder):
    """A stored summary: built for all series, then rebuilt for one of them."""
    rows, path = trade.kv(spark, folder), work_dir(spark, "summary")
    refresh.refresh_summary(agg.daily_summary(rows.where("submissionts < '2024011500'")), path, KV)
    refresh.refresh_summary(agg.daily_summary(rows), path, KV, series=["click"])
    return spark.read.parquet(path)


@query
def kept_summary(spark, folder):
    """The daily summary, kept up load by load; one load comes twice, one is added up with the first."""
    path, rows = work_dir(spark, "summary-state"), trade.kv(spark, folder)
    late = F.col("submissionts") >= "2024011500"
    for load, part in (("a", rows.where(~late)), ("b", rows.where(late)), ("b", rows.where(late))):
        derived.merge_summary(part, path, load)
        if load == "a":
            derived.fold_loads(spark, path, ["a"])
    return derived.kept_summary(spark, path)


# ---------------------------------------------------------------- latest and as-of


@query
def latest_submission(spark, folder):
    return latest.latest_submission(
        trade.collections(spark, folder),
        tie_break=["item_value", "context_level1_value", "context_level2_value", "context_level3_value"],
    ).select(*KEYS, "item_mdrm", "item_value", "ingest_timestamp")


@query
def kept_latest(spark, folder):
    """The current state, kept up load by load; the second load comes twice."""
    path, rows = work_dir(spark, "latest"), trade.collections(spark, folder)
    early = F.col("ingest_timestamp") <= INGEST
    ties = ["item_value", "context_level1_value", "context_level2_value", "context_level3_value"]
    for part in (rows.where(~early), rows.where(early), rows.where(early)):
        derived.merge_latest(part, path, tie_break=ties)
    return derived.read_latest(spark, path).select(*KEYS, "item_mdrm", "item_value", "ingest_timestamp")


@query
def asof_ingest(spark, folder):
    return agg.rows_by(latest.as_of_ingest(trade.collections(spark, folder), INGEST), "seriesid")


# ---------------------------------------------------------------- cells


@query
def encoded_cells(spark, folder):
    return trade.collections(spark, folder).select(*KEYS, "item_mdrm", encode_cell().alias("cell"))


@query
def decode_regex_cells(spark, folder):
    wide = pivots.pivot_encoded(trade.collections(spark, folder), "FR2004A")
    return wide.select("seriesid", "aod", "rssdid", "ITEM1", *decode_regex("ITEM1", "item1"))


@query
def decode_cells(spark, folder):
    wide = pivots.pivot_encoded(trade.collections(spark, folder), "FR2004A")
    return wide.select(*KEYS, "ITEM1", *decode_cell("ITEM1", "item1"))


# ---------------------------------------------------------------- quality


@query
def compare_outputs(spark, folder):
    """The two pivot forms, one of them of a table that lost rows: what differs comes out."""
    rows = trade.collections(spark, folder)
    codes = pivots.discover_codes(flt.by_series(rows, SERIES), COLLECTIONS.item)
    damaged = rows.where("rssdid NOT LIKE '%7' OR item_mdrm <> 'ITEM1'")
    return sets.compare_outputs(
        pivots.pivot_encoded(rows, SERIES, items=codes, form="case"),
        pivots.pivot_encoded(damaged, SERIES, items=codes, form="block"),
    )


@query
def compare_by_checksum(spark, folder):
    """The same comparison by checksums of buckets of filings."""
    rows = trade.collections(spark, folder)
    codes = pivots.discover_codes(flt.by_series(rows, SERIES), COLLECTIONS.item)
    damaged = rows.where("rssdid NOT LIKE '%7' OR item_mdrm <> 'ITEM1'")
    return sets.compare_by_checksum(
        pivots.pivot_encoded(rows, SERIES, items=codes),
        pivots.pivot_encoded(damaged, SERIES, items=codes),
        KEYS,
    )


@query
def compare_ingests(spark, folder):
    """Rows that differ in number between the table and an earlier state of it."""
    rows = trade.collections(spark, folder).select("seriesid", "rssdid", "item_mdrm", "ingest_timestamp")
    return sets.compare_outputs(rows, latest.as_of_ingest(rows, "200105"))


@query
def duplicate_items(spark, folder):
    return quality.duplicate_items(trade.collections(spark, folder))


@query
def one_row_per_filing(spark, folder):
    """A wide relation that lost some filings and holds others twice."""
    rows = flt.by_series(trade.collections(spark, folder), SERIES)
    wide = pivots.pivot_encoded(rows)
    times = F.expr("CASE WHEN rssdid LIKE '%7' THEN 0 WHEN rssdid LIKE '%3' THEN 2 ELSE 1 END")
    damaged = wide.select("*", F.explode(F.array_repeat(F.lit(1), times))).drop("col")
    return quality.filing_row_check(damaged, rows)


@query
def no_unknown_ingest(spark, folder):
    """Rows whose files named no ingest time: those of one item here."""
    rows = trade.collections(spark, folder)
    lost = F.when(F.col("item_mdrm") == "ITEM7", UNKNOWN_INGEST).otherwise(F.col("ingest_timestamp"))
    return quality.unknown_ingest_count(rows.withColumn("ingest_timestamp", lost))


@query
def non_empty(spark, folder):
    """The guard lets a relation with rows pass as it is."""
    return quality.non_empty(trade.collections(spark, folder), "collections").select(*KEYS, "item_mdrm")


# ---------------------------------------------------------------- files and tables


def _once(build: Callable[[SparkSession, str], str]) -> Callable[[SparkSession, str], str]:
    """Build a stored input once per application and source folder."""
    made: dict[tuple[str, str], str] = {}

    def path_of(spark: SparkSession, folder: str) -> str:
        key = (spark.sparkContext.applicationId, folder)
        if key not in made:
            made[key] = build(spark, folder)
        return made[key]

    return path_of


@_once
def _drop(spark, folder):
    """The unvalidated rows as a CSV drop, one folder per ingest."""
    path = work_dir(spark, "drop")
    sink.write_csv_drop(trade.raw_collections(spark, folder), path)
    return path


def _new_database(spark):
    """A database of its own in the shared folder."""
    name = f"narrowlake_{uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{work_dir(spark, name)}'")
    return name


@_once
def _database(spark, folder):
    return _new_database(spark)


@_once
def _narrow_table(spark, folder):
    name = f"{_database(spark, folder)}.collections_data_tbl"
    sink.create_partitioned(
        trade.collections(spark, folder), name, properties={"layer": "narrow"}
    )
    return name


@_once
def _published(spark, folder):
    database, table = _new_database(spark), _narrow_table(spark, folder)
    publish.publish_wide(spark, table, database=database)
    return database


def _new_table(spark, folder, label):
    return f"{_database(spark, folder)}.{label}_{uuid4().hex[:8]}"


# Files of each kind that a drop may hold, one for each ingest time: text with a comma, a tab, a
# semicolon, or without any delimiter, which is refused.
ODD_LINE = """CASE month(to_date(ingest_ts, 'yyyyMM')) % 4 WHEN 0 THEN concat('seriesid,rows,', n)
    WHEN 1 THEN concat('seriesid\\trows\\t', n) WHEN 2 THEN concat('no delimiter ', n) ELSE concat('seriesid;rows;', n) END"""


@_once
def _odd_drop(spark, folder):
    """One file of one line for each ingest time, accepted or not, with the number of its rows in it."""
    path = work_dir(spark, "odd")
    rows = trade.collections(spark, folder).groupBy(F.col("ingest_timestamp").alias("ingest_ts"))
    lines = rows.agg(F.count(F.lit(1)).alias("n")).selectExpr("ingest_ts", f"{ODD_LINE} AS line")
    plain = {"sep": "\x01", "quote": "", "header": False, "lineSep": "\x02"}
    lines.repartition("ingest_ts").write.partitionBy("ingest_ts").options(**plain).csv(path)
    return path


@query
def file_manifest(spark, folder):
    """Every file of a drop, with its size."""
    found = files.file_manifest(spark, _odd_drop(spark, folder))
    return found.select(files.ingest_ts(F.col("path")).alias("ingest_ts"), "length")


@query
def csv_sniff(spark, folder):
    """Every file of a drop with its fingerprint, header and verdict; a quarter of them are not accepted."""
    found = files.csv_sniff(spark, _odd_drop(spark, folder))
    return found.select("ingest_ts", "length", "sample_md5", "header", "is_csv")


@query
def csv_strict(spark, folder):
    """All rows of the drop, accepted or not, each with the ingest time of its file."""
    rows = csv_source.read_csv_strict(spark, _drop(spark, folder))
    return csv_source.stamp_ingest(rows).drop(csv_source.SOURCE_FILE)


@query
def csv_first_file_stamp(spark, folder):
    """Every row stamped with the ingest time of the first file."""
    path = _drop(spark, folder)
    rows = csv_source.read_csv_strict(spark, path)
    stamped = csv_source.stamp_ingest(rows, mode="first_file", files=files.valid_files(spark, path))
    return agg.rows_by(stamped, "ingest_timestamp")


@query
def csv_plain(spark, folder):
    """Types found by inference."""
    rows = csv_source.read_csv_plain(spark, _drop(spark, folder))
    return rows.groupBy("item_mdrm").agg(
        F.count(F.lit(1)).alias("record_count"),
        F.sum(F.col("item_value").cast("bigint")).alias("total_value"),
    )


@query
def csv_roundtrip_ingest(spark, folder):
    """Drop to narrow table: listed, sniffed, read, stamped, validated, written."""
    table = _new_table(spark, folder, "loaded")
    loads.ingest(spark, _drop(spark, folder), table, reject_table=table + "_rejects")
    return spark.table(table).select(*COLLECTIONS.columns, COLLECTIONS.ingest)


@query
def csv_rejects(spark, folder):
    table = _new_table(spark, folder, "loaded")
    loads.ingest(spark, _drop(spark, folder), table, reject_table=table + "_rejects")
    return agg.rows_by(spark.table(table + "_rejects"), "seriesid", "reason")


@query
def csv_text_roundtrip(spark, folder):
    """Whole documents through CSV: line breaks, quotes and commas survive."""
    path = work_dir(spark, "documents")
    sink.write_csv_drop(trade.document_rows(spark, folder), path)
    rows = csv_source.read_csv_strict(spark, path)
    return rows.select(
        F.col("item_mdrm").cast("bigint").alias("doc_id"),
        F.col("item_desc").alias("lang"),
        F.col("item_value").alias("text"),
    )


@query
def parquet_roundtrip(spark, folder):
    path = work_dir(spark, "entity")
    sink.write_parquet(trade.entity(spark, folder), path)
    return table_source.scan_narrow(spark, path)


@query
def create_or_append(spark, folder):
    """Created from one half of the rows, the other half appended by name."""
    table = _new_table(spark, folder, "grown")
    rows = trade.collections(spark, folder)
    early = F.col("ingest_timestamp") <= INGEST
    sink.create_or_append(rows.where(early), table)
    late = rows.where(~early)
    sink.create_or_append(late.select(*reversed(late.columns)), table)
    return agg.rows_by(spark.table(table), "seriesid", "ingest_timestamp")


@query
def post_load_count(spark, folder):
    """Rows before a load, in the load, and after it."""
    table = _new_table(spark, folder, "counted")
    rows = trade.collections(spark, folder)
    late = F.col("ingest_timestamp") > INGEST
    sink.create_partitioned(rows.where(~late), table)
    before = spark.table(table).count()
    sink.append_batch(rows.where(late), table)
    return spark.table(table).agg(
        F.lit(before).alias("before_rows"),
        (F.count(F.lit(1)) - F.lit(before)).alias("batch_rows"),
        F.count(F.lit(1)).alias("after_rows"),
    )


@query
def ingest_new_only(spark, folder):
    """The drop loaded twice; the second run finds nothing new."""
    target, ledger = work_dir(spark, "narrow"), work_dir(spark, "ledger")
    drop = _drop(spark, folder)
    loads.load_new(spark, drop, target, ledger)
    if loads.load_new(spark, drop, target, ledger):
        raise AssertionError("the second load took files again")
    return loads.read_loaded(spark, target)


@query
def new_files(spark, folder):
    """Files that a ledger of the earlier ingests does not have as they are: later ones, and some
    of another length than written down there."""
    found = files.valid_files(spark, _odd_drop(spark, folder))
    then = F.when(F.col("ingest_ts") % 3 == 0, F.col("length") + 1).otherwise(F.col("length"))
    ledger = found.where(F.col("ingest_ts") <= INGEST).withColumn("length", then)
    return joins.new_files(found, ledger, ("path", "length")).select("ingest_ts", "length", "sample_md5")


@query
def load_long_headers(spark, folder):
    """A drop, packed by gzip, whose headers are several kilobytes long and hold a line break in quotes."""
    path, target, ledger = work_dir(spark, "long"), work_dir(spark, "narrow"), work_dir(spark, "ledger")
    rows = trade.raw_collections(spark, folder).select(*COLLECTIONS.columns, F.col("ingest_timestamp").alias("ingest_ts"))
    others = {f"column {n}, with a\nname of some length": F.lit(str(n)) for n in range(120)}
    # The rows move before they are wide.
    moved = sink.rebalanced(rows, ["ingest_ts"])
    wide = moved.select(*[v.alias(n) for n, v in others.items()], *rows.columns)
    with sink.open_files(spark):
        wide.write.partitionBy("ingest_ts").options(
            header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        ).csv(path, compression="gzip")
    loads.load_new(spark, path, target, ledger, gzip=True)
    return loads.read_loaded(spark, target)


@query
def compacted_loads(spark, folder):
    """The drop loaded in many batches, packed into larger files, loaded on and packed again."""
    path, target = work_dir(spark, "arriving"), work_dir(spark, "streamed")
    checkpoint, ledger = work_dir(spark, "checkpoint"), work_dir(spark, "ledger")
    rows = trade.raw_collections(spark, folder)
    late = F.coalesce(F.col("rssdid") % 2 == 0, F.lit(False))
    for arrived in (rows.where(~late), rows.where(late)):
        sink.write_csv_drop(arrived, path)
        found = streams.read_drop_stream(spark, path, max_files_per_trigger=60)
        streams.ingest_stream(found, target, checkpoint, ledger=ledger).awaitTermination()
        loads.compact_loads(spark, target, ledger)
    return loads.read_loaded(spark, target)


@query
def append_merge_schema(spark, folder):
    table = _new_table(spark, folder, "merged")
    rows = trade.collections(spark, folder).select("seriesid", "ingest_timestamp", "item_mdrm", "item_value")
    early = F.col("ingest_timestamp") <= INGEST
    sink.create_partitioned(rows.where(early), table)
    sink.append_merge_schema(rows.where(~early).withColumn("loader", F.lit("v2")), table)
    return agg.rows_by(spark.table(table), "seriesid", "loader")


@query
def evolve_schema(spark, folder):
    """A column added in place, another renamed by a rewrite."""
    table = _new_table(spark, folder, "evolved")
    sink.create_partitioned(
        trade.entity(spark, folder), table, partition_by=["entity1"], properties={"layer": "entity"}
    )
    sink.add_columns(spark, table, {"new_field": "string"})
    sink.rename_columns(spark, table, table + "_v2", {"value": "new_value"})
    return spark.table(table + "_v2").select("entity1", "entity2", "key", "new_value", "new_field")


@query
def ctas_verify(spark, folder):
    table = _new_table(spark, folder, "copied")
    path = work_dir(spark, "copied")
    sink.ctas_verify_counts(spark, _narrow_table(spark, folder), table, path=path)
    sink.rename_table(spark, table, table + "_final")
    return agg.rows_by(spark.table(table + "_final"), "seriesid")


@query
def upsert_wide(spark, folder):
    """A stored pivot of the early ingests, refreshed for the filings of the late ones."""
    path = work_dir(spark, "wide")
    rows = flt.by_series(trade.collections(spark, folder), SERIES)
    codes = pivots.discover_codes(rows, COLLECTIONS.item)
    early = latest.as_of_ingest(rows, INGEST)
    sink.store_wide(pivots.pivot_encoded(early, items=codes), path, partition_by=["aod"])
    late = rows.where(F.col("ingest_timestamp") > INGEST)
    changed = refresh.changed_filings(rows, late, SERIES)
    sink.upsert_wide(changed, path, keys=KEYS, partition_by=["aod"])
    wide = sink.read_stored(spark, path)
    return wide.select(*[F.col(c).cast("string").alias(c) for c in [*KEYS, *codes]])


@query
def drop_old_ingests(spark, folder):
    table = _new_table(spark, folder, "kept")
    sink.create_partitioned(trade.collections(spark, folder), table)
    sink.drop_old_ingests(spark, table, INGEST)
    return agg.rows_by(spark.table(table), "seriesid", "ingest_timestamp")


@query
def retained_wide(spark, folder):
    """Wide relations after the early ingests were dropped from the table and from them."""
    table, root = _new_table(spark, folder, "kept"), work_dir(spark, "wide")
    sink.create_partitioned(trade.collections(spark, folder), table)
    refresh.refresh_series(spark.table(table), root, [SERIES, OTHER_SERIES])
    derived.retain(spark, table, INGEST, root)
    return refresh.read_wide(spark, root, SERIES)


@query
def item_dictionary(spark, folder):
    path = work_dir(spark, "dictionary")
    trade.dictionary(spark, folder).write.options(header=True, quote='"', escape='"').csv(path)
    return table_source.item_dictionary(spark, path)


@query
def code_list(spark, folder):
    """Codes of comma-separated text, one line per brand."""
    path = work_dir(spark, "codes")
    parts = trade.read_table(spark, folder, "part")
    parts.select(F.concat_ws(" , ", "p_name", "p_type", "p_name").alias("value")).write.text(path)
    return table_source.code_list(spark, path)


# ---------------------------------------------------------------- published relations


def _bare(status: DataFrame) -> DataFrame:
    return status.select(
        F.regexp_replace("name", r"^.*\.", "").alias("name"), "series", "kind", "n_columns", "status"
    )


@query
def schema_probe(spark, folder):
    """Columns and types of a published relation, without a job."""
    fields = prj.schema_of(spark.table(f"{_published(spark, folder)}.fry9c_wide_view")).fields
    told = [(n, f.name, f.dataType.simpleString()) for n, f in enumerate(fields)]
    names = spark.createDataFrame(told, "place int, name string, type string")
    # Only codes that the table has are columns.
    codes = trade.collections(spark, folder).where(F.col("seriesid") == SERIES).select("item_mdrm").distinct()
    return names.join(codes, F.col("name") == F.col("item_mdrm"), "left").select(
        "place", "name", "type", F.col("item_mdrm").isNotNull().alias("is_item")
    )


@query
def publish_wide_status(spark, folder):
    table = _new_table(spark, folder, "raw")
    sink.create_partitioned(trade.raw_collections(spark, folder), table)
    return _bare(publish.publish_wide(spark, table, database=_new_database(spark)))


@query
def published_wide_view(spark, folder):
    return spark.table(f"{_published(spark, folder)}.fry9c_wide_view")


@query
def published_view_names(spark, folder):
    return publish.list_views(spark, _published(spark, folder), "*_wide_view")


@query
def materialised_wide(spark, folder):
    """The same relation stored as a table, as the caller chooses for one series."""
    database = _new_database(spark)
    publish.publish_wide(
        spark, _narrow_table(spark, folder), database=database, kind={SERIES: "table"}
    )
    return spark.table(f"{database}.fry9c_wide_view")


@query
def published_normal(spark, folder):
    database, table = _database(spark, folder), _narrow_table(spark, folder)
    publish.publish_normal(spark, table, SERIES, database=database)
    all_rows = agg.total_rows(spark.table(f"{database}.{publish.ALL_ROWS_VIEW}"))
    one = agg.total_rows(spark.table(f"{database}.{publish.ONE_SERIES_VIEW}"))
    return all_rows.withColumn("view", F.lit(publish.ALL_ROWS_VIEW)).unionByName(
        one.withColumn("view", F.lit(publish.ONE_SERIES_VIEW))
    )


@query
def published_report(spark, folder):
    database, table = _new_database(spark), _new_table(spark, folder, "kv")
    sink.create_partitioned(trade.kv(spark, folder), table)
    publish.publish_report(spark, table, database=database)
    return spark.table(f"{database}.click_report_view")


@query
def view_check_report(spark, folder):
    """Checks of views, of a stored table, and of a view whose filings are in no table."""
    database, table = _new_database(spark), _narrow_table(spark, folder)
    publish.publish_wide(spark, table, database=database, kind={SERIES: "table"})
    spark.sql(
        f"CREATE VIEW {database}.stray_wide_view AS SELECT seriesid, aod, concat('x', rssdid) AS rssdid, "
        f"submission_ts, `ITEM1` FROM {database}.fry15_wide_view"
    )
    report = publish.check_views(spark, table, database=database, like="*_wide_view")
    return report.select("view", "check", "passed")


@query
def published_as_of(spark, folder):
    """The published view of an earlier state of the table."""
    view = f"{_new_database(spark)}.collections_asof"
    publish.publish_as_of(spark, _narrow_table(spark, folder), view, INGEST)
    return agg.rows_by(spark.table(view), "seriesid", "ingest_timestamp")


@query
def recreated_views(spark, folder):
    """Views published, dropped by prefix and published again, with another body."""
    database, table = _new_database(spark), _narrow_table(spark, folder)
    publish.publish_wide(spark, table, database=database)
    publish.drop_views(spark, "fry", database)
    publish.publish_wide(spark, table, database=database, prefixes=["FR2004A"])
    return publish.list_views(spark, database)


@query
def table_properties(spark, folder):
    """Properties set on a table and read back, with a quote in a value."""
    table = _new_table(spark, folder, "marked")
    sink.create_partitioned(trade.collections(spark, folder), table)
    sink.set_table_properties(spark, table, {"layer": "it's narrow", "loaded_by": "loads"})
    marked = spark.sql(f"SHOW TBLPROPERTIES {table}").where("key IN ('layer', 'loaded_by')")
    return marked.withColumn("row_count", F.lit(spark.table(table).count()))


# ---------------------------------------------------------------- streams


@_once
def _changing_drop(spark, folder):
    """Files of three layouts: as written, columns turned round with one more, and three optional ones missing."""
    path = work_dir(spark, "changing")
    rows = trade.raw_collections(spark, folder).select(*COLLECTIONS.columns, F.col("ingest_timestamp").alias("ingest_ts"))
    late = F.col("ingest_ts") > INGEST
    whole = rows.where(~late)
    turned = rows.where(late & (F.col("rssdid") % 2 == 0)).withColumn("loader", F.lit("v2"))
    turned = turned.select("ingest_ts", "loader", *reversed(COLLECTIONS.columns))
    fewer = rows.where(late & (F.col("rssdid") % 2 != 0)).drop(
        "context_level3_mdrm", "context_level3_desc", "context_level3_value"
    )
    for part in (whole, turned, fewer):
        writer = sink.rebalanced(part, ["ingest_ts"]).write.mode("append").partitionBy("ingest_ts")
        with sink.open_files(spark):
            writer.options(
                header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
            ).csv(path)
    return path


@query
def load_changing_headers(spark, folder):
    """Columns taken by name whatever their order and number; nothing is shifted or lost."""
    target, ledger = work_dir(spark, "narrow"), work_dir(spark, "ledger")
    loads.load_new(spark, _changing_drop(spark, folder), target, ledger)
    return loads.read_loaded(spark, target)


@query
def load_rejects(spark, folder):
    """What the load refused, by reason; with the stored rows it adds up to the lines read."""
    target, ledger = work_dir(spark, "narrow"), work_dir(spark, "ledger")
    loads.load_new(spark, _changing_drop(spark, folder), target, ledger)
    return agg.rows_by(loads.read_rejects(spark, target), "reason")


@query
def load_extra_columns(spark, folder):
    """A load that adds a column which only some files have."""
    table = _new_table(spark, folder, "extra")
    loads.ingest(spark, _changing_drop(spark, folder), table, extra=True)
    return agg.rows_by(spark.table(table), "seriesid", "loader")


@query
def stream_rejects(spark, folder):
    """The same rejects out of a stream of several batches."""
    target = work_dir(spark, "streamed")
    rows = streams.read_drop_stream(spark, _changing_drop(spark, folder), max_files_per_trigger=60)
    streams.ingest_stream(rows, target, work_dir(spark, "checkpoint")).awaitTermination()
    return agg.rows_by(loads.read_rejects(spark, target), "reason")


@query
def stream_ingest(spark, folder):
    """The drop read as a stream, run twice over one checkpoint."""
    target, checkpoint = work_dir(spark, "streamed"), work_dir(spark, "checkpoint")
    for _ in range(2):
        rows = streams.read_drop_stream(spark, _drop(spark, folder), max_files_per_trigger=40)
        streams.ingest_stream(rows, target, checkpoint).awaitTermination()
    return streams.read_stream_table(spark, target)


def _refreshed(spark, folder, refresh_mode, max_files):
    target, wide = work_dir(spark, "streamed"), work_dir(spark, "wide")
    rows = streams.read_drop_stream(spark, _drop(spark, folder), max_files_per_trigger=max_files)
    streams.refresh_stream(
        rows, target, wide, work_dir(spark, "checkpoint"), refresh=refresh_mode
    ).awaitTermination()
    return refresh.read_wide(spark, wide, SERIES)


@query
def stream_refresh(spark, folder):
    """Batches stored, and the touched filings of the wide relations refreshed after each."""
    return _refreshed(spark, folder, "filings", 50)


@query
def stream_rebuild(spark, folder):
    """The same with a rebuild of each touched series."""
    return _refreshed(spark, folder, "series", None)


@query
def published_latest(spark, folder):
    view = f"{_new_database(spark)}.collections_latest"
    publish.publish_latest(spark, _narrow_table(spark, folder), view)
    return agg.rows_by(spark.table(view), "seriesid", "submission_ts")
