"""DuckDB SQL with the same result as each query in ``narrowlake.registry``."""

from __future__ import annotations

KEYS = "seriesid, aod, rssdid, submission_ts"
SERIES = "FRY9C"
ITEMS = [f"ITEM{n}" for n in range(1, 8)]
KV_CODES = [f"{kind}{n:04d}" for kind in ("RCFD", "RCON") for n in range(10)]
ENTITY_CODES = [f"key_{n}" for n in range(10)]


def _codes(width: int) -> list[str]:
    return [f"M{n:05d}" for n in range(width)]


def _lines(item: str = "'ITEM' || CAST(l_linenumber AS VARCHAR)", series: str | None = None) -> str:
    base = "CASE l_returnflag WHEN 'A' THEN 'FRY9C' WHEN 'N' THEN 'FRY15' ELSE 'FR2004A' END"
    if series:
        base = series.format(base=base)
    return f"""SELECT {base} AS seriesid,
  strftime(last_day(CAST(date_trunc('quarter', l_shipdate) AS DATE) + INTERVAL 2 MONTH), '%Y%m%d') AS aod,
  CAST(l_suppkey AS VARCHAR) AS rssdid,
  strftime(l_shipdate, '%Y%m') AS submission_ts,
  CASE WHEN l_linenumber = 7 AND l_quantity = 50 THEN NULL ELSE {item} END AS item_mdrm,
  'Line, item ' || CAST(l_linenumber AS VARCHAR) AS item_desc,
  CASE WHEN l_quantity = 13 THEN NULL ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS item_value,
  CASE WHEN l_linestatus = 'O' THEN 'CTX1' ELSE '' END AS context_level1_mdrm,
  CASE WHEN l_linestatus = 'O' THEN 'Open line' ELSE '' END AS context_level1_desc,
  CASE WHEN l_linestatus = 'O' THEN CAST(l_partkey % 2 AS VARCHAR) ELSE '' END AS context_level1_value,
  CASE WHEN l_discount > 0.05 THEN 'CTX2' END AS context_level2_mdrm,
  CASE WHEN l_discount > 0.05 THEN 'Discounted' END AS context_level2_desc,
  CASE WHEN l_partkey % 5 <> 0 THEN CAST(l_partkey % 5 AS VARCHAR) END AS context_level2_value,
  CASE WHEN l_tax > 0.04 THEN 'CTX3' ELSE '' END AS context_level3_mdrm,
  CASE WHEN l_tax > 0.04 THEN 'Taxed' ELSE '' END AS context_level3_desc,
  CAST(l_partkey % 3 AS VARCHAR) AS context_level3_value,
  strftime(l_shipdate + INTERVAL 20 DAY, '%Y%m') AS ingest_timestamp
FROM lineitem"""


RAW_SERIES = """CASE WHEN l_quantity = 1 THEN NULL WHEN l_quantity = 2 THEN '' WHEN l_quantity = 3 THEN '  '
  WHEN l_quantity = 4 THEN 'X' || {base} WHEN l_quantity = 5 THEN {base} || 'X' ELSE {base} END"""

CELL = """CASE WHEN context_level1_mdrm IS NULL OR context_level1_mdrm = '' THEN item_value
  ELSE context_level1_mdrm || '=' || COALESCE(context_level1_value, '')
    || COALESCE(':' || NULLIF(context_level2_mdrm, '') || '=' || COALESCE(context_level2_value, ''), '')
    || COALESCE(':' || NULLIF(context_level3_mdrm, '') || '=' || COALESCE(context_level3_value, ''), '')
    || ':' || item_value END"""

NARROW = f"narrow AS ({_lines()})"
CELLS = f"{NARROW}, cells AS (SELECT *, {CELL} AS cell FROM narrow)"
RAW = f"narrow AS ({_lines(series=RAW_SERIES)})"
# The loader's CSV options read an empty field, quoted or not, as NULL.
TEXT = """seriesid aod rssdid submission_ts item_mdrm item_desc item_value context_level1_mdrm context_level1_desc
  context_level1_value context_level2_mdrm context_level2_desc context_level2_value context_level3_mdrm
  context_level3_desc context_level3_value ingest_timestamp""".split()
FROM_CSV = f"written AS ({_lines(series=RAW_SERIES)}), narrow AS (SELECT {', '.join(f"NULLIF({c}, '') AS {c}" for c in TEXT)} FROM written)"
VALID = "(starts_with(seriesid, 'FRY9C') OR starts_with(seriesid, 'FRY15') OR starts_with(seriesid, 'FR2004A'))"

KV = """kv AS (SELECT event_type AS seriesid, strftime(ts, '%Y%m%d') AS aod, CAST(user_id AS VARCHAR) AS rssdid,
  strftime(ts, '%Y%m%d%H') AS submissionts,
  CASE WHEN n % 2 = 0 THEN 'RCON' ELSE 'RCFD' END || lpad(CAST(n // 10 AS VARCHAR), 4, '0') AS key, value,
  strftime(ts, '%Y%m%d') AS ingest_timestamp
  FROM (SELECT *, CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS INTEGER) AS n FROM events))"""

ENTITY = """entity AS (SELECT o_orderstatus AS entity1, NULLIF(o_orderpriority, '4-NOT SPECIFIED') AS entity2,
  CAST(o_custkey AS VARCHAR) AS entity3, strftime(o_orderdate, '%Y%m') AS entity4,
  'key_' || CAST(o_orderkey % 10 AS VARCHAR) AS key, 'value_' || CAST(o_orderkey AS VARCHAR) AS value FROM orders)"""

DAILY = """daily AS (SELECT seriesid, CAST(strptime(aod, '%Y%m%d') AS DATE) AS report_date,
  COUNT(DISTINCT rssdid) AS institution_count, COUNT(*) AS total_records,
  CAST(SUM(CASE WHEN key LIKE 'RCON%' THEN 1 ELSE 0 END) AS BIGINT) AS rcon_fields,
  MAX(submissionts) AS latest_submission FROM kv GROUP BY 1, 2)"""


def _max(codes: list[str], value: str, item: str = "item_mdrm") -> str:
    return ", ".join(f"MAX(CASE WHEN {item} = '{c}' THEN {value} END) AS \"{c}\"" for c in codes)


def _pivot(
    codes: list[str],
    value: str = "cell",
    *,
    source: str = "cells",
    keys: str = KEYS,
    where: str = f"seriesid = '{SERIES}'",
    item: str = "item_mdrm",
    extra: str = "",
) -> str:
    return (
        f"SELECT {keys}, {extra}{_max(codes, value, item)} FROM {source} WHERE {where} GROUP BY {keys}"
    )


def _coded(width: int, keys: str, where: str = "TRUE") -> str:
    lines = _lines(item=f"'M' || lpad(CAST(l_partkey % {width} AS VARCHAR), 5, '0')")
    cells = f"narrow AS ({lines}), cells AS (SELECT *, {CELL} AS cell FROM narrow)"
    return f"WITH {cells} {_pivot(_codes(width), keys=keys, where=where)}"


ODD = f"""{NARROW}, counted AS (SELECT ingest_timestamp AS ingest_ts, COUNT(*) AS n FROM narrow GROUP BY 1),
  odd AS (SELECT ingest_ts, CAST(ingest_ts[5:6] AS BIGINT) % 4 AS kind, CASE kind WHEN 0 THEN 'seriesid,rows,' || n
  WHEN 1 THEN 'seriesid' || chr(9) || 'rows' || chr(9) || n WHEN 2 THEN 'no delimiter ' || n ELSE 'seriesid;rows;' || n END AS line
  FROM counted)"""
SERIES_ITEMS = f"""WITH {NARROW} SELECT seriesid, string_agg(item_mdrm, ',' ORDER BY item_mdrm) AS items
        FROM (SELECT DISTINCT seriesid, item_mdrm FROM narrow WHERE item_mdrm IS NOT NULL) GROUP BY seriesid"""
WIDE = f"{CELLS}, wide AS ({_pivot(ITEMS)})"


def _differences() -> str:
    return f"""WITH {WIDE}, damaged AS ({_pivot(ITEMS, where=f"seriesid = '{SERIES}' AND (rssdid NOT LIKE '%7' OR item_mdrm <> 'ITEM1')")})
        SELECT *, CAST(1 AS BIGINT) AS left_rows, CAST(0 AS BIGINT) AS right_rows FROM (SELECT * FROM wide EXCEPT SELECT * FROM damaged)
        UNION ALL SELECT *, CAST(0 AS BIGINT), CAST(1 AS BIGINT) FROM (SELECT * FROM damaged EXCEPT SELECT * FROM wide)"""


WIDE_ITEMS = f"{NARROW}, wide AS ({_pivot(ITEMS, 'item_value', source='narrow')})"
WIDE_FR = f"""{CELLS}, wide AS ({_pivot(ITEMS, where="seriesid = 'FR2004A'")})"""
ENTITY_KEYS = "entity1, entity2, entity3, entity4"


def _entity(where: str) -> str:
    return _pivot(ENTITY_CODES, "value", source="entity", keys=ENTITY_KEYS, where=where, item="key")


def _kv(series: str) -> str:
    return _pivot(
        KV_CODES,
        "value",
        source="kv",
        keys="seriesid, aod, rssdid, submissionts",
        where=f"seriesid = '{series}'",
        item="key",
    )


COMPOSITE = [f"ITEM{n}{c}" for n in range(1, 8) for c in ("", "_CTX0", "_CTX1")]
CODE_OF_ITEM = "CASE WHEN COALESCE(context_level1_value, '') = '' THEN item_mdrm ELSE item_mdrm || '_CTX' || context_level1_value END"

SCHEDULE = "schedule AS (SELECT CAST(o_orderkey AS VARCHAR) AS filing_id, o_orderpriority AS schedule_id FROM orders)"
ITEMS_FULL = _lines().replace(
    "FROM lineitem",
    """, CAST(l_orderkey AS VARCHAR) AS filing_id, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS submission_datetime,
  l_linestatus AS filing_status, CASE WHEN l_quantity = 13 THEN 'Y' ELSE 'N' END AS estimated_flag,
  CASE WHEN l_quantity = 13 THEN 'estimate' END AS estimated_by FROM lineitem""",
)
ITEM_ROWS = f"items AS ({ITEMS_FULL}), {SCHEDULE}"

LATEST = f"""SELECT {KEYS}, item_mdrm, item_value, ingest_timestamp FROM (SELECT *, ROW_NUMBER() OVER (
  PARTITION BY seriesid, aod, rssdid, item_mdrm ORDER BY submission_ts DESC, ingest_timestamp DESC,
  item_value DESC NULLS LAST, context_level1_value DESC NULLS LAST, context_level2_value DESC NULLS LAST,
  context_level3_value DESC NULLS LAST) AS rn FROM narrow) WHERE rn = 1"""

# Columns of rows from files that lack the third context level.
CHANGED = [
    f"CASE WHEN ingest_timestamp > '199811' AND CAST(rssdid AS BIGINT) % 2 <> 0 THEN NULL ELSE {c} END AS {c}"
    if "level3" in c
    else c
    for c in TEXT
]
REASON = """CASE WHEN seriesid IS NULL THEN 'null series' WHEN seriesid = '' THEN 'blank series' ELSE 'unknown series' END"""

ORACLES: dict[str, str] = {
    # pivots
    "wide_encoded": f"WITH {CELLS} {_pivot(ITEMS)}",
    "wide_encoded_multi": f"WITH {CELLS} {_pivot(ITEMS, keys=KEYS + ', ingest_timestamp', where=VALID)}",
    "wide_encoded_80": _coded(80, KEYS),
    "wide_encoded_550": _coded(550, KEYS),
    "wide_encoded_1900": _coded(1900, KEYS),
    "wide_kv": f"WITH {KV} {_kv('click')}",
    "wide_api": f"WITH {KV} {_kv('purchase')}",
    "wide_entity": f"""WITH {ENTITY} {_entity("entity1 = 'O'")}""",
    "wide_items": f"WITH {NARROW} {_pivot(ITEMS, 'item_value', source='narrow')}",
    "wide_items_ctx": f"""WITH {NARROW} {_pivot(ITEMS, 'item_value', source='narrow', where="seriesid = 'FR2004A'",
        extra='MAX(context_level1_mdrm) AS context_level1_mdrm, MAX(context_level1_desc) AS context_level1_desc, MAX(context_level1_value) AS context_level1_value, ')}""",
    "wide_composite": f"""WITH {NARROW}, coded AS (SELECT *, {CODE_OF_ITEM} AS code FROM narrow)
        {_pivot(COMPOSITE, 'item_value', source='coded', where="seriesid = 'FR2004A'", item='code')}""",
    "wide_by_group": _coded(160, KEYS, f"seriesid = '{SERIES}'"),
    "pivot_custom": f"""WITH {CELLS} SELECT seriesid, aod, MAX(CASE WHEN item_mdrm = 'ITEM1' THEN cell END) AS "ITEM1",
        MAX(CASE WHEN item_mdrm = 'ITEM3' THEN cell END) AS "ITEM3", TRUE AS has_created_at
        FROM cells WHERE item_value IS NOT NULL GROUP BY seriesid, aod""",
    "items_by_series": SERIES_ITEMS,
    "kept_codes": SERIES_ITEMS,
    "unpivot_roundtrip": f"""WITH {CELLS} SELECT {KEYS}, item_mdrm, MAX(cell) AS cell FROM cells
        WHERE seriesid = '{SERIES}' AND item_mdrm IS NOT NULL AND cell IS NOT NULL GROUP BY {KEYS}, item_mdrm""",
    # rows and columns
    "all_data": f"WITH {NARROW} SELECT * FROM narrow",
    "one_series": f"WITH {NARROW} SELECT * FROM narrow WHERE seriesid = 'FRY15'",
    "by_partition": f"WITH {NARROW} SELECT * FROM narrow WHERE seriesid = 'FRY9C' AND ingest_timestamp = '199811'",
    "by_key": f"WITH {KV} SELECT seriesid, aod, rssdid, value FROM kv WHERE key = 'RCON0003'",
    "by_aod": f"WITH {WIDE} SELECT * FROM wide WHERE aod = '19981231'",
    "by_ingest": f"""WITH {NARROW} SELECT * FROM narrow WHERE ingest_timestamp = '199811' ORDER BY
        {KEYS}, item_mdrm NULLS FIRST, item_desc, item_value NULLS FIRST, context_level1_mdrm, context_level1_desc,
        context_level1_value, context_level2_mdrm NULLS FIRST, context_level2_desc NULLS FIRST,
        context_level2_value NULLS FIRST, context_level3_mdrm, context_level3_desc, context_level3_value LIMIT 100""",
    "by_entity": f"WITH {ENTITY} SELECT * FROM entity WHERE entity1 = 'O' AND entity2 = '2-HIGH'",
    "not_null_entity": f"""WITH {ENTITY} {_entity("entity1 = 'F' AND entity2 IS NOT NULL")}""",
    "recent_days": f"WITH {KV}, {DAILY} SELECT * FROM daily WHERE report_date >= DATE '2024-02-10' - INTERVAL 30 DAY",
    "recent_filings": f"""WITH {NARROW} SELECT seriesid, CAST(strptime(aod, '%Y%m%d') AS DATE) AS report_date,
        COUNT(*) AS record_count FROM narrow
        WHERE CAST(strptime(aod, '%Y%m%d') AS DATE) >= DATE '2001-12-31' - INTERVAL 100 DAY GROUP BY 1, 2""",
    "valid_series": f"WITH {RAW} SELECT * FROM narrow WHERE regexp_matches(seriesid, '^(FRY9C|FRY15|FR2004A)')",
    "rejected_rows": f"""WITH {RAW} SELECT *, CASE WHEN seriesid IS NULL THEN 'null series' WHEN seriesid = '' THEN 'blank series'
        ELSE 'unknown series' END AS reason FROM narrow
        WHERE seriesid IS NULL OR NOT regexp_matches(seriesid, '^(FRY9C|FRY15|FR2004A)')""",
    "valid_discriminators": f"WITH {RAW} SELECT DISTINCT seriesid FROM narrow WHERE {VALID}",
    "invalid_count": f"""WITH {RAW} SELECT COUNT(*) AS total_rows, COUNT(*) FILTER (WHERE {VALID}) AS valid_rows,
        COUNT(*) FILTER (WHERE seriesid IS NULL OR NOT {VALID}) AS invalid_rows FROM narrow""",
    "series_difference": f"""WITH {RAW} SELECT DISTINCT seriesid FROM narrow
        EXCEPT SELECT DISTINCT seriesid FROM narrow WHERE {VALID}""",
    "renamed_items": f"""WITH {WIDE_ITEMS} SELECT aod, rssdid, "ITEM1" AS first_line, "ITEM2" AS second_line
        FROM wide WHERE aod = '19981231' ORDER BY rssdid""",
    "column_subset": f"""WITH {WIDE} SELECT seriesid, "ITEM1", "ITEM2", "ITEM3", "ITEM4", "ITEM5" FROM wide""",
    "report_items": f"""WITH {ITEM_ROWS} SELECT DISTINCT substr(i.filing_id, 1, 250) AS filing_id, substr(seriesid, 1, 20) AS series_id,
        substr(schedule_id, 1, 250) AS schedule_id, substr(rssdid, 1, 22) AS rssd_id, aod AS as_of_date,
        substr(item_mdrm, 1, 8) AS item_mdrm, substr(item_desc, 1, 4000) AS item_description, item_value,
        context_level1_mdrm, context_level1_desc, context_level1_value, context_level2_mdrm, context_level2_desc,
        context_level2_value, context_level3_mdrm, context_level3_desc, context_level3_value,
        CAST(submission_datetime AS TIMESTAMP) AS submission_datetime, filing_status, estimated_flag, estimated_by
        FROM items i JOIN schedule s ON i.filing_id = s.filing_id""",
    "without_desc": f"""WITH {NARROW} SELECT * EXCLUDE (item_desc, context_level1_desc, context_level2_desc, context_level3_desc)
        FROM narrow""",
    "first_rows": f"WITH {WIDE} SELECT * FROM wide ORDER BY {KEYS} LIMIT 10",
    "add_literal": f"WITH {ENTITY} SELECT *, '20240229' AS ingest_timestamp FROM entity",
    "add_created_at": f"WITH {WIDE} SELECT {KEYS}, TRUE AS is_stamped FROM wide",
    # joins
    "cross_series_join": f"""WITH {NARROW}, a AS ({_pivot(ITEMS, 'item_value', source='narrow')}),
        b AS ({_pivot(ITEMS, 'item_value', source='narrow', where="seriesid = 'FRY15'")})
        SELECT a.rssdid, a.aod, a.seriesid AS fry9c_series, a."ITEM1" AS fry9c_value, b."ITEM2" AS fry15_value
        FROM a LEFT JOIN b ON a.rssdid = b.rssdid AND a.aod = b.aod WHERE a.aod = '19981231'""",
    "entity_view_join": f"""WITH {ENTITY}, a AS ({_entity("entity1 = 'O'")}), b AS ({_entity("entity1 = 'P'")})
        SELECT a.entity1, a.entity2, a.key_1, b.entity2 AS other_entity2, b.key_6 AS other_key_6
        FROM a LEFT JOIN b ON a.entity3 = b.entity3""",
    "items_schedule_join": f"""WITH {ITEM_ROWS} SELECT i.filing_id, schedule_id, item_mdrm, item_value
        FROM items i JOIN schedule s ON i.filing_id = s.filing_id""",
    "item_desc_lookup": f"""WITH {NARROW}, names AS (SELECT DISTINCT 'ITEM' || CAST(l_linenumber AS VARCHAR) AS item_mdrm,
        'Line number ' || CAST(l_linenumber AS VARCHAR) AS item_desc FROM lineitem)
        SELECT {KEYS}, n.item_mdrm, d.item_desc, item_value FROM narrow n LEFT JOIN names d ON n.item_mdrm = d.item_mdrm""",
    "code_assignment": """WITH codes AS (SELECT n_name AS code, ROW_NUMBER() OVER (ORDER BY n_name) - 1 AS code_no FROM nation)
        SELECT o_orderkey, code FROM orders JOIN codes ON o_orderkey % (SELECT COUNT(*) FROM nation) = code_no""",
    # counts and summaries
    "total_rows": f"WITH {NARROW} SELECT COUNT(*) AS row_count FROM narrow",
    "view_rows": f"WITH {WIDE} SELECT COUNT(*) AS row_count FROM wide",
    "rows_by_series": f"WITH {NARROW} SELECT seriesid, COUNT(*) AS record_count FROM narrow GROUP BY 1",
    "rows_by_partition": f"WITH {NARROW} SELECT seriesid, ingest_timestamp, COUNT(*) AS record_count FROM narrow GROUP BY 1, 2",
    "rows_by_pair": f"WITH {ENTITY} SELECT entity1, entity2, COUNT(*) AS record_count FROM entity GROUP BY 1, 2 ORDER BY 1, 2",
    "rows_by_series_aod": f"""WITH {WIDE} SELECT seriesid, aod, COUNT(*) AS record_count FROM wide
        GROUP BY 1, 2 ORDER BY 1, 2 LIMIT 5""",
    "distinct_series": f"WITH {NARROW} SELECT DISTINCT seriesid FROM narrow",
    "distinct_items": """SELECT DISTINCT CASE WHEN l_linenumber = 7 AND l_quantity = 50 THEN NULL
        ELSE 'M' || lpad(CAST(l_partkey % 550 AS VARCHAR), 5, '0') END AS item_mdrm FROM lineitem WHERE l_returnflag = 'A'""",
    "distinct_ingests": f"WITH {NARROW} SELECT DISTINCT ingest_timestamp FROM narrow",
    "filing_summary": f"""WITH {NARROW} SELECT seriesid, aod, rssdid, COUNT(*) AS record_count, MAX(submission_ts) AS latest_submission
        FROM narrow WHERE seriesid = 'FRY9C' GROUP BY 1, 2, 3""",
    "daily_summary": f"WITH {KV}, {DAILY} SELECT * FROM daily",
    "kept_summary": f"WITH {KV}, {DAILY} SELECT * FROM daily",
    "distinct_rows": f"WITH {NARROW} SELECT DISTINCT seriesid, rssdid, item_mdrm, item_desc FROM narrow",
    "refresh_summary": f"""WITH {KV}, {DAILY}, {DAILY.replace('daily AS', 'early AS').replace('FROM kv', "FROM kv WHERE submissionts < '2024011500'")}
        SELECT * FROM daily WHERE seriesid = 'click' UNION ALL SELECT * FROM early WHERE seriesid <> 'click'""",
    # latest and as-of
    "latest_submission": f"WITH {NARROW} {LATEST}",
    "kept_latest": f"WITH {NARROW} {LATEST}",
    "asof_ingest": f"""WITH {NARROW} SELECT seriesid, COUNT(*) AS record_count FROM narrow
        WHERE ingest_timestamp <= '199811' GROUP BY 1""",
    # cells
    "encoded_cells": f"WITH {CELLS} SELECT {KEYS}, item_mdrm, cell FROM cells",
    "decode_regex_cells": f"""WITH {WIDE_FR} SELECT seriesid, aod, rssdid, "ITEM1",
        regexp_extract("ITEM1", ':([0-9]+)$', 1) AS item1_value, regexp_extract("ITEM1", '^([^=]+)=', 1) AS item1_context1_mdrm,
        regexp_extract("ITEM1", '^[^=]+=([^:]+)', 1) AS item1_context1_value FROM wide""",
    "decode_cells": f"""WITH {WIDE_FR}, parts AS (SELECT *, string_split("ITEM1", ':') AS p FROM wide)
        SELECT {KEYS}, "ITEM1", p[len(p)] AS item1_value,
        {", ".join(f'''CASE WHEN len(p) > {n} THEN split_part(p[{n}], '=', 1) END AS item1_context{n}_mdrm,
        CASE WHEN len(p) > {n} THEN split_part(p[{n}], '=', 2) END AS item1_context{n}_value''' for n in (1, 2, 3))}
        FROM parts""",
    # quality
    "compare_outputs": _differences(),
    "compare_by_checksum": _differences(),
    "compare_ingests": f"""WITH {NARROW} SELECT seriesid, rssdid, item_mdrm, ingest_timestamp, COUNT(*) AS left_rows,
        CAST(0 AS BIGINT) AS right_rows FROM narrow WHERE ingest_timestamp > '200105' GROUP BY 1, 2, 3, 4""",
    "duplicate_items": f"""WITH {NARROW} SELECT {KEYS}, item_mdrm, ingest_timestamp, COUNT(*) AS row_count FROM narrow
        GROUP BY {KEYS}, item_mdrm, ingest_timestamp HAVING COUNT(*) > 1""",
    "one_row_per_filing": f"""WITH {WIDE} SELECT {KEYS}, CAST(CASE WHEN rssdid LIKE '%7' THEN 0 ELSE 2 END AS BIGINT) AS wide_rows
        FROM wide WHERE rssdid LIKE '%7' OR rssdid LIKE '%3'""",
    "no_unknown_ingest": f"WITH {NARROW} SELECT COUNT(*) AS unknown_rows FROM narrow WHERE item_mdrm = 'ITEM7'",
    "non_empty": f"WITH {NARROW} SELECT {KEYS}, item_mdrm FROM narrow",
    # files and tables
    "file_manifest": f"WITH {ODD} SELECT ingest_ts, CAST(strlen(line) + 1 AS BIGINT) AS length FROM odd",
    "csv_sniff": f"WITH {ODD} SELECT ingest_ts, CAST(strlen(line) + 1 AS BIGINT) AS length, md5(line || chr(2)) AS sample_md5, "
    f"line || chr(2) AS header, kind <> 2 AS is_csv FROM odd",
    "csv_strict": f"WITH {FROM_CSV} SELECT * FROM narrow",
    "csv_first_file_stamp": f"""WITH {RAW} SELECT (SELECT MIN(ingest_timestamp) FROM narrow) AS ingest_timestamp,
        COUNT(*) AS record_count FROM narrow""",
    "csv_plain": f"""WITH {NARROW} SELECT item_mdrm, COUNT(*) AS record_count, CAST(SUM(CAST(item_value AS BIGINT)) AS BIGINT) AS total_value
        FROM narrow GROUP BY 1""",
    "csv_roundtrip_ingest": f"WITH {FROM_CSV} SELECT * FROM narrow WHERE {VALID}",
    "csv_rejects": f"""WITH {FROM_CSV} SELECT seriesid, CASE WHEN seriesid IS NULL THEN 'null series' WHEN seriesid = '' THEN 'blank series'
        ELSE 'unknown series' END AS reason, COUNT(*) AS record_count FROM narrow
        WHERE seriesid IS NULL OR NOT {VALID} GROUP BY 1, 2""",
    "csv_text_roundtrip": "SELECT doc_id, lang, text FROM documents",
    "parquet_roundtrip": f"WITH {ENTITY} SELECT * FROM entity",
    "create_or_append": f"WITH {NARROW} SELECT seriesid, ingest_timestamp, COUNT(*) AS record_count FROM narrow GROUP BY 1, 2",
    "post_load_count": f"""WITH {NARROW} SELECT COUNT(*) FILTER (WHERE ingest_timestamp <= '199811') AS before_rows,
        COUNT(*) FILTER (WHERE ingest_timestamp > '199811') AS batch_rows, COUNT(*) AS after_rows FROM narrow""",
    "ingest_new_only": f"WITH {FROM_CSV} SELECT * FROM narrow WHERE {VALID}",
    "new_files": f"""WITH {ODD} SELECT ingest_ts, CAST(strlen(line) + 1 AS BIGINT) AS length, md5(line || chr(2)) AS sample_md5
        FROM odd WHERE kind <> 2 AND (ingest_ts > '199811' OR CAST(ingest_ts AS BIGINT) % 3 = 0)""",
    "load_long_headers": f"WITH {FROM_CSV} SELECT * FROM narrow WHERE {VALID}",
    "compacted_loads": f"WITH {FROM_CSV} SELECT * FROM narrow WHERE {VALID}",
    "retained_wide": f"""WITH {CELLS} {_pivot(ITEMS, where=f"seriesid = '{SERIES}' AND ingest_timestamp >= '199811'")}""",
    "append_merge_schema": f"""WITH {NARROW} SELECT seriesid, CASE WHEN ingest_timestamp > '199811' THEN 'v2' END AS loader,
        COUNT(*) AS record_count FROM narrow GROUP BY 1, 2""",
    "evolve_schema": f"""WITH {ENTITY} SELECT entity1, entity2, key, value AS new_value, CAST(NULL AS VARCHAR) AS new_field FROM entity""",
    "ctas_verify": f"WITH {NARROW} SELECT seriesid, COUNT(*) AS record_count FROM narrow GROUP BY 1",
    "upsert_wide": f"WITH {CELLS} {_pivot(ITEMS)}",
    "drop_old_ingests": f"""WITH {NARROW} SELECT seriesid, ingest_timestamp, COUNT(*) AS record_count FROM narrow
        WHERE ingest_timestamp >= '199811' GROUP BY 1, 2""",
    "item_dictionary": """SELECT 'P' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS item_mdrm, p_name AS item_desc,
        CASE WHEN p_size > 25 THEN 'GSWA0001' END AS context_level1_mdrm,
        CASE WHEN p_size > 25 THEN 'Long  1' END AS context_level1_desc,
        CASE WHEN p_size > 25 THEN '1' END AS context_level1_value FROM part""",
    "code_list": "SELECT p_name AS code FROM part UNION SELECT p_type FROM part",
    # published relations
    "schema_probe": f"""WITH named AS (SELECT unnest(range(0, {len(ITEMS) + 4})) AS place,
        unnest([{", ".join(f"'{c}'" for c in [*KEYS.split(", "), *ITEMS])}]) AS name)
        SELECT CAST(place AS INTEGER) AS place, name, 'string' AS type, place >= 4 AS is_item FROM named""",
    "publish_wide_status": f"""WITH {RAW} SELECT lower(seriesid) || '_wide_view' AS name, seriesid AS series, 'view' AS kind,
        CAST(4 + COUNT(DISTINCT item_mdrm) AS INTEGER) AS n_columns, 'created' AS status FROM narrow WHERE {VALID} GROUP BY seriesid
        UNION ALL SELECT DISTINCT CAST(NULL AS VARCHAR), seriesid, CAST(NULL AS VARCHAR), CAST(NULL AS INTEGER), 'skipped'
        FROM (SELECT NULLIF(seriesid, '') AS seriesid FROM narrow) WHERE seriesid IS NULL OR NOT {VALID}""",
    "published_as_of": f"""WITH {NARROW} SELECT seriesid, ingest_timestamp, COUNT(*) AS record_count FROM narrow
        WHERE ingest_timestamp <= '199811' GROUP BY 1, 2""",
    "recreated_views": f"""WITH {NARROW} SELECT DISTINCT lower(seriesid) || '_wide_view' AS view_name FROM narrow
        WHERE starts_with(seriesid, 'FR2004A')""",
    "table_properties": f"""WITH {NARROW} SELECT COUNT(*) AS row_count, key, value FROM narrow,
        (VALUES ('layer', 'it''s narrow'), ('loaded_by', 'loads')) AS p(key, value) GROUP BY key, value""",
    "published_wide_view": f"WITH {CELLS} {_pivot(ITEMS)}",
    "published_view_names": f"WITH {NARROW} SELECT DISTINCT lower(seriesid) || '_wide_view' AS view_name FROM narrow",
    "materialised_wide": f"WITH {CELLS} {_pivot(ITEMS)}",
    "published_normal": f"""WITH {NARROW} SELECT COUNT(*) AS row_count, 'collections_data_vw' AS view FROM narrow
        UNION ALL SELECT COUNT(*), 'one_series_vw' FROM narrow WHERE seriesid = 'FRY9C'""",
    "published_report": f"WITH {KV} {_kv('click')}",
    "view_check_report": f"""WITH {NARROW}, published AS (SELECT DISTINCT lower(seriesid) AS name FROM narrow UNION ALL SELECT 'stray')
        SELECT name || '_wide_view' AS view, c.check_name AS "check", name <> 'stray' OR c.check_name <> 'joins' AS passed
        FROM published, (VALUES ('schema'), ('rows'), ('sample'), ('group'), ('columns'), ('joins')) AS c(check_name)""",
    # loads of changing files, streams
    "load_changing_headers": f"""WITH {FROM_CSV} SELECT {", ".join(CHANGED)} FROM narrow WHERE {VALID}""",
    "load_rejects": f"""WITH {FROM_CSV} SELECT {REASON} AS reason, COUNT(*) AS record_count FROM narrow
        WHERE seriesid IS NULL OR NOT {VALID} GROUP BY 1""",
    "stream_rejects": f"""WITH {FROM_CSV} SELECT {REASON} AS reason, COUNT(*) AS record_count FROM narrow
        WHERE seriesid IS NULL OR NOT {VALID} GROUP BY 1""",
    "load_extra_columns": f"""WITH {FROM_CSV} SELECT seriesid, CASE WHEN ingest_timestamp > '199811' AND CAST(rssdid AS BIGINT) % 2 = 0
        THEN 'v2' END AS loader, COUNT(*) AS record_count FROM narrow WHERE {VALID} GROUP BY 1, 2""",
    "stream_ingest": f"WITH {FROM_CSV} SELECT * FROM narrow WHERE {VALID}",
    "stream_refresh": f"WITH {FROM_CSV}, cells AS (SELECT *, {CELL} AS cell FROM narrow) {_pivot(ITEMS)}",
    "stream_rebuild": f"WITH {FROM_CSV}, cells AS (SELECT *, {CELL} AS cell FROM narrow) {_pivot(ITEMS)}",
    "published_latest": f"""WITH {NARROW}, latest AS (SELECT DISTINCT seriesid, aod, rssdid, item_mdrm,
        MAX(submission_ts) OVER (PARTITION BY seriesid, aod, rssdid, item_mdrm) AS submission_ts FROM narrow)
        SELECT seriesid, submission_ts, COUNT(*) AS record_count FROM latest GROUP BY 1, 2""",
}
