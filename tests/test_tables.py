"""Tables, views, refreshes, quality and plan shapes."""

import uuid

import pytest
from pyspark.sql import functions as F

from narrowlake.model import COLLECTIONS, KV
from narrowlake.operators import aggregates as agg
from narrowlake.operators import filters as flt
from narrowlake.operators import joins, latest, pivots, quality, sets
from narrowlake.operators import projections as prj
from narrowlake.plans import publish, refresh
from narrowlake.sinks import tables as sink
from narrowlake.sinks import versions

KEYS = list(COLLECTIONS.keys)


def narrow(spark, rows):
    """Rows of (series, aod, rssdid, submission, item, value, ingest)."""
    schema = ", ".join(f"{c} string" for c in (*KEYS, "item_mdrm", "item_value", "ingest_timestamp"))
    frame = spark.createDataFrame(rows, schema)
    for c in COLLECTIONS.columns:
        if c not in frame.columns:
            frame = frame.withColumn(c, F.lit(None).cast("string"))
    return frame.select(*COLLECTIONS.columns, COLLECTIONS.ingest)


def sample(spark):
    return narrow(
        spark,
        [
            ("FRY9C", "20230131", "1", "1", "A", "9", "100"),
            ("FRY9C", "20230131", "1", "1", "A", "10", "100"),
            ("FRY9C", "20230131", "1", "2", "A", "7", "200"),
            ("FRY9C", "20230131", "2", "1", "B", "5", "100"),
            ("FRY15", "20230131", "1", "1", "C", "3", "100"),
            ("FRY9CX", "20230131", "1", "1", "A", "1", "100"),
            ("OTHER", "20230131", "1", "1", "A", "1", "100"),
        ],
    )


@pytest.fixture
def database(spark, tmp_path):
    name = f"db_{uuid.uuid4().hex[:10]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/{name}'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


@pytest.fixture
def table(spark, database):
    name = f"{database}.collections_data_tbl"
    sink.create_partitioned(sample(spark), name)
    return name


def plan(frame):
    return frame._jdf.queryExecution().explainString(
        frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


# ---------------------------------------------------------------- tables


def test_append_matches_columns_by_name(spark, table):
    extra = narrow(spark, [("FRY15", "d", "9", "9", "Z", "z", "300")])
    sink.append_batch(extra.select(*reversed(extra.columns)), table)
    row = spark.table(table).where("ingest_timestamp = '300'").first()
    assert (row.seriesid, row.aod, row.item_mdrm, row.item_value) == ("FRY15", "d", "Z", "z")


def test_append_refuses_unknown_columns_and_merge_adds_them(spark, table):
    extra = narrow(spark, [("FRY15", "d", "9", "9", "Z", "z", "300")]).withColumn("loader", F.lit(2))
    with pytest.raises(ValueError, match="loader"):
        sink.append_batch(extra, table)
    assert sink.append_merge_schema(extra, table) == ["loader"]
    assert {r.loader for r in spark.table(table).collect()} == {None, 2}


def test_create_then_append(spark, database):
    name = f"{database}.t"
    assert sink.create_or_append(sample(spark), name) == "created"
    assert sink.create_or_append(sample(spark), name) == "appended"
    assert spark.table(name).count() == 14


def test_properties(spark, table):
    sink.set_table_properties(spark, table, {"owner's": "a'b\\c"})
    found = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    assert found["owner's"] == "a'b\\c"


def test_old_ingests_are_dropped_whole(spark, table):
    assert sorted(sink.drop_old_ingests(spark, table, "200"))[0] == "seriesid=FRY15/ingest_timestamp=100"
    assert {r.ingest_timestamp for r in spark.table(table).collect()} == {"200"}


def test_copy_is_counted_and_renamed(spark, database, table, tmp_path):
    copy = f"{database}.copy"
    assert sink.ctas_verify_counts(spark, table, copy, path=str(tmp_path / "copy")) == 7
    sink.rename_table(spark, copy, copy + "_2")
    assert spark.table(copy + "_2").count() == 7
    with pytest.raises(ValueError, match="managed"):
        sink.rename_table(spark, table, table + "_2")


def test_renamed_columns_keep_partitions(spark, database, table):
    sink.rename_columns(spark, table, f"{database}.renamed", {"seriesid": "series_id", "item_value": "val"})
    columns = {c.name: c.isPartition for c in spark.catalog.listColumns(f"{database}.renamed")}
    assert columns["series_id"] and columns["ingest_timestamp"] and not columns["val"]


def test_upsert_touches_only_changed_partitions(spark, tmp_path):
    path = str(tmp_path / "wide")
    rows = narrow(
        spark, [("S", "d1", "1", "1", "A", "1", "1"), ("S", "d1", "2", "1", "A", "2", "1"), ("S", "d2", "1", "1", "A", "3", "1")]
    )
    sink.write_parquet(pivots.pivot_encoded(rows), path, partition_by=["aod"])
    before = sorted(p.name for p in (tmp_path / "wide" / "aod=d2").iterdir())
    changed = pivots.pivot_encoded(narrow(spark, [("S", "d1", "2", "1", "A", "8", "2"), ("S", "d1", "2", "1", "N", "9", "2")]))
    sink.upsert_wide(changed, path, keys=KEYS, partition_by=["aod"])
    wide = sink.read_stored(spark, path)
    assert sorted((r.aod, r.rssdid, r.A, r.N) for r in wide.collect()) == [
        ("d1", "1", "1", None), ("d1", "2", "8", "9"), ("d2", "1", "3", None),
    ]
    assert sorted(p.name for p in (tmp_path / "wide" / "aod=d2").iterdir()) == before


def test_upsert_with_null_keys_and_numeric_looking_partitions(spark, tmp_path):
    path = str(tmp_path / "wide")
    rows = narrow(spark, [("S", "0123", "1", None, "A", "1", "1"), ("S", "0456", "1", "1", "A", "2", "1")])
    sink.write_parquet(pivots.pivot_encoded(rows), path, partition_by=["aod"])
    changed = pivots.pivot_encoded(narrow(spark, [("S", "0123", "1", None, "A", "5", "1")]))
    sink.upsert_wide(changed, path, keys=KEYS, partition_by=["aod"])
    found = sink.read_stored(spark, path)
    assert sorted((r.aod, r.A) for r in found.collect()) == [("0123", "5"), ("0456", "2")]


def test_filing_refresh_equals_rebuild(spark, tmp_path):
    rows = sample(spark).unionByName(
        narrow(spark, [("FRY9C", "20230430", "1", "1", "NEW", "4", "200"), ("FR2004A", "d", "1", "1", "A", "4", "200")])
    )
    early, late = rows.where("ingest_timestamp = '100'"), rows.where("ingest_timestamp = '200'")
    refresh.refresh_series(early, str(tmp_path / "a"), ["FRY9C", "FRY15"])
    for _ in range(2):
        refresh.refresh_filings(late, str(tmp_path / "a"))
    refresh.refresh_series(rows, str(tmp_path / "b"), ["FRY9C", "FRY15", "FR2004A"])
    for series in ("FRY9C", "FRY15", "FR2004A"):
        a, b = (refresh.read_wide(spark, str(tmp_path / x), series) for x in "ab")
        assert sorted(a.columns) == sorted(b.columns)
        assert sets.compare_outputs(a.select(*b.columns), b).isEmpty()


def test_summary_refresh_replaces_only_given_series(spark, tmp_path):
    path, rows = str(tmp_path / "s"), sample(spark)
    refresh.refresh_summary(agg.filing_summary(rows), path)
    grown = rows.unionByName(rows)
    refresh.refresh_summary(agg.filing_summary(grown), path, series=["FRY15"])
    counts = {(r.seriesid, str(r.rssdid)): r.record_count for r in spark.read.parquet(path).collect()}
    assert counts[("FRY15", "1")] == 2 and counts[("FRY9C", "1")] == 3


def test_hot_partition_is_written_by_several_tasks(spark, tmp_path):
    rows = spark.range(0, 400_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, "rare").otherwise("hot").alias("p"), F.sha2(F.col("id").cast("string"), 256).alias("v")
    )
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "2m")
    try:
        sink.write_parquet(rows, str(tmp_path / "t"), partition_by=["p"])
    finally:
        spark.conf.set(key, old)
    files = [p for p in (tmp_path / "t" / "p=hot").iterdir() if p.name.startswith("part-")]
    assert len(files) > 2
    assert spark.read.parquet(str(tmp_path / "t")).count() == 400_000


# ---------------------------------------------------------------- views


def test_normal_views(spark, database, table):
    status = publish.publish_normal(spark, table, "FRY9C", database=database)
    assert {r.status for r in status.collect()} == {"created"}
    assert spark.table(f"{database}.collections_data_vw").count() == 7
    # the exact name, not the prefix
    assert {r.seriesid for r in spark.table(f"{database}.one_series_vw").collect()} == {"FRY9C"}
    assert "PartitionFilters: [isnotnull(seriesid" in plan(spark.table(f"{database}.one_series_vw"))


def test_wide_views_and_status(spark, database, table):
    status = {r.series: r for r in publish.publish_wide(spark, table, database=database).collect()}
    assert {s: r.status for s, r in status.items()} == {
        "FRY9C": "created", "FRY15": "created", "FRY9CX": "created", "OTHER": "skipped",
    }
    view = spark.table(f"{database}.fry9c_wide_view")
    direct = pivots.pivot_encoded(sample(spark), "FRY9C")
    assert view.columns == direct.columns
    assert sets.compare_outputs(view, direct).isEmpty()


def test_the_caller_chooses_views_or_tables(spark, database, table):
    first = publish.publish_wide(spark, table, database=database)
    second = publish.publish_wide(spark, table, database=database, kind="table")
    third = publish.publish_wide(spark, table, database=database, kind="table")
    kinds = [{r.kind for r in s.collect() if r.kind} for s in (first, second, third)]
    assert kinds == [{"view"}, {"table"}, {"table"}]
    wide = spark.table(f"{database}.fry9c_wide_view")
    assert sets.compare_outputs(wide, pivots.pivot_encoded(sample(spark), "FRY9C")).isEmpty()
    publish.publish_wide(spark, table, database=database)
    assert spark.catalog.getTable(f"{database}.fry9c_wide_view").tableType == "VIEW"


def test_kinds_by_series(spark, database, table):
    status = publish.publish_wide(spark, table, database=database, kind={"FRY9C": "table"})
    kinds = {r.series: r.kind for r in status.collect() if r.kind}
    assert kinds == {"FRY9C": "table", "FRY15": "view", "FRY9CX": "view"}
    with pytest.raises(ValueError, match="unknown kind"):
        publish.publish_wide(spark, table, database=database, kind="snapshot")


def test_a_wide_series_stays_a_view_that_follows_its_table(spark, database):
    name = f"{database}.many"
    rows = [("FRY9C", "d", "1", "1", f"C{n:03d}", str(n), "1") for n in range(601)]
    sink.create_partitioned(narrow(spark, rows), name)
    (status,) = publish.publish_wide(spark, name, database=database).collect()
    assert (status.kind, status.n_columns) == ("view", 605)
    sink.append_batch(narrow(spark, [("FRY9C", "d", "2", "1", "C000", "7", "2")]), name)
    assert spark.table(f"{database}.fry9c_wide_view").count() == 2


def test_rows_without_a_series_are_reported(spark, database):
    name = f"{database}.blank"
    rows = [("FRY9C", "d", "1", "1", "A", "1", "1"), (None, "d", "1", "1", "A", "1", "1"), ("", "d", "1", "1", "A", "1", "1")]
    sink.create_partitioned(narrow(spark, rows), name)
    status = {r.series: r.status for r in publish.publish_wide(spark, name, database=database).collect()}
    assert status == {"FRY9C": "created", None: "skipped"}


def test_views_follow_the_table(spark, database, table):
    publish.publish_wide(spark, table, database=database)
    sink.append_batch(narrow(spark, [("FRY9C", "20230131", "3", "1", "A", "4", "300")]), table)
    assert spark.table(f"{database}.fry9c_wide_view").where("rssdid = '3'").first().A == "4"


def test_odd_codes_and_series_in_view_text(spark, database):
    name = f"{database}.odd"
    codes = ["it's", "back\\slash", "tick`", "a.b"]
    rows = [("FRY9C's", "d", "1", "1", c, str(n), "1") for n, c in enumerate(codes)]
    sink.create_partitioned(narrow(spark, rows), name)
    status = publish.publish_wide(spark, name, database=database, name_fn=lambda s: "odd_view").first()
    assert status.status == "created", status.error
    got = spark.table(f"{database}.odd_view").first().asDict()
    assert {c: got[c] for c in codes} == {c: str(n) for n, c in enumerate(codes)}


def test_one_failure_does_not_stop_the_others(spark, database):
    name = f"{database}.mixed"
    rows = [("FRY9C", "d", "1", "1", c, "1", "1") for c in ("Ab", "aB")] + [("FRY15", "d", "1", "1", "A", "1", "1")]
    sink.create_partitioned(narrow(spark, rows), name)
    status = {r.series: r for r in publish.publish_wide(spark, name, database=database).collect()}
    assert status["FRY15"].status == "created"
    assert status["FRY9C"].status == "failed" and "told apart" in status["FRY9C"].error


def test_two_series_of_one_name_are_refused(spark, database):
    name = f"{database}.cased"
    rows = [("FRY9Ca", "d", "1", "1", "A", "1", "1"), ("FRY9CA", "d", "1", "1", "A", "1", "1")]
    sink.create_partitioned(narrow(spark, rows), name)
    with pytest.raises(publish.NameCollision):
        publish.publish_wide(spark, name, database=database)


def test_report_views_and_tables(spark, database):
    rows = spark.createDataFrame(
        [("click", "d", "1", "1", "K", 9.0, "1"), ("click", "d", "1", "1", "K", 10.0, "1")],
        "seriesid string, aod string, rssdid string, submissionts string, key string, value double, ingest_timestamp string",
    )
    sink.create_partitioned(rows, f"{database}.kv")
    publish.publish_report(spark, f"{database}.kv", database=database)
    assert spark.table(f"{database}.click_report_view").first().K == 10.0
    status = publish.materialise_wide(spark, f"{database}.kv", "entity_table", database=database).first()
    assert (status.kind, status.n_columns) == ("table", 5)
    assert spark.table(f"{database}.entity_table_click").first().K == 10.0


def test_latest_and_as_of_views(spark, database, table):
    publish.publish_latest(spark, table, f"{database}.collections_latest")
    publish.publish_as_of(spark, table, f"{database}.collections_asof", "100")
    view = spark.table(f"{database}.collections_latest")
    direct = latest.latest_submission(spark.table(table))
    assert view.columns == direct.columns
    assert sets.compare_outputs(view, direct).isEmpty()
    assert spark.table(f"{database}.collections_asof").count() == 6
    assert "ingest_timestamp" in plan(spark.table(f"{database}.collections_asof")).split("PartitionFilters")[1].split("\n")[0]


def test_listing_and_dropping_views(spark, database, table):
    publish.publish_wide(spark, table, database=database)
    assert {r.view_name for r in publish.list_views(spark, database, "fry9*").collect()} == {
        "fry9c_wide_view", "fry9cx_wide_view",
    }
    assert publish.drop_views(spark, "fry9c", database) == ["fry9c_wide_view", "fry9cx_wide_view"]
    assert publish.list_views(spark, database).count() == 1


def test_view_checks_find_a_stale_table(spark, database, table):
    publish.publish_wide(spark, table, database=database, kind={"FRY15": "table"})
    spark.sql(f"CREATE VIEW {database}.stray_wide_view AS SELECT 'FRY9C' seriesid, 'd' aod, 'x' rssdid, '1' submission_ts, '1' A")
    report = publish.check_views(spark, table, database=database, like="*_wide_view").collect()
    failed = {(r.view, r.check) for r in report if not r.passed}
    assert failed == {("stray_wide_view", "joins")}
    assert {r.view for r in report} >= {"fry15_wide_view", "fry9c_wide_view"}


# ---------------------------------------------------------------- operators


def test_series_rules(spark):
    values = ["FRY9C", "FRY9CX", "XFRY9C", "", "  ", None, "FR2004A", "fry15"]
    frame = spark.createDataFrame([(v,) for v in values], "seriesid string")
    assert [r[0] for r in flt.valid_series(frame).collect()] == ["FRY9C", "FRY9CX", "FR2004A"]
    reasons = {r.seriesid: r.reason for r in flt.rejected_rows(frame).collect()}
    assert reasons == {
        "XFRY9C": "unknown series", "": "blank series", "  ": "unknown series",
        None: "null series", "fry15": "unknown series",
    }
    counts = agg.validity_counts(frame).first()
    assert (counts.total_rows, counts.valid_rows, counts.invalid_rows) == (8, 3, 5)
    other = spark.createDataFrame([(1,)], "x int")
    assert flt.valid_series(other).count() == 1 and flt.rejected_rows(other).count() == 0


def test_latest_takes_one_whole_row(spark):
    rows = narrow(
        spark,
        [
            ("S", "d", "1", "1", "A", "99", "900"),
            ("S", "d", "1", "2", "A", None, "100"),
            ("S", "d", "1", "2", "A", "5", "100"),
            ("S", "d", "1", None, "A", "6", "100"),
            ("S", "d", "1", "1", None, "7", "100"),
        ],
    )
    got = {(r.item_mdrm, r.submission_ts, r.item_value, r.ingest_timestamp) for r in latest.latest_submission(rows).collect()}
    assert got == {("A", "2", "5", "100"), (None, "1", "7", "100")}


def test_compare_counts_repeated_rows(spark):
    a = spark.createDataFrame([("x",), ("x",), (None,)], "v string")
    b = spark.createDataFrame([("x",), (None,), ("y",)], "v string")
    got = {(r.v, r.left_rows, r.right_rows) for r in sets.compare_outputs(a, b).collect()}
    assert got == {("x", 2, 1), ("y", 0, 1)}


def test_filing_check_finds_lost_and_repeated_filings(spark):
    rows = sample(spark).where("seriesid = 'FRY9C'")
    wide = pivots.pivot_encoded(rows)
    assert quality.filing_row_check(wide, rows).isEmpty()
    one = wide.where("rssdid = '2'")
    got = {(r.rssdid, r.wide_rows) for r in quality.filing_row_check(one.unionByName(one), rows).collect()}
    assert got == {("2", 2), ("1", 0)}


def test_quality_guards(spark):
    rows = sample(spark)
    assert quality.all_string_columns(rows) == []
    assert quality.all_string_columns(rows.withColumn("n", F.lit(1))) == ["n"]
    assert quality.duplicate_items(rows).count() == 1
    with pytest.raises(ValueError, match="empty"):
        quality.non_empty(rows.where("false"))
    assert quality.non_empty(rows) is rows


def test_report_lengths(spark):
    long = spark.createDataFrame([tuple("é" * 5000 for _ in prj.REPORT_LENGTHS)], ", ".join(f"{c} string" for c in prj.REPORT_LENGTHS))
    row = prj.report_items(long).first()
    assert (len(row.filing_id), len(row.item_mdrm), len(row.item_value)) == (250, 8, 4000)
    assert row.submission_datetime is None and len(row.as_of_date) == 5000


def test_code_assignment_cycles(spark):
    codes = spark.createDataFrame([("c",), ("a",), ("b",)], "code string")
    got = joins.assign_codes(spark.range(7), codes, row_id=F.col("id"), order="code")
    assert [r.code for r in got.orderBy("id").collect()] == ["a", "b", "c", "a", "b", "c", "a"]
    with pytest.raises(ValueError):
        joins.assign_codes(spark.range(7), codes.where("false"), row_id=F.col("id"), order="code")


def test_many_codes_are_numbered_without_one_task(spark):
    codes = spark.range(20_000).select(F.format_string("C%05d", F.lit(19_999) - F.col("id")).alias("code"))
    got = joins.assign_codes(spark.range(40_000), codes, row_id=F.col("id"), order="code")
    wrong = got.where(F.col("code") != F.format_string("C%05d", F.col("id") % 20_000))
    assert got.count() == 40_000 and wrong.isEmpty()


def test_a_dictionary_is_not_forced_on_all_tasks_and_multiplies_no_row(spark):
    rows = sample(spark)
    names = spark.createDataFrame([("A", "first"), ("A", "again"), ("B", "second")], "item_mdrm string, item_desc string")
    found = joins.item_desc_lookup(rows, names)
    assert found.count() == rows.count()
    assert {r.item_desc for r in found.collect()} == {"first", "second", None}
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in plan(joins.item_desc_lookup(rows, names))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_ingest_times_compare_as_numbers(spark):
    rows = narrow(spark, [("S", "d", "1", "1", "A", "1", t) for t in ("999999999", "1770609249", "unknown")])
    assert {r.ingest_timestamp for r in latest.as_of_ingest(rows, "1770609249").collect()} == {"999999999", "1770609249"}
    assert {r.ingest_timestamp for r in latest.as_of_ingest(rows, "1000000000").collect()} == {"999999999"}


def test_partitions_must_be_keys(spark, tmp_path):
    wide = pivots.pivot_encoded(sample(spark), "FRY9C")
    for merge in (sink.upsert_wide, sink.merge_wide):
        with pytest.raises(ValueError, match="no keys"):
            merge(wide, str(tmp_path / "w"), keys=KEYS, partition_by=["A"])


def test_a_refresh_reads_the_batch_and_the_touched_dates_only(spark, tmp_path):
    path = str(tmp_path / "wide")
    rows = narrow(spark, [("S", f"d{n}", "1", "1", "A", "5", "1") for n in range(6)])
    sink.merge_wide(pivots.pivot_encoded(rows), path, keys=KEYS, partition_by=["aod"])
    before = versions.current(spark, path).folders
    late = narrow(spark, [("S", "d3", "1", "1", "A", "9", "2"), ("S", "d3", "1", "1", "N", "1", "2")])
    sink.merge_wide(pivots.pivot_encoded(late), path, keys=KEYS, partition_by=["aod"])
    after = versions.current(spark, path).folders
    assert {part for part in after if after[part] != before[part]} == {"aod=d3"}
    assert set(sink.stored_schema(spark, path).names) == {*KEYS, "A", "N"}
    rows = sink.read_stored(spark, path)
    where = sink._touched(pivots.pivot_encoded(late), ["aod"])
    assert "aod" in plan(rows.where(where)).split("PartitionFilters")[1].split("\n")[0]
    got = {(r.aod, r.A, r.N) for r in rows.collect()}
    assert ("d3", "9", "1") in got and ("d1", "5", None) in got and len(got) == 6


@pytest.mark.parametrize("kill", ["before the record", "half a record", "before clearing"])
def test_a_merge_that_dies_leaves_old_or_new_rows_and_can_be_run_again(spark, tmp_path, monkeypatch, kill):
    """The process is lost at each step between the first file written and the last old one deleted."""
    path = str(tmp_path / "wide")
    rows = narrow(spark, [("S", f"d{n}", str(f), "1", "A", "5", "1") for n in range(3) for f in range(3)])
    late = narrow(spark, [("S", "d1", "1", "1", "A", "9", "2"), ("S", "d1", "7", "1", "N", "1", "2")])
    sink.merge_wide(pivots.pivot_encoded(rows), path, keys=KEYS, partition_by=["aod"])

    def seen():
        found = sink.read_stored(spark, path)
        return {(r.aod, r.rssdid, r.A) for r in found.collect()}

    old = seen()
    create = versions.Store.create

    def dies(store, name, text):
        if kill == "half a record":
            create(store, name, text[: len(text) // 2])
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        if kill == "before clearing":
            patch.setattr(versions, "_clear", lambda store: dies(store, "", ""))
        else:
            patch.setattr(versions.Store, "create", dies)
        with pytest.raises(RuntimeError, match="driver lost"):
            sink.merge_wide(pivots.pivot_encoded(late), path, keys=KEYS, partition_by=["aod"])
    new = {*(old - {("d1", "1", "5")}), ("d1", "1", "9"), ("d1", "7", None)}
    assert seen() == (new if kill == "before clearing" else old)
    for _ in range(4):
        sink.merge_wide(pivots.pivot_encoded(late), path, keys=KEYS, partition_by=["aod"])
        assert seen() == new
    # Only the folders of the last two states stay, and those of writers that may be at work.
    named = {f for f in versions.current(spark, path).folders.values()}
    assert len(list((tmp_path / "wide").glob("narrowlake_version=*"))) <= len(named) + 2


def test_two_writers_can_not_switch_from_one_state(spark, tmp_path):
    path = str(tmp_path / "wide")
    wide = pivots.pivot_encoded(narrow(spark, [("S", "d1", "1", "1", "A", "5", "1")]))
    sink.store_wide(wide, path, partition_by=["aod"])
    base = versions.current(spark, path)
    versions.switch(wide.withColumn("A", F.lit("6")), path, ["aod"], base=base)
    with pytest.raises(versions.VersionTaken):
        versions.switch(wide.withColumn("A", F.lit("7")), path, ["aod"], base=base)
    assert [r.A for r in sink.read_stored(spark, path).collect()] == ["6"]


def test_a_reader_that_has_planned_finishes_its_scan(spark, tmp_path):
    path = str(tmp_path / "wide")
    wide = pivots.pivot_encoded(narrow(spark, [("S", "d1", "1", "1", "A", "5", "1")]))
    sink.store_wide(wide, path, partition_by=["aod"])
    planned = sink.read_stored(spark, path)
    sink.store_wide(wide.withColumn("A", F.lit("6")), path, partition_by=["aod"])
    assert [r.A for r in planned.collect()] == ["5"]
    assert [r.A for r in sink.read_stored(spark, path).collect()] == ["6"]


def test_a_table_is_replaced_only_when_its_rows_are_written(spark, database, tmp_path):
    wide = pivots.pivot_encoded(narrow(spark, [("S", "d1", "1", "1", "A", "5", "1")]))
    for path in (None, str(tmp_path / "w")):
        table = f"{database}.replaced_{'b' if path else 'a'}"
        for value in "567":
            rows = wide.withColumn("A", F.lit(value)).withColumn(f"N{value}", F.lit("1"))
            sink.replace_wide_table(rows, table, partition_by=["aod"], path=path)
            assert [r.A for r in spark.table(table).collect()] == [value]
            assert f"N{value}" in spark.table(table).columns
        broken = wide.withColumn("A", F.raise_error(F.lit("lost")))
        with pytest.raises(Exception, match="lost"):
            sink.replace_wide_table(broken, table, partition_by=["aod"], path=path)
        assert [r.A for r in spark.table(table).collect()] == ["7"]


def test_few_shuffles_in_checks_and_groups(spark, table):
    rows = flt.by_series(spark.table(table), "FRY9C")

    def shuffles(frame):
        tree = plan(frame).split("\n\n")[0]
        return tree.count("Exchange (") - tree.count("BroadcastExchange (")

    assert shuffles(quality.filing_row_check(pivots.pivot_encoded(rows, items=["A", "B"]), rows)) == 2
    wide, groups = pivots.pivot_by_group(spark.table(table), "FRY9C", prefix_length=1)
    assert set(groups) == {"A", "B"} and shuffles(wide) == 1


# ---------------------------------------------------------------- plans


def test_partition_filter_and_columns_reach_the_scan(spark, table):
    text = plan(flt.by_partition(spark.table(table), "FRY9C", "100").select("rssdid"))
    assert "ReadSchema: struct<rssdid:string>" in text
    assert "PartitionFilters: [isnotnull(seriesid" in text and "ingest_timestamp" in text


def test_filing_filter_on_a_view_reaches_the_scan_and_unused_items_do_not(spark, database, table):
    publish.publish_wide(spark, table, database=database)
    view = spark.table(f"{database}.fry9c_wide_view")
    text = plan(flt.by_as_of(view, "20230131").select("rssdid", "A"))
    assert "PushedFilters: [IsNotNull(aod), EqualTo(aod,20230131)]" in text
    assert text.count("max(") + text.count("max (") >= 1
    assert "= B" not in text


@pytest.mark.parametrize("form, shuffles", [("case", 1), ("block", 2)])
def test_shuffles_of_a_pivot(spark, table, form, shuffles):
    text = plan(pivots.pivot_encoded(spark.table(table), "FRY9C", items=["A", "B"], form=form))
    assert text.split("\n\n")[0].count("Exchange (") - text.split("\n\n")[0].count("BroadcastExchange (") == shuffles


def test_latest_has_no_window(spark, table):
    text = plan(latest.latest_submission(spark.table(table)))
    assert "Window" not in text and "partial_max" in text


def test_no_cross_join_in_any_query(spark):
    import __spark_entry__ as entry_point

    from narrowlake.registry import QUERIES

    assert set(QUERIES) <= set(entry_point.queries())
    for name in ("cross_series_join", "entity_view_join", "items_schedule_join", "wide_by_group", "one_row_per_filing", "code_assignment", "item_desc_lookup"):
        text = plan(QUERIES[name](spark, "/root/testdata/sf0.001"))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_kv_roles_have_no_context(spark):
    assert KV.columns == ("seriesid", "aod", "rssdid", "submissionts", "key", "value")
    assert COLLECTIONS.columns[4:7] == ("item_mdrm", "item_desc", "item_value")


def test_narrow_writes_do_not_sort_rows_by_partition(spark, tmp_path):
    rows = spark.range(1000).selectExpr("'FRY9C' AS seriesid", "cast(id % 7 AS string) AS ingest_timestamp", "id")
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    with sink.open_files(spark):
        with sink.open_files(spark):
            rows.write.partitionBy("ingest_timestamp").parquet(str(tmp_path / "in"))
        assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == str(sink.OPEN_FILES)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    seen = []
    writer = type(rows.write)
    kept, writer.saveAsTable = writer.saveAsTable, lambda self, name, *a, **b: seen.append(
        spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    )
    try:
        sink.create_partitioned(rows, "never_made")
    finally:
        writer.saveAsTable = kept
    assert seen == [str(sink.OPEN_FILES)]
    assert sorted(r[0] for r in spark.read.parquet(str(tmp_path / "in")).select("id").collect()) == list(range(1000))


def test_report_is_distinct_over_cut_ids_and_joined_rows_are_not_shuffled_again(spark):
    from narrowlake.operators.joins import items_schedule_join
    from narrowlake.operators.projections import REPORT_LENGTHS, report_items

    ids = ["a", "a", "b", "x" * 249, "x" * 250, "x" * 250 + "y", "x" * 250 + "z", "x" * 260]
    columns = [c for c in REPORT_LENGTHS if c not in ("filing_id", "schedule_id")]
    rows = spark.createDataFrame([(i,) for i in ids], "filing_id string")
    rows = rows.withColumns({c: F.lit("2024-01-01" if c == "submission_datetime" else "v") for c in columns})
    schedule = spark.createDataFrame([(i, "s") for i in sorted(set(ids))], "filing_id string, schedule_id string")
    joined = items_schedule_join(rows.hint("merge"), schedule)
    report = report_items(joined)
    assert sorted(r["filing_id"] for r in report.collect()) == ["a", "b", "x" * 249, "x" * 250]
    assert report.columns == list(REPORT_LENGTHS)
    executed = report._jdf.queryExecution().executedPlan().toString()
    first = executed.split("== Initial Plan ==")[-1].split("Union")[1]
    branches = first.split("SortMergeJoin")
    assert "Exchange" not in branches[0]
    # A filing without an id, which no join leaves, is a row too.
    lone = rows.limit(1).withColumn("filing_id", F.lit(None).cast("string")).withColumn("schedule_id", F.lit("s"))
    assert report_items(lone).count() == 1
