"""Relations kept up load by load, packing of loads, comparison by checksums."""

import pytest
from pyspark.sql import functions as F

from narrowlake.model import COLLECTIONS, KV
from narrowlake.operators import aggregates as agg
from narrowlake.operators import latest, pivots, sets
from narrowlake.plans import compact, derived, publish, refresh
from narrowlake.plans import ingest as loads
from narrowlake.sinks import tables as sink
from narrowlake.sinks import versions
from test_tables import KEYS, database, narrow, plan, sample, table  # noqa: F401


def read_dates(frame):
    """As-of dates of the files that a plan reads."""
    return {f.split("aod=")[1].split("/")[0] for f in frame.inputFiles()}


def test_kept_latest_equals_the_latest_of_all_rows(spark, tmp_path):
    path, rows = str(tmp_path / "latest"), sample(spark)
    later = narrow(spark, [("FRY9C", "20230131", "2", "9", "B", "1", "300"), ("FRY9C", "20230430", "2", "1", "B", None, "300")])
    for part in (rows.where("ingest_timestamp = '200'"), rows.where("ingest_timestamp = '100'"), later, later):
        derived.merge_latest(part, path)
    want = latest.latest_submission(rows.unionByName(later))
    got = derived.read_latest(spark, path)
    assert sets.compare_outputs(got.select(*want.columns), want).isEmpty()


@pytest.mark.parametrize("kill", ["create", "_clear"])
def test_a_load_that_dies_can_be_merged_again(spark, tmp_path, monkeypatch, kill):
    path, rows = str(tmp_path / "state"), sample(spark)
    early, late = rows.where("ingest_timestamp = '100'"), rows.where("ingest_timestamp = '200'")
    derived.merge_summary(early, path, "a", COLLECTIONS)

    def dies(*args):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(versions.Store if kill == "create" else versions, kill, dies)
        with pytest.raises(RuntimeError, match="driver lost"):
            derived.merge_summary(late, path, "b", COLLECTIONS)
    derived.merge_summary(late, path, "b", COLLECTIONS)
    want = agg.daily_summary(rows, COLLECTIONS)
    got = derived.kept_summary(spark, path, COLLECTIONS)
    assert sets.compare_outputs(got.select(*want.columns), want).isEmpty()
    derived.fold_loads(spark, path, ["a", "b"], COLLECTIONS)
    assert sets.compare_outputs(derived.kept_summary(spark, path, COLLECTIONS).select(*want.columns), want).isEmpty()


def test_a_summary_load_touches_its_days_only(spark, tmp_path):
    path = str(tmp_path / "state")
    rows = narrow(spark, [("S", f"2023010{n}", "1", "1", "RCON1", "5", "1") for n in range(1, 7)])
    derived.merge_summary(rows, path, "a", COLLECTIONS)
    before = versions.current(spark, path).folders
    derived.merge_summary(rows.where("aod = '20230103'"), path, "b", COLLECTIONS)
    after = versions.current(spark, path).folders
    assert {p for p in after if after[p] != before[p]} == {"aod=20230103"}
    counts = {str(r.report_date): (r.total_records, r.institution_count) for r in derived.kept_summary(spark, path, COLLECTIONS).collect()}
    assert counts["2023-01-03"] == (2, 1) and counts["2023-01-04"] == (1, 1)


def test_kept_codes_serve_publishing_without_a_scan_of_the_table(spark, database, tmp_path):  # noqa: F811
    path, rows = str(tmp_path / "codes"), sample(spark)
    for _ in range(2):
        for time in ("100", "200"):
            derived.merge_codes(rows.where(F.col("ingest_timestamp") == time), path)
    codes = derived.read_codes(spark, path)
    assert sorted(map(tuple, codes.collect())) == sorted(map(tuple, rows.select("seriesid", "item_mdrm").distinct().collect()))
    name = f"{database}.collections_data_tbl"
    sink.create_partitioned(rows, name)
    status = publish.publish_wide(spark, name, database=database, codes=codes)
    plain = publish.publish_wide(spark, name, database=database)
    same = ["name", "series", "kind", "n_columns", "status"]
    assert sorted(map(tuple, status.select(same).collect()), key=str) == sorted(map(tuple, plain.select(same).collect()), key=str)
    # What publishing asked the table for names no item column: discovery reads the kept codes.
    assert "collections_data_tbl" not in " ".join(codes.inputFiles())


def test_retention_reaches_wide_relations(spark, database, tmp_path):  # noqa: F811
    rows = narrow(
        spark,
        [
            ("FRY9C", "d1", "1", "1", "A", "9", "100"),
            ("FRY9C", "d1", "1", "1", "A", "5", "200"),
            ("FRY9C", "d1", "2", "1", "B", "7", "100"),
            ("FRY9C", "d2", "1", "1", "A", "1", "100"),
            ("FRY9C", "d3", "1", "1", "A", "1", "200"),
            ("FRY15", "d3", "1", "1", "C", "1", "200"),
        ],
    )
    name, root = f"{database}.kept", str(tmp_path / "wide")
    sink.create_partitioned(rows, name)
    refresh.refresh_series(spark.table(name), root, ["FRY9C", "FRY15"])
    before = versions.current(spark, refresh.wide_path(root, "FRY9C")).folders
    untouched = versions.current(spark, refresh.wide_path(root, "FRY15"))

    # A run that dies before the partitions are dropped is run again.
    dropped = derived.drop_old_ingests
    try:
        derived.drop_old_ingests = lambda *a: (_ for _ in ()).throw(RuntimeError("driver lost"))
        with pytest.raises(RuntimeError, match="driver lost"):
            derived.retain(spark, name, "200", root)
    finally:
        derived.drop_old_ingests = dropped
    assert derived.retain(spark, name, "200", root) == ["seriesid=FRY9C/ingest_timestamp=100"]
    wide = refresh.read_wide(spark, root, "FRY9C")
    want = pivots.pivot_encoded(spark.table(name), "FRY9C")
    assert sets.compare_outputs(wide.select(*want.columns), want).isEmpty() and wide.count() == 2
    after = versions.current(spark, refresh.wide_path(root, "FRY9C")).folders
    assert set(after) == {"aod=d1", "aod=d3"} and after["aod=d3"] == before["aod=d3"]
    assert versions.current(spark, refresh.wide_path(root, "FRY15")) == untouched
    assert derived.retain(spark, name, "200", root) == []


def test_checksums_find_what_the_whole_comparison_finds(spark):
    left = sample(spark).unionByName(sample(spark).where("rssdid = '2'"))
    changed = F.when((F.col("rssdid") == "1") & (F.col("item_mdrm") == "C"), "4").otherwise(F.col("item_value"))
    right = sample(spark).withColumn("item_value", changed)
    for keys in (KEYS, ["rssdid"]):
        want = sets.compare_outputs(left, right)
        got = sets.compare_by_checksum(left, right.select(*reversed(right.columns)), keys, buckets=64)
        found = sorted(map(str, got.select(*want.columns).collect()))
        assert found == sorted(map(str, want.collect())) and len(found) == 3
    assert sets.compare_by_checksum(left, left, KEYS).isEmpty()
    # Rows are summed up before anything is shuffled.
    told = plan(sets.unequal_buckets(left, right, KEYS))
    assert "partial_sum" in told and "item_value" not in told.split("Exchange")[-1].split("\n")[0]


def stored_loads(spark, root, n):
    target = str(root / "data")
    for load in range(n):
        rows = narrow(spark, [("FRY9C", "d", str(load), "1", f"A{k}", "5", t) for k in range(3) for t in ("100", "200")])
        loads.write_load(rows, target, f"load-{load}")
    return target


def files_of(root):
    return [p for p in root.rglob("*.parquet")]


def test_packing_bounds_files_and_keeps_rows(spark, tmp_path):
    target = stored_loads(spark, tmp_path, 5)
    before = loads.read_loaded(spark, target).collect()
    planned = loads.read_loaded(spark, target)
    schema = loads.narrow_schema()
    done = [f"load-{n}" for n in range(4)]
    assert compact.compact(spark, target, done, schema=schema) == done
    # Readers that planned before finish, readers after see the packed rows once.
    assert len(planned.collect()) == len(before)
    assert sorted(map(str, loads.read_loaded(spark, target).collect())) == sorted(map(str, before))
    compact.compact(spark, target, done, schema=schema)
    assert {p.parent.name.split("=")[1].split("-")[0] for p in files_of(tmp_path / "data")} == {"packed", "load"}
    assert len(files_of(tmp_path / "data")) == 4  # two ingests, packed and the load that is not finished
    assert sorted(map(str, loads.read_loaded(spark, target).collect())) == sorted(map(str, before))
    # The unfinished load may still be written again.
    rows = narrow(spark, [("FRY9C", "d", "4", "1", "NEW", "5", "100")])
    loads.write_load(rows, target, "load-4")
    assert loads.read_loaded(spark, target).where("item_mdrm = 'NEW'").count() == 1


def test_packing_that_dies_changes_nothing_that_counts(spark, tmp_path, monkeypatch):
    target = stored_loads(spark, tmp_path, 3)
    before = sorted(map(str, loads.read_loaded(spark, target).collect()))
    done, schema = [f"load-{n}" for n in range(3)], loads.narrow_schema()
    with monkeypatch.context() as patch:
        patch.setattr(compact.Store, "create", lambda *a: (_ for _ in ()).throw(RuntimeError("driver lost")))
        with pytest.raises(RuntimeError, match="driver lost"):
            compact.compact(spark, target, done, schema=schema)
    assert sorted(map(str, loads.read_loaded(spark, target).collect())) == before
    compact.compact(spark, target, done, schema=schema)
    compact.compact(spark, target, done, schema=schema)
    assert sorted(map(str, loads.read_loaded(spark, target).collect())) == before
    assert len(files_of(tmp_path / "data")) == 2


def test_kv_summary_of_one_load(spark, tmp_path):
    rows = spark.createDataFrame(
        [("s", "20240101", "1", "5", "RCON1", "1"), ("s", "20240101", "2", "4", "X", "1")],
        ", ".join(f"{c} string" for c in KV.columns),
    )
    derived.merge_summary(rows, str(tmp_path / "k"), "a")
    (row,) = derived.kept_summary(spark, str(tmp_path / "k")).collect()
    assert (row.institution_count, row.total_records, row.rcon_fields, row.latest_submission) == (2, 2, 1, "5")
