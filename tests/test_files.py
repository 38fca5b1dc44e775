"""Listing, sniffing, reading, loading."""

import gzip
import os
import pathlib
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from narrowlake import registry
from narrowlake.functions.files import ingest_ts, looks_like_csv
from narrowlake.model import COLLECTIONS, KV
from narrowlake.operators import filters as flt
from narrowlake.operators import sets
from narrowlake.plans import ingest as loads
from narrowlake.plans import lease, refresh
from narrowlake.sinks import tables as sink
from narrowlake.sources import csv as csv_source
from narrowlake.sources import files, generators
from narrowlake.sources import tables as table_source
from narrowlake.streaming import ingest as streams

HEADER = ",".join(COLLECTIONS.columns)


def line(series="FRY9C", item="A1", value="5", desc="x", aod="20230131"):
    return f"{series},{aod},1234567,1740000002,{item},{desc},{value}" + "," * 9


def put(root, name, content):
    path = pathlib.Path(root, name)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content if isinstance(content, bytes) else content.encode())
    return path


@pytest.fixture
def drop(tmp_path):
    put(tmp_path, "ingest_ts=100/a.csv", "\n".join([HEADER, line(), line("FRY15"), line("XYZ"), line("")]) + "\n")
    put(tmp_path, "ingest_ts=200/B.CSV", "\n".join([HEADER, line("FRY9CX", "A2", "7"), "FRY9C,short"]) + "\n")
    put(tmp_path, "ingest_ts=200/empty.csv", "")
    put(tmp_path, "ingest_ts=200/note.txt", "a,b\n")
    put(tmp_path, "ingest_ts=200/latin.csv", "a,b\n\xe9,1\n".encode("latin-1"))
    put(tmp_path, "ingest_ts=200/plain.csv", "no delimiter at all\n")
    put(tmp_path, "ingest_ts=200/blank.csv", "\na,b\n1,2\n")
    return tmp_path


def test_manifest_takes_csv_of_any_case_and_skips_empty_files(spark, drop):
    names = {r.path.rsplit("/", 1)[1] for r in files.file_manifest(spark, str(drop)).collect()}
    assert names == {"a.csv", "B.CSV", "latin.csv", "plain.csv", "blank.csv"}


@pytest.mark.parametrize("route", ["ranged", "whole"])
def test_sniff(spark, drop, route):
    found = {
        r.path.rsplit("/", 1)[1]: (r.is_csv, r.ingest_ts)
        for r in files.csv_sniff(spark, str(drop), route).collect()
    }
    assert found == {
        "a.csv": (True, "100"),
        "B.CSV": (True, "200"),
        "latin.csv": (False, "200"),
        "plain.csv": (False, "200"),
        "blank.csv": (False, "200"),
    }


def test_both_routes_mark_files_alike(spark, drop):
    marks = [
        sorted((r.path, r.length, r.sample_md5) for r in files.csv_sniff(spark, str(drop), route).collect())
        for route in ("ranged", "whole")
    ]
    assert marks[0] == marks[1]


@pytest.mark.parametrize(
    "head, ok",
    [
        (b"a;b\n", True),
        (b"a\tb\n", True),
        (b"ab\n", False),
        (b"", False),
        (None, False),
        (b"\r\na,b", False),
        (b",," + b"x" * 1021 + "é".encode()[:1], True),
        (b",," + b"x" * 1019 + "\U0001f600".encode()[:3], True),
        (b",," + b"x" * 10 + "é".encode()[:1], False),
        (b"\xff,b\n", False),
    ],
)
def test_first_bytes(spark, head, ok):
    frame = spark.createDataFrame([(head,)], "head binary")
    assert frame.select(looks_like_csv(F.col("head"))).first()[0] is ok


@pytest.mark.parametrize(
    "path, time",
    [
        ("s3://b/c/ingest_ts=1770609249/f.csv", "1770609249"),
        ("s3://b/c/f.csv", "unknown"),
        ("s3://b/my_ingest_ts=5/f.csv", "unknown"),
        ("file:/b/ingest_ts=1/ingest_ts=2/f.csv", "1"),
    ],
)
def test_ingest_time_of_path(spark, path, time):
    frame = spark.createDataFrame([(path,)], "path string")
    assert frame.select(ingest_ts(F.col("path"))).first()[0] == time


def test_strict_reader_keeps_quoting_and_drops_short_lines(spark, tmp_path):
    quoted = line(desc='"one\ntwo, ""three"""')
    put(tmp_path, "ingest_ts=1/q.csv", "\n".join([HEADER, quoted, "FRY9C,20230131"]) + "\n")
    rows = csv_source.read_csv_strict(spark, str(tmp_path)).collect()
    assert [r.item_desc for r in rows] == ['one\ntwo, "three"']
    assert rows[0].context_level1_mdrm is None


def test_short_lines_are_dropped_whatever_columns_are_read(spark, drop):
    rows = csv_source.read_csv_strict(spark, str(drop / "ingest_ts=200"))
    found = rows.where("source_file LIKE '%B.CSV'")
    assert found.count() == found.select("seriesid").count() == found.select("item_value").count() == 1
    assert len(found.collect()) == len(found.select("seriesid").collect()) == 1


def test_plain_reader_infers(spark, tmp_path):
    put(tmp_path, "k.csv", "key,value\na,1\nb,2\n")
    assert dict(csv_source.read_csv_plain(spark, str(tmp_path)).dtypes)["value"] == "int"


def test_all_text_schema_is_not_changed_by_an_odd_row(spark, tmp_path):
    put(tmp_path, "ingest_ts=1/a.csv", "\n".join([HEADER, line(value="244360"), line(value="1.5")]) + "\n")
    rows = csv_source.read_csv_strict(spark, str(tmp_path))
    assert {r.item_value for r in rows.collect()} == {"244360", "1.5"}
    inferred = csv_source.read_csv_strict(spark, str(tmp_path), infer=True)
    assert dict(inferred.dtypes)["item_value"] == "double"


def test_paths_with_special_characters(spark, tmp_path):
    root = tmp_path / "a b%c"
    put(root, "ingest_ts=1 0/x y.csv", "\n".join([HEADER, line()]) + "\n")
    table = "special_paths"
    report = loads.ingest(spark, str(root), table, table_path=str(tmp_path / "t"))
    assert report.loaded_rows == 1
    assert spark.table(table).first().ingest_timestamp == "1 0"
    spark.sql(f"DROP TABLE {table}")


def test_ingest_reports_and_keeps_refused_rows(spark, drop, tmp_path_factory):
    root = tmp_path_factory.mktemp("tables")
    report = loads.ingest(spark, str(drop), "loaded_t", reject_table="loaded_r", table_path=str(root / "t"))
    assert (report.files, report.read_rows, report.loaded_rows, report.rejected_rows) == (2, 6, 3, 3)
    assert report.action == "created"
    rows = {(r.seriesid, r.ingest_timestamp) for r in spark.table("loaded_t").collect()}
    assert rows == {("FRY9C", "100"), ("FRY15", "100"), ("FRY9CX", "200")}
    assert {r.reason for r in spark.table("loaded_r").collect()} == {"null series", "unknown series", "malformed"}
    again = loads.ingest(spark, str(drop), "loaded_t")
    assert again.action == "appended" and spark.table("loaded_t").count() == 6
    spark.sql("DROP TABLE loaded_t")
    spark.sql("DROP TABLE loaded_r")


def test_ingest_by_first_file(spark, drop):
    files_found = files.valid_files(spark, str(drop))
    rows = csv_source.read_csv_strict(spark, str(drop))
    stamped = csv_source.stamp_ingest(rows, mode="first_file", files=files_found)
    assert {r.ingest_timestamp for r in stamped.collect()} == {"100"}


def test_nothing_to_load_is_an_error(spark, tmp_path):
    put(tmp_path, "ingest_ts=1/x.txt", "a,b")
    with pytest.raises(loads.EmptyLoad):
        loads.ingest(spark, str(tmp_path), "never")
    put(tmp_path, "ingest_ts=1/x.csv", HEADER + "\n")
    with pytest.raises(loads.EmptyLoad):
        loads.ingest(spark, str(tmp_path), "never")


def test_load_new_takes_each_file_once(spark, drop, tmp_path_factory):
    root = tmp_path_factory.mktemp("narrow")
    target, ledger = str(root / "data"), str(root / "ledger")
    assert loads.load_new(spark, str(drop), target, ledger) == 2
    assert loads.load_new(spark, str(drop), target, ledger) == 0
    put(drop, "ingest_ts=300/c.csv", "\n".join([HEADER, line(value="9")]) + "\n")
    assert loads.load_new(spark, str(drop), target, ledger) == 1
    rows = loads.read_loaded(spark, target)
    assert rows.count() == 4
    assert rows.where("ingest_timestamp = '300'").first().item_value == "9"


def test_load_new_finishes_a_run_that_died(spark, drop, tmp_path_factory, monkeypatch):
    root = tmp_path_factory.mktemp("narrow")
    target, ledger = str(root / "data"), str(root / "ledger")
    append = loads._append_ledger

    def dies(files_, ledger_, load_id, state):
        if state == "loaded":
            raise RuntimeError("executor host lost")
        append(files_, ledger_, load_id, state)

    monkeypatch.setattr(loads, "_append_ledger", dies)
    with pytest.raises(RuntimeError):
        loads.load_new(spark, str(drop), target, ledger)
    monkeypatch.undo()
    put(drop, "ingest_ts=300/c.csv", "\n".join([HEADER, line(value="9")]) + "\n")
    assert loads.load_new(spark, str(drop), target, ledger) == 3
    assert loads.read_loaded(spark, target).count() == 4


def test_a_second_run_is_refused_and_a_dead_one_taken_over(spark, drop, tmp_path_factory, monkeypatch):
    root = tmp_path_factory.mktemp("narrow")
    target, ledger = str(root / "data"), str(root / "ledger")
    held = lease.Lease(spark, loads.lease_path(ledger), 3)
    held.__enter__()
    with pytest.raises(lease.LeaseHeld):
        loads.load_new(spark, str(drop), target, ledger)
    time.sleep(4)  # longer than it holds: signs of life keep it
    with pytest.raises(lease.LeaseHeld):
        loads.load_new(spark, str(drop), target, ledger)
    held._end.set()  # the process is gone: no more signs of life, nothing given back
    time.sleep(4)
    assert loads.load_new(spark, str(drop), target, ledger) == 2
    assert loads.read_loaded(spark, target).count() == 3
    # A run that ends gives the lease back at once.
    assert loads.load_new(spark, str(drop), target, ledger) == 0


def test_a_slow_run_that_was_taken_over_writes_no_more(spark, drop, tmp_path_factory, monkeypatch):
    root = tmp_path_factory.mktemp("narrow")
    target, ledger = str(root / "data"), str(root / "ledger")
    read = loads.load_files

    def slow(*args, **kw):
        monkeypatch.setattr(loads, "load_files", read)
        monkeypatch.setattr(lease.Lease, "__exit__", lambda self, *error: self._end.set())
        # Its signs of life stop; another run finishes the load.
        taken = lease.Lease(spark, loads.lease_path(ledger), 0)
        taken._store.create(f"{taken._highest()[0] + 1:012d}", '{"owner": "other", "until": 0}')
        assert loads.load_new(spark, str(drop), target, ledger) == 2
        return read(*args, **kw)

    monkeypatch.setattr(loads, "load_files", slow)
    with pytest.raises(lease.LeaseLost):
        loads.load_new(spark, str(drop), target, ledger)
    monkeypatch.undo()
    states = loads.read_ledger(spark, ledger).groupBy("state").count().collect()
    assert {r["state"]: r["count"] for r in states} == {"taken": 2, "loaded": 2}
    assert loads.read_loaded(spark, target).count() == 3


def test_only_one_of_many_takes_a_lease(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    def take(_):
        own = lease.Lease(spark, str(tmp_path / "lease"), 60)
        try:
            return own.__enter__()
        except lease.LeaseHeld:
            return None

    with ThreadPoolExecutor(1) as pool:
        found = [x for x in pool.map(take, range(6)) if x]
    assert len(found) == 1
    found[0].__exit__()


def bad_file():
    """Lines of full width in an encoding that is not accepted."""
    return "\n".join([HEADER, line("FRY9C", desc="caf\xe9")]).encode("latin-1") + b"\n"


def test_columns_are_taken_by_header(spark, tmp_path, tmp_path_factory):
    turned = [c for c in reversed(COLLECTIONS.columns)]
    values = dict(zip(COLLECTIONS.columns, line(item="B2", value="8").split(",")))
    put(tmp_path, "ingest_ts=1/a.csv", "\n".join([HEADER, line()]) + "\n")
    put(tmp_path, "ingest_ts=2/b.csv", "\n".join([",".join(["extra", *turned]), ",".join(["e", *[values[c] for c in turned]])]) + "\n")
    few = ["seriesid", "AOD", "rssdid", "submission_ts", "item_mdrm", "item_value"]
    put(tmp_path, "ingest_ts=3/c.csv", ",".join(few) + "\nFRY15,20230131,1,2,C3,9\nFRY15,too,few\n")
    put(tmp_path, "ingest_ts=4/d.csv", "seriesid,rssdid,item_mdrm,item_value\nFRY15,1,A,1\n")
    put(tmp_path, "ingest_ts=5/e.csv", HEADER + ",aod\n" + line() + ",again\n")
    root = tmp_path_factory.mktemp("narrow")
    target = str(root / "data")
    assert loads.load_new(spark, str(tmp_path), target, str(root / "ledger")) == 5
    got = {(r.ingest_timestamp, r.seriesid, r.aod, r.rssdid, r.item_mdrm, r.item_value) for r in loads.read_loaded(spark, target).collect()}
    assert got == {
        ("1", "FRY9C", "20230131", "1234567", "A1", "5"),
        ("2", "FRY9C", "20230131", "1234567", "B2", "8"),
        ("3", "FRY15", "20230131", "1", "C3", "9"),
    }
    rejects = sorted((r.reason, r.malformed_line.rsplit("/", 1)[-1]) for r in loads.read_rejects(spark, target).collect())
    assert rejects == [("malformed", "FRY15,too,few"), ("no column 'aod'", "d.csv"), ("repeated column 'aod'", "e.csv")]


@pytest.mark.parametrize("route", ["ranged", "whole"])
@pytest.mark.parametrize("way", ["batch", "stream"])
def test_headers_beyond_the_sample_are_read_whole(spark, tmp_path, tmp_path_factory, route, way):
    """A header of kilobytes, one with a line break in quotes, and one whose quotes hold commas."""
    if way == "stream" and route == "whole":
        return
    wide = [f"extra_{n:04d}_with_a_long_name" for n in range(300)]
    put(tmp_path, "ingest_ts=1/a.csv", ",".join([*wide, HEADER]) + "\n" + "e," * 300 + line(value="1") + "\n")
    broken = '"two\nlines","a, ""quoted"" name",' + HEADER
    put(tmp_path, "ingest_ts=2/b.csv", broken + "\nx,y," + line(value="2") + "\n")
    put(tmp_path, "ingest_ts=3/c.csv", HEADER + "," + '"' + "x" * 3_000 + '\n",last\r\n' + line(value="3") + ",x,y\r\n")
    put(tmp_path, "ingest_ts=4/d.csv", '"never closed,' + HEADER + "\n" + line(value="4") + "\n")
    put(tmp_path, "ingest_ts=5/e.csv", b"\xef\xbb\xbf" + HEADER.encode() + b"\n" + line(value="5").encode())
    root = tmp_path_factory.mktemp("narrow")
    target = str(root / "data")
    if way == "batch":
        loads.load_new(spark, str(tmp_path), target, str(root / "ledger"), route=route)
    else:
        streams.ingest_stream(streams.read_drop_stream(spark, str(tmp_path)), target, str(root / "c")).awaitTermination()
    assert sorted(r.item_value for r in loads.read_loaded(spark, target).collect()) == ["1", "2", "3", "5"]
    rejects = loads.read_rejects(spark, target).collect()
    assert [(r.reason, r.malformed_line.rsplit("/", 1)[-1]) for r in rejects] == [("the header does not end", "d.csv")]


@pytest.mark.parametrize("sent", [True, False])
def test_the_plan_of_a_load_holds_folders_not_files(spark, tmp_path, monkeypatch, sent):
    for n in range(40):
        put(tmp_path, f"ingest_ts=1/file_{n:03d}.csv", "\n".join([HEADER, line(item=f"A{n}")]) + "\n")
    put(tmp_path, "ingest_ts=1/more/deep.csv", "\n".join([HEADER, line(item="DEEP")]) + "\n")
    put(tmp_path, "ingest_ts=1/other.csv", "\n".join([HEADER, line(item="OTHER")]) + "\n")
    if not sent:
        monkeypatch.setattr(csv_source, "MOST_SENT", 0)
    found = files.valid_files(spark, str(tmp_path)).where("path NOT LIKE '%other.csv'")
    rows, refused = csv_source.read_by_header(spark, found)
    assert {r.item_mdrm for r in rows.collect()} == {"DEEP", *[f"A{n}" for n in range(40)]}
    assert refused.isEmpty()
    told = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "file_0" not in told and ("strategy=broadcast" in told) == sent


def test_files_that_changed_since_they_were_listed_are_not_taken_for_read(spark, tmp_path):
    path = put(tmp_path, "ingest_ts=1/a.csv", "\n".join([HEADER, line()]) + "\n")
    found = files.valid_files(spark, str(tmp_path)).persist()
    assert found.count() == 1
    os.utime(path, (path.stat().st_atime, path.stat().st_mtime + 10))
    with pytest.raises(csv_source.MissingFiles):
        csv_source.read_by_header(spark, found)


def test_extra_columns_join_the_table(spark, tmp_path, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables") / "t")
    put(tmp_path, "ingest_ts=1/a.csv", "\n".join([HEADER, line()]) + "\n")
    loads.ingest(spark, str(tmp_path / "ingest_ts=1"), "grown_t", table_path=path)
    put(tmp_path, "ingest_ts=2/b.csv", "\n".join([HEADER + ",loader", line(value="6") + ",v2"]) + "\n")
    loads.ingest(spark, str(tmp_path / "ingest_ts=2"), "grown_t", extra=True)
    assert {(r.item_value, r.loader) for r in spark.table("grown_t").collect()} == {("5", None), ("6", "v2")}
    spark.sql("DROP TABLE grown_t")


def test_a_corrected_file_is_loaded_again(spark, tmp_path, tmp_path_factory):
    """Equal name, equal length, equal first kilobyte."""
    root = tmp_path_factory.mktemp("narrow")
    target, ledger = str(root / "data"), str(root / "ledger")
    body = [HEADER, *[line(item=f"A{n:04d}") for n in range(60)]]
    path = put(tmp_path, "ingest_ts=1/a.csv", "\n".join([*body, line(item="LAST", value="5")]) + "\n")
    assert loads.load_new(spark, str(tmp_path), target, ledger) == 1
    path.write_text("\n".join([*body, line(item="LAST", value="6")]) + "\n")
    os.utime(path, (path.stat().st_atime, path.stat().st_mtime + 10))
    assert loads.load_new(spark, str(tmp_path), target, ledger) == 1
    found = loads.read_loaded(spark, target).where("item_mdrm = 'LAST'")
    assert sorted(r.item_value for r in found.collect()) == ["5", "6"]
    assert loads.load_new(spark, str(tmp_path), target, ledger) == 0


def test_a_load_without_rows_is_an_error_once(spark, tmp_path, tmp_path_factory):
    root = tmp_path_factory.mktemp("narrow")
    target, ledger = str(root / "data"), str(root / "ledger")
    put(tmp_path, "ingest_ts=1/a.csv", HEADER + "\n")
    with pytest.raises(loads.EmptyLoad):
        loads.load_new(spark, str(tmp_path), target, ledger)
    assert loads.load_new(spark, str(tmp_path), target, ledger) == 0


def test_streams_refuse_files_as_batches_do(spark, drop, tmp_path_factory):
    put(drop, "ingest_ts=400/wide_latin.csv", bad_file())
    root = tmp_path_factory.mktemp("stream")
    rows = streams.read_drop_stream(spark, str(drop))
    streams.ingest_stream(rows, str(root / "data"), str(root / "checkpoint")).awaitTermination()
    streamed = streams.read_stream_table(spark, str(root / "data"))
    loads.load_new(spark, str(drop), str(root / "batch"), str(root / "ledger"))
    assert streamed.where("ingest_timestamp = '400'").isEmpty()
    assert sets.compare_outputs(streamed, loads.read_loaded(spark, str(root / "batch"))).isEmpty()
    reasons = [loads.read_rejects(spark, str(root / t)).groupBy("reason").count() for t in ("data", "batch")]
    assert sets.compare_outputs(*reasons).isEmpty() and not reasons[0].isEmpty()


def test_a_second_query_or_a_lost_checkpoint_is_refused(spark, drop, tmp_path_factory):
    root = tmp_path_factory.mktemp("stream")
    target = str(root / "data")
    streams.ingest_stream(streams.read_drop_stream(spark, str(drop)), target, str(root / "one")).awaitTermination()
    put(drop, "ingest_ts=300/c.csv", "\n".join([HEADER, line(value="9")]) + "\n")
    other = streams.ingest_stream(streams.read_drop_stream(spark, str(drop)), target, str(root / "two"))
    with pytest.raises(StreamingQueryException):
        other.awaitTermination()
    assert streams.read_stream_table(spark, target).count() == 3
    streams.ingest_stream(streams.read_drop_stream(spark, str(drop)), target, str(root / "one")).awaitTermination()
    assert streams.read_stream_table(spark, target).count() == 4


def test_series_that_differ_by_case_are_stored_apart(spark, tmp_path, tmp_path_factory):
    put(tmp_path, "ingest_ts=1/a.csv", "\n".join([HEADER, line("FRY9Ca", value="1"), line("FRY9CA", value="2")]) + "\n")
    root = tmp_path_factory.mktemp("stream")
    rows = streams.read_drop_stream(spark, str(tmp_path))
    streams.refresh_stream(rows, str(root / "data"), str(root / "wide"), str(root / "checkpoint")).awaitTermination()
    for series, value in (("FRY9Ca", "1"), ("FRY9CA", "2")):
        assert [r.A1 for r in refresh.read_wide(spark, str(root / "wide"), series).collect()] == [value]


def test_stream_equals_batch_whatever_the_batches(spark, drop, tmp_path_factory):
    root = tmp_path_factory.mktemp("stream")
    target, checkpoint = str(root / "data"), str(root / "checkpoint")
    for _ in range(2):
        rows = streams.read_drop_stream(spark, str(drop), max_files_per_trigger=1)
        streams.ingest_stream(rows, target, checkpoint).awaitTermination()
    streamed = streams.read_stream_table(spark, target)
    loads.load_new(spark, str(drop), str(root / "batch"), str(root / "ledger"))
    batch = loads.read_loaded(spark, str(root / "batch"))
    assert streamed.count() == 3
    assert sets.compare_outputs(streamed, batch).isEmpty()


@pytest.mark.parametrize("refresh_mode", ["filings", "series"])
def test_stream_refresh_keeps_earlier_batches(spark, drop, tmp_path_factory, refresh_mode):
    root = tmp_path_factory.mktemp("stream")
    args = (str(root / "data"), str(root / "wide"), str(root / "checkpoint"))

    def run():
        rows = streams.read_drop_stream(spark, str(drop))
        streams.refresh_stream(rows, *args, refresh=refresh_mode).awaitTermination()

    run()
    put(drop, "ingest_ts=300/c.csv", "\n".join([HEADER, line(item="A9", value="9")]) + "\n")
    run()
    wide = refresh.read_wide(spark, str(root / "wide"), "FRY9C").collect()
    assert [(r.A1, r.A9) for r in wide] == [("5", "9")]


def test_stream_batch_run_again_replaces_its_rows(spark, drop, tmp_path_factory):
    target = str(tmp_path_factory.mktemp("narrow") / "data")
    rows, refused = loads.read_drop(files.valid_files(spark, str(drop / "ingest_ts=100")))
    assert refused.isEmpty()
    for _ in range(2):
        loads.write_load(loads.accepted(rows), target, "batch-0")
    assert loads.read_loaded(spark, target).count() == 2


def test_generated_drops(spark):
    rows = generators.gen_kv(spark, 10)
    assert rows.columns == list(KV.columns) and rows.count() == 30
    assert rows.where("submissionts = 'submissionts_set2' AND key = 'key_3'").first().value == "value_changed_3"
    assert rows.where("seriesid = 'seriesid_set2'").agg(F.min("key"), F.max("key")).first()[:] == ("key_set2_11", "key_set2_20")
    assert flt.valid_series(rows).isEmpty()

    def codes(n):
        return spark.range(n).select(F.format_string("C%03d", "id").alias("code"))

    kv = generators.gen_kv_codes(spark, {"FRY9C": codes(7), "FRY15": codes(3)}, 20)
    counts = {r[0]: r[1] for r in kv.where("aod = '20241231'").groupBy("key").count().collect()}
    assert counts == {"C000": 7, "C001": 7, "C002": 6}
    assert sets.compare_outputs(kv, generators.gen_kv_codes(spark, {"FRY9C": codes(7), "FRY15": codes(3)}, 20)).isEmpty()

    items = spark.createDataFrame(
        [("GSWAM438", "1a Bills", "GSWA0001", "Long  1", "1"), ("GSWAN749", "1b, FRN", "", "", "")],
        ", ".join(f"{c} string" for c in table_source.DICTIONARY_COLUMNS),
    )
    made = generators.gen_collections(spark, dict.fromkeys(("FRY9C", "FRY15", "FR2004A"), items), 5)
    assert made.columns == list(COLLECTIONS.columns) and made.count() == 20
    bounds = made.agg(F.min(F.col("item_value").cast("int")), F.max(F.col("item_value").cast("int"))).first()
    assert bounds[0] >= 1000 and bounds[1] <= 9999999
    assert made.where("context_level1_mdrm = 'GSWA0001' AND context_level1_value = '1'").count() == 12


def test_dictionary_and_code_list(spark, tmp_path):
    put(tmp_path, "d/map.csv", 'item_mdrm,item_desc,context_level1_mdrm,context_level1_desc,context_level1_value\nGSWAM438,"1a, Bills",GSWA0001,Long  1,1\n')
    row = table_source.item_dictionary(spark, str(tmp_path / "d")).first()
    assert (row.item_desc, row.context_level1_desc, row.context_level1_value) == ("1a, Bills", "Long  1", "1")
    put(tmp_path, "c/codes.txt", "BHCK1, BHCK2,BHCK1 ,,BHCK3\n")
    codes = table_source.code_list(spark, str(tmp_path / "c"))
    assert sorted(r.code for r in codes.collect()) == ["BHCK1", "BHCK2", "BHCK3"]


def test_csv_drop_keeps_text(spark, tmp_path):
    values = [" lead", "trail ", 'q"uote', "two\nlines", "tab\there", "ü€😀", "back\\slash"]
    frame = spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], "item_mdrm string, item_value string")
    rows = frame.select(
        *[F.col(c) if c in frame.columns else F.lit("FRY9C").alias(c) for c in COLLECTIONS.columns],
        F.lit("7").alias("ingest_timestamp"),
    )
    sink.write_csv_drop(rows, str(tmp_path / "drop"))
    back = csv_source.read_csv_strict(spark, str(tmp_path / "drop"))
    assert {r.item_mdrm: r.item_value for r in back.collect()} == {str(i): v for i, v in enumerate(values)}


def test_rows_of_files_of_one_layout_hold_no_other_columns_and_search_no_paths(spark, tmp_path):
    names = ["extra 1", *COLLECTIONS.columns, "extra 2"]
    for n in (1, 2):
        place = tmp_path / f"ingest_ts={n} +%"
        place.mkdir()
        (place / f"part +{n}.csv").write_text(",".join(names) + "\n" + ",".join(f"v{n}" for _ in names) + "\nshort\n")
    rows, refused = loads.read_drop(files.valid_files(spark, str(tmp_path)))
    got = sorted(map(tuple, rows.select("seriesid", "context_level3_value", "ingest_timestamp", "reason").collect()), key=str)
    assert sorted(r[2] for r in got) == ["1 +%", "1 +%", "2 +%", "2 +%"]
    assert sum(r[3] == "malformed" for r in got) == 2
    assert {r[1] for r in got if r[3] != "malformed"} == {"v1", "v2"}
    plan = rows._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan csv" in line)
    assert "_1#" in scan and "_0#" not in scan and f"_{len(names) - 1}#" not in scan
    assert "regexp" not in plan.split("FileScan csv")[0].split("InMemory")[0]


@pytest.mark.parametrize("per_time, moved", [(1, False), (40, True)])
def test_rows_of_an_ingest_time_in_few_files_are_stored_by_the_tasks_that_read_them(
    spark, tmp_path, tmp_path_factory, monkeypatch, per_time, moved
):
    for time in (100, 200):
        for n in range(per_time):
            put(tmp_path, f"ingest_ts={time}/{n:03d}.csv", "\n".join([HEADER, line(item=f"A{n}"), line(item="B")]) + "\n")
    found = files.valid_files(spark, str(tmp_path))
    seen = []
    rebalanced = loads.rebalanced
    monkeypatch.setattr(loads, "rebalanced", lambda rows, by: seen.append(by) or rebalanced(rows, by))
    target = str(tmp_path_factory.mktemp("target") / "narrow")
    assert loads.load_files(found, target, "one") == (4 * per_time, 4 * per_time)
    assert bool(seen) == moved
    stored = loads.read_loaded(spark, target)
    got = sorted((r.ingest_timestamp, r.item_mdrm) for r in stored.collect())
    assert got == sorted((t, i) for t in ("100", "200") for n in range(per_time) for i in (f"A{n}", "B"))
    # One file for each series and ingest time, either way.
    assert len(stored.inputFiles()) == 2


def test_a_very_large_file_is_read_by_one_task_and_stored_by_many(spark):
    sizes = [("a", "1", 300 * 2**20), ("b", "2", 10)]
    frame = spark.createDataFrame(sizes, "path string, ingest_ts string, length long")
    assert not loads.stored_as_read(frame)
    assert loads.stored_as_read(frame.where("length = 10"))
    assert not loads.stored_as_read(frame.where("length < 0"))


def test_a_changing_drop_has_one_file_of_each_layout_for_an_ingest_time(spark, tmp_path):
    from narrowlake import registry

    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    lines.repartition(4).write.parquet(str(tmp_path / "lineitem.parquet"))
    drop = pathlib.Path(registry._changing_drop(spark, str(tmp_path)).removeprefix("file:"))
    folders = list(drop.glob("ingest_ts=*"))
    assert len(folders) > 50
    assert all(len(list(f.glob("*.csv"))) <= 2 for f in folders)


def test_a_stream_is_packed_between_its_runs(spark, tmp_path):
    target, checkpoint, ledger = (str(tmp_path / name) for name in ("data", "checkpoint", "ledger"))
    packed = []
    for first in (100, 200):
        for time_ in range(first, first + 3):
            put(tmp_path / "in", f"ingest_ts={time_}/a.csv", "\n".join([HEADER, line(), line(item=f"B{time_}")]) + "\n")
        rows = streams.read_drop_stream(spark, str(tmp_path / "in"), max_files_per_trigger=1)
        streams.ingest_stream(rows, target, checkpoint, ledger=ledger).awaitTermination()
        with lease.Lease(spark, loads.lease_path(ledger)), pytest.raises(lease.LeaseHeld):
            loads.compact_loads(spark, target, ledger)
        packed.append(loads.compact_loads(spark, target, ledger))
    # The second packing takes the batches loaded since, and what the first one packed.
    assert [len(p) for p in packed] == [3, 4]
    assert sum(p.startswith("packed-") for p in packed[1]) == 1
    read = loads.read_loaded(spark, target)
    assert sorted((r.item_mdrm, r.ingest_timestamp) for r in read.collect()) == sorted(
        (item, str(t)) for t in (100, 101, 102, 200, 201, 202) for item in ("A1", f"B{t}")
    )


def test_a_batch_run_again_after_it_was_packed_is_not_stored_twice(spark, tmp_path):
    target, ledger = str(tmp_path / "data"), str(tmp_path / "ledger")
    for time_ in (100, 200):
        put(tmp_path, f"in/ingest_ts={time_}/a.csv", "\n".join([HEADER, line()]) + "\n")
    batches = {f"batch-{t}": files.valid_files(spark, str(tmp_path / f"in/ingest_ts={t}")) for t in (100, 200)}
    for load_id, found in batches.items():
        assert loads.load_once(found, target, ledger, load_id)
    assert loads.compact_loads(spark, target, ledger) == list(batches)
    loads.compact_loads(spark, target, ledger)
    assert not loads.load_once(batches["batch-100"], target, ledger, "batch-100")
    assert loads.read_loaded(spark, target).count() == 2


def test_compacted_loads_loads_on_between_its_packings(spark, tmp_path, monkeypatch):
    months = [f"{1995 + n // 12}-{n % 12 + 1:02d}-01" for n in range(62)]
    rows = [(1, 1, supplier, 1, 7.0, 0.0, 0.0, "A", "O", month) for month in months for supplier in (1, 2)]
    names = "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_discount l_tax l_returnflag l_linestatus l_shipdate"
    lines = spark.createDataFrame(rows, names.split()).withColumn("l_shipdate", F.to_timestamp("l_shipdate"))
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    steps, stream, pack = [], streams.ingest_stream, loads.compact_loads

    def streamed(*args, **options):
        steps.append("loaded")
        return stream(*args, **options)

    def packing(*args, **options):
        steps.append(len(pack(*args, **options)))

    monkeypatch.setattr(streams, "ingest_stream", streamed)
    monkeypatch.setattr(loads, "compact_loads", packing)
    found = registry.QUERIES["compacted_loads"](spark, str(tmp_path))
    assert found.count() == len(rows)
    assert steps == ["loaded", 2, "loaded", 3]


@pytest.mark.parametrize("route", ["ranged", "whole"])
def test_packed_files_load_as_plain_ones_where_asked_for(spark, tmp_path, route):
    wide = HEADER + "".join(f',"column {n}, with a\nname of some length"' for n in range(120))
    text = "\n".join([wide, line() + "," * 120, line(item="A2") + "," * 119]) + "\n"
    put(tmp_path, "in/ingest_ts=100/a.csv.gz", gzip.compress(text[:3000].encode()) + gzip.compress(text[3000:].encode()))
    put(tmp_path, "in/ingest_ts=200/b.csv", text)
    put(tmp_path, "in/ingest_ts=200/note.gz", gzip.compress(text.encode()))
    for asked, times in ((True, ["100", "200"]), (False, ["200"])):
        target = str(tmp_path / f"data-{asked}")
        args = (spark, str(tmp_path / "in"), target, str(tmp_path / f"ledger-{asked}"))
        assert loads.load_new(*args, route=route, gzip=asked) == len(times)
        assert loads.load_new(*args, route=route, gzip=asked) == 0
        stored = sorted((r.item_mdrm, r.ingest_timestamp) for r in loads.read_loaded(spark, target).collect())
        assert stored == [("A1", t) for t in times]
        refused = loads.read_rejects(spark, target).collect()
        assert sorted((r.reason, r.ingest_timestamp) for r in refused) == [("malformed", t) for t in times]


@pytest.mark.parametrize("text", ["a,b\n1,2\n", '"a\nb",c'])
def test_first_text_of_packed_bytes(text):
    unpacked = files._unpacker(most=1024)
    whole = gzip.compress(text.encode())
    assert unpacked(whole, True) == (text.encode(), True)
    assert unpacked(whole + gzip.compress(b"more"), True) == (text.encode() + b"more", True)
    assert unpacked(whole[:-10], False)[1] is False
    assert unpacked(gzip.compress(b"x" * 5000), True) == (b"x" * 1024, False)


def test_the_drop_of_long_headers_is_packed_and_has_one_file_for_an_ingest_time(spark, tmp_path, monkeypatch):
    rows = [(n, n, n % 5, 1, 7.0, 0.0, 0.0, "A", "O", f"1995-0{n % 3 + 1}-01") for n in range(900)]
    names = "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_discount l_tax l_returnflag l_linestatus l_shipdate"
    lines = spark.createDataFrame(rows, names.split()).withColumn("l_shipdate", F.to_timestamp("l_shipdate"))
    lines.repartition(4).write.parquet(str(tmp_path / "lineitem.parquet"))
    monkeypatch.setattr(registry, "work_dir", lambda spark, label: str(tmp_path / label))
    assert registry.QUERIES["load_long_headers"](spark, str(tmp_path)).count() == 900
    found = [p for p in (tmp_path / "long").rglob("*") if p.is_file() and p.name.startswith("part-")]
    assert len(found) == 3 and all(p.name.endswith(".csv.gz") for p in found)
    texts = [gzip.decompress(p.read_bytes()).decode() for p in found]
    values = ",".join(map(str, range(120)))
    assert all(t.startswith('"column 0, with a\nname of some length","column 1,') for t in texts)
    assert sum(t.count(f"\n{values},FRY9C,") for t in texts) == 900
    assert sum(p.stat().st_size for p in found) * 5 < sum(map(len, texts))
