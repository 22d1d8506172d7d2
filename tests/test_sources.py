import csv
import io
import itertools
import json
from collections import Counter
from datetime import datetime, timezone
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import rows
from panelwatch.sources import pointer
from panelwatch.sources.ingest import Source, exit_code, ingest
from panelwatch.sources.report import write_json
from panelwatch.sources.store import RawStore
from panelwatch.sources.text_csv import field_count, read_text_csv

AT = datetime(2024, 1, 2, 3, 4, 5, tzinfo=timezone.utc)
LATER = datetime(2024, 1, 9, tzinfo=timezone.utc)


def write(path: Path, text: str | bytes) -> str:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text if isinstance(text, bytes) else text.encode())
    return str(path)


def test_all_strings_with_bom_and_empties(spark, tmp_path):
    path = write(tmp_path / "a.csv", "﻿年,縣市,n\n2020,台北市,007\n2021,,\n\n2022,\"\",NA\n")
    df = read_text_csv(spark, path)
    assert df.dtypes == [("年", "string"), ("縣市", "string"), ("n", "string")]
    assert rows(df, "年") == [("2020", "台北市", "007"), ("2021", "", ""), ("2022", "", "NA")]


def test_bad_bytes_are_replaced(spark, tmp_path):
    path = write(tmp_path / "a.csv", b"a,b\nx\xffy,1\n")
    assert rows(read_text_csv(spark, path)) == [("x�y", "1")]


def test_short_rows_are_filled_and_long_ones_fail(spark, tmp_path):
    short = write(tmp_path / "short.csv", "a,b,c\n1,2\n3,4,5\n")
    assert rows(read_text_csv(spark, short), "a") == [("1", "2", ""), ("3", "4", "5")]
    for i, line in enumerate(("1,2,3,4", "1,2,3,")):
        path = write(tmp_path / f"long{i}.csv", f"a,b,c\n{line}\n")
        with pytest.raises(PySparkException, match="more than 3 fields"):
            read_text_csv(spark, path).collect()


def test_quotes(spark, tmp_path):
    path = write(tmp_path / "q.csv", 'a,b\n"x,y","say ""hi"""\n')
    assert rows(read_text_csv(spark, path)) == [("x,y", 'say "hi"')]


def test_quoted_line_breaks(spark, tmp_path):
    path = write(tmp_path / "q.csv", 'a,b\n"two\nlines",1\nplain,2\n')
    assert rows(read_text_csv(spark, path), "b") == [("two\nlines", "1"), ("plain", "2")]


@pytest.mark.parametrize("split_bytes", ["40", "97", "100000"])
def test_quoted_line_breaks_across_splits(spark, tmp_path, split_bytes):
    expected = []
    for f in range(2):
        records = ["a,b,c"]
        for i in range(40):
            note = "\n".join([f'line {k} ""x"", y' for k in range(i % 4)])
            quoted = i % 3 == 0 or '"' in note
            records.append(f'{f}-{i},"{note}",z{i}' if quoted else f"{f}-{i},{note},z{i}")
            expected.append((f"{f}-{i}", note.replace('""', '"'), f"z{i}"))
        end = "\n" if f else "\r\n"
        write(tmp_path / "many" / f"{f}.csv", "\ufeff" + end.join(records) + end)
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = rows(read_text_csv(spark, str(tmp_path / "many")))
        starts = spark.read.text(str(tmp_path / "many")).select("_metadata.file_path", "_metadata.file_block_start")
        splits = starts.distinct().count()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert sorted(got) == sorted(expected)
    assert splits > (20 if split_bytes == "40" else 1)


def test_long_and_short_rows_with_quoted_line_breaks(spark, tmp_path):
    short = write(tmp_path / "short.csv", 'a,b,c\n"1\n1",2\n\n3,4,5\n')
    assert rows(read_text_csv(spark, short), "a") == [("1\n1", "2", ""), ("3", "4", "5")]
    long = write(tmp_path / "long.csv", 'a,b\n"1\n1",2,3\n')
    with pytest.raises(PySparkException, match="more than 2 fields"):
        read_text_csv(spark, long).collect()


def test_field_count_ignores_quoted_separators(spark):
    df = spark.createDataFrame([('a,"b,""c,",d',), ("",), (",,",)], "r string")
    assert [r[0] for r in df.select(field_count(F.col("r"))).collect()] == [3, 1, 3]


SPLITS = pytest.mark.parametrize("split_bytes", ["20", "100000"])


@pytest.fixture
def split_size(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in keys}

    def put(size):
        spark.conf.set(keys[0], size)
        spark.conf.set(keys[1], "0")

    yield put
    for key, value in before.items():
        spark.conf.set(key, value)


@SPLITS
def test_quotes_within_unquoted_fields_are_characters(spark, tmp_path, split_size, split_bytes):
    path = write(tmp_path / "q.csv", 'a,b\n1,5" disk\n2,y\n3,7" disk\n4,w\n5,a"b"c\n6,""\n7,"x ""y"\n')
    split_size(split_bytes)
    assert rows(read_text_csv(spark, path), "a") == [
        ("1", '5" disk'), ("2", "y"), ("3", '7" disk'), ("4", "w"), ("5", 'a"b"c'), ("6", ""), ("7", 'x "y'),
    ]


@SPLITS
def test_a_quoted_field_that_does_not_end_fails(spark, tmp_path, split_size, split_bytes):
    path = write(tmp_path / "q.csv", 'a,b\n1,"open\n2,x\n3,y\n4,z\n')
    split_size(split_bytes)
    with pytest.raises(PySparkException, match="does not end"):
        read_text_csv(spark, path).collect()
    report = ingest(spark, RawStore(str(tmp_path / "store")), [Source("d", "x", path)], AT).first()
    assert report["rows"] is None and "does not end" in report["error"]


@SPLITS
def test_reordered_headers_are_aligned_by_name(spark, tmp_path, split_size, split_bytes):
    write(tmp_path / "many" / "0.csv", "a,b\n1,x\n2,y\n")
    write(tmp_path / "many" / "1.csv", "b,a\nz,3\n")
    split_size(split_bytes)
    assert rows(read_text_csv(spark, str(tmp_path / "many")).select("a", "b"), "a") == [("1", "x"), ("2", "y"), ("3", "z")]
    write(tmp_path / "many" / "2.csv", "a,c\n1,x\n")
    with pytest.raises(ValueError, match="headers differ"):
        read_text_csv(spark, str(tmp_path / "many"))


@SPLITS
def test_blank_lines_around_the_header(spark, tmp_path, split_size, split_bytes):
    path = write(tmp_path / "q.csv", '\n\r\na,b\n\n"1\n\n1",2\n\n3,4\n')
    split_size(split_bytes)
    assert rows(read_text_csv(spark, path), "a") == [("1\n\n1", "2"), ("3", "4")]


def test_one_column_alone_is_checked_as_well(spark, tmp_path):
    path = write(tmp_path / "q.csv", "a,b\n1,2\n1,2,3\n")
    for column in ("a", "b"):
        with pytest.raises(PySparkException, match="more than 2 fields"):
            read_text_csv(spark, path).select(column).collect()


def test_header_names(spark, tmp_path):
    path = write(tmp_path / "q.csv", 'a,,a,"x\ny"\n1,2,3,4\n')
    assert read_text_csv(spark, path).columns == ["a", "_c1", "a.1", "x\ny"]
    with pytest.raises(ValueError, match="no header"):
        read_text_csv(spark, write(tmp_path / "none.csv", "\n"))


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.text('ab",\n\r ', max_size=6), min_size=2, max_size=2), min_size=1, max_size=25), st.integers(20, 90))
def test_records_are_those_of_the_grammar(spark, tmp_path, split_size, table, split):
    """Values as a CSV writer quotes them, in splits of any size."""
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerows([["p", "q"], *table])
    path = write(tmp_path / f"{abs(hash((str(table), split)))}.csv", out.getvalue())
    split_size(str(split))
    # Carriage returns at the end of a record are part of its line end.
    expected = [(a, b) for a, b in table]
    got = rows(read_text_csv(spark, path))
    assert sorted(got) == sorted(expected)


def test_headers_are_aligned_however_many_there_are(spark, tmp_path):
    """1,100 files with seven names in as many orders, one of them behind all others with another name."""
    names = list("abcdefg")
    orders = itertools.islice(itertools.permutations(names), 1100)
    for i, order in enumerate(orders):
        write(tmp_path / "many" / f"{i:04}.csv", ",".join(order) + "\n" + ",".join(f"{name}{i}" for name in order) + "\n")
    df = read_text_csv(spark, str(tmp_path / "many")).select(*names)
    assert Counter(map(tuple, df.collect())) == Counter(tuple(f"{name}{i}" for name in names) for i in range(1100))
    write(tmp_path / "many" / "1100.csv", "a,b,c,d,e,f,x\n1,2,3,4,5,6,7\n")
    with pytest.raises(ValueError, match="headers differ"):
        read_text_csv(spark, str(tmp_path / "many"))


def test_headers_of_other_widths_are_errors(spark, tmp_path):
    write(tmp_path / "many" / "0.csv", "a,b\n1,2\n")
    for other in ("a\n1\n", "a,b,c\n1,2,3\n", "a,b,c,\n1,2,3\n"):
        write(tmp_path / "many" / "1.csv", other)
        with pytest.raises(ValueError, match="headers differ"):
            read_text_csv(spark, str(tmp_path / "many"))


def test_long_rows_whose_last_fields_are_empty_fail(spark, tmp_path):
    for i, line in enumerate(("1,2,", "1,2,,", "1,2,,5", ",,", '"1,2",3,""')):
        with pytest.raises(PySparkException, match="more than 2 fields"):
            read_text_csv(spark, write(tmp_path / f"{i}.csv", f"a,b\n{line}\n")).collect()
    whole = write(tmp_path / "whole.csv", 'a,b\n"1,2","3,4,"\n",",\n')
    assert rows(read_text_csv(spark, whole), "a") == [(",", ""), ("1,2", "3,4,")]


def test_an_open_quote_in_the_last_line_fails(spark, tmp_path):
    for i, line in enumerate(('1,"x', '"1', '1,"x""', '1,2\n3,"\n', '1,"a,b\n2,c\n')):
        with pytest.raises(PySparkException, match="does not end"):
            read_text_csv(spark, write(tmp_path / f"{i}.csv", f"a,b\n{line}")).collect()


def test_one_column(spark, tmp_path):
    path = write(tmp_path / "one.csv", 'a\r\n1\r\n\r\n""\r\n"x\r\ny"\r\n')
    assert rows(read_text_csv(spark, path), "a") == [("",), ("1",), ("x\ny",)]


def test_a_record_that_did_not_land_is_noticed(spark, tmp_path, monkeypatch):
    path = write(tmp_path / "a.csv", "a\n1\n2\n")
    store = RawStore(str(tmp_path / "store"))
    add = RawStore.add
    monkeypatch.setattr(RawStore, "add", lambda self, df, *args: add(self, df.where("a = '1'"), *args))
    assert "2 records were parsed and 1 landed" in ingest(spark, store, [Source("d", "x", path)], AT).first()["error"]
    with pytest.raises(FileNotFoundError):
        RawStore(str(tmp_path / "other")).latest(spark, "d")


def test_many_files_have_their_header_each(spark, tmp_path):
    for i in range(3):
        write(tmp_path / "many" / f"{i}.csv", f"a,b\n{i},x\n")
    assert rows(read_text_csv(spark, str(tmp_path / "many")), "a") == [("0", "x"), ("1", "x"), ("2", "x")]


def test_ingest_reports_falls_back_and_continues(spark, tmp_path):
    good = write(tmp_path / "good.csv", "a,b\n1,2\n3,4\n")
    store = RawStore(str(tmp_path / "store"))
    report = ingest(
        spark,
        store,
        [
            Source("missing", "x", str(tmp_path / "nowhere.csv")),
            Source("one", "流感", good),
            Source("two", "登革熱", str(tmp_path / "nowhere.csv"), fallback=good),
        ],
        AT,
    )
    got = {r["name"]: r for r in report.collect()}
    assert got["missing"]["error"] and got["missing"]["rows"] is None
    assert (got["one"]["rows"], got["one"]["cols"], got["one"]["source_url"]) == (2, 4, good)
    assert got["two"]["source_url"] == good and got["two"]["error"] is None
    assert exit_code(report) == 1
    assert exit_code(report.where("error IS NULL")) == 0
    landed = store.latest(spark, "two")
    assert rows(landed, "a") == [("1", "2", good, AT.isoformat()), ("3", "4", good, AT.isoformat())]


def test_fallback_after_a_failure_while_parsing(spark, tmp_path):
    broken = write(tmp_path / "broken.csv", "a,b\n1,2,3\n")
    good = write(tmp_path / "good.csv", "a,b\n1,2\n")
    store = RawStore(str(tmp_path / "store"))
    report = ingest(spark, store, [Source("d", "x", broken, fallback=good)], AT)
    row = report.first()
    assert row["source_url"] == good and row["error"] is None and "more than 2 fields" in row["primary_error"]
    assert exit_code(report) == 0
    assert store.latest(spark, "d").count() == 1


def test_versions_and_snapshot(spark, tmp_path):
    store = RawStore(str(tmp_path / "store"))
    path = str(tmp_path / "a.csv")
    for at, text in ((AT, "a\n1\n"), (LATER, "a\n1\n2\n")):
        write(Path(path), text)
        spark.catalog.clearCache()
        assert exit_code(ingest(spark, store, [Source("d", "x", path)], at)) == 0
    history = store.history(spark, "d")
    assert rows(history.groupBy("ingest_ts").count(), "ingest_ts") == [
        (pointer.new_version(AT), 1), (pointer.new_version(LATER), 2),
    ]
    assert store.latest(spark, "d").count() == 2
    assert store.newest_version(spark, "d") == pointer.new_version(LATER)


def test_latest_without_snapshot_is_the_newest_version(spark, tmp_path):
    store = RawStore(str(tmp_path / "store"))
    with pytest.raises(FileNotFoundError):
        store.latest(spark, "d")
    for n, at in enumerate((LATER, AT), 1):
        store.add(spark.range(n).select(F.col("id").cast("string")), "d", pointer.new_version(at))
    assert store.latest(spark, "d").count() == 1


def test_a_published_version_is_not_written_again(spark, tmp_path):
    store = RawStore(str(tmp_path / "store"))
    path = Path(tmp_path / "a.csv")
    for text, failed in (("a\n1\n", 0), ("a\n2\n", 1)):
        write(path, text)
        assert exit_code(ingest(spark, store, [Source("d", "x", str(path))], AT)) == failed
    assert rows(store.latest(spark, "d").select("a")) == [("1",)]


def test_history_has_the_columns_of_all_versions(spark, tmp_path):
    store = RawStore(str(tmp_path / "store"))
    store.add(spark.createDataFrame([("1", "x")], "a string, c string"), "d", "v1")
    store.add(spark.createDataFrame([("2", "y")], "a string, b string"), "d", "v2")
    history = store.history(spark, "d").select("a", "b", "c", "ingest_ts")
    assert rows(history, "a") == [("1", "", "x", "v1"), ("2", "y", "", "v2")]


def test_the_newest_version_is_a_complete_one(spark, tmp_path):
    store = RawStore(str(tmp_path / "store"))
    assert store.newest_version(spark, "d") is None
    store.add(spark.range(1), "d", "v1")
    (tmp_path / "store" / "raw" / "d" / "ingest_ts=v2").mkdir()
    assert store.newest_version(spark, "d") == "v1"


@pytest.mark.parametrize("copy", [False, True])
def test_snapshot_with_and_without_files_of_its_own(spark, tmp_path, copy):
    store = RawStore(str(tmp_path / "store"))
    good = write(tmp_path / "good.csv", "a,b\n1,2\n")
    ingest(spark, store, [Source("d", "x", good)], AT, copy=copy)
    (file,) = store.latest(spark, "d").inputFiles()
    assert ("/snapshot/d/" in file) == copy
    assert rows(store.latest(spark, "d").select("a", "b")) == [("1", "2")]


def test_a_failed_ingest_keeps_the_snapshot(spark, tmp_path):
    store = RawStore(str(tmp_path / "store"))
    good = write(tmp_path / "good.csv", "a,b\n1,2\n")
    broken = write(tmp_path / "broken.csv", "a,b\n1,2,3\n")
    ingest(spark, store, [Source("d", "x", good)], AT)
    assert exit_code(ingest(spark, store, [Source("d", "x", broken)], LATER)) == 1
    assert rows(store.latest(spark, "d").select("a", "b")) == [("1", "2")]


def test_json_report_keeps_text(spark, tmp_path):
    path = str(tmp_path / "report")
    write_json(spark.createDataFrame([("台南市", 3)], "county string, n int"), path)
    (part,) = Path(path).glob("part-*.json")
    assert "台南市" in part.read_text(encoding="utf-8")
    assert json.loads(part.read_text(encoding="utf-8")) == {"county": "台南市", "n": 3}
