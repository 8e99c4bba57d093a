"""The snapshot scan, reading whole files and in splits."""

import csv
import io
import os
import random

import pandas as pd
import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from snapfold import schemas
from snapfold.sources import snapshot
from snapfold.sources.snapshot import read_snapshot

COLUMNS = list(schemas.SNAPSHOT_COLUMNS)
# Several stages that fail at once come as one error that PySpark does not translate.
ERRORS = (PySparkException, Py4JJavaError)
def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def write(path, records, header=COLUMNS, eol="\n", **options):
    text = io.StringIO()
    out = csv.writer(text, lineterminator=eol, **options)
    out.writerow(header)
    out.writerows(records)
    path.write_bytes(text.getvalue().encode())
    return str(path)


def expected(records):
    na = set(schemas.NA_TOKENS)
    return sorted(
        (tuple(None if v is None or v in na else v for v in r) for r in records), key=repr
    )


@pytest.fixture
def split_bytes(spark):
    """Set the input split size for one test."""
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    yield lambda size: spark.conf.set(name, f"{size}b")
    spark.conf.set(name, before)


@pytest.fixture(params=[30, 10**8], ids=["splits", "whole"])
def cut(request, split_bytes):
    """Files cut into many splits, or not at all: nothing else may differ."""
    split_bytes(request.param)


@pytest.mark.parametrize("size, n", [("128MB", 2**27), ("16m", 2**24), ("40b", 40), ("77", 77), ("1g", 2**30)])
def test_split_sizes(spark, size, n):
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert snapshot._split_bytes(session) == n


def nasty_records(n, seed):
    rng = random.Random(seed)
    bits = ["a", "Zoë", '"', '""', ",", "\n", "\n\n", "\r\n", " ", "NULL", "x", "'", "\\", "中"]
    text = lambda: "".join(rng.choice(bits) for _ in range(rng.randint(0, 6)))
    return [[str(i), *(text() for _ in COLUMNS[1:])] for i in range(n)]


def test_records_are_parsed_without_regular_expressions(spark, tmp_path, monkeypatch):
    """What every record passes is counted in bytes; the limit is still one of characters."""
    records = [[str(i), "中\n" * 20, *("" for _ in COLUMNS[2:])] for i in range(5)]
    path = write(tmp_path / "a.csv", records, eol="\r\n", quoting=csv.QUOTE_ALL)
    # Fewer characters than the limit, but more bytes.
    monkeypatch.setattr(snapshot, "MAX_RECORD", 150)
    found = read_snapshot(spark, path)
    assert "regexp" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert rows(found) == expected(records)


def test_small_splits_do_not_cost_a_task_each(spark, tmp_path, split_bytes):
    """They are cut as told, but tasks take several of them and leave few files of pieces."""
    records = nasty_records(400, 3)
    path = write(tmp_path / "a.csv", records, quoting=csv.QUOTE_ALL)
    split_bytes(100)
    found, folder = snapshot.scan_snapshot(spark, path)
    pieces = spark.read.parquet(f"{folder}/pieces")
    assert pieces.select("start").distinct().count() > 200
    tasks = [f for f in os.listdir(f"{folder}/pieces") if f.startswith("part-")]
    assert len(tasks) <= 3 * spark.sparkContext.defaultParallelism
    assert rows(found) == expected(records)


@pytest.mark.parametrize("size", [40, 333, 5000, 10**8])
@pytest.mark.parametrize("eol", ["\n", "\r\n"], ids=["lf", "crlf"])
def test_records_are_put_together_over_any_splits(spark, tmp_path, split_bytes, size, eol):
    folder = tmp_path / "snapshot"
    folder.mkdir()
    first, second = nasty_records(60, 1), nasty_records(25, 2)
    write(folder / "a.csv", first, eol=eol, quoting=csv.QUOTE_ALL)
    write(folder / "b.csv", second, eol=eol, quoting=csv.QUOTE_ALL)
    split_bytes(size)
    got = read_snapshot(spark, str(folder))
    assert rows(got) == expected(first + second)


def test_records_are_put_together_without_a_broadcast(spark, tmp_path, split_bytes, monkeypatch):
    records = nasty_records(60, 5)
    path = write(tmp_path / "a.csv", records, quoting=csv.QUOTE_ALL)
    split_bytes(333)
    monkeypatch.setattr(snapshot, "MAX_BROADCAST_SPLITS", 0)
    got = read_snapshot(spark, path)
    assert rows(got) == expected(records)


@pytest.mark.parametrize("place", [0, 5, 11])
def test_checks_hold_wherever_an_extra_column_stands(spark, tmp_path, cut, place):
    header = [*COLUMNS[:place], "extra", *COLUMNS[place:]]
    lines = [[str(i), *"abcdefg", "2020-01-01", "", "x"] for i in range(20)]
    lines = [[*r[:place], "e", *r[place:]] for r in lines]
    path = tmp_path / "a.csv"
    good = write(path, lines, header)
    assert read_snapshot(spark, good).count() == 20
    write(path, [*lines, [*lines[0], "surplus"]], header)
    with pytest.raises(PySparkException, match="too many fields"):
        read_snapshot(spark, str(path)).select("employee_id").collect()
    for at in (4, 9):
        lines[at] = [x.replace("c", '5" pipe') for x in lines[at]]
    path.write_text("\n".join(",".join(r) for r in [header, *lines]) + "\n")
    with pytest.raises(ERRORS, match="quote is missing|too many fields"):
        read_snapshot(spark, str(path)).select("employee_id").collect()


def test_line_ends_may_differ_within_a_file(spark, tmp_path, cut):
    path = tmp_path / "a.csv"
    body = [f"{i},a,b,c,d,e,f,1,2020-01-01,,x{i}" for i in range(10)]
    ends = ["\n", "\r\n"] * 5
    path.write_bytes((",".join(COLUMNS) + "\n" + "".join(map(str.__add__, body, ends))).encode())
    assert sorted(r.address for r in read_snapshot(spark, str(path)).collect()) == [f"x{i}" for i in range(10)]
    path.write_bytes(('"' + '","'.join(COLUMNS) + '"\r\n1,a,b,c,d,e,f,1,2020-01-01,,"x\r\ny"\r\n').encode())
    assert read_snapshot(spark, str(path)).first().address == "x\r\ny"


def test_missing_value_tokens_are_those_of_pandas():
    from pandas._libs.parsers import STR_NA_VALUES

    assert set(schemas.NA_TOKENS) == STR_NA_VALUES


def test_missing_value_tokens(spark, tmp_path, cut):
    records = [[str(i), token, f" {token}", *["v"] * 8] for i, token in enumerate(schemas.NA_TOKENS)]
    path = write(tmp_path / "a.csv", records, quoting=csv.QUOTE_ALL)
    got = read_snapshot(spark, path).collect()
    assert {r.first_name for r in got} == {None}
    assert {r.last_name for r in got} == {f" {t}" for t in schemas.NA_TOKENS}


def test_columns_are_found_by_name(spark, tmp_path, cut):
    header = [*reversed(COLUMNS), "extra"]
    path = write(tmp_path / "a.csv", [[*(f"v{i}" for i in range(11)), "more"]], header)
    got = read_snapshot(spark, path)
    assert got.columns == COLUMNS
    assert tuple(got.first()) == tuple(f"v{i}" for i in range(10, -1, -1))


def test_short_rows_blank_lines_and_surplus_values(spark, tmp_path, cut):
    path = tmp_path / "a.csv"
    path.write_text(",".join(COLUMNS) + "\n1,a\n\n2,b,c\n")
    got = rows(read_snapshot(spark, str(path)))
    assert got == [("1", "a", *[None] * 9), ("2", "b", "c", *[None] * 8)]
    path.write_text(",".join(COLUMNS) + "\n" + ",".join("x" * 12) + "\n")
    with pytest.raises(PySparkException, match="too many fields"):
        read_snapshot(spark, str(path)).collect()


def test_header_of_every_file_must_agree(spark, tmp_path, cut):
    write(tmp_path / "a.csv", [["1", *"abcdefghij"]])
    write(tmp_path / "b.csv", [["2", *"abcdefghij"]], [COLUMNS[1], COLUMNS[0], *COLUMNS[2:]])
    with pytest.raises(ERRORS, match="header"):
        read_snapshot(spark, str(tmp_path)).collect()


def test_missing_column_and_missing_file(spark, tmp_path):
    path = write(tmp_path / "a.csv", [["1", "a"]], COLUMNS[:2])
    with pytest.raises(ValueError, match="last_name"):
        read_snapshot(spark, path)
    with pytest.raises(FileNotFoundError, match="nowhere.csv"):
        read_snapshot(spark, str(tmp_path / "nowhere.csv"))


def test_too_long_records_are_refused(spark, tmp_path, cut, monkeypatch):
    monkeypatch.setattr(snapshot, "MAX_RECORD", 200)
    records = [[str(i), *"abcdefghi", "x"] for i in range(20)]
    path = write(tmp_path / "a.csv", records, quoting=csv.QUOTE_ALL)
    assert read_snapshot(spark, path).count() == 20
    records[7][-1] = "line\n" * 60
    path = write(tmp_path / "a.csv", records, quoting=csv.QUOTE_ALL)
    with pytest.raises(PySparkException, match="too long"):
        read_snapshot(spark, path).collect()


@pytest.mark.parametrize("stray", [[3], [5, 6], [0, 19], [2, 9, 11]])
def test_stray_quotes_are_refused(spark, tmp_path, cut, stray):
    lines = [f"{i},a,b,c,d,e,f,1,2020-01-01,,x" for i in range(20)]
    for i in stray:
        lines[i] = lines[i].replace(",c,", ',5" pipe,')
    path = tmp_path / "a.csv"
    path.write_text("\n".join([",".join(COLUMNS), *lines]) + "\n")
    with pytest.raises(ERRORS, match="quote is missing|too many fields"):
        read_snapshot(spark, str(path)).collect()


@pytest.mark.parametrize("size", [60, 333, 10**8])
def test_quotes_that_mislead_have_their_splits_read_again(spark, tmp_path, split_bytes, size, monkeypatch):
    """Quotes inside unquoted fields of single lines look like the ends of quoted ones."""
    lines = [f'{i},a,b,5" c 7",d,e,f,1,2020-01-01,,{"x" * (i % 50)}' for i in range(60)]
    for i in range(10, 40):
        lines[i] = f'{i},a,b,5",",7,d,e,f,1,2020-01-01,y'
    path = tmp_path / "a.csv"
    path.write_text("\n".join([",".join(COLUMNS), *lines]) + "\n")
    split_bytes(10**9)
    want = rows(read_snapshot(spark, str(path)))
    assert len(want) == 60
    split_bytes(size)
    for most in (10**6, 0):
        monkeypatch.setattr(snapshot, "MAX_BROADCAST_SPLITS", most)
        assert rows(read_snapshot(spark, str(path))) == want


def test_a_long_record_in_a_doubtful_split(spark, tmp_path, split_bytes, monkeypatch):
    from snapfold.sources import records as record_tasks

    monkeypatch.setattr(record_tasks, "DOUBTFUL", 20)
    records = [[str(i), *"abcdefghi", "word\n" * (40 if i == 5 else 1)] for i in range(12)]
    path = write(tmp_path / "a.csv", records, quoting=csv.QUOTE_ALL)
    split_bytes(70)
    assert rows(read_snapshot(spark, path)) == expected(records)


def test_byte_order_mark_and_compression(spark, tmp_path, cut):
    import gzip

    text = ",".join(COLUMNS) + "\n1," + ",".join("a" * 10) + "\n"
    plain, packed = tmp_path / "a.csv", tmp_path / "b.csv.gz"
    plain.write_bytes(b"\xef\xbb\xbf" + text.encode())
    packed.write_bytes(gzip.compress(text.encode()))
    for path in (plain, packed):
        got = rows(read_snapshot(spark, str(path)))
        assert got == [("1", *"aaaaaaaaaa")]
