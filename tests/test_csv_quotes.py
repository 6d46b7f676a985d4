"""Quoted CSV records over many splits, against pandas; scans that stop early."""

import gzip
import random

import pandas as pd
import pytest

from ingot import schemas
from ingot.sources import csv as CSV


def fields_of(spark, path, sep=","):
    lines = CSV.with_source(CSV.text_lines(spark.read).text(str(path)))
    rows = CSV.records(CSV.stage(lines, sep), sep)
    return [(r["_open"], list(r["fields"])) for r in rows.orderBy(CSV.SOURCE_FILE, CSV.BLOCK, "_line").collect()]


def pandas_rows(text, width):
    import io

    t = pd.read_csv(io.StringIO(text), header=None, names=range(width), dtype=str, keep_default_na=False, na_filter=False)
    return t.fillna("").values.tolist()


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")if spark.conf.get(k, None) is not None}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")
    for k, v in old.items():
        spark.conf.set(k, v)


PIECES = ["a", "bc", " ", '"x"', '""', '"p,q"', '"l1\nl2"', '"say ""hi"""', '"a\n\n,""b"" \n"', 'in"ner', '"tail"er', "", "é漢", '"', "q\"\"q"]


def random_csv(seed, n, width=4):
    r = random.Random(seed)
    rows = []
    for _ in range(n):
        cells = []
        for _ in range(r.randint(1, width)):
            piece = r.choice(PIECES[:-2]) if r.random() < 0.97 else r.choice(PIECES[-1:])
            cells.append(piece)
        rows.append(",".join(cells))
    return "\n".join(rows) + "\n"


@pytest.mark.parametrize("seed", range(2))
def test_records_are_those_of_pandas_over_many_splits(spark, tmp_path, small_splits, seed):
    text = random_csv(seed, 120)
    p = tmp_path / "a.csv"
    p.write_text(text, newline="")
    got = fields_of(spark, p)
    blocks = CSV.with_source(CSV.text_lines(spark.read).text(str(p))).select(CSV.BLOCK).distinct().count()
    assert blocks > 5 and not any(o for o, _ in got)
    assert [f + [""] * (4 - len(f)) for _, f in got] == pandas_rows(text, 4)


def test_line_states():
    q = CSV.Quotes()
    for line, from_out, from_in in [('a,b', False, True), ('a,"b', True, False), ('b",c', False, False), ('"a""', True, False), ('a"b', False, False), ('x","y', True, True), ('a,"b","c', True, True), ('""', False, True)]:
        assert (q.ends_inside(line, False), q.ends_inside(line, True)) == (from_out, from_in), line


def test_files_stay_apart_and_open_quotes_are_rejects(spark, tmp_path, small_splits):
    head = ",".join(schemas.CSV_COLUMNS)
    good = head + '\r\n2020-01-01 00:00:00 UTC,view,1,2,a.b,"two\nlines, ""q""",3.50,7,"s\r\n1"\r\n\r\n2020-01-02 00:00:00 UTC,cart,2,2,,x,1,8,s2\r\n'
    broken = head + '\n2020-01-01 00:00:00 UTC,view,1,2,a.b,ok,3.50,7,s\n2020-01-01 00:00:00 UTC,view,1,2,a.b,"never closed,3.50,7,s\n' + "2020-01-03 00:00:00 UTC,view,1,2,a.b,c,3.50,7,s\n" * 20
    (tmp_path / "good.csv").write_text(good, newline="")
    (tmp_path / "broken.csv").write_text(broken, newline="")
    ok, bad = CSV.to_bronze_rows(CSV.read_events_text(spark, str(tmp_path)))
    assert sorted((r["brand"], r["user_session"]) for r in ok.collect()) == [("ok", "s"), ('two\nlines, "q"', "s\r\n1"), ("x", "s2")]
    reasons = {r["reject_reason"].split(";")[0] for r in bad.collect()}
    assert reasons == {"quote not closed"} and bad.count() == 21


def test_other_separator(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a|"b|""c"|\n')
    assert fields_of(spark, tmp_path / "a.csv", "|") == [(False, ["a", 'b|"c', ""])]


def test_first_rows_without_reading_on(spark, tmp_path):
    """The files are cut off in the middle: reading to their end fails."""
    head, row = ",".join(schemas.CSV_COLUMNS), '2020-01-01 00:00:00 UTC,view,{},2,a.b,"br\n{}",3.50,7,s\n'
    for k in range(2):
        r = random.Random(k)
        data = (head + "\n" + "".join(row.format(i, r.random()) for i in range(100_000))).encode()
        (tmp_path / f"f{k}.csv.gz").write_bytes(gzip.compress(data, 1)[:-1000])
    (tmp_path / "tiny.csv.gz").write_bytes(gzip.compress((head + "\n" + row.format(5, "x")).encode()))
    text = CSV.head_n_per_file(CSV.read_events_text(spark, str(tmp_path), first=500), 500)
    got = {r[CSV.SOURCE_FILE].rsplit("/", 1)[1]: (r["n"], r["s"]) for r in text.groupBy(CSV.SOURCE_FILE).agg({"*": "count", "product_id": "sum"}).toDF(CSV.SOURCE_FILE, "s", "n").collect()}
    assert got == {"f0.csv.gz": (500, sum(range(500))), "f1.csv.gz": (500, sum(range(500))), "tiny.csv.gz": (1, 5)}
    with pytest.raises(Exception):
        CSV.read_events_text(spark, str(tmp_path)).count()


def test_only_lines_of_longer_records_are_shuffled(spark, tmp_path):
    """Lines that are records by themselves stay where they are read, whatever
    the other lines of their file; a block's state goes on over Arrow batches."""
    head, row = ",".join(schemas.CSV_COLUMNS), '2020-01-01 00:00:00 UTC,view,{},2,a.b,"a ""{}""\n\nb, c",3.50,7,s\n2020-01-01 00:00:00 UTC,view,{},2,a.b,x,3.50,7,s\n'
    (tmp_path / "a.csv").write_text(head + "\n" + "".join(row.format(i, i, i) for i in range(40)), newline="")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        text = CSV.read_events_text(spark, str(tmp_path))
        plan = text._jdf.queryExecution().executedPlan().toString()
        got = sorted((int(r["product_id"]), r["brand"]) for r in text.collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == sorted((i, b) for i in range(40) for b in (f'a "{i}"\n\nb, c', "x"))
    assert "hashpartitioning" not in plan and "Window" not in plan and "SortMergeJoin" not in plan
