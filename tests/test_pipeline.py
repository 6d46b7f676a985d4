import csv
import os
import threading
import time
from pathlib import Path
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from ingot.plans import medallion as M
from ingot.plans import sinks as S
from ingot.session import ensure_checkpoint_dir
from ingot.sources import csv as CSV

HEADER = ["event_time", "event_type", "product_id", "category_id", "category_code",
          "brand", "price", "user_id", "user_session"]


def _rows(n, start=0, bad_at=None):
    out = []
    for i in range(start, start + n):
        out.append([
            f"2019-11-{1 + i % 28:02d} {i % 24:02d}:00:00 UTC" if i != bad_at else "not-a-time",
            "view" if i % 3 else "purchase",
            str(1000 + i % 7),
            str(2053013555631882655 + i % 3),
            "electronics.smartphone" if i % 4 else "",
            "apple" if i % 5 else "NA",
            f"{i % 50}.239",
            str(500 + i % 11),
            f"sess-{i % 13}",
        ])
    return out


def _write(path, rows, header=True):
    with open(path, "w", newline="") as fh:
        w = csv.writer(fh)
        if header:
            w.writerow(HEADER)
        w.writerows(rows)


@pytest.fixture()
def src(tmp_path):
    d = tmp_path / "csv"
    d.mkdir()
    _write(d / "a.csv", _rows(30))
    _write(d / "b.csv", _rows(5, start=100))
    _write(d / "c.csv", _rows(8, start=200, bad_at=203))  # one bad time -> file skipped
    _write(d / "empty.csv", [], header=False)
    _write(d / "header_only.csv", [])
    return str(d)


def test_csv_policies(spark, src):
    text = CSV.read_events_text(spark, f"{src}/*.csv")
    ok, bad = CSV.to_bronze_rows(text, on_error="skip_file")
    assert ok.count() == 35 and bad.count() == 8
    reasons = {r.reject_reason for r in bad.collect()}
    assert any("event_time" in r for r in reasons) and "file has rejected rows" in reasons
    ok, bad = CSV.to_bronze_rows(text, on_error="quarantine")
    assert ok.count() == 42 and bad.count() == 1
    with pytest.raises(Exception):
        CSV.to_bronze_rows(text, on_error="fail")
    # NA tokens -> NULL, decimals half-up, ids exact
    row = ok.where("brand IS NULL").first()
    assert row is not None and str(row.price).endswith(".24")
    assert ok.agg(F.max("category_id")).first()[0] == 2053013555631882657


def test_missing_glob_is_empty_or_raises(spark, tmp_path):
    assert CSV.read_events_text(spark, str(tmp_path / "nope" / "*.csv")).count() == 0
    with pytest.raises(Exception):
        CSV.read_events_text(spark, str(tmp_path / "nope" / "*.csv"), on_missing="raise")


def test_head_n_per_file_over_many_splits(spark, tmp_path):
    d = tmp_path / "big"
    d.mkdir()
    _write(d / "x.csv", _rows(300))
    _write(d / "y.csv", _rows(5, start=1000))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")  # many splits per file
    try:
        text = CSV.read_events_text(spark, str(d))
        assert text.select(CSV.BLOCK).distinct().count() > 5
        idx = CSV.with_row_in_file(text)
        got = idx.select("source_file", CSV.ROW_INDEX, "user_session", "product_id").collect()
        x = sorted((r[CSV.ROW_INDEX], r.product_id) for r in got if r.source_file.endswith("x.csv"))
        assert [i for i, _ in x] == list(range(300))
        assert [p for _, p in x] == [str(1000 + i % 7) for i in range(300)]
        head = CSV.head_n_per_file(text, 10).collect()
        assert len(head) == 15
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_pipeline_rerun_semantics(spark, src, tmp_path):
    root = str(tmp_path / "lake")
    r1 = M.run_medallion(spark, f"{src}/*.csv", root, on_error="skip_file", recreate=True)
    assert r1["bronze_rows"] == 35 and r1["bronze_rejects"] == 8 and r1["fact_rows"] == 35
    lh = S.Lakehouse(spark, root)
    assert lh.table(S.SILVER).count() == 35
    assert lh.table(S.DIM_PRODUCTS).count() == 7
    r2 = M.run_medallion(spark, f"{src}/*.csv", root, on_error="skip_file")
    assert lh.table(S.BRONZE).count() == 70            # bronze appends
    assert lh.table(S.SILVER).count() == 70            # silver refreshed from bronze
    assert lh.table(S.DIM_PRODUCTS).count() == 7       # dim refreshed
    fact = lh.table(S.FACT)
    stats = fact.agg(F.count("*"), F.min("event_key"), F.max("event_key"),
                     F.countDistinct("event_key")).first()
    assert tuple(stats) == (35 + 70, 1, 105, 105)       # fact appends all of silver again
    assert r2["checks"][("gold", "event_key_duplicates")] == (0, "PASS")
    assert lh.table(S.DQ_RESULTS).count() == 2 * len(r1["checks"])
    m = {(r.layer, r.metric): (r.value, r.status)
         for r in lh.table(S.DQ_METRICS).where("run_at = (SELECT max(run_at) FROM gold.dq_metrics)").collect()}
    assert m[("bronze", "total_rows")] == (70, "OK") and m[("gold", "total_rows")] == (105, "OK")
    assert m[("silver", "null_brand")] == (0, "OK") and m[("silver", "brand_unknowns")][1] == "WARN"
    parts = {r.event_month for r in lh.table(S.SILVER).select("event_month").distinct().collect()}
    assert parts == {"2019-11"}
    # a fresh session re-attaches the stored tables
    lh.create()
    assert lh.table(S.FACT).count() == 105


def test_pipeline_overwrite_mode_and_gate(spark, src, tmp_path):
    root = str(tmp_path / "lake2")
    M.run_medallion(spark, f"{src}/*.csv", root, on_error="skip_file", fact_mode="overwrite", recreate=True)
    M.run_medallion(spark, f"{src}/*.csv", root, on_error="skip_file", fact_mode="overwrite")
    lh = S.Lakehouse(spark, root)
    stats = lh.table(S.FACT).agg(F.count("*"), F.max("event_key")).first()
    assert tuple(stats) == (70, 70)
    with pytest.raises(M.QualityGateFailed):
        M.run_medallion(spark, f"{src}/*.csv", root, on_error="skip_file", fail_on=("duplicate_product_ids",))


def test_limit_per_file_test_mode(spark, src, tmp_path):
    root = str(tmp_path / "lake3")
    r = M.run_medallion(spark, f"{src}/*.csv", root, on_error="skip_file", limit_per_file=3, recreate=True)
    # a: 3, b: 3; c's first 3 rows are clean (bad row is its 4th) -> 3
    assert r["bronze_rows"] == 9
    counts = {os.path.basename(r.source_file): r.rows_loaded
              for r in M.bronze_file_counts(S.Lakehouse(spark, root)).collect()}
    assert counts == {"a.csv": 3, "b.csv": 3, "c.csv": 3}


def test_recreate_empties_tables(spark, src, tmp_path):
    root = str(tmp_path / "lake4")
    M.run_medallion(spark, f"{src}/*.csv", root, on_error="skip_file", recreate=True)
    lh = S.Lakehouse(spark, root)
    lh.create(recreate=True)
    assert lh.table(S.BRONZE).count() == 0 and lh.table(S.FACT).count() == 0


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_old_rows_never_come_back(spark, src, tmp_path, mode):
    root = str(tmp_path / "lake4b")
    old = spark.conf.get("spark.sql.sources.partitionOverwriteMode", "static")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        for _ in range(3):
            M.run_medallion(spark, f"{src}/*.csv", root, on_error="skip_file", recreate=True)
            other = spark.newSession()
            for s in (spark, other):
                lh = S.Lakehouse(s, root)
                lh.create()
                got = lh.table(S.FACT).agg(F.count("*"), F.countDistinct("event_key"), F.max("event_key")).first()
                assert tuple(got) == (35, 35, 35)
        lh = S.Lakehouse(spark, root)
        fewer = lh.partitioned(lh.table(S.SILVER).drop("event_month").where("event_type = 'view'"))
        n = fewer.count()
        lh.overwrite(fewer.withColumn("event_date", F.expr("date'2020-05-05'")).drop("event_month").transform(lh.partitioned), S.SILVER)
        assert lh.table(S.SILVER).count() == n and 0 < n < 35
        assert lh.vacuum(S.SILVER) >= 1 and lh.table(S.SILVER).count() == n
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", old)


def test_failed_refresh_leaves_the_table(spark, src, tmp_path):
    root = str(tmp_path / "lake4c")
    M.run_medallion(spark, f"{src}/*.csv", root, on_error="skip_file", recreate=True)
    lh = S.Lakehouse(spark, root)
    broken = lh.table(S.SILVER).withColumn("brand", F.raise_error(F.lit("stop")))
    with pytest.raises(Exception):
        lh.overwrite(broken, S.SILVER)
    assert lh.table(S.SILVER).count() == 35


def test_fact_keys_stay_unique_when_fact_written_outside_pipeline(spark, src, tmp_path):
    root = str(tmp_path / "lake5")
    M.run_medallion(spark, f"{src}/*.csv", root, on_error="skip_file", recreate=True)
    lh = S.Lakehouse(spark, root)
    assert M.logged_key(lh) == M.logged_key(lh, verify=True) == 35
    # a stray append the log does not know about (keys 1000..1001)
    stray = lh.table(S.FACT).limit(2).withColumn("event_key", F.col("event_key") + 999)
    lh.append(spark.createDataFrame(stray.collect(), stray.schema), S.FACT)
    assert M.logged_key(lh) == 35                      # the log alone does not see it
    M.load_fact(lh, verify=True)                       # compared on demand
    keys = lh.table(S.FACT).agg(F.count("*"), F.countDistinct("event_key"), F.max("event_key")).first()
    assert keys[0] == 35 + 2 + 35 and keys[0] == keys[1]


def test_no_row_is_cut_for_its_width(spark, tmp_path):
    from ingot import schemas
    from ingot.operators.keys import with_surrogate_key
    from ingot.operators.transforms import to_dim_products, to_fact_columns, to_silver

    d = tmp_path / "wide"
    d.mkdir()
    rows = _rows(6)
    rows[2][4] = "a." + "b" * 98          # a code of 100 characters
    rows[3][4] = "c" * 98 + ".d"
    _write(d / "w.csv", rows)
    root = str(tmp_path / "lake6")
    r = M.run_medallion(spark, str(d), root, recreate=True)
    lh = S.Lakehouse(spark, root)
    assert r["bronze_rows"] == 6 and lh.table(S.SILVER).count() == lh.table(S.FACT).count() == 6
    assert lh.table(S.FACT).agg(F.max(F.length("category")), F.max(F.length("subcategory"))).first() == (98, 98)
    # transform outputs carry the declared names and types
    bronze = lh.table(S.BRONZE)
    silver = to_silver(bronze)
    assert [(f.name, f.dataType) for f in silver.schema] == \
        [(f.name, f.dataType) for f in schemas.SILVER_SCHEMA]
    assert [(f.name, f.dataType) for f in to_dim_products(silver).schema] == \
        [(f.name, f.dataType) for f in schemas.DIM_PRODUCTS_SCHEMA]
    fact = with_surrogate_key(to_fact_columns(silver))
    assert [(f.name, f.dataType) for f in fact.schema] == [(f.name, f.dataType) for f in schemas.FACT_SCHEMA]
    assert [f.name for f in bronze.schema][:10] == [f.name for f in schemas.BRONZE_SCHEMA]


def test_cli_run_and_dq(spark, src, tmp_path, capsys):
    from ingot.__main__ import main

    root = str(tmp_path / "lake_cli")
    assert main(["run", "--source", f"{src}/*.csv", "--root", root, "--recreate"]) == 0
    out = capsys.readouterr().out
    assert '"bronze_rows": 42' in out and '"fact_rows": 42' in out
    assert main(["dq", "--root", root, "--layer", "gold", "--preview", "3"]) == 0
    out = capsys.readouterr().out
    assert "referential_integrity" in out and "event_key_duplicates" in out
    assert main(["silver", "--root", root]) == 0
    assert "silver: refreshed" in capsys.readouterr().out


def test_incremental_path_equals_full_refresh(spark, tmp_path, monkeypatch):
    from ingot.operators.transforms import to_dim_products, to_silver

    d1, d2 = tmp_path / "in1", tmp_path / "in2"
    d1.mkdir(), d2.mkdir()
    _write(d1 / "a.csv", _rows(30))
    _write(d1 / "b.csv", _rows(5, start=100))
    _write(d2 / "c.csv", _rows(8, start=200, bad_at=203))
    wide = _rows(10, start=300)
    wide[4][4] = "a." + "z" * 55
    _write(d2 / "d.csv", wide)
    lh = S.Lakehouse(spark, str(tmp_path / "lake_inc"))
    lh.create(recreate=True)
    r1 = M.load_bronze_increment(lh, str(d1))

    # the second load breaks off at every step in turn (its files are there, whole or in part), then runs to its end, then again
    real, calls = lh.write, []
    before = {t: lh.table(t).count() for t in (S.BRONZE, S.SILVER, S.DIM_PRODUCTS, S.FACT)}
    for stop in range(1, 6):
        def flaky(df, table, *args, stop=stop, **named):
            calls.append(table)
            part = real(df, table, *args, **named)
            if len(calls) == stop:
                for f in sorted(Path(part.folder).rglob("part-*"))[::2]:
                    f.rename(f"{f}.lost")
                raise OSError("lost")
            return part
        calls.clear()
        monkeypatch.setattr(lh, "write", flaky)
        with pytest.raises(OSError):
            M.load_bronze_increment(lh, str(d2), load_id="second")
        assert {t: lh.table(t).count() for t in before} == before
    monkeypatch.setattr(lh, "write", real)
    for _ in range(2):
        r2 = M.load_bronze_increment(lh, str(d2), load_id="second")
    assert (r1["silver_rows"], r2["silver_rows"], r2["bronze_rejects"]) == (35, 17, 1)

    def rows(df, cols):
        return sorted(tuple(r) for r in df.select(*cols).collect())

    full_silver = to_silver(lh.table(S.BRONZE))
    cols = full_silver.columns
    assert rows(lh.table(S.SILVER), cols) == rows(full_silver, cols)
    assert rows(lh.table(S.DIM_PRODUCTS), ["product_id", "category_id", "brand"]) == \
        rows(to_dim_products(full_silver), ["product_id", "category_id", "brand"])
    stats = lh.table(S.FACT).agg(F.count("*"), F.min("event_key"), F.max("event_key"),
                                 F.countDistinct("event_key")).first()
    assert tuple(stats) == (52, 1, 52, 52)


def test_cli_increment_and_stream(spark, tmp_path, capsys):
    from ingot.__main__ import main

    a, b = tmp_path / "a", tmp_path / "b"
    a.mkdir(), b.mkdir()
    _write(a / "x.csv", _rows(12))
    _write(b / "y.csv", _rows(4, start=70))
    root = str(tmp_path / "lake_cli2")
    assert main(["increment", "--source", str(a), "--root", root, "--recreate"]) == 0
    assert '"silver_rows": 12' in capsys.readouterr().out
    assert main(["stream", "--source", str(b), "--root", root]) == 0
    assert "bronze now holds 16 rows" in capsys.readouterr().out
    lh = S.Lakehouse(spark, root)
    assert tuple(lh.table(S.FACT).agg(F.count("*"), F.max("event_key")).first()) == (16, 16)


def test_parallel_gold_loads(spark, src, tmp_path):
    root = str(tmp_path / "lake_par")
    r = M.run_medallion(spark, f"{src}/*.csv", root, on_error="skip_file", recreate=True, parallel_gold=True)
    lh = S.Lakehouse(spark, root)
    assert r["fact_rows"] == 35 and lh.table(S.DIM_PRODUCTS).count() == 7
    assert r["checks"][("gold", "referential_integrity")] == (0, "PASS")


def test_a_load_reads_its_own_files(spark, tmp_path, monkeypatch):
    """Silver and the fact of an increment are made from the load's parts."""
    for k in range(2):
        (tmp_path / f"in{k}").mkdir()
        _write(tmp_path / f"in{k}" / "a.csv", _rows(40, start=100 * k))
    lh = S.Lakehouse(spark, str(tmp_path / "lake_own"))
    lh.create(recreate=True)
    first = M.load_bronze_increment(lh, str(tmp_path / "in0"))
    old = {f for t in (S.BRONZE, S.SILVER, S.FACT) for f in lh.table(t).inputFiles()}
    read, real, began = [], lh.write, time.time()

    def watched(df, table, *args, **named):
        read.append((table, set(df.inputFiles())))
        return real(df, table, *args, **named)

    monkeypatch.setattr(lh, "write", watched)
    second = M.load_bronze_increment(lh, str(tmp_path / "in1"))
    mine = {p.table: p.folder for p in lh.load_parts(second["load_id"]).values()}
    assert not [f for f in Path(urlparse(ensure_checkpoint_dir(spark)).path).glob("csv-staging-*") if f.stat().st_mtime > began]
    for table, files in read:
        assert not files & old, table
    assert all(mine[S.BRONZE] in f for f in dict(read)[S.SILVER]) and all(mine[S.SILVER] in f for f in dict(read)[S.FACT])
    assert first["load_id"] != second["load_id"] and lh.table(S.FACT).where(F.col("load_id") == second["load_id"]).count() == 40


def test_no_moment_without_the_table(spark, src, tmp_path):
    """A reader that goes on during refreshes sees 35 rows each time."""
    M.run_medallion(spark, f"{src}/*.csv", str(tmp_path / "lake_gap"), on_error="skip_file", recreate=True)
    lh, seen, stop = S.Lakehouse(spark, str(tmp_path / "lake_gap")), [], threading.Event()

    def reader():
        while not stop.is_set():
            try:
                seen.append(spark.sql("SELECT count(*) FROM silver.ecommerce_behavior").first()[0])
            except Exception as e:
                seen.append(str(e)[:200])

    t = threading.Thread(target=reader)
    t.start()
    for _ in range(6):
        M.load_silver(lh)
    stop.set()
    t.join()
    assert len(seen) > 5 and set(seen) == {35}


def test_text_too_long_stops_the_write(spark, tmp_path):
    lh = S.Lakehouse(spark, str(tmp_path / "lake_w"))
    lh.create(recreate=True)
    with pytest.raises(Exception, match="longer than 50"):
        lh.append(spark.createDataFrame([(1, 2, "x" * 51)], "product_id long, category_id long, brand string"), S.DIM_PRODUCTS)
    lh.append(spark.createDataFrame([(1, 2, "x" * 50)], "product_id long, category_id long, brand string"), S.DIM_PRODUCTS)
    assert lh.table(S.DIM_PRODUCTS).count() == 1 and "varchar(50)" in spark.sql(f"SHOW CREATE TABLE {lh._stored(S.DIM_PRODUCTS)}").first()[0].lower()


def test_loads_of_nothing(spark, tmp_path):
    """Header-only files, and files of rejects alone, are loads without rows."""
    (tmp_path / "in").mkdir()
    (tmp_path / "bad").mkdir()
    _write(tmp_path / "in" / "a.csv", [])
    _write(tmp_path / "bad" / "b.csv", _rows(1, bad_at=0))
    lh = S.Lakehouse(spark, str(tmp_path / "lake_nothing"))
    lh.create(recreate=True)
    first = M.load_bronze_increment(lh, str(tmp_path / "in"))
    assert (first["silver_rows"], first["bronze_rejects"], first["dim_events_without_product"]) == (0, 0, 0)
    assert M.load_bronze_increment(lh, str(tmp_path / "in"), load_id=first["load_id"])["silver_rows"] == 0  # published, so not run again
    assert M.load_bronze_increment(lh, str(tmp_path / "bad"))["bronze_rejects"] == 1
    assert lh.table(S.FACT).count() == 0 and M.logged_key(lh) == 0 and lh.table(S.BRONZE_REJECTS).count() == 1
    _write(tmp_path / "in" / "c.csv", _rows(3))
    assert M.load_bronze_increment(lh, str(tmp_path / "in"))["silver_rows"] == 3
    assert lh.table(S.FACT).agg(F.max("event_key")).first()[0] == 3 and M.incremental_metrics(lh).count() > 0
