"""Input at its edges: many headers, damaged lines, dates by the first value, log lines, distinct counts, cached tables."""

import gzip
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

import helpers as H
from skeinmart.functions import dates
from skeinmart.operators import clean, distinct, quality
from skeinmart.plans import marts
from skeinmart.sources import artifacts, files


def test_headers_of_many_files(spark, tmp_path):
    folder = tmp_path / "orders.csv"
    folder.mkdir()
    for i in range(2000):
        head = "order_id,customer_id" if i % 2 else "customer_id,order_id"
        (folder / f"part-{i:05d}.csv").write_text(f"{head}\n{i},{i}\n")
    (folder / "part-99999.csv").write_text("")
    tracker, group = spark.sparkContext.statusTracker(), "headers"
    spark.sparkContext.setJobGroup(group, "headers of many files")
    try:
        df = files.read_csv(spark, str(folder))
        jobs = len(tracker.getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= 3
    assert df.where("order_id = customer_id").count() == 2000


def test_headers_with_quotes_blanks_and_archives(spark, tmp_path):
    folder = tmp_path / "t.csv"
    folder.mkdir()
    (folder / "a b.csv").write_text('\n"id","the ""name"""\n1,x\n')
    with gzip.open(folder / "c.csv.gz", "wt") as f:
        f.write('"the ""name""",id\ny,2\n')
    assert sorted(H.rows(files.read_csv(spark, str(folder)).select("id", 'the "name"'))) == [("1", "x"), ("2", "y")]
    (folder / "d.csv").write_text("other\n1\n")
    with pytest.raises(ValueError, match="no column"):
        files.read_csv(spark, str(folder))


def test_damaged_lines_are_kept_apart(spark, tmp_path):
    folder = tmp_path / "t.csv"
    folder.mkdir()
    (folder / "a.csv").write_text("id,name,x\n1,one,NA\n2,two\n3,three,4,5\n4,four,y\n")
    (folder / "b.csv").write_text("name,id\nfive,5\nsix\n")
    good, bad = files.read_csv_checked(spark, str(folder))
    assert H.rows(good.select("id", "name", "x")) == [("1", "one", None), ("4", "four", "y"), ("5", "five", None)]
    assert sorted(r.line for r in bad.collect()) == ["2,two", "3,three,4,5", "six"]
    assert {r.file_path.rsplit("/", 1)[1] for r in bad.collect()} == {"a.csv", "b.csv"}
    data = gzip.compress(("id,name,x\n" + "".join(f"{i},n,z\n" for i in range(10, 20000))).encode())
    (folder / "torn.csv.gz").write_bytes(data[: len(data) // 2])
    kept = files.read_csv_checked(spark, str(folder))[0]
    assert kept.where("id < 10").count() == 3, "a torn file takes no other with it"


COLUMNS = [
    ("2024-01-15", "2024-1-5", "2024-01-16 10:00:00", "2024/01/17", "20240118", " 2024-01-19", "2024-02-30", "2024-01"),
    ("15/01/2024", "1/2/2024", "01/02/24", "2024-01-01", "31/02/2024", "5/13/2024", "15/01/2024 10:00"),
    ("05/01/2024", "15/01/2024", "1/2/2024"), (None, "15-Jan-2024", "1-feb-2024", "x"), ("15.01.2024", "1.2.2024"),
    ("not-a-date", "15/01/2024", "2024-01-15", "Jan 3, 2024", "01/02/2024", "20240118", "x", "2024-01-15 10:00"),
    ("Jan 15, 2024", "january 16, 2024", "JAN 17, 2024", "Feb 30, 2024"), ("May 5, 2024", "Jan 15, 2024", "January 3, 2024"),
    ("20240115", "2024-01-16", "2024016"), ("2024-01-15 10:30:00", "2024-01-16", "2024-01-17 9:30:00", "2024-01-18T10:30:00"),
    (None, None),
]


@pytest.mark.filterwarnings("ignore")
@pytest.mark.parametrize("values", COLUMNS)
def test_layout_of_the_first_value(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, d string").repartition(3)
    read = dates.date_column(df, "d", dates.FIRST_VALUE, [F.col("i")])
    got = [r.x and str(r.x) for r in df.select("i", read.alias("x")).orderBy("i").collect()]
    want = pd.to_datetime(pd.Series(values, dtype=object), errors="coerce")
    assert got == [None if pd.isna(x) else str(x.date()) for x in want]


def test_orders_by_the_first_layout(spark):
    rows = [("1", "1", "1", "1", "31/12/2023", "x"), ("2", "1", "1", "1", "02/01/2024", "x"), ("3", "1", "1", "1", "2024-01-03", "x")]
    got = clean.clean_orders(H.orders(spark, rows), ["seq"], dates.FIRST_VALUE)
    assert [(r.order_id, str(r.order_date)) for r in got.orderBy("order_id").collect()] == [(1, "2023-12-31"), (2, "2024-01-02")]


def test_log_lines_over_splits(spark, tmp_path):
    rng = random.Random(1)
    texts = {f"run_{k}.log": [f"{i} " + "x" * rng.randint(0, 60) for i in range(900)] for k in range(3)}
    for name, lines in texts.items():
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        logs = artifacts.read_logs(spark, str(tmp_path))
        got = {(r.file_name, r.line_no): r.value for r in logs.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {(name, i): v for name, lines in texts.items() for i, v in enumerate(lines, 1)}


def test_distinct_counts_add_up(spark):
    rng = random.Random(2)
    rows = [(rng.choice([20240131, 20240215, 20240401, 20250101]), rng.choice([None, -5, 0, 1, 32768, 32769, rng.randint(1, 10**6)])) for _ in range(400)]
    fact = spark.createDataFrame(rows, "date_id int, customer_id long")
    got = {(r.level, r.year, r.quarter, r.month): r["keys"] for r in distinct.calendar_rollup(distinct.monthly_bitmaps(fact, "customer_id")).collect()}
    want = {}
    for d, c in rows:
        y, m = d // 10000, d // 100 % 100
        for at in (("month", y, (m + 2) // 3, m), ("quarter", y, (m + 2) // 3, None), ("year", y, None, None)):
            want.setdefault(at, set()).update({c} - {None})
    assert got == {at: len(v) for at, v in want.items()}


def test_percent_limits(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (4,)], "k long")
    passed = lambda *limits: [r.passed for r in quality.check_pct_limits(df, "t", "k", *limits).collect()]
    assert passed() == [False, False] and passed(25.0, 24.0) == [True, False] and passed(24.0, 25.0) == [False, True]
    assert [r.passed for r in quality.check_pct_limits(df.limit(0), "t", "k").collect()] == [True, True]


def test_cache_follows_its_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    cache = marts.FollowingCache(spark)
    first = cache.get("t", [path], lambda: spark.read.parquet(path))
    assert first.count() == 3 and first.is_cached
    assert cache.get("t", [path], lambda: spark.range(0)) is first
    spark.range(5).write.mode("append").parquet(path)
    second = cache.get("t", [path], lambda: spark.read.parquet(path))
    assert second.count() == 8 and second.is_cached and not first.is_cached
    cache.release()
    assert not second.is_cached
