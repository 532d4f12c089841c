"""Readers, writers, uploads and artifacts."""

import json
import os

import pytest

import helpers as H
from skeinmart.operators import clean
from skeinmart.operators.mapping import default_mapping, map_columns
from skeinmart.schemas import PRIMARY_KEYS, RAW_SCHEMAS, STAR_SCHEMAS
from skeinmart.sources import artifacts, files, warehouse


def write(path, text):
    path.write_text(text)
    return str(path)


def test_csv_reads_text(spark, tmp_path):
    df = files.read_csv(spark, write(tmp_path / "t.csv", "a,b\n1,3\n2,4\n"))
    assert df.columns == ["a", "b"] and H.rows(df) == [("1", "3"), ("2", "4")]
    typed = files.read_csv(spark, str(tmp_path / "t.csv"), dtype_overrides={"a": "bigint"})
    assert H.rows(typed) == [(1, "3"), (2, "4")]


def test_csv_null_tokens_and_quotes(spark, tmp_path):
    df = files.read_csv(spark, write(tmp_path / "t.csv", 'a,b\nNA,"say ""hi"", you"\n,None\n'))
    assert H.rows(df) == [(None, 'say "hi", you'), (None, None)]


def test_csv_line_breaks_in_fields(spark, tmp_path):
    path = write(tmp_path / "t.csv", 'a,b\n1,"two\nlines"\n2,x\n')
    assert H.rows(files.read_csv(spark, path, multi_line=True)) == [("1", "two\nlines"), ("2", "x")]


def test_missing_file(spark, tmp_path):
    gone = str(tmp_path / "gone.csv")
    assert files.read_csv(spark, gone).columns == []
    empty = files.extract_orders(spark, str(tmp_path))
    assert empty.count() == 0 and empty.columns == RAW_SCHEMAS["orders"].names
    with pytest.raises(FileNotFoundError):
        files.read_csv(spark, gone, on_missing="raise")
    with pytest.raises(ValueError):
        files.read_csv(spark, gone, on_missing="ignore")


def test_unreadable_file(spark, tmp_path):
    bad = write(tmp_path / "bad.parquet", "this is not parquet")
    schema = STAR_SCHEMAS["dim_date"]
    with pytest.raises(Exception):
        files.read_table(spark, bad, schema=schema).count()
    assert files.read_table(spark, bad, schema=schema, on_error="empty").count() == 0
    assert files.read_table(spark, bad, on_error="empty").count() == 0


def test_ingest_order_follows_the_file(spark, tmp_path):
    lines = "".join(f"{i % 50},1,1,{i + 1},2024-01-01,x\n" for i in range(3000))
    write(tmp_path / "orders.csv", "order_id,customer_id,product_id,quantity,order_date,status\n" + lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        raw = files.extract_orders(spark, str(tmp_path))
        assert raw.rdd.getNumPartitions() > 1
        got = clean.clean_orders(raw).select("order_id", "quantity")
        assert sorted(H.rows(got)) == [(i, i + 1) for i in range(50)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_extract_all_and_views(spark, tmp_path):
    write(tmp_path / "customers.csv", "name,customer_id\nzoe,5\n")
    raw = files.extract_all(spark, str(tmp_path))
    assert {n: df.count() for n, df in raw.items()} == {"orders": 0, "customers": 1, "products": 0}
    assert H.rows(clean.clean_customers(raw["customers"])) == [(5, "Zoe", "unknown@example.com", "Unknown", None)]
    files.register_views({"people": raw["customers"]})
    assert spark.sql("select name from people").first()[0] == "zoe"


def test_get_table_and_preview(spark, tmp_path):
    assert files.get_table(spark, "dim_date", str(tmp_path)) is None
    spark.range(20).write.parquet(str(tmp_path / "numbers"))
    assert files.preview(files.get_table(spark, "numbers", str(tmp_path)), 7).count() == 7


def test_mapping(spark):
    df = spark.createDataFrame([("9", "n", "e", "l")], "cust string, name string, mail string, `where it is` string")
    assert default_mapping(df, "customers") == {"customer_id": "cust", "name": "name", "email": "cust", "location": "cust"}
    with pytest.raises(ValueError, match="more than once"):
        map_columns(df, "customers")
    got = map_columns(df, "customers", {"email": "mail", "location": "where it is"})
    assert got.columns == ["customer_id", "name", "email", "location"] and H.rows(got) == [("9", "n", "e", "l")]
    with pytest.raises(ValueError, match="not columns"):
        map_columns(df, "customers", {"phone": "mail"})


def test_upload_replace_and_append(spark, tmp_path):
    path = str(tmp_path / "customers.csv")
    one = spark.createDataFrame([("1", 'a "b", c')], "customer_id string, name string")
    warehouse.save_upload(one, path, "append")  # nothing there yet
    warehouse.save_upload(one.replace("1", "2"), path, "append")
    assert sorted(H.rows(files.read_csv(spark, path))) == [("1", 'a "b", c'), ("2", 'a "b", c')]
    warehouse.save_upload(one, path, "replace")
    assert files.read_csv(spark, path).count() == 1
    with pytest.raises(ValueError):
        warehouse.save_upload(one, path, "merge")


def small_star(spark):
    from test_star import fixture_star

    return fixture_star(spark)


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_star_zone_round_trip(spark, tmp_path, fmt):
    star = small_star(spark)
    warehouse.write_star(star, str(tmp_path), fmt=fmt)
    back = files.read_star(spark, str(tmp_path), fmt)
    for name, df in star.items():
        assert H.rows(back[name]) == H.rows(df), name


def test_load_full_is_repeatable_incremental_grows(spark, tmp_path):
    star = small_star(spark)
    place = str(tmp_path / "dwh")

    def counts(loaded):
        return {r["table_name"]: r["loaded_rows"] for r in warehouse.verify_load(loaded, star).collect()}

    want = {n: df.count() for n, df in star.items()}
    for _ in range(2):
        assert counts(warehouse.load_all(star, "path", "full", warehouse=place)) == want
    assert counts(warehouse.load_all(star, "path", "incremental", warehouse=place)) == {n: 2 * c for n, c in want.items()}
    again = warehouse.load_all(star, "path", "incremental", warehouse=place, skip_known=True)
    assert counts(again) == {n: 2 * c for n, c in want.items()}
    fresh = str(tmp_path / "dwh2")
    assert counts(warehouse.load_all(star, "path", "incremental", warehouse=fresh, skip_known=True)) == want


def test_load_catalog(spark):
    star = small_star(spark)
    warehouse.create_tables(spark, "shop")
    assert spark.table("shop.fact_orders").count() == 0
    warehouse.create_tables(spark, "shop")  # exists: no error
    loaded = warehouse.load_all(star, database="shop")
    assert all(r["matches"] for r in warehouse.verify_load(loaded, star).collect())
    twice = warehouse.load_all(star, "catalog", "incremental", database="shop")
    for name, pk in PRIMARY_KEYS.items():
        assert twice[name].count() == 2 * star[name].count()
        assert twice[name].select(pk).distinct().count() == star[name].count()
    same = warehouse.load_all(star, "catalog", "incremental", database="shop", skip_known=True)
    assert same["fact_orders"].count() == 2 * star["fact_orders"].count()


def test_load_connector(spark, tmp_path):
    star = small_star(spark)
    loaded = warehouse.load_all(star, "connector", fmt="json", table_option="path", prefix=f"{tmp_path}/")
    assert all(r["matches"] for r in warehouse.verify_load(loaded, star).collect())


def test_load_rejects_unknown_names(spark):
    with pytest.raises(ValueError, match="unknown target"):
        warehouse.load_all({}, "tape")
    with pytest.raises(ValueError, match="unknown load mode"):
        warehouse.load_all({}, "path", "sometimes", warehouse="/nowhere")


def test_report_round_trip(spark, tmp_path):
    path = str(tmp_path / "report")
    assert artifacts.read_report(spark, path) is None
    report = spark.createDataFrame([("a", "t", True, "x, y")], "check string, table string, passed boolean, details string")
    for fmt in ("parquet", "csv"):
        artifacts.write_report(report, path, fmt)
        assert H.rows(artifacts.read_report(spark, path, fmt)) == [("a", "t", True, "x, y")]


def test_logs(spark, tmp_path):
    write(tmp_path / "run_1.log", "10:00 [INFO] start\n10:01 [ERROR] broke\n")
    write(tmp_path / "run_2.log", "11:00 [WARNING] odd\nplain\n")
    write(tmp_path / "notes.txt", "ERROR in a text file\n")
    logs = artifacts.read_logs(spark, str(tmp_path))
    assert [r[0] for r in artifacts.log_files(logs).collect()] == ["run_2.log", "run_1.log"]
    assert sorted(r["value"] for r in artifacts.filter_logs(logs).collect()) == [
        "10:00 [INFO] start", "10:01 [ERROR] broke", "11:00 [WARNING] odd",
    ]
    assert [r["value"] for r in artifacts.filter_logs(logs, ["ERROR"]).collect()] == ["10:01 [ERROR] broke"]
    assert artifacts.filter_logs(logs, []).count() == 0


def test_manifests(spark, tmp_path):
    run = {
        "status": "SUCCESS", "mode": "full", "env": "dev", "timestamp": "2026-01-01T00:00:00",
        "steps": {"extract": {"status": "PASS", "duration": 0.5}, "load": {"status": "PASS", "duration": 1.5, "row_counts": {"a": 3, "b": 4}}},
        "total_duration": 2.0,
    }
    write(tmp_path / "one.json", json.dumps(run, indent=2))
    write(tmp_path / "two.json", json.dumps({**run, "status": "FAILED", "steps": {}, "error": "boom"}, indent=2))
    manifests = artifacts.read_manifests(spark, str(tmp_path))
    assert manifests.filter("error = 'boom'").count() == 1
    steps = [tuple(r)[3:6] for r in artifacts.manifest_steps(manifests).orderBy("step").collect()]
    assert steps == [("extract", "PASS", 0.5), ("load", "PASS", 1.5)]
    assert H.rows(artifacts.manifest_row_counts(manifests)) == [
        ("2026-01-01T00:00:00", "load", "a", 3), ("2026-01-01T00:00:00", "load", "b", 4),
    ]


def test_nested_report_file(spark, tmp_path):
    report = {"t": {"success": False, "statistics": {"evaluated_expectations": 2, "successful_expectations": 1,
              "unsuccessful_expectations": 1, "success_percent": 50.0},
              "results": [{"check": "a", "success": True, "message": ""}, {"check": "b", "success": False, "message": "m"}]}}
    path = write(tmp_path / "report.json", json.dumps(report, indent=2))
    assert H.rows(artifacts.read_nested_report(spark, path)) == [
        ("t", "a", True, "", False, 50.0), ("t", "b", False, "m", False, 50.0),
    ]


def test_files_of_a_folder_keep_their_own_headers(spark, tmp_path):
    folder = tmp_path / "products.csv"
    folder.mkdir()
    (folder / "a.csv").write_text("product_id,product_name,price,supplier\n1,x,2.5,acme\n")
    (folder / "b.csv").write_text("price,product_id,product_name\n" + "7.5,2,y\n" * 50)
    rows = files.extract_raw(spark, str(tmp_path), "products").select("product_id", "product_name", "price", "supplier").distinct().collect()
    assert sorted(map(tuple, rows), key=str) == [("1", "x", "2.5", "acme"), ("2", "y", "7.5", None)]
    (folder / "c.csv").write_text("foo,bar\n1,2\n")
    with pytest.raises(ValueError, match="shares no column"):
        files.extract_raw(spark, str(tmp_path), "products")


def test_a_missing_table_has_the_ingest_order(spark, tmp_path):
    from skeinmart.operators import clean

    assert clean.clean_customers(files.extract_raw(spark, str(tmp_path), "customers")).count() == 0


def test_clear_scratch_leaves_no_folder(spark):
    from skeinmart import session

    df = session.materialize(spark.range(5), "numbers")
    folder = session.shared_dir(spark)
    assert df.count() == 5 and os.path.isdir(folder)
    session.clear_scratch(spark)
    assert not os.path.exists(folder)
    assert session.shared_dir(spark) != folder and session.materialize(spark.range(3), "numbers").count() == 3


def test_files_state_sees_an_older_file_of_the_same_size(spark, tmp_path):
    from skeinmart.sources.files import files_state

    for name in "ab":
        (tmp_path / name).write_text("x")
    before = files_state(spark, [str(tmp_path)])
    assert files_state(spark, [str(tmp_path)]) == before
    os.utime(tmp_path / "a", (1, 1))
    assert files_state(spark, [str(tmp_path)]) != before
