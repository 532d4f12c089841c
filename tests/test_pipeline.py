"""The whole run, its stages and its gates."""

import csv

import pytest

import helpers as H
from skeinmart.operators.quality import QualityError
from skeinmart.plans import pipeline
from skeinmart.plans.pipeline import Zones
from skeinmart.sources import artifacts, files


def raw_folder(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    tables = {
        "orders": (["order_id", "customer_id", "product_id", "quantity", "order_date", "status"], H.RAW_ORDERS),
        "customers": (["customer_id", "name", "email", "location", "signup_date"], H.RAW_CUSTOMERS),
        "products": (["product_id", "product_name", "category", "price", "supplier"], H.RAW_PRODUCTS),
    }
    for name, (header, rows) in tables.items():
        with open(folder / f"{name}.csv", "w", newline="") as f:
            out = csv.writer(f)
            out.writerow(header)
            out.writerows(rows)
    return str(folder)


@pytest.fixture
def zones(tmp_path):
    return Zones(raw_folder(tmp_path), f"{tmp_path}/transformed", f"{tmp_path}/validated", f"{tmp_path}/manifests")


WANT = {"dim_date": 2, "dim_customers": 3, "dim_products": 3, "fact_orders": 3}


def test_run_warns_and_goes_on(spark, zones, tmp_path):
    result = pipeline.run_pipeline(
        spark, zones, target="path", load_options={"warehouse": f"{tmp_path}/dwh"}
    )
    assert result.status == "SUCCESS" and result.failed_checks == 4  # too few rows in every table
    assert list(result.steps) == ["extract", "transform", "validate", "load"]
    assert result.steps["transform"]["row_counts"] == WANT
    assert H.rows(files.read_star(spark, f"{tmp_path}/dwh")["fact_orders"])[0] == (
        1, 10, 100, 20240115, 2, 29.99, 59.98, "completed",
    )
    assert artifacts.read_report(spark, f"{zones.validated}/validation_report").count() == 16
    manifests = artifacts.read_manifests(spark, zones.manifests)
    assert [r["step_status"] for r in artifacts.manifest_steps(manifests).collect()] == ["PASS"] * 4
    assert {(r["step"], r["table_name"], r["row_count"]) for r in artifacts.manifest_row_counts(manifests).collect()} == {
        (s, t, n) for s in ("transform", "load") for t, n in WANT.items()
    }


def test_strict_gate_stops_before_the_load(spark, zones, tmp_path):
    with pytest.raises(QualityError):
        pipeline.run_pipeline(
            spark, zones, target="path", gate_mode="fail", load_options={"warehouse": f"{tmp_path}/dwh"}
        )
    assert not (tmp_path / "dwh").exists()
    failed = artifacts.read_manifests(spark, zones.manifests).first()
    assert failed["status"] == "FAILED" and "4 checks failed" in failed["error"] and "QualityError" in failed["traceback"]
    assert failed["steps"]["validate"]["status"] == "FAIL" and "load" not in failed["steps"]


def test_gate_off_and_incremental(spark, zones, tmp_path):
    for mode in ("full", "incremental"):
        result = pipeline.run_pipeline(
            spark, zones, target="path", mode=mode, gate_mode="off", load_options={"warehouse": f"{tmp_path}/dwh"}
        )
        assert result.failed_checks == 0
    assert files.read_star(spark, f"{tmp_path}/dwh")["fact_orders"].count() == 6
    assert result.steps["load"]["row_counts"] == {t: 2 * n for t, n in WANT.items()}
    assert artifacts.read_manifests(spark, zones.manifests).count() == 2


def test_stages_hand_over_by_files(spark, zones, tmp_path):
    assert pipeline.stage_extract(spark, zones) == {"orders": 6, "customers": 4, "products": 3}
    assert pipeline.stage_transform(spark, zones) == WANT
    with pytest.raises(QualityError):
        pipeline.stage_validate(spark, zones)
    loaded = pipeline.stage_load(spark, zones, "path", warehouse=f"{tmp_path}/dwh")
    assert {n: df.count() for n, df in loaded.items()} == WANT


def test_zone_equals_lazy_transform(spark, zones):
    raw = files.extract_all(spark, zones.raw)
    pipeline.transform_to_zone(spark, raw, zones.transformed)
    stored = files.read_star(spark, zones.transformed)
    for name, df in pipeline.transform_all(raw).items():
        assert H.rows(stored[name]) == H.rows(df), name


def test_order_dates_in_other_forms(spark, zones, tmp_path):
    path = f"{zones.raw}/orders.csv"
    text = open(path).read()

    def facts(rewritten, **options):
        with open(path, "w") as f:
            f.write(rewritten)
        pipeline.run_pipeline(
            spark, zones, target="path", gate_mode="off", load_options={"warehouse": f"{tmp_path}/dwh"}, **options
        )
        return H.rows(files.read_star(spark, f"{tmp_path}/dwh")["fact_orders"])

    plain = facts(text)
    assert len(plain) == 3
    assert facts(text.replace("2024-01-15", "2024-01-15 10:30:00")) == plain
    slashed = text.replace("2024-01-15", "15/01/2024").replace("2024-02-20", "20/02/2024")
    assert facts(slashed, cleaning=pipeline.Cleaning(order_dates="dd/MM/yyyy")) == plain
