"""Work that must not grow faster than the input: shares of tasks, sides of joins, jobs run once."""

from contextlib import contextmanager

import helpers as H
import pytest
from pyspark.sql import functions as F

from skeinmart.operators.counts import row_counts
from skeinmart.plans import catalogue, loads, snapshot
from skeinmart.sources import artifacts, published
from skeinmart.sources.files import FilesState
from test_star import fixture_star

SMOKE = "/root/testdata/sf0.001"


@contextmanager
def settings(spark, **values):
    keys = {k: f"spark.sql.{k.replace('__', '.')}" for k in values}
    before = {k: spark.conf.get(keys[k], None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(keys[k], v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(keys[k]) if v is None else spark.conf.set(keys[k], v)


def test_tasks_get_a_bounded_share_of_the_tables(spark, monkeypatch):
    monkeypatch.setattr(snapshot, "files_state", lambda *_: FilesState(6, 1 << 30, "x"))
    with settings(spark, shuffle__partitions="4", files__maxPartitionBytes="128m"):
        snapshot._state(spark, SMOKE)
        assert int(spark.conf.get("spark.sql.shuffle.partitions")) == 64
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == f"{32 << 20}b"
    with settings(spark, shuffle__partitions="400", files__maxPartitionBytes="1m"):
        snapshot._state(spark, SMOKE)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "400"
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "1m"


def test_report_is_validated_once(spark, monkeypatch):
    written, original = [], artifacts.write_report
    monkeypatch.setattr(artifacts, "write_report", lambda df, *a: (written.append(H.plan(df)), original(df, *a)))
    assert catalogue.registry()["report_round_trip"](spark, SMOKE).count() == 32
    assert len(written) == 2 and not any("HashAggregate" in plan for plan in written)


def test_previews_are_the_small_side(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(loads, "row_counts", lambda tables: (seen.append(tables), row_counts(tables))[1])
    with settings(spark, autoBroadcastJoinThreshold="-1", maxMetadataStringLength="2000"):
        loads.preview_tables(spark, SMOKE)
        for name, df in seen[1].items():
            plan = H.plan(df)
            assert plan.index(f"/{name}]") < plan.index("/preview-"), "the right side of a half join is what is broadcast"


@pytest.mark.parametrize("constraints", ["off", "report"])
def test_unique_keys_are_counted_in_the_written_buckets(spark, tmp_path, monkeypatch, constraints):
    star, house = fixture_star(spark), published.Warehouse(spark, str(tmp_path / "w"), buckets=4)
    customers = star["dim_customers"]
    nulls = customers.withColumn("customer_id", F.lit(None).cast("long"))
    planted = {**star, "dim_customers": customers.unionByName(customers).unionByName(customers.limit(1)).unionByName(nulls)}
    counted, original = [], published.Warehouse._repeated
    monkeypatch.setattr(published.Warehouse, "_repeated", staticmethod(lambda df, key: (counted.append(key), original(df, key))[1]))
    broken = {(t, c): n for t, c, n in house.load(planted, "a", constraints=constraints).violations}
    assert len(counted) == (0 if constraints == "off" else 4), "nothing is looked at that nobody asked for"
    if constraints == "report":
        assert broken["dim_customers", "unique: customer_id"] == customers.count() + 1
    keys = house.table("dim_customers").groupBy("customer_id").agg(F.count("*").alias("n"))
    assert "Exchange" not in H.plan(keys)
