"""The published warehouse: repeated appends, broken loads, digests, keys, and plans."""

import pytest
from pyspark.sql import functions as F

import helpers as H
from skeinmart.plans import pipeline
from skeinmart.schemas import STAR_SCHEMAS, STAR_TABLES
from skeinmart.sources import published
from skeinmart.sources.warehouse import load_all


@pytest.fixture(scope="module")
def star(spark):
    raw = {"orders": H.orders(spark), "customers": H.customers(spark), "products": H.products(spark)}
    lazy = pipeline.transform_all(raw, {t: ["seq"] for t in raw})
    return {name: spark.createDataFrame(lazy[name].collect(), STAR_SCHEMAS[name]) for name in STAR_TABLES}


def counts(tables):
    return {name: df.count() for name, df in tables.items()}


def test_retried_append_and_versions(spark, star, tmp_path):
    house = published.Warehouse(spark, str(tmp_path / "w"), buckets=2)
    with pytest.raises(FileNotFoundError):
        house.read()
    once = counts(star)
    house.load(star, "a")
    first = house.load(star, "b", "incremental", constraints="report")
    assert ("fact_orders", "unique in the warehouse: order_id", once["fact_orders"]) in first.violations
    assert house.load(star, "b", "incremental") == first and house.version() == 2
    assert counts(house.read()) == {n: 2 * c for n, c in once.items()}
    assert counts(house.read(1)) == once, "an older version is still there"
    with pytest.raises(published.ConstraintError, match="unique in the warehouse"):
        house.load(star, "c", "incremental")
    assert house.version() == 2
    added = house.load(star, "c", "incremental", skip_known=True)
    assert {n: c.rows for n, c in added.tables.items()} == dict.fromkeys(star, 0)
    house.load(star, "a", "full")
    assert counts(house.read()) == once and [b.batch_id for b in house.batches()] == ["a"]
    again = published.Warehouse(spark.newSession(), str(tmp_path / "w"))
    assert counts(again.read()) == once and published.version_rows(again.batches(), spark).count() == 4


def test_broken_load_leaves_the_old_star(spark, star, tmp_path, monkeypatch):
    house = published.Warehouse(spark, str(tmp_path / "w"), buckets=2)
    house.load(star, "a")
    once = counts(star)
    other = {**star, "dim_customers": star["dim_customers"].limit(1)}
    with monkeypatch.context() as m:
        m.setattr(published, "content", _broken_for(published, "fact_orders"))
        with pytest.raises(published.ContentError, match="fact_orders"):
            house.load(other, "b", "full", constraints="off")
    assert counts(house.read()) == once and house.version() == 1
    house.load(star, "c", "incremental", constraints="off")  # the same version number, another batch
    assert counts(house.read()) == {n: 2 * c for n, c in once.items()}


def _broken_for(module, table):
    original = module.content

    def content(df, name):
        found = original(df, name)
        return module.Content(found.rows - 1, found.sum, found.xor) if name == table else found

    return content


def test_two_loads_at_once(spark, star, tmp_path):
    house = published.Warehouse(spark, str(tmp_path / "w"), buckets=2)
    house._versions.add(1, '{"version": 1, "buckets": 2, "batches": []}')
    with pytest.raises(published.ConflictError):
        house._versions.add(1, "{}")
    assert house._versions.read(1).startswith('{"version": 1')


def test_keys_are_enforced(spark, star, tmp_path):
    house = published.Warehouse(spark, str(tmp_path / "w"), buckets=2)
    bad = dict(star)
    bad["dim_customers"] = star["dim_customers"].unionByName(star["dim_customers"].limit(1))
    bad["dim_products"] = star["dim_products"].withColumn("product_name", F.lit(None).cast("string"))
    bad["dim_date"] = star["dim_date"].limit(0)
    with pytest.raises(published.ConstraintError) as e:
        house.load(bad, "a")
    found = {(t, c): n for t, c, n in e.value.violations}
    assert found["dim_customers", "unique: customer_id"] == 1
    assert found["dim_products", "not null: product_name"] == star["dim_products"].count()
    assert found["fact_orders", "foreign: date_id in dim_date"] == star["fact_orders"].count()
    assert house.version() == 0
    assert set(house.load(bad, "a", constraints="report").violations) == set(e.value.violations)


def test_bad_arguments(spark, star, tmp_path):
    house = published.Warehouse(spark, str(tmp_path / "w"))
    for options in ({"mode": "sometimes"}, {"constraints": "maybe"}):
        with pytest.raises(ValueError):
            house.load(star, "a", **options)
    for name in ("", "a/b", "a b"):
        with pytest.raises(ValueError):
            house.load(star, name)


def test_content_ignores_order_and_sees_each_row(spark, star):
    fact = star["fact_orders"]
    whole = published.content(fact, "fact_orders")
    assert published.content(fact.orderBy(F.desc("order_id")).repartition(3), "fact_orders") == whole
    assert published.content(fact.unionByName(fact.limit(1)), "fact_orders") != whole
    assert published.content(fact.withColumn("quantity", F.col("quantity") + 1), "fact_orders") != whole
    assert published.content(fact.limit(0), "fact_orders").rows == 0


def test_stored_keys_are_not_shuffled(spark, star, tmp_path):
    house = published.Warehouse(spark, str(tmp_path / "w"), buckets=4)
    house.load(star, "a")
    key = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(key, "-1")
    try:
        new = star["fact_orders"].join(house.table("fact_orders").select("order_id"), "order_id", "left_anti")
        plan = H.plan(new)
    finally:
        spark.conf.unset(key)
    stored = plan[plan.index("FileScan parquet") - 400 :]
    assert "Bucketed: true" in plan and plan.count("Exchange hashpartitioning") == 1 and "Exchange" not in stored.split("SortMergeJoin")[-1].split("FileScan")[-1]


def test_target_of_the_pipeline(spark, star, tmp_path):
    loaded = load_all(star, "published", "full", warehouse=str(tmp_path / "w"), batch_id="d1")
    assert counts(loaded) == counts(star)


def test_failed_load_does_not_transform_again(spark, tmp_path, monkeypatch):
    raw = {"orders": H.orders(spark), "customers": H.customers(spark), "products": H.products(spark)}
    by = {t: ["seq"] for t in raw}
    zones = pipeline.Zones(*(str(tmp_path / z) for z in ("raw", "star", "validated")))
    calls, original = [], pipeline.transform_to_zone
    monkeypatch.setattr(pipeline, "transform_to_zone", lambda *a, **k: calls.append(1) or original(*a, **k))
    options = {"raw": raw, "order_by": by, "target": "path", "resume": True, "load_options": {"warehouse": str(tmp_path / "w")}}
    with pytest.raises(Exception):
        pipeline.run_pipeline(spark, zones, **{**options, "load_options": {**options["load_options"], "fmt": "nothing"}}, input_key="k1")
    result = pipeline.run_pipeline(spark, zones, **options, input_key="k1")
    assert len(calls) == 1 and {n: s["status"] for n, s in result.steps.items()} == {
        "extract": "PASS", "transform": "SKIPPED", "validate": "SKIPPED", "load": "PASS",
    }
    with pytest.raises(Exception):
        pipeline.run_pipeline(spark, zones, **options, input_key="k1", gate_mode="fail")  # the noted checks failed
    pipeline.run_pipeline(spark, zones, **options, input_key="k2")
    assert len(calls) == 2
    with pytest.raises(ValueError, match="input_key"):
        pipeline.run_pipeline(spark, zones, **options)
