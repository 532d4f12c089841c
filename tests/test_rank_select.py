"""Exact medians and draws against brute force, also with one hot group."""

import hashlib
import random
import statistics

import helpers as H
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F
from skeinmart.operators import inject
from skeinmart.operators.rank_select import value_bucket, weighted_medians


def counted(spark, rows):
    df = spark.createDataFrame(rows, "g string, v double")
    return df.groupBy("g", "v").agg(F.count("*").alias("n"))


def expected(rows):
    groups = {}
    for g, v in rows:
        if g is not None and v is not None:
            groups.setdefault(g, []).append(v)
    return {g: statistics.median(vs) for g, vs in groups.items()}


def medians(spark, rows):
    return {r["g"]: r["median"] for r in weighted_medians(counted(spark, rows), ["g"], "v", "n").collect()}


def test_medians_with_a_hot_group(spark):
    rnd = random.Random(7)
    rows = [("hot" if rnd.random() < 0.4 else f"g{rnd.randrange(9)}", round(rnd.uniform(0, 500), 2)) for _ in range(6000)]
    rows += [(None, 1.0), ("g1", None), ("one", 3.25), ("same", 2.0), ("same", 2.0)]
    rows += [("signs", v) for v in (-5.0, -0.5, 0.0, 0.25, 1e-9, 7e9)]
    assert medians(spark, rows) == expected(rows)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["a", "b"]), st.floats(-1e12, 1e12, allow_nan=False)), min_size=1, max_size=60))
def test_medians_property(spark, rows):
    assert medians(spark, rows) == expected([(g, v + 0.0) for g, v in rows])


def test_buckets_follow_the_order(spark):
    rnd = random.Random(1)
    values = sorted([0.0, 5e-324, -5e-324, 1.7e308, -1.7e308] + [rnd.choice([-1, 1]) * 10 ** rnd.uniform(-9, 9) for _ in range(3000)])
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = [r["b"] for r in df.select("i", value_bucket(F.col("v")).alias("b")).orderBy("i").collect()]
    assert got == sorted(got)


def test_medians_rank_inside_one_bucket_only(spark):
    text = H.plan(weighted_medians(counted(spark, [("a", 1.0)]), ["g"], "v", "n"))
    assert "Python" not in text
    # No window is ordered by value over a whole group.
    windows = [line for line in text.splitlines() if "Window [sum(__w" in line]
    assert windows and all("__bucket" in line for line in windows)


def chosen(ids, draw, k, seed="42"):
    return set(sorted(ids, key=lambda i: (hashlib.md5(f"{seed}|{draw}|{i}".encode()).hexdigest(), i))[:k])


def test_inject_nulls_exact_cells(spark):
    n = 997
    df = spark.range(n).select(F.col("id").cast("string").alias("rid"), F.lit("x").alias("a"), F.lit("y").alias("b"))
    got = inject.inject_nulls(df, 0.1, ["a", "b"], F.col("rid")).collect()
    ids = [str(i) for i in range(n)]
    for c in ("a", "b"):
        assert {r["rid"] for r in got if r[c] is None} == chosen(ids, c, int(n * 0.1))
    assert len(got) == n


def test_inject_edges(spark):
    df = spark.range(10).select(F.col("id").cast("string").alias("rid"), F.lit("x").alias("a"), F.col("id").alias("seq"))
    assert inject.inject_nulls(df, 0.01, ["a"], F.col("rid")).filter("a is null").count() == 0
    assert inject.inject_nulls(df, 1.0, ["a"], F.col("rid")).filter("a is null").count() == 10
    twice = inject.inject_duplicates(df, 0.35, F.col("rid"), "seq")
    copies = [r for r in twice.collect() if r["seq"] > 9]
    assert twice.count() == 13 and {r["rid"] for r in copies} == chosen([str(i) for i in range(10)], "rows", 3)
