"""Hot keys, bucketed orders, splits and the shape of the plans."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from ticketloom.catalog import load
from ticketloom.operators import aggregates, drift, ordering, sampling, skew, windows
from ticketloom.session import shared_dir


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one key, some have none."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(F.concat(F.lit("k"), F.col("id") % 97))
    return spark.range(6000).select("id", key.alias("key"))


@pytest.mark.parametrize("how", ["left", "inner", "left_semi"])
def test_skew_join_equals_join(spark, skewed, how):
    table = skewed.where("key is not null").groupBy("key").agg(F.count("*").alias("n")).where("n > 40")
    want = rows(skewed.join(table, "key", how).select("id", "key"))
    salted = skew.skew_join(skewed, table, ["key"], how, ["id"], salts=8)
    assert rows(salted.select("id", "key")) == want
    assert rows(skew.lookup_join(skewed, table, ["key"], how, ["id"]).select("id", "key")) == want
    assert rows(skew.lookup_join(skewed, table, ["key"], how, ["id"], max_rows=1).select("id", "key")) == want


def test_skew_join_spreads_hot_key(spark, skewed):
    table = skewed.where("key is not null").select("key").distinct()
    hot = skew.hot_keys(skewed, ["key"], 0.05)
    assert [r.key for r in hot.collect()] == ["hot"]
    joined = skew.skew_join(skewed, table, ["key"], "inner", ["id"], salts=16)
    assert joined.count() == skewed.where("key is not null").count()


def test_row_index_is_dense(spark):
    df = spark.range(5000).select((F.col("id") * F.col("id") % 100003).alias("id")).distinct()
    got = ordering.row_index(df, "id", "i", "n", buckets=7).orderBy("id").collect()
    assert [r.i for r in got] == list(range(len(got)))
    assert {r.n for r in got} == {len(got)}


def test_hashed_position_with_hot_stratum(spark, skewed):
    got = ordering.hashed_position(skewed, "id", 1, ["key"], digits=1).toPandas()
    for _, part in got.groupby("key", dropna=False):
        assert sorted(part["position"]) == list(range(1, len(part) + 1))
        assert set(part["stratum_size"]) == {len(part)}


@pytest.mark.parametrize(("test", "val"), [(0.15, 0.15), (0.3, 0.0), (0.0, 0.5), (1.0, 0.0)])
def test_split_is_complete_and_proportional(spark, skewed, test, val):
    split = sampling.stratified_split(skewed, ["key"], test, val, 9).toPandas()
    assert sorted(split["id"]) == list(range(6000))
    for _, part in split.groupby("key", dropna=False):
        n = len(part)
        counts = part["split"].value_counts()
        n_test = int(n * test + 0.5)
        assert counts.get("test", 0) == n_test
        assert counts.get("val", 0) == int((n - n_test) * val + 0.5)


def test_split_agrees_with_positions(spark, skewed):
    placed = sampling.stratified_position(skewed, ["key"], 9)
    want = placed.where(F.col("position") <= F.round(F.col("stratum_size") * 0.15)).select("id")
    got = sampling.stratified_split(skewed, ["key"], 0.15, 0.0, 9).where("split = 'test'").select("id")
    assert rows(want) == rows(got)


def test_stratified_sample(spark, skewed):
    got = sampling.stratified_sample(skewed, ["key"], 600, 3).toPandas()
    sizes = skewed.toPandas()["key"].value_counts(dropna=False)
    for key, part in got.groupby("key", dropna=False):
        n = sizes[key] if isinstance(key, str) else sizes[sizes.index.isna()].iloc[0]
        assert len(part) == max(1, int(n * 600 / 6000))
    assert sampling.stratified_sample(skewed, ["key"], 6000).count() == 6000


def test_running_sums_over_buckets(spark):
    rng = np.random.default_rng(1)
    values = {g: np.unique(np.round(rng.exponential(size=300), 2)) for g in "ab"}
    data = [(g, float(v), int(i % 5 + 1)) for g, vs in values.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(data, "g string, v double, n int")
    got = ordering.running_sums(df, "g", "v", ["n"], buckets=4).orderBy("g", "v").collect()
    for g, vs in values.items():
        mine = [r for r in got if r.g == g]
        assert [r.cum_n for r in mine] == list(np.cumsum([i % 5 + 1 for i in range(len(vs))]))
        assert [r.next_value for r in mine] == [*map(float, vs[1:]), None]


def test_profile_against_numpy(spark):
    rng = np.random.default_rng(2)
    x = np.round(rng.normal(size=501), 1)
    data = [(float(v) if i % 7 else None, 5.0) for i, v in enumerate(x)]
    got = {r.column: r for r in aggregates.data_profile(spark.createDataFrame(data, "x double, c double"), ["x", "c"]).collect()}
    kept = np.array([v for v, _ in data if v is not None])
    assert got["x"].missing == len(data) - len(kept)
    for q, name in ((0.25, "q25"), (0.5, "median"), (0.75, "q75")):
        assert got["x"][name] == pytest.approx(np.quantile(kept, q))
    assert got["x"].distinct == len(set(kept))
    assert got["c"].most_frequent == 5.0 and got["c"].std == 0.0


def test_drift_against_numpy(spark):
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=700), rng.normal(0.5, 1.2, size=400)
    ref = spark.createDataFrame([(float(v), int(v > 0)) for v in a], "x double, f int")
    cur = spark.createDataFrame([(float(v), int(v > 0)) for v in b], "x double, f int")
    got = {r.column: r for r in drift.column_drift(ref, cur, ["x", "f"]).collect()}
    grid = np.sort(np.concatenate([a, b]))
    fa, fb = (np.searchsorted(np.sort(s), grid, side="right") / len(s) for s in (a, b))
    area = float(np.sum(np.abs(fa - fb)[:-1] * np.diff(grid)))
    assert got["x"].method == "wasserstein" and got["x"].score == pytest.approx(area / a.std())
    p, q = np.array([(a <= 0).mean(), (a > 0).mean()]), np.array([(b <= 0).mean(), (b > 0).mean()])
    m = (p + q) / 2
    js = np.sqrt(0.5 * (p * np.log(p / m)).sum() + 0.5 * (q * np.log(q / m)).sum())
    assert got["f"].method == "jensen-shannon" and got["f"].score == pytest.approx(js)
    assert got["x"].drifted


def test_no_drift_on_few_rows(spark):
    few = spark.range(99).select(F.col("id").cast("double").alias("x"))
    many = spark.range(500).select((F.col("id") + 1000).cast("double").alias("x"))
    result = drift.dataset_drift(drift.column_drift(many, few, ["x"]), many, few).first()
    assert (result.drift_share, result.dataset_drift, result.n_cur) == (0.0, False, 99)


def test_empty_inputs(spark):
    empty = spark.createDataFrame([], "x double, label string, prediction string")
    assert aggregates.class_distribution(empty, "label").count() == 0
    assert aggregates.cache_hit_rate(empty.withColumn("embedding", F.lit(None))).first().hit_rate == 0.0
    assert drift.column_drift(empty, empty, ["x"]).count() == 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans(spark, sf):
    queries = load()
    assert "WindowGroupLimit" in plan(queries["latest_per_key"].run(spark, sf))
    assert "GreaterThanOrEqual(ts" in plan(queries["last_days"].run(spark, sf))
    assert "TakeOrderedAndProject" in plan(queries["hash_sample"].run(spark, sf))
    for name in ("refine_queue", "clean_text", "keyword_flags"):
        text = plan(queries[name].run(spark, sf))
        assert "Python" not in text and "SinglePartition" not in text
    for name in ("retrieve_filtered_by_grid", "attach_class_weight", "apply_feedback", "stratified_split"):
        text = plan(queries[name].run(spark, sf))
        assert "CartesianProduct" not in text and "NestedLoop" not in text
    split = plan(queries["stratified_split"].run(spark, sf))
    assert "hashpartitioning(queue" not in split and "Window" not in split


def test_top_k_and_shares(spark):
    counts = spark.createDataFrame([("a", 1), ("b", 3)], "c string, count bigint")
    assert rows(windows.share_of_total(counts).select("c", "share")) == [("a", 0.25), ("b", 0.75)]


def test_shared_dir_follows_the_setting(spark, tmp_path):
    assert shared_dir(spark) == shared_dir(spark)
    assert spark.sparkContext.getCheckpointDir() is not None
