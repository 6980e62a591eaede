"""Scratch scopes, reserved ids, versions of tables, range sums, hold-out search, language by n-grams."""

from __future__ import annotations

import os
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from ticketloom.operators import aggregates, language, models, ordering
from ticketloom.session import create_once, cut_lineage, folder_names, scratch_scope, shared_dir
from ticketloom.sources import tables


def scratch(spark):
    return set(folder_names(spark, shared_dir(spark)))


def test_a_scope_leaves_nothing_but_what_is_kept(spark):
    before = scratch(spark)
    with scratch_scope(spark) as outer:
        first = cut_lineage(spark.range(10))
        with scratch_scope(spark) as inner:
            second = cut_lineage(first.where("id > 4"))
            kept = inner.kept(second.where("id > 6"))
        assert kept.count() == 3 and len(scratch(spark) - before) == 2
        last = outer.kept(kept)
    assert last.count() == 3 and len(scratch(spark) - before) == 1
    with pytest.raises(ZeroDivisionError), scratch_scope(spark):
        cut_lineage(spark.range(3))
        raise ZeroDivisionError
    assert len(scratch(spark) - before) == 1


def test_concurrent_batches_get_different_ids(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "ID_RANGE", 16)
    path = str(tmp_path / "log")
    before = scratch(spark)
    batches = [(f"b{n}", spark.range(n * 13, numPartitions=3).select(F.col("id").alias("v"))) for n in range(6)]
    with ThreadPoolExecutor(6) as pool:
        done = list(pool.map(lambda b: tables.append_log(b[1], path, b[0]), batches))
    assert scratch(spark) == before
    assert [d.count() for d in done] == [n * 13 for n in range(6)]
    stored = spark.read.parquet(path)
    ids = [r.id for r in stored.collect()]
    assert len(ids) == len(set(ids)) == 13 * 15 and min(ids) > 0
    assert stored.columns == ["id", "v", "batch"]
    # ids of a batch are dense in its ranges: as many ranges as it takes
    taken = [n for n in os.listdir(f"{path}/{tables.RESERVED}") if n.isdigit()]
    assert len(taken) == sum(-(-n * 13 // 16) for n in range(6))
    assert create_once(spark, str(tmp_path / "x" / "once")) and not create_once(spark, str(tmp_path / "x" / "once"))


def test_old_versions_are_dropped(spark, tmp_path):
    tables.replace_table(spark.range(5), "lifecycle_reload", path=str(tmp_path / "t"))
    for n in (3, 4):
        tables.reload_table(spark.range(n), "lifecycle_reload")
    assert len(tables.drop_old_versions(spark, "lifecycle_reload")) == 2
    assert spark.table("lifecycle_reload").count() == 4 and len(os.listdir(tmp_path)) == 1
    assert tables.drop_old_versions(spark, "lifecycle_reload") == []
    spark.sql("DROP TABLE lifecycle_reload")


def test_range_sums_have_no_borders_in_the_plan(spark):
    rng = np.random.default_rng(1)
    values = {g: np.unique(np.round(rng.exponential(size=3000), 3)) for g in ("a", "b", None)}
    rows = [(g, float(v), i % 5 + 1) for g in ("a", "b") for i, v in enumerate(values[g])]
    df = spark.createDataFrame(rows, "g string, v double, n int")
    plans = {}
    for buckets in (1, 7, 40):
        summed = ordering.running_sums(df, "g", "v", ["n"], buckets=buckets)
        plans[buckets] = len(summed._jdf.queryExecution().optimizedPlan().toString())
        got = summed.orderBy("g", "v").collect()
        for g in "ab":
            mine = [r for r in got if r.g == g]
            assert [r.cum_n for r in mine] == list(np.cumsum([i % 5 + 1 for i in range(len(values[g]))]))
            assert [r.next_value for r in mine] == [*map(float, values[g][1:]), None]
    assert max(plans.values()) - min(plans.values()) < 200
    assert ordering.running_sums(df.limit(0), "g", "v", ["n"]).count() == 0


def test_moments_read_the_rows_once(spark):
    df = spark.createDataFrame([(1.0, 2), (float("nan"), 4), (None, None), (3.0, 6)], "x double, y int")
    got = {r.column: r for r in aggregates.moments(df, ["x", "y"]).collect()}
    assert (got["x"].n_rows, got["x"].missing, got["x"].mean, got["x"].max) == (4, 2, 2.0, 3.0)
    assert (got["y"].missing, got["y"].min, got["y"].std) == (1, 2.0, 2.0)
    plan = aggregates.moments(df, ["x", "y"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Expand" not in plan


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(600):
        kind = "rare" if i % 10 == 0 else "common"
        centre = 1.5 if kind == "rare" else 0.0
        rows.append((i, kind if i % 50 else None, (centre + rng.normal(size=3)).tolist()))
    df = spark.createDataFrame(rows, "id bigint, kind string, x array<double>")
    return df.select("id", "kind", array_to_vector("x").alias("features")).cache()


def test_holdout_search_weighs_classes_of_the_trained_part(points):
    sets = [{"max_depth": 2, "n_estimators": 4}, {"max_depth": 3, "n_estimators": 8, "learning_rate": 0.3}]
    found = models.random_search(points, "kind", sets, balanced=True, validation=models.HOLDOUT, share=0.25).collect()
    marked = models.validation_parts(points, "kind", models.HOLDOUT, share=0.25)
    held, rest = marked.where("part = 0").count(), marked.where("part is null").count()
    assert held + rest == 588 and 100 < held < 200
    for r in found:
        assert [(p.part, p.n_train, p.n_valid) for p in r.parts] == [(0, rest, held)] and r.score == r.parts[0].score
        assert r.score > 0.7
    folds = models.random_search(points, "kind", sets[:1], 3).first()
    assert sorted(p.part for p in folds.parts) == [0, 1, 2] and sum(p.n_valid for p in folds.parts) == 588
    assert folds.score == pytest.approx(sum(p.score for p in folds.parts) / 3)


def test_character_ngrams(spark):
    df = spark.createDataFrame([("Aé b!1",), ("",), (None,), ("ab" * 40_000,)], "t string")
    grams = [r[0] for r in df.limit(1).select(language.char_ngrams(language._letters("t"))).collect()][0]
    assert sorted(grams) == sorted(["a", "é", " ", "b", " ", "aé", "é ", " b", "b ", "aé ", "é b", " b "])
    vectors = language.with_ngrams(df, "t").select("t", vector_to_array("__features").alias("v")).collect()
    assert [sum(r.v) for r in vectors] == [12, 0, 0, 80_000 + 79_999 + 79_998]
