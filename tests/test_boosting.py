"""Second-order boosting against plain Python on small tables."""

import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from sparkmart.models import boosting as B
from sparkmart.models.train import SEARCH_SPACE, random_search, sample_space


def brute(x, y, edges, s):
    """Trees as {heap position: (feature, threshold, weight)} and the final margins."""
    margin, trees = np.full(len(y), math.log(y.mean() / (1 - y.mean()))), []
    s = {**B.DEFAULTS, **s}
    worth = lambda g, h: max(abs(g) - s["reg_alpha"], 0) ** 2 / (h + s["reg_lambda"])
    for _ in range(s["n_estimators"]):
        p = 1 / (1 + np.exp(-margin))
        g, h, tree = p - y, p * (1 - p), {}

        def grow(at, rows, depth):
            G, H = g[rows].sum(), h[rows].sum()
            w = -math.copysign(max(abs(G) - s["reg_alpha"], 0), G) / (H + s["reg_lambda"]) * s["learning_rate"]
            best = None
            for f in range(x.shape[1]) if depth < s["max_depth"] else ():
                for cut in edges[f]:
                    left = rows[x[rows, f] <= cut]
                    hl, gl = h[left].sum(), g[left].sum()
                    if min(hl, H - hl) < s["min_child_weight"] or len(left) in (0, len(rows)):
                        continue
                    gain = worth(gl, hl) + worth(G - gl, H - hl) - worth(G, H)
                    if gain > 1e-6 and gain >= s["gamma"] and (best is None or gain > best[0] + 1e-7):
                        best = (gain, f, cut)
            tree[at] = (best[1], best[2], w) if best else (-1, None, w)
            if best is None:
                margin[rows] += w
                return
            inside = x[rows, best[1]] <= best[2]
            grow(2 * at + 1, rows[inside], depth + 1)
            grow(2 * at + 2, rows[~inside], depth + 1)

        grow(0, np.arange(len(y)), 0)
        trees.append(tree)
    return trees, margin


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(4)
    x = np.stack([rng.integers(0, 12, 300), rng.integers(0, 5, 300), np.round(rng.normal(size=300), 1)], 1).astype(float)
    y = (x[:, 0] + 2 * x[:, 1] + 3 * rng.normal(size=300) > 10).astype(float)
    df = spark.createDataFrame([(i, *map(float, r), float(t), i % 3) for i, (r, t) in enumerate(zip(x, y))], "k long, a double, b double, c double, y double, fold int")
    return df.repartition(5).checkpoint(), x, y


SETTINGS = [{"n_estimators": 3, "max_depth": 3, "learning_rate": 0.5}, {"n_estimators": 2, "max_depth": 2, "reg_alpha": 1, "reg_lambda": 2, "gamma": 0.1, "min_child_weight": 5},
            {"n_estimators": 4, "max_depth": 1, "reg_lambda": 0, "min_child_weight": 0}]


def same(tree, want, edges):
    for at, (f, cut, w) in want.items():
        assert tree.feature[at] == f and tree.weight[at] == pytest.approx(w, abs=1e-6)
        assert f < 0 or edges[f][tree.bin[at]] == cut


def test_trees_and_leaf_weights(table, spark):
    df, x, y = table
    growth = B.grow(df, ["a", "b", "c"], "y", SETTINGS, "k")
    for m, s in zip(growth.models, SETTINGS):
        want, margin = brute(x, y, growth.edges, s)
        assert len(m.trees) == len(want)
        for tree, other in zip(m.trees, want):
            same(tree, other, growth.edges)
        model = PipelineModel(stages=[VectorAssembler(inputCols=["a", "b", "c"], outputCol="features"), B.as_spark_model(spark, m, growth.edges)])
        got = {r["k"]: r["probability"][1] for r in model.transform(df).collect()}
        assert np.allclose([got[i] for i in range(len(y))], 1 / (1 + np.exp(-margin)), atol=1e-6)


def test_folds_leave_their_rows_out(table):
    df, x, y = table
    growth = B.grow(df, ["a", "b", "c"], "y", SETTINGS[:1], "k", "fold", 3)
    growth.land()
    for m in growth.models:
        rows = np.flatnonzero(np.arange(len(y)) % 3 != m.fold)
        for tree, other in zip(m.trees, brute(x[rows], y[rows], growth.edges, SETTINGS[0])[0]):
            same(tree, other, growth.edges)
    scored = growth.held_out()
    assert scored.count() == len(y) and scored.where("model % 3 <> fold").count() == 0


def test_many_passes_and_landings_change_nothing(table, monkeypatch):
    df, _, _ = table
    settings = [{**SETTINGS[0], "subsample": 0.6, "colsample_bytree": 0.67}, SETTINGS[1]]
    one = B.grow(df, ["a", "b", "c"], "y", settings, "k")
    monkeypatch.setattr(B, "HISTOGRAM_BYTES", 1)
    monkeypatch.setattr(B, "LAND_EVERY", 1)
    two = B.grow(df.repartition(2), ["a", "b", "c"], "y", settings, "k")
    for m, n in zip(one.models, two.models):
        for s, t in zip(m.trees, n.trees):
            assert (s.feature == t.feature).all() and (s.bin == t.bin).all() and np.allclose(s.weight, t.weight)
    assert all(len({int(f) for f in t.feature if f >= 0}) <= 2 for t in one.models[0].trees)  # two of three columns per tree


def test_rows_are_dealt_over_the_cores(spark):
    df = spark.range(4096, numPartitions=1).select("id", (F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 2).cast("double").alias("y"))
    growth = B.grow(df, ["a"], "y", [{"n_estimators": 1, "max_depth": 1}], "id")
    parts = growth.state.groupBy(F.input_file_name()).count().collect()  # one file per core, or one per 1,024 rows
    assert len(parts) == min(spark.sparkContext.defaultParallelism, 4) and sum(r["count"] for r in parts) == 4096
    assert max(r["count"] for r in parts) <= 2 * min(r["count"] for r in parts)


def test_margins_are_kept_for_growing_models_only(table, monkeypatch):
    df, _, _ = table
    settings = [{**SETTINGS[0], "n_estimators": 1}, {**SETTINGS[0], "n_estimators": 3}]
    monkeypatch.setattr(B, "LAND_EVERY", 1)
    growth = B.grow(df, ["a", "b", "c"], "y", settings, "k", "fold", 3)
    assert growth.kept.tolist() == [3, 4, 5] and growth.fresh == 1
    assert {len(r["margins"]) for r in growth.state.select("margins").collect()} == {3 * 8}
    monkeypatch.setattr(B, "LAND_EVERY", 100)
    other = B.grow(df, ["a", "b", "c"], "y", settings, "k", "fold", 3)
    assert growth.held_out().exceptAll(other.held_out()).count() == 0


def test_saved_model_scores_the_same(table, spark, tmp_root):
    df, _, _ = table
    model = B.fit(df, ["a", "b", "c"], "y", SETTINGS[0], "k")
    pipe = PipelineModel(stages=[VectorAssembler(inputCols=["a", "b", "c"], outputCol="features"), model])
    pipe.write().overwrite().save(f"{tmp_root}/boosted")
    again = PipelineModel.load(f"{tmp_root}/boosted")
    assert pipe.transform(df).select("k", "probability").exceptAll(again.transform(df).select("k", "probability")).count() == 0


def test_null_features_are_refused(spark):
    df = spark.createDataFrame([(1, None, 1.0), (2, 1.0, 0.0)], "k long, a double, y double")
    with pytest.raises(Exception, match="features must not be null"):
        B.grow(df, ["a"], "y", [{"n_estimators": 1}], "k")


def test_search_over_the_whole_space(table):
    df, _, _ = table
    space = {**SEARCH_SPACE, "n_estimators": [2, 3]}
    model, results = random_search(df, ["a", "b", "c"], "y", space=space, n_iter=12, key_col="k")
    rows = results.collect()
    assert len({tuple(r)[1:-1] for r in rows}) == 12 and {"reg_alpha", "reg_lambda", "colsample_bytree"} <= set(results.columns)
    assert max(r["mean_cv_auc"] for r in rows) > 0.8
    won = max(rows, key=lambda r: (r["mean_cv_auc"], -r["draw"]))
    assert len(model.stages[1].trees) == won["n_estimators"] + 1  # the base margin is a tree of its own
    assert len(sample_space(SEARCH_SPACE, 100)) == 100
