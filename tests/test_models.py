"""Model jobs on FIXTURES.md §3 rows."""

import datetime as dt

from pyspark.sql import functions as F

from sparkmart.models.metrics import f1_accuracy, log_loss, roc_auc
from sparkmart.models.scale import apply_scaler, fit_scaler
from sparkmart.models.split import assign_windows, stratified_split
from sparkmart.operators.calendar import window_sufficient


def test_auc_with_ties(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.4), (1, 0.4), (1, 0.8)], "label int, score double")
    r = roc_auc(df).first()
    assert r["auc"] == 0.875 and r["gini"] == 0.75


def test_auc_matches_evaluator(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    df = spark.range(400).select(
        (F.col("id") % 3 == 0).cast("int").alias("label"),
        (F.round((F.col("id") * 7919 % 101) / 101.0, 2) + (F.col("id") % 3 == 0).cast("double") * 0.1).alias("score"))
    mine = roc_auc(df, buckets=8).first()["auc"]
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", metricName="areaUnderROC")
    theirs = ev.evaluate(df.withColumn("label", F.col("label").cast("double")))
    assert abs(mine - theirs) < 1e-9


def test_auc_grouped(spark):
    df = spark.createDataFrame([("a", 0, 0.1), ("a", 1, 0.9), ("b", 1, 0.1), ("b", 0, 0.9), ("b", 1, 0.5)],
                               "g string, label int, score double")
    got = {r["g"]: r["auc"] for r in roc_auc(df, group_cols=["g"]).collect()}
    assert got == {"a": 1.0, "b": 0.0}


def test_log_loss(spark):
    df = spark.createDataFrame([(1, 0.8), (0, 0.2)], "label int, score double")
    assert abs(log_loss(df).first()["logloss"] - 0.223144) < 1e-6


def test_f1_accuracy(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.2), (0, 0.7), (0, 0.1)], "label int, score double")
    r = f1_accuracy(df).first()
    assert (r["tp"], r["fp"], r["fn"], r["tn"]) == (1, 1, 1, 1)
    assert r["f1_score"] == 0.5 and r["accuracy"] == 0.5


def test_scaler(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (None,)], "x double")
    stats = fit_scaler(df, ["x"])
    assert stats["x"] == (2.0, 1.0)
    assert [r["x"] for r in apply_scaler(df, stats).collect()] == [-1.0, 1.0, 0.0]


def test_windows(spark):
    dates = [dt.date(2024, 8, 31), dt.date(2024, 7, 1), dt.date(2024, 6, 30), dt.date(2023, 7, 1),
             dt.date(2023, 6, 30), dt.date(2024, 9, 1)]
    df = spark.createDataFrame([(d,) for d in dates], "snapshot_date date")
    got = [r["window_name"] for r in assign_windows(df, "2024-09-01").collect()]
    assert got == ["oot", "oot", "train_test", "train_test", "outside", "outside"]


def test_sufficiency_gate(spark):
    df = spark.createDataFrame([(dt.date(2023, 12, 1),), (dt.date(2024, 1, 1),)], "run_date date")
    got = [r[0] for r in df.select(window_sufficient(F.col("run_date"), F.lit("2023-01-01").cast("date"))).collect()]
    assert got == [False, True]


def test_stratified_split(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 10 == 0).cast("int").alias("label"))
    a = stratified_split(df, "k", "label", 0.8, seed=88)
    rates = {r["label"]: r["r"] for r in a.groupBy("label").agg(F.avg((F.col("split") == "train").cast("double")).alias("r")).collect()}
    assert abs(rates[0] - 0.8) < 0.01 and abs(rates[1] - 0.8) < 0.03
    b = stratified_split(df.repartition(7), "k", "label", 0.8, seed=88)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
