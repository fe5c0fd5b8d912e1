"""Train -> score -> monitor jobs end to end on a small synthetic loan book."""

import datetime as dt

from pyspark.sql import functions as F

from sparkmart.plans.model_jobs import monitor_job, score_job, train_job


def _data(spark):
    months = [dt.date(2023, m, 1) for m in range(6, 13)] + [dt.date(2024, m, 1) for m in range(1, 9)]
    rows = []
    for i in range(900):
        snap = months[i % len(months)]
        x = (i * 37 % 100) / 100.0
        label = 1 if (x + (i % 7) / 20.0) > 0.75 else 0
        rows.append((f"L{i}", f"C{i}", snap, label, x, float(i % 13), None if i % 11 == 0 else float(i % 5)))
    df = spark.createDataFrame(rows, "loan_id string, Customer_ID string, snapshot_date date, label int, "
                                     "fe_1 double, fe_2 double, fe_3 double")
    labels = df.select("loan_id", "Customer_ID", "snapshot_date", "label")
    feats = df.select("Customer_ID", "snapshot_date", "fe_1", "fe_2", "fe_3")
    return labels, feats


def test_train_score_monitor(spark, tmp_root):
    labels, feats = _data(spark)
    model_path, metrics, preds = f"{tmp_root}/model", f"{tmp_root}/metrics", f"{tmp_root}/predictions"
    model, record = train_job(spark, labels, feats, ["fe_1", "fe_2", "fe_3"], "2024-09-01", model_path, metrics,
                              search=False, params={"n_estimators": 10, "max_depth": 3})
    r = record.first()
    assert r["rows_oot"] == labels.where(F.col("snapshot_date") >= F.lit("2024-07-01").cast("date")).count()
    assert r["auc_train"] > 0.8 and 0 <= r["accuracy"] <= 1
    scored = score_job(spark, model_path, feats, ["Customer_ID", "snapshot_date"], "gbt_v1", preds)
    assert scored.count() == 900
    assert scored.where((F.col("score") < 0) | (F.col("score") > 1)).count() == 0
    mon = monitor_job(spark, preds, labels, ["Customer_ID", "snapshot_date"], metrics, model_name="gbt_v1")
    rows = mon.collect()
    assert len(rows) == 15 and all(x["inference_count"] == 60 for x in rows)
    log = spark.read.option("mergeSchema", True).parquet(metrics)
    assert log.count() == 16  # one training row + one row per monitored snapshot


def test_random_search(spark, tmp_root):
    labels, feats = _data(spark)
    _, record = train_job(spark, labels, feats, ["fe_1", "fe_2"], "2024-09-01", f"{tmp_root}/m2", None,
                          search=True, n_iter=2)
    r = record.first().asDict()
    assert "draw_0_cv_auc" in r["params"] and "draw_1_cv_auc" in r["params"]
