"""Days past due, labels and the label-mart plan on the FIXTURES.md edge rows."""

import datetime as dt

from pyspark.sql import functions as F

from sparkmart.operators.clean import fill_all_numeric
from sparkmart.operators.features import days_past_due
from sparkmart.operators.labels import bad_rate_curve, default_label

D = dt.date

# (case, snapshot, due, overdue, missed, first_missed, dpd, label)
EDGES = [
    ("current", D(2023, 7, 1), 100.0, 0.0, 0, None, 0, 0),
    ("one missed", D(2023, 7, 1), 100.0, 100.0, 1, D(2023, 6, 1), 30, 1),
    ("short month", D(2023, 3, 1), 100.0, 100.0, 1, D(2023, 2, 1), 28, 0),
    ("part rounds up", D(2023, 7, 1), 100.0, 1.0, 1, D(2023, 6, 1), 30, 1),
    ("two missed", D(2023, 3, 1), 100.0, 150.0, 2, D(2023, 1, 1), 59, 1),
    ("month-end clamp", D(2023, 3, 31), 100.0, 100.0, 1, D(2023, 2, 28), 31, 1),
    ("due zero", D(2023, 7, 1), 0.0, 50.0, 0, None, None, 0),
    ("due null", D(2023, 7, 1), None, 50.0, 0, None, None, 0),
    ("overdue null", D(2023, 7, 1), 100.0, None, 0, None, 0, 0),
]


def _book(spark):
    rows = [(c, f"C{i}", 6, s, due, od) for i, (c, s, due, od, *_rest) in enumerate(EDGES)]
    return spark.createDataFrame(
        rows, "loan_id string, Customer_ID string, installment_num int, snapshot_date date, due_amt double, "
              "overdue_amt double")


def test_dpd_edges(spark):
    df = days_past_due(fill_all_numeric(_book(spark), 0, exclude=["due_amt"]))
    got = {r["loan_id"]: r for r in df.collect()}
    for case, _s, _d, _o, missed, first, dpd, _l in EDGES:
        r = got[case]
        assert r["installments_missed"] == missed, case
        assert r["first_missed_date"] == first, case
        assert r["dpd"] == dpd, case
        assert r["mob"] == 6


def test_labels_from_edges(spark):
    df = days_past_due(fill_all_numeric(_book(spark), 0, exclude=["due_amt"]))
    lab = {r["loan_id"]: r for r in default_label(df, 30, 6).collect()}
    for case, *_x, label in EDGES:
        assert lab[case]["label"] == label, case
        assert lab[case]["label_def"] == "30dpd_6mob"


def test_label_only_at_mob(spark):
    df = days_past_due(_book(spark).withColumn("installment_num", F.lit(5)))
    assert default_label(df, 30, 6).count() == 0


def test_bad_rate_curve(spark):
    df = days_past_due(fill_all_numeric(_book(spark), 0, exclude=["due_amt"]))
    df = df.withColumn("loan_start_date", F.lit("2023-01-01").cast("date"))
    rows = bad_rate_curve(df, 30).collect()
    assert len(rows) == 1 and rows[0]["mob"] == 6
    assert abs(rows[0]["bad_rate"] - 4 / 9) < 1e-12
    assert bad_rate_curve(df, 30, cohort_before="2022-01-01").count() == 0


def test_label_mart_backfill(spark, tmp_root, local_tmp):
    """PIP-1/2/7/13 from a raw CSV: one partition per month, labels as the edge table."""
    import os

    from sparkmart.plans import label_mart

    csv = os.path.join(local_tmp, "lms.csv")
    with open(csv, "w") as f:
        f.write("loan_id,Customer_ID,loan_start_date,tenure,installment_num,loan_amt,due_amt,paid_amt,"
                "overdue_amt,balance,snapshot_date\n")
        for i, (case, s, due, od, *_r) in enumerate(EDGES):
            f.write(f"{case},C{i},2023-01-01,10,6,1000,{'' if due is None else due},0,"
                    f"{'' if od is None else od},500,{s.isoformat()}\n")
        f.write("outside,C99,2020-01-01,10,6,1000,100,0,100,500,2020-05-01\n")
    paths = label_mart.backfill(spark, csv, tmp_root, "2023-01-15", "2023-12-01")
    assert paths["rows"] == {"bronze_loan_daily": len(EDGES), "silver_loan_daily": len(EDGES),
                             "gold_label_store": len(EDGES)}
    silver = spark.read.parquet(paths["silver_loan_daily"])
    assert {r[0] for r in silver.select("snapshot_date").distinct().collect()} == {
        D(2023, 7, 1), D(2023, 3, 1), D(2023, 3, 31)}
    gold = {r["loan_id"]: r["label"] for r in spark.read.parquet(paths["gold_label_store"]).collect()}
    assert gold == {case: label for case, *_x, label in EDGES}
    # rerun of one month leaves the others (dynamic overwrite, D1)
    label_mart.silver(spark, paths["bronze_loan_daily"], paths["silver_loan_daily"], "2023-07-01", "2023-07-01")
    assert spark.read.parquet(paths["silver_loan_daily"]).count() == len(EDGES)
