
import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparkmart.models.metrics import roc_auc
from sparkmart.models.split import assign_windows, stratified_split
from sparkmart.operators.encode import fit_vocabulary, one_hot

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def _brute_auc(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    wins = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 20)), min_size=2, max_size=60),
       st.sampled_from([1, 2, 4, 256]))
def test_auc_equals_pairwise_count(spark, rows, buckets):
    rows = [(y, s / 20.0) for y, s in rows]
    if len({y for y, _ in rows}) < 2:
        return
    df = spark.createDataFrame(rows, "label int, score double")
    got = roc_auc(df, buckets=buckets).first()["auc"]
    assert abs(got - _brute_auc(rows)) < 1e-12


@SETTINGS
@given(st.lists(st.sampled_from(["a", "b", "c-d", "e f", None, ""]), min_size=1, max_size=30))
def test_one_hot_rows_sum_at_most_one(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "k int, v string")
    vocab = fit_vocabulary(df, "v")
    out = one_hot(df, "v", vocab)
    cols = [c for c in out.columns if c.startswith("v_")]
    if not cols:
        return
    sums = [r[0] for r in out.select(sum(F.col(c) for c in cols)).collect()]
    assert all(s in (0, 1) for s in sums)
    assert len(cols) == len({v for v in values if v})


def test_train_and_oot_disjoint(spark):
    days = [dt.date(2023, 1, 1) + dt.timedelta(days=7 * i) for i in range(100)]
    df = spark.createDataFrame([(f"k{i}", d, i % 2) for i, d in enumerate(days)], "k string, snapshot_date date, label int")
    w = assign_windows(df, "2024-09-01")
    tt = stratified_split(w.where("window_name = 'train_test'"), "k", "label", 0.8)
    oot = w.where("window_name = 'oot'")
    assert tt.select("k").intersect(oot.select("k")).count() == 0
    assert tt.count() + oot.count() + w.where("window_name = 'outside'").count() == 100


def test_encoded_width_equal_across_snapshots(spark):
    rows = [("2023-01-01", "a"), ("2023-01-01", "b"), ("2023-02-01", "a")]
    df = spark.createDataFrame(rows, "snapshot_date string, v string")
    out = one_hot(df, "v", fit_vocabulary(df, "v"))
    feb = out.where("snapshot_date = '2023-02-01'")
    assert set(feb.columns) == set(out.columns) and feb.first()["v_b"] == 0
