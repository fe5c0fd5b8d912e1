"""Late labels, joins with heavy keys, counts from footers."""

import pytest
from pyspark.sql import functions as F

from sparkmart.models.late_labels import add_labels, known_counts, known_metrics, stored_drops
from sparkmart.models.monitor import monitor
from sparkmart.operators.calendar import footer_counts, store_counts, store_coverage
from sparkmart.operators.joins import heavy_keys, heavy_left_join
from sparkmart.sources.writers import write_snapshots


def _rounded(df):
    return sorted((r["model_name"], str(r["snapshot_date"]), r["inference_count"],
                   *[None if r[c] is None else round(r[c], 9) for c in ("positive_rate", "mean_score", "auc_score", "logloss")]) for r in df.collect())


@pytest.fixture()
def scored(spark):
    return spark.range(400).select("id", F.lit("m").alias("model_name"), F.lit("2024-01-01").cast("date").alias("snapshot_date"),
                                   F.when(F.col("id") % 50 != 7, (F.col("id") * 37 % 20) / 20.0).alias("score"))


def test_drops_with_corrections_equal_one_delivery(spark, scored, tmp_root):
    truth = spark.range(300).select("id", F.when(F.col("id") % 11 != 0, F.col("id") % 3 % 2).alias("label"))
    first = truth.where("id < 150").withColumn("label", F.when(F.col("id") % 4 == 0, 1 - F.col("label")).otherwise(F.col("label")))
    back = first.where("id % 11 = 0").withColumn("label", F.lit(1).cast("long"))  # labels that are taken back later
    add_labels(scored, first.where("id % 11 <> 0").unionByName(back), ["id"], tmp_root, 0)
    add_labels(scored, truth.where("id >= 150"), ["id"], tmp_root, 1)
    add_labels(scored, truth.where("id < 150 and (id % 4 = 0 or id % 11 = 0)"), ["id"], tmp_root, 2)
    want = _rounded(monitor(scored, truth, ["id"]))
    assert _rounded(known_metrics(spark, tmp_root)) == want and want[0][2] > 200
    add_labels(scored, truth.where("id < 150 and (id % 4 = 0 or id % 11 = 0)"), ["id"], tmp_root, 2)  # delivered again
    assert _rounded(known_metrics(spark, tmp_root)) == want
    assert stored_drops(spark, tmp_root) == [0, 1, 2]
    with pytest.raises(ValueError):
        add_labels(scored, truth, ["id"], tmp_root, 1)


def test_an_empty_drop_changes_nothing(spark, scored, tmp_root):
    labels = spark.range(9).select("id", F.lit(1).alias("label"))
    add_labels(scored, labels, ["id"], tmp_root, 0)
    before = sorted(map(tuple, known_counts(spark, tmp_root).collect()))
    add_labels(scored, labels.limit(0), ["id"], tmp_root, 1)
    assert sorted(map(tuple, known_counts(spark, tmp_root).collect())) == before


def test_heavy_join_equals_plain_join(spark):
    base = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 100 == 1, None).otherwise(F.col("id")).alias("k"), F.col("id").alias("n"))
    side = spark.createDataFrame([(7, "seven"), (7, "seven"), (10, "ten"), (None, "none")], "k long, name string")
    assert [r["k"] for r in heavy_keys(base, ["k"], 100).collect()] == [7]
    got = heavy_left_join(base, side, ["k"], limit=100)
    want = base.join(side.distinct(), ["k"], "left")
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert heavy_left_join(base.limit(0), side, ["k"]).count() == 0


def test_heavy_key_stays_out_of_the_shuffle(spark):
    """A third of the base on one key, without AQE: the largest task of the shuffle is under 5x the median."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        base = spark.range(0, 60000, 1, 4).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).alias("k"), "id")
        side = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
        out = heavy_left_join(base, side, ["k"], unique=True)
        sizes = sorted(r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect())
        assert sum(sizes) == 60000 and sizes[-1] < 5 * sizes[len(sizes) // 2]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_store_counts_read_footers_only(spark, tmp_root):
    df = spark.range(500).select("id", F.expr("add_months(date'2024-01-01', cast(id % 5 as int))").alias("snapshot_date"))
    write_snapshots(df, tmp_root)
    counts = store_counts(spark, tmp_root)
    assert sorted((str(r[0]), r[1]) for r in counts.collect()) == [(f"2024-0{m}-01", 100) for m in range(1, 6)]
    row = store_coverage(counts).first()
    assert (str(row[0]), str(row[1]), row[2], row[3]) == ("2024-01-01", "2024-05-01", 5, 500)
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
    conf = {"spark.sql.sources.useV1SourceList": "csv", "spark.sql.parquet.aggregatePushdown": "true"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        plan = footer_counts(spark, tmp_root, "snapshot_date")._jdf.queryExecution().executedPlan().toString()
        assert "PushedAggregation: [COUNT(*)]" in plan and "PushedGroupBy: [snapshot_date]" in plan
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
