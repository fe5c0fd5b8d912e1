"""Vocabularies of any size, kept with the store; joins that keep every base row and split hot keys."""

import duckdb
import pytest
from pyspark.sql import functions as F

from sparkmart.operators.encode import (
    VocabularyTooLarge, count_values, encode_slots, fit_indexed_one_hot, fit_list_vocabulary, fit_vocabulary,
    number_values, update_vocabularies,
)
from sparkmart.operators.joins import left_chain, outer_chain


def test_more_than_a_thousand_values(spark):
    df = spark.range(3000).select(F.format_string("v%05d", F.col("id") % 1500).alias("v"), "id")
    assert len(fit_vocabulary(df, "v")) == 1500
    assert len(fit_list_vocabulary(df, "v")) == 1500
    _, widths = fit_indexed_one_hot(df, ["v"])
    assert widths == {"v": 1500}
    for fit in (lambda: fit_vocabulary(df, "v", 1000), lambda: fit_indexed_one_hot(df, ["v"], max_values=1000)):
        with pytest.raises(VocabularyTooLarge):
            fit()
    slots = encode_slots(df, number_values(count_values(df, ["v"])), ["v"])
    assert slots.count() == 3000
    assert slots.agg(F.countDistinct("v_slot"), F.min("v_slot"), F.max("v_slot")).first() == (1500, 0, 1499)


def test_slots_by_frequency_then_value(spark):
    df = spark.createDataFrame([("b", "x"), ("a", "y"), ("b", None), (None, "y"), ("c", " ")], "p string, q string")
    got = {(r["column"], r["value"]): r["slot"] for r in number_values(count_values(df, ["p", "q"])).collect()}
    assert got == {("p", "b"): 0, ("p", "a"): 1, ("p", "c"): 2, ("q", "y"): 0, ("q", "x"): 1}
    assert number_values(count_values(df.limit(0), ["p"])).count() == 0
    lists = df.withColumn("q", F.split("q", "x"))
    got = count_values(lists, ["p"], {"q": F.col("q")}).collect()
    assert {(r["column"], r["value"], r["n"]) for r in got} == {("p", "a", 1), ("p", "b", 2), ("p", "c", 1), ("q", "y", 2)}


def test_stored_slots_never_move(spark, tmp_root):
    first = spark.createDataFrame([("b",), ("b",), ("a",)], "p string")
    second = spark.createDataFrame([("z",), ("z",), ("z",), ("a",), ("c",)], "p string")
    update_vocabularies(count_values(first, ["p"]), tmp_root)
    for _ in range(2):  # the second time adds nothing
        table = update_vocabularies(count_values(second, ["p"]), tmp_root)
        assert {r["value"]: r["slot"] for r in table.collect()} == {"b": 0, "a": 1, "z": 2, "c": 3}
    out = encode_slots(second.union(spark.createDataFrame([(None,), ("new",)], "p string")), table, ["p"])
    assert sorted((str(r["p"]), r["p_slot"]) for r in out.distinct().collect()) == [
        ("None", None), ("a", 1), ("c", 3), ("new", None), ("z", 2)]


def test_outer_chain_keeps_every_row_of_the_first_frame(spark):
    a = [(1, 1, 10), (1, 1, 11), (2, 1, 12), (None, 1, 13), (4, 1, 14)]
    b = [(1, 1, 20), (3, 1, 21), (None, 1, 22)]
    c = [(3, 1, 30), (5, 1, 31), (2, 1, 32)]
    frames = [spark.createDataFrame(rows, f"k int, d int, {n} int") for n, rows in zip("xyz", (a, b, c))]
    got = outer_chain(frames, ["k", "d"])
    con = duckdb.connect()
    for name, col, rows in (("a", "x", a), ("b", "y", b), ("c", "z", c)):
        con.execute(f"CREATE TABLE {name} (k INT, d INT, {col} INT)")
        con.executemany(f"INSERT INTO {name} VALUES (?, ?, ?)", rows)
    want = con.execute("""SELECT k, d, x, y, z FROM a FULL JOIN b USING (k, d) FULL JOIN c USING (k, d)""").fetchall()
    key = lambda r: tuple((v is None, v) for v in r)
    assert sorted(map(tuple, got.select(*"kdxyz").collect()), key=key) == sorted(want, key=key)


def test_hot_key_is_split_in_a_three_side_chain(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        base = spark.range(200000, numPartitions=8).select(F.when(F.col("id") % 3 < 2, -1).otherwise(F.col("id")).alias("k"), "id")
        sides = [(spark.range(-1, 200000).select(F.col("id").alias("k"), F.lit(i).alias(f"s{i}")), ["k"], True) for i in range(3)]
        out = left_chain(base, sides)
        out.write.format("noop").mode("overwrite").save()
        assert len(out.collect()) == 200000
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
