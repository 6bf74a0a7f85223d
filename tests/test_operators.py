import re

import pytest
from pyspark.sql import functions as F

from sparecost.operators import (
    Pool, Rule, Step, allocate_pool, latest_per_key, merge_update, rule_cascade, waterfall_lookup, with_rest_packed, with_spread,
)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def frame(spark, schema, *data):
    return spark.createDataFrame(list(data), schema)


@pytest.fixture(scope="module")
def lines(spark):
    return frame(spark, "unique_link_key string, tag string, v int", ("a", "T1", 1), ("b", "T2", 2), ("c", None, 3), ("d", "T9", 4))


def test_latest_per_key_drops_null_keys_and_breaks_ties(spark):
    df = frame(spark, "k string, t int, id int", ("x", 1, 1), ("x", 2, 2), ("x", 2, 3), (None, 9, 4), ("y", None, 5))
    assert rows(latest_per_key(df, ["k"], ["t"], ["id"]), "k", "id") == [("x", 3), ("y", 5)]


def test_merge_update_keeps_or_clears_unmatched(spark, lines):
    src = frame(spark, "tag string, n int", ("T1", 10), ("T2", None))
    kept = merge_update(lines, src, ["tag"], {"v": "n"})
    assert rows(kept, "unique_link_key", "v") == [("a", 10), ("b", None), ("c", 3), ("d", 4)]
    cleared = merge_update(lines, src, ["tag"], {"v": "n"}, unmatched="null", where=F.col("unique_link_key") != "d")
    assert rows(cleared, "unique_link_key", "v") == [("a", 10), ("b", None), ("c", None), ("d", 4)]


def test_merge_update_sees_old_values(spark, lines):
    src = frame(spark, "tag string, n int", ("T1", 10))
    out = merge_update(lines, src, ["tag"], {"v": "n", "w": F.col("v") + F.col("src_n")})
    assert rows(out.filter("tag = 'T1'"), "v", "w") == [(10, 11)]


def test_merge_update_refuses_two_source_rows(spark, lines):
    src = frame(spark, "tag string, n int", ("T1", 10), ("T1", 11))
    with pytest.raises(Exception, match="two source rows"):
        merge_update(lines, src, ["tag"], {"v": "n"}).collect()
    first = merge_update(lines, src, ["tag"], {"v": "n"}, on_duplicate="first", order=("n",))
    assert ("a", 11) in rows(first, "unique_link_key", "v")


def test_waterfall_first_hit_stays_and_zero_counts_as_missing(spark):
    df = frame(spark, "unique_link_key string, k string, part string, cost double", ("a", "1", "p", None), ("b", "2", "q", None),
               ("c", "3", "r", None), ("d", None, "p", None))
    one = frame(spark, "k string, c double", ("1", 5.0), ("2", 0.0))
    two = frame(spark, "k string, c double", ("1", 7.0), ("2", 8.0), ("3", 9.0))
    three = frame(spark, "part string, c double", ("p", 1.0), ("r", 2.0))
    missing = F.col("cost").isNull() | (F.col("cost") == 0)
    df = with_spread(df, "k", "kk")
    out = waterfall_lookup(df, [Step(one, {"k": "kk"}, {"cost": "c"}), Step(two, {"k": "kk"}, {"cost": "c"}),
                                Step(three, {"part": "part"}, {"cost": "c"})], missing)
    assert rows(out, "unique_link_key", "cost") == [("a", 5.0), ("b", 8.0), ("c", 9.0), ("d", 1.0)]


def test_cascade_last_match_wins_and_null_clears(spark):
    df = frame(spark, "x int, flag string", (1, "old"), (2, "old"), (3, "old"), (4, "old"))
    out = rule_cascade(df, [
        Rule(F.col("x") <= 3, {"flag": "A"}), Rule(F.col("x") == 2, {"flag": "B"}),
        Rule(F.col("x") == 3, {"flag": F.lit(None).cast("string")}), Rule(F.col("flag") == "B", {"flag": "C"}, True),
        Rule(F.col("flag") == "A", {"flag": "D"}),
    ])
    assert rows(out, "x", "flag") == [(1, "D"), (2, "C"), (3, None), (4, "old")]


def test_pool_is_spread_whole_and_skips_empty_bases(spark):
    df = frame(spark, "unique_link_key string, k string, w int, ok boolean", ("a", "x", 1, True), ("b", "x", 3, True), ("c", "x", 9, False),
               ("d", "y", 0, True), ("e", "z", 5, True), ("f", None, 5, True))
    pool = frame(spark, "k string, amount double", ("x", 100.0), ("y", 7.0), ("none", 9.0))
    df = df.withColumn("out", F.lit(None).cast("double"))
    out = allocate_pool(df, Pool(pool, {"k": "k"}, "amount"), "w", "out", base=F.col("ok"))
    assert rows(out, "unique_link_key", "out") == [("a", 25.0), ("b", 75.0), ("c", None), ("d", None), ("e", None), ("f", None)]
    zero = allocate_pool(df, Pool(pool, {"k": "k"}, "amount"), "w", "out", base=F.col("ok"), zero_base="zero")
    assert ("d", 0.0) in rows(zero, "unique_link_key", "out")


def test_merge_forces_no_broadcast(spark):
    df = merge_update(spark.range(50).withColumn("v", F.lit(0)), spark.range(5).withColumn("w", F.lit(1)), ["id"], {"v": "w"})
    assert "ResolvedHint" not in df._jdf.queryExecution().analyzed().toString()
    assert df.agg(F.sum("v")).first()[0] == 5


def test_null_keys_spread_over_partitions(spark):
    df = spark.range(4000).select(F.col("id").cast("string").alias("unique_link_key"), F.lit(None).cast("string").alias("tag"))
    sizes = with_spread(df, "tag", "k").repartition(8, "k").groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < 1500


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_hot_key_and_null_keys_keep_every_row(spark, threshold):
    """A third of the lines on one key, a third on none: shuffle join and broadcast join agree."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        n = 30000
        key = F.when(F.col("id") % 3 == 0, F.lit("HOT")).when(F.col("id") % 3 == 1, F.concat(F.lit("K"), (F.col("id") % 500).cast("string")))
        df = with_spread(spark.range(n).select(F.col("id").cast("string").alias("unique_link_key"), key.alias("tag")), "tag", "k")
        src = spark.range(500).select(F.concat(F.lit("K"), F.col("id").cast("string")).alias("tag"), F.lit(1).alias("n")).union(
            spark.sql("SELECT 'HOT', 2"))
        out = merge_update(df, src, {"tag": "k"}, {"v": "n"})
        assert {r["v"]: r["count"] for r in out.groupBy("v").count().collect()} == {1: n // 3, 2: n // 3, None: n // 3}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")


def test_columns_a_step_does_not_use_pass_its_joins_as_one(spark):
    rows = [("a", 1, None, 2.5, "x"), (None, 2, "t", None, "y"), ("a", 1, None, 2.5, "x"), ("b", None, "u", 1.0, None)]
    lines = spark.createDataFrame(rows, "k string, n int, t string, d double, z string")
    master = spark.createDataFrame([("a", 7)], "k string, v int")

    def step(df):
        return merge_update(df.filter("k IS NOT NULL OR n = 2"), master, ["k"], {"n": "v", "new": F.col("src_v") + 1})

    packed = with_rest_packed(lines, ["k", "n", "absent"], step)
    assert packed.columns == step(lines).columns and packed.dtypes == step(lines).dtypes
    assert sorted(map(str, packed.collect())) == sorted(map(str, step(lines).collect()))
    # one value beside the key and the column that is set
    joined = re.search(r"Join LeftOuter.*?\n(.*?\n){0,2}?.*?Project \[(.*)\]", packed._jdf.queryExecution().optimizedPlan().toString())
    assert "struct(t" in joined[2] and "d#" not in joined[2].split("struct(")[0]
    with pytest.raises(ValueError, match="n"):
        with_rest_packed(lines, ["k"], step)
