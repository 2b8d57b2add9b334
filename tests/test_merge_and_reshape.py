import random
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from siltbed.operators.merge import compare_sources, first_per_key, join_on, merge_entities, union_labelled
from siltbed.operators.reshape import flatten, missing_weekdays, weights_to_100, wrap_records
from siltbed.operators.skew import attach_group_values, bounded_blocks, repeat_rows


def test_priority_beats_order_and_ties_are_stable(spark):
    a = spark.createDataFrame([("k", "z"), ("k", "y"), ("k", "y")], "key string, name string")
    b = spark.createDataFrame([("k", "a"), ("only_b", "b")], "key string, name string")
    rows = {tuple(r) for r in merge_entities({"a": a, "b": b}, "key").collect()}
    assert rows == {("k", "y", "a"), ("only_b", "b", "b")}


def test_hot_key_is_reduced_before_the_shuffle(spark, plan):
    df = spark.range(1000).withColumn("k", F.when(F.col("id") > 10, 1).otherwise(0))
    found = first_per_key(df, ["k"], [F.desc("id")])
    assert sorted(r["id"] for r in found.collect()) == [10, 999]
    text = plan(first_per_key(df, ["k"], [F.desc("id")]))
    assert text.count("WindowGroupLimit") == 2
    assert text.index("1, Final") < text.index("Exchange") < text.index("1, Partial")


def test_union_requires_equal_columns(spark):
    with pytest.raises(Exception, match="Cannot resolve column name"):
        union_labelled({"a": spark.range(1), "b": spark.range(1).withColumnRenamed("id", "x")})


def test_compare_sources_needs_both(spark):
    df = spark.createDataFrame(
        [("x", "cdp", 3253366.0), ("x", "nzdpu", 3794435.0), ("y", "cdp", 1.0), ("z", "cdp", 1.0), ("z", "nzdpu", 0.0)],
        "isin string, source_system string, v double",
    )
    rows = {r["isin"]: r for r in compare_sources(df, ["isin"], "source_system", "v", "cdp", "nzdpu").collect()}
    assert set(rows) == {"x", "z"}
    assert rows["x"]["abs_difference"] == 541069.0
    assert round(rows["x"]["pct_difference"], 2) == 14.26
    assert rows["z"]["pct_difference"] is None


def test_null_keys_join(spark):
    left = spark.createDataFrame([(None, 1), ("a", 2)], "k string, v int")
    right = spark.createDataFrame([(None, 10), ("a", 20)], "k string, w int")
    assert {tuple(r) for r in join_on(left, right, ["k"]).collect()} == {(None, 1, 10), ("a", 2, 20)}


def test_attach_group_values_salts_hot_groups_and_loses_nothing(spark, plan):
    rows = spark.range(3000).select(
        F.when(F.col("id") < 2000, "hot").when(F.col("id") < 2900, F.concat(F.lit("k"), (F.col("id") % 50))).alias("k"),
        F.lit(7).alias("same"),
    )
    groups = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    for hot_rows in (10**9, 500, 10):
        joined = attach_group_values(rows, groups, ["k"], "n", hot_rows)
        assert joined.count() == 3000
        wrong = joined.groupBy("k").agg(F.count(F.lit(1)).alias("found"), F.max("n").alias("n")).filter("found <> n")
        assert wrong.count() == 0


def test_repeat_rows(spark):
    df = spark.createDataFrame([("a", 0), ("b", 1), ("c", 25)], "k string, times bigint")
    repeated = sorted(tuple(r) for r in repeat_rows(df, "times", "n", block=10).collect())
    assert repeated == [("b", 1)] + [("c", n) for n in range(1, 26)]


@pytest.mark.parametrize("hot_rows", [10**9, 20])
def test_weights_add_up_to_100(spark, hot_rows):
    rng = random.Random(1)
    data = [("hot" if i % 2 else f"f{i % 10}", i, round(rng.uniform(1, 15), 3)) for i in range(400)]
    # Copies of one row, which are also the last of their group.
    data += [("copies", 9, 3.0)] * 7 + [("copies", 1, 1.0)] + [(None, 1, 2.0), (None, 2, 1.0)]
    df = spark.createDataFrame(data, "fund string, pos int, raw double")
    weights = weights_to_100(df, ["fund"], "raw", ["pos"], hot_rows=hot_rows)
    assert weights.count() == len(data)
    sums = {r["fund"]: r["s"] for r in weights.groupBy("fund").agg(F.sum("weight_pct").alias("s")).collect()}
    assert set(sums.values()) == {Decimal("100.0000")}
    copies = sorted(r["weight_pct"] for r in weights.filter("fund = 'copies' AND pos = 9").collect())
    assert copies[1:] == [Decimal("13.6364")] * 6 and copies[0] == Decimal("100") - Decimal("4.5455") - 6 * copies[1]


def test_missing_weekdays(spark):
    rows = [("a", date(2026, 1, 5)), ("a", date(2026, 1, 5)), ("a", date(2026, 1, 8)), ("b", date(2025, 1, 1))]
    df = spark.createDataFrame(rows, "k string, d date")
    start, end = F.lit(date(2026, 1, 2)), F.lit(date(2026, 1, 9))
    gaps = {}
    for r in missing_weekdays(df, ["k"], "d", start, end).collect():
        gaps.setdefault(r["k"], []).append(r["missing_day"].day)
    # 3 and 4 January 2026 are a weekend.
    assert {k: sorted(v) for k, v in gaps.items()} == {"a": [2, 6, 7, 9], "b": [2, 5, 6, 7, 8, 9]}


def test_calendar_without_gaps_or_weekdays(spark):
    df = spark.createDataFrame([("a", date(2026, 1, 5))], "k string, d date")
    day = F.lit(date(2026, 1, 5))
    assert missing_weekdays(df, ["k"], "d", day, day).count() == 0
    saturday = F.lit(date(2026, 1, 3))
    assert missing_weekdays(df, ["k"], "d", saturday, saturday).count() == 0


def test_flatten_any_depth(spark):
    df = spark.sql("SELECT named_struct('b.c', named_struct('d', 1), 'e', array(2)) AS a, 3 AS f")
    flat = flatten(df, "/")
    assert flat.columns == ["a/b.c/d", "a/e", "f"]
    assert tuple(flat.first()) == (1, [2], 3)


def test_envelopes_are_bounded_and_sorted(spark):
    df = spark.range(2500).select(F.lit("x").alias("source"), "id", (-F.col("id")).alias("rank"))
    block = F.floor(F.col("id") / 1000).cast("bigint")
    wrapped = wrap_records(df, ["source"], block, ["rank"], {"source_system": F.col("source")})
    rows = sorted(wrapped.collect(), key=lambda r: r["block_no"])
    assert [r["record_count"] for r in rows] == [1000, 1000, 500]
    assert rows[0]["raw_payload"].startswith('{"source_system":"x","record_count":1000,"records":[{"rank":-999,"id":999}')


def test_oversized_blocks_are_split_without_losing_copies(spark):
    rows = [("x", 1, "same")] * 700 + [("x", 1, f"v{i}") for i in range(700)] + [("y", 2, "one")]
    df = spark.createDataFrame(rows, "source string, id bigint, v string")
    block = F.floor(F.col("id") / 100).cast("bigint")
    wrapped = wrap_records(df, ["source"], block, ["id", "v"], {"s": F.col("source")}, max_records=100).cache()
    counts = [r["record_count"] for r in wrapped.collect()]
    assert sum(counts) == len(rows) and max(counts) <= 100
    schema = "records array<struct<id: bigint, v: string>>"
    back = wrapped.select("source", F.from_json("raw_payload", schema)["records"].alias("r")).select("source", F.inline("r"))
    assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0


def test_blocks_are_bounded_and_full(spark):
    """One block with distinct rows, one with a row repeated often, one with a NULL key."""
    df = (
        spark.range(95).selectExpr("'a' AS k", "id", "0 AS b")
        .unionAll(spark.range(1000).selectExpr("'a'", "7L", "1"))
        .unionAll(spark.range(7).selectExpr("CAST(NULL AS STRING)", "id", "0"))
    )
    parts = bounded_blocks(df, ["k"], F.col("b"), 10).groupBy("k", "block_no", "part_no").count().collect()
    sizes = {}
    for r in parts:
        sizes.setdefault((r["k"], r["block_no"]), []).append(r["count"])
    assert {k: sorted(v) for k, v in sizes.items()} == {
        ("a", 0): [5] + [10] * 9, ("a", 1): [10] * 100, (None, 0): [7]
    }
