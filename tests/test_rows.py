"""Collapse, top row, group size, sorting: order and skew."""

import random

from pyspark.sql import functions as F

from plans import plan
from longitab.operators.collapse import coalesce_by_column
from longitab.operators.rows import distinct_first, drop_all_missing, first_per_group, groups_of_size, sort_by_level


def test_collapse_takes_first_value_of_each_column(spark, rows):
    df = spark.createDataFrame(
        [(1, 3, "c", None), (1, 1, None, None), (1, 2, "b", 5), (2, 1, None, None), (None, 1, "n", 1)],
        "id int, seq bigint, a string, b int")
    want = [(1, "b", 5), (2, None, None), (None, "n", 1)]
    assert rows(coalesce_by_column(df, ["id"], "seq")) == want
    for parts in (1, 3, 8):
        assert rows(coalesce_by_column(df.repartition(parts), ["id"], "seq")) == want


def test_collapse_combines_before_the_shuffle(spark):
    df = spark.range(10).select((F.col("id") % 2).alias("k"), F.col("id").alias("seq"), F.lit("x").alias("v"))
    text = plan(coalesce_by_column(df, ["k"], "seq"))
    assert text.index("functions=[min_by") < text.index("Exchange") < text.index("partial_min_by")


def test_first_per_group_nulls_last_and_ties(spark, rows):
    df = spark.createDataFrame(
        [(1, None, 1, "main"), (1, "2020", 2, "late"), (1, "2019", 4, "tie"), (1, "2019", 3, "early"), (2, None, 9, "only")],
        "id int, t string, seq bigint, v string")
    assert rows(first_per_group(df, ["id"], ["t", "seq"]), "id", "v") == [(1, "early"), (2, "only")]
    assert "WindowGroupLimit" in plan(first_per_group(df, ["id"], ["t", "seq"]))


def test_distinct_first(spark, rows):
    df = spark.createDataFrame([(1, 1, "a", "x"), (1, 2, "a", "y"), (1, 3, "b", "z"), (2, 4, "a", "w"), (2, 5, None, "n")],
                               "id int, seq bigint, k string, v string")
    assert rows(distinct_first(df, ["id"], "k", ["seq"]), "id", "v") == [(1, "x"), (1, "z"), (2, "n"), (2, "w")]


def test_groups_of_size_with_hot_group(spark):
    rnd = random.Random(5)
    data = [(0, n) for n in range(500)] + [(rnd.randint(1, 300), 500 + n) for n in range(900)] + [(None, 5000)]
    df = spark.createDataFrame(data, "k int, seq bigint").repartition(6)
    sizes = {}
    for k, _ in data:
        sizes[k] = sizes.get(k, 0) + 1
    for size in (1, 2, 3, 500):
        got = sorted(r.seq for r in groups_of_size(df, ["k"], size, "seq").collect())
        assert got == sorted(s for k, s in data if sizes[k] == size)
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "3")
    try:
        for size in (3, 500):
            got = sorted(r.seq for r in groups_of_size(df, ["k"], size, "seq").collect())
            assert got == sorted(s for k, s in data if sizes[k] == size)
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
    text = plan(groups_of_size(df, ["k"], 1, "seq"))
    # Cut to size + 1 rows on both sides of the shuffle.
    assert text.count("WindowGroupLimit") == 2


def test_drop_all_missing(spark, rows):
    df = spark.createDataFrame([(1, None, None), (2, "a", None), (3, None, 4)], "id int, a string, b int")
    assert rows(drop_all_missing(df, ["a", "b"]), "id") == [(2,), (3,)]


def test_sort_by_level(spark):
    df = spark.createDataFrame([(2, "high", 1), (1, "low", 2), (1, "odd", 3), (1, "high", 5), (1, "high", 4), (None, "low", 6)],
                               "id int, level string, seq bigint").repartition(4)
    got = [r.seq for r in sort_by_level(df, ["id"], "level", ["low", "high"], "seq").collect()]
    assert got == [2, 4, 5, 3, 1, 6]
