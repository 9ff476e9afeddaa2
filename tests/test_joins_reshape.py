import pytest
from pyspark.sql import functions as F

from plans import plan
from longitab.functions.text import trim_all
from longitab.operators import aggregate as A
from longitab.operators import joins as J
from longitab.operators import reshape as R


@pytest.fixture(scope="module")
def xy(spark):
    x = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "n")], "id int, x string")
    y = spark.createDataFrame([(1, 10), (3, 30), (None, 99)], "id int, y int")
    return x, y


def test_left_join_null_keys(xy, rows):
    x, y = xy
    assert rows(J.left_join(x, y, "id")) == [(1, "a", 10), (1, "b", 10), (2, "c", None), (None, "n", None)]
    assert rows(J.left_join(x, y, "id", null_safe=True)) == [(1, "a", 10), (1, "b", 10), (2, "c", None), (None, "n", 99)]


def test_left_join_fans_out_unless_unique(xy, rows):
    x, y = xy
    assert len(rows(J.left_join(y, x, "id"))) == 4
    with pytest.raises(Exception, match="duplicate key"):
        J.left_join(y, x, "id", unique=True).collect()
    assert rows(J.left_join(x, y, "id", unique=True)) == rows(J.left_join(x, y, "id"))


def test_full_joins(xy, rows):
    x, y = xy
    want = [(1, "a", 10), (1, "b", 10), (2, "c", None), (3, None, 30), (None, "n", None), (None, None, 99)]
    assert rows(J.full_join(x, y, "id")) == want
    assert rows(J.full_join_split(x, y, "id")) == want
    assert rows(J.full_join(x, y, "id", null_safe=True)) == want[:4] + [(None, "n", 99)]


def test_semi_and_anti(xy, rows):
    x, y = xy
    assert rows(J.semi_join(x, y, "id"), "x") == [("a",), ("b",)]
    assert rows(J.anti_join(x, y, "id", null_safe=True), "x") == [("c",)]
    assert rows(J.anti_join(x, y, "id"), "x") == [("c",), ("n",)]


def test_suffixes_and_attach(spark, xy, rows):
    x, _ = xy
    out = J.join_suffixed(x, x.filter("x = 'c'"), "id")
    assert out.columns == ["id", "x.x", "x.y"]
    df = spark.createDataFrame([(1, "m0", 2), (1, "m4", 5), (2, "m4", 7)], "id int, t string, v int")
    assert rows(J.attach_from(df, "id", F.col("t") == "m0", {"base": F.col("v") * 10})) == [
        (1, "m0", 2, 20), (1, "m4", 5, 20), (2, "m4", 7, None)]


def test_no_join_hints_a_broadcast(spark, xy):
    x, y = xy
    for df in (J.left_join(x, y, "id"), J.full_join(x, y, "id"), J.semi_join(x, y, "id"), J.enrich(x, y, "id")):
        assert "hint" not in df._jdf.queryExecution().analyzed().toString().lower()


def test_hot_key_is_split_by_aqe(spark):
    """A left join whose key holds most rows: the large partition is cut up."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        n = 60000
        big = spark.range(0, n, 1, 8).select(F.when(F.col("id") < n * 2 / 3, 1).otherwise(F.col("id")).alias("id"), F.rand(1).alias("v"))
        small = spark.range(0, n).select("id", F.lit("s").alias("w"))
        out = J.left_join(big, small, "id")
        rows = out.collect()
        assert len(rows) == n and all(r.w == "s" for r in rows)
        assert "skew=true" in plan(out)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_union_aligns_types(spark, rows):
    a = spark.createDataFrame([(1, 5, 1)], "id int, v int, n int")
    b = spark.createDataFrame([(2, "x", 2.5, True)], "id bigint, v string, n double, extra boolean")
    out = R.union_by_name(a, b, a)
    assert out.dtypes == [("id", "bigint"), ("v", "string"), ("n", "double"), ("extra", "boolean")]
    assert rows(out) == [(1, "5", 1.0, None), (1, "5", 1.0, None), (2, "x", 2.5, True)]


def test_longer_and_wider_are_inverse_on_text(spark, rows):
    df = spark.createDataFrame([(1, "a", None), (2, "b", "c")], "id int, x string, y string")
    back = R.wider(R.longer(df, ["id"]), ["id"], "var", "val", ["x", "y"])
    assert rows(back) == rows(df)
    assert rows(R.longer(df, ["id"], drop_null=True)) == [(1, "x", "a"), (2, "x", "b"), (2, "y", "c")]


def test_wider_takes_first_by_order_and_limits_columns(spark, rows):
    df = spark.createDataFrame([(1, "k", "late", 2), (1, "k", "early", 1)], "id int, key string, v string, seq int")
    assert rows(R.wider(df, ["id"], "key", "v", order="seq")) == [(1, "early")]
    wide = spark.range(R.MAX_PIVOT_COLUMNS + 1).select(F.lit(1).alias("id"), F.col("id").cast("string").alias("key"), F.lit(1).alias("v"))
    with pytest.raises(ValueError, match="columns"):
        R.wider(wide, ["id"], "key", "v")


def test_lists(spark, rows):
    df = spark.createDataFrame([(1, "a;b;"), (2, None), (3, " a ;a"), (4, "")], "id int, x string")
    assert rows(R.explode_list(df, "x")) == [(1, ""), (1, "a"), (1, "b"), (2, None), (3, " a "), (3, "a"), (4, "")]
    assert rows(R.explode_list(df, "x", trim=True, drop_empty=True)) == [(1, "a"), (1, "b"), (2, None), (3, "a"), (3, "a"), (4, None)]
    assert rows(R.split_columns(df, "x", ["p", "q"])) == [(1, "a", "b"), (2, None, None), (3, " a ", "a"), (4, "", None)]
    assert rows(R.explode_first(df, "x", 2)) == [(1, "a"), (1, "b"), (3, " a "), (3, "a"), (4, "")]
    assert rows(df.select(trim_all("x"))) == [("",), ("a ;a",), ("a;b;",), (None,)]


def test_aggregates(spark, rows):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (2, None), (3, None)], "id int, v int")
    got = rows(df.groupBy("id").agg(A.strict_sum("v"), A.strict_max("v"), A.strict_abs_min("v")))
    assert got == [(1, 3, 2, 1), (2, None, None, None), (3, None, None, None)]
    freq = [tuple(r) for r in A.frequency(df, "v", sort=True).collect()]
    assert freq == [(1, 2), (None, 2), (2, 1)]


def test_total_row_keeps_a_null_label(spark, rows):
    df = spark.createDataFrame([("a", 1), (None, 2)], "f string, n int")
    assert rows(A.with_total_row(df, "f", ["n"])) == [("Total", 3, 1), ("a", 1, 0), (None, 2, 0)]
