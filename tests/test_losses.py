"""Cases that used to lose data without a word."""

import datetime as dt

import duckdb
import oracle
from pyspark.sql import functions as F

from longitab.functions.recode import recode
from longitab.functions.text import plain_text
from longitab.operators.reshape import union_by_name, wider
from longitab.operators.spatial import assign_areas
from longitab.plans.events import incidence_report
from longitab.plans.history import history_tokens
from longitab.plans.monitoring import merge_checkbox_arms
from longitab.session import clear_staged, stage, unstage
from longitab.sources.delimited import read_csv, write_csv


def test_history_keeps_every_entry(spark):
    df = spark.createDataFrame([(1, ";".join(f"t{chr(97 + k)}" for k in range(12)))], "id int, text string")
    assert history_tokens(df, "text").count() == 12
    assert history_tokens(df, "text", n=8).count() == 8


def test_csv_keeps_outer_spaces(spark, tmp_path):
    df = spark.createDataFrame([(1, "  lead"), (2, "trail  "), (3, " ")], "id int, s string")
    write_csv(df, str(tmp_path / "t"))
    assert {r.id: r.s for r in read_csv(spark, str(tmp_path / "t"), "id INT, s STRING", ("NA",)).collect()} == {1: "  lead", 2: "trail  ", 3: " "}


def test_recode_takes_text_codes(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,), ("9",)], "c string")
    assert [r[0] for r in df.select(recode("c", {1: "one", 2: "two"})).collect()] == ["one", None, None, None]


def test_plain_text_has_no_exponent(spark):
    df = spark.createDataFrame([(0.0005,), (1e19,), (-2.5e-7,), (0.25,), (3.0,)], "d double")
    assert [r[0] for r in df.select(plain_text("d", "double")).collect()] == ["0.0005", "10000000000000000000", "-0.00000025", "0.25", "3"]


def test_union_keeps_digits_and_dates(spark):
    a = spark.sql("SELECT DATE '2020-01-02' AS d, CAST('12345678901234567890' AS DECIMAL(20,0)) AS n, 0.0001D AS t")
    b = spark.sql("SELECT TIMESTAMP '2020-01-03 04:05:06' AS d, 7L AS n, 'x' AS t")
    out = union_by_name(a, b)
    got = out.collect()
    assert [str(r.n) for r in got] == ["12345678901234567890", "7"] and [r.t for r in got] == ["0.0001", "x"]
    assert [r.d for r in got] == [dt.datetime(2020, 1, 2), dt.datetime(2020, 1, 3, 4, 5, 6)]


def test_doubled_cell_is_ordered(spark):
    df = spark.createDataFrame([(1, "k", 6), (1, "k", 5)], "id int, key string, value int")
    assert wider(df, ["id"], "key", "value", ["k"]).collect()[0].k == 5


def test_one_arm_alone_is_kept(spark):
    df = spark.createDataFrame([(1, 1)], "id int, fn_whichotherprof_super___1 int")
    merged = merge_checkbox_arms(df, "fn")
    assert [merged.collect()[0][c] for c in merged.columns if c.startswith("fn_otherprof_")] == [1]


def test_points_with_one_key_are_all_placed(spark):
    square = [(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0)]
    areas = spark.createDataFrame([("a", [{"x": x, "y": y} for x, y in square])], "code string, ring array<struct<x:double,y:double>>")
    points = spark.createDataFrame([(1, 0.5, 0.5), (1, 1.5, 1.5)], "id int, lon double, lat double")
    assert assign_areas(points, areas, key="id", x="lon", y="lat", code="code", ring="ring").count() == 2


def test_events_outside_the_grid_are_counted(spark):
    people = spark.createDataFrame([(1, 4), (2, None)], "id int, group int")
    events = spark.createDataFrame([(1, "m8", "pain", None), (1, None, "pain", None), (2, "m4", "pain", None), (1, "m4", "flu", None)],
                                   "id int, timepoint string, x string, y string")
    report = lambda **how: [tuple(r) for r in incidence_report(people, events, ["x", "y"], timepoints=["m4"], arms=[4], **how)
                            .orderBy("section", "row_order", "f").collect()]
    assert report() == [("x", "flu", 1, 0, 0), ("x", "pain", 0, 3, 0), ("x", "Total", 1, 3, 1), ("x", "Total n", 1, 2, 2),
                        ("y", "Total", 0, 0, 1), ("y", "Total n", 0, 0, 2)]
    assert report(rest=None)[:3] == [("x", "flu", 1, 0), ("x", "Total", 1, 1), ("x", "Total n", 1, 2)]


def test_oracle_sees_row_order(spark):
    con, sql = duckdb.connect(), "SELECT * FROM (VALUES (1), (2)) t(k) ORDER BY k"
    rows = lambda *ks: spark.createDataFrame([(k,) for k in ks], "k int").coalesce(1)
    assert oracle.compare(rows(1, 2), con, sql) is None and oracle.compare(rows(2, 1), con, sql)
    assert oracle.compare(rows(2, 1), con, sql.replace(" ORDER BY k", "")) is None


def test_staged_files_can_be_removed(spark):
    kept, gone = stage(spark.range(3)), stage(spark.range(4))
    unstage(gone)
    assert kept.agg(F.sum("id")).first()[0] == 3
    clear_staged(spark)
