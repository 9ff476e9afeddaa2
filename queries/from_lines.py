"""Queries on line items: item columns, sides, column sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from longitab.functions.score import any_true, reverse, row_mean, row_sum, subscale
from longitab.operators import reshape as R
from longitab.operators import rows as RW
from longitab.operators import schema as S
from longitab.plans.sides import side_relative as relative

from .derive import SIDED, sided, sql_text
from .registry import query

KEYS = ["l_orderkey", "l_linenumber", "l_partkey"]
# Four answers 0..4 per line item; the last is blank on cheap lines.
ITEMS = """t AS (SELECT l_orderkey, l_linenumber, l_partkey, CAST(floor((l_quantity - 1) / 10) AS INTEGER) AS item_1,
    l_linenumber - 3 AS item_2, CAST(floor(l_extendedprice / 25000) AS INTEGER) AS item_3,
    CASE WHEN l_extendedprice > 20000 THEN CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 2 ELSE 4 END END AS item_4
  FROM lineitem)"""


def _items(load):
    return load("lineitem").select(
        *KEYS, F.floor((F.col("l_quantity") - 1) / 10).cast("int").alias("item_1"),
        (F.col("l_linenumber") - 3).alias("item_2"), F.floor(F.col("l_extendedprice") / 25000).cast("int").alias("item_3"),
        F.when(F.col("l_extendedprice") > 20000, F.when(F.col("l_returnflag") == "A", 0).when(
            F.col("l_returnflag") == "N", 2).otherwise(4)).alias("item_4"))


@query(f"""WITH {ITEMS} SELECT l_orderkey, l_linenumber, l_partkey,
  100.0::DOUBLE - ((item_1 + item_2 + item_3 + item_4) / 4.0::DOUBLE) * 100.0::DOUBLE / 4.0::DOUBLE AS total FROM t""")
def subscale_score(load):
    df = _items(load)
    return df.select(*KEYS, subscale(S.matching(df, r"item_\d+")).alias("total"))


@query(f"""WITH {ITEMS} SELECT l_orderkey, l_linenumber, l_partkey, (item_1 + item_2 + item_3 + item_4) / 4.0::DOUBLE AS strict,
  (item_1 + item_2 + item_3 + coalesce(item_4, 0)) / (CASE WHEN item_4 IS NULL THEN 3.0 ELSE 4.0 END)::DOUBLE AS skipping FROM t""", name="row_mean")
def _row_mean(load):
    df = _items(load)
    cols = S.matching(df, r"item_\d+")
    return df.select(*KEYS, row_mean(cols).alias("strict"), row_mean(cols, skip_null=True).alias("skipping"))


@query(f"WITH {ITEMS} SELECT l_orderkey, l_linenumber, l_partkey, item_3 + item_4 AS total FROM t", name="row_sum")
def _row_sum(load):
    return _items(load).select(*KEYS, row_sum(["item_3", "item_4"]).alias("total"))


@query(f"""WITH {ITEMS} SELECT l_orderkey, l_linenumber, l_partkey, abs(item_1 - 4) AS flipped, item_4 + 1 AS shifted FROM t""")
def scale_reverse(load):
    return _items(load).select(*KEYS, reverse("item_1").alias("flipped"), (F.col("item_4") + 1).alias("shifted"))


@query(f"""WITH {ITEMS} SELECT l_orderkey, l_linenumber, l_partkey,
  CASE WHEN item_1 > 3 OR item_4 > 2 OR item_2 <> 0 THEN 1 ELSE 0 END AS flag FROM t""")
def composite_flag(load):
    c = F.col
    return _items(load).select(*KEYS, any_true([c("item_1") > 3, c("item_4") > 2, c("item_2") != 0]).alias("flag"))


# -- column sets -----------------------------------------------------------

@query("""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag, l_linestatus, round_even(l_quantity * 2, 2) AS l_quantity,
  round_even(l_extendedprice * 2, 2) AS l_extendedprice, l_shipdate FROM lineitem""")
def across_apply(load):
    df = load("lineitem").drop("l_discount", "l_tax")
    return S.across(df, S.matching(df, "quant|extended"), lambda c: F.bround(c * 2, 2))


@query("SELECT l_quantity, l_partkey, l_orderkey, l_suppkey, l_linestatus FROM lineitem")
def select_by_pattern(load):
    df = load("lineitem")
    return S.pick(df, S.present(df, [*S.starting(df, "L_Q"), *S.matching(df, "KEY$"), *S.containing(df, "Status"), "absent"]))


@query("SELECT l_orderkey, l_quantity, l_extendedprice, l_linestatus FROM lineitem")
def select_by_catalogue(load):
    df = load("lineitem")
    catalogue = df.sparkSession.createDataFrame(
        [("l_quantity", "amount"), ("l_linestatus", "state"), ("l_extendedprice", "amount"), ("l_gone", "amount"),
         ("l_quantity", "state"), ("l_comment", "text"), ("l_tax", "tax")], "varname string, namegroup string")
    return S.select_catalogued(df, catalogue, ["amount", "state"], always=["l_orderkey"])


@query("SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_shipdate FROM lineitem")
def drop_by_pattern(load):
    return S.drop_matching(load("lineitem"), "PART|supp|status$|flag|discount|tax")


@query("SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag FROM lineitem")
def drop_from_dictionary(load):
    df = load("lineitem")
    dictionary = df.sparkSession.createDataFrame(
        [("l_discount", "remove"), ("l_tax", "remove"), ("l_shipdate", "remove"), ("l_linestatus", "remove"),
         ("l_absent", "remove"), ("l_quantity", None)], "newname string, remove string")
    return S.drop_from(df, dictionary)


@query("SELECT l_shipdate, l_linenumber, l_linestatus, l_returnflag, l_orderkey, l_partkey, l_suppkey, l_quantity FROM lineitem")
def reorder_columns(load):
    df = load("lineitem").drop("l_extendedprice", "l_discount", "l_tax")
    return S.reorder(df, ["l_shipdate", "absent"], ["l_line", "l_ret"])


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM (
  SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem) WHERE n = 1""")
def filter_group_size(load):
    df = load("lineitem").select(*KEYS, "l_quantity")
    return RW.groups_of_size(df, ["l_orderkey", "l_linenumber"], 1, "l_partkey")


@query("""SELECT l_orderkey, l_linenumber, l_partkey FROM (
  SELECT *, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem) WHERE n = 4""")
def filter_group_of_four(load):
    return RW.groups_of_size(load("lineitem").select(*KEYS), ["l_orderkey"], 4, "l_partkey")


# -- sides -----------------------------------------------------------------

def _side(a, b):
    return f"CASE side WHEN 'Left' THEN {a} WHEN 'Right' THEN {b} END"


@query(f"""WITH {SIDED}, t AS (SELECT id, line, part, side, {sql_text("l_qty")} AS l_qty, {sql_text("r_qty")} AS r_qty,
    l_state, r_state FROM sided)
SELECT id, line, part, side, {_side("l_qty", "r_qty")} AS a_qty, {_side("r_qty", "l_qty")} AS c_qty,
  {_side("l_state", "r_state")} AS a_state, {_side("r_state", "l_state")} AS c_state FROM t""")
def side_relative(load):
    return relative(sided(load), side="side")


SPLIT = " UNION ALL ".join(
    f"SELECT id, line, part, '{c[0]}' AS side, '{c[2:]}' AS var, {sql_text(c) if c.endswith('qty') else c} AS value FROM sided"
    for c in ("l_qty", "r_qty", "l_state", "r_state"))


@query(f"WITH {SIDED} {SPLIT}")
def unpivot_split_name(load):
    return R.longer_split(sided(load).drop("side"), ["id", "line", "part"], r"(\w)_(.+)", ["side", "var"])


@query(f"WITH {SIDED}, t AS ({SPLIT}) SELECT id, line, part, side || '_' || var AS var, value AS val FROM t WHERE value IS NOT NULL")
def unpivot_drop_null(load):
    return R.longer(sided(load).drop("side"), ["id", "line", "part"], drop_null=True)
