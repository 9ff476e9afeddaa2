"""Study-shaped views of the given tables, in Spark and in SQL.

The tables hold no nulls, so sparse columns are made from conditions on the
rows.  Each Spark view has a SQL twin that is put in front of oracle queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TYPES = ["signup", "view", "click", "purchase", "error"]
EVENTS = {"mpre": ["signup"], "m0": ["view"], "m2": ["click"], "m4": ["purchase"]}
SUPPLEMENTS = {"m4": ["error"]}


def sparse_events(load) -> DataFrame:
    """Events as an export: one row per event, a column per event type."""
    is_type = {t: F.col("event_type") == t for t in TYPES}
    return load("events").select(
        F.col("user_id").alias("id"), F.col("event_id").alias("seq"), F.col("event_type").alias("event"),
        "ts", "value", F.regexp_extract("props", r"(\d+)", 1).cast("int").alias("k"),
        *[F.when(is_type[t], F.col("value")).alias(f"{t}_v") for t in TYPES],
        F.when(~is_type["error"], F.col("props")).alias("note"),
        F.when(F.col("value") > 20, F.col("ts")).alias("done"),
        F.when(F.col("value") > 20, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("done_text"),
    )


SPARSE = """sparse AS (
  SELECT user_id AS id, event_id AS seq, event_type AS event, ts, value,
    CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k,
    CASE WHEN event_type = 'signup' THEN value END AS signup_v,
    CASE WHEN event_type = 'view' THEN value END AS view_v,
    CASE WHEN event_type = 'click' THEN value END AS click_v,
    CASE WHEN event_type = 'purchase' THEN value END AS purchase_v,
    CASE WHEN event_type = 'error' THEN value END AS error_v,
    CASE WHEN event_type <> 'error' THEN props END AS note,
    CASE WHEN value > 20 THEN ts END AS done,
    CASE WHEN value > 20 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS done_text
  FROM events)"""


def first(col: str, cond: str | None = None) -> str:
    """SQL: the first non-null value by seq."""
    test = f"{col} IS NOT NULL" + (f" AND {cond}" if cond else "")
    return f"arg_min({col}, seq) FILTER (WHERE {test})"


def arms(load) -> DataFrame:
    """Orders as visits: customer = id, status = arm, priority = level."""
    return load("orders").select(
        F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("seq"),
        F.col("o_orderstatus").alias("arm"), F.col("o_orderpriority").alias("level"),
        F.col("o_totalprice").alias("price"), F.col("o_orderdate").cast("date").alias("day"),
        F.when(F.col("o_totalprice") < 400000, F.col("o_orderdate").cast("date")).alias("done"),
    )


ARMS = """arms AS (
  SELECT o_custkey AS id, o_orderkey AS seq, o_orderstatus AS arm, o_orderpriority AS level,
    o_totalprice AS price, CAST(o_orderdate AS DATE) AS day,
    CASE WHEN o_totalprice < 400000 THEN CAST(o_orderdate AS DATE) END AS done
  FROM orders)"""

LEVELS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def sided(load) -> DataFrame:
    """Line items with left and right measures and an affected side."""
    lines = load("lineitem")
    odd = F.col("l_linenumber").isin(1, 3, 5, 7)
    return lines.select(
        F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("part"),
        F.when(F.col("l_returnflag") == "A", "Left").when(F.col("l_returnflag") == "R", "Right").alias("side"),
        F.when(odd, F.col("l_quantity")).alias("l_qty"),
        F.when(~odd, F.col("l_quantity")).alias("r_qty"),
        F.when(odd, F.col("l_linestatus")).alias("l_state"),
        F.when(F.col("l_quantity") > 10, F.col("l_linestatus")).alias("r_state"),
    )


SIDED = """sided AS (
  SELECT l_orderkey AS id, l_linenumber AS line, l_partkey AS part,
    CASE l_returnflag WHEN 'A' THEN 'Left' WHEN 'R' THEN 'Right' END AS side,
    CASE WHEN l_linenumber IN (1,3,5,7) THEN l_quantity END AS l_qty,
    CASE WHEN l_linenumber NOT IN (1,3,5,7) THEN l_quantity END AS r_qty,
    CASE WHEN l_linenumber IN (1,3,5,7) THEN l_linestatus END AS l_state,
    CASE WHEN l_quantity > 10 THEN l_linestatus END AS r_state
  FROM lineitem)"""


def lists(load) -> DataFrame:
    """Documents as free-text lists: sentences and lines become entries."""
    return load("documents").select(
        F.col("doc_id").alias("id"), "lang", "source",
        F.replace(F.replace("text", F.lit("."), F.lit(";")), F.lit("\n"), F.lit(";")).alias("list"),
    )


LISTS = r"""lists AS (
  SELECT doc_id AS id, lang, source, translate(text, '.' || chr(10), ';;') AS list
  FROM documents)"""

# White space as the trimming functions see it.
WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(133) || chr(160) || chr(5760) || " + " || ".join(
    f"chr({c})" for c in [*range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])


def sql_text(col: str) -> str:
    """SQL: a double as text, whole numbers without a fraction."""
    return (f"CASE WHEN {col} = floor({col}) THEN CAST(CAST({col} AS BIGINT) AS VARCHAR) "
            f"ELSE CAST({col} AS VARCHAR) END")
