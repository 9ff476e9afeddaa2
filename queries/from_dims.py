"""Queries on customers, parts, suppliers, nations and regions."""

from __future__ import annotations

from pyspark.sql import functions as F

from longitab.functions.text import extract_first, paste
from longitab.operators import aggregate as A
from longitab.operators import joins as J
from longitab.operators import reshape as R
from longitab.operators import schema as S
from longitab.session import staging_dir
from longitab.sources import bundle, delimited

from .derive import sql_text
from .registry import query


def _fresh(spark) -> str:
    import uuid
    return f"{staging_dir(spark)}/query-{uuid.uuid4().hex}"


# -- CSV and bundles -------------------------------------------------------

SPARSE_CUSTOMER = """SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_name END AS c_name,
  CASE WHEN c_nationkey > 5 THEN c_nationkey END AS c_nationkey, CASE WHEN c_acctbal < 5000 THEN c_acctbal END AS c_acctbal,
  {segment} AS c_mktsegment FROM customer"""
TRICKY = "CASE c_mktsegment WHEN 'BUILDING' THEN 'a \"b\", c' WHEN 'MACHINERY' THEN 'NA' ELSE c_mktsegment END"
DDL = "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"


def _sparse_customer(load):
    df = load("customer")
    return df.withColumns({
        "c_name": F.when(F.col("c_acctbal") > 0, F.col("c_name")),
        "c_nationkey": F.when(F.col("c_nationkey") > 5, F.col("c_nationkey")),
        "c_acctbal": F.when(F.col("c_acctbal") < 5000, F.col("c_acctbal")),
        "c_mktsegment": F.expr(TRICKY),
    })


@query(SPARSE_CUSTOMER.format(segment=TRICKY))
def scan_csv_blank_null(load):
    """Blank is null, NA is a text."""
    df = _sparse_customer(load)
    path = _fresh(df.sparkSession)
    delimited.write_csv(df, path, null="")
    return delimited.read_csv(df.sparkSession, path, DDL)


@query(SPARSE_CUSTOMER.format(segment=f"nullif({TRICKY}, 'NA')"))
def scan_csv_na_tokens(load):
    """Blank and NA are null."""
    df = _sparse_customer(load)
    path = _fresh(df.sparkSession)
    delimited.write_csv(df, path, null="NA")
    return delimited.read_table(df.sparkSession, path, DDL)


@query(SPARSE_CUSTOMER.format(segment=f"nullif({TRICKY}, 'NA')").replace("SELECT c_custkey,", "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey,")
       .replace("THEN c_nationkey END", "THEN CAST(c_nationkey AS VARCHAR) ELSE '-' END").replace("THEN c_acctbal END", "THEN " + sql_text("c_acctbal") + " ELSE '-' END")
       .replace("THEN c_name END", "THEN c_name ELSE '-' END"))
def csv_null_token_roundtrip(load):
    """What a reader sees that does not know the null token."""
    df = _sparse_customer(load)
    path = _fresh(df.sparkSession)
    texts = df.withColumn("c_acctbal", F.regexp_replace(F.col("c_acctbal").cast("string"), r"\.0$", ""))
    delimited.write_csv(texts, path, null="-")
    return delimited.read_csv(df.sparkSession, path, nulls=("", "NA"))


@query("SELECT n_nationkey, n_name, n_regionkey, r_name, CASE WHEN n_regionkey > 1 THEN DATE '2024-02-29' END AS opened "
       "FROM nation JOIN region ON n_regionkey = r_regionkey")
def bundle_roundtrip(load):
    nation, region = load("nation"), load("region")
    spark = nation.sparkSession
    opened = F.when(F.col("n_regionkey") > 1, F.lit("2024-02-29").cast("date"))
    folder = _fresh(spark)
    bundle.write_bundle({"nation": nation.withColumn("opened", opened), "region": region, "spare": region}, folder,
                        only=["nation", "region"])
    back = bundle.read_bundle(spark, folder, "nation", schema="n_nationkey INT, n_name STRING, n_regionkey INT, opened DATE")
    names = bundle.read_bundle(spark, folder, "region", schema="r_regionkey INT, r_name STRING")
    return back.join(names, F.col("n_regionkey") == F.col("r_regionkey")).drop("r_regionkey")


# -- names -----------------------------------------------------------------

@query("SELECT c_custkey, c_mktsegment FROM customer")
def select_basic(load):
    return load("customer").select("c_custkey", "c_mktsegment")


@query("SELECT c_custkey AS id, c_name AS full_name, c_nationkey, c_acctbal AS balance, c_mktsegment FROM customer")
def rename_from_dictionary(load):
    df = load("customer")
    dictionary = df.sparkSession.createDataFrame(
        [("c_custkey", "id"), ("c_name", "full_name"), ("c_acctbal", "balance")], "varname string, newname string")
    return S.rename_from(df, dictionary)


@query("SELECT s_suppkey AS id, s_name, s_nationkey AS nation, s_acctbal FROM supplier")
def rename_explicit(load):
    return S.rename(load("supplier"), {"s_suppkey": "id", "s_nationkey": "nation"})


@query("SELECT p_partkey AS part_partkey, p_name AS part_name, p_brand AS part_brand, p_type AS part_type, p_size AS part_size, "
       "p_retailprice AS part_retailprice FROM part")
def rename_by_regex(load):
    return S.lower_names(S.rename_matching(load("part"), "^p", "Part"))


# -- shapes, joins, numbers ------------------------------------------------

@query(" UNION ALL ".join(
    f"SELECT c_custkey, '{c}' AS var, {e} AS val FROM customer" for c, e in {
        "c_name": "c_name", "c_nationkey": "CAST(c_nationkey AS VARCHAR)", "c_acctbal": sql_text("c_acctbal"),
        "c_mktsegment": "c_mktsegment"}.items()))
def unpivot_mixed(load):
    return R.longer(load("customer"), ["c_custkey"])


@query("SELECT c_nationkey, max(c_acctbal) AS top, abs(min(c_acctbal)) AS low, "
       "CASE WHEN count(b) = count(*) THEN max(b) END AS strict_top, CASE WHEN count(b) = count(*) THEN abs(min(b)) END AS strict_low "
       "FROM (SELECT *, CASE WHEN c_acctbal < 9900 THEN c_acctbal END AS b FROM customer) GROUP BY c_nationkey")
def max_absmin(load):
    df = load("customer").withColumn("b", F.when(F.col("c_acctbal") < 9900, F.col("c_acctbal")))
    return df.groupBy("c_nationkey").agg(
        F.max("c_acctbal").alias("top"), F.abs(F.min("c_acctbal")).alias("low"),
        A.strict_max("b").alias("strict_top"), A.strict_abs_min("b").alias("strict_low"))


@query("SELECT c_custkey, k, n_name, nullif(regexp_extract(n_name, '[0-9]+'), '') AS code, n_regionkey "
       "FROM (SELECT c_custkey, c_nationkey - 4 AS k FROM customer) LEFT JOIN nation ON k = n_nationkey")
def enrich_by_key(load):
    """Keys below 0 have no entry."""
    df = J.enrich(load("customer").select("c_custkey", (F.col("c_nationkey") - 4).alias("k")), load("nation"), "k", "n_nationkey")
    return df.withColumn("code", extract_first("n_name", r"(?<=_)\d+"))


@query('SELECT c_custkey, k, x.n_name AS "n_name.x", x.n_regionkey AS "n_regionkey.x", y.n_name AS "n_name.y", '
       'y.n_regionkey AS "n_regionkey.y" FROM (SELECT c_custkey, c_nationkey AS k FROM customer) '
       "LEFT JOIN nation x ON k = x.n_nationkey LEFT JOIN nation y ON k = y.n_nationkey + 4")
def join_suffix(load):
    """Keys below 4 have no match in the second table."""
    nation = load("nation").withColumnRenamed("n_nationkey", "k")
    people = load("customer").select("c_custkey", F.col("c_nationkey").alias("k"))
    return J.join_suffixed(J.left_join(people, nation, "k"), nation.withColumn("k", F.col("k") + 4), "k")


@query("SELECT p_partkey, coalesce(b, 'NA') || '_' || p_size AS as_text, b || '_' || p_size AS strict, 'P' || p_partkey AS tagged "
       "FROM (SELECT *, CASE WHEN p_size > 25 THEN p_brand END AS b FROM part)")
def concat_null_text(load):
    b = F.when(F.col("p_size") > 25, F.col("p_brand"))
    return load("part").select(
        "p_partkey", paste(b, "p_size", sep="_").alias("as_text"), paste(b, "p_size", sep="_", null_text=None).alias("strict"),
        paste(F.lit("P"), "p_partkey", sep="").alias("tagged"))
