"""Queries on orders seen as visits of customers."""

from __future__ import annotations

from pyspark.sql import functions as F

from longitab.functions import dates as D
from longitab.functions import recode as RC
from longitab.functions.score import nan_to_null, truncate
from longitab.functions.text import plain_text
from longitab.operators import aggregate as A
from longitab.operators import reshape as R
from longitab.operators import rows as RW
from longitab.operators import schema as S
from longitab.operators.report import REST, participants_with
from longitab.plans import events as EV
from longitab.plans import extract as EX
from longitab.plans.timepoints import merge_supplements
from longitab.session import fresh_path
from longitab.sources.bundle import read_bundle

from .derive import ARMS, LEVELS, arms, sql_text
from .registry import SQL, query

RANK = "CASE level " + " ".join(f"WHEN '{v}' THEN {i}" for i, v in enumerate(LEVELS, start=1)) + " END"
STATUS = {"F": "Finished", "O": "Open"}


# -- recoding --------------------------------------------------------------

@query(f"""WITH {ARMS} SELECT seq, CASE arm WHEN 'F' THEN 'Finished' WHEN 'O' THEN 'Open' END AS strict,
  CASE arm WHEN 'F' THEN 'Finished' WHEN 'O' THEN 'Open' ELSE arm END AS kept FROM arms""")
def recode_map(load):
    return arms(load).select("seq", RC.recode("arm", STATUS).alias("strict"),
                             RC.recode("arm", STATUS, keep_unmatched=True).alias("kept"))


@query(f"""WITH {ARMS} SELECT seq, CASE level WHEN '1-URGENT' THEN 10 WHEN '2-HIGH' THEN 20 WHEN '5-LOW' THEN 50 END AS code
FROM arms""")
def case_match(load):
    return arms(load).select("seq", RC.recode("level", {"1-URGENT": 10, "2-HIGH": 20, "5-LOW": 50}).alias("code"))


@query(f"""WITH {ARMS} SELECT seq, CASE WHEN done IS NULL THEN 'dear' WHEN price > 200000 THEN 'middle'
  WHEN arm = 'F' THEN 'cheap done' ELSE level END AS band FROM arms""")
def case_when_chain(load):
    band = (
        F.when(F.col("done").isNull(), "dear").when(F.col("price") > 200000, "middle")
        .when(F.col("arm") == "F", "cheap done").otherwise(F.col("level"))
    )
    return arms(load).select("seq", band.alias("band"))


@query(f"""WITH {ARMS} SELECT seq, CASE WHEN l = 'Other' THEN CASE WHEN price > 100000 THEN arm END ELSE l END AS label
FROM (SELECT *, CASE level WHEN '1-URGENT' THEN 'Now' WHEN '5-LOW' THEN 'Other' END AS l FROM arms)""")
def other_text_merge(load):
    label = RC.recode("level", {"1-URGENT": "Now", "5-LOW": "Other"})
    text = F.when(F.col("price") > 100000, F.col("arm"))
    return arms(load).select("seq", RC.other_text(label, text).alias("label"))


@query(f"""WITH {ARMS} SELECT seq, {RANK.replace("WHEN '5-LOW' THEN 5", "")} AS rank,
  CASE WHEN level <> '5-LOW' THEN level END AS level FROM arms""")
def ordinal_rank(load):
    known = LEVELS[:-1]
    return arms(load).select("seq", RC.rank_of("level", known).alias("rank"), RC.only_levels("level", known).alias("level"))


@query(f"WITH {ARMS} SELECT seq, CASE WHEN id IN (3, 14, 159) THEN 1 ELSE CASE WHEN arm = 'F' THEN 1 ELSE 0 END END AS flag FROM arms")
def override_by_list(load):
    flag = F.when(F.col("arm") == "F", 1).otherwise(0)
    return arms(load).select("seq", RC.override(flag, "id", [3, 14, 159], 1).alias("flag"))


@query(f"WITH {ARMS} SELECT seq, nullif(level, '4-NOT SPECIFIED') AS level FROM arms")
def sentinel_to_null(load):
    return arms(load).select("seq", RC.null_if("level", "4-NOT SPECIFIED").alias("level"))


@query(f"WITH {ARMS} SELECT seq, level, arm FROM arms WHERE level <> '4-NOT SPECIFIED'")
def sentinel_drop(load):
    return arms(load).filter(F.col("level") != "4-NOT SPECIFIED").select("seq", "level", "arm")


# -- casts, dates, numbers -------------------------------------------------

@query("""SELECT o_orderkey AS seq, CAST(o_custkey AS VARCHAR) AS as_text, try_cast(substr(o_orderpriority, 1, 1) AS DOUBLE) AS rank,
  try_cast(o_orderpriority AS DOUBLE) AS bad FROM orders""")
def safe_cast(load):
    p = F.col("o_orderpriority")
    return load("orders").select(
        F.col("o_orderkey").alias("seq"), F.col("o_custkey").cast("string").alias("as_text"),
        p.substr(1, 1).try_cast("double").alias("rank"), p.try_cast("double").alias("bad"))


TEXTS = """CASE WHEN o_orderstatus = 'F' THEN {day} WHEN o_orderstatus = 'O' THEN {stamp} ELSE '[not completed]' END"""


@query(f"""WITH t AS (SELECT o_orderkey AS seq, {TEXTS.format(
    day="strftime(o_orderdate, '%Y-%m-%d')", stamp="strftime(o_orderdate, '%Y-%m-%d 10:11:12')")} AS x FROM orders)
SELECT seq, CAST(try_cast(x AS TIMESTAMP) AS DATE) AS day, CASE WHEN length(x) = 19 THEN try_cast(x AS TIMESTAMP) END AS at FROM t""")
def parse_dates(load):
    text = F.expr(TEXTS.format(day="date_format(o_orderdate, 'yyyy-MM-dd')",
                               stamp="concat(date_format(o_orderdate, 'yyyy-MM-dd'), ' 10:11:12')"))
    return load("orders").select(F.col("o_orderkey").alias("seq"), D.parse_date(text).alias("day"),
                                 D.parse_timestamp(text).cast("timestamp_ntz").alias("at"))


# The order's day against a fixed 29 February, both ways round.
YEARS = ("CASE WHEN {b} >= {a} THEN year({b}) - year({a}) - CASE WHEN month({b}) * 100 + day({b}) < month({a}) * 100 + day({a}) "
         "THEN 1 ELSE 0 END END")
LEAP = "DATE '1996-02-29'"


@query(f"""WITH {ARMS} SELECT seq, CAST(CASE WHEN day >= {LEAP} THEN {YEARS.format(a=LEAP, b="day")}
  ELSE -{YEARS.format(a="day", b=LEAP)} END AS INTEGER) AS years FROM arms""")
def age_years(load):
    return arms(load).select("seq", D.years_completed(F.lit("1996-02-29").cast("date"), "day").alias("years"))


def _anniversary(n):
    return f"CAST(a + to_months(CAST(12 * ({n}) AS INTEGER)) AS DATE)"


@query(f"""WITH {ARMS}, p AS (SELECT seq, CASE WHEN day >= {LEAP} THEN 1 ELSE -1 END AS sgn,
    least(day, {LEAP}) AS a, greatest(day, {LEAP}) AS b FROM arms),
q AS (SELECT *, {YEARS.format(a="a", b="b")} AS n FROM p)
SELECT seq, round_even(sgn * (n + date_diff('day', {_anniversary("n")}, b)
  / date_diff('day', {_anniversary("n")}, {_anniversary("n + 1")})::DOUBLE), 6) AS years FROM q""")
def years_fractional(load):
    return arms(load).select("seq", F.bround(D.years_fractional(F.lit("1996-02-29").cast("date"), "day"), 6).alias("years"))


@query(f"""WITH {ARMS} SELECT seq, CAST(date_diff('day', {LEAP}, day) AS INTEGER) AS days,
  round_even(date_diff('day', {LEAP}, day) / 7.0::DOUBLE, 2) AS weeks FROM arms""")
def elapsed_weeks(load):
    start = F.lit("1996-02-29").cast("date")
    return arms(load).select("seq", D.days_between(start, "day").alias("days"), D.weeks_between(start, "day").alias("weeks"))


@query("""SELECT o_orderkey AS seq, round_even(sqrt(o_totalprice), 2) AS r, CAST(trunc(x) AS BIGINT) AS t,
  CAST(ceil(x) AS BIGINT) AS c, abs(x) AS a FROM (SELECT *, o_totalprice - 250000 AS x FROM orders)""")
def rounding(load):
    x = F.col("o_totalprice") - 250000
    return load("orders").select(F.col("o_orderkey").alias("seq"), F.bround(F.sqrt("o_totalprice"), 2).alias("r"),
                                 truncate(x).alias("t"), F.ceil(x).alias("c"), F.abs(x).alias("a"))


# -- selection, order ------------------------------------------------------

@query("SELECT o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders")
def select_range(load):
    df = load("orders")
    return S.pick(df, S.between(df, "o_custkey", "o_orderdate"))


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey < 1000")
def filter_range(load):
    return load("orders").filter(F.col("o_custkey") < 1000).select("o_orderkey", "o_custkey", "o_totalprice")


@query(f"WITH {ARMS}, ranked AS (SELECT *, {RANK} AS rank FROM arms) SELECT id, level, seq, price FROM ranked ORDER BY id, rank, seq")
def sort_by_level(load):
    return RW.sort_by_level(arms(load).select("id", "level", "seq", "price"), ["id"], "level", LEVELS, "seq")


@query(f"""WITH {ARMS} SELECT id, arm, seq, done, price FROM (SELECT *, row_number() OVER (
  PARTITION BY id, arm ORDER BY done NULLS LAST, seq) AS rn FROM arms) WHERE rn = 1""")
def earliest_per_group(load):
    return RW.first_per_group(arms(load).select("id", "arm", "seq", "done", "price"), ["id", "arm"], ["done", "seq"])


@query(f"""WITH {ARMS}, main AS (SELECT id, min(done) AS done, max(price) AS price, min(level) AS level
    FROM arms WHERE arm <> 'P' GROUP BY id),
extra AS (SELECT id, min(done) AS done, max(price) AS price FROM arms WHERE arm = 'P' GROUP BY id)
SELECT coalesce(main.id, extra.id) AS id, 'visit' AS timepoint, level,
  CASE WHEN main.id IS NULL OR extra.done IS NOT NULL AND (main.done IS NULL OR extra.done < main.done)
    THEN extra.done ELSE main.done END AS done,
  CASE WHEN main.id IS NULL OR extra.done IS NOT NULL AND (main.done IS NULL OR extra.done < main.done)
    THEN extra.price ELSE main.price END AS price
FROM main FULL JOIN extra ON main.id = extra.id""")
def supplement_merge(load):
    """Supplement against main visit, earliest wins, supplement-only ids kept."""
    slot = RC.recode("arm", {"F": "visit", "O": "visit", "P": "visit_extra"})
    rows = arms(load).withColumn("slot", slot).groupBy("id", "slot").agg(
        F.min("done").alias("done"), F.max("price").alias("price"),
        F.min(F.when(F.col("arm") != "P", F.col("level"))).alias("level"))
    return merge_supplements(rows, "id", {"visit": ["done", "price"]}, "done", keep_unmatched=True)


# -- reports ---------------------------------------------------------------

GRID = R.cells(["F", "O", "P", "X"], [0, 1])
DEAR = "CASE WHEN price > 250000 THEN 1 ELSE 0 END"


@query(f"""WITH {ARMS} SELECT level, {", ".join(
    f"count(*) FILTER (WHERE arm = '{g[0]}' AND {DEAR} = {g[2]}) AS {g}" for g in GRID)} FROM arms GROUP BY level""")
def pivot_multi_key(load):
    """Counts per (arm, price band) over the full grid: a cell without rows is 0."""
    df = arms(load).withColumn("cell", R.cell([F.col("arm"), F.expr(DEAR).cast("string")]))
    n = df.groupBy("level", "cell").agg(F.count("*").alias("n"))
    return R.wider(n, ["level"], "cell", "n", values=GRID, fill=0)


@query(f"""WITH {ARMS}, t AS (SELECT CASE WHEN level <> '5-LOW' THEN level END AS f, count(*) AS n,
    count(done) AS n_done FROM arms GROUP BY 1)
SELECT f, n, n_done, 0 AS row_order FROM t UNION ALL
SELECT 'Total', CAST(sum(n) AS BIGINT), CAST(sum(n_done) AS BIGINT), 1 FROM t""")
def append_total_row(load):
    """A null label keeps its own row beside the total."""
    label = RC.only_levels("level", LEVELS[:-1])
    t = arms(load).groupBy(label.alias("f")).agg(F.count("*").alias("n"), F.count("done").alias("n_done"))
    return A.with_total_row(t, "f", ["n", "n_done"])


@query(f"WITH {ARMS} SELECT arm, level, count(DISTINCT id) AS n FROM arms WHERE done IS NOT NULL GROUP BY arm, level")
def total_participants_row(load):
    return participants_with(arms(load), ["arm", "level"], "id", "done")


# Adverse events: an order's customer is the participant, its status the
# timepoint, and a list is put together from its other columns.
LIST_SPARK = "CASE WHEN price > 100000 THEN concat(' ', level, ';', {b}, '; ;') END"
BAND = "CASE WHEN price > 300000 THEN 'high' WHEN price > 200000 THEN 'middle' ELSE level END"
CELLS = [*R.cells(["F", "P"], [4, 7]), REST]


def _cell_sums(counter):
    return ", ".join(f"CAST(coalesce(sum({counter}) FILTER (WHERE cell = '{g}'), 0) AS BIGINT) AS {g}" for g in CELLS)


@query(f"""WITH {ARMS}, people AS (SELECT c_custkey AS id, CASE WHEN c_acctbal > 4500 THEN 7 ELSE 4 END AS grp FROM customer),
x AS (SELECT id, CASE WHEN arm IN ('F', 'P') THEN arm || '_' || grp ELSE '{REST}' END AS cell, level, {BAND} AS band, price
  FROM arms JOIN people USING (id)),
tok AS (SELECT 'listed' AS section, id, cell, level AS f FROM x WHERE price > 100000
  UNION ALL SELECT 'listed', id, cell, band FROM x WHERE price > 100000
  UNION ALL SELECT 'single', id, cell, band FROM x WHERE price < 300000),
n AS (SELECT section, f, cell, count(*) AS n FROM tok GROUP BY ALL)
SELECT section, f, {_cell_sums("n")}, 0 AS row_order FROM n GROUP BY section, f
UNION ALL SELECT section, 'Total', {_cell_sums("n")}, 1 FROM n GROUP BY section
UNION ALL SELECT section, 'Total n', {_cell_sums("n")}, 2 FROM (
  SELECT section, cell, count(DISTINCT id) AS n FROM tok GROUP BY ALL) GROUP BY section""")
def incidence_table(load):
    """Stacked incidence tables with totals and participant counts; open orders are outside the grid."""
    people = load("customer").select(
        F.col("c_custkey").alias("id"), F.when(F.col("c_acctbal") > 4500, 7).otherwise(4).alias("group"))
    events = arms(load).select(
        "id", F.col("arm").alias("timepoint"), F.expr(LIST_SPARK.format(b=BAND)).alias("listed"),
        F.expr(f"CASE WHEN price < 300000 THEN {BAND} END").alias("single"))
    return EV.incidence_report(people, events, ["listed", "single"], timepoints=["F", "P"], arms=[4, 7])


@query(SQL["incidence_table"].replace("WITH ", "SELECT * EXCLUDE (section, row_order) FROM (WITH ", 1)
       + ") WHERE section = 'listed' ORDER BY row_order, f")
def incidence_sorted(load):
    """One section in display order."""
    return EV.incidence_table(incidence_table(load), "listed")


@query(f"""WITH {ARMS}, x AS (SELECT id, CASE WHEN arm = 'F' THEN CAST(price AS DOUBLE) END AS price FROM arms)
SELECT id, avg(price) AS mean, count(price) > 0 AS known FROM x GROUP BY id""")
def nan_null(load):
    """A mean over nothing is not a number, and then missing."""
    price = F.when(F.col("arm") == "F", F.col("price"))
    n = F.count(price)
    ratio = F.when(n > 0, F.avg(price)).otherwise(F.lit(float("nan")))
    return arms(load).groupBy("id").agg(nan_to_null(ratio).alias("mean"), (n > 0).alias("known"))


@query(f"""WITH {ARMS} SELECT id, seq, CASE WHEN price < 200000 THEN level END AS level, 'data' AS part FROM arms
UNION ALL SELECT id, seq, arm, 'fortnightly' FROM arms WHERE arm <> 'O'""")
def extract_request(load):
    """A request for one variable group and the fortnightly table, written and read back; the surgical table isn't asked for."""
    df = arms(load)
    spark, folder = df.sparkSession, fresh_path(df.sparkSession)
    main = df.select("id", "seq", F.when(F.col("price") < 200000, F.col("level")).alias("level"))
    weekly = df.filter("arm <> 'O'").select("id", "seq", F.col("arm").alias("level"))
    written = EX.write_extract(main, weekly, df.select("id"), folder, groups=["visits"], extra=["fn"], missing="na")
    schema = "id BIGINT, seq BIGINT, level STRING"
    parts = [read_bundle(spark, folder, name, schema=schema).withColumn("part", F.lit(name)) for name in written]
    return parts[0].unionByName(parts[1])


# -- blinding, extract -----------------------------------------------------

@query("SELECT o_orderkey, o_orderstatus, o_orderdate, o_orderpriority FROM orders")
def blind_projection(load):
    return S.blind(load("orders"), ["o_custkey", "not_there"], ["TOTAL"])


@query("""SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Control' WHEN 'O' THEN 'Treated' END AS o_orderstatus,
  o_custkey, o_totalprice, o_orderdate, o_orderpriority FROM orders""")
def unblind_projection(load):
    return S.blind(load("orders"), ["o_custkey"], blinded=False, arm="o_orderstatus",
                   labels={"F": "Control", "O": "Treated"})


def _longitudinal(load):
    """One row per customer and status, under the names an extract looks for."""
    last = lambda c: F.max_by(c, "seq").alias(c)
    df = arms(load).groupBy("id", F.col("arm").alias("timepoint")).agg(
        last("price"), last("level"), last("day"), last("done"), F.count("*").alias("n"))
    return df.withColumns({"blgoals_n": F.col("n"), "group": F.lit(4)})


def _catalogue(df):
    rows = [("price", "money"), ("level", "other"), ("done", "money"), ("stale", "money"), ("n", "money"),
            ("n", "other"), ("blgoals_n", "money")]
    return df.sparkSession.createDataFrame(rows, "varname string, namegroup string")


LONGITUDINAL = f"""{ARMS}, visits AS (SELECT id, arm AS timepoint, arg_max(price, seq) AS price,
    arg_max(level, seq) AS level, arg_max(day, seq) AS day,
    arg_max(done, seq) FILTER (WHERE done IS NOT NULL) AS done_any, count(*) AS n, max(seq) AS top FROM arms GROUP BY 1, 2),
v AS (SELECT visits.*, arms.done FROM visits JOIN arms ON visits.top = arms.seq)"""


@query(f"""WITH {LONGITUDINAL} SELECT id, timepoint, 4 AS "group", price, done, n FROM v WHERE timepoint IN ('F', 'O')""")
def extract_long(load):
    df = _longitudinal(load)
    return EX.extract(df, _catalogue(df), ["F", "O"], ["money"])


@query(f"""WITH {LONGITUDINAL} SELECT id, 4 AS "group", {", ".join(
    f"max(CASE WHEN timepoint = '{t}' THEN {e} END) AS {t}_{c}" for t in ("F", "O")
    for c, e in {"price": sql_text("price"), "done": "CAST(done AS VARCHAR)", "n": "CAST(n AS VARCHAR)"}.items())}
FROM v WHERE timepoint IN ('F', 'O') GROUP BY id""")
def extract_wide(load):
    df = _longitudinal(load)
    return EX.extract(df, _catalogue(df), ["F", "O"], ["money"], shape="wide")


@query(f"SELECT o_orderkey AS seq, {sql_text('o_totalprice')} AS price, {sql_text('floor(o_totalprice)')} AS whole FROM orders")
def number_text(load):
    p = F.col("o_totalprice")
    return load("orders").select(F.col("o_orderkey").alias("seq"), plain_text(p, "double").alias("price"),
                                 plain_text(F.floor(p).cast("double"), "double").alias("whole"))
