"""Queries on events seen as a sparse long export."""

from __future__ import annotations

from pyspark.sql import functions as F

from longitab import vocab as V
from longitab.functions.score import either_or
from longitab.functions.text import paste
from longitab.operators import aggregate as A
from longitab.operators import joins as J
from longitab.operators import reshape as R
from longitab.operators import rows as RW
from longitab.operators import schema as S
from longitab.operators.collapse import coalesce_by_column
from longitab.operators.fill import fill
from longitab.plans import adherence as AD
from longitab.plans import standardise as ST
from longitab.plans import timepoints as TP
from longitab.plans.cohort import keep_consented
from longitab.plans.final import final_table as finish
from longitab.plans.longitudinal import longitudinal
from longitab.plans.monitoring import merge_checkbox_arms as merge_arms
from longitab.plans.monitoring import monitoring

from .derive import EVENTS, SPARSE, SUPPLEMENTS, TYPES, first, sparse_events
from .registry import query

VALUES = [f"{t}_v" for t in TYPES]


# -- collapse, cohort, timepoints ------------------------------------------

@query(f"""WITH {SPARSE} SELECT id, {", ".join(f"{first(c)} AS {c}" for c in [*VALUES, "note", "done"])}
FROM sparse GROUP BY id""", name="coalesce_by_column")
def _coalesce(load):
    return coalesce_by_column(sparse_events(load), ["id"], "seq", [*VALUES, "note", "done"])


TICK = "CASE WHEN event = 'purchase' AND value > 150 THEN 1 WHEN event = 'signup' THEN 0 END"


@query(f"""WITH {SPARSE}, t AS (SELECT *, {TICK} AS consent_tick FROM sparse)
SELECT id, seq, event, consent_tick FROM t WHERE id IN (SELECT id FROM t WHERE consent_tick = 1)""")
def cohort_semi_join(load):
    df = sparse_events(load).withColumn("consent_tick", F.expr(TICK))
    return keep_consented(df, "id").select("id", "seq", "event", "consent_tick")


SLOTS = """CASE event WHEN 'signup' THEN 'mpre' WHEN 'view' THEN 'm0' WHEN 'click' THEN 'm2'
  WHEN 'purchase' THEN 'm4' WHEN 'error' THEN 'm4_extra' END"""
ASSEMBLED = [*VALUES, "note", "value", "event", "done"]
SHARED = ["value", "event", "done", "error_v"]
LATER = "(y.done IS NOT NULL AND (x.done IS NULL OR y.done < x.done))"

ASSEMBLY = f"""tagged AS (SELECT *, {SLOTS} AS slot FROM sparse),
collapsed AS (SELECT id, slot, {", ".join(f"{first(c)} AS {c}" for c in ASSEMBLED)}
  FROM tagged GROUP BY id, slot),
assembled AS (
  SELECT x.id, x.slot AS timepoint, {", ".join(
      f"CASE WHEN {LATER} THEN y.{c} ELSE x.{c} END AS {c}" if c in SHARED else f"x.{c}"
      for c in ASSEMBLED)}
  FROM collapsed x LEFT JOIN (SELECT * FROM collapsed WHERE slot = 'm4_extra') y
    ON x.id = y.id AND x.slot = 'm4'
  WHERE x.slot <> 'm4_extra')"""


def assembled(load):
    export = sparse_events(load).select("id", "seq", *ASSEMBLED)
    return TP.assemble(export, event="event", events=EVENTS, supplements=SUPPLEMENTS, earliest="done")


@query(f"WITH {SPARSE}, {ASSEMBLY} SELECT * FROM assembled")
def timepoint_assembly(load):
    """Events to one row per participant and timepoint, supplement merged, sorted."""
    return assembled(load).orderBy("id", TP.timepoint_rank())


@query(f"""WITH {SPARSE} SELECT id, seq, 'mpre' AS timepoint, signup_v, NULL AS view_v, NULL AS mixed
FROM sparse WHERE event = 'signup'
UNION ALL SELECT id, seq, 'm0', NULL, view_v, CAST(k AS VARCHAR) FROM sparse WHERE event = 'view'
UNION ALL SELECT id, seq, 'm2', NULL, NULL, note FROM sparse WHERE event NOT IN ('signup', 'view')""")
def timepoint_union(load):
    df = sparse_events(load)
    tp = lambda t: F.lit(t).alias("timepoint")
    return R.union_by_name(
        df.filter("event = 'signup'").select("id", "seq", tp("mpre"), "signup_v"),
        df.filter("event = 'view'").select("id", "seq", tp("m0"), "view_v", F.col("k").alias("mixed")),
        df.filter("event NOT IN ('signup', 'view')").select("id", "seq", tp("m2"), F.col("note").alias("mixed")),
    )


DOB = "CASE WHEN k >= 30 THEN CAST(date_add(DATE '1960-02-29', k * 137) AS STRING) END"
DOB_SQL = "CASE WHEN k >= 30 THEN strftime(DATE '1960-02-29' + k * 137, '%Y-%m-%d') END"
PROMS = "CASE WHEN event = 'view' AND value > 60 THEN done_text WHEN event = 'view' AND value < 3 THEN '[not completed]' END"
YEARS = ("CAST(year({b}) - year({a}) - CASE WHEN month({b}) * 100 + day({b}) < month({a}) * 100 + day({a}) "
         "THEN 1 ELSE 0 END AS BIGINT)")


@query(f"""WITH {SPARSE},
pre AS (SELECT id, {first("done_text")} AS base_pre, {first("dob")} AS dob_pre,
    {first("bl_birthcountry")} AS bl_birthcountry, {first("bl_pass")} AS bl_pass
  FROM (SELECT *, {DOB_SQL} AS dob, note AS bl_birthcountry, value AS bl_pass FROM sparse WHERE event = 'signup')
  GROUP BY id),
base AS (SELECT id, {first("completed_proms")} AS completed_proms, {first("dob")} AS dob0, {first("k")} AS k
  FROM (SELECT *, {DOB_SQL} AS dob, {PROMS} AS completed_proms FROM sparse WHERE event = 'view')
  GROUP BY id),
joined AS (SELECT coalesce(base.id, pre.id) AS id, bl_birthcountry, bl_pass, k,
    CAST(try_cast(completed_proms AS TIMESTAMP) AS DATE) AS baseline_date,
    coalesce(dob0, dob_pre) AS dob, coalesce(completed_proms, base_pre) AS completed_proms
  FROM base FULL JOIN pre ON base.id = pre.id),
aged AS (SELECT *, CAST(dob AS DATE) AS a,
    coalesce(baseline_date, CAST(try_cast(completed_proms AS TIMESTAMP) AS DATE)) AS b FROM joined)
SELECT aged.id, bl_birthcountry, bl_pass, k, baseline_date, dob, completed_proms,
  {YEARS.format(a="a", b="b")} AS age, c_mktsegment AS segment
FROM aged LEFT JOIN customer ON aged.id = c_custkey
WHERE completed_proms IS NOT NULL AND completed_proms <> '[not completed]'""")
def baseline_merge(load):
    """Pre-baseline questionnaire block, side table, dates and age on the baseline row."""
    df = sparse_events(load).select(
        "id", "seq", "event", "k", F.expr(PROMS).alias("completed_proms"), F.expr(DOB).alias("dob"),
        F.col("done_text").alias("completed_base"), F.col("note").alias("bl_birthcountry"),
        F.col("value").alias("bl_pass"),
    )
    side = load("customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"))
    tagged = TP.tag_slots(df, "event", {t: e for t, e in EVENTS.items() if t in ("mpre", "m0")})
    routed = TP.route_prebaseline(tagged, "id", "seq", S.between(df, *V.PREBASELINE_BLOCK))
    rows = coalesce_by_column(routed, ["id", "slot"], "seq")
    base = TP.finish_baseline(rows, "id", [side]).filter(F.col("slot") == "m0")
    return base.select("id", "bl_birthcountry", "bl_pass", "k", "baseline_date", "dob", "completed_proms",
                       F.col("age").cast("bigint").alias("age"), "segment")


# -- joins -----------------------------------------------------------------

@query(f"""WITH {SPARSE}, d AS (SELECT *, CAST(ts AS DATE) AS day FROM sparse),
x AS (SELECT id, day, {first("click_v")} AS click_v, {first("note")} AS note FROM d WHERE event <> 'purchase' GROUP BY id, day),
y AS (SELECT id, day, {first("purchase_v")} AS purchase_v FROM d WHERE event = 'purchase' GROUP BY id, day)
SELECT id, day, click_v, note, purchase_v FROM x FULL JOIN y USING (id, day)""")
def full_join(load):
    """Purchases and all else of each person and day, one row each."""
    df = sparse_events(load).withColumn("day", F.to_date("ts"))
    x = coalesce_by_column(df.filter("event <> 'purchase'"), ["id", "day"], "seq", ["click_v", "note"])
    y = coalesce_by_column(df.filter("event = 'purchase'"), ["id", "day"], "seq", ["purchase_v"])
    return J.full_join(x, y, ["id", "day"])


@query(f"""WITH {SPARSE}, d AS (SELECT *, CAST(ts AS DATE) AS day FROM sparse),
x AS (SELECT id, day, seq, click_v FROM d WHERE event <> 'purchase'),
y AS (SELECT id, day, {first("purchase_v")} AS purchase_v FROM d WHERE event = 'purchase' GROUP BY id, day)
SELECT id, day, seq, click_v, purchase_v FROM x FULL JOIN y USING (id, day)""")
def full_join_split(load):
    """The form for a left side with hot keys."""
    df = sparse_events(load).withColumn("day", F.to_date("ts"))
    x = df.filter("event <> 'purchase'").select("id", "day", "seq", "click_v")
    y = coalesce_by_column(df.filter("event = 'purchase'"), ["id", "day"], "seq", ["purchase_v"])
    return J.full_join_split(x, y, ["id", "day"])


@query(f"""WITH {SPARSE}, {ASSEMBLY}
SELECT x.id, x.timepoint, x.value, y.half FROM assembled x
LEFT JOIN (SELECT id, value / 2 AS half FROM assembled WHERE timepoint = 'm0') y ON x.id = y.id""")
def broadcast_baseline(load):
    df = assembled(load)
    return J.attach_from(df, "id", F.col("timepoint") == "m0", {"half": F.col("value") / 2}).select(
        "id", "timepoint", "value", "half")


@query(f"""WITH {SPARSE},
x AS (SELECT id, seq, note FROM sparse),
y AS (SELECT id, note, count(*) AS n FROM sparse GROUP BY id, note)
SELECT x.id, x.seq, x.note, y.n FROM x LEFT JOIN y
  ON x.id IS NOT DISTINCT FROM y.id AND x.note IS NOT DISTINCT FROM y.note""")
def null_safe_join(load):
    df = sparse_events(load)
    y = df.groupBy("id", "note").agg(F.count("*").alias("n"))
    return J.left_join(df.select("id", "seq", "note"), y, ["id", "note"], null_safe=True)


# -- fills -----------------------------------------------------------------

def _fill_sql(exprs):
    down = "last_value({c} IGNORE NULLS) OVER (PARTITION BY id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    up = "first_value({c} IGNORE NULLS) OVER (PARTITION BY id ORDER BY seq ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    both = {"down": down, "up": up, "downup": f"coalesce({down}, {up})", "updown": f"coalesce({up}, {down})"}
    return ", ".join(f"{both[way].format(c=c)} AS {c}" for c, way in exprs.items())


def _fill_query(way):
    cols = dict.fromkeys(["signup_v", "click_v", "note"], way)

    @query(f"WITH {SPARSE} SELECT id, seq, {_fill_sql(cols)} FROM sparse", name=f"fill_{way}")
    def run(load):
        return fill(sparse_events(load).select("id", "seq", *cols), cols, ["id"], "seq")


for _way in ("down", "up", "downup", "updown"):
    _fill_query(_way)

MIXED = {"signup_v": "down", "click_v": "up", "note": "downup", "done": "updown"}


@query(f"WITH {SPARSE} SELECT id, seq, {_fill_sql(MIXED)} FROM sparse")
def fill_mixed(load):
    """One pass for columns with different directions."""
    return fill(sparse_events(load).select("id", "seq", *MIXED), MIXED, ["id"], "seq")


@query(f"""WITH {SPARSE}, x AS (SELECT event, seq * seq AS seq, {", ".join(f"CASE WHEN k % 9 = {i} THEN {c} END AS {c}" for i, c in enumerate(("value", "note", "ts", "k")))} FROM sparse)
SELECT event, seq, {_fill_sql({"value": "down", "note": "up", "ts": "downup", "k": "updown"}).replace("BY id", "BY event")} FROM x""")
def fill_blocks(load):
    """Five large groups in blocks of 500 rows at most, with gaps in the order that grow."""
    ways = {"value": "down", "note": "up", "ts": "downup", "k": "updown"}
    sparse = sparse_events(load).select(
        "event", (F.col("seq") * F.col("seq")).alias("seq"), *[F.when(F.col("k") % 9 == i, F.col(c)).alias(c) for i, c in enumerate(ways)])
    return fill(sparse, ways, ["event"], "seq", rows_per_block=500)


GRAFT_CODE = "CASE WHEN k < 15 THEN 1 WHEN k < 30 THEN 2 WHEN k < 45 THEN 3 WHEN k < 60 THEN 4 WHEN k < 90 THEN 5 ELSE 6 END"
SX_GRAFT = f"CASE WHEN event = 'purchase' AND value > 150 THEN {GRAFT_CODE} END"
SX_OTHER = "CASE WHEN value > 200 THEN 'tibialis anterior allograft' WHEN value > 170 THEN 'peroneal' END"
SX_SIDE = "CASE WHEN event = 'purchase' AND value > 150 THEN CASE WHEN value > 190 THEN 2 ELSE 1 END END"
BL_GRAFT = "CASE WHEN event = 'signup' AND value > 100 THEN CASE WHEN k < 25 THEN 1 WHEN k < 50 THEN 2 WHEN k < 75 THEN 3 ELSE 4 END END"


@query(f"""WITH {SPARSE},
coded AS (SELECT id, seq, {SX_GRAFT} AS g, {SX_OTHER} AS o, {SX_SIDE} AS s, {BL_GRAFT} AS b FROM sparse),
labelled AS (SELECT id, seq, s,
    CASE g WHEN 1 THEN 'Hamstring' WHEN 2 THEN 'Quadriceps' WHEN 3 THEN 'BPTB' WHEN 4 THEN 'Allograft'
      WHEN 5 THEN o WHEN 6 THEN 'Unknown' END AS sx,
    CASE b WHEN 1 THEN 'Hamstring' WHEN 2 THEN 'BPTB' WHEN 3 THEN 'Quadriceps' WHEN 4 THEN 'Other' END AS bl
  FROM coded),
one AS (SELECT id, seq, bl, CASE WHEN s = 2 THEN 'Contralateral ' || sx ELSE sx END AS aclrgraft FROM labelled),
filled AS (SELECT id, seq, bl, {_fill_sql({"aclrgraft": "downup"})} FROM one),
two AS (SELECT id, seq, CASE WHEN aclrgraft IS NULL THEN bl
    WHEN aclrgraft = 'tibialis anterior allograft' THEN 'Allograft' ELSE aclrgraft END AS aclrgraft FROM filled)
SELECT id, seq, {_fill_sql({"aclrgraft": "downup"})} FROM two""")
def resolve_with_fallback(load):
    df = sparse_events(load).select(
        "id", "seq", F.expr(SX_GRAFT).alias("sx_graft"), F.expr(SX_OTHER).alias("sx_graft_other"),
        F.expr(SX_SIDE).alias("sx_graftside"), F.expr(BL_GRAFT).alias("bl_grafttype"))
    return ST.resolve_graft(df).select("id", "seq", "aclrgraft")


@query(f"WITH {SPARSE} SELECT id, seq, coalesce(done, ts) AS completed, coalesce(click_v, view_v, -1) AS v FROM sparse")
def coalesce_precedence(load):
    return sparse_events(load).select("id", "seq", F.coalesce("done", "ts").alias("completed"),
                                      F.coalesce("click_v", "view_v", F.lit(-1.0)).alias("v"))


# -- filters ---------------------------------------------------------------

@query(f"WITH {SPARSE} SELECT id, seq, signup_v, view_v, note FROM sparse")
def drop_all_null(load):
    df = sparse_events(load).select("id", "seq", "signup_v", "view_v", "note",
                                    F.when(F.col("value") < 0, F.col("note")).alias("blank"))
    return S.drop_null_columns(df)


@query("SELECT event_id, user_id, event_type FROM events WHERE event_type IN ('click', 'view')")
def filter_isin(load):
    return load("events").filter(F.col("event_type").isin("click", "view")).select("event_id", "user_id", "event_type")


@query(f"WITH {SPARSE} SELECT id, seq, done FROM sparse WHERE done IS NOT NULL")
def filter_not_null(load):
    return sparse_events(load).filter(F.col("done").isNotNull()).select("id", "seq", "done")


@query(f"WITH {SPARSE} SELECT id, seq, done, click_v FROM sparse WHERE NOT (done IS NULL AND click_v IS NULL)")
def filter_not_all_null(load):
    return RW.drop_all_missing(sparse_events(load).select("id", "seq", "done", "click_v"), ["done", "click_v"])


# -- aggregates ------------------------------------------------------------

@query("SELECT DISTINCT user_id AS id FROM events")
def distinct_keys(load):
    return load("events").select(F.col("user_id").alias("id")).distinct()


@query(f"""WITH {SPARSE} SELECT id, seq, event, value FROM (
  SELECT *, row_number() OVER (PARTITION BY id, event ORDER BY seq) AS rn FROM sparse) WHERE rn = 1""")
def distinct_keep_first(load):
    return RW.distinct_first(sparse_events(load).select("id", "seq", "event", "value"), ["id"], "event", ["seq"])


@query("SELECT user_id AS id, count(*) AS n FROM events GROUP BY 1")
def group_count(load):
    return load("events").groupBy(F.col("user_id").alias("id")).agg(F.count("*").alias("n"))


@query("""SELECT user_id AS id, count(*) AS responses, round_even(count(*) * 100.0::DOUBLE / 7.0::DOUBLE, 2) AS perc
FROM events GROUP BY 1""")
def percent_of_expected(load):
    n = F.count("*")
    return load("events").groupBy(F.col("user_id").alias("id")).agg(
        n.alias("responses"), A.percent_of(n, V.EXPECTED_RESPONSES).alias("perc"))


@query(f"""WITH {SPARSE} SELECT id, event,
  round_even(CASE WHEN count(click_v) = count(*) THEN sum(click_v) END, 2) AS click_sum,
  CAST(CASE WHEN count(done) = count(*) THEN sum(k) END AS BIGINT) AS k_sum
FROM (SELECT id, event, click_v, done, CASE WHEN done IS NOT NULL THEN k END AS k FROM sparse) GROUP BY id, event""")
def strict_sum(load):
    df = sparse_events(load).withColumn("k", F.when(F.col("done").isNotNull(), F.col("k")))
    return df.groupBy("id", "event").agg(
        F.bround(A.strict_sum("click_v"), 2).alias("click_sum"), A.strict_sum("k").alias("k_sum"))


@query(f"WITH {SPARSE} SELECT id, event, round_even(avg(sqrt(click_v)) / 2, 4) AS half_mean FROM sparse GROUP BY id, event")
def mean_skip_null(load):
    return sparse_events(load).groupBy("id", "event").agg(F.bround(F.avg(F.sqrt("click_v")) / 2, 4).alias("half_mean"))


@query(f"WITH {SPARSE} SELECT note AS f, count(*) AS n FROM sparse GROUP BY 1 ORDER BY n DESC, f NULLS LAST")
def category_freq(load):
    return A.frequency(sparse_events(load), "note", sort=True)


@query(f"WITH {SPARSE} SELECT event, id, note AS f, count(*) AS n FROM sparse GROUP BY 1, 2, 3")
def category_freq_by_group(load):
    return A.frequency(sparse_events(load), "note", by=["event", "id"])


@query("SELECT user_id AS id, CAST(ts AS DATE) AS day, " + ", ".join(
    f"nullif(count(*) FILTER (WHERE event_type = '{t}'), 0) AS {t}" for t in TYPES) + " FROM events GROUP BY 1, 2")
def pivot_single(load):
    """A person's events per day, null where there are none of a type."""
    n = load("events").groupBy(F.col("user_id").alias("id"), F.to_date("ts").alias("day"), "event_type").agg(
        F.count("*").alias("n"))
    return R.wider(n, ["id", "day"], "event_type", "n", values=TYPES)


# -- composed tables -------------------------------------------------------

def _export(load):
    """Events under export column names."""
    return sparse_events(load).select(
        F.col("id").alias("record_id"), "seq", F.col("done_text").alias("demographic_questionnaire_timestamp"),
        F.when(F.col("event") == "view", F.coalesce("done_text", F.lit("[not completed]")))
        .alias("physical_testing_anthropometrics_timestamp"),
        F.when(F.col("event") == "signup", F.expr(DOB)).alias("q_dob"),
        F.when(F.col("event") == "click", F.floor(F.col("k") / 20).cast("int")).alias("q_gender"),
        F.floor(F.col("k") / 25).cast("int").alias("sex"), F.col("note").alias("sex_other"),
        F.when(F.col("k") < 80, F.floor(F.col("k") / 40).cast("int")).alias("group"),
        F.floor(F.col("k") / 33).cast("int").alias("bl_birthcountry"), F.col("event").alias("bl_birthcountrytext"),
        F.floor(F.col("k") / 30).cast("int").alias("bl_aclrside"), F.floor(F.col("k") / 45).cast("int").alias("dominanthand"),
        F.col("k").alias("trash"), F.col("k").alias("form_complete"), F.col("done_text").alias("other_timestamp"),
    )


STANDARD = f"""export AS (SELECT id, seq, done_text AS completed_base,
    CASE WHEN event = 'view' THEN done_text END AS completed_lab,
    CASE WHEN event = 'signup' THEN {DOB_SQL} END AS dob,
    CASE WHEN event = 'click' THEN CASE k // 20 WHEN 0 THEN 'Man' WHEN 1 THEN 'Woman' WHEN 2 THEN 'Other'
      WHEN 3 THEN 'Prefer not to say' END END AS gender,
    CASE k // 25 WHEN 1 THEN 'Male' WHEN 2 THEN 'Female' WHEN 3 THEN note END AS sex,
    CASE WHEN k < 40 THEN 7 WHEN k < 80 THEN 4 END AS "group",
    CASE k // 33 WHEN 1 THEN 'Australia' WHEN 2 THEN event END AS bl_birthcountry,
    CASE k // 30 WHEN 1 THEN 'Left' WHEN 2 THEN 'Right' END AS bl_aclrside,
    CASE k // 45 WHEN 0 THEN 'Left' WHEN 1 THEN 'Right' END AS dominanthand
  FROM sparse)"""


@query(f"""WITH {SPARSE}, {STANDARD}
SELECT id, seq, completed_base, completed_lab, {_fill_sql({"dob": "down", "gender": "updown"})}, sex, "group",
  bl_birthcountry, bl_aclrside, dominanthand FROM export""")
def standardise(load):
    """Dictionary rename, recodes, administrative columns dropped, demographics filled."""
    df = _export(load)
    dictionary = df.sparkSession.createDataFrame(
        [("q_dob", "dob", None), ("q_gender", "gender", None), ("trash", "rubbish", "remove")],
        "varname string, newname string, remove string")
    return ST.standardise(df, dictionary)


KOOS = ["p1", "p2", "s1", "s4", "s5", "sp1", "q1", "pf1", "a1"]


def _items(load):
    """Assembled rows with questionnaire items made from their values."""
    df = coalesce_by_column(
        TP.tag_slots(sparse_events(load), "event", EVENTS | {"m8": ["error"]}), ["id", "slot"], "seq",
        ["k", "value", "done_text", "ts", "note"]).withColumnRenamed("slot", "timepoint")
    # Items 0..4: the same answer shifted, blank where the value is low.
    item = lambda i: F.when(F.col("value") > i, F.pmod(F.floor(F.col("k") / 20) + i, F.lit(5)).cast("int"))
    return df.select(
        "id", "timepoint", F.lit(None).cast("string").alias("completed_base"),
        F.col("done_text").alias("completed_proms"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("completed_eq5d"),
        F.when(F.col("value") > 60, F.col("k")).alias("aclr_satisfaction2"), F.col("k").alias("aclr_satisfaction1"),
        F.expr("CASE WHEN k >= 30 THEN '2023-05-01' END").alias("bl_rupturedate"),
        F.expr("CAST(date_add(DATE '2023-03-01', k) AS STRING)").alias("bl_aclrdate"),
        F.when(F.col("timepoint") == "m0", F.to_date("ts")).alias("baseline_date"),
        F.when((F.col("timepoint") == "m2") & (F.col("value") > 50), F.col("done_text")).alias("firstphysiosession_date"),
        F.when(F.col("timepoint") == "m0", F.col("note")).alias("sex"),
        F.when((F.col("timepoint") != "mpre") & (F.col("value") > 40), F.col("k")).alias("group"),
        *[item(i).alias(f"pfoos_{c}") for i, c in enumerate(KOOS)], F.col("k").alias("koos_p1"),
        item(1).alias("aclqol_1a"), item(2).alias("aclqol_2"), F.col("k").alias("aclqol_work"),
        item(3).alias("eq5d_pain"), F.col("k").alias("eq5d_vas"),
        F.when(F.col("timepoint") == "m0", item(4)).alias("bl_pass"), item(0).alias("pass"),
    )


def _item(i):
    return f"CASE WHEN value > {i} THEN (k // 20 + {i}) % 5 END"


def _rev(c, forward=False):
    return c if forward else f"abs({c} - 4)"


def _sub(*items):
    total = " + ".join(_rev(f"pfoos_{c}", c in ("s4", "s5")) for c in items)
    return f"(100.0 - (({total}) / {float(len(items))}::DOUBLE) * 100.0 / 4.0)"


RANKED = "CASE timepoint WHEN 'mpre' THEN 1 WHEN 'm0' THEN 2 WHEN 'm2' THEN 3 WHEN 'm4' THEN 4 WHEN 'm8' THEN 5 END"
ITEMS = f"""collapsed AS (SELECT id, {SLOTS.replace("m4_extra", "m8")} AS timepoint, {", ".join(
      f"{first(c)} AS {c}" for c in ["k", "value", "done_text", "ts", "note"])}
  FROM sparse GROUP BY 1, 2),
base AS (SELECT id, timepoint, {RANKED} AS seq, k, value, done_text,
    coalesce(done_text, strftime(ts, '%Y-%m-%d %H:%M:%S')) AS completed,
    CASE WHEN value > 60 THEN k ELSE k END AS aclr_satisfaction,
    CASE WHEN k >= 30 THEN CAST(date_diff('day', DATE '2023-05-01', DATE '2023-03-01' + k) AS INTEGER) END AS bl_surgicaldelay,
    DATE '2023-03-01' + k AS bl_aclrdate,
    CASE WHEN timepoint = 'm0' THEN CAST(ts AS DATE) END AS baseline_date,
    CASE WHEN timepoint = 'm2' AND value > 50 THEN done_text END AS firstphysiosession_date,
    CASE WHEN timepoint = 'm0' THEN note END AS sex,
    CASE WHEN timepoint <> 'mpre' AND value > 40 THEN k END AS "group",
    {", ".join(f"{_item(i)} AS pfoos_{c}" for i, c in enumerate(KOOS))},
    {_item(1)} AS aclqol_1a, {_item(2)} AS aclqol_2, {_item(3)} + 1 AS eq_pain, {_item(0)} AS pass0,
    CASE WHEN timepoint = 'm0' THEN {_item(4)} END AS bl_pass
  FROM collapsed),
filled AS (SELECT * EXCLUDE (baseline_date, firstphysiosession_date, sex, "group"),
    {_fill_sql({"baseline_date": "downup", "firstphysiosession_date": "downup", "sex": "downup", '"group"': "downup"})}
  FROM base),
scored AS (SELECT *, {", ".join(f'''{_sub(*[c for c in KOOS if c.rstrip("0123456789") == s])} AS koos_{s}_total'''
      for s in ["p", "s", "sp", "q", "pf", "a"])}
  FROM filled)"""
FROM_START = """CASE WHEN timepoint = 'mpre' THEN NULL WHEN timepoint = 'm0' THEN 0.0::DOUBLE ELSE round_even(date_diff('day',
  coalesce(CAST(CAST(firstphysiosession_date AS TIMESTAMP) AS DATE), baseline_date),
  CAST(CAST(completed AS TIMESTAMP) AS DATE)) / 7.0::DOUBLE, 2) END"""


@query(f"""WITH {SPARSE}, {ITEMS}
SELECT id, timepoint, aclr_satisfaction, bl_surgicaldelay, baseline_date, sex, "group",
  koos_p_total, koos_s_total, koos_sp_total, koos_q_total, koos_pf_total, koos_a_total,
  (koos_p_total + koos_s_total + koos_sp_total + koos_q_total) / 4.0::DOUBLE AS koos_4_total,
  (aclqol_1a + aclqol_2) / 2.0::DOUBLE AS aclqol_total, eq_pain, k AS eq_vas, coalesce(bl_pass, pass0) AS pass,
  CAST(CAST(completed AS TIMESTAMP) AS DATE) AS completed, {FROM_START} AS timepoint_actual
FROM scored""")
def score_longitudinal(load):
    """Participant fills, instrument swap, reversal, subscales, weeks from the start."""
    cols = ["id", "timepoint", "aclr_satisfaction", "bl_surgicaldelay", "baseline_date", "sex", "group",
            *V.SUBSCALES, "koos_4_total", "aclqol_total", "eq_pain", "eq_vas", "pass", "completed", "timepoint_actual"]
    return longitudinal(_items(load)).select(*cols)


@query(f"""WITH {SPARSE}, {ITEMS},
whole AS (SELECT *, date_diff('year', bl_aclrdate, baseline_date)
    - CASE WHEN month(baseline_date) * 100 + day(baseline_date) < month(bl_aclrdate) * 100 + day(bl_aclrdate)
      THEN 1 ELSE 0 END AS y FROM scored WHERE timepoint = 'm0'),
since AS (SELECT id, y + date_diff('day', CAST(bl_aclrdate + to_months(CAST(12 * y AS INTEGER)) AS DATE), baseline_date)
    / date_diff('day', CAST(bl_aclrdate + to_months(CAST(12 * y AS INTEGER)) AS DATE),
      CAST(bl_aclrdate + to_months(CAST(12 * y + 12 AS INTEGER)) AS DATE))::DOUBLE AS years FROM whole),
sided AS (SELECT *, CASE WHEN k < 45 THEN 'Left' WHEN k < 80 THEN 'Right' END AS side FROM scored)
SELECT sided.id, sex, timepoint, {FROM_START} AS timepoint_actual, baseline_date,
  CAST(CAST(completed AS TIMESTAMP) AS DATE) AS completed, "group", DATE '1960-02-29' + k * 137 AS dob,
  coalesce(side, 'Unsure') AS aclrside, c_mktsegment AS postcode, years AS yearssinceaclr, abs(pfoos_s1 - 4) AS koos_s1,
  CASE side WHEN 'Left' THEN {"CAST(k AS VARCHAR)"} WHEN 'Right' THEN timepoint END AS a_hop,
  CASE side WHEN 'Left' THEN timepoint WHEN 'Right' THEN CAST(k AS VARCHAR) END AS c_hop,
  CASE WHEN side IS NOT NULL THEN k END AS left_aclr_no,
  CASE WHEN side IS NOT NULL THEN k + 1 END AS right_aclr_no
FROM sided LEFT JOIN since USING (id) LEFT JOIN customer ON sided.id = c_custkey
WHERE NOT (completed IS NULL AND pfoos_s1 IS NULL)""")
def final_table(load):
    """Sides, joins, column order, sort, blinding."""
    items = _items(load)
    k, tp = F.col("k"), F.col("timepoint")
    extra = items.withColumn("k", F.col("eq5d_vas")).withColumns({
        "bl_aclrside": F.when(k < 45, "Left").when(k < 80, "Right"),
        "bl_aclrside_demographic": F.lit("Unsure"), "l_hop": k, "r_hop": tp,
        "l_aclr_no": k, "r_aclr_no": k + 1,
        "dob": F.expr("CAST(date_add(DATE '1960-02-29', k * 137) AS STRING)"),
        "blgoals_run": k, "treatment_satisfaction": k, "y2_hop": k, "bl_concurrent": k,
    }).drop("k")
    # The participant-level columns above vary by row here, so only the rest is filled.
    kept = ["bl_aclrside", "bl_aclrside_demographic", "dob", "l_aclr_no", "r_aclr_no"]
    scored = longitudinal(extra.withColumnsRenamed({c: f"own_{c}" for c in kept})).withColumnsRenamed(
        {f"own_{c}": c for c in kept})
    post = load("customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("postcode"))
    out = finish(scored, postcode=post)
    return out.select("id", "sex", "timepoint", "timepoint_actual", "baseline_date", "completed", "group", "dob",
                      "aclrside", "postcode", "yearssinceaclr", "koos_s1", "a_hop", "c_hop", "left_aclr_no", "right_aclr_no")


FORMS = {"signup": "2_week_fortnight_arm_1", "view": "pre4_month_questio_arm_1", "click": "8_month_questionna_arm_1",
         "purchase": "4_month_testing_arm_1", "error": "pre12_month_questi_arm_1"}


def _boxes(prefix, arms=V.ARMS):
    return {f"{prefix}_whichotherprof_{arm}___{n}": (i, n) for i, arm in enumerate(arms) for n in range(1, 10)}


def _box(i, n):
    """SQL for both engines: checkbox n of arm i, 1, 0 or blank."""
    return f"CASE WHEN value > {5 * i + n} THEN CASE WHEN k > {10 * n - 5 * i} THEN 1 ELSE 0 END END"


SESSIONS = {"super": "CASE WHEN value > 40 THEN note END", "control": "CASE WHEN value < 60 THEN event END"}
EITHER = "CASE WHEN ({a}) IS NULL THEN ({b}) WHEN ({b}) IS NULL THEN ({a}) END"


@query(f"""WITH {SPARSE}
SELECT id, CASE event WHEN 'signup' THEN 'w2' WHEN 'view' THEN 'w16' WHEN 'click' THEN 'm8' ELSE 'm12' END AS timepoint,
  coalesce(CAST(CAST(done_text AS TIMESTAMP) AS DATE), CASE WHEN k > 50 THEN CAST(ts AS DATE) END) AS completed,
  CASE k // 6 {" ".join(f"WHEN {c} THEN '{n}'" for c, n in V.SPORT.items())} END AS fn_sport_type_1,
  {", ".join(f"{_box(0, n)} + {_box(1, n)} AS fn_otherprof_{p}" for n, p in enumerate(V.PROFESSIONS, start=1))},
  note AS fn_otherprof_otherdetail,
  {EITHER.format(a=SESSIONS["super"], b=SESSIONS["control"])} AS fn_otherprof_sessions, k AS mth_hours
FROM sparse WHERE event <> 'purchase'""")
def monitoring_table(load):
    df = sparse_events(load)
    form = F.create_map(*[F.lit(x) for kv in FORMS.items() for x in kv])[F.col("event")]
    return monitoring(df.select(
        "id", form.alias("redcap_event_name"), F.col("done_text").alias("fn_completed"),
        F.when(F.col("k") > 50, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("mth_completed"),
        F.floor(F.col("k") / 6).cast("int").alias("fn_sport_type_1"),
        *[F.expr(_box(*at)).alias(c) for c, at in _boxes("fn").items()], F.col("note").alias("fn_whichotherprof_other"),
        *[F.expr(e).alias(f"fn_otherprofsessions_{arm}") for arm, e in SESSIONS.items()], F.col("k").alias("mth_hours"),
    ))


@query(f"""WITH {SPARSE} SELECT id, seq,
  {", ".join(f"{_box(0, n)} + {_box(1, n)} AS mth_otherprof_{p}" for n, p in enumerate(V.PROFESSIONS, start=1))} FROM sparse""")
def merge_checkbox_arms(load):
    df = sparse_events(load).select("id", "seq", *[F.expr(_box(*at)).alias(c) for c, at in _boxes("mth").items()])
    return S.drop_matching(merge_arms(df, "mth"), "whichotherprof")


@query(f"""WITH {SPARSE} SELECT id, seq, {EITHER.format(a=SESSIONS["super"], b=SESSIONS["control"])} AS sessions FROM sparse""")
def either_or_merge(load):
    df = sparse_events(load).select("id", "seq", *[F.expr(e).alias(arm) for arm, e in SESSIONS.items()])
    return df.select("id", "seq", either_or("super", "control").alias("sessions"))


def _weekly(load):
    big = lambda c, v: F.when(F.col("value") > v, F.col(c))
    return sparse_events(load).select(
        paste(F.lit("P_"), "id", sep="").alias("id"), "event",
        F.sqrt("k").alias("fn_physioattendance_super"), F.sqrt(big("k", 1)).alias("fn_strengthsessions_super"),
        F.floor(F.col("k") / 50).cast("int").alias("fn_strengthsessions_control"),
        F.when(F.col("value") > 3, F.sqrt("k")).alias("fn_strengthsessionsfreq_control"),
        F.sqrt(big("value", 30)).alias("fn_sessionlength"), F.sqrt("click_v").alias("fn_rpe"),
        *[big("k", 10 * i).alias(f"fn_exercises_{e}") for i, e in enumerate(V.EXERCISES)],
    )


def _visits(load):
    c = load("customer")
    bal = F.col("c_acctbal")
    return c.select(
        F.col("c_custkey").alias("id"), F.when(F.col("c_mktsegment") == "BUILDING", "m0").otherwise("m4").alias("timepoint"),
        bal.alias("m4_strength_physio1to1"), F.when(bal > 0, F.lit(1.5)).alias("m4_strength_physiogroup"),
        F.when(bal < 5000, bal).alias("m4_strength_home"), F.lit(2.0).alias("m4_strength_gym"),
        bal.alias("m4_sessionlength"), F.col("c_nationkey").cast("double").alias("m4_rpe"))


FREQ = "CASE WHEN k < 50 THEN 0.0 WHEN value > 3 THEN sqrt(k) END"
STRICT = "CASE WHEN count({c}) = count(*) THEN round_even(CAST(sum({c}) AS DOUBLE), 2) END"
REPORTED = f"""weekly AS (SELECT 'P_' || id AS id, sqrt(k) AS physio, CASE WHEN value > 1 THEN sqrt(k) END AS strength,
    {FREQ} AS freq, CASE WHEN value > 30 THEN sqrt(value) END AS len, sqrt(click_v) AS rpe FROM sparse),
reported AS (SELECT id, count(*) AS responses, round_even(count(*) * 100.0::DOUBLE / 7.0::DOUBLE, 2) AS perc_complete,
    {STRICT.format(c="physio")} AS sum_physioattendance_super, {STRICT.format(c="strength")} AS sum_strengthattendance_super,
    {STRICT.format(c="freq")} AS sum_strengthattendance_control,
    round_even(avg(physio) / 2, 2) AS mean_physioattendance_super, round_even(avg(strength) / 2, 2) AS mean_strengthattendance_super,
    round_even(avg(freq) / 2, 2) AS mean_strengthattendance_control, round_even(avg(len), 2) AS mean_sessionlength,
    round_even(avg(rpe), 2) AS mean_rpe FROM weekly GROUP BY id),
assessed AS (SELECT 'P_' || c_custkey AS id, c_acctbal + CASE WHEN c_acctbal > 0 THEN 1.5 END AS m4_physio_mean,
    CASE WHEN c_acctbal < 5000 THEN c_acctbal END + 2.0 AS m4_strength_mean, c_acctbal AS m4_mean_sessionlength,
    CAST(c_nationkey AS DOUBLE) AS m4_mean_rpe FROM customer WHERE c_mktsegment <> 'BUILDING')"""


@query(f"""WITH {SPARSE}, {REPORTED}
SELECT *, {", ".join(f"perc_complete AS {e}_perc" for e in V.EXERCISES)} FROM reported FULL JOIN assessed USING (id)""")
def adherence_summary(load):
    return AD.adherence(_weekly(load), _visits(load), id_prefix="P_")


@query(f"""WITH {SPARSE}, {REPORTED}
SELECT id, CAST(ceil(coalesce(mean_strengthattendance_super, mean_strengthattendance_control)) AS BIGINT) AS reported,
  m4_strength_mean AS assessed FROM reported FULL JOIN assessed USING (id)""")
def strength_pairs(load):
    return AD.strength_pairs(AD.adherence(_weekly(load), _visits(load), id_prefix="P_"))
