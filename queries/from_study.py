"""The whole run on an export made from events, and what it is made of."""

from __future__ import annotations

from pyspark.sql import functions as F

from longitab import vocab as V
from longitab.plans import standardise as ST
from longitab.plans import timepoints as TP
from longitab.plans.clean import clean_study
from longitab.plans.cohort import consented
from longitab.plans.final import postcodes as find_postcodes
from longitab.plans.surgery import surgical_details as find_surgery

from .derive import SPARSE, first, sparse_events
from .from_events import (BL_GRAFT, DOB, DOB_SQL, FROM_START, KOOS, SX_GRAFT, SX_OTHER, SX_SIDE, TICK, YEARS, _fill_sql, _sub)
from .registry import query

EVENT_NAMES = {"signup": "online_consent_and_arm_1", "view": "baseline_questionn_arm_1", "click": "8_week_questionnai_arm_1",
               "purchase": "4_month_questionna_arm_1", "error": "covid_interum_4_mo_arm_1"}
LATER_ROWS = "event <> 'signup'"
# Export column -> its value on an event, in either SQL; the few that differ are below.
EXPORT = {
    "redcap_event_name": "CASE event " + " ".join(f"WHEN '{e}' THEN '{n}'" for e, n in EVENT_NAMES.items()) + " END",
    "consent_tick": TICK,
    "demographic_questionnaire_timestamp": "CASE WHEN event = 'signup' THEN done_text END",
    "pfoos_timestamp": "CASE WHEN event = 'view' AND value > 60 THEN done_text WHEN event = 'view' AND value < 3 THEN '[not completed]' "
                       "WHEN event NOT IN ('signup', 'view') THEN done_text END",
    "eq5d_timestamp": None,
    "fortnightly_activity_monitoring_timestamp": "CASE WHEN event = 'click' THEN done_text END",
    "monthly_activity_monitoring_timestamp": "CASE WHEN event = 'error' THEN done_text END",
    "alloc": f"CASE WHEN {LATER_ROWS} AND value > 40 THEN k % 2 END",
    "sex": "CASE WHEN event = 'view' THEN k % 3 + 1 END",
    "sex_other": "note",
    "gender": "CASE WHEN k < 40 THEN k % 4 END",
    "dob": None,
    "address_res": "CASE WHEN event = 'signup' AND value > 60 THEN note END",
    "bl_birthcountry": "CASE WHEN event IN ('signup', 'view') THEN k % 3 END",
    "bl_birthcountrytext": "note",
    "bl_rupturedate": "CASE WHEN event <> 'error' AND k >= 30 THEN '2023-05-01' END",
    "bl_pass": "CASE WHEN event = 'signup' AND value > 30 THEN k % 2 END",
    "bl_aclrdate": None,
    "bl_aclrside": "CASE WHEN event = 'view' AND k < 45 THEN 1 WHEN event = 'view' AND k < 80 THEN 2 END",
    "bl_grafttype": BL_GRAFT, "sx_graft": SX_GRAFT, "sx_graft_other": SX_OTHER, "sx_graftside": SX_SIDE,
    "sx_name": "CASE WHEN event = 'purchase' AND value > 190 THEN note END",
    "sx_primary": "k % 4", "sx_side": "k % 2 + 1",
    "sx_meniscus_med": "CASE WHEN k < 30 THEN k % 3 END", "sx_meniscus_lat": "1",
    "sx_cartilage_int": "CASE WHEN k > 50 THEN k % 3 END",
    "sx_patellacartilage": "k % 4", "sx_femoralcartilage_lat": "2",
    "aclr_satisfaction1": f"CASE WHEN {LATER_ROWS} THEN k END",
    "aclr_satisfaction2": f"CASE WHEN {LATER_ROWS} AND value > 60 THEN k + 1 END",
    "koos_p1": "CASE WHEN event = 'signup' THEN k % 5 END", "koos_s1": "CASE WHEN event = 'signup' THEN (k + 1) % 5 END",
    **{f"pfoos_{c}": f"CASE WHEN {LATER_ROWS} AND value > {i} THEN (k + {i}) % 5 END" for i, c in enumerate(KOOS)},
    "pass": f"CASE WHEN {LATER_ROWS} THEN k % 2 END",
    "eq5d_vas": f"CASE WHEN {LATER_ROWS} THEN k END",
    "l_hop": f"CASE WHEN {LATER_ROWS} THEN k END", "r_hop": "CASE WHEN event <> 'signup' THEN note END",
    "firstphysiosession_date": "CASE WHEN event = 'click' AND value > 50 THEN done_text END",
    "mridate": "CASE WHEN event = 'view' THEN done_text END",
}
ACLR = "CASE WHEN event = 'view' THEN {} END"
IN_SPARK = {"eq5d_timestamp": f"CASE WHEN {LATER_ROWS} THEN date_format(ts, 'yyyy-MM-dd HH:mm:ss') END", "dob": DOB,
            "bl_aclrdate": ACLR.format("CAST(date_add(DATE '2022-03-01', k) AS STRING)")}
IN_DUCKDB = {"eq5d_timestamp": f"CASE WHEN {LATER_ROWS} THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END", "dob": DOB_SQL,
             "bl_aclrdate": ACLR.format("strftime(DATE '2022-03-01' + k, '%Y-%m-%d')")}


def _export(load):
    cols = [F.expr(IN_SPARK.get(c) or e).alias(c) for c, e in EXPORT.items()]
    return sparse_events(load).select(F.col("id").alias("record_id"), "seq", *cols)


def _dictionary(load, *rows):
    return load("events").sparkSession.createDataFrame([("alloc", "group", None), *rows], "varname string, newname string, remove string")


def _sides(load):
    """Two side tables; the first has two rows of each id, the later one complete, and a name the export has as well."""
    c = load("customer")
    history = c.select(F.col("c_custkey").alias("id"), F.lit(1).alias("seq"), F.when(F.col("c_acctbal") > 4000, F.col("c_mktsegment")).alias("segment"),
                       F.lit(None).cast("int").alias("eq5d_vas"))
    later = c.select(F.col("c_custkey").alias("id"), F.lit(2).alias("seq"), F.lit("later").alias("segment"), F.col("c_nationkey").alias("eq5d_vas"))
    counts = c.select(F.col("c_custkey").alias("id"), (F.col("c_nationkey") % 3).alias("l_aclr_no"), (F.col("c_nationkey") % 2).alias("r_aclr_no"))
    return history.unionByName(later), counts


def _addresses(load):
    e = load("events")
    k = F.regexp_extract("props", r"(\d+)", 1).cast("int")
    return e.select(F.col("props").alias("address_res"), F.concat("props", F.lit(", Town VIC "), (F.lit(3000) + k).cast("string")).alias("address")).distinct()


NEW = {"demographic_questionnaire_timestamp": "completed_base", "pfoos_timestamp": "completed_proms", "eq5d_timestamp": "completed_eq5d",
       "alloc": '"group"'}
SEX_SQL = "CASE sex WHEN 1 THEN 'Male' WHEN 2 THEN 'Female' WHEN 3 THEN sex_other END"
GENDER_SQL = "CASE gender " + " ".join(f"WHEN {c} THEN '{n}'" for c, n in V.GENDER.items()) + " END"
SX_LABEL = ("CASE sx_graft WHEN 1 THEN 'Hamstring' WHEN 2 THEN 'Quadriceps' WHEN 3 THEN 'BPTB' WHEN 4 THEN 'Allograft' "
            "WHEN 5 THEN sx_graft_other WHEN 6 THEN 'Unknown' END")
BL_LABEL = "CASE bl_grafttype WHEN 1 THEN 'Hamstring' WHEN 2 THEN 'BPTB' WHEN 3 THEN 'Quadriceps' WHEN 4 THEN 'Other' END"
ITEMS = [f"pfoos_{c}" for c in KOOS]
BLOCK = ["bl_birthcountry", "bl_rupturedate", "bl_pass"]
OTHERS = ["sex", "bl_aclrdate", "bl_aclrside", "r_hop", "firstphysiosession_date", "mridate"]
# What the supplement answers as well.
SHARED = ["completed_proms", "completed_eq5d", '"group"', "dob", "gender", "aclrgraft", *ITEMS, "pass", "eq5d_vas", "l_hop",
          "aclr_satisfaction1", "aclr_satisfaction2"]
MAIN = ["completed_base", *SHARED, *OTHERS]
LATER = "(y.completed_proms IS NOT NULL AND (x.completed_proms IS NULL OR y.completed_proms < x.completed_proms))"

STUDY = f"""{SPARSE},
export AS (SELECT id, seq, event, {", ".join(f"{IN_DUCKDB.get(c) or e} AS {NEW.get(c, c)}" for c, e in EXPORT.items())} FROM sparse),
cohort AS (SELECT DISTINCT id FROM export WHERE consent_tick = 1),
labelled AS (SELECT * REPLACE ({SEX_SQL} AS sex, {GENDER_SQL} AS gender, CASE "group" WHEN 0 THEN 7 WHEN 1 THEN 4 END AS "group",
    CASE bl_birthcountry WHEN 1 THEN 'Australia' WHEN 2 THEN bl_birthcountrytext END AS bl_birthcountry,
    CASE bl_aclrside WHEN 1 THEN 'Left' WHEN 2 THEN 'Right' END AS bl_aclrside, {BL_LABEL} AS bl_grafttype),
  CASE WHEN sx_graftside = 2 THEN 'Contralateral ' || {SX_LABEL} ELSE {SX_LABEL} END AS reported FROM export),
filled AS (SELECT * EXCLUDE (dob, gender, reported, bl_grafttype),
    {_fill_sql({"dob": "down", "gender": "updown", "reported": "downup", "bl_grafttype": "downup"})} FROM labelled),
ready AS (SELECT *, coalesce(CASE reported WHEN 'tibialis anterior allograft' THEN 'Allograft' ELSE reported END, bl_grafttype) AS aclrgraft
  FROM filled WHERE id IN (SELECT id FROM cohort)),
routed AS (
  SELECT id, seq, 'mpre' AS slot, {", ".join(c for c in MAIN if c not in ITEMS)}, koos_p1 AS pfoos_p1, koos_s1 AS pfoos_s1 FROM ready WHERE event = 'signup'
  UNION ALL BY NAME SELECT id, seq, 'm0' AS slot, {", ".join(BLOCK)}, completed_base AS completed_proms_mpre, dob AS dob_pre FROM ready WHERE event = 'signup'
  UNION ALL BY NAME SELECT id, seq, 'm0' AS slot, {", ".join(MAIN)} FROM ready WHERE event = 'view'
  UNION ALL BY NAME SELECT id, seq, CASE event WHEN 'click' THEN 'm2' WHEN 'purchase' THEN 'm4' ELSE 'm4_extra' END AS slot,
    {", ".join(MAIN + BLOCK)} FROM ready WHERE event IN ('click', 'purchase', 'error')),
collapsed AS (SELECT id, slot, {", ".join(f"{first(c)} AS {c}" for c in [*MAIN, *BLOCK, "completed_proms_mpre", "dob_pre"])}
  FROM routed GROUP BY id, slot),
dated AS (SELECT c.* REPLACE (CASE WHEN slot = 'm0' THEN coalesce(dob, dob_pre) ELSE dob END AS dob,
    CASE WHEN slot = 'm0' THEN coalesce(completed_proms, completed_proms_mpre) ELSE completed_proms END AS completed_proms),
    CASE WHEN slot = 'm0' THEN CAST(try_cast(completed_proms AS TIMESTAMP) AS DATE) END AS baseline_date,
    CASE WHEN c_acctbal > 4000 THEN c_mktsegment WHEN c_custkey IS NOT NULL THEN 'later' END AS segment, c_nationkey AS eq5d_vas_y,
    c_nationkey % 3 AS l_aclr_no, c_nationkey % 2 AS r_aclr_no
  FROM collapsed c LEFT JOIN customer ON c.id = c_custkey AND slot = 'm0'),
aged AS (SELECT *, CASE WHEN slot = 'm0' THEN CAST(dob AS DATE) END AS a,
    coalesce(baseline_date, CAST(try_cast(completed_proms AS TIMESTAMP) AS DATE)) AS b
  FROM dated WHERE slot <> 'm0' OR (completed_proms IS NOT NULL AND completed_proms <> '[not completed]')),
based AS (SELECT *, {YEARS.format(a="a", b="b")} AS age FROM aged),
rows AS (SELECT x.id, x.slot AS timepoint, {", ".join(f"CASE WHEN {LATER} THEN y.{c} ELSE x.{c} END AS {c}" for c in SHARED)},
    {", ".join(f"x.{c}" for c in ["completed_base", *OTHERS, *BLOCK, "baseline_date", "age", "segment", "eq5d_vas_y", "l_aclr_no", "r_aclr_no"])}
  FROM based x LEFT JOIN (SELECT * FROM based WHERE slot = 'm4_extra') y ON x.id = y.id AND x.slot = 'm4' WHERE x.slot <> 'm4_extra')"""


@query(f"""WITH {STUDY}
SELECT id, timepoint, completed_base, completed_proms, completed_eq5d, baseline_date, age, dob, gender, sex, aclrgraft, "group", {", ".join(BLOCK + ITEMS)},
  pass, eq5d_vas, l_hop, r_hop, aclr_satisfaction1, aclr_satisfaction2, bl_aclrdate, bl_aclrside, segment, eq5d_vas_y, l_aclr_no, r_aclr_no FROM rows""")
def study_timepoints(load):
    """One row per participant and timepoint; the dictionary removes the consent tick."""
    export = _export(load)
    dictionary = _dictionary(load, ("consent_tick", "consent_tick", "remove"))
    df = ST.graft_candidates(ST.standardise(export, dictionary))
    keys = ["id", "redcap_event_name", "seq"]
    cohort = consented(export, "record_id").toDF("id")
    grafts = ST.finish_graft(ST.fill(df.select(*keys, *ST.GRAFT_FILLS, "dob", "gender"), ST.GRAFT_FILLS, ["id"], "seq"))
    trunk = df.drop(*ST.GRAFT_FILLS, "dob", "gender", *[c for c in df.columns if c.startswith("sx_")])
    rows = TP.study_timepoints(trunk, _sides(load), filled=grafts.join(cohort, "id", "left_semi"), cohort=cohort)
    return rows.select(
        "id", "timepoint", "completed_base", "completed_proms", "completed_eq5d", "baseline_date", F.col("age").cast("bigint").alias("age"),
        "dob", "gender", "sex", "aclrgraft", "group", *BLOCK, *ITEMS, "pass", "eq5d_vas", "l_hop", "r_hop",
        "aclr_satisfaction1", "aclr_satisfaction2", "bl_aclrdate", "bl_aclrside", "segment", "eq5d_vas_y", "l_aclr_no", "r_aclr_no")


RANK = "CASE timepoint WHEN 'mpre' THEN 1 WHEN 'm0' THEN 2 WHEN 'm2' THEN 3 WHEN 'm4' THEN 4 END"
FILLED = ["sex", "age", "bl_aclrside", '"group"', "baseline_date", "firstphysiosession_date", "dob", "l_aclr_no", "r_aclr_no"]
INJURY = "k % 4 = 3 OR (k < 30 AND k % 3 = 2) OR (k > 50 AND k % 3 > 0)"
POSTCODES = "SELECT id, CAST(3000 + k AS VARCHAR) AS postcode FROM export JOIN sparse USING (id, seq) WHERE address_res IS NOT NULL"
DATABASE = f"""{STUDY},
postcode AS ({POSTCODES}),
injury AS (SELECT id, CASE WHEN {INJURY} THEN 1 ELSE 0 END AS concomitant_inj FROM export JOIN sparse USING (id, seq) WHERE sx_name IS NOT NULL),
numbered AS (SELECT *, {RANK} AS seq, coalesce(completed_base, completed_proms, completed_eq5d) AS completed FROM rows),
participant AS (SELECT * EXCLUDE ({", ".join(FILLED)}), {_fill_sql(dict.fromkeys(FILLED, "downup"))} FROM numbered),
scored AS (SELECT *, {", ".join(f'''{_sub(*[c for c in KOOS if c.rstrip("0123456789") == s])} AS koos_{s}_total''' for s in ["p", "s", "sp", "q", "pf", "a"])}
  FROM participant),
whole AS (SELECT id, CAST(bl_aclrdate AS DATE) AS d, baseline_date AS b FROM scored WHERE timepoint = 'm0' AND bl_aclrdate IS NOT NULL),
years AS (SELECT *, date_diff('year', d, b) - CASE WHEN month(b) * 100 + day(b) < month(d) * 100 + day(d) THEN 1 ELSE 0 END AS y FROM whole),
since AS (SELECT id, max(y + date_diff('day', CAST(d + to_months(CAST(12 * y AS INTEGER)) AS DATE), b)
    / date_diff('day', CAST(d + to_months(CAST(12 * y AS INTEGER)) AS DATE), CAST(d + to_months(CAST(12 * y + 12 AS INTEGER)) AS DATE))::DOUBLE) AS years
  FROM years GROUP BY id)"""


@query(f"""WITH {DATABASE}
SELECT scored.id, sex, gender, age, bl_aclrside AS aclrside, aclrgraft, CASE WHEN bl_aclrside IS NOT NULL THEN l_aclr_no END AS left_aclr_no,
  CASE WHEN bl_aclrside IS NOT NULL THEN r_aclr_no END AS right_aclr_no, concomitant_inj, timepoint, {FROM_START} AS timepoint_actual, baseline_date,
  CAST(CAST(completed AS TIMESTAMP) AS DATE) AS completed, "group", CAST(dob AS DATE) AS dob, postcode, years AS yearssinceaclr,
  bl_birthcountry, CAST(date_diff('day', CAST(bl_rupturedate AS DATE), CAST(bl_aclrdate AS DATE)) AS INTEGER) AS bl_surgicaldelay,
  abs(pfoos_s1 - 4) AS koos_s1, koos_p_total, koos_s_total, koos_pf_total, (koos_p_total + koos_s_total + koos_sp_total + koos_q_total) / 4.0::DOUBLE AS koos_4_total,
  coalesce(bl_pass, pass) AS pass, eq5d_vas AS eq_vas, coalesce(aclr_satisfaction2, aclr_satisfaction1) AS aclr_satisfaction, segment,
  CASE bl_aclrside WHEN 'Left' THEN CAST(l_hop AS VARCHAR) WHEN 'Right' THEN r_hop END AS a_hop,
  CASE bl_aclrside WHEN 'Left' THEN r_hop WHEN 'Right' THEN CAST(l_hop AS VARCHAR) END AS c_hop
FROM scored LEFT JOIN since USING (id) LEFT JOIN postcode USING (id) LEFT JOIN injury USING (id)
WHERE NOT (completed IS NULL AND pfoos_s1 IS NULL)""", name="clean_study")
def _clean(load):
    """Export, dictionary, side tables and addresses to the database table; the dictionary renames the consent tick."""
    dictionary = _dictionary(load, ("consent_tick", "agreed", None))
    history, counts = _sides(load)
    empty = load("events").limit(0)
    tables = clean_study(_export(load), dictionary, history, counts, _addresses(load), empty, empty)
    return tables["database"].select(
        "id", "sex", "gender", F.col("age").cast("bigint").alias("age"), "aclrside", "aclrgraft", "left_aclr_no", "right_aclr_no", "concomitant_inj",
        "timepoint", "timepoint_actual", "baseline_date", "completed", "group", "dob", "postcode", "yearssinceaclr", "bl_birthcountry",
        "bl_surgicaldelay", "koos_s1", "koos_p_total", "koos_s_total", "koos_pf_total", "koos_4_total", "pass", "eq_vas", "aclr_satisfaction",
        "segment", "a_hop", "c_hop")


@query(f"WITH {STUDY} {POSTCODES}")
def postcodes(load):
    """The four digits after the state of each given address."""
    return find_postcodes(_export(load).withColumnRenamed("record_id", "id"), _addresses(load))


def _label(c, labels):
    return f"CASE {c} " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in labels.items()) + f" END AS {c}"


@query(f"""WITH {STUDY}
SELECT id, {_label("sx_primary", V.PRIMARY)}, {_label("sx_side", V.LEFT_RIGHT)}, {_label("sx_graftside", V.GRAFT_SIDE)}, {SX_LABEL} AS sx_graft, sx_name,
  {", ".join(_label(c, V.MENISCUS) for c in ("sx_meniscus_med", "sx_meniscus_lat"))}, {_label("sx_cartilage_int", V.CARTILAGE_INT)},
  {", ".join(_label(c, V.CARTILAGE_GRADE) for c in ("sx_patellacartilage", "sx_femoralcartilage_lat"))},
  CASE WHEN id IN (3, 5, 8, 13) OR {INJURY} THEN 1 ELSE 0 END AS concomitant_inj
FROM export JOIN sparse USING (id, seq) WHERE sx_name IS NOT NULL""")
def surgical_details(load):
    """Labelled surgery records with the flag, which four ids have from notes."""
    df = ST.graft_candidates(_export(load).withColumnRenamed("record_id", "id"))
    return find_surgery(df, flagged_ids=[3, 5, 8, 13])
