"""Fixed values of the study's data convention.

All values below are fixed: they are the codes, labels, event names and
column names that the data carry or that results must show.  Functions take
them as default arguments, so another study passes its own.
"""

# Ordered timepoints.
TIMEPOINTS = ["mpre", "m0", "m2", "m4", "m8", "m12"]

# Collection events of each timepoint.
EVENTS = {
    "mpre": ["online_consent_and_arm_1", "participant_regist_arm_1"],
    "m0": [
        "prebaseline_questi_arm_1", "baseline_questionn_arm_1", "baseline_testing_arm_1",
        "randomisation_arm_1", "baseline_postrando_arm_1",
    ],
    "m2": ["8_week_questionnai_arm_1"],
    "m4": ["pre4_month_questio_arm_1", "4_month_questionna_arm_1", "4_month_testing_arm_1"],
    "m8": ["8_month_questionna_arm_1"],
    "m12": ["pre12_month_questi_arm_1", "12_month_questionn_arm_1", "12_month_testing_arm_1"],
}
# Events that supplement a timepoint with separately collected answers.
SUPPLEMENTS = {"m4": ["covid_interum_4_mo_arm_1"], "m12": ["12_month_key_proms_arm_1"]}

# Export names -> working names.
EXPORT_NAMES = {
    "demographic_questionnaire_timestamp": "completed_base",
    "physical_testing_anthropometrics_timestamp": "completed_lab",
    "pfoos_timestamp": "completed_proms",
    "eq5d_timestamp": "completed_eq5d",
    "fortnightly_activity_monitoring_timestamp": "fn_completed",
    "monthly_activity_monitoring_timestamp": "mth_completed",
    "record_id": "id",
}
NOT_COMPLETED = "[not completed]"

# Code -> label.
GROUP = {0: 7, 1: 4}
ARM_LABELS = {4: "Control", 7: "Super"}
SEX = {1: "Male", 2: "Female"}
SEX_OTHER = 3
GENDER = {0: "Man", 1: "Woman", 2: "Other", 3: "Prefer not to say"}
BIRTH_COUNTRY = {1: "Australia"}
BIRTH_COUNTRY_OTHER = 2
RIGHT_LEFT = {1: "Right", 2: "Left"}
LEFT_RIGHT = {1: "Left", 2: "Right"}
HAND = {0: "Left", 1: "Right"}
GRAFT_REPORTED = {
    1: "Hamstring", 2: "Quadriceps", 3: "BPTB", 4: "Allograft", 5: "Other", 6: "Unknown",
}
GRAFT_RECALLED = {1: "Hamstring", 2: "BPTB", 3: "Quadriceps", 4: "Other"}
GRAFT_SAME = {"tibialis anterior allograft": "Allograft"}
GRAFT_CONTRALATERAL = 2
PRIMARY = {1: "Primary", 2: "Revision", 3: "Unknown"}
GRAFT_SIDE = {1: "Ipsilateral", 2: "Contralateral", 3: "Allograft (n/a)", 4: "Unknown"}
MENISCUS = {1: "None reported", 2: "Meniscectomy", 3: "Repair", 4: "Tear untreated", 5: "Other"}
CARTILAGE_INT = {
    0: "None reported", 1: "Autologous Cartilage Implantation", 2: "Micro-fracture surgery",
    3: "Cartilage debridgement", 4: "Other",
}
CARTILAGE_GRADE = {1: "Not reported", 2: "Grade 0", 3: "Grade 1", 4: "Grade 2", 5: "Grade 3"}
NONE_REPORTED = "None reported"
SPORT = {
    1: "Soccer", 2: "Australian Rules Football", 3: "Basketball", 4: "Netball",
    5: "Tennis/Squash", 6: "Cricket", 7: "Hockey", 8: "Volleyball", 9: "Martial arts",
    10: "Alpine skiing/snowboarding", 11: "Dancing/aerobics/gymnastics/ballet", 12: "Golf",
    13: "Running", 14: "Swimming", 15: "Cycling", 16: "Surfing", 17: "Other",
}
# Checkbox number k = 1..9 -> suffix of the merged column.
PROFESSIONS = [
    "gp", "physio", "chiro", "osteoeo", "massage", "naturopath", "sportsdoc", "orthopod", "other",
]
ARMS = ("super", "control")

# Columns dropped once the value they lead to exists.
GRAFT_INPUTS = [
    "bl_grafttype", "bl_graftother", "bl_graftwhichknee", "bl_graftwherefrom", "bl_aclsurgeon",
    "bl_aclhospital", "bl_aclrnumber", "bl_aclrhistory",
]
HISTORY_INPUTS = [
    "bl_otherkneeinj", "bl_otherkneeinjdet", "bl_medicationyn", "bl_medicationdetails",
    "bl_medicalhx", "bl_otherkneeinjdetails", "bl_otherinj", "bl_otherinjdetails",
    "bl_otherpainconditions_none", "bl_aclcontralatknee", "bl_otherkneeinj_withresearcher",
    "bl_otherpainconditions_otherdetails",
]
INJURY_INPUTS = ["bl_concurrent", "bl_concurrentdetails"]

# Questionnaire block collected before baseline: first and last column.
PREBASELINE_BLOCK = ("bl_birthcountry", "bl_pass")

# Columns that hold one value per participant.
PARTICIPANT_COLUMNS = [
    "sex", "age", "bl_dominantleg", "bl_aclrside", "bl_aclrside_demographic", "group",
    "baseline_date", "firstphysiosession_date", "dob", "dominanthand", "l_aclr_no", "r_aclr_no",
    "aclrside_revision",
]

# Subscale -> pattern of its items.
SUBSCALES = {
    "koos_p_total": r"koos\_p\d+", "koos_s_total": r"koos\_s\d+", "koos_a_total": r"koos\_a\d+",
    "koos_sp_total": r"koos\_sp\d+", "koos_q_total": r"koos\_q\d+",
    "koos_pf_total": r"koos\_pf\d+",
}
KOOS4 = ["koos_p_total", "koos_s_total", "koos_sp_total", "koos_q_total"]
ACLQOL_ITEMS = r"aclqol\_\d+"
KOOS_FORWARD = ["koos_s4", "koos_s5"]
EQ5D_NAMES = {
    "eq5d_mobility": "eq_mob", "eq5d_selfcare": "eq_care", "eq5d_adl": "eq_act",
    "eq5d_pain": "eq_pain", "eq5d_anxdep": "eq_dep", "eq5d_vas": "eq_vas",
}
EQ5D_SHIFTED = ["eq5d_mobility", "eq5d_selfcare", "eq5d_adl", "eq5d_pain", "eq5d_anxdep"]

# Columns (or parts of names) that reveal the allocation.
REVEALING = [
    "firstphysiosession_date", "expect_tegner_4m", "expect_pain_4m", "expect_qol_4m",
    "adherence_selfrated", "treatment_satisfaction",
]
REVEALING_PARTS = ["blgoals"]

# Column order of the longitudinal table.
FRONT = [
    "id", "sex", "gender", "age", "dominantleg", "dominanthand", "aclrside", "aclrgraft",
    "aclrside_revision", "left_aclr_no", "right_aclr_no", "concomitant_inj", "timepoint",
    "timepoint_actual", "baseline_date", "firstphysiosession_date", "completed", "mridate",
    "group", "dob", "postcode", "yearssinceaclr",
]
FRONT_BASELINE = ("bl_birthcountry", "bl_rupturedate")
FRONT_NEXT = ["bl_surgicaldelay", "bl_rupturesport", "bl_familyhxoadetails"]
FRONT_PREFIXES = [
    "bl_", "koos_", "aclqol", "tsk", "nprs", "pass", "groc", "hlq", "wlq", "eq_",
]
LATER_PREFIXES = ["y2_", "kessler"]

# Self-service extract: columns that always go out, and those that identify
# a participant in the wide shape.
EXTRACT_ALWAYS = [
    "id", "sex", "gender", "age", "dominantleg", "dominanthand", "aclrside", "aclrgraft",
    "aclrside_revision", "left_aclr_no", "right_aclr_no", "timepoint", "timepoint_actual",
    "baseline_date", "completed", "mridate", "group", "dob", "postcode", "yearssinceaclr",
]
EXTRACT_IDS = [
    "id", "sex", "gender", "age", "dominantleg", "dominanthand", "aclrside", "group", "dob",
    "postcode",
]

# Adverse events: the list columns, and the grid of the report.
EVENT_COLUMNS = [
    "adverse_index", "adverse_other", "serious_knee", "serious_other", "medication",
    "cointervention",
]
EVENT_TIMEPOINTS = ["m4", "m12"]
EVENT_ARMS = [4, 7]

# Free-text history.
HISTORY_TOKENS = 8
BODY_REGIONS = (
    "ankle|foot|knee|hip|back|collarbone|shoulder|wrist|arm|shoulder|lisfranc|ischium|femur|"
    "hamstring|syndesmosis|tibia|achilles|groin|quadriceps|humerus"
)
LATERALITY = "index|contralateral|contra"
GRAFT_SURGERY = "aclr"
ANY_SURGERY = "aclr|bone graft|arthroscope|mua|wash out"

# Adherence.
EXPECTED_RESPONSES = 7
EXERCISES = ["quad", "hami", "plyo", "balance", "core", "gluthip", "calf"]
