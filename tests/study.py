"""An invented study export with the awkward cases, as rows of dicts."""

from __future__ import annotations

COLUMNS = {
    "record_id": "INT", "redcap_event_name": "STRING", "consent_tick": "INT",
    "demographic_questionnaire_timestamp": "STRING", "physical_testing_anthropometrics_timestamp": "STRING",
    "pfoos_timestamp": "STRING", "eq5d_timestamp": "STRING",
    "fortnightly_activity_monitoring_timestamp": "STRING", "monthly_activity_monitoring_timestamp": "STRING",
    "redcap_survey_identifier": "STRING", "alloc": "INT", "sex": "INT", "sex_other": "STRING", "gender": "INT", "dob": "STRING",
    "address_res": "STRING", "dominanthand": "INT", "bl_dominantleg": "INT", "bl_aclrside": "INT", "bl_aclrside_demographic": "INT",
    "bl_birthcountry": "INT", "bl_birthcountrytext": "STRING", "bl_rupturedate": "STRING", "bl_pass": "INT",
    "bl_aclrdate": "STRING", "bl_grafttype": "INT", "bl_concurrent": "INT", "bl_medicalhx": "STRING",
    "pass": "INT", "aclr_satisfaction1": "INT", "aclr_satisfaction2": "INT",
    "sx_name": "STRING", "sx_graft": "INT", "sx_graft_other": "STRING", "sx_graftside": "INT", "sx_primary": "INT", "sx_side": "INT",
    "sx_meniscus_med": "INT", "sx_meniscus_med_other": "STRING", "sx_meniscus_lat": "INT", "sx_meniscus_lat_other": "STRING",
    "sx_cartilage_int": "INT", "sx_cartilage_int_other": "STRING",
    "sx_patellacartilage": "INT", "sx_trochleacartilage": "INT", "sx_tibialcartilage_med": "INT",
    "sx_tibialcartilage_lat": "INT", "sx_femoralcartilage_med": "INT", "sx_femoralcartilage_lat": "INT",
    "koos_p1": "INT", "koos_s1": "INT", "pfoos_p1": "INT", "pfoos_p2": "INT", "pfoos_s1": "INT", "pfoos_s4": "INT",
    "pfoos_sp1": "INT", "pfoos_q1": "INT", "aclqol_1a": "INT", "aclqol_2": "INT", "aclqol_work": "INT",
    "eq5d_mobility": "INT", "eq5d_vas": "INT", "l_hop_max": "DOUBLE", "r_hop_max": "DOUBLE", "l_note": "STRING", "r_note": "STRING",
    "firstphysiosession_date": "STRING", "mridate": "STRING", "blgoals_goals": "STRING", "treatment_satisfaction": "INT",
    "y2_hop": "INT", "kessler_1": "INT", "junk": "STRING", "form_complete": "INT",
    "fn_sport_type_1": "INT", "fn_whichotherprof_super___1": "INT", "fn_whichotherprof_control___1": "INT",
    "fn_whichotherprof_other": "STRING", "fn_otherprofsessions_super": "STRING", "fn_otherprofsessions_control": "STRING",
}
DDL = ", ".join(f"{c} {t}" for c, t in COLUMNS.items())
DICTIONARY = [("alloc", "group", None), ("junk", "rubbish", "remove"), ("form_complete", "absent_now", "remove")]

PRE, PRE2 = "online_consent_and_arm_1", "participant_regist_arm_1"
BASE, LAB = "baseline_questionn_arm_1", "baseline_testing_arm_1"
M2, M4, M4LAB, M4X = "8_week_questionnai_arm_1", "4_month_questionna_arm_1", "4_month_testing_arm_1", "covid_interum_4_mo_arm_1"
M8, M12, M12X = "8_month_questionna_arm_1", "12_month_questionn_arm_1", "12_month_key_proms_arm_1"
PRE4 = "pre4_month_questio_arm_1"

ITEMS = dict(pfoos_p1=1, pfoos_p2=3, pfoos_s1=0, pfoos_s4=4, pfoos_sp1=2, pfoos_q1=4)


def row(record_id, event, **values):
    return {"record_id": record_id, "redcap_event_name": event, **values}


ROWS = [
    # 11: everything; consent on a later row; graft contralateral; affected side left.
    row(11, PRE, demographic_questionnaire_timestamp="2023-01-10 09:00:00", sex=1, gender=0, dob="1990-02-28",
        bl_birthcountry=2, bl_birthcountrytext="Norway", bl_rupturedate="2022-06-01", bl_pass=1, koos_p1=2, koos_s1=1),
    row(11, PRE2, consent_tick=1, address_res="1 Some St"),
    row(11, BASE, pfoos_timestamp="2023-02-28 10:00:00", alloc=0, bl_aclrside=1, bl_dominantleg=1, dominanthand=1,
        bl_aclrdate="2022-08-30", bl_concurrent=1, bl_medicalhx="x", **ITEMS),
    row(11, LAB, physical_testing_anthropometrics_timestamp="[not completed]", pfoos_timestamp="2023-03-15 10:00:00",
        l_hop_max=100.0, r_hop_max=120.5, l_note="stiff", mridate="2023-03-01", y2_hop=1, kessler_1=1, junk="j", form_complete=2),
    row(11, LAB, sx_name="Dr A", sx_graft=1, sx_graftside=2, sx_primary=1, sx_side=1, sx_meniscus_med=1, sx_meniscus_lat=1,
        sx_cartilage_int=0, sx_patellacartilage=2, sx_trochleacartilage=1, sx_femoralcartilage_lat=3),
    row(11, M2, eq5d_timestamp="2023-05-01 08:00:00", firstphysiosession_date="2023-03-10", aclr_satisfaction1=3,
        eq5d_mobility=0, eq5d_vas=80, **{**ITEMS, "pfoos_p2": None}),
    row(11, PRE4, fortnightly_activity_monitoring_timestamp="2023-06-20 08:00:00", fn_sport_type_1=13,
        fn_whichotherprof_super___1=1, fn_whichotherprof_control___1=0, fn_otherprofsessions_super="2", fn_whichotherprof_other="coach"),
    # Main four-month row first answered late; the supplement came earlier and wins.
    row(11, M4, pfoos_timestamp="2023-07-20 08:00:00", eq5d_vas=70, aclr_satisfaction1=1, **{**ITEMS, "pfoos_p1": 4}),
    row(11, M4LAB, l_hop_max=110.0, r_hop_max=None, r_note="ok", treatment_satisfaction=5),
    row(11, M4X, pfoos_timestamp="2023-07-01 08:00:00", aclr_satisfaction2=2, koos_p1=4, **ITEMS),
    row(11, M12, pfoos_timestamp="2024-03-01 08:00:00", **ITEMS),
    row(11, M12X, pfoos_timestamp="2024-03-01 08:00:00", pfoos_p1=4),
    # 12: no graft report, so recall counts; no baseline answer, so the pre-baseline date does; side from demographics.
    row(12, PRE, consent_tick=1, demographic_questionnaire_timestamp="2023-01-20 09:00:00", sex=3, sex_other="X", gender=9,
        dob="1992-02-29", bl_birthcountry=1, bl_rupturedate="2022-12-01", bl_pass=0),
    row(12, BASE, alloc=1, bl_grafttype=2, bl_aclrside_demographic=2, bl_aclrdate="2022-11-01", blgoals_goals="g"),
    row(12, "10_week_fortnightl_arm_1", fn_sport_type_1=99, monthly_activity_monitoring_timestamp="2023-04-01 08:00:00",
        fn_otherprofsessions_super="1", fn_otherprofsessions_control="2"),
    # 13: no consent.
    row(13, PRE, consent_tick=0, demographic_questionnaire_timestamp="2023-01-10 09:00:00"),
    row(13, BASE, pfoos_timestamp="2023-02-28 10:00:00", **ITEMS),
    # 13 also has the only supplement with a value for eq5d_vas: it must not count.
    row(13, M4X, pfoos_timestamp="2023-07-01 08:00:00", eq5d_vas=5),
    # 14: consented but baseline not completed; one month-8 row; a supplement without a main row.
    row(14, PRE, consent_tick=1, gender=1),
    row(14, BASE, pfoos_timestamp="[not completed]"),
    row(14, M8, pfoos_timestamp="2023-10-01 08:00:00", bl_aclrside=2, l_hop_max=5.0, **ITEMS),
    row(14, M4X, pfoos_timestamp="2023-07-01 08:00:00", **ITEMS),
    row(14, M8, sx_name="Dr B", sx_graft=5, sx_graft_other="tibialis anterior allograft", sx_graftside=1, sx_meniscus_med=5,
        sx_meniscus_med_other="flap", sx_meniscus_lat=1, sx_cartilage_int=0),
]

HISTORY = [(11, "asthma", "none"), (99, "x", "y")]
SURGERY = [(11, 2, 0, "Left"), (12, 0, 1, "Right")]
ADDRESSES = [("1 Some St", "1 Some St, Town VIC 3084, Country")]
