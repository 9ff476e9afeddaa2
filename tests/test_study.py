"""The whole cleaning run on the invented export."""

import csv
import datetime as dt

import pytest
import study
from plans import plan
from pyspark.sql import functions as F

from longitab import vocab as V
from longitab.operators import schema as S
from longitab.plans import extract as EX
from longitab.plans import standardise as ST
from longitab.plans.clean import clean_study
from longitab.plans.cohort import consented, keep_consented
from longitab.plans.monitoring import WEEK_16_AS_WRITTEN, monitoring
from longitab.plans.timepoints import assemble
from longitab.sources.bundle import read_bundle, write_bundle
from longitab.sources.delimited import read_export


@pytest.fixture(scope="module")
def export(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("study") / "export.csv"
    with open(path, "w", newline="") as f:
        out = csv.DictWriter(f, list(study.COLUMNS), restval="")
        out.writeheader()
        out.writerows(study.ROWS)
    return read_export(spark, str(path), study.DDL)


@pytest.fixture(scope="module")
def inputs(spark, export):
    return dict(
        export=export,
        dictionary=spark.createDataFrame(study.DICTIONARY, "varname string, newname string, remove string").filter("varname <> 'form_complete'")
        .unionByName(spark.createDataFrame([("sx_name", "sx_name", None)], "varname string, newname string, remove string")),
        history=spark.createDataFrame(study.HISTORY, "id int, bl_medhist_done string, bl_medication_done string"),
        surgery_counts=spark.createDataFrame(study.SURGERY, "id int, l_aclr_no int, r_aclr_no int, aclrside_revision string"),
        addresses=spark.createDataFrame(study.ADDRESSES, "address_res string, address string"),
        adverse_events=spark.createDataFrame([(11, "m4", "a;b")], "id int, timepoint string, adverse_index string"),
        mri=spark.createDataFrame([(11, 1)], "id int, grade int"),
    )


@pytest.fixture(scope="module")
def tables(inputs):
    return clean_study(**inputs, rows_per_block=3)


@pytest.fixture(scope="module")
def main(tables):
    return tables["database"].cache()


@pytest.fixture(scope="module")
def cell(main):
    got = {(r.id, r.timepoint): r.asDict() for r in main.collect()}
    return lambda i, t: got[i, t]


def test_cohort(export):
    assert sorted(r.record_id for r in consented(export).collect()) == [11, 12, 14]


def test_one_row_per_participant_and_timepoint_in_order(main):
    assert [(r.id, r.timepoint) for r in main.select("id", "timepoint").collect()] == [
        (11, "mpre"), (11, "m0"), (11, "m2"), (11, "m4"), (11, "m12"), (12, "mpre"), (12, "m0"), (14, "m8")]


def test_prebaseline_moves_to_baseline(cell):
    assert cell(11, "mpre")["bl_birthcountry"] is None and cell(11, "m0")["bl_birthcountry"] == "Norway"
    assert cell(11, "m0")["pass"] == 1 and cell(12, "m0")["pass"] == 0
    assert cell(12, "m0")["bl_birthcountry"] == "Australia"
    assert cell(11, "m0")["bl_medhist_done"] == "asthma" and cell(11, "m2")["bl_medhist_done"] is None


def test_baseline_dates_and_age(cell):
    assert cell(11, "m0")["baseline_date"] == dt.date(2023, 2, 28) and cell(11, "m0")["age"] == 33
    assert cell(11, "m12")["age"] == 33
    # No baseline answer: no baseline date, but an age at the pre-baseline answer.
    assert cell(12, "m0")["baseline_date"] is None and cell(12, "m0")["age"] == 30
    assert cell(12, "m0")["completed"] == dt.date(2023, 1, 20)
    assert cell(11, "mpre")["completed"] == dt.date(2023, 1, 10)
    # The rupture is dated after the surgery.
    assert cell(11, "m0")["bl_surgicaldelay"] is not None and cell(12, "m0")["bl_surgicaldelay"] == -30


def test_participant_values_fill_all_rows(cell):
    for t in ("mpre", "m0", "m2", "m4", "m12"):
        r = cell(11, t)
        assert (r["sex"], r["gender"], r["group"], r["dominanthand"], r["aclrside_revision"]) == ("Male", "Man", 7, "Right", "Left")
        assert r["aclrgraft"] == "Contralateral Hamstring" and r["postcode"] == "3084" and r["dob"] == dt.date(1990, 2, 28)
        assert r["concomitant_inj"] == 1
    assert cell(12, "mpre")["sex"] == "X" and cell(12, "m0")["gender"] is None and cell(12, "m0")["group"] == 4
    assert cell(12, "m0")["aclrgraft"] == "BPTB" and cell(14, "m8")["aclrgraft"] == "Allograft"


def test_side_falls_back_on_demographics(cell):
    assert cell(11, "m4")["aclrside"] == "Left" and cell(12, "mpre")["aclrside"] == "Right"
    # Surgery counts hang on the recorded side, which 12 does not have.
    assert cell(11, "m0")["left_aclr_no"] == 2 and cell(12, "m0")["right_aclr_no"] is None


def test_affected_and_contralateral(cell):
    m0, m4, m8 = cell(11, "m0"), cell(11, "m4"), cell(14, "m8")
    assert (m0["a_hop_max"], m0["c_hop_max"], m0["a_note"], m0["c_note"]) == ("100", "120.5", "stiff", None)
    assert (m4["a_hop_max"], m4["c_hop_max"], m4["c_note"]) == ("110", None, "ok")
    assert (m8["a_hop_max"], m8["c_hop_max"]) == (None, "5")


def test_scores(cell):
    # p: items 1, 3 flipped to 3, 1; s1: 0 -> 4, s4 keeps 4.
    m0 = cell(11, "m0")
    assert (m0["koos_p_total"], m0["koos_s_total"], m0["koos_sp_total"], m0["koos_q_total"]) == (50.0, 0.0, 50.0, 100.0)
    assert m0["koos_4_total"] == 50.0
    assert cell(11, "m2")["koos_p_total"] is None and cell(11, "m2")["koos_4_total"] is None
    # Before baseline the knee score stands in for the patellofemoral one.
    assert (cell(11, "mpre")["koos_p1"], cell(11, "mpre")["koos_s1"]) == (2, 3)
    assert cell(11, "m2")["eq_mob"] == 1 and cell(11, "m2")["eq_vas"] == 80


def test_supplement_wins_when_earlier(cell):
    m4 = cell(11, "m4")
    assert m4["completed"] == dt.date(2023, 7, 1) and m4["koos_p1"] == 3
    # Columns the supplement never fills stay with the main row.
    assert m4["eq_vas"] == 70 and m4["aclr_satisfaction"] == 2
    # Equal times: the main row stays.
    assert cell(11, "m12")["koos_p1"] == 3


def test_time_from_start(cell):
    assert cell(11, "mpre")["timepoint_actual"] is None and cell(11, "m0")["timepoint_actual"] == 0
    # From the first session, as it is known: 10 March to 1 July 2023.
    assert cell(11, "m4")["timepoint_actual"] == 16.14
    assert cell(11, "m4")["yearssinceaclr"] == pytest.approx(182 / 365)


def test_blinding_and_trimming(main):
    names = main.columns
    for gone in (*V.REVEALING, "blgoals_goals", "y2_hop", "kessler_1", "rubbish", "bl_concurrent", "bl_medicalhx", "address_res",
                 "l_hop_max", "redcap_event_name", "completed_proms", "form_complete", "sex_other"):
        assert gone not in names
    assert names[:4] == ["id", "sex", "gender", "age"] and "group" in names


def test_unblinded(inputs):
    out = clean_study(**inputs, blinded=False)["database"]
    assert {"treatment_satisfaction", "blgoals_goals", "firstphysiosession_date"} <= set(out.columns)
    assert {r.group for r in out.select("group").collect()} == {"Super", "Control", None}


def test_supplement_only_rows_can_be_kept(inputs):
    out = clean_study(**inputs, keep_unmatched=True)["database"]
    assert (14, "m4") in {(r.id, r.timepoint) for r in out.select("id", "timepoint").collect()}


def test_skip_null_scores(inputs):
    out = clean_study(**inputs, skip_null=True)["database"].filter("id = 11 and timepoint = 'm2'").first()
    assert out.koos_p_total == 25.0


def test_monitoring(tables):
    got = {(r.id, r.timepoint): r for r in tables["fortnightly"].collect()}
    assert sorted(got) == [(11, "w16"), (11, "w8"), (12, "w10"), (14, "m8")]
    r = got[11, "w16"]
    assert (r.completed, r.fn_sport_type_1, r.fn_otherprof_gp, r.fn_otherprof_sessions, r.fn_otherprof_otherdetail) == (
        dt.date(2023, 6, 20), "Running", 1, "2", "coach")
    r = got[12, "w10"]
    assert (r.completed, r.fn_sport_type_1, r.fn_otherprof_gp, r.fn_otherprof_sessions) == (dt.date(2023, 4, 1), None, None, None)
    assert "fn_whichotherprof_super___1" not in tables["fortnightly"].columns


def test_week_16_as_written(inputs):
    df = ST.rename_columns(inputs["export"], inputs["dictionary"])
    labels = {r.timepoint for r in monitoring(df, week_16=WEEK_16_AS_WRITTEN).collect()}
    assert "m4" in labels and "w16" not in labels


def test_surgical_details(tables, inputs):
    got = {r.id: r for r in tables["surgical"].collect()}
    assert (got[11].sx_primary, got[11].sx_graftside, got[11].sx_patellacartilage, got[11].sx_femoralcartilage_lat) == (
        "Primary", "Contralateral", "Grade 0", "Grade 1")
    assert got[11].concomitant_inj == 1 and got[14].sx_meniscus_med == "flap" and got[14].concomitant_inj == 1
    assert got[14].sx_graft == "tibialis anterior allograft" and "sx_graft_other" not in tables["surgical"].columns


def test_flag_needs_a_known_finding_or_an_override(spark):
    from longitab.plans.surgery import surgical_details
    ddl = ("id int, sx_name string, sx_meniscus_med int, sx_meniscus_lat int, sx_cartilage_int int, sx_patellacartilage int, "
           "sx_femoralcartilage_lat int")
    df = spark.createDataFrame([(1, "a", 1, 1, 0, 2, None), (2, "a", None, None, None, None, None), (3, "a", 1, 2, 0, 1, 1),
                                (4, "a", 1, 1, 0, 1, 3), (5, None, 2, 2, 0, 3, 3)], ddl)
    flags = lambda **kw: {r.id: r.concomitant_inj for r in surgical_details(df, **kw).collect()}
    assert flags() == {1: 0, 2: 0, 3: 1, 4: 1}
    assert flags(flagged_ids=[2]) == {1: 0, 2: 1, 3: 1, 4: 1}


def test_collapse_does_not_depend_on_partitions(inputs, rows):
    df = ST.rename_columns(keep_consented(inputs["export"]), inputs["dictionary"]).select(
        "id", "seq", "redcap_event_name", "completed_proms", "pfoos_p1", "l_hop_max")
    one, many = assemble(df.repartition(1)), assemble(df.repartition(9))
    assert rows(one) == rows(many)
    assert one.groupBy("id", "timepoint").count().filter("count > 1").count() == 0


def test_shuffles_of_the_main_table(spark, inputs):
    """The export is shuffled once collapsed; then the id's partitioning serves all."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(clean_study(**inputs)["database"])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    exchanges = [line for line in text.splitlines() if "Exchange " in line]
    # Texts, numbers and filled columns collapse apart, numbers by hash.
    assert sum("slot#" in e for e in exchanges) == 3 and sum("REPARTITION_BY_COL" in e for e in exchanges) == 1
    # Besides: two side tables, addresses, postcodes, surgery, and the final sort.
    assert len(exchanges) == 3 + 1 + 2 + 3 + 1 + 1 and sum("rangepartitioning" in e for e in exchanges) == 1
    assert "+- HashAggregate(keys=[id" in text and "+- SortAggregate(key=[id" in text
    assert "partial_min_by" in text and "CartesianProduct" not in text and "NestedLoop" not in text


def test_export_bundle(spark, tables, tmp_path):
    folder = str(tmp_path / "out")
    assert write_bundle(tables, folder) == ["database", "fortnightly", "surgical", "adverse_events", "mri"]
    back = read_bundle(spark, folder, "database", schema=tables["database"].schema)
    key = lambda r: (r.id, V.TIMEPOINTS.index(r.timepoint))
    assert sorted(back.collect(), key=key) == sorted(tables["database"].collect(), key=key)


def test_contralateral_of_unknown_kind(spark):
    df = spark.createDataFrame([(1, 1, None, None, 2, 1), (1, 2, None, None, None, None)],
                               "id int, seq bigint, sx_graft int, sx_graft_other string, sx_graftside int, bl_grafttype int")
    assert {r.aclrgraft for r in ST.resolve_graft(df).collect()} == {"Hamstring"}
    assert {r.aclrgraft for r in ST.resolve_graft(df, null_text="NA").collect()} == {"Contralateral NA"}


# -- extract ---------------------------------------------------------------

@pytest.fixture(scope="module")
def catalogue(spark):
    return spark.createDataFrame(
        [("koos_p1", "koos"), ("koos_p_total", "koos"), ("eq5d_vas", "eq5d"), ("eq_vas", "eq"), ("treatment_satisfaction", "goals"),
         ("blgoals_goals", "goals")], "varname string, namegroup string")


def test_extract_long(main, catalogue):
    out = EX.extract(main, catalogue, ["m0", "m4"], ["koos", "eq5d"])
    assert out.columns == [*S.present(main, V.EXTRACT_ALWAYS), "koos_p1", "koos_p_total"]
    assert out.count() == 3
    assert EX.unknown_names(main, catalogue, ["koos", "eq5d"]) == ["eq5d_vas"]


def test_extract_wide(main, catalogue):
    out = EX.extract(main, catalogue, ["m0", "m4"], ["koos"], shape="wide")
    r = {x.id: x.asDict() for x in out.collect()}
    assert r[11]["m0_koos_p_total"] == "50" and r[11]["m4_completed"] == "2023-07-01" and r[12]["m4_koos_p1"] is None
    assert not [c for c in out.columns if "blgoals" in c or c == "timepoint"]
    one = EX.extract(main, catalogue, ["m0"], [], shape="wide")
    assert all(c in V.EXTRACT_IDS or c.startswith("m0_") for c in one.columns)


def test_no_revealing_name_survives_blinding(inputs, catalogue):
    open_table = clean_study(**inputs, blinded=False)["database"].withColumn("group", F.lit(4))
    out = EX.extract(open_table, catalogue, ["m0"], ["goals"])
    assert not [c for c in out.columns if c in V.REVEALING or "blgoals" in c]
    shown = EX.extract(open_table, catalogue, ["m0"], ["goals"], blinded=False)
    assert "blgoals_goals" in shown.columns and {r.group for r in shown.collect()} == {"Control"}


def test_write_extract(spark, main, tables, tmp_path):
    args = (main.select("id"), tables["fortnightly"], tables["surgical"])
    assert EX.write_extract(*args, str(tmp_path / "a"), groups=["koos"], extra=["sx"], missing="blank") == ["data", "surgical"]
    assert EX.write_extract(*args, str(tmp_path / "b"), extra=["fn"]) == ["fortnightly"]
    assert EX.write_extract(*args, str(tmp_path / "c")) == []
