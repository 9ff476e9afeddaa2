import pytest
from pyspark.sql import functions as F

from longitab.operators import schema as S


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame([(1, 2, 3, 4, 5)], "ID int, koos_p1 int, KOOS_p2 int, pfoos_a int, note int")


def test_finding_names_ignores_case(frame):
    assert S.starting(frame, "koos") == ["koos_p1", "KOOS_p2"]
    assert S.matching(frame, r"KOOS\_p\d+") == ["koos_p1", "KOOS_p2"]
    assert S.containing(frame, "FOO") == ["pfoos_a"]
    assert S.between(frame, "koos_p1", "pfoos_a") == ["koos_p1", "KOOS_p2", "pfoos_a"]
    assert S.present(frame, ["note", "gone", "ID", "note"]) == ["note", "ID"]
    assert S.unknown(frame, ["note", "gone"]) == ["gone"]


def test_rename_from_dictionary_checks(spark, frame):
    table = lambda *p: spark.createDataFrame(list(p), "varname string, newname string")
    assert S.rename_from(frame, table(("ID", "record"), ("note", "text"))).columns[0] == "record"
    with pytest.raises(ValueError, match="absent"):
        S.rename_from(frame, table(("gone", "x")))
    assert S.rename_from(frame, table(("gone", "x")), strict=False).columns == frame.columns
    with pytest.raises(ValueError, match="duplicate"):
        S.rename_from(frame, table(("ID", "note")))


def test_swapping_names_is_possible(frame):
    out = S.rename(frame, {"koos_p1": "note", "note": "koos_p1"})
    assert out.first().asDict()["note"] == 2


def test_dictionary_has_to_be_schema_sized(spark):
    big = spark.range(S.MAX_SCHEMA_ROWS + 1).select(F.col("id").cast("string").alias("varname"), F.lit("x").alias("newname"))
    with pytest.raises(ValueError, match="schema-sized"):
        S.pairs_of(big, "varname", "newname")


def test_drop_from_dictionary_tolerates_absent(spark, frame):
    table = spark.createDataFrame([("note", "remove"), ("gone", "remove"), ("ID", None)], "newname string, remove string")
    assert "note" not in S.drop_from(frame, table).columns and "ID" in S.drop_from(frame, table).columns


def test_catalogue_duplicates_and_stale_names(spark, frame):
    table = spark.createDataFrame([("note", "a"), ("note", "b"), ("stale", "a"), ("koos_p1", "b")], "varname string, namegroup string")
    assert S.catalogue_names(table, ["a", "b"]) == ["note", "stale", "koos_p1"]
    assert S.select_catalogued(frame, table, ["a", "b"], ["ID"]).columns == ["ID", "note", "koos_p1"]
    assert S.select_catalogued(frame, table, [], ["ID"]).columns == ["ID"]


def test_reorder(frame):
    assert S.reorder(frame, ["note", "gone"], ["pf", "koos"]).columns == ["note", "pfoos_a", "koos_p1", "KOOS_p2", "ID"]


def test_drop_null_columns(spark):
    df = spark.createDataFrame([(1, None, None), (2, None, 3)], "a int, b string, `c.d` int")
    assert S.drop_null_columns(df).columns == ["a", "c.d"]


def test_blinding(spark):
    df = spark.createDataFrame([(4, 1, 2, 3), (7, 1, 2, 3), (9, 1, 2, 3)], "group int, blgoals_goals int, x_BLGOALS int, session int")
    hidden = S.blind(df, ["session", "gone"], ["blgoals"])
    assert hidden.columns == ["group"]
    shown = S.blind(df, ["session"], ["blgoals"], blinded=False, labels={4: "Control", 7: "Super"})
    assert [r.group for r in shown.collect()] == ["Control", "Super", None] and len(shown.columns) == 4
