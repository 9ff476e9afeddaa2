"""Incidence tables, histories, adherence, areas."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from longitab.operators.spatial import assign_areas
from longitab.plans import adherence as AD
from longitab.plans import areas as AR
from longitab.plans import events as EV
from longitab.plans import history as H

AE = [
    (1, "m4", "pain;swelling;", None), (1, "m12", " pain ", "flu"), (2, "m4", "pain;pain", None),
    (3, "m4", None, "flu; cold"), (3, "m2", "pain", None), (9, "m4", "ghost", None), (4, "m12", " ; ", None),
]


@pytest.fixture(scope="module")
def report(spark):
    main = spark.createDataFrame(
        [(1, "m0", 4), (1, "m4", 4), (2, "m0", 7), (3, "m0", 4), (4, "m0", 7), (5, "m0", 7), (3001, "m0", 4)],
        "id int, timepoint string, group int")
    events = spark.createDataFrame(AE + [(3001, "m4", "test", None)], "id int, timepoint string, adverse_index string, adverse_other string")
    return EV.incidence_report(EV.participants(main), events, ["adverse_index", "adverse_other"])


def test_incidence_tables(report):
    table = [tuple(r) for r in EV.incidence_table(report, "adverse_index").collect()]
    assert EV.incidence_table(report, "adverse_index").columns == ["f", "m4_4", "m4_7", "m12_4", "m12_7", "elsewhere"]
    assert table == [("pain", 1, 2, 1, 0, 1), ("swelling", 1, 0, 0, 0, 0), ("Total", 2, 2, 1, 0, 1), ("Total n", 1, 1, 1, 0, 1)]
    other = [tuple(r) for r in EV.incidence_table(report, "adverse_other").collect()]
    assert other == [("cold", 1, 0, 0, 0, 0), ("flu", 1, 0, 1, 0, 0), ("Total", 2, 0, 1, 0, 0), ("Total n", 1, 0, 1, 0, 0)]


def test_totals_are_sums_and_people_fit(report):
    rows = report.collect()
    for section in {r.section for r in rows}:
        for cell in ("m4_4", "m4_7", "m12_4", "m12_7"):
            part = {k: [r[cell] for r in rows if r.section == section and r.row_order == k] for k in (0, 1, 2)}
            assert part[1] == [sum(part[0])] and part[2][0] <= 4


def test_incidence_as_written(spark):
    """Untrimmed tokens and empty ones count."""
    people = spark.createDataFrame([(1, 4)], "id int, group int")
    events = spark.createDataFrame([(1, "m4", "a; a;")], "id int, timepoint string, x string")
    out = EV.incidence_report(people, events, ["x"], trim=False, drop_empty=False)
    assert sorted(r.f for r in out.filter("row_order = 0").collect()) == ["", " a", "a"]


TEXTS = [(1, "knee 2010, index knee; contra hip;ankle", "a"), (2, "Knee;\tknee\n;asthma", None), (3, None, "b"),
         (4, ";".join(f"t{c}" for c in "abcdefghij"), "")]


@pytest.fixture(scope="module")
def histories(spark):
    return spark.createDataFrame(TEXTS, "id int, text string, other string")


def test_first_eight_tokens(histories):
    assert H.history_tokens(histories, "text").filter("id = 4").count() == 10  # all entries unless told otherwise
    tokens = H.history_tokens(histories, "text", n=8)
    assert tokens.filter("id = 4").count() == 8 and tokens.filter("id = 3").count() == 0
    freq = [tuple(r) for r in H.token_frequency(tokens).limit(2).collect()]
    assert freq == [("knee", 2), ("Knee", 1)]


def test_body_regions(histories, rows):
    got = rows(H.body_region_tokens(H.history_tokens(histories, "text"), order=["pos"]), "id", "token")
    assert got == [(1, "ankle"), (1, "hip"), (1, "knee"), (2, "knee")]


def test_surgery_profile(spark, rows):
    df = spark.createDataFrame(
        [(1, "index aclr (in 2019); contra aclr, index aclr;"), (2, "arthroscope 2"), (3, "nothing"), (4, None)], "id int, s string")
    tokens = H.history_tokens(df, "s", notes=True, closing=True)
    out = H.surgery_profile(df, tokens)
    assert out.columns == ["id", "n_surgery", "n_indexsurgery", "n_contrasurgery", "contra aclr", "index aclr"]
    assert rows(out) == [(1, 3, 2, 1, 1, 2), (2, 1, 0, 0, None, None), (3, None, None, None, None, None),
                         (4, None, None, None, None, None)]
    assert [tuple(r) for r in H.patients_per_token(tokens).collect()] == [
        ("arthroscope", 1), ("contra aclr", 1), ("index aclr", 1), ("nothing", 1)]


def test_adherence(spark):
    exercises = {f"fn_exercises_{e}": 1 for e in ("quad", "hami", "plyo", "balance", "core", "gluthip", "calf")}
    names = ["id", "completed", "fn_physioattendance_super", "fn_strengthsessions_super", "fn_strengthsessions_control",
             "fn_strengthsessionsfreq_control", "fn_sessionlength", "fn_rpe", *exercises]
    ddl = "id string, completed date, " + ", ".join(
        f"{n} {'double' if n in ('fn_strengthsessionsfreq_control', 'fn_sessionlength', 'fn_rpe') else 'int'}" for n in names[2:])
    day = dt.date(2024, 1, 1)
    weekly = spark.createDataFrame([
        ("P_1", day, 1, 2, None, None, 30.0, None, *exercises.values()),
        ("P_1", None, 2, None, None, None, 45.0, None, None, *list(exercises.values())[1:]),
        ("P_2", day, None, None, 0, None, None, 5.0, *exercises.values()),
        ("P_2", day, None, None, 3, 2.0, None, 6.0, *exercises.values()),
    ], ddl)
    visits = spark.createDataFrame([(1, "m4", 1.0, 2.0, 3.0, None, 40.0, 6.0), (1, "m0", 9.0, 9.0, 9.0, 9.0, 9.0, 9.0),
                                    (3, "m4", 1.0, None, 3.0, 1.0, 40.0, 6.0)],
                                   "id int, timepoint string, m4_strength_physio1to1 double, m4_strength_physiogroup double, "
                                   "m4_strength_home double, m4_strength_gym double, m4_sessionlength double, m4_rpe double")
    out = AD.adherence(weekly, visits, id_prefix="P_")
    got = {r.id: r for r in out.collect()}
    assert sorted(got) == ["P_1", "P_2", "P_3"] and out.columns[:3] == ["id", "responses", "perc_complete"]
    one, two, three = got["P_1"], got["P_2"], got["P_3"]
    assert (one.responses, one.perc_complete, one.quad_perc) == (2, 28.57, 28.57)
    assert (one.sum_physioattendance_super, one.sum_strengthattendance_super, one.mean_strengthattendance_super) == (3.0, None, 1.0)
    assert (one.mean_rpe, one.m4_physio_mean, one.m4_strength_mean) == (None, 3.0, None)
    # No sessions: the missing frequency counts as 0.
    assert (two.sum_strengthattendance_control, two.mean_strengthattendance_control, two.mean_rpe) == (2.0, 0.5, 5.5)
    assert (three.responses, three.m4_physio_mean, three.m4_strength_mean) == (None, None, 4.0)
    assert {r.id: r.quad_perc for r in AD.reported(weekly, count_answers=True).collect()}["P_1"] == 14.29
    pairs = {r.id: (r.reported, r.assessed) for r in AD.strength_pairs(out).collect()}
    assert pairs == {"P_1": (1, None), "P_2": (1, None), "P_3": (None, 4.0)}


RING = "array<struct<x:double,y:double>>"
SQUARE = lambda x, y, s: [(x, y), (x + s, y), (x + s, y + s), (x, y + s)]


@pytest.fixture(scope="module")
def areas(spark):
    return spark.createDataFrame([
        ("20", "B", SQUARE(0.0, 0.0, 1.0)), ("21", "B", SQUARE(1.0, 0.0, 1.0)), ("22", "C", SQUARE(-5.0, -5.0, 4.0)),
        # A large triangle and a hollow shape around nothing.
        ("30", "D", [(10.0, 0.0), (200.0, 0.0), (10.0, 100.0)]),
        ("31", "D", [(0.0, 10.0), (3.0, 10.0), (3.0, 13.0), (2.0, 13.0), (2.0, 11.0), (1.0, 11.0), (1.0, 13.0), (0.0, 13.0)]),
    ], f"SA1 string, SA2 string, ring {RING}")


def test_points(spark, areas):
    points = spark.createDataFrame([
        (1, 0.5, 0.5), (2, 1.0, 0.5), (3, -2.0, -2.0), (4, 9.0, 9.0), (5, None, 1.0), (6, 50.0, 50.0), (7, 150.0, 90.0),
        (8, 1.5, 12.0), (9, 0.5, 12.0), (10, 2.0, 0.0), (11, -5.0, -5.0)], "id int, x double, y double")
    got = {r.id: r.SA1 for r in assign_areas(points, areas, "id", "x", "y", "SA1").collect()}
    assert got == {1: "20", 2: "20", 3: "22", 6: "30", 9: "31", 10: "21", 11: "22"}


def test_points_equal_brute_force(spark, areas):
    """All points on a grid against every area, without the grid join."""
    points = spark.range(0, 4000).select(
        "id", (F.pmod(F.col("id"), F.lit(80)) / 5 - 6).alias("x"), (F.floor(F.col("id") / 80) / 2 - 6).alias("y"))
    got = {r.id: r.SA1 for r in assign_areas(points, areas, "id", "x", "y", "SA1").collect()}

    def holds(ring, x, y):
        hit = False
        for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1]):
            if (bx - ax) * (y - ay) == (by - ay) * (x - ax) and min(ax, bx) <= x <= max(ax, bx) and min(ay, by) <= y <= max(ay, by):
                return True
            if (ay > y) != (by > y) and x < ax + (y - ay) * (bx - ax) / (by - ay):
                hit = not hit
        return hit

    rings = [(r.SA1, [(p.x, p.y) for p in r.ring]) for r in areas.collect()]
    want = {}
    for p in points.collect():
        codes = [c for c, ring in rings if holds(ring, p.x, p.y)]
        if codes:
            want[p.id] = min(codes)
    assert got == want and len(want) > 100


def test_holes_parts_and_mixed_sizes(spark):
    """Areas of sizes from 0.01 to 1000 with holes and several parts, against a plain count of crossings."""
    import random
    rnd = random.Random(4)
    areas = []
    for i in range(120):
        cx, cy, r = rnd.uniform(-40, 40), rnd.uniform(-40, 40), 10 ** rnd.uniform(-2, 1.2) if i else 1000
        box = lambda k, dx=0.0: [(cx + dx - r * k, cy - r * k), (cx + dx + r * k, cy - r * k * 0.5), (cx + dx + r * k * 0.7, cy + r * k)]
        rings = [box(1)] + ([box(0.4)] if i % 3 == 0 else []) + ([box(1, 3 * r)] if i % 4 == 0 else [])
        areas.append((f"{1000 + i if i else 9999}", rings))
    areas += [("0000", None), ("0001", [])]
    df = spark.createDataFrame([(c, rings and [[{"x": x, "y": y} for x, y in ring] for ring in rings]) for c, rings in areas],
                               "code string, ring array<array<struct<x:double,y:double>>>")
    some = [(i, rnd.uniform(-50, 50), rnd.uniform(-50, 50)) for i in range(600)]
    some += [(600 + i, *a[1][0][0]) for i, a in enumerate(areas[:120])]  # corners
    points = spark.createDataFrame(some, "id int, x double, y double")
    got = {r["id"]: r["code"] for r in assign_areas(points, df, "id", "x", "y", "code").collect()}

    def holds(rings, x, y):
        hit = False
        for ring in rings:
            for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1]):
                if (bx - ax) * (y - ay) - (by - ay) * (x - ax) == 0 and min(ax, bx) <= x <= max(ax, bx) and min(ay, by) <= y <= max(ay, by):
                    return True
                if (ay > y) != (by > y) and x < ax + (y - ay) * (bx - ax) / (by - ay):
                    hit = not hit
        return hit

    want = {}
    for i, x, y in some:
        if codes := [c for c, rings in areas if rings and holds(rings, x, y)]:
            want[i] = min(codes)
    assert got == want and len(set(want.values())) > 60
    assert assign_areas(points, df.limit(0), "id", "x", "y", "code").isEmpty()


def test_area_indexes(spark, areas, rows):
    points = spark.createDataFrame([(1, 0.5, 0.5), (2, 1.5, 0.5)], "id int, lon double, lat double")
    codes = AR.area_codes(points, areas, "P_", ["SA1", "SA2"])
    assert codes.columns == ["id", "sa1", "sa2"]
    national = spark.createDataFrame([(20, 5)], "sa1 bigint, score int")
    state = spark.createDataFrame([(20, 7), (21, 8)], "sa1 bigint, score int")
    out = AR.link_indexes(codes, national, state, "sa1")
    assert rows(out, "id", "sa2", "score.x", "score.y") == [("P_1", "B", 5, 7), ("P_2", "B", None, 8)]
