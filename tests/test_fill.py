"""Fills against a plain loop, with and without cutting groups into blocks."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from plans import plan
from longitab.operators import fill as F_
from longitab.operators.fill import DIRECTIONS, fill


def by_hand(data, way):
    """data: (id, seq, value) -> filled value per (id, seq)."""
    out = {}
    for key in {d[0] for d in data}:
        group = sorted((s, v) for i, s, v in data if i == key)
        values = [v for _, v in group]

        def nearest(n, step):
            while 0 <= n < len(values):
                if values[n] is not None:
                    return values[n]
                n += step
            return None

        for n, (s, _) in enumerate(group):
            down, up = nearest(n, -1), nearest(n, 1)
            pick = {"down": [down], "up": [up], "downup": [down, up], "updown": [up, down]}[way]
            out[key, s] = next((p for p in pick if p is not None), None)
    return out


def sample(seed, n=400):
    rnd = random.Random(seed)
    seqs = rnd.sample(range(-50, 3 * n), n)
    # One id holds a third of the rows, one id is null, one has no value at all.
    ids = [7 if rnd.random() < 0.34 else rnd.choice([1, 2, 3, None, 9]) for _ in range(n)]
    return [(i, s, None if i == 9 or rnd.random() < 0.85 else rnd.choice("abcdef")) for i, s in zip(ids, seqs)]


@pytest.mark.parametrize("way", DIRECTIONS)
@pytest.mark.parametrize("block", [None, 1, 7, 64, 1 << 20])
def test_fill_equals_loop(spark, way, block):
    data = sample(len(way))
    df = spark.createDataFrame(data, "id int, seq bigint, v string").repartition(7)
    got = {(r.id, r.seq): r.v for r in fill(df, ["v"], ["id"], "seq", way, rows_per_block=block).collect()}
    assert got == by_hand(data, way)


def test_mixed_directions_in_one_pass(spark):
    data = sample(11)
    df = spark.createDataFrame([(i, s, v, v, v, v) for i, s, v in data],
                               "id int, seq bigint, down string, up string, downup string, updown string")
    out = fill(df, {w: w for w in DIRECTIONS}, ["id"], "seq", rows_per_block=16).collect()
    assert len(out) == len(data)
    for w in DIRECTIONS:
        assert {(r.id, r.seq): r[w] for r in out} == by_hand(data, w)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(1, 2), st.sampled_from([None, "x", "y"])), min_size=1, max_size=25),
       st.sampled_from(DIRECTIONS), st.integers(1, 6))
def test_fill_properties(spark, pairs, way, block):
    data = [(i, s, v) for s, (i, v) in enumerate(pairs)]
    df = spark.createDataFrame(data, "id int, seq bigint, v string")
    once = fill(df, ["v"], ["id"], "seq", way, rows_per_block=block)
    got = {(r.id, r.seq): r.v for r in once.collect()}
    assert got == by_hand(data, way)
    again = {(r.id, r.seq): r.v for r in fill(once, ["v"], ["id"], "seq", way, rows_per_block=block).collect()}
    assert again == got
    if len(way) > 4:
        known = {i for i, _, v in data if v is not None}
        assert all(v is not None for (i, _), v in got.items() if i in known)


def test_other_columns_and_types_stay(spark):
    df = spark.createDataFrame([(1, 1, None, 5), (1, 2, 2.5, None)], "id int, seq bigint, v double, w int")
    out = fill(df, ["v"], ["id"], "seq", "up", rows_per_block=1)
    assert out.schema.simpleString() == df.schema.simpleString()
    assert {tuple(r) for r in out.collect()} == {(1, 1, 2.5, 5), (1, 2, 2.5, None)}


def test_no_block_has_more_rows(spark, monkeypatch):
    """Whatever the gaps in the order and the ranges, a window reads at most the rows of a block and its front."""
    data = [(1, s ** 3, "a" if s % 97 == 0 else None) for s in range(500)] + [(2, 7, None), (None, 1, "b")]
    df = spark.createDataFrame(data, "id int, seq bigint, v string")
    seen = []
    was = F_._fill_within

    def spy(df, keep, ways, part, order):
        seen.append(max(r["count"] for r in df.groupBy(*part).count().collect()))
        return was(df, keep, ways, part, order)
    monkeypatch.setattr(F_, "_fill_within", spy)
    monkeypatch.setattr(F_, "FAN", 4)  # three levels of ends
    out = fill(df, ["v"], ["id"], "seq", "downup", rows_per_block=9)
    assert {(r.id, r.seq): r.v for r in out.collect()} == by_hand(data, "downup")
    assert seen[0] <= 10
    text = plan(out)
    assert "partial_max_by" not in text  # ends come from a staged frame
    assert "__block" in next(line for line in text.splitlines() if "Exchange hashpartitioning" in line)


def test_small_groups_take_one_shuffle(spark):
    df = spark.createDataFrame([(1, 1, "a"), (2, 1, None)], "id int, seq bigint, v string")
    text = plan(fill(df, ["v"], ["id"], "seq", "down"))
    assert text.count("Exchange hashpartitioning") == 1 and "BroadcastExchange" not in text


def test_direction_is_checked(spark):
    df = spark.createDataFrame([(1, 1, "a")], "id int, seq bigint, v string")
    with pytest.raises(ValueError):
        fill(df, ["v"], ["id"], "seq", "sideways")
