"""Interval, nearest and range joins against brute force, and other join helpers."""

import datetime as dt
import random

import pytest
from racing import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pitwall.operators import joins

T0 = dt.datetime(2023, 3, 5, 13, 0, 0)


def laps_and_samples(spark, laps, samples):
    l_df = spark.createDataFrame(laps, "k int, lap int, lt timestamp")
    s_df = spark.createDataFrame(samples, "k int, rt timestamp, position int")
    return l_df, s_df


def whole(t):
    return int(t.replace(microsecond=0).timestamp())


def random_case(seed, n=120, span=400):
    rnd = random.Random(seed)
    at = lambda: T0 + dt.timedelta(milliseconds=rnd.randrange(span * 1000))
    # Key 0 holds most rows.
    key = lambda: rnd.choice([0, 0, 0, 1, 2])
    laps = [(key(), i, at()) for i in range(n)]
    samples = [(key(), at(), rnd.randrange(20)) for _ in range(n)]
    return laps, samples


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("bucket", [None, 60])
def test_interval_join_equals_brute_force(spark, seed, bucket):
    laps, samples = random_case(seed)
    l_df, s_df = laps_and_samples(spark, laps, samples)
    got = rows(joins.interval_join(l_df, s_df, ["k"], "lt", "rt", 30, bucket), "k", "lap", "rt", "position")
    want = [(k, i, rt, p) for k, i, lt in laps for k2, rt, p in samples if k == k2 and abs(whole(lt) - whole(rt)) < 30]
    assert got == sorted(want, key=repr)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_nearest_join_equals_brute_force(spark, seed):
    laps, samples = random_case(seed, span=4000)
    l_df, s_df = laps_and_samples(spark, laps, samples)
    got = rows(joins.nearest_join(l_df, s_df, ["k"], "lt", "rt", 30, ["position"]), "k", "lap", "rt", "position")
    want = []
    for k, i, lt in laps:
        near = [(abs(whole(lt) - whole(rt)), rt, p) for k2, rt, p in samples if k == k2 and abs(whole(lt) - whole(rt)) < 30]
        if near:
            _, rt, p = min(near)
            want.append((k, i, rt, p))
    assert got == sorted(want, key=repr)


def test_distance_is_in_whole_seconds(spark):
    """29.4 s over a second boundary counts 30 whole seconds and is out; 29.9 s within is in."""
    lt = T0 + dt.timedelta(milliseconds=900)
    samples = [(1, lt + dt.timedelta(milliseconds=29_400), 1), (1, T0 + dt.timedelta(milliseconds=29_999), 2)]
    l_df, s_df = laps_and_samples(spark, [(1, 1, lt)], samples)
    assert rows(joins.interval_join(l_df, s_df, ["k"], "lt", "rt", 30), "position") == [(2,)]


def test_narrow_bucket_is_refused(spark):
    l_df, s_df = laps_and_samples(spark, [], [])
    with pytest.raises(ValueError, match="bucket"):
        joins.interval_join(l_df, s_df, ["k"], "lt", "rt", 30, 45)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.integers(0, 1), st.integers(1, 60)), min_size=1, max_size=15, unique=True),
    st.lists(st.tuples(st.integers(0, 1), st.integers(0, 60), st.integers(-2, 40)), max_size=8),
)
def test_range_join_equals_brute_force(spark, points, spans):
    ranges = [(k, lo, lo + n, i) for i, (k, lo, n) in enumerate(spans)]
    left = spark.createDataFrame(points, "k int, lap int")
    right = spark.createDataFrame(ranges, "k int, lo int, hi int, id int")
    got = rows(joins.range_join(left, right, ["k"], "lap", "lo", "hi", ["lo", "id"]), "k", "lap", "id")
    want = []
    for k, lap in points:
        hit = sorted((lo, i) for k2, lo, hi, i in ranges if k == k2 and lo <= lap <= hi)
        want.append((k, lap, hit[0][1] if hit else None))
    assert got == sorted(want, key=repr)


def test_range_join_of_tables_with_one_origin(spark):
    laps = spark.createDataFrame([(1, 4, 1), (1, 4, 50), (1, 5, 1)], "s int, d int, lap int")
    stints = laps.where("d = 4").select("s", "d").distinct().selectExpr("s", "d", "1 AS lo", "20 AS hi")
    got = rows(joins.range_join(laps, stints, ["s", "d"], "lap", "lo", "hi", ["lo"]), "s", "d", "lap", "lo")
    assert got == sorted([(1, 4, 1, 1), (1, 4, 50, None), (1, 5, 1, None)], key=repr)


def test_lap_on_a_stint_border_takes_the_earlier_stint(spark):
    left = spark.createDataFrame([(1, 10)], "k int, lap int")
    right = spark.createDataFrame([(1, 10, 20, "later"), (1, 1, 10, "earlier")], "k int, lo int, hi int, name string")
    assert rows(joins.range_join(left, right, ["k"], "lap", "lo", "hi", ["lo"]), "name") == [("earlier",)]


def test_first_match_is_thinned_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "id AS v")
    picked = joins.first_match(df, ["k"], ["v"])
    assert rows(picked) == [(0, 0), (1, 1), (2, 2)]
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan


def test_orphans_ignore_null_keys(spark):
    child = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    parent = spark.createDataFrame([(1,)], "k int")
    assert rows(joins.orphans(child, parent, "k"), "v") == [("b",)]


def test_literal_star_repeats_laps(spark):
    laps = spark.createDataFrame([(1, 7, 90.0)], "session_key int, driver_number int, lap_time double")
    drivers = spark.createDataFrame([(1, 7, "N", "T"), (2, 7, "N", "T")], "session_key int, driver_number int, full_name string, team_name string")
    sessions = spark.createDataFrame([(1, 5, "Race", "Race", T0, T0)], "session_key int, meeting_key int, session_name string, session_type string, date_start timestamp, date_end timestamp")
    meetings = spark.createDataFrame([(5, "GP", 2023, "X", "Y")], "meeting_key int, meeting_name string, year int, country_name string, circuit_short_name string")
    assert joins.star(laps, drivers, sessions, meetings).count() == 1
    assert joins.star(laps, drivers, sessions, meetings, literal=True).count() == 2


def test_lookup_gives_null_when_absent(spark):
    df = spark.createDataFrame([(1,), (2,)], "y int")
    dim = spark.createDataFrame([(1, 20), (1, 10)], "y int, v int")
    assert rows(joins.lookup(df, dim, ["y"], {"v": "found"})) == [(1, 10), (2, None)]
