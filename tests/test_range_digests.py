from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from siltbed.operators.range_digests import (
    add_digests,
    compare_by_ranges,
    differing_ranges,
    range_digests,
    rows_in,
    table_digest,
)

SCHEMA = "k int, `v.w` string, x double"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_one_changed_row_leaves_few_rows_to_compare(spark):
    left = [(n, f"t{n}", n / 3) for n in range(3000)]
    right = [*left[:-1], (2999, "other", 2999 / 3)]
    a, b = frame(spark, left), frame(spark, right[::-1])
    wanted = differing_ranges(range_digests(a, ["k"], 64), range_digests(b, ["k"], 64))
    assert wanted.count() == 1
    assert 0 < rows_in(a, ["k"], wanted, 64).count() < 300
    found = {tuple(r) for r in compare_by_ranges(a, b, ["k"], 64).collect()}
    assert found == {("removed", 1, *left[-1]), ("added", 1, *right[-1])}


def test_places_of_nulls_and_copies_count(spark):
    a = frame(spark, [(1, None, 2.0), (None, "x", None), (1, "y", 1.0)])
    b = frame(spark, [(1, None, 2.0), (None, None, None), (1, "y", 1.0), (1, "y", 1.0)])
    found = {tuple(r) for r in compare_by_ranges(a, b, ["k"], 8).collect()}
    assert found == {("removed", 1, None, "x", None), ("added", 1, None, None, None), ("added", 1, 1, "y", 1.0)}


def test_digests_of_loads_add_up(spark):
    rows = [(n % 7, str(n), float(n)) for n in range(100)]
    whole = range_digests(frame(spark, rows), ["k"], 16)
    parts = [range_digests(frame(spark, rows[i::3]), ["k"], 16) for i in range(3)]
    assert differing_ranges(whole, add_digests(*parts)).count() == 0
    assert table_digest(whole).first() == table_digest(add_digests(*parts)).first()


def test_empty_sides(spark):
    empty, one = frame(spark, []), frame(spark, [(1, "a", 1.0)])
    assert compare_by_ranges(empty, empty, ["k"]).count() == 0
    assert [r["change"] for r in compare_by_ranges(empty, one, ["k"]).collect()] == ["added"]
    assert [r["change"] for r in compare_by_ranges(one, empty, ["k"]).collect()] == ["removed"]


def test_rows_outside_are_filtered_before_the_shuffle(spark, plan):
    a, b = frame(spark, [(1, "a", 1.0)]), frame(spark, [(2, "a", 1.0)])
    text = plan(compare_by_ranges(a, b, ["k"], 8))
    assert "BroadcastHashJoin" in text and "CartesianProduct" not in text and "NestedLoop" not in text


row = st.tuples(st.none() | st.integers(0, 3), st.none() | st.sampled_from("ab"), st.none() | st.sampled_from([0.0, 1.5]))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(left=st.lists(row, max_size=8), right=st.lists(row, max_size=8))
def test_equals_counting(spark, left, right):
    expected = {}
    for r in {*left, *right}:
        if (more := right.count(r) - left.count(r)) != 0:
            expected[r] = more
    found = {tuple(r)[2:]: r["times"] * (1 if r["change"] == "added" else -1) for r in
             compare_by_ranges(frame(spark, left), frame(spark, right), ["k"], 4).collect()}
    assert found == expected
