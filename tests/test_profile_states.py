import random
from datetime import datetime, timedelta

import pytest

from siltbed.operators.profile_states import DISTINCT_ERROR, profile_of, profile_state, unite

SCHEMA = "n bigint, price double, word string, at timestamp_ntz, only_null int, `a.b` boolean"


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(1)
    start = datetime(2024, 1, 1)
    return [
        (
            draw.choice([None, draw.randint(-(2**60), 2**60)]),
            draw.choice([None, draw.uniform(-5, 5)]),
            draw.choice([None, f"w{draw.randint(0, 500)}", ""]),
            start + timedelta(minutes=draw.randint(0, 10_000)),
            None,
            draw.random() < 0.5,
        )
        for _ in range(3000)
    ]


def profile(spark, parts):
    states = [profile_state(spark.createDataFrame(part, SCHEMA), str(n)) for n, part in enumerate(parts)]
    both = states[0]
    for state in states[1:]:
        both = both.unionByName(state)
    return {r["column_name"]: r.asDict() for r in profile_of(unite(both)).collect()}


@pytest.mark.parametrize("cuts", [[0, 3000], [0, 10, 1500, 3000], [0, 0, 3000, 3000]])
def test_any_split_of_the_loads_gives_one_profile(spark, rows, cuts):
    found = profile(spark, [rows[a:b] for a, b in zip(cuts, cuts[1:])])
    for place, name in enumerate(["n", "price", "word", "at"]):
        values = [r[place] for r in rows if r[place] is not None]
        assert (found[name]["row_count"], found[name]["null_count"]) == (3000, 3000 - len(values))
        if name in ("n", "price"):
            assert (found[name]["least_number"], found[name]["largest_number"]) == (float(min(values)), float(max(values)))
            rank = sum(v <= found[name]["quantile"] for v in values) / len(values)
            assert abs(rank - 0.5) < 0.03
        else:
            assert (found[name]["least_text"], found[name]["largest_text"]) == (str(min(values)), str(max(values)))
            assert found[name]["quantile"] is None
        exact = len(set(values))
        assert abs(found[name]["distinct_estimate"] - exact) <= 4 * DISTINCT_ERROR * exact + 1
    assert found["only_null"]["null_count"] == 3000 and found["only_null"]["distinct_estimate"] == 0
    assert found["a.b"]["distinct_estimate"] == 2


def test_a_load_is_one_aggregate_over_one_scan(spark, rows, plan):
    text = plan(profile_state(spark.createDataFrame(rows, SCHEMA), "x"))
    assert text.count("Scan") == 1


def test_empty_load(spark, rows):
    found = profile(spark, [[]])
    assert {r["row_count"] for r in found.values()} == {0} and found["n"]["least_number"] is None
