import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from siltbed.operators import history
from siltbed.operators.as_of import as_of_join
from siltbed.plans.prices import read_history, record_history
from siltbed.sources.tables import VersionedTable

KEYS, CHECKS = ["k"], ["v", "w"]
COLUMNS = "k string, v double, w string, at timestamp"


def at(day):
    return datetime(2026, 1, day)


def staged(spark, *rows):
    return spark.createDataFrame(list(rows), COLUMNS)


def run(previous, rows, day):
    source = history.latest_load(rows, KEYS, "at", CHECKS).drop("at")
    if previous is None:
        return history.first_load(source, KEYS, F.lit(at(day)))
    return history.apply_changes(previous, source, KEYS, CHECKS, F.lit(at(day)))


def shown(df):
    rows = df.select("k", "v", "w", "valid_from", "valid_to").collect()
    return sorted(
        ((r.k, r.v, r.w, r.valid_from.day, r.valid_to.day if r.valid_to else None) for r in rows), key=str
    )


LOAD_1 = [("a", 127.49, "EUR", at(1)), ("b", 1.0, "EUR", at(1))]
LOAD_2 = [("a", 126.81, "EUR", at(2))]


def test_correction_closes_and_opens(spark):
    first = run(None, staged(spark, *LOAD_1), 1)
    second = run(first, staged(spark, *LOAD_1, *LOAD_2), 2)
    assert shown(second) == [("a", 126.81, "EUR", 2, None), ("a", 127.49, "EUR", 1, 2), ("b", 1.0, "EUR", 1, None)]


def test_running_again_changes_nothing(spark):
    both = staged(spark, *LOAD_1, *LOAD_2)
    versions = run(run(None, staged(spark, *LOAD_1), 1), both, 2)
    again = run(run(versions, both, 3), both, 4)
    assert shown(again) == shown(versions)
    assert sorted(r.scd_id for r in again.collect()) == sorted(r.scd_id for r in versions.collect())


def test_first_run_over_both_loads_opens_one_version(spark):
    assert shown(run(None, staged(spark, *LOAD_1, *LOAD_2), 2)) == [("a", 126.81, "EUR", 2, None), ("b", 1.0, "EUR", 2, None)]


def test_value_to_null_and_back_is_a_change(spark):
    versions = run(None, staged(spark, ("a", 1.0, None, at(1))), 1)
    versions = run(versions, staged(spark, ("a", None, None, at(2))), 2)
    versions = run(versions, staged(spark, ("a", None, "x", at(3))), 3)
    assert shown(versions) == [("a", 1.0, None, 1, 2), ("a", None, "x", 3, None), ("a", None, None, 2, 3)]


def test_removed_key_stays_open_and_empty_source_changes_nothing(spark):
    versions = run(None, staged(spark, *LOAD_1), 1)
    assert shown(run(versions, staged(spark, LOAD_1[0]), 2)) == shown(versions)
    assert shown(run(versions, staged(spark), 2)) == shown(versions)


def test_as_of_is_inclusive_from_and_exclusive_to(spark):
    versions = run(run(None, staged(spark, *LOAD_1), 1), staged(spark, *LOAD_2), 2)
    value = {
        moment: [r.v for r in history.as_of(versions, F.lit(moment)).filter("k = 'a'").collect()]
        for moment in (at(1) - timedelta(seconds=1), at(1), at(2) - timedelta(seconds=1), at(2))
    }
    assert list(value.values()) == [[], [127.49], [127.49], [126.81]]


def test_meta_columns(spark):
    versions = run(run(None, staged(spark, *LOAD_1), 1), staged(spark, *LOAD_2), 2).collect()
    assert len({r.scd_id for r in versions}) == 3
    assert all(r.updated_at == r.valid_from for r in versions)


def test_no_overlaps_and_one_open_version_under_random_loads(spark):
    rng = random.Random(7)
    versions, rows = None, []
    for day in range(1, 6):
        rows += [(f"k{rng.randrange(8)}", float(rng.randrange(3)), rng.choice(["x", None]), at(day)) for _ in range(6)]
        versions = run(versions, staged(spark, *rows), day)
        versions = spark.createDataFrame(versions.collect(), versions.schema)
    by_key = {}
    for r in sorted(versions.collect(), key=lambda r: (r.k, r.valid_from)):
        by_key.setdefault(r.k, []).append(r)
    for found in by_key.values():
        assert [r.valid_to for r in found[:-1]] == [r.valid_from for r in found[1:]]
        assert found[-1].valid_to is None
    assert len(by_key) == len({k for k, *_ in rows})


def test_stored_history_equals_the_frame_and_keeps_closed_files(spark, tmp_path, folders):
    table = VersionedTable(spark, str(tmp_path / "history"))
    expected, rows = None, []
    for day, load in enumerate([LOAD_1, LOAD_2, [("a", 1.0, "EUR", at(3)), ("c", 5.0, "USD", at(3))]], start=1):
        rows += load
        expected = run(expected, staged(spark, *rows), day)
        source = history.latest_load(staged(spark, *rows), KEYS, "at", CHECKS).drop("at")
        record_history(table, source, F.lit(at(day)), KEYS, CHECKS)
    assert shown(read_history(table)) == shown(expected)
    closed = [part for part in folders(table.entry()) if "closed" in part]
    assert closed == [f"commit_version={n}/history_part=closed_all" for n in (2, 3)]
    assert shown(read_history(table, 1)) == [("a", 127.49, "EUR", 1, None), ("b", 1.0, "EUR", 1, None)]


def test_a_run_touches_open_rows_of_its_slices_only(spark, tmp_path, folders):
    table = VersionedTable(spark, str(tmp_path / "history"))
    first = staged(spark, ("a1", 1.0, "x", at(1)), ("b1", 2.0, "x", at(1)), ("b2", 3.0, "x", at(1))).drop("at")
    by_letter = F.substring("k", 1, 1)
    record_history(table, first, F.lit(at(1)), KEYS, CHECKS, by_letter)
    correction = staged(spark, ("b2", 4.0, "x", at(2)), ("c1", 5.0, "x", at(2))).drop("at")
    record_history(table, correction, F.lit(at(2)), KEYS, CHECKS, by_letter)
    parts = {f"commit_version={p}" for p in ("1/history_part=open_a", "2/history_part=open_b", "2/history_part=open_c", "2/history_part=closed_b")}
    assert set(folders(table.entry())) == parts
    assert shown(read_history(table)) == [
        ("a1", 1.0, "x", 1, None),
        ("b1", 2.0, "x", 1, None),
        ("b2", 3.0, "x", 1, 2),
        ("b2", 4.0, "x", 2, None),
        ("c1", 5.0, "x", 2, None),
    ]


def brute_force(rows):
    """Versions per key by walking its loads in order."""
    states = {}
    for k, v, w, when in rows:
        low = (float("-inf") if v is None else v, "" if w is None else w)
        states.setdefault(k, {}).setdefault(when, []).append((low, (v, w)))
    found = []
    for k, by_time in states.items():
        open_from, state = None, None
        for when in sorted(by_time):
            new = max(by_time[when])[1]
            if open_from is None or new != state:
                if open_from is not None:
                    found.append((k, *state, open_from, when))
                open_from, state = when, new
        found.append((k, *state, open_from, None))
    return sorted(found, key=str)


@pytest.mark.parametrize("bucket", ["hour", "day", "year"])
def test_replay_equals_brute_force(spark, bucket):
    rng = random.Random(3)
    rows = [
        (
            "hot" if rng.random() < 0.5 else rng.choice(["a", "b", None]),
            rng.choice([1.0, 2.0, None]),
            rng.choice(["x", "x", None]),
            datetime(2026, 1, 1) + timedelta(hours=rng.randrange(200)),
        )
        for _ in range(400)
    ]
    replayed = history.replay(staged(spark, *rows), KEYS, CHECKS, "at", bucket)
    found = [(r.k, r.v, r.w, r.valid_from, r.valid_to) for r in replayed.collect()]
    assert sorted(found, key=str) == brute_force(rows)


def test_a_late_load_changes_nothing(spark):
    """The load of the second day runs before that of the first."""
    second, first = (staged(spark, ("a", nav, "EUR", at(day))) for nav, day in ((2.0, 2), (1.0, 1)))
    opened = history.first_load(second, KEYS, F.lit(at(3)))
    late = history.apply_changes(opened, first, KEYS, CHECKS, F.lit(at(4)), "at")
    assert [(r[CHECKS[0]], r["valid_to"]) for r in late.collect()] == [(2.0, None)]
    newer = history.apply_changes(opened, staged(spark, ("a", 3.0, "EUR", at(3))), KEYS, CHECKS, F.lit(at(4)), "at")
    assert sorted((r[CHECKS[0]], r["valid_to"] is None) for r in newer.collect()) == [(2.0, False), (3.0, True)]


def test_null_keys_stay_one_version(spark, plan):
    load = staged(spark, (None, 1.0, "EUR", at(1))).drop("at")
    versions = history.first_load(load, KEYS, F.lit(at(1)))
    for day in (2, 3):
        versions = history.apply_changes(versions, load, KEYS, CHECKS, F.lit(at(day)))
    assert versions.count() == 1
    assert "NestedLoop" not in plan(versions)


def test_slices_may_hold_any_text(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "history"))
    keys = ["a:b", "c/d", "100%", "", None]
    load = staged(spark, *[(k, 1.0, "x", at(1)) for k in keys]).drop("at")
    for day in (1, 2):
        record_history(table, load, F.lit(at(day)), KEYS, CHECKS, F.col("k"))
    assert read_history(table).count() == len(keys)
    plain = VersionedTable(spark, str(tmp_path / "plain"))
    plain.overwrite(load, split_by="k")
    plain.replace_split(load.filter("k IS NULL OR k = 'a:b'"), [None, "a:b"])
    # As in any partition column, an empty text is stored as NULL.
    assert sorted(str(r["k"]) for r in plain.read().collect()) == ["100%", "None", "a:b", "c/d"]


SCHEMA = "k int, at timestamp_ntz, v string"


def random_records(draw, count):
    start = datetime(2024, 1, 1)
    return [
        (draw.choice([1, 2, 3, 4, None]), start + timedelta(hours=draw.randint(0, 120)), draw.choice(["a", "b", None]))
        for _ in range(count)
    ]


@pytest.mark.parametrize("seed", range(3))
def test_any_order_of_loads_gives_the_replayed_history(spark, seed):
    draw = random.Random(seed)
    records = random_records(draw, 80)
    cut = draw.randint(0, 80)
    first, late = (spark.createDataFrame(part, SCHEMA) for part in (records[:cut], records[cut:]))
    found = history.insert_late(history.replay(first, ["k"], ["v"], "at"), late, first, ["k"], ["v"], "at")
    whole = history.replay(spark.createDataFrame(records, SCHEMA), ["k"], ["v"], "at")
    assert sorted(map(repr, found.collect())) == sorted(map(repr, whole.collect()))


def test_a_late_record_splits_a_closed_version(spark):
    at = [datetime(2024, 1, day) for day in range(1, 6)]
    staged = spark.createDataFrame([(1, at[0], "a"), (1, at[2], "a"), (1, at[4], "b"), (2, at[0], "x")], SCHEMA)
    late = spark.createDataFrame([(1, at[1], "c"), (3, at[1], "n"), (4, None, "no time")], SCHEMA)
    found = history.insert_late(history.replay(staged, ["k"], ["v"], "at"), late, staged, ["k"], ["v"], "at")
    rows = sorted((r["k"], r["v"], r["valid_from"], r["valid_to"]) for r in found.collect() if r["k"] == 1)
    assert rows == [(1, "a", at[0], at[1]), (1, "a", at[2], at[4]), (1, "b", at[4], None), (1, "c", at[1], at[2])]
    assert {r["k"] for r in found.collect()} == {1, 2, 3}


@pytest.mark.parametrize("forward", [False, True])
@pytest.mark.parametrize("exact", [True, False])
def test_as_of_join_equals_a_search(spark, forward, exact):
    draw = random.Random(7)
    facts = random_records(draw, 150) + [(1, None, "z")]
    versions = random_records(draw, 60) + [(2, None, "q")]
    given = spark.createDataFrame(versions, SCHEMA).toDF("k", "since", "value")
    found = as_of_join(
        spark.createDataFrame(facts, SCHEMA), given, ["k"], "at", "since", {"s": "since", "w": "value"}, forward=forward, exact=exact
    )

    def counts(since, at):
        if since is None or at is None:
            return False
        return since == at and exact or (since > at if forward else since < at)

    expected = []
    for key, at, value in facts:
        fitting = [(s, w) for k, s, w in versions if k == key and counts(s, at)]
        sign = -1 if forward else 1
        best = max(fitting, key=lambda x: (sign * x[0].timestamp(), x[1] is not None, x[1] or ""), default=(None, None))
        expected.append((key, at, value, *best))
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, expected))


def test_as_of_join_respects_the_end_of_versions(spark):
    day = [datetime(2024, 1, n) for n in range(1, 8)]
    versions = spark.createDataFrame([(1, day[0], day[2], "a"), (1, day[4], None, "b")], "k int, f timestamp_ntz, t timestamp_ntz, v string")
    facts = spark.createDataFrame([(1, d) for d in day], "k int, at timestamp_ntz")
    found = as_of_join(facts, versions, ["k"], "at", "f", {"v": "v"}, valid_to="t")
    assert [r["v"] for r in found.orderBy("at").collect()] == ["a", "a", None, None, "b", "b", "b"]
    assert as_of_join(facts.limit(0), versions, ["k"], "at", "f", {"v": "v"}).count() == 0
    assert as_of_join(facts, versions.limit(0), ["k"], "at", "f", {"v": "v"}).count() == 7


def test_late_loads_go_through_one_sort_per_bucket_and_one_per_key(spark, plan):
    rows = [(n % 7, datetime(2024, 1, 1) + timedelta(hours=n), "abc"[n % 3]) for n in range(60)]
    first, late = (spark.createDataFrame(part, SCHEMA) for part in (rows[::2], rows[1::2]))
    versions = history.replay(first, ["k"], ["v"], "at")
    # Instants, buckets, keys; no join, and no frame that is added up anew for every row.
    assert plan(versions).count("Exchange hashpartitioning") == 3
    assert "Join" not in plan(versions)
    versions = spark.createDataFrame(versions.collect(), versions.schema)
    found = plan(history.insert_late(versions, late, first, ["k"], ["v"], "at"))
    assert "unboundedfollowing" not in found.lower()
    windows = found.count("Window [")
    assert 0 < windows <= 4


@pytest.mark.parametrize("bucket", ["hour", "month"])
def test_late_loads_with_copies_equal_brute_force(spark, bucket):
    draw = random.Random(11)
    rows = [
        (draw.choice(["a", "b", None]), draw.choice([1.0, None]), draw.choice(["x", "y"]), datetime(2026, 1, 25) + timedelta(minutes=20 * draw.randrange(600)))
        for _ in range(200)
    ]
    rows += rows[::5]
    loads = [staged(spark, *rows[n::3]) for n in range(3)]
    versions = history.replay(loads[0], KEYS, CHECKS, "at", bucket)
    seen = loads[0]
    for late in loads[1:]:
        versions = history.insert_late(versions, late, seen, KEYS, CHECKS, "at", bucket)
        versions = spark.createDataFrame(versions.collect(), versions.schema)
        seen = seen.unionByName(late)
    assert sorted([(r.k, r.v, r.w, r.valid_from, r.valid_to) for r in versions.collect()], key=str) == brute_force(rows)
