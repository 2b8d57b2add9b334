import pytest
from pyspark.sql import functions as F

from siltbed.operators import expectations as expect
from siltbed.operators.checks import AcceptedValues, NotNull, Relationship, Unique, duplicate_groups, enforce_not_null, orphans, run_checks
from siltbed.operators.expectations import statistics, validate
from siltbed.operators.profile import column_profile, completeness
from siltbed.plans.gate import promote
from siltbed.sources.tables import VersionedTable


@pytest.fixture
def rows(spark):
    data = [(1, "a", "x"), (2, "a", None), (3, None, "z"), (3, "b", "z"), (None, "c", "q"), (None, "c", "q")]
    return spark.createDataFrame(data, "id int, k string, v string")


def outcome(df):
    return {(r["check"], r["column"]): (r["evaluated"], r["failures"], r["success"]) for r in df.collect()}


def test_checks(spark, rows):
    parents = spark.createDataFrame([("a",), ("a",), ("c",)], "k string")
    checks = [
        NotNull("id"),
        NotNull("k"),
        AcceptedValues("v", ("x", "z")),
        AcceptedValues("k", ("a",)),
        Unique(("id",)),
        Unique(("id", "k")),
        Relationship("k", "p", "k"),
    ]
    assert outcome(run_checks(rows, checks, {"p": parents})) == {
        ("not_null", "id"): (6, 2, False),
        ("not_null", "k"): (6, 1, False),
        ("accepted_values", "v"): (5, 1, False),
        ("accepted_values", "k"): (5, 2, False),
        ("unique", "id"): (4, 1, False),
        ("unique_combination", "id, k"): (6, 1, False),
        ("relationships", "k"): (5, 1, False),
    }
    assert [tuple(r) for r in duplicate_groups(rows, ["id", "k"]).collect()] == [(None, "c", 2)]
    assert [tuple(r) for r in orphans(rows, "k", parents, "k").collect()] == [("b", 1)]


def test_unique_with_a_condition(rows):
    assert outcome(run_checks(rows, [Unique(("id",), where="k IS NOT NULL")])) == {("unique", "id"): (3, 0, True)}


def test_checks_of_an_empty_table_pass(spark, rows):
    empty = rows.filter("false")
    checks = [NotNull("id"), AcceptedValues("v", ("x",)), Unique(("id",)), Unique(("id", "k")), Relationship("k", "p", "k")]
    assert all(e == 0 and ok for e, _, ok in outcome(run_checks(empty, checks, {"p": empty})).values())


def test_every_declared_check_has_a_row(spark, rows):
    parents = {name: spark.createDataFrame([(k,) for k in keys], "k string") for name, keys in (("p", "ac"), ("q", "a"))}
    checks = [Unique(("id",)), Unique(("id",), where="k IS NOT NULL"), Relationship("k", "p", "k"), Relationship("k", "q", "k")]
    found = sorted((r["check"], r["evaluated"], r["failures"]) for r in run_checks(rows, checks, parents).collect())
    assert found == [("relationships", 5, 1), ("relationships", 5, 3), ("unique", 3, 0), ("unique", 4, 1)]
    assert run_checks(rows, []).collect() == []
    assert run_checks(rows, []).columns == run_checks(rows, checks, parents).columns


def test_row_checks_share_one_scan(rows, plan):
    text = plan(run_checks(rows, [NotNull(c) for c in rows.columns]))
    assert text.count("Scan") == 1


def test_required_columns(rows):
    assert enforce_not_null(rows.filter("id IS NOT NULL"), ["id"]).count() == 4
    with pytest.raises(Exception, match="NULL in required column id"):
        enforce_not_null(rows, ["id"]).collect()


SUITE = [
    expect.RowCountBetween(100, 200),
    expect.NotNull("isin"),
    expect.LengthEquals("isin", 12),
    expect.InSet("source_system", ("nzdpu", "cdp")),
    expect.Between("scope", 0, 100_000_000, mostly=0.95),
    expect.CompoundUnique(("isin", "year")),
]


def emissions(spark, n, outliers=0):
    base = spark.range(n).select(
        F.format_string("DE%010d", "id").alias("isin"),
        F.lit(2022).alias("year"),
        F.lit("cdp").alias("source_system"),
        F.when(F.col("id") >= 6, F.lit(10.0)).alias("scope"),
    )
    bad = spark.range(outliers).select(
        F.lit("DE0007236101"), (F.col("id") + 2030).cast("int"), F.lit("cdp"), F.lit(500_000_000.0)
    )
    return base.unionAll(bad)


def test_suite_green_and_red(spark):
    assert tuple(statistics(validate(emissions(spark, 150), SUITE)).first()) == (6, 6, 0, 100.0, True)
    red = {r["expectation"]: r for r in validate(emissions(spark, 150, 8), SUITE).collect()}
    assert (red["between"]["unexpected"], red["between"]["evaluated"], red["between"]["unexpected_pct"]) == (8, 152, 5.2632)
    assert [name for name, r in red.items() if not r["success"]] == ["between"]
    assert statistics(validate(emissions(spark, 150, 7), SUITE)).first()["success"]


def test_suite_of_an_empty_table(spark):
    results = {r["expectation"]: r["success"] for r in validate(emissions(spark, 0), SUITE).collect()}
    assert results.pop("row_count_between") is False
    assert all(results.values())


def test_every_copy_of_a_repeated_key_is_unexpected(spark, rows):
    found = validate(rows, [expect.CompoundUnique(("id",))]).first()
    assert (found["evaluated"], found["unexpected"], found["success"]) == (4, 2, False)
    found = validate(rows, [expect.CompoundUnique(("id", "k"))]).first()
    assert (found["evaluated"], found["unexpected"], found["success"]) == (6, 2, False)


@pytest.fixture
def tables(spark, tmp_path):
    return [VersionedTable(spark, str(tmp_path / name)) for name in ("curated", "trusted", "results")]


def test_gate_promotes_blocks_and_reports_errors(spark, tables):
    curated, trusted, store = tables
    green = promote(curated, trusted, SUITE, refresh=lambda: curated.overwrite(emissions(spark, 150)), store=store, run_name="r1")
    assert (green.outcome, green.exit_code, green.target_version) == ("promoted", 0, 1)

    curated.append(emissions(spark, 0, 8))
    red = promote(curated, trusted, SUITE, store=store, run_name="r2")
    assert (red.outcome, red.exit_code, red.target_version, red.validated_version) == ("blocked", 1, None, 2)
    assert trusted.entry()["version"] == 1 and trusted.read().count() == 150
    stored = {(r["run_name"], r["success"]): r["count"] for r in store.read().groupBy("run_name", "success").count().collect()}
    assert stored == {("r1", True): 6, ("r2", True): 5, ("r2", False): 1}

    def broken():
        raise RuntimeError("refresh failed")

    error = promote(curated, trusted, SUITE, refresh=broken)
    assert (error.outcome, error.exit_code, error.message) == ("error", 2, "refresh failed")
    assert trusted.entry()["version"] == 1

    fixed = promote(curated, trusted, SUITE, refresh=lambda: curated.delete_where(F.col("year") >= 2030))
    assert (fixed.outcome, trusted.read().count()) == ("promoted", 150)


def test_the_validated_version_is_promoted(spark, tables):
    curated, trusted, _ = tables
    curated.append(emissions(spark, 150))

    def model(df):
        curated.append(emissions(spark, 0, 8))
        return df

    assert promote(curated, trusted, SUITE, model).outcome == "promoted"
    assert curated.read().count() == 158 and trusted.read().count() == 150


def test_profiles(spark, rows):
    assert tuple(completeness(rows, ["id", "v"], "v").first()) == (6, 2, 1, 3)
    for approximate in (False, True):
        profile = {r["column_name"]: r for r in column_profile("t", rows, approximate).collect()}
        assert (profile["id"]["row_count"], profile["id"]["null_count"], profile["id"]["distinct_count"]) == (6, 2, 3)
        assert (profile["k"]["min_value"], profile["k"]["max_value"], profile["k"]["data_type"]) == ("a", "c", "string")
    assert column_profile("t", rows.filter("false")).filter("distinct_count = 0").count() == 3


def test_gate_reports_a_failing_promotion(spark, tables):
    curated, trusted, _ = tables
    curated.overwrite(emissions(spark, 150))
    trusted.overwrite(emissions(spark, 3))
    before = trusted.entry()["version"]
    failed = promote(curated, trusted, SUITE, lambda df: df.select("no_such_column"))
    assert (failed.outcome, failed.exit_code, failed.target_version) == ("error", 2, None)
    assert "no_such_column" in failed.message and trusted.entry()["version"] == before
