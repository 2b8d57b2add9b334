import uuid

import pytest

from siltbed.operators.known_keys import known_keys, remember_keys, repeated_keys, uniqueness_of_load

SCHEMA = "a int, b string"


@pytest.fixture
def table(tmp_path):
    return f"known_{uuid.uuid4().hex}", str(tmp_path / "keys")


def report(rows, columns, known=None):
    return tuple(uniqueness_of_load(rows, columns, known).first())


def test_loads_are_tested_against_those_before(spark, table):
    name, path = table
    first = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (None, None)], SCHEMA)
    second = spark.createDataFrame([(2, None), (2, "x"), (None, None), (3, "y"), (3, "y"), (4, "z")], SCHEMA)
    assert report(first, ["a", "b"]) == (4, 1)
    remember_keys(first, ["a", "b"], name, path, 4)
    assert report(second, ["a", "b"], known_keys(spark, name)) == (6, 3)
    remember_keys(second, ["a", "b"], name, path, 4)
    assert report(second, ["a", "b"], known_keys(spark, name)) == (6, 5)
    found = repeated_keys(second.limit(0), ["a", "b"], known_keys(spark, name))
    assert found.count() == 0


def test_null_alone_is_no_key(spark, table):
    name, path = table
    rows = spark.createDataFrame([(None, "x"), (None, "x"), (1, "y")], SCHEMA)
    assert report(rows, ["a"]) == (1, 0)
    remember_keys(rows, ["a"], name, path, 4)
    assert report(rows, ["a"], known_keys(spark, name)) == (1, 1)


def test_stored_keys_are_not_shuffled(spark, table, plan):
    name, path = table
    remember_keys(spark.createDataFrame([(n, "x") for n in range(500)], SCHEMA), ["a"], name, path, 4)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        text = plan(repeated_keys(spark.createDataFrame([(1, "x")], SCHEMA), ["a"], known_keys(spark, name)).filter("is_known"))
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    # The only shuffle is that of the new keys; the stored ones are read bucket by bucket.
    assert "Bucketed: true" in text and text.count("Exchange") == 1
    assert "Exchange" not in text[text.index("Scan ExistingRDD") :]
