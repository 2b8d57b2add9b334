import random

from siltbed.operators.identify import components, entity_records, identify

SCHEMA = "n int, isin string, lei string"


def brute(rows):
    """Groups of row numbers that share an identifier, by plain union."""
    root = {n: n for n, *_ in rows}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    seen = {}
    for n, *values in rows:
        for kind, value in enumerate(values):
            if value and value.strip():
                other = seen.setdefault((kind, value.strip()), n)
                root[find(n)] = find(other)
    groups = {}
    for n, *_ in rows:
        groups.setdefault(find(n), set()).add(n)
    return sorted(map(sorted, groups.values()))


def groups(identified):
    found = {}
    for row in identified.collect():
        found.setdefault(row["entity"], []).append(row["n"])
    return sorted(map(sorted, found.values()))


def test_equals_plain_union(spark):
    draw = random.Random(5)

    def value(prefix):
        return draw.choice([None, "", " "]) if draw.random() < 0.3 else f"{prefix}{draw.randrange(60)}"

    rows = [(n, value("i"), value("l")) for n in range(90)]
    assert groups(identify(spark.createDataFrame(rows, SCHEMA), ["isin", "lei"])) == brute(rows)


def test_a_long_chain_and_a_hub(spark):
    chain = [(n, f"i{n // 2}", f"l{(n + 1) // 2}") for n in range(300)]
    hub = [(1000 + n, "hub", None) for n in range(300)]
    found = groups(identify(spark.createDataFrame(chain + hub, SCHEMA), ["isin", "lei"]))
    assert [len(g) for g in found] == [300, 300]


def test_records_without_identifier_stay_and_kinds_do_not_mix(spark):
    rows = [(1, None, " "), (2, "", None), (3, "X", None), (4, None, "X"), (5, " X ", None)]
    found = groups(identify(spark.createDataFrame(rows, SCHEMA), ["isin", "lei"]))
    assert found == [[1], [2], [3, 5], [4]]
    assert identify(spark.createDataFrame([], SCHEMA), ["isin", "lei"]).count() == 0
    assert groups(identify(spark.createDataFrame(rows, SCHEMA), ["isin"])) == [[1], [2], [3, 5], [4]]


def test_priority_over_all_records_of_an_entity(spark):
    rows = [("a.b", 3, "i1", None), ("main", 2, "i1", "l1"), ("main", 1, None, "l1"), (None, 0, "i1", None)]
    records = spark.createDataFrame(rows, "`s.x` string, n int, isin string, lei string")
    best = entity_records(identify(records, ["isin", "lei"]), "s.x", ["main", "a.b"], ["n"]).collect()
    assert [(r["s.x"], r["n"]) for r in best] == [("main", 1)]


def test_loops_are_no_edges(spark):
    assert components(spark.createDataFrame([(b"a", b"a")], "a binary, b binary")).count() == 0
