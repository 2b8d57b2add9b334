import pytest

from siltbed.operators.expand import expand_csv, expand_lines, expand_nested_records, expand_records
from siltbed.operators.verify import verify_csv

COLUMNS = {"name": "string", "year": "int", "amount": "double"}


def raw(spark, *payloads):
    return spark.createDataFrame(list(enumerate(payloads)), "id int, raw_payload string")


def rows(df):
    return [tuple(r) for r in df.orderBy(*df.columns[:2]).collect()]


def test_csv_edges(spark):
    payload = 'n,y,a\r\n"Smith, J",2022,1.5\r\n \t\r\n,x,\nshort\nlong,2023,2,extra\n'
    assert rows(expand_csv(raw(spark, payload), COLUMNS, ["id"])) == [
        (0, 2, "Smith, J", 2022, 1.5),
        (0, 4, None, None, None),
        (0, 5, "short", None, None),
        (0, 6, "long", 2023, 2.0),
    ]


def test_csv_without_quoting(spark):
    assert rows(expand_csv(raw(spark, 'n,y,a\n"a,1,2'), COLUMNS, ["id"], quoted=False)) == [(0, 2, '"a', 1, 2.0)]


def test_strict_csv_fails_on_bad_numbers(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        expand_csv(raw(spark, "n,y,a\nx,y,z"), COLUMNS, ["id"], strict=True).collect()


def test_header_only_and_empty_payload(spark):
    assert rows(expand_csv(raw(spark, "n,y,a\n", ""), COLUMNS, ["id"])) == []


def test_lines_are_numbered_from_one(spark):
    assert rows(expand_lines(raw(spark, "a\n\nb\r\n"), ["id"])) == [(0, 1, "a"), (0, 2, ""), (0, 3, "b"), (0, 4, "")]


def test_records_edges(spark):
    payloads = ['{"records": [{"a": 1, "b": {"c": "2.5"}}, {"a": "2"}]}', '{"records": []}', '{"records": null}', "{}"]
    fields = {"a": ("a", "int"), "c": ("b.c", "double")}
    assert rows(expand_records(raw(spark, *payloads), "records", fields, ["id"])) == [(0, 1, 2.5), (0, 2, None)]


def test_records_fail_on_bad_values(spark):
    df = raw(spark, '{"records": [{"a": "x"}]}')
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        expand_records(df, "records", {"a": ("a", "int")}, ["id"]).collect()
    assert rows(expand_records(df, "records", {"a": ("a", "int")}, ["id"], strict=False)) == [(0, None)]


def test_nested_records_edges(spark):
    payload = (
        '{"data": [{"n": "x", "p": [{"y": 1, "s": {"v": 5}}, {"y": 2, "s": null}]},'
        ' {"n": "empty", "p": []}, {"n": "null", "p": null}, {"n": "missing"}]}'
    )
    expanded = expand_nested_records(
        raw(spark, payload), "data", "p", {"n": ("n", "string")}, {"y": ("y", "int"), "v": ("s.v", "double")}, ["id"]
    )
    assert sorted(tuple(r) for r in expanded.collect()) == [(0, "x", 1, 5.0), (0, "x", 2, None)]


def test_spreading_keeps_all_rows(spark):
    payload = "h\n" + "\n".join(f"{i}" for i in range(1000))
    df = expand_csv(raw(spark, payload), {"n": "int"}, ["id"], spread=5)
    assert df.rdd.getNumPartitions() == 5
    assert df.distinct().count() == 1000


def test_quoted_line_breaks_are_one_record(spark):
    payload = 'a,"b"\r\n1,"two\nlines, one cell"\r\n\r\n2,"say ""hi"""\r\n'
    raw = spark.createDataFrame([(payload,)], "raw_payload string")
    rows = expand_csv(raw, {"a": "int", "b": "string"}, []).collect()
    assert [(r["a"], r["b"], r["row_number"]) for r in rows] == [(1, "two\nlines, one cell", 2), (2, 'say "hi"', 4)]
    checks = {r["check"]: r["success"] for r in verify_csv(raw, "a,b", 2).collect()}
    assert checks == {"header": True, "data_rows": True}
    broken = raw.selectExpr("replace(raw_payload, 'cell\"', 'cell') AS raw_payload")
    assert {r["check"]: r["success"] for r in verify_csv(broken, "a,b", 2).collect()}["data_rows"] is False
