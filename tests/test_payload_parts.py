"""CSV and JSON text against Python's own readers, whole and cut into chunks of any size."""

import csv
import io
import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from siltbed.functions.csv_text import csv_cells, csv_records
from siltbed.functions.json_fields import is_json
from siltbed.operators.expand import expand_csv, expand_nested_records, expand_records
from siltbed.operators.payload_parts import csv_parts, json_array_parts
from siltbed.operators.verify import verify_csv


@pytest.fixture
def tasks_of(spark):
    """Tasks that hold rows of a frame, planned as for large tables: small ones are neither put together nor broadcast."""
    small = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for name, value in small.items():
        spark.conf.set(name, value)
    yield lambda df: df.select(F.spark_partition_id()).distinct().count()
    for name in small:
        spark.conf.unset(name)


def random_csv(draw):
    pieces = ["a", "é", '"', '"', '""', ",", "\n", "\n", "x y", '5" d', "😀", "\x1e"]
    return "".join(draw.choices(pieces, k=draw.randint(0, 40)))


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(3)
    return [random_csv(draw) for _ in range(1500)] + ['3,5" disk\n4,ok', '"a"b,c', "a\n", "", "\n", "\n\n", '"open\nx', 'x,"']


@pytest.fixture(scope="module")
def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id int, raw_payload string").repartition(4).cache()


def read_by_python(text):
    # A blank line is a record of one empty cell here.
    return [cells or [""] for cells in csv.reader(io.StringIO(text, newline=""))]


def cells_of():
    return F.transform(csv_records(F.col("raw_payload")), csv_cells)


def test_records_and_cells_equal_the_csv_module(frame, texts):
    found = {r["id"]: r["cells"] for r in frame.select("id", cells_of().alias("cells")).collect()}
    assert [found[n] for n in range(len(texts))] == list(map(read_by_python, texts))


@pytest.mark.parametrize("size", [1, 3, 20])
def test_chunks_give_the_same_records(frame, texts, size):
    parts = csv_parts(frame, ["id"], size=size).select("id", "first_record", F.posexplode(cells_of()).alias("n", "cells"))
    found = {}
    for r in parts.collect():
        found.setdefault(r["id"], {})[r["first_record"] + r["n"]] = r["cells"]
    for n, text in enumerate(texts):
        rows = found.get(n, {})
        assert [rows[k] for k in range(len(rows))] == read_by_python(text), text


def test_stray_quotes_lose_no_record(spark):
    raw = spark.createDataFrame([('id,item\n3,5" disk\n4,ok\n5,"say ""hi"",\n\x1e"\n',)], "raw_payload string")
    rows = expand_csv(raw, {"id": "int", "item": "string"}, []).collect()
    assert [tuple(r) for r in rows] == [(2, 3, '5" disk'), (3, 4, "ok"), (4, 5, 'say "hi",\n\x1e')]
    assert all(r["success"] for r in verify_csv(raw, "id,item", 3).collect())


def test_one_large_csv_is_expanded_by_several_tasks(spark, tasks_of):
    lines = [f'{n},"text {n},\nof two lines ""quoted"""' if n % 3 else f'{n},5" disk' for n in range(3000)]
    raw = spark.createDataFrame([("f", "n,t\n" + "\n".join(lines)), ("g", "n,t\n1,x")], "file string, raw_payload string")
    columns = {"n": "int", "t": "string"}
    cut = expand_csv(raw, columns, ["file"], part_bytes=4096)
    assert Counter(cut.collect()) == Counter(expand_csv(raw, columns, ["file"]).collect())
    parts = csv_parts(raw, ["file"], size=4096)
    assert parts.count() > 20
    assert tasks_of(parts) > 1


def test_json_is_judged_as_by_the_json_module(spark):
    def refuse(name):
        raise ValueError(name)

    def valid(text):
        try:
            json.loads(text, parse_constant=refuse)
        except ValueError:
            return False
        return True

    draw = random.Random(3)
    pieces = ["1", '"a"', "{", "}", "[", "]", ",", ":", '"v"', '"end"', " ", "null", "-", "0", '"\\""', '"\n"', '{"a":1}', "[]", "\\", "'x'", "NaN"]
    texts = ["".join(draw.choices(pieces, k=draw.randint(0, 6))) for _ in range(8000)]
    texts += ['1],"v":[2', '{"a":1}],"end":1,"v":[{}', '1,"end":1,"v":2', '1,"end":1}', "", "  ", "1 2"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    found = {r["id"]: r["ok"] for r in df.select("id", is_json(F.col("t")).alias("ok")).collect()}
    assert [found[n] for n in range(len(texts))] == list(map(valid, texts))


def random_value(draw, depth):
    kind = draw.random()
    if depth <= 0 or kind < 0.4:
        return draw.choice([1, -2.5, None, True, "x", "a,b]}", 'q"uo\\te', "é😀", "", "\\"])
    if kind < 0.7:
        return [random_value(draw, depth - 1) for _ in range(draw.randint(0, 3))]
    return {draw.choice(["a", "b", "records", "c,"]): random_value(draw, depth - 1) for _ in range(draw.randint(0, 3))}


@pytest.fixture(scope="module")
def envelopes(spark):
    draw = random.Random(5)
    found = []
    for _ in range(200):
        keys = {k: random_value(draw, 2) for k in draw.sample(["x", "y", "z"], draw.randint(0, 2))}
        lists = [[], None, [{"a": n, "b": random_value(draw, 3)} for n in range(draw.randint(0, 12))], [random_value(draw, 3)] * 5, "s"]
        after = {k: random_value(draw, 2) for k in draw.sample(["u", "v", "w"], draw.randint(0, 2))}
        envelope = keys | {"records": draw.choice(lists)} | after
        found.append(json.dumps(envelope, ensure_ascii=draw.random() < 0.5, indent=draw.choice([None, None, 1])))
    found += ["", "[]", "{}", "not json", '{"deep":[[[[1]]]],"records":[1,2]}']
    return spark.createDataFrame(list(enumerate(found)), "id int, raw_payload string").repartition(4).cache()


def elements(df):
    each = df.select("id", F.explode(F.from_json("raw_payload", "records array<string>")["records"]).alias("e"))
    return Counter(map(tuple, each.collect()))


@pytest.mark.parametrize("size", [1, 7, 60])
def test_parts_of_arrays_hold_the_same_elements(envelopes, size):
    assert elements(json_array_parts(envelopes, "records", ["id"], size=size)) == elements(envelopes)


def test_one_large_json_is_expanded_by_several_tasks(spark, tasks_of):
    records = [{"n": n, "p": [{"y": y, "s": {"v": f"[{n},"}} for y in range(n % 4)]} for n in range(2000)]
    raw = spark.createDataFrame([("f", json.dumps({"m": {"k": [1]}, "data": records, "t": [1]}))], "file string, raw_payload string")
    fields = {"n": ("n", "int")}
    for expand in (
        lambda **o: expand_records(raw, "data", fields, ["file"], **o),
        lambda **o: expand_nested_records(raw, "data", "p", fields, {"y": ("y", "int"), "v": ("s.v", "string")}, ["file"], **o),
    ):
        assert Counter(expand(part_bytes=2048).collect()) == Counter(expand().collect())
    parts = json_array_parts(raw, "data", ["file"], size=2048)
    assert parts.count() > 20 and tasks_of(parts) > 1
